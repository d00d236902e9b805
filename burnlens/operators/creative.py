"""Creative lifecycle: daily metrics, peaks, burnout events and the burnout
mart (the headline model).

Physical plan: the dimension joins are small-side hash joins (Spark's size
check decides broadcast vs shuffle), then everything is partitioned once by
``creative_id``. The rolling windows, the peak, the burnout crossing and the
best CPI are all window aggregates over that same partitioning, so the mart
is one shuffle with no join back; per-creative history is bounded by days,
so no window partition grows with event volume.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from burnlens.functions import constants as K
from burnlens.functions.columns import dsum, exact_avg, flag, ratio, rnd, running, trailing

CREATIVE_ORDER = ["stat_date", "campaign_id", "network", "country"]


def join_dims(ads: DataFrame, creatives: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Ads inner creatives inner campaigns, then the residual stat_date >=
    launch_date. Both dimensions are small-side hash joins: Spark broadcasts
    them when their measured size is under the threshold and shuffles
    otherwise (no unconditional broadcast hint)."""
    cre = creatives.select(
        "creative_id", "creative_name", "format", "format_group", "is_video", "launch_date"
    )
    camp = campaigns.select("campaign_id", "objective")
    return (
        ads.join(cre, "creative_id", "inner")
        .join(camp, "campaign_id", "inner")
        .where(F.col("stat_date") >= F.col("launch_date"))
    )


def daily_metrics(ads: DataFrame, creatives: DataFrame, campaigns: DataFrame) -> DataFrame:
    """int_creative_daily_metrics: one row per staged ad row on or after launch."""
    joined = join_dims(ads, creatives, campaigns)
    w7 = trailing(["creative_id"], CREATIVE_ORDER, -6)
    cum = running(["creative_id"], CREATIVE_ORDER)
    return joined.select(
        "stat_date", "campaign_id", "creative_id", "network", "country",
        "creative_name", "format", "format_group", "is_video", "launch_date", "objective",
        F.datediff("stat_date", "launch_date").alias("day_of_life"),
        "impressions", "clicks", "spend_usd", "installs",
        "ctr", "cvr_click_to_install", "cpi_usd", "cpm_usd", "cpc_usd",
        exact_avg("ctr", 6, over=w7).alias("ctr_7d_avg"),
        F.max("ctr").over(cum).alias("ctr_peak_so_far"),
        dsum("spend_usd", over=cum).alias("cumulative_spend_usd"),
        F.sum("installs").over(cum).alias("cumulative_installs"),
    )


def _eligible(c: str = "impressions") -> Column:
    return F.col(c) >= K.MIN_IMPRESSIONS_FOR_BURNOUT


def peak_day_of_life(ctr: Column, dol: Column) -> Column:
    """argMax(day_of_life, ctr); on equal ctr the earliest day wins."""
    return F.max_by(dol, F.struct(ctr.alias("c"), (-dol).alias("d")))


def peaks(metrics: DataFrame) -> DataFrame:
    """int_creative_peaks: one row per creative over days with >= 500 impressions."""
    return (
        metrics.where(_eligible())
        .groupBy("creative_id")
        .agg(
            F.max("ctr").alias("absolute_peak_ctr"),
            F.min("stat_date").alias("first_stat_date"),
            peak_day_of_life(F.col("ctr"), F.col("day_of_life")).alias("peak_day_of_life"),
        )
    )


def _burnt(ctr_7d: Column, peak: Column, dol: Column, peak_dol: Column) -> Column:
    return (ctr_7d < peak * F.lit(K.BURNOUT_CTR_THRESHOLD)) & (dol > peak_dol)


def crossing_rows(metrics: DataFrame, peaks_df: DataFrame) -> DataFrame:
    """Metrics inner peaks on creative_id plus the non-equi residuals: the
    eligible days below 70 % of peak after the peak day."""
    return (
        metrics.where(_eligible())
        .join(peaks_df.select("creative_id", "absolute_peak_ctr", "peak_day_of_life"), "creative_id")
        .where(_burnt(F.col("ctr_7d_avg"), F.col("absolute_peak_ctr"),
                      F.col("day_of_life"), F.col("peak_day_of_life")))
    )


def burnout_joined(metrics: DataFrame, peaks_df: DataFrame, events: DataFrame) -> DataFrame:
    """The reference's join form of the mart input: eligible days inner
    peaks, left burnout events (a creative that never burnt keeps NULLs).
    The mart itself computes the same values as window aggregates."""
    return (
        metrics.where(_eligible())
        .join(peaks_df, "creative_id", "inner")
        .join(events, "creative_id", "left")
    )


def burnout_events(metrics: DataFrame, peaks_df: DataFrame | None = None) -> DataFrame:
    """int_burnout_events: first crossing below 70 % of peak after the peak day."""
    p = peaks(metrics) if peaks_df is None else peaks_df
    return (
        crossing_rows(metrics, p)
        .groupBy("creative_id")
        .agg(
            F.min("stat_date").alias("burnout_date"),
            F.min("day_of_life").alias("burnout_day_of_life"),
        )
    )


def burnout_score(ctr_7d: Column, peak: Column) -> Column:
    """round(greatest(0, 1 - ctr_7d / nullif(peak, 0)), 4); NULL without a peak."""
    x = F.lit(1.0) - ratio(ctr_7d, peak)
    return rnd(F.when(x.isNotNull(), F.greatest(F.lit(0.0), x)), 4)


def lifecycle_stage(dol, peak_dol, stat_date, burnout_date, ctr_7d, peak) -> Column:
    return (
        F.when(dol <= peak_dol, "warming_up")
        .when(burnout_date.isNull() | (stat_date < burnout_date), "peak")
        .when(ctr_7d >= peak * F.lit(K.BURNOUT_CTR_THRESHOLD), "declining")
        .otherwise("burnt")
    )


MART_COLUMNS = [
    "stat_date", "creative_id", "campaign_id", "network", "country", "creative_name",
    "format", "format_group", "is_video", "launch_date", "day_of_life",
    "impressions", "clicks", "spend_usd", "installs", "ctr", "ctr_7d_avg", "cpi_usd",
    "cumulative_spend_usd", "cumulative_installs",
    "absolute_peak_ctr", "peak_day_of_life", "burnout_date", "burnout_day_of_life",
    "burnout_score", "lifecycle_stage", "is_post_burnout", "wasted_spend_usd",
    "ctr_vs_peak_ratio", "cpi_vs_best_ratio",
]


def creative_burnout(
    metrics: DataFrame,
    since: dt.date | None = None,
    compat_window: bool = False,
) -> DataFrame:
    """mart_creative_burnout.

    ``since``: incremental runs keep only stat_date >= since (the caller
    derives it from the target, see ``burnlens.streaming.incremental``).
    Peaks and burnout events always come from full history, as in the
    reference. The best CPI also uses full history unless ``compat_window``
    reproduces the reference's min over the reprocessed dates only.
    """
    per_creative = Window.partitionBy("creative_id")
    d = metrics.where(_eligible())
    ctr, ctr7, dol = F.col("ctr"), F.col("ctr_7d_avg"), F.col("day_of_life")
    d = d.select(
        *metrics.columns,
        F.max(ctr).over(per_creative).alias("absolute_peak_ctr"),
        peak_day_of_life(ctr, dol).over(per_creative).alias("peak_day_of_life"),
    )
    crossed = _burnt(ctr7, F.col("absolute_peak_ctr"), dol, F.col("peak_day_of_life"))
    in_window = F.lit(True) if since is None else F.col("stat_date") >= F.lit(since)
    best_cpi_input = F.col("cpi_usd") if not compat_window else F.when(in_window, F.col("cpi_usd"))
    d = d.select(
        "*",
        F.min(F.when(crossed, F.col("stat_date"))).over(per_creative).alias("burnout_date"),
        F.min(F.when(crossed, dol)).over(per_creative).alias("burnout_day_of_life"),
        F.min(best_cpi_input).over(per_creative).alias("best_cpi"),
    )
    return finish_burnout(d if since is None else d.where(in_window))


def finish_burnout(d: DataFrame) -> DataFrame:
    """The mart's columns, from metric rows with their creative's peak, burnout
    and best CPI."""
    ctr7, dol = F.col("ctr_7d_avg"), F.col("day_of_life")
    peak, bdate = F.col("absolute_peak_ctr"), F.col("burnout_date")
    post = bdate.isNotNull() & (F.col("stat_date") >= bdate)
    return d.select(
        *MART_COLUMNS[:22],
        "burnout_date", "burnout_day_of_life",
        burnout_score(ctr7, peak).alias("burnout_score"),
        lifecycle_stage(dol, F.col("peak_day_of_life"), F.col("stat_date"), bdate, ctr7, peak)
        .alias("lifecycle_stage"),
        flag(post).alias("is_post_burnout"),
        F.when(post, F.col("spend_usd")).otherwise(F.lit(0.0)).alias("wasted_spend_usd"),
        rnd(ratio(ctr7, peak), 4).alias("ctr_vs_peak_ratio"),
        rnd(ratio(F.col("cpi_usd"), F.col("best_cpi")), 4).alias("cpi_vs_best_ratio"),
    )
