"""Dashboard queries over the marts, and the analyses the reference's README
claims but no model computes.

Rates are always recomputed from sums of their numerator and denominator,
never averaged across rows. Every query is a grouped aggregate with partial
aggregation; the only window (``traffic_mix``) partitions by date after the
aggregate, so it sees at most networks x format groups rows per date.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from burnlens.functions import constants as K
from burnlens.functions.columns import dsum, ratio, rnd, running, to_monday
from burnlens.operators.cohort import cohort_wide_sums

# ------------------------------------------------------- creative burnout page

def ctr_by_day_of_life(burnout: DataFrame) -> DataFrame:
    return burnout.groupBy("day_of_life", "format_group").agg(
        rnd(F.avg("ctr_7d_avg"), 6).alias("avg_ctr_7d"),
        F.count(F.lit(1)).alias("creative_days"),
    )


def burnout_scatter(burnout: DataFrame) -> DataFrame:
    return burnout.groupBy("creative_id", "creative_name", "format_group").agg(
        F.max("burnout_day_of_life").alias("burnout_day_of_life"),
        dsum("wasted_spend_usd").alias("wasted_spend_usd"),
        F.max("cumulative_spend_usd").alias("cumulative_spend_usd"),
    )


def top_burnt_creatives(burnout: DataFrame, k: int = 20) -> DataFrame:
    """Top-k creatives by spend wasted after burnout (a top-k report: the
    limit is the feature). Ties broken by creative_id so the order is total."""
    return (
        burnout.where(F.col("lifecycle_stage") == "burnt")
        .groupBy("creative_id", "creative_name")
        .agg(
            dsum("wasted_spend_usd").alias("wasted_spend_usd"),
            F.max("burnout_score").alias("max_burnout_score"),
            F.count(F.lit(1)).alias("burnt_days"),
        )
        .orderBy(F.desc("wasted_spend_usd"), F.asc("creative_id"))
        .limit(k)
    )


def total_wasted_spend(burnout: DataFrame) -> DataFrame:
    return burnout.agg(dsum("wasted_spend_usd").alias("total_wasted_spend_usd"))


def slicer(burnout: DataFrame, network: str = "Meta", format_group: str = "video") -> DataFrame:
    """The CTR curve restricted by the page slicers; the filter runs before
    the aggregate and reaches the scan."""
    sliced = burnout.where((F.col("network") == network) & (F.col("format_group") == format_group))
    return ctr_by_day_of_life(sliced)


# --------------------------------------------------------- unit economics page

def cac_by_network(unit: DataFrame) -> DataFrame:
    return unit.groupBy("network").agg(
        F.sum("total_installs").alias("total_installs"),
        dsum("total_spend_usd").alias("total_spend_usd"),
    ).withColumn("cac_usd", rnd(ratio("total_spend_usd", "total_installs"), 4))


def ltv_curve(installs: DataFrame, revenue: DataFrame) -> DataFrame:
    """LTV at D7/D14/D30 by network in long form: revenue through the day over
    the network's installs."""
    inst = installs.groupBy("network").agg(F.sum("cohort_installs").alias("installs"))
    rev = revenue.groupBy("network").agg(*[
        dsum(F.when(F.col("days_since_install") <= d, F.col("daily_revenue_usd")).otherwise(0.0))
        .alias(f"d{d}") for d in (7, 14, 30)
    ])
    long = rev.unpivot("network", ["d7", "d14", "d30"], "checkpoint", "revenue_usd")
    return long.join(inst, "network", "left").select(
        "network",
        F.substring("checkpoint", 2, 3).cast("int").alias("cohort_day"),
        "revenue_usd",
        "installs",
        rnd(ratio("revenue_usd", "installs"), 4).alias("ltv_usd"),
    )


def roas_matrix(unit: DataFrame) -> DataFrame:
    return unit.select("campaign_id", "campaign_name", "network", "country",
                       "roas_d7", "roas_d14", "roas_d30")


def payback_distribution(unit: DataFrame) -> DataFrame:
    return unit.groupBy("payback_period_bucket").agg(F.count(F.lit(1)).alias("campaigns"))


# ------------------------------------------------------------ cohort page

def _weekly(installs: DataFrame, revenue: DataFrame) -> DataFrame:
    days = sorted({0, *K.COHORT_DAYS})
    return (
        cohort_wide_sums(installs, revenue)
        .groupBy(to_monday("install_date").alias("install_week"))
        .agg(
            F.sum("total_installs").alias("total_installs"),
            dsum("total_spend_usd").alias("total_spend_usd"),
            *[dsum(f"rev_d{d}").alias(f"rev_d{d}") for d in days],
        )
    )


def arpu_heatmap(installs: DataFrame, revenue: DataFrame) -> DataFrame:
    """install_week x cohort day, ARPU from sums (long form)."""
    days = sorted({0, *K.COHORT_DAYS})
    w = _weekly(installs, revenue)
    long = w.unpivot(["install_week", "total_installs"], [f"rev_d{d}" for d in days],
                     "checkpoint", "revenue_usd")
    return long.select(
        "install_week",
        F.substring("checkpoint", 6, 3).cast("int").alias("cohort_day"),
        rnd(ratio("revenue_usd", "total_installs"), 4).alias("arpu_usd"),
    )


def roas_trend(installs: DataFrame, revenue: DataFrame) -> DataFrame:
    w = _weekly(installs, revenue)
    return w.select(
        "install_week", "total_spend_usd",
        *[rnd(ratio(f"rev_d{d}", "total_spend_usd"), 4).alias(f"roas_d{d}") for d in (7, 14, 30)],
    )


def installs_by_network_week(cohort: DataFrame) -> DataFrame:
    return cohort.groupBy("install_week", "network").agg(
        F.sum("total_installs").alias("total_installs"))


# -------------------------------------------------------------- SKAN page

CV_COLUMNS = ("cv_no_event", "cv_engagement", "cv_trial", "cv_low_revenue",
              "cv_mid_revenue", "cv_high_revenue")


def cv_bucket_distribution(skan: DataFrame) -> DataFrame:
    sums = skan.agg(*[F.sum(c).alias(c) for c in CV_COLUMNS])
    return sums.unpivot([], list(CV_COLUMNS), "cv_bucket", "postbacks").select(
        F.regexp_replace("cv_bucket", "^cv_", "").alias("cv_bucket"), "postbacks")


def privacy_impact(skan: DataFrame) -> DataFrame:
    return skan.groupBy("network").agg(
        F.sum("fine_cv_postbacks").alias("fine_cv_postbacks"),
        F.sum("low_threshold_postbacks").alias("low_threshold_postbacks"),
        F.sum("medium_threshold_postbacks").alias("medium_threshold_postbacks"),
    )


def coverage_trend(cv_map: DataFrame, ads: DataFrame) -> DataFrame:
    """First postbacks against reported installs by date. Each side is summed
    from its own rows: the attribution mart repeats a cohort's installs for
    every version of its postbacks."""
    postbacks = cv_map.where(F.col("postback_sequence") == 1).groupBy("install_date").agg(
        F.sum("postback_count").alias("skan_postbacks"), F.lit(0).cast("long").alias("mmp_installs"))
    installs = ads.groupBy(F.col("stat_date").alias("install_date")).agg(
        F.lit(0).cast("long").alias("skan_postbacks"), F.sum("installs").alias("mmp_installs"))
    return postbacks.unionByName(installs).groupBy("install_date").agg(
        F.sum("skan_postbacks").alias("skan_postbacks"), F.sum("mmp_installs").alias("mmp_installs"),
    ).withColumn("skan_coverage_rate", rnd(ratio("skan_postbacks", "mmp_installs"), 4))


def skan_kpis(postbacks: DataFrame, ads: DataFrame) -> DataFrame:
    """Mean conversion value, monetisation rate and ROAS of first postbacks,
    from sums over the postbacks and over the ad rows, each counted once."""
    first = postbacks.where(F.col("postback_sequence") == 1)
    one = first.agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("conversion_value").cast("long")).alias("cv"),
        F.count_if("has_revenue_signal").alias("signals"), dsum("estimated_revenue_usd").alias("revenue"),
        F.lit(None).cast("double").alias("spend"))
    two = ads.agg(
        *[F.lit(None).cast("long").alias(c) for c in ("n", "cv", "signals")],
        F.lit(None).cast("double").alias("revenue"), dsum("spend_usd").alias("spend"))
    t = one.unionByName(two).agg(*[F.max(c).alias(c) for c in ("n", "cv", "signals", "revenue", "spend")])
    return t.select(
        F.col("n").alias("skan_postbacks"),
        rnd(ratio("cv", "n"), 4).alias("avg_conversion_value"),
        rnd(ratio("signals", "n"), 4).alias("monetisation_rate"),
        rnd(ratio("revenue", "spend"), 4).alias("skan_roas"),
    )


# -------------------------------------------- analyses claimed by the README

def day_counts(rows: DataFrame, by: str, day: str) -> DataFrame:
    """(by, day, n): a histogram that days, loads or regions can be added up
    in, and from which quantiles are exact."""
    return rows.groupBy(by, F.col(day).alias("day")).agg(F.count(F.lit(1)).alias("n"))


def day_summary(counts: DataFrame, by: str) -> DataFrame:
    """(by, rows, mean, median) from ``day_counts``: the exact median by a running sum over
    the days (calendar many), so no task holds a value per row. NULL days
    count as rows only."""
    known = F.col("day").isNotNull()
    upto = F.sum(F.when(known, F.col("n"))).over(running([by], ["day"]))
    total = F.sum(F.when(known, F.col("n"))).over(Window.partitionBy(by))
    held = counts.select("*", upto.alias("__upto"), total.alias("__total"))

    def at(rank: Column) -> Column:
        return F.min(F.when(known & (F.col("__upto") >= rank), F.col("day")))
    return held.groupBy(by).agg(
        F.sum("n").alias("rows"),
        (F.sum(F.col("day") * F.col("n")).cast("double") / F.sum(F.when(known, F.col("n")))).alias("mean"),
        ((at(F.floor((F.col("__total") + 1) / 2)) + at(F.floor(F.col("__total") / 2) + 1)) / F.lit(2.0)).alias("median"))


def rotation_schedule(burnout_events: DataFrame, creatives: DataFrame) -> DataFrame:
    """Suggested rotation day per format: exact median burnout day of life."""
    joined = burnout_events.join(creatives.select("creative_id", "format"), "creative_id")
    return day_summary(day_counts(joined, "format", "burnout_day_of_life"), "format").select(
        "format", F.col("rows").alias("burnt_creatives"), F.col("median").alias("rotation_day"))


def post_burnout_cpi_inflation(burnout: DataFrame) -> DataFrame:
    post = F.col("is_post_burnout")
    spend_after = dsum(F.when(post, F.col("spend_usd")).otherwise(0.0))
    spend_before = dsum(F.when(~post, F.col("spend_usd")).otherwise(0.0))
    inst_after = F.sum(F.when(post, F.col("installs")).otherwise(0))
    inst_before = F.sum(F.when(~post, F.col("installs")).otherwise(0))
    return burnout.groupBy("format_group").agg(
        rnd(ratio(spend_before, inst_before), 4).alias("cpi_before_usd"),
        rnd(ratio(spend_after, inst_after), 4).alias("cpi_after_usd"),
        rnd(ratio(ratio(spend_after, inst_after), ratio(spend_before, inst_before)), 4)
        .alias("cpi_inflation"),
    )


def wasted_spend_share(burnout: DataFrame) -> DataFrame:
    wasted, total = dsum("wasted_spend_usd"), dsum("spend_usd")
    return burnout.agg(
        wasted.alias("wasted_spend_usd"),
        total.alias("spend_usd"),
        rnd(ratio(wasted, total), 4).alias("wasted_share"),
    )


def traffic_mix(metrics: DataFrame) -> DataFrame:
    """Spend share by network x format group within each day."""
    daily = metrics.groupBy("stat_date", "network", "format_group").agg(
        dsum("spend_usd").alias("spend_usd"))
    day_total = dsum("spend_usd", over=Window.partitionBy("stat_date"))
    return daily.select("*", rnd(ratio(F.col("spend_usd"), day_total), 4).alias("spend_share"))


def peak_day_by_format(peaks: DataFrame, creatives: DataFrame) -> DataFrame:
    joined = peaks.join(creatives.select("creative_id", "format"), "creative_id")
    return day_summary(day_counts(joined, "format", "peak_day_of_life"), "format").select(
        "format", F.col("rows").alias("creatives"), rnd("mean", 2).alias("avg_peak_day_of_life"), F.col("median").alias("median_peak_day_of_life"))
