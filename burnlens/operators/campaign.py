"""Campaign performance: daily totals, rolling trends and saturation flags.

The daily aggregate shuffles on its group keys after a map-side partial
aggregate; the trend windows then partition by campaign. A campaign's rows
are days x (network, country), so a window partition is bounded by the
calendar, not by traffic: a campaign holding a third of all ad rows still
arrives at the window as one row per day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from burnlens.functions import constants as K
from burnlens.functions.columns import (
    dsum, exact_avg, flag, nan_to_null, ratio, rnd, running, to_monday, trailing,
)

ORDER = ["stat_date", "network", "country"]


def saturation_flag(trend: Column) -> Column:
    """NULL (and, thanks to ``nan_to_null``, NaN) ratios are 'stable'."""
    return (
        F.when(trend > K.SATURATING_ABOVE, "saturating")
        .when(trend > K.WATCH_ABOVE, "watch")
        .when(trend < K.IMPROVING_BELOW, "improving")
        .otherwise("stable")
    )


def cpi_trend_ratio(cpi: Column, prior_avg: Column) -> Column:
    return nan_to_null(rnd(ratio(cpi, prior_avg), 4))


def campaign_daily(ads: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Daily totals by ids; the campaign's texts are joined to the totals, so
    none goes through the shuffles of the distinct count."""
    totals = (
        ads.groupBy("stat_date", "campaign_id", "network", "country")
        .agg(
            F.sum("impressions").alias("impressions"),
            F.sum("clicks").alias("clicks"),
            dsum("spend_usd").alias("spend_usd"),
            F.sum("installs").alias("installs"),
            F.countDistinct("creative_id").alias("active_creatives"),
        )
    )
    camp = campaigns.select("campaign_id", "campaign_name", "objective", "daily_budget_usd")
    return (
        totals.join(camp, "campaign_id")
        .select(
            "stat_date", "campaign_id", "network", "country", "campaign_name", "objective", "daily_budget_usd",
            "impressions", "clicks", "spend_usd", "installs", "active_creatives",
            rnd(ratio("clicks", "impressions"), 6).alias("blended_ctr"),
            rnd(ratio("spend_usd", "installs"), 4).alias("blended_cpi_usd"),
            rnd(ratio("spend_usd", "impressions") * 1000, 4).alias("blended_cpm_usd"),
            rnd(ratio("spend_usd", "daily_budget_usd"), 4).alias("budget_utilisation_rate"),
        )
    )


BITMAP = 32768  # codes of a bitmap
WORD = 64


def creative_codes(ads: DataFrame) -> DataFrame:
    """(campaign_id, creative_id, code): creatives numbered within their campaign."""
    known = ads.select("campaign_id", "creative_id").where("creative_id IS NOT NULL").distinct()
    return known.select("*", (F.row_number().over(Window.partitionBy("campaign_id").orderBy("creative_id")) - 1).alias("code"))


def active_state(ads: DataFrame, codes: DataFrame) -> DataFrame:
    """(stat_date, campaign_id, network, country, bucket, creatives): the daily
    rows' active creatives as bitmaps of their codes, of which only the words of 64 bits that
    have any are held (word, bits): a day of few creatives takes a few bytes. A distinct count can't be added
    up over days; a bitmap can."""
    keys = ["stat_date", "campaign_id", "network", "country"]
    bit = F.expr(f"shiftleft(1L, CAST(pmod(code, {WORD}) AS INT))")
    words = (ads.select(*keys, "creative_id").join(codes, ["campaign_id", "creative_id"])
             .groupBy(*keys, F.floor(F.col("code") / WORD).alias("at")).agg(F.bit_or(bit).alias("bits")))
    per = BITMAP // WORD
    return (words.groupBy(*keys, F.floor(F.col("at") / per).alias("bucket"))
            .agg(F.collect_list(F.struct(F.pmod("at", F.lit(per)).cast("int").alias("word"), F.col("bits"))).alias("creatives")))


def active_creatives(state: DataFrame, *grain) -> DataFrame:
    """Exact numbers of active creatives by ``grain`` (columns; the campaign is
    always among the result's keys), from ``active_state`` rows alone."""
    keys = [g if isinstance(g, Column) else F.col(g) for g in grain]
    words = state.select("*", F.inline("creatives"))
    whole = words.groupBy("campaign_id", "bucket", "word", *keys).agg(F.bit_or("bits").alias("bits"))
    names = [c for c in whole.columns if c not in ("bucket", "word", "bits")]
    return whole.groupBy(*names).agg(F.sum(F.bit_count("bits").cast("bigint")).alias("active_creatives"))


def campaign_performance(ads: DataFrame, campaigns: DataFrame) -> DataFrame:
    """mart_campaign_performance: one row per (stat_date, campaign, network, country)."""
    daily = campaign_daily(ads, campaigns)
    by = ["campaign_id"]
    cpi = F.col("blended_cpi_usd")
    t = daily.select(
        "*",
        rnd(exact_avg(cpi, 4, over=trailing(by, ORDER, -6)), 4).alias("cpi_7d_avg"),
        rnd(exact_avg("blended_ctr", 6, over=trailing(by, ORDER, -13)), 6).alias("ctr_14d_avg"),
        rnd(dsum("spend_usd", over=running(by, ORDER)), 2).alias("cumulative_spend_usd"),
        F.sum("installs").over(running(by, ORDER)).alias("cumulative_installs"),
        cpi_trend_ratio(cpi, exact_avg(cpi, 4, over=trailing(by, ORDER, -13, -1)))
        .alias("cpi_trend_ratio"),
    )
    return t.select(
        "*",
        saturation_flag(F.col("cpi_trend_ratio")).alias("saturation_flag"),
        flag(F.col("budget_utilisation_rate") > K.OVER_BUDGET_ABOVE).alias("is_over_budget"),
        to_monday("stat_date").alias("stat_week"),
    )
