"""SKAN postbacks: conversion-value distribution and reconciliation with the
reported (MMP) installs.

Postbacks are row-level and the largest input; they are reduced to cohort
grain with decomposable aggregates (counts, conditional counts, decimal sums,
avg) so the partial aggregate runs before the shuffle. The full outer join is
between two cohort-grain aggregates, never between raw rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from burnlens.functions.columns import dsum, ratio, rnd

SKAN_KEYS = ["install_date", "campaign_id", "creative_id", "network", "country"]
CV_COUNTS = (
    ("no_event", "cv_no_event"),
    ("engagement", "cv_engagement"),
    ("trial_start", "cv_trial"),
    ("low_revenue", "cv_low_revenue"),
    ("mid_revenue", "cv_mid_revenue"),
    ("high_revenue", "cv_high_revenue"),
)


def cv_mapping(postbacks: DataFrame) -> DataFrame:
    """int_skan_cv_mapping: one row per cohort, skan_version and postback_sequence."""
    privacy, bucket = F.col("privacy_threshold"), F.col("cv_bucket")
    signal = F.count_if(F.col("has_revenue_signal"))
    n = F.count(F.lit(1))
    return postbacks.groupBy(*SKAN_KEYS, "skan_version", "postback_sequence").agg(
        n.alias("postback_count"),
        F.count_if(privacy == "none").alias("fine_cv_count"),
        F.count_if(privacy == "low").alias("low_threshold_count"),
        F.count_if(privacy == "medium").alias("medium_threshold_count"),
        *[F.count_if(bucket == b).alias(name) for b, name in CV_COUNTS],
        signal.alias("revenue_signal_count"),
        dsum("estimated_revenue_usd").alias("estimated_revenue_usd"),
        rnd(F.avg("conversion_value"), 2).alias("avg_conversion_value"),
        rnd(ratio(signal, n), 4).alias("monetisation_rate"),
    )


def reported_installs(ads: DataFrame) -> DataFrame:
    return ads.groupBy(
        F.col("stat_date").alias("install_date"), "campaign_id", "creative_id", "network", "country"
    ).agg(F.sum("installs").alias("reported_installs"), dsum("spend_usd").alias("spend_usd"))


def reconcile(skan: DataFrame, ads: DataFrame) -> DataFrame:
    """Full outer join on the five cohort keys; keys coalesced, measures to 0."""
    s = skan.select([F.col(c).alias(f"s_{c}") for c in skan.columns])
    a = ads.select([F.col(c).alias(f"a_{c}") for c in ads.columns])
    cond = [F.col(f"s_{k}") == F.col(f"a_{k}") for k in SKAN_KEYS]
    j = s.join(a, cond, "full_outer")

    def z(c: str, zero=0):
        return F.coalesce(F.col(c), F.lit(zero))

    return j.select(
        *[F.coalesce(F.col(f"s_{k}"), F.col(f"a_{k}")).alias(k) for k in SKAN_KEYS],
        z("s_postback_count").alias("skan_postbacks"),
        z("s_fine_cv_count").alias("fine_cv_postbacks"),
        z("s_low_threshold_count").alias("low_threshold_postbacks"),
        z("s_medium_threshold_count").alias("medium_threshold_postbacks"),
        *[z(f"s_{name}").alias(name) for _, name in CV_COUNTS],
        z("s_revenue_signal_count").alias("revenue_signal_postbacks"),
        z("s_estimated_revenue_usd", 0.0).alias("skan_estimated_revenue_usd"),
        z("s_monetisation_rate", 0.0).alias("skan_monetisation_rate"),
        z("s_avg_conversion_value", 0.0).alias("avg_cv"),
        z("a_reported_installs").alias("mmp_installs"),
        z("a_spend_usd", 0.0).alias("spend_usd"),
    )


def skan_attribution(cv_map: DataFrame, ads: DataFrame, campaigns: DataFrame) -> DataFrame:
    """mart_skan_attribution: first postbacks reconciled with reported installs."""
    skan = cv_map.where(F.col("postback_sequence") == 1)
    r = reconcile(skan, reported_installs(ads)).join(
        campaigns.select("campaign_id", "campaign_name", "objective"), "campaign_id", "left"
    )
    paid = F.col("cv_low_revenue") + F.col("cv_mid_revenue") + F.col("cv_high_revenue")
    return r.select(
        *SKAN_KEYS,
        "skan_postbacks", "fine_cv_postbacks", "low_threshold_postbacks",
        "medium_threshold_postbacks", *[name for _, name in CV_COUNTS],
        "revenue_signal_postbacks", "skan_estimated_revenue_usd", "skan_monetisation_rate",
        "avg_cv", "mmp_installs", "spend_usd", "campaign_name", "objective",
        rnd(ratio("skan_postbacks", "mmp_installs"), 4).alias("skan_coverage_rate"),
        rnd(ratio("medium_threshold_postbacks", "skan_postbacks"), 4).alias("privacy_loss_rate"),
        rnd(ratio("fine_cv_postbacks", "skan_postbacks"), 4).alias("fine_signal_rate"),
        rnd(ratio(paid, paid + F.col("cv_trial")), 4).alias("trial_to_revenue_rate"),
        rnd(ratio("spend_usd", "skan_postbacks"), 4).alias("skan_cpi_usd"),
        rnd(ratio("skan_estimated_revenue_usd", "spend_usd"), 4).alias("skan_roas"),
    )
