"""Staging layer: clean, cast and derive per raw row. Pure projections and
filters, so Catalyst inlines them into every reader and pushes the filters
into the scan."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from burnlens.functions import constants as K
from burnlens.functions.columns import case_map, flag, ratio, rnd


def as_of_col(as_of: dt.date | str | Column | None) -> Column:
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(as_of if isinstance(as_of, dt.date) else dt.date.fromisoformat(as_of))


# ----------------------------------------------------------------- campaigns
def campaign_is_active(end_date: Column, as_of: Column) -> Column:
    return flag(end_date.isNull() | (end_date >= as_of))


def campaign_duration(start: Column, end: Column) -> Column:
    return F.datediff(end, start)  # NULL when open-ended


def stg_campaigns(raw: DataFrame, as_of=None) -> DataFrame:
    end = F.col("end_date").cast("date")
    start = F.col("start_date").cast("date")
    return raw.where(F.col("campaign_id").isNotNull()).select(
        "campaign_id", "campaign_name", "network", "objective", "country",
        F.col("daily_budget").cast("double").alias("daily_budget_usd"),
        start.alias("start_date"),
        end.alias("end_date"),
        campaign_is_active(end, as_of_col(as_of)).alias("is_active"),
        campaign_duration(start, end).alias("campaign_duration_days"),
    )


# ----------------------------------------------------------------- creatives
def creative_format_group(fmt: Column) -> Column:
    return case_map(fmt, K.FORMAT_GROUPS, "other")


def creative_is_video(fmt: Column) -> Column:
    return flag(fmt.isin(*[f for f, _ in K.VIDEO_LENGTHS]))


def creative_video_length(fmt: Column) -> Column:
    return case_map(fmt, K.VIDEO_LENGTHS)


def stg_creatives(raw: DataFrame) -> DataFrame:
    fmt = F.col("format")
    return raw.where(F.col("creative_id").isNotNull()).select(
        "creative_id", "campaign_id", "creative_name", "format", "size",
        F.col("launch_date").cast("date").alias("launch_date"),
        creative_format_group(fmt).alias("format_group"),
        creative_is_video(fmt).alias("is_video"),
        creative_video_length(fmt).alias("video_length_seconds"),
    )


# ------------------------------------------------------------------ ad stats
def ad_row_filter() -> Column:
    return (
        F.col("stat_date").isNotNull()
        & F.col("campaign_id").isNotNull()
        & F.col("creative_id").isNotNull()
        & (F.col("spend_usd") >= 0)
        & (F.col("impressions") >= 0)
    )


def ad_ratio_metrics(impressions: Column, clicks: Column, spend: Column, installs: Column) -> list[Column]:
    return [
        rnd(ratio(clicks, impressions), 6).alias("ctr"),
        rnd(ratio(installs, clicks), 6).alias("cvr_click_to_install"),
        rnd(ratio(spend, installs), 4).alias("cpi_usd"),
        rnd(ratio(spend, impressions) * 1000, 4).alias("cpm_usd"),
        rnd(ratio(spend, clicks), 4).alias("cpc_usd"),
    ]


def stg_ad_stats(raw: DataFrame) -> DataFrame:
    impressions = F.col("impressions").cast("bigint")
    clicks = F.col("clicks").cast("bigint")
    spend = F.col("spend_usd").cast("double")
    installs = F.col("installs").cast("bigint")
    return raw.where(ad_row_filter()).select(
        F.col("stat_date").cast("date").alias("stat_date"),
        "campaign_id", "creative_id", "network", "country",
        impressions.alias("impressions"),
        clicks.alias("clicks"),
        spend.alias("spend_usd"),
        installs.alias("installs"),
        *ad_ratio_metrics(impressions, clicks, spend, installs),
    )


# ------------------------------------------------------------ SKAN postbacks
def skan_cv_bucket(cv: Column) -> Column:
    expr = None
    for lo, hi, label in K.CV_BUCKETS:
        cond = cv.between(lo, hi)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr  # no else: out-of-domain values give NULL


def skan_cv_revenue(cv: Column) -> Column:
    expr = None
    for lo, hi, value in K.CV_REVENUE:
        cond = cv.between(lo, hi)
        expr = F.when(cond, F.lit(value)) if expr is None else expr.when(cond, F.lit(value))
    above = (cv - K.CV_REVENUE_ABOVE_BASE) * F.lit(K.CV_REVENUE_STEP) + F.lit(K.CV_REVENUE_OFFSET)
    return expr.otherwise(above)


def skan_has_revenue(cv: Column) -> Column:
    return flag(cv >= K.CV_REVENUE_SIGNAL_MIN)


def skan_cv_quality(privacy: Column) -> Column:
    return F.when(privacy == K.FINE_PRIVACY, "fine").otherwise("coarse")


def skan_row_filter() -> Column:
    return (
        F.col("postback_id").isNotNull()
        & F.col("install_date").isNotNull()
        & F.col("conversion_value").between(0, 63)
    )


def stg_skan_postbacks(raw: DataFrame) -> DataFrame:
    cv = F.col("conversion_value").cast("int")
    return raw.where(skan_row_filter()).select(
        "postback_id",
        F.col("install_date").cast("date").alias("install_date"),
        "campaign_id", "creative_id", "network", "country", "skan_version",
        cv.alias("conversion_value"),
        F.col("postback_sequence").cast("int").alias("postback_sequence"),
        "privacy_threshold",
        skan_cv_bucket(cv).alias("cv_bucket"),
        skan_cv_revenue(cv).alias("estimated_revenue_usd"),
        skan_has_revenue(cv).alias("has_revenue_signal"),
        skan_cv_quality(F.col("privacy_threshold")).alias("cv_quality"),
    )


# ---------------------------------------------------------------- IAP events
def iap_days_since_install(install: Column, event: Column) -> Column:
    return F.datediff(event, install)


def iap_product_tier(product: Column) -> Column:
    return case_map(product, K.PRODUCT_TIERS, "other")


def iap_is_revenue_event(event_type: Column) -> Column:
    return flag(event_type != "trial_start")


def iap_monthly_equivalent(product: Column, revenue: Column) -> Column:
    expr = None
    for pid, op, factor in K.MONTHLY_EQUIVALENT:
        value = revenue * F.lit(factor) if op == "mul" else revenue / F.lit(factor)
        expr = F.when(product == pid, value) if expr is None else expr.when(product == pid, value)
    return expr.otherwise(revenue)


def iap_row_filter() -> Column:
    return (
        F.col("event_id").isNotNull()
        & F.col("install_date").isNotNull()
        & (F.col("event_date") >= F.col("install_date"))
        & (F.col("revenue_usd") >= 0)
    )


def stg_iap_events(raw: DataFrame) -> DataFrame:
    install = F.col("install_date").cast("date")
    event = F.col("event_date").cast("date")
    revenue = F.col("revenue_usd").cast("double")
    return raw.where(iap_row_filter()).select(
        "event_id",
        install.alias("install_date"),
        event.alias("event_date"),
        "campaign_id", "creative_id", "network", "country", "event_type", "product_id",
        revenue.alias("revenue_usd"),
        iap_days_since_install(install, event).alias("days_since_install"),
        iap_product_tier(F.col("product_id")).alias("product_tier"),
        iap_is_revenue_event(F.col("event_type")).alias("is_revenue_event"),
        iap_monthly_equivalent(F.col("product_id"), revenue).alias("monthly_equivalent_usd"),
    )
