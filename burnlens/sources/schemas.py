"""Declared schemas of the five raw tables (never inferred)."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 4)


def _s(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


CAMPAIGNS = _s(
    ("campaign_id", T.StringType(), True),
    ("campaign_name", T.StringType(), True),
    ("network", T.StringType(), True),
    ("objective", T.StringType(), True),
    ("country", T.StringType(), True),
    ("daily_budget", MONEY, True),
    ("start_date", T.DateType(), True),
    ("end_date", T.DateType(), True),
)

CREATIVES = _s(
    ("creative_id", T.StringType(), True),
    ("campaign_id", T.StringType(), True),
    ("creative_name", T.StringType(), True),
    ("format", T.StringType(), True),
    ("size", T.StringType(), True),
    ("launch_date", T.DateType(), True),
)

AD_DAILY_STATS = _s(
    ("stat_date", T.DateType(), True),
    ("campaign_id", T.StringType(), True),
    ("creative_id", T.StringType(), True),
    ("network", T.StringType(), True),
    ("country", T.StringType(), True),
    ("impressions", T.LongType(), True),
    ("clicks", T.LongType(), True),
    ("spend_usd", MONEY, True),
    ("installs", T.LongType(), True),
)

SKAN_POSTBACKS = _s(
    ("postback_id", T.StringType(), True),
    ("install_date", T.DateType(), True),
    ("campaign_id", T.StringType(), True),
    ("creative_id", T.StringType(), True),
    ("network", T.StringType(), True),
    ("country", T.StringType(), True),
    ("skan_version", T.StringType(), True),
    ("conversion_value", T.IntegerType(), True),
    ("postback_sequence", T.IntegerType(), True),
    ("privacy_threshold", T.StringType(), True),
)

IAP_EVENTS = _s(
    ("event_id", T.StringType(), True),
    ("install_date", T.DateType(), True),
    ("event_date", T.DateType(), True),
    ("campaign_id", T.StringType(), True),
    ("creative_id", T.StringType(), True),
    ("network", T.StringType(), True),
    ("country", T.StringType(), True),
    ("event_type", T.StringType(), True),
    ("product_id", T.StringType(), True),
    ("revenue_usd", MONEY, True),
)

RAW_SCHEMAS = {
    "campaigns": CAMPAIGNS,
    "creatives": CREATIVES,
    "ad_daily_stats": AD_DAILY_STATS,
    "skan_postbacks": SKAN_POSTBACKS,
    "iap_events": IAP_EVENTS,
}

# On-disk layout of each raw table: sort key and the date column whose month
# partitions the facts (None = unpartitioned dimension).
SORT_KEYS = {
    "campaigns": ("network", "campaign_id"),
    "creatives": ("campaign_id", "creative_id"),
    "ad_daily_stats": ("stat_date", "campaign_id", "creative_id"),
    "skan_postbacks": ("install_date", "campaign_id", "creative_id"),
    "iap_events": ("install_date", "event_date", "campaign_id"),
}
MONTH_PARTITION = {
    "campaigns": None,
    "creatives": None,
    "ad_daily_stats": "stat_date",
    "skan_postbacks": "install_date",
    "iap_events": "install_date",
}
