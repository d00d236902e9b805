"""Test-data adapter: derives the five raw user-acquisition tables from the
driver's ``lineitem`` and ``supplier`` tables, entirely in Spark.

Every row of ``lineitem`` contributes: ad delivery rows are aggregated per
(day, creative), postbacks and IAP events are one per line. Nothing is
sampled or capped; the raw tables grow linearly with the input.

Mapping (all arithmetic is integer or decimal, so DuckDB derives exactly the
same rows; see ``burnlens.oracle`` for the SQL twin):

* day ``d`` = 2024-10-01 + (days from 1995-01-01 to l_shipdate) % 92
* campaign = supplier; creative number = l_suppkey * 4 + l_partkey % 4
* ad row per (d, creative): impressions = 100 * sum(qty),
  clicks = sum(qty * (1 + round(100 * discount))), spend = sum(price) * 0.01,
  installs = sum(linenumber - 1)
* postback per line: cv = (orderkey + partkey) % 64, sequence =
  1 + linenumber % 3, install date = d + orderkey % 2 (a late postback)
* IAP event per line: event date = d + qty % 40, product by partkey % 5,
  type by linenumber % 4, revenue = list price * (1 + (suppkey % 8) * 5)
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from burnlens.functions.constants import (
    COUNTRIES, EVENT_TYPES, FORMATS, NETWORKS, OBJECTIVES, SIZES,
)

# ---------------------------------------------------------------- fixed values
AD_WINDOW_START = dt.date(2024, 10, 1)
AD_WINDOW_DAYS = 92
SHIP_EPOCH = dt.date(1995, 1, 1)
# IAP products and list prices; the fifth is an unknown product (tier other).
PRODUCTS = ("weekly_sub", "monthly_sub", "annual_sub", "lifetime", "coins_pack")
PRICES = ("9.99", "29.99", "79.99", "199.99", "4.99")
PRIVACY_BY_RETURNFLAG = (("N", "none"), ("R", "low"), ("A", "medium"))
# ------------------------------------------------------------ end fixed values

LINE_COLUMNS = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
    "l_extendedprice", "l_discount", "l_returnflag", "l_linestatus", "l_shipdate",
)


def pick(values, idx: Column) -> Column:
    """values[idx] with a 0-based integer index."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


def campaign_id(sk: Column) -> Column:
    return F.concat(F.lit("cmp_"), sk.cast("string"))


def creative_id(cnum: Column) -> Column:
    return F.concat(F.lit("cre_"), cnum.cast("string"))


def source_columns(sk: Column, cnum: Column) -> list[Column]:
    """campaign_id, creative_id, network, country (the raw schemas' order)."""
    return [
        campaign_id(sk).alias("campaign_id"),
        creative_id(cnum).alias("creative_id"),
        pick(NETWORKS, sk % 5).alias("network"),
        pick(COUNTRIES, sk % 6).alias("country"),
    ]


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(*LINE_COLUMNS)
    day = F.date_add(
        F.lit(AD_WINDOW_START),
        F.datediff(F.col("l_shipdate").cast("date"), F.lit(SHIP_EPOCH)) % AD_WINDOW_DAYS,
    )
    return li.select(
        *LINE_COLUMNS[:-1],
        day.alias("d"),
        (F.col("l_suppkey") * 4 + F.col("l_partkey") % 4).alias("cnum"),
    )


def campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    sk = F.col("s_suppkey")
    start = F.date_add(F.lit(AD_WINDOW_START), (sk % 21).cast("int"))
    return spark.read.parquet(f"{sf_dir}/supplier.parquet").select(
        campaign_id(sk).alias("campaign_id"),
        F.concat(F.lit("UA "), F.col("s_name")).alias("campaign_name"),
        pick(NETWORKS, sk % 5).alias("network"),
        pick(OBJECTIVES, sk % 2).alias("objective"),
        pick(COUNTRIES, sk % 6).alias("country"),
        (F.abs(F.col("s_acctbal")) / 2).cast("decimal(18,4)").alias("daily_budget"),
        start.alias("start_date"),
        F.when(sk % 10 >= 7, F.date_add(start, (30 + sk % 31).cast("int"))).alias("end_date"),
    )


def creatives(ln: DataFrame) -> DataFrame:
    cnum = F.col("cnum")
    return (
        ln.groupBy("cnum", "l_suppkey")
        .agg(F.min("d").alias("first_day"))
        .select(
            creative_id(cnum).alias("creative_id"),
            campaign_id(F.col("l_suppkey")).alias("campaign_id"),
            F.concat(pick(FORMATS, cnum % 4), F.lit("_"), cnum.cast("string")).alias("creative_name"),
            pick(FORMATS, cnum % 4).alias("format"),
            pick(SIZES, cnum % 3).alias("size"),
            F.date_add("first_day", (cnum % 3).cast("int")).alias("launch_date"),
        )
    )


def ad_daily_stats(ln: DataFrame) -> DataFrame:
    q = F.col("l_quantity")
    return (
        ln.groupBy("d", "cnum", "l_suppkey")
        .agg(
            F.sum(q).alias("qty"),
            F.sum(q * (1 + F.round(F.col("l_discount") * 100))).alias("clk"),
            F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("price"),
            F.sum(F.col("l_linenumber") - 1).alias("inst"),
        )
        .select(
            F.col("d").alias("stat_date"),
            *source_columns(F.col("l_suppkey"), F.col("cnum")),
            (F.col("qty") * 100).cast("bigint").alias("impressions"),
            F.col("clk").cast("bigint").alias("clicks"),
            (F.col("price") * F.lit(Decimal("0.01"))).cast("decimal(18,4)").alias("spend_usd"),
            F.col("inst").cast("bigint").alias("installs"),
        )
    )


def line_id(prefix: str) -> Column:
    """prefix + orderkey + '_' + linenumber (not unique in the driver data)."""
    return F.concat(
        F.lit(prefix), F.col("l_orderkey").cast("string"), F.lit("_"),
        F.col("l_linenumber").cast("string"),
    )


def skan_postbacks(ln: DataFrame) -> DataFrame:
    sk = F.col("l_suppkey")
    privacy = None
    for flag, level in PRIVACY_BY_RETURNFLAG:
        cond = F.col("l_returnflag") == flag
        privacy = F.when(cond, level) if privacy is None else privacy.when(cond, level)
    return ln.select(
        line_id("pb_").alias("postback_id"),
        F.date_add("d", (F.col("l_orderkey") % 2).cast("int")).alias("install_date"),
        *source_columns(sk, F.col("cnum")),
        F.when(F.col("l_linestatus") == "O", "4.0").otherwise("3.0").alias("skan_version"),
        ((F.col("l_orderkey") + F.col("l_partkey")) % 64).cast("int").alias("conversion_value"),
        (1 + F.col("l_linenumber") % 3).cast("int").alias("postback_sequence"),
        privacy.alias("privacy_threshold"),
    )


def iap_events(ln: DataFrame) -> DataFrame:
    sk = F.col("l_suppkey")
    event_type = pick(EVENT_TYPES, F.col("l_linenumber") % 4)
    price = F.element_at(
        F.array(*[F.lit(Decimal(p)) for p in PRICES]), (F.col("l_partkey") % 5 + 1).cast("int")
    )
    revenue = F.when(event_type == "trial_start", F.lit(Decimal("0"))).otherwise(
        price * (1 + (sk % 8) * 5)
    )
    return ln.select(
        line_id("ev_").alias("event_id"),
        F.col("d").alias("install_date"),
        F.date_add("d", F.col("l_quantity").cast("int") % 40).alias("event_date"),
        *source_columns(sk, F.col("cnum")),
        event_type.alias("event_type"),
        pick(PRODUCTS, F.col("l_partkey") % 5).alias("product_id"),
        revenue.cast("decimal(18,4)").alias("revenue_usd"),
    )


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The five raw tables, lazily derived from the driver tables."""
    ln = lines(spark, sf_dir)
    return {
        "campaigns": campaigns(spark, sf_dir),
        "creatives": creatives(ln),
        "ad_daily_stats": ad_daily_stats(ln),
        "skan_postbacks": skan_postbacks(ln),
        "iap_events": iap_events(ln),
    }
