"""Appending to the loaded fact tables, with uniqueness checked at the cost of
the new rows.

``append_facts`` puts new rows in the place of all rows dated from ``since`` on.
Months before ``since``'s stay the files they are; their keys are known by their Bloom filters
(``operators.key_filter``), kept in ``<table>_keys`` by month. The keys that
occur more than once in the whole table are kept in ``<table>_repeated``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from burnlens.operators import key_filter
from burnlens.operators.quality import unique_name
from burnlens.sources import files, tables
from burnlens.sources.schemas import MONTH_PARTITION
from burnlens.streaming.incremental import replace_since

KEYS = {"skan_postbacks": "postback_id", "iap_events": "event_id"}
FILTER_LAYOUT = tables.Layout(by=tables.MONTH, sort=("bucket",))


def _keyed(rows: DataFrame, table: str) -> DataFrame:
    """(part, key) of raw rows."""
    month = F.coalesce(files.month_key(MONTH_PARTITION[table]), F.lit(tables.NO_MONTH))
    return rows.select(month.alias("part"), F.col(KEYS[table]).alias("key"))


def _filters(keyed: DataFrame, buckets: int) -> DataFrame:
    return key_filter.build(keyed, buckets).withColumnRenamed("part", tables.MONTH).withColumn("buckets", F.lit(buckets).cast("long"))


def index_keys(spark: SparkSession, database: str, table: str) -> None:
    """Filters and repeated keys of a table that was loaded whole."""
    keyed = _keyed(files.read_raw_table(spark, database, table), table)
    buckets = key_filter.bucket_count(keyed.count())
    name = f"{database}.{table}"
    staged = [tables.stage(_filters(keyed, buckets), f"{name}_keys", FILTER_LAYOUT),
              tables.stage(key_filter.counted(keyed).where("n > 1"), f"{name}_repeated")]
    for s in staged:
        tables.publish(spark, s)


def append_facts(rows: DataFrame, database: str, table: str, since: dt.date) -> None:
    """The next version of a loaded fact table: its rows before ``since``, then
    ``rows`` (raw columns, all dated from ``since`` on). Rows without a date
    stay. Filters of the months from ``since``'s on are built again; when the table has outgrown them
    (fewer than half the bits a key that they were made for), so are all."""
    spark, name, first = rows.sparkSession, f"{database}.{table}", since.replace(day=1)
    date_col, month = MONTH_PARTITION[table], since.strftime("%Y%m")
    staged = [replace_since(files.with_loaded_at(rows), name, name, since, files.raw_layout(table), date_col)]
    try:
        undated = tables.NO_MONTH in tables.partitions(spark, tables.version(spark, name))
        if undated:
            spark.sql(f"ALTER TABLE {staged[0].version} ADD IF NOT EXISTS PARTITION (`{tables.MONTH}`='{tables.NO_MONTH}') "
                      f"LOCATION '{tables.folder(spark, tables.version(spark, name), tables.NO_MONTH)}'")
        new = _keyed(tables.read_staged(spark, staged[0], first, date_col), table)
        held = F.col(tables.MONTH) < month
        if undated:
            held = held | (F.col(tables.MONTH) == tables.NO_MONTH)
        kept = spark.table(name).where(held).select(F.col(KEYS[table]).alias("key"))
        known = spark.table(f"{name}_keys").where(held)
        buckets = spark.table(f"{name}_keys").agg(F.max("buckets").alias("n")).first()["n"] or 1
        found = key_filter.repeated(new.select("key"), kept, known, tables.read(spark, f"{name}_repeated"), buckets)
        staged.append(tables.stage(found, f"{name}_repeated"))
        total = spark.table(staged[0].version).count()
        if key_filter.bucket_count(total) > 2 * buckets:
            whole = _keyed(spark.table(staged[0].version), table)
            staged.append(tables.stage(_filters(whole, key_filter.bucket_count(total)), f"{name}_keys", FILTER_LAYOUT))
        else:
            keep = {m: tables.folder(spark, tables.version(spark, f"{name}_keys"), m)
                    for m in tables.partitions(spark, tables.version(spark, f"{name}_keys")) if m < month or m == tables.NO_MONTH}
            staged.append(tables.stage(_filters(new, buckets), f"{name}_keys", FILTER_LAYOUT, keep))
    except BaseException:
        for s in staged:
            tables.discard(spark, s)
        raise
    for s in staged:
        tables.publish(spark, s)


def unique_failures(spark: SparkSession, database: str) -> DataFrame:
    """Offending rows of the uniqueness tests of the fact tables (test_name,
    failing_key, n_rows), as the last load or append found them."""
    out = None
    for t, c in KEYS.items():
        part = tables.read(spark, f"{database}.{t}_repeated").select(
            F.lit(unique_name(t, c)).alias("test_name"), F.col("key").alias("failing_key"), F.col("n").alias("n_rows"))
        out = part if out is None else out.unionByName(part)
    return out
