"""Incremental maintenance of the marts (the reference is batch-incremental;
it has no stream source, watermark or state store, so neither do we).

* burnout mart: re-process the last 15 dates of the target (max date - 14),
  delete those (creative_id, stat_date) keys from the target and insert the
  new rows. A table by month: a run reads and writes the months that its window touches, the
  others go into the new version as the files they are (``sources.tables``).
* cohort backfill: recompute the cohorts installed in the last 45 days and
  overwrite their partitions (dynamic partition overwrite of a table by install
  date); partitions of dates that the fresh result lacks are dropped.

The values pulled to the driver are the one-row max(stat_date) watermark and the
at most 46 install dates of a backfill.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from burnlens.functions import constants as K
from burnlens.operators.creative import creative_burnout
from burnlens.sources import tables

BURNOUT_KEYS = ("creative_id", "stat_date")
BURNOUT_LAYOUT = tables.Layout(month_of="stat_date", sort=BURNOUT_KEYS)
COHORT_LAYOUT = tables.Layout(by="install_date", sort=("network", "country"))


def reprocess_since(target: DataFrame | None, days: int = K.REPROCESS_DAYS,
                    date_col: str = "stat_date") -> dt.date | None:
    """max(date) of the target minus ``days``; None for an absent or empty
    target (which then means: full refresh)."""
    if target is None:
        return None
    latest = target.agg(F.max(date_col).alias("m")).first()["m"]
    return None if latest is None else latest - dt.timedelta(days=days)


def inc_window_filter(metrics: DataFrame, since: dt.date | None) -> DataFrame:
    """The rows an incremental run re-processes."""
    rows = metrics.where(F.col("impressions") >= K.MIN_IMPRESSIONS_FOR_BURNOUT)
    return rows if since is None else rows.where(F.col("stat_date") >= F.lit(since))


def delete_insert(target: DataFrame, batch: DataFrame, keys=BURNOUT_KEYS,
                  since: dt.date | None = None, date_col: str = "stat_date") -> DataFrame:
    """Target minus the batch's keys, plus the batch (delete+insert upsert).

    With ``since`` (all batch rows have date >= since) only target rows from
    that date on are anti-joined; the rest is a pass-through.
    """
    keys = list(keys)
    batch_keys = batch.select(*keys)
    if since is None:
        kept = target.join(batch_keys, keys, "left_anti")
    else:
        recent = F.col(date_col) >= F.lit(since)
        kept = target.where(~recent).unionByName(
            target.where(recent).join(batch_keys, keys, "left_anti"))
    return kept.unionByName(batch.select(*target.columns))


def replace_since(rows: DataFrame, target: str, out: str, since: dt.date, layout: tables.Layout, date_col: str) -> tables.Staged:
    """The next version of ``target`` (a table by month, staged under the name ``out``): its
    rows before ``since``, then ``rows``. Months before ``since``'s are shared, not read."""
    spark = rows.sparkSession
    first = since.replace(day=1)
    old = tables.read(spark, target, first, date_col).where(F.col(date_col) < F.lit(since))
    return tables.stage(old.select(*rows.columns).unionByName(rows), out, layout, tables.months_before(spark, target, since))


def stage_upsert(batch: DataFrame, target: str, out: str, since: dt.date) -> tables.Staged:
    """The next version of the burnout mart: ``batch`` (all dated from ``since``) in the place of its keys."""
    spark = batch.sparkSession
    recent = tables.read(spark, target, since.replace(day=1), "stat_date")
    return tables.stage(delete_insert(recent, batch, since=since), out, BURNOUT_LAYOUT, tables.months_before(spark, target, since))


def watermark(spark: SparkSession, target: str | None) -> dt.date | None:
    """First date that the next run re-processes; None means full refresh."""
    if not target or not tables.exists(spark, target):
        return None
    latest = tables.latest(spark, tables.version(spark, target), "stat_date")
    return None if latest is None else latest - dt.timedelta(days=K.REPROCESS_DAYS)


def incremental_burnout(spark: SparkSession, metrics: DataFrame, target: str | None,
                        out: str, compat_window: bool = False) -> str:
    """One incremental run of the burnout mart from its whole metrics: a new
    version of ``out`` (which may be the target itself). Months before the window
    are not read but for the watermark, and not written. (The daily job continues
    the metrics from a state instead: ``plans.refresh``.)"""
    since = watermark(spark, target)
    if since is None:
        return full_refresh(creative_burnout(metrics), out)
    # Written first: the upsert reads it for its keys and for its rows.
    batch = tables.stage(creative_burnout(metrics, since=since, compat_window=compat_window), f"{out}_batch")
    try:
        tables.publish(spark, stage_upsert(tables.read_staged(spark, batch), target, out, since))
    finally:
        tables.discard(spark, batch)
    return out


def full_refresh(df: DataFrame, out: str) -> str:
    """The whole burnout mart as a new version."""
    tables.replace(df, out, BURNOUT_LAYOUT)
    return out


def backfill_since(as_of: dt.date, days: int = K.BACKFILL_DAYS) -> dt.date:
    return as_of - dt.timedelta(days=days)


def write_by_install_date(df: DataFrame, name: str) -> None:
    """The whole cohort mart as a new version, a partition for each install date."""
    tables.replace(df, name, COHORT_LAYOUT)


def backfill_cohorts(fresh: DataFrame, target: str, as_of: dt.date, days: int = K.BACKFILL_DAYS) -> None:
    """Replace the rows of the last ``days`` days with ``fresh``'s, in the
    published version: INSERT OVERWRITE of the partitions that ``fresh`` has, then
    DROP PARTITION of the window's other dates. Earlier dates stay as they are."""
    spark = fresh.sparkSession
    since = backfill_since(as_of, days)
    held = tables.version(spark, target)
    seen = Observation("backfill")
    rows = tables.rebalance(fresh.where(F.col("install_date") >= F.lit(since)).select(*spark.table(held).columns), "install_date")
    rows = rows.sortWithinPartitions("install_date", *COHORT_LAYOUT.sort).observe(seen, F.collect_set("install_date").alias("dates"))
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        rows.write.insertInto(held, overwrite=True)
    finally:
        spark.conf.set(mode, before)
    new = {d.isoformat() for d in seen.get["dates"]}
    gone = [d for d in tables.partitions(spark, held) if d[:1].isdigit() and d >= since.isoformat() and d not in new]
    if gone:
        spark.sql(f"ALTER TABLE {held} DROP IF EXISTS " + ", ".join(f"PARTITION (install_date='{d}')" for d in gone))
