"""The scheduled jobs as one Spark program each.

``refresh_daily``: staging (lazy views), then every intermediate and mart
materialised in dependency order, then the data tests. ``refresh_weekly``:
the cohort models, the cohort marts and the burnout mart, then the tests.

Each materialised model is written as a new version of its catalogue table, and
the models downstream of it read the written version: the lineage is cut at
every layer, so a lost executor recomputes one layer, not the whole graph. The
daily metrics are bucketed by creative_id, so the three models that
read them (peaks, burnout events, burnout mart) run without a shuffle. The ad rows
are summed by cohort key once for the cohort, campaign and SKAN models; that table and the
SKAN mapping are bucketed by the five keys, so their full outer join runs without one too.

A daily run after another one is incremental for the creative models: it reads the
state of each creative (``operators.creative_state``) as it was 14 days before
the last date, and the ad rows since then, and writes only the months that these
touch. Without a state, or when a creative's launch date changed, it is a full run.

The ad rows and the creatives are written first, both by creative_id (``BY_CREATIVE``): the source's
aggregates run once a job, and neither the daily metrics nor the sums by cohort key shuffle the ad rows again.
Revenue events are read once too, for the cohort revenue model; the marts add up its days.

The versions are published only after the data tests: with ``on_failure="raise"``
a failed test leaves every table as it was. Runs are repeatable; the caller's
Models are not changed.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from burnlens.functions import constants as K
from burnlens.operators import cohort, creative_state, quality, skan, staging
from burnlens.plans.models import RAW_TABLES, Models, load_raw, load_tests
from burnlens.sources import files, tables
from burnlens.streaming import incremental as inc

# How each materialised model is stored. The daily metrics are bucketed by the key
# that all their readers group, window or join on, and cut by month for incremental runs; marts
# are in the order of their reports, so date filters skip files and row groups.
LAYOUTS = {
    "int_creative_daily_metrics": tables.Layout(month_of="stat_date", sort=("creative_id", "stat_date"), bucket=("creative_id", 16)),
    # Both sides of the reconciliation, by its five keys: the full outer join reads them as they are.
    "cohort_ads": tables.Layout(month_of="stat_date", bucket=(("stat_date", *skan.SKAN_KEYS[1:]), 16)),
    "int_skan_cv_mapping": tables.Layout(month_of="install_date", bucket=(tuple(skan.SKAN_KEYS), 16)),
    "mart_creative_burnout": dataclasses.replace(inc.BURNOUT_LAYOUT, dealt=True),  # rows come by creative
    "mart_campaign_performance": tables.Layout(month_of="stat_date", sort=("stat_date", "spend_usd"), dealt=True),  # by campaign
    "mart_skan_attribution": tables.Layout(month_of="install_date", sort=("install_date", "spend_usd"), dealt=True),  # by the five keys
    "mart_cohort_analysis": inc.COHORT_LAYOUT,
    "mart_unit_economics": tables.Layout(sort=("campaign_roas",)),
}
#: The raw tables that several models read by creative, as a job writes them first.
BY_CREATIVE = {"ad_daily_stats": "ads_by_creative", "creatives": "creatives_by_id"}
LAYOUTS |= {
    "ads_by_creative": tables.Layout(month_of="stat_date", bucket=("creative_id", 16)),
    "creatives_by_id": tables.Layout(bucket=("creative_id", 16)),
}
#: The state that the next run continues, and the first date that isn't in it.
STATE = "creative_state"
#: Ad sums by cohort key, and the models that read them instead of the ad rows.
COHORT_ADS = "cohort_ads"
COHORT_MODELS = ("int_cohort_installs", "int_cohort_revenue", "mart_campaign_performance", "mart_cohort_analysis",
                 "mart_unit_economics", "mart_skan_attribution")
CREATIVE_MODELS = ("int_creative_daily_metrics", "int_creative_peaks", "int_burnout_events", "mart_creative_burnout")


class DataTestFailure(RuntimeError):
    """Data tests failed; nothing was published."""


DAILY = (
    "int_creative_daily_metrics", "int_creative_peaks", "int_burnout_events",
    "int_cohort_installs", "int_cohort_revenue", "int_skan_cv_mapping",
    "mart_creative_burnout", "mart_campaign_performance", "mart_cohort_analysis",
    "mart_unit_economics", "mart_skan_attribution",
)
WEEKLY = (
    "int_cohort_installs", "int_cohort_revenue", "mart_cohort_analysis",
    "mart_unit_economics", "int_creative_daily_metrics", "mart_creative_burnout",
)


class Run:
    """Versions that a job has written, its models over them, and the seconds
    that each took."""

    def __init__(self, spark: SparkSession, models: Models, database: str, buckets: int | None = None):
        self.spark, self.database, self.buckets = spark, database, buckets
        self.models = Models(models.raw, models.as_of, models.denominator)
        self.models.database = models.database
        self.staged: dict[str, tables.Staged] = {}
        self.seconds: dict[str, float] = {}

    def layout(self, name: str) -> tables.Layout:
        found = LAYOUTS.get(name, tables.Layout())
        if self.buckets and found.bucket:
            found = dataclasses.replace(found, bucket=(found.bucket[0], self.buckets))
        return found

    def add(self, name: str, write) -> DataFrame:
        """Stage a table by ``write()`` and return its rows; downstream models read them."""
        start = time.perf_counter()
        self.staged[name] = write()
        self.seconds[name] = time.perf_counter() - start
        out = tables.read_staged(self.spark, self.staged[name])
        self.models.__dict__[name] = out
        return out

    def write(self, name: str, df: DataFrame) -> DataFrame:
        return self.add(name, lambda: tables.stage(df, f"{self.database}.{name}", self.layout(name)))

    def stage_raw(self) -> None:
        """Write the raw tables of BY_CREATIVE; the run's models read them from there."""
        raw, database = dict(self.models.raw), self.models.database
        for table, name in BY_CREATIVE.items():
            raw[table] = self.write(name, raw[table])
        self.models = Models(raw, self.models.as_of, self.models.denominator)
        self.models.database = database

    def deal_facts(self) -> None:
        """Postbacks and revenue events are dealt out once, by the keys that their models are stored or
        windowed by: what their sums are grouped by includes these, so the sums aren't dealt again. (A cohort's
        rows meet in one task, which adds them up as they come.)"""
        raw, m = self.models.raw, self.models.__dict__
        n = self.layout("int_skan_cv_mapping").bucket[1]
        m["int_skan_cv_mapping"] = skan.cv_mapping(staging.stg_skan_postbacks(raw["skan_postbacks"].repartition(n, *skan.SKAN_KEYS)))
        m["int_daily_revenue"] = cohort.daily_revenue(staging.stg_iap_events(raw["iap_events"].repartition(*cohort.COHORT)))

    def discard(self) -> None:
        for s in self.staged.values():
            tables.discard(self.spark, s)

    def publish(self) -> None:
        for s in self.staged.values():
            tables.publish(self.spark, s)


# ------------------------------------------------------------ creative models
def continued_from(spark: SparkSession, models: Models, previous: str | None) -> tuple[DataFrame, dt.date] | None:
    """The previous run's state and the first date after it; None when there is
    none to continue (then the run is a full one)."""
    if previous is None or not all(tables.exists(spark, f"{previous}.{n}") for n in (STATE, *CREATIVE_MODELS)):
        return None
    state = tables.read(spark, f"{previous}.{STATE}")
    before = state.agg(F.max("before").alias("d")).first()["d"]
    state = state.drop("before")
    if before is None or not creative_state.relaunched(state, models.stg_creatives).isEmpty():
        return None
    return state, before


def _save_state(run: Run, state: DataFrame, metrics: DataFrame, before: dt.date | None) -> None:
    """The state for the next run: as of ``before``, the first date it will re-process."""
    latest = tables.latest(run.spark, run.staged["mart_creative_burnout"].version, "stat_date")
    upto = creative_state.next_before(latest, before)
    if upto is not None:
        kept = creative_state.merged(state, metrics.where(F.col("stat_date") < F.lit(upto)))
        run.write(STATE, kept.withColumn("before", F.lit(upto)))


def creative_models(run: Run, names, previous: str | None) -> None:
    """The daily metrics, peaks, burnout events and burnout mart; from the
    previous run's state where there is one."""
    spark, models, db = run.spark, run.models, run.database
    held = continued_from(spark, models, previous)
    if held is None:
        metrics = run.write("int_creative_daily_metrics", models.int_creative_daily_metrics)
        for name in ("int_creative_peaks", "int_burnout_events", "mart_creative_burnout"):
            if name in names:
                run.write(name, getattr(models, name))
        _save_state(run, creative_state.empty(spark), metrics, None)
        return
    state, since = held
    fresh = creative_state.window_metrics(state, models.ads_since(since), models.stg_creatives, models.stg_campaigns)
    name = "int_creative_daily_metrics"
    run.add(name, lambda: inc.replace_since(fresh, f"{previous}.{name}", f"{db}.{name}", since, run.layout(name), "stat_date"))
    window = tables.read_staged(spark, run.staged[name], since, "stat_date")
    now = run.write("creative_state_now", creative_state.merged(state, window))
    if "int_creative_peaks" in names:
        run.write("int_creative_peaks", creative_state.peaks(now))
    if "int_burnout_events" in names:
        run.write("int_burnout_events", creative_state.burnout_events(now))
    mart = "mart_creative_burnout"
    run.add(mart, lambda: inc.stage_upsert(creative_state.burnout(now, window), f"{previous}.{mart}", f"{db}.{mart}", since))
    _save_state(run, state, window, since)


# ------------------------------------------------------------ jobs
def materialise(spark: SparkSession, models: Models, names, database: str,
                previous: str | None = None, buckets: int | None = None) -> Run:
    """Write each model in order, downstream models reading the written
    versions, none of them published. ``previous``: the database of the previous
    run (which may be ``database``), from which the creative models go on."""
    run = Run(spark, models, database, buckets)
    try:
        run.stage_raw()
        run.deal_facts()
        if any(n in CREATIVE_MODELS for n in names):
            creative_models(run, names, previous)
        if any(n in COHORT_MODELS for n in names):
            run.models.__dict__["ad_rows"] = run.write(COHORT_ADS, cohort.cohort_ads(run.models.stg_ad_stats)).drop("has_installs")
        for name in names:
            if name not in CREATIVE_MODELS:
                written = run.write(name, getattr(run.models, name))
                if name == "int_cohort_revenue":  # the marts by cohort and campaign add up its days, not the events again
                    run.models.__dict__["revenue_events"] = cohort.revenue_days(written)
    except BaseException:
        run.discard()
        raise
    return run


def _run(spark: SparkSession, models: Models, names, database: str,
         previous: str | None = None, on_failure: str = "raise") -> DataFrame:
    if on_failure not in ("raise", "publish"):
        raise ValueError(f"unknown policy {on_failure!r}")
    run = materialise(spark, models, names, database, previous)
    try:
        tests = quality.dq_summary(run.models.raw, run.models.mart_creative_burnout, run.models.stg_ad_stats, load_tests(spark, models.database))
        results = run.write("dq_summary", tests)
        if on_failure == "raise":
            failed = [r["test_name"] for r in results.where(F.col("status") == "FAIL").collect()]  # of 25
            if failed:
                raise DataTestFailure(", ".join(sorted(failed)))
    except BaseException:
        run.discard()
        raise
    run.publish()
    took = spark.createDataFrame([(n, round(s, 3)) for n, s in run.seconds.items()], "model string, seconds double").coalesce(1)
    tables.replace(took, f"{database}.run_seconds")
    counts = [
        tables.read(spark, f"{database}.{n}").agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("model"), "row_count")
        for n in names
    ]
    counts.append(tables.read(spark, f"{database}.dq_summary").agg(F.count_if(F.col("status") == "FAIL").alias("row_count"))
                  .select(F.lit("dq_failed_tests").alias("model"), "row_count"))
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


def refresh_daily(spark: SparkSession, models: Models, database: str,
                  previous: str | None = None, on_failure: str = "raise") -> DataFrame:
    """Run summary: (model, row_count) per model, plus failed tests.
    ``previous``: the previous run's database, to go on from.
    ``on_failure``: "raise" publishes nothing when a data test fails, "publish"
    reports the failures only."""
    return _run(spark, models, DAILY, database, previous, on_failure)


def refresh_weekly(spark: SparkSession, models: Models, database: str, on_failure: str = "raise") -> DataFrame:
    """Full rebuild of the cohort and creative models."""
    return _run(spark, models, WEEKLY, database, on_failure=on_failure)


def databases(spark: SparkSession, prefix: str, location: str | None = None) -> tuple[str, str]:
    """The databases of the raw tables and of the models, created if need be."""
    return tuple(tables.create_database(spark, f"{prefix}_{x}", f"{location}/{x}" if location else None) for x in ("raw", "models"))


MAX_BAD_SHARE = 0.01


def load_csv(spark: SparkSession, csv_root: str, database: str, max_bad_share: float = MAX_BAD_SHARE) -> DataFrame:
    """Load the five raw tables from their CSV files (``csv_root``/<table>).
    Lines that aren't rows of their table go to ``rejected_lines`` (table_name, file, line); a
    table with more than ``max_bad_share`` of them refuses the load, and the lines can be looked at.
    Returns (table_name, row_count, rejected) as the load counted them."""
    bad = None
    for t in RAW_TABLES:
        part = files.rejected_lines(spark, f"{csv_root}/{t}", t)
        bad = part if bad is None else bad.unionByName(part)
    tables.replace(bad, f"{database}.rejected_lines")
    rejected = {r["table_name"]: r["n"] for r in tables.read(spark, f"{database}.rejected_lines")
                .groupBy("table_name").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a table
    load_raw({t: files.read_raw_csv(spark, f"{csv_root}/{t}", t) for t in RAW_TABLES}, database, rejected, max_bad_share)
    rows = load_tests(spark, database)
    return spark.createDataFrame([(t, rows[f"rows_{t}"], rows[f"rejected_{t}"]) for t in RAW_TABLES], "table_name string, row_count long, rejected long")


def run_daily(spark: SparkSession, csv_root: str, prefix: str, as_of: dt.date | None = None, on_failure: str = "raise",
              location: str | None = None, max_bad_share: float = MAX_BAD_SHARE) -> tuple[DataFrame, DataFrame]:
    """The whole daily job: load, staging, intermediate models, marts, tests.
    Returns the loaded row counts and the run summary."""
    raw, out = databases(spark, prefix, location)
    loaded = load_csv(spark, csv_root, raw, max_bad_share)
    return loaded, refresh_daily(spark, Models.from_tables(spark, raw, as_of=as_of), out, out, on_failure)


def run_weekly(spark: SparkSession, prefix: str, as_of: dt.date | None = None, on_failure: str = "raise", location: str | None = None) -> DataFrame:
    """The weekly job over the tables that the daily job loaded."""
    raw, out = databases(spark, prefix, location)
    return refresh_weekly(spark, Models.from_tables(spark, raw, as_of=as_of), out, on_failure)


def run_backfill(spark: SparkSession, prefix: str, as_of: dt.date, days: int = K.BACKFILL_DAYS, location: str | None = None) -> DataFrame:
    """The weekly cohort window over loaded tables: returns (model, row_count)
    of the cohort mart."""
    raw, out = databases(spark, prefix, location)
    backfill_weekly(spark, raw, f"{out}.mart_cohort_analysis", as_of, days)
    return (tables.read(spark, f"{out}.mart_cohort_analysis").agg(F.count(F.lit(1)).alias("row_count"))
            .select(F.lit("mart_cohort_analysis").alias("model"), "row_count"))


def backfill_weekly(spark: SparkSession, raw_database: str, target: str, as_of: dt.date, days: int = K.BACKFILL_DAYS) -> None:
    """Weekly cohort backfill from the loaded raw tables: recompute only the
    cohorts installed in the last ``days`` days, reading only those months,
    and replace their install_date partitions in the target."""
    recent = Models.from_tables(spark, raw_database, since=inc.backfill_since(as_of, days), as_of=as_of)
    inc.backfill_cohorts(recent.mart_cohort_analysis, target, as_of, days)


def export_marts(spark: SparkSession, models: Models, out_root: str,
                 fmt: str = "csv") -> dict[str, str]:
    """The BI read path: every mart with the BI column-type contract, NaN/Inf
    turned into NULL, written as CSV with header (or JSON lines) under
    ``out_root``. Returns mart name -> path."""
    writer = {"csv": files.export_csv, "json": files.export_json}[fmt]
    paths = {}
    for name in Models.MARTS:
        path = f"{out_root}/{name}"
        writer(files.bi_types(getattr(models, name)), path)
        paths[name] = path
    return paths
