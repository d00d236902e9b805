"""The model graph as plain Python: each property is one model of the
three layers (staging, intermediate, marts), built lazily from the five raw
tables. Nothing is executed until a caller runs an action or writes."""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from burnlens.operators import campaign, cohort, creative, quality, skan, staging
from burnlens.sources import adapter, files, tables

RAW_TABLES = ("campaigns", "creatives", "ad_daily_stats", "skan_postbacks", "iap_events")

# The evaluation date of the test tables (the ad window ends 2024-12-31).
DEFAULT_AS_OF = dt.date(2024, 12, 31)


class Models:
    """``as_of``: the evaluation date (None: the current date)."""

    def __init__(self, raw: dict[str, DataFrame], as_of: dt.date | None = None,
                 denominator: str = "total"):
        self.raw = raw
        self.as_of = as_of
        self.denominator = denominator
        self.database: str | None = None  # where the raw tables were loaded

    @classmethod
    def from_testdata(cls, spark: SparkSession, sf_dir: str, as_of: dt.date = DEFAULT_AS_OF, **kw) -> "Models":
        return cls(adapter.raw_tables(spark, sf_dir), as_of=as_of, **kw)

    @classmethod
    def from_tables(cls, spark: SparkSession, database: str, since: dt.date | None = None, **kw) -> "Models":
        """Raw tables as loaded by ``load_raw`` into ``database``. ``since``
        restricts the facts to rows dated on or after it (partition pruning);
        only models keyed by that date are then complete."""
        out = cls({t: files.read_raw_table(spark, database, t, since) for t in RAW_TABLES}, **kw)
        out.database = database
        return out

    def ads_since(self, since: dt.date) -> DataFrame:
        """Staged ad rows dated on or after ``since``; of loaded tables only those months are read."""
        raw = self.raw["ad_daily_stats"]
        if self.database is not None:
            raw = files.read_raw_table(raw.sparkSession, self.database, "ad_daily_stats", since)
        return staging.stg_ad_stats(raw.where(F.col("stat_date") >= F.lit(since)))

    # ------------------------------------------------------------- staging
    @cached_property
    def stg_campaigns(self) -> DataFrame:
        return staging.stg_campaigns(self.raw["campaigns"], self.as_of)

    @cached_property
    def stg_creatives(self) -> DataFrame:
        return staging.stg_creatives(self.raw["creatives"])

    @cached_property
    def stg_ad_stats(self) -> DataFrame:
        return staging.stg_ad_stats(self.raw["ad_daily_stats"])

    @cached_property
    def stg_skan_postbacks(self) -> DataFrame:
        return staging.stg_skan_postbacks(self.raw["skan_postbacks"])

    @cached_property
    def stg_iap_events(self) -> DataFrame:
        return staging.stg_iap_events(self.raw["iap_events"])

    @cached_property
    def ad_rows(self) -> DataFrame:
        """What the cohort, campaign and SKAN models sum: the staged ad rows. A job
        puts their sums by cohort key here (``cohort.cohort_ads``), written once for all of them."""
        return self.stg_ad_stats

    # -------------------------------------------------------- intermediate
    @cached_property
    def int_creative_daily_metrics(self) -> DataFrame:
        return creative.daily_metrics(self.stg_ad_stats, self.stg_creatives, self.stg_campaigns)

    @cached_property
    def int_creative_peaks(self) -> DataFrame:
        return creative.peaks(self.int_creative_daily_metrics)

    @cached_property
    def int_burnout_events(self) -> DataFrame:
        return creative.burnout_events(self.int_creative_daily_metrics, self.int_creative_peaks)

    @cached_property
    def int_cohort_installs(self) -> DataFrame:
        return cohort.cohort_installs(self.ad_rows, self.stg_creatives, self.stg_campaigns)

    @cached_property
    def int_daily_revenue(self) -> DataFrame:
        return cohort.daily_revenue(self.stg_iap_events)

    @cached_property
    def revenue_events(self) -> DataFrame:
        return cohort.revenue_events(self.stg_iap_events)

    @cached_property
    def int_cohort_revenue(self) -> DataFrame:
        return cohort.cohort_revenue(self.int_daily_revenue, self.int_cohort_installs)

    @cached_property
    def int_skan_cv_mapping(self) -> DataFrame:
        return skan.cv_mapping(self.stg_skan_postbacks)

    # --------------------------------------------------------------- marts
    @cached_property
    def mart_creative_burnout(self) -> DataFrame:
        return creative.creative_burnout(self.int_creative_daily_metrics)

    @cached_property
    def mart_campaign_performance(self) -> DataFrame:
        return campaign.campaign_performance(self.ad_rows, self.stg_campaigns)

    @cached_property
    def mart_cohort_analysis(self) -> DataFrame:
        # Only revenue sums are read from the cohort revenue model, so they
        # are aggregated from the revenue events directly: no join back to
        # installs and no intermediate cohort-day shuffle.
        return cohort.cohort_analysis(self.int_cohort_installs, self.revenue_events)

    @cached_property
    def mart_unit_economics(self) -> DataFrame:
        # The "first_cohort" denominator needs cohort installs on each revenue
        # row; the default only needs revenue sums (see mart_cohort_analysis).
        # Campaign totals of installs and spend are summed from the ad rows
        # directly (same decimal totals as summing the cohorts, one shuffle
        # fewer).
        revenue = (self.int_cohort_revenue if self.denominator == "first_cohort"
                   else self.revenue_events)
        installs = cohort.install_rows(self.ad_rows, self.stg_creatives, self.stg_campaigns)
        return cohort.unit_economics(
            installs, revenue, self.stg_campaigns, denominator=self.denominator,
        )

    @cached_property
    def mart_skan_attribution(self) -> DataFrame:
        return skan.skan_attribution(self.int_skan_cv_mapping, self.ad_rows, self.stg_campaigns)

    MARTS = (
        "mart_creative_burnout", "mart_campaign_performance", "mart_cohort_analysis",
        "mart_unit_economics", "mart_skan_attribution",
    )
    INTERMEDIATE = (
        "int_creative_daily_metrics", "int_creative_peaks", "int_burnout_events",
        "int_cohort_installs", "int_cohort_revenue", "int_skan_cv_mapping",
    )
    STAGING = (
        "stg_campaigns", "stg_creatives", "stg_ad_stats", "stg_skan_postbacks", "stg_iap_events",
    )


LOAD_TESTS = "load_tests"


def load_raw(raw: dict[str, DataFrame], database: str, rejected: dict[str, int] | None = None, max_bad_share: float = 0.0) -> None:
    """Ingest: write each raw table with its layout (month partitions for the
    facts, sort key within files) and the time of the load. Idempotent: every
    table is replaced by a new version, and all are published together at the
    end. The row tests are counted by the writing tasks (``load_tests``: table_name, test_name,
    n_rows), so the data tests need no scan for them. ``rejected``: lines of each
    table that weren't rows; a share above ``max_bad_share`` in any table refuses the whole load."""
    spark = raw[RAW_TABLES[0]].sparkSession
    staged, counted = [], []
    try:
        for t in RAW_TABLES:
            seen = Observation(f"load_{t}")
            staged.append(tables.stage(files.with_loaded_at(raw[t]), f"{database}.{t}", files.raw_layout(t),
                                       observe=(seen, quality.row_metrics(t))))
            counted += [(t, name, n) for name, n in seen.get.items()]
            bad, good = (rejected or {}).get(t, 0), seen.get[f"rows_{t}"]
            if bad > max_bad_share * (bad + good):
                raise files.TooManyBadLines(f"{t}: {bad} of {bad + good} lines are no rows of it")
            counted.append((t, f"rejected_{t}", bad))
        staged.append(tables.stage(spark.createDataFrame(counted, "table_name string, test_name string, n_rows long").coalesce(1),
                                   f"{database}.{LOAD_TESTS}"))
    except BaseException:
        for s in staged:
            tables.discard(spark, s)
        raise
    for s in staged:
        tables.publish(spark, s)


def load_tests(spark: SparkSession, database: str | None) -> dict[str, int] | None:
    """Rows that failed each row test of the last load; None if there was none."""
    if database is None or not tables.exists(spark, f"{database}.{LOAD_TESTS}"):
        return None
    return {r["test_name"]: r["n_rows"] for r in tables.read(spark, f"{database}.{LOAD_TESTS}").collect()}  # one row a test
