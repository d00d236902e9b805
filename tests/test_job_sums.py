"""Sums of money, and what a job reads."""

from pyspark.sql import functions as F

from burnlens import registry
from burnlens.functions import columns
from burnlens.plans import refresh
from burnlens.sources import tables


def test_sums_of_money_by_units_equal_the_decimals(spark):
    """With NULLs, NaN, more decimals than money has, ties, negative and very large values."""
    values = [None, float("nan"), -0.0, 0.1, 0.00005, 1.00015, -1.23455, 2.5, 999999.9999, 1e6, -3.0001, 12345678901234.5678, 99999999999999.0, -99999999999999.0]
    rows = [(i, v) for i, v in enumerate(values)] + [(100 + i, v) for i in range(40) for v in values[i % 14:i % 14 + 5]] + [(200, 99999999999999.0)] * 5000
    df = spark.createDataFrame(rows, "k int, v double").groupBy("k").agg(
        F.sum(F.col("v").cast("decimal(18,4)")).cast("double").alias("want"), columns.dsum("v").alias("got"),
        (F.sum(F.col("v").cast("decimal(18,4)")).cast("double") / F.count("v")).alias("want_avg"), columns.exact_avg("v", 4).alias("got_avg"))
    assert df.count() == 55 and df.where("NOT (want <=> got) OR NOT (want_avg <=> got_avg)").isEmpty()


def test_a_job_reads_the_revenue_events_once(spark, monkeypatch):
    """The marts by cohort and campaign read the days of the cohort revenue model that the job has written."""
    plans = {}
    write = refresh.Run.write

    def noted(self, name, df):
        plans[name] = df.inputFiles()
        return write(self, name, df)

    monkeypatch.setattr(refresh.Run, "write", noted)
    models = registry.M(spark, "/root/testdata/sf0.001")
    refresh.refresh_daily(spark, models, tables.scratch_database(spark, "once"), on_failure="publish")
    read = {n: any("lineitem" in f for f in plans[n]) for n in ("int_cohort_revenue", "mart_cohort_analysis", "mart_unit_economics")}
    assert read == {"int_cohort_revenue": True, "mart_cohort_analysis": False, "mart_unit_economics": False}
