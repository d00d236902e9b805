"""Published tables, the jobs, grains of the dashboard queries, ingest by name."""

import datetime as dt
import threading
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from burnlens import jobs
from burnlens.operators import bi, cohort, quality
from burnlens.plans import refresh
from burnlens.plans.models import RAW_TABLES, Models, load_raw, load_tests
from burnlens.session import require_shared_folder, scratch_path
from burnlens.sources import files, tables
from burnlens.sources import schemas as S
from burnlens.streaming import incremental as inc

D0 = dt.date(2024, 10, 1)


def values(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def db(spark):
    return tables.scratch_database(spark, "tests")


# ------------------------------------------------------------------- writes
def test_a_failed_write_keeps_the_published_version(spark, db):
    name = f"{db}.t_failed"
    files.write_replace(spark.range(5), name)
    bad = spark.range(5).withColumn("id", F.when(F.col("id") == 3, F.raise_error(F.lit("no"))).otherwise(F.col("id")))
    entries = len(spark.catalog.listTables(db))
    with pytest.raises(Exception, match="no"):
        files.write_replace(bad.select(F.col("id").cast("long").alias("id")), name)
    assert len(spark.catalog.listTables(db)) == entries
    assert values(tables.read(spark, name)) == [(i,) for i in range(5)]
    files.write_replace(tables.read(spark, name).where("id < 2"), name)  # from itself
    assert values(tables.read(spark, name)) == [(0,), (1,)]


def test_readers_see_one_version_and_a_schema_may_change(spark, db):
    name = f"{db}.t_seen"
    files.write_replace(spark.range(3), name)
    planned = tables.read(spark, name)
    staged = tables.stage(spark.range(10).selectExpr("id", "'x' AS note"), name)
    assert tables.read(spark, name).count() == 3  # written, not published
    tables.publish(spark, staged)
    assert tables.read(spark, name).columns == ["id", "note"] and tables.read(spark, name).count() == 10
    assert planned.count() == 3  # the version that it was planned on
    assert spark.sql(f"SELECT count(note) AS n FROM {name}").first()["n"] == 10


def test_two_writers_do_not_mix(spark, db):
    """Both start from the same version by month; whoever publishes last has
    the whole table, and no reader ever sees rows of both."""
    name = f"{db}.t_writers"
    layout = tables.Layout(month_of="stat_date")
    rows = lambda who, days: spark.createDataFrame([(D0 + dt.timedelta(days=d), who) for d in days], "stat_date date, who string")
    tables.replace(rows("old", range(60)), name, layout)
    keep = tables.months_before(spark, name, dt.date(2024, 11, 1))
    first = tables.stage(rows("a", range(31, 60)), name, layout, keep)
    second = tables.stage(rows("b", range(31, 50)), name, layout, keep)
    tables.publish(spark, second)
    assert {r.who for r in tables.read(spark, name).collect()} == {"old", "b"}
    tables.publish(spark, first)
    assert sorted(r.who for r in tables.read(spark, name).collect()) == ["a"] * 29 + ["old"] * 31

    failed = []

    def write(who):
        try:
            tables.replace(rows(who, range(60)), name, layout)
        except Exception as e:  # noqa: BLE001
            failed.append(e)
    threads = [threading.Thread(target=write, args=(w,)) for w in "cdef"]
    [t.start() for t in threads]
    [t.join() for t in threads]
    got = [r.who for r in tables.read(spark, name).collect()]
    assert not failed and len(got) == 60 and len(set(got)) == 1


def test_old_entries_leave_the_catalogue(spark, db):
    name = f"{db}.t_many"
    for n in range(5):
        files.write_replace(spark.range(n), name)
    held = [t.name for t in spark.catalog.listTables(db) if t.name.startswith("t_many__")]
    assert len(held) == 2 and tables.read(spark, name).count() == 4


def test_no_table_and_empty_table(spark, db):
    assert not tables.exists(spark, f"{db}.t_none") and not tables.exists(spark, "no_such_database.t")
    with pytest.raises(tables.NoTable):
        tables.read(spark, f"{db}.t_none")
    with pytest.raises(ValueError, match="not a name"):
        tables.exists(spark, "a.b; DROP")
    empty = spark.createDataFrame([], "stat_date date, v int")
    tables.replace(empty, f"{db}.t_empty", tables.Layout(month_of="stat_date"))
    back = tables.read(spark, f"{db}.t_empty")
    assert back.count() == 0 and back.columns == ["stat_date", "v"]
    assert inc.watermark(spark, f"{db}.t_empty") is None and inc.watermark(spark, f"{db}.t_none") is None


def test_rows_without_a_date_are_kept(spark, db):
    rows = spark.createDataFrame([(None, 1), (D0, 2), (dt.date(2024, 12, 1), 3)], "stat_date date, v int")
    tables.replace(rows, f"{db}.t_null", tables.Layout(month_of="stat_date", sort=("v",)))
    assert values(tables.read(spark, f"{db}.t_null")) == values(rows)
    assert values(tables.read(spark, f"{db}.t_null", dt.date(2024, 11, 5), "stat_date")) == [(dt.date(2024, 12, 1), 3)]


def test_months_are_few_files_and_a_hot_month_is_split(spark, db):
    name = f"{db}.t_months"
    df = spark.range(0, 3000, 1, 16).select(F.date_add(F.lit(D0), (F.col("id") % 92).cast("int")).alias("stat_date"), "id")
    tables.replace(df, name, tables.Layout(month_of="stat_date", sort=("stat_date",)))
    back = tables.read(spark, name)
    assert values(back) == values(df) and tables.partitions(spark, tables.version(spark, name)) == ["202410", "202411", "202412"]
    assert back.select(F.input_file_name()).distinct().count() <= 6
    plan = tables.read(spark, name, dt.date(2024, 12, 5), "stat_date")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ym" in plan and "InMemoryFileIndex(1 paths)" in plan


def test_incremental_run_keeps_older_months_as_they_are(spark, models, db):
    name = f"{db}.t_inc"
    mart = models.mart_creative_burnout
    inc.full_refresh(mart.where(F.col("stat_date") <= F.lit(dt.date(2024, 12, 20))), name)
    after = dt.date(2025, 1, 1)
    before = tables.months_before(spark, name, after)
    inc.incremental_burnout(spark, models.int_creative_daily_metrics, name, name)
    now = tables.months_before(spark, name, after)
    assert now["202410"] == before["202410"] and now["202411"] == before["202411"] and now["202412"] != before["202412"]
    assert tables.read(spark, name).count() == mart.count()


def test_backfill_drops_dates_that_vanish(spark, db):
    days = [dt.date(2024, 10, 1), dt.date(2024, 11, 1), dt.date(2024, 11, 20), dt.date(2024, 12, 1), dt.date(2024, 12, 2)]
    name = f"{db}.t_vanish"
    schema = "install_date date, v int, network string, country string"
    inc.write_by_install_date(spark.createDataFrame([(d, 1, "n", "c") for d in days], schema), name)
    fresh = spark.createDataFrame([(days[0], 2, "n", "c"), (days[3], 2, "n", "c")], schema)
    held = tables.version(spark, name)
    inc.backfill_cohorts(fresh, name, dt.date(2024, 12, 31))  # window from 2024-11-16
    assert [r[:2] for r in values(tables.read(spark, name))] == [(days[0], 1), (days[1], 1), (days[3], 2)]
    assert tables.version(spark, name) == held and tables.partitions(spark, held) == ["2024-10-01", "2024-11-01", "2024-12-01"]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"
    inc.backfill_cohorts(fresh.where("false"), name, dt.date(2024, 12, 31))
    assert tables.partitions(spark, held) == ["2024-10-01", "2024-11-01"]


def test_marts_are_stored_in_the_order_of_their_reports(spark, models, db):
    """Files of one month hold ranges of the sort key, not a mixture."""
    for name in ("mart_campaign_performance", "mart_skan_attribution"):
        layout = refresh.LAYOUTS[name]
        tables.replace(getattr(models, name), f"{db}.{name}", layout)
        per_file = tables.read(spark, f"{db}.{name}").select(F.input_file_name().alias("f"), F.monotonically_increasing_id().alias("at"), layout.sort[0])
        got = {}
        for r in sorted(per_file.collect(), key=lambda r: r["at"]):
            got.setdefault(r["f"], []).append(r[layout.sort[0]])
        assert got and all(v == sorted(v) for v in got.values())


# --------------------------------------------------------------------- jobs
def test_refresh_twice_on_one_database(spark, models):
    out = tables.scratch_database(spark, "t_twice")
    held = dict(models.__dict__)
    first = values(refresh.refresh_daily(spark, models, out, on_failure="publish"))
    marts = {n: values(tables.read(spark, f"{out}.{n}")) for n in Models.MARTS}
    assert values(refresh.refresh_daily(spark, models, out, on_failure="publish")) == first
    assert {n: values(tables.read(spark, f"{out}.{n}")) for n in Models.MARTS} == marts
    assert models.__dict__.keys() >= held.keys() and all(models.__dict__[k] is v for k, v in held.items())
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("burnlens_")]
    took = {r.model: r.seconds for r in tables.read(spark, f"{out}.run_seconds").collect()}
    assert set(refresh.DAILY) <= set(took) and all(s > 0 for s in took.values())


def test_failed_tests_publish_nothing(spark, models):
    out = tables.scratch_database(spark, "t_policy")
    with pytest.raises(refresh.DataTestFailure, match="unique_iap_events_event_id"):
        refresh.refresh_weekly(spark, models, out)
    assert not spark.catalog.listTables(out)


def test_daily_script_from_csv(spark, models, capsys):
    csv = scratch_path(spark, "t_csv")
    key = {"skan_postbacks": "postback_id", "iap_events": "event_id"}
    for t in RAW_TABLES:
        df = models.raw[t].dropDuplicates([key[t]]) if t in key else models.raw[t]
        df.select(*df.columns[::-1], F.lit("x").alias("note")).write.option("header", True).csv(f"{csv}/{t}")
    where = ["--root", scratch_path(spark, "t_job"), "--name", "t_script", "--as-of", "2024-12-31"]
    args = ["daily", "--csv", csv, *where]
    assert jobs.main(args, spark) == 0
    said = capsys.readouterr().out
    n = models.raw["ad_daily_stats"].count()
    assert f"loaded ad_daily_stats: {n} rows" in said and "dq_failed_tests: 0" in said and "seconds mart_creative_burnout: " in said
    names = [n for n in Models.MARTS + Models.INTERMEDIATE]
    first = {n: values(tables.read(spark, f"t_script_models.{n}")) for n in names}
    assert first["mart_creative_burnout"] == values(models.mart_creative_burnout)
    assert jobs.main(args, spark) == 0  # the second run goes on from the first one's state
    assert {n: values(tables.read(spark, f"t_script_models.{n}")) for n in names} == first
    assert "loaded_at" in tables.read(spark, "t_script_raw.campaigns").columns
    assert jobs.main(["backfill", *where], spark) == 0
    assert values(tables.read(spark, "t_script_models.mart_cohort_analysis")) == first["mart_cohort_analysis"]
    assert jobs.main(["weekly", *where], spark) == 0


def test_run_date_defaults_to_today(spark, models):
    from burnlens.operators import staging
    rows = spark.createDataFrame([("c", "n", "Meta", "o", "US", Decimal("1"), D0, e) for e in (None, dt.date(2024, 12, 31), dt.date(2999, 1, 1))], S.CAMPAIGNS)
    assert sorted(r.is_active for r in staging.stg_campaigns(rows, Models({}).as_of).collect()) == sorted(
        r.is_active for r in staging.stg_campaigns(rows, dt.date.today()).collect())


def test_a_cluster_needs_a_shared_folder():
    require_shared_folder("local[4]")
    for master in ("yarn", "spark://host:7077", "k8s://host", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            require_shared_folder(master)


# ------------------------------------------------------------------- ingest
def test_row_tests_come_from_the_load(spark, models):
    """Equal to the scanning summary; no scan of a raw table but for the key tests."""
    raw = dict(models.raw)
    raw["campaigns"] = raw["campaigns"].withColumn("network", F.when(F.col("campaign_id") > F.lit("c"), F.lit("Myspace")).otherwise(F.col("network")))
    raw["campaigns"] = raw["campaigns"].withColumn("network", F.when(F.rand(1) < 0.2, None).otherwise(F.col("network")))
    raw["ad_daily_stats"] = raw["ad_daily_stats"].withColumn("spend_usd", F.when(F.pmod(F.hash("creative_id", "stat_date"), F.lit(50)) == 0, None).otherwise(F.col("spend_usd")))
    out = tables.scratch_database(spark, "t_load")
    load_raw(raw, out)
    m = Models.from_tables(spark, out, as_of=models.as_of)
    seen = load_tests(spark, out)
    assert {t: seen[f"rows_{t}"] for t in RAW_TABLES} == {r.table_name: r.row_count for r in files.load_row_counts(m.raw).collect()}
    told = quality.dq_summary(m.raw, m.mart_creative_burnout, m.stg_ad_stats, seen)
    assert values(told) == values(quality.dq_summary(m.raw, m.mart_creative_burnout, m.stg_ad_stats))
    assert {r.test_name for r in told.collect() if r.status == "FAIL"} >= {"not_null_campaigns_network", "accepted_values_campaigns_network", "not_null_ad_daily_stats_spend_usd"}
    # the key tests, the mart's score and the values of the one failed list: one column each
    tests = quality.dq_summary(m.raw, spark.range(1).select(F.lit(0.5).alias("burnout_score"), F.lit("k").alias("creative_id"), F.lit(D0).alias("stat_date")),
                               m.stg_ad_stats, seen)._jdf.queryExecution().executedPlan().toString()
    read = [line.split("ReadSchema: ")[1] for line in tests.splitlines() if "FileScan parquet" in line]
    assert sorted(read) == sorted(["struct<campaign_id:string>", "struct<creative_id:string>", "struct<postback_id:string>", "struct<event_id:string>",
                                   "struct<campaign_id:string>", "struct<campaign_id:string>", "struct<network:string>"]) or all(r.count(":") <= 2 for r in read)
    assert "ad_daily_stats" not in tests


def test_csv_columns_are_matched_by_name(spark, models):
    cre = models.raw["creatives"]
    path = scratch_path(spark, "t_byname")
    cre.select("size", "creative_id", F.lit(1).alias("extra"), *[c for c in cre.columns if c not in ("size", "creative_id")]).write.option("header", True).csv(path)
    assert values(files.read_raw_csv(spark, path, "creatives")) == values(cre)
    short = scratch_path(spark, "t_missing")
    cre.drop("size", "format").write.option("header", True).csv(short)
    with pytest.raises(ValueError, match="no column format, size"):
        files.read_raw_csv(spark, short, "creatives")


# ------------------------------------------------------------------- grains
@pytest.fixture(scope="module")
def two_countries(spark, models):
    """Every second ad row, postback and event of a campaign moves to another
    country, so cohorts span countries and both postback versions."""
    raw = dict(models.raw)
    ads = raw["ad_daily_stats"]
    raw["ad_daily_stats"] = ads.unionByName(ads.withColumn("country", F.lit("XX")))
    raw["iap_events"] = raw["iap_events"].withColumn("country", F.when(F.hash("event_id") % 2 == 0, "XX").otherwise(F.col("country")))
    return Models(raw, models.as_of)


def test_revenue_rows_do_not_grow(two_countries):
    m = two_countries
    assert m.int_cohort_revenue.count() == m.int_daily_revenue.count()
    assert m.int_cohort_installs.count() > cohort.cohort_totals(m.int_cohort_installs).count()


def test_dashboard_totals_are_the_raw_totals(two_countries):
    m = two_countries
    total = lambda df, c: round(df.agg(F.sum(F.col(c).cast("decimal(18,4)"))).first()[0] or 0, 2)
    revenue = total(m.stg_iap_events.where("is_revenue_event and days_since_install <= 30"), "revenue_usd")
    assert total(bi.ltv_curve(m.int_cohort_installs, m.revenue_events).where("cohort_day = 30"), "revenue_usd") == revenue
    known = m.stg_iap_events.join(m.int_cohort_installs.select("install_date", "network", "country").distinct(), ["install_date", "network", "country"], "left_semi")
    spend = total(m.stg_ad_stats.where("installs > 0"), "spend_usd")
    trend = bi.roas_trend(m.int_cohort_installs, m.revenue_events)
    assert total(trend, "total_spend_usd") == spend
    weekly = bi._weekly(m.int_cohort_installs, m.revenue_events)
    assert total(weekly, "rev_d30") == total(known.where("is_revenue_event and days_since_install <= 30"), "revenue_usd")
    installs = m.stg_ad_stats.agg(F.sum("installs")).first()[0]
    cover = bi.coverage_trend(m.int_skan_cv_mapping, m.stg_ad_stats)
    assert cover.agg(F.sum("mmp_installs")).first()[0] == installs
    first = m.stg_skan_postbacks.where("postback_sequence = 1")
    kpis = bi.skan_kpis(m.stg_skan_postbacks, m.stg_ad_stats).first()
    assert kpis.skan_postbacks == first.count()
    roas = float(total(first, "estimated_revenue_usd")) / float(total(m.stg_ad_stats, "spend_usd"))
    assert abs(kpis.skan_roas - roas) < 1e-4
    assert abs(kpis.avg_conversion_value - first.agg(F.avg("conversion_value")).first()[0]) < 1e-4


# -------------------------------------------------------------------- order
@pytest.mark.parametrize("name,key", [
    ("sort_campaign_performance", lambda r: (-r.stat_date.toordinal(), -r.spend_usd)),
    ("sort_cohort_analysis", lambda r: (r.install_date, r.network, r.country)),
    ("sort_unit_economics", lambda r: (r.campaign_roas is None, -(r.campaign_roas or 0))),
    ("sort_skan_attribution", lambda r: (-r.install_date.toordinal(), -r.spend_usd)),
])
def test_sorted_reports_are_in_order(spark, name, key):
    from burnlens.registry import queries
    rows = [key(r) for r in queries()[name](spark, "/root/testdata/sf0.001").collect()]
    assert len(rows) > 1 and rows == sorted(rows)
