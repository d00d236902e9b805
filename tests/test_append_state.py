"""Appends checked by Bloom filters, bitmap and histogram states, rejected lines."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal
from statistics import median

import pytest
from pyspark.sql import functions as F

from burnlens import jobs
from burnlens.operators import bi, campaign, key_filter, quality
from burnlens.plans import append, refresh
from burnlens.plans.models import RAW_TABLES
from burnlens.session import scratch_path
from burnlens.sources import files, tables
from burnlens.sources import schemas as S

D0 = dt.date(2024, 10, 1)
EVENT = ("c1", "k1", "Meta", "US", "purchase", "lifetime", Decimal("1"))


def values(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def events(spark, rows):
    """(event_id, install day number)."""
    return spark.createDataFrame([(i, None if d is None else D0 + dt.timedelta(days=d), D0, *EVENT) for i, d in rows], S.IAP_EVENTS)


# ------------------------------------------------------------- Bloom filters
def test_filters_miss_no_key(spark):
    r = random.Random(1)
    held = [f"e{r.getrandbits(60)}" for _ in range(5000)]
    other = [f"x{r.getrandbits(60)}" for _ in range(5000)]
    buckets = key_filter.bucket_count(5000)
    parts = spark.createDataFrame([(str(i % 3), k) for i, k in enumerate(held)] + [("0", None)], "part string, key string")
    filters = key_filter.build(parts, buckets)
    found = {r.key for r in key_filter.possible_repeats(spark.createDataFrame([(k,) for k in held + other] + [(None,)], "key string"), filters, buckets).collect()}
    assert found >= set(held) and len(found - set(held)) < 100
    assert filters.where("length(bits) <> 4096").count() == 0


def test_filters_shuffle_a_hash_a_key(spark):
    """No bitmaps are sent: each task would send one for each bucket that it has a bit of."""
    parts = spark.range(2000).select((F.col("id") % 3).cast("string").alias("part"), F.concat(F.lit("k"), "id").alias("key"))
    lines = key_filter.build(parts, 4)._jdf.queryExecution().executedPlan().toString().splitlines()
    sent = [line for k, line in enumerate(lines) if k and "Exchange" in lines[k - 1]]
    assert sent and not any("bitmap" in line for line in sent)


def test_appends_equal_the_exact_test(spark):
    """Repeats within the old part, within the new one, across both, across
    three loads, undated rows, replaced rows that were a repeat."""
    db = tables.scratch_database(spark, "t_append")
    name = f"{db}.iap_events"
    old = [(f"a{i}", i % 70) for i in range(400)] + [("dup_old", 3), ("dup_old", 40), ("gone", 5), ("gone", 69), ("none", None), ("none", 2), (None, 1), (None, 2)]
    tables.replace(files.with_loaded_at(events(spark, old)), name, files.raw_layout("iap_events"))
    append.index_keys(spark, db, "iap_events")

    def check(rows):
        got = values(append.unique_failures(spark, db).where("test_name LIKE '%event_id'")) if tables.exists(spark, f"{db}.skan_postbacks_repeated") else \
            values(tables.read(spark, f"{name}_repeated").select(F.lit(quality.unique_name("iap_events", "event_id")), "key", "n"))
        raw = {t: spark.createDataFrame([], S.RAW_SCHEMAS[t]) for t in RAW_TABLES} | {"iap_events": events(spark, rows)}
        assert got == values(quality.dq_unique(raw))
        assert values(files.read_raw_table(spark, db, "iap_events")) == values(events(spark, rows))
    check(old)
    state = old
    for start, new in ((68, [(f"b{i}", 68 + i % 20) for i in range(300)] + [("a3", 70), ("a4", 70), ("b1", 71), ("dup_old", 80)]),
                       (75, [(f"c{i}", 75 + i % 20) for i in range(200)] + [("b1", 90), ("a3", 91), ("none", 92), (None, 93), ("c5", 76)]),
                       (75, [("last", 95)])):
        append.append_facts(events(spark, new), db, "iap_events", D0 + dt.timedelta(days=start))
        state = [(k, d) for k, d in state if d is None or d < start] + new
        check(state)
    big = [(f"z{i}", 100 + i % 5) for i in range(9000)]  # outgrows the filters
    append.append_facts(events(spark, big), db, "iap_events", D0 + dt.timedelta(days=100))
    check(state + big)
    assert tables.read(spark, f"{name}_keys").agg(F.max("buckets")).first()[0] == key_filter.bucket_count(len(state + big))


def test_kept_months_are_not_written_and_only_candidates_meet_them(spark):
    db = tables.scratch_database(spark, "t_append2")
    name = f"{db}.iap_events"
    tables.replace(files.with_loaded_at(events(spark, [(f"a{i}", i % 60) for i in range(300)])), name, files.raw_layout("iap_events"))
    append.index_keys(spark, db, "iap_events")
    since = dt.date(2024, 12, 5)
    before = tables.months_before(spark, name, since), tables.months_before(spark, f"{name}_keys", since)
    append.append_facts(events(spark, [(f"b{i}", 65 + i % 9) for i in range(100)]), db, "iap_events", since)
    assert (tables.months_before(spark, name, since), tables.months_before(spark, f"{name}_keys", since)) == before
    new = events(spark, [(f"b{i}", 65) for i in range(100)]).select(F.col("event_id").alias("key"))
    known = spark.table(f"{name}_keys").where("ym < '202412'")
    assert key_filter.possible_repeats(new, known, 1).count() <= 3


# ------------------------------------------------------------------- states
def test_bitmaps_equal_distinct_counts(spark, models):
    ads = models.stg_ad_stats.unionByName(models.stg_ad_stats.limit(50))
    state = campaign.active_state(ads, campaign.creative_codes(ads))
    for grain in ((), ("stat_date",), ("stat_date", "network", "country"), (F.date_trunc("month", "stat_date").alias("month"),)):
        want = ads.groupBy("campaign_id", *grain).agg(F.countDistinct("creative_id").alias("n"))
        assert values(campaign.active_creatives(state, *grain)) == values(want)
    assert campaign.active_creatives(state.where("false")).count() == 0


def test_a_day_of_few_creatives_is_a_small_state(spark):
    """Two creatives of a campaign: one word of 64 bits for each day, not a whole bitmap."""
    ads = spark.range(4).select(F.date_add(F.lit(D0), (F.col("id") % 2).cast("int")).alias("stat_date"), F.lit("c").alias("campaign_id"), F.lit("n").alias("network"),
                                F.lit("x").alias("country"), F.concat(F.lit("k"), F.floor(F.col("id") / 2)).alias("creative_id"))
    state = campaign.active_state(ads, campaign.creative_codes(ads))
    assert [[tuple(w) for w in r.creatives] for r in state.collect()] == [[(0, 3)], [(0, 3)]]
    assert campaign.active_creatives(state).first()["active_creatives"] == 2


def test_a_campaign_of_many_creatives(spark):
    ads = spark.range(70_000).select(F.lit(D0).alias("stat_date"), F.lit("c").alias("campaign_id"), F.lit("n").alias("network"), F.lit("x").alias("country"),
                                     F.concat(F.lit("k"), F.col("id")).alias("creative_id"))
    state = campaign.active_state(ads, campaign.creative_codes(ads))
    assert state.count() == 3 and campaign.active_creatives(state).first()["active_creatives"] == 70_000


@pytest.mark.parametrize("n", [1, 2, 3, 10, 11, 200])
def test_medians_from_day_counts(spark, n):
    r = random.Random(n)
    rows = [(f, r.choice([None, 1, 2, 3, 50, 7])) for f in "ab" for _ in range(n)] + [("none", None)]
    df = spark.createDataFrame(rows, "format string, day int")
    counts = bi.day_counts(df, "format", "day")
    halves = bi.day_counts(df.where("day > 3"), "format", "day").unionByName(bi.day_counts(df.where("day <= 3 OR day IS NULL"), "format", "day"))
    for c in (counts, halves.groupBy("format", "day").agg(F.sum("n").alias("n"))):  # states add up
        got = {x.format: (x.rows, x.mean, x.median) for x in bi.day_summary(c, "format").collect()}
        for f in ("a", "b", "none"):
            days = [d for g, d in rows if g == f and d is not None]
            want = (sum(g == f for g, _ in rows), sum(days) / len(days), float(median(days))) if days else (sum(g == f for g, _ in rows), None, None)
            assert got[f] == want


# ---------------------------------------------------------------- bad lines
def _write_csv(spark, models, path, spoil):
    key = {"skan_postbacks": "postback_id", "iap_events": "event_id"}
    for t in RAW_TABLES:
        df = models.raw[t].dropDuplicates([key[t]]) if t in key else models.raw[t]
        df.coalesce(1).write.option("header", True).csv(f"{path}/{t}")
    header = ",".join(S.RAW_SCHEMAS["iap_events"].fieldNames())
    spark.createDataFrame([(header,), *[(line,) for line in spoil]], "v string").coalesce(1).write.mode("append").text(f"{path}/iap_events")


BAD = ["e1,not a date,2024-10-02,c,k,Meta,US,purchase,lifetime,1.0", "e2,2024-10-01", "e3,2024-10-01,2024-10-02,c,k,Meta,US,purchase,lifetime,much",
       "e4,2024-10-01,2024-10-02,c,k,Meta,US,purchase,lifetime,1.0,more"]
GOOD = "e5,2024-10-01,2024-10-02,c,k,Meta,US,purchase,lifetime,1.0000"


def test_bad_lines_are_kept_aside(spark, models, capsys):
    csv = scratch_path(spark, "t_bad")
    _write_csv(spark, models, csv, [*BAD, GOOD])
    db = tables.scratch_database(spark, "t_bad")
    n = models.raw["iap_events"].select("event_id").distinct().count()
    loaded = {r.table_name: (r.row_count, r.rejected) for r in refresh.load_csv(spark, csv, db).collect()}
    assert loaded["iap_events"] == (n + 1, 4) and loaded["campaigns"][1] == 0
    aside = tables.read(spark, f"{db}.rejected_lines").collect()
    assert sorted(r.line for r in aside) == sorted(BAD) and all(r.table_name == "iap_events" and "/iap_events/" in r.file for r in aside)
    assert files.read_raw_table(spark, db, "iap_events").where("event_id = 'e5'").count() == 1
    with pytest.raises(files.TooManyBadLines, match="iap_events: 4 of"):
        refresh.load_csv(spark, csv, db, max_bad_share=0.0)
    assert files.read_raw_table(spark, db, "iap_events").count() == n + 1  # the load before
    assert jobs.main(["daily", "--csv", csv, "--name", "t_refused", "--root", scratch_path(spark, "t_refused"), "--max-bad-share", "0"], spark) == 1
    assert "load refused" in capsys.readouterr().err
