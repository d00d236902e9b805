"""The running state of creatives against full rebuilds, day by day."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from burnlens.operators import creative, creative_state
from burnlens.plans import refresh
from burnlens.plans.models import Models
from burnlens.sources import schemas as S
from burnlens.sources import tables
from burnlens.streaming import incremental as inc

START = dt.date(2024, 11, 3)
DAYS = 30
NAMES = refresh.CREATIVE_MODELS


def values(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def history(days, seed=7):
    """Ad rows with the day on which each arrives (at most 14 days late): creatives that
    burn out, peak again, pause, start late, have no impressions, NULLs and tied CTRs."""
    r, out = random.Random(seed), []
    for k in range(14):
        first = r.randint(0, 20)
        for d in range(first, days):
            if k % 5 == 4 and 8 < d - first < 16:
                continue  # a pause
            for network, country in (("Meta", "US"), ("TikTok", "DE"))[: 1 + k % 2]:
                seen = 0 if r.random() < 0.1 else r.choice([300, 1000, 1000, 2000])
                rate = 0.05 * max(0.1, 1 - 0.06 * (d - first)) if (d - first) % 17 < 14 else 0.08
                clicks = None if r.random() < 0.03 else (20 if k == 3 else int(seen * rate * r.uniform(0.6, 1.2)))
                installs = None if r.random() < 0.05 else r.randint(0, 9)
                late = r.choice([0, 0, 0, 0, 1, 5, 14])
                out.append((min(days - 1, d + late), (START + dt.timedelta(days=d), "c1" if k % 3 else "c2", f"k{k}", network, country,
                                                      seen, clicks, Decimal(r.randint(0, 90000)) / 10000, installs)))
    return out


@pytest.fixture(scope="module")
def dims(spark):
    camp = spark.createDataFrame([(c, c, "Meta", o, "US", Decimal(9), START, None) for c, o in (("c1", "x"), ("c2", "y"))], S.CAMPAIGNS)
    cre = spark.createDataFrame([(f"k{k}", "c1" if k % 3 else "c2", f"name {k}", "carousel" if k % 2 else "video_15s", "1x1",
                                  START + dt.timedelta(days=(k % 4) - 1)) for k in range(14)], S.CREATIVES)
    return {"campaigns": camp, "creatives": cre, "skan_postbacks": spark.createDataFrame([], S.SKAN_POSTBACKS),
            "iap_events": spark.createDataFrame([], S.IAP_EVENTS)}


def at_day(spark, dims, rows, day):
    ads = spark.createDataFrame([row for d, row in rows if d <= day], S.AD_DAILY_STATS)
    return Models({**dims, "ad_daily_stats": ads.coalesce(2)}, START + dt.timedelta(days=DAYS))


def test_thirty_days_equal_full_rebuilds(spark, dims):
    """Metrics, peaks and events equal the full rebuild every day; the mart does on
    the re-processed dates and keeps older rows. Late rows come up to 14 days late."""
    rows = history(DAYS)
    db = tables.scratch_database(spark, "t_state")
    going_on, before = 0, None
    for day in [6, 16, 18, 19, 20, 23, 26, DAYS - 1, DAYS - 1]:  # gaps, days in a row, the last one twice
        m = at_day(spark, dims, rows, day)
        since = inc.watermark(spark, f"{db}.mart_creative_burnout")
        old = tables.read(spark, f"{db}.mart_creative_burnout") if since else None
        kept = {} if old is None else {r: 1 for r in values(old.where(F.col("stat_date") < F.lit(since)), *creative.MART_COLUMNS)}
        going_on += refresh.continued_from(spark, m, db) is not None
        refresh.materialise(spark, m, NAMES, db, db).publish()
        for name in NAMES[:3]:
            want = getattr(m, name)
            assert values(tables.read(spark, f"{db}.{name}"), *want.columns) == values(want, *want.columns), (day, name)
        got = tables.read(spark, f"{db}.mart_creative_burnout")
        if since is None:
            assert values(got, *creative.MART_COLUMNS) == values(m.mart_creative_burnout, *creative.MART_COLUMNS)
        else:
            recent = F.col("stat_date") >= F.lit(since)
            assert values(got.where(recent), *creative.MART_COLUMNS) == values(m.mart_creative_burnout.where(recent), *creative.MART_COLUMNS), day
            assert values(got.where(~recent), *creative.MART_COLUMNS) == sorted(kept, key=str)
        state = tables.read(spark, f"{db}.{refresh.STATE}")
        upto = state.agg(F.max("before")).first()[0]
        assert before is None or upto >= before
        before = upto
        whole = creative_state.merged(creative_state.empty(spark), m.int_creative_daily_metrics.where(F.col("stat_date") < F.lit(upto)))
        assert values(state, *creative_state.FIELDS) == values(whole, *creative_state.FIELDS), day
    assert going_on == 7  # the first two runs have no rows older than the window


def test_a_run_reads_the_state_and_the_new_months_only(spark, models):
    """Plans of the incremental models: ad rows from the window's months, no
    scan of the daily metrics but of the month they begin in."""
    from burnlens.plans.models import load_raw
    raw_db, db = tables.scratch_database(spark, "t_reads_raw"), tables.scratch_database(spark, "t_reads")
    load_raw(models.raw, raw_db)
    m = Models.from_tables(spark, raw_db, as_of=models.as_of)
    refresh.materialise(spark, m, NAMES, db).publish()
    state, since = refresh.continued_from(spark, m, db)
    assert since == dt.date(2024, 12, 17)
    plan = creative_state.window_metrics(state, m.ads_since(since), m.stg_creatives, m.stg_campaigns)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line and "ad_daily_stats" in line]
    assert len(scans) == 1 and "InMemoryFileIndex(1 paths)" in scans[0] and "PartitionFilters: [isnotnull(ym" in scans[0]
    assert "int_creative_daily_metrics" not in plan
    # one shuffle of the rows, one of the state
    assert sum("Exchange hashpartitioning" in line for line in plan.splitlines()) <= 2
    before = tables.months_before(spark, f"{db}.int_creative_daily_metrics", since)
    refresh.materialise(spark, m, NAMES, db, db).publish()
    assert tables.months_before(spark, f"{db}.int_creative_daily_metrics", since) == before
    for name in NAMES:
        a, b = tables.read(spark, f"{db}.{name}"), getattr(models, name)
        assert a.exceptAll(b.select(*a.columns)).count() == 0 and a.count() == b.count(), name


def test_another_launch_date_means_a_full_run(spark, dims):
    rows = history(DAYS)
    db = tables.scratch_database(spark, "t_relaunch")
    refresh.materialise(spark, at_day(spark, dims, rows, 20), NAMES, db).publish()
    moved = dict(dims)
    moved["creatives"] = dims["creatives"].withColumn("launch_date", F.when(F.col("creative_id") == "k2", F.lit(START)).otherwise(F.col("launch_date")))
    m = at_day(spark, moved, rows, 25)
    assert refresh.continued_from(spark, m, db) is None
    refresh.materialise(spark, m, NAMES, db, db).publish()
    assert values(tables.read(spark, f"{db}.mart_creative_burnout"), *creative.MART_COLUMNS) == values(m.mart_creative_burnout, *creative.MART_COLUMNS)


def test_no_ads_no_state(spark, dims):
    db = tables.scratch_database(spark, "t_nothing")
    m = Models({**dims, "ad_daily_stats": spark.createDataFrame([], S.AD_DAILY_STATS)}, START)
    refresh.materialise(spark, m, NAMES, db, db).publish()
    assert not tables.exists(spark, f"{db}.{refresh.STATE}") and tables.read(spark, f"{db}.mart_creative_burnout").count() == 0
    rows = history(DAYS)
    refresh.materialise(spark, at_day(spark, dims, rows, 9), NAMES, db, db).publish()
    assert tables.exists(spark, f"{db}.{refresh.STATE}")
