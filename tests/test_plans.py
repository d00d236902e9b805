"""Plan-shape guards: the properties the design relies on at scale."""

import re

import pytest

from burnlens import registry as E
from marts_helpers import SMOKE

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
             "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(plan: str) -> int:
    return sum(1 for line in plan.splitlines()
               if "Exchange" in line and "Broadcast" not in line and "Reused" not in line)


def test_no_cross_joins_or_python_anywhere(spark):
    bad = {}
    # keys that write and return a read-back are covered by their own tests
    io = ("src_csv", "sink_", "mat_table", "inc_", "backfill_", "refresh_")
    for name, fn in E.queries().items():
        if name.startswith(io):
            continue
        plan = physical(fn(spark, SMOKE))
        hits = [f for f in FORBIDDEN if f in plan]
        if hits:
            bad[name] = hits
        if name != "bi_top_burnt_creatives":  # the top-k report is the only limit
            assert not re.search(r"\b(CollectLimit|GlobalLimit|TakeOrderedAndProject)\b", plan), name
    assert bad == {}


@pytest.fixture(scope="module")
def loaded(spark, models):
    from burnlens.plans.models import Models, load_raw
    from burnlens.sources import tables
    database = tables.scratch_database(spark, "plans")
    load_raw(models.raw, database)
    return Models.from_tables(spark, database)


def test_headline_mart_is_one_shuffle_with_broadcast_dims(loaded):
    plan = physical(loaded.mart_creative_burnout)
    assert shuffles(plan) == 1
    assert "hashpartitioning(creative_id" in plan
    assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan


def test_fact_aggregates_combine_before_the_shuffle(loaded):
    """Every aggregate over the large row-level facts has a partial
    aggregate below its shuffle (map-side combine: hot keys are reduced per
    task before they are sent)."""
    for df in (loaded.int_skan_cv_mapping, loaded.int_daily_revenue,
               loaded.mart_cohort_analysis, loaded.mart_unit_economics):
        plan = physical(df).splitlines()
        for i, line in enumerate(plan):
            if "Exchange hashpartitioning" in line and "ENSURE_REQUIREMENTS" in line:
                below = "\n".join(plan[i + 1:i + 3])
                assert "HashAggregate" in below or "partial" in below.lower(), line


def test_bucketed_metrics_feed_the_creative_models_without_shuffle(spark, models):
    from burnlens.operators import creative
    from burnlens.plans.refresh import LAYOUTS
    from burnlens.sources import tables
    name = f"{tables.scratch_database(spark)}.metrics"
    tables.replace(models.int_creative_daily_metrics, name, LAYOUTS["int_creative_daily_metrics"])
    t = tables.read(spark, name)
    for df in (creative.creative_burnout(t), creative.peaks(t), creative.burnout_events(t)):
        assert shuffles(physical(df)) == 0
    assert t.exceptAll(models.int_creative_daily_metrics).count() == 0


def test_cohort_ads_are_summed_once_and_join_without_shuffle(spark, loaded):
    """The job's models by cohort key read one bucketed table; the full outer join has no Exchange."""
    from burnlens.operators import skan
    from burnlens.plans import refresh
    from burnlens.plans.models import Models
    from burnlens.sources import tables
    names = ("int_skan_cv_mapping", "int_cohort_installs", "mart_campaign_performance", "mart_unit_economics", "mart_skan_attribution")
    run = refresh.materialise(spark, loaded, names, tables.scratch_database(spark, "cohort"), buckets=4)
    rows = run.models.ad_rows
    plan = physical(skan.reconcile(run.models.int_skan_cv_mapping.where("postback_sequence = 1"), skan.reported_installs(rows)))
    assert "FullOuter" in plan and shuffles(plan) == 0, plan
    lazy = Models(loaded.raw, loaded.as_of)
    read = Models(loaded.raw, loaded.as_of)
    read.__dict__.update(ad_rows=rows, int_skan_cv_mapping=run.models.int_skan_cv_mapping)
    for name in names[1:]:
        plan = physical(getattr(read, name))
        assert "cohort_ads" in plan and "ad_daily_stats" not in plan, name
        got, want = getattr(run.models, name), getattr(lazy, name)
        assert got.columns == want.columns and got.count() == want.count() > 0, name
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty(), name


def test_cohort_ads_keep_rows_without_installs_apart(spark, models):
    """Two ad rows of one key, of which one has no installs: its spend isn't the cohort's."""
    from burnlens.operators import cohort, skan
    ads = models.stg_ad_stats
    row = ads.where("installs > 0").orderBy("creative_id", "stat_date").first().asDict()
    both = spark.createDataFrame([row, {**row, "installs": 0, "spend_usd": 7.0}, {**row, "installs": None}], ads.schema)
    sums = cohort.cohort_ads(both)
    assert sums.count() == 3
    for model in (lambda a: cohort.cohort_installs(a, models.stg_creatives, models.stg_campaigns), skan.reported_installs):
        assert model(sums).collect() == model(both).collect()


def test_a_job_shuffles_the_ad_rows_once(spark, models):
    """Daily metrics and cohort sums read the rows by creative: no Exchange of them, none before the sums."""
    from burnlens.operators import cohort, skan
    from burnlens.plans import refresh
    from burnlens.sources import tables
    run = refresh.Run(spark, models, tables.scratch_database(spark, "by_creative"), buckets=4)
    run.stage_raw()
    assert shuffles(physical(cohort.cohort_ads(run.models.stg_ad_stats))) == 0
    plan = physical(run.models.int_creative_daily_metrics)
    assert "ads_by_creative" in plan and "lineitem" not in plan and shuffles(plan) == 0
    run.deal_facts()
    for name in ("int_skan_cv_mapping", "int_daily_revenue"):
        assert shuffles(physical(getattr(run.models, name))) == 1, name
    assert "Exchange" not in physical(run.models.int_skan_cv_mapping.repartition(4, *skan.SKAN_KEYS)).split("Exchange", 1)[1]
    run.discard()


def test_quality_summary_copies_no_row(loaded):
    from burnlens.operators import quality
    plan = physical(quality.dq_summary(loaded.raw, loaded.mart_creative_burnout, loaded.stg_ad_stats))
    assert "gid#" not in plan  # no Expand for distinct counts (unpivot expands one row)


def test_raw_load_reads_its_input_once(spark, models):
    """The raw write rebalances (no range sampling, which runs the input twice)."""
    from burnlens.sources import tables
    plan = physical(tables.rebalance(models.raw["iap_events"].withColumn("ym", models.raw["iap_events"].install_date.cast("string")), "ym"))
    assert "REBALANCE_PARTITIONS_BY_COL" in plan and "rangepartitioning" not in plan


def test_dashboards_stay_off_the_cohort_join(spark):
    for name in ("bi_arpu_heatmap", "bi_roas_trend", "bi_ltv_curve"):
        assert shuffles(physical(E.queries()[name](spark, SMOKE))) <= 8, name
