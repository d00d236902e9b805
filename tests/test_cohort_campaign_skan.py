"""Cohort, unit economics, saturation and SKAN reconciliation on hand-made frames."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from burnlens.operators import campaign, cohort, skan
from burnlens.operators import staging as stg
from burnlens.sources import schemas as S
from marts_helpers import rows

D0 = dt.date(2024, 10, 1)


def day(n):
    return D0 + dt.timedelta(days=n)


def dims(spark, campaigns=("c1",), creatives=(("k1", "c1"),)):
    camp = spark.createDataFrame(
        [(c, f"name {c}", "Meta", "app_installs", "US", Decimal("100"), D0, None) for c in campaigns],
        S.CAMPAIGNS)
    cre = spark.createDataFrame(
        [(k, c, "n", "carousel", "1x1", D0) for k, c in creatives], S.CREATIVES)
    return stg.stg_campaigns(camp), stg.stg_creatives(cre)


def ads(spark, data):
    """data: (day, campaign, creative, installs, spend)."""
    return stg.stg_ad_stats(spark.createDataFrame(
        [(day(d), c, k, "Meta", "US", 10000, 100, Decimal(str(sp)), i) for d, c, k, i, sp in data],
        S.AD_DAILY_STATS))


def iap(spark, data):
    """data: (id, install day, event day, campaign, creative, type, product, revenue)."""
    return stg.stg_iap_events(spark.createDataFrame(
        [(e, day(i), day(ev), c, k, "Meta", "US", t, p, Decimal(str(r)))
         for e, i, ev, c, k, t, p, r in data], S.IAP_EVENTS))


def test_cohort_revenue_checkpoints(spark):
    camp, cre = dims(spark)
    a = ads(spark, [(0, "c1", "k1", 10, 50.0), (1, "c1", "k1", 5, 20.0), (2, "c1", "k1", 0, 9.0)])
    ev = []
    for i, d in enumerate([0, 1, 7, 8, 30, 31]):       # checkpoint boundaries
        ev.append((f"e{i}", 0, d, "c1", "k1", "purchase", "monthly_sub", 10.0))
    ev.append(("two", 0, 0, "c1", "k1", "purchase", "lifetime", 5.0))       # two products, one day
    ev.append(("tr", 1, 1, "c1", "k1", "trial_start", "weekly_sub", 0.0))  # trial only
    ev.append(("orphan", 5, 5, "c1", "k1", "purchase", "lifetime", 99.0))  # revenue, no cohort
    installs = cohort.cohort_installs(a, cre, camp)
    assert sorted(r.install_date.day for r in installs.collect()) == [1, 2]  # 0-install day dropped
    out = cohort.cohort_analysis(installs, cohort.revenue_events(iap(spark, ev)))
    got = {r.install_date.day: r for r in out.collect()}
    assert sorted(got) == [1, 2]                          # revenue without a cohort drops
    r0 = got[1]
    assert r0.total_installs == 10 and r0.cac_usd == 5.0
    assert (r0.arpu_d0, r0.arpu_d1, r0.arpu_d3, r0.arpu_d7, r0.arpu_d14, r0.arpu_d30) == (
        1.5, 2.5, 2.5, 3.5, 4.5, 5.5)
    assert (r0.revenue_d7_usd, r0.revenue_d30_usd) == (35.0, 55.0)
    assert r0.roas_d7 == 0.7
    r1 = got[2]                                           # cohort without revenue keeps zeros
    assert (r1.arpu_d0, r1.arpu_d30, r1.revenue_d7_usd, r1.roas_d30) == (0.0, 0.0, 0.0, 0.0)
    assert r0.install_week == dt.date(2024, 9, 30)


def test_cohort_revenue_running_sum(spark):
    camp, cre = dims(spark)
    a = ads(spark, [(0, "c1", "k1", 4, 40.0)])
    ev = [("a", 0, 0, "c1", "k1", "purchase", "monthly_sub", 10.0),
          ("b", 0, 2, "c1", "k1", "purchase", "monthly_sub", 6.0),
          ("c", 0, 2, "c1", "k1", "purchase", "lifetime", 4.0),
          ("x", 3, 3, "c1", "k1", "purchase", "lifetime", 4.0)]     # no cohort: NULL ltv
    installs = cohort.cohort_installs(a, cre, camp)
    rev = cohort.cohort_revenue(cohort.daily_revenue(iap(spark, ev)), installs)
    got = rows(rev, "install_date", "days_since_install", "daily_revenue_usd",
               "cumulative_revenue_usd", "ltv_usd", "roas")
    assert got == [(day(0), 0, 10.0, 10.0, 2.5, 0.25), (day(0), 2, 10.0, 20.0, 5.0, 0.5),
                   (day(3), 0, 4.0, 4.0, None, None)]


def test_unit_economics_payback(spark):
    cs = ("p7", "p14", "p30", "never", "norev")
    camp, cre = dims(spark, cs, [(f"k_{c}", c) for c in cs])
    a = ads(spark, [(0, c, f"k_{c}", 10, 100.0) for c in cs])  # cac = 10
    ev = [("e1", 0, 5, "p7", "k_p7", "purchase", "lifetime", 100.0),
          ("e2", 0, 10, "p14", "k_p14", "purchase", "lifetime", 100.0),
          ("e3", 0, 20, "p30", "k_p30", "purchase", "lifetime", 100.0),
          ("e4", 0, 40, "never", "k_never", "purchase", "lifetime", 100.0),
          ("e5", 0, 0, "never", "k_never", "purchase", "lifetime", 50.0)]
    installs = cohort.cohort_installs(a, cre, camp)
    out = cohort.unit_economics(installs, cohort.revenue_events(iap(spark, ev)), camp)
    got = {r.campaign_id: r for r in out.collect()}
    assert {c: got[c].payback_period_bucket for c in cs} == {
        "p7": "≤ 7 days", "p14": "8–14 days", "p30": "15–30 days", "never": "> 30 days",
        "norev": "> 30 days"}
    assert got["p14"].payback_d7 == "not_yet" and got["p14"].payback_d14 == "paid_back"
    assert got["norev"].total_revenue_usd is None and got["norev"].ltv_d7_usd is None
    assert got["never"].ltv_total_usd == 15.0 and got["never"].campaign_roas == 1.5
    assert got["p7"].roas_d7 == 1.0


def test_unit_economics_denominators(spark):
    camp, cre = dims(spark, ("c1",), [("k1", "c1"), ("k2", "c1")])
    a = ads(spark, [(0, "c1", "k1", 10, 100.0), (1, "c1", "k2", 30, 300.0)])
    ev = [("e1", 0, 0, "c1", "k1", "purchase", "lifetime", 80.0),
          ("e2", 1, 1, "c1", "k2", "purchase", "lifetime", 120.0)]
    installs = cohort.cohort_installs(a, cre, camp)
    events = iap(spark, ev)
    total = cohort.unit_economics(installs, cohort.revenue_events(events), camp).collect()[0]
    assert total.total_installs == 40 and total.ltv_d7_usd == 5.0       # 200 / 40
    rev = cohort.cohort_revenue(cohort.daily_revenue(events), installs)
    first = cohort.unit_economics(installs, rev, camp, denominator="first_cohort").collect()[0]
    assert first.ltv_d7_usd == 20.0                                       # 200 / 10 (first cohort)


def test_saturation_flags(spark):
    vals = [1.30, 1.31, 1.15, 1.16, 0.90, 0.89, None, float("nan")]
    df = spark.createDataFrame([(v,) for v in vals], "r double")
    from burnlens.functions.columns import nan_to_null
    got = [r[0] for r in df.select(campaign.saturation_flag(nan_to_null(F.col("r")))).collect()]
    assert got == ["watch", "saturating", "stable", "watch", "stable", "improving",
                   "stable", "stable"]


def test_campaign_budget_and_trend(spark):
    camp, _ = dims(spark)
    # budget 100: spend 105 is not over budget, 106 is
    a = ads(spark, [(0, "c1", "k1", 10, 105.0), (1, "c1", "k1", 10, 106.0),
                    (1, "c1", "k2", 10, 0.0), (2, "c1", "k1", 5, 212.0)])
    out = campaign.campaign_performance(a, camp)
    got = {r.stat_date.day: r for r in out.collect()}
    assert [got[d].is_over_budget for d in (1, 2)] == [False, True]
    assert got[2].active_creatives == 2
    assert got[1].cpi_trend_ratio is None and got[1].saturation_flag == "stable"
    assert got[2].cpi_trend_ratio == round(5.3 / 10.5, 4)          # vs mean of prior days
    assert got[3].cpi_trend_ratio == round(42.4 / ((10.5 + 5.3) / 2), 4)
    assert got[3].saturation_flag == "saturating"
    assert got[3].cumulative_spend_usd == 423.0 and got[3].cumulative_installs == 35


def test_skan_reconciliation(spark):
    pb = []
    def p(i, d, k, ver="4.0", seq=1, cv=5, priv="none"):
        pb.append((f"p{i}", day(d), "c1", k, "Meta", "US", ver, cv, seq, priv))
    p(1, 0, "k1"); p(2, 0, "k1", cv=20, priv="medium")          # matched
    p(3, 1, "k9")                                              # postback only
    p(4, 2, "k1", ver="3.0"); p(5, 2, "k1", ver="4.0")           # two versions, one cohort
    p(6, 3, "k1", seq=2)                                       # sequence 2 only: ads only
    postbacks = stg.stg_skan_postbacks(spark.createDataFrame(pb, S.SKAN_POSTBACKS))
    a = ads(spark, [(0, "c1", "k1", 4, 40.0), (2, "c1", "k1", 2, 10.0), (3, "c1", "k1", 1, 5.0),
                    (4, "c1", "k1", 1, 5.0)])                    # day 4: ads only
    camp, _ = dims(spark)
    out = skan.skan_attribution(skan.cv_mapping(postbacks), a, camp)
    got = sorted(((r.install_date - D0).days, r.creative_id, r.skan_postbacks, r.mmp_installs)
                 for r in out.collect())
    assert got == [(0, "k1", 2, 4), (1, "k9", 1, 0), (2, "k1", 1, 2), (2, "k1", 1, 2),
                   (3, "k1", 0, 1), (4, "k1", 0, 1)]
    r0 = [r for r in out.collect() if r.install_date == D0][0]
    assert (r0.skan_coverage_rate, r0.privacy_loss_rate, r0.fine_signal_rate) == (0.5, 0.5, 0.5)
    assert r0.skan_estimated_revenue_usd == round(9.99 + 114.99, 2)
    assert r0.campaign_name == "name c1" and r0.avg_cv == 12.5
    only_pb = [r for r in out.collect() if r.creative_id == "k9"][0]
    assert only_pb.skan_coverage_rate is None and only_pb.spend_usd == 0.0


def test_join_edge_cases(spark):
    """A creative without stats yields no rows; stats without a creative (or
    before launch) are dropped by the inner joins and the launch filter."""
    from burnlens.operators import creative
    camp, cre = dims(spark, ("c1",), [("k1", "c1"), ("idle", "c1")])
    a = ads(spark, [(0, "c1", "k1", 1, 1.0), (1, "c1", "ghost", 1, 1.0), (2, "c1", "k1", 1, 1.0)])
    m = creative.daily_metrics(a, cre, camp)
    assert sorted(((r.stat_date - D0).days, r.creative_id) for r in m.collect()) == [
        (0, "k1"), (2, "k1")]
    late = spark.createDataFrame([("k1", "c1", "n", "carousel", "1x1", day(1))], S.CREATIVES)
    m2 = creative.daily_metrics(a, stg.stg_creatives(late), camp)
    assert [((r.stat_date - D0).days, r.day_of_life) for r in m2.collect()] == [(2, 1)]


def test_csv_export_turns_nan_into_null(spark):
    from burnlens.session import scratch_path
    from burnlens.sources import files
    df = spark.createDataFrame([(1, float("nan")), (2, float("inf")), (3, 1.5)], "k int, x double")
    path = scratch_path(spark, "t_csv")
    files.export_csv(df, path)
    back = sorted(tuple(r) for r in files.read_csv(spark, path, df.schema).collect())
    assert back == [(1, None), (2, None), (3, 1.5)]


def test_hot_cohort_aggregates_exactly(spark):
    """One cohort holds ~70 % of all postbacks: the partial-then-final
    aggregate gives the brute-force answer (pandas) exactly."""
    n = 20000
    raw = spark.range(n).select(
        F.concat(F.lit("p"), F.col("id").cast("string")).alias("postback_id"),
        F.when(F.col("id") % 10 < 7, F.lit(D0)).otherwise(F.date_add(F.lit(D0), (F.col("id") % 5).cast("int"))).alias("install_date"),
        F.lit("c1").alias("campaign_id"),
        F.when(F.col("id") % 10 < 7, F.lit("hot")).otherwise(F.lit("cold")).alias("creative_id"),
        F.lit("Meta").alias("network"), F.lit("US").alias("country"), F.lit("4.0").alias("skan_version"),
        (F.col("id") % 64).cast("int").alias("conversion_value"),
        F.lit(1).alias("postback_sequence"),
        F.element_at(F.array(F.lit("none"), F.lit("low"), F.lit("medium")),
                     (F.col("id") % 3 + 1).cast("int")).alias("privacy_threshold"),
    )
    staged = stg.stg_skan_postbacks(raw.repartition(7))
    got = skan.cv_mapping(staged).toPandas().set_index(["install_date", "creative_id"]).sort_index()
    pdf = staged.toPandas()
    want = pdf.groupby(["install_date", "creative_id"]).agg(
        postback_count=("postback_id", "size"),
        fine_cv_count=("privacy_threshold", lambda s: (s == "none").sum()),
        revenue_signal_count=("has_revenue_signal", "sum"),
        cv_sum=("conversion_value", "sum"),
    ).sort_index()
    assert got["postback_count"].max() >= 0.7 * n
    assert (got["postback_count"].values == want["postback_count"].values).all()
    assert (got["fine_cv_count"].values == want["fine_cv_count"].values).all()
    assert (got["revenue_signal_count"].values == want["revenue_signal_count"].values).all()
    exp_avg = (want["cv_sum"] / want["postback_count"]).round(2).values
    assert abs(got["avg_conversion_value"].values - exp_avg).max() < 1e-9
