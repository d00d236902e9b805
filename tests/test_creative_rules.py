"""Creative lifecycle rules on hand-made frames."""

import datetime as dt

from burnlens.operators import creative

D0 = dt.date(2024, 10, 1)
METRIC_SCHEMA = (
    "stat_date date, campaign_id string, creative_id string, network string, country string, "
    "creative_name string, format string, format_group string, is_video boolean, "
    "launch_date date, objective string, day_of_life int, impressions bigint, clicks bigint, "
    "spend_usd double, installs bigint, ctr double, cvr_click_to_install double, "
    "cpi_usd double, cpm_usd double, cpc_usd double, ctr_7d_avg double, "
    "ctr_peak_so_far double, cumulative_spend_usd double, cumulative_installs bigint"
)


def metrics(spark, creative_id, days):
    """days: list of (day_of_life, impressions, ctr, ctr_7d_avg, spend, cpi)."""
    data = []
    for dol, imp, ctr, ctr7, spend, cpi in days:
        data.append((D0 + dt.timedelta(days=dol), "c1", creative_id, "Meta", "US", "n",
                     "video_15s", "video", True, D0, "app_installs", dol, imp, 0, spend, 1,
                     ctr, None, cpi, None, None, ctr7, None, None, None))
    return spark.createDataFrame(data, METRIC_SCHEMA)


def stages(df):
    return [(r.day_of_life, r.lifecycle_stage) for r in df.orderBy("day_of_life").collect()]


def test_never_burnt(spark):
    m = metrics(spark, "k", [(d, 1000, 0.01, 0.01, 10.0, 2.0) for d in range(4)])
    out = creative.creative_burnout(m)
    assert stages(out) == [(0, "warming_up"), (1, "peak"), (2, "peak"), (3, "peak")]
    assert {r.burnout_score for r in out.collect()} == {0.0}
    assert {r.wasted_spend_usd for r in out.collect()} == {0.0}
    assert all(r.burnout_date is None for r in out.collect())


def test_burnt_at_once_and_recovery(spark):
    m = metrics(spark, "k", [
        (0, 1000, 0.02, 0.02, 10.0, 2.0),
        (1, 1000, 0.005, 0.010, 20.0, 4.0),   # crosses: 0.010 < 0.014
        (2, 1000, 0.02, 0.016, 30.0, 3.0),    # recovered above 70 %: declining
        (3, 1000, 0.004, 0.010, 40.0, 5.0),   # below again: burnt
    ])
    out = creative.creative_burnout(m)
    assert stages(out) == [(0, "warming_up"), (1, "burnt"), (2, "declining"), (3, "burnt")]
    by_day = {r.day_of_life: r for r in out.collect()}
    assert by_day[1].burnout_date == D0 + dt.timedelta(days=1)
    assert by_day[1].burnout_day_of_life == 1
    assert [by_day[d].is_post_burnout for d in range(4)] == [False, True, True, True]
    assert [by_day[d].wasted_spend_usd for d in range(4)] == [0.0, 20.0, 30.0, 40.0]
    assert by_day[1].burnout_score == 0.5 and by_day[1].ctr_vs_peak_ratio == 0.5
    assert [by_day[d].cpi_vs_best_ratio for d in range(4)] == [1.0, 2.0, 1.5, 2.5]


def test_exactly_seventy_percent_is_not_burnt(spark):
    m = metrics(spark, "k", [(0, 1000, 0.1, 0.1, 1.0, 1.0), (1, 1000, 0.07, 0.07, 1.0, 1.0)])
    out = creative.creative_burnout(m)
    assert stages(out) == [(0, "warming_up"), (1, "peak")]
    assert [r.burnout_score for r in out.orderBy("day_of_life").collect()] == [0.0, 0.3]


def test_zero_peak_has_no_score(spark):
    m = metrics(spark, "k", [(0, 1000, 0.0, 0.0, 1.0, 1.0), (1, 1000, 0.0, 0.0, 1.0, 1.0)])
    out = creative.creative_burnout(m)
    assert [r.burnout_score for r in out.collect()] == [None, None]
    assert [r.ctr_vs_peak_ratio for r in out.collect()] == [None, None]
    assert stages(out) == [(0, "warming_up"), (1, "peak")]


def test_peak_ties_and_impression_floor(spark):
    m = metrics(spark, "k", [
        (0, 499, 0.09, 0.09, 1.0, 1.0),    # higher ctr but under 500 impressions: ignored
        (1, 500, 0.05, 0.05, 1.0, 1.0),    # tie on top ctr: earliest day wins
        (2, 800, 0.05, 0.05, 1.0, 1.0),
        (3, 900, 0.01, 0.03, 1.0, 1.0),
    ])
    p = creative.peaks(m).collect()[0]
    assert (p.absolute_peak_ctr, p.peak_day_of_life, p.first_stat_date.day) == (0.05, 1, 2)
    # the mart drops the 499-impression day and agrees with the grouped peaks
    out = creative.creative_burnout(m)
    assert sorted(r.day_of_life for r in out.collect()) == [1, 2, 3]
    assert {(r.absolute_peak_ctr, r.peak_day_of_life) for r in out.collect()} == {(0.05, 1)}
    be = creative.burnout_events(m).collect()
    assert [(r.creative_id, r.burnout_day_of_life) for r in be] == [("k", 3)]


def test_window_mart_equals_join_form(spark, models):
    """The window-based mart equals the reference's join form on real data."""
    m = models
    mart = m.mart_creative_burnout.select(
        "creative_id", "stat_date", "absolute_peak_ctr", "peak_day_of_life", "burnout_date",
        "burnout_day_of_life")
    joined = creative.burnout_joined(
        m.int_creative_daily_metrics, m.int_creative_peaks, m.int_burnout_events
    ).select(*mart.columns)
    assert mart.exceptAll(joined).count() == 0 and joined.exceptAll(mart).count() == 0


def test_rolling_ctr_counts_rows_and_skips_null(spark):
    from burnlens.operators import staging as stg
    from burnlens.sources import schemas as S
    from decimal import Decimal
    days = [0, 1, 2, 3, 5, 6, 7, 8, 9]  # day 4 missing: the 7-row frame reaches back further
    data = []
    for i, d in enumerate(days):
        imps = 0 if d == 6 else 1000       # day 6: NULL ctr
        data.append((D0 + dt.timedelta(days=d), "c1", "k", "Meta", "US", imps, 10 * (i + 1),
                     Decimal("1.0000"), 1))
    ads = stg.stg_ad_stats(spark.createDataFrame(data, S.AD_DAILY_STATS))
    cre = spark.createDataFrame([("k", "c1", "n", "carousel", "1x1", D0)], S.CREATIVES)
    camp = spark.createDataFrame(
        [("c1", "n", "Meta", "app_installs", "US", Decimal("10"), D0, None)], S.CAMPAIGNS)
    out = creative.daily_metrics(ads, stg.stg_creatives(cre), stg.stg_campaigns(camp))
    got = {r.day_of_life: r for r in out.collect()}
    ctrs = {d: (None if d == 6 else 10 * (i + 1) / 1000) for i, d in enumerate(days)}
    last7 = [d for d in days if d <= 9][-7:]           # rows, not calendar days
    vals = [ctrs[d] for d in last7 if ctrs[d] is not None]
    assert abs(got[9].ctr_7d_avg - sum(vals) / len(vals)) < 1e-12
    assert got[6].ctr is None and got[6].ctr_7d_avg is not None
    assert got[9].ctr_peak_so_far == max(v for v in ctrs.values() if v is not None)
    assert got[9].cumulative_spend_usd == 9.0 and got[9].cumulative_installs == 9
