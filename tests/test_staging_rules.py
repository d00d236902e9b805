"""Hand-made frames for the staging rules (one frame per rule, <= 10 rows)."""

import datetime as dt
import math

from pyspark.sql import functions as F

from burnlens.functions import constants as K
from burnlens.operators import staging as stg
from burnlens.sources import schemas as S
from marts_helpers import rows

D = dt.date
dec = __import__("decimal").Decimal


def test_ad_ratios(spark):
    data = [
        (D(2024, 10, 1), "c1", "k1", "Meta", "US", 0, 0, dec("5.0000"), 0),      # zero impressions
        (D(2024, 10, 2), "c1", "k1", "Meta", "US", 1000, 0, dec("5.0000"), 0),   # zero clicks
        (D(2024, 10, 3), "c1", "k1", "Meta", "US", 1000, 10, dec("5.0000"), 0),  # zero installs
        (D(2024, 10, 4), "c1", "k1", "Meta", "US", 0, 0, dec("0.0000"), 0),      # all zero
        (D(2024, 10, 5), "c1", None, "Meta", "US", 1000, 10, dec("5.0000"), 1),  # NULL creative
        (D(2024, 10, 6), "c1", "k1", "Meta", "US", 1000, 10, dec("-1.0000"), 1), # negative spend
        (D(2024, 10, 7), "c1", "k1", "Meta", "US", 3000, 7, dec("12.3456"), 3),
    ]
    out = stg.stg_ad_stats(spark.createDataFrame(data, S.AD_DAILY_STATS))
    got = {r.stat_date.day: r for r in out.collect()}
    assert sorted(got) == [1, 2, 3, 4, 7]  # NULL creative and negative spend dropped
    assert got[1].ctr is None and got[1].cpm_usd is None and got[1].cpi_usd is None
    assert got[2].ctr == 0.0 and got[2].cvr_click_to_install is None and got[2].cpc_usd is None
    assert got[3].cvr_click_to_install == 0.0 and got[3].cpi_usd is None
    assert got[4].ctr is None and got[4].cpm_usd is None
    r = got[7]
    assert r.ctr == round(7 / 3000, 6) == 0.002333
    assert r.cpi_usd == 4.1152 and r.cpm_usd == 4.1152 and r.cpc_usd == 1.7637
    assert r.cvr_click_to_install == 0.428571


def test_creative_formats(spark):
    data = [(f"k{i}", "c1", "n", f, "1x1", D(2024, 10, 1)) for i, f in
            enumerate(["video_15s", "video_30s", "static_image", "carousel", "gif", None])]
    out = stg.stg_creatives(spark.createDataFrame(data, S.CREATIVES))
    got = rows(out, "format", "format_group", "is_video", "video_length_seconds")
    assert got == sorted([
        ("video_15s", "video", True, 15), ("video_30s", "video", True, 30),
        ("static_image", "static", False, None), ("carousel", "carousel", False, None),
        ("gif", "other", False, None), (None, "other", False, None),
    ], key=lambda t: tuple((x is None, str(x)) for x in t))


def test_campaign_dates(spark):
    as_of = D(2024, 12, 31)
    data = [
        ("a", "n", "Meta", "app_installs", "US", dec("100"), D(2024, 10, 1), None),
        ("b", "n", "Meta", "app_installs", "US", dec("100"), D(2024, 10, 1), as_of),
        ("c", "n", "Meta", "app_installs", "US", dec("100"), D(2024, 10, 1), D(2024, 12, 30)),
        ("d", "n", "Meta", "app_installs", "US", dec("100"), D(2024, 11, 5), D(2024, 11, 5)),
        (None, "n", "Meta", "app_installs", "US", dec("100"), D(2024, 11, 5), None),
    ]
    out = stg.stg_campaigns(spark.createDataFrame(data, S.CAMPAIGNS), as_of)
    got = {r.campaign_id: (r.is_active, r.campaign_duration_days) for r in out.collect()}
    assert got == {"a": (True, None), "b": (True, 91), "c": (False, 90), "d": (False, 0)}


def test_cv_decode(spark):
    data = [(f"p{cv}", D(2024, 10, 1), "c", "k", "Meta", "US", "4.0", cv, 1,
             K.PRIVACY_THRESHOLDS[cv % 3]) for cv in range(-1, 65)]
    out = stg.stg_skan_postbacks(spark.createDataFrame(data, S.SKAN_POSTBACKS))
    got = {r.conversion_value: r for r in out.collect()}
    assert sorted(got) == list(range(64))  # -1 and 64 dropped
    expect_bucket = {0: "no_event", 1: "engagement", 2: "engagement", 3: "trial_start",
                     4: "low_revenue", 7: "low_revenue", 8: "mid_revenue", 15: "mid_revenue",
                     16: "high_revenue", 63: "high_revenue"}
    for cv, b in expect_bucket.items():
        assert got[cv].cv_bucket == b
    expect_rev = {0: 0.0, 3: 0.0, 4: 9.99, 5: 9.99, 6: 14.99, 7: 14.99, 8: 29.99, 11: 29.99,
                  12: 49.99, 13: 49.99, 14: 79.99, 15: 79.99, 16: 102.99, 63: 243.99}
    for cv, v in expect_rev.items():
        assert math.isclose(got[cv].estimated_revenue_usd, v, abs_tol=1e-9), cv
    assert [got[cv].has_revenue_signal for cv in (3, 4)] == [False, True]
    assert {got[cv].privacy_threshold: got[cv].cv_quality for cv in (0, 1, 2)} == {
        "none": "fine", "low": "coarse", "medium": "coarse"}


def test_iap(spark):
    rows_in = []
    products = ["weekly_sub", "monthly_sub", "annual_sub", "lifetime", "coins"]
    for i, (p, t) in enumerate(zip(products, K.EVENT_TYPES + ("purchase",))):
        rows_in.append((f"e{i}", D(2024, 10, 1), D(2024, 10, 1 + i), "c", "k", "Meta", "US",
                        t, p, dec("24.0000")))
    rows_in.append(("late", D(2024, 10, 5), D(2024, 10, 4), "c", "k", "Meta", "US",
                    "purchase", "lifetime", dec("24.0000")))   # event before install
    rows_in.append(("nt", D(2024, 10, 1), D(2024, 10, 2), "c", "k", "Meta", "US",
                    None, "lifetime", dec("24.0000")))         # NULL type
    out = stg.stg_iap_events(spark.createDataFrame(rows_in, S.IAP_EVENTS))
    got = {r.event_id: r for r in out.collect()}
    assert "late" not in got
    assert [got[f"e{i}"].product_tier for i in range(5)] == [
        "weekly", "monthly", "annual", "lifetime", "other"]
    assert [got[f"e{i}"].days_since_install for i in range(5)] == [0, 1, 2, 3, 4]
    assert got["e0"].is_revenue_event is False and got["e1"].is_revenue_event is True
    assert got["nt"].is_revenue_event is False
    me = [got[f"e{i}"].monthly_equivalent_usd for i in range(5)]
    assert [round(x, 6) for x in me] == [round(24 * 4.33, 6), 24.0, 2.0, 1.0, 24.0]


def test_rounding_ties(spark):
    """Half to even at 2, 4 and 6 decimals on values that are exact ties."""
    df = spark.createDataFrame([(0.125,), (0.375,), (2.5,)], "x double")
    from burnlens.functions.columns import rnd
    got = [r[0] for r in df.select(rnd("x", 2)).collect()]
    assert got == [0.12, 0.38, 2.5]
    df = spark.createDataFrame([(0.000125,), (0.000375,)], "x double")
    assert [r[0] for r in df.select(rnd(F.col("x") * 100, 4)).collect()] == [0.0125, 0.0375]
    df = spark.createDataFrame([(1, 16), (3, 16)], "a long, b long")
    from burnlens.functions.columns import ratio
    assert [r[0] for r in df.select(rnd(ratio("a", "b") / 10000, 6)).collect()] == [
        0.000006, 0.000019]
    df = spark.createDataFrame([(1, 8), (3, 8)], "a long, b long")
    from burnlens.functions.columns import ratio
    assert [r[0] for r in df.select(rnd(ratio("a", "b"), 2)).collect()] == [0.12, 0.38]


def test_adapter_matches_declared_schemas(models):
    for t, df in models.raw.items():
        declared = S.RAW_SCHEMAS[t]
        assert df.columns == declared.fieldNames(), t
        assert [f.dataType for f in df.schema.fields] == [f.dataType for f in declared.fields], t
