"""DuckDB twins of every registered query, for the correctness gate.

The SQL is written independently of the Spark code, from the model rules:
one WITH chain (adapter -> staging -> intermediate -> marts) and one final
SELECT per key. Exactness conventions match ``burnlens.functions.columns``:
``R`` rounds half to even on doubles, money is summed as DECIMAL(18,4).
"""

from __future__ import annotations

import re as _re

from burnlens.functions import constants as K
from burnlens.plans.models import DEFAULT_AS_OF

AS_OF = f"DATE '{DEFAULT_AS_OF.isoformat()}'"


def R(expr: str, n: int) -> str:
    s = f"CAST({10 ** n} AS DOUBLE)"
    return f"(round_even(CAST({expr} AS DOUBLE) * {s}, 0) / {s})"


def RAT(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0))"


def DSUM(expr: str, scale: int = 4) -> str:
    return f"CAST(SUM(CAST({expr} AS DECIMAL(18,{scale}))) AS DOUBLE)"


def D(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


def L(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


NET, CTRY = L(K.NETWORKS), L(K.COUNTRIES)
THR = D(K.BURNOUT_CTR_THRESHOLD)
MINI = K.MIN_IMPRESSIONS_FOR_BURNOUT

CTES: list[tuple[str, str]] = []


def cte(name: str, body: str) -> None:
    CTES.append((name, body))


# ------------------------------------------------------------------ adapter
cte("ln", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
       l_discount, l_returnflag, l_linestatus,
       DATE '2024-10-01' + CAST(datediff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) % 92 AS INTEGER) AS d,
       l_suppkey * 4 + l_partkey % 4 AS cnum
FROM lineitem""")

cte("raw_campaigns", f"""
SELECT 'cmp_' || CAST(s_suppkey AS VARCHAR) AS campaign_id,
       'UA ' || s_name AS campaign_name,
       {NET}[s_suppkey % 5 + 1] AS network,
       {L(K.OBJECTIVES)}[s_suppkey % 2 + 1] AS objective,
       {CTRY}[s_suppkey % 6 + 1] AS country,
       CAST(ABS(s_acctbal) / 2 AS DECIMAL(18,4)) AS daily_budget,
       DATE '2024-10-01' + CAST(s_suppkey % 21 AS INTEGER) AS start_date,
       CASE WHEN s_suppkey % 10 >= 7
            THEN DATE '2024-10-01' + CAST(s_suppkey % 21 AS INTEGER) + CAST(30 + s_suppkey % 31 AS INTEGER)
       END AS end_date
FROM supplier""")

cte("raw_creatives", f"""
SELECT 'cre_' || CAST(cnum AS VARCHAR) AS creative_id,
       'cmp_' || CAST(l_suppkey AS VARCHAR) AS campaign_id,
       {L(K.FORMATS)}[cnum % 4 + 1] || '_' || CAST(cnum AS VARCHAR) AS creative_name,
       {L(K.FORMATS)}[cnum % 4 + 1] AS format,
       {L(K.SIZES)}[cnum % 3 + 1] AS size,
       MIN(d) + CAST(cnum % 3 AS INTEGER) AS launch_date
FROM ln GROUP BY cnum, l_suppkey""")

cte("raw_ad_daily_stats", f"""
SELECT d AS stat_date,
       'cmp_' || CAST(l_suppkey AS VARCHAR) AS campaign_id,
       'cre_' || CAST(cnum AS VARCHAR) AS creative_id,
       {NET}[l_suppkey % 5 + 1] AS network,
       {CTRY}[l_suppkey % 6 + 1] AS country,
       CAST(SUM(l_quantity) * 100 AS BIGINT) AS impressions,
       CAST(SUM(l_quantity * (1 + round(l_discount * 100))) AS BIGINT) AS clicks,
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) * 0.01 AS DECIMAL(18,4)) AS spend_usd,
       CAST(SUM(l_linenumber - 1) AS BIGINT) AS installs
FROM ln GROUP BY d, cnum, l_suppkey""")

cte("raw_skan_postbacks", f"""
SELECT 'pb_' || CAST(l_orderkey AS VARCHAR) || '_' || CAST(l_linenumber AS VARCHAR) AS postback_id,
       d + CAST(l_orderkey % 2 AS INTEGER) AS install_date,
       'cmp_' || CAST(l_suppkey AS VARCHAR) AS campaign_id,
       'cre_' || CAST(cnum AS VARCHAR) AS creative_id,
       {NET}[l_suppkey % 5 + 1] AS network,
       {CTRY}[l_suppkey % 6 + 1] AS country,
       CASE WHEN l_linestatus = 'O' THEN '4.0' ELSE '3.0' END AS skan_version,
       CAST((l_orderkey + l_partkey) % 64 AS INTEGER) AS conversion_value,
       CAST(1 + l_linenumber % 3 AS INTEGER) AS postback_sequence,
       CASE WHEN l_returnflag = 'N' THEN 'none' WHEN l_returnflag = 'R' THEN 'low'
            WHEN l_returnflag = 'A' THEN 'medium' END AS privacy_threshold
FROM ln""")

_EV = f"{L(K.EVENT_TYPES)}[l_linenumber % 4 + 1]"
cte("raw_iap_events", f"""
SELECT 'ev_' || CAST(l_orderkey AS VARCHAR) || '_' || CAST(l_linenumber AS VARCHAR) AS event_id,
       d AS install_date,
       d + CAST(l_quantity AS INTEGER) % 40 AS event_date,
       'cmp_' || CAST(l_suppkey AS VARCHAR) AS campaign_id,
       'cre_' || CAST(cnum AS VARCHAR) AS creative_id,
       {NET}[l_suppkey % 5 + 1] AS network,
       {CTRY}[l_suppkey % 6 + 1] AS country,
       {_EV} AS event_type,
       ['weekly_sub', 'monthly_sub', 'annual_sub', 'lifetime', 'coins_pack'][l_partkey % 5 + 1] AS product_id,
       CAST(CASE WHEN {_EV} = 'trial_start' THEN 0
                 ELSE [9.99, 29.99, 79.99, 199.99, 4.99][l_partkey % 5 + 1] * (1 + (l_suppkey % 8) * 5)
            END AS DECIMAL(18,4)) AS revenue_usd
FROM ln""")

# ------------------------------------------------------------------ staging
cte("stg_campaigns", f"""
SELECT campaign_id, campaign_name, network, objective, country,
       CAST(daily_budget AS DOUBLE) AS daily_budget_usd,
       start_date, end_date,
       CASE WHEN end_date IS NULL OR end_date >= {AS_OF} THEN true ELSE false END AS is_active,
       CAST(datediff('day', start_date, end_date) AS INTEGER) AS campaign_duration_days
FROM raw_campaigns WHERE campaign_id IS NOT NULL""")

cte("stg_creatives", """
SELECT creative_id, campaign_id, creative_name, format, size, launch_date,
       CASE WHEN format IN ('video_15s', 'video_30s') THEN 'video'
            WHEN format = 'static_image' THEN 'static'
            WHEN format = 'carousel' THEN 'carousel'
            ELSE 'other' END AS format_group,
       CASE WHEN format IN ('video_15s', 'video_30s') THEN true ELSE false END AS is_video,
       CASE WHEN format = 'video_15s' THEN 15 WHEN format = 'video_30s' THEN 30 END AS video_length_seconds
FROM raw_creatives WHERE creative_id IS NOT NULL""")

cte("stg_ad_stats", f"""
SELECT stat_date, campaign_id, creative_id, network, country,
       impressions, clicks, CAST(spend_usd AS DOUBLE) AS spend_usd, installs,
       {R(RAT('clicks', 'impressions'), 6)} AS ctr,
       {R(RAT('installs', 'clicks'), 6)} AS cvr_click_to_install,
       {R(RAT('spend_usd', 'installs'), 4)} AS cpi_usd,
       {R(RAT('spend_usd', 'impressions') + ' * 1000', 4)} AS cpm_usd,
       {R(RAT('spend_usd', 'clicks'), 4)} AS cpc_usd
FROM raw_ad_daily_stats
WHERE stat_date IS NOT NULL AND campaign_id IS NOT NULL AND creative_id IS NOT NULL
  AND spend_usd >= 0 AND impressions >= 0""")

cte("stg_skan_postbacks", f"""
SELECT postback_id, install_date, campaign_id, creative_id, network, country, skan_version,
       conversion_value, postback_sequence, privacy_threshold,
       CASE WHEN conversion_value = 0 THEN 'no_event'
            WHEN conversion_value BETWEEN 1 AND 2 THEN 'engagement'
            WHEN conversion_value = 3 THEN 'trial_start'
            WHEN conversion_value BETWEEN 4 AND 7 THEN 'low_revenue'
            WHEN conversion_value BETWEEN 8 AND 15 THEN 'mid_revenue'
            WHEN conversion_value BETWEEN 16 AND 63 THEN 'high_revenue' END AS cv_bucket,
       CASE WHEN conversion_value BETWEEN 0 AND 3 THEN {D(0.0)}
            WHEN conversion_value BETWEEN 4 AND 5 THEN {D(9.99)}
            WHEN conversion_value BETWEEN 6 AND 7 THEN {D(14.99)}
            WHEN conversion_value BETWEEN 8 AND 11 THEN {D(29.99)}
            WHEN conversion_value BETWEEN 12 AND 13 THEN {D(49.99)}
            WHEN conversion_value BETWEEN 14 AND 15 THEN {D(79.99)}
            ELSE (conversion_value - 15) * {D(3.0)} + {D(99.99)} END AS estimated_revenue_usd,
       CASE WHEN conversion_value >= 4 THEN true ELSE false END AS has_revenue_signal,
       CASE WHEN privacy_threshold = 'none' THEN 'fine' ELSE 'coarse' END AS cv_quality
FROM raw_skan_postbacks
WHERE postback_id IS NOT NULL AND install_date IS NOT NULL AND conversion_value BETWEEN 0 AND 63""")

cte("stg_iap_events", f"""
SELECT event_id, install_date, event_date, campaign_id, creative_id, network, country,
       event_type, product_id, CAST(revenue_usd AS DOUBLE) AS revenue_usd,
       CAST(datediff('day', install_date, event_date) AS INTEGER) AS days_since_install,
       CASE WHEN product_id = 'weekly_sub' THEN 'weekly' WHEN product_id = 'monthly_sub' THEN 'monthly'
            WHEN product_id = 'annual_sub' THEN 'annual' WHEN product_id = 'lifetime' THEN 'lifetime'
            ELSE 'other' END AS product_tier,
       CASE WHEN event_type <> 'trial_start' THEN true ELSE false END AS is_revenue_event,
       CASE WHEN product_id = 'weekly_sub' THEN CAST(revenue_usd AS DOUBLE) * {D(4.33)}
            WHEN product_id = 'monthly_sub' THEN CAST(revenue_usd AS DOUBLE) * {D(1.0)}
            WHEN product_id = 'annual_sub' THEN CAST(revenue_usd AS DOUBLE) / {D(12.0)}
            WHEN product_id = 'lifetime' THEN CAST(revenue_usd AS DOUBLE) / {D(24.0)}
            ELSE CAST(revenue_usd AS DOUBLE) END AS monthly_equivalent_usd
FROM raw_iap_events
WHERE event_id IS NOT NULL AND install_date IS NOT NULL AND event_date >= install_date
  AND revenue_usd >= 0""")

# ---------------------------------------------------------- creative chain
_WC = "PARTITION BY s.creative_id ORDER BY s.stat_date, s.campaign_id, s.network, s.country"
cte("int_creative_daily_metrics", f"""
SELECT s.stat_date, s.campaign_id, s.creative_id, s.network, s.country,
       c.creative_name, c.format, c.format_group, c.is_video, c.launch_date, camp.objective,
       CAST(datediff('day', c.launch_date, s.stat_date) AS INTEGER) AS day_of_life,
       s.impressions, s.clicks, s.spend_usd, s.installs,
       s.ctr, s.cvr_click_to_install, s.cpi_usd, s.cpm_usd, s.cpc_usd,
       CAST(SUM(CAST(s.ctr AS DECIMAL(18,6))) OVER w7 AS DOUBLE) / COUNT(s.ctr) OVER w7 AS ctr_7d_avg,
       MAX(s.ctr) OVER wc AS ctr_peak_so_far,
       CAST(SUM(CAST(s.spend_usd AS DECIMAL(18,4))) OVER wc AS DOUBLE) AS cumulative_spend_usd,
       CAST(SUM(s.installs) OVER wc AS BIGINT) AS cumulative_installs
FROM stg_ad_stats s
JOIN stg_creatives c ON c.creative_id = s.creative_id
JOIN stg_campaigns camp ON camp.campaign_id = s.campaign_id
WHERE s.stat_date >= c.launch_date
WINDOW w7 AS ({_WC} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),
       wc AS ({_WC} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")

cte("int_creative_peaks", f"""
SELECT creative_id,
       MAX(ctr) AS absolute_peak_ctr,
       MIN(stat_date) AS first_stat_date,
       FIRST(day_of_life ORDER BY ctr DESC, day_of_life ASC) AS peak_day_of_life
FROM int_creative_daily_metrics
WHERE impressions >= {MINI}
GROUP BY creative_id""")

cte("int_burnout_events", f"""
SELECT d.creative_id, MIN(d.stat_date) AS burnout_date, MIN(d.day_of_life) AS burnout_day_of_life
FROM int_creative_daily_metrics d
JOIN int_creative_peaks p ON p.creative_id = d.creative_id
WHERE d.impressions >= {MINI}
  AND d.ctr_7d_avg < p.absolute_peak_ctr * {THR}
  AND d.day_of_life > p.peak_day_of_life
GROUP BY d.creative_id""")

_POST = "be.burnout_date IS NOT NULL AND d.stat_date >= be.burnout_date"
_SCORE = f"{D(1.0)} - {RAT('d.ctr_7d_avg', 'p.absolute_peak_ctr')}"
cte("mart_creative_burnout", f"""
SELECT d.stat_date, d.creative_id, d.campaign_id, d.network, d.country, d.creative_name,
       d.format, d.format_group, d.is_video, d.launch_date, d.day_of_life,
       d.impressions, d.clicks, d.spend_usd, d.installs, d.ctr, d.ctr_7d_avg, d.cpi_usd,
       d.cumulative_spend_usd, d.cumulative_installs,
       p.absolute_peak_ctr, p.peak_day_of_life, be.burnout_date, be.burnout_day_of_life,
       {R(f"CASE WHEN ({_SCORE}) IS NOT NULL THEN greatest({D(0.0)}, {_SCORE}) END", 4)} AS burnout_score,
       CASE WHEN d.day_of_life <= p.peak_day_of_life THEN 'warming_up'
            WHEN be.burnout_date IS NULL OR d.stat_date < be.burnout_date THEN 'peak'
            WHEN d.ctr_7d_avg >= p.absolute_peak_ctr * {THR} THEN 'declining'
            ELSE 'burnt' END AS lifecycle_stage,
       CASE WHEN {_POST} THEN true ELSE false END AS is_post_burnout,
       CASE WHEN {_POST} THEN d.spend_usd ELSE {D(0.0)} END AS wasted_spend_usd,
       {R(RAT('d.ctr_7d_avg', 'p.absolute_peak_ctr'), 4)} AS ctr_vs_peak_ratio,
       {R(RAT('d.cpi_usd', 'MIN(d.cpi_usd) OVER (PARTITION BY d.creative_id)'), 4)} AS cpi_vs_best_ratio
FROM (SELECT * FROM int_creative_daily_metrics WHERE impressions >= {MINI}) d
JOIN int_creative_peaks p ON p.creative_id = d.creative_id
LEFT JOIN int_burnout_events be ON be.creative_id = d.creative_id""")

# ------------------------------------------------------------ cohort chain
cte("int_cohort_installs", f"""
SELECT s.stat_date AS install_date, s.campaign_id, s.creative_id, s.network, s.country,
       camp.objective, cre.format, cre.format_group,
       CAST(SUM(s.installs) AS BIGINT) AS cohort_installs,
       {DSUM('s.spend_usd')} AS cohort_spend_usd,
       CAST(SUM(s.clicks) AS BIGINT) AS cohort_clicks,
       CAST(SUM(s.impressions) AS BIGINT) AS cohort_impressions,
       {R(RAT(DSUM('s.spend_usd'), 'SUM(s.installs)'), 4)} AS cac_usd,
       {R(RAT('SUM(s.installs)', 'SUM(s.clicks)'), 6)} AS install_cvr
FROM stg_ad_stats s
JOIN stg_campaigns camp ON camp.campaign_id = s.campaign_id
JOIN stg_creatives cre ON cre.creative_id = s.creative_id
WHERE s.installs > 0
GROUP BY s.stat_date, s.campaign_id, s.creative_id, s.network, s.country,
         camp.objective, cre.format, cre.format_group""")

cte("daily_revenue", f"""
SELECT install_date, campaign_id, creative_id, network, country, days_since_install,
       {DSUM('revenue_usd')} AS daily_revenue_usd
FROM stg_iap_events WHERE is_revenue_event = true
GROUP BY install_date, campaign_id, creative_id, network, country, days_since_install""")

cte("int_cohort_revenue", f"""
SELECT cr.install_date, cr.campaign_id, cr.creative_id, cr.network, cr.country,
       cr.days_since_install, cr.daily_revenue_usd, cr.cumulative_revenue_usd,
       ci.cohort_installs, ci.cohort_spend_usd, ci.cac_usd,
       {R(RAT('cr.cumulative_revenue_usd', 'ci.cohort_installs'), 4)} AS ltv_usd,
       {R(RAT('cr.cumulative_revenue_usd', 'ci.cohort_spend_usd'), 4)} AS roas
FROM (
  SELECT *, CAST(SUM(CAST(daily_revenue_usd AS DECIMAL(18,4))) OVER (
              PARTITION BY install_date, campaign_id, creative_id
              ORDER BY days_since_install, network, country
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS cumulative_revenue_usd
  FROM daily_revenue) cr
LEFT JOIN (
  SELECT install_date, campaign_id, creative_id, cohort_installs, cohort_spend_usd,
         {R(RAT('cohort_spend_usd', 'cohort_installs'), 4)} AS cac_usd
  FROM (SELECT install_date, campaign_id, creative_id, CAST(SUM(cohort_installs) AS BIGINT) AS cohort_installs,
               {DSUM('cohort_spend_usd')} AS cohort_spend_usd
        FROM int_cohort_installs GROUP BY install_date, campaign_id, creative_id)) ci
  ON ci.install_date = cr.install_date AND ci.campaign_id = cr.campaign_id
 AND ci.creative_id = cr.creative_id""")


def _sum_if(cond: str, col: str = "ra.revenue_usd") -> str:
    return f"CAST(SUM(CASE WHEN {cond} THEN CAST({col} AS DECIMAL(18,4)) ELSE 0 END) AS DOUBLE)"


cte("cohort_base_q", f"""
SELECT install_date, network, country,
       CAST(SUM(cohort_installs) AS BIGINT) AS total_installs,
       {DSUM('cohort_spend_usd')} AS total_spend_usd,
       CAST(SUM(CAST(cac_usd AS DECIMAL(18,4))) AS DOUBLE) / COUNT(cac_usd) AS avg_cac_usd
FROM int_cohort_installs GROUP BY install_date, network, country""")

cte("revenue_rollup_q", f"""
SELECT install_date, network, country, days_since_install,
       {DSUM('daily_revenue_usd')} AS revenue_usd,
       {DSUM('cumulative_revenue_usd')} AS cum_revenue_usd,
       FIRST(cohort_installs ORDER BY campaign_id, creative_id)
         FILTER (WHERE cohort_installs IS NOT NULL) AS installs,
       FIRST(cohort_spend_usd ORDER BY campaign_id, creative_id)
         FILTER (WHERE cohort_spend_usd IS NOT NULL) AS spend_usd
FROM int_cohort_revenue
GROUP BY install_date, network, country, days_since_install""")

_DAYS = sorted({0, *K.COHORT_DAYS})


def _rev_through(d: int, dsi: str = "ra.days_since_install", col: str = "ra.revenue_usd") -> str:
    op = "=" if d == 0 else "<="
    return _sum_if(f"{dsi} {op} {d}", col)


cte("cohort_wide_sums_q", f"""
SELECT cb.install_date, cb.network, cb.country, cb.total_installs, cb.total_spend_usd,
       cb.avg_cac_usd,
       {', '.join(f"{_rev_through(d)} AS rev_d{d}" for d in _DAYS)}
FROM cohort_base_q cb
LEFT JOIN revenue_rollup_q ra
  ON cb.install_date = ra.install_date AND cb.network = ra.network AND cb.country = ra.country
GROUP BY cb.install_date, cb.network, cb.country, cb.total_installs, cb.total_spend_usd,
         cb.avg_cac_usd""")

_cohort_cols = [f"{R(RAT(f'rev_d{d}', 'total_installs'), 4)} AS arpu_d{d}" for d in _DAYS]
_cohort_cols += [f"{R(f'rev_d{d}', 2)} AS revenue_d{d}_usd" for d in (7, 14, 30)]
_cohort_cols += [f"{R(RAT(f'rev_d{d}', 'total_spend_usd'), 4)} AS roas_d{d}" for d in (7, 14, 30)]
cte("mart_cohort_analysis", f"""
SELECT install_date, network, country, total_installs, total_spend_usd,
       {R('avg_cac_usd', 4)} AS cac_usd,
       {', '.join(_cohort_cols)},
       CAST(date_trunc('week', install_date) AS DATE) AS install_week
FROM cohort_wide_sums_q""")


cte("campaign_cohorts_q", f"""
SELECT ci.campaign_id, ci.network, ci.country, camp.campaign_name, camp.objective,
       camp.daily_budget_usd,
       CAST(SUM(ci.cohort_installs) AS BIGINT) AS total_installs,
       {DSUM('ci.cohort_spend_usd')} AS total_spend_usd,
       {R(RAT(DSUM('ci.cohort_spend_usd'), 'SUM(ci.cohort_installs)'), 4)} AS cac_usd
FROM int_cohort_installs ci JOIN stg_campaigns camp ON camp.campaign_id = ci.campaign_id
GROUP BY ci.campaign_id, ci.network, ci.country, camp.campaign_name, camp.objective,
         camp.daily_budget_usd""")

cte("ltv_checkpoints_q", f"""
SELECT campaign_id, network, country,
       {_sum_if('days_since_install <= 7', 'daily_revenue_usd')} AS rev_7,
       {_sum_if('days_since_install <= 14', 'daily_revenue_usd')} AS rev_14,
       {_sum_if('days_since_install <= 30', 'daily_revenue_usd')} AS rev_30,
       {DSUM('daily_revenue_usd')} AS total_revenue_usd,
       FIRST(cohort_installs ORDER BY install_date, creative_id)
         FILTER (WHERE cohort_installs IS NOT NULL) AS first_cohort_installs
FROM int_cohort_revenue GROUP BY campaign_id, network, country""")


def _unit_economics(den: str) -> str:
    ltv = {d: RAT(f"lv.rev_{d}", den) for d in (7, 14, 30)}
    ltv_total = RAT("lv.total_revenue_usd", den)
    b = K.PAYBACK_BUCKETS
    return f"""
SELECT cc.campaign_id, cc.campaign_name, cc.network, cc.country, cc.objective, cc.daily_budget_usd,
       cc.total_installs, cc.total_spend_usd, cc.cac_usd,
       {', '.join(f"{R(ltv[d], 4)} AS ltv_d{d}_usd" for d in (7, 14, 30))},
       {R(ltv_total, 4)} AS ltv_total_usd,
       lv.total_revenue_usd,
       {', '.join(f"{R(RAT(ltv[d], 'cc.cac_usd'), 4)} AS roas_d{d}" for d in (7, 14, 30))},
       {R(RAT(ltv_total, 'cc.cac_usd'), 4)} AS roas_total,
       {R(RAT('lv.total_revenue_usd', 'cc.total_spend_usd'), 4)} AS campaign_roas,
       {', '.join(f"CASE WHEN {ltv[d]} >= cc.cac_usd THEN 'paid_back' ELSE 'not_yet' END AS payback_d{d}" for d in (7, 14, 30))},
       CASE WHEN {ltv[7]} >= cc.cac_usd THEN '{b[0]}'
            WHEN {ltv[14]} >= cc.cac_usd THEN '{b[1]}'
            WHEN {ltv[30]} >= cc.cac_usd THEN '{b[2]}'
            ELSE '{b[3]}' END AS payback_period_bucket
FROM campaign_cohorts_q cc
LEFT JOIN ltv_checkpoints_q lv
  ON lv.campaign_id = cc.campaign_id AND lv.network = cc.network AND lv.country = cc.country"""


cte("mart_unit_economics", _unit_economics("cc.total_installs"))
cte("mart_unit_economics_first_cohort", _unit_economics("lv.first_cohort_installs"))

# ----------------------------------------------------- campaign performance
_WCP = "PARTITION BY campaign_id ORDER BY stat_date, network, country"


def _xavg(col: str, scale: int, frame: str) -> str:
    w = f"OVER ({_WCP} ROWS BETWEEN {frame})"
    return f"(CAST(SUM(CAST({col} AS DECIMAL(18,{scale}))) {w} AS DOUBLE) / COUNT({col}) {w})"


cte("campaign_daily", f"""
SELECT s.stat_date, s.campaign_id, s.network, s.country,
       camp.campaign_name, camp.objective, camp.daily_budget_usd,
       CAST(SUM(s.impressions) AS BIGINT) AS impressions,
       CAST(SUM(s.clicks) AS BIGINT) AS clicks,
       {DSUM('s.spend_usd')} AS spend_usd,
       CAST(SUM(s.installs) AS BIGINT) AS installs,
       COUNT(DISTINCT s.creative_id) AS active_creatives,
       {R(RAT('SUM(s.clicks)', 'SUM(s.impressions)'), 6)} AS blended_ctr,
       {R(RAT(DSUM('s.spend_usd'), 'SUM(s.installs)'), 4)} AS blended_cpi_usd,
       {R(RAT(DSUM('s.spend_usd'), 'SUM(s.impressions)') + ' * 1000', 4)} AS blended_cpm_usd,
       {R(RAT(DSUM('s.spend_usd'), 'camp.daily_budget_usd'), 4)} AS budget_utilisation_rate
FROM stg_ad_stats s JOIN stg_campaigns camp ON camp.campaign_id = s.campaign_id
GROUP BY s.stat_date, s.campaign_id, s.network, s.country,
         camp.campaign_name, camp.objective, camp.daily_budget_usd""")

_TREND = R(RAT("blended_cpi_usd", _xavg("blended_cpi_usd", 4, "13 PRECEDING AND 1 PRECEDING")), 4)
cte("campaign_trends", f"""
SELECT *,
       {R(_xavg('blended_cpi_usd', 4, '6 PRECEDING AND CURRENT ROW'), 4)} AS cpi_7d_avg,
       {R(_xavg('blended_ctr', 6, '13 PRECEDING AND CURRENT ROW'), 6)} AS ctr_14d_avg,
       {R(f"CAST(SUM(CAST(spend_usd AS DECIMAL(18,4))) OVER ({_WCP} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE)", 2)} AS cumulative_spend_usd,
       CAST(SUM(installs) OVER ({_WCP} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cumulative_installs,
       CASE WHEN isnan({_TREND}) OR isinf({_TREND}) THEN NULL ELSE {_TREND} END AS cpi_trend_ratio
FROM campaign_daily""")

cte("mart_campaign_performance", f"""
SELECT *,
       CASE WHEN cpi_trend_ratio > {D(K.SATURATING_ABOVE)} THEN 'saturating'
            WHEN cpi_trend_ratio > {D(K.WATCH_ABOVE)} THEN 'watch'
            WHEN cpi_trend_ratio < {D(K.IMPROVING_BELOW)} THEN 'improving'
            ELSE 'stable' END AS saturation_flag,
       CASE WHEN budget_utilisation_rate > {D(K.OVER_BUDGET_ABOVE)} THEN true ELSE false END AS is_over_budget,
       CAST(date_trunc('week', stat_date) AS DATE) AS stat_week
FROM campaign_trends""")

# --------------------------------------------------------------- SKAN chain
_SK = "install_date, campaign_id, creative_id, network, country"
cte("int_skan_cv_mapping", f"""
SELECT {_SK}, skan_version, postback_sequence,
       COUNT(*) AS postback_count,
       COUNT(*) FILTER (WHERE privacy_threshold = 'none') AS fine_cv_count,
       COUNT(*) FILTER (WHERE privacy_threshold = 'low') AS low_threshold_count,
       COUNT(*) FILTER (WHERE privacy_threshold = 'medium') AS medium_threshold_count,
       COUNT(*) FILTER (WHERE cv_bucket = 'no_event') AS cv_no_event,
       COUNT(*) FILTER (WHERE cv_bucket = 'engagement') AS cv_engagement,
       COUNT(*) FILTER (WHERE cv_bucket = 'trial_start') AS cv_trial,
       COUNT(*) FILTER (WHERE cv_bucket = 'low_revenue') AS cv_low_revenue,
       COUNT(*) FILTER (WHERE cv_bucket = 'mid_revenue') AS cv_mid_revenue,
       COUNT(*) FILTER (WHERE cv_bucket = 'high_revenue') AS cv_high_revenue,
       COUNT(*) FILTER (WHERE has_revenue_signal = true) AS revenue_signal_count,
       {DSUM('estimated_revenue_usd')} AS estimated_revenue_usd,
       {R('AVG(conversion_value)', 2)} AS avg_conversion_value,
       {R(RAT('COUNT(*) FILTER (WHERE has_revenue_signal = true)', 'COUNT(*)'), 4)} AS monetisation_rate
FROM stg_skan_postbacks
GROUP BY {_SK}, skan_version, postback_sequence""")

cte("skan_ads_q", f"""
SELECT stat_date AS install_date, campaign_id, creative_id, network, country,
       CAST(SUM(installs) AS BIGINT) AS reported_installs, {DSUM('spend_usd')} AS spend_usd
FROM stg_ad_stats GROUP BY stat_date, campaign_id, creative_id, network, country""")

cte("skan_reconciled", f"""
  SELECT coalesce(s.install_date, a.install_date) AS install_date,
         coalesce(s.campaign_id, a.campaign_id) AS campaign_id,
         coalesce(s.creative_id, a.creative_id) AS creative_id,
         coalesce(s.network, a.network) AS network,
         coalesce(s.country, a.country) AS country,
         coalesce(s.postback_count, 0) AS skan_postbacks,
         coalesce(s.fine_cv_count, 0) AS fine_cv_postbacks,
         coalesce(s.low_threshold_count, 0) AS low_threshold_postbacks,
         coalesce(s.medium_threshold_count, 0) AS medium_threshold_postbacks,
         coalesce(s.cv_no_event, 0) AS cv_no_event,
         coalesce(s.cv_engagement, 0) AS cv_engagement,
         coalesce(s.cv_trial, 0) AS cv_trial,
         coalesce(s.cv_low_revenue, 0) AS cv_low_revenue,
         coalesce(s.cv_mid_revenue, 0) AS cv_mid_revenue,
         coalesce(s.cv_high_revenue, 0) AS cv_high_revenue,
         coalesce(s.revenue_signal_count, 0) AS revenue_signal_postbacks,
         coalesce(s.estimated_revenue_usd, {D(0.0)}) AS skan_estimated_revenue_usd,
         coalesce(s.monetisation_rate, {D(0.0)}) AS skan_monetisation_rate,
         coalesce(s.avg_conversion_value, {D(0.0)}) AS avg_cv,
         coalesce(a.reported_installs, 0) AS mmp_installs,
         coalesce(a.spend_usd, {D(0.0)}) AS spend_usd
  FROM (SELECT * FROM int_skan_cv_mapping WHERE postback_sequence = 1) s
  FULL OUTER JOIN skan_ads_q a
    ON s.install_date = a.install_date AND s.campaign_id = a.campaign_id
   AND s.creative_id = a.creative_id AND s.network = a.network AND s.country = a.country
""")

_RS = "(r.cv_low_revenue + r.cv_mid_revenue + r.cv_high_revenue)"
cte("mart_skan_attribution", f"""
SELECT r.*, camp.campaign_name, camp.objective,
       {R(RAT('r.skan_postbacks', 'r.mmp_installs'), 4)} AS skan_coverage_rate,
       {R(RAT('r.medium_threshold_postbacks', 'r.skan_postbacks'), 4)} AS privacy_loss_rate,
       {R(RAT('r.fine_cv_postbacks', 'r.skan_postbacks'), 4)} AS fine_signal_rate,
       {R(RAT(_RS, f'(r.cv_trial + {_RS})'), 4)} AS trial_to_revenue_rate,
       {R(RAT('r.spend_usd', 'r.skan_postbacks'), 4)} AS skan_cpi_usd,
       {R(RAT('r.skan_estimated_revenue_usd', 'r.spend_usd'), 4)} AS skan_roas
FROM skan_reconciled r
LEFT JOIN stg_campaigns camp ON camp.campaign_id = r.campaign_id""")


# ----------------------------------------------------- variant chains
def variant(names, suffix: str, subst: dict[str, str]) -> None:
    """Re-emit CTEs ``names`` as ``name + suffix`` reading substituted inputs."""
    bodies = dict(CTES)
    subst = dict(subst)
    for n in names:
        body = bodies[n]
        for src, dst in subst.items():
            body = _re.sub(rf"\b{src}\b", dst, body)
        cte(n + suffix, body)
        subst[n] = n + suffix


# First run of the incremental scenario: ad days up to the cutoff.
INC_CUTOFF = "DATE '2024-12-10'"
cte("stg_ad_stats_p", f"SELECT * FROM stg_ad_stats WHERE stat_date <= {INC_CUTOFF}")
variant(["int_creative_daily_metrics", "int_creative_peaks", "int_burnout_events",
         "mart_creative_burnout"], "_p", {"stg_ad_stats": "stg_ad_stats_p"})
cte("inc_since", "SELECT MAX(stat_date) - 14 AS since FROM mart_creative_burnout_p")
cte("inc_batch", """
SELECT * FROM mart_creative_burnout WHERE stat_date >= (SELECT since FROM inc_since)""")

# Stale cohorts of the backfill scenario: revenue known up to the cutoff.
STALE_CUTOFF = "DATE '2024-12-20'"
cte("stg_iap_events_s", f"SELECT * FROM stg_iap_events WHERE event_date <= {STALE_CUTOFF}")
variant(["daily_revenue", "int_cohort_revenue", "revenue_rollup_q", "cohort_wide_sums_q",
         "mart_cohort_analysis"], "_s", {"stg_iap_events": "stg_iap_events_s"})

# ------------------------------------------------------------ data quality
_ROW_KEYS = {
    "campaigns": ("campaign_id",),
    "creatives": ("creative_id",),
    "ad_daily_stats": ("stat_date", "campaign_id", "creative_id"),
    "skan_postbacks": ("postback_id",),
    "iap_events": ("event_id",),
}
_NOT_NULL = (
    ("campaigns", "campaign_id"), ("campaigns", "network"), ("campaigns", "daily_budget"),
    ("creatives", "creative_id"), ("creatives", "campaign_id"),
    ("ad_daily_stats", "stat_date"), ("ad_daily_stats", "campaign_id"),
    ("ad_daily_stats", "creative_id"), ("ad_daily_stats", "spend_usd"),
    ("skan_postbacks", "postback_id"), ("skan_postbacks", "conversion_value"),
    ("iap_events", "event_id"), ("iap_events", "revenue_usd"),
)
_UNIQUE = (("campaigns", "campaign_id"), ("creatives", "creative_id"),
           ("skan_postbacks", "postback_id"), ("iap_events", "event_id"))
_ACCEPTED = (
    ("campaigns", "network", K.NETWORKS), ("creatives", "format", K.FORMATS),
    ("skan_postbacks", "skan_version", K.SKAN_VERSIONS),
    ("skan_postbacks", "privacy_threshold", K.PRIVACY_THRESHOLDS),
    ("iap_events", "event_type", K.EVENT_TYPES),
)


def _key(t: str, alias: str = "") -> str:
    return "concat_ws('|', " + ", ".join(f"CAST({alias}{c} AS VARCHAR)" for c in _ROW_KEYS[t]) + ")"


def _inlist(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


cte("dq_not_null_q", "\nUNION ALL\n".join(
    f"SELECT 'not_null_{t}_{c}' AS test_name, {_key(t)} AS failing_key, CAST(1 AS BIGINT) AS n_rows "
    f"FROM raw_{t} WHERE {c} IS NULL" for t, c in _NOT_NULL))
cte("dq_unique_q", "\nUNION ALL\n".join(
    f"SELECT 'unique_{t}_{c}' AS test_name, CAST({c} AS VARCHAR) AS failing_key, "
    f"CAST(COUNT(*) AS BIGINT) AS n_rows FROM raw_{t} WHERE {c} IS NOT NULL "
    f"GROUP BY {c} HAVING COUNT(*) > 1" for t, c in _UNIQUE))
cte("dq_accepted_q", "\nUNION ALL\n".join(
    f"SELECT 'accepted_values_{t}_{c}' AS test_name, CAST({c} AS VARCHAR) AS failing_key, "
    f"CAST(COUNT(*) AS BIGINT) AS n_rows FROM raw_{t} "
    f"WHERE {c} IS NOT NULL AND {c} NOT IN ({_inlist(v)}) GROUP BY {c}" for t, c, v in _ACCEPTED))
cte("dq_relationships_q", f"""
SELECT 'relationships_creatives_campaign_id__campaigns' AS test_name, {_key('creatives', 'c.')} AS failing_key,
       CAST(1 AS BIGINT) AS n_rows
FROM raw_creatives c
WHERE c.campaign_id IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM raw_campaigns p WHERE p.campaign_id = c.campaign_id)""")
cte("dq_score_q", """
SELECT 'assert_burnout_score_range' AS test_name,
       concat_ws('|', CAST(creative_id AS VARCHAR), CAST(stat_date AS VARCHAR)) AS failing_key,
       CAST(1 AS BIGINT) AS n_rows
FROM mart_creative_burnout WHERE burnout_score < 0 OR burnout_score > 1""")
cte("dq_spend_q", f"""
SELECT 'assert_positive_spend' AS test_name, {_key('ad_daily_stats')} AS failing_key, CAST(1 AS BIGINT) AS n_rows
FROM stg_ad_stats WHERE spend_usd < 0
UNION ALL
SELECT 'assert_positive_spend_raw', {_key('ad_daily_stats')}, CAST(1 AS BIGINT)
FROM raw_ad_daily_stats WHERE spend_usd < 0""")
_ALL_TESTS = (
    [f"not_null_{t}_{c}" for t, c in _NOT_NULL]
    + [f"unique_{t}_{c}" for t, c in _UNIQUE]
    + [f"accepted_values_{t}_{c}" for t, c, _ in _ACCEPTED]
    + ["relationships_creatives_campaign_id__campaigns", "assert_burnout_score_range",
       "assert_positive_spend"]
)
cte("dq_summary_q", f"""
SELECT n.test_name, CAST(COALESCE(f.failures, 0) AS BIGINT) AS failures,
       CASE WHEN COALESCE(f.failures, 0) = 0 THEN 'PASS' ELSE 'FAIL' END AS status
FROM (VALUES {', '.join(f"('{t}')" for t in _ALL_TESTS)}) n(test_name)
LEFT JOIN (
  SELECT test_name, COUNT(*) AS failures FROM (
    SELECT test_name FROM dq_not_null_q UNION ALL SELECT test_name FROM dq_unique_q
    UNION ALL SELECT test_name FROM dq_accepted_q UNION ALL SELECT test_name FROM dq_relationships_q
    UNION ALL SELECT test_name FROM dq_score_q
    UNION ALL SELECT test_name FROM dq_spend_q WHERE test_name = 'assert_positive_spend'
  ) GROUP BY test_name) f ON f.test_name = n.test_name""")

# -------------------------------------------------------------------- BI
# Straight from the staged facts: every install, dollar and event once.
cte("weekly_cohort_q", f"""
SELECT install_week, CAST(SUM(installs) AS BIGINT) AS total_installs, {DSUM('spend')} AS total_spend_usd,
       {', '.join(f"{DSUM(f'rev_d{d}')} AS rev_d{d}" for d in _DAYS)}
FROM (
  SELECT CAST(date_trunc('week', a.stat_date) AS DATE) AS install_week, a.installs, a.spend_usd AS spend,
         {', '.join(f"0 AS rev_d{d}" for d in _DAYS)}
  FROM stg_ad_stats a
  WHERE a.installs > 0 AND a.campaign_id IN (SELECT campaign_id FROM stg_campaigns)
    AND a.creative_id IN (SELECT creative_id FROM stg_creatives)
  UNION ALL
  SELECT CAST(date_trunc('week', e.install_date) AS DATE), 0, 0,
         {', '.join(f"CASE WHEN e.days_since_install {'=' if d == 0 else '<='} {d} THEN e.revenue_usd ELSE 0 END" for d in _DAYS)}
  FROM stg_iap_events e
  WHERE e.is_revenue_event AND EXISTS (
    SELECT 1 FROM int_cohort_installs i
    WHERE i.install_date = e.install_date AND i.network = e.network AND i.country = e.country))
GROUP BY install_week""")


def _ctr_by_dol(where: str = "") -> str:
    return f"""
SELECT day_of_life, format_group, {R('AVG(ctr_7d_avg)', 6)} AS avg_ctr_7d,
       COUNT(*) AS creative_days
FROM mart_creative_burnout {where}
GROUP BY day_of_life, format_group"""


def _sum_when(cond: str, col: str) -> str:
    return f"CAST(SUM(CASE WHEN {cond} THEN CAST({col} AS DECIMAL(18,4)) ELSE 0 END) AS DOUBLE)"


# ------------------------------------------------------------------ queries
QUERIES: dict[str, str] = {}


def query(key: str, select: str) -> None:
    QUERIES[key] = select


def sel(key: str, model: str, *cols: str) -> None:
    query(key, f"SELECT {', '.join(cols) if cols else '*'} FROM {model}")


for _m in (
    "stg_campaigns", "stg_creatives", "stg_ad_stats", "stg_skan_postbacks", "stg_iap_events",
    "int_creative_daily_metrics", "int_creative_peaks", "int_burnout_events",
    "int_cohort_installs", "int_cohort_revenue", "int_skan_cv_mapping",
    "mart_creative_burnout", "mart_campaign_performance", "mart_cohort_analysis",
    "mart_unit_economics", "mart_unit_economics_first_cohort", "mart_skan_attribution",
):
    sel(_m, _m)

# sources and sinks
query("src_schema", "SELECT * REPLACE (CAST(spend_usd AS DOUBLE) AS spend_usd) FROM raw_ad_daily_stats")
query("src_csv", "SELECT * REPLACE (CAST(revenue_usd AS DOUBLE) AS revenue_usd) FROM raw_iap_events")
query("src_loaded_at", "SELECT * REPLACE (CAST(daily_budget AS DOUBLE) AS daily_budget), "
      "TIMESTAMP '2024-12-31 06:00:00' AS loaded_at FROM raw_campaigns")
query("sink_replace", "SELECT * REPLACE (CAST(spend_usd AS DOUBLE) AS spend_usd) FROM raw_ad_daily_stats")
query("load_row_counts", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM raw_{t}"
    for t in ("campaigns", "creatives", "ad_daily_stats", "skan_postbacks", "iap_events")))
query("sink_partition_month", "SELECT *, strftime(install_date, '%Y%m') AS ym FROM raw_skan_postbacks")
query("sink_sorted", "SELECT * REPLACE (CAST(revenue_usd AS DOUBLE) AS revenue_usd) FROM raw_iap_events")
sel("mat_view", "stg_creatives")
sel("mat_table", "int_creative_peaks")
sel("sink_export_csv", "mart_campaign_performance")
sel("sink_bi_types", "mart_creative_burnout")
sel("sink_export_json", "mart_unit_economics")

# staging fragments
sel("campaign_is_active", "stg_campaigns", "campaign_id", "end_date", "is_active")
sel("campaign_duration", "stg_campaigns", "campaign_id", "start_date", "end_date",
    "campaign_duration_days")
sel("creative_format_group", "stg_creatives", "creative_id", "format", "format_group")
sel("creative_is_video", "stg_creatives", "creative_id", "format", "is_video")
sel("creative_video_length", "stg_creatives", "creative_id", "format", "video_length_seconds")
sel("ad_ratio_metrics", "stg_ad_stats", "stat_date", "creative_id", "ctr", "cvr_click_to_install",
    "cpi_usd", "cpm_usd", "cpc_usd")
query("ad_row_filter", """
SELECT stat_date, campaign_id, creative_id, impressions, CAST(spend_usd AS DOUBLE) AS spend_usd
FROM raw_ad_daily_stats
WHERE stat_date IS NOT NULL AND campaign_id IS NOT NULL AND creative_id IS NOT NULL
  AND spend_usd >= 0 AND impressions >= 0""")
sel("skan_cv_bucket", "stg_skan_postbacks", "postback_id", "conversion_value", "cv_bucket")
sel("skan_cv_revenue", "stg_skan_postbacks", "postback_id", "conversion_value",
    "estimated_revenue_usd")
sel("skan_has_revenue", "stg_skan_postbacks", "postback_id", "conversion_value",
    "has_revenue_signal")
sel("skan_cv_quality", "stg_skan_postbacks", "postback_id", "privacy_threshold", "cv_quality")
query("skan_row_filter", """
SELECT postback_id, install_date, conversion_value FROM raw_skan_postbacks
WHERE postback_id IS NOT NULL AND install_date IS NOT NULL AND conversion_value BETWEEN 0 AND 63""")
sel("iap_days_since_install", "stg_iap_events", "event_id", "install_date", "event_date",
    "days_since_install")
sel("iap_product_tier", "stg_iap_events", "event_id", "product_id", "product_tier")
sel("iap_is_revenue_event", "stg_iap_events", "event_id", "event_type", "is_revenue_event")
sel("iap_monthly_equivalent", "stg_iap_events", "event_id", "product_id", "revenue_usd",
    "monthly_equivalent_usd")
query("iap_row_filter", """
SELECT event_id, install_date, event_date, CAST(revenue_usd AS DOUBLE) AS revenue_usd
FROM raw_iap_events
WHERE event_id IS NOT NULL AND install_date IS NOT NULL AND event_date >= install_date
  AND revenue_usd >= 0""")

# joins
query("join_ads_creatives_campaigns", """
SELECT s.stat_date, s.campaign_id, s.creative_id, c.launch_date, c.format, camp.objective
FROM stg_ad_stats s JOIN stg_creatives c ON c.creative_id = s.creative_id
JOIN stg_campaigns camp ON camp.campaign_id = s.campaign_id
WHERE s.stat_date >= c.launch_date""")
query("join_cohort_dims", """
SELECT s.stat_date, s.campaign_id, s.creative_id, camp.objective, cre.format, cre.format_group,
       s.installs
FROM stg_ad_stats s JOIN stg_campaigns camp ON camp.campaign_id = s.campaign_id
JOIN stg_creatives cre ON cre.creative_id = s.creative_id
WHERE s.installs > 0""")
query("join_metrics_peaks", f"""
SELECT d.creative_id, d.stat_date, d.day_of_life, d.ctr_7d_avg, p.absolute_peak_ctr,
       p.peak_day_of_life
FROM int_creative_daily_metrics d JOIN int_creative_peaks p ON p.creative_id = d.creative_id
WHERE d.impressions >= {MINI} AND d.ctr_7d_avg < p.absolute_peak_ctr * {THR}
  AND d.day_of_life > p.peak_day_of_life""")
sel("join_revenue_installs_left", "int_cohort_revenue", "install_date", "campaign_id",
    "creative_id", "network", "country", "days_since_install", "cohort_installs",
    "cohort_spend_usd")
query("join_burnout_optional", f"""
SELECT d.stat_date, d.creative_id, p.absolute_peak_ctr, p.peak_day_of_life, be.burnout_date,
       be.burnout_day_of_life
FROM (SELECT * FROM int_creative_daily_metrics WHERE impressions >= {MINI}) d
JOIN int_creative_peaks p ON p.creative_id = d.creative_id
LEFT JOIN int_burnout_events be ON be.creative_id = d.creative_id""")
query("join_cohort_revenue_left", """
SELECT cb.install_date, cb.network, cb.country, cb.total_installs, ra.days_since_install,
       ra.revenue_usd
FROM cohort_base_q cb LEFT JOIN revenue_rollup_q ra
  ON cb.install_date = ra.install_date AND cb.network = ra.network AND cb.country = ra.country""")
sel("join_unit_economics", "mart_unit_economics", "campaign_id", "network", "country",
    "campaign_name", "total_installs", "total_revenue_usd")
query("join_campaign_daily", """
SELECT s.stat_date, s.campaign_id, s.creative_id, camp.campaign_name, camp.daily_budget_usd,
       s.spend_usd
FROM stg_ad_stats s JOIN stg_campaigns camp ON camp.campaign_id = s.campaign_id""")
sel("join_skan_full_outer", "skan_reconciled")
sel("join_skan_campaign_left", "mart_skan_attribution", "install_date", "campaign_id",
    "creative_id", "network", "country", "campaign_name", "objective")

# aggregations
sel("agg_cohort_installs", "int_cohort_installs")
sel("agg_daily_revenue", "daily_revenue")
sel("agg_skan_distribution", "int_skan_cv_mapping")
sel("agg_peaks", "int_creative_peaks")
sel("agg_burnout_events", "int_burnout_events")
sel("agg_campaign_daily", "campaign_daily")
sel("agg_campaign_cohorts", "campaign_cohorts_q")
sel("agg_ltv_checkpoints", "ltv_checkpoints_q")
sel("agg_cohort_base", "cohort_base_q")
sel("agg_cohort_revenue_rollup", "revenue_rollup_q")
sel("agg_cohort_pivot", "mart_cohort_analysis", "install_date", "network", "country",
    *[f"arpu_d{d}" for d in (0, 1, 3, 7, 14, 30)],
    *[f"revenue_d{d}_usd" for d in (7, 14, 30)], *[f"roas_d{d}" for d in (7, 14, 30)])
sel("agg_skan_ads", "skan_ads_q")
sel("agg_group_by_alias", "mart_cohort_analysis", "install_date", "network", "country",
    "total_installs", "total_spend_usd", "cac_usd", "revenue_d7_usd")

# windows
_CDM = ("int_creative_daily_metrics", "creative_id", "stat_date")
_CP = ("mart_campaign_performance", "campaign_id", "stat_date", "network", "country")
_MCB = ("mart_creative_burnout", "creative_id", "stat_date")
sel("win_ctr_7d_avg", *_CDM, "ctr", "ctr_7d_avg")
sel("win_ctr_peak_so_far", *_CDM, "ctr", "ctr_peak_so_far")
sel("win_creative_cum_spend", *_CDM, "spend_usd", "cumulative_spend_usd")
sel("win_creative_cum_installs", *_CDM, "installs", "cumulative_installs")
sel("win_cum_revenue", "int_cohort_revenue", "install_date", "campaign_id", "creative_id",
    "network", "country", "days_since_install", "daily_revenue_usd", "cumulative_revenue_usd")
sel("win_cpi_7d_avg", *_CP, "blended_cpi_usd", "cpi_7d_avg")
sel("win_ctr_14d_avg", *_CP, "blended_ctr", "ctr_14d_avg")
sel("win_campaign_cum_spend", *_CP, "spend_usd", "cumulative_spend_usd")
sel("win_campaign_cum_installs", *_CP, "installs", "cumulative_installs")
sel("win_cpi_trend_ratio", *_CP, "blended_cpi_usd", "cpi_trend_ratio")
sel("win_cpi_vs_best", *_MCB, "cpi_usd", "cpi_vs_best_ratio")

# burnout mart column rules
sel("burnout_score", *_MCB, "ctr_7d_avg", "absolute_peak_ctr", "burnout_score")
sel("lifecycle_stage", *_MCB, "day_of_life", "peak_day_of_life", "burnout_date", "lifecycle_stage")
sel("is_post_burnout", *_MCB, "burnout_date", "is_post_burnout")
sel("wasted_spend", *_MCB, "spend_usd", "wasted_spend_usd")
sel("ctr_vs_peak_ratio", *_MCB, "ctr_7d_avg", "ctr_vs_peak_ratio")
sel("cpi_vs_best_ratio", *_MCB, "cpi_usd", "cpi_vs_best_ratio")

# sort and top-k
query("sort_campaign_performance",
      "SELECT * FROM mart_campaign_performance ORDER BY stat_date DESC, spend_usd DESC")
query("sort_cohort_analysis",
      "SELECT * FROM mart_cohort_analysis ORDER BY install_date, network, country")
query("sort_unit_economics", "SELECT * FROM mart_unit_economics ORDER BY campaign_roas DESC NULLS LAST")
query("sort_skan_attribution",
      "SELECT * FROM mart_skan_attribution ORDER BY install_date DESC, spend_usd DESC")
query("bi_top_burnt_creatives", f"""
SELECT creative_id, creative_name, {DSUM('wasted_spend_usd')} AS wasted_spend_usd,
       MAX(burnout_score) AS max_burnout_score, COUNT(*) AS burnt_days
FROM mart_creative_burnout WHERE lifecycle_stage = 'burnt'
GROUP BY creative_id, creative_name
ORDER BY wasted_spend_usd DESC, creative_id LIMIT 20""")

# scalar functions
query("fn_to_date", "SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS ship_date FROM lineitem")
sel("fn_to_uint64", "stg_ad_stats", "stat_date", "creative_id", "impressions", "clicks", "installs")
sel("fn_to_uint8", "stg_skan_postbacks", "postback_id", "conversion_value", "postback_sequence")
sel("fn_to_float64", "stg_iap_events", "event_id", "revenue_usd")
query("fn_today", f"SELECT campaign_id, end_date, {AS_OF} AS as_of, is_active FROM stg_campaigns")
sel("fn_date_diff_day", *_CDM, "launch_date", "day_of_life")
query("fn_to_monday", """
SELECT DISTINCT stat_date, CAST(date_trunc('week', stat_date) AS DATE) AS stat_week FROM stg_ad_stats""")
query("fn_interval", """
SELECT creative_id, MAX(stat_date) AS last_date, MAX(stat_date) - 14 AS reprocess_from
FROM int_creative_daily_metrics GROUP BY creative_id""")
query("fn_month_key", "SELECT DISTINCT stat_date, strftime(stat_date, '%Y%m') AS month_key FROM stg_ad_stats")
query("fn_round", f"""
SELECT stat_date, creative_id, {R(RAT('spend_usd', 'clicks'), 2)} AS cpc_2,
       {R(RAT('clicks', 'impressions'), 4)} AS ctr_4, {R(RAT('clicks', 'impressions'), 6)} AS ctr_6
FROM stg_ad_stats""")
query("fn_nullif", f"""
SELECT stat_date, creative_id, {RAT('clicks', 'impressions')} AS ctr_raw,
       {RAT('installs', 'clicks')} AS cvr_raw
FROM stg_ad_stats""")
sel("fn_if", *_MCB, "burnout_date", "is_post_burnout", "wasted_spend_usd")
sel("fn_case", *_MCB, "lifecycle_stage")
sel("fn_greatest", *_MCB, "ctr_7d_avg", "absolute_peak_ctr", "burnout_score")
sel("fn_nan_guard", *_CP, "cpi_trend_ratio", "saturation_flag")
sel("fn_coalesce", "skan_reconciled", "install_date", "campaign_id", "creative_id", "network",
    "country", "skan_postbacks", "mmp_installs", "spend_usd")
query("fn_between_in", """
SELECT postback_id, conversion_value, conversion_value BETWEEN 4 AND 15 AS low_or_mid_revenue,
       privacy_threshold IN ('low', 'medium') AS is_coarse, privacy_threshold IS NULL AS privacy_missing
FROM stg_skan_postbacks""")
query("fn_safe_divide", f"""
SELECT stat_date, creative_id,
       CASE WHEN installs IS NULL OR installs = 0 THEN {D(0.0)}
            ELSE CAST(spend_usd AS DOUBLE) / CAST(installs AS DOUBLE) END AS cpi_or_zero
FROM stg_ad_stats""")

# incremental, backfill, refresh
query("inc_window_filter", f"""
SELECT creative_id, stat_date, impressions, ctr_7d_avg FROM int_creative_daily_metrics
WHERE impressions >= {MINI} AND stat_date >= (SELECT since FROM inc_since)""")
query("inc_delete_insert", """
SELECT * FROM mart_creative_burnout_p t
WHERE NOT EXISTS (SELECT 1 FROM inc_batch b
                  WHERE b.creative_id = t.creative_id AND b.stat_date = t.stat_date)
UNION ALL
SELECT * FROM inc_batch""")
query("inc_delete_insert_compat", f"""
SELECT * FROM mart_creative_burnout_p t
WHERE NOT EXISTS (SELECT 1 FROM inc_batch b
                  WHERE b.creative_id = t.creative_id AND b.stat_date = t.stat_date)
UNION ALL
SELECT * REPLACE (
  {R(RAT('cpi_usd', 'MIN(cpi_usd) OVER (PARTITION BY creative_id)'), 4)} AS cpi_vs_best_ratio)
FROM inc_batch""")
sel("inc_full_refresh", "mart_creative_burnout")
query("backfill_window", f"""
SELECT * FROM mart_cohort_analysis_s WHERE install_date < {AS_OF} - {K.BACKFILL_DAYS}
UNION ALL
SELECT * FROM mart_cohort_analysis WHERE install_date >= {AS_OF} - {K.BACKFILL_DAYS}""")


def _refresh(models) -> str:
    parts = [f"SELECT '{m}' AS model, COUNT(*) AS row_count FROM {m}" for m in models]
    parts.append("SELECT 'dq_failed_tests', COUNT(*) FILTER (WHERE status = 'FAIL') FROM dq_summary_q")
    return "\nUNION ALL\n".join(parts)


query("refresh_daily", _refresh((
    "int_creative_daily_metrics", "int_creative_peaks", "int_burnout_events",
    "int_cohort_installs", "int_cohort_revenue", "int_skan_cv_mapping",
    "mart_creative_burnout", "mart_campaign_performance", "mart_cohort_analysis",
    "mart_unit_economics", "mart_skan_attribution")))
query("refresh_daily_incremental", QUERIES["inc_delete_insert"])
query("refresh_weekly", _refresh((
    "int_cohort_installs", "int_cohort_revenue", "mart_cohort_analysis",
    "mart_unit_economics", "int_creative_daily_metrics", "mart_creative_burnout")))

# data quality
sel("dq_not_null", "dq_not_null_q")
sel("dq_unique", "dq_unique_q")
query("dq_unique_append", """
SELECT * FROM dq_unique_q WHERE test_name IN ('unique_skan_postbacks_postback_id', 'unique_iap_events_event_id')""")
query("agg_active_creatives", """
SELECT 'day' AS grain, stat_date AS period, campaign_id, count(DISTINCT creative_id) AS active_creatives FROM stg_ad_stats GROUP BY ALL
UNION ALL
SELECT 'week', CAST(date_trunc('week', stat_date) AS DATE), campaign_id, count(DISTINCT creative_id) FROM stg_ad_stats GROUP BY ALL
UNION ALL
SELECT 'all', NULL, campaign_id, count(DISTINCT creative_id) FROM stg_ad_stats GROUP BY ALL""")
sel("dq_accepted_values", "dq_accepted_q")
sel("dq_relationships", "dq_relationships_q")
sel("dq_burnout_score_range", "dq_score_q")
sel("dq_positive_spend", "dq_spend_q")
sel("dq_summary", "dq_summary_q")

# BI
query("bi_ctr_by_day_of_life", _ctr_by_dol())
query("bi_burnout_scatter", f"""
SELECT creative_id, creative_name, format_group, MAX(burnout_day_of_life) AS burnout_day_of_life,
       {DSUM('wasted_spend_usd')} AS wasted_spend_usd, MAX(cumulative_spend_usd) AS cumulative_spend_usd
FROM mart_creative_burnout GROUP BY creative_id, creative_name, format_group""")
query("bi_total_wasted_spend",
      f"SELECT {DSUM('wasted_spend_usd')} AS total_wasted_spend_usd FROM mart_creative_burnout")
query("bi_slicer", _ctr_by_dol("WHERE network = 'Meta' AND format_group = 'video'"))
query("bi_cac_by_network", f"""
SELECT network, CAST(SUM(total_installs) AS BIGINT) AS total_installs,
       {DSUM('total_spend_usd')} AS total_spend_usd,
       {R(RAT(DSUM('total_spend_usd'), 'SUM(total_installs)'), 4)} AS cac_usd
FROM mart_unit_economics GROUP BY network""")
query("bi_ltv_curve", f"""
SELECT r.network, r.cohort_day, r.revenue_usd, i.installs,
       {R(RAT('r.revenue_usd', 'i.installs'), 4)} AS ltv_usd
FROM ({' UNION ALL '.join(
    f"SELECT network, {d} AS cohort_day, {_sum_when(f'days_since_install <= {d}', 'revenue_usd')} "
    f"AS revenue_usd FROM stg_iap_events WHERE is_revenue_event GROUP BY network" for d in (7, 14, 30))}) r
LEFT JOIN (SELECT network, CAST(SUM(cohort_installs) AS BIGINT) AS installs
           FROM int_cohort_installs GROUP BY network) i ON i.network = r.network""")
sel("bi_roas_matrix", "mart_unit_economics", "campaign_id", "campaign_name", "network", "country",
    "roas_d7", "roas_d14", "roas_d30")
query("bi_payback_distribution", """
SELECT payback_period_bucket, COUNT(*) AS campaigns FROM mart_unit_economics
GROUP BY payback_period_bucket""")
query("bi_arpu_heatmap", "\nUNION ALL\n".join(
    f"SELECT install_week, {d} AS cohort_day, {R(RAT(f'rev_d{d}', 'total_installs'), 4)} AS arpu_usd "
    f"FROM weekly_cohort_q" for d in _DAYS))
query("bi_roas_trend", f"""
SELECT install_week, total_spend_usd,
       {', '.join(f"{R(RAT(f'rev_d{d}', 'total_spend_usd'), 4)} AS roas_d{d}" for d in (7, 14, 30))}
FROM weekly_cohort_q""")
query("bi_installs_by_network_week", """
SELECT install_week, network, CAST(SUM(total_installs) AS BIGINT) AS total_installs
FROM mart_cohort_analysis GROUP BY install_week, network""")
query("bi_cv_bucket_distribution", "\nUNION ALL\n".join(
    f"SELECT '{c[3:]}' AS cv_bucket, CAST(SUM({c}) AS BIGINT) AS postbacks FROM mart_skan_attribution"
    for c in ("cv_no_event", "cv_engagement", "cv_trial", "cv_low_revenue", "cv_mid_revenue",
              "cv_high_revenue")))
query("bi_privacy_impact", """
SELECT network, CAST(SUM(fine_cv_postbacks) AS BIGINT) AS fine_cv_postbacks,
       CAST(SUM(low_threshold_postbacks) AS BIGINT) AS low_threshold_postbacks,
       CAST(SUM(medium_threshold_postbacks) AS BIGINT) AS medium_threshold_postbacks
FROM mart_skan_attribution GROUP BY network""")
query("bi_coverage_trend", f"""
SELECT d.install_date, COALESCE(p.n, 0) AS skan_postbacks, CAST(COALESCE(a.n, 0) AS BIGINT) AS mmp_installs,
       {R(RAT('COALESCE(p.n, 0)', 'COALESCE(a.n, 0)'), 4)} AS skan_coverage_rate
FROM (SELECT install_date FROM stg_skan_postbacks WHERE postback_sequence = 1 UNION SELECT stat_date FROM stg_ad_stats) d
LEFT JOIN (SELECT install_date, COUNT(*) AS n FROM stg_skan_postbacks WHERE postback_sequence = 1 GROUP BY install_date) p
  ON p.install_date IS NOT DISTINCT FROM d.install_date
LEFT JOIN (SELECT stat_date, SUM(installs) AS n FROM stg_ad_stats GROUP BY stat_date) a
  ON a.stat_date IS NOT DISTINCT FROM d.install_date""")
query("bi_skan_kpis", f"""
SELECT COUNT(*) AS skan_postbacks,
       {R(RAT('SUM(conversion_value)', 'COUNT(*)'), 4)} AS avg_conversion_value,
       {R(RAT('COUNT(*) FILTER (WHERE has_revenue_signal)', 'COUNT(*)'), 4)} AS monetisation_rate,
       {R(RAT(DSUM('estimated_revenue_usd'), f"(SELECT {DSUM('spend_usd')} FROM stg_ad_stats)"), 4)} AS skan_roas
FROM stg_skan_postbacks WHERE postback_sequence = 1""")

# analyses claimed by the README
query("rotation_schedule", """
SELECT c.format, COUNT(*) AS burnt_creatives,
       CAST(MEDIAN(be.burnout_day_of_life) AS DOUBLE) AS rotation_day
FROM int_burnout_events be JOIN stg_creatives c ON c.creative_id = be.creative_id
GROUP BY c.format""")
_SA = _sum_when("is_post_burnout", "spend_usd")
_SB = _sum_when("NOT is_post_burnout", "spend_usd")
_IA = "SUM(CASE WHEN is_post_burnout THEN installs ELSE 0 END)"
_IB = "SUM(CASE WHEN NOT is_post_burnout THEN installs ELSE 0 END)"
query("post_burnout_cpi_inflation", f"""
SELECT format_group, {R(RAT(_SB, _IB), 4)} AS cpi_before_usd, {R(RAT(_SA, _IA), 4)} AS cpi_after_usd,
       {R(RAT(RAT(_SA, _IA), RAT(_SB, _IB)), 4)} AS cpi_inflation
FROM mart_creative_burnout GROUP BY format_group""")
query("wasted_spend_share", f"""
SELECT {DSUM('wasted_spend_usd')} AS wasted_spend_usd, {DSUM('spend_usd')} AS spend_usd,
       {R(RAT(DSUM('wasted_spend_usd'), DSUM('spend_usd')), 4)} AS wasted_share
FROM mart_creative_burnout""")
query("traffic_mix", f"""
SELECT stat_date, network, format_group, spend_usd,
       {R(RAT('spend_usd', 'CAST(SUM(CAST(spend_usd AS DECIMAL(18,4))) OVER (PARTITION BY stat_date) AS DOUBLE)'), 4)} AS spend_share
FROM (SELECT stat_date, network, format_group, {DSUM('spend_usd')} AS spend_usd
      FROM int_creative_daily_metrics GROUP BY stat_date, network, format_group)""")
query("peak_day_by_format", f"""
SELECT c.format, COUNT(*) AS creatives, {R('AVG(p.peak_day_of_life)', 2)} AS avg_peak_day_of_life,
       CAST(MEDIAN(p.peak_day_of_life) AS DOUBLE) AS median_peak_day_of_life
FROM int_creative_peaks p JOIN stg_creatives c ON c.creative_id = p.creative_id
GROUP BY c.format""")


def with_chain(select: str) -> str:
    body = ",\n".join(f"{name} AS ({sql}\n)" for name, sql in CTES)
    return f"WITH {body}\n{select}"


def oracle_sql() -> dict[str, str]:
    return {k: with_chain(v) for k, v in QUERIES.items()}
