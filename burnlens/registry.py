"""Query registry: key -> callable(spark, sf_dir) -> DataFrame, one key per

Every query reads the driver tables (through the adapter) at full size; no
key subsets, samples or row caps (the one ``limit`` is the top-k report).
Source, sink and incremental keys write under the session's shared
checkpoint folder and return what they read back.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from burnlens.functions.columns import month_key, ratio, rnd, safe_divide, to_monday
from burnlens.operators import bi, campaign, cohort, creative, quality, skan
from burnlens.operators import staging as stg
from burnlens.plans import append, refresh
from burnlens.plans.models import DEFAULT_AS_OF, Models
from burnlens.session import scratch_path
from burnlens.sources import files, tables
from burnlens.sources.schemas import AD_DAILY_STATS, MONTH_PARTITION, RAW_SCHEMAS, SORT_KEYS
from burnlens.streaming import incremental as inc

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

# Parameters of the source / incremental scenarios (shared with the oracle).
LOADED_AT = "2024-12-31 06:00:00"
INCREMENTAL_CUTOFF = dt.date(2024, 12, 10)   # first run sees ad days up to here
STALE_REVENUE_CUTOFF = dt.date(2024, 12, 20)  # stale cohorts miss later revenue
TOP_K = 20


def register(key: str):
    def deco(fn: Query) -> Query:
        REGISTRY[key] = fn
        return fn
    return deco


def M(spark: SparkSession, sf_dir: str, **kw) -> Models:
    return Models.from_testdata(spark, sf_dir, **kw)


def model_query(name: str, **kw) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return getattr(M(spark, sf_dir, **kw), name)
    return run


def proj(name: str, *cols) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return getattr(M(spark, sf_dir), name).select(*cols)
    return run


# ------------------------------------------------------------------ models
for _name in (*Models.STAGING, *Models.INTERMEDIATE, *Models.MARTS):
    REGISTRY[_name] = model_query(_name)
REGISTRY["mart_unit_economics_first_cohort"] = model_query(
    "mart_unit_economics", denominator="first_cohort")


# ------------------------------------------------------ sources and sinks
@register("src_schema")
def _src_schema(spark, sf):
    return files.api_edge(files.conform(M(spark, sf).raw["ad_daily_stats"], AD_DAILY_STATS))


@register("src_csv")
def _src_csv(spark, sf):
    path = scratch_path(spark, "src_csv")
    rows = M(spark, sf).raw["iap_events"]
    rows.select(*rows.columns[::-1]).write.option("header", True).csv(path)  # matched by name
    return files.api_edge(files.read_raw_csv(spark, path, "iap_events"))


@register("src_loaded_at")
def _src_loaded_at(spark, sf):
    ts = F.lit(LOADED_AT).cast("timestamp_ntz")
    return files.api_edge(files.with_loaded_at(M(spark, sf).raw["campaigns"], ts))


@register("sink_replace")
def _sink_replace(spark, sf):
    name = f"{tables.scratch_database(spark)}.ad_daily_stats"
    raw = M(spark, sf).raw["ad_daily_stats"]
    files.write_replace(raw, name)
    files.write_replace(raw, name)  # a re-run replaces, never appends
    return files.api_edge(tables.read(spark, name))


@register("load_row_counts")
def _load_row_counts(spark, sf):
    return files.load_row_counts(M(spark, sf).raw)


@register("sink_partition_month")
def _sink_partition_month(spark, sf):
    path = scratch_path(spark, "sink_partition_month")
    files.write_month_partitioned(M(spark, sf).raw["skan_postbacks"], path, "install_date")
    return files.read_month_partitioned(spark, path, RAW_SCHEMAS["skan_postbacks"])


@register("sink_sorted")
def _sink_sorted(spark, sf):
    path = scratch_path(spark, "sink_sorted")
    files.write_sorted(M(spark, sf).raw["iap_events"], path, SORT_KEYS["iap_events"])
    return files.api_edge(spark.read.schema(RAW_SCHEMAS["iap_events"]).parquet(path))


@register("mat_view")
def _mat_view(spark, sf):
    m = M(spark, sf)
    for name in Models.STAGING:
        getattr(m, name).createOrReplaceTempView(name)
    out = spark.sql("SELECT * FROM stg_creatives")
    for name in Models.STAGING:  # the result is planned over the view; no other job of the session meets the names
        spark.catalog.dropTempView(name)
    return out


@register("mat_table")
def _mat_table(spark, sf):
    name = f"{tables.scratch_database(spark)}.int_creative_peaks"
    files.write_replace(M(spark, sf).int_creative_peaks, name)
    return tables.read(spark, name)


@register("sink_export_csv")
def _sink_export_csv(spark, sf):
    path = scratch_path(spark, "sink_export_csv")
    mart = M(spark, sf).mart_campaign_performance
    files.export_csv(mart, path)
    return files.read_csv(spark, path, mart.schema)


@register("sink_bi_types")
def _sink_bi_types(spark, sf):
    return files.bi_types(M(spark, sf).mart_creative_burnout)


@register("sink_export_json")
def _sink_export_json(spark, sf):
    path = scratch_path(spark, "sink_export_json")
    mart = M(spark, sf).mart_unit_economics
    files.export_json(mart, path)
    return spark.read.schema(mart.schema).json(path)


# ----------------------------------------------------------------- staging
REGISTRY.update({
    "campaign_is_active": proj("stg_campaigns", "campaign_id", "end_date", "is_active"),
    "campaign_duration": proj("stg_campaigns", "campaign_id", "start_date", "end_date",
                              "campaign_duration_days"),
    "creative_format_group": proj("stg_creatives", "creative_id", "format", "format_group"),
    "creative_is_video": proj("stg_creatives", "creative_id", "format", "is_video"),
    "creative_video_length": proj("stg_creatives", "creative_id", "format",
                                  "video_length_seconds"),
    "ad_ratio_metrics": proj("stg_ad_stats", "stat_date", "creative_id", "ctr",
                             "cvr_click_to_install", "cpi_usd", "cpm_usd", "cpc_usd"),
    "skan_cv_bucket": proj("stg_skan_postbacks", "postback_id", "conversion_value", "cv_bucket"),
    "skan_cv_revenue": proj("stg_skan_postbacks", "postback_id", "conversion_value",
                            "estimated_revenue_usd"),
    "skan_has_revenue": proj("stg_skan_postbacks", "postback_id", "conversion_value",
                             "has_revenue_signal"),
    "skan_cv_quality": proj("stg_skan_postbacks", "postback_id", "privacy_threshold",
                            "cv_quality"),
    "iap_days_since_install": proj("stg_iap_events", "event_id", "install_date", "event_date",
                                   "days_since_install"),
    "iap_product_tier": proj("stg_iap_events", "event_id", "product_id", "product_tier"),
    "iap_is_revenue_event": proj("stg_iap_events", "event_id", "event_type", "is_revenue_event"),
    "iap_monthly_equivalent": proj("stg_iap_events", "event_id", "product_id", "revenue_usd",
                                   "monthly_equivalent_usd"),
})


@register("ad_row_filter")
def _ad_row_filter(spark, sf):
    return M(spark, sf).raw["ad_daily_stats"].where(stg.ad_row_filter()).select(
        "stat_date", "campaign_id", "creative_id", "impressions",
        F.col("spend_usd").cast("double").alias("spend_usd"))


@register("skan_row_filter")
def _skan_row_filter(spark, sf):
    return M(spark, sf).raw["skan_postbacks"].where(stg.skan_row_filter()).select(
        "postback_id", "install_date", "conversion_value")


@register("iap_row_filter")
def _iap_row_filter(spark, sf):
    return M(spark, sf).raw["iap_events"].where(stg.iap_row_filter()).select(
        "event_id", "install_date", "event_date",
        F.col("revenue_usd").cast("double").alias("revenue_usd"))


# ------------------------------------------------------------------- joins
@register("join_ads_creatives_campaigns")
def _join_acc(spark, sf):
    m = M(spark, sf)
    return creative.join_dims(m.stg_ad_stats, m.stg_creatives, m.stg_campaigns).select(
        "stat_date", "campaign_id", "creative_id", "launch_date", "format", "objective")


@register("join_cohort_dims")
def _join_cohort_dims(spark, sf):
    m = M(spark, sf)
    return cohort.cohort_dims_join(m.stg_ad_stats, m.stg_creatives, m.stg_campaigns).select(
        "stat_date", "campaign_id", "creative_id", "objective", "format", "format_group", "installs")


@register("join_metrics_peaks")
def _join_metrics_peaks(spark, sf):
    m = M(spark, sf)
    return creative.crossing_rows(m.int_creative_daily_metrics, m.int_creative_peaks).select(
        "creative_id", "stat_date", "day_of_life", "ctr_7d_avg", "absolute_peak_ctr",
        "peak_day_of_life")


REGISTRY["join_revenue_installs_left"] = proj(
    "int_cohort_revenue", "install_date", "campaign_id", "creative_id", "network", "country",
    "days_since_install", "cohort_installs", "cohort_spend_usd")


@register("join_burnout_optional")
def _join_burnout_optional(spark, sf):
    m = M(spark, sf)
    return creative.burnout_joined(
        m.int_creative_daily_metrics, m.int_creative_peaks, m.int_burnout_events
    ).select("stat_date", "creative_id", "absolute_peak_ctr", "peak_day_of_life",
             "burnout_date", "burnout_day_of_life")


@register("join_cohort_revenue_left")
def _join_cohort_revenue_left(spark, sf):
    m = M(spark, sf)
    return cohort.cohort_revenue_long(m.int_cohort_installs, m.int_cohort_revenue).select(
        "install_date", "network", "country", "total_installs", "days_since_install",
        "revenue_usd")


REGISTRY["join_unit_economics"] = proj(
    "mart_unit_economics", "campaign_id", "network", "country", "campaign_name",
    "total_installs", "total_revenue_usd")


@register("join_campaign_daily")
def _join_campaign_daily(spark, sf):
    m = M(spark, sf)
    return m.stg_ad_stats.join(
        m.stg_campaigns.select("campaign_id", "campaign_name", "daily_budget_usd"), "campaign_id"
    ).select("stat_date", "campaign_id", "creative_id", "campaign_name", "daily_budget_usd",
             "spend_usd")


@register("join_skan_full_outer")
def _join_skan_full_outer(spark, sf):
    m = M(spark, sf)
    first = m.int_skan_cv_mapping.where(F.col("postback_sequence") == 1)
    return skan.reconcile(first, skan.reported_installs(m.stg_ad_stats))


REGISTRY["join_skan_campaign_left"] = proj(
    "mart_skan_attribution", "install_date", "campaign_id", "creative_id", "network", "country",
    "campaign_name", "objective")


# ------------------------------------------------------------ aggregations
REGISTRY.update({
    "agg_cohort_installs": model_query("int_cohort_installs"),
    "agg_daily_revenue": model_query("int_daily_revenue"),
    "agg_skan_distribution": model_query("int_skan_cv_mapping"),
    "agg_peaks": model_query("int_creative_peaks"),
    "agg_burnout_events": model_query("int_burnout_events"),
    "agg_cohort_pivot": proj(
        "mart_cohort_analysis", "install_date", "network", "country",
        *[f"arpu_d{d}" for d in (0, 1, 3, 7, 14, 30)],
        *[f"revenue_d{d}_usd" for d in (7, 14, 30)], *[f"roas_d{d}" for d in (7, 14, 30)]),
})


@register("agg_active_creatives")
def _agg_active_creatives(spark, sf):
    """Active creatives of each campaign by day, week and in all, from one state of daily rows."""
    ads = M(spark, sf).stg_ad_stats
    state = campaign.active_state(ads, campaign.creative_codes(ads))
    grains = {"day": F.col("stat_date"), "week": to_monday("stat_date"), "all": F.lit(None).cast("date")}
    out = None
    for grain, period in grains.items():
        part = campaign.active_creatives(state, period.alias("period")).select(F.lit(grain).alias("grain"), "period", "campaign_id", "active_creatives")
        out = part if out is None else out.unionByName(part)
    return out


@register("agg_campaign_daily")
def _agg_campaign_daily(spark, sf):
    m = M(spark, sf)
    return campaign.campaign_daily(m.stg_ad_stats, m.stg_campaigns)


@register("agg_campaign_cohorts")
def _agg_campaign_cohorts(spark, sf):
    m = M(spark, sf)
    return cohort.campaign_cohorts(m.int_cohort_installs, m.stg_campaigns)


@register("agg_ltv_checkpoints")
def _agg_ltv_checkpoints(spark, sf):
    return cohort.ltv_checkpoints(M(spark, sf).int_cohort_revenue)


@register("agg_cohort_base")
def _agg_cohort_base(spark, sf):
    return cohort.cohort_base(M(spark, sf).int_cohort_installs)


@register("agg_cohort_revenue_rollup")
def _agg_cohort_revenue_rollup(spark, sf):
    return cohort.revenue_rollup(M(spark, sf).int_cohort_revenue)


@register("agg_skan_ads")
def _agg_skan_ads(spark, sf):
    return skan.reported_installs(M(spark, sf).stg_ad_stats)


@register("agg_group_by_alias")
def _agg_group_by_alias(spark, sf):
    m = M(spark, sf)
    return cohort.cohort_pivot_by_alias(m.int_cohort_installs, m.int_cohort_revenue)


# ----------------------------------------------------------------- windows
_CDM = ("int_creative_daily_metrics", "creative_id", "stat_date")
_CP = ("mart_campaign_performance", "campaign_id", "stat_date", "network", "country")
REGISTRY.update({
    "win_ctr_7d_avg": proj(*_CDM, "ctr", "ctr_7d_avg"),
    "win_ctr_peak_so_far": proj(*_CDM, "ctr", "ctr_peak_so_far"),
    "win_creative_cum_spend": proj(*_CDM, "spend_usd", "cumulative_spend_usd"),
    "win_creative_cum_installs": proj(*_CDM, "installs", "cumulative_installs"),
    "win_cum_revenue": proj("int_cohort_revenue", "install_date", "campaign_id", "creative_id",
                            "network", "country", "days_since_install", "daily_revenue_usd",
                            "cumulative_revenue_usd"),
    "win_cpi_7d_avg": proj(*_CP, "blended_cpi_usd", "cpi_7d_avg"),
    "win_ctr_14d_avg": proj(*_CP, "blended_ctr", "ctr_14d_avg"),
    "win_campaign_cum_spend": proj(*_CP, "spend_usd", "cumulative_spend_usd"),
    "win_campaign_cum_installs": proj(*_CP, "installs", "cumulative_installs"),
    "win_cpi_trend_ratio": proj(*_CP, "blended_cpi_usd", "cpi_trend_ratio"),
    "win_cpi_vs_best": proj("mart_creative_burnout", "creative_id", "stat_date", "cpi_usd",
                            "cpi_vs_best_ratio"),
})

# ------------------------------------------- burnout mart column rules
_MCB = ("mart_creative_burnout", "creative_id", "stat_date")
REGISTRY.update({
    "burnout_score": proj(*_MCB, "ctr_7d_avg", "absolute_peak_ctr", "burnout_score"),
    "lifecycle_stage": proj(*_MCB, "day_of_life", "peak_day_of_life", "burnout_date",
                            "lifecycle_stage"),
    "is_post_burnout": proj(*_MCB, "burnout_date", "is_post_burnout"),
    "wasted_spend": proj(*_MCB, "spend_usd", "wasted_spend_usd"),
    "ctr_vs_peak_ratio": proj(*_MCB, "ctr_7d_avg", "ctr_vs_peak_ratio"),
    "cpi_vs_best_ratio": proj(*_MCB, "cpi_usd", "cpi_vs_best_ratio"),
})


# -------------------------------------------------------------------- sort
@register("sort_campaign_performance")
def _sort_cp(spark, sf):
    return M(spark, sf).mart_campaign_performance.orderBy(F.desc("stat_date"), F.desc("spend_usd"))


@register("sort_cohort_analysis")
def _sort_ca(spark, sf):
    return M(spark, sf).mart_cohort_analysis.orderBy("install_date", "network", "country")


@register("sort_unit_economics")
def _sort_ue(spark, sf):
    return M(spark, sf).mart_unit_economics.orderBy(F.desc_nulls_last("campaign_roas"))


@register("sort_skan_attribution")
def _sort_sa(spark, sf):
    return M(spark, sf).mart_skan_attribution.orderBy(F.desc("install_date"), F.desc("spend_usd"))


@register("bi_top_burnt_creatives")
def _top_burnt(spark, sf):
    return bi.top_burnt_creatives(M(spark, sf).mart_creative_burnout, TOP_K)


# -------------------------------------------------------- scalar functions
@register("fn_to_date")
def _fn_to_date(spark, sf):
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    return li.select("l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("ship_date"))


REGISTRY.update({
    "fn_to_uint64": proj("stg_ad_stats", "stat_date", "creative_id", "impressions", "clicks",
                         "installs"),
    "fn_to_uint8": proj("stg_skan_postbacks", "postback_id", "conversion_value",
                        "postback_sequence"),
    "fn_to_float64": proj("stg_iap_events", "event_id", "revenue_usd"),
    "fn_date_diff_day": proj(*_CDM, "launch_date", "day_of_life"),
    "fn_if": proj(*_MCB, "burnout_date", "is_post_burnout", "wasted_spend_usd"),
    "fn_case": proj(*_MCB, "lifecycle_stage"),
    "fn_greatest": proj(*_MCB, "ctr_7d_avg", "absolute_peak_ctr", "burnout_score"),
    "fn_nan_guard": proj(*_CP, "cpi_trend_ratio", "saturation_flag"),
})


@register("fn_today")
def _fn_today(spark, sf):
    return M(spark, sf).stg_campaigns.select(
        "campaign_id", "end_date", F.lit(DEFAULT_AS_OF).alias("as_of"), "is_active")


@register("fn_to_monday")
def _fn_to_monday(spark, sf):
    return M(spark, sf).stg_ad_stats.select(
        "stat_date", to_monday("stat_date").alias("stat_week")).distinct()


@register("fn_interval")
def _fn_interval(spark, sf):
    return M(spark, sf).int_creative_daily_metrics.groupBy("creative_id").agg(
        F.max("stat_date").alias("last_date")
    ).select("creative_id", "last_date", F.date_sub("last_date", 14).alias("reprocess_from"))


@register("fn_month_key")
def _fn_month_key(spark, sf):
    return M(spark, sf).stg_ad_stats.select(
        "stat_date", month_key("stat_date").alias("month_key")).distinct()


@register("fn_round")
def _fn_round(spark, sf):
    return M(spark, sf).stg_ad_stats.select(
        "stat_date", "creative_id",
        rnd(ratio("spend_usd", "clicks"), 2).alias("cpc_2"),
        rnd(ratio("clicks", "impressions"), 4).alias("ctr_4"),
        rnd(ratio("clicks", "impressions"), 6).alias("ctr_6"))


@register("fn_nullif")
def _fn_nullif(spark, sf):
    return M(spark, sf).stg_ad_stats.select(
        "stat_date", "creative_id",
        ratio("clicks", "impressions").alias("ctr_raw"),
        ratio("installs", "clicks").alias("cvr_raw"))


@register("fn_coalesce")
def _fn_coalesce(spark, sf):
    return _join_skan_full_outer(spark, sf).select(
        *skan.SKAN_KEYS, "skan_postbacks", "mmp_installs", "spend_usd")


@register("fn_between_in")
def _fn_between_in(spark, sf):
    p = M(spark, sf).stg_skan_postbacks
    return p.select(
        "postback_id", "conversion_value",
        F.col("conversion_value").between(4, 15).alias("low_or_mid_revenue"),
        F.col("privacy_threshold").isin("low", "medium").alias("is_coarse"),
        F.col("privacy_threshold").isNull().alias("privacy_missing"))


@register("fn_safe_divide")
def _fn_safe_divide(spark, sf):
    return M(spark, sf).stg_ad_stats.select(
        "stat_date", "creative_id", safe_divide("spend_usd", "installs").alias("cpi_or_zero"))


# ----------------------------------------------------- incremental / backfill
def _partial_models(m: Models) -> Models:
    """The state of the first run: ad days up to INCREMENTAL_CUTOFF."""
    raw = dict(m.raw)
    raw["ad_daily_stats"] = raw["ad_daily_stats"].where(
        F.col("stat_date") <= F.lit(INCREMENTAL_CUTOFF))
    return Models(raw, m.as_of)


def _by_creative(spark, sf) -> Models:
    """Models over ad rows and creatives as a job writes them first, for both runs."""
    run = refresh.Run(spark, M(spark, sf), tables.scratch_database(spark))
    run.stage_raw()
    return run.models


def _first_run_target(spark, m: Models) -> str:
    name = f"{tables.scratch_database(spark)}.burnout_target"
    return inc.full_refresh(_partial_models(m).mart_creative_burnout, name)


@register("inc_window_filter")
def _inc_window_filter(spark, sf):
    m = _by_creative(spark, sf)
    since = inc.watermark(spark, _first_run_target(spark, m))
    return inc.inc_window_filter(m.int_creative_daily_metrics, since).select(
        "creative_id", "stat_date", "impressions", "ctr_7d_avg")


@register("inc_delete_insert")
def _inc_delete_insert(spark, sf):
    m = _by_creative(spark, sf)
    target = _first_run_target(spark, m)
    return tables.read(spark, inc.incremental_burnout(spark, m.int_creative_daily_metrics, target, target))


@register("inc_delete_insert_compat")
def _inc_delete_insert_compat(spark, sf):
    """As inc_delete_insert, with the reference's exact window semantics: the
    best CPI of a re-processed row is the minimum over the re-processed dates
    only."""
    m = _by_creative(spark, sf)
    target = _first_run_target(spark, m)
    inc.incremental_burnout(spark, m.int_creative_daily_metrics, target, target, compat_window=True)
    return tables.read(spark, target)


@register("inc_full_refresh")
def _inc_full_refresh(spark, sf):
    out = f"{tables.scratch_database(spark)}.mart_creative_burnout"
    return tables.read(spark, inc.full_refresh(M(spark, sf).mart_creative_burnout, out))


@register("backfill_window")
def _backfill_window(spark, sf):
    m = M(spark, sf)
    stale_raw = dict(m.raw)
    stale_raw["iap_events"] = stale_raw["iap_events"].where(
        F.col("event_date") <= F.lit(STALE_REVENUE_CUTOFF))
    stale = Models(stale_raw, m.as_of).mart_cohort_analysis
    name = f"{tables.scratch_database(spark)}.mart_cohort_analysis"
    inc.write_by_install_date(stale, name)
    inc.backfill_cohorts(m.mart_cohort_analysis, name, DEFAULT_AS_OF)
    return tables.read(spark, name)


@register("refresh_daily")
def _refresh_daily(spark, sf):
    return refresh.refresh_daily(spark, M(spark, sf), tables.scratch_database(spark, "daily"), on_failure="publish")


@register("refresh_daily_incremental")
def _refresh_daily_incremental(spark, sf):
    """Two daily runs on one database: the first sees the ad days up to
    INCREMENTAL_CUTOFF, the second goes on from its state."""
    out = tables.scratch_database(spark, "daily")
    refresh.refresh_daily(spark, _partial_models(M(spark, sf)), out, on_failure="publish")
    refresh.refresh_daily(spark, M(spark, sf), out, previous=out, on_failure="publish")
    return tables.read(spark, f"{out}.mart_creative_burnout")


@register("refresh_weekly")
def _refresh_weekly(spark, sf):
    return refresh.refresh_weekly(spark, M(spark, sf), tables.scratch_database(spark, "weekly"), on_failure="publish")


# ------------------------------------------------------------ data quality
@register("dq_not_null")
def _dq_not_null(spark, sf):
    return quality.dq_not_null(M(spark, sf).raw)


@register("dq_unique")
def _dq_unique(spark, sf):
    return quality.dq_unique(M(spark, sf).raw)


@register("dq_unique_append")
def _dq_unique_append(spark, sf):
    """The facts' uniqueness tests after a load and an append from
    INCREMENTAL_CUTOFF's month on: the appended keys meet the Bloom filters of the months before."""
    db, raw = tables.scratch_database(spark, "append"), M(spark, sf).raw
    for t in append.KEYS:
        date_col = F.col(MONTH_PARTITION[t])
        tables.replace(files.with_loaded_at(raw[t].where(date_col < F.lit(INCREMENTAL_CUTOFF))), f"{db}.{t}", files.raw_layout(t))
        append.index_keys(spark, db, t)
        append.append_facts(raw[t].where(date_col >= F.lit(INCREMENTAL_CUTOFF)), db, t, INCREMENTAL_CUTOFF)
    return append.unique_failures(spark, db)


@register("dq_accepted_values")
def _dq_accepted(spark, sf):
    return quality.dq_accepted_values(M(spark, sf).raw)


@register("dq_relationships")
def _dq_rel(spark, sf):
    return quality.dq_relationships(M(spark, sf).raw)


@register("dq_burnout_score_range")
def _dq_score(spark, sf):
    return quality.dq_burnout_score_range(M(spark, sf).mart_creative_burnout)


@register("dq_positive_spend")
def _dq_spend(spark, sf):
    m = M(spark, sf)
    return quality.dq_positive_spend(m.stg_ad_stats, m.raw["ad_daily_stats"])


@register("dq_summary")
def _dq_summary(spark, sf):
    m = M(spark, sf)
    return quality.dq_summary(m.raw, m.mart_creative_burnout, m.stg_ad_stats)


# ---------------------------------------------------------------------- BI
def _on(model: str, fn) -> Query:
    def run(spark, sf):
        return fn(getattr(M(spark, sf), model))
    return run


def _cohort_pair(fn) -> Query:
    def run(spark, sf):
        m = M(spark, sf)
        return fn(m.int_cohort_installs, m.revenue_events)
    return run


REGISTRY.update({
    "bi_ctr_by_day_of_life": _on("mart_creative_burnout", bi.ctr_by_day_of_life),
    "bi_burnout_scatter": _on("mart_creative_burnout", bi.burnout_scatter),
    "bi_total_wasted_spend": _on("mart_creative_burnout", bi.total_wasted_spend),
    "bi_slicer": _on("mart_creative_burnout", bi.slicer),
    "bi_cac_by_network": _on("mart_unit_economics", bi.cac_by_network),
    "bi_ltv_curve": _cohort_pair(bi.ltv_curve),
    "bi_roas_matrix": _on("mart_unit_economics", bi.roas_matrix),
    "bi_payback_distribution": _on("mart_unit_economics", bi.payback_distribution),
    "bi_arpu_heatmap": _cohort_pair(bi.arpu_heatmap),
    "bi_roas_trend": _cohort_pair(bi.roas_trend),
    "bi_installs_by_network_week": _on("mart_cohort_analysis", bi.installs_by_network_week),
    "bi_cv_bucket_distribution": _on("mart_skan_attribution", bi.cv_bucket_distribution),
    "bi_privacy_impact": _on("mart_skan_attribution", bi.privacy_impact),
    "bi_coverage_trend": lambda spark, sf: bi.coverage_trend((m := M(spark, sf)).int_skan_cv_mapping, m.stg_ad_stats),
    "bi_skan_kpis": lambda spark, sf: bi.skan_kpis((m := M(spark, sf)).stg_skan_postbacks, m.stg_ad_stats),
    "post_burnout_cpi_inflation": _on("mart_creative_burnout", bi.post_burnout_cpi_inflation),
    "wasted_spend_share": _on("mart_creative_burnout", bi.wasted_spend_share),
    "traffic_mix": _on("int_creative_daily_metrics", bi.traffic_mix),
})


@register("rotation_schedule")
def _rotation(spark, sf):
    m = M(spark, sf)
    return bi.rotation_schedule(m.int_burnout_events, m.stg_creatives)


@register("peak_day_by_format")
def _peak_day(spark, sf):
    m = M(spark, sf)
    return bi.peak_day_by_format(m.int_creative_peaks, m.stg_creatives)


def queries() -> dict[str, Query]:
    return dict(REGISTRY)
