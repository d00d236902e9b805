"""Install cohorts: installs, revenue curves, cohort analysis and unit
economics.

Row-level facts (IAP events) are aggregated to cohort grain before any
window or join, with partial (map-side) aggregation, so a hot cohort never
reaches a task as raw rows. Conditional sums replace join-then-group where
one side is unique on the join keys, which keeps each mart to one shuffle per
side on the same keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from burnlens.functions import constants as K
from burnlens.functions.columns import dsum, exact_avg, ratio, rnd, running, to_monday

COHORT = ["install_date", "campaign_id", "creative_id"]
SOURCE = ["network", "country"]


def cohort_ads(ads: DataFrame) -> DataFrame:
    """Ad rows summed by (stat_date, campaign, creative, network, country), rows
    with and without installs apart: ad rows in shape, at most three for a key. Every
    model by these keys or coarser ones gives the same from these rows as
    from all, as they add up only sums (of decimals), distinct creatives and rows with installs."""
    return (
        ads.groupBy("stat_date", "campaign_id", "creative_id", "network", "country", (F.col("installs") > 0).alias("has_installs"))
        .agg(
            F.sum("impressions").alias("impressions"),
            F.sum("clicks").alias("clicks"),
            F.sum("installs").alias("installs"),
            dsum("spend_usd").alias("spend_usd"),
        )
    )


def cohort_dims_join(ads: DataFrame, creatives: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Ad days with installs, with campaign objective and creative format."""
    return (
        ads.where(F.col("installs") > 0)
        .join(campaigns.select("campaign_id", "objective"), "campaign_id")
        .join(creatives.select("creative_id", "format", "format_group"), "creative_id")
    )


def install_rows(ads: DataFrame, creatives: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Ad days with installs in the shape of the cohort-installs model (one
    row per ad row). Marts that only need installs and spend summed per
    coarser keys aggregate these directly, skipping the cohort-grain shuffle;
    decimal sums make the totals identical."""
    return cohort_dims_join(ads, creatives, campaigns).select(
        F.col("stat_date").alias("install_date"), "campaign_id", "creative_id", "network",
        "country", F.col("installs").alias("cohort_installs"),
        F.col("spend_usd").alias("cohort_spend_usd"))


def cohort_installs(ads: DataFrame, creatives: DataFrame, campaigns: DataFrame) -> DataFrame:
    """int_cohort_installs; days with zero installs are dropped (their spend too)."""
    facts = (
        ads.where(F.col("installs") > 0)
        .groupBy(F.col("stat_date").alias("install_date"), "campaign_id", "creative_id", "network", "country")
        .agg(
            F.sum("installs").alias("cohort_installs"),
            dsum("spend_usd").alias("cohort_spend_usd"),
            F.sum("clicks").alias("cohort_clicks"),
            F.sum("impressions").alias("cohort_impressions"),
        )
    )
    # The dimensions' text columns join the sums: they don't go through the shuffle.
    return (
        facts.join(campaigns.select("campaign_id", "objective"), "campaign_id")
        .join(creatives.select("creative_id", "format", "format_group"), "creative_id")
        .select("install_date", "campaign_id", "creative_id", "network", "country", "objective", "format", "format_group",
                "cohort_installs", "cohort_spend_usd", "cohort_clicks", "cohort_impressions")
        .withColumn("cac_usd", rnd(ratio("cohort_spend_usd", "cohort_installs"), 4))
        .withColumn("install_cvr", rnd(ratio("cohort_installs", "cohort_clicks"), 6))
    )


def daily_revenue(iap: DataFrame) -> DataFrame:
    """Revenue by cohort and cohort day, revenue events only."""
    return (
        iap.where(F.col("is_revenue_event"))
        .groupBy(*COHORT, *SOURCE, "days_since_install")
        .agg(dsum("revenue_usd").alias("daily_revenue_usd"))
    )


def revenue_events(iap: DataFrame) -> DataFrame:
    """Revenue events in the shape of the cohort-day revenue model (one row
    per event). Marts that only need revenue sums per coarser keys aggregate
    these directly: one partial aggregate and one shuffle, instead of
    shuffling the cohort-day aggregate first."""
    return iap.where(F.col("is_revenue_event")).select(
        *COHORT, *SOURCE, "days_since_install", F.col("revenue_usd").alias("daily_revenue_usd"))


def revenue_days(revenue: DataFrame) -> DataFrame:
    """The days of the cohort revenue model in the shape of ``revenue_events``: it has all of them, and marts add
    up the same decimals from them."""
    return revenue.select(*COHORT, *SOURCE, "days_since_install", "daily_revenue_usd")


def cohort_totals(installs: DataFrame) -> DataFrame:
    """Installs, spend and CAC per cohort: the grain of the revenue join (the
    cohort-installs model is finer, by network and country)."""
    return (
        installs.groupBy(*COHORT)
        .agg(F.sum("cohort_installs").alias("cohort_installs"), dsum("cohort_spend_usd").alias("cohort_spend_usd"))
        .withColumn("cac_usd", rnd(ratio("cohort_spend_usd", "cohort_installs"), 4))
    )


def cohort_revenue(daily: DataFrame, installs: DataFrame) -> DataFrame:
    """int_cohort_revenue: running revenue per cohort, LTV and ROAS. Joined to
    one row per cohort, so no revenue row is repeated."""
    w = running(COHORT, ["days_since_install", *SOURCE])
    cr = daily.select("*", dsum("daily_revenue_usd", over=w).alias("cumulative_revenue_usd"))
    ci = cohort_totals(installs)
    return cr.join(ci, COHORT, "left").select(
        *COHORT, *SOURCE, "days_since_install", "daily_revenue_usd", "cumulative_revenue_usd",
        "cohort_installs", "cohort_spend_usd", "cac_usd",
        rnd(ratio("cumulative_revenue_usd", "cohort_installs"), 4).alias("ltv_usd"),
        rnd(ratio("cumulative_revenue_usd", "cohort_spend_usd"), 4).alias("roas"),
    )


def revenue_through(day: int, dsi: str = "days_since_install", rev: str = "daily_revenue_usd",
                    exact_day: bool = False) -> Column:
    """sumIf(rev, dsi <= day) (or dsi = day), 0 when nothing matches."""
    cond = F.col(dsi) == day if exact_day else F.col(dsi) <= day
    return dsum(F.when(cond, F.col(rev)).otherwise(F.lit(0.0)))


COHORT_WIDE_KEYS = ["install_date", "network", "country"]


def cohort_base(installs: DataFrame) -> DataFrame:
    """Installs, spend and the unweighted mean CAC per (date, network, country)."""
    return installs.groupBy(*COHORT_WIDE_KEYS).agg(
        F.sum("cohort_installs").alias("total_installs"),
        dsum("cohort_spend_usd").alias("total_spend_usd"),
        exact_avg("cac_usd", 4).alias("avg_cac_usd"),
    )


def revenue_rollup(revenue: DataFrame) -> DataFrame:
    """Revenue per (date, network, country, cohort day); installs and spend of
    one cohort, chosen deterministically (the reference's ``any``)."""
    first = F.struct("campaign_id", "creative_id")

    def any_of(c: str):
        return F.min_by(c, F.when(F.col(c).isNotNull(), first))

    return revenue.groupBy(*COHORT_WIDE_KEYS, "days_since_install").agg(
        dsum("daily_revenue_usd").alias("revenue_usd"),
        dsum("cumulative_revenue_usd").alias("cum_revenue_usd"),
        any_of("cohort_installs").alias("installs"),
        any_of("cohort_spend_usd").alias("spend_usd"),
    )


def cohort_revenue_long(installs: DataFrame, revenue: DataFrame) -> DataFrame:
    """Cohort base left join the revenue roll-up: one row per cohort day,
    cohorts without revenue kept with NULL revenue."""
    return cohort_base(installs).join(revenue_rollup(revenue), COHORT_WIDE_KEYS, "left")


def cohort_pivot_by_alias(installs: DataFrame, revenue: DataFrame) -> DataFrame:
    """The reference's own shape of the pivot: join first, then group by the
    base columns and by the computed alias ``cac_usd``."""
    long = cohort_revenue_long(installs, revenue)
    return long.groupBy(
        *COHORT_WIDE_KEYS, "total_installs", "total_spend_usd",
        rnd("avg_cac_usd", 4).alias("cac_usd"),
    ).agg(rnd(revenue_through(7, rev="revenue_usd"), 2).alias("revenue_d7_usd"))


def cohort_wide_sums(installs: DataFrame, revenue: DataFrame,
                     cohort_days: tuple[int, ...] = K.COHORT_DAYS) -> DataFrame:
    """Cohort base (installs, spend, mean CAC) with revenue through each
    checkpoint day, per (install_date, network, country).

    The reference joins the base to revenue rolled up per cohort day and then
    groups again; since the base is unique on the join keys, summing revenue
    per checkpoint first and joining once gives the same rows with both sides
    hash-partitioned on the same three keys (no third shuffle).
    """
    keys = COHORT_WIDE_KEYS
    base = cohort_base(installs)
    days = sorted({0, *cohort_days})
    rev = revenue.groupBy(*keys).agg(
        *[revenue_through(d, exact_day=(d == 0)).alias(f"rev_d{d}") for d in days]
    )
    return base.join(rev, keys, "left").select(
        *keys, "total_installs", "total_spend_usd", "avg_cac_usd",
        *[F.coalesce(F.col(f"rev_d{d}"), F.lit(0.0)).alias(f"rev_d{d}") for d in days],
    )


def cohort_analysis(installs: DataFrame, revenue: DataFrame,
                    cohort_days: tuple[int, ...] = K.COHORT_DAYS) -> DataFrame:
    """mart_cohort_analysis: one wide row per (install_date, network, country).

    Cohorts without revenue keep zeros; revenue without a cohort drops.
    """
    keys = COHORT_WIDE_KEYS
    days = sorted({0, *cohort_days})
    j = cohort_wide_sums(installs, revenue, cohort_days)
    ti, ts = F.col("total_installs"), F.col("total_spend_usd")

    def r(d: int) -> Column:
        return F.col(f"rev_d{d}")

    return j.select(
        *keys, "total_installs", "total_spend_usd",
        rnd("avg_cac_usd", 4).alias("cac_usd"),
        *[rnd(ratio(r(d), ti), 4).alias(f"arpu_d{d}") for d in days],
        *[rnd(r(d), 2).alias(f"revenue_d{d}_usd") for d in (7, 14, 30) if d in days],
        *[rnd(ratio(r(d), ts), 4).alias(f"roas_d{d}") for d in (7, 14, 30) if d in days],
        to_monday("install_date").alias("install_week"),
    )


CAMPAIGN_KEYS = ["campaign_id", "network", "country"]


def campaign_cohorts(installs: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Cohorts rolled up per campaign: installs, spend and CAC. The campaign's
    texts are joined to the sums, so none goes through the shuffle."""
    keys = CAMPAIGN_KEYS
    camp = campaigns.select("campaign_id", "campaign_name", "objective", "daily_budget_usd")
    return (
        installs.groupBy(*keys)
        .agg(
            F.sum("cohort_installs").alias("total_installs"),
            dsum("cohort_spend_usd").alias("total_spend_usd"),
        )
        .join(camp, "campaign_id")
        .select(*keys, "campaign_name", "objective", "daily_budget_usd", "total_installs", "total_spend_usd")
        .withColumn("cac_usd", rnd(ratio("total_spend_usd", "total_installs"), 4))
    )


def ltv_checkpoints(revenue: DataFrame) -> DataFrame:
    """Revenue through D7/D14/D30 and in total per campaign, and (when the
    input carries cohort installs) the installs of the campaign's first
    cohort, the "first_cohort" denominator."""
    aggs = [
        revenue_through(7).alias("rev_7"),
        revenue_through(14).alias("rev_14"),
        revenue_through(30).alias("rev_30"),
        dsum("daily_revenue_usd").alias("total_revenue_usd"),
    ]
    if "cohort_installs" in revenue.columns:
        has_cohort = F.col("cohort_installs").isNotNull()
        first = F.when(has_cohort, F.struct("install_date", "creative_id"))
        aggs.append(F.min_by("cohort_installs", first).alias("first_cohort_installs"))
    return revenue.groupBy(*CAMPAIGN_KEYS).agg(*aggs)


def unit_economics(installs: DataFrame, revenue: DataFrame, campaigns: DataFrame,
                   denominator: str = "total") -> DataFrame:
    """mart_unit_economics: one row per (campaign, network, country).

    ``denominator``: "total" divides revenue by the campaign's total installs;
    "first_cohort" by the installs of its earliest cohort (a deterministic
    stand-in for the reference's arbitrary ``any(cohort_installs)``).
    """
    keys = CAMPAIGN_KEYS
    j = campaign_cohorts(installs, campaigns).join(ltv_checkpoints(revenue), keys, "left")
    if denominator == "total":
        den = F.col("total_installs")
    elif denominator == "first_cohort":
        den = F.col("first_cohort_installs")
    else:
        raise ValueError(f"unknown denominator {denominator!r}")
    cac = F.col("cac_usd")
    ltv = {d: ratio(F.col(f"rev_{d}"), den) for d in (7, 14, 30)}
    ltv_total = ratio("total_revenue_usd", den)

    def payback(d: int) -> Column:
        return F.when(ltv[d] >= cac, K.PAID_BACK).otherwise(K.NOT_YET)

    b = K.PAYBACK_BUCKETS
    bucket = (
        F.when(ltv[7] >= cac, b[0]).when(ltv[14] >= cac, b[1]).when(ltv[30] >= cac, b[2])
        .otherwise(b[3])
    )
    return j.select(
        "campaign_id", "campaign_name", "network", "country", "objective", "daily_budget_usd",
        "total_installs", "total_spend_usd", "cac_usd",
        *[rnd(ltv[d], 4).alias(f"ltv_d{d}_usd") for d in (7, 14, 30)],
        rnd(ltv_total, 4).alias("ltv_total_usd"),
        "total_revenue_usd",
        *[rnd(ratio(ltv[d], cac), 4).alias(f"roas_d{d}") for d in (7, 14, 30)],
        rnd(ratio(ltv_total, cac), 4).alias("roas_total"),
        rnd(ratio("total_revenue_usd", "total_spend_usd"), 4).alias("campaign_roas"),
        *[payback(d).alias(f"payback_d{d}") for d in (7, 14, 30)],
        bucket.alias("payback_period_bucket"),
    )
