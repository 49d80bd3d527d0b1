"""Reporting queries over the star schema."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.columns import banded, month_of
from ledgerlake.operators.lookup import join_large
from ledgerlake.plans.labels import MOVEMENT_TYPES

TOTAL = "decimal(38,2)"


def total(col: str | Column) -> Column:
    return F.sum(col).cast(TOTAL)


def count() -> Column:
    return F.count(F.lit(1))


def share(part: Column, whole: Column) -> Column:
    """Part of whole as a fraction; NULL for an empty whole."""
    return F.when(whole != 0, part.cast("double") / whole.cast("double"))


def revenue_by_month(fct_transactions: DataFrame) -> DataFrame:
    return (
        fct_transactions.groupBy(month_of(F.col("created_date")).alias("month"), "event_type")
        .agg(count().alias("events"), total("amount_usd").alias("gross_revenue_usd"),
             total("signed_net_amount_usd").alias("net_revenue_usd"))
        .orderBy(F.col("month").desc(), "event_type")
    )


def mrr_by_movement(fct_mrr: DataFrame) -> DataFrame:
    return (
        fct_mrr.groupBy("billing_month", "movement_type")
        .agg(count().alias("customers"), total("mrr_usd").alias("mrr_usd"),
             total("mrr_change_usd").alias("mrr_change_usd"))
        .orderBy(F.col("billing_month").desc(), "movement_type")
    )


def gold_totals(fct_transactions: DataFrame, fct_mrr: DataFrame, dim_customers: DataFrame) -> DataFrame:
    """Row counts and totals that tell whether Gold is populated."""
    none = F.lit(None).cast(TOTAL)
    return (
        fct_transactions.agg(count().alias("rows")).select(
            F.lit("fct_transactions").alias("table_name"), "rows", none.alias("total_usd"))
        .unionByName(fct_mrr.agg(count().alias("rows"), total("mrr_usd").alias("total_usd")).select(
            F.lit("fct_mrr_movements").alias("table_name"), "rows", "total_usd"))
        .unionByName(dim_customers.agg(F.count_if("is_current").alias("rows")).select(
            F.lit("dim_customers_current").alias("table_name"), "rows", none.alias("total_usd")))
    )


def mrr_summary(fct_mrr: DataFrame) -> DataFrame:
    """Monthly and annual recurring revenue with the change split by movement."""
    names = {m: m.lower().replace(" ", "_") for m in MOVEMENT_TYPES}
    moved = [
        F.coalesce(F.sum(F.when(F.col("movement_type") == m, F.col("mrr_change_usd"))),
                   F.lit(Decimal("0.00"))).cast(TOTAL).alias(f"{n}_usd")
        for m, n in names.items()
    ]
    return fct_mrr.groupBy("billing_month").agg(
        total("mrr_usd").alias("mrr_usd"),
        (F.sum("mrr_usd") * F.lit(Decimal(12))).cast(TOTAL).alias("arr_usd"),
        *moved,
    )


def movement_counts(fct_mrr: DataFrame) -> DataFrame:
    """Customers per month and movement, one column per movement type."""
    pivoted = fct_mrr.groupBy("billing_month").pivot("movement_type", MOVEMENT_TYPES).agg(count())
    return pivoted.select(
        "billing_month",
        *(F.coalesce(F.col(f"`{m}`"), F.lit(0)).alias(m.lower().replace(" ", "_")) for m in MOVEMENT_TYPES),
    )


def risk_rates(charges_daily: DataFrame, refunds_daily: DataFrame, disputes_daily: DataFrame) -> DataFrame:
    """Refund rate, dispute rate and dispute win rate per month, merged from daily partials."""
    def monthly(df: DataFrame, *aggs: Column) -> DataFrame:
        return df.groupBy(month_of(F.col("day")).alias("month")).agg(*aggs)

    charges = monthly(charges_daily, F.sum("n").alias("charges"), total("amount_usd").alias("charged_usd"))
    refunds = monthly(refunds_daily, F.sum("n").alias("refunds"), total("amount_usd").alias("refunded_usd"))
    disputes = monthly(disputes_daily, F.sum("n").alias("disputes"), F.sum("won").alias("won"),
                       F.sum("lost").alias("lost"), total("loss_usd").alias("loss_usd"))
    joined = charges.join(refunds, "month", "full").join(disputes, "month", "full")

    def n(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0))

    def money(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(Decimal("0.00"))).cast(TOTAL)

    return joined.select(
        "month",
        *(n(c).alias(c) for c in ("charges", "refunds", "disputes", "won", "lost")),
        *(money(c).alias(c) for c in ("charged_usd", "refunded_usd", "loss_usd")),
        share(n("refunds"), n("charges")).alias("refund_rate"),
        share(money("refunded_usd"), money("charged_usd")).alias("refunded_share"),
        share(n("disputes"), n("charges")).alias("dispute_rate"),
        share(n("won"), n("won") + n("lost")).alias("dispute_win_rate"),
    )


def charge_outcomes(charges_daily: DataFrame) -> DataFrame:
    """Success rate per month, payment method and card brand, merged from daily partials."""
    return charges_daily.groupBy(month_of(F.col("day")).alias("month"), "payment_method_type", "card_brand").agg(
        F.sum("n").alias("attempts"),
        F.sum("succeeded").alias("succeeded"),
        F.sum("failed").alias("failed"),
        share(F.sum("succeeded"), F.sum("n")).alias("success_rate"),
        total("amount_usd").alias("amount_usd"),
    )


def failure_codes(charges_daily: DataFrame) -> DataFrame:
    return (
        charges_daily.filter(F.col("failed") > 0).groupBy("failure_code", "payment_method_type")
        .agg(F.sum("n").alias("charges"), total("amount_usd").alias("amount_usd"))
    )


LATENCY_BANDS = [(0, "before charge"), (8, "0-7 days"), (31, "8-30 days"), (91, "31-90 days")]
LATENCY_ABOVE = "over 90 days"


def refund_latency(refunds_daily: DataFrame) -> DataFrame:
    """Days from charge to refund, by reason, merged from daily histograms.

    The percentiles are exact; their state holds one counter per distinct number of days.
    """
    known = refunds_daily.filter(F.col("days_since_charge").isNotNull())
    days, n = F.col("days_since_charge"), F.col("n")
    bands = [label for _, label in LATENCY_BANDS] + [LATENCY_ABOVE]
    band = banded(days, LATENCY_BANDS, LATENCY_ABOVE)
    return known.groupBy("reason").agg(
        F.sum(n).alias("refunds"),
        F.percentile(days, F.lit(0.5), n).alias("median_days"),
        F.percentile(days, F.lit(0.9), n).alias("p90_days"),
        F.min(days).alias("min_days"),
        F.max(days).alias("max_days"),
        *(F.sum(F.when(band == b, n).otherwise(F.lit(0))).alias(b.replace(" ", "_").replace("-", "_")) for b in bands),
    )


def dispute_sla(disputes_daily: DataFrame) -> DataFrame:
    """Time left to answer disputes, per outcome, merged from daily histograms."""
    days, n = F.col("days_to_evidence_due"), F.col("n")
    return disputes_daily.groupBy("outcome_category").agg(
        F.sum(n).alias("disputes"),
        F.sum("overdue").alias("overdue"),
        F.sum("with_evidence").alias("with_evidence"),
        F.percentile(days, F.lit(0.5), n).alias("median_days_to_due"),
        F.min(days).alias("min_days_to_due"),
        F.max(days).alias("max_days_to_due"),
        total("amount_usd").alias("amount_usd"),
    )


def cash_by_day(fct_payouts: DataFrame) -> DataFrame:
    """Cash reaching the bank per arrival day, instant and standard apart."""
    paid = F.when(F.col("is_paid"), F.col("amount_usd"))
    zero = F.lit(Decimal("0.00"))
    return fct_payouts.groupBy("arrival_date").agg(
        count().alias("payouts"),
        F.coalesce(F.sum(paid), zero).cast(TOTAL).alias("net_cash_usd"),
        F.coalesce(F.sum(F.when(F.col("is_instant"), paid)), zero).cast(TOTAL).alias("instant_usd"),
        F.coalesce(F.sum(F.when(~F.col("is_instant"), paid)), zero).cast(TOTAL).alias("standard_usd"),
        F.count_if("is_failed").alias("failed"),
    )


def transit_days(fct_payouts: DataFrame) -> DataFrame:
    """Distribution of the days in transit per method."""
    return fct_payouts.groupBy("method", "transit_days").agg(
        count().alias("payouts"), total("amount_usd").alias("amount_usd"))


def failed_payouts(fct_payouts: DataFrame) -> DataFrame:
    return (
        fct_payouts.filter("is_failed")
        .groupBy(month_of(F.col("created_date")).alias("month"), "failure_code", "currency")
        .agg(count().alias("payouts"), total("amount_usd").alias("amount_usd"))
    )


def customers_by_region(dim_customers: DataFrame, dim_geography: DataFrame) -> DataFrame:
    """Current customers per region and market tier."""
    per_country = (
        dim_customers.filter("is_current")
        .groupBy(F.upper(F.trim("billing_country")).alias("country_code"))
        .agg(count().alias("customers"), F.count_if("delinquent").alias("delinquent"))
    )
    # Both sides hold one row per country by now.
    return (
        per_country.join(dim_geography.select("country_code", "region", "market_tier"), "country_code", "left")
        .groupBy("region", "market_tier")
        .agg(F.sum("customers").alias("customers"), F.sum("delinquent").alias("delinquent"))
    )


def mrr_by_region_and_plan(fct_mrr: DataFrame, dim_customers: DataFrame, dim_geography: DataFrame) -> DataFrame:
    """Recurring revenue and churned customers per region, tier, plan and month."""
    current = dim_customers.filter("is_current").select(
        "customer_id", F.upper(F.trim("billing_country")).alias("country_code"))
    located = join_large(fct_mrr, current, "customer_id", "customer_id",
                         {"country_code": "country_code"}, spread_by="mrr_key")
    per_country = located.groupBy("country_code", "plan_id", "billing_month").agg(
        F.sum("mrr_usd").alias("mrr_usd"),
        count().alias("customers"),
        F.count_if(F.col("movement_type") == "Churn").alias("churned"),
    )
    named = per_country.join(
        dim_geography.select("country_code", "region", "market_tier"), "country_code", "left")
    return named.groupBy(
        F.coalesce("region", F.lit("Unknown")).alias("region"),
        F.coalesce("market_tier", F.lit("Unknown")).alias("market_tier"),
        "plan_id", "billing_month",
    ).agg(total("mrr_usd").alias("mrr_usd"), F.sum("customers").alias("customers"),
          F.sum("churned").alias("churned"))


def mrr_by_pricing_tier(fct_mrr: DataFrame, dim_plans: DataFrame) -> DataFrame:
    """Recurring revenue per month and pricing tier of the plan.

    A plan sold at several prices counts under its highest tier.
    """
    per_plan = fct_mrr.groupBy("plan_id", "billing_month").agg(
        F.sum("mrr_usd").alias("mrr_usd"), count().alias("customers"))
    tiers = dim_plans.groupBy("plan_id").agg(
        F.max_by("pricing_tier", "monthly_price_usd").alias("pricing_tier"))
    return (
        per_plan.join(tiers, "plan_id", "left")
        .groupBy("billing_month", "pricing_tier")
        .agg(total("mrr_usd").alias("mrr_usd"), F.sum("customers").alias("customers"))
    )


def masked_customers(dim_customers: DataFrame, secret: str) -> DataFrame:
    """Customers for analysts: identity hashed, contact data masked, region kept.

    Ids and addresses can be enumerated, so the hashes take a ``secret`` that analysts do not
    have; no other key of the customer is shown.
    """
    def keyed(column: str) -> Column:
        inner = F.sha2(F.concat(F.lit(secret), F.lit(":"), F.col(column)), 256)
        return F.sha2(F.concat(F.lit(secret), F.lit(":"), inner), 256)

    return dim_customers.select(
        keyed("customer_id").alias("customer_hash"),
        "created_date", "currency",
        keyed("email").alias("email_hash"),
        F.regexp_extract("email", "@(.*)$", 1).alias("email_domain"),
        F.mask("name").alias("name_masked"),
        F.mask("phone").alias("phone_masked"),
        "billing_country",
        F.left("address_postal_code", F.lit(2)).alias("postal_area"),
        "delinquent", "balance", "tax_exempt", "valid_from", "valid_to", "is_current",
    )
