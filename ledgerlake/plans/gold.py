"""Gold: dimensions and facts of the star schema.

Silver keys are unique already, so the facts do not de-duplicate again. Dimensions that
stay small by construction are attached through ``Lookup``; customers and charges grow
with the business and are joined by shuffle.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.functions.columns import (
    banded, days_between, fiscal_month, fiscal_year, mapped, month_of, non_empty,
    surrogate_key, title_case, weekday_from_sunday,
)
from ledgerlake.functions.money import MONEY, RATE
from ledgerlake.operators.dedup import LOAD_ORDER, latest_values
from ledgerlake.operators.lookup import Lookup, join_large
from ledgerlake.plans import labels

FISCAL_START_MONTH = 7
CALENDAR_START = dt.date(2018, 1, 1)
CALENDAR_END = dt.date(2030, 12, 31)


# --- dimensions -------------------------------------------------------------------------

def dim_customers(stg_customers_history: DataFrame) -> DataFrame:
    return stg_customers_history.drop("ingestion_run_id", "load_mode", "loaded_at")


def calendar(days: DataFrame, fiscal_start: int = FISCAL_START_MONTH) -> DataFrame:
    """Calendar and fiscal attributes for a frame with one ``date_day`` column."""
    day = F.col("date_day")
    return days.select(
        "date_day",
        surrogate_key(day).alias("date_key"),
        F.year(day).alias("calendar_year"),
        F.month(day).alias("calendar_month"),
        F.day(day).alias("calendar_day"),
        weekday_from_sunday(day).alias("day_of_week"),
        F.dayname(day).alias("day_name"),
        F.weekofyear(day).alias("week_of_year"),
        F.quarter(day).alias("calendar_quarter"),
        fiscal_year(day, fiscal_start).alias("fiscal_year"),
        fiscal_month(day, fiscal_start).alias("fiscal_month"),
        month_of(day).alias("month_start_date"),
        F.last_day(day).alias("month_end_date"),
        (day == month_of(day)).alias("is_month_start"),
        (day == F.last_day(day)).alias("is_month_end"),
        weekday_from_sunday(day).isin(0, 6).alias("is_weekend"),
    )


def dim_dates(spark: SparkSession, start: dt.date = CALENDAR_START, end: dt.date = CALENDAR_END,
              fiscal_start: int = FISCAL_START_MONTH) -> DataFrame:
    """One row per day from ``start`` to ``end``, both included."""
    span = spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end))).alias("date_day"))
    return calendar(span, fiscal_start)


def dim_currencies(brz_fx: DataFrame, as_of: dt.date) -> DataFrame:
    """One row per currency with its latest rate; USD is always a member."""
    usd = brz_fx.filter(F.col("to_currency") == "USD")
    latest = latest_values(usd, ["from_currency"], ["rate", "rate_date"], ("rate_date", *LOAD_ORDER)).select(
        F.col("from_currency").alias("currency_code"),
        F.col("rate").cast(RATE).alias("latest_usd_rate"),
        F.col("rate_date").alias("latest_rate_date"),
    )
    spark = brz_fx.sparkSession
    base = spark.range(1).select(
        F.lit("USD").alias("currency_code"),
        F.lit(Decimal("1.000000")).cast(RATE).alias("latest_usd_rate"),
        F.lit(as_of).cast("date").alias("latest_rate_date"),
    )
    # A quoted USD rate comes before the constant one. One row per currency by now: no join.
    either = latest.withColumn("_quoted", F.lit(1)).unionByName(base.withColumn("_quoted", F.lit(0)))
    members = either.groupBy("currency_code").agg(
        F.max_by(F.struct("latest_usd_rate", "latest_rate_date"), "_quoted").alias("_rate")).select(
        "currency_code", "_rate.*")
    code = F.col("currency_code")
    regions = {c: region for region, codes in labels.CURRENCY_REGIONS.items() for c in codes}
    return members.select(
        surrogate_key(code).alias("currency_key"),
        "currency_code",
        mapped(code, labels.CURRENCY_NAMES, F.concat(code, F.lit(" (Unknown)"))).alias("currency_name"),
        mapped(code, labels.CURRENCY_SYMBOLS, code).alias("currency_symbol"),
        mapped(code, regions, F.lit("Other")).alias("region"),
        (code == "USD").alias("is_base_currency"),
        "latest_usd_rate",
        "latest_rate_date",
    )


def _stamp(as_of: dt.datetime) -> Column:
    return F.lit(as_of).cast("timestamp_ntz").alias("dbt_updated_at")


def dim_geography(stg_customers_history: DataFrame, as_of: dt.datetime) -> DataFrame:
    """One row per billing country of the current customers."""
    current = stg_customers_history.filter(F.col("is_current") & non_empty(F.col("billing_country")))
    countries = current.select(F.upper(F.trim("billing_country")).alias("country_code")).distinct()
    code = F.col("country_code")

    def part(index: int, default: Column) -> Column:
        return mapped(code, {k: v[index] for k, v in labels.COUNTRIES.items()}, default)

    return countries.select(
        surrogate_key(code).alias("geography_key"),
        "country_code",
        part(0, F.concat(code, F.lit(" (Unknown)"))).alias("country_name"),
        part(1, F.lit("Other")).alias("region"),
        part(2, F.lit("Other")).alias("sub_region"),
        part(3, F.lit("Tier 3")).alias("market_tier"),
        _stamp(as_of),
    )


def dim_payment_category(stg_ledger: DataFrame, as_of: dt.datetime) -> DataFrame:
    """One row per event type and reporting category seen in the ledger."""
    kinds = (
        stg_ledger.filter(F.col("event_type").isNotNull())
        .select("event_type", "reporting_category")
        .distinct()
    )
    event = F.col("event_type")

    def part(index: int, default: Column) -> Column:
        return mapped(event, {k: v[index] for k, v in labels.PAYMENT_EVENTS.items()}, default)

    return kinds.select(
        surrogate_key(event, F.col("reporting_category")).alias("payment_category_key"),
        "event_type",
        "reporting_category",
        part(0, title_case(event)).alias("event_label"),
        part(1, F.lit("Other")).alias("financial_category"),
        part(2, F.lit("Neutral")).alias("sign_convention"),
        part(3, F.lit(False)).alias("affects_revenue"),
        part(4, F.lit(False)).alias("affects_cash"),
        _stamp(as_of),
    )


def billing_cadence(interval: Column, count: Column) -> Column:
    """Known cadences by name, any other as ``<interval> x<count>`` (NULL without a count)."""
    expr = F.when(F.lit(False), F.lit(None).cast("string"))
    for (unit, n), label in labels.BILLING_CADENCES.items():
        expr = expr.when((interval == unit) & (count == n), label)
    for unit, label in labels.BILLING_CADENCES_ANY_COUNT.items():
        expr = expr.when(interval == unit, label)
    return expr.otherwise(F.concat(interval, F.lit(" x"), count.cast("string")))


def dim_plans(stg_lines: DataFrame) -> DataFrame:
    """One row per plan and price, taken from its latest recurring line."""
    recurring = stg_lines.filter(F.col("is_recurring") & F.col("plan_id").isNotNull())
    latest = latest_values(recurring, ["plan_id", "price_id"],
                           ["plan_interval", "plan_interval_count", "currency", "mrr_amount_usd"],
                           ("loaded_at", "ingestion_run_id", "line_item_id"))
    price = F.col("mrr_amount_usd")
    return latest.select(
        surrogate_key(F.col("plan_id"), F.col("price_id")).alias("plan_key"),
        "plan_id", "price_id", "plan_interval", "plan_interval_count",
        F.upper("currency").alias("currency"),
        billing_cadence(F.col("plan_interval"), F.col("plan_interval_count")).alias("billing_cadence"),
        banded(price, labels.PRICING_TIERS, labels.TOP_PRICING_TIER).alias("pricing_tier"),
        (F.col("plan_interval") == "year").alias("is_annual"),
        price.cast(MONEY).alias("monthly_price_usd"),
        (price * F.lit(Decimal(12))).cast(MONEY).alias("annual_price_usd"),
    )


# --- facts ------------------------------------------------------------------------------

def date_lookup(dim_dates: DataFrame, **options) -> Lookup:
    return Lookup(dim_dates.select("date_day", "date_key"), ["date_day"], **options)


def currency_lookup(dim_currencies: DataFrame, **options) -> Lookup:
    return Lookup(dim_currencies.select("currency_code", "currency_key"), ["currency_code"], **options)


def current_customers(dim_customers: DataFrame) -> DataFrame:
    return dim_customers.filter("is_current").select("customer_id", "customer_key")


def _with_customer_key(facts: DataFrame, dim_customers: DataFrame, row_id: str) -> DataFrame:
    return join_large(facts, current_customers(dim_customers), "customer_id", "customer_id",
                      {"customer_key": "customer_key"}, spread_by=row_id)


def _with_day(facts: DataFrame, dates: Lookup, day: str, into: str) -> DataFrame:
    return dates.attach(facts, {"date_day": F.col(day)}, {"date_key": into})


def _with_currency(facts: DataFrame, currencies: Lookup) -> DataFrame:
    return currencies.attach(facts, {"currency_code": F.upper("currency")}, {"currency_key": "currency_key"})


def fct_charges(stg: DataFrame, dim_customers: DataFrame, dates: Lookup, currencies: Lookup) -> DataFrame:
    c = stg.drop("payment_method_id", "card_exp_month", "card_exp_year", "statement_descriptor", "load_mode")
    c = _with_customer_key(c, dim_customers, "charge_id")
    return _with_currency(_with_day(c, dates, "created_date", "created_date_key"), currencies)


def _through_charge(facts: DataFrame, stg_charges: DataFrame, row_id: str) -> DataFrame:
    """Customer and day of the parent charge, in one join."""
    return join_large(facts, stg_charges.select("charge_id", "customer_id", "created_date"),
                      "charge_id", "charge_id",
                      {"customer_id": "customer_id", "created_date": "charge_created_date"},
                      spread_by=row_id)


def refund_days(stg: DataFrame, stg_charges: DataFrame) -> DataFrame:
    """Refunds with the customer of their charge and the days since it."""
    r = _through_charge(stg, stg_charges, "refund_id")
    r = r.withColumn("days_since_charge", days_between(F.col("charge_created_date"), F.col("created_date")))
    return r.drop("charge_created_date")


def fct_refunds(stg: DataFrame, stg_charges: DataFrame, dim_customers: DataFrame,
                dates: Lookup, currencies: Lookup) -> DataFrame:
    r = stg.drop("payment_intent_id", "failure_balance_transaction_id", "load_mode")
    r = _with_customer_key(refund_days(r, stg_charges), dim_customers, "refund_id")
    return _with_currency(_with_day(r, dates, "created_date", "created_date_key"), currencies)


def fct_disputes(stg: DataFrame, stg_charges: DataFrame, dim_customers: DataFrame,
                 dates: Lookup, currencies: Lookup) -> DataFrame:
    d = _through_charge(stg.drop("payment_intent_id", "load_mode"), stg_charges, "dispute_id")
    lost = F.when(F.col("is_lost"), F.col("amount_usd")).otherwise(F.lit(Decimal("0.00"))).cast(MONEY)
    d = d.withColumns({
        "days_since_charge": days_between(F.col("charge_created_date"), F.col("created_date")),
        "loss_amount_usd": lost,
    })
    d = _with_customer_key(d.drop("charge_created_date"), dim_customers, "dispute_id")
    return _with_currency(_with_day(d, dates, "created_date", "created_date_key"), currencies)


def fct_payouts(stg: DataFrame, dates: Lookup, currencies: Lookup) -> DataFrame:
    p = stg.drop("failure_balance_transaction_id", "load_mode")
    p = _with_day(p, dates, "created_date", "created_date_key")
    return _with_currency(_with_day(p, dates, "arrival_date", "arrival_date_key"), currencies)


def source_customers(stg_charges: DataFrame, stg_refunds: DataFrame, stg_disputes: DataFrame,
                     unique: bool = True) -> DataFrame:
    """The customer behind each ledger source: a charge, or a refund or dispute of one.

    Ids of different kinds share a namespace only by accident; ``unique`` keeps one row per id.
    """
    charges = stg_charges.filter(F.col("customer_id").isNotNull()).select("charge_id", "customer_id")
    claims = stg_refunds.select(F.col("refund_id").alias("source_id"), "charge_id").unionByName(
        stg_disputes.select(F.col("dispute_id").alias("source_id"), "charge_id")
    )
    claimed = join_large(claims, charges, "charge_id", "charge_id", {"customer_id": "customer_id"},
                         spread_by="source_id")
    sources = charges.withColumnRenamed("charge_id", "source_id").unionByName(
        claimed.filter(F.col("customer_id").isNotNull()).select("source_id", "customer_id")
    )
    return sources.groupBy("source_id").agg(F.min("customer_id").alias("customer_id")) if unique else sources


def fct_transactions(stg_ledger: DataFrame, dim_customers: DataFrame, dates: Lookup,
                     sources: DataFrame | None = None) -> DataFrame:
    """The ledger with its customer and day.

    A source id that is a customer id matches directly. With ``sources`` (see
    ``source_customers``, which need not be unique) any other id is resolved through its charge.
    """
    ledger = stg_ledger
    current = current_customers(dim_customers)
    if sources is None:
        keyed = join_large(ledger, current, "source_id", "customer_id",
                           {"customer_key": "customer_key"}, spread_by="transaction_id")
    else:
        # Resolve the small id pairs first; the wide ledger rows are then shuffled once.
        resolved = join_large(sources, current, "customer_id", "customer_id",
                              {"customer_key": "customer_key"}, spread_by="source_id")
        direct = current.select(F.col("customer_id").alias("source_id"), "customer_key",
                                F.struct(F.lit(0).alias("via"), "customer_id").alias("_via"))
        through = resolved.filter(F.col("customer_key").isNotNull()).select(
            "source_id", "customer_key", F.struct(F.lit(1).alias("via"), "customer_id").alias("_via"))
        # The only aggregate over the ids.
        keys = direct.unionByName(through).groupBy("source_id").agg(
            F.min_by("customer_key", "_via").alias("customer_key"))
        keyed = join_large(ledger, keys, "source_id", "source_id",
                           {"customer_key": "customer_key"}, spread_by="transaction_id")
    return _with_day(keyed, dates, "created_date", "date_key")


def recurring_by_subscription(stg_lines: DataFrame) -> DataFrame:
    """Recurring revenue per subscription, plan and billing month."""
    return (
        stg_lines.filter(F.col("is_recurring") & F.col("mrr_amount_usd").isNotNull())
        .groupBy("subscription", "plan_id", month_of(F.col("period_start_date")).alias("billing_month"))
        .agg(F.sum("mrr_amount_usd").alias("mrr_usd"))
    )


def subscription_customers(raw_subscriptions: DataFrame) -> DataFrame:
    latest = latest_values(raw_subscriptions, ["id"], ["customer"])
    return latest.select(F.col("id").alias("subscription_id"), F.col("customer").alias("customer_id"))


def movement_type(mrr: Column, prior: Column) -> Column:
    return (
        F.when(prior.isNull(), "New")
        .when((mrr == 0) & (prior > 0), "Churn")
        .when(mrr > prior, "Expansion")
        .when((mrr < prior) & (mrr > 0), "Contraction")
        .otherwise("No Change")
    )


def fct_mrr_movements(stg_lines: DataFrame, raw_subscriptions: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Monthly recurring revenue per customer and plan, compared with its preceding row.

    Lines are summed per subscription before any join, then to the output grain, so the
    join and the window see at most one row per subscription or customer, plan and month.
    """
    by_subscription = recurring_by_subscription(stg_lines)
    owned = join_large(by_subscription, subscription_customers(raw_subscriptions),
                       "subscription", "subscription_id", {"customer_id": "owner"},
                       spread_by="plan_id")
    monthly = owned.groupBy(
        F.coalesce("owner", "subscription").alias("customer_id"), "plan_id", "billing_month"
    ).agg(F.sum("mrr_usd").cast(MONEY).alias("mrr_usd"))
    series = Window.partitionBy("customer_id", "plan_id").orderBy("billing_month")
    compared = monthly.withColumn("prior_mrr_usd", F.lag("mrr_usd").over(series))
    mrr, prior = F.col("mrr_usd"), F.col("prior_mrr_usd")
    change = mrr - F.coalesce(prior, F.lit(Decimal("0.00")))
    return compared.select(
        surrogate_key(F.col("customer_id"), F.col("plan_id"), F.col("billing_month")).alias("mrr_key"),
        "customer_id", "plan_id", "billing_month", "mrr_usd", "prior_mrr_usd",
        change.cast(MONEY).alias("mrr_change_usd"),
        movement_type(mrr, prior).alias("movement_type"),
        _stamp(as_of),
    )
