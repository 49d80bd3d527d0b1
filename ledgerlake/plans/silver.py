"""Silver: one row per business key, amounts in currency units and in USD.

Each model keeps the newest version of a key first and converts afterwards, so the
rate lookup sees every key once.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.columns import (
    OPEN_END, days_between, is_true, key_text, surrogate_key,
)
from ledgerlake.functions.money import from_cents, from_cents_at, monthly, negated, outflow
from ledgerlake.operators.dedup import dedup_latest
from ledgerlake.operators.fx import with_usd_rate
from ledgerlake.operators.history import with_next, with_previous_hash
from ledgerlake.operators.lookup import Lookup

AUDIT = ("ingestion_run_id", "load_mode", "loaded_at")

# Ledger events that reduce the balance.
OUTGOING_EVENTS = ("refund", "dispute", "adjustment")
# Dispute states that still wait for an answer.
OPEN_DISPUTES = ("needs_response", "warning_needs_response")


def _latest_with_rate(brz: DataFrame, rates: Lookup, day: str = "created_date",
                      currency: Column | None = None) -> DataFrame:
    latest = dedup_latest(brz, ["id"])
    return with_usd_rate(latest, rates, F.upper("currency") if currency is None else currency, F.col(day))


def stg_charges(brz: DataFrame, rates: Lookup) -> DataFrame:
    c = _latest_with_rate(brz, rates)
    net = F.col("amount") - F.col("amount_refunded")
    rate = F.col("usd_rate")
    return c.select(
        F.col("id").alias("charge_id"),
        "customer_id", "invoice_id", "payment_intent_id", "payment_method_id",
        "balance_transaction_id",
        "status", "paid", "captured", "refunded", "currency",
        from_cents(F.col("amount")).alias("amount"),
        from_cents(F.col("amount_captured")).alias("amount_captured"),
        from_cents(F.col("amount_refunded")).alias("amount_refunded"),
        from_cents(net).alias("net_amount"),
        "usd_rate",
        from_cents_at(F.col("amount"), rate).alias("amount_usd"),
        from_cents_at(F.col("amount_captured"), rate).alias("amount_captured_usd"),
        from_cents_at(F.col("amount_refunded"), rate).alias("amount_refunded_usd"),
        from_cents_at(net, rate).alias("net_amount_usd"),
        "payment_method_type", "card_brand", "card_funding", "card_country", "card_last4",
        "card_exp_month", "card_exp_year",
        "failure_code", "failure_message",
        F.col("failure_code").isNotNull().alias("is_failed"),
        "created_at", "created_date",
        "description", "receipt_url", "statement_descriptor",
        *AUDIT,
    )


def stg_refunds(brz: DataFrame, rates: Lookup) -> DataFrame:
    r = _latest_with_rate(brz, rates)
    amount = from_cents(F.col("amount"))
    amount_usd = from_cents_at(F.col("amount"), F.col("usd_rate"))
    return r.select(
        F.col("id").alias("refund_id"),
        "charge_id", "payment_intent_id", "balance_transaction_id",
        "status", "reason",
        (F.col("status") == "succeeded").alias("is_successful"),
        "currency",
        amount.alias("amount"),
        negated(amount).alias("signed_amount"),
        "usd_rate",
        amount_usd.alias("amount_usd"),
        negated(amount_usd).alias("signed_amount_usd"),
        "failure_balance_transaction_id", "failure_reason",
        F.col("failure_reason").isNotNull().alias("is_failed"),
        "created_at", "created_date",
        "description", "receipt_number",
        *AUDIT,
    )


def dispute_outcome(status: Column) -> Column:
    return (
        F.when(status == "won", "Won")
        .when(status == "lost", "Lost")
        .when(status == "charge_refunded", "Charge Refunded")
        .when(status.startswith("warning"), "Warning")
        .when(status.isin("needs_response", "under_review"), "In Progress")
        .otherwise("Unknown")
    )


def stg_disputes(brz: DataFrame, rates: Lookup, as_of: dt.date) -> DataFrame:
    """``as_of`` is the day against which evidence deadlines are judged."""
    d = _latest_with_rate(brz, rates)
    amount = from_cents(F.col("amount"))
    amount_usd = from_cents_at(F.col("amount"), F.col("usd_rate"))
    overdue = (F.col("evidence_due_date") < F.lit(as_of)) & F.col("status").isin(*OPEN_DISPUTES)
    return d.select(
        F.col("id").alias("dispute_id"),
        "charge_id", "payment_intent_id", "balance_transaction_id",
        "status", "reason", "is_won", "is_lost", "is_charge_refundable", "has_evidence_submitted",
        dispute_outcome(F.col("status")).alias("outcome_category"),
        "currency",
        amount.alias("amount"),
        negated(amount).alias("signed_amount"),
        "usd_rate",
        amount_usd.alias("amount_usd"),
        negated(amount_usd).alias("signed_amount_usd"),
        "evidence_due_at", "evidence_due_date",
        days_between(F.col("created_date"), F.col("evidence_due_date")).alias("days_to_evidence_due"),
        is_true(overdue).alias("is_overdue"),
        "created_at", "created_date",
        *AUDIT,
    )


def stg_payouts(brz: DataFrame, rates: Lookup) -> DataFrame:
    p = _latest_with_rate(brz, rates)
    return p.select(
        F.col("id").alias("payout_id"),
        "balance_transaction_id", "destination_id",
        "status", "payout_type", "method", "automatic", "source_type",
        (F.col("status") == "paid").alias("is_paid"),
        (F.col("status") == "failed").alias("is_failed"),
        (F.col("status") == "canceled").alias("is_canceled"),
        (F.col("method") == "instant").alias("is_instant"),
        "currency",
        from_cents(F.col("amount")).alias("amount"),
        "usd_rate",
        from_cents_at(F.col("amount"), F.col("usd_rate")).alias("amount_usd"),
        "created_at", "created_date", "arrival_at", "arrival_date",
        days_between(F.col("created_date"), F.col("arrival_date")).alias("transit_days"),
        "failure_code", "failure_message", "failure_balance_transaction_id",
        "description", "statement_descriptor",
        *AUDIT,
    )


def stg_invoice_line_items(brz: DataFrame, rates: Lookup, daily_usd_scaled: bool = True,
                           divide_by_interval_count: bool = False) -> DataFrame:
    """Recurring lines are flagged, not filtered.

    ``daily_usd_scaled=False`` leaves daily plans unscaled in USD only;
    ``divide_by_interval_count`` spreads multi-interval plans over their intervals.
    """
    li = _latest_with_rate(brz, rates, day="period_start_date")
    count = F.col("plan_interval_count") if divide_by_interval_count else None
    interval = F.col("plan_interval")
    recurring = (F.col("line_item_type") == "subscription") & ~F.coalesce(F.col("proration"), F.lit(False))
    return li.select(
        F.col("id").alias("line_item_id"),
        "invoice_id", "subscription", "subscription_item", "plan_id", "price_id",
        "plan_interval", "plan_interval_count", "period_start_date", "period_end_date",
        "currency", "proration", "quantity", "line_item_type",
        recurring.alias("is_recurring"),
        from_cents(F.col("amount")).alias("amount"),
        monthly(F.col("amount"), interval, interval_count=count).alias("mrr_amount"),
        "usd_rate",
        monthly(F.col("amount"), interval, F.col("usd_rate"), count, daily_usd_scaled)
        .alias("mrr_amount_usd"),
        *AUDIT,
    )


def stg_finance_ledger_events(brz: DataFrame, rates: Lookup, match_currency_case: bool = False) -> DataFrame:
    """``match_currency_case=True`` looks rates up by the lower-case code, which finds none."""
    currency = F.col("currency") if match_currency_case else F.upper("currency")
    t = _latest_with_rate(brz, rates, currency=currency)
    rate = F.col("usd_rate")
    net, net_usd = from_cents(F.col("net")), from_cents_at(F.col("net"), rate)
    outgoing = F.col("event_type").isin(*OUTGOING_EVENTS)
    return t.select(
        F.col("id").alias("transaction_id"),
        "source_id", "event_type", "reporting_category", "status", "currency",
        "created_at", "created_date", "available_on_at",
        from_cents(F.col("amount")).alias("amount"),
        from_cents(F.col("fee")).alias("fee"),
        net.alias("net_amount"),
        "usd_rate",
        from_cents_at(F.col("amount"), rate).alias("amount_usd"),
        from_cents_at(F.col("fee"), rate).alias("fee_usd"),
        net_usd.alias("net_amount_usd"),
        F.when(outgoing, outflow(net)).otherwise(net).alias("signed_net_amount"),
        F.when(outgoing, outflow(net_usd)).otherwise(net_usd).alias("signed_net_amount_usd"),
        "description",
        *AUDIT,
    )


CUSTOMER_ATTRIBUTES = (
    "created_at", "created_date", "currency", "email", "name", "phone", "billing_country",
    "address_city", "address_postal_code", "delinquent", "balance", "tax_exempt",
)


def stg_customers_history(brz: DataFrame, existing: DataFrame | None = None,
                          changes_only: bool = False) -> DataFrame:
    """One row per customer and load, with its interval of validity.

    Given the ``existing`` history, only customers present in ``brz`` are recomputed, so the
    result is the set of rows to upsert: closed old versions and new ones.
    ``changes_only`` drops a version whose attributes equal the preceding one's.
    """
    versions = brz.select(F.col("id").alias("customer_id"), *CUSTOMER_ATTRIBUTES, *AUDIT)
    if existing is not None:
        touched = versions.select("customer_id").distinct()
        old = existing.join(touched, "customer_id", "left_semi").select(*versions.columns)
        versions = old.unionByName(versions)
    versions = dedup_latest(versions, ["customer_id", "loaded_at"])
    if changes_only:
        compared = with_previous_hash(versions, "customer_id", "loaded_at", CUSTOMER_ATTRIBUTES, "_before")
        same = F.col("_before").eqNullSafe(F.xxhash64(*CUSTOMER_ATTRIBUTES))
        versions = compared.filter(~same).drop("_before")
    spans = with_next(versions, "customer_id", "loaded_at", "_until")
    return spans.select(
        surrogate_key(F.col("customer_id"), key_text(F.col("loaded_at"))).alias("customer_key"),
        "customer_id",
        *CUSTOMER_ATTRIBUTES,
        F.col("loaded_at").alias("valid_from"),
        F.coalesce(F.col("_until"), F.lit(OPEN_END).cast("timestamp_ntz")).alias("valid_to"),
        F.col("_until").isNull().alias("is_current"),
        *AUDIT,
    )
