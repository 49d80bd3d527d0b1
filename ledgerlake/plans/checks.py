"""The data tests declared for each table, and the freshness limits."""

from __future__ import annotations

from ledgerlake.operators.quality import Check
from ledgerlake.plans.labels import MOVEMENT_TYPES

LEDGER_EVENTS = ("charge", "refund", "dispute", "payout", "transfer", "adjustment", "payment")
CHARGE_STATUS = ("succeeded", "pending", "failed", "unknown")
REFUND_STATUS = ("succeeded", "pending", "failed", "canceled", "unknown")
REFUND_REASONS = ("requested_by_customer", "duplicate", "fraudulent", "expired_uncaptured_charge")
OUTCOMES = ("Won", "Lost", "Charge Refunded", "Warning", "In Progress", "Unknown")
PAYOUT_STATUS = ("paid", "pending", "in_transit", "canceled", "failed", "unknown")
PAYOUT_METHODS = ("standard", "instant")
REGIONS = ("Americas", "EMEA", "APAC", "Other")
FINANCIAL_CATEGORIES = ("Revenue", "Contra-Revenue", "Cash Movement", "Adjustment", "Other")
CADENCES = ("Monthly", "Quarterly", "Semi-Annual", "Annual", "Weekly", "Daily")
TIERS = ("Starter", "Growth", "Professional", "Enterprise")


def _present(*columns: str) -> list[Check]:
    return [Check(c, "not_null") for c in columns]


def _key(column: str, severity: str = "error") -> list[Check]:
    return [Check(column, "not_null"), Check(column, "unique", severity=severity)]


def _one_of(column: str, values: tuple[str, ...], required: bool = True) -> list[Check]:
    return (_present(column) if required else []) + [Check(column, "accepted_values", tuple(values))]


RAW = {
    "balance_transactions": _present("id"),
    "charges": _present("id"),
    "customers": _present("id"),
    "subscriptions": _present("id"),
    "invoices": _present("id"),
    "invoice_line_items": _present("id"),
    "fx_rates": _present("rate_date", "rate"),
}

SILVER = {
    "stg_finance_ledger_events": [
        *_key("transaction_id", "warn"), *_one_of("event_type", LEDGER_EVENTS),
        *_present("amount_usd", "created_date")],
    "stg_customers_history": [
        *_key("customer_key"), *_present("customer_id", "billing_country", "is_current")],
    "stg_invoice_line_items": [
        *_key("line_item_id", "warn"), *_present("mrr_amount_usd", "period_start_date")],
    "stg_charges": [
        *_key("charge_id"), *_one_of("status", CHARGE_STATUS), *_present("amount_usd", "created_date")],
    "stg_refunds": [
        *_key("refund_id"), *_one_of("status", REFUND_STATUS), *_one_of("reason", REFUND_REASONS),
        *_present("amount_usd", "created_date")],
    "stg_disputes": [
        *_key("dispute_id"), *_one_of("outcome_category", OUTCOMES),
        *_present("amount_usd", "created_date")],
    "stg_payouts": [
        *_key("payout_id"), *_one_of("status", PAYOUT_STATUS), *_one_of("method", PAYOUT_METHODS),
        *_present("amount_usd", "created_date")],
}

GOLD = {
    "fct_transactions": [
        *_key("transaction_id"), *_one_of("event_type", LEDGER_EVENTS),
        *_present("amount_usd", "created_date")],
    "fct_mrr_movements": [
        *_key("mrr_key"), *_one_of("movement_type", tuple(MOVEMENT_TYPES), required=False),
        *_present("mrr_usd")],
    "dim_customers": [*_key("customer_key"), *_present("customer_id", "billing_country")],
    "dim_dates": [*_key("date_key"), *_key("date_day")],
    "dim_plans": [
        *_key("plan_key"), *_present("plan_id"), *_one_of("billing_cadence", CADENCES),
        *_one_of("pricing_tier", TIERS, required=False)],
    "dim_currencies": [*_key("currency_key"), *_key("currency_code"), *_present("latest_usd_rate")],
    "dim_geography": [
        *_key("geography_key"), *_key("country_code"), *_one_of("region", REGIONS, required=False)],
    "dim_payment_category": [
        *_key("payment_category_key"), *_present("event_type"),
        *_one_of("financial_category", FINANCIAL_CATEGORIES, required=False)],
    "fct_charges": [
        *_key("charge_id"), *_one_of("status", CHARGE_STATUS), *_present("amount_usd", "created_date")],
    "fct_refunds": [
        *_key("refund_id"), *_one_of("reason", REFUND_REASONS),
        *_present("signed_amount_usd", "created_date")],
    "fct_disputes": [
        *_key("dispute_id"), *_one_of("outcome_category", OUTCOMES),
        *_present("amount_usd", "created_date")],
    "fct_payouts": [
        *_key("payout_id"), *_one_of("method", PAYOUT_METHODS), *_present("amount_usd", "created_date")],
}

# entity -> (warn after hours, error after hours); None switches the check off.
DEFAULT_FRESHNESS = (25, 49)
FRESHNESS: dict[str, tuple[int, int] | None] = {
    "balance_transactions": DEFAULT_FRESHNESS,
    "charges": DEFAULT_FRESHNESS,
    "customers": DEFAULT_FRESHNESS,
    "subscriptions": DEFAULT_FRESHNESS,
    "invoices": DEFAULT_FRESHNESS,
    "invoice_line_items": DEFAULT_FRESHNESS,
    "fx_rates": DEFAULT_FRESHNESS,
    "refunds": (72, 168),
    "disputes": (72, 168),
    "payouts": None,
    "prices": None,
    "products": None,
}
