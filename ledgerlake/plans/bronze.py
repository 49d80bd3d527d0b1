"""Bronze: typed and normalised projections of the RAW entities.

Every model is stateless, so the same function serves a batch frame and a stream.
Amounts stay in cents. Inputs are RAW frames in their declared schema.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.columns import (
    epoch_date, epoch_timestamp, flag, is_true, lowered, uppered,
)
from ledgerlake.operators.dedup import ROW_HASH

LOADED = ("source_file", "ingestion_run_id", "load_mode", "loaded_at")


def _loaded(raw: DataFrame) -> list[str]:
    """The load columns, and the stored hash of the row where the table has it."""
    return [*LOADED, *(c for c in raw.columns if c == ROW_HASH)]


# The payload fields the charge model reads; everything is text until cast.
CHARGE_PAYLOAD = """
    customer string, invoice string, payment_intent string, payment_method string,
    balance_transaction string, failure_code string, failure_message string,
    description string, receipt_email string, receipt_url string, statement_descriptor string,
    payment_method_details struct<type: string, card: struct<brand: string, funding: string,
        country: string, last4: string, exp_month: string, exp_year: string>>
"""


def _created(col: str = "created") -> list[Column]:
    return [epoch_timestamp(F.col(col)).alias("created_at"), epoch_date(F.col(col)).alias("created_date")]


def brz_fx_rates(raw: DataFrame) -> DataFrame:
    """Usable rates only: present and positive."""
    return raw.filter(F.col("rate").isNotNull() & (F.col("rate") > 0)).select(
        "rate_date",
        uppered(F.col("from_currency")).alias("from_currency"),
        uppered(F.col("to_currency")).alias("to_currency"),
        "rate",
        "source",
        *_loaded(raw),
    )


def brz_stripe_balance_transactions(raw: DataFrame) -> DataFrame:
    return raw.select(
        "id", "amount", "fee", "net", "exchange_rate",
        *_created(),
        epoch_timestamp(F.col("available_on")).alias("available_on_at"),
        lowered(F.col("currency")).alias("currency"),
        lowered(F.col("status"), "unknown").alias("status"),
        lowered(F.col("type"), "unknown").alias("event_type"),
        lowered(F.col("reporting_category"), "unknown").alias("reporting_category"),
        F.col("source").alias("source_id"),
        "description",
        *_loaded(raw),
    )


def brz_stripe_charges(raw: DataFrame) -> DataFrame:
    """Core columns come from the flat row, all others from the payload, parsed once."""
    parsed = raw.withColumn("p", F.from_json("raw_payload", CHARGE_PAYLOAD))
    card = F.col("p.payment_method_details.card")
    plain = {
        "customer": "customer_id",
        "invoice": "invoice_id",
        "payment_intent": "payment_intent_id",
        "payment_method": "payment_method_id",
        "balance_transaction": "balance_transaction_id",
        "failure_code": "failure_code",
        "failure_message": "failure_message",
        "description": "description",
        "receipt_email": "receipt_email",
        "receipt_url": "receipt_url",
        "statement_descriptor": "statement_descriptor",
    }
    return parsed.select(
        "id", "amount", "amount_captured", "amount_refunded",
        lowered(F.col("status"), "unknown").alias("status"),
        *(flag(F.col(c), False).alias(c) for c in ("paid", "captured", "refunded", "disputed")),
        lowered(F.col("currency"), "usd").alias("currency"),
        *_created(),
        *(F.col(f"p.{src}").alias(dst) for src, dst in plain.items()),
        lowered(F.col("p.payment_method_details.type"), "unknown").alias("payment_method_type"),
        lowered(card["brand"], "unknown").alias("card_brand"),
        lowered(card["funding"], "unknown").alias("card_funding"),
        uppered(card["country"], "UNKNOWN").alias("card_country"),
        card["last4"].alias("card_last4"),
        card["exp_month"].try_cast("long").alias("card_exp_month"),
        card["exp_year"].try_cast("long").alias("card_exp_year"),
        *_loaded(raw),
    )


def brz_stripe_customers(raw: DataFrame) -> DataFrame:
    return raw.select(
        "id",
        *_created(),
        lowered(F.col("currency"), "usd").alias("currency"),
        "description",
        lowered(F.col("email")).alias("email"),
        "name", "phone",
        uppered(F.col("address_country"), "UNKNOWN").alias("billing_country"),
        "address_city", "address_line1", "address_postal_code", "delinquent", "balance",
        lowered(F.col("tax_exempt"), "none").alias("tax_exempt"),
        *_loaded(raw),
    )


def brz_stripe_disputes(raw: DataFrame) -> DataFrame:
    status = F.lower("status")
    return raw.select(
        "id", "amount",
        lowered(F.col("currency"), "usd").alias("currency"),
        lowered(F.col("status"), "unknown").alias("status"),
        lowered(F.col("reason"), "unknown").alias("reason"),
        is_true(status == "won").alias("is_won"),
        is_true(status == "lost").alias("is_lost"),
        flag(F.col("is_charge_refundable"), False).alias("is_charge_refundable"),
        *_created(),
        epoch_timestamp(F.col("evidence_details_due_by")).alias("evidence_due_at"),
        epoch_date(F.col("evidence_details_due_by")).alias("evidence_due_date"),
        flag(F.col("evidence_details_has_evidence"), False).alias("has_evidence_submitted"),
        F.col("charge").alias("charge_id"),
        F.col("payment_intent").alias("payment_intent_id"),
        F.col("balance_transaction").alias("balance_transaction_id"),
        *_loaded(raw),
    )


def brz_stripe_invoice_line_items(raw: DataFrame) -> DataFrame:
    return raw.select(
        "id", "invoice_id", "amount",
        lowered(F.col("currency")).alias("currency"),
        "description",
        epoch_timestamp(F.col("period_start")).alias("period_start_at"),
        epoch_timestamp(F.col("period_end")).alias("period_end_at"),
        epoch_date(F.col("period_start")).alias("period_start_date"),
        epoch_date(F.col("period_end")).alias("period_end_date"),
        "plan_id",
        lowered(F.col("plan_interval"), "unknown").alias("plan_interval"),
        "plan_interval_count", "plan_amount", "price_id", "proration", "quantity",
        "subscription", "subscription_item",
        lowered(F.col("type"), "unknown").alias("line_item_type"),
        *_loaded(raw),
    )


def brz_stripe_payouts(raw: DataFrame) -> DataFrame:
    return raw.select(
        "id", "amount",
        lowered(F.col("currency"), "usd").alias("currency"),
        lowered(F.col("status"), "unknown").alias("status"),
        lowered(F.col("type"), "bank_account").alias("payout_type"),
        lowered(F.col("method"), "standard").alias("method"),
        flag(F.col("automatic"), True).alias("automatic"),
        *_created(),
        epoch_timestamp(F.col("arrival_date")).alias("arrival_at"),
        epoch_date(F.col("arrival_date")).alias("arrival_date"),
        F.col("destination").alias("destination_id"),
        F.col("balance_transaction").alias("balance_transaction_id"),
        "failure_code", "failure_message",
        F.col("failure_balance_transaction").alias("failure_balance_transaction_id"),
        "description", "statement_descriptor", "source_type",
        *_loaded(raw),
    )


def brz_stripe_refunds(raw: DataFrame) -> DataFrame:
    return raw.select(
        "id", "amount",
        lowered(F.col("currency"), "usd").alias("currency"),
        lowered(F.col("status"), "unknown").alias("status"),
        *_created(),
        F.col("charge").alias("charge_id"),
        F.col("payment_intent").alias("payment_intent_id"),
        F.col("balance_transaction").alias("balance_transaction_id"),
        lowered(F.col("reason"), "requested_by_customer").alias("reason"),
        "description", "receipt_number",
        F.col("failure_balance_transaction").alias("failure_balance_transaction_id"),
        lowered(F.col("failure_reason")).alias("failure_reason"),
        *_loaded(raw),
    )


# RAW entity -> (Bronze table, model)
MODELS: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "fx_rates": ("brz_fx_rates", brz_fx_rates),
    "balance_transactions": ("brz_stripe_balance_transactions", brz_stripe_balance_transactions),
    "charges": ("brz_stripe_charges", brz_stripe_charges),
    "customers": ("brz_stripe_customers", brz_stripe_customers),
    "disputes": ("brz_stripe_disputes", brz_stripe_disputes),
    "invoice_line_items": ("brz_stripe_invoice_line_items", brz_stripe_invoice_line_items),
    "payouts": ("brz_stripe_payouts", brz_stripe_payouts),
    "refunds": ("brz_stripe_refunds", brz_stripe_refunds),
}
