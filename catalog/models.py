"""Bronze, Silver and Gold models."""

from __future__ import annotations

from pyspark.sql import functions as F

import oracles as o
from catalog.base import register, register_table, warehouse
from ledgerlake.plans import bronze, gold, silver

# --- Bronze -----------------------------------------------------------------------------

for _id, _entity in {
    "B1": "fx_rates", "B2": "balance_transactions", "B3": "charges", "B4": "customers",
    "B5": "disputes", "B6": "invoice_line_items", "B7": "payouts", "B8": "refunds",
}.items():
    _table = bronze.MODELS[_entity][0]
    register(f"{_id}_{_table}", o.whole(_table))(
        lambda s, d, e=_entity: warehouse(s, d).bronze(e))

# --- Silver -----------------------------------------------------------------------------

for _id, _table in {
    "V1": "stg_charges", "V2": "stg_refunds", "V3": "stg_disputes", "V4": "stg_payouts",
    "V5": "stg_invoice_line_items", "V6": "stg_finance_ledger_events", "V7": "stg_customers_history",
}.items():
    register_table(f"{_id}_{_table}", _table)


@register("V5_daily_usd_unscaled", o.whole("stg_invoice_line_items_unscaled"))
def _(spark, sf_dir):
    w = warehouse(spark, sf_dir)
    return silver.stg_invoice_line_items(w.bronze("invoice_line_items"), w.rates, daily_usd_scaled=False)


@register("V6_currency_case_kept", o.whole("stg_finance_ledger_events_case"))
def _(spark, sf_dir):
    w = warehouse(spark, sf_dir)
    return silver.stg_finance_ledger_events(w.bronze("balance_transactions"), w.rates,
                                            match_currency_case=True)


# --- Gold -------------------------------------------------------------------------------

for _id, _table in {
    "G1": "dim_customers", "G3": "dim_currencies", "G4": "dim_geography", "G5": "dim_payment_category",
    "G6": "dim_plans", "G7": "fct_charges", "G8": "fct_refunds", "G9": "fct_disputes",
    "G10": "fct_payouts", "G11": "fct_transactions", "G12": "fct_mrr_movements",
}.items():
    register_table(f"{_id}_{_table}", _table)


@register("G11_direct_match_only", o.whole("fct_transactions_direct"))
def _(spark, sf_dir):
    return warehouse(spark, sf_dir, resolve_sources=False).fct_transactions


@register("G2_dim_dates", o.whole("dim_dates_active"))
def _(spark, sf_dir):
    """The calendar from the first to the last day with a charge."""
    days = warehouse(spark, sf_dir).bronze("charges").agg(
        F.min("created_date").alias("first"), F.max("created_date").alias("last"))
    return gold.calendar(days.select(F.explode(F.sequence("first", "last")).alias("date_day")))
