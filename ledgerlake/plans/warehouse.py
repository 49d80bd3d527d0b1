"""All models wired together lazily, from RAW frames to the star schema."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.operators.dedup import latest_values
from ledgerlake.operators.fx import daily_rates, rate_lookup
from ledgerlake.operators.lookup import FIXED_WIDTH, Lookup
from ledgerlake.plans import bronze, gold, partials, silver
from ledgerlake.session import materialize, work_dir

# A row of the currency lookup: a short code and an MD5 key.
CURRENCY_ROW_BYTES = 2 * FIXED_WIDTH + 64


class Warehouse:
    """Each attribute is one table as a DataFrame; nothing runs before it is used.

    The only eager step is the rate table, written and measured once. ``raw`` returns the
    RAW frame of an entity. Pass ``resolve_sources=False`` to match ledger sources to
    customers by id only.
    """

    def __init__(self, spark: SparkSession, raw: Callable[[str], DataFrame], as_of: dt.datetime,
                 calendar_start: dt.date = gold.CALENDAR_START, calendar_end: dt.date = gold.CALENDAR_END,
                 resolve_sources: bool = True):
        self.spark = spark
        self.raw = raw
        self.as_of = as_of
        self.calendar_start = calendar_start
        self.calendar_end = calendar_end
        self.resolve_sources = resolve_sources

    def storing(self, tables: Mapping[str, Sequence[str]]) -> Warehouse:
        """The same models for a job that reads some tables more than once: these are written now, in
        the given columns, and read back by what is built on them. Nothing is kept for other jobs."""
        other = Warehouse(self.spark, self.raw, self.as_of, self.calendar_start, self.calendar_end, self.resolve_sources)
        other.rates = self.rates
        for name, columns in tables.items():
            found = getattr(other, name).select(*columns)
            setattr(other, name, materialize(found, work_dir(self.spark, name), self.spark))
        return other

    def bronze(self, entity: str) -> DataFrame:
        return bronze.MODELS[entity][1](self.raw(entity))

    @cached_property
    def rates(self) -> Lookup:
        found = daily_rates(self.bronze("fx_rates"))
        return rate_lookup(materialize(found, work_dir(self.spark, "rates"), self.spark))

    @cached_property
    def stg_charges(self) -> DataFrame:
        return silver.stg_charges(self.bronze("charges"), self.rates)

    @cached_property
    def stg_refunds(self) -> DataFrame:
        return silver.stg_refunds(self.bronze("refunds"), self.rates)

    @cached_property
    def stg_disputes(self) -> DataFrame:
        return silver.stg_disputes(self.bronze("disputes"), self.rates, self.as_of.date())

    @cached_property
    def stg_payouts(self) -> DataFrame:
        return silver.stg_payouts(self.bronze("payouts"), self.rates)

    @cached_property
    def stg_invoice_line_items(self) -> DataFrame:
        return silver.stg_invoice_line_items(self.bronze("invoice_line_items"), self.rates)

    @cached_property
    def stg_finance_ledger_events(self) -> DataFrame:
        return silver.stg_finance_ledger_events(self.bronze("balance_transactions"), self.rates)

    @cached_property
    def stg_customers_history(self) -> DataFrame:
        return silver.stg_customers_history(self.bronze("customers"))

    # What other models need of charges, refunds and disputes beyond their amounts: the same
    # rows as in Silver, without the rate lookup behind the amounts.

    @cached_property
    def charge_owners(self) -> DataFrame:
        return latest_values(self.bronze("charges"), ["id"], ["customer_id", "created_date"]).select(
            F.col("id").alias("charge_id"), "customer_id", "created_date")

    @cached_property
    def refund_charges(self) -> DataFrame:
        return latest_values(self.bronze("refunds"), ["id"], ["charge_id"]).select(
            F.col("id").alias("refund_id"), "charge_id")

    @cached_property
    def dispute_charges(self) -> DataFrame:
        return latest_values(self.bronze("disputes"), ["id"], ["charge_id"]).select(
            F.col("id").alias("dispute_id"), "charge_id")

    @cached_property
    def charges_daily(self) -> DataFrame:
        return partials.charges_daily(self.stg_charges)

    @cached_property
    def refunds_daily(self) -> DataFrame:
        return partials.refunds_daily(gold.refund_days(self.stg_refunds, self.charge_owners))

    @cached_property
    def disputes_daily(self) -> DataFrame:
        return partials.disputes_daily(self.stg_disputes)

    @cached_property
    def dim_customers(self) -> DataFrame:
        return gold.dim_customers(self.stg_customers_history)

    @cached_property
    def dim_dates(self) -> DataFrame:
        return gold.dim_dates(self.spark, self.calendar_start, self.calendar_end)

    @cached_property
    def dim_currencies(self) -> DataFrame:
        return gold.dim_currencies(self.bronze("fx_rates"), self.as_of.date())

    @cached_property
    def dim_geography(self) -> DataFrame:
        return gold.dim_geography(self.stg_customers_history, self.as_of)

    @cached_property
    def dim_payment_category(self) -> DataFrame:
        return gold.dim_payment_category(self.stg_finance_ledger_events, self.as_of)

    @cached_property
    def dim_plans(self) -> DataFrame:
        return gold.dim_plans(self.stg_invoice_line_items)

    @cached_property
    def dates(self) -> Lookup:
        days = (self.calendar_end - self.calendar_start).days + 1
        return gold.date_lookup(self.dim_dates, bytes_bound=days * (2 * FIXED_WIDTH + 32))

    @cached_property
    def currencies(self) -> Lookup:
        # At most one row per row of the rate lookup, plus USD.
        rows = self.rates.size // (3 * FIXED_WIDTH) + 1
        return gold.currency_lookup(self.dim_currencies, bytes_bound=rows * CURRENCY_ROW_BYTES)

    @cached_property
    def fct_charges(self) -> DataFrame:
        return gold.fct_charges(self.stg_charges, self.dim_customers, self.dates, self.currencies)

    @cached_property
    def fct_refunds(self) -> DataFrame:
        return gold.fct_refunds(self.stg_refunds, self.charge_owners, self.dim_customers,
                                self.dates, self.currencies)

    @cached_property
    def fct_disputes(self) -> DataFrame:
        return gold.fct_disputes(self.stg_disputes, self.charge_owners, self.dim_customers,
                                 self.dates, self.currencies)

    @cached_property
    def fct_payouts(self) -> DataFrame:
        return gold.fct_payouts(self.stg_payouts, self.dates, self.currencies)

    @cached_property
    def fct_transactions(self) -> DataFrame:
        sources = None
        if self.resolve_sources:
            sources = gold.source_customers(
                self.charge_owners, self.refund_charges, self.dispute_charges, unique=False)
        return gold.fct_transactions(self.stg_finance_ledger_events, self.dim_customers, self.dates, sources)

    @cached_property
    def fct_mrr_movements(self) -> DataFrame:
        return gold.fct_mrr_movements(self.stg_invoice_line_items, self.raw("subscriptions"), self.as_of)
