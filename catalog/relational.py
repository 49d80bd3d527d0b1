"""Joins (J), aggregations (A), window functions (W), sorts and set operations (O)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

import oracles as o
from catalog.base import AS_OF, raw, register, warehouse
from ledgerlake.functions.money import RATE
from ledgerlake.operators.dedup import dedup_latest
from ledgerlake.operators.fx import daily_rates, missing_rates, rate_lookup, with_usd_rate
from ledgerlake.operators.history import with_next
from ledgerlake.operators.lookup import join_large
from ledgerlake.plans import gold, silver

# --- joins ------------------------------------------------------------------------------

_RATED = """
SELECT b.id, b.loaded_at, ifnull(fx.rate, CAST(1 AS DECIMAL(12,6))) AS usd_rate FROM brz_stripe_charges b
LEFT JOIN fx ON fx.from_currency = upper(b.currency) AND fx.rate_date = b.created_date"""


def _rated(spark, sf_dir, **options):
    w = warehouse(spark, sf_dir)
    rates = rate_lookup(daily_rates(w.bronze("fx_rates")), **options)
    rated = with_usd_rate(w.bronze("charges"), rates, F.upper("currency"), F.col("created_date"))
    return rated.select("id", "loaded_at", "usd_rate")


@register("J1_fx_join", o.statement("brz_stripe_charges fx", _RATED))
def _(spark, sf_dir):
    return _rated(spark, sf_dir)


@register("J1_fx_join_beyond_broadcast", o.statement("brz_stripe_charges fx", _RATED))
def _(spark, sf_dir):
    """The same join with a rate table declared too large to broadcast: salted shuffle join."""
    return _rated(spark, sf_dir, limit=0, salts=4)


@register("J1_missing_rates", o.statement("brz_stripe_disputes fx", """
SELECT upper(b.currency) AS currency, count(*) AS fx_missing FROM brz_stripe_disputes b
LEFT JOIN fx ON fx.from_currency = upper(b.currency) AND fx.rate_date = b.created_date
WHERE fx.rate IS NULL GROUP BY ALL"""))
def _(spark, sf_dir):
    w = warehouse(spark, sf_dir)
    return missing_rates(w.bronze("disputes"), w.rates, F.upper("currency"), F.col("created_date"))


@register("J2_customer_key", o.statement("stg_charges dim_customers", f"""
SELECT f.charge_id, f.customer_id, cu.customer_key FROM stg_charges f {o.CUSTOMER_JOIN} f.customer_id"""))
def _(spark, sf_dir):
    w = warehouse(spark, sf_dir)
    return join_large(w.stg_charges.select("charge_id", "customer_id"), gold.current_customers(w.dim_customers),
                      "customer_id", "customer_id", {"customer_key": "customer_key"}, spread_by="charge_id")


@register("J3_date_keys", o.statement("stg_payouts dim_dates", f"""
SELECT f.payout_id, dd.date_key AS created_date_key, ad.date_key AS arrival_date_key FROM stg_payouts f
{o.CREATED_JOIN} LEFT JOIN dim_dates ad ON ad.date_day = f.arrival_date"""))
def _(spark, sf_dir):
    w = warehouse(spark, sf_dir)
    payouts = w.stg_payouts.select("payout_id", "created_date", "arrival_date")
    for day, into in (("created_date", "created_date_key"), ("arrival_date", "arrival_date_key")):
        payouts = w.dates.attach(payouts, {"date_day": F.col(day)}, {"date_key": into})
    return payouts.drop("created_date", "arrival_date")


@register("J4_currency_key", o.statement("stg_refunds dim_currencies", f"""
SELECT f.refund_id, f.currency, cc.currency_key FROM stg_refunds f {o.CURRENCY_JOIN}"""))
def _(spark, sf_dir):
    w = warehouse(spark, sf_dir)
    return w.currencies.attach(w.stg_refunds.select("refund_id", "currency"),
                               {"currency_code": F.upper("currency")}, {"currency_key": "currency_key"})


@register("J5_parent_charge", o.statement("brz_stripe_refunds stg_charges", """
SELECT r.id AS refund_id, r.charge_id, c.customer_id, c.created_date AS charge_created_date
FROM brz_stripe_refunds r LEFT JOIN stg_charges c ON c.charge_id = r.charge_id"""))
def _(spark, sf_dir):
    w = warehouse(spark, sf_dir)
    refunds = w.bronze("refunds").select(F.col("id").alias("refund_id"), "charge_id")
    return join_large(refunds, w.stg_charges, "charge_id", "charge_id",
                      {"customer_id": "customer_id", "created_date": "charge_created_date"},
                      spread_by="refund_id")


@register("J6_ledger_sources", o.statement("stg_charges stg_refunds stg_disputes", """
SELECT charge_id AS source_id, customer_id FROM stg_charges WHERE customer_id IS NOT NULL
UNION ALL SELECT r.refund_id, c.customer_id FROM stg_refunds r JOIN stg_charges c USING (charge_id)
 WHERE c.customer_id IS NOT NULL
UNION ALL SELECT d.dispute_id, c.customer_id FROM stg_disputes d JOIN stg_charges c USING (charge_id)
 WHERE c.customer_id IS NOT NULL"""))
def _(spark, sf_dir):
    w = warehouse(spark, sf_dir)
    return gold.source_customers(w.stg_charges, w.stg_refunds, w.stg_disputes)


@register("J7_subscription_owner", o.statement("recurring subscription_customers", """
SELECT r.subscription, r.plan_id, r.billing_month, ifnull(s.customer_id, r.subscription) AS customer_id
FROM recurring r LEFT JOIN subscription_customers s ON s.subscription_id = r.subscription"""))
def _(spark, sf_dir):
    w = warehouse(spark, sf_dir)
    owned = join_large(gold.recurring_by_subscription(w.stg_invoice_line_items),
                       gold.subscription_customers(raw(spark, sf_dir, "subscriptions")),
                       "subscription", "subscription_id", {"customer_id": "owner"}, spread_by="plan_id")
    return owned.select("subscription", "plan_id", "billing_month",
                        F.coalesce("owner", "subscription").alias("customer_id"))


@register("J8_anti_join_default_member", o.statement("brz_fx_rates", """
WITH f AS (SELECT * FROM brz_fx_rates WHERE from_currency <> 'USD'),
 c AS (SELECT DISTINCT from_currency AS currency_code FROM f)
SELECT currency_code FROM c UNION ALL SELECT 'USD' WHERE NOT EXISTS (SELECT 1 FROM c WHERE currency_code = 'USD')"""))
def _(spark, sf_dir):
    without_usd = warehouse(spark, sf_dir).bronze("fx_rates").filter("from_currency <> 'USD'")
    return gold.dim_currencies(without_usd, AS_OF.date()).select("currency_code")


# --- aggregations -----------------------------------------------------------------------

@register("A1_recurring_by_subscription", o.statement("recurring", "SELECT * FROM recurring"))
def _(spark, sf_dir):
    return gold.recurring_by_subscription(warehouse(spark, sf_dir).stg_invoice_line_items)


@register("A2_distinct", o.statement("stg_finance_ledger_events", """
SELECT DISTINCT event_type, reporting_category FROM stg_finance_ledger_events"""))
def _(spark, sf_dir):
    return warehouse(spark, sf_dir).stg_finance_ledger_events.select(
        "event_type", "reporting_category").distinct()


@register("A3_row_counts", o.statement(
    "raw_charges raw_refunds raw_disputes raw_payouts raw_invoice_line_items raw_balance_transactions",
    " UNION ALL ".join(
        f"SELECT '{e}' AS entity, count(*) AS n FROM raw_{e}"
        for e in ("charges", "refunds", "disputes", "payouts", "invoice_line_items", "balance_transactions"))))
def _(spark, sf_dir):
    frames = [
        raw(spark, sf_dir, e).agg(F.count(F.lit(1)).alias("n")).select(F.lit(e).alias("entity"), "n")
        for e in ("charges", "refunds", "disputes", "payouts", "invoice_line_items", "balance_transactions")
    ]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


@register("A4_distinct_count", o.statement("brz_stripe_charges", """
SELECT count(DISTINCT id) AS charges, count(DISTINCT customer_id) AS customers FROM brz_stripe_charges"""))
def _(spark, sf_dir):
    return warehouse(spark, sf_dir).bronze("charges").agg(
        F.count_distinct("id").alias("charges"), F.count_distinct("customer_id").alias("customers"))


@register("A5_newest_load", o.statement("raw_customers", """
SELECT max(loaded_at) AS max_loaded_at FROM raw_customers"""))
def _(spark, sf_dir):
    return raw(spark, sf_dir, "customers").agg(F.max("loaded_at").alias("max_loaded_at"))


# --- windows ----------------------------------------------------------------------------

@register("W1_latest_wins", o.statement(
    "brz_stripe_balance_transactions", f"SELECT * FROM {o.latest('brz_stripe_balance_transactions')}"))
def _(spark, sf_dir):
    return dedup_latest(warehouse(spark, sf_dir).bronze("balance_transactions"), ["id"])


@register("W2_daily_rates", o.statement("fx", "SELECT from_currency, rate_date, rate FROM fx"))
def _(spark, sf_dir):
    return daily_rates(warehouse(spark, sf_dir).bronze("fx_rates"))


@register("W3_latest_rate", o.statement("brz_fx_rates", """
SELECT from_currency, rate_date, CAST(rate AS DECIMAL(12,6)) AS rate FROM brz_fx_rates
QUALIFY row_number() OVER (PARTITION BY from_currency ORDER BY rate_date DESC, loaded_at DESC, ingestion_run_id DESC) = 1"""))
def _(spark, sf_dir):
    rates = warehouse(spark, sf_dir).bronze("fx_rates")
    latest = dedup_latest(rates, ["from_currency"], ("rate_date", "loaded_at", "ingestion_run_id"))
    return latest.select("from_currency", "rate_date", F.col("rate").cast(RATE).alias("rate"))


@register("W4_latest_plan_line", o.statement("stg_invoice_line_items", """
SELECT plan_id, price_id, line_item_id FROM stg_invoice_line_items WHERE is_recurring
QUALIFY row_number() OVER (PARTITION BY plan_id, price_id
 ORDER BY loaded_at DESC, ingestion_run_id DESC, line_item_id DESC) = 1"""))
def _(spark, sf_dir):
    lines = warehouse(spark, sf_dir).stg_invoice_line_items.filter("is_recurring")
    return dedup_latest(lines, ["plan_id", "price_id"], ("loaded_at", "ingestion_run_id", "line_item_id")).select(
        "plan_id", "price_id", "line_item_id")


@register("W5_latest_subscription", o.whole("subscription_customers"))
def _(spark, sf_dir):
    return gold.subscription_customers(raw(spark, sf_dir, "subscriptions"))


@register("W6_lead_next_load", o.statement("raw_customers", """
SELECT id, loaded_at, lead(loaded_at) OVER (PARTITION BY id ORDER BY loaded_at) AS next_loaded_at FROM raw_customers"""))
def _(spark, sf_dir):
    versions = raw(spark, sf_dir, "customers").select("id", "loaded_at")
    return with_next(versions, "id", "loaded_at", "next_loaded_at")


@register("W7_lag_prior_month", o.statement("monthly_mrr", """
SELECT customer_id, plan_id, billing_month, lag(mrr_usd) OVER w AS prior_mrr_usd,
 lag(billing_month) OVER w AS prior_billing_month
FROM monthly_mrr WINDOW w AS (PARTITION BY customer_id, plan_id ORDER BY billing_month)"""))
def _(spark, sf_dir):
    series = Window.partitionBy("customer_id", "plan_id").orderBy("billing_month")
    return warehouse(spark, sf_dir).fct_mrr_movements.select(
        "customer_id", "plan_id", "billing_month",
        F.lag("mrr_usd").over(series).alias("prior_mrr_usd"),
        F.lag("billing_month").over(series).alias("prior_billing_month"))


@register("W8_output_grain", o.statement("monthly_mrr", """
SELECT customer_id, plan_id, billing_month, 1::BIGINT AS n FROM monthly_mrr"""))
def _(spark, sf_dir):
    """Rows per customer, plan and month: always one."""
    return warehouse(spark, sf_dir).fct_mrr_movements.groupBy(
        "customer_id", "plan_id", "billing_month").agg(F.count(F.lit(1)).alias("n"))


@register("V7_changes_only", o.statement("brz_stripe_customers", f"""
WITH v AS {o.latest('brz_stripe_customers', 'id, loaded_at')},
 p AS (SELECT *, lag(row({o.HISTORY_COLUMNS})) OVER (PARTITION BY id ORDER BY loaded_at) AS before,
  row({o.HISTORY_COLUMNS}) AS now, row_number() OVER (PARTITION BY id ORDER BY loaded_at) AS rn FROM v),
 k AS (SELECT * FROM p WHERE rn = 1 OR now IS DISTINCT FROM before)
{o.history('k')}"""))
def _(spark, sf_dir):
    return silver.stg_customers_history(warehouse(spark, sf_dir).bronze("customers"), changes_only=True)


# --- sort, limit, union -----------------------------------------------------------------

@register("O1_top_ten", o.statement("stg_charges", """
SELECT charge_id, amount_usd FROM stg_charges ORDER BY amount_usd DESC, charge_id LIMIT 10"""))
def _(spark, sf_dir):
    return (
        warehouse(spark, sf_dir).stg_charges.select("charge_id", "amount_usd")
        .orderBy(F.col("amount_usd").desc(), "charge_id").limit(10)
    )


@register("O2_order_by", o.statement("stg_payouts", """
SELECT created_date, method, count(*) AS n FROM stg_payouts GROUP BY ALL ORDER BY 1 DESC, 2"""))
def _(spark, sf_dir):
    return (
        warehouse(spark, sf_dir).stg_payouts.groupBy("created_date", "method")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.col("created_date").desc(), "method")
    )


@register("O3_single_lookup", o.statement("raw_customers", """
SELECT max(created) AS created FROM raw_customers"""))
def _(spark, sf_dir):
    """The newest row alone, as the watermark lookup reads it."""
    return raw(spark, sf_dir, "customers").select("created").orderBy(F.col("created").desc()).limit(1)


@register("O4_union_all", o.statement("stg_charges stg_refunds", """
SELECT charge_id AS id, amount_usd AS signed_usd FROM stg_charges
UNION ALL SELECT refund_id, signed_amount_usd FROM stg_refunds"""))
def _(spark, sf_dir):
    w = warehouse(spark, sf_dir)
    charges = w.stg_charges.select(F.col("charge_id").alias("id"), F.col("amount_usd").alias("signed_usd"))
    refunds = w.stg_refunds.select(F.col("refund_id").alias("id"), F.col("signed_amount_usd").alias("signed_usd"))
    return charges.unionByName(refunds)
