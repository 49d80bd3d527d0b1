"""Filters and projections (F) and scalar functions (X), each over whole tables."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

import oracles as o
from catalog.base import raw, register, warehouse
from ledgerlake.functions import columns as c
from ledgerlake.functions import money as m
from ledgerlake.operators.incremental import created_after, newer_than, since
from ledgerlake.plans import gold, labels, silver

FIRST_LOAD = dt.datetime(2024, 2, 1)


# --- projections and filters ------------------------------------------------------------

@register("F1_typed_projection", o.statement("brz_stripe_refunds", """
SELECT id AS refund_id, charge_id, amount, created_date FROM brz_stripe_refunds"""))
def _(spark, sf_dir):
    refunds = warehouse(spark, sf_dir).bronze("refunds")
    return refunds.select(F.col("id").alias("refund_id"), "charge_id", "amount", "created_date")


@register("F2_since_watermark", o.statement("raw_charges", """
SELECT id, loaded_at FROM raw_charges WHERE loaded_at > TIMESTAMP '2024-02-01'"""))
def _(spark, sf_dir):
    charges = raw(spark, sf_dir, "charges")
    held = charges.filter(F.col("loaded_at") <= F.lit(FIRST_LOAD).cast("timestamp_ntz"))
    return since(charges, held).select("id", "loaded_at")


@register("F2_since_empty_target", o.statement("raw_charges", "SELECT id, loaded_at FROM raw_charges"))
def _(spark, sf_dir):
    charges = raw(spark, sf_dir, "charges")
    return since(charges, charges.filter("amount < -1")).select("id", "loaded_at")


@register("F2_since_with_lookback", o.statement("raw_charges", """
SELECT id, loaded_at FROM raw_charges WHERE loaded_at > TIMESTAMP '2024-02-01'"""))
def _(spark, sf_dir):
    mark = FIRST_LOAD + dt.timedelta(days=1)
    return newer_than(raw(spark, sf_dir, "charges"), mark, lookback=dt.timedelta(days=1)).select(
        "id", "loaded_at")


@register("F3_positive_rates", o.statement("raw_fx_rates", """
SELECT from_currency, rate_date, rate FROM raw_fx_rates WHERE rate > 0"""))
def _(spark, sf_dir):
    rates = raw(spark, sf_dir, "fx_rates")
    return rates.filter(F.col("rate").isNotNull() & (F.col("rate") > 0)).select(
        "from_currency", "rate_date", "rate")


@register("F4_current_customers", o.statement("dim_customers", """
SELECT customer_id, customer_key FROM dim_customers WHERE is_current"""))
def _(spark, sf_dir):
    return gold.current_customers(warehouse(spark, sf_dir).dim_customers)


@register("F5_non_empty", o.statement("raw_customers", """
SELECT id, address_country FROM raw_customers WHERE address_country <> ''"""))
def _(spark, sf_dir):
    customers = raw(spark, sf_dir, "customers")
    return customers.filter(c.non_empty(F.col("address_country"))).select("id", "address_country")


@register("F6_recurring_lines", o.statement("stg_invoice_line_items", """
SELECT line_item_id, plan_id, mrr_amount_usd FROM stg_invoice_line_items
WHERE is_recurring AND mrr_amount_usd IS NOT NULL AND plan_id IS NOT NULL"""))
def _(spark, sf_dir):
    lines = warehouse(spark, sf_dir).stg_invoice_line_items
    kept = lines.filter(F.col("is_recurring") & F.col("mrr_amount_usd").isNotNull()
                        & F.col("plan_id").isNotNull())
    return kept.select("line_item_id", "plan_id", "mrr_amount_usd")


@register("F7_in_list", o.statement("brz_stripe_balance_transactions", """
SELECT id, event_type FROM brz_stripe_balance_transactions
WHERE event_type IN ('refund', 'dispute', 'adjustment')"""))
def _(spark, sf_dir):
    ledger = warehouse(spark, sf_dir).bronze("balance_transactions")
    return ledger.filter(F.col("event_type").isin(*silver.OUTGOING_EVENTS)).select("id", "event_type")


@register("F8_like_prefix", o.statement("brz_stripe_disputes", """
SELECT id, status FROM brz_stripe_disputes WHERE status LIKE 'warning%'"""))
def _(spark, sf_dir):
    disputes = warehouse(spark, sf_dir).bronze("disputes")
    return disputes.filter(F.col("status").startswith("warning")).select("id", "status")


@register("F9_case", o.statement("stg_disputes", "SELECT dispute_id, outcome_category FROM stg_disputes"))
def _(spark, sf_dir):
    disputes = warehouse(spark, sf_dir).bronze("disputes")
    return disputes.select(F.col("id").alias("dispute_id"),
                           silver.dispute_outcome(F.col("status")).alias("outcome_category"))


@register("F10_null_to_flag", o.statement("brz_stripe_charges", """
SELECT id, loaded_at, failure_code IS NOT NULL AS is_failed FROM brz_stripe_charges"""))
def _(spark, sf_dir):
    charges = warehouse(spark, sf_dir).bronze("charges")
    return charges.select("id", "loaded_at", F.col("failure_code").isNotNull().alias("is_failed"))


# --- scalar functions -------------------------------------------------------------------

def each(name: str, entity: str, keys: str, sql: str, build) -> None:
    """Key columns plus computed ones over a whole RAW view."""
    statement = o.statement(f"raw_{entity}", f"SELECT {keys}, {sql} FROM raw_{entity}")
    register(name, statement)(
        lambda s, d: raw(s, d, entity).select(*keys.split(", "), *(x.alias(n) for n, x in build().items())))


each("X1_case_with_default", "customers", "id, loaded_at",
     "lower(ifnull(currency, 'usd')) AS currency, upper(ifnull(address_country, 'UNKNOWN')) AS country",
     lambda: {"currency": c.lowered(F.col("currency"), "usd"),
              "country": c.uppered(F.col("address_country"), "UNKNOWN")})

each("X2_trim", "customers", "id, loaded_at",
     "trim('  ' || name || ' ') AS trimmed",
     lambda: {"trimmed": F.trim(F.concat(F.lit("  "), F.col("name"), F.lit(" ")))})

each("X3_title_case", "refunds", "id",
     """CASE reason WHEN 'duplicate' THEN 'Duplicate' WHEN 'Fraudulent' THEN 'Fraudulent'
        WHEN 'requested_by_customer' THEN 'Requested By Customer' END AS label""",
     lambda: {"label": c.title_case(F.col("reason"))})

each("X4_concat", "invoice_line_items", "id",
     "plan_interval || ' x' || plan_interval_count AS cadence, price_id || '!' AS price",
     lambda: {"cadence": F.concat(F.col("plan_interval"), F.lit(" x"), F.col("plan_interval_count").cast("string")),
              "price": F.concat("price_id", F.lit("!"))})

each("X5_epoch_timestamp", "charges", "id, loaded_at", f"{o.at('created')} AS created_at",
     lambda: {"created_at": c.epoch_timestamp(F.col("created"))})

each("X6_epoch_date", "payouts", "id", f"{o.on('arrival_date')} AS arrival_day",
     lambda: {"arrival_day": c.epoch_date(F.col("arrival_date"))})

each("X7_days_between", "disputes", "id",
     f"CAST({o.on('evidence_details_due_by')} - {o.on('created')} AS BIGINT) AS days",
     lambda: {"days": c.days_between(c.epoch_date(F.col("created")),
                                     c.epoch_date(F.col("evidence_details_due_by")))})


@register("X8_day_spine", o.statement("raw_invoice_line_items", f"""
SELECT id, CAST(unnest(generate_series({o.on('period_start')}, {o.on('period_end')}, INTERVAL 1 DAY)) AS DATE) AS day
FROM raw_invoice_line_items"""))
def _(spark, sf_dir):
    """Every day of every billing period."""
    lines = raw(spark, sf_dir, "invoice_line_items")
    span = F.sequence(c.epoch_date(F.col("period_start")), c.epoch_date(F.col("period_end")))
    return lines.select("id", F.explode(span).alias("day"))


_DAY = o.on("created")


def _day():
    return c.epoch_date(F.col("created"))


each("X9_date_parts", "charges", "id, loaded_at",
     f"""CAST(year({_DAY}) AS INTEGER) AS y, CAST(month({_DAY}) AS INTEGER) AS m, CAST(day({_DAY}) AS INTEGER) AS d,
     CAST(quarter({_DAY}) AS INTEGER) AS q""",
     lambda: {"y": F.year(_day()), "m": F.month(_day()), "d": F.day(_day()), "q": F.quarter(_day())})

each("X10_weekday", "charges", "id, loaded_at",
     f"CAST(dayofweek({_DAY}) AS INTEGER) AS dow, dayofweek({_DAY}) IN (0, 6) AS is_weekend",
     lambda: {"dow": c.weekday_from_sunday(_day()), "is_weekend": c.weekday_from_sunday(_day()).isin(0, 6)})

each("X11_day_name", "charges", "id, loaded_at", f"left(dayname({_DAY}), 3) AS day_name",
     lambda: {"day_name": F.dayname(_day())})

each("X12_week_of_year", "charges", "id, loaded_at", f"CAST(weekofyear({_DAY}) AS INTEGER) AS week",
     lambda: {"week": F.weekofyear(_day())})

each("X13_month_start", "charges", "id, loaded_at", f"CAST(date_trunc('month', {_DAY}) AS DATE) AS month",
     lambda: {"month": c.month_of(_day())})

each("X14_last_day", "charges", "id, loaded_at", f"last_day({_DAY}) AS month_end",
     lambda: {"month_end": F.last_day(_day())})

each("X15_fiscal", "charges", "id, loaded_at",
     f"""CAST(CASE WHEN month({_DAY}) < 7 THEN year({_DAY}) - 1 ELSE year({_DAY}) END AS INTEGER) AS fiscal_year,
     CAST(CASE WHEN month({_DAY}) < 7 THEN month({_DAY}) + 6 ELSE month({_DAY}) - 6 END AS INTEGER) AS fiscal_month""",
     lambda: {"fiscal_year": c.fiscal_year(_day(), 7), "fiscal_month": c.fiscal_month(_day(), 7)})

each("X16_round_and_sign", "balance_transactions", "id, loaded_at",
     f"{o.units('net')} AS net, CAST(-abs({o.units('net')}) AS DECIMAL(18,2)) AS outflow",
     lambda: {"net": m.from_cents(F.col("net")), "outflow": m.outflow(m.from_cents(F.col("net")))})

each("X17_json_path", "charges", "id, loaded_at",
     f"""{o.js('customer')} AS customer, {o.js('payment_method_details.card.brand')} AS brand,
     {o.js('payment_method_details.card.last4')} AS last4,
     CAST({o.js('payment_method_details.card.exp_year')} AS BIGINT) AS exp_year""",
     lambda: {n: F.try_variant_get(F.parse_json("raw_payload"), p, t) for n, p, t in (
         ("customer", "$.customer", "string"),
         ("brand", "$.payment_method_details.card.brand", "string"),
         ("last4", "$.payment_method_details.card.last4", "string"),
         ("exp_year", "$.payment_method_details.card.exp_year", "long"))})

each("X18_surrogate_key", "customers", "id, loaded_at",
     f"""{o.key('address_country', 'currency')} AS place_key,
     md5(id || '-' || strftime(loaded_at, '%Y-%m-%d %H:%M:%S.%f')) AS version_key""",
     lambda: {"place_key": c.surrogate_key(F.col("address_country"), F.col("currency")),
              "version_key": c.surrogate_key(F.col("id"), c.key_text(F.col("loaded_at")))})

each("X19_as_of", "disputes", "id",
     f"{o.on('evidence_details_due_by')} < {o.AS_OF_DATE} AS is_past, {o.AS_OF_TS} AS dbt_updated_at",
     lambda: {"is_past": c.epoch_date(F.col("evidence_details_due_by")) < F.lit(dt.date(2024, 3, 1)),
              "dbt_updated_at": F.lit(dt.datetime(2024, 3, 1)).cast("timestamp_ntz")})

each("X20_open_end", "customers", "id, loaded_at",
     "CASE WHEN ingestion_run_id = 'run-1' THEN loaded_at ELSE TIMESTAMP '9999-12-31 00:00:00' END AS valid_to",
     lambda: {"valid_to": F.coalesce(
         F.when(F.col("ingestion_run_id") == "run-1", F.col("loaded_at")),
         F.lit(c.OPEN_END).cast("timestamp_ntz"))})

each("X21_boolean_default", "payouts", "id",
     "ifnull(automatic, true) AS automatic, ifnull(method = 'instant', false) AS is_instant",
     lambda: {"automatic": c.flag(F.col("automatic"), True),
              "is_instant": c.flag(F.col("method") == "instant", False)})

each("X22_amounts", "invoice_line_items", "id",
     f"""{o.units('amount')} AS amount, {o.mrr('1')} AS monthly,
     {o.usd('amount', 'CAST(1.234567 AS DECIMAL(12,6))')} AS converted,
     CAST({o.mrr('1')} * 12 AS DECIMAL(18,2)) AS annual""".replace("plan_interval WHEN", "lower(plan_interval) WHEN"),
     lambda: {"amount": m.from_cents(F.col("amount")),
              "monthly": m.monthly(F.col("amount"), F.lower("plan_interval")),
              "converted": m.from_cents_at(F.col("amount"), F.lit(Decimal("1.234567"))),
              "annual": (m.monthly(F.col("amount"), F.lower("plan_interval")) * F.lit(Decimal(12))).cast(m.MONEY)})

each("X23_epoch_seconds", "charges", "id",
     "CAST(floor(epoch(loaded_at)) AS BIGINT) AS loaded_seconds",
     lambda: {"loaded_seconds": c.epoch_seconds(F.col("loaded_at"))})


@register("X24_row_ids", o.statement("raw_disputes", """
SELECT count(*) AS n, count(DISTINCT id) AS ids, bool_and(length(id) > 0) AS filled FROM raw_disputes"""))
def _(spark, sf_dir):
    """Random row ids differ per run; what is checked is that there is one per row."""
    marked = raw(spark, sf_dir, "disputes").withColumn("row_id", F.uuid())
    return marked.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("row_id").alias("ids"),
                      F.bool_and(F.length("row_id") == 36).alias("filled"))


each("X25_parse_utc", "customers", "id, loaded_at",
     "loaded_at AS parsed, loaded_at - INTERVAL 2 HOUR AS shifted, CAST(NULL AS TIMESTAMP) AS malformed",
     lambda: {"parsed": F.expr(c.parse_utc("date_format(loaded_at, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'\")")),
              "shifted": F.expr(c.parse_utc("date_format(loaded_at, \"yyyy-MM-dd'T'HH:mm:ss'+02:00'\")")),
              "malformed": F.expr(c.parse_utc("concat('x', name)"))})

each("X26_bands", "invoice_line_items", "id",
     """CASE WHEN amount IS NULL OR amount >= 1000 THEN 'Enterprise' WHEN amount >= 200 THEN 'Professional'
     WHEN amount >= 50 THEN 'Growth' ELSE 'Starter' END AS tier""",
     lambda: {"tier": c.banded(F.col("amount"), labels.PRICING_TIERS, labels.TOP_PRICING_TIER)})

each("X27_percent_apart", "balance_transactions", "id, loaded_at",
     """CASE WHEN amount > 0 THEN CAST(abs(amount - net) AS DOUBLE) / amount * 100.0 END AS pct""",
     lambda: {"pct": c.percent_apart(F.col("amount"), F.col("net"))})


@register("P12_created_after", o.statement("raw_payouts", """
SELECT id, created FROM raw_payouts WHERE created > 1704067200 + 86400 * 10"""))
def _(spark, sf_dir):
    return created_after(raw(spark, sf_dir, "payouts"), 1704067200 + 86400 * 10).select("id", "created")
