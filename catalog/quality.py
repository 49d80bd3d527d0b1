"""Data tests, freshness and reconciliation (Q1 to Q5)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

import oracles as o
from catalog.base import AS_OF, raw, register, warehouse
from ledgerlake.operators import quality
from ledgerlake.plans import checks

PRESENT = ("balance_transactions", "charges", "customers", "subscriptions", "invoice_line_items",
           "refunds", "disputes", "invoices", "fx_rates")


def _quoted(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _check_sql(table: str, check: quality.Check, source: str) -> str:
    if check.kind == "not_null":
        count = f"(SELECT count(*) FROM {source} WHERE {check.column} IS NULL)"
    elif check.kind == "unique":
        count = (f"(SELECT count(*) FROM (SELECT {check.column} FROM {source} WHERE {check.column} IS NOT NULL "
                 f"GROUP BY 1 HAVING count(*) > 1))")
    else:
        count = (f"(SELECT count(*) FROM {source} WHERE {check.column} IS NOT NULL "
                 f"AND {check.column} NOT IN ({_quoted(check.values)}))")
    failed = "warn" if check.severity == "warn" else "fail"
    return (f"SELECT '{check.kind}_{table}_{check.column}' AS test_name, '{table}' AS model_name, "
            f"'{check.column}' AS column_name, CASE WHEN {count} = 0 THEN 'pass' ELSE '{failed}' END AS status, "
            f"{count} AS failure_count")


def _layer_sql(declared: dict, prefix: str = "") -> str:
    needs = " ".join(f"{prefix}{t}" for t in declared)
    return o.statement(needs, " UNION ALL ".join(
        _check_sql(t, c, f"{prefix}{t}") for t, cs in declared.items() for c in cs))


def _layer(declared: dict, read) -> DataFrame:
    return reduce(DataFrame.unionByName, [quality.run_checks(read(t), t, cs) for t, cs in declared.items()])


_SILVER_CORE = checks.SILVER

register("Q1_not_null", o.statement("raw_customers", """
SELECT count(*) FILTER (address_country IS NULL) AS failures FROM raw_customers"""))(
    lambda s, d: quality.not_null(raw(s, d, "customers"), "address_country"))

register("Q2_unique", o.statement("raw_charges", """
SELECT count(*) AS failures FROM (SELECT id FROM raw_charges GROUP BY id HAVING count(*) > 1)"""))(
    lambda s, d: quality.unique(raw(s, d, "charges"), "id"))

register("Q3_accepted_values", o.statement("brz_stripe_disputes", """
SELECT count(*) FILTER (status NOT IN ('won', 'lost')) AS failures FROM brz_stripe_disputes"""))(
    lambda s, d: quality.accepted_values(warehouse(s, d).bronze("disputes"), "status", ("won", "lost")))

register("Q1_Q2_Q3_source_tests", _layer_sql(checks.RAW, "raw_").replace("'raw_", "'"))(
    lambda s, d: _layer(checks.RAW, lambda e: raw(s, d, e)))

register("Q1_Q2_Q3_silver_tests", _layer_sql(_SILVER_CORE))(
    lambda s, d: (lambda w: _layer(_SILVER_CORE, lambda t: getattr(w, t)))(warehouse(s, d)))


def _freshness_sql(entity: str) -> str:
    warn, error = checks.FRESHNESS[entity]
    age = f"(epoch({o.AS_OF_TS}) - epoch(max(loaded_at))) / 3600.0"
    return (f"SELECT '{entity}' AS source, max(loaded_at) AS max_loaded_at, {age} AS age_hours, "
            f"CASE WHEN {age} > {error} THEN 'error' WHEN {age} > {warn} THEN 'warn' ELSE 'ok' END AS status "
            f"FROM raw_{entity}")


@register("Q4_freshness", o.statement(
    " ".join(f"raw_{e}" for e in PRESENT), " UNION ALL ".join(_freshness_sql(e) for e in PRESENT)))
def _(spark, sf_dir):
    return reduce(DataFrame.unionByName, [
        quality.freshness(raw(spark, sf_dir, e), e, AS_OF, *checks.FRESHNESS[e]) for e in PRESENT])


def _reconcile_sql() -> str:
    n = "CAST({} AS DECIMAL(18,2))"

    def size(table: str) -> str:
        return f"(SELECT count(*) FROM {table})"

    def distinct(table: str, key: str) -> str:
        return f"(SELECT count(DISTINCT {key}) FROM {table})"

    def line(name, source, target, expected, actual, tolerance, passed) -> str:
        return (f"SELECT 'run-x' AS run_id, '{name}' AS check_name, '{source}' AS layer_from, '{target}' AS layer_to, "
                f"{n.format(expected)} AS expected_value, {n.format(actual)} AS actual_value, "
                f"CAST(abs({expected} - {actual}) AS DECIMAL(18,2)) AS delta, "
                f"CAST({tolerance} AS DECIMAL(5,2)) AS tolerance_pct, "
                f"CASE WHEN {passed} THEN 'passed' ELSE 'failed' END AS status, {o.AS_OF_TS} AS checked_at")

    out = []
    for name, table in (("silver_ledger_has_data", "stg_finance_ledger_events"),
                        ("silver_mrr_has_data", "stg_invoice_line_items"),
                        ("silver_charges_has_data", "stg_charges"),
                        ("gold_transactions_has_data", "fct_transactions"),
                        ("gold_mrr_has_data", "fct_mrr_movements"),
                        ("gold_charges_has_data", "fct_charges")):
        layer = name.split("_")[0]
        out.append(line(name, layer, layer, 1, size(table), 0, f"{size(table)} > 0"))
    for e in ("refunds", "disputes", "payouts"):
        s, g = size(f"stg_{e}"), size(f"fct_{e}")
        out.append(line(f"gold_{e}_populated", "silver", "gold", s, g, 0, f"{g} > 0") + f" WHERE {s} > 0")
    s = distinct("stg_finance_ledger_events", "transaction_id")
    g = distinct("fct_transactions", "transaction_id")
    out.append(line("ledger_dedup_integrity", "silver", "gold", s, g, 0, f"{s} = {g}"))
    t = size("fct_transactions")
    out.append(line("txn_volume_within_tolerance", "silver", "gold", s, t, 5, f"abs({s} - {t}) * 100 <= 5 * {s}"))
    s, g = distinct("stg_charges", "charge_id"), distinct("fct_charges", "charge_id")
    out.append(line("charges_silver_to_gold", "silver", "gold", s, g, 2, f"abs({s} - {g}) * 100 <= 2 * {s}"))
    needs = " ".join(quality.RECONCILED)
    return o.statement(needs, " UNION ALL ".join(out))


@register("Q5_reconcile", _reconcile_sql())
def _(spark, sf_dir):
    w = warehouse(spark, sf_dir)
    return quality.reconcile({t: getattr(w, t) for t in quality.RECONCILED}, "run-x", AS_OF)


# Silver tables whose amounts are converted, and the day of their rate.
_RATED = {"stg_charges": "created_date", "stg_refunds": "created_date", "stg_disputes": "created_date",
          "stg_payouts": "created_date", "stg_finance_ledger_events": "created_date",
          "stg_invoice_line_items": "period_start_date"}


@register("Q5_fx_missing", o.statement(" ".join(_RATED) + " fx", f"""
WITH f AS ({" UNION ALL ".join(f"SELECT upper(currency) c, {d} d FROM {t}" for t, d in _RATED.items())})
SELECT count(*) FILTER (fx.rate IS NULL) AS fx_missing FROM f LEFT JOIN fx ON fx.from_currency = f.c AND fx.rate_date = f.d"""))
def _(spark, sf_dir):
    w = warehouse(spark, sf_dir)
    return quality.count_missing_rates([(getattr(w, t), day) for t, day in _RATED.items()], w.rates)


# Silver tables that two Gold tables each are built from, in the columns that these and their tests read.
_SHARED = {
    "stg_finance_ledger_events": ("transaction_id", "source_id", "event_type", "reporting_category", "amount_usd",
                                  "created_date"),
    "stg_invoice_line_items": ("line_item_id", "subscription", "plan_id", "price_id", "plan_interval",
                               "plan_interval_count", "period_start_date", "currency", "is_recurring",
                               "mrr_amount_usd", "loaded_at", "ingestion_run_id"),
}


@register("Q1_Q2_Q3_gold_tests", _layer_sql(checks.GOLD))
def _(spark, sf_dir):
    w = warehouse(spark, sf_dir).storing(_SHARED)
    return _layer(checks.GOLD, lambda t: getattr(w, t))


@register("Q5_fingerprints", o.statement("stg_charges", """
SELECT charge_id AS key, CASE WHEN charge_id LIKE '%3' THEN 'only left' ELSE 'differs' END AS finding
FROM stg_charges WHERE charge_id LIKE '%3' OR (charge_id LIKE '%17' AND amount_usd <> 0)
UNION ALL SELECT charge_id || '+', 'only right' FROM stg_charges WHERE charge_id LIKE '%3'"""))
def _(spark, sf_dir):
    """As many rows on both sides, and the sum of some keys' amounts turned round: the keys are named."""
    silver = warehouse(spark, sf_dir).stg_charges.select("charge_id", "amount_usd", "status")
    gold = silver.withColumn("amount_usd", F.when(F.col("charge_id").endswith("17"), -F.col("amount_usd")).otherwise(F.col("amount_usd")))
    gold = gold.withColumn("charge_id", F.when(F.col("charge_id").endswith("3"), F.concat("charge_id", F.lit("+"))).otherwise(F.col("charge_id")))
    return quality.differing_keys(silver, gold, "charge_id", ("amount_usd", "status"))
