"""Declared data tests, freshness and reconciliation, all as aggregations."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.columns import percent_apart
from ledgerlake.operators.fx import missing_rates
from ledgerlake.operators.lookup import Lookup


class Check(NamedTuple):
    """``kind`` is not_null, unique or accepted_values; ``severity`` is error or warn."""

    column: str
    kind: str
    values: tuple[str, ...] = ()
    severity: str = "error"


def not_null(df: DataFrame, column: str) -> DataFrame:
    """Number of rows whose column is NULL."""
    return df.agg(F.count_if(F.col(column).isNull()).alias("failures"))


def unique(df: DataFrame, column: str) -> DataFrame:
    """Number of values that occur more than once; NULL does not count."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column).agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .agg(F.count(F.lit(1)).alias("failures"))
    )


def accepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Number of rows whose value is not in the list; NULL passes."""
    return df.agg(F.count_if(~F.col(column).isin(*values)).alias("failures"))


def run_checks(df: DataFrame, table: str, checks: Sequence[Check]) -> DataFrame:
    """One result row per check.

    The row-level checks of a table ride along with its first uniqueness check: the rows
    are counted per key and the counters added up. Only a second key needs another pass.
    """
    row_level = [c for c in checks if c.kind != "unique"]
    keys = [c for c in checks if c.kind == "unique"]
    counters = [
        F.count_if(F.col(c.column).isNull() if c.kind == "not_null"
                   else ~F.col(c.column).isin(*c.values)).alias(f"c{i}")
        for i, c in enumerate(row_level)
    ]
    passes = []  # (one-row frame, checks whose counts it holds)
    if keys:
        grouped = df.groupBy(F.col(keys[0].column).alias("_key")).agg(
            F.count(F.lit(1)).alias("_n"), *counters)
        repeated = F.count_if(F.col("_key").isNotNull() & (F.col("_n") > 1))
        added = [F.coalesce(F.sum(f"c{i}"), F.lit(0)) for i in range(len(row_level))]
        passes.append((grouped.agg(*(x.alias(f"f{i}") for i, x in enumerate([repeated, *added]))),
                       [keys[0], *row_level]))
    elif row_level:
        passes.append((df.agg(*(x.alias(f"f{i}") for i, x in enumerate(counters))), row_level))
    passes += [(unique(df, c.column).withColumnRenamed("failures", "f0"), [c]) for c in keys[1:]]

    def rows(counts: DataFrame, held: Sequence[Check]) -> DataFrame:
        failed = {c: "warn" if c.severity == "warn" else "fail" for c in held}
        return counts.select(F.inline(F.array(*(
            F.struct(
                F.lit(f"{c.kind}_{table}_{c.column}").alias("test_name"),
                F.lit(table).alias("model_name"),
                F.lit(c.column).alias("column_name"),
                F.when(F.col(f"f{i}") == 0, "pass").otherwise(failed[c]).alias("status"),
                F.col(f"f{i}").alias("failure_count"),
            )
            for i, c in enumerate(held)
        ))))

    return reduce(DataFrame.unionByName, [rows(counts, held) for counts, held in passes])


def freshness(df: DataFrame, source: str, as_of: dt.datetime, warn_hours: int, error_hours: int,
              loaded_at: str = "loaded_at") -> DataFrame:
    """Age of the newest load against its limits. A source without rows is an error."""
    age = F.timestamp_diff("SECOND", F.col("max_loaded_at"), F.lit(as_of).cast("timestamp_ntz")) / 3600.0
    status = (
        F.when(F.col("age_hours").isNull() | (F.col("age_hours") > error_hours), "error")
        .when(F.col("age_hours") > warn_hours, "warn")
        .otherwise("ok")
    )
    return (
        df.agg(F.max(loaded_at).alias("max_loaded_at"))
        .withColumn("age_hours", age)
        .select(F.lit(source).alias("source"), "max_loaded_at", "age_hours", status.alias("status"))
    )


# Tolerated difference in percent.
LEDGER_TOLERANCE = 5.0
CHARGES_TOLERANCE = 2.0

# Reconciled tables and the key that is counted.
RECONCILED = {
    "stg_finance_ledger_events": "transaction_id",
    "stg_invoice_line_items": "line_item_id",
    "stg_charges": "charge_id",
    "stg_refunds": "refund_id",
    "stg_disputes": "dispute_id",
    "stg_payouts": "payout_id",
    "fct_transactions": "transaction_id",
    "fct_mrr_movements": "mrr_key",
    "fct_charges": "charge_id",
    "fct_refunds": "refund_id",
    "fct_disputes": "dispute_id",
    "fct_payouts": "payout_id",
}
DISTINCT_COUNTED = ("stg_finance_ledger_events", "fct_transactions", "stg_charges", "fct_charges")

# Existence checks: name -> table that must have rows.
MUST_HAVE_ROWS = {
    "silver_ledger_has_data": "stg_finance_ledger_events",
    "silver_mrr_has_data": "stg_invoice_line_items",
    "silver_charges_has_data": "stg_charges",
    "gold_transactions_has_data": "fct_transactions",
    "gold_mrr_has_data": "fct_mrr_movements",
    "gold_charges_has_data": "fct_charges",
}
# Gold must have rows wherever Silver has.
FOLLOWS_SILVER = ("refunds", "disputes", "payouts")


def _sizes(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row and distinct-key counts of all tables in one row: one aggregation per table."""
    parts = []
    for name, key in RECONCILED.items():
        distinct = F.count_distinct(key) if name in DISTINCT_COUNTED else F.lit(0).cast("long")
        parts.append(tables[name].agg(F.count(F.lit(1)).alias("n"), distinct.alias("d"))
                     .withColumn("name", F.lit(name)))
    rows = reduce(DataFrame.unionByName, parts)
    picked = []
    for name in RECONCILED:
        here = F.col("name") == name
        picked += [F.max(F.when(here, F.col("n"))).alias(f"n_{name}"),
                   F.max(F.when(here, F.col("d"))).alias(f"d_{name}")]
    return rows.agg(*picked)


def reconcile(tables: Mapping[str, DataFrame], run_id: str, checked_at: dt.datetime,
              missing_rate_rows: DataFrame | None = None) -> DataFrame:
    """One row per check: expected, actual, difference, tolerance and status.

    ``missing_rate_rows`` (one ``fx_missing`` count) adds a warning for amounts converted
    without a rate.
    """
    def row(name, expected, actual, tolerance, passed, applies=None, source="silver", target="gold"):
        return F.struct(
            F.lit(name).alias("check_name"), F.lit(source).alias("layer_from"), F.lit(target).alias("layer_to"),
            expected.cast("decimal(18,2)").alias("expected_value"),
            actual.cast("decimal(18,2)").alias("actual_value"),
            F.lit(tolerance).cast("decimal(5,2)").alias("tolerance_pct"),
            F.when(passed, "passed").otherwise("failed").alias("status"),
            (F.lit(True) if applies is None else applies).alias("applies"),
        )

    checks = []
    for name, table in MUST_HAVE_ROWS.items():
        n, layer = F.col(f"n_{table}"), name.split("_")[0]
        checks.append(row(name, F.lit(1), n, 0, n > 0, source=layer, target=layer))
    for entity in FOLLOWS_SILVER:
        s, g = F.col(f"n_stg_{entity}"), F.col(f"n_fct_{entity}")
        checks.append(row(f"gold_{entity}_populated", s, g, 0, g > 0, applies=s > 0))
    silver, gold = F.col("d_stg_finance_ledger_events"), F.col("d_fct_transactions")
    checks.append(row("ledger_dedup_integrity", silver, gold, 0, silver == gold))
    total = F.col("n_fct_transactions")
    checks.append(row("txn_volume_within_tolerance", silver, total, LEDGER_TOLERANCE,
                      percent_apart(silver, total) <= LEDGER_TOLERANCE, applies=silver > 0))
    silver, gold = F.col("d_stg_charges"), F.col("d_fct_charges")
    checks.append(row("charges_silver_to_gold", silver, gold, CHARGES_TOLERANCE,
                      percent_apart(silver, gold) <= CHARGES_TOLERANCE, applies=silver > 0))

    results = _sizes(tables).select(F.inline(F.array(*checks))).filter("applies").drop("applies")
    if missing_rate_rows is not None:
        n = F.col("fx_missing")
        results = results.unionByName(missing_rate_rows.select(
            F.lit("fx_missing").alias("check_name"), F.lit("bronze").alias("layer_from"),
            F.lit("silver").alias("layer_to"), F.lit(0).cast("decimal(18,2)").alias("expected_value"),
            n.cast("decimal(18,2)").alias("actual_value"), F.lit(0).cast("decimal(5,2)").alias("tolerance_pct"),
            F.when(n > 0, "warning").otherwise("passed").alias("status")))
    return results.select(
        F.lit(run_id).alias("run_id"), "check_name", "layer_from", "layer_to",
        "expected_value", "actual_value",
        F.abs(F.col("expected_value") - F.col("actual_value")).cast("decimal(18,2)").alias("delta"),
        "tolerance_pct", "status",
        F.lit(checked_at).cast("timestamp_ntz").alias("checked_at"),
    )


def count_missing_rates(frames: Sequence[tuple[DataFrame, str]], rates: Lookup) -> DataFrame:
    """Rows over all (frame, day column) whose currency and day have no rate."""
    parts = [missing_rates(df, rates, F.upper("currency"), F.col(day)) for df, day in frames]
    return reduce(DataFrame.unionByName, parts).agg(
        F.coalesce(F.sum("fx_missing"), F.lit(0)).alias("fx_missing"))


# Silver table, Gold table, key, and the columns that must agree.
COMPARED = {
    "charges": ("stg_charges", "fct_charges", "charge_id", ("amount_usd", "net_amount_usd", "status", "created_date")),
    "refunds": ("stg_refunds", "fct_refunds", "refund_id", ("signed_amount_usd", "status", "created_date")),
    "disputes": ("stg_disputes", "fct_disputes", "dispute_id", ("signed_amount_usd", "status", "created_date")),
    "payouts": ("stg_payouts", "fct_payouts", "payout_id", ("amount_usd", "status", "arrival_date")),
    "transactions": ("stg_finance_ledger_events", "fct_transactions", "transaction_id",
                     ("signed_net_amount_usd", "event_type", "created_date")),
}
FINGERPRINT_BUCKETS = 4096


def _fingerprints(rows: DataFrame, buckets: int) -> DataFrame:
    """Per bucket of keys the count and the sum of the row hashes, in which order plays no part."""
    return rows.groupBy(F.pmod("key_hash", F.lit(buckets)).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("row_hash").cast("decimal(38,0)")).alias("hashes"))


def differing_keys(left: DataFrame, right: DataFrame, key: str, columns: Sequence[str],
                   buckets: int = FINGERPRINT_BUCKETS) -> DataFrame:
    """``key`` and ``finding`` (only left, only right, differs) of rows that two tables do not share.

    Fingerprints of key buckets are compared first, one aggregation of a number for each bucket;
    only rows of buckets that differ are then joined by key. Keys are unique in each table.
    """
    def hashed(df: DataFrame) -> DataFrame:
        return df.select(F.col(key).alias("key"), F.xxhash64(key).alias("key_hash"),
                         F.xxhash64(key, *columns).alias("row_hash"))

    one, two = hashed(left), hashed(right)
    a, b = _fingerprints(one, buckets), _fingerprints(two, buckets).toDF("bucket_", "n_", "hashes_")
    same = F.col("n").eqNullSafe(F.col("n_")) & F.col("hashes").eqNullSafe(F.col("hashes_"))
    apart = a.join(b, F.col("bucket") == F.col("bucket_"), "full").filter(~same).select(
        F.coalesce("bucket", "bucket_").alias("apart"))

    def chosen(rows: DataFrame) -> DataFrame:  # at most one row for each bucket is broadcast
        return rows.join(F.broadcast(apart), F.pmod("key_hash", F.lit(buckets)) == F.col("apart"), "left_semi")

    left_rows = chosen(one).select("key", F.col("row_hash").alias("hash_left"))
    right_rows = chosen(two).select(F.col("key").alias("key_"), F.col("row_hash").alias("hash_right"))
    finding = (F.when(F.col("hash_right").isNull(), "only left").when(F.col("hash_left").isNull(), "only right")
               .otherwise("differs"))
    return (left_rows.join(right_rows, F.col("key").eqNullSafe(F.col("key_")), "full")
            .filter(~F.col("hash_left").eqNullSafe(F.col("hash_right")))
            .select(F.coalesce("key", "key_").alias("key"), finding.alias("finding")))


def compare_values(tables: Mapping[str, DataFrame], run_id: str, checked_at: dt.datetime) -> DataFrame:
    """One reconciliation row for each fact: how many keys differ from Silver in value. None may."""
    parts = []
    for name, (silver, gold, key, columns) in COMPARED.items():
        found = differing_keys(tables[silver], tables[gold], key, columns).agg(F.count(F.lit(1)).alias("n"))
        parts.append(found.select(
            F.lit(run_id).alias("run_id"), F.lit(f"{name}_values_agree").alias("check_name"),
            F.lit("silver").alias("layer_from"), F.lit("gold").alias("layer_to"),
            F.lit(0).cast("decimal(18,2)").alias("expected_value"), F.col("n").cast("decimal(18,2)").alias("actual_value"),
            F.col("n").cast("decimal(18,2)").alias("delta"), F.lit(0).cast("decimal(5,2)").alias("tolerance_pct"),
            F.when(F.col("n") == 0, "passed").otherwise("failed").alias("status"),
            F.lit(checked_at).cast("timestamp_ntz").alias("checked_at")))
    return reduce(DataFrame.unionByName, parts)
