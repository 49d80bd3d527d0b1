"""Declared tests, freshness and reconciliation edges."""

import pytest
from conftest import ts
from pyspark.sql import functions as F

from ledgerlake.operators import quality
from ledgerlake.operators.quality import Check
from ledgerlake.plans import checks


def test_declared_counts():
    def kinds(layer):
        found = [c.kind for cs in layer.values() for c in cs]
        return tuple(found.count(k) for k in ("not_null", "unique", "accepted_values"))
    assert kinds(checks.RAW) == (8, 0, 0)
    assert kinds(checks.SILVER) == (29, 7, 7)
    assert kinds(checks.GOLD) == (37, 15, 10)


def test_run_checks(spark):
    df = spark.createDataFrame(
        [("a", "x"), ("a", "y"), ("b", None), (None, "z"), (None, "x")], "id string, kind string")
    got = {r.test_name: (r.status, r.failure_count) for r in quality.run_checks(df, "t", [
        Check("id", "not_null"), Check("id", "unique", severity="warn"), Check("kind", "unique"),
        Check("kind", "accepted_values", ("x", "y"))]).collect()}
    assert got == {"not_null_t_id": ("fail", 2), "unique_t_id": ("warn", 1), "unique_t_kind": ("fail", 1),
                   "accepted_values_t_kind": ("fail", 1)}
    empty = quality.run_checks(df.limit(0), "t", [Check("id", "unique"), Check("id", "not_null")])
    assert {(r.status, r.failure_count) for r in empty.collect()} == {("pass", 0)}


@pytest.mark.parametrize("hours, status", [(24, "ok"), (25, "ok"), (26, "warn"), (49, "warn"), (50, "error")])
def test_freshness(spark, hours, status):
    df = spark.createDataFrame([(ts("2024-02-01"),), (ts("2024-01-01"),)], "loaded_at timestamp_ntz")
    as_of = ts("2024-02-01") + __import__("datetime").timedelta(hours=hours)
    got = quality.freshness(df, "s", as_of, 25, 49).first()
    assert (got.status, got.age_hours) == (status, hours)


def test_freshness_without_rows(spark):
    df = spark.createDataFrame([], "loaded_at timestamp_ntz")
    assert quality.freshness(df, "s", ts("2024-02-01"), 25, 49).first().status == "error"


def tables(spark, **sizes):
    return {name: spark.range(sizes.get(name, 1)).select(F.col("id").cast("string").alias(key))
            for name, key in quality.RECONCILED.items()}


def statuses(spark, **sizes):
    got = quality.reconcile(tables(spark, **sizes), "run", ts("2024-02-01")).collect()
    return {r.check_name: r.status for r in got}


@pytest.mark.parametrize("gold, volume", [(1000, "passed"), (950, "passed"), (949, "failed"), (1050, "passed"), (1051, "failed")])
def test_ledger_tolerance(spark, gold, volume):
    got = statuses(spark, stg_finance_ledger_events=1000, fct_transactions=gold)
    assert got["txn_volume_within_tolerance"] == volume
    assert got["ledger_dedup_integrity"] == ("passed" if gold == 1000 else "failed")


@pytest.mark.parametrize("gold, want", [(10000, "passed"), (9800, "passed"), (9799, "failed")])
def test_charges_tolerance(spark, gold, want):
    assert statuses(spark, stg_charges=10000, fct_charges=gold)["charges_silver_to_gold"] == want


def test_conditional_checks(spark):
    quiet = statuses(spark, stg_refunds=0, fct_refunds=0, stg_charges=0, fct_charges=0)
    assert "gold_refunds_populated" not in quiet and "charges_silver_to_gold" not in quiet
    assert quiet["silver_charges_has_data"] == quiet["gold_charges_has_data"] == "failed"
    assert statuses(spark, stg_refunds=5, fct_refunds=0)["gold_refunds_populated"] == "failed"


def test_reconcile_values(spark):
    got = quality.reconcile(tables(spark, stg_charges=7, fct_charges=6), "run", ts("2024-02-01"),
                            spark.createDataFrame([(3,)], "fx_missing long"))
    rows = {r.check_name: r for r in got.collect()}
    row = rows["charges_silver_to_gold"]
    assert tuple(map(str, (row.expected_value, row.actual_value, row.delta, row.tolerance_pct))) == (
        "7.00", "6.00", "1.00", "2.00")
    assert str(rows["silver_charges_has_data"].expected_value) == "1.00"
    assert rows["fx_missing"].status == "warning"


def test_fingerprints_name_the_keys_that_differ(spark):
    left = spark.createDataFrame([(f"k{i}", i, "x" if i % 3 else None) for i in range(400)], "k string, v int, s string")
    right = spark.createDataFrame(
        [(f"k{i}", {17: 18, 18: 17}.get(i, i), ("y" if i == 40 else "x") if i % 3 else ("" if i == 60 else None))
         for i in range(1, 401)], "k string, v int, s string")
    for buckets in (1, 7, 4096):
        got = {r.key: r.finding for r in quality.differing_keys(left, right, "k", ("v", "s"), buckets).collect()}
        assert got == {"k17": "differs", "k18": "differs", "k40": "differs", "k60": "differs", "k0": "only left", "k400": "only right"}
    assert quality.differing_keys(left, left, "k", ("v", "s")).count() == 0
    assert quality.differing_keys(left.limit(0), left.limit(0), "k", ("v", "s")).count() == 0
