"""Daily runs end to end: two days against one, late rates, and the gate."""


import pytest
from conftest import day, ts
from pyspark.sql import functions as F

import catalog
from catalog.storage import LANDED, lake
from ledgerlake.plans import pipeline
from ledgerlake.plans.warehouse import Warehouse
from ledgerlake.schemas import RAW
from ledgerlake.session import work_dir
from ledgerlake.sources import control, landing

SF = "/root/testdata/sf0.001"
CUT = ts("2024-02-01T12:00:00")


def land(spark, root, run, keep, on):
    for entity in LANDED:
        landing.write_landing(catalog.raw(spark, SF, entity).filter(keep(entity)), root, entity, run, on)


@pytest.fixture(scope="module")
def two_days(spark):
    root = work_dir(spark, "two-days")
    cut = F.lit(CUT).cast("timestamp_ntz")
    land(spark, root, "run-a", lambda e: F.col("loaded_at") <= cut, day("2024-02-01"))
    pipeline.run_daily(lake(spark, root, "run-a"))
    land(spark, root, "run-b", lambda e: F.col("loaded_at") > cut, day("2024-02-02"))
    pipeline.run_daily(lake(spark, root, "run-b"))
    return root


def same(a, b):
    columns = [c for c in a.columns if c != "load_mode"]
    return a.select(columns).exceptAll(b.select(columns)).isEmpty() and a.count() == b.count()


def test_two_days_equal_one(spark, two_days):
    """After late rates are restated, the incremental tables equal a build from scratch."""
    now = lake(spark, two_days, "check")
    whole = Warehouse(spark, lambda e: catalog.raw(spark, SF, e), catalog.AS_OF, calendar_start=catalog.CALENDAR_START)
    for name in ("stg_customers_history", "stg_disputes"):
        assert same(now.silver(name).read(), getattr(whole, name)), name
    late = now.bronze("fx_rates").read().filter(F.col("loaded_at") > F.lit(CUT).cast("timestamp_ntz"))
    for name in ("stg_charges", "stg_payouts", "stg_finance_ledger_events"):
        assert not same(now.silver(name).read(), getattr(whole, name)), name
        pipeline.restate_rates(now, name, late)
        assert same(now.silver(name).read(), getattr(whole, name)), name
    pipeline.rebuild_silver(now, "stg_refunds")
    assert same(now.silver("stg_refunds").read(), whole.stg_refunds)


def test_what_a_run_records(spark, two_days):
    now = lake(spark, two_days, "check")
    log = now.audit("pipeline_runs").read()
    assert log.filter("status = 'success'").count() == 22
    results = now.audit("reconciliation_results").read()
    assert {r.status for r in results.collect()} <= {"passed", "warning"}
    tests = now.audit("dbt_test_results").read()
    assert tests.filter("status = 'fail'").count() == 0 and tests.filter("run_id = 'run-a'").count() == 8 + 43 + 62
    state = now.audit("ingestion_control").read()
    newest = catalog.raw(spark, SF, "payouts").agg(F.max("created")).first()[0]
    assert control.get_watermark(state, "payouts") == newest
    assert pipeline.collect_rejects(now).count() == 0


def test_failed_gate_stops_the_run(spark):
    """Two currencies of one plan break no rule; a payout method outside the list does."""
    root = work_dir(spark, "gate")
    bad = F.when(F.col("id").endswith("7"), "wire").otherwise(F.col("method"))
    for entity in LANDED:
        rows = catalog.raw(spark, SF, entity)
        rows = rows.withColumn("method", bad) if entity == "payouts" else rows
        landing.write_landing(rows, root, entity, "run-a", day("2024-02-01"))
    run = lake(spark, root, "run-a")
    with pytest.raises(pipeline.GateFailed, match="accepted_values_stg_payouts_method"):
        pipeline.run_daily(run)
    assert not run.audit("ingestion_control").exists() and not run.gold("fct_payouts").exists()
    log = {r.task_id: r.status for r in run.audit("pipeline_runs").read().collect()}
    assert log["silver"] == "success" and log["test_silver"] == "failed" and "gold" not in log


def test_missing_required_entity(spark, folder):
    with pytest.raises(FileNotFoundError, match="balance_transactions"):
        pipeline.run_daily(lake(spark, folder, "run-a"))


def test_failed_ingest_is_recorded_and_stops_the_run(spark, folder):
    def fails(mark):
        raise OSError("source is down")

    run = lake(spark, folder, "run-a")
    run.payloads = {"charges": fails, "refunds": lambda mark: spark.createDataFrame([('{"id":"a","created":%d}' % (mark + 5),)], "payload string")}
    with pytest.raises(RuntimeError, match="charges"):
        pipeline.run_daily(run)
    letters = pipeline.collect_rejects(run).collect()
    assert [(r.entity, r.error_type, r.error_message) for r in letters] == [("charges", "ingest_failed", "source is down")]
    assert landing.read_optional(spark, folder, "refunds", RAW["refunds"]).count() == 1
    assert [r.status for r in run.audit("pipeline_runs").read().collect()] == ["failed"]


def test_row_counts_in_the_run_log(spark, two_days):
    log = lake(spark, two_days, "check").audit("pipeline_runs").read().filter("run_id = 'run-b'")
    rows = {r.task_id: r.row_count for r in log.collect()}
    late = sum(catalog.raw(spark, SF, e).filter(F.col("loaded_at") > F.lit(CUT).cast("timestamp_ntz")).count() for e in LANDED)
    assert rows["load_raw"] == late and 0 < rows["bronze"] <= late
