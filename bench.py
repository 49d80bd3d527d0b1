"""Time the headline queries and print one JSON line.

BENCH_SF_DIR  input folder (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_RUNS    timed runs per query, of which the median counts (default 1)
"""

from __future__ import annotations

import datetime as dt
import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from catalog import QUERIES, raw  # noqa: E402
from catalog.storage import LANDED, lake, ntz  # noqa: E402
from ledgerlake.plans import pipeline  # noqa: E402
from ledgerlake.session import local_session, work_dir  # noqa: E402
from ledgerlake.sources import landing  # noqa: E402

HEADLINE = (
    "B3_brz_stripe_charges",
    "V1_stg_charges", "V2_stg_refunds", "V3_stg_disputes", "V4_stg_payouts",
    "V5_stg_invoice_line_items", "V6_stg_finance_ledger_events", "V7_stg_customers_history",
    "G3_dim_currencies", "G4_dim_geography", "G5_dim_payment_category", "G6_dim_plans",
    "G7_fct_charges", "G8_fct_refunds", "G9_fct_disputes", "G10_fct_payouts",
    "G11_fct_transactions", "G12_fct_mrr_movements",
    "A6_revenue_by_month", "R1_mrr_summary", "R2_risk_rates", "R5_cash_by_day",
    "R6_mrr_by_region_and_plan",
    "S4_upsert", "T3_streaming_upsert", "Q10_daily_run",
)
WARM_UP = ("V1_stg_charges", "G12_fct_mrr_movements")
ONE_DAY = "one_day_run"  # the daily run that takes up the second of two landed days


def timed(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name].query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def one_day(spark, sf_dir: str) -> float:
    """A whole daily run over one more day of loads; the lake it runs on is built untimed."""
    root, cut = work_dir(spark, "bench"), ntz(dt.datetime(2024, 2, 2))
    for number in (1, 2):
        for entity in LANDED:
            rows = raw(spark, sf_dir, entity)
            first = F.lit(True) if entity == "fx_rates" else F.col("loaded_at") < cut
            landing.write_landing(rows.filter(first if number == 1 else ~first), root, entity, f"run-{number}",
                                  dt.date(2024, 2, number))
        start = time.perf_counter()
        pipeline.run_daily(lake(spark, root, f"run-{number}"))
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = local_session(cpus, shuffle_partitions=int(cpus))
    for name in WARM_UP:
        timed(spark, name, sf_dir)
    seconds = {
        name: round(statistics.median(timed(spark, name, sf_dir) for _ in range(runs)), 3)
        for name in HEADLINE
    }
    seconds[ONE_DAY] = round(one_day(spark, sf_dir), 3)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(seconds[n] for n in HEADLINE), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")),
        "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
