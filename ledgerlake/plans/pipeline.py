"""The daily run: ingest, load, Bronze, Silver, tests, Gold, tests, reconcile, advance."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerlake.operators.dedup import with_row_hash
from ledgerlake.operators.fx import RATE_KEYS, daily_rates, rate_lookup
from ledgerlake.operators.lookup import Lookup, semi_join
from ledgerlake.operators.quality import compare_values, count_missing_rates, freshness, reconcile, run_checks
from ledgerlake.plans import bronze, checks, gold, increments, partials, silver
from ledgerlake.schemas import AUDIT, DAILY_ENTITIES, OPTIONAL_ENTITIES, RAW, WATERMARK_START
from ledgerlake.session import release, work_dir
from ledgerlake.sources import control, files, landing
from ledgerlake.sources.tables import Table
from ledgerlake.streaming.loads import load_once

# Silver table -> (entity, key)
SILVER = {
    "stg_charges": ("charges", "charge_id"),
    "stg_refunds": ("refunds", "refund_id"),
    "stg_disputes": ("disputes", "dispute_id"),
    "stg_payouts": ("payouts", "payout_id"),
    "stg_invoice_line_items": ("invoice_line_items", "line_item_id"),
    "stg_finance_ledger_events": ("balance_transactions", "transaction_id"),
    "stg_customers_history": ("customers", "customer_key"),
}
# The date that orders the rows of a Silver or Gold table on disk.
LAID_OUT_BY = {"stg_invoice_line_items": "period_start_date", "stg_customers_history": "valid_from",
               "dim_customers": "valid_from", "fct_mrr_movements": "billing_month"}
CLUSTERED_BRONZE = ("balance_transactions", "charges", "refunds", "disputes", "payouts")
DIMENSIONS = ("dim_customers", "dim_dates", "dim_currencies", "dim_geography",
              "dim_payment_category", "dim_plans")
FACTS = tuple(increments.FACTS)
LOADED = ("loaded_at", "ingestion_run_id")
AUDIT_TABLES = ("dbt_test_results", "reconciliation_results", "pipeline_runs", "source_freshness")
LOAD_LOG = "load_number long, rows long, newest_loaded_at timestamp_ntz, newest_created timestamp_ntz"


class GateFailed(RuntimeError):
    """A data test or a reconciliation check failed; watermarks stay where they were."""


@dataclass
class Lake:
    """Where everything lives, and how one run is to behave."""

    spark: SparkSession
    root: str
    run_id: str
    as_of: dt.datetime
    grain: str = "month"
    calendar_start: dt.date = gold.CALENDAR_START
    calendar_end: dt.date = gold.CALENDAR_END
    resolve_sources: bool = True
    concurrent_models: int = 4
    # Hash buckets of each Silver table and fact, fixed when they are made: about their size over
    # that of a file, say 1 GB.
    buckets: int = 16
    dates_never_change: bool = False
    # Schema of the landed files of an entity where it is not the declared one.
    file_schemas: Mapping[str, StructType] = field(default_factory=dict)
    # What a run ingests before it loads: payloads (JSON texts) of an entity from a watermark on,
    # which may hold older ones too.
    payloads: Mapping[str, Callable[[int], DataFrame]] = field(default_factory=dict)
    watermark_start: str = WATERMARK_START
    # Tests whose failure is reported but does not stop the run, by test name.
    tolerated: frozenset[str] = frozenset()
    entities: tuple[str, ...] = field(default=DAILY_ENTITIES)

    def raw(self, entity: str) -> Table:
        return Table(self.spark, f"{self.root}/raw/{entity}")

    def bronze(self, entity: str) -> Table:
        cluster = ("created_date",) if entity in CLUSTERED_BRONZE else ()
        return Table(self.spark, f"{self.root}/bronze/{bronze.MODELS[entity][0]}",
                     cluster_by=cluster, rebalance=False)

    def silver(self, name: str) -> Table:
        day = LAID_OUT_BY.get(name, "created_date")
        key = SILVER[name][1]
        # The key of a customer version holds its load time. The other dates are set once by
        # the source too, but only ``dates_never_change`` says that this may be relied on.
        fixed = self.dates_never_change or name == "stg_customers_history"
        return Table(self.spark, f"{self.root}/silver/{name}", keys=[key], buckets=self.buckets,
                     part_by=day if fixed else None, grain=self.grain, cluster_by=(day, key))

    def gold(self, name: str) -> Table:
        path = f"{self.root}/gold/{name}"
        if name not in FACTS:
            return Table(self.spark, path)
        return Table(self.spark, path, keys=[increments.FACTS[name][0]], buckets=self.buckets,
                     cluster_by=(LAID_OUT_BY.get(name, "created_date"),))

    def daily(self, name: str) -> Table:
        """The daily partials of a fact."""
        return Table(self.spark, f"{self.root}/gold/{partials.PARTIALS[name][0]}", keys=["day"], buckets=self.buckets,
                     cluster_by=("day",))

    def audit(self, name: str) -> Table:
        if name == "ingestion_control":
            return control.control_table(self.spark, f"{self.root}/audit/{name}")
        return Table(self.spark, f"{self.root}/audit/{name}")

    @property
    def daily_rates(self) -> Table:
        """The rate of each currency and day, kept as rates come."""
        return Table(self.spark, f"{self.root}/silver/daily_rates", keys=RATE_KEYS, buckets=1)

    @cached_property
    def rates(self) -> Lookup:
        return rate_lookup(self.daily_rates.read().drop("loaded_at", "ingestion_run_id"))

    def in_parallel(self, work: Callable[[str], object], names: Iterable[str]) -> list:
        """Submit independent jobs together, so small ones do not leave the cluster idle.

        No more of them than a third of the cores: each takes driver memory for its plans, threads and broadcasts,
        and disk for its shuffles, and more would wait for cores.
        """
        cores = self.spark.sparkContext.defaultParallelism
        with ThreadPoolExecutor(min(self.concurrent_models, max(2, cores // 3))) as pool:
            found = list(pool.map(work, names))
        release(self.spark)
        return found


# --- load -------------------------------------------------------------------------------

def _control_name(entity: str) -> tuple[str, str]:
    return ("fx", "rates") if entity == "fx_rates" else ("stripe", entity)


def _control(lake: Lake) -> Table:
    table = lake.audit("ingestion_control")
    if not table.exists():
        table.replace(control.control_seed(lake.spark, lake.watermark_start))
    return table


def ingest(lake: Lake) -> int:
    """Land what came after the watermarks, entity by entity. Returns how many rows.

    An entity that fails is recorded and does not keep the others from landing, but stops the
    run after them: its watermark stays, so the next run takes it up again.
    """
    marks = control.watermarks(_control(lake).read())
    errors: dict[str, str] = {}
    landed = landing.ingest_all(
        lake.spark, {e: lambda e=e, fetch=fetch: fetch(marks.get(_control_name(e), 0)) for e, fetch in lake.payloads.items()},
        lake.root, lake.run_id, lake.as_of, {e: marks.get(_control_name(e), 0) for e in lake.payloads}, errors=errors,
        together=lake.concurrent_models)
    if errors:
        rows = [(_control_name(e)[0], e, "ingest_failed", message, lake.run_id) for e, message in errors.items()]
        found = lake.spark.createDataFrame(rows, "source string, entity string, error_type string, error_message string, run_id string")
        control.record(lake.audit("failed_files"), "failed_files", found.withColumns({
            "file_path": F.concat(F.lit(f"{lake.root}/landing/"), F.col("entity")),
            "failed_at": F.lit(lake.as_of).cast("timestamp_ntz")}))
    landing.raise_on_failure(landed)
    return sum(landed.values())


def load_raw(lake: Lake) -> int:
    """Load every landed file not loaded before. Only optional entities may be absent.

    What was seen while writing a load is noted beside it. Returns how many rows came.
    """
    def one(entity: str) -> int:
        path = landing.entity_path(lake.root, entity)
        required = entity not in OPTIONAL_ENTITIES
        if required and not files.has_files(lake.spark, path) and not lake.raw(entity).exists():
            raise FileNotFoundError(f"nothing landed for {entity}: {path}")
        loaded: list[tuple[int, dict]] = []
        load_once(lake.spark, path, entity, lake.raw(entity), f"{lake.root}/manifest/{entity}",
                  lake.audit(f"rejects/{entity}"), lake.run_id, lake.as_of,
                  file_schema=lake.file_schemas.get(entity, RAW[entity]), note=lambda n, seen: loaded.append((n, seen)))
        log = lake.audit(f"loads/{entity}")
        for number, seen in loaded:
            created = seen["newest_created"]
            if isinstance(created, int):
                created = dt.datetime.fromtimestamp(created, dt.timezone.utc).replace(tzinfo=None)
            elif isinstance(created, dt.date):
                created = dt.datetime(created.year, created.month, created.day)
            row = (number, seen["rows"], seen["newest_loaded_at"], created)
            log.append(lake.spark.createDataFrame([row], LOAD_LOG).coalesce(1), number)
        return sum(seen["rows"] for _, seen in loaded)
    return sum(lake.in_parallel(one, lake.entities))


def load_log(lake: Lake, entity: str) -> DataFrame:
    """One row for each load of an entity: its rows, its newest load and creation times.

    A load that a crash kept from being noted is read for it.
    """
    raw, log = lake.raw(entity), lake.audit(f"loads/{entity}")
    noted = log.read_or_none()
    rest, last = raw.loaded_since(log.last()) if raw.exists() else (None, -1)
    parts = [] if noted is None else [noted]
    if rest is not None:
        created = "rate_date" if entity == "fx_rates" else "created"
        newest = F.max(created) if created in rest.columns else F.lit(None)
        newest = newest.cast("timestamp_ntz") if entity == "fx_rates" else F.timestamp_seconds(newest).cast("timestamp_ntz")
        parts.append(rest.agg(F.lit(last).cast("long").alias("load_number"), F.count(F.lit(1)).alias("rows"),
                              F.max("loaded_at").alias("newest_loaded_at"), newest.alias("newest_created")))
    return reduce(DataFrame.unionByName, parts, lake.spark.createDataFrame([], LOAD_LOG))


def collect_rejects(lake: Lake) -> DataFrame:
    """The dead letters of all entities, and what could not be ingested."""
    found = [lake.audit(name).read_or_none() for name in ("failed_files", *(f"rejects/{e}" for e in lake.entities))]
    present = [df for df in found if df is not None]
    empty = lake.spark.createDataFrame([], AUDIT["failed_files"])
    return reduce(DataFrame.unionByName, present, empty)


def source_freshness(lake: Lake) -> DataFrame:
    """Age of the newest load of each source, from the times noted while loading."""
    def age(entity: str) -> DataFrame:
        return freshness(load_log(lake, entity), entity, lake.as_of, *checks.FRESHNESS[entity],
                         loaded_at="newest_loaded_at")
    return reduce(DataFrame.unionByName, [age(e) for e in lake.entities if checks.FRESHNESS[e]])


def record_freshness(lake: Lake) -> None:
    """Keep the ages. A stale source is reported, it does not stop the run."""
    found = source_freshness(lake).withColumns({
        "run_id": F.lit(lake.run_id), "checked_at": F.lit(lake.as_of).cast("timestamp_ntz")})
    lake.audit("source_freshness").append(found.coalesce(1))


def maintain(lake: Lake) -> None:
    """Rewrite single loads of appended tables together and delete folders that others stand for.

    RAW and Bronze are rewritten only as far as the layers that read them by load have done so.
    """
    def one(entity: str) -> None:
        raw = lake.raw(entity)
        facts = [lake.gold(f).applied(entity) for f, (_, used) in increments.FACTS.items() if entity in used]
        if entity in bronze.MODELS:
            target = lake.bronze(entity)
            raw.compact(target.applied())
            taken = [lake.silver(n).applied() for n, (source, _) in SILVER.items() if source == entity]
            target.compact(min([*taken, *facts], default=None))
            target.drop_replaced()
        else:
            raw.compact(min(facts, default=None))
        manifest = Table(lake.spark, f"{lake.root}/manifest/{entity}")
        for table in (raw, manifest, lake.audit(f"rejects/{entity}"), lake.audit(f"loads/{entity}")):
            if table is not raw:
                table.compact()
            table.drop_replaced()

    lake.in_parallel(one, lake.entities)
    for table in (*(lake.silver(n) for n in SILVER), *(lake.gold(n) for n in (*DIMENSIONS, *FACTS)),
                  *(lake.daily(n) for n in partials.PARTIALS),
                  *(lake.audit(n) for n in AUDIT_TABLES)):
        table.compact()
        table.drop_replaced()


# --- layers -----------------------------------------------------------------------------

def build_bronze(lake: Lake) -> int:
    """Append what RAW loaded since Bronze last took from it. Returns how many rows."""
    def one(entity: str) -> int:
        target = lake.bronze(entity)
        new, reached = lake.raw(entity).loaded_since(target.applied())
        if new is None:
            return 0
        target.append(bronze.MODELS[entity][1](new), reached) if reached > 0 else target.replace(bronze.MODELS[entity][1](new))
        return target.rows_written
    rows = sum(lake.in_parallel(one, [e for e in lake.entities if e in bronze.MODELS]))
    keep_rates(lake)
    return rows


def keep_rates(lake: Lake) -> None:
    """Take the rates that came into the daily ones; the one loaded last counts."""
    target = lake.daily_rates
    new, reached = lake.bronze("fx_rates").loaded_since(target.applied()) if lake.bronze("fx_rates").exists() else (None, -1)
    if new is not None:
        target.upsert(daily_rates(new, LOADED), ("loaded_at", "ingestion_run_id"), batch=reached)
    lake.__dict__.pop("rates", None)


def silver_rows(lake: Lake, name: str, brz: DataFrame) -> DataFrame:
    """The Silver model ``name`` over the given Bronze rows."""
    if name == "stg_customers_history":
        return silver.stg_customers_history(brz, lake.silver(name).read_or_none())
    if name == "stg_disputes":
        return silver.stg_disputes(brz, lake.rates, lake.as_of.date())
    return getattr(silver, name)(brz, lake.rates)


def build_silver(lake: Lake, names: Iterable[str] = tuple(SILVER)) -> None:
    """Upsert what Bronze loaded since Silver last took from it."""
    _ = lake.rates.size  # measured once, before the models share it

    def one(name: str) -> None:
        target = lake.silver(name)
        new, reached = lake.bronze(SILVER[name][0]).loaded_since(target.applied())
        if new is not None:
            target.upsert(silver_rows(lake, name, new), ("loaded_at", "ingestion_run_id"), batch=reached)
    lake.in_parallel(one, names)


def _facts_start_anew(lake: Lake, name: str) -> None:
    """Silver rows changed without a load: the facts that read them are built whole next time."""
    for fact, (_, entities) in increments.FACTS.items():
        if SILVER[name][0] in entities:
            lake.gold(fact).forget()


def rebuild_silver(lake: Lake, name: str) -> None:
    """Full refresh of one Silver table from all of Bronze."""
    brz = lake.bronze(SILVER[name][0]).read()
    if name == "stg_customers_history":
        lake.silver(name).replace(silver.stg_customers_history(brz))
    else:
        lake.silver(name).replace(silver_rows(lake, name, brz))
    _facts_start_anew(lake, name)


def restate_rates(lake: Lake, name: str, days: DataFrame) -> None:
    """Convert again the rows of one Silver table on the given (``from_currency``, ``rate_date``).

    For rates that arrived after the facts they apply to. The days are few; the rows are
    found by a semi join on them.
    """
    entity = SILVER[name][0]
    day = "period_start_date" if name == "stg_invoice_line_items" else "created_date"
    first, last = days.agg(F.min("rate_date"), F.max("rate_date")).first()
    if first is None:
        return
    brz = lake.bronze(entity).read().filter(F.col(day).between(F.lit(first), F.lit(last)))
    late = days.select(F.col("from_currency").alias("_ccy"), F.col("rate_date").alias("_day")).distinct()
    hit = brz.join(late, (F.upper("currency") == F.col("_ccy")) & (F.col(day) == F.col("_day")), "left_semi")
    lake.silver(name).upsert(silver_rows(lake, name, hit), ("loaded_at", "ingestion_run_id"))
    _facts_start_anew(lake, name)


def backfill(lake: Lake, entity: str, first: dt.date, last: dt.date) -> None:
    """Take the landed files of some days through the layers, as after a model was corrected.

    Files that were never loaded are loaded; Silver takes all rows of these days anew, and the facts
    that read them are built whole next time. Only the folders of these days are opened.
    """
    rows = landing.backfill(lake.spark, lake.root, entity, RAW[entity], first, last, lake.file_schemas.get(entity, RAW[entity]))
    known = lake.raw(entity).read_or_none()
    held = with_row_hash(rows)
    if known is not None:
        loaded = known.select("source_file").filter(F.col("source_file").rlike(_days(first, last))).distinct()
        held = held.join(loaded, "source_file", "left_anti").select(*held.columns)
    lake.raw(entity).append(held)
    if entity not in bronze.MODELS:
        return
    build_bronze(lake)
    brz = bronze.MODELS[entity][1](with_row_hash(rows))
    for name, (source, _) in SILVER.items():
        if source == entity:
            lake.silver(name).upsert(silver_rows(lake, name, brz), ("loaded_at", "ingestion_run_id"))
            _facts_start_anew(lake, name)


def _days(first: dt.date, last: dt.date) -> str:
    """A pattern for the folders of the days."""
    days = [first + dt.timedelta(n) for n in range((last - first).days + 1)]
    return "/(" + "|".join(f"{d:year=%Y/month=%m/day=%d}" for d in days) + ")/"


def build_gold(lake: Lake, whole: bool = False) -> None:
    """Dimensions anew, facts by what changed since they were last built, or ``whole``."""
    stg = {name: lake.silver(name).read() for name in SILVER}
    history, lines = stg["stg_customers_history"], stg["stg_invoice_line_items"]
    dimensions = {
        "dim_customers": lambda: gold.dim_customers(history),
        "dim_dates": lambda: gold.dim_dates(lake.spark, lake.calendar_start, lake.calendar_end),
        "dim_currencies": lambda: gold.dim_currencies(lake.bronze("fx_rates").read(), lake.as_of.date()),
        "dim_geography": lambda: gold.dim_geography(history, lake.as_of),
        "dim_payment_category": lambda: gold.dim_payment_category(
            stg["stg_finance_ledger_events"], lake.as_of),
        "dim_plans": lambda: gold.dim_plans(lines),
    }
    lake.in_parallel(lambda n: lake.gold(n).replace(dimensions[n]()), dimensions)

    customers = lake.gold("dim_customers").read()
    dates = gold.date_lookup(lake.gold("dim_dates").read())
    currencies = gold.currency_lookup(lake.gold("dim_currencies").read())
    _ = dates.size, currencies.size
    charges, refunds, disputes = stg["stg_charges"], stg["stg_refunds"], stg["stg_disputes"]

    def transactions() -> DataFrame:
        sources = gold.source_customers(charges, refunds, disputes, unique=False) if lake.resolve_sources else None
        return gold.fct_transactions(stg["stg_finance_ledger_events"], customers, dates, sources)

    facts = {
        "fct_transactions": transactions,
        "fct_charges": lambda: gold.fct_charges(charges, customers, dates, currencies),
        "fct_refunds": lambda: gold.fct_refunds(refunds, charges, customers, dates, currencies),
        "fct_disputes": lambda: gold.fct_disputes(disputes, charges, customers, dates, currencies),
        "fct_payouts": lambda: gold.fct_payouts(stg["stg_payouts"], dates, currencies),
        "fct_mrr_movements": lambda: gold.fct_mrr_movements(
            lines, lake.raw("subscriptions").read(), lake.as_of),
    }

    # A fact may take no more than Silver has.
    reached = {e: lake.silver(n).applied() for n, (e, _) in SILVER.items()}
    reached["subscriptions"] = lake.raw("subscriptions").last()

    def loads(entity: str) -> Table:
        return lake.bronze(entity) if entity in bronze.MODELS else lake.raw(entity)

    scratch = work_dir(lake.spark, "increments")
    sources = increments.Sources(
        lake.silver, lambda entity, load: loads(entity).loaded_since(load)[0], lambda entity: loads(entity).read(),
        customers, dates, currencies, lake.resolve_sources, lake.as_of, scratch)

    def one(name: str) -> None:
        target, used = lake.gold(name), increments.FACTS[name][1]
        taken = {e: target.applied(e) for e in used}
        if whole or not target.exists() or min(taken.values()) < 0:
            target.replace(facts[name]())
            if name in partials.PARTIALS:
                lake.daily(name).replace(partials.PARTIALS[name][1](target.read()))
        elif found := increments.changes(sources, name, target.read(), taken.__getitem__):
            gone, rows = found[0], sources.written(found[1])
            days = None if name not in partials.PARTIALS else sources.ids(
                [target.rows_of(gone, different=True).select("created_date"), rows.select("created_date")], "day")
            target.swap(gone, rows, written=True)
            sources.drop(rows)
            if days is not None:  # the days of the old rows and of the new ones
                rows = semi_join(target.read(), days, {"created_date": "day"}, different=True)
                lake.daily(name).swap(days, partials.PARTIALS[name][1](rows))
        for entity in used:
            target.took(reached[entity], entity)
    try:
        lake.in_parallel(one, facts)
    finally:
        files.remove(lake.spark, scratch)


# --- gates ------------------------------------------------------------------------------

def run_tests(lake: Lake, declared: dict[str, list], read: Callable[[str], DataFrame]) -> None:
    """Run the declared tests of a layer, record them all, then stop the run on a failure."""
    def one(name: str) -> list:
        return run_checks(read(name), name, declared[name]).collect()  # one row per test
    rows = [r for part in lake.in_parallel(one, declared) for r in part]
    schema = "test_name string, model_name string, column_name string, status string, failure_count long"
    results = lake.spark.createDataFrame(rows, schema).withColumns({
        "run_id": F.lit(lake.run_id),
        "generated_at": F.lit(lake.as_of).cast("timestamp_ntz"),
        "logged_at": F.lit(lake.as_of).cast("timestamp_ntz"),
    })
    control.record(lake.audit("dbt_test_results"), "dbt_test_results", results)
    failed = [r["test_name"] for r in rows if r["status"] == "fail" and r["test_name"] not in lake.tolerated]
    if failed:
        raise GateFailed(f"tests failed: {', '.join(sorted(failed))}")


def reconcile_run(lake: Lake) -> DataFrame:
    """Record all reconciliation checks, then stop the run if any failed."""
    tables = {n: lake.silver(n).read() for n in SILVER} | {n: lake.gold(n).read() for n in FACTS}
    missing = count_missing_rates(
        [(lake.silver(n).read(), "period_start_date" if n == "stg_invoice_line_items" else "created_date")
         for n in SILVER if n != "stg_customers_history"], lake.rates)
    # A few rows, computed once: recorded, read back for the gate.
    control.record(lake.audit("reconciliation_results"), "reconciliation_results",
                   reconcile(tables, lake.run_id, lake.as_of, missing).unionByName(
                       compare_values(tables, lake.run_id, lake.as_of)))
    results = lake.audit("reconciliation_results").read().filter(F.col("run_id") == lake.run_id)
    failed = [r[0] for r in results.filter("status = 'failed'").select("check_name").collect()]
    if failed:
        raise GateFailed(f"reconciliation failed: {', '.join(sorted(failed))}")
    return results


def advance(lake: Lake) -> None:
    """Move each watermark to the newest creation time loaded, as noted while loading.

    Invoice lines are as new as their invoices, which is also what ingest holds them against.
    """
    table = _control(lake)
    reached = []
    for entity in lake.entities:
        noted = load_log(lake, "invoices" if entity == "invoice_line_items" else entity)
        source, name = _control_name(entity)
        reached.append(noted.agg(F.max("newest_created").alias("last_successful_watermark")).select(
            F.lit(source).alias("source_name"), F.lit(name).alias("entity_name"), "last_successful_watermark"))
    control.advance_watermarks(table, reduce(DataFrame.unionByName, reached), lake.run_id, lake.as_of)


def run_daily(lake: Lake) -> DataFrame:
    """One full run. Returns the reconciliation results; raises before watermarks move."""
    stages: list[tuple[str, Callable[[], object]]] = [
        *([("ingest", lambda: ingest(lake))] if lake.payloads else []),
        ("load_raw", lambda: load_raw(lake)),
        ("source_tests", lambda: run_tests(
            lake, {e: c for e, c in checks.RAW.items() if e in lake.entities},
            lambda e: lake.raw(e).read())),
        ("source_freshness", lambda: record_freshness(lake)),
        ("bronze", lambda: build_bronze(lake)),
        ("silver", lambda: build_silver(lake)),
        ("test_silver", lambda: run_tests(lake, checks.SILVER, lambda n: lake.silver(n).read())),
        ("gold", lambda: build_gold(lake)),
        ("test_gold", lambda: run_tests(lake, checks.GOLD, lambda n: lake.gold(n).read())),
        ("reconcile", lambda: reconcile_run(lake)),
        ("advance_watermarks", lambda: advance(lake)),
        ("maintain", lambda: maintain(lake)),
    ]
    outcome: dict[str, object] = {}
    entries: list[DataFrame] = []

    def log(task: str, started: dt.datetime, rows: object = None, error: str | None = None) -> None:
        entries.append(control.run_entry(
            lake.spark, lake.run_id, task, "failed" if error else "success", started, _now(),
            rows=rows if isinstance(rows, int) else None, error=error))

    try:
        for task, work in stages:
            started = _now()
            try:
                outcome[task] = work()
            except Exception as err:
                log(task, started, error=str(err))
                raise
            log(task, started, outcome[task])
    finally:
        control.record(lake.audit("pipeline_runs"), "pipeline_runs",
                       reduce(DataFrame.unionByName, entries))
    return outcome["reconcile"]


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
