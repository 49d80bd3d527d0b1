"""Sources and sinks (S), payload flattening (P), streams (T), control jobs (Q6 to Q10).

Queries that write do so below a fresh folder of the shared work directory and return
what they read back.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

import adapters
import oracles as o
from catalog.base import AS_OF, CALENDAR_START, raw, register, warehouse
from ledgerlake.operators.align import align_to_schema, split_rejects
from ledgerlake.operators.layout import overlapping
from ledgerlake.plans import bronze, pipeline, silver
from ledgerlake.schemas import RAW
from ledgerlake.session import work_dir
from ledgerlake.sources import control, files, flatten, landing, load
from ledgerlake.sources.tables import Table
from ledgerlake.streaming import loads

RUN_DAY = dt.datetime(2024, 2, 5, 15, 30)
LANDED = ("balance_transactions", "charges", "refunds", "disputes", "payouts", "customers",
          "subscriptions", "invoices", "invoice_line_items", "fx_rates")


def ntz(value: dt.datetime):
    return F.lit(value).cast("timestamp_ntz")


def at_load(df: DataFrame, day: int) -> DataFrame:
    """Rows of the load of one day in February 2024."""
    return df.filter(F.col("loaded_at") == ntz(dt.datetime(2024, 2, day)))


def columns_of(entity: str, but: str = "") -> str:
    """The RAW columns of an entity, for a statement."""
    return ", ".join(f.name for f in RAW[entity].fields if f.name not in but.split())


# --- landing ----------------------------------------------------------------------------

@register("S1_landing_scan", o.statement("raw_disputes", f"""
SELECT {columns_of('disputes', 'source_file')}, true AS has_file FROM raw_disputes"""))
def _(spark, sf_dir):
    root = work_dir(spark, "s1")
    landing.write_landing(raw(spark, sf_dir, "disputes"), root, "disputes", "run-1", RUN_DAY.date())
    found = landing.read_landing(spark, root, "disputes", RAW["disputes"])
    return found.withColumn("has_file", F.col("source_file").contains("run_id=run-1")).drop("source_file")


@register("S2_landing_sink", o.statement("raw_charges", """
SELECT CASE ingestion_run_id WHEN 'run-1' THEN 5 ELSE 6 END::INTEGER AS day, ingestion_run_id AS run_id, count(*) AS n
FROM raw_charges GROUP BY ALL"""))
def _(spark, sf_dir):
    """Two runs on two days, the first one repeated; its files are replaced, not doubled."""
    root, charges = work_dir(spark, "s2"), raw(spark, sf_dir, "charges")
    for run, day in (("run-1", 5), ("run-1", 5), ("run-2", 6)):
        rows = charges.filter(F.col("ingestion_run_id") == run)
        landing.write_landing(rows, root, "charges", run, dt.date(2024, 2, day))
    landed = spark.read.parquet(landing.entity_path(root, "charges"))
    return landed.groupBy(F.col("day").cast("int").alias("day"), "run_id").agg(F.count(F.lit(1)).alias("n"))


@register("S3_align_by_name", o.statement("raw_payouts", f"SELECT {columns_of('payouts')} FROM raw_payouts"))
def _(spark, sf_dir):
    """Upper-case names, an unknown column, missing columns and text for a number."""
    view = adapters.spark_view(spark, sf_dir, "payouts")
    odd = view.withColumn("amount", F.col("amount").cast("string")).withColumn("unknown", F.lit(1))
    return align_to_schema(odd.toDF(*(c.upper() for c in odd.columns)), RAW["payouts"])


_BROKEN_AMOUNT = "CASE WHEN status = 'failed' THEN 'n/a' ELSE CAST(amount AS STRING) END"


def _broken_payouts(spark, sf_dir) -> DataFrame:
    view = adapters.spark_view(spark, sf_dir, "payouts")
    return view.withColumn("amount", F.expr(_BROKEN_AMOUNT)).withColumn(
        "id", F.when(F.col("status") != "Canceled", F.col("id")))


@register("S3b_loaded_rows", o.statement("raw_payouts", f"""
SELECT {columns_of('payouts')} FROM raw_payouts WHERE status NOT IN ('failed', 'Canceled')"""))
def _(spark, sf_dir):
    return split_rejects(_broken_payouts(spark, sf_dir), RAW["payouts"])[0]


@register("S3b_dead_letters", o.statement("raw_payouts", """
SELECT error_message, count(*) AS n FROM (SELECT CASE status WHEN 'failed' THEN 'amount: cannot convert'
 WHEN 'Canceled' THEN 'id: missing' END AS error_message FROM raw_payouts) WHERE error_message IS NOT NULL GROUP BY ALL"""))
def _(spark, sf_dir):
    rejects = split_rejects(_broken_payouts(spark, sf_dir), RAW["payouts"])[1]
    return rejects.groupBy("error_message").agg(F.count(F.lit(1)).alias("n"))


@register("S3c_optional_entity", o.statement("raw_refunds", """
SELECT 'disputes' AS entity, 0::BIGINT AS n UNION ALL SELECT 'refunds', count(*) FROM raw_refunds"""))
def _(spark, sf_dir):
    """Refunds were landed, disputes were not."""
    root = work_dir(spark, "s3c")
    landing.write_landing(raw(spark, sf_dir, "refunds"), root, "refunds", "run-1", RUN_DAY.date())

    def rows(entity: str) -> DataFrame:
        found = landing.read_optional(spark, root, entity, RAW[entity])
        return found.agg(F.count(F.lit(1)).alias("n")).select(F.lit(entity).alias("entity"), "n")

    return rows("disputes").unionByName(rows("refunds"))


# --- tables -----------------------------------------------------------------------------

_LATEST_CHARGES = o.statement("brz_stripe_charges", f"""
SELECT id, amount, status, currency, created_date, ingestion_run_id, loaded_at
FROM {o.latest('brz_stripe_charges')}""")


def _charge_versions(spark, sf_dir) -> DataFrame:
    return warehouse(spark, sf_dir).bronze("charges").select(
        "id", "amount", "status", "currency", "created_date", "ingestion_run_id", "loaded_at")


@register("S4_upsert", _LATEST_CHARGES)
def _(spark, sf_dir):
    """Two loads upserted in the wrong order, then one of them once more."""
    rows = _charge_versions(spark, sf_dir)
    table = Table(spark, work_dir(spark, "s4"), keys=["id"], cluster_by=("created_date", "id"))
    second, first = rows.filter("ingestion_run_id = 'run-2'"), rows.filter("ingestion_run_id = 'run-1'")
    for batch in (second, first, second):
        table.upsert(batch, ("loaded_at", "ingestion_run_id"))
    return table.read()


@register("S5_append", o.statement("raw_customers", """
SELECT id, ingestion_run_id, loaded_at FROM raw_customers"""))
def _(spark, sf_dir):
    rows = raw(spark, sf_dir, "customers").select("id", "ingestion_run_id", "loaded_at")
    table = Table(spark, work_dir(spark, "s5"))
    for day in (1, 2, 3):
        table.append(at_load(rows, day))
    return table.read()


@register("S6_full_refresh", o.whole("dim_geography"))
def _(spark, sf_dir):
    geography = warehouse(spark, sf_dir).dim_geography
    table = Table(spark, work_dir(spark, "s6"))
    table.replace(geography.filter("region = 'EMEA'"))
    table.replace(geography)
    return table.read()


@register("S8_append_new_columns", o.statement("raw_customers", """
SELECT id, CASE WHEN loaded_at = TIMESTAMP '2024-02-03' THEN NULL ELSE name END AS name,
 CASE WHEN loaded_at = TIMESTAMP '2024-02-01' THEN NULL ELSE email END AS email,
 CASE WHEN loaded_at = TIMESTAMP '2024-02-03' THEN balance END AS balance, loaded_at
FROM raw_customers"""))
def _(spark, sf_dir):
    """The second load brings a new column; the third another one, and lacks an old one."""
    rows = raw(spark, sf_dir, "customers")
    table = Table(spark, work_dir(spark, "s8"))
    table.append(at_load(rows, 1).select("id", "name", "loaded_at"))
    table.append(at_load(rows, 2).select("id", "email", "loaded_at", "name"))
    table.append(at_load(rows, 3).select("balance", "id", "email", "loaded_at"))
    return table.read()


@register("S8_sync_all_columns", o.statement("raw_customers", """
SELECT id || '@' || CAST(CAST(loaded_at AS DATE) AS VARCHAR) AS version,
 CASE WHEN loaded_at = TIMESTAMP '2024-02-03' THEN balance END AS balance, loaded_at
FROM raw_customers"""))
def _(spark, sf_dir):
    """Three upserts into one table, each with other columns; the last ones stay."""
    rows = raw(spark, sf_dir, "customers").withColumn(
        "version", F.concat("id", F.lit("@"), F.col("loaded_at").cast("date").cast("string")))
    table = Table(spark, work_dir(spark, "s8s"), keys=["version"], buckets=4)
    for day, column in ((1, "name"), (2, "email"), (3, "balance")):
        table.upsert(at_load(rows, day).select("version", column, "loaded_at"), ("loaded_at",))
    return table.read()


@register("S9_layout", o.statement("stg_charges", """
SELECT charge_id, created_date, amount_usd, true AS few_files_by_date, true AS few_files_by_id FROM stg_charges"""))
def _(spark, sf_dir):
    """Written along a curve over date and id: a filter on either opens half of the files at most."""
    charges = warehouse(spark, sf_dir).stg_charges.select("charge_id", "created_date", "amount_usd")
    table = Table(spark, work_dir(spark, "s9"), curve_by=("created_date", "charge_id"), files=16)
    table.replace(charges)
    stored = table.read()
    middle = stored.agg(F.percentile(F.unix_date("created_date"), F.lit(0.5)).cast("int").alias("day"),
                        F.max_by("charge_id", F.xxhash64("charge_id")).alias("id")).first()
    day = dt.date(1970, 1, 1) + dt.timedelta(middle["day"])
    few = {}
    for name, column, value in (("few_files_by_date", "created_date", day), ("few_files_by_id", "charge_id", middle["id"])):
        hit, files_ = overlapping(stored, column, value)
        few[name] = F.lit(files_ == 16 and 1 <= hit <= files_ // 2)
    return stored.withColumns(few)


@register("S12_stamp", o.statement("raw_payouts", """
SELECT id, 'run-9' AS ingestion_run_id, 'batch' AS load_mode, TIMESTAMP '2024-02-05 15:30:00' AS loaded_at FROM raw_payouts"""))
def _(spark, sf_dir):
    return landing.stamp(raw(spark, sf_dir, "payouts").select("id"), "run-9", RUN_DAY)


_MARKS = {"charges": 800000000, "payouts": 4000000000, "invoices": 850000000, "invoice_line_items": 850000000}


def _landed_sql(entity: str) -> str:
    if entity == "fx_rates":
        count = ("(SELECT count(*) FROM raw_fx_rates WHERE upper(from_currency) <> 'USD') + "
                 "(SELECT count(DISTINCT rate_date) FROM raw_fx_rates)")
    elif entity == "invoice_line_items":
        count = (f"(SELECT 2 * count(*) FROM raw_invoice_line_items WHERE proration IS NOT NULL "
                 f"AND period_start > {_MARKS[entity]})")
    else:
        kept = f"created > {_MARKS.get(entity, 0)}" if entity != "subscriptions" else "false"
        count = f"(SELECT count(*) FROM raw_{entity} WHERE {kept})"
    return f"SELECT '{entity}' AS entity, CAST({count} AS BIGINT) AS rows"


@register("S14_ingest_all", o.statement(
    " ".join(f"raw_{e}" for e in LANDED), " UNION ALL ".join(map(_landed_sql, LANDED)) + " UNION ALL SELECT 'prices', -1"))
def _(spark, sf_dir):
    """Every daily entity, from JSON payloads, under watermarks that cut some partly, payouts
    wholly and lines by the time of their invoice; a subscription without a time is not new;
    the source of prices fails."""
    def fails() -> DataFrame:
        raise OSError("no payloads")

    def payloads(entity: str) -> DataFrame:
        if entity == "fx_rates":
            return _quotes(spark, sf_dir)
        if entity == "invoice_line_items":
            return flatten.to_payload(_invoices(spark, sf_dir))
        return nested_payload(raw(spark, sf_dir, entity), flatten.NESTED.get(entity, {}))

    sources = {e: lambda e=e: payloads(e) for e in LANDED}
    landed = landing.ingest_all(spark, sources | {"prices": fails}, work_dir(spark, "s14"), "run-9", RUN_DAY,
                                {e: 0 for e in LANDED} | _MARKS)
    return spark.createDataFrame(list(landed.items()), "entity string, rows long")


@register("S15_load_strategies", o.statement("raw_customers", """
SELECT 'timestamp_watermark' AS strategy, count(*) AS n FROM raw_customers
UNION ALL SELECT 'full_snapshot', count(*) FROM raw_customers
UNION ALL SELECT 'cursor', count(*) FILTER (loaded_at = TIMESTAMP '2024-02-01' OR created > 800000000) FROM raw_customers"""))
def _(spark, sf_dir):
    """The same load repeated under each strategy."""
    rows = raw(spark, sf_dir, "customers").select("id", "created", "loaded_at")
    root = work_dir(spark, "s15")
    out = None
    for strategy in ("timestamp_watermark", "full_snapshot", "cursor"):
        table = Table(spark, f"{root}/{strategy}")
        if strategy == "cursor":
            load.load(at_load(rows, 1), table, strategy)
            load.load(rows.filter(F.col("loaded_at") > ntz(dt.datetime(2024, 2, 1))), table, strategy,
                      cursor=("created", 800000000))
        else:
            load.load(at_load(rows, 1), table, strategy)
            load.load(rows, table, strategy)
            load.load(rows, table, strategy)
        part = table.read().agg(F.count(F.lit(1)).alias("n")).select(F.lit(strategy).alias("strategy"), "n")
        out = part if out is None else out.unionByName(part)
    return out


@register("S16_rebuild", o.whole("stg_payouts"))
def _(spark, sf_dir):
    """Bronze holds every row twice; the rebuilt Silver table does not."""
    w = warehouse(spark, sf_dir)
    doubled, target = Table(spark, work_dir(spark, "s16b")), Table(spark, work_dir(spark, "s16s"))
    doubled.append(w.bronze("payouts"))
    doubled.append(w.bronze("payouts"))
    load.rebuild(lambda brz: silver.stg_payouts(brz, w.rates), doubled.read(), target)
    return target.read()


@register("S17_backfill", o.statement("raw_charges", """
SELECT id, ingestion_run_id, loaded_at FROM raw_charges WHERE loaded_at <= TIMESTAMP '2024-02-02'"""))
def _(spark, sf_dir):
    """Three days landed, the first two read."""
    root, charges = work_dir(spark, "s17"), raw(spark, sf_dir, "charges")
    for day in (1, 2, 5):
        landing.write_landing(at_load(charges, day), root, "charges", f"run-{day}", dt.date(2024, 2, day))
    found = landing.backfill(spark, root, "charges", RAW["charges"], dt.date(2024, 2, 1), dt.date(2024, 2, 2))
    return found.select("id", "ingestion_run_id", "loaded_at")


# --- payloads ---------------------------------------------------------------------------

_NOT_IN_PAYLOAD = "raw_payload source_file ingestion_run_id load_mode loaded_at"


def _flat(name: str, entity: str) -> None:
    """Nested payloads built from the whole RAW view, flattened again."""
    nested = flatten.NESTED.get(entity, {})
    statement = o.statement(f"raw_{entity}", f"SELECT {columns_of(entity, _NOT_IN_PAYLOAD)} FROM raw_{entity}")

    @register(name, statement)
    def _(spark, sf_dir):
        view = raw(spark, sf_dir, entity)
        payloads = nested_payload(view, nested)
        return flatten.FLATTENERS[entity](payloads).drop("raw_payload")


def nested_payload(view: DataFrame, nested: dict[str, str]) -> DataFrame:
    """JSON objects in which the given columns sit at their nested paths."""
    kept = [F.col(f.name) for f in view.schema.fields
            if f.name not in nested and f.name not in _NOT_IN_PAYLOAD.split()]
    tree: dict = {}
    for column, path in nested.items():
        *parents, leaf = path.split(".")
        level = tree
        for name in parents:
            level = level.setdefault(name, {})
        level[leaf] = F.col(column)

    def built(level: dict) -> list:
        return [(F.struct(*built(v)) if isinstance(v, dict) else v).alias(n) for n, v in level.items()]

    return view.select(F.to_json(F.struct(*kept, *built(tree))).alias("payload"))


for _name, _entity in {
    "P1_flatten_balance_transactions": "balance_transactions", "P3_flatten_refunds": "refunds",
    "P4_flatten_disputes": "disputes", "P5_flatten_payouts": "payouts",
    "P6_flatten_customers": "customers", "P7_flatten_subscriptions": "subscriptions",
    "P8_flatten_invoices": "invoices",
}.items():
    _flat(_name, _entity)


# Charge fields that the RAW view leaves NULL, in SQL that both engines read.
_CHARGE_FIELDS = {
    "object": "'charge'", "captured": "amount % 2 = 0", "customer": "'cus_' || id", "description": "'order ' || id",
    "disputed": "amount % 7 = 0", "failure_code": "CASE WHEN amount % 3 = 0 THEN 'card_declined' END",
    "failure_message": "CASE WHEN amount % 3 = 0 THEN 'The card was declined.' END", "invoice": "'in_' || id",
    "paid": "amount % 5 <> 0", "payment_intent": "'pi_' || id", "receipt_email": "id || '@example.com'",
    "refunded": "amount_refunded > 0", "payment_method": "'pm_' || id", "balance_transaction": "'txn_' || id",
    "receipt_url": "'https://example.com/' || id", "statement_descriptor": "upper(id)",
    "payment_method_details_type": "CASE WHEN amount % 11 <> 0 THEN 'card' END",
    "payment_method_details_card_brand": "CASE WHEN amount % 2 = 0 THEN 'visa' ELSE 'amex' END",
    "payment_method_details_card_funding": "CASE WHEN amount % 4 = 0 THEN 'debit' ELSE 'credit' END",
    "payment_method_details_card_country": "CASE WHEN amount % 6 = 0 THEN NULL ELSE 'US' END",
    "payment_method_details_card_last4": "right(id, 4)", "payment_method_details_card_exp_month": "amount % 12 + 1",
    "payment_method_details_card_exp_year": "amount % 5 + 2024",
}
_CHARGE_COLUMNS = [f.name for f in RAW["charges"].fields if f.name not in _NOT_IN_PAYLOAD.split()]


@register("P2_flatten_charges", o.statement("raw_charges", "SELECT " + ", ".join(
    f"{_CHARGE_FIELDS[c]} AS {c}" if c in _CHARGE_FIELDS else c for c in _CHARGE_COLUMNS) + " FROM raw_charges"))
def _(spark, sf_dir):
    """Every field, the nested ones at their paths."""
    rows = raw(spark, sf_dir, "charges").selectExpr(
        *(f"{_CHARGE_FIELDS[c]} AS {c}" if c in _CHARGE_FIELDS else c for c in _CHARGE_COLUMNS))
    return flatten.flatten(nested_payload(rows, flatten.NESTED["charges"]), "charges").drop("raw_payload")


def _invoices(spark, sf_dir) -> DataFrame:
    """One invoice object per line of the RAW view: the line, and a second, prorated one.

    Invoices whose line has no proration flag get an empty list of lines.
    """
    def line(id_, proration):
        return F.struct(
            id_.alias("id"), "amount", "currency", proration.alias("proration"), "type", "subscription",
            F.struct(F.col("period_start").alias("start"), F.col("period_end").alias("end")).alias("period"),
            F.struct(F.col("plan_id").alias("id"), F.col("plan_interval").alias("interval"),
                     F.col("plan_interval_count").alias("interval_count")).alias("plan"),
            F.struct(F.col("price_id").alias("id")).alias("price"))

    pair = F.array(line(F.col("id"), F.col("proration")),
                   line(F.concat("id", F.lit("_p")), F.lit(True)))
    listed = F.when(F.col("proration").isNotNull(), pair).otherwise(F.slice(pair, 1, 0))
    return raw(spark, sf_dir, "invoice_line_items").select(
        F.col("invoice_id").alias("id"), "subscription", F.col("amount").alias("total"),
        F.col("period_start").alias("created"), F.struct(listed.alias("data")).alias("lines"))


_LINE = ("invoice_id, amount, currency, period_start, period_end, plan_id, plan_interval, "
         "plan_interval_count, price_id, type, subscription")


@register("P9_flatten_invoice_line_items", o.statement("raw_invoice_line_items", f"""
SELECT id, proration, {_LINE} FROM raw_invoice_line_items WHERE proration IS NOT NULL
UNION ALL SELECT id || '_p', true, {_LINE} FROM raw_invoice_line_items WHERE proration IS NOT NULL"""))
def _(spark, sf_dir):
    payloads = _invoices(spark, sf_dir).select(F.to_json(F.struct("*")).alias("payload"))
    return flatten.flatten_invoice_line_items(payloads).select("id", "proration", *_LINE.split(", "))


def _quotes(spark, sf_dir) -> DataFrame:
    """One JSON object of quotes per day and load."""
    rates = raw(spark, sf_dir, "fx_rates")
    return rates.groupBy("rate_date", "ingestion_run_id").agg(F.to_json(F.struct(
        F.first("rate_date").alias("rate_date"),
        F.map_from_entries(F.collect_list(F.struct(F.upper("from_currency"), "rate"))).alias("rates"))
    ).alias("payload")).select("payload")


@register("P10_fx_from_usd_base", o.statement("raw_fx_rates", """
WITH n AS (SELECT rate_date, upper(from_currency) AS from_currency, CAST(rate * 1000000 AS HUGEINT) AS k
 FROM raw_fx_rates WHERE upper(from_currency) <> 'USD')
SELECT rate_date, from_currency, 'USD' AS to_currency, CASE WHEN k <> 0 THEN
 CAST(CAST((2 * 1000000000000 + k) // (2 * k) AS DECIMAL(38,0)) * CAST(0.000001 AS DECIMAL(7,6)) AS DECIMAL(12,6)) END AS rate,
 'exchangerate' AS source FROM n
UNION ALL SELECT DISTINCT rate_date, 'USD', 'USD', CAST(1 AS DECIMAL(12,6)), 'exchangerate' FROM raw_fx_rates"""))
def _(spark, sf_dir):
    return flatten.fx_from_usd_base(_quotes(spark, sf_dir))


@register("P11_to_payload", o.statement("raw_disputes", """
SELECT CAST(to_json({'id': id, 'amount': amount, 'is_won': ifnull(status = 'won', false), 'reason': reason,
 'total_usd': CAST(amount AS DOUBLE) / 100.0}) AS VARCHAR) AS payload FROM raw_disputes"""))
def _(spark, sf_dir):
    """The text itself: decimals are numbers, NULL fields are kept."""
    return flatten.to_payload(raw(spark, sf_dir, "disputes").select(
        "id", "amount", F.coalesce(F.col("status") == "won", F.lit(False)).alias("is_won"), "reason",
        (F.col("amount").cast("decimal(18,0)") * F.expr("0.01BD")).alias("total_usd")))


# --- streams ----------------------------------------------------------------------------

def _land_charges(spark, sf_dir, root: str) -> DataFrame:
    charges = raw(spark, sf_dir, "charges")
    for day in (1, 2):
        landing.write_landing(at_load(charges, day), root, "charges", f"run-{day}", dt.date(2024, 2, day))
    return charges


@register("S7_T1_load_each_file_once", o.statement("raw_charges", """
SELECT id, amount, ingestion_run_id, loaded_at FROM raw_charges"""))
def _(spark, sf_dir):
    """Two days, a run without news, a third day, and another run without news."""
    root = work_dir(spark, "s7")
    charges = _land_charges(spark, sf_dir, root)
    target = Table(spark, f"{root}/raw/charges")

    def run() -> None:
        loads.load_once(spark, landing.entity_path(root, "charges"), "charges", target, f"{root}/manifest")

    run()
    run()
    landing.write_landing(at_load(charges, 5), root, "charges", "run-5", dt.date(2024, 2, 5))
    run()
    run()
    return target.read().select("id", "amount", "ingestion_run_id", "loaded_at")


@register("S7_old_files", o.statement("raw_charges", """
SELECT id, amount, ingestion_run_id, loaded_at FROM raw_charges"""))
def _(spark, sf_dir):
    """The newest day is loaded first; the files of the others then arrive, years old."""
    root, charges = work_dir(spark, "s7o"), raw(spark, sf_dir, "charges")
    target = Table(spark, f"{root}/raw/charges")
    for number, day in enumerate((5, 2, 1)):
        path = landing.write_landing(at_load(charges, day), root, "charges", f"run-{day}", dt.date(2024, 2, day))
        if number:
            files.set_modified(spark, path, dt.datetime(2019, 1, day))
        loads.load_once(spark, landing.entity_path(root, "charges"), "charges", target, f"{root}/manifest",
                        file_schema=RAW["charges"])
    return target.read().select("id", "amount", "ingestion_run_id", "loaded_at")


@register("F2_late_and_equal_loads", o.whole("stg_charges"))
def _(spark, sf_dir):
    """Charges land newest day first, and each day in two runs with the same load time; RAW,
    Bronze and Silver take each of them up by what was committed."""
    root = work_dir(spark, "f2")
    daily = lake(spark, root, "run-f2", entities=("fx_rates", "charges"))
    landing.write_landing(raw(spark, sf_dir, "fx_rates"), root, "fx_rates", "run-a", dt.date(2024, 2, 5))
    charges = raw(spark, sf_dir, "charges")
    half = F.pmod(F.xxhash64("id"), F.lit(2))
    for day in (5, 2, 1):
        for part in (0, 1):
            landing.write_landing(at_load(charges, day).filter(half == part), root, "charges",
                                  f"run-{day}-{part}", dt.date(2024, 2, day))
            pipeline.load_raw(daily)
            pipeline.build_bronze(daily)
            pipeline.build_silver(daily, ["stg_charges"])
    return daily.silver("stg_charges").read()


@register("T2_streaming_bronze", o.statement("brz_stripe_disputes", """
SELECT * EXCLUDE (source_file) REPLACE ('streaming' AS load_mode) FROM brz_stripe_disputes"""))
def _(spark, sf_dir):
    root = work_dir(spark, "t2")
    landing.write_landing(raw(spark, sf_dir, "disputes"), root, "disputes", "run-1", RUN_DAY.date())
    stream = loads.landed_files(spark, landing.entity_path(root, "disputes"))
    target = Table(spark, f"{root}/bronze/disputes")
    for _ in range(2):
        loads.stream_bronze(stream, "disputes", target, f"{root}/checkpoint")
    return target.read().drop("source_file")


@register("T3_streaming_upsert", o.whole("stg_charges"))
def _(spark, sf_dir):
    """The newest day arrives first; the order of arrival leaves no trace."""
    root = work_dir(spark, "t3")
    w = warehouse(spark, sf_dir)
    target = Table(spark, f"{root}/silver/charges", keys=["charge_id"])
    charges = raw(spark, sf_dir, "charges")
    for day in (5, 2, 1):
        landing.write_landing(at_load(charges, day), root, "charges", f"run-{day}", dt.date(2024, 2, day))
        stream = loads.landed_files(spark, landing.entity_path(root, "charges"))
        loads.stream_upsert(
            align_to_schema(stream, RAW["charges"]),
            lambda batch: silver.stg_charges(bronze.brz_stripe_charges(batch), w.rates),
            target, f"{root}/checkpoint", ("loaded_at", "ingestion_run_id"), newest_by=["id"])
    return target.read()


# --- control ----------------------------------------------------------------------------

@register("Q6_record_results", o.statement("raw_charges", """
SELECT 'run-9' AS run_id, 'unique_charges_id' AS test_name, 'charges' AS model_name, 'id' AS column_name,
 CASE WHEN n = 0 THEN 'pass' ELSE 'fail' END AS status, n AS failure_count,
 TIMESTAMP '2024-02-05 15:30:00' AS generated_at, TIMESTAMP '2024-02-05 15:30:00' AS logged_at
FROM (SELECT count(*) AS n FROM (SELECT id FROM raw_charges GROUP BY id HAVING count(*) > 1))"""))
def _(spark, sf_dir):
    from ledgerlake.operators.quality import Check, run_checks

    results = run_checks(raw(spark, sf_dir, "charges"), "charges", [Check("id", "unique")]).withColumns({
        "run_id": F.lit("run-9"), "generated_at": ntz(RUN_DAY), "logged_at": ntz(RUN_DAY)})
    table = Table(spark, work_dir(spark, "q6"))
    control.record(table, "dbt_test_results", results)
    return table.read()


_MARKED = ("charges", "refunds", "disputes", "payouts", "customers")
_SEED = 1577836800  # 2020-01-01


@register("Q7_Q8_watermarks", o.statement(" ".join(f"raw_{e}" for e in _MARKED), " UNION ALL ".join(
    f"SELECT '{e}' AS entity, greatest(max(created), {_SEED}) AS watermark FROM raw_{e}" for e in _MARKED) +
    f" UNION ALL SELECT 'invoices', {_SEED} UNION ALL SELECT 'unknown', 0"))
def _(spark, sf_dir):
    """Seeded, advanced to what was loaded (never back), and read again."""
    table = control.control_table(spark, work_dir(spark, "q8"))
    table.replace(control.control_seed(spark))
    reached = None
    for entity in _MARKED:
        row = control.loaded_watermark(raw(spark, sf_dir, entity), entity)
        reached = row if reached is None else reached.unionByName(row)
    control.advance_watermarks(table, reached, "run-9", RUN_DAY)
    state = table.read()
    marks = [(e, control.get_watermark(state, e)) for e in (*_MARKED, "invoices", "unknown")]
    return spark.createDataFrame(marks, "entity string, watermark long")


_INGESTED = ("charges", "refunds", "customers")
_SEEN = 850000000


@register("Q7_ingest_by_watermark", o.statement(" ".join(f"raw_{e}" for e in _INGESTED), " UNION ALL ".join(
    f"SELECT '{run}' AS run_id, '{e}' AS entity, count(*) AS n FROM raw_{e} WHERE {kept} HAVING count(*) > 0"
    for e in _INGESTED for run, kept in (("run-1", f"created <= {_SEEN}"), ("run-2", f"created > {_SEEN}")))))
def _(spark, sf_dir):
    """The source gives all it has each time; a run lands what is newer than the watermark that
    the run before it left, and a run without news lands nothing."""
    root = work_dir(spark, "q7")

    def source(entity: str, until: int):
        rows = raw(spark, sf_dir, entity).filter(F.col("created") <= until)
        return lambda mark: nested_payload(rows, flatten.NESTED.get(entity, {}))

    for number, until in ((1, _SEEN), (2, 1 << 40), (3, 1 << 40)):
        run = pipeline.Lake(spark, root, f"run-{number}", AS_OF, entities=_INGESTED, watermark_start="1970-01-01",
                            payloads={e: source(e, until) for e in _INGESTED})
        pipeline.ingest(run)
        pipeline.load_raw(run)
        pipeline.advance(run)
    out = None
    for entity in _INGESTED:
        part = run.raw(entity).read().groupBy(F.col("ingestion_run_id").alias("run_id")).agg(F.count(F.lit(1)).alias("n"))
        part = part.select("run_id", F.lit(entity).alias("entity"), "n")
        out = part if out is None else out.unionByName(part)
    return out


@register("S17_backfill_to_silver", o.whole("stg_charges"))
def _(spark, sf_dir):
    """Three days landed and none loaded; two are taken through the layers, then the third, and
    the first once more."""
    root, charges = work_dir(spark, "s17s"), raw(spark, sf_dir, "charges")
    run = lake(spark, root, "run-s17", entities=("fx_rates", "charges"))
    landing.write_landing(raw(spark, sf_dir, "fx_rates"), root, "fx_rates", "run-a", dt.date(2024, 2, 5))
    one = lake(spark, root, "run-s17", entities=("fx_rates",))
    pipeline.load_raw(one)
    pipeline.build_bronze(one)
    for day in (1, 2, 5):
        landing.write_landing(at_load(charges, day), root, "charges", f"run-{day}", dt.date(2024, 2, day))
    for first, last in ((2, 5), (1, 1), (1, 1)):
        pipeline.backfill(run, "charges", dt.date(2024, 2, first), dt.date(2024, 2, last))
    assert run.raw("charges").read().count() == charges.count()
    return run.silver("stg_charges").read()


_BUILT = {
    "stg_charges": "stg_charges", "stg_refunds": "stg_refunds", "stg_disputes": "stg_disputes",
    "stg_payouts": "stg_payouts", "stg_invoice_line_items": "stg_invoice_line_items",
    "stg_finance_ledger_events": "stg_finance_ledger_events", "stg_customers_history": "stg_customers_history",
    "fct_charges": "fct_charges", "fct_refunds": "fct_refunds", "fct_disputes": "fct_disputes",
    "fct_payouts": "fct_payouts", "fct_transactions": "fct_transactions", "fct_mrr_movements": "fct_mrr_movements",
}
_SUMS = {"stg_charges": "amount_usd", "fct_charges": "net_amount_usd", "fct_transactions": "signed_net_amount_usd",
         "fct_mrr_movements": "mrr_change_usd", "fct_refunds": "signed_amount_usd",
         "fct_disputes": "loss_amount_usd", "fct_payouts": "amount_usd"}


def _built_sql() -> str:
    parts = []
    for table in _BUILT:
        total = f"CAST(sum({_SUMS[table]}) AS DECIMAL(38,2))" if table in _SUMS else "CAST(NULL AS DECIMAL(38,2))"
        parts.append(f"SELECT '{table}' AS table_name, count(*) AS n, {total} AS total_usd FROM {table}")
    return o.statement(" ".join(_BUILT), " UNION ALL ".join(parts))


def lake(spark, root: str, run_id: str, entities: tuple[str, ...] = LANDED) -> pipeline.Lake:
    return pipeline.Lake(spark, root, run_id, AS_OF, grain="year", calendar_start=CALENDAR_START,
                         entities=entities, concurrent_models=8,
                         file_schemas={e: RAW[e] for e in LANDED})


@register("Q10_daily_run", _built_sql())
def _(spark, sf_dir):
    """One daily run, from landing to the advanced watermarks."""
    root = work_dir(spark, "q10")
    for entity in LANDED:
        landing.write_landing(raw(spark, sf_dir, entity), root, entity, "run-a", dt.date(2024, 2, 5))
    pipeline.run_daily(lake(spark, root, "run-a"))
    final = lake(spark, root, "read")
    out = None
    for table in _BUILT:
        df = (final.silver(table) if table in pipeline.SILVER else final.gold(table)).read()
        total = F.sum(_SUMS[table]) if table in _SUMS else F.lit(None)
        part = df.agg(F.count(F.lit(1)).alias("n"), total.cast(T.DecimalType(38, 2)).alias("total_usd"))
        part = part.select(F.lit(table).alias("table_name"), "n", "total_usd")
        out = part if out is None else out.unionByName(part)
    return out
