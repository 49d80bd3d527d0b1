"""Tables, landing, payloads, streams and control."""

import datetime as dt
import threading

import pytest
from conftest import day, epoch, ts
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from ledgerlake.schemas import AUDIT, RAW
from ledgerlake.sources import control, files, flatten, landing
from ledgerlake.sources.tables import Table
from ledgerlake.streaming import loads

ORDER = ("loaded_at",)


def rows(spark, *values):
    return spark.createDataFrame(
        [(k, v, day(d), ts(at)) for k, v, d, at in values], "k string, v int, d date, loaded_at timestamp_ntz")


def content(table):
    return sorted((r.k, r.v) for r in table.read().collect())


def written_files(spark, folder):
    """Files of a table by bucket folder."""
    found = {}
    base = sorted(n for n in files.children(spark, folder) if n.startswith("base="))[-1]
    for bucket in files.children(spark, f"{folder}/{base}"):
        if "=" in bucket:
            found[bucket] = set(files.children(spark, f"{folder}/{base}/{bucket}"))
    return found


def test_upsert(spark, folder):
    table = Table(spark, folder, keys=["k"], buckets=3, cluster_by=("d", "k"))
    first = rows(spark, ("a", 1, "2024-01-05", "2024-02-01"), ("b", 1, "2024-02-05", "2024-02-01"),
                 ("c", 1, "2024-03-05", "2024-02-01"))
    second = rows(spark, ("a", 2, "2024-01-05", "2024-02-02"), ("d", 2, "2024-02-09", "2024-02-02"))
    late = rows(spark, ("a", 0, "2024-01-05", "2024-01-15"), ("e", 0, "2024-01-07", "2024-01-15"))
    moved = rows(spark, ("c", 3, "2024-01-09", "2024-02-03"))
    for batch in (first, second, second, late):
        table.upsert(batch, ORDER)
    assert content(table) == [("a", 2), ("b", 1), ("c", 1), ("d", 2), ("e", 0)]
    table.upsert(moved, ORDER)
    assert content(table) == [("a", 2), ("b", 1), ("c", 3), ("d", 2), ("e", 0)]
    assert table.newest() == ts("2024-02-03")


def test_upsert_opens_only_the_buckets_of_its_keys(spark, folder):
    table = Table(spark, folder, keys=["k"], buckets=16)
    table.upsert(rows(spark, *[(f"k{i}", 1, "2024-01-05", "2024-02-01") for i in range(200)]), ORDER)
    before = written_files(spark, folder)
    assert len(before) == 16
    table.upsert(rows(spark, ("k7", 2, "2024-01-05", "2024-02-02"), ("new", 2, "2024-04-05", "2024-02-02")), ORDER)
    after = written_files(spark, folder)
    assert sum(before[b] != after[b] for b in before) <= 2 and len(content(table)) == 201
    some = table.rows_of(rows(spark, ("k7", 0, "2024-01-05", "2024-02-01")))
    assert [(r.k, r.v) for r in some.collect()] == [("k7", 2)] and len(some.inputFiles()) == 1
    table.upsert(rows(spark).limit(0), ORDER)
    assert written_files(spark, folder) == after


def test_parts_of_dates_that_keys_fix(spark, folder):
    table = Table(spark, folder, keys=["k"], buckets=2, part_by="d")
    table.upsert(rows(spark, ("a", 1, "2024-01-05", "2024-02-01"), ("b", 1, "2024-02-05", "2024-02-01")), ORDER)
    before = written_files(spark, folder)
    table.upsert(rows(spark, ("a", 2, "2024-01-05", "2024-02-02"), ("c", 2, "2024-04-05", "2024-02-02")), ORDER)
    assert content(table) == [("a", 2), ("b", 1), ("c", 2)]
    assert set(written_files(spark, folder)) == {*before, "table_part=2024-04"}


def test_swap_leaves_no_old_rows(spark, folder):
    table = Table(spark, folder, keys=["k"], buckets=4)
    values = [(k, n, "2024-01-05", "2024-02-01") for k in ("a", "b", "c", None) for n in (1, 2, 3)]
    table.replace(rows(spark, *values))
    before = written_files(spark, folder)
    table.swap(spark.createDataFrame([("a",), (None,)], "k string"), rows(spark, ("a", 9, "2024-01-05", "2024-02-02")))
    assert sorted((r.k or "", r.v) for r in table.read().collect()) == [("a", 9), *[(k, n) for k in "bc" for n in (1, 2, 3)]]
    assert sum(before[b] != written_files(spark, folder).get(b) for b in before) <= 2
    table.swap(spark.createDataFrame([(k,) for k in "abc"], "k string"), rows(spark).limit(0))  # whole buckets go
    assert table.read().count() == 0


def test_upsert_order_of_arrival_does_not_matter(spark, folder):
    batches = [rows(spark, *[(f"k{i % 7}", 10 * n + i, f"2024-0{1 + i % 3}-05", f"2024-02-0{n}") for i in range(7)])
               for n in (1, 2, 3)]
    seen = set()
    for n, order in enumerate([(0, 1, 2), (2, 1, 0), (1, 2, 0, 1)]):
        table = Table(spark, f"{folder}/{n}", keys=["k"], buckets=2)
        for i in order:
            table.upsert(batches[i], ORDER)
        seen.add(tuple(content(table)))
    assert len(seen) == 1


def test_schema_changes(spark, folder):
    base = rows(spark, ("a", 1, "2024-01-05", "2024-02-01"), ("b", 1, "2024-02-05", "2024-02-01"))
    table = Table(spark, f"{folder}/appended")
    table.append(base)
    wider = rows(spark, ("c", 1, "2024-02-05", "2024-02-02")).withColumn("w", F.lit("new"))
    table.append(wider)
    assert sorted((r.k, r.w) for r in table.read().collect()) == [("a", None), ("b", None), ("c", "new")]
    table = Table(spark, f"{folder}/keyed", keys=["k"], buckets=8)
    table.upsert(base.unionByName(wider.drop("w")), ORDER)
    narrower = rows(spark, ("b", 2, "2024-02-05", "2024-02-03")).drop("v").withColumn("x", F.lit(7))
    table.upsert(narrower, ORDER)
    got = table.read()
    assert set(got.columns) == {"k", "d", "loaded_at", "x"}
    assert sorted((r.k, r.x) for r in got.collect()) == [("a", None), ("b", 7), ("c", None)]


def test_replayed_batch_is_skipped(spark, folder):
    table = Table(spark, folder)
    batch = rows(spark, ("a", 1, "2024-01-05", "2024-02-01"))
    assert table.append(batch, 1) and not table.append(batch, 1) and table.append(batch, 2)
    assert table.read().count() == 2 and table.rows_written == 1


def test_failed_write_leaves_the_table(spark, folder):
    table = Table(spark, folder)
    table.replace(rows(spark, ("a", 1, "2024-01-05", "2024-02-01")))
    broken = rows(spark, ("b", 1, "2024-01-05", "2024-02-01")).withColumn("v", F.raise_error(F.lit("x")).cast("int"))
    for write in (table.append, table.replace):
        with pytest.raises(Exception):
            write(broken)
        assert content(table) == [("a", 1)]
    table.append(rows(spark, ("c", 1, "2024-01-05", "2024-02-01")))
    assert content(table) == [("a", 1), ("c", 1)]
    keyed = Table(spark, f"{folder}/keyed", keys=["k"], buckets=2)
    keyed.upsert(rows(spark, ("a", 1, "2024-01-05", "2024-02-01")), ORDER)
    with pytest.raises(Exception):
        keyed.upsert(broken, ORDER)
    assert content(keyed) == [("a", 1)]


def test_full_refresh_stands_for_all_before(spark, folder):
    table = Table(spark, folder)
    for v in (1, 2, 3):
        table.append(rows(spark, (f"a{v}", v, "2024-01-05", "2024-02-01")))
    table.replace(rows(spark, ("z", 9, "2024-01-05", "2024-02-01")))
    table.append(rows(spark, ("y", 8, "2024-01-05", "2024-02-01")))
    assert content(table) == [("y", 8), ("z", 9)]
    table.drop_replaced()
    assert content(table) == [("y", 8), ("z", 9)] and len([n for n in files.children(spark, folder) if "=" in n]) == 2


def test_empty_table_keeps_its_schema(spark, folder):
    for n, keys in enumerate(([], ["k"])):
        table = Table(spark, f"{folder}/{n}", keys=keys)
        table.replace(rows(spark).limit(0))
        assert table.read().count() == 0 and table.read().columns == ["k", "v", "d", "loaded_at"]
        assert table.newest() is None and table.rows_written == 0
    table.upsert(rows(spark, ("a", 1, "2024-01-05", "2024-02-01")), ORDER)
    assert content(table) == [("a", 1)]


# --- payloads ---------------------------------------------------------------------------

def payloads(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "payload string")


def test_flatten_charges(spark):
    got = flatten.FLATTENERS["charges"](payloads(
        spark,
        '{"id":"a","amount":5,"paid":true,"payment_method_details":{"type":"card","card":{"brand":"visa","exp_year":2030}}}',
        '{"id":"b","payment_method_details":{"type":"iban"}}', '{"id":"c","payment_method_details":null}', "{broken"))
    rows_ = {r["id"]: r for r in got.collect()}
    assert (rows_["a"]["amount"], rows_["a"]["paid"], rows_["a"]["payment_method_details_card_exp_year"]) == (5, True, 2030)
    assert rows_["b"]["payment_method_details_type"] == "iban" and rows_["b"]["payment_method_details_card_brand"] is None
    assert rows_["c"]["payment_method_details_type"] is None
    assert rows_[None]["raw_payload"] == "{broken"
    wanted = [f for f in RAW["charges"].names if f not in ("source_file", "ingestion_run_id", "load_mode", "loaded_at")]
    assert sorted(got.columns) == sorted(wanted)


def test_flatten_lines(spark):
    got = flatten.flatten_invoice_line_items(payloads(
        spark,
        '{"id":"i1","lines":{"data":[{"id":"l1","amount":1,"period":{"start":10,"end":20},"plan":{"id":"p","interval":"month"},"price":{"id":"x"}},{"id":"l2","plan":null}]}}',
        '{"id":"i2","lines":[{"id":"l3","amount":3}]}', '{"id":"i3","lines":{"data":[]}}', '{"id":"i4"}'))
    rows_ = {r["id"]: r for r in got.collect()}
    assert set(rows_) == {"l1", "l2", "l3"}
    assert (rows_["l1"]["invoice_id"], rows_["l1"]["period_end"], rows_["l1"]["plan_interval"], rows_["l1"]["price_id"]) == (
        "i1", 20, "month", "x")
    assert rows_["l2"]["plan_id"] is None and rows_["l3"]["invoice_id"] == "i2"
    assert '"amount":1' in rows_["l1"]["raw_payload"]


def test_rates_from_quotes(spark):
    df = payloads(spark, '{"rate_date":"2024-01-10","rates":{"USD":1,"EUR":0.8,"JPY":149.123456,"ZERO":0.0,"NONE":null,"BTC":0.0000153}}')
    got = {r.from_currency: r.rate for r in flatten.fx_from_usd_base(df).collect()}
    assert {k: None if v is None else str(v) for k, v in got.items()} == {
        "EUR": "1.250000", "JPY": "0.006706", "ZERO": None, "NONE": None, "BTC": "65359.477124", "USD": "1.000000"}


# --- landing and streams ----------------------------------------------------------------

def refund(id_, amount=1, **kw):
    return {"id": id_, "amount": amount, "created": epoch("2024-01-10T00:00:00"),
            "loaded_at": ts("2024-02-01"), "ingestion_run_id": "r1", **kw}


def test_optional_entity(spark, folder, raw):
    assert landing.read_optional(spark, folder, "refunds", RAW["refunds"]).count() == 0
    landing.write_landing(raw("refunds", [refund("a")]), folder, "refunds", "r1", day("2024-02-01"))
    got = landing.read_optional(spark, folder, "refunds", RAW["refunds"])
    assert got.count() == 1 and "run_id=r1" in got.first()["source_file"]


def test_backfill_reads_only_its_days(spark, folder, raw):
    for n in (1, 2, 3):
        landing.write_landing(raw("refunds", [refund(f"d{n}")]), folder, "refunds", f"r{n}", dt.date(2024, 2, n))
    got = landing.backfill(spark, folder, "refunds", RAW["refunds"], day("2024-02-02"), day("2024-02-03"))
    assert sorted(r.id for r in got.collect()) == ["d2", "d3"]
    assert "PartitionFilters: [" in got._jdf.queryExecution().toString()


def test_load_once_with_rejects(spark, folder, raw):
    target, dead = Table(spark, f"{folder}/raw"), Table(spark, f"{folder}/dead")
    path = landing.entity_path(folder, "refunds")

    def run():
        loads.load_once(spark, path, "refunds", target, f"{folder}/manifest", dead, "r", ts("2024-02-05"))

    run()
    assert target.read().count() == 0 and not dead.exists()
    landing.write_landing(raw("refunds", [refund("a")]), folder, "refunds", "r1", day("2024-02-01"))
    run()
    run()
    assert target.read().count() == 1 and not dead.exists()
    landing.write_landing(raw("refunds", [refund("b"), refund(None), refund(None)]).coalesce(1), folder, "refunds", "r2", day("2024-02-02"))
    run()
    run()
    assert sorted(r.id for r in target.read().collect()) == ["a", "b"]
    letters = dead.read().collect()
    assert len(letters) == 1 and letters[0].error_message == "id: missing" and "run_id=r2" in letters[0].file_path
    assert dead.read().columns == AUDIT["failed_files"].names


def test_files_are_loaded_in_portions_and_once(spark, folder, raw):
    target, path, noted = Table(spark, f"{folder}/raw"), landing.entity_path(folder, "refunds"), []

    def run():
        loads.load_once(spark, path, "refunds", target, f"{folder}/manifest", portion=3, file_schema=RAW["refunds"],
                        note=lambda n, seen: noted.append((n, seen["rows"])))

    for n in range(7):
        landing.write_landing(raw("refunds", [refund(f"a{n}")]).coalesce(1), folder, "refunds", f"r{n}", day(f"2024-02-0{n + 1}"))
    run()
    run()
    assert noted == [(1, 3), (2, 3), (3, 1)] and target.read().count() == 7
    landing.write_landing(raw("refunds", [refund("old")]).coalesce(1), folder, "refunds", "late", day("2023-01-01"))
    run()
    assert target.read().count() == 8 and noted[-1] == (4, 1)
    files.remove(spark, f"{folder}/manifest/load=4")  # as if the run had ended before it was written
    run()
    assert target.read().count() == 8 and len(noted) == 4
    manifest = Table(spark, f"{folder}/manifest").read()
    assert manifest.count() == manifest.select("file").distinct().count() == 8


def test_many_files_are_listed_in_bounded_portions(spark, tmp_path):
    for n in range(120):
        inner = tmp_path / f"day={n % 6}"
        inner.mkdir(exist_ok=True)
        (inner / f"f{n:03d}.parquet").touch()
        (inner / f"_hidden{n}.parquet").touch()
    portions = list(files.listed(spark, str(tmp_path), ".parquet", 50))
    assert [len(p) for p in portions] == [50, 50, 20] and len({f for p in portions for f in p}) == 120


def test_ingest_isolates_failures(spark, folder):
    def fails():
        raise OSError("down")

    landed = landing.ingest_all(spark, {
        "disputes": fails,
        "refunds": lambda: payloads(spark, '{"id":"a","created":5}', '{"id":"b","created":50}'),
        "payouts": lambda: payloads(spark, '{"id":"c","created":5}')}, folder, "r1", ts("2024-02-01"),
        {"refunds": 5, "payouts": 5}, errors=(errors := {}))
    assert landed == {"disputes": -1, "refunds": 1, "payouts": 0} and errors == {"disputes": "down"}
    with pytest.raises(RuntimeError, match="disputes"):
        landing.raise_on_failure(landed)
    got = landing.read_landing(spark, folder, "refunds", RAW["refunds"]).first()
    assert (got.id, got.ingestion_run_id, got.load_mode, got.loaded_at) == ("b", "r1", "batch", ts("2024-02-01"))


def test_a_watermark_does_not_read_payloads_twice(spark, folder):
    calls = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def payload(n):
        calls.add(1)
        return f'{{"id":"a{n}","created":{n},"lines":[{{"id":"l{n}"}},{{"id":"m{n}"}}]}}' if n % 7 else None

    for entity, each in (("refunds", 1), ("invoices", 1), ("invoice_line_items", 2)):
        before = calls.value
        landed = landing.ingest_all(spark, {entity: lambda: spark.range(40).select(payload("id").alias("payload"))},
                                    folder, "r1", ts("2024-02-01"), {entity: 9})
        assert landed == {entity: 26 * each} and calls.value - before == 40
    got = landing.read_landing(spark, folder, "invoice_line_items", RAW["invoice_line_items"])
    assert {(r.invoice_id, r.id) for r in got.collect()} == {
        (f"a{n}", f"{c}{n}") for n in range(10, 40) if n % 7 for c in "lm"}


def test_an_invoice_is_not_read_again_for_each_line(spark):
    calls = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(text):
        calls.add(1)
        return text

    lines = '{"id":"i%d","lines":{"data":[{"id":"a"},{"id":"b"},{"id":"c"}]}}'
    got = flatten.flatten_invoice_line_items(payloads(spark, *(lines % n for n in range(5))).select(seen("payload").alias("payload")))
    assert sorted((r.invoice_id, r.id) for r in got.select("invoice_id", "id").collect()) == [
        (f"i{n}", c) for n in range(5) for c in "abc"]
    assert calls.value == 5
    below = got._jdf.queryExecution().optimizedPlan().toString().split("from_json(ArrayType")[0]
    assert "$.id" not in below


def test_entities_are_landed_together(spark, folder, monkeypatch):
    gate, write = threading.Barrier(2, timeout=60), landing.write_landing

    def meets(rows, root, entity, *rest):
        gate.wait()
        return write(rows, root, entity, *rest)

    monkeypatch.setattr(landing, "write_landing", meets)
    errors = {}
    landed = landing.ingest_all(spark, {
        "refunds": lambda: payloads(spark, '{"id":"a","created":5}', '{"id":"b","created":6}'),
        "invoice_line_items": lambda: payloads(spark, '{"id":"i","created":"never","lines":[]}'),
    }, folder, "r1", ts("2024-02-01"), {"refunds": 5, "invoice_line_items": 5}, errors=errors)
    assert list(landed.items()) == [("refunds", 1), ("invoice_line_items", -1)]
    assert list(errors) == ["invoice_line_items"] and "never" in errors["invoice_line_items"]


def test_payload_of_nested_values(spark):
    df = spark.sql("SELECT array(named_struct('n', 1, 't', CAST(NULL AS STRING)), NULL) AS plain,"
                   " array(named_struct('n', 1.50BD, 's', named_struct('t', 'x')), NULL) AS amounts,"
                   " CAST(NULL AS STRUCT<a: INT>) AS none")
    got = flatten.to_payload(df)
    assert got.first().payload == (
        '{"plain":[{"n":1,"t":null},null],"amounts":[{"n":1.5,"s":{"t":"x"}},null],"none":null}')
    plain = flatten.to_payload(spark.range(1).selectExpr("array(named_struct('n', id)) AS plain"))
    assert "transform(" not in plain._jdf.queryExecution().analyzed().toString()


# --- control ----------------------------------------------------------------------------

def test_watermarks(spark, folder):
    table = control.control_table(spark, folder)
    table.replace(control.control_seed(spark))
    seed = epoch("2020-01-01T00:00:00")
    assert control.get_watermark(table.read(), "charges") == seed
    assert control.get_watermark(table.read(), "nothing") == 0
    loaded = spark.createDataFrame([(epoch("2024-01-10T00:00:00"),), (5,)], "created long")
    old = spark.createDataFrame([(5,)], "created long")
    none = old.limit(0)
    reached = (control.loaded_watermark(loaded, "charges").unionByName(control.loaded_watermark(old, "refunds"))
               .unionByName(control.loaded_watermark(none, "payouts")))
    control.advance_watermarks(table, reached, "run", ts("2024-02-01"))
    state = table.read()
    assert [control.get_watermark(state, e) for e in ("charges", "refunds", "payouts")] == [
        epoch("2024-01-10T00:00:00"), seed, seed]
    assert state.count() == 12
    assert state.filter("entity_name = 'charges'").first()["last_run_status"] == "success"
    assert state.filter("entity_name = 'payouts'").first()["last_run_status"] is None


def test_run_log(spark, folder):
    table = Table(spark, folder)
    for n in range(12):
        at = ts("2024-02-01") + dt.timedelta(minutes=n)
        control.record(table, "pipeline_runs", control.run_entry(spark, f"r{n:02d}", "load", "success", at, at, rows=n))
    last = control.last_runs(table.read())
    assert [r.run_id for r in last.collect()] == [f"r{n:02d}" for n in range(11, 1, -1)]
    assert "TakeOrderedAndProject" in last._jdf.queryExecution().executedPlan().toString()


def test_a_rewrite_shuffles_stored_rows_once(spark, tmp_path, monkeypatch):
    plans = []
    write = DataFrameWriter.parquet

    def parquet(self, path, *rest, **named):
        if "/base=" in path:
            plans.append(self._df._jdf.queryExecution().executedPlan().toString())
        return write(self, path, *rest, **named)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",)}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        table = Table(spark, f"{tmp_path}/t", keys=["k"], buckets=3)
        columns = "k long, v string, loaded_at timestamp_ntz"
        at = [dt.datetime(2024, 2, n) for n in range(1, 5)]
        table.replace(spark.createDataFrame([(i, "old", at[1]) for i in range(40)] + [(None, "old", at[1])], columns))
        plans.clear()
        table.upsert(spark.createDataFrame([(1, "late", at[0])] * 50 + [(2, "new", at[2]), (2, "newer", at[3]),
                                            (None, "new", at[2]), (70, "new", at[2])], columns), ("loaded_at",))
        table.swap(spark.createDataFrame([(3,), (None,), (99,)], "k long"),
                   spark.createDataFrame([(3, "a", at[3]), (3, "b", at[3]), (5, "c", at[3])], columns))
    finally:
        for name, value in kept.items():
            spark.conf.set(name, value)
    found = sorted((-1 if r.k is None else r.k, r.v) for r in table.read().collect())
    changed = {2: ["newer"], 3: ["a", "b"], 5: ["c"], 70: ["new"]}
    assert found == sorted((k, v) for k in [*range(40), 70] for v in changed.get(k, ["old"]))
    assert [plan.count("Exchange") for plan in plans] == [1, 1]
