"""What was committed, not when rows say they were loaded; compaction; clean-up."""

import datetime as dt

from conftest import plan, ts
from pyspark.sql import functions as F

import catalog
from catalog.storage import LANDED, lake
from ledgerlake.plans import gold, pipeline
from ledgerlake.session import work_dir
from ledgerlake.sources import files, landing
from ledgerlake.sources.tables import Table

SF = "/root/testdata/sf0.001"


def rows(spark, *values):
    return spark.createDataFrame([(k, v, ts(at)) for k, v, at in values], "k string, v int, loaded_at timestamp_ntz")


def keys(df):
    return sorted(r.k for r in df.collect())


def test_loads_know_no_load_times(spark, folder):
    table = Table(spark, folder)
    table.append(rows(spark, ("a", 1, "2024-02-02")))
    first, one = table.loaded_since(-1)
    assert keys(first) == ["a"]
    table.append(rows(spark, ("b", 1, "2024-02-02")))  # the same time
    table.append(rows(spark, ("c", 1, "2024-01-01")))  # an older one
    new, two = table.loaded_since(one)
    assert keys(new) == ["b", "c"] and two > one
    assert table.loaded_since(two) == (None, two)


def test_batches_are_taken_once(spark, folder):
    target = Table(spark, folder)
    for number in (1, 1, 2, 1):
        target.append(rows(spark, (f"n{number}", 1, "2024-02-01")), number)
    assert keys(target.read()) == ["n1", "n2"] and target.applied() == 2
    merged = Table(spark, f"{folder}/upsert", keys=["k"])
    for number, value in ((1, 1), (2, 2), (2, 9)):
        merged.upsert(rows(spark, ("a", value, "2024-02-01")), ("loaded_at",), batch=number)
    assert [r.v for r in merged.read().collect()] == [2] and merged.applied() == 2
    merged.took(7, "other")
    assert merged.applied("other") == 7 and merged.applied() == 2 and merged.applied("none") == -1


def test_single_loads_are_rewritten_together_once(spark, folder):
    table = Table(spark, folder)
    for n in range(40):
        table.append(rows(spark, (f"k{n:02d}", n, "2024-02-01")))
        table.compact(fan=4)
        table.drop_replaced()
    assert keys(table.read()) == [f"k{n:02d}" for n in range(40)]
    names = [n for n in files.children(spark, folder) if "=" in n]
    assert len(names) == 10 and all("-" in n for n in names)


def test_compaction_repeats_no_rows_to_a_reader(spark, folder):
    table, seen, mark = Table(spark, folder), [], -1
    for n in range(20):
        table.append(rows(spark, (f"k{n:02d}", n, "2024-02-01")))
        if n % 3 == 0:
            new, mark = table.loaded_since(mark)
            seen += keys(new)
        table.compact(mark, fan=3)
    new, mark = table.loaded_since(mark)
    seen += keys(new)
    assert seen == [f"k{n:02d}" for n in range(20)]


def test_late_and_equal_files_reach_silver(spark):
    """Land a, build; then b with the same stamp and c with an older one; every layer has all."""
    root = work_dir(spark, "late")
    run = lake(spark, root, "r", entities=("fx_rates", "payouts"))
    landing.write_landing(catalog.raw(spark, SF, "fx_rates"), root, "fx_rates", "r", dt.date(2024, 2, 5))
    payouts = catalog.raw(spark, SF, "payouts").withColumn("part", F.pmod(F.xxhash64("id"), F.lit(3)))
    for part, stamp in ((0, "2024-02-02"), (1, "2024-02-02"), (2, "2024-01-15")):
        chosen = payouts.filter(F.col("part") == part).drop("part")
        landing.write_landing(chosen.withColumn("loaded_at", F.lit(ts(stamp)).cast("timestamp_ntz")),
                              root, "payouts", f"run-{part}", dt.date(2024, 2, 5))
        pipeline.load_raw(run)
        pipeline.build_bronze(run)
        pipeline.build_silver(run, ["stg_payouts"])
    pipeline.build_bronze(run)  # nothing new: nothing appended
    total = payouts.count()
    assert run.raw("payouts").read().count() == run.bronze("payouts").read().count() == total
    assert run.silver("stg_payouts").read().count() == payouts.select("id").distinct().count()


def test_failed_upsert_leaves_no_staging(spark, folder, monkeypatch):
    from ledgerlake.sources import tables

    table = Table(spark, folder, keys=["k"])
    day = rows(spark, ("a", 1, "2024-02-01"))
    table.upsert(day, ("loaded_at",))
    staged = f"{folder}-staging"
    monkeypatch.setattr(tables, "work_dir", lambda spark, purpose: staged)
    monkeypatch.setattr(Table, "_write", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    try:
        table.upsert(day, ("loaded_at",))
    except RuntimeError:
        pass
    assert not files.exists(spark, staged)


def test_currencies_need_no_join(spark):
    rates = catalog.warehouse(spark, SF).bronze("fx_rates")
    assert "NestedLoop" not in plan(gold.dim_currencies(rates, dt.date(2024, 3, 1)))


def test_backfill_opens_the_chosen_days_only(spark, folder):
    payouts = catalog.raw(spark, SF, "payouts")
    for day in (1, 2, 3):
        landing.write_landing(payouts.limit(day), folder, "payouts", f"run-{day}", dt.date(2024, 2, day))
    found = landing.backfill(spark, folder, "payouts", payouts.schema, dt.date(2024, 2, 2), dt.date(2024, 2, 9))
    assert found.count() == 5 and not any("day=01" in f for f in found.inputFiles())
    assert landing.backfill(spark, folder, "payouts", payouts.schema, dt.date(2023, 1, 1), dt.date(2023, 1, 2)).count() == 0


def test_run_records_freshness_and_whole_errors(spark, folder):
    run = lake(spark, folder, "r")
    landing.write_landing(catalog.raw(spark, SF, "charges"), folder, "charges", "r", dt.date(2024, 2, 5))
    run.raw("charges").append(catalog.raw(spark, SF, "charges"))
    one = lake(spark, folder, "r", entities=("charges",))
    pipeline.record_freshness(one)
    kept = one.audit("source_freshness").read().collect()
    assert [(r.source, r.run_id) for r in kept] == [("charges", "r")]
    assert kept[0].max_loaded_at == catalog.raw(spark, SF, "charges").agg(F.max("loaded_at")).first()[0]


def buckets_of(run, name):
    folder = run.gold(name).path
    base = [n for n in files.children(run.spark, folder) if n.startswith("base=")][-1]
    return {b: files.children(run.spark, f"{folder}/{base}/{b}") for b in files.children(run.spark, f"{folder}/{base}") if "=" in b}


def build(run):
    for step in (pipeline.load_raw, pipeline.build_bronze, pipeline.build_silver, pipeline.build_gold):
        step(run)


def test_increments_equal_the_whole_and_write_little(spark):
    """A changed charge with its refunds, a new customer version, and nothing at all."""
    from catalog.increments import two_steps
    from ledgerlake.plans.increments import FACTS

    run = two_steps(spark, SF)
    two_steps.cache_clear()  # the lake is changed below
    before = {f: buckets_of(run, f) for f in FACTS}
    build(run)
    assert before == {f: buckets_of(run, f) for f in FACTS}  # nothing came, nothing was written
    refund = run.silver("stg_refunds").read().orderBy("refund_id").first()
    charge = catalog.raw(spark, SF, "charges").filter(F.col("id") == refund.charge_id).orderBy("loaded_at").limit(1)
    moved = charge.withColumns({"loaded_at": F.lit(ts("2024-02-20")).cast("timestamp_ntz"), "amount": F.col("amount") + 100,
                                "raw_payload": F.regexp_replace("raw_payload", '"customer":"[^"]*"', '"customer":"cus_new"')})
    landing.write_landing(moved, run.root, "charges", "run-c", dt.date(2024, 2, 20))
    buyer = run.gold("fct_charges").read().filter("customer_key IS NOT NULL").orderBy("charge_id").first().customer_id
    again = catalog.raw(spark, SF, "customers").filter(F.col("id") == buyer).orderBy("loaded_at").limit(1)
    landing.write_landing(again.withColumn("loaded_at", F.lit(ts("2024-02-20")).cast("timestamp_ntz")),
                          run.root, "customers", "run-c", dt.date(2024, 2, 20))
    build(run)
    after = {f: buckets_of(run, f) for f in FACTS}
    assert after["fct_payouts"] == before["fct_payouts"] and after["fct_mrr_movements"] == before["fct_mrr_movements"]
    assert after["fct_charges"] != before["fct_charges"] and after["fct_refunds"] != before["fct_refunds"]
    facts = {f: run.gold(f).read() for f in FACTS}
    kept = {f: sorted(map(str, df.collect())) for f, df in facts.items()}
    assert any("cus_new" in r for r in kept["fct_refunds"])
    pipeline.build_gold(run, whole=True)
    for f, rows_ in kept.items():
        assert sorted(map(str, run.gold(f).read().collect())) == rows_, f


def test_one_changed_fact_rewrites_one_bucket(spark, folder):
    run = lake(spark, folder, "r")
    for entity in LANDED:
        landing.write_landing(catalog.raw(spark, SF, entity), folder, entity, "run-a", dt.date(2024, 2, 5))
    build(run)
    before = {f: buckets_of(run, f) for f in ("fct_payouts", "fct_charges")}
    one = catalog.raw(spark, SF, "payouts").orderBy("id").limit(1).withColumn("loaded_at", F.lit(ts("2024-03-01")).cast("timestamp_ntz"))
    landing.write_landing(one, folder, "payouts", "run-b", dt.date(2024, 3, 1))
    build(run)
    after = {f: buckets_of(run, f) for f in before}
    assert sum(before["fct_payouts"][b] != after["fct_payouts"].get(b) for b in before["fct_payouts"]) == 1
    assert before["fct_charges"] == after["fct_charges"]


def test_a_late_refund_changes_the_partial_of_one_day(spark, folder):
    run = lake(spark, folder, "r")
    for entity in LANDED:
        landing.write_landing(catalog.raw(spark, SF, entity), folder, entity, "run-a", dt.date(2024, 2, 5))
    build(run)
    table = run.daily("fct_refunds")
    before = {r.day: str(r) for r in table.read().orderBy("day", "reason", "days_since_charge").collect()}
    late = catalog.raw(spark, SF, "refunds").orderBy("id").limit(1).withColumns({
        "id": F.lit("late"), "loaded_at": F.lit(ts("2024-03-01")).cast("timestamp_ntz")})
    landing.write_landing(late, folder, "refunds", "run-b", dt.date(2024, 3, 1))
    day = late.select(F.to_date(F.timestamp_seconds("created")).alias("day")).first().day
    build(run)
    rows_ = table.read().orderBy("day", "reason", "days_since_charge").collect()
    assert sum(r.n for r in rows_ if r.day == day) == 1 + run.gold("fct_refunds").read().filter(
        (F.col("created_date") == F.lit(day)) & (F.col("refund_id") != "late")).count()
    after = {r.day: str(r) for r in rows_}
    assert {d for d in after if after[d] != before.get(d)} <= {day}


def test_latest_wins_reads_few_columns(spark, folder):
    """Two columns of the last versions: keys, order and the stored hash beside them."""
    from ledgerlake.operators.dedup import dedup_latest, latest_values, with_row_hash

    table = Table(spark, folder)
    table.append(with_row_hash(catalog.raw(spark, SF, "charges")))
    for latest in (dedup_latest(table.read(), ["id"]).select("id", "amount"),
                   latest_values(table.read(), ["id"], ["amount"])):
        scan = latest._jdf.queryExecution().sparkPlan().collectLeaves().head()
        assert scan.requiredSchema().size() <= 6
    whole = dedup_latest(table.read(), ["id"]).select("id", "amount", "status")
    assert whole.exceptAll(latest_values(table.read(), ["id"], ["amount", "status"])).isEmpty()


def many_keys(spark, count):
    return spark.range(count).select(F.concat(F.lit("key-"), F.col("id").cast("string")).alias("k"))


def test_many_keys_of_a_semi_join_are_not_sent_to_the_driver(spark, folder):
    """Files of keys are small, the hash table that the driver builds of them is not."""
    from ledgerlake.operators.lookup import noted, semi_join
    from ledgerlake.session import materialize

    facts = materialize(many_keys(spark, 300_000), f"{folder}/facts")
    many, few = materialize(many_keys(spark, 200_000), f"{folder}/many"), materialize(many_keys(spark, 2_000), f"{folder}/few")
    found = semi_join(facts, many, {"k": "k"}, different=True)
    assert "BroadcastHashJoin" not in plan(found) and found.count() == 200_000
    found = semi_join(facts, few, {"k": "k"}, different=True)
    assert "BroadcastHashJoin" in plan(found) and found.count() == 2_000
    assert "BroadcastHashJoin" not in plan(semi_join(facts, noted(few, 1 << 40), {"k": "k"}, different=True))


def test_sets_of_keys_are_measured_while_they_are_written(spark, folder):
    from ledgerlake.operators import lookup
    from ledgerlake.plans.increments import Sources

    sources = Sources(*[None] * 8, folder)
    keys_ = sources.ids([many_keys(spark, 100), many_keys(spark, 50)], "id")
    assert lookup._NOTED[keys_] == keys_.agg(F.sum(lookup.width(keys_))).first()[0] > 0
    assert lookup._NOTED[sources.ids([many_keys(spark, 0)], "id")] == 0


def test_shuffle_files_go_with_their_query(spark, folder):
    import time

    stored = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        found = stored.getAllFiles().iterator()
        names = []
        while found.hasNext():
            names.append(found.next().getName())
        return {n for n in names if n.startswith("shuffle_")}

    before = shuffles()
    kept = many_keys(spark, 1000).groupBy(F.substring("k", -1, 1).alias("last")).count()
    kept.write.parquet(folder)
    until = time.monotonic() + 20
    while shuffles() - before and time.monotonic() < until:
        time.sleep(0.2)
    assert not shuffles() - before
    assert kept.count() == 10 == len(kept.collect()) == len(kept.collect())  # what is asked for again is there


def test_models_at_once_follow_the_cores(spark, folder):
    import threading
    import time

    run, lock, now, most = lake(spark, folder, "r"), threading.Lock(), [], []

    def work(name):
        with lock:
            now.append(name)
            most.append(len(now))
        time.sleep(0.1)
        with lock:
            now.remove(name)
        return name.upper()

    assert run.in_parallel(work, "abcdefghij") == list("ABCDEFGHIJ")
    assert max(most) <= max(2, spark.sparkContext.defaultParallelism // 3)


def test_written_rows_are_swapped_without_a_copy(spark, folder, monkeypatch):
    from ledgerlake.session import materialize
    from ledgerlake.sources import tables

    table = Table(spark, f"{folder}/t", keys=["k"])
    table.replace(rows(spark, ("a", 1, "2024-02-01"), ("b", 1, "2024-02-01"), ("c", 1, "2024-02-01")))
    new = materialize(rows(spark, ("a", 2, "2024-02-02")), f"{folder}/new")
    gone = materialize(rows(spark, ("a", 0, "2024-02-02"), ("b", 0, "2024-02-02")).select("k"), f"{folder}/gone")
    monkeypatch.setattr(tables, "materialize", lambda *a: (_ for _ in ()).throw(RuntimeError("copied")))
    table.swap(gone, new, written=True)
    assert sorted((r.k, r.v) for r in table.read().collect()) == [("a", 2), ("c", 1)]


def test_large_rewrites_go_bucket_by_bucket(spark, folder, monkeypatch):
    """The same rows, whatever is rewritten at once; NULL is a key, and one that goes leaves no folder."""
    from ledgerlake.sources import tables

    def run(path, portion):
        monkeypatch.setattr(tables, "PORTION", portion)
        table, writes, write = Table(spark, path, keys=["k"], buckets=5), [], Table._write
        monkeypatch.setattr(Table, "_write", lambda *a: (writes.append(a[2]), write(*a)))
        table.upsert(rows(spark, *((f"k{n}", n, "2024-02-01") for n in range(30)), (None, 1, "2024-02-01")), ("loaded_at",))
        table.upsert(rows(spark, *((f"k{n}", -n, "2024-02-02") for n in range(20, 40)), ("k1", 9, "2024-01-01"),
                          (None, 2, "2024-02-02")), ("loaded_at",))
        rewritten = table.rows_written
        table.swap(rows(spark, *((f"k{n}", 0, "2024-02-01") for n in range(35))).select("k"),
                   rows(spark, ("k3", 3, "2024-02-03"), (None, 3, "2024-02-03")))
        monkeypatch.setattr(Table, "_write", write)
        return sorted((str(r.k), r.v) for r in table.read().collect()), rewritten, len(writes)

    whole, first, one = run(f"{folder}/whole", 1 << 30)
    parted, second, many = run(f"{folder}/parted", 1)
    assert whole == parted == sorted([("None", 3), ("k3", 3), *((f"k{n}", -n) for n in range(35, 40))])
    assert first == second > 0 and one == 3 and many > 6
