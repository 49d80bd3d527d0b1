"""De-duplication, lookups, history and alignment: results, and the plans they run as."""

import random

from conftest import plan, ts
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerlake.operators.align import align_to_schema, split_rejects
from ledgerlake.operators.dedup import dedup_latest
from ledgerlake.operators.history import with_next
from ledgerlake.operators.incremental import evolve, since
from ledgerlake.operators.lookup import Lookup, join_large
from ledgerlake.schemas import RAW, struct


def versions(spark, rows):
    return spark.createDataFrame(
        rows, "id string, v int, loaded_at timestamp_ntz, ingestion_run_id string, source_file string")


def test_latest_wins_and_ties_are_settled(spark):
    a, b = ts("2024-01-01"), ts("2024-01-02")
    rows = [("x", 1, a, "r1", "f"), ("x", 2, b, "r1", "f"), ("y", 3, a, "r1", "f"), ("y", 4, a, "r2", "f"),
            ("z", 5, None, "r1", "f"), ("z", 6, a, "r1", "f"), ("t", 7, a, "r1", "f"), ("t", 8, a, "r1", "f")]
    outcomes = set()
    for _ in range(3):
        random.shuffle(rows)
        got = dedup_latest(versions(spark, rows).repartition(5), ["id"])
        outcomes.add(tuple(sorted((r["id"], r["v"]) for r in got.collect())))
    assert len(outcomes) == 1
    kept = dict(outcomes.pop())
    assert (kept["x"], kept["y"], kept["z"]) == (2, 4, 6) and kept["t"] in (7, 8)


def test_hot_key_is_cut_before_the_exchange(spark):
    df = spark.range(0, 90_000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("id"),
        F.col("id").cast("int").alias("v"),
        F.timestamp_add("SECOND", F.col("id"), F.lit("2024-01-01").cast("timestamp_ntz")).alias("loaded_at"))
    got = dedup_latest(df, ["id"])
    text = plan(got)
    assert text.count("WindowGroupLimit") == 2
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")
    assert got.count() == 60_001
    assert got.filter("id = 'hot'").first()["v"] == 89_997


def rates(spark, **options):
    side = spark.createDataFrame([("EUR", 1), ("GBP", 2)], "code string, rate int")
    return Lookup(side, ["code"], **options)


def test_lookup_broadcast_and_salted_agree(spark):
    facts = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 != 0, "EUR").when(F.col("id") % 2 == 0, "GBP")
        .when(F.col("id") % 7 == 0, "XXX").alias("ccy"))
    small, large = rates(spark), rates(spark, limit=0, salts=8)
    assert small.fits and not large.fits and small.size == 2 * (16 + 16) + 6
    a = small.attach(facts, {"code": F.col("ccy")}, {"rate": "r"})
    b = large.attach(facts, {"code": F.col("ccy")}, {"rate": "r"})
    assert "BroadcastHashJoin" in plan(a)
    assert "_salt" in plan(b)
    assert a.columns == b.columns == ["id", "ccy", "r"]
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    assert a.filter("r IS NULL").count() == facts.filter("ccy IS NULL OR ccy = 'XXX'").count()


def test_lookup_bound_needs_no_job(spark):
    assert rates(spark, bytes_bound=10).size == 10


def test_hot_join_key_is_split_at_run_time(spark):
    """A third of the rows on one key, another third without a key."""
    facts = spark.range(0, 300_000, numPartitions=8).select(
        F.col("id").alias("row_id"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.col("id").cast("string")).alias("k"),
        F.sha2(F.col("id").cast("string"), 256).alias("pad"))
    side = spark.range(0, 300_000, numPartitions=4).select(
        F.when(F.col("id") == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("v"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        joined = join_large(facts, side, "k", "k", {"v": "v"}, spread_by="row_id")
        rows = joined.collect()
        assert "skew=true" in plan(joined)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    assert len(rows) == 300_000
    for r in rows[::997]:
        want = {0: 0, 1: r["row_id"], 2: None}[r["row_id"] % 3]
        assert r["v"] == want


def test_sliced_lead_equals_lead(spark):
    rng = random.Random(7)
    rows = {(f"c{rng.randrange(6)}", ts(f"2024-0{rng.randrange(1, 4)}-1{rng.randrange(10)}T0{rng.randrange(10)}:00"))
            for _ in range(400)}
    df = spark.createDataFrame(list(rows), "id string, at timestamp_ntz")
    plain = df.withColumn("nxt", F.lead("at").over(Window.partitionBy("id").orderBy("at")))
    for slice_by in ("hour", "day", "month"):
        got = with_next(df, "id", "at", "nxt", slice_by)
        assert sorted(map(str, got.select("id", "at", "nxt").collect())) == sorted(map(str, plain.collect()))


def test_align(spark):
    df = spark.createDataFrame([("1", "a", 5, "2024-02-01T00:00:00+00:00")], "AMOUNT string, Id string, extra int, loaded_at string")
    got = align_to_schema(df, RAW["payouts"])
    assert got.schema.simpleString() == RAW["payouts"].simpleString()
    row = got.first()
    assert (row["amount"], row["id"], row["load_mode"], row["status"]) == (1, "a", "batch", None)
    assert row["loaded_at"] == ts("2024-02-01")


def test_rejects(spark):
    schema = struct("id string, amount bigint", required=("id",))
    df = spark.createDataFrame([("a", "1"), ("b", "x"), (None, "2"), ("c", None)], "id string, amount string")
    good, bad = split_rejects(df, schema, {})
    assert sorted((r.id, r.amount) for r in good.collect()) == [("a", 1), ("c", None)]
    assert {(r.id, r.error_message) for r in bad.collect()} == {
        ("b", "amount: cannot convert"), (None, "id: missing")}


def test_since(spark):
    df = spark.createDataFrame([(1, ts("2024-01-01")), (2, ts("2024-01-02"))], "id int, loaded_at timestamp_ntz")
    assert since(df, None).count() == 2
    assert since(df, df.filter("id < 0")).count() == 2
    assert [r.id for r in since(df, df.filter("id = 1")).collect()] == [2]


def test_watermark_literal_reaches_the_scan(spark, folder):
    spark.range(100).select(
        "id", F.timestamp_add("DAY", F.col("id"), F.lit("2024-01-01").cast("timestamp_ntz")).alias("loaded_at"),
        F.lit("x").alias("unused")).write.parquet(folder)
    stored = spark.read.parquet(folder)
    text = since(stored, stored.filter("id < 90")).select("id").distinct()._jdf.queryExecution().toString()
    assert "GreaterThan(loaded_at,2024-03-30T00:00)" in text
    assert "ReadSchema: struct<id:bigint,loaded_at:timestamp_ntz>" in text


def test_evolve(spark):
    old = spark.createDataFrame([(1, "a")], "id int, gone string")
    new = spark.createDataFrame([(2, 5)], "id int, added int")
    a, b = evolve(old, new, "append_new_columns")
    assert a.columns == b.columns == ["id", "gone", "added"]
    a, b = evolve(old, new, "sync_all_columns")
    assert a.columns == b.columns == ["id", "added"] and a.unionByName(b).count() == 2


def test_curve_keeps_both_columns_narrow(spark, folder):
    import datetime as dt
    import random

    from ledgerlake.operators.layout import along_curve, curve, overlapping

    rng = random.Random(6)
    rows = [(f"id_{i:06d}", dt.date(2024, 1, 1) + dt.timedelta(rng.randrange(1000)), rng.random()) for i in range(5000)]
    df = spark.createDataFrame(rows + [(None, None, None)], "k string, d date, x double")
    along_curve(df, ["d", "k"], 16).write.parquet(folder)
    stored = spark.read.parquet(folder)
    assert stored.exceptAll(df).isEmpty() and stored.count() == 5001
    for column, value in (("d", dt.date(2025, 3, 3)), ("k", "id_002345")):
        hit, files = overlapping(stored, column, value)
        assert 1 <= hit <= 8 and files == 16
    # With one column the curve is its order.
    ordered = [r.x for r in df.filter("x IS NOT NULL").orderBy(curve(df, ["x"], 30)).select("x").collect()]
    assert max(a - b for a, b in zip(ordered, ordered[1:])) < 1e-8
    assert along_curve(df.limit(0), ["d", "k"], 2).count() == 0
