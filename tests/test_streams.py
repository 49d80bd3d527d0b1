"""Keyed state of streams: what passes, whatever the order of arrival, across restarts."""

import datetime as dt
import random
from decimal import Decimal

import pandas as pd
from conftest import ts

from ledgerlake.operators.dedup import dedup_latest, with_row_hash
from ledgerlake.session import work_dir
from ledgerlake.sources.tables import Table
from ledgerlake.streaming import loads
from ledgerlake.streaming import newest as newest_module
from ledgerlake.streaming.newest import KEY, ORDER, ROW, Newest, newest_rows, order_text

SCHEMA = "k string, v int, m decimal(18,2), t timestamp, loaded_at timestamp_ntz, ingestion_run_id string, source_file string"


def row(k, v, at, run="r", file="f"):
    return k, v, Decimal("1.25") if v else None, dt.datetime(2024, 1, 1, 0, 0, 0, 7) if v else None, ts(at), run, file


def test_order_text_sorts_as_the_columns_do(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["a", "b"]), 1, None, None, rng.choice([None, ts("2024-02-01"), ts("2024-02-01T00:00:00.000007"), ts("1969-01-01")]),
             rng.choice([None, "", "r", "r2", "q"]), rng.choice([None, "f", "f\x01"])) for _ in range(200)]
    df = order_text(with_row_hash(spark.createDataFrame(rows, SCHEMA)), ("loaded_at", "ingestion_run_id", "source_file"))
    got = df.collect()
    least = (False, 0.0)
    known = [((least if r.loaded_at is None else (True, r.loaded_at.timestamp()), (r.ingestion_run_id is not None, r.ingestion_run_id or ""),
               (r.source_file is not None, r.source_file or ""), r.row_hash), r[ORDER]) for r in got]
    assert [o for _, o in sorted(known)] == sorted(o for _, o in known)


def upserted(spark, batches, folder):
    """The table after streams over the batches, each a run of its own from the checkpoint."""
    table, taken = Table(spark, f"{folder}/table", keys=["k"], buckets=2), []
    for n, batch in enumerate(batches):
        spark.createDataFrame(batch, SCHEMA).write.parquet(f"{folder}/in/{n:03d}")
        stream = spark.readStream.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(f"{folder}/in")

        def model(rows):
            taken.append(rows.count())
            return rows

        loads.stream_upsert(stream, model, table, f"{folder}/checkpoint", newest_by=["k"])
    return table.read(), taken


def test_late_equal_and_replayed_rows_leave_the_batch_result(spark):
    batches = [
        [row("a", 1, "2024-02-02"), row("b", 1, "2024-02-02"), row(None, 0, "2024-02-01")],
        [row("a", 0, "2024-02-01"), row("b", 2, "2024-02-02", "s"), row("a", 1, "2024-02-02")],  # late, equal time, replayed
        [row("a", 3, "2024-02-03"), row("a", 4, "2024-02-04"), row("c", 0, "2024-01-01"), row(None, 0, "2024-01-01")],
    ]
    every = [r for b in batches for r in b]
    wanted = sorted(map(str, dedup_latest(with_row_hash(spark.createDataFrame(every, SCHEMA)), ["k"]).collect()))
    for n, order in enumerate(((0, 1, 2), (2, 1, 0))):
        got, taken = upserted(spark, [batches[i] for i in order], work_dir(spark, f"stream-{n}"))
        assert sorted(map(str, got.collect())) == wanted
        if order == (0, 1, 2):
            assert taken == [3, 1, 2]  # of what came late or again, nothing reached the table


def test_rows_pass_unchanged(spark, folder):
    rows = [row(f"k{i}", i, f"2024-02-{1 + i % 28:02d}T00:00:00.{i:06d}") for i in range(60)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/in")
    stream = with_row_hash(spark.readStream.schema(SCHEMA).parquet(f"{folder}/in"))
    got = []
    query = newest_rows(stream, ["k"]).writeStream.foreachBatch(lambda b, n: got.extend(b.collect())) \
        .option("checkpointLocation", f"{folder}/cp").trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted(map(str, got)) == sorted(map(str, with_row_hash(spark.createDataFrame(rows, SCHEMA)).collect()))


class Times:
    def __init__(self, now):
        self.now = now

    def getCurrentProcessingTimeInMs(self):
        return self.now


class Handle:
    """State of one slice, which counts how often it is asked."""

    def __init__(self):
        self.value, self.asked = None, 0

    def getValueState(self, name, schema, ttlDurationMs=None):
        return self

    def exists(self):
        self.asked += 1
        return self.value is not None

    def get(self):
        self.asked += 1
        return self.value

    def update(self, value):
        self.asked += 1
        self.value = value


def slice_of(*rows):
    return iter([pd.DataFrame(rows, columns=[KEY, ORDER, ROW])])


def passed(found):
    return sorted(r for frame in found for r in frame[ROW])


def test_keys_of_a_slice_cost_one_access_to_the_state():
    handle, newest = Handle(), Newest(dt.timedelta(days=1))
    newest.init(handle)
    rows = [(f"k{i}", "2", f"row {i}") for i in range(500)]
    assert passed(newest.handleInputRows((0,), slice_of(*rows), Times(1000))) == sorted(r for _, _, r in rows)
    assert handle.asked <= 3
    late = [(f"k{i}", "1", "late") for i in range(500)] + [("k7", "3", "new"), ("k8", "2", "again")]
    assert passed(newest.handleInputRows((0,), slice_of(*late), Times(2000))) == ["new"]


def test_keys_are_let_go_one_by_one():
    handle, newest = Handle(), Newest(dt.timedelta(seconds=1))
    newest.init(handle)
    passed(newest.handleInputRows((0,), slice_of(("a", "2", "a2"), ("b", "2", "b2")), Times(0)))
    assert passed(newest.handleInputRows((0,), slice_of(("b", "3", "b3")), Times(600))) == ["b3"]
    # 'a' passed last at 0 and is forgotten, 'b' at 600 and is not.
    assert passed(newest.handleInputRows((0,), slice_of(("a", "1", "a1"), ("b", "1", "b1")), Times(1200))) == ["a1"]


def test_slices_are_fewer_than_keys(spark, folder, monkeypatch):
    monkeypatch.setattr(newest_module, "SLICES", 2)  # keys that share a slice, null and texts like numbers among them
    batches = [[row(k, 1, "2024-02-02") for k in ("a", "b", "1", "", None, 'q"', "null")],
               [row("a", 2, "2024-02-01"), row("b", 2, "2024-02-03"), row(None, 2, "2024-02-01"), row("null", 2, "2024-02-04")]]
    got, taken = upserted(spark, batches, folder)
    assert taken == [7, 2]
    assert {r.k: r.v for r in got.collect()} == {"a": 1, "b": 2, "1": 1, "": 1, None: 1, 'q"': 1, "null": 2}
