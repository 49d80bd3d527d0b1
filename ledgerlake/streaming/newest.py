"""The newest row of each key of a stream, by state kept for each key.

The state of a key is the order of its newest row so far: load time, run, file, hash of the row. A
row passes only if it is newer, so that late, equal and replayed rows never reach the table that
is upserted from the stream. The keys of a slice (by hash) share one state value, as each access to
the state is a round trip between Python and Spark, which took milliseconds for each key. Keys
without a new row for a while are let go; should an old version come after that, it passes, and the
upsert holds it against the stored row. No watermark is set, as one would drop rows that are later
than it.
"""

from __future__ import annotations

import datetime as dt
import sys
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from ledgerlake.operators.dedup import LOAD_ORDER, ROW_HASH

# What runs in tasks is shipped by value: executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: The order of a row as text, which sorts as it does; the state holds it beside the key.
#: Names with a leading underscore would be lost on the way to the state function.
KEY, ORDER, ROW, SLICE = "key_text", "order_text", "whole_row", "key_slice"
#: Slices that the keys of a stream are dealt over; fixed for the life of a checkpoint.
SLICES = 4096
TIMES = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def order_text(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """``df`` with its order as one text. NULL comes before all else."""
    parts = []
    for c in (*order, ROW_HASH):
        kind = df.schema[c].dataType
        value = F.col(c)
        if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            value = F.date_format(value.cast("timestamp_ntz"), "yyyyMMddHHmmssSSSSSS")
        elif isinstance(kind, (T.LongType, T.IntegerType)):  # shifted to be non-negative, with leading zeros
            value = F.lpad((value.cast("decimal(20,0)") + F.lit(str(1 << 63)).cast("decimal(20,0)")).cast("string"), 20, "0")
        elif not isinstance(kind, T.StringType):
            raise ValueError(f"cannot order by {c}: {kind.simpleString()}")
        parts.append(F.coalesce(F.concat(F.lit("\x02"), value), F.lit("\x01")))
    return df.withColumn(ORDER, F.concat_ws("\x00", *parts))


def _thinned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The newest row of each key in each batch, so that few rows of a hot key are shuffled."""
    for batch in batches:
        found: dict[str, tuple[str, int]] = {}
        for place, (key, order) in enumerate(zip(batch.column(KEY).to_pylist(), batch.column(ORDER).to_pylist())):
            if order > found.get(key, ("", 0))[0]:
                found[key] = order, place
        yield batch.take(pa.array(sorted(place for _, place in found.values()), pa.int64()))


class Newest(StatefulProcessor):
    def __init__(self, keep: dt.timedelta):
        self.keep = int(keep.total_seconds() * 1000)

    def init(self, handle) -> None:
        # A slice that nothing passed in for as long holds no key that still counts.
        self.slice = handle.getValueState(
            "newest", "keys array<string>, newest array<string>, passed array<bigint>", ttlDurationMs=self.keep)

    def handleInputRows(self, key, rows, timerValues):
        newest: dict[str, tuple[str, str]] = {}
        for frame in rows:
            for name, order, row in zip(frame[KEY], frame[ORDER], frame[ROW]):
                if name not in newest or order > newest[name][0]:
                    newest[name] = order, row
        now = timerValues.getCurrentProcessingTimeInMs()
        seen = {name: (order, at) for name, order, at in zip(*(self.slice.get() or ((), (), ())))
                if at + self.keep > now}
        passed = {name: order for name, (order, _) in newest.items() if name not in seen or order > seen[name][0]}
        if passed:
            seen |= {name: (order, now) for name, order in passed.items()}
            self.slice.update((list(seen), [order for order, _ in seen.values()], [at for _, at in seen.values()]))
            yield pd.DataFrame({ROW: [newest[name][1] for name in passed]})

    def close(self) -> None:
        pass


def newest_rows(stream: DataFrame, keys: Sequence[str], order: Sequence[str] = LOAD_ORDER,
                keep: dt.timedelta = dt.timedelta(days=400)) -> DataFrame:
    """The rows of a stream that are newer than all before of their key. They hold a ``row_hash``.

    NULL keys are one key. Of equal rows the first passes.
    """
    stream.sparkSession.conf.set(STATE_STORE, ROCKSDB)
    # State that runs out asks for batches without data for ever; a run on what is there must end.
    stream.sparkSession.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    ordered = order_text(stream, order)
    # Rows travel as JSON text, in which numbers, decimals and times stay what they are.
    packed = ordered.select(
        F.pmod(F.xxhash64(*keys), F.lit(SLICES)).alias(SLICE), F.to_json(F.struct(*keys), TIMES).alias(KEY),
        ORDER, F.to_json(F.struct(*stream.columns), TIMES).alias(ROW))
    thin = packed.mapInArrow(_thinned, packed.schema)
    passed = thin.groupBy(SLICE).transformWithStateInPandas(
        statefulProcessor=Newest(keep), outputStructType=f"{ROW} string", outputMode="Append", timeMode="ProcessingTime")
    return passed.select(F.from_json(ROW, stream.schema, TIMES).alias("r")).select("r.*")
