"""What the operators share: work tables, batch sizes, ragged array helpers."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.session import materialize, work_dir
from ledgerlake.sources import files

#: Rows that cross to Python at once; with whole documents a batch stays within a few MB.
BATCH_ROWS = 1000
#: A batch of very long texts is worked off in runs of about so many characters.
RUN_CHARS = 1 << 19


def prepare(spark: SparkSession) -> SparkSession:
    """Small Arrow batches: a Python worker then holds a few MB of text at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settle(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` once to the cluster's shared folder and read it back.

    Four tasks for each core write it at most: after a shuffle of small rows the many partitions
    of the session would each write a file of a few rows.
    """
    most = 4 * df.sparkSession.sparkContext.defaultParallelism
    return materialize(df.coalesce(most), work_dir(df.sparkSession, purpose))


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The same by as many tasks as ``df`` has, for what is read from files or large throughout."""
    return materialize(df, work_dir(df.sparkSession, purpose))


def settled(df: DataFrame, purpose: str) -> tuple[DataFrame, Callable[[], None]]:
    """As ``settle``, with a function that removes the table when nothing reads it any more."""
    path = work_dir(df.sparkSession, purpose)
    most = 4 * df.sparkSession.sparkContext.defaultParallelism
    return materialize(df.coalesce(most), path), lambda: files.remove(df.sparkSession, path)


def lean(work):
    """``work`` on batches, after which the Python worker gives its free memory back: Spark keeps
    workers for later tasks, and what they once held adds to the executor's memory."""

    def run(batches):
        try:
            yield from work(batches)
        finally:
            _give_back()

    return run


def _give_back() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries do it by themselves
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def rows_of(df: DataFrame) -> int:
    return df.agg(F.count(F.lit(1))).first()[0]


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` does not have, one for each of ``names``."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def with_fields(df: DataFrame, **kinds: str) -> T.StructType:
    """The schema of ``df`` followed by new fields, given as name and type."""
    return T.StructType([*df.schema.fields, *(
        T.StructField(name, T._parse_datatype_string(kind)) for name, kind in kinds.items())])


def texts_of(column: pa.Array) -> list[str]:
    """The texts of an Arrow column; null is the empty text."""
    return ["" if t is None else t for t in column.to_pylist()]


def bytes_of(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def runs(sizes: list[int], most: int = RUN_CHARS) -> Iterator[tuple[int, int]]:
    """Split ``range(len(sizes))`` into consecutive runs of about ``most`` in sum."""
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if total and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of the concatenated ranges ``starts[i] : starts[i] + lengths[i]``."""
    ends = np.cumsum(lengths)
    out = np.arange(ends[-1] if len(ends) else 0, dtype=np.int64)
    return out + np.repeat(starts - (ends - lengths), lengths)


def sorted_lookup(known: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Position of each wanted value in the sorted ``known``, or -1."""
    if not len(known):
        return np.full(len(wanted), -1, dtype=np.int64)
    at = np.searchsorted(known, wanted)
    at[at == len(known)] = 0
    return np.where(known[at] == wanted, at, -1)


def identified(docs: DataFrame, key: str, text: str, rid: str) -> DataFrame:
    """``docs`` with a row identity beside the key: rows with the same key, null included, are
    one document only if their texts are equal too."""
    return docs.withColumn(rid, F.xxhash64(F.col(text), F.col(key).cast("string")))


def same_row(left: DataFrame, right: DataFrame, key: str, rid: str):
    """Join condition on identity; ``right`` names its columns ``r_key`` and ``r_rid``."""
    return (left[rid] == right["r_rid"]) & left[key].eqNullSafe(right["r_key"])


#: Rows, and bytes of them, up to which a written table is sent to every task.
BROADCAST_ROWS, BROADCAST_BYTES = 1_000_000, 64 << 20


def sized(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """A written table of narrow rows, to be broadcast if it has ``most`` rows at most and its columns
    take ``BROADCAST_BYTES`` at most, both measured, and else to be joined by a shuffle."""
    width = F.lit(0).cast("long")
    for field in df.schema.fields:
        width = width + 16
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(field.name), F.lit(0))
        elif isinstance(field.dataType, T.ArrayType):
            width = width + 32 * F.coalesce(F.size(field.name), F.lit(0))
    rows, size = df.agg(F.count(F.lit(1)), F.sum(width)).first()
    return F.broadcast(df) if rows <= most and (size or 0) <= BROADCAST_BYTES else df
