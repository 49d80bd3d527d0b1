"""Left joins from a large table to a keyed side table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import cached_property
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024
#: Keys of a semi join take several times their bytes as a hash table, which the driver builds, and many are built at once.
KEYS_LIMIT_BYTES = 2 * 1024 * 1024
FIXED_WIDTH = 16
#: Sizes that were noted while a frame was written, so that nothing reads it for them.
_NOTED: WeakKeyDictionary[DataFrame, int] = WeakKeyDictionary()

class Lookup:
    """A side table with unique keys and a measured size.

    It is broadcast only while its measured size stays under the limit. Beyond that it
    is joined by shuffle, with the fact rows of each key spread over ``salts`` tasks and
    the side table repeated once per salt, so that a hot key never meets a single task. There
    are more salts the smaller the side is, so that its copies stay within ``salted_bytes``.
    ``bytes_bound`` skips the measurement where a bound is already proven.
    """

    def __init__(self, frame: DataFrame, keys: Sequence[str], bytes_bound: int | None = None,
                 limit: int = BROADCAST_LIMIT_BYTES, salts: int | None = None,
                 salted_bytes: int = 64 * BROADCAST_LIMIT_BYTES):
        self.frame = frame
        self.keys = list(keys)
        self.limit = limit
        self._salts = salts
        self.salted_bytes = salted_bytes
        self._bound = bytes_bound

    @cached_property
    def size(self) -> int:
        """Upper bound of the size in bytes; one aggregation if none was given."""
        return measured_bytes(self.frame) if self._bound is None else self._bound

    @property
    def salts(self) -> int:
        """How often the side is repeated where it is not broadcast: 2 to 64 times."""
        return self._salts or min(64, max(2, self.salted_bytes // max(self.size, 1)))

    @property
    def fits(self) -> bool:
        return self.size <= self.limit

    def attach(self, facts: DataFrame, on: Mapping[str, Column], take: Mapping[str, str]) -> DataFrame:
        """Add the columns ``take`` (lookup name -> new name) to ``facts``.

        ``on`` gives for each key of the lookup the expression to match on the fact side.
        """
        side = self.frame.select(
            *(F.col(k).alias(f"_k_{k}") for k in self.keys),
            *(F.col(src).alias(dst) for src, dst in take.items()),
        )
        match = [on[k] == F.col(f"_k_{k}") for k in self.keys]
        kept = [F.col(c) for c in facts.columns] + [F.col(dst) for dst in take.values()]
        if self.fits:
            return facts.join(F.broadcast(side), match, "left").select(*kept)
        salted = facts.withColumn("_salt", F.pmod(F.xxhash64(*facts.columns), F.lit(self.salts)))
        repeated = side.withColumn("_salt_k", F.explode(F.sequence(F.lit(0), F.lit(self.salts - 1))))
        match.append(F.col("_salt") == F.col("_salt_k").cast("long"))
        return salted.join(repeated, match, "left").select(*kept)


def width(df: DataFrame) -> Column:
    """Upper bound of the bytes of a row."""
    total = F.lit(0).cast("long")
    for field in df.schema.fields:
        total = total + FIXED_WIDTH
        if isinstance(field.dataType, T.StringType):
            total = total + F.coalesce(F.octet_length(field.name), F.lit(0))
    return total


def measured_bytes(df: DataFrame) -> int:
    """Upper bound of the size of ``df`` in memory: as noted, or by one aggregation."""
    return _NOTED[df] if df in _NOTED else df.agg(F.sum(width(df))).first()[0] or 0


def noted(df: DataFrame, size: int) -> DataFrame:
    """``df`` with its size, once that is known."""
    _NOTED[df] = size
    return df


def semi_join(rows: DataFrame, keys: DataFrame, on: Mapping[str, str],
              limit: int = KEYS_LIMIT_BYTES, different: bool = False) -> DataFrame:
    """The ``rows`` whose columns ``on`` occur among the given columns of ``keys``, NULL like any value.

    The keys are broadcast if their measured size stays below the limit, else shuffled and merged, however
    small their files are; hot keys of ``rows`` are split then by adaptive execution. ``different`` tells
    that ``keys`` holds no row twice, which saves a shuffle to measure them, and all of it where their size
    is ``noted``.
    """
    names = {column: f"_m{n}" for n, column in enumerate(on)}
    wanted = keys.select(*(F.col(on[c]).alias(names[c]) for c in on))
    wanted = wanted if different else wanted.distinct()
    size = measured_bytes(keys if different and len(on) == len(keys.columns) else wanted)
    wanted = F.broadcast(wanted) if size <= limit else wanted.hint("merge")
    return rows.join(wanted, [F.col(c).eqNullSafe(F.col(names[c])) for c in on], "left_semi")


def join_large(facts: DataFrame, side: DataFrame, key: str, side_key: str,
               take: Mapping[str, str], spread_by: str) -> DataFrame:
    """Left join to a side table that may be as large as the facts.

    The side has one row per key. Rows without a key match nothing; they are scattered by
    ``spread_by`` instead of meeting in the one task that NULL hashes to. The scatter
    column is part of the join key, so both inputs of the join are always exchanges of
    their own: the shape in which adaptive execution splits the partition of a hot key.
    """
    spread = F.when(F.col(key).isNull(), F.xxhash64(F.col(spread_by))).otherwise(F.lit(0).cast("long"))
    left = facts.withColumn("_spread", spread)
    right = side.select(
        F.col(side_key).alias("_side_key"),
        F.lit(0).cast("long").alias("_side_spread"),
        *(F.col(src).alias(dst) for src, dst in take.items()),
    )
    joined = left.join(
        right,
        [F.col(key) == F.col("_side_key"), F.col("_spread") == F.col("_side_spread")],
        "left",
    )
    return joined.select(*facts.columns, *take.values())
