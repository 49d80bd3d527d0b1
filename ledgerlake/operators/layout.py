"""Order of rows on disk by several columns at once, along a space-filling curve."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bits of each column in the curve: 2**BITS steps between its least and greatest value.
BITS = 12


def _number(column: str, kind: T.DataType, shared: int) -> Column:
    """A number that grows with the column. Of texts, the six bytes after those all have in common."""
    value = F.col(column)
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("double")
    if isinstance(kind, T.StringType):
        bytes_ = F.rpad(F.hex(F.substring(value.cast("binary"), shared + 1, 6)), 12, "0")
        return F.conv(bytes_, 16, 10).cast("double")
    return value.cast("double")


def _shared(low: str | None, high: str | None) -> int:
    a, b = (low or "").encode(), (high or "").encode()
    return next((n for n, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def curve(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> Column:
    """The place of a row on a Z-order curve over ``columns``: their steps, bit by bit in turn.

    Rows near each other on the curve are near in every column, so files cut along it have narrow
    ranges of each. The least and greatest values are measured once. NULL is the least step.
    """
    kinds = {c: df.schema[c].dataType for c in columns}
    ends = df.agg(*(f(c).alias(f"{n}_{c}") for c in columns for n, f in (("low", F.min), ("high", F.max)))).first()
    shared = {c: _shared(ends[f"low_{c}"], ends[f"high_{c}"]) if isinstance(k, T.StringType) else 0 for c, k in kinds.items()}
    numbers = {c: _number(c, kinds[c], shared[c]) for c in columns}
    spans = df.agg(*(f(numbers[c]).alias(f"{n}_{c}") for c in columns for n, f in (("low", F.min), ("high", F.max)))).first()
    place = F.lit(0).cast("long")
    steps = []
    for c in columns:
        low, high = spans[f"low_{c}"] or 0.0, spans[f"high_{c}"] or 0.0
        share = (numbers[c] - F.lit(low)) / F.lit((high - low) or 1.0)
        steps.append(F.coalesce(F.floor(share * F.lit(float((1 << bits) - 1))), F.lit(0)).cast("long"))
    for bit in range(bits):
        for n, step in enumerate(steps):
            one = F.shiftright(step, bit).bitwiseAND(F.lit(1).cast("long"))
            place = place.bitwiseOR(F.shiftleft(one, bit * len(steps) + n))
    return place


def along_curve(df: DataFrame, columns: Sequence[str], files: int | None = None) -> DataFrame:
    """``df`` dealt by ranges of the curve and sorted along it: one file for each range, or as many
    as adaptive execution makes of the session's partitions."""
    place = curve(df, columns)
    dealt = df.withColumn("_place", place)
    dealt = dealt.repartitionByRange(files, "_place") if files else dealt.repartitionByRange("_place")
    return dealt.sortWithinPartitions("_place").drop("_place")


def overlapping(df: DataFrame, column: str, value: object) -> tuple[int, int]:
    """How many files of a table may hold ``value`` by the least and greatest of ``column`` in each,
    which is what their footers say, and how many files there are."""
    ranges = df.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.min(column).alias("low"), F.max(column).alias("high"))
    found = ranges.agg(F.count_if(F.lit(value).between(F.col("low"), F.col("high"))), F.count(F.lit(1))).first()
    return found[0], found[1]
