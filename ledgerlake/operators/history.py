"""Validity intervals for slowly changing rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def with_next(df: DataFrame, key: str, at: str, into: str, slice_by: str = "day") -> DataFrame:
    """Add ``into``: the following value of ``at`` within ``key``. NULL on the last row.

    Equal to ``lead(at) over (partition by key order by at)``, but the rows of one key are
    spread over time slices, so the longest run of rows any task sorts for a key is one
    slice. The last row of each slice then looks up the start of the next slice; there
    is one such row per key and slice.
    """
    sliced = df.withColumn("_slice", F.date_trunc(slice_by, F.col(at)))
    inside = Window.partitionBy(key, "_slice").orderBy(at)
    marked = sliced.withColumns(
        {into: F.lead(at).over(inside), "_slice_start": F.first(at).over(inside)}
    )
    across = Window.partitionBy(key).orderBy("_slice")
    settled = marked.filter(F.col(into).isNotNull())
    open_rows = marked.filter(F.col(into).isNull()).withColumn(
        into, F.lead("_slice_start").over(across)
    )
    return settled.unionByName(open_rows).drop("_slice", "_slice_start")


def with_previous_hash(df: DataFrame, key: str, at: str, attributes: Sequence[str],
                       into: str, slice_by: str = "day") -> DataFrame:
    """Add ``into``: the attribute hash of the preceding row of the key, sliced as above."""
    hashed = df.withColumn("_hash", F.xxhash64(*attributes)).withColumn(
        "_slice", F.date_trunc(slice_by, F.col(at))
    )
    inside = Window.partitionBy(key, "_slice")
    ordered = inside.orderBy(at)
    marked = (
        hashed.withColumn(into, F.lag("_hash").over(ordered))
        .withColumn("_first", F.row_number().over(ordered) == 1)
        .withColumn("_slice_end", F.max(F.struct(at, "_hash")).over(inside).getField("_hash"))
    )
    across = Window.partitionBy(key).orderBy("_slice")
    settled = marked.filter(~F.col("_first"))
    openers = marked.filter("_first").withColumn(into, F.lag("_slice_end").over(across))
    return settled.unionByName(openers).drop("_hash", "_slice", "_first", "_slice_end")
