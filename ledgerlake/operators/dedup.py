"""Keep the newest version of each key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LOAD_ORDER = ("loaded_at", "ingestion_run_id", "source_file")
#: A hash of the landed row, stored when it is loaded; it makes every order total.
ROW_HASH = "row_hash"


def with_row_hash(df: DataFrame) -> DataFrame:
    return df.withColumn(ROW_HASH, F.xxhash64(*(c for c in df.columns if c != ROW_HASH)))


def _tie_break(df: DataFrame) -> Column:
    """The stored hash of the row where there is one, so that the rest of it need not be read."""
    return F.col(ROW_HASH) if ROW_HASH in df.columns else F.xxhash64(*df.columns)


def newest_first(df: DataFrame, by: Sequence[str]) -> list[Column]:
    """Descending order over ``by``, made total by the hash of the row.

    Rows that tie on everything are copies of each other, so which one survives a
    de-duplication no longer depends on the order of arrival.
    """
    present = [c for c in by if c in df.columns]
    return [*(F.col(c).desc_nulls_last() for c in present), _tie_break(df).desc_nulls_last()]


def dedup_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str] = LOAD_ORDER) -> DataFrame:
    """One row per key: the last by ``order``.

    ``row_number() = 1`` is planned with a group limit before the exchange, so each
    map task sends at most one row per key. A key with billions of copies costs the
    reducer one row per map task.
    """
    window = Window.partitionBy(*keys).orderBy(*newest_first(df, order))
    return (
        df.withColumn("_rank", F.row_number().over(window))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def latest_values(df: DataFrame, keys: Sequence[str], columns: Sequence[str],
                  order: Sequence[str] = LOAD_ORDER) -> DataFrame:
    """The ``columns`` of the last row of each key, by ``order``, as one aggregate.

    For reads of few columns: map tasks merge a key before the shuffle and sort by the key only,
    and nothing but keys, order and ``columns`` is read. Without a stored row hash, rows that tie
    are told apart by ``columns`` alone.
    """
    present = [F.col(c) for c in order if c in df.columns]
    last = F.col(ROW_HASH) if ROW_HASH in df.columns else F.xxhash64(*columns)
    newest = F.max_by(F.struct(*columns), F.struct(*present, last.alias("_tie")))
    return df.groupBy(*keys).agg(newest.alias("_row")).select(*keys, "_row.*")
