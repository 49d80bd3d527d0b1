"""Incremental reads and schema evolution."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def high_water(target: DataFrame | None, ts_col: str = "loaded_at") -> dt.datetime | None:
    """The newest timestamp in ``target``; None if there is no target or it is empty."""
    if target is None or ts_col not in target.columns:
        return None
    return target.agg(F.max(ts_col)).first()[0]


def newer_than(df: DataFrame, mark: dt.datetime | None, ts_col: str = "loaded_at",
               lookback: dt.timedelta | None = None) -> DataFrame:
    """Rows strictly after ``mark``. The literal reaches the Parquet scan as a filter."""
    if mark is None:
        return df
    if lookback:
        mark = mark - lookback
    return df.filter(F.col(ts_col) > F.lit(mark).cast(df.schema[ts_col].dataType))


def since(df: DataFrame, target: DataFrame | None, ts_col: str = "loaded_at",
          lookback: dt.timedelta | None = None) -> DataFrame:
    """Rows of ``df`` not yet in ``target`` by load time. An empty target takes all rows."""
    return newer_than(df, high_water(target, ts_col), ts_col, lookback)


def created_after(df: DataFrame, watermark: int) -> DataFrame:
    """Rows created strictly after a Unix-seconds watermark."""
    return df.filter(F.col("created") > F.lit(watermark))


def evolve(target: DataFrame, updates: DataFrame, mode: str) -> tuple[DataFrame, DataFrame]:
    """Bring old rows and new rows to one column set.

    ``append_new_columns`` keeps all old columns and adds new ones; ``sync_all_columns``
    takes exactly the columns of the updates.
    """
    if mode == "sync_all_columns":
        columns = [(f.name, f.dataType) for f in updates.schema.fields]
    elif mode == "append_new_columns":
        columns = [(f.name, f.dataType) for f in target.schema.fields]
        columns += [(f.name, f.dataType) for f in updates.schema.fields if f.name not in target.columns]
    else:
        raise ValueError(f"unknown schema change mode: {mode}")

    def shaped(df: DataFrame) -> DataFrame:
        return df.select(*(
            (F.col(name) if name in df.columns else F.lit(None)).cast(kind).alias(name)
            for name, kind in columns
        ))

    return shaped(target), shaped(updates)
