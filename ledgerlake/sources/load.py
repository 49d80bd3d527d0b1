"""How a table takes new rows, by the strategy declared for its entity."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.operators.incremental import newer_than
from ledgerlake.sources.tables import Table


def load(df: DataFrame, target: Table, strategy: str, cursor: tuple[str, object] | None = None,
         lookback: dt.timedelta | None = None) -> None:
    """``timestamp_watermark`` appends rows loaded since the target's newest load,
    ``full_snapshot`` replaces the table, ``cursor`` appends rows past a cursor value."""
    if strategy == "timestamp_watermark":
        target.append(newer_than(df, target.newest(), lookback=lookback))
    elif strategy == "full_snapshot":
        target.replace(df)
    elif strategy == "cursor":
        rows = df
        if cursor is not None and cursor[1] is not None:
            rows = df.filter(F.col(cursor[0]) > F.lit(cursor[1]))
        target.append(rows)
    else:
        raise ValueError(f"unknown load strategy: {strategy}")


def rebuild(model: Callable[[DataFrame], DataFrame], source: DataFrame, target: Table) -> None:
    """Full refresh of an incremental table: run its model over everything, then swap."""
    target.replace(model(source))
