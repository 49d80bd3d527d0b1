"""Column expressions shared by the models. All of them stay inside the JVM."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: stands for NULL inside a surrogate key.
KEY_NULL = "_dbt_utils_surrogate_key_null_"
KEY_TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
# Fixed value: end of validity of a row that is still current.
OPEN_END = "9999-12-31 00:00:00"


# --- text -------------------------------------------------------------------------------

def lowered(col: Column, default: str | None = None) -> Column:
    return F.lower(col if default is None else F.coalesce(col, F.lit(default)))


def uppered(col: Column, default: str | None = None) -> Column:
    return F.upper(col if default is None else F.coalesce(col, F.lit(default)))


def title_case(col: Column) -> Column:
    """``late_fee`` becomes ``Late Fee``."""
    return F.initcap(F.replace(col, F.lit("_"), F.lit(" ")))


def flag(col: Column, default: bool) -> Column:
    return F.coalesce(col.cast("boolean"), F.lit(default))


def non_empty(col: Column) -> Column:
    return col.isNotNull() & (col != "")


def is_true(condition: Column) -> Column:
    """NULL-free boolean: an unknown condition counts as false."""
    return F.coalesce(condition, F.lit(False))


# --- time -------------------------------------------------------------------------------

def epoch_timestamp(seconds: Column) -> Column:
    """Unix seconds to a zone-free UTC timestamp, whatever the session time zone."""
    origin = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("SECOND", seconds.cast("long"), origin)


def epoch_date(seconds: Column) -> Column:
    return epoch_timestamp(seconds).cast("date")


def epoch_seconds(ts: Column) -> Column:
    """Zone-free timestamp to Unix seconds."""
    origin = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("SECOND", origin, ts.cast("timestamp_ntz")).cast("long")


def days_between(start: Column, end: Column) -> Column:
    """Days from ``start`` to ``end``."""
    return F.datediff(end, start).cast("long")


def month_of(day: Column) -> Column:
    return F.trunc(day, "month")


def weekday_from_sunday(day: Column) -> Column:
    """0 for Sunday to 6 for Saturday."""
    return (F.dayofweek(day) - 1).cast("int")


def fiscal_year(day: Column, first_month: int) -> Column:
    """The calendar year in which the fiscal year starts."""
    return F.when(F.month(day) >= first_month, F.year(day)).otherwise(F.year(day) - 1).cast("int")


def fiscal_month(day: Column, first_month: int) -> Column:
    return (F.pmod(F.month(day) - first_month, F.lit(12)) + 1).cast("int")


def parse_utc(text: str) -> str:
    """SQL text: ISO-8601 text, with or without offset, as a zone-free UTC timestamp.

    Malformed text gives NULL.
    """
    return f"CAST(to_utc_timestamp(try_to_timestamp({text}), current_timezone()) AS timestamp_ntz)"


# --- keys and lookups -------------------------------------------------------------------

def surrogate_key(*cols: Column) -> Column:
    """MD5 over the text of the given columns, NULL-safe."""
    parts = [F.coalesce(c.cast("string"), F.lit(KEY_NULL)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def key_text(ts: Column) -> Column:
    """Timestamp text with a fixed width, for use inside a key."""
    return F.date_format(ts, KEY_TIMESTAMP_FORMAT)


def mapped(col: Column, values: Mapping[str, object], default: Column) -> Column:
    """Translate a code through a constant table."""
    pairs: Sequence[Column] = [F.lit(x) for pair in values.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), col), default)


def banded(col: Column, bands: Sequence[tuple[object, str]], above: str) -> Column:
    """First label whose upper limit exceeds the value; NULL and the rest fall through."""
    limit, label = bands[0]
    expr = F.when(col < F.lit(limit), label)
    for limit, label in bands[1:]:
        expr = expr.when(col < F.lit(limit), label)
    return expr.otherwise(above)


def percent_apart(expected: Column, actual: Column) -> Column:
    """|expected - actual| in percent of expected; NULL unless expected is positive."""
    gap = F.abs(expected - actual).cast("double") / expected.cast("double") * 100.0
    return F.when(expected > 0, gap)
