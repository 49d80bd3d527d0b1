"""Registration of queries: a Spark callable and, where one exists, its DuckDB statement."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import lru_cache
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

import adapters
import oracles as o
from ledgerlake.plans.warehouse import Warehouse
from ledgerlake.session import configure

AS_OF = dt.datetime(2024, 3, 1)
# Order dates start in 1995, so the calendar does too.
CALENDAR_START = dt.date(1995, 1, 1)


class Registered(NamedTuple):
    query: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Registered] = {}


@lru_cache(maxsize=128)
def raw(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    return adapters.spark_raw(spark, sf_dir, entity)


@lru_cache(maxsize=16)
def warehouse(spark: SparkSession, sf_dir: str, **options) -> Warehouse:
    """One warehouse per session and input folder: its plans are built, and its rate table
    measured, once. No data is cached."""
    configure(spark)
    return Warehouse(spark, lambda entity: raw(spark, sf_dir, entity), AS_OF,
                     calendar_start=CALENDAR_START, **options)


def register(name: str, sql: str | None):
    def add(query: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = Registered(query, sql)
        return query
    return add


def register_table(name: str, table: str) -> None:
    register(name, o.whole(table))(lambda s, d: getattr(warehouse(s, d), table))
