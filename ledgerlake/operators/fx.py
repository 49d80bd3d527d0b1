"""Daily exchange rates to USD."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.money import RATE, rate_or_one
from ledgerlake.operators.dedup import latest_values
from ledgerlake.operators.lookup import Lookup

RATE_KEYS = ("from_currency", "rate_date")


def daily_rates(brz_fx: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    """One rate to USD per currency and day: the one loaded last, with the columns ``also``."""
    usd = brz_fx.filter(F.col("to_currency") == "USD")
    latest = latest_values(usd, RATE_KEYS, ["rate", *also])
    return latest.select("from_currency", "rate_date", F.col("rate").cast(RATE).alias("rate"), *also)


def rate_lookup(rates: DataFrame, **options) -> Lookup:
    """Daily rates as a lookup; its size is measured once and shared by all models.

    ``rates`` are written ones, so that no model works them out again.
    """
    return Lookup(rates, RATE_KEYS, **options)


def with_usd_rate(facts: DataFrame, rates: Lookup, currency: Column, day: Column) -> DataFrame:
    """Add ``usd_rate``: the rate of the day, or 1 where there is none."""
    joined = rates.attach(facts, {"from_currency": currency, "rate_date": day}, {"rate": "_rate"})
    return joined.withColumn("usd_rate", rate_or_one(F.col("_rate"))).drop("_rate")


def missing_rates(facts: DataFrame, rates: Lookup, currency: Column, day: Column) -> DataFrame:
    """Rows per currency whose day has no rate, the ones converted at 1."""
    joined = rates.attach(facts, {"from_currency": currency, "rate_date": day}, {"rate": "_rate"})
    return (
        joined.filter(F.col("_rate").isNull())
        .groupBy(currency.alias("currency"))
        .agg(F.count(F.lit(1)).alias("fx_missing"))
    )
