"""Daily partials of the charge, refund and dispute facts, from which rates and latencies are merged.

A partial holds counts and sums for each day and the few attributes that reports ask for; days
between events are kept as a histogram, one row for each number of days, so that percentiles
stay exact when partials are merged. They need Silver columns only. Kept per day, a late refund
changes the partial of one day.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOTAL = "decimal(38,2)"


def _daily(df: DataFrame, by: list[str], **flags) -> DataFrame:
    return df.groupBy(F.col("created_date").alias("day"), *by).agg(
        F.count(F.lit(1)).alias("n"), *(F.count_if(c).alias(name) for name, c in flags.items()),
        F.sum("amount_usd").cast(TOTAL).alias("amount_usd"))


def charges_daily(charges: DataFrame) -> DataFrame:
    """By payment method, card brand and failure code, which is NULL unless the charge failed."""
    return _daily(charges, ["payment_method_type", "card_brand", "failure_code"],
                  succeeded=F.col("status") == "succeeded", failed=F.col("is_failed"))


def refunds_daily(refunds: DataFrame) -> DataFrame:
    """By reason and days since the charge."""
    return _daily(refunds, ["reason", "days_since_charge"])


def disputes_daily(disputes: DataFrame) -> DataFrame:
    """By outcome and days left to answer."""
    found = disputes.withColumn("loss", F.when(F.col("is_lost"), F.col("amount_usd")).otherwise(F.lit(Decimal("0.00"))))
    return found.groupBy(F.col("created_date").alias("day"), "outcome_category", "days_to_evidence_due").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("is_won").alias("won"), F.count_if("is_lost").alias("lost"),
        F.count_if("is_overdue").alias("overdue"), F.count_if("has_evidence_submitted").alias("with_evidence"),
        F.sum("amount_usd").cast(TOTAL).alias("amount_usd"), F.sum("loss").cast(TOTAL).alias("loss_usd"))


# Fact -> the table of its partials and how they are made.
PARTIALS: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "fct_charges": ("charges_daily", charges_daily),
    "fct_refunds": ("refunds_daily", refunds_daily),
    "fct_disputes": ("disputes_daily", disputes_daily),
}
