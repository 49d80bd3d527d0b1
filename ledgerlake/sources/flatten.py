"""Flatten nested JSON payloads into RAW rows.

Input frames have one ``payload`` column of JSON text. The text is parsed once per row
against the declared fields; anything absent, null or of another shape becomes NULL.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.schemas import LOAD_COLUMNS, RAW

_LOADED = {item.split(":")[0] for item in LOAD_COLUMNS.split()}

# RAW column -> path inside the payload, where it is not a top-level field.
NESTED: dict[str, dict[str, str]] = {
    "charges": {
        "payment_method_details_type": "payment_method_details.type",
        "payment_method_details_card_brand": "payment_method_details.card.brand",
        "payment_method_details_card_funding": "payment_method_details.card.funding",
        "payment_method_details_card_country": "payment_method_details.card.country",
        "payment_method_details_card_last4": "payment_method_details.card.last4",
        "payment_method_details_card_exp_month": "payment_method_details.card.exp_month",
        "payment_method_details_card_exp_year": "payment_method_details.card.exp_year",
    },
    "disputes": {
        "evidence_details_due_by": "evidence_details.due_by",
        "evidence_details_has_evidence": "evidence_details.has_evidence",
    },
    "customers": {
        "address_city": "address.city",
        "address_country": "address.country",
        "address_line1": "address.line1",
        "address_postal_code": "address.postal_code",
    },
    "subscriptions": {
        "plan_id": "plan.id",
        "plan_interval": "plan.interval",
        "plan_interval_count": "plan.interval_count",
        "plan_amount": "plan.amount",
        "plan_currency": "plan.currency",
    },
    "invoice_line_items": {
        "period_start": "period.start",
        "period_end": "period.end",
        "plan_id": "plan.id",
        "plan_interval": "plan.interval",
        "plan_interval_count": "plan.interval_count",
        "plan_amount": "plan.amount",
        "price_id": "price.id",
    },
}


def once(value: Column) -> Column:
    """A column worked out once for each row, however it is used later.

    A filter on a plain column, say a watermark, is pushed below what gives it and works that
    out, and all it is built from, a second time; nothing is pushed below an explode.
    """
    return F.explode(F.array(value))


def _fields(entity: str) -> list[T.StructField]:
    return [f for f in RAW[entity].fields if f.name not in _LOADED and f.name != "raw_payload"]


def payload_schema(entity: str, skip: tuple[str, ...] = ()) -> T.StructType:
    """The nested schema to parse for an entity."""
    root: dict = {}
    for field in _fields(entity):
        if field.name in skip:
            continue
        *parents, leaf = NESTED.get(entity, {}).get(field.name, field.name).split(".")
        level = root
        for name in parents:
            level = level.setdefault(name, {})
        level[leaf] = field.dataType

    def built(level: dict) -> T.StructType:
        return T.StructType([
            T.StructField(name, built(kind) if isinstance(kind, dict) else kind)
            for name, kind in level.items()
        ])

    return built(root)


def _column(entity: str, name: str, root: str) -> Column:
    return F.col(f"{root}.{NESTED.get(entity, {}).get(name, name)}").alias(name)


def flatten(df: DataFrame, entity: str) -> DataFrame:
    """One RAW row per payload, with the payload itself as ``raw_payload``."""
    parsed = df.select("payload", once(F.from_json("payload", payload_schema(entity))).alias("p"))
    return parsed.select(*(_column(entity, f.name, "p") for f in _fields(entity)),
                         F.col("payload").alias("raw_payload"))


def flatten_invoice_line_items(df: DataFrame) -> DataFrame:
    """One row per line of each invoice; an invoice without lines gives none.

    Lines come as a plain array or as a list object with a ``data`` array.
    """
    line = payload_schema("invoice_line_items", skip=("invoice_id",))
    as_text = F.coalesce(
        F.get_json_object("payload", "$.lines.data"), F.get_json_object("payload", "$.lines"))
    # The id is taken before the lines, else the invoice is read again for each line.
    invoices = df.select("payload", once(F.get_json_object("payload", "$.id")).alias("invoice_id"))
    lines = invoices.select(
        "invoice_id",
        F.explode(F.from_json(as_text, T.ArrayType(T.StringType()))).alias("line"),
    ).withColumn("p", F.from_json("line", line))
    return lines.select(
        *(F.col("invoice_id") if f.name == "invoice_id" else _column("invoice_line_items", f.name, "p")
          for f in _fields("invoice_line_items")),
        F.col("line").alias("raw_payload"),
    )


def fx_from_usd_base(df: DataFrame, source: str = "exchangerate") -> DataFrame:
    """Quotes per USD to rates into USD.

    Input: ``payload``, a JSON object of ``rate_date`` and ``rates``, an object from currency to
    units per USD. A quote that is zero or missing gives a NULL rate. USD itself is added once
    per day at 1.
    """
    parsed = df.select(F.from_json("payload", "rate_date date, rates map<string, decimal(24,12)>").alias("p"))
    days = parsed.select("p.rate_date", "p.rates")
    quoted = days.select("rate_date", F.explode("rates").alias("from_currency", "quote")).where("from_currency <> 'USD'")
    inverse = F.when(F.col("quote") != 0, F.round(F.lit(1).cast("decimal(1,0)") / F.col("quote"), 6))
    rates = quoted.select("rate_date", "from_currency", inverse.try_cast("decimal(12,6)").alias("rate"))
    base = days.select("rate_date").distinct().select(
        "rate_date", F.lit("USD").alias("from_currency"), F.lit(1).cast("decimal(12,6)").alias("rate"))
    return rates.unionByName(base).select(
        "rate_date", "from_currency", F.lit("USD").alias("to_currency"), "rate",
        F.lit(source).alias("source"))


def _has_decimals(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_has_decimals(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _has_decimals(kind.elementType)
    return isinstance(kind, T.DecimalType)


def _as_numbers(value: Column, kind: T.DataType) -> Column:
    """Decimals, also inside structs and arrays, as doubles. What holds none is not rebuilt."""
    if not _has_decimals(kind):
        return value
    if isinstance(kind, T.DecimalType):
        return value.cast("double")
    if isinstance(kind, T.StructType):
        inner = F.struct(*(_as_numbers(value[f.name], f.dataType).alias(f.name) for f in kind.fields))
        return F.when(value.isNotNull(), inner)
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: _as_numbers(x, kind.elementType))
    return value


def to_payload(df: DataFrame) -> DataFrame:
    """The whole row as JSON text; decimals become numbers, NULL fields stay as ``null``."""
    values = [_as_numbers(F.col(f.name), f.dataType).alias(f.name) for f in df.schema.fields]
    return df.select(F.to_json(F.struct(*values), {"ignoreNullFields": "false"}).alias("payload"))


# Entities whose payload is one flat row.
PLAIN = ("balance_transactions", "charges", "refunds", "disputes", "payouts", "customers",
         "subscriptions", "invoices")

FLATTENERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    **{entity: partial(flatten, entity=entity) for entity in PLAIN},
    "invoice_line_items": flatten_invoice_line_items,
    "fx_rates": fx_from_usd_base,
}
