"""Load by column name, with rows that do not fit set aside."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.functions.columns import parse_utc
from ledgerlake.schemas import RAW_DEFAULTS


def _by_lower_name(df: DataFrame) -> dict[str, T.StructField]:
    return {f.name.lower(): f for f in df.schema.fields}


def _converted(found: T.StructField, want: T.DataType) -> str:
    """SQL text that converts a found column, NULL where that fails."""
    source = f"`{found.name}`"
    if found.dataType == want:
        return source
    if isinstance(want, T.TimestampNTZType) and isinstance(found.dataType, T.StringType):
        return parse_utc(source)
    if isinstance(want, T.TimestampNTZType) and isinstance(found.dataType, T.TimestampType):
        return f"CAST(to_utc_timestamp({source}, current_timezone()) AS timestamp_ntz)"
    return f"try_cast({source} AS {want.simpleString()})"


def align_to_schema(df: DataFrame, schema: T.StructType,
                    defaults: Mapping[str, str] = RAW_DEFAULTS) -> DataFrame:
    """Select exactly the columns of ``schema``.

    Names match whatever their case, columns the schema lacks are dropped, missing ones
    become NULL or their default, and a value that cannot be converted becomes NULL.
    """
    found = _by_lower_name(df)
    out = []
    for field in schema.fields:
        have = found.get(field.name.lower())
        kind = field.dataType.simpleString()
        value = _converted(have, field.dataType) if have else f"CAST(NULL AS {kind})"
        if field.name in defaults:
            value = f"coalesce({value}, CAST('{defaults[field.name]}' AS {kind}))"
        out.append(f"{value} AS `{field.name}`")
    return df.selectExpr(*out)


def load_errors(df: DataFrame, schema: T.StructType,
                defaults: Mapping[str, str] = RAW_DEFAULTS) -> Column:
    """What is wrong with a row: the columns that fail to convert or lack a required value."""
    found = _by_lower_name(df)
    problems = []
    for field in schema.fields:
        have = found.get(field.name.lower())
        required = bool(field.metadata.get("required")) and field.name not in defaults
        if have is None:
            if required:
                problems.append(F.lit(f"{field.name}: missing"))
            continue
        source = F.col(f"`{have.name}`")
        if have.dataType != field.dataType:
            lost = source.isNotNull() & F.expr(_converted(have, field.dataType)).isNull()
            problems.append(F.when(lost, F.lit(f"{field.name}: cannot convert")))
        if required:
            problems.append(F.when(source.isNull(), F.lit(f"{field.name}: missing")))
    if not problems:
        return F.lit("")
    return F.concat_ws("; ", *problems)


def marked(df: DataFrame, schema: T.StructType,
           defaults: Mapping[str, str] = RAW_DEFAULTS) -> DataFrame:
    """The rows untouched plus ``_error``: what is wrong with each, empty if nothing is."""
    return df.withColumn("_error", load_errors(df, schema, defaults))


def good_rows(df: DataFrame, schema: T.StructType,
              defaults: Mapping[str, str] = RAW_DEFAULTS) -> DataFrame:
    """The sound rows of a marked frame, in the target schema."""
    return align_to_schema(df.filter(F.col("_error") == "").drop("_error"), schema, defaults)


def rejected_rows(df: DataFrame) -> DataFrame:
    """The other rows of a marked frame, with the reason."""
    return df.filter(F.col("_error") != "").withColumnRenamed("_error", "error_message")


def split_rejects(df: DataFrame, schema: T.StructType,
                  defaults: Mapping[str, str] = RAW_DEFAULTS) -> tuple[DataFrame, DataFrame]:
    """``(good, rejects)``: good rows in the target schema, rejects untouched plus the reason."""
    checked = marked(df, schema, defaults)
    return good_rows(checked, schema, defaults), rejected_rows(checked)
