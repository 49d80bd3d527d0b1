"""Watermarks, run log and recorded check results."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.functions.columns import epoch_seconds, epoch_timestamp
from ledgerlake.operators.align import align_to_schema
from ledgerlake.schemas import AUDIT, LOAD_STRATEGIES, WATERMARK_START
from ledgerlake.sources.tables import Table

CONTROL_KEYS = ("source_name", "entity_name")


def control_table(spark: SparkSession, path: str) -> Table:
    """The watermark table: a row for each entity."""
    return Table(spark, path, keys=CONTROL_KEYS, buckets=1)


def control_seed(spark: SparkSession, start: str = WATERMARK_START) -> DataFrame:
    """The watermark table before the first run, all watermarks at ``start``."""
    rows = [(source, entity, strategy) for (source, entity), strategy in LOAD_STRATEGIES.items()]
    seeded = spark.createDataFrame(rows, "source_name string, entity_name string, load_strategy string")
    begin = F.lit(start).cast("timestamp_ntz")
    return align_to_schema(seeded.withColumn("last_successful_watermark", begin),
                           AUDIT["ingestion_control"])


def get_watermark(control: DataFrame, entity: str, source: str = "stripe") -> int:
    """Unix seconds of the last successful load; 0 if there is none."""
    row = (
        control.filter((F.col("source_name") == source) & (F.col("entity_name") == entity)
                       & F.col("last_successful_watermark").isNotNull())
        .select(epoch_seconds(F.col("last_successful_watermark")).alias("mark"))
        .limit(1)
        .first()
    )
    return row[0] if row else 0


def watermarks(control: DataFrame) -> dict[tuple[str, str], int]:
    """All watermarks in Unix seconds, by source and entity. One row each, a dozen in all."""
    rows = control.select(*CONTROL_KEYS, epoch_seconds(F.col("last_successful_watermark")).alias("mark")).collect()
    return {(r["source_name"], r["entity_name"]): r["mark"] or 0 for r in rows}


def loaded_watermark(loaded: DataFrame, entity: str, source: str = "stripe",
                     created: str = "created") -> DataFrame:
    """The watermark an entity has reached: the newest creation time actually loaded."""
    return loaded.agg(F.max(created).alias("newest")).select(
        F.lit(source).alias("source_name"), F.lit(entity).alias("entity_name"),
        epoch_timestamp(F.col("newest")).alias("last_successful_watermark"))


def advanced(control: DataFrame, reached: DataFrame, run_id: str, now: dt.datetime) -> DataFrame:
    """Control rows for a successful run. A watermark never moves back."""
    new = reached.filter("last_successful_watermark IS NOT NULL").withColumnRenamed(
        "last_successful_watermark", "_reached")
    return control.join(F.broadcast(new), list(CONTROL_KEYS)).select(
        *CONTROL_KEYS, "load_strategy",
        F.greatest("last_successful_watermark", "_reached").alias("last_successful_watermark"),
        "last_successful_cursor",
        F.lit(run_id).alias("last_successful_run_id"),
        F.lit("success").alias("last_run_status"),
        F.lit(now).cast("timestamp_ntz").alias("updated_at"),
    )


def advance_watermarks(control: Table, reached: DataFrame, run_id: str, now: dt.datetime) -> None:
    control.upsert(advanced(control.read(), reached, run_id, now), order=())


def shaped(rows: DataFrame, table: str) -> DataFrame:
    """Rows in the schema of an audit table, with a row id where it has one."""
    schema = AUDIT[table]
    if "id" in schema.names and "id" not in rows.columns:
        rows = rows.withColumn("id", F.uuid())
    return align_to_schema(rows, schema, defaults={})


def record(table: Table, name: str, rows: DataFrame) -> None:
    """Append to an audit table. These hold a handful of rows per run."""
    table.append(shaped(rows, name).coalesce(1))


def run_entry(spark: SparkSession, run_id: str, task: str, status: str, started: dt.datetime,
              finished: dt.datetime, rows: int | None = None, error: str | None = None,
              job: str = "daily") -> DataFrame:
    """One row of the run log."""
    seconds = int((finished - started).total_seconds())
    schema = T.StructType([f for f in AUDIT["pipeline_runs"].fields if f.name != "extra_metadata"])
    values = (run_id, job, task, status, started, finished, seconds, rows, error, finished)
    return spark.createDataFrame([values], schema)


def last_runs(pipeline_runs: DataFrame, count: int = 10) -> DataFrame:
    """The newest entries of the run log."""
    return pipeline_runs.orderBy(F.col("logged_at").desc(), "run_id", "task_id").limit(count)


def failed_rows(rejects: DataFrame, entity: str, run_id: str, now: dt.datetime,
                source: str = "stripe") -> DataFrame:
    """Dead-letter entries: one per file and kind of error."""
    return rejects.groupBy(F.col("source_file").alias("file_path"), "error_message").agg(
        F.lit(source).alias("source"), F.lit(entity).alias("entity"),
        F.lit("row_rejected").alias("error_type"),
        F.lit(now).cast("timestamp_ntz").alias("failed_at"),
        F.lit(run_id).alias("run_id"),
    )
