"""Landing zone: Parquet files per entity, day and run."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import Future, ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.operators.align import align_to_schema
from ledgerlake.operators.incremental import created_after
from ledgerlake.session import observed
from ledgerlake.sources import files
from ledgerlake.sources.flatten import FLATTENERS, once

def entity_path(root: str, entity: str) -> str:
    return f"{root.rstrip('/')}/landing/{entity}"


def stamp(df: DataFrame, run_id: str, loaded_at: dt.datetime, load_mode: str = "batch") -> DataFrame:
    """Add the load columns. The time is given, not taken from the clock of a task."""
    return df.withColumns({
        "ingestion_run_id": F.lit(run_id),
        "load_mode": F.lit(load_mode),
        "loaded_at": F.lit(loaded_at).cast("timestamp_ntz"),
    })


def write_landing(df: DataFrame, root: str, entity: str, run_id: str, day: dt.date) -> str:
    """Write one run of one entity. A repeated run replaces its own files only."""
    path = f"{entity_path(root, entity)}/{day:year=%Y/month=%m/day=%d}/run_id={run_id}"
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)
    return path


def _scan(spark: SparkSession, path: str, schema: T.StructType | None) -> DataFrame:
    reader = spark.read.option("recursiveFileLookup", "true")
    reader = reader.schema(schema) if schema else reader.option("mergeSchema", "true")
    found = reader.parquet(path)
    return found.drop("source_file").withColumn("source_file", F.col("_metadata.file_path"))


def read_landing(spark: SparkSession, root: str, entity: str, schema: T.StructType,
                 file_schema: T.StructType | None = None) -> DataFrame:
    """All landed files of an entity in ``schema``, with the file each row came from.

    ``file_schema`` declares what the files hold; without it their footers are merged.
    """
    return align_to_schema(_scan(spark, entity_path(root, entity), file_schema), schema)


def read_optional(spark: SparkSession, root: str, entity: str, schema: T.StructType,
                  file_schema: T.StructType | None = None) -> DataFrame:
    """As ``read_landing``, but an empty or absent folder gives no rows."""
    if not files.has_files(spark, entity_path(root, entity)):
        return spark.createDataFrame([], schema)
    return read_landing(spark, root, entity, schema, file_schema)


def backfill(spark: SparkSession, root: str, entity: str, schema: T.StructType,
             first: dt.date, last: dt.date, file_schema: T.StructType | None = None) -> DataFrame:
    """Landed files of the days from ``first`` to ``last``. Only their folders are opened.

    ``file_schema`` declares what the files hold; without it the footers of these days are merged.
    """
    base = entity_path(root, entity)
    days = [first + dt.timedelta(n) for n in range((last - first).days + 1)]
    paths = [p for d in days if files.exists(spark, p := f"{base}/{d:year=%Y/month=%m/day=%d}")]
    if not paths:
        return spark.createDataFrame([], schema)
    reader = spark.read.option("recursiveFileLookup", "true")
    reader = reader.schema(file_schema) if file_schema else reader.option("mergeSchema", "true")
    chosen = reader.parquet(*paths).drop("source_file").withColumn("source_file", F.col("_metadata.file_path"))
    return align_to_schema(chosen, schema)


def ingest_all(spark: SparkSession, payloads: Mapping[str, Callable[[], DataFrame]], root: str,
               run_id: str, loaded_at: dt.datetime, watermarks: Mapping[str, int] | None = None,
               flatteners: Mapping[str, Callable[[DataFrame], DataFrame]] = FLATTENERS,
               errors: dict[str, str] | None = None, together: int = 4) -> dict[str, int]:
    """Flatten, stamp and land every entity, ``together`` of them at a time.

    Returns the rows landed per entity: 0 where nothing was new, -1 where it failed. A
    failure does not stop the other entities; ``errors`` takes what it was, and
    ``raise_on_failure`` stops the run.
    """
    def prepared(entity: str) -> DataFrame:
        found = payloads[entity]()
        mark = watermarks.get(entity, 0) if watermarks else None
        if mark is not None and entity == "invoice_line_items":
            # Lines have no time of their own; they are as new as their invoice.
            created = F.get_json_object("payload", "$.created").cast("long")
            found = found.select("*", once(created).alias("_invoice_created"))
            found = found.filter(F.col("_invoice_created") > mark).drop("_invoice_created")
        rows = flatteners[entity](found)
        if mark is not None and "created" in rows.columns:
            rows = created_after(rows, mark)
        return stamp(rows, run_id, loaded_at)

    def written(entity: str, rows: DataFrame) -> int:
        seen = Observation()
        write_landing(rows.observe(seen, F.count(F.lit(1)).alias("rows")), root, entity, run_id, loaded_at.date())
        return observed(seen, {"rows": 0})["rows"]

    failed: dict[str, Exception] = {}
    writes: dict[str, Future[int]] = {}
    with ThreadPoolExecutor(together) as pool:
        for entity in payloads:
            try:
                rows = prepared(entity)
            except Exception as err:  # one entity must not stop the others
                failed[entity] = err
            else:
                writes[entity] = pool.submit(inheritable_thread_target(spark)(written), entity, rows)
    failed |= {e: err for e, write in writes.items() if isinstance(err := write.exception(), Exception)}
    if errors is not None:
        errors.update({e: str(failed[e]) for e in payloads if e in failed})
    return {e: -1 if e in failed else writes[e].result() for e in payloads}


def raise_on_failure(landed: Mapping[str, int]) -> None:
    failed: Sequence[str] = [e for e, n in landed.items() if n < 0]
    if failed:
        raise RuntimeError(f"ingest failed for {', '.join(failed)}")
