"""Load every landed file once; streams of landed files: project them, upsert them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerlake.operators.align import good_rows, marked, rejected_rows
from ledgerlake.operators.dedup import LOAD_ORDER, with_row_hash
from ledgerlake.plans import bronze
from ledgerlake.schemas import RAW
from ledgerlake.session import configure, observed
from ledgerlake.sources import files
from ledgerlake.sources.control import failed_rows, shaped
from ledgerlake.sources.manifest import PORTION, Manifest
from ledgerlake.sources.tables import Table
from ledgerlake.streaming.newest import newest_rows


# Longer than any file is old; the source otherwise skips files a week older than the newest.
ANY_AGE = "36500d"
# Entities whose creation time is not called ``created``.
CREATED = {"fx_rates": "rate_date"}


def landed_files(spark: SparkSession, path: str, file_schema: T.StructType | None = None,
                 max_files: int | None = None) -> DataFrame:
    """A stream over the Parquet files below ``path``, with the file each row came from."""
    if file_schema is None:
        file_schema = (
            spark.read.option("recursiveFileLookup", "true").option("mergeSchema", "true").parquet(path).schema)
    # Files are known by name alone: one that was never loaded is never too old to load.
    reader = (spark.readStream.schema(file_schema).option("recursiveFileLookup", "true")
              .option("maxFileAge", ANY_AGE))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    stream = reader.parquet(path)
    return stream.drop("source_file").withColumn("source_file", F.col("_metadata.file_path"))


def _drain(stream: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Process everything available now, in one or more batches, then stop."""
    def with_settings(batch: DataFrame, batch_id: int) -> None:
        # A stream runs in a session of its own that starts without adaptive execution.
        configure(batch.sparkSession)
        handle(batch, batch_id)

    query = (
        stream.writeStream.foreachBatch(with_settings)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def load_once(spark: SparkSession, path: str, entity: str, target: Table, manifest: str,
              rejects: Table | None = None, run_id: str = "", now: dt.datetime | None = None,
              file_schema: T.StructType | None = None, portion: int = PORTION,
              note: Callable[[int, dict], None] | None = None) -> None:
    """Load the files below ``path`` that no earlier call has loaded, whatever their age.

    The folder ``manifest`` names them. Each portion of new files is one load of the target; a load
    that a crash kept from being named is known by its rows. Rows that do not fit the schema go to
    ``rejects``. An empty or absent folder loads nothing. ``note`` is told the number of each load and
    what was seen while writing it: its rows and the newest load and creation times.
    """
    if not files.has_files(spark, path):
        if not target.exists():
            target.replace(with_row_hash(spark.createDataFrame([], RAW[entity])))
        return
    now = now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    created = CREATED.get(entity, "created")
    known = Manifest(spark, manifest, path, target)
    known.repair()
    for names in known.new_files(portion=portion):
        seen, kept = Observation(), Observation()
        checked = marked(known.rows(names, file_schema or _merged(spark, path, names)), RAW[entity])
        counted = checked.observe(seen, F.count_if(F.col("_error") != "").alias("rejected"))
        rows = with_row_hash(good_rows(counted, RAW[entity]))
        newest = F.max(created) if created in rows.columns else F.lit(None).cast("long")
        rows = rows.observe(kept, F.count(F.lit(1)).alias("rows"), F.max("loaded_at").alias("newest_loaded_at"),
                            newest.alias("newest_created"))
        number = max(target.last(), 0) + 1
        target.append(rows, number)
        if rejects is not None and observed(seen, {"rejected": 0})["rejected"] > 0:
            rejects.append(shaped(failed_rows(rejected_rows(checked), entity, run_id, now), "failed_files"), number)
        known.loaded(names, number)
        if note is not None:
            note(number, observed(kept, {"rows": 0, "newest_loaded_at": None, "newest_created": None}))


def _merged(spark: SparkSession, path: str, names: Sequence[str]) -> T.StructType:
    """The columns of all the given files, from their footers."""
    return spark.read.option("mergeSchema", "true").parquet(*(f"{path}/{n}" for n in names)).schema


def stream_bronze(stream: DataFrame, entity: str, target: Table, checkpoint: str,
                  load_mode: str = "streaming") -> None:
    """Bronze rows from a stream of RAW rows, marked with their load mode."""
    projected = bronze.MODELS[entity][1](stream.withColumn("load_mode", F.lit(load_mode)))

    def handle(batch: DataFrame, batch_id: int) -> None:
        target.append(batch, batch_id + 1)

    _drain(projected, checkpoint, handle)


def stream_upsert(stream: DataFrame, model: Callable[[DataFrame], DataFrame], target: Table,
                  checkpoint: str, order: Sequence[str] = LOAD_ORDER, newest_by: Sequence[str] = (),
                  keep: dt.timedelta = dt.timedelta(days=400)) -> None:
    """Silver from a stream: each batch runs the model and is upserted.

    The newest row per key wins whatever the order of arrival, so late files and replayed
    batches leave the same table. ``newest_by`` names the key of the stream: rows older than what
    was seen of their key, within ``keep``, then do not reach the table at all.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        target.upsert(model(batch), order)

    if newest_by:
        stream = newest_rows(with_row_hash(stream), newest_by, order, keep)
    _drain(stream, checkpoint, handle)
