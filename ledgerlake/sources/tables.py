"""Plain Parquet tables with append, full refresh and upsert.

An appended table has one folder for each load, ``load=N``, or ``load=M-N`` for several that were
rewritten together; a full refresh writes ``base=N``, which stands for all loads up to N. A folder
counts once Spark has finished it (``_SUCCESS``), and one that lies within another no longer
does, so a failed or repeated job leaves no trace. The number of a load is its identity: a batch
that comes again finds its folder and is skipped.

A keyed table deals its rows over hash buckets of the key, below a folder for each period where
the key fixes the date. The buckets of a batch follow from its keys: an upsert reads and
overwrites their folders and no others, with Spark's dynamic partition overwrite. Stored and
incoming rows are shuffled once for that, by folder and slice of the key, which is both where
a key is decided and where its file is written; large ones a group of buckets after the other. One
failed between two groups is to be taken again, which ends alike. One writer per table at a time. Formats with row-level MERGE are served by ``upsert_by_catalog``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.operators.dedup import LOAD_ORDER, dedup_latest, newest_first
from ledgerlake.operators.incremental import evolve
from ledgerlake.operators.layout import along_curve
from ledgerlake.operators.lookup import semi_join
from ledgerlake.session import materialize, observed, work_dir
from ledgerlake.sources import files

PART, BUCKET, SLICE = "table_part", "key_bucket", "key_slice"
#: Tasks that rewrite the rows of one bucket.
SLICES = 4
#: Bytes of stored and incoming files that are rewritten at once, in whole buckets.
PORTION = 1 << 30
#: Ids, paths and texts repeat in these tables; files are about a third smaller than by default.
COMPRESSION = "zstd"
LOADED_AT = "loaded_at"
GRAINS = {"day": "yyyy-MM-dd", "month": "yyyy-MM", "year": "yyyy"}


class Table:
    """A table at ``path``.

    ``keys`` make it a keyed table of ``buckets`` buckets, which is fixed for its life: about its
    size over that of a file. ``part_by`` names a date column that a key can never change, and
    ``grain`` the length of a part. ``cluster_by`` orders rows inside files, which keeps the
    min/max statistics of those columns narrow; ``rebalance`` shuffles them together first.
    ``curve_by`` orders an appended table along a space-filling curve instead, into ``files`` files
    or as many as its size asks for, so that a filter on any of the columns opens few of them.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str] = (), buckets: int = 16,
                 part_by: str | None = None, grain: str = "month", cluster_by: Sequence[str] = (),
                 rebalance: bool = True, curve_by: Sequence[str] = (), files: int | None = None):
        self.spark = spark
        self.path = path.rstrip("/")
        self.keys = list(keys)
        self.buckets = buckets
        self.part_by = part_by
        self.grain = grain
        self.cluster_by = list(cluster_by)
        self.rebalance = rebalance
        self.curve_by = list(curve_by)
        self.files = files
        self.rows_written = 0

    # --- folders ------------------------------------------------------------------------

    def _folders(self) -> list[tuple[int, int, str]]:
        """(first load, last load, name) of the folders that make up the table."""
        found = []
        for name in files.finished(self.spark, self.path):
            kind, _, numbers = name.partition("=")
            first, _, last = numbers.partition("-")
            found.append((-1 if kind == "base" else int(first), int(last or first), name))
        # The widest of those that end at a load is the one that counts.
        found.sort(key=lambda f: (-f[1], f[0]))
        kept, reach = [], None
        for first, last, name in found:
            if reach is None or last < reach:
                kept.append((first, last, name))
                reach = first
        return kept[::-1]

    def last(self) -> int:
        """The number of the newest load; -1 before the first."""
        return max((last for _, last, _ in self._folders()), default=-1)

    def exists(self) -> bool:
        return bool(self._folders())

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromJson(files.read_json(self.spark, f"{self.path}/_schema.json"))

    def _keep_schema(self, schema: T.StructType) -> None:
        file = f"{self.path}/_schema.json"
        plain = T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])
        if not files.exists(self.spark, file) or self.schema != plain:
            files.write_json(self.spark, file, plain.jsonValue())

    def applied(self, source: str = "") -> int:
        """The number of the last batch taken (of one of several sources); -1 before the first."""
        if not self.keys:
            return self.last()
        taken = (n.rpartition("=") for n in files.children(self.spark, f"{self.path}/_taken"))
        return max((int(number) for name, _, number in taken if name == source), default=-1)

    def took(self, batch: int | None, source: str = "") -> None:
        """Note that a keyed table has taken a batch."""
        if batch is not None:
            files.write_json(self.spark, f"{self.path}/_taken/{source}={batch}", {})

    def forget(self) -> None:
        """Take no batch as taken: what is built on it starts anew."""
        files.remove(self.spark, f"{self.path}/_taken")

    def newest(self) -> dt.datetime | None:
        """The newest ``loaded_at``; None if there is none."""
        return self.read().agg(F.max(LOADED_AT)).first()[0] if self.exists() else None

    # --- read ---------------------------------------------------------------------------

    def _load(self, schema: T.StructType, folders: Sequence[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema)
        found = self.spark.read.schema(schema).parquet(*(f"{self.path}/{f}" for f in folders))
        return found.select(*schema.names)

    def read(self) -> DataFrame:
        found = self._folders()
        if not found:
            raise FileNotFoundError(f"no table at {self.path}")
        return self._load(self.schema, [name for _, _, name in found])

    def read_or_none(self) -> DataFrame | None:
        return self.read() if self.exists() else None

    def loaded_since(self, number: int) -> tuple[DataFrame | None, int]:
        """The loads after ``number``, and the newest of them; None if there are none.

        What counts is the load that rows came with, not any time inside them, so late rows and
        rows with equal times are neither lost nor read twice.
        """
        found = self._folders()
        if not found:
            raise FileNotFoundError(f"no table at {self.path}")
        new = [(last, name) for _, last, name in found if last > number]
        if not new:
            return None, number
        return self._load(self.schema, [name for _, name in new]), new[-1][0]

    def rows_of(self, keys: DataFrame, different: bool = False) -> DataFrame:
        """The rows whose key occurs in ``keys``, which may be known to be ``different``. Only the buckets that these keys fall into are read."""
        if not self.keys or self.part_by:
            stored = self.read()
        else:
            wanted = keys.select(self._place()[BUCKET].alias(BUCKET)).distinct().collect()  # bounded by the buckets
            base = self._folders()[-1][2]
            folders = [f"{base}/{BUCKET}={r[0]}" for r in wanted]
            stored = self._load(self.schema, [f for f in folders if files.exists(self.spark, f"{self.path}/{f}")])
        return semi_join(stored, keys, {k: k for k in self.keys}, different=different)

    # --- write --------------------------------------------------------------------------

    def _place(self) -> dict:
        """The folder columns of a keyed table."""
        out = {}
        if self.part_by:
            out[PART] = F.coalesce(F.date_format(self.part_by, GRAINS[self.grain]), F.lit("none"))
        if self.keys:
            out[BUCKET] = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        return out

    def _dealt(self, df: DataFrame) -> DataFrame:
        """The rows by folder and slice of the key, which stand in columns."""
        place = self._place() | {SLICE: F.pmod(F.shiftright(F.xxhash64(*self.keys), 24), F.lit(SLICES)).cast("int")}
        return df.withColumns(place).repartition(*place)

    def _write(self, df: DataFrame, folder: str, mode: str = "static", dealt: bool = False) -> None:
        seen = Observation()
        df = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        self._store(df, folder, mode, self._place(), dealt)
        self.rows_written = observed(seen, {"rows": 0})["rows"]

    def _store(self, df: DataFrame, folder: str, mode: str, place: dict, dealt: bool) -> None:
        if place:
            # Rebalancing splits an oversized folder over several tasks and merges small ones.
            laid_out = df.drop(SLICE) if dealt else df.withColumns(place).hint("rebalance", *place)
            laid_out = laid_out.sortWithinPartitions(*place, *self.cluster_by)
            (laid_out.write.partitionBy(*place).mode("overwrite").option("compression", COMPRESSION)
             .option("partitionOverwriteMode", mode).parquet(f"{self.path}/{folder}"))
            return
        if self.curve_by:
            df = along_curve(df, self.curve_by, self.files)
        elif self.cluster_by:
            moved = df.hint("rebalance", self.cluster_by[0]) if self.rebalance else df
            df = moved.sortWithinPartitions(*self.cluster_by)
        df.write.mode("overwrite").option("compression", COMPRESSION).parquet(f"{self.path}/{folder}")

    def replace(self, df: DataFrame, batch: int | None = None) -> None:
        """Full refresh. What was there before can be read until ``drop_replaced``."""
        self._write(df, f"base={self.last() + 1}")
        self._keep_schema(df.schema)
        self.took(batch)

    def append(self, df: DataFrame, batch: int | None = None) -> bool:
        """Add rows as one load; new columns are added, missing ones stay NULL.

        ``batch`` is a growing number above 0. One already loaded is skipped, which makes a replayed
        stream batch harmless. Returns whether it wrote.
        """
        last = self.last()
        if batch is not None and batch <= last:
            return False
        schema = df.schema
        if last >= 0:
            old, df = evolve(self.spark.createDataFrame([], self.schema), df, "append_new_columns")
            schema = old.schema
        self._write(df, f"load={max(last, 0) + 1 if batch is None else batch}")
        self._keep_schema(schema)
        return True

    def upsert(self, updates: DataFrame, order: Sequence[str] = LOAD_ORDER,
               schema_change: str = "sync_all_columns", batch: int | None = None) -> None:
        """Insert new keys and replace known ones by the newest row, by ``order``.

        An update older than the stored row changes nothing; on a tie the update wins. Taking a
        ``batch`` again leaves the same table; one known to be taken is skipped.
        """
        if batch is not None and batch <= self.applied():
            return
        if not self.exists():
            self.replace(dedup_latest(updates, self.keys, order), batch)
            return

        def merged(stored: DataFrame, new: DataFrame) -> DataFrame:
            old, new = evolve(stored, new, schema_change)
            both = old.withColumn("_incoming", F.lit(0)).unionByName(new.withColumn("_incoming", F.lit(1)))
            # Both hold a key once, so no task gets many rows of one.
            newest = Window.partitionBy(*self._place(), SLICE, *self.keys).orderBy(*newest_first(both, (*order, "_incoming")))
            ranked = self._dealt(both).withColumn("_rank", F.row_number().over(newest))
            return ranked.filter(F.col("_rank") == 1).drop("_incoming", "_rank")

        old, new = evolve(self.spark.createDataFrame([], self.schema), updates, schema_change)
        new = new.withColumn("_incoming", F.lit(1)).select(*old.columns, "_incoming")
        newest = dedup_latest(new, self.keys, (*order, "_incoming")).drop("_incoming")
        self._rewrite(newest, old.schema, merged)
        self.took(batch)

    def swap(self, gone: DataFrame, rows: DataFrame, batch: int | None = None, written: bool = False) -> None:
        """Put ``rows`` in the place of all rows whose key occurs in ``gone`` or in ``rows``.

        ``written`` tells that both are read from files outside the table, so that they need not be staged.
        """
        if batch is not None and batch <= self.applied():
            return
        if not self.exists():
            self.replace(rows, batch)
            return
        if self.part_by:
            raise ValueError("rows are swapped by key alone; the table has parts")
        both = gone.select(*self.keys).withColumn("_gone", F.lit(True)).unionByName(
            rows.withColumn("_gone", F.lit(False)), allowMissingColumns=True)

        def merged(stored: DataFrame, new: DataFrame) -> DataFrame:
            # A key of many rows is dropped by one of them. NULL is a key like any other.
            both = stored.withColumn("_gone", F.lit(None).cast("boolean")).unionByName(
                new.select(*stored.columns, "_gone"))
            same_key = Window.partitionBy(*self._place(), SLICE, *self.keys)
            named = self._dealt(both).withColumn("_named", F.count("_gone").over(same_key) > 0)
            return named.filter(F.when(F.col("_gone").isNull(), ~F.col("_named")).otherwise(~F.col("_gone"))).drop("_gone", "_named")

        self._rewrite(both, rows.schema, merged, written)
        self.took(batch)

    def _rewrite(self, incoming: DataFrame, schema: T.StructType,
                 merge: Callable[[DataFrame, DataFrame], DataFrame], written: bool = False) -> None:
        """Overwrite the folders that ``incoming`` falls into by ``merge`` of their rows and it."""
        place = self._place()
        base = self._folders()[-1][2]
        # The rows are read twice below; evaluate what produces them once.
        staged = work_dir(self.spark, "upsert")
        try:
            if not written:
                incoming = materialize(incoming, staged, self.spark, COMPRESSION)
            parts = incoming.select(*(c.alias(n) for n, c in place.items())).distinct().collect()  # one row per folder
            touched = ["/".join(f"{n}={row[n]}" for n in place) for row in parts]
            known = [f"{base}/{f}" for f in touched if files.exists(self.spark, f"{self.path}/{base}/{f}")]
            before = {f: files.children(self.spark, f"{self.path}/{f}") for f in known}
            if touched:
                count, portions = 0, self._portions({row[BUCKET] for row in parts}, known, incoming)
                for buckets in portions:
                    chosen = [f for f in known if int(f.rpartition("=")[2]) in buckets]
                    new = incoming if len(portions) == 1 else incoming.filter(place[BUCKET].isin(buckets))
                    self._write(merge(self._load(self.schema, chosen), new), base, "dynamic", True)
                    count += self.rows_written
                self.rows_written = count
                for folder, names in before.items():  # one that is empty now was not overwritten
                    if files.children(self.spark, f"{self.path}/{folder}") == names:
                        files.remove(self.spark, f"{self.path}/{folder}")
                self._keep_schema(schema)
        finally:
            files.remove(self.spark, staged)

    def _portions(self, buckets: set[int], known: Sequence[str], incoming: DataFrame) -> list[list[int]]:
        """The buckets in groups of about ``PORTION`` bytes, so that what is shuffled at once does not grow with the table."""
        size = sum(files.size(self.spark, f"{self.path}/{f}") for f in known)
        size += sum(files.size(self.spark, f) for f in incoming.inputFiles())
        each = max(1, -(-len(buckets) // max(1, -(-size // PORTION))))
        found = sorted(buckets)
        return [found[n:n + each] for n in range(0, len(found), each)]

    # --- upkeep -------------------------------------------------------------------------

    def compact(self, upto: int | None = None, fan: int = 16) -> bool:
        """Rewrite single loads together, ``fan`` at least; each row is so rewritten once.

        Only loads up to ``upto`` are, those that every reader of ``loaded_since`` has taken.
        """
        ready = [(last, name) for first, last, name in self._folders()
                 if first == last and (upto is None or last <= upto)]
        if self.keys or len(ready) < fan:
            return False
        self._write(self._load(self.schema, [name for _, name in ready]), f"load={ready[0][0]}-{ready[-1][0]}")
        return True

    def drop_replaced(self) -> None:
        """Delete folders that others stand for. No reader may still use them."""
        current = {name for _, _, name in self._folders()}
        for name in files.finished(self.spark, self.path):
            if name not in current:
                files.remove(self.spark, f"{self.path}/{name}")


def upsert_by_catalog(updates: DataFrame, table: str, keys: Sequence[str], order: str = "loaded_at") -> None:
    """The same upsert for a catalog table whose format supports row-level MERGE."""
    same = [F.col(f"target.{k}") == F.col(f"source.{k}") for k in keys]
    condition = same[0]
    for part in same[1:]:
        condition = condition & part
    newer = F.col(f"source.{order}") >= F.col(f"target.{order}")
    (
        dedup_latest(updates, keys).alias("source")
        .mergeInto(table, condition)
        .whenMatched(newer).updateAll()
        .whenNotMatched().insertAll()
        .merge()
    )
