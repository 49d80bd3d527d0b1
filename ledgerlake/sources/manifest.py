"""Which landed files a table has loaded: a Parquet manifest, held against the listing.

Files are listed folder by folder as the store hands them out, a bounded number at a time, and
those that the manifest does not name are new, whatever their age. The driver holds one such
portion; the manifest is read and joined by Spark.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.sources import files
from ledgerlake.sources.tables import Table

SCHEMA = "file string, load_number long"
#: Files that are listed, and loaded, at once.
PORTION = 10_000


class Manifest:
    """The files below ``root`` that ``target`` has loaded, by their path from there."""

    def __init__(self, spark: SparkSession, path: str, root: str, target: Table):
        self.spark, self.root, self.target = spark, root.rstrip("/"), target
        self.table = Table(spark, path)

    def _relative(self, source_file) -> F.Column:
        """From what Spark says of a row's file, which may spell scheme and authority differently."""
        inner = "/" + self.root.split("://")[-1].split(":")[-1].lstrip("/") + "/"
        return F.regexp_replace(F.substring_index(source_file, inner, -1), "%20", " ")

    def repair(self) -> None:
        """Name the files of loads that a crash kept from being named, from the rows they left."""
        if not self.target.exists() or self.target.last() <= self.table.last():
            return
        rows, last = self.target.loaded_since(self.table.last())
        if last > 0:
            found = rows.select(self._relative(F.col("source_file")).alias("file")).distinct()
            self.table.append(found.filter(F.col("file").isNotNull()).withColumn("load_number", F.lit(last).cast("long")), last)

    def new_files(self, suffix: str = ".parquet", portion: int = PORTION) -> Iterator[list[str]]:
        """Files not loaded, in lists of bounded size."""
        for names in files.listed(self.spark, self.root, suffix, portion):
            if not self.table.exists():
                yield names
                continue
            listed = self.spark.createDataFrame([(n,) for n in names], "file string")
            # The portion is the small side: it is sent to the manifest, not the manifest to it.
            known = self.table.read().select("file").join(F.broadcast(listed), "file", "left_semi").distinct()
            seen = {row[0] for row in known.collect()}  # at most the portion
            if new := [n for n in names if n not in seen]:
                yield new

    def rows(self, names: list[str], schema) -> DataFrame:
        """The rows of the files, with the file each came from."""
        found = self.spark.read.schema(schema).parquet(*(f"{self.root}/{n}" for n in names))
        return found.drop("source_file").withColumn("source_file", F.col("_metadata.file_path"))

    def loaded(self, names: list[str], number: int) -> None:
        self.table.append(self.spark.createDataFrame([(n, number) for n in names], SCHEMA).coalesce(1), number)
