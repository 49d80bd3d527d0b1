"""From raw documents to packed training sequences.

Each stage works on what its predecessor kept, written as Parquet and read again. A stage that
changes texts brings ``n_chars`` up to date.

All stages but the last return the columns of their documents, also columns whose names the
operators use. Null and empty texts pass every filter
and are packed as the end mark alone; texts of any length are read whole. Repeated rows are
rows of their own, but near duplicates keep one row for each key and text that stays. Ties go to the
least key. Empty documents give empty results, empty labels a model that rejects nothing, and an
empty benchmark leaves all documents clean.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.base import prepare, settle, table
from ledgerlake.llm.op1_token_counts import vocabulary
from ledgerlake.llm.op2_line_dedup import dedup_lines
from ledgerlake.llm.op3_near_dedup import drop_near_duplicates
from ledgerlake.llm.op4_decontamination import decontaminate
from ledgerlake.llm.op6_best_fit_packing import packed_documents
from ledgerlake.llm.op10_toxicity import classify, train

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Classifiers and tokenizers have no SQL form; the tests hold the stages against brute force.
ORACLE_SQL: str | None = None

TOXIC = 0.5


def _measured(docs: DataFrame, columns: list[str]) -> DataFrame:
    kind = docs.schema["n_chars"].dataType if "n_chars" in docs.columns else None
    out = docs.withColumn("n_chars", F.length("text").cast(kind)) if kind is not None else docs
    return out.select(*columns)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain, trained on the labelled ones, rejects go."""
    chain = train(docs, table(spark, sf_dir, "labels"))
    return classify(docs, chain).where(F.col("p_toxic") < TOXIC).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Runs of lines that occurred before go, and documents of which nothing is left."""
    return _measured(dedup_lines(docs, drop_emptied=True, runs=True), docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the least id stays."""
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; documents that consist of them for the most part go."""
    return _measured(decontaminate(docs, table(spark, sf_dir, "benchmark")), docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents as pieces of sequences of at most 1024 tokens."""
    return packed_documents(docs, vocabulary()).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
