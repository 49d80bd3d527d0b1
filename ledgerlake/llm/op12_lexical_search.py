"""Ranked lexical search over all documents by bags of the items' words.

Terms are runs of ASCII letters (lower-cased), digits and non-ASCII characters. A document is
restricted to the terms of the items: its bag is the sorted numbers of these terms with their
frequencies. Documents with the same bag and the same length norm m have the same score for every
item, so they form a class: bags are dealt by a hash of bag and m, and within it told apart by
their bytes. Each class is scored once, against all items at a time through the items' postings;
then its members come into the ranking by ascending id. No more than the ``k`` least ids of a
class can be a result of any item, so no more travel, however large a class is.

Weights and scores are whole numbers, exact in 64 bits. A null or empty text has no terms; such a
document counts for nothing, and such an item has no results. Each row of ``docs`` is a document,
so repeated rows have places of their own; equal scores are ordered by id, null ids last. Items
that agree in id and text count once; items with one id and different texts are ranked one by one.
An empty table gives an empty table. Of other columns none is read.

Items are measured first: up to ``BLOCK_BYTES`` of their text go to the tasks at once, more go in
blocks, one pass over the documents for each.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.llm.automaton import words_of
from ledgerlake.llm.base import bytes_of, lean, prepare, ragged, table, written

K = 10
#: Parameters of the length norm: m = 100 - NORM + (NORM * n * N) div L; and of the saturation.
NORM, SATURATION = 90, 8
#: Text of the items that are searched for at once; scores that a task holds at once.
BLOCK_BYTES, CELLS = 4 << 20, 1 << 20


class Items:
    """A block of items: the numbers of their terms, and for each term the items that hold it."""

    def __init__(self, texts: list[bytes]):
        self.number: dict[bytes, int] = {}
        pairs = []
        for i, text in enumerate(texts):
            pairs += [(self.number.setdefault(w, len(self.number)), i) for w in sorted(set(words_of(text)))]
        self.size, self.terms = len(texts), len(self.number)
        held = np.array(sorted(pairs), dtype=np.int64).reshape(-1, 2)
        self.items = np.ascontiguousarray(held[:, 1])
        self.starts = np.searchsorted(held[:, 0], np.arange(self.terms + 1))

    def bag(self, words: list[bytes]) -> np.ndarray:
        """Numbers of the known terms in ascending order, each followed by its frequency."""
        known = self.number
        found = np.array([known[w] for w in words if w in known], dtype="<i4")
        terms, times = np.unique(found, return_counts=True)
        out = np.empty(2 * len(terms), dtype="<i4")
        out[::2], out[1::2] = terms, times
        return out


def scores(bags: list[bytes], norms: np.ndarray, weights: np.ndarray, items: Items) -> np.ndarray:
    """Score of each bag (row) for each item (column)."""
    flat = np.frombuffer(b"".join(bags), dtype="<i4").reshape(-1, 2)
    row = np.repeat(np.arange(len(bags)), np.fromiter(map(len, bags), dtype=np.int64, count=len(bags)) // 8)
    term, times = flat[:, 0].astype(np.int64), flat[:, 1].astype(np.int64)
    part = weights[term] * ((1_000_000_000 * times) // (1000 * times + SATURATION * norms[row]))
    lengths = items.starts[term + 1] - items.starts[term]
    place = np.repeat(row, lengths) * items.size + items.items[ragged(items.starts[term], lengths)]
    out = np.zeros(len(bags) * items.size, dtype=np.int64)
    np.add.at(out, place, np.repeat(part, lengths))
    return out.reshape(len(bags), items.size)


class Best:
    """The k best (score, id) for each item so far, from classes with their least ids."""

    def __init__(self, size: int, k: int):
        self.k = k
        self.least = np.ones(size, dtype=np.int64)  # scores below cannot be results
        self.found: list[list[tuple[int, bool, int]]] = [[] for _ in range(size)]

    def add(self, values: np.ndarray, members: list[list]) -> None:
        rows, columns = np.nonzero(values >= self.least)
        order = np.argsort(columns, kind="stable")
        rows, columns = rows[order], columns[order]
        ends = np.searchsorted(columns, np.arange(values.shape[1] + 1))
        for item in np.unique(columns).tolist():
            mine = rows[ends[item]:ends[item + 1]]
            got = values[mine, item]
            if len(mine) > self.k:  # the k-th best score of these, and all that reach it
                reach = -np.partition(-got, self.k - 1)[self.k - 1]
                mine, got = mine[got >= reach], got[got >= reach]
            held = self.found[item] + [(-s, m is None, m or 0) for r, s in zip(mine.tolist(), got.tolist()) for m in members[r]]
            held.sort()
            self.found[item] = held[:self.k]
            if len(held) >= self.k:
                self.least[item] = -held[self.k - 1][0]


def _blocks(items: DataFrame, item_id: str, text: str, block_bytes: int):
    """Distinct items with a text, in lists of (id, text) of bounded size."""
    known = items.select(F.col(item_id).alias("id"), F.col(text).cast("binary").alias("text")) \
        .where(F.octet_length("text") > 0).distinct()
    total = known.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = -(-total // block_bytes)
    # Twice as many blocks as needed, as a hash deals them unevenly.
    for k in range(2 * count if count > 1 else count):
        part = known.where(F.pmod(F.xxhash64("id", "text"), F.lit(2 * count)) == k) if count > 1 else known
        rows = part.collect()  # bounded by the block
        if rows:
            yield sorted(((r.id, bytes(r.text)) for r in rows), key=lambda r: (r[0] is None, str(r[0]), r[1]))


def _bags(docs: DataFrame, key: str, text: str, items: Items) -> DataFrame:
    """``id``, number of terms ``n`` and ``bag`` of each document that has a term."""

    def restrict(batches):
        for batch in batches:
            words = [words_of(t) if t else [] for t in bytes_of(batch.column(1))]
            some = [k for k, w in enumerate(words) if w]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(some, pa.int64())), pa.array([len(words[k]) for k in some], pa.int64()),
                 pa.array([items.bag(words[k]).tobytes() for k in some], pa.binary())], names=["id", "n", "bag"])

    return docs.select(F.col(key).cast("long").alias("id"), text).mapInArrow(lean(restrict), "id long, n long, bag binary")


def _frequencies(bags: DataFrame, terms: int) -> np.ndarray:
    """In how many documents each term occurs. Each task sends one row for each term at most."""

    def count(batches):
        total = np.zeros(terms, dtype=np.int64)
        for batch in batches:
            flat = np.frombuffer(b"".join(batch.column(0).to_pylist()), dtype="<i4")
            total += np.bincount(flat[::2], minlength=terms)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["term", "df"])

    out = np.zeros(terms, dtype=np.int64)
    for r in bags.select("bag").mapInArrow(lean(count), "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        out[r.term] = r.df  # as many rows as the block has terms
    return out


def _classes(bags: DataFrame, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """``bag``, ``m`` and the ``k`` least ids of each class. The hash deals them; the bytes decide."""
    m = F.expr(f"cast({100 - NORM} + ({NORM} * n * {n_docs}L) div {n_terms}L as long)")
    hashed = bags.where(F.octet_length("bag") > 0).select(
        F.xxhash64("bag", m).alias("h"), m.alias("m"), "bag", "id")
    alike = Window.partitionBy("h", "m", "bag").orderBy(F.col("id").asc_nulls_last())
    # The window limits a class to k rows before the shuffle, in each task.
    least = hashed.withColumn("nth", F.row_number().over(alike)).where(F.col("nth") <= k)
    # Structs, as a null id is an id too.
    return least.groupBy("h", "m", "bag").agg(F.collect_list(F.struct("nth", "id")).alias("members")) \
        .select("bag", "m", F.expr("transform(array_sort(members), x -> x.id)").alias("members"))


def search(docs: DataFrame, items: DataFrame, *, key: str = "doc_id", text: str = "text", item_id: str = "item_id",
           item_text: str = "text", k: int = K, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The ``k`` best documents of each item: ``item_id``, ``rank``, ``doc_id`` and ``score``."""
    spark = prepare(docs.sparkSession)
    kind = items.schema[item_id].dataType
    schema = T.StructType([T.StructField("item_id", kind), T.StructField("rank", T.IntegerType()),
                           T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())])
    out = spark.createDataFrame([], schema)
    for block in _blocks(items, item_id, item_text, block_bytes):
        out = out.unionByName(_search_block(docs, block, key, text, k, kind))
    return out


def _search_block(docs: DataFrame, block: list, key: str, text: str, k: int, kind: T.DataType) -> DataFrame:
    spark, items = docs.sparkSession, Items([t for _, t in block])
    bags = written(_bags(docs, key, text, items), "bags")
    n_docs, n_terms = bags.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    if not n_docs or not items.terms:
        return spark.createDataFrame([], T.StructType([T.StructField("item_id", kind), *T._parse_datatype_string(
            "rank int, doc_id long, score long").fields]))
    df = _frequencies(bags, items.terms)
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * f + 1))) for f in df.tolist()], dtype=np.int64)
    rows = max(1, CELLS // items.size)

    def rank(batches):
        best = Best(items.size, k)
        for batch in batches:
            for lo in range(0, batch.num_rows, rows):
                part = batch.slice(lo, rows)
                values = scores(part.column(0).to_pylist(), part.column(1).to_numpy(zero_copy_only=False), weights, items)
                best.add(values, part.column(2).to_pylist())
        found = [(i, None if empty else doc, -s) for i, held in enumerate(best.found) for s, empty, doc in held]
        yield pa.RecordBatch.from_arrays([pa.array([f[c] for f in found], pa.int64()) for c in range(3)],
                                         names=["item", "doc_id", "score"])

    found = _classes(bags, n_docs, n_terms, k).mapInArrow(lean(rank), "item long, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    named = spark.createDataFrame(list(enumerate(i for i, _ in block)), T.StructType([
        T.StructField("item", T.LongType()), T.StructField("item_id", kind)]))
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .join(F.broadcast(named), "item").select("item_id", "rank", "doc_id", "score"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


ORACLE = rf"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), sizes AS (
    SELECT r, doc_id, len(w) AS n FROM d WHERE len(w) > 0
), every AS (
    SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sizes
), items AS (
    SELECT item_id, text, unnest(list_distinct(regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'))) AS term
    FROM (SELECT DISTINCT item_id, text FROM benchmark)
), held AS (
    SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d) GROUP BY r, term
), weights AS (
    SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
    FROM held, every WHERE term IN (SELECT term FROM items) GROUP BY term, docs
), scored AS (
    SELECT item_id, text, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + {SATURATION} * (
        {100 - NORM} + ({NORM} * n * docs) // terms)))) AS BIGINT) AS score
    FROM items JOIN weights USING (term) JOIN held USING (term) JOIN sizes USING (r), every GROUP BY item_id, text, r, doc_id
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id) AS INTEGER) AS rank
    FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= {K}
"""
