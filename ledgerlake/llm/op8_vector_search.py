"""Exact top-k inner products by vector-approximation files.

Vectors are whole numbers, floor(256 * x) of each component. Each dimension is cut into cells of
equal width between its least and greatest value; a vector's approximation is its cells. For a
block of vectors and one of queries, the cells alone give an upper bound of each score (a lower
bound of the distance). Exact vectors are then read in the order of these bounds until the k-th
best score lies above every bound that is left.

Vectors that are null or hold null, NaN or infinite components take no part, nor do rows
without id. Rows that agree in id and vector count once; a row with the query's id is never its
result. Vectors of different length are not compared. Ties go to the smaller id. Of equal
vectors only the k + 1 smallest ids can be a result of any query, so that a vector which a third
of all rows share costs no more than others. Components must stay below 2**20 in size for exact
sums. An empty table gives an empty table, and so does one without queries; with fewer than k
candidates all are returned.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.llm.base import prepare, rows_of, settle, table

SCALE, CELLS, K, EVERY = 256, 64, 5, 50
#: Vectors and queries that one task compares; vectors read at first for a query.
BLOCK, QUERY_BLOCK, READ = 1024, 4096, 32


def _whole(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """Ids with their whole-number vectors, little-endian 64-bit."""
    usable = vectors.where(
        F.col(vec_id).isNotNull() & F.col(vector).isNotNull()
        & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))

    def emit(batches):
        for batch in batches:
            column = batch.column(1)
            flat = np.floor(SCALE * column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)).astype("<i8")
            data = flat.tobytes()
            ends = np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False)) * 8
            parts = [data[a:b] for a, b in zip([0, *ends.tolist()], ends.tolist())]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(parts, pa.binary())],
                                             names=["vec_id", "v"])

    return usable.select(vec_id, vector).mapInArrow(emit, "vec_id long, v binary").distinct()


def _ranges(whole: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Least and greatest value of each dimension, by length of vector."""

    def emit(batches):
        for batch in batches:
            by_size: dict[int, list[bytes]] = {}
            for v in batch.column(0).to_pylist():
                by_size.setdefault(len(v) // 8, []).append(v)
            for n, group in by_size.items():
                m = np.frombuffer(b"".join(group), dtype="<i8").reshape(len(group), n)
                if n:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, n)), pa.array(np.arange(n)), pa.array(m.min(0)), pa.array(m.max(0))],
                        names=["size", "at", "lo", "hi"])

    found = (whole.select("v").mapInArrow(emit, "size long, at long, lo long, hi long")
             .groupBy("size", "at").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).collect())
    out: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for r in found:
        lo, hi = out.setdefault(r["size"], (np.zeros(r["size"]), np.zeros(r["size"])))
        lo[r["at"]], hi[r["at"]] = r["lo"], r["hi"]
    return out


class Approximation:
    """Cells of one length of vector, and the bounds they give."""

    def __init__(self, lo: np.ndarray, hi: np.ndarray):
        self.lo = lo
        self.width = np.maximum(np.ceil((hi - lo + 1) / CELLS), 1.0)

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        return ((vectors - self.lo) // self.width).astype(np.uint8)

    def upper(self, cells: np.ndarray, queries: np.ndarray) -> np.ndarray:
        """No vector in the cells has a higher score. One row for each query."""
        low = self.lo + cells * self.width
        high = low + (self.width - 1)
        return np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T


def search_block(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray,
                 approximation: Approximation, k: int) -> list[tuple[int, int, int]]:
    """(query's row, vector's row, score) of the best k of this block for each query."""
    out = []
    cells = approximation.cells(vectors)
    for lo in range(0, len(queries), 256):
        bounds = approximation.upper(cells, queries[lo:lo + 256].astype(np.float64))
        for q in range(len(bounds)):
            bound, own = bounds[q], query_ids[lo + q]
            read, best = 0, []
            want = READ
            while True:
                if want < len(bound):
                    order = np.argpartition(-bound, want)[:want]
                    order = order[np.argsort(-bound[order], kind="stable")]
                    left = np.partition(-bound, want)[want] * -1  # the greatest bound not yet read
                else:
                    order, left = np.argsort(-bound, kind="stable"), -np.inf
                rows = order[ids[order] != own]
                scores = vectors[rows] @ queries[lo + q]
                top = np.lexsort((ids[rows], -scores))[:k]
                best = [(lo + q, int(rows[t]), int(scores[t])) for t in top]
                if left == -np.inf or (len(best) == k and best[-1][2] > left):
                    break
                read, want = want, want * 4
            out += best
    return out


def top_k(vectors: DataFrame, *, vec_id: str = "vec_id", vector: str = "embedding", k: int = K,
          every: int = EVERY) -> DataFrame:
    """For each row whose id is divisible by ``every``: its ``k`` best rows, with rank and score."""
    spark = prepare(vectors.sparkSession)
    whole = settle(_whole(vectors, vec_id, vector), "vectors")
    approximations = {n: Approximation(lo, hi) for n, (lo, hi) in _ranges(whole).items()}
    approximations[0] = Approximation(np.zeros(0), np.zeros(0))
    candidates = (whole.withColumn("nth", F.row_number().over(Window.partitionBy("v").orderBy("vec_id")))
                  .where(F.col("nth") <= k + 1).drop("nth"))
    queries = whole.where(F.col("vec_id") % every == 0)
    blocks = max(1, -(-rows_of(whole) // BLOCK))
    query_blocks = max(1, -(-rows_of(queries) // QUERY_BLOCK))
    size = (F.octet_length("v") / 8).cast("int")
    left = (candidates.withColumn("size", size)
            .withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
            .withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)))))
    right = (queries.withColumn("size", size)
             .withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(query_blocks)).cast("int"))
             .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))))
    shape = ["size", "block", "part"]
    schema = "query_id long, query binary, vec_id long, score long"

    def matrix(part: pa.Table, n: int) -> np.ndarray:
        return np.frombuffer(b"".join(part.column("v").to_pylist()), dtype="<i8").reshape(part.num_rows, n)

    def search(key, ours: pa.Table, theirs: pa.Table) -> pa.Table:
        n = key[0].as_py()
        found = []
        if ours.num_rows and theirs.num_rows:
            ids, query_ids = ours.column("vec_id").to_numpy(), theirs.column("vec_id").to_numpy()
            found = search_block(ids, matrix(ours, n), query_ids, matrix(theirs, n), approximations[n], k)
        q, v, score = (pa.array([f[c] for f in found], pa.int64()) for c in range(3))
        return pa.Table.from_arrays([theirs.column("vec_id").take(q), theirs.column("v").take(q),
                                     ours.column("vec_id").take(v), score],
                                    names=["query_id", "query", "vec_id", "score"])

    found = left.groupBy(*shape).cogroup(right.groupBy(*shape)).applyInArrow(search, schema)
    order = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


ORACLE = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
    FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
