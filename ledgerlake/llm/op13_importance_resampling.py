"""Target-distribution importance resampling of documents.

The features of a text are its runs of 1 to ``LONGEST`` words, dealt into buckets by their CRC-32.
How often a bucket occurs in all documents and in all target texts gives its gain, the logarithm
of the ratio of both shares; the array of gains scores whole batches at once. A document's score
is the sum of its features' gains plus Gumbel noise drawn from a hash of its id, so that the
highest scores are a sample without replacement by importance weight.

Scores are written once. The score of the last document drawn is found by numeric bisection: each
round counts, exactly and in one job, the rows beyond ``SECTIONS`` - 1 thresholds at once and
keeps the section that holds the cutoff. Rows that tie on it are parted the same way by id, then by
a hash of the text, then by their row number. What is drawn is dealt by range, sorted within its
partitions, and ranked by the sizes of the partitions before; no task sees more than a partition.

A null or empty text has no words, weight 0, and is never drawn, as all with fewer than
``LEAST_WORDS`` words. A null id is hashed as "null" and ties after all others. Repeated rows are
rows of their own; of equal ids and scores the less hash of the text is first, and rows equal in that too are
copies of each other. Without target texts every target count is 0. An empty table gives an empty
table. Existing columns with the names of new ones are replaced. Ids must be whole numbers.
"""

from __future__ import annotations

import math
from zlib import crc32

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.automaton import words_of
from ledgerlake.llm.base import bytes_of, fresh, lean, prepare, table, with_fields, written

LONGEST, BUCKETS, SEED = 1, 10_000, 2024
PERCENT, LEAST_WORDS = 10, 20
#: Thresholds + 1 that one counting job tries.
SECTIONS = 16
NEW = ("n_features", "weight", "score", "rank")


def features(words: list[bytes], longest: int, buckets: int) -> np.ndarray:
    """Buckets of the runs of 1 to ``longest`` words."""
    found = [np.fromiter(map(crc32, words), dtype=np.uint32, count=len(words))]
    for n in range(2, longest + 1):
        grams = [b" ".join(words[i:i + n]) for i in range(len(words) - n + 1)]
        found.append(np.fromiter(map(crc32, grams), dtype=np.uint32, count=len(grams)))
    return np.concatenate(found).astype(np.int64) % buckets


def bucket_counts(texts: DataFrame, text: str = "text", longest: int = LONGEST, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts by bucket. Each task sends one row for each bucket at most."""

    def count(batches):
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for data in bytes_of(batch.column(0)):
                if data:
                    found = features(words_of(data), longest, buckets)
                    if len(found):
                        total += np.bincount(found, minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["bucket", "n"])

    rows = (texts.select(text).mapInArrow(lean(count), "bucket long, n long").groupBy("bucket")
            .agg(F.sum("n").alias("n")).collect())  # as many rows as buckets, a parameter
    out = np.zeros(buckets, dtype=np.int64)
    for r in rows:
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln) of the ratio of the smoothed shares."""
    every, wanted, n = int(source.sum()), int(target.sum()), len(source)
    return np.array([math.floor(1000 * math.log((t + 1) * (every + n) / ((s + 1) * (wanted + n))))
                     for s, t in zip(source.tolist(), target.tolist())], dtype=np.int64)


def noise(key: Column, seed: int) -> Column:
    """floor(-1000 * ln(-ln(u))) of a u that follows from the seed and the key."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null"))), 256)
    u = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln(u))).cast("long")


def scores(docs: DataFrame, target: DataFrame, *, key: str = "doc_id", text: str = "text", target_text: str = "text",
           longest: int = LONGEST, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """``docs`` without their text, with ``n_features``, ``weight`` and ``score``; ``n_words`` and a hash of
    the text come as ``words_`` and ``hash_``, or the next free names."""
    gain = gains(bucket_counts(docs, text, longest, buckets), bucket_counts(target, target_text, longest, buckets))
    docs = docs.drop(*(c for c in NEW if c not in (key, text)))
    place = docs.columns.index(text)
    kept = [c for c in docs.columns if c != text]
    words_, hash_ = fresh(docs, "words_", "hash_")
    schema = with_fields(docs.select(*kept), n_features="long", weight="long", **{words_: "long", hash_: "long"})

    def score(batches):
        for batch in batches:
            columns = ([], [], [])
            texts = bytes_of(batch.column(place))
            for data in texts:
                words = words_of(data) if data else []
                found = features(words, longest, buckets) if words else np.empty(0, dtype=np.int64)
                for column, value in zip(columns, (len(found), int(gain[found].sum()), len(words))):
                    column.append(value)
            digests = np.array(list(map(xxhash.xxh3_64_intdigest, texts)), dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*(c for k, c in enumerate(batch.columns) if k != place), *(pa.array(c, pa.int64()) for c in columns),
                 pa.array(digests, pa.int64())], names=schema.names)

    return docs.mapInArrow(lean(score), schema).withColumn("score", F.col("weight") + noise(F.col(key), seed))


def _cutoff(rows: DataFrame, value: str, want: int) -> tuple[int, int, int]:
    """The least v of which at least ``want`` rows have a ``value`` up to v; how many have less, and how
    many up to v. ``rows`` has at least ``want`` >= 1 rows."""
    low, high = rows.agg(F.min(value), F.max(value)).first()
    low, below = low - 1, 0  # as many rows up to ``low``: fewer than wanted
    upto = None
    while high - low > 1:
        step = max(1, -(-(high - low) // SECTIONS))
        tried = [low + step * k for k in range(1, SECTIONS) if low + step * k < high]
        counts = rows.agg(*(F.sum((F.col(value) <= t).cast("long")) for t in tried)).first()
        for t, n in zip(tried, counts):
            if n < want:
                low, below = t, n
            else:
                high, upto = t, n
                break
    if upto is None:
        upto = rows.agg(F.sum((F.col(value) <= high).cast("long"))).first()[0]
    return high, below, upto


def draw(scored: DataFrame, by: list[str], want: int) -> tuple[DataFrame, DataFrame]:
    """The first ``want`` rows by the whole-number columns ``by``, ascending with nulls last, and the
    others. The last column must be unique. ``scored`` is read many times."""
    if want <= 0:
        return scored.where(F.lit(False)), scored
    tied, need = scored, want
    before, same = F.lit(False), F.lit(True)
    for value in by:
        # Nulls come last: they matter only if the rows with a value do not suffice.
        known = tied.where(F.col(value).isNotNull())
        there = known.count()
        if there < need:
            before = before | (same & F.col(value).isNotNull())
            same, need = same & F.col(value).isNull(), need - there
        elif there == need:
            before, same = before | (same & F.col(value).isNotNull()), F.lit(False)
            break
        else:
            v, less, upto = _cutoff(known, value, need)
            before = before | (same & F.coalesce(F.col(value) < v, F.lit(False)))
            same, need = same & F.col(value).eqNullSafe(F.lit(v)), need - less
            if upto - less == need:
                break
        tied = scored.where(same)
    chosen = before | same
    return scored.where(chosen), scored.where(~chosen)


def ranked(rows: DataFrame, by: list[str], rank: str) -> DataFrame:
    """``rows`` with their place, from 1, in ascending order of ``by``, nulls last."""
    order = [F.col(c).asc_nulls_last() for c in by]
    part, nth = fresh(rows, "part_", "nth_")
    in_part = F.monotonically_increasing_id()  # the partition in the upper 31 bits, the row below
    dealt = written(rows.repartitionByRange(*order).sortWithinPartitions(*order)
                    .withColumn(nth, in_part), "ranks").withColumn(part, F.shiftright(nth, 33))
    sizes = dealt.groupBy(part).agg(F.count(F.lit(1)).alias("n")).orderBy(part).collect()  # one row for each partition
    starts, total = [], 0
    for r in sizes:
        starts.append((r[part], total))
        total += r["n"]
    first = rows.sparkSession.createDataFrame(starts, "p_part long, p_first long")
    return (dealt.join(F.broadcast(first), F.col(part) == F.col("p_part"))
            .withColumn(rank, F.col("p_first") + F.col(nth).bitwiseAND(F.lit((1 << 33) - 1)) + 1)
            .drop(part, nth, "p_part", "p_first"))


def resample(docs: DataFrame, target: DataFrame, *, key: str = "doc_id", text: str = "text", target_text: str = "text",
             percent: int = PERCENT, least_words: int = LEAST_WORDS, longest: int = LONGEST, buckets: int = BUCKETS,
             seed: int = SEED) -> DataFrame:
    """``docs`` without their text, with ``n_features``, ``weight``, ``score`` and, for the ``percent`` of the
    documents of at least ``least_words`` words that are drawn, ``rank``."""
    prepare(docs.sparkSession)
    columns = [c for c in docs.columns if c != text and c not in NEW]
    words_, hash_, down, row = fresh(docs, "words_", "hash_", "down_", "row_")
    scored = written(scores(docs, target, key=key, text=text, target_text=target_text, longest=longest, buckets=buckets,
                            seed=seed).withColumns({down: -F.col("score"), row: F.monotonically_increasing_id()}), "scores")
    able = scored.where(F.col(words_) >= least_words)
    by = [down, key, hash_, row]
    chosen, others = draw(able, by, percent * able.count() // 100)
    out = ranked(chosen, by, "rank").select(*columns, *NEW)
    rest = others.unionByName(scored.where(F.col(words_) < least_words))
    return out.unionByName(rest.select(*columns, "n_features", "weight", "score", F.lit(None).cast("long").alias("rank")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return resample(docs, table(spark, sf_dir, "benchmark").select("text"))


ORACLE = rf"""
WITH polynomial AS (
    SELECT list(c ORDER BY b) AS t FROM (
        SELECT b, list_reduce(list_prepend(CAST(b AS BIGINT), [0, 0, 0, 0, 0, 0, 0, 0]),
                              lambda c, z: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END) AS c
        FROM (SELECT unnest(range(256)) AS b))
), words AS (
    SELECT 0 AS wanted, row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
    UNION ALL
    SELECT 1, -row_number() OVER (), NULL, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark
), each AS (
    SELECT wanted, r, x, count(*) AS n FROM (SELECT wanted, r, unnest(w) AS x FROM words) GROUP BY ALL
), bucket AS (
    SELECT x, xor(4294967295, list_reduce(
        list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(octet_length(encode(x))),
            lambda i: CAST('0x' || substr(hex(encode(x)), CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT))),
        lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1]))) % {BUCKETS} AS k
    FROM (SELECT DISTINCT x FROM each), polynomial
), counted AS (
    SELECT k, sum(n) FILTER (wanted = 0) AS s, sum(n) FILTER (wanted = 1) AS t FROM each JOIN bucket USING (x) GROUP BY k
), total AS (
    SELECT coalesce(sum(s), 0) AS s_all, coalesce(sum(t), 0) AS t_all FROM counted
), gain AS (
    SELECT k, floor(1000 * ln(CAST((coalesce(t, 0) + 1) * (s_all + {BUCKETS}) AS DOUBLE)
                              / CAST((coalesce(s, 0) + 1) * (t_all + {BUCKETS}) AS DOUBLE))) AS g FROM counted, total
), weighed AS (
    SELECT r, sum(n) AS n_features, CAST(sum(n * g) AS BIGINT) AS weight
    FROM each JOIN bucket USING (x) JOIN gain USING (k) WHERE wanted = 0 GROUP BY r
), scored AS (
    SELECT r, doc_id, len(w) AS n_words, CAST(coalesce(n_features, 0) AS BIGINT) AS n_features,
           CAST(coalesce(weight, 0) AS BIGINT) AS weight,
           CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('{SEED}:' || CAST(doc_id AS VARCHAR)), 1, 8)
                AS BIGINT) + 0.5) / 4294967296))) AS BIGINT) AS score
    FROM words LEFT JOIN weighed USING (r) WHERE wanted = 0
), drawn AS (
    SELECT r, row_number() OVER (ORDER BY score DESC, doc_id) AS nth, count(*) OVER () AS n FROM scored WHERE n_words >= {LEAST_WORDS}
)
SELECT doc_id, n_features, weight, score, CASE WHEN nth <= {PERCENT} * n // 100 THEN nth END AS rank
FROM scored LEFT JOIN drawn USING (r)
"""
