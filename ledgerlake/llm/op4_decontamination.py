"""Benchmark decontamination by a generalised suffix automaton of the test items.

Words are runs of ASCII letters (lower-cased), digits and non-ASCII characters. The automaton
follows a document word by word and knows at each the longest ending that occurs in an item;
where that is a whole window, the words of the window are hit.

A null or empty text has no words and no hits; items without words have no windows; an item
without id is called "null". Repeated documents are judged one by one, items with the same id
count once. An empty item table leaves every document clean. Existing columns with the names
of new ones are replaced.

The items are measured first. Up to ``BLOCK_BYTES`` of them form one automaton that every task
builds; more are split into blocks of that size, which the documents pass one after another.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.automaton import WORDS, Automaton, words_of
from ledgerlake.llm.base import bytes_of, fresh, lean, prepare, settle, table, with_fields

WINDOW = 10
#: Documents of which a larger share of words is hit are dropped as a whole.
COVERAGE = 0.5
#: Text of the items in one automaton.
BLOCK_BYTES = 4 << 20
RANGES = "array<struct<first:int,after:int>>"


def _blocks(items: DataFrame, item_id: str, text: str, block_bytes: int):
    """The items, in lists of bounded size."""
    known = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("id"),
                         F.col(text).cast("binary").alias("text")).where(F.col("text").isNotNull())
    total = known.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, -(-total // block_bytes))
    if count == 1:
        yield [(r.id, bytes(r.text)) for r in known.collect()]
        return
    # Twice as many blocks as needed, as a hash deals them unevenly.
    for k in range(2 * count):
        part = known.where(F.pmod(F.xxhash64("id", "text"), F.lit(2 * count)) == k)
        yield [(r.id, bytes(r.text)) for r in part.collect()]


def find_leaks(docs: DataFrame, items: DataFrame, *, text: str = "text", item_id: str = "item_id",
               item_text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit``, ``hit_words`` (ranges of hit words) and ``hit_items``."""
    prepare(docs.sparkSession)
    found = docs.drop("n_words", "n_hit", "hit_words", "hit_items")
    schema = with_fields(found, n_words="long", n_hit="long", hit_words=RANGES, hit_items="array<string>")
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.struct([("first", pa.int32()), ("after", pa.int32())])),
             pa.list_(pa.string())]

    def scanner(part: list[tuple[str, bytes]]):
        def scan(batches):
            automaton = Automaton(part, window)
            for batch in batches:
                names = batch.schema.names
                new = ([], [], [], [])
                before = batch.column(names.index("hit_words")).to_pylist() if "hit_words" in names else None
                items_before = batch.column(names.index("hit_items")).to_pylist() if before is not None else None
                for k, data in enumerate(bytes_of(batch.column(names.index(text)))):
                    words = words_of(data)
                    ranges, ids = automaton.scan(words)
                    if before is not None:
                        ranges = _merged(ranges + [(r["first"], r["after"]) for r in before[k]])
                        ids |= set(items_before[k])
                    for column, value in zip(new, (len(words), sum(b - a for a, b in ranges),
                                                   [{"first": a, "after": b} for a, b in ranges], sorted(ids))):
                        column.append(value)
                own = [c for c in names if c not in ("n_words", "n_hit", "hit_words", "hit_items")]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(names.index(c)) for c in own), *map(pa.array, new, kinds)],
                    names=[*own, "n_words", "n_hit", "hit_words", "hit_items"])
        return scan

    for k, part in enumerate(_blocks(items, item_id, item_text, block_bytes)):
        if k:
            found = settle(found, "leaks")
        found = found.mapInArrow(lean(scanner(part)), schema)
    return found


def _merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _without(data: bytes, ranges: list[tuple[int, int]]) -> bytes:
    """A text without the words of the ranges and what lies between them."""
    at = [m.span() for m in re.finditer(rb"[^ ]+", data.translate(WORDS))]
    parts, start = [], 0
    for first, after in ranges:
        parts.append(data[start:at[first][0]])
        start = at[after - 1][1]
    return b"".join([*parts, data[start:]])


def decontaminate(docs: DataFrame, items: DataFrame, *, text: str = "text", coverage: float = COVERAGE,
                  item_id: str = "item_id", item_text: str = "text", window: int = WINDOW,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without hit words, and without documents that are hit beyond ``coverage``.

    Documents without words, null texts among them, stay as they are. Repeated rows are cut one by
    one. Empty documents or items give the documents back; other columns stay as they are. Items
    of one block are searched for and cut in one pass.
    """
    prepare(docs.sparkSession)
    columns, schema = docs.columns, docs.schema
    place = columns.index(text)
    blocks = _blocks(items, item_id, item_text, block_bytes)
    part, more = next(blocks), next(blocks, None)
    source = docs
    if more is not None:
        names = dict(zip(columns, fresh(docs, *(f"own_{n}" for n in range(len(columns))))))
        found = find_leaks(docs.withColumnsRenamed(names), items, text=names[text], item_id=item_id,
                           item_text=item_text, window=window, block_bytes=block_bytes)
        source = found.select(*(F.col(names[c]).alias(c) for c in columns), "hit_words")

    def cut(batches):
        automaton = Automaton(part, window) if more is None else None
        for batch in batches:
            field, kept, texts = batch.schema.field(place), [], []
            known = None if automaton is not None else batch.column(len(columns)).to_pylist()
            for k, value in enumerate(batch.column(place).cast(pa.binary()).to_pylist()):
                words = words_of(value or b"")
                ranges = automaton.scan(words)[0] if known is None else [(r["first"], r["after"]) for r in known[k]]
                if sum(after - first for first, after in ranges) <= coverage * len(words):
                    kept.append(k)
                    texts.append(_without(value, ranges) if ranges else value)
            rows = batch.select(columns).take(pa.array(kept, pa.int64()))
            # The field stays as it came: all batches of a task must have one schema.
            yield rows.set_column(place, field, pa.array(texts, pa.binary()).cast(field.type))

    return source.mapInArrow(lean(cut), schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_leaks(table(spark, sf_dir, "documents").select("doc_id", "text"),
                       table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


ORACLE = r"""
WITH lowered AS (
    SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
), d AS (
    SELECT doc_id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM lowered
), b AS (
    SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item,
           regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark WHERE text IS NOT NULL
), windows AS (
    SELECT DISTINCT item, least(10, len(w)) AS n, list_slice(w, i, i + least(10, len(w)) - 1) AS gram
    FROM (SELECT item, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)
), places AS (
    SELECT doc_id, n, i, list_slice(w, i, i + n - 1) AS gram
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
          FROM d, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)
), found AS (
    SELECT doc_id, n, i, item FROM places JOIN windows USING (n, gram)
), hits AS (
    SELECT doc_id, count(DISTINCT k) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM (SELECT DISTINCT doc_id, n, i FROM found)) GROUP BY doc_id
), items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
    FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""
