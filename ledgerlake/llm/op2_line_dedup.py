"""Removal of repeated runs of lines, by content-defined chunks and by windows of lines.

A rolling hash over the hashes of two neighbouring lines decides where a chunk ends, so that
a run of lines is cut in the same places wherever it stands. A chunk has two lines at least,
the last of a document too, unless the document is one line. Chunks of several lines that occur
more than once, in one document or in many, are compared by their bytes, and all but the first
(smallest key, then place) are removed.

A chunk boundary seldom meets both ends of a passage. With ``runs``, as the query and the
pipeline ask, each line also goes that lies in a run of lines of over 50 words (parted by ASCII
white space; the first and last line have words) that occurred before, be it one line or many.
The shortest such runs from and up to each line are hashed, which covers all longer ones.
Every line that goes is kept at an earlier place. Shorter single lines are never removed, nor
are shorter runs that are no chunk.

Null texts stay null and empty texts empty. Rows with equal key and text count as one document
and get the same result; keys may be null (first in order). Ties cannot occur: the order of
chunks is total. An empty table gives an empty table. Existing columns with the names of new
ones are replaced. Chunks that share a 128-bit hash but not their bytes are not removed.

Per document the rows that are gathered are its own chunks and windows, about two a line. A chunk
that a third of all documents hold is counted with partial sums and joined by plain exchanges,
which adaptive execution splits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.base import (
    RUN_CHARS, bytes_of, fresh, identified, lean, prepare, rows_of, same_row, settle, sized, table,
    with_fields,
)

#: One neighbouring pair of lines in so many ends a chunk; least lines of a chunk.
ONE_IN, LEAST = 2, 2
#: A repeated run of lines of more than so many words goes wherever chunks end.
WORDS = 50
_BLANK = np.isin(np.arange(256), list(b" \t\n\r\x0b\x0c"))


def chunks_of(data: bytes) -> list[tuple[int, int, int, int]]:
    """(first line, line after, first byte, byte after) of each chunk."""
    lines = data.split(b"\n")
    sizes = np.fromiter(map(len, lines), dtype=np.int64, count=len(lines)) + 1
    at = np.concatenate([[0], np.cumsum(sizes)])
    ends = [len(lines)]
    if len(lines) > LEAST:
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, lines), dtype=np.uint64, count=len(lines))
        rolled = hashes[1:] + hashes[:-1] * np.uint64(0x9E3779B97F4A7C15)
        rolled ^= rolled >> np.uint64(32)
        rolled *= np.uint64(0xD6E8FEB86659FD93)
        possible = np.flatnonzero((rolled >> np.uint64(40)) % np.uint64(ONE_IN) == 0) + 2
        ends, last = [], 0
        for end in possible.tolist():
            if end - last >= LEAST and len(lines) - end >= LEAST:
                ends.append(end)
                last = end
        ends.append(len(lines))
    out, begin = [], 0
    for end in ends:
        out.append((begin, end, int(at[begin]), int(at[end]) - 1))
        begin = end
    return out


def line_starts(data: bytes) -> np.ndarray:
    """First byte of each line, and the length plus one: line i is ``data[at[i]:at[i + 1] - 1]``."""
    ends = np.flatnonzero(np.frombuffer(data, dtype="u1") == 10) + 1
    return np.concatenate([[0], ends, [len(data) + 1]])


def windows_of(data: bytes) -> list[tuple[int, int, int, int]]:
    """The shortest runs of over ``WORDS`` words from each line and up to each line that has words,
    as ``chunks_of`` gives them.

    They cover every longer run that begins and ends with such lines, so a run occurs elsewhere
    only if they do. A line that is a run by itself also goes together with the empty lines after
    it and the line that follows.
    """
    at = line_starts(data)
    n = len(at) - 1
    blank = _BLANK[np.frombuffer(data, dtype="u1")]
    blank_before = np.concatenate([[True], blank[:-1]]) if len(data) else blank
    words = np.searchsorted(np.flatnonzero(~blank & blank_before), at)  # before each line
    some = np.flatnonzero(words[1:] > words[:-1])
    after = np.searchsorted(words, words[some] + WORDS, "right")
    first = np.searchsorted(words, words[some + 1] - WORDS, "left") - 1
    whole, gap = after <= n, np.flatnonzero((after[:-1] == some[:-1] + 1) & (some[1:] > some[:-1] + 1))
    begin = np.concatenate([some[whole], first[first >= 0], some[gap]])
    end = np.concatenate([after[whole], some[first >= 0] + 1, some[gap + 1] + 1])
    begin, end = np.divmod(np.unique(begin * (n + 1) + end), n + 1)
    return list(zip(begin.tolist(), end.tolist(), at[begin].tolist(), (at[end] - 1).tolist()))


def _chunk_hashes(rows: DataFrame, key: str, rid: str, text: str, runs: bool) -> DataFrame:
    """Hashes of what may be removed: chunks, by their first line, and windows if ``runs`` asks for them."""
    kind = rows.schema[key].dataType.simpleString()

    def emit(batches):
        for batch in batches:
            owner, number, lines, digest = [], [], [], []
            for k, data in enumerate(bytes_of(batch.column(2))):
                spans = {x for x in chunks_of(data) if x[1] - x[0] >= LEAST}
                if runs:
                    spans.update(windows_of(data))
                for first, after, a, b in sorted(spans):
                    owner.append(k)
                    number.append(first)
                    lines.append(after - first)
                    digest.append(xxhash.xxh3_128_digest(data[a:b]))
            owner = pa.array(owner, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(owner), batch.column(1).take(owner), pa.array(number, pa.int32()),
                 pa.array(lines, pa.int32()), pa.array(digest, pa.binary())],
                names=["r_key", "r_rid", "chunk", "lines", "hash"])

    return rows.select(key, rid, text).mapInArrow(
        lean(emit), f"r_key {kind}, r_rid long, chunk int, lines int, hash binary")


def _unequal(rows: DataFrame, text: str, hits: str, brief: bool) -> DataFrame:
    """Hashes that stand for different contents.

    ``brief``: windows overlap, so a longer one is given by the hashes of its lines, and each
    line of a document is sent once under its own hash. Nothing found then proves that all are
    equal; otherwise some hash of a line or window, marked by a first byte, is unequal.
    """

    def emit(batches):
        for batch in batches:
            digest, content, size = [], [], 0
            for data, wanted in zip(bytes_of(batch.column(0)), batch.column(1).to_pylist()):
                at = line_starts(data).tolist()
                names: dict[int, bytes] = {}
                for hit in wanted:
                    first, after = hit["chunk"], hit["chunk"] + hit["lines"]
                    value = data[at[first]:at[after] - 1]
                    if brief and len(value) > 16 * hit["lines"]:
                        for i in range(first, after):
                            if i not in names:
                                names[i] = xxhash.xxh3_128_digest(data[at[i]:at[i + 1] - 1])
                        value = b"l" + b"".join(names[i] for i in range(first, after))
                    elif brief:
                        value = b"b" + value
                    digest.append(b"w" + hit["hash"] if brief else hit["hash"])
                    content.append(value)
                    size += len(value)
                    if size > RUN_CHARS:
                        yield _rows(digest, content)
                        digest, content, size = [], [], 0
                for name, i in {name: i for i, name in names.items()}.items():
                    digest.append(b"l" + name)
                    content.append(data[at[i]:at[i + 1] - 1])
                    size += len(content[-1])
            yield _rows(digest, content)

    def _rows(digest, content):
        return pa.RecordBatch.from_arrays([pa.array(digest, pa.binary()), pa.array(content, pa.binary())],
                                          names=["hash", "content"])

    # Of equal hashes the least and the greatest content must be the same.
    return (rows.where(F.col(hits).isNotNull()).select(text, hits).mapInArrow(lean(emit), "hash binary, content binary")
            .groupBy("hash").agg(F.min("content").alias("least"), F.max("content").alias("most"))
            .where(F.col("least") != F.col("most")).select("hash"))


def dedup_lines(docs: DataFrame, *, key: str = "doc_id", text: str = "text",
                drop_emptied: bool = False, runs: bool = False) -> DataFrame:
    """``docs`` without repeated chunks, with ``n_lines`` and ``n_removed`` (lines).

    ``runs`` also removes every repeated run of over ``WORDS`` words, wherever chunks end.
    ``drop_emptied`` leaves out documents of which nothing stayed, as each of their chunks is
    kept elsewhere.
    """
    prepare(docs.sparkSession)
    docs = docs.drop("n_lines", "n_removed")
    rid, hits = fresh(docs, "rid", "hits")
    rows = identified(docs, key, text, rid)
    # Equal rows are one document: their chunks count once.
    chunks = _chunk_hashes(rows, key, rid, text, runs).withColumn("short", F.xxhash64("hash"))
    # Most hashes occur once; they go before places are compared, by 64 bits of each.
    often = settle(chunks.groupBy("short").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("short"), "often")
    chunks = settle(chunks.join(sized(often), "short").drop("short"), "often")
    place = F.struct("r_key", "r_rid", "chunk")
    # Written, so that the join below reads plain exchanges on both sides and a hot chunk is split.
    repeated = settle(chunks.groupBy("hash").agg(F.min(place).alias("first"), F.max(place).alias("last"))
                      .where(~F.col("first").eqNullSafe(F.col("last"))).drop("last"), "repeated")
    found = (chunks.join(repeated, "hash")
             .groupBy("r_key", "r_rid")
             .agg(F.collect_set(F.struct("chunk", "lines", "hash", place.eqNullSafe(F.col("first")).alias("first")))
                  .alias(hits)))
    joined = settle(rows.join(found, same_row(rows, found, key, rid), "left").drop("r_key", "r_rid"), "lines")
    unequal = settle(_unequal(joined, text, hits, brief=True), "unequal")
    if rows_of(unequal):
        unequal = settle(_unequal(joined, text, hits, brief=False), "unequal")
    if rows_of(unequal):
        wrong = (joined.select(F.col(key).alias("r_key"), F.col(rid).alias("r_rid"), F.explode(hits).alias("h"))
                 .select("r_key", "r_rid", "h", F.col("h.hash").alias("hash")).join(unequal, "hash")
                 .groupBy("r_key", "r_rid").agg(F.collect_set("h").alias("wrong")))
        joined = (joined.join(wrong, same_row(joined, wrong, key, rid), "left")
                  .withColumn(hits, F.array_except(hits, F.coalesce("wrong", F.array()))).drop("r_key", "r_rid", "wrong"))

    def remove(batches):
        for batch in batches:
            names = batch.schema.names
            at = names.index(text)
            hit = batch.column(names.index(hits)).to_pylist()
            values = batch.column(at).to_pylist()
            total, gone = [], []
            for k, value in enumerate(values):
                total.append(0 if value is None else value.count("\n") + 1 if value else 0)
                gone.append(0)
                drop = {i for h in hit[k] or () if not h["first"] for i in range(h["chunk"], h["chunk"] + h["lines"])}
                if drop:
                    gone[k] = len(drop)
                    values[k] = b"\n".join(line for i, line in enumerate(value.encode().split(b"\n"))
                                           if i not in drop).decode()
            columns = list(batch.columns)
            columns[at] = pa.array(values, columns[at].type)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(total, pa.int64()), pa.array(gone, pa.int64())],
                                             names=[*names, "n_lines", "n_removed"])

    out = joined.mapInArrow(lean(remove), with_fields(joined, n_lines="long", n_removed="long")).drop(rid, hits)
    return out.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_lines"))) if drop_emptied else out


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), runs=True)
    return done.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
