"""Quality rules by the frequency of lines across the documents of a host.

Each document is measured (words, symbols, repeated lines, repeated windows of three words), and its
lines are normalised (ASCII lower case, white space as one blank) and hashed to 128 bits. A line
that at least ``LEAST_DOCUMENTS`` different documents of a host hold, and more than ``SHARE`` of
them all, says nothing about a document and is removed. Documents of which less than ``LEFT`` of
the words, or fewer than ``LEAST_LEFT`` words, are left by that are depleted and rejected, and
so are those that fail the base rules: too few words, or too many in repeated windows.

Documents of a host with equal texts count as one, so that copies do not make each other's lines
frequent. A null host is a host of its own. A null or empty text has no words and fails; a line
without words is none. Repeated rows are judged one by one, alike. Texts of any length are read
whole. An empty table gives an empty table. Existing columns with the names of new ones are
replaced.

The lines of a document cross to Spark as hashes with their words, in a table written once.
Counting merges on the map side, so a line that a third of all documents hold costs a counter
for each task; what is removed is joined to the lines by broadcast while it is small, and by a
join that splits hot keys otherwise; the sums meet their documents by a row number of the table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.base import bytes_of, fresh, lean, prepare, sized, table, with_fields, written

#: Base rules: least words of a document, greatest share of words in repeated windows in percent.
LEAST_WORDS, REPEATED = 50, 50
LEAST_DOCUMENTS, SHARE = 20, 0.005
LEFT, LEAST_LEFT = 0.5, 20
#: Hosts, and frequent lines, up to which they are sent to every task; more are joined by a shuffle.
BROADCAST_LINES = 200_000

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
NEW = (*COUNTS, "n_lines", "n_frequent_lines", "n_words_left", "base_failed", "kept")
LINES = "array<struct<line:binary,words:int>>"
_SPACE = b" \t\n\r\x0b\x0c"
_SYMBOLS = b"#*$%&|<>"
_CONTINUED = bytes(range(0x80, 0xC0))


def repeated_words(words: list[bytes]) -> int:
    """Words in windows of three that occur twice or more, the first occurrences included."""
    n = len(words)
    if n < 4:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), dtype=np.int64, count=n)
    pairs = np.unique(ids[:-1] * len(known) + ids[1:], return_inverse=True)[1]
    _, place, times = np.unique(pairs[:-1] * len(known) + ids[2:], return_inverse=True, return_counts=True)
    found = times[place] > 1
    covered = np.zeros(n, dtype=bool)
    for k in range(3):
        covered[k:n - 2 + k] |= found
    return int(covered.sum())


def measured(data: bytes) -> tuple[int, ...]:
    """The counts of a text, in the order of ``COUNTS``."""
    words = data.split()
    solid = data.translate(None, _SPACE)
    lines = [line for line in data.split(b"\n") if line.strip()]
    return (len(words), len(solid.translate(None, _CONTINUED)), len(data) - len(data.translate(None, _SYMBOLS)),
            len(lines) - len(set(lines)), repeated_words(words))


def normal(line: bytes) -> bytes:
    return b" ".join(line.lower().split())


def hashed(line: bytes) -> bytes:
    return xxhash.xxh3_128_digest(line)


def lines_of(data: bytes) -> dict[bytes, int]:
    """Hashes of the different lines of a text, and their words with repeats."""
    out: dict[bytes, int] = {}
    for line in data.split(b"\n"):
        words = line.lower().split()
        if words:
            h = hashed(b" ".join(words))
            out[h] = out.get(h, 0) + len(words)
    return out


def _measured(docs: DataFrame, text: str, names: dict[str, str], keep_text: bool) -> DataFrame:
    """``docs`` with their counts, lines, text digest and row number, as a written table."""
    kept = [c for c in docs.columns if keep_text or c != text]
    place = docs.columns.index(text)
    schema = with_fields(docs.select(*kept), **{names["digest"]: "binary", **{c: "long" for c in COUNTS},
                                                names["lines"]: LINES})
    kind = pa.list_(pa.struct([("line", pa.binary()), ("words", pa.int32())]))

    def measure(batches):
        for batch in batches:
            texts = bytes_of(batch.column(place))
            counts = list(zip(*map(measured, texts))) or [()] * len(COUNTS)
            lines = [[{"line": h, "words": n} for h, n in lines_of(t).items()] for t in texts]
            yield pa.RecordBatch.from_arrays(
                [*(c for k, c in enumerate(batch.columns) if keep_text or k != place),
                 pa.array(list(map(hashed, texts)), pa.binary()), *(pa.array(c, pa.int64()) for c in counts),
                 pa.array(lines, kind)], names=schema.names)

    found = docs.mapInArrow(lean(measure), schema)
    return written(found.withColumn(names["row"], F.monotonically_increasing_id()), "quality")


def frequent_lines(rows: DataFrame, host: str, names: dict[str, str], *, least: int = LEAST_DOCUMENTS,
                   share: float = SHARE) -> DataFrame:
    """``r_host``, ``r_line`` of the lines above the limits, from a table of ``_measured``."""
    documents = rows.select(F.col(host).alias("r_host"), F.col(names["digest"]).alias("r_digest"),
                            F.col(names["lines"]).alias("r_lines"))
    totals = sized(written(documents.select("r_host", "r_digest").distinct().groupBy(F.col("r_host").alias("t_host"))
                           .agg(F.count(F.lit(1)).alias("t_documents")), "hosts"), BROADCAST_LINES)
    held = (documents.select("r_host", "r_digest", F.explode("r_lines.line").alias("r_line"))
            .distinct().groupBy("r_host", "r_line").agg(F.count(F.lit(1)).alias("r_documents"))
            .where(F.col("r_documents") >= least))
    return (held.join(totals, F.col("r_host").eqNullSafe(F.col("t_host")))
            .where(F.col("r_documents") > F.lit(share) * F.col("t_documents")).select("r_host", "r_line"))


def _judged(docs: DataFrame, text: str, host: str, keep_text: bool, least: int, share: float, left: float,
            least_left: int) -> tuple[DataFrame, dict[str, str]]:
    prepare(docs.sparkSession)
    if text not in docs.columns or host not in docs.columns:
        raise ValueError(f"documents need columns {text} and {host}")
    docs = docs.drop(*(c for c in NEW if c not in (text, host)))
    names = dict(zip(("digest", "lines", "row", "gone"), fresh(docs, "digest_", "lines_", "row_", "gone_")))
    rows = _measured(docs, text, names, keep_text)
    frequent = sized(written(frequent_lines(rows, host, names, least=least, share=share), "lines"), BROADCAST_LINES)
    held = rows.select(F.col(host).alias("h_host"), F.col(names["row"]).alias("h_row"),
                       F.explode(names["lines"]).alias("h")).select("h_host", "h_row", "h.line", "h.words")
    gone = (held.join(frequent, F.col("h_host").eqNullSafe(F.col("r_host")) & (F.col("line") == F.col("r_line")))
            .groupBy("h_row").agg(F.sum("words").alias("h_words"), F.collect_list("line").alias(names["gone"])))
    words, fewer = F.col("n_words"), F.coalesce(F.col("h_words"), F.lit(0))
    failed = (words < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEATED * words)
    depleted = (F.col("n_words_left") < least_left) | (F.col("n_words_left") < F.lit(left) * words)
    out = rows.join(gone, rows[names["row"]] == gone["h_row"], "left").withColumns({
        "n_lines": F.size(names["lines"]).cast("long"),
        "n_frequent_lines": F.coalesce(F.size(names["gone"]), F.lit(0)).cast("long"),
        "n_words_left": (words - fewer).cast("long"),
        "base_failed": failed,
    }).withColumn("kept", ~failed & ~(depleted & (fewer > 0)))
    return out, names


def quality(docs: DataFrame, *, text: str = "text", host: str = "source", least: int = LEAST_DOCUMENTS,
            share: float = SHARE, left: float = LEFT, least_left: int = LEAST_LEFT) -> DataFrame:
    """``docs`` without their text, with its counts, ``n_lines`` (different ones), ``n_frequent_lines``,
    ``n_words_left`` beside frequent lines, ``base_failed`` and ``kept``."""
    out, _ = _judged(docs, text, host, False, least, share, left, least_left)
    return out.select(*(c for c in docs.columns if c != text and c not in NEW), *NEW)


def clean(docs: DataFrame, *, text: str = "text", host: str = "source", least: int = LEAST_DOCUMENTS,
          share: float = SHARE, left: float = LEFT, least_left: int = LEAST_LEFT) -> DataFrame:
    """The kept documents, without their frequent lines."""
    out, names = _judged(docs, text, host, True, least, share, left, least_left)
    columns = [c for c in docs.columns if c not in NEW or c in (text, host)]
    found = out.where("kept").select(*columns, names["gone"])
    place, schema = columns.index(text), found.schema

    def cut(batches):
        for batch in batches:
            texts = []
            for data, gone in zip(batch.column(place).cast(pa.binary()).to_pylist(), batch.column(len(columns)).to_pylist()):
                if gone:
                    gone = set(gone)
                    data = b"\n".join([x for x in data.split(b"\n") if not x.strip() or hashed(normal(x)) not in gone])
                texts.append(data)
            field = batch.schema.field(place)
            yield batch.set_column(place, field, pa.array(texts, pa.binary()).cast(field.type))

    return found.mapInArrow(lean(cut), schema).select(*columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return quality(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                "base_failed", "kept", "n_lines", "n_frequent_lines", "n_words_left")


ORACLE = rf"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents
), split AS (
    SELECT r, doc_id, source, t, string_split(t, chr(10)) AS raw, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d
), lines AS (
    SELECT r, source, t, x AS line, i FROM (SELECT r, source, t, unnest(raw) AS x, unnest(range(1, len(raw) + 1)) AS i FROM split)
    WHERE regexp_matches(x, '[^\x20\x09-\x0D]')
), dup AS (
    SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines GROUP BY r
), windows AS (
    SELECT r, i, list_slice(w, i, i + 2) AS gram FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM split WHERE len(w) >= 3)
), often AS (
    SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS n FROM windows) WHERE n > 1
), covered AS (
    SELECT r, count(DISTINCT k) AS n_repeat_words FROM (SELECT r, unnest([i, i + 1, i + 2]) AS k FROM often) GROUP BY r
), normal AS (
    SELECT r, source, t, translate(array_to_string(regexp_extract_all(line, '[^\x20\x09-\x0D]+'), ' '),
                                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS line,
           len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words FROM lines
), frequent AS (
    SELECT source, line FROM (SELECT source, line, count(DISTINCT t) AS n FROM normal GROUP BY source, line) a
    JOIN (SELECT source AS host, count(DISTINCT t) AS total FROM d GROUP BY source) b ON source IS NOT DISTINCT FROM host
    WHERE n >= {LEAST_DOCUMENTS} AND n > CAST({SHARE} AS DOUBLE) * total
), gone AS (
    SELECT r, count(DISTINCT n.line) AS n_frequent_lines, sum(words) AS fewer
    FROM normal n JOIN frequent f ON n.line = f.line AND n.source IS NOT DISTINCT FROM f.source GROUP BY r
), counted AS (
    SELECT s.r, doc_id, CAST(len(w) AS BIGINT) AS n_words,
           CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
           CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
           CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
           CAST(coalesce((SELECT count(DISTINCT line) FROM normal n WHERE n.r = s.r), 0) AS BIGINT) AS n_lines,
           CAST(coalesce(n_frequent_lines, 0) AS BIGINT) AS n_frequent_lines, CAST(coalesce(fewer, 0) AS BIGINT) AS fewer
    FROM split s LEFT JOIN dup USING (r) LEFT JOIN covered USING (r) LEFT JOIN gone USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_frequent_lines,
       n_words - fewer AS n_words_left, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {REPEATED} * n_words AS base_failed,
       NOT (n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {REPEATED} * n_words)
       AND NOT (fewer > 0 AND (n_words - fewer < {LEAST_LEFT} OR n_words - fewer < CAST({LEFT} AS DOUBLE) * n_words)) AS kept
FROM counted
"""
