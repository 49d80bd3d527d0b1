"""Documents packed into sequences of fixed length, by bin completion (see ``packing``).

Every document becomes its token ids and the end token; a null text is an empty one, which
leaves the end token alone. Only documents longer than a sequence are cut, so that the first
piece takes the remainder. Full pieces are sequences of their own. The others are dealt into
blocks of bounded size, each block is packed by one task, and the bins that stay open are
dealt into fewer blocks again until one block is left. A hot source, many equal lengths or
repeated rows change nothing, as blocks are dealt by a hash of a row's number. Repeated rows are packed as
often as they occur. An empty table gives no rows. Other columns are carried along; new ones
replace those of the same name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.base import fresh, lean, prepare, rows_of, settle, table, texts_of, with_fields
from ledgerlake.llm.bpe import ByteBpe
from ledgerlake.llm.op1_token_counts import vocabulary
from ledgerlake.llm.packing import complete

CAPACITY, END = 1024, 2
#: Pieces that one task packs at once. Bins with this much space are packed once more.
BLOCK, OPEN = 6000, 8
FULL_IDS = 1 << 62


def pieces(docs: DataFrame, path: str, *, key: str = "doc_id", text: str = "text",
           capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """Each document's pieces: ``key``, ``piece``, ``start``, ``length`` and ``ids``
    (unsigned 32-bit, little-endian)."""
    prepare(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, piece int, start long, length long, ids binary"

    def cut(batches):
        engine = ByteBpe(path)
        for batch in batches:
            keys = batch.column(batch.schema.get_field_index(key))
            texts = texts_of(batch.column(batch.schema.get_field_index(text)))
            for lo in range(0, len(texts), 250):
                ids, counts = engine.encode(texts[lo:lo + 250])
                after = np.cumsum(counts)
                data = np.insert(ids, after, end).astype("<u4")
                n = counts + 1
                parts = -(-n // capacity)
                row = np.repeat(np.arange(len(n)), parts)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
                head = (n - capacity * (parts - 1))[row]
                start = np.where(piece == 0, 0, head + (piece - 1) * capacity)
                length = np.where(piece == 0, head, capacity)
                at = ((np.cumsum(n) - n)[row] + start) * 4
                raw = data.tobytes()
                yield pa.RecordBatch.from_arrays([
                    keys.take(pa.array(row + lo)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array([raw[a:a + 4 * m] for a, m in zip(at.tolist(), length.tolist())], pa.binary()),
                ], names=[key, "piece", "start", "length", "ids"])

    return docs.select(key, text).mapInArrow(lean(cut), schema)


def pack(items: DataFrame, *, length: str = "length", capacity: int = CAPACITY, block: int = BLOCK) -> DataFrame:
    """``items`` with ``sequence_id`` and ``offset``, in as few sequences as the search finds.

    ``items`` is read more than once and must be a written table (see ``base.settle``). Lengths
    are 1 to ``capacity``.
    """
    spark = prepare(items.sparkSession)
    items = items.drop("sequence_id", "offset")
    group, bin_, fill, salt = fresh(items, "block", "bin", "fill", "salt")
    columns = items.columns
    full = items.where(F.col(length) >= capacity).withColumns({
        "sequence_id": F.monotonically_increasing_id() + F.lit(FULL_IDS), "offset": F.lit(0).cast("long")})
    rest = items.where(F.col(length) < capacity)
    left, level, done = rows_of(rest), 0, [full]
    while left:
        blocks = max(1, -(-left // block))
        # Dealt evenly whatever the rows hold, also where they repeat. The numbers follow from the
        # written files, so a task that is repeated deals the same way.
        number = F.xxhash64(F.lit(level), F.monotonically_increasing_id())
        dealt = rest.withColumn(group, F.pmod(number, F.lit(blocks)).cast("int"))
        schema = with_fields(dealt, **{bin_: "int", "offset": "long", fill: "int"})

        def packed(part: pa.Table) -> pa.Table:
            sizes = part.column(length).to_pylist()
            queue: dict[int, list[int]] = {}
            for row, n in enumerate(sizes):
                queue.setdefault(n, []).append(row)
            number, offset, filled = ([0] * len(sizes) for _ in range(3))
            for b, bin_lengths in enumerate(complete(sizes, capacity)):
                at = 0
                for n in bin_lengths:
                    row = queue[n].pop()
                    number[row], offset[row], filled[row] = b, at, sum(bin_lengths)
                    at += n
            for name, values, kind in ((bin_, number, pa.int32()), ("offset", offset, pa.int64()),
                                       (fill, filled, pa.int32())):
                part = part.append_column(pa.field(name, kind), pa.array(values, kind))
            return part

        out = settle(dealt.groupBy(group).applyInArrow(packed, schema), "packing")
        again = F.col(fill) <= capacity - OPEN
        open_rows = rows_of(out.where(again))
        numbered = out.withColumn("sequence_id", F.lit(level << 54) + F.col(group).cast("long") * (1 << 22)
                                  + F.col(bin_).cast("long"))
        if blocks == 1 or open_rows >= left:
            done.append(numbered.select(*columns, "sequence_id", "offset"))
            break
        done.append(numbered.where(~again).select(*columns, "sequence_id", "offset"))
        rest = out.where(again).select(*columns)
        left, level = open_rows, level + 1
    result = done[0]
    for part in done[1:]:
        result = result.unionByName(part)
    return result


def packed_documents(docs: DataFrame, path: str, **options) -> DataFrame:
    """Pieces with their check sums and places."""
    cut = pieces(docs, path, **options).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return pack(settle(cut, "pieces"), capacity=options.get("capacity", CAPACITY))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_documents(table(spark, sf_dir, "documents"), vocabulary()).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
