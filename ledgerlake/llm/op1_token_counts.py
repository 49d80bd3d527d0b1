"""Token counts of whole texts by rank-synchronous array merging (see ``bpe``).

Null and empty texts have no tokens. Texts of any length are counted whole; rows are never
merged, so repeated rows and ties stay as they are. Columns of the input whose names clash
with ``n_bytes``, ``n_tokens`` or ``over_limit`` are replaced by the new ones.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.base import fresh, prepare, table, texts_of, with_fields
from ledgerlake.llm.bpe import ByteBpe

DEFAULT_VOCABULARY = "byte_bpe_50k.json"
LIMIT = 512


def vocabulary(name: str = DEFAULT_VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def token_counts(docs: DataFrame, path: str, *, text: str = "text", limit: int = LIMIT) -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens)."""
    prepare(docs.sparkSession)
    (n,) = fresh(docs, "n_tokens")
    schema = with_fields(docs, **{n: "long"})

    def counted(batches):
        engine = ByteBpe(path)
        for batch in batches:
            counts = engine.count(texts_of(batch.column(batch.schema.get_field_index(text))))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(counts, pa.int64())],
                                             names=[*batch.schema.names, n])

    rows = docs.mapInArrow(counted, schema)
    out = rows.withColumns({
        "n_bytes": F.coalesce(F.octet_length(text), F.lit(0)).cast("long"),
        "over_limit": F.col(n) > limit,
    })
    return out if n == "n_tokens" else out.drop("n_tokens").withColumnRenamed(n, "n_tokens")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts(docs, vocabulary()).select("doc_id", "n_bytes", "n_tokens", "over_limit")
