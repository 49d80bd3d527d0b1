"""Rows that every operator must take: nulls, empty and very long texts, ties, repeated rows."""

import random

from pyspark.sql import functions as F

LONG = " ".join(f"w{i % 997}" for i in range(40_000))


def words(seed, n, pool=400):
    rng = random.Random(seed)
    return [f"{rng.choice('abcdefgh')}{rng.randrange(pool)}" for _ in range(n)]


def text(seed, n, per_line=12):
    w = words(seed, n)
    return ".\n".join(" ".join(w[i:i + per_line]) for i in range(0, n, per_line))


def odd_texts():
    same = text(1, 120)
    return [None, "", " \n ", "one", same, same, LONG, LONG + " x", "é" * 700 + "ab", text(2, 200), text(2, 200) + " end"]


def frame(spark, texts, first=1):
    """Documents with nulls in other columns, and columns whose names operators use."""
    rows = [(i, t, None, f"src{i % 3}", None if t is None else len(t), "x", -1)
            for i, t in enumerate(texts, first)]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars int, spans string, n_tokens int")


def repeated(docs):
    return docs.unionByName(docs.where(F.col("doc_id") % 2 == 0))


def collected(df, key="doc_id"):
    return sorted((r.asDict() for r in df.collect()), key=lambda r: (r[key] is None, r[key] or 0, str(r)))
