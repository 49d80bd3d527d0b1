"""Connected components of a graph that is given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.base import settle

ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """``id`` and ``label``, the least id of its component, for every id in ``edges`` (a, b).

    Alternating large and small stars: every vertex hands its neighbours to the least of them,
    until all edges lead to the least vertex. The minimum of a vertex is taken with partial
    sums, and its neighbours are reached by a plain join, so that a vertex with very many
    neighbours is split like any hot key.
    """
    now = settle(edges.where(F.col("a") != F.col("b"))
                 .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    state = _state(now)
    for _ in range(ROUNDS):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where(F.col("v") > F.col("u")).join(least, "u").where(F.col("v") != F.col("m")) \
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = settle(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        before, state = state, _state(now)
        if state == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {ROUNDS} rounds")
    roots = now.select(F.col("v").alias("id")).distinct()
    return now.select(F.col("u").alias("id"), F.col("v").alias("label")).unionByName(
        roots.select("id", F.col("id").alias("label")))


def _state(edges: DataFrame) -> tuple:
    hashed = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(hashed), F.bit_xor(F.xxhash64(hashed))).first())
