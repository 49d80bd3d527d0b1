"""Toxicity by a chain of linear classifiers.

The categories of the label table are predicted one after another. Each has a logistic model
over the word beginnings of a text, and sees the log odds of the categories before it. While
training, these come from models that did not see the document (out-of-fold predictions), so
that a later model learns how far to trust the earlier ones. Only beginnings whose share among
the two classes differs beyond chance enter a model, which keeps long texts from adding up noise.

Training takes the ``SAMPLE`` labelled documents with the least hash of their key, a fixed
bound on keys and on examples; which of their features tell classes apart is counted on the cluster, and only these
features are collected. Every document is scored on its whole text. A null or empty text has no
features and gets the model's base rate. Labels that are null are left out; of repeated labels
the highest counts, of different texts with one key the least. A category without labels, or with one class only, has that class's share
as its probability. An empty table gives an empty table. Existing columns with the names of new
ones are replaced.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.base import lean, prepare, settle, table, texts_of, with_fields

CATEGORIES = ("quality", "toxic")
SAMPLE, FOLDS, STEPS = 12_000, 5, 250
#: Lengths of word beginnings; least standard deviations of a feature's share between classes.
BEGINNINGS, SIGNIFICANT = (4, 5, 6), 4.0
PENALTY = 0.05
_WORD = re.compile(r"[^\W\d_]+")
_MARK = re.compile(r"[^\w\s.,;:'\"()-]{2,4}")


def features(text: str) -> set[str]:
    """The words of a text and their beginnings, the beginnings that occur twice or three times,
    runs of marks, and whether capitals prevail."""
    words = _WORD.findall(text.lower())
    out = set(words)
    for n in BEGINNINGS:
        times = Counter([w[:n] for w in words])
        out.update(times)
        for least in (2, 3):
            out.update([f"{w}\t{least}" for w, k in times.items() if k >= least])
    out.update(_MARK.findall(text))
    if len(text) > 20 and sum(map(str.isupper, text)) * 2 > len(text):
        out.add("\tCAPITALS")
    return out


class Linear:
    """Logistic regression over sets of features and a few numbers."""

    def __init__(self):
        self.weights: dict[str, float] = {}
        self.bias, self.of_numbers = 0.0, np.empty(0)
        self.chosen, self.values = np.empty(0, dtype=np.int64), np.empty(0)

    def fit(self, sets: list[np.ndarray], names: np.ndarray, numbers: np.ndarray, y: np.ndarray) -> "Linear":
        """``sets`` hold indices into ``names``."""
        n, positive = len(y), float(y.sum())
        if not n or positive in (0.0, float(n)):
            share = min(max(positive / n if n else 0.0, 1e-6), 1 - 1e-6)
            self.bias, self.of_numbers = float(np.log(share / (1 - share))), np.zeros(numbers.shape[1])
            return self
        flat = np.concatenate([*sets, np.empty(0, dtype=np.int64)]).astype(np.int64)
        row = np.repeat(np.arange(n), [len(s) for s in sets])
        yes = np.bincount(flat, weights=y[row], minlength=len(names))
        every = np.bincount(flat, minlength=len(names))
        share = positive / n
        score = np.abs(yes - every * share) / np.sqrt(np.maximum(every, 1) * share * (1 - share))
        chosen = np.flatnonzero((score >= SIGNIFICANT) & (every >= 3))
        place = np.full(len(names), -1)
        place[chosen] = np.arange(len(chosen))
        at = place[flat]
        row, at = row[at >= 0], at[at >= 0]
        w, v, b = np.zeros(len(chosen)), np.zeros(numbers.shape[1]), float(np.log(share / (1 - share)))
        seen_w, seen_v, seen_b = np.full(len(w), 1e-6), np.full(len(v), 1e-6), 1e-6
        for _ in range(STEPS):  # gradient descent with a rate of its own for each weight
            z = b + numbers @ v + np.bincount(row, weights=w[at], minlength=n)
            e = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
            gw = np.bincount(at, weights=e[row], minlength=len(w)) + PENALTY * w
            gv, gb = numbers.T @ e + PENALTY * v, e.sum()
            seen_w, seen_v, seen_b = seen_w + gw * gw, seen_v + gv * gv, seen_b + gb * gb
            w, v, b = w - gw / np.sqrt(seen_w) / 2, v - gv / np.sqrt(seen_v) / 4, b - gb / np.sqrt(seen_b) / 4
        self.weights = {str(names[c]): float(x) for c, x in zip(chosen, w)}
        self.chosen, self.values = chosen, w
        self.bias, self.of_numbers = float(b), v
        return self

    def log_odds_indexed(self, sets: list[np.ndarray], size: int, numbers: np.ndarray) -> np.ndarray:
        """The same for sets of indices into ``size`` names."""
        every = np.zeros(size)
        every[self.chosen] = self.values
        z = np.array([every[s].sum() for s in sets]) + self.bias + numbers @ self.of_numbers
        return np.clip(z, -30, 30)

    def log_odds(self, found: set[str], numbers) -> float:
        weights = self.weights
        z = self.bias + sum(map(weights.__getitem__, weights.keys() & found))
        return float(np.clip(z + np.dot(self.of_numbers, numbers), -30, 30))


class Chain:
    """One model for each category, each fed with the log odds of those before."""

    def __init__(self, categories: tuple[str, ...]):
        self.categories, self.models = categories, []

    def fit(self, sets: list[set[str]], labels: dict[str, np.ndarray]) -> "Chain":
        """Labels are 0, 1 or NaN."""
        names = np.array(sorted(set().union(*sets)) if sets else [], dtype=object)
        number = {name: k for k, name in enumerate(names)}
        indexed = [np.fromiter(map(number.__getitem__, s), dtype=np.int64, count=len(s)) for s in sets]
        return self.fit_indexed(indexed, names, labels)

    def fit_indexed(self, indexed: list[np.ndarray], names: np.ndarray, labels: dict[str, np.ndarray]) -> "Chain":
        """The same for sets of indices into ``names``."""
        fold = np.arange(len(indexed)) % FOLDS
        before = np.empty((len(indexed), 0))
        for category in self.categories:
            y = labels[category]
            known = ~np.isnan(y)

            def model(rows: np.ndarray) -> Linear:
                return Linear().fit([indexed[i] for i in rows], names, before[rows], y[rows])

            self.models.append(model(np.flatnonzero(known)))
            out = np.empty(len(indexed))
            for k in range(FOLDS):
                held = np.flatnonzero(fold == k)
                part = model(np.flatnonzero(known & (fold != k)))
                out[held] = part.log_odds_indexed([indexed[i] for i in held], len(names), before[held])
            before = np.column_stack([before, out])
        return self

    def probabilities(self, text: str) -> list[float]:
        found, odds = features(text), []
        for model in self.models:
            odds.append(model.log_odds(found, odds))
        return [1 / (1 + float(np.exp(-z))) for z in odds]


def train(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text",
          categories: tuple[str, ...] = CATEGORIES, sample: int = SAMPLE) -> Chain:
    """A chain for ``categories``, columns of ``labels`` that hold 0 or 1."""
    prepare(docs.sparkSession)
    columns = [f"label_{k}" for k in range(len(categories))]
    known = labels.select(F.col(key).alias("r_key"), *(F.col(c).cast("double").alias(n) for c, n in zip(categories, columns))) \
        .where(F.col("r_key").isNotNull())
    drawn = settle(known.groupBy("r_key").agg(*(F.max(n).alias(n) for n in columns))
                   .orderBy(F.xxhash64("r_key"), "r_key").limit(sample), "labels")

    kinds = "".join(f", {n} double" for n in columns)

    def extract(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array([sorted(features(t)) for t in texts_of(batch.column(0))], pa.list_(pa.string())),
                 *batch.columns[1:]], names=["found", *columns])

    # One example for each key, however many rows repeat it; of different texts the least counts.
    labelled = (docs.select(key, text).join(F.broadcast(drawn), F.col(key) == F.col("r_key"))
                .groupBy("r_key", *columns).agg(F.min(text).alias("r_text")))
    rows = settle(labelled.select("r_text", *columns).mapInArrow(lean(extract), "found array<string>" + kinds), "sample")
    # Which features tell the classes of some category apart is counted where the rows are; only
    # these come to the driver.
    known_rows = rows.agg(*(F.count(n).alias(f"n_{n}") for n in columns), *(F.sum(n).alias(f"y_{n}") for n in columns)).first()
    telling = F.lit(False)
    for n in columns:
        total, positive = known_rows[f"n_{n}"], known_rows[f"y_{n}"] or 0.0
        if 0 < positive < total:
            share = positive / total
            spread = F.sqrt(F.col(f"n_{n}") * (share * (1 - share)))
            telling = telling | ((F.col(f"n_{n}") >= 3) & (
                F.abs(F.col(f"y_{n}") - F.col(f"n_{n}") * share) >= SIGNIFICANT * spread))
    chosen = (rows.select(F.explode("found").alias("feature"), *columns).groupBy("feature")
              .agg(*(F.count(n).alias(f"n_{n}") for n in columns), *(F.sum(n).alias(f"y_{n}") for n in columns))
              .where(telling).select("feature").collect())
    names = sorted(r["feature"] for r in chosen)
    number = {name: k for k, name in enumerate(names)}

    def reduced(batches):
        for batch in batches:
            found = [np.array(sorted(number[x] for x in f if x in number), dtype="<i4").tobytes()
                     for f in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), *batch.columns[1:]],
                                             names=["found", *columns])

    # In the same order, and so the same folds, however the rows came.
    small = rows.mapInArrow(lean(reduced), "found binary" + kinds).orderBy("found", *columns).toArrow()
    indexed = [np.frombuffer(f, dtype="<i4") for f in small.column("found").to_pylist()]
    values = {c: small.column(n).to_numpy(zero_copy_only=False).astype(float) for c, n in zip(categories, columns)}
    return Chain(categories).fit_indexed(indexed, np.array(names, dtype=object), values)


def classify(docs: DataFrame, chain: Chain, *, text: str = "text", prefix: str = "p_") -> DataFrame:
    """``docs`` with the probability of each category."""
    prepare(docs.sparkSession)
    names = [prefix + c for c in chain.categories]
    docs = docs.drop(*names)

    def score(batches):
        for batch in batches:
            texts = texts_of(batch.column(batch.schema.get_field_index(text)))
            found = np.array([chain.probabilities(t) for t in texts]).reshape(len(texts), len(names))
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(found[:, k]) for k in range(len(names)))],
                                             names=[*batch.schema.names, *names])

    return docs.mapInArrow(lean(score), with_fields(docs, **{n: "double" for n in names}))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    chain = train(docs, table(spark, sf_dir, "labels"))
    return classify(docs, chain).select("doc_id", "p_quality", "p_toxic", (F.col("p_toxic") >= 0.5).alias("toxic"))
