"""Hashed logistic regression: bounded labelled samples, follow-the-regularised-leader, sparse scoring."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltatlas.llm.common import columns, map_texts, pieces

BITS = 18
DIM = 1 << BITS
# Labelled rows of each class that a model is fitted on at most, the ones with the least hash of their id.
CLASS_ROWS = 8_000
# Rows of the sample that one task learns from; the models of several tasks are averaged.
SHARD_ROWS = 4_000
EPOCHS = 4


class Leader:
    """FTRL-proximal with one learning rate a feature; the last weight is the intercept."""

    def __init__(self, alpha: float, l1: float, l2: float, beta: float = 1.0) -> None:
        self.alpha, self.l1, self.l2, self.beta = alpha, l1, l2, beta
        self.z, self.n = np.zeros(DIM + 1), np.zeros(DIM + 1)

    def weights(self, i: np.ndarray) -> np.ndarray:
        z = self.z[i]
        l1 = np.where(i == DIM, 0.0, self.l1)
        w = -(z - np.sign(z) * l1) / ((self.beta + np.sqrt(self.n[i])) / self.alpha + self.l2)
        return np.where(np.abs(z) <= l1, 0.0, w)

    def move(self, i: np.ndarray, w: np.ndarray, g: np.ndarray) -> None:
        n = self.n[i]
        new = n + g * g
        self.z[i] += g - (np.sqrt(new) - np.sqrt(n)) / self.alpha * w
        self.n[i] = new

    def learn(self, i: np.ndarray, x: np.ndarray, label: int, weight: float) -> None:
        w = self.weights(i)
        p = sigmoid(float(w @ x))
        self.move(i, w, (p - label) * weight * x)

    def level(self, i: np.ndarray, x: np.ndarray, strength: float) -> None:
        """Pull the score difference ``w @ x`` of two versions of a text towards 0."""
        w = self.weights(i)
        self.move(i, w, 2.0 * strength * float(w @ x) * x)


def sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -60, 60)))


def gathered(own: np.ndarray, idx: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, feature) pairs once each with their values summed, in order of the text."""
    key = (own.astype(np.int64) << BITS) | idx
    order = np.argsort(key, kind="stable")
    key, value = key[order], value[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    total = np.add.reduceat(value, first) if len(first) else value
    return key[first] >> BITS, key[first] & (DIM - 1), total


Features = Callable[[list[bytes]], tuple[np.ndarray, np.ndarray, np.ndarray]]


def rows_of(features: Features, values: Callable, texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Each text's features and values, with the intercept."""
    out = []
    for lo, hi in pieces(texts):
        own, idx, x = gathered(*features(texts[lo:hi]))
        cut = np.searchsorted(own, np.arange(hi - lo + 1))
        for a, b in zip(cut[:-1], cut[1:]):
            out.append((np.append(idx[a:b], DIM), np.append(values(x[a:b]), 1.0)))
    return out


def sample(labels: DataFrame, label: str, fold: Column, rows: int = CLASS_ROWS) -> DataFrame:
    """``doc_id, label`` of at most ``rows`` labelled rows of each class within ``fold``."""
    known = columns(labels, "doc_id", label).where(fold).select("doc_id", F.col(label).cast("int").alias("label"))
    known = known.where("doc_id is not null")
    few = [known.where(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows) for c in (0, 1)]
    return few[0].unionByName(few[1])


def fit(docs: DataFrame, chosen: DataFrame, train: Callable[[list[bytes], np.ndarray], np.ndarray]) -> np.ndarray:
    """Weights learned on the documents named in ``chosen``, a bounded table."""
    text = F.coalesce("text", F.lit("")).cast("binary").alias("text")
    rows = columns(docs, "doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "label", text)
    shards = max(1, -(-chosen.count() // SHARD_ROWS))
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(shards)))

    def learn(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending")])
        y = np.asarray(table.column("label").to_pylist(), np.int64)
        texts = table.column("text").to_pylist()
        order = np.random.default_rng(len(texts)).permutation(len(texts))
        w = train([texts[i] for i in order], y[order])
        return pa.table({"w": pa.array([w.astype(np.float32).tobytes()], pa.binary())})

    models = [np.frombuffer(r.w, np.float32) for r in dealt.groupBy("shard").applyInArrow(learn, "w binary").collect()]
    return np.mean(models, axis=0) if models else np.zeros(DIM + 1, np.float32)


def class_weights(y: np.ndarray) -> np.ndarray:
    """Each row's weight, so that both classes weigh the same."""
    n = np.bincount(y, minlength=2).astype(float)
    return (len(y) / 2 / np.maximum(n, 1))[y]


def scored(docs: DataFrame, weights: np.ndarray, features: Features, values: Callable, held_out: Column, cut: float = 0.3) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row; features without weight are passed over."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)  # DIM + 1 numbers

    def score(rest, texts):
        w = shared.value
        own, idx, x = features(texts)
        live = np.flatnonzero(w[idx])
        own, idx, x = gathered(own[live], idx[live], x[live])
        z = np.bincount(own, weights=w[idx] * values(x), minlength=len(texts)) + w[DIM]
        yield pa.RecordBatch.from_arrays([rest.column(0), pa.array(sigmoid(z), pa.float64())], names=["doc_id", "score"])

    out = map_texts(columns(docs, "doc_id", "text"), score, "doc_id long, score double")
    return out.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"))


def fold_of(parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts
