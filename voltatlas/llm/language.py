"""Language identification by nearest centroids of TF-IDF vectors.

A text is its runs of one to three bytes within words, a blank on either side of a
word included, hashed into buckets.  Counts are damped, weighed by rarity and brought
to length one.  The learned texts of each language are clustered into a few centroids
on the sphere; a text has the language of the centroid it is nearest to by cosine,
and is rejected where it lies further out than the texts of that centroid do.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltatlas.llm import arrays as A
from voltatlas.llm.common import columns, map_texts, pieces, ready, written
from voltatlas.llm.linear import fold_of

BITS = 15
DIM = 1 << BITS
# Learned texts of each language that are clustered at most, the ones with the least hash of their id and text.
LANG_ROWS = 1_000
CENTROIDS, ROUNDS = 4, 10
# Groups in which a language's least hashes are picked first.
SALTS = 64
# A centroid's radius: the distance that so many of 1,000 of its texts keep within, and how much wider it reaches.
INSIDE, WIDER = 990, 1.25
UNKNOWN = "und"

_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def counts(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, bucket, count) of all runs of one to three bytes, in order of text and bucket."""
    buf, begin = A.joined(texts)
    low = np.concatenate([[np.uint8(32)], A.LOWER[buf]])
    # Capitals of the Latin-1 letters: their second byte.
    second = (low[1:] >= 0x80) & (low[1:] <= 0x9E) & (low[1:] != 0x97) & (low[:-1] == 0xC3)
    low[1:][second] += 0x20
    gap = ~_LETTER[low]
    low[gap] = 32
    keep = ~gap
    keep[1:] |= ~gap[:-1]
    keep[0] = True
    at = np.flatnonzero(keep) - 1  # place in the buffer
    c, gap = low[keep].astype(A.U), gap[keep]
    own = A.owner(begin, np.maximum(at, 0))
    found, owners = [c], [own]
    ok = [~gap]
    if len(c) > 1:
        found.append(c[1:] | c[:-1] << A.U(8) | A.U(1 << 24))
        owners.append(own[1:])
        ok.append(np.ones(len(c) - 1, bool))
    if len(c) > 2:
        found.append(c[2:] | c[1:-1] << A.U(8) | c[:-2] << A.U(16) | A.U(2 << 24))
        owners.append(own[2:])
        ok.append(~gap[1:-1])
    ok = np.concatenate(ok)
    bucket = A.mix(np.concatenate(found)[ok]) >> A.U(64 - BITS)
    key = (np.concatenate(owners)[ok] << BITS) | bucket.astype(np.int64)
    key.sort()
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else key
    return key[first] >> BITS, key[first] & (DIM - 1), np.diff(np.append(first, len(key)))


def vectors(texts: list[bytes | None], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, bucket, value) of each text's vector of length one."""
    own, bucket, n = counts(texts)
    value = (1.0 + np.log(n)) * idf[bucket]
    length = np.sqrt(np.bincount(own, value * value, minlength=len(texts)))
    return own, bucket, value / np.maximum(length[own], 1e-300)


def has_letter(text: bytes | None) -> bool:
    if text is None:
        return False
    raw = np.frombuffer(text, np.uint8)
    if _LETTER[raw[raw < 0x80]].any():
        return True
    return any(c.isalpha() for c in text.decode("utf-8", "replace"))


def _document_counts(batches):
    """How many texts of a task hold each bucket, and how many texts there are (bucket -1)."""
    total, n = np.zeros(DIM, np.int64), 0
    for batch in batches:
        texts = batch.column(0).to_pylist()
        n += len(texts)
        for lo, hi in pieces(texts):
            total += np.bincount(counts(texts[lo:hi])[1], minlength=DIM)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1).astype(np.int32)), pa.array(np.append(total[at], n))], names=["bucket", "n"])


def rarity(texts: DataFrame) -> np.ndarray:
    """Inverse document frequency of each bucket over all of ``texts``; one number a bucket comes to the driver."""
    rows = texts.select(F.col("text").cast("binary")).mapInArrow(_document_counts, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    found = {r.bucket: r.n for r in rows}
    seen = np.zeros(DIM)
    for k, n in found.items():
        if k >= 0:
            seen[k] = n
    return np.log((1.0 + found.get(-1, 0)) / (1.0 + seen)) + 1.0


def clustered(x: np.ndarray, k: int, rounds: int, seed: int) -> np.ndarray:
    """Centroids of rows of length one, by k-means on the sphere; the first ones are drawn by distance."""
    rng = np.random.default_rng(seed)
    centers = x[[rng.integers(len(x))]]
    for _ in range(min(k, len(x)) - 1):
        far = np.maximum(1.0 - (x @ centers.T).max(axis=1), 0.0)
        if far.sum() < 1e-9:
            break
        centers = np.vstack([centers, x[rng.choice(len(x), p=far / far.sum())]])
    for _ in range(rounds):
        near = (x @ centers.T).argmax(axis=1)
        sums = np.stack([x[near == j].sum(axis=0) if (near == j).any() else centers[j] for j in range(len(centers))])
        centers = sums / np.linalg.norm(sums, axis=1, keepdims=True)
    return centers


def _centroids(k: int, rounds: int, table: pa.Table) -> pa.Table:
    """A language's centroids and their radii, from the vectors of its bounded sample."""
    table = table.sort_by([("h", "ascending")])
    own = np.repeat(np.arange(len(table)), [len(b) // 4 for b in table.column("buckets").to_pylist()])
    joined = lambda c, t: np.frombuffer(b"".join(table.column(c).to_pylist()), t)
    # Only the buckets that this language uses.
    used, at = np.unique(joined("buckets", np.int32), return_inverse=True)
    x = np.zeros((len(table), len(used)), np.float32)
    x[own, at] = joined("values", np.float32)
    x = x[np.linalg.norm(x, axis=1) > 0.5]  # texts without letters have no direction
    if not len(x):
        return pa.table({"lang": table.column("lang").slice(0, 0), "centroid": pa.array([], pa.binary()), "radius": pa.array([], pa.float64())})
    centers = clustered(x, k, rounds, len(x))
    cosine = x @ centers.T
    near = cosine.argmax(axis=1)
    radius = [float(np.quantile(1.0 - cosine[near == j, j], INSIDE / 1000)) if (near == j).any() else 0.0 for j in range(len(centers))]
    whole = np.zeros((len(centers), DIM), np.float32)
    whole[:, used] = centers
    lang = pa.array([table.column("lang")[0].as_py()] * len(centers), pa.string())
    return pa.table({"lang": lang, "centroid": pa.array([c.tobytes() for c in whole], pa.binary()), "radius": pa.array(radius, pa.float64())})


class Model:
    """Rarity of the buckets, centroids with their languages and radii."""

    def __init__(self, idf: np.ndarray, langs: list[str], centroids: np.ndarray, radius: np.ndarray) -> None:
        self.idf, self.langs, self.centroids, self.radius = idf, langs, centroids, radius

    def nearest(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """The nearest centroid of each text and the cosine to it; ties go to the first."""
        own, bucket, value = vectors(texts, self.idf)
        cosine = np.zeros((len(texts), len(self.langs)))
        for j in range(len(self.langs)):
            cosine[:, j] = np.bincount(own, value * self.centroids[bucket, j], minlength=len(texts))
        best = cosine.argmax(axis=1)
        return best, np.clip(cosine[np.arange(len(texts)), best], 0.0, 1.0)


def learned(docs: DataFrame, known: Column, rows: int = LANG_ROWS, k: int = CENTROIDS, rounds: int = ROUNDS) -> Model:
    """The model of the rows of ``docs`` for which ``known`` holds; the languages are their values of ``lang``.

    Rarity is counted over all of them, centroids are made from at most ``rows`` texts a language.
    """
    fine = columns(docs, "doc_id", "text", "lang").where(known & F.col("lang").isNotNull() & F.col("text").isNotNull())
    idf = rarity(fine)
    h = F.xxhash64("doc_id", F.col("text").cast("binary"))
    # The rows with the least hash of each language; texts are read again for these only.
    few = fine.select("lang", h.alias("h"), F.pmod(F.spark_partition_id(), F.lit(SALTS)).alias("salt"))
    for group in (["lang", "salt"], ["lang"]):  # each of a bounded number of groups keeps ``rows`` first
        few = few.withColumn("k", F.row_number().over(Window.partitionBy(*group).orderBy("h"))).where(F.col("k") <= rows).drop("k")
    few = few.select("lang", "h").distinct()
    few = written(few, "language-sample")  # the bound times the number of languages
    picked = fine.withColumn("h", h).join(few, ["lang", "h"], "left_semi").select("lang", "h", "text")

    def vectorised(rest, texts):
        own, bucket, value = vectors(texts, idf)
        cut = np.searchsorted(own, np.arange(len(texts) + 1))
        bucket, value = bucket.astype(np.int32), value.astype(np.float32)
        parts = [[x[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])] for x in (bucket, value)]
        yield pa.RecordBatch.from_arrays([*rest.columns, *[pa.array(p, pa.binary()) for p in parts]], names=["lang", "h", "buckets", "values"])

    sample = map_texts(picked, vectorised, "lang string, h long, buckets binary, values binary").dropDuplicates(["lang", "h"])

    def cluster(table: pa.Table) -> pa.Table:
        return _centroids(k, rounds, table)

    found = sample.groupBy("lang").applyInArrow(cluster, "lang string, centroid binary, radius double")
    found = sorted(found.collect(), key=lambda r: (r.lang, r.centroid))  # a few centroids a language
    matrix = np.stack([np.frombuffer(r.centroid, np.float32) for r in found], axis=1) if found else np.zeros((DIM, 0), np.float32)
    return Model(idf, [r.lang for r in found], matrix, np.array([r.radius for r in found]))


def languages(docs: DataFrame, held_out_part: int = 2, parts: int = 4, rejected_as: str | None = None) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, rejected`` for every row of ``docs``.

    Learned from the rows with a language outside the held-out part.  ``score`` is
    the cosine to the nearest centroid.  Null texts and texts without a letter are
    ``und`` with score 0, as are all texts when nothing could be learned.  ``rejected`` tells
    that a text lies outside its centroid's reach; its language stays the nearest
    one's unless ``rejected_as`` names another.  Rows with a null id are
    predicted, never learned from nor held out; repeated rows are predicted alike; texts of any
    length are taken whole; an empty table gives no rows; extra columns are not looked at.
    """
    fold = fold_of(parts)
    model = learned(docs, F.coalesce(fold != held_out_part, F.lit(False)))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few rows of DIM numbers a language

    def predict(rest, texts):
        m = shared.value
        some = np.array([bool(m.langs) and has_letter(t) for t in texts], bool)
        best, cosine = m.nearest(texts) if m.langs else (np.zeros(len(texts), np.int64), np.zeros(len(texts)))
        reach = m.radius * WIDER
        out = some & (1.0 - cosine > reach[best]) if m.langs else ~some
        name = [UNKNOWN if not s else rejected_as if r and rejected_as is not None else m.langs[b] for s, r, b in zip(some, out, best)]
        yield pa.RecordBatch.from_arrays(
            [rest.column(0), pa.array(name, pa.string()), pa.array(np.where(some, cosine, 0.0)), pa.array(out | ~some)],
            names=["doc_id", "lang_pred", "score", "rejected"],
        )

    out = map_texts(columns(docs, "doc_id", "text"), predict, "doc_id long, lang_pred string, score double, rejected boolean")
    held = F.coalesce(fold == held_out_part, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score", "rejected")


def op11_centroid_language(spark, sf):
    """Every document's language."""
    return languages(ready(spark).read.parquet(f"{sf}/documents.parquet"))
