"""Quality classifier on hashed word n-grams, fitted by follow-the-regularised-leader.

A text is its word unigrams and bigrams, and the same of the words' shapes (runs of
letters, digits and capitals shortened to one mark, other signs as they are; a bigram
also tells whether a word repeats the one before).  A feature's value is the root of
its share among the n-grams of its kind, so texts of any length are alike in size.
"""

from __future__ import annotations

import numpy as np

from voltatlas.llm import arrays as A
from voltatlas.llm import linear
from voltatlas.llm.common import ready

ALPHA, L1, L2 = 2.0, 0.05, 0.01

_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[128:] = ord("a")
for _b in range(128):
    _c = chr(_b)
    _SHAPE[_b] = ord("A" if _c.isupper() else "a" if _c.islower() else "0" if _c.isdigit() else _c)


def features(texts):
    """Text number, feature number and share of every n-gram."""
    buf, begin = A.joined(texts)
    ws, we = A.word_spans(buf)
    own = A.owner(begin, ws)
    n_words = np.bincount(own, minlength=len(texts)).astype(float)
    words = A.Spans(A.BYTE_CODE[A.LOWER[buf]]).of(ws, we)
    shape = _SHAPE[buf]
    keep = np.ones(len(buf), bool)
    keep[1:] = (shape[1:] != shape[:-1]) | A.SPACE[buf[1:]]
    short = shape[keep]
    shapes = A.Spans(A.BYTE_CODE[short]).of(*A.word_spans(short))
    pair = np.flatnonzero(A.in_one(own, 2))
    same = (words[pair] == words[pair + 1]).astype(A.U) if len(pair) else np.zeros(0, A.U)
    word_pairs, shape_pairs = A.grams(words, 2), A.grams(shapes, 2)
    kinds = [
        (own, words, n_words),
        (own[pair], word_pairs[pair], n_words - 1),
        (own, shapes, n_words),
        (own[pair], shape_pairs[pair] + same * A.U(0x51ED27), n_words - 1),
    ]
    hashed = [A.mix(h + A.U(k)) for k, (_, h, _) in enumerate(kinds)]
    idx = np.concatenate(hashed) >> A.U(64 - linear.BITS)
    return (
        np.concatenate([o for o, _, _ in kinds]),
        idx.astype(np.int64),
        np.concatenate([1.0 / np.maximum(n, 1.0)[o] for o, _, n in kinds]),
    )


def train(texts, y):
    model = linear.Leader(ALPHA, L1, L2)
    rows, weight = linear.rows_of(features, np.sqrt, texts), linear.class_weights(y)
    for _ in range(linear.EPOCHS):
        for (i, x), label, c in zip(rows, y, weight):
            model.learn(i, x, int(label), c)
    return model.weights(np.arange(linear.DIM + 1))


def quality(docs, labels, held_out_part: int = 0, parts: int = 5):
    """``doc_id, held_out, score, predicted`` for every row of ``docs``.

    Learned from labels outside the held-out part, at most ``linear.CLASS_ROWS`` a
    class.  Null and empty texts have no n-grams and get the intercept's score;
    rows with a null id are scored, never learned from nor held out; repeated rows
    score alike; without labels every score is 0.5.
    """
    fold = linear.fold_of(parts)
    weights = linear.fit(docs, linear.sample(labels, "quality", fold != held_out_part), train)
    return linear.scored(docs, weights, features, np.sqrt, fold == held_out_part)


def op1_ngram_quality(spark, sf):
    """Every document's quality."""
    ready(spark)
    return quality(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))
