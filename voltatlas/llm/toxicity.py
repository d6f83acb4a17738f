"""Toxicity classifier that is told not to mind which group a text mentions.

A labelled text with identity terms is also seen with each of them swapped for
another of its kind; half the change of its score, squared, is added to the loss.  What a
term weighs by itself so goes to what its kind weighs, and neutral mentions are no
longer taken for abuse because abuse often names one group.
"""

from __future__ import annotations

import re
import zlib

import numpy as np

from voltatlas.llm import arrays as A
from voltatlas.llm import linear
from voltatlas.llm.common import ready

ALPHA, L1, L2 = 0.5, 5.0, 0.1
# Weight of the counterfactual term.
STRENGTH = 1.0
# A word also counts by its first bytes, since insults come with many endings.
PREFIXES = (4, 5, 6)

# Identity terms by kind; a term is swapped for another of its row.
IDENTITY = [
    "muslim christian jewish hindu buddhist catholic protestant atheist",
    "muslims christians jews hindus buddhists catholics protestants atheists",
    "women men", "woman man", "female male", "girls boys",
    "gay lesbian straight bisexual transgender queer",
    "black white asian latino african european arab",
    "american mexican chinese indian german french spanish polish turkish russian",
    "immigrants refugees foreigners citizens natives",
    "disabled blind deaf old young",
    "musulman chrétien juif bouddhiste catholique", "femmes hommes", "noirs blancs asiatiques arabes",
    "muslime christen juden hindus katholiken", "frauen männer", "schwarze weiße asiaten",
    "musulmanes cristianos judíos budistas católicos", "mujeres hombres", "negros blancos asiáticos árabes",
]
_KIND = {t: row.split() for row in reversed(IDENTITY) for t in row.split()}
_TERM = re.compile(r"\w+")


def swapped(text: bytes) -> bytes | None:
    """The text with every identity term replaced by another of its kind; None if it has none."""
    found = False

    def other(m):
        nonlocal found
        kind = _KIND.get(m[0].lower())
        if kind is None:
            return m[0]
        found = True
        at = kind.index(m[0].lower())
        step = 1 + zlib.crc32(f"{m.start()} {m[0]}".encode()) % (len(kind) - 1)
        return kind[(at + step) % len(kind)]

    out = _TERM.sub(other, text.decode("utf-8", "replace"))
    return out.encode() if found else None


def features(texts):
    """Text number, feature number and 1 for every word and word beginning, without case and outer signs."""
    buf, begin = A.joined(texts)
    low = A.LOWER[buf]
    high = np.zeros(len(buf), bool)  # capitals of two bytes
    high[1:] = (buf[:-1] == 0xC3) & (buf[1:] >= 0x80) & (buf[1:] <= 0x9E)
    low[high] += 32
    letter = (buf >= 128) | ((low >= ord("a")) & (low <= ord("z"))) | ((buf >= ord("0")) & (buf <= ord("9")))
    edge = np.flatnonzero(letter[1:] != letter[:-1]) + 1
    if len(buf) and letter[0]:
        edge = np.concatenate([[0], edge])
    ws, we = edge[::2], edge[1::2]
    own = A.owner(begin, ws)
    spans = A.Spans(A.BYTE_CODE[low])
    parts = [(own, A.mix(spans.of(ws, we)))]
    for k in PREFIXES:
        long = np.flatnonzero(we - ws > k)
        parts.append((own[long], A.mix(spans.of(ws[long], ws[long] + k) + A.U(k))))
    idx = (np.concatenate([h for _, h in parts]) >> A.U(64 - linear.BITS)).astype(np.int64)
    return np.concatenate([o for o, _ in parts]), idx, np.ones(len(idx))


def present(counts):
    return np.ones(len(counts))


def train(texts, y, strength: float = STRENGTH):
    model = linear.Leader(ALPHA, L1, L2)
    rows, weight = linear.rows_of(features, present, texts), linear.class_weights(y)
    other = [swapped(t) for t in texts]
    at = [k for k, t in enumerate(other) if t is not None]
    changed = {}
    for k, (i, _) in zip(at, linear.rows_of(features, present, [other[k] for k in at])):
        gone, come = np.setdiff1d(rows[k][0], i), np.setdiff1d(i, rows[k][0])
        changed[k] = np.concatenate([gone, come]), np.concatenate([np.ones(len(gone)), -np.ones(len(come))])
    for _ in range(linear.EPOCHS):
        for k, (i, x) in enumerate(rows):
            model.learn(i, x, int(y[k]), weight[k])
            if k in changed and strength:
                model.level(*changed[k], strength * weight[k] / 2)
    return model.weights(np.arange(linear.DIM + 1))


def toxicity(docs, labels, held_out_part: int = 2, parts: int = 4):
    """``doc_id, held_out, score, predicted`` for every row of ``docs``.

    Learned from labels outside the held-out part, at most ``linear.CLASS_ROWS`` a
    class.  Null and empty texts have no words and get the intercept's score; rows
    with a null id are scored, never learned from nor held out; repeated rows score
    alike; without labels every score is 0.5.
    """
    fold = linear.fold_of(parts)
    weights = linear.fit(docs, linear.sample(labels, "toxic", fold != held_out_part), train)
    return linear.scored(docs, weights, features, present, fold == held_out_part)


def op3_counterfactual_toxicity(spark, sf):
    """Every document's toxicity."""
    ready(spark)
    return toxicity(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))
