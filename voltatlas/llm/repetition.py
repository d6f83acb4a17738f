"""Quality rules on repeated substrings, by suffix array and longest common prefixes.

Each text is a sequence of words.  Its suffixes are sorted by prefix doubling, for
all texts of a batch at once; suffixes that are alone in their group are done and
leave the sort, so only repeated passages are looked at again.  The longest common
prefixes of neighbours give the intervals of the array, whose deepest one at a
suffix is the longest maximal repeat that begins there.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from voltatlas.llm import arrays as A
from voltatlas.llm.common import columns, map_texts, ready

# Base rules.
WINDOW, LEAST_WORDS, MOST_REPEATED_PERCENT = 5, 10, 20
# Rules on maximal repeats: only those of so many words count; the share of words they may cover; the longest allowed.
REPEAT_WORDS, COVERED_PERCENT, LONGEST_REPEAT = 10, 18, 200
# The characters that count as symbols.
SYMBOLS = b"#*$%&|<>"

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True


def suffix_order(words: np.ndarray, own: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Positions ``at`` in the order of the suffixes of ``words`` that begin there; a suffix ends with its text.

    ``own`` numbers the texts; suffixes of one text come together.  ``at`` must
    hold all positions of the texts that it touches.
    """
    n = len(words)
    rank = np.full(n + 1, -1, np.int64)
    # A symbol is the rank of (text, word), so that texts are apart by their first symbol.
    order = at[np.lexsort((words[at], own[at]))]
    new = np.ones(len(order), bool)
    new[1:] = (own[order[1:]] != own[order[:-1]]) | (words[order[1:]] != words[order[:-1]])
    first = np.flatnonzero(new)
    place = np.repeat(first, np.diff(np.append(first, len(order))))  # a group's rank is where it begins
    rank[order] = place
    step = 1
    loose = np.flatnonzero(~new | np.append(~new[1:], False))  # places in groups of more than one
    last = np.append(own, -1)
    while len(loose):
        pos = order[loose]
        ahead = np.minimum(pos + step, n)
        nxt = np.where(last[ahead] == own[pos], rank[ahead], -1)
        head = rank[pos]
        local = np.lexsort((nxt, head))
        pos, nxt, head = pos[local], nxt[local], head[local]
        order[loose] = pos  # groups are contiguous and keep their places
        new = np.ones(len(pos), bool)
        new[1:] = (head[1:] != head[:-1]) | (nxt[1:] != nxt[:-1])
        first = np.flatnonzero(new)
        rank[pos] = np.repeat(loose[first], np.diff(np.append(first, len(pos))))
        loose = loose[~new | np.append(~new[1:], False)]
        step *= 2
    return order


def common_prefix(spans: A.Spans, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Number of equal symbols from positions ``a`` and ``b`` on, at most ``most``."""
    length = np.zeros(len(a), np.int64)
    if not len(a):
        return length
    bit = 1 << int(most.max()).bit_length()
    while bit:
        fits = np.flatnonzero(length + bit <= most)
        s, t = a[fits] + length[fits], b[fits] + length[fits]
        same = spans.raw(s, s + bit) == spans.raw(t, t + bit)
        length[fits[same]] += bit
        bit >>= 1
    return length


def longest_repeats(words: np.ndarray, own: np.ndarray, texts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the texts flagged in ``texts`` and the longest repeat that begins at each."""
    at = np.flatnonzero(texts[own])
    if not len(at):
        return at, np.zeros(0, np.int64)
    order = suffix_order(words, own, at)
    a, b = order[:-1], order[1:]
    pair = np.flatnonzero((own[a] == own[b]) & (words[a] == words[b]))
    a, b = a[pair], b[pair]
    lcp = np.zeros(len(order) + 1, np.int64)
    lcp[pair + 1] = common_prefix(A.Spans(words), a, b, ends[own[a]] - np.maximum(a, b))
    return order, np.maximum(lcp[:-1], lcp[1:])


def _measure(rest, texts):
    buf, begin = A.joined(texts)
    n = len(texts)
    count = lambda own: np.bincount(own, minlength=n).astype(np.int64)
    ws, we = A.word_spans(buf)
    own = A.owner(begin, ws)
    n_words = count(own)
    spans = A.Spans(A.BYTE_CODE[buf])
    words = spans.of(ws, we)
    # Characters: every byte that does not continue one.
    visible = ~A.SPACE[buf]
    byte_sum = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags)])[begin]).astype(np.int64)
    word_chars = byte_sum(visible & ((buf & 0xC0) != 0x80))
    n_symbols = byte_sum(_SYMBOL[buf])
    # Lines with a word.
    ls, le = A.line_spans(buf)
    seen = np.concatenate([[0], np.cumsum(visible)])
    full = seen[le] > seen[ls]
    ls, le = ls[full], le[full]
    line_own = A.owner(begin, ls)
    distinct = np.unique(np.stack([line_own.astype(np.uint64), spans.of(ls, le)]), axis=1)[0].astype(np.int64) if len(ls) else line_own
    n_dup_lines = count(line_own) - count(distinct)
    # Words in windows that occur twice.
    windows = A.grams(words, WINDOW)
    inside = np.flatnonzero(A.in_one(own, WINDOW))
    again = inside[A.repeats(A.keyed(own[inside], windows[inside]))]
    n_repeat = count(own[A.cover(again, again + WINDOW, len(words))])
    failed = (n_words < LEAST_WORDS) | (100 * n_repeat > MOST_REPEATED_PERCENT * n_words)
    # Maximal repeats; a text none of whose windows repeats has none.
    suspect = np.zeros(n, bool)
    suspect[own[again]] = True
    at, length = longest_repeats(words, own, suspect, np.cumsum(n_words))
    long = np.flatnonzero(length >= REPEAT_WORDS)
    covered = count(own[A.cover(at[long], at[long] + length[long], len(words))])
    longest = np.zeros(n, np.int64)
    np.maximum.at(longest, own[at], length)
    rejected = (100 * covered > COVERED_PERCENT * n_words) | (longest > LONGEST_REPEAT)
    yield pa.RecordBatch.from_arrays(
        [*rest.columns, *[pa.array(x) for x in (n_words, word_chars, n_symbols, n_dup_lines, n_repeat, failed, ~failed & ~rejected, covered, longest)]],
        names=[*rest.schema.names, *NAMES],
    )


NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_covered", "longest_repeat"]
MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, "
    "n_covered long, longest_repeat long"
)


def repetition(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the measures and verdict of every row's text; nothing is shuffled.

    Null and empty texts have no words and fail the base rules; texts of any
    length are taken whole; repeated rows are measured each; an empty table gives
    no rows; other columns are not looked at.
    """
    return map_texts(columns(docs, "doc_id", "text"), _measure, f"doc_id long, {MEASURES}")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text is kept, with all their columns, without a join."""
    names = docs.columns
    keep = [f"in_{i}" for i in range(len(names))]
    renamed = docs.toDF(*keep).withColumn("text", docs_text(docs, keep))
    schema = ", ".join(f"{k} {t.dataType.simpleString()}" for k, t in zip(keep, docs.schema))
    scored = map_texts(renamed, _measure, f"{schema}, {MEASURES}")
    return scored.where("kept").select(*[scored[k].alias(n) for k, n in zip(keep, names)])


def docs_text(docs: DataFrame, keep: list[str]):
    from pyspark.sql import functions as F

    return F.col(keep[docs.columns.index("text")])


def op7_suffix_repetition(spark, sf):
    """Base measures and the verdict for every document."""
    docs = ready(spark).read.parquet(f"{sf}/documents.parquet")
    return repetition(docs)
