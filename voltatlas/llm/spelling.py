"""Spelling variants: words one edit apart, found by PartEnum signatures of their letter multisets.

A word's letters, each with its number among its equals, are a binary vector.  One
inserted or deleted letter changes one place of it and a replaced one two, so words one
edit apart have vectors within a Hamming distance of two.  The places are dealt into
three parts: at that distance at least one part is equal, and the hash of each part is
a signature.  Letters alone would bring all anagrams together, so a signature is
joined with one half of the word: an edit leaves the first or the last half as it is.
Words that share a signature meet in one group and are verified letter by letter.
"""

from __future__ import annotations

import zlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltatlas.llm import arrays as A
from voltatlas.llm.checksums import crc32
from voltatlas.llm.common import columns, map_texts, ready, written
from voltatlas.llm.groups import whole_groups
from voltatlas.llm.sql import CRC_TABLE, LOWER_ASCII
from voltatlas.llm.sql import crc32 as sql_crc32

LEAST_LETTERS, LEAST_TIMES, RATIO = 7, 2, 10
# One of so many word occurrences loses a letter.
SLIP = 31
# Parts of the letter vector; a Hamming distance of fewer leaves one part equal.
PARTS = 3
# Words of a group up to which all pairs are compared; larger groups are ordered by what is left without one letter.
PAIRWISE = 32
# Rows of whole groups that are compared together.
TOGETHER = 1 << 16

_ASCII = np.zeros(256, bool)
_ASCII[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True


def _inside(begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the stretch and position of everything within stretches."""
    own = np.repeat(np.arange(len(size)), size)
    return own, np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


def _starts(size: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(size)])


def strings(letters: np.ndarray, size: np.ndarray) -> pa.Array:
    """Words of one-byte letters (Latin-1), one after the other, as strings."""
    high = letters >= 128
    out = np.repeat(letters, 1 + high)
    at = np.flatnonzero(high) + np.arange(int(high.sum()))
    out[at], out[at + 1] = 0xC3, letters[high] - 0x40
    ends = _starts(1 + high)[_starts(size)]
    return pa.StringArray.from_buffers(len(size), pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(out))


def letters_of(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The letters of strings as one byte each, and the words' lengths; the inverse of ``strings``."""
    words = words.cast(pa.large_binary())
    ends = np.frombuffer(words.buffers()[1], np.int64, len(words) + 1, 8 * words.offset)
    buf = np.frombuffer(words.buffers()[2], np.uint8)[ends[0] : ends[-1]] if words.buffers()[2] else np.zeros(0, np.uint8)
    lead = buf == 0xC3
    full = np.concatenate([[0], np.cumsum(~lead)])
    out = buf + np.where(np.concatenate([[False], lead[:-1]]), 0x40, 0).astype(np.uint8) if len(buf) else buf
    return out[~lead], np.diff(full[ends - ends[0]])


def _occurrences(least: int, slip: int):
    """Distinct words of a piece with their numbers, after slips."""

    def run(rest, texts):
        buf, begin = A.joined(texts)
        low = A.LOWER[buf]
        lead = np.zeros(len(buf), bool)
        lead[:-1] = (buf[:-1] == 0xC3) & (buf[1:] & 0xC0 == 0x80)
        after = np.concatenate([[False], lead[:-1]])
        ws, we = A.runs(_ASCII[buf] | lead | after)
        one = (_ASCII[buf] & ~after) | after  # a letter's last byte
        nth = np.concatenate([[0], np.cumsum(one)])
        size = nth[we] - nth[ws]
        long = np.flatnonzero(size >= least)
        ws, we, size = ws[long], we[long], size[long]
        names = [b"" if i is None else str(i).encode() for i in rest.column(0).to_pylist()]
        before = np.array([zlib.crc32(n + b":") for n in names], np.uint32)
        h = crc32(low, ws, we, before[A.owner(begin, ws)]).astype(np.int64)
        slips = h % slip == 0
        plain = (low + np.where(after, 0x40, 0).astype(np.uint8))[one]
        own, at = _inside(nth[ws], size)
        gone = np.where(slips, nth[ws] + h % np.maximum(size, 1), -1)
        plain, size = plain[at[at != gone[own]]], size - slips
        start = _starts(size)
        names = A.Spans(A.BYTE_CODE[plain]).of(start[:-1], start[1:])
        fine = np.flatnonzero(size >= least)
        _, first, n = np.unique(names[fine], return_index=True, return_counts=True)
        first = fine[first]
        _, at = _inside(start[first], size[first])
        yield pa.RecordBatch.from_arrays([strings(plain[at], size[first]), pa.array(n.astype(np.int64))], names=["word", "n"])

    return run


def vocabulary(docs: DataFrame, least: int = LEAST_LETTERS, times: int = LEAST_TIMES, slip: int = SLIP) -> DataFrame:
    """``word, n`` for every word of at least ``least`` letters that occurs at least ``times`` times."""
    found = map_texts(columns(docs, "doc_id", "text"), _occurrences(least, slip), "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= times)


def signatures(letters: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Hash of each part of each word's letter vector, one row a word."""
    own = np.repeat(np.arange(len(size)), size)
    place = own << 8 | letters
    place.sort()  # letters in order within each word
    first = np.flatnonzero(np.append(True, place[1:] != place[:-1])) if len(place) else place
    nth = np.arange(len(place)) - np.repeat(first, np.diff(np.append(first, len(place))))
    letter = place & 255
    code = A.mix((letter << 32 | (nth + 1)).astype(A.U) * A.U(0x9E3779B97F4A7C15))
    start = _starts(size)
    out = np.zeros((len(size), PARTS), A.U)
    for p in range(PARTS):
        sums = np.concatenate([[A.U(0)], np.cumsum(np.where((letter + nth) % PARTS == p, code, A.U(0)))])
        out[:, p] = sums[start[1:]] - sums[start[:-1]]
    return out


def halves(letters: np.ndarray, size: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    """Hash of the first and of the last half of each word, where the shorter word of the pair has ``shorter`` letters."""
    start = _starts(size)
    spans = A.Spans(A.BYTE_CODE[letters])
    m = shorter // 2
    return np.stack([spans.of(start[:-1], start[:-1] + m), spans.of(start[1:] - m, start[1:])], axis=1)


def _keyed(least: int, batches):
    """Every word under each of its signatures.

    A word stands once as the shorter of its pairs (``role`` 0), or one as long, and once as the longer.
    ``tag`` is the number of half and part.
    """
    for batch in batches:
        letters, size = letters_of(batch.column("word"))
        parts = signatures(letters, size)
        rows = np.arange(len(size))
        for role in (0, 1):
            shorter = size - role
            half = halves(letters, size, shorter)
            use = rows[shorter >= least]
            for tag in range(2 * PARTS):
                key = A.mix(parts[use, tag % PARTS] ^ A.mix(half[use, tag // PARTS] + (shorter[use] * 16 + tag).astype(A.U)))
                at = pa.array(use)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(np.full(len(use), 2 * tag + role, np.int8)), batch.column("word").take(at), batch.column("n").take(at)],
                    names=["key", "tag", "word", "n"],
                )


class Words:
    """Words of one table, for comparing many pairs."""

    def __init__(self, words: pa.Array) -> None:
        self.letters, self.size = letters_of(words)
        self.start = _starts(self.size)

    def near(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether one edit, and no less, turns word i into word j; word j is as long or one letter longer."""
        small = self.size[i]
        common = np.zeros(len(i), np.int64)
        s, t = self.start[i], self.start[j]
        # Letters the two begin with alike.
        live = np.arange(len(i))
        while len(live):
            k = common[live]
            live = live[k < small[live]]
            k = common[live]
            live = live[self.letters[s[live] + k] == self.letters[t[live] + k]]
            common[live] += 1
        # What follows one edit must be alike.
        equal = (common == small) & (self.size[j] == small)
        left = small - common - (self.size[j] == small)
        ok = (self.size[j] - small <= 1) & ~equal
        s, t = self.start[i + 1] - 1, self.start[j + 1] - 1
        live, k = np.flatnonzero(ok & (left > 0)), 0
        while len(live):
            same = self.letters[s[live] - k] == self.letters[t[live] - k]
            ok[live[~same]] = False
            k += 1
            live = live[same]
            live = live[left[live] > k]
        return ok


def _all_pairs(first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every pair of rows within each of the small groups."""
    rows = np.concatenate([np.arange(f, f + g) for f, g in zip(first, size)]) if len(first) else first
    left = np.repeat(first + size, size) - rows
    i, j = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for step in range(1, int(size.max(initial=1))):
        at = rows[left > step]
        i.append(at)
        j.append(at + step)
    return np.concatenate(i), np.concatenate(j)


def _left_out(words: Words, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows within each group that are equal once a letter of one, or the same letter of both, is left out."""
    own, row = _inside(first, size)
    n = words.size[row]
    who, at = _inside(words.start[row], n)
    spans = A.Spans(A.BYTE_CODE[words.letters])
    up, _ = A.powers(int(n.max(initial=0)) + 1)
    place = at - words.start[row][who]
    head = spans.raw(words.start[row][who], at)
    rest = A.mix(head + spans.raw(at + 1, words.start[row + 1][who]) * up[place])
    whole = A.mix(spans.raw(words.start[row], words.start[row + 1]))
    group = own.astype(A.U) * A.U(0xD1342543DE82EF95)
    # Replaced letters: the same place is left out.  Inserted ones: what is left is the shorter word.
    replaced = A.mix(rest ^ A.mix(group[who] + place.astype(A.U) * A.U(2) + A.U(1)))
    deleted, shorter = A.mix(rest ^ A.mix(group[who])), A.mix(whole ^ A.mix(group))
    i, j = [], []
    for key, r in ((replaced, row[who]), (np.concatenate([deleted, shorter]), np.concatenate([row[who], row]))):
        order = np.argsort(key, kind="stable")
        key, r = key[order], r[order]
        head = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else key.astype(np.int64)
        some = np.diff(np.append(head, len(key)))
        a, b = _all_pairs(head[some > 1], some[some > 1])
        i.append(r[a])
        j.append(r[b])
    i, j = np.concatenate(i), np.concatenate(j)
    lo, hi = np.minimum(i, j), np.maximum(i, j)
    both = np.unique(np.stack([lo, hi])[:, lo < hi], axis=1)
    return both[0], both[1]


def _verified(pairwise: int, batches):
    """For each row of a group its near words under the first signature that both share: their number and the best of them."""
    for group in whole_groups(batches, ["key"], TOGETHER):
        key, tag, n = (group.column(c).to_numpy() for c in ("key", "tag", "n"))
        column = group.column("word").combine_chunks()
        words = Words(column)
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        size = np.diff(np.append(first, len(key)))
        few = (size > 1) & (size <= pairwise)
        i, j = _all_pairs(first[few], size[few])
        many = size > pairwise
        if many.any():
            a, b = _left_out(words, first[many], size[many])
            i, j = np.concatenate([i, a]), np.concatenate([j, b])
        # The shorter word first; two of the longer kind meet elsewhere.
        flip = words.size[i] > words.size[j]
        i, j = np.where(flip, j, i), np.where(flip, i, j)
        some = np.flatnonzero((tag[i] % 2 == 0) & (tag[j] % 2 == words.size[j] - words.size[i]))
        i, j = i[some], j[some]
        some = np.flatnonzero(words.near(i, j))
        i, j = i[some], j[some]
        # Only the first signature that both words share counts the pair.
        shorter = words.size[i]
        used, back = np.unique(np.concatenate([i, j]), return_inverse=True)
        _, at = _inside(words.start[used], words.size[used])
        letters, length = words.letters[at], words.size[used]
        parts = signatures(letters, length)
        x, y = back[: len(i)], back[len(i) :]
        start = _starts(length)
        spans, m = A.Spans(A.BYTE_CODE[letters]), shorter // 2
        alike = spans.of(start[x], start[x] + m) == spans.of(start[y], start[y] + m)
        own = tag[i] // 2
        ok = np.where(own >= PARTS, ~alike, True)
        for p in range(PARTS - 1):
            ok &= ~((own % PARTS > p) & (parts[x, p] == parts[y, p]))
        i, j = i[ok], j[ok]
        if not len(i):
            continue
        # Both ways; of each word's partners the most frequent, then the least.
        a, b = np.concatenate([i, j]), np.concatenate([j, i])
        rank = np.empty(len(column), np.int64)
        rank[pa.compute.sort_indices(pa.table({"n": n, "word": column}), [("n", "descending"), ("word", "ascending")]).to_numpy()] = np.arange(len(column))
        order = np.lexsort((rank[b], a))
        a, b = a[order], b[order]
        head = np.flatnonzero(np.append(True, a[1:] != a[:-1]))
        best = pa.array(b[head])
        yield pa.RecordBatch.from_arrays(
            [column.take(pa.array(a[head])), pa.array(np.diff(np.append(head, len(a)))), pa.array(n[b[head]]), column.take(best)],
            names=["word", "n_near", "best_n", "best"],
        )


def variants(words: DataFrame, least: int = LEAST_LETTERS, ratio: int = RATIO, pairwise: int = PAIRWISE) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every row of ``words`` (``word, n``, each word once, of at least ``least`` letters).

    ``words`` must be a table that can be read twice.  No pair is given out: a
    word's partners are counted and the best one taken where they are verified.
    """
    rows = words.mapInArrow(partial(_keyed, least), "key long, tag byte, word string, n long")
    met = rows.repartition("key").sortWithinPartitions("key").mapInArrow(partial(_verified, pairwise), "word string, n_near long, best_n long, best string")
    own = words.select("word", "n", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("long").alias("best_n"), F.lit(None).cast("string").alias("best"))
    both = met.select("word", F.lit(None).cast("long").alias("n"), "n_near", "best_n", "best").unionByName(own)
    best = F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("m"), F.col("best").alias("form")))
    out = both.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min(best).alias("b"))
    leads = -F.col("b.m") >= ratio * F.col("n")
    out = written(out.select("word", "n", "n_near", F.when(leads, F.col("b.form")).alias("form"), F.when(leads, -F.col("b.m")).alias("form_n")), "spelling-forms")
    # Every step multiplies n by ``ratio`` at least, and every round doubles the steps taken: a handful of rounds.
    root = written(out.where("form is not null").select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        on = root.select(F.col("word").alias("at"), F.col("root").alias("further"))
        step = root.join(on, F.col("root") == F.col("at"), "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        step = written(step, "spelling-roots")
        root = step.select("word", "root")
        if step.where("moved").isEmpty():
            break
    out = out.join(root, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spellings(docs: DataFrame, least: int = LEAST_LETTERS, times: int = LEAST_TIMES, ratio: int = RATIO, slip: int = SLIP) -> DataFrame:
    """The words of all texts with the form each is a variant of.

    Null and empty texts have no words; a null id counts as an empty one when
    slips are dealt; texts and words of any length are taken whole; repeated rows
    count each; equal best forms go to the first in code point order; an empty
    table gives no rows; other columns are not looked at.
    """
    return variants(written(vocabulary(docs, least, times, slip), "spelling-words"), least, ratio)


OP13_SQL = rf"""
with recursive {CRC_TABLE},
runs as (select doc_id, r, count(*) as n
         from (select doc_id, unnest(regexp_extract_all({LOWER_ASCII.format('text')}, '[A-Za-z\x{{00C0}}-\x{{00FF}}]{{7,}}')) as r from documents) group by all),
hashed as (select r, n, {sql_crc32("(coalesce(doc_id::varchar, '') || ':' || r)")} as h from runs, crc_table),
slips as (select case when h % 31 = 0 then left(r, (h % length(r))::int) || substr(r, (h % length(r))::int + 2) else r end as word, n from hashed),
v as materialized (select word, sum(n)::bigint as n from slips where length(word) >= 7 group by word having sum(n) >= 2),
dels as materialized (select word, n, k, left(word, k::int - 1) || substr(word, k::int + 1) as rest
         from (select word, n, unnest(range(1, length(word) + 1)) as k from v)),
near as materialized (select distinct a.word, b.word as other, b.n as m from dels a join dels b on a.rest = b.rest and a.k = b.k and a.word <> b.word
         union select a.word, b.word, b.n from dels a join v b on a.rest = b.word
         union select b.word, a.word, a.n from dels a join v b on a.rest = b.word),
best as (select word, count(*)::bigint as n_near, arg_min(other, struct_pack(m := -m, o := other)) as o, max(m) as m from near group by word),
f as materialized (select v.word, v.n, coalesce(n_near, 0)::bigint as n_near, case when m >= 10 * v.n then o end as form, case when m >= 10 * v.n then m end::bigint as form_n
      from v left join best on v.word = best.word),
chain as (select word, form as at from f where form is not null
          union all select c.word, f.form from chain c join f on c.at = f.word where f.form is not null),
ends as (select c.word, c.at from chain c join f on c.at = f.word where f.form is null)
select f.word, form, coalesce(ends.at, f.word) as root, n, n_near, form_n from f left join ends on f.word = ends.word
"""


def op13_partenum_spelling(spark, sf):
    """Every frequent word of all documents with its standard form."""
    return spellings(ready(spark).read.parquet(f"{sf}/documents.parquet"))
