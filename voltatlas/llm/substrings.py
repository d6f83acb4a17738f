"""Removal of long byte strings that occur twice, by prefix-free parsing.

Trigger positions, where a rolling hash is least among its neighbours, cut every
text into phrases, the same way wherever a passage stands.  Every string of
``length`` bytes holds a trigger close to its start, so it is the end of a phrase (a
suffix of the dictionary) followed by the parse from that trigger on (a suffix of
the parse).  First the parse suffixes are brought together: a trigger whose next
bytes occur nowhere else can head no repeated string, and that settles nearly all
text.  Behind the rest, dictionary suffix and parse suffix are combined and
sorted; equal neighbours in that corpus order are the repeated strings.  The order
is that of 64-bit hashes cut at ``length`` bytes: neighbours only have to be
recognised, not put in the alphabet's order.
"""

from __future__ import annotations

import hashlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltatlas.llm import arrays as A
from voltatlas.llm.common import columns, map_texts, ready, release, written

LENGTH = 400
# Bytes of the rolling hash.
TRIGGER_BYTES = 16
# Triggers at one parse suffix that one task compares; more are split by the strings' hashes.
GROUP_TRIGGERS = 20_000
# A parse suffix at more than this share of all triggers is joined without a shuffle; there are at most so many.
MOST_HOT = 1024
# Strings that are sorted together.
SORT_STRINGS = 1 << 20


def reach(length: int) -> int:
    """Bytes from a string's start within which its trigger lies: half the string."""
    return length // 2


def triggers(buf: np.ndarray, begin: np.ndarray, spans: A.Spans, length: int):
    """Start and trigger position of every string of ``length`` bytes that lies within one text, in order."""
    m = reach(length)
    n = len(buf)
    if n < length:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.arange(n - TRIGGER_BYTES + 1)
    score = (spans.of(at, at + TRIGGER_BYTES) >> A.U(32) << A.U(32)) | at.astype(A.U)  # ties go to the left
    pad = -len(score) % m
    rows = np.concatenate([score, np.full(pad, ~A.U(0))]).reshape(-1, m)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[: n - length + 1], ahead[m - 1 : m + n - length])
    start = np.arange(n - length + 1)
    end = begin[1:] - 1  # the separator is no part of a text
    inside = start + length <= end[A.owner(begin, start)]
    return start[inside], (least[inside] & A.U(0xFFFFFFFF)).astype(np.int64)


def _heads(length: int):
    """Each trigger of each text, and the hash of the bytes that any string led by it has from there on."""

    def run(rest, texts):
        buf, begin = A.joined(texts)
        spans = A.Spans(A.BYTE_CODE[buf])
        _, lead = triggers(buf, begin, spans, length)
        lead = lead[np.concatenate([[True], lead[1:] != lead[:-1]])] if len(lead) else lead
        key = spans.of(lead, lead + length - reach(length) + 1)
        own = A.owner(begin, lead)
        yield pa.RecordBatch.from_arrays(
            [*rest.take(pa.array(own)).columns, pa.array(key.view(np.int64)), pa.array((lead - begin[own]).astype(np.int32))],
            names=["id", "h", "head", "pos"],
        )

    return run


def _back_type(length: int):
    """Unsigned integer that holds the bytes from a string's start to its trigger."""
    return np.uint8 if reach(length) <= 256 else np.uint32


RUNS = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
NAMES = ["id", "h", "head", "sub", "pos", "back", "strings", "runs"]
STRINGS = "id long, h long, head long, sub int, pos int, back binary, strings binary, runs array<struct<a:int,b:int>>"


def _as_lists(row: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Rows that have starts, and the runs of their starts; rows and starts come in any order."""
    order = np.lexsort((at, row))
    row, at = row[order], at[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (at[1:] > at[:-1] + 1)
    first = np.flatnonzero(new)
    end = np.append(first[1:], len(row))[: len(first)] - 1
    owner = row[first]
    head = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(owner) else owner
    runs = pa.StructArray.from_arrays([pa.array(at[first].astype(np.int32)), pa.array((at[end] + 1).astype(np.int32))], names=["a", "b"])
    return owner[head], pa.ListArray.from_arrays(pa.array(np.append(head, len(first)).astype(np.int32)), runs)


def _known(rest, begin, start) -> pa.RecordBatch:
    """Runs already sure, one row a text, to be passed through."""
    own = A.owner(begin, start)
    texts, runs = _as_lists(own, start - begin[own])
    at, n = pa.array(texts), len(texts)
    return pa.RecordBatch.from_arrays(
        [rest.column("id").take(at), rest.column("h").take(at), rest.column("h").take(at), pa.array(np.full(n, -1, np.int32)), pa.array(np.zeros(n, np.int32)),
         pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary()), runs],
        names=NAMES,
    )


def _strings(length: int):
    """The strings led by the triggers at ``heads``: their hashes, in one row a trigger and split."""

    def run(rest, texts):
        buf, begin = A.joined(texts)
        spans = A.Spans(A.BYTE_CODE[buf])
        start, lead = triggers(buf, begin, spans, length)
        lists = rest.column("heads")
        flat = lists.flatten()
        sizes = np.diff(lists.offsets.to_numpy())
        pos = flat.field("pos").to_numpy() + np.repeat(begin[:-1], sizes)
        order = np.argsort(pos)
        pos, head, parts = pos[order], flat.field("head").to_numpy()[order], flat.field("parts").to_numpy()[order]
        if not len(pos) or not len(lead):
            return
        which = np.minimum(np.searchsorted(pos, lead), len(pos) - 1)
        hit = np.flatnonzero(pos[which] == lead)
        start, which = start[hit], which[hit]
        h = spans.of(start, start + length)
        # Strings that occur twice right here: settled, and sent on once for the others.
        sort = np.argsort(h, kind="stable")
        same = np.zeros(len(h), bool)
        same[1:] = h[sort][1:] == h[sort][:-1]
        twice = np.zeros(len(h), bool)
        twice[sort] = same | np.append(same[1:], False)
        yield _known(rest, begin, start[twice])
        once = np.sort(sort[~same])
        start, which, h = start[once], which[once], h[once]
        sub = ((h >> A.U(40)).astype(np.int64) % parts[which]).astype(np.int32)
        order = np.lexsort((sub, which))
        start, which, h, sub = start[order], which[order], h[order], sub[order]
        new = np.ones(len(which), bool)
        new[1:] = (which[1:] != which[:-1]) | (sub[1:] != sub[:-1])
        first = np.flatnonzero(new)
        if not len(first):
            return
        bound = np.append(first, len(which)).astype(np.int32)
        trigger = pos[which[first]]
        own = A.owner(begin, trigger)
        back = (pos[which] - start).astype(_back_type(length))
        blob = lambda data: pa.BinaryArray.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(bound * data.itemsize), pa.py_buffer(data.tobytes())])
        yield pa.RecordBatch.from_arrays(
            [rest.column("id").take(pa.array(own)), rest.column("h").take(pa.array(own)), pa.array(head[which[first]]), pa.array(sub[first]),
             pa.array((trigger - begin[own]).astype(np.int32)), blob(back), blob(h), pa.nulls(len(first), RUNS)],
            names=NAMES,
        )

    return run


def _repeated(length: int, batches):
    """Runs of starts whose string occurs twice; rows come sorted by (head, sub)."""
    held, size, last = [], 0, None

    def settle(rows: pa.Table):
        rows = rows.combine_chunks()
        joined = lambda c, t: np.frombuffer(b"".join(rows.column(c).to_pylist()), t)
        h, back = joined("strings", np.uint64), joined("back", _back_type(length)).astype(np.int64)
        count = np.fromiter((len(x) // 8 for x in rows.column("strings").to_pylist()), np.int64, rows.num_rows)
        row = np.repeat(np.arange(rows.num_rows), count)
        hit = np.flatnonzero(A.repeats(A.mix(h ^ A.mix(rows.column("head").to_numpy().view(np.uint64))[row])))
        row, at = row[hit], rows.column("pos").to_numpy()[row[hit]] - back[hit]
        # One row a text and sort, not one a trigger.
        ids = np.stack([rows.column("id").to_numpy(), rows.column("h").to_numpy()])
        _, one, text = np.unique(ids, axis=1, return_index=True, return_inverse=True)
        texts, runs = _as_lists(text.ravel()[row], at)
        own = pa.array(one[texts])
        return pa.RecordBatch.from_arrays(
            [rows.column("id").combine_chunks().take(own), rows.column("h").combine_chunks().take(own), runs], names=["id", "h", "runs"]
        )

    for batch in batches:
        sure = batch.column("sub").to_numpy() < 0
        if sure.any():
            yield batch.filter(pa.array(sure)).select(["id", "h", "runs"])
            batch = batch.filter(pa.array(~sure))
        if not batch.num_rows:
            continue
        key = np.stack([batch.column("head").to_numpy(), batch.column("sub").to_numpy().astype(np.int64)])
        # A group that goes on in this batch stays with what is held.
        change = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
        if last is None or (key[:, 0] != last).any():
            change = np.append(0, change)
        if size >= SORT_STRINGS and len(change):
            held.append(batch.slice(0, int(change[0])))
            yield settle(pa.Table.from_batches(held))
            held, size, batch = [], 0, batch.slice(int(change[0]))
        held.append(batch)
        size += batch.column("strings").nbytes // 8
        last = key[:, -1]
    if held:
        yield settle(pa.Table.from_batches(held))


def _cut(length: int):
    """What is left of each text."""

    def run(rest, texts):
        out = []
        copied, runs = rest.column("copied").to_pylist(), rest.column("runs").to_pylist()
        for t, twin, found in zip(texts, copied, runs):
            t = t or b""
            n = len(t)
            if twin and n >= length:
                found = [{"a": 0, "b": n - length + 1}]
            if not found:
                out.append((n, 0, 0, hashlib.sha256(t).hexdigest()))
                continue
            gone = A.cover(np.array([r["a"] for r in found]), np.array([r["b"] - 1 + length for r in found]), n)
            first, _ = A.runs(gone)
            out.append((n, int(gone.sum()), len(first), hashlib.sha256(np.frombuffer(t, np.uint8)[~gone].tobytes()).hexdigest()))
        n, removed, spans, sha = zip(*out)
        yield pa.RecordBatch.from_arrays(
            [rest.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(sha)],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )

    return run


def repeated_runs(docs: DataFrame, length: int = LENGTH) -> tuple[DataFrame, DataFrame]:
    """``id, h, copied, runs``: for each text that loses something, whether it has an exact copy, and runs of starts
    ``a <= i < b`` at which a string of ``length`` bytes begins that also begins elsewhere.  Also the texts, keyed alike."""
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    docs = columns(docs, "doc_id", "text").select(
        "doc_id", F.coalesce("doc_id", F.lit(0)).cast("long").alias("id"), F.xxhash64("doc_id", text).alias("h"), text.alias("text")
    )
    key = ["id", "h"]
    long = docs.where(F.octet_length("text") >= length)
    # Exact copies: one of them speaks for all.
    rows = written(long.select(*key, F.unhex(F.md5("text")).alias("md5")), "substring-texts")
    groups = rows.groupBy("md5").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*key)).alias("one")).where("n > 1")
    twins = rows.join(groups, "md5").select(*key, (F.struct(*key) == F.col("one")).alias("speaks")).distinct()
    twins = written(twins, "substring-twins")
    # Parse suffixes that occur twice.
    heads = map_texts(long.drop("doc_id"), _heads(length), "id long, h long, head long, pos int")
    heads = written(heads, "substring-heads")
    parts = F.ceil(F.col("n") / GROUP_TRIGGERS).cast("int").alias("parts")
    twice = heads.groupBy("head").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    twice = written(twice.select("head", "n", parts), "substring-twice")
    # A periodic text, or a passage found everywhere, would put all its triggers into one task of the join.
    crowded = F.col("n") > max(GROUP_TRIGGERS, heads.count() // MOST_HOT)
    hot = F.broadcast(twice.where(crowded).select("head", "parts"))
    rare = heads.join(hot, "head", "left_anti").join(twice.where(~crowded).select("head", "parts"), "head")
    open_heads = heads.join(hot, "head").unionByName(rare).groupBy(*key).agg(F.collect_list(F.struct("head", "pos", "parts")).alias("heads"))
    silent = twins.where("not speaks").select(*key)
    asked = open_heads.join(silent, key, "left_anti").hint("shuffle_hash")
    # Their strings in corpus order.
    strings = map_texts(
        long.drop("doc_id").join(asked, key), _strings(length), STRINGS
    )
    ordered = strings.repartition("head", "sub").sortWithinPartitions("head", "sub")
    runs = ordered.mapInArrow(partial(_repeated, length), "id long, h long, runs array<struct<a:int,b:int>>")
    found = runs.groupBy(*key).agg(F.flatten(F.collect_list("runs")).alias("runs"))
    copied = twins.select(*key, F.lit(True).alias("copied"))
    return written(found.join(copied, key, "full"), "substring-runs"), docs


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` for every row of ``docs``.

    Null text is empty; texts shorter than ``length`` lose nothing; a row given
    twice is a copy of itself; rows with a null id are told apart by their text;
    texts of any length are taken whole; an empty table gives no rows.
    """
    runs, docs = repeated_runs(docs, length)
    release(docs.sparkSession)
    whole = docs.join(runs.hint("shuffle_hash"), ["id", "h"], "left").select("doc_id", F.coalesce("copied", F.lit(False)).alias("copied"), "runs", "text")
    return map_texts(whole, _cut(length), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def op10_prefix_free_dedup(spark, sf):
    """All documents without the 400-byte strings that occur twice."""
    return without_repeats(ready(spark).read.parquet(f"{sf}/documents.parquet"))
