"""Best-fit packing into sequences of several permitted lengths.

Texts are cut into pieces no longer than the largest sequence; pieces are dealt
by hash into blocks of bounded size; each block is packed by itself.  Within a
block pieces go, longest first, into the open sequence that they fill best.  When
none has room, the length to open is the one that costs least for each word it
can hold with the pieces still waiting; all admissible policies are tried and the
cheapest kept; at the end each sequence shrinks to the least length that holds it.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltatlas.llm.common import columns, map_texts, ready

# Permitted sequence lengths in words, separators included.
LENGTHS = (256, 512, 1024, 2048)
# Cost of a sequence: its words, the share of attention that grows with the square, and what each costs to start.
ATTENTION, OPENING = 8192, 16
# Pieces and bytes of text that are packed together at most.
BLOCK_ROWS, BLOCK_BYTES = 20_000, 16 << 20
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def cost(length: int) -> int:
    return length + length * length // ATTENTION + OPENING


def pack(sizes: list[int], lengths: tuple[int, ...] = LENGTHS) -> tuple[list[int], list[int], list[int]]:
    """Sequence number and offset of each piece, and each sequence's length; sizes are at most ``lengths[-1]``."""
    order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    plans = [_fill(order, sizes, lengths, lengths[: k + 1]) for k in range(len(lengths))]
    return min(plans, key=lambda p: sum(map(cost, p[2])))


def _fill(order, sizes, lengths, openable):
    """Best fit; new sequences take one of ``openable``, or the least length that holds the piece if none does."""
    waiting = sum(sizes)
    bins: list[int] = []  # words in each
    room: dict[int, list[int]] = {}  # free words -> open sequences with just so much room
    free = 0  # bit r: some sequence has r free words
    number, offset = [0] * len(sizes), [0] * len(sizes)
    for i in order:
        n = sizes[i]
        fits = free >> n
        if fits:
            left = n + (fits & -fits).bit_length() - 1
            b = room[left].pop()
            if not room[left]:
                free ^= 1 << left
        else:
            able = [c for c in openable if c >= n] or [next(c for c in lengths if c >= n)]
            left = min(able, key=lambda c: (cost(c) / max(1, min(c, waiting)), c))
            b = len(bins)
            bins.append(0)
        number[i], offset[i] = b, bins[b]
        bins[b] += n
        waiting -= n
        left -= n
        if left:
            if not room.setdefault(left, []):
                free |= 1 << left
            room[left].append(b)
    return number, offset, [next(c for c in lengths if c >= used) for used in bins]


def text_pieces(docs: DataFrame, most: int, with_text: bool) -> DataFrame:
    """``doc_id, piece, start, size, part``: each text in pieces of at most ``most`` words, whole words, in order.

    ``start`` is the piece's first word.  A text without words is one piece of size 0.
    """

    def cut(rest, texts):
        ids, piece, start, size, part = [], [], [], [], []
        for at, t in enumerate(texts):
            t = t or b""
            n = len(t.split())
            if n <= most:
                begins, bounds = [0], [0, len(t)]
            else:
                begins = list(range(0, n, most))
                bounds = [m.start() for k, m in enumerate(WORD.finditer(t)) if k % most == 0]
                bounds = [0, *bounds[1:], len(t)]
            for k, w in enumerate(begins):
                ids.append(at)
                piece.append(k)
                start.append(w)
                size.append(min(most, n - w))
                part.append(t[bounds[k] : bounds[k + 1]] if with_text else None)
        yield pa.RecordBatch.from_arrays(
            [rest.column(0).take(pa.array(ids, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
             pa.array(size, pa.int64()), pa.array(part, pa.binary()).cast(pa.string())],
            names=["doc_id", "piece", "start", "size", "part"],
        )

    return map_texts(columns(docs, "doc_id", "text"), cut, "doc_id long, piece int, start long, size long, part string")


def packed(docs: DataFrame, lengths: tuple[int, ...] = LENGTHS, with_text: bool = False) -> DataFrame:
    """``bin_id, bin_length, bin_used, bin_offset, doc_id, piece, start, size`` and the piece's ``part`` of the text if asked for.

    One row a piece; nothing is cut off or left out.  Every piece takes one word
    more than it has, for a separator.  Null and empty texts are one piece of no
    words; a null id is kept; repeated rows are packed as rows of their own; an
    empty table gives no rows.
    """
    lengths = tuple(sorted(lengths))
    pieces = text_pieces(docs, lengths[-1] - 1, with_text)
    # Dealt by id, piece and size: copies of one text are not one group.
    spread = pieces.repartition("doc_id", "piece", "size")

    def fill(batches):
        from pyspark import TaskContext

        part_no, block_no, held, rows, size = TaskContext.get().partitionId(), 0, [], 0, 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            size += batch.nbytes
            if rows >= BLOCK_ROWS or size >= BLOCK_BYTES:
                yield _block(held, part_no, block_no, lengths)
                held, rows, size, block_no = [], 0, 0, block_no + 1
        if rows:
            yield _block(held, part_no, block_no, lengths)

    schema = "bin_id string, bin_length int, bin_used long, bin_offset long, doc_id long, piece int, start long, size long, part string"
    spread = spread.sortWithinPartitions("doc_id", "piece", "start", "size") if not with_text else spread
    out = spread.mapInArrow(fill, schema)
    return out if with_text else out.drop("part")


def _block(held, part_no: int, block_no: int, lengths):
    batch = pa.Table.from_batches(held).combine_chunks().sort_by([("doc_id", "ascending"), ("piece", "ascending"), ("size", "ascending")])
    sizes = [n + 1 for n in batch.column("size").to_pylist()]
    number, offset, length = pack(sizes, lengths)
    used = [0] * len(length)
    for b, n in zip(number, sizes):
        used[b] += n
    return pa.RecordBatch.from_arrays(
        [pa.array([f"{part_no}-{block_no}-{b}" for b in number]), pa.array([length[b] for b in number], pa.int32()),
         pa.array([used[b] for b in number], pa.int64()), pa.array(offset, pa.int64()),
         *[batch.column(c).combine_chunks() for c in ("doc_id", "piece", "start", "size", "part")]],
        names=["bin_id", "bin_length", "bin_used", "bin_offset", "doc_id", "piece", "start", "size", "part"],
    )


def op8_variable_best_fit(spark, sf):
    """All documents in sequences of 256 to 2,048 words: where each piece of each text goes."""
    return packed(ready(spark).read.parquet(f"{sf}/documents.parquet"))
