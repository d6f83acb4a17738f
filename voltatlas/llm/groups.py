"""Groups of rows that a task meets one after the other, and spanning forests within a group."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def block_pairs(df: DataFrame, blocks: Column, salt: Column) -> DataFrame:
    """Each row once for every pair of blocks that its block is in, as ``left`` and ``right``.

    A group of one block stays as it is.  A large group becomes ``blocks`` blocks
    by hash, and every two of them meet somewhere, so no task holds more than two.
    """
    df = df.withColumn("blocks", blocks.cast("int")).withColumn("block", F.pmod(salt, F.col("blocks")).cast("int"))
    # One block: the pair (0, 0).  More: the pairs of distinct blocks, which also hold the pairs within a block.
    other = F.when(F.col("blocks") == 1, F.array(F.lit(0))).otherwise(F.expr("filter(sequence(0, blocks - 1), x -> x <> block)"))
    df = df.withColumn("other", F.explode(other))
    return df.withColumn("left", F.least("block", "other")).withColumn("right", F.greatest("block", "other")).drop("blocks", "block", "other")


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of whole groups from batches that come sorted by ``keys``, one group each."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        key = np.stack([batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in keys])
        cut = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
        bounds = [0, *cut.tolist(), batch.num_rows]
        for lo, hi in zip(bounds[:-1], bounds[1:]):
            if last is not None and (key[:, lo] != last).any():
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
            held.append(batch.slice(lo, hi - lo))
            last = key[:, lo]
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str], rows: int) -> Iterator[pa.Table]:
    """Tables of one or more whole groups, of ``rows`` rows or one group more, from sorted batches."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        if size >= rows:
            both = pa.Table.from_batches([held[-1].slice(held[-1].num_rows - 1), batch]).combine_chunks()
            key = np.stack([both.column(k).to_numpy().astype(np.int64) for k in keys])
            cut = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0))
            if len(cut):
                held.append(batch.slice(0, int(cut[0])))
                yield pa.Table.from_batches(held).combine_chunks()
                held, size, batch = [], 0, batch.slice(int(cut[0]))
        held.append(batch)
        size += batch.num_rows
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def forest(n: int, near: Callable[[int, np.ndarray], np.ndarray]) -> Iterator[tuple[int, int]]:
    """Links that connect what ``near`` connects; ``near(i, others)`` tells which of the others node i is near.

    A node that has been reached is not compared again with those reached before it.
    """
    rest = np.arange(n)
    while len(rest):
        front, rest = [int(rest[0])], rest[1:]
        while front and len(rest):
            v = front.pop()
            hit = near(v, rest)
            for u in rest[hit].tolist():
                yield v, u
                front.append(u)
            rest = rest[~hit]
