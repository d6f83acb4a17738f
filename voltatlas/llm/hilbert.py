"""Approximate nearest neighbours by shifted Hilbert orderings.

Vectors are projected to a few dimensions, several times, and ordered along a
Hilbert curve through a shifted grid; Spark partitions each ordering by range into
blocks.  A query looks into the blocks around its own in every ordering, and what
they hold is ranked by the exact product of the original vectors.  A window is a
share of the ordering: for vectors without any structure recall depends on that share.
"""

from __future__ import annotations

import math
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltatlas.llm.common import ready, written


def hilbert_key(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each row's cell on the Hilbert curve through a grid of ``2**bits`` cells a side (at most 63 bits in all).

    The cell's coordinates are turned into the transposed index by undoing, from
    the top bit down, the reflections and exchanges of axes that the curve makes.
    """
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    for b in range(bits - 1, 0, -1):
        low = (1 << b) - 1
        for k in range(dims):
            up = (x[k] >> b & 1).astype(bool)
            swap = np.where(up, 0, (x[0] ^ x[k]) & low)
            x[0] ^= np.where(up, low, swap)
            if k:
                x[k] ^= swap
    for k in range(1, dims):
        x[k] ^= x[k - 1]
    turn = np.zeros(x.shape[1], np.int64)
    for b in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] >> b & 1, (1 << b) - 1, 0)
    x ^= turn
    key = np.zeros(x.shape[1], np.int64)
    for b in range(bits - 1, -1, -1):
        for k in range(dims):
            key = key << 1 | (x[k] >> b & 1)
    return key


# Orderings, the dimensions each projects to, and bits of a cell in each dimension.
CURVES, DIMS, CELL_BITS = 8, 6, 8
# Blocks of an ordering at least, rows of a block at most, and the share of an ordering that a window spans.
LEAST_BLOCKS, BLOCK_ROWS, SHARE = 32, 4096, 0.2
# Vectors that the projections' ranges are taken from, the ones with the least hash.
SAMPLE = 4096
SEED = 11


class Orderings:
    """Seeded projections, shifted grids and the ranges of the grids."""

    def __init__(self, sample: np.ndarray, longest: float) -> None:
        rng = np.random.default_rng(SEED)
        dim = sample.shape[1] + 1
        dims = min(DIMS, dim)
        self.longest = longest
        self.axes = [np.linalg.qr(rng.normal(size=(dim, dim)))[0][:, :dims] for _ in range(CURVES)]
        self.low, self.span = [], []
        lifted = self.lifted(sample)
        for axes in self.axes:
            y = lifted @ axes
            low, high = y.min(axis=0), y.max(axis=0)
            width = np.maximum(high - low, 1e-12)
            shift = rng.random(dims) * width / 4
            self.low.append(low - shift)
            self.span.append(width * 1.25)

    def lifted(self, x: np.ndarray) -> np.ndarray:
        """One more coordinate makes all vectors equally long, so that the largest product is the least distance."""
        rest = np.sqrt(np.maximum(self.longest**2 - (x * x).sum(axis=1), 0.0))
        return np.hstack([x, rest[:, None]])

    def keys(self, x: np.ndarray) -> list[np.ndarray]:
        lifted = self.lifted(x)
        top = (1 << CELL_BITS) - 1
        cells = [np.clip((lifted @ a - lo) / w * (top + 1), 0, top) for a, lo, w in zip(self.axes, self.low, self.span)]
        return [hilbert_key(c, CELL_BITS) for c in cells]


def matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def windows(sizes: list[tuple[int, int, int]], rows: int) -> list[tuple[int, int, int, int]]:
    """``curve, block, low, high`` from ``curve, block, rows``: the blocks that hold ``rows`` rows of the ordering on either side of a block.

    Where an ordering ends before that, its other side holds no more: a small ordering is one window.
    """
    out = []
    for curve in sorted({c for c, _, _ in sizes}):
        own = sorted((b, n) for c, b, n in sizes if c == curve)
        upto = np.cumsum([n for _, n in own])
        for i, (block, n) in enumerate(own):
            low = int(np.searchsorted(upto, upto[i] - n - rows, side="right"))
            high = min(int(np.searchsorted(upto, upto[i] + rows)), len(own) - 1)
            out.append((curve, block, own[low][0], own[high][0]))
    return out


def _search(width: int, most: int, batches):
    """The best of one block for each query that looks into it; candidates come before queries."""
    ids = vectors = block = None
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column("block").to_numpy().astype(np.int64) * 2 + batch.column("asks").to_numpy(zero_copy_only=False).astype(np.int64)
        bounds = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), batch.num_rows]
        for lo, hi in zip(bounds[:-1], bounds[1:]):
            part, at = batch.slice(lo, hi - lo), int(key[lo])
            if at % 2 == 0:
                if block != at // 2:
                    block, held = at // 2, []
                held.append(part)
                ids = None
                continue
            if block != at // 2:
                continue  # a block without candidates
            if ids is None:
                table = pa.Table.from_batches(held).combine_chunks()
                ids, vectors = table.column("vid").to_numpy(), matrix(table.column("e").combine_chunks())
            asked, q = part.column("vid").to_numpy(), matrix(part.column("e"))
            for first in range(0, len(asked), 64):
                some = q[first : first + 64]
                rough = some @ vectors.T
                # A few more than asked for, since the last digits of the product depend on the block.
                k = min(most + 8, len(ids))
                best = np.argpartition(-rough, k - 1, axis=1)[:, :k]
                score = np.stack([(vectors[b] * s).sum(axis=1) for b, s in zip(best, some)])
                order = np.lexsort((ids[best], -score), axis=1)[:, :most]
                n = order.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(asked[first : first + 64], n)), pa.array(np.take_along_axis(ids[best], order, 1).ravel()), pa.array(np.take_along_axis(score, order, 1).ravel())],
                    names=["qid", "vid", "score"],
                )


def nearest(table: DataFrame, asks: Column, most: int = 20, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row for which ``asks`` holds, the ``most`` other rows of largest product found.

    Vectors that are null, empty, all zero or hold a null or a non-finite number
    take no part, nor do rows without an id or of another dimension than the
    longest vectors.  Equal vectors are searched once and count each.  Rows given
    twice count once.  With ``most`` rows or fewer in all, all are returned; an empty
    table gives no rows.
    """
    spark = table.sparkSession
    e = F.col(vector)
    fine = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(e, lambda x: x != 0)
    rows = table.where(e.isNotNull() & F.col(id).isNotNull()).where(fine)
    rows = rows.select(F.col(id).cast("long").alias("id"), e.alias("e"), F.coalesce(asks, F.lit(False)).alias("asks"))
    # Of equal vectors the first few ids are enough for any answer.
    top = Window.partitionBy("e").orderBy("id")
    some = rows.select("id", "e").distinct().withColumn("k", F.row_number().over(top)).where(F.col("k") <= most + 1)
    some = some.groupBy("e").agg(F.min("id").alias("vid"), F.collect_list("id").alias("ids"))
    asking = rows.groupBy("e").agg(F.max("asks").alias("asks"))
    vectors = written(some.join(asking, "e").select("vid", "e", "ids", "asks"), "ann-vectors")
    size = vectors.agg(F.max(F.size("e"))).first()[0]
    if size is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    vectors = vectors.where(F.size("e") == size)
    square = F.aggregate("e", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    n, longest = vectors.agg(F.count(F.lit(1)), F.sqrt(F.max(square))).first()
    few = vectors.orderBy(F.xxhash64("vid"), "vid").limit(SAMPLE).select("e").collect()  # a bounded sample
    orderings = Orderings(np.array([r.e for r in few], np.float64), longest)  # a few thousand numbers

    def order(batches):
        for batch in batches:
            if batch.num_rows:
                for curve, key in enumerate(orderings.keys(matrix(batch.column("e")))):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(key), curve, np.int32)), pa.array(key), *batch.columns], names=["curve", "key", *batch.schema.names]
                    )

    kind = vectors.schema["e"].dataType.simpleString()
    keyed = vectors.select("vid", "e", "asks").mapInArrow(order, f"curve int, key long, vid long, e {kind}, asks boolean")
    blocks = CURVES * max(LEAST_BLOCKS, -(-n // BLOCK_ROWS))
    ordered = keyed.repartitionByRange(blocks, "curve", "key", "vid").withColumn("block", F.spark_partition_id())
    ordered = written(ordered.select("curve", "block", "vid", "e", "asks"), "ann-order")
    sizes = ordered.groupBy("curve", "block").agg(F.count(F.lit(1)).alias("n")).collect()  # a row or two a block
    looks = spark.createDataFrame(windows(sizes, max(math.ceil(SHARE * n / 2), 2 * (most + 1))), "curve int, block int, low int, high int")
    queries = ordered.where("asks").join(F.broadcast(looks), ["curve", "block"])
    queries = queries.select(F.explode(F.sequence("low", "high")).alias("block"), "vid", "e", "asks")
    meet = ordered.select("block", "vid", "e", F.lit(False).alias("asks")).unionByName(queries)
    meet = meet.repartition("block").sortWithinPartitions("block", "asks")
    found = meet.mapInArrow(partial(_search, size, most + 1), "qid long, vid long, score double")
    best = Window.partitionBy("qid").orderBy(F.desc("score"), "vid")
    found = found.dropDuplicates(["qid", "vid"]).withColumn("k", F.row_number().over(best)).where(F.col("k") <= most + 1)
    ids = vectors.select("vid", "ids")
    found = found.join(ids, "vid").select("qid", "score", F.explode("ids").alias("vec_id"))
    first = Window.partitionBy("qid").orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("k", F.row_number().over(first)).where(F.col("k") <= most + 1)
    wanted = rows.where("asks").select("id", "e").distinct().join(vectors.select("e", "vid"), "e").select(F.col("id").alias("query_id"), F.col("vid").alias("qid"))
    answers = wanted.join(found, "qid").where(F.col("vec_id") != F.col("query_id"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return answers.withColumn("rank", rank.cast("int")).where(F.col("rank") <= most).select("query_id", "rank", "vec_id", "score")


def op2_hilbert_neighbours(spark, sf):
    """The 20 nearest of every vector whose id is divisible by 20."""
    return nearest(ready(spark).read.parquet(f"{sf}/embeddings.parquet"), F.col("vec_id") % 20 == 0)
