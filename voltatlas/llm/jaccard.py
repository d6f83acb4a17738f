"""Exact Jaccard join of word shingles, filtered under several global orders of the shingles.

Texts with equal sets are one class from the start.  Order one, a hash order, gives
each set a prefix; similar sets share at least ``overlap`` shingles within their
prefixes, so a set with fewer shared ones is out.  Order two, rarity, sorts the shared
shingles of a prefix and drops the ``overlap - 1`` most frequent: similar sets still
share one of the others.  What passes both, and a bound on the difference from
parity bits, forms loose clusters; the sets of a cluster then meet once and are compared
exactly.  Links only matter as connections, so a set is not compared with sets
it is already connected to.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltatlas.llm import arrays as A
from voltatlas.llm.common import columns, map_texts, ready, release, written
from voltatlas.llm.components import components
from voltatlas.llm.groups import block_pairs, forest, sorted_groups

# Rows of one group that a task compares at once; larger groups meet in pairs of blocks.
BLOCK_ROWS = 4096
# Bytes of sets in one block.
BLOCK_BYTES = 8 << 20


def least_partner(n, percent: int):
    """Smallest set that a set of n can be similar to: ceil(percent * n / 100)."""
    return (percent * n + 99) // 100


def overlap(n):
    """Shared shingles asked for within two prefixes; grows with the smaller set."""
    return np.maximum(1, n // 25)


def prefix(n, percent: int):
    return n - least_partner(n, percent) + overlap(n)


def shingle_sets(texts: list[bytes | None], width: int):
    """Each text's distinct shingles, as hashes in hash order, with where each text's begin.

    Words are lower-cased in A-Z.  A text of fewer words has its whole sequence as its
    one shingle, one without words none.
    """
    buf, begin = A.joined(texts)
    ws, we = A.word_spans(buf)
    own = A.owner(begin, ws)
    words = A.Spans(A.BYTE_CODE[A.LOWER[buf]]).of(ws, we)
    n_words = np.bincount(own, minlength=len(texts))
    at = np.flatnonzero(A.in_one(own, width))
    parts, owners = [A.grams(words, width)[at]], [own[at]]
    first = np.concatenate([[0], np.cumsum(n_words)])
    for k in range(1, width):
        few = np.flatnonzero(n_words == k)
        parts.append(A.mix(A.grams(words, k)[first[few]] + A.U(k)) if len(few) else np.zeros(0, A.U))
        owners.append(few)
    h, o = np.concatenate(parts), np.concatenate(owners)
    order = np.lexsort((h, o))
    h, o = h[order], o[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
    h, o = h[new], o[new]
    return h, np.concatenate([[0], np.cumsum(np.bincount(o, minlength=len(texts)))])


def class_of(h: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One 64-bit name for each set; equal sets have equal names."""
    sums = np.concatenate([[A.U(0)], np.cumsum(A.mix(h * A.U(0x9FB21C651E98DF25)))])
    return A.mix(sums[bounds[1:]] - sums[bounds[:-1]] + np.diff(bounds).astype(A.U) * A.U(0xD1342543DE82EF95)).view(np.int64)


def _signatures(width: int, percent: int):
    def run(rest, texts):
        h, bounds = shingle_sets(texts, width)
        n = np.diff(bounds)
        q = np.where(n > 0, prefix(n, percent), 0)
        start = np.concatenate([[0], np.cumsum(q)])
        take = np.arange(start[-1]) - np.repeat(start[:-1], q) + np.repeat(bounds[:-1], q)
        lists = pa.ListArray.from_arrays(pa.array(start.astype(np.int32)), pa.array(h[take].view(np.int64)))
        yield pa.RecordBatch.from_arrays(
            [*rest.columns, pa.array(n), pa.array(class_of(h, bounds)), lists], names=["doc_id", "row", "n", "c", "head"]
        )

    return run


def parity(tokens: np.ndarray) -> bytes:
    """Parity of the set's tokens in each of at least 2n places; places halve by folding."""
    places = 1 << max(6, int(2 * len(tokens) - 1).bit_length())
    spot = (A.mix(tokens ^ A.U(0x5851F42D4C957F2D)) & A.U(places - 1)).astype(np.int64)
    return np.packbits(np.bincount(spot, minlength=places) & 1).tobytes()


def _full_sets(width: int):
    """The set and its parity bits for each text asked for, once more from the text."""

    def run(rest, texts):
        # Rows given many times are read once a batch.
        asked, one = np.unique(rest.column("c").to_numpy(), return_index=True)
        h, bounds = shingle_sets([texts[i] for i in one], width)
        c = class_of(h, bounds)
        want = np.flatnonzero(c == asked)
        sets = [h[bounds[i] : bounds[i + 1]] for i in want]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c[want]), pa.array([len(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary()),
             pa.array([parity(s) for s in sets], pa.binary())],
            names=["c", "n", "tokens", "bits"],
        )

    return run


class Difference:
    """A lower bound on the symmetric difference of sets, from parity bits of different length."""

    def __init__(self, n: np.ndarray, bits: list[bytes]) -> None:
        self.n = n
        size = np.array([len(b) for b in bits])
        self.level = np.log2(size).astype(int)
        self.slot = np.zeros(len(bits), np.int64)
        self.rows: dict[int, np.ndarray] = {}
        for lv in np.unique(self.level):
            own = np.flatnonzero(self.level == lv)
            self.slot[own] = np.arange(len(own))
            self.rows[int(lv)] = np.frombuffer(b"".join(bits[i] for i in own), np.uint64).reshape(len(own), -1)
        self.folded = {lv: _fold(m) for lv, m in self.rows.items() if m.shape[1] > 1}

    def near(self, percent: int):
        """For ``forest``: whether sizes and parity bits leave room for the similarity."""

        def near(v: int, others: np.ndarray) -> np.ndarray:
            nv, lv = self.n[v], int(self.level[v])
            n = self.n[others]
            ok = np.minimum(n, nv) * 100 >= percent * np.maximum(n, nv)
            mine = self.rows[lv][self.slot[v]]
            for level in (lv - 1, lv, lv + 1):
                at = np.flatnonzero(ok & (self.level[others] == level))
                if not len(at):
                    continue
                slot = self.slot[others[at]]
                if level == lv:
                    gap = self.rows[lv][slot] ^ mine
                elif level < lv:
                    gap = self.rows[level][slot] ^ self.folded[lv][self.slot[v]]
                else:
                    gap = self.folded[level][slot] ^ mine
                apart = np.bitwise_count(gap).sum(axis=1, dtype=np.int64)
                # J >= p means a difference of at most (1 - p) / (1 + p) of both sizes together.
                ok[at] = (100 + percent) * apart <= (100 - percent) * (n[at] + nv)
            return ok

        return near


def _fold(m: np.ndarray) -> np.ndarray:
    half = m.shape[1] // 2
    return m[:, :half] ^ m[:, half:]


EDGES = "a long, b long"


def _edge_batch(c: np.ndarray, links: list[tuple[int, int]]) -> pa.RecordBatch:
    ends = np.array(links, np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(c[ends[:, 0]]), pa.array(c[ends[:, 1]])], names=["a", "b"])


def _loose(percent: int, batches):
    """Classes of one shared shingle that sizes and parity bits connect."""
    for group in sorted_groups(batches, ["token", "left", "right"]):
        c = group.column("c").to_numpy()
        bound = Difference(group.column("n").to_numpy(), group.column("bits").to_pylist())
        if links := list(forest(len(c), bound.near(percent))):
            yield _edge_batch(c, links)


def _exact(percent: int, batches):
    """Sets of one cluster that are similar, up to connection."""
    for group in sorted_groups(batches, ["root", "left", "right"]):
        c, n = group.column("c").to_numpy(), group.column("n").to_numpy()
        sets = [np.frombuffer(t, np.uint64) for t in group.column("tokens").to_pylist()]
        near = Difference(n, group.column("bits").to_pylist()).near(percent)

        def similar(v, others, near=near, n=n, sets=sets):
            ok = near(v, others)
            for k in np.flatnonzero(ok):
                u = others[k]
                small, large = (sets[v], sets[u]) if n[v] < n[u] else (sets[u], sets[v])
                found = np.minimum(np.searchsorted(large, small), len(large) - 1)
                both = int((large[found] == small).sum())
                ok[k] = 100 * both >= percent * (n[v] + n[u] - both)
            return ok

        if links := list(forest(len(c), similar)):
            yield _edge_batch(c, links)


def linked(docs: DataFrame, width: int = 3, percent: int = 90) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``.

    Null and empty texts have no shingles and are linked with nothing; rows given
    twice have equal sets and are linked; a component of rows without any id has a
    null id; an empty table gives no rows.  A row is known by the hash of its id and
    text, so ids may be null or stand with several texts.
    """
    docs = columns(docs, "doc_id", "text")
    docs = docs.select("doc_id", F.xxhash64("doc_id", F.col("text").cast("binary")).alias("row"), "text")
    signs = map_texts(docs, _signatures(width, percent), "doc_id long, row long, n long, c long, head array<long>")
    signs = written(signs, "jaccard-signatures")
    # A shingle counts as shared when two classes have it in their prefixes; its frequency orders it.
    tokens = signs.select("c", "n", F.explode("head").alias("token"))
    shared = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df"), F.min("c").alias("lo"), F.max("c").alias("hi"))
    shared = shared.where("lo < hi").select("token", "df")
    heads = tokens.join(shared, "token").groupBy("c", "n").agg(F.array_sort(F.collect_set(F.struct("df", "token"))).alias("open"))
    asked = F.greatest(F.lit(1), F.expr(f"(({percent} * n + 99) div 100) div 25"))
    heads = heads.withColumn("asked", asked).where(F.size("open") >= F.col("asked"))
    rare = F.slice("open", F.lit(1), (F.size("open") - F.col("asked") + 1).cast("int"))
    heads = written(heads.select("c", "n", rare["token"].alias("tokens")), "jaccard-index")
    # The shuffles of the shingles go before those of the texts come.
    del tokens, shared
    release(docs.sparkSession)
    # The sets of the classes still in play, from one text each.
    one = signs.where("n > 0").groupBy("c").agg(F.min("row").alias("row")).join(heads.select("c"), "c")
    texts = docs.select("row", "text").join(one.hint("shuffle_hash"), "row").select("c", "text")
    sets = map_texts(texts, _full_sets(width), "c long, n long, tokens binary, bits binary").dropDuplicates(["c"])
    sets = written(sets, "jaccard-sets")
    release(docs.sparkSession)
    # Loose clusters.
    index = heads.select("c", "n", F.explode("tokens").alias("token"))
    groups = index.groupBy("token").agg(F.count(F.lit(1)).alias("g")).where("g > 1")
    index = index.join(groups, "token").join(sets.select("c", "bits"), "c")
    index = block_pairs(index, F.ceil(F.col("g") / BLOCK_ROWS), F.xxhash64("c")).drop("g")
    index = index.repartition("token", "left", "right").sortWithinPartitions("token", "left", "right", "n", "c")
    loose = index.mapInArrow(partial(_loose, percent), EDGES)
    clusters = written(components(loose), "jaccard-clusters")
    # Exact links within a cluster.
    rows = sets.join(clusters, sets["c"] == clusters["node"]).drop("node")
    size = rows.groupBy("root").agg(F.sum(F.octet_length("tokens")).alias("bytes"))
    rows = block_pairs(rows.join(size, "root"), F.ceil(F.col("bytes") / BLOCK_BYTES), F.xxhash64("c")).drop("bytes")
    rows = rows.repartition("root", "left", "right").sortWithinPartitions("root", "left", "right", "n", "c")
    roots = components(rows.mapInArrow(partial(_exact, percent), EDGES)).withColumnRenamed("root", "of")
    classes = signs.select("doc_id", F.col("n").alias("n_shingles"), "c").join(roots, F.col("c") == F.col("node"), "left")
    classes = classes.select("doc_id", "n_shingles", F.coalesce("of", "c").alias("of"))
    least = classes.where("n_shingles > 0").groupBy("of").agg(F.min("doc_id").alias("least"))
    alone = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("least"))
    return classes.join(least, "of", "left").select("doc_id", "n_shingles", alone.alias("component_id"))


def op9_multi_order_jaccard(spark, sf):
    """All documents linked at 90% of their three-word shingles."""
    return linked(ready(spark).read.parquet(f"{sf}/documents.parquet"))
