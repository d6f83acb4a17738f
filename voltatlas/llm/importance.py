"""Importance resampling towards a target corpus, cut at an exact score without sorting the corpus.

Word runs of both corpora fall into hash buckets; the log ratio of a bucket's shares
is its gain, and an array of all gains scores every document.  Noise of the Gumbel
kind makes "the highest scores" a draw by weight.  The cut is selected by weighted
medians of medians: every partition tells the median of the keys it has left, the
median of these by their numbers is the pivot, and whichever side of it cannot hold
the cut is discarded, at least a quarter of the keys.  Only the winners are sorted.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltatlas.llm import arrays as A
from voltatlas.llm.checksums import crc32
from voltatlas.llm.common import columns, map_texts, pieces, ready, written
from voltatlas.llm.sql import CRC_TABLE, LOWER_ASCII
from voltatlas.llm.sql import crc32 as sql_crc32

BUCKETS, SEED, DRAW_PERCENT, LEAST_WORDS = 10_000, 2024, 10, 20
# Keys left that one sort settles.
SMALL = 4096

_SIGN = np.ones(256, bool)
_SIGN[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


def features(texts: list[bytes | None], widths: range, buckets: int):
    """Text number and bucket of every run of words, and the number of words of each text."""
    buf, begin = A.joined(texts)
    gap = _SIGN[buf]
    ws, we = A.runs(~gap)
    own = A.owner(begin, ws)
    # Words with one blank after each: the runs are stretches of this.
    low = A.LOWER[buf]
    low[gap] = 32
    keep = ~gap
    keep[1:] |= ~gap[:-1]
    at = np.cumsum(keep) - 1
    low, ws, we = low[keep], at[ws], at[we]
    owners, found = [], []
    for n in widths:
        first = np.flatnonzero(A.in_one(own, n))
        owners.append(own[first])
        found.append(crc32(low, ws[first], we[first + n - 1]).astype(np.int64) % buckets)
    return np.concatenate(owners), np.concatenate(found), np.bincount(own, minlength=len(texts))


def _counted(widths: range, buckets: int, batches):
    """Features of a task in each bucket."""
    total = np.zeros(buckets, np.int64)
    for batch in batches:
        texts = batch.column(0).to_pylist()
        for lo, hi in pieces(texts):
            total += np.bincount(features(texts[lo:hi], widths, buckets)[1], minlength=buckets)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["bucket", "n"])


def bucket_counts(texts: DataFrame, widths: range = range(1, 2), buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts in each bucket: one number a bucket comes to the driver, however many texts there are."""
    plain = texts.select(F.col("text").cast("binary").alias("text")).where("text is not null")
    rows = plain.mapInArrow(partial(_counted, widths, buckets), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(buckets, np.int64)
    for r in rows:
        out[r.bucket] = r.n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """1,000 times the log ratio of a bucket's shares, with one added to each count, rounded down."""
    n = len(corpus)
    up = (target + 1).astype(float) * float(corpus.sum() + n)
    down = (corpus + 1).astype(float) * float(target.sum() + n)
    return np.floor(1000.0 * np.log(up / down)).astype(np.int64)


def weighed(docs: DataFrame, gain: np.ndarray, widths: range = range(1, 2)) -> DataFrame:
    """``doc_id, n_words, n_features, weight`` for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)  # one number a bucket

    def run(rest, texts):
        own, bucket, words = features(texts, widths, len(shared.value))
        # Sums of whole numbers in doubles: exact up to 2**53.
        weight = np.bincount(own, weights=shared.value[bucket], minlength=len(texts)).astype(np.int64)
        n = np.bincount(own, minlength=len(texts)).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [rest.column(0), pa.array(words.astype(np.int64)), pa.array(n), pa.array(weight)], names=["doc_id", "n_words", "n_features", "weight"]
        )

    return map_texts(columns(docs, "doc_id", "text"), run, "doc_id long, n_words long, n_features long, weight long")


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """Noise of the document's id, rounded down: the same in every run."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000.0 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


KEY = ["a", "b", "c"]


def _after(key: tuple, inclusive: bool = False) -> Column:
    """Whether a row's key comes after ``key``."""
    out = F.lit(inclusive)
    for name, v in reversed(list(zip(KEY, key))):
        out = (F.col(name) > F.lit(v)) | ((F.col(name) == F.lit(v)) & out)
    return out


def _medians(batches):
    """Median key of a partition, and the number of its keys."""
    cols = [[], [], []]
    for batch in batches:
        for held, name in zip(cols, KEY):
            held.append(batch.column(name).to_numpy())
    a, b, c = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in cols)
    if not len(a):
        return
    # The median's first part is found without a sort; only keys that share it are sorted.
    k = (len(a) - 1) // 2
    mid = np.partition(a, k)[k]
    same = np.flatnonzero(a == mid)
    at = same[np.lexsort((c[same], b[same]))[k - int((a < mid).sum())]]
    yield pa.RecordBatch.from_arrays([pa.array([int(x[at])]) for x in (a, b, c)] + [pa.array([len(a)])], names=[*KEY, "n"])


def cut_key(keys: DataFrame, k: int, small: int = SMALL) -> tuple | None:
    """The ``k``-th key of ``keys`` (columns a, b, c; all different), from 1, in ascending order; None if there are fewer.

    One row a partition comes to the driver in each round.  What is left is written
    anew when it has shrunk to a quarter, so all rounds together read a few times the keys.
    """
    left = stored = keys.count()
    if not 1 <= k <= left:
        return None
    rest = keys
    while left > small:
        found = sorted(tuple(r) for r in rest.mapInArrow(_medians, "a long, b long, c long, n long").collect())
        upto = np.cumsum([r[3] for r in found])
        pivot = found[int(np.searchsorted(upto, (upto[-1] + 1) // 2))][:3]
        below = rest.where(~_after(pivot, True)).count()
        if below == k - 1:
            return pivot
        # The pivot itself goes with the side that is discarded.
        if below >= k:
            rest, left = rest.where(~_after(pivot, True)), below
        else:
            rest, left, k = rest.where(_after(pivot)), left - below - 1, k - below - 1
        if 4 * left <= stored:
            rest, stored = written(rest, "resample-keys"), left
    return tuple(rest.orderBy(*KEY).limit(k).collect()[-1])  # at most ``small`` rows


def resampled(
    docs: DataFrame,
    target: DataFrame,
    widths: range = range(1, 2),
    buckets: int = BUCKETS,
    seed: int = SEED,
    percent: int = DRAW_PERCENT,
    least_words: int = LEAST_WORDS,
    small: int = SMALL,
) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` for every row of ``docs``; ``rank`` is null for those not drawn.

    Null and empty texts have no features and weigh 0; a null id has noise of
    its own and comes last among equal scores; repeated rows are drawn one by one;
    an empty target gives gains of the corpus alone; an empty table gives no
    rows; other columns are not looked at.
    """
    texts = columns(docs, "doc_id", "text")
    gain = gains(bucket_counts(texts, widths, buckets), bucket_counts(columns(target, "text"), widths, buckets))
    scored = weighed(texts, gain, widths).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
    # Rows alike in score and id are told apart by a number of the row, so that all keys are different.
    scored = written(scored.withColumn("c", F.monotonically_increasing_id()), "resample-scores")
    scored = scored.withColumns({"a": -F.col("score"), "b": F.coalesce("doc_id", F.lit((1 << 63) - 1))})
    asked = scored.where(F.col("n_words") >= least_words)
    out = ["doc_id", "n_features", "weight", "score"]
    cut = cut_key(asked.select(*KEY), percent * asked.count() // 100, small)
    if cut is None:
        return scored.select(*out, F.lit(None).cast("long").alias("rank"))
    drawn = ~_after(cut) & (F.col("n_words") >= least_words)
    winners = scored.where(drawn).repartitionByRange(*KEY).sortWithinPartitions(*KEY)
    winners = written(winners.select(*out, *KEY, F.spark_partition_id().alias("part")), "resample-winners")
    counts = winners.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = F.broadcast(counts.select("part", before.alias("before")))  # one row a partition
    place = F.row_number().over(Window.partitionBy("part").orderBy(*KEY))
    winners = winners.withColumn("place", place).join(counts, "part").select(*out, (F.col("before") + F.col("place")).cast("long").alias("rank"))
    return winners.unionByName(scored.where(~drawn).select(*out, F.lit(None).cast("long").alias("rank")))


OP12_SQL = rf"""
with {CRC_TABLE},
d as (select doc_id, list_filter(regexp_extract_all({LOWER_ASCII.format('text')}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') as ws from documents),
b as (select unnest(regexp_extract_all({LOWER_ASCII.format('text')}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as w from benchmark),
dw as (select doc_id, w, count(*) as n from (select doc_id, unnest(ws) as w from d) group by all),
words as (select distinct w from (select w from dw union all select w from b)),
codes as (select w, {sql_crc32('w')} % 10000 as k from words, crc_table),
s as (select k, sum(n) as n from dw join codes using (w) group by k),
t as (select k, count(*) as n from b join codes using (w) group by k),
g as (select k, floor(1000 * ln(((coalesce(t.n, 0) + 1)::double * ((select sum(n) from s) + 10000)::double)
                                / ((coalesce(s.n, 0) + 1)::double * (coalesce((select sum(n) from t), 0) + 10000)::double)))::bigint as gain
      from (select distinct k from codes) left join s using (k) left join t using (k)),
w as (select doc_id, sum(n)::bigint as n, sum(n * gain)::bigint as weight from dw join codes using (w) join g using (k) group by doc_id),
r as (select d.doc_id, coalesce(n, 0)::bigint as n_features, coalesce(weight, 0)::bigint as weight,
             ('0x' || left(sha256('2024:' || coalesce(d.doc_id::varchar, '')), 8))::bigint as h
      from d left join w on d.doc_id = w.doc_id),
q as (select doc_id, n_features, weight, weight + floor(-1000 * ln(-ln((h + 0.5::double) / 4294967296::double)))::bigint as score from r),
e as (select doc_id, row_number() over (order by score desc, doc_id) as rank, count(*) over () as n from q where n_features >= 20)
select q.*, e.rank::bigint as rank from q left join e on q.doc_id = e.doc_id and e.rank <= 10 * e.n // 100
"""


def op12_median_resample(spark, sf):
    """All documents scored towards the benchmark's words; a tenth of those with 20 words or more drawn."""
    ready(spark)
    return resampled(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet"))
