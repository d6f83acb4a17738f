"""Mixing sources to target weights by hash thresholds.

Words are summed by source and hash bucket; the bucket in which a source's budget
runs out is the only one looked into further, in buckets 4,096 times as fine, until
the threshold is exact.  Documents are then kept by comparing hashes: nothing is sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltatlas.llm.common import ready, renamed, word_count, written

# The weights of the sources in their order, repeated; the share of all words; the most times a source may be repeated.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
# The hash has 60 bits; each round settles 12 of them.
HASH_BITS, ROUND_BITS = 60, 12


def hash60(key: Column) -> Column:
    return F.conv(F.substring(F.md5(key), 1, HASH_BITS // 4), 16, 10).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``: one row a source.

    Sources in code point order, null last, weigh ``weights`` in turn.  A target
    stops at ``most`` times its source and the excess goes to the others by
    weight: sources reach their stop in order of size over weight, so the level
    at which the words run out follows from running sums.
    """
    ranked = sizes.withColumn("at", F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("at") % len(weights) + 1).cast("int")).cast("double")
    w = ranked.select("source", "source_size", weight.alias("w"), (F.col("source_size") * most).cast("double").alias("stop"))
    first = Window.orderBy(F.col("stop") / F.col("w"), F.col("source").isNull(), "source")
    everything = Window.partitionBy()
    w = (
        w.withColumn("all", F.sum("source_size").over(everything).cast("double") * share)
        .withColumn("weight", F.sum("w").over(everything))
        .withColumn("stopped", F.coalesce(F.sum("stop").over(first.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("left_w", F.col("weight") - F.coalesce(F.sum("w").over(first.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("level", (F.col("all") - F.col("stopped")) / F.col("left_w"))
    )
    # The level is that of the first source which does not reach its stop.
    over = F.min(F.when(F.col("w") * F.col("level") < F.col("stop"), F.struct(F.col("stop") / F.col("w"), "level"))).over(everything)
    return w.select("source", "source_size", F.least("stop", F.coalesce(F.col("w") * over["level"], F.col("stop"))).alias("target"))


def thresholds(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """``source, below``: documents of the source with a smaller hash together come nearest to ``rest`` words.

    ``rows`` has source, size, h; ``wanted`` has source, rest, one row a source.
    """
    state = wanted.select("source", "rest", F.lit(0).cast("long").alias("low"), F.lit(0).cast("long").alias("done"))
    found = None
    for level in range(HASH_BITS // ROUND_BITS):
        shift = HASH_BITS - ROUND_BITS * (level + 1)
        state = written(state, "mix-boundary")  # one row a source; its file size lets Spark choose how to join
        here = rows.join(state, rows["source"].eqNullSafe(state["source"])).select(rows["source"], "size", "h", "rest", "low", "done")
        if level:
            here = here.where((F.col("h") >= F.col("low")) & (F.col("h") < F.col("low") + F.lit(1 << (shift + ROUND_BITS))))
        bucket = F.shiftright(F.col("h"), shift).alias("bucket")
        sums = here.groupBy("source", bucket, "rest", "done").agg(F.sum("size").alias("words"), F.min("h").alias("least"), F.max("h").alias("most"))
        upto = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.withColumn("before", F.col("done") + F.coalesce(F.sum("words").over(upto), F.lit(0)))
        # The boundary is the first bucket that would go past the budget.
        past = F.col("before") + F.col("words") > F.col("rest")
        edge = sums.groupBy("source").agg(
            F.min(F.when(past, F.struct("bucket", "before", "words", "least", "most", "rest"))).alias("e"), F.max("most").alias("end")
        )
        edge = written(edge.select("source", "e.*", "end"), "mix-edge")
        # A boundary of one hash: in if that is nearer to the budget than out.
        closer = 2 * F.col("before") + F.col("words") <= 2 * F.col("rest")
        limit = F.when(F.col("bucket").isNull(), F.col("end") + 1).when(closer, F.col("most") + 1).otherwise(F.col("least"))
        settled = edge.where("bucket is null or least = most").select("source", limit.alias("below"))
        found = settled if found is None else found.unionByName(settled)
        state = edge.where("least < most").select("source", "rest", F.shiftleft("bucket", shift).alias("low"), F.col("before").alias("done"))
        if state.isEmpty():
            break
    return found


def mix_rows(docs: DataFrame, *extra: str) -> DataFrame:
    """``doc_id, source, size, h`` of every document, with further columns of its own."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.md5(F.col("text").cast("binary")), F.lit(""))
    names = dict.fromkeys(["doc_id", "source", *extra])
    return docs.select(*names, word_count(F.col("text")).alias("size"), hash60(key).alias("h"))


def mix_plan(rows: DataFrame) -> DataFrame:
    """One row a source: its size and target, how often all of it is taken, and below which hash once more."""
    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    goal = targets(totals)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    goal = written(goal.withColumn("whole", F.least(whole, F.lit(MOST)).cast("long")), "mix-targets")
    rest = F.col("target") - F.col("whole") * F.col("source_size")
    limits = thresholds(rows.select("source", "size", "h"), goal.select("source", rest.alias("rest")))
    plan = goal.join(limits, goal["source"].eqNullSafe(limits["source"]), "left").select(
        goal["source"].alias("of"), "source_size", "target", "whole", F.coalesce("below", F.lit(0)).alias("below")
    )
    return written(plan, "mix-plan")


def with_copies(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """How many copies of each row the mix takes: a comparison of hashes."""
    copies = F.least(F.col("whole") + (F.col("h") < F.col("below")).cast("long"), F.lit(MOST).cast("long"))
    return rows.join(plan, rows["source"].eqNullSafe(plan["of"])).withColumn("copies", copies).drop("of", "whole", "below", "h")


def mixed(docs: DataFrame) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` for every row of ``docs``.

    Null text has size 0; a null source is a source, the last; rows that share an
    id share their fate; rows with a null id are told apart by their text; an
    empty table gives no rows, a corpus without words takes nothing.
    """
    rows = written(mix_rows(docs), "mix-rows")
    taken = with_copies(rows, mix_plan(rows))
    return taken.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def mix(docs: DataFrame) -> DataFrame:
    """The mixed corpus with the columns of ``docs``, whatever their names: every document as often as it is taken."""
    inner, back = renamed(docs, "doc_id", "source", "text")
    rows = written(mix_rows(inner), "mix-rows")
    taken = with_copies(mix_rows(inner, *inner.columns), mix_plan(rows)).where("copies > 0")
    return taken.withColumn("copy", F.explode(F.expr("sequence(1L, copies)"))).select(*back)


OP5_SQL = r"""
with d as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
         ('0x' || left(md5(doc_id::varchar), 15))::bigint as h
  from documents),
s as (select source, sum(size)::bigint as source_size from d group by source),
w as (select source, source_size, source_size * 2.0::double as stop,
             case (row_number() over (order by source nulls last) - 1) % 3 when 0 then 5.0 when 1 then 2.0 else 1.0 end::double as w from s),
r as (select *, (select sum(source_size) from s)::double * 1.5::double as budget,
             coalesce(sum(stop) over (order by stop / w, source nulls last rows between unbounded preceding and 1 preceding), 0) as gone,
             sum(w) over () - coalesce(sum(w) over (order by stop / w, source nulls last rows between unbounded preceding and 1 preceding), 0) as rest_w
      from w),
v as (select arg_min((budget - gone) / rest_w, stop / w) filter (w * ((budget - gone) / rest_w) < stop) as level from r),
t as (select source, source_size, least(stop, coalesce(w * level, stop)) as target from r, v),
p as (select *, case when source_size > 0 then least(floor(target / source_size), 2) else 0 end::bigint as whole from t),
q as (select d.doc_id, d.size, p.source_size, p.target, p.whole, p.target - p.whole * p.source_size as rest, d.h, d.source,
             sum(size) over (partition by d.source order by h range between unbounded preceding and current row) as upto,
             sum(size) over (partition by d.source, h) as tied
      from d join p on d.source is not distinct from p.source)
select doc_id, size, source_size, target,
       (size * least(whole + case when size > 0 and 2 * (upto - tied) + tied <= 2 * rest then 1 else 0 end, 2))::bigint as taken
from q
"""


def op5_hash_threshold_mix(spark, sf):
    """All documents mixed: 150% of their words, by the weights of their sources."""
    docs = ready(spark).read.parquet(f"{sf}/documents.parquet")
    return mixed(docs)
