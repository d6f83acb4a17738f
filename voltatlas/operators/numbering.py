"""Row numbers over groups of any size, without one task holding a whole group.

Rows are shuffled once, by ranges of (group, order), and written sorted, each with
its place in its range.  How many rows every range got is read off what was
written; the sum over earlier ranges and the place give a row's place among all.
A group's rows are neighbours in that order, so the number in the group is the
distance from its first row.  Nothing is counted or sampled in a read of its own but for
the sample of keys that Spark takes to find the ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltatlas.session import scratch_dir

# ``monotonically_increasing_id`` keeps the number of the partition above these bits and the place in it below.
PLACE_BITS = 33


def placed_rows(df: DataFrame, order: list[Column], out: str = "_at", ranges: int | None = None) -> DataFrame:
    """Add the 0-based place ``out`` of each row in ascending ``order``; written once in the shared folder, sorted.

    ``ranges`` is the number of parts of the shuffle, by default that of all
    shuffles of the session; it decides the size of a task and nothing else.
    """
    spark = df.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])
    # A range is one partition up to the write: with a stated number Spark neither merges nor splits it.
    cut = df.withColumn("_key", key).repartitionByRange(ranges, "_key").sortWithinPartitions("_key").drop("_key")
    path = scratch_dir(spark, "ranges")
    cut = cut.withColumn("_id", F.monotonically_increasing_id())
    cut.write.option("compression", "zstd").parquet(path)
    stored = spark.read.schema(cut.schema).parquet(path).withColumn("_range", F.shiftright("_id", PLACE_BITS))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # One row a range.
    counts = stored.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows"))
    before = counts.select("_range", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    at = F.col("_before") + F.col("_id").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    return stored.join(F.broadcast(before), "_range").select(*[F.col(f"`{c}`") for c in df.columns], at.alias(out))


def number_rows(
    df: DataFrame, order: list[Column], group: list[str] | None = None, out: str = "row_number", ranges: int | None = None
) -> DataFrame:
    """Add 1-based ``out`` per group in ascending ``order``.

    ``order`` must be unique within a group.  NULLs sort first; for NULLs last
    pass ``col.isNull()`` before the column, for descending pass its negative.
    NULL is a group like any other.  The first places of groups are joined to the rows
    by a plain join: sent to all tasks while they are few, else a shuffle in which
    Spark splits a large group.
    """
    group = group or []
    placed = placed_rows(df, [*[F.col(g) for g in group], *order], "_at", ranges)
    if not group:
        return placed.select(*df.columns, (F.col("_at") + 1).alias(out))
    heads = placed.groupBy(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)]).agg(F.min("_at").alias("_head"))
    same = F.lit(True)
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    return placed.join(heads, same).select(*df.columns, (F.col("_at") - F.col("_head") + 1).alias(out))


def assign_batches(df: DataFrame, order: list[Column], size: int, ranges: int | None = None) -> DataFrame:
    """Add ``row_index`` (from 0) and ``batch_id`` (from 1, ``size`` rows each)."""
    placed = placed_rows(df, order, "row_index", ranges)
    return placed.withColumn("batch_id", F.call_function("div", F.col("row_index"), F.lit(max(1, int(size)))) + 1)


def batch_ranges(batched: DataFrame) -> DataFrame:
    """(batch_id, start_idx inclusive, end_idx exclusive)."""
    return batched.groupBy("batch_id").agg(
        F.min("row_index").alias("start_idx"), (F.max("row_index") + 1).alias("end_idx")
    )
