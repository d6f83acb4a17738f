"""Sharding by fixed virtual slots, with DataFrame functions only.

Every record hashes into one of a few thousand slots for good; a small versioned
map, stored with all its versions, says which shard each slot lives on.  Rebalancing edits
the newest version, never the hash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltatlas.llm.common import columns, ready, written
from voltatlas.session import scratch_dir

SLOTS = 4096
# Rows that one task numbers together; a slot with more is numbered in several parts.
PART_ROWS = 50_000
# Parts of a shard's size that no slot exceeds for long: larger ones are split.
SPLIT = 16
# Bytes that each row takes beside its text.
ROW_BYTES = 8


def slot_of(*keys: str, slots: int = SLOTS):
    return F.pmod(F.xxhash64(*keys), F.lit(slots)).cast("int")


def slot_bytes(rows: DataFrame, slot: str = "vslot", size: str = "size") -> DataFrame:
    """Bytes of every slot: at most ``SLOTS`` rows, reduced on the map side."""
    return rows.groupBy(slot).agg(F.sum(size).alias("bytes"))


def first_map(spark: SparkSession, shards: int, slots: int = SLOTS) -> DataFrame:
    """Version 1: the slots dealt round."""
    return spark.range(slots).select(
        F.lit(1).alias("version"), F.col("id").cast("int").alias("vslot"), F.pmod("id", F.lit(shards)).cast("int").alias("shard")
    )


def rebalanced(slot_map: DataFrame, sizes: DataFrame, shards: int, only_new: bool = False) -> DataFrame:
    """The next version of the map, with the shards' bytes nearly equal and most slots left where they are.

    A shard keeps its slots, largest first, up to the mean; the rest move, largest
    first, each to the shard that has least.  With ``only_new`` moved slots may go
    to shards that the old map does not have, and nowhere else.  The work is on
    the at most ``SLOTS`` rows of the map, however large the corpus.
    """
    from pyspark.sql import Window

    known = slot_map.join(sizes, "vslot", "left").select("version", "vslot", "shard", F.coalesce("bytes", F.lit(0)).alias("bytes"))
    order = Window.partitionBy("shard").orderBy(F.desc("bytes"), "vslot")
    cut = (
        known.withColumn("upto", F.sum("bytes").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("total", F.sum("bytes").over(Window.partitionBy()))  # of the map's rows only
        .withColumn("stays", F.col("upto") * shards <= F.col("total"))
    )
    item = F.struct((-F.col("bytes")).alias("b"), F.col("vslot").alias("v"))
    both = cut.agg(
        F.array_sort(F.collect_list(F.when(~F.col("stays"), item))).alias("moves"),
        F.collect_list(F.when(F.col("stays"), F.struct("vslot", "shard"))).alias("kept"),
        F.collect_list(F.when(F.col("stays"), F.struct("shard", "bytes"))).alias("held"),
        F.max("version").alias("old"),
        F.max("shard").alias("last"),
    )
    # Loads as (bytes, shard), so that the least of the array is the shard to fill next.
    load = f"""
        transform(sequence(0, {shards - 1}), s -> named_struct(
            'b', aggregate(filter(held, x -> x.shard = s), 0L, (a, x) -> a + x.bytes), 's', s))"""
    open_to = "filter(loads, x -> x.s > last)" if only_new else "loads"
    dealt = both.withColumn("loads", F.expr(load)).withColumn(
        "dealt",
        F.expr(
            f"""
            aggregate(moves, named_struct('loads', {open_to}, 'to', cast(array() as array<struct<vslot:int,shard:int>>)),
                (acc, m) -> named_struct(
                    'loads', transform(acc.loads, x -> if(x.s = array_min(acc.loads).s, named_struct('b', x.b - m.b, 's', x.s), x)),
                    'to', concat(acc.to, array(named_struct('vslot', m.v, 'shard', array_min(acc.loads).s)))))"""
        ),
    )
    return dealt.select((F.col("old") + 1).alias("version"), F.inline(F.expr("concat(kept, dealt.to)"))).select("version", "vslot", "shard")


MAP = "version int, vslot int, shard int"


def slot_map_at(spark: SparkSession, maps: str, version: int | None = None) -> DataFrame | None:
    """The newest version of the map stored in the folder ``maps``, or the one asked for; None if there is none."""
    from pyspark.errors import AnalysisException

    try:
        known = spark.read.schema(MAP).parquet(maps)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    if version is None:
        version = known.agg(F.max("version")).first()[0]
    return None if version is None else known.where(F.col("version") == version)


def next_map(spark: SparkSession, maps: str, sizes: DataFrame, shards: int, slots: int = SLOTS, only_new: bool = False) -> DataFrame:
    """Edit the newest stored map for these ``sizes`` and store it as one version more; older versions stay.

    Without a stored map, version 1 deals the slots round.  A slot that the map
    does not know yet (a part of a hot one) starts where dealing round puts it.
    """
    old = slot_map_at(spark, maps)
    if old is None:
        first_map(spark, shards, slots).write.mode("append").parquet(maps)
        old = slot_map_at(spark, maps)
    version = old.agg(F.max("version")).first()[0]
    fresh = sizes.join(old, "vslot", "left_anti")
    fresh = fresh.select(F.lit(version).alias("version"), "vslot", F.pmod("vslot", F.lit(shards)).cast("int").alias("shard"))
    new = rebalanced(old.select("version", "vslot", "shard").unionByName(fresh), sizes, shards, only_new)
    new.select(*[F.col(c).cast("int") for c in ("version", "vslot", "shard")]).write.mode("append").parquet(maps)
    return slot_map_at(spark, maps)


def placed(docs: DataFrame, shards: int = 24, slots: int = SLOTS, maps: str | None = None) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for every row of ``docs``.

    The law is ``bytes``: the shards' sizes are as equal as whole slots allow.  The
    map is the next version of the one in the folder ``maps`` (a new folder, if
    none is named).  A slot that would hold more than a sixteenth of a shard is split
    into parts by a further hash and the row's number, so that even one record
    given a million times spreads; parts are slots of their own in the map.
    ``slot`` is the row's place within its shard, from 0 without gaps.  Null text
    has size 8 and the checksum of nothing; rows with a null id are spread by
    their text; an empty table gives no rows; repeated rows get places of their own.
    """
    from pyspark.sql import Window

    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    rows = columns(docs, "doc_id", "text").select(
        "doc_id",
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.monotonically_increasing_id().alias("nth"),
    )
    rows = written(rows.withColumn("vslot", slot_of("doc_id", "text_crc32", slots=slots)), "shard-rows")
    per_slot = rows.groupBy("vslot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    total = F.sum("bytes").over(Window.partitionBy())  # of at most ``slots`` rows
    parts = F.greatest(F.ceil(F.col("n") / (PART_ROWS // 2)), F.ceil(F.col("bytes") * (SPLIT * shards) / total), F.lit(1))
    parts = F.broadcast(written(per_slot.select("vslot", parts.cast("int").alias("parts")), "shard-slots"))  # at most ``slots`` rows
    part = F.pmod(F.xxhash64("doc_id", "text_crc32", "nth"), F.col("parts")).cast("int")
    rows = rows.join(parts, "vslot").withColumn("vslot", F.col("vslot") + F.lit(slots) * part).drop("parts")
    # At most ``slots`` rows, and SPLIT a shard and one per PART_ROWS / 2 rows of hot slots more.
    sizes = written(rows.groupBy("vslot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")), "shard-sizes")
    slot_map = next_map(spark, maps or scratch_dir(spark, "shard-maps"), sizes.select("vslot", "bytes"), shards, slots)
    before = Window.partitionBy("shard").orderBy("vslot").rowsBetween(Window.unboundedPreceding, -1)
    where = slot_map.select("vslot", "shard").join(sizes.select("vslot", "n"), "vslot")
    where = where.select("vslot", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("vslot").orderBy("doc_id", "text_crc32", "size", "nth")
    numbered = rows.withColumn("at", F.row_number().over(inside)).join(where, "vslot")
    return numbered.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("before") + F.col("at") - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_virtual_slots(spark, sf):
    """All documents over 24 shards of nearly equal size."""
    return placed(ready(spark).read.parquet(f"{sf}/documents.parquet"))
