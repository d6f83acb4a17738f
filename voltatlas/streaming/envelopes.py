"""Envelope consumers."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from voltatlas.functions.timestamps import coerce_ts
from voltatlas.operators.align import align
from voltatlas.operators.quality import require_columns
from voltatlas.operators.lookups import landed_ids, missing_events
from voltatlas.operators.stations import (
    availability_rows,
    envelope_availability,
    envelope_searches,
    explode_results,
    map_rows,
    station_rows,
)
from voltatlas.operators.traffic import flow_fact
from voltatlas.streaming.keyindex import KeyIndex
from voltatlas.session import release
from voltatlas.specs import DIM_HISTORY, FACT_AVAILABILITY, MAP_STATIONS

# Dates of one micro-batch named in a filter; beyond it the whole table is asked.
MAX_DAYS = 10_000
# Shuffled bytes, compressed, that one task of a micro-batch takes up; rows much alike are some forty times as large when sorted for writing.
TASK_BYTES = 8 << 20

def dedupe_within(stream: DataFrame, keys: list[str], ts: str = "event_ts", delay: str = "10 minutes") -> DataFrame:
    """Drop repeats that arrive within ``delay`` of each other; state stays small.

    Rows older than the watermark are late and do not come through, so use
    this for live feeds.  ``append_once`` keeps every row, however late.
    An event whose time cannot be read counts as arriving now.
    """
    arrived = F.coalesce(coerce_ts("snapshot_ts").cast("timestamp"), F.current_timestamp())
    stamped = stream if ts in stream.columns else stream.withColumn(ts, arrived)
    return stamped.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


def traffic_rows(envelopes: DataFrame, run_ts: Column, keep: list[str] | None = None) -> DataFrame:
    """Traffic envelopes, with either form of ``raw_json``, to fact rows; stateless."""
    return flow_fact(envelopes, run_ts, keep)


def append_once(
    stream: DataFrame,
    table: str,
    checkpoint: str,
    keys: list[str],
    transform: Callable[[DataFrame], DataFrame] | None = None,
    partition: str = "event_date",
    ts: str = "snapshot_ts",
    index: KeyIndex | None = None,
) -> StreamingQuery:
    """Insert each key once, however late or often it arrives.

    Rows go to ``table`` under the date in ``ts`` as it arrived.  A micro-batch
    is cut to one row per key and then to the keys that the table's partitions
    of the same dates lack, so only those partitions are read.  If ``ts`` is not
    one of ``keys``, a key may come again with another date, and all dates are
    asked.  A micro-batch run again after a failure overwrites its own folder and
    nothing else: folders bear the id of the feed's checkpoint.
    ``transform`` must keep ``keys`` and the ``partition`` column.

    With an ``index`` the table itself is never read: the index tells which keys it
    holds, and opens only what may hold keys of the micro-batch.  All feeds of a table share one index.
    """

    def insert(batch: DataFrame, batch_no: int) -> None:
        # The stream's own session: no other query sees the setting.
        spark = batch.sparkSession
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", TASK_BYTES)
        day = F.coalesce(coerce_ts(ts).cast("date").cast("string"), F.lit("unknown"))
        dated = batch.withColumn(partition, day)
        days = [r[0] for r in dated.select(partition).distinct().limit(MAX_DAYS).collect()]
        if not days:
            return
        fresh = dated.dropDuplicates(keys)
        folder = batch_folder(spark, checkpoint, batch_no)
        if index is not None:
            # Runs are merged before this micro-batch adds its own, so one that fails can be run again.
            index.compact(spark)
            known = index.known(fresh, folder)
        else:
            known = _known_keys(spark, table, folder, keys, partition, days if ts in keys else None)
        if known is not None:
            fresh = fresh.join(known, keys, "left_anti")
        rows = require_columns(transform(fresh) if transform else fresh, [*keys, partition])
        (
            rows.withColumn("micro_batch", F.lit(folder))
            .hint("rebalance", partition)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", "zstd")
            .partitionBy(partition, "micro_batch")
            .parquet(table)
        )
        if index is not None:
            days_of = F.col(partition).cast("string").isin(days) if len(days) < MAX_DAYS else F.lit(True)
            own = spark.read.schema(rows.schema.add("micro_batch", "string")).parquet(table).where(days_of & (F.col("micro_batch") == folder))
            index.add(own, folder)

    return (
        stream.writeStream.foreachBatch(insert)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def batch_folder(spark: SparkSession, checkpoint: str, batch_no: int) -> str:
    """Name of a micro-batch that no other feed, and no later checkpoint of this one, gives again."""
    feed = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    feed = feed or hashlib.md5(checkpoint.encode()).hexdigest()
    return f"{feed}-{batch_no}"


def _stored(spark: SparkSession, table: str) -> DataFrame | None:
    """The table, or None if nothing has been written there; any other fault is raised."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(path) or not any(not s.getPath().getName().startswith(("_", ".")) for s in files.listStatus(path)):
        return None
    return spark.read.parquet(table)


def _known_keys(spark, table: str, folder: str, keys: list[str], partition: str | None, days: list[str] | None):
    """Keys already in the table (for these dates), other than from this very micro-batch."""
    have = _stored(spark, table)
    if have is None:
        return None
    same_days = F.col(partition).cast("string").isin(days) if days and len(days) < MAX_DAYS else F.lit(True)
    return have.where(same_days & (F.col("micro_batch").cast("string") != folder)).select(*keys).distinct()


def write_stations(
    stream: DataFrame, path: str, checkpoint: str, run_ts: Callable[[], Column]
) -> StreamingQuery:
    """Station envelopes to the DIM, MAP and FACT tables.

    The three tables of one micro-batch come from one read of it, which stands packed
    in a hidden folder under ``path`` until they are written, and each is
    a folder of its own per micro-batch, so a repeated one replaces itself.  An
    event that an earlier micro-batch has brought, of this feed or another, is
    left out; which events came is written last, as the table ``events``.
    """

    def insert(batch: DataFrame, batch_no: int) -> None:
        spark, now = batch.sparkSession, run_ts()
        folder = batch_folder(spark, checkpoint, batch_no)
        batch = batch.dropDuplicates(["event_id"])
        known = _known_keys(spark, f"{path}/events", folder, ["event_id"], None, None)
        if known is not None:
            batch = batch.join(known, "event_id", "left_anti")
        # Not persisted: what memory cannot hold would stand on disk unpacked.
        staged = f"{path}/_staged-{folder}"
        schema = batch.schema
        batch.write.mode("overwrite").option("compression", "zstd").parquet(staged)
        # What the shuffle of the envelopes holds goes before the tables are written.
        del batch, known
        release(spark)
        rows = spark.read.schema(schema).parquet(staged)
        try:
            for name, df in {**station_tables(rows, now), "events": rows.select("event_id")}.items():
                df.write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/{name}/micro_batch={folder}")
        finally:
            _removed(spark, staged)

    return (
        stream.writeStream.foreachBatch(insert)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _removed(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def station_tables(envelopes: DataFrame, run_ts: Column) -> dict[str, DataFrame]:
    """Envelope rows to the three tables; stateless, so batch and stream agree.

    DIM rows are not reduced here: the latest per station is a view over the table.
    """
    hits = explode_results(envelope_searches(envelopes))
    return {
        "dim": align(station_rows(hits, run_ts, ["cand_ord", "rank_by_dist"]), DIM_HISTORY),
        "map": align(map_rows(hits, run_ts), MAP_STATIONS),
        "fact": align(availability_rows(envelope_availability(envelopes), run_ts), FACT_AVAILABILITY),
    }


def unlanded(sent: DataFrame, landing: DataFrame) -> DataFrame:
    """Sent events that are not in the raw landing table yet."""
    return missing_events(sent, landed_ids(landing))
