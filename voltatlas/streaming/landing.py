"""What was sent against what landed, while both go on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

# How long a sent event may take to land, and how far either feed may be out of order.
WAIT, DELAY = "1 hour", "10 minutes"


def landing_verdicts(
    sent: DataFrame, landed: DataFrame, wait: str = WAIT, delay: str = DELAY, key: str = "event_id", sent_ts: str = "sent_ts", landed_ts: str = "landed_ts"
) -> DataFrame:
    """``event_id, sent_ts, landed_ts, verdict`` as they become sure.

    ``landed``: landed within ``wait`` after it was sent, as soon as both are there.  ``missing``:
    the time is over and nothing came.  ``unasked``: landed, but not sent within
    ``wait`` before; if the event was called missing, this settles it (``settled``).
    State holds what is younger than ``wait`` and ``delay``; the slower feed's clock counts.  Rows
    without a key say only how late it is, so a feed at rest can send them as a
    heartbeat.  Rows more than ``delay`` out of order are dropped by the watermark.  Times must
    not be NULL: such a row would match nothing and stay in the state for good.
    """
    left = sent.select(F.col(key).alias("event_id"), F.col(sent_ts).alias("sent_ts")).withWatermark("sent_ts", delay)
    right = landed.select(F.col(key).alias("_id"), F.col(landed_ts).alias("landed_ts")).withWatermark("landed_ts", delay)
    in_time = F.expr(f"event_id = _id AND landed_ts >= sent_ts AND landed_ts <= sent_ts + INTERVAL {wait}")
    both = left.join(right, in_time, "full_outer")
    verdict = F.when(F.col("event_id").isNull(), "unasked").when(F.col("_id").isNull(), "missing").otherwise("landed")
    name = F.coalesce("event_id", "_id")
    return both.select(name.alias("event_id"), "sent_ts", "landed_ts", verdict.alias("verdict")).where(name.isNotNull())


def write_verdicts(verdicts: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Append the verdicts; files count once their micro-batch is in the sink's log."""
    out = verdicts.writeStream.format("parquet").option("path", table).option("checkpointLocation", checkpoint)
    return out.outputMode("append").trigger(availableNow=True).start()


def settled(verdicts: DataFrame) -> DataFrame:
    """One row per event: ``landed``, ``late`` (called missing, then landed), ``missing`` or ``unasked``, and when it first landed.

    An event that landed in time stays ``landed`` though repeats of it come later.
    """
    has = lambda v: F.max(F.col("verdict") == v)
    state: Column = F.when(has("landed"), "landed").when(has("missing") & has("unasked"), "late").when(has("missing"), "missing").otherwise("unasked")
    return verdicts.groupBy("event_id").agg(state.alias("state"), F.min("landed_ts").alias("landed_ts"))
