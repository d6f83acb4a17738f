"""Envelope streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from voltatlas.functions.timestamps import iso_seconds, ntz
from voltatlas.queries.registry import RUN_TS, query, spread_table, table
from voltatlas.session import scratch_dir
from voltatlas.sources.tables import batch_events, read_envelopes, write_unreadable
from voltatlas.specs import TRAFFIC_ENVELOPE
from voltatlas.streaming.envelopes import append_once, dedupe_within, traffic_rows
from voltatlas.streaming.keyindex import KeyIndex
from voltatlas.streaming.landing import landing_verdicts, settled, write_verdicts

_RAW = """
case event_type when 'view' then null when 'error' then '{}' else
  '{"flowSegmentData":{"frc":"FRC1","currentSpeed":' || {k} || ',"freeFlowSpeed":50,"roadClosure":false}}' end"""


def _write_envelopes(spark, sf, folder, where="true", prefix="e", times=2):
    """Events as traffic envelopes; every envelope lands ``times`` times, in as many sets of files."""
    events = spread_table(spark, sf, "events").where(where)
    raw = _RAW.replace("{k}", "get_json_object(props, '$.k')")
    rows = events.select(
        F.concat(F.lit(prefix), F.col("event_id").cast("string")).alias("event_id"), F.lit("run-1").alias("run_id"),
        iso_seconds("ts").alias("snapshot_ts"), F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("request_point_key"),
        F.lit(50.0).alias("request_point_lat"), F.lit(19.5).alias("request_point_lon"),
        F.expr("case event_type when 'view' then 403 else 200 end").alias("http_status"), F.expr(raw).alias("raw_json"),
    )
    values = rows.select(F.to_json(F.struct("*")).alias("value"))
    for _ in range(times):
        values.write.mode("append").text(folder)


_FACT_SQL = f"""
select 'run-1' as run_id, 'u' || user_id as request_point_key, date_trunc('second', ts) as snapshot_ts,
       case when event_type not in ('view', 'error') then cast(json_extract_string(props, '$.k') as bigint) end as current_speed,
       case when event_type not in ('view', 'error') then cast(50 as bigint) end as free_flow_speed,
       case when event_type not in ('view', 'error') then false end as road_closure,
       case event_type when 'view' then 403 else 200 end as http_status, timestamp '{RUN_TS}' as load_ts
from events
"""
_COLUMNS = [
    "run_id", "request_point_key", "snapshot_ts", "current_speed", "free_flow_speed", "road_closure", "http_status", "load_ts",
]


@query(_FACT_SQL)
def stream_dedupe_fact(spark, sf):
    """Files of envelopes, each twice, through the stream to the fact; every event once."""
    folder, out = scratch_dir(spark, "envelopes"), scratch_dir(spark, "fact")
    _write_envelopes(spark, sf, folder)
    stream = read_envelopes(spark, folder, TRAFFIC_ENVELOPE)

    fact = lambda batch: traffic_rows(batch, ntz(RUN_TS), ["event_id", "event_date"])
    append_once(stream, out, scratch_dir(spark, "progress"), ["event_id"], fact).awaitTermination()
    return spark.read.parquet(out).select(*_COLUMNS)


@query("select 'e' || event_id as event_id, 'u' || user_id as request_point_key from events")
def stream_two_feeds(spark, sf):
    """Two feeds with checkpoints of their own, one file a micro-batch, into one table; every event once."""
    folder, out = scratch_dir(spark, "envelopes"), scratch_dir(spark, "both")
    _write_envelopes(spark, sf, folder)
    for _ in range(2):
        stream = read_envelopes(spark, folder, TRAFFIC_ENVELOPE)
        append_once(stream, out, scratch_dir(spark, "progress"), ["event_id"]).awaitTermination()
    return spark.read.parquet(out).select("event_id", "request_point_key")


@query("select 'e' || event_id as event_id, 'u' || user_id as request_point_key from events")
def stream_repeat_batches(spark, sf):
    """Repeats in later micro-batches and under another date; every event once."""
    folder, out = scratch_dir(spark, "envelopes"), scratch_dir(spark, "repeats")
    value = lambda shift: F.to_json(F.struct(
        F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("event_id"), iso_seconds(F.col("ts") + F.expr(shift)).alias("snapshot_ts"),
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("request_point_key"),
    ))
    for shift in ("interval 0 days", "interval 3 days"):
        spread_table(spark, sf, "events").select(value(shift).alias("value")).write.mode("append").text(folder)
    stream = read_envelopes(spark, folder, TRAFFIC_ENVELOPE, files_per_trigger=4)
    append_once(stream, out, scratch_dir(spark, "progress"), ["event_id"]).awaitTermination()
    return spark.read.parquet(out).select("event_id", "request_point_key")


@query("select 'e' || event_id as event_id, 'u' || user_id as request_point_key from events")
def stream_key_index(spark, sf):
    """Two feeds of repeats under other dates, several micro-batches each, through one key index that is merged on the way; every event once."""
    folder, out, index = scratch_dir(spark, "envelopes"), scratch_dir(spark, "indexed"), KeyIndex(scratch_dir(spark, "keys"), ["event_id"], 32, 3)
    value = lambda shift: F.to_json(F.struct(
        F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("event_id"), iso_seconds(F.col("ts") + F.expr(shift)).alias("snapshot_ts"),
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("request_point_key"),
    ))
    for shift in ("interval 0 days", "interval 3 days"):
        spread_table(spark, sf, "events").select(value(shift).alias("value")).write.mode("append").text(folder)
    for files in (4, 1000):
        stream = read_envelopes(spark, folder, TRAFFIC_ENVELOPE, files_per_trigger=files)
        append_once(stream, out, scratch_dir(spark, "progress"), ["event_id"], index=index).awaitTermination()
    return spark.read.parquet(out).select("event_id", "request_point_key")


@query(
    """
with pairs as (
  select o_orderkey, max(l_shipdate between o_orderdate and o_orderdate + interval 60 day) as in_time, min(l_shipdate) as first
  from orders left join (select * from lineitem where l_returnflag <> 'N') l on o_orderkey = l_orderkey group by o_orderkey
)
select cast(o_orderkey as varchar) as event_id, case when in_time then 'landed' when first is not null then 'late' else 'missing' end as state,
       cast(first as timestamp) as landed_ts
from pairs
"""
)
def stream_landing(spark, sf):
    """Orders are sent, their returned lines land; three runs of one stream, by time, then a heartbeat; every order gets its state."""
    sent, landed, out, progress = (scratch_dir(spark, n) for n in ("sent", "landed", "verdicts", "progress"))
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("event_id"), F.col("o_orderdate").cast("timestamp").alias("sent_ts"))
    lines = table(spark, sf, "lineitem").where("l_returnflag <> 'N'")
    lines = lines.select(F.col("l_orderkey").cast("string").alias("event_id"), F.col("l_shipdate").cast("timestamp").alias("landed_ts"))
    beat = spark.range(1).select(F.lit(None).cast("string").alias("event_id"), F.lit("2100-01-01").cast("timestamp").alias("ts"))
    feed = lambda path, ts: spark.readStream.schema(f"event_id string, {ts} timestamp").parquet(path)
    bounds = ["0001-01-01", "1997-01-01", "1999-01-01", "2100-01-01"]
    for since, until in [*zip(bounds, bounds[1:]), (None, None)]:
        for rows, path, ts in ((orders, sent, "sent_ts"), (lines, landed, "landed_ts")):
            part = beat.withColumnRenamed("ts", ts) if since is None else rows.where((F.col(ts) >= since) & (F.col(ts) < until))
            part.write.mode("append").parquet(path)
        verdicts = landing_verdicts(feed(sent, "sent_ts"), feed(landed, "landed_ts"), "60 days", "1 day")
        write_verdicts(verdicts, out, progress).awaitTermination()
    return settled(spark.read.parquet(out)).withColumn("landed_ts", F.col("landed_ts").cast("timestamp_ntz"))


@query("select 'e' || event_id as event_id, event_type = 'view' as bad from events")
def stream_unreadable(spark, sf):
    """Messages cut off in the middle go to a table of their own, none is lost."""
    folder, out, odd = (scratch_dir(spark, n) for n in ("envelopes", "readable", "unreadable"))
    whole = F.concat(F.lit('{"request_point_key":"'), "event_type", F.lit('","event_id":"e'), F.col("event_id").cast("string"))
    text = F.when(F.col("event_type") == "view", whole).otherwise(F.concat(whole, F.lit('"}')))
    spread_table(spark, sf, "events").select(text.alias("value")).write.text(folder)
    append_once(read_envelopes(spark, folder, TRAFFIC_ENVELOPE, 4), out, scratch_dir(spark, "progress"), ["event_id"]).awaitTermination()
    write_unreadable(spark, folder, odd, scratch_dir(spark, "progress")).awaitTermination()
    good = spark.read.parquet(out).select("event_id", F.lit(False).alias("bad"))
    bad = spark.read.text(odd).select(F.regexp_extract("value", '"event_id":"(e[0-9]+)', 1).alias("event_id"), F.lit(True).alias("bad"))
    return good.unionByName(bad)


@query("select 'e' || event_id as event_id, 'u' || user_id as request_point_key from events")
def stream_dedupe_window(spark, sf):
    """The same files through the watermark form, in several micro-batches; what came behind the watermark goes by ``append_once``."""
    folder, out, every = (scratch_dir(spark, n) for n in ("envelopes", "unique", "every"))
    _write_envelopes(spark, sf, folder)
    stream = dedupe_within(read_envelopes(spark, folder, TRAFFIC_ENVELOPE, files_per_trigger=2), ["event_id"])
    (
        stream.select("event_id", "request_point_key")
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", scratch_dir(spark, "progress"))
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    append_once(read_envelopes(spark, folder, TRAFFIC_ENVELOPE), every, scratch_dir(spark, "progress"), ["event_id"]).awaitTermination()
    unique, every = (spark.read.parquet(path).select("event_id", "request_point_key") for path in (out, every))
    return unique.unionByName(every.join(unique, "event_id", "left_anti"))


@query("select 'e' || event_id as event_id, 'u' || user_id as request_point_key from events")
def stream_watermark_drops(spark, sf):
    """The watermark form, run twice over time: repeats within the delay go, what is behind the watermark does not pass, all else does.

    The second run also brings the events of the first once more, and events of new ids that are an hour
    or more behind the newest of the first run, so behind its watermark.
    """
    folder, out, progress = (scratch_dir(spark, n) for n in ("envelopes", "unique", "progress"))
    span = table(spark, sf, "events").agg(F.min("ts").alias("first"), F.max("ts").alias("last"))
    middle = span.select(F.expr("first + (last - first) / 2").cast("string")).first()[0]
    newest = table(spark, sf, "events").where(f"ts < '{middle}'").agg(F.max("ts").cast("string")).first()[0]

    def run():
        # All files of a run are one micro-batch: the order of files is not that of time.
        stream = dedupe_within(read_envelopes(spark, folder, TRAFFIC_ENVELOPE, files_per_trigger=1_000_000), ["event_id"])
        rows = stream.select("event_id", "request_point_key").writeStream.format("parquet").option("path", out)
        rows.option("checkpointLocation", progress).trigger(availableNow=True).start().awaitTermination()

    _write_envelopes(spark, sf, folder, f"ts < '{middle}'")
    run()
    _write_envelopes(spark, sf, folder, f"ts >= '{middle}'")
    _write_envelopes(spark, sf, folder, f"ts < '{middle}'", times=1)
    _write_envelopes(spark, sf, folder, f"ts < timestamp'{newest}' - interval 1 hour", "late", 1)
    run()
    return spark.read.parquet(out)


@query(
    """
select side || event_id as event_id, case side when 'a' then 200 else 403 end as http_status
from events, (select unnest(['a', 'b']) as side) where event_type not in ('error', 'view')
"""
)
def batch_event_lists(spark, sf):
    """Results of two events each; those of two event types are malformed or empty."""
    result = """
        case event_type when 'error' then '[1]' when 'view' then '{"api_calls":1,"events":[]}' else
          '{"events":[{"event_id":"a' || event_id || '","http_status":200},{"event_id":"b' || event_id
             || '","http_status":403}]}' end"""
    results = table(spark, sf, "events").select(F.expr(result).alias("value"))
    return batch_events(results, TRAFFIC_ENVELOPE).select("event_id", "http_status")
