"""Road requests, flow answers and the traffic fact."""

from __future__ import annotations

from pyspark.sql import functions as F

from voltatlas.functions.timestamps import ntz
from voltatlas.operators.lookups import landed_ids, reconcile
from voltatlas.operators.totals import traffic_totals as totals_of
from voltatlas.operators.traffic import flow_fact, flow_metrics
from voltatlas.plans.jobs import traffic_feed, traffic_snapshot
from voltatlas.queries.registry import RUN_TS, query, spread_table, table
from voltatlas.sources.tables import parse_envelopes
from voltatlas.specs import TRAFFIC_ENVELOPE


@query(
    """
with t as (
  select l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(l_quantity as bigint) % 7 as c, cast(l_linenumber % 5 as bigint) as f,
         cast(l_quantity as bigint) as ct, case when l_linenumber = 7 then null else cast(l_linenumber - 1 as bigint) end as ft
  from lineitem
)
select l_orderkey, l_linenumber, l_partkey, l_suppkey, ct - ft as delay_sec,
       round(cast(nullif(c, 0) as double) / nullif(f, 0), 9) as speed_ratio,
       round(cast(nullif(ct, 0) as double) / nullif(ft, 0), 9) as delay_ratio
from t
"""
)
def traffic_metrics(spark, sf):
    lines = table(spark, sf, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "bigint(l_quantity) % 7 as current_speed",
        "bigint(l_linenumber % 5) as free_flow_speed", "bigint(l_quantity) as current_travel_time",
        "case when l_linenumber = 7 then null else bigint(l_linenumber - 1) end as free_flow_travel_time",
    )
    return flow_metrics(lines).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "delay_sec",
        F.round("speed_ratio", 9).alias("speed_ratio"), F.round("delay_ratio", 9).alias("delay_ratio"),
    )


def _roads(spark, sf):
    """Customers as candidate roads; every fifth has a bad centroid."""
    return table(spark, sf, "customer").selectExpr(
        "'R' || c_nationkey as region_code", "c_mktsegment as region", "c_name as h3_r7",
        "string(c_custkey % 4) as degurba", "c_acctbal as macro_score", "'near' as traffic_scope",
        "case c_custkey % 3 when 0 then true when 1 then false end as near_ev_station",
        "cast(null as string) as ev_station_id", "case when c_custkey % 2 = 0 then '' else 'F' || c_custkey end as road_feature_id",
        "string(c_custkey) as road_osm_id", "'primary' as highway", "50D as maxspeed_kph", "2D as lanes", "120.5D as road_len_m",
        "case when c_custkey % 5 = 0 then 'POINT(x y)' else 'POINT(' || (c_custkey % 180) || ' ' || (c_custkey % 90) || ')' end"
        " as road_centroid_wkt_4326",
    )


_FLOW = """
named_struct('flowSegmentData', named_struct(
  'frc', 'FRC' || (o_custkey % 6), 'currentSpeed', o_custkey % 60, 'freeFlowSpeed', 50 + o_custkey % 7,
  'currentTravelTime', o_custkey % 90 + 0.75, 'freeFlowTravelTime', case when o_custkey % 9 = 0 then null else 40 end,
  'confidence', 0.5D, 'roadClosure', o_custkey % 8 = 0,
  'coordinates', named_struct('coordinate', array(
     named_struct('latitude', 50D, 'longitude', double(o_custkey % 180)),
     named_struct('latitude', 51.5D, 'longitude', double(o_custkey % 170)),
     named_struct('latitude', 95D, 'longitude', 1D)))))"""


def _flow_answers(spark, sf):
    """Newest order of each customer as its flow answer; pending orders failed."""
    newest = table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.max_by("o_orderstatus", "o_orderkey").alias("o_orderstatus")
    )
    return newest.selectExpr(
        "case when o_custkey % 2 = 0 then string(o_custkey) else 'F' || o_custkey end as request_key",
        "case when o_orderstatus = 'P' then 403 else 200 end as http_status",
        "case when o_orderstatus = 'P' then repeat('denied ', 200) end as error_message",
        f"case when o_orderstatus <> 'P' then to_json({_FLOW}) end as body",
    )


_FACT_SQL = f"""
with newest as (
  select o_custkey, arg_max(o_orderstatus, o_orderkey) as st from orders group by o_custkey
),
roads as (
  select *, case when c_custkey % 2 = 0 then cast(c_custkey as varchar) else 'F' || c_custkey end as request_point_key
  from customer where c_custkey % 5 <> 0
),
j as (
  select r.*, n.st, o_custkey as k, (st is not null and st <> 'P') as ok from roads r left join newest n on n.o_custkey = r.c_custkey
)
select 'run-1' as run_id, request_point_key, cast(c_custkey % 90 as double) as request_point_lat,
       cast(c_custkey % 180 as double) as request_point_lon, 10 as tomtom_zoom, '4' as tomtom_version, 'R' || c_nationkey as region_code,
       c_name as h3_r7, cast(c_custkey % 4 as int) as degurba,
       case c_custkey % 3 when 0 then true when 1 then false end as near_ev_station,
       case when ok then 'FRC' || (k % 6) end as frc, case when ok then k % 60 end as current_speed,
       case when ok then 50 + k % 7 end as free_flow_speed, case when ok then k % 90 end as current_travel_time,
       case when ok and k % 9 <> 0 then cast(40 as bigint) end as free_flow_travel_time, case when ok then 0.5::double end as confidence,
       case when ok then k % 8 = 0 end as road_closure,
       case when ok then 'LINESTRING(' || cast(k % 180 as double) || ' 50.0, ' || cast(k % 170 as double) || ' 51.5)' end
         as segment_linestring_wkt_4326,
       case when ok then round(cast(nullif(k % 60, 0) as double) / (50 + k % 7), 9) end as speed_ratio,
       case when ok and k % 9 <> 0 then k % 90 - 40 end as delay_sec,
       case when ok and k % 9 <> 0 then round(cast(nullif(k % 90, 0) as double) / 40, 9) end as delay_ratio,
       case when st = 'P' then 403 when st is not null then 200 end as http_status,
       case when st = 'P' then left(trim(repeat('denied ', 200)), 800) || '…' end as error_message,
       timestamp '{RUN_TS}' as snapshot_ts, timestamp '{RUN_TS}' as load_ts
from j
"""
_FACT_COLUMNS = [
    "run_id", "request_point_key", "request_point_lat", "request_point_lon", "tomtom_zoom", "tomtom_version", "region_code",
    "h3_r7", "degurba", "near_ev_station", "frc", "current_speed", "free_flow_speed", "current_travel_time",
    "free_flow_travel_time", "confidence", "road_closure", "segment_linestring_wkt_4326", "speed_ratio", "delay_sec",
    "delay_ratio", "http_status", "error_message", "snapshot_ts", "load_ts",
]


def _fact_view(fact):
    cols = [F.round(c, 9).alias(c) if c.endswith("ratio") else F.col(c) for c in _FACT_COLUMNS]
    return fact.select(*cols)


@query(_FACT_SQL)
def traffic_fact(spark, sf):
    """Roads and stored answers to the fact; failures stay rows."""
    return _fact_view(traffic_snapshot(_roads(spark, sf), _flow_answers(spark, sf), ntz(RUN_TS), "run-1"))


def _feed(spark, sf, empty_object):
    return traffic_feed(
        _roads(spark, sf), _flow_answers(spark, sf), ntz(RUN_TS), "run-1", "lenient", empty_object
    )


@query(_FACT_SQL)
def traffic_envelope_normalise(spark, sf):
    """Envelopes of both forms, by turns, through text to the fact."""
    text = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    half = F.col("request_point_key").startswith("F")
    one = _feed(spark, sf, True).where(half).select(text.alias("value"))
    two = _feed(spark, sf, False).where(~half).select(text.alias("value"))
    envelopes = parse_envelopes(one.unionByName(two), TRAFFIC_ENVELOPE)
    return _fact_view(flow_fact(envelopes, ntz(RUN_TS)))


@query(
    """
select cast(count(*) as bigint) as sent, cast(count(*) as bigint) as api_calls,
       cast(count(*) filter (o_orderstatus = 'P') as bigint) as failed_calls, count(*) as batches
from orders
"""
)
def traffic_stream_totals(spark, sf):
    batches = table(spark, sf, "orders").selectExpr(
        "1 as sent", "1 as api_calls", "int(o_orderstatus = 'P') as failed_calls"
    )
    return totals_of(batches)


@query(
    """
with landed as (select distinct l_orderkey from lineitem)
select count(*) as sent, count(l_orderkey) as matched, count(*) - count(l_orderkey) as missing
from orders left join landed on o_orderkey = l_orderkey
"""
)
def sent_vs_landed(spark, sf):
    """Orders were sent; line items are the raw landing rows, under both spellings of the id."""
    sent = table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("event_id"))
    content = F.concat(
        F.when(F.col("l_linestatus") == "F", '{"event_id":"').otherwise('{"EVENT_ID":"'),
        F.col("l_orderkey").cast("string"), F.lit('"}'),
    )
    lines = spread_table(spark, sf, "lineitem", "l_orderkey", "l_linestatus")
    landing = lines.select(F.parse_json(content).alias("record_content"))
    return reconcile(sent, landed_ids(landing))
