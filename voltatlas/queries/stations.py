"""Station search answers, availability, envelopes and lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from voltatlas.functions.timestamps import clamp_ts, ntz
from voltatlas.operators.lookups import latest_response, left_lookup, with_outcome
from voltatlas.operators.stations import availability_rows, current_stations, explode_results, station_envelopes, station_rows, station_star
from voltatlas.operators.totals import station_totals as totals_of
from voltatlas.queries.registry import RUN_TS, query, spread_table, table
from voltatlas.session import release, scratch_dir
from voltatlas.sinks.current import CurrentTable
from voltatlas.sources.tables import parse_envelopes, read_envelopes
from voltatlas.specs import DIM_HISTORY, STATION_ENVELOPE
from voltatlas.streaming.envelopes import station_tables, write_stations

# Each order asks once; its answer has o_custkey % 4 hits.  Hit i of an order
# is station (o_custkey + i) % 97; hit 2 has no distance; odd stations have an
# availability id.
_HITS = """
transform(sequence(0, 3), i -> named_struct(
  'id', case when (o_custkey + i) % 97 = 13 then null else 'P' || ((o_custkey + i) % 97) end,
  'dist', case when i = 2 then null else double((o_orderkey * (i + 3)) % 50) end,
  'score', double(i) / 2,
  'poi', named_struct('name', 'Station ' || o_orderkey || '-' || i,
     'brands', case when i = 1 then array() else array(named_struct('name', o_orderstatus)) end,
     'categories', array('ev', o_orderpriority)),
  'address', named_struct('countryCode', 'PL', 'municipality', 'M' || (o_custkey % 10), 'streetNumber', string(i)),
  'position', named_struct('lat', 50 + i / 4, 'lon', double(o_custkey % 180)),
  'dataSources', case when (o_custkey + i) % 2 = 1
     then named_struct('chargingAvailability', named_struct('id', 'A' || ((o_custkey + i) % 97))) end,
  'chargingPark', named_struct('connectors', array(named_struct('ratedPowerKW', i)))))"""

_HITS_SQL = """
hits as (
  select o_orderkey, o_custkey, o_orderstatus, o_orderpriority, i,
         case when (o_custkey + i) % 97 = 13 then null else 'P' || ((o_custkey + i) % 97) end as poi_id,
         case when i = 2 then null else cast((o_orderkey * (i + 3)) % 50 as double) end as dist,
         cast(i as double) / 2 as score,
         case when (o_custkey + i) % 2 = 1 then 'A' || ((o_custkey + i) % 97) end as avail_id
  from orders, (select unnest([0, 1, 2, 3]) as i) where i < o_custkey % 4
),
ranked as (
  select *, cast(row_number() over (partition by o_orderkey order by coalesce(dist, 1e18), i) as int) as rank_by_dist from hits
)"""


def _searches(spark, sf, where="true"):
    hits = f"slice({_HITS}, 1, int(o_custkey % 4))"
    orders = spread_table(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority").where(where)
    return orders.select(
        F.concat(F.lit("S"), F.col("o_orderkey").cast("string")).alias("request_key"),
        F.col("o_orderkey").alias("cand_ord"), F.concat(F.lit("R"), (F.col("o_custkey") % 7).cast("string")).alias("region_code"),
        F.col("o_orderpriority").alias("region"), F.col("o_orderkey").cast("string").alias("h3_r7"),
        F.lit(1).alias("degurba"), F.lit(50.0).alias("request_point_lat"), F.lit(19.5).alias("request_point_lon"),
        F.lit(3000).alias("radius_m"),
        F.to_json(F.struct(F.expr(hits).alias("results"))).alias("poi_json"),
    )


# Availability answers, one per customer key below 97: three connectors, the
# second without levels, the third without anything.
_AVAIL = """
named_struct('connectors', array(
  named_struct('type', 'CCS', 'total', int(c_nationkey), 'availability', named_struct(
    'current', named_struct('available', 1, 'occupied', 0, 'reserved', 0, 'unknown', 0, 'outOfService', 0),
    'perPowerLevel', transform(sequence(1, 1 + int(c_custkey % 3)), p -> named_struct(
       'powerKW', double(p * 25), 'available', p, 'occupied', int(c_custkey % 5), 'reserved', 0, 'unknown', 0,
       'outOfService', 1)))),
  named_struct('type', 'Type2', 'total', cast(null as int), 'availability', named_struct(
    'current', named_struct('available', 2, 'occupied', int(c_custkey % 7), 'reserved', 1, 'unknown', 0, 'outOfService', 0),
    'perPowerLevel', cast(array() as array<struct<powerKW:double,available:int,occupied:int,reserved:int,unknown:int,outOfService:int>>))),
  named_struct('type', 'Schuko', 'total', 1, 'availability', cast(null as
    struct<current:struct<available:int,occupied:int,reserved:int,unknown:int,outOfService:int>,
           perPowerLevel:array<struct<powerKW:double,available:int,occupied:int,reserved:int,unknown:int,outOfService:int>>>))))"""

_AVAIL_SQL = """
avail as (
  select 'A' || c_custkey as id, 'CCS' as connector_type, cast(p * 25 as double) as power_kw, c_nationkey as total,
         p as available, cast(c_custkey % 5 as int) as occupied, 0 as reserved, 0 as unknown, 1 as out_of_service
  from customer, (select unnest([1, 2, 3]) as p) where p <= 1 + c_custkey % 3
  union all
  select 'A' || c_custkey, 'Type2', null, null, 2, cast(c_custkey % 7 as int), 1, 0, 0 from customer
  union all
  select 'A' || c_custkey, 'Schuko', null, 1, null, null, null, null, null from customer
)"""


def _availability(spark, sf):
    return spread_table(spark, sf, "customer", "c_custkey", "c_nationkey").select(
        F.concat(F.lit("A"), F.col("c_custkey").cast("string")).alias("request_key"),
        F.expr("case when c_nationkey = 3 then 403 else 200 end").alias("http_status"),
        F.expr("case when c_nationkey = 3 then 'HTTP 403' end").alias("error_message"),
        F.expr(f"case when c_nationkey <> 3 then to_json({_AVAIL}, map('ignoreNullFields', 'false')) end").alias("body"),
    )


_FACT_COLUMNS = [
    "charging_availability_id", "connector_type", "power_kw", "total", "available", "occupied", "reserved", "unknown",
    "out_of_service",
]


@query(
    f"""
with {_AVAIL_SQL}
select id as charging_availability_id, connector_type, power_kw, total, available, occupied, reserved, unknown,
       out_of_service, timestamp '{RUN_TS}' as snapshot_ts
from avail where id not in (select 'A' || c_custkey from customer where c_nationkey = 3)
"""
)
def availability_explode(spark, sf):
    answers = _availability(spark, sf).where("body IS NOT NULL").select(
        F.col("request_key").alias("charging_availability_id"), F.col("body").alias("avail_json")
    )
    return availability_rows(answers, ntz(RUN_TS)).select(*_FACT_COLUMNS, "snapshot_ts")


def _star(spark, sf):
    return station_star(_searches(spark, sf), _availability(spark, sf), ntz(RUN_TS))


@query(
    f"""
with {_HITS_SQL}
select 'R' || (o_custkey % 7) as region_code, o_orderpriority as region, cast(o_orderkey as varchar) as h3_r7,
       1 as degurba, 50.0::double as query_lat, 19.5::double as query_lon, 3000 as radius_m, poi_id as tomtom_poi_id,
       dist as dist_m, score, rank_by_dist, timestamp '{RUN_TS}' as load_ts
from ranked
"""
)
def station_map(spark, sf):
    return _star(spark, sf).map.drop("raw_search_json")


_DIM_SQL = f"""
with {_HITS_SQL}, last as (
  select *, row_number() over (partition by poi_id order by o_orderkey desc, rank_by_dist desc) as rn from ranked
)
select poi_id as tomtom_poi_id, avail_id as charging_availability_id, 'Station ' || o_orderkey || '-' || i as name,
       case when i <> 1 then o_orderstatus end as brand, 'ev' as category, 'PL' as country_code,
       cast(null as varchar) as country_subdivision, 'M' || (o_custkey % 10) as municipality,
       cast(null as varchar) as street, cast(i as varchar) as street_number, cast(null as varchar) as postal_code,
       cast(null as varchar) as freeform_address, 50 + i / 4 as lat, cast(o_custkey % 180 as double) as lon,
       '[{{"ratedPowerKW":' || i || '}}]' as connectors_static_json, timestamp '{RUN_TS}' as updated_at
from last where rn = 1
"""


@query(_DIM_SQL)
def station_dim(spark, sf):
    return _star(spark, sf).dim.drop("raw_poi_json")


_FACT_SQL = f"""
with {_HITS_SQL}, {_AVAIL_SQL}
select avail_id as charging_availability_id, connector_type, power_kw, total, available, occupied, reserved, unknown,
       out_of_service, count(*) as n
from hits join avail on avail.id = hits.avail_id
where avail_id not in (select 'A' || c_custkey from customer where c_nationkey = 3)
group by all
"""


@query(_FACT_SQL)
def station_fact(spark, sf):
    """Not de-duplicated: a station near two candidates counts twice."""
    fact = _star(spark, sf).fact
    return fact.groupBy(*_FACT_COLUMNS).agg(F.count(F.lit(1)).alias("n"))


def _envelopes(spark, sf):
    searches = _searches(spark, sf)
    candidates = searches.drop("poi_json")
    answers = searches.select(
        "request_key",
        F.expr("case when cand_ord % 11 = 0 then 403 else 200 end").alias("http_status"),
        F.expr("case when cand_ord % 11 = 0 then 'HTTP 403' end").alias("error_message"),
        F.expr("case when cand_ord % 11 = 0 then null else poi_json end").alias("body"),
    )
    return station_envelopes(candidates, answers, _availability(spark, sf), "run-1", ntz(RUN_TS))


@query(
    f"""
with {_HITS_SQL}, looked as (
  select o_orderkey, count(*) filter (avail_id is not null) as looked_up,
         count(*) filter (c_nationkey is not null and c_nationkey <> 3) as answered
  from hits left join customer on hits.avail_id = 'A' || c_custkey
  where o_orderkey % 11 <> 0 group by o_orderkey
)
select cast(o.o_orderkey as varchar) as h3_r7, case when o.o_orderkey % 11 = 0 then 403 else 200 end as http_status,
       cast(coalesce(looked_up, 0) as int) as looked_up, cast(coalesce(answered, 0) as int) as answered,
       sha256('run-1|S' || o.o_orderkey || '|R' || (o.o_custkey % 7) || '|' || o.o_orderkey || '|2024-06-01T12:00:00Z') as event_id
from orders o left join looked l on o.o_orderkey = l.o_orderkey
"""
)
def station_envelope_build(spark, sf):
    return _envelopes(spark, sf).select(
        "h3_r7", "http_status", F.size("availability_snapshots").alias("looked_up"),
        F.size(F.filter("availability_snapshots", lambda s: s["ok"])).alias("answered"), "event_id",
    )


def _parsed_envelopes(spark, sf):
    envelopes = _envelopes(spark, sf)
    value = F.to_json(F.struct(*envelopes.columns), {"ignoreNullFields": "false"})
    return parse_envelopes(envelopes.select(value.alias("value")), STATION_ENVELOPE)


@query(
    f"""
with {_HITS_SQL}
select 'R' || (o_custkey % 7) as region_code, cast(o_orderkey as varchar) as h3_r7, poi_id as tomtom_poi_id,
       dist as dist_m, rank_by_dist
from ranked where o_orderkey % 11 <> 0
"""
)
def ev_envelope_flatten(spark, sf):
    """Envelope text back to MAP rows, as the consumer does."""
    rows = station_tables(_parsed_envelopes(spark, sf), ntz(RUN_TS))["map"]
    return rows.select("region_code", "h3_r7", "tomtom_poi_id", "dist_m", "rank_by_dist")


# Envelopes in one landed file at most: a file is read by one task.
FILE_ROWS = 50_000


@query(_DIM_SQL.replace("as rn from ranked", "as rn from ranked where o_orderkey % 11 <> 0"))
def station_stream_tables(spark, sf):
    """Envelopes in several micro-batches, each twice: the view of the streamed DIM is the DIM of the batch job."""
    folder, out = scratch_dir(spark, "envelopes"), scratch_dir(spark, "stations")
    envelopes = _envelopes(spark, sf)
    value = F.to_json(F.struct(*envelopes.columns), {"ignoreNullFields": "false"})
    text = envelopes.select(value.alias("value"))
    # Envelopes repeat most of their text: as gzip they take a tenth of the disk.
    # Four files at least, and more for more rows, without a shuffle of the text for it.
    most = min(FILE_ROWS, max(1, -(-table(spark, sf, "orders").count() // 4)))
    text.write.option("compression", "gzip").option("maxRecordsPerFile", most).text(folder)
    # What the envelopes were built from is let go before more is written.
    del envelopes, text
    release(spark)
    spark.read.text(folder).write.mode("append").option("compression", "gzip").option("maxRecordsPerFile", most).text(folder + "-again")
    for source in (folder, folder + "-again"):
        files = len(spark.read.text(source).inputFiles())
        stream = read_envelopes(spark, source, STATION_ENVELOPE, files_per_trigger=max(1, -(-files // 3)))
        write_stations(stream, out, scratch_dir(spark, "progress"), lambda: ntz(RUN_TS)).awaitTermination()
    history = spark.read.schema(DIM_HISTORY).parquet(f"{out}/dim")
    return current_stations(history).drop("raw_poi_json", "micro_batch")


# The run that brings an order, and the hour of that run.
_RUNS = {"F": "12", "O": "13", "P": "14"}
_HOUR_SQL = "case o_orderstatus when 'F' then 0 when 'O' then 1 else 2 end"


@query(_DIM_SQL.replace("order by o_orderkey desc", f"order by {_HOUR_SQL} desc, o_orderkey desc")
       .replace(f"timestamp '{RUN_TS}' as", f"timestamp '{RUN_TS}' + to_hours({_HOUR_SQL}) as"))
def station_current(spark, sf):
    """The current DIM after three runs, one of them given twice: two merged into the base, the third as the table is read."""
    dim = CurrentTable(scratch_dir(spark, "current"), DIM_HISTORY, ["tomtom_poi_id"], ["updated_at", "cand_ord", "rank_by_dist", "raw_poi_json"], buckets=32)
    for n, (status, hour) in enumerate(_RUNS.items()):
        stamp = clamp_ts(ntz(RUN_TS.replace(" 12", f" {hour}")), ntz(RUN_TS.replace(" 12", f" {hour}")))
        hits = explode_results(_searches(spark, sf, f"o_orderstatus = '{status}'"))
        for _ in range(2 if n == 1 else 1):
            dim.add(station_rows(hits, stamp, ["cand_ord", "rank_by_dist"]), f"run-{n}")
        if n == 1:
            dim.compact(spark)
    return dim.read(spark).drop("raw_poi_json", "cand_ord", "rank_by_dist")


@query(_FACT_SQL.replace("from hits join", "from (select * from hits where o_orderkey % 11 <> 0) hits join"))
def ev_envelope_fact(spark, sf):
    fact = station_tables(_parsed_envelopes(spark, sf), ntz(RUN_TS))["fact"]
    return fact.groupBy(*_FACT_COLUMNS).agg(F.count(F.lit(1)).alias("n"))


@query(
    """
select o_orderkey, c_name, case when c_custkey is null then 'other' when c_nationkey = 1 then 'permanent' else 'ok' end as outcome
from orders left join (select * from customer where c_mktsegment <> 'BUILDING') c
  on case when o_orderpriority <> '5-LOW' then o_custkey end = c_custkey
"""
)
def dim_fact_lookup(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.expr("case when o_orderpriority <> '5-LOW' then o_custkey end").alias("key")
    )
    answers = table(spark, sf, "customer").where("c_mktsegment <> 'BUILDING'").select(
        F.col("c_custkey").alias("request_key"), "c_name",
        F.expr("case when c_nationkey = 1 then 404 else 200 end").alias("http_status"),
    )
    return with_outcome(left_lookup(orders, answers, "key")).select("o_orderkey", "c_name", "outcome")


@query(
    """
select request_key, o_orderkey, o_totalprice from (
  select o_custkey as request_key, o_orderkey, o_totalprice,
         row_number() over (partition by o_custkey order by o_orderkey desc) as rn from orders) where rn = 1
"""
)
def latest_answer(spark, sf):
    answers = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("request_key"), "o_orderkey", "o_totalprice"
    )
    return latest_response(answers, order="o_orderkey")


@query(
    """
select cast(count(*) as bigint) as total_candidates, cast(count(*) filter (o_orderstatus <> 'P') as bigint) as total_envelopes,
       cast(coalesce(sum(o_custkey), 0) as bigint) as total_sent,
       cast(count(*) filter (o_orderstatus = 'F') as bigint) as total_tomtom_403
from orders
"""
)
def station_stream_totals(spark, sf):
    batches = table(spark, sf, "orders").select(
        F.lit(1).alias("candidates"), F.expr("int(o_orderstatus <> 'P')").alias("envelopes"),
        F.col("o_custkey").alias("sent"), F.expr("int(o_orderstatus = 'F')").alias("tomtom_403"),
    )
    return totals_of(batches)


@query("select cast(o_orderkey as varchar) as request_key, o_orderstatus as body from orders")
def response_table_scan(spark, sf):
    from voltatlas.sources.tables import read_responses

    folder = scratch_dir(spark, "responses")
    table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("request_key"), F.lit(200).alias("http_status"),
        F.lit(None).cast("string").alias("error_message"), F.col("o_orderstatus").alias("body"),
    ).write.parquet(folder)
    return read_responses(spark, folder).select("request_key", "body")
