"""Candidate choice, point text, radius, ranks and batches."""

from __future__ import annotations

from pyspark.sql import functions as F

from voltatlas.functions.points import point_lon_lat, search_radius_m
from voltatlas.operators.numbering import assign_batches, batch_ranges as ranges_of
from voltatlas.operators.quality import split_bad_points
from voltatlas.operators.ranking import (
    debug_rows as first_rows,
    last_per_key,
    rank_by_distance as ranked,
    stratified_candidates,
    top_per_group,
)
from voltatlas.operators.rings import self_crossings
from voltatlas.operators.spatial import RadiusJoin, open_grid
from voltatlas.operators.stations import current_stations
from voltatlas.operators.totals import batch_totals as totals_of
from voltatlas.session import scratch_dir
from voltatlas.queries.registry import query, spread_table, table
from voltatlas.sources.tables import candidate_roads

_CELL_WKT = """
case when c_custkey % 17 = 5 then 'POINT(bad)'
     when c_custkey % 19 = 3 then 'point(1 2)'
     else 'POINT(' || cast(c_custkey % 400 - 200 as string) || ' ' || cast(c_custkey % 170 - 85 as string) || ')'
end"""
_DEGURBA = """
case c_mktsegment when 'BUILDING' then '1' when 'MACHINERY' then '2' when 'HOUSEHOLD' then '3'
                  when 'FURNITURE' then 'x' end"""


def cells(spark, sf):
    """Customers as candidate cells."""
    return table(spark, sf, "customer").select(
        F.concat(F.lit("R"), "c_nationkey").alias("region_code"),
        F.col("c_mktsegment").alias("region"),
        F.col("c_name").alias("h3_r7"),
        F.expr(_CELL_WKT).alias("cell_center_wkt_4326"),
        (F.col("c_acctbal") * 10000).alias("kring_area_m2"),
        F.col("c_acctbal").alias("macro_score"),
        F.expr(_DEGURBA).alias("degurba"),
    )


@query(
    f"""
select region_code, region, h3_r7, degurba, p[1]::double as lon, p[2]::double as lat, kring_area_m2, macro_score,
       case when kring_area_m2 > 0 then cast(least(10000, greatest(1500, floor(sqrt(kring_area_m2 / pi())))) as int) else 3000 end as radius_m
from (
  select 'R' || c_nationkey as region_code, c_mktsegment as region, c_name as h3_r7, try_cast({_DEGURBA} as int) as degurba,
         {_CELL_WKT.replace('as string', 'as varchar')} as wkt, regexp_extract_all(wkt, '-?[0-9.]+') as p,
         c_acctbal * 10000 as kring_area_m2, c_acctbal as macro_score
  from customer
  where starts_with(wkt, 'POINT(') and degurba between 1 and 3
  qualify row_number() over (partition by degurba order by macro_score desc, h3_r7) <= 17
)
where abs(lat) <= 90 and abs(lon) <= 180
order by macro_score desc, h3_r7 limit 50
"""
)
def stratified_top_candidates(spark, sf):
    return stratified_candidates(cells(spark, sf))


_FORMS = """
case c_custkey % 12
  when 0 then 'POINT(19.5 50.25)' when 1 then 'POINT (19.5 50.25)' when 2 then 'point(19.5 50.25)'
  when 3 then 'POINT(19.5  50.25)' when 4 then 'POINT(19.5)' when 5 then 'POINT EMPTY'
  when 6 then 'POINT(a b)' when 7 then 'POINT(1 2 3)' when 8 then 'POINT(10 91)'
  when 9 then 'POINT(-181 1)' when 10 then null else ' POINT( 1.5 2.5 ) ' end"""

_SQL_FORMS = f"""
forms as (select c_custkey, {_FORMS} as wkt from customer),
parts as (
  select c_custkey, wkt,
         string_split(replace(replace(wkt, 'POINT(', ''), ')', ''), ' ') as a,
         regexp_split_to_array(trim(regexp_extract(wkt, '(?is)^\\s*POINT\\((.*)\\)\\s*$', 1)), '\\s+') as b,
         regexp_split_to_array(trim(regexp_extract(wkt, '(?is)^\\s*POINT[^(]*\\((.*)\\)[^)]*$', 1)), '\\s+') as c
  from forms
),
numbers as (
  select c_custkey, wkt, try_cast(a[1] as double) as sql_lon, try_cast(a[2] as double) as sql_lat,
         try_cast(b[1] as double) as x2, try_cast(b[2] as double) as y2,
         try_cast(c[1] as double) as x3, try_cast(c[2] as double) as y3
  from parts
),
modes as (
  select c_custkey, wkt, sql_lon, sql_lat,
         case when x2 between -180 and 180 and y2 between -90 and 90 then x2 end as strict_lon,
         case when x2 between -180 and 180 and y2 between -90 and 90 then y2 end as strict_lat,
         case when x3 between -180 and 180 and y3 between -90 and 90 then x3 end as lenient_lon,
         case when x3 between -180 and 180 and y3 between -90 and 90 then y3 end as lenient_lat
  from numbers
)"""


def point_forms(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", "c_acctbal", F.expr(_FORMS).alias("wkt"))


@query(
    f"with {_SQL_FORMS} select c_custkey, sql_lon, sql_lat, strict_lon, strict_lat, lenient_lon, lenient_lat from modes"
)
def wkt_parse_modes(spark, sf):
    forms = point_forms(spark, sf)
    modes = {m: point_lon_lat("wkt", m) for m in ("sql", "strict", "lenient")}
    return forms.select(
        "c_custkey", *[p[x].alias(f"{m}_{x}") for m, p in modes.items() for x in ("lon", "lat")]
    )


@query(
    f"""
with {_SQL_FORMS}
select case when wkt is null then 'missing' when lenient_lon is null then 'malformed' else 'good' end as verdict,
       count(*) as n, min(c_custkey) as first_key
from modes group by 1
"""
)
def point_quarantine(spark, sf):
    good, bad = split_bad_points(point_forms(spark, sf), "wkt")
    both = good.withColumn("reason", F.lit("good")).unionByName(bad)
    return both.groupBy(F.col("reason").alias("verdict")).agg(
        F.count(F.lit(1)).alias("n"), F.min("c_custkey").alias("first_key")
    )


@query(
    f"""
with {_SQL_FORMS}
select c_custkey as road_key, lenient_lon as request_point_lon, lenient_lat as request_point_lat,
       cast(case when c_custkey % 3 = 0 then null else c_custkey % 3 end as int) as degurba
from modes
where lower(wkt) like 'point(%' and lenient_lon is not null
   or lower(wkt) like 'point (%' and lenient_lon is not null
"""
)
def candidate_road_scan(spark, sf):
    roads = point_forms(spark, sf).select(
        *[F.lit(None).cast("string").alias(c) for c in (
            "region_code", "region", "h3_r7", "traffic_scope", "ev_station_id", "road_osm_id", "highway")],
        F.col("c_custkey").alias("road_feature_id"), F.col("c_acctbal").alias("macro_score"),
        F.lit(True).alias("near_ev_station"),
        F.expr("case when c_custkey % 3 = 0 then 'x' else string(c_custkey % 3) end").alias("degurba"),
        *[F.lit(None).cast("double").alias(c) for c in ("maxspeed_kph", "lanes", "road_len_m")],
        F.col("wkt").alias("road_centroid_wkt_4326"),
    )
    kept = candidate_roads(roads, "lenient")
    return kept.select(
        F.col("road_feature_id").alias("road_key"), "request_point_lon", "request_point_lat", "degurba"
    )


@query(
    """
with a as (select p_partkey, case when p_size = 1 then null else (p_retailprice - 950) * 1000000 end as area from part)
select p_partkey,
       cast(case when area > 0 then greatest(1500, least(10000, floor(sqrt(area / pi())))) else 3000 end as int)
         as radius_m
from a
"""
)
def search_radius(spark, sf):
    area = F.expr("case when p_size = 1 then null else (p_retailprice - 950) * 1000000 end")
    return table(spark, sf, "part").select("p_partkey", search_radius_m(area).alias("radius_m"))


_C_LAT, _C_LON = "50 + (c_custkey % 997) / 2000", "15 + ((c_custkey * 7) % 991) / 1500"
_S_LAT, _S_LON = "50 + ((s_suppkey * 37) % 499) / 1000", "15 + ((s_suppkey * 11) % 331) / 500"

_RADIUS_SQL = f"""
with c as (
  select c_custkey, cast({_C_LAT} as double) as lat, cast({_C_LON} as double) as lon,
         case when c_acctbal > 0 then greatest(1500, least(10000, floor(sqrt(c_acctbal * 30000 / pi())))) else 3000
         end as radius_m
  from customer
), s as (
  select s_suppkey, cast({_S_LAT} as double) as slat, cast({_S_LON} as double) as slon from supplier
), d as (
  select c_custkey, s_suppkey, radius_m,
         2 * 6371008.8 * asin(sqrt(least(1.0,
           power(sin(radians(slat - lat) / 2), 2)
           + cos(radians(lat)) * cos(radians(slat)) * power(sin(radians(slon - lon) / 2), 2)))) as dist
  from c, s
), r as (
  select *, row_number() over (partition by c_custkey order by dist, s_suppkey) as rn from d where dist <= radius_m
)
select c_custkey, s_suppkey, round(dist, 2) as dist_m, cast(rn as int) as rank_by_dist from r where rn <= 10
"""


def _radius_tables(spark, sf):
    c = table(spark, sf, "customer").select(
        "c_custkey", F.expr(f"double({_C_LAT})").alias("lat"), F.expr(f"double({_C_LON})").alias("lon"),
        search_radius_m(F.col("c_acctbal") * 30000).alias("radius_m"),
    )
    s = table(spark, sf, "supplier").select(
        "s_suppkey", F.expr(f"double({_S_LAT})").alias("station_lat"),
        F.expr(f"double({_S_LON})").alias("station_lon"),
    )
    return c, s


def _radius_rows(joined):
    return joined.select(
        "c_custkey", "s_suppkey", F.round("dist_m", 2).alias("dist_m"), F.col("rank_by_dist").cast("int")
    )


@query(_RADIUS_SQL)
def radius_join(spark, sf):
    return _radius_rows(RadiusJoin("c_custkey", "s_suppkey").run(*_radius_tables(spark, sf)))


@query(_RADIUS_SQL)
def radius_join_crowded(spark, sf):
    """The same join on the path for crowded cells."""
    return _radius_rows(RadiusJoin("c_custkey", "s_suppkey", leaf_rows=4).run(*_radius_tables(spark, sf)))


@query(_RADIUS_SQL)
def radius_join_stored(spark, sf):
    """Stations filed once, asked by two candidate tables; the second opens the grid from its folder."""
    join, path = RadiusJoin("c_custkey", "s_suppkey", leaf_rows=4), scratch_dir(spark, "stations")
    candidates, stations = _radius_tables(spark, sf)
    even, odd = (candidates.where(f"c_custkey % 2 = {k}") for k in (0, 1))
    first = join.run(even, join.store(stations, path))
    return _radius_rows(first.unionByName(join.run(odd, open_grid(spark, path))))


_LINE = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice"


@query(
    f"""
with d as (select *, case when l_returnflag = 'R' then null else l_quantity end as dist from lineitem)
select {_LINE}, dist, row_number() over (
         partition by l_orderkey
         order by dist asc nulls last, l_partkey, l_suppkey, l_linenumber, l_extendedprice) as rank_by_dist
from d
"""
)
def rank_by_distance(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        *_LINE.split(", "), F.expr("case when l_returnflag = 'R' then null else l_quantity end").alias("dist")
    )
    ties = ["l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice"]
    return ranked(lines, ["l_orderkey"], "dist", ties, None)


@query(
    f"""
select l_returnflag, {_LINE}, cast(rn as int) as rn from (
  select *, row_number() over (
    partition by l_returnflag
    order by l_extendedprice desc, l_orderkey, l_linenumber, l_partkey, l_suppkey) as rn
  from lineitem) where rn <= 1500
"""
)
def top_per_flag(spark, sf):
    """A per-group limit beyond what Spark cuts before the shuffle by itself."""
    order = [F.desc("l_extendedprice"), *[F.asc(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]]
    lines = table(spark, sf, "lineitem").select("l_returnflag", *_LINE.split(", "))
    return top_per_group(lines, ["l_returnflag"], order, 1500)


@query(
    """
select user_id as poi_id, event_id, event_type, value from (
  select *, row_number() over (partition by user_id order by event_type desc, event_id desc) as rn from events)
where rn = 1
"""
)
def poi_dim_last_row(spark, sf):
    events = table(spark, sf, "events").select(
        F.col("user_id").alias("poi_id"), "event_id", "event_type", "value"
    )
    return last_per_key(events, ["poi_id"], ["event_type", "event_id"])


@query(
    """
select tomtom_poi_id, event_id, value from (
  select cast(user_id as varchar) as tomtom_poi_id, event_id, value,
         row_number() over (partition by user_id order by ts desc, event_id desc) as rn
  from events) where rn = 1
"""
)
def poi_dim_latest(spark, sf):
    history = table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("tomtom_poi_id"), "event_id", "value",
        F.col("ts").alias("updated_at"), F.lpad(F.col("event_id").cast("string"), 20, "0").alias("raw_poi_json"),
    )
    return current_stations(history).select("tomtom_poi_id", "event_id", "value")


_ORDER_BATCHES = """
numbered as (
  select o_orderkey, row_number() over (order by o_orderkey) - 1 as row_index from orders
)"""


def _batched(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return assign_batches(orders, [F.col("o_orderkey")], 50)


@query(
    f"""
with {_ORDER_BATCHES}
select row_index // 50 + 1 as batch_id, min(row_index) as start_idx, max(row_index) + 1 as end_idx
from numbered group by 1
"""
)
def batch_ranges(spark, sf):
    return ranges_of(_batched(spark, sf))


@query(
    f"""
with {_ORDER_BATCHES}, answers as (
  select n.row_index // 50 + 1 as batch_id,
         case o.o_orderstatus when 'F' then 403 when 'P' then 500 else 200 end as http_status,
         case when o.o_orderstatus = 'O' then 'x' end as body
  from numbered n join orders o on n.o_orderkey = o.o_orderkey
)
select batch_id, count(*) as api_calls, count(*) filter (body is null) as failed_calls,
       count(*) filter (http_status = 403) as forbidden_calls, count(*) filter (body is not null) as answered_calls
from answers group by rollup (batch_id)
"""
)
def batch_totals(spark, sf):
    answers = _batched(spark, sf).withColumns(
        {
            "http_status": F.expr("case o_orderstatus when 'F' then 403 when 'P' then 500 else 200 end"),
            "body": F.expr("case when o_orderstatus = 'O' then 'x' end"),
        }
    )
    return totals_of(answers)


@query("select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 10")
def debug_rows(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", (-F.col("o_totalprice")).alias("_p"))
    return first_rows(orders, ["_p", "o_orderkey"], 10).drop("_p")


@query(
    """
with points as (
  select l_orderkey, l_partkey % 101 as x, l_suppkey * 7 % 97 as y,
         row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey) - 1 as i, count(*) over (partition by l_orderkey) as n
  from lineitem
),
edges as (
  select a.l_orderkey, a.i, a.n, a.x as ax, a.y as ay, b.x as bx, b.y as by
  from points a join points b on a.l_orderkey = b.l_orderkey and b.i = (a.i + 1) % a.n where a.n > 2
)
select e.l_orderkey, count(*) as n_crossings
from edges e join edges f on e.l_orderkey = f.l_orderkey and f.i > e.i + 1 and not (e.i = 0 and f.i = e.n - 1)
where sign((e.bx - e.ax) * (f.ay - e.ay) - (e.by - e.ay) * (f.ax - e.ax)) * sign((e.bx - e.ax) * (f.by - e.ay) - (e.by - e.ay) * (f.bx - e.ax)) < 0
  and sign((f.bx - f.ax) * (e.ay - f.ay) - (f.by - f.ay) * (e.ax - f.ax)) * sign((f.bx - f.ax) * (e.by - f.ay) - (f.by - f.ay) * (e.bx - f.ax)) < 0
group by e.l_orderkey
"""
)
def ring_self_crossings(spark, sf):
    """The lines of each order as a ring through places made of their part and supplier."""
    place = F.struct("l_linenumber", "l_partkey", "l_suppkey", F.expr("double(l_partkey % 101)").alias("x"), F.expr("double(l_suppkey * 7 % 97)").alias("y"))
    lines = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(place)).alias("at"))
    open_ring = F.transform("at", lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y")))
    return self_crossings(lines.select("l_orderkey", F.concat(open_ring, F.slice(open_ring, 1, 1)).alias("ring")), ["l_orderkey"])
