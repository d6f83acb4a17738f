"""Feature layers, geometry and tags."""

from __future__ import annotations

from pyspark.sql import functions as F

from voltatlas.functions.geometry import (
    first_vertex,
    geojson_parts,
    geojson_polygons,
    geojson_wkt as to_wkt,
    laea_to_lonlat,
    linestring_wkt as line_text,
    polygons_wkb,
    ring_problem,
)
from voltatlas.functions.tags import tags_decode, tags_encode
from voltatlas.operators.align import union_all, union_levels
from voltatlas.operators.layers import (
    admin_features,
    features_layer,
    filter_layer,
    grid_text,
    project_layer,
)
from voltatlas.operators.quality import output_profile as profile, polygon_types_only
from voltatlas.operators.cover import clip_by_cover, cover_regions
from voltatlas.operators.spatial import clip_to_regions
from voltatlas.operators.totals import feature_counts
from voltatlas.plans.jobs import load_municipalities
from voltatlas.queries.registry import query, spread_table, table
from voltatlas.session import scratch_dir
from voltatlas.sources.features import read_geojson_seq
from voltatlas.specs import LAYERS

_TAG_NAME = """case p_size % 3 when 0 then p_name || ' "' || p_type || '"' when 1 then p_name || ',' || p_type else p_name end"""


@query(
    f"""
with t as (select p_partkey, p_brand, {_TAG_NAME} as name, case when p_size > 25 then p_type end as kind from part)
select p_partkey,
       '"name"=>"' || replace(name, '"', '\\"') || '","brand"=>"' || p_brand || '"'
         || case when kind is null then '' else ',"kind"=>"' || kind || '"' end as other_tags,
       name as name_again, kind as kind_again
from t
"""
)
def hstore_roundtrip(spark, sf):
    part = table(spark, sf, "part")
    tags = F.map_from_arrays(
        F.array(F.lit("name"), F.lit("brand"), F.lit("kind")),
        F.array(F.expr(_TAG_NAME), "p_brand", F.expr("case when p_size > 25 then p_type end")),
    )
    text = part.select("p_partkey", tags_encode(tags).alias("other_tags"))
    back = tags_decode("other_tags")
    return text.select(
        "p_partkey", "other_tags", F.try_element_at(back, F.lit("name")).alias("name_again"),
        F.try_element_at(back, F.lit("kind")).alias("kind_again"),
    )


_CHARGING_TAGS = """
case p_size % 5 when 0 then '"amenity"=>"charging_station"' when 1 then '"note"=>"old charging_station"'
  when 2 then '"charging"=>"yes"' when 3 then '"amenity"=>"bench"' end"""


@query(
    f"""
with t as (select cast(p_partkey as varchar) as osm_id, p_name as name, {_CHARGING_TAGS} as other_tags from part)
select 'text' as mode, * from t where other_tags like '%charging_station%' or other_tags like '%charging=>yes%'
union all
select 'tags', * from t where other_tags in ('"amenity"=>"charging_station"', '"charging"=>"yes"')
"""
)
def charging_filter(spark, sf):
    points = table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("osm_id"), F.col("p_name").alias("name"),
        F.expr(_CHARGING_TAGS).alias("other_tags"),
    )
    spec = LAYERS["charging"]
    return union_all([filter_layer(points, spec, m).select(F.lit(m).alias("mode"), "*") for m in ("text", "tags")])


@query(
    """
select 'roads' as dataset, cast(s_suppkey as varchar) as osm_id, s_name as name,
       case when s_nationkey % 4 = 0 then null else 'primary' end as highway, cast(null as varchar) as barrier,
       cast(null as varchar) as man_made, cast(null as varchar) as railway, cast(null as varchar) as waterway,
       cast(s_nationkey as int) as z_order, cast(null as varchar) as other_tags, cast(null as varchar) as is_in,
       cast(null as varchar) as ref, cast(null as varchar) as place
from supplier where s_nationkey % 4 <> 0
union all
select 'poi_points', cast(p_partkey as varchar), p_name, null, null, p_brand, null, null, null, null, null, p_type, null
from part
"""
)
def layer_projection(spark, sf):
    lines = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("osm_id"), F.col("s_name").alias("name"),
        F.expr("case when s_nationkey % 4 = 0 then null else 'primary' end").alias("highway"),
        F.col("s_nationkey").alias("z_order"), F.col("s_acctbal").alias("not_in_the_layer"),
    )
    points = table(spark, sf, "part").select(
        F.col("p_partkey").alias("OSM_ID"), F.col("p_name").alias("name"), F.col("p_brand").alias("man_made"),
        F.col("p_type").alias("ref"),
    )
    roads = project_layer(filter_layer(lines, LAYERS["roads"]), LAYERS["roads"])
    poi = project_layer(points, LAYERS["poi_points"])
    return union_all([roads.withColumn("dataset", F.lit("roads")), poi.withColumn("dataset", F.lit("poi_points"))])


# Geometry text from the customer key, in one of six forms.
_X, _Y = "(c_custkey % 170)", "(c_nationkey * 3)"


def _square(x: str, y: str, cast: str) -> str:
    t = lambda e: f"cast({e} as {cast})"
    corner = lambda dx, dy: f"'[' || {t(f'{x} + {dx}')} || ', ' || {t(f'{y} + {dy}')} || ']'"
    return (
        f"'[' || {corner(0, 0)} || ',' || {corner(2, 0)} || ',' || {corner(2, 1)} || ',' || {corner(0, 0)} || ']'"
    )


def _geojson(cast: str) -> str:
    one = _square(_X, _Y, cast)
    t = lambda e: f"cast({e} as {cast})"
    return f"""
case c_custkey % 6
  when 0 then '{{"type":"Polygon","coordinates":[' || {one} || ']}}'
  when 1 then '{{"type":"MultiPolygon","coordinates":[[' || {one} || '],[' || {_square(_X + ' + 5', _Y, cast)} || ']]}}'
  when 2 then '{{"type":"Point","coordinates":[' || {t(_X)} || ',' || {t(_Y)} || ',7]}}'
  when 3 then '{{"type":"LineString","coordinates":[[' || {t(_X)} || ',' || {t(_Y)} || '],[1.5,2.25]]}}'
  when 4 then '{{"type":"Polygon","coordinates":[[[' || {t(_X)} || ',' || {t(_Y)} || '],[1,2],[3,4]]]}}'
  else '{{"type":"Polygon","coordinates":[[[' || {t(_X)} || ',' || {t(_Y)} || '],[1,2],[3,4],[5,6.125]]]}}'
end"""


def _wkt_square(x: str, y: str) -> str:
    return f"""'(' || {x} || ' ' || {y} || ', ' || ({x} + 2) || ' ' || {y} || ', ' || ({x} + 2) || ' ' || ({y} + 1)
               || ', ' || {x} || ' ' || {y} || ')'"""


_WKT_SQL = f"""
case c_custkey % 6
  when 0 then 'POLYGON(' || {_wkt_square(_X, _Y)} || ')'
  when 1 then 'MULTIPOLYGON((' || {_wkt_square(_X, _Y)} || '), (' || {_wkt_square('(' + _X + ' + 5)', _Y)} || '))'
  when 2 then 'POINT(' || {_X} || ' ' || {_Y} || ')'
  when 3 then 'LINESTRING(' || {_X} || ' ' || {_Y} || ', 1.5 2.25)'
  when 4 then 'POLYGON((' || {_X} || ' ' || {_Y} || ', 1 2, 3 4))'
  else 'POLYGON((' || {_X} || ' ' || {_Y} || ', 1 2, 3 4, 5 6.125))'
end"""


@query(
    f"""
select c_custkey, {_WKT_SQL} as geom_wkt,
       case c_custkey % 6 when 4 then 'ring under 4 points' when 5 then 'ring not closed' when 2 then 'no rings'
                          when 3 then 'no rings' end as problem,
       cast({_X} as double) as first_lon, cast({_Y} as double) as first_lat
from customer
"""
)
def geojson_to_wkt(spark, sf):
    shapes = table(spark, sf, "customer").select("c_custkey", F.expr(_geojson("string")).alias("g"))
    text = shapes.select("c_custkey", to_wkt("g").alias("geom_wkt"), ring_problem(geojson_polygons("g")).alias("problem"))
    v = first_vertex("geom_wkt")
    return text.select("*", v["lon"].alias("first_lon"), v["lat"].alias("first_lat"))


@query("select c_custkey, case c_custkey % 6 when 1 then 'MultiPolygon' else 'Polygon' end as geometry_type "
       "from customer where c_custkey % 6 not in (2, 3)")  # fmt: skip
def polygon_whitelist(spark, sf):
    shapes = table(spark, sf, "customer").select(
        "c_custkey", geojson_parts(F.expr(_geojson("string")))["type"].alias("geometry_type")
    )
    return polygon_types_only(shapes)


@query(
    f"""
select c_custkey as feature_key, c_mktsegment as name, c_name as ref,
       case when c_nationkey > 12 then '"amenity"=>"charging_station"' else '"x"=>"charging_station, old"' end as other_tags,
       {_WKT_SQL} as geom_wkt
from customer
"""
)
def geojson_sequence_scan(spark, sf):
    """Features written as a record-separated sequence, read back, made a layer."""
    folder = scratch_dir(spark, "features")
    record = F.concat(
        F.lit('\x1e{"type":"Feature","properties":{"osm_id":'), F.col("c_custkey").cast("string"),
        F.lit(',"name":"'), "c_mktsegment", F.lit('","ref":"'), "c_name", F.lit('","other_tags":'),
        F.expr(
            r"""case when c_nationkey > 12 then '"\\"amenity\\"=>\\"charging_station\\""'
                     else '"\\"x\\"=>\\"charging_station, old\\""' end"""
        ),
        F.lit('},"geometry":'), F.expr(_geojson("string")), F.lit("}"),
    )
    table(spark, sf, "customer").select(record.alias("value")).write.text(folder)
    layer = features_layer(read_geojson_seq(spark, folder), "charging")
    return layer.withColumn("feature_key", F.col("osm_id").cast("long")).drop("osm_id")


@query(
    """
with f as (
  select p_partkey, p_name, p_brand, p_size,
         case p_size % 4 when 0 then 'relation' when 1 then 'way' end as osm_type,
         case p_size % 4 when 2 then 'relation' end as at_type,
         case when p_partkey % 3 = 0 then 'administrative' when p_partkey % 3 = 1 then 'maritime' end as boundary,
         case when p_partkey % 5 = 0 then 'boundary' when p_partkey % 5 = 1 then 'route' end as type
  from part
)
select cast(p_partkey as varchar) as osm_id, 'relation' as osm_type, type, p_name as name, boundary,
       cast(p_size % 8 as varchar) as admin_level,
       '"brand"=>"' || p_brand || '","note"=>"say \\"' || p_size || '\\""' as other_tags
from f
where (boundary = 'administrative' or type = 'boundary') and coalesce(osm_type, at_type) = 'relation'
  and p_size % 8 in (2, 4, 6) and p_partkey % 7 <> 0
"""
)
def admin_filter(spark, sf):
    part = table(spark, sf, "part")
    features = part.select(
        F.map_from_arrays(
            F.array(*[F.lit(k) for k in (
                "@id", "osm_type", "@type", "type", "name", "boundary", "admin_level", "brand", "gone", "note")]),
            F.array(
                F.col("p_partkey").cast("string"),
                F.expr("case p_size % 4 when 0 then 'relation' when 1 then 'way' end"),
                F.expr("case p_size % 4 when 2 then 'relation' end"),
                F.expr("case when p_partkey % 5 = 0 then 'boundary' when p_partkey % 5 = 1 then 'route' end"),
                F.col("p_name"),
                F.expr("case when p_partkey % 3 = 0 then 'administrative' when p_partkey % 3 = 1 then 'maritime' end"),
                (F.col("p_size") % 8).cast("string"),
                F.col("p_brand"),
                F.lit(None).cast("string"),
                F.concat(F.lit('say "'), F.col("p_size").cast("string"), F.lit('"')),
            ),
        ).alias("properties"),
        F.expr(
            """case when p_partkey % 7 = 0 then '{"type":"LineString","coordinates":[[1,2],[3,4]]}'
                    else '{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1],[0,0]]]}' end"""
        ).alias("geometry"),
    )
    return admin_features(features).drop("geometry")


@query(
    """
select '0' as level, count(*) as feature_count from region union all
select '1', count(*) from nation union all select '2', count(*) from customer
"""
)
def level_union_counts(spark, sf):
    levels = {
        "0": table(spark, sf, "region").select(F.col("r_name").alias("name")),
        "1": table(spark, sf, "nation").select(F.col("n_name").alias("name")),
        "2": table(spark, sf, "customer").select(F.col("c_name").alias("name"), "c_nationkey"),
    }
    return feature_counts(union_levels(levels), ["level"])


def _line_point(lat: str, lon: str) -> str:
    return (
        f"case when {lat} between -90 and 90 and {lon} between -180 and 180 "
        f"then cast({lon} as varchar) || ' ' || cast({lat} as varchar) end"
    )


_P1 = _line_point("l_quantity", "cast(l_linenumber * 20 as double)")
_P2 = _line_point("cast(l_linenumber * 20 as double)", "(0 - l_quantity)")
_P3 = _line_point("l_discount", "(case when l_returnflag = 'R' then null else l_tax end)")


@query(
    f"""
with t as (
  select l_orderkey, l_linenumber, l_partkey, l_suppkey, {_P1} as a, {_P2} as b, {_P3} as c from lineitem
)
select l_orderkey, l_linenumber, l_partkey, l_suppkey,
       case when (a is not null)::int + (b is not null)::int + (c is not null)::int >= 2
            then 'LINESTRING(' || concat_ws(', ', a, b, c) || ')' end as wkt
from t
"""
)
def linestring_wkt(spark, sf):
    point = lambda lat, lon: F.struct(
        F.expr(f"string({lat})").alias("latitude"), F.expr(f"string({lon})").alias("longitude")
    )
    coords = F.array(
        point("l_quantity", "double(l_linenumber * 20)"),
        point("double(l_linenumber * 20)", "0 - l_quantity"),
        point("l_discount", "case when l_returnflag = 'R' then null else l_tax end"),
        F.struct(F.lit("x").alias("latitude"), F.lit("1").alias("longitude")),
    )
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax", "l_returnflag"]
    return spread_table(spark, sf, "lineitem", *columns).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", line_text(coords).alias("wkt")
    )


_E_SQL, _N_SQL = "cast(2500000 + c_custkey * 997 % 3500000 as double)", "cast(1500000 + c_custkey * 1009 % 3500000 as double)"
# From the published parameters of the projection (EPSG:3035, GRS80), all derived values worked out in SQL.
_LAEA_SQL = f"""
given as (select 6378137.0::double as a, 1 / 298.257222101::double as f, radians(52.0::double) as lat0, radians(10.0::double) as lon0,
                 4321000.0::double as fe, 3210000.0::double as fn),
ecc as (select *, f * (2 - f) as e2, sqrt(f * (2 - f)) as e from given),
auth as (select *, (1 - e2) * (1 / (1 - e2) - ln((1 - e) / (1 + e)) / (2 * e)) as qp,
                (1 - e2) * (sin(lat0) / (1 - e2 * sin(lat0) * sin(lat0)) - ln((1 - e * sin(lat0)) / (1 + e * sin(lat0))) / (2 * e)) as q0 from ecc),
proj as (select *, asin(q0 / qp) as b0, a * sqrt(qp / 2) as rq from auth),
laea as (select *, a * cos(lat0) / sqrt(1 - e2 * sin(lat0) * sin(lat0)) / (rq * cos(b0)) as d from proj),
p as (select c_custkey, ({_E_SQL} - fe) / d as x, ({_N_SQL} - fn) * d as y, laea.* from customer, laea),
r as (select *, sqrt(x * x + y * y) as rho, 2 * asin(sqrt(x * x + y * y) / (2 * rq)) as ang from p),
t as (select *, case when rho = 0 then b0 else asin(cos(ang) * sin(b0) + y * sin(ang) * cos(b0) / rho) end as beta,
             atan2(x * sin(ang), rho * cos(b0) * cos(ang) - y * sin(b0) * sin(ang)) as dlon from r),
u as (select c_custkey, degrees(lon0 + dlon) as lon,
             degrees(beta + (e2 / 3 + 31 * e2 ** 2 / 180 + 517 * e2 ** 3 / 5040) * sin(2 * beta)
                          + (23 * e2 ** 2 / 360 + 251 * e2 ** 3 / 3780) * sin(4 * beta) + 761 * e2 ** 3 / 45360 * sin(6 * beta)) as lat
      from t)"""


@query(f"with {_LAEA_SQL} select c_custkey, round(lon, 6) as lon, round(lat, 6) as lat from u")
def laea_to_wgs84(spark, sf):
    p = laea_to_lonlat(_E_SQL, _N_SQL)
    return table(spark, sf, "customer").select(
        "c_custkey", F.round(p["lon"], 6).alias("lon"), F.round(p["lat"], 6).alias("lat")
    )


@query(
    f"""
with {_LAEA_SQL}
select 'CRS3035RES1000m-' || c_custkey as grd_id, c_custkey as t, cast(null as bigint) as m,
       round(round(lon, 8) + 0.000000004, 5) as first_lon, round(round(lat, 8) + 0.000000004, 5) as first_lat, 5 as vertices
from u
"""
)
def grid_cells_to_text(spark, sf):
    """Binary census cells in metres to degree text."""
    corners = [(0, 0), (1000, 0), (1000, 1000), (0, 1000), (0, 0)]
    points = ", ".join(f"named_struct('x', {_E_SQL} + {dx}, 'y', {_N_SQL} + {dy})" for dx, dy in corners)
    grid = spread_table(spark, sf, "customer", "c_custkey").select(
        F.concat(F.lit("CRS3035RES1000m-"), F.col("c_custkey").cast("string")).alias("GRD_ID"),
        F.col("c_custkey").alias("T"), polygons_wkb(f"array(array(array({points})))").alias("geom"),
    )
    text = grid_text(grid)
    v = first_vertex("geom_wkt")
    return text.select(
        F.col("GRD_ID").alias("grd_id"), F.col("T").alias("t"), F.col("M").alias("m"),
        # The text has 8 digits; the small step keeps every value off the middle between two 5-digit ones.
        F.round(v["lon"] + 4e-9, 5).alias("first_lon"), F.round(v["lat"] + 4e-9, 5).alias("first_lat"),
        F.size(F.split("geom_wkt", ",")).alias("vertices"),
    )


# Every nation is a region: a notched hexagon with a square hole, shifted by its key.
_RING = [(0, 0), (30, -5), (40, 20), (22, 9), (20, 30), (-3, 21), (0, 0)]
_HOLE = [(5, 5), (10, 5), (10, 10), (5, 10), (5, 5)]


def _edges_sql() -> str:
    parts = []
    for ring in (_RING, _HOLE):
        for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
            parts.append(f"({x1}, {y1}, {x2}, {y2})")
    return ", ".join(parts)


_PT = "cast(c_custkey * 7919 % 36000 as double) / 100 - 180 as lon, cast(c_custkey * 104729 % 18000 as double) / 100 - 90 as lat"
_CLIP_SQL = f"""
with pts as (select c_custkey, {_PT} from customer),
edge as (select * from (values {_edges_sql()}) as v(x1, y1, x2, y2)),
e as (
  select n_name as region, x1 + n_nationkey * 11 - 160 as x1, y1 + n_nationkey * 3 - 60 as y1,
         x2 + n_nationkey * 11 - 160 as x2, y2 + n_nationkey * 3 - 60 as y2
  from nation, edge
)
select c_custkey, lon, lat, region
from pts, e
where (y1 > lat) <> (y2 > lat) and lon < cast(x2 - x1 as double) * (lat - y1) / (y2 - y1) + x1
group by c_custkey, lon, lat, region having count(*) % 2 = 1
"""


def _regions_and_points(spark, sf):
    def ring(points):
        return F.array(
            *[
                F.struct(
                    (F.col("n_nationkey") * 11 - 160 + x).cast("double").alias("x"),
                    (F.col("n_nationkey") * 3 - 60 + y).cast("double").alias("y"),
                )
                for x, y in points
            ]
        )

    regions = table(spark, sf, "nation").select(
        F.col("n_name").alias("region"), F.array(F.array(ring(_RING), ring(_HOLE))).alias("polygons")
    )
    points = table(spark, sf, "customer").selectExpr("c_custkey", *[s.strip() for s in _PT.split(", ")])
    return regions, points


def _clip(spark, sf, **kw):
    regions, points = _regions_and_points(spark, sf)
    return clip_to_regions(points, regions, "c_custkey", **kw).select("c_custkey", "lon", "lat", "region")


@query(_CLIP_SQL)
def region_clip(spark, sf):
    return _clip(spark, sf)


@query(_CLIP_SQL)
def region_clip_cover(spark, sf):
    """The same clip through the quadtree cover of the regions, with border cells of few edges."""
    regions, points = _regions_and_points(spark, sf)
    return clip_by_cover(points, cover_regions(regions, leaf_edges=4)).select("c_custkey", "lon", "lat", "region")


@query(_CLIP_SQL)
def region_clip_long_bands(spark, sf):
    """The same clip on the path for bands with many edges."""
    return _clip(spark, sf, edges_per_array=1)


# A municipality per customer, in the list as it comes: other columns around the five, some without a degree of urbanisation.
@query(
    """
select 'PL_' || c_custkey as "GISCO_ID", 'PL' as "CNTR_CODE", c_custkey::varchar as "LAU_ID", c_name as "LAU_NAME",
       case when c_custkey % 7 <> 0 then (c_custkey % 3 + 1)::varchar end as "DGURBA",
       'POLYGON((' || c_custkey % 90 || ' 1, ' || c_custkey % 90 + 1 || ' 1, ' || c_custkey % 90 || ' 2, ' || c_custkey % 90 || ' 1))' as geom_wkt
from customer
"""
)
def municipality_list(spark, sf):
    """The list of municipalities through its job: columns in order, text geometry, the table replaced and read back."""
    x = "cast(c_custkey % 90 as int)"
    ring = f"'[[' || {x} || ',1],[' || ({x} + 1) || ',1],[' || {x} || ',2],[' || {x} || ',1]]'"
    lau = spread_table(spark, sf, "customer").select(
        F.col("c_acctbal").alias("POP_2021"), F.expr("c_custkey % 3 + 1").alias("_urban"), F.col("c_name").alias("LAU_NAME"),
        F.col("c_custkey").cast("string").alias("LAU_ID"), F.concat(F.lit("PL_"), F.col("c_custkey").cast("string")).alias("GISCO_ID"),
        F.lit("PL").alias("CNTR_CODE"), F.expr("case when c_custkey % 7 <> 0 then c_custkey % 3 + 1 end").cast("string").alias("DGURBA"),
        F.expr(f"""'{{"type":"Polygon","coordinates":[' || {ring} || ']}}'""").alias("geometry"),
    )
    folder = scratch_dir(spark, "municipalities")
    load_municipalities(lau, folder)
    return spark.read.parquet(folder)


@query(
    """
with c as (select count(*) as rows, count(doc_id) as a, count(text) as b, count(case when lang <> 'en' then lang end) as c,
                  count(source) as d, count(n_chars) as e from documents)
select unnest([1, 2, 3, 4, 5]) as position, unnest(['doc_id', 'text', 'foreign_lang', 'source', 'n_chars']) as column_name,
       unnest(['bigint', 'string', 'string', 'string', 'bigint']) as data_type, rows, unnest([a, b, c, d, e]) as non_null
from c
"""
)
def output_profile(spark, sf):
    docs = table(spark, sf, "documents").select(
        "doc_id", "text", F.expr("case when lang <> 'en' then lang end").alias("foreign_lang"), "source", "n_chars"
    )
    return profile(docs)
