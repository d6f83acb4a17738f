"""File formats, folder layouts and gates: tables written out, read back by the scans, and checked."""

from __future__ import annotations

from pyspark.sql import functions as F

from voltatlas.functions.geometry import polygons_wkb, wkb_polygons
from voltatlas.functions.timestamps import ntz
from voltatlas.operators.align import union_all
from voltatlas.operators.cube import tidy_cube
from voltatlas.operators.layers import admin_layer, features_geometry, features_layer, grid_geometry
from voltatlas.operators.lookups import require_landed
from voltatlas.operators.quality import QualityError, require_columns, require_degrees, require_rows, require_text_geometry
from voltatlas.queries.layers import _WKT_SQL, _geojson
from voltatlas.queries.registry import RUN_TS, query, spread_table, table
from voltatlas.session import scratch_dir
from voltatlas.sinks.files import publish, read_published, replace_table, write_layer, write_levels
from voltatlas.sources.cube import read_cube
from voltatlas.sources.features import (
    grid_schema,
    properties_to_columns,
    read_census_grid,
    read_feature_collection,
    read_geojson_seq,
    read_layer,
)
from voltatlas.sources.tables import read_batch_files
from voltatlas.specs import LAYERS, MAP_DATASETS

_DAY = "2024-06-01"

# What each data set keeps of the features below, and how many bytes their geometries take.
_KEPT = """case d.dataset when 'admin' then c_custkey % 6 not in (2, 3) and c_nationkey % 8 in (2, 4, 6)
     when 'roads' then c_nationkey > 12 when 'charging' then c_nationkey % 2 = 0 else true end"""
_WKB_TYPE = """case when d.dataset = 'admin' or c_custkey % 6 = 1 then 6 when c_custkey % 6 = 2 then 1
     when c_custkey % 6 = 3 then 2 else 3 end"""
_WKB_BYTES = """case c_custkey % 6 when 1 then 9 + 2 * 77 when 2 then 21 when 3 then 41 when 4 then 61 else 77 end
     + case when d.dataset = 'admin' and c_custkey % 6 <> 1 then 9 else 0 end"""


def _features(spark, sf):
    properties = F.map_from_arrays(
        F.array(*[F.lit(k) for k in ("osm_id", "name", "highway", "other_tags", "boundary", "admin_level", "osm_type")]),
        F.array(
            F.col("c_custkey").cast("string"), "c_name", F.expr("case when c_nationkey > 12 then 'primary' end"),
            F.expr("case when c_nationkey % 2 = 0 then '\"amenity\"=>\"charging_station\"' end"), F.lit("administrative"),
            F.expr("string(c_nationkey % 8)"), F.lit("relation"),
        ),
    )
    customers = spread_table(spark, sf, "customer", "c_custkey", "c_name", "c_nationkey")
    return customers.select(properties.alias("properties"), F.expr(_geojson("string")).alias("geometry"))


@query(
    f"""
select d.dataset, cast(c_custkey as varchar) as osm_id, {_WKT_SQL} as geom_wkt, {_WKB_TYPE} as wkb_type,
       {_WKB_BYTES} as wkb_bytes, 4326 as crs
from customer, unnest({MAP_DATASETS!r}) as d(dataset)
where {_KEPT}
"""
)
def layer_outputs(spark, sf):
    """All eight map layers as text and as binary, written under country/region/dataset/dt and read back together."""
    folder = scratch_dir(spark, "outputs")
    features = _features(spark, sf)
    for dataset in MAP_DATASETS:
        text = admin_layer(features) if dataset == "admin" else features_layer(features, dataset)
        write_layer(text, f"{folder}/text", "poland", "all", dataset, _DAY)
        write_layer(features_geometry(features, dataset), f"{folder}/geometry", "poland", "all", dataset, _DAY)
    keys = "country string, region string, dataset string, dt string"
    text = spark.read.schema(f"osm_id string, geom_wkt string, {keys}").parquet(f"{folder}/text")
    binary = spark.read.schema(f"osm_id string, geom_wkb binary, crs int, {keys}").parquet(f"{folder}/geometry")
    kind = F.conv(F.hex(F.substring("geom_wkb", 2, 4)), 16, 10).cast("int")
    return (
        text.where(F.col("dt") == _DAY)
        .join(binary.where(F.col("dt") == _DAY), ["country", "region", "dataset", "dt", "osm_id"])
        .select("dataset", "osm_id", "geom_wkt", kind.alias("wkb_type"), F.octet_length("geom_wkb").alias("wkb_bytes"), "crs")
    )


@query("select cast(c_custkey as varchar) as osm_id, c_nationkey > 12 as has_highway from customer")
def layer_table_scan(spark, sf):
    """A layer kept as a table: attributes and geometry text."""
    folder = scratch_dir(spark, "layer")
    properties_to_columns(_features(spark, sf), LAYERS["poi_points"], ["geometry"]).write.parquet(folder)
    return read_layer(spark, folder, "poi_points").select("osm_id", F.col("highway").isNotNull().alias("has_highway"))


_RECORD = '{"type":"Feature","properties":{"id":'


@query(
    """
select cast(c_custkey as varchar) as id, false as bad from customer where c_custkey % 10 <> 0
union all
select null, true from customer where c_custkey % 10 = 0
"""
)
def mixed_sequences(spark, sf):
    """Files cut at 0x1E and files cut at line feeds in one folder; some records have text after them, some are cut off."""
    folder = scratch_dir(spark, "mixed")
    end = F.expr("case when c_custkey % 20 = 0 then '},\"geometry\":null' when c_custkey % 10 = 0 then '},\"geometry\":null} {}' "
                 "else '},\"geometry\":null}' end")  # fmt: skip
    text = table(spark, sf, "customer").select("c_custkey", F.concat(F.lit(_RECORD), F.col("c_custkey").cast("string"), end).alias("value"))
    text.where("c_custkey % 3 = 0").select("value").write.text(f"{folder}/lines")
    text.where("c_custkey % 3 <> 0").select(F.concat(F.lit("\x1e"), "value").alias("value")).write.option("lineSep", "\n").text(f"{folder}/records")
    rows = read_geojson_seq(spark, f"{folder}/*", mode="quarantine")
    return rows.select(F.try_element_at("properties", F.lit("id")).alias("id"), "bad")


@query(
    """
select case when o_orderkey % 10 > 1 then o_orderkey end as o_orderkey,
       case o_orderkey % 10 when 0 then '{"o_orderkey":' || o_orderkey when 1 then '{"o_orderkey":' || o_orderkey || '} x' end as bad
from orders
"""
)
def batch_files_quarantine(spark, sf):
    """Landing lines of which some are cut off, some go on after the record, and some are blank."""
    folder = scratch_dir(spark, "landing")
    start = F.concat(F.lit('{"o_orderkey":'), F.col("o_orderkey").cast("string"))
    line = (
        F.when(F.expr("o_orderkey % 10 = 0"), start).when(F.expr("o_orderkey % 10 = 1"), F.concat(start, F.lit("} x")))
        .when(F.expr("o_orderkey % 10 = 2"), F.concat(start, F.lit("}\n  "))).otherwise(F.concat(start, F.lit("}")))
    )
    table(spark, sf, "orders").select(line.alias("value")).write.text(folder)
    rows = read_batch_files(spark, [folder], "o_orderkey bigint, note string", multi_line=False, mode="quarantine")
    return rows.select("o_orderkey", "bad")


def _document(rows, folder: str, name: str):
    """One document in a file of this name: a part file is moved into place."""
    rows.coalesce(1).write.text(folder)
    spark = rows.sparkSession
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    fs = fs_path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    part = next(s.getPath() for s in fs.globStatus(fs_path(f"{folder}/part-*")) if s.getLen())
    fs.rename(part, fs_path(f"{folder}/{name}"))
    return f"{folder}/{name}"


def _collection(rows):
    feature = F.concat(F.lit('{"type":"Feature","properties":{"NUTS_ID":"'), "id", F.lit('","NAME_LATN":"'), "name",
                       F.lit('"},"geometry":{"type":"Point","coordinates":['), "x", F.lit(",0]}}"))
    rows = rows.agg(F.array_join(F.collect_list(feature), ",").alias("f"))
    return rows.select(F.concat(F.lit('{"type":"FeatureCollection","features":['), "f", F.lit("]}")))


@query(
    """
select '0' as level, 'R' || r_regionkey as nuts_id, r_name as name, 'POINT(' || r_regionkey || ' 0)' as geom_wkt,
       2024 as year, '20m' as scale, 4326 as crs from region
union all
select '1', 'N' || n_nationkey, n_name, 'POINT(' || n_nationkey || ' 0)', 2024, '20m', 4326 from nation
"""
)
def feature_collection_levels(spark, sf):
    """Boundary documents, their level in the file name, to year/scale/crs/level and back."""
    from voltatlas.functions.geometry import geojson_wkt

    folder, out = scratch_dir(spark, "boundaries"), scratch_dir(spark, "levels")
    region = table(spark, sf, "region").selectExpr("'R' || r_regionkey as id", "r_name as name", "string(r_regionkey) as x")
    nation = table(spark, sf, "nation").selectExpr("'N' || n_nationkey as id", "n_name as name", "string(n_nationkey) as x")
    paths = [
        _document(_collection(region), f"{folder}/a", "areas_level=0.geojson"),
        _document(_collection(nation), f"{folder}/b", "AREAS_LEVL_1.geojson"),
    ]
    rows = read_feature_collection(spark, paths)
    named = rows.select("level", F.col("properties")["NUTS_ID"].alias("nuts_id"), F.col("properties")["NAME_LATN"].alias("name"),
                        geojson_wkt("geometry").alias("geom_wkt"))
    write_levels(named, out, 2024, "20m", 4326)
    # A level written again replaces itself only.
    write_levels(named.where("level = '1'"), out, 2024, "20m", 4326)
    return spark.read.schema("nuts_id string, name string, geom_wkt string, year int, scale string, crs int, level string").parquet(out)


@query("select 'C' || c_custkey as GRD_ID, c_custkey as T, 3035 as crs, 4000000 + c_custkey * 1000.0::double as x, "
       "3000000.0::double as y from customer")  # fmt: skip
def census_grid_scan(spark, sf):
    """Grid cells as a table of attributes and WKB; the copy with its own geometry."""
    folder = scratch_dir(spark, "grid")
    corner = lambda dx, dy: f"struct(4000000 + c_custkey * 1000D + {dx} as x, 3000000D + {dy} as y)"
    ring = ", ".join([corner(0, 0), corner(1000, 0), corner(1000, 1000), corner(0, 1000), corner(0, 0)])
    cells = table(spark, sf, "customer").select(
        F.expr("'C' || c_custkey").alias("GRD_ID"), F.col("c_custkey").alias("T"),
        polygons_wkb(f"array(array(array({ring})))").alias("geom"),
    )
    full = [F.col(f.name) if f.name in cells.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in grid_schema()]
    cells.select(*full).write.parquet(folder)
    grid = grid_geometry(read_census_grid(spark, folder)).withColumn("p", wkb_polygons("geom")[0][0][0])
    return grid.select("GRD_ID", "T", "crs", "p.x", "p.y")


@query(
    f"""
select 'trade' as dataset, n_name as geo, r_name as area, n_nationkey * 1.5::double as value, timestamp '{RUN_TS}' as ingest_ts
from nation join region on r_regionkey = n_regionkey
"""
)
def cube_document(spark, sf):
    """A cube document of nations and regions, read and made tidy."""
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    index = lambda df, code, idx: df.agg(
        F.array_join(F.collect_list(F.concat(F.lit('"'), code, F.lit('":'), F.col(idx).cast("string"))), ",").alias("i"),
        F.count(F.lit(1)).cast("string").alias("n"),
    )
    cell = F.concat(F.lit('"'), F.expr(f"string(n_nationkey * {region.count()} + n_regionkey)"), F.lit('":'), F.expr("string(n_nationkey * 1.5D)"))
    values = nation.agg(F.array_join(F.collect_list(cell), ",").alias("i"), F.lit("").alias("n"))
    parts = union_all([
        index(nation, "n_name", "n_nationkey").withColumn("part", F.lit("geo")),
        index(region, "r_name", "r_regionkey").withColumn("part", F.lit("area")), values.withColumn("part", F.lit("value")),
    ])
    of = lambda part, column: F.max(F.when(F.col("part") == part, F.col(column)))
    text = F.concat(
        F.lit('{"id":["geo","area"],"size":['), of("geo", "n"), F.lit(","), of("area", "n"),
        F.lit('],"dimension":{"geo":{"category":{"index":{'), of("geo", "i"), F.lit('}}},"area":{"category":{"index":{'), of("area", "i"),
        F.lit('}}}},"value":{'), of("value", "i"), F.lit("}}"),
    )
    path = _document(parts.agg(text), scratch_dir(spark, "cube"), "cube.json")
    values, dims = read_cube(spark, path)
    return tidy_cube(values, dims, "trade", ntz(RUN_TS))


@query("select o_orderkey, o_totalprice from orders where o_orderstatus = 'F'")
def replaced_prefix(spark, sf):
    """A table written whole and then replaced whole."""
    folder = scratch_dir(spark, "prefix")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    replace_table(orders.drop("o_orderstatus"), folder)
    replace_table(orders.where("o_orderstatus = 'F'").drop("o_orderstatus"), folder)
    return spark.read.parquet(folder)


@query(
    """
select stage, part, count(*) as rows, sum(o_orderkey)::bigint as keys
from orders, (values ('first', 1), ('failed', 1), ('late reader', 1), ('second', 2), ('by number', 1)) s(stage, v), (values ('text'), ('geometry')) p(part)
where v = 1 or o_orderstatus = 'F' group by all
"""
)
def published_versions(spark, sf):
    """Text and geometry published together, seen before, while and after they are replaced, and after a replacement that failed half way."""
    folder = scratch_dir(spark, "published")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    point = F.format_string("POINT(%d 1)", F.col("o_orderkey") % 170)
    parts = lambda df: {
        "text": df.select("o_orderkey", point.alias("geom_wkt")), "geometry": df.select("o_orderkey", F.encode(point, "UTF-8").alias("geom_wkb"))
    }
    seen = lambda stage, number=None: [
        read_published(spark, folder, part, number).select(F.lit(stage).alias("stage"), F.lit(part).alias("part"), "o_orderkey") for part in ("text", "geometry")
    ]
    checks = {"text": require_degrees}
    publish(spark, folder, parts(orders), checks)
    found = seen("first")
    # The text of this one is written, its check fails: nothing of it is ever seen.
    broken = parts(orders.where("o_orderstatus = 'O'"))
    broken["text"] = broken["text"].withColumn("geom_wkt", F.lit("POINT(500000 1)"))
    if _passes(publish, spark, folder, broken, checks):
        raise AssertionError("projected coordinates were published")
    found += seen("failed")
    late = seen("late reader")
    publish(spark, folder, parts(orders.where("o_orderstatus = 'F'")), checks)
    found += late + seen("second") + seen("by number", 1)
    return union_all(found).groupBy("stage", "part").agg(F.count(F.lit(1)).alias("rows"), F.sum("o_orderkey").alias("keys"))


def _passes(gate, *args) -> bool:
    try:
        gate(*args)
    except QualityError:
        return False
    return True


@query(
    """
select 'rows' as gate, (select count(*) from orders) > 0 as good, (select count(*) from orders where o_orderkey < 0) > 0 as bad
union all select 'columns', true, false
union all select 'text geometry', true, false
union all select 'degrees', (select max(c_custkey % 170) from customer) <= 180, (select max(c_custkey + 181) from customer) <= 180
union all select 'landed', (select count(*) from orders semi join lineitem on o_orderkey = l_orderkey) > 0,
                 not exists (from orders anti join (from lineitem where l_orderkey % 2 = 0) on o_orderkey = l_orderkey)
"""
)
def gate_verdicts(spark, sf):
    """Every gate on a table that should pass and on one that should not."""
    orders, lines, customer = (table(spark, sf, n) for n in ("orders", "lineitem", "customer"))
    text = customer.select(F.expr("'POINT(' || c_custkey % 170 || ' 1)'").alias("geom_wkt"))
    metres = customer.select(F.expr("'POINT(' || (c_custkey + 181) || ' 1)'").alias("geom_wkt"))
    landed = lines.select(F.col("l_orderkey").alias("event_id"))
    sent = orders.select(F.col("o_orderkey").alias("event_id"))
    arrived = sent.join(landed, "event_id", "left_semi")
    found = [
        ("rows", _passes(require_rows, orders, "orders"), _passes(require_rows, orders.where("o_orderkey < 0"), "orders")),
        ("columns", _passes(require_columns, orders, ["o_orderkey"]), _passes(require_columns, orders, ["no_such"])),
        ("text geometry", _passes(require_text_geometry, text),
         _passes(require_text_geometry, text.withColumn("raw", F.col("geom_wkt").cast("binary")))),
        ("degrees", _passes(require_degrees, text), _passes(require_degrees, metres)),
        ("landed", _passes(require_landed, arrived, landed), _passes(require_landed, sent, landed.where("event_id % 2 = 0"))),
    ]
    one = spark.range(1)
    return union_all([one.select(F.lit(g).alias("gate"), F.lit(good).alias("good"), F.lit(bad).alias("bad")) for g, good, bad in found])
