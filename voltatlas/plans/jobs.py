"""Whole jobs: one function each, from tables to tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltatlas.functions.values import double_text
from voltatlas.operators.cube import tidy_cube, validate_tidy
from voltatlas.operators.layers import admin_layer, features_geometry, features_layer, grid_geometry, grid_text
from voltatlas.operators.lookups import left_lookup
from voltatlas.operators.quality import require_degrees, require_rows, require_text_geometry
from voltatlas.operators.ranking import stratified_candidates
from voltatlas.operators.spatial import RadiusJoin
from voltatlas.operators.stations import StationStar, station_star
from voltatlas.operators.traffic import flow_fact, road_requests, traffic_envelopes, with_answers
from voltatlas.sinks.files import publish, replace_table, write_both, write_layer, write_levels, write_snapshot
from voltatlas.sources.cube import read_cube
from voltatlas.sources.features import read_census_grid, read_feature_collection, read_geojson_seq
from voltatlas.sources.tables import candidate_roads


def search_key(lat: Column, lon: Column, radius: Column) -> Column:
    """Request key of a station search."""
    return F.concat_ws(",", double_text(lat), double_text(lon), radius.cast("string"))


def candidate_requests(cells: DataFrame) -> DataFrame:
    """Chosen candidates with their search key and their place in the run.

    The run holds at most 50 rows by then, so one ordered pass is enough.
    """
    from pyspark.sql import Window

    best = stratified_candidates(cells)
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("macro_score"), F.asc("h3_r7")))
    return best.select(
        "region_code", "region", "h3_r7", "degurba", F.col("lat").alias("request_point_lat"),
        F.col("lon").alias("request_point_lon"), "radius_m", place.alias("cand_ord"),
        search_key(F.col("lat"), F.col("lon"), F.col("radius_m")).alias("request_key"),
    )


def enrich_stations(
    cells: DataFrame, searches: DataFrame, availability: DataFrame, run_ts: Column
) -> StationStar:
    """Candidates, stored search answers and stored availability answers to the star."""
    asked = left_lookup(candidate_requests(cells), searches, "request_key")
    return station_star(asked.withColumnRenamed("body", "poi_json"), availability, run_ts)


def stations_near_candidates(cells: DataFrame, stations: DataFrame, station_key: str) -> DataFrame:
    """The same search against a station table instead of stored answers."""
    asked = stratified_candidates(cells)
    return RadiusJoin("h3_r7", station_key).run(asked, stations)


def traffic_snapshot(roads: DataFrame, responses: DataFrame, run_ts: Column, run_id: str, wkt_mode: str = "sql") -> DataFrame:
    """Roads and stored flow answers to the traffic fact."""
    asked = road_requests(candidate_roads(roads, wkt_mode))
    return flow_fact(with_answers(asked, responses).withColumn("run_id", F.lit(run_id)), run_ts)


def traffic_feed(
    roads: DataFrame, responses: DataFrame, run_ts: Column, run_id: str, wkt_mode: str = "lenient",
    empty_object: bool = True,
) -> DataFrame:
    """The same as envelopes for the stream."""
    asked = road_requests(candidate_roads(roads, wkt_mode))
    return traffic_envelopes(with_answers(asked, responses), run_id, run_ts, empty_object)


def load_map_layer(
    spark: SparkSession, source: str, target: str, country: str, region: str, dataset: str, dt: str
) -> None:
    """One map dataset of one region: sequence file to partitioned layers, as text and, beside it under ``_geometry``, in binary."""
    features = read_geojson_seq(spark, source)
    layer = admin_layer(features) if dataset == "admin" else features_layer(features, dataset)
    write_layer(require_text_geometry(layer), target, country, region, dataset, dt)
    write_layer(features_geometry(features, dataset), f"{target}_geometry", country, region, dataset, dt)


def load_boundaries(spark: SparkSession, paths: list[str], target: str, year: int, scale: str, crs: int) -> None:
    """Boundary collections of all levels to one table partitioned by level."""
    features = read_feature_collection(spark, paths)
    from voltatlas.functions.geometry import geojson_wkt
    from voltatlas.operators.layers import project_layer
    from voltatlas.sources.features import properties_to_columns
    from voltatlas.specs import LAYERS

    rows = properties_to_columns(features, LAYERS["nuts"], ["geometry", "level"])
    layer = project_layer(
        rows.withColumn("geom_wkt", geojson_wkt("geometry")), LAYERS["nuts"], extra=["level"]
    )
    write_levels(require_rows(require_text_geometry(layer), "boundaries"), target, year, scale, crs)


def load_municipalities(lau: DataFrame, target: str) -> None:
    """Municipality table (degrees already, to table precision) to a text layer."""
    from voltatlas.operators.layers import text_layer

    replace_table(require_rows(require_text_geometry(text_layer(lau, "lau")), "municipalities"), target)


def load_census_grid(spark: SparkSession, source: str, target: str) -> None:
    """Census grid to a degree text table and a copy with its own geometry."""
    grid = read_census_grid(spark, source)
    text = require_degrees(require_text_geometry(grid_text(grid)))
    write_both(text, grid_geometry(grid), target)


def publish_map_layer(spark: SparkSession, source: str, target: str, dataset: str) -> int:
    """The same layer as text and in binary, visible together; the source is evaluated once for each and checked as written."""
    features = read_geojson_seq(spark, source)
    text = admin_layer(features) if dataset == "admin" else features_layer(features, dataset)
    parts = {"text": require_text_geometry(text), "geometry": features_geometry(features, dataset)}
    return publish(spark, target, parts, {name: lambda df, name=name: require_rows(df, f"{dataset} {name}") for name in parts})


def publish_census_grid(spark: SparkSession, source: str, target: str) -> int:
    """Census grid as degree text and with its own geometry, visible together; degrees are checked on what was written."""
    grid = read_census_grid(spark, source)
    parts = {"text": require_text_geometry(grid_text(grid)), "geometry": grid_geometry(grid)}
    return publish(spark, target, parts, {"text": require_degrees})


def load_cube(spark: SparkSession, source: str, target: str, dataset: str, run_ts: Column, snapshot: str) -> str:
    """Cube document to a new snapshot of the tidy table."""
    values, dims = read_cube(spark, source)
    tidy = validate_tidy(tidy_cube(values, dims, dataset, run_ts))
    return write_snapshot(tidy, target, snapshot, spark.read.text(source, wholetext=True))
