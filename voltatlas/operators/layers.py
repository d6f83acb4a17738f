"""Feature rows to text-geometry layers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltatlas.functions.geometry import (
    POLYGON_TYPES,
    geojson_parts,
    geojson_wkb,
    geojson_wkt,
    laea_polygons_to_lonlat,
    polygons_wkt,
    readable,
    wkb_polygons,
)
from voltatlas.functions.tags import tags_encode
from voltatlas.functions.values import once
from voltatlas.operators.quality import require_rows
from voltatlas.sources.features import properties_to_columns
from voltatlas.specs import DEFAULT_ADMIN_LEVELS, LAYERS, LayerSpec

# Properties that do not go into the tag text of an admin area.
_ADMIN_OWN = ["osm_id", "id", "@id", "osm_type", "@type", "name", "boundary", "admin_level", "type"]


def project_layer(df: DataFrame, spec: LayerSpec, geometry: str = "geom_wkt", extra: list[str] | None = None) -> DataFrame:
    """The layer's attributes in order, then the geometry text; a missing attribute is a typed NULL."""
    found = {c.lower(): c for c in df.columns}
    cols = [
        (df[found[c.lower()]] if c.lower() in found else F.lit(None)).cast(spec.column_type(c)).alias(c)
        for c in spec.columns
    ]
    return df.select(*cols, *([geometry] if geometry in df.columns else []), *(extra or []))


def filter_layer(df: DataFrame, spec: LayerSpec, mode: str = "text") -> DataFrame:
    predicate = spec.predicate(mode)
    return df if predicate is None else df.where(predicate)


def text_layer(df: DataFrame, dataset: str, mode: str = "text") -> DataFrame:
    """Layer rows with GeoJSON ``geometry`` text: filter, project, geometry to WKT; one of an unknown type is an error."""
    spec = LAYERS[dataset]
    kept = once(filter_layer(df, spec, mode), "geom_wkt", geojson_wkt("geometry"))
    return project_layer(kept.withColumn("geom_wkt", readable(F.col("geom_wkt"), "geometry")), spec)


def features_layer(features: DataFrame, dataset: str, mode: str = "text") -> DataFrame:
    """The same for feature rows that still carry a property map."""
    return text_layer(properties_to_columns(features, LAYERS[dataset], ["geometry"]), dataset, mode)


def admin_features(features: DataFrame, levels: list[str] | None = None) -> DataFrame:
    """Administrative areas: relations of the wanted levels with a polygon.

    ``levels`` empty keeps every level.  Tags other than the named ones are
    kept as tag text in their order.
    """
    levels = DEFAULT_ADMIN_LEVELS if levels is None else levels
    p = lambda k: F.try_element_at("properties", F.lit(k))
    filled = lambda k: F.nullif(p(k), F.lit(""))
    rows = features.withColumns(
        {
            "_level": F.coalesce(p("admin_level"), F.lit("")),
            "_kind": F.coalesce(filled("osm_type"), filled("@type"), F.lit("")),
            "_id": F.coalesce(filled("osm_id"), filled("@id"), p("id")),
            "_shape": geojson_parts("geometry")["type"],
        }
    )
    tagged = (p("boundary") == "administrative") | p("type").isin("boundary", "multipolygon")
    keep = tagged & (F.col("_kind") == "relation") & F.col("_shape").isin(POLYGON_TYPES) & F.col("_id").isNotNull()
    if levels:
        keep = keep & F.col("_level").isin(levels)
    rest = F.map_filter("properties", lambda k, v: ~k.isin(_ADMIN_OWN))
    return rows.where(keep).select(
        F.col("_id").alias("osm_id"), F.col("_kind").alias("osm_type"), p("type").alias("type"),
        p("name").alias("name"), p("boundary").alias("boundary"), p("admin_level").alias("admin_level"),
        tags_encode(rest).alias("other_tags"), "geometry",
    )


def admin_layer(features: DataFrame, levels: list[str] | None = None) -> DataFrame:
    """Text table of administrative areas; none at all is an error."""
    rows = admin_features(features, levels).withColumn("geom_wkt", geojson_wkt("geometry"))
    return require_rows(project_layer(rows, LAYERS["admin"]), "admin areas")


def geometry_layer(features: DataFrame, dataset: str, mode: str = "text", crs: int = 4326) -> DataFrame:
    """The layer with binary geometry and its reference system, for rows with the layer's attributes.

    Areas of ``admin`` are MultiPolygons throughout.  A row without geometry keeps
    NULL; a geometry that cannot be converted is an error.
    """
    spec = LAYERS[dataset]
    shapes = once(filter_layer(features, spec, mode), "geom_wkb", geojson_wkb("geometry", promote=dataset == "admin"))
    rows = shapes.withColumns({"geom_wkb": readable(F.col("geom_wkb"), "geometry"), "crs": F.lit(crs)})
    return project_layer(rows, spec, "geom_wkb", ["crs"])


def features_geometry(features: DataFrame, dataset: str, mode: str = "text") -> DataFrame:
    """The same for feature rows that still carry a property map."""
    if dataset == "admin":
        return geometry_layer(admin_features(features), dataset)
    return geometry_layer(properties_to_columns(features, LAYERS[dataset], ["geometry"]), dataset, mode)


def grid_text(grid: DataFrame, digits: int = 8) -> DataFrame:
    """Census grid cells in degrees as text; reprojected first, then printed."""
    metres = grid.withColumn("_cell", wkb_polygons("geom"))
    degrees = metres.withColumn("_cell", laea_polygons_to_lonlat("_cell"))
    return project_layer(
        degrees.withColumn("geom_wkt", polygons_wkt("_cell", digits)), LAYERS["census_grid"]
    )


def grid_geometry(grid: DataFrame) -> DataFrame:
    """The grid as it came: binary cells, and the reference system they are really in."""
    return project_layer(grid.withColumn("crs", F.lit(3035)), LAYERS["census_grid"], "geom", ["crs"])
