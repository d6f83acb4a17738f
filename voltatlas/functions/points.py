"""Point text and search radius."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from voltatlas.functions.values import as_column, let, to_double

# Radius in metres when the area is unknown, and its two bounds.
DEFAULT_RADIUS_M = 3000
MIN_RADIUS_M = 1500
MAX_RADIUS_M = 10000


def in_range(lon: Column | str, lat: Column | str) -> Column:
    """True only for present coordinates inside the degree ranges."""
    lon, lat = as_column(lon), as_column(lat)
    return F.coalesce(lat.between(-90.0, 90.0) & lon.between(-180.0, 180.0), F.lit(False))


def point_lon_lat(wkt: Column | str, mode: str = "sql") -> Column:
    """Point WKT to ``struct<lon, lat>``.

    sql      only 'POINT(' upper case, one space between the numbers; values
             outside the degree ranges stay (the caller filters)
    strict   any case, any white space, closing bracket last
    lenient  as strict, but text may stand between 'POINT' and the first
             bracket and after the last one
    """
    s = as_column(wkt)
    if mode == "sql":
        inner = F.replace(F.replace(s, F.lit("POINT("), F.lit("")), F.lit(")"), F.lit(""))
        parts = F.split(inner, " ")
        lon = F.try_element_at(parts, F.lit(1)).try_cast("double")
        lat = F.try_element_at(parts, F.lit(2)).try_cast("double")
        return F.struct(lon.alias("lon"), lat.alias("lat"))
    if mode == "strict":
        pattern = r"(?is)^\s*POINT\((.*)\)\s*$"
    elif mode == "lenient":
        pattern = r"(?is)^\s*POINT[^(]*\((.*)\)[^)]*$"
    else:
        raise ValueError(f"unknown point mode {mode!r}")
    inner = F.trim(F.regexp_replace(F.regexp_extract(s, pattern, 1), r"\s+", " "))

    def numbers(parts: Column) -> Column:
        lon = to_double(F.try_element_at(parts, F.lit(1)))
        lat = to_double(F.try_element_at(parts, F.lit(2)))
        return F.struct(lon.alias("lon"), lat.alias("lat"))

    def checked(p: Column) -> Column:
        ok = in_range(p["lon"], p["lat"])
        return F.struct(F.when(ok, p["lon"]).alias("lon"), F.when(ok, p["lat"]).alias("lat"))

    return let(let(F.split(inner, " "), numbers), checked)


def looks_like_point(wkt: Column | str, mode: str = "sql") -> Column:
    """Cheap prefix test that the scan can push down."""
    s = as_column(wkt)
    if mode in ("sql", "strict"):
        return s.isNotNull() & s.startswith("POINT(")
    return s.isNotNull() & (s.ilike("point(%") | s.ilike("point (%"))


def search_radius_m(area_m2: Column | str) -> Column:
    """Radius of the circle with this area, in whole metres, kept in bounds."""
    area = as_column(area_m2).cast("double")
    r = F.floor(F.sqrt(area / F.pi()))
    bounded = F.greatest(F.lit(MIN_RADIUS_M), F.least(F.lit(MAX_RADIUS_M), r))
    return F.when(area > 0, bounded).otherwise(F.lit(DEFAULT_RADIUS_M)).cast("int")
