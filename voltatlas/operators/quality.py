"""Gates that stop a job, and the tables that explain why."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltatlas.functions.geometry import POLYGON_TYPES, first_vertex, ring_problem
from voltatlas.functions.points import point_lon_lat
from voltatlas.functions.timestamps import MAX_TS, MIN_TS, coerce_ts_column, ntz
from voltatlas.functions.values import let, once


class QualityError(RuntimeError):
    """A gate found the data unfit to go on."""


def require_rows(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise QualityError(f"{what}: 0 rows")
    return df


def require_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise QualityError(f"missing required columns: {missing}")
    return df


def require_text_geometry(df: DataFrame, column: str = "geom_wkt") -> DataFrame:
    """Text tables carry ``geom_wkt`` and no binary column."""
    require_columns(df, [column])
    binary = [f.name for f in df.schema.fields if isinstance(f.dataType, T.BinaryType)]
    if binary:
        raise QualityError(f"binary geometry in a text table: {binary}")
    return df


def require_degrees(df: DataFrame, column: str = "geom_wkt") -> DataFrame:
    """Output coordinates must be degrees, not metres."""
    v = first_vertex(column)
    row = df.agg(
        F.max(F.abs(v["lon"])).alias("lon"), F.max(F.abs(v["lat"])).alias("lat")
    ).first()
    if row.lon is not None and (row.lon > 180 or row.lat > 90):
        raise QualityError(f"coordinates look projected: |x| up to {row.lon}, |y| up to {row.lat}")
    return df


def split_bad(df: DataFrame, reason: Column) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad rows with ``reason``); ``reason`` is NULL for a good row."""
    marked = once(df, "reason", reason)
    return marked.where("reason IS NULL").drop("reason"), marked.where("reason IS NOT NULL")


def split_bad_points(df: DataFrame, column: str, mode: str = "lenient") -> tuple[DataFrame, DataFrame]:
    """Rows with a readable point, and the rest with the reason."""
    bad = let(point_lon_lat(column, mode), lambda p: p["lon"].isNull() | p["lat"].isNull())
    reason = F.when(F.col(column).isNull(), "missing").when(bad, "malformed")
    return split_bad(df, reason)


def require_some_points(df: DataFrame, column: str, mode: str = "lenient", samples: int = 5) -> DataFrame:
    """Good rows; an error with a few bad texts when there is none."""
    good, bad = split_bad_points(df, column, mode)
    if good.isEmpty():
        shown = [r[0] for r in bad.where(F.col(column).isNotNull()).select(column).limit(samples).collect()]
        raise QualityError(f"no valid point in {column}; samples: {shown}")
    return good


def polygon_types_only(df: DataFrame, geometry_type: str = "geometry_type") -> DataFrame:
    return df.where(F.col(geometry_type).isin(POLYGON_TYPES))


def split_bad_rings(df: DataFrame, polygons: str) -> tuple[DataFrame, DataFrame]:
    """Sound polygons, and those with an open or too short ring."""
    return split_bad(df, ring_problem(polygons))


def file_profile(spark: SparkSession, path: str) -> DataFrame:
    """One row: rows, files and bytes of a written table."""
    per_file = (
        spark.read.parquet(path)
        .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"))
        .groupBy("file")
        .agg(F.count(F.lit(1)).alias("n"), F.max("size").alias("size"))
    )
    return per_file.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("files"),
        F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"),
    )


def timestamp_fallbacks(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per column: values given, and those that ``repair_ts`` would replace by the run time."""
    given = [F.col(f"`{c}`").isNotNull() for c in columns]
    lost = [g & ~F.coalesce(coerce_ts_column(df, c).between(ntz(MIN_TS), ntz(MAX_TS)), F.lit(False)) for c, g in zip(columns, given)]
    entry = [
        F.struct(F.lit(c).alias("column_name"), F.count_if(g).alias("given"), F.count_if(x).alias("replaced"))
        for c, g, x in zip(columns, given, lost)
    ]
    return df.agg(F.array(*entry).alias("e")).select(F.inline("e"))


def output_profile(df: DataFrame) -> DataFrame:
    """One row per column: position, type, total rows, non-null rows; one scan in all."""
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"), *[F.count(df[c]).alias(f"n{i}") for i, c in enumerate(df.columns)]
    )
    entries = F.array(
        *[
            F.struct(
                F.lit(i + 1).alias("position"), F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"), F.col("rows"),
                F.col(f"n{i}").alias("non_null"),
            )
            for i, f in enumerate(df.schema.fields)
        ]
    )
    return counts.select(F.explode(entries).alias("e")).select("e.*")
