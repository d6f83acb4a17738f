"""JSON-stat documents."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_META = (
    "id array<string>, size array<int>, "
    "dimension map<string,struct<category:struct<index:map<string,int>>>>"
)


@dataclass(frozen=True)
class CubeDimension:
    """A dimension: its size and its (idx, code) table."""

    name: str
    size: int
    codes: DataFrame


def read_cube(spark: SparkSession, path: str) -> tuple[DataFrame, list[CubeDimension]]:
    """Sparse values as (flat_index, value), and the dimensions in ``id`` order.

    Only the dimension names and sizes reach the driver.
    """
    text = spark.read.text(path, wholetext=True)
    meta = text.select(F.from_json("value", _META).alias("m"))
    ids, sizes = meta.select("m.id", "m.size").first()
    if not ids:
        raise ValueError(f"no dimensions in {path}")
    index = meta.select(F.explode("m.dimension").alias("dim", "body")).select(
        "dim", F.explode("body.category.index").alias("code", "idx")
    )
    tasks = spark.sparkContext.defaultParallelism
    dims = [
        CubeDimension(n, s, index.where(F.col("dim") == n).select(F.col("idx").cast("long"), "code"))
        for n, s in zip(ids, sizes)
    ]
    values = text.select(
        F.explode(F.from_json("value", "value map<string,double>")["value"]).alias("k", "value")
    ).select(F.col("k").cast("long").alias("flat_index"), "value")
    # One task reads the document; what follows is shared out.
    values = values.repartition(tasks, "flat_index")
    return values, dims
