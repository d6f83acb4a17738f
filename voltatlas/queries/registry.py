"""Queries on the driver tables, each next to the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from voltatlas.session import configure, spread

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

# Fixed value: the run timestamp of every query, so results repeat.
RUN_TS = "2024-06-01 12:00:00"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(configure(spark), sf_dir)

        QUERIES[fn.__name__] = run
        if sql is not None:
            SQL[fn.__name__] = sql.strip()
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The same for queries whose work per row is large: all cores take part."""
    df = table(spark, sf_dir, name)
    return spread(df.select(*columns) if columns else df)
