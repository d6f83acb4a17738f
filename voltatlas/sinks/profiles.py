"""Profiles kept beside a partitioned table: statistics a partition, merged without reading the table again."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltatlas.sinks.files import write_partitions

# Types that have no order, so no least and largest value.
_UNORDERED = (T.MapType, T.VariantType)


def _profiles(path: str) -> str:
    return f"{path.rstrip('/')}_profile"


def _statistics(rows: DataFrame, by: str) -> DataFrame:
    """One row a partition: its rows, the names of its files, and a struct of statistics for each column."""

    def column(field: T.StructField) -> Column:
        c = F.col(f"`{field.name}`")
        ordered = not isinstance(field.dataType, _UNORDERED)
        least, most = (F.min(c), F.max(c)) if ordered else (F.lit(None), F.lit(None))
        text = c.cast("string") if ordered else F.when(c.isNotNull(), F.to_json(F.struct(c)))
        return F.struct(
            F.count(c).alias("non_null"), least.cast(field.dataType if ordered else "string").alias("least"),
            most.cast(field.dataType if ordered else "string").alias("most"), F.hll_sketch_agg(text).alias("sketch"),
        ).alias(field.name)

    fields = [f for f in rows.schema.fields if f.name != by]
    named = rows.withColumn("_file", F.col("_metadata.file_name"))
    return named.groupBy(by).agg(
        F.count(F.lit(1)).alias("_rows"), F.sort_array(F.collect_set("_file")).alias("_files"), *[column(f) for f in fields]
    )


def _of(by: str, values: list) -> Column:
    """Partitions of these values, as a filter that prunes folders."""
    given = [v for v in values if v is not None]
    parts = ([F.col(by).isin(given)] if given else []) + ([F.col(by).isNull()] if len(given) < len(values) else [])
    return reduce(lambda a, b: a | b, parts, F.lit(False))


def write_profiled(df: DataFrame, path: str, by: str) -> None:
    """Replace the partitions present in ``df`` and their statistics; others stay.

    ``df`` is evaluated once: which partitions it had is noted during the write, and the
    statistics come from the files written.  The values of ``by`` in one write
    come to the driver, which names a folder for each of them anyway.  A run that fails
    between the two leaves statistics that ``refresh`` finds out of date.
    """
    seen = Observation()
    write_partitions(df.observe(seen, F.collect_set(by).alias("values"), F.count_if(F.col(by).isNull()).alias("nulls")), path, [by])
    got = seen.get
    values = [*(got.get("values") or []), *([None] if got.get("nulls") else [])]
    if values:
        _store(df.sparkSession, path, by, df.schema, values)


def _store(spark: SparkSession, path: str, by: str, schema: T.StructType, values: list) -> None:
    stored = spark.read.schema(schema).parquet(path).where(_of(by, values))
    _statistics(stored, by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(_profiles(path))


def stored_statistics(spark: SparkSession, path: str) -> DataFrame | None:
    """The rows kept for the table, one a partition, whatever columns it had at the time; None if there are none."""
    try:
        return spark.read.option("mergeSchema", "true").parquet(_profiles(path))
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def stale_partitions(spark: SparkSession, path: str, by: str, schema: T.StructType) -> DataFrame:
    """Values of ``by`` whose files are not those that the statistics are of; only file names are read."""
    files = spark.read.schema(schema).parquet(path).select(F.col(by).alias("_value"), F.col("_metadata.file_name").alias("_file"))
    now = files.groupBy("_value").agg(F.sort_array(F.collect_set("_file")).alias("_now"))
    known = stored_statistics(spark, path)
    if known is None:
        return now.select(F.col("_value").alias(by))
    known = known.select(F.col(by).cast(schema[by].dataType).alias("_known"), "_files")
    both = now.join(known, F.col("_value").eqNullSafe(F.col("_known")), "left")
    return both.where(~F.col("_now").eqNullSafe(F.col("_files"))).select(F.col("_value").alias(by))


def refresh(spark: SparkSession, path: str, by: str, schema: T.StructType) -> int:
    """Work out the statistics of partitions that were written without, or after, theirs; returns how many."""
    values = [r[0] for r in stale_partitions(spark, path, by, schema).collect()]
    if values:
        _store(spark, path, by, schema, values)
    return len(values)


def merged_profile(spark: SparkSession, path: str, by: str, where: Column | None = None) -> DataFrame:
    """One row a column: position, type, rows, rows with a value, least and largest value as text, about how many values.

    Merged from the statistics of the partitions that ``where``, a condition on
    ``by``, lets through.  A partition that lacks a column counts as null in it.
    """
    kept = stored_statistics(spark, path)
    if kept is None:
        raise ValueError(f"no statistics are kept for {path}")
    names = [c for c in kept.columns if c not in (by, "_rows", "_files")]
    kept = kept if where is None else kept.where(where)
    entries = []
    for i, name in enumerate(names):
        of = lambda part, name=name: F.col(f"`{name}`")[part]
        kind = kept.schema[name].dataType["least"].dataType.simpleString()
        entries.append(
            F.struct(
                F.lit(i + 1).alias("position"), F.lit(name).alias("column_name"), F.lit(kind).alias("data_type"),
                F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows"), F.coalesce(F.sum(of("non_null")), F.lit(0)).alias("non_null"),
                F.min(of("least")).cast("string").alias("least"), F.max(of("most")).cast("string").alias("most"),
                F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(of("sketch"))), F.lit(0)).alias("about_distinct"),
            )
        )
    return kept.agg(F.array(*entries).alias("e")).select(F.inline("e"))
