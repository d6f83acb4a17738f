"""Writers."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltatlas.functions.timestamps import repair_ts
from voltatlas.operators.align import align, evolve
from voltatlas.operators.quality import require_rows, require_text_geometry
from voltatlas.specs import struct

# Fixed value: rows per row group the layers are written with.
ROWS_PER_GROUP = 50_000
# Rows per file; keeps files of one partition near each other in size.
ROWS_PER_FILE = 5_000_000


def _writer(df: DataFrame):
    """Zstandard Parquet in row groups of ``ROWS_PER_GROUP`` rows."""
    w = df.write.option("compression", "zstd").option("maxRecordsPerFile", ROWS_PER_FILE)
    return w.option("parquet.block.row.count.limit", ROWS_PER_GROUP)


def write_layer(df: DataFrame, path: str, country: str, region: str, dataset: str, dt: str) -> None:
    """Layer table under country/region/dataset/dt; writing a day again replaces that day only."""
    require_rows(df, f"{country}/{region}/{dataset}")
    keys = {"country": country, "region": region, "dataset": dataset, "dt": dt}
    named = df.withColumns({k: F.lit(v) for k, v in keys.items()})
    _writer(named).mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def write_both(text: DataFrame, geometry: DataFrame, path: str) -> None:
    """Text table and geometry table side by side."""
    require_text_geometry(text)
    _writer(text).mode("overwrite").parquet(f"{path}/text")
    _writer(geometry).mode("overwrite").parquet(f"{path}/geometry")


VERSIONS = "version long, folder string, parts array<string>"


def publish(spark: SparkSession, path: str, parts: dict[str, DataFrame], checks: dict[str, Callable[[DataFrame], DataFrame]] | None = None) -> int:
    """Write all ``parts`` as one new version, which readers see whole or not at all; returns its number.

    Every part is evaluated once, into a folder that no reader knows.  ``checks``
    look at what was written and raise if it is not fit.  Then one row in a file of
    its own names the folder: it appears by a rename, and with it all parts.  A run that
    fails before that leaves the version before it, and readers that have
    begun keep theirs, as no file is ever replaced.
    """
    folder = f"{path}/data/{uuid.uuid4().hex}"
    for name, df in parts.items():
        _writer(df).parquet(f"{folder}/{name}")
    for name, check in (checks or {}).items():
        check(spark.read.parquet(f"{folder}/{name}"))
    number = (_version(spark, path) or (0,))[0] + 1
    row = spark.createDataFrame([(number, folder, sorted(parts))], VERSIONS)
    row.coalesce(1).write.mode("append").parquet(f"{path}/versions")
    return number


def versions(spark: SparkSession, path: str) -> DataFrame | None:
    """One row for each version published under ``path``; None if there is none."""
    try:
        return spark.read.schema(VERSIONS).parquet(f"{path}/versions")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _version(spark: SparkSession, path: str, number: int | None = None):
    known = versions(spark, path)
    if known is None:
        return None
    if number is not None:
        known = known.where(F.col("version") == number)
    # Should two writers ever give the same number, all readers settle for the same one.
    return known.agg(F.max(F.struct("version", "folder"))).first()[0]


def read_published(spark: SparkSession, path: str, part: str, version: int | None = None) -> DataFrame:
    """One part of the newest version, or of the one asked for."""
    found = _version(spark, path, version)
    if found is None:
        raise ValueError(f"nothing is published under {path}" + (f" as version {version}" if version else ""))
    return spark.read.parquet(f"{found[1]}/{part}")


def replace_table(df: DataFrame, path: str) -> None:
    """The whole prefix is replaced."""
    _writer(df).mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def write_partitions(df: DataFrame, path: str, by: list[str]) -> None:
    """Replace the partitions present in ``df``; others stay.

    Rows are brought together by partition first, a large partition in several
    parts, so the number of files follows the data and not the number of tasks.
    """
    _writer(df.hint("rebalance", *by)).mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def write_levels(df: DataFrame, path: str, year: int, scale: str, crs: int) -> None:
    """Boundaries under year=/scale=/crs=/level=."""
    write_partitions(df, f"{path}/year={year}/scale={scale}/crs={crs}", ["level"])


def write_snapshot(df: DataFrame, path: str, snapshot: str, raw: DataFrame | None = None) -> str:
    """A new immutable snapshot: tidy table and, if given, the raw text; an existing one is an error."""
    target = f"{path}/snapshot={snapshot}"
    _writer(df).mode("errorifexists").parquet(target)
    if raw is not None:
        raw.select(F.col(raw.columns[0]).cast("string").alias("value")).write.mode("errorifexists").text(
            f"{path}_raw/snapshot={snapshot}"
        )
    return target


SCHEMAS = "version long, ddl string"


def schema_versions(spark: SparkSession, path: str) -> DataFrame | None:
    """One row for each schema the table has had, from the log beside it; None if it has none."""
    try:
        return spark.read.schema(SCHEMAS).parquet(f"{path}_schemas")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def logged_schema(spark: SparkSession, path: str, version: int | None = None) -> T.StructType | None:
    """The table's newest schema, or the one it had as of ``version``."""
    log = schema_versions(spark, path)
    if log is None:
        return None
    if version is not None:
        log = log.where(F.col("version") <= version)
    found = log.agg(F.max(F.struct("version", "ddl"))).first()[0]
    return None if found is None else T.StructType.fromJson(json.loads(found.ddl))


def log_schema(spark: SparkSession, path: str, wanted: T.StructType | str) -> T.StructType:
    """The table's schema with the columns of ``wanted`` it lacked; a new version if there are any.

    Columns are only ever added.  One that is there with another type is an error.  The
    entry comes before the rows, so no file holds a column that the log does not name.
    """
    wanted, have = struct(wanted), logged_schema(spark, path)
    known = {f.name.lower(): f.dataType for f in (have or wanted).fields}
    clash = [f"{f.name}: {known[f.name.lower()].simpleString()}, not {f.dataType.simpleString()}" for f in wanted.fields if known.get(f.name.lower(), f.dataType) != f.dataType]
    if clash:
        raise ValueError(f"columns of {path} have other types: {clash}")
    grown = evolve(have, wanted) if have is not None else wanted
    if have is None or len(grown) > len(have):
        log = schema_versions(spark, path)
        number = 1 if log is None else log.agg(F.max("version")).first()[0] + 1
        spark.createDataFrame([(number, grown.json())], SCHEMAS).coalesce(1).write.mode("append").parquet(f"{path}_schemas")
    return grown


def append_table(df: DataFrame, path: str, schema: T.StructType | str, run_ts: Column, ts: list[str]) -> None:
    """Fit to the table's schema, repair timestamps, append; an empty input writes nothing.

    The table's schema is the logged one with the columns of ``schema`` that are new.
    """
    fitted = align(df, schema)
    fitted = fitted.withColumns({c: repair_ts(c, run_ts) for c in ts})
    if not fitted.isEmpty():
        log_schema(df.sparkSession, path, schema)
        _writer(fitted).mode("append").parquet(path)


def read_evolving(spark: SparkSession, path: str, *schemas: T.StructType | str, version: int | None = None) -> DataFrame:
    """A table whose schema has grown; files written before a column show NULL for it.

    The schema is the table's own, from its log (as of ``version``, if given), unless the caller states the
    ``schemas`` it has had.
    """
    if schemas:
        schema = struct(schemas[0])
        for wanted in schemas[1:]:
            schema = evolve(schema, wanted)
    else:
        schema = logged_schema(spark, path, version)
        if schema is None:
            raise ValueError(f"no schema is logged for {path}" + (f" as of version {version}" if version else ""))
    return spark.read.schema(schema).parquet(path)


def write_batches(df: DataFrame, path: str) -> None:
    """Landing files per run and batch."""
    df.write.mode("append").partitionBy("run_id", "batch_id").json(path)


def event_values(events: DataFrame, nested: list[str] | None = None) -> DataFrame:
    """One JSON value per event, with the event's id as key and its properties as headers.

    ``nested`` names text columns that hold JSON; they go out as objects.
    """
    cols = [F.try_parse_json(c).alias(c) if c in (nested or []) else F.col(c) for c in events.columns]
    return events.select(
        F.col("event_id").alias("key"),
        F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}).alias("value"),
        F.array(
            *[
                F.struct(F.lit(n).alias("key"), F.encode(F.col(n), "UTF-8").alias("value"))
                for n in ("event_id", "run_id", "source")
            ]
        ).alias("headers"),
    )


def write_event_files(values: DataFrame, path: str) -> None:
    values.select("value").write.mode("append").text(path)


def write_event_topic(values: DataFrame, servers: str, topic: str) -> None:
    """Needs the Kafka connector on the cluster."""
    (
        values.write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("includeHeaders", "true")
        .save()
    )
