"""Feature scans: GeoJSON sequences, feature collections, layers, the census grid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltatlas.functions.values import once
from voltatlas.specs import LAYERS, LayerSpec

RECORD_SEPARATOR = "\x1e"

FEATURE = "properties map<string,string>, geometry string"
_FEATURE_FIELDS = "properties: map<string,string>, geometry: string"


def record_separated(spark: SparkSession, path: str) -> list[str]:
    """The files that use 0x1E anywhere; only file names come to the driver."""
    marked = spark.read.text(path).where(F.col("value").contains(RECORD_SEPARATOR))
    return sorted(r[0] for r in marked.select(F.col("_metadata.file_path")).distinct().collect())


def _records(spark: SparkSession, path: str, separator: str | None) -> DataFrame:
    if separator:
        return spark.read.option("lineSep", separator).text(path)
    marked = record_separated(spark, path)
    lines = spark.read.text(path)
    if not marked:
        return lines
    # Conditions on the file's name choose files, they are not tried on rows.
    of_marked = F.col("_metadata.file_path").isin(marked)
    apart = spark.read.option("lineSep", RECORD_SEPARATOR).text(path).where(of_marked)
    return lines.where(~of_marked).unionByName(apart)


def read_geojson_seq(
    spark: SparkSession, path: str, mode: str = "failfast", separator: str | None = None
) -> DataFrame:
    """One row per feature: ``properties`` (map), ``geometry`` (GeoJSON text), ``record``.

    A file with 0x1E in it is cut there, any other at line feeds: each file for
    itself.  Finding out costs a pass over the text; ``separator`` saves it.

    failfast    a bad record stops the job and shows its first 200 characters
    quarantine  bad records stay as rows with ``bad = true`` and NULL features
    """
    record = F.regexp_replace("value", r"^[\s\x1e]+|\s+$", "")
    rows = _records(spark, path, separator).select(record.alias("record")).where("record <> ''")
    # As the only entry of a list: text after the record makes the list unreadable.
    feature = F.from_json(F.concat(F.lit("["), "record", F.lit("]")), f"array<struct<{_FEATURE_FIELDS}>>")
    parsed = once(rows, "l", feature)
    # Says for itself that a blank is not bad: filters may be reordered around it.
    single = F.coalesce(F.size("l") == 1, F.lit(False)) & F.get("l", F.lit(0)).isNotNull() & F.col("record").endswith("}")
    bad = (F.col("record") != "") & ~single
    parsed = parsed.withColumn("f", F.when(~bad, F.get("l", F.lit(0))))
    if mode == "quarantine":
        return parsed.select("record", bad.alias("bad"), "f.properties", "f.geometry")
    if mode != "failfast":
        raise ValueError(f"unknown mode {mode!r}")
    shown = F.concat(F.lit("cannot parse record: "), F.left("record", F.lit(200)))
    # The check must feed the output, or the optimizer would drop it.
    checked = parsed.withColumn("f", F.when(bad, F.raise_error(shown)).otherwise(F.col("f")))
    return checked.select("record", "f.properties", "f.geometry")


def read_feature_collection(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Feature collections, one document per file (plain or gzip), to feature rows.

    ``level`` comes from 'level=N' or 'LEVL_N' in the file name.
    """
    schema = "features array<string>"
    docs = (
        spark.read.schema(schema)
        .option("multiLine", True)
        .json(path)
        .select("features", F.col("_metadata.file_name").alias("file_name"))
    )
    # One task reads one document; its features are parsed by many.
    rows = docs.select("file_name", F.explode("features").alias("record")).repartition(spark.sparkContext.defaultParallelism, "record")
    return (
        once(rows, "f", F.from_json("record", FEATURE))
        .select("file_name", level_of("file_name").alias("level"), "f.properties", "f.geometry")
    )


def level_of(file_name: Column | str) -> Column:
    """'level=N' in a file name, or 'LEVL_N', else 'unknown'."""
    name = F.col(file_name) if isinstance(file_name, str) else file_name
    named = F.regexp_extract(name, r"level=([^.]*)", 1)
    numbered = F.regexp_extract(name, r"LEVL_([0-9]+)", 1)
    return F.when(name.contains("level="), named).when(numbered != "", numbered).otherwise("unknown")


def properties_to_columns(df: DataFrame, spec: LayerSpec, keep: list[str] | None = None) -> DataFrame:
    """Attributes of a layer out of the property map, typed."""
    cols = [
        F.try_element_at("properties", F.lit(c)).try_cast(spec.column_type(c)).alias(c)
        for c in spec.columns
    ]
    return df.select(*cols, *(keep or []))


def read_layer(spark: SparkSession, path: str, dataset: str) -> DataFrame:
    """A map layer kept as Parquet: attributes plus ``geometry`` text."""
    if dataset not in LAYERS:
        raise KeyError(f"unknown dataset {dataset!r}")
    df = spark.read.parquet(path)
    if "geometry" not in df.columns or df.schema["geometry"].dataType != T.StringType():
        raise ValueError(f"{path}: a layer needs a text column geometry")
    spec = LAYERS[dataset]
    found = {c.lower(): c for c in df.columns}
    wrong = [c for c in spec.columns if c.lower() in found and isinstance(df.schema[found[c.lower()]].dataType, (T.ArrayType, T.MapType, T.StructType))]
    if wrong:
        raise ValueError(f"{path}: attributes must be plain values: {wrong}")
    return df


def grid_schema() -> T.StructType:
    spec = LAYERS["census_grid"]
    fields = [T.StructField(c, spec.column_type(c)) for c in spec.columns]
    return T.StructType([*fields, T.StructField("geom", T.BinaryType())])


def read_census_grid(spark: SparkSession, path: str) -> DataFrame:
    """The 29 attributes and the WKB cell; only columns used later are read."""
    return spark.read.schema(grid_schema()).parquet(path)
