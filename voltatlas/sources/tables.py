"""Candidate, response, batch-file, snapshot and envelope scans."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltatlas.functions.points import in_range, looks_like_point, point_lon_lat
from voltatlas.functions.values import once
from voltatlas.specs import CANDIDATE_ROAD, RESPONSE, struct


def candidate_cells(df: DataFrame) -> DataFrame:
    """Cells that have a point text; the prefix test reaches the scan."""
    return df.where(looks_like_point("cell_center_wkt_4326"))


def candidate_roads(df: DataFrame, wkt_mode: str = "sql") -> DataFrame:
    """Roads with a valid centroid, which becomes request_point_lat/lon.

    ``wkt_mode`` picks the prefix test and the parser together.
    """
    names = [n for n in struct(CANDIDATE_ROAD).names if n != "degurba"]
    roads = df.where(looks_like_point("road_centroid_wkt_4326", wkt_mode)).select(
        *names, F.col("degurba").try_cast("int").alias("degurba")
    )
    kept = once(roads, "p", point_lon_lat("road_centroid_wkt_4326", wkt_mode))
    return (
        kept.where(in_range("p.lon", "p.lat"))
        .withColumns({"request_point_lat": F.col("p.lat"), "request_point_lon": F.col("p.lon")})
        .drop("p")
    )


def read_batch_files(
    spark: SparkSession, paths: list[str], schema: T.StructType | str, multi_line: bool = True, mode: str = "failfast"
) -> DataFrame:
    """Record files of many batches as one table; blank files and lines add no rows.

    A file is a record or a list of records; with ``multi_line=False`` every line
    is one, and large files can be split.  No file, or no text in any, is an error.

    failfast    a text that is no JSON record stops the job and is shown
    quarantine  it stays as a row: ``bad`` with its text, ``file``, NULL fields
    """
    if mode not in ("failfast", "quarantine"):
        raise ValueError(f"unknown mode {mode!r}")
    if not paths:
        raise ValueError("no batch files given")
    texts = spark.read.text(paths, wholetext=multi_line).where(F.col("value").rlike(r"\S"))
    texts = texts.select("value", F.col("_metadata.file_path").alias("file"))
    if texts.isEmpty():
        raise ValueError("all batch files were empty; nothing to load")
    fields = struct(schema)
    # As the only entry of a list: text after the record makes the list unreadable.
    entries = F.from_json(F.concat(F.lit("["), "value", F.lit("]")), "array<string>")
    rows = once(texts, "e", entries)
    one = F.when(F.size("e") == 1, F.get("e", F.lit(0)))
    rows = once(rows.select("value", "file", one.alias("one")), "r", F.from_json("one", T.ArrayType(fields)))
    blank = ~F.col("value").rlike(r"\S")
    bad = ~blank & (F.col("r").isNull() | F.exists("r", lambda r: r.isNull()))
    if mode == "failfast":
        shown = F.concat(F.lit("cannot parse "), "file", F.lit(": "), F.left("value", F.lit(200)))
        checked = F.when(bad, F.raise_error(shown)).otherwise(F.col("r"))
        return rows.select(F.inline(checked))
    kept = rows.select(
        "file", F.when(bad, F.col("value")).alias("bad"), F.explode_outer(F.when(~bad, F.col("r"))).alias("r")
    )
    return kept.where("r is not null or bad is not null").select("r.*", "bad", "file")


def read_responses(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.schema(RESPONSE).format(fmt).load(path)


def fetch_responses(
    requests: DataFrame,
    fetch: Callable[[str, str], tuple[int | None, str | None, str | None]],
    partitions: int,
) -> DataFrame:
    """Call ``fetch(request_key, params_json)`` for each row of (request_key, params).

    The calls run in the tasks, ``partitions`` at a time at most.  ``fetch``
    returns (status, error, body) and must not raise; failures stay rows.
    """

    def call(batches: Iterable):
        import pandas as pd

        for batch in batches:
            answers = [fetch(k, p) for k, p in zip(batch.request_key, batch.params)]
            yield pd.DataFrame(
                {
                    "request_key": batch.request_key,
                    "http_status": pd.array([a[0] for a in answers], dtype="Int32"),
                    "error_message": [a[1] for a in answers],
                    "body": [a[2] for a in answers],
                }
            )

    keyed = requests.select(
        F.col("request_key").cast("string"), F.col("params").cast("string")
    ).repartition(partitions)
    return keyed.mapInPandas(call, RESPONSE)


def read_latest_snapshot(spark: SparkSession, path: str, partition: str = "snapshot") -> DataFrame:
    """Newest snapshot partition only, by the names of the folders: no other one is opened."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    listed = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(root)
    names = [s.getPath().getName() for s in listed if s.isDirectory()]
    newest = max((n for n in names if n.startswith(f"{partition}=")), default=None)
    if newest is None:
        raise FileNotFoundError(f"no {partition}= folder in {path}")
    return spark.read.option("basePath", path).parquet(f"{path.rstrip('/')}/{newest}")


def latest_partition(df: DataFrame, column: str) -> DataFrame:
    """Rows of the largest value of ``column``, lazily: one scalar, then a filter."""
    newest = df.agg(F.max(column).alias("_newest"))
    return df.join(F.broadcast(newest), df[column] == newest["_newest"], "left_semi")


def read_envelopes(spark: SparkSession, path: str, schema: T.StructType | str, files_per_trigger: int = 1000) -> DataFrame:
    """Envelope files, one JSON object per line, as a stream; a backlog comes in micro-batches of so many files."""
    files = spark.readStream.schema("value string").option("maxFilesPerTrigger", files_per_trigger).text(path)
    return parse_envelopes(files, schema)


def write_unreadable(spark: SparkSession, path: str, target: str, checkpoint: str):
    """The stream beside ``read_envelopes``: messages without an event id, as text files under ``target``."""
    files = spark.readStream.schema("value string").option("maxFilesPerTrigger", 1000).text(path)
    bad = unreadable_messages(files).where(F.col("value").rlike(r"\S"))
    return bad.writeStream.format("text").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_envelope_topic(spark: SparkSession, servers: str, topic: str, schema: T.StructType | str) -> DataFrame:
    """The same from a topic; needs the Kafka connector on the cluster."""
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .load()
    )
    return parse_envelopes(raw.select(F.col("value").cast("string")), schema)


def parse_envelopes(df: DataFrame, schema: T.StructType | str) -> DataFrame:
    """Envelope text to columns; nested payloads stay JSON text for the consumer.

    Messages without an event id are not envelopes; ``unreadable_messages`` has them.
    """
    parsed = once(df.select("value"), "e", F.from_json("value", schema))
    return parsed.where("e.event_id IS NOT NULL").select("e.*")


def unreadable_messages(df: DataFrame) -> DataFrame:
    """The messages that ``parse_envelopes`` leaves out, for a quarantine table."""
    return df.where(F.get_json_object("value", "$.event_id").isNull())


def batch_events(results: DataFrame, schema: T.StructType | str) -> DataFrame:
    """Events of many batch results (text in ``value``) as one table.

    A result that is not an object, or has no event list, adds nothing.
    """
    lists = results.select(F.from_json("value", "events array<string>")["events"].alias("events"))
    return parse_envelopes(lists.select(F.explode("events").alias("value")), schema)
