"""The newest row of every key, kept up to date run by run and merged as it is read.

The table is cut into hash buckets of its key.  A run adds a delta: its own newest
rows, filed by bucket.  A reader takes the base and the deltas since; only buckets that a
delta touches are merged, all others are scanned as they lie.  Compaction writes the
touched buckets anew and leaves the rest, so its cost follows what came in and
not what the table holds.  Every step becomes visible by one row of a log.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltatlas.operators.align import align
from voltatlas.specs import struct

BUCKETS = 256
# Deltas a reader has to merge, after which ``add`` compacts by itself.
MOST_DELTAS = 8
LOG = "step long, name string, folder string, base boolean, buckets array<int>, replaces array<string>"


class CurrentTable:
    """Rows under ``path``, one for each ``keys``: the greatest by ``order``, whatever run brought it.

    ``order`` should leave no ties between different rows; NULL is least.  NULL is a key
    like any other.  One writer at a time; readers may come at any time, and what they have begun
    to read stays, as no file is replaced.
    """

    def __init__(self, path: str, schema: T.StructType | str, keys: list[str], order: list[str], buckets: int = BUCKETS, most_deltas: int = MOST_DELTAS) -> None:
        self.path, self.schema, self.keys, self.order = path, struct(schema), keys, order
        self.buckets, self.most_deltas = buckets, most_deltas

    def _log(self, spark: SparkSession) -> DataFrame | None:
        try:
            return spark.read.schema(LOG).parquet(f"{self.path}/log")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def state(self, spark: SparkSession) -> tuple[dict[int, str], dict[str, list[int]], int]:
        """Folder of each base bucket, buckets of each delta not merged yet, and the last step: bounded by buckets and deltas."""
        log = self._log(spark)
        if log is None:
            return {}, {}, 0
        base = log.where("base").select("step", "folder", F.explode("buckets").alias("bucket"))
        base = base.groupBy("bucket").agg(F.max_by("folder", "step").alias("folder"))
        gone = log.select(F.explode("replaces").alias("folder"))
        live = log.where("not base").join(gone, "folder", "left_anti").select("folder", "buckets")
        last = log.agg(F.max("step")).first()[0]
        return {r.bucket: r.folder for r in base.collect()}, {r.folder: r.buckets for r in live.collect()}, last

    def _newest(self, rows: DataFrame) -> DataFrame:
        whole = F.struct(*self.schema.names)
        found = rows.groupBy("_bucket", *[F.col(k).alias(f"_{k}") for k in self.keys]).agg(F.max_by(whole, F.struct(*self.order)).alias("r"))
        return found.select("r.*", "_bucket")

    def _write(self, rows: DataFrame, folder: str) -> list[int]:
        """Rows by bucket; returns the buckets there are."""
        rows.hint("rebalance", "_bucket").write.option("compression", "zstd").partitionBy("_bucket").parquet(folder)
        try:
            stored = rows.sparkSession.read.parquet(folder)
        except AnalysisException:  # no rows, so no files and no schema
            return []
        return sorted(r[0] for r in stored.select("_bucket").distinct().collect())

    def _enter(self, spark: SparkSession, *row) -> None:
        spark.createDataFrame([row], LOG).coalesce(1).write.mode("append").parquet(f"{self.path}/log")

    def _scan(self, spark: SparkSession, places: list[tuple[str, int]]) -> DataFrame:
        paths = [f"{folder}/_bucket={bucket}" for folder, bucket in places]
        # The bucket is taken from the key again, as the folders may have different parents.
        rows = spark.read.schema(self.schema).parquet(*paths) if paths else spark.createDataFrame([], self.schema)
        return rows.select(*self.schema.names, self._bucket())

    def _bucket(self):
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int").alias("_bucket")

    def add(self, rows: DataFrame, name: str) -> bool:
        """The rows of the run ``name``; False, and nothing is done, if that run is in the table already."""
        spark = rows.sparkSession
        log = self._log(spark)
        if log is not None and not log.where(F.col("name") == name).isEmpty():
            return False
        fitted = align(rows, self.schema)
        folder = f"{self.path}/delta-{uuid.uuid4().hex}"
        found = self._write(self._newest(fitted.select(*self.schema.names, self._bucket())), folder)
        _, deltas, last = self.state(spark)
        self._enter(spark, last + 1, name, folder, False, found, [])
        if len(deltas) + 1 >= self.most_deltas:
            self.compact(spark)
        return True

    def read(self, spark: SparkSession) -> DataFrame:
        """The newest row of each key."""
        base, deltas, _ = self.state(spark)
        touched = {b for buckets in deltas.values() for b in buckets}
        as_they_lie = self._scan(spark, [(f, b) for b, f in sorted(base.items()) if b not in touched])
        if not touched:
            return as_they_lie.drop("_bucket")
        return as_they_lie.unionByName(self._merged(spark, base, deltas, touched)).drop("_bucket")

    def _merged(self, spark: SparkSession, base: dict[int, str], deltas: dict[str, list[int]], touched: set[int]) -> DataFrame:
        places = [(f, b) for b, f in sorted(base.items()) if b in touched]
        return self._newest(self._scan(spark, places + [(f, b) for f, buckets in deltas.items() for b in buckets]))

    def compact(self, spark: SparkSession) -> list[int]:
        """Merge the deltas into the base; returns the buckets written anew."""
        base, deltas, last = self.state(spark)
        touched = {b for buckets in deltas.values() for b in buckets}
        if not deltas:
            return []
        folder = f"{self.path}/base-{uuid.uuid4().hex}"
        found = self._write(self._merged(spark, base, deltas, touched), folder) if touched else []
        self._enter(spark, last + 1, None, folder, True, found, sorted(deltas))
        return found
