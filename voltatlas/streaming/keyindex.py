"""Index of the keys that a streamed table holds, for micro-batches that must not insert a key twice.

Keys lie in hash buckets, in one run of files per micro-batch.  Each run has a Bloom filter
for every bucket, sixteen bits a key, held in the executors' memory while the stream goes on.  A
micro-batch asks the filters, and reads only those buckets of those runs that may
hold one of its keys: as a rule those with repeats.  Once eight runs of a level
have come together they are merged into one run of the next, so there are few runs
and a key is rewritten a few times in all.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 256
# Runs of a level that are merged.
FAN_IN = 8
# Keys for each 64-bit word of a filter; every key sets three bits of one word.
KEYS_PER_WORD = 4
LOG = "run string, level int, dropped boolean"


class KeyIndex:
    """Keys under ``path``.  ``owner`` marks which micro-batch brought a key, so that one run again does not meet its own keys."""

    def __init__(self, path: str, keys: list[str], buckets: int = BUCKETS, fan_in: int = FAN_IN) -> None:
        self.path, self.keys, self.buckets, self.fan_in = path, keys, buckets, fan_in
        self._filters: dict[str, DataFrame] = {}
        #: Buckets of runs opened by the last ``known``, and those there were.
        self.opened, self.there = 0, 0

    # A run counts from the moment its row is in the log; the row appears by a rename.

    def _log(self, spark: SparkSession, rows: list[tuple[str, int, bool]]) -> None:
        spark.createDataFrame(rows, LOG).coalesce(1).write.mode("append").parquet(f"{self.path}/log")

    def runs(self, spark: SparkSession) -> dict[str, int]:
        """Level of every live run: some eight a level."""
        try:
            log = spark.read.schema(LOG).parquet(f"{self.path}/log")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return {}
        live = log.groupBy("run").agg(F.max("level").alias("level"), F.max("dropped").alias("gone")).where("not gone")
        return {r.run: r.level for r in live.collect()}

    def _marked(self, df: DataFrame) -> DataFrame:
        """With the bucket, and the hash that the filters use."""
        return df.withColumns({"_bucket": F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int"), "_h": F.xxhash64(*self.keys, F.lit(1))})

    @staticmethod
    def _bits(h: Column) -> Column:
        one = F.lit(1).cast("long")
        bit = lambda k: F.call_function("shiftleft", one, F.shiftrightunsigned(h, k).bitwiseAND(F.lit(63)).cast("int"))
        return bit(0).bitwiseOR(bit(6)).bitwiseOR(bit(12))

    @staticmethod
    def _word(h: Column, words: Column) -> Column:
        return F.pmod(F.shiftrightunsigned(h, 20), words)

    def _write(self, keys: DataFrame, run: str) -> None:
        """One run: the keys with their owners by bucket, and a filter for each bucket."""
        spark, folder = keys.sparkSession, f"{self.path}/run={run}"
        marked = self._marked(keys.select(*self.keys, "owner"))
        marked.repartition("_bucket").write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("_bucket").parquet(f"{folder}/keys")
        if not self._parts(spark, run):
            return
        stored = spark.read.parquet(f"{folder}/keys")
        words = stored.groupBy("_bucket").agg(F.ceil(F.count(F.lit(1)) / KEYS_PER_WORD).alias("words"))
        held = stored.join(F.broadcast(words), "_bucket")  # a row a bucket
        held = held.groupBy("_bucket", "words", self._word(F.col("_h"), F.col("words")).alias("word")).agg(F.bit_or(self._bits(F.col("_h"))).alias("bits"))
        held.write.mode("overwrite").parquet(f"{folder}/filter")

    def _parts(self, spark: SparkSession, run: str) -> bool:
        try:
            spark.read.parquet(f"{self.path}/run={run}/keys")
        except AnalysisException:  # a run without keys has no files and so no schema
            return False
        return True

    def _filter(self, spark: SparkSession, run: str) -> DataFrame:
        """A run's filter, read once while the run lives; executors that are lost read it again."""
        if run not in self._filters:
            schema = "_bucket int, words long, word long, bits long"
            self._filters[run] = spark.read.schema(schema).parquet(f"{self.path}/run={run}/filter").withColumn("run", F.lit(run)).persist()
        return self._filters[run]

    def known(self, batch: DataFrame, owner: str) -> DataFrame | None:
        """Keys of ``batch`` that the index holds from other owners, or None if it surely holds none."""
        spark = batch.sparkSession
        runs = self.runs(spark)
        for run in set(self._filters) - set(runs):
            self._filters.pop(run).unpersist()
        self.opened = self.there = 0
        if not runs:
            return None
        filters = None
        for run in runs:
            one = self._filter(spark, run)
            filters = one if filters is None else filters.unionByName(one)
        asked = self._marked(batch.select(*self.keys)).select("_bucket", "_h")
        sizes = filters.groupBy("run", "_bucket").agg(F.max("words").alias("words"))  # a row a run and bucket
        probes = asked.join(F.broadcast(sizes), "_bucket").withColumn("word", self._word(F.col("_h"), F.col("words")))
        hits = probes.join(filters.drop("words"), ["run", "_bucket", "word"])
        mine = self._bits(F.col("_h"))
        hits = hits.where(F.col("bits").bitwiseAND(mine) == mine)
        places = [(r.run, r[1]) for r in hits.select("run", "_bucket").distinct().collect()]  # at most runs times buckets
        self.opened, self.there = len(places), sizes.count()
        if not places:
            return None
        paths = [f"{self.path}/run={run}/keys/_bucket={bucket}" for run, bucket in places]
        held = spark.read.parquet(*paths)
        return held.where(F.col("owner") != owner).select(*self.keys).join(batch.select(*self.keys).distinct(), self.keys, "left_semi").distinct()

    def add(self, keys: DataFrame, owner: str) -> None:
        """Store the keys that the micro-batch ``owner`` has brought; doing it again replaces them."""
        spark = keys.sparkSession
        self._write(keys.select(*self.keys).withColumn("owner", F.lit(owner)), owner)
        if owner in self._filters:
            self._filters.pop(owner).unpersist()
        if self._parts(spark, owner) and owner not in self.runs(spark):
            self._log(spark, [(owner, 0, False)])

    def compact(self, spark: SparkSession) -> None:
        """Merge the runs of every level that has come to ``fan_in`` of them.

        The new run and the end of the old ones are one entry of the log.  Their
        files stay for readers that have begun; nothing names them any more.
        """
        runs = self.runs(spark)
        for level in sorted(set(runs.values())):
            own = sorted(r for r, at in runs.items() if at == level)
            if len(own) < self.fan_in:
                continue
            merged = f"merged-{uuid.uuid4().hex}"
            keys = spark.read.parquet(*[f"{self.path}/run={r}/keys/_bucket=*" for r in own]).select(*self.keys, "owner")
            self._write(keys, merged)
            self._log(spark, [(merged, level + 1, False), *[(r, level, True) for r in own]])
