"""What the operators share: session, scratch tables, streams of texts through Arrow batches."""

from __future__ import annotations

import gc
import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltatlas.session import configure, scratch_dir

# Rows of one Arrow batch: at a few KB a text, a few MB; a text of any length is one row.
BATCH_ROWS = 500
# Bytes of text that the array code looks at together; a longer text is a piece of its own.
PIECE_BYTES = 1 << 20


def ready(spark: SparkSession) -> SparkSession:
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark


def written(df: DataFrame, purpose: str, partition: str | None = None) -> DataFrame:
    """``df`` as a table in the shared folder: lineage ends here, and lost executors lose nothing."""
    spark = df.sparkSession
    path = scratch_dir(spark, purpose)
    writer = df.write.partitionBy(partition) if partition else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(table: DataFrame) -> None:
    """Delete the files of a table that ``written`` made and that no later job reads."""
    jvm, conf = table.sparkSession._jvm, table.sparkSession._jsparkSession.sessionState().newHadoopConf()
    for folder in {name.rsplit("/", 1)[0] for name in table.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def release(spark: SparkSession) -> None:
    """Let the shuffle files of finished phases go now: Spark drops them once nothing refers to their plan.

    The first round frees the plans, which Spark's cleaner then notices in the next.
    """
    for _ in range(3):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.3)


def columns(df: DataFrame, *names: str) -> DataFrame:
    """Only these columns, so that no other column of the table can clash with ours."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def renamed(df: DataFrame, *own: str) -> tuple[DataFrame, list[Column]]:
    """``df`` with names that clash with none of ours, but for the columns ``own``; and the columns that give it its names back."""
    names = df.columns
    inner = [n if n in own and names.index(n) == k else f"in_{k}" for k, n in enumerate(names)]
    return df.toDF(*inner), [F.col(i).alias(n) for i, n in zip(inner, names)]


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in the text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def map_texts(
    docs: DataFrame, fn: Callable[[pa.RecordBatch, list[bytes]], Iterator[pa.RecordBatch]], schema: str, text: str = "text"
) -> DataFrame:
    """Run ``fn`` over pieces of the table; it gets the other columns and the texts as UTF-8 bytes (null: None)."""
    from pyspark.sql.types import _parse_datatype_string

    docs = docs.withColumn(text, F.col(text).cast("binary"))

    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index(text)
            texts = batch.column(at).to_pylist()
            rest = batch.drop_columns([text])
            for lo, hi in pieces(texts):
                yield from fn(rest.slice(lo, hi - lo), texts[lo:hi])

    return docs.mapInArrow(run, _parse_datatype_string(schema))


def pieces(texts: list[bytes | None], limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows whose texts together stay within ``limit`` bytes."""
    lo = size = 0
    for i, t in enumerate(texts):
        n = len(t) if t is not None else 0
        if i > lo and size + n > limit:
            yield lo, i
            lo, size = i, 0
        size += n
    if lo < len(texts):
        yield lo, len(texts)
