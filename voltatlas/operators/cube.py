"""Flat cube index to a tidy long table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltatlas.functions.values import as_column
from voltatlas.operators.quality import require_columns, require_rows
from voltatlas.sources.cube import CubeDimension

# A dimension this small is sent to every task; the size comes from the document.
BROADCAST_CODES = 200_000


def strides(sizes: list[int]) -> list[int]:
    out, step = [], 1
    for s in reversed(sizes):
        out.append(step)
        step *= s
    return out[::-1]


def decode_flat_index(index: Column | str, sizes: list[int]) -> list[Column]:
    """Position per dimension, the last dimension running fastest."""
    k = as_column(index)
    k = k.cast("long")
    whole = lambda step: F.call_function("div", k - F.pmod(k, F.lit(step)), F.lit(step))
    return [F.pmod(whole(step), F.lit(s)) for step, s in zip(strides(sizes), sizes)]


def encode_flat_index(positions: list[Column], sizes: list[int]) -> Column:
    total = F.lit(0).cast("long")
    for p, step in zip(positions, strides(sizes)):
        total = total + p * step
    return total


def tidy_cube(
    values: DataFrame, dims: list[CubeDimension], dataset: str, run_ts: Column, keep: list[str] | None = None
) -> DataFrame:
    """dataset, one code column per dimension, value, ingest_ts.

    Every dimension is a lookup by position: sent to all tasks when its stated
    size is small, joined by key otherwise.
    """
    positions = decode_flat_index("flat_index", [d.size for d in dims])
    out = values.withColumns({f"_i{n}": p for n, p in enumerate(positions)})
    for n, dim in enumerate(dims):
        codes = dim.codes.select(F.col("idx").cast("long").alias(f"_i{n}"), F.col("code").alias(dim.name))
        # Positions lie below the size, so this bounds what is sent to every task.
        codes = codes.where(F.col(f"_i{n}") < dim.size)
        codes = F.broadcast(codes) if dim.size <= BROADCAST_CODES else codes
        out = out.join(codes, f"_i{n}", "left")
    # A position without a code is a broken document, not a row to lose.
    known = [
        F.when(F.col(d.name).isNull(), F.raise_error(F.lit(f"no code for a position of {d.name}")).cast("string"))
        .otherwise(F.col(d.name))
        .alias(d.name)
        for d in dims
    ]
    return out.select(
        F.lit(dataset).alias("dataset"), *known,
        F.col("value").cast("double").alias("value"), run_ts.alias("ingest_ts"), *(keep or []),
    )


def validate_tidy(df: DataFrame) -> DataFrame:
    return require_rows(require_columns(df, ["dataset", "value", "ingest_ts"]), "cube")
