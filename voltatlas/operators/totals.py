"""Run totals and counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def batch_totals(events: DataFrame, batch: str = "batch_id", body: str = "body") -> DataFrame:
    """Calls, failures and 403s per batch, and for the run in the row with a NULL batch.

    One pass; every task sums its own rows first.
    """
    return events.rollup(batch).agg(
        F.count(F.lit(1)).alias("api_calls"),
        F.count_if(F.col(body).isNull()).alias("failed_calls"),
        F.count_if(F.col("http_status") == 403).alias("forbidden_calls"),
        F.count_if(F.col(body).isNotNull()).alias("answered_calls"),
    )


def station_totals(batches: DataFrame) -> DataFrame:
    """Run totals of the station stream over its batch rows."""
    names = ["candidates", "envelopes", "sent", "tomtom_403"]
    return batches.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(f"total_{n}") for n in names])


def traffic_totals(batches: DataFrame) -> DataFrame:
    names = ["sent", "api_calls", "failed_calls"]
    return batches.agg(
        *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names], F.count(F.lit(1)).alias("batches")
    )


def feature_counts(df: DataFrame, by: list[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("feature_count"))
