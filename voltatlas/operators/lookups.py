"""Lookups by key, and the check of what was sent against what landed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltatlas.functions.responses import outcome
from voltatlas.functions.values import once
from voltatlas.operators.quality import QualityError


def latest_response(responses: DataFrame, key: str = "request_key", order: str = "response_ts") -> DataFrame:
    """Newest answer per request; every task keeps one per key before the shuffle."""
    whole = F.struct(*responses.columns)
    return responses.groupBy(key).agg(F.max_by(whole, order).alias("r")).select("r.*")


def left_lookup(left: DataFrame, responses: DataFrame, left_key: str, right_key: str = "request_key") -> DataFrame:
    """Every left row with its answer; rows without one keep NULLs.

    Repeated left keys stay repeated.  A row without a key is not looked up.
    """
    right = responses.withColumnRenamed(right_key, "_rk")
    return left.join(right, left[left_key] == F.col("_rk"), "left").drop("_rk")


def with_outcome(df: DataFrame, policy: str = "traffic") -> DataFrame:
    return df.withColumn("outcome", outcome("http_status", policy))


def landed_ids(landing: DataFrame) -> DataFrame:
    """Distinct event ids of raw landing rows, under either spelling of the key.

    Rows without an id leave one NULL, which matches nothing.
    """
    content = F.col("record_content")
    ids = F.coalesce(
        F.try_variant_get(content, "$.event_id", "string"), F.try_variant_get(content, "$.EVENT_ID", "string")
    )
    return once(landing.select("record_content"), "event_id", ids).select("event_id").distinct()


def missing_events(sent: DataFrame, landed: DataFrame, key: str = "event_id") -> DataFrame:
    return sent.join(landed.select(key), key, "left_anti")


def reconcile(sent: DataFrame, landed: DataFrame, key: str = "event_id") -> DataFrame:
    """One row: sent, matched and missing over all keys.

    Both sides are cut to distinct keys before they meet.
    """
    left = sent.select(key).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    right = landed.select(F.col(key).alias("_k")).distinct()
    joined = left.join(right, F.col(key) == F.col("_k"), "left")
    found = F.col("_k").isNotNull()
    return joined.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("sent"),
        F.coalesce(F.sum(F.when(found, F.col("_n"))), F.lit(0)).alias("matched"),
        F.coalesce(F.sum(F.when(~found, F.col("_n"))), F.lit(0)).alias("missing"),
    )


def require_landed(sent: DataFrame, landed: DataFrame, key: str = "event_id") -> int:
    """The landing gate over all ids: the number landed; one that is missing is an error."""
    row = reconcile(sent.where(F.col(key).isNotNull()), landed, key).first()
    if row.missing:
        shown = [r[0] for r in missing_events(sent.where(F.col(key).isNotNull()), landed, key).select(key).limit(5).collect()]
        raise QualityError(f"{row.missing} of {row.sent} events have not landed, such as {shown}")
    return row.matched


def probe_landed(sent: DataFrame, landed: DataFrame, key: str = "event_id", probe: int = 10) -> int:
    """A quick look, not a gate: how many of the first ``probe`` ids have landed."""
    ids = [r[0] for r in sent.select(key).where(F.col(key).isNotNull()).orderBy(key).limit(probe).collect()]
    return landed.where(F.col(key).isin(ids)).count() if ids else 0
