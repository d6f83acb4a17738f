"""Road requests and flow answers to the traffic fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltatlas.functions.geometry import linestring_wkt
from voltatlas.functions.responses import ERROR_LIMITS, error_text
from voltatlas.functions.timestamps import clamp_ts, coerce_ts_column, iso_seconds
from voltatlas.functions.values import once, request_point_key, stable_event_id, to_bool, to_bool_column, to_int
from voltatlas.operators.align import align
from voltatlas.operators.lookups import left_lookup
from voltatlas.specs import (
    CANDIDATE_ROAD,
    COORDINATES,
    EVENT_SOURCE,
    FACT_TRAFFIC,
    FLOW,
    TRAFFIC_VERSION,
    TRAFFIC_ZOOM,
    struct,
)


def ratio(top: Column | str, bottom: Column | str) -> Column:
    """NULL when either side is missing or 0, so a standstill has no ratio."""
    top, bottom = (F.col(c) if isinstance(c, str) else c for c in (top, bottom))
    return F.try_divide(
        F.nullif(top.cast("double"), F.lit(0.0)), F.nullif(bottom.cast("double"), F.lit(0.0))
    )


def flow_metrics(df: DataFrame) -> DataFrame:
    """Add speed_ratio, delay_sec and delay_ratio."""
    return df.withColumns(
        {
            "speed_ratio": ratio("current_speed", "free_flow_speed"),
            "delay_sec": F.col("current_travel_time") - F.col("free_flow_travel_time"),
            "delay_ratio": ratio("current_travel_time", "free_flow_travel_time"),
        }
    )


def road_requests(roads: DataFrame) -> DataFrame:
    """Roads with ``request_point_key``."""
    return roads.withColumn("request_point_key", request_point_key(roads))


def flow_columns(df: DataFrame, raw_json: str = "raw_json") -> DataFrame:
    """Add the flow-segment columns; the answer is parsed once."""
    parsed = once(df, "_f", F.from_json(raw_json, FLOW)["flowSegmentData"])
    coords = F.col("_f.coordinates.coordinate")
    flat = parsed.withColumns(
        {
            "frc": F.col("_f.frc"),
            "current_speed": to_int("_f.currentSpeed"),
            "free_flow_speed": to_int("_f.freeFlowSpeed"),
            "current_travel_time": to_int("_f.currentTravelTime"),
            "free_flow_travel_time": to_int("_f.freeFlowTravelTime"),
            "confidence": F.col("_f.confidence"),
            "road_closure": F.coalesce(to_bool("_f.roadClosure"), to_bool("_f.roadClosure", numeric=True)),
            "segment_linestring_wkt_4326": linestring_wkt(F.from_json(coords, COORDINATES)),
            "segment_coords_json": F.coalesce(coords, F.lit("[]")),
        }
    ).drop("_f")
    return flow_metrics(flat)


def normal_raw_json(raw: Column | str) -> Column:
    """Answer text as one form: an empty object means no answer, as NULL does."""
    raw = F.col(raw) if isinstance(raw, str) else raw
    return F.when(F.trim(raw).isin("{}", "", "null"), None).otherwise(raw)


def flow_fact(df: DataFrame, run_ts: Column, keep: list[str] | None = None) -> DataFrame:
    """Rows with road columns, status and ``raw_json`` to the 38-column fact.

    Failed requests stay as rows with NULL metrics.  ``keep`` names columns to
    carry along behind the fact's own.
    """
    limit, mark = ERROR_LIMITS["traffic_row"]
    ready = df.withColumns(
        {
            "raw_json": normal_raw_json("raw_json"),
            "error_message": error_text("error_message", limit, mark),
            "near_ev_station": to_bool_column(df, "near_ev_station"),
            "tomtom_zoom": F.lit(TRAFFIC_ZOOM),
            "tomtom_version": F.lit(TRAFFIC_VERSION),
            "load_ts": run_ts,
        }
    )
    if "snapshot_ts" not in df.columns:
        ready = ready.withColumn("snapshot_ts", run_ts)
    for name in ("snapshot_ts", "load_ts"):
        ready = ready.withColumn(name, clamp_ts(coerce_ts_column(ready, name, "struct_first"), run_ts))
    extra = [df.schema[c] for c in keep or [] if c not in struct(FACT_TRAFFIC).names]
    return align(flow_columns(ready), T.StructType([*struct(FACT_TRAFFIC).fields, *extra]))


def with_answers(roads: DataFrame, responses: DataFrame) -> DataFrame:
    """Keyed roads with status, error and ``raw_json``; roads without an answer stay."""
    return left_lookup(roads, responses, "request_point_key").withColumnRenamed("body", "raw_json")


def traffic_envelopes(
    answered: DataFrame, run_id: str, run_ts: Column, empty_object: bool = False
) -> DataFrame:
    """One envelope per road.  ``empty_object`` writes '{}' for a missing answer, else NULL."""
    snapshot_ts = iso_seconds(run_ts)
    raw = F.coalesce("raw_json", F.lit("{}")) if empty_object else F.col("raw_json")
    road = [F.col(n) for n in struct(CANDIDATE_ROAD).names]
    return answered.select(
        stable_event_id(
            F.lit(run_id), "request_point_key", "region_code", "h3_r7", "traffic_scope", "ev_station_id", snapshot_ts
        ).alias("event_id"),
        F.lit(run_id).alias("run_id"), snapshot_ts.alias("snapshot_ts"), F.lit(EVENT_SOURCE).alias("source"),
        F.lit(TRAFFIC_ZOOM).alias("tomtom_zoom"), F.lit(TRAFFIC_VERSION).alias("tomtom_version"),
        "request_point_lat", "request_point_lon", "request_point_key", *road, "http_status", "error_message",
        raw.alias("raw_json"),
    )
