"""Station search and availability answers to DIM, MAP and FACT rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltatlas.functions.timestamps import clamp_ts, iso_seconds
from voltatlas.functions.values import stable_event_id
from voltatlas.operators.align import align
from voltatlas.operators.lookups import left_lookup
from voltatlas.operators.ranking import last_per_key
from voltatlas.specs import (
    AVAILABILITY,
    DIM_STATIONS,
    EVENT_SOURCE,
    FACT_AVAILABILITY,
    MAP_STATIONS,
    POI_ITEM,
)

# Fixed value: where a hit without distance sorts.
_FAR = 1e18


def ranked_results(poi_json: Column | str) -> Column:
    """The hits of one search answer, nearest first, as (far, pos, item text, hit).

    An answer is one row, so its hits are sorted inside the row: no shuffle.
    """
    items = F.from_json(poi_json, "results array<string>")["results"]
    typed = F.transform(
        items,
        lambda item, pos: F.struct(
            pos.alias("pos"), item.alias("item"), F.from_json(item, POI_ITEM).alias("hit")
        ),
    )
    keyed = F.transform(
        typed,
        lambda t: F.struct(
            F.coalesce(t["hit"]["dist"], F.lit(_FAR)).alias("far"), t["pos"].alias("pos"),
            t["item"].alias("item"), t["hit"].alias("hit"),
        ),
    )
    # Struct order: distance, then position, which is unique; nothing behind it is compared.
    return F.sort_array(keyed)


def explode_results(searches: DataFrame, poi_json: str = "poi_json") -> DataFrame:
    """One row per hit: ``rank_by_dist``, ``item`` (raw text) and ``hit`` (typed)."""
    hits = searches.select("*", F.posexplode(ranked_results(poi_json)).alias("_p", "_r"))
    return hits.select(
        *searches.columns, (F.col("_p") + 1).alias("rank_by_dist"), F.col("_r.item").alias("item"),
        F.col("_r.hit").alias("hit"),
    )


def station_rows(hits: DataFrame, run_ts: Column, keep: list[str] | None = None) -> DataFrame:
    """DIM columns of each hit, not yet de-duplicated."""
    address, poi = "hit.address", "hit.poi"
    return hits.select(
        F.col("hit.id").alias("tomtom_poi_id"),
        F.col("hit.dataSources.chargingAvailability.id").alias("charging_availability_id"),
        F.col(f"{poi}.name").alias("name"),
        F.get(F.col(f"{poi}.brands"), F.lit(0))["name"].alias("brand"),
        F.get(F.col(f"{poi}.categories"), F.lit(0)).alias("category"),
        F.col(f"{address}.countryCode").alias("country_code"),
        F.col(f"{address}.countrySubdivisionName").alias("country_subdivision"),
        F.col(f"{address}.municipality").alias("municipality"),
        F.col(f"{address}.streetName").alias("street"),
        F.col(f"{address}.streetNumber").alias("street_number"),
        F.col(f"{address}.postalCode").alias("postal_code"),
        F.col(f"{address}.freeformAddress").alias("freeform_address"),
        F.col("hit.position.lat").alias("lat"),
        F.col("hit.position.lon").alias("lon"),
        F.col("hit.chargingPark.connectors").alias("connectors_static_json"),
        F.col("item").alias("raw_poi_json"),
        run_ts.alias("updated_at"),
        *(keep or []),
    )


def map_rows(hits: DataFrame, run_ts: Column) -> DataFrame:
    """One row per candidate and hit."""
    return hits.select(
        "region_code", "region", "h3_r7", "degurba",
        F.col("request_point_lat").alias("query_lat"), F.col("request_point_lon").alias("query_lon"),
        "radius_m", F.col("hit.id").alias("tomtom_poi_id"), F.col("hit.dist").alias("dist_m"),
        F.col("hit.score").alias("score"), "rank_by_dist", run_ts.alias("load_ts"),
        F.col("poi_json").alias("raw_search_json"),
    )


def availability_rows(answers: DataFrame, run_ts: Column, avail_json: str = "avail_json") -> DataFrame:
    """One row per connector and power level.

    A connector without levels gives one row from its current counts with a
    NULL power.  ``total`` belongs to the connector and repeats on each of its
    levels, so it must not be summed over them.
    """
    connectors = F.from_json(avail_json, AVAILABILITY)["connectors"]
    rows = answers.select("*", F.explode(connectors).alias("c"))
    levels = F.col("c.availability.perPowerLevel")
    now = F.col("c.availability.current")
    counts = ["available", "occupied", "reserved", "unknown", "outOfService"]
    current = F.struct(F.lit(None).cast("double").alias("powerKW"), *[now[n].alias(n) for n in counts])
    per_level = F.when(F.size(levels) > 0, levels).otherwise(F.array(current))
    flat = rows.select("*", F.explode(per_level).alias("l"))
    return flat.select(
        "charging_availability_id", run_ts.alias("snapshot_ts"), F.col("c.type").alias("connector_type"),
        F.col("l.powerKW").alias("power_kw"), F.col("c.total").alias("total"),
        *[F.col(f"l.{n}").alias(n) for n in counts[:-1]],
        F.col("l.outOfService").alias("out_of_service"), F.col(avail_json).alias("raw_avail_json"),
    )


@dataclass(frozen=True)
class StationStar:
    """The three station tables of one run."""

    dim: DataFrame
    map: DataFrame
    fact: DataFrame


def station_star(
    searches: DataFrame,
    availability: DataFrame,
    run_ts: Column,
    candidate_order: str = "cand_ord",
    dedupe_fact: bool = False,
) -> StationStar:
    """Candidates with their search answer, and availability answers by id, to the star.

    ``searches`` holds the candidate columns, ``request_point_lat/lon``,
    ``radius_m``, ``cand_ord`` and ``poi_json``; ``availability`` holds
    (request_key, body).  DIM keeps the last row met per station.  A station
    near two candidates gives two groups of FACT rows unless ``dedupe_fact``.
    """
    hits = explode_results(searches)
    stamped = clamp_ts(run_ts, run_ts)
    rows = station_rows(hits, stamped, [candidate_order, "rank_by_dist"])
    dim = last_per_key(rows, ["tomtom_poi_id"], [candidate_order, "rank_by_dist"])
    wanted = rows.select("charging_availability_id").where("charging_availability_id <> ''")
    if dedupe_fact:
        wanted = wanted.distinct()
    answers = availability.select("request_key", F.col("body").alias("avail_json"))
    asked = left_lookup(wanted, answers, "charging_availability_id").where("avail_json IS NOT NULL")
    return StationStar(
        align(dim, DIM_STATIONS),
        align(map_rows(hits, stamped), MAP_STATIONS),
        align(availability_rows(asked, stamped), FACT_AVAILABILITY),
    )


def current_stations(history: DataFrame) -> DataFrame:
    """The usable view of the appended DIM: newest row per station.

    Within a run it is the row met last, by candidate and rank, as ``station_star``
    decides; a history without these two leaves that to the text.
    """
    met = [c for c in ("cand_ord", "rank_by_dist") if c in history.columns]
    newest = F.max_by(F.struct(*history.columns), F.struct("updated_at", *met, "raw_poi_json"))
    return history.groupBy("tomtom_poi_id").agg(newest.alias("r")).select("r.*").drop(*met)


def station_envelopes(
    candidates: DataFrame,
    searches: DataFrame,
    availability: DataFrame,
    run_id: str,
    run_ts: Column,
    key: str = "request_key",
) -> DataFrame:
    """One envelope per candidate: its search answer and the availability answers.

    ``searches`` holds one answer per ``request_key``; candidates may share a
    key.  Failed searches and lookups stay in with status and error.  The lists
    are built once per search answer, from its own hits, and then handed to
    every candidate that asked it, so a popular key makes no long list.
    """
    answered_ok = F.when(F.col("http_status") < 400, F.col("body"))
    found = left_lookup(candidates, searches.withColumn("poi_json", answered_ok).drop("body"), key)
    items = F.from_json(answered_ok, "results array<string>")["results"]
    ids = searches.select(F.col("request_key").alias("_k"), F.posexplode(items).alias("pos", "item")).select(
        "_k", "pos",
        F.get_json_object("item", "$.dataSources.chargingAvailability.id").alias("availability_id"),
    ).where("availability_id <> ''")
    # The ids alone are shuffled for this, not the answers they stand in.
    ids = ids.join(candidates.select(F.col(key).alias("_k")).distinct(), "_k", "left_semi")
    answered = left_lookup(ids, availability, "availability_id")
    good = F.coalesce(F.col("http_status") < 400, F.lit(False))
    entry = F.struct(
        "pos", F.col("availability_id").alias("chargingAvailabilityId"), good.alias("ok"),
        F.col("http_status").alias("status_code"), F.col("error_message").alias("error"),
        F.when(good, F.col("body")).alias("avail_json"),
    )
    lists = answered.groupBy("_k").agg(F.array_sort(F.collect_list(entry)).alias("_list"))
    joined = found.join(lists, found[key] == F.col("_k"), "left").drop("_k")
    snapshots = F.transform(
        "_list",
        lambda e: F.struct(
            *[e[n].alias(n) for n in ("chargingAvailabilityId", "ok", "status_code", "error", "avail_json")]
        ),
    )
    empty = F.array().cast(
        "array<struct<chargingAvailabilityId:string,ok:boolean,status_code:int,error:string,avail_json:string>>"
    )
    snapshot_ts = iso_seconds(run_ts)
    return joined.select(
        stable_event_id(F.lit(run_id), key, "region_code", "h3_r7", snapshot_ts).alias("event_id"),
        F.lit(run_id).alias("run_id"),
        snapshot_ts.alias("snapshot_ts"), F.lit(EVENT_SOURCE).alias("source"), "http_status", "error_message",
        "region_code", "region", "h3_r7", "degurba", "request_point_lat", "request_point_lon", "radius_m",
        "poi_json", F.coalesce(snapshots, empty).alias("availability_snapshots"),
        (F.col("cand_ord") if "cand_ord" in candidates.columns else F.lit(None)).cast("bigint").alias("cand_ord"),
    )


def envelope_searches(envelopes: DataFrame) -> DataFrame:
    """Station envelopes as ``station_star`` input for MAP and DIM."""
    return envelopes.select(
        "event_id", "region_code", "region", "h3_r7", "degurba", "request_point_lat", "request_point_lon",
        "radius_m", "poi_json", "cand_ord",
    )


def envelope_availability(envelopes: DataFrame) -> DataFrame:
    """Availability answers inside envelopes; failed ones carry no rows."""
    lists = envelopes.select("event_id", F.explode("availability_snapshots").alias("s"))
    return lists.where("s.ok AND s.avail_json IS NOT NULL").select(
        "event_id", F.col("s.chargingAvailabilityId").alias("charging_availability_id"),
        F.col("s.avail_json").alias("avail_json"),
    )
