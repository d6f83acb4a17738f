"""The star and the traffic fact from hand-written answers."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from voltatlas.functions.timestamps import ntz
from voltatlas.operators import lookups as L
from voltatlas.operators.quality import QualityError
from voltatlas.operators.stations import current_stations, station_envelopes, station_star
from voltatlas.operators.traffic import flow_fact, ratio
from voltatlas.plans.jobs import candidate_requests, enrich_stations, search_key, stations_near_candidates, traffic_feed, traffic_snapshot
from voltatlas.sinks.files import event_values
from voltatlas.sources.tables import parse_envelopes
from voltatlas.specs import (
    CANDIDATE_CELL,
    CANDIDATE_ROAD,
    DIM_STATIONS,
    FACT_AVAILABILITY,
    FACT_TRAFFIC,
    MAP_STATIONS,
    RESPONSE,
    STATION_ENVELOPE,
    TRAFFIC_ENVELOPE,
    struct,
)
from voltatlas.streaming.envelopes import station_tables

RUN = "2026-01-01 10:00:00"
NOW = dt.datetime(2026, 1, 1, 10)


def hit(i, dist=None, avail=None, **poi):
    out = {"id": i, "poi": poi, "address": {"countryCode": "PL"}, "position": {"lat": 50.0, "lon": 19.0}}
    if dist is not None:
        out["dist"] = dist
    if avail:
        out["dataSources"] = {"chargingAvailability": {"id": avail}}
    return out


FIRST = {"results": [hit("far"), hit("tie1", 5.0, "A1", name="T1", brands=[{"name": "B"}], categories=["c1", "c2"]),
                     hit("tie2", 5.0), hit("near", 1.0, "A2", name="old")]}
SECOND = {"results": [hit("near", 9.0, "A1", name="new"), hit(None, 2.0)]}
AVAIL = {"connectors": [
    {"type": "CCS", "total": 4, "availability": {"current": {"available": 9}, "perPowerLevel": [
        {"powerKW": 50.0, "available": 1, "outOfService": 1}, {"powerKW": 150, "available": 2, "occupied": 3}]}},
    {"type": "Type2", "availability": {"current": {"available": 2, "unknown": 1}, "perPowerLevel": []}},
    {"type": "Schuko", "total": 1},
]}

CELLS = [
    ("R1", "r", "h1", "POINT(19.0 50.0)", None, 9.0, "1"), ("R1", "r", "h2", "POINT(20.0 51.0)", 2e7, 8.0, "2"),
    ("R1", "r", "h3", "POINT(20.0 95.0)", 2e7, 7.0, "3"), ("R1", "r", "h4", "POINT (20.0 51.0)", 2e7, 7.0, "3"),
    ("R1", "r", "h5", "POINT(20.0 51.0)", 2e7, 99.0, "4"), ("R1", "r", "h6", None, 2e7, 99.0, "1"),
]


@pytest.fixture
def star(spark):
    cells = spark.createDataFrame(CELLS, CANDIDATE_CELL)
    searches = spark.createDataFrame([("50.0,19.0,3000", 200, None, json.dumps(FIRST)), ("51.0,20.0,2523", 200, None, json.dumps(SECOND))], RESPONSE)
    avail = spark.createDataFrame([("A1", 200, None, json.dumps(AVAIL)), ("A2", 403, "HTTP 403", None)], RESPONSE)
    return cells, searches, avail, enrich_stations(cells, searches, avail, ntz(RUN))


def test_candidates(spark, star):
    rows = candidate_requests(star[0]).orderBy("cand_ord").collect()
    assert [(r.h3_r7, r.request_key, r.cand_ord) for r in rows] == [("h1", "50.0,19.0,3000", 1), ("h2", "51.0,20.0,2523", 2)]
    assert search_key(F.lit(1.5), F.lit(2.0), F.lit(3)) is not None


def test_map(star):
    rows = star[3].map.orderBy("h3_r7", "rank_by_dist").collect()
    assert star[3].map.schema.simpleString() == struct(MAP_STATIONS).simpleString()
    got = [(r.h3_r7, r.tomtom_poi_id, r.dist_m, r.rank_by_dist) for r in rows]
    assert got == [("h1", "near", 1.0, 1), ("h1", "tie1", 5.0, 2), ("h1", "tie2", 5.0, 3), ("h1", "far", None, 4),
                   ("h2", None, 2.0, 1), ("h2", "near", 9.0, 2)]
    assert rows[0].load_ts == NOW and json.loads(rows[0].raw_search_json) == FIRST


def test_dim_last_row_wins(star):
    dim = star[3].dim
    assert dim.schema.simpleString() == struct(DIM_STATIONS).simpleString()
    rows = {r.tomtom_poi_id: r for r in dim.collect()}
    assert set(rows) == {"near", "tie1", "tie2", "far", None}
    assert (rows["near"].name, rows["near"].charging_availability_id) == ("new", "A1")
    assert (rows["tie1"].brand, rows["tie1"].category, rows["tie2"].brand) == ("B", "c1", None)
    assert json.loads(rows["tie2"].raw_poi_json) == FIRST["results"][2]


def test_fact_levels_and_repeats(star):
    fact = star[3].fact
    assert fact.schema.simpleString() == struct(FACT_AVAILABILITY).simpleString()
    one = [("A1", "CCS", 50.0, 4, 1, None), ("A1", "CCS", 150.0, 4, 2, 3), ("A1", "Type2", None, None, 2, None), ("A1", "Schuko", None, 1, None, None)]
    got = [(r.charging_availability_id, r.connector_type, r.power_kw, r.total, r.available, r.occupied) for r in fact.collect()]
    assert sorted(map(str, got)) == sorted(map(str, one * 2))


def test_fact_dedupe(spark, star):
    _, searches, avail, _ = star
    asked = searches.selectExpr("'r' as region_code", "'r' as region", "request_key as h3_r7", "1 as degurba", "1D as request_point_lat",
                                "2D as request_point_lon", "3 as radius_m", "request_key as cand_ord", "body as poi_json")
    assert station_star(asked, avail, ntz(RUN), dedupe_fact=True).fact.count() == 4


def test_no_hits_give_empty_tables(spark, star):
    empty = star[1].withColumn("body", F.lit('{"results":[]}'))
    out = enrich_stations(star[0], empty, star[2], ntz(RUN))
    assert out.dim.isEmpty() and out.map.isEmpty() and out.fact.isEmpty()


def test_current_view(star):
    dim = star[3].dim
    later = dim.where("tomtom_poi_id = 'near'").withColumns({"name": F.lit("newest"), "updated_at": F.lit(NOW + dt.timedelta(days=1)).cast("timestamp_ntz")})
    now = current_stations(dim.unionByName(later))
    assert now.count() == 5 and now.where("tomtom_poi_id = 'near'").first().name == "newest"


def test_ties_within_a_run_go_to_the_row_met_last(star):
    dim = star[3].dim.where("tomtom_poi_id = 'near'")
    rows = [dim.withColumns({"cand_ord": F.lit(c), "rank_by_dist": F.lit(r), "name": F.lit(n), "raw_poi_json": F.lit(t)})
            for c, r, n, t in [(2, 1, "last", "a"), (1, 9, "rank", "z"), (2, 0, "text", "y")]]
    now = current_stations(rows[0].unionByName(rows[1]).unionByName(rows[2]))
    assert [r.name for r in now.collect()] == ["last"] and now.columns == dim.columns


def test_stations_from_a_table(spark, star):
    stations = spark.createDataFrame([("s1", 50.001, 19.0), ("s2", 50.02, 19.0), ("s3", 50.1, 19.0)], "sid string, station_lat double, station_lon double")
    rows = stations_near_candidates(star[0], stations, "sid").orderBy("rank_by_dist").collect()
    assert [(r.h3_r7, r.sid, r.rank_by_dist) for r in rows] == [("h1", "s1", 1), ("h1", "s2", 2)]


def test_station_envelopes_and_consumer(spark, star):
    cells, searches, avail, batch = star
    broken = searches.withColumn("http_status", F.when(F.col("request_key").startswith("51"), 403).otherwise(200)).withColumn(
        "body", F.when(F.col("http_status") == 200, F.col("body")))
    env = station_envelopes(candidate_requests(cells), broken, avail, "run", ntz(RUN))
    rows = {r.h3_r7: r for r in env.collect()}
    assert (rows["h2"].http_status, rows["h2"].poi_json, rows["h2"].availability_snapshots) == (403, None, [])
    snaps = rows["h1"].availability_snapshots
    assert [(s.chargingAvailabilityId, s.ok, s.status_code, s.error) for s in snaps] == [("A1", True, 200, None), ("A2", False, 403, "HTTP 403")]
    assert rows["h1"].snapshot_ts == "2026-01-01T10:00:00Z"
    # The message carries objects, and reads back the same either way.
    as_objects = event_values(env, ["poi_json"])
    assert json.loads(as_objects.where("value like '%h1%'").first().value)["poi_json"] == FIRST
    tables = station_tables(parse_envelopes(as_objects.select("value"), STATION_ENVELOPE), ntz(RUN))
    key = ["h3_r7", "tomtom_poi_id", "dist_m", "rank_by_dist"]
    want = {tuple(r) for r in batch.map.where("h3_r7 = 'h1'").select(*key).collect()}
    assert {tuple(r) for r in tables["map"].select(*key).collect()} == want
    assert tables["fact"].count() == 4


def test_candidates_that_share_a_search(spark, star):
    cells, searches, avail, _ = star
    shared = candidate_requests(cells).where("h3_r7 = 'h1'")
    twins = shared.unionByName(shared.withColumn("h3_r7", F.lit("twin")))
    rows = station_envelopes(twins, searches, avail, "run", ntz(RUN)).collect()
    assert [len(r.availability_snapshots) for r in rows] == [2, 2]
    assert len({r.event_id for r in rows}) == 2


FLOW = {"flowSegmentData": {"frc": "FRC3", "currentSpeed": 25, "freeFlowSpeed": "50.9", "currentTravelTime": 80.7, "freeFlowTravelTime": 40,
                            "confidence": 0.9, "roadClosure": False, "coordinates": {"coordinate": [
                                {"latitude": 50.0, "longitude": 19.0}, {"latitude": 50.5, "longitude": 19.25}]}}}


def road(feature, wkt="POINT(19.0 50.0)", degurba=1, near=True):
    return ("R1", "r", "h", degurba, 1.0, "scope", near, None, feature, "77", "primary", 50.0, 2.0, 10.0, wkt)


def roads(spark):
    rows = [road("a"), road("b", near=None), road("", "POINT(19.0 50.5)"), road("d", "POINT (19.0 50.0)"), road("e", "POINT(19.0 95.0)")]
    return spark.createDataFrame(rows, CANDIDATE_ROAD)


def flow_answers(spark):
    return spark.createDataFrame([("a", 200, None, json.dumps(FLOW)), ("b", 403, "x" * 900, None)], RESPONSE)


def test_traffic_fact(spark):
    fact = traffic_snapshot(roads(spark), flow_answers(spark), ntz(RUN), "run")
    assert fact.schema.simpleString() == struct(FACT_TRAFFIC).simpleString() and len(fact.columns) == 38
    rows = {r.request_point_key: r for r in fact.collect()}
    assert set(rows) == {"a", "b", "77"}
    a = rows["a"]
    assert (a.frc, a.current_speed, a.free_flow_speed, a.current_travel_time, a.free_flow_travel_time) == ("FRC3", 25, 50, 80, 40)
    assert (a.speed_ratio, a.delay_sec, a.delay_ratio, a.road_closure, a.confidence) == (0.5, 40, 2.0, False, 0.9)
    assert a.segment_linestring_wkt_4326 == "LINESTRING(19.0 50.0, 19.25 50.5)"
    assert json.loads(a.segment_coords_json) == FLOW["flowSegmentData"]["coordinates"]["coordinate"] and json.loads(a.raw_json) == FLOW
    b = rows["b"]
    assert (b.http_status, b.error_message, b.current_speed, b.segment_coords_json, b.raw_json) == (403, "x" * 800 + "…", None, "[]", None)
    assert rows["77"].http_status is None and rows["77"].snapshot_ts == NOW


def test_both_envelope_forms_give_the_batch_fact(spark):
    batch = traffic_snapshot(roads(spark), flow_answers(spark), ntz(RUN), "run").drop("error_message")
    for empty_object in (True, False):
        env = traffic_feed(roads(spark), flow_answers(spark), ntz(RUN), "run", "sql", empty_object)
        back = parse_envelopes(event_values(env, ["raw_json"]).select("value"), TRAFFIC_ENVELOPE)
        assert {tuple(r) for r in flow_fact(back, ntz(RUN)).drop("error_message", "raw_json", "segment_coords_json").collect()} == {
            tuple(r) for r in batch.drop("raw_json", "segment_coords_json").collect()}


def test_wkt_modes_of_the_road_scan(spark):
    assert traffic_feed(roads(spark), flow_answers(spark), ntz(RUN), "run", "lenient").count() == 4


def test_ratio(spark):
    df = spark.createDataFrame([(0, 50), (50, 0), (None, 50), (25, 50)], "a int, b int")
    assert [r[0] for r in df.select(ratio("a", "b")).collect()] == [None, None, None, 0.5]


def test_landing_checks(spark):
    sent = spark.createDataFrame([("e1",), ("e2",), ("e3",)], "event_id string")
    raw = spark.createDataFrame([('{"event_id":"e1"}',), ('{"EVENT_ID":"e2"}',), ('{"event_id":"e2"}',), ("{}",)], "t string")
    landed = L.landed_ids(raw.select(F.parse_json("t").alias("record_content")))
    assert tuple(L.reconcile(sent, landed).first()) == (3, 2, 1)
    assert [r.event_id for r in L.missing_events(sent, landed).collect()] == ["e3"]
    assert L.require_landed(sent.where("event_id <> 'e3'"), landed) == 2
    with pytest.raises(QualityError, match="e3"):
        L.require_landed(sent, landed)
    assert L.probe_landed(sent, landed) == 2
    with pytest.raises(QualityError):
        L.require_landed(sent, landed.where("false"))


def test_lookup_keeps_rows_without_a_key(spark):
    left = spark.createDataFrame([(1, "a"), (2, None), (3, "a"), (4, "z")], "i int, k string")
    right = spark.createDataFrame([("a", 200)], "request_key string, http_status int")
    assert {(r.i, r.http_status) for r in L.left_lookup(left, right, "k").collect()} == {(1, 200), (2, None), (3, 200), (4, None)}


def test_envelope_files_are_packed(spark, tmp_path, monkeypatch):
    """The landed envelopes take a small part of their text on disk, and none is lost."""
    from voltatlas.queries import stations

    orders = spark.range(1, 201).selectExpr("id as o_orderkey", "id * 7 % 50 as o_custkey", "'O' as o_orderstatus", "'5-LOW' as o_orderpriority")
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    customers = spark.range(1, 98).selectExpr("id as c_custkey", "cast(id % 25 as int) as c_nationkey")
    customers.write.parquet(str(tmp_path / "customer.parquet"))
    made = []
    folder = lambda _, purpose: str(tmp_path / (f"progress-{len(made)}" if made.append(purpose) or purpose == "progress" else purpose))
    monkeypatch.setattr(stations, "scratch_dir", folder)
    stations.station_stream_tables(spark, str(tmp_path)).collect()
    for name in ("envelopes", "envelopes-again"):
        text = spark.read.text(str(tmp_path / name))
        held = sum(f.stat().st_size for f in (tmp_path / name).glob("part-*"))
        assert text.count() == 200
        assert 3 * held < text.selectExpr("sum(octet_length(value))").first()[0]


def test_envelopes_land_in_files_of_bounded_rows_and_batches_are_not_persisted(spark, tmp_path, monkeypatch):
    """More rows are more files, a search answer is shuffled once to be put into its envelope, and nothing staged is left."""
    from pyspark.sql.classic.dataframe import DataFrame

    from voltatlas.queries import stations

    orders = spark.range(1, 201).selectExpr("id as o_orderkey", "id * 7 % 50 as o_custkey", "'O' as o_orderstatus", "'5-LOW' as o_orderpriority")
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    customers = spark.range(1, 98).selectExpr("id as c_custkey", "cast(id % 25 as int) as c_nationkey")
    customers.write.parquet(str(tmp_path / "customer.parquet"))
    made = []
    folder = lambda _, purpose: str(tmp_path / (f"progress-{len(made)}" if made.append(purpose) or purpose == "progress" else purpose))
    monkeypatch.setattr(stations, "scratch_dir", folder)
    monkeypatch.setattr(stations, "FILE_ROWS", 10, raising=False)
    persisted, persist = [], DataFrame.persist
    monkeypatch.setattr(DataFrame, "persist", lambda self, *a: persisted.append(1) or persist(self, *a))
    wanted = {r.tomtom_poi_id for r in stations._star(spark, str(tmp_path)).dim.collect()}
    got = [r.tomtom_poi_id for r in stations.station_stream_tables(spark, str(tmp_path)).collect()]
    assert len(got) == len(set(got)) > 40 and set(got) <= wanted
    for name in ("envelopes", "envelopes-again"):
        assert len(list((tmp_path / name).glob("part-*"))) >= 20
    assert spark.read.parquet(str(tmp_path / "stations/events")).count() == 200
    assert not list((tmp_path / "stations").glob("_staged*"))
    assert not persisted
