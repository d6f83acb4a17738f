import json

from voltatlas.functions.timestamps import ntz
from voltatlas.sources.tables import parse_envelopes, read_envelopes, unreadable_messages
from voltatlas.specs import STATION_ENVELOPE, TRAFFIC_ENVELOPE
from voltatlas.streaming.envelopes import append_once, dedupe_within, traffic_rows, unlanded, write_stations

RUN = "2026-01-01 10:00:00"


def envelope(i, ts="2026-01-01T09:00:00Z", **kw):
    return json.dumps({"event_id": f"e{i}", "run_id": "r", "snapshot_ts": ts, "request_point_key": f"k{i}", "request_point_lat": 50.0,
                       "request_point_lon": 19.0, "http_status": 200, **kw})


def start(spark, src, out, cp):
    stream = read_envelopes(spark, src, TRAFFIC_ENVELOPE)
    fact = lambda b: traffic_rows(b, ntz(RUN), ["event_id", "event_date"])
    append_once(stream, out, cp, ["event_id"], fact).awaitTermination()


def test_append_once_over_runs_late_rows_and_replays(spark, tmp_path):
    src, out = tmp_path / "in", str(tmp_path / "out")
    src.mkdir()
    (src / "1.json").write_text("\n".join([envelope(1), envelope(1), envelope(2, "2026-01-03T00:00:00Z"), "not json"]))
    start(spark, str(src), out, str(tmp_path / "cp"))
    # Later: repeats of old events, and an event days behind everything seen.
    (src / "2.json").write_text("\n".join([envelope(1), envelope(3, "2025-12-01T00:00:00Z"), envelope(4, "no time")]))
    start(spark, str(src), out, str(tmp_path / "cp"))
    rows = spark.read.parquet(out).collect()
    assert sorted(r.event_id for r in rows) == ["e1", "e2", "e3", "e4"]
    # The same files again from the beginning, with fresh progress, in another order of batches.
    start(spark, str(src), out, str(tmp_path / "cp2"))
    assert sorted(r.event_id for r in spark.read.parquet(out).collect()) == ["e1", "e2", "e3", "e4"]


def test_micro_batch_is_written_in_bounded_parts(spark, tmp_path, monkeypatch):
    """Rows of one date are dealt to several tasks when they are many; the setting stays within the stream."""
    from voltatlas.streaming import envelopes

    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before, src = spark.conf.get(name), tmp_path / "in"
    monkeypatch.setattr(envelopes, "TASK_BYTES", 1 << 20, raising=False)
    spark.range(200_000).selectExpr("""'{"event_id":"' || sha(string(id)) || '"}' as value""").repartition(8).write.text(str(src))
    append_once(read_envelopes(spark, str(src), TRAFFIC_ENVELOPE), str(tmp_path / "out"), str(tmp_path / "cp"), ["event_id"]).awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.select("event_id").distinct().count() == out.count() == 200_000
    assert len(out.inputFiles()) > 1 and spark.conf.get(name) == before


def test_watermark_dedupe(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "1.json").write_text("\n".join([envelope(1), envelope(1), envelope(2)]))
    q = (
        dedupe_within(read_envelopes(spark, str(src), TRAFFIC_ENVELOPE), ["event_id"])
        .writeStream.format("memory").queryName("dd").trigger(availableNow=True).start()
    )
    q.awaitTermination()
    assert spark.table("dd").count() == 2


def test_window_query_keeps_late_events(spark, monkeypatch):
    """Several micro-batches: events behind the watermark come through too, each once."""
    from voltatlas.queries import streams

    monkeypatch.setattr(streams, "read_envelopes", lambda s, path, schema, files_per_trigger=1: read_envelopes(s, path, schema, 1))
    sf = "/root/testdata/sf0.001"
    got = sorted(r.event_id for r in streams.stream_dedupe_window(spark, sf).collect())
    assert got == sorted(f"e{r.event_id}" for r in spark.read.parquet(f"{sf}/events.parquet").select("event_id").collect())


def test_batch_and_stream_agree(spark, tmp_path):
    src, out = tmp_path / "in", str(tmp_path / "out")
    src.mkdir()
    raw = {"flowSegmentData": {"currentSpeed": 10, "freeFlowSpeed": 40}}
    lines = [envelope(1, raw_json=raw), envelope(2, raw_json=json.dumps(raw)), envelope(3, raw_json={}), envelope(4, raw_json=None)]
    (src / "1.json").write_text("\n".join(lines))
    start(spark, str(src), out, str(tmp_path / "cp"))
    batch = traffic_rows(spark.read.schema(TRAFFIC_ENVELOPE).json(str(src)), ntz(RUN), ["event_id"])
    cols = ["event_id", "current_speed", "speed_ratio", "load_ts"]
    got = {tuple(r) for r in spark.read.parquet(out).select(*cols).collect()}
    assert got == {tuple(r) for r in batch.select(*cols).collect()}
    assert {r[0]: r[2] for r in got} == {"e1": 0.25, "e2": 0.25, "e3": None, "e4": None}


def test_station_consumer(spark, tmp_path):
    src, out = tmp_path / "in", str(tmp_path / "out")
    src.mkdir()
    poi = {"results": [{"id": "p1", "dist": 3.0}, {"id": "p2", "dist": 1.0}]}
    snap = {"chargingAvailabilityId": "A", "ok": True, "status_code": 200, "error": None,
            "avail_json": {"connectors": [{"type": "CCS", "availability": {"current": {"available": 1}}}]}}
    bad = {**snap, "ok": False, "avail_json": None}
    line = envelope(1, region_code="R", h3_r7="h", degurba=1, radius_m=3000, poi_json=poi, availability_snapshots=[snap, bad])
    (src / "1.json").write_text(line + "\n" + line)
    stream = read_envelopes(spark, str(src), STATION_ENVELOPE)
    write_stations(stream, out, str(tmp_path / "cp"), lambda: ntz(RUN)).awaitTermination()
    ranks = {(r.tomtom_poi_id, r.rank_by_dist) for r in spark.read.parquet(f"{out}/map").collect()}
    assert ranks == {("p2", 1), ("p1", 2)}
    assert spark.read.parquet(f"{out}/dim").count() == 2
    assert [(r.charging_availability_id, r.available) for r in spark.read.parquet(f"{out}/fact").collect()] == [("A", 1)]


def test_unreadable_messages(spark):
    df = spark.createDataFrame([(envelope(1),), ("not json",), ("{}",), (None,)], "value string")
    assert parse_envelopes(df, TRAFFIC_ENVELOPE).count() == 1
    assert {r.value for r in unreadable_messages(df).collect()} == {"not json", "{}", None}


def test_unlanded(spark):
    sent = spark.createDataFrame([("e1",), ("e2",)], "event_id string")
    landing = spark.sql("""select parse_json('{"event_id":"e1"}') as record_content""")
    assert [r.event_id for r in unlanded(sent, landing).collect()] == ["e2"]
