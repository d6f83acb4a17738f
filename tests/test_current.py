"""Current table by merge-on-read, schema log, and the streamed landing check."""

import pytest
from pyspark.sql import functions as F

from voltatlas.sinks.current import CurrentTable
from voltatlas.sinks.files import append_table, log_schema, logged_schema, read_evolving, schema_versions
from voltatlas.streaming.landing import landing_verdicts, settled, write_verdicts
from voltatlas.functions.timestamps import ntz

DDL = "k string, at int, v string"


@pytest.fixture
def current(tmp_path):
    return CurrentTable(str(tmp_path / "t"), DDL, ["k"], ["at", "v"], buckets=4, most_deltas=3)


def rows(spark, *found):
    return spark.createDataFrame(list(found), DDL)


def state(current, spark):
    return sorted(tuple(r) for r in current.read(spark).collect())


def test_newest_rows_over_runs(spark, current):
    assert state(current, spark) == []
    history = []
    for n in range(7):
        new = [(f"k{(n * 5 + j) % 11}", n - j % 2, f"v{n}{j}") for j in range(5)] + [("k0", 3, f"tie{n}")]
        history += new
        assert current.add(rows(spark, *new), f"run-{n}")
        assert not current.add(rows(spark, ("k1", 99, "again")), f"run-{n}")
        want = {}
        for k, at, v in history:
            want[k] = max(want.get(k, (at, v)), (at, v))
        assert state(current, spark) == sorted((k, *w) for k, w in want.items())
    assert len(current.state(spark)[1]) < 3


def test_compaction_rewrites_touched_buckets_only(spark, current):
    current.add(rows(spark, *[(f"k{j}", 1, "a") for j in range(40)]), "first")
    assert current.compact(spark) == [0, 1, 2, 3] and current.compact(spark) == []
    before = current.state(spark)[0]
    current.add(rows(spark, ("k7", 2, "b")), "second")
    plan = current.read(spark)._jdf.queryExecution().executedPlan().toString()
    assert "Union" in plan  # untouched buckets are scanned beside those that are merged
    (bucket,) = current.compact(spark)
    after = current.state(spark)[0]
    assert {b for b in before if before[b] != after[b]} == {bucket}
    assert ("k7", 2, "b") in state(current, spark) and len(state(current, spark)) == 40


def test_null_keys_empty_runs_and_a_reader_that_has_begun(spark, current):
    current.add(rows(spark, (None, 1, "a"), (None, None, "z"), ("x", None, None)), "one")
    begun = current.read(spark)
    current.add(rows(spark), "empty")
    assert not current.add(rows(spark, ("x", 5, "no")), "empty")
    current.add(rows(spark, (None, 2, None)), "two")
    current.compact(spark)
    assert {tuple(r) for r in begun.collect()} == {(None, 1, "a"), ("x", None, None)}
    assert {tuple(r) for r in current.read(spark).collect()} == {(None, 2, None), ("x", None, None)}


def test_schema_log(spark, tmp_path):
    path = str(tmp_path / "t")
    assert logged_schema(spark, path) is None
    with pytest.raises(ValueError, match="no schema"):
        read_evolving(spark, path)
    load = lambda ddl, *found: append_table(spark.createDataFrame(list(found), ddl), path, ddl, ntz("2026-01-01 00:00:00"), [])
    load("id int", (1,))
    load("id int, Note string", (2, "n"))
    load("id int", (3,))
    load("note string, id int, day date", ("m", 4, None))
    load("id int, other string")
    assert [r.version for r in schema_versions(spark, path).orderBy("version").collect()] == [1, 2, 3]
    assert [tuple(r) for r in read_evolving(spark, path).orderBy("id").collect()] == [(1, None, None), (2, "n", None), (3, None, None), (4, "m", None)]
    assert read_evolving(spark, path, version=1).columns == ["id"]
    with pytest.raises(ValueError, match="id: int, not string"):
        log_schema(spark, path, "id string")


def test_landing_verdicts(spark, tmp_path):
    sent, landed, out, progress = (str(tmp_path / n) for n in ("sent", "landed", "out", "progress"))

    def run(sends, lands):
        for found, path, ts in ((sends, sent, "sent_ts"), (lands, landed, "landed_ts")):
            df = spark.createDataFrame(found, "event_id string, ts string").select("event_id", F.to_timestamp("ts").alias(ts))
            df.coalesce(1).write.mode("append").parquet(path)
        feed = lambda path, ts: spark.readStream.schema(f"event_id string, {ts} timestamp").parquet(path)
        write_verdicts(landing_verdicts(feed(sent, "sent_ts"), feed(landed, "landed_ts")), out, progress).awaitTermination()
        return {r.event_id: r.state for r in settled(spark.read.parquet(out)).collect()}

    at = lambda clock: f"2026-01-01 {clock}:00"
    first = run([("a", at("10:00")), ("b", at("10:05")), ("c", at("10:06")), ("d", at("10:07"))], [("a", at("10:01")), ("a", at("10:02")), ("x", at("10:03"))])
    assert first == {"a": "landed"}  # the others may still come
    second = run([("e", at("12:00"))], [("b", at("10:50")), ("a", at("11:30")), ("c", at("12:10"))])
    assert second["b"] == "landed" and "e" not in second
    third = run([(None, at("18:00"))], [(None, at("18:00"))])
    assert third == {"a": "landed", "b": "landed", "c": "late", "d": "missing", "e": "missing", "x": "unasked"}
