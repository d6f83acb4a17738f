import random

import pytest
from pyspark.sql import functions as F

from voltatlas.operators.numbering import assign_batches, batch_ranges, number_rows
from voltatlas.operators.ranking import debug_rows, last_per_key, rank_by_distance, top_per_group


@pytest.mark.parametrize("ranges", [1, 20])
def test_batches_cover_every_row_once(spark, ranges):
    df = spark.range(0, 5000, 7).repartition(8)
    n = df.count()
    rows = assign_batches(df, [F.col("id")], 50, ranges).orderBy("id").collect()
    assert [r.row_index for r in rows] == list(range(n))
    assert [r.batch_id for r in rows] == [i // 50 + 1 for i in range(n)]
    ranges = batch_ranges(assign_batches(df, [F.col("id")], 50, ranges)).orderBy("batch_id").collect()
    assert [(r.start_idx, r.end_idx) for r in ranges] == [(s, min(n, s + 50)) for s in range(0, n, 50)]


@pytest.mark.parametrize("ranges", [1, 23])
def test_ranks_with_a_hot_group_and_ties(spark, ranges):
    rng = random.Random(1)
    rows = []
    for i in range(900):
        g = "hot" if i % 3 == 0 else rng.choice(["a", "b", None, "c\"d"]) if i % 3 == 1 else f"g{i}"
        rows.append((g, rng.choice([None, 1.0, 2.5, 2.5, -3.0]), i))
    df = spark.createDataFrame(rows, "g string, d double, pos long").repartition(5)
    got = rank_by_distance(df, ["g"], "d", ["pos"], None, ranges=ranges).collect()
    assert len(got) == len(rows)
    want = {}
    for g in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == g), key=lambda r: (r[1] is None, r[1] or 0, r[2]))
        want.update({r[2]: n + 1 for n, r in enumerate(mine)})
    assert {r.pos: r.rank_by_dist for r in got} == want


def test_string_and_time_keys(spark):
    df = spark.range(300).selectExpr("id", "'k' || (id % 7) as g", "timestamp_micros(id * 1000003) as t")
    got = number_rows(df, [F.col("t"), F.col("id")], ["g"], ranges=13).collect()
    assert {r.id: r.row_number for r in got} == {i: i // 7 + 1 for i in range(300)}


def test_nothing_to_number(spark):
    assert number_rows(spark.range(0), [F.col("id")], ["id"]).count() == 0
    assert number_rows(spark.range(0), [F.col("id")]).count() == 0


def test_many_small_groups_and_one_range_shuffle(spark):
    """Groups cut by a range's end go on counting; the rows come from the written table, in which no input is read again."""
    df = spark.range(20_000).selectExpr("id", "id div 3 as g")
    numbered = number_rows(df, [F.col("id")], ["g"], ranges=17)
    assert numbered.where("row_number <> id % 3 + 1").count() == 0
    plan = numbered._jdf.queryExecution().optimizedPlan().toString()
    assert "Range (" not in plan and "Window" in plan and plan.count("Window") <= 2


@pytest.mark.parametrize("n", [3, 1200])
def test_top_per_group(spark, n):
    df = spark.range(6000).selectExpr("id", "id % 2 as g", "(id * 7919) % 1000 as v")
    got = {(r.g, r.id, r.rn) for r in top_per_group(df, ["g"], [F.desc("v"), F.asc("id")], n).collect()}
    want = set()
    for g in (0, 1):
        mine = sorted((i for i in range(6000) if i % 2 == g), key=lambda i: (-((i * 7919) % 1000), i))
        want |= {(g, i, k + 1) for k, i in enumerate(mine[:n])}
    assert got == want


def test_last_per_key_keeps_one_null(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 2, 1), ("a", 2, 3), (None, 5, 1), (None, 4, 9)], "k string, c int, r int")
    assert {tuple(r) for r in last_per_key(df, ["k"], ["c", "r"]).collect()} == {("a", 2, 3), (None, 5, 1)}


def test_debug_rows(spark):
    df = spark.range(100)
    assert debug_rows(df, ["id"], 0).count() == 1
    assert debug_rows(df, ["id"], 10).count() == 10
    assert debug_rows(df, ["id"], 10, enabled=False).count() == 100
