"""The key index: what it knows, what it opens, merging, and micro-batches run again."""

import pytest
from pyspark.sql import functions as F

from voltatlas.streaming.keyindex import KeyIndex


@pytest.fixture
def index(tmp_path):
    return KeyIndex(str(tmp_path / "keys"), ["k", "day"], buckets=8, fan_in=2)


def keys(spark, lo, hi, step=1):
    return spark.range(lo, hi, step).select(F.concat(F.lit("e"), F.col("id").cast("string")).alias("k"), (F.col("id") % 5).cast("int").alias("day"))


def found(df):
    return set() if df is None else {int(r.k[1:]) for r in df.collect()}


def test_known_keys_and_merging(spark, index):
    assert index.known(keys(spark, 0, 10), "x") is None
    for n in range(5):
        index.compact(spark)
        assert found(index.known(keys(spark, 50 * n - 20, 50 * n + 50), f"b{n}")) == set(range(max(0, 50 * n - 20), 50 * n))
        index.add(keys(spark, 50 * n, 50 * n + 50), f"b{n}")
    runs = index.runs(spark)
    assert sorted(runs.values()) == [0, 1, 1] and all(r.startswith("merged-") == (at == 1) for r, at in runs.items())
    assert found(index.known(keys(spark, 0, 400, 7), "y")) == set(range(0, 250, 7))


def test_only_buckets_with_hits_are_opened(spark, index):
    index.add(keys(spark, 0, 4000), "a")
    assert found(index.known(keys(spark, 10_000, 10_400), "b")) == set()
    # 400 new keys: few false hits, so few of the eight buckets; a single repeat opens one.
    assert index.there == 8
    assert found(index.known(keys(spark, 17, 18), "b")) == {17} and index.opened == 1
    index.known(keys(spark, 50_000, 50_003), "b")
    assert index.opened <= 1


def test_a_micro_batch_run_again_does_not_meet_its_own_keys(spark, index):
    index.add(keys(spark, 0, 30), "a")
    index.add(keys(spark, 30, 60), "b")
    assert found(index.known(keys(spark, 20, 60), "b")) == set(range(20, 30))
    index.add(keys(spark, 30, 70), "b")
    assert found(index.known(keys(spark, 0, 100), "c")) == set(range(70))
    # Even after its run has been merged by another feed.
    index.compact(spark)
    assert list(index.runs(spark).values()) == [1]
    assert found(index.known(keys(spark, 0, 100), "b")) == set(range(30))


def test_no_keys_make_no_run(spark, index):
    index.add(keys(spark, 0, 0), "a")
    assert index.runs(spark) == {} and index.known(keys(spark, 0, 5), "b") is None
