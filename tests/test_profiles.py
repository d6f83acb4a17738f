"""Statistics kept beside a table."""

import pytest
from pyspark.sql import functions as F

from voltatlas.session import scratch_dir
from voltatlas.sinks.files import write_partitions
from voltatlas.sinks.profiles import merged_profile, refresh, stale_partitions, write_profiled

SCHEMA = "k long, s string, b boolean, a array<int>, m map<string,int>, dt string"


def rows(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def facts(df):
    return {r.column_name: (r.rows, r.non_null, r.least, r.most, r.about_distinct) for r in df.collect()}


def test_merged_over_partitions(spark):
    path = scratch_dir(spark, "t")
    first = [(9, "x", True, [2], {"a": 1}, "1"), (10, None, None, None, None, "1"), (None, "y", False, [1, 5], {"a": 1}, None)]
    write_profiled(rows(spark, first), path, "dt")
    write_profiled(rows(spark, [(100, "z", True, None, None, "2")] * 50), path, "dt")
    got = facts(merged_profile(spark, path, "dt"))
    assert got["k"] == (53, 52, "9", "100", 3)
    assert got["s"] == (53, 52, "x", "z", 3)
    assert got["b"] == (53, 52, "false", "true", 2)
    assert got["a"] == (53, 2, "[1, 5]", "[2]", 2)
    assert got["m"] == (53, 2, None, None, 1)
    assert facts(merged_profile(spark, path, "dt", F.col("dt") == "1"))["k"] == (2, 2, "9", "10", 2)
    assert facts(merged_profile(spark, path, "dt", F.lit(False)))["k"] == (0, 0, None, None, 0)


def test_partition_written_again(spark):
    path = scratch_dir(spark, "t")
    write_profiled(rows(spark, [(1, "x", None, None, None, "1"), (2, "x", None, None, None, "2")]), path, "dt")
    write_profiled(rows(spark, [(7, "q", None, None, None, "2")] * 3), path, "dt")
    assert facts(merged_profile(spark, path, "dt"))["k"] == (4, 4, "1", "7", 2)


def test_statistics_out_of_date(spark):
    """A table written without statistics, then one partition rewritten without them."""
    path, schema = scratch_dir(spark, "t"), rows(spark, []).schema
    write_partitions(rows(spark, [(1, "x", None, None, None, "1"), (2, "x", None, None, None, None)]), path, ["dt"])
    assert refresh(spark, path, "dt", schema) == 2
    write_partitions(rows(spark, [(5, "x", None, None, None, "1")]), path, ["dt"])
    assert [r.dt for r in stale_partitions(spark, path, "dt", schema).collect()] == ["1"]
    assert refresh(spark, path, "dt", schema) == 1 and refresh(spark, path, "dt", schema) == 0
    assert facts(merged_profile(spark, path, "dt"))["k"] == (2, 2, "2", "5", 2)


def test_later_columns_and_nothing_written(spark):
    path = scratch_dir(spark, "t")
    with pytest.raises(ValueError):
        merged_profile(spark, path, "dt")
    write_profiled(spark.createDataFrame([(1, "1")], "k long, dt string"), path, "dt")
    write_profiled(spark.createDataFrame([(3, 2.5, "2")], "k long, extra double, dt string"), path, "dt")
    got = facts(merged_profile(spark, path, "dt"))
    assert got["k"] == (2, 2, "1", "3", 2) and got["extra"] == (2, 1, "2.5", "2.5", 1)


def test_merging_reads_no_table(spark):
    path = scratch_dir(spark, "t")
    write_profiled(rows(spark, [(1, "x", None, None, None, "1")]), path, "dt")
    plan = merged_profile(spark, path, "dt")._jdf.queryExecution().optimizedPlan().toString()
    assert "_metadata" not in plan and plan.count("Relation [") == 1
