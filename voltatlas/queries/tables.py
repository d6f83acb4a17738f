"""Schema alignment, appends, partitions and landing files."""

from __future__ import annotations

from pyspark.sql import functions as F

from voltatlas.functions.timestamps import ntz
from voltatlas.operators.align import align, lower_columns
from voltatlas.operators.quality import file_profile
from voltatlas.queries.registry import RUN_TS, query, table
from voltatlas.session import scratch_dir
from voltatlas.sinks.files import append_table, event_values, read_evolving, write_batches, write_event_files, write_partitions
from voltatlas.sinks.profiles import merged_profile, write_profiled
from voltatlas.sources.tables import read_batch_files

_TARGET = (
    "load_ts timestamp_ntz, o_orderkey bigint, lanes double, o_totalprice double, near boolean, note string"
)


@query(
    """
select case o_orderkey % 3 when 0 then o_orderdate when 1 then null else o_orderdate + interval 1 second end as load_ts,
       o_orderkey, cast(null as double) as lanes, o_totalprice, cast(null as boolean) as near, o_orderpriority as note
from orders
"""
)
def align_to_target(spark, sf):
    us = "unix_micros(timestamp(o_orderdate))"
    wide = table(spark, sf, "orders").selectExpr(
        "o_orderpriority as NOTE", "string(o_orderkey) as O_OrderKey", "o_totalprice as O_TOTALPRICE", "o_custkey as EXTRA",
        f"""case o_orderkey % 3 when 0 then date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss') when 1 then 'never'
            else '(seconds_since_epoch=' || string({us} * 1000 + 1000000000) || ', nanos=0)' end as LOAD_TS""",
    )
    return align(lower_columns(wide), _TARGET)


_FIRST = "o_orderkey bigint, o_totalprice double, load_ts timestamp_ntz"
_MORE = "o_orderpriority string"


@query(
    f"""
select o_orderkey, o_totalprice,
       case when o_orderstatus = 'F' then timestamp '{RUN_TS}' when o_custkey % 2 = 0 then o_orderdate + interval 10 year
            else timestamp '{RUN_TS}' end as load_ts,
       case when o_orderstatus <> 'F' then o_orderpriority end as o_orderpriority
from (select *, o_orderdate + interval 10 year as shifted from orders)
"""
    .replace("when o_custkey % 2 = 0 then o_orderdate + interval 10 year",
             f"when o_custkey % 2 = 0 and shifted between timestamp '2000-01-01' and timestamp '{RUN_TS}' + interval 1 day then shifted")
)
def append_evolve(spark, sf):
    """Two loads into one table; the second has one column more and doubtful dates."""
    folder = scratch_dir(spark, "append")
    orders = table(spark, sf, "orders")
    now = ntz(RUN_TS)
    first = orders.where("o_orderstatus = 'F'").withColumn("load_ts", F.lit(None).cast("timestamp_ntz"))
    append_table(first, folder, _FIRST, now, ["load_ts"])
    shifted = F.expr("case when o_custkey % 2 = 0 then cast(o_orderdate as timestamp_ntz) + interval 10 year "
                     "else timestamp_ntz'1999-01-01 00:00:00' end")  # fmt: skip
    second = orders.where("o_orderstatus <> 'F'").withColumn("load_ts", shifted)
    append_table(second, folder, f"{_FIRST}, {_MORE}", now, ["load_ts"])
    append_table(second.where("false"), folder, _FIRST, now, ["load_ts"])
    return read_evolving(spark, folder, _FIRST, _MORE)


@query(
    """
select o_orderkey, o_totalprice, case when o_orderstatus <> 'F' then o_orderpriority end as o_orderpriority,
       case when o_orderstatus = 'P' then o_custkey end as o_custkey
from orders
"""
)
def schema_log(spark, sf):
    """One load per status, two with a column more than before; the reader finds the schema in the table's log."""
    folder, orders = scratch_dir(spark, "logged"), table(spark, sf, "orders")
    names = ["o_orderkey", "o_totalprice", "o_orderpriority", "o_custkey"]
    for status, n in (("F", 2), ("O", 3), ("P", 4)):
        load = orders.where(F.col("o_orderstatus") == status).select(*names[:n])
        append_table(load, folder, load.schema, ntz(RUN_TS), [])
    return read_evolving(spark, folder)


@query(
    """
select o_orderkey, o_orderstatus as status, case when o_orderstatus = 'F' then o_totalprice else o_custkey end as amount
from orders
"""
)
def partition_roundtrip(spark, sf):
    """Write by status, write one status again with other values, read back."""
    folder = scratch_dir(spark, "partitions")
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"), "o_totalprice", "o_custkey")
    write_partitions(orders.selectExpr("o_orderkey", "status", "double(o_custkey) as amount"), folder, ["status"])
    again = orders.where("status = 'F'").selectExpr("o_orderkey", "status", "o_totalprice as amount")
    write_partitions(again, folder, ["status"])
    return spark.read.schema("o_orderkey bigint, amount double, status string").parquet(folder)


@query("select o_orderkey, o_totalprice from orders")
def batch_file_scan(spark, sf):
    """Fact rows to JSON landing files per batch, and the files to one table."""
    folder = scratch_dir(spark, "landing")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", F.col("o_orderstatus").alias("batch_id"))
    write_batches(orders.withColumn("run_id", F.lit("run-1")), folder)
    schema = "o_orderkey bigint, o_totalprice double"
    return read_batch_files(spark, [f"{folder}/run_id=run-1/batch_id=*"], schema, multi_line=False)


@query("select count(*) as rows, true as has_bytes from orders")
def written_profile(spark, sf):
    """Rows and bytes of a table written by status."""
    folder = scratch_dir(spark, "profile")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", F.col("o_orderstatus").alias("status"))
    write_partitions(orders, folder, ["status"])
    return file_profile(spark, folder).select("rows", (F.col("bytes") > 0).alias("has_bytes"))


_PROFILED = {"o_orderkey": "bigint", "o_totalprice": "double", "o_orderpriority": "string", "clerk": "bigint"}


@query(
    "with o as (select *, case when o_orderstatus = 'F' then o_custkey end as clerk from orders where year(o_orderdate) <= 1997)\n"
    + "\nunion all\n".join(
        f"select {i + 1} as position, '{c}' as column_name, '{t}' as data_type, count(*) as rows, count({c}) as non_null, "
        f"cast(min({c}) as varchar) as least, cast(max({c}) as varchar) as most, "
        f"case when '{c}' = 'o_orderpriority' then count(distinct {c}) end as about_distinct, true as near from o"
        for i, (c, t) in enumerate(_PROFILED.items())
    )
)
def merged_profiles(spark, sf):
    """Orders by year with statistics a year, one year written again; those up to 1997 merged, the numbers of values within 5%."""
    folder, orders = scratch_dir(spark, "profiled"), table(spark, sf, "orders")
    rows = orders.select("o_orderkey", "o_totalprice", "o_orderpriority", F.expr("case when o_orderstatus = 'F' then o_custkey end as clerk"),
                         F.expr("year(o_orderdate) as dt"))
    write_profiled(rows.withColumn("o_totalprice", F.when(F.col("dt") == 1995, -1.0).otherwise(F.col("o_totalprice"))), folder, "dt")
    write_profiled(rows.where("dt = 1995"), folder, "dt")
    merged = merged_profile(spark, folder, "dt", F.col("dt") <= 1997)
    exact = rows.where("dt <= 1997").agg(*[F.count_distinct(c).alias(c) for c in _PROFILED])
    exact = exact.select(F.explode(F.create_map(*[x for c in _PROFILED for x in (F.lit(c), F.col(c))])).alias("column_name", "exact"))
    near = F.abs(F.col("about_distinct") - F.col("exact")) <= 0.05 * F.col("exact")
    both = merged.join(exact, "column_name").withColumn("near", near).drop("exact")
    return both.withColumn("about_distinct", F.when(F.col("column_name") == "o_orderpriority", F.col("about_distinct")))


@query(
    """
select cast(event_id as varchar) as event_id, event_type, cast(value as varchar) as value,
       cast(json_extract_string(props, '$.k') as int) as k
from events
"""
)
def message_values(spark, sf):
    """Events as message values, written as text and read back."""
    folder = scratch_dir(spark, "messages")
    events = table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("event_id"), F.lit("run-1").alias("run_id"), F.lit("TOMTOM").alias("source"),
        "event_type", "value", "props",
    )
    write_event_files(event_values(events, nested=["props"]), folder)
    schema = "event_id string, event_type string, value string, props struct<k:int>"
    return spark.read.schema(schema).json(folder).select("event_id", "event_type", "value", F.col("props.k").alias("k"))
