"""Cube decoding and snapshots."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from voltatlas.functions.timestamps import ntz
from voltatlas.operators.cube import decode_flat_index, encode_flat_index, tidy_cube
from voltatlas.queries.registry import RUN_TS, query, table
from voltatlas.session import scratch_dir
from voltatlas.sinks.files import write_snapshot
from voltatlas.sources.cube import CubeDimension
from voltatlas.sources.tables import latest_partition, read_latest_snapshot


def _dimensions(spark, sf) -> list[CubeDimension]:
    nation = table(spark, sf, "nation").select(F.col("n_nationkey").alias("idx"), F.col("n_name").alias("code"))
    region = table(spark, sf, "region").select(F.col("r_regionkey").alias("idx"), F.col("r_name").alias("code"))
    kinds = table(spark, sf, "events").select(F.col("event_type").alias("code")).distinct()
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("code")) - 1
    kinds = kinds.select(place.alias("idx"), "code")
    return [
        CubeDimension("geo", nation.count(), nation),
        CubeDimension("area", region.count(), region),
        CubeDimension("kind", kinds.count(), kinds),
    ]


_CODES = """
kinds as (select event_type as code, row_number() over (order by event_type) - 1 as idx
          from (select distinct event_type from events)),
sizes as (select (select count(*) from nation) as ng, (select count(*) from region) as na,
                 (select count(*) from kinds) as nk),
placed as (
  select event_id, value, event_id // (na * nk) % ng as ig, event_id // nk % na as ia, event_id % nk as ik
  from events, sizes)
"""


@query(
    f"""
with {_CODES}
select 'cube' as dataset, n.n_name as geo, r.r_name as area, k.code as kind, value,
       timestamp '{RUN_TS}' as ingest_ts, event_id
from placed p join nation n on n.n_nationkey = p.ig join region r on r.r_regionkey = p.ia join kinds k on k.idx = p.ik
"""
)
def cube_decode(spark, sf):
    values = table(spark, sf, "events").select(F.col("event_id").alias("flat_index"), "value", "event_id")
    return tidy_cube(values, _dimensions(spark, sf), "cube", ntz(RUN_TS), ["event_id"])


@query("select l_orderkey, l_orderkey // 24 % 2 as i0, l_orderkey // 8 % 3 as i1, l_orderkey % 8 as i2, "
       "l_orderkey % 48 as again from lineitem")  # fmt: skip
def flat_index_roundtrip(spark, sf):
    sizes = [2, 3, 8]
    lines = table(spark, sf, "lineitem").select("l_orderkey")
    placed = lines.withColumns({f"i{n}": p for n, p in enumerate(decode_flat_index("l_orderkey", sizes))})
    return placed.withColumn("again", encode_flat_index([F.col(f"i{n}") for n in range(3)], sizes))


@query("select event_id, user_id, value from events where cast(ts as date) = (select max(cast(ts as date)) from events)")
def latest_snapshot(spark, sf):
    events = table(spark, sf, "events").withColumn("snapshot", F.to_date("ts"))
    return latest_partition(events, "snapshot").select("event_id", "user_id", "value")


@query("select o_orderkey, o_totalprice, '2024-02-01T00-00-00Z' as snapshot from orders")
def snapshot_roundtrip(spark, sf):
    """Two immutable snapshots; the newest one is read."""
    folder = scratch_dir(spark, "snapshots")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    write_snapshot(orders.where("o_orderstatus = 'F'"), folder, "2024-01-01T00-00-00Z")
    write_snapshot(orders, folder, "2024-02-01T00-00-00Z")
    return read_latest_snapshot(spark, folder)
