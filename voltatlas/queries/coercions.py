"""Value coercions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from voltatlas.functions.responses import error_text, outcome, redact_params, redact_query, status_message
from voltatlas.functions.timestamps import clamp_ts, coerce_ts, iso_seconds, ntz, ts_text, warehouse_ts as load_ts
from voltatlas.functions.values import (
    nested_to_json,
    request_point_key,
    stable_event_id,
    to_bool_column,
    to_int,
)
from voltatlas.queries.registry import RUN_TS, query, table

# {us} stands for the event's microseconds.
_TS_FORMS = """
case event_id % 10
  when 0 then cast({us} div 1000000 as string) when 1 then cast({us} div 1000 as string)
  when 2 then cast({us} as string) when 3 then cast({us} as string) || '000'
  when 4 then {iso} || 'Z' when 5 then '(seconds_since_epoch=' || cast({us} div 1000000 as string) || ', nanos=0)'
  when 6 then '2024-01-01' when 7 then 'seconds_since_epoch: ' || cast({us} div 1000000 as string)
  when 8 then cast({us} div 1000000 - 900000000 as string)
  else 'no time' end"""

_SPARK_TS = _TS_FORMS.format(us="us", iso="iso")
_DUCK_TS = _TS_FORMS.format(us="us", iso="iso").replace(" div ", " // ").replace("as string", "as varchar")


def _sql_epoch(x: str) -> str:
    secs = f"""(case when abs({x}) >= 1e18 then {x} / 1e9 when abs({x}) >= 1e15 then {x} / 1e6
                when abs({x}) >= 1e12 then {x} / 1e3 else {x} end)"""
    return f"""make_timestamp(cast(trunc({secs}) as bigint) * 1000000
               + cast(round_even(({secs} - trunc({secs})) * 1e6, 0) as bigint))"""


_NUM = "'^[0-9+.\\-]*[0-9][0-9+.\\-]*$'"
_TS_SQL = f"""
t as (
  select event_id, {_DUCK_TS} as s from (
    select event_id, epoch_us(ts) as us, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') as iso from events)
),
n as (
  select event_id, s,
         case when regexp_matches(s, {_NUM}) then try_cast(s as double) end as x,
         try_cast(nullif(regexp_extract(s, 'seconds_since_epoch=([0-9]+)', 1), '') as double) as e1,
         try_cast(nullif(regexp_extract(s, 'seconds_since_epoch(?:\\s*[:=]\\s*|\\s+)([0-9]+)', 1), '') as double) as e2
  from t
),
c as (
  select event_id, s,
         case when regexp_matches(s, {_NUM}) then {_sql_epoch('x')} when e1 is not null then {_sql_epoch('e1')}
              else try_cast(s as timestamp) end as a,
         case when e2 is not null then {_sql_epoch('e2')} when regexp_matches(s, {_NUM}) then {_sql_epoch('x')}
              else try_cast(s as timestamp) end as b
  from n
)"""


def _ts_forms(spark, sf):
    return (
        table(spark, sf, "events")
        .select(
            "event_id",
            F.unix_micros(F.col("ts").cast("timestamp")).alias("us"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("iso"),
        )
        .select("event_id", F.expr(_SPARK_TS).alias("s"))
    )


@query(
    f"""
with {_TS_SQL}
select event_id, strftime(a, '%Y-%m-%d %H:%M:%S.%f') as numbers_first, strftime(b, '%Y-%m-%d %H:%M:%S.%f') as struct_first,
       strftime(case when a between timestamp '2000-01-01' and timestamp '2100-01-01' then a
                     else timestamp '{RUN_TS}' end, '%Y-%m-%d %H:%M:%S.%f') as clamped_now,
       strftime(case when b between timestamp '2000-01-01' and timestamp '2100-01-01' then b end,
                '%Y-%m-%d %H:%M:%S.%f') as clamped_null
from c
"""
)
def coerce_clamp_ts(spark, sf):
    forms = _ts_forms(spark, sf).withColumns(
        {"a": coerce_ts("s", "numbers_first"), "b": coerce_ts("s", "struct_first")}
    )
    return forms.select(
        "event_id", ts_text("a").alias("numbers_first"), ts_text("b").alias("struct_first"),
        ts_text(clamp_ts("a", ntz(RUN_TS))).alias("clamped_now"),
        ts_text(clamp_ts("b", None)).alias("clamped_null"),
    )


@query(
    """
with t as (
  select event_id, case event_id % 3
           when 0 then '(seconds_since_epoch=' || cast(epoch_us(ts) as varchar) || '000, nanos=0)'
           when 1 then strftime(ts, '%Y-%m-%d %H:%M:%S.%f') else event_type end as s,
         epoch_us(ts) as us
  from events
)
select event_id, strftime(case when s like '%seconds_since_epoch%' then make_timestamp(us)
                               else try_cast(s as timestamp) end, '%Y-%m-%d %H:%M:%S.%f') as load_ts
from t
"""
)
def warehouse_ts(spark, sf):
    s = F.expr(
        """case event_id % 3
             when 0 then '(seconds_since_epoch=' || string(unix_micros(timestamp(ts))) || '000, nanos=0)'
             when 1 then date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSSSSS') else event_type end"""
    )
    return table(spark, sf, "events").select("event_id", ts_text(load_ts(s)).alias("load_ts"))


_TRUTH = """
case event_type when 'click' then ' Yes ' when 'view' then 'F' when 'error' then 'maybe' when 'signup' then '1' else
  case when {k} % 2 = 0 then 'N' else '2' end end"""
_INT_TEXT = """
case when {k} % 5 = 0 then 'x' when {k} % 5 = 1 then ' ' || {v} || ' ' when {k} % 5 = 2 then '-' || {v}
     when {k} % 5 = 3 then '1.5e2' else null end"""


@query(
    f"""
with t as (
  select event_id, cast(json_extract_string(props, '$.k') as bigint) as k, cast(value as varchar) as v, event_type
  from events
), s as (select event_id, k, {_TRUTH.format(k='k')} as truth, {_INT_TEXT.format(k='k', v='v')} as num from t)
select event_id,
       case when lower(trim(truth)) in ('true', 't', 'yes', 'y', '1') then true
            when lower(trim(truth)) in ('false', 'f', 'no', 'n', '0') then false end as truth,
       case when k = 1 then true when k = 0 then false end as numeric_truth,
       cast(trunc(try_cast(trim(num) as double)) as bigint) as whole
from s
"""
)
def bool_int_coercion(spark, sf):
    t = table(spark, sf, "events").select(
        "event_id", "event_type", F.get_json_object("props", "$.k").cast("double").alias("k"),
        F.col("value").cast("string").alias("v"),
    )
    s = t.select(
        "event_id", "k", F.expr(_TRUTH.format(k="k")).alias("truth"),
        F.expr(_INT_TEXT.format(k="k", v="v")).alias("num"),
    )
    return s.select(
        "event_id", to_bool_column(s, "truth").alias("truth"), to_bool_column(s, "k").alias("numeric_truth"),
        to_int("num").alias("whole"),
    )


_KEY_COLUMNS = """
case o_orderpriority when '5-LOW' then '' when '1-URGENT' then null else o_orderstatus || '-' || {key} end as road_feature_id,
case when o_custkey % 3 = 0 then 0 when o_custkey % 3 = 1 then null else o_custkey end as road_osm_id,
cast(case when o_custkey % 6 = 0 then 0.0005 when o_custkey % 6 = 1 then 0.0000125
          else (o_custkey % 180 - 90) / 2.0 end as double) as request_point_lat,
cast((o_orderkey % 360 - 180) / 4.0 as double) as request_point_lon"""


@query(
    f"""
with t as (select o_orderkey, {_KEY_COLUMNS.format(key='cast(o_orderkey as varchar)')} from orders)
select o_orderkey, coalesce(nullif(road_feature_id, ''), cast(nullif(road_osm_id, 0) as varchar),
                            cast(request_point_lat as varchar) || ',' || cast(request_point_lon as varchar))
         as request_point_key
from t
"""
)
def request_key(spark, sf):
    orders = table(spark, sf, "orders")
    t = orders.selectExpr("o_orderkey", *_split_columns(_KEY_COLUMNS.format(key="string(o_orderkey)")))
    return t.select("o_orderkey", request_point_key(t).alias("request_point_key"))


def _split_columns(text: str) -> list[str]:
    """'expr as name,' lines to single expressions; every expression ends in its 'as name'."""
    out, depth, start = [], 0, 0
    for i, ch in enumerate(text):
        depth += (ch == "(") - (ch == ")")
        if ch == "," and depth == 0 and " as " in text[start:i].splitlines()[-1]:
            out.append(text[start:i])
            start = i + 1
    return [*out, text[start:]]


_STATUS = """
case event_id % 12 when 0 then 200 when 1 then 400 when 2 then 401 when 3 then 403 when 4 then 404 when 5 then 418
  when 6 then 429 when 7 then 500 when 8 then 502 when 9 then 503 when 10 then 504 end"""
_BODY = "case event_type when 'view' then '  ' when 'click' then null else ' ' || event_type || props || event_type || ' ' end"


@query(
    f"""
with t as (select event_id, {_STATUS} as st, {_BODY} as body from events),
u as (
  select *, case when length(trim(body)) > 20 then left(trim(body), 20) || '…' else trim(body) end as cut from t
)
select event_id,
       case when st is null then 'other' when st in (429, 500, 502, 503, 504) then 'retryable'
            when st in (400, 401, 403, 404) then 'permanent' when st < 400 then 'ok' else 'other' end as traffic_outcome,
       case when st is null then 'other' when st in (429, 500, 502, 503, 504) then 'retryable'
            when st >= 400 then 'permanent' else 'ok' end as station_outcome,
       cut as error_text,
       case when cut is null or cut = '' then 'HTTP ' || st else 'HTTP ' || st || ': ' || cut end as message
from u
"""
)
def response_outcomes(spark, sf):
    t = table(spark, sf, "events").select("event_id", F.expr(_STATUS).alias("st"), F.expr(_BODY).alias("body"))
    return t.select(
        "event_id", outcome("st", "traffic").alias("traffic_outcome"),
        outcome("st", "station").alias("station_outcome"), error_text("body", 20).alias("error_text"),
        status_message("st", "body", 20).alias("message"),
    )


@query(
    """
select page_id, regexp_replace(url, '([?&]page=)[^&#]*', '\\1***', 'g') as safe_url,
       case when page_id % 2 = 0 then '***' end as key_param, 'v' || page_id as other_param
from pages
"""
)
def redact_secrets(spark, sf):
    pages = table(spark, sf, "pages")
    params = F.map_from_entries(
        F.when(
            F.col("page_id") % 2 == 0,
            F.array(
                F.struct(F.lit("key"), F.lit("s3cret")),
                F.struct(F.lit("point"), F.concat(F.lit("v"), "page_id")),
            ),
        ).otherwise(F.array(F.struct(F.lit("point"), F.concat(F.lit("v"), "page_id"))))
    )
    safe = redact_params(params)
    return pages.select(
        "page_id", redact_query("url", "page").alias("safe_url"),
        F.try_element_at(safe, F.lit("key")).alias("key_param"),
        F.try_element_at(safe, F.lit("point")).alias("other_param"),
    )


@query(
    """
select o_orderkey,
       '{"status":"' || o_orderstatus || '","cust":' || o_custkey || ',"gap":null}' as detail,
       '["' || o_orderpriority || '"]' as list,
       cast(o_custkey as varchar) as whole, cast(o_custkey + 0.25 as double)::varchar as part
from orders
"""
)
def json_stringify(spark, sf):
    t = table(spark, sf, "orders").select(
        "o_orderkey",
        F.struct(
            F.col("o_orderstatus").alias("status"), F.col("o_custkey").alias("cust"),
            F.lit(None).cast("string").alias("gap"),
        ).alias("detail"),
        F.array("o_orderpriority").alias("list"),
        F.col("o_custkey").cast("decimal(12,2)").alias("whole"),
        (F.col("o_custkey").cast("decimal(12,2)") + F.lit(0.25).cast("decimal(3,2)")).alias("part"),
    )
    return nested_to_json(t)


@query(
    """
select event_id, sha256('run-1|' || user_id || '|' || strftime(ts, '%Y-%m-%dT%H:%M:%SZ')) as stable_id,
       strftime(ts, '%Y-%m-%dT%H:%M:%SZ') as snapshot_ts
from events
"""
)
def stable_event_ids(spark, sf):
    stamp = iso_seconds("ts")
    return table(spark, sf, "events").select(
        "event_id", stable_event_id(F.lit("run-1"), "user_id", stamp).alias("stable_id"), stamp.alias("snapshot_ts")
    )
