"""Registered queries, each with the SQL that must give the same rows (where there is one)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import format_time

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn
    return add


def times_as_text(df: DataFrame) -> DataFrame:
    """Timestamps in the text form the engine's tables use."""
    stamps = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp"]
    return df.withColumns({c: format_time(c) for c in stamps})


def flags_as_numbers(df: DataFrame) -> DataFrame:
    flags = [f.name for f in df.schema.fields if f.dataType.typeName() == "boolean"]
    return df.withColumns({c: F.col(c).cast("int") for c in flags})


TEXT = "'%Y-%m-%d %H:%M:%S'"

# --- SQL of the stand-in rows (see standins.py) ----------------------------------------

SE = f"""
ev as (
  select event_id, user_id, event_type,
         cast(regexp_extract(props, '"k":\\s*(\\d+)', 1) as bigint) as k,
         date_trunc('second', ts) as rec_ts,
         date_trunc('second', ts) - to_minutes(cast(floor(value) as bigint)) as stage_ts
  from events),
se as (
  select *, strftime(rec_ts, {TEXT}) as rec_time, strftime(stage_ts, {TEXT}) as stage_time,
         user_id % 10 as area_id, user_id % 25 as client_id, 'u' || (user_id % 7) as user_name,
         cast(event_id % 3 as integer) as drop_num,
         'Supplier#' || lpad(cast(user_id % 120 as varchar), 9, '0') as org_name,
         case event_type when 'signup' then 1 when 'click' then 2 when 'purchase' then 3
                         when 'error' then 4 end as source,
         stage_ts + to_minutes(k * 30) as check_ts,
         time_bucket(interval '3 minutes', rec_ts, timestamp '1970-01-01') as w3,
         time_bucket(interval '10 minutes', rec_ts, timestamp '1970-01-01') as w10
  from ev)
"""


def person_sql(key: str) -> str:
    return f"""case when {key} % 50 = 7 then {key} || '#'
  when {key} % 3 = 0 and {key} < 1000000000
  then '1' || lpad(cast({key} // 10000 as varchar), 5, '0') || '19900111'
       || lpad(cast({key} % 10000 as varchar), 4, '0')
  else cast({key} as varchar) end"""


def good_id_sql(key: str) -> str:
    return f"coalesce({key} % 50 <> 7 and {key} % 3 = 0 and {key} < 1000000000, false)"


COL = f"""
col as (
  select {person_sql("o_custkey")} as person, o_custkey as cust, cast(o_orderkey as varchar) as tube, o_orderkey,
         o_custkey % 10 as area_id, o_orderpriority as district, o_orderdate as collect_ts,
         strftime(o_orderdate, {TEXT}) as collect_time,
         o_orderdate + to_days(cast(o_orderkey % 5 - 1 as integer)) as add_ts
  from orders)
"""

REP = f"""
rep as (
  select l_orderkey, l_partkey, l_linenumber, o_custkey as cust,
         {person_sql("o_custkey")} as person,
         case when l_partkey % 19 = 0 then null
              when l_partkey % 23 = 0 then l_shipdate + interval 1 hour
              else o_orderdate + to_minutes(l_partkey % 5 - 1) end as pack_ts,
         case when l_partkey % 17 = 0 then o_orderdate - interval 1 hour
              else l_shipdate + to_minutes(20 - l_partkey % 7 * 10) end as receive_ts,
         l_shipdate + to_days(cast(l_partkey % 6 - 1 as integer)) as add_ts,
         cast(l_orderkey as varchar) as tube, o_custkey % 10 as area_id,
         o_orderpriority as district,
         'Supplier#' || lpad(cast(l_suppkey as varchar), 9, '0') as org_name,
         o_orderdate as collect_ts, strftime(o_orderdate, {TEXT}) as collect_time,
         l_shipdate as check_ts, strftime(l_shipdate, {TEXT}) as check_time
  from lineitem left join orders on l_orderkey = o_orderkey)
"""

PERSON = f"""
{COL}, {REP},
person_rel as (
  select coalesce(c.person, r.person) as person, coalesce(c.tube, r.tube) as tube,
         c.collect_time, r.check_time, r.check_ts
  from (select person, tube, max(collect_time) as collect_time from col
        where person is not null group by all) c
  full join (select person, tube, max(check_time) as check_time, max(check_ts) as check_ts
             from rep where person is not null and tube is not null group by all) r
  on c.person = r.person and c.tube = r.tube)
"""

DELIVERY = f"""
tra as (
  select l_orderkey, l_suppkey, l_orderkey || '-' || l_suppkey as code,
         min(l_shipdate) as delivery_ts, cast(count(*) as integer) as tube_num,
         cast(count(distinct l_partkey) as integer) as pack_num,
         min(l_shipdate) + to_hours(cast(l_orderkey % 4 - 2 as integer)) as pack_ts
  from lineitem group by l_orderkey, l_suppkey),
rec as (
  select l_orderkey, l_suppkey, l_orderkey || '-' || l_suppkey as code,
         max(l_shipdate) as receive_ts, cast(count(*) as integer) as tube_num,
         cast(count(distinct l_partkey) as integer) as pack_num
  from lineitem where l_linestatus = 'F' group by l_orderkey, l_suppkey)
"""
