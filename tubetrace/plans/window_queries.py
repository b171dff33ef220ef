"""Queries of the windowed statistics and their running accumulation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import relations as R
from ..operators.rules import COLLECT_RULES, REPORT_RULES
from ..operators.running import upsert_latest
from . import jobs, stats
from . import standins as S
from .registry import SE, TEXT, query, times_as_text

W3 = f"strftime(w3, {TEXT}) as window_start, strftime(w3 + interval 3 minutes, {TEXT}) as window_end"


def _text(df):
    return times_as_text(df)


def _stage(spark, sf_dir, stage):
    return S.event_stage(spark, sf_dir, stage)


def _stages(spark, sf_dir):
    return {name: _stage(spark, sf_dir, name) for name in S.EVENT_TYPES}


@query("tumble_3m", f"""
with {SE}
select {W3}, event_type, count(*) as events from se group by w3, event_type""")
def tumble_3m(spark, sf_dir):
    rows = S.table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("recTs"),
                                                   "event_type")
    stat = stats.WindowStat(stats.STAT_WINDOW, keys={"event_type": F.col("event_type")},
                            sums={"events": stats.count_rows()})
    return _text(stats.windowed_stats(rows, "recTs", stat))


# --- city and district -----------------------------------------------------------------

_CITY_MATCHED = f"""{SE},
checked as (
  select user_id, k, check_ts from (
    select user_id, k, check_ts, row_number() over (
      partition by user_id, k order by rec_ts desc, cast(event_id as varchar) desc) as rn
    from se where source = 4) where rn = 1),
collected as (select distinct user_id, k from se where source = 1),
city_1 as (
  select se.*, (k % 20 = 0 or k % 10 = 0) as bad,
         (epoch(timestamp '{S.EVENTS_NOW}') - epoch(se.stage_ts) >= 86400
          and (checked.user_id is null
               or epoch(checked.check_ts) - epoch(se.stage_ts) > 86400)) as unsync
  from se left join checked using (user_id, k) where source = 1),
city_4 as (
  select se.*, collected.user_id is not null as hit,
         (k % 10 = 0 or k < 2 or k % 20 = 0 or user_id % 10 in (3, 4) or k % 5 < 2
          or k % 4 = 0 or se.check_ts > rec_ts
          or (collected.user_id is not null and k > 48)) as bad,
         collected.user_id is null as unsync
  from se left join collected using (user_id, k) where source = 4)"""


def _city_sql(source: int) -> str:
    uploads = ("count(distinct case when hit then user_id || '_' || k end)" if source == 4
               else "cast(0 as bigint)")
    return f"""
select {W3}, area_id || '_' || 'c' || (k % 3) || '_' || 'd' || (k % 5) || '_{source}_0_'
         || substr(max(rec_time), 1, 10) as union_id,
       area_id, 'c' || (k % 3) as collect_location_city, 'd' || (k % 5) as collect_location_district,
       {source} as source, {uploads} as upload_number,
       count(distinct stage_time || user_id) as success_number, cast(0 as bigint) as fail_number,
       count(distinct k) as tube_number, count(*) filter (where bad or unsync) as problem_number,
       count(*) filter (where bad) as problem_error, count(*) filter (where unsync) as problem_unsync,
       max(rec_time) as upload_time, max(user_name) as create_by
from city_{source} group by w3, area_id, k % 3, k % 5"""


def _city_load_sql(source: int) -> str:
    return f"""
select {W3}, area_id || '___{source}_0_' || substr(max(rec_time), 1, 10) as union_id, area_id,
       '' as collect_location_city, '' as collect_location_district, {source} as source,
       cast(0 as bigint) as upload_number, cast(0 as bigint) as success_number,
       cast(0 as bigint) as fail_number, cast(sum(k) as bigint) as tube_number,
       cast(0 as bigint) as problem_number, cast(0 as bigint) as problem_error,
       cast(0 as bigint) as problem_unsync, max(rec_time) as upload_time,
       max(user_name) as create_by
from se where source = {source} group by w3, area_id"""


def _event_person(spark, sf_dir):
    return R.person_relation(_stage(spark, sf_dir, "collect"), _stage(spark, sf_dir, "report"),
                             order=("recTs", "message_id"))


def _flagged_collect(spark, sf_dir):
    rows = R.match_collect_report(_stage(spark, sf_dir, "collect"), _event_person(spark, sf_dir))
    return jobs.with_flags(rows, COLLECT_RULES, S.at(S.EVENTS_NOW))


def _flagged_report(spark, sf_dir):
    rows = R.match_report_collect(_stage(spark, sf_dir, "report"), _event_person(spark, sf_dir))
    rows = rows.withColumn("isCollected", F.col("matchCollectTime").isNotNull())
    return jobs.with_flags(rows, REPORT_RULES, S.at(S.EVENTS_NOW))


@query("city_collect", f"with {_CITY_MATCHED} {_city_sql(1)}")
def city_collect(spark, sf_dir):
    return _text(stats.city_collect(_flagged_collect(spark, sf_dir)))


@query("city_report", f"with {_CITY_MATCHED} {_city_sql(4)}")
def city_report(spark, sf_dir):
    return _text(stats.city_report(_flagged_report(spark, sf_dir)))


@query("city_transport", f"with {SE} {_city_load_sql(2)}")
def city_transport(spark, sf_dir):
    return _text(stats.city_transport(_stage(spark, sf_dir, "transport")))


@query("city_receive", f"with {SE} {_city_load_sql(3)}")
def city_receive(spark, sf_dir):
    return _text(stats.city_receive(_stage(spark, sf_dir, "receive")))


def _city_rows(spark, sf_dir):
    return jobs.city_windows(
        _flagged_collect(spark, sf_dir), _stage(spark, sf_dir, "transport"),
        _stage(spark, sf_dir, "receive"), _flagged_report(spark, sf_dir))


def _running_sql(rows: str, sums, firsts=(), rest=(), order="window_end",
                 keys="union_id", extra="") -> str:
    over = f"over (partition by {keys} order by {order} rows unbounded preceding)"
    cols = [f"cast(sum({c}) {over} as bigint) as {c}" for c in sums]
    cols += [f"first_value({c}) {over} as {c}" for c in firsts]
    return f"select {', '.join([*rest, *cols])} {extra} from ({rows})"


_CITY_ALL = " union all ".join((_city_sql(1), _city_load_sql(2), _city_load_sql(3), _city_sql(4)))


_CREDITED = f"""
city_all as ({_CITY_ALL}),
credited as (
  select window_end, union_id, area_id, source, 0 as credit, upload_time, create_by,
         success_number, tube_number, problem_number, problem_error, problem_unsync,
         case when source = 4 then 0 else upload_number end as upload_number
  from city_all
  union all
  select window_end, area_id || '_' || collect_location_city || '_' || collect_location_district
           || '_1_0_' || substr(upload_time, 1, 10), area_id, 1, 1, null, null, 0, 0, 0, 0, 0,
         upload_number
  from city_all where source = 4)"""


@query("running_city", f"""
with {_CITY_MATCHED}, {_CREDITED}
select * from (
  select window_end, union_id, area_id, source, credit as is_credit,
         last_value(upload_time ignore nulls) over w as upload_time,
         last_value(create_by ignore nulls) over w as create_by,
         {', '.join(f'cast(sum({c}) over w as bigint) as {c}' for c in stats.CITY_SUMS)}
  from credited
  window w as (partition by union_id order by window_end, credit rows unbounded preceding))
where upload_time is not null""")
def running_city(spark, sf_dir):
    out = jobs.city_changelog(_city_rows(spark, sf_dir))
    return _text(out.select("window_end", "union_id", "area_id", "source",
                            F.col("is_credit").cast("int").alias("is_credit"), "upload_time",
                            "create_by", *stats.CITY_SUMS))


# --- organisation ----------------------------------------------------------------------

def _org_sql(stage: str) -> str:
    source = {"collect": 1, "transport": 2, "receive": 3, "report": 4}[stage]
    by_person = stage in ("collect", "report")
    site = "''" if stage == "receive" else "'l' || (k % 4)"
    district = "'d' || (k % 5)" if by_person else "''"
    groups = ", ".join(["w3", "area_id", "org_name", *["k % 4"] * (stage != "receive"),
                        *["k % 5"] * by_person])
    return f"""
select {W3}, area_id || '_' || org_name || '_' || {district} || '_' || {site} || '_{source}_'
         || substr(max(rec_time), 1, 10) as union_id,
       area_id, org_name, {site} as collect_location_name,
       {district} as collect_location_district, {source} as source, count(*) as upload_number,
       {"count(distinct stage_time || user_id)" if by_person else "cast(0 as bigint)"}
         as success_number,
       {"count(distinct k)" if by_person else "cast(sum(k) as bigint)"} as tube_number,
       max(rec_time) as upload_time, max(user_name) as create_by
from se where source = {source} group by {groups}"""


def _register_org(stage: str) -> None:
    @query(f"org_{stage}", f"with {SE} {_org_sql(stage)}")
    def org(spark, sf_dir):
        return _text(stats.org_stat(_stage(spark, sf_dir, stage), stage))


for _name in S.EVENT_TYPES:
    _register_org(_name)


@query("running_org", f"""
with {SE}, log as ({_running_sql(
    " union all ".join(_org_sql(s) for s in S.EVENT_TYPES), stats.ORG_SUMS,
    rest=("window_end", "union_id", "area_id", "org_name", "source", "upload_time"))})
select log.*, s_suppkey as org_code from log left join supplier on s_name = org_name""")
def running_org(spark, sf_dir):
    rows = jobs.org_windows(_stages(spark, sf_dir))
    dim = S.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("org_name"))
    out = jobs.org_changelog(jobs.with_org_code(rows, dim))
    return _text(out.select("window_end", "union_id", "area_id", "org_name", "source",
                            "upload_time", *stats.ORG_SUMS, "org_code"))


# --- reporting delay -------------------------------------------------------------------

_LABEL = """strftime(w3, '%Y-%m-%d %H') || '时-' || strftime(w3 + interval 1 hour, '%H') || '时'"""


def _delay_sql(source: int) -> str:
    moment = "check_ts" if source == 4 else "stage_ts"
    return f"""
select {W3}, area_id || '_{source}_' || client_id || '_' || {_LABEL} as union_id, area_id,
       '{source}' as source, client_id, {_LABEL} as data_delay_time,
       cast(sum(datesub('minute', {moment}, timestamp '{S.EVENTS_NOW}')) as bigint) as delay_sum,
       count(*) as delay_count, max(rec_time) as create_time
from se where source = {source} group by w3, area_id, client_id"""


_DELAYS = " union all ".join(_delay_sql(s) for s in (1, 2, 3, 4))


def _delay_rows(spark, sf_dir):
    return jobs.delay_windows(_stages(spark, sf_dir), now=S.at(S.EVENTS_NOW))


@query("report_delay", f"with {SE} {_DELAYS}")
def report_delay(spark, sf_dir):
    return _text(_delay_rows(spark, sf_dir))


@query("running_delay", f"""
with {SE}, log as ({_running_sql(
    _DELAYS, ("delay_sum", "delay_count"), ("create_time",),
    rest=("window_end", "union_id", "area_id", "source", "client_id", "data_delay_time"))})
select log.*, delay_sum // delay_count as delay_num, '{stats.REPORT_DELAY_LABEL}' as delay_type,
       coalesce(n_name, '') as report_client
from log left join nation on n_nationkey = client_id""")
def running_delay(spark, sf_dir):
    dim = S.table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("bigint").alias("client_id"),
        F.col("n_name").alias("client_name"))
    out = jobs.delay_changelog(jobs.with_client_name(_delay_rows(spark, sf_dir), dim))
    return _text(out.select("window_end", "union_id", "area_id", "source", "client_id",
                            "data_delay_time", "delay_sum", "delay_count", "create_time",
                            "delay_num", "delay_type", "report_client"))


# --- stage delay -----------------------------------------------------------------------

def _stage_delay_sql(source: int) -> str:
    moment = "check_ts" if source == 4 else "stage_ts"
    return f"""
select area_id, {source} as source, strftime(max({moment}), '%Y-%m-%d') as day_date,
       cast(hour(w10) as integer) as unit_hour, cast(minute(w10) as integer) as unit_minute,
       cast(trunc(sum(datesub('minute', {moment}, rec_ts)) / count(*)) as bigint) as delay_avg,
       max(rec_time) as create_time
from se where source = {source} group by w10, area_id, substr(rec_time, 1, 10)"""


@query("stage_delay", f"with {SE} " + " union all ".join(_stage_delay_sql(s) for s in (1, 2, 3, 4)))
def stage_delay(spark, sf_dir):
    return jobs.stage_delays(_stages(spark, sf_dir))


# --- persons per hour of day -----------------------------------------------------------

_W1 = f"strftime(rec_ts, {TEXT}) as window_start, strftime(rec_ts + interval 1 second, {TEXT}) as window_end"
_HOUR_CTE = f"""{SE},
collected as (select distinct user_id, k from se where source = 1),
hours as (
  select se.*, hour(stage_ts) as unit_hour, collected.user_id is not null as hit
  from se left join collected using (user_id, k))"""


def _hour_sql(source: int) -> str:
    zero = "cast(0 as bigint)"
    collected = "count(distinct user_id)" if source == 1 else zero
    tested = ("count(distinct case when hit then user_id || '_' || k end)"
              if source == 4 else zero)
    return f"""
select {_W1}, area_id || '_' || unit_hour || '_' || substr(max(rec_time), 1, 10) as union_id,
       area_id, cast(unit_hour as integer) as unit_hour, {source} as source,
       {collected} as collect_persons, {tested} as check_persons,
       {'count(*)' if source == 1 else zero} as collect_all,
       {'count(*)' if source == 4 else zero} as check_all, max(rec_time) as create_time
from hours where source = {source} group by rec_ts, area_id, unit_hour"""


def _hour_stages(spark, sf_dir):
    collect = _stage(spark, sf_dir, "collect")
    report = R.with_collected_flag(_stage(spark, sf_dir, "report"), collect)
    return {"collect": collect, "report": report}


@query("hour_persons_collect", f"with {_HOUR_CTE} {_hour_sql(1)}")
def hour_persons_collect(spark, sf_dir):
    return _text(stats.hour_persons(_stage(spark, sf_dir, "collect"), "collect"))


@query("hour_persons_report", f"with {_HOUR_CTE} {_hour_sql(4)}")
def hour_persons_report(spark, sf_dir):
    return _text(stats.hour_persons(_hour_stages(spark, sf_dir)["report"], "report"))


@query("running_hour", f"""
with {_HOUR_CTE} {_running_sql(
    _hour_sql(1) + " union all " + _hour_sql(4), stats.HOUR_SUMS, ("create_time",),
    rest=("window_end", "union_id", "area_id", "unit_hour", "source"),
    order="window_end, source")}""")
def running_hour(spark, sf_dir):
    out = jobs.hour_changelog(jobs.hour_windows(_hour_stages(spark, sf_dir)))
    return _text(out.select("window_end", "union_id", "area_id", "unit_hour", "source",
                            *stats.HOUR_SUMS, "create_time"))


# --- today -----------------------------------------------------------------------------

def _today_sql(stage: str) -> str:
    source = {"collect": 1, "transport": 2, "receive": 3, "report": 4}[stage]
    by_person = stage in ("collect", "report")
    persons, zero = "count(distinct user_id)", "cast(0 as bigint)"
    return f"""
select {W3}, area_id || '_{source}_' || substr(max(rec_time), 1, 10) as union_id, area_id,
       {source} as source, {persons if stage == 'collect' else zero} as upload_number,
       count(*) as success_number, {persons if by_person else zero} as fail_number,
       max(rec_time) as upload_time, max(user_name) as create_by,
       {'count(distinct k)' if by_person else 'cast(sum(k) as bigint)'} as tube_number,
       max(drop_num) as drop_data_num
from se where source = {source} group by w3, area_id"""


def _register_today(stage: str) -> None:
    @query(f"today_{stage}", f"with {SE} {_today_sql(stage)}")
    def today(spark, sf_dir):
        return _text(stats.today_stat(_stage(spark, sf_dir, stage), stage))


for _name in S.EVENT_TYPES:
    _register_today(_name)

_TODAY = " union all ".join(_today_sql(s) for s in S.EVENT_TYPES)
_TODAY_REST = ("window_end", "union_id", "area_id", "source", "upload_time", "create_by",
               "drop_data_num")


def _today_log(spark, sf_dir):
    return jobs.today_changelog(jobs.today_windows(_stages(spark, sf_dir)))


@query("union_stages", f"""
with {SE}
select source, count(*) as window_rows, cast(sum(success_number) as bigint) as success_number,
       cast(sum(fail_number) as bigint) as fail_number,
       cast(sum(tube_number) as bigint) as tube_number
from ({_TODAY}) group by source""")
def union_stages(spark, sf_dir):
    rows = jobs.today_windows(_stages(spark, sf_dir))
    return rows.groupBy("source").agg(
        F.count("*").alias("window_rows"),
        *[F.sum(c).alias(c) for c in ("success_number", "fail_number", "tube_number")])


@query("running_today", f"with {SE} {_running_sql(_TODAY, stats.TODAY_SUMS, rest=_TODAY_REST)}")
def running_today(spark, sf_dir):
    return _text(_today_log(spark, sf_dir).select(*_TODAY_REST, *stats.TODAY_SUMS))


@query("running_today_hour", f"""
with {SE}
select window_end, union_id, upload_time,
       cast(sum(success_number) over w as bigint) as upload_hour_num,
       cast(sum(fail_number) over w as bigint) as fail_hour_num
from ({_TODAY})
window w as (partition by union_id, substr(upload_time, 1, 13) order by window_end
             rows unbounded preceding)""")
def running_today_hour(spark, sf_dir):
    return _text(_today_log(spark, sf_dir).select(
        "window_end", "union_id", "upload_time", "upload_hour_num", "fail_hour_num"))


@query("upsert_latest", f"""
with {SE}, log as ({_running_sql(_TODAY, stats.TODAY_SUMS, rest=_TODAY_REST)})
select * exclude (rn) from (
  select *, row_number() over (partition by union_id order by window_end desc) as rn from log)
where rn = 1""")
def upsert_latest_query(spark, sf_dir):
    log = _today_log(spark, sf_dir).select(*_TODAY_REST, *stats.TODAY_SUMS)
    return _text(upsert_latest(log, ["union_id"], ["window_end"]))


# --- collect to report gap -------------------------------------------------------------

_GAP_SQL = f"""
select {W3}, area_id || '_' || substr(max(rec_time), 1, 10) || '_'
         || datesub('hour', stage_ts, check_ts) as union_id,
       area_id, datesub('hour', stage_ts, check_ts) as unit_hour, count(user_id) as check_persons,
       max(rec_time) as create_time,
       cast(sum(event_id % 90) * 1000 as bigint) as sum_delay, count(*) as total
from se where source = 4 group by w3, area_id, datesub('hour', stage_ts, check_ts)"""
_GAP_COLUMNS = ", ".join(stats.GAP_COLUMNS)


@query("gap_histogram", f"with {SE} select {_GAP_COLUMNS} from ({_GAP_SQL})")
def gap_histogram(spark, sf_dir):
    return _text(stats.gap_histogram(_stage(spark, sf_dir, "report")))


_GAP_REST = ("window_end", "union_id", "area_id", "unit_hour")


@query("running_gap", f"""
with {SE} {_running_sql(_GAP_SQL, ("check_persons",), ("create_time",), rest=_GAP_REST)}""")
def running_gap(spark, sf_dir):
    out = jobs.gap_changelog(stats.gap_histogram(_stage(spark, sf_dir, "report")))
    return _text(out.select(*_GAP_REST, "check_persons", "create_time"))


@query("latency_avg", f"""
with {SE}, log as ({_running_sql(
    _GAP_SQL, ("check_persons", "sum_delay", "total"), ("create_time",), rest=_GAP_REST)})
select * exclude (sum_delay), round(sum_delay / 1000.0 / total, 2) as delay_avg from log""")
def latency_avg(spark, sf_dir):
    rows = _stage(spark, sf_dir, "report").withColumn(
        "processedTs", F.timestamp_add("SECOND", (F.col("event_id") % 90).cast("int"),
                                       F.col("recTs")))
    out = jobs.latency_changelog(stats.latency_stat(rows, "processedTs"))
    return _text(out.select(*_GAP_REST, "check_persons", "total", "create_time", "delay_avg"))
