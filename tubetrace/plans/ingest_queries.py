"""Queries over messages: parse, route, type, encode, encrypt, summarise."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import predicates
from ..functions.crypto import CipherKey, decrypt, decrypt_columns, encrypt, encrypt_columns
from ..operators import batch_log as B
from ..operators import envelope as E
from ..operators.issues import error_flags
from ..operators.rules import COLLECT_RULES
from ..operators.running import accumulated, running_accumulate
from ..schemas import COLLECT, RECEIVE, REPORT, TRANSPORT
from . import standins as S
from .jobs import HOURLY_KEYS, HOURLY_SUMS, enrich_messages
from .registry import COL, SE, query, times_as_text

# a key for the demonstration only; real keys are parameters
DEMO_SECRET = CipherKey(b"0123456789abcdef", b"fedcba9876543210")

MESSAGE_TYPE = """case event_type when 'signup' then 'COLLECT_DATA' when 'click' then 'TRANSPORT_DATA'
  when 'purchase' then 'RECEIVE_DATA' when 'view' then 'PAGE_VIEW'
  when 'error' then case when event_id % 2 = 1 then 'XA_REPORT_DATA' else 'REPORT_DATA' end end"""

TWO = f"""{SE}, two as (
  select se.*, extra, k + extra as kk, event_id * 2 + extra as submit_id, {MESSAGE_TYPE} as type
  from se, (values (0), (1)) as x(extra))"""


@query("source_messages", """
select conv_id || '-' || (turn // 16) as message_id, count(*) as turns
from conversations group by all""")
def source_messages(spark, sf_dir):
    messages = S.conversation_messages(spark, sf_dir)
    data = F.from_json("value", "data array<struct<turn: bigint>>")["data"]
    return messages.select("message_id", F.size(data).cast("bigint").alias("turns"))


@query("parse_envelope", f"""
with {SE}
select cast(event_id as varchar) as message_id, {MESSAGE_TYPE} as type, user_name, client_id,
       event_id as number_report, rec_time, drop_num as drop_data_num, cast(2 as bigint) as elements
from se""")
def parse_envelope(spark, sf_dir):
    parsed = E.parse_envelope(S.event_messages(spark, sf_dir))
    return parsed.select(
        "message_id", "type", F.col("userName").alias("user_name"),
        F.col("clientId").alias("client_id"), F.col("numberReport").alias("number_report"),
        F.col("interfaceRecTime").alias("rec_time"), F.col("dropDataNum").alias("drop_data_num"),
        F.size("data").cast("bigint").alias("elements"))


@query("quarantine_messages", """
select cast(event_id as varchar) as message_id,
       case event_id % 50 when 0 then 'malformed' when 1 then 'blank' when 2 then 'missing_type'
                          when 3 then 'malformed' else 'unknown_type' end as reason
from events where event_id % 50 < 4 or event_type = 'view'""")
def quarantine_messages(spark, sf_dir):
    return E.quarantine_messages(S.damaged_event_messages(spark, sf_dir)).select(
        "message_id", "reason")


@query("route_by_type", """
select case event_type when 'signup' then 'collect' when 'click' then 'transport'
                       when 'purchase' then 'receive' else 'report' end as stage,
       count(*) as messages
from events where event_type <> 'view' group by all""")
def route_by_type(spark, sf_dir):
    routed = E.route_by_type(E.parse_envelope(S.event_messages(spark, sf_dir)))
    return routed.groupBy("stage").agg(F.count("*").alias("messages"))


def _stage(spark, sf_dir, stage, *columns):
    rows = E.stage_from_messages(S.event_messages(spark, sf_dir), stage)
    return times_as_text(rows.select("message_id", "pos", "type", "areaId", "submitId", *columns))


_STAGE_SQL = """cast(event_id as varchar) as message_id, extra as pos, type, area_id as "areaId",
  submit_id as "submitId" """
_ENVELOPE_SQL = """event_id as "numberReport", rec_time as "interfaceRecTime",
  user_name as "userName", client_id as "clientId", drop_num as "dropDataNum",
  rec_time as "recTs" """
_ENVELOPE = ("numberReport", "interfaceRecTime", "userName", "clientId", "dropDataNum", "recTs")


@query("stage_collect", f"""
with {TWO}
select {_STAGE_SQL}, cast(user_id as varchar) as "personIdCard", cast(kk as varchar) as "tubeCode",
       stage_time as "collectTime", stage_time as "collectTs", rec_time as "addTime",
       1 as "collectCount", cast(null as integer) as "collectLimitnum", {_ENVELOPE_SQL}
from two where source = 1""")
def stage_collect(spark, sf_dir):
    return _stage(spark, sf_dir, COLLECT, "personIdCard", "tubeCode", "collectTime", "collectTs",
                  "addTime", "collectCount", "collectLimitnum", *_ENVELOPE)


@query("stage_transport", f"""
with {TWO}
select {_STAGE_SQL}, 'D' || user_id || '-' || kk as "deliveryCode", stage_time as "deliveryTime",
       stage_time as "deliveryTs", rec_time as "addTime", cast(kk as integer) as "tubeNum",
       cast(kk as varchar) as first_tube, {_ENVELOPE_SQL}
from two where source = 2""")
def stage_transport(spark, sf_dir):
    return _stage(spark, sf_dir, TRANSPORT, "deliveryCode", "deliveryTime", "deliveryTs",
                  "addTime", "tubeNum", F.col("transportItem")[0]["tubeCode"].alias("first_tube"),
                  *_ENVELOPE)


@query("stage_receive", f"""
with {TWO}
select {_STAGE_SQL}, 'D' || user_id || '-' || kk as "deliveryCode", 'R' || event_id as "receiveCode",
       stage_time as "receiveTime", stage_time as "receiveTs", rec_time as "addTime",
       cast(kk as integer) as "tubeNum", cast(kk as varchar) as first_tube, {_ENVELOPE_SQL}
from two where source = 3""")
def stage_receive(spark, sf_dir):
    return _stage(spark, sf_dir, RECEIVE, "deliveryCode", "receiveCode", "receiveTime",
                  "receiveTs", "addTime", "tubeNum",
                  F.col("receivesItem")[0]["tubeCode"].alias("first_tube"), *_ENVELOPE)


@query("stage_report", f"""
with {TWO}
select {_STAGE_SQL}, cast(user_id as varchar) as "personIdCard", cast(kk as varchar) as "tubeCode",
       stage_time as "collectTime", stage_time as "collectTs", rec_time as "checkTime",
       rec_time as "checkTs", cast(kk % 4 as varchar) as "checkResult", rec_time as "addTime",
       {_ENVELOPE_SQL}
from two where source = 4""")
def stage_report(spark, sf_dir):
    return _stage(spark, sf_dir, REPORT, "personIdCard", "tubeCode", "collectTime", "collectTs",
                  "checkTime", "checkTs", "checkResult", "addTime", *_ENVELOPE)


# --- hourly summaries ------------------------------------------------------------------

_HOURLY_SQL = f"""{COL}, hourly as (
  select o_orderkey, area_id, strftime(collect_ts, '%Y-%m-%d') as collect_date,
         cast(o_orderkey % 3 as integer) as unit_hour,
         cast(o_orderkey % 11 as integer) as collect_persons,
         cast(o_orderkey % 13 as integer) as collect_sample_num,
         cast(o_orderkey % 17 as integer) as transfer_persons,
         cast(o_orderkey % 19 as integer) as transfer_sample_num,
         cast(o_orderkey % 23 as integer) as receive_persons,
         cast(o_orderkey % 29 as integer) as receive_sample_num,
         cast(o_orderkey % 31 as integer) as check_persons,
         cast(o_orderkey % 37 as integer) as check_sample_num
  from col)"""
_HOURLY_NAMES = ("collect_persons", "collect_sample_num", "transfer_persons",
                 "transfer_sample_num", "receive_persons", "receive_sample_num",
                 "check_persons", "check_sample_num")


def _hourly(spark, sf_dir):
    rows = E.hourly_summary_rows(S.hourly_messages(spark, sf_dir), F.lit(S.ORDERS_NOW))
    return rows.withColumn("sequence", F.col("message_id").cast("bigint"))


@query("hourly_summary_rows", f"""
with {_HOURLY_SQL}
select cast(o_orderkey as varchar) as message_id, area_id, collect_date, unit_hour,
       {', '.join(_HOURLY_NAMES)}, 'loader' as create_by, '{S.ORDERS_NOW}' as create_time,
       0 as is_delete
from hourly""")
def hourly_summary_rows(spark, sf_dir):
    return _hourly(spark, sf_dir).select(
        "message_id", *[F.col(c).alias(n) for c, n in HOURLY_KEYS.items()],
        *[F.col(c).alias(n) for c, n in HOURLY_SUMS.items()],
        F.col("createBy").alias("create_by"), F.col("createTime").alias("create_time"),
        F.col("isDelete").alias("is_delete"))


_RUNNING = ", ".join(
    f"""cast(sum({n}) over (partition by area_id, collect_date, unit_hour order by o_orderkey
      rows unbounded preceding) as bigint) as {n}""" for n in _HOURLY_NAMES)


@query("hourly_summary_running", f"""
with {_HOURLY_SQL}
select o_orderkey as sequence, area_id, collect_date, unit_hour, {_RUNNING} from hourly""")
def hourly_summary_running(spark, sf_dir):
    rows = _hourly(spark, sf_dir).select(
        "sequence", *[F.col(c).alias(n) for c, n in HOURLY_KEYS.items()],
        *[F.col(c).alias(n) for c, n in HOURLY_SUMS.items()])
    return running_accumulate(rows, HOURLY_KEYS.values(), ["sequence"],
                              sums=HOURLY_SUMS.values(), hot_keys=True)


@query("hourly_summary_final", f"""
with {_HOURLY_SQL}
select area_id, collect_date, unit_hour,
       {', '.join(f'cast(sum({n}) as bigint) as {n}' for n in _HOURLY_NAMES)},
       min(o_orderkey) as first_sequence, max(o_orderkey) as last_sequence
from hourly group by area_id, collect_date, unit_hour""")
def hourly_summary_final(spark, sf_dir):
    rows = _hourly(spark, sf_dir).select(
        "sequence", F.col("sequence").alias("first_sequence"),
        F.col("sequence").alias("last_sequence"),
        *[F.col(c).alias(n) for c, n in HOURLY_KEYS.items()],
        *[F.col(c).alias(n) for c, n in HOURLY_SUMS.items()])
    return accumulated(rows, HOURLY_KEYS.values(), ["sequence"], sums=HOURLY_SUMS.values(),
                       firsts=["first_sequence"], lasts=["last_sequence"])


# --- values ----------------------------------------------------------------------------

@query("decode_result", f"""
with {TWO}
select cast(event_id as varchar) as message_id, extra as pos,
       case kk % 4 when 1 then '阴性' when 2 then '阳性' else cast(kk % 4 as varchar) end
         as check_result,
       cast(null as varchar) as igg_result
from two where source = 4""")
def decode_result(spark, sf_dir):
    rows = E.stage_from_messages(S.event_messages(spark, sf_dir), REPORT)
    return E.decode_results(rows).select(
        "message_id", "pos", F.col("checkResult").alias("check_result"),
        F.col("iggResult").alias("igg_result"))


@query("enriched_messages", f"""
with {TWO}
select cast(event_id as varchar) as message_id, type, extra as pos, submit_id,
       case when source = 4 then
         case kk % 4 when 1 then '阴性' when 2 then '阳性' else cast(kk % 4 as varchar) end
       end as check_result,
       case when source is not null then min(event_id * 2 + extra) over (
         partition by type, case source
           when 1 then user_id || '_' || stage_time
           when 2 then 'D' || user_id || '-' || kk
           when 3 then 'R' || event_id
           else user_id || '_' || stage_time || '_' || rec_time end) end as first_of_id,
       case when source in (2, 3) then min(event_id * 2 + extra) over (
         partition by source, kk) end as first_of_tube_id,
       1 as is_else_unchanged
from two""")
def enriched_messages(spark, sf_dir):
    """Ids by the first element that has the same one, and whether all else is unchanged, a
    member that no layout lists included."""
    messages = S.event_messages(spark, sf_dir).withColumn(
        "value", F.regexp_replace("value", r"^\{", '{"trace":{"a":[1,null]},'))
    enriched = enrich_messages(messages)

    def elements(value):
        return F.from_json(F.from_json(value, "map<string,string>")["data"],
                           "array<map<string,string>>")

    def rest(members, *changed):
        return F.array_sort(F.map_entries(F.map_filter(
            members, lambda name, value: ~name.isin(*changed) & value.isNotNull())))

    before = messages.select("message_id", F.col("value").alias("old"))
    # by size on disk the messages look small enough to be broadcast, but their text is not
    enriched = enriched.join(before.hint("merge"), "message_id")
    heads = [rest(F.from_json(c, "map<string,string>"), "data") for c in ("old", "value")]
    same = F.zip_with(elements("old"), elements("value"), lambda a, b: rest(
        a, "checkResult", "transportItem", "receivesItem") == rest(
        b, "id", "checkResult", "transportItem", "receivesItem"))
    item = "struct<id: bigint, tubeCode: string>"
    element = ("struct<id: bigint, submitId: bigint, checkResult: string, "
               f"transportItem: array<{item}>, receivesItem: array<{item}>>")
    parsed = enriched.select(
        "message_id", F.from_json("value", f"type string, data array<{element}>").alias("m"),
        (heads[0] == heads[1]).alias("same_head"), same.alias("same"))
    rows = parsed.select("message_id", "m.type", "same", "same_head",
                         F.posexplode("m.data").alias("pos", "e"))
    place = F.col("message_id").cast("bigint") * 2 + F.col("pos")
    tube = F.coalesce("e.transportItem", "e.receivesItem")[0]

    def first_of(value):
        # rows without an id have no first; they are spread instead of meeting in one task
        spread = F.when(value.isNull(), F.xxhash64("message_id", "pos"))
        return F.when(value.isNotNull(), F.min(place).over(Window.partitionBy(value, spread)))

    return rows.select(
        "message_id", "type", "pos", F.col("e.submitId").alias("submit_id"),
        F.col("e.checkResult").alias("check_result"),
        first_of(F.col("e.id")).alias("first_of_id"),
        first_of(tube["id"]).alias("first_of_tube_id"),
        (F.col("same_head") & F.col("same")[F.col("pos")]).cast("int").alias("is_else_unchanged"))


@query("encrypt_columns", """
select c_custkey, c_name, 1 as is_sealed from customer""")
def encrypt_columns_query(spark, sf_dir):
    rows = S.table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", F.col("c_name").alias("sealed"))
    sealed = encrypt_columns(rows, ["sealed"], DEMO_SECRET)
    same = encrypt("c_name", DEMO_SECRET) == F.col("sealed")
    back = decrypt("sealed", DEMO_SECRET)
    return sealed.select("c_custkey", back.alias("c_name"),
                         (same & (F.col("sealed") != F.col("c_name"))).cast("int")
                         .alias("is_sealed"))


@query("decrypt_columns", """
select c_custkey, case when c_custkey % 10 <> 0 then c_name end as c_name from customer""")
def decrypt_columns_query(spark, sf_dir):
    rows = S.table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    sealed = encrypt_columns(rows, ["c_name"], DEMO_SECRET)
    damaged = sealed.withColumn("c_name", F.when(
        F.col("c_custkey") % 10 != 0, F.col("c_name")).otherwise(F.lit("no cipher text")))
    return decrypt_columns(damaged, ["c_name"], DEMO_SECRET)


@query("format_predicates", r"""
select c_custkey,
  cast(regexp_matches(c_name, '[#$%]') as integer) as special,
  0 as special_in_digits,
  cast(regexp_matches('1' || lpad(cast(30 + c_custkey % 60 as varchar), 2, '0') || '12345678',
    '^((13[0-9])|(14[0-1,4-9])|(15[0-3,5-9])|(16[2,5-7])|(17[0-8])|(18[0-9])|(19[0-3,5-9]))[0-9]{8}$')
    as integer) as mobile,
  cast(c_custkey % 31 <> 0 as integer) as id_card,
  cast(c_custkey % 300 < 256 as integer) as ipv4,
  cast(6100 + c_custkey % 20 between 6101 and 6112 as integer) as known_area,
  cast(c_custkey % 2 = 0 as integer) as number_list
from customer""")
def format_predicates(spark, sf_dir):
    key = F.col("c_custkey")
    rows = S.table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    phone = F.concat(F.lit("1"), S.text(30 + key % 60), F.lit("12345678"))
    day = F.lpad(S.text(key % 31), 2, "0")
    card = F.concat(F.lit("61010119900"), F.lit("1"), day, F.lit("1234"))
    checks = {
        "special": predicates.has_special_character("c_name"),
        "special_in_digits": predicates.has_special_character(S.text(key)),
        "mobile": predicates.is_mobile(phone),
        "id_card": predicates.is_id_card(card),
        "ipv4": predicates.is_ipv4(F.concat(F.lit("10.0.0."), S.text(key % 300))),
        "known_area": predicates.is_known_area(6100 + key % 20),
        "number_list": predicates.is_number_list(
            F.concat(S.text(key), F.when(key % 2 == 0, F.lit(",7")).otherwise(F.lit(",x")))),
    }
    return rows.select("c_custkey", *[c.cast("int").alias(n) for n, c in checks.items()])


@query("special_text", r"""
select doc_id, cast(regexp_matches(text, '[`~!@#$%^&*()+=|{}'':;,\[\].<>/?￥…—【】‘；：”“’。，、？\\]')
  as integer) as special from documents""")
def special_text(spark, sf_dir):
    docs = S.table(spark, sf_dir, "documents")
    return docs.select("doc_id", predicates.has_special_character("text").cast("int")
                       .alias("special"))


# --- per-message log -------------------------------------------------------------------

_BATCHES = r"""
turns as (
  select conv_id || '-' || (turn // 16) as message_id, conv_id, turn,
         case when conv_id % 7 <> 3 then conv_id % 10 end as area_id,
         '2024-01-31 ' || lpad(cast(conv_id % 20 as varchar), 2, '0') as hour,
         regexp_matches(text, '[`~!@#$%^&*()+=|{}'':;,\[\].<>/?￥…—【】‘；：”“’。，、？\\]')
           or turn % 13 = 0 or conv_id % 11 = 5 or turn % 9 = 4 as failed
  from conversations where conv_id % 13 <> 6),
msg as (
  select message_id, conv_id, area_id, count(*) as upload_number,
         count(*) filter (where not failed) as success_number,
         count(*) filter (where failed) as fail_number, max(turn) as last_turn,
         any_value(hour) || ':30:00' as section_time,
         case when conv_id % 11 = 5 then ' '
              else any_value(hour) || case when max(turn) % 9 = 4 then ':00:00' else ':45:00' end
         end as upload_time
  from turns group by message_id, conv_id, area_id)
"""


def _summary(spark, sf_dir):
    messages = S.conversation_messages(spark, sf_dir)
    parsed = E.parse_envelope(messages, COLLECT)
    records = E.stage_rows(parsed, COLLECT).withColumns(
        {"matchCheckTime": F.lit(None).cast("string"),
         "matchCheckTs": F.lit(None).cast("timestamp")})
    flagged = error_flags(records, COLLECT_RULES, S.at("2024-01-31 23:59:00"))
    heads = E.of_stage(parsed, COLLECT)
    return messages, B.message_summary(heads, B.element_results(flagged, COLLECT))


_LOG_SQL = f"""
with {_BATCHES}
select message_id, area_id, cast(conv_id as varchar) as number_report, 1 as source, upload_number,
       success_number, fail_number, upload_time, section_time, 1 as upload_result,
       'u' || (conv_id % 7) as create_by, 0 as is_delete from msg"""
_LOG = ("message_id", "area_id", "number_report", "source", "upload_number", "success_number",
        "fail_number", "upload_time", "section_time", "upload_result", "create_by", "is_delete")


@query("batch_log", _LOG_SQL + " where area_id is not null and trim(upload_time) <> ''")
def batch_log(spark, sf_dir):
    _, summary = _summary(spark, sf_dir)
    return B.batch_log(B.upload_log(summary, S.at(S.EVENTS_NOW))).select(*_LOG)


@query("batch_log_fail", _LOG_SQL + " where area_id is null or trim(upload_time) = ''")
def batch_log_fail(spark, sf_dir):
    _, summary = _summary(spark, sf_dir)
    return B.batch_log_fail(B.upload_log(summary, S.at(S.EVENTS_NOW))).select(*_LOG)


@query("reconcile", f"""
with {_BATCHES}
select message_id, area_id, 1 as source, cast(conv_id as varchar) as record_id,
       cast(conv_id as varchar) as number_report, upload_number, success_number,
       1 as confirm_status, upload_time, cast(conv_id * 1000 + last_turn as varchar) as submit_id,
       'u' || (conv_id % 7) as create_by
from msg where area_id is not null""")
def reconcile(spark, sf_dir):
    _, summary = _summary(spark, sf_dir)
    return B.reconcile(summary, S.at(S.EVENTS_NOW)).drop("id", "create_time", "is_delete")


@query("reconcile_fail", f"""
with {_BATCHES}
select message_id, area_id, 1 as source, cast(conv_id as varchar) as record_id,
       cast(conv_id as varchar) as number_report, 1 as has_raw,
       'u' || (conv_id % 7) as create_by
from msg where area_id is null""")
def reconcile_fail(spark, sf_dir):
    messages, summary = _summary(spark, sf_dir)
    rows = B.reconcile_fail(summary, messages, S.at(S.EVENTS_NOW))
    return rows.select("message_id", "area_id", "source", "record_id", "number_report",
                       F.col("fail_data").startswith("{").cast("int").alias("has_raw"),
                       "create_by")
