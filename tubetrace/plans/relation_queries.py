"""Queries of the relation tables, matches, lookups, rules, issues and ids."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import hash_id
from ..functions.times import whole_hours
from ..operators import identity
from ..operators import issues as I
from ..operators import relations as R
from ..operators.joins import lookup_join
from ..operators.repartition import slice_number
from ..operators.rules import CATALOGUE
from ..session import steps
from . import jobs
from . import standins as S
from .registry import (COL, DELIVERY, PERSON, REP, SE, TEXT, flags_as_numbers, good_id_sql,
                       query)

NOW_SQL = f"timestamp '{S.ORDERS_NOW}'"


def now():
    return S.at(S.ORDERS_NOW)


# --- relation tables -------------------------------------------------------------------

@query("relation_store_person", f"""
with {PERSON}
select person as "personIdCard", tube as "tubeCode", collect_time as "collectTime",
       check_time as "checkTime" from person_rel""")
def relation_store_person(spark, sf_dir):
    return S.person_table(spark, sf_dir).select(
        "personIdCard", "tubeCode", "collectTime", "checkTime")


@query("relation_store_tube", f"""
with {COL}
select tube as "tubeCode", collect_time as "tubeCollectTime", tube as "collectSubmitId"
from col""")
def relation_store_tube(spark, sf_dir):
    return S.tube_table(spark, sf_dir).select("tubeCode", "tubeCollectTime", "collectSubmitId")


@query("relation_store_delivery", f"""
with {DELIVERY}
select tra.code as "deliveryCode", strftime(delivery_ts, {TEXT}) as "deliveryTime",
       tra.tube_num as "tubeNum", tra.pack_num as "packNum",
       strftime(receive_ts, {TEXT}) as "receiveTime"
from tra left join rec on tra.code = rec.code""")
def relation_store_delivery(spark, sf_dir):
    return S.delivery_table(spark, sf_dir).select(
        "deliveryCode", "deliveryTime", "tubeNum", "packNum", "receiveTime")


@query("relation_store_ties", """
select cast(l_partkey % 500 as varchar) as "tubeCode",
       cast(arg_max(l_suppkey, place) as varchar) as "collectSubmitId",
       strftime(arg_max(l_shipdate + to_days(l_linenumber::integer), place), '%Y-%m-%d %H:%M:%S')
         as "tubeCollectTime"
from (select *, ((floor(epoch(l_shipdate) / 2592000)::hugeint * 10 + l_orderkey % 7) * 1000000000000
                 + l_orderkey) * 1000000 + l_linenumber * 10000 + l_suppkey % 10000 as place
      from lineitem)
group by l_partkey % 500""")
def relation_store_ties(spark, sf_dir):
    """Many writes to a key in one second (here: a month), partition and message."""
    lines = S.table(spark, sf_dir, "lineitem")
    month = F.floor(F.unix_seconds(F.col("l_shipdate").cast("timestamp")) / 2592000)
    rows = lines.select(
        S.text(F.col("l_partkey") % 500).alias("tubeCode"),
        F.timestamp_add("DAY", F.col("l_linenumber").cast("int"), F.col("l_shipdate").cast(
            "timestamp")).alias("collectTs"),
        F.col("l_suppkey").alias("submitId"), F.timestamp_seconds(month).alias("recTs"),
        F.concat_ws("-", F.lit("lines"), S.text(F.col("l_orderkey") % 7),
                    S.text("l_orderkey")).alias("message_id"),
        (F.col("l_linenumber") * 10000 + F.col("l_suppkey") % 10000).alias("pos"))
    return R.tube_relation(rows).select("tubeCode", "collectSubmitId", "tubeCollectTime")


# --- matches ---------------------------------------------------------------------------

@query("match_collect_report", f"""
with {PERSON}
select col.tube, col.person, cast(p.check_time is not null as integer) as matched,
       datesub('hour', collect_ts, p.check_ts) as gap_hours
from col left join person_rel p on p.person = col.person and p.tube = col.tube""")
def match_collect_report(spark, sf_dir):
    rows = R.match_collect_report(S.collect_records(spark, sf_dir), S.person_table(spark, sf_dir))
    return rows.select(
        F.col("tubeCode").alias("tube"), F.col("personIdCard").alias("person"),
        F.col("matchCheckTime").isNotNull().cast("int").alias("matched"),
        whole_hours("collectTs", "matchCheckTs").alias("gap_hours"))


@query("match_report_collect", f"""
with {COL}, {REP}
select l_orderkey, l_partkey, l_linenumber, cast(col.tube is not null as integer) as matched,
       datesub('hour', rep.collect_ts, rep.check_ts) as gap_hours
from rep left join col on rep.person = col.person and rep.tube = col.tube""")
def match_report_collect(spark, sf_dir):
    person = R.person_relation(
        S.collect_records(spark, sf_dir),
        S.report_records(spark, sf_dir).withColumn("message_id", F.col("tubeCode")),
        order=("recTs", "message_id"))
    rows = R.match_report_collect(S.report_records(spark, sf_dir), person)
    return rows.select(
        "l_orderkey", "l_partkey", "l_linenumber",
        F.col("matchCollectTime").isNotNull().cast("int").alias("matched"),
        whole_hours("collectTs", "checkTs").alias("gap_hours"))


@query("match_receive_transport", f"""
with {DELIVERY}
select rec.code, cast(tra.code is not null as integer) as matched,
       cast(rec.tube_num <> tra.tube_num as integer) as tube_differs,
       cast(rec.pack_num <> tra.pack_num as integer) as pack_differs
from rec left join tra on rec.code = tra.code""")
def match_receive_transport(spark, sf_dir):
    rows = R.match_receive_transport(S.receive_records(spark, sf_dir),
                                     S.delivery_table(spark, sf_dir),
                                     S.load_partitions(spark, sf_dir))
    return rows.select(
        F.col("deliveryCode").alias("code"),
        F.col("matchDeliveryTime").isNotNull().cast("int").alias("matched"),
        (F.col("tubeNum") != F.col("matchTubeNum")).cast("int").alias("tube_differs"),
        (F.col("packNum") != F.col("matchPackNum")).cast("int").alias("pack_differs"))


@query("match_transport_receive", f"""
with {DELIVERY}
select tra.code, cast(rec.code is not null as integer) as matched,
       strftime(receive_ts, {TEXT}) as receive_time
from tra left join rec on rec.code = tra.code""")
def match_transport_receive(spark, sf_dir):
    rows = R.match_transport_receive(S.transport_records(spark, sf_dir),
                                     S.delivery_table(spark, sf_dir),
                                     S.load_partitions(spark, sf_dir))
    return rows.select(
        F.col("deliveryCode").alias("code"),
        F.col("matchReceiveTime").isNotNull().cast("int").alias("matched"),
        F.col("matchReceiveTime").alias("receive_time"))


_TUBES = f"""{COL}, {DELIVERY},
tubes as (
  select tra.*, rec.receive_ts, item_pos, cast(tra.l_orderkey + item_pos as varchar) as tube,
         col.collect_ts as tube_ts
  from tra left join rec on rec.code = tra.code cross join (values (0), (1)) as i(item_pos)
  left join col on col.tube = cast(tra.l_orderkey + item_pos as varchar))"""


@query("match_tubes_collect", f"""
with {_TUBES}
select code, item_pos, tube, cast(tube_ts is not null as integer) as matched,
       strftime(tube_ts, {TEXT}) as collect_time
from tubes""")
def match_tubes_collect(spark, sf_dir):
    rows = R.match_tubes_collect(S.transport_records(spark, sf_dir), S.tube_table(spark, sf_dir))
    return rows.select(
        F.col("deliveryCode").alias("code"), F.col("itemPos").alias("item_pos"),
        F.col("tubeCode").alias("tube"),
        F.col("tubeCollectTime").isNotNull().cast("int").alias("matched"),
        F.col("tubeCollectTime").alias("collect_time"))


@query("upload_number", f"""
with {REP}
select rep.district as "collectLocationDistrict",
       count(distinct case when o_orderkey is not null then rep.person || '_' || rep.tube end)
         as upload_number
from rep left join (select o_orderkey from orders where o_orderstatus = 'F') f
  on f.o_orderkey = rep.l_orderkey
group by rep.district""")
def upload_number(spark, sf_dir):
    finished = S.table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "F").select(
        S.text("o_orderkey").alias("tubeCode"))
    collected = S.collect_records(spark, sf_dir).join(finished, "tubeCode", "left_semi")
    return R.upload_number(S.report_records(spark, sf_dir), collected,
                           ["collectLocationDistrict"])


# --- lookups ---------------------------------------------------------------------------

@query("lookup_org", """
select l_orderkey, l_partkey, l_linenumber, s_suppkey as org_code
from lineitem left join supplier on s_suppkey = l_suppkey and s_suppkey % 10 <> 3""")
def lookup_org(spark, sf_dir):
    dim = S.table(spark, sf_dir, "supplier").filter(F.col("s_suppkey") % 10 != 3).select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("org_name"))
    # the same name under a second id must not multiply rows
    dim = dim.unionByName(dim.withColumn("id", F.col("id") + 1_000_000_000))
    lines = S.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber",
        F.concat(F.lit("Supplier#"), F.lpad(S.text("l_suppkey"), 9, "0")).alias("org_name"))
    return jobs.with_org_code(lines, dim).drop("org_name")


@query("lookup_client", f"""
with {SE}
select event_id, client_id, coalesce(n_name, '') as report_client
from se left join nation on n_nationkey = client_id and n_nationkey < 20""")
def lookup_client(spark, sf_dir):
    rows = S.table(spark, sf_dir, "events").select(
        "event_id", (F.col("user_id") % 25).alias("client_id"))
    dim = S.table(spark, sf_dir, "nation").filter("n_nationkey < 20").select(
        F.col("n_nationkey").cast("bigint").alias("client_id"), F.col("n_name").alias("client_name"))
    return jobs.with_client_name(rows, dim)


@query("lookup_large_dimension", """
select l_orderkey, l_partkey, l_linenumber, o_orderpriority
from lineitem left join orders on o_orderkey = l_orderkey""")
def lookup_large_dimension(spark, sf_dir):
    lines = S.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    dim = S.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority")
    return lookup_join(lines, dim, ["l_orderkey"])


# --- rules -----------------------------------------------------------------------------

def _known_deliveries(delivery):
    """Receive records only know the transport records of even orders."""
    return delivery.filter(F.split("deliveryCode", "-")[0].cast("bigint") % 2 == 0)


def _checked(spark, sf_dir, stage):
    if stage == "collect":
        return R.match_collect_report(S.collect_records(spark, sf_dir),
                                      S.person_table(spark, sf_dir))
    if stage == "report":
        return R.match_report_collect(S.report_records(spark, sf_dir),
                                      S.person_table(spark, sf_dir))
    delivery = S.delivery_table(spark, sf_dir)
    if stage == "receive":
        return R.match_receive_transport(S.receive_records(spark, sf_dir),
                                         _known_deliveries(delivery))
    return R.match_transport_receive(S.transport_records(spark, sf_dir), delivery)


_COLLECT_SQL = f"""
cm as (
  select col.*, p.check_time, p.check_ts
  from col left join person_rel p on p.person = col.person and p.tube = col.tube),
collect_issues as (
  select tube, person, area_id, district, rule_code, problem_type, kind,
         case when case rule_code
           when 'C1' then cust % 50 = 7
           when 'C2' then cust % 4 = 1
           when 'C3' then o_orderkey % 7 = 0 or o_orderkey % 11 = 0
           when 'C4' then cust % 10 = 0
           when 'C5' then add_ts < collect_ts
           else check_ts is null or epoch(check_ts) - epoch(collect_ts) > 86400 end
         then 0 else 1 end as is_valid
  from cm, (values ('C1', '1', 2), ('C2', '3', 2), ('C3', '7', 2), ('C4', '2', 2),
                   ('C5', '6', 2), ('C6', '4', 1)) as r(rule_code, problem_type, kind)
  where rule_code <> 'C6' or epoch({NOW_SQL}) - epoch(collect_ts) >= 86400)
"""


@query("validate_collect", f"""
with {PERSON}, {_COLLECT_SQL}
select tube, rule_code, problem_type, kind, is_valid from collect_issues""")
def validate_collect(spark, sf_dir):
    rows = I.validate(_checked(spark, sf_dir, "collect"), CATALOGUE["collect"], now())
    return rows.select(F.col("tubeCode").alias("tube"), "rule_code", "problem_type",
                       F.col("issue_kind").alias("kind"), "is_valid")


_HOURS = "(epoch(check_ts) - epoch(collect_ts))"
_REPORT_SQL = f"""
report_issues as (
  select rep.*, rule_code, problem_type, kind,
         case when case rule_code
           when 'R1' then not {good_id_sql("cust")}
           when 'R2' then not coalesce(cust % 4 = 0, false)
           when 'R3' then cust % 10 = 0
           when 'R4' then pack_ts < collect_ts
           when 'R5' then receive_ts < collect_ts
           when 'R6' then check_ts < collect_ts
           when 'R7' then {_HOURS} < 3600
           when 'R8' then epoch(pack_ts) - epoch(collect_ts) < 120
           when 'R9' then epoch(check_ts) - epoch(receive_ts) < 1200
           when 'R10' then check_ts < pack_ts
           when 'R11' then add_ts < check_ts
           when 'R12' then check_ts < receive_ts
           when 'R13' then l_partkey % 9 = 0 or l_partkey % 13 = 0
           when 'R14' then person is null
           when 'R15' then collect_ts > check_ts
           when 'R16' then {_HOURS} > 86400 end
         then 0 else 1 end as is_valid
  from rep, (values ('R1', '1', 2), ('R2', '3', 2), ('R3', '2', 2), ('R4', '6', 2),
                    ('R5', '6', 2), ('R6', '6', 2), ('R7', '6', 2), ('R8', '6', 2),
                    ('R9', '6', 2), ('R10', '6', 2), ('R11', '6', 2), ('R12', '6', 2),
                    ('R13', '7', 2), ('R14', '5', 1), ('R15', '6', 2), ('R16', '6', 2))
            as r(rule_code, problem_type, kind)
  where person is not null or rule_code not in ('R15', 'R16'))
"""


@query("validate_report", f"""
with {REP}, {_REPORT_SQL}
select l_orderkey, l_partkey, l_linenumber, rule_code, problem_type, kind, is_valid
from report_issues""")
def validate_report(spark, sf_dir):
    rows = I.validate(_checked(spark, sf_dir, "report"), CATALOGUE["report"], now())
    return rows.select("l_orderkey", "l_partkey", "l_linenumber", "rule_code", "problem_type",
                       F.col("issue_kind").alias("kind"), "is_valid")


_TRANSPORT_SQL = f"""
{_TUBES}, tm as (
  select tra.*, receive_ts from tra left join rec on rec.code = tra.code),
transport_issues as (
  select code, l_orderkey, l_suppkey, -1 as item_pos, 'TR1' as rule_code, '6' as problem_type,
         2 as kind, case when delivery_ts < pack_ts then 0 else 1 end as is_valid from tm
  union all
  select code, l_orderkey, l_suppkey, -1, 'TR2', '7', 1,
         case when receive_ts is null or epoch(receive_ts) - epoch(delivery_ts) > 86400
              then 0 else 1 end
  from tm
  where receive_ts is not null or epoch({NOW_SQL}) - epoch(delivery_ts) >= 86400
  union all
  select code, l_orderkey, l_suppkey, item_pos, rule_code, '6', 2,
         case rule_code
           when 'TR3' then case when pack_ts < tube_ts then 0 else 1 end
           when 'TR4' then case when delivery_ts < tube_ts then 0 else 1 end
           else case when epoch(delivery_ts) - epoch(tube_ts) > 86400 then 0 else 1 end end
  from tubes, (values ('TR3'), ('TR4'), ('TR5')) as r(rule_code)
  where receive_ts is not null and tube_ts is not null
  union all
  select code, l_orderkey, l_suppkey, item_pos, 'TR6', '9', 1,
         case when tube_ts is null then 0 else 1 end
  from tubes
  where receive_ts is not null
    and (tube_ts is null) = (epoch({NOW_SQL}) - epoch(delivery_ts) >= 86400))
"""


def _transport_candidates(spark, sf_dir):
    matched = _checked(spark, sf_dir, "transport")
    records = I.validate(matched, CATALOGUE["transport"], now())
    received = I.tube_records(matched)
    tubes = I.validate_tubes(R.match_tubes_collect(received, S.tube_table(spark, sf_dir)), now())
    return records, tubes


@query("validate_transport", f"""
with {_TRANSPORT_SQL}
select code, item_pos, rule_code, problem_type, kind, is_valid from transport_issues""")
def validate_transport(spark, sf_dir):
    records, tubes = _transport_candidates(spark, sf_dir)
    both = records.withColumn("itemPos", F.lit(-1)).unionByName(tubes, allowMissingColumns=True)
    return both.select(F.col("deliveryCode").alias("code"), F.col("itemPos").alias("item_pos"),
                       "rule_code", "problem_type", F.col("issue_kind").alias("kind"), "is_valid")


_RECEIVE_SQL = f"""
receive_issues as (
  select rec.code, rec.l_orderkey, rec.l_suppkey, rule_code, problem_type, kind,
         case rule_code
           when 'V1' then case when {good_id_sql("rec.l_suppkey")} then 1 else 0 end
           when 'V2' then case when rec.l_suppkey % 4 = 0 then 1 else 0 end
           when 'V3' then case when rec.l_orderkey % 4 = 0 then 1 else 0 end
           when 'V4' then case when {good_id_sql("rec.l_orderkey")} then 1 else 0 end
           when 'V5' then case when rec.tube_num <> tra.tube_num then 0 else 1 end
           when 'V6' then case when rec.pack_num <> tra.pack_num then 0 else 1 end
           when 'V7' then case when epoch({NOW_SQL}) - epoch(delivery_ts) > 86400
                                and epoch(receive_ts) - epoch(delivery_ts) > 86400
                               then 0 else 1 end
           when 'V8' then case when tra.code is null then 0 else 1 end end as is_valid
  from rec left join tra on tra.code = rec.code and tra.l_orderkey % 2 = 0,
       (values ('V1', '1', 2), ('V2', '2', 2), ('V3', '4', 2), ('V4', '3', 2),
               ('V5', '5', 2), ('V6', '5', 2), ('V7', '6', 2), ('V8', '8', 1))
         as r(rule_code, problem_type, kind)
  where tra.code is not null or rule_code <= 'V4'
     or (rule_code = 'V8' and epoch({NOW_SQL}) - epoch(receive_ts) >= 86400))
"""


@query("validate_receive", f"""
with {DELIVERY}, {_RECEIVE_SQL}
select code, rule_code, problem_type, kind, is_valid from receive_issues""")
def validate_receive(spark, sf_dir):
    rows = I.validate(_checked(spark, sf_dir, "receive"), CATALOGUE["receive"], now())
    return rows.select(F.col("deliveryCode").alias("code"), "rule_code", "problem_type",
                       F.col("issue_kind").alias("kind"), "is_valid")


@query("validation_summary", f"""
with {PERSON}, {_COLLECT_SQL}
select district as "collectLocationDistrict", count(*) filter (where bad or unsync) as problem_number,
       count(*) filter (where bad) as problem_error, count(*) filter (where unsync) as problem_unsync
from (select tube, district, bool_or(is_valid = 0 and kind = 2) as bad,
             bool_or(is_valid = 0 and kind = 1) as unsync
      from collect_issues group by tube, district)
group by district""")
def validation_summary(spark, sf_dir):
    flagged = I.error_flags(_checked(spark, sf_dir, "collect"), CATALOGUE["collect"], now())
    return I.validation_summary(flagged, ["collectLocationDistrict"])


_ISSUES_SQL = f"""{COL}, {REP}, {DELIVERY}, tubes as (
  select tra.*, rec.receive_ts, item_pos, cast(tra.l_orderkey + item_pos as varchar) as tube,
         col.collect_ts as tube_ts
  from tra left join rec on rec.code = tra.code cross join (values (0), (1)) as i(item_pos)
  left join col on col.tube = cast(tra.l_orderkey + item_pos as varchar)),
person_rel as (
  select c.person, c.tube, c.collect_time, r.check_time, r.check_ts
  from (select person, tube, max(collect_time) as collect_time from col group by all) c
  left join (select person, tube, max(check_time) as check_time, max(check_ts) as check_ts
             from rep group by all) r on c.person = r.person and c.tube = r.tube),
{_COLLECT_SQL}, {_REPORT_SQL}, {_TRANSPORT_SQL[_TRANSPORT_SQL.index("tm as ("):]}, {_RECEIVE_SQL},
issues as (
  select 1 as source, area_id, problem_type, kind, rule_code, is_valid,
         cast(tube as bigint) as submit_id from collect_issues
  union all
  select 4, area_id, problem_type, kind, rule_code, is_valid, l_orderkey from report_issues
  union all
  select 2, l_suppkey % 10, problem_type, kind, rule_code, is_valid, l_orderkey
  from transport_issues
  union all
  select 3, l_suppkey % 10, problem_type, kind, rule_code, is_valid, l_orderkey
  from receive_issues)"""


SLICE = "_slice"


def _issue_stages(spark, sf_dir, result):
    """``result`` of the judged records of each stage, together. Stage after stage is matched,
    judged and written, so that the shuffle files on disk are those of one stage; deliveries
    are gone through slice by slice. Rules that need no match run ahead of it. Loads, receipts
    and relations are written once for the stages that look at them and removed behind them."""
    found = []

    def done(step, stage, matched, parts):
        records = jobs.check_records({stage: matched}, now(), rules={stage: CATALOGUE[stage]})
        found.append(step(result(records), parts, kept=True))

    def alone(records, stage):
        return I.judged_alone(records, CATALOGUE[stage], now())

    parts = S.load_partitions(spark, sf_dir)
    with steps(spark) as step:
        person = step(S.person_table(spark, sf_dir), parts)
        done(step, "collect", R.match_collect_report(
            alone(S.collect_records(spark, sf_dir), "collect"), person), parts)
        done(step, "report", R.match_report_collect(
            alone(S.report_records(spark, sf_dir), "report"), person), parts)

    slices, some = S.load_slices(spark, sf_dir)
    with steps(spark) as step:
        def by_slice(loads):
            number = slice_number(S.delivery_code(), slices)
            return step(loads.withColumn(SLICE, number), parts, by=SLICE)

        sent, got = by_slice(S.sent_loads(spark, sf_dir)), by_slice(S.got_loads(spark, sf_dir))
        tubes = step(S.tube_table(spark, sf_dir), parts)
        for k in range(slices):
            _deliveries(spark, sf_dir, sent.filter(F.col(SLICE) == k),
                        got.filter(F.col(SLICE) == k), tubes, some, alone, done)
    return reduce(DataFrame.unionByName, found)


def _deliveries(spark, sf_dir, sent, got, tubes, parts, alone, done):
    """The stages of a slice of the deliveries."""
    sent, got = S.transport_records(spark, sf_dir, sent), S.receive_records(spark, sf_dir, got)
    with steps(spark) as step:
        delivery = step(S.delivery_table(spark, sf_dir, sent, got, parts), parts)
        done(step, "receive", R.match_receive_transport(
            alone(got, "receive"), _known_deliveries(delivery)), parts)
        done(step, "transport", R.match_transport_receive(alone(sent, "transport"), delivery),
             parts)
        received = I.tube_records(R.match_transport_receive(sent, delivery))
        done(step, "tube", R.match_tubes_collect(received, tubes), parts)


@query("issue_events", f"""
with {_ISSUES_SQL}
select source, area_id, submit_id, kind as "TYPE", problem_type, rule_code as problem_record,
       is_valid, 0 as is_delete, 'loader' as create_by, '{S.ORDERS_NOW}' as create_time
from issues where is_valid = 0""")
def issue_events(spark, sf_dir):
    columns = ["source", "area_id", "submit_id", "is_delete", "create_by", "create_time"]
    failed = _issue_stages(spark, sf_dir, lambda records: records.select(
        *columns, "failed_rules", "first_rule", "last_rule"))
    return I.issue_rows(failed, 0).select(
        "source", "area_id", "submit_id", "TYPE", "problem_type", "problem_record", "is_valid",
        "is_delete", "create_by", "create_time")


_COUNTERS_SQL = """
count(*) as upload_number,
count(*) filter (where is_valid = 1) as success_number,
count(*) filter (where bad and source = 1 and problem_type = '4') as fail_number,
count(*) filter (where bad and source = 4 and problem_type = '5') as fail_end_number,
count(*) filter (where bad and problem_type <= '4') as error_number,
count(*) filter (where bad and source = 1 and problem_type = '1') as cid_number,
count(*) filter (where bad and source = 1 and problem_type = '2') as cname_number,
count(*) filter (where bad and source = 1 and problem_type = '3') as cphone_number,
count(*) filter (where bad and source = 4 and problem_type = '1') as rid_number,
count(*) filter (where bad and source = 4 and problem_type = '2') as rname_number,
count(*) filter (where bad and source = 4 and problem_type = '3') as rphone_number,
count(*) filter (where bad and problem_type = '6') as time_number,
count(*) filter (where bad and source = 3 and problem_type = '1') as tr_id_number,
count(*) filter (where bad and source = 3 and problem_type = '2') as tr_phone_number,
count(*) filter (where bad and source = 3 and problem_type = '3') as re_id_number,
count(*) filter (where bad and source = 3 and problem_type = '4') as re_phone_number
"""


def _event_issues(spark, sf_dir):
    """Events as issue rows, so that every problem type and stage occurs over many days."""
    event, user = F.col("event_id"), F.col("user_id")
    rows = S.table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    return rows.select(
        "event_id", (user % 10).alias("area_id"), (event % 4 + 1).cast("int").alias("source"),
        S.text(event % 9 + 1).alias("problem_type"), (event % 5 == 0).cast("int").alias("is_valid"),
        S.format_time(F.col("ts").cast("timestamp")).alias("create_time"))


_EVENT_ISSUES = f"""ei as (
  select event_id, user_id % 10 as area_id, cast(event_id % 4 + 1 as integer) as source,
         cast(event_id % 9 + 1 as varchar) as problem_type, event_id % 5 <> 0 as bad,
         cast(event_id % 5 = 0 as integer) as is_valid,
         strftime(ts, '%Y-%m-%d') || ' 00:00:00' as upload_time
  from events)"""


@query("issue_daily_counts", f"""
with {_EVENT_ISSUES}
select area_id, source, upload_time, {_COUNTERS_SQL} from ei group by area_id, source, upload_time
""")
def issue_daily_counts(spark, sf_dir):
    return I.issue_daily_counts(_event_issues(spark, sf_dir))


@query("issue_stage_counts", f"""
with {_ISSUES_SQL}
select area_id, source, upload_time, {_COUNTERS_SQL}
from (select *, is_valid = 0 as bad, '{S.ORDERS_NOW}' as upload_time from issues
      where area_id is not null)
group by area_id, source, upload_time""")
def issue_stage_counts(spark, sf_dir):
    return I.added_counts(_issue_stages(
        spark, sf_dir, lambda records: I.issue_daily_counts(I.issue_rows(records))))


@query("issue_daily_changelog", f"""
with {_EVENT_ISSUES}
select event_id, area_id, source, upload_time, {_COUNTERS_SQL.replace(" as ", " over w as ")}
from ei
window w as (partition by area_id, source, upload_time order by event_id rows unbounded preceding)
""")
def issue_daily_changelog(spark, sf_dir):
    log = I.issue_daily_changelog(_event_issues(spark, sf_dir), ["event_id"])
    return log.select("event_id", "area_id", "source", "upload_time", *I.daily_counters())


def _lifecycle_candidates(spark, sf_dir):
    rows = S.table(spark, sf_dir, "events").filter(F.col("event_type").isin("error", "purchase"))
    return rows.select("event_id", "user_id", "event_type",
                       S.format_time(F.col("ts").cast("timestamp")).alias("add_time"))


_LIFE_SQL = f"""
c as (
  select event_id, user_id, event_type, strftime(ts, {TEXT}) as add_time,
         event_type = 'error' as is_error,
         lag(event_type) over (partition by user_id order by event_id) as before
  from events where event_type in ('error', 'purchase'))"""


@query("issue_lifecycle", f"""
with {_LIFE_SQL}, s as (
  select *, is_error and coalesce(before, '') <> 'error' as start from c),
n as (
  select *, cast(sum(cast(start as integer)) over w as bigint) as issue_number,
         last_value(case when start then add_time end ignore nulls) over w as issue_add_time
  from s window w as (partition by user_id order by event_id rows unbounded preceding))
select event_id, user_id, event_type, add_time, issue_number, issue_add_time,
       cast(is_error as integer) as issue_open
from n where is_error or before = 'error'""")
def issue_lifecycle(spark, sf_dir):
    return flags_as_numbers(I.issue_lifecycle(
        _lifecycle_candidates(spark, sf_dir), ["user_id"], ["event_id"],
        F.col("event_type") == "error", "add_time"))


@query("issue_lifecycle_no_reopen", f"""
with {_LIFE_SQL}, f as (
  select user_id, min(event_id) as first_error from c where is_error group by user_id),
x as (
  select user_id, min(event_id) as closing from c join f using (user_id)
  where not is_error and event_id > first_error group by user_id),
n as (
  select c.*, first_error, closing,
         is_error and (event_id = first_error or event_id > closing) as start
  from c left join f using (user_id) left join x using (user_id)),
m as (
  select *, cast(sum(cast(start as integer)) over w as bigint) as issue_number,
         last_value(case when start then add_time end ignore nulls) over w as issue_add_time
  from n window w as (partition by user_id order by event_id rows unbounded preceding))
select event_id, user_id, event_type, add_time, issue_number, issue_add_time,
       cast(is_error and (closing is null or event_id < closing) as integer) as issue_open
from m where is_error or event_id = closing""")
def issue_lifecycle_no_reopen(spark, sf_dir):
    return flags_as_numbers(I.issue_lifecycle(
        _lifecycle_candidates(spark, sf_dir), ["user_id"], ["event_id"],
        F.col("event_type") == "error", "add_time", reopen=False))


# --- ids -------------------------------------------------------------------------------

@query("assign_ids", f"""
with {COL}, m as (
  select person, collect_time, row_number() over (order by person, collect_time) as id
  from (select distinct person, collect_time from col))
select o_orderkey, id from col join m using (person, collect_time)""")
def assign_ids(spark, sf_dir):
    keys = identity.BUSINESS_KEYS["COLLECT_DATA"]
    rows = S.collect_records(spark, sf_dir).select("submitId", *keys)
    id_map = identity.extend_id_map(None, rows, keys)
    return identity.assign_mapped_ids(rows, id_map, keys).select(
        F.col("submitId").alias("o_orderkey"), "id")


@query("assign_tube_ids", """
with m as (select k, row_number() over (order by k) as id from (
  select distinct cast(l_orderkey as varchar) as k from lineitem where l_linestatus = 'F')),
n as (select k, row_number() over (order by k) + (select max(id) from m) as id from (
  select distinct cast(l_orderkey as varchar) as k from lineitem
  where cast(l_orderkey as varchar) not in (select k from m)))
select k as "tubeCode", id from m union all select k, id from n""")
def assign_tube_ids(spark, sf_dir):
    lines = S.table(spark, sf_dir, "lineitem").select(
        S.text("l_orderkey").alias("tubeCode"), "l_linestatus")
    first = identity.extend_id_map(None, lines.filter("l_linestatus = 'F'"), ["tubeCode"])
    return identity.extend_id_map(first, lines, ["tubeCode"])


@query("assign_hash_ids", """
select cast(l_orderkey as varchar) as "tubeCode", count(*) as rows_of_key, 1 as ids, 1 as in_range
from lineitem group by l_orderkey""")
def assign_hash_ids(spark, sf_dir):
    lines = S.table(spark, sf_dir, "lineitem").select(S.text("l_orderkey").alias("tubeCode"))
    rows = lines.withColumn("id", hash_id("TRANSPORT_TUBE", "tubeCode"))
    return rows.groupBy("tubeCode").agg(
        F.count("*").alias("rows_of_key"),
        (F.min("id") == F.max("id")).cast("int").alias("ids"),
        (F.min("id") >= 0).cast("int").alias("in_range"))


@query("dedup_by_key", """
select l_orderkey, l_partkey, min(l_linenumber) as l_linenumber
from lineitem group by l_orderkey, l_partkey""")
def dedup_by_key(spark, sf_dir):
    lines = S.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    return identity.dedup_by_key(lines, ["l_orderkey", "l_partkey"], ["l_linenumber"])
