import json

from pyspark.sql import functions as F

from messages import SECRET, collect, envelope, frame, receive, report, transport
from tubetrace.functions.crypto import decrypt, encrypt
from tubetrace.operators import envelope as E
from tubetrace.plans import ingest_queries, jobs
from tubetrace.schemas import COLLECT, RECEIVE, REPORT, TRANSPORT
from tubetrace.sources import messages as M


def test_malformed_messages_are_set_aside_and_never_fail(spark):
    values = ["", "   ", "{broken", "[1, 2]", "17", envelope(None, []), envelope("", []),
              envelope("SOMETHING", []), envelope("COLLECT_DATA", []),
              envelope("hour_sum_report", [])]
    messages = frame(spark, *values)
    got = {r.message_id: r.reason for r in E.quarantine_messages(messages).collect()}
    assert got == {"m000": "blank", "m001": "blank", "m002": "malformed", "m003": "malformed",
                   "m004": "malformed", "m005": "missing_type", "m006": "missing_type",
                   "m007": "unknown_type"}
    assert E.route_by_type(E.parse_envelope(messages)).count() == 1


def test_numbers_may_be_quoted_and_bad_times_become_null(spark):
    messages = frame(
        spark,
        envelope("COLLECT_DATA", [collect(areaId="6101", collectTime="2021-11-2214:50:53")]),
        envelope("COLLECT_DATA", [collect(areaId=6101), collect(areaId="x")], numberReport=222))
    rows = E.stage_from_messages(messages, COLLECT).orderBy("message_id", "pos").collect()
    assert [r.areaId for r in rows] == [6101, 6101, None]
    assert [r.numberReport for r in rows] == [111111, 222, 222]
    assert rows[0].collectTs is None and rows[0].collectTime == "2021-11-2214:50:53"
    assert str(rows[1].collectTs) == "2024-01-05 08:00:00"


def test_both_spellings_of_the_upload_time(spark):
    messages = frame(
        spark, envelope("TRANSPORT_DATA", [transport()]), envelope("RECEIVE_DATA", [receive()]),
        envelope("XA_REPORT_DATA", [report(remark='say "addtime": no')]))
    assert E.stage_from_messages(messages, TRANSPORT).first().addTime == "2024-01-05 08:45:00"
    assert E.stage_from_messages(messages, RECEIVE).first().addTime == "2024-01-05 09:05:00"
    row = E.stage_from_messages(messages, REPORT).first()
    assert row.addTime == "2024-01-05 11:00:00" and row.remark == 'say "addtime": no'


def test_empty_and_missing_data_give_no_rows(spark):
    messages = frame(spark, envelope("COLLECT_DATA", []), envelope("COLLECT_DATA", None))
    assert E.stage_from_messages(messages, COLLECT).count() == 0


def test_hourly_type_in_any_case(spark):
    item = {"areaId": 1, "collectDate": "2024-01-05", "unitHour": 3, "collectPersons": 4}
    messages = frame(spark, envelope("HOUR_SUM_REPORT", [item]),
                     envelope("Hour_Sum_Report", [item, item]), envelope("COLLECT_DATA", [item]))
    rows = E.hourly_summary_rows(messages, F.lit("2024-01-06 00:00:00")).collect()
    assert len(rows) == 3 and {r.createBy for r in rows} == {"lab-1"}


def test_result_codes(spark):
    rows = spark.createDataFrame([("1",), ("2",), ("3",), ("",), (None,)], "v string")
    got = [r.v for r in rows.select(E.decode_result("v").alias("v")).collect()]
    assert got == ["阴性", "阳性", "3", "", None]


def test_encryption_round_trip_and_bad_cipher_text(spark):
    rows = spark.createDataFrame([("Ann",), ("王",), ("",), (None,)], "v string")
    sealed = rows.select("v", encrypt("v", SECRET).alias("s"))
    for r in sealed.select("v", "s", decrypt("s", SECRET).alias("d")).collect():
        assert r.d == r.v
        assert r.v is None or len(r.s) == 24
    bad = spark.createDataFrame([("plain",), ("!!",), ("QUJD",)], "s string")
    assert {r[0] for r in bad.select(decrypt("s", SECRET)).collect()} == {None}


def test_enriched_messages_keep_ids_across_messages(spark):
    other = envelope("OTHER", [{"x": 1}])
    messages = frame(
        spark, envelope("COLLECT_DATA", [collect(), collect(tubeCode="t2"), collect(personIdCard="q")]),
        envelope("COLLECT_DATA", [collect(personName="Bea")]),
        envelope("REPORT_DATA", [report()]), envelope("XA_REPORT_DATA", [report()]),
        envelope("TRANSPORT_DATA", [transport()]), envelope("RECEIVE_DATA", [receive()]), other)
    out = [json.loads(r.value) if r.type != "OTHER" else r.value
           for r in jobs.enrich_messages(messages).orderBy("message_id").collect()]
    first, second, rep, xa, tra, rec, unknown = out
    ids = [e["id"] for e in first["data"]]
    # person and time make the key: the tube does not
    assert ids[0] == ids[1] != ids[2] and second["data"][0]["id"] == ids[0]
    assert rep["data"][0]["id"] != xa["data"][0]["id"]
    assert rep["data"][0]["checkResult"] == "阴性"
    tube = tra["data"][0]["transportItem"][0]
    assert tube["id"] >= 0 and tube["id"] != rec["data"][0]["receivesItem"][0]["id"]
    assert tra["data"][0]["areaId"] == 6101 and tra["numberReport"] == "111111"
    assert unknown == other
    again = jobs.enrich_messages(jobs.enrich_messages(messages).select("message_id", "value"))
    redone = json.loads(again.orderBy("message_id").first().value)
    assert [e["id"] for e in redone["data"]] == ids


def test_enriched_messages_keep_what_the_producer_wrote(spark):
    org = {"creditCode": "c", "areaId": 6101, "orgName": "o", "locationCity": "x",
           "checkAbility": 12.5}
    odd = collect(collectCount="n/a", note={"deep": [1, None, "é"]}, none=None)
    tubes = transport(transportItem=[{"tubeCode": "t1", "box": 4}, {"packCode": "k"}])
    messages = frame(spark, envelope("CHECK_ORG", [org], station="s9"),
                     envelope("COLLECT_DATA", [odd]), envelope("TRANSPORT_DATA", [tubes]),
                     envelope("TRANSPORT_DATA", [transport(transportItem="text")]),
                     envelope("collect_data", [collect()]),
                     envelope("COLLECT_DATA", [collect(personIdCard=None, id=77)]))
    before = [json.loads(r.value) for r in messages.orderBy("message_id").collect()]
    after = [json.loads(r.value)
             for r in jobs.enrich_messages(messages).orderBy("message_id").collect()]
    assert isinstance(after[0]["data"][0].pop("id"), int)
    assert isinstance(after[1]["data"][0].pop("id"), int)
    for n in (2, 3):
        assert isinstance(after[n]["data"][0].pop("id"), int)
    assert after[2]["data"][0]["transportItem"][0].pop("id") >= 0
    # no tube code, no id; a tag in another spelling is no known type; no key, no new id
    assert after == before


def test_a_bad_nested_field_becomes_null_and_nothing_is_lost(spark):
    values = [envelope("TRANSPORT_DATA", [transport(transportItem="text"), transport()]),
              envelope("COLLECT_DATA", [collect(transportItem=5)]),
              envelope("COLLECT_DATA", "text"), envelope("COLLECT_DATA", [collect(), 3]),
              "{", " ", envelope("", []), envelope("OTHER", [])]
    messages = frame(spark, *values)
    read = E.read_messages(messages)
    good = {r.message_id for r in E.accepted(read).collect()}
    bad = {r.message_id: r.reason for r in E.rejected(read).collect()}
    assert good == {"m000", "m001"} and len(bad) == 6
    assert bad == {r.message_id: r.reason for r in E.quarantine_messages(messages).collect()}
    rows = E.stage_from_messages(messages, TRANSPORT).orderBy("pos").collect()
    assert [r.transportItem and r.transportItem[0].tubeCode for r in rows] == [None, "t1"]


def test_text_source_gives_equal_lines_different_ids(spark, tmp_path):
    (tmp_path / "in.txt").write_text("a\na\nb\n")
    rows = M.read_text(spark, str(tmp_path)).collect()
    assert len({r.message_id for r in rows}) == 3
    assert sorted(r.value for r in rows) == ["a", "a", "b"]


def test_topic_options():
    options = M.kafka_options("h:1", "t", "latest")
    assert options["startingOffsets"] == "latest" and options["subscribe"] == "t"
    assert M.topic_sink_options("h:1", "t")["kafka.max.request.size"] == "10485760"


def test_enriched_messages_are_neither_broadcast_nor_met_in_one_task(spark, tmp_path):
    spark.range(40).selectExpr(
        "id as event_id", "timestamp'2024-01-05 12:00:00' as ts", "id % 4 as user_id",
        "array('view', 'signup', 'click', 'error')[cast(id % 4 as int)] as event_type",
        "1.5 as value", "concat('{\"k\": ', id % 3, '}') as props",
    ).write.parquet(f"{tmp_path}/events.parquet")
    rows = ingest_queries.enriched_messages(spark, str(tmp_path))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "hashpartitioning" in plan
    # each window splits the rows without an id
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("xxhash64(message_id") >= 2
    found = rows.collect()
    assert len(found) == 80 and {r.is_else_unchanged for r in found} == {1}
    assert {r.first_of_id for r in found if r.type == "PAGE_VIEW"} == {None}
    assert all(r.first_of_id is not None for r in found if r.type != "PAGE_VIEW")
