"""Each rule: a passing, a failing, a missing and a boundary case."""

import pytest
from pyspark.sql import functions as F

from messages import SECRET, collect, envelope, frame, receive, report, transport
from tubetrace.functions.crypto import encrypt_columns
from tubetrace.operators import envelope as E
from tubetrace.operators import issues as I
from tubetrace.operators import relations as R
from tubetrace.operators.rules import CATALOGUE
from tubetrace.schemas import STAGES

NOW = "2024-01-06 08:00:00"  # a day after the collection of the fixtures

TAGS = {"collect": ("COLLECT_DATA", collect), "report": ("REPORT_DATA", report),
        "transport": ("TRANSPORT_DATA", transport), "receive": ("RECEIVE_DATA", receive)}

# match columns of a record whose counterpart is there and fits
MATCH = {
    "collect": {"matchCheckTime": "2024-01-05 10:00:00"},
    "report": {"matchCollectTime": "2024-01-05 08:00:00"},
    "receive": {"matchDeliveryTime": "2024-01-05 08:40:00", "matchTubeNum": 2, "matchPackNum": 1},
    "transport": {"matchReceiveTime": "2024-01-05 09:00:00"},
    "tube": {"matchReceiveTime": "2024-01-05 09:00:00", "tubeCollectTime": "2024-01-05 08:00:00",
             "collectSubmitId": "9"},
}

# stage, rule, changes to the record, changes to the match, expected outcome
CASES = [
    ("collect", "C1", {}, {}, 1),
    ("collect", "C1", {"personIdCard": "61#"}, {}, 0),
    ("collect", "C1", {"personIdCard": ""}, {}, 1),
    ("collect", "C1", {"personIdCard": None}, {}, 1),
    ("collect", "C2", {"personPhone": "139-0"}, {}, 1),
    ("collect", "C2", {"personPhone": "139;0"}, {}, 0),
    ("collect", "C3", {"collectCount": 0}, {}, 0),
    ("collect", "C3", {"collectLimitnum": None}, {}, 0),
    ("collect", "C3", {"collectCount": 2}, {}, 1),
    ("collect", "C4", {"personName": "A（b"}, {}, 1),
    ("collect", "C4", {"personName": "王。"}, {}, 0),
    ("collect", "C5", {"addTime": "2024-01-05 07:59:59"}, {}, 0),
    ("collect", "C5", {"addTime": "2024-01-05 08:00:00"}, {}, 1),
    ("collect", "C5", {"addTime": None}, {}, 1),
    ("collect", "C6", {}, {}, 1),
    ("collect", "C6", {}, {"matchCheckTime": None}, 0),
    ("collect", "C6", {"collectTime": "2024-01-05 08:00:01"}, {"matchCheckTime": None}, None),
    ("collect", "C6", {}, {"matchCheckTime": "2024-01-06 08:00:00"}, 1),
    ("collect", "C6", {}, {"matchCheckTime": "2024-01-06 08:00:01"}, 0),
    ("collect", "C6", {"collectTime": "bad"}, {"matchCheckTime": None}, None),
    ("report", "R1", {}, {}, 1),
    ("report", "R1", {"personIdCard": "123"}, {}, 0),
    ("report", "R1", {"personIdCard": None}, {}, 0),
    ("report", "R1", {"personIdCard": "610101900101123"}, {}, 1),
    ("report", "R2", {"personPhone": "12912345678"}, {}, 0),
    ("report", "R2", {}, {}, 1),
    ("report", "R3", {"personName": "<b>"}, {}, 0),
    ("report", "R3", {"personName": None}, {}, 1),
    ("report", "R4", {"packTime": "2024-01-05 07:00:00"}, {}, 0),
    ("report", "R4", {"packTime": " "}, {}, 1),
    ("report", "R5", {"receiveTime": "2024-01-05 07:00:00"}, {}, 0),
    ("report", "R5", {}, {}, 1),
    ("report", "R6", {"checkTime": "2024-01-05 07:59:59"}, {}, 0),
    ("report", "R6", {"checkTime": None}, {}, 1),
    ("report", "R7", {"checkTime": "2024-01-05 09:00:00"}, {}, 1),
    ("report", "R7", {"checkTime": "2024-01-05 08:59:59"}, {}, 0),
    ("report", "R7", {"checkTime": "2024-01-0509:00:00"}, {}, 1),
    ("report", "R8", {"packTime": "2024-01-05 08:02:00"}, {}, 1),
    ("report", "R8", {"packTime": "2024-01-05 08:01:59"}, {}, 0),
    ("report", "R9", {"checkTime": "2024-01-05 09:20:00"}, {}, 1),
    ("report", "R9", {"checkTime": "2024-01-05 09:19:59"}, {}, 0),
    ("report", "R10", {"packTime": "2024-01-05 10:00:01"}, {}, 0),
    ("report", "R10", {"packTime": None}, {}, 1),
    ("report", "R11", {"addtime": "2024-01-05 09:59:59"}, {}, 0),
    ("report", "R11", {"addtime": "2024-01-05 10:00:00"}, {}, 1),
    ("report", "R12", {"receiveTime": "2024-01-05 10:00:01"}, {}, 0),
    ("report", "R12", {"receiveTime": None}, {}, 1),
    ("report", "R13", {"collectLimitnum": 0}, {}, 0),
    ("report", "R13", {}, {}, 1),
    ("report", "R14", {}, {"matchCollectTime": None}, 0),
    ("report", "R14", {}, {}, 1),
    ("report", "R15", {"checkTime": "2024-01-05 07:00:00"}, {}, 0),
    ("report", "R15", {"checkTime": "2024-01-05 07:00:00"}, {"matchCollectTime": None}, None),
    ("report", "R16", {"checkTime": "2024-01-06 08:00:00"}, {}, 1),
    ("report", "R16", {"checkTime": "2024-01-06 08:00:01"}, {}, 0),
    ("receive", "V1", {}, {}, 1),
    ("receive", "V1", {"deliveryPrpId": None}, {}, 0),
    ("receive", "V2", {"deliveryPrpPhone": "1"}, {}, 0),
    ("receive", "V3", {"transportPrpPhone": "1"}, {}, 0),
    ("receive", "V3", {}, {}, 1),
    ("receive", "V4", {"transportPrpId": "61010119900100123X"}, {}, 0),
    ("receive", "V4", {"transportPrpId": "61010119900101123X"}, {}, 1),
    ("receive", "V5", {"tubeNum": 3}, {}, 0),
    ("receive", "V5", {"tubeNum": "2"}, {}, 1),
    ("receive", "V5", {}, {"matchPackNum": None}, None),
    ("receive", "V6", {"packNum": None}, {}, 0),
    ("receive", "V6", {}, {}, 1),
    ("receive", "V7", {"receiveTime": "2024-01-06 08:40:00"},
     {"matchDeliveryTime": "2024-01-05 07:59:59"}, 0),
    ("receive", "V7", {"receiveTime": "2024-01-06 08:40:00"}, {}, 1),
    ("receive", "V8", {}, {}, 1),
    ("receive", "V8", {"receiveTime": "2024-01-05 08:00:00"},
     {"matchDeliveryTime": None, "matchTubeNum": None, "matchPackNum": None}, 0),
    ("receive", "V8", {"receiveTime": "2024-01-05 08:00:01"},
     {"matchDeliveryTime": None, "matchTubeNum": None, "matchPackNum": None}, None),
    ("receive", "V8", {}, {"matchTubeNum": None}, None),
    ("transport", "TR1", {"packTime": "2024-01-05 08:40:01"}, {}, 0),
    ("transport", "TR1", {"packTime": None}, {}, 1),
    ("transport", "TR2", {}, {}, 1),
    ("transport", "TR2", {}, {"matchReceiveTime": "2024-01-06 08:40:00"}, 1),
    ("transport", "TR2", {}, {"matchReceiveTime": "2024-01-06 08:40:01"}, 0),
    ("transport", "TR2", {"deliveryTime": "2024-01-05 08:00:00"}, {"matchReceiveTime": None}, 0),
    ("transport", "TR2", {"deliveryTime": "2024-01-05 08:00:01"}, {"matchReceiveTime": None}, None),
    ("tube", "TR3", {"packTime": "2024-01-05 07:59:59"}, {}, 0),
    ("tube", "TR3", {}, {}, 1),
    ("tube", "TR3", {}, {"collectSubmitId": None}, None),
    ("tube", "TR4", {"deliveryTime": "2024-01-05 07:00:00"}, {}, 0),
    ("tube", "TR4", {}, {}, 1),
    ("tube", "TR5", {"deliveryTime": "2024-01-06 08:00:00"}, {}, 1),
    ("tube", "TR5", {"deliveryTime": "2024-01-06 08:00:01"}, {}, 0),
    ("tube", "TR6", {}, {}, 1),
    ("tube", "TR6", {"deliveryTime": "2024-01-05 08:00:00"}, {}, None),
    ("tube", "TR6", {"deliveryTime": "2024-01-05 08:00:00"}, {"tubeCollectTime": None}, 0),
    ("tube", "TR6", {}, {"tubeCollectTime": None}, None),
]

_MATCH_TYPES = {"matchTubeNum": "int", "matchPackNum": "int"}


def _outcomes(spark, stage):
    """Outcome of every case of a stage in one run, by case number."""
    record_stage = "transport" if stage == "tube" else stage
    tag, make = TAGS[record_stage]
    cases = [(n, c) for n, c in enumerate(CASES) if c[0] == stage]
    values = [envelope(tag, [make(**c[2])]) for _, c in cases]
    rows = E.stage_from_messages(frame(spark, *values), STAGES[record_stage])
    fields = list(MATCH[stage])
    match = spark.createDataFrame(
        [(f"m{i:03d}", n, c[1], *[{**MATCH[stage], **c[3]}[f] for f in fields])
         for i, (n, c) in enumerate(cases)],
        "message_id string, case int, rule string, "
        + ", ".join(f"{f} {_MATCH_TYPES.get(f, 'string')}" for f in fields))
    times = {f.removesuffix("Time") + "Ts": F.try_to_timestamp(f, F.lit("yyyy-MM-dd HH:mm:ss"))
             for f in fields if f.endswith("Time")}
    joined = rows.join(match.withColumns(times), "message_id")
    found = I.validate(joined, CATALOGUE[stage], F.lit(NOW).cast("timestamp"))
    return {r.case: r.is_valid for r in found.filter("rule_code = rule").collect()}


@pytest.mark.parametrize("stage", list(CATALOGUE))
def test_rules(spark, stage):
    got = _outcomes(spark, stage)
    wrong = [(n, c, got.get(n)) for n, c in enumerate(CASES)
             if c[0] == stage and got.get(n) != c[4]]
    assert not wrong


def test_every_rule_has_cases():
    covered = {c[1] for c in CASES}
    assert {r.code for rules in CATALOGUE.values() for r in rules} == covered


def test_encrypted_values_are_checked_in_clear_text(spark):
    values = [envelope("REPORT_DATA", [report()]),
              envelope("REPORT_DATA", [report(personPhone="12")])]
    rows = E.stage_from_messages(frame(spark, *values), STAGES["report"])
    sealed = encrypt_columns(rows, ["personIdCard", "personName", "personPhone"], SECRET)
    matched = sealed.withColumn("matchCollectTime", F.lit(None).cast("string"))
    now = F.lit(NOW).cast("timestamp")
    got = I.validate(matched, CATALOGUE["report"], now, SECRET)
    result = {(r.message_id, r.rule_code): r.is_valid for r in got.collect()}
    assert [result["m000", c] for c in ("R1", "R2", "R3")] == [1, 1, 1]
    assert result["m001", "R2"] == 0
    # without the key nothing can be read: format rules fail, nothing throws
    other = I.validate(matched, CATALOGUE["report"], now, type(SECRET)(b"k" * 16, b"v" * 16))
    assert {r.is_valid for r in other.filter("rule_code = 'R1'").collect()} == {0}


def test_flags_agree_with_the_candidates(spark):
    values = [envelope("COLLECT_DATA", [collect(personName="#"), collect(collectCount=0)]),
              envelope("COLLECT_DATA", [collect()])]
    rows = E.stage_from_messages(frame(spark, *values), STAGES["collect"])
    matched = rows.withColumns({"matchCheckTime": F.lit(None).cast("string"),
                                "matchCheckTs": F.lit(None).cast("timestamp")})
    now = F.lit(NOW).cast("timestamp")
    flags = I.error_flags(matched, CATALOGUE["collect"], now).orderBy("message_id", "pos")
    assert [(r.hasError, r.hasBadData, r.hasMissingStage, r.hasNameError)
            for r in flags.collect()] == [
        (True, True, True, True), (True, True, True, False), (True, False, True, False)]


def test_relation_tables_keep_the_latest_value(spark):
    messages = frame(
        spark,
        envelope("COLLECT_DATA", [collect()]),
        envelope("COLLECT_DATA", [collect(collectTime="2024-01-05 08:05:00", submitId=77)],
                 interfaceRecTime="2024-01-05 13:00:00"),
        envelope("COLLECT_DATA", [collect(collectTime="bad")],
                 interfaceRecTime="2024-01-05 14:00:00"),
        envelope("REPORT_DATA", [report()]), envelope("TRANSPORT_DATA", [transport()]),
        envelope("RECEIVE_DATA", [receive()]))
    stages = {n: E.stage_from_messages(messages, s) for n, s in STAGES.items()}
    person = R.person_relation(stages["collect"], stages["report"]).collect()
    assert [(r.collectTime, r.checkTime) for r in person] == [
        ("2024-01-05 08:05:00", "2024-01-05 10:00:00")]
    tube = R.tube_relation(stages["collect"]).first()
    assert (tube.tubeCollectTime, tube.collectSubmitId) == ("2024-01-05 08:05:00", "1")
    delivery = R.delivery_relation(stages["transport"], stages["receive"]).first()
    assert (delivery.tubeNum, delivery.packNum, delivery.deliveryTime, delivery.receiveTime) == (
        2, 1, "2024-01-05 08:40:00", "2024-01-05 09:00:00")


def test_only_numbers_are_exploded_and_named_afterwards(spark):
    rows = E.stage_from_messages(
        frame(spark, envelope("REPORT_DATA", [report(personName="#")])), STAGES["report"])
    matched = rows.withColumn("matchCollectTime", F.lit(None).cast("string"))
    now = F.lit(NOW).cast("timestamp")
    found = I.validate(matched, CATALOGUE["report"], now)
    want = {(r.code, r.problem_type, r.kind) for r in CATALOGUE["report"]
            if r.code not in ("R15", "R16")}  # these say nothing without a collect record
    assert {(r.rule_code, r.problem_type, r.issue_kind) for r in found.collect()} == want
    failed = I.validate(matched, CATALOGUE["report"], now, only=0).collect()
    assert sorted(r.rule_code for r in failed) == ["R14", "R3"]
    # a function called per record and rule would not be compiled
    assert "lambdafunction" not in found._jdf.queryExecution().optimizedPlan().toString()
