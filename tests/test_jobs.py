import json
import time
from pathlib import Path

from pyspark.sql import functions as F

from messages import collect, envelope, frame, receive, report, transport
from tubetrace.operators import issues as I
from tubetrace.operators.rules import CATALOGUE
from tubetrace.plans import jobs, relation_queries, standins, stats
from tubetrace.sources.tables import KeyedTable


def at(text):
    return F.lit(text).cast("timestamp")


NOW = "2024-01-08 00:00:00"


def _matched(messages):
    stages = jobs.stage_frames(messages)
    return jobs.matched_stages(stages, jobs.relation_updates(stages))


def test_data_check_opens_and_resolves_issues(spark):
    late = {"interfaceRecTime": "2024-01-05 13:00:00"}
    bad = frame(spark, envelope("COLLECT_DATA", [collect(personName="#")]),
                envelope("REPORT_DATA", [report()]),
                envelope("COLLECT_DATA", [collect(personName="#")], **late))
    out = jobs.data_check(_matched(bad), at(NOW))
    issues = out["problem_data_cr"].collect()
    assert [(r.problem_record, r.is_valid) for r in issues] == [("C4", 0), ("C4", 0)]
    assert len({r.id for r in issues}) == 1 and issues[0].add_time == "2024-01-05 08:10:00"
    assert out["problem_data_tre"].count() == 0
    count = out["upload_log_prob"].first()
    assert (count.upload_number, count.cname_number, count.error_number) == (2, 2, 2)

    state = spark.createDataFrame(out["issue_state"].collect(), out["issue_state"].schema)
    fixed = frame(spark, envelope("COLLECT_DATA", [collect()]), envelope("REPORT_DATA", [report()]))
    again = jobs.data_check(_matched(fixed), at(NOW), stored=state)
    resolved = again["problem_data_cr"].collect()
    assert [(r.problem_record, r.is_valid, r.id) for r in resolved] == [("C4", 1, issues[0].id)]
    assert [r.is_open for r in again["issue_state"].collect()] == [False]

    # nothing is open any more: with reopening off, a new error stays apart
    state = spark.createDataFrame(again["issue_state"].collect(), state.schema)
    last = jobs.data_check(_matched(bad), at(NOW), stored=state, reopen=False)
    assert len({r.id for r in last["problem_data_cr"].collect()}) == 2


def test_transport_and_receive_issues_name_their_delivery(spark):
    messages = frame(
        spark, envelope("TRANSPORT_DATA", [transport(transportItem=[
            {"tubeCode": "t1"}, {"tubeCode": "lost"}])]),
        envelope("RECEIVE_DATA", [receive(tubeNum=5)]), envelope("COLLECT_DATA", [collect()]))
    out = jobs.data_check(_matched(messages), at(NOW))
    rows = out["problem_data_tre"].collect()
    assert {(r.source, r.problem_record, r.code, r.is_valid) for r in rows} == {
        (2, "TR6", "d1", 0), (3, "V5", "r1", 0)}
    assert set(out["problem_data_cr"].columns) == {
        *I.BASE_ISSUE_COLUMNS, "person_name", "person_id_card", "collect_time", "check_time"}


def test_report_log_counts_and_routes(spark):
    messages = frame(
        spark,
        envelope("COLLECT_DATA", [collect(), collect(personName="#", addTime="2024-01-05 09:00:00")]),
        envelope("REPORT_DATA", [report()]),
        envelope("COLLECT_DATA", []),
        envelope("COLLECT_DATA", [collect(areaId=None)]),
        envelope("RECEIVE_DATA", [receive(addTime="  ")]),
        envelope("TRANSPORT_DATA", [transport(transportItem=[{"tubeCode": "lost"}])]),
        envelope("OTHER", [collect()]))
    out = jobs.report_log(messages, _matched(messages), at(NOW))
    log = {r.message_id: (r.upload_number, r.success_number, r.fail_number, r.source)
           for r in out["upload_log"].collect()}
    assert log == {"m000": (2, 1, 1, 1), "m001": (1, 1, 0, 4), "m005": (1, 0, 1, 2)}
    first = out["upload_log"].filter("message_id = 'm000'").first()
    assert (first.upload_time, first.section_time) == ("2024-01-05 09:00:00", "2024-01-05 08:00:00")
    failed = {r.message_id: r.source for r in out["upload_log_fail"].collect()}
    assert failed == {"m002": None, "m003": 1, "m004": 3}
    good = {r.message_id: (r.record_id, r.submit_id) for r in out["upload_report"].collect()}
    assert good == {"m000": ("5", "1"), "m001": ("6", "2"), "m004": ("", "4"), "m005": ("", "3")}
    raw = {r.message_id: json.loads(r.fail_data)["type"]
           for r in out["upload_report_fail"].collect()}
    assert raw == {"m002": "COLLECT_DATA", "m003": "COLLECT_DATA"}


def test_hourly_summary_adds_up(spark):
    item = {"areaId": 1, "collectDate": "2024-01-05", "unitHour": 3, "collectPersons": 4}
    messages = frame(spark, envelope("HOUR_SUM_REPORT", [item, {**item, "collectPersons": 6}]),
                     envelope("HOUR_SUM_REPORT", [{**item, "areaId": None}]))
    log = jobs.hourly_summary(messages, F.lit(NOW)).orderBy("pos").collect()
    assert [(r.collect_persons, r.check_persons) for r in log] == [(4, 0), (10, 0)]
    assert len({r.id for r in log}) == 1


def _city_rows(spark, messages):
    matched = _matched(messages)
    now = at(NOW)
    reports = matched["report"].withColumn("isCollected", F.col("matchCollectTime").isNotNull())
    flag = {n: jobs.with_flags(r, jobs.CATALOGUE[n], now) for n, r in
            (("collect", matched["collect"]), ("report", reports))}
    return jobs.city_windows(flag["collect"], matched["transport"], matched["receive"],
                             flag["report"])


def test_city_rows_credit_the_collect_stage(spark):
    messages = frame(
        spark, envelope("COLLECT_DATA", [collect(), collect(tubeCode="t2", personIdCard="x")]),
        envelope("REPORT_DATA", [report()], interfaceRecTime="2024-01-05 12:10:00"),
        envelope("REPORT_DATA", [report(collectLocationCity="far", tubeCode="t9")],
                 interfaceRecTime="2024-01-05 12:10:00"),
        envelope("TRANSPORT_DATA", [transport()]))
    log = jobs.city_changelog(_city_rows(spark, messages)).orderBy("union_id", "window_end")
    rows = [(r.union_id, r.upload_number, r.success_number, r.tube_number) for r in log.collect()]
    assert rows == [
        ("6101___2_0_2024-01-05", 0, 0, 2),
        ("6101_c_d_1_0_2024-01-05", 0, 2, 2),
        ("6101_c_d_1_0_2024-01-05", 1, 2, 2),
        ("6101_c_d_4_0_2024-01-05", 0, 1, 1),
        ("6101_far_d_4_0_2024-01-05", 0, 1, 1)]


def test_distinct_counts_add_up_over_windows_and_days_split(spark):
    def seen(time):
        return envelope("COLLECT_DATA", [collect(), collect()], interfaceRecTime=time)

    messages = frame(spark, seen("2024-01-05 12:00:10"), seen("2024-01-05 12:02:00"),
                     seen("2024-01-05 12:03:00"), seen("2024-01-05 23:59:59"),
                     seen("2024-01-06 00:00:00"))
    rows = stats.today_stat(jobs.stage_frames(messages)["collect"], "collect")
    log = jobs.today_changelog(rows).orderBy("window_end").collect()
    assert [(r.union_id[-10:], r.success_number, r.fail_number, r.tube_number) for r in log] == [
        ("2024-01-05", 4, 1, 1), ("2024-01-05", 6, 2, 2), ("2024-01-05", 8, 3, 3),
        ("2024-01-06", 2, 1, 1)]
    assert [r.upload_hour_num for r in log] == [4, 6, 2, 2]


def test_stage_delay_mean_truncates(spark):
    def delayed(time):
        return collect(collectTime=time)

    messages = frame(
        spark, envelope("COLLECT_DATA", [delayed("2024-01-05 11:50:00"),
                                         delayed("2024-01-05 11:55:01"), delayed("bad")]),
        envelope("COLLECT_DATA", [delayed("2024-01-05 12:20:00"), delayed("2024-01-05 12:15:30")],
                 interfaceRecTime="2024-01-05 12:13:00"),
        envelope("COLLECT_DATA", [delayed(None)], interfaceRecTime="2024-01-05 13:00:00"))
    got = stats.stage_delay(jobs.stage_frames(messages)["collect"], "collect")
    # 10 and 4 minutes; -7 and -2; nothing known
    assert [(r.unit_hour, r.unit_minute, r.delay_avg) for r in
            got.orderBy("unit_hour", "unit_minute").collect()] == [
        (12, 0, 7), (12, 10, -4), (13, 0, None)]


def test_keyed_table_replaces_repeated_batches(spark, tmp_path):
    table = KeyedTable(str(tmp_path), ["k"], ["o"])

    def batch(*rows):
        return spark.createDataFrame(rows, "k string, o int, v int")

    assert table.latest(spark) is None
    table.write_batch(batch(("a", 1, 1), ("a", 2, 2), ("b", 1, 5)), 0)
    table.write_batch(batch(("a", 1, 7)), 1)
    table.write_batch(batch(("a", 1, 8)), 1)

    def held(before=None):
        return {r.k: r.v for r in table.latest(spark, before).collect()}

    assert held() == {"a": 8, "b": 5} and held(before=1) == {"a": 2, "b": 5}
    table.compact(spark)
    table.write_batch(batch(("c", 1, 9)), 2)
    assert held() == {"a": 8, "b": 5, "c": 9}
    assert held(before=1) == {"a": 2, "b": 5}
    (tmp_path / "delta" / "3").mkdir()  # a write that never finished
    assert held() == {"a": 8, "b": 5, "c": 9}


def test_both_outcomes_of_the_issue_rows_in_one_pass(spark):
    rows = frame(spark, envelope("COLLECT_DATA", [collect(personName="#")]),
                 envelope("REPORT_DATA", [report()]))
    records = jobs.check_records(_matched(rows), at(NOW))
    apart = I.issue_rows(records, 0).unionByName(I.issue_rows(records, 1))
    both = I.issue_rows(records)
    assert both.columns == apart.columns
    assert sorted(map(str, both.collect())) == sorted(map(str, apart.collect()))


def test_stage_counts_leave_little_behind(spark, tmp_path):
    """Neither the judged records nor the texts of loads are written."""
    day, home = "timestamp'2000-01-05'", str(tmp_path)
    spark.range(2000).selectExpr(
        "id as o_orderkey", "id % 300 as o_custkey", "'F' as o_orderstatus", "1.0 as o_totalprice",
        f"{day} as o_orderdate", "'LOW' as o_orderpriority").write.parquet(f"{home}/orders.parquet")
    spark.range(8000).selectExpr(
        "id div 4 as l_orderkey", "id % 70 as l_partkey", "id % 9 as l_suppkey",
        "cast(id % 4 as int) as l_linenumber", "'F' as l_linestatus",
        f"{day} as l_shipdate").write.parquet(f"{home}/lineitem.parquet")
    folder = Path(spark.sparkContext.getCheckpointDir().removeprefix("file:"))

    def held():
        return {f: f.stat().st_size for f in folder.rglob("*") if f.is_file()}

    before = held()
    counts = relation_queries.issue_stage_counts(spark, home)
    new = {f: n for f, n in held().items() if f not in before}
    assert counts.count() and 0 < sum(new.values()) < 500_000
    assert all("tables" in f.parts for f in new)


def _lines_and_orders(spark, home):
    spark.range(1500).selectExpr(
        "id as o_orderkey", "nullif(id % 300, 11) as o_custkey", "'F' as o_orderstatus",
        "1.0 as o_totalprice", "timestamp'2000-01-05' + make_interval(0, 0, 0, id % 3) as o_orderdate",
        "'LOW' as o_orderpriority").write.parquet(f"{home}/orders.parquet")
    spark.range(6000).selectExpr(
        "nullif(id div 4 + 30, 77) as l_orderkey", "nullif(id % 70, 9) as l_partkey",
        "nullif(id % 9, 3) as l_suppkey", "cast(id % 4 as int) as l_linenumber",
        "if(id % 5 < 3, 'F', 'O') as l_linestatus",
        "timestamp'2000-01-05' + make_interval(0, 0, 0, id % 4) as l_shipdate",
    ).write.parquet(f"{home}/lineitem.parquet")


def test_issue_stages_leave_no_shuffle_files(spark, tmp_path):
    """Each stage is written before the next one begins, and what it shuffled goes with it."""
    _lines_and_orders(spark, str(tmp_path))
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    folders = [Path(d.toString()) for d in disk.localDirs()]

    def shuffled():
        return {f for d in folders for f in d.rglob("shuffle_*")}

    before = shuffled()
    for issues in (relation_queries.issue_events, relation_queries.issue_stage_counts):
        rows = issues(spark, str(tmp_path))
        until = time.time() + 10  # the files are removed in the background
        while (left := shuffled() - before) and time.time() < until:
            time.sleep(.1)
        assert not left
        assert rows.count()


def test_stage_counts_leave_counts_only(spark, tmp_path):
    """Tables of the way, such as loads and relations, are removed behind it."""
    _lines_and_orders(spark, str(tmp_path))
    folder = Path(spark.sparkContext.getCheckpointDir().removeprefix("file:"))
    settings = dict(spark.conf.getAll)
    before = set(folder.rglob("*.parquet"))
    counts = relation_queries.issue_stage_counts(spark, str(tmp_path))
    assert dict(spark.conf.getAll) == settings
    tables = {f.parent for f in folder.rglob("*.parquet") if f not in before}
    assert len(tables) == 5
    assert all("upload_number" in spark.read.parquet(str(t)).columns for t in tables)
    assert {r.source for r in counts.collect()} == {1, 2, 3, 4}


def test_issue_stages_by_slices_of_the_deliveries(spark, tmp_path, monkeypatch):
    _lines_and_orders(spark, str(tmp_path))

    def found():
        return [sorted(map(str, issues(spark, str(tmp_path)).collect()))
                for issues in (relation_queries.issue_events, relation_queries.issue_stage_counts)]

    whole = found()
    monkeypatch.setattr(standins, "LINES_PER_SLICE", 1_500)
    assert standins.load_slices(spark, str(tmp_path))[0] == 4
    assert found() == whole


def test_rules_ahead_of_the_match_give_the_same_bits(spark):
    rows = frame(spark, envelope("COLLECT_DATA", [collect(personName="#"), collect(tubeCode="T9")]),
                 envelope("REPORT_DATA", [report(), report(checkTime=None),
                                          report(personIdCard=None), report(tubeCode="T8")]))
    for name, records in _matched(rows).items():
        ahead = I.judged_alone(records, CATALOGUE[name], at(NOW))
        once, twice = (I.judged(r, CATALOGUE[name], at(NOW)) for r in (records, ahead))
        assert once.columns == twice.columns
        assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))
        own = records.drop(*[c for c in records.columns if c.startswith(("match", "tubeCollect"))])
        assert own.columns != records.columns
        assert I.judged_alone(own, CATALOGUE[name], at(NOW)).count() == records.count()
