"""Streams against the batch result over the same messages, with a restart in between."""

import os

import pytest
from pyspark.sql import functions as F

from messages import collect, envelope, frame, report
from tubetrace.operators import envelope as E
from tubetrace.operators import relations as R
from tubetrace.operators.windows import WindowStat, stream_windowed_stats
from tubetrace.plans import catalog, jobs, stats, stream_queries  # noqa: F401
from tubetrace.schemas import COLLECT, REPORT
from tubetrace.sources import messages as M
from tubetrace.sources import tables
from tubetrace.sources.tables import KeyedTable
from tubetrace.streaming import runner
from tubetrace.streaming.state import stream_issues

ONCE = {"availableNow": True}


@pytest.fixture(autouse=True)
def only_data_batches(spark):
    # state with a life time asks for another batch for ever; a finite run must not
    name = "spark.sql.streaming.noDataMicroBatches.enabled"
    spark.conf.set(name, "false")
    yield
    spark.conf.unset(name)


def _put(spark, folder, number, *values):
    messages = frame(spark, *values).withColumn(
        "message_id", F.concat(F.lit(f"{number}-"), "message_id"))
    messages.coalesce(1).write.mode("append").parquet(folder)


def _run(start):
    query = start()
    assert query.awaitTermination(150), "the stream did not end"
    return query


SENTINEL = envelope("REPORT_DATA", [report(areaId=1)], interfaceRecTime="2024-01-09 00:00:00")
LAST = envelope("REPORT_DATA", [report(areaId=2)], interfaceRecTime="2024-01-10 00:00:00")


def test_gap_stream_equals_batch_and_survives_a_restart(spark, tmp_path):
    folder, checkpoint = str(tmp_path / "in"), str(tmp_path / "cp")
    table = KeyedTable(str(tmp_path / "out"), ["union_id"], ["window_end"])

    def start():
        source = M.stream_message_table(spark, folder, 1)
        rows = runner.stream_gap(E.stage_from_messages(source, REPORT), delay="3 minutes")
        return runner.start_changelog(rows, table, checkpoint, ONCE)

    def message(time, *checks):
        return envelope("REPORT_DATA", [report(checkTime=c) for c in checks],
                        interfaceRecTime=time)

    ten, noon = "2024-01-05 10:00:00", "2024-01-05 12:30:00"
    first = [message("2024-01-05 12:00:00", ten, ten), message("2024-01-05 12:02:59", ten, noon)]
    second = [message("2024-01-05 12:03:00", ten), message("2024-01-05 12:07:00", noon)]
    _put(spark, folder, 1, *first)
    _run(start)
    _put(spark, folder, 2, *second)
    _run(start)
    _put(spark, folder, 3, SENTINEL)
    _put(spark, folder, 4, LAST)
    _run(start)

    messages = frame(spark, *first, *second)
    batch = jobs.gap_changelog(stats.gap_histogram(E.stage_from_messages(messages, REPORT)))
    want = sorted((r.union_id, r.check_persons, r.create_time) for r in batch.collect())
    log = table.changelog(spark).filter("area_id = 6101").collect()
    assert sorted((r.union_id, r.check_persons, r.create_time) for r in log) == want
    assert {r.union_id: r.check_persons for r in table.latest(spark).collect()
            if r.area_id == 6101} == {"6101_2024-01-05_2": 4, "6101_2024-01-05_4": 2}


def test_today_stream_counts_distinct_and_hours_like_batch(spark, tmp_path):
    folder = str(tmp_path / "in")
    table = KeyedTable(str(tmp_path / "out"), ["union_id"], ["window_end"])

    def seen(time, *tubes):
        return envelope("COLLECT_DATA", [collect(tubeCode=t, personIdCard=t[0]) for t in tubes],
                        interfaceRecTime=time)

    values = [seen("2024-01-05 12:00:10", "a1", "a2", "a1"), seen("2024-01-05 12:02:00", "a1"),
              seen("2024-01-05 12:03:00", "b1", "a1"), seen("2024-01-05 13:00:00", "c1")]
    for n, value in enumerate(values):
        _put(spark, folder, n, value)
    _put(spark, folder, 8, envelope("COLLECT_DATA", [collect(areaId=1)],
                                    interfaceRecTime="2024-01-09 00:00:00"))
    _put(spark, folder, 9, envelope("COLLECT_DATA", [collect(areaId=2)],
                                    interfaceRecTime="2024-01-10 00:00:00"))

    def rows_of(source, aggregate):
        return stats.today_stat(E.stage_from_messages(source, COLLECT), "collect",
                                aggregate=aggregate)

    source = M.stream_message_table(spark, folder, 1)
    stages = {"collect": E.stage_from_messages(source, COLLECT)}
    changelog = runner.stream_today(stages, delay="3 minutes")
    _run(lambda: runner.start_changelog(changelog, table, str(tmp_path / "cp"), ONCE))
    columns = ("union_id", "success_number", "fail_number", "tube_number", "upload_hour_num",
               "fail_hour_num")
    batch = jobs.today_changelog(rows_of(frame(spark, *values), stats.windowed_stats))
    got = table.changelog(spark).filter("area_id = 6101")
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(
        map(tuple, batch.select(*columns).collect()))


def test_issue_stream_follows_an_issue_over_batches(spark, tmp_path):
    folder = str(tmp_path / "in")
    steps = [[(1, 0), (2, 0)], [(3, 1), (4, 1)], [(5, 0), (6, 1)]]
    for batch in steps:
        rows = [("k", i, valid, i * 10, f"t{i}") for i, valid in batch]
        (spark.createDataFrame(rows, "issue_key string, i int, is_valid int, id bigint, "
                                     "add_time string").coalesce(1)
         .write.mode("append").parquet(folder))
    schema = "issue_key string, i int, is_valid int, id bigint, add_time string"
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    out = stream_issues(source, "issue_key", ["i"])
    query = (out.writeStream.format("memory").queryName("issues").outputMode("append")
             .option("checkpointLocation", str(tmp_path / "cp")).trigger(**ONCE).start())
    assert query.awaitTermination(150)
    got = spark.sql("select i, id, add_time, issue_number from issues order by i").collect()
    assert [tuple(r) for r in got] == [
        (1, 10, "t1", 1), (2, 10, "t1", 1), (3, 10, "t1", 1), (5, 50, "t5", 2), (6, 50, "t5", 2)]


def test_message_stream_writes_all_tables_and_repeats_without_double_counting(spark, tmp_path):
    stores = runner.Stores(str(tmp_path / "stores"))
    step = runner.message_step(stores, now=lambda: F.lit("2024-01-08 00:00:00").cast("timestamp"))
    hour = {"areaId": 1, "collectDate": "2024-01-05", "unitHour": 3, "collectPersons": 4}
    first = frame(spark, envelope("COLLECT_DATA", [collect(personName="#")]),
                  envelope("HOUR_SUM_REPORT", [hour]))
    second = frame(spark, envelope("REPORT_DATA", [report()]),
                   envelope("HOUR_SUM_REPORT", [hour, hour])).withColumn(
        "message_id", F.concat(F.lit("n"), "message_id"))
    step(first, 0)
    step(second, 1)
    step(second, 1)
    person = stores.relation("person").latest(spark).collect()
    assert [(r.collectTime, r.checkTime) for r in person] == [
        ("2024-01-05 08:00:00", "2024-01-05 10:00:00")]
    hourly = stores.sink("hour_sum_report").latest(spark).collect()
    assert [r.collect_persons for r in hourly] == [12]
    records = {r.problem_record for r in stores.sink("problem_data_cr").latest(spark).collect()}
    assert records == {"C4", "C6"}
    counts = stores.sink("upload_log_prob").latest(spark).collect()
    assert [(r.source, r.upload_number) for r in counts] == [(1, 2)]
    assert stores.sink("upload_log").latest(spark).count() == 2


def test_all_windowed_jobs_build_on_a_stream(spark, tmp_path):
    folder = str(tmp_path / "in")
    _put(spark, folder, 1, SENTINEL)
    stages = jobs.stage_frames(M.stream_message_table(spark, folder))
    no_relations = jobs.relation_updates(jobs.stage_frames(frame(spark, SENTINEL)))
    matched = jobs.matched_stages(stages, no_relations)
    collected = {"collect": stages["collect"], "report": matched["report"].withColumn(
        "isCollected", F.col("matchCollectTime").isNotNull())}
    orgs = spark.createDataFrame([(1, "org")], "id bigint, org_name string")
    clients = spark.createDataFrame([(7, "c")], "client_id bigint, client_name string")
    now = F.lit("2024-01-10 00:00:00").cast("timestamp")
    late = {"delay": "10 minutes"}
    built = {
        "upload_log_city": runner.stream_city(matched, jobs.CATALOGUE, now, **late),
        "upload_log_org": runner.stream_org(stages, orgs, **late),
        "data_time_delay": runner.stream_delay(stages, clients, now, **late),
        "delay_avg": runner.stream_stage_delay(stages, **late),
        "upload_log_hour": runner.stream_hour(collected, **late),
        "upload_log_time": runner.stream_today(stages, **late),
        "upload_log_checkhour": runner.stream_gap(stages["report"], **late),
    }
    for table, rows in built.items():
        sink = runner.Stores(str(tmp_path)).sink(table)
        assert rows.isStreaming
        assert {*sink.keys, *sink.order} <= set(rows.columns), table
    windows = {
        "upload_log_city": lambda s: jobs.city_changelog(jobs.city_windows(
            *[jobs.with_flags(s[n], jobs.CATALOGUE[n], now) if n in ("collect", "report") else s[n]
              for n in ("collect", "transport", "receive", "report")])),
        "upload_log_org": lambda s: jobs.org_changelog(
            jobs.with_org_code(jobs.org_windows(s), orgs)),
        "data_time_delay": lambda s: jobs.delay_changelog(
            jobs.with_client_name(jobs.delay_windows(s, now=now), clients)),
        "delay_avg": jobs.stage_delays,
        "upload_log_hour": lambda s: jobs.hour_changelog(jobs.hour_windows(
            {"collect": s["collect"], "report": s["report"]})),
        "upload_log_time": lambda s: jobs.today_changelog(jobs.today_windows(s)),
        "upload_log_checkhour": lambda s: jobs.gap_changelog(stats.gap_histogram(s["report"])),
    }
    batch = jobs.stage_frames(frame(spark, SENTINEL))
    known = jobs.matched_stages(batch, no_relations)
    known["report"] = known["report"].withColumn("isCollected", F.lit(True))
    for table, of in windows.items():
        assert {*of(known).columns} == {*built[table].columns}, table


def test_windows_and_late_rows_together_are_all_rows(spark, tmp_path):
    folder, stores = str(tmp_path / "in"), runner.Stores(str(tmp_path / "stores"))

    def message(minute, n):
        return envelope("REPORT_DATA", [report()] * n,
                        interfaceRecTime=f"2024-01-05 12:{minute:02}:00")

    # the third is late by 20 minutes, the fourth by 5, which is allowed
    for n, value in enumerate([message(0, 2), message(30, 1), message(10, 4), message(25, 3),
                               SENTINEL, LAST]):
        _put(spark, folder, n, value)
    source = M.stream_message_table(spark, folder, 1)
    _run(lambda: runner.start_intake(source, stores, "10 minutes", str(tmp_path / "c1"), ONCE))
    table = KeyedTable(str(tmp_path / "out"), ["union_id"], ["window_end"])
    rows = runner.stream_gap(runner.stage_stream(spark, stores, "report"), delay="10 minutes")
    _run(lambda: runner.start_changelog(rows, table, str(tmp_path / "c2"), ONCE))
    # a file source takes all files at once: the watermark follows with the next batch
    _put(spark, folder, 9, LAST)
    _run(lambda: runner.start_intake(source, stores, "10 minutes", str(tmp_path / "c1"), ONCE))
    _run(lambda: runner.start_changelog(rows, table, str(tmp_path / "c2"), ONCE))
    late = stores.late("report").changelog(spark)
    assert [r.pos for r in late.orderBy("pos").collect()] == [0, 1, 2, 3]
    counted = table.latest(spark).filter("area_id = 6101").agg(F.sum("check_persons")).first()[0]
    assert counted + late.count() == 10


def test_windows_on_arrival_time_lose_nothing(spark, tmp_path):
    folder = str(tmp_path / "in")
    table = KeyedTable(str(tmp_path / "out"), ["union_id"], ["window_end"])
    for n, time in enumerate(("2024-01-05 12:00:00", "2024-01-05 13:00:00",
                              "2024-01-05 11:00:00")):
        _put(spark, folder, n, envelope("REPORT_DATA", [report()], interfaceRecTime=time))
    rows = stats.gap_histogram(
        E.stage_from_messages(M.stream_message_table(spark, folder, 1), REPORT),
        aggregate=runner._aggregate("1 second", "arrival"))
    query = (rows.writeStream.outputMode("append").format("memory").queryName("arrived")
             .option("checkpointLocation", str(tmp_path / "cp")).trigger(**ONCE).start())
    assert query.awaitTermination(150)
    dropped = [o["numRowsDroppedByWatermark"] for p in query.recentProgress
               for o in p["stateOperators"]]
    assert sum(dropped) == 0
    assert sum(p["numInputRows"] for p in query.recentProgress) == 3


def test_rows_without_a_time_count_on_arrival(spark, tmp_path):
    folder = str(tmp_path / "in")
    _put(spark, folder, 1, *[envelope("REPORT_DATA", [report()], interfaceRecTime=t)
                             for t in ("2024-01-05 12:00:00", "no time", None)])
    rows = E.stage_from_messages(M.stream_message_table(spark, folder), REPORT)
    stat = WindowStat("1 second", {"area_id": F.col("areaId")}, {"n": F.lit(1)})
    counted = stream_windowed_stats(rows, "recTs", stat, runner.ROW_ID, "1 second", "arrival")
    query = (counted.writeStream.outputMode("update").format("memory").queryName("untimed")
             .option("checkpointLocation", str(tmp_path / "cp")).trigger(**ONCE).start())
    assert query.awaitTermination(150)
    assert spark.sql("select sum(n) from untimed").first()[0] == 3


def test_stores_are_folded_and_batches_keep_their_time(spark, tmp_path):
    stores = runner.Stores(str(tmp_path / "stores"))
    step = runner.message_step(stores, compact_every=1)
    for n in range(3):
        step(frame(spark, envelope("COLLECT_DATA", [collect(tubeCode=f"t{n}")]), "{").withColumn(
            "message_id", F.concat(F.lit(f"{n}-"), "message_id")), n)
    person = stores.relation("person")
    assert person._complete(spark, "base", None) == [1]
    assert person._complete(spark, "delta", None) == [2]
    assert {r.tubeCode for r in person.latest(spark).collect()} == {f"t{n}" for n in range(3)}
    assert stores.sink("quarantine").latest(spark).count() == 3
    before = sorted(map(repr, stores.sink("upload_log").latest(spark).collect()))
    step(frame(spark, envelope("COLLECT_DATA", [collect(tubeCode="t2")]), "{").withColumn(
        "message_id", F.concat(F.lit("2-"), "message_id")), 2)
    assert sorted(map(repr, stores.sink("upload_log").latest(spark).collect())) == before


def test_hour_stream_carries_both_stages_like_batch(spark, tmp_path):
    folder = str(tmp_path / "in")
    table = KeyedTable(str(tmp_path / "out"), ["union_id"], ["window_end", "source"])
    values = [envelope("COLLECT_DATA", [collect(), collect(personIdCard="x")]),
              envelope("REPORT_DATA", [report(), report(tubeCode="other")]),
              envelope("COLLECT_DATA", [collect()], interfaceRecTime="2024-01-05 12:00:05")]
    for n, value in enumerate(values):
        _put(spark, folder, n, value)
    # the slowest stage sets the watermark: both need a later record
    for n, (last, time) in enumerate(((SENTINEL, "2024-01-09 00:00:00"),
                                      (LAST, "2024-01-10 00:00:00"))):
        _put(spark, folder, 8 + n, last, envelope(
            "COLLECT_DATA", [collect(areaId=n)], interfaceRecTime=time))
    known = jobs.stage_frames(frame(spark, *values))["collect"]

    def stages(messages):
        frames = jobs.stage_frames(messages)
        return {"collect": frames["collect"],
                "report": R.with_collected_flag(frames["report"], known)}

    out = runner.stream_hour(stages(M.stream_message_table(spark, folder, 1)), delay="1 minute")
    _run(lambda: runner.start_changelog(out, table, str(tmp_path / "cp"), ONCE))
    columns = ("union_id", "source", *stats.HOUR_SUMS, "create_time")
    batch = jobs.hour_changelog(jobs.hour_windows(stages(frame(spark, *values))))
    got = table.changelog(spark).filter("area_id = 6101")
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(
        map(tuple, batch.select(*columns).collect()))


def test_a_batch_reads_as_much_of_a_large_store_as_of_a_small_one(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "PART_BYTES", 3000)
    store = KeyedTable(str(tmp_path / "store"), ["k"])
    read = {}
    for batch in range(50):
        spark.range(batch * 100, batch * 100 + 100).selectExpr(
            "concat('key', id) as k", "id as v", "md5(cast(id as string)) as pad").coalesce(
            1).write.mode("overwrite").parquet(f"{store.path}/delta/{batch}")
        if batch and batch % 5 == 0:
            store.compact(spark, before=batch, remove=True)
        if batch % 5 == 4 and batch > 5:
            keys = spark.createDataFrame([("key5",), (f"key{batch * 50}",)], "k string")
            files = store.changelog(spark, batch, keys).select(F.input_file_name()).distinct()
            read[batch] = sum(os.path.getsize(r[0].removeprefix("file://"))
                              for r in files.collect())
            found = store.latest(spark, batch, keys).join(keys, "k").collect()
            assert {r.k for r in found} == {"key5", f"key{batch * 50}"}
    whole = store.latest(spark)
    assert whole.count() == 5000 and whole.agg(F.sum("v")).first()[0] == 4999 * 2500
    # the folders since the last fold, and the parts of two keys
    assert read[49] < 1.2 * read[9]


def test_counters_begin_anew_and_closed_issues_are_forgotten_after_two_days(spark, tmp_path):
    hour = envelope("HOUR_SUM_REPORT", [
        {"areaId": 1, "collectDate": "2024-01-05", "unitHour": 3, "collectPersons": 4}])
    bad, good = (envelope("COLLECT_DATA", [collect(personName=n)]) for n in ("#", "Ann"))
    stores, clock = runner.Stores(str(tmp_path / "stores")), {}
    step = runner.message_step(stores, now=lambda: F.lit(clock["now"]).cast("timestamp"),
                               compact_every=1, reopen=False)

    def run(batch, now, *values):
        clock["now"] = now
        step(frame(spark, *values).withColumn(
            "message_id", F.concat(F.lit(f"{batch}-"), "message_id")), batch)
        (total,) = stores.sink("hour_sum_report").latest(spark).collect()
        issues = {(r.issue_key[-2:], r.is_open) for r in stores.issues.latest(spark).collect()}
        return total.collect_persons, issues

    run(0, "2024-01-05 12:00:00", hour, bad)
    persons, issues = run(1, "2024-01-06 12:00:00", hour, good)
    assert persons == 8 and ("C4", False) in issues
    # 49 hours later: the sum begins anew; the closed issue is unknown and opens again
    for _ in range(2):
        persons, issues = run(2, "2024-01-08 13:00:00", hour, bad)
        assert persons == 4 and ("C4", True) in issues
    records = stores.sink("problem_data_cr").latest(spark).filter("problem_record = 'C4'")
    assert records.count() == 2
    # 49 hours on, the open issue is still known
    persons, issues = run(3, "2024-01-10 14:00:00", hour, good)
    assert persons == 4 and ("C4", False) in issues


def test_stages_of_the_today_stream_share_their_state(spark, tmp_path):
    day = "timestamp '2024-01-05 12:00:00'"
    rows = spark.sql(
        f"select string(id) as message_id, 0 as pos, if(id % 7 = 0, null, id % 2) as areaId, "
        f"{day} + make_interval(0, 0, 0, 0, 0, int(id * 9)) as recTs, concat('u', id % 3) as userName, "
        "int(id % 5) as dropDataNum, string(id % 4) as personIdCard, string(id % 6) as tubeCode, "
        "if(id % 5 = 0, null, int(id % 8)) as tubeNum from range(40)")
    last = rows.limit(1).withColumns({
        "areaId": F.lit(-1).cast("bigint"), "recTs": F.expr(f"{day} + interval 3 days")})
    folder = str(tmp_path / "in")
    table = KeyedTable(str(tmp_path / "out"), ["union_id"], ["window_end"])
    persons, loads = ("personIdCard", "tubeCode"), ("tubeNum",)

    def stages(source):
        return {"collect": source.drop(*loads), "transport": source.drop(*persons),
                "receive": source.drop(*persons).filter("pos = 0"), "report": source.drop(*loads)}

    def changelog():
        return runner.stream_today(stages(spark.readStream.schema(rows.schema).parquet(folder)),
                                   delay="3 minutes")

    for part in (rows, last, last.withColumn("recTs", F.expr("recTs + interval 1 day"))):
        part.coalesce(1).write.mode("append").parquet(folder)
        _run(lambda: runner.start_changelog(changelog(), table, str(tmp_path / "cp"), ONCE))
    columns = ("union_id", "area_id", "source", "upload_time", "create_by", "drop_data_num",
               *stats.TODAY_SUMS, "upload_hour_num", "fail_hour_num")
    batch = jobs.today_changelog(jobs.today_windows(stages(rows)))
    got = table.changelog(spark).filter("coalesce(area_id, 0) >= 0")
    assert sorted(map(str, got.select(*columns).collect())) == sorted(
        map(str, batch.select(*columns).collect()))
    plan = changelog()._jdf.queryExecution().analyzed().toString()
    assert plan.count("DeduplicateWithinWatermark") == 1 and plan.count("EventTimeWatermark") == 4


def test_state_has_as_many_partitions_as_its_rows_ask_for(spark):
    assert stream_queries.state_partitions(spark, 10 ** 9) == 2  # what the session is set to
    with stream_queries._stream_settings(spark, 96):
        assert stream_queries.state_partitions(spark, 10) == 8  # one per core
        assert stream_queries.state_partitions(spark, 3_000_001) == 13
    assert spark.conf.get("spark.sql.shuffle.partitions") == "2"
