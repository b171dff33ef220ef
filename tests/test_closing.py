"""Windowed jobs that look things up when a window closes."""

import pytest
from pyspark.sql import functions as F

from messages import collect, envelope, frame, report
from tubetrace.operators.windows import closed_of, closed_rows
from tubetrace.plans import jobs, stats
from tubetrace.sources import messages as M
from tubetrace.streaming import runner

ONCE = {"availableNow": True}
NOW = "2024-01-20 00:00:00"


def now():
    return F.lit(NOW).cast("timestamp")


def put(spark, folder, number, *values):
    messages = frame(spark, *values).withColumn(
        "message_id", F.concat(F.lit(f"{number}-"), "message_id"))
    messages.coalesce(1).write.mode("append").parquet(folder)
    return messages


def at(kind, time, *rows):
    return envelope(kind, rows, interfaceRecTime=time)


def closers(day):
    """A later message of each stage, which moves the watermark."""
    time = f"2024-01-{day} 00:00:00"
    return [at("COLLECT_DATA", time, collect(areaId=day, tubeCode="late")),
            at("REPORT_DATA", time, report(areaId=day, tubeCode="late")),
            at("TRANSPORT_DATA", time, {"areaId": day}), at("RECEIVE_DATA", time, {"areaId": day})]


@pytest.fixture
def fed(spark, tmp_path):
    """Feeds batches of messages to the relation tables and then to a job, from its checkpoint."""
    folder, stores = str(tmp_path / "in"), runner.Stores(str(tmp_path / "stores"))

    def feed(number, values, *starts):
        put(spark, folder, number, *values)
        stages = jobs.stage_frames(M.stream_message_table(spark, folder))
        for n, start in enumerate((lambda s, c: runner.start_relations(s, stores, c, ONCE),
                                   *starts)):
            assert start(stages, str(tmp_path / f"c{n}")).awaitTermination(150)
        return stores

    return feed


FIRST = [at("REPORT_DATA", "2024-01-05 12:00:00", report(), report(tubeCode="t2")),
         at("COLLECT_DATA", "2024-01-05 12:00:30", collect(tubeCode="t9"))]
SECOND = [at("COLLECT_DATA", "2024-01-05 12:01:00", collect()),
          at("REPORT_DATA", "2024-01-05 12:04:00", report(tubeCode="t9"))]


def test_a_report_counts_when_its_collect_record_comes_before_the_window_closes(spark, fed):
    def city(stages, checkpoint):
        return runner.start_city(stages, stores_of(checkpoint), checkpoint, delay="5 minutes",
                                 trigger=ONCE, now=now)

    def hour(stages, checkpoint):
        return runner.start_hour(stages, stores_of(checkpoint), checkpoint, delay="5 minutes",
                                 trigger=ONCE, now=now)

    def stores_of(checkpoint):
        return runner.Stores(checkpoint.rsplit("/", 1)[0] + "/stores")

    for number, values in enumerate((FIRST, SECOND, closers(10))):
        stores = fed(number, values, city, hour)
    stores = fed(9, closers(12), city, hour)

    stages = jobs.stage_frames(frame(spark, *FIRST, *SECOND))
    matched = jobs.matched_stages(stages, jobs.relation_updates(
        jobs.stage_frames(frame(spark, *FIRST, *SECOND, *closers(10)))))
    known = matched["report"].withColumn("isCollected", F.col("matchCollectTime").isNotNull())
    want = jobs.city_changelog(jobs.city_windows(
        jobs.with_flags(matched["collect"], jobs.CATALOGUE["collect"], now()),
        matched["transport"], matched["receive"],
        jobs.with_flags(known, jobs.CATALOGUE["report"], now())))
    columns = ["window_end", "union_id", "source", "is_credit", *stats.CITY_SUMS, "upload_time"]

    def rows(df, *names):
        return sorted(map(tuple, df.filter("area_id = 6101").select(*names).collect()))

    got = stores.sink("upload_log_city").changelog(spark)
    assert rows(got, *columns) == rows(want, *columns)
    # t1 and t9 have their collect record by then, t2 never
    credited = got.filter("source = 1").agg(F.max("upload_number")).first()[0]
    assert credited == 2
    hours = jobs.hour_changelog(jobs.hour_windows({"collect": stages["collect"], "report": known}))
    names = ("window_end", "union_id", "source", *stats.HOUR_SUMS)
    assert rows(stores.sink("upload_log_hour").changelog(spark), *names) == rows(hours, *names)


def test_dimensions_are_read_when_a_window_closes(spark, fed, tmp_path):
    path = str(tmp_path / "orgs")

    def write(*rows):
        spark.createDataFrame(rows, "id bigint, org_name string").write.mode("overwrite").parquet(path)

    def org(stages, checkpoint):
        return runner.start_org(stages, runner.Stores(str(tmp_path / "stores")),
                                lambda: spark.read.parquet(path), checkpoint,
                                delay="5 minutes", trigger=ONCE)

    write((1, "other"))
    fed(0, FIRST, org)
    write((1, "other"), (8, "lab"))
    fed(1, closers(10), org)
    stores = fed(2, closers(12), org)
    rows = stores.sink("upload_log_org").changelog(spark).filter("area_id = 6101").collect()
    assert {(r.org_name, r.org_code) for r in rows} == {("lab", 8), ("org", None)}


def test_a_closing_batch_that_is_repeated_counts_once(spark, tmp_path):
    stores = runner.Stores(str(tmp_path / "stores"))
    stages = jobs.stage_frames(frame(spark, *FIRST, *SECOND))
    step = runner.closing_step(
        stores, "upload_log_hour", ["collect", "report"],
        lambda rows, at: jobs.hour_windows({
            **rows, "report": rows["report"].withColumn("isCollected", F.lit(True))}),
        jobs.hour_changelog, lambda rows: rows, now)
    closed = runner.tagged({n: stages[n] for n in ("collect", "report")})
    for batch in (0, 1, 1):
        step(closed, batch)
    totals = stores.sink("upload_log_hour").latest(spark).collect()
    assert {(r.collect_all, r.check_all) for r in totals} == {(4, 6)}


def test_rows_come_out_once_and_with_their_whole_window(spark, tmp_path):
    folder, minutes, seen = str(tmp_path / "in"), [0, 1, 2, 3, 14], []
    for hour in range(3):
        values = [at("REPORT_DATA", f"2024-01-05 1{hour}:{m:02}:00", report(areaId=hour))
                  for m in minutes]
        messages = put(spark, folder, hour, *values)
        messages.write.mode("append").parquet(folder)  # every message twice
        rows = jobs.stage_frames(M.stream_message_table(spark, folder))["report"]
        closed = closed_rows({"report": rows}, "recTs", "3 minutes", runner.ROW_ID, "5 minutes")
        query = closed.writeStream.foreachBatch(
            lambda rows, batch: seen.append(closed_of(rows, "report").collect())).option(
            "checkpointLocation", str(tmp_path / "cp")).trigger(**ONCE).start()
        assert query.awaitTermination(150)
    found = [(r.areaId, r.recTs.minute) for rows in seen for r in rows]
    assert len(found) == len(set(found))
    for hour in (0, 1):
        assert sorted(m for h, m in found if h == hour) == minutes
    windows = [{(r.areaId, r.recTs.minute // 3) for r in rows} for rows in seen]
    assert not any(a & b for k, a in enumerate(windows) for b in windows[:k])
