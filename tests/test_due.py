"""Ids out of a map, records that fall due, stable line ids, repeats on streams."""

import json

import pytest
from pyspark.sql import functions as F

from messages import collect, envelope, frame, receive, report, transport
from tubetrace.operators import identity
from tubetrace.sources import messages as M
from tubetrace.streaming import runner

ONCE = {"availableNow": True}


def named(spark, batch, *values):
    return frame(spark, *values).withColumn(
        "message_id", F.concat(F.lit(f"{batch}-"), "message_id"))


def test_absence_falls_due_without_a_message_once_and_after_a_repeat(spark, tmp_path):
    stores, clock = runner.Stores(str(tmp_path / "stores")), {}
    step = runner.message_step(stores, now=lambda: F.lit(clock["now"]).cast("timestamp"))

    def run(batch, now, *values):
        clock["now"] = now
        step(named(spark, batch, *values), batch)
        found = [stores.sink(t).of_batch(spark, batch) for t in ("problem_data_cr",
                                                               "problem_data_tre")]
        return sorted(r.problem_record for rows in found for r in rows.filter(
            F.col("problem_record").isin("C6", "TR2", "TR6", "V8") & (F.col("is_valid") == 0))
            .collect())

    # a person who is reported in time, one who is not; a load without receipt, a receipt
    # without load, a received load whose tube has no collect record
    first = [envelope("COLLECT_DATA", [collect(), collect(tubeCode="t2", personIdCard="x")]),
             envelope("TRANSPORT_DATA", [transport(deliveryCode="d8"), transport(
                 deliveryCode="d9", transportItem=[{"tubeCode": "nowhere"}])]),
             envelope("RECEIVE_DATA", [receive(deliveryCode="d7", receiveCode="r7"),
                                       receive(deliveryCode="d9", receiveCode="r9")])]
    assert run(0, "2024-01-05 12:00:00", *first) == []
    assert run(1, "2024-01-05 13:00:00", envelope("REPORT_DATA", [report()])) == []
    due = ["C6", "TR2", "TR6", "V8"]
    assert run(2, "2024-01-06 13:00:00") == due
    assert run(2, "2024-01-06 13:00:00") == due  # run again
    assert run(3, "2024-01-06 15:00:00") == []
    assert run(4, "2024-01-07 15:00:00") == []


def test_ids_of_the_map_never_collide_and_are_the_same_in_a_repeat(spark, tmp_path):
    stores, path = runner.Stores(str(tmp_path / "stores")), str(tmp_path / "out")
    step = runner.enrich_step(stores, path=path, compact_every=2)

    def run(batch, *values):
        step(named(spark, batch, *values), batch)
        rows = spark.read.parquet(f"{path}/batch={batch}").orderBy("message_id").collect()
        return [json.loads(r.value) for r in rows]

    def seen(bodies):
        return [(e.get("id"), [t.get("id") for t in e.get("transportItem", [])])
                for body in bodies for e in body["data"]]

    first = [envelope("COLLECT_DATA", [collect(), collect(personIdCard="y"), collect()]),
             envelope("TRANSPORT_DATA", [transport()])]
    one = seen(run(0, *first))
    assert one[0] == one[2] and len({i for i, _ in one}) == 3
    assert None not in [i for i, _ in one] and None not in one[3][1]
    given = {i for i, _ in one} | {i for _, tubes in one for i in tubes}
    assert given == set(range(1, len(given) + 1))
    second = [envelope("COLLECT_DATA", [collect(personIdCard="z"), collect(), collect(collectTime=None)])]
    two = seen(run(1, *second))
    assert two[1] == one[0] and two[0][0] == len(given) + 1 and two[2][0] is None
    for _ in range(2):
        assert seen(run(1, *second)) == two
    assert seen(run(2, *first)) == one  # the map is folded with this batch
    assert seen(run(3, *first, *second)) == one + two


def test_enriched_stream_with_a_map(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    named(spark, 0, envelope("COLLECT_DATA", [collect()])).write.parquet(folder)
    query = runner.start_enriched(
        M.stream_message_table(spark, folder), str(tmp_path / "c"), ONCE,
        stores=runner.Stores(str(tmp_path / "stores")), path=out)
    assert query.awaitTermination(100)
    (row,) = spark.read.parquet(out).collect()
    assert json.loads(row.value)["data"][0]["id"] == 1


@pytest.mark.parametrize("size", [40, 1 << 20])
def test_line_ids_do_not_depend_on_splits(spark, tmp_path, size):
    (tmp_path / "a.txt").write_text("\n".join(["same"] * 9000 + ["one", "", "two", ""]) + "\n")
    (tmp_path / "b.txt").write_text("same\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size * 100)
        rows = [tuple(r) for r in M.read_text(spark, str(tmp_path)).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(rows) == 9005 == len({i for i, _ in rows})
    digest = spark.createDataFrame(sorted(rows), "i string, v string").agg(
        F.md5(F.concat_ws(",", F.array_sort(F.collect_list(F.concat("i", "v")))))).first()[0]
    known = test_line_ids_do_not_depend_on_splits.__dict__.setdefault("seen", {})
    numbers = {i.split("-", 1)[1] for i, v in rows}
    assert known.setdefault("numbers", numbers) == numbers and digest


def test_lines_of_a_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("x\ny\r\nx\n\n")
    query = (M.stream_text(spark, str(tmp_path / "in")).writeStream.format("memory")
             .queryName("lines").trigger(**ONCE).start())
    assert query.awaitTermination(100)
    rows = spark.sql("select * from lines").collect()
    assert sorted((r.message_id.split("-")[1], r.value) for r in rows) == [
        ("0", "x"), ("1", "y"), ("2", "x"), ("3", "")]


def test_repeats_across_batches_are_dropped(spark, tmp_path):
    folder, seen = str(tmp_path / "in"), []
    schema = "k string, v int, at timestamp"
    for number, rows in enumerate(([("a", 1, "12:00:00"), ("b", 2, "12:00:01"), (None, 3, "12:00:01")],
                                   [("a", 4, "12:04:00"), ("c", 5, "12:05:00")],
                                   [("a", 6, "12:09:00"), ("c", 7, "12:09:00")])):
        df = spark.createDataFrame(rows, "k string, v int, t string").select(
            "k", "v", F.concat(F.lit("2024-01-05 "), "t").cast("timestamp").alias("at"))
        df.coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(schema).parquet(folder)
        query = (identity.dedup_stream(stream, ["k"], "at", "10 minutes").writeStream
                 .foreachBatch(lambda rows, _: seen.extend(r.v for r in rows.collect()))
                 .option("checkpointLocation", str(tmp_path / "c")).trigger(**ONCE).start())
        assert query.awaitTermination(100)
    assert sorted(seen) == [1, 2, 5]
