"""Place of a write, and relation tables built by hashing."""

from pyspark.sql import functions as F

from tubetrace.operators import relations as R
from tubetrace.plans import standins as S


def test_places_follow_second_partition_offset_and_position(spark):
    rows = [("2024-01-05 12:00:00", "t-3-9", 1), ("2024-01-05 12:00:00", "t-3-9", 12),
            ("2024-01-05 12:00:00", "t-3-10", 0), ("2024-01-05 12:00:00", "t-4-2", 0),
            ("2024-01-05 12:00:01", "t-0-0", 0), ("1969-12-31 23:59:59", "t-9-9", 9),
            (None, "t-9-9", 9), ("2024-01-05 12:00:02", "no number", 0),
            ("2024-01-05 12:00:03", None, None), ("2024-01-05 12:00:04", "12345678901234567890", 7)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)],
                               "i int, at string, message_id string, pos int")
    placed = df.withColumn("recTs", F.col("at").cast("timestamp")).withColumn(
        "place", R.arrival_order())
    assert placed.schema["place"].dataType.simpleString() == "decimal(38,0)"
    assert placed.filter("place is null").count() == 0
    assert [r.i for r in placed.orderBy("place").collect()] == [6, 5, 0, 1, 2, 3, 4, 7, 8, 9]


def test_relation_tables_are_hashed(spark):
    rows = spark.createDataFrame([], "personIdCard string, tubeCode string, message_id string, "
                                 "pos int, recTs timestamp, collectTs timestamp, checkTs timestamp, "
                                 "submitId bigint, deliveryCode string, deliveryTs timestamp, "
                                 "tubeNum int, packNum int, receiveTs timestamp")
    for table in (R.person_relation(rows, rows), R.tube_relation(rows),
                  R.delivery_relation(rows, rows)):
        plan = table._jdf.queryExecution().executedPlan().toString()
        assert "HashAggregate" in plan and "SortAggregate" not in plan and "Sort " not in plan


def test_work_on_loads_is_cut_by_the_number_of_lines(spark, tmp_path, monkeypatch):
    day = "timestamp '2024-01-05 00:00:00'"
    lines = spark.sql(
        f"select id % 9 as l_orderkey, id % 4 as l_suppkey, id % 5 as l_partkey, "
        f"if(id % 3 = 0, 'F', 'O') as l_linestatus, {day} + make_interval(0, 0, 0, int(id)) "
        f"as l_shipdate from range(60) union all select null, 1, 1, 'F', {day}")
    lines.coalesce(1).write.parquet(str(tmp_path / "lineitem.parquet"))

    def made():
        table = S.delivery_table(spark, str(tmp_path))
        parts = S.load_partitions(spark, str(tmp_path))
        matches = [
            R.match_receive_transport(S.receive_records(spark, str(tmp_path)), table, parts),
            R.match_transport_receive(S.transport_records(spark, str(tmp_path)), table, parts)]
        matches = [rows.drop("transportItem") for rows in matches]
        return [rows.rdd.getNumPartitions() for rows in (table, *matches)], [
            sorted(map(str, rows.collect())) for rows in (table, *matches)]

    assert S.load_partitions(spark, str(tmp_path)) is None
    _, want = made()
    monkeypatch.setattr(S, "LINES_PER_PARTITION", 9)
    partitions, got = made()
    assert partitions == [7, 7, 7]
    assert got == want and all(want)
