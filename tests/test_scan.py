import random
from datetime import datetime

from pyspark.sql import functions as F

from tubetrace.operators import identity, relations
from tubetrace.operators.issues import issue_lifecycle
from tubetrace.operators.joins import keyed_left_join, lookup_join
from tubetrace.operators.running import accumulated, running_accumulate, upsert_latest
from tubetrace.operators.scan import CHUNK, ordered_scan, range_chunks, row_numbers


def _rows(spark, n=600, seed=1):
    """A third of the rows belong to one key, and some keys are null."""
    rng = random.Random(seed)
    rows = [(rng.choice(["hot", "hot", "a", "b", None, "c"]), i,
             rng.choice([None, rng.randint(-5, 5)]), rng.choice([0, 1])) for i in range(n)]
    return spark.createDataFrame(rows, "k string, i bigint, v int, is_valid int").repartition(5)


def test_ranges_split_a_hot_key_and_stay_in_order(spark):
    cut = range_chunks(_rows(spark), ["k"], ["i"], chunks=7)
    spans = cut.filter("k = 'hot'").groupBy(CHUNK).agg(
        F.min("i").alias("lo"), F.max("i").alias("hi")).orderBy(CHUNK).collect()
    assert len(spans) >= 2
    assert all(a.hi < b.lo for a, b in zip(spans, spans[1:]))


def test_scan_by_ranges_equals_plain_windows(spark):
    rows = _rows(spark)
    wanted = dict(running={"s": F.col("v")}, previous={"p": F.col("v")},
                  latest={"l": F.col("v")}, first={"f": F.col("v")})
    plain = ordered_scan(rows, ["k"], ["i"], **wanted)
    for chunks in (1, 4, 50):
        cut = ordered_scan(range_chunks(rows, ["k"], ["i"], chunks), ["k"], ["i"], **wanted)
        assert sorted(map(repr, cut.drop(CHUNK).collect())) == sorted(map(repr, plain.collect()))


def test_scan_matches_brute_force(spark):
    rows = _rows(spark, seed=2)
    got = {r.i: r for r in ordered_scan(
        range_chunks(rows, ["k"], ["i"], 6), ["k"], ["i"], running={"s": F.col("v")},
        previous={"p": F.col("v")}, latest={"l": F.col("v")}, first={"f": F.col("v")}).collect()}
    seen = {}
    for r in sorted(rows.collect(), key=lambda r: r.i):
        past = seen.setdefault(r.k, [])
        known = [v for v in [*past, r.v] if v is not None]
        out = got[r.i]
        assert out.s == sum(known)
        assert out.p == (past[-1] if past else None)
        assert out.l == (known[-1] if known else None)
        assert out.f == (past[0] if past else r.v)
        past.append(r.v)


def test_row_numbers_are_dense_and_ordered(spark):
    got = row_numbers(_rows(spark).select("i"), ["i"], chunks=5).orderBy("i").collect()
    assert [r.row_number for r in got] == list(range(1, len(got) + 1))


def test_last_running_total_is_the_grouped_sum(spark):
    rows = _rows(spark).fillna(0, ["v"])
    log = running_accumulate(rows, ["k"], ["i"], sums=["v"], firsts=["is_valid"], hot_keys=True,
                             chunks=4)
    last = upsert_latest(log.select("k", "i", "v"), ["k"], ["i"]).collect()
    total = accumulated(rows, ["k"], ["i"], sums=["v"], firsts=["is_valid"]).collect()
    assert {r.k: r.v for r in last} == {r.k: r.v for r in total}
    assert {r.k: r.is_valid for r in log.collect()} == {r.k: r.is_valid for r in total}


def _lifecycle(rows, reopen):
    """The rule, row by row."""
    out, state = [], {}
    for k, i, valid in rows:
        s = state.setdefault(k, {"open": False, "closed": False, "n": 0, "at": None})
        if valid == 0:
            if not s["open"]:
                s["n"], s["at"] = s["n"] + 1, i
            out.append((i, s["n"], s["at"]))
            s["open"] = reopen or not s["closed"]
        elif s["open"]:
            out.append((i, s["n"], s["at"]))
            s["open"], s["closed"] = False, True
    return sorted(out)


def test_issue_lifecycle_against_brute_force(spark):
    rows = _rows(spark, seed=3).filter("k is not null")
    local = [(r.k, r.i, r.is_valid) for r in sorted(rows.collect(), key=lambda r: r.i)]
    for reopen in (True, False):
        for hot in (True, False):
            got = issue_lifecycle(rows, ["k"], ["i"], F.col("is_valid") == 0, "i", reopen=reopen,
                                  hot_keys=hot, chunks=5)
            found = sorted((r.i, r.issue_number, r.issue_add_time) for r in got.collect())
            assert found == _lifecycle(local, reopen)


def test_lifecycle_of_one_key(spark):
    # error, repeated error, fixed, fixed again, error again
    rows = spark.createDataFrame([(1, 0), (2, 0), (3, 1), (4, 1), (5, 0)], "i int, is_valid int")
    rows = rows.withColumn("k", F.lit("x"))
    for reopen, last_open in ((True, True), (False, False)):
        got = issue_lifecycle(rows, ["k"], ["i"], F.col("is_valid") == 0, "i", reopen=reopen,
                              chunks=3).orderBy("i").collect()
        assert [(r.i, r.issue_number, r.issue_add_time, r.issue_open) for r in got] == [
            (1, 1, 1, True), (2, 1, 1, True), (3, 1, 1, False), (5, 2, 5, last_open)]


def test_null_keys_and_hot_keys_in_joins(spark):
    left = spark.createDataFrame(
        [(f"m{i}", 0, None if i % 3 == 0 else "hot") for i in range(30)],
        "message_id string, pos int, k string")
    right = spark.createDataFrame([("hot", 1), ("cold", 2)], "k string, v int")
    got = keyed_left_join(left, right, ["k"]).collect()
    assert len(got) == 30
    assert all((r.v == 1) == (r.k == "hot") for r in got)


def test_lookup_gives_the_same_rows_broadcast_or_not(spark):
    left = spark.createDataFrame([(i % 7,) for i in range(50)], "k int")
    dim = spark.createDataFrame([(i, f"n{i}") for i in (0, 1, 2, 2, 3)], "k int, name string")
    joined = lookup_join(left, dim, ["k"])
    small = sorted(map(repr, joined.collect()))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    large = sorted(map(repr, lookup_join(left, dim, ["k"]).collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert small == large and len(small) == 50


def test_null_keys_are_spread_without_an_identity(spark):
    left = spark.createDataFrame([(i, None if i % 2 else "a") for i in range(20)], "v int, k string")
    right = spark.createDataFrame([("a", 1)], "k string, w int")
    got = keyed_left_join(left, right, ["k"])
    assert got.columns == ["k", "v", "w"] or set(got.columns) == {"k", "v", "w"}
    assert sorted((r.v, r.w) for r in got.collect()) == [(i, None if i % 2 else 1) for i in range(20)]


def test_the_last_write_of_a_message_wins(spark):
    """Two collect times for one person and tube in each message, in one second."""
    rows = [(f"p{m}", "t", datetime(2024, 1, 1 + pos, 8), datetime(2024, 1, 9), m, pos)
            for m in range(60) for pos in (0, 1)]
    collect = spark.createDataFrame(rows, "personIdCard string, tubeCode string, "
                                    "collectTs timestamp, recTs timestamp, message_id long, pos int")
    report = spark.createDataFrame([], "personIdCard string, tubeCode string, "
                                   "checkTs timestamp, recTs timestamp, message_id long, pos int")
    table = relations.person_relation(collect, report)
    assert {r.collectTs.day for r in table.collect()} == {2}


def test_id_map_keeps_ids_and_adds_new_ones(spark):
    first = spark.createDataFrame([("b",), ("a",), ("b",), (None,)], "k string")
    ids = identity.extend_id_map(None, first, ["k"], chunks=2)
    more = spark.createDataFrame([("0",), ("b",), ("z",)], "k string")
    grown = {r.k: r.id for r in identity.extend_id_map(ids, more, ["k"], chunks=2).collect()}
    assert grown == {"a": 1, "b": 2, "0": 3, "z": 4}


def test_dedup_keeps_the_first_or_the_last(spark):
    rows = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 5, None)],
                                 "k string, o int, v string")
    first = {r.k: r.v for r in identity.dedup_by_key(rows, ["k"], ["o"]).collect()}
    last = {r.k: r.v for r in identity.dedup_by_key(rows, ["k"], ["o"], latest=True).collect()}
    assert first == {"a": "y", "b": None} and last == {"a": "x", "b": None}
