"""Queries that run the streaming jobs to their end and return the tables they wrote.

The events arrive in parts by time: each part is written into a folder of the shared
checkpoint folder and taken in by a run that goes on from the checkpoint of the run before, as
after a restart. Last events of each kind, days after all others, move the watermark behind
the last window; their own windows stay open.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..session import ensure_checkpoint_dir
from ..sources.tables import KeyedTable
from ..streaming import runner
from . import standins as S
from . import stats
from .registry import ORACLES, query, times_as_text
from .window_queries import _GAP_REST, _TODAY_REST

PARTS = 2
DELAY = "3 minutes"

# the state of the jobs needs this store; state with a life time would ask for another empty
# batch for ever
STREAM_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false"}
SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"
# Each partition of each state is opened and committed in every batch, however few rows it
# holds; a stream keeps the number it begins with.
ROWS_PER_PARTITION = 250_000


def state_partitions(spark: SparkSession, rows: int) -> int:
    """Partitions of the state of a stream whose first part has ``rows`` rows: one per core or
    as many as the rows ask for, and not more than the session is set to."""
    asked = max(spark.sparkContext.defaultParallelism, -(-rows // ROWS_PER_PARTITION))
    return min(asked, int(spark.conf.get(SHUFFLE_PARTITIONS)))


@contextmanager
def _stream_settings(spark: SparkSession, partitions: int | None = None):
    settings = dict(STREAM_SETTINGS)
    if partitions:
        settings[SHUFFLE_PARTITIONS] = str(partitions)
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def event_parts(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The events in parts by time, and two last parts of one late event per kind each, of a
    user that no other event has: the second batch of them sees the watermark of the first."""
    events = S.table(spark, sf_dir, "events")
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    if first is None:
        return [events]
    bounds = [None, *[first + (last - first) / PARTS * k for k in range(1, PARTS)], None]
    cut = []
    for low, high in zip(bounds, bounds[1:]):
        part = events if low is None else events.filter(F.col("ts") >= F.lit(low))
        cut.append(part if high is None else part.filter(F.col("ts") < F.lit(high)))
    late = events.groupBy("event_type").agg(F.max_by(F.struct(*events.columns), "ts").alias("e"))
    kinds = {f.name: f.dataType for f in events.schema.fields}
    late = late.select("e.*").withColumn("user_id", F.lit(-1).cast(kinds["user_id"]))
    return [*cut, *[late.withColumn("ts", (F.lit(last) + F.expr(f"interval {days} days"))
                                    .cast(kinds["ts"])).select(*events.columns)
                    for days in (2, 4)]]


def run_in_parts(spark: SparkSession, parts: list[DataFrame],
                 start: Callable[[Callable[[], DataFrame], str], StreamingQuery],
                 with_state: bool = True) -> runner.Stores:
    """Feeds the parts one after the other to the query that ``start`` makes of a stream of
    rows and a folder. Returns the stores in that folder."""
    root = f"{ensure_checkpoint_dir(spark)}/streams/{uuid.uuid4().hex}"
    partitions = None
    for number, part in enumerate(parts):
        part.write.parquet(f"{root}/input/part={number}")
        if with_state and not number:
            first = spark.read.schema(part.schema).parquet(f"{root}/input/part=0")
            partitions = state_partitions(spark, first.count())
        stream = lambda: (spark.readStream.schema(parts[0].schema)
                          .parquet(f"{root}/input/part=*"))
        with _stream_settings(spark, partitions):
            start(stream, root).awaitTermination()
    return runner.Stores(root)


ONCE = {"availableNow": True}


def _stages(spark, sf_dir, stream) -> dict[str, DataFrame]:
    return {name: S.event_stage(spark, sf_dir, name, stream()) for name in S.EVENT_TYPES}


def _changelog(spark, stores: runner.Stores, table: str) -> DataFrame:
    return times_as_text(stores.sink(table).changelog(spark))


@query("stream_gap", ORACLES["running_gap"])
def stream_gap(spark, sf_dir):
    """The gap job: windows and running sums in Spark's state."""
    def start(stream, root):
        rows = runner.stream_gap(S.event_stage(spark, sf_dir, "report", stream()), delay=DELAY)
        return runner.start_changelog(rows, runner.Stores(root).sink("upload_log_checkhour"),
                                      f"{root}/checkpoint", ONCE)

    stores = run_in_parts(spark, event_parts(spark, sf_dir), start)
    return _changelog(spark, stores, "upload_log_checkhour").select(
        *_GAP_REST, "check_persons", "create_time")


@query("stream_today", ORACLES["running_today"])
def stream_today(spark, sf_dir):
    """The today job: sums per day and hour in value and map state."""
    def start(stream, root):
        rows = runner.stream_today(_stages(spark, sf_dir, stream), delay=DELAY)
        return runner.start_changelog(rows, runner.Stores(root).sink("upload_log_time"),
                                      f"{root}/checkpoint", ONCE)

    stores = run_in_parts(spark, event_parts(spark, sf_dir), start)
    return _changelog(spark, stores, "upload_log_time").select(*_TODAY_REST, *stats.TODAY_SUMS)


def _looking_up(spark, sf_dir, start_job, **options) -> runner.Stores:
    """Runs a job with lookups. Each part comes to the relation tables first; so a window of
    the first part, which closes with the second, sees the records of both."""
    def start(stream, root):
        stores = runner.Stores(root)
        known = {n: rows for n, rows in _stages(spark, sf_dir, stream).items()
                 if n in ("collect", "report")}
        runner.start_relations(known, stores, f"{root}/relations", ONCE).awaitTermination()
        return start_job(_stages(spark, sf_dir, stream), stores, checkpoint=f"{root}/checkpoint",
                         delay=DELAY, trigger=ONCE, **options)

    return run_in_parts(spark, event_parts(spark, sf_dir), start)


@query("stream_city", ORACLES["running_city"])
def stream_city(spark, sf_dir):
    """The city job; records are matched when their window closes."""
    stores = _looking_up(spark, sf_dir, runner.start_city, now=lambda: S.at(S.EVENTS_NOW))
    out = _changelog(spark, stores, "upload_log_city")
    return out.select("window_end", "union_id", "area_id", "source",
                      F.col("is_credit").cast("int").alias("is_credit"), "upload_time",
                      "create_by", *stats.CITY_SUMS)


@query("stream_hour", ORACLES["running_hour"])
def stream_hour(spark, sf_dir):
    """Persons per hour; reports are looked up when their window closes."""
    stores = _looking_up(spark, sf_dir, runner.start_hour)
    return _changelog(spark, stores, "upload_log_hour").select(
        "window_end", "union_id", "area_id", "unit_hour", "source", *stats.HOUR_SUMS,
        "create_time")


@query("stream_org", ORACLES["running_org"])
def stream_org(spark, sf_dir):
    """Uploads per organisation; the dimension is read when a window closes."""
    def organisations():
        return S.table(spark, sf_dir, "supplier").select(
            F.col("s_suppkey").alias("id"), F.col("s_name").alias("org_name"))

    def start(stream, root):
        return runner.start_org(_stages(spark, sf_dir, stream), runner.Stores(root),
                                organisations, f"{root}/checkpoint", delay=DELAY, trigger=ONCE)

    stores = run_in_parts(spark, event_parts(spark, sf_dir), start)
    return _changelog(spark, stores, "upload_log_org").select(
        "window_end", "union_id", "area_id", "org_name", "source", "upload_time",
        *stats.ORG_SUMS, "org_code")


@query("stream_messages", f"""
select 'log' as sink, message_id as place, area_id, upload_number as first_number,
       success_number as second_number, fail_number as third_number
from ({ORACLES["batch_log"]})
union all
select 'hour', collect_date || '-' || unit_hour, area_id, collect_persons, transfer_persons,
       receive_persons
from ({ORACLES["hourly_summary_final"]})""")
def stream_messages(spark, sf_dir):
    """The message job over two batches: its upload log, and the hourly sums it carries on."""
    messages = (S.hourly_messages(spark, sf_dir)
                .unionByName(S.conversation_messages(spark, sf_dir)))
    half = F.pmod(F.crc32("message_id"), F.lit(2))

    def start(stream, root):
        return runner.start_messages(stream(), runner.Stores(root), f"{root}/checkpoint", ONCE,
                                     now=lambda: S.at("2024-01-31 23:59:00"))

    stores = run_in_parts(spark, [messages.filter(half == n) for n in range(2)], start,
                          with_state=False)
    log = stores.sink("upload_log").changelog(spark)
    hours = stores.sink("hour_sum_report").latest(spark)
    hour = F.concat_ws("-", "collect_date", F.col("unit_hour").cast("string"))

    def shown(rows, sink, place, *numbers):
        named = zip(("first_number", "second_number", "third_number"), numbers)
        return rows.select(F.lit(sink).alias("sink"), place.alias("place"), "area_id",
                           *[F.col(c).cast("bigint").alias(n) for n, c in named])

    return shown(log, "log", F.col("message_id"), "upload_number", "success_number",
                 "fail_number").unionByName(
        shown(hours, "hour", hour, "collect_persons", "transfer_persons", "receive_persons"))
