"""Streaming jobs: messages in, keyed tables out.

Two shapes cover them all. Jobs about single messages and records run their batch plan
on each micro-batch (``message_step``). Jobs about windows aggregate in Spark's streaming
operators and accumulate the few window rows per key in state (``stream_changelog``).
Both end in keyed tables whose writes can be repeated without counting twice.

Jobs whose windows look something up (``start_city``, ``start_hour``, ``start_org``,
``start_delay``) hold the rows of a window until it closes, and then run the batch plan on
them, joined with the relation tables and dimensions as they are in that batch.

Windows on event time close. ``start_intake`` parses the messages once for all windowed
jobs, writes the rows of each stage that are in time to a folder that the jobs read as a
stream (``stage_stream``), and keeps those that come too late in tables (``Stores.late``).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import partial, reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.times import hour_of, truncated_mean
from ..operators import envelope as E
from ..operators import issues as I
from ..operators import relations as R
from ..operators.identity import new_ids
from ..operators.running import accumulated, add_to_stored, upsert_latest
from ..operators.windows import closed_of, closed_rows, stream_windowed_stats, tagged
from ..plans import jobs, stats
from ..sources.tables import KeyedTable, older_than
from .pending import Pending
from .state import stream_running

ROW_ID = ("message_id", "pos")
# counters go on from what is stored, unless that is older; closed issues are forgotten, too
KEPT = "2 days"
COUNTERS = ("upload_log_prob", "hour_sum_report")
MESSAGES = "messages"


@dataclass(frozen=True)
class Stores:
    """Folder of the keyed tables; it must be one that all executors share."""

    path: str

    def sink(self, table: str) -> KeyedTable:
        return KeyedTable(f"{self.path}/{table}", jobs.SINK_KEYS[table],
                          jobs.SINK_ORDER.get(table, ()))

    def relation(self, name: str) -> KeyedTable:
        return KeyedTable(f"{self.path}/relation_{name}", jobs.RELATION_KEYS[name])

    @property
    def issues(self) -> KeyedTable:
        return KeyedTable(f"{self.path}/issue_state", ["issue_key"], by=["record_key"])

    @property
    def ids(self) -> KeyedTable:
        """The id map: (place, id)."""
        return KeyedTable(f"{self.path}/id_map", ["place"])

    @property
    def last_ids(self) -> KeyedTable:
        """The highest id given so far, in one row."""
        return KeyedTable(f"{self.path}/last_id", ["one"])

    def pending(self, stage: str) -> Pending:
        return Pending(f"{self.path}/pending_{stage}")

    def batch_times(self, job: str) -> KeyedTable:
        return KeyedTable(f"{self.path}/batch_time/{job}", ["batch"])

    def totals(self, job: str) -> KeyedTable:
        """Running totals of a windowed job, with those that its sink does not show yet."""
        return KeyedTable(f"{self.path}/totals_{job}", ["union_id"])

    def relations(self, spark: SparkSession) -> dict[str, DataFrame | None]:
        """The relation tables as they are now; None where nothing is written yet."""
        return {n: self.relation(n).latest(spark) for n in jobs.RELATION_KEYS}

    @property
    def stage_clocks(self) -> KeyedTable:
        """Latest time seen per stage."""
        return KeyedTable(f"{self.path}/stage_clock", ["stage"])

    def in_time(self, stage: str) -> KeyedTable:
        return KeyedTable(f"{self.path}/intake_{stage}", ROW_ID)

    def late(self, stage: str) -> KeyedTable:
        return KeyedTable(f"{self.path}/late_{stage}", ROW_ID)

    def read_per_batch(self) -> list[KeyedTable]:
        """The tables, beside the issues, that each micro-batch reads; they are folded from
        time to time."""
        return [*(self.relation(n) for n in jobs.RELATION_KEYS), *map(self.sink, COUNTERS)]


def _update_relations(stores: Stores, stages, spark: SparkSession, batch: int, due=None):
    """Add the batch to the relation tables; returns them as of after the batch, as far as
    its rows, or the ``due`` ones, ask for them."""
    updates = jobs.relation_updates(stages)
    for name, fresh in updates.items():
        table = stores.relation(name)
        merged = R.merge_relation(table.latest(spark, before=batch, among=fresh), fresh,
                                  jobs.RELATION_KEYS[name])
        table.write_batch(merged, batch)
    asked = {n: rows.select(*jobs.RELATION_KEYS[n]) for n, rows in updates.items()}
    for rows in (stages, due or {}):
        if "transport" in rows:
            items = rows["transport"].select(F.explode("transportItem").alias("item"))
            asked["tube"] = asked["tube"].union(items.select("item.tubeCode"))
    for name, stage in (("person", "collect"), ("delivery", "transport"), ("delivery", "receive")):
        if due:
            asked[name] = asked[name].union(due[stage].select(*jobs.RELATION_KEYS[name]))
    return {n: stores.relation(n).latest(spark, before=batch + 1, among=asked[n])
            for n in updates}


def _due_records(stores: Stores, stages, spark: SparkSession, batch: int, at: Column):
    """Keep the records of a batch that the rules on absence cannot judge yet, and return the
    ones of earlier batches that they can judge now (stage -> rows); None if there are none."""
    for name, since in jobs.ABSENCE_SINCE.items():
        due = F.col(since) + F.expr("interval 1 day")
        stores.pending(name).write_batch(stages[name].filter(due > at), due, batch)
    before = stores.batch_times(MESSAGES).of_batch(spark, batch - 1) if batch else None
    if before is None:
        return None
    after = before.select(F.timestamp_micros("micros")).first()[0]
    until = spark.range(1).select(at).first()[0]
    found = {n: stores.pending(n).due(spark, stages[n].schema, after, until, batch)
             for n in jobs.ABSENCE_SINCE}
    for name in found:
        stores.pending(name).forget(spark, after)
    if not any(rows is not None for rows in found.values()):
        return None
    return {**{n: stages[n].limit(0) if found.get(n) is None else found[n] for n in stages}}


def _time_of_batch(stores: Stores, spark: SparkSession, batch: int, now: Column,
                   job: str = MESSAGES) -> Column:
    """The time of a batch: taken once, stored, and the same in every retry and table."""
    times = stores.batch_times(job)
    stored = times.of_batch(spark, batch)
    if stored is None:
        times.write_batch(spark.range(1).select(
            F.lit(batch).alias("batch"), F.unix_micros(now).alias("micros")), batch)
        stored = times.of_batch(spark, batch)
    return F.timestamp_micros(F.lit(stored.first()["micros"]))


def message_step(stores: Stores, now: Callable[[], Column] = F.current_timestamp, secret=None,
                 reopen: bool = True, compact_every: int = 50) -> Callable[[DataFrame, int], None]:
    """Work on one micro-batch: relations, data check, message log, hourly summaries, and the
    messages that no job can use. Messages are parsed once.

    Relations are written before the records are checked against them. Every read of a
    store stops before this batch and takes only the parts that the batch's keys lie in, so a
    repeated batch gives the same rows. Every ``compact_every`` batches the stores that are
    read per batch are folded, so that a read never takes more than that many folders.

    Records without their counterpart are kept until a day has passed and judged again in the
    first batch after that, so such an issue needs no further message; see ``heartbeats``.

    Counters that were last written more than ``KEPT`` before the batch begin anew, and closed
    issues of that age are forgotten; sink rows stay until they are written again.
    """
    def step(messages: DataFrame, batch: int) -> None:
        spark = messages.sparkSession
        at = _time_of_batch(stores, spark, batch, now())
        messages = messages.filter(F.col("message_id").isNotNull())  # no heartbeats
        read = E.read_messages(messages).persist(StorageLevel.MEMORY_AND_DISK)
        kept = [read]
        try:
            parsed = E.accepted(read)
            stages = jobs.stages_of(parsed)
            due = _due_records(stores, stages, spark, batch, at)
            relations = _update_relations(stores, stages, spark, batch, due)
            matched = {n: rows.persist(StorageLevel.MEMORY_AND_DISK)
                       for n, rows in jobs.matched_stages(stages, relations).items()}
            kept.extend(matched.values())
            old = older_than(KEPT, at)
            forgotten = old & ~F.col("is_open")
            checked = jobs.data_check(
                matched, at, secret,
                lambda records: stores.issues.latest(spark, batch, records, forgotten), reopen,
                due=due and jobs.matched_stages(due, relations))
            stores.issues.write_batch(checked.pop("issue_state"), batch, at)
            counts, daily = stores.sink("upload_log_prob"), checked["upload_log_prob"]
            checked["upload_log_prob"] = add_to_stored(
                counts.latest(spark, batch, daily, old), daily, I.COUNTER_KEYS,
                tuple(I.daily_counters()))
            hourly = stores.sink("hour_sum_report")
            totals = accumulated(
                jobs.hourly_rows_of(parsed, F.date_format(at, "yyyy-MM-dd HH:mm:ss")),
                jobs.HOURLY_KEYS.values(), ROW_ID, sums=jobs.HOURLY_SUMS.values(),
                firsts=("id", "create_time"), lasts=("update_time", "create_by", "is_delete"))
            checked["hour_sum_report"] = add_to_stored(
                hourly.latest(spark, batch, totals, old), totals,
                tuple(jobs.HOURLY_KEYS.values()),
                tuple(jobs.HOURLY_SUMS.values()), ("id", "create_time"))
            outputs = {**checked, **jobs.report_log(read, matched, at, secret, parsed),
                       "quarantine": E.rejected(read)}
            for table, rows in outputs.items():
                stores.sink(table).write_batch(rows, batch, at if table in COUNTERS else None)
            if batch and batch % compact_every == 0:
                for store in stores.read_per_batch():
                    store.compact(spark, before=batch, remove=True)
                stores.issues.compact(spark, batch, remove=True, expired=forgotten)
        finally:
            for df in kept:
                df.unpersist()
    return step


def heartbeats(messages: DataFrame, per_second: int = 1) -> DataFrame:
    """A stream of messages that never falls silent: rows without an id come in between, so that
    batches go on and records become due while no message comes."""
    beats = (messages.sparkSession.readStream.format("rate")
             .option("rowsPerSecond", per_second).load())
    nothing = F.lit(None).cast("string")
    return messages.unionByName(beats.select(*[nothing.alias(c) for c in messages.columns]))


def start_messages(messages: DataFrame, stores: Stores, checkpoint: str, trigger=None,
                   **options) -> StreamingQuery:
    writer = messages.writeStream.foreachBatch(message_step(stores, **options))
    return (writer.option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "2 minutes"})).start())


def enrich_step(stores: Stores, fmt: str = "parquet", compact_every: int = 50,
                **options) -> Callable[[DataFrame, int], None]:
    """Work on one micro-batch: messages with ids out of the id map, where two keys never share
    one. New keys are numbered in key order after the highest id of the batches before, so a
    batch that is run again gives the same ids. Files go to a folder per batch below ``path``."""
    def step(messages: DataFrame, batch: int) -> None:
        spark = messages.sparkSession
        rows = messages.persist(StorageLevel.MEMORY_AND_DISK)
        keys = jobs.message_keys(rows).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            known = stores.ids.latest(spark, batch, keys)
            last = stores.last_ids.latest(spark, batch)
            top = 0 if last is None else last.first()["id"]
            stores.ids.write_batch(new_ids(keys, known, ["place"], F.lit(top)), batch)
            fresh = stores.ids.of_batch(spark, batch)
            stores.last_ids.write_batch(fresh.agg(
                F.lit(0).alias("one"), F.coalesce(F.max("id"), F.lit(top)).alias("id")), batch)
            ids = fresh if known is None else known.unionByName(fresh)
            out = jobs.enrich_messages(rows, keys.join(ids, "place"))
            if "path" in options:
                path = f"{options['path']}/batch={batch}"
                out.write.format(fmt).mode("overwrite").options(
                    **{n: v for n, v in options.items() if n != "path"}).save(path)
            else:
                out.write.format(fmt).options(**options).save()
            if batch and batch % compact_every == 0:
                for store in (stores.ids, stores.last_ids):
                    store.compact(spark, before=batch, remove=True)
        finally:
            for df in (rows, keys):
                df.unpersist()
    return step


def start_enriched(messages: DataFrame, checkpoint: str, trigger=None, fmt="parquet",
                   stores: Stores | None = None, **options) -> StreamingQuery:
    """Messages with ids, to a topic (``fmt="kafka"`` with its options) or to files. Ids are
    hashes, or with ``stores`` come out of an id map that grows with the stream."""
    if stores is not None:
        writer = messages.writeStream.foreachBatch(enrich_step(stores, fmt, **options))
    else:
        writer = (jobs.enrich_messages(messages).writeStream.format(fmt).options(**options))
    return (writer.option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "2 minutes"})).start())


# --- windowed jobs ---------------------------------------------------------------------

def intake_step(stores: Stores, delay: str) -> Callable[[DataFrame, int], None]:
    """Work on one micro-batch: parse once, and split the rows of each stage into those in
    time and those more than ``delay`` behind the latest row of an earlier batch.

    A windowed job with the same ``delay`` reads the rows in the same order of batches, so its
    watermark is never ahead of the one here: it drops none of the rows in time, and windows
    and late rows together are all rows. Rows without a time belong to no window; they are
    kept with the late ones.
    """
    def step(messages: DataFrame, batch: int) -> None:
        spark = messages.sparkSession
        parsed = E.accepted(E.read_messages(messages)).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            stages = jobs.stages_of(parsed)
            clocks = stores.stage_clocks.latest(spark, before=batch)
            # one row per stage
            seen = {} if clocks is None else {r.stage: r.micros for r in clocks.collect()}
            latest = []
            for name, rows in stages.items():
                late = F.col("recTs").isNull()
                if seen.get(name) is not None:
                    bound = F.timestamp_micros(F.lit(seen[name])) - F.expr(f"interval {delay}")
                    late = late | (F.col("recTs") <= bound)
                stores.late(name).write_batch(rows.filter(late), batch)
                stores.in_time(name).write_batch(rows.filter(~late), batch)
                latest.append(rows.agg(F.greatest(
                    F.max(F.unix_micros("recTs")), F.lit(seen.get(name)).cast("bigint"))
                    .alias("micros")).select(F.lit(name).alias("stage"), "micros"))
            stores.stage_clocks.write_batch(
                reduce(DataFrame.unionByName, latest).coalesce(1), batch)
            if batch and batch % 50 == 0:
                stores.stage_clocks.compact(spark, before=batch, remove=True)
        finally:
            parsed.unpersist()
    return step


def start_intake(messages: DataFrame, stores: Stores, delay: str, checkpoint: str,
                 trigger=None) -> StreamingQuery:
    writer = messages.writeStream.foreachBatch(intake_step(stores, delay))
    return (writer.option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "2 minutes"})).start())


def stage_stream(spark: SparkSession, stores: Stores, stage: str) -> DataFrame:
    """The rows of a stage that came in time, as a stream. Start the intake first. A batch of
    the intake that is repeated replaces its files; rows read twice count once."""
    empty = spark.createDataFrame([], "message_id string, value string")
    folder = f"{stores.in_time(stage).path}/delta"
    return (spark.readStream.schema(jobs.stage_frames(empty)[stage].schema)
            .option("recursiveFileLookup", "true").option("ignoreMissingFiles", "true")
            .parquet(folder))


def _aggregate(delay: str, clock: str):
    return partial(stream_windowed_stats, row_id=ROW_ID, delay=delay, clock=clock)


def _sunk(rows: DataFrame, table: str, **fixed) -> DataFrame:
    """The columns that the batch form of the sink has, too."""
    return rows.withColumns({"id": jobs.id_of(table), **{
        name: F.lit(value) for name, value in fixed.items()}})


def stream_city(matched: dict[str, DataFrame], rules: dict, now: Column, secret=None, *,
                delay: str, clock: str = "event") -> DataFrame:
    """City and district statistics; collect and report rows come matched."""
    collect = jobs.with_flags(matched["collect"], rules["collect"], now, secret)
    report = matched["report"].withColumn("isCollected", F.col("matchCollectTime").isNotNull())
    report = jobs.with_flags(report, rules["report"], now, secret)
    rows = jobs.city_windows(collect, matched["transport"], matched["receive"], report,
                             aggregate=_aggregate(delay, clock))
    credited = jobs.with_collect_credits(rows)
    out = stream_running(credited, "union_id", ["window_end", "is_credit"], stats.CITY_SUMS,
                         lasts=("upload_time", "create_by"))
    return _sunk(out.filter(F.col("upload_time").isNotNull()), "upload_log_city",
                 **jobs.CITY_FIXED)


def stream_org(stages, organisations: DataFrame, *, delay: str, clock: str = "event") -> DataFrame:
    rows = jobs.org_windows(stages, aggregate=_aggregate(delay, clock))
    out = stream_running(jobs.with_org_code(rows, organisations), "union_id", ["window_end"],
                         stats.ORG_SUMS)
    return _sunk(out, "upload_log_org", **jobs.ORG_FIXED)


def stream_delay(stages, clients: DataFrame, now: Column | None = None, *, delay: str,
                 clock: str = "event") -> DataFrame:
    rows = jobs.delay_windows(stages, now=now, aggregate=_aggregate(delay, clock))
    out = stream_running(jobs.with_client_name(rows, clients), "union_id", ["window_end"],
                         ("delay_sum", "delay_count"), ("create_time",))
    out = out.withColumn("delay_num", truncated_mean("delay_sum", "delay_count"))
    return _sunk(out, "data_time_delay", delay_type=stats.REPORT_DELAY_LABEL)


def stream_stage_delay(stages, *, delay: str, clock: str = "event") -> DataFrame:
    return jobs.stage_delays(stages, aggregate=_aggregate(delay, clock))


def stream_hour(stages, *, delay: str, clock: str = "event") -> DataFrame:
    """Persons per hour; report rows carry ``isCollected``."""
    rows = jobs.hour_windows(stages, aggregate=_aggregate(delay, clock))
    out = stream_running(rows, "union_id", ["window_end", "source"], stats.HOUR_SUMS,
                         ("create_time",))
    return jobs.with_hour_columns(_sunk(out, "upload_log_hour"))


def stream_today(stages, *, delay: str, clock: str = "event") -> DataFrame:
    rows = stats.today_stats(stages, _aggregate(delay, clock)).withColumns({
        "upload_hour": hour_of("upload_time"), "upload_hour_num": F.col("success_number"),
        "fail_hour_num": F.col("fail_number")})
    out = stream_running(rows, "union_id", ["window_end"], stats.TODAY_SUMS,
                         sub_key="upload_hour", sub_sums=("upload_hour_num", "fail_hour_num"))
    return _sunk(out, "upload_log_time", **jobs.TODAY_FIXED).drop("upload_hour")


def stream_gap(report: DataFrame, *, delay: str, clock: str = "event") -> DataFrame:
    rows = stats.gap_histogram(report, aggregate=_aggregate(delay, clock))
    out = stream_running(rows, "union_id", ["window_end"], ("check_persons",), ("create_time",))
    return _sunk(out, "upload_log_checkhour", **jobs.GAP_FIXED)


# --- windowed jobs with lookups ---------------------------------------------------------

def start_relations(stages: dict[str, DataFrame], stores: Stores, checkpoint: str,
                    trigger=None) -> StreamingQuery:
    """Keeps only the relation tables up to date, for jobs that run without
    ``start_messages`` beside them. Do not run both on the same stores."""
    return (tagged(stages).writeStream.foreachBatch(lambda rows, batch: _update_relations(
        stores, {n: closed_of(rows, n) for n in stages}, rows.sparkSession, batch))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "2 minutes"})).start())


def closing_step(stores: Stores, job: str, stages, increments, totals, sink,
                 now: Callable[[], Column] = F.current_timestamp) -> Callable[[DataFrame, int], None]:
    """Work on the rows of the windows that close in one micro-batch.

    ``increments`` makes window rows of stage rows and the time of the batch, ``totals`` adds
    them to the stored totals, ``sink`` gives the rows that the sink ``job`` shows. Totals are
    read as of before the batch, and its time is stored, so a batch that is run again counts
    nothing twice; what it looks up may have become more complete.
    """
    store = stores.totals(job)

    def step(closed: DataFrame, batch: int) -> None:
        spark = closed.sparkSession
        at = _time_of_batch(stores, spark, batch, now(), job)
        rows = closed.persist(StorageLevel.MEMORY_AND_DISK)
        kept = [rows]
        try:
            made = increments({n: closed_of(rows, n) for n in stages}, at)
            found = totals(made, store.latest(spark, before=batch))
            kept.append(found.persist(StorageLevel.MEMORY_AND_DISK))
            order = [c for c in ("window_end", "is_credit", "source") if c in found.columns]
            store.write_batch(upsert_latest(found, ["union_id"], order), batch)
            stores.sink(job).write_batch(sink(found), batch)
            if batch and batch % 50 == 0:
                store.compact(spark, before=batch, remove=True)
        finally:
            for df in kept:
                df.unpersist()
    return step


def _start_closing(stages, stores, job, increments, totals, checkpoint, delay, trigger,
                   size=stats.STAT_WINDOW, sink=lambda rows: rows, **options) -> StreamingQuery:
    closed = closed_rows(stages, "recTs", size, ROW_ID, delay)
    step = closing_step(stores, job, list(stages), increments, totals, sink, **options)
    return (closed.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "2 minutes"})).start())


Relations = Callable[[SparkSession], dict[str, DataFrame | None]]


def _matched(rows: DataFrame, match, table: DataFrame | None, fresh: DataFrame) -> DataFrame:
    """``rows`` matched with a relation table; an empty one (that of ``fresh``) where none is
    written yet."""
    return match(rows, fresh.limit(0) if table is None else table)


def start_city(stages, stores: Stores, checkpoint: str, *, delay: str, rules=jobs.CATALOGUE,
               secret=None, relations: Relations | None = None, trigger=None,
               **options) -> StreamingQuery:
    """City and district statistics. Collect and report records are looked up in the relation
    tables when their window closes."""
    lookup = relations or stores.relations

    def increments(rows, at):
        person = lookup(rows["report"].sparkSession)["person"]
        empty = R.person_relation(rows["collect"], rows["report"])
        collect = _matched(rows["collect"], R.match_collect_report, person, empty)
        report = _matched(rows["report"], R.match_report_collect, person, empty)
        report = report.withColumn("isCollected", F.col("matchCollectTime").isNotNull())
        return jobs.city_windows(
            jobs.with_flags(collect, rules["collect"], at, secret), rows["transport"],
            rows["receive"], jobs.with_flags(report, rules["report"], at, secret))

    return _start_closing(stages, stores, "upload_log_city", increments, jobs.city_totals,
                          checkpoint, delay, trigger, sink=jobs.city_sink, **options)


def start_hour(stages, stores: Stores, checkpoint: str, *, delay: str,
               relations: Relations | None = None, trigger=None, **options) -> StreamingQuery:
    """Persons per hour; a report counts if the person and tube have a collect record when its
    window closes."""
    lookup = relations or stores.relations

    def increments(rows, at):
        person = lookup(rows["report"].sparkSession)["person"]
        empty = R.person_relation(rows["collect"], rows["report"])
        report = _matched(rows["report"], R.match_report_collect, person, empty)
        return jobs.hour_windows({"collect": rows["collect"], "report": report.withColumn(
            "isCollected", F.col("matchCollectTime").isNotNull())})

    stages = {n: stages[n] for n in ("collect", "report")}
    return _start_closing(stages, stores, "upload_log_hour", increments, jobs.hour_changelog,
                          checkpoint, delay, trigger, stats.PERSON_WINDOW, **options)


def start_org(stages, stores: Stores, organisations: Callable[[], DataFrame], checkpoint: str, *,
              delay: str, trigger=None, **options) -> StreamingQuery:
    """Uploads per organisation. ``organisations`` reads the dimension; it is called in every
    batch, so a window sees the names that are there when it closes."""
    return _start_closing(
        stages, stores, "upload_log_org",
        lambda rows, at: jobs.with_org_code(jobs.org_windows(rows), organisations()),
        jobs.org_changelog, checkpoint, delay, trigger, **options)


def start_delay(stages, stores: Stores, clients: Callable[[], DataFrame], checkpoint: str, *,
                delay: str, trigger=None, **options) -> StreamingQuery:
    """Reporting delay up to the time of the batch in which a window closes; ``clients`` reads
    the dimension in every batch."""
    return _start_closing(
        stages, stores, "data_time_delay",
        lambda rows, at: jobs.with_client_name(jobs.delay_windows(rows, now=at), clients()),
        jobs.delay_changelog, checkpoint, delay, trigger, **options)


def start_changelog(rows: DataFrame, table: KeyedTable, checkpoint: str,
                    trigger=None) -> StreamingQuery:
    """Write a changelog to a keyed table, one folder per micro-batch."""
    return (rows.writeStream.foreachBatch(table.write_batch)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "2 minutes"})).start())
