"""Tumbling-window statistics, batch and streaming; rows of closed windows.

A statistic is a set of additive aggregates plus exact distinct counts. In batch, Spark
expands the distinct counts and aggregates them partially before the shuffle. On a
stream, where exact distinct counts are not supported, each row is expanded into one
record per distinct value; the records are de-duplicated within the watermark and then
counted, so no set of values is ever held by one group.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class WindowStat:
    """Grouping of one windowed statistic.

    keys      output name -> expression
    sums      output name -> numeric expression to add up (use lit(1) to count rows)
    maxima    output name -> expression
    distinct  output name -> expression whose distinct non-null values are counted
    """

    size: str
    keys: dict[str, Column]
    sums: dict[str, Column] = field(default_factory=dict)
    maxima: dict[str, Column] = field(default_factory=dict)
    distinct: dict[str, Column] = field(default_factory=dict)

    @property
    def outputs(self) -> list[str]:
        return ["window_start", "window_end", *self.keys, *self.sums, *self.distinct,
                *self.maxima]


def _flatten(grouped: DataFrame, stat: WindowStat) -> DataFrame:
    return grouped.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        *stat.outputs[2:])


def _additive(value: Column, name: str) -> Column:
    return F.coalesce(F.sum(value), F.lit(0)).cast("bigint").alias(name)


def windowed_stats(df: DataFrame, time_column: str, stat: WindowStat) -> DataFrame:
    """One row per window and key. Rows without a time are left out."""
    grouped = (df.groupBy(F.window(time_column, stat.size),
                          *[e.alias(n) for n, e in stat.keys.items()])
               .agg(*[_additive(e, n) for n, e in stat.sums.items()],
                    *[F.countDistinct(e).alias(n) for n, e in stat.distinct.items()],
                    *[F.max(e).alias(n) for n, e in stat.maxima.items()]))
    return _flatten(grouped, stat)


ARRIVAL = "arrival"


def _records(df: DataFrame, time_column: str, stat: WindowStat, row_id, delay: str) -> DataFrame:
    """One record per row and one per distinct value of it, with a watermark."""
    identity = F.concat_ws("\u0001", *[F.col(c).cast("string") for c in row_id])
    row_record = F.struct(F.lit("").alias("metric"), identity.alias("v"))
    records = [row_record] + [
        F.struct(F.lit(n).alias("metric"), e.cast("string").alias("v"))
        for n, e in stat.distinct.items()]
    # everything is computed before the watermark is set: a copy of the time column made
    # afterwards would count as a second event time
    expanded = df.filter(F.col(time_column).isNotNull()).select(
        F.col(time_column).alias("_time"),
        F.window(time_column, stat.size)["start"].alias("_start"),
        *[e.alias(f"_k_{n}") for n, e in stat.keys.items()],
        *[e.alias(f"_s_{n}") for n, e in stat.sums.items()],
        *[e.alias(f"_m_{n}") for n, e in stat.maxima.items()],
        F.inline(F.array(*records)))
    return expanded.filter(F.col("v").isNotNull()).withWatermark("_time", delay)


def stream_windowed_stats(df: DataFrame | list[DataFrame], time_column: str, stat: WindowStat,
                          row_id, delay: str, clock: str = "event") -> DataFrame:
    """Streaming form of ``windowed_stats``, in append mode.

    ``row_id`` lists the columns that identify a row (a repeated row counts once).
    ``clock="event"`` cuts windows on ``time_column``; ``delay`` is how late a row may come,
    at least the window size. Spark drops what comes later: let the rows pass
    ``runner.start_intake`` first, which puts them into a table of their own.
    ``clock="arrival"`` cuts windows on the time of the micro-batch that brings a row. No row
    is late then, rows without ``time_column`` count as well, and a batch that is run again
    keeps its time.

    Several streams share one state for their rows and one for their windows; a key must tell
    them apart. Each has a watermark of its own, and the slowest one counts.
    """
    if clock not in ("event", ARRIVAL):
        raise ValueError(f"no such clock: {clock}")
    streams = df if isinstance(df, list) else [df]
    if clock == ARRIVAL:
        streams = [rows.withColumn("_arrived", F.current_timestamp()) for rows in streams]
        time_column = "_arrived"
    is_row = F.col("metric") == ""
    expanded = reduce(DataFrame.unionByName, [
        _records(rows, time_column, stat, row_id, delay) for rows in streams])
    unique = expanded.dropDuplicatesWithinWatermark(
        ["_start", "metric", "v", *[f"_k_{n}" for n in stat.keys]])
    grouped = (unique.groupBy(F.window("_time", stat.size),
                              *[F.col(f"_k_{n}").alias(n) for n in stat.keys])
               .agg(*[_additive(F.when(is_row, F.col(f"_s_{n}")), n) for n in stat.sums],
                    *[_additive(F.when(F.col("metric") == n, 1), n) for n in stat.distinct],
                    *[F.max(F.when(is_row, F.col(f"_m_{n}"))).alias(n) for n in stat.maxima]))
    return _flatten(grouped, stat)


HELD = "_row"


def _as_row(name: str, streams: dict[str, DataFrame], *extra) -> DataFrame:
    rows = streams[name]
    return rows.select(
        F.lit(name).alias("_stream"), *extra,
        *[(F.struct(*rows.columns) if other == name else F.lit(None).cast(streams[other].schema))
          .alias(f"{HELD}_{other}") for other in streams])


def tagged(streams: dict[str, DataFrame]) -> DataFrame:
    """The rows of several streams (name -> rows) as one; ``closed_of`` takes them apart."""
    return reduce(DataFrame.unionByName, [_as_row(n, streams) for n in streams])


def closed_rows(streams: dict[str, DataFrame], time_column: str, size: str, row_id,
                delay: str) -> DataFrame:
    """Rows of several streams (name -> rows) once their windows have closed.

    Each row is held until the watermark passes the end of its window, so all rows of a
    window come out in one batch, where they can be joined with tables as of that batch
    and counted by ``windowed_stats``. The state is keyed by window and row, so a hot key is
    spread evenly; a row that is repeated within its window comes out once. The slowest
    stream sets the watermark. Take the rows of a stream with ``closed_of``.
    """
    ids = [f"_id_{c}" for c in row_id]
    timed = {n: rows.filter(F.col(time_column).isNotNull()) for n, rows in streams.items()}
    parts = [_as_row(n, timed, F.col(time_column).alias("_time"),
                     *[F.col(c).cast("string").alias(i) for c, i in zip(row_id, ids)])
             .withWatermark("_time", delay) for n in timed]
    grouped = reduce(DataFrame.unionByName, parts).groupBy(
        F.window("_time", size), "_stream", *ids)
    held = [f"{HELD}_{n}" for n in streams]
    return grouped.agg(*[F.first(h).alias(h) for h in held]).select("_stream", *held)


def closed_of(closed: DataFrame, name: str) -> DataFrame:
    """The rows of one stream out of ``closed_rows``, as they came in."""
    return closed.filter(F.col("_stream") == name).select(f"{HELD}_{name}.*")
