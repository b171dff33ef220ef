"""Ordered scans per key that hold up when one key owns a large part of the rows.

A plain window function sends every row of a key to one task. Here the rows are first
cut into ranges of about equal size over (keys, order); each range is scanned on its
own, and what the scan of a range needs from the rows before it is one small carry row.
Ranges are contiguous, so only the first key of a range can have rows in the ranges before
it: there is at most one carry per range, however large the input and however hot a key.
The carries are broadcast, and the rows themselves are exchanged once after the cut.

The cut is checkpointed: range bounds come from a sample, and both the scan and the
carries must see the same cut even if an executor is lost and a stage runs again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..session import ensure_checkpoint_dir

CHUNK = "_chunk"


def range_chunks(df: DataFrame, keys, order, chunks: int | None = None) -> DataFrame:
    """Add the range number of each row; ``order`` must be unique within a key."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = chunks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    return (df.repartitionByRange(n, *keys, *order)
            .withColumn(CHUNK, F.spark_partition_id())
            .checkpoint())


def ordered_scan(df: DataFrame, keys, order, running=None, previous=None, latest=None,
                 first=None) -> DataFrame:
    """Add columns computed over the rows of a key up to and including the current one.

    running   name -> expression: sum so far
    previous  name -> expression: value on the row before, null on the first row
    latest    name -> expression: last non-null value so far
    first     name -> expression: value on the key's first row

    With the chunk column present (see ``range_chunks``) the scan is done per range and
    stitched together; without it, by plain window functions.
    """
    running, previous = running or {}, previous or {}
    latest, first = latest or {}, first or {}
    keys, order = list(keys), list(order)
    chunked = CHUNK in df.columns
    groups = [*keys, CHUNK] if chunked else keys
    window = Window.partitionBy(*groups).orderBy(*order)
    so_far = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    local = {}
    for name, expr in running.items():
        local[name] = F.coalesce(F.sum(expr).over(so_far), F.lit(0))
    for name, expr in previous.items():
        local[name] = F.lag(F.struct(expr.alias("v"))).over(window)
    for name, expr in latest.items():
        local[name] = F.last(expr, ignorenulls=True).over(so_far)
    for name, expr in first.items():
        local[name] = F.first(F.struct(expr.alias("v"))).over(so_far)
    scanned = df.withColumns(local)
    if chunked:
        carry = _carries(df, keys, order, running, previous, latest, first)
        scanned = scanned.join(*_null_safe(carry, groups), "left").drop(
            *[f"_g_{g}" for g in groups])
        combined = {}
        for name in running:
            combined[name] = F.col(name) + F.coalesce(f"_c_{name}", F.lit(0))
        for name in (*previous, *latest):
            combined[name] = F.coalesce(name, f"_c_{name}")
        for name in first:
            combined[name] = F.coalesce(f"_c_{name}", name)
        scanned = scanned.withColumns(combined).drop(
            *[f"_c_{n}" for n in (*running, *previous, *latest, *first)])
    return scanned.withColumns({n: F.col(n)["v"] for n in (*previous, *first)})


def _crossing(df: DataFrame, keys) -> DataFrame:
    """Rows of the keys that lie in several ranges: those at the bounds of more than one."""
    if not keys:
        return df
    key = F.struct(*keys)
    ends = df.groupBy(CHUNK).agg(F.min(key).alias("lo"), F.max(key).alias("hi"))
    bounds = ends.select(CHUNK, F.explode(F.array_distinct(F.array("lo", "hi"))).alias("key"))
    crossing = bounds.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key.*")
    return df.join(*_null_safe(crossing, keys), "left_semi")


def _carries(df, keys, order, running, previous, latest, first) -> DataFrame:
    """What the ranges before hand over to the first key of a range."""
    df = _crossing(df, keys)
    place = F.struct(*order)
    sums = {n: F.coalesce(F.sum(e), F.lit(0)).alias(n) for n, e in running.items()}
    ends = {n: F.max_by(F.struct(e.alias("v")), place).alias(n) for n, e in previous.items()}
    lasts = {n: F.max_by(e, F.when(e.isNotNull(), place)).alias(n) for n, e in latest.items()}
    firsts = {n: F.min_by(F.struct(e.alias("v")), place).alias(n) for n, e in first.items()}
    per_range = df.groupBy(*keys, CHUNK).agg(
        F.count("*").alias("_rows_of_range"), *sums.values(), *ends.values(), *lasts.values(), *firsts.values())
    before = (Window.partitionBy(*keys).orderBy(CHUNK)
              .rowsBetween(Window.unboundedPreceding, -1))
    return per_range.select(
        *keys, CHUNK, F.count("*").over(before).alias("_before"),
        *[F.sum(n).over(before).alias(f"_c_{n}") for n in sums],
        *[F.last(n).over(before).alias(f"_c_{n}") for n in ends],
        *[F.last(n, ignorenulls=True).over(before).alias(f"_c_{n}") for n in lasts],
        *[F.first(n).over(before).alias(f"_c_{n}") for n in firsts],
    ).filter(F.col("_before") > 0).drop("_before")


def _null_safe(table: DataFrame, columns) -> tuple[DataFrame, Column]:
    """A broadcast table of at most two rows per range, and the condition to join it on;
    its ``columns`` are renamed."""
    cond = F.lit(True)
    for c in columns:
        cond = cond & F.col(c).eqNullSafe(F.col(f"_g_{c}"))
    return F.broadcast(table.withColumnsRenamed({c: f"_g_{c}" for c in columns})), cond


def row_numbers(df: DataFrame, order, name="row_number", chunks: int | None = None) -> DataFrame:
    """Global row number in ``order``, without a single-task sort."""
    cut = range_chunks(df, [], order, chunks)
    return ordered_scan(cut, [], order, running={name: F.lit(1).cast("bigint")}).drop(CHUNK)
