"""Left joins: against a keyed table of any size, and against small dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .repartition import by_key

NULL_KEY_SPREAD = 1024


ROW_IDENTITY = ("message_id", "pos")


def keyed_left_join(df: DataFrame, table: DataFrame, keys,
                    partitions: int | None = None) -> DataFrame:
    """Left join on a table with one row per key.

    Rows whose key is null can match nothing; they are spread over many tasks by their
    identity, or else by all they hold, instead of meeting in one. A hot key that does match is
    split by adaptive execution: the table side holds a single row for it. With ``partitions``
    both sides are dealt out by key beforehand and no key is split: for few rows per key.
    """
    keys = list(keys)
    identity = [c for c in ROW_IDENTITY if c in df.columns] or df.columns
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    spread = F.when(missing, F.pmod(F.xxhash64(*identity), F.lit(NULL_KEY_SPREAD)) + 1)
    left = df.withColumn("_spread", F.coalesce(spread, F.lit(0)).cast("int"))
    right = table.withColumn("_spread", F.lit(0))
    on = [*keys, "_spread"]
    left, right = by_key(left, on, partitions), by_key(right, on, partitions)
    return left.join(right, on, "left").drop("_spread")


def one_row_per_key(table: DataFrame, keys, order) -> DataFrame:
    """Drop repeated keys so that a join cannot multiply rows; keeps the lowest row."""
    rest = [c for c in table.columns if c not in keys]
    if not rest:
        return table.distinct()
    row = F.min_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return table.groupBy(*keys).agg(row).select(*keys, *[F.col("_row")[c].alias(c) for c in rest])


def lookup_join(df: DataFrame, dimension: DataFrame, keys, order=None) -> DataFrame:
    """Left join against a dimension; unmatched rows are kept with nulls.

    Whether the dimension is broadcast is left to the engine, which knows its bytes when
    the join runs; in a stream that is decided anew for each batch.
    """
    keys = list(keys)
    order = list(order or [c for c in dimension.columns if c not in keys])
    return keyed_left_join(df, one_row_per_key(dimension, keys, order), keys)
