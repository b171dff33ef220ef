"""Spreading rows over the cluster where the input arrives in too few pieces."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rebalance(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Spread rows evenly over ``partitions`` (default: one per core).

    For costly work on an input of few large pieces, such as a topic with a handful of
    partitions. Where the input already comes in at least half as many, nothing is
    moved. Looks at the plan only; use it right behind a source.
    """
    wanted = partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() * 2 >= wanted:
        return df
    return df.repartition(wanted)


def by_key(df: DataFrame, keys, partitions: int | None) -> DataFrame:
    """Rows of a key together in one of ``partitions``, for a caller that knows how many rows
    there are: what one task holds does not grow with them then. None leaves the number to the
    session."""
    return df if partitions is None else df.repartition(partitions, *keys)


def slice_number(key: Column, slices: int) -> Column:
    """One of ``slices`` numbers, the same for all rows of a key: work that looks at one key at
    a time can go through the slices one after the other. Not the hash that Spark deals
    partitions by, so that a slice still fills all of them."""
    return F.pmod(F.xxhash64(key), F.lit(slices)).cast("int")
