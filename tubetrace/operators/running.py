"""Running accumulation of windowed rows per business key, and latest-row upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scan import CHUNK, ordered_scan, range_chunks


def running_accumulate(df: DataFrame, keys, order, sums=(), firsts=(),
                       hot_keys: bool = False, chunks: int | None = None) -> DataFrame:
    """Changelog: every input row, with its sums so far and first values of its key.

    Leave ``hot_keys`` off where the rows per key are bounded (window rows of one day);
    turn it on for raw rows, where one key may own a large part of the input.
    """
    keys, order = list(keys), list(order)
    rows = range_chunks(df, keys, order, chunks) if hot_keys else df
    out = ordered_scan(
        rows, keys, order,
        running={f"_r_{c}": F.col(c) for c in sums},
        first={f"_f_{c}": F.col(c) for c in firsts})
    return (out.withColumns({c: F.col(f"_r_{c}") for c in sums})
            .withColumns({c: F.col(f"_f_{c}") for c in firsts})
            .drop(CHUNK, *[f"_r_{c}" for c in sums], *[f"_f_{c}" for c in firsts]))


FRESH = "_fresh"


def after_stored(rows: DataFrame, stored: DataFrame | None, keys, columns) -> DataFrame:
    """Rows to be scanned behind the stored totals of their keys, which come as rows with 0 in
    ``FRESH``. Order by it first, and keep the rows with 1 afterwards."""
    fresh = rows.withColumn(FRESH, F.lit(1))
    if stored is None:
        return fresh
    known = stored.select(*keys, *columns, F.lit(0).alias(FRESH))
    known = known.join(rows.select(*keys).distinct(), list(keys), "left_semi")
    return fresh.unionByName(known, allowMissingColumns=True)


def accumulated(df: DataFrame, keys, order, sums=(), firsts=(), lasts=()) -> DataFrame:
    """Final table: one row per key. Partially aggregated, so hot keys are no burden."""
    place = F.struct(*order)
    return df.groupBy(*keys).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums],
        *[F.min_by(c, place).alias(c) for c in firsts],
        *[F.max_by(c, place).alias(c) for c in lasts])


def add_to_stored(stored: DataFrame | None, fresh: DataFrame, keys, sums, firsts=()) -> DataFrame:
    """Totals of a batch added to the stored totals; only the keys of the batch come back."""
    if stored is None:
        return fresh
    old = stored.select(*keys, *[F.col(c).alias(f"_o_{c}") for c in (*sums, *firsts)])
    joined = fresh.join(old, list(keys), "left")
    return joined.withColumns({
        **{c: F.col(c) + F.coalesce(f"_o_{c}", F.lit(0)) for c in sums},
        **{c: F.coalesce(f"_o_{c}", c) for c in firsts},
    }).select(*fresh.columns)


def upsert_latest(changelog: DataFrame, keys, order) -> DataFrame:
    """The table a primary-key sink holds after all rows: the last row of each key."""
    keys = list(keys)
    rest = [c for c in changelog.columns if c not in keys]
    row = F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return changelog.groupBy(*keys).agg(row).select(
        *keys, *[F.col("_row")[c].alias(c) for c in rest])
