"""Stable ids per business key, and de-duplication by business key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scan import row_numbers

# The fields that make up the business key of each message type. Every
# type is an id space of its own.
BUSINESS_KEYS = {
    "COLLECT_DATA": ("personIdCard", "collectTime"),
    "TRANSPORT_DATA": ("deliveryCode",),
    "RECEIVE_DATA": ("receiveCode",),
    "REPORT_DATA": ("personIdCard", "collectTime", "checkTime"),
    "XA_REPORT_DATA": ("personIdCard", "collectTime", "checkTime"),
    "CHECK_ORG": ("creditCode", "areaId", "orgName"),
    "HOUR_SUM_REPORT": ("areaId", "collectDate", "unitHour"),
}
# Id spaces of the tubes nested in transport and receive elements.
TUBE_SPACES = {"transportItem": "TRANSPORT_TUBE", "receivesItem": "RECEIVE_TUBE"}


def extend_id_map(id_map: DataFrame | None, df: DataFrame, keys, name="id",
                  chunks: int | None = None) -> DataFrame:
    """Id map with the new keys of ``df`` added; known keys keep their ids.

    New ids follow the highest one given so far, in key order. Collision-free at any
    size. The numbering is distributed: no single task sees all keys.
    """
    keys = list(keys)
    if id_map is None:
        return new_ids(df, None, keys, F.lit(0), name, chunks)
    top = id_map.agg(F.coalesce(F.max(name), F.lit(0))).scalar()
    added = new_ids(df, id_map, keys, top, name, chunks)
    return id_map.select(*keys, name).unionByName(added)


def new_ids(df: DataFrame, id_map: DataFrame | None, keys, top: Column, name="id",
            chunks: int | None = None) -> DataFrame:
    """Ids after ``top``, in key order, for the keys of ``df`` that are not in the map."""
    keys = list(keys)
    new = df.select(*keys).dropna().distinct()
    if id_map is not None:
        new = new.join(id_map, keys, "left_anti")
    return row_numbers(new, keys, "_n", chunks).select(*keys, (F.col("_n") + top).alias(name))


def assign_mapped_ids(df: DataFrame, id_map: DataFrame, keys, name="id") -> DataFrame:
    return df.join(id_map.select(*keys, name), list(keys), "left")


def dedup_stream(df: DataFrame, keys, time_column: str, delay: str) -> DataFrame:
    """Streaming form: the first row of each key that arrives, within ``delay`` of event time.
    Rows without a complete key cannot be told to be repeats and are left out, as rows without
    a time are."""
    complete = df.dropna(subset=[*keys, time_column])
    return (complete.withWatermark(time_column, delay)
            .dropDuplicatesWithinWatermark(list(keys)))


def dedup_by_key(df: DataFrame, keys, order, latest: bool = False) -> DataFrame:
    """One row per key: the first in ``order``, or the last. Partially aggregated."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    pick = F.max_by if latest else F.min_by
    row = pick(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(row).select(*keys, *[F.col("_row")[c].alias(c) for c in rest])
