"""Relation tables that link the stages of a specimen, and the matches against them.

Three tables, each with one row per key:
  person    (personIdCard, tubeCode) -> collectTime, checkTime
  tube      tubeCode                 -> tubeCollectTime, collectSubmitId
  delivery  deliveryCode             -> deliveryTime, tubeNum, packNum, receiveTime
(times also as timestamps: collectTs, checkTs and so on). They are built by partial
aggregation (last write wins per column) and joined, so a lookup of any number of
records costs one shuffle rather than a read per record.

The place of a write is one number of fixed width, so that the aggregates hash and never
sort: second, partition and offset of the message, position in the message.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import is_blank
from ..functions.times import format_time
from ..schemas import time_column
from .joins import keyed_left_join
from .repartition import by_key

PERSON_KEY = ("personIdCard", "tubeCode")
TUBE_KEY = ("tubeCode",)
DELIVERY_KEY = ("deliveryCode",)
ORDER = ("recTs", "message_id", "pos")


# digits of the parts of a place; together they fill a decimal(38, 0)
SECOND_DIGITS, PARTITION_DIGITS, OFFSET_DIGITS, POSITION_DIGITS = 12, 5, 15, 6
FIRST_SECOND = 10 ** 11  # added, so that times before 1970 are positive, too


def _digits(value: Column, width: int) -> Column:
    return F.lpad(F.right(value, F.lit(width)), width, "0")


def arrival_order(order=ORDER) -> Column:
    """Place of a row in time as decimal(38, 0): the last write wins inside a second and inside
    a message, too.

    A message id ends in the number of the message in its partition, with the partition
    before it where there are several; an id without numbers gets one from a hash. A row
    without a time comes before all others.
    """
    first, message, *position = order
    text = F.coalesce(F.col(message).cast("string"), F.lit(""))
    offset = F.regexp_extract(text, r"(\d+)$", 1)
    offset = F.when(offset != "", offset).otherwise(F.crc32(text).cast("string"))
    seconds = F.coalesce(F.unix_seconds(first) + F.lit(FIRST_SECOND), F.lit(0)).cast("string")
    place = F.col(position[0]).cast("string") if position else F.lit("0")
    return F.concat(
        _digits(seconds, SECOND_DIGITS),
        _digits(F.regexp_extract(text, r"(\d+)\D\d+$", 1), PARTITION_DIGITS),
        _digits(offset, OFFSET_DIGITS),
        _digits(F.coalesce(place, F.lit("0")), POSITION_DIGITS)).cast("decimal(38,0)")


def _latest(column: str) -> Column:
    return F.max_by(column, F.when(F.col(column).isNotNull(), F.col("_place"))).alias(column)


def _latest_per_key(rows: DataFrame, keys, columns, partitions: int | None = None) -> DataFrame:
    present = by_key(rows.dropna(subset=list(keys)), keys, partitions)
    return present.groupBy(*keys).agg(*[_latest(c) for c in columns])


def _with_text(table: DataFrame, *times: str) -> DataFrame:
    return table.withColumns({t: format_time(time_column(t)) for t in times})


def person_relation(collect: DataFrame, report: DataFrame, order=ORDER) -> DataFrame:
    """Latest collect and check time of each person and tube."""
    nothing = F.lit(None).cast("timestamp")
    place = arrival_order(order).alias("_place")
    rows = collect.select(*PERSON_KEY, "collectTs", nothing.alias("checkTs"), place)
    rows = rows.unionByName(
        report.select(*PERSON_KEY, nothing.alias("collectTs"), "checkTs", place))
    table = _latest_per_key(rows, PERSON_KEY, ("collectTs", "checkTs"))
    return _with_text(table, "collectTime", "checkTime")


def tube_relation(collect: DataFrame, order=ORDER) -> DataFrame:
    """Latest collect time and submission of each tube."""
    rows = collect.select(*TUBE_KEY, F.col("collectTs").alias("tubeCollectTs"),
                          F.col("submitId").alias("collectSubmitId"),
                          arrival_order(order).alias("_place"))
    table = _latest_per_key(rows, TUBE_KEY, ("tubeCollectTs", "collectSubmitId"))
    return _with_text(table, "tubeCollectTime").withColumn(
        "collectSubmitId", F.col("collectSubmitId").cast("string"))


def delivery_relation(transport: DataFrame, receive: DataFrame, order=ORDER,
                      partitions: int | None = None) -> DataFrame:
    """Latest transport and receive facts of each delivery. ``partitions`` for large inputs of
    few rows per delivery, which aggregation ahead of the shuffle would only hold, not lessen."""
    nothing, place = F.lit(None), arrival_order(order).alias("_place")
    sent = transport.select(
        *DELIVERY_KEY, "deliveryTs", F.col("tubeNum").cast("int").alias("tubeNum"),
        F.col("packNum").cast("int").alias("packNum"),
        nothing.cast("timestamp").alias("receiveTs"), place)
    got = receive.select(
        *DELIVERY_KEY, nothing.cast("timestamp").alias("deliveryTs"),
        nothing.cast("int").alias("tubeNum"), nothing.cast("int").alias("packNum"),
        "receiveTs", place)
    table = _latest_per_key(sent.unionByName(got), DELIVERY_KEY,
                            ("deliveryTs", "tubeNum", "packNum", "receiveTs"), partitions)
    return _with_text(table, "deliveryTime", "receiveTime")


def merge_relation(stored: DataFrame | None, fresh: DataFrame, keys) -> DataFrame:
    """Rows of a later batch completed by what is stored, column by column.

    Only the keys of the batch come back: written to a keyed table, they replace the
    stored rows of these keys and leave all others alone.
    """
    if stored is None:
        return fresh
    values = [c for c in fresh.columns if c not in keys]
    old = stored.select(*keys, *[F.col(c).alias(f"_o_{c}") for c in values])
    joined = fresh.join(old, list(keys), "left")
    return joined.select(*keys, *[F.coalesce(c, f"_o_{c}").alias(c) for c in values])


def _prefixed(table: DataFrame, keys, columns: dict[str, str]) -> DataFrame:
    return table.select(*keys, *[F.col(c).alias(n) for c, n in columns.items()])


def match_collect_report(collect: DataFrame, person: DataFrame) -> DataFrame:
    """Collect records with the check time of their report (``matchCheckTime``)."""
    table = _prefixed(person.filter(F.col("checkTs").isNotNull()), PERSON_KEY,
                      {"checkTime": "matchCheckTime", "checkTs": "matchCheckTs"})
    return keyed_left_join(collect, table, PERSON_KEY)


def match_report_collect(report: DataFrame, person: DataFrame) -> DataFrame:
    """Report records with the collect time on record (``matchCollectTime``)."""
    table = _prefixed(person.filter(F.col("collectTs").isNotNull()), PERSON_KEY,
                      {"collectTime": "matchCollectTime"})
    return keyed_left_join(report, table, PERSON_KEY)


def match_receive_transport(receive: DataFrame, delivery: DataFrame,
                            partitions: int | None = None) -> DataFrame:
    """Receive records with what the transport record of the delivery says."""
    sent = delivery.filter("deliveryTs is not null or tubeNum is not null or packNum is not null")
    table = _prefixed(sent, DELIVERY_KEY, {
        "deliveryTime": "matchDeliveryTime", "deliveryTs": "matchDeliveryTs",
        "tubeNum": "matchTubeNum", "packNum": "matchPackNum"})
    return keyed_left_join(receive, table, DELIVERY_KEY, partitions)


def match_transport_receive(transport: DataFrame, delivery: DataFrame,
                            partitions: int | None = None) -> DataFrame:
    """Transport records with the receive time of the delivery."""
    table = _prefixed(delivery.filter(F.col("receiveTs").isNotNull()), DELIVERY_KEY,
                      {"receiveTime": "matchReceiveTime", "receiveTs": "matchReceiveTs"})
    return keyed_left_join(transport, table, DELIVERY_KEY, partitions)


def match_tubes_collect(transport: DataFrame, tubes: DataFrame,
                        items: str = "transportItem") -> DataFrame:
    """One row per transported tube, with the collect record of the tube."""
    exploded = transport.select(*[c for c in transport.columns if c != items],
                                F.posexplode(items).alias("itemPos", "_item"))
    exploded = exploded.withColumn("tubeCode", F.col("_item.tubeCode")).drop("_item")
    found = tubes.filter("tubeCollectTs is not null and collectSubmitId is not null")
    return keyed_left_join(exploded, found, TUBE_KEY)


def with_collected_flag(report: DataFrame, collected: DataFrame) -> DataFrame:
    """Report records with ``isCollected``: the person and tube have a collect record."""
    known = (collected.filter(~is_blank("collectTime")).select(*PERSON_KEY).dropna()
             .distinct().withColumn("_hit", F.lit(True)))
    return (keyed_left_join(report, known, PERSON_KEY)
            .withColumn("isCollected", F.col("_hit").isNotNull()).drop("_hit"))


def upload_number(report: DataFrame, collected: DataFrame, groups) -> DataFrame:
    """Distinct persons and tubes per group that have a collect record; 0 where none."""
    flagged = with_collected_flag(report, collected)
    person, tube = PERSON_KEY
    return flagged.groupBy(*groups).agg(
        F.countDistinct(F.when(F.col("isCollected"), F.col(person)), F.col(tube))
        .alias("upload_number"))
