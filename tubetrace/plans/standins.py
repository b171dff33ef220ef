"""Stage rows and messages derived from the generic test tables.

The test tables hold no specimen messages, so each stage is mapped onto them row by row:
  events            all four stages by event type, for the windowed statistics
  orders            collect records;  lineitem: report, transport and receive records
  conversations     batches of turns as messages, for the per-message log
Every mapping keeps the pushdown of filters and columns into the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.times import format_time
from ..operators import relations
from ..operators.repartition import by_key, rebalance

EVENT_TYPES = {"collect": "signup", "transport": "click", "receive": "purchase",
               "report": "error"}
EVENTS_NOW = "2024-02-01 00:00:00"
ORDERS_NOW = "2002-01-01 00:00:00"
TURNS_PER_MESSAGE = 16


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table. Its schema is read from the files once, not on every use."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def at(text: str) -> Column:
    return F.lit(text).cast("timestamp")


def text(value) -> Column:
    return F.col(value).cast("string") if isinstance(value, str) else value.cast("string")


def person_number(key: str) -> Column:
    """One key in three as an identity number, the rest as a bare number, some of those with
    a special character. Different keys stay different."""
    k = F.col(key)
    number = F.concat(F.lit("1"), F.lpad(text((k / 10000).cast("bigint")), 5, "0"),
                      F.lit("19900111"), F.lpad(text(k % 10000), 4, "0"))
    return (F.when(k % 50 == 7, F.concat(text(k), F.lit("#")))
            .when((k % 3 == 0) & (k < 1_000_000_000), number).otherwise(text(k)))


def phone(key: str) -> Column:
    """One key in four as a mobile number, one with a special character, two malformed."""
    k = F.col(key)
    return (F.when(k % 4 == 0, F.concat(F.lit("139"), F.lpad(text(k % 100_000_000), 8, "0")))
            .when(k % 4 == 1, F.concat(text(k), F.lit("#"))).otherwise(text(k)))


def person_name(key: str) -> Column:
    return F.concat(F.lit("name"), F.when(F.col(key) % 10 == 0, F.lit("#")).otherwise(F.lit("")))


def event_stage(spark: SparkSession, sf_dir: str, stage: str,
                events: DataFrame | None = None) -> DataFrame:
    """Records of one stage from ``events`` (or from a stream of them)."""
    events = table(spark, sf_dir, "events") if events is None else events
    rows = events.filter(F.col("event_type") == EVENT_TYPES[stage])
    k = F.get_json_object("props", "$.k").cast("bigint")
    received = F.date_trunc("second", F.col("ts").cast("timestamp"))
    minutes = F.floor("value").cast("int")
    rows = rows.select("event_id", "user_id", k.alias("k"), received.alias("recTs"),
                       F.timestamp_add("MINUTE", -minutes, received).alias("stageTs"))
    user, num = F.col("user_id"), F.col("k")
    common = [
        text("event_id").alias("message_id"), F.lit(0).alias("pos"), "event_id", "recTs",
        format_time("recTs").alias("interfaceRecTime"), (user % 10).alias("areaId"),
        (user % 25).alias("clientId"), F.concat(F.lit("u"), text(user % 7)).alias("userName"),
        (F.col("event_id") % 3).cast("int").alias("dropDataNum"),
        F.col("event_id").alias("submitId"), (F.col("event_id") / 100).cast("bigint")
        .alias("numberReport"), format_time("recTs").alias("addTime")]
    id_card = F.concat(F.lit("1"), F.lpad(text((user / 10000).cast("bigint")), 5, "0"),
                       F.lit("19900111"), F.lpad(text(user % 10000), 4, "0"))
    mobile = F.concat(F.lit("139"), F.lpad(text(user % 100_000_000), 8, "0"))
    person = [F.when(user % 10 == 3, text(user)).otherwise(id_card).alias("personIdCard"),
              text("user_id").alias("personId"), text("k").alias("tubeCode"),
              F.when(user % 10 == 4, text(user)).otherwise(mobile).alias("personPhone"),
              F.concat(F.lit("name"), F.when(num % 10 == 0, F.lit("#")).otherwise(F.lit("")))
              .alias("personName"),
              F.concat(F.lit("c"), text(num % 3)).alias("collectLocationCity"),
              F.concat(F.lit("d"), text(num % 5)).alias("collectLocationDistrict"),
              F.concat(F.lit("l"), text(num % 4)).alias("collectLocationName"),
              F.lit(1).alias("collectCount"), (num % 20).cast("int").alias("collectLimitnum")]
    stage_time = format_time("stageTs")
    org = F.concat(F.lit("Supplier#"), F.lpad(text(user % 120), 9, "0"))
    if stage == "collect":
        own = [*person, F.col("stageTs").alias("collectTs"), stage_time.alias("collectTime"),
               org.alias("collectOrgName")]
    elif stage == "report":
        checked = F.timestamp_add("MINUTE", (num * 30).cast("int"), F.col("stageTs"))
        rows = rows.withColumns({
            "checkTs": checked,
            "packTs": F.timestamp_add("MINUTE", (num % 5).cast("int"), F.col("stageTs"))})
        rows = rows.withColumn("receiveTs", F.timestamp_add(
            "MINUTE", (-15 - num % 4 * 10).cast("int"), F.col("checkTs")))
        own = [*person, F.col("stageTs").alias("collectTs"), stage_time.alias("collectTime"),
               "checkTs", format_time("checkTs").alias("checkTime"), org.alias("checkOrgName"),
               "packTs", format_time("packTs").alias("packTime"),
               "receiveTs", format_time("receiveTs").alias("receiveTime")]
    elif stage == "transport":
        own = [num.cast("int").alias("tubeNum"), F.col("stageTs").alias("deliveryTs"),
               stage_time.alias("deliveryTime"), org.alias("transportOrgName"),
               F.concat(F.lit("l"), text(num % 4)).alias("collectAddress")]
    else:
        own = [num.cast("int").alias("tubeNum"), F.col("stageTs").alias("receiveTs"),
               stage_time.alias("receiveTime"), org.alias("receiveOrgName")]
    return rows.select(*common, *own)


def collect_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` as collect records. Every fifth is uploaded a day too early."""
    o = table(spark, sf_dir, "orders")
    collected = F.col("o_orderdate").cast("timestamp")
    added = F.timestamp_add("DAY", (F.col("o_orderkey") % 5 - 1).cast("int"), collected)
    return o.select(
        text("o_orderkey").alias("message_id"), F.lit(0).alias("pos"),
        person_number("o_custkey").alias("personIdCard"), text("o_orderkey").alias("tubeCode"),
        phone("o_custkey").alias("personPhone"), person_name("o_custkey").alias("personName"),
        (F.col("o_orderkey") % 7).cast("int").alias("collectCount"),
        (F.col("o_orderkey") % 11).cast("int").alias("collectLimitnum"),
        F.col("o_orderkey").alias("submitId"), (F.col("o_custkey") % 10).alias("areaId"),
        F.col("o_orderpriority").alias("collectLocationDistrict"), collected.alias("collectTs"),
        format_time(collected).alias("collectTime"), format_time(added).alias("addTime"),
        added.alias("recTs"), F.col("o_orderkey").alias("numberReport"),
        F.lit("loader").alias("userName"))


def report_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as report records, with the collect facts of their order."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    lines = rebalance(table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate"))
    # one row per order at most: the join cannot multiply lines
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey, "left")
    collected, checked = F.col("o_orderdate").cast("timestamp"), F.col("l_shipdate").cast("timestamp")
    part = F.col("l_partkey")
    packed = (F.when(part % 19 == 0, F.lit(None).cast("timestamp"))
              .when(part % 23 == 0, F.timestamp_add("HOUR", F.lit(1), checked))
              .otherwise(F.timestamp_add("MINUTE", (part % 5 - 1).cast("int"), collected)))
    received = (F.when(part % 17 == 0, F.timestamp_add("HOUR", F.lit(-1), collected))
                .otherwise(F.timestamp_add("MINUTE", (20 - part % 7 * 10).cast("int"), checked)))
    return joined.select(
        "l_orderkey", "l_partkey", "l_linenumber",
        person_number("o_custkey").alias("personIdCard"), text("l_orderkey").alias("tubeCode"),
        phone("o_custkey").alias("personPhone"), person_name("o_custkey").alias("personName"),
        (part % 9).cast("int").alias("collectCount"),
        F.when(part % 13 != 0, 10).alias("collectLimitnum"),
        packed.alias("packTs"), format_time(packed).alias("packTime"),
        received.alias("receiveTs"), format_time(received).alias("receiveTime"),
        F.col("l_orderkey").alias("submitId"), (F.col("o_custkey") % 10).alias("areaId"),
        F.col("o_orderpriority").alias("collectLocationDistrict"),
        F.concat(F.lit("Supplier#"), F.lpad(text("l_suppkey"), 9, "0")).alias("checkOrgName"),
        collected.alias("collectTs"), format_time(collected).alias("collectTime"),
        checked.alias("checkTs"), format_time(checked).alias("checkTime"),
        format_time(F.timestamp_add("DAY", (part % 6 - 1).cast("int"), checked)).alias("addTime"),
        checked.alias("recTs"), F.col("l_orderkey").alias("numberReport"),
        F.lit("loader").alias("userName"))


def delivery_code() -> Column:
    return F.concat_ws("-", text("l_orderkey"), text("l_suppkey")).alias("deliveryCode")


LOAD_KEY = ("l_orderkey", "l_suppkey")
LINES_PER_PARTITION = 250_000
LINES_PER_SLICE = 30_000_000


def load_partitions(spark: SparkSession, sf_dir: str) -> int | None:
    """Partitions for work on loads, by the number of lines, which the files tell without
    being read; None where the session's number is enough."""
    return _beyond_session(spark, table(spark, sf_dir, "lineitem").count())


def _beyond_session(spark: SparkSession, lines: int) -> int | None:
    parts = -(-lines // LINES_PER_PARTITION)
    return parts if parts > int(spark.conf.get("spark.sql.shuffle.partitions")) else None


def load_slices(spark: SparkSession, sf_dir: str) -> tuple[int, int | None]:
    """Slices of the loads for work that would take too much disk on all at once, and the
    partitions for the work on one of them (see ``load_partitions``)."""
    lines = table(spark, sf_dir, "lineitem").count()
    slices = max(1, -(-lines // LINES_PER_SLICE))
    return slices, _beyond_session(spark, lines // slices)


def _loads(spark: SparkSession, sf_dir: str, lines: DataFrame, *facts: Column) -> DataFrame:
    # few lines make a load: the shuffle comes first, and one task never holds more than its
    # share of a fixed number of lines
    dealt = by_key(lines, LOAD_KEY, load_partitions(spark, sf_dir))
    return dealt.groupBy(*LOAD_KEY).agg(
        *facts, F.count("*").cast("int").alias("tubeNum"),
        F.countDistinct("l_partkey").cast("int").alias("packNum"))


def sent_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the lines of one order and supplier add up to."""
    return _loads(spark, sf_dir, table(spark, sf_dir, "lineitem"),
                  F.min("l_shipdate").cast("timestamp").alias("deliveryTs"))


def got_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the finished lines of one order and supplier add up to."""
    lines = table(spark, sf_dir, "lineitem").filter(F.col("l_linestatus") == "F")
    return _loads(spark, sf_dir, lines, F.max("l_shipdate").cast("timestamp").alias("receiveTs"))


def transport_records(spark: SparkSession, sf_dir: str, loads=None) -> DataFrame:
    """Lines of one order and supplier as a transport record; ``loads`` if they are there."""
    sent = sent_loads(spark, sf_dir) if loads is None else loads
    packed = F.timestamp_add("HOUR", (F.col("l_orderkey") % 4 - 2).cast("int"), F.col("deliveryTs"))
    return sent.select(
        delivery_code().alias("message_id"), F.lit(0).alias("pos"), delivery_code(),
        "l_orderkey", "l_suppkey", F.col("l_orderkey").alias("submitId"),
        (F.col("l_suppkey") % 10).alias("areaId"), "deliveryTs",
        format_time("deliveryTs").alias("deliveryTime"), format_time(packed).alias("packTime"),
        delivery_code().alias("deliveryName"), "tubeNum", "packNum",
        format_time("deliveryTs").alias("addTime"), F.col("deliveryTs").alias("recTs"),
        F.col("l_orderkey").alias("numberReport"), F.lit("loader").alias("userName"),
        F.array(F.struct(text("l_orderkey").alias("tubeCode")),
                F.struct(text(F.col("l_orderkey") + 1).alias("tubeCode"))).alias("transportItem"))


def receive_records(spark: SparkSession, sf_dir: str, loads=None) -> DataFrame:
    """Finished lines of one order and supplier as a receive record; ``loads`` if they are
    there."""
    got = got_loads(spark, sf_dir) if loads is None else loads
    return got.select(
        delivery_code().alias("message_id"), F.lit(0).alias("pos"), delivery_code(),
        "l_orderkey", "l_suppkey", F.col("l_orderkey").alias("submitId"),
        (F.col("l_suppkey") % 10).alias("areaId"), "receiveTs",
        format_time("receiveTs").alias("receiveTime"), delivery_code().alias("receiveCode"),
        delivery_code().alias("receiveName"), "tubeNum", "packNum",
        person_number("l_suppkey").alias("deliveryPrpId"),
        phone("l_suppkey").alias("deliveryPrpPhone"),
        person_number("l_orderkey").alias("transportPrpId"),
        phone("l_orderkey").alias("transportPrpPhone"),
        format_time("receiveTs").alias("addTime"), F.col("receiveTs").alias("recTs"),
        F.col("l_orderkey").alias("numberReport"), F.lit("loader").alias("userName"))


def person_table(spark, sf_dir) -> DataFrame:
    """Relation of the order tables: person and tube -> collect and check time."""
    report = report_records(spark, sf_dir).withColumn("message_id", text("tubeCode"))
    return relations.person_relation(collect_records(spark, sf_dir), report,
                                     order=("recTs", "message_id"))


def tube_table(spark, sf_dir) -> DataFrame:
    return relations.tube_relation(collect_records(spark, sf_dir), order=("recTs", "message_id"))


def delivery_table(spark, sf_dir, sent=None, got=None, partitions=None) -> DataFrame:
    """Relation of deliveries, from transport and receive records that are there already or
    are made here; ``partitions`` if they are not all loads."""
    sent = transport_records(spark, sf_dir) if sent is None else sent
    got = receive_records(spark, sf_dir) if got is None else got
    return relations.delivery_relation(sent, got, order=("recTs", "message_id"),
                                       partitions=partitions or load_partitions(spark, sf_dir))


# --- messages ------------------------------------------------------------------------

MESSAGE_TYPES = {"signup": "COLLECT_DATA", "click": "TRANSPORT_DATA", "purchase": "RECEIVE_DATA",
                 "error": "REPORT_DATA", "view": "PAGE_VIEW"}


def _message(kind: Column, user: Column, client: Column, number: Column, received: Column,
             dropped: Column, data: Column) -> Column:
    return F.to_json(F.struct(
        user.alias("userName"), kind.alias("type"), client.alias("clientId"),
        number.alias("numberReport"), received.alias("interfaceRecTime"),
        dropped.alias("dropDataNum"), data.alias("data")))


def _as_source(value: Column) -> Column:
    # a message arrives as a plain column; an expression would be repeated by every
    # filter that looks at it
    return F.explode(F.array(value)).alias("value")


def _event_element(kind: Column, extra: int) -> Column:
    """Element of an event message; only the fields of its kind are set."""
    event, user, k = F.col("event_id"), F.col("user_id"), F.col("k") + extra
    moment = format_time("stageTs")

    def only(*kinds):
        return lambda value: F.when(kind.isin(*kinds), value)

    collect, transport = only("COLLECT_DATA"), only("TRANSPORT_DATA")
    receive, report = only("RECEIVE_DATA"), only("REPORT_DATA", "XA_REPORT_DATA")
    person = only("COLLECT_DATA", "REPORT_DATA", "XA_REPORT_DATA")
    load = only("TRANSPORT_DATA", "RECEIVE_DATA")
    code = F.concat(F.lit("D"), text(user), F.lit("-"), text(k))
    items = F.array(F.struct(text(k).alias("tubeCode"), F.lit("p").alias("packCode")))
    added = format_time("recTs")
    return F.struct(
        (user % 10).alias("areaId"), (event * 2 + extra).alias("submitId"),
        person(text(user)).alias("personIdCard"), person(text(user)).alias("personId"),
        person(text(k)).alias("tubeCode"), person(moment).alias("collectTime"),
        report(added).alias("checkTime"), report(text(k % 4)).alias("checkResult"),
        collect(F.lit(1)).alias("collectCount"),
        load(code).alias("deliveryCode"), transport(moment).alias("deliveryTime"),
        receive(F.concat(F.lit("R"), text(event))).alias("receiveCode"),
        receive(moment).alias("receiveTime"), load(text(k)).alias("tubeNum"),
        transport(items).alias("transportItem"), receive(items).alias("receivesItem"),
        only("COLLECT_DATA", "RECEIVE_DATA")(added).alias("addTime"),
        only("TRANSPORT_DATA", "REPORT_DATA", "XA_REPORT_DATA")(added).alias("addtime"))


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One message of two elements per event, as JSON text."""
    kind = F.lit(None).cast("string")
    for event_type, tag in MESSAGE_TYPES.items():
        kind = F.when(F.col("event_type") == event_type, F.lit(tag)).otherwise(kind)
    received = F.date_trunc("second", F.col("ts").cast("timestamp"))
    events = rebalance(table(spark, sf_dir, "events"))
    rows = events.select(
        "event_id", "user_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        received.alias("recTs"), kind.alias("kind"),
        F.timestamp_add("MINUTE", -F.floor("value").cast("int"), received).alias("stageTs"))
    rows = rows.withColumn("kind", F.when(
        (F.col("kind") == "REPORT_DATA") & (F.col("event_id") % 2 == 1),
        F.lit("XA_REPORT_DATA")).otherwise(F.col("kind")))
    data = F.array(_event_element(F.col("kind"), 0), _event_element(F.col("kind"), 1))
    return rows.select(
        text("event_id").alias("message_id"),
        _as_source(_message(F.col("kind"), F.concat(F.lit("u"), text(F.col("user_id") % 7)),
                            F.col("user_id") % 25, text("event_id"), format_time("recTs"),
                            F.col("event_id") % 3, data)))


def damaged_event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event messages, some of them blank, cut off or without a type."""
    n = F.col("message_id").cast("bigint") % 50
    value = (F.when(n == 0, F.expr("substring(value, 1, 40)")).when(n == 1, F.lit("  "))
             .when(n == 2, F.regexp_replace("value", '"type":"[A-Z_]+",', ""))
             .when(n == 3, F.lit("not json")).otherwise(F.col("value")))
    return event_messages(spark, sf_dir).select("message_id", _as_source(value))


def conversation_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of turns as collect messages. A batch holds at most 16 turns, because
    (conversation, turn) is unique: the list per group is bounded."""
    turns = table(spark, sf_dir, "conversations")
    conv, turn = F.col("conv_id"), F.col("turn")
    batch = F.floor(turn / TURNS_PER_MESSAGE).cast("bigint")
    hour = F.lpad(text(conv % 20), 2, "0")
    element = F.struct(
        turn.alias("turn"),
        F.when(conv % 7 != 3, conv % 10).alias("areaId"),
        (conv * 1000 + turn).alias("submitId"), conv.alias("recordId"),
        F.col("text").alias("personName"), F.col("role").alias("collectUser"),
        F.concat(F.lit("2024-01-31 "), hour, F.lit(":30:00")).alias("collectTime"),
        F.when(conv % 11 == 5, F.lit(" "))
        .otherwise(F.concat(F.lit("2024-01-31 "), hour, F.when(turn % 9 == 4, F.lit(":00:00"))
                            .otherwise(F.lit(":45:00")))).alias("addTime"),
        F.lit(1).alias("collectCount"), (turn % 13).alias("collectLimitnum"))
    batches = turns.groupBy("conv_id", batch.alias("batch")).agg(
        F.sort_array(F.collect_list(element)).alias("data"))
    kind = F.when(conv % 13 == 6, F.lit("OTHER_DATA")).otherwise(F.lit("COLLECT_DATA"))
    return batches.select(
        F.concat_ws("-", text("conv_id"), text("batch")).alias("message_id"),
        _as_source(_message(kind, F.concat(F.lit("u"), text(conv % 7)), conv % 25,
                            text("conv_id"), F.lit("2024-01-31 23:50:00"), conv % 3,
                            F.col("data"))))


def hourly_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One hourly summary message per order."""
    o = rebalance(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate"))
    key = F.col("o_orderkey")
    element = F.struct(
        (F.col("o_custkey") % 10).alias("areaId"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("collectDate"),
        (key % 3).alias("unitHour"),
        (key % 11).alias("collectPersons"), (key % 13).alias("collectSampleNum"),
        (key % 17).alias("transferPersons"), (key % 19).alias("transferSampleNum"),
        (key % 23).alias("receivePersons"), (key % 29).alias("receiveSampleNum"),
        (key % 31).alias("checkPersons"), (key % 37).alias("checkSampleNum"))
    tag = F.when(key % 2 == 0, F.lit("HOUR_SUM_REPORT")).otherwise(F.lit("hour_sum_report"))
    return o.select(
        text("o_orderkey").alias("message_id"),
        _as_source(_message(tag, F.lit("loader"), key % 25, text("o_orderkey"),
                            format_time(F.col("o_orderdate").cast("timestamp")), F.lit(0),
                            F.array(element))))
