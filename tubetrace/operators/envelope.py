"""Messages to parsed envelopes: parse, quarantine, route, explode.

The parser reads each message once into one layout that holds the fields of every kind,
so that all jobs and the quarantine agree on which messages are malformed. A cheap
substring test on the raw text goes first, so that a job for one kind does not pay for
parsing the others; ``read_messages`` is for jobs that need all kinds from one parse.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import is_blank
from ..functions.times import parse_time
from ..schemas import (ALL_KINDS, CORRUPT, ENVELOPE_FIELDS, HOURLY, STAGES, Stage,
                       ITEM_TYPE, envelope_schema, time_column)

KNOWN_TYPES = tuple(t for kind in ALL_KINDS for t in kind.types)


def drop_blank(messages: DataFrame) -> DataFrame:
    return messages.filter(~is_blank("value"))


def _decoded(messages: DataFrame, *columns: str) -> DataFrame:
    """Messages with the fields of their envelope.

    The parsed message goes through ``inline``: filters on its fields then stay above
    the parse. Pushed below, each would parse the text again.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = F.from_json(_one_spelling(F.col("value")), envelope_schema(), options)
    return messages.select("message_id", *columns, F.inline(F.array(parsed)))


def _one_spelling(value: Column) -> Column:
    # two of the producers spell the key addTime in lower case; quotes inside a text
    # value are escaped, so only keys match
    renamed = F.regexp_replace(value, r'"addtime"(\s*:)', '"addTime"$1')
    return F.when(value.contains('"addtime"'), renamed).otherwise(value)


def parse_envelope(messages: DataFrame, *kinds: Stage, keep_raw: bool = False) -> DataFrame:
    """Parsed, well-formed messages with a non-blank type.

    ``messages`` has ``message_id`` and ``value``. Result: ``message_id``, the envelope
    fields and ``data``, an array of string-first elements (plus ``value`` on request).
    """
    relevant = drop_blank(messages)
    if kinds:
        relevant = relevant.filter(_mentions_any(kinds))
    raw = ["value"] if keep_raw else []
    parsed = _decoded(relevant, *raw)
    parsed = parsed.filter(~is_blank("type") & F.col(CORRUPT).isNull())
    return _typed(parsed, *raw)


def _typed(parsed: DataFrame, *raw: str) -> DataFrame:
    fields = [F.col(name).try_cast(dtype).alias(name) for name, dtype in ENVELOPE_FIELDS.items()]
    return parsed.select("message_id", *raw, *fields, "data")


def _mentions_any(kinds) -> Column:
    """Necessary condition on the raw text for a message to be of one of the kinds."""
    text = F.upper("value") if HOURLY in kinds else F.col("value")
    # an escaped character could spell a tag differently: let the parser decide
    cond = F.col("value").contains("\\u")
    for kind in kinds:
        for tag in kind.types:
            cond = cond | text.contains(tag)
    return cond


def read_messages(messages: DataFrame, known_types=KNOWN_TYPES) -> DataFrame:
    """All messages, parsed, with the ``reason`` why no job can use one (null: some can).

    Persist it and take ``accepted`` and ``rejected`` rows from it: one parse gives both.
    """
    parsed = _decoded(messages, "value")
    kind = F.col("type")
    # a broken message is kept as text in the corrupt column; one that is no object at
    # all leaves every field null
    reason = (F.when(is_blank("value"), F.lit("blank"))
              .when(F.col(CORRUPT).isNotNull(), F.lit("malformed"))
              .when(is_blank(kind), F.lit("missing_type"))
              .when(~kind.isin(*known_types) & (F.upper(kind) != HOURLY.types[0]),
                    F.lit("unknown_type")))
    return parsed.withColumn("reason", reason)


def accepted(read: DataFrame) -> DataFrame:
    """The usable ones of ``read_messages``, as ``parse_envelope`` gives them."""
    return _typed(read.filter("reason is null"), "value")


def rejected(read: DataFrame) -> DataFrame:
    return read.filter("reason is not null").select("message_id", "reason", "value")


def quarantine_messages(messages: DataFrame, known_types=KNOWN_TYPES) -> DataFrame:
    """Messages that no job can use, with the reason; the complement of routing."""
    return rejected(read_messages(messages, known_types))


def routing_type(kind: Column) -> Column:
    """Type tag that decides what is done with a message: tags are compared as they are,
    that of the hourly summaries in any case."""
    hourly = HOURLY.types[0]
    return F.when(F.upper(kind) == hourly, F.lit(hourly)).otherwise(kind)


def stage_of_type(kind) -> Column:
    """Stage name of a message type; null for types no stage handles."""
    out = None
    for stage in STAGES.values():
        cond = kind.isin(*stage.types)
        out = F.when(cond, stage.name) if out is None else out.when(cond, stage.name)
    return out


def route_by_type(parsed: DataFrame) -> DataFrame:
    """Keep the messages of the four stages and tag each with its stage."""
    return (parsed.withColumn("stage", stage_of_type(F.col("type")))
            .filter(F.col("stage").isNotNull()))


def of_stage(parsed: DataFrame, stage: Stage) -> DataFrame:
    return parsed.filter(F.col("type").isin(*stage.types))


def _element_columns(kind: Stage) -> list[Column]:
    out = []
    for name, dtype in kind.fields.items():
        if dtype == "items":
            value = F.from_json(F.col(f"element.{name}"), ITEM_TYPE)
        else:
            value = F.col(f"element.{name}").try_cast(dtype)
        out.append(value.alias(name))
    return out


def stage_rows(parsed: DataFrame, stage: Stage) -> DataFrame:
    """One typed row per element of the stage's messages.

    Envelope fields are copied onto each row. Time fields stay strings; a parsed
    timestamp is added for each (``collectTime`` -> ``collectTs``) and ``recTs`` for the
    time the message was received.
    """
    rows = (of_stage(parsed, stage)
            .select("message_id", "type", *[c for c in ENVELOPE_FIELDS if c != "type"],
                    F.posexplode("data").alias("pos", "element")))
    envelope = ["numberReport", "interfaceRecTime", "userName", "clientId", "dropDataNum"]
    rows = rows.select("message_id", "pos", "type", *_element_columns(stage), *envelope)
    return with_times(rows, stage)


def with_times(rows: DataFrame, stage: Stage) -> DataFrame:
    times = {time_column(name): parse_time(name) for name in stage.times}
    return rows.withColumns({**times, "recTs": parse_time("interfaceRecTime")})


def stage_from_messages(messages: DataFrame, stage: Stage) -> DataFrame:
    """Typed rows of one stage, straight from raw messages."""
    return stage_rows(parse_envelope(messages, stage), stage)


def hourly_summary_rows(messages: DataFrame, now) -> DataFrame:
    """Elements of the hourly summary messages; the type tag is matched in any case."""
    return hourly_rows(parse_envelope(messages, HOURLY), now)


def hourly_rows(parsed: DataFrame, now) -> DataFrame:
    rows = (parsed.filter(F.upper("type") == HOURLY.types[0])
            .select("message_id", "userName", F.posexplode("data").alias("pos", "element")))
    return rows.select(
        "message_id", "pos", *_element_columns(HOURLY),
        F.col("userName").alias("createBy"), now.alias("createTime"),
        now.alias("updateTime"), F.lit(0).alias("isDelete"))


# Result codes and the labels shown for them.
RESULT_LABELS = {"1": "阴性", "2": "阳性"}
RESULT_FIELDS = ("checkResult", "iggResult", "igmResult")


def decode_result(value, labels=None) -> Column:
    """Label of a result code; other values, blank and null included, stay as they are."""
    value = F.col(value) if isinstance(value, str) else value
    out = value
    for code, label in (labels or RESULT_LABELS).items():
        out = F.when(value == code, F.lit(label)).otherwise(out)
    return out


def decode_results(rows: DataFrame, fields=RESULT_FIELDS, labels=None) -> DataFrame:
    return rows.withColumns({f: decode_result(f, labels) for f in fields})
