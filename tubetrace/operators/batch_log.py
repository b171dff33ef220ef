"""Per-message summaries: the upload log and the reconciliation rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import hash_id
from ..functions.predicates import is_blank
from ..functions.times import format_time
from ..schemas import Stage

# taken from the last element of a message
LAST_FIELDS = ("source", "area_id", "upload_time", "section_time", "record_id", "submit_id")


def element_results(flagged: DataFrame, stage: Stage) -> DataFrame:
    """Narrow rows for the summary: one per element, with its outcome and last fields."""
    record_id = F.col("recordId") if "recordId" in flagged.columns else F.lit(None)
    return flagged.select(
        "message_id", "pos", F.col("hasError").alias("failed"),
        F.lit(stage.source).alias("source"), F.col("areaId").alias("area_id"),
        F.col("addTime").alias("upload_time"), F.col(stage.section_time).alias("section_time"),
        F.coalesce(record_id.cast("string"), F.lit("")).alias("record_id"),
        F.coalesce(F.col("submitId").cast("string"), F.lit("")).alias("submit_id"))


def message_summary(messages: DataFrame, elements: DataFrame) -> DataFrame:
    """One row per message: total, passed and failed elements, fields of the last one.

    Messages without elements are kept. They join the elements as rows at position -1,
    so one aggregation does all; it is partial, and a message's rows are few.
    """
    heads = messages.select(
        "message_id", F.lit(-1).alias("pos"), F.lit(None).cast("boolean").alias("failed"),
        F.col("numberReport").cast("string").alias("number_report"),
        F.col("userName").alias("create_by"))
    rows = heads.unionByName(elements, allowMissingColumns=True)
    is_element = F.col("pos") >= 0
    return rows.groupBy("message_id").agg(
        F.count_if(is_element).alias("upload_number"),
        F.count_if(is_element & ~F.col("failed")).alias("success_number"),
        F.count_if(is_element & F.col("failed")).alias("fail_number"),
        F.max("number_report").alias("number_report"), F.max("create_by").alias("create_by"),
        F.max_by(F.struct(*LAST_FIELDS), "pos").alias("_last"),
    ).select("message_id", "upload_number", "success_number", "fail_number", "number_report",
             "create_by", "_last.*")


def upload_log(summary: DataFrame, now: Column) -> DataFrame:
    """Rows of the upload log, valid and failed alike."""
    stamp = format_time(now)
    return summary.select(
        "message_id", hash_id("UPLOAD_LOG", "message_id").alias("id"), "area_id", "number_report",
        "source", "upload_number", "success_number", "fail_number",
        F.coalesce("upload_time", F.lit("")).alias("upload_time"),
        F.coalesce("section_time", F.lit("")).alias("section_time"),
        F.lit(1).alias("upload_result"), "create_by", stamp.alias("create_time"),
        F.lit(0).alias("is_delete"))


def _log_incomplete() -> Column:
    return F.col("area_id").isNull() | F.col("source").isNull() | is_blank("upload_time")


def batch_log(log: DataFrame) -> DataFrame:
    return log.filter(~_log_incomplete())


def batch_log_fail(log: DataFrame) -> DataFrame:
    return log.filter(_log_incomplete())


def reconcile(summary: DataFrame, now: Column) -> DataFrame:
    """Reconciliation rows of the messages whose area and stage are known."""
    known = summary.filter(F.col("area_id").isNotNull() & F.col("source").isNotNull())
    return known.select(
        "message_id", hash_id("UPLOAD_REPORT", "message_id").alias("id"), "area_id", "source",
        F.coalesce("record_id", F.lit("")).alias("record_id"), "number_report", "upload_number",
        "success_number", F.lit(1).alias("confirm_status"), "upload_time",
        F.coalesce("submit_id", F.lit("")).alias("submit_id"), "create_by",
        format_time(now).alias("create_time"), F.lit(0).alias("is_delete"))


def reconcile_fail(summary: DataFrame, messages: DataFrame, now: Column) -> DataFrame:
    """The other messages, each with its raw text."""
    unknown = summary.filter(F.col("area_id").isNull() | F.col("source").isNull())
    return (unknown.join(messages.select("message_id", F.col("value").alias("fail_data")),
                         "message_id")
            .select("message_id", hash_id("UPLOAD_REPORT", "message_id").alias("id"), "area_id",
                    "source", F.coalesce("record_id", F.lit("")).alias("record_id"),
                    "number_report", "fail_data", "create_by",
                    format_time(now).alias("create_time"), F.lit(0).alias("is_delete")))
