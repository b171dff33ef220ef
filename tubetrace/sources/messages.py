"""Message sources and the message sink, batch and streaming.

Each source yields ``message_id`` (unique, stable under retries) and ``value``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_MESSAGE_BYTES = 10_485_760


def kafka_options(servers: str, topic: str, starting="earliest", extra=None) -> dict[str, str]:
    """Options of a topic source. A stream resumes from its checkpoint; ``starting``
    (``earliest`` or ``latest``) only applies to the first start."""
    return {"kafka.bootstrap.servers": servers, "subscribe": topic,
            "startingOffsets": starting, **(extra or {})}


def _topic_records(df: DataFrame) -> DataFrame:
    return df.select(F.concat_ws("-", "topic", "partition", "offset").alias("message_id"),
                     F.col("value").cast("string").alias("value"))


def read_topic(spark: SparkSession, **options) -> DataFrame:
    return _topic_records(spark.read.format("kafka").options(**kafka_options(**options)).load())


def stream_topic(spark: SparkSession, **options) -> DataFrame:
    return _topic_records(
        spark.readStream.format("kafka").options(**kafka_options(**options)).load())


def _file_number() -> Column:
    return F.hex(F.xxhash64(F.col("_metadata.file_path")))


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """One message per line. Its id is the file, a digest of the line and its number among equal
    lines of the file, so it does not depend on how the file is cut into tasks. Equal lines are
    counted partially first; lines that occur often are no burden."""
    lines = spark.read.text(path).select(_file_number().alias("file"), "value")
    counted = lines.groupBy("file", "value").agg(F.count("*").alias("times"))
    # in two steps, so that no array grows with the number of equal lines
    step = 4096
    pieces = counted.withColumn("piece", F.explode(F.sequence(
        F.lit(0), F.floor((F.col("times") - 1) / step))))
    last = F.least(F.col("times") - 1, F.col("piece") * step + (step - 1))
    numbered = pieces.withColumn("number", F.explode(F.sequence(F.col("piece") * step, last)))
    return numbered.select(F.concat_ws("-", "file", F.md5("value"), F.col("number").cast("string"))
                           .alias("message_id"), "value")


def stream_text(spark: SparkSession, path: str, max_files_per_trigger=None) -> DataFrame:
    """One message per line; its id is the file and the number of the line. A file is taken as a
    whole, so files should be of the size of some messages' worth, up to a gigabyte."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    whole = reader.text(path, wholetext=True).select(_file_number().alias("file"), F.regexp_replace(
        "value", r"(\r\n|\r|\n)\z", "").alias("value"))
    lines = whole.select("file", F.posexplode(F.split("value", r"\r\n|\r|\n"))
                         .alias("number", "value"))
    return lines.select(F.concat_ws("-", "file", F.col("number").cast("string"))
                        .alias("message_id"), "value")


def read_message_table(spark: SparkSession, path: str) -> DataFrame:
    """Messages kept as parquet with ``message_id`` and ``value``."""
    return spark.read.parquet(path).select("message_id", "value")


def stream_message_table(spark: SparkSession, path: str, max_files_per_trigger=None) -> DataFrame:
    reader = spark.readStream.schema("message_id string, value string")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def topic_sink_options(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic,
            "kafka.max.request.size": str(MAX_MESSAGE_BYTES)}


def write_topic(df: DataFrame, servers: str, topic: str) -> None:
    (df.select(F.col("message_id").alias("key"), "value").write.format("kafka")
     .options(**topic_sink_options(servers, topic)).save())
