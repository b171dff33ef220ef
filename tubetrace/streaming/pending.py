"""Records that a rule can only judge later.

A record without its counterpart is an error once a day has passed, whether or not another
message comes. Each batch writes its young records to a table partitioned by the hour in
which they are due; each later batch reads the hours since the batch before it.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

HOUR = "yyyy-MM-dd-HH"
HOUR_FORMAT = "%Y-%m-%d-%H"


class Pending:
    """Rows with the time they are due, written once per batch."""

    def __init__(self, path: str):
        self.path = path

    def write_batch(self, rows: DataFrame, due: Column, batch: int) -> None:
        """In place of what an earlier try of the batch wrote."""
        (rows.withColumns({"_due": due, "_hour": F.date_format(due, HOUR), "_batch": F.lit(batch)})
         .repartition("_hour").write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("_hour", "_batch")
         .parquet(self.path))

    def due(self, spark: SparkSession, schema: StructType, after: datetime, until: datetime,
            batch: int) -> DataFrame | None:
        """Rows of earlier batches that are due ``after`` one time and not after another; None
        if there are no hours to read."""
        low, high = (t.strftime(HOUR_FORMAT) for t in (after, until))
        hours = [h for h in self._hours(spark) if low <= h <= high]
        if not hours:
            return None
        own = StructType.fromDDL("_due timestamp, _hour string, _batch int")
        full = StructType([*schema.fields, *own.fields])
        rows = spark.read.schema(full).option("basePath", self.path).parquet(
            *[f"{self.path}/_hour={h}" for h in hours])
        return rows.filter((F.col("_due") > F.lit(after)) & (F.col("_due") <= F.lit(until))
                           & (F.col("_batch") < batch)).select(*schema.names)

    def forget(self, spark: SparkSession, before: datetime) -> None:
        """Drops the hours that no batch reads any more."""
        for hour in self._hours(spark):
            if hour < before.strftime(HOUR_FORMAT):
                place = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/_hour={hour}")
                place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)

    def _hours(self, spark: SparkSession) -> list[str]:
        root = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
        if not fs.exists(root):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(root)]
        return sorted(n.partition("=")[2] for n in names if n.startswith("_hour="))
