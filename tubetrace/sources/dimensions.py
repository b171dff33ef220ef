"""Small reference tables: organisations and clients."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

ORGANISATION_SCHEMA = "id bigint, org_name string"
CLIENT_SCHEMA = "client_id bigint, client_name string"


def read_dimension(spark: SparkSession, source: str, schema: str, fmt: str = "parquet",
                   **options) -> DataFrame:
    """A dimension from files, or from a database with ``fmt="jdbc"``.

    For jdbc ``source`` is the table; pass url, user and password as options. Call it
    again per micro-batch to see changes.
    """
    names = [part.split()[0] for part in schema.split(",")]
    if fmt == "jdbc":
        return (spark.read.format("jdbc").option("dbtable", source).options(**options)
                .load().select(*names))
    return spark.read.format(fmt).options(**options).schema(schema).load(source).select(*names)
