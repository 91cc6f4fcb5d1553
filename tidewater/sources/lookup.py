"""The dictionary table used to enrich facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewater.contract import DICTIONARY_SCHEMA


def jdbc_options(
    url: str, table: str, user: str, password: str, driver: str, **more: str
) -> dict[str, str]:
    return {
        "url": url,
        "dbtable": table,
        "user": user,
        "password": password,
        "driver": driver,
        "customSchema": DICTIONARY_SCHEMA.replace("string", "STRING").replace(
            "timestamp", "TIMESTAMP"
        ),
        **more,
    }


def jdbc_table(spark: SparkSession, **options: str) -> DataFrame:
    """A table read over JDBC. Joined to a stream, it is read again for every batch."""
    return spark.read.format("jdbc").options(**options).load()
