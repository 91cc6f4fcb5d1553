"""Change rows of the business database, and of the routing config."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidewater.contract import ARRIVAL, CONFIG_COLUMNS
from tidewater.functions.json_rows import with_object
from tidewater.operators.scale import order_key

CHANGE_FIELDS = (
    "database string, `table` string, type string, "
    "data map<string,string>, old map<string,string>"
)
_CONFIG_ROW = "struct<" + ",".join(f"{name}:string" for name in CONFIG_COLUMNS) + ">"
CONFIG_CHANGE_FIELDS = f"before {_CONFIG_ROW}, after {_CONFIG_ROW}"


def _decode(lines: DataFrame, schema: str) -> DataFrame:
    """``row`` of each valid line; lines that are not one JSON object give none."""
    return with_object(lines, schema).drop("value").where(F.col("row").isNotNull())


def flagged_changes(
    lines: DataFrame, processing_time: bool = False, keep_text: bool = False
) -> DataFrame:
    """Like ``decode_changes``, with a row of NULLs for each line it drops, and ``_good``."""
    rest = [name for name in lines.columns if name != "value" or keep_text]
    changes = with_object(lines, CHANGE_FIELDS).select(
        *rest, "row.*", F.col("row").isNotNull().alias("_good")
    )
    if processing_time:
        changes = changes.withColumn("pt", F.current_timestamp())
    return changes


def decode_changes(lines: DataFrame, processing_time: bool = False) -> DataFrame:
    """``database, table, type, data, old`` of change lines, plus their arrival columns.

    Values in ``data`` and ``old`` are text, as written. ``processing_time`` adds
    ``pt``, the time the batch started.
    """
    return flagged_changes(lines, processing_time).where("_good").drop("_good")


def config_changes(lines: DataFrame, arrival: Sequence[str] = ARRIVAL) -> DataFrame:
    """Every change of a route: ``source_table, removed``, the config's columns and arrival.

    Lines that are no change of a config row, or name no source table, give none.
    """
    after = F.col("row")["after"]
    source = F.coalesce(after["source_table"], F.col("row")["before"]["source_table"])
    return (
        _decode(lines, CONFIG_CHANGE_FIELDS)
        .select(
            source.alias("source_table"),
            after.isNull().alias("removed"),
            *[after[name].alias(name) for name in CONFIG_COLUMNS if name != "source_table"],
            *arrival,
        )
        .where(F.col("source_table").isNotNull())
    )


def decode_config(lines: DataFrame, arrival: Sequence[str] = ARRIVAL) -> DataFrame:
    """Routing config now in force, one row per source table.

    The latest change of a source table counts; a change without an "after" row
    removes the table's mapping.
    """
    latest = (
        _decode(lines, CONFIG_CHANGE_FIELDS)
        .withColumn(
            "source_table", F.coalesce("row.after.source_table", "row.before.source_table")
        )
        .where(F.col("source_table").isNotNull())
        .groupBy("source_table")
        .agg(F.max_by("row.after", order_key(arrival)).alias("after"))
    )
    return latest.where(F.col("after").isNotNull()).select("after.*")
