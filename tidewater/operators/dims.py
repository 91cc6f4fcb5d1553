"""Change rows to dimension tables: which rows, which table, which columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewater.contract import (
    ARRIVAL,
    CONFIG_COLUMNS,
    DEFAULT_KEY_COLUMN,
    DIMENSION_CHANGE_TYPES,
)
from tidewater.operators.scale import BROADCAST_ROWS, lookup_side, order_key


def dimension_changes(changes: DataFrame, database: str | None = None) -> DataFrame:
    """Inserts, updates and bootstrap rows, of one database if it is given."""
    kept = changes.where(F.col("type").isin(*DIMENSION_CHANGE_TYPES))
    return kept if database is None else kept.where(F.col("database") == database)


def key_column() -> Column:
    """Key column of a config row; ``id`` where it names none."""
    return F.coalesce(F.nullif("sink_pk", F.lit("")), F.lit(DEFAULT_KEY_COLUMN))


def listed_columns(trim: bool = False) -> Column:
    """The column names a config row lists, blanks included unless trimmed."""
    listed = F.split("sink_columns", ",", -1)
    return F.transform(listed, lambda name: F.trim(name)) if trim else listed


def _routes(config: DataFrame, trim: bool, max_rows: int, *more: str) -> DataFrame:
    return lookup_side(
        config.select(
            F.col("source_table").alias("table"),
            "sink_table",
            listed_columns(trim).alias("sink_columns"),
            key_column().alias("key_column"),
            *more,
        ),
        max_rows,
    )


def route(
    changes: DataFrame, config: DataFrame, trim: bool = False, max_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Add ``sink_table, key`` and cut ``data`` to the columns the config lists.

    Names must match exactly; with ``trim``, blanks around the listed names are
    ignored. Rows of tables without a config are left out; see ``unrouted``.
    """
    joined = changes.join(_routes(config, trim, max_rows), "table", "inner")
    return _cut(joined, changes.columns)


def _cut(joined: DataFrame, columns: Sequence[str]) -> DataFrame:
    listed = F.map_filter(
        F.col("data"), lambda name, _: F.array_contains(F.col("sink_columns"), name)
    )
    return (
        joined.withColumn("data", listed)
        .withColumn("key", F.col("data")[F.col("key_column")])
        .select(*columns, "sink_table", "key")
    )


def route_versions(config_changes: DataFrame, arrival: Sequence[str] = ARRIVAL) -> DataFrame:
    """When each route was in force: the config's columns, ``valid_from`` and ``valid_to``.

    A version lasts from its arrival (NULL: ever since) until the next change of the same
    source table arrives (NULL: to this day). Of changes that arrive at the same time, the
    last one counts. Removed routes are times without a version.
    """
    order = Window.partitionBy("source_table").orderBy(*arrival)
    at = F.col(arrival[0])
    return (
        config_changes.withColumn("valid_to", F.lead(at).over(order))
        .withColumn("valid_from", at)
        .where(~F.col("removed"))
        .where(F.col("valid_from").isNull() | F.col("valid_to").isNull() | (F.col("valid_from") < F.col("valid_to")))
        .select(*CONFIG_COLUMNS, "valid_from", "valid_to")
    )


def _in_force(changes: DataFrame, routes: DataFrame, at: str) -> Column:
    time = changes[at]
    return (
        (changes["table"] == routes["table"])
        & (routes["valid_from"].isNull() | (time >= routes["valid_from"]))
        & (routes["valid_to"].isNull() | (time < routes["valid_to"]))
    )


def route_as_of(
    changes: DataFrame,
    versions: DataFrame,
    at: str = ARRIVAL[0],
    trim: bool = False,
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Like ``route``, by the version that was in force when the row arrived (column ``at``).

    So a backfill, or a batch that runs again, routes rows as at first, whatever has become
    of the config since. At most one version fits, since those of a table do not overlap.
    """
    routes = _routes(versions, trim, max_rows, "valid_from", "valid_to")
    joined = changes.join(routes, _in_force(changes, routes, at)).drop(routes["table"])
    return _cut(joined, changes.columns)


def unrouted_as_of(
    changes: DataFrame,
    versions: DataFrame,
    at: str = ARRIVAL[0],
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Rows of tables that had no route when the row arrived."""
    known = versions.select(F.col("source_table").alias("table"), "valid_from", "valid_to")
    routes = lookup_side(known, max_rows)
    return changes.join(routes, _in_force(changes, routes, at), "left_anti")


def unrouted(changes: DataFrame, config: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Rows of tables the config does not know."""
    known = lookup_side(config.select(F.col("source_table").alias("table")), max_rows)
    return changes.join(known, "table", "left_anti")


def routed_values(
    routed: DataFrame, arrival: Sequence[str] = ARRIVAL, keep: Sequence[str] = ()
) -> DataFrame:
    """One row per routed column: ``sink_table, key, column, value`` and arrival."""
    # The inner explode would add a filter that cuts the data a second time.
    values = routed.select(
        *keep, "sink_table", "key", *arrival, F.explode_outer("data").alias("column", "value")
    )
    return values.where(F.col("column").isNotNull())


def latest_values(values: DataFrame, arrival: Sequence[str] = ARRIVAL) -> DataFrame:
    """The last-arrived value of each column of each key, with its arrival.

    A change names only some columns; the others keep their value. Aggregated
    before the shuffle, so a key that changes all the time stays cheap.
    """
    latest = F.max_by(F.struct("value", *arrival), order_key(arrival)).alias("_latest")
    return (
        values.groupBy("sink_table", "key", "column")
        .agg(latest)
        .select("sink_table", "key", "column", "_latest.*")
    )


def schema_plan(config: DataFrame, trim: bool = False) -> DataFrame:
    """Columns of the dimension tables: ``sink_table, position, column, is_pk``."""
    return config.select(
        "sink_table",
        key_column().alias("_key"),
        F.posexplode(listed_columns(trim)).alias("_index", "column"),
    ).select(
        "sink_table",
        (F.col("_index") + 1).cast("bigint").alias("position"),
        "column",
        (F.col("column") == F.col("_key")).alias("is_pk"),
    )


def schema_errors(config: DataFrame, trim: bool = False) -> DataFrame:
    """Config rows whose key is not among their columns: no table can be made."""
    return config.where(~F.array_contains(listed_columns(trim), key_column()))
