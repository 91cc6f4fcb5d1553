"""Dimension tables: created from the config, upserted by buckets of keys.

A table is ``TABLE/version=N/_bucket=B``: version N holds the rows of the buckets that batch N
changed, whole, and of each bucket the newest version counts. The table's location names one
folder per bucket, so that one statement moves it from one whole version to the next, and
what a batch writes follows what it changed, not the table.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F

from tidewater.operators.dims import key_column, listed_columns, schema_errors
from tidewater.sinks.batches import file_system, hadoop_path, is_complete, write_once

PARALLEL_TABLES = 8
# Of each dimension table.
BUCKETS = 64
BUCKET = "_bucket"


def _name(*parts: str) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in parts)


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_statement(
    database: str, table: str, columns: Sequence[str], key: str, extend: str, location: str
) -> str:
    """DDL of one dimension table: text columns, key and extension as properties."""
    listed = ", ".join(f"{_name(column)} STRING" for column in columns)
    return (
        f"CREATE TABLE IF NOT EXISTS {_name(database, table)} ({listed}) USING parquet "
        f"LOCATION {_text(location)} "
        f"TBLPROPERTIES ('key' = {_text(key)}, 'extend' = {_text(extend)})"
    )


def planned_tables(config: DataFrame) -> list[Row]:
    """``sink_table, columns, key, extend`` of each table; one row per table.

    Sources of one table add up their columns, in the order of the sources' names; they
    must agree on the key.
    """
    wrong = schema_errors(config).select("sink_table").distinct()
    count = wrong.count()
    if count:
        names = [row["sink_table"] for row in wrong.orderBy("sink_table").limit(20).collect()]
        raise ValueError(f"the key is not among the columns of {count} tables, such as {names}")
    source = F.struct(
        "source_table",
        listed_columns().alias("columns"),
        key_column().alias("key"),
        F.coalesce("sink_extend", F.lit("")).alias("extend"),
    )
    rows = (
        config.groupBy("sink_table")
        .agg(F.sort_array(F.collect_list(source)).alias("sources"))
        .select(
            "sink_table",
            F.array_distinct(F.flatten(F.col("sources.columns"))).alias("columns"),
            F.array_distinct("sources.key").alias("keys"),
            F.col("sources")[0]["extend"].alias("extend"),
        )
        .collect()
    )
    for row in rows:
        if BUCKET in {column.lower() for column in row["columns"]}:
            raise ValueError(f"{row['sink_table']} lists {BUCKET}, which names the folders of its keys")
        if len(row["keys"]) > 1:
            raise ValueError(f"sources of {row['sink_table']} differ in the key: {row['keys']}")
    return [Row(sink_table=r[0], columns=r[1], key=r[2][0], extend=r[3]) for r in rows]


def snapshots(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the complete versions of a table, oldest first."""
    files = file_system(spark, folder)
    if not files.exists(hadoop_path(spark, folder)):
        return []
    names = [status.getPath().getName() for status in files.listStatus(hadoop_path(spark, folder))]
    numbers = [name.partition("=")[2] for name in names if name.startswith("version=")]
    found = sorted(int(number) for number in numbers if number.isdigit())
    return [number for number in found if is_complete(spark, f"{folder}/version={number}")]


def ensure_tables(
    spark: SparkSession,
    config: DataFrame,
    database: str,
    path: str,
    known: dict[str, Row] | None = None,
) -> list[Row]:
    """Create the tables that do not exist yet; returns all of the config's tables.

    A table points at its newest complete version, also when a new process with an
    empty catalogue creates it again: the folders are what lasts. New columns are
    added. ``known`` holds the tables as they were last time, and is brought up to
    date: statements are run for new and changed ones only.
    """
    known = {} if known is None else known
    if not known:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {_name(database)}")
    tables = planned_tables(config)
    for table in tables:
        if known.get(table.sink_table) == table:
            continue
        name, folder = _name(database, table.sink_table), f"{path.rstrip('/')}/{table.sink_table}"
        versions = bucket_versions(spark, folder)
        location = table_location(folder, versions)
        spark.sql(
            create_statement(
                database, table.sink_table, table.columns, table.key, table.extend, location
            )
        )
        there = set(spark.table(name).columns)
        added = [column for column in table.columns if column not in there]
        if added:
            listed = ", ".join(f"{_name(column)} STRING" for column in added)
            spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({listed})")
        if versions:
            _point(spark, database, table.sink_table, location)
        known[table.sink_table] = table
    return tables


def _point(spark: SparkSession, database: str, table: str, location: str) -> None:
    spark.sql(f"ALTER TABLE {_name(database, table)} SET LOCATION {_text(location)}")
    spark.catalog.refreshTable(_name(database, table))


def bucket_versions(spark: SparkSession, folder: str, before: int = 2**62) -> dict[int, int]:
    """Of each bucket of a table, its newest complete version before the given one."""
    found: dict[int, int] = {}
    for version in snapshots(spark, folder):
        if version < before:
            found |= dict.fromkeys(_buckets_of(spark, folder, version), version)
    return found


def _buckets_of(spark: SparkSession, folder: str, version: int) -> list[int]:
    parent = f"{folder}/version={version}"
    listed = file_system(spark, parent).listStatus(hadoop_path(spark, parent))
    names = [status.getPath().getName() for status in listed]
    return [int(name.partition("=")[2]) for name in names if name.startswith(f"{BUCKET}=")]


def table_location(folder: str, versions: dict[int, int]) -> str:
    """One pattern for the folders of all buckets; catalogues take some 4,000 letters of it."""
    if not versions:
        return f"{folder}/version=none"
    by_version: dict[int, list[str]] = {}
    for bucket, version in sorted(versions.items()):
        by_version.setdefault(version, []).append(str(bucket))
    parts = [
        f"version={version}/_bucket=" + (buckets[0] if len(buckets) == 1 else "{" + ",".join(buckets) + "}")
        for version, buckets in sorted(by_version.items())
    ]
    return f"{folder}/" + (parts[0] if len(parts) == 1 else "{" + ",".join(parts) + "}")


def _upserted(old: DataFrame, values: DataFrame, key: str) -> DataFrame:
    """Rows of a table with the values of some keys' columns set, and rows of new keys."""
    changed = values.groupBy(F.col("key").alias("_key"), BUCKET).agg(
        F.map_from_entries(F.collect_list(F.struct("column", "value"))).alias("_new")
    )
    rows = old.select(F.struct("*").alias("_old"), F.col(_name(key)).alias("_old_key"))
    joined = rows.join(changed, F.col("_old_key") == F.col("_key"), "full_outer")
    return joined.select(
        F.coalesce("_key", "_old_key").alias("_key"),
        *[
            F.when(F.map_contains_key("_new", column), F.col("_new")[column])
            .otherwise(F.col("_old")[column])
            .alias(column)
            for column in old.columns
        ],
    )


def _bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def upsert(
    values: DataFrame,
    tables: Sequence[Row],
    database: str,
    path: str,
    version: int,
    buckets: int = BUCKETS,
) -> None:
    """Set values (``sink_table, key, column, value``; one per table, key and column) in these tables.

    Only buckets with a changed key are read and written, then the table is pointed at the
    new version. Columns a key has no value for stay as they are, NULL for new keys. Tables are
    independent of each other, so several are written at a time. The version before stays for
    those who are reading it; older folders of the same buckets are deleted. ``buckets`` is for
    good: a key's bucket must not change.
    """
    spark = values.sparkSession

    def one(table: Row) -> None:
        folder = f"{path.rstrip('/')}/{table.sink_table}"
        before = bucket_versions(spark, folder, version)
        target = f"{folder}/version={version}"
        if not is_complete(spark, target):
            new = values.where(F.col("sink_table") == table.sink_table).withColumn(
                BUCKET, _bucket(F.col("key"), buckets)
            )
            touched = {row[BUCKET] for row in new.select(BUCKET).distinct().collect()}
            # As the catalogue has them: columns that routes have given up stay.
            columns = spark.table(_name(database, table.sink_table)).columns
            paths = [f"{folder}/version={before[b]}/_bucket={b}" for b in sorted(touched) if b in before]
            schema = ", ".join(f"{_name(column)} STRING" for column in columns)
            old = spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
            rows = _upserted(old, new, table.key).withColumn(BUCKET, _bucket(F.col("_key"), buckets))
            write_once(rows.drop("_key").repartition(BUCKET), target, (BUCKET,))
        now = bucket_versions(spark, folder, version + 1)
        _point(spark, database, table.sink_table, table_location(folder, now))
        for old_version in snapshots(spark, folder):
            there = _buckets_of(spark, folder, old_version)
            live = [b for b in there if old_version in (now.get(b), before.get(b)) or old_version > version]
            for gone in [f"{folder}/version={old_version}"] if not live else [
                f"{folder}/version={old_version}/_bucket={b}" for b in there if b not in live
            ]:
                file_system(spark, folder).delete(hadoop_path(spark, gone), True)

    with ThreadPoolExecutor(PARALLEL_TABLES) as pool:
        list(pool.map(inheritable_thread_target(spark)(one), tables))
