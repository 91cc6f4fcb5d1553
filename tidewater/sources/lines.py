"""Text lines from Kafka topics or from files, with their arrival columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewater.contract import ARRIVAL

# What a file of lines must hold, and what a Kafka topic gives.
LINE_SCHEMA = "value string, timestamp timestamp, partition int, offset bigint"
HEADERS = "headers array<struct<key:string,value:binary>>"
# Where a fact comes from, as its headers say; see ``sinks.fanout``.
ORIGIN_COLUMNS = ("source_partition", "source_offset", "source_nth")


def kafka_options(
    servers: str,
    topic: str,
    group_id: str | None = None,
    starting_offsets: str | None = None,
    max_offsets_per_trigger: int | None = None,
    headers: bool = False,
) -> dict[str, str]:
    """Options of Spark's Kafka reader.

    Positions are kept in the query's checkpoint; ``starting_offsets`` matters only
    for the first start. ``group_id`` is what the brokers see. ``headers`` are needed to tell
    facts that were sent twice; see ``as_lines``.
    """
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic}
    if group_id:
        options["kafka.group.id"] = group_id
    if starting_offsets:
        options["startingOffsets"] = starting_offsets
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if headers:
        options["includeHeaders"] = "true"
    return options


def as_lines(records: DataFrame) -> DataFrame:
    """``value`` as text (an empty one if the record has none) and the arrival columns.

    Records with ``headers`` also give ``source_partition, source_offset, source_nth``: where
    the fact comes from, NULL where no header says it. Of a header that stands there twice, the
    last one counts; one that is no number counts as none.
    """
    columns = [F.coalesce(F.col("value").cast("string"), F.lit("")).alias("value"), *ARRIVAL]
    if "headers" in records.columns:
        columns += [_header(name) for name in ORIGIN_COLUMNS]
    return records.select(*columns)


def _header(column: str) -> Column:
    key = column.replace("_", "-")
    found = F.filter("headers", lambda header: header["key"] == key)
    text = F.try_element_at(found, F.lit(-1))["value"].cast("string")
    return text.try_cast("bigint" if column == "source_offset" else "int").alias(column)


def kafka_lines(spark: SparkSession, options: Mapping[str, str], stream: bool = True) -> DataFrame:
    reader = spark.readStream if stream else spark.read
    return as_lines(reader.format("kafka").options(**options).load())


def stored_bytes(spark: SparkSession, path: str) -> int:
    """How many bytes the files of a path, which may be a pattern, have."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = files.globStatus(target) or []
    return sum(files.getContentSummary(status.getPath()).getLength() for status in found)


def file_lines(
    spark: SparkSession,
    path: str,
    stream: bool = True,
    schema: str = LINE_SCHEMA,
    headers: bool = False,
    **options: str,
) -> DataFrame:
    """The same rows from a parquet folder, e.g. an archive of a topic; see ``as_lines``."""
    if headers:
        schema = f"{schema}, {HEADERS}"
    reader = spark.readStream if stream else spark.read
    return as_lines(reader.schema(schema).options(**options).parquet(path))
