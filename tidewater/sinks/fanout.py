"""Rows of (topic, value) to topics: one write, whatever number of topics."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewater.sinks.batches import write_once
from tidewater.sources.lines import LINE_SCHEMA

Sink = Callable[[DataFrame, int], None]


def folder_sink(path: str, partition_by: Sequence[str] = ("topic",)) -> Sink:
    """``path/batch_id=N/topic=T``: each batch exactly once."""
    return lambda rows, batch_id: write_once(
        rows, f"{path.rstrip('/')}/batch_id={batch_id}", partition_by
    )


# Where a fact comes from, as far as its rows tell: the same for a batch sent again.
ORIGIN = ("partition", "offset", "nth")


def kafka_records(rows: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Records as Spark's Kafka writer wants them; no value becomes an empty one.

    Headers name the source's partition and offset and the fact's number in its line,
    so that consumers can tell a fact that was sent twice: see ``streaming.replays``.
    """
    headers = [
        F.struct(
            F.lit(f"source-{name}").alias("key"),
            F.col(name).cast("string").cast("binary").alias("value"),
        )
        for name in ORIGIN
        if name in rows.columns
    ]
    if "reason" in rows.columns:  # of lines that were left out
        reason = F.struct(F.lit("reason").alias("key"), F.col("reason").cast("binary").alias("value"))
        headers.append(reason)
    columns = ["topic", F.coalesce("value", F.lit("")).cast("binary").alias("value")]
    return rows.select(*columns, *[_present(headers).alias("headers")] * bool(headers), *extra)


def _present(headers: Sequence[Column]) -> Column:
    return F.filter(F.array(*headers), lambda header: header["value"].isNotNull())


def kafka_sink(servers: str, **options: str) -> Sink:
    """To the topic each row names. A replayed batch is sent again, with equal headers."""

    def write(rows: DataFrame, batch_id: int) -> None:
        settings: Mapping[str, str] = {"kafka.bootstrap.servers": servers, **options}
        kafka_records(rows).write.format("kafka").options(**settings).save()

    return write


def as_topic(rows: DataFrame, topic: str) -> DataFrame:
    """Rows that already have their text as ``value``, addressed to one topic."""
    return rows.withColumn("topic", F.lit(topic))


def read_topic(spark: SparkSession, path: str, topic: str | None = None) -> DataFrame:
    """What ``folder_sink`` wrote; only the folders of the topic are read.

    Facts written without arrival columns have NULL there.
    """
    schema = f"{LINE_SCHEMA}, nth int, topic string, batch_id bigint"
    rows = spark.read.schema(schema).parquet(path)
    return rows if topic is None else rows.where(F.col("topic") == topic)
