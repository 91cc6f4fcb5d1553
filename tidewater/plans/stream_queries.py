"""The registered streaming queries. Each gives the rows of its batch counterpart.

The lines are written to a topic archive slice by slice; after each slice the job
is started on the archive, works off what is new, and stops. So every slice is one
micro-batch, and the job resumes from its checkpoint each time.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewater.contract import ARRIVAL, CART_COLUMNS, PAGE_TOPIC, START_TOPIC
from tidewater.plans import inputs
from tidewater.plans.inputs import DATABASE
from tidewater.plans.queries import ROW_SCHEMA, WITHIN_MS, all_facts, event_id
from tidewater.session import new_folder, short_splits
from tidewater.sinks.fanout import folder_sink, kafka_records, read_topic
from tidewater.sources.changes import decode_config
from tidewater.sources.lines import file_lines
from tidewater.streaming import jobs
from tidewater.streaming.replays import SeenFacts

N_SLICES = 3
# Of the state of the few visitors in the test tables.
BUCKETS = 8


def as_records(lines: DataFrame) -> DataFrame:
    """Lines of a one-partition topic; arrival times follow the offsets."""
    return lines.select(
        "value",
        F.timestamp_millis("offset").alias("timestamp"),
        F.lit(0).alias("partition"),
        F.col("offset").cast("bigint").alias("offset"),
    )


def feed(
    spark: SparkSession,
    records: DataFrame,
    folder: str,
    process: jobs.Process,
    closing: DataFrame | None = None,
    n_slices: int = N_SLICES,
    config: DataFrame | None = None,
) -> None:
    """Run a job over the records in offset order, one micro-batch per slice.

    ``config`` are records of a second topic, those of the same offsets in the same slice.
    """
    low, high = records.agg(F.min("offset"), F.max("offset")).first()
    width = (high - low) // n_slices + 1
    number = F.greatest(F.lit(0), F.least(F.lit(n_slices - 1), F.floor((F.col("offset") - low) / width)))

    def archive(name: str):
        return file_lines(spark, f"{folder}/{name}", headers="headers" in records.columns)

    for i in range(n_slices + (closing is not None)):
        part = records.where(number == i) if i < n_slices else closing
        part.write.mode("append").parquet(f"{folder}/archive")
        if config is None:
            stream = archive("archive")
        else:
            config.where(number == i).write.mode("append").parquet(f"{folder}/config")
            stream = jobs.with_config(archive("archive"), archive("config"))
        with short_splits(spark):
            jobs.start(stream, process, f"{folder}/checkpoint").awaitTermination()


def _log_split(spark: SparkSession, folder: str) -> DataFrame:
    run = new_folder(spark, "log-split")
    process = jobs.log_split(
        jobs.first_visits(f"{run}/visits", BUCKETS), folder_sink(f"{run}/facts"), merge_every=2
    )
    feed(spark, as_records(inputs.log_lines(spark, folder)), run, process)
    return read_topic(spark, f"{run}/facts")


def log_split_stream(spark: SparkSession, folder: str) -> DataFrame:
    return all_facts(_log_split(spark, folder))


def visitor_flag_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The flags as they come out of the split: each line is one page or one start."""
    facts = _log_split(spark, folder).where(F.col("topic").isin(PAGE_TOPIC, START_TOPIC))
    row = facts.select(F.from_json("value", ROW_SCHEMA).alias("row"))
    return row.select("row.event_id", "row.common.mid", "row.ts", "row.common.is_new")


def unique_visitor_stream(spark: SparkSession, folder: str) -> DataFrame:
    run = new_folder(spark, "unique-visitors")
    process = jobs.unique_visitors(
        jobs.last_visits(f"{run}/visits", BUCKETS), folder_sink(f"{run}/facts"), merge_every=2
    )
    feed(spark, as_records(inputs.log_lines(spark, folder, as_pages=True)), run, process)
    row = F.from_json("value", ROW_SCHEMA)
    return read_topic(spark, f"{run}/facts").select(
        event_id(),
        row["common"]["mid"].alias("mid"),
        F.to_date(F.timestamp_millis(row["ts"])).cast("string").alias("dt"),
    )


def user_jump_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Lines in time order, then one of another visitor that lets the time run out."""
    run = new_folder(spark, "user-jumps")
    process = jobs.user_jumps(
        jobs.open_pages(f"{run}/open"),
        jobs.high_marks(f"{run}/marks"),
        folder_sink(f"{run}/facts"),
        WITHIN_MS,
    )
    lines = inputs.log_lines(spark, folder, as_pages=True, in_time_order=True)
    feed(spark, as_records(lines), run, process, as_records(_closing(spark, folder)))
    return _jumps(spark, run)


def _closing(spark: SparkSession, folder: str) -> DataFrame:
    """A line of a visitor of its own, so much later that all windows before it are over."""
    last = F.struct(
        F.struct(F.lit("closing").alias("mid")).alias("common"),
        F.struct(F.lit("home").alias("last_page_id")).alias("page"),
        (F.unix_millis(F.max("ts").cast("timestamp")) + 10 * WITHIN_MS).alias("ts"),
    )
    events = inputs.table(spark, folder, "events")
    return events.agg(F.to_json(last).alias("value"), (F.max("event_id") + 1).alias("offset"))


def _jumps(spark: SparkSession, run: str) -> DataFrame:
    row = F.from_json("value", ROW_SCHEMA)
    return read_topic(spark, f"{run}/facts").select(
        event_id(), row["common"]["mid"].alias("mid"), row["ts"].alias("ts")
    )


def user_jump_replay_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Every fact stands in the topic twice, the second time half a slice later.

    So half of the repeats are in the same micro-batch as the first, half in one after it.
    They are told by their headers, as the Kafka sink of the split writes them.
    """
    run = new_folder(spark, "user-jumps")
    drops = jobs.drops_table(f"{run}/drops")
    process = jobs.user_jumps(
        jobs.open_pages(f"{run}/open"),
        jobs.high_marks(f"{run}/marks"),
        folder_sink(f"{run}/facts"),
        WITHIN_MS,
        drops=drops,
        seen=SeenFacts(f"{run}/seen", merge_every=2),
    )
    lines = inputs.log_lines(spark, folder, as_pages=True, in_time_order=True)
    facts = lines.withColumns({"partition": F.lit(0), "nth": F.lit(0), "topic": F.lit(PAGE_TOPIC)})
    count = inputs.table(spark, folder, "events").agg(F.max("event_id")).first()[0]
    sent = kafka_records(facts.drop("timestamp"), extra=("offset",)).drop("topic")
    later = F.array(F.col("offset") * 2, F.col("offset") * 2 + count // N_SLICES // 2 * 2 + 1)
    records = sent.withColumn("offset", F.explode(later)).withColumn("partition", F.lit(0))
    records = records.withColumn("timestamp", F.timestamp_millis("offset"))
    closing = as_records(_closing(spark, folder).withColumn("offset", F.col("offset") * 4))
    none = F.lit(None).cast("array<struct<key:string,value:binary>>").alias("headers")
    closing = closing.select(F.col("value").cast("binary").alias("value"), none, "timestamp", "partition", "offset")
    feed(spark, records, run, process, closing)
    return _jumps(spark, run)


def user_jump_partitions_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Three partitions: one ahead, one a third of all lines behind it, one idle after a line."""
    run = new_folder(spark, "user-jumps")
    process = jobs.user_jumps(
        jobs.open_pages(f"{run}/open"),
        jobs.high_marks(f"{run}/marks"),
        folder_sink(f"{run}/facts"),
        WITHIN_MS,
        idle=timedelta(minutes=1),
    )
    lines = inputs.log_lines(spark, folder, as_pages=True, in_time_order=True)
    low, high = inputs.table(spark, folder, "events").agg(F.min("event_id"), F.max("event_id")).first()
    offset = F.col("offset")
    partition = F.when(offset == low, 2).otherwise(offset % 2).cast("int")
    behind = F.when(partition == 1, (high - low) // 3).otherwise(0)
    records = lines.select(
        "value", F.timestamp_seconds(offset + behind).alias("timestamp"), partition.alias("partition"),
        (offset + behind).alias("offset"),
    )
    closing = _closing(spark, folder).select(
        "value", F.timestamp_seconds(offset * 2).alias("timestamp"), F.lit(0).alias("partition"),
        (offset * 2).alias("offset"),
    )
    feed(spark, records, run, process, closing)
    return _jumps(spark, run)


def cart_add_stream(spark: SparkSession, folder: str) -> DataFrame:
    run = new_folder(spark, "cart-adds")
    process = jobs.cart_adds(
        folder_sink(f"{run}/facts"), DATABASE, "dwd_trade_cart_add", inputs.dictionary
    )
    feed(spark, as_records(inputs.cart_change_lines(spark, folder)), run, process)
    schema = ", ".join(f"{name} string" for name in (*CART_COLUMNS, "source_type_name"))
    return (
        read_topic(spark, f"{run}/facts")
        .select(F.from_json("value", schema).alias("row"))
        .select("row.*")
    )


def dim_upsert_stream(spark: SparkSession, folder: str) -> DataFrame:
    run = new_folder(spark, "dimensions")
    store = jobs.dimension_values(f"{run}/values")
    process = jobs.dimensions(
        store, inputs.routing_config, "dims", f"{run}/tables", merge_every=2
    )
    feed(spark, as_records(inputs.dimension_change_lines(spark, folder)), run, process)
    values = jobs.current_values(spark, store, ARRIVAL)
    return values.select("sink_table", "key", "column", "value")


def dim_config_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Routes come, change and go in mid-stream; the first ones are a snapshot's."""
    run = new_folder(spark, "dimensions")
    store = jobs.dimension_values(f"{run}/values")
    records = as_records(inputs.route_log_lines(spark, folder))

    def snapshot(spark: SparkSession) -> DataFrame:
        return decode_config(records.where("offset = 0"))

    process = jobs.dimensions(
        store, snapshot, f"dims_{run[-8:]}", f"{run}/tables", merge_every=2,
        log=jobs.config_log(f"{run}/config-log"),
    )
    changes = as_records(inputs.dimension_change_lines(spark, folder))
    feed(spark, changes, run, process, config=records.where("offset > 0"))
    values = jobs.current_values(spark, store, ARRIVAL)
    return values.select("sink_table", "key", "column", "value")


def dim_tables_stream(spark: SparkSession, folder: str) -> DataFrame:
    """What the published tables hold after a last batch that merges nothing."""
    run = new_folder(spark, "dimensions")
    database = f"dims_{run[-8:]}"
    process = jobs.dimensions(
        jobs.dimension_values(f"{run}/values"), inputs.routing_config, database,
        f"{run}/tables", merge_every=2,
    )
    feed(spark, as_records(inputs.dimension_change_lines(spark, folder)), run, process)
    found = None
    for row in inputs.routing_config(spark).select("sink_table", "sink_pk").collect():
        rows = spark.table(f"{database}.{row['sink_table']}")
        part = rows.select(
            F.lit(row["sink_table"]).alias("sink_table"),
            F.col(row["sink_pk"]).alias("key"),
            F.explode(
                F.array(
                    *[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("value")) for c in rows.columns]
                )
            ).alias("one"),
        ).select("sink_table", "key", "one.*")
        found = part if found is None else found.unionByName(part)
    return found.where("value is not null")


def _page_log_drops(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Drops of a job over lines out of time order, and the marks it leaves."""
    run = new_folder(spark, "drops")
    drops, marks = jobs.drops_table(f"{run}/drops"), jobs.high_marks(f"{run}/marks")
    process = jobs.user_jumps(
        jobs.open_pages(f"{run}/open"), marks, folder_sink(f"{run}/facts"), WITHIN_MS, drops=drops
    )
    feed(spark, as_records(inputs.log_lines(spark, folder, as_pages=True)), run, process)
    return jobs.drop_totals(spark, drops), marks.latest(spark)


def drops_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Lines and rows left out by the page-log and the dimension jobs."""
    pages, _ = _page_log_drops(spark, folder)
    run = new_folder(spark, "drops")
    drops = jobs.drops_table(f"{run}/drops")
    process = jobs.dimensions(
        jobs.dimension_values(f"{run}/values"), inputs.routing_config, f"dims_{run[-8:]}",
        f"{run}/tables", drops=drops,
    )
    feed(spark, as_records(inputs.dimension_change_lines(spark, folder)), run, process)
    return pages.unionByName(jobs.drop_totals(spark, drops))


def user_jump_late_stream(spark: SparkSession, folder: str) -> DataFrame:
    """How many rows came behind the watermark of the batches before, in all batches."""
    _, marks = _page_log_drops(spark, folder)
    return marks.agg(F.sum("late").cast("bigint").alias("late"))


STREAMS = (
    log_split_stream, visitor_flag_stream, unique_visitor_stream, user_jump_stream,
    user_jump_replay_stream, user_jump_partitions_stream,
    cart_add_stream, dim_upsert_stream, dim_config_stream, dim_tables_stream, drops_stream, user_jump_late_stream,
)
