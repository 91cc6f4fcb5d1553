"""How much one task reads stays the same, however large tables and archives get."""

from helpers import frame, line
from pyspark.sql import functions as F

from tidewater.plans import inputs
from tidewater.session import new_folder, short_splits
from tidewater.sources.lines import file_lines
from tidewater.streaming import jobs


def most_rows(rows):
    counts = rows.groupBy(F.spark_partition_id().alias("task")).count()
    return counts.agg(F.max("count")).first()[0]


def test_tasks_get_more_with_the_rows_not_larger(spark):
    rows = spark.range(20_000).withColumn("other", F.lit("x"))
    dealt = inputs.spread(rows, "id", rows_a_task=500)
    assert dealt.rdd.getNumPartitions() == 40 and most_rows(dealt) < 750
    assert sorted(row["id"] for row in dealt.collect()) == list(range(20_000))
    assert inputs.spread(rows, "id", least=1).rdd.getNumPartitions() == rows.rdd.getNumPartitions()


def test_a_slice_of_lines_comes_from_all_tasks(spark):
    """Also if the table has as many files as there are cores, each with rows that follow one another."""
    folder = new_folder(spark, "test")
    events = spark.range(0, 3200, 1, 16).select(
        F.col("id").alias("event_id"), F.timestamp_millis(F.col("id")).alias("ts"),
        F.lit(1).alias("user_id"), F.lit("view").alias("event_type"), F.lit("{}").alias("props"),
    )
    events.write.parquet(f"{folder}/events.parquet")
    for in_order in (False, True):
        lines = inputs.log_lines(spark, folder, as_pages=True, in_time_order=in_order)
        last = lines.agg(F.max("offset")).first()[0]
        first_third = lines.where(F.col("offset") < last // 3)
        cores = spark.sparkContext.defaultParallelism
        assert most_rows(first_third) < 2 * first_third.count() / cores


def test_files_of_lines_are_read_in_short_splits(spark):
    run = new_folder(spark, "test")
    frame(spark, [line(id=i) for i in range(40)]).repartition(40, "offset").write.parquet(f"{run}/archive")
    found = []

    def process(rows, batch_id):
        found.append((rows.rdd.getNumPartitions(), rows.count()))

    for split_bytes in (1 << 20, 64 << 20):
        stream = file_lines(spark, f"{run}/archive")
        with short_splits(spark, split_bytes):
            jobs.start(stream, process, f"{run}/{split_bytes}").awaitTermination()
    (many, rows), (few, same) = found
    assert rows == same == 40 and many > few
