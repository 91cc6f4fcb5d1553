import datetime

import pytest

from tidewater.functions.times import (
    to_date_text, to_day, to_epoch_ms, to_previous_day, to_second_text,
)
from tidewater.session import new_folder, shared_folder, shuffle_partitions
from tidewater.sources import lines, lookup
from pyspark.sql import functions as F

MS = 1_675_270_337_754  # 2023-02-01 16:52:17.754 UTC


@pytest.mark.parametrize(
    "zone, day, second",
    [
        ("UTC", "2023-02-01", "2023-02-01 16:52:17"),
        ("Asia/Shanghai", "2023-02-02", "2023-02-02 00:52:17"),
    ],
)
def test_dates_follow_the_session_zone(spark, zone, day, second):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        row = spark.range(1).select(F.lit(MS).alias("ms")).select(
            to_date_text("ms"), to_second_text("ms"), to_day("ms"), to_previous_day("ms"),
            to_epoch_ms(F.lit("2023-02-22")), to_epoch_ms(F.lit("2023-02-22 01:14:14"), full=True),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    parsed = datetime.date.fromisoformat(day)
    assert tuple(row)[:4] == (day, second, parsed, parsed - datetime.timedelta(days=1))
    assert tuple(row)[4:] == (1_676_995_200_000, 1_676_999_654_000)  # always +08:00


def test_kafka_options():
    assert lines.kafka_options("h:1", "topic_log", "g", "earliest", 5) == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "topic_log", "kafka.group.id": "g",
        "startingOffsets": "earliest", "maxOffsetsPerTrigger": "5",
    }
    assert set(lines.kafka_options("h:1", "t")) == {"kafka.bootstrap.servers", "subscribe"}


def test_records_without_value_become_empty_lines(spark):
    records = spark.createDataFrame(
        [(bytearray("é".encode()), None, 0, 1), (None, None, 0, 2)],
        "value binary, timestamp timestamp, partition int, offset bigint",
    )
    assert sorted(row["value"] for row in lines.as_lines(records).collect()) == ["", "é"]


def test_file_lines(spark):
    path = new_folder(spark, "test")
    spark.createDataFrame([("x", None, 0, 1)], lines.LINE_SCHEMA).write.parquet(path)
    batch = lines.file_lines(spark, path, stream=False)
    assert [row["value"] for row in batch.collect()] == ["x"]
    stream = lines.file_lines(spark, path)
    assert stream.isStreaming and stream.columns == batch.columns


def test_jdbc_options():
    options = lookup.jdbc_options("jdbc:x", "base_dic", "u", "p", "d", fetchsize="10")
    assert options["dbtable"] == "base_dic" and options["fetchsize"] == "10"
    assert options["customSchema"].startswith("dic_code STRING, dic_name STRING")


def test_shared_folder_is_the_one_configured(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_folder(spark) == (configured or shared_folder(spark))
    assert new_folder(spark, "a") != new_folder(spark, "a")


def test_shuffle_partitions_grow_with_the_input():
    assert shuffle_partitions(1 << 20) == 200
    assert shuffle_partitions(100 << 40) == 102_400
