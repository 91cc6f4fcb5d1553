"""The jobs as started from the command line, chained through folders."""

import json

import pytest
from helpers import START_MS, as_lines, frame, ids, line, random_visits
from pyspark.sql import functions as F

from tidewater.__main__ import main, parser
from tidewater.contract import PAGE_TOPIC, UNIQUE_VISITOR_TOPIC, USER_JUMP_TOPIC
from tidewater.operators import bounces, logs, visitors
from tidewater.session import new_folder
from tidewater.sinks.fanout import read_topic


def run(job, work, source, sink, *more):
    main(
        [
            job, "--work", work, "--source", "files", "--source-option", f"path={source}",
            "--sink", "files", "--sink-option", f"path={sink}", "--time-zone", "UTC", *more,
        ]
    )


def test_logs_to_visitors_and_jumps(spark):
    folder = new_folder(spark, "test")
    # The last lines close the windows, in both partitions.
    closing = [line("x", START_MS + 10**9, last="q", id=-1)] * 3
    lines = frame(spark, as_lines(random_visits(100, seed=9)) + closing)
    lines.write.parquet(f"{folder}/log")
    run("log-split", f"{folder}/split", f"{folder}/log", f"{folder}/facts")
    pages = f"{folder}/facts/batch_id=*/topic={PAGE_TOPIC}"
    run("unique-visitors", f"{folder}/uv", pages, f"{folder}/uv-facts")
    run("user-jumps", f"{folder}/jump", pages, f"{folder}/jump-facts")

    split = logs.split_logs(
        visitors.repair_new_flag(logs.parse_logs(lines)), topics=(PAGE_TOPIC,),
        keep=("timestamp", "partition", "offset"),
    )
    expected = logs.read_pages(split)
    entries = logs.entry_pages(expected)
    found = read_topic(spark, f"{folder}/uv-facts", UNIQUE_VISITOR_TOPIC)
    assert ids(found.collect()) == ids(visitors.unique_visitors(entries).collect())
    found = read_topic(spark, f"{folder}/jump-facts", USER_JUMP_TOPIC)
    assert ids(found.collect()) == ids(bounces.bounces(expected).collect())


def test_cart_adds(spark):
    folder = new_folder(spark, "test")
    change = {"database": "shop", "table": "cart_info", "type": "insert", "data": {"id": "1", "source_type": "7"}}
    frame(spark, [json.dumps(change)]).write.parquet(f"{folder}/db")
    names = spark.createDataFrame([("7", "friend")], "dic_code string, dic_name string")
    names.write.parquet(f"{folder}/names")
    more = ["--database", "shop", "--lookup-option", f"path={folder}/names"]
    run("cart-adds", f"{folder}/work", f"{folder}/db", f"{folder}/facts", *more)
    row = json.loads(read_topic(spark, f"{folder}/facts").first()["value"])
    assert row.pop("pt")
    assert row == {"id": "1", "source_type": "7", "source_type_name": "friend"}


def test_dimensions_in_one_shot(spark):
    folder = new_folder(spark, "test")
    changes = [json.dumps({"database": "d", "table": "t", "type": "insert", "data": {"id": i, "n": "x"}}) for i in (1, 2)]
    frame(spark, changes).write.parquet(f"{folder}/db")
    schema = "source_table string, sink_table string, sink_columns string, sink_pk string, sink_extend string"
    spark.createDataFrame([("t", "dim_shot", "id,n", "id", None)], schema).write.parquet(f"{folder}/config")
    run("dimensions", f"{folder}/work", f"{folder}/db", "none", "--lookup-option", f"path={folder}/config", "--target-database", "shot")
    assert sorted(map(tuple, spark.table("shot.dim_shot").collect())) == [("1", "x"), ("2", "x")]


def test_failing_on_bad_page_logs(spark):
    folder = new_folder(spark, "test")
    frame(spark, [line(), "xx"]).write.parquet(f"{folder}/pages")
    with pytest.raises(Exception, match="not a page log"):
        run("user-jumps", f"{folder}/work", f"{folder}/pages", f"{folder}/facts", "--on-error", "fail")


def test_arguments():
    with pytest.raises(SystemExit):
        parser().parse_args(["unknown", "--work", "x"])
    assert parser().parse_args(["user-jumps", "--work", "x"]).source == "kafka"


def test_dimensions_by_a_config_log(spark):
    """Routes come from a log only; the table follows them."""
    folder = new_folder(spark, "test")
    changes = [json.dumps({"database": "d", "table": "t", "type": "insert", "data": {"id": i, "n": "x", "m": "y"}}) for i in (1, 2)]
    row = {"source_table": "t", "sink_table": "dim_t", "sink_columns": "id, n", "sink_pk": None, "sink_extend": None}
    config = [json.dumps({"before": None, "after": row}), "no change"]
    frame(spark, config).withColumn("timestamp", F.expr("timestamp - interval 1 day")).write.parquet(f"{folder}/config")
    frame(spark, changes).write.parquet(f"{folder}/db")
    name = f"db_{folder[-8:]}"
    more = ["--config-option", f"path={folder}/config", "--target-database", name, "--trim"]
    run("dimensions", f"{folder}/work", f"{folder}/db", f"{folder}/facts", *more)
    rows = {tuple(row) for row in spark.table(f"{name}.dim_t").select("id", "n").collect()}
    assert rows == {("1", "x"), ("2", "x")}
    assert spark.table(f"{name}.dim_t").columns == ["id", "n"]


def test_settings_reach_the_jobs(spark):
    """A page five seconds on, judged by a window of two; and one that is sent again."""
    folder = new_folder(spark, "test")
    text = [line("a", START_MS, id=1), line("a", START_MS + 5000, id=2), line("a", START_MS + 5000, id=2), line("z", START_MS + 10**6, id=3)]
    header = lambda name, value: F.struct(F.lit(name).alias("key"), value.cast("string").cast("binary").alias("value"))
    # The third line is the second one again.
    place = F.when(F.col("offset") == 2, 1).otherwise(F.col("offset"))
    rows = frame(spark, text).withColumn("partition", F.lit(0)).withColumn("headers", F.array(header("source-partition", F.lit(0)), header("source-offset", place)))
    rows.write.parquet(f"{folder}/pages")
    for more, expected in ((["--within-ms", "2000"], [1, 2]), (["--hot-rows", "1"], [1, 2]), (["--keep-seen", "", "--within-ms", "2000"], [1, 2, 2])):
        work = f"{folder}/work-{len(expected)}-{len(more)}"
        run("user-jumps", work, f"{folder}/pages", f"{work}/facts", *more)
        assert ids(read_topic(spark, f"{work}/facts").collect()) == expected


def test_config_topic_and_headers_of_kafka(monkeypatch):
    from tidewater import __main__ as command

    asked = []
    monkeypatch.setattr(command, "kafka_lines", lambda spark, options: asked.append(options) or options)
    monkeypatch.setattr(command.jobs, "with_config", lambda changes, config: None)
    base = ["--work", "w", "--source-option", "kafka.bootstrap.servers=h:1"]
    command._stream(None, parser().parse_args(["user-jumps", *base]))
    command._stream(None, parser().parse_args(["dimensions", *base, "--config-option", "startingOffsets=earliest"]))
    assert [one["subscribe"] for one in asked] == [PAGE_TOPIC, "topic_db", "table_process"]
    assert ["includeHeaders" in one for one in asked] == [True, False, False]
    assert asked[2]["startingOffsets"] == "earliest" and "startingOffsets" not in asked[1]
