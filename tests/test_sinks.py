import json
import os
from pathlib import Path

import pytest
from helpers import frame
from pyspark.sql import Row, functions as F

from tidewater.contract import ARRIVAL
from tidewater.operators import dims, logs
from tidewater.plans.inputs import routing_config
from tidewater.session import new_folder
from tidewater.sinks import fanout, tables
from tidewater.sinks.batches import BatchTable, KeyedTable, is_complete, last_per_key, write_once


def numbers(spark, *values):
    return spark.createDataFrame([(value,) for value in values], "n int")


def found(frame):
    return sorted(row["n"] for row in frame.collect())


def test_write_once(spark):
    path = f"{new_folder(spark, 'test')}/batch_id=0"
    assert not is_complete(spark, path)
    write_once(numbers(spark, 1), path)
    write_once(numbers(spark, 2), path)
    assert found(spark.read.parquet(path)) == [1]


def test_unfinished_batches_are_not_read(spark):
    table = BatchTable(new_folder(spark, "test"), "n int")
    numbers(spark, 9).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(
        f"{table.path}/delta/batch_id=0"
    )
    assert found(table.latest(spark)) == []
    table.add(0, numbers(spark, 1))
    assert found(table.latest(spark)) == [1]


def test_batch_table(spark):
    table = BatchTable(new_folder(spark, "test"), "n int")
    assert found(table.before(spark, 5)) == []
    for batch_id in range(4):
        table.add(batch_id, numbers(spark, batch_id))
        if batch_id % 2:
            table.replace(batch_id, table.before(spark, batch_id + 1).drop("batch_id"))
    assert found(table.latest(spark)) == [0, 1, 2, 3]
    # Batch 3 may run again: what it read is still there, what it wrote is not read.
    assert found(table.before(spark, 3)) == [0, 1, 2]
    assert table._versions(spark, "full") == [1, 3]
    assert table._versions(spark, "delta") == [2, 3]


def test_keyed_table_reads_and_merges_touched_buckets(spark):
    table = KeyedTable(new_folder(spark, "test"), "n int", "n", buckets=8)
    for batch_id in range(6):
        table.add(batch_id, numbers(spark, *range(10 * batch_id, 10 * batch_id + 10)))
        if batch_id == 3:
            table.merge(spark, batch_id, lambda rows: rows.drop("batch_id"))
    assert found(table.before(spark, 9)) == list(range(60))
    one = table.before(spark, 9, numbers(spark, 7))
    buckets = {name.partition("/bucket=")[2].partition("/")[0] for name in one.inputFiles()}
    assert len(buckets) == 1 and 7 in found(one) and len(found(one)) < 30
    # A replay of the merging batch reads what it read then.
    assert found(table.before(spark, 3)) == list(range(30))

    # A merge after a batch of one key writes that key's bucket only.
    small = KeyedTable(new_folder(spark, "test"), "n int", "n", buckets=8)
    small.add(0, numbers(spark, *range(40)))
    small.merge(spark, 0, lambda rows: rows.drop("batch_id"))
    small.add(1, numbers(spark, 100))
    small.merge(spark, 1, lambda rows: rows.drop("batch_id"))
    small.merge(spark, 1, lambda rows: rows.drop("batch_id"))
    assert len(small._buckets_in(spark, "full", 0)) == 8
    assert len(small._buckets_in(spark, "full", 1)) == 1
    assert found(small.latest(spark)) == [*range(40), 100]
    small.add(2, numbers(spark, 100))
    small.merge(spark, 2, lambda rows: rows.select("n").distinct())
    assert found(small.latest(spark)) == [*range(40), 100]
    assert len(small._buckets_in(spark, "full", 0)) == 7


def bytes_read(spark):
    """Of local files, by this process so far."""
    statistics = spark.sparkContext._jvm.org.apache.hadoop.fs.FileSystem.getGlobalStorageStatistics()
    return statistics.get("file").getLong("bytesRead")


def test_few_keys_are_read_by_page(spark):
    table = KeyedTable(new_folder(spark, "test"), "mid string, n bigint", "mid", buckets=4)
    mid = F.concat(F.lit("mid_"), F.xxhash64("id").cast("string"))
    table.add(0, spark.range(1_000_000).select(mid.alias("mid"), F.col("id").alias("n")))
    table.merge(spark, 0, lambda rows: rows.drop("batch_id"))
    table.add(1, spark.range(1_000_000, 1_000_500).select(mid.alias("mid"), F.col("id").alias("n")))
    size = sum(f.stat().st_size for f in Path(table.path.removeprefix("file:")).glob("full/*/*/*.parquet"))
    keys = spark.range(100).select((F.col("id") * 9_973 + 3_000).alias("id")).select(mid.alias("mid"))
    before = bytes_read(spark)
    rows = table.before(spark, 2, keys).select("mid", "n").collect()
    assert sorted(row["n"] for row in rows) == [9_973 * i + 3_000 for i in range(100)]
    assert bytes_read(spark) - before < 0.05 * size
    # With more keys than are looked for one by one, whole buckets.
    many = spark.range(2_000).select(mid.alias("mid"))
    found = table.before(spark, 2, many).join(many, "mid", "left_semi")
    assert found.count() == 2_000
    none = table.before(spark, 2, many.where("false"))
    assert none.count() == 0 and none.columns == rows[0].__fields__ + ["batch_id"]


def test_a_merge_spreads_a_bucket_over_tasks(spark):
    table = KeyedTable(new_folder(spark, "test"), "n bigint", "n", buckets=1)
    table.add(0, spark.range(5_000).toDF("n"))
    adaptive = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    table.merge(spark, 0, lambda rows: rows.drop("batch_id"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", adaptive)
    files = list(Path(table.path.removeprefix("file:")).glob("full/batch_id=0/bucket=0/*.parquet"))
    assert len(files) > 4
    table.add(1, spark.range(5_000, 5_001).toDF("n"))
    table.merge(spark, 1, lambda rows: rows.drop("batch_id"))
    assert found(table.before(spark, 5, numbers(spark, 7, 5_000))) == [7, 5_000]
    assert found(table.latest(spark)) == list(range(5_001))


def test_keys_may_be_null(spark):
    table = KeyedTable(new_folder(spark, "test"), "n int", "n", buckets=4)
    table.add(0, spark.createDataFrame([(1,), (None,), (2,)], "n int"))
    table.merge(spark, 0, lambda rows: rows.drop("batch_id"))
    asked = spark.createDataFrame([(None,), (2,)], "n int")
    assert sorted(row["n"] or 0 for row in table.before(spark, 1, asked).collect()) == [0, 2]


def test_last_per_key(spark):
    rows = spark.createDataFrame([("a", 1, 0), ("a", 2, 3), ("b", 3, 1)], "k string, n int, batch_id long")
    assert found(last_per_key(rows, ["k"], ["n"])) == [2, 3]


def test_folder_sink_prunes_topics(spark):
    path = new_folder(spark, "test")
    sink = fanout.folder_sink(path)
    rows = spark.createDataFrame([("a", "1"), ("b", "2"), ("a", "3")], "topic string, value string")
    sink(rows, 0)
    sink(rows, 0)
    sink(rows.where("topic = 'a'"), 1)
    read = fanout.read_topic(spark, path, "a")
    assert sorted(row["value"] for row in read.collect()) == ["1", "1", "3", "3"]
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(topic" in plan


def test_kafka_records(spark):
    rows = spark.createDataFrame([("t", "é"), ("t", None)], "topic string, value string")
    sent = fanout.kafka_records(rows)
    assert sent.dtypes == [("topic", "string"), ("value", "binary")]
    assert sorted(bytes(row["value"]) for row in sent.collect()) == [b"", "é".encode()]


def test_kafka_headers_tell_where_a_fact_is_from(spark):
    """Equal for a batch that is sent again, whatever the partitioning; one per fact."""
    body = {"common": {"mid": "m"}, "ts": 1, "page": {}, "displays": [{"item": 1}, {"item": 1}]}
    lines = frame(spark, [json.dumps(body)] * 5)

    def sent(rows):
        facts = logs.split_logs(logs.parse_logs(rows), keep=ARRIVAL, numbered=True)
        return [
            (row["topic"], bytes(row["value"]), tuple((h["key"], bytes(h["value"])) for h in row["headers"]))
            for row in fanout.kafka_records(facts).collect()
        ]

    once, again = sent(lines), sent(lines.repartition(7))
    assert sorted(once) == sorted(again)
    assert len({headers for _, _, headers in once}) == len(once) == 15
    assert {key for key, _ in once[0][2]} == {"source-partition", "source-offset", "source-nth"}


def test_create_statement_quotes(spark):
    text = tables.create_statement("d", "t", ["a", "b`c"], "a", "it's", "/x")
    assert "`b``c` STRING" in text and "'extend' = 'it\\'s'" in text


def test_key_must_be_listed(spark):
    wrong = routing_config(spark).replace("s_suppkey", "id", ["sink_pk"])
    with pytest.raises(ValueError, match="of 1 tables.*dim_supplier"):
        tables.planned_tables(wrong)


def test_sources_of_one_table_add_up_their_columns(spark):
    schema = "source_table string, sink_table string, sink_columns string, sink_pk string, sink_extend string"
    rows = [("b", "t", "id,y", None, "e"), ("a", "t", "x,id", "id", None)]
    found = tables.planned_tables(spark.createDataFrame(rows, schema))
    assert found == [Row(sink_table="t", columns=["x", "id", "y"], key="id", extend="")]
    rows.append(("c", "t", "x,z", "z", None))
    with pytest.raises(ValueError, match="differ in the key"):
        tables.planned_tables(spark.createDataFrame(rows, schema))
    with pytest.raises(ValueError, match="_bucket"):
        tables.planned_tables(spark.createDataFrame([("a", "t", "id,_BUCKET", None, "e")], schema))


def test_tables_are_made_and_published(spark):
    path = new_folder(spark, "test")
    config = routing_config(spark).where("source_table = 'supplier'")
    made = tables.ensure_tables(spark, config, "sinks_test", path)
    assert made == [
        Row(sink_table="dim_supplier", columns=["s_suppkey", "s_name"], key="s_suppkey", extend="buckets=4")
    ]
    tables.ensure_tables(spark, config, "sinks_test", path)
    assert spark.table("sinks_test.dim_supplier").count() == 0
    properties = spark.sql("SHOW TBLPROPERTIES sinks_test.dim_supplier").collect()
    assert {("key", "s_suppkey"), ("extend", "buckets=4")} <= {(p["key"], p["value"]) for p in properties}
    rows = [
        ("dim_supplier", "1", "s_suppkey", "1"), ("dim_supplier", "1", "s_name", "x'y"),
        ("dim_supplier", "2", "s_suppkey", "2"), ("other", "1", "s_name", "no"),
    ]
    values = spark.createDataFrame(rows, "sink_table string, key string, column string, value string")
    tables.upsert(values, made, "sinks_test", path, 0)
    more = [("dim_supplier", "2", "s_name", "two"), ("dim_supplier", "1", "s_name", None)]
    tables.upsert(spark.createDataFrame(more, values.schema), made, "sinks_test", path, 1)
    there = lambda: sorted(tuple(row) for row in spark.table("sinks_test.dim_supplier").collect())
    assert there() == [("1", None), ("2", "two")]
    # A new process, whose catalogue is empty, finds the newest version; and new columns.
    spark.sql("DROP TABLE sinks_test.dim_supplier")
    wider = config.replace("s_suppkey,s_name", "s_suppkey,s_name,s_more", ["sink_columns"])
    known = {}
    tables.ensure_tables(spark, config, "sinks_test", path, known)
    tables.ensure_tables(spark, wider, "sinks_test", path, known)
    assert there() == [("1", None, None), ("2", "two", None)]
    assert dims.schema_errors(config).count() == 0
    # A route that lists fewer columns than before leaves the others as they are.
    last = spark.createDataFrame([("dim_supplier", "1", "s_more", "m"), ("dim_supplier", "3", "s_suppkey", "3")], values.schema)
    for _ in range(2):
        tables.upsert(last, made, "sinks_test", path, 7)
        assert there() == [("1", None, "m"), ("2", "two", None), ("3", None, None)]


def stored_files(path):
    return {os.path.join(at, name): os.path.getsize(os.path.join(at, name)) for at, _, names in os.walk(path) for name in names if name.endswith(".parquet")}


def test_one_changed_key_writes_one_bucket(spark):
    """Of a table of a million rows; who reads sees whole versions, old or new."""
    path, name = new_folder(spark, "test"), "sinks_bytes"
    schema = "source_table string, sink_table string, sink_columns string, sink_pk string, sink_extend string"
    config = spark.createDataFrame([("t", "wide", "key,old,note", "key", None)], schema)
    made = tables.ensure_tables(spark, config, name, path)
    one = F.array(*[F.struct(F.lit(c).alias("column"), F.concat(F.lit(c[0]), F.col("id").cast("string")).alias("value")) for c in ("old", "note")])
    key = F.col("id").cast("string")
    values = spark.range(1_000_000).select(F.lit("wide").alias("sink_table"), key.alias("key"), F.explode(
        F.concat(one, F.array(F.struct(F.lit("key").alias("column"), key.alias("value"))))).alias("one"),
    ).select("sink_table", "key", "one.*")
    tables.upsert(values, made, name, path, 0)
    first = stored_files(path)
    old = spark.table(f"{name}.wide").where("key in ('5', '6')").orderBy("key")
    assert [tuple(row) for row in old.collect()] == [("5", "o5", "n5"), ("6", "o6", "n6")]
    change = spark.createDataFrame([("wide", "5", "note", "new")], "sink_table string, key string, column string, value string")
    tables.upsert(change, made, name, path, 1)
    second = stored_files(path)
    written = sum(size for file, size in second.items() if file not in first)
    assert written < 1.5 * sum(first.values()) / tables.BUCKETS
    # A reader of the version before finds all of it; a new one the next version.
    assert set(first) <= set(second)
    assert [tuple(row) for row in old.collect()] == [("5", "o5", "n5"), ("6", "o6", "n6")]
    rows = spark.table(f"{name}.wide")
    assert rows.count() == 1_000_000
    assert [tuple(row) for row in rows.where("key = '5'").collect()] == [("5", "o5", "new")]
    # The version after that one deletes what nobody reads any more, and nothing else.
    tables.upsert(change.replace("new", "newer", ["value"]), made, name, path, 2)
    assert len(stored_files(path)) == len(second)
    assert spark.table(f"{name}.wide").where("note = 'newer'").count() == 1
    assert spark.table(f"{name}.wide").count() == 1_000_000


def test_locations_name_every_bucket():
    assert tables.table_location("/t", {}) == "/t/version=none"
    assert tables.table_location("/t", {3: 1}) == "/t/version=1/_bucket=3"
    assert tables.table_location("/t", {3: 1, 4: 1}) == "/t/version=1/_bucket={3,4}"
    assert tables.table_location("/t", {3: 1, 4: 0, 5: 1}) == "/t/{version=0/_bucket=4,version=1/_bucket={3,5}}"
    spread = {bucket: 10**6 + bucket for bucket in range(tables.BUCKETS)}
    assert len(tables.table_location("/t", spread)) < 4000
