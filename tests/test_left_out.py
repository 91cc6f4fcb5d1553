"""Lines left out are kept and can come again; lookups stay as a batch saw them; expired state goes."""

import json
import os
from datetime import datetime, timedelta

from helpers import START_MS, frame, ids, line
from pyspark.sql import functions as F

from tidewater.session import new_folder
from tidewater.sinks.fanout import folder_sink, kafka_records, read_topic
from tidewater.sources.lines import file_lines
from tidewater.streaming import jobs
from tidewater.streaming.lookups import PinnedLookup
from tidewater.streaming.replays import SeenFacts

DAY_MS = 86_400_000


def rejects(spark, path):
    rows = spark.read.parquet(path).where(F.col("topic") == jobs.REJECTED_TOPIC)
    return sorted((row["reason"], row["value"]) for row in rows.collect())


def test_pages_left_out_are_kept_in_the_same_write(spark):
    run = new_folder(spark, "test")
    good = [line(f"m{i}", START_MS, id=i) for i in range(3)]
    uv = jobs.unique_visitors(jobs.last_visits(f"{run}/v"), folder_sink(f"{run}/uv"), keep_rejects=True)
    for _ in range(2):
        uv(frame(spark, [*good, "xx", "", '{"a":1}']), 0)
    # Every line is a fact or a reject: here all pages are a visitor's first.
    assert rejects(spark, f"{run}/uv") == [("no page log", text) for text in ("", "xx", '{"a":1}')]
    assert read_topic(spark, f"{run}/uv").count() == 6
    # Mended, they can be fed in again as they are.
    again = file_lines(spark, f"{run}/uv/batch_id=0/topic={jobs.REJECTED_TOPIC}", stream=False)
    mended = again.withColumn("value", F.when(F.col("value") == "xx", line("m9", START_MS, id=9)).otherwise(F.col("value")))
    uv(mended, 1)
    facts = read_topic(spark, f"{run}/uv").where("topic <> 'rejected'")
    assert ids(facts.collect()) == [0, 1, 2, 9]


def test_late_pages_are_kept(spark):
    run = new_folder(spark, "test")
    marks = jobs.high_marks(f"{run}/marks")
    process = jobs.user_jumps(jobs.open_pages(f"{run}/open"), marks, folder_sink(f"{run}/facts"), keep_rejects=True, seen=SeenFacts(f"{run}/seen"))
    late = line("m", START_MS, id=2)
    for batch_id, text in enumerate([[line("m", START_MS + 60_000, id=1)], [late, "xx"], [line("z", START_MS + 10**6, id=3)]]):
        rows = frame(spark, text).withColumns({"source_partition": F.lit(0), "source_offset": F.lit(batch_id) * 10 + F.col("offset"), "source_nth": F.lit(0)})
        process(rows, batch_id)
        process(rows, batch_id)
    assert rejects(spark, f"{run}/facts") == [("late", late), ("no page log", "xx")]


def test_changes_left_out_are_kept(spark):
    run = new_folder(spark, "test")
    change = lambda table: json.dumps({"database": "d", "table": table, "type": "insert", "data": {"id": 1}})
    cart = jobs.cart_adds(folder_sink(f"{run}/cart"), "d", "cart", keep_rejects=True)
    cart(frame(spark, [change("cart_info"), "xx"]), 0)
    assert rejects(spark, f"{run}/cart") == [("no change row", "xx")]
    schema = "source_table string, sink_table string, sink_columns string, sink_pk string, sink_extend string"
    process = jobs.dimensions(
        jobs.dimension_values(f"{run}/values"), lambda s: s.createDataFrame([("t", "dim_left", "id", "id", None)], schema),
        "streaming_test", f"{run}/tables", rejects=folder_sink(f"{run}/rejects"),
    )
    for _ in range(2):
        process(frame(spark, [change("t"), change("u"), "xx"]), 0)
    assert rejects(spark, f"{run}/rejects") == [("no change row", "xx"), ("no route: u", change("u"))]
    # The routed one, and the two above: all lines there were.
    assert spark.table("streaming_test.dim_left").count() == 1


def test_reasons_are_headers(spark):
    rows = spark.createDataFrame([("a", "t", 1, None), ("b", "rejected", 2, "late")], "value string, topic string, offset bigint, reason string")
    found = {bytes(r["value"]): [(h["key"], bytes(h["value"])) for h in r["headers"]] for r in kafka_records(rows).collect()}
    assert found == {b"a": [("source-offset", b"1")], b"b": [("source-offset", b"2"), ("reason", b"late")]}


def test_a_batch_that_runs_again_sees_the_same_dictionary(spark):
    run = new_folder(spark, "test")
    names, now, loaded = ["first"], [0], []

    def load(spark):
        loaded.append(names[0])
        return spark.createDataFrame([("7", names[0])], "dic_code string, dic_name string")

    pinned = PinnedLookup(f"{run}/lookup", load, max_age_ms=60_000, clock=lambda: now[0])
    change = json.dumps({"database": "d", "table": "cart_info", "type": "insert", "data": {"id": "1", "source_type": "7"}})

    def name_of(batch_id, attempt):
        sink = f"{run}/facts-{batch_id}-{attempt}"
        jobs.cart_adds(folder_sink(sink), "d", "t", pinned)(frame(spark, [change]), batch_id)
        return json.loads(read_topic(spark, sink).first()["value"])["source_type_name"]

    assert name_of(0, 0) == "first"
    names[0], now[0] = "second", 60_000
    assert name_of(0, 1) == "first"
    assert name_of(1, 0) == "first"  # not old enough
    now[0] = 60_001
    assert name_of(2, 0) == "second"
    names[0], now[0] = "third", 10**9
    assert name_of(2, 1) == "second" and name_of(1, 1) == "first"
    assert name_of(3, 0) == "third"
    assert loaded == ["first", "second", "third"]
    # Versions that no batch can use any more are gone.
    assert sorted(os.listdir(f"{run}/lookup/tables")) == ["version=2", "version=3"]


def test_expired_state_frees_its_folders(spark):
    run = new_folder(spark, "test")
    now = [0]
    visits = jobs.last_visits(f"{run}/visits", 8)
    process = jobs.unique_visitors(visits, folder_sink(f"{run}/facts"), clock=lambda: now[0], merge_every=1)
    size = lambda: sum(os.path.getsize(os.path.join(at, f)) for at, _, files in os.walk(f"{run}/visits") for f in files)

    def batch(batch_id, mids):
        at = datetime(2024, 1, 1) + timedelta(days=batch_id)
        rows = [(line(mid, START_MS + batch_id * DAY_MS, id=batch_id), at, 0, i) for i, mid in enumerate(mids)]
        process(spark.createDataFrame(rows, "value string, timestamp timestamp, partition int, offset bigint"), batch_id)

    many = [f"m{i}" for i in range(2000)]
    batch(0, many)
    batch(1, many[:1000])
    full = size()
    assert visits.latest(spark).count() == 2000
    # A day later the others are visited no more: one visitor is, and one bucket changes.
    now[0] = DAY_MS + 1
    batch(2, ["one"])
    batch(3, ["one"])
    batch(4, ["one"])
    assert size() < full / 5
    assert visits.latest(spark).where("mid = 'one'").count() >= 1
    assert read_topic(spark, f"{run}/facts").count() == 2000 + 1000 + 3
