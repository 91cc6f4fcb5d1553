"""Each job: stream equals batch, and a batch that runs twice changes nothing."""

import json

import pytest
from helpers import START_MS, as_lines, frame, ids, line, random_visits

from tidewater.contract import DIRTY_TOPIC, PAGE_TOPIC
from tidewater.operators import bounces, logs, visitors
from tidewater.session import new_folder
from tidewater.sinks.fanout import folder_sink, read_topic
from tidewater.streaming import jobs

HOUR = 3_600_000


def batches(spark, values, count):
    """The lines cut into micro-batches in arrival order."""
    rows = frame(spark, values)
    order = ["timestamp", "partition", "offset"]
    collected = rows.orderBy(*order).collect()
    size = -(-len(collected) // count)
    return [
        spark.createDataFrame(collected[i : i + size], rows.schema).repartition(3)
        for i in range(0, len(collected), size)
    ]


def run_twice(process, parts):
    for batch_id, part in enumerate(parts):
        process(part, batch_id)
        process(part, batch_id)


@pytest.mark.parametrize("merge_every", [0, 2])
def test_log_split(spark, merge_every):
    values = as_lines(random_visits(300, seed=5)) + ["", "xx"]
    run = new_folder(spark, "test")
    visits = jobs.first_visits(f"{run}/visits")
    process = jobs.log_split(visits, folder_sink(f"{run}/facts"), merge_every=merge_every)
    run_twice(process, batches(spark, values, 4))
    facts = read_topic(spark, f"{run}/facts")
    expected = visitors.repair_new_flag(logs.parse_logs(frame(spark, values)))

    def flags(texts):
        bodies = [json.loads(text) for text in texts]
        return sorted((b["id"], b["common"]["is_new"]) for b in bodies)

    pages = [row["value"] for row in facts.where(f"topic = '{PAGE_TOPIC}'").collect()]
    batch = logs.split_logs(expected, topics=(PAGE_TOPIC,)).collect()
    assert flags(pages) == flags(row["value"] for row in batch)
    assert facts.where(f"topic = '{DIRTY_TOPIC}'").count() == 2
    assert visits.latest(spark).count() == visits.latest(spark).select("mid").distinct().count() == 7


@pytest.mark.parametrize("merge_every, hot_rows", [(0, None), (2, 10)])
def test_unique_visitors(spark, merge_every, hot_rows):
    values = as_lines(random_visits(400, seed=6))
    run = new_folder(spark, "test")
    process = jobs.unique_visitors(
        jobs.last_visits(f"{run}/visits"), folder_sink(f"{run}/facts"),
        merge_every=merge_every, hot_rows=hot_rows,
    )
    run_twice(process, batches(spark, values, 4))
    entries = logs.entry_pages(logs.read_pages(frame(spark, values)))
    expected = ids(visitors.unique_visitors(entries).collect())
    assert ids(read_topic(spark, f"{run}/facts").collect()) == expected


def test_visit_state_expires(spark):
    """A day after its last write the state is gone, however often it was read since."""
    run = new_folder(spark, "test")
    times = iter([0, 23 * HOUR, 24 * HOUR, 30 * HOUR])
    process = jobs.unique_visitors(
        jobs.last_visits(f"{run}/visits"), folder_sink(f"{run}/facts"),
        clock=lambda: next(times), merge_every=2,
    )
    for batch_id in range(4):
        process(frame(spark, [line(ts=START_MS, id=batch_id)]), batch_id)
    assert ids(read_topic(spark, f"{run}/facts").collect()) == [0, 2]


def jump_job(spark, **options):
    run = new_folder(spark, "test")
    open_pages = jobs.open_pages(f"{run}/open")
    marks = jobs.high_marks(f"{run}/marks")
    process = jobs.user_jumps(open_pages, marks, folder_sink(f"{run}/facts"), **options)
    return process, open_pages, marks, lambda: read_topic(spark, f"{run}/facts")


@pytest.mark.parametrize("hot_rows", [None, 10])
def test_user_jumps(spark, hot_rows):
    """Times disordered by up to the allowed lateness, windows across batches."""
    visits = random_visits(400, seed=7, spread_ms=400_000)
    visits.sort(key=lambda v: v["ts"] + 1_900 * (v["id"] % 2))
    values = as_lines(visits)
    process, open_pages, marks, facts = jump_job(spark, hot_rows=hot_rows)
    run_twice(process, batches(spark, values, 6))
    late = marks.latest(spark).first()["late"]
    expected = bounces.bounces(logs.read_pages(frame(spark, values)))
    found = ids(facts().collect()) + ids(jobs.remaining_jumps(spark, open_pages).collect())
    assert late == 0
    assert sorted(found) == ids(expected.collect())
    assert open_pages.latest(spark).count() < 40


def test_user_jump_waits_for_the_watermark(spark):
    process, open_pages, _, facts = jump_job(spark)
    process(frame(spark, [line("m", START_MS, id=0)]), 0)
    assert facts().count() == 0 and open_pages.latest(spark).count() == 1
    # Ten seconds on, a row within the window may still come: two seconds late at most.
    process(frame(spark, [line("x", START_MS + 11_999, last="q", id=1)]), 1)
    assert facts().count() == 0
    process(frame(spark, [line("x", START_MS + 12_000, last="q", id=2)]), 2)
    assert ids(facts().collect()) == [0]


def test_late_rows_are_dropped_and_counted(spark):
    process, _, marks, facts = jump_job(spark)
    process(frame(spark, [line("m", START_MS, id=0), line("x", START_MS + 9_000, id=1)]), 0)
    # 7.0 s is not behind the watermark of 9 - 2 s, 6.999 s is.
    second = [line("m", START_MS + 6_999, last="q", id=2), line("x", START_MS + 50_000, last="q", id=3)]
    process(frame(spark, second), 1)
    assert marks.latest(spark).first()["late"] == 1
    process(frame(spark, [line("m", START_MS + 7, last="q", id=4)]), 2)
    process(frame(spark, [line("y", START_MS + 60_000, last="q", id=5)]), 3)
    assert marks.latest(spark).first()["late"] == 2
    assert ids(facts().collect()) == [0, 1]


def test_drops_are_counted_by_reason(spark):
    run = new_folder(spark, "test")
    drops = jobs.drops_table(f"{run}/drops")
    good = [line(ts=START_MS, id=0)]
    bad = ["xx", "", '{"common":{"mid":"m"},"ts":9223372036854775807,"page":{}}']
    sink = folder_sink(f"{run}/facts")
    uv = jobs.unique_visitors(jobs.last_visits(f"{run}/uv"), sink, drops=drops)
    run_twice(uv, [frame(spark, good + bad)])
    process, _ = dimension_job(spark, [("t", "dim_drops", "id", "id", None)], drops=jobs.drops_table(f"{run}/dim"))
    run_twice(process, [frame(spark, ["xx", dimension_line({"id": 1}), dimension_line({"id": 1}, table="u")])])
    cart = jobs.cart_adds(folder_sink(f"{run}/cart"), "d", "topic", drops=jobs.drops_table(f"{run}/carts"))
    run_twice(cart, [frame(spark, ["xx", "yy"])])

    def totals(path):
        return sorted(map(tuple, jobs.drop_totals(spark, jobs.drops_table(path)).collect()))

    assert totals(f"{run}/drops") == [("unique-visitors", "no page log", 3)]
    assert totals(f"{run}/dim") == [("dimensions", "no change row", 1), ("dimensions", "no route: u", 1)]
    assert totals(f"{run}/carts") == [("cart-adds", "no change row", 2)]


@pytest.mark.parametrize("job", ["visitors", "jumps"])
def test_bad_page_logs_can_fail_the_job(spark, job):
    if job == "jumps":
        process, *_ = jump_job(spark, on_error="fail")
    else:
        run = new_folder(spark, "test")
        process = jobs.unique_visitors(
            jobs.last_visits(f"{run}/v"), folder_sink(f"{run}/f"), on_error="fail"
        )
    with pytest.raises(Exception, match="not a page log"):
        process(frame(spark, [line(), "xx"]), 0)


def test_tables_can_be_read_after_every_batch(spark):
    """Also with a grown config, two sources of one table, and in a process started anew."""
    run = new_folder(spark, "test")
    schema = "source_table string, sink_table string, sink_columns string, sink_pk string, sink_extend string"
    config = [("t", "dim_live", "id,name", "id", None), ("u", "dim_live", "id,size", "id", None)]

    def process():
        return jobs.dimensions(
            jobs.dimension_values(f"{run}/values"), lambda s: s.createDataFrame(config, schema),
            "streaming_test", f"{run}/tables", merge_every=100,
        )

    def found():
        return sorted(map(tuple, spark.table("streaming_test.dim_live").collect()), key=str)

    first = process()
    first(frame(spark, [dimension_line({"id": 1, "name": "a"})]), 0)
    assert found() == [("1", "a", None)]
    first(frame(spark, [dimension_line({"id": 1, "size": 5}, table="u")]), 1)
    assert found() == [("1", "a", "5")]
    spark.sql("DROP TABLE streaming_test.dim_live")
    config[0] = ("t", "dim_live", "id,name,color", "id", None)
    second = process()
    second(frame(spark, [dimension_line({"id": 9}, table="elsewhere")]), 2)
    assert sorted(spark.table("streaming_test.dim_live").columns) == ["color", "id", "name", "size"]
    second(frame(spark, [dimension_line({"id": 2, "color": "red"})]), 3)
    rows = spark.table("streaming_test.dim_live").select("id", "name", "size", "color").collect()
    assert sorted(map(tuple, rows)) == [("1", "a", "5", None), ("2", None, None, "red")]


def test_row_at_the_watermark_is_in_time(spark):
    process, _, marks, facts = jump_job(spark)
    process(frame(spark, [line("m", START_MS, id=0), line("x", START_MS + 9_000, last="q", id=1)]), 0)
    second = [line("m", START_MS + 7_000, last="q", id=2), line("x", START_MS + 50_000, last="q", id=3)]
    process(frame(spark, second), 1)
    assert marks.latest(spark).first()["late"] == 0
    assert facts().count() == 0


def dimension_job(spark, config_rows, **options):
    run = new_folder(spark, "test")
    store = jobs.dimension_values(f"{run}/values")
    schema = (
        "source_table string, sink_table string, sink_columns string, sink_pk string, "
        "sink_extend string"
    )
    process = jobs.dimensions(
        store, lambda session: session.createDataFrame(config_rows, schema), "streaming_test",
        f"{run}/tables", **options,
    )
    return process, store


def dimension_line(data, type="update", table="t"):
    return json.dumps({"database": "d", "table": table, "type": type, "data": data})


def test_dimensions(spark):
    rows = [("t", "dim_stream", "id,name,size", "id", None)]
    process, store = dimension_job(spark, rows, merge_every=2)
    parts = [
        [dimension_line({"id": 1, "name": "a", "size": 5}), dimension_line({"id": 2, "name": "b"})],
        [dimension_line({"id": 1, "name": "it's"}), dimension_line({"id": 9}, table="unknown")],
        [dimension_line({"id": 2, "name": None}), dimension_line({"id": 3}, type="delete")],
        [dimension_line({"id": 4, "name": "d"})],
    ]
    run_twice(process, [frame(spark, part) for part in parts])
    table = spark.table("streaming_test.dim_stream")
    assert sorted(map(tuple, table.collect())) == [
        ("1", "it's", "5"), ("2", None, None), ("4", "d", None),
    ]
    values = jobs.current_values(spark, store, jobs.ARRIVAL)
    assert values.count() == 7 and values.where("key = '1' AND column = 'name'").first()["value"] == "it's"


def test_change_without_key_fails_the_batch(spark):
    process, _ = dimension_job(spark, [("t", "dim_keyless", "id,name", "id", None)])
    with pytest.raises(Exception, match="without a key for dim_keyless"):
        process(frame(spark, [dimension_line({"name": "a"})]), 0)
