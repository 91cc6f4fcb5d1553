import json

import pytest
from helpers import (
    START_MS, arrival_order, as_lines, counted_visits, day_of, frame, ids, line,
    random_visits, repaired_flags,
)
from pyspark.sql import functions as F

from tidewater.contract import DAY_MS
from tidewater.operators import logs, visitors
from tidewater.operators.scale import arrival_key


def in_arrival_order(spark, values):
    """The frame, and the values as they arrive (partitions interleave)."""
    rows = frame(spark, values)
    return rows, [row["value"] for row in arrival_order(rows.collect())]


@pytest.mark.parametrize(
    "flags, days, expected",
    [
        (["1"], [0], ["1"]),  # first visit, new
        (["1", "1"], [0, 0], ["1", "1"]),  # same day again
        (["1", "1"], [0, 1], ["1", "0"]),  # another day
        (["0", "1"], [0, 0], ["0", "0"]),  # not new at first: the anchor is the day before
        (["0", "1"], [1, 0], ["0", "1"]),  # and that day may still come
        ([None, "1"], [0, 0], [None, "0"]),  # no flag counts as not new
        (["1", "0", "1"], [0, 1, 0], ["1", "0", "1"]),  # the anchor is written once
    ],
)
def test_flag_rules(spark, flags, days, expected):
    values = [line(ts=START_MS + d * DAY_MS, is_new=f) for f, d in zip(flags, days)]
    fixed = visitors.repair_new_flag(logs.parse_logs(frame(spark, values)))
    rows = sorted(fixed.collect(), key=lambda row: row["offset"])
    assert [row["is_new"] for row in rows] == expected
    assert [json.loads(row["common"]).get("is_new") for row in rows] == expected


@pytest.mark.parametrize("max_rows, hot_rows", [(1000, 1000), (0, 1000), (0, 100)])
def test_flags_agree_with_state(spark, max_rows, hot_rows):
    """With the broadcast join, and beyond its bound without and with a hot visitor."""
    dirty = ["", "xx", '{"ts":1}']
    rows, values = in_arrival_order(spark, as_lines(random_visits(600, seed=1)) + dirty)
    visits = []
    for value in values:
        if value not in dirty:
            body = json.loads(value)
            visits.append(
                {"id": body["id"], "ts": body["ts"], **body["common"]}
            )
    repaired = visitors.repair_new_flag(
        logs.parse_logs(rows), max_rows=max_rows, hot_rows=hot_rows
    )
    fixed = repaired.collect()
    assert len(fixed) == 603
    found = {json.loads(row["value"])["id"]: row["is_new"] for row in fixed if row["mid"]}
    assert found == repaired_flags(visits)


@pytest.mark.parametrize("hot_rows", [None, 20, 10_000])
def test_unique_visitors_agree_with_state(spark, hot_rows):
    rows, values = in_arrival_order(spark, as_lines(random_visits(500, seed=2)))
    bodies = [json.loads(value) for value in values]
    visits = [
        {"id": b["id"], "ts": b["ts"], "mid": b["common"]["mid"], "last": b["page"]["last_page_id"]}
        for b in bodies
    ]
    entries = logs.entry_pages(logs.read_pages(rows))
    found = visitors.unique_visitors(entries, hot_rows=hot_rows)
    assert ids(found.collect()) == counted_visits(visits)
    per_day = {(v["mid"], day_of(v["ts"])) for v in visits if v["last"] is None}
    assert visitors.unique_visitors_per_day(entries).count() == len(per_day)


def test_wrong_flags_holds_only_visitors_to_repair(spark):
    values = [line("good", START_MS), line("good", START_MS), line("bad", START_MS)]
    values.append(line("bad", START_MS + DAY_MS))
    anchors = visitors.visit_anchors(logs.parse_logs(frame(spark, values)))
    assert [row["mid"] for row in visitors.wrong_flags(anchors).collect()] == ["bad"]
    assert anchors.where(F.col("mid") == "good").count() == 1


def test_anchors_are_hashed_and_parsed_narrowly(spark):
    """No sort before the first sums, and one parse of three fields."""
    lines = frame(spark, as_lines(random_visits(20, seed=1)))
    anchors = visitors.visit_anchors(logs.parse_visits(lines))
    plan = anchors._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan
    optimized = anchors._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.count("from_json(") == 1 and "displays" not in optimized


def test_arrival_key_orders_like_the_columns(spark):
    rows = frame(spark, [line(id=i) for i in range(30)])
    order = ["timestamp", "partition", "offset"]
    by_columns = [row["offset"] for row in rows.orderBy(*order).collect()]
    by_key = [row["offset"] for row in rows.orderBy(arrival_key(order)).collect()]
    assert by_key == by_columns


@pytest.mark.parametrize("narrow", [False, True])
def test_repair_with_and_without_lines(spark, narrow):
    lines = frame(spark, as_lines(random_visits(200, seed=2)))
    found = visitors.repair_new_flag(logs.parse_logs(lines), lines=lines if narrow else None)
    expected = visitors.repair_new_flag(logs.parse_logs(lines))
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))
