import json

import pytest
from helpers import START_MS, arrival_order, as_lines, bounced_visits, frame, ids, line, random_visits

from tidewater.operators import bounces, logs, scale, visitors
from tidewater.operators.scale import with_neighbour

S = 1000


def found(spark, pages, **options):
    values = [
        line("m", START_MS + at, last=last, id=i) for i, (at, last) in enumerate(pages)
    ]
    rows = bounces.bounces(logs.read_pages(frame(spark, values)), **options).collect()
    return sorted((json.loads(row["value"])["id"], row["kind"]) for row in rows)


def test_match_then_timeout(spark):
    assert found(spark, [(0, None), (5 * S, None)]) == [(0, "match"), (1, "timeout")]


def test_second_page_is_no_bounce(spark):
    assert found(spark, [(0, None), (5 * S, "home")]) == []


def test_second_page_too_late(spark):
    assert found(spark, [(0, None), (11 * S, "home")]) == [(0, "timeout")]


def test_window_is_open_at_its_end(spark):
    assert found(spark, [(0, None), (10 * S, "home")]) == [(0, "timeout")]
    assert found(spark, [(0, None), (10 * S - 1, "home")]) == []


def test_ties_go_by_arrival(spark):
    assert found(spark, [(0, None), (0, "home")]) == []
    assert found(spark, [(0, "home"), (0, None)]) == [(1, "timeout")]


def test_three_entries_overlap(spark):
    expected = [(0, "match"), (1, "match"), (2, "timeout")]
    assert found(spark, [(0, None), (S, None), (2 * S, None)]) == expected


def test_other_visitors_do_not_interfere(spark):
    values = [line("a", START_MS, id=0), line("b", START_MS + S, last="home", id=1)]
    rows = bounces.bounces(logs.read_pages(frame(spark, values)))
    assert [row["kind"] for row in rows.collect()] == ["timeout"]
    assert bounces.matched(rows).count() == 0 and bounces.timed_out(rows).count() == 1


@pytest.mark.parametrize("hot_rows", [None, 15, 10_000])
@pytest.mark.parametrize("spread_ms", [50, 4_000_000])
def test_agrees_with_state(spark, hot_rows, spread_ms):
    """Also when one visitor is cut into chunks, and with many rows at one time."""
    rows = frame(spark, as_lines(random_visits(500, seed=3, spread_ms=spread_ms)))
    bodies = [json.loads(row["value"]) for row in arrival_order(rows.collect())]
    visits = [
        {"id": b["id"], "ts": b["ts"], "mid": b["common"]["mid"], "last": b["page"]["last_page_id"]}
        for b in bodies
    ]
    result = bounces.bounces(logs.read_pages(rows), hot_rows=hot_rows).collect()
    kinds = sorted((json.loads(row["value"])["id"], row["kind"]) for row in result)
    assert kinds == bounced_visits(visits, 10_000)


def test_one_key_one_time_is_still_cut(spark):
    """A key whose rows all share the leading order column is spread by the next one."""
    rows = spark.range(1000).selectExpr("'k' AS key", "0 AS ts", "id")
    result = with_neighbour(rows, "key", ("ts", "id"), {"next": "id"}, 1, hot_rows=50)
    pairs = {row["id"]: row["next"] for row in result.collect()}
    assert pairs == {i: i + 1 if i < 999 else None for i in range(1000)}


def exchanged(frame):
    """Columns of every exchange by keys in a plan; the tests' rows are dealt out by another."""
    text = frame._jdf.queryExecution().explainString(
        frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    parts = text.split("\n\n")
    return [part.split("Input [")[1].splitlines()[0] for part in parts if ") Exchange" in part.split("\n")[0] and "hashpartitioning" in part]


@pytest.mark.parametrize("hot_rows", [None, 10, 10_000])
def test_texts_stay_out_of_sorts_and_shuffles(spark, hot_rows):
    pages = logs.read_pages(frame(spark, as_lines(random_visits(200, seed=4))))
    entries = logs.entry_pages(pages)
    for found in (bounces.with_next_page(pages, hot_rows=hot_rows), visitors.first_entries(entries, hot_rows=hot_rows)):
        shuffled = exchanged(found)
        assert shuffled and not any("value#" in columns for columns in shuffled)
        # What is stored to find hot visitors is not made of lines again.
        assert ("Generate" in found._jdf.queryExecution().toString()) == (hot_rows is None)
    for found in (bounces.bounces(pages, hot_rows=hot_rows), visitors.unique_visitors(entries, hot_rows=hot_rows)):
        assert not any("value#" in columns for columns in exchanged(found))


def test_texts_of_a_large_result_come_by_a_shuffle(spark, monkeypatch):
    monkeypatch.setattr(scale, "BROADCAST_BYTES", -1)
    visits = as_lines(random_visits(200, seed=4))
    lines = frame(spark, visits)
    found = bounces.bounces(logs.read_pages(lines), lines=lines)
    assert any("value#" in columns for columns in exchanged(found))
    monkeypatch.undo()
    assert ids(found.collect()) == ids(bounces.bounces(logs.read_pages(lines)).collect())


def test_hot_keys_are_exact(spark):
    rows = spark.range(30_000).selectExpr("CASE WHEN id % 3 = 0 THEN 'a' WHEN id % 5 = 0 THEN 'b' WHEN id % 7 = 0 THEN NULL ELSE concat('k', id) END AS key")
    for bound, expected in ((9_999, {"a"}), (3_999, {"a", "b"}), (3, {"a", "b"}), (10_000, set()), (10**6, set())):
        found = {row["key"]: row["count"] for row in scale.hot_keys(rows, "key", bound).collect()}
        assert found == {key: {"a": 10_000, "b": 4_000}[key] for key in expected}
    every = spark.range(100).selectExpr("id % 50 AS key")
    monkey = scale._TRACKED
    try:
        scale._TRACKED = 1
        assert scale.hot_keys(every, "key", 1).count() == 50
    finally:
        scale._TRACKED = monkey
