import json

import pytest
from helpers import START_MS, frame, line
from pyspark.errors import PySparkException
from pyspark.sql import Observation

from tidewater.contract import (
    ACTION_TOPIC, DAY_MS, DIRTY_TOPIC, DISPLAY_TOPIC, ERROR_TOPIC, LEAST_MS, MOST_MS,
    PAGE_TOPIC, START_TOPIC,
)
from tidewater.operators import logs, visitors


def facts(spark, *values, **options):
    parsed = logs.parse_logs(frame(spark, values))
    found = {}
    for row in logs.split_logs(parsed, **options).collect():
        found.setdefault(row["topic"], []).append(row["value"])
    return {
        topic: sorted(texts) if topic == DIRTY_TOPIC else [json.loads(text) for text in texts]
        for topic, texts in found.items()
    }


@pytest.mark.parametrize(
    "text",
    [
        "", "xx", "[1]", "5", "null", '{"a":1,', '{"common":{"mid":"m"},"ts":1} xx',
        '{"common":{"mid":"m"},"ts":1}{"a":1}', '{"common":{"mid":"m"},"ts":1}] junk',
        '{"common":{"mid":"m"},"ts":1}]', '{"common":{"mid":"m"},"ts":1}],[{}',
        '{"common":{"mid":"m"},"ts":1},{"_end":1}', '{"common":{"mid":"m"},"ts":9223372036854775807}',
        f'{{"common":{{"mid":"m"}},"ts":{MOST_MS + 1}}}', f'{{"common":{{"mid":"m"}},"ts":{LEAST_MS - 1}}}',
        '{"ts":1}', '{"common":{},"ts":1}',
        '{"common":{"mid":"m"}}', '{"common":{"mid":null},"ts":1}', '{"common":5,"ts":1}',
        '{"common":{"mid":"m"},"ts":"soon"}', "{'common':{'mid':'m'},'ts':1}",
    ],
)
def test_dirty(spark, text):
    assert facts(spark, text) == {DIRTY_TOPIC: [text]}
    assert [r["value"] for r in logs.dirty_lines(logs.parse_logs(frame(spark, [text]))).collect()] == [text]


def test_time_as_text_or_fraction(spark):
    values = ['{"common":{"mid":"m"},"ts":"12"}', '{"common":{"mid":7},"ts":1.5e3}']
    rows = logs.clean_logs(logs.parse_logs(frame(spark, values))).collect()
    assert sorted((row["mid"], row["ts"]) for row in rows) == [("7", 1500), ("m", 12)]


BODY = {
    "common": {"mid": "m", "is_new": "1", "extra": {"x": [1, None]}}, "ts": START_MS,
    "page": {"page_id": "p", "last_page_id": "q"}, "more": "{\"k\": 69}", "n": 5, "s": "5",
    "b": True, "weird \"key\"": "v\né",
}


def test_page_with_displays_and_actions(spark):
    body = {**BODY, "displays": [{"item": 1}, {"item": 2}], "actions": [{"action_id": "a"}]}
    found = facts(spark, json.dumps(body))
    assert found[PAGE_TOPIC] == [BODY]
    shared = {"common": BODY["common"], "page": BODY["page"]}
    assert found[DISPLAY_TOPIC] == [
        {"display": {"item": i}, **shared, "ts": START_MS} for i in (1, 2)
    ]
    assert found[ACTION_TOPIC] == [{"action": {"action_id": "a"}, **shared}]
    assert set(found) == {PAGE_TOPIC, DISPLAY_TOPIC, ACTION_TOPIC}


def test_error_goes_out_whole_and_goes_on(spark):
    body = {**BODY, "err": {"code": 1}, "displays": [{"item": 1}]}
    found = facts(spark, json.dumps(body))
    assert found[ERROR_TOPIC] == [body]
    assert found[PAGE_TOPIC] == [BODY]
    assert len(found[DISPLAY_TOPIC]) == 1


def test_start_excludes_page_facts(spark):
    body = {**BODY, "start": {"entry": "icon"}, "displays": [{"item": 1}], "err": {"code": 1}}
    found = facts(spark, json.dumps(body))
    assert set(found) == {START_TOPIC, ERROR_TOPIC}
    assert found[START_TOPIC] == [{k: v for k, v in body.items() if k != "err"}]


@pytest.mark.parametrize("empty", [[], None])
def test_nulls_and_empty_arrays_count_as_absent(spark, empty):
    body = {**BODY, "displays": empty, "actions": empty, "err": None, "start": None}
    found = facts(spark, json.dumps(body))
    assert set(found) == {PAGE_TOPIC}
    assert {k: v for k, v in found[PAGE_TOPIC][0].items() if v is not None} == BODY


def test_missing_page(spark):
    body = {k: v for k, v in BODY.items() if k != "page"} | {"displays": [{"item": 1}]}
    found = facts(spark, json.dumps(body))
    assert found[DISPLAY_TOPIC] == [
        {"display": {"item": 1}, "common": BODY["common"], "ts": START_MS}
    ]


def test_flat_shape(spark):
    body = {
        **BODY,
        "displays": [{"item": 1, "ts": 3, "page_id": "own"}],
        "actions": [{"action_id": "a", "ts": 4}],
    }
    found = facts(spark, json.dumps(body), shape="flat")
    display, action = found[DISPLAY_TOPIC][0], found[ACTION_TOPIC][0]
    assert json.loads(display.pop("common")) == BODY["common"]
    assert display == {"item": 1, "page_id": "p", "ts": START_MS}
    assert json.loads(action.pop("common")) == BODY["common"]
    assert action == {"action_id": "a", "page_id": "p", "ts": 4}  # the action's own time


def test_action_time_on_request(spark):
    body = {**BODY, "actions": [{"action_id": "a"}]}
    found = facts(spark, json.dumps(body), with_action_ts=True)
    assert found[ACTION_TOPIC][0]["ts"] == START_MS


def test_odd_values_stay_valid(spark):
    body = {**BODY, "page": "text", "displays": ["x", {"item": 1}], "actions": 5}
    found = facts(spark, json.dumps(body))
    assert [d["display"] for d in found[DISPLAY_TOPIC]] == ["x", {"item": 1}]
    assert found[PAGE_TOPIC][0]["page"] == "text"


def test_repeated_keys_lose_nothing(spark):
    text = '{"common":{"mid":"m","a":1,"a":2},"ts":1,"page":{"page_id":"p"},"n":5,"actions":[{}]}'
    page = facts(spark, text)[PAGE_TOPIC][0]
    assert page["common"]["mid"] == "m" and str(page["n"]) == "5" and str(page["ts"]) == "1"


def test_untouched_lines_pass_to_the_letter(spark):
    text = '{"common": {"mid":"m"},  "ts":1, "page":{"price":123456.0}}'
    parsed = logs.parse_logs(frame(spark, [text]))
    assert [row["value"] for row in logs.split_logs(parsed).collect()] == [text]


def test_repaired_line_changes_only_the_flag(spark):
    second = {**BODY, "ts": START_MS + DAY_MS, "err": {"code": 1}}
    parsed = logs.parse_logs(frame(spark, [json.dumps(BODY), json.dumps(second)]))
    rows = logs.split_logs(visitors.repair_new_flag(parsed), topics=(ERROR_TOPIC,)).collect()
    second["common"] = {**second["common"], "is_new": "0"}
    assert [json.loads(row["value"]) for row in rows] == [second]


def test_read_pages_drops_and_counts(spark):
    values = [line(), line(page=None), "xx", line(mid=None), line(last="q")]
    dropped = Observation()
    pages = logs.read_pages(frame(spark, values), observation=dropped)
    assert sorted(row["is_entry"] for row in pages.collect()) == [False, True]
    assert dropped.get["dropped"] == 3
    with pytest.raises(PySparkException, match="not a page log"):
        logs.read_pages(frame(spark, values), on_error="fail").collect()
    with pytest.raises(ValueError):
        logs.read_pages(frame(spark, values), on_error="ignore")


def test_lines_are_parsed_once(spark):
    """A filter on parsed fields must not reach below the parser."""
    rows = logs.clean_logs(logs.parse_logs(frame(spark, [line()])))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(ArrayType") == 1


@pytest.mark.parametrize("ts", [LEAST_MS, MOST_MS, 0, -1])
def test_extreme_times_pass_every_step(spark, ts):
    rows = visitors.repair_new_flag(logs.parse_logs(frame(spark, [line(ts=ts), line(ts=ts, is_new="0")])))
    assert [row["ts"] for row in logs.clean_logs(rows).collect()] == [ts, ts]
    pages = logs.read_pages(frame(spark, [line(ts=ts)]))
    assert visitors.unique_visitors(logs.entry_pages(pages)).count() == 1


def test_displays_that_are_no_array_go(spark):
    found = facts(spark, json.dumps({**BODY, "displays": {"item": 1}, "actions": "x"}))
    assert found == {PAGE_TOPIC: [BODY]}
