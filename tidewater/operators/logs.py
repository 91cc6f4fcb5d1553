"""Log lines: parsing, and splitting each line into facts by topic."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, functions as F

from tidewater.contract import (
    ACTION_TOPIC,
    DIRTY_TOPIC,
    DISPLAY_TOPIC,
    ERROR_TOPIC,
    PAGE_TOPIC,
    START_TOPIC,
)
from tidewater.functions.json_rows import (
    JSON_OPTIONS,
    is_object,
    long_of,
    member,
    object_of,
    other_members,
    quoted,
    with_object,
)
from tidewater.functions.times import in_range, to_day

# columns parse_logs adds besides mid, is_new and ts
LINE_PARTS = ("common", "page", "err", "start", "displays", "actions")

LOG_TOPICS = (ERROR_TOPIC, START_TOPIC, PAGE_TOPIC, DISPLAY_TOPIC, ACTION_TOPIC, DIRTY_TOPIC)


# Nested values stay text; see functions.json_rows.
LINE_FIELDS = (
    "common string, page string, ts string, err string, start string, "
    "displays string, actions string"
)
VISITOR_FIELDS = "mid string, is_new string"
VISIT_FIELDS = "common struct<mid:string,is_new:string>, ts string"
PAGE_FIELDS = "common struct<mid:string>, page struct<last_page_id:string>, ts string"


def parse_logs(lines: DataFrame) -> DataFrame:
    """Add ``mid, is_new, ts`` and the fields a split needs to text lines.

    A line is dirty when it is not a JSON object, or has no visitor or no time that can be
    dated; then ``mid`` or ``ts`` is NULL. No line is removed.
    """
    visitor = F.from_json("row.common", VISITOR_FIELDS)
    return (
        with_object(lines, LINE_FIELDS)
        .withColumn("visitor", visitor)
        .select(
            *lines.columns,
            "visitor.mid",
            "visitor.is_new",
            in_range(long_of(F.col("row.ts"))).alias("ts"),
            *[F.col(f"row.{name}") for name in LINE_PARTS],
        )
    )


def parse_visits(lines: DataFrame) -> DataFrame:
    """Like ``parse_logs``, but only ``mid, is_new, ts``: for passes that need no more."""
    row = F.col("row")
    return with_object(lines, VISIT_FIELDS).select(
        *lines.columns,
        row["common"]["mid"].alias("mid"),
        row["common"]["is_new"].alias("is_new"),
        in_range(long_of(row["ts"])).alias("ts"),
    )


def is_clean() -> Column:
    return F.col("mid").isNotNull() & F.col("ts").isNotNull()


def clean_logs(parsed: DataFrame) -> DataFrame:
    return parsed.where(is_clean())


def dirty_lines(parsed: DataFrame) -> DataFrame:
    return parsed.where(~is_clean()).select("value")


def split_logs(
    parsed: DataFrame,
    shape: str = "nested",
    topics: Sequence[str] = LOG_TOPICS,
    with_action_ts: bool = False,
    keep: Sequence[str] = (),
    numbered: bool = False,
) -> DataFrame:
    """Rows of ``(topic, value)``, the facts each parsed line gives rise to.

    ``numbered`` adds ``nth``, the fact's place among those of its line.

    An error line goes out whole, then goes on without its error as either a start
    fact or a page fact with one fact per display and per action. ``shape`` is
    "nested" (display, common and page as objects) or "flat" (the display's own
    fields, common as text, page_id). Actions carry no time unless asked for.
    ``displays`` or ``actions`` that are no array give no facts, and go from the page fact.
    Every line is read once, whatever number of ``topics`` is wanted.
    """
    if shape not in ("nested", "flat"):
        raise ValueError(f"unknown shape {shape!r}")
    item_text = _nested_item if shape == "nested" else _flat_item
    repaired = F.col("repaired") if "repaired" in parsed.columns else F.lit(False)
    none = F.array().cast("array<struct<topic:string,value:string>>")

    def fact(topic: str, text: Column) -> Column:
        return F.struct(F.lit(topic).alias("topic"), text.alias("value"))

    def one(topic: str, text: Column) -> Column:
        return F.array(fact(topic, text)) if topic in topics else none

    def each(topic: str, kind: str, with_ts: bool) -> Column:
        if topic not in topics:
            return none
        text = F.col(f"{kind}s")
        listed = F.from_json(F.when(text.startswith("["), text), "array<string>", JSON_OPTIONS)
        items = F.transform(listed, lambda item: fact(topic, item_text(kind, item, with_ts)))
        return F.coalesce(items, none)

    def line_without(*names: str) -> Column:
        """The line as it came, if nothing in it changes; otherwise put together anew."""
        has_none = [F.col(name).isNull() for name in names]
        unchanged = functools.reduce(Column.__and__, has_none, ~repaired)
        return F.when(unchanged, F.col("value")).otherwise(_rebuilt(names))

    start_facts = one(START_TOPIC, line_without("err"))
    page_facts = F.concat(
        one(PAGE_TOPIC, line_without("err", "displays", "actions")),
        each(DISPLAY_TOPIC, "display", True),
        each(ACTION_TOPIC, "action", with_action_ts),
    )
    facts = F.when(
        is_clean(),
        F.concat(
            F.when(F.col("err").isNotNull(), one(ERROR_TOPIC, line_without())).otherwise(none),
            F.when(F.col("start").isNotNull(), start_facts).otherwise(page_facts),
        ),
    ).otherwise(one(DIRTY_TOPIC, F.col("value")))
    # A column first, as generators are not compiled; and the outer form, as the inner
    # one would evaluate the facts once more to drop lines without any.
    exploded = parsed.withColumn("_facts", facts).select(
        *keep, F.posexplode_outer("_facts").alias("nth", "_fact")
    )
    columns = [*keep, "_fact.topic", "_fact.value", *["nth"] * numbered]
    return exploded.select(*columns).where(F.col("topic").isNotNull())


def _page() -> Column:
    return F.when(is_object(F.col("page")), F.col("page"))


def _rebuilt(names: Sequence[str]) -> Column:
    """The line with the repaired common part and without some fields."""
    copied = F.when(_page().isNotNull(), F.array(F.lit("common"), F.lit("page"))).otherwise(
        F.array(F.lit("common"))
    )
    left_out = F.concat(copied, F.array(*[F.lit(name) for name in names]).cast("array<string>"))
    return object_of(
        member("common", F.col("common")),
        member("page", _page()),
        other_members(F.col("value"), left_out),
    )


def _nested_item(kind: str, item: Column, with_ts: bool) -> Column:
    return object_of(
        member(kind, F.when(is_object(item), item).otherwise(quoted(item))),
        member("common", F.col("common")),
        member("page", _page()),
        *[member("ts", F.col("ts").cast("string"))] * with_ts,
    )


def _flat_item(kind: str, item: Column, with_ts: bool) -> Column:
    added = {
        "common": quoted(F.col("common")),
        "page_id": quoted(F.get_json_object("page", "$.page_id")),
    }
    if with_ts:
        added["ts"] = F.col("ts").cast("string")
    own = F.when(is_object(item), item)
    replaced = F.array(*[F.lit(name) for name in added])
    return object_of(
        other_members(own, replaced), *[member(name, text) for name, text in added.items()]
    )


def flagged_pages(lines: DataFrame, on_error: str = "drop") -> DataFrame:
    """Like ``read_pages``, with the lines it drops, and ``_good``: whether it keeps a line."""
    row = F.col("row")
    good = row["common"]["mid"].isNotNull() & F.col("ts").isNotNull() & row["page"].isNotNull()
    rows = (
        with_object(lines, PAGE_FIELDS)
        .withColumn("ts", in_range(long_of(row["ts"])))
        .select(
            *lines.columns,
            row["common"]["mid"].alias("mid"),
            "ts",
            to_day("ts").alias("dt"),
            row["page"]["last_page_id"].isNull().alias("is_entry"),
            F.coalesce(good, F.lit(False)).alias("_good"),
        )
    )
    if on_error == "fail":
        message = F.concat(F.lit("not a page log: "), F.coalesce("value", F.lit("null")))
        rows = rows.withColumn("_good", F.when(F.col("_good"), True).otherwise(F.raise_error(message)))
    elif on_error != "drop":
        raise ValueError(f"unknown on_error {on_error!r}")
    return rows


def good_pages(flagged: DataFrame) -> DataFrame:
    return flagged.where("_good").drop("_good")


def read_pages(
    lines: DataFrame,
    on_error: str = "drop",
    observation: Observation | None = None,
) -> DataFrame:
    """Add ``mid, ts, dt, is_entry`` to page-log lines.

    Lines without a page, visitor or time are dropped, or fail the job with
    ``on_error="fail"``. ``observation`` reports how many there were as "dropped".
    An entry is a page that was not reached from another page.
    """
    rows = flagged_pages(lines, on_error)
    if observation is not None:
        rows = rows.observe(observation, F.count_if(~F.col("_good")).alias("dropped"))
    return good_pages(rows)


def entry_pages(pages: DataFrame) -> DataFrame:
    return pages.where("is_entry").drop("is_entry")
