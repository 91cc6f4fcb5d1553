"""The registered batch queries: ``name -> (spark, folder) -> DataFrame``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewater.contract import (
    ACTION_TOPIC,
    ARRIVAL,
    DIRTY_TOPIC,
    DISPLAY_TOPIC,
    ERROR_TOPIC,
    PAGE_TOPIC,
    START_TOPIC,
)
from tidewater.functions.times import to_date_text, to_epoch_ms, to_second_text
from tidewater.operators import bounces, carts, dims, logs, visitors
from tidewater.plans import inputs
from tidewater.plans.inputs import DATABASE, OFFSET
from tidewater.sources.changes import config_changes, decode_changes, decode_config

# The test events are hours apart, so bounces are sought within hours too.
WITHIN_MS = 6 * 3_600_000

ROW_SCHEMA = (
    "event_id bigint, common struct<mid:string,is_new:string>, ts bigint, "
    "page struct<page_id:string,last_page_id:string>, err struct<code:bigint>, "
    "display struct<item:bigint,pos:bigint>, action struct<action_id:string,item:bigint>, "
    "extra string"
)
FLAT_SCHEMA = "common string, page_id string, ts bigint, item bigint, pos bigint, action_id string"


def _fields(value: DataFrame, **columns: str) -> DataFrame:
    """Fields of the JSON text a query's operator wrote."""
    parsed = value.select("*", F.from_json("value", ROW_SCHEMA).alias("row"))
    return parsed.select(*[F.col(path).alias(name) for name, path in columns.items()])


def src_text_lines(spark: SparkSession, folder: str) -> DataFrame:
    lines = inputs.log_lines(spark, folder)
    return logs.parse_logs(lines).select(
        F.when(logs.is_clean(), event_id()).alias("event_id"),
        (F.col("value") == "").alias("is_empty"),
    )


def log_parse(spark: SparkSession, folder: str) -> DataFrame:
    clean = logs.clean_logs(logs.parse_logs(inputs.log_lines(spark, folder)))
    return _fields(
        clean.select("value", "mid", "is_new", "ts"),
        event_id="row.event_id", mid="mid", is_new="is_new", ts="ts",
        page_id="row.page.page_id", last_page_id="row.page.last_page_id", extra="row.extra",
    )


def log_dirty(spark: SparkSession, folder: str) -> DataFrame:
    return logs.dirty_lines(logs.parse_logs(inputs.log_lines(spark, folder)))


def _repaired(spark: SparkSession, folder: str) -> DataFrame:
    lines = inputs.log_lines(spark, folder)
    return visitors.repair_new_flag(logs.parse_logs(lines), OFFSET, lines=lines)


def visitor_flag_repair(spark: SparkSession, folder: str) -> DataFrame:
    clean = logs.clean_logs(_repaired(spark, folder))
    return clean.select(
        event_id(), "mid", "ts", F.get_json_object("common", "$.is_new").alias("is_new")
    )


def visitor_flag_repair_arrival(spark: SparkSession, folder: str) -> DataFrame:
    """The same in the order of topics: time of arrival, partition, offset."""
    offset = F.col("offset").cast("bigint")
    lines = inputs.log_lines(spark, folder).select(
        "value",
        F.timestamp_millis(F.floor(offset / 100)).alias("timestamp"),
        (F.floor(offset / 10) % 10).cast("int").alias("partition"),
        offset.alias("offset"),
    )
    clean = logs.clean_logs(visitors.repair_new_flag(logs.parse_logs(lines), ARRIVAL, lines=lines))
    return clean.select(
        event_id(), "mid", "ts", F.get_json_object("common", "$.is_new").alias("is_new")
    )


def _facts(spark: SparkSession, folder: str, topic: str, shape: str = "nested") -> DataFrame:
    return logs.split_logs(_repaired(spark, folder), shape, topics=(topic,))


_COMMON = {"mid": "row.common.mid", "is_new": "row.common.is_new"}


def log_split_error(spark: SparkSession, folder: str) -> DataFrame:
    return _fields(
        _facts(spark, folder, ERROR_TOPIC),
        event_id="row.event_id", **_COMMON, ts="row.ts", err_code="row.err.code",
    )


def log_split_start(spark: SparkSession, folder: str) -> DataFrame:
    return _fields(
        _facts(spark, folder, START_TOPIC), event_id="row.event_id", **_COMMON, ts="row.ts"
    )


def log_split_page(spark: SparkSession, folder: str) -> DataFrame:
    return _fields(
        _facts(spark, folder, PAGE_TOPIC),
        event_id="row.event_id", **_COMMON, ts="row.ts", page_id="row.page.page_id",
        last_page_id="row.page.last_page_id", extra="row.extra",
    )


def log_split_display(spark: SparkSession, folder: str) -> DataFrame:
    return _fields(
        _facts(spark, folder, DISPLAY_TOPIC),
        **_COMMON, page_id="row.page.page_id", item="row.display.item",
        pos="row.display.pos", ts="row.ts",
    )


def log_split_action(spark: SparkSession, folder: str) -> DataFrame:
    return _fields(
        _facts(spark, folder, ACTION_TOPIC),
        **_COMMON, page_id="row.page.page_id", item="row.action.item",
        action_id="row.action.action_id",
    )


def _flat_fields(facts: DataFrame, *columns: str) -> DataFrame:
    parsed = facts.select(F.from_json("value", FLAT_SCHEMA).alias("row"))
    common = F.from_json("row.common", "mid string, is_new string")
    return parsed.select(
        common["mid"].alias("mid"), common["is_new"].alias("is_new"),
        *[F.col(f"row.{name}") for name in columns],
    )


def log_split_display_flat(spark: SparkSession, folder: str) -> DataFrame:
    facts = _facts(spark, folder, DISPLAY_TOPIC, "flat")
    return _flat_fields(facts, "page_id", "item", "pos", "ts")


def log_split_action_flat(spark: SparkSession, folder: str) -> DataFrame:
    facts = _facts(spark, folder, ACTION_TOPIC, "flat")
    return _flat_fields(facts, "page_id", "item", "action_id")


def all_facts(facts: DataFrame) -> DataFrame:
    """One row per fact of any topic; dirty lines have no fields."""
    return _fields(
        facts.withColumn("value", F.when(F.col("topic") != DIRTY_TOPIC, F.col("value"))),
        topic="topic", mid="row.common.mid", page_id="row.page.page_id", ts="row.ts",
    )


def log_split_all(spark: SparkSession, folder: str) -> DataFrame:
    return all_facts(logs.split_logs(_repaired(spark, folder)))


def _page_lines(spark: SparkSession, folder: str) -> DataFrame:
    return inputs.log_lines(spark, folder, as_pages=True)


def _pages(spark: SparkSession, folder: str) -> DataFrame:
    return logs.read_pages(_page_lines(spark, folder))


def event_id() -> Column:
    return F.from_json("value", "event_id bigint")["event_id"].alias("event_id")


def uv_entry_pages(spark: SparkSession, folder: str) -> DataFrame:
    entries = logs.entry_pages(_pages(spark, folder))
    return entries.select(event_id(), "mid", F.col("dt").cast("string"))


def unique_visitor_detail(spark: SparkSession, folder: str) -> DataFrame:
    entries = logs.entry_pages(_pages(spark, folder))
    found = visitors.unique_visitors(entries, OFFSET, lines=_page_lines(spark, folder))
    return found.select(event_id(), "mid", F.col("dt").cast("string"))


def unique_visitor_per_day(spark: SparkSession, folder: str) -> DataFrame:
    entries = logs.entry_pages(_pages(spark, folder))
    found = visitors.unique_visitors_per_day(entries, OFFSET)
    return found.select("mid", F.col("dt").cast("string"))


def _bounces(spark: SparkSession, folder: str) -> DataFrame:
    lines = _page_lines(spark, folder)
    return bounces.bounces(logs.read_pages(lines), WITHIN_MS, OFFSET, lines=lines)


def user_jump_match(spark: SparkSession, folder: str) -> DataFrame:
    return bounces.matched(_bounces(spark, folder)).select(event_id(), "mid", "ts")


def user_jump_timeout(spark: SparkSession, folder: str) -> DataFrame:
    return bounces.timed_out(_bounces(spark, folder)).select(event_id(), "mid", "ts")


def user_jump_detail(spark: SparkSession, folder: str) -> DataFrame:
    return _bounces(spark, folder).select(event_id(), "mid", "ts")


def _cart_changes(spark: SparkSession, folder: str) -> DataFrame:
    return decode_changes(inputs.cart_change_lines(spark, folder))


def cdc_decode(spark: SparkSession, folder: str) -> DataFrame:
    return _cart_changes(spark, folder).select(
        "database", "table", "type",
        F.col("data")["id"].alias("id"),
        F.col("data")["sku_num"].alias("sku_num"),
        F.col("old")["sku_num"].alias("old_sku_num"),
    )


def cart_add(spark: SparkSession, folder: str) -> DataFrame:
    return carts.cart_adds(_cart_changes(spark, folder), DATABASE)


def cart_add_scoped(spark: SparkSession, folder: str) -> DataFrame:
    return carts.cart_adds(_cart_changes(spark, folder), DATABASE, scoped=True)


def cart_add_enriched(spark: SparkSession, folder: str) -> DataFrame:
    return carts.with_source_type_name(cart_add(spark, folder), inputs.dictionary(spark))


def _dimension_changes(spark: SparkSession, folder: str) -> DataFrame:
    return dims.dimension_changes(decode_changes(inputs.dimension_change_lines(spark, folder)))


def _any_key() -> Column:
    names = ("c_custkey", "s_suppkey", "p_partkey", "n_nationkey")
    return F.coalesce(*[F.col("data")[name] for name in names]).alias("key")


def dim_change_filter(spark: SparkSession, folder: str) -> DataFrame:
    return _dimension_changes(spark, folder).select("table", "type", _any_key())


def dim_config_decode(spark: SparkSession, folder: str) -> DataFrame:
    return decode_config(inputs.config_change_lines(spark, folder), OFFSET)


def dim_schema_plan(spark: SparkSession, folder: str) -> DataFrame:
    return dims.schema_plan(dim_config_decode(spark, folder))


def _routed(spark: SparkSession, folder: str) -> DataFrame:
    return dims.route(_dimension_changes(spark, folder), inputs.routing_config(spark))


def dim_route(spark: SparkSession, folder: str) -> DataFrame:
    return dims.routed_values(_routed(spark, folder), (), keep=("table",))


def dim_unrouted(spark: SparkSession, folder: str) -> DataFrame:
    changes = _dimension_changes(spark, folder)
    return dims.unrouted(changes, inputs.routing_config(spark)).select("table", _any_key())


def dim_upsert_latest(spark: SparkSession, folder: str) -> DataFrame:
    values = dims.routed_values(_routed(spark, folder), OFFSET)
    return dims.latest_values(values, OFFSET).select("sink_table", "key", "column", "value")


def dim_route_asof(spark: SparkSession, folder: str) -> DataFrame:
    """Each row by the route that was in force when it came; the routes change all the time."""
    changes = config_changes(inputs.route_log_lines(spark, folder), OFFSET)
    versions = dims.route_versions(changes, OFFSET)
    routed = dims.route_as_of(_dimension_changes(spark, folder), versions, OFFSET[0])
    return dims.routed_values(routed, OFFSET, keep=("table",)).select(
        "table", "sink_table", "key", "column", "value", F.col("offset").alias("arrival")
    )


def dim_unrouted_asof(spark: SparkSession, folder: str) -> DataFrame:
    changes = config_changes(inputs.route_log_lines(spark, folder), OFFSET)
    versions = dims.route_versions(changes, OFFSET)
    rest = dims.unrouted_as_of(_dimension_changes(spark, folder), versions, OFFSET[0])
    return rest.select("table", _any_key(), F.col("offset").alias("arrival"))


def _event_times(spark: SparkSession, folder: str) -> DataFrame:
    events = inputs.table(spark, folder, "events")
    return events.select("event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"))


def fn_to_date(spark: SparkSession, folder: str) -> DataFrame:
    return _event_times(spark, folder).select("event_id", to_date_text("ms").alias("day"))


def fn_to_ymd_hms(spark: SparkSession, folder: str) -> DataFrame:
    return _event_times(spark, folder).select("event_id", to_second_text("ms").alias("second"))


def fn_to_ts(spark: SparkSession, folder: str) -> DataFrame:
    orders = inputs.table(spark, folder, "orders")
    moment = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    return orders.select(
        "o_orderkey",
        to_epoch_ms(F.substring(moment, 1, 10)).alias("day_ms"),
        to_epoch_ms(moment, full=True).alias("full_ms"),
    )


BATCH = (
    src_text_lines, log_parse, log_dirty, visitor_flag_repair, visitor_flag_repair_arrival,
    log_split_error, log_split_start, log_split_page, log_split_display, log_split_action,
    log_split_display_flat, log_split_action_flat, log_split_all,
    uv_entry_pages, unique_visitor_detail, unique_visitor_per_day,
    user_jump_match, user_jump_timeout, user_jump_detail,
    cdc_decode, cart_add, cart_add_scoped, cart_add_enriched,
    dim_change_filter, dim_config_decode, dim_schema_plan, dim_route, dim_unrouted,
    dim_route_asof, dim_unrouted_asof, dim_upsert_latest, fn_to_date, fn_to_ymd_hms, fn_to_ts,
)
