import json

import pytest
from helpers import frame
from pyspark.sql import functions as F

from tidewater.contract import CART_COLUMNS
from tidewater.operators import carts, dims
from tidewater.sources.changes import decode_changes, decode_config

CART = {
    "is_ordered": "1", "cart_price": "123456.0", "create_time": "2023-02-22 01:14:14",
    "sku_num": "22", "sku_id": "1", "source_type": "1", "order_time": "2023-02-23 01:14:51",
    "user_id": "A", "img_url": "11112", "is_checked": "1", "sku_name": "DFD", "id": "1",
    "source_id": "1", "operate_time": "2023-02-23 00:00:00",
}


def change(type="insert", data=CART, old=None, table="cart_info", database="shop"):
    body = {"database": database, "table": table, "type": type, "data": data, "old": old}
    return json.dumps(body)


def cart(spark, *values, **options):
    changes = decode_changes(frame(spark, values))
    return [row.asDict() for row in carts.cart_adds(changes, "shop", **options).collect()]


def test_sample_rows(spark):
    """The insert is kept as it is; the update that leaves the quantity alone is dropped."""
    moved = change("update", {**CART, "sku_id": "2"}, {"sku_id": "1"})
    assert cart(spark, change(), moved) == [{name: CART[name] for name in CART_COLUMNS}]


def test_numbers_keep_their_text(spark):
    found = cart(spark, change(data={**CART, "cart_price": 123456.0, "sku_num": 22}))
    assert (found[0]["cart_price"], found[0]["sku_num"]) == ("123456.0", "22")


@pytest.mark.parametrize("scoped, expected", [(False, ["3", "3"]), (True, ["3"])])
def test_raised_quantity(spark, scoped, expected):
    """Unless scoped, updates of other tables pass too."""
    values = [
        change("update", CART, {"sku_num": "19"}),
        change("update", CART, {"sku_num": "19"}, table="order_detail", database="other"),
        change("update", CART, {"sku_num": "25"}),
        change("update", CART, {"sku_num": "many"}),
        change("bootstrap-insert"),
        change("insert", database="other"),
        change("delete"),
        "xx",
        "",
        change() + "x",
    ]
    assert [row["sku_num"] for row in cart(spark, *values, scoped=scoped)] == expected


def test_processing_time(spark):
    changes = decode_changes(frame(spark, [change()]), processing_time=True)
    assert carts.cart_adds(changes, "shop").columns == [*CART_COLUMNS, "pt"]


@pytest.mark.parametrize("max_rows", [0, 10])
def test_dictionary(spark, max_rows):
    names = spark.createDataFrame([("1", "search")], "dic_code string, dic_name string")
    values = [change(), change(data={**CART, "source_type": "9"}), change(data={"id": "2"})]
    added = carts.cart_adds(decode_changes(frame(spark, values)), "shop")
    named = carts.with_source_type_name(added, names, max_rows)
    assert named.columns == [*CART_COLUMNS, "source_type_name"]
    assert sorted(str(row["source_type_name"]) for row in named.collect()) == [
        "None", "None", "search",
    ]


def config_change(after, before=None):
    return json.dumps({"before": before, "after": after, "op": "r", "source": {"db": "c"}})


def route_row(source, sink="bb", columns="id,cc", pk="id", extend="xxx"):
    return {
        "source_table": source, "sink_table": sink, "sink_columns": columns, "sink_pk": pk,
        "sink_extend": extend,
    }


def test_config(spark):
    """The latest row of a table counts; one without an "after" removes it."""
    values = [
        config_change(route_row("aa")),
        config_change(route_row("gone")),
        config_change(route_row("aa", sink="new"), route_row("aa")),
        config_change(None, route_row("gone")),
        "xx",
    ]
    assert [row.asDict() for row in decode_config(frame(spark, values)).collect()] == [
        route_row("aa", sink="new")
    ]


@pytest.fixture
def config(spark):
    rows = [
        route_row("t", "dim_t", "id,name, blank", None, None),
        route_row("u", "dim_u", "code", "code", ""),
    ]
    return spark.createDataFrame(
        rows,
        "source_table string, sink_table string, sink_columns string, sink_pk string, "
        "sink_extend string",
    )


@pytest.mark.parametrize("max_rows", [0, 10])
def test_route(spark, config, max_rows):
    values = [
        change("update", {"id": 1, "name": "a'b", "blank": "x", "other": "y"}, table="t"),
        change("insert", {"code": "c"}, table="u", database="elsewhere"),
        change("insert", {"id": 1}, table="unknown"),
        change("delete", {"id": 1}, table="t"),
    ]
    changes = dims.dimension_changes(decode_changes(frame(spark, values)))
    routed = {row["table"]: row for row in dims.route(changes, config, max_rows=max_rows).collect()}
    assert set(routed) == {"t", "u"}
    assert routed["t"]["data"] == {"id": "1", "name": "a'b"}  # " blank" is another name
    assert (routed["t"]["sink_table"], routed["t"]["key"]) == ("dim_t", "1")
    trimmed = dims.route(changes, config, trim=True).where("sink_table = 'dim_t'").first()
    assert trimmed["data"] == {"id": "1", "name": "a'b", "blank": "x"}
    assert [r["table"] for r in dims.unrouted(changes, config, max_rows).collect()] == ["unknown"]
    assert dims.dimension_changes(decode_changes(frame(spark, values)), "shop").count() == 2


def test_latest_values(spark, config):
    values = [
        change("insert", {"id": "1", "name": "a"}, table="t"),
        change("update", {"id": "1", "name": None}, table="t"),
        change("update", {"id": "2", "name": "b"}, table="t"),
        change("update", {"id": "2"}, table="t"),
    ]
    routed = dims.route(decode_changes(frame(spark, values)), config)
    latest = dims.latest_values(dims.routed_values(routed))
    found = {(row["key"], row["column"]): row["value"] for row in latest.collect()}
    # A null is stored; a column left out keeps its value.
    assert found == {
        ("1", "id"): "1", ("1", "name"): None, ("2", "id"): "2", ("2", "name"): "b",
    }


def test_schema(spark, config):
    plan = dims.schema_plan(config).orderBy("sink_table", "position").collect()
    assert [tuple(row) for row in plan] == [
        ("dim_t", 1, "id", True), ("dim_t", 2, "name", False), ("dim_t", 3, " blank", False),
        ("dim_u", 1, "code", True),
    ]
    wrong = config.withColumn("sink_columns", F.lit("cc"))
    assert dims.schema_errors(config).count() == 0 and dims.schema_errors(wrong).count() == 2
