"""Log lines, change lines and config lines made from the star-schema tables.

Every field is plain arithmetic on table columns, so the expected result of each
operator can be computed from the columns without parsing any text. Dates and
times are meant in UTC.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewater.contract import LEAST_MS, MOST_MS

# Arrival of the lines below: the offset within a one-partition topic.
OFFSET = ("offset",)
DATABASE = "shop"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


# Rows that one task makes text of: some 100 MB of lines, whatever the size of the table.
ROWS_A_TASK = 250_000


def spread(rows: DataFrame, *keys: str, least: int | None = None, rows_a_task: int = ROWS_A_TASK) -> DataFrame:
    """Rows of a table dealt out by their keys: over all cores, and to more tasks the more there are.

    Making and parsing text is costly next to reading. The splits of a file say nothing of its
    rows: a row group is in one of them, however many rows it has, and neighbours are in the
    same one, so that a slice of a topic would come from a few tasks. ``least`` is for tables
    that are small by nature: in one task they stay as they are.
    """
    if least is None:
        least = rows.sparkSession.sparkContext.defaultParallelism
    tasks = max(least, -(-rows.count() // rows_a_task))
    return rows.repartition(tasks, *keys) if tasks > 1 else rows


def _event_ms() -> Column:
    return F.unix_millis(F.col("ts").cast("timestamp"))


def log_lines(
    spark: SparkSession, folder: str, as_pages: bool = False, in_time_order: bool = False
) -> DataFrame:
    """``value, offset`` from ``events``.

    Lines arrive out of time order by up to 1800 events unless ``in_time_order``.
    Every 50th line is dirty: cut, empty, no object, with something behind the object, or
    of a time without a date. With ``as_pages`` every line has a page and none a
    start, as in a page log.
    """
    event = F.col("event_id")
    kind = F.col("event_type")
    entry = kind.isin("view", "error") | (event % 2 == 0)
    page = F.struct(kind.alias("page_id"), F.when(~entry, "home").alias("last_page_id"))
    signup = (kind == "signup") & (not as_pages)
    items = F.transform(
        F.sequence(F.lit(1), (event % 4).cast("int"), F.lit(1)),
        lambda i: F.struct(i.alias("item"), i.alias("pos")),
    )
    acts = F.transform(
        F.sequence(F.lit(1), (event % 3).cast("int"), F.lit(1)),
        lambda i: F.struct(kind.alias("action_id"), i.alias("item")),
    )
    fields = F.struct(
        event,
        F.struct(
            F.col("user_id").cast("string").alias("mid"),
            F.when(event % 3 == 0, "0").otherwise("1").alias("is_new"),
        ).alias("common"),
        _event_ms().alias("ts"),
        F.when(~signup, page).alias("page"),
        F.when(kind == "error", F.struct((event % 5).alias("code"))).alias("err"),
        F.when(signup, F.struct(F.lit("icon").alias("entry"))).alias("start"),
        # No displays: an empty array on some lines, no field on others.
        F.when(event % 4 != 0, items)
        .when(event % 8 == 0, F.array().cast("array<struct<item:int,pos:int>>"))
        .alias("displays"),
        F.when(event % 3 != 0, acts).alias("actions"),
        F.col("props").alias("extra"),
    )
    # Absent fields: left out on some lines, JSON null on others.
    clean = F.when(event % 5 == 1, F.to_json(fields, {"ignoreNullFields": "false"})).otherwise(
        F.to_json(fields)
    )
    # No array: some of the lines without displays have an object there.
    no_array = F.concat(F.lit('{"displays":{"item":1},'), F.substring(clean, F.lit(2), F.length(clean)))
    clean = F.when((event % 8 == 4) & (event % 5 != 1), no_array).otherwise(clean)
    cut = F.concat(F.lit('{"event_id":'), event.cast("string"), F.lit(',"common":{'))
    whole = F.concat(cut, F.lit('"mid":"m"},"page":{},"ts":'))
    times = ["9223372036854775807", "-9223372036854775808", str(MOST_MS + 1), str(LEAST_MS - 1)]
    tails = ["1}] junk", "1}]", "1}],[{}", *[f"{time}}}" for time in times]]
    forms = [cut, F.lit(None), F.lit("[1]"), *[F.concat(whole, F.lit(tail)) for tail in tails]]
    dirty = F.element_at(F.array(*forms), (F.floor(event / 50) % len(forms) + 1).cast("int"))
    offset = event if in_time_order else (event + 300 * (event % 7)) * 7 + 6 - event % 7
    records = spread(table(spark, folder, "events"), "event_id").select(
        F.when(event % 50 == 0, dirty).otherwise(clean).alias("value"), offset.alias("offset")
    )
    return records.withColumn("value", F.coalesce("value", F.lit("")))


def cart_change_lines(spark: SparkSession, folder: str) -> DataFrame:
    """``value, offset`` from ``lineitem``: changes of cart and order rows."""
    order, line, part = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey")
    quantity = F.col("l_quantity").cast("int")
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    old_quantity = F.when(part % 3 != 0, quantity + line - 4)
    fields = F.struct(
        F.when(order % 10 == 0, "other").otherwise(DATABASE).alias("database"),
        F.when(line % 2 == 1, "cart_info").otherwise("order_detail").alias("table"),
        F.when(F.col("l_returnflag") == "N", "insert")
        .when(F.col("l_returnflag") == "R", "bootstrap-insert")
        .otherwise("update")
        .alias("type"),
        F.struct(
            F.concat_ws("-", order, line).alias("id"),
            F.col("l_suppkey").cast("string").alias("user_id"),
            part.alias("sku_id"),
            cents.cast("string").alias("cart_price"),
            quantity.alias("sku_num"),
            F.lit("thing").alias("sku_name"),
            F.lit("1").alias("is_checked"),
            F.lit("2023-02-22 01:14:14").alias("create_time"),
            F.lit("0").alias("is_ordered"),
            F.concat(F.lit("24"), (line % 4).cast("string")).alias("source_type"),
            F.lit("1").alias("source_id"),
            F.lit("x.png").alias("img_url"),
        ).alias("data"),
        F.when(
            F.col("l_returnflag") == "A",
            F.struct(
                old_quantity.alias("sku_num"), F.when(old_quantity.isNull(), part).alias("sku_id")
            ),
        ).alias("old"),
    )
    items = spread(table(spark, folder, "lineitem"), "l_orderkey", "l_linenumber")
    return items.select(
        F.to_json(fields).alias("value"), order.alias("offset")
    )


def dictionary(spark: SparkSession) -> DataFrame:
    """Names of source types 240 to 242; 243 is not there, 999 is not used."""
    rows = [("240", "search"), ("241", "advert"), ("242", "friend"), ("999", "unused")]
    return spark.createDataFrame(rows, "dic_code string, dic_name string")


# table, key column, columns sent with the first version of a row
_DIMENSIONS = (
    ("customer", "c_custkey", ("c_custkey", "c_name", "c_mktsegment", "c_nationkey")),
    ("supplier", "s_suppkey", ("s_suppkey", "s_name", "s_nationkey")),
    ("part", "p_partkey", ("p_partkey", "p_name", "p_brand", "p_size")),
    ("nation", "n_nationkey", ("n_nationkey", "n_name")),
)


def dimension_change_lines(spark: SparkSession, folder: str) -> DataFrame:
    """``value, offset`` from four tables; every third row has a second version.

    The second version carries a new name only, besides the key.
    """
    lines = None
    for name, key, columns in _DIMENSIONS:
        number = F.col(key).cast("bigint")
        title = columns[1]
        kind = (
            F.when(number % 5 == 0, "delete")
            .when(number % 5 == 1, "update")
            .when(number % 5 == 2, "bootstrap-insert")
            .otherwise("insert")
        )
        versions = F.when(number % 3 == 0, F.array(F.lit(1), F.lit(2))).otherwise(
            F.array(F.lit(1))
        )
        first = F.col("version") == 1
        data = F.struct(
            F.col(key),
            F.when(first, F.col(title)).otherwise(F.concat(title, F.lit("-v2"))).alias(title),
            *[F.when(first, F.col(other)).alias(other) for other in columns if other not in (key, title)],
        )
        fields = F.struct(
            F.lit(DATABASE).alias("database"),
            F.lit(name).alias("table"),
            kind.alias("type"),
            data.alias("data"),
        )
        part = (
            spread(table(spark, folder, name), key, least=1)
            .select(*columns, F.explode(versions).alias("version"))
            .select(F.to_json(fields).alias("value"), (number * 2 + F.col("version")).alias("offset"))
        )
        lines = part if lines is None else lines.unionByName(part)
    return lines


def routing_config(spark: SparkSession) -> DataFrame:
    """Routes of three of the four tables. The blank before p_name is meant."""
    rows = [
        ("customer", "dim_customer", "c_custkey,c_name,c_mktsegment", "c_custkey", None),
        ("supplier", "dim_supplier", "s_suppkey,s_name", "s_suppkey", "buckets=4"),
        ("part", "dim_part", "p_partkey, p_name", "p_partkey", None),
    ]
    return spark.createDataFrame(
        rows,
        "source_table string, sink_table string, sink_columns string, "
        "sink_pk string, sink_extend string",
    )


def config_change_lines(spark: SparkSession, folder: str) -> DataFrame:
    """``value, offset`` from ``part``: changes of a config with a route per source.

    A third as many sources as parts; each has about three changes, and every
    eleventh change removes the route.
    """
    number = F.col("p_partkey")
    source = F.concat(F.lit("src_"), F.floor(number / 3).cast("string"))
    columns = F.concat(F.lit("id,"), F.lower("p_type"), F.lit(",size_"), F.col("p_size").cast("string"))
    row = F.struct(
        source.alias("source_table"),
        F.concat(F.lit("dim_"), source).alias("sink_table"),
        columns.alias("sink_columns"),
        F.when(number % 4 == 0, "").when(number % 4 == 1, F.lower("p_type")).alias("sink_pk"),
        F.when(number % 2 == 0, "buckets=4").alias("sink_extend"),
    )
    removed = number % 11 == 0
    fields = F.struct(
        F.when(removed, F.struct(source.alias("source_table"))).alias("before"),
        F.when(~removed, row).alias("after"),
        F.when(removed, "d").otherwise("u").alias("op"),
    )
    return table(spark, folder, "part").select(
        F.to_json(fields, {"ignoreNullFields": "false"}).alias("value"), number.alias("offset")
    )


# Every so many offsets of the change rows, the routes below change.
ROUTE_STEP = 20


def route_log_lines(spark: SparkSession, folder: str) -> DataFrame:
    """``value, offset`` from ``nation``: changes of the routes of three source tables.

    Version k comes at offset ``ROUTE_STEP`` * k. Odd ones lead to another table and list the
    key only; every fifth, from the fourth on, takes the routes away.
    """
    number = F.col("n_nationkey").cast("bigint")
    sources = F.array(
        *[
            F.struct(F.lit(name).alias("source"), F.lit(key).alias("key"), F.lit(columns[1]).alias("title"))
            for name, key, columns in _DIMENSIONS[:3]
        ]
    )
    routes = table(spark, folder, "nation").select(
        number.alias("number"), F.explode(sources).alias("one")
    )
    source = F.col("one.source")
    row = F.struct(
        source.alias("source_table"),
        F.concat(F.lit("dim_"), source, F.lit("_"), (F.col("number") % 2).cast("string")).alias("sink_table"),
        F.when(F.col("number") % 2 == 0, F.concat_ws(",", "one.key", "one.title"))
        .otherwise(F.col("one.key")).alias("sink_columns"),
        F.col("one.key").alias("sink_pk"),
        F.lit(None).cast("string").alias("sink_extend"),
    )
    removed = F.col("number") % 5 == 3
    fields = F.struct(
        F.when(removed, F.struct(source.alias("source_table"))).alias("before"),
        F.when(~removed, row).alias("after"),
    )
    return routes.select(
        F.to_json(fields, {"ignoreNullFields": "false"}).alias("value"),
        (F.col("number") * ROUTE_STEP).alias("offset"),
    )
