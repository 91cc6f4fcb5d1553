"""The jobs as streams: the batch operators run per micro-batch, with state between.

State that outlives a batch is a ``BatchTable``. The operators stay relational, so
a visitor with a third of all rows is spread over tasks as in the batch form. A
per-key state function would get all of that visitor's rows in one Python call.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewater.contract import (
    ARRIVAL,
    BOUNCE_WITHIN_MS,
    CONFIG_COLUMNS,
    LATENESS_MS,
    UNIQUE_VISITOR_TOPIC,
    USER_JUMP_TOPIC,
    VISIT_STATE_MS,
)
from tidewater.operators import bounces, carts, dims, logs, visitors
from tidewater.operators.scale import (
    HOT_ROWS,
    hot_bound,
    kept,
    lookup_side,
    order_key,
    stored,
    with_texts,
)
from tidewater.sinks.batches import BatchTable, KeyedTable, last_per_key
from tidewater.sinks.fanout import Sink, as_topic
from tidewater.sinks.tables import BUCKETS as TABLE_BUCKETS, ensure_tables, upsert
from tidewater.sources.changes import config_changes, flagged_changes
from tidewater.streaming.lookups import Lookup, looked_up
from tidewater.streaming.replays import SeenFacts

Process = Callable[[DataFrame, int], None]
# Before all event times.
NEVER = -(2**62)
# A partition without rows for so long is not waited for.
IDLE = timedelta(hours=1)
ARRIVAL_TYPES = {"timestamp": "timestamp", "partition": "int", "offset": "bigint"}


def arrival_schema(arrival: Sequence[str]) -> str:
    return ", ".join(f"{name} {ARRIVAL_TYPES[name]}" for name in arrival)


def start(
    stream: DataFrame, process: Process, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Run ``process(rows, batch_id)`` on every micro-batch; by default until all is read."""

    def body(rows: DataFrame, batch_id: int) -> None:
        # Streams switch adaptive execution off for the sake of stateful operators;
        # there are none here, and the joins below count on its skew handling.
        rows.sparkSession.conf.set("spark.sql.adaptive.enabled", "true")
        process(rows, batch_id)

    return (
        stream.writeStream.foreachBatch(body)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


# What is left out, if it is kept: its text, arrival and reason.
REJECTED_TOPIC = "rejected"

# --- dropped rows -------------------------------------------------------------


def drops_table(path: str) -> BatchTable:
    """What jobs left out: ``job, reason, count`` of each batch."""
    return BatchTable(path, "job string, reason string, count bigint")


def drop_totals(spark: SparkSession, drops: BatchTable) -> DataFrame:
    """``job, reason, count`` over all batches."""
    rows = drops.latest(spark).groupBy("job", "reason")
    return rows.agg(F.sum("count").cast("bigint").alias("count"))


def _report(drops: BatchTable | None, batch_id: int, job: str, counts: DataFrame) -> None:
    """Record the ``reason, count`` rows of a batch."""
    if drops is not None:
        drops.add(batch_id, counts.where("count > 0").select(F.lit(job).alias("job"), "reason", "count"))


def _bad_lines(flagged: DataFrame, reason: str) -> DataFrame:
    return flagged.agg(F.count_if(~F.col("_good")).alias("count")).select(
        F.lit(reason).alias("reason"), "count"
    )


def _left_out(marked: DataFrame) -> DataFrame:
    """Lines that are no page log, and facts that were sent again."""
    again = marked.agg(F.count_if(F.col("_again")).alias("count"))
    return _bad_lines(marked.where("not _again"), "no page log").unionByName(
        again.select(F.lit("sent again").alias("reason"), "count")
    )


def _rejected(rows: DataFrame, reason: Column, arrival: Sequence[str]) -> DataFrame:
    """Lines left out, as they came: facts of a topic of their own, with the reason."""
    columns = [F.lit(REJECTED_TOPIC).alias("topic"), "value", *arrival, reason.alias("reason")]
    return rows.select(*columns)


def _with_rejects(facts: DataFrame, rejects: Sequence[DataFrame]) -> DataFrame:
    """Facts and rejects for one write."""
    for one in rejects:
        facts = facts.unionByName(one, allowMissingColumns=True)
    return facts


def _marked(
    rows: DataFrame, seen: SeenFacts | None, batch_id: int, arrival: Sequence[str]
) -> tuple[DataFrame, DataFrame | None]:
    if seen is None:
        return rows.withColumn("_again", F.lit(False)), None
    return seen.marked(rows, batch_id, arrival)


# --- log split ---------------------------------------------------------------


def first_visits(path: str, buckets: int = 64) -> KeyedTable:
    """Visitors met so far: grows with visitors, not with lines."""
    return KeyedTable(path, "mid string, anchor date", "mid", buckets)


def anchors_so_far(
    parsed: DataFrame, visits: KeyedTable, batch_id: int, arrival: Sequence[str]
) -> DataFrame:
    """Like ``visit_anchors``, but an anchor set by an earlier batch stays."""
    spark = parsed.sparkSession
    here = stored(visitors.visit_anchors(parsed, arrival))
    known = (
        visits.before(spark, batch_id, here)
        .select("mid", F.col("anchor").alias("known"))
        .join(lookup_side(here.select("mid")), "mid", "left_semi")
    )
    merged = stored(here.join(known, "mid", "left"))
    visits.add(batch_id, merged.where("known is null").select("mid", "anchor"))
    return merged.withColumn("anchor", F.coalesce("known", "anchor")).drop("known")


def log_split(
    visits: KeyedTable,
    sink: Sink,
    shape: str = "nested",
    arrival: Sequence[str] = ARRIVAL,
    merge_every: int = 100,
    with_action_ts: bool = False,
) -> Process:
    """Lines to facts of all topics, flags repaired."""

    def process(lines: DataFrame, batch_id: int) -> None:
        with kept(lines) as held:
            parsed, narrow = logs.parse_logs(held), logs.parse_visits(held)
            wrong = visitors.wrong_flags(anchors_so_far(narrow, visits, batch_id, arrival))
            facts = logs.split_logs(
                visitors.apply_anchors(parsed, wrong), shape, with_action_ts=with_action_ts,
                keep=arrival, numbered=True,
            )
            sink(facts, batch_id)
        if visits.due(batch_id, merge_every):
            visits.merge(lines.sparkSession, batch_id, lambda rows: rows.drop("batch_id"))

    return process


# --- daily unique visitors ---------------------------------------------------


def last_visits(path: str, buckets: int = 64) -> KeyedTable:
    """Day of each visitor's last counted visit; entries expire."""
    return KeyedTable(path, "mid string, last_day date, written_ms bigint", "mid", buckets)


def unique_visitors(
    visits: KeyedTable,
    sink: Sink,
    arrival: Sequence[str] = ARRIVAL,
    state_ms: int = VISIT_STATE_MS,
    merge_every: int = 20,
    hot_rows: int | None = HOT_ROWS,
    clock: Callable[[], int] = lambda: int(time.time() * 1000),
    on_error: str = "drop",
    drops: BatchTable | None = None,
    seen: SeenFacts | None = None,
    keep_rejects: bool = False,
) -> Process:
    """Page-log lines to unique-visitor facts. State lives ``state_ms`` from its last write.

    Lines that are no page log are counted in ``drops``, or fail the job (``on_error``); with
    ``keep_rejects`` they go to ``REJECTED_TOPIC``, in the same write as the facts.
    With ``seen``, facts that the topic holds twice are left out and counted.
    """

    def process(lines: DataFrame, batch_id: int) -> None:
        spark = lines.sparkSession
        now = clock()

        def alive(state: DataFrame) -> DataFrame:
            latest = last_per_key(state, ["mid"], ["last_day", "written_ms"])
            return latest.where(F.col("written_ms") > now - state_ms)

        flagged = logs.flagged_pages(lines, on_error).where("is_entry or not _good")
        with kept(flagged) as held:
            marked, read = _marked(held, seen, batch_id, arrival)
            pages = marked.where("not _again").drop("_again")
            entries = logs.entry_pages(logs.good_pages(pages))
            here = stored(entries.select("mid").distinct())
            before = visits.before(spark, batch_id, here)
            known = stored(alive(before.join(lookup_side(here), "mid", "left_semi")))
            bound = hot_bound(entries, hot_rows)
            found = stored(visitors.first_entries(entries, arrival, known, bound))
            facts = with_texts(found, pages, ("mid", *arrival)).select("value", *arrival)
            _report(drops, batch_id, "unique-visitors", _left_out(marked))
            if seen is not None:
                seen.record(spark, batch_id, read)
            bad = marked.where("not _again and not _good")
            rejects = [_rejected(bad, F.lit("no page log"), arrival)] * keep_rejects
            sink(_with_rejects(as_topic(facts, UNIQUE_VISITOR_TOPIC), rejects), batch_id)
        visits.add(
            batch_id,
            found.groupBy("mid").agg(
                F.max_by("dt", order_key(arrival)).alias("last_day"),
                F.lit(now).cast("bigint").alias("written_ms"),
            ),
        )
        if visits.due(batch_id, merge_every):
            visits.merge(spark, batch_id, alive, expired=F.col("written_ms") <= now - state_ms)

    return process


# --- bounces -----------------------------------------------------------------


def open_pages(path: str, arrival: Sequence[str] = ARRIVAL) -> BatchTable:
    """Pages whose outcome is not settled: those of the last few seconds."""
    return BatchTable(
        path, f"value string, {arrival_schema(arrival)}, mid string, ts bigint, is_entry boolean"
    )


def high_marks(path: str) -> BatchTable:
    """Of each partition of the topic, the highest event time and the last arrival so far, and
    how many rows came too late; and the time all of them are through with."""
    return BatchTable(
        path, "partition int, high bigint, seen timestamp, late bigint, closed bigint"
    )


def _through(marks: Sequence[Row], lateness_ms: int, idle: timedelta) -> int:
    """The time up to which all partitions are through: no row up to it is waited for.

    The slowest partition decides. One that has had no row for ``idle`` before the last
    arrival in any partition is not waited for.
    """
    last = max((mark["seen"] for mark in marks if mark["seen"]), default=None)
    awaited = [
        mark["high"]
        for mark in marks
        if mark["high"] is not None and (last is None or mark["seen"] is None or last - mark["seen"] <= idle)
    ]
    return min(awaited, default=NEVER) - lateness_ms - 1


def _risen(marks: Sequence[Row], here: Sequence[Row]) -> list[Row]:
    """The partitions' marks after a batch; one row per partition, old or new."""
    found = {mark["partition"]: mark for mark in marks}
    for row in here:
        old = found.get(row["partition"])
        found[row["partition"]] = Row(
            partition=row["partition"],
            high=max((x["high"] for x in (old, row) if x and x["high"] is not None), default=None),
            seen=max((x["seen"] for x in (old, row) if x and x["seen"] is not None), default=None),
            late=row["late"] + (old["late"] if old else 0),
        )
    return list(found.values())


def user_jumps(
    pages_open: BatchTable,
    marks: BatchTable,
    sink: Sink,
    within_ms: int = BOUNCE_WITHIN_MS,
    lateness_ms: int = LATENESS_MS,
    arrival: Sequence[str] = ARRIVAL,
    hot_rows: int | None = HOT_ROWS,
    on_error: str = "drop",
    drops: BatchTable | None = None,
    seen: SeenFacts | None = None,
    idle: timedelta = IDLE,
    keep_rejects: bool = False,
) -> Process:
    """Page-log lines to bounce facts, in event time.

    Lines that are no page log are counted in ``drops``, or fail the job (``on_error``); with
    ``keep_rejects`` they and late pages go to ``REJECTED_TOPIC``, in the same write as the
    facts. With ``seen``, facts that the topic holds twice are left out and counted: the second
    would be taken for the visitor's next page.

    The watermark trails the highest event time of the slowest partition by ``lateness_ms``;
    a partition without rows for ``idle`` (by arrival times, so that a batch that runs again
    sees the same) is not waited for. The watermark never falls. Rows behind the watermark of
    the batches before are dropped and counted. A page is settled once no row still to come
    can be its next page within the window.
    """

    def process(lines: DataFrame, batch_id: int) -> None:
        spark = lines.sparkSession
        # One row per partition of the topic.
        known = marks.before(spark, batch_id).drop("batch_id").collect()
        closed_before = max((mark["closed"] for mark in known), default=NEVER)
        with kept(logs.flagged_pages(lines, on_error).drop("dt")) as held:
            marked, read = _marked(held, seen, batch_id, arrival)
            pages = logs.good_pages(marked.where("not _again").drop("_again"))
            partition = F.col("partition") if "partition" in arrival else F.lit(0)
            arrived = F.col("timestamp") if "timestamp" in arrival else F.lit(None).cast("timestamp")
            here = (
                pages.groupBy(partition.cast("int").alias("partition"))
                .agg(
                    F.max("ts").alias("high"),
                    F.max(arrived).alias("seen"),
                    F.count_if(F.col("ts") <= closed_before).alias("late"),
                )
                .collect()
            )
            risen = _risen(known, here)
            closed = max(closed_before, _through(risen, lateness_ms, idle))
            rows = pages.where(F.col("ts") > closed_before).select(
                "value", *arrival, "mid", "ts", "is_entry"
            )
            rows = rows.unionByName(pages_open.before(spark, batch_id).drop("batch_id"))
            settled = (F.col("ts") <= closed) & (
                ~F.col("is_entry")
                | F.coalesce(F.col("next_ts") <= closed, F.lit(False))
                | (F.lit(closed + 1) - F.col("ts") >= within_ms)
            )
            judged = stored(
                bounces.with_next_page(rows, arrival, hot_bound(rows, hot_rows))
                .withColumn("settled", settled)
                .withColumn("kind", bounces.bounce_kind(within_ms))
                .where(~F.col("settled") | F.col("kind").isNotNull())
            )
            _report(drops, batch_id, "user-jumps", _left_out(marked))
            if seen is not None:
                seen.record(spark, batch_id, read)
            place = ("mid", "ts", *arrival)
            over = with_texts(judged.where("settled").select(*place), rows, place)
            bad = marked.where("not _again and not _good")
            late = pages.where(F.col("ts") <= closed_before)
            rejects = [
                _rejected(bad, F.lit("no page log"), arrival),
                _rejected(late, F.lit("late"), arrival),
            ] * keep_rejects
            facts = as_topic(over.select("value", *arrival), USER_JUMP_TOPIC)
            sink(_with_rejects(facts, rejects), batch_id)
            still_open = judged.where(~F.col("settled")).select(*place, "is_entry")
            pages_open.replace(batch_id, with_texts(still_open, rows, place))
        now = [(m["partition"], m["high"], m["seen"], m["late"], closed) for m in risen]
        marks.replace(batch_id, spark.createDataFrame(now, marks.schema))

    return process


def remaining_jumps(
    spark: SparkSession,
    pages_open: BatchTable,
    within_ms: int = BOUNCE_WITHIN_MS,
    arrival: Sequence[str] = ARRIVAL,
) -> DataFrame:
    """Bounces among the pages still open, as if no more rows were to come."""
    rows = pages_open.latest(spark).drop("batch_id")
    return bounces.bounces(rows, within_ms, arrival)


# --- cart additions ----------------------------------------------------------


def cart_adds(
    sink: Sink,
    database: str,
    topic: str,
    load_dictionary: Lookup | None = None,
    scoped: bool = False,
    drops: BatchTable | None = None,
    keep_rejects: bool = False,
) -> Process:
    """Change lines to cart-add facts; the dictionary is read anew for every batch, or pinned.

    With ``keep_rejects``, lines that are no change row go to ``REJECTED_TOPIC``. Facts carry the arrival of their change, which the Kafka sink puts into headers.
    """

    def process(lines: DataFrame, batch_id: int) -> None:
        with kept(flagged_changes(lines, processing_time=True, keep_text=keep_rejects)) as held:
            good = held.where("_good").drop("_good")
            arrival = [name for name in ARRIVAL if name in good.columns]
            found = carts.cart_adds(good, database, scoped, keep=arrival)
            if load_dictionary is not None:
                # Stored, so that it is counted and sent as one state of the table.
                dictionary = stored(looked_up(load_dictionary, lines.sparkSession, batch_id))
                found = carts.with_source_type_name(found, dictionary)
            names = [name for name in found.columns if name not in arrival]
            text = F.to_json(F.struct(*names)).alias("value")
            # A change gives one fact at most: the first of its line.
            facts = found.select(text, *arrival, F.lit(0).alias("nth"))
            rejects = []
            if keep_rejects:
                rejects = [_rejected(held.where("not _good"), F.lit("no change row"), arrival)]
            sink(_with_rejects(as_topic(facts, topic), rejects), batch_id)
            _report(drops, batch_id, "cart-adds", _bad_lines(held, "no change row"))

    return process


# --- dimensions --------------------------------------------------------------


def dimension_values(
    path: str, arrival: Sequence[str] = ARRIVAL, buckets: int = 64
) -> KeyedTable:
    """Latest values of all dimension tables, one row per table, key and column."""
    return KeyedTable(
        path,
        f"sink_table string, key string, column string, value string, {arrival_schema(arrival)}",
        "key",
        buckets,
    )


def current_values(
    spark: SparkSession, store: KeyedTable, arrival: Sequence[str], before: int = 2**62
) -> DataFrame:
    rows = store.before(spark, before)
    return dims.latest_values(rows, ("batch_id", *arrival)).drop("batch_id")


def config_log(path: str, arrival: Sequence[str] = ARRIVAL) -> BatchTable:
    """All changes of the routing config so far, by arrival."""
    columns = ", ".join(f"{name} string" for name in CONFIG_COLUMNS if name != "source_table")
    return BatchTable(
        path, f"source_table string, removed boolean, {columns}, {arrival_schema(arrival)}"
    )


# Which of two topics a line of a stream over both is from.
CHANGES, CONFIG = "changes", "config"


def with_config(changes: DataFrame, config: DataFrame) -> DataFrame:
    """One stream of change lines and lines of the config's log, told apart by ``stream``."""
    both = [
        lines.select("value", *ARRIVAL, F.lit(name).alias("stream"))
        for lines, name in ((changes, CHANGES), (config, CONFIG))
    ]
    return both[0].unionByName(both[1])


def _record_config(
    log: BatchTable,
    lines: DataFrame,
    batch_id: int,
    load_config: Lookup | None,
    arrival: Sequence[str],
) -> DataFrame:
    """Add the batch's changes of the config; the versions known after it.

    The first batch takes a snapshot, if there is one to load: routes in force ever since,
    until the log says otherwise. A change that the snapshot has already, because the log is
    read from an earlier point, is a version of its own from its arrival on, as it was.
    """
    spark = lines.sparkSession
    new = config_changes(lines.where(F.col("stream") == CONFIG), arrival)
    if load_config is not None and log.before(spark, batch_id).isEmpty():
        routes = looked_up(load_config, spark, batch_id).select(*CONFIG_COLUMNS, F.lit(False).alias("removed"))
        new = new.unionByName(routes, allowMissingColumns=True)
    log.add(batch_id, new)
    return stored(dims.route_versions(log.before(spark, batch_id + 1), arrival))


def dimensions(
    store: KeyedTable,
    load_config: Lookup | None,
    database: str,
    tables_path: str,
    arrival: Sequence[str] = ARRIVAL,
    source_database: str | None = None,
    merge_every: int = 10,
    drops: BatchTable | None = None,
    log: BatchTable | None = None,
    trim: bool = False,
    buckets: int = TABLE_BUCKETS,
    rejects: Sink | None = None,
) -> Process:
    """Change lines to dimension tables, by the config as it is when the batch starts.

    With ``log``, by the config as it was when each row arrived: the stream has the lines of
    the config's log too (``with_config``), and ``load_config`` gives the snapshot it starts
    from, read once. Every row is judged by the versions known by the end of its batch.
    ``trim`` ignores blanks around the columns a route lists.

    Every batch ends with new versions of the tables it changed, so they can be read at once,
    and after a restart; only those of their ``buckets`` that have a changed key are written.
    Its values are added to the store, and merged there every ``merge_every`` batches. A row without a key fails the batch; lines that are no
    change row and rows of tables without a route are counted in ``drops``, and sent to
    ``rejects`` as they came.
    """
    known: dict[str, Row] = {}

    def process(lines: DataFrame, batch_id: int) -> None:
        spark = lines.sparkSession
        if log is None:
            config = stored(looked_up(load_config, spark, batch_id))
        else:
            config = _record_config(log, lines, batch_id, load_config, arrival)
            lines = lines.where(F.col("stream") == CHANGES)
        if trim:
            config = config.withColumn("sink_columns", F.array_join(dims.listed_columns(True), ","))
        tables = ensure_tables(spark, config, database, tables_path, known)
        with kept(flagged_changes(lines, keep_text=rejects is not None)) as held:
            good = held.where("_good").drop("_good")
            changes = dims.dimension_changes(good, source_database)
            if log is None:
                routed, rest = dims.route(changes, config), dims.unrouted(changes, config)
            else:
                routed = dims.route_as_of(changes, config, arrival[0])
                rest = dims.unrouted_as_of(changes, config, arrival[0])
            key = F.when(F.col("key").isNotNull(), F.col("key")).otherwise(
                F.raise_error(F.concat(F.lit("change without a key for "), F.col("sink_table")))
            )
            values = dims.routed_values(routed.withColumn("key", key), arrival)
            store.add(batch_id, dims.latest_values(values, arrival))
            unrouted = rest.groupBy("table").agg(F.count("*").alias("count"))
            reason = F.concat(F.lit("no route: "), F.coalesce("table", F.lit("no table"))).alias("reason")
            bad = _bad_lines(held, "no change row").unionByName(unrouted.select(reason, "count"))
            _report(drops, batch_id, "dimensions", bad)
            if rejects is not None:
                lines_out = _rejected(held.where("not _good"), F.lit("no change row"), arrival)
                rejects(lines_out.unionByName(_rejected(rest, reason, arrival)), batch_id)
        touched = store.added(spark, batch_id)
        names = {row["sink_table"] for row in touched.select("sink_table").distinct().collect()}
        changed = [table for table in tables if table.sink_table in names]
        upsert(touched, changed, database, tables_path, batch_id, buckets)
        if store.due(batch_id, merge_every):
            store.merge(
                spark,
                batch_id,
                lambda rows: dims.latest_values(rows, ("batch_id", *arrival)).drop("batch_id"),
            )
        if log is not None and log.due(batch_id, merge_every):
            log.replace(batch_id, log.before(spark, batch_id + 1).drop("batch_id"))

    return process
