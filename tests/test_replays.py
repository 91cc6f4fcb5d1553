"""Facts sent twice, partitions that lag or fall silent, and a config that changes in mid-stream."""

import json
import random
from datetime import datetime, timedelta

import pytest
from helpers import START_MS, ids, line
from pyspark.sql import functions as F

from tidewater.contract import ARRIVAL
from tidewater.operators import dims
from tidewater.session import new_folder
from tidewater.sinks.fanout import folder_sink, kafka_records, read_topic
from tidewater.sources.changes import config_changes, decode_changes
from tidewater.sources.lines import as_lines
from tidewater.streaming import jobs
from tidewater.streaming.replays import SeenFacts

DAY = datetime(2024, 1, 1)
FACTS = (
    "value string, timestamp timestamp, partition int, offset bigint, "
    "source_partition int, source_offset bigint, source_nth int"
)


def facts(spark, sources, first=0, days=0.0):
    """Facts of the given (partition, offset, nth), arriving one after the other."""
    rows = [
        (f"{source}", DAY + timedelta(days=days, seconds=i), 0, first + i, *source)
        for i, source in enumerate(sources)
    ]
    return spark.createDataFrame(rows, FACTS).repartition(3)


def fresh(spark, seen, batch_id, rows):
    """Offsets of the rows that are no repeats; the batch runs twice."""
    found = None
    for _ in range(2):
        marked, new = seen.marked(rows, batch_id)
        assert marked.columns == [*rows.columns, "_again"]
        now = sorted(row["offset"] for row in marked.where("not _again").collect())
        assert found in (None, now)
        found = now
        seen.record(spark, batch_id, new)
    return found


@pytest.mark.parametrize("per_line, merge_every", [(1, 0), (4, 2)])
def test_repeats_of_any_batch(spark, per_line, merge_every):
    """Positions far apart, below 32768 and beyond; gaps are no repeats, whenever they are filled."""
    rng = random.Random(21)
    seen = SeenFacts(new_folder(spark, "seen"), per_line=per_line, merge_every=merge_every)
    places = [0, 1, 2, 7, 8, 32_766, 32_767, 32_768, 32_769, 10**6, 10**12]
    pool = [(p, o, n) for p in (0, 1) for o in places for n in range(per_line)]
    known = set()
    for batch_id in range(5):
        sources = rng.choices(pool, k=25) + [(None, None, None)] * 2
        expected = []
        for i, source in enumerate(sources):
            if source[0] is None or source not in known:
                expected.append(100 * batch_id + i)
            known.add(source)
        assert fresh(spark, seen, batch_id, facts(spark, sources, 100 * batch_id)) == expected


def test_old_positions_are_dropped_and_count_as_read(spark):
    seen = SeenFacts(new_folder(spark, "seen"), keep="2 days", merge_every=1)
    far = 40_000
    assert fresh(spark, seen, 0, facts(spark, [(0, 1, 0), (0, far, 0), (1, 5, 0)])) == [0, 1, 2]
    # The second bucket of partition 0 is still in use: it stays, and so does all after it.
    assert fresh(spark, seen, 1, facts(spark, [(0, far + 1, 0)], 10, days=3)) == [10]
    state = seen.table.latest(spark)
    assert state.where("bits is not null").count() == 1
    # Partition 0: a gap in a bucket that is gone counts as read, one that is there does not.
    sources = [(0, 2, 0), (0, far + 2, 0), (0, far, 0), (1, 6, 0), (1, far, 0), (2, 1, 0)]
    assert fresh(spark, seen, 2, facts(spark, sources, 20, days=3)) == [21, 24, 25]
    assert state.where("bits is null").count() == 2


def test_rows_without_headers_pass(spark):
    seen = SeenFacts(new_folder(spark, "seen"))
    rows = spark.createDataFrame([("x", DAY, 0, 1)] * 2, "value string, timestamp timestamp, partition int, offset bigint")
    assert fresh(spark, seen, 0, rows) == [1, 1]


def test_headers_come_back(spark):
    rows = spark.createDataFrame([("a", "t", 3, 10**12, 2)], "value string, topic string, partition int, offset bigint, nth int")
    records = kafka_records(rows).withColumns(
        {"timestamp": F.lit(DAY), "partition": F.lit(9), "offset": F.lit(1).cast("bigint")}
    )
    row = as_lines(records).first()
    assert tuple(row)[4:] == (3, 10**12, 2) and row["partition"] == 9
    strange = F.array(*[F.struct(F.lit(k).alias("key"), F.lit(v).cast("binary").alias("value")) for k, v in (("source-offset", "x"), ("other", "1"))])
    assert tuple(as_lines(records.withColumn("headers", strange)).first())[4:] == (None, None, None)
    none = F.lit(None).cast("array<struct<key:string,value:binary>>")
    assert tuple(as_lines(records.withColumn("headers", none)).first())[4:] == (None, None, None)


def with_origin(rows):
    """As if each line were the fact of a line at the same place."""
    return rows.withColumns(
        {"source_partition": F.lit(0), "source_offset": F.col("offset"), "source_nth": F.lit(0)}
    )


def records(spark, lines, partition=0, first=0, at=DAY):
    rows = [(text, at + timedelta(seconds=i), partition, first + i) for i, text in enumerate(lines)]
    return spark.createDataFrame(rows, "value string, timestamp timestamp, partition int, offset bigint")


def jumps(spark, **options):
    run = new_folder(spark, "test")
    marks = jobs.high_marks(f"{run}/marks")
    process = jobs.user_jumps(jobs.open_pages(f"{run}/open"), marks, folder_sink(f"{run}/facts"), **options)
    return process, marks, lambda: ids(read_topic(spark, f"{run}/facts").collect())


def test_a_page_sent_twice_is_no_second_page(spark):
    """A visitor that went on is no bounce; its entry page sent twice would look like one."""
    text = [line("a", START_MS, id=1), line("a", START_MS + 5000, last="p", id=2), line("z", START_MS + 10**6, id=3)]
    run = new_folder(spark, "test")
    for seen, expected in ((None, [1]), (SeenFacts(f"{run}/seen"), [])):
        drops = jobs.drops_table(f"{run}/drops-{bool(expected)}")
        process, _, found = jumps(spark, seen=seen, drops=drops)
        process(with_origin(records(spark, text[:1])), 0)
        again = with_origin(records(spark, text[:1])).withColumns(
            {"offset": F.col("offset") + 50, "timestamp": F.col("timestamp") + F.expr("interval 1 minute")}
        )
        process(again, 1)
        process(with_origin(records(spark, text[1:], first=1)), 2)
        assert found() == expected
        totals = {row["reason"]: row["count"] for row in jobs.drop_totals(spark, drops).collect()}
        assert totals == ({} if expected else {"sent again": 1})


def test_unique_visitors_of_a_topic_sent_twice(spark):
    run = new_folder(spark, "test")
    process = jobs.unique_visitors(
        jobs.last_visits(f"{run}/visits"), folder_sink(f"{run}/facts"), seen=SeenFacts(f"{run}/seen"), merge_every=0
    )
    day = 86_400_000
    # The first day's page again after the second day's would count once more.
    for batch_id, at in enumerate((0, 1, 0)):
        rows = records(spark, [line("a", START_MS + at * day, id=at)], first=at)
        process(with_origin(rows), batch_id)
    assert ids(read_topic(spark, f"{run}/facts").collect()) == [0, 1]


def test_a_partition_that_lags_loses_nothing(spark):
    hour = 3_600_000
    process, marks, found = jumps(spark)
    ahead = [records(spark, [line(f"a{i}", START_MS + i * hour, id=i)], 0, i) for i in range(4)]
    behind = [records(spark, [line(f"b{i}", START_MS + (i - 1) * hour, id=10 + i)], 1, i) for i in range(4)]
    for batch_id, (a, b) in enumerate(zip(ahead, behind)):
        process(a.unionByName(b), batch_id)
    late = {row["partition"]: row["late"] for row in marks.latest(spark).collect()}
    assert late == {0: 0, 1: 0}
    # The slower one stands at two hours: what is before that is settled.
    assert found() == [0, 1, 10, 11, 12]


def test_an_idle_partition_is_not_waited_for(spark):
    hour = 3_600_000
    text = [line(f"a{i}", START_MS + i * hour, id=i) for i in range(4)]
    for idle, expected in ((timedelta(minutes=5), [0, 1, 2, 9]), (timedelta(days=1), [])):
        process, marks, found = jumps(spark, idle=idle)
        process(records(spark, [line("b", START_MS - 1000, id=9)], 1), 0)
        for i in range(4):
            process(records(spark, text[i : i + 1], 0, i, DAY + timedelta(minutes=10 * (i + 1))), i + 1)
        assert found() == expected
        # Back again it may be late, which is counted; the watermark does not fall.
        closed = marks.latest(spark).first()["closed"]
        process(records(spark, [line("b", START_MS + 10_000, id=8)], 1, 1, DAY + timedelta(hours=2)), 5)
        rows = {row["partition"]: row for row in marks.latest(spark).collect()}
        assert rows[1]["late"] == (1 if expected else 0)
        assert rows[0]["closed"] >= closed


# --- routes as they were ----------------------------------------------------------------


def route(source, columns="id,n", sink="dim_t", pk=None, removed=False):
    row = {"source_table": source, "sink_table": sink, "sink_columns": columns, "sink_pk": pk, "sink_extend": None}
    return json.dumps({"before": row, "after": None} if removed else {"before": None, "after": row})


def change(key, table="t", **data):
    return json.dumps({"database": "d", "table": table, "type": "insert", "data": {"id": key, **data}})


def test_routes_as_of_their_rows(spark):
    log = ["xx", route("t", "id"), route("t", "id,n"), json.dumps({"before": None, "after": None}), route("t", removed=True), route("u", "id", "dim_u")]
    config = config_changes(records(spark, log), ARRIVAL)
    assert config.count() == 4
    same = config.where("removed").withColumns({"removed": F.lit(False), "sink_columns": F.lit("n"), "offset": F.lit(99).cast("bigint")})
    for more, at_end in ((config, None), (config.unionByName(same), {"n"})):
        versions = dims.route_versions(more)
        rows = [change(str(i), n="x") for i in range(6)] + [change("9", "u"), change("8", None)]
        changes = decode_changes(records(spark, rows))
        routed = dims.route_as_of(changes, versions)
        assert routed.columns == [*changes.columns, "sink_table", "key"]
        found = {row["offset"]: set(row["data"]) for row in routed.collect()}
        # Second 0 is before any route; from second 4 on it is gone, or another one.
        expected = {1: {"id"}, 2: {"id", "n"}, 3: {"id", "n"}, 6: {"id"}}
        expected |= {i: at_end for i in (4, 5) if at_end}
        assert found == expected
        rest = {row["offset"] for row in dims.unrouted_as_of(changes, versions).collect()}
        assert rest == set(range(8)) - set(expected)
        # Far more versions than may be broadcast: the same result.
        assert {r["offset"] for r in dims.route_as_of(changes, versions, max_rows=0).collect()} == set(expected)


def test_config_log_of_a_job(spark):
    """A snapshot, then a log that repeats it, changes it and takes it back; batches run twice."""
    run = new_folder(spark, "test")
    drops, store = jobs.drops_table(f"{run}/drops"), jobs.dimension_values(f"{run}/values")
    loaded = []

    def snapshot(spark):
        loaded.append(1)
        row = ("t", "dim_t", "id,n", None, None)
        return spark.createDataFrame([row], "source_table string, sink_table string, sink_columns string, sink_pk string, sink_extend string")

    log = jobs.config_log(f"{run}/log")
    process = jobs.dimensions(store, snapshot, f"db_{run[-8:]}", f"{run}/tables", drops=drops, log=log, merge_every=2)
    none = records(spark, ["x"]).where("false")
    for batch_id, (rows, config) in enumerate(
        [
            (records(spark, [change("1", n="a", m="b")]), none),
            (records(spark, [change("2", n="a", m="b")], 0, 10, DAY + timedelta(hours=1)),
             records(spark, [route("t", " id , m")], 0, 0, DAY + timedelta(minutes=30))),
            (records(spark, [change("3", n="a", m="b")], 0, 20, DAY + timedelta(hours=2)),
             records(spark, [route("t", removed=True)], 0, 1, DAY + timedelta(minutes=90))),
            # A row that comes late, but arrived when the first route was in force.
            (records(spark, [change("4", n="a", m="b")], 0, 30, DAY + timedelta(minutes=1)), none),
        ]
    ):
        config = config.withColumn("value", F.replace("value", F.lit(" id , m"), F.lit("id,m")))
        for _ in range(2):
            process(jobs.with_config(rows, config), batch_id)
    assert len(loaded) == 2  # by the first batch, each time it ran
    values = jobs.current_values(spark, store, ARRIVAL)
    found = {(row["key"], row["column"]) for row in values.collect()}
    assert found == {("1", "id"), ("1", "n"), ("2", "id"), ("2", "m"), ("4", "id"), ("4", "n")}
    totals = {row["reason"]: row["count"] for row in jobs.drop_totals(spark, drops).collect()}
    assert totals == {"no route: t": 1}
    assert set(spark.table(f"db_{run[-8:]}.dim_t").columns) == {"id", "n", "m"}
