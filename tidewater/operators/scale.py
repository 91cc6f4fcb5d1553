"""Joins and neighbour look-ups that hold when one key has a third of the rows."""

from __future__ import annotations

import functools
import operator
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Window, functions as F

from tidewater.session import shared_folder

# A side with at most this many rows and bytes of text is sent to every executor.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 << 20
# A key with more rows than this is sorted in several tasks.
HOT_ROWS = 5_000_000


def stored(frame: DataFrame) -> DataFrame:
    """The frame written once to the shared folder, with its lineage cut."""
    shared_folder(frame.sparkSession)
    return frame.checkpoint()


@contextmanager
def kept(frame: DataFrame) -> Iterator[DataFrame]:
    """The frame held in memory or on disk for several passes; lost parts are recomputed."""
    held = frame.persist()
    try:
        yield held
    finally:
        held.unpersist()


def is_small(frame: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Whether the frame has at most ``max_rows`` rows.

    A full count: it is summed up in every task, while a limit before it would send
    that many rows of every task to a single one.
    """
    return frame.count() <= max_rows


def lookup_side(frame: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """The frame marked for broadcast if its rows and their text are small enough.

    Beyond that it is returned as it is: Spark then shuffles both sides, and
    adaptive execution splits the partitions a hot key has filled. The frame is counted
    first, so give one that is cheap to evaluate again, or stored.
    """
    texts = [
        F.coalesce(F.length(F.to_json(F.struct(F.col(f"`{name}`")))), F.lit(0))
        for name, kind in frame.dtypes
        if "string" in kind or "binary" in kind or "array" in kind
    ]
    sums = functools.reduce(operator.add, texts, F.lit(0)).cast("bigint")
    seen = frame.agg(F.count("*").alias("rows"), F.sum(sums).alias("bytes")).first()
    small = seen["rows"] <= max_rows and (seen["bytes"] or 0) <= BROADCAST_BYTES
    return F.broadcast(frame) if small else frame


def hot_bound(frame: DataFrame, hot_rows: int | None) -> int | None:
    """``hot_rows``, or None if the frame is too small for any key to be hot."""
    return None if hot_rows is None or is_small(frame, hot_rows) else hot_rows


# What Spark's frequent-items sketch can track at most.
_TRACKED = 1_000_000


def hot_keys(rows: DataFrame, key: str, hot_rows: int) -> DataFrame:
    """``key, count`` of the keys with more than ``hot_rows`` rows.

    A sketch per task, merged, gives the candidates, which are counted exactly: no shuffle by
    key. It is made large enough to miss none. Rows without a key do not count. The rows are
    read twice, so give them stored.
    """
    total = rows.count()
    tracked = max(10_000, 16 * total // hot_rows)
    if total <= hot_rows:
        candidates = rows.select(key).where("false")
    elif tracked > _TRACKED:
        candidates = rows.select(key)
    else:
        most = min(tracked, total // hot_rows + 1)
        found = rows.agg(F.expr(f"approx_top_k(`{key}`, {most + 1}, {tracked})").alias("items"))
        # A few items by construction: at most total / hot_rows keys can be hot.
        items = found.select(F.explode("items").alias("one")).select(F.col("one.item").alias(key))
        candidates = rows.select(key).join(F.broadcast(items), key, "left_semi")
    return candidates.where(F.col(key).isNotNull()).groupBy(key).count().where(F.col("count") > hot_rows)


def with_texts(found: DataFrame, rows: DataFrame, address: Sequence[str], text: str = "value") -> DataFrame:
    """Rows found without their text, with it: by their ``address``, which must be unique.

    So that texts are not carried through sorts and shuffles of which few rows come out. A
    small result is broadcast and no text is shuffled. It is counted first, so give it stored.
    """
    columns = [*found.columns, text]
    return rows.select(*address, text).join(lookup_side(found), list(address)).select(*columns)


def order_key(columns: Sequence[str]):
    """One value that orders rows like ``columns`` do."""
    return F.col(columns[0]) if len(columns) == 1 else F.struct(*columns)


# Digits of a time in microseconds, a partition and an offset in one decimal.
_ARRIVAL_DIGITS = (17, 5, 16)


def arrival_key(columns: Sequence[str]):
    """Like ``order_key``, with one decimal for a (timestamp, partition, offset).

    Aggregates that compare structs sort all rows first; decimals are hashed. Times
    before 1970 or after the year 5138, more than 100,000 partitions and offsets from 10^16
    on do not fit and are an error.
    """
    if len(columns) != 3:
        return order_key(columns)
    time, partition, offset = columns
    parts = (F.unix_micros(time), F.col(partition).cast("bigint"), F.col(offset).cast("bigint"))
    fits = functools.reduce(
        operator.and_,
        [(part >= 0) & (part < 10**digits) for part, digits in zip(parts, _ARRIVAL_DIGITS)],
    )
    # Partition and offset have 21 digits: as text, since products of decimals are slower.
    low = F.concat(
        F.lpad(parts[1].cast("string"), _ARRIVAL_DIGITS[1], "0"),
        F.lpad(parts[2].cast("string"), _ARRIVAL_DIGITS[2], "0"),
    )
    packed = F.concat(parts[0].cast("string"), low).cast("decimal(38,0)")
    return F.when(fits, packed).otherwise(
        F.raise_error(F.lit("arrival beyond what one number holds")).cast("decimal(38,0)")
    )


def with_neighbour(
    rows: DataFrame,
    key: str,
    order: Sequence[str],
    picks: dict[str, str],
    step: int,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Add values of the next (``step=1``) or previous (``step=-1``) row of the same key.

    ``picks`` maps new column names to the neighbour's columns; ``order`` must be
    unique within a key. Keys with more than ``hot_rows`` rows (at most
    total / hot_rows of them) are cut into chunks along ``order``: each chunk is
    sorted in its own task, and its edge row gets its neighbour from the adjoining
    chunk. Rows are evaluated once and stored to find these keys, so give narrow ones;
    ``hot_rows=None`` says that no key is hot and saves that.
    """
    whole = Window.partitionBy(key).orderBy(*order)

    def in_window(frame: DataFrame, window) -> DataFrame:
        return frame.withColumns(
            {name: F.lead(source, step).over(window) for name, source in picks.items()}
        )

    if hot_rows is None:
        return in_window(rows, whole)
    rows = stored(rows)
    hot = hot_keys(rows, key, hot_rows).collect()  # few, see there
    if not hot:
        return in_window(rows, whole)

    n_hot_rows = sum(row["count"] for row in hot)
    hot = rows.sparkSession.createDataFrame([(row[key], row["count"]) for row in hot], f"`{key}` {dict(rows.dtypes)[key]}, count bigint")
    hot_side = F.broadcast(hot.select(key))
    n_chunks = max(2, -(-n_hot_rows // hot_rows))
    # The chunk numbers are used twice below, so they are stored: a second
    # evaluation could sample other range bounds.
    chunked = stored(
        rows.join(hot_side, key, "left_semi")
        .repartitionByRange(n_chunks, key, *order)
        .withColumn("_chunk", F.spark_partition_id())
    )
    nearest = F.min_by if step > 0 else F.max_by
    edges = chunked.groupBy(key, "_chunk").agg(
        nearest(F.struct(*dict.fromkeys(picks.values())), order_key(order)).alias("_edge")
    )
    links = edges.select(
        key,
        "_chunk",
        F.lead("_edge", step).over(Window.partitionBy(key).orderBy("_chunk")).alias("_edge"),
    )
    local = Window.partitionBy(key, "_chunk").orderBy(*order)
    found = (
        in_window(chunked, local)
        .withColumn("_at_edge", F.lead(F.lit(True), step).over(local).isNull())
        .join(lookup_side(links), [key, "_chunk"], "left")
        .withColumns(
            {
                name: F.when(F.col("_at_edge"), F.col("_edge")[source]).otherwise(F.col(name))
                for name, source in picks.items()
            }
        )
        .drop("_chunk", "_edge", "_at_edge")
    )
    cold = in_window(rows.join(hot_side, key, "left_anti"), whole)
    return cold.unionByName(found)
