"""Hard negatives by an inverted multi-index.

Each half of the vectors' dimensions has a codebook; a pair of codes is a cell, and every
row is in the cell of its nearest codes. A half-score of an anchor with a code, plus the
anchor's length times the code's radius (the largest distance of any row to it), bounds the
half-scores of all rows of that code. A heap over the two lists of half-scores, sorted,
gives the cells in descending order of their summed bounds (multi-sequence). Rows of a
visited cell are scored exactly. A request has a window of scores and wants its first
few; it is certified once the next cell's bound is below the last of these, or below the
window. Cells that are above all windows still open are passed over.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewater.llm.common import ranked, written
from tidewater.llm.vectors import (
    LEAST,
    MOST,
    Hits,
    Requests,
    Shard,
    dot,
    exact,
    matrix,
    numbered,
    packed,
    searched,
    shard_of,
)

# Rows the codebooks are fitted on, at most; all rows are indexed and give the radii.
SAMPLE = 20_000
ROWS_PER_CELL = 64
MOST_CODES = 256
ROUNDS = 8
# Rows of visited cells that are scored at once.
SCORED = 2048


def halves(dims: int) -> tuple[slice, slice]:
    return slice(0, dims // 2), slice(dims // 2, dims)


def distances(rows: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Squared distance of each row to each code."""
    squares = (rows**2).sum(axis=1)[:, None] + (codes**2).sum(axis=1)[None, :]
    return np.maximum(squares - 2 * rows @ codes.T, 0)


def codebook(rows: np.ndarray, size: int) -> np.ndarray:
    """At most ``size`` codes by k-means, from evenly spaced distinct rows; rounds are fixed."""
    if not rows.shape[1]:
        return np.zeros((1, 0))
    start = np.unique(rows, axis=0)
    codes = start[np.linspace(0, len(start) - 1, min(size, len(start))).astype(int)]
    for _ in range(ROUNDS):
        nearest = distances(rows, codes).argmin(axis=1)
        counts = np.bincount(nearest, minlength=len(codes))
        sums = np.zeros_like(codes)
        np.add.at(sums, nearest, rows)
        codes = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], codes)
    return codes


def fitted(rows: DataFrame, count: int, dims: int) -> list[np.ndarray]:
    """The codebooks of both halves, from ``SAMPLE`` rows chosen by the hash of their number."""
    size = min(MOST_CODES, max(1, math.isqrt(count // ROWS_PER_CELL)))
    sample = rows.orderBy(F.xxhash64("row"), "row").limit(SAMPLE).select("values")
    values = matrix(sample.toArrow()["values"], dims).astype(float)
    return [codebook(values[:, half], size) for half in halves(dims)]


def coded(rows: DataFrame, books: list[np.ndarray], dims: int) -> DataFrame:
    """Add ``code1, code2``, the nearest codes, and the distances to them."""
    schema = pa.schema(
        [(f"code{i}", pa.int64()) for i in (1, 2)] + [(f"far{i}", pa.float64()) for i in (1, 2)]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = matrix(batch["values"], dims).astype(float)
            codes, far = [], []
            for half, book in zip(halves(dims), books):
                nearest = distances(values[:, half], book).argmin(axis=1)
                codes.append(nearest)
                # Not from the squares above, which lose digits where rows are near a code.
                far.append(np.sqrt(((values[:, half] - book[nearest]) ** 2).sum(axis=1)))
            added = [pa.array(one, kind) for one, kind in zip((*codes, *far), schema.types)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *added], names=[*batch.schema.names, *schema.names]
            )

    added = "code1 bigint, code2 bigint, far1 double, far2 double"
    fields = ", ".join(f"`{name}` {kind}" for name, kind in rows.dtypes)
    return rows.mapInArrow(run, f"{fields}, {added}")


def radii(rows: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """The largest distance of a row to each code: over all rows, one number per code."""
    pairs = F.array(*[F.struct(F.lit(i).alias("half"), F.col(f"code{i + 1}").alias("code"), F.col(f"far{i + 1}").alias("far")) for i in (0, 1)])
    most = rows.select(F.explode(pairs).alias("one")).groupBy("one.half", "one.code")
    found = [np.zeros(len(book)) for book in books]
    for row in most.agg(F.max("one.far").alias("far")).collect():
        found[row["half"]][row["code"]] = row["far"]
    return found


class HalfScores:
    """Bounds of an anchor's half-scores with the codes of one half that a shard has."""

    def __init__(self, values: np.ndarray, codes: np.ndarray, radius: np.ndarray):
        lengths = np.sqrt((values**2).sum(axis=1))[:, None]
        middle = values @ codes.T
        # Room for the rounding of all sums here and in the distances.
        room = 1 + 1e-9 * lengths * (np.sqrt((codes**2).sum(axis=1)) + radius)[None, :]
        around = lengths * radius[None, :] + room
        self.most, self.least = middle + around, middle - around


def cells_in_order(first: np.ndarray, second: np.ndarray) -> Iterator[tuple[float, int, int]]:
    """``bound, i, j`` of all pairs of the two lists, largest sum first."""
    a, b = np.argsort(-first, kind="stable").tolist(), np.argsort(-second, kind="stable").tolist()
    x, y = first[a].tolist(), second[b].tolist()
    heap = [(-(x[0] + y[0]), 0, 0)]
    while heap:
        bound, i, j = heapq.heappop(heap)
        yield -bound, a[i], b[j]
        if j + 1 < len(y):
            heapq.heappush(heap, (-(x[i] + y[j + 1]), i, j + 1))
        if j == 0 and i + 1 < len(x):
            heapq.heappush(heap, (-(x[i + 1] + y[0]), i + 1, 0))


class Windows:
    """The requests of one anchor in a shard: the best ``k`` of each so far, ties included."""

    def __init__(self, floor: np.ndarray, ceiling: np.ndarray, k: int):
        self.floor, self.ceiling, self.k = floor.copy(), ceiling, k
        self.found = [np.zeros((0, 2), np.int64) for _ in floor]

    def add(self, place: np.ndarray, scores: np.ndarray) -> None:
        for one, (low, high) in enumerate(zip(self.floor, self.ceiling)):
            fit = (scores >= low) & (scores <= high)
            if not fit.any():
                continue
            both = np.concatenate((self.found[one], np.column_stack((scores[fit], place[fit]))))
            if len(both) >= self.k:
                self.floor[one] = np.partition(both[:, 0], -self.k)[-self.k]
                both = both[both[:, 0] >= self.floor[one]]
            self.found[one] = both


def multi_sequence(books: list[np.ndarray], radius: list[np.ndarray], same: bool):
    """A search for rows of the same label as the one that asks, or of another one."""

    def search(shard: Shard, requests: Requests, k: int) -> Hits:
        codes = np.divmod(shard.units, len(books[1]))
        there = [np.unique(side, return_inverse=True) for side in codes]
        cell = np.full([len(used) for used, _ in there], -1)
        cell[there[0][1], there[1][1]] = np.arange(len(shard.units))
        _, lead, group = np.unique(requests.row, return_index=True, return_inverse=True)
        asking = requests.values[lead]
        first, second = (
            HalfScores(asking[:, half].astype(float), book[used], far[used])
            for half, book, far, (used, _) in zip(halves(asking.shape[1]), books, radius, there)
        )
        rows, asking = exact(shard.values, asking)
        found = []
        members = np.split(np.argsort(group, kind="stable"), np.cumsum(np.bincount(group))[:-1])
        for at, mine in enumerate(members):
            fit = (shard.labels == requests.label[mine[0]]) == same
            fit &= shard.rows != requests.row[mine[0]]
            windows = Windows(requests.floor[mine], requests.ceiling[mine], k)
            low, high = windows.floor.min(), windows.ceiling.max()
            waiting: list[np.ndarray] = []
            for bound, i, j in cells_in_order(first.most[at], second.most[at]):
                # Clipped as scores are, which stop at what a long holds.
                if max(bound, LEAST) < low:  # every window is certified
                    break
                unit = cell[i, j]
                if unit < 0 or min(first.least[at, i] + second.least[at, j], MOST) > high:
                    continue
                waiting.append(np.arange(shard.first[unit], shard.end[unit]))
                if sum(map(len, waiting)) >= SCORED:
                    _score(windows, rows, asking[at], np.concatenate(waiting), fit)
                    waiting, low = [], windows.floor.min()
            if waiting:
                _score(windows, rows, asking[at], np.concatenate(waiting), fit)
            found += [(one, *pair) for one, pairs in zip(mine, windows.found) for pair in pairs.tolist()]
        hits = Hits(requests, shard, k)
        if found:
            of, scores, place = np.array(found, np.int64).T
            hits.add(of, place, scores)
        return hits

    return search


def _score(
    windows: Windows, rows: np.ndarray, values: np.ndarray, places: np.ndarray, fit: np.ndarray
) -> None:
    places = places[fit[places]]
    windows.add(places, dot(values[None, :], rows[places])[0])


def hard_negatives(
    rows: DataFrame,
    label: Column,
    anchor: Column,
    positives: int = 5,
    negatives: int = 10,
    window: tuple[int, int] = (30, 90),
    scale: int = 256,
    vector: str = "embedding",
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    The positives of an anchor are the first ``positives`` other rows of its label, by inner
    product of the components, each taken as floor(``scale`` * x); its negatives for one of
    them are the first ``negatives`` rows of other labels whose score is within ``window`` per
    cent of the positive's, both ends included. So a positive of a score below 0 has none.
    Ties go to the smaller vec_id, rows without one come last.

    Rows with a NULL label or vector, or a component that is NULL or not finite, take no
    part. Shorter vectors are filled up with zeros. Rows that repeat a vec_id count each for
    itself. Integers and scores that a long cannot hold count as its bound. Other columns
    are not read. An anchor without positives or negatives gives no rows.
    """
    found, count, dims = numbered(rows.where(label.isNotNull()), F.col(vector), scale, anchor, label)
    if not count:
        empty = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
        return rows.sparkSession.createDataFrame([], empty)
    books = fitted(found, count, dims)
    cells = written(coded(found, books, dims), "cells")
    far = radii(cells, books)
    ordered = cells.drop("far1", "far2").withColumn("tree", F.lit(""))
    placed = ranked(ordered, ("code1", "code2", "row")).drop("row")
    index = written(packed(placed, F.col("code1") * len(books[1]) + F.col("code2")), "index")
    asking = written(
        placed.where("asked").select(
            F.col("pos").alias("row"), F.col("id").alias("anchor_id"), shard_of().alias("shard"),
            "label", "values",
        ),
        "anchors",
    )
    first = asking.select(
        F.col("row").alias("request"), "row", "shard", "label", F.lit(LEAST).alias("floor"),
        F.lit(MOST).alias("ceiling"), "values",
    )
    search = multi_sequence(books, far, same=True)
    near = written(
        searched(index, first, count, dims, positives, search).select(
            F.col("request").alias("row"), F.col("id").alias("positive_id"),
            F.col("score").alias("positive_score"),
        ),
        "positives",
    )
    # Positives of equal score have the same window: one request for all of them.
    nth = F.dense_rank().over(Window.partitionBy("row").orderBy("positive_score"))
    pairs = written(near.withColumn("request", F.col("row") * (positives + 1) + nth), "pairs")
    low, high = (F.lit(percent).cast("decimal(38,0)") * F.col("positive_score") for percent in window)
    hundred = F.lit(100).cast("decimal(38,0)")
    windows = (
        pairs.select("request", "row", "positive_score").distinct()
        .select(
            "request", "row",
            F.ceil(low / hundred).cast("bigint").alias("floor"),
            F.floor(high / hundred).cast("bigint").alias("ceiling"),
        )
        .where("floor <= ceiling")
        .join(asking.drop("anchor_id"), "row")
    )
    search = multi_sequence(books, far, same=False)
    hits = searched(index, written(windows, "windows"), count, dims, negatives, search)
    return (
        hits.join(pairs, "request")
        .join(asking.select("row", "anchor_id"), "row")
        .select(
            "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"),
            "positive_score", F.col("score").alias("negative_score"),
        )
    )
