"""Vectors of integers, and searches of them: requests against all rows, shard by shard.

Rows are put in an order that brings similar ones together and cut into shards of equal
size; a shard is packed into units (blocks or cells) of one matrix each. Requests meet the
shards in two waves. First every request is worked off in the shard its own row is in. The
score of its k-th hit there is its floor in the second wave, in which parts of the requests
meet all other shards: one Python call per part and shard. So neither the rows nor the
requests have to fit anywhere as a whole, and no call depends on another's progress.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewater.llm.common import written

SHARD = 8192
# Requests that one Python call of the second wave gets, on average.
PART = 4096
LEAST, MOST = -(2**63), 2**63 - 1
HIT = "request bigint, id bigint, score bigint"

Search = Callable[["Shard", "Requests", int], "Hits"]


def usable(vector: Column) -> Column:
    """Whether a vector is there and all of its components are finite."""
    finite = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))),
    )
    return F.coalesce(vector.isNotNull() & finite, F.lit(False))


def integers(vector: Column, scale: int) -> Column:
    """Each component x as floor(scale * x), x as double; bounded by what a long holds."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))


def numbered(
    rows: DataFrame, vector: Column, scale: int, asked: Column, label: Column | None = None
) -> tuple[DataFrame, int, int]:
    """``id, label, asked, values, row`` of the usable rows, their number and dimensions.

    Vectors of different lengths are filled up with zeros.
    """
    found = written(
        rows.where(usable(vector)).select(
            F.col("vec_id").cast("bigint").alias("id"),
            (F.lit(0) if label is None else label).cast("bigint").alias("label"),
            F.coalesce(asked, F.lit(False)).alias("asked"),
            integers(vector, scale).alias("values"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "vectors",
    )
    seen = found.agg(F.count("*").alias("n"), F.max(F.size("values")).alias("dims")).first()
    dims = seen["dims"] or 0
    zeros = F.array_repeat(F.lit(0).cast("bigint"), F.lit(dims) - F.size("values"))
    return found.withColumn("values", F.concat("values", zeros)), seen["n"], dims


def matrix(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    """An Arrow column of equally long lists as one array."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(lists), dims)


def exact(*arrays: np.ndarray) -> list[np.ndarray]:
    """The arrays in a type in which products of their rows are exact."""
    sizes = [max(abs(int(a.min(initial=0))), abs(int(a.max(initial=0)))) for a in arrays]
    width = max(1, *[a.shape[-1] for a in arrays])
    small = width * max(sizes) * max(sizes) < 2**53
    return [a.astype(np.float64 if small else object) for a in arrays]


def dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of all rows of both; those no long can hold count as its bound."""
    found = a @ b.T
    if found.dtype == object:
        found = np.clip(found, LEAST, MOST)
    return found.astype(np.int64)


class Shard:
    """The units of a shard, side by side: ``first`` and ``end`` of each in ``values``."""

    def __init__(self, table: pa.Table, dims: int):
        table = table.sort_by("unit")
        self.units = table["unit"].to_numpy()
        counts = pc.list_value_length(table["rows"]).to_numpy().astype(np.int64)
        self.end = np.cumsum(counts)
        self.first = self.end - counts
        ids = table["ids"].combine_chunks().flatten()
        self.no_id = ids.is_null().to_numpy(zero_copy_only=False)
        self.ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
        self.rows = table["rows"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        self.labels = table["labels"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        parts = [
            np.frombuffer(data, f"<i{len(data) // max(1, n * dims)}").reshape(n, dims)
            for data, n in zip(table["data"].to_pylist(), counts.tolist())
            if n * dims
        ]
        self.values = np.concatenate(parts).astype(np.int64) if parts else np.zeros((len(self.ids), dims), np.int64)


class Requests:
    """``floor`` and ``ceiling`` bound the wanted scores; ``row`` is the row that asks."""

    def __init__(self, table: pa.Table, dims: int):
        for name in ("request", "row", "label", "floor", "ceiling"):
            setattr(self, name, table[name].to_numpy().astype(np.int64))
        self.values = matrix(table["values"], dims)


class Hits:
    """The best ``k`` hits of each request so far; ``floor`` follows the k-th."""

    def __init__(self, requests: Requests, shard: Shard, k: int):
        self.k, self.shard, self.floor = k, shard, requests.floor.copy()
        self.numbers = requests.request
        self.of = self.place = self.score = np.zeros(0, np.int64)

    def add(self, of: np.ndarray, place: np.ndarray, score: np.ndarray) -> None:
        """``of`` is a request's place among the requests, ``place`` a row's in the shard."""
        of, place, score = (np.concatenate(pair) for pair in ((self.of, of), (self.place, place), (self.score, score)))
        # ~x sorts descending without overflow; ties go to the smaller id, rows without id last.
        order = np.lexsort((self.shard.ids[place], self.shard.no_id[place], ~score, of))
        of, place, score = of[order], place[order], score[order]
        starts = np.searchsorted(of, of, "left")
        nth = np.arange(len(of)) - starts
        last = nth == self.k - 1
        self.floor[of[last]] = np.maximum(self.floor[of[last]], score[last])
        keep = nth < self.k
        self.of, self.place, self.score = of[keep], place[keep], score[keep]

    def table(self) -> pa.Table:
        ids = pa.array(self.shard.ids[self.place], pa.int64(), mask=self.shard.no_id[self.place])
        return pa.table({"request": self.numbers[self.of], "id": ids, "score": self.score})


def packed(placed: DataFrame, unit: Column) -> DataFrame:
    """``shard, unit, ids, rows, labels, data``: rows at ``pos`` as one matrix per unit of a shard."""

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by("pos")
        units = table["unit"].to_numpy()
        cuts = [0, *(np.nonzero(np.diff(units))[0] + 1), len(units)]
        rows = matrix(table["values"], len(table["values"][0]))
        size = max(abs(int(rows.min(initial=0))), abs(int(rows.max(initial=0))) + 1)
        kind = "<i2" if size < 2**15 else "<i4" if size < 2**31 else "<i8"
        pairs = list(zip(cuts, cuts[1:]))
        lists = {
            name: pa.array([table[column][a:b].to_pylist() for a, b in pairs], pa.list_(pa.int64()))
            for name, column in (("ids", "id"), ("rows", "pos"), ("labels", "label"))
        }
        return pa.table(
            {
                "shard": pa.array([table["shard"][0].as_py()] * len(pairs), pa.int64()),
                "unit": pa.array([int(units[a]) for a, _ in pairs], pa.int64()),
                **lists,
                "data": pa.array([rows[a:b].astype(kind).tobytes() for a, b in pairs], pa.binary()),
            }
        )

    rows = placed.select("id", "label", "values", "pos", shard_of().alias("shard"), unit.alias("unit"))
    return rows.groupBy("shard").applyInArrow(
        pack,
        "shard bigint, unit bigint, ids array<bigint>, rows array<bigint>, labels array<bigint>, data binary",
    )


def shard_of() -> Column:
    return F.call_function("div", F.col("pos"), F.lit(SHARD))


def _each(count: int) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(count - 1).cast("bigint")))


def best(hits: DataFrame, k: int) -> DataFrame:
    """The first ``k`` hits of each request, with their ``rank``."""
    order = Window.partitionBy("request").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def searched(
    index: DataFrame, requests: DataFrame, n_rows: int, dims: int, k: int, search: Search
) -> DataFrame:
    """``request, id, score, rank``: the first ``k`` hits of each request in all shards.

    ``requests`` has ``request, row, shard, label, floor, ceiling, values``; a score counts
    if it is neither below the floor nor above the ceiling. Requests of one row stay together.
    """

    def run(units: pa.Table, asked: pa.Table) -> pa.Table:
        if not len(units) or not len(asked):
            return pa.table({name: pa.array([], pa.int64()) for name in ("request", "id", "score")})
        return search(Shard(units, dims), Requests(asked, dims), k).table()

    at_home = index.groupBy("shard").cogroup(requests.groupBy("shard")).applyInArrow(run, HIT)
    first = written(at_home, "hits")
    # At most k hits of each request are there.
    scores = F.sort_array(F.collect_list("score"), asc=False)
    kth = first.groupBy("request").agg(F.get(scores, k - 1).alias("kth"))
    shards, parts = max(1, -(-n_rows // SHARD)), max(1, -(-requests.count() // PART))
    others = (
        requests.join(kth, "request", "left")
        .withColumn("floor", F.greatest("floor", F.coalesce("kth", "floor")))
        .withColumn("part", F.pmod(F.xxhash64("row"), F.lit(parts)))
        .withColumn("home", F.col("shard"))
        .withColumn("shard", _each(shards))
        .where(F.col("shard") != F.col("home"))
        .drop("home", "kth")
    )
    spread = index.withColumn("part", _each(parts))
    keys = ("shard", "part")
    elsewhere = spread.groupBy(*keys).cogroup(others.groupBy(*keys)).applyInArrow(run, HIT)
    return best(first.unionByName(elsewhere), k)
