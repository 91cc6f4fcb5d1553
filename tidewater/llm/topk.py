"""Exact top-k by inner product, block by block.

A vector's components are weights of terms, as a text's are. Rows are ordered by their
heaviest term, so that neighbours are alike, and cut into blocks of 256: document ranges,
each with its rows' weights (its forward index) and the largest and least weight of every
term in it. The sum over a query's terms of its weight times the block's largest (least,
where the query's weight is negative) bounds all scores in the block. Each query takes the
blocks in descending order of that bound and scores them whole, until the next bound is
below its k-th score; equal bounds are still scored, as ties go by vec_id.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from tidewater.llm.common import ranked, written
from tidewater.llm.vectors import (
    LEAST,
    MOST,
    Hits,
    Requests,
    Shard,
    dot,
    exact,
    numbered,
    packed,
    searched,
    shard_of,
)

BLOCK = 256


def block_bounds(shard: Shard, values: np.ndarray) -> np.ndarray:
    """For each query and block, what no score in the block is above."""
    most = np.array([shard.values[a:b].max(axis=0) for a, b in zip(shard.first, shard.end)])
    least = np.array([shard.values[a:b].min(axis=0) for a, b in zip(shard.first, shard.end)])
    weights = np.hstack((np.maximum(values, 0), np.minimum(values, 0)))
    return dot(*exact(weights, np.hstack((most, least))))


def block_at_a_time(shard: Shard, requests: Requests, k: int) -> Hits:
    """Blocks in order of their bounds, until a query's next bound is below its floor."""
    hits = Hits(requests, shard, k)
    bounds = block_bounds(shard, requests.values)
    order = np.argsort(~bounds, axis=1, kind="stable")
    rows, queries = exact(shard.values, requests.values)
    going = np.arange(len(queries))
    for step in range(len(shard.units)):
        block = order[going, step]
        on = bounds[going, block] >= hits.floor[going]
        going, block = going[on], block[on]
        if not len(going):
            break
        found = []
        for one in np.unique(block):
            mine = going[block == one]
            first, end = shard.first[one], shard.end[one]
            scores = dot(queries[mine], rows[first:end])
            fit = scores >= hits.floor[mine][:, None]
            fit &= shard.rows[first:end][None, :] != requests.row[mine][:, None]
            if end - first > k + 1:  # one of the first may be the query itself
                fit &= scores >= np.partition(scores, -k - 1, axis=1)[:, -k - 1][:, None]
            at, place = np.nonzero(fit)
            found.append((mine[at], first + place, scores[at, place]))
        hits.add(*[np.concatenate(parts) for parts in zip(*found)])
    return hits


def top_k(
    rows: DataFrame, asked: Column, k: int = 10, scale: int = 1024, vector: str = "embedding"
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best rows for each row that is ``asked``.

    The score is the inner product of the components, each taken as floor(``scale`` * x); a
    row is no candidate of its own. Ties go to the smaller vec_id, rows without one come
    last. Vectors that are NULL or hold NULL or a component that is not finite take no part;
    shorter ones are filled up with zeros, an empty one scores 0. Rows that repeat a vec_id
    are candidates, and queries, each for itself. Integers and scores that a long cannot hold
    count as its bound. Other columns are not read. No row gives no rows.
    """
    found, count, dims = numbered(rows, F.col(vector), scale, asked)
    sizes = F.transform("values", lambda x: F.abs(x.cast("double")))
    heaviest = F.array_position(sizes, F.array_max(sizes))
    sign = F.signum(F.get("values", (heaviest - 1).cast("int")).cast("double"))
    ordered = found.select(
        F.lit("").alias("tree"), "*", (heaviest * sign).alias("term"), (-F.array_max(sizes)).alias("weight")
    )
    placed = ranked(ordered, ("term", "weight", "row")).drop("row")
    index = written(packed(placed, F.call_function("div", F.col("pos"), F.lit(BLOCK))), "blocks")
    requests = written(
        placed.where("asked").select(
            F.col("pos").alias("request"), F.col("pos").alias("row"), shard_of().alias("shard"),
            F.col("id").alias("query_id"), "label", F.lit(LEAST).alias("floor"),
            F.lit(MOST).alias("ceiling"), "values",
        ),
        "requests",
    )
    hits = searched(index, requests.drop("query_id"), count, dims, k, block_at_a_time)
    return hits.join(requests.select("request", "query_id"), "request").select(
        "query_id", "rank", F.col("id").alias("vec_id"), "score"
    )
