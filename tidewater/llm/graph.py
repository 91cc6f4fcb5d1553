"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidewater.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` from undirected edges ``a, b``: root is the component's least node.

    Alternating stars (Kiveris et al. 2014): each round first links the larger
    neighbours of every node to its least neighbour, then the smaller ones. The
    graph shrinks to one star per component, in about log n rounds for long chains. No
    neighbourhood is ever gathered: a round is two grouped minima and two joins, and
    what a hub fills is split by adaptive execution. Loops and NULLs are left out.
    """
    a, b = F.col("a"), F.col("b")
    now = written(
        edges.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(),
        "edges",
    )
    state = None
    while (found := _signature(now)) != state:
        state = found
        both = now.unionByName(now.select(b.alias("a"), a.alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        large = (
            both.where(b > a)
            .join(least, "a")
            .select(b.alias("a"), F.least("m", "a").alias("b"))
            .distinct()
        )
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where(b != F.col("m")).select(b.alias("a"), F.col("m").alias("b"))
        now = written(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "edges")
    roots = now.select(b.alias("node"), b.alias("root")).distinct()
    return now.select(a.alias("node"), b.alias("root")).unionByName(roots)


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
