"""A Merkle manifest of a table: a digest per row, a root, and a proof for every row.

Rows of one source make a tree, ordered by doc_id; the roots of the trees, ordered by
source, make one more. While a level has several nodes, every three neighbours become
the digest of their digests' text (the last run may be shorter, even one).

Trees are worked off in blocks of 3^7 neighbours (or 3^``height``), which are whole
subtrees. On the way up each block becomes one node, and the nodes of a level are cut into
blocks again, until every tree has one. On the way down, the nodes of a level meet what lies outside of their
blocks: both are cogrouped by superblock (a few blocks whose hash is equal), and one Python
call makes the inner levels, joins the proofs and folds them. So no call holds more than
some thousand rows, however large a tree is, and a block gets from outside only the
siblings on the one path from its top to the root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tidewater.llm.common import ranked, written
from tidewater.operators.scale import lookup_side

FAN = 3
# Levels of a block: it has 3^7 = 2187 nodes.
LEVELS = 7
# Rows of a Python call, on average. A proof takes one to three kB.
SUPERBLOCK = 8192
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def row_digest(fields: Sequence[Column]) -> Column:
    """SHA-256 of the fields' texts, each as ``bytes:text`` (``-`` for NULL), as binary."""
    texts = [field.cast("string") for field in fields]
    parts = [
        F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))
        for text in texts
    ]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def fold(node: str, proof: str, shape: str) -> str:
    """The root that follows from a node and its proof.

    ``shape`` has two digits per level: the node's place among the nodes of its run, and
    how many there are. ``proof`` is the text of the others, level by level.
    """
    at = 0
    for place, count in zip(shape[::2], shape[1::2]):
        cut = at + 64 * int(place)
        end = at + 64 * (int(count) - 1)
        node = _digest(proof[at:cut] + node + proof[cut:end])
        at = end
    return node


def _inner_levels(nodes: list[str], size: int, height: int) -> list[list[str]]:
    """The levels of a block of a tree of ``size`` nodes, the given one first."""
    levels = [nodes]
    while size > 1 and len(levels) <= height:
        below = levels[-1]
        levels.append([_digest("".join(below[i : i + FAN])) for i in range(0, len(below), FAN)])
        size = -(-size // FAN)
    return levels


def _inner_proofs(levels: list[list[str]], proof: str, shape: str) -> list[tuple[str, str]]:
    """Proof and shape of each node of the lowest level, given those of the top."""
    known = [(proof, shape)]
    for nodes in reversed(levels[:-1]):
        found = []
        for i in range(len(nodes)):
            first = i - i % FAN
            run = nodes[first : first + FAN]
            others = "".join(run[: i - first] + run[i - first + 1 :])
            proof, shape = known[i // FAN]
            found.append((others + proof, f"{i - first}{len(run)}{shape}"))
        known = found
    return known


def _blocks(rows: pd.DataFrame, height: int) -> Iterator[tuple[str, int, pd.DataFrame]]:
    """``tree, block, rows in order`` of each block in a superblock."""
    rows = rows.assign(block=rows["pos"] // FAN**height).sort_values(["tree", "pos"], kind="stable")
    for (tree, block), part in rows.groupby(["tree", "block"], sort=False):
        yield tree, int(block), part


def _hex(values: pd.Series) -> list[str]:
    return [bytes(value).hex() for value in values]


def _tops(rows: pd.DataFrame, height: int) -> pd.DataFrame:
    found = []
    for tree, block, part in _blocks(rows, height):
        size = int(part["size"].iloc[0])
        top = _inner_levels(_hex(part["node"]), size, height)[-1][0]
        found.append((tree, block, -(-size // FAN**height), bytes.fromhex(top)))
    return pd.DataFrame(found, columns=["tree", "pos", "size", "node"])


def _with_proofs(
    rows: pd.DataFrame, outer: pd.DataFrame, height: int
) -> Iterator[tuple[pd.DataFrame, list, dict]]:
    """``rows of a block, (proof, shape) of each, what is known of the block``."""
    above = {(one["tree"], int(one["pos"])): one for one in outer.to_dict("records")}
    for tree, block, part in _blocks(rows, height):
        known = above[tree, block]
        levels = _inner_levels(_hex(part["node"]), int(part["size"].iloc[0]), height)
        yield part, _inner_proofs(levels, known["proof"], known["shape"]), known


_PATH = "tree string, pos bigint, node binary, proof string, shape string, subroot string, root string"


def _paths(rows: pd.DataFrame, outer: pd.DataFrame, height: int) -> pd.DataFrame:
    found = []
    for part, proofs, known in _with_proofs(rows, outer, height):
        for pos, node, (proof, shape) in zip(part["pos"], part["node"], proofs):
            found.append((known["tree"], pos, node, proof, shape, known["subroot"], known["root"]))
    return pd.DataFrame(
        found, columns=["tree", "pos", "node", "proof", "shape", "subroot", "root"]
    )


_FINISHED = (
    "id string, leaf string, subroot string, root string, proof string, shape string, "
    "folded_root string"
)


def _finished(rows: pd.DataFrame, outer: pd.DataFrame, height: int) -> pd.DataFrame:
    found = []
    for part, proofs, known in _with_proofs(rows, outer, height):
        leaves = _hex(part["node"])
        for name, leaf, now, (proof, shape) in zip(part["id"], leaves, part["now"], proofs):
            folded = fold(leaf if now is None else bytes(now).hex(), proof, shape)
            found.append((name, leaf, known["subroot"], known["root"], proof, shape, folded))
    columns = ["id", "leaf", "subroot", "root", "proof", "shape", "folded_root"]
    return pd.DataFrame(found, columns=columns)


def _superblocks(rows: DataFrame, count: int, block: Column) -> DataFrame:
    number = -(-count // SUPERBLOCK)
    return rows.withColumn("superblock", F.pmod(F.xxhash64("tree", block), F.lit(max(1, number))))


def _inside(height: int) -> Column:
    return F.call_function("div", F.col("pos"), F.lit(FAN**height))


def climbed(nodes: DataFrame, height: int) -> list[tuple[DataFrame, int]]:
    """The levels of ``tree, pos, size, node`` at the blocks' borders, with their row counts.

    The last one has one node per tree. Rows of the given level keep their other columns.
    """
    levels = []
    while True:
        seen = nodes.agg(F.count("*").alias("rows"), F.max("size").alias("most")).first()
        levels.append((nodes, seen["rows"]))
        if not seen["rows"] or seen["most"] == 1:
            return levels
        # A tree of one node is its own root: it is not digested again.
        small = nodes.where("size = 1").select("tree", "pos", "size", "node")
        large = nodes.where("size > 1").select("tree", "pos", "size", "node")
        tops = (
            _superblocks(large, seen["rows"], _inside(height))
            .groupBy("superblock")
            .applyInPandas(
                lambda rows: _tops(rows, height), "tree string, pos bigint, size bigint, node binary"
            )
        )
        nodes = written(tops.unionByName(small), "nodes")


def _met(nodes: DataFrame, count: int, outer: DataFrame, height: int, work, schema: str) -> DataFrame:
    """Nodes cogrouped by superblock with the paths of their blocks' tops."""
    left = _superblocks(nodes, count, _inside(height)).groupBy("superblock")
    right = _superblocks(outer.drop("node"), count, F.col("pos")).groupBy("superblock")
    return left.cogroup(right).applyInPandas(lambda a, b: work(a, b, height), schema)


def descended(
    levels: Sequence[tuple[DataFrame, int]], outer: DataFrame, height: int
) -> DataFrame:
    """Paths of the tops of the lowest level's blocks, from those of the trees' roots."""
    for nodes, count in reversed(levels[1:-1]):
        outer = written(_met(nodes, count, outer, height, _paths, _PATH), "paths")
    return outer


def manifest(docs: DataFrame, text_now: Column | None = None, height: int = LEVELS) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof, shape, folded_root, verified``, one row per row.

    A leaf is the digest of ``doc_id, source, lang, n_chars, text``; digests are lowercase
    hex. ``proof`` and ``shape`` are what ``fold`` needs to get from the leaf to the root.
    ``text_now`` is the text as it is found later: ``folded_root`` is folded from the leaf of
    the row with it, by the proof made from the texts as they were, and ``verified`` says
    whether that gives the root.

    NULLs in any column are digested as such; rows without source are a source of their own
    that comes first, rows without doc_id come first in theirs. Rows that share a doc_id are
    ordered by their leaves, so repeated rows are leaves of their own with proofs of their
    own. An empty table has no rows. Every text is read whole, however long. Other columns are not read, whatever their names.
    """
    rows = docs.select(*[F.col(name) for name in FIELDS])
    leaf = row_digest([F.col(name) for name in FIELDS])
    now = F.lit(None).cast("binary")
    if text_now is not None:
        # Taken from the caller's table, as it may read any column of it.
        changed = docs.select(*[F.col(name) for name in FIELDS], text_now.alias("_now"))
        other = row_digest([*[F.col(name) for name in FIELDS[:-1]], F.col("_now")])
        now = F.when(~F.col("_now").eqNullSafe(F.col("text")), other)
        rows = changed
    # Sorts as sources do: none first, then by bytes. The row number makes the order unique.
    tree = F.coalesce(F.concat(F.lit("+"), F.col("source").cast("string")), F.lit(""))
    leaves = written(
        rows.select(
            tree.alias("tree"),
            F.col("doc_id").alias("id"),
            leaf.alias("node"),
            now.alias("now"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "leaves",
    )
    trees = climbed(ranked(leaves, ("id", "node", "row")), height)
    subroots = trees[-1][0].select(F.col("tree").alias("label"), "node")
    sources = climbed(ranked(subroots.withColumn("tree", F.lit("")), ("label",)), height)
    none = F.lit("")
    top = sources[-1][0].select(
        "tree", "pos", "node", none.alias("proof"), none.alias("shape"), none.alias("subroot"),
        F.lower(F.hex("node")).alias("root"),
    )
    labels = sources[0][0].select("pos", F.col("label"))
    if len(sources) > 1:
        nodes, count = sources[0]
        outer = descended(sources, top, height)
        top = _met(nodes.drop("label"), count, outer, height, _paths, _PATH)
    outer = (
        written(top, "paths")
        .join(lookup_side(labels), "pos")
        .select(
            F.col("label").alias("tree"),
            F.lit(0).cast("bigint").alias("pos"),
            "node",
            "proof",
            "shape",
            F.lower(F.hex("node")).alias("subroot"),
            "root",
        )
    )
    nodes, count = trees[0]
    texts = nodes.withColumn("id", F.col("id").cast("string")).drop("row")
    outer = descended(trees, outer, height)
    found = _met(texts, count, outer, height, _finished, _FINISHED)
    return found.select(
        F.col("id").cast(docs.schema["doc_id"].dataType).alias("doc_id"),
        "leaf", "subroot", "root", "proof", "shape", "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
