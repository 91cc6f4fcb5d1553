"""Near-copies by SimHash: covering locality-sensitive hashing finds all close pairs."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tidewater.llm.common import free_name, in_python, written
from tidewater.llm.graph import components
from tidewater.operators.scale import lookup_side

SHINGLE_WORDS = 3
HASH_SEED = 42
RADIUS = 2
BITS = 64
# Buckets up to this size are searched in one numpy call of 8-byte numbers.
SMALL_BUCKET = 4096
_SLICE = 1 << 15


def fingerprint(text: bytes | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """The 64 majority bits of the text's shingle hashes; 0 for a text without words."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) < shingle_words:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*[words[i:] for i in range(shingle_words)]))
    count = max(1, len(words) - shingle_words + 1)
    digest = partial(xxhash.xxh64_intdigest, seed=HASH_SEED)
    hashes = np.fromiter(map(digest, shingles), np.uint64, count)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, count, _SLICE):
        piece = hashes[at : at + _SLICE].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(piece, axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * ones > count, bitorder="little").view(np.uint64)[0])


def text_hash() -> Column:
    """A number for the row's text; with the doc_id it tells rows apart, but for equal ones."""
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, text_hash, fp`` (the fingerprint as a signed number) of each row."""

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            found = [fingerprint(text, shingle_words) for text in batch["text"]]
            yield batch | {"fp": np.array(found, np.uint64).view(np.int64)}

    rows = docs.select(
        F.col("doc_id").cast("bigint"), text_hash().alias("text_hash"), F.col("text").cast("string")
    )
    return in_python(rows, work, "doc_id bigint, text_hash bigint, fp bigint")


def covering_masks(radius: int = RADIUS, bits: int = BITS) -> list[int]:
    """Masks such that any two numbers that differ in ``radius`` bits at most agree under one.

    Bit i has a vector m(i) of radius + 1 bits, not zero; mask v keeps the bits whose
    m(i) has an odd product with v. Any ``radius`` vectors m(i) leave a v orthogonal
    to all of them, and the mask of that v keeps none of the differing bits.
    """
    size = (1 << (radius + 1)) - 1
    return [
        sum(1 << i for i in range(bits) if ((i % size + 1) & v).bit_count() % 2)
        for v in range(1, size + 1)
    ]


def _signed(number: int) -> int:
    return number - (1 << 64) if number >> 63 else number


def close_edges(members: list[int], radius: int) -> tuple[list[int], list[int]]:
    """A star per connected group of the members, from exact distances."""
    left = np.unique(np.array(members, np.int64)).view(np.uint64)
    ends: tuple[list[int], list[int]] = ([], [])
    while left.size > 1:
        centre, front, left = left[0], [left[0]], left[1:]
        while front and left.size:
            near = np.bitwise_count(left ^ front.pop()) <= radius
            reached, left = left[near], left[~near]
            front.extend(reached)
            ends[0].extend(reached.view(np.int64).tolist())
            ends[1].extend([int(np.int64(centre.view(np.int64)))] * reached.size)
    return ends


def links(
    fps: DataFrame, radius: int = RADIUS, small_bucket: int = SMALL_BUCKET
) -> DataFrame:
    """Edges ``a, b`` that connect all distinct ``fp`` within ``radius`` bits.

    Each of the 2^(radius+1) - 1 tables buckets the numbers by their bits under a
    mask. Small buckets are searched directly. What lies in larger ones is linked by
    flipping up to radius / 2 bits, rounded up: two numbers within the radius meet
    in a third one, and all that meet there are linked to the least. That is linear in
    the number of fingerprints (65 each for radius 2) and exact.
    """
    if radius > 2:
        raise ValueError("large buckets are searched for a radius of 2 at most")
    masks = F.array(*[F.lit(_signed(mask)) for mask in covering_masks(radius)])
    keys = fps.select("fp", F.posexplode(masks).alias("table", "mask")).select(
        "fp", "table", F.col("fp").bitwiseAND(F.col("mask")).alias("key")
    )
    sizes = keys.groupBy("table", "key").agg(F.count("*").alias("n")).where("n > 1")
    shared = written(keys.join(sizes, ["table", "key"]), "buckets")

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            a: list[int] = []
            b: list[int] = []
            for members in batch["members"]:
                found = close_edges(members, radius)
                a += found[0]
                b += found[1]
            yield {"a": a, "b": b}

    small = (
        shared.where(F.col("n") <= small_bucket)
        .groupBy("table", "key")
        .agg(F.collect_list("fp").alias("members"))
        .select("members")
    )
    near = in_python(small, work, "a bigint, b bigint")
    rest = shared.where(F.col("n") > small_bucket).select("fp").distinct()
    flips = F.array(F.lit(0), *[F.lit(_signed(1 << bit)) for bit in range(BITS)])
    if radius == 2:
        meets = rest.select("fp", F.explode(flips).alias("flip")).select(
            "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("at")
        )
    else:
        flips = flips if radius == 1 else F.array(F.lit(0))
        meets = rest.select("fp", F.explode(flips).alias("flip")).select(
            "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("at")
        )
        if radius == 1:  # only a number and its own flips: the flip must itself be there
            there = rest.select(F.col("fp").alias("at"))
            return near.unionByName(
                meets.join(there, "at").select(F.col("fp").alias("a"), F.col("at").alias("b"))
            ).distinct()
    least = meets.groupBy("at").agg(F.min("fp").alias("b"), F.count("*").alias("n"))
    met = meets.join(least.where("n > 1"), "at").select(F.col("fp").alias("a"), "b")
    return near.unionByName(met).where("a <> b").distinct()


def near_copies(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``doc_id, fp, component_id``: one row per document, with its group's least doc_id.

    Documents are linked if their fingerprints differ in ``radius`` bits at most;
    groups are what links connect. NULL and empty texts, and texts of blanks, have
    fingerprint 0. Equal fingerprints are one node, so thousands of copies cost one.
    Repeated rows are returned as often as they occur. A row without doc_id gets the
    least id of its group, NULL if there is none. Other columns are not read.
    """
    return _grouped(docs, radius).select("doc_id", "fp", "component_id")


def _grouped(docs: DataFrame, radius: int) -> DataFrame:
    """``doc_id, text_hash, fp, root, component_id``: the root is some fingerprint of the group."""
    rows = written(fingerprints(docs), "fingerprints")
    classes = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(links(classes.select("fp"), radius))
    groups = classes.join(roots, classes["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    labels = groups.join(
        groups.groupBy("root").agg(F.min("least").alias("component_id")), "root"
    ).select("fp", "root", "component_id")
    return rows.join(labels, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def without_near_copies(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """The documents, one of each group: that with the least doc_id, of repeated rows one.

    Of a group without any doc_id one row stays. Rows with one doc_id, or without any, are
    told apart by their texts' hashes: what other groups hold of them stays or goes by itself.
    All columns are passed on, whatever their names.
    """
    groups = written(_grouped(docs, radius), "groups")
    is_first = F.col("doc_id").eqNullSafe(F.col("component_id"))
    # Equal rows are counted first, so that a large group is as many rows as distinct texts.
    texts = groups.groupBy("root", "doc_id", "text_hash", is_first.alias("is_first")).agg(
        F.count("*").alias("count")
    )
    texts = written(texts, "texts")
    stays = texts.where("is_first").groupBy("root").agg(F.min("text_hash").alias("stays"))
    judged = texts.join(stays, "root").withColumn("kept", F.expr("is_first and text_hash = stays"))
    judged = written(judged.select("doc_id", "text_hash", "count", "kept"), "judged")
    kept = _by_text(docs, judged.where("not kept"), "left_anti")
    repeated = judged.where("kept and count > 1")
    if repeated.isEmpty():
        return kept
    rows = _by_text(kept, repeated, "left_semi")
    names = [free_name(docs, name) for name in ("_doc_id", "_text_hash")]
    again = rows.select("*", F.col("doc_id").cast("bigint").alias(names[0]), text_hash().alias(names[1]))
    again = again.dropDuplicates(names).drop(*names)
    return _by_text(kept, repeated, "left_anti").unionByName(again)


def _by_text(docs: DataFrame, given: DataFrame, how: str) -> DataFrame:
    """The documents whose doc_id and text are (or are not) among the given; NULL matches NULL."""
    side = lookup_side(
        given.select(F.col("doc_id").alias("_given_id"), F.col("text_hash").alias("_given_hash"))
    )
    same = docs["doc_id"].cast("bigint").eqNullSafe(side["_given_id"])
    own = F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit("")))
    return docs.join(side, same & (own == side["_given_hash"]), how)
