"""Documents cut into pieces of tokens, and pieces packed into sequences of a fixed capacity."""

from __future__ import annotations

import base64
import os
import re
import threading
from array import array
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from tidewater.llm.common import in_python, written

CAPACITY = 1024
END_ID = 2
VOCABULARY = "byte_bpe_50k"
# Longer pieces without white space are left to the library whose merging is not quadratic.
LONG_PIECE = 1000

_encoders: dict[str, Encoder] = {}
_lock = threading.Lock()


class Encoder:
    """Token ids of texts as little-endian 32-bit numbers, by a byte-level vocabulary.

    A vocabulary is two files: ``NAME.json`` with its rules and special tokens, and
    ``NAME.tiktoken`` with the same tokens as ranks. The second one's library is several
    times faster, and encodes all but texts in which the special strings (``<|...|>``)
    may stand, or pieces of thousands of signs; these go through the first.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        with open(f"{path}.tiktoken", "rb") as lines:
            pairs = [line.split() for line in lines]
        ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self._fast = tiktoken.Encoding(
            os.path.basename(path),
            pat_str=public_tokenizers.PATTERN,
            mergeable_ranks=ranks,
            special_tokens={},
        )
        self._rules = Tokenizer.from_file(f"{path}.json")
        self._special = re.compile(rf"<\||\S{{{LONG_PIECE}}}")

    def encode(self, texts: list[str]) -> list[bytes]:
        found = []
        for text in texts:
            if self._special.search(text):
                ids = self._rules.encode(text, add_special_tokens=False).ids
            else:
                ids = self._fast.encode_ordinary(text)
            found.append(array("I", ids).tobytes())
        return found


def encoder(path: str) -> Encoder:
    """The worker's encoder of this vocabulary, loaded once."""
    with _lock:
        if path not in _encoders:
            _encoders[path] = Encoder(path)
    return _encoders[path]


def vocabulary_path(name: str = VOCABULARY) -> str:
    """Where the vocabulary's two files are, without their endings."""
    import public_tokenizers

    return public_tokenizers.path(f"{name}.json").removesuffix(".json")


def token_pieces(
    docs: DataFrame,
    vocabulary: str | None = None,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
) -> DataFrame:
    """``doc_id, piece, start, length, ids``: each document's tokens and ``end_id``, cut.

    Only documents longer than ``capacity`` are cut; the first piece takes what is over,
    so all others are full. ``ids`` are little-endian unsigned 32-bit numbers. NULL text is
    empty and gives one piece, the end; repeated rows and NULL doc_ids are documents as
    any other. The vocabulary's files (see ``Encoder``) are on every executor. Other columns are not read.
    """
    path = vocabulary or vocabulary_path()
    end = np.array([end_id], "<u4").tobytes()

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        encode = encoder(path).encode
        for batch in batches:
            texts = [(text or b"").decode() for text in batch["text"]]
            out: dict[str, list] = {n: [] for n in ("doc_id", "piece", "start", "length", "ids")}
            for doc_id, ids in zip(batch["doc_id"], encode(texts)):
                ids += end
                total = len(ids) // 4
                first = total % capacity or capacity
                edges = [0, *range(first, total + 1, capacity)]
                for piece, (start, stop) in enumerate(zip(edges, edges[1:])):
                    out["doc_id"].append(doc_id)
                    out["piece"].append(piece)
                    out["start"].append(start)
                    out["length"].append(stop - start)
                    out["ids"].append(ids[4 * start : 4 * stop])
            yield out

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return in_python(rows, work, "doc_id bigint, piece int, start bigint, length bigint, ids binary")


def packing_plan(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Where the items of each size go: rows ``size, rank, bins, bin, offset``.

    Items ``rank`` and on of this size (up to the next row's) go to ``bins`` bins from
    ``bin`` on, one each from ``offset`` on, then a second each behind, and so on.

    No bin holds three items above a third of the capacity. So these are matched first,
    greedily: the largest with the largest that fits beside it. Then smaller ones,
    largest first, go where the least room that suffices is left; new bins are opened only
    when none has. Bins of one state are a range of numbers, so the work is bounded by the
    number of sizes, whatever the number of items.
    """
    left = dict(counts)
    plan: list[tuple[int, int, int, int, int]] = []
    used = dict.fromkeys(counts, 0)
    rooms: dict[int, list[tuple[int, int]]] = {}
    opened = 0

    def put(size: int, items: int, bins: int, at: int, offset: int) -> None:
        plan.append((size, used[size], bins, at, offset))
        used[size] += items
        left[size] -= items

    def leave(room: int, at: int, bins: int) -> None:
        if room and bins:
            rooms.setdefault(room, []).append((at, bins))

    large = sorted(size for size in counts if 3 * size > capacity)
    while large:
        size = large[-1]
        if not left[size]:
            large.pop()
            continue
        fit = bisect_left(large, capacity - size + 1) - 1
        if fit == len(large) - 1 and left[size] == 1:
            fit -= 1  # not with itself
        if fit < 0:
            bins = left[size]
            put(size, bins, bins, opened, 0)
            leave(capacity - size, opened, bins)
            opened += bins
            continue
        other = large[fit]
        bins = left[size] // 2 if other == size else min(left[size], left[other])
        if not bins:  # the partner is used up
            large.pop(fit)
            continue
        put(size, bins, bins, opened, 0)
        put(other, bins, bins, opened, size)
        leave(capacity - size - other, opened, bins)
        opened += bins
    for size in sorted((size for size in counts if 3 * size <= capacity), reverse=True):
        for room in sorted(room for room in rooms if room >= size):
            ranges, each, rest = rooms.pop(room), room // size, []
            for at, bins in ranges:
                full = min(bins, left[size] // each)
                if full:
                    put(size, full * each, full, at, capacity - room)
                    leave(room - full * each * size // full, at, full)
                    at, bins = at + full, bins - full
                if bins and left[size]:  # fewer than a bin takes
                    items = left[size]
                    put(size, items, 1, at, capacity - room)
                    leave(room - items * size, at, 1)
                    at, bins = at + 1, bins - 1
                if bins:
                    rest.append((at, bins))
            if rest:
                rooms.setdefault(room, []).extend(rest)
            if not left[size]:
                break
        each = capacity // size
        full = left[size] // each
        if full:
            put(size, full * each, full, opened, 0)
            leave(capacity - each * size, opened, full)
            opened += full
        if left[size]:
            items = left[size]
            put(size, items, 1, opened, 0)
            leave(capacity - items * size, opened, 1)
            opened += 1
    return np.array(sorted(plan), np.int64).reshape(-1, 5)


def best_fit(items: DataFrame, capacity: int = CAPACITY, size: str = "length") -> DataFrame:
    """The items with ``sequence_id`` and ``offset``: packed into few sequences.

    Only the number of items of each size goes to the driver (``capacity`` numbers), and
    the plan comes back. An item's rank among those of its size is its place in its
    partition, plus what earlier partitions have: no task sees all items of a size. Items
    that fill a sequence are not ranked. Items of size 0 or NULL get no sequence; larger
    ones than ``capacity`` are an error. Columns named like the new ones are replaced; all
    others are passed on, whatever their names.
    """
    items = items.drop("sequence_id", "offset")
    columns = items.columns
    # The caller's columns are one, so that no name of theirs meets one of ours.
    too_long = F.raise_error(F.concat(F.lit("larger than a sequence: "), F.col(size).cast("string")))
    rows = written(
        items.select(
            F.struct(*[F.col(f"`{name}`") for name in columns]).alias("_in"),
            F.when(F.col(size) > capacity, too_long.cast("bigint")).otherwise(F.col(size)).cast("bigint").alias("_size"),
            F.monotonically_increasing_id().alias("_row"),
            F.spark_partition_id().alias("_part"),
        ),
        "items",
    )
    full = F.col("_size") == capacity
    part = rows.where((F.col("_size") > 0) & ~full)
    groups = part.groupBy("_size", "_part").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy("_size").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    groups = written(groups.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))), "sizes")
    counts = groups.groupBy("_size").agg(F.sum("_n")).collect()  # at most one row per size
    plan = packing_plan({int(n): int(count) for n, count in counts}, capacity)
    sizes, ranks, bins, first, offsets = (np.ascontiguousarray(c) for c in plan.T)
    starts = sizes * (1 << 50) + ranks

    def place(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            length = np.array(batch["_size"], np.int64)
            rank = np.array(batch["_rank"], np.int64)
            at = np.searchsorted(starts, length * (1 << 50) + rank, "right") - 1
            nth = rank - ranks[at]
            yield {
                "_row": batch["_row"],
                "_sequence": first[at] + nth % bins[at],
                "_offset": offsets[at] + nth // bins[at] * length,
            }

    order = Window.partitionBy("_size", "_part").orderBy("_row")
    ranked = (
        part.select("_size", "_part", "_row")
        .withColumn("_rank", F.row_number().over(order) - 1)
        .join(groups.select("_size", "_part", "_before"), ["_size", "_part"])
        .select("_row", "_size", (F.col("_rank") + F.col("_before")).alias("_rank"))
    )
    placed = in_python(ranked, place, "_row bigint, _sequence bigint, _offset bigint")
    alone = F.when(full, -1 - F.col("_row"))
    return rows.join(placed, "_row", "left").select(
        *[F.col("_in")[name].alias(name) for name in columns],
        F.coalesce(alone, "_sequence").alias("sequence_id"),
        F.coalesce(F.when(full, F.lit(0)), "_offset").cast("bigint").alias("offset"),
    )


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids``: the token ids of each sequence, from packed pieces with ids."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(
        parts, F.lit(b""), lambda all_, part: F.concat(all_, part["ids"])
    )
    return packed.groupBy("sequence_id").agg(joined.alias("ids"))
