"""Passages repeated across documents, removed byte for byte.

A byte goes if a 50-byte string that covers it also starts in a document with a smaller
doc_id. Sorting all suffixes would shuffle the corpus many times over, so they are sorted
where it matters:

1. Every 50-byte string has an anchor: the 24-byte gram in it with the least hash. Equal
   strings have equal anchors, wherever they stand. A census of the anchors' hashes
   (sorted and delta-coded runs, three bytes each) tells which occur in two documents.
2. Around each of these, the bytes of all its 50-byte strings are one suffix. (At an anchor
   of very many blocks, two: equal strings have it at the same place and so share the bytes
   before it, or those after it, which then count as part of the anchor.) Each
   block of documents sorts its distinct suffixes, front-codes them (length of the prefix
   shared with the one before, and the rest) and sends the runs to buckets by anchor.
   A bucket merges its runs, a sixteenth of the anchors at a time, with a loser tree that
   carries the shared lengths along, which makes equal suffixes one. Their 50-byte strings are then matched by two 64-bit hashes of
   each, not by the merged order: most start inside a suffix, and the order of suffixes
   brings together only those that start one.
3. Blocks get back one bit per string, and cut.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tidewater.llm.common import BLANKS, PLAIN_TYPES, in_python, release, width, written

MATCH = 50
GRAM = 24
# Bytes of text in a block: a Python worker needs about 60 times as much.
BLOCK_BYTES = 2 << 20
# Text whose suffixes meet in a bucket, so buckets are as many as the input needs.
BUCKET_BYTES = 48 << 20
# A bucket is merged slice by slice, so that only a slice is decoded at a time.
SLICES = 16
# Strings at an anchor that so many blocks have are told apart by the bytes beside it, too.
HOT_BLOCKS = 1024
ID_BITS = 40
NO_ID = np.iinfo(np.int64).max
_BASE = np.uint64(0x9E3779B97F4A7C15)
_OTHER = np.uint64(0xD6E8FEB86659FD93)


def _pack(*parts) -> bytes:
    """Arrays and bytes as one compressed value."""
    raw = pickle.dumps(parts, protocol=5)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpack(value: bytes) -> tuple:
    size = int.from_bytes(value[:8], "little")
    return pickle.loads(pa.decompress(value[8:], size, codec="zstd", asbytes=True))


def _delta(sorted_ids: np.ndarray) -> bytes:
    """Ascending numbers as differences, low bytes of all first, so that zeros are together."""
    steps = np.diff(sorted_ids, prepend=np.uint64(0)).astype("<u8")
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes()


def _undelta(planes: bytes) -> np.ndarray:
    grid = np.frombuffer(planes, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(grid.T).view("<u8").ravel(), dtype=np.uint64)


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A number for each substring of ``size`` bytes, by doubling."""
    wide = data.astype(np.uint64) + np.uint64(1)
    have, power, done, total = wide, _BASE, 0, None
    length = 1
    while True:
        if size & length:
            if total is None:
                total, done = have, length
            else:
                n = len(data) - done - length + 1
                total, done = total[:n] * power + have[done : done + n], done + length
        if done == size:
            break
        n = len(have) - length
        have = have[:n] * power + have[length : length + n]
        power = power * power
        length *= 2
    return total ^ (total >> np.uint64(29))


class Anchors:
    """Where the 50-byte strings of a block's documents are anchored."""

    def __init__(self, data: np.ndarray, sizes: np.ndarray, match: int = MATCH, gram: int = GRAM):
        """``starts, stops``: first and last start of each run of strings with one anchor;
        ``ids`` its hash, ``docs`` the document's place."""
        ends = np.cumsum(sizes)
        with np.errstate(over="ignore"):
            hashes = gram_hashes(data, gram) if len(data) >= match else np.zeros(0, np.uint64)
            order = (hashes * _OTHER) & np.uint64(0xFFFFFFFF00000000)
        least = order | np.arange(len(order), dtype=np.uint64)
        span, have = match - gram + 1, 1
        while have < span:  # minima over ``have`` places, then over twice as many
            step = min(have, span - have)
            least = np.minimum(least[: len(least) - step], least[step:])
            have += step
        anchor = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
        valid = np.zeros(len(anchor) + 1, np.int8)
        long = sizes >= match
        np.add.at(valid, (ends - sizes)[long], 1)
        np.add.at(valid, (ends - match + 1)[long], -1)
        valid = np.cumsum(valid[:-1]).astype(bool)
        new = valid.copy()
        new[1:] &= ~valid[:-1] | (anchor[1:] != anchor[:-1])
        last = valid.copy()
        last[:-1] &= ~valid[1:] | (anchor[1:] != anchor[:-1])
        self.starts, self.stops = np.nonzero(new)[0], np.nonzero(last)[0]
        # Neighbouring documents may share a place, not a run.
        self.at = anchor[self.starts]
        with np.errstate(over="ignore"):
            mixed = hashes[self.at] * _BASE
        self.ids = mixed >> np.uint64(64 - ID_BITS)
        self.docs = np.searchsorted(ends, self.starts, "right")

    def choose(self, chosen: np.ndarray) -> None:
        """Keep these runs only."""
        for name in ("starts", "stops", "at", "ids", "docs"):
            setattr(self, name, getattr(self, name)[chosen])

    def split(self, hot: np.ndarray, data: np.ndarray, match: int = MATCH, gram: int = GRAM) -> None:
        """Cut these runs into strings with ``side`` bytes or more before the anchor, and others.

        The others have as many after it. Each part's id is made of the anchor and these bytes.
        """
        side = (match - gram) // 2
        if not side or not hot.any():
            return
        with np.errstate(over="ignore"):
            beside = gram_hashes(data, side)
        cold, last = np.nonzero(~hot)[0], self.at - side
        left = np.nonzero(hot & (self.starts <= last))[0]
        right = np.nonzero(hot & (self.stops > last))[0]
        runs = np.concatenate((cold, left, right))
        starts, stops, ids = self.starts, self.stops, self.ids
        parts = [(cold, starts[cold], stops[cold], ids[cold])]
        for where, low, high, context in (
            (left, starts[left], np.minimum(stops[left], last[left]), last[left]),
            (right, np.maximum(starts[right], last[right] + 1), stops[right], self.at[right] + gram),
        ):
            with np.errstate(over="ignore"):
                mixed = (ids[where] ^ (beside[context] * _OTHER)) * _BASE
            parts.append((where, low, high, mixed >> np.uint64(64 - ID_BITS)))
        self.at, self.docs = self.at[runs], self.docs[runs]
        self.starts, self.stops, self.ids = (np.concatenate([part[i] for part in parts]) for i in (1, 2, 3))


class Block:
    """Documents side by side, as a row of the block table holds them."""

    def __init__(self, value: bytes):
        self.doc_ids, self.sizes, self.carried, text = _unpack(value)
        self.data = np.frombuffer(text, np.uint8)
        self.keys = np.array([NO_ID if d is None else d for d in self.doc_ids], np.int64)

    def anchors(self, match: int) -> Anchors:
        return Anchors(self.data, self.sizes, match)


def bucket_of(ids: np.ndarray, buckets: int) -> np.ndarray:
    return ((ids >> np.uint64(ID_BITS - 32)) * np.uint64(buckets)) >> np.uint64(32)


def _edges(sorted_buckets: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """``bucket, first, end`` of each bucket there is."""
    if len(sorted_buckets):
        cut = np.nonzero(np.diff(sorted_buckets))[0] + 1
        for first, end in zip([0, *cut], [*cut, len(sorted_buckets)]):
            yield int(sorted_buckets[first]), int(first), int(end)


def census(anchors: Anchors) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct ids in order, whether two documents here have one, and each run's place."""
    ids, place = np.unique(anchors.ids, return_inverse=True)
    low = np.full(len(ids), NO_ID, np.int64)
    high = np.full(len(ids), -1, np.int64)
    np.minimum.at(low, place, anchors.docs)
    np.maximum.at(high, place, anchors.docs)
    return ids, low != high, place


def repeated_ids(
    runs: Sequence[tuple[np.ndarray, np.ndarray]], hot_blocks: int = HOT_BLOCKS
) -> list[np.ndarray]:
    """For each run of a bucket, two bits for each id: two documents have it, very many blocks do."""
    ids = np.concatenate([run for run, _ in runs])
    both = np.concatenate([flags for _, flags in runs])
    found, place, n = np.unique(ids, return_inverse=True, return_counts=True)
    many = n > 1
    many[place[both]] = True
    bits = np.stack((many[place], n[place] >= hot_blocks), axis=1)
    cuts = np.cumsum([len(run) for run, _ in runs])[:-1]
    return [part.ravel() for part in np.split(bits, cuts)]


class Suffixes:
    """The distinct suffixes of a block at its repeated anchors, sorted by bucket and bytes."""

    def __init__(self, block: Block, anchors: Anchors, buckets: int, match: int):
        longest = 2 * match - GRAM
        self.starts, self.docs = anchors.starts, anchors.docs
        self.lengths = anchors.stops - self.starts + match
        places = self.starts[:, None] + np.arange(longest)[None, :]
        grid = block.data[np.minimum(places, max(0, len(block.data) - 1))]
        grid[np.arange(longest)[None, :] >= self.lengths[:, None]] = 0
        ids = anchors.ids
        head = bucket_of(ids, buckets).astype(">u4").view(np.uint8).reshape(-1, 4)
        # The low bits, as buckets are made of the high ones.
        part = (ids % np.uint64(SLICES)).astype(np.uint8)[:, None]
        rows = np.hstack((head, part, grid, self.lengths.astype(np.uint8)[:, None]))
        rows = np.ascontiguousarray(rows).view(np.dtype((np.void, rows.shape[1]))).ravel()
        found, self.place = np.unique(rows, return_inverse=True)
        flat = found.view(np.uint8).reshape(len(found), longest + 6)
        self.buckets = np.ascontiguousarray(flat[:, :4]).view(">u4").ravel().astype(np.int64)
        self.slices = flat[:, 4]
        self.grid, self.sizes = flat[:, 5:-1], flat[:, -1].astype(np.int64)
        self.least = np.full(len(found), NO_ID, np.int64)
        np.minimum.at(self.least, self.place, block.keys[self.docs])

    def coded(self, first: int, end: int) -> bytes:
        """The run of one bucket, front-coded; every slice starts with a whole suffix."""
        grid, sizes = self.grid[first:end], self.sizes[first:end]
        shared = np.zeros(len(grid), np.int64)
        differs = grid[1:] != grid[:-1]
        shared[1:] = np.where(differs.any(axis=1), differs.argmax(axis=1), grid.shape[1])
        shared[1:] = np.minimum(shared[1:], np.minimum(sizes[1:], sizes[:-1]))
        slices = self.slices[first:end]
        shared[1:][slices[1:] != slices[:-1]] = 0
        columns = np.arange(grid.shape[1])[None, :]
        rest = grid[(columns >= shared[:, None]) & (columns < sizes[:, None])]
        counts = np.bincount(slices, minlength=SLICES)
        return _pack(
            shared.astype(np.uint8), sizes.astype(np.uint8), rest.tobytes(), self.least[first:end], counts
        )


def slices_of(value: bytes) -> list[tuple]:
    """The slices of a run, still front-coded."""
    shared, sizes, rest, least, counts = _unpack(value)
    ends = np.cumsum(counts)
    read = np.concatenate(([0], np.cumsum(sizes.astype(np.int64) - shared)))
    return [
        (shared[a:b], sizes[a:b], memoryview(rest)[read[a] : read[b]], least[a:b])
        for a, b in zip(ends - counts, ends)
    ]


def decoded(part: tuple) -> tuple[list[bytes], list[int], np.ndarray]:
    """Suffixes of a slice, the prefix each shares with the one before, and their least doc_ids."""
    shared, sizes, rest, least = part
    shared, sizes, rest = shared.tolist(), sizes.tolist(), bytes(rest)
    found, before, at = [], b"", 0
    for same, size in zip(shared, sizes):
        end = at + size - same
        before = before[:same] + rest[at:end]
        found.append(before)
        at = end
    return found, shared, least


def _common(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix, of which ``known`` bytes need not be looked at."""
    end = min(len(a), len(b))
    if a[known:end] == b[known:end]:
        return end
    step = 8
    while a[known : known + step] == b[known : known + step]:
        known += step
    while a[known] == b[known]:
        known += 1
    return known


def merged(runs: Sequence[tuple[list[bytes], list[int]]]) -> Iterator[tuple[int, int, int]]:
    """``run, place, shared`` of all suffixes in order; shared with the one before.

    A loser tree: each inner node keeps the run that lost there, with the length of the
    prefix it shares with the winner. That winner was the last to leave, so two runs
    that meet share different lengths with the same string, and the longer one comes
    first, unread; or equal lengths, and they are compared from there on. A run's next
    suffix enters with its front code. No byte is compared that is known to be equal.
    """
    count = len(runs)
    strings = [run for run, _ in runs]
    codes = [code for _, code in runs]
    sizes = [len(run) for run in strings]
    place = [0] * count
    now = [run[0] if run else b"" for run in strings]
    shared = [0 if run else -1 for run in strings]
    losers = [-1] * count
    winner = -1
    for run in range(count):  # the tree fills from the leaves
        node, me = (run + count) // 2, run
        while node and losers[node] >= 0:
            me = _duel(me, node, losers, shared, now)
            node //= 2
        if node:
            losers[node] = me
        else:
            winner = me
    while shared[winner] >= 0:
        yield winner, place[winner], shared[winner]
        at = place[winner] + 1
        place[winner] = at
        if at < sizes[winner]:
            now[winner] = strings[winner][at]
            shared[winner] = codes[winner][at]
        else:
            shared[winner] = -1
        me, node = winner, (winner + count) // 2
        while node:
            other = losers[node]
            a, b = shared[me], shared[other]
            if a < b:
                losers[node], me = me, other
            elif a == b and a >= 0:
                me = _duel(me, node, losers, shared, now)
            node //= 2
        winner = me


def _duel(me: int, node: int, losers: list[int], shared: list[int], now: list[bytes]) -> int:
    """Who wins at the node; the loser stays there with the prefix both share."""
    other = losers[node]
    a, b = shared[me], shared[other]
    if a != b or a < 0:
        if a < b:
            losers[node], me = me, other
        return me
    x, y = now[me], now[other]
    same = _common(x, y, a)
    if same == len(y) and (same < len(x) or other < me) or same < len(x) and same < len(y) and y[same] < x[same]:
        losers[node], me = me, other
    shared[losers[node]] = same
    return me


def window_keys(grid: np.ndarray, sizes: np.ndarray, match: int):
    """Two 64-bit hashes of every window of the suffixes, and the suffix of each."""
    rows, columns = grid.shape
    of = np.repeat(np.arange(rows), sizes - match + 1)
    at = np.arange(len(of)) - np.repeat(np.cumsum(sizes - match + 1) - (sizes - match + 1), sizes - match + 1)
    keys = []
    for base in (_BASE, _OTHER):
        sums = np.zeros((columns + 1, rows), np.uint64)
        with np.errstate(over="ignore"):
            power = np.uint64(1)
            for _ in range(match):
                power = power * base
            for i in range(columns):
                sums[i + 1] = sums[i] * base + grid[:, i] + np.uint64(1)
            keys.append(sums[at + match, of] - sums[at, of] * power)
    return keys[0], keys[1], of


def bucket_bits(values: Sequence[bytes], match: int) -> list[np.ndarray]:
    """For each run, whether each of its strings is in a document before the run's own."""
    slices = zip(*[slices_of(value) for value in values])
    found = [_slice_bits([decoded(part) for part in parts], match) for parts in slices]
    return [np.concatenate(bits) for bits in zip(*found)]


def _slice_bits(runs: Sequence[tuple], match: int) -> list[np.ndarray]:
    if not any(run for run, _, _ in runs):
        return [np.zeros(0, bool)] * len(runs)
    distinct: list[bytes] = []
    place = [np.empty(len(run), np.int64) for run, _, _ in runs]
    for run, at, shared in merged([(run, codes) for run, codes, _ in runs]):
        suffix = runs[run][0][at]
        if not distinct or shared < len(suffix) or len(distinct[-1]) != shared:
            distinct.append(suffix)
        place[run][at] = len(distinct) - 1
    sizes = np.array([len(suffix) for suffix in distinct], np.int64)
    longest = 2 * match - GRAM
    joined = b"".join(suffix.ljust(longest, b"\0") for suffix in distinct)
    grid = np.frombuffer(joined, np.uint8).reshape(len(distinct), longest)
    least = np.full(len(distinct), NO_ID, np.int64)
    for where, (_, _, docs) in zip(place, runs):
        np.minimum.at(least, where, docs)
    first, second, of = window_keys(grid, sizes, match)
    order = np.lexsort((second, first))
    a, b = first[order], second[order]
    new = np.ones(len(order), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    begins = np.nonzero(new)[0]
    lowest = np.minimum.reduceat(least[of[order]], begins)
    by_window = np.empty(len(order), np.int64)
    by_window[order] = np.repeat(lowest, np.diff([*begins, len(order)]))
    windows = sizes - match + 1
    offsets = np.cumsum(windows) - windows
    found = []
    for where, (_, _, docs) in zip(place, runs):
        n = windows[where]
        spread = np.repeat(offsets[where] - np.cumsum(n) + n, n) + np.arange(n.sum())
        found.append(by_window[spread] < np.repeat(docs, n))
    return found


def _by_bucket(frame: DataFrame, work) -> DataFrame:
    """Rows ``block, bucket, value`` answered per bucket: ``work(values)`` to bits of each."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("block")
        bits = work(table["value"].to_pylist())
        release()
        return pa.table(
            {
                "block": table["block"],
                "bucket": table["bucket"],
                "bits": pa.array([np.packbits(one).tobytes() for one in bits], pa.binary()),
            }
        )

    return frame.groupBy("bucket").applyInArrow(run, "block bigint, bucket int, bits binary")


def _answers(frame: DataFrame, name: str) -> DataFrame:
    """One row per block with its buckets' bits, in order of bucket."""
    return frame.groupBy("block").agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("bucket", "bits"))), lambda one: one["bits"]
        ).alias(name)
    )


def _flags(answers: Sequence[bytes], buckets: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Bits of all buckets as one array; an item of a bucket has ``counts`` bits."""
    found = [np.zeros(0, bool)]
    for (_, first, end), bits in zip(_edges(buckets), answers):
        n = int(counts[first:end].sum())
        found.append(np.unpackbits(np.frombuffer(bits, np.uint8), count=n).astype(bool))
    return np.concatenate(found)


def text_blocks(docs: DataFrame, carry: Sequence[str], block_bytes: int) -> DataFrame:
    """``block, value``: neighbouring documents packed together, numbered by task."""

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        task = TaskContext.get().partitionId() << 32
        number = 0
        held: list[tuple] = []
        size = 0

        def pack() -> dict:
            nonlocal number, held, size
            texts = [text for text, *_ in held]
            sizes = np.array([len(text) for text in texts], np.int64)
            ids = [doc_id for _, doc_id, *_ in held]
            value = _pack(ids, sizes, [rest for _, _, *rest in held], b"".join(texts))
            number, held, size = number + 1, [], 0
            return {"block": [task + number], "value": [value]}

        for batch in batches:
            columns = [batch[f"_carry{i}"] for i in range(len(carry))]
            for text, doc_id, *rest in zip(batch["text"], batch["doc_id"], *columns):
                text = text or b""
                if held and size + len(text) > block_bytes:
                    yield pack()
                held.append((text, doc_id, *rest))
                size += len(text)
        if held:
            yield pack()

    rows = docs.select(
        F.col("doc_id").cast("bigint"),
        F.col("text").cast("string"),
        *[F.col(name).alias(f"_carry{i}") for i, name in enumerate(carry)],
    )
    return in_python(rows, work, "block bigint, value binary")


def without_repeats(
    docs: DataFrame,
    match: int = MATCH,
    carry: Sequence[str] = (),
    block_bytes: int = BLOCK_BYTES,
    bucket_bytes: int = BUCKET_BYTES,
    hot_blocks: int = HOT_BLOCKS,
) -> DataFrame:
    """``doc_id, n_bytes, span_starts, span_lengths, kept`` and the ``carry`` columns.

    The spans are the maximal runs of removed bytes, ``kept`` the rest as bytes (which
    may cut a sign). One row per row: NULL and empty texts and such of less than 50
    bytes lose nothing. Rows with the same doc_id remove nothing from each other; a row
    without doc_id is taken to come last of all. ``carry`` names columns of plain types
    (numbers and strings) that are passed on; others are not read.
    """
    if not GRAM < match <= 140:
        raise ValueError(f"strings of {GRAM + 1} to 140 bytes can be matched")
    blocks = written(text_blocks(docs, carry, block_bytes), "blocks")
    buckets = max(width(docs.sparkSession), -(-blocks.count() * block_bytes // bucket_bytes))

    def count(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            for number, value in zip(batch["block"], batch["value"]):
                ids, both, _ = census(Block(value).anchors(match))
                cuts = list(_edges(bucket_of(ids, buckets)))
                yield {
                    "block": [number] * len(cuts),
                    "bucket": [bucket for bucket, _, _ in cuts],
                    "value": [_pack(_delta(ids[a:b]), np.packbits(both[a:b])) for _, a, b in cuts],
                }

    def common(values: list[bytes]) -> list[np.ndarray]:
        runs = []
        for value in values:
            planes, flags = _unpack(value)
            ids = _undelta(planes)
            runs.append((ids, np.unpackbits(flags, count=len(ids)).astype(bool)))
        return repeated_ids(runs, hot_blocks)

    counted = in_python(blocks, count, "block bigint, bucket int, value binary")
    known = written(_answers(_by_bucket(counted, common), "repeated"), "census")

    def sorted_suffixes(block: Block, repeated: Sequence[bytes]) -> Suffixes:
        anchors = block.anchors(match)
        ids, _, place = census(anchors)
        flags = _flags(repeated or (), bucket_of(ids, buckets), np.full(len(ids), 2))
        many, hot = flags.reshape(-1, 2).T
        chosen = many[place]
        anchors.choose(chosen)
        anchors.split(hot[place[chosen]], block.data, match)
        return Suffixes(block, anchors, buckets, match)

    def send(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            for number, value, repeated in zip(batch["block"], batch["value"], batch["repeated"]):
                mine = sorted_suffixes(Block(value), repeated)
                cuts = list(_edges(mine.buckets))
                yield {
                    "block": [number] * len(cuts),
                    "bucket": [bucket for bucket, _, _ in cuts],
                    "value": [mine.coded(a, b) for _, a, b in cuts],
                }

    told = blocks.join(known, "block", "left")
    runs = in_python(told, send, "block bigint, bucket int, value binary")
    answers = written(
        _answers(_by_bucket(runs, lambda values: bucket_bits(values, match)), "earlier"), "merged"
    )
    types = dict(docs.dtypes)
    names = ["doc_id", "n_bytes", "span_starts", "span_lengths", "kept", *carry]

    def cut(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            for value, repeated, earlier in zip(batch["value"], batch["repeated"], batch["earlier"]):
                block = Block(value)
                mine = sorted_suffixes(block, repeated)
                windows = mine.sizes - match + 1
                bits = _flags(earlier or (), mine.buckets, windows)
                covered = _covered(block, mine, windows, bits, match)
                out: dict[str, list] = {name: [] for name in names}
                end = 0
                for doc_id, size, rest in zip(block.doc_ids, block.sizes.tolist(), block.carried):
                    gone = covered[end : end + size]
                    turns = np.diff(np.concatenate(([False], gone, [False])).astype(np.int8))
                    starts = np.nonzero(turns == 1)[0]
                    lengths = np.nonzero(turns == -1)[0] - starts
                    kept = block.data[end : end + size][~gone].tobytes()
                    rest = [one.decode() if isinstance(one, bytes) else one for one in rest]
                    for name, one in zip(names, (doc_id, size, starts, lengths, kept, *rest)):
                        out[name].append(one)
                    end += size
                yield out

    schema = "doc_id bigint, n_bytes bigint, span_starts array<bigint>, span_lengths array<bigint>, kept binary"
    schema += "".join(f", `{name}` {types[name]}" for name in carry)
    return in_python(told.join(answers, "block", "left"), cut, schema)


def _covered(block: Block, mine: Suffixes, windows, bits, match: int) -> np.ndarray:
    """Which bytes of the block go: covered by a string that an earlier document has."""
    n = windows[mine.place]
    first = np.cumsum(windows) - windows
    nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    # A document that is not the suffix's first here has all of its strings from that one.
    later = block.keys[mine.docs] > mine.least[mine.place]
    gone = bits[np.repeat(first[mine.place], n) + nth] | np.repeat(later, n)
    marks = np.zeros(len(block.data) + 1, np.int64)
    marks[(np.repeat(mine.starts, n) + nth)[gone]] = 1
    sums = np.cumsum(marks[:-1])
    before = np.concatenate((np.zeros(match, np.int64), sums))[: len(sums)]
    return sums > before


def cut_documents(docs: DataFrame, match: int = MATCH) -> DataFrame:
    """The documents with their repeated passages cut out, and ``n_chars`` of what is left.

    Where a cut splits a sign, the rest of the sign goes too. Documents of which nothing
    is left go; such that were empty before stay, with an empty text. All other columns
    are passed on, whatever their names and types.
    """
    others = [name for name in docs.columns if name not in ("doc_id", "text", "n_chars")]
    types = dict(docs.dtypes)
    plain = {name: types[name] in PLAIN_TYPES for name in others}
    carried = docs.select(
        "doc_id",
        "text",
        *[
            (F.col(f"`{name}`") if plain[name] else F.to_json(F.struct(F.col(f"`{name}`").alias("v"))))
            .alias(f"_other{i}")
            for i, name in enumerate(others)
        ],
    )
    found = without_repeats(carried, match, [f"_other{i}" for i in range(len(others))])
    text = F.col("kept").cast("string")
    whole = F.when(F.is_valid_utf8(text), text).otherwise(
        F.replace(F.make_valid_utf8(text), F.lit("\ufffd"), F.lit(""))
    )
    found = found.withColumn("text", whole)
    left = (F.size("span_starts") == 0) | (F.btrim("text", F.lit(BLANKS)) != "")
    columns = {"doc_id": F.col("doc_id").cast(types["doc_id"]), "text": F.col("text")}
    columns["n_chars"] = F.length("text").cast("bigint")
    for i, name in enumerate(others):
        value = F.col(f"_other{i}")
        columns[name] = value if plain[name] else F.from_json(value, f"v {types[name]}")["v"]
    return found.where(left).select(*[columns[name].alias(name) for name in docs.columns])
