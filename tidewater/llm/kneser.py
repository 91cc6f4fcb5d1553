"""Quality by perplexity: an interpolated modified Kneser-Ney model of trusted text's words."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewater.llm.common import Scratch, in_python, written
from tidewater.llm.neural_lm import contexts, tokens
from tidewater.operators.scale import lookup_side

# N-grams whose weight every worker holds; those of others are joined.
HEAD_GRAMS = 1_500_000
# Bits of the filter that tells which n-grams cannot be in the table, per n-gram and at most.
FILTER_BITS, MOST_FILTER_BITS = 16, 1 << 28
PAGE_BITS = 16
QUANTILE = 0.995
# A language with fewer trusted texts to measure takes the limit of all languages.
LEAST_TEXTS = 20
# One in so many trusted texts is not learned from, but sets the limits.
MEASURED = 5
# The number of what stands before a text.
START = 0
HASH_SEED = 42
CACHE_WORDS = 200_000
# Bytes of text whose n-grams are looked up at a time.
PIECE_BYTES = 1 << 20
# Shuffles of all triples, and of all n-grams asked for, go in so many rounds, so that their
# files are never there all at once. Counting reads the texts once a round.
COUNT_ROUNDS, ROUNDS = 2, 4


def discounts(counts_of_counts: dict[int, int]) -> tuple[float, float, float]:
    """What is taken off counts of 1, 2, and 3 or more (Chen and Goodman 1998)."""
    n1, n2, n3, n4 = (counts_of_counts.get(i, 0) for i in (1, 2, 3, 4))
    y = n1 / (n1 + 2 * n2) if n1 + 2 * n2 else 0.5
    found = []
    for i, (less, more) in enumerate(((n1, n2), (n2, n3), (n3, n4)), 1):
        value = i - (i + 1) * y * more / less if less else i * 0.5
        found.append(min(max(value, 0.05), i - 0.05))
    return tuple(found)


class Words(dict):
    """A number per word, its 64-bit hash, kept once computed."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > CACHE_WORDS:
            self.clear()
        number = xxhash.xxh64_intdigest(word, seed=HASH_SEED)
        found = self[word] = number - (1 << 64) if number >> 63 else number
        return found

    def number(self, word: bytes) -> int:
        return self[word]

    def of(self, texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        flat = [word for text in texts for word in text]
        numbers = np.fromiter(map(self.__getitem__, flat), np.int64, len(flat))
        return numbers, np.cumsum([len(text) for text in texts], dtype=np.int64)


_P1, _P2, _P3, _P4, _P5 = (
    np.uint64(p)
    for p in (
        0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5,
    )
)


def _turned(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def gram_key(*numbers: np.ndarray) -> np.ndarray:
    """What ``xxhash64`` of Spark gives for these bigint columns."""
    found = np.full(len(numbers[0]), HASH_SEED, np.uint64)
    for one in numbers:
        found = found + _P5 + np.uint64(8)
        found = found ^ (_turned(one.view(np.uint64) * _P2, 31) * _P1)
        found = _turned(found, 27) * _P1 + _P4
        found = (found ^ (found >> np.uint64(33))) * _P2
        found = (found ^ (found >> np.uint64(29))) * _P3
        found = found ^ (found >> np.uint64(32))
    return found.view(np.int64)


@dataclass
class Model:
    """What every worker holds: the head's weights and a filter of all n-grams."""

    words: Words
    distinct: int  # words of the trusted text, the end included
    unknown: float  # log10 of the probability of each word without one of its own
    head: np.ndarray  # keys of n-grams in order ...
    head_weight: np.ndarray  # ... and their weights
    rest: bool  # whether the table has others
    seen: np.ndarray | None  # a bit for each place that an n-gram of the rest may have; None: all

    @property
    def width(self) -> int:
        return self.distinct + 2  # with the unknown word and the start


def trigram_counts(docs: DataFrame, turn: int = 0, turns: int = 1) -> DataFrame:
    """``a, b, c, n``: numbers of three words, summed up in every batch before the shuffle.

    Rows are dealt out by ``a, b``. Of ``turns`` rounds, each has the triples of some middle words.
    """

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        words = Words()
        for batch in batches:
            for texts in _pieces(batch["text"]):
                c, ends = words.of([tokens(text) for text in texts])
                a, b = contexts(c, ends, START)
                if turns > 1:
                    mine = b % turns == turn
                    a, b, c = a[mine], b[mine], c[mine]
                _, at, n = np.unique(gram_key(a, b, c), return_index=True, return_counts=True)
                yield {"a": a[at], "b": b[at], "c": c[at], "n": n}

    rows = in_python(
        docs.select(F.col("text").cast("string")), work, "a bigint, b bigint, c bigint, n bigint"
    )
    return rows.repartition("a", "b").groupBy("a", "b", "c").agg(F.sum("n").cast("bigint").alias("n"))


def _pieces(texts: list[bytes | None]) -> Iterator[list[bytes | None]]:
    """The texts in order, some at a time; a long one by itself."""
    some, size = [], 0
    for text in texts:
        if some and size + len(text or b"") > PIECE_BYTES:
            yield some
            some, size = [], 0
        some.append(text)
        size += len(text or b"")
    if some:
        yield some


def _counts_of_counts(frame: DataFrame, column: str) -> dict[int, int]:
    rows = frame.where(F.col(column) <= 4).groupBy(column).count().collect()
    return {row[column]: row["count"] for row in rows}


def _off(column: str, taken: tuple[float, float, float]) -> Column:
    n = F.col(column)
    return F.when(n >= 3, taken[2]).when(n == 2, taken[1]).otherwise(taken[0])


def fit(docs: DataFrame, head: int = HEAD_GRAMS) -> tuple[Model, DataFrame]:
    """The model of these documents, and the weights of all their n-grams (``key, weight``), written.

    Log probabilities of a text are sums of weights, one for each of its words, pairs and
    triples, zero for those without any: a word's is that of its own probability over an
    unknown word's and of its backoff, a longer one's what it changes against the
    shorter one, and its backoff. All tables are grouped and joined by Spark; the driver
    gets the head, sums and the filter.
    """
    spark = docs.sparkSession
    counted, n = Scratch(spark, "trigrams"), F.col("n")
    after_two = Window.partitionBy("a", "b")
    for turn in range(COUNT_ROUNDS):
        counted.add(
            trigram_counts(docs, turn, COUNT_ROUNDS).select(
                "a", "b", "c", "n",
                F.sum("n").over(after_two).alias("total"),
                *[F.count_if(n == i if i < 3 else n >= i).over(after_two).alias(f"n{i}") for i in (1, 2, 3)],
                (F.min("c").over(after_two) == F.col("c")).alias("one_of_two"),
            )
        )
    taken = discounts(_counts_of_counts(counted.rows(), "n"))
    off = sum(F.col(f"n{i}") * one for i, one in enumerate(taken, 1))
    trigrams = counted.rows().select(
        "a", "b", "c", "n", "total", "one_of_two",
        ((n - _off("n", taken)) / F.col("total")).alias("own"),
        F.log10(off / F.col("total")).alias("two_backoff"),
    )
    # Lower orders count in how many contexts a pair or word occurs, not how often.
    paired = Scratch(spark, "pairs")
    for turn in range(ROUNDS):
        mine = _of_round(counted.rows(), "b", turn)
        paired.add(mine.groupBy("b", "c").agg(F.count("*").alias("n"), F.sum("n").alias("times")))
    pairs = paired.rows()
    # A pair occurs before a word as often as at all, unless it has the start or the end.
    backoffs = Scratch(spark, "after-two")
    backoffs.add(
        trigrams.where("one_of_two").select(
            F.xxhash64("a", "b").alias("key"), F.col("two_backoff").alias("weight"), F.col("total").alias("times")
        )
    )
    pair_taken = discounts(_counts_of_counts(pairs, "n"))
    one_word = Scratch(spark, "after-one")
    one_word.add(
        pairs.groupBy("b").agg(
            F.log10(F.sum(_off("n", pair_taken)) / F.sum("n")).alias("backoff"),
            F.sum("n").alias("pair_total"),
            F.sum("times").alias("word_times"),
        )
    )
    after_one = one_word.rows()
    singles = Scratch(spark, "singles")
    singles.add(pairs.groupBy("c").agg(F.count("*").alias("n"), F.sum("times").alias("times")))
    single = singles.rows()
    single_taken = discounts(_counts_of_counts(single, "n"))
    sums = single.agg(
        F.count("*").alias("words"), F.sum("n").alias("n"), F.sum(_off("n", single_taken)).alias("off")
    ).first()
    unknown = (sums["off"] / sums["n"] if sums["n"] else 1.0) / (sums["words"] + 1)
    own = (F.col("n") - _off("n", single_taken)) / F.lit(float(sums["n"] or 1)) + F.lit(unknown)
    words = single.select("c", F.log10(own).alias("word_log"), "times")

    pair = F.log10(
        (F.col("n") - _off("n", pair_taken)) / F.col("pair_total")
        + F.pow(F.lit(10.0), F.col("backoff") + F.col("word_log"))
    )
    logged = Scratch(spark, "pair-logs")
    logged.add(
        pairs.join(lookup_side(after_one.drop("word_times")), "b")
        .join(lookup_side(words.drop("times")), "c")
        .select(
            "b", "c", pair.alias("pair_log"),
            (pair - F.col("backoff") - F.col("word_log")).alias("weight"),
            "times",
        )
    )
    paired.delete()
    pair_logs = logged.rows()
    triple = F.log10(F.col("own") + F.pow(F.lit(10.0), F.col("two_backoff") + F.col("pair_log")))
    found = Scratch(spark, "grams")
    for turn in range(ROUNDS):
        logs = _of_round(pair_logs.select("b", "c", "pair_log"), "b", turn)
        mine = _of_round(trigrams, "b", turn).join(logs, ["b", "c"])
        weight = triple - F.col("two_backoff") - F.col("pair_log")
        found.add(_grams(mine, F.xxhash64("a", "b", "c"), weight, "n"))
    weight = F.col("word_log") - math.log10(unknown)
    found.add(_grams(words, F.xxhash64("c"), weight, "times"))
    found.add(_grams(after_one, F.xxhash64("b"), F.col("backoff"), "word_times"))
    found.add(_grams(pair_logs, F.xxhash64("b", "c"), F.col("weight"), "times"))
    found.add(_grams(backoffs.rows(), F.col("key"), F.col("weight"), "times"))
    for done in (counted, backoffs, logged, one_word, singles):
        done.delete()
    # An n-gram that is a context too has two rows, equal in their times.
    grams = found.rows()
    level, size, in_head = _level_of_head(grams, head)
    top = F.lit(False) if level is None else _times() >= level
    table = grams.where(top).select("key", "weight").toArrow()
    keys, weights = table["key"].to_numpy(), table["weight"].to_numpy()
    keys, place = np.unique(keys, return_inverse=True)
    weights = np.bincount(place, weights, len(keys)).astype(np.float32)
    rest = grams.where(~top).select("key", "weight")
    model = Model(
        Words(), sums["words"], math.log10(unknown), keys, weights,
        size > in_head, _seen(rest, size - in_head),
    )
    return model, rest


def _of_round(frame: DataFrame, column: str, turn: int) -> DataFrame:
    return frame.where(F.pmod(column, F.lit(ROUNDS)) == turn)


def _grams(frame: DataFrame, key: Column, weight: Column, times: str) -> DataFrame:
    return frame.select(
        key.alias("key"), weight.alias("weight"), F.col(times).cast("bigint").alias("times")
    )


def _times() -> Column:
    return F.least(F.col("times"), F.lit(1 << 20))


def _level_of_head(grams: DataFrame, head: int) -> tuple[int | None, int, int]:
    """How often the head's n-grams occur at least, without any tie left halfway; all, and the head's."""
    rows = sorted(grams.groupBy(_times().alias("level")).count().collect(), reverse=True)
    taken, least = 0, None
    for row in rows:
        if taken + row["count"] > head:
            break
        taken += row["count"]
        least = row["level"]
    return least, sum(row["count"] for row in rows), taken


def _seen(grams: DataFrame, count: int) -> np.ndarray | None:
    """A bit for each key's last digits, gathered in pages; None if hardly any would be zero."""
    space = 1 << PAGE_BITS
    while space < FILTER_BITS * count and space < MOST_FILTER_BITS:
        space *= 2
    if not count or count > space:
        return None
    size = 1 << PAGE_BITS

    def page(table: pa.Table) -> pa.Table:
        bits = np.zeros(size, bool)
        bits[table["at"].to_numpy()] = True
        return pa.table(
            {"page": table["page"][:1], "bits": pa.array([np.packbits(bits).tobytes()], pa.binary())}
        )

    place = F.col("key").bitwiseAND(F.lit(space - 1))
    pages = grams.select(
        place.bitwiseAND(F.lit(size - 1)).cast("int").alias("at"),
        F.shiftright(place, PAGE_BITS).cast("int").alias("page"),
    )
    found = np.zeros(space // 8, np.uint8)
    for row in pages.groupBy("page").applyInArrow(page, "page int, bits binary").toLocalIterator():
        at = row["page"] * (size // 8)
        found[at : at + size // 8] = np.frombuffer(row["bits"], np.uint8)
    return found


def log_probabilities(docs: DataFrame, model: Model, grams: DataFrame) -> DataFrame:
    """``doc_id, lang, n_tokens, log10_prob`` of all documents.

    N-grams that no trusted text has, and frequent ones, are settled next to the text.
    The rest go out by document, each with its number of times, and are joined with the
    sharded table.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        model = shared.value
        words = Words()
        for batch in batches:
            at = 0
            for texts in _pieces(batch["text"]):
                mine = slice(at, at + len(texts))
                at += len(texts)
                numbers, ends = words.of([tokens(text) for text in texts])
                sizes = np.diff(ends, prepend=0)
                yield {
                    "doc_id": batch["doc_id"][mine],
                    "lang": [None if one is None else one.decode() for one in batch["lang"][mine]],
                    "n_tokens": sizes,
                    **_settled(model, numbers, ends, sizes),
                }

    rows = docs.select(
        F.col("doc_id").cast("bigint"), F.col("lang").cast("string"), F.col("text").cast("string")
    )
    asked = [f"keys{turn} array<bigint>, times{turn} array<int>" for turn in range(ROUNDS)]
    schema = ", ".join(["doc_id bigint, lang string, n_tokens bigint, known double", *asked])
    local = in_python(rows, work, schema)
    columns = ("doc_id", "lang", "n_tokens")
    if not model.rest:
        return local.select(*columns, F.col("known").alias("log10_prob"))
    local = written(local.withColumn("row", F.monotonically_increasing_id()), "local")
    more = Scratch(docs.sparkSession, "more")
    for turn in range(ROUNDS):
        mine = local.select("row", F.explode(F.arrays_zip(f"keys{turn}", f"times{turn}")).alias("at"))
        open_ = mine.select(
            "row", F.col(f"at.keys{turn}").alias("key"), F.col(f"at.times{turn}").alias("times")
        )
        more.add(
            open_.join(_of_round(grams, "key", turn), "key").groupBy("row").agg(
                F.sum(F.col("times") * F.col("weight")).alias("more")
            )
        )
    joined = more.rows().groupBy("row").agg(F.sum("more").alias("more"))
    return local.join(joined, "row", "left").select(
        *columns, (F.col("known") + F.coalesce("more", F.lit(0.0))).alias("log10_prob")
    )


def _settled(model: Model, numbers: np.ndarray, ends: np.ndarray, sizes: np.ndarray) -> dict:
    """Per text what its n-grams in the head sum up to, and the others that may have weights."""
    a, b = contexts(numbers, ends, START)
    count = len(ends)
    texts = np.arange(count)
    by_token = np.repeat(texts, sizes)
    begin = np.full(count, START, np.int64)  # the start is a context of its own, once a text
    grams = [
        (gram_key(numbers), by_token), (gram_key(b, numbers), by_token), (gram_key(a, b, numbers), by_token),
        (gram_key(begin), texts), (gram_key(begin, begin), texts),
    ]
    known = model.unknown * sizes
    keys, places = [], []
    for found, text in grams:
        left = np.ones(len(found), bool)
        if len(model.head):
            at = np.searchsorted(model.head, found).clip(0, len(model.head) - 1)
            there = model.head[at] == found
            known += np.bincount(text[there], model.head_weight[at[there]], count)
            left = ~there
        if not model.rest:
            continue
        if model.seen is not None:
            place = found & (8 * len(model.seen) - 1)
            left &= ((model.seen[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1).astype(bool)
        keys.append(found[left])
        places.append(text[left])
    found = {"known": known}
    if not keys:
        none = [np.zeros(0, np.int64)] * count
        return found | {f"{name}{turn}": none for name in ("keys", "times") for turn in range(ROUNDS)}
    key, text = np.concatenate(keys), np.concatenate(places)
    order = np.lexsort((key, text))
    key, text = key[order], text[order]
    first = np.ones(len(key), bool)
    first[1:] = (key[1:] != key[:-1]) | (text[1:] != text[:-1])
    first = np.nonzero(first)[0]
    times = np.diff(first, append=len(key)).astype(np.int32)
    key, text = key[first], text[first]
    for turn in range(ROUNDS):
        mine = key % ROUNDS == turn
        cuts = np.searchsorted(text[mine], np.arange(count + 1))
        for name, values in (("keys", key[mine]), ("times", times[mine])):
            found[f"{name}{turn}"] = [values[x:y] for x, y in zip(cuts, cuts[1:])]
    return found


def quality(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """``doc_id, lang, n_tokens, log10_prob, perplexity, limit, kept``, one row per document.

    Trusted texts are those labelled ``quality`` 1 and not ``toxic``. Four in five teach
    the model (by crc32 of doc_id); the perplexities of the fifth set each language's
    limit at ``quantile`` (approximate, to a ten-thousandth of the ranks). A language, NULL
    included, with fewer than 20 of these takes the limit over all; without any trusted
    text there is no limit, and all are kept.

    The model is over whole words and the end of the text, however many there are; a word
    that no text of the model has shares what unseen words get. Words and n-grams go by
    64-bit hashes. NULL texts are empty (the end alone). Repeated rows and NULL doc_ids
    are judged each; NULL doc_ids are never trusted. Other columns are not read.
    """
    good = (F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)
    trusted = written(
        labels.where(good & F.col("doc_id").isNotNull())
        .select(
            F.col("doc_id").cast("bigint").alias("doc_id"),
            (F.crc32(F.col("doc_id").cast("string").cast("binary")) % MEASURED == 0).alias("measured"),
        )
        .distinct(),
        "trusted",
    )

    def among(frame: DataFrame, measured: bool) -> DataFrame:
        ids = lookup_side(
            trusted.where(F.col("measured") == measured).select(F.col("doc_id").alias("_id"))
        )
        return frame.join(ids, frame["doc_id"] == ids["_id"], "left_semi")

    model, grams = fit(among(docs, False))
    perplexity = F.pow(F.lit(10.0), -F.col("log10_prob") / F.col("n_tokens"))
    rows = written(
        log_probabilities(docs, model, grams).withColumn("perplexity", perplexity), "perplexities"
    )
    measured = among(rows, True)
    limit = F.percentile_approx("perplexity", quantile, 10_000).alias("own_limit")
    by_language = measured.groupBy(F.col("lang").alias("_lang")).agg(limit, F.count("*").alias("n"))
    overall = measured.agg(limit).first()[0]
    limits = lookup_side(by_language.where(F.col("n") >= LEAST_TEXTS).select("_lang", "own_limit"))
    limit = F.coalesce("own_limit", F.lit(overall).cast("double"))
    return rows.join(limits, rows["lang"].eqNullSafe(limits["_lang"]), "left").select(
        "doc_id",
        "lang",
        "n_tokens",
        "log10_prob",
        "perplexity",
        limit.alias("limit"),
        F.coalesce(F.col("perplexity") <= limit, F.lit(True)).alias("kept"),
    )
