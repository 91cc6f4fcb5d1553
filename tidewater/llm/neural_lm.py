"""Texts scored by a log-bilinear language model, fitted by noise-contrastive estimation."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from tidewater.llm.common import in_python, written

# The most frequent words are predicted each; all others as classes by their last bytes,
# and within a class by their counts.
OWN_WORDS, CLASSES, SUFFIX = 384, 128, 3
# Words whose counts every worker holds; the counts of others are joined.
HEAD_WORDS = 200_000
DIMENSIONS, CONTEXT = 16, 2
NOISE, BATCH, RATE, ROUNDS = 32, 2048, 0.15, 2
SMOOTH = 0.1
END = b"\n"  # the token behind each text; no word has a line feed
COUNTER_WORDS = 400_000
NUMBER = np.dtype("<u2")  # of a word or class of the model


def tokens(text: bytes | None) -> list[bytes]:
    found = (text or b"").lower().split()
    found.append(END)
    return found


def is_held_out(doc_id: Column) -> Column:
    """crc32 of the id as text is divisible by 10; NULL is the empty text, so held out."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 10 == 0


def word_counts(docs: DataFrame) -> DataFrame:
    """``word, c`` of all tokens, summed up in every task before the shuffle."""

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        counts: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch["text"]:
                counts.update(tokens(text))
            if len(counts) > COUNTER_WORDS:
                yield _as_columns(counts)
                counts = Counter()
        yield _as_columns(counts)

    rows = in_python(docs.select(F.col("text").cast("string")), work, "word string, c bigint")
    return rows.groupBy("word").agg(F.sum("c").cast("bigint").alias("c"))


def _as_columns(counts: Counter) -> dict:
    return {"word": [word.decode() for word in counts], "c": list(counts.values())}


@dataclass
class Vocabulary:
    """Counts of the head words, and the number every token has in the model."""

    total: int
    distinct: int
    counts: dict[bytes, int]  # head words
    own: dict[bytes, int]  # word to number
    classes: dict[bytes, int]  # last bytes to number
    unit_counts: np.ndarray  # training tokens of each number
    class_sizes: np.ndarray  # training tokens and 0.1 per word, one unseen included; 0 for words

    @property
    def size(self) -> int:
        return len(self.unit_counts)

    def number(self, word: bytes) -> int:
        found = self.own.get(word)
        return self.classes.get(word[-SUFFIX:], len(self.own)) if found is None else found


def _level(count: Column) -> Column:
    """A coarse logarithm, exact for small counts: few values, in the order of the counts."""
    return F.when(count < 4096, count).otherwise(F.floor(F.log(count) * 400) + 4096).cast("bigint")


def vocabulary(
    counts: DataFrame,
    head: int = HEAD_WORDS,
    own_words: int = OWN_WORDS,
    suffix_classes: int = CLASSES,
) -> Vocabulary:
    """From a written table ``word, c``. The driver gets at most ``head`` words."""
    levels = counts.groupBy(_level(F.col("c")).alias("level")).agg(
        F.count("*").alias("words"), F.sum("c").alias("tokens")
    )
    rows = sorted(levels.collect(), reverse=True)
    total, distinct = sum(r["tokens"] for r in rows), sum(r["words"] for r in rows)
    taken, least = 0, None
    for row in rows:
        taken += row["words"]
        if taken > head:
            break
        least = row["level"]
    known = [] if least is None else counts.where(_level(F.col("c")) >= least).collect()
    in_head = {row["word"].encode(): row["c"] for row in known}
    ranked = sorted(in_head.items(), key=lambda item: (item[1], item[0]), reverse=True)
    frequent = [word for word, _ in ranked if word != END][: own_words - 1]
    own = {word: i for i, word in enumerate([END, *frequent])}
    suffixes: Counter[bytes] = Counter()
    for word, n in ranked:
        if word not in own:
            suffixes[word[-SUFFIX:]] += n
    best = sorted(suffixes.items(), key=lambda item: (item[1], item[0]), reverse=True)
    classes = {suffix: len(own) + 1 + i for i, (suffix, _) in enumerate(best[: suffix_classes - 1])}
    draft = Vocabulary(total, distinct, in_head, own, classes, np.zeros(0), np.zeros(0))

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        n, v = Counter(), Counter()
        for batch in batches:
            for word, c in zip(batch["word"], batch["c"]):
                number = draft.number(word)
                n[number] += c
                v[number] += 1
        yield {"number": list(n), "n": list(n.values()), "v": [v[number] for number in n]}

    size = len(own) + 1 + len(classes)
    sums = in_python(counts, work, "number int, n bigint, v bigint")
    unit, words = np.zeros(size), np.zeros(size)
    for row in sums.groupBy("number").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect():
        unit[row["number"]], words[row["number"]] = row["n"], row["v"]
    sizes = unit + SMOOTH * (words + 1)
    sizes[: len(own)] = 0
    draft.unit_counts, draft.class_sizes = unit, sizes
    return draft


class LogBilinear:
    """score(w | a, b) = (r_a C_1 + r_b C_2) . o_w + bias_w, for the two tokens before w."""

    def __init__(self, size: int, unit_counts: np.ndarray, parameters: np.ndarray | None = None):
        random = np.random.default_rng(1)
        shapes = [(size + 1, DIMENSIONS), (size, DIMENSIONS), *[(DIMENSIONS, DIMENSIONS)] * CONTEXT]
        self.size, self.start = size, size  # what stands before a text
        if parameters is None:
            parts = [random.normal(0, 0.3, shape) for shape in shapes[:2]]
            parts += [np.eye(DIMENSIONS) / (i + 1) for i in range(CONTEXT)]
            shares = (unit_counts + SMOOTH) / (unit_counts + SMOOTH).sum()
            parameters = np.concatenate([part.ravel() for part in (*parts, np.log(shares))])
        self.all = np.array(parameters, np.float32)
        views, at = [], 0
        for shape in (*shapes, (size,)):
            n = math.prod(shape)
            views.append(self.all[at : at + n].reshape(shape))
            at += n
        self.context, self.target, *self.moves, self.bias = views

    def query(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (self.context @ self.moves[1])[a] + (self.context @ self.moves[0])[b]

    def log_totals(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Log of the summed exponentials over all tokens: makes scores probabilities."""
        found = np.empty(len(a))
        for at in range(0, len(a), 4096):
            scores = self.query(a[at : at + 4096], b[at : at + 4096]) @ self.target.T + self.bias
            top = scores.max(axis=1)
            found[at : at + 4096] = top + np.log(np.exp(scores - top[:, None]).sum(axis=1))
        return found


class NoiseContrastive:
    """Learns to tell a batch's tokens from tokens drawn by their counts."""

    def __init__(self, model: LogBilinear, unit_counts: np.ndarray, seed: int):
        self.model, self.random = model, np.random.default_rng(seed)
        shares = (unit_counts + SMOOTH) / (unit_counts + SMOOTH).sum()
        self.cumulative = np.cumsum(shares)
        self.log_noise = np.log(NOISE * shares).astype(np.float32)
        self.squares = np.full(model.all.shape, 1e-3, np.float32)
        self.slope = LogBilinear(model.size, unit_counts, np.zeros(model.all.shape))

    @staticmethod
    def _scattered(where: np.ndarray, rows: np.ndarray, size: int) -> np.ndarray:
        return np.stack([np.bincount(where, rows[:, d], size) for d in range(rows.shape[1])], axis=1)

    def step(self, a: np.ndarray, b: np.ndarray, w: np.ndarray) -> None:
        m, g = self.model, self.slope
        drawn = np.searchsorted(self.cumulative, self.random.random(NOISE)).clip(0, m.size - 1)
        first, second = m.context[a], m.context[b]
        query = first @ m.moves[1] + second @ m.moves[0]
        target = m.target[w]
        true = np.einsum("bd,bd->b", query, target) + m.bias[w] - self.log_noise[w]
        miss = 1 / (1 + np.exp(true.clip(-30, 30)))
        noise = query @ m.target[drawn].T + (m.bias - self.log_noise)[drawn]
        false = -1 / (1 + np.exp((-noise).clip(-30, 30)))
        to_query = miss[:, None] * target + false @ m.target[drawn]
        g.target[:] = self._scattered(w, miss[:, None] * query, m.size)
        np.add.at(g.target, drawn, false.T @ query)
        g.bias[:] = np.bincount(w, miss, m.size)
        np.add.at(g.bias, drawn, false.sum(axis=0))
        g.moves[1][:], g.moves[0][:] = first.T @ to_query, second.T @ to_query
        g.context[:] = self._scattered(a, to_query @ m.moves[1].T, m.size + 1)
        g.context += self._scattered(b, to_query @ m.moves[0].T, m.size + 1)
        slope = g.all / len(w)
        self.squares += slope * slope
        m.all += RATE * slope / np.sqrt(self.squares)


def contexts(numbers: np.ndarray, ends: np.ndarray, start: int):
    """The two tokens before each one; ``start`` before a text's first."""
    a, b = np.full(len(numbers), start), np.full(len(numbers), start)
    b[1:], a[2:] = numbers[:-1], numbers[:-2]
    first = np.concatenate(([0], ends[:-1]))
    b[first] = start
    a[first] = start
    second = first + 1
    a[second[second < ends]] = start
    return a, b


def train(rows: DataFrame, words: Vocabulary, rounds: int = ROUNDS) -> np.ndarray:
    """Parameters learned from all tokens of these rows of ``numbered``.

    Every task runs through its own texts from the same start; the results are
    averaged, weighted by tokens, and the next round starts from there. What the
    driver gets is one set of parameters a round.
    """
    shared = rows.sparkSession.sparkContext.broadcast(words.unit_counts)
    parameters = None
    for turn in range(rounds):
        begin = parameters

        def work(batches: Iterator[dict], begin=begin, turn=turn) -> Iterator[dict]:
            unit_counts = shared.value
            model = LogBilinear(len(unit_counts), unit_counts, begin)
            learner = NoiseContrastive(model, unit_counts, turn)
            seen = 0
            for batch in batches:
                numbers, ends = _numbers_of(batch)
                a, b = contexts(numbers, ends, model.start)
                order = learner.random.permutation(len(numbers))
                for at in range(0, len(order), BATCH):
                    some = order[at : at + BATCH]
                    learner.step(a[some], b[some], numbers[some])
                seen += len(numbers)
            n = len(model.all) if seen else 0
            yield {"i": np.arange(n), "v": model.all[:n] * float(seen), "n": np.full(n, seen)}

        learned = in_python(rows.select("numbers"), work, "i int, v double, n bigint")
        means = learned.groupBy("i").agg((F.sum("v") / F.sum("n")).alias("v"))
        found = sorted((row["i"], row["v"]) for row in means.collect())
        if not found:
            break
        parameters = np.array([value for _, value in found], np.float32)
    return LogBilinear(words.size, words.unit_counts, parameters).all


class Numbers:
    """Numbers of tokens, those of head words by one lookup each."""

    def __init__(self, words: Vocabulary):
        self.words = words
        self.head = {word: i for i, word in enumerate(words.counts)}
        self.numbers = np.array([words.number(word) for word in words.counts], np.int64)

    def of(self, texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        flat = [word for text in texts for word in text]
        get = self.head.get
        place = np.array([get(word, -1) for word in flat], np.int64)
        self.place, self.flat = place, flat
        numbers = self.numbers[place] if len(self.numbers) else np.zeros(len(flat), np.int64)
        for at in np.nonzero(place < 0)[0].tolist():
            numbers[at] = self.words.number(flat[at])
        return numbers, np.cumsum([len(text) for text in texts])


def _numbers_of(batch: dict) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(one) for one in batch["numbers"]], np.int64) // NUMBER.itemsize
    numbers = np.frombuffer(b"".join(batch["numbers"]), NUMBER).astype(np.int64)
    return numbers, np.cumsum(sizes)


def numbered(docs: DataFrame, words: Vocabulary) -> DataFrame:
    """``row, doc_id, held_out, n_tokens, known, base, inside, numbers, tail``, written.

    All that texts themselves are needed for, so that they are split once: the number of each
    token (16 bits each, in one value), the sums of the head words' logs (``base``) and of
    the shares of words in their classes (``inside``), and the words outside the head.
    """
    if words.size > np.iinfo(NUMBER).max:
        raise ValueError("more words and classes than numbers of 16 bits")
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        words = shared.value
        lookup = Numbers(words)
        head_logs = np.log10(np.array([*words.counts.values(), 0], np.float64) + SMOOTH)
        class_logs = np.zeros(words.size)
        is_class = words.class_sizes > 0
        class_logs[is_class] = np.log10(words.class_sizes[is_class])
        for batch in batches:
            numbers, ends = lookup.of([tokens(text) for text in batch["text"]])
            starts = np.concatenate(([0], ends[:-1])).astype(np.int64)
            known = lookup.place >= 0
            logs = np.where(known, head_logs[lookup.place], 0.0)
            inside = np.where(is_class[numbers], logs - class_logs[numbers], 0.0)
            narrow = numbers.astype(NUMBER)
            tail = np.nonzero(~known)[0]
            cuts = np.searchsorted(tail, np.concatenate((starts, ends[-1:])))
            yield {
                "doc_id": batch["doc_id"],
                "held_out": batch["held_out"],
                "n_tokens": ends - starts,
                "known": np.add.reduceat(known.astype(np.int64), starts),
                "base": np.add.reduceat(logs, starts),
                "inside": np.add.reduceat(inside, starts),
                "numbers": [narrow[x:y].tobytes() for x, y in zip(starts, ends)],
                "tail": [
                    [lookup.flat[at].decode() for at in tail[x:y]] for x, y in zip(cuts, cuts[1:])
                ],
            }

    rows = docs.select(
        F.col("doc_id").cast("bigint"),
        is_held_out(F.col("doc_id").cast("bigint")).alias("held_out"),
        F.col("text").cast("string"),
    )
    schema = (
        "doc_id bigint, held_out boolean, n_tokens bigint, known bigint, base double, "
        "inside double, numbers binary, tail array<string>"
    )
    found = in_python(rows, work, schema).withColumn("row", F.monotonically_increasing_id())
    return written(found, "numbered")


def scores(rows: DataFrame, words: Vocabulary, parameters: np.ndarray, counts: DataFrame) -> DataFrame:
    """One row per row of ``numbered``; see ``score_texts``."""
    shared = rows.sparkSession.sparkContext.broadcast((words.unit_counts, parameters))

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        unit_counts, parameters = shared.value
        model = LogBilinear(len(unit_counts), unit_counts, parameters)
        width = model.size + 1
        totals = np.full(width * width, np.nan)
        in_first = model.context @ model.moves[1]
        in_second = model.context @ model.moves[0]
        for batch in batches:
            numbers, ends = _numbers_of(batch)
            a, b = contexts(numbers, ends, model.start)
            pair = a * width + b
            need = np.zeros(width * width, bool)
            need[pair] = True
            need = np.nonzero(need & np.isnan(totals))[0]
            totals[need] = model.log_totals(need // width, need % width)
            raw = np.empty(len(pair))
            for at in range(0, len(pair), 1 << 16):
                part = slice(at, at + (1 << 16))
                query = in_first[a[part]] + in_second[b[part]]
                raw[part] = np.einsum("bd,bd->b", query, model.target[numbers[part]])
            raw += model.bias[numbers] - totals[pair]
            starts = np.concatenate(([0], ends[:-1])).astype(np.int64)
            sums = np.add.reduceat(raw / math.log(10), starts)
            yield {**{name: batch[name] for name in passed}, "raw": sums}

    passed = ("row", "doc_id", "held_out", "n_tokens", "known", "base", "inside")
    schema = (
        "row bigint, doc_id bigint, held_out boolean, n_tokens bigint, known bigint, "
        "base double, inside double, raw double"
    )
    local = in_python(rows.select(*passed, "numbers"), work, schema)
    rare = rows.select("row", F.explode("tail").alias("word")).join(counts, "word", "left")
    sums = rare.groupBy("row").agg(
        F.sum(F.log10(F.coalesce("c", F.lit(0)) + SMOOTH)).alias("tail_log"),
        F.count("c").alias("tail_known"),
    )
    tail_log = F.coalesce("tail_log", F.lit(0.0))
    base_size = math.log10(words.total + SMOOTH * (words.distinct + 1))
    return local.join(sums, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
        F.lit(words.total).cast("bigint").alias("train_tokens"),
        (F.col("base") + tail_log - F.col("n_tokens") * base_size).alias("base_score"),
        (F.col("raw") + F.col("inside") + tail_log).alias("score"),
    )


def score_texts(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    Learns from all documents whose crc32 of doc_id is not divisible by 10 and scores all.
    ``score`` is the log10 probability of the whole text and its end: the model's
    probability of each token or, for words outside its own ones, of the word's class,
    normalised over all of them, times the word's smoothed share of its class (one share
    of each class is for unseen words). ``base_score`` is the smoothed unigram score.
    Scores of frequent words are made next to the text; the counts of rare ones are
    joined by word.

    NULL text is empty: the end alone. NULL doc_ids are held out; repeated rows are
    learned from and scored each. With nothing to learn from, the base score is 0 and the
    model is at its start. Other columns are not read.
    """
    learned = docs.where(~is_held_out(F.col("doc_id").cast("bigint")))
    counts = written(word_counts(learned), "words")
    words = vocabulary(counts)
    rows = numbered(docs, words)
    return scores(rows, words, train(rows.where("not held_out"), words), counts)
