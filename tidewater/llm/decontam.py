"""Benchmark items leaked into documents: BM25 over an inverted index, block-max WAND."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import DataFrame, functions as F

from tidewater.llm.common import filtered, in_python, words_of, written

K1, B = 1.2, 0.75
PASSAGE_WORDS = 128
# Score above which a passage retrieves an item, as a share of what the item itself scores.
THRESHOLD = 0.6
OVERLAP = 0.8
BLOCK = 8
# Words of benchmark items in one index; beyond it, several are searched in turn.
INDEX_WORDS = 2_000_000
_PLAIN = bytes(
    ord(chr(c).lower()) if c < 128 and chr(c).isalnum() else c if c >= 128 else 32
    for c in range(256)
)


def plain_words(text: bytes | None) -> list[bytes]:
    """Words in lower-case A-Z, with all other ASCII signs as blanks."""
    return (text or b"").translate(_PLAIN).split()


class Index:
    """Posting lists of entries (parts of items), for one score threshold.

    A posting's impact is the term's BM25 weight in the entry, divided by what the
    entry's own words score: an entry that a passage holds whole scores 1.

    Search is by WAND over blocks of entries. An entry's essential terms are its rarest
    ones, so many that all others together stay below the threshold: without one of them
    the entry cannot reach it, so pivots come from the lists of essential terms alone. A
    pivot's block is skipped if the maxima of all terms' blocks do not reach the threshold.
    """

    def __init__(
        self, postings: Sequence[tuple[int, bytes, float]], threshold: float, block: int = BLOCK
    ):
        by_entry: dict[int, list[tuple[bytes, float]]] = {}
        frequency = Counter(term for _, term, _ in postings)
        for entry, term, impact in postings:
            by_entry.setdefault(entry, []).append((term, impact))
        self.block, self.threshold = block, threshold - 1e-9
        self.number = {term: i for i, term in enumerate(sorted(frequency))}
        self.impacts: list[dict[int, float]] = [{} for _ in frequency]
        self.block_max: list[dict[int, float]] = [{} for _ in frequency]
        self.pivots: list[list[int]] = [[] for _ in frequency]
        for entry, terms in sorted(by_entry.items()):
            # Of equally frequent words, long ones are rarer in text.
            terms.sort(key=lambda item: (frequency[item[0]], -len(item[0]), item[0]))
            left = sum(impact for _, impact in terms)
            for term, impact in terms:
                number = self.number[term]
                self.impacts[number][entry] = impact
                top = self.block_max[number]
                top[entry // block] = max(impact, top.get(entry // block, 0.0))
                if left >= self.threshold:
                    self.pivots[number].append(entry)
                left -= impact
        self.essential = np.array([bool(entries) for entries in self.pivots] + [False])

    def above(self, terms: Sequence[int]) -> dict[int, float]:
        """All entries that score the threshold or more for the distinct terms."""
        found: dict[int, float] = {}
        at, bound = -1, 0.0
        for entry in sorted({entry for term in terms for entry in self.pivots[term]}):
            if entry // self.block != at:
                at = entry // self.block
                bound = sum(self.block_max[term].get(at, 0.0) for term in terms)
            if bound < self.threshold:
                continue
            score = sum(self.impacts[term].get(entry, 0.0) for term in terms)
            if score >= self.threshold:
                found[entry] = score
        return found


def share_found(wanted: Counter, there: Counter) -> float:
    """Share of the wanted words, repeats counted, that are there; 1 if none is wanted."""
    total = sum(wanted.values())
    return sum(min(n, there[word]) for word, n in wanted.items()) / total if total else 1.0


class Searcher:
    """Searches one document for all entries of an index."""

    def __init__(self, postings, items, passage_words, threshold, overlap):
        self.index = Index(postings, threshold)
        # entry -> (item, question, answer, words of both)
        self.items = {
            entry: (item, Counter(question), Counter(answer), len(question) + len(answer))
            for entry, item, question, answer in items
        }
        self.words, self.overlap = passage_words, overlap

    def leaks(self, text: bytes | None) -> dict[int, tuple[float, float, float]]:
        """``item -> (score, question overlap, answer overlap)`` of each verified leak."""
        words = plain_words(text)
        get, none = self.index.number.get, len(self.index.number)
        terms = np.array([get(word, none) for word in words], np.int64)
        if not (terms < none).any():
            return {}
        # Passages without an essential term of any entry, all at once.
        sums = np.concatenate(([0], np.cumsum(self.index.essential[terms])))
        step = self.words // 2
        starts = np.arange(0, max(1, len(words) - step), step)
        stops = np.minimum(starts + self.words, len(words))
        best: dict[int, tuple[float, float, float]] = {}
        for at in np.nonzero(sums[stops] > sums[starts])[0]:
            start, stop = int(starts[at]), int(stops[at])
            here = set(terms[start:stop].tolist())
            here.discard(none)
            for entry, score in self.index.above(sorted(here)).items():
                item, question, answer, length = self.items[entry]
                more = max(0, length - step)
                there = Counter(words[max(0, start - more) : stop + more])
                q, a = share_found(question, there), share_found(answer, there)
                if min(q, a) >= self.overlap and (item not in best or best[item] < (score, q, a)):
                    best[item] = (score, q, a)
        return best


def index_entries(items: DataFrame, passage_words: int = PASSAGE_WORDS) -> DataFrame:
    """``number, entry, term, impact``: the postings of all items, written once.

    ``items`` has ``number, question, answer``. An item with more words than half a
    passage is several entries, so that each lies whole in some passage.
    """

    def cut(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            out: dict[str, list] = {n: [] for n in ("number", "part", "term", "tf", "length")}
            for number, question, answer in zip(batch["number"], batch["question"], batch["answer"]):
                words = plain_words(question) + plain_words(answer)
                size = passage_words // 2
                for part, at in enumerate(range(0, len(words), size)):
                    piece = words[at : at + size]
                    for term, tf in Counter(piece).items():
                        out["number"].append(number)
                        out["part"].append(part)
                        out["term"].append(term.decode("utf-8", "replace"))
                        out["tf"].append(tf)
                        out["length"].append(len(piece))
            yield out

    terms = written(
        in_python(
            items.select("number", "question", "answer"),
            cut,
            "number bigint, part int, term string, tf int, length int",
        ),
        "terms",
    )
    sizes = terms.select("number", "part", "length").distinct()
    total = sizes.agg(F.count("*").alias("n"), F.avg("length").alias("mean")).first()
    df = terms.groupBy("term").agg(F.count("*").alias("df"))
    weight = F.log1p((total["n"] - F.col("df") + 0.5) / (F.col("df") + 0.5)) * (
        F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("length") / (total["mean"] or 1.0)))
    )
    weighted = written(terms.join(df, "term").withColumn("weight", weight), "weights")
    own = weighted.groupBy("number", "part").agg(F.sum("weight").alias("own"))
    return weighted.join(own, ["number", "part"]).select(
        "number", "part", "term", (F.col("weight") / F.col("own")).alias("impact")
    )


def leaks(
    docs: DataFrame,
    items: DataFrame,
    passage_words: int = PASSAGE_WORDS,
    threshold: float = THRESHOLD,
    overlap: float = OVERLAP,
    index_words: int = INDEX_WORDS,
) -> DataFrame:
    """``doc_id, item_id, score, question_overlap, answer_overlap``: items found in documents.

    ``items`` has ``item_id, question, answer``. Every passage of every document (128
    words, one starting each 64) is a query. Passages without an essential term of any item
    retrieve nothing, and are passed over in one array operation; the others go through
    block-max WAND, which gives all entries above the threshold. A retrieved
    item counts if shares of ``overlap`` of its question's and of its answer's words are
    there. The index goes to every task; it holds ``index_words`` words of items at
    most, and more items are searched in several rounds with the same weights.

    NULL texts hold nothing. NULL or empty questions or answers count as found; items
    without any word find nothing. Repeated rows and items are reported each; a NULL
    doc_id or item_id is reported as such. Other columns are not read.
    """
    found = None
    for index in _indexes(items, passage_words, index_words):
        part = _search(docs, index, passage_words, threshold, overlap)
        found = part if found is None else found.unionByName(part)
    return found


def _indexes(items: DataFrame, passage_words: int, index_words: int) -> Iterator[tuple]:
    """The index of each round: postings, entries and item ids."""
    empty = F.lit("")
    numbered = written(
        items.select(
            F.monotonically_increasing_id().alias("number"),
            F.col("item_id").cast("bigint"),
            F.coalesce(F.col("question").cast("string"), empty).alias("question"),
            F.coalesce(F.col("answer").cast("string"), empty).alias("answer"),
        ),
        "items",
    )
    postings = written(index_entries(numbered, passage_words), "postings")
    size = numbered.agg(F.sum(F.size(words_of(F.col("question"))) + F.size(words_of(F.col("answer"))))).first()[0]
    rounds = max(1, -(-(size or 0) // index_words))
    for turn in range(rounds):
        mine = F.pmod(F.xxhash64("number"), F.lit(rounds)) == turn
        yield _gathered(numbered.where(mine), postings.where(mine))


def _gathered(items: DataFrame, postings: DataFrame) -> tuple:
    entries: dict[tuple[int, int], int] = {}
    listed = []
    for row in sorted(postings.collect()):  # bounded by index_words
        key = (row["number"], row["part"])
        listed.append((entries.setdefault(key, len(entries)), row["term"].encode(), row["impact"]))
    ids, texts = {}, {}
    for row in items.collect():
        ids[row["number"]] = row["item_id"]
        texts[row["number"]] = (
            plain_words(row["question"].encode()),
            plain_words(row["answer"].encode()),
        )
    known = [(entry, number, *texts[number]) for (number, _), entry in entries.items()]
    return listed, known, ids


def _search(docs, found_index, passage_words, threshold, overlap) -> DataFrame:
    index = docs.sparkSession.sparkContext.broadcast(found_index)

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        listed, known, ids = index.value
        searcher = Searcher(listed, known, passage_words, threshold, overlap)
        names = ("doc_id", "item_id", "score", "question_overlap", "answer_overlap")
        for batch in batches:
            out: dict[str, list] = {name: [] for name in names}
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                for number, values in sorted(searcher.leaks(text).items()):
                    for name, value in zip(names, (doc_id, ids[number], *values)):
                        out[name].append(value)
            yield out

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return in_python(
        rows,
        work,
        "doc_id bigint, item_id bigint, score double, question_overlap double, answer_overlap double",
    )


def as_question_and_answer(benchmark: DataFrame, answer_share: float = 1 / 3) -> DataFrame:
    """Items given as one text: the last third of the words is taken for the answer."""
    words = words_of(F.col("text").cast("string"))
    cut = F.floor(F.size("words") * (1 - answer_share)).cast("int")
    return benchmark.select("item_id", words.alias("words")).select(
        "item_id",
        F.array_join(F.slice("words", 1, cut), " ").alias("question"),
        F.array_join(F.slice("words", cut + 1, F.size("words")), " ").alias("answer"),
    )


def without_leaks(
    docs: DataFrame,
    items: DataFrame,
    passage_words: int = PASSAGE_WORDS,
    threshold: float = THRESHOLD,
    overlap: float = OVERLAP,
    index_words: int = INDEX_WORDS,
) -> DataFrame:
    """The documents in which no item leaks; of the rest, nothing stays.

    Each row is judged by its own text, whatever its doc_id.
    """
    for found_index in _indexes(items, passage_words, index_words):
        index = docs.sparkSession.sparkContext.broadcast(found_index)

        def make(index=index):
            listed, known, _ = index.value
            searcher = Searcher(listed, known, passage_words, threshold, overlap)
            return lambda texts: [not searcher.leaks(text) for text in texts]

        docs = filtered(docs, make)
    return docs
