"""Language of words and texts by a linear-chain conditional random field."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, functions as F

from tidewater.llm.common import filtered, in_python, words_of

FEATURES = 1 << 16
# Labelled documents per language that the model is fitted on, and words of each.
SAMPLE_DOCUMENTS = 300
SAMPLE_WORDS = 400
SEGMENT, SEGMENTS = 16, 3
EPOCHS, BATCH, RATE, DECAY = 6, 256, 0.3, 1e-4
# A chain is a line; longer lines are worked on in pieces that pass messages on.
CHAIN_WORDS = 256
LEXICON_COUNT = 5
CACHE_WORDS = 200_000
# Forms, and texts, that are worked on at a time.
SLICE, TEXTS = 4_000, 400
UNKNOWN = "und"
SIGNS = ".,;:!?\"'()[]{}|#*$%&<>"


class _FeatureNumbers(dict):
    """Numbers of feature names, kept once computed."""

    def __missing__(self, name: str) -> int:
        if len(self) > CACHE_WORDS:
            self.clear()
        number = self[name] = zlib.crc32(name.encode()) % FEATURES
        return number


_feature_numbers = _FeatureNumbers()


def form_of(word: bytes) -> str:
    """The word in lower case without signs around it; empty if it has no letter."""
    text = word.decode("utf-8", "replace").lower()
    form = text.strip(SIGNS)
    if form.isalpha() or any(map(str.isalpha, text)):
        return form
    return ""


def features(form: str, lexicon: dict[str, tuple[int, ...]]) -> list[int]:
    """Numbers of a form's affixes, letter pairs and triples, and lexicon entries."""
    if not form:
        return []
    framed = f"^{form}$"
    names = {framed[i : i + 2] for i in range(len(framed) - 1)}
    names.update([framed[i : i + 3] for i in range(len(framed) - 2)])
    names.update([f"p{framed[:n]}" for n in (2, 3, 4)])
    names.update([f"s{framed[-n:]}" for n in (2, 3, 4, 5)])
    labels = lexicon.get(form)
    if labels is not None:
        names.update([f"l{label}" for label in labels])
        names.add(f"w{form}")
    return sorted(map(_feature_numbers.__getitem__, names))


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # feature x language
    moves: np.ndarray  # language x language, log
    lexicon: dict[str, tuple[int, ...]]

    def emissions(self, forms: Sequence[str]) -> np.ndarray:
        """Summed weights of each form's features."""
        lists = [features(form, self.lexicon) for form in forms]
        counts = np.array([len(one) for one in lists])
        flat = np.array([f for one in lists for f in one], np.int64)
        return _summed(self.weights[flat], counts)


def _summed(rows: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive groups of rows; zero for empty groups."""
    ends = np.cumsum(counts)
    sums = np.concatenate((np.zeros((1, rows.shape[1])), np.cumsum(rows, axis=0, dtype=np.float64)))
    return sums[ends] - sums[ends - counts]


def posteriors(
    scores: np.ndarray,
    lengths: np.ndarray,
    moves: np.ndarray,
    with_pairs: bool = True,
    before: np.ndarray | float = 1.0,
    after: np.ndarray | float = 1.0,
):
    """Forward-backward over padded chains (chain, position, label).

    Gives each position's label probabilities, and the expected moves of all chains.
    ``before`` and ``after`` (chain, label) are the messages from what stands around a
    piece of a longer chain.
    """
    chains, size, labels = scores.shape
    step = np.exp(moves - moves.max())
    here = np.exp(scores - scores.max(axis=2, keepdims=True))
    inside = np.arange(size)[None, :] < lengths[:, None]
    forward = np.empty_like(here)
    backward = np.empty_like(here)
    backward[:, -1] = after
    now = here[:, 0] * before
    forward[:, 0] = now / now.sum(axis=1, keepdims=True)
    for t in range(1, size):
        now = (forward[:, t - 1] @ step) * here[:, t]
        forward[:, t] = now / now.sum(axis=1, keepdims=True)
    for t in range(size - 2, -1, -1):
        now = (backward[:, t + 1] * here[:, t + 1]) @ step.T
        now /= now.sum(axis=1, keepdims=True)
        backward[:, t] = np.where(inside[:, t + 1, None], now, after)
    found = forward * backward
    found /= found.sum(axis=2, keepdims=True)
    found *= inside[:, :, None]
    pairs = np.zeros((labels, labels))
    if with_pairs and size > 1:
        to = (here * backward)[:, 1:]
        joint = np.einsum("cti,ij,ctj->ct", forward[:, :-1], step, to)
        both = inside[:, 1:] / joint
        pairs = step * np.einsum("cti,ctj,ct->ij", forward[:, :-1], to, both)
    return found, pairs


def passages(scores: np.ndarray, lengths: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Of each piece (chain, position, label), what it does to a message that goes through it.

    A matrix (chain, label at the first position, label at the last), up to a factor.
    """
    step = np.exp(moves - moves.max())
    here = np.exp(scores - scores.max(axis=2, keepdims=True))
    found = np.eye(scores.shape[2]) * here[:, 0][:, :, None]
    for t in range(1, scores.shape[1]):
        now = (found @ step) * here[:, t][:, None, :]
        now /= now.max(axis=(1, 2), keepdims=True)
        found = np.where((t < lengths)[:, None, None], now, found)
    return found


def fit(rows: Sequence[tuple[str, list[bytes]]], seed: int = 0) -> Model:
    """Learn from ``(language, words)`` of documents, by stochastic gradient steps.

    All words of a document carry its language. Chains are made of segments of
    different documents, so that moves between languages are learned too.
    """
    languages = sorted({language for language, _ in rows})
    number = {language: i for i, language in enumerate(languages)}
    counts: dict[str, Counter] = defaultdict(Counter)
    for language, words in rows:
        for word in words:
            counts[form_of(word)][number[language]] += 1
    lexicon = {
        word: tuple(sorted(label for label, n in seen.items() if n >= LEXICON_COUNT))
        for word, seen in counts.items()
        if max(seen.values()) >= LEXICON_COUNT and word
    }
    model = Model(
        languages,
        np.zeros((FEATURES, len(languages)), np.float32),
        np.zeros((len(languages), len(languages))),
        lexicon,
    )
    if len(languages) < 2:
        return model
    random = np.random.default_rng(seed)
    vocabulary: dict[bytes, int] = {}
    segments = []
    for language, words in rows:
        ids = [vocabulary.setdefault(word, len(vocabulary)) for word in words]
        for at in range(0, len(ids), SEGMENT):
            segments.append((number[language], ids[at : at + SEGMENT]))
    lists = [np.array(features(form_of(word), lexicon), np.int64) for word in vocabulary]
    sizes = np.array([len(one) for one in lists])
    starts = np.cumsum(sizes) - sizes
    flat = np.concatenate(lists) if lists else np.zeros(0, np.int64)
    squares = np.full(model.weights.shape, 1e-8, np.float64)
    move_squares = np.full(model.moves.shape, 1e-8)
    for _ in range(EPOCHS):
        order = random.permutation(len(segments))
        chains = [
            [segments[i] for i in order[at : at + SEGMENTS]]
            for at in range(0, len(order), SEGMENTS)
        ]
        for at in range(0, len(chains), BATCH):
            batch = chains[at : at + BATCH]
            lengths = np.array([sum(len(ids) for _, ids in chain) for chain in batch])
            words = np.zeros((len(batch), lengths.max()), np.int64)
            truth = np.zeros_like(words)
            for c, chain in enumerate(batch):
                words[c, : lengths[c]] = [w for _, ids in chain for w in ids]
                truth[c, : lengths[c]] = [label for label, ids in chain for _ in ids]
            used, where = np.unique(words, return_inverse=True)
            n = sizes[used]
            rows_at = np.repeat(starts[used] - np.cumsum(n) + n, n) + np.arange(n.sum())
            active = flat[rows_at]
            scores = _summed(model.weights[active], n)[where.reshape(words.shape)]
            found, pairs = posteriors(scores, lengths, model.moves)
            inside = np.arange(words.shape[1])[None, :] < lengths[:, None]
            onehot = np.eye(len(languages))[truth] * inside[:, :, None]
            error = (onehot - found).reshape(-1, len(languages))
            moves = np.zeros_like(pairs)
            np.add.at(moves, (truth[:, :-1][inside[:, 1:]], truth[:, 1:][inside[:, 1:]]), 1)
            scale = 1 / lengths.sum()
            for label in range(len(languages)):
                by_word = np.bincount(where.ravel(), error[:, label], used.size)
                slope = np.bincount(active, np.repeat(by_word, n), FEATURES) * scale
                slope -= DECAY * model.weights[:, label] * (slope != 0)
                squares[:, label] += slope**2
                model.weights[:, label] += RATE * slope / np.sqrt(squares[:, label])
            slope = (moves - pairs) * scale
            move_squares += slope**2
            model.moves += RATE * slope / np.sqrt(move_squares)
    return model


def _padded(chains: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
    """Some chains at a time, the places of their words, and which of these are theirs."""
    for at in range(0, len(chains), 1024):
        some = chains[at : at + 1024]
        columns = np.arange(lengths[some].max())[None, :]
        yield some, starts[some][:, None] + columns, columns < lengths[some][:, None]


class Labeller:
    """Labels words with a model; remembers the scores of words it has met."""

    def __init__(self, model: Model):
        self.model = model
        self.words: dict[bytes, int] = {}
        self._clear()

    def _clear(self) -> None:
        self.words.clear()
        self.forms = {"": 0}  # the first row is for words without letters
        self.scores = np.zeros((1 << 12, len(self.model.languages)), np.float32)

    def _numbers(self, words: list[bytes]) -> np.ndarray:
        """Each word's row of scores. Full caches keep what the latest texts hold."""
        if len(self.forms) > CACHE_WORDS:
            self._clear()
        distinct = set(words)
        if len(self.words) + len(distinct) > 2 * CACHE_WORDS:
            self.words = {word: self.words[word] for word in distinct if word in self.words}
        forms = {word: form_of(word) for word in distinct.difference(self.words)}
        new = sorted(set(forms.values()).difference(self.forms))
        if new:
            first, need = len(self.forms), len(self.forms) + len(new)
            if need > len(self.scores):
                more = np.zeros((max(need, 2 * len(self.scores)) - len(self.scores), self.scores.shape[1]))
                self.scores = np.concatenate((self.scores, more.astype(np.float32)))
            for at in range(0, len(new), SLICE):  # a form has some twenty features
                some = new[at : at + SLICE]
                self.scores[first + at : first + at + len(some)] = self.model.emissions(some)
            self.forms.update(zip(new, range(first, need)))
        self.words.update({word: self.forms[form] for word, form in forms.items()})
        return np.fromiter(map(self.words.__getitem__, words), np.int64, len(words))

    def _scores(self, ids: np.ndarray, places: np.ndarray) -> np.ndarray:
        return self.scores[ids[np.minimum(places, len(ids) - 1)]].astype(np.float64)

    def _messages(
        self, ids: np.ndarray, starts: np.ndarray, lengths: np.ndarray, goes_on: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """What pieces of one line tell each other; ones where a line begins or ends."""
        moves = self.model.moves
        before = np.ones((len(lengths), len(moves)))
        after = before.copy()
        later = np.nonzero(goes_on)[0]
        if not len(later):
            return before, after
        parts = np.union1d(later, later - 1)
        through = np.empty((len(parts), *moves.shape))
        for some, places, _ in _padded(parts, starts, lengths):
            at = np.searchsorted(parts, some)
            through[at] = passages(self._scores(ids, places), lengths[some], moves)
        step = np.exp(moves - moves.max())
        at = np.searchsorted(parts, later)
        for piece, i in zip(later, at):
            message = before[piece - 1] @ through[i - 1] @ step
            before[piece] = message / message.sum()
        for piece, i in zip(later[::-1], at[::-1]):
            message = step @ (through[i] @ after[piece])
            after[piece - 1] = message / message.sum()
        return before, after

    def label(self, texts: Sequence[bytes | None]):
        """``_label`` of all texts, some at a time."""
        for at in range(0, len(texts), TEXTS):
            yield from self._label(texts[at : at + TEXTS])

    def _label(self, texts: Sequence[bytes | None]):
        """Per text: mean probabilities of the languages, and each word's (NULL: none).

        The mean is over words with letters; None without any.
        """
        words: list[bytes] = []
        chain_sizes: list[int] = []
        goes_on: list[bool] = []
        ends = []
        for text in texts:
            for line in (text or b"").split(b"\n"):
                found = line.split()
                words += found
                full, rest = divmod(len(found), CHAIN_WORDS)
                chain_sizes += [CHAIN_WORDS] * full + [rest] * bool(rest)
                goes_on += [i > 0 for i in range(full + bool(rest))]
            ends.append(len(words))
        ids = self._numbers(words)
        lengths = np.array(chain_sizes, np.int64)
        starts = np.cumsum(lengths) - lengths
        moves = self.model.moves
        shares = np.zeros((len(words), len(self.model.languages)))
        before, after = self._messages(ids, starts, lengths, np.array(goes_on, bool))
        order = np.argsort(lengths, kind="stable")
        for some, places, inside in _padded(order, starts, lengths):
            found, _ = posteriors(
                self._scores(ids, places), lengths[some], moves, False, before[some], after[some]
            )
            shares[places[inside]] = found[inside]
        letters = ids > 0
        counted = shares * letters[:, None]
        begin = 0
        for end in ends:
            n = letters[begin:end].sum()
            mean = counted[begin:end].sum(axis=0) / n if n else None
            yield mean, shares[begin:end], letters[begin:end]
            begin = end


def labelled_sample(
    docs: DataFrame, documents: int = SAMPLE_DOCUMENTS, words: int = SAMPLE_WORDS
) -> list[tuple[str, list[bytes]]]:
    """At most ``documents`` documents per language, ``words`` words from somewhere in each.

    Documents with the least hash of doc_id are taken. Those whose crc32 of doc_id is 1
    modulo 3 are never looked at, nor those without language or doc_id.
    """
    pick = F.xxhash64("doc_id", F.lit("sample"))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("lang").cast("string").alias("lang"),
        F.col("text").cast("string").alias("text"),
    ).where(
        F.col("lang").isNotNull()
        & (F.col("lang") != UNKNOWN)
        & (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1)
    )
    counts = rows.groupBy("lang").agg(F.count("*").alias("n"))
    share = F.least(F.lit(1.0), (1.5 * documents + 20) / F.col("n"))
    # The hash is even over 2^63, so this share of each language's rows is below it.
    likely = rows.join(F.broadcast(counts.select("lang", share.alias("share"))), "lang").where(
        F.pmod(pick, F.lit(1 << 40)) <= F.col("share") * (1 << 40)
    )
    all_words = words_of(F.col("text"))
    start = 1 + F.pmod(F.xxhash64("doc_id"), F.greatest(F.lit(1), F.size("w") - words + 1))
    taken = likely.withColumn("w", all_words).select(
        "lang", pick.alias("pick"), F.slice("w", start.cast("int"), F.lit(words)).alias("w")
    )
    by_language: dict[str, list] = defaultdict(list)
    for row in taken.collect():
        by_language[row["lang"]].append((row["pick"], [word.encode() for word in row["w"]]))
    found = []
    for language, listed in sorted(by_language.items()):
        listed.sort()
        found += [(language, one) for _, one in listed[:documents]]
    return found


def language_model(docs: DataFrame) -> Model:
    """The model fitted on the labelled sample of these documents."""
    return fit(labelled_sample(docs))


def identify(docs: DataFrame, model: Model, with_words: bool = False) -> DataFrame:
    """``doc_id, held_out, lang_pred, score``, one row per document, from its text alone.

    Every word of the text gets its probability of each language by forward-backward
    over its line, however long; the prediction is the language with the largest mean over words with
    letters, and that mean is the score. Ties go to the first language by name. A
    NULL text, or one without any letter, is ``und`` with score 0, and so is all text if
    nothing was learned. ``with_words`` adds ``words`` (the language of each word, ``und``
    if it has no letter). Repeated rows and NULL doc_ids are predicted as any other
    (held_out is then false). Other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        model = shared.value
        labeller = Labeller(model)
        for batch in batches:
            languages, scores, words = [], [], []
            for mean, shares, letters in labeller.label(batch["text"]) if model.languages else ():
                best = UNKNOWN if mean is None else model.languages[int(mean.argmax())]
                languages.append(best)
                scores.append(0.0 if mean is None else float(min(1.0, mean.max())))
                if with_words:
                    labels = shares.argmax(axis=1)
                    words.append(
                        [model.languages[i] if ok else UNKNOWN for i, ok in zip(labels, letters)]
                    )
            if not model.languages:
                languages, scores = [UNKNOWN] * len(batch["text"]), [0.0] * len(batch["text"])
                words = [[UNKNOWN] * len((text or b"").split()) for text in batch["text"]]
            yield batch | {"lang_pred": languages, "score": scores, "words": words}

    rows = docs.select(
        F.col("doc_id").cast("bigint"),
        F.coalesce(
            F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False)
        ).alias("held_out"),
        F.col("text").cast("string"),
    )
    more = ", words array<string>" if with_words else ""
    return in_python(
        rows, work, f"doc_id bigint, held_out boolean, lang_pred string, score double{more}"
    )


def without_unknown(docs: DataFrame, least_score: float = 0.5) -> DataFrame:
    """The documents with a language: predicted with a mean probability of ``least_score``.

    Texts without letters go, and so do texts of which no language has that share: most of
    two languages in equal parts and all of three. Each row is judged by
    its own text, whatever its doc_id.
    """
    shared = docs.sparkSession.sparkContext.broadcast(language_model(docs))

    def make():
        model = shared.value
        labeller = Labeller(model)

        def keep(texts: list) -> list[bool]:
            if not model.languages:
                return [False] * len(texts)
            return [
                mean is not None and float(min(1.0, mean.max())) >= least_score
                for mean, _, _ in labeller.label(texts)
            ]

        return keep

    return filtered(docs, make)
