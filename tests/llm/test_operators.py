"""The operators against plain versions of their rules, on small tables and odd rows."""

import hashlib
import math
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import tidewater.llm as package
from tidewater.llm import (
    chat,
    common,
    decontam,
    kneser,
    langid,
    line_rules,
    neural_lm,
    packing,
    queries,
    simhash,
    suffixes,
    token_rollup,
)

FOLDER = "/root/testdata/sf0.001"
SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    "row string, fp string, word string, kept boolean, block array<int>, _row int, n int, "
    # Names that operators use inside.
    "_doc_id string, _text_hash string, _part string, _sequence string, _offset string, _in string, "
    "_size string, _rank string, _before string, _given_id string, _given_hash string, at string, "
    "node string, root string, count string, bucket string, value string, hash string"
)
CLASHING = ("d", "h", "p", "s", "o", "i", "z", "r", "b", "g", "x", "a", "m", "t", "c", "u", "v", "w")


def odd_rows():
    """NULLs, empty and very long texts, ties and repeated rows."""
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdeé", k=rng.randint(1, 7))) for _ in range(800)]
    text = lambda n: " ".join(rng.choices(words, k=n))
    long, shared = text(60_000), text(40)
    rows = [
        (1, None, None, None),
        (2, "", "en", "s"),
        (3, " \t\n ", "en", None),
        (None, text(30), None, "s"),
        (None, None, "en", "s"),
        (4, long, "de", "s"),
        (5, "x" * 100_000, "de", "s"),
        (6, f"{shared} {text(20)}", "en", "s"),
        (7, f"{text(20)}\n{shared}\n{text(3)}", "en", "s"),
        (7, f"{text(20)}\n{shared}\n{text(3)}", "fr", "t"),
        (8, shared.upper(), "fr", "t"),
        (9, "### 123 ... !!!", "en", "s"),
        (10, "one two", "en", "s"),
    ]
    copy = text(120)
    rows += [(11, copy, "en", "s"), (11, copy, "en", "s"), (12, copy, "en", "s"), (13, f"{copy} end", "de", "t")]
    rows += [(20 + i, f"{text(50)}\n{text(30)}", "en" if i % 2 else "fr", f"s{i % 3}") for i in range(30)]
    return [(*r, 0, "a", "b", "c", True, [1], 5, 6, *CLASHING) for r in rows]


@pytest.fixture(scope="module")
def odd(spark):
    return common.tuned(spark).createDataFrame(odd_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return common.tuned(spark).read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="module", params=["odd", "given"])
def some(request, odd, docs):
    return odd if request.param == "odd" else docs


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# --- packing -----------------------------------------------------------------


def gold_ids(text):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.vocabulary_path() + ".json")
    return tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize(
    "text",
    [
        "", " ", "  a", "a  b", "a \n b", "a\n\n b\n", "it's we'll'", "x1 22é\u00a0y", "tab\t\tz ",
        "\u3000a b\u2003", "\x1cq\x85w", "<|endoftext|> a<|endoftext|>b", "日本語 テキスト。", "a\r\nb \r\n",
        "é" * 50, "don't   stop\n\n\n", "😀 😀😀",
        "x" * 50_000, "ab " * 20_000, "\u180e \u200b\ufeff", "²½ Ⅷ ٣", "e\u0301 à́",
    ],
)
def test_ids_are_the_tokenizers(text):
    found = packing.encoder(packing.vocabulary_path()).encode([text, text])
    assert [np.frombuffer(one, "<u4").tolist() for one in found] == [gold_ids(text)] * 2


def check_packing(rows, capacity):
    by_sequence = {}
    for row in rows:
        by_sequence.setdefault(row["sequence_id"], []).append((row["offset"], row["length"]))
    for placed in by_sequence.values():
        end = 0
        for offset, length in sorted(placed):
            assert offset == end
            end += length
        assert end <= capacity
    return len(by_sequence)


def test_pieces_and_sequences(some):
    pieces = packing.token_pieces(some, capacity=64)
    packed = packing.best_fit(pieces, 64).cache()
    rows = packed.collect()
    expected = Counter()
    for row in some.collect():
        ids = [*gold_ids(row["text"]), 2]
        first = len(ids) % 64 or 64
        for piece, start in enumerate([0, *range(first, len(ids), 64)]):
            stop = first if piece == 0 else start + 64
            expected[row["doc_id"], piece, start, tuple(ids[start:stop])] += 1
    assert expected == Counter(
        (r["doc_id"], r["piece"], r["start"], tuple(np.frombuffer(r["ids"], "<u4"))) for r in rows
    )
    assert all(r["length"] * 4 == len(r["ids"]) for r in rows)
    used = check_packing(rows, 64)
    assert used <= 1.02 * sum(r["length"] for r in rows) / 64 + 2
    whole = packing.sequences(packed).collect()
    assert sum(len(r["ids"]) for r in whole) == sum(len(r["ids"]) for r in rows)


def test_plan_matches_large_items_in_pairs():
    rng = random.Random(5)
    for _ in range(60):
        capacity = rng.randint(3, 60)
        counts = Counter(rng.randint(1, capacity - 1) for _ in range(rng.randint(1, 400)))
        plan = packing.packing_plan(dict(counts), capacity)
        bins = Counter()
        large = Counter()
        runs = plan.tolist()
        for i, (size, rank, width, at, offset) in enumerate(runs):
            end = runs[i + 1][1] if i + 1 < len(runs) and runs[i + 1][0] == size else counts[size]
            for nth in range(end - rank):
                bins[at + nth % width] += size
                large[at + nth % width] += 3 * size > capacity
        assert sum(bins.values()) == sum(size * n for size, n in counts.items())
        assert max(bins.values()) <= capacity and max(large.values()) <= 2
        lower = max(
            math.ceil(sum(bins.values()) / capacity), sum(n for s, n in counts.items() if 2 * s > capacity)
        )
        assert len(bins) <= 1.25 * lower + 2


def test_packing_keeps_all_columns(odd):
    items = odd.withColumn("length", F.lit(3))
    packed = packing.best_fit(items, 10)
    assert packed.columns == [*items.columns, "sequence_id", "offset"]
    before, after = (Counter(map(repr, frame.drop("sequence_id", "offset").collect())) for frame in (items, packed))
    assert before == after and check_packing(packed.collect(), 10) == -(-items.count() // 3)


def test_packing_of_odd_items(spark, nothing):
    items = spark.createDataFrame([(None, 1), (0, 2), (10, 3), (10, 4), (4, 5)], "length int, _row2 int")
    rows = {r["_row2"]: r for r in packing.best_fit(items, 10).collect()}
    assert rows[1]["sequence_id"] is None and rows[2]["sequence_id"] is None
    assert len({rows[i]["sequence_id"] for i in (3, 4, 5)}) == 3
    with pytest.raises(Exception, match="larger than a sequence"):
        packing.best_fit(items, 9).collect()
    assert packing.best_fit(packing.token_pieces(nothing)).count() == 0


# --- token totals --------------------------------------------------------------


def test_totals_after_changes(spark, some, tmp_path):
    found = token_rollup.maintained_totals(some, f"file://{tmp_path}/rollup")
    rows = [(r["doc_id"], r["text"] or "", r["source"], r["lang"]) for r in some.collect()]
    least = {}
    for doc_id, text, *_ in rows:
        if doc_id is not None and (text not in least or doc_id < least[text]):
            least[text] = doc_id
    expected = Counter()
    for doc_id, text, source, lang in rows:
        # By row: others may share its doc_id, or have none either.
        if text in least and (doc_id is None or doc_id > least[text]):
            continue
        text = "\n".join(dict.fromkeys(text.split("\n")))
        for tokenizer, n in (("byte_bpe_50k", len(gold_ids(text))), ("words_1", len(split(text)))):
            expected[source, lang, tokenizer, "documents"] += 1
            expected[source, lang, tokenizer, "tokens"] += n
    got = Counter()
    for r in found.collect():
        for name in ("documents", "tokens"):
            got[r["source"], r["lang"], r["tokenizer"], name] += r[name]
    assert +got == +expected


def test_totals_of_rows_that_share_an_id_or_have_none(spark, tmp_path):
    rows = [
        (None, "a\na", "s", "x"), (None, "b", "s", "x"), (None, "c d", "s", "x"), (1, "c d", "s", "x"),
        (7, "e\ne", "t", "x"), (7, "f g h", "t", "x"), (7, "c d", "u", "x"), (8, "i\ni", "v", "x"), (None, "i\ni", "v", "x"),
    ]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string").repartition(3)
    got = {}
    for r in token_rollup.maintained_totals(frame, f"file://{tmp_path}/shared").where("tokenizer = 'words_1'").collect():
        got[r["source"]] = (r["documents"], r["tokens"])
    assert got == {"s": (3, 4), "t": (2, 4), "v": (1, 1)}


def test_batches_count_once_and_merge(spark, tmp_path):
    rollup = token_rollup.TokenRollup(f"file://{tmp_path}/totals")
    schema = "source string, lang string, tokenizer string, documents int, tokens bigint"
    one = spark.createDataFrame([("a", None, "t", 1, 10), ("a", None, "t", 1, 5), ("b", "en", "t", 1, 1)], schema)
    back = spark.createDataFrame([("b", "en", "t", -1, -1)], schema)
    for batch_id, changes in ((1, one), (0, one), (1, one), (2, back), (2, back)):
        rollup.commit(batch_id, changes)
    expected = [("a", None, "t", 4, 30), ("b", "en", "t", 1, 1)]
    assert sorted(map(tuple, rollup.totals(spark).collect())) == expected
    rollup.merge(spark, 2)
    rollup.commit(1, one)
    assert sorted(map(tuple, rollup.totals(spark).collect())) == expected


# --- quality rules ----------------------------------------------------------------


def line_facts(text):
    words = split(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    many = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if many[w] > 1 for k in range(5)}
    lines = [line for line in (text or "").split("\n") if split(line)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(sign in "#*$%&|<>" for sign in text or ""),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "base_failed": len(words) < 10 or 100 * len(covered) > 20 * len(words),
    }


def plain_line_rules(rows, least, least_words):
    norm = lambda line: re.sub("[0-9]", "0", "".join(
        c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\f\r")))
    texts, counts = {}, Counter()
    for _, text, source in rows:
        texts.setdefault(source or "", set()).add(text or "")
    for host, distinct in texts.items():
        for text in distinct:
            counts.update({(host, norm(line)) for line in text.split("\n") if split(line)})
    found = Counter()
    for doc_id, text, source in rows:
        facts = line_facts(text)
        gone = [
            line for line in (text or "").split("\n")
            if len(split(line)) >= max(1, least_words) and counts[source or "", norm(line)] > least
        ]
        left = facts["n_words"] - sum(len(split(line)) for line in gone)
        kept = not facts["base_failed"] and left >= 10 and left >= 0.5 * facts["n_words"]
        found[(doc_id, *facts.values(), kept, len(gone), facts["n_words"] - left)] += 1
    return found


@pytest.mark.parametrize("least, words", [(10, 3), (1, 0), (1, 6)])
def test_line_rules(some, least, words):
    rows = [(r["doc_id"], r["text"], r["source"]) for r in some.collect()]
    found = line_rules.line_rules(some, least, words)
    assert Counter(map(tuple, found.collect())) == plain_line_rules(rows, least, words)


def test_a_larger_host_keeps_no_line_that_a_smaller_one_lost(spark):
    line, short = "all rights reserved by the shop", "thank you"
    schema = "doc_id int, text string, source string"

    def text(i, *lines):
        name = "".join(chr(97 + int(digit)) for digit in str(i))  # digits are one to the rule
        return "\n".join((*lines, " ".join(name + sign for sign in "klmnopqrstuv")))

    with_line = [(i, text(i, line, short), "h") for i in range(11)]
    for others in (0, 2000):
        rows = with_line + [(100 + i, text(100 + i, short), "h") for i in range(others)]
        found = line_rules.line_rules(spark.createDataFrame(rows, schema)).where("doc_id < 11").collect()
        assert [r["n_removed_lines"] for r in found] == [1] * 11 and all(r["kept"] for r in found)
    few = line_rules.line_rules(spark.createDataFrame(with_line[:10], schema)).collect()
    assert [r["n_removed_lines"] for r in few] == [0] * 10


def test_line_rules_clean_text(spark):
    line = "buy now for 5 coins at the shop"
    texts = [f"{line}\nsomething {'abc'[i]} else that is written here by someone\n\n{line}" for i in range(3)]
    frame = spark.createDataFrame([(i, t, "h") for i, t in enumerate(texts)], "doc_id int, text string, source string")
    found = line_rules.line_rules(frame, 1, with_text=True).collect()
    assert sorted(r["clean_text"] for r in found) == [
        f"something {c} else that is written here by someone\n" for c in "abc"
    ]


def test_line_rules_of_nothing(nothing):
    assert line_rules.line_rules(nothing).count() == 0


# --- language model -----------------------------------------------------------------


def test_text_scores(some):
    rows = neural_lm.score_texts(some).collect()
    tokens = [((r["doc_id"]), (r["text"] or "").encode().lower().split() + [b"\n"]) for r in some.collect()]
    held = lambda doc_id: zlib.crc32(str(doc_id).encode() if doc_id is not None else b"") % 10 == 0
    counts = Counter(word for doc_id, words in tokens if not held(doc_id) for word in words)
    total, distinct = sum(counts.values()), len(counts)
    expected = Counter()
    for doc_id, words in tokens:
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in words)
        known = sum(word in counts for word in words)
        expected[doc_id, held(doc_id), len(words), known, total, f"{base:.5g}"] += 1
    assert expected == Counter(
        (r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], f"{r['base_score']:.5g}")
        for r in rows
    )
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in rows)


def test_model_beats_counts_on_held_out_texts(spark):
    docs = common.tuned(spark).read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [r for r in neural_lm.score_texts(docs).collect() if r["held_out"]]
    gain = sum(r["score"] - r["base_score"] for r in rows) / sum(r["n_tokens"] for r in rows)
    assert gain > 0.1


def test_probabilities_sum_to_one(docs):
    counts = common.written(neural_lm.word_counts(docs), "counts")
    words = neural_lm.vocabulary(counts, head=300)
    learned = neural_lm.train(neural_lm.numbered(docs, words), words, 1)
    model = neural_lm.LogBilinear(words.size, words.unit_counts, learned)
    a, b = np.array([words.size, 3, 7]), np.array([words.size, 0, 7])
    scores = model.query(a, b) @ model.target.T + model.bias
    units = np.exp(scores - model.log_totals(a, b)[:, None])
    assert np.allclose(units.sum(axis=1), 1, atol=1e-4)
    within = np.zeros(words.size)
    listed = counts.collect()
    for row in listed:
        number = words.number(row["word"].encode())
        if words.class_sizes[number]:
            within[number] += (row["c"] + 0.1) / words.class_sizes[number]
    is_class = words.class_sizes > 0
    unseen = 0.1 / words.class_sizes[is_class]
    assert np.allclose(within[is_class] + unseen, 1)
    assert words.total == sum(row["c"] for row in listed) and words.distinct == len(listed)
    assert len(words.counts) <= 300


def test_scores_of_nothing(nothing):
    assert neural_lm.score_texts(nothing).count() == 0


# --- language ----------------------------------------------------------------------------


def test_languages_of_held_out_documents(spark):
    docs = common.tuned(spark).read.parquet("/root/testdata/sf0.01/documents.parquet")
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    rows = langid.identify(docs, langid.language_model(docs)).collect()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) > 0.98


def test_code_switched_words(spark):
    docs = common.tuned(spark).read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.language_model(docs)
    texts = {}
    for lang in ("en", "de"):
        words = docs.where(f"lang = '{lang}' and n_chars > 900").first()["text"].split()
        texts[lang] = [word for word in words if re.search("[a-z]", word)][:40]
    mixed = " ".join([*texts["en"], *texts["de"]])
    frame = spark.createDataFrame([(1, mixed)], "doc_id int, text string")
    labels = langid.identify(frame, model, with_words=True).first()["words"]
    truth = ["en"] * 40 + ["de"] * 40
    assert np.mean([a == b for a, b in zip(labels, truth)]) > 0.85


def test_forward_backward_against_enumeration():
    import itertools

    rng = np.random.default_rng(2)
    scores, moves = rng.normal(size=(2, 4, 3)), rng.normal(size=(3, 3))
    lengths = np.array([4, 2])
    found, pairs = langid.posteriors(scores, lengths, moves)
    expected_pairs = np.zeros((3, 3))
    for c, n in enumerate(lengths):
        weights = {}
        for path in itertools.product(range(3), repeat=int(n)):
            total = sum(scores[c, t, y] for t, y in enumerate(path))
            total += sum(moves[x, y] for x, y in zip(path, path[1:]))
            weights[path] = math.exp(total)
        z = sum(weights.values())
        for t in range(n):
            for y in range(3):
                p = sum(w for path, w in weights.items() if path[t] == y) / z
                assert found[c, t, y] == pytest.approx(p)
        for path, w in weights.items():
            for x, y in zip(path, path[1:]):
                expected_pairs[x, y] += w / z
    assert np.allclose(pairs, expected_pairs)


def test_long_lines_are_one_chain(monkeypatch):
    rng = np.random.default_rng(7)
    model = langid.Model(
        ["a", "b", "c"],
        rng.normal(0, 0.6, (langid.FEATURES, 3)).astype(np.float32),
        rng.normal(0, 2.0, (3, 3)),
        {},
    )
    words = [f"{a}{b}".encode() for a in "abcdefg" for b in "hijkl"]
    line = [words[i] for i in rng.integers(0, len(words), 700)]
    short = [words[i] for i in rng.integers(0, len(words), 11)]
    text = b" ".join(line) + b"\n" + b" ".join(short) + b"\n\n" + b" ".join(line[:256])
    expected = []
    for chain in (line, short, line[:256]):
        scores = model.emissions([langid.form_of(word) for word in chain])[None]
        found, _ = langid.posteriors(scores, np.array([len(chain)]), model.moves)
        expected.append(found[0])
    for size in (256, 100, 7, 1):
        monkeypatch.setattr(langid, "CHAIN_WORDS", size)
        (_, shares, _), (none, _, _) = langid.Labeller(model).label([text, b""])
        assert none is None
        assert shares == pytest.approx(np.concatenate(expected), abs=1e-4)


def test_unknown_languages(odd, nothing):
    rows = langid.identify(odd, langid.language_model(odd)).collect()
    assert len(rows) == odd.count()
    by_id = {r["doc_id"]: r for r in rows}
    assert {by_id[i]["lang_pred"] for i in (1, 2, 3, 9)} == {"und"}
    assert by_id[4]["lang_pred"] in ("en", "de", "fr")
    empty = langid.language_model(nothing)
    assert langid.identify(nothing, empty).count() == 0
    assert {r["lang_pred"] for r in langid.identify(odd, empty).collect()} == {"und"}
    assert 9 not in {r["doc_id"] for r in langid.without_unknown(odd).collect()}


# --- perplexity ---------------------------------------------------------------------------


def plain_kneser_ney(texts, number, width):
    """p(c | a, b) over units, straight from the definition."""
    tri = Counter()
    for words in texts:
        padded = [width - 1, width - 1, *[number(w) for w in words]]
        tri.update(zip(padded, padded[1:], padded[2:]))
    levels = [tri]
    for _ in range(2):
        levels.append(Counter(gram[1:] for gram in levels[-1]))
    totals, offs, taken = [], [], []
    for level in levels:
        d = kneser.discounts(Counter(level.values()))
        taken.append(d)
        total, off = Counter(), Counter()
        for gram, n in level.items():
            total[gram[:-1]] += n
            off[gram[:-1]] += d[min(n, 3) - 1]
        totals.append(total)
        offs.append(off)

    def p(gram, at=0):
        if at == 3:
            return 1 / (width - 1)
        context = gram[:-1]
        if not totals[at][context]:
            return p(gram[1:], at + 1)
        n = levels[at][gram]
        own = (n - taken[at][min(n, 3) - 1] if n else 0) / totals[at][context]
        return own + offs[at][context] / totals[at][context] * p(gram[1:], at + 1)

    return p


def test_perplexities(docs):
    model, shares = kneser.fit(docs, head=500)
    texts = [neural_lm.tokens((r["text"] or "").encode()) for r in docs.collect()]
    p = plain_kneser_ney(texts, model.words.number, model.width)
    found = {r["doc_id"]: r for r in kneser.log_probabilities(docs, model, shares).collect()}
    for row in docs.limit(12).collect():
        start = model.width - 1
        units = [start, start, *[model.words.number(w) for w in neural_lm.tokens((row["text"] or "").encode())]]
        total = sum(math.log10(p(gram)) for gram in zip(units, units[1:], units[2:]))
        assert found[row["doc_id"]]["log10_prob"] == pytest.approx(total, rel=1e-5)


def test_every_trusted_word_has_its_own_probability(spark):
    # 900 words with one ending: more than any fixed number of own words, one class by last bytes
    rng = random.Random(8)
    words = [f"{''.join(rng.choices('abcdefgh', k=8))}ung" for _ in range(900)]
    trusted = spark.createDataFrame([(i, "de", " ".join(words)) for i in range(3)], "doc_id bigint, lang string, text string")
    other = [f"{word[:8][::-1]}zung" for word in words]
    texts = {1: " ".join(words), 2: " ".join(rng.sample(words, 900)), 3: " ".join(other)}
    asked = spark.createDataFrame([(i, "de", t) for i, t in texts.items()], "doc_id bigint, lang string, text string")
    for head in (10, kneser.HEAD_GRAMS):
        model, grams = kneser.fit(trusted, head=head)
        found = {r["doc_id"]: r["log10_prob"] for r in kneser.log_probabilities(asked, model, grams).collect()}
        p = plain_kneser_ney([neural_lm.tokens(" ".join(words).encode())] * 3, model.words.number, model.width)
        for i, text in texts.items():
            start = model.width - 1
            units = [start, start, *map(model.words.number, neural_lm.tokens(text.encode()))]
            total = sum(math.log10(p(gram)) for gram in zip(units, units[1:], units[2:]))
            assert found[i] == pytest.approx(total, rel=1e-5)
        assert len(set(map(model.words.number, map(str.encode, words)))) == 900
        assert found[1] > found[2] + 500 > found[3] + 500  # order counts, and so do words


def test_a_fitted_model_leaves_nothing_but_its_weights(spark, docs):
    """What it is made from goes as soon as the next tables are there, shuffle files too."""
    from tidewater.session import shared_folder

    folder = shared_folder(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    _, grams = kneser.fit(docs, head=10)
    left = {name.rpartition("-")[0] for name in set(os.listdir(folder)) - before if name.startswith("llm-")}
    assert left == {"llm-grams"}
    assert grams.count() > 10


def test_rounds_count_each_triple_once(spark, docs):
    whole = kneser.trigram_counts(docs).collect()
    rounds = [row for turn in range(3) for row in kneser.trigram_counts(docs, turn, 3).collect()]
    assert sorted(whole) == sorted(rounds) and len({row[:3] for row in rounds}) == len(rounds)


def test_gram_keys_are_sparks(spark):
    from pyspark.sql import functions as F

    numbers = np.random.default_rng(1).integers(-(1 << 63), (1 << 63) - 1, (3, 50))
    frame = spark.createDataFrame([tuple(map(int, row)) for row in numbers.T], "a bigint, b bigint, c bigint")
    for names in ("a", "ab", "abc"):
        rows = frame.select(F.xxhash64(*names)).collect()
        assert [r[0] for r in rows] == kneser.gram_key(*numbers[: len(names)]).tolist()


def test_quality_of_odd_rows(spark, odd, nothing):
    schema = "doc_id bigint, quality int, toxic int, text string"
    labels = spark.createDataFrame(
        [(i, 1, None, "z") for i in (4, 6, 7, 11, 21, 22, 23, 24, 25, 26)] + [(None, 1, 0, "z"), (5, None, 1, "z"), (4, 1, 0, "z")],
        schema,
    )
    rows = kneser.quality(odd, labels).collect()
    assert len(rows) == odd.count() and all(r["perplexity"] > 0 for r in rows)
    unlabelled = kneser.quality(odd, labels.limit(0)).collect()
    assert len(unlabelled) == odd.count() and all(r["kept"] for r in unlabelled)
    assert kneser.quality(nothing, labels).count() == 0


# --- near copies ------------------------------------------------------------------------------


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = split(words)
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    distinct = sorted(set(prints))
    root = {p: p for p in distinct}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, x in enumerate(distinct):
        for y in distinct[:i]:
            if (x ^ y).bit_count() <= 2:
                root[find(x)] = find(y)
    return {p: find(p) for p in distinct}


@pytest.mark.parametrize("small", [simhash.SMALL_BUCKET, 1])
def test_near_copies(some, small, monkeypatch):
    monkeypatch.setattr(simhash.links, "__defaults__", (2, small))
    rows = [(r["doc_id"], plain_fingerprint(r["text"])) for r in some.collect()]
    roots = plain_components([p for _, p in rows])
    least = {}
    for doc_id, p in rows:
        if doc_id is not None:
            least[roots[p]] = min(doc_id, least.get(roots[p], doc_id))
    found = simhash.near_copies(some).collect()
    assert Counter((r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in found) == Counter(
        (doc_id, p, least.get(roots[p])) for doc_id, p in rows
    )


def test_masks_cover_every_pair():
    masks = simhash.covering_masks(2)
    assert len(masks) == 7
    for i in range(64):
        for j in range(i, 64):
            assert any(not mask & (1 << i | 1 << j) for mask in masks)


@pytest.mark.parametrize("small", [4096, 2])
def test_links_of_chains_and_crowds(spark, small):
    rng = random.Random(1)
    start = rng.getrandbits(64)
    prints = {start ^ (3 << (2 * (i % 31))) ^ (1 << (i % 64)) for i in range(100)} | {start}
    at = rng.getrandbits(64)
    for _ in range(40):  # a chain of steps of two bits
        prints.add(at)
        at ^= 1 << rng.randrange(64) | 1 << rng.randrange(64)
    frame = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fp bigint")
    from tidewater.llm.graph import components

    found = components(simhash.links(frame, small_bucket=small)).collect()
    groups = {}
    for node, root in found:
        groups.setdefault(root, set()).add(node % (1 << 64))
    expected = {}
    for p, root in plain_components(prints).items():
        expected.setdefault(root, set()).add(p)
    assert sorted(map(sorted, groups.values())) == sorted(sorted(g) for g in expected.values() if len(g) > 1)


def test_one_of_each_group_stays(odd, nothing):
    kept = simhash.without_near_copies(odd)
    assert kept.columns == odd.columns
    rows = kept.collect()
    # Rows that share a doc_id may be in different groups: one of each stays.
    groups = {r["root"]: r["component_id"] for r in simhash._grouped(odd, simhash.RADIUS).collect()}
    key = lambda doc_id: (doc_id is None, doc_id)
    assert sorted((r["doc_id"] for r in rows), key=key) == sorted(groups.values(), key=key)
    assert all(r["_doc_id"] == "d" and r["_text_hash"] == "h" and r["_row"] == 5 for r in rows)
    assert simhash.without_near_copies(nothing).count() == 0


def test_stages_judge_rows_that_share_an_id_or_have_none(spark):
    rng = random.Random(6)
    words = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(500)]
    one, two, three, four, five = (" ".join(rng.sample(words, 60)) for _ in range(5))
    rows = [
        (1, ""), (None, None), (None, one), (None, one), (7, two), (7, three), (8, two), (3, three), (9, four), (9, four), (9, five),
    ]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    kept = simhash.without_near_copies(frame).collect()
    key = lambda row: (row[0] is None, *map(str, row))
    assert sorted(map(tuple, kept), key=key) == sorted([(1, ""), (None, one), (7, two), (3, three), (9, four), (9, five)], key=key)

    items = spark.createDataFrame([(1, two, three)], "item_id bigint, question string, answer string")
    leaky = f"{two} {three}"
    frame = spark.createDataFrame([(None, leaky), (None, one), (7, leaky), (7, four)], "doc_id bigint, text string")
    left = {tuple(r) for r in decontam.without_leaks(frame, items).collect()}
    assert left == {(None, one), (7, four)}


def test_unknown_language_takes_its_row_alone(spark):
    docs = common.tuned(spark).read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang", "text")
    text = docs.where("lang = 'en' and length(text) > 900").first()["text"]
    more = [(None, None, "###"), (None, None, text), (-7, None, "123"), (-7, None, text)]
    left = langid.without_unknown(docs.unionByName(spark.createDataFrame(more, docs.schema)))
    found = [tuple(r) for r in left.where("doc_id is null or doc_id = -7").select("doc_id", "text").collect()]
    assert sorted(found, key=str) == sorted([(None, text), (-7, text)], key=str)


# --- chat -------------------------------------------------------------------------------------


TURNS = "conv_id bigint, turn bigint, role string, text string, window string, pos int, shown string"


def turn_rows(seed, long=False):
    rng = random.Random(seed)
    rows = []
    marks = ["</s>", "[INST]", "<\\s>", "[\\\\/INST]", "<s>[INST] a [/INST] b</s>", "\n", "plain words here", "é" * 9]
    for conv in range(25):
        n = rng.choice([1, 2, 3, 9, 60 if conv == 3 else 4])
        for turn in range(n):
            role = "system" if turn == 0 and conv % 3 == 0 else rng.choice(["user", "assistant", None, "tool]"])
            text = " ".join(rng.choices(marks, k=rng.randint(0, 300 if long else 25)))
            rows.append((conv, turn, role, rng.choice([text, text, text, None]), "w", 1, "s"))
    rows += [(None, None, "user", "hi", "w", 1, "s"), (None, 2, "assistant", "ho", "w", 1, "s")]
    rows += [(77, 1, "assistant", "same", "w", 1, "s")] * 2
    return rows


@pytest.mark.parametrize("seed, long, budget", [(1, False, 300), (2, True, 1024), (3, False, 100_000)])
def test_windows_hold_every_turn_once(spark, seed, long, budget):
    rows = turn_rows(seed, long)
    windows = chat.chat_windows(spark.createDataFrame(rows, TURNS).repartition(4), budget=budget).cache()
    by_conv = {}
    for conv, turn, role, text, *_ in rows:
        by_conv.setdefault(conv, []).append(((turn is not None, turn or 0), role or "", text or ""))
    found = {r["conv_id"]: r for r in chat.conversation_digests(windows).collect()}
    assert set(found) == set(by_conv)
    for conv, turns in by_conv.items():
        turns.sort()
        listed = "".join(f"{role}\n{text}\n" for _, role, text in turns)
        loss = "".join(text for _, role, text in turns if role == "assistant")
        r = found[conv]
        assert r["n_turns"] == len(turns) and r["loss_chars"] == len(loss)
        assert r["turns_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    shapes = windows.collect()
    for w in shapes:
        assert w["over_budget"] == (w["n_tokens"] > budget)
        fresh = w["n_turns"] - w["n_repeated"]
        assert fresh >= 1
        if w["over_budget"] and w["conv_id"] is not None and w["conv_id"] % 3 and not long:
            assert fresh == 1
        pieces = w["text"].split("</s>")
        assert pieces.pop() == "" and len(pieces) == w["n_turns"]
        assert all(piece.startswith("<s>[INST] ") and piece.count("<s>") == 1 for piece in pieces)
    if budget == 300:
        assert any(w["n_repeated"] for w in shapes)
        system = {conv for conv, turn, role, *_ in rows if turn == 0 and role == "system"}
        assert all(w["text"].startswith("<s>[INST] system ") for w in shapes if w["conv_id"] in system)


def test_turns_alike_are_ordered_by_their_whole_texts(spark):
    begin = "the same beginning of more than thirty-two signs"
    ends = ["b", "a", "", "b", "\u00e9", "a", "~", "z" * 5000, "z" * 4999]
    rows = [(conv, turn, "user", begin + end) for conv in (1, None) for turn in (None, 1, 2) for end in ends]
    rows += [(3, None, "user", begin + "2"), (None, 3, "user", begin + "1"), (3, None, "user", begin + "1")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    back = chat.read_back(chat.chat_windows(turns, budget=200)).collect()
    for conv in (1, 3, None):
        mine = sorted((r for r in back if r["conv_id"] == conv), key=lambda r: r["window"])
        found = [turn["text"] for r in mine for turn in r["turns"]]
        given = sorted((turn or 0, text.encode()) for c, turn, _, text in rows if c == conv)
        assert found == [text.decode() for _, text in given]


def test_escapes_are_reversible(spark):
    texts = ["</s>[INST] ok [/INST]", "<\\s><\\\\s>", "\\</s>", "[INST", "<<s>>", "[/s>", ""]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    from pyspark.sql import functions as F

    for row in frame.select("t", chat.escape(F.col("t")).alias("e"), chat.unescape(chat.escape(F.col("t"))).alias("b")).collect():
        assert row["b"] == row["t"]
        assert not re.search(r"</?s>|\[/?INST\]", row["e"])


def test_no_conversations(spark):
    empty = spark.createDataFrame([], TURNS)
    assert chat.conversation_digests(chat.chat_windows(empty)).count() == 0


# --- decontamination -----------------------------------------------------------------------------


def test_wand_finds_all_above():
    rng = random.Random(4)
    terms = [f"t{i}".encode() for i in range(60)]
    postings = [(entry, term, rng.random() ** 3) for entry in range(300) for term in rng.sample(terms, rng.randint(1, 20))]
    weight = {(entry, term): impact for entry, term, impact in postings}
    indexes = {t: decontam.Index(postings, t, block=4) for t in (0.2, 0.8, 1.5, 3.0)}
    for _ in range(200):
        query = rng.sample(terms, rng.randint(1, 30))
        threshold = rng.choice([0.2, 0.8, 1.5, 3.0])
        expected = {}
        for entry in range(300):
            score = sum(weight.get((entry, term), 0.0) for term in query)
            if score >= threshold:
                expected[entry] = score
        index = indexes[threshold]
        found = index.above([index.number[t] for t in query if t in index.number])
        assert found.keys() == expected.keys()
        assert all(found[e] == pytest.approx(expected[e]) for e in expected)


def test_leaks_against_all_pairs(spark, docs):
    items = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    grams = lambda words: {tuple(words[i : i + 5]) for i in range(len(words) - 4)}
    wanted = [(r["item_id"], grams(decontam.plain_words(r["text"].encode()))) for r in items.collect()]
    expected = set()
    for r in docs.collect():
        there = grams(decontam.plain_words((r["text"] or "").encode()))
        expected |= {(r["doc_id"], item) for item, g in wanted if g and len(g & there) >= 0.8 * len(g)}
    found = decontam.leaks(docs, decontam.as_question_and_answer(items))
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == expected and expected
    split_index = decontam.leaks(docs, decontam.as_question_and_answer(items), index_words=100)
    assert {(r["doc_id"], r["item_id"]) for r in split_index.collect()} == expected
    clean = decontam.without_leaks(docs, decontam.as_question_and_answer(items))
    assert {r["doc_id"] for r in clean.collect()} == {r["doc_id"] for r in docs.collect()} - {d for d, _ in expected}


def test_leaks_in_odd_rows(spark, odd, nothing):
    long = next(r["text"] for r in odd.collect() if r["doc_id"] == 4).split()
    schema = "item_id bigint, question string, answer string, text string"
    items = spark.createDataFrame(
        [
            (1, " ".join(long[5000:5030]), " ".join(long[5030:5040]), "t"),
            (2, " ".join(long[20_000:20_200]), " ".join(long[20_200:20_220]), "t"),
            (3, None, None, "t"), (None, "", "", "t"), (4, "quite other things", None, "t"),
            (5, " ".join(long[5000:5030]), "zebra quagga okapi tapir", "t"),
        ],
        schema,
    )
    found = {(r["doc_id"], r["item_id"]) for r in decontam.leaks(odd, items).collect()}
    assert found == {(4, 1), (4, 2)}
    assert decontam.leaks(nothing, items).count() == 0
    assert decontam.leaks(odd, items.limit(0)).count() == 0


# --- repeated passages -------------------------------------------------------------------------------


def plain_removed(rows):
    """Coverage from a table of all 50-byte strings and the least doc_id each is in."""
    last = float("inf")
    first = {}
    for doc_id, text in rows:
        data = (text or "").encode()
        key = last if doc_id is None else doc_id
        for i in range(len(data) - 49):
            piece = data[i : i + 50]
            first[piece] = min(key, first.get(piece, key))
    found = []
    for doc_id, text in rows:
        data = (text or "").encode()
        key = last if doc_id is None else doc_id
        covered = np.zeros(len(data), bool)
        for i in range(len(data) - 49):
            if first[data[i : i + 50]] < key:
                covered[i : i + 50] = True
        spans = int((np.diff(np.concatenate(([0], covered.astype(int)))) == 1).sum())
        found.append((doc_id, len(data), int(covered.sum()), spans, bytes(np.frombuffer(data, np.uint8)[~covered])))
    return found


@pytest.mark.parametrize("block_bytes", [suffixes.BLOCK_BYTES, 3000])
def test_repeated_passages(some, block_bytes):
    some = some.where("doc_id is null or doc_id <> 5")  # for the plain version's sake
    found = suffixes.without_repeats(some, block_bytes=block_bytes).collect()
    rows = [(r["doc_id"], r["text"]) for r in some.collect()]
    assert Counter(
        (r["doc_id"], r["n_bytes"], sum(r["span_lengths"]), len(r["span_starts"]), bytes(r["kept"])) for r in found
    ) == Counter(plain_removed(rows))


def test_repeated_passages_of_few_letters(spark):
    rng = random.Random(8)
    rows = []
    for doc_id in range(60):
        parts = ["ab" * rng.randint(0, 60), "a" * rng.randint(0, 120), "".join(rng.choices("ab\0", k=rng.randint(0, 90)))]
        rng.shuffle(parts)
        rows.append((doc_id, "".join(parts)))
    rows += [(60 + i, text[rng.randint(0, 40) :] + text[: rng.randint(0, 80)]) for i, (_, text) in enumerate(rows[:40])]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    expected = Counter(plain_removed(rows))
    for options in ({}, {"hot_blocks": 2}, {"hot_blocks": 4, "bucket_bytes": 300}):
        found = suffixes.without_repeats(frame, block_bytes=700, **options).collect()
        assert expected == Counter(
            (r["doc_id"], r["n_bytes"], sum(r["span_lengths"]), len(r["span_starts"]), bytes(r["kept"])) for r in found
        )


def test_strings_at_one_anchor_are_told_apart(spark):
    # One gram of least hash in every document, with other bytes on both sides of it.
    rng = random.Random(9)
    letters = "abcdefghijklmnopqrstuvwxyz"
    sides = ["".join(rng.choices(letters, k=26)) for _ in range(40)]
    found = suffixes.Anchors(np.zeros(0, np.uint8), np.zeros(0, np.int64))
    while not len(found.ids) or Counter(found.ids.tolist()).most_common(1)[0][1] < 150:
        gram = "".join(rng.choices(letters, k=24))
        texts = [f"{rng.choice(sides)}{gram}{rng.choice(sides)}{rng.choice(sides)}" for _ in range(200)]
        data = np.frombuffer("".join(texts).encode(), np.uint8)
        found = suffixes.Anchors(data, np.array([len(text) for text in texts]))
    rows = list(enumerate(texts))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    plain = Counter((doc_id, removed, spans) for doc_id, _, removed, spans, _ in plain_removed(rows))
    for hot_blocks in (2, suffixes.HOT_BLOCKS):
        found = suffixes.without_repeats(frame, block_bytes=400, bucket_bytes=2000, hot_blocks=hot_blocks).collect()
        assert plain == Counter((r["doc_id"], sum(r["span_lengths"]), len(r["span_starts"])) for r in found)

    # Split, each part has an id of its own and the strings are the same ones.
    sizes = np.array([len(text) for text in texts])
    whole, parts = suffixes.Anchors(data, sizes), suffixes.Anchors(data, sizes)
    parts.split(np.ones(len(parts.ids), bool), data)
    strings = [
        sorted((start, doc) for a, b, doc in zip(one.starts, one.stops, one.docs) for start in range(a, b + 1))
        for one in (whole, parts)
    ]
    assert strings[0] == strings[1]
    most = [Counter(one.ids.tolist()).most_common(1)[0][1] for one in (whole, parts)]
    assert most[1] < most[0] / 4


def test_loser_tree_merges_with_shared_prefixes():
    rng = random.Random(6)
    for _ in range(200):
        runs = []
        for _ in range(rng.randint(1, 9)):
            run = sorted({bytes(rng.choices(b"ab", k=rng.randint(0, 12))) for _ in range(rng.randint(0, 12))})
            codes = [0] + [len(suffixes_common(a, b)) for a, b in zip(run, run[1:])]
            runs.append((run, codes[: len(run)]))
        out = [(runs[r][0][at], shared) for r, at, shared in suffixes.merged(runs)]
        assert [s for s, _ in out] == sorted(s for run, _ in runs for s in run)
        for (a, _), (b, shared) in zip(out, out[1:]):
            assert shared == len(suffixes_common(a, b))


def suffixes_common(a, b):
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return a[:n]


def test_cut_documents_keep_their_columns(odd, nothing):
    found = suffixes.cut_documents(odd)
    assert found.dtypes == odd.dtypes
    rows = found.collect()
    assert all(r["block"] == [1] and r["kept"] is True and r["n_chars"] == len(r["text"]) for r in rows)
    ids = [r["doc_id"] for r in rows]
    assert 12 not in ids and ids.count(11) == 2 and 1 in ids
    assert suffixes.cut_documents(nothing).count() == 0


# --- queries and pipeline ----------------------------------------------------------------------------


def test_every_operator_has_a_query(spark):
    found = queries.queries()
    assert sorted(int(name[2:].split("_")[0]) for name in found) == list(range(1, 14))
    assert package.__doc__


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = common.tuned(spark).read.parquet(f"{FOLDER}/documents.parquet")
    columns, before = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = common.written(stage(spark, before, FOLDER), name)
        assert after.columns == columns
        assert 0 < after.count() <= before.count()
        before = after
    texts = {r["doc_id"]: r["text"] for r in before.collect()}
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    assert {r["doc_id"] for r in rows} == set(texts)
    check_packing(rows, 1024)
    for doc_id, text in list(texts.items())[:20]:
        assert sum(r["length"] for r in rows if r["doc_id"] == doc_id) == len(gold_ids(text)) + 1
