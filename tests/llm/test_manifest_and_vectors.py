"""Manifest, top-k and hard negatives against plain versions of their rules."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.llm import common, merkle, negatives, queries, topk, vectors

FOLDER = "/root/testdata/sf0.001"

# --- manifest ------------------------------------------------------------------------

DOCS = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, id string, tree string, "
    "pos int, size int, node string, now string, _now string, row int, superblock int, label string, "
    "proof string, shape string, root string, _id int, _part int"
)


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf_of(row, text):
    return digest(*map(field, (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)))


def levels_of(nodes):
    found = [nodes]
    while len(found[-1]) > 1:
        found.append([digest(*found[-1][i : i + 3]) for i in range(0, len(found[-1]), 3)])
    return found


def siblings(levels, i):
    for nodes in levels[:-1]:
        first = i - i % 3
        yield nodes[first:i], nodes[i + 1 : first + 3]
        i //= 3


def lost_lines(row):
    known = row["doc_id"] is not None and row["text"] is not None
    if known and zlib.crc32(str(row["doc_id"]).encode()) % 2 == 0:
        return row["text"].replace("\n", "")
    return row["text"]


def plain_manifest(rows):
    sources = {}
    for row in rows:
        sources.setdefault(row["source"], []).append(row)
    names = sorted(sources, key=lambda name: (name is not None, (name or "").encode()))
    trees = {}
    for name in names:
        sources[name].sort(key=lambda row: (row["doc_id"] is not None, row["doc_id"] or 0, leaf_of(row, row["text"])))
        trees[name] = levels_of([leaf_of(row, row["text"]) for row in sources[name]])
    top = levels_of([trees[name][-1][0] for name in names]) if names else []
    found = Counter()
    for place, name in enumerate(names):
        for i, row in enumerate(sources[name]):
            path = [*siblings(trees[name], i), *siblings(top, place)]
            now = leaf_of(row, lost_lines(row))
            for before, after in path:
                now = digest(*before, now, *after)
            proof = digest(*[one for pair in path for side in pair for one in side])
            root = top[-1][0]
            found[row["doc_id"], trees[name][0][i], trees[name][-1][0], root, proof, now, now == root] += 1
    return found


def manifest_of(docs, height):
    odd = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    now = F.when(odd, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    found = merkle.manifest(docs, now, height)
    names = ["doc_id", "leaf", "subroot", "root", "folded_root", "verified", "proof", "shape"]
    rows = found.select(*names).collect()
    for row in rows:
        assert merkle.fold(row["leaf"], row["proof"], row["shape"]) == row["root"]
    return Counter(
        (r["doc_id"], r["leaf"], r["subroot"], r["root"], digest(r["proof"]), r["folded_root"], r["verified"])
        for r in rows
    )


def odd_docs():
    rng = random.Random(11)
    rest = ("i", "t", 1, 2, "n", "w", "x", 3, 4, "l", "p", "s", "r", 5, 6)
    rows = [
        (None, "no id\n", "en", "s", 1), (None, "no id\n", "en", "s", 1), (None, None, None, None, None),
        (1, "", "en", None, 0), (2, "\n\n", None, "", 2), (3, "é\n" * 50_000, "de", "é", 100_000),
        (4, "same\n", "en", "t", None), (4, "same\n", "en", "t", None), (4, "other\n", "en", "t", None),
        (-5, "less", "en", "t", 1), (2**62, "more", "en", "t", 1),
    ]
    rows += [(100 + i, "a\nb" * (i % 4), "en", f"h{rng.choice((0, 0, 0, i % 50))}", i) for i in range(400)]
    return [(*row, *rest) for row in rows]


@pytest.mark.parametrize("height", [1, 2, merkle.LEVELS])
def test_manifest(spark, height):
    docs = spark.createDataFrame(odd_docs(), DOCS).repartition(5)
    assert manifest_of(docs, height) == plain_manifest([row.asDict() for row in docs.collect()])


def test_manifest_of_one_row_and_of_none(spark):
    docs = spark.createDataFrame(odd_docs()[:1], DOCS)
    (row,) = merkle.manifest(docs).collect()
    assert row["leaf"] == row["subroot"] == row["root"] == row["folded_root"] and row["verified"]
    assert row["proof"] == row["shape"] == ""
    assert merkle.manifest(docs.where("false")).count() == 0


# --- vectors -------------------------------------------------------------------------

ROWS = (
    "vec_id bigint, embedding array<float>, label int, id string, pos string, shard int, unit int, "
    "values string, rows int, request int, row int, tree string, term int, weight int, asked int, "
    "floor int, code1 int, _id int, part int, home int"
)
REST = ("i", "p", 1, 2, "v", 3, 4, 5, "t", 6, 7, 8, 9, 10, 11, 12, 13)


def plain_vectors(rows, scale):
    found = []
    for row in rows:
        vector = row["embedding"]
        if vector is None or any(x is None or not np.isfinite(x) for x in vector):
            continue
        whole = [min(max(int(np.floor(np.float64(scale) * np.float64(x))), -(2**63)), 2**63 - 1) for x in vector]
        found.append((row["vec_id"], row["label"], whole))
    return found


def inner(a, b):
    return min(max(sum(x * y for x, y in zip(a, b)), -(2**63)), 2**63 - 1)


def first(scored, k):
    return sorted(scored, key=lambda one: (-one[1], one[0] is None, one[0] or 0))[:k]


def plain_top_k(rows, k):
    found = Counter()
    given = plain_vectors(rows, 1024)
    for i, (query, _, vector) in enumerate(given):
        if query is not None and query % 100 == 0:
            others = [(name, inner(vector, other)) for j, (name, _, other) in enumerate(given) if i != j]
            for rank, (name, score) in enumerate(first(others, k), 1):
                found[query, rank, name, score] += 1
    return found


def plain_negatives(rows):
    given = [
        (name, (label + 1) % 10 if name is not None and name % 7 == 0 else label, vector)
        for name, label, vector in plain_vectors(rows, 256)
        if label is not None
    ]
    found = Counter()
    for i, (anchor, label, vector) in enumerate(given):
        if anchor is None or anchor % 100:
            continue
        scored = [(n, inner(vector, v), own) for j, (n, own, v) in enumerate(given) if i != j]
        for positive, high, _ in first([one for one in scored if one[2] == label], 5):
            fit = [one for one in scored if one[2] != label and 30 * high <= 100 * one[1] <= 90 * high]
            for rank, (name, score, _) in enumerate(first(fit, 10), 1):
                found[anchor, positive, rank, name, high, score] += 1
    return found


def odd_vectors():
    rng = random.Random(12)
    inf, nan = float("inf"), float("nan")
    vector = lambda n=6: [rng.uniform(-1, 1) for _ in range(n)]
    same = vector()
    rows = [
        (0, vector(), 1), (0, vector(), 2), (None, vector(), 1), (None, None, 1), (1, None, 1), (100, [], 1),
        (200, vector(3), 1), (300, [1.0, None, 0.0], 1), (400, [nan] * 6, 1), (500, [inf] * 6, 1), (3, [-inf] * 6, 1),
        (600, [3e38] * 6, 1), (4, [-3e38] * 6, 1), (5, [3e38] * 6, 2), (700, same, None), (800, [0.0] * 6, 3),
        (900, same, 4),
    ]
    rows += [(1000 + i, same, 4 + i % 2) for i in range(40)]
    rows += [(2000 + i, vector(), rng.randint(-2, 12)) for i in range(300)]
    return [(*row, *REST) for row in rows]


@pytest.fixture(scope="module")
def odd(spark):
    return common.tuned(spark).createDataFrame(odd_vectors(), ROWS).repartition(4)


def tuples(frame):
    return Counter(map(tuple, frame.collect()))


def top_k_of(rows, k=10):
    return topk.top_k(rows, F.col("vec_id") % 100 == 0, k)


def negatives_of(rows):
    vec_id, label = F.col("vec_id"), F.col("label")
    moved = F.when(label.isNotNull() & (vec_id % 7 == 0), F.pmod(label + 1, F.lit(10))).otherwise(label)
    return negatives.hard_negatives(rows, moved, vec_id % 100 == 0)


@pytest.mark.parametrize("k", [1, 10, 1000])
def test_top_k(odd, k):
    assert tuples(top_k_of(odd, k)) == plain_top_k(odd.collect(), k)


def test_hard_negatives(odd):
    assert tuples(negatives_of(odd)) == plain_negatives(odd.collect())


def test_no_vectors(spark, odd):
    for rows in (odd.where("false"), odd.where("vec_id = 1"), odd.where("vec_id = 100"), odd.where("vec_id = 2001")):
        assert top_k_of(rows).count() == 0
        assert negatives_of(rows).count() == 0


@pytest.fixture(scope="module")
def many(spark):
    """Three shards: clusters, a third of the rows in one of them, and a group of equal rows."""
    rng = np.random.default_rng(13)
    middle = rng.normal(size=(12, 8)) * 3
    at = np.where(rng.random(20_000) < 1 / 3, 0, rng.integers(0, 12, 20_000))
    values = (middle[at] + rng.normal(size=(20_000, 8)) * 0.5).round(3)
    values[15_000:16_000] = values[15_000]
    rows = [(i, v, int(c % 5)) for i, (v, c) in enumerate(zip(values.tolist(), at))]
    frame = common.tuned(spark).createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    return common.written(frame.repartition(7), "many")


def plain_scores(frame, scale):
    rows = sorted(frame.collect())
    whole = np.floor(scale * np.array([row["embedding"] for row in rows])).astype(np.int64)
    return np.array([row["label"] for row in rows]), whole, whole[::100] @ whole.T


def test_top_k_over_several_shards(many):
    _, _, scores = plain_scores(many, 1024)
    expected = Counter()
    for place, one in enumerate(scores):
        order = [i for i in np.lexsort((np.arange(len(one)), -one))[:12].tolist() if i != 100 * place][:10]
        expected.update((100 * place, rank, i, int(one[i])) for rank, i in enumerate(order, 1))
    assert tuples(top_k_of(many)) == expected


def test_hard_negatives_over_several_shards(many):
    labels, _, scores = plain_scores(many, 256)
    labels = np.where(np.arange(len(labels)) % 7 == 0, (labels + 1) % 10, labels)
    expected = Counter()
    for place, one in enumerate(scores):
        anchor = 100 * place
        order = np.lexsort((np.arange(len(one)), -one))
        order = order[order != anchor]
        same = labels[order] == labels[anchor]
        for positive in order[same][:5].tolist():
            high = int(one[positive])
            others = order[~same]
            fit = others[(100 * one[others] >= 30 * high) & (100 * one[others] <= 90 * high)][:10]
            expected.update((anchor, positive, rank, i, high, int(one[i])) for rank, i in enumerate(fit.tolist(), 1))
    assert tuples(negatives_of(many)) == expected


def shard_of_clusters():
    """Thirty tight clusters of 256 rows, a block each, and a query in one of them."""
    rng = np.random.default_rng(14)
    values = np.repeat(rng.integers(-1000, 1000, (30, 8)), 256, axis=0) + rng.integers(-9, 10, (30 * 256, 8))
    shard = vectors.Shard.__new__(vectors.Shard)
    shard.units = np.arange(30)
    shard.end = np.arange(1, 31) * 256
    shard.first = shard.end - 256
    shard.ids = shard.rows = np.arange(len(values))
    shard.no_id = np.zeros(len(values), bool)
    shard.labels = np.zeros(len(values), np.int64)
    shard.values = values
    asked = vectors.Requests.__new__(vectors.Requests)
    asked.request = asked.row = np.array([5])
    asked.label, asked.floor, asked.ceiling = (np.array([x]) for x in (0, vectors.LEAST, vectors.MOST))
    asked.values = values[5:6]
    return shard, asked


def test_blocks_below_the_kth_score_are_not_read(monkeypatch):
    shard, asked = shard_of_clusters()
    bounds = topk.block_bounds(shard, asked.values)
    scores = vectors.dot(asked.values, shard.values)[0]
    for block in range(30):
        assert bounds[0, block] >= scores[256 * block : 256 * block + 256].max()
    read = []
    plain = topk.dot
    monkeypatch.setattr(topk, "dot", lambda a, b: read.append(len(b)) or plain(a, b))
    hits = topk.block_at_a_time(shard, asked, 10)
    assert len(read) - 1 < 10  # the first call makes the bounds
    best = [i for i in np.lexsort((np.arange(len(scores)), -scores)).tolist() if i != 5][:10]
    assert hits.place.tolist() == best


def test_cells_come_in_order_of_their_bounds():
    rng = np.random.default_rng(15)
    for sizes in ((1, 1), (1, 7), (6, 9)):
        first_half, second_half = (rng.integers(-5, 6, n).astype(float) for n in sizes)
        cells = list(negatives.cells_in_order(first_half, second_half))
        assert [bound for bound, _, _ in cells] == sorted((bound for bound, _, _ in cells), reverse=True)
        assert len({cell[1:] for cell in cells}) == sizes[0] * sizes[1]
        assert all(bound == first_half[i] + second_half[j] for bound, i, j in cells)


def test_cells_below_the_window_are_not_read(monkeypatch):
    rng = np.random.default_rng(16)
    shard, asked = shard_of_clusters()
    books = [np.unique(shard.values[shard.first][:, half], axis=0).astype(float) for half in negatives.halves(8)]
    codes = [negatives.distances(shard.values[:, half].astype(float), book).argmin(axis=1) for half, book in zip(negatives.halves(8), books)]
    order = np.argsort(codes[0] * len(books[1]) + codes[1], kind="stable")
    units, first_row = np.unique((codes[0] * len(books[1]) + codes[1])[order], return_index=True)
    shard.units, shard.first, shard.end = units, first_row, np.append(first_row[1:], len(order))
    shard.values, shard.ids, shard.rows = shard.values[order], shard.ids[order], shard.rows[order]
    shard.labels = rng.integers(0, 2, len(order))
    far = [
        np.array([np.sqrt(((shard.values[:, half][code[order] == i] - book[i]) ** 2).sum(axis=1)).max(initial=0) for i in range(len(book))])
        for half, book, code in zip(negatives.halves(8), books, codes)
    ]
    scores = vectors.dot(asked.values, shard.values)[0]
    asked.floor, asked.ceiling = np.array([int(scores.max() * 0.3)]), np.array([int(scores.max() * 0.9)])
    read = []
    plain = negatives.dot
    monkeypatch.setattr(negatives, "dot", lambda a, b: read.append(len(b)) or plain(a, b))
    hits = negatives.multi_sequence(books, far, same=False)(shard, asked, 10)
    assert sum(read) < len(order) / 2
    fit = np.nonzero((shard.labels != 0) & (scores >= asked.floor) & (scores <= asked.ceiling))[0]
    expected = fit[np.lexsort((shard.ids[fit], -scores[fit]))][:10]
    assert shard.ids[hits.place].tolist() == shard.ids[expected].tolist()


def test_queries_give_their_columns(spark):
    for name, columns in (
        ("op11_merkle_manifest", "doc_id leaf subroot root proof_sha256 folded_root verified"),
        ("op12_top_k", "query_id rank vec_id score"),
        ("op13_hard_negatives", "anchor_id positive_id rank negative_id positive_score negative_score"),
    ):
        assert queries.queries()[name](spark, FOLDER).columns == columns.split()
