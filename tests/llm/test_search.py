"""Ranked search against brute force; bounds of the ball tree; odd rows and ties."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from gradeledger.llm import balltree
from gradeledger.llm import search as module
from gradeledger.llm.balltree import BallTree, Queries, Vectors, in_parts
from gradeledger.llm.search import search, terms_of

PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_terms(text):
    return PATTERN.findall((text or "").translate(LOWER))


def brute(docs, items, k=10):
    """item_id, rank, doc_id, score from all documents for each item."""
    bags = [(i, Counter(plain_terms(t)), len(plain_terms(t))) for i, t in docs if plain_terms(t)]
    total, length = len(bags), sum(n for _, _, n in bags)
    df = Counter(w for _, bag, _ in bags for w in bag)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(plain_terms(text))
    out = []
    for item, terms in wanted.items():
        scored = []
        for doc_id, bag, n in bags:
            m = 100 - 90 + (90 * n * total) // length
            score = sum(
                math.floor(1000 * math.log((2 * total + 2) / (2 * df[w] + 1))) * ((10**9 * bag[w]) // (1000 * bag[w] + 8 * m))
                for w in terms & bag.keys()
            )
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0))
        for rank, (score, null, doc_id) in enumerate(sorted(scored)[:k], 1):
            out.append((item, rank, None if null else doc_id, -score))
    return sorted(out, key=repr)


def prose(rng, size, words=120):
    ranks = np.minimum(rng.zipf(1.3, size), words)
    return " ".join(f"t{r}" for r in ranks)


def random_vectors(rng, rows, width):
    data = [np.sort(rng.choice(width, int(rng.integers(1, min(width, 12))), replace=False)) for _ in range(rows)]
    starts = np.concatenate([[0], np.cumsum([len(d) for d in data])])
    return Vectors(list(range(rows)), starts, np.concatenate(data), rng.integers(1, 10**6, starts[-1]))


def random_queries(rng, n, width):
    data = [np.sort(rng.choice(width, int(rng.integers(0, 8)), replace=False)) for _ in range(n)]
    starts = np.concatenate([[0], np.cumsum([len(d) for d in data])])
    return Queries(starts, np.concatenate(data).astype(int), rng.integers(1, 25_000, starts[-1]))


def dense(v, width):
    out = np.zeros((len(v.starts) - 1, width), object)
    for i in range(len(out)):
        own = slice(v.starts[i], v.starts[i + 1])
        out[i, v.terms[own]] = [int(x) for x in (v.values if hasattr(v, "values") else v.weights)[own]]
    return out


@pytest.mark.parametrize("seed", range(6))
def test_bounds_hold_and_search_is_exact(seed):
    rng = np.random.default_rng(seed)
    width = int(rng.integers(12, 200))
    vectors, queries = random_vectors(rng, 300, width), random_queries(rng, 25, width)
    if seed == 0:
        vectors = vectors.take(np.zeros(300, int))  # one vector, 300 times
        vectors.ids = list(range(300))
    tree = BallTree(vectors, width, leaf=4)
    scores = dense(queries, width) @ dense(tree.vectors, width).T
    bounds = tree.bounds(queries)
    for node, (a, b) in enumerate(tree.nodes):
        assert (bounds[:, node] >= scores[:, a:b].max(axis=1).astype(float)).all()
    best = [[] for _ in range(len(queries))]
    for first, part in in_parts(queries, 30):
        tree.search(part, best[first : first + len(part)], 7)
    for i in range(len(queries)):
        assert best[i] == sorted((-s, False, d) for s, d in zip(scores[i], tree.vectors.ids, strict=True) if s > 0)[:7]


def test_search_prunes():
    """Texts of separate topics: the leaves of others aren't read."""
    rng = np.random.default_rng(3)
    topics = [np.sort(rng.choice(20, 8, replace=False)) + 20 * (i % 50) for i in range(1000)]
    starts = np.arange(0, 8001, 8)
    tree = BallTree(Vectors(list(range(1000)), starts, np.concatenate(topics), rng.integers(1, 1000, 8000)), 1000, leaf=8)
    query = Queries(np.array([0, 8]), topics[7], np.full(8, 100))
    best = [[]]
    assert tree.search(query, best, 3) < len([c for c in tree.children if c is None]) / 3


@pytest.mark.parametrize("text", ["", "A-b c_D", "É É été\x00x", "中文 a中", "İı ſ 1２3", "tab\tnew\nline\x1cx\x7fy~z", "ß" * 50])
def test_terms(text):
    assert [t.decode() for t in terms_of(text.encode())] == plain_terms(text)


@pytest.mark.parametrize("blocks", [1, 3])
def test_against_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(module, "TREE_ROWS", 40)
    monkeypatch.setattr(balltree, "LEAF", 4)
    rng = np.random.default_rng(blocks)
    docs = [(i, prose(rng, int(rng.integers(1, 60)))) for i in range(400)]
    items = [(i, prose(rng, int(rng.integers(1, 25)))) for i in range(30)]
    if blocks > 1:
        monkeypatch.setattr(module, "BLOCK_ENTRIES", sum(len({*plain_terms(t)}) for _, t in items) // blocks)
    frame = lambda rows, name: spark.createDataFrame(rows, f"{name} long, text string").repartition(3)
    got = sorted(map(tuple, search(frame(docs, "doc_id"), frame(items, "item_id")).collect()), key=repr)
    assert got == brute(docs, items)


def test_odd_rows(spark, odd, no_docs):
    """Nulls, repeats, ties, long texts and clashing names on both sides."""
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    items = [(1, "word1 WORD2 one"), (1, "w0x0 w1x1"), (2, None), (3, ""), (None, "line a b"), (5, "nowhere"), (6, "to"), (6, "to")]
    asked = spark.createDataFrame([(*i, 9, 9) for i in items], "item_id long, text string, doc_id long, score long")
    got = sorted(map(tuple, search(odd, asked).collect()), key=repr)
    assert got == brute(docs, items)
    assert search(no_docs, asked).count() == 0
    assert search(odd, asked.limit(0)).count() == 0


def test_ties_go_to_smaller_ids(spark):
    docs = [(i, "same text") for i in [*range(30, 0, -1), None, 5]]
    docs += [(100 + i, f"other{i}") for i in range(40)]
    got = search(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), spark.createDataFrame([(7, "same")], "item_id long, text string"))
    assert [(r.rank, r.doc_id) for r in sorted(got.collect(), key=lambda r: r.rank)] == list(enumerate([1, 2, 3, 4, 5, 5, 6, 7, 8, 9], 1))
