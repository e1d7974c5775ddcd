"""Ranked search over K2-treaps against plain scoring of every document."""

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanforge.llm import k2_treap
from spanforge.llm.k2_treap import Tree, build_tree, rank_documents

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, k):
    held = [(i, terms(t)) for i, t in docs]
    held = [(i, t) for i, t in held if t]
    n, length = len(held), sum(len(t) for _i, t in held)
    df = {}
    for _i, t in held:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    out = []
    for item, text in items:
        want, scored = [t for t in terms(text) if t in df], []
        for i, t in held:
            m = 75 + (25 * len(t) * n) // length
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[x] + 1))) * ((10**9 * t.count(x)) // (1000 * t.count(x) + 12 * m)) for x in want if x in t)
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scored, key=lambda x: x[:3])[:k])]
    return sorted(out, key=str)


def ranked(spark, docs, items, k):
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("item_id", "id", "n", "terms", "shard", "rank")})
    i = spark.createDataFrame(items, "item_id long, text string").withColumns({c: F.lit("x") for c in ("doc_id", "id", "item", "score")})
    return sorted(map(tuple, rank_documents(d.repartition(3), i, k).select("item_id", "rank", "doc_id", "score").collect()), key=str)


def test_tree_holds_every_point_and_maximum():
    r = np.random.default_rng(1)
    for n, side in ((1, 1), (1, 9), (40, 7), (900, 200), (5000, 3000)):
        cells = r.choice(side * side, min(n, side * side), replace=False)
        row, col, value = cells // side, cells % side, r.integers(1, 10**6, len(cells))
        tree = Tree(*build_tree(row, col, value))
        assert tree.value[0][0] == value.max() and len(tree.value[-1]) == len(cells)
        for x in r.choice(side, min(side, 20), replace=False):
            docs, scores = tree.search(np.array([x]), np.array([3]), side)
            want = sorted(zip(-3 * value[row == x], col[row == x]))
            assert list(zip(-scores, docs)) == want


def test_search_over_small_shards(spark, monkeypatch):
    monkeypatch.setattr(k2_treap, "SHARD_POSTINGS", 600)
    monkeypatch.setattr(k2_treap, "BLOCK_TERMS", 40)
    monkeypatch.setattr(k2_treap, "AT_ONCE", 3)
    r = random.Random(5)
    vocab = [f"w{i}" for i in range(300)] + ["É", "naïve", "日本", "x1y"]
    text = lambda n: " ".join(r.choice(vocab[:30] if r.random() < 0.6 else vocab) for _ in range(n))
    docs = [(i, text(r.randint(1, 60))) for i in range(200)]
    docs += [(500 + i, docs[3][1].upper()) for i in range(40)] + [(3, docs[3][1]), (3, "w1 w1"), (None, docs[3][1]), (None, None), (900, None), (901, ""), (902, " .,;- \t\n")]
    docs += [(950, text(4000)), (951, "w1\x00w2_w3[w4]w5"), (952, "ſ K É é")]
    items = [(i, text(12)) for i in range(20)] + [(40, docs[3][1]), (41, None), (42, ""), (43, "nowhere else"), (44, "W5 w5 w5, é!"), (1, "w7 w8"), (None, "w9 w10 w2")]
    assert ranked(spark, docs, items, 20) == plain(docs, items, 20)


@pytest.mark.parametrize("docs,items", [([], [(1, "a")]), ([(1, "a b")], []), ([(1, None)], [(1, "a")]), ([(1, "A a b"), (2, "c")], [(1, "a c c"), (2, "zz")])])
def test_small_tables(spark, docs, items):
    assert ranked(spark, docs, items, 20) == plain(docs, items, 20)


def test_little_of_the_grid_is_descended(monkeypatch):
    """A rare term's documents are found without halving the ranges of a common one."""
    monkeypatch.setattr(k2_treap, "AT_ONCE", 4)
    row = np.r_[np.zeros(4096, np.int64), np.full(5, 3000)]
    col = np.r_[np.arange(4096), np.array([7, 900, 901, 2000, 4000])]
    tree = Tree(*build_tree(row, col, np.full(len(row), 1000)))
    seen, halve = [], tree.halve
    tree.halve = lambda level, docs, *rest: (seen.append(len(docs)), halve(level, docs, *rest))[1]
    docs, scores = tree.search(np.array([0, 3000]), np.array([1, 50]), 5)
    assert docs.tolist() == [7, 900, 901, 2000, 4000] and set(scores) == {51_000} and sum(seen) < 400
