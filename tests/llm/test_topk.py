"""Exact top-k against brute force, with ties, repeated rows and odd vectors."""

import numpy as np
import pytest
from pyspark.sql.types import DoubleType

from llm_cases import embeddings  # noqa: F401

from sparkchecks.llm import topk
from sparkchecks.llm.topk import Tree, search, top_k


def brute(vectors, queries, k):
    out = []
    for q, x in queries:
        scores = sorted((-int(np.dot(x, y)), i) for i, y in vectors if i != q and len(y) == len(x))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def whole(v):
    return [int(np.floor(1024 * float(x))) for x in v]


@pytest.mark.parametrize("block", [16_384, 50])
def test_random_and_clustered(spark, embeddings, monkeypatch, block):
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "LEAF", 5)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(6, 8))
    rows = [(i, (centres[i % 6] + 0.05 * rng.normal(size=8)).astype(np.float32).tolist()) for i in range(400)]
    rows += [(400 + i, rows[0][1]) for i in range(100)]  # many equal vectors, so many ties
    df = embeddings(rows)
    got = sorted(map(tuple, top_k(df, df.filter("vec_id % 10 = 0"), 7).collect()))
    vectors = [(i, whole(v)) for i, v in rows]
    assert got == brute(vectors, [v for v in vectors if v[0] % 10 == 0], 7)


def test_tree_covers_and_search_prunes(monkeypatch):
    monkeypatch.setattr(topk, "LEAF", 10)
    rng = np.random.default_rng(5)
    x = np.concatenate([c + rng.integers(-20, 20, (100, 6)) for c in rng.integers(-5000, 5000, (12, 6))])
    tree = Tree(x)
    assert sorted(tree.order) == list(range(len(x)))
    for i, kids in enumerate(tree.children):
        own = x[tree.order[tree.first[i] : tree.end[i]]]
        assert np.sqrt(((own - tree.centre[i]) ** 2).sum(axis=1)).max() <= tree.radius[i] + 1e-6
        assert not kids or [tree.first[i], tree.end[i]] == [min(tree.first[c] for c in kids), max(tree.end[c] for c in kids)]
    calls = []
    monkeypatch.setattr(topk, "_product", lambda a, b: calls.append(a.size * b.shape[0]) or a @ b.T)
    ids = np.arange(len(x))
    best, _ = search(tree, ids, x, np.array([-1, -2]), x[:2], np.full(2, -1e300), 10)
    assert (best == -np.sort(-(x[:2] @ x.T), axis=1)[:, :10]).all()
    assert sum(calls) < 0.8 * 2 * x.size  # some pairs were pruned


def test_defined_cases(spark, embeddings):
    nan, inf = float("nan"), float("inf")
    rows = [(100, [1.0, 2.0]), (1, [0.5, 0.5]), (1, [0.5, 0.5]), (2, [0.5, 0.5]), (3, None), (4, [None, 1.0]), (5, [nan, 1.0]), (6, [inf, 0.0]), (7, [1.0]), (8, []), (None, [9.0, 9.0]), (200, [-0.0001, 0.0]), (200, [-0.0001, 0.0]), (300, None)]
    df = embeddings(rows, DoubleType)
    got = sorted(map(tuple, top_k(df, df.filter("vec_id % 100 = 0")).collect()))
    vectors = [(100, whole([1, 2])), (1, whole([0.5, 0.5])), (2, whole([0.5, 0.5])), (7, whole([1])), (200, [-1, 0])]
    assert got == brute(vectors, [vectors[0], vectors[4]], 10)
    assert top_k(df.limit(0), df).count() == 0 and top_k(df, df.limit(0)).count() == 0


def test_scores_beyond_double_precision():
    big = np.array([[(1 << 30) + 1, 1]]), np.array([[(1 << 31) + 1, 3]])
    assert topk._product(*big)[0, 0] == ((1 << 30) + 1) * ((1 << 31) + 1) + 3
    with pytest.raises(OverflowError):
        topk._product(np.array([[1 << 40, 0]]), np.array([[1 << 40, 0]]))


def test_queries_visit_few_blocks(spark, embeddings, monkeypatch):
    """On clustered vectors most blocks are never visited, and no block gets all queries."""
    monkeypatch.setattr(topk, "BLOCK", 60)
    seen = []
    inner = topk._blocks

    def counted(rows, parts, k):
        visits = rows.filter("role = 1").groupBy("c").count().collect()
        seen.append((parts, sum(r["count"] for r in visits), max((r["count"] for r in visits), default=0)))
        return inner(rows, parts, k)

    monkeypatch.setattr(topk, "_blocks", counted)
    rng = np.random.default_rng(8)
    centres = 3 * rng.normal(size=(12, 16))
    rows = [(i, (centres[i % 12] + 0.02 * rng.normal(size=16)).astype(np.float32).tolist()) for i in range(1200)]
    df = embeddings(rows)
    got = sorted(map(tuple, top_k(df, df.filter("vec_id % 10 = 0"), 5).collect()))
    vectors = [(i, whole(v)) for i, v in rows]
    assert got == brute(vectors, [v for v in vectors if v[0] % 10 == 0], 5)
    (blocks, first, most), (_, second, _) = seen
    assert first == 120 and most <= 60
    assert first + second <= 0.5 * 120 * blocks


def test_large_components(spark, embeddings):
    """Scores are exact up to 63 bits, whatever the components; beyond them there is an error, never a missing row."""
    rows = [(1, [9e12, 1.0]), (2, [1e-3, 2.0]), (100, [0.5, 3.0]), (200, [0.001, -1.0])]
    df = embeddings(rows, DoubleType)
    got = sorted(map(tuple, top_k(df, df.filter("vec_id % 100 = 0")).collect()))
    exact = [(i, [int(np.floor(1024 * x)) for x in v]) for i, v in rows]

    def dot(a, b):
        return sum(x * y for x, y in zip(a, b))

    want = []
    for q, x in exact[2:]:
        ranked = sorted((-dot(x, y), i) for i, y in exact if i != q)
        want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(ranked)]
    assert got == sorted(want)
    for value in (1e17, 9e15):
        odd = embeddings([(100, [value, 1.0]), (2, [value, 1.0])], DoubleType)
        with pytest.raises(Exception, match="63 bits"):
            top_k(odd, odd.filter("vec_id = 100")).collect()
