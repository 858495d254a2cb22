"""Targets against iterated resharing, quotas, shards, and defined cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_cases import SF, documents  # noqa: F401

from sparkchecks.llm import mixing
from sparkchecks.llm.queries import QUERIES


def reshared(sizes, weights=mixing.WEIGHTS, cap=mixing.CAP):
    """Cut off what is above the cap and share it by weight, again and again."""
    w = np.array([weights[i % len(weights)] for i in range(len(sizes))], float)
    total, limit = sum(sizes), cap * np.array(sizes, float)
    fixed = np.zeros(len(sizes), bool)
    while True:
        free = total - limit[fixed].sum()
        target = np.where(fixed, limit, free * w / max(w[~fixed].sum(), 1e-300))
        above = ~fixed & (target > limit)
        if not above.any():
            return target
        fixed |= above


@pytest.mark.parametrize("sizes", [[10], [100, 1, 1, 50, 3, 900], [0, 0, 5], [0, 0], [1, 1000, 1, 1, 1, 1, 1000, 0, 7]])
def test_targets(spark, sizes):
    names = [None if i == len(sizes) - 1 and i else f"s{i}" for i in range(len(sizes))]
    df = spark.createDataFrame([(n, s, 1) for n, s in zip(names, sizes, strict=True)], "source string, source_size long, docs long")
    rows = mixing.targets(df).orderBy("sid").collect()
    assert [r.source for r in rows] == names
    assert np.allclose([r.target for r in rows], reshared(sizes))


def test_split_is_exact_and_repeatable():
    quotas = np.array([1000, 0, 37, 1])
    out = mixing.split(quotas, 13, 5)
    assert (out.sum(axis=1) == quotas).all()
    assert np.ptp(out.sum(axis=0)) <= 1
    assert (out == mixing.split(quotas, 13, 5)).all() and (out != mixing.split(quotas, 13, 6)).any()
    # Each shard's share of a source has the hypergeometric mean.
    many = np.mean([mixing.split(quotas, 13, s)[0] for s in range(300)], axis=0)
    assert np.allclose(many, 1000 / 13, rtol=0.05)


def checked(rows, smallest):
    by = {}
    for r in rows:
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.copies * r.size
        by.setdefault((r.source_size, r.target), []).append(r)
    for (_, target), own in by.items():
        assert abs(sum(r.taken for r in own) - target) <= smallest(own) / 2 + 1


def test_given_documents(spark):
    first, again = (sorted(map(tuple, QUERIES["op5_mixing"](spark, SF).collect()), key=str) for _ in range(2))
    assert first == again
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = QUERIES["op5_mixing"](spark, SF).collect()
    assert len(rows) == docs.count()
    checked(rows, lambda own: max(r.size for r in own))
    repartitioned = sorted(map(tuple, mixing.mix_plan(docs.repartition(7)).collect()), key=str)
    assert repartitioned == first


def test_many_blocks(spark, documents, monkeypatch):
    monkeypatch.setattr(mixing, "WORDS_PER_SHARD", 3000)
    rows = [(i, "w " * (1 + i % 9), "en", "abc"[i % 3] if i % 10 else None) for i in range(3000)]
    docs = documents(rows)
    got = mixing.mix_plan(docs).collect()
    checked(got, lambda own: 9)
    copies = {r.doc_id: r.copies for r in got}
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    ids = [r.doc_id for r in mixed.select("doc_id").collect()]
    assert {i: ids.count(i) for i in set(ids)} == {i: n for i, n in copies.items() if n}
    assert ids != sorted(ids)
    place = np.array(ids) % 3 == 0  # sources stay mixed along the output
    assert all(0.02 < chunk.mean() < 0.98 for chunk in np.array_split(place, 5))


def test_defined_cases(spark, documents):
    rows = [(1, None, None, "a"), (2, "", None, "a"), (3, "x y", None, None), (3, "x y", None, None), (None, "z", None, "b"), (None, None, None, None), (4, "long " * 30_000, None, "c")]
    got = mixing.mix_plan(documents(rows)).collect()
    assert len(got) == len(rows)
    checked(got, lambda own: max(r.size for r in own) * 2)
    assert mixing.mix_plan(documents(rows[:1]).limit(0)).count() == 0
    assert mixing.mix(documents(rows[:1]).limit(0)).count() == 0
    nothing = mixing.mix_plan(documents(rows[:2])).collect()
    assert {r.taken for r in nothing} == {0}
    assert mixing.mix(documents(rows)).agg(F.count("*")).first()[0] == sum(r.copies for r in got)


def test_targets_are_met_as_near_as_single_documents_allow(spark, documents):
    """Few large documents: no document that is still open would bring a source nearer to its target."""
    rows = [(i, "w " * n, "en", src) for i, (src, n) in enumerate([("a", 20_000)] * 3 + [("a", 15)] * 3 + [("b", 700)] * 9 + [("b", 1)] * 2 + [("c", 90_000), ("c", 13)] + [("d", 40 + 7 * k) for k in range(60)])]
    got = mixing.mix_plan(documents(rows)).collect()
    by = {}
    for r in got:
        by.setdefault(rows[r.doc_id][3], []).append(r)
    for own in by.values():
        target, sum_taken = own[0].target, sum(r.taken for r in own)
        passes = int(target // own[0].source_size)
        miss = target - sum_taken
        assert all(0 <= r.copies <= 3 for r in own)
        free = [r.size for r in own if r.copies == passes]
        assert all(abs(miss - s) >= abs(miss) for s in free), (miss, free)


def test_large_mixtures_are_split_by_tasks(spark, monkeypatch):
    """Ten thousand sources and 50,000 shards: the driver holds a bounded part of the tree, the rows are exact."""
    rng = np.random.default_rng(1)
    quotas = {i: int(n) for i, n in enumerate(rng.integers(0, 30, 2_000))}
    total, shards = sum(quotas.values()), 4_000
    whole = mixing.split(np.array([quotas[i] for i in range(2_000)]), shards, 3)
    for held in (0, 10_000, 10**7):
        monkeypatch.setattr(mixing, "HELD", held)
        rows = mixing.dealt_shards(spark, quotas, shards, 3).collect()
        assert len(rows) == total
        got = np.zeros_like(whole)
        for r in rows:
            got[r.sid, r.shard] += 1
        assert (got == whole).all()
        numbers = {}
        for r in sorted(rows, key=lambda r: (r.sid, r.number)):
            own = numbers.setdefault(r.sid, [])
            assert r.number == len(own) and (not own or own[-1] <= r.shard)
            own.append(r.shard)
    monkeypatch.setattr(mixing, "HELD", 4_000_000)
    many = {i: 5 for i in range(10_000)}
    per = mixing.dealt_shards(spark, many, 50_000, 3).groupBy("shard").count().agg(F.count("*"), F.sum("count"), F.max("count")).first()
    assert tuple(per) == (50_000, 50_000, 1)
