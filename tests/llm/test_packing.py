"""Packing: nothing lost, no bin overfull, best fit against brute force, few tokens wasted."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from llm_cases import SF, documents  # noqa: F401

from sparkchecks.llm import packing
from sparkchecks.llm.queries import QUERIES


def slow_pack(sizes, lengths):
    """The same rules by search through all open bins: least room, then the bin filled last."""
    bins, where = [], []
    for k, s in enumerate(sizes):
        fits = [(room, -last, i) for i, (room, last, _) in enumerate(bins) if room >= s]
        if fits:
            i = min(fits)[2]
        else:
            c = min((c for c in lengths if c >= s), key=lambda c: (packing.cost(c) / min(c, sum(sizes[k:])), c))
            i = len(bins)
            bins.append((c, k, 0))
        bins[i] = (bins[i][0] - s, k, bins[i][2] + s)
        where.append(i)
    return where, [min(c for c in lengths if c >= filled) for _, _, filled in bins]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=60))
def test_pack_rules(sizes):
    sizes = sorted(sizes, reverse=True)
    lengths = (8, 16, 64)
    bins, offset, final = packing.pack(sizes, lengths)
    filled = np.zeros(len(final), int)
    for s, b, o in zip(sizes, bins, offset, strict=True):
        assert o == filled[b]
        filled[b] += s
    assert all(f == min(c for c in lengths if c >= x) for f, x in zip(final, filled, strict=True))
    assert (bins, final) == slow_pack(sizes, lengths)


def test_joint_lengths_beat_one_length():
    rng = np.random.default_rng(0)
    sizes = sorted(rng.lognormal(6, 1.2, 5000).astype(int).clip(1, 8192).tolist(), reverse=True)
    total = lambda lengths: sum(map(packing.cost, packing.pack(sizes, lengths)[2]))
    assert total(packing.LENGTHS) < min(total((8192,)), total((512, 8192)))
    assert sum(sizes) / sum(packing.pack(sizes)[2]) > 0.97


def whole(rows, top=max(packing.LENGTHS)):
    """Checks pieces and sequences; returns the tokens of each document."""
    tokens, seqs = {}, {}
    for r in rows:
        tokens.setdefault(r.doc_id, []).append((r.start, r.n_tokens))
        if r.seq_id is None:
            assert r.n_tokens == 0 and r.capacity is None and r.offset is None
        else:
            seqs.setdefault(r.seq_id, []).append(r)
    for own in seqs.values():
        own.sort(key=lambda r: r.offset)
        end = 0
        for r in own:
            assert r.offset == end and r.capacity == own[0].capacity and 0 < r.n_tokens <= top
            end += r.n_tokens
        assert own[0].capacity == min(c for c in packing.LENGTHS if c >= end)
    return tokens


def test_given_documents(spark):
    rows = QUERIES["op6_best_fit_packing"](spark, SF).collect()
    tokens = whole(rows)
    docs = {r.doc_id: len((r.text or "").split()) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert set(tokens) == set(docs)
    for doc, parts in tokens.items():
        parts.sort()
        assert [s for s, _ in parts] == [i * 8192 for i in range(len(parts))]
        assert sum(n for _, n in parts) == docs[doc]
    seqs = {r.seq_id: r.capacity for r in rows if r.seq_id is not None}
    assert sum(docs.values()) / sum(seqs.values()) > 0.9


def test_defined_cases(spark, documents, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_PIECES", 50)
    monkeypatch.setattr(packing, "FLUSH", 40)
    rows = [(1, None, None, None), (2, "", None, None), (None, "a b", None, None), (3, "x " * 20_000, None, None)]
    rows += [(4, "same words here", None, None)] * 300 + [(10 + i, "w " * (i % 50), None, None) for i in range(400)]
    got = packing.pack_documents(documents(rows), packing.word_count(F.col("text"))).collect()
    tokens = whole(got)
    assert sum(n for v in tokens.values() for _, n in v) == sum(len((t or "").split()) for _, t, *_ in rows)
    assert len(tokens[4]) == 300 and [n for _, n in sorted(tokens[3])] == [8192, 8192, 3616]
    assert tokens[1] == [(0, 0)] and tokens[None] == [(0, 2)]
    assert packing.pack_documents(documents(rows[:1]).limit(0), F.lit(1)).count() == 0
