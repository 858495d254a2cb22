"""Near duplicates against brute force, on given and made documents; components against union-find."""

import random
import re

import pytest

from llm_cases import SF, documents  # noqa: F401

from sparkchecks.llm import neardup, storage
from sparkchecks.llm.components import components
from sparkchecks.llm.neardup import near_duplicates
from sparkchecks.llm.queries import QUERIES


def shingle_set(text, k):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def joined(n, pairs):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def brute(rows, k, percent):
    """Per row in the order of ids: set size and smallest linked id."""
    rows = sorted(rows)
    sets = [shingle_set(t, k) for _, t in rows]
    index = {}
    for i, s in enumerate(sets):
        for x in s:
            index.setdefault(x, []).append(i)
    common = {}
    for own in index.values():
        for y, b in enumerate(own):
            for a in own[:y]:
                common[a, b] = common.get((a, b), 0) + 1
    links = [p for p, n in common.items() if 100 * n >= percent * (len(sets[p[0]]) + len(sets[p[1]]) - n)]
    return {rows[i][0]: (len(sets[i]), rows[c][0]) for i, c in enumerate(joined(len(rows), links))}


def found(df):
    rows = df.collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows if r.doc_id is not None)
    return {r.doc_id: (r.n_shingles, r.component_id) for r in rows}


def test_given_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert found(QUERIES["op9_minhash_near_dedup"](spark, SF)) == brute(rows, 3, 85)


@pytest.mark.parametrize(("k", "percent", "chunk"), [(3, 85, 256), (5, 80, 8)])
def test_dense_groups_around_the_threshold(spark, documents, monkeypatch, k, percent, chunk):
    """Copies with more and fewer edits: many pairs on both sides of the threshold."""
    monkeypatch.setattr(neardup, "CHUNK", chunk)
    rng = random.Random(6)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for n in (0, 1, 2, 3, 4, 5, 6, 8):
        for _ in range(12):
            words = list(base)
            for i in rng.sample(range(120), n):
                words[i] = f"x{rng.randrange(10**6)}"
            texts.append(" ".join(words))
    chain = [f"c{i}" for i in range(200)]
    texts += [" ".join(chain[8 * i : 8 * i + 110]) for i in range(12)]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    assert found(near_duplicates(documents([(i, t, None, None) for i, t in rows]), k, percent)) == brute(rows, k, percent)


def test_defined_cases(spark, documents):
    long = " ".join(f"l{i}" for i in range(30_000))
    rows = [(9, None), (8, ""), (7, " \n"), (6, "One TWO"), (5, "one two"), (4, "two one"), (3, "one"), (2, "a b c d"), (1, "A\tB  C\nd"), (11, long), (10, long + " end"), (12, "É b c"), (13, "é b c"), (14, "a b c d e"), (14, "a b c d e")]
    got = found(near_duplicates(documents([(i, t, None, None) for i, t in rows]), 3, 85))
    want = brute(rows[:-1], 3, 85)
    assert got == want
    assert got[9] == (0, 9) and got[6] == got[5] == (1, 5) and got[4] == (1, 4) and got[2] == got[1] == (2, 1) and got[11] == (29999, 10) or got[11][1] == 10
    none = near_duplicates(documents([(None, "a b c", None, None), (None, "a b c", None, None), (1, "a b c", None, None)])).collect()
    assert sorted((str(r.doc_id), str(r.component_id), r.kept) for r in none) == [("1", "1", True), ("None", "None", True), ("None", "None", True)]
    assert near_duplicates(documents([(1, "a", None, None)]).limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(2))
def test_components(spark, seed):
    rng = random.Random(seed)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(300, 420)] + [(500, 500 + i) for i in range(60)]
    df = spark.createDataFrame([*pairs, (None, 1), (3, None), (7, 7)], "a long, b long")
    want = joined(600, pairs)
    touched = {x for p in pairs if p[0] != p[1] for x in p}
    assert {r.node: r.component for r in components(df).collect()} == {x: want[x] for x in touched}
    assert components(df.limit(0)).count() == 0


def test_one_id_with_several_texts(spark, documents):
    a = " ".join(f"a{i}" for i in range(120))
    b = " ".join(f"b{i}" for i in range(199))
    rows = [(1, a), (5, a), (5, b), (8, b), (9, b.replace("b100 ", "x ")), (5, b), (5, ""), (5, None), (None, a)]
    docs = documents([(i, t, None, None) for i, t in rows])
    got = near_duplicates(docs, 3, 85).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == sorted(
        [("1", 118, "1"), ("5", 118, "1"), ("5", 197, "5"), ("5", 197, "5"), ("8", 197, "5"), ("9", 197, "5"), ("5", 0, "5"), ("5", 0, "5"), ("None", 118, "None")]
    )
    kept = neardup.one_of_each(docs, 3, 85)
    assert kept.columns == docs.columns
    assert sorted((str(r.doc_id), r.text or "") for r in kept.collect()) == sorted([("1", a), ("5", b), ("5", ""), ("5", ""), ("None", a)])


def test_bands_follow_the_threshold():
    for percent in range(50, 100):
        bands, rows = neardup.banding(percent)
        assert bands <= neardup.MOST_BANDS and (1 - (percent / 100) ** rows) ** bands <= neardup.MISSED
    assert neardup.banding(85) == (76, 11) and neardup.banding(80) == (76, 8)
    assert neardup.banding(100)[0] == 1


def test_chance_meetings_are_few(spark, documents):
    """Documents that share a third of their passages: hardly a bucket joins them."""
    rng = random.Random(9)
    passages = [" ".join(f"p{i}w{j}" for j in range(40)) for i in range(30)]
    rows = [(i, " ".join(rng.sample(passages, 3) + [f"own{i}n{j}" for j in range(150)]), None, None) for i in range(300)]
    sig = neardup.signatures(documents(rows).selectExpr("doc_id", "text", "1 AS carried"), 5, 80)
    shared = sig.selectExpr("explode(bands) AS k").groupBy("k").count().filter("count > 1").count()
    assert shared <= 30
    assert found(near_duplicates(documents(rows), 5, 80)) == brute([r[:2] for r in rows], 5, 80)


@pytest.mark.parametrize(("k", "percent"), [(3, 85), (5, 80)])
def test_pairs_of_a_dense_group_grow_with_its_members(spark, documents, monkeypatch, k, percent):
    """Near copies that share most buckets, few of them links: some pairs for each member, all links found."""
    rng = random.Random(12)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for d in range(300):
        words = list(base)
        for i in rng.sample(range(150), 3 + d % 3):
            words[i] = f"x{rng.randrange(10**6)}"
        rows.append((d, " ".join(words)))
    compared = []
    alike = neardup._alike
    monkeypatch.setattr(neardup, "_alike", lambda pairs, least: (compared.append(pairs.count()), alike(pairs, least))[1])
    assert found(near_duplicates(documents([(i, t, None, None) for i, t in rows]), k, percent)) == brute(rows, k, percent)
    assert sum(compared) <= 30 * len(rows), compared


@pytest.mark.parametrize(("k", "percent"), [(3, 85), (5, 80)])
def test_beyond_the_broadcast_limit_bands_are_shuffled_once(spark, documents, no_broadcast, monkeypatch, k, percent):
    """Narrow sides that can't be broadcast: bands are exploded once, and rows with bands and minima stay where they are."""
    rng = random.Random(15)
    rows = []
    for d in range(90):
        words = [f"{d // 3}w{i}" for i in range(120)]
        for i in rng.sample(range(120), d % 3):
            words[i] = f"x{rng.randrange(10**6)}"
        rows.append((d, " ".join(words)))
    rows += [(100 + d, t) for d, t in rows[:25]]
    monkeypatch.setattr(storage, "BROADCAST_ROWS", 20)
    plans = []
    kept = neardup.stored
    monkeypatch.setattr(neardup, "stored", lambda df, *a, **m: (plans.append((df.columns, df._jdf.queryExecution().executedPlan().toString())), kept(df, *a, **m))[1])
    assert found(near_duplicates(documents([(i, t, None, None) for i, t in rows]), k, percent)) == brute(rows, k, percent)
    assert sum("Generate explode(bands" in p for _, p in plans) == 1
    wide = [p for c, p in plans if {"bands", "minima"} & {*c}]
    assert len(wide) >= 2 and not any("Exchange hashpartitioning" in p for p in wide)
