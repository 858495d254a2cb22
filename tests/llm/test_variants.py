"""Near words, forms and roots against all pairs of words compared one by one."""

import random
import zlib
import re
from collections import Counter

import pytest

from llm_cases import SF, documents  # noqa: F401

from sparkchecks.llm.queries import QUERIES
from sparkchecks.llm.variants import Range, borders, common, letter_runs, numbered, variant_groups


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def slow(counts):
    near = {w: [v for v in counts if one_apart(w, v)] for w in counts}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None
    out = set()
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, counts[w], len(near[w]), form[w], counts[form[w]] if form[w] is not None else None, root))
    return out


def found(spark, counts):
    rows = variant_groups(spark.createDataFrame([*counts.items()], "word string, n long")).collect()
    assert len(rows) == len({r.word for r in rows})
    return {(r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in rows}


@pytest.mark.parametrize("seed", range(3))
def test_random_words(spark, seed):
    rng = random.Random(seed)
    letters = ["ab", "abé", "ab😀日"][seed]
    counts = {"".join(rng.choices(letters, k=rng.randint(1, 7))): rng.choice([1, 1, 2, 3, 4, 8, 16, 64]) for _ in range(350)}
    counts[""] = 1
    assert found(spark, counts) == slow(counts)


def test_runs_ties_and_long_words(spark):
    counts = {"aaaa": 1, "aaaaa": 2, "aaaaaa": 4, "baaaa": 4, "aaaab": 4, "x" * 30_000: 1, "x" * 30_001: 3, "x" * 15_000 + "y" + "x" * 15_000: 9}
    counts |= {"aaaa" + c: 4 for c in "cdefghijk"}
    assert found(spark, counts) == slow(counts)


def test_chains_are_followed_to_their_end(spark):
    counts = {"a" * k: 2**k for k in range(1, 40)}
    assert {x[5] for x in found(spark, counts)} == {"a" * 39}


def test_nodes_are_prefixes(spark):
    rng = random.Random(5)
    words = sorted({"".join(rng.choices("ab", k=rng.randint(0, 9))) for _ in range(400)})
    rows = numbered(spark.createDataFrame([(w,) for w in words], "key string").repartition(7)).collect()
    nodes = {}
    for r in rows:
        assert len(r.nodes) == len(r.key) + 1
        for d, node in enumerate(r.nodes):
            assert nodes.setdefault(node, r.key[:d]) == r.key[:d]
    assert len(nodes) == len({w[:d] for w in words for d in range(len(w) + 1)})
    assert [r.key for r in sorted(rows, key=lambda r: r.place)] == words


def test_borders_share_nodes_over_several_ranges():
    parts = borders([(0, "aa", "abca"), (1, "abcb", "abcc"), (4, "abcd", "abd"), (5, "b", "b")])
    assert all(isinstance(p, Range) for p in parts.values())
    assert parts[0].right == parts[1].left and parts[1].right == parts[4].left and parts[4].right == parts[5].left
    assert parts[0].right == parts[1].right and len(parts[0].right) == 4
    assert parts[5].left == parts[0].right[:1]
    assert (parts[0].left, parts[5].right) == ([], [])
    assert (common("abc", "abd"), common("", "a"), common("ab", "abc")) == (2, 0, 2)


def slow_runs(rows):
    counts = Counter()
    for i, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 97 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            if len(w) >= 5:
                counts[w] += 1
    return counts


def test_letter_runs(spark, documents):
    rng = random.Random(1)
    words = ["Straße", "ÉCOLE", "école", "summer", "x×y÷z", "abcde", "日本summer"] + ["".join(rng.choices("abcdeé", k=6)) for _ in range(400)]
    rows = [(i, " ".join(rng.choices(words, k=200)), None, None) for i in range(20)]
    rows += [(None, "summer winter", None, None), (3, None, None, None), (4, "", None, None), (3, "Summer", None, None), (3, "Summer", None, None)]
    got = {r.word: r.n for r in letter_runs(documents(rows)).collect()}
    assert got == dict(slow_runs(rows))


def test_given_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    counts = {w: n for w, n in slow_runs(rows).items() if n >= 3}
    some = {w: n for w, n in counts.items()}
    got = {(r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in QUERIES["op13_spelling_variants"](spark, SF).collect()}
    assert {(x[0], x[1]) for x in got} == set(counts.items())
    if len(some) < 4000:
        assert got == slow(some)


def test_empty(spark, documents):
    empty = spark.createDataFrame([(None, 5)], "word string, n long")
    assert variant_groups(empty).collect() == []
    again = spark.createDataFrame([("abcde", 1), ("abcde", 2), ("abcd", 7)], "word string, n long")
    assert {(r.word, r.n, r.form, r.form_n) for r in variant_groups(again).collect()} == {("abcde", 3, "abcd", 7), ("abcd", 7, None, None)}
    assert letter_runs(documents([(1, None, None, None)])).count() == 0
