"""Collocations against counting everything in Python; transducers against plain dictionaries."""

import random
import re
import tracemalloc
from collections import Counter

import pytest
from pyspark.sql import functions as F

from llm_cases import documents  # noqa: F401

from sparkchecks.llm.collocations import collocations, cut_at, phrase_counts, shards, splits, texts_of, united
from sparkchecks.llm.transducer import DEPTH, Transducer, merged, union


def windows(text):
    out = Counter()
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
        w = re.findall(r"[^ \t]+", piece)
        out.update(tuple(w[i : i + DEPTH]) for i in range(len(w)))
    return out


def spelled(t):
    return {tuple(x.decode() for x in t.window(i)): int(t.weights[i]) for i in range(len(t.paths))}


def slow(rows, least=30, percent=80, top=2000):
    out = []
    by_lang = {}
    for _, text, lang, *_ in rows:
        by_lang.setdefault(lang or "und", Counter()).update(windows(text or ""))
    for lang, seen in by_lang.items():
        f = Counter()
        for w, c in seen.items():
            for k in range(1, len(w) + 1):
                f[w[:k]] += c
        n = sum(seen.values())
        long = {w: a for w, a in f.items() if len(w) > 1 and a >= least}
        kept = []
        for w, a in long.items():
            if any(100 * b >= percent * a for v, b in long.items() if len(v) > len(w) and any(v[i : i + len(w)] == w for i in range(len(v)))):
                continue
            score, _, l, r = min((2_000_000 * a // (f[w[:k]] + f[w[k:]]), k, f[w[:k]], f[w[k:]]) for k in range(1, len(w)))
            kept.append((-score, -a, " ".join(w).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n, -score))
    return sorted(out)


def text_of(rng, words, n):
    return "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ", ", ".\n"]) for _ in range(n))


@pytest.mark.parametrize("seed", range(8))
def test_transducers(seed):
    rng = random.Random(seed)
    words = ["a", "b", "ab", "É", "é", "日本", "Ab", "a\x01", "z" * 70][: rng.randint(1, 9)]
    texts = [text_of(rng, words, rng.choice([0, 1, 3, 400])) for _ in range(5)]
    parts = [Transducer.of_text(t.encode()) for t in texts]
    for t, p in zip(texts, parts):
        assert spelled(p) == windows(t)
        again = Transducer.from_bytes(p.to_bytes())
        assert spelled(again) == windows(t)
        assert [again.window(i) for i in range(len(again.paths))] == sorted(again.window(i) for i in range(len(again.paths)))
    whole = union(parts)
    seen = sum((windows(t) for t in texts), Counter())
    assert spelled(whole) == seen
    order = sorted(tuple(x.encode() for x in w) for w in seen)
    for probe in [*order[::7], (b"a", b"zz"), (b"\xff",), (b"a",), ()]:
        assert whole.place(probe) == sum(w < probe for w in order)
    lo, hi = len(order) // 3, len(order) - len(order) // 4
    middle = Transducer.from_bytes(whole.between(lo, hi).to_bytes())
    assert [middle.window(i) for i in range(len(middle.paths))] == order[lo:hi]
    for d in range(1, DEPTH + 1):
        f = Counter()
        for w, c in seen.items():
            if len(w) >= d:
                f[w[:d]] += c
        phrases, sums = whole.phrases(d, 3)
        got = dict(zip((p.as_py().decode() for p in phrases), sums.tolist()))
        assert all(f[tuple(p.split(" "))] == c for p, c in got.items())
        assert {p for p, c in f.items() if c >= 3} <= {tuple(p.split(" ")) for p in got}


def test_equal_states_are_written_once():
    plain = " . ".join(f"w{i} the same end" for i in range(3000)).encode()
    other = " . ".join(f"w{i} the same end{i}" for i in range(3000)).encode()
    assert len(Transducer.of_text(plain).to_bytes()) < 0.7 * len(Transducer.of_text(other).to_bytes())


def test_long_texts_are_cut_without_loss():
    rng = random.Random(3)
    for text in (text_of(rng, ["a", "b", "c"], 500), " ".join(rng.choices(["aa", "b", "cé"], k=700)), "x" * 900, "a b " + "y" * 500 + " c d e"):
        seen = Counter()
        for part, own in texts_of([text.encode()], 40):
            seen.update(spelled(Transducer.of_text(part)))
            if own < len(part):
                seen.subtract(spelled(Transducer.of_text(part[own:])))
        assert +seen == windows(text)


@pytest.mark.parametrize("size, span, step", [(8 << 20, 2_000_000, 100_000), (300, 150, 20), (2000, 40, 3)])
def test_phrases_and_scores(spark, documents, size, span, step):
    rng = random.Random(size)
    words = ["the", "of", "New", "york", "city", "hall", "École", "É", "日本", "x\x01", "a-b"]
    rows = [(i, text_of(rng, words, 60) + " new york city hall" * rng.randint(0, 3), rng.choice(["en", "de", None, "und"]), None) for i in range(80)]
    rows += [(None, "the of the of " * 90, "en", None), (3, None, "en", None), (3, "", "fr", None), (4, "one one " * 700, "de", None)]
    counts = phrase_counts(documents(rows), 12, size=size, window_range=span, step=step)
    got = sorted(tuple(r) for r in collocations(counts, 12).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())
    assert got == slow(rows, 12)
    few = sorted(tuple(r) for r in collocations(counts, 12, top=5).collect())
    assert few == slow(rows, 12, top=5)


def test_scores_beyond_64_bits(spark):
    a = 9_000_000_000_000_000
    counts = spark.createDataFrame([("en", 0, "", 4 * a), ("en", 1, "x", a + 1), ("en", 1, "y", 2 * a), ("en", 2, "x y", a)], "lang string, size int, phrase string, f long")
    r = collocations(counts).first()
    assert (r.score, r.l, r.r, r.n) == (2_000_000 * a // (3 * a + 1), a + 1, 2 * a, 4 * a)


def test_empty(spark, documents):
    for rows in ([(1, None, None, None), (2, "", "en", None), (3, " .\n", "en", None)], []):
        assert collocations(phrase_counts(documents(rows or [(1, "a", None, None)]).limit(len(rows)))).collect() == []


def test_union_holds_little_besides_parts_and_result():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(4000)]
    parts = [Transducer.of_text(" ".join(rng.choices(words, k=100_000)).encode()) for _ in range(8)]
    tracemalloc.start()
    whole = union(parts)
    _, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert len(whole.paths) > 790_000 and int(whole.weights.sum()) == 800_000
    assert most < 70 * 800_000  # 24 of them are the result


@pytest.mark.parametrize("block", [1, 9, 64, 5000])
def test_pieces_of_a_union(block):
    rng = random.Random(block)
    texts = [text_of(rng, ["a", "b", "c", "École", "x" * 70][: 2 + i % 4], rng.choice([1, 30, 400])) for i in range(12)]
    pieces = list(merged([Transducer.of_text(t.encode()) for t in texts], block))
    order = [p.window(i) for p in pieces for i in range(len(p.paths))]
    assert order == sorted(set(order)) and (len(pieces) > 1) == (block < 500)
    assert {k: v for p in pieces for k, v in spelled(p).items()} == sum((windows(t) for t in texts), Counter())


def test_ranges_are_even_whatever_the_number_of_shards(spark, documents):
    rng = random.Random(7)
    words = [f"w{i}" for i in range(2000)]
    rows = [(i, " ".join(rng.choices(words, k=1000)), "en", None) for i in range(200)]
    written = shards(documents(rows).repartition(4), size=16_000, step=1000).cache()
    assert written.count() >= 40
    at = splits(written, 4000, 1000)
    cut = cut_at(written, at).collect()
    of = Counter()
    for r in cut:
        of[r.range] += len(Transducer.from_bytes(r.blob).paths)
    assert 40 <= len(of) <= 60 and max(of.values()) <= 3 * 4000
    assert sum(int(Transducer.from_bytes(r.blob).weights.sum()) for r in cut) == 200_000
    written.unpersist()


def test_each_task_unites_four_ranges(spark, documents):
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choices(["a", "b", "c", "d", "e", "f", "g"], k=400)), "en", None) for i in range(20)]
    written = shards(documents(rows).repartition(2), size=1500, step=50).cache()
    at = splits(written, 300, 50)
    ranges = sum(len(w) + 1 for _, w in at.values())
    counts = united(cut_at(written, at), ranges, 1)
    assert ranges > 8 and counts.rdd.getNumPartitions() == -(-ranges // 4)
    own = counts.withColumn("task", F.spark_partition_id()).filter("size = 0").groupBy("task").count()
    assert max(r["count"] for r in own.collect()) <= 4
    assert counts.filter("size = 0").agg(F.sum("f")).first()[0] == 8000
    written.unpersist()
