"""Measures against brute force, sketches against exact quantiles, and what the limits keep."""

import re
from collections import Counter

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from llm_cases import SF, documents  # noqa: F401

from sparkchecks.llm import quality


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    runs = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts, covered = Counter(runs), set()
    for i, run in enumerate(runs):
        if counts[run] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines), len(lines) - len(set(lines)), len(covered))


COLUMNS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]


def test_measures_of_given_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = quality.measured(docs).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert tuple(r[c] for c in COLUMNS) == brute(texts[r.doc_id])


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.none(), st.text(st.sampled_from("ab \t\n\r\x0b\x0c\x1fé#|<日\xa0"), max_size=60)), min_size=20, max_size=40))
def test_measures_of_any_text(spark, documents, texts):
    rows = quality.measured(documents([(i, t, None, None) for i, t in enumerate(texts)])).collect()
    assert {r.doc_id: tuple(r[c] for c in COLUMNS) for r in rows} == {i: brute(t) for i, t in enumerate(texts)}


def test_buckets_are_ordered_and_narrow(spark):
    values = sorted({*range(3000), *np.random.default_rng(0).integers(0, 1 << 40, 3000).tolist()})
    df = spark.createDataFrame([(int(v),) for v in values], "v long").select("v", quality.bucket(F.col("v")).alias("b"))
    rows = df.withColumn("top", quality.bucket_value(F.col("b"))).orderBy("v").collect()
    assert [r.b for r in rows] == sorted(r.b for r in rows)
    assert all(r.v <= r.top <= r.v * (1 + 1 / 32) for r in rows)


def words(rng, n):
    return " ".join("".join(rng.choice(list("abcdefgh"), rng.integers(2, 9))) for _ in range(n))


def test_limits_follow_the_group(spark, documents):
    rng = np.random.default_rng(1)
    rows = [(i, words(rng, 80), "en", "a") for i in range(150)]
    rows += [(200 + i, words(rng, 60).replace(" ", "# "), "en", "b") for i in range(150)]  # usual in its source
    rows += [(400, words(rng, 60).replace(" ", "# "), "en", "a"), (401, words(rng, 60).replace(" ", "# "), None, None)]
    rows += [(402, words(rng, 10), "en", "a"), (403, "one two " * 50, "en", "a"), (404, None, "en", "a"), (405, "", None, "a")]
    rows += [(406, words(rng, 20_000), "en", "a"), (407, rows[0][1], "en", "a"), (407, rows[0][1], "en", "a")]
    got = {r.doc_id: (r.base_failed, r.kept) for r in quality.judge_quality(documents(rows)).collect()}
    assert all(got[i] == (False, True) for i in [*range(150), *range(200, 350), 401, 406, 407])
    assert got[400] == (False, False)
    assert all(got[i] == (True, False) for i in (402, 403, 404, 405))
    kept = quality.keep_good(documents(rows))
    assert kept.columns == documents(rows).columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r[0] for r in rows if got[r[0]][1])
    assert quality.judge_quality(documents(rows[:1]).limit(0)).count() == 0


def made(rng, n, lines, symbols, length, phrase):
    """A text of n words with usual repetition, symbols and word lengths."""
    out = ["".join(rng.choice(list("abcdefgh"), rng.integers(length, length + 4))) for _ in range(n)]
    for _ in range(phrase):
        out[rng.integers(0, n - 3)] = "one two three"
    text = "\n".join(" ".join(out[i : i + 8]) for i in range(0, n, 8))
    return text + "\nsame line" * lines + " #" * symbols


def test_limits_come_from_the_group(spark, documents):
    """Two languages of different habits have different limits of all measures, and each rule rejects outliers."""
    rng = np.random.default_rng(4)
    rows = [(i, made(rng, 90, int(rng.integers(0, 2)), int(rng.integers(0, 2)), 2, int(rng.integers(0, 2))), "en", "a") for i in range(400)]
    rows += [(1000 + i, made(rng, 90, int(rng.integers(2, 8)), int(rng.integers(5, 20)), 6, int(rng.integers(2, 6))), "de", "a") for i in range(400)]
    odd = {"dup_lines": (30, 0, 2, 0), "symbols": (0, 60, 2, 0), "word_length": (0, 0, 12, 0), "repeats": (0, 0, 2, 14)}
    rows += [(2000 + i, made(rng, 90, *x), "en", "a") for i, x in enumerate(odd.values())]
    measured = quality.measured(documents(rows))
    found = {r.lang: r for r in quality.limits(quality.sketches(measured)).filter("level = 1").collect()}
    for name in [*[f"hi_{k}" for k in quality.REACH], "lo_word_length"]:
        assert found["de"][name] > found["en"][name], name
    got = {r.doc_id: (r.base_failed, r.kept) for r in quality.judge_quality(documents(rows)).collect()}
    assert all(got[2000 + i] == (False, False) for i in range(len(odd)))
    usual = [k for i, (_, k) in got.items() if i < 2000]
    assert sum(usual) >= 0.98 * len(usual)


def test_each_rule_rejects_some_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    m = quality.measured(docs).cache()
    limits = {r.lang: r for r in quality.limits(quality.sketches(m)).filter("level = 1").collect()}
    rows = m.filter(~quality.base_failed()).select("lang", *[v.alias(k) for k, v in quality.measures().items()]).collect()
    for k in quality.REACH:
        high = {lang: x[f"hi_{k}"] for lang, x in limits.items() if x[f"hi_{k}"] is not None}
        assert any(r[k] > high[r.lang] for r in rows if r.lang in high), k
        assert len({x[f"hi_{k}"] for x in limits.values()}) > 1 or k == "symbols", k


def test_main_path_is_native(spark, documents):
    plan = quality.judge_quality(documents([(1, "a b c", "en", "s")]))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Cartesian", "NestedLoop"))
