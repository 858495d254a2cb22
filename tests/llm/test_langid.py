"""Held-out accuracy, the kernel against brute force, and defined cases."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_cases import SF, documents  # noqa: F401

from sparkchecks.llm import langid
from sparkchecks.llm.queries import QUERIES


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = QUERIES["op4_language_id"](spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == r.lang for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_presence_is_that_of_all_ngrams():
    table = langid._classes()
    text = "Ab, 12 ab!" + "x" * 3
    codes = [int(table[ord(c)]) for c in "\0" + text]
    codes = [c for i, c in enumerate(codes) if c or i == 0 or codes[i - 1]]
    base = [0, langid.SIZES[0], langid.SIZES[0] + langid.SIZES[1]]
    want = set()
    for n in (1, 2, 3):
        for i in range(len(codes) - n + 1):
            code = 0
            for c in codes[i : i + n]:
                code = code * langid.CLASSES + c
            want.add(base[n - 1] + code)
    got = set(langid.present(text, table).tolist())
    assert want <= got and len(got - want) <= 1  # the end of the text counts as a space


def test_long_texts_in_pieces(monkeypatch):
    table = langid._classes()
    text = "Der schnelle Fuchs, été 42 niño. " * 40
    whole = langid.present(text, table)
    monkeypatch.setattr(langid, "CHUNK", 7)
    assert np.array_equal(whole, langid.present(text, table))


def test_folded_scores_equal_the_kernel_form():
    """The folded matrix gives what kernel rows, Nystroem features and regression give one by one."""
    rng = np.random.default_rng(3)
    table = langid._classes()
    texts = [" ".join(rng.choice(["der", "und", "ist"] if i % 2 else ["the", "and", "is"], 6)) for i in range(30)]
    grams = [langid.present(t, table) for t in texts]
    labels = ["de" if i % 2 else "en" for i in range(30)]
    model = langid.fit(labels, grams)
    names, scores = langid.score(texts, model, table)
    assert names == labels and min(scores) > 0.5
    sets = [set(g.tolist()) for g in grams]
    kernel = np.array([[len(a & b) / np.sqrt(len(a) * len(b)) for b in sets] for a in sets])
    assert np.linalg.eigvalsh(kernel).min() > -1e-9


def test_defined_cases(spark, documents):
    rows = [(i, "the cat and the dog", "en", "s") for i in range(20)] + [(100 + i, "der Hund und die Katze", "de", "s") for i in range(20)]
    rows += [(200, None, "en", "s"), (201, "", None, None), (202, "123 !?", "en", "s"), (None, "the cat", "en", "s"), (203, "the dog and", None, None), (203, "the dog and", None, None)]
    rows += [(204, "die Katze und der Hund " * 20_000, None, None)]
    got = langid.identify(documents(rows)).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert all((by[i].lang_pred, by[i].score) == ("und", 0.0) for i in (200, 201, 202))
    assert by[203].lang_pred == "en" and by[204].lang_pred == "de" and by[None].lang_pred == "en" and not by[None].held_out
    assert langid.identify(documents(rows[:1]).limit(0)).count() == 0
    unlabelled = documents([(1, "the cat", None, None)])
    assert langid.identify(unlabelled).first().lang_pred == "und"


def test_held_out_rows_teach_nothing(spark, documents):
    """Labels of held-out rows may be anything."""
    rows = [(i, "the cat and the dog" if i % 2 else "der Hund und die Katze", "en" if i % 2 else "de", "s") for i in range(60)]
    false = [(i, t, "xx" if zlib.crc32(str(i).encode()) % 3 == 1 else lang, s) for i, t, lang, s in rows]
    key = lambda df: sorted(map(tuple, langid.identify(df).collect()))
    assert key(documents(rows)) == key(documents(false))


@pytest.mark.parametrize("allowed", [True, False])
def test_sample_is_bounded(spark, monkeypatch, allowed):
    monkeypatch.setattr(langid, "PER_LANGUAGE", 5)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    counts = langid.training_rows(docs, "doc_id", "lang", F.lit(allowed)).groupBy("lang").count().collect()
    assert all(r["count"] == 5 for r in counts) and bool(counts) == allowed


LETTERS = {"Cyrillic": "абвгдежзийклмнопрстуфхцчшщъыьэюя", "Arabic": "ابتثجحخدذرزسشصضطظعغفقكلمنهوي", "Adlam": "".join(map(chr, range(0x1E922, 0x1E944)))}


@pytest.mark.parametrize("script", LETTERS)
def test_languages_of_one_script_on_long_texts(script):
    """Two languages that share a script but not their words, on texts of thousands of words."""
    rng = np.random.default_rng(5)
    table = langid._classes()
    lexicon = {lang: ["".join(rng.choice(list(LETTERS[script]), rng.integers(3, 8))) for _ in range(1500)] for lang in ("aa", "bb")}
    labels = [lang for _ in range(20) for lang in lexicon]
    texts = [" ".join(rng.choice(lexicon[lang], 3000)) for lang in labels]
    model = langid.fit(labels[:20], [langid.present(t, table) for t in texts[:20]])
    names, scores = langid.score(texts[20:], model, table)
    assert names == labels[20:] and min(scores) > 0.5


def test_letters_have_classes_of_their_own():
    table = langid._classes()
    for letters in LETTERS.values():
        assert len({int(table[ord(c)]) for c in letters}) == len(letters)
    assert table[ord("Ж")] == table[ord("ж")] > 0 and table[ord("ि")] > 0 and table[ord("7")] == 0


def test_blocks_of_ngrams_change_nothing(monkeypatch):
    table = langid._classes()
    texts, labels = ["der Hund und die Katze", "the cat and the dog", "das Haus ist alt", "this house is old"], ["de", "en", "de", "en"]
    grams = [langid.present(t, table) for t in texts]
    whole = langid.fit(labels, grams)
    monkeypatch.setattr(langid, "BLOCK", 7)
    assert np.allclose(whole.weights, langid.fit(labels, grams).weights, atol=1e-4)
