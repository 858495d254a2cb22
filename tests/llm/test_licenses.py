"""License statements: winnowing, alignment against brute force, planted statements."""

import re

import numpy as np
from llm_cases import SF, documents  # noqa: F401

from sparkchecks.llm import licenses
from sparkchecks.llm.licenses import TEMPLATES, Index, align, scan_licenses, winnow
from sparkchecks.llm.queries import QUERIES

LINES = ["apache-2.0", "mit", "gpl-3.0", "cc-by-nc-4.0", "all-rights-reserved"]


def tokens(text):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", text.translate({c: c + 32 for c in range(65, 91)}))


def test_winnowing_keeps_one_of_each_window():
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 3, 30):
        h = rng.integers(0, 9, n).astype(np.uint64)
        kept = winnow(h, 4)
        assert kept == sorted(set(kept))
        assert all(any(i <= k < i + 4 and h[k] == h[i : i + 4].min() for k in kept) for i in range(n - 3))


def test_every_template_finds_itself(spark, documents):
    for i, (name, text) in enumerate(TEMPLATES.items()):
        row = scan_licenses(documents([(i, f"Some words before. {text} And more after.", None, None)])).collect()
        assert [(r.license, r.coverage) for r in row] == [(name, 1.0)]


def test_alignment_with_edits():
    index = Index(TEMPLATES)
    t = index.names.index("apache-2.0-notice")
    words = index.words[t]
    rng = np.random.default_rng(1)
    edited = np.concatenate([rng.integers(1, 99, 5).astype(np.uint64), words[:20], words[22:50], rng.integers(1, 99, 3).astype(np.uint64), words[50:]])
    matched, first, end = align(words, edited, 5)
    assert matched >= len(words) - 4 and first == 5 and end == len(edited)


def test_given_documents(spark):
    """All lines planted whole are reported at their place; nothing in texts without their words."""
    rows = {}
    for r in QUERIES["op10_license_scans"](spark, SF).collect():
        rows.setdefault(r.doc_id, []).append(r)
    for doc in spark.read.parquet(f"{SF}/documents.parquet").collect():
        have = tokens(doc.text or "")
        got = rows.get(doc.doc_id, [])
        for name in LINES:
            want = tokens(TEMPLATES[name])
            n = sum(have[i : i + len(want)] == want for i in range(len(have)))
            assert len([r for r in got if r.license == name and r.coverage == 1.0]) == n
        for r in got:
            assert tokens(doc.text[r.start_char : r.end_char])[0] in tokens(TEMPLATES[r.license])
            assert r.coverage >= licenses.MIN_COVERAGE


def test_defined_cases(spark, documents):
    line = TEMPLATES["gpl-3.0"]
    rows = [(1, None, None, None), (2, "", None, None), (3, f"é日 {line.upper()}! x", None, None), (None, line, None, None), (4, line, None, None), (4, line, None, None)]
    rows += [(5, "word " * 50_000 + line + " " + line, None, None), (6, line.replace("General", "Generic"), None, None), (7, "This work is licensed to you", None, None)]
    got = scan_licenses(documents(rows)).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert {k: len(v) for k, v in by.items()} == {3: 1, None: 1, 4: 2, 5: 2, 6: 1}
    text = rows[2][1]
    assert text[by[3][0].start_char : by[3][0].end_char] == line.upper()
    assert by[6][0].coverage < 1
    assert scan_licenses(documents(rows[:1]).limit(0)).count() == 0


def test_repeats_at_short_distance(spark, documents):
    """A row for each place, however close together, at the places themselves."""
    lines = {"all-rights-reserved": ["All rights reserved. "], "mit": ["Released under the MIT License "], "cc-by-sa-4.0": ["Licensed under CC BY-SA 4.0; "]}
    lines["all-rights-reserved"].append("(c) 2021 Foo All rights reserved\n")
    texts = [(name, line, n) for name, some in lines.items() for line in some for n in (2, 3, 1000)]
    got = {}
    for r in scan_licenses(documents([(i, line * n, None, None) for i, (_, line, n) in enumerate(texts)])).collect():
        got.setdefault(r.doc_id, []).append(r)
    for i, (name, line, n) in enumerate(texts):
        begin = line.index(TEMPLATES[name])
        spans = [(k * len(line) + begin, k * len(line) + begin + len(TEMPLATES[name])) for k in range(n)]
        assert [(r.license, r.coverage, r.start_char, r.end_char) for r in got[i]] == [(name, 1.0, *s) for s in spans]


def test_every_word_of_a_short_template_may_be_missing(spark, documents):
    """Each word left out or replaced, and a word put in: found whenever alignment over the whole text finds it."""
    index = Index(TEMPLATES)
    texts, want = [], []
    for name, text in TEMPLATES.items():
        have = text.split()
        if len(tokens(text)) > 16:
            continue
        for i in range(len(have)):
            for change in ([], ["xyzzy"], [have[i], "xyzzy"]):
                texts.append(" ".join(["some", "words", *have[:i], *change, *have[i + 1 :], "and", "more"]))
                held = {w: h for n, ws in zip(index.names, index.words, strict=True) for w, h in zip(tokens(TEMPLATES[n]), ws, strict=True)}
                t = index.words[index.names.index(name)]
                matched = align(t, np.array([held.get(w, 0) for w in tokens(texts[-1])], np.uint64), 0, band=100)[0]
                want.append((name, matched) if matched >= licenses.MIN_COVERAGE * len(t) else None)
    got = {}
    for r in scan_licenses(documents([(i, x, None, None) for i, x in enumerate(texts)])).collect():
        got.setdefault(r.doc_id, []).append((r.license, r.matched))
    assert sum(x is not None for x in want) > 100
    for i, x in enumerate(want):
        assert x is None or x in got.get(i, []) or max(m for _, m in got[i]) >= x[1], texts[i]


def test_long_templates_keep_a_fingerprint():
    """Evenly spread changes are the hardest for runs."""
    for text in TEMPLATES.values():
        for size in {len(tokens(text)), 20, 33, 70}:
            run, window = licenses.run_and_window(size, licenses.MIN_COVERAGE)
            matched = licenses.needed(size, licenses.MIN_COVERAGE)
            pieces = size - matched + licenses.BAND + 1
            assert 1 <= run <= licenses.RUN and 1 <= window <= licenses.WINDOW
            assert -(-matched // pieces) >= run + window - 1
