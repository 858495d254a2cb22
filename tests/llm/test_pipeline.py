"""The pipeline stage by stage against brute force, and its contract."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from corpus_pipeline import STAGES, best_fit_packing, language_id, minhash_near_dedup, mixing_sources, quality_rules
from llm_cases import SF, documents  # noqa: F401
from test_neardup import brute
from test_quality import brute as measures

from sparkchecks.llm.queries import ORACLE_SQL, QUERIES


def test_contract():
    names = contract.queries()
    assert [n for n in range(1, 14) if any(k.startswith(f"op{n}_") for k in names)] == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(names) and set(ORACLE_SQL) <= set(contract.oracle_sql())
    assert len(STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_stages_on_given_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    named = language_id(spark, docs, SF)
    assert named.columns == docs.columns
    has_letter = {r.doc_id for r in docs.collect() if any(map(str.isalpha, r.text or ""))}
    kept = named.collect()
    assert {r.doc_id for r in kept} <= has_letter and len(kept) >= 0.99 * len(has_letter)

    good = quality_rules(spark, named, SF)
    assert good.columns == docs.columns
    rows = good.collect()
    for r in rows:
        n, *_, repeated = measures(r.text)
        assert n >= 50 and 100 * repeated <= 50 * n
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    ids = {r.doc_id for r in rows}
    clean = [r.doc_id for r in kept if labels.get(r.doc_id) == 1 and measures(r.text)[0] >= 50 and 2 * measures(r.text)[-1] <= measures(r.text)[0]]
    assert sum(i in ids for i in clean) >= 0.98 * len(clean)
    assert not any(labels.get(i) == 0 for i in ids)

    alone = minhash_near_dedup(spark, good, SF)
    want = {d for d, (_, c) in brute([(r.doc_id, r.text) for r in rows], 5, 80).items() if d == c}
    assert rows_of(alone) == sorted((tuple(r) for r in rows if r.doc_id in want), key=str)

    mixed = mixing_sources(spark, alone, SF)
    assert mixed.columns == docs.columns
    counts = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert set(counts) <= want and max(counts.values()) <= 3

    packed = best_fit_packing(spark, mixed, SF)
    words = sum(len(r.text.split()) for r in mixed.collect())
    assert packed.agg(F.sum("n_tokens")).first()[0] == words


def test_run_equals_its_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in STAGES:
        docs = stage(spark, docs, SF)
    columns = ["doc_id", "piece", "start", "n_tokens", "capacity"]
    assert rows_of(corpus_pipeline.run(spark, SF).select(columns)) == rows_of(docs.select(columns))


def test_odd_rows(spark, documents):
    text = " ".join(f"word{i % 97}{'abcdefg'[i % 7]}" for i in range(90))
    other = " ".join(f"anderes{i}" for i in range(80))
    rows = [(1, text, "en", "a"), (1, text, "en", "a"), (2, text, None, None), (None, other, "de", "b"), (None, other, "de", "b")]
    rows += [(3, None, "en", "a"), (4, "", None, None), (5, "12 34 " * 50, "en", "a"), (6, "one two " * 200, "en", "a"), (7, text + " more words here", "en", "c")]
    docs = documents(rows)
    for _, stage in STAGES[:3]:
        docs = stage(spark, docs, SF)
        assert docs.columns == documents(rows).columns
    assert sorted(str(r.doc_id) for r in docs.collect()) == ["1", "None", "None"]
    for _, stage in STAGES[3:]:
        docs = stage(spark, docs, SF)
    assert docs.count() >= 1


@pytest.mark.parametrize("name", [n for n, _ in STAGES])
def test_empty_table(spark, documents, name):
    assert dict(STAGES)[name](spark, documents([(1, "a", "b", "c")]).limit(0), SF).count() == 0
