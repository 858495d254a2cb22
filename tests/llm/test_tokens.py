"""Token counts equal the library's, whole text by whole text."""

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_cases import SF, documents  # noqa: F401

from sparkchecks.llm.queries import QUERIES
from sparkchecks.llm.tokens import TokenCounter, count_tokens, provable

MODEL = public_tokenizers.path("piece_bpe_32k.model")
COUNTER = TokenCounter(MODEL)
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_given_documents(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op7_token_counts"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n = len(LIBRARY.encode(texts[r.doc_id]))
        assert (r.n_tokens, r.n_bytes, r.over_limit) == (n, len(texts[r.doc_id].encode()), n > 4096)


@settings(max_examples=500, deadline=None)
@given(st.one_of(st.text(max_size=40), st.text(st.sampled_from(" ▁ab\n\t\r\0é<s>/unk日"), max_size=40)))
def test_any_text(text):
    assert COUNTER.count([text]) == [len(LIBRARY.encode(text))]


def test_proved_pieces_are_one_token():
    single = provable(LIBRARY)
    assert len(single) > 10_000
    some = sorted(single)[::37]
    assert all(len(LIBRARY.encode(p[1:])) == 1 for p in some)


def test_models_that_cross_spaces_are_refused():
    class Crossing:
        def __getattr__(self, name):
            return getattr(LIBRARY, name)

        def id_to_piece(self, i):
            return "a▁b" if i == 500 else LIBRARY.id_to_piece(i)

    with pytest.raises(ValueError):
        provable(Crossing())


def test_defined_cases(spark, documents):
    rows = [(1, None, None, None), (2, "", None, None), (None, "<s> a", None, None), (3, "word " * 30_000, None, None), (4, "a", None, None), (4, "a", None, None)]
    got = count_tokens(documents(rows), MODEL).collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.over_limit) for r in got) == sorted(
        (str(i), len(LIBRARY.encode(t)) if t else 0, bool(t and len(LIBRARY.encode(t)) > 4096)) for i, t, *_ in rows
    )
    assert count_tokens(documents(rows[:1]).limit(0), MODEL).count() == 0


def test_texts_without_spaces_are_not_remembered():
    counter = TokenCounter(MODEL)
    texts = [f"{i}日本語" * 300 for i in range(200)]
    assert counter.count(texts) == [len(LIBRARY.encode(t)) for t in texts]
    assert all(len(p) <= 64 for p in counter.known)
