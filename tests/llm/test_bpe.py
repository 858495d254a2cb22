"""Byte-level BPE equals the tiktoken library's ids, and decodes to the bytes it came from."""

import hashlib

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_cases import SF, documents  # noqa: F401

from sparkchecks.llm import bpe
from sparkchecks.llm.queries import QUERIES

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
RANKS = bpe.read_ranks(PATH)
LIBRARY = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=RANKS, special_tokens={})
OWN = bpe.build(RANKS, PATTERN)
TABLE = bpe.token_bytes(OWN)


MATCHES = bpe.Matches(OWN.to_str(), bpe.spelled_out(PATTERN))


def ids(text):
    """By pieces, and by matches, which must be the same."""
    found = MATCHES.encode([text, "", text])[0].tolist()
    out = _ids(text)
    assert found == out + out
    return out


def _ids(text):
    return [i for part in bpe.pieces(text) for i in OWN.encode(part, add_special_tokens=False).ids]


def test_given_documents(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op12_byte_bpe"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = LIBRARY.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(want)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, want)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


@settings(max_examples=1500, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text(st.sampled_from(" aab''stlre\n\t\r 　é1½<|endoftext>_日本😀\x1c\x85"), max_size=60)))
def test_any_text(text):
    text = text.encode("utf-8", "ignore").decode()
    assert ids(text) == LIBRARY.encode_ordinary(text)
    table = TABLE
    assert b"".join(table[i] for i in ids(text)).decode() == text
    assert "".join(bpe.added_text([table[i] for i in ids(text)])) == text


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("aaabbnois \n 'sé日 "), max_size=80))
def test_pieces_end_where_matches_end(text):
    before = bpe.PIECE
    bpe.PIECE = 3
    try:
        assert "".join(bpe.pieces(text)) == text
        assert ids(text) == LIBRARY.encode_ordinary(text)
    finally:
        bpe.PIECE = before


@pytest.mark.parametrize("letter", ["a", "ab", "aab", "é", " ", "\n ", "na", "==", "日本"])
def test_runs_of_one_pattern(letter):
    for n in (1, 2, 3, 5, 8, 31, 64, 1000, 5001):
        assert ids(letter * n) == LIBRARY.encode_ordinary(letter * n)


def test_every_token_and_pair_of_bytes():
    for token in [*RANKS][::11]:
        try:
            text = token.decode()
        except UnicodeDecodeError:
            continue
        assert ids(text) == LIBRARY.encode_ordinary(text)


def test_offsets_and_split_characters(spark, documents):
    rows = [(1, "naïve 日本 😀😀 x", None, None), (2, None, None, None), (3, "word " * 20_000 + "😀", None, None)]
    got = {r.doc_id: r for r in bpe.encode(documents(rows), PATH, PATTERN, offsets=True).collect()}
    for i, text, *_ in rows:
        text = text or ""
        assert got[i].ids == LIBRARY.encode_ordinary(text)
        assert len(got[i].starts) == len(got[i].ends) == len(got[i].ids)
        table = TABLE
        for token, a, b in zip(got[i].ids[:40], got[i].starts, got[i].ends):
            assert table[token] in text[a:b].encode() or text[a:b].encode() in table[token]
    assert got[3].ends[-1] == len(rows[2][1])
    back = bpe.decode(bpe.encode(documents(rows), PATH, PATTERN).withColumnRenamed("doc_id", "bytes2"), PATH, PATTERN, texts=True)
    assert {r.bytes2: ("".join(r.texts), bytes(r["bytes"]).decode()) for r in back.collect()} == {i: (t or "", t or "") for i, t, *_ in rows}
    cut = spark.createDataFrame([(1, got[1].ids[:-3]), (2, None)], "doc_id long, ids array<int>")
    cut = {r.doc_id: r for r in bpe.decode(cut, PATH, PATTERN, texts=True).collect()}
    assert (cut[2]["bytes"], cut[2].texts) == (b"", [])
    assert "".join(cut[1].texts) == bytes(cut[1]["bytes"]).decode("utf-8", "replace")


def test_defined_cases(spark, documents):
    rows = [(1, None, None, None), (2, "", None, None), (None, "<|endoftext|> a", None, None), (3, "x" * 200_000, None, None), (4, "a", None, None), (4, "a", None, None)]
    got = bpe.round_trip(documents(rows), PATH, PATTERN).collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256) for r in got) == sorted(
        (str(i), len(x := LIBRARY.encode_ordinary(t or "")), hashlib.sha256(" ".join(map(str, x)).encode()).hexdigest()) for i, t, *_ in rows
    )
    assert bpe.round_trip(documents(rows[:1]).limit(0), PATH, PATTERN).count() == 0


def test_every_character_is_split_alike():
    split = OWN.pre_tokenizer.pre_tokenize_str
    for probe in ("a", "1", "!", "\n", " "):
        for part in (range(0x3100), range(0x3100, 0x110000, 61)):
            text = "".join(probe + chr(c) + "\0" for c in part if not 0xD800 <= c < 0xE000)
            assert MATCHES.split(text) == [text[a:b] for _, (a, b) in split(text)]


def test_patterns_that_cannot_be_spelled_out(spark, documents):
    for pattern in (r"\p{Lu}+|.", r"\w+|\W", r"[\S]+|\s", r"[a-z&&[^b]]|."):
        assert bpe.spelled_out(pattern) is None
    got = bpe.encode(documents([(1, "Ab cd 日", None, None), (2, None, None, None)]), PATH, r"\p{Lu}|[^\p{Lu}]+").collect()
    library = tiktoken.Encoding("x", pat_str=r"\p{Lu}|[^\p{Lu}]+", mergeable_ranks=RANKS, special_tokens={})
    assert {r.doc_id: r.ids for r in got} == {1: library.encode_ordinary("Ab cd 日"), 2: []}


def test_unknown_ids_are_an_error(spark):
    frame = spark.createDataFrame([(1, [5, 60_000])], "doc_id long, ids array<int>")
    with pytest.raises(Exception, match="60000|out of bounds"):
        bpe.decode(frame, PATH, PATTERN).collect()
