"""Byte-level BPE: texts to token ids with offsets, and ids back to bytes and text.

A rank file (base64 of a token, its rank) becomes a model of the tokenizers library: every byte is
written as one printable character, so tokens that end inside a character are ordinary strings.
Each match of the pattern is encoded by itself; a match that is a token stays whole, otherwise
the pair whose concatenation has the lowest rank is merged until no pair is a token.

The file is read once on the driver and broadcast (its size is fixed, about 2 MB). Without offsets,
matches are found by the same pattern spelled out for Python's expressions, and each different match
is given to the library once as long as ``KNOWN`` characters of them are remembered; texts with
characters that Python doesn't know yet, and patterns that can't be spelled out, are split by the library.
With offsets, texts go to the library in pieces of some ``PIECE`` characters, cut before white space
that follows a visible character: there every match ends, so pieces give the ids of the whole text. A
text without such a place is one piece. ``BATCH`` characters are encoded at a time, so memory doesn't
grow with a batch or a text beyond what its own ids need.

Defined cases: NULL is the empty text, which has no tokens; rows without id are encoded like others;
repeated rows stay repeated; an empty table gives no rows; columns other than the id and the text
aren't read. Strings that look like special tokens are ordinary text. Ids that aren't in the file
are an error when they are decoded, NULL ids decode to nothing. Bytes that are no complete character
decode to U+FFFD.
"""

from __future__ import annotations

import base64
import codecs
import os
import re
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Regex, Tokenizer
from tokenizers.models import BPE
from tokenizers.pre_tokenizers import ByteLevel, Sequence, Split

from .storage import released

#: Characters of a piece, and of the pieces encoded in one call.
PIECE, BATCH = 1 << 15, 1 << 20
#: Characters of the matches that a task remembers; then it starts anew, which costs time only.
KNOWN = 1 << 22
#: Below it a text is Latin, and its character classes are short.
LATIN = 0x250
#: The characters of Unicode's property White_Space.
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Where every match ends: white space after a visible ASCII character, a letter or a digit.
SAFE = re.compile(r"(?<=[!-~\w])[ \n]")


def byte_characters() -> list[str]:
    """A printable character for each byte: itself if it is visible in Latin-1, else the next one from U+0100 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in visible else next(spare)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and ranks of a rank file, which only the driver needs to see."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def build(ranks: dict[bytes, int], pattern: str) -> Tokenizer:
    """The library's tokenizer for these ranks, which are its ids."""
    written = byte_characters()
    text = {token: "".join(written[b] for b in token) for token in ranks}
    merges = []
    for token, rank in ranks.items():
        for i in range(1, len(token)):
            if token[:i] in ranks and token[i:] in ranks:
                merges.append((rank, i, text[token[:i]], text[token[i:]]))
    merges.sort()
    model = BPE({text[t]: r for t, r in ranks.items()}, [m[2:] for m in merges], ignore_merges=True)
    tokenizer = Tokenizer(model)
    tokenizer.pre_tokenizer = Sequence([Split(Regex(pattern), "isolated"), ByteLevel(add_prefix_space=False, use_regex=False)])
    return tokenizer


def token_bytes(tokenizer: Tokenizer) -> dict[int, bytes]:
    """The bytes of each id: the byte table in reverse."""
    byte = {c: b for b, c in enumerate(byte_characters())}
    return {i: bytes(byte[c] for c in token) for token, i in tokenizer.get_vocab().items()}


def _ranges(wanted, end: int = 0x110000) -> str:
    """The code points below ``end`` that pass a test, as the inside of a character class."""
    out, start = [], None
    for c in range(end + 1):
        inside = c < end and wanted(unicodedata.category(chr(c)))
        if inside and start is None:
            start = c
        elif not inside and start is not None:
            out.append(f"\\U{start:08x}-\\U{c - 1:08x}")
            start = None
    return "".join(out)


def spelled_out(pattern: str) -> tuple[str, str, str] | None:
    """The pattern for Python's expressions: for texts below ``LATIN``, for others, and one that finds characters unknown to Python.

    None if it holds classes other than letters, numbers and white space.
    """
    tokens = re.findall(r"\\p\{[LN]\}|\\.|\[|\]|[^\\\[\]]+", pattern)
    depth, found = 0, []
    for token in tokens:
        depth += (token == "[") - (token == "]")
        if token[0] == "\\" and token[1].isalpha() and token not in (r"\p{L}", r"\p{N}", r"\s", r"\S") or token == r"\S" and depth:
            return None
        found.append((token, depth))
    if any(d > 1 for _, d in found) or "&&" in pattern:
        return None
    out = []
    for end in (LATIN, 0x110000):
        inside = {r"\p{L}": _ranges(lambda k: k[0] == "L", end), r"\p{N}": _ranges(lambda k: k[0] == "N", end), r"\s": WHITE}
        out.append("".join(f"[^{WHITE}]" if t == r"\S" else (inside[t] if d else f"[{inside[t]}]") if t in inside else t for t, d in found))
    return out[0], out[1], f"[{_ranges(lambda k: k == 'Cn')}]"


class Matches:
    """Ids of texts by way of their different matches, which are remembered for a while."""

    def __init__(self, written: str, spelled: tuple[str, str, str]) -> None:
        self.split_by, self.tokenizer = Tokenizer.from_str(written).pre_tokenizer, Tokenizer.from_str(written)
        self.tokenizer.pre_tokenizer = ByteLevel(add_prefix_space=False, use_regex=False)
        self.latin, self.find = (re.compile(x).findall for x in spelled[:2])
        self.late, self.unknown = re.compile(f"[{chr(LATIN)}-\U0010ffff]"), re.compile(spelled[2])
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.ids, self.first, self.size = array("i"), array("q", [0]), 0

    def split(self, text: str) -> list[str]:
        """The matches of a text, in order."""
        if text.isascii() or not self.late.search(text):
            return self.latin(text)
        if not self.unknown.search(text):
            return self.find(text)
        return [text[a:b] for _, (a, b) in self.split_by.pre_tokenize_str(text)]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and where those of each text begin (and the last one's end)."""
        if self.size > KNOWN:
            self.forget()
        place, parts, ends = self.place, [], [0]
        for text in texts:
            parts += self.split(text)
            ends.append(len(parts))
        new = list(dict.fromkeys(p for p in parts if p not in place))
        for got in self.tokenizer.encode_batch_fast(new, add_special_tokens=False) if new else ():
            self.ids.extend(got.ids)
            self.first.append(len(self.ids))
        place.update(zip(new, range(len(place), len(place) + len(new)), strict=True))
        self.size += sum(map(len, new))
        codes = np.fromiter(map(place.__getitem__, parts), np.int64, len(parts))
        first = np.array(self.first, np.int64)
        sizes = np.diff(first)[codes]
        cuts = np.concatenate([[0], np.cumsum(sizes)])
        return np.array(self.ids, np.int32)[spans(first[codes], sizes)], cuts[ends]


def spans(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of all spans, one after another."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes - first, sizes)


def _groups(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Runs of rows of about ``BATCH`` characters or tokens."""
    start, held = 0, 0
    for i, size in enumerate(sizes):
        held += size
        if held >= BATCH:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(sizes):
        yield start, len(sizes)


def pieces(text: str) -> Iterator[str]:
    """The text in pieces that end where a match ends."""
    at = 0
    while len(text) - at > PIECE:
        place = SAFE.search(text, at + PIECE)
        if place is None:
            break
        yield text[at : place.start()]
        at = place.start()
    yield text[at:]


def _calls(texts: list[str]) -> Iterator[list[tuple[int, str, bool]]]:
    """Pieces (row, piece, whether it is the row's last) for one call each."""
    held, size = [], 0
    for row, text in enumerate(texts):
        parts = list(pieces(text)) if len(text) > PIECE else [text]
        for k, part in enumerate(parts):
            held.append((row, part, k + 1 == len(parts)))
            size += len(part)
            if size >= BATCH:
                yield held
                held, size = [], 0
    if held:
        yield held


def _shared(spark: SparkSession, path: str, pattern: str):
    """A broadcast of the tokenizer, written as text, and of its spelled-out pattern."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return spark.sparkContext.broadcast((build(read_ranks(path), pattern).to_str(), spelled_out(pattern)))


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", offsets: bool = False) -> DataFrame:
    """Per row: doc_id, ids, and with ``offsets`` the code points where each token starts and ends.

    Tokens of one character share its span.
    """
    model = _shared(docs.sparkSession, path, pattern)
    base = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def only_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        matches = Matches(*model.value)
        for batch in batches:
            for lo, hi in _groups(pc.binary_length(batch.column(1)).fill_null(0).to_pylist()):
                part = batch.slice(lo, hi - lo)
                ids, cuts = matches.encode([x or "" for x in part.column(1).to_pylist()])
                column = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(ids))
                yield pa.RecordBatch.from_arrays([part.column(0), column], names=["doc_id", "ids"])

    def with_offsets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tokenizer = Tokenizer.from_str(model.value[0])
        for batch in batches:
            first, sent = 0, 0
            held: list[list] = [[], [], []]
            done: list[list] = [[], [], []]
            for group in _calls([x or "" for x in batch.column(1).to_pylist()]):
                for (_, part, last), got in zip(group, tokenizer.encode_batch([g[1] for g in group], add_special_tokens=False), strict=True):
                    held[0].extend(got.ids)
                    held[1].extend(first + a for a, _ in got.offsets)
                    held[2].extend(first + b for _, b in got.offsets)
                    first += len(part)
                    if last:
                        for x, y in zip(done, held, strict=True):
                            x.append(pa.array(y, pa.int32()))
                        held, first = [[], [], []], 0
                n = len(done[0])
                if n:
                    columns = [batch.column(0).slice(sent, n), *[pa.array(x, pa.list_(pa.int32())) for x in done]]
                    yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "starts", "ends"])
                    sent, done = sent + n, [[], [], []]

    if offsets or model.value[1] is None:
        out = base.mapInArrow(released(with_offsets), "doc_id bigint, ids array<int>, starts array<int>, ends array<int>")
        return out if offsets else out.select("doc_id", "ids")
    return base.mapInArrow(released(only_ids), "doc_id bigint, ids array<int>")


def decode(encoded: DataFrame, path: str, pattern: str, ids_col: str = "ids", texts: bool = False) -> DataFrame:
    """The rows without their ids, with the decoded ``bytes`` and, if asked for, the ``texts`` that each token adds.

    A character whose bytes lie in several tokens belongs to the token that completes it. Columns
    of those two names are replaced.
    """
    model = _shared(encoded.sparkSession, path, pattern)
    kept = [c for c in encoded.columns if c not in (ids_col, "bytes", "texts")]
    row = F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row")
    ids = F.filter(F.coalesce(F.col(f"`{ids_col}`").cast("array<int>"), F.array().cast("array<int>")), lambda x: x.isNotNull())
    base = encoded.select(row, ids.alias("ids") if encoded.schema[ids_col].dataType.containsNull or texts else F.col(f"`{ids_col}`").alias("ids"))
    schema = f"row {base.schema['row'].dataType.simpleString()}, bytes binary" + ", texts array<string>" * texts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = token_bytes(Tokenizer.from_str(model.value[0]))
        flat = np.frombuffer(b"".join(table.get(i, b"") for i in range(max(table) + 1)), np.uint8)
        size = np.array([len(table.get(i, b"")) for i in range(max(table) + 1)], np.int64)
        first = np.concatenate([[0], np.cumsum(size)])[:-1]
        for batch in batches:
            for lo, hi in _groups(pc.list_value_length(batch.column(1)).fill_null(0).to_pylist()):
                part = batch.slice(lo, hi - lo)
                tokens = part.column(1).flatten().to_numpy()
                if (unknown := size[tokens] == 0).any():
                    raise ValueError(f"not an id of this vocabulary: {tokens[unknown][0]}")
                ends = np.concatenate([[0], np.cumsum(size[tokens])])
                cuts = ends[np.concatenate([[0], np.cumsum(pc.list_value_length(part.column(1)).fill_null(0).to_numpy())])]
                data = flat[spans(first[tokens], size[tokens])]
                whole = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(part), [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(data)])
                columns = [part.column(0), whole.cast(pa.binary())]
                if texts:
                    columns.append(pa.array([list(added_text([table[x] for x in own or ()])) for own in part.column(1).to_pylist()], pa.list_(pa.string())))
                yield pa.RecordBatch.from_arrays(columns, names=["row", "bytes", *["texts"] * texts])

    out = base.mapInArrow(released(run), schema)
    return out.select(*[F.col(f"row.`{c}`") for c in kept], "bytes", *["texts"] * texts)


def added_text(tokens: list[bytes]) -> Iterator[str]:
    """The text that each token completes; what stays incomplete at the end is U+FFFD in the last."""
    reader = codecs.getincrementaldecoder("utf-8")("replace")
    for i, token in enumerate(tokens):
        yield reader.decode(token, i + 1 == len(tokens))


def digest(ids: Column) -> Column:
    """Lowercase hex of the SHA-256 of the decimal ids, joined by one space."""
    return F.sha2(F.concat_ws(" ", ids.cast("array<string>")), 256)


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per document: doc_id, n_tokens, and digests of its ids and of the bytes that they decode to."""
    encoded = encode(docs, path, pattern)
    told = encoded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), digest(F.col("ids")).alias("ids_sha256"), "ids")
    decoded = decode(told, path, pattern)
    return decoded.select("doc_id", "n_tokens", "ids_sha256", F.sha2("bytes", 256).alias("decoded_sha256"))
