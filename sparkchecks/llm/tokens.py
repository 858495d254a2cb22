"""Token counts of a SentencePiece BPE model by whole-token look-up.

Proof, made once for a model file before any text is read: (1) no piece has a space mark after
another character, so a merge never crosses the place where a space follows something else, and a
text falls into parts that are encoded independently of each other; (2) every piece that encodes
alone to exactly itself is one token. Parts found among those count one; only the others are
merged by the library, once for each different part of a chunk. A model for which (1) fails, or
that alters texts before encoding, is refused.

The proof is made again in each task (some 0.1 s), which needs the model file anyway. What a task
remembers is bounded in characters: parts of more than ``SHORT`` characters, such as texts without
spaces, are merged and forgotten.

Defined cases: NULL and empty texts have no tokens and no bytes; texts are never cut.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
#: The library is called with this many parts at a time.
CALL = 20_000
#: Counts of merged parts that a task keeps, and the longest of them; a full table is emptied, which costs time only.
CACHE, SHORT = 300_000, 64


def provable(processor) -> set[str]:
    """Pieces (space mark first) that encode alone as one token; raises if parts depend on each other."""
    pieces = [processor.id_to_piece(i) for i in range(processor.get_piece_size()) if not (processor.is_control(i) or processor.is_unknown(i) or processor.is_byte(i))]
    if any(MARK in p.lstrip(MARK) for p in pieces):
        raise ValueError("a piece of this model crosses a space; texts can't be split there")
    probe = "  a ﬁ  B\n"
    if processor.decode(processor.encode(probe)) != probe or processor.encode("", out_type=str):
        raise ValueError("this model alters texts; parts can't be counted alone")
    starts = [p for p in pieces if p.startswith(MARK)]
    return {p for p, out in zip(starts, processor.encode([p[1:] for p in starts], out_type=str, num_threads=1), strict=True) if out == [p]}


class TokenCounter:
    """Counts the tokens of texts with one model; made once in a task."""

    def __init__(self, model_file: str) -> None:
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.single = provable(self.processor)
        # A mark with nothing behind it can only end a text.
        self.last = len(self.processor.encode("a ")) - len(self.processor.encode("a"))
        self.known = self.proved()
        self.parts = re.compile(f"{MARK}+[^{MARK}]*")

    def proved(self) -> dict[str, int]:
        """Counts that need no merging."""
        return dict.fromkeys(self.single, 1) | {MARK: self.last}

    def count(self, texts: list[str | None]) -> list[int]:
        """Tokens of each text."""
        # The library puts one space mark before a text; with it every part begins with a mark.
        split = [Counter(self.parts.findall(MARK + t.replace(" ", MARK))) if t else Counter() for t in texts]
        if len(self.known) > CACHE:
            self.known = self.proved()
        known, long = self.known, {}
        new = list({p for parts in split for p in parts if p not in known})
        for i in range(0, len(new), CALL):
            some = new[i : i + CALL]
            for p, ids in zip(some, self.processor.encode([p[1:] for p in some], num_threads=1), strict=True):
                (known if len(p) <= SHORT else long)[p] = len(ids)
        return [sum((known.get(p) or long.get(p) or 0) * n for p, n in parts.items()) for parts in split]


def count_tokens(docs: DataFrame, model_file: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, n_bytes, n_tokens, over_limit."""
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = f"doc_id {base.schema['doc_id'].dataType.simpleString()}, n_bytes bigint, n_tokens bigint, over_limit boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = None
        for batch in batches:
            counter = counter or TokenCounter(model_file)
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                texts = part.column(1).to_pylist()
                n = counter.count(texts)
                size = [len(t.encode()) if t else 0 for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(size, pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())],
                    names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
                )

    return base.mapInArrow(run, schema)
