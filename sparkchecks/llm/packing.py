"""Packing of documents into sequences of several permitted lengths by best fit.

Documents are cut into pieces of at most the largest length. Pieces are dealt into groups of about
``GROUP_PIECES`` by a hash, longest first in each group, and each goes to the open bin that it
fills best. If none has room, the bin size with the least cost per token that it can still be given
is opened: ``cost(c) = OVERHEAD + c + c * c / REACH``, a fixed part, the tokens and their attention.
At the end each bin shrinks to the smallest permitted length that holds its contents.

Defined cases: a document without tokens is one row without a sequence (seq_id, capacity and
offset NULL); NULL lengths count as 0; repeated rows are packed as often as they occur; rows
without doc_id are packed like others; a table without rows gives none. A group that is larger
than ``FLUSH`` pieces is packed in parts, so memory stays bounded; nothing is dropped.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import stored

LENGTHS = (512, 1024, 2048, 4096, 8192)
OVERHEAD, REACH = 256, 16384
GROUP_PIECES = 20_000
FLUSH = 200_000
WORD = r"[^\x20\x09-\x0D]+"


def cost(capacity: int) -> float:
    """Cost of one sequence of this length."""
    return OVERHEAD + capacity + capacity * capacity / REACH


def pack(sizes: Sequence[int], lengths: Sequence[int] = LENGTHS) -> tuple[list[int], list[int], list[int]]:
    """Bin and offset of each piece (longest first), and the final capacity of each bin."""
    lengths = sorted(lengths)
    bin_of, offset, filled = [], [], []
    room_of: dict[int, list[int]] = {}
    mask = 0  # bit r is set if a bin with r tokens of room is open
    capacity: list[int] = []
    left = sum(sizes)
    for s in sizes:
        fit = mask >> s
        if fit:
            room = s + (fit & -fit).bit_length() - 1
            bins = room_of[room]
            b = bins.pop()
            if not bins:
                mask &= ~(1 << room)
        else:
            c = min((c for c in lengths if c >= s), key=lambda c: (cost(c) / min(c, left), c))
            b, room = len(capacity), c
            capacity.append(c)
            filled.append(0)
        bin_of.append(b)
        offset.append(filled[b])
        filled[b] += s
        left -= s
        room -= s
        if room:
            room_of.setdefault(room, []).append(b)
            mask |= 1 << room
    final = [lengths[int(np.searchsorted(lengths, f))] for f in filled]
    return bin_of, offset, final


def word_count(text: Column) -> Column:
    """Number of words, 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def pack_documents(docs: DataFrame, length: Column, id_col: str = "doc_id", lengths: Sequence[int] = LENGTHS) -> DataFrame:
    """Per piece: doc_id, piece, start, n_tokens, seq_id, capacity, offset."""
    top = max(lengths)
    sized = docs.select(F.col(id_col).alias("doc_id"), F.greatest(F.coalesce(length.cast("bigint"), F.lit(0)), F.lit(0)).alias("size"))
    # Rows without id are told apart by their place, so that they don't all meet in one group.
    sized = stored(sized.withColumn("row", F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id())))
    last = F.greatest(F.ceil(F.col("size") / top) - 1, F.lit(0))
    pieces = sized.select("doc_id", "row", "size", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("piece"))
    start = F.col("piece") * top
    pieces = pieces.select("doc_id", "row", "piece", start.alias("start"), F.least(F.lit(top), F.col("size") - start).cast("bigint").alias("n_tokens"))
    n = sized.agg(F.coalesce(F.sum(last + 1), F.lit(0))).first()[0]
    groups = max(1, -(-n // GROUP_PIECES))
    kind = sized.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece bigint, start bigint, n_tokens bigint, seq_id bigint, capacity bigint, offset bigint"
    group = F.pmod(F.xxhash64("doc_id", "piece", "row"), F.lit(groups))
    dealt = pieces.filter("n_tokens > 0").withColumn("g", group).drop("row").repartition(groups, "g")
    dealt = dealt.sortWithinPartitions("g", F.desc("n_tokens"), "doc_id", "piece")

    def finish(rows: pa.Table, g: int, part: int) -> list[pa.RecordBatch]:
        bins, offset, final = pack(rows.column("n_tokens").to_pylist(), lengths)
        seq = np.array(bins, np.int64) + (part * FLUSH * 2 + (g << 40))
        cap = np.array(final, np.int64)[bins]
        rows = rows.drop_columns(["g"])
        for name, values in (("seq_id", seq), ("capacity", cap), ("offset", np.array(offset, np.int64))):
            rows = rows.append_column(name, pa.array(values))
        return rows.combine_chunks().to_batches(max_chunksize=10_000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        now, part, count = None, 0, 0
        for batch in batches:
            g = batch.column("g").to_numpy()
            cuts = [0, *(np.flatnonzero(g[1:] != g[:-1]) + 1).tolist(), len(g)]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                if lo == hi:
                    continue
                if held and (g[lo] != now or count >= FLUSH):
                    yield from finish(pa.Table.from_batches(held), now, part)
                    part = part + 1 if g[lo] == now else 0
                    held, count = [], 0
                now = int(g[lo])
                held.append(batch.slice(lo, hi - lo))
                count += hi - lo
        if held:
            yield from finish(pa.Table.from_batches(held), now, part)

    packed = dealt.mapInArrow(run, schema)
    none = F.lit(None).cast("bigint")
    empty = pieces.filter("n_tokens = 0").drop("row").select("*", none.alias("seq_id"), none.alias("capacity"), none.alias("offset"))
    return packed.unionByName(empty)
