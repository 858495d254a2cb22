"""Words of Arrow text columns as 64-bit hashes, computed for many documents at once in NumPy."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: Bytes of text that are hashed at a time; a longer document makes a chunk of its own.
CHUNK = 1 << 19
BASE = 0x9E3779B97F4A7C15 | 1
U = np.uint64

#: Byte tables: A-Z lower-cased; separators are the six ASCII white-space bytes, or all but letters and digits.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True
NOT_ALNUM = np.ones(256, bool)
NOT_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


class Words(NamedTuple):
    """Hash, document (index in the chunk), first byte and end byte of each word, in text order."""

    hash: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    n_docs: int


def mix(x: np.ndarray) -> np.ndarray:
    """Spread all bits over all bits (invertible)."""
    x = x ^ (x >> U(32))
    x = x * U(0xD6E8FEB86659FD93)
    x = x ^ (x >> U(29))
    x = x * U(0xFF51AFD7ED558CCD)
    return x ^ (x >> U(32))


def _powers(n: int, held: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in held or len(held["up"]) < n:
        size = max(n, CHUNK + 1)
        for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            p = np.full(size, base, U)
            p[0] = 1
            held[name] = np.multiply.accumulate(p)
    return held["up"], held["down"]


def chunks(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First row, end row, bytes and document offsets of pieces of a string column; NULL is empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type)
    _, offsets, data = texts.buffers()
    if not len(texts):
        return
    offs = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + CHUNK, "right")) - 1)
        yield i, j, raw[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
        i = j


def words(data: np.ndarray, offs: np.ndarray, held: dict[str, np.ndarray], separators: np.ndarray = SPACE, lower: bool = True) -> Words:
    """Words of one chunk; ``held`` keeps tables of powers between the chunks of a task."""
    n = len(data)
    n_docs = len(offs) - 1
    if not n:
        none = np.zeros(0, np.int64)
        return Words(np.zeros(0, U), none, none, none, n_docs)
    up, down = _powers(n + 1, held)
    apart = separators[data]
    before = np.empty(n, bool)
    before[0] = True
    before[1:] = apart[:-1]
    after = np.empty(n, bool)
    after[-1] = True
    after[:-1] = apart[1:]
    inner = offs[1:-1]
    before[inner[inner < n]] = True
    after[inner[inner > 0] - 1] = True
    start = np.flatnonzero(before & ~apart)
    end = np.flatnonzero(after & ~apart) + 1
    sums = np.zeros(n + 1, U)
    np.cumsum((LOWER[data] if lower else data).astype(U) * up[:n] + up[:n], out=sums[1:])
    value = (sums[end] - sums[start]) * down[start]
    doc = np.searchsorted(offs, start, "right") - 1
    return Words(mix(value), doc, start, end, n_docs)


def shingles(w: Words, k: int, short_as_one: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of runs of ``k`` words and the document of each; fewer words make one run of all."""
    odd = [U((BASE * (2 * i + 3)) & 0xFFFFFFFFFFFFFFFF | 1) for i in range(k)]
    n = len(w.hash) - k + 1
    if n > 0:
        value = np.zeros(n, U)
        for i in range(k):
            value += w.hash[i : n + i] * odd[i]
        whole = w.doc[:n] == w.doc[k - 1 :]
        value, doc = mix(value[whole]), w.doc[:n][whole]
    else:
        value, doc = np.zeros(0, U), np.zeros(0, np.int64)
    if short_as_one and len(w.doc):
        counts = np.bincount(w.doc, minlength=w.n_docs)
        first = np.searchsorted(w.doc, np.arange(w.n_docs))
        more, short = [], []
        for d in np.flatnonzero((counts > 0) & (counts < k)):
            own = w.hash[first[d] : first[d] + counts[d]]
            # Another rule than for runs of k words, by the number of words.
            more.append((own * np.array(odd[: len(own)], U)).sum(dtype=U) ^ U(BASE >> len(own)))
            short.append(d)
        if more:
            value = np.concatenate([value, mix(np.array(more, U))])
            doc = np.concatenate([doc, np.array(short)])
            order = np.argsort(doc, kind="stable")
            value, doc = value[order], doc[order]
    return value, doc


def distinct_in_docs(value: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each document, documents in order."""
    if not len(value):
        return value, doc
    order = np.lexsort((value, doc))
    value, doc = value[order], doc[order]
    new = np.empty(len(value), bool)
    new[0] = True
    new[1:] = (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])
    return value[new], doc[new]
