"""Count transducers: weighted acyclic automata over words, for windows of at most ``DEPTH`` words.

A path reads a window (shorter ones end in the label 0) and its weight is how often the window
occurs. Paths are kept in the order of their words, so a phrase is a range of paths, and the phrase's
count is the sum of that range. Written down, the automaton is minimal level by level: states
whose arcs have equal labels, weights and targets are one state. Everything is done for all paths
at once in NumPy.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .words import U, mix

DEPTH = 4
#: Paths that a union sorts at a time: besides its parts and its result it holds some 100 bytes for each of these.
BLOCK = 200_000
#: Ends of a piece: . , ; : ! ? and line ends; between words: space and tab.
ENDS = np.zeros(256, bool)
ENDS[[*b".,;:!?", *range(10, 14)]] = True
APART = ENDS.copy()
APART[[9, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _ordered(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Distinct words in byte order, and for each given word its label (from 1)."""
    coded = words.dictionary_encode()
    distinct, codes = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
    order = pc.array_sort_indices(distinct).to_numpy()
    label = np.empty(len(order), np.int32)
    label[order] = np.arange(1, len(order) + 1, dtype=np.int32)
    return distinct.take(pa.array(order)), label[codes]


def _summed(paths: np.ndarray, weights: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Paths in order, equal ones added up; ``size`` is the number of labels."""
    if not len(paths):
        return paths, weights
    high, low = (paths[:, i].astype(np.int64) * (size + 1) + paths[:, i + 1] for i in (0, 2))
    order = np.lexsort((low, high))
    high, low = high[order], low[order]
    first = np.flatnonzero(np.concatenate([[True], (high[1:] != high[:-1]) | (low[1:] != low[:-1])]))
    return paths[order[first]], np.add.reduceat(weights[order], first)


@dataclass
class Transducer:
    """Words in byte order, paths (labels from 1 on, 0 for none) in order, and their weights."""

    words: pa.Array
    paths: np.ndarray
    weights: np.ndarray

    @staticmethod
    def of_text(data: bytes) -> Transducer:
        """The windows that begin at each word of a text."""
        raw = np.frombuffer(data, np.uint8)
        apart = APART[raw]
        inside = np.concatenate([[False], ~apart, [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        start, end = edges[::2], edges[1::2]
        n = len(start)
        if not n:
            return Transducer(pa.array([], pa.binary()), np.zeros((0, DEPTH), np.int32), np.zeros(0, np.int64))
        offsets = np.zeros(n + 1, np.int32)
        np.cumsum(end - start, out=offsets[1:])
        words = pa.BinaryArray.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(LOWER[raw[~apart]])])
        ends = np.cumsum(ENDS[raw], dtype=np.int32)
        goes_on = np.zeros(n, bool)
        goes_on[:-1] = ends[start[1:]] == ends[end[:-1] - 1]
        del inside, edges, apart, ends
        words, labels = _ordered(words)
        paths = np.zeros((n, DEPTH), np.int32)
        paths[:, 0] = labels
        alive = goes_on
        for d in range(1, min(DEPTH, n)):
            paths[: n - d, d] = np.where(alive[: n - d], labels[d:], 0)
            alive = alive[: n - d] & goes_on[d:][: n - d]
        return Transducer(words, *_summed(paths, np.ones(n, np.int64), len(words)))

    def to_bytes(self) -> bytes:
        """The minimal automaton: for each level the number of arcs of its states, labels, targets or weights."""
        n = len(self.paths)
        columns = [np.array([n], np.int64)]
        if n:
            change = self.paths[1:] != self.paths[:-1]
            starts = [np.concatenate([[0], np.flatnonzero(change[:, : d + 1].any(axis=1)) + 1]) for d in range(DEPTH)]
            value = self.weights
            for d in range(DEPTH - 1, -1, -1):
                label = self.paths[starts[d], d]
                above = starts[d - 1] if d else np.zeros(1, np.int64)
                first = np.searchsorted(starts[d], above)
                kept, target = _merged(first, label, value)
                sizes = np.diff(np.append(first, len(label)))
                arcs = _spans(first[kept], sizes[kept])
                columns += [sizes[kept].astype(np.int32), label[arcs].astype(np.int32), value[arcs] if d == DEPTH - 1 else value[arcs].astype(np.int32)]
                value = target
        _, offsets, text = self.words.buffers()
        offsets = np.frombuffer(offsets, np.int32, len(self.words) + 1, 4 * self.words.offset) if len(self.words) else np.zeros(1, np.int32)
        text = text.slice(offsets[0], offsets[-1] - offsets[0]) if offsets[-1] else b""
        columns.append(np.diff(offsets))
        head = np.array([len(columns), *map(len, columns)], np.int64)
        whole = b"".join([head.tobytes(), *(_planes(c) for c in columns), text])
        return len(whole).to_bytes(8, "little") + pa.compress(whole, codec="zstd", asbytes=True)

    @staticmethod
    def from_bytes(blob: bytes | pa.Buffer) -> Transducer:
        blob = pa.py_buffer(blob)
        raw = pa.decompress(blob.slice(8), decompressed_size=int.from_bytes(blob.slice(0, 8).to_pybytes(), "little"), codec="zstd")
        sizes = np.frombuffer(raw, np.int64, 1 + int(np.frombuffer(raw, np.int64, 1)[0]))[1:].tolist()
        columns, at = [], 8 * (1 + len(sizes))
        for i, n in enumerate(sizes):
            kind = np.dtype(np.int64 if i in (0, 3) else np.int32)  # the number of paths, and the weights
            columns.append(_whole(np.frombuffer(raw, np.uint8, n * kind.itemsize, at), kind))
            at += n * kind.itemsize
        offsets = np.concatenate([[0], np.cumsum(columns.pop())]).astype(np.int32)
        text = np.frombuffer(raw, np.uint8, int(offsets[-1]), at).tobytes()  # a copy, so that nothing else is kept
        words = pa.BinaryArray.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(text)])
        if not columns[0][0]:
            return Transducer(words, np.zeros((0, DEPTH), np.int32), np.zeros(0, np.int64))
        levels = [columns[i : i + 3] for i in range(len(columns) - 3, 0, -3)]
        state = np.zeros(1, np.int64)
        paths = np.zeros((1, 0), np.int32)
        for sizes, label, value in levels:
            first = np.concatenate([[0], np.cumsum(sizes)])
            arcs = _spans(first[state], sizes[state])
            paths = np.column_stack([np.repeat(paths, sizes[state], axis=0), label[arcs]])
            state = value[arcs]
        return Transducer(words, paths, state.astype(np.int64))

    def between(self, lo: int, hi: int) -> Transducer:
        """The paths from ``lo`` up to ``hi``, with their own words only."""
        paths = self.paths[lo:hi]
        used = np.unique(paths)
        used = used[used > 0]
        label = np.zeros(len(self.words) + 1, np.int32)
        label[used] = np.arange(1, len(used) + 1)
        return Transducer(self.words.take(pa.array(used - 1)), label[paths], self.weights[lo:hi])

    def place(self, window: tuple[bytes, ...]) -> int:
        """The number of paths before a window in the order."""
        return _before(self.paths, map(self.label, window[:DEPTH]))

    def label(self, word: bytes) -> tuple[int, bool]:
        """The label of a word, or where it would stand, and whether it is there."""
        lo, hi = 0, len(self.words)
        while lo < hi:
            mid = (lo + hi) // 2
            if self.words[mid].as_py() < word:
                lo = mid + 1
            else:
                hi = mid
        return lo + 1, lo < len(self.words) and self.words[lo].as_py() == word

    def window(self, i: int) -> tuple[bytes, ...]:
        """The words of one path."""
        return tuple(self.words[int(x) - 1].as_py() for x in self.paths[i] if x)

    def phrases(self, depth: int, least: int) -> tuple[pa.Array, np.ndarray]:
        """Phrases of ``depth`` words (joined by a space) and the sums over their ranges of paths.

        All that reach ``least``, and those of the first and the last path whatever their sum, as
        they may go on outside.
        """
        if not len(self.paths):
            return pa.array([], pa.binary()), np.zeros(0, np.int64)
        part = self.paths[:, :depth]
        first = np.concatenate([[0], np.flatnonzero((part[1:] != part[:-1]).any(axis=1)) + 1])
        sums = np.add.reduceat(self.weights, first)
        told = sums >= least
        told[[0, -1]] = True
        told &= part[first, depth - 1] > 0
        rows = part[first[told]]
        columns = [self.words.take(pa.array(rows[:, d] - 1)) for d in range(depth)]
        joined = pc.binary_join_element_wise(*columns, b" ") if depth > 1 else columns[0]
        return joined, sums[told]


def merged(parts: list[Transducer], block: int = BLOCK) -> Iterator[Transducer]:
    """The union of some transducers as consecutive pieces of some ``block`` paths, all with the words of the whole.

    Parts are in order, so a piece is a range of each of them, and only a piece's paths are sorted together.
    """
    words, labels = _ordered(pa.concat_arrays([p.words for p in parts]))
    starts = np.cumsum([0, *(len(p.words) for p in parts)])
    known = [np.concatenate([[0], labels[lo:hi]]).astype(np.int32) for lo, hi in zip(starts, starts[1:])]
    del labels
    ends = np.cumsum([len(p.paths) for p in parts])
    drawn = np.arange(block // 8, ends[-1], max(1, block // 8))
    drawn = zip(drawn.tolist(), np.searchsorted(ends, drawn, "right").tolist())
    drawn = sorted(tuple(known[k][parts[k].paths[i - ends[k]]].tolist()) for i, k in drawn)

    def label(k: int, x: int) -> tuple[int, bool]:
        own = int(np.searchsorted(known[k], np.int32(x)))
        return own, own < len(known[k]) and known[k][own] == x

    before = [0] * len(parts)
    for window in [*dict.fromkeys(drawn[7::8]), None]:
        until = [len(p.paths) if window is None else _before(p.paths, (label(k, x) for x in window)) for k, p in enumerate(parts)]
        some = [(k, lo, hi) for k, (lo, hi) in enumerate(zip(before, until)) if lo < hi]
        before = until
        if some:
            paths = np.concatenate([known[k][parts[k].paths[lo:hi]] for k, lo, hi in some])
            yield Transducer(words, *_summed(paths, np.concatenate([parts[k].weights[lo:hi] for k, lo, hi in some]), len(words)))


def union(parts: list[Transducer]) -> Transducer:
    """All paths of some transducers, weights of equal ones added up."""
    if len(parts) == 1:
        return parts[0]
    most = sum(len(p.paths) for p in parts)
    words, paths, weights, n = pa.array([], pa.binary()), np.empty((most, DEPTH), np.int32), np.empty(most, np.int64), 0
    for piece in merged(parts):
        words, m = piece.words, n + len(piece.paths)
        paths[n:m], weights[n:m], n = piece.paths, piece.weights, m
    return Transducer(words, paths[:n], weights[:n])


def _before(paths: np.ndarray, labels: Iterator[tuple[int, bool]]) -> int:
    """The number of paths before the one of some labels; each label is given with whether it is there."""
    lo, hi = 0, len(paths)
    for d, (label, there) in enumerate(labels):
        column, label = paths[lo:hi, d], np.int32(label)  # a wider label would make a wider copy of the column
        lo, hi = lo + int(np.searchsorted(column, label)), lo + int(np.searchsorted(column, label, "right")) if there else lo
        if lo >= hi:
            return lo
    return lo


def _planes(column: np.ndarray) -> bytes:
    """All first bytes of the numbers, all second ones and so on: small numbers and their zeros pack better so."""
    return column.view(np.uint8).reshape(len(column), column.itemsize).T.tobytes()


def _whole(planes: np.ndarray, kind: np.dtype) -> np.ndarray:
    """The numbers of such bytes."""
    return np.ascontiguousarray(planes.reshape(kind.itemsize, -1).T).reshape(-1).view(kind)


def _spans(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of all spans, one after another."""
    sizes = sizes.astype(np.int64)
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes - first, sizes)


def _merged(first: np.ndarray, label: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """States to keep, and for each state its number among them; states with equal arcs are one.

    States are told apart by a hash and then arc by arc; where that fails, a state stays alone.
    """
    sizes = np.diff(np.append(first, len(label)))
    place = np.arange(len(label)) - np.repeat(first, sizes)
    arc = mix(mix(label.astype(U) + (place.astype(U) << U(40))) + value.astype(U))
    key = np.add.reduceat(arc, first)
    _, sample, same = np.unique(key, return_index=True, return_inverse=True)
    like = sample[same]
    off = sizes != sizes[like]
    arcs, others = _spans(first[~off], sizes[~off]), _spans(first[like[~off]], sizes[~off])
    differ = (label[arcs] != label[others]) | (value[arcs] != value[others])
    off[np.repeat(np.flatnonzero(~off), sizes[~off])[differ]] = True
    like[off] = np.flatnonzero(off)
    kept, target = np.unique(like, return_inverse=True)
    return kept, target
