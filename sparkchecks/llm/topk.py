"""Exact top-k by integer inner product with two cover trees.

1. A bounded sample of the candidates gives pivots (some rounds of k-means). Every candidate goes to its
   nearest pivot; a pivot with more than ``BLOCK`` candidates is divided by a hash. A cell is known by
   its pivot and the largest distance from it, so ``<q, p> + |q| radius`` bounds all its scores.
2. A query is first answered in the block of the pivot that it likes best, so the first pass is spread
   over all blocks; then it visits only the blocks whose bound reaches its kth score.
3. Each block builds a cover tree over its candidates and one over each batch of queries: a node has
   a centre and the radius that covers all its vectors, children are centres picked farthest first
   until they cover at half the radius. A pair of nodes is pruned when ``<q, c> + rq |c| + rc |q| + rq
   rc`` lies below the worst kth score of the queries in the node; pairs of leaves are scored by one
   matrix product. Blocks' lists are merged per query.

Defined cases: vectors that are NULL, empty, or hold a NULL or non-finite component, and rows
without id, take no part; vectors of different lengths are not compared; identical repeated rows
count once; rows with an id in common are never candidates of each other; ties go to the smaller
id; an empty table gives no rows. A component beyond 63 bits, or a score beyond them, is an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .storage import released, stored

SCALE = 1024
BLOCK = 16_384
#: Pivots of the vectors of one length, and sampled vectors for each of them.
MAX_PIVOTS, SAMPLED = 1024, 4
#: Blocks of a cell are numbered from its pivot's number times this.
PARTS = 1 << 20
BATCH = 1_024
LEAF = 64
FANOUT = 24
LOWEST = np.iinfo(np.int64).min
#: Share of the product of two norms by which a bound is raised, for the rounding of doubles.
SLACK = 1e-9


class Tree:
    """Cover tree as arrays; node i holds the vectors ``order[first[i]:end[i]]``."""

    def __init__(self, vectors: np.ndarray) -> None:
        x = vectors.astype(np.float64)
        self.order = np.arange(len(x))
        self.first, self.end, self.children, self.centre, self.radius = [], [], [], [], []
        todo = [self._node(x, 0, len(x), x.mean(axis=0))] if len(x) else []
        while todo:
            i = todo.pop()
            lo, hi = self.first[i], self.end[i]
            if hi - lo <= LEAF or self.radius[i] == 0:
                continue
            own = self.order[lo:hi]
            near, label = self._cover(x[own], self.centre[i], self.radius[i])
            by = np.argsort(label, kind="stable")
            self.order[lo:hi] = own[by]
            cuts = np.searchsorted(label[by], np.arange(len(near) + 1)) + lo
            for c, (a, b) in zip(near, zip(cuts, cuts[1:], strict=False), strict=True):
                if a < b:
                    self.children[i].append(self._node(x, a, b, c))
            todo += self.children[i]
        self.norm = np.array([np.linalg.norm(c) for c in self.centre])

    def _node(self, x: np.ndarray, lo: int, hi: int, centre: np.ndarray) -> int:
        self.first.append(int(lo))
        self.end.append(int(hi))
        self.children.append([])
        self.centre.append(centre)
        rows = x[self.order[lo:hi]]
        self.radius.append(float(np.sqrt(((rows - centre) ** 2).sum(axis=1).max())))
        return len(self.first) - 1

    @staticmethod
    def _cover(x: np.ndarray, centre: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
        """Centres picked farthest first, and the nearest of them for each row."""
        picked = [x[((x - centre) ** 2).sum(axis=1).argmax()]]
        best = ((x - picked[0]) ** 2).sum(axis=1)
        label = np.zeros(len(x), int)
        while len(picked) < FANOUT and best.max() > (radius / 2) ** 2:
            picked.append(x[best.argmax()])
            d = ((x - picked[-1]) ** 2).sum(axis=1)
            closer = d < best
            label[closer], best[closer] = len(picked) - 1, d[closer]
        return np.array(picked), label


def _product(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exact."""
    most = int(np.abs(q).max(initial=0)) * int(np.abs(c).max(initial=0)) * max(q.shape[1], 1)
    if most < 1 << 53:
        return (q.astype(np.float64) @ c.astype(np.float64).T).astype(np.int64)
    if most < 1 << 63:
        return q @ c.T
    exact = q.astype(object) @ c.astype(object).T
    if abs(exact).max(initial=0) >= 1 << 63:
        raise OverflowError("scores exceed 63 bits")
    return exact.astype(np.int64)


def search(tree: Tree, ids: np.ndarray, vectors: np.ndarray, q_ids: np.ndarray, queries: np.ndarray, floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Best scores and ids (rows: queries; unused places LOWEST), among those at least ``floor``."""
    n = len(q_ids)
    best, who = np.full((n, k), LOWEST), np.full((n, k), np.iinfo(np.int64).max)
    worst = floor.copy()  # a candidate below it can't be among the k best
    q_tree = Tree(queries)
    stack = [(np.inf, 0, 0)] if n and len(ids) else []

    def bound(a: int, b: int) -> float:
        rq, rc = q_tree.radius[a], tree.radius[b]
        nq, nc = q_tree.norm[a], tree.norm[b]
        value = float(q_tree.centre[a] @ tree.centre[b]) + rq * nc + rc * nq + rq * rc
        return value + SLACK * (nq + rq) * (nc + rc) + 1e-3

    while stack:
        high, a, b = stack.pop()
        rows = q_tree.order[q_tree.first[a] : q_tree.end[a]]
        if high < worst[rows].min():
            continue
        down_q = bool(q_tree.children[a]) and (not tree.children[b] or q_tree.radius[a] >= tree.radius[b])
        if down_q or tree.children[b]:
            pairs = [(x, b) for x in q_tree.children[a]] if down_q else [(a, y) for y in tree.children[b]]
            stack += sorted((bound(*p), *p) for p in pairs)  # the most promising pair is taken next
            continue
        cols = tree.order[tree.first[b] : tree.end[b]]
        scores = _product(queries[rows], vectors[cols])
        scores[q_ids[rows][:, None] == ids[cols][None, :]] = LOWEST
        able = np.flatnonzero(scores.max(axis=1) >= np.maximum(worst[rows], LOWEST + 1))
        if len(able):
            r = rows[able]
            s = np.concatenate([best[r], scores[able]], axis=1)
            w = np.concatenate([who[r], np.broadcast_to(ids[cols], (len(able), len(cols)))], axis=1)
            top = np.lexsort((w, ~s), axis=1)[:, :k]
            best[r], who[r] = np.take_along_axis(s, top, 1), np.take_along_axis(w, top, 1)
            worst[r] = np.maximum(worst[r], best[r, -1])
    return best, who


def _distinct(ids: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Places of rows that differ from the one before (rows are sorted)."""
    new = np.ones(len(ids), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (vectors[1:] != vectors[:-1]).any(axis=1)
    return np.flatnonzero(new)


def _blocks(rows: DataFrame, parts: int, k: int) -> DataFrame:
    """Best k of each query in each block: rows (d, c, role, id, v, floor) to (query_id, vec_id, score)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, tree = None, [], None
        ids, vectors = np.zeros(0, np.int64), np.zeros((0, 1), np.int64)

        def answer(q: list, d: int) -> pa.RecordBatch:
            q_ids, qv, floor = (np.concatenate(x) for x in zip(*q, strict=True))
            keep = _distinct(q_ids, qv)
            best, who = search(tree, ids, vectors, q_ids[keep], qv[keep], floor[keep], k)
            row, col = np.nonzero(best > LOWEST)
            return pa.RecordBatch.from_arrays([pa.array(q_ids[keep][row]), pa.array(who[row, col]), pa.array(best[row, col])], names=["query_id", "vec_id", "score"])

        for batch in batches:
            key = np.stack([batch.column(i).to_numpy() for i in (0, 1, 2)], axis=1)
            cuts = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1).tolist(), len(key)]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                if lo == hi:
                    continue
                d, c, role = map(int, key[lo])
                if (d, c, role) != now:
                    if held and now[2] == 1:
                        yield answer(held, now[0])
                        held = []
                    if role == 0 or now is None or now[:2] != (d, c):
                        held, tree = [], None
                        ids, vectors = np.zeros(0, np.int64), np.zeros((0, d), np.int64)
                    now = (d, c, role)
                part = batch.slice(lo, hi - lo)
                x = part.column(4).flatten().to_numpy().reshape(hi - lo, d)
                held.append((part.column(3).to_numpy(), x, part.column(5).to_numpy()))
                if role == 1:
                    if tree is None:
                        tree = Tree(vectors)
                    if sum(len(h[0]) for h in held) >= BATCH:
                        yield answer(held, d)
                        held = []
                elif role == 0:
                    tree = None
                if role == 0:
                    ids, vectors = np.concatenate([ids, held[-1][0]]), np.concatenate([vectors, held[-1][1]])
                    keep = _distinct(ids, vectors)
                    ids, vectors, held = ids[keep], vectors[keep], []
        if held and now[2] == 1:
            yield answer(held, now[0])

    dealt = rows.repartition(parts, "d", "c").sortWithinPartitions("d", "c", "role", "id", "v")
    return dealt.mapInArrow(released(run), "query_id bigint, vec_id bigint, score bigint")


def pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Centres of ``n`` groups of the sampled vectors."""
    x = sample.astype(np.float64)
    centres = x[: min(n, len(x))].copy()
    for _ in range(5):
        near = ((centres**2).sum(axis=1)[None, :] - 2 * x @ centres.T).argmin(axis=1)
        for i in range(len(centres)):
            if (own := near == i).any():
                centres[i] = x[own].mean(axis=0)
    return centres


def _placed(vectors: DataFrame, centres) -> DataFrame:
    """Rows (id, v, d) with the nearest pivot (c) and a bound of the distance to it (far)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.column(2).to_numpy()
            for d in np.unique(size):
                part = batch.filter(pa.array(size == d))
                p = centres.value[int(d)]
                for lo in range(0, len(part), 2048):
                    rows = part.slice(lo, 2048)
                    x = rows.column(1).flatten().to_numpy().reshape(len(rows), d).astype(np.float64)
                    c = ((p**2).sum(axis=1)[None, :] - 2 * x @ p.T).argmin(axis=1)
                    far = np.sqrt(((x - p[c]) ** 2).sum(axis=1)) + SLACK * (np.linalg.norm(x, axis=1) + np.linalg.norm(p[c], axis=1))
                    yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(c.astype(np.int32)), pa.array(far)], names=["id", "v", "d", "c", "far"])

    return vectors.mapInArrow(released(run), "id bigint, v array<bigint>, d int, c int, far double")


def _visits(asked: DataFrame, centres, cells, first: bool) -> DataFrame:
    """Queries (id, v, d, s, own) for the blocks that they visit: (d, c, role, id, v, floor).

    First the block of the best pivot, with ``s`` NULL; then all others whose bound reaches ``s``.
    ``own`` decides which block of a divided cell is the first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.column(2).to_numpy()
            for d in np.unique(size):
                if int(d) not in centres.value:
                    continue
                part = batch.filter(pa.array(size == d))
                p = centres.value[int(d)]
                of, radius = cells.value[int(d)]
                norm = np.linalg.norm(p, axis=1)
                for lo in range(0, len(part), 256):
                    rows = part.slice(lo, 256)
                    ids, own = rows.column(0).to_numpy(), rows.column(4).to_numpy()
                    x = rows.column(1).flatten().to_numpy().reshape(len(rows), d).astype(np.float64)
                    scores, length = x @ p.T, np.linalg.norm(x, axis=1)[:, None]
                    best = np.where(of > 0, scores, -np.inf).argmax(axis=1)
                    if first:
                        row, block, sub = np.arange(len(rows)), best, own % of[best]
                        floor = np.full(len(rows), LOWEST + 1)
                    else:
                        known = rows.column(3).fill_null(int(LOWEST) + 1).to_numpy()
                        high = scores + length * radius + SLACK * length * (norm + radius) + 1e-3
                        row, block = np.nonzero((high >= known[:, None]) & (of > 0))
                        again = np.repeat(np.arange(len(row)), of[block])
                        sub = np.arange(len(again)) - np.repeat(np.cumsum(of[block]) - of[block], of[block])
                        row, block = row[again], block[again]
                        new = (block != best[row]) | (sub != own[row] % of[best[row]])
                        row, block, sub = row[new], block[new], sub[new]
                        floor = known[row]
                    columns = [np.full(len(row), d, np.int32), block.astype(np.int64) * PARTS + sub, np.ones(len(row), np.int32)]
                    yield pa.RecordBatch.from_arrays(
                        [*map(pa.array, columns), pa.array(ids[row]), rows.column(1).take(pa.array(row)), pa.array(floor.astype(np.int64))],
                        names=["d", "c", "role", "id", "v", "floor"],
                    )

    return asked.mapInArrow(released(run), "d int, c bigint, role int, id bigint, v array<bigint>, floor bigint")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Per query: query_id, rank, vec_id, score of its k best candidates."""
    spark = vectors.sparkSession

    def whole(df: DataFrame) -> DataFrame:
        large = F.raise_error(F.lit("a component exceeds 63 bits")).cast("bigint")
        scaled = F.transform(F.col(vec_col).cast("array<double>"), lambda e: F.when(F.isnan(e) | (F.abs(e) == float("inf")), None).otherwise(SCALE * e))
        df = df.select(F.col(id_col).cast("bigint").alias("id"), scaled.alias("v"))
        df = df.filter(F.col("id").isNotNull() & (F.size("v") > 0) & ~F.exists("v", lambda e: e.isNull()))
        return df.select("id", F.transform("v", lambda e: F.when(F.abs(e) < float(1 << 63), F.floor(e)).otherwise(large)).alias("v"), F.size("v").alias("d"))

    cands, asked = stored(whole(vectors)), stored(whole(queries))
    points = {}
    for d, count in sorted((r.d, r["count"]) for r in cands.groupBy("d").count().collect()):
        n = max(1, min(MAX_PIVOTS, -(-count // BLOCK)))
        drawn = cands.filter(F.col("d") == d).orderBy(F.xxhash64("id"), "id").limit(SAMPLED * n)
        points[d] = pivots(np.array([r.v for r in drawn.select("v").collect()], np.int64), n)
    centres = spark.sparkContext.broadcast(points)
    placed = stored(_placed(cands, centres))
    cells = {d: (np.zeros(len(p), np.int64), np.zeros(len(p))) for d, p in points.items()}
    for r in placed.groupBy("d", "c").agg(F.max("far").alias("far"), F.count(F.lit(1)).alias("n")).collect():
        cells[r.d][0][r.c], cells[r.d][1][r.c] = -(-r.n // BLOCK), r.far
    held = spark.sparkContext.broadcast(cells)
    parts = [(int(d), c, int(n)) for d, (of, _) in cells.items() for c, n in enumerate(of) if n]
    blocks = max(1, sum(n for *_, n in parts))
    sizes = F.broadcast(spark.createDataFrame(parts, "d int, c int, of bigint"))  # MAX_PIVOTS rows at most for a length
    block = F.col("c").cast("bigint") * PARTS + F.pmod(F.xxhash64("id"), F.col("of"))
    none = F.lit(int(LOWEST) + 1).cast("bigint")
    c_rows = placed.join(sizes, ["d", "c"]).select("d", block.alias("c"), F.lit(0).alias("role"), "id", "v", none.alias("floor"))
    asked = asked.dropDuplicates(["id", "v"]).withColumn("own", F.pmod(F.xxhash64("id"), F.lit(1 << 31)))

    def pass_over(known: DataFrame, first: bool) -> DataFrame:
        visits = _visits(known.select("id", "v", "d", "s", "own"), centres, held, first)
        return stored(_blocks(c_rows.unionByName(visits), blocks, k))

    found = pass_over(asked.withColumn("s", F.lit(None).cast("bigint")), True)
    if blocks > 1:
        worst = found.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("s")).filter(f"n >= {k}")
        known = asked.join(worst.select(F.col("query_id").alias("id"), "s"), "id", "left")
        found = found.unionByName(pass_over(known, False))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
