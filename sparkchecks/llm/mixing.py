"""Mixing sources to target weights with a splitting tree over blocks.

1. Every document falls into a block of its source by a hash of its id; a source has one block for
   ``DOCS_PER_BLOCK`` documents, ``MAX_BLOCKS`` at most (larger sources have larger blocks).
2. Targets: each source's share of all sizes by weight, at most ``CAP`` times its own size; what is
   cut off is shared among the others by weight (water-filling, solved in closed form).
3. A source's quota: whole passes over its blocks, then blocks in a permuted order up to the target.
   Of the block that crosses it, documents in a permuted order are taken while they fit. What is then
   missing is mended with single documents from anywhere else: the one that brings the sum nearest to
   the target, again and again, until none brings it nearer.
4. The quotas, in blocks, are dealt to the output shards by a tree: at each node the left half draws
   its blocks from the sources by a multivariate hypergeometric draw. The draws of a source are
   disjoint runs of its permuted blocks. Within a shard documents are shuffled. The driver splits the
   upper nodes, up to ``HELD`` entries; each subtree below is split by a task, which returns its draws as rows.

All draws follow from ``seed`` and hashes, so reruns agree, also after lost executors. Sizes and
block sums cover all documents; only the quota of each source passes through the driver.

Defined cases: a NULL text has size 0; NULL is a source of its own, the last; rows that share an id
and a source are taken together; empty tables give no rows; if all sizes are 0 nothing is taken.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .packing import word_count
from .storage import row_count, small, stored

WEIGHTS = (5, 2, 1)
CAP = 3
DOCS_PER_BLOCK = 64
MAX_BLOCKS = 4096
WORDS_PER_SHARD = 500_000
#: Entries (node, source) that the driver splits at most, subtrees, and blocks of a mixture (draws are of less than 1e9).
HELD, SUBTREES, ALL_BLOCKS = 4_000_000, 256, 300_000_000
#: Sources are named in a mixture's configuration; their quotas fit on the driver.
MAX_SOURCES = 100_000


def targets(by_source: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """Rows (source, source_size, docs) with sid, weight and target; one row per source."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("sid"), F.lit(len(weights))) + 1).cast("int"))
    t = by_source.withColumn("sid", F.row_number().over(order) - 1).withColumn("weight", weight)
    t = t.withColumn("limit", (F.lit(cap) * F.col("source_size")).cast("double"))
    filling = Window.orderBy(F.col("limit") / F.col("weight"), "sid")
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    free = F.sum("source_size").over(whole) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    rest = F.sum("weight").over(filling.rowsBetween(0, Window.unboundedFollowing))
    t = t.withColumn("level", free / rest)
    level = F.min(F.when(F.col("level") <= F.col("limit") / F.col("weight"), F.struct(F.col("limit") / F.col("weight"), "sid", "level"))).over(whole)
    return t.withColumn("target", F.least("limit", level["level"] * F.col("weight"))).drop("level", "limit")


#: The shards from lo to hi, their sources (sids) and how many blocks of each they get; sources without blocks are left out.
Node = tuple[int, int, np.ndarray, np.ndarray]


def halves(node: Node, seed: int) -> list[Node]:
    """A node's two halves: the left one draws its blocks, the right one gets the rest."""
    lo, hi, sids, counts = node
    mid = (lo + hi) // 2
    draw = int(counts.sum()) * (mid - lo) // (hi - lo)
    rng = np.random.default_rng([seed, lo, hi])
    left = rng.multivariate_hypergeometric(counts, draw, method="marginals") if draw else np.zeros_like(counts)
    return [(a, b, sids[own > 0], own[own > 0]) for a, b, own in ((lo, mid, left), (mid, hi, counts - left))]


def leaves(node: Node, seed: int) -> Iterator[Node]:
    """All shards below a node, in order, with what they get."""
    todo = [node]
    while todo:
        node = todo.pop()
        if node[1] - node[0] == 1:
            yield node
        else:
            todo += halves(node, seed)[::-1]


def split(quotas: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """Blocks of each source (rows) for each shard (columns): the tree as a matrix, for small mixtures."""
    out = np.zeros((len(quotas), shards), np.int64)
    has = np.flatnonzero(quotas)
    for lo, _, sids, counts in leaves((0, shards, has, np.asarray(quotas, np.int64)[has]), seed):
        out[sids, lo] = counts
    return out


def dealt_shards(spark: SparkSession, quotas: dict[int, int], shards: int, seed: int) -> DataFrame:
    """Rows (sid, number, shard): the shard of each block of a source, numbered along the shards."""
    sids = np.array(sorted(k for k, n in quotas.items() if n), np.int64)
    nodes: list[Node] = [(0, shards, sids, np.array([quotas[int(k)] for k in sids], np.int64))]
    while len(nodes) < SUBTREES and any(hi - lo > 1 for lo, hi, *_ in nodes) and 2 * sum(len(n[2]) for n in nodes) <= HELD:
        nodes = [x for n in nodes for x in (halves(n, seed) if n[1] - n[0] > 1 else [n])]
    columns = {"lo": [n[0] for n in nodes], "hi": [n[1] for n in nodes], "sids": [n[2].tolist() for n in nodes], "counts": [n[3].tolist() for n in nodes]}
    upper = spark.createDataFrame(pd.DataFrame(columns), "lo bigint, hi bigint, sids array<bigint>, counts array<bigint>")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                held, size = [], 0
                for lo, _, own, counts in leaves((row.lo, row.hi, np.array(row.sids, np.int64), np.array(row.counts, np.int64)), seed):
                    held.append(pd.DataFrame({"sid": own, "shard": np.int64(lo), "n": counts}))
                    size += len(own)
                    if size >= 100_000:
                        yield pd.concat(held)
                        held, size = [], 0
                if held:
                    yield pd.concat(held)

    drawn = stored(upper.repartition(len(nodes), "lo").mapInPandas(run, "sid bigint, shard bigint, n bigint"))
    before = F.sum("n").over(Window.partitionBy("sid").orderBy("shard")) - F.col("n")
    numbers = F.sequence(F.col("first"), F.col("first") + F.col("n") - 1)
    ranges = drawn.filter("n > 0").select(F.col("sid").cast("int").alias("sid"), F.col("shard").cast("int").alias("shard"), "n", before.alias("first"))
    return ranges.select("sid", "shard", F.explode(numbers).alias("number"))


def _filled(units: DataFrame, missing: DataFrame, seed: int) -> tuple[DataFrame, DataFrame]:
    """Units (sid, u, size) of the crossing blocks that are taken in a permuted order while they fit, and what is still missing.

    Each round takes the units up to the first that doesn't fit; larger ones than what is left then drop out.
    """
    along = Window.partitionBy("sid").orderBy(F.xxhash64("u", F.lit(seed + 1)), "u")
    chosen, units = units.limit(0), units.filter("size > 0")
    sids = row_count(missing)
    while True:
        run = units.join(small(missing, sids), "sid").filter("size <= missing").withColumn("end", F.sum("size").over(along))
        run = stored(run.withColumn("fits", F.col("end") <= F.col("missing")))
        if not row_count(run):
            return stored(chosen), stored(missing.filter("missing > 0"))
        taken = run.filter("fits").select("sid", "u", "size")
        chosen, units = chosen.unionByName(taken), run.filter("NOT fits").select("sid", "u", "size")
        filled = taken.groupBy("sid").agg(F.sum("size").alias("filled"))
        missing = stored(missing.join(small(filled, most=sids), "sid", "left").select("sid", (F.col("missing") - F.coalesce("filled", F.lit(0))).alias("missing")))


def _mended(open_units: DataFrame, missing: DataFrame) -> DataFrame:
    """Units (sid, u, size, o) of which each brings what a source (sid, missing) lacks nearer to nothing."""
    spark = open_units.sparkSession
    taken = spark.createDataFrame([], "sid int, u bigint, size bigint")
    while True:
        left = F.abs(F.col("missing") - F.col("size"))
        able = open_units.join(small(missing), "sid").filter(left < F.col("missing"))
        best = able.groupBy("sid").agg(F.min(F.struct(left.alias("left"), "o", "u", "size")).alias("best"))
        best = stored(best.select("sid", F.col("best.u").alias("u"), F.col("best.size").alias("size")))
        if not row_count(best):
            return taken
        taken = taken.unionByName(best)
        missing = missing.join(small(best.select("sid", F.col("size").alias("more")), row_count(best)), "sid")
        missing = stored(missing.select("sid", (F.col("missing") - F.col("more")).alias("missing")))
        # What fits next is smaller than what was missing before.
        gone = small(best.select("sid", "u"), row_count(best))
        open_units = stored(open_units.join(small(missing), "sid").filter(F.col("size") < 2 * F.col("missing")).drop("missing").join(gone, ["sid", "u"], "left_anti"))


def plan(docs: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP, seed: int = 1, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Stored tables: documents (doc_id, source, size, u), sources, blocks with shards, single units with theirs."""
    unit = F.xxhash64(F.col(id_col), F.lit(seed))
    narrow = stored(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"), unit.alias("u")))
    by_source = narrow.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    known = by_source.limit(MAX_SOURCES + 1).count()
    if known > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    most = max(1, min(MAX_BLOCKS, ALL_BLOCKS // max(1, known)))
    blocks = F.least(F.lit(most), F.ceil(F.col("docs") / DOCS_PER_BLOCK)).cast("bigint")
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    sources = targets(by_source, weights, cap).withColumn("n_blocks", blocks).withColumn("passes", passes.cast("bigint"))
    sources = stored(sources.withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size")))

    placed = placed_rows(narrow, sources)
    sums = placed.groupBy("sid", "block").agg(F.sum("size").alias("words"))
    sums = sums.join(small(sources.select("sid", "passes", "rest"), row_count(sources)), "sid")
    order = F.xxhash64("sid", "block", "passes", F.lit(seed))
    run = Window.partitionBy("sid").orderBy(order, "block")
    sums = sums.withColumn("end", F.sum("words").over(run)).withColumn("begin", F.col("end") - F.col("words"))
    whole, crossing = F.col("end") <= F.col("rest"), (F.col("begin") < F.col("rest")) & (F.col("end") > F.col("rest"))
    sums = stored(sums.withColumn("whole", whole & (F.col("rest") > 0)).withColumn("crossing", crossing))

    # Each pass over a block is one instance; its number within the source follows a permuted order.
    count = F.col("passes") + (F.col("whole") | F.col("crossing")).cast("bigint")
    each = sums.select("sid", "block", "passes", "crossing", F.explode(F.when(count > 0, F.sequence(F.lit(0).cast("bigint"), count - 1)).otherwise(F.array().cast("array<bigint>"))).alias("p"))
    number = Window.partitionBy("sid").orderBy("p", F.xxhash64("sid", "block", "p", F.lit(seed)), "block")
    each = stored(each.withColumn("number", F.row_number().over(number) - 1).withColumn("part", F.col("crossing") & (F.col("p") == F.col("passes"))))
    rows = each.groupBy("sid").count().collect()  # MAX_SOURCES rows at most
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    shards = max(1, min(sum(r["count"] for r in rows) or 1, -(-int(total) // WORDS_PER_SHARD)))
    shard_of = dealt_shards(docs.sparkSession, {r.sid: r["count"] for r in rows}, shards, seed)
    each = each.join(shard_of, ["sid", "number"])
    full = F.array_sort(F.collect_list(F.when(~F.col("part"), F.col("shard"))))  # at most CAP entries
    taken = stored(each.groupBy("sid", "block").agg(full.alias("full"), F.max(F.when(F.col("part"), F.col("shard"))).alias("part")))

    cross = stored(sums.filter("crossing").select("sid", "block", (F.col("rest") - F.col("begin")).alias("room")))
    units = stored(placed.join(small(cross), ["sid", "block"]).groupBy("sid", "u").agg(F.sum("size").alias("size")))
    missing = cross.select("sid", F.col("room").alias("missing"))
    chosen, missing = _filled(units.select("sid", "u", "size"), missing, seed)
    # Units outside of the blocks that the last pass takes whole, unless they are far too large.
    others = placed.join(small(missing), "sid").join(small(sums.filter("whole").select("sid", "block"), most=row_count(sums)), ["sid", "block"], "left_anti")
    others = others.groupBy("sid", "u").agg(F.sum("size").alias("size"), F.max("missing").alias("missing"))
    others = others.filter((F.col("size") > 0) & (F.col("size") < 2 * F.col("missing"))).drop("missing")
    others = others.join(small(chosen.select("sid", "u"), row_count(chosen)), ["sid", "u"], "left_anti").withColumn("o", F.xxhash64("u", F.lit(seed + 2)))
    more = _mended(stored(others), missing)
    part = taken.filter("part IS NOT NULL").select("sid", F.col("part").alias("shard"))
    chosen = stored(chosen.unionByName(more).select("sid", "u").join(small(part, most=row_count(taken)), "sid"))
    return narrow, sources, taken, chosen


def placed_rows(narrow: DataFrame, sources: DataFrame) -> DataFrame:
    """Rows with the sid and block of their source and unit."""
    side = small(sources.select(F.col("source").alias("__source"), "sid", "n_blocks"), row_count(sources))
    joined = narrow.join(side, narrow["source"].eqNullSafe(F.col("__source"))).drop("__source")
    return joined.withColumn("block", F.pmod("u", "n_blocks")).drop("n_blocks")


def with_shards(rows: DataFrame, sources: DataFrame, taken: DataFrame, chosen: DataFrame) -> DataFrame:
    """Rows (with source and u) and ``shards``: the shard of each copy that the mix takes."""
    out = placed_rows(rows, sources).join(small(taken), ["sid", "block"], "left")
    out = out.join(small(chosen.withColumnRenamed("shard", "__extra"), row_count(chosen)), ["sid", "u"], "left")
    none = F.array().cast("array<int>")
    extra = F.when(F.col("__extra").isNotNull(), F.array("__extra")).otherwise(none)
    return out.withColumn("shards", F.concat(F.coalesce("full", none), extra)).drop("full", "part", "__extra")


def mix_plan(docs: DataFrame, **options) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken, copies."""
    narrow, sources, taken, chosen = plan(docs, **options)
    out = with_shards(narrow, sources, taken, chosen).join(small(sources.select("sid", "source_size", "target"), row_count(sources)), "sid")
    copies = F.size("shards").cast("bigint")
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * copies).alias("taken"), copies.alias("copies"))


def mix(docs: DataFrame, seed: int = 1, id_col: str = "doc_id", source_col: str = "source", **options) -> DataFrame:
    """The mixed documents: all columns, one row per copy, in the order of shards, shuffled within."""
    _, sources, taken, chosen = plan(docs, seed=seed, id_col=id_col, source_col=source_col, **options)
    packed = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(packed, F.col(source_col).alias("source"), F.xxhash64(F.col(id_col), F.lit(seed)).alias("u"))
    rows = with_shards(rows, sources, taken, chosen).select("row", "u", F.posexplode("shards").alias("copy", "shard"))
    rows = rows.orderBy("shard", F.xxhash64("u", "copy", F.lit(seed)))
    return rows.select("row.*")
