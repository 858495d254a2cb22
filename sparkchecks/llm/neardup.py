"""Near-duplicate documents: MinHash minima, banding, signature check, exact check, components.

1. Each text becomes its set of word shingles (64-bit hashes) and, from that, a 128-bit
   fingerprint of the set and some hundred minima under universal (multiply-shift) hashes.
2. Rows with equal sets become one class; only one row of each class goes on. Classes are told
   apart by their set, so rows that share an id but not the text are different classes.
3. Classes that share a band fall into a bucket. Bands are as long as ``MOST_BANDS`` of them allow
   while a pair at the threshold shares none with a probability below ``MISSED``: 76 bands of 11
   minima for 85 %, 76 of 8 for 80 %. A pair at 50 % then meets with 4 % (26 %). Bands are shuffled
   once; rows with bands and minima stay where they are and are told by their ids.
4. Leaders: each class is compared with one member that leads buckets of it, the one that it meets
   in most of them. That settles most groups of copies with a pair for each member. Buckets of at
   most ``FEW`` members that still hold several components are compared entirely. In larger ones two
   more rounds name two leaders by a hash, and each class is compared with the ``CHOSEN`` leaders
   that it meets most often. So the pairs of a round are at most ``CHOSEN`` for each class, however
   many buckets a group of copies shares, and those of small buckets ``FEW`` / 2 for each entry.
5. Blocks: larger buckets that still hold several components are divided by the size of the sets, so
   that only sizes within the threshold meet, and into chunks of ``CHUNK`` members; pairs of chunks
   are compared on the minima, each in one place. So every pair in a common bucket is either joined
   already or compared; none is dropped, and no group is held whole by a task.
6. A pair is compared on the lowest byte of its minima first (five standard deviations below the
   threshold: 3e-7 of the pairs at the threshold are missed, less above it), then by the intersection
   of the full sets. Only pairs that pass become links; components are found by alternating
   large-star and small-star.

Defined cases: texts without words (or NULL) have an empty set and are linked with nothing; a
text of fewer words than a shingle is one shingle; rows without doc_id are linked with nothing,
have no component and are kept; repeated rows are copies with the same doc_id, and rows that share
a doc_id but not the text are judged row by row; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .components import components
from .storage import among, likely, released, row_count, small, small_once, stored
from .words import U, chunks, distinct_in_docs, mix, shingles, words

SEED = 20_240_229
#: Share of the pairs at the threshold that may meet in no band, and the number of bands for it.
MISSED, MOST_BANDS = 1e-6, 80
#: Standard deviations that the share of equal minima may lie below the threshold.
SIGMAS = 5
#: Members of a bucket that is compared entirely; rounds of leaders in larger ones, and leaders that a member is compared with in each.
FEW, ROUNDS, CHOSEN = 9, 2, 4
#: Members and shingles of a chunk of a block.
CHUNK, CHUNK_SHINGLES = 1024, 2_000_000
#: Rows with shingle sets that a worker holds at a time.
WIDE = 256


def banding(percent: int) -> tuple[int, int]:
    """Bands and minima of each: the longest bands that miss less than ``MISSED`` at the threshold."""
    for rows in range(30, 0, -1):
        together = (percent / 100) ** rows
        bands = 1 if together >= 1 else math.ceil(math.log(MISSED) / math.log1p(-together))
        if bands <= MOST_BANDS:
            return bands, rows
    return MOST_BANDS, 1


def least_equal(percent: int) -> float:
    """Share of equal minima below which a pair is no link."""
    bands, rows = banding(percent)
    t = percent / 100
    return t - SIGMAS * math.sqrt(t * (1 - t) / (bands * rows))


def _minima(value: np.ndarray, first: np.ndarray, n: np.ndarray, count: int) -> np.ndarray:
    """The minimum of each document (they begin at ``first``) under each of ``count`` hashes x -> a * x + b of 32 bits."""
    rng = np.random.default_rng(SEED)
    a = rng.integers(0, 1 << 32, count, np.uint32) | np.uint32(1)
    b = rng.integers(0, 1 << 32, count, np.uint32)
    narrow = (value >> U(32)).astype(np.uint32)
    out = np.full((len(first), count), 0xFFFFFFFF, np.uint32)
    held = np.empty((256, count), np.uint32)
    for x, (lo, size) in enumerate(zip(first.tolist(), n.tolist(), strict=True)):
        for i in range(lo, lo + size, 256):
            part = held[: min(256, lo + size - i)]
            np.multiply(narrow[i : i + len(part), None], a, out=part)
            np.add(part, b, out=part)
            np.minimum(out[x], part.min(axis=0), out=out[x])
    return out


def signatures(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """Rows (doc_id, text, carried) as doc_id, carried, n_shingles, f1, f2 (fingerprint), bands and the minima's lowest bytes."""
    kind = docs.schema["carried"].dataType.simpleString()
    n_bands, per_band = banding(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng(SEED + 1)
        odd = rng.integers(0, 1 << 64, per_band, U) | U(1)
        apart = rng.integers(0, 1 << 64, n_bands, U)
        held: dict = {}
        for batch in batches:
            for i, j, data, offs in chunks(batch.column(1)):
                value, doc = distinct_in_docs(*shingles(words(data, offs, held), k))
                n = np.bincount(doc, minlength=j - i)
                has = np.flatnonzero(n)
                f1, f2 = np.zeros(j - i, U), np.zeros(j - i, U)
                bands: list = [None] * (j - i)
                minima: list = [None] * (j - i)
                if len(has):
                    first = np.searchsorted(doc, has)
                    f1[has] = np.add.reduceat(mix(value ^ odd[0]), first)
                    f2[has] = np.add.reduceat(mix(value ^ apart[0]), first)
                    low = _minima(value, first, n[has], n_bands * per_band)
                    key = mix((low.reshape(-1, n_bands, per_band) * odd).sum(axis=2, dtype=U) + apart).view(np.int64)
                    short = low.astype(np.uint8)
                    for x, d in enumerate(has):
                        bands[d], minima[d] = key[x], short[x].tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(i, j - i),
                        batch.column(2).slice(i, j - i),
                        pa.array(n, pa.int64()),
                        pa.array(f1.view(np.int64)),
                        pa.array(f2.view(np.int64)),
                        pa.array(bands, pa.list_(pa.int64())),
                        pa.array(minima, pa.binary()),
                    ],
                    names=["doc_id", "carried", "n_shingles", "f1", "f2", "bands", "minima"],
                )

    return docs.mapInArrow(released(run), f"doc_id bigint, carried {kind}, n_shingles bigint, f1 bigint, f2 bigint, bands array<bigint>, minima binary")


def shingle_sets(texts: DataFrame, k: int) -> DataFrame:
    """Rows (c, text) as c and the sorted shingle hashes in bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for batch in batches:
            for i, j, data, offs in chunks(batch.column(1)):
                value, doc = distinct_in_docs(*shingles(words(data, offs, held), k))
                at = np.searchsorted(doc, np.arange(j - i + 1))
                sets = [value[at[x] : at[x + 1]].tobytes() for x in range(j - i)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(sets, pa.binary())], names=["c", "s"])

    return texts.mapInArrow(released(run), "c bigint, s binary")


def _alike(pairs: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b) whose minima ma, mb agree often enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 2000):
                part = batch.slice(i, 2000)
                x, y = (np.frombuffer(b"".join(part.column(c).to_pylist()), np.uint8).reshape(part.num_rows, -1) for c in (2, 3))
                good = (x == y).mean(axis=1) >= least
                yield part.select([0, 1]).filter(pa.array(good))

    return pairs.mapInArrow(released(run), "a bigint, b bigint")


def linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets have 100 * intersection >= percent * union."""
    both = np.sort(np.concatenate([x, y]), kind="stable")
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (len(x) + len(y) - common)


def _linked(pairs: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose sets sa, sb have 100 * intersection >= percent * union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for p, q in zip(batch.column(2), batch.column(3), strict=True):
                good.append(linked(np.frombuffer(p.as_buffer(), U), np.frombuffer(q.as_buffer(), U), percent))
            yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

    return pairs.mapInArrow(released(run), "a bigint, b bigint")


def row_key(id_col: str, text_col: str) -> tuple[Column, Column]:
    """What tells rows apart: the id, and two hashes of the text."""
    return F.col(id_col).cast("bigint").alias("doc_id"), F.struct(F.xxhash64(F.col(text_col)).alias("x"), F.hash(F.col(text_col)).alias("y")).alias("carried")


def judged_rows(docs: DataFrame, k: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """Per row: doc_id, carried (its text's hashes), n_shingles, class_id, component_id, and c, the number of its component (NULL: none)."""
    key, hashes = row_key(id_col, text_col)
    base = docs.select(key, F.col(text_col).cast("string").alias("text"), hashes)
    sig = stored(signatures(base, k, percent).withColumn("r", F.monotonically_increasing_id()), 2_000)
    named = sig.filter("doc_id IS NOT NULL AND n_shingles > 0").select("doc_id", "r", "f1", "f2")
    copies = named.groupBy("f1", "f2").agg(F.min(F.struct("doc_id", "r")).alias("of"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    copies = stored(copies.select("f1", "f2", F.col("of.r").alias("of"), F.col("of.doc_id").alias("of_id")))
    rows = sig.select("doc_id", "carried", "n_shingles", "r", "f1", "f2").join(small(copies), ["f1", "f2"], "left")
    able = F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)
    rows = rows.select("doc_id", "carried", "n_shingles", "r", F.when(able, F.coalesce("of", "r")).alias("c"), F.when(able, F.coalesce("of_id", "doc_id")).alias("c_id"))
    rows = stored(rows)
    others = stored(rows.filter("c IS NULL OR c <> r").select("r"))
    classes = among(sig, others, "r", keep=False).select(F.col("r").alias("c"), "doc_id", "carried", "n_shingles", "bands", "minima")

    found = _linked_classes(base, classes, k, percent)
    names = rows.filter("c = r").select("c", "c_id").join(small(found), "c")
    least = names.groupBy("component").agg(F.min("c_id").alias("component_id"))
    named = stored(names.select("c", "component").join(least, "component"))
    out = rows.join(small(named), "c", "left")
    return out.select(
        "doc_id",
        "carried",
        "n_shingles",
        F.coalesce("c_id", "doc_id").alias("class_id"),
        F.coalesce("component_id", "c_id", "doc_id").alias("component_id"),
        F.coalesce("component", "c").alias("c"),
    )


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, kept, class_id."""
    rows = judged_rows(docs, k, percent, id_col, text_col)
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept")
    return rows.select("doc_id", "n_shingles", "component_id", kept, "class_id")


def one_of_each(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without all but one of each group of near duplicates: the one with the smallest id, then hash of the text.

    Rows without id and rows without words all stay; of rows that repeat id and text one stays.
    """
    rows = stored(judged_rows(docs, k, percent, id_col, text_col).filter("c IS NOT NULL").select("c", F.struct("doc_id", "carried").alias("key")))
    groups = stored(rows.groupBy("c").agg(F.min("key").alias("stays"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"))
    told = stored(rows.join(small(groups), "c").withColumn("same", F.col("key") == F.col("stays")))
    gone = stored(told.filter("NOT same").select(F.col("key").alias("__key")).distinct())
    again = stored(told.filter("same").groupBy("key").count().filter("count > 1").select(F.col("key").alias("__key")))
    kept = docs.withColumn("__key", F.struct(*row_key(id_col, text_col)))
    kept = kept.join(small(gone), "__key", "left_anti")
    if not row_count(again):
        return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    first = kept.join(small(again), "__key", "left_semi").groupBy("__key").agg(F.first(row).alias("row")).select("row.*")
    return kept.join(small(again), "__key", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns]).unionByName(first)


def _in_blocks(rows: DataFrame, percent: int) -> DataFrame:
    """Rows (block, docs, p, q): members of a block and the pairs (places in docs) to be confirmed.

    Takes rows (key, i, j, side, c, component, n, minima, bands) sorted by (key, i, j). Sides 0 and 1
    are two chunks of a bucket, side 2 is one chunk compared with itself.
    """
    n_bands, per_band = banding(percent)
    least = least_equal(percent)
    some = min(128, n_bands * per_band)
    least_some = percent / 100 - SIGMAS * math.sqrt(percent / 100 * (1 - percent / 100) / some)

    def compare(x: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        side, c, component, n = (x.column(i).to_numpy() for i in (3, 4, 5, 6))
        key = x.column(0)[0].as_py()
        fine = np.frombuffer(b"".join(x.column(7).to_pylist()), np.uint8).reshape(len(c), -1)
        bands = x.column(8).flatten().to_numpy().reshape(len(c), n_bands)
        earlier = int(np.flatnonzero(bands[0] == key)[0])
        p, q = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
        able = component[p][:, None] != component[q][None, :]
        able &= 100 * np.minimum(n[p][:, None], n[q][None, :]) >= percent * np.maximum(n[p][:, None], n[q][None, :])
        able &= (c[p][:, None] < c[q][None, :]) if side[0] == 2 else True
        r, s = np.nonzero(able)
        r, s = p[r], q[s]

        def only(test) -> None:
            nonlocal r, s
            kept = [test(r[i : i + 8192], s[i : i + 8192]) for i in range(0, len(r), 8192)]
            keep = np.concatenate(kept) if kept else np.zeros(0, bool)
            r, s = r[keep], s[keep]

        only(lambda x, y: (fine[x, :some] == fine[y, :some]).mean(axis=1) >= least_some)
        only(lambda x, y: ~(bands[x, :earlier] == bands[y, :earlier]).any(axis=1))
        only(lambda x, y: (fine[x] == fine[y]).mean(axis=1) >= least)
        return r, s

    def finish(held: list[pa.RecordBatch]) -> list[pa.RecordBatch]:
        x = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        r, s = compare(x)
        if not len(r):
            return []
        used, places = np.unique(np.concatenate([r, s]), return_inverse=True)
        docs = x.column(4).to_numpy()[used].tolist()
        block = hash(tuple(x.column(i)[0].as_py() for i in range(3)))
        columns = [pa.array([v]) for v in (block, docs, places[: len(r)].tolist(), places[len(r) :].tolist())]
        return [pa.RecordBatch.from_arrays(columns, names=["block", "docs", "p", "q"])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        now = None
        for batch in batches:
            key = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in (0, 1, 2)], axis=1)
            cuts = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1).tolist(), len(key)]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                if lo < hi:
                    if held and now != tuple(key[lo]):
                        yield from finish(held)
                        held = []
                    now = tuple(key[lo])
                    held.append(batch.slice(lo, hi - lo))
        if held:
            yield from finish(held)

    return rows.mapInArrow(released(run), "block bigint, docs array<bigint>, p array<bigint>, q array<bigint>")


def _confirmed_blocks(blocks: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) of blocks, a forest of each; sets are rows (c, s)."""

    def confirm(block, members: pd.DataFrame) -> pd.DataFrame:
        at = {c: np.frombuffer(s, U) for c, s in zip(members["c"], members["s"], strict=True)}
        root: dict = {}

        def find(x: int) -> int:
            while root.get(x, x) != x:
                x = root[x]
            return x

        out = []
        for docs, p, q in zip(block["docs"], block["p"], block["q"], strict=True):
            for a, b in zip(docs[p], docs[q], strict=True):
                ra, rb = find(a), find(b)
                if ra != rb and linked(at[a], at[b], percent):
                    root[ra] = rb
                    out.append((a, b))
        return pd.DataFrame(out, columns=["a", "b"]).astype("int64")

    members = blocks.select(F.col("block").alias("of"), F.explode("docs").alias("c")).distinct().join(sets.select("c", "s"), "c")
    return blocks.groupBy("block").cogroup(members.groupBy("of")).applyInPandas(confirm, "a bigint, b bigint")


def _chunked(tagged: DataFrame, fine: DataFrame, percent: int) -> DataFrame:
    """Members (key, c, component) dealt to the pairs of chunks of their bucket whose sizes can be alike.

    Sets are told apart by the logarithm of their size in steps of the threshold: linked ones lie in
    one step or in two neighbours. Each step of a bucket is divided into chunks by a hash.
    """
    step = 1.001 * math.log(100 / percent) if percent < 100 else 1e-9
    sized = tagged.join(fine.select("c", "n"), "c").withColumn("cell", F.floor(F.log("n") / step))
    chunks_of = F.greatest(F.ceil(F.count(F.lit(1)) / CHUNK), F.ceil(F.sum("n") / CHUNK_SHINGLES)).cast("int")
    counts = stored(sized.groupBy("key", "cell").agg(chunks_of.alias("of")))
    near = counts.select("key", (F.col("cell") - 1).alias("cell"), F.col("of").alias("above"))
    below = counts.select("key", (F.col("cell") + 1).alias("cell"), F.col("of").alias("below"))
    around = stored(counts.join(near, ["key", "cell"], "left").join(below, ["key", "cell"], "left").fillna(0, ["above", "below"]))
    rows = sized.join(small(around), ["key", "cell"]).withColumn("own", F.pmod(F.xxhash64("c"), F.col("of")).cast("int"))

    def chunks_in(cell: Column, n: Column) -> Column:
        """Names of all chunks of a step."""
        of = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.expr("CAST(array() AS array<int>)"))
        return F.transform(of, lambda x: cell * (1 << 32) + x)

    cell = F.col("cell")
    others = F.concat(chunks_in(cell, F.col("of")), chunks_in(cell + 1, F.col("above")), chunks_in(cell - 1, F.col("below")))
    rows = rows.withColumn("mine", cell * (1 << 32) + F.col("own")).withColumn("other", F.explode(others))
    side = F.when(F.col("mine") == F.col("other"), 2).otherwise((F.col("mine") > F.col("other")).cast("int"))
    rows = rows.select("key", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), side.alias("side"), "c", "component")
    rows = rows.join(fine, "c").select("key", "i", "j", "side", "c", "component", "n", "minima", "bands")
    return rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "c")


def _linked_classes(base: DataFrame, classes: DataFrame, k: int, percent: int) -> DataFrame:
    """Components (c, component) of the classes that have links; every link is confirmed."""
    spark = base.sparkSession
    entries = classes.select("c", F.explode("bands").alias("key"))
    # One shuffle finds buckets and their members; a bucket is at most one part in as many as there are bands.
    bucket = Window.partitionBy("key")
    active = stored(entries.select("key", "c", F.min("c").over(bucket).alias("lo"), F.max("c").over(bucket).alias("hi")).filter("lo < hi").select("key", "c"))
    ids = stored(active.select("c").distinct())
    known = stored(among(classes, ids, "c"))
    minima = known.select("c", "minima")
    state = {"parts": ids.withColumn("component", F.col("c")), "sets": None}
    state["components"] = spark.createDataFrame([], "c bigint, component bigint")

    def sets_of(wanted: DataFrame) -> DataFrame:
        """Sets of wanted classes; texts of those that were not read before are read again for them."""
        before = state["sets"]
        new = wanted if before is None else stored(wanted.join(before.select("c"), "c", "left_anti"))
        if before is None or row_count(new):
            new = _sets_of(base, stored(among(known.select("c", "doc_id", "carried"), new, "c")), k)
            state["sets"] = new if before is None else before.unionByName(new)
        return among(state["sets"], wanted, "c")

    def unsettled(active: DataFrame) -> DataFrame:
        """Rows (c, key, component) of buckets that hold several components."""
        tagged = stored(active.join(small(state["parts"], row_count(ids)), "c"))
        mixed = tagged.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi").select("key")
        return stored(tagged.join(small_once(mixed, row_count(tagged) // 2), "key"))

    def confirm(pairs: DataFrame) -> None:
        """Compare the sets of pairs; links that are found join components."""
        if not row_count(pairs):
            return
        sets = sets_of(stored(pairs.select(F.explode(F.array("a", "b")).alias("c")).distinct()))
        full = pairs.join(sets.select(F.col("c").alias("a"), F.col("s").alias("sa")), "a")
        full = full.join(sets.select(F.col("c").alias("b"), F.col("s").alias("sb")), "b").select("a", "b", "sa", "sb")
        add(stored(_linked(full, percent), WIDE))

    def compare(met: DataFrame) -> None:
        """Compare the minima of rows (c, b), then the sets of those that agree."""
        pairs = met.select(F.greatest("c", "b").alias("a"), F.least("c", "b").alias("b")).distinct()
        checked = pairs.join(minima.select(F.col("c").alias("a"), F.col("minima").alias("ma")), "a")
        checked = checked.join(minima.select(F.col("c").alias("b"), F.col("minima").alias("mb")), "b").select("a", "b", "ma", "mb")
        confirm(stored(_alike(checked, least_equal(percent)), 4_000))

    def add(found: DataFrame) -> None:
        if not row_count(found):
            return
        # What is joined already is one star for each component; new links join stars.
        stars = state["components"].filter("c <> component").select(F.col("c").alias("a"), F.col("component").alias("b"))
        joined = stored(components(stars.unionByName(found)).withColumnRenamed("node", "c"))
        state["components"] = joined
        parts = ids.join(small(joined), "c", "left")
        state["parts"] = stored(parts.select("c", F.coalesce("component", "c").alias("component")))

    def leaders(tagged: DataFrame, turn: int) -> DataFrame:
        """Rows (c, b): members of a bucket and its leaders of another component; of those the ones met in most buckets."""
        order = F.struct(F.xxhash64("c", F.lit(turn)) if turn else F.col("c"), F.col("c").alias("b"), F.col("component").alias("cb"))
        ends = [F.min(order), F.max(order)] if turn else [F.min(order)]
        led = tagged.groupBy("key").agg(F.array(*ends).alias("led")).select("key", F.explode("led").alias("led")).select("key", "led.b", "led.cb")
        met = tagged.join(small_once(led, row_count(tagged)), "key").filter("component <> cb").groupBy("c", "b").agg(F.count(F.lit(1)).alias("n"))
        place = F.row_number().over(Window.partitionBy("c").orderBy(F.desc("n"), "b"))
        return met.withColumn("place", place).filter(F.col("place") <= (CHOSEN if turn else 1)).select("c", "b")

    tagged = unsettled(active)
    if row_count(tagged):
        compare(leaders(tagged, 0))
        tagged = unsettled(tagged.select("key", "c"))
    if row_count(tagged):
        sizes = stored(tagged.groupBy("key").count())
        few = stored(tagged.join(small(sizes.filter(F.col("count") <= FEW).select("key"), most=row_count(sizes)), "key"))
        other = few.select("key", F.col("c").alias("b"), F.col("component").alias("cb"))
        compare(few.join(other, "key").filter("c < b AND component <> cb").select("c", "b"))
        tagged = unsettled(tagged.join(small(sizes.filter(F.col("count") > FEW).select("key"), most=row_count(sizes)), "key").select("key", "c"))
    for turn in range(1, 1 + ROUNDS):
        if not row_count(tagged):
            return state["components"]
        compare(leaders(tagged, turn))
        tagged = unsettled(tagged.select("key", "c"))
    left = stored(tagged.select("c").distinct())
    if row_count(left):
        sets = sets_of(left)
        fine = stored(among(known, left, "c").select("c", F.col("n_shingles").alias("n"), "minima", "bands"))
        blocks = stored(_in_blocks(_chunked(tagged, fine, percent), percent), 2_000)
        add(stored(_confirmed_blocks(blocks, sets, percent), WIDE))
    return state["components"]


def _sets_of(base: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """Sets (c, s) of wanted classes (c, doc_id, carried), from the texts of their documents."""
    sets = stored(shingle_sets(likely(base, wanted, ["doc_id", "carried"]).join(small(wanted), ["doc_id", "carried"]).select("c", "text"), k), 2_000)
    if row_count(sets) == row_count(wanted):  # each class has one row at least
        return sets
    return stored(sets.dropDuplicates(["c"]), WIDE)  # repeated rows
