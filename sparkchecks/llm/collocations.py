"""Collocations per language: phrases of 2 to 4 words that are more frequent than their parts suggest.

1. *Shards.* A task gathers texts by language; some ``SHARD`` bytes at a time become a count
   transducer: the windows of up to four words that begin at each word, sorted, as a weighted acyclic
   automaton. Shards are written to the shared folder.
2. *Ranges.* Windows sampled from the shards divide their order into ranges of some ``RANGE`` windows
   (the sample decides only where work is cut). Shards of a task are united piece by piece and cut at the ranges.
3. *Union.* Tasks unite the transducers of each range and add up weights. The count of a phrase
   is the sum over the paths that begin with it; phrases that reach ``least`` leave the range, and
   those at its two ends in any case, since they may go on in the next one. Their sums are added.
4. *Parts.* Every candidate is cut after each of its words; both parts are looked up in the table of
   counts (the composition of the candidates with the counts, as joins on language and phrase; Spark
   divides the parts that many candidates share). Scores are integers, computed as decimals of 38 digits.
5. *Containment.* The largest count among longer candidates around each phrase is one maximum
   per phrase, so no list of pairs arises.

Defined cases: NULL and empty texts have no words; a NULL language is ``und``; rows without id and
repeated rows count like all others; only the text and the language are read; a text of any length
is counted whole (one without any end of a piece is cut where a word ends, with the next words as
context); an empty table gives no rows.
"""

from __future__ import annotations

import math
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .storage import released, stored, trim
from .transducer import APART, DEPTH, ENDS, Transducer, merged, union

#: Bytes of text of a shard; windows of a range; windows per sampled window.
SHARD, RANGE, STEP = 2 << 20, 1_000_000, 25_000
#: Windows united before a cut, and of a range between two unions.
UNITED, FRESH = 1_200_000, 300_000
#: Ranges that a task unites one after another and writes as one file.
TOGETHER = 4
#: Ranges and samples that the driver holds at most; beyond them ranges grow.
MAX_RANGES, MAX_SAMPLES = 65_536, 1_000_000
#: Rows per language after the first round of the ranking are kept in so many groups.
SALTS = 64
UNDETERMINED = "und"


def texts_of(parts: list[bytes], size: int) -> Iterator[tuple[bytes, int]]:
    """Texts joined by line ends, in pieces of about ``size`` bytes, and the bytes whose words begin windows there.

    A piece ends where a text's piece ends; where none does for as long again, it ends behind a word
    and carries the next words along.
    """
    whole = b"\n".join(parts)
    at = 0
    while len(whole) - at > 2 * size:
        cut = next((i + 1 for i in range(at + size, at + 2 * size) if ENDS[whole[i]]), 0)
        if cut:
            yield whole[at:cut], cut - at
        else:
            cut = next((i for i in range(at + size, len(whole)) if APART[whole[i]]), len(whole))
            more, words = cut, 0
            while more < len(whole) and words < DEPTH:
                more += 1
                words += more < len(whole) and APART[whole[more]] and not APART[whole[more - 1]]
            yield whole[at:more], cut - at
        at = cut
    yield whole[at:], len(whole) - at


def shards(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", size: int = SHARD, step: int = STEP) -> DataFrame:
    """Rows (lang, n, blob, sample): count transducers of some ``size`` bytes of text, and every ``step``-th of their windows."""
    base = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UNDETERMINED)).alias("lang"), F.col(text_col).cast("binary").alias("text"))

    def rows(lang: str, parts: list[bytes]) -> Iterator[pa.RecordBatch]:
        for text, own in texts_of(parts, size):
            t = Transducer.of_text(text)
            if own < len(text):
                after = Transducer.of_text(text[own:])
                t = union([t, Transducer(after.words, after.paths, -after.weights)])
                there = t.weights > 0
                t = Transducer(t.words, t.paths[there], t.weights[there])
            if len(t.paths):
                blob = t.to_bytes()
                # from another place in each shard: the same places would be the same windows in all, with all others in the ranges between
                sample = [b" ".join(t.window(i)) for i in range(zlib.crc32(blob) % step, len(t.paths), step)]
                columns = [pa.array([lang]), pa.array([int(t.weights.sum())], pa.int64()), pa.array([blob], pa.binary()), pa.array([sample], pa.list_(pa.binary()))]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "n", "blob", "sample"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        sizes: dict[str, int] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if text:
                    held.setdefault(lang, []).append(text)
                    sizes[lang] = sizes.get(lang, 0) + len(text)
                    if sizes[lang] >= size:
                        yield from rows(lang, held.pop(lang))
                        del sizes[lang]
                    elif sum(sizes.values()) >= 4 * size:
                        most = max(sizes, key=sizes.get)
                        yield from rows(most, held.pop(most))
                        del sizes[most]
        for lang, parts in held.items():
            yield from rows(lang, parts)

    return base.mapInArrow(released(run), "lang string, n bigint, blob binary, sample array<binary>")


def splits(written: DataFrame, size: int = RANGE, step: int = STEP) -> dict[str, tuple[int, list[tuple[bytes, ...]]]]:
    """Per language the number of its first range and the windows at which the next ones begin."""
    windows, samples = written.agg(F.sum("n"), F.sum(F.size("sample"))).first()
    if not windows:
        return {}
    share = min(1.0, MAX_SAMPLES / max(1, samples))
    some = written.filter(F.pmod(F.xxhash64("n", "sample"), F.lit(1 << 20)) < math.ceil(share * (1 << 20))).select("lang", F.explode("sample").alias("w"))
    drawn = sorted((r.lang, tuple(bytes(r.w).split(b" "))) for r in some.collect())
    ranges = max(1, min(MAX_RANGES, math.ceil(windows / size)))
    every = max(1, len(drawn) // ranges)
    out: dict[str, tuple[int, list]] = {}
    for i, lang in enumerate(sorted({r.lang for r in written.select("lang").distinct().collect()})):
        out[lang] = (0, sorted({w for l, w in drawn[every - 1 :: every] if l == lang}))
    first = 0
    for lang, (_, at) in out.items():
        out[lang] = (first, at)
        first += len(at) + 1
    return out


def cut_at(written: DataFrame, at: dict[str, tuple[int, list[tuple[bytes, ...]]]]) -> DataFrame:
    """Shards as rows (range, lang, blob); those of a task are united before they are cut."""
    known = written.sparkSession.sparkContext.broadcast(at)

    def rows(lang: str, parts: list[Transducer]) -> Iterator[pa.RecordBatch]:
        first, windows = known.value[lang]
        for t in merged(parts):
            lo, hi = (bisect_right(windows, t.window(i)) for i in (0, len(t.paths) - 1))
            places = [0, *[t.place(w) for w in windows[lo:hi]], len(t.paths)]
            for i, (start, end) in enumerate(zip(places, places[1:], strict=False), first + lo):
                if start < end:
                    columns = [pa.array([i], pa.int64()), pa.array([lang]), pa.array([t.between(start, end).to_bytes()], pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, names=["range", "lang", "blob"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[Transducer]] = {}
        for batch in batches:
            for lang, blob in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                held.setdefault(lang, []).append(Transducer.from_bytes(blob.as_buffer()))
                while sum(len(t.paths) for own in held.values() for t in own) > UNITED:
                    most = max(held, key=lambda x: sum(len(t.paths) for t in held[x]))
                    yield from rows(most, held.pop(most))
                    trim()
        for lang, own in held.items():
            yield from rows(lang, own)

    return written.select("lang", "blob").mapInArrow(released(run), "range bigint, lang string, blob binary")


def united(cut: DataFrame, ranges: int, least: int) -> DataFrame:
    """Rows (lang, size, phrase, f): sums of each range, size 0 being all words."""
    # not by a hash, which would put several times as many ranges into some tasks and none into others
    dealt = cut.repartitionById(math.ceil(ranges / TOGETHER), F.expr(f"CAST(range div {TOGETHER} AS INT)")).sortWithinPartitions("range", "lang")

    def rows(lang: str, t: Transducer) -> Iterator[pa.RecordBatch]:
        told = [(0, pa.array([b""], pa.binary()), [int(t.weights.sum())]), *[(d, *t.phrases(d, least)) for d in range(1, DEPTH + 1)]]
        for size, phrase, f in told:
            n = len(phrase)
            columns = [pa.array([lang] * n, pa.string()), pa.array([size] * n, pa.int32()), phrase.cast(pa.string()), pa.array(f, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "size", "phrase", "f"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, fresh = None, [], 0
        for batch in batches:
            for place, lang, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                if held and now != (place, lang):
                    yield from rows(now[1], union(held))
                    held, fresh = [], 0
                    trim()
                now = (place, lang)
                held.append(Transducer.from_bytes(blob.as_buffer()))
                fresh += len(held[-1].paths)
                if fresh > max(FRESH, len(held[0].paths)):
                    held, fresh = [union(held)], 0
        if held:
            yield from rows(now[1], union(held))

    return dealt.mapInArrow(released(run), "lang string, size int, phrase string, f bigint")


def phrase_counts(docs: DataFrame, least: int = 30, text_col: str = "text", lang_col: str = "lang", size: int = SHARD, window_range: int = RANGE, step: int = STEP) -> DataFrame:
    """Per language: size, phrase and f of all phrases of up to four words that occur ``least`` times, and of size 0 the number of words."""
    written = stored(shards(docs, text_col, lang_col, size, step), 1_000)
    at = splits(written, window_range, step)
    ranges = max(1, sum(len(w) + 1 for _, w in at.values()))
    parts = stored(united(cut_at(written, at), ranges, least), 4)
    sums = parts.groupBy("lang", "size", "phrase").agg(F.sum("f").alias("f"))
    return stored(sums.filter((F.col("f") >= least) | (F.col("size") == 0)))


def collocations(counts: DataFrame, least: int = 30, percent: int = 80, top: int = 2000, factor: int = 2_000_000) -> DataFrame:
    """The first ``top`` phrases of each language by score; ``counts`` are those of ``phrase_counts``."""
    known = counts.filter("size > 0").select("lang", "phrase", "f")
    words = F.split("phrase", " ")
    of = lambda a, n: F.array_join(F.slice("words", a, n), " ")
    candidates = counts.filter((F.col("size") >= 2) & (F.col("f") >= least)).select("lang", "size", "phrase", F.col("f").alias("a"), words.alias("words"))

    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.select("lang", "size", "phrase", "a", "k", of(F.lit(1), F.col("k")).alias("first"), of(F.col("k") + 1, F.col("size") - F.col("k")).alias("rest"))
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    score = F.expr(f"CAST({factor} AS DECIMAL(18,0)) * CAST(a AS DECIMAL(20,0)) div (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0)))")
    cuts = cuts.select("lang", "phrase", "size", "a", F.struct(score.alias("score"), "k", "l", "r").alias("cut"))
    scored = cuts.groupBy("lang", "phrase").agg(F.first("size").alias("size"), F.first("a").alias("a"), F.min("cut").alias("cut"))

    inner = candidates.filter("size > 2").withColumn("m", F.explode(F.sequence(F.lit(2), F.col("size") - 1)))
    inner = inner.withColumn("i", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("m") + 1)))
    around = inner.select("lang", of(F.col("i"), F.col("m")).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("around"))
    free = scored.join(around, ["lang", "phrase"], "left")
    covered = wide("around") * 100 >= wide("a") * percent
    free = free.filter(~F.coalesce(covered, F.lit(False))).select("lang", "phrase", "a", "cut.score", "cut.l", "cut.r")

    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = free.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    salted = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("rank") <= top)
    ranked = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")).filter(F.col("rank") <= top)
    total = counts.filter("size = 0").select("lang", F.col("f").alias("n"))
    return ranked.drop("salt").join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
