"""Spelling variants: near words by a dictionary of pairs of trie nodes, and the form that each belongs to.

1. Words are sorted, and the nodes of their trie are numbered along the order: a word takes the
   nodes of the prefix that it shares with its predecessor and numbers the others anew. Ranges of
   the order are numbered by different tasks; the nodes of words that meet at a border of two ranges
   get their numbers on the driver (two words a range). The same is done with the reversed words.
   So a prefix and a suffix are one integer each, whatever their length.
2. A word stands in the dictionary under (prefix node, suffix node) for each position: *cut* there,
   and with the character there left out (*gap*). Two words that share a gap pair differ by one
   replaced character; a cut pair that equals a gap pair is a word without that character. Both are
   exact, so nothing is left to be verified.
3. Words under one pair are ordered by frequency in a window, which gives each of them the number of
   the others and the best of them. A pair has no more words than there are characters, as they
   differ in that place only; no pairs of words are listed. A run of one letter counts a deletion
   at its first place only, so every near word is counted once.
4. A word's form is its most frequent near word (ties: the smallest in code-point order) if that is
   at least ``RATIO`` times as frequent. Roots follow the forms by pointer doubling.

Defined cases: rows without a word are ignored; repeated words are added up; the empty word is a
word; words of any length take one number per character; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import stored

#: How many times as frequent as a word its form must be.
RATIO = 2
#: Nodes and words of a range are numbered from its place times this.
SPAN = 1 << 40


def common(a: str, b: str) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return next(i for i in range(n) if a[i] != b[i])


class Range:
    """The border nodes of one range of sorted words: those of its first and of its last word that other ranges share."""

    def __init__(self, first: str, last: str) -> None:
        self.first, self.last = first, last
        self.left: list[int] = []
        self.right: list[int] = []


def borders(ranges: list[tuple[int, str, str]]) -> dict[int, Range]:
    """Ranges (place, first word, last word) in order, with negative numbers for the nodes that lie on both sides of a border."""
    out = {place: Range(first, last) for place, first, last in ranges}
    before, used = None, 0
    for here in out.values():
        if before is not None:
            shared = common(before.last, here.first) + 1
            # Prefixes of the last word that are shared with still earlier ranges have their numbers.
            known = before.left[: min(shared, common(before.first, before.last) + 1)]
            ids = [*known, *range(-used - 1, -used - 1 - (shared - len(known)), -1)]
            used += shared - len(known)
            before.right = here.left = ids
        before = here
    return out


def numbered(words: DataFrame) -> DataFrame:
    """Rows (key) in sorted order as (key, place, nodes, fresh).

    ``place`` grows with the order; ``nodes`` holds a number for each prefix from the empty one to
    the key; ``fresh`` says whether a character differs from the one before it.
    """
    ordered = stored(words.select("key").orderBy("key").withColumn("range", F.spark_partition_id()))
    ends = ordered.groupBy("range").agg(F.min("key"), F.max("key")).orderBy("range").collect()
    ranges = words.sparkSession.sparkContext.broadcast(borders([tuple(r) for r in ends]))
    dealt = ordered.repartition(max(1, len(ends)), "range").sortWithinPartitions("range", "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, here, before, nodes, used, row = None, None, "", [], 0, 0
        for batch in batches:
            out: tuple[list, list, list, list] = ([], [], [], [])
            for key, place in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if place != now:
                    now, here, before, nodes, used, row = place, ranges.value[place], "", [], 0, 0
                nodes = nodes[: common(before, key) + 1]
                if len(nodes) <= len(key):
                    left = common(key, here.first) + 1 if here.left else 0
                    right = common(key, here.last) + 1 if here.right else 0
                    for border, n in ((here.left, left), (here.right, right)):
                        nodes += border[len(nodes) : n]
                    more = len(key) + 1 - len(nodes)
                    nodes += range(place * SPAN + used, place * SPAN + used + more)
                    used += more
                out[0].append(key)
                out[1].append(place * SPAN + row)
                out[2].append(nodes)
                out[3].append([i == 0 or key[i] != key[i - 1] for i in range(len(key))])
                before, row = key, row + 1
            kinds = (pa.string(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, kinds, strict=True)], names=["key", "place", "nodes", "fresh"])

    return dealt.mapInArrow(run, "key string, place bigint, nodes array<bigint>, fresh array<boolean>")


def pairs(words: DataFrame) -> DataFrame:
    """The dictionary of words (word, id, n, p, s, fresh): rows (p, s, kind, id, n); kind 0 is a cut, 1 a gap, 2 a gap within a run."""

    def entries(upto: Column, entry) -> Column:
        return F.when(upto >= 0, F.transform(F.sequence(F.lit(0), upto), entry)).otherwise(F.expr("array()"))

    size = F.size("p") - 1
    cut = entries(size, lambda i: F.struct(F.get("p", i).alias("p"), F.get("s", i).alias("s"), F.lit(0).alias("kind")))
    gap = entries(size - 1, lambda i: F.struct(F.get("p", i).alias("p"), F.get("s", i + 1).alias("s"), F.when(F.get("fresh", i), 1).otherwise(2).alias("kind")))
    return words.select("id", "n", F.explode(F.concat(cut, gap)).alias("e")).select("e.*", "id", "n")


def near_words(entries: DataFrame) -> DataFrame:
    """Per word with near words: id, n_near and best (n, minus id)."""
    group = Window.partitionBy("p", "s")
    first = group.orderBy(F.col("kind") == 0, F.desc("n"), "id").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    own = F.struct("n", (-F.col("id")).alias("less"))
    of = lambda kinds: F.max(F.when(kinds, own)).over(group)
    seen = entries.select(
        "kind",
        "id",
        F.count_if(F.col("kind") > 0).over(group).alias("gaps"),
        F.count_if(F.col("kind") == 1).over(group).alias("longer"),
        of(F.col("kind") == 0).alias("cut"),
        of(F.col("kind") == 1).alias("best_longer"),
        F.nth_value(own, 1).over(first).alias("one"),
        F.nth_value(F.when(F.col("kind") > 0, own), 2).over(first).alias("two"),
    )
    shorter = (F.col("kind") == 1) & F.col("cut").isNotNull()
    count = F.when(F.col("kind") == 0, F.col("longer")).otherwise(F.col("gaps") - 1 + shorter.cast("bigint"))
    other = F.when(F.col("one.less") == -F.col("id"), F.col("two")).otherwise(F.col("one"))
    best = F.when(F.col("kind") == 0, F.col("best_longer")).otherwise(F.greatest(other, F.when(shorter, F.col("cut"))))
    return seen.select("id", count.alias("k"), best.alias("best")).filter("k > 0").groupBy("id").agg(F.sum("k").alias("n_near"), F.max("best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """Rows (id, form) as (id, root): the end of each chain of forms, by pointer doubling."""
    state = stored(forms.select("id", F.col("form").alias("root")))
    while True:
        ahead = state.select(F.col("id").alias("root"), F.col("root").alias("beyond"))
        moved = stored(state.join(ahead, "root", "left").select("id", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")))
        if moved.filter("moved").isEmpty():
            return state
        state = moved.drop("moved")


def variant_groups(counts: DataFrame, ratio: int = RATIO) -> DataFrame:
    """Of rows (word, n): word, n, n_near, form, form_n, root."""
    words = stored(counts.filter("word IS NOT NULL").groupBy("word").agg(F.sum("n").cast("bigint").alias("n")))
    forward = numbered(words.select(F.col("word").alias("key"))).select(F.col("key").alias("word"), F.col("place").alias("id"), F.col("nodes").alias("p"), "fresh")
    backward = numbered(words.select(F.reverse("word").alias("key"))).select(F.reverse("key").alias("word"), F.reverse("nodes").alias("s"))
    known = stored(words.join(forward, "word").join(backward, "word"))
    near = near_words(pairs(known))
    form = F.when(F.col("best.n") >= ratio * F.col("n"), -F.col("best.less"))
    judged = stored(known.select("word", "id", "n").join(near, "id", "left").withColumn("form_id", form))
    ends = roots(judged.filter("form_id IS NOT NULL").select("id", F.col("form_id").alias("form")))
    names = judged.select(F.col("id").alias("form_id"), F.col("word").alias("form"))
    out = judged.join(ends, "id", "left").join(names, "form_id", "left")
    out = out.join(names.select(F.col("form_id").alias("root"), F.col("form").alias("root_word")), "root", "left")
    return out.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        "form",
        F.when(F.col("form_id").isNotNull(), F.col("best.n")).alias("form_n"),
        F.coalesce("root_word", "word").alias("root"),
    )


def letter_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 5, every: int = 97) -> DataFrame:
    """Words of a corpus and their counts: runs of Latin letters in lower case, of at least ``least`` letters.

    A run loses one letter where ``every`` divides the CRC of its document and itself, as if it
    were misspelt there. NULL texts have no runs; a NULL id is written as nothing.
    """
    runs = docs.select(F.col(id_col).cast("string").alias("i"), F.explode(F.regexp_extract_all(F.col(text_col), F.lit("[A-Za-zÀ-ÿ]+"), 0)).alias("w"))
    runs = runs.filter(F.length("w") >= least)
    lower = F.translate("w", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").alias("w")
    runs = runs.select("i", lower).withColumn("h", F.crc32(F.concat(F.coalesce("i", F.lit("")), F.lit(":"), F.col("w")).cast("binary")))
    at = (F.col("h") % F.length("w")).cast("int")
    word = F.when(F.col("h") % every == 0, F.concat(F.substring("w", F.lit(1), at), F.substring("w", at + 2, F.length("w")))).otherwise(F.col("w"))
    return runs.select(word.alias("word")).filter(F.length("word") >= least).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
