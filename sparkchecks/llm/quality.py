"""Quality rules whose limits come from the corpus: quantile sketches per language and source.

Only DataFrame functions. Each text is measured once. A sketch is a histogram with 32 buckets per
power of two (values below 64 have a bucket each), so a quantile is found within 1/32 of its
value; sketches merge by adding counts. They are merged from (language, source) to language to the
whole corpus, and a group with too few documents uses the next one. A limit is a high quantile of
the group, plus a multiple of the distance to a lower quantile, plus one bucket; no other constant takes part.
Which quantiles: junk makes up several percent of a corpus and must not set its own limit, so
symbols and word length build on q90 and its distance to the median (word length also on q10, below);
repetition is a matter of degree and has a long tail in good texts too, so it builds on q99 and its
distance to q95, and groups of fewer than ``TAIL_DOCS`` documents have no limit for it. Limits are joined back to the documents.

Defined cases: a NULL text has no words and fails the base rules; NULL languages and sources are
groups of their own; repeated rows count as often as they occur; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import row_count, small, stored

WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Documents that a group needs for limits of its own.
MIN_DOCS = 100
#: Lower and upper quantile of each measure in percent, and the multiple of their distance as a fraction.
REACH = {"symbols": (50, 90, 4, 1), "dup_lines": (95, 99, 1, 4), "repeats": (95, 99, 1, 4), "word_length": (50, 90, 4, 1)}
#: Documents that a group needs for limits that build on its q99: of fewer, q99 is one of the few largest values.
TAIL_DOCS = 300
LOW_TOO = ("word_length",)
QUANTILES = (10, 50, 90, 95, 99)


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", group_cols: tuple[str, str] = ("lang", "source"), carry: Sequence[Column] = ()) -> DataFrame:
    """Per document: id, lang, source, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words.

    ``carry`` are further columns to keep.
    """
    carried = docs.select(*carry).columns if carry else []
    lang, source = group_cols
    text = F.coalesce(F.col(text_col), F.lit(""))
    bare = F.btrim(text, F.lit(BLANKS))
    base = docs.select(
        *carry,
        F.col(id_col).alias("doc_id"),
        F.col(lang).alias("lang"),
        F.col(source).alias("source"),
        F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"[\x20\x09-\x0D]+")).alias("w"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    windows = F.transform(
        F.slice("w", 1, F.greatest(F.size("w") - 2, F.lit(0))),
        lambda x, i: F.xxhash64(x, F.get(F.col("w"), i + 1), F.get(F.col("w"), i + 2)),
    )
    base = base.select(
        *carried,
        "doc_id",
        "lang",
        "source",
        F.size("w").cast("bigint").alias("n_words"),
        F.length(F.array_join("w", "")).cast("bigint").alias("word_chars"),
        "n_symbols",
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        windows.alias("h"),
    )
    # Windows sorted by hash stand beside their equals; their places sorted again give the words they cover.
    order = F.sort_array(F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    twice = base.withColumn("o", F.when(F.size(F.array_distinct("h")) < F.size("h"), order))
    beside = F.zip_with("o", F.slice("o", 2, F.size("o")), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
    twice = twice.withColumn("p", F.array_sort(F.array_distinct(F.flatten(F.filter(beside, lambda x: x.isNotNull())))))
    covered = F.zip_with("p", F.slice("p", 2, F.size("p")), lambda a, b: F.coalesce(F.least(F.lit(3), b - a), F.lit(3)))
    total = F.coalesce(F.aggregate(covered, F.lit(0), lambda s, x: s + x), F.lit(0))
    return twice.select(
        *carried, "doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", total.cast("bigint").alias("n_repeat_words")
    )


def base_failed() -> Column:
    """Too few words, or mostly repeated ones."""
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def measures() -> dict[str, Column]:
    """The whole numbers that are compared with limits."""

    def ratio(a: str, b: str) -> Column:
        return F.when(F.col(b) > 0, F.expr(f"1000 * {a} div {b}")).otherwise(0).cast("bigint")

    return {
        "symbols": ratio("n_symbols", "word_chars"),
        "dup_lines": ratio("n_dup_lines", "n_lines"),
        "repeats": ratio("n_repeat_words", "n_words"),
        "word_length": ratio("word_chars", "n_words"),
    }


def bucket(value: Column) -> Column:
    """Bucket of a whole number from 0 on: itself below 64, then 32 buckets per power of two."""
    shift = F.greatest(F.length(F.bin(value)) - 6, F.lit(0))
    return shift * 64 + F.call_function("shiftright", value, shift).cast("int")


def bucket_value(b: Column) -> Column:
    """Largest value of a bucket."""
    return F.call_function("shiftleft", (b % 64 + 1).cast("bigint"), F.floor(b / 64).cast("int")) - 1


def sketches(m: DataFrame) -> DataFrame:
    """Histogram rows (level, lang, source, name, b, n) for sources, languages and the corpus."""
    values = F.array(*[F.struct(F.lit(k).alias("name"), bucket(v).alias("b")) for k, v in measures().items()])
    rows = m.filter(~base_failed()).select("lang", "source", F.explode(values).alias("x")).select("lang", "source", "x.name", "x.b")
    fine = stored(rows.groupBy("lang", "source", "name", "b").agg(F.count(F.lit(1)).alias("n")))
    none = F.lit(None).cast("string")
    by_lang = fine.groupBy("lang", "name", "b").agg(F.sum("n").alias("n")).withColumn("source", none)
    everything = fine.groupBy("name", "b").agg(F.sum("n").alias("n")).withColumn("source", none).withColumn("lang", none)
    levels = [x.withColumn("level", F.lit(i)) for i, x in enumerate((fine, by_lang, everything))]
    return reduce(DataFrame.unionByName, levels)


def limits(sketch: DataFrame) -> DataFrame:
    """One row per group: level, lang, source, docs, and lo_/hi_ of each measure."""
    key = ["level", "lang", "source", "name"]
    w = Window.partitionBy(*key)
    run = sketch.withColumn("cum", F.sum("n").over(w.orderBy("b"))).withColumn("all", F.sum("n").over(w))
    found = [F.min(F.when(100 * F.col("cum") >= q * F.col("all"), F.col("b"))).alias(f"b{q}") for q in QUANTILES]
    per = run.groupBy(*key).agg(*found, F.max("all").alias("docs"))
    per = per.select("*", *[bucket_value(F.col(f"b{q}")).alias(f"q{q}") for q in QUANTILES])
    out = []
    for name, (low, high, times, over) in REACH.items():
        above = bucket_value(F.col(f"b{high}") + 1) + F.expr(f"{times} * (q{high} - q{low}) div {over}")
        below = bucket_value(F.greatest(F.col(f"b{100 - high}") - 1, F.lit(0))) - F.expr(f"{times} * (q{low} - q{100 - high}) div {over}") if name in LOW_TOO else None
        enough = F.col("docs") >= (TAIL_DOCS if high > 95 else 0)
        out.append(F.max(F.when((F.col("name") == name) & enough, above)).alias(f"hi_{name}"))
        if below is not None:
            out.append(F.min(F.when(F.col("name") == name, below)).alias(f"lo_{name}"))
    return per.groupBy("level", "lang", "source").agg(F.max("docs").alias("docs"), *out)


def judge_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", group_cols: tuple[str, str] = ("lang", "source")) -> DataFrame:
    """Measures of every document with base_failed and kept."""
    return judged(stored(measured(docs, id_col, text_col, group_cols)))


def keep_good(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", group_cols: tuple[str, str] = ("lang", "source")) -> DataFrame:
    """The rows of kept documents, all columns. Rows are written once with their measures, not joined by id."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    m = stored(measured(docs, id_col, text_col, group_cols, [row]))
    return judged(m, ["row"]).filter("kept").select("row.*")


def judged(m: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
    """Verdicts for measured documents."""
    table = stored(limits(sketches(m)))
    names = [*[f"hi_{k}" for k in REACH], *[f"lo_{k}" for k in LOW_TOO]]
    by_source = table.filter(f"level = 0 AND docs >= {MIN_DOCS}").select(F.col("lang").alias("l0"), F.col("source").alias("s0"), F.struct(*names).alias("own"))
    by_lang = table.filter(f"level = 1 AND docs >= {MIN_DOCS}").select(F.col("lang").alias("l1"), F.struct(*names).alias("mid"))
    whole = table.filter("level = 2").select(F.struct(*names)).scalar()
    out = m.join(small(by_source, most=row_count(table)), F.col("lang").eqNullSafe(F.col("l0")) & F.col("source").eqNullSafe(F.col("s0")), "left")
    out = out.join(small(by_lang, most=row_count(table)), F.col("lang").eqNullSafe(F.col("l1")), "left")
    limit = F.coalesce("own", "mid", whole)
    fine = ~base_failed()
    for k, v in measures().items():
        fine = fine & F.coalesce(v <= limit[f"hi_{k}"], F.lit(True))
        if k in LOW_TOO:
            fine = fine & F.coalesce(v >= limit[f"lo_{k}"], F.lit(True))
    cols = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return out.select(*carried, *cols, base_failed().alias("base_failed"), fine.alias("kept"), "n_lines", "lang", "source")
