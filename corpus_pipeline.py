"""Documents to packed training sequences: stages that are each written and read by the next.

Every stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and returns a
DataFrame; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkchecks.llm.langid import UNDETERMINED, learn, predict, remainder
from sparkchecks.llm.mixing import mix
from sparkchecks.llm.neardup import one_of_each
from sparkchecks.llm.packing import pack_documents, word_count
from sparkchecks.llm.quality import keep_good
from sparkchecks.llm.storage import stored

#: Regression value below which no language fits a text.
MIN_LANGUAGE_SCORE = 0.1
#: Near duplicates: words of a shingle, and similarity in percent.
SHINGLE, SIMILAR = 5, 80


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a determined language; fill in missing language labels.

    The model learns from the labelled documents that are not held out.
    """
    model = learn(docs, F.coalesce(remainder("doc_id") != 1, F.lit(True)))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    judged = predict(docs.select(row), model, ["row"], within="row")
    kept = judged.filter((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= MIN_LANGUAGE_SCORE))
    lang = F.coalesce("row.lang", "lang_pred").alias("lang")
    return kept.select(*[lang if c == "lang" else F.col(f"row.`{c}`") for c in docs.columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the base rules or the adaptive limits of their group reject."""
    return keep_good(docs)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each group of near duplicates.

    Rows without id or words all stay; of rows that repeat an id and its text one stays.
    """
    return one_of_each(docs, SHINGLE, SIMILAR)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix by source weights: a row per copy that it takes, in the order of its shards."""
    return mix(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequence, its length and their place in it."""
    return pack_documents(docs, word_count(F.col("text")))


STAGES = [
    ("language ID", language_id),
    ("quality rules", quality_rules),
    ("MinHash near-dedup", minhash_near_dedup),
    ("mixing sources", mixing_sources),
    ("best-fit packing", best_fit_packing),
]
#: The draws of the mix can't be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what each but the last returns is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
