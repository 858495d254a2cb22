"""Language identification with a string kernel.

The kernel of two texts is the number of n-grams (n = 1 to 3, a blended spectrum) present in both,
divided by the root of the product of their own numbers. It is approximated from landmarks
(Nystroem: ``K(x, L) (K(L, L) + ridge)^(-1/2)``), and kernel ridge regression is solved on these
features, one language against the rest. Since the kernel is a product of presence vectors, the
landmarks, the Nystroem matrix and the regression fold into one matrix (n-grams x languages) per
model; a document is scored by the sum of the rows of its n-grams. N-grams consist of code points
in lower case (letters and marks of all scripts), so none are taken for each other.

Fitting uses at most ``PER_LANGUAGE`` texts per language and ``MAX_SAMPLE`` in all, chosen by a
hash of the id from the rows it is given; scoring reads every whole text. Only the n-grams and
languages of the sample (bounded by these two numbers) pass through the driver.

Defined cases: a NULL text, or one without a letter, is ``und`` with score 0; without any labelled
text every document is ``und``; rows without id take no part in fitting; repeated rows are scored
alike; languages are whatever non-NULL labels the sample has.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from typing import NamedTuple
from unicodedata import category

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

PER_LANGUAGE = 400
MAX_SAMPLE = 4000
SLICES = 16
LANDMARKS = 256
RIDGE = 1e-2
#: Characters of a text that are turned into n-grams at a time.
CHUNK = 1 << 18
#: The class of a letter or mark is the code point of its lower case; 0 is everything else.
CLASSES = 0x110000
UNDETERMINED = "und"
SIZES = (CLASSES, CLASSES**2, CLASSES**3)
#: N-grams of the landmarks that are multiplied at a time.
BLOCK = 1 << 14


@cache
def _classes() -> np.ndarray:
    table = np.zeros(CLASSES, np.int32)
    for code in range(CLASSES):
        char = chr(code)
        if char.isalpha() or category(char)[0] == "M":
            table[code] = ord(char.lower()[0])
    return table


def present(text: str, table: np.ndarray) -> np.ndarray:
    """Codes of the n-grams present in a text, sorted. A run of other characters counts as one."""
    found = []
    tail = np.zeros(1, np.int64)
    for at in range(0, len(text), CHUNK):
        codes = np.frombuffer(text[at : at + CHUNK].encode("utf-32-le", "surrogatepass"), np.uint32)
        c = np.concatenate([tail, table[codes]])
        keep = np.empty(len(c), bool)
        keep[0] = True
        keep[1:] = (c[1:] != 0) | (c[:-1] != 0)
        c = c[keep]
        two = c[:-1] * CLASSES + c[1:]
        found.append(np.unique(np.concatenate([c, SIZES[0] + two, SIZES[0] + SIZES[1] + two[:-1] * CLASSES + c[2:]])))
        tail = c[-2:]
    if tail[-1]:
        found.append(SIZES[0] + tail[-1:] * CLASSES)
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)


class Model(NamedTuple):
    """``weights`` has a row for each n-gram of ``columns`` (sorted codes) and a last one, of zeros, for others."""

    languages: list[str]
    columns: np.ndarray
    weights: np.ndarray


def fit(labels: list[str], grams: list[np.ndarray]) -> Model | None:
    """Kernel ridge regression on Nystroem features of presence vectors."""
    languages = sorted(set(labels))
    if not languages:
        return None
    rng = np.random.default_rng(7)
    marks: list[int] = []
    each = max(1, LANDMARKS // len(languages))
    for lang in languages:
        own = [i for i, x in enumerate(labels) if x == lang]
        marks += list(rng.permutation(own)[:each])
    used = np.unique(np.concatenate([grams[i] for i in marks]))
    places = [_places(g, used) for g in grams]
    places = [x[x < len(used)] for x in places]

    def presence(rows: list[int], start: int) -> np.ndarray:
        out = np.zeros((len(rows), min(BLOCK, len(used) - start)), np.float32)
        for k, i in enumerate(rows):
            own = places[i][slice(*np.searchsorted(places[i], [start, start + BLOCK]))]
            out[k, own - start] = 1 / np.sqrt(max(len(grams[i]), 1))
        return out

    # By blocks of n-grams: some scripts have very many.
    kernel = np.zeros((len(grams), len(marks)))
    for start in range(0, len(used), BLOCK):
        land = presence(marks, start)
        for i in range(0, len(grams), 200):
            rows = list(range(i, min(i + 200, len(grams))))
            kernel[rows] += presence(rows, start) @ land.T
    inner = kernel[marks]
    values, vectors = np.linalg.eigh(inner + 1e-6 * np.eye(len(marks)))
    root = vectors / np.sqrt(np.maximum(values, 1e-6)) @ vectors.T
    features = kernel @ root
    target = np.array([[float(x == lang) for lang in languages] for x in labels])
    # Every language weighs the same, however many texts it has.
    weight = 1 / np.maximum(target.sum(axis=0), 1)
    w = (target * weight).sum(axis=1)[:, None]
    solved = np.linalg.solve(features.T @ (w * features) + RIDGE / len(labels) * np.eye(features.shape[1]), features.T @ (w * target))
    weights = np.zeros((len(used) + 1, len(languages)), np.float32)
    for start in range(0, len(used), BLOCK):
        weights[start : min(start + BLOCK, len(used))] = presence(marks, start).T @ (root @ solved)
    return Model(languages, used, weights)


def _places(g: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Places of n-grams in sorted codes; their number for those that are not among them."""
    if not len(columns):
        return np.zeros(len(g), np.int64)
    at = np.minimum(np.searchsorted(columns, g), len(columns) - 1)
    return np.where(columns[at] == g, at, len(columns))


def _with_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def training_rows(docs: DataFrame, id_col: str, lang_col: str, allowed: Column) -> DataFrame:
    """At most ``PER_LANGUAGE`` ids of each language and ``MAX_SAMPLE`` in all: doc_id, lang."""
    h = F.xxhash64(F.col(id_col), F.lit(1))
    rows = docs.filter(allowed & F.col(id_col).isNotNull() & F.col(lang_col).isNotNull())
    rows = rows.select(F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"), h.alias("h"))
    # A language may hold most rows: it is thinned out in slices first, then as a whole.
    for key in (["lang", F.pmod("h", F.lit(SLICES))], ["lang"]):
        order = Window.partitionBy(*key).orderBy("h", "doc_id")
        rows = rows.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= PER_LANGUAGE)
    return rows.orderBy("r", "h", "doc_id", "lang").limit(MAX_SAMPLE).select("doc_id", "lang")


def learn(docs: DataFrame, allowed: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model | None:
    """Fit a model on a bounded sample of the labelled rows that ``allowed`` selects."""
    chosen = training_rows(docs, id_col, lang_col, allowed).collect()
    ids = sorted({r.doc_id for r in chosen})
    base = docs.filter(allowed & F.col(id_col).isin(ids) & F.col(lang_col).isNotNull())
    base = base.select(F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _classes()
        for batch in batches:
            texts = batch.column(2).to_pylist()
            grams = [present(t, table).tobytes() if _with_letter(t) else None for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(grams, pa.binary())], names=["doc_id", "lang", "g"])

    kind = base.schema["doc_id"].dataType.simpleString()
    rows = base.mapInArrow(run, f"doc_id {kind}, lang string, g binary").filter("g IS NOT NULL")
    # One row for each id and language: repeated rows can't swell the sample.
    rows = sorted(rows.groupBy("doc_id", "lang").agg(F.min("g").alias("g")).collect(), key=lambda r: (r.doc_id, r.lang))
    return fit([r.lang for r in rows], [np.frombuffer(r.g, np.int64) for r in rows])


def predict(docs: DataFrame, model: Model | None, keep: list[str], text_col: str = "text", within: str | None = None) -> DataFrame:
    """The columns ``keep`` with lang_pred and score.

    ``within`` names the struct among them that holds the text, which is then sent to Python once.
    """
    base = docs.select(*keep) if within else docs.select(F.col(text_col).alias("__text"), *keep)
    held = docs.sparkSession.sparkContext.broadcast(model)
    schema = StructType([*(base.schema.fields if within else base.schema.fields[1:]), StructField("lang_pred", StringType()), StructField("score", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, table = held.value, _classes()
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                column = part.column(keep.index(within)).field(text_col) if within else part.column(0)
                names, scores = score([t if _with_letter(t) else None for t in column.to_pylist()], model, table)
                yield pa.RecordBatch.from_arrays(
                    [*(part.columns if within else part.columns[1:]), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=[*keep, "lang_pred", "score"]
                )

    return base.mapInArrow(run, schema)


def score(texts: list[str | None], model: Model | None, table: np.ndarray) -> tuple[list[str], list[float]]:
    """Best language and its regression value, between 0 and 1, of each text."""
    if model is None:
        return [UNDETERMINED] * len(texts), [0.0] * len(texts)
    values = np.zeros((len(texts), len(model.languages)))
    for i, text in enumerate(texts):
        if text is not None:
            g = present(text, table)
            values[i] = model.weights[_places(g, model.columns)].sum(axis=0, dtype=np.float64) / np.sqrt(max(len(g), 1))
    best = values.argmax(axis=1)
    top = np.clip(values[np.arange(len(texts)), best], 0, 1).astype(float)
    names = [UNDETERMINED if t is None else model.languages[b] for t, b in zip(texts, best, strict=True)]
    return names, [0.0 if t is None else float(s) for t, s in zip(texts, top, strict=True)]


def remainder(id_col: str) -> Column:
    """crc32 of the id as text, modulo 3: 1 marks the documents that are held out."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 3


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score; learns from the rows not held out."""
    held_out = F.coalesce(remainder(id_col) == 1, F.lit(False))
    model = learn(docs, ~held_out, id_col, text_col, lang_col)
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return predict(base, model, ["doc_id"]).select("doc_id", F.coalesce(remainder("doc_id") == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")
