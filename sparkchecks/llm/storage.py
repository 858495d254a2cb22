"""Intermediate tables that outlive lost executors, and joins with sides of a known size."""

from __future__ import annotations

import ctypes
import gc
import os
import re
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager, suppress

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: A side of at most this many narrow rows (two or three longs) may be broadcast: some 20 MB.
BROADCAST_ROWS = 200_000
#: Ids that a row of two longs tells, a bit each.
PACKED = 128


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where Spark runs locally without one, a folder of the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not re.match(r"local($|\[)", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return os.path.join(spark.conf.get("spark.sql.warehouse.dir"), "intermediate")


def trim() -> None:
    """Give freed memory back to the system: workers are used again, and libraries keep what they once had."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # only where the C library has it
        ctypes.CDLL(None).malloc_trim(0)


def released(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The function of a task, which gives memory back at its end."""

    def wrapped(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            trim()

    return wrapped


@contextmanager
def batches_of(spark: SparkSession, rows: int | None) -> Iterator[None]:
    """Within it, jobs hand Python workers at most so many rows at a time."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    if rows:
        spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def stored(df: DataFrame, batch: int | None = None, **measures: Column) -> DataFrame:
    """Write once to the shared folder and read back: cuts the lineage, survives lost executors.

    ``batch`` bounds the rows that a Python worker gets at a time, where rows are wide. Rows are counted
    as they are written, together with further aggregates; see ``row_count`` and ``measure``. A job for
    each count would add a plan, its exchanges and the threads that the driver starts for them.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"
    seen = Observation()
    aggregates = {"rows": F.count(F.lit(1))} | measures
    with batches_of(spark, batch):
        df.observe(seen, *[v.alias(k) for k, v in aggregates.items()]).write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._seen = seen.get
    return out


def measure(df: DataFrame, name: str) -> object:
    """An aggregate that ``stored`` took of this very frame."""
    return df._seen[name]


def row_count(df: DataFrame) -> int:
    """Rows of a frame, without a job if it is one that ``stored`` returned."""
    return vars(df)["_seen"]["rows"] if "_seen" in vars(df) else df.count()


def small(df: DataFrame, rows: int | None = None, most: int | None = None) -> DataFrame:
    """Broadcast a narrow side if its rows are within the limit, else leave it to Spark.

    ``rows`` is their number where it is known, ``most`` a bound; rows are counted only if the bound is beyond the limit.
    """
    if rows is None:
        rows = most if most is not None and most <= BROADCAST_ROWS else row_count(df)
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def small_once(df: DataFrame, most: int) -> DataFrame:
    """``small`` for a side that is costly to compute and used once: stored to be counted only if ``most`` rows are beyond the limit."""
    return F.broadcast(df) if most <= BROADCAST_ROWS else small(stored(df))


def _bit(place: Column) -> Column:
    """The bit of a place in its long."""
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), place.bitwiseAND(F.lit(63)).cast("int"))


def _packed(places: DataFrame) -> DataFrame:
    """Rows (p) as rows (word, low, high), with the bit set of each p; p may repeat."""
    p = F.col("p")
    rows = places.select(F.shiftright(p, 7).alias("word"), (p.bitwiseAND(F.lit(64)) == 0).alias("lower"), _bit(p).alias("bit"))
    low, high = (F.coalesce(F.bit_or(F.when(one, F.col("bit"))), F.lit(0)) for one in (F.col("lower"), ~F.col("lower")))
    return stored(rows.groupBy("word").agg(low.alias("low"), high.alias("high")))


def _told(df: DataFrame, place: Column, packed: DataFrame, keep: bool) -> DataFrame:
    """Rows whose place has its bit set, or those whose place has not."""
    rows = df.withColumn("__p", place).withColumn("__word", F.shiftright("__p", 7))
    bits = small(packed).select(F.col("word").alias("__word"), F.col("low").alias("__low"), F.col("high").alias("__high"))
    rows = rows.join(bits, "__word", "left")
    own = F.when(F.col("__p").bitwiseAND(F.lit(64)) == 0, F.col("__low")).otherwise(F.col("__high"))
    there = F.coalesce(own.bitwiseAND(_bit(F.col("__p"))) != 0, F.lit(False))
    return rows.filter(there if keep else ~there).select(*[F.col(f"`{c}`") for c in df.columns])


def among(df: DataFrame, ids: DataFrame, name: str, keep: bool = True) -> DataFrame:
    """Rows of a wide frame whose ``name`` (bigint) is in the only column of ids, or those whose is not.

    Beyond the limit ids are packed as bits, so wide rows need no shuffle before there are some
    ``PACKED`` times as many ids as may be broadcast, if ids are dense.
    """
    if row_count(ids) <= BROADCAST_ROWS:
        kept = df.join(F.broadcast(ids), name, "left_semi" if keep else "left_anti")
        return kept.select(*[F.col(f"`{c}`") for c in df.columns])
    return _told(df, F.col(name), _packed(ids.select(F.col(name).alias("p"))), keep)


def likely(df: DataFrame, wanted: DataFrame, names: list[str]) -> DataFrame:
    """Rows of a wide frame whose ``names`` may be those of a row of wanted: all that are, and some that are not.

    For a join that follows: where wanted can't be broadcast, it would shuffle the whole frame. The
    hash of the names chooses one of some 25 million bits.
    """
    if row_count(wanted) <= BROADCAST_ROWS:
        return df
    place = F.pmod(F.xxhash64(*names), F.lit(PACKED * BROADCAST_ROWS))
    return _told(df, place, _packed(wanted.select(place.alias("p"))), True)
