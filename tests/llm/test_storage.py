"""Intermediate tables know their rows, so that no jobs count them."""

import uuid

import pytest
from pyspark.sql import functions as F

from sparkchecks.llm import storage
from sparkchecks.llm.components import components
from sparkchecks.llm.neardup import one_of_each
from sparkchecks.llm.storage import among, likely, measure, row_count, small, small_once, stored


#: Before rows were counted as they are written: 120 and 24 jobs.
JOBS, COMPONENT_JOBS = 90, 20


def jobs_of(spark, run):
    """What run returns, and the number of jobs that it starts."""
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, group)
    try:
        return run(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("rows", [0, 1, 1000])
def test_rows_are_counted_as_they_are_written(spark, rows):
    frame = spark.range(1000).filter(F.col("id") < rows).withColumn("k", F.col("id") % 7)
    for one in (frame, frame.groupBy("k").count(), frame.join(frame.select("k").distinct(), "k")):
        table = stored(one, most=F.max("k"))
        side, jobs = jobs_of(spark, lambda t=table: small(t))
        assert not jobs
        assert row_count(table) == table.count() == side.count()
        assert measure(table, "most") == table.agg(F.max("k")).first()[0]
        assert row_count(table.limit(1)) == min(1, rows)


@pytest.mark.parametrize("limit", [3, 100])
def test_sides_beyond_the_limit_are_not_broadcast(spark, monkeypatch, limit):
    monkeypatch.setattr(storage, "BROADCAST_ROWS", limit)
    table = stored(spark.range(10))
    plans = [str(x._jdf.queryExecution().logical()) for x in (small(table), small(table.filter("id < 9"), most=10), small_once(table.filter("id < 9"), 10))]
    assert ["broadcast" in p for p in plans] == [limit == 100] * 3


@pytest.mark.parametrize("limit", [2, 12, 100])
def test_rows_among_ids(spark, no_broadcast, monkeypatch, limit):
    """Ids that are broadcast, packed as bits, and too many for that: the same rows, and wide rows move in the last case only."""
    monkeypatch.setattr(storage, "BROADCAST_ROWS", limit)
    top = 5 << 33
    places = [0, 1, 63, 64, 65, 127, 128, 190, 191, 192, 255, 256, -1, -64, -65, -128, -129, top, top + 63, top + 64, top + 127, (1 << 63) - 1, -(1 << 63), None]
    wide = spark.createDataFrame([(i, p, "x" * 9) for i, p in enumerate(places)], "i int, r bigint, wide string")
    wanted = [*places[::2], 62, 129, top + 1]
    ids = stored(spark.createDataFrame([(p,) for p in wanted], "r bigint"))
    there = [p is not None and p in wanted for p in places]
    for keep in (True, False):
        got = among(wide, ids, "r", keep)
        assert got.columns == wide.columns
        assert sorted(r.i for r in got.collect()) == [i for i, x in enumerate(there) if x == keep]
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert ("Exchange hashpartitioning" in plan) == (limit == 2)
    found = {r.i for r in likely(wide, ids, ["r"]).collect()}
    assert found >= {i for i, x in enumerate(there) if x}


def test_near_dedup_starts_few_jobs(spark):
    words = [f"w{i}" for i in range(60)]
    texts = [(i, " ".join(words[:59] + [f"x{i}"])) for i in range(4)] + [(10 + i, f"{i} ".join(words)) for i in range(4)]
    docs = stored(spark.createDataFrame(texts, "doc_id bigint, text string"))
    kept, jobs = jobs_of(spark, lambda: sorted(r.doc_id for r in one_of_each(docs).collect()))
    assert kept == [0, 10, 11, 12, 13]
    assert jobs <= JOBS


def test_components_start_few_jobs(spark):
    links = stored(spark.createDataFrame([(1, 2), (3, 2), (7, 8)], "a bigint, b bigint"))
    found, jobs = jobs_of(spark, lambda: components(links))
    assert sorted(map(tuple, found.collect())) == [(1, 1), (2, 1), (3, 1), (7, 7), (8, 7)]
    assert jobs <= COMPONENT_JOBS
