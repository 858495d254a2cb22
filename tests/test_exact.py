"""Exact sums against math.fsum, whatever the order, the partitions and the grouping."""

import math
import random
import struct
from decimal import Decimal
from fractions import Fraction

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sparkchecks.functions.exact import exact_sums, partial_sums, whole_sums

INF, NAN = float("inf"), float("nan")


def bits(x):
    return None if x is None else "nan" if math.isnan(x) else struct.pack(">d", x + 0.0)


def wanted(values):
    known = [v for v in values if v is not None]
    if not known:
        return None
    if any(map(math.isnan, known)) or INF in known and -INF in known:
        return NAN
    if INF in known or -INF in known:
        return INF if INF in known else -INF
    return nearest(sum(map(Fraction, known)))


def nearest(exact):
    try:
        return float(exact)
    except OverflowError:
        return INF if exact > 0 else -INF


def found(spark, groups, partitions=3):
    rows = [(k, v) for k, values in groups.items() for v in values]
    random.Random(partitions).shuffle(rows)
    df = spark.createDataFrame(rows, "k int, x double").repartition(partitions)
    return {r.k: r.x for r in exact_sums(df, ["k"], {"x": F.col("x")}).collect()}


def made(rng):
    kind = rng.randrange(5)
    if kind == 0:
        return rng.uniform(-1, 1) * 10.0 ** rng.randint(-300, 300)
    if kind == 1:
        return rng.choice([-1, 1]) * math.ldexp(rng.randrange(1, 1 << 53), rng.randint(-1074, 971))
    if kind == 2:
        return rng.choice([5e-324, -5e-324, 2.2250738585072014e-308, 1.7976931348623157e308 / 64, 0.0, -0.0, 1.0, 2.0**52, -(2.0**-1022)])
    if kind == 3:
        return round(rng.uniform(0, 1e6), 2)
    return math.nextafter(2.0 ** rng.randint(-1000, 1000), rng.choice([0.0, INF]))


@pytest.mark.parametrize("partitions", [1, 3, 8])
def test_any_range_in_any_order(spark, partitions):
    rng = random.Random(7)
    groups = {k: [made(rng) for _ in range(rng.randint(1, 60))] for k in range(150)}
    groups |= {200: [1e300, 1.0, -1e300], 201: [1e16, 1.0, 1.0, -1e16], 202: [0.1] * 1000, 203: [5e-324] * 3, 204: [1.7e308] * 3, 205: [-1.7e308, -1.7e308, 1e308]}
    groups |= {206: [2.0**60, 2.0**7, 2.0**-300], 207: [2.0**60, 2.0**7], 208: [-(2.0**60), -(2.0**7), -5e-324], 209: [1.0, -1.0, 5e-324, -5e-324]}
    got = found(spark, groups, partitions)
    assert {k: bits(v) for k, v in got.items()} == {k: bits(wanted(v)) for k, v in groups.items()}


def test_values_that_are_no_numbers(spark):
    groups = {1: [INF, 1.0], 2: [-INF, 1.0], 3: [INF, -INF], 4: [NAN, INF], 5: [None, None], 6: [None, 2.5], 7: [0.0, -0.0], 8: [NAN]}
    assert {k: bits(v) for k, v in found(spark, groups).items()} == {k: bits(wanted(v)) for k, v in groups.items()}
    empty = spark.createDataFrame([], "k int, x double")
    assert exact_sums(empty, ["k"], {"x": F.col("x")}).collect() == []
    assert exact_sums(empty, [], {"x": F.col("x")}).first().x is None


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.floats(allow_nan=False, allow_infinity=False, width=64), min_size=1, max_size=12), min_size=30, max_size=60))
def test_any_floats(spark, lists):
    groups = dict(enumerate(lists))
    assert {k: bits(v) for k, v in found(spark, groups).items()} == {k: bits(wanted(v)) for k, v in groups.items()}


def test_weights_counts_conditions_and_further_grouping(spark):
    rng = random.Random(2)
    rows = [(i % 7, i % 3, made(rng), rng.randint(-5, 5), rng.choice([None, 1, 2**60]), f"{rng.uniform(-1, 1)!r}" if i % 5 else "x") for i in range(2000)]
    df = spark.createDataFrame(rows, "k int, m int, x double, w int, n bigint, t string").withColumn("d", F.col("n").cast("decimal(30,4)"))
    values = {"x": F.col("x"), "y": F.when(F.col("m") == 1, F.col("x")), "n": F.col("n"), "d": F.col("d"), "t": F.col("t")}
    fine = partial_sums(df, ["k", "m"], values, F.col("w"), {"rows": F.count(F.lit(1))})
    again = partial_sums(fine, ["m"], {c: F.col(c) for c in values}, F.lit(3), {"rows": F.sum("rows")})
    got = {r.m: r for r in whole_sums(again, ["m"], list(values), ["rows"]).collect()}

    def number(t):
        try:
            return float(t)
        except ValueError:
            return None

    for m in range(3):
        own = [r for r in rows if r[1] == m]
        exact = sum((Fraction(r[2]) * r[3] * 3 for r in own), Fraction(0))
        assert bits(got[m].x) == bits(nearest(exact))
        assert bits(got[m].y) == bits(nearest(exact) if m == 1 else None)
        whole = [r[4] * r[3] * 3 for r in own if r[4] is not None]
        assert got[m].n == sum(whole) and got[m].d == Decimal(sum(whole))
        texts = sum((Fraction(number(r[5])) * r[3] * 3 for r in own if number(r[5]) is not None), Fraction(0))
        assert bits(got[m].t) == bits(float(texts))
        assert got[m].rows == len(own)


def test_strange_names_and_no_keys(spark):
    df = spark.createDataFrame([(1, 0.5), (2, 0.25)], "`a b` int, `x.y` double")
    assert exact_sums(df, ["a b"], {"s": F.col("`x.y`")}).count() == 2
    assert exact_sums(df, [], {"s": F.col("`x.y`")}).first().s == 0.75


def test_rows_are_reduced_before_a_shuffle_and_compiled(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.rand(1).alias("x"))
    plan = exact_sums(df, ["k"], {"x": F.col("x")})._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and "SortAggregate" not in plan and "Python" not in plan
