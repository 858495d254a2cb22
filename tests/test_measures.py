import math
from decimal import Decimal

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkchecks.functions.exact import exact_sums
from sparkchecks.functions.measures import (
    array_length,
    array_totals,
    not_a_number,
    rounded_bigint,
)

NAN, INF = float("nan"), float("inf")


def total(spark, values, dtype="double"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return exact_sums(df, [], {"x": F.col("x")}).select(F.col("x").cast("double")).first()[0]


@pytest.mark.parametrize(
    "values",
    [
        [0.1] * 10,
        [0.1, 0.2, -0.3],
        [1e14, 0.25, -1e14],
        [-1.75, -0.0001, 0.000123456789],
        [123456.789, None, 0.001],
        [None, None],
        [],
    ],
)
def test_sum_equals_decimal_sum(spark, values):
    known = [Decimal(repr(v)) for v in values if v is not None]
    wanted = pytest.approx(float(sum(known)), rel=1e-15, abs=1e-12) if known else None
    assert total(spark, values) == wanted


@pytest.mark.parametrize("dtype", ["double", "decimal(28,10)", "bigint"])
def test_sum_over_any_partitioning(spark, dtype):
    df = spark.range(100_000).selectExpr(f"cast(CASE WHEN id = 7 THEN 0.00005 ELSE id * 0.0123 END AS {dtype}) AS x")
    sums = [
        exact_sums(df.repartition(n, F.rand(n)), [], {"x": F.col("x")}).first()[0]
        for n in (1, 3, 8)
    ]
    assert len(set(sums)) == 1


def test_no_digit_is_dropped(spark):
    df = spark.range(100_000).selectExpr("0.000123456789012345D AS x", "cast(0.0000494999 AS decimal(28,10)) AS d")
    row = exact_sums(df, [], {"x": F.col("x"), "d": F.col("d")}).first()
    assert row[0] == math.fsum([0.000123456789012345] * 100_000)
    assert row[1] == Decimal("4.9499900000")


def test_sum_of_many_magnitudes(spark):
    random = np.random.default_rng(1)
    values = random.standard_normal(20_000) * 10.0 ** random.integers(-9, 12, 20_000)
    tables = [values, values[np.abs(values) > 1], values[np.abs(values) < 1e-5], values * 1e-9]
    for group in tables:
        df = spark.createDataFrame(pd.DataFrame({"x": group}))
        assert exact_sums(df, [], {"x": F.col("x")}).first()[0] == math.fsum(group)


def test_sum_of_extreme_values(spark):
    assert total(spark, [1e300, 1.0]) == 1e300
    assert total(spark, [1e-15] * 3) == pytest.approx(3e-15)
    assert total(spark, [INF, 1.0]) == INF
    assert total(spark, [NAN, 1.0]) != total(spark, [NAN, 1.0])
    assert total(spark, [2**62, 2**62], "bigint") == float(2**63)
    assert total(spark, [Decimal("0.1")] * 3, "decimal(10,2)") == 0.3


def test_rounding_casts(spark):
    df = spark.sql("SELECT 2.5D AS d, CAST(2.5 AS decimal(4,1)) AS n, CAST(-2.5 AS decimal(4,1)) AS m")
    row = df.select(
        *[rounded_bigint(F.col(c), df.schema[c].dataType).alias(c) for c in ("d", "n", "m")]
    ).first()
    assert tuple(row) == (2, 3, -3)


def test_array_totals(spark):
    df = spark.createDataFrame(
        [(1, [1.0, None, 2.5]), (1, [1.0]), (2, []), (3, None), (4, [None, None])], "k int, a array<double>"
    )
    assert {r.k: r.total for r in array_totals(df, ["k"], "a").collect()} == {1: 4.5, 4: None}


def test_array_length_counts_all_dimensions(spark):
    df = spark.sql("SELECT array(array(1, 2), array(3)) AS a, CAST(NULL AS array<int>) AS b")
    row = df.select(
        *[array_length(F.col(c), df.schema[c].dataType).alias(c) for c in ("a", "b")]
    ).first()
    assert tuple(row) == (3, None)


def invalid(spark, values, dtype, **options):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    check = not_a_number(F.col("x"), df.schema["x"].dataType, **options)
    rows = df.select("x", F.coalesce(check, F.lit(False)).alias("bad")).collect()
    return [r.x for r in rows if r.bad]


def test_numeric_texts(spark):
    good = [".5", "1e3", "-1.5E-7", "+2", "007", None]
    bad = ["5.", "Infinity", "abc", "", "NaN", "1\n", " 1", "1e", "--1"]
    assert invalid(spark, good + bad, "string") == bad


def test_not_a_number_by_type(spark):
    found = invalid(spark, [1.0, NAN, INF, -INF, None], "double")
    assert len(found) == 3
    assert len(invalid(spark, [1.0, NAN], "float")) == 1
    assert invalid(spark, [1, None], "bigint") == []
    assert invalid(spark, [Decimal("1.5")], "decimal(4,1)") == []
    assert invalid(spark, [True, False, None], "boolean") == [True, False]
    df = spark.sql("SELECT DATE'2020-01-01' AS d, X'00' AS b, named_struct('a', 1) AS s, map(1, 2) AS m")
    row = df.select(*[not_a_number(F.col(c), df.schema[c].dataType) for c in df.columns]).first()
    assert list(row) == [True] * 4


def test_not_a_number_in_arrays(spark):
    rows = [[1.0, 2.0], [1.0, NAN], [None, INF], [-INF], [None], [], None]
    found = invalid(spark, rows, "array<double>")
    assert len(found) == 3
    assert len(invalid(spark, rows, "array<double>", lexical=True)) == 6
    assert invalid(spark, [["1", "x"], ["2"], None], "array<string>") == [["1", "x"]]
    assert invalid(spark, [[1, 2]], "array<int>") == []
    nested = [[[1.0], [NAN]], [[1.0]]]
    assert len(invalid(spark, nested, "array<array<double>>")) == 1
