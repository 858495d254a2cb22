import itertools

import numpy as np
import pytest

from sparkchecks.functions.compare import (
    classify_deviation,
    loosely_close,
    relative_error,
    strictly_close,
)
from sparkchecks.functions.status import severity, worst_status

EDGES = [
    0.0, -0.0, 1.0, -1.0, 1.0 + 1e-6, 1.0 + 1e-4, 1e-9, -1e-9, 1e-7,
    1e300, float("nan"), float("inf"), float("-inf"), 1000.001,
]


def test_closeness_agrees_with_numpy(spark):
    pairs = list(itertools.product(EDGES, EDGES))
    df = spark.createDataFrame(pairs, "a double, d double")
    rows = df.select(
        strictly_close("a", "d", 1e-5).alias("strict"),
        loosely_close("a", "d", 1e-5).alias("loose"),
    ).collect()
    for (a, d), row in zip(pairs, rows):
        try:
            np.testing.assert_allclose(a, d, rtol=1e-5)
            strict = True
        except AssertionError:
            strict = False
        with np.errstate(invalid="ignore"):
            assert (row.strict, row.loose) == (strict, bool(np.allclose(a, d, rtol=1e-5))), (a, d)


def test_null_is_not_comparable(spark):
    row = spark.sql("SELECT CAST(NULL AS double) a, 1.0D d").select(
        strictly_close("a", "d", 1e-5), loosely_close("d", "a", 1e-5)
    ).first()
    assert tuple(row) == (None, None)


def test_relative_error(spark):
    rows = spark.createDataFrame([(90.0, 100.0), (100.0, 0.0), (1.0, -2.0)], "a double, e double")
    found = [r[0] for r in rows.select(relative_error("a", "e")).collect()]
    assert found == [0.1, float("inf"), -1.5]


NAN, INF = float("nan"), float("inf")


@pytest.mark.parametrize(
    "given, out, tolerance, status, deviation, words",
    [
        (1000.0, 1050.0, 10.0, "SUCCESS", 5.0, "within tolerance"),
        (1000.0, 1200.0, 10.0, "WARNING", 20.0, "exceeds tolerance"),
        (1000.0, 1100.0, 10.0, "SUCCESS", 10.0, "10.00%"),
        (0.0, 0.0, 10.0, "SUCCESS", 0.0, "No capacity"),
        (0.0, 500.0, 10.0, "CRITICAL_FAILURE", INF, "no input capacity"),
        (500.0, 0.0, 10.0, "CRITICAL_FAILURE", -100.0, "was not distributed"),
        (500.0, 500.0, 5.0, "SUCCESS", 0.0, "0.00%"),
        (-500.0, 0.0, 10.0, "WARNING", -100.0, "exceeds"),
        (0.0, -5.0, 10.0, "CRITICAL_FAILURE", None, "Failed to validate"),
        (0.0, NAN, 10.0, "CRITICAL_FAILURE", None, "Failed to validate"),
        (NAN, 0.0, 10.0, "WARNING", NAN, "exceeds"),
        (NAN, 5.0, 10.0, "WARNING", NAN, "exceeds"),
        (5.0, INF, 10.0, "WARNING", INF, "exceeds"),
        (INF, INF, 10.0, "WARNING", NAN, "exceeds"),
        (INF, 0.0, 10.0, "CRITICAL_FAILURE", -100.0, "was not distributed"),
    ],
)
def test_deviation(spark, given, out, tolerance, status, deviation, words):
    df = spark.createDataFrame([("solar", given, out)], "c string, i double, o double")
    verdict = classify_deviation("c", "i", "o", tolerance)
    row = df.select(*[c.alias(n) for n, c in verdict.items()]).first()
    assert row.status == status
    assert words in row.message
    if deviation is None:
        assert row.deviation_percent is None
    elif deviation != deviation:
        assert row.deviation_percent != row.deviation_percent
    else:
        assert row.deviation_percent == pytest.approx(deviation)


def test_status_ladder(spark):
    def worst(*statuses):
        df = spark.createDataFrame([(s,) for s in statuses], "s string")
        return df.agg(worst_status("s")).first()[0]

    assert worst() == "SUCCESS"
    assert worst("SUCCESS", "SUCCESS") == "SUCCESS"
    assert worst("SUCCESS", "WARNING") == "WARNING"
    assert worst("WARNING", "CRITICAL_FAILURE", "SUCCESS") == "CRITICAL_FAILURE"
    assert worst("SUCCESS", None) == "CRITICAL_FAILURE"
    assert spark.sql("SELECT 'FAILED' s").select(severity("s")).first()[0] == 2
