import pytest
from pyspark.sql import functions as F

from sparkchecks import FrameTables, batch_rollup, batch_summary, column_check_items, column_items
from sparkchecks import register_column_check, run_column_checks

NAN = float("nan")


@pytest.fixture(scope="module")
def tables(spark):
    measures = spark.range(1000).select(
        F.when(F.col("id") >= 15, F.col("id").cast("double")).alias("with_nulls"),
        F.when(F.col("id") < 8, NAN).otherwise(1.0).alias("with_nans"),
        F.lit(1).alias("clean"),
        F.when(F.col("id") == 3, "abc").otherwise("1").alias("texts"),
    )
    series = spark.createDataFrame(
        [([1.0] * 3,), ([1.0] * 2,), ([],), (None,), ([NAN] * 3,)], "p array<double>"
    )
    return FrameTables(
        spark,
        {
            "a.measures": measures,
            "a.series": series,
            "a.empty": measures.limit(0),
            "a.fails": measures.select(
                F.col("clean"), F.col("texts").cast("int").alias("number"), "with_nans"
            ),
        },
    )


def items(*specs, rule="rule"):
    found = []
    for check, table, column, *params in specs:
        found.append((check, {"table": table, "column": column, **(params[0] if params else {})}))
    out = []
    for i, (check, config) in enumerate(found):
        (item,) = column_items(rule, check, [config])
        out.append(type(item)(rule, i, check, item.table, item.column, item.params))
    return out


def both(tables, wanted):
    """The lazy and the isolating way must agree."""
    lazy = sorted(column_check_items(tables, wanted).collect(), key=lambda r: r.ordinal)
    eager = sorted(run_column_checks(tables, wanted).collect(), key=lambda r: r.ordinal)
    assert lazy == eager
    return lazy


def test_null_and_nan_counts(tables):
    rows = both(
        tables,
        items(
            ("null", "a.measures", "clean"),
            ("null", "a.measures", "with_nulls"),
            ("nan", "a.measures", "with_nans"),
            ("nan", "a.measures", "clean"),
            ("nan", "a.measures", "texts"),
            ("null", "a.empty", "clean"),
        ),
    )
    assert [(r.status, r.total_rows, r.invalid_count) for r in rows] == [
        ("SUCCESS", 1000, 0),
        ("FAILED", 1000, 15),
        ("FAILED", 1000, 8),
        ("SUCCESS", 1000, 0),
        ("FAILED", 1000, 1),
        ("SUCCESS", 0, 0),
    ]
    assert rows[0].details == "No NULL values found in a.measures.clean (1000 rows checked)"
    assert "Found 15 NULL values" in rows[1].details
    assert "Found 8 NaN values" in rows[2].details
    assert "No NaN values found" in rows[3].details
    assert rows[1].invalid_rate == 1.5
    assert rows[5].invalid_rate is None


def test_array_lengths(tables):
    right, default = both(
        tables,
        items(
            ("time_series", "a.series", "p", {"expected_length": 3}),
            ("time_series", "a.series", "p"),
        ),
    )
    assert (right.total_rows, right.invalid_count, right.found_lengths) == (5, 2, [0, 2, 3])
    assert right.expected_length == 3 and "Found lengths: 0, 2, 3" in right.details
    assert (default.expected_length, default.invalid_count) == (8760, 4)


def test_nan_inside_arrays(tables):
    element_wise, lexical = both(
        tables,
        items(("nan", "a.series", "p"), ("nan", "a.series", "p", {"lexical": True})),
    )
    assert (element_wise.invalid_count, lexical.invalid_count) == (1, 4)


def test_one_scan_per_table(tables, spark):
    wanted = items(*[("null", "a.measures", c) for c in ("clean", "with_nulls", "with_nans", "texts")])
    plan = column_check_items(tables, wanted)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (") == 1


def test_missing_things_fail_alone(tables):
    rows = both(
        tables,
        items(
            ("null", "a.measures", "no_such"),
            ("null", "no.table", "x"),
            ("null", "a.measures", "clean"),
            ("time_series", "a.measures", "clean"),
            ("no_such_check", "a.measures", "clean"),
        ),
    )
    assert [(r.status, r.total_rows, r.invalid_count) for r in rows] == [
        ("FAILED", 0, -1),
        ("FAILED", 0, -1),
        ("SUCCESS", 1000, 0),
        ("FAILED", 0, -1),
        ("FAILED", 0, -1),
    ]
    assert "Column does not exist" in rows[0].details
    assert "Table does not exist" in rows[1].details
    assert rows[0].details.startswith("SQL execution failed")
    assert rows[3].expected_length == 8760


def test_errors_while_reading_fail_alone(tables):
    """The cast in one column raises when a row is read; its neighbours are still checked."""
    rows = sorted(
        run_column_checks(
            tables,
            items(
                ("null", "a.fails", "clean"),
                ("null", "a.fails", "number"),
                ("nan", "a.fails", "with_nans"),
                ("null", "a.fails", "no_such"),
                ("null", "a.measures", "clean"),
            ),
        ).collect(),
        key=lambda r: r.ordinal,
    )
    assert [(r.status, r.invalid_count) for r in rows] == [
        ("SUCCESS", 0),
        ("FAILED", -1),
        ("FAILED", 8),
        ("FAILED", -1),
        ("SUCCESS", 0),
    ]


def test_batch_rollup(tables):
    mixed = items(
        ("null", "a.measures", "clean"),
        ("null", "a.measures", "with_nulls"),
        ("null", "a.measures", "texts"),
    )
    row = batch_rollup(column_check_items(tables, mixed)).first()
    assert (row.status, row.total, row.passed, row.failed) == ("CRITICAL_FAILURE", 3, 2, 1)
    assert row.error_details == "1 of 3 validations failed: a.measures.with_nulls"
    assert row.message is None
    passing = items(*[("null", "a.measures", "clean")] * 3)
    row = batch_rollup(column_check_items(tables, passing)).first()
    assert (row.status, row.message, row.error_details) == (
        "SUCCESS", "All 3 validations passed", None,
    )


def test_failed_names_keep_their_order(tables):
    wanted = items(
        ("nan", "a.measures", "with_nans"),
        ("null", "a.measures", "with_nulls"),
        ("nan", "a.measures", "with_nans"),
    )
    row = batch_rollup(column_check_items(tables, wanted)).first()
    assert row.failed_names == "a.measures.with_nans, a.measures.with_nulls, a.measures.with_nans"


def test_last_item_of_a_column_wins(tables):
    wanted = items(
        ("nan", "a.measures", "with_nans"),
        ("null", "a.measures", "with_nans"),
        ("null", "a.measures", "with_nulls"),
    )
    rows = batch_summary(column_check_items(tables, wanted)).collect()
    assert {r.column_name: r.status for r in rows} == {
        "with_nans": "SUCCESS", "with_nulls": "FAILED",
    }


def test_incomplete_item_is_an_error():
    with pytest.raises(KeyError):
        column_items("rule", "null", [{"table": "a.measures"}])


def test_custom_check_shares_the_scan(tables):
    register_column_check(
        "above", lambda column, params: {"invalid_count": F.count_if(column > params["limit"])}
    )
    wanted = items(
        ("above", "a.measures", "with_nulls", {"limit": 990}),
        ("null", "a.measures", "with_nulls"),
    )
    rows = both(tables, wanted)
    assert [r.invalid_count for r in rows] == [9, 15]
    plan = column_check_items(tables, wanted)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (") == 1


def test_custom_check_needs_an_invalid_count(tables):
    register_column_check("odd", lambda column, params: {"other": F.count(column)})
    (row,) = both(tables, items(("odd", "a.measures", "clean")))
    assert row.status == "FAILED" and "invalid_count" in row.details


def test_many_lengths_stay_rows(spark):
    """Distinct lengths are rows of their own; an item's row has a bounded number of them."""
    from sparkchecks import FrameTables, column_items
    from sparkchecks.operators import batch

    frame = spark.range(100_000).selectExpr("CASE WHEN id > 0 THEN array_repeat(1Y, cast(id % 300 AS int)) END AS a", "id")
    tables = FrameTables(spark, {"t": frame})
    items = column_items("r", "time_series", [{"table": "t", "column": "a", "expected_length": 5}]) + column_items("n", "null", [{"table": "t", "column": "id"}])
    plan, lengths, _ = batch._plan_table(frame, dict(enumerate(items)))
    assert "ObjectHashAggregate" not in plan._jdf.queryExecution().executedPlan().toString()
    rows = batch.found_lengths(tables, items).collect()
    assert len(rows) == 300 and sum(r.arrays for r in rows) == 99_999
    for found in (column_check_items(tables, items), run_column_checks(tables, items)):
        row = found.filter("check_type = 'time_series'").first()
        assert (row.total_rows, row.invalid_count, row.length_count, row.min_length, row.max_length) == (100_000, 99_999 - 333 - (5 <= 99_999 % 300), 300, 0, 299)
        assert len(row.found_lengths) == batch.MOST_LENGTHS and "and 200 more" in row.details
    wide = spark.range(100_000).selectExpr("sequence(1L, 1L) AS a", "id")
    assert batch.found_lengths(FrameTables(spark, {"t": wide}), items).count() == 1


def test_a_million_lengths(spark):
    from pyspark.sql import functions as F
    from sparkchecks.operators import batch

    lengths = spark.range(1_000_000).selectExpr("cast(id % 1 AS int) AS item", "cast(id AS int) AS length", "CASE WHEN id = 777 THEN 9L ELSE 1L END AS arrays")
    items = column_items("r", "time_series", [{"table": "t", "column": "a", "expected_length": 5}])
    from sparkchecks import FrameTables

    found = batch._by_length(FrameTables(spark, {}), lengths, items)
    row = found.first()
    assert (row.total_rows, row.invalid_count, row.length_count) == (1_000_008, 1_000_007, 1_000_000)
    assert row.found_lengths == [*range(batch.MOST_LENGTHS - 1), 777]
    assert "WindowGroupLimit" in found._jdf.queryExecution().executedPlan().toString()
    assert lengths.agg(F.max("length")).first()[0] == 999_999


def test_lengths_and_counts_come_from_one_scan(spark, tmp_path):
    from sparkchecks import FileTables

    spark.range(100).selectExpr("array_repeat(1D, cast(id % 3 AS int)) AS a", "id").write.parquet(f"{tmp_path}/t.parquet")
    items = column_items("r", "time_series", [{"table": "t", "column": "a", "expected_length": 1}])
    frame = column_check_items(FileTables(spark, str(tmp_path)), items)
    frame.collect()
    final = frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final and final.count("FileScan parquet") == 1
    (row,) = run_column_checks(FileTables(spark, str(tmp_path)), items).collect()
    assert (row.total_rows, row.invalid_count, row.found_lengths) == (100, 67, [0, 1, 2])


def test_lengths_of_an_empty_table(spark):
    from sparkchecks import FrameTables

    empty = spark.createDataFrame([], "a array<int>, b int")
    items = column_items("r", "time_series", [{"table": "t", "column": "a"}, {"table": "t", "column": "b"}])
    for found in (column_check_items(FrameTables(spark, {"t": empty}), items), run_column_checks(FrameTables(spark, {"t": empty}), items)):
        right, wrong = found.orderBy("ordinal").collect()
        assert (right.status, right.total_rows, right.invalid_count, right.found_lengths, right.length_count) == ("SUCCESS", 0, 0, [], 0)
        assert (wrong.status, wrong.total_rows, wrong.invalid_count) == ("FAILED", 0, -1)
