import math

import pytest

from sparkchecks.operators.groups import (
    first_mismatches,
    grade_members,
    group_rollup,
    group_sum_items,
    mapped_sums,
    member_summary,
    refinement_items,
    share_items,
    share_rollup,
)

NAN = float("nan")
RTOL = 1e-5


def graded(spark, rows, rtol=RTOL):
    df = spark.createDataFrame(
        [(g, m, a, e, 1) for g, m, a, e in rows],
        "g string, m string, actual double, expected double, n_rows bigint",
    )
    return grade_members(df, "rule", "g", "m", rtol)


def rolled(spark, rows, rtol=RTOL, **options):
    return {r.group_key: r for r in group_rollup(graded(spark, rows, rtol), "rule", rtol, **options).collect()}


@pytest.mark.parametrize(
    "pairs, rtol, status, mismatches",
    [
        ([(1000, 1000), (1500, 1500), (2000, 2000)], 1e-5, "SUCCESS", 0),
        ([(1000, 1000), (1500, 1600), (2000, 1900)], 1e-5, "CRITICAL_FAILURE", 2),
        ([(1000, 1000.001), (1500, 1500.0015)], 1e-3, "SUCCESS", 0),
        ([(1000, 1100)] * 15, 1e-5, "CRITICAL_FAILURE", 15),
        ([(0, 0), (100, 0)], 1e-5, "CRITICAL_FAILURE", 1),
        ([(1e-9, 0)], 1e-5, "CRITICAL_FAILURE", 0),  # strict fails, loose does not
        ([(NAN, NAN)], 1e-5, "SUCCESS", 0),
        ([(NAN, NAN), (1, 2)], 1e-5, "CRITICAL_FAILURE", 2),
    ],
)
def test_rollup(spark, pairs, rtol, status, mismatches):
    rows = [("s", f"m{i}", float(a), float(e)) for i, (a, e) in enumerate(pairs)]
    row = rolled(spark, rows, rtol, requested=["s"])["s"]
    assert (row.status, row.mismatches, row.total_members) == (status, mismatches, len(pairs))
    if not math.isnan(pairs[0][0]):
        assert row.total_actual == pytest.approx(sum(a for a, _ in pairs))
        assert row.total_expected == pytest.approx(sum(e for _, e in pairs))


def test_requested_group_without_rows(spark):
    rows = rolled(spark, [("s", "m", 1.0, 1.0), ("other", "m", 1.0, 9.0)], requested=["s", "t"])
    assert set(rows) == {"s", "t"}
    absent = rows["t"]
    assert (absent.status, absent.mismatches, absent.total_members) == ("CRITICAL_FAILURE", 0, 0)
    assert absent.message == "No data found for t"


def test_null_sum_leaves_the_group_uncounted(spark):
    data = [("s", "m", None, 1.0), ("s", "n", 1.0, 2.0), ("t", "m", 1.0, 1.0)]
    requested = rolled(spark, data, requested=["s", "t"])
    assert (requested["s"].status, requested["s"].mismatches, requested["s"].total_members) == (
        "CRITICAL_FAILURE", None, None)
    assert requested["t"].status == "SUCCESS"
    found = rolled(spark, data)
    assert (found["s"].mismatches, found["s"].total_members) == (None, 2)
    assert "Failed to validate s" in found["s"].message


def test_codes_are_graded_apart(spark):
    data = [("T1", "a", 1000.0, 1000.0), ("T1", "b", 1500.0, 1500.0), ("T2", "a", 800.0, 800.0),
            ("T2", "b", 900.0, 900.0), ("T3", "a", 600.0, 600.0)]
    totals = {k: (r.total_actual, r.total_members) for k, r in rolled(spark, data).items()}
    assert totals == {"T1": (2500.0, 2), "T2": (1700.0, 2), "T3": (600.0, 1)}


@pytest.mark.parametrize("limit", [5, 10])
def test_first_mismatches(spark, limit):
    data = [("s", f"{i:02}", 1000.0, 1100.0) for i in range(15)] + [("t", "x", 1.0, 1.0)]
    items = graded(spark, data)
    listed = first_mismatches(items, limit, group_rollup(items, "rule", RTOL)).collect()
    assert sorted(r.member_key for r in listed) == [f"{i:02}" for i in range(limit)]
    assert {r.relative_error for r in listed} == {100 / 1100}


def test_infinite_relative_error_is_listed(spark):
    items = graded(spark, [("s", "a", 0.0, 0.0), ("s", "b", 100.0, 0.0)])
    (row,) = first_mismatches(items, 10).collect()
    assert (row.member_key, row.relative_error) == ("b", float("inf"))


def test_groups_that_pass_or_cannot_be_graded_list_nothing(spark):
    items = graded(spark, [("nan", "a", NAN, NAN), ("null", "a", None, 1.0), ("null", "b", 1.0, 2.0)])
    assert first_mismatches(items, 10, group_rollup(items, "rule", RTOL)).count() == 0


def test_mapped_sums(spark, any_size):
    detail = [(i % 20 if i % 3 else 1, "AB"[i % 2], float(i)) for i in range(600)]
    detail += [(None, "A", 7.0), (3, "C", 7.0), (999, "A", 7.0), (5, "A", None)]
    mapping = [(k, f"r{k % 4}") for k in range(20)] + [(1, "r1"), (1, "r2"), (None, "r0"), (6, None)]
    sums = mapped_sums(
        spark.createDataFrame(detail, "id bigint, s string, v double"),
        spark.createDataFrame(mapping, "id bigint, region string"),
        "id", "s", "region", "v", ["A", "B", "Z"],
    ).collect()
    wanted = {}
    for i, s, v in detail:
        for j, region in mapping:
            if i is not None and i == j and s in "AB":
                total, n = wanted.get((s, region), (0.0, 0))
                wanted[s, region] = (total + (v or 0.0), n + 1)
    assert {(r.group_key, r.region): (r.total, r.n_rows) for r in sums} == wanted


def test_only_null_values_give_a_null_sum(spark, any_size):
    sums = mapped_sums(
        spark.createDataFrame([(1, "A", None)], "id bigint, s string, v double"),
        spark.createDataFrame([(1, "r")], "id bigint, region string"),
        "id", "s", "region", "v", ["A", "B"],
    ).collect()
    assert [(r.group_key, r.total, r.n_rows) for r in sums] == [("A", None, 1)]


def test_group_sum_items(spark):
    sums = spark.createDataFrame(
        [("A", "r1", 10.0, 2), ("A", "r2", 5.0, 1), ("A", None, 5.0, 1)],
        "group_key string, region string, total double, n_rows bigint",
    )
    reference = spark.createDataFrame(
        [("A", "2035", "r1", 4.0), ("A", "2035", "r1", 6.0), ("A", "2050", "r1", 11.0),
         ("A", "2035", "r3", 1.0), ("A", "2035", None, 5.0), ("B", "2035", "r1", 10.0)],
        "s string, year string, nuts3 string, demand double",
    )
    rows = group_sum_items(sums, reference, "rule", RTOL, "s", "nuts3", "demand", ["A"], "year").collect()
    # One-sided and NULL regions drop out; a region counts once per year.
    assert sorted((r.member_key, r.expected, r.is_close) for r in rows) == [
        ("r1", 10.0, True), ("r1", 11.0, False)]


def test_refinement(spark):
    data = [
        ("n1", "T1", 1, 5, 2), ("n1", "T1", 1, 5, 3), ("n1", "T1", 2, 4, 4), ("n1", "T1", 2, None, 0),
        ("n2", "T1", 1, 7, 6), ("n1", "T2", None, 3, 3), (None, "T1", 1, 100, 1), ("n1", None, 1, 100, 1),
        ("n3", "T3", 1, None, 5), ("n4", "T4", 1, 3, 1), ("n4", "T4", 1, 2, 4),
    ]
    df = spark.createDataFrame(data, "nuts3 string, code string, cell bigint, h5 int, h10 int")
    for dtype in ("int", "double", "decimal(10,2)"):
        typed = df.withColumns({c: df[c].cast(dtype) for c in ("h5", "h10")})
        items = refinement_items(typed, "rule", RTOL, "nuts3", "code", "cell", "h5", "h10")
        found = {(r.group_key, r.member_key): (r.actual, r.expected, r.n_rows) for r in items.collect()}
        assert found == {
            ("T1", "n1"): (9.0, 9.0, 4), ("T1", "n2"): (6.0, 7.0, 1), ("T2", "n1"): (3.0, 3.0, 1),
            ("T3", "n3"): (5.0, None, 1), ("T4", "n4"): (5.0, 5.0, 2),
        }
        rollup = {r.group_key: (r.status, r.mismatches) for r in group_rollup(items, "rule", RTOL).collect()}
        assert rollup == {
            "T1": ("CRITICAL_FAILURE", 1), "T2": ("SUCCESS", 0), "T3": ("CRITICAL_FAILURE", None),
            "T4": ("SUCCESS", 0),
        }


def share_results(spark, rows, requested=("y35", "y100"), rtol=RTOL, dtype="double"):
    df = spark.createDataFrame(rows, f"bus bigint, scn string, share {dtype}")
    items = share_items(df, "rule", rtol, "bus", "scn", "share")
    rollup = share_rollup(items, "rule", rtol, list(requested))
    return items, {r.group_key: r for r in rollup.collect()}


def test_shares_that_sum_to_one(spark):
    _, rows = share_results(spark, [(1, "y35", 0.3), (1, "y35", 0.7), (2, "y35", 0.4), (2, "y35", 0.6),
                                    (1, "y100", 0.2), (1, "y100", 0.8)])
    assert {r.status for r in rows.values()} == {"SUCCESS"}
    assert rows["y35"].total_members == 2 and "equal 1.0" in rows["y35"].message


def test_shares_that_do_not(spark):
    items, rows = share_results(spark, [(1, "y35", 0.3), (1, "y35", 0.6), (2, "y35", 0.4), (2, "y35", 0.6)])
    assert (rows["y35"].status, rows["y35"].mismatches, rows["y35"].total_members) == ("CRITICAL_FAILURE", 1, 2)
    assert "do not sum to 1.0" in rows["y35"].message
    (listed,) = first_mismatches(items, 10).collect()
    assert (listed.member_key, listed.actual, listed.n_rows) == (1, pytest.approx(0.9), 2)


def test_share_tolerance_and_single_shares(spark):
    _, rows = share_results(spark, [(1, "y35", 0.3), (1, "y35", 0.7001), (2, "y35", 0.4999), (2, "y35", 0.5001)],
                            rtol=1e-3)
    assert rows["y35"].status == "SUCCESS"
    _, rows = share_results(spark, [(1, "y35", 0.5), (2, "y35", 0.3), (2, "y35", 0.7)])
    assert rows["y35"].mismatches == 1


def test_absent_scenario_is_a_warning(spark):
    _, rows = share_results(spark, [(1, "y35", 1.0), (9, "unasked", 0.2)])
    assert (rows["y100"].status, rows["y100"].total_members, rows["y100"].mismatches) == ("WARNING", 0, 0)
    assert rows["y35"].status == "SUCCESS" and rows["y35"].source_rows == 2
    assert set(rows) == {"y35", "y100"}


@pytest.mark.parametrize("bad", [(1, "y35", "invalid"), (1, "y35", None), (5, "unasked", "x")])
def test_one_bad_share_breaks_every_scenario(spark, bad):
    _, rows = share_results(spark, [(1, "y35", "0.3"), (1, "y35", "0.7"), bad], dtype="string")
    assert {(r.status, r.mismatches, r.total_members) for r in rows.values()} == {("CRITICAL_FAILURE", None, 0)}
    assert "Failed to validate" in rows["y100"].message


def test_empty_share_table(spark):
    _, rows = share_results(spark, [])
    assert {r.source_rows for r in rows.values()} == {0}


def test_hot_bus_and_listing_order(spark):
    """One bus holds a third of the rows; the list is by bus number, not by text."""
    rows = [(0, "y35", 1 / 500)] * 500 + [(b, "y35", 0.45) for b in range(1, 501) for _ in range(2)]
    items, found = share_results(spark, rows)
    assert (found["y35"].mismatches, found["y35"].total_members) == (500, 501)
    assert [r.member_key for r in first_mismatches(items, 10).orderBy("position").collect()] == list(range(1, 11))


def test_listing_is_pruned_before_the_shuffle(spark):
    items = graded(spark, [("s", "a", 1.0, 2.0)])
    plan = first_mismatches(items, 10)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_listing_with_a_rollup_is_pruned_first(spark, no_broadcast):
    items = graded(spark, [("s", "a", 1.0, 2.0), ("s", "b", 1.0, 2.0), ("t", "a", 1.0, 1.0)])
    rollup = group_rollup(items, "rule", RTOL)
    listed = first_mismatches(items, 1, rollup)
    assert [(r.group_key, r.member_key) for r in listed.collect()] == [("s", "a")]
    plan = listed._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Join") < plan.index("WindowGroupLimit")  # the join is above the limit


def test_decimals_give_the_same_verdict_at_any_size(spark, any_size):
    value = "cast(0.0000494999 AS decimal(28,10))"
    detail = spark.range(1000).selectExpr("id AS cell", "'s' AS scenario", f"{value} AS x")
    mapping = spark.range(1000).selectExpr("id AS cell", "'r' AS region")
    sums = mapped_sums(detail, mapping, "cell", "scenario", "region", "x", ["s"])
    reference = spark.sql("SELECT 's' AS scenario, 'r' AS region, cast(0.0494999 AS decimal(28,10)) AS x")
    items = group_sum_items(sums, reference, "rule", RTOL, "scenario", "region", "x", ["s"])
    assert [r.status for r in group_rollup(items, "rule", RTOL, ["s"]).collect()] == ["SUCCESS"]


def test_plan_does_not_grow_with_the_groups(spark):
    detail = spark.sql("SELECT 1 AS cell, 'g1' AS scenario, 1.0D AS x")
    mapping = spark.sql("SELECT 1 AS cell, 'r' AS region")
    sizes = {
        str(mapped_sums(detail, mapping, "cell", "scenario", "region", "x", [f"g{i}" for i in range(n)])
            ._jdf.queryExecution().optimizedPlan().toString()).count("\n")
        for n in (2, 60)
    }
    assert len(sizes) == 1


def test_member_summary(spark):
    items, _ = share_results(spark, [(1, "y35", 0.3), (1, "y35", 0.7), (2, "y100", 1.0), (None, "y100", 1.0)])
    assert tuple(member_summary(items).first()) == (3, 4, 3, 2)
