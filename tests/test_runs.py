import pytest
from pyspark.sql import functions as F

from sparkchecks import FrameTables, Part, Rule, Total, changed_rules, history, plan_run, register_table_check, run, run_rollup
from sparkchecks.plans.specs import RULE_SETS, SANITY_RULES, rule_set
from test_reconcile import Energy

NULLS = Rule("nulls", "null", [{"table": "t", "column": "a"}, {"table": "t", "column": "b"}])
NANS = Rule("nans", "nan", [{"table": "t", "column": "b"}])
EMPTY = Rule("empty", "null", [])
NO_COLUMN = Rule("no_column", "null", [{"table": "t"}])
ABSENT = Rule("absent", "refinement",
              {"table": "none", "column": "x", "region": "r", "code": "c", "cell": "l", "original": "o"})
UNKNOWN = Rule("unknown", "no_such_check", {"table": "t"})


@pytest.fixture
def tables(spark):
    frame = spark.createDataFrame([(1, 1.0), (2, None), (3, 2.0)], "a int, b double")
    return FrameTables(spark, {"t": frame, "bad": frame.select(F.expr("cast('x' || a AS int) AS v"), "a")})


def by_name(results):
    return {r.rule_name: r for r in results.collect()}


@pytest.mark.parametrize("way", ["plan", "run", "stored"])
def test_rules_are_isolated(tables, way, tmp_path):
    rules = [NULLS, NANS, EMPTY, NO_COLUMN, ABSENT, UNKNOWN]
    if way == "plan":
        results = plan_run(tables, rules, run_id="r1")
    else:
        results = run(tables, rules, run_id="r1", output=str(tmp_path) if way == "stored" else None).rules
    rows = by_name(results)
    assert [rows[r.name].ordinal for r in rules] == list(range(6))
    assert {r.run_id for r in rows.values()} == {"r1"}
    assert {n: r.status for n, r in rows.items()} == {
        "nulls": "CRITICAL_FAILURE", "nans": "SUCCESS", "empty": "SUCCESS",
        "no_column": "CRITICAL_FAILURE", "absent": "CRITICAL_FAILURE", "unknown": "CRITICAL_FAILURE",
    }
    assert rows["nulls"].error_details == "1 of 2 validations failed: t.b"
    assert rows["nulls"].table_name == "multiple_tables"
    assert rows["nans"].message == "All 1 validations passed"
    assert rows["empty"].message == "All 0 validations passed"
    assert rows["no_column"].error_details.startswith("Batch validation execution failed")
    assert (rows["absent"].table_name, rows["absent"].validation_type) == ("unknown", "unknown")
    assert "Table does not exist" in rows["absent"].error_details
    report = run_rollup(results).first()
    assert (report.total_rules, report.passed_rules, report.failed_rules) == (6, 2, 4)
    assert report.passed_rule_names == ["empty", "nans"]
    assert report.overall_status == "CRITICAL_FAILURE"


def test_empty_run_succeeds(tables):
    result = run(tables, [])
    assert tuple(result.report.first()) == (0, 0, 0, [], [], "SUCCESS")
    assert plan_run(tables, []).count() == 0


def test_subset(tables):
    rules = [NULLS, NANS, EMPTY]
    assert set(by_name(run(tables, rules, only=["nans"]).rules)) == {"nans"}
    assert len(rules) == 3
    with pytest.raises(ValueError, match="Unknown rules: other"):
        run(tables, rules, only=["nans", "other"])


def test_later_rule_of_a_name_replaces_the_earlier(tables):
    again = Rule("nulls", "null", [{"table": "t", "column": "a"}])
    rows = by_name(plan_run(tables, [NULLS, NANS, again]))
    assert rows["nulls"].status == "SUCCESS" and rows["nulls"].ordinal == 0


def test_stored_run_reads_back(spark, tables, tmp_path):
    total = Total("t", "a", {"all": []})
    sums = Rule("sums", "reconcile", {"table": "t", "column": "a", "parts": [Part(["all"], [total], [total])]})
    result = run(tables, [NULLS, sums], run_id="r7", output=str(tmp_path))
    stored = history(spark, str(tmp_path))
    assert sorted(stored.columns) == sorted(result.rules.columns) and stored.count() == 2
    assert history(spark, str(tmp_path), "check_items").filter("run_id = 'r7'").count() == 2
    (item,) = spark.read.parquet(f"{tmp_path}/r7/details/sums").collect()
    assert (item.component, item.input_total, item.status) == ("all", 6.0, "SUCCESS")
    assert history(spark, str(tmp_path), "reports").first().failed_rules == 1
    assert set(result.details) == {"sums"}


def test_runs_are_parts_of_one_table(spark, tables, tmp_path):
    output = str(tmp_path)
    run(tables, [NULLS, NANS], run_id="1", output=output)
    run(tables, [NULLS, NANS, EMPTY], run_id="2", output=output)
    before = {(r.run_id, r.rule_name): r.ts for r in history(spark, output).collect()}
    assert set(before) == {("1", "nulls"), ("1", "nans"), ("2", "nulls"), ("2", "nans"), ("2", EMPTY.name)}
    run(tables, [NANS], run_id="1", output=output)
    after = {(r.run_id, r.rule_name): r.ts for r in history(spark, output).collect()}
    assert set(after) == set(before) - {("1", "nulls")}
    assert after["2", "nulls"] == before["2", "nulls"] and after["1", "nans"] > before["1", "nans"]
    assert history(spark, output, "check_items").filter("run_id = '1'").count() == 1
    plan = history(spark, output).filter("run_id = '2'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_id" in plan
    run(tables, [], run_id="1", output=output)  # a run without rules leaves no rows of an earlier one
    assert {r.run_id for r in history(spark, output).collect()} == {"2"}
    assert {r.run_id: r.total_rules for r in history(spark, output, "reports").collect()} == {"1": 0, "2": 3}
    with pytest.raises(ValueError, match="can name a part"):
        run(tables, [NANS], run_id="a/b", output=output)


def test_a_failed_run_leaves_the_others(spark, tables, tmp_path):
    from sparkchecks.sources.sinks import read_parts, replace_part

    frame = spark.range(3).withColumn("x", F.lit(1.5))
    replace_part(frame, f"{tmp_path}/t", "run_id", "a")
    replace_part(frame, f"{tmp_path}/t", "run_id", "b")
    with pytest.raises(Exception):
        replace_part(frame.withColumn("x", F.raise_error(F.lit("lost")).cast("double")), f"{tmp_path}/t", "run_id", "b")
    assert read_parts(spark, f"{tmp_path}/t", frame.schema, "run_id").groupBy("run_id").count().count() == 2
    assert replace_part(frame.limit(1), f"{tmp_path}/t", "run_id", "b").count() == 1
    assert read_parts(spark, f"{tmp_path}/t", frame.schema, "run_id").count() == 4


def test_changed_rules(spark):
    rows = [("1", "r", "SUCCESS", 1), ("2", "r", "CRITICAL_FAILURE", 2), ("3", "r", "CRITICAL_FAILURE", 3), ("2", "s", "SUCCESS", 2)]
    frame = spark.createDataFrame(rows, "run_id string, rule_name string, status string, ts int")
    found = {(r.rule_name, r.run_id): (r.status_before, r.changed) for r in changed_rules(frame).collect()}
    assert found == {("r", "1"): (None, False), ("r", "2"): ("SUCCESS", True), ("r", "3"): ("CRITICAL_FAILURE", False), ("s", "2"): (None, False)}


def test_reconciliations_of_a_run_share_their_passes(spark, tables, tmp_path):
    total = Total("t", "a", {"all": []})
    rules = [Rule(f"sums{i}", "reconcile", {"table": "t", "parts": [Part(["all"], [total], [total])]}) for i in range(3)]
    result = run(tables, rules, run_id="r", output=str(tmp_path))
    assert [r.status for r in result.rules.orderBy("ordinal").collect()] == ["SUCCESS"] * 3
    assert {n: d.first().input_total for n, d in result.details.items()} == {f"sums{i}": 6.0 for i in range(3)}
    assert spark.read.parquet(f"{tmp_path}/r/details/reconciliations").count() == 3
    broken = Total("bad", "v", {"bad": []})
    rules.append(Rule("broken", "reconcile", {"table": "t", "parts": [Part(["bad"], [broken], [broken])]}))
    found = by_name(run(tables, rules).rules)
    assert [found[f"sums{i}"].status for i in range(3)] == ["SUCCESS"] * 3 and found["broken"].status == "CRITICAL_FAILURE"


@pytest.mark.parametrize("stored", [False, True])
def test_mismatches_of_grouped_rules(spark, tmp_path, stored):
    shares = [(b, "y35", 0.45) for b in range(15) for _ in range(2)] + [(1, "y100", 1.0)]
    frames = {"s": spark.createDataFrame(shares, "bus bigint, scn string, share double")}
    rule = Rule("shares", "share_sums", {"table": "s", "column": "share", "member": "bus", "group": "scn",
                                         "scenarios": ["y35", "y100", "y50"]})
    output = str(tmp_path) if stored else None
    result = run(FrameTables(spark, frames), [rule], run_id="r", output=output)
    row = result.rules.first()
    assert (row.status, row.total, row.passed, row.warnings, row.failed) == ("CRITICAL_FAILURE", 3, 1, 1, 1)
    rollup = {r.group_key: r for r in result.details["shares"].collect()}
    assert (rollup["y35"].mismatches, rollup["y35"].total_members) == (15, 15)
    listed = sorted(r.member_key for r in result.mismatches["shares"].collect())
    assert listed == list(range(10))
    if stored:
        assert spark.read.parquet(f"{tmp_path}/r/items/shares").count() == 16


def test_a_part_that_fails_while_read_is_isolated(tables):
    good, bad = Total("t", "a", {"good": []}), Total("bad", "v", {"bad": []})
    parts = [Part(["good"], [good], [good]), Part(["bad"], [bad], [bad])]
    result = run(tables, [Rule("sums", "reconcile", {"table": "t", "parts": parts}), NANS])
    rows = {r.component: r for r in result.details["sums"].collect()}
    assert rows["good"].status == "SUCCESS"
    assert (rows["bad"].status, rows["bad"].input_total) == ("CRITICAL_FAILURE", None)
    assert by_name(result.rules)["sums"].passed == 1
    assert by_name(result.rules)["nans"].status == "SUCCESS"


def test_warnings_count_as_failed_in_a_run(spark, tables):
    register_table_check(
        "statuses", lambda t, params: t.spark.createDataFrame([(s,) for s in params["statuses"]], "status string")
    )
    rows = plan_run(tables, [
        Rule("warned", "statuses", {"statuses": ["SUCCESS", "WARNING"]}),
        Rule("failed", "statuses", {"statuses": ["WARNING", "CRITICAL_FAILURE", None]}),
        Rule("passed", "statuses", {"statuses": ["SUCCESS"]}),
    ])
    found = by_name(rows)
    assert [found[n].status for n in ("warned", "failed", "passed")] == ["WARNING", "CRITICAL_FAILURE", "SUCCESS"]
    assert found["warned"].error_details == "Found 1 warnings in warned"
    assert found["failed"].error_details == "Found 2 critical failures in failed"
    assert found["passed"].error_details is None and found["passed"].message == "1/1 validations passed"
    assert run_rollup(rows).first().failed_rules == 2


def test_column_rules_share_a_scan(tables, spark):
    frames = FrameTables(spark, {"t": spark.range(10).selectExpr("id AS a", "double(id) AS b")})
    plan = plan_run(frames, [NULLS, NANS])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (") == 1


def test_shipped_rule_sets():
    assert {name: len(rules) for name, rules in RULE_SETS.items()} == {
        "comprehensive": 9, "critical_only": 2, "time_series_only": 1, "null_checks_only": 1,
        "quick_check": 1, "sanity_checks": 6,
    }
    sizes = [len(r.config) for r in RULE_SETS["comprehensive"][:3]]
    assert sizes == [6, 3, 16]
    assert len(RULE_SETS["time_series_only"][0].config) == 4
    with pytest.raises(ValueError, match="not found"):
        rule_set("no_such_set")


def test_shipped_rules_end_to_end(spark):
    energy = Energy(spark)
    energy.put("demand.egon_demandregio_zensus_electricity",
               "zensus_population_id bigint, scenario string, sector string, demand double",
               [(1, s, "residential", 10.0) for s in ("eGon2035", "eGon100RE")] + [(1, "eGon2035", "CTS", 5.0)])
    energy.put("boundaries.egon_map_zensus_vg250", "zensus_population_id bigint, vg250_nuts3 string", [(1, "DE1")])
    energy.put("demand.egon_demandregio_hh", "nuts3 string, scenario string, year string, demand double",
               [("DE1", "eGon2035", "2035", 10.0), ("DE1", "eGon100RE", "2050", 11.0)])
    energy.put("society.egon_destatis_zensus_household_per_ha_refined",
               "nuts3 string, cell_id bigint, characteristics_code string, hh_5types int, hh_10types int", [])
    energy.put("demand.egon_cts_electricity_demand_building_share",
               "bus_id bigint, scenario string, profile_share double", [(1, "eGon2035", 1.0)])
    energy.put("demand.egon_cts_heat_demand_building_share",
               "bus_id bigint, scenario string, profile_share double", [])
    rows = by_name(run(energy.tables, SANITY_RULES).rules)
    assert {n: (r.status, r.total, r.passed) for n, r in rows.items() if "etrago" not in n} == {
        "residential_electricity_annual_sum": ("CRITICAL_FAILURE", 2, 1),
        "residential_electricity_hh_refinement": ("CRITICAL_FAILURE", None, None),
        "cts_electricity_demand_share": ("WARNING", 2, 1),
        "cts_heat_demand_share": ("CRITICAL_FAILURE", None, None),
    }
    assert rows["residential_electricity_hh_refinement"].error_details == "No refinement data found"
    assert rows["cts_heat_demand_share"].error_details == "No CTS heat demand share data found"
    assert rows["residential_electricity_annual_sum"].message == "1/2 scenarios passed"
    assert (rows["etrago_heat_sanity"].status, rows["etrago_heat_sanity"].passed) == ("SUCCESS", 6)
    electricity = rows["etrago_electricity_sanity"]
    assert (electricity.status, electricity.total, electricity.passed) == ("WARNING", 11, 10)


def test_reconciliations_of_a_run_share_their_passes(spark):
    """One read each of the tables that several parts and both sector rules need."""
    from sparkchecks.plans import specs
    from sparkchecks.plans.runs import plan_run

    frames = {}

    def table(name, columns):
        frames[name] = spark.createDataFrame([], columns)
        frames[name].createOrReplaceTempView(name.replace(".", "_"))

    energy = "scn_name string, bus bigint, carrier string, p_nom double"
    for name in (specs.GENERATOR, specs.STORAGE, specs.LINK):
        table(name, energy)
    table(specs.BUS, "scn_name string, bus_id bigint, country string")
    table(specs.LOAD, "scn_name string, load_id bigint, bus bigint, carrier string")
    table(specs.LOAD_SERIES, "scn_name string, load_id bigint, p_set array<double>")
    table(specs.CAPACITIES, "scenario_name string, carrier string, capacity double")
    for name in (specs.HOUSEHOLD_DEMAND, specs.INDUSTRY_DEMAND, specs.HEAT_DEMAND):
        table(name, "scenario string, year string, demand double")
    from sparkchecks import FrameTables, rule_set

    rules = [r for r in rule_set("sanity_checks") if r.check == "reconcile"]
    assert len(rules) == 2
    spark.conf.set("spark.sql.optimizer.excludedRules", "org.apache.spark.sql.catalyst.optimizer.ConvertToLocalRelation,org.apache.spark.sql.catalyst.optimizer.PropagateEmptyRelation")
    try:
        plan = plan_run(FrameTables(spark, frames), rules)
        text = plan._jdf.queryExecution().analyzed().toString()
    finally:
        spark.conf.unset("spark.sql.optimizer.excludedRules")
    for column in ("scenario_name", "p_set"):
        assert text.count(f"[{column}") + text.count(f", {column}#") >= 1
    capacities = [line for line in text.split("\n") if "LogicalRDD" in line and "capacity#" in line]
    series = [line for line in text.split("\n") if "LogicalRDD" in line and "p_set#" in line]
    energy_reads = [line for line in text.split("\n") if "LogicalRDD" in line and "p_nom#" in line]
    assert (len(capacities), len(series), len(energy_reads)) == (1, 1, 3)
