"""Runs of rule sets, inventory, coverage and reports."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkchecks import RULE_SETS, CatalogTables, FrameTables, Rule, plan_run, register_table_check
from sparkchecks import changed_rules, history, run, run_rollup, write_report
from sparkchecks.operators import coverage

from .column_queries import (
    ALL_DERIVED,
    LENGTH_ITEMS,
    NAN_ITEMS,
    NULL_ITEMS,
    ROLLUP_SQL,
    item,
    union,
)
from .derived import SAMPLE_TABLES, SampleTables, with_derived
from .group_queries import REFINED_SQL, close_sql, rollup_sql
from .registry import sample
from .total_queries import (
    ELECTRICITY_DERIVED,
    ELECTRICITY_SQL,
    HEAT_DERIVED,
    HEAT_SQL,
    PRIORITY_PARTS,
    PRIORITY_SQL,
)

# --- runs

RULES = [
    Rule("nulls", "null", NULL_ITEMS),
    Rule("nans", "nan", NAN_ITEMS),
    Rule("lengths", "time_series", LENGTH_ITEMS),
    Rule("clean", "null", [item("orders", "o_custkey"), item("orders", "o_orderkey")]),
    Rule("priorities", "reconcile", {"table": "home_orders", "column": "p_nom", "parts": PRIORITY_PARTS}),
    Rule("absent", "share_sums", {"table": "no_such_table", "column": "share", "member": "m", "group": "g"}),
]


def shown(results: DataFrame) -> DataFrame:
    """Comparable columns; a rule that could not run shows -1 for its counts."""
    counts = [f"coalesce({n}, -1) AS {n}" for n in ("total", "passed", "warnings", "failed")]
    return results.selectExpr("ordinal", "rule_name", "validation_type", "status", *counts)


def _number(rows: str, rules: list[Rule]) -> str:
    """Put the position and type of a rule beside its tallies."""
    values = ", ".join(f"({i}, '{r.name}', '{r.check}')" for i, r in enumerate(rules))
    return f"""
    SELECT CAST(n.ordinal AS integer) AS ordinal, n.rule_name, n.validation_type, t.status,
           t.total, t.passed, t.warnings, t.failed
    FROM (VALUES {values}) n(ordinal, rule_name, validation_type)
         JOIN ({rows}) t ON n.rule_name = t.rule_name"""


def _tally_sql(rule: str, items: str) -> str:
    return f"""
    SELECT '{rule}' AS rule_name,
           CASE WHEN count(CASE WHEN status = 'CRITICAL_FAILURE' THEN 1 END) > 0
                THEN 'CRITICAL_FAILURE'
                WHEN count(CASE WHEN status = 'WARNING' THEN 1 END) > 0 THEN 'WARNING'
                ELSE 'SUCCESS' END AS status,
           count(*) AS total, count(CASE WHEN status = 'SUCCESS' THEN 1 END) AS passed,
           count(CASE WHEN status = 'WARNING' THEN 1 END) AS warnings,
           count(CASE WHEN status = 'CRITICAL_FAILURE' THEN 1 END) AS failed
    FROM ({items}) items"""


RESULTS_SQL = union(
    _number(
        union(
            f"SELECT rule_name, status, total, passed, warnings, failed FROM ({ROLLUP_SQL}) r",
            _tally_sql("priorities", PRIORITY_SQL),
        ),
        RULES,
    ),
    "SELECT 5, 'absent', 'unknown', 'CRITICAL_FAILURE', -1, -1, -1, -1",
)
RUN_DERIVED = with_derived(
    "dirty_lineitem", "dirty_events", "dirty_embeddings", "home_orders", "home_capacities"
)
REPORT_SQL = """
    SELECT count(*) AS total_rules, count(CASE WHEN status = 'SUCCESS' THEN 1 END) AS passed_rules,
           count(CASE WHEN status <> 'SUCCESS' THEN 1 END) AS failed_rules,
           coalesce(string_agg(CASE WHEN status = 'SUCCESS' THEN rule_name END, ', '
                               ORDER BY rule_name), '') AS passed_names,
           coalesce(string_agg(CASE WHEN status <> 'SUCCESS' THEN rule_name END, ', '
                               ORDER BY rule_name), '') AS failed_names,
           CASE WHEN count(CASE WHEN status <> 'SUCCESS' THEN 1 END) > 0
                THEN 'CRITICAL_FAILURE' ELSE 'SUCCESS' END AS overall_status
    FROM ({results}) r"""


def shown_report(results: DataFrame) -> DataFrame:
    return run_rollup(results).select(
        "total_rules",
        "passed_rules",
        "failed_rules",
        F.array_join("passed_rule_names", ", ").alias("passed_names"),
        F.array_join("failed_rule_names", ", ").alias("failed_names"),
        "overall_status",
    )


@sample("run_results", RUN_DERIVED + RESULTS_SQL)
def run_results(tables: SampleTables) -> DataFrame:
    return shown(plan_run(tables, RULES))


@sample("run_rollup", RUN_DERIVED + REPORT_SQL.format(results=RESULTS_SQL))
def run_report(tables: SampleTables) -> DataFrame:
    return shown_report(plan_run(tables, RULES))


@sample(
    "run_subset",
    ALL_DERIVED
    + REPORT_SQL.format(
        results=f"SELECT * FROM ({ROLLUP_SQL}) r WHERE rule_name IN ('clean', 'lengths')"
    ),
)
def run_subset(tables: SampleTables) -> DataFrame:
    return shown_report(plan_run(tables, RULES, only=["clean", "lengths"]))


def _share_rollup_sql(table: str) -> str:
    return f"""
    SELECT CASE WHEN count(s.share_sum) = 0 THEN 'WARNING'
                WHEN count(CASE WHEN NOT ({close_sql("s.share_sum", "1.0", atol=1e-8)}) THEN 1 END) > 0
                THEN 'CRITICAL_FAILURE' ELSE 'SUCCESS' END AS status
    FROM (VALUES ('eGon2035'), ('eGon100RE')) requested(scenario)
         LEFT JOIN (SELECT bus_id, scenario, sum(profile_share) AS share_sum FROM {table}
                    GROUP BY bus_id, scenario) s ON requested.scenario = s.scenario
    GROUP BY requested.scenario"""


_ANNUAL_SQL = f"""
    SELECT p.scenario AS group_key, nuts3 AS member_key, actual, expected,
           {close_sql("actual", "expected")} AS is_strictly_close,
           {close_sql("actual", "expected", atol=1e-8)} AS is_close
    FROM (SELECT scenario, vg250_nuts3, sum(demand) AS actual FROM cell_demand d
               JOIN cell_map m ON d.zensus_population_id = m.zensus_population_id
          WHERE sector = 'residential' GROUP BY scenario, vg250_nuts3) p
         JOIN (SELECT year, scenario, nuts3, sum(demand) AS expected FROM household_demand
               GROUP BY year, scenario, nuts3) r
         ON p.scenario = r.scenario AND p.vg250_nuts3 = r.nuts3"""

SANITY_SQL = _number(
    union(
        _tally_sql("etrago_electricity_sanity", ELECTRICITY_SQL),
        _tally_sql("etrago_heat_sanity", HEAT_SQL),
        _tally_sql("residential_electricity_annual_sum", rollup_sql(_ANNUAL_SQL)),
        _tally_sql("residential_electricity_hh_refinement", rollup_sql(REFINED_SQL)),
        _tally_sql("cts_electricity_demand_share", _share_rollup_sql("building_shares")),
        _tally_sql("cts_heat_demand_share", _share_rollup_sql("exact_shares")),
    ),
    RULE_SETS["sanity_checks"],
)


@sample(
    "sanity_run",
    with_derived(
        *ELECTRICITY_DERIVED, *HEAT_DERIVED, "cell_demand", "cell_map", "refined",
        "building_shares", "exact_shares",
    )
    + SANITY_SQL,
)
def sanity_run(tables: SampleTables) -> DataFrame:
    """The shipped cross-table rules over the stand-in tables, as one plan."""
    return shown(plan_run(tables, RULE_SETS["sanity_checks"]))


def _null_count(table: str, column: str) -> str:
    return f"(SELECT count(*) FROM {table} WHERE {column} IS NULL)"


def _bad_count(table: str, column: str) -> str:
    return f"(SELECT count(*) FROM {table} WHERE isnan({column}) OR isinf({column}))"


_ARRAY_NAN = "len(list_filter(p_set, lambda v: isnan(v) OR isinf(v))) > 0"
# Invalid counts of the items of the three formal rules; 15 tables have no stand-in.
_FORMAL_COUNTS = {
    "critical_null_checks": [
        _null_count("household_demand", "demand"),
        _null_count("household_demand", "nuts3"),
        _null_count("household_demand", "scenario"),
        _null_count("power_plants", "el_capacity"),
        _null_count("power_plants", "carrier"),
        _null_count("bus", "carrier"),
    ],
    "critical_nan_checks": [
        _bad_count("household_demand", "demand"),
        _bad_count("power_plants", "el_capacity"),
        f"(SELECT count(*) FROM load_series WHERE {_ARRAY_NAN})",
    ],
    "time_series_completeness": [
        "(SELECT count(*) FROM load_series WHERE len(p_set) <> 8760)",
        *["-1"] * 15,
    ],
}
FORMAL_SQL = _number(
    f"""
    SELECT rule_name,
           CASE WHEN count(CASE WHEN invalid <> 0 THEN 1 END) > 0
                THEN 'CRITICAL_FAILURE' ELSE 'SUCCESS' END AS status,
           count(*) AS total, count(CASE WHEN invalid = 0 THEN 1 END) AS passed,
           CAST(0 AS bigint) AS warnings, count(CASE WHEN invalid <> 0 THEN 1 END) AS failed
    FROM ({union(*[
        f"SELECT '{rule}' AS rule_name, {count} AS invalid"
        for rule, counts in _FORMAL_COUNTS.items()
        for count in counts
    ])}) counted GROUP BY rule_name""",
    RULE_SETS["comprehensive"][:3],
)


@sample(
    "formal_run", with_derived("household_demand", "power_plants", "bus", "load_series") + FORMAL_SQL
)
def formal_run(tables: SampleTables) -> DataFrame:
    """The shipped column rules over the stand-in tables, most of which are missing."""
    return shown(plan_run(tables, RULE_SETS["comprehensive"], only=list(_FORMAL_COUNTS)))


def _series_item(i: int) -> tuple[str, str]:
    """Stand-in of the i-th series table: the readings of each order, customer or supplier, and how many lengths differ from the i-th."""
    table, key, value = (("lineitem", "l_orderkey", "l_quantity"), ("orders", "o_custkey", "o_totalprice"), ("events", "user_id", "value"), ("lineitem", "l_suppkey", "l_tax"))[i % 4]
    length = i // 4 + 1
    wrong = f"SELECT count(*) FROM (SELECT {key} FROM {table} GROUP BY {key} HAVING count({value}) <> {length})"
    return f"SELECT array_agg({value}) AS series FROM {{{table}}} GROUP BY {key}", wrong


_SERIES_CONFIG = [{**config, "expected_length": i // 4 + 1} for i, config in enumerate(RULE_SETS["comprehensive"][2].config)]


@sample(
    "formal_series_run",
    f"""
    SELECT CAST(0 AS integer) AS ordinal, 'time_series_completeness' AS rule_name, 'time_series' AS validation_type,
           CASE WHEN count(CASE WHEN wrong > 0 THEN 1 END) > 0 THEN 'CRITICAL_FAILURE' ELSE 'SUCCESS' END AS status,
           count(*) AS total, count(CASE WHEN wrong = 0 THEN 1 END) AS passed, CAST(0 AS bigint) AS warnings,
           count(CASE WHEN wrong > 0 THEN 1 END) AS failed
    FROM ({union(*[f"SELECT ({_series_item(i)[1]}) AS wrong" for i in range(len(_SERIES_CONFIG))])}) w""",
)
def formal_series_run(tables: SampleTables) -> DataFrame:
    """The shipped array-length rule with data in every one of its tables, most of other lengths."""
    files = {name: tables.files.table(name) for name in ("lineitem", "orders", "events")}
    frames = {
        config["table"]: tables.spark.sql(_series_item(i)[0], **files).withColumnRenamed("series", config["column"])
        for i, config in enumerate(_SERIES_CONFIG)
    }
    rule = Rule("time_series_completeness", "time_series", _SERIES_CONFIG)
    return shown(plan_run(FrameTables(tables.spark, frames), [rule]))


@sample("stored_run", RUN_DERIVED + RESULTS_SQL)
def stored_run(tables: SampleTables) -> DataFrame:
    """A run that writes its graded rows and results, read back from what it wrote."""
    folder = report_folder(tables.spark)
    result = run(tables, RULES, output=folder)
    return shown(history(tables.spark, folder).filter(F.col("run_id") == result.run_id))


@sample(
    "result_history",
    RUN_DERIVED
    + f"""
    SELECT 'tuesday' AS run_id, rule_name, status, failed, CAST(NULL AS varchar) AS status_before, false AS changed FROM ({RESULTS_SQL}) t
    UNION ALL
    SELECT 'monday', rule_name, status, failed, status, false FROM ({RESULTS_SQL}) m WHERE rule_name IN ('nulls', 'lengths')""",
)
def result_history(tables: SampleTables) -> DataFrame:
    """The results of two runs in one table; one run is repeated with other rules and replaces its own rows."""
    folder = report_folder(tables.spark)
    run(tables, RULES, only=["nulls", "clean"], run_id="monday", output=folder)
    run(tables, RULES, run_id="tuesday", output=folder)
    run(tables, RULES, only=["nulls", "lengths"], run_id="monday", output=folder)
    results = history(tables.spark, folder)
    changes = changed_rules(results).select("run_id", "rule_name", "status_before", "changed")
    return results.join(changes, ["run_id", "rule_name"]).select(
        "run_id", "rule_name", "status", F.coalesce("failed", F.lit(-1)).alias("failed"), "status_before", "changed"
    )


@sample(
    "custom_table_check",
    """SELECT CAST(0 AS integer) AS ordinal, 'orders_have_lines' AS rule_name, 'orphans' AS validation_type,
              CASE WHEN max(n) > 0 THEN 'CRITICAL_FAILURE' ELSE 'SUCCESS' END AS status, count(*) AS total,
              count(CASE WHEN n = 0 THEN 1 END) AS passed, CAST(0 AS bigint) AS warnings, count(CASE WHEN n > 0 THEN 1 END) AS failed
       FROM (SELECT o_orderpriority, count(CASE WHEN l_orderkey IS NULL THEN 1 END) AS n
             FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey FROM lineitem) ON o_orderkey = l_orderkey
             GROUP BY o_orderpriority) g""",
)
def custom_table_check(tables: SampleTables) -> DataFrame:
    """A cross-table check of one's own: orders without lines, by priority."""

    def orphans(tables, params):
        lines = tables.table("lineitem").select("l_orderkey").distinct()
        orders = tables.table("orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        found = orders.groupBy(params["by"]).agg(F.count_if(F.col("l_orderkey").isNull()).alias("n"))
        return found.select(F.when(F.col("n") > 0, "CRITICAL_FAILURE").otherwise("SUCCESS").alias("status"))

    register_table_check("orphans", orphans)
    return shown(plan_run(tables, [Rule("orders_have_lines", "orphans", {"table": "orders", "by": "o_orderpriority"})]))


# --- inventory and coverage, over the sample tables and the rules above

COVERAGE_RULES = [
    Rule("nulls", "null", [item("lineitem", "l_quantity"), item("orders", "o_totalprice"),
                           item("orders", "o_custkey"), item("no_such_table", "x")]),
    Rule("nans", "nan", [item("lineitem", "l_quantity"), item("events", "value")]),
    Rule("lengths", "time_series", [item("embeddings", "embedding", expected_length=64)]),
    Rule("shares", "share_sums", {"table": "lineitem", "column": "l_discount"}),
]
COVERAGE_TYPES = ["null", "nan", "share_sums", "time_series"]
_DECLARED = [
    (rule.name, rule.check, config["table"], config["column"])
    for rule in COVERAGE_RULES
    for config in (rule.config if isinstance(rule.config, list) else [rule.config])
]
CATALOG_SQL = (
    "(VALUES "
    + ", ".join(f"('{r}', '{k}', '{t}', '{c}')" for r, k, t, c in _DECLARED)
    + ") catalog(rule_name, check_type, table_name, column_name)"
)
# How many columns the sample tables have.
COLUMN_COUNTS = {
    "region": 2, "nation": 3, "customer": 5, "supplier": 4, "part": 6, "orders": 6, "lineitem": 11,
    "events": 6, "documents": 5, "embeddings": 3, "pages": 3, "benchmark": 2, "labels": 3,
    "conversations": 4,
}
INVENTORY_SQL = "(" + union(
    *[
        f"SELECT '{t}' AS table_name, CAST({COLUMN_COUNTS[t]} AS integer) AS column_count, "
        f"count(*) AS row_count FROM {t}"
        for t in SAMPLE_TABLES
    ]
) + ")"


def found_and_declared(tables: SampleTables) -> tuple[DataFrame, DataFrame]:
    return (
        coverage.inventory(tables.files),
        coverage.check_catalog(tables.spark, {"sample": COVERAGE_RULES}),
    )


@sample("table_inventory", f"SELECT table_name, column_count, row_count FROM {INVENTORY_SQL} i")
def table_inventory(tables: SampleTables) -> DataFrame:
    return coverage.inventory(tables.files).select("table_name", "column_count", "row_count")


@sample("catalog_inventory", f"SELECT table_name, column_count, row_count FROM {INVENTORY_SQL} i")
def catalog_inventory(tables: SampleTables) -> DataFrame:
    """The same tables as a database of the session catalog; system schemas are not listed."""
    spark, root = tables.spark, tables.files.root.rstrip("/")
    database = f"samples_{uuid.uuid5(uuid.NAMESPACE_URL, root).hex[:12]}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name in SAMPLE_TABLES:
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} USING parquet LOCATION '{root}/{name}.parquet'")
    found = coverage.inventory(CatalogTables(spark)).filter(F.col("schema_name") == database)
    short = F.substring_index("table_name", ".", -1).alias("table_name")
    return found.select(short, "column_count", "row_count")


@sample(
    "table_columns",
    f"""
    SELECT c.table_name, CAST(c.ordinal_position - 1 AS integer) AS ordinal, c.column_name, i.row_count
    FROM information_schema.columns c JOIN {INVENTORY_SQL} i ON c.table_name = i.table_name""",
)
def columns_of_tables(tables: SampleTables) -> DataFrame:
    """Columns in their order, beside the number of rows they hold."""
    sizes = coverage.inventory(tables.files).select("table_name", "row_count")
    columns = coverage.table_columns(tables.files).join(sizes, "table_name")
    return columns.select("table_name", "ordinal", "column_name", "row_count")


@sample(
    "inventory_summary",
    f"""SELECT CAST(1 AS bigint) AS total_schemas, count(*) AS total_tables,
               CAST(sum(column_count) AS bigint) AS total_columns, CAST(sum(row_count) AS bigint) AS total_rows
        FROM {INVENTORY_SQL} i""",
)
def inventory_summary(tables: SampleTables) -> DataFrame:
    return coverage.inventory_summary(coverage.inventory(tables.files))


@sample(
    "check_catalog",
    f"""
    SELECT c.table_name, c.column_name,
           string_agg(DISTINCT c.check_type, ', ' ORDER BY c.check_type) AS check_types,
           'sample' AS rule_sets, coalesce(max(i.row_count), -1) AS row_count
    FROM {CATALOG_SQL} LEFT JOIN {INVENTORY_SQL} i ON c.table_name = i.table_name
    GROUP BY c.table_name, c.column_name""".replace("catalog(", "c("),
)
def catalog_of_checks(tables: SampleTables) -> DataFrame:
    """Check types per column, beside the size of what they check."""
    found, catalog = found_and_declared(tables)
    sizes = found.select("table_name", "row_count")
    return coverage.covered_columns(catalog).join(sizes, "table_name", "left").select(
        "table_name",
        "column_name",
        F.array_join("check_types", ", ").alias("check_types"),
        F.array_join("rule_sets", ", ").alias("rule_sets"),
        F.coalesce("row_count", F.lit(-1)).alias("row_count"),
    )


@sample(
    "rule_tables",
    f"""
    SELECT c.rule_name, c.check_type, count(*) AS items, count(DISTINCT c.table_name) AS table_count,
           (SELECT CAST(sum(row_count) AS bigint) FROM {INVENTORY_SQL} i WHERE i.table_name IN
               (SELECT x.table_name FROM {CATALOG_SQL.replace("catalog(", "x(")}
                WHERE x.rule_name = c.rule_name)) AS row_count
    FROM {CATALOG_SQL} GROUP BY c.rule_name, c.check_type""".replace("catalog(", "c("),
)
def tables_of_rules(tables: SampleTables) -> DataFrame:
    """How many tables and rows every rule touches."""
    found, catalog = found_and_declared(tables)
    touched = coverage.rule_tables(catalog)
    rows = (
        touched.select("rule_name", F.explode("tables").alias("table_name"))
        .join(found, "table_name")
        .groupBy("rule_name")
        .agg(F.sum("row_count").alias("row_count"))
    )
    return touched.join(rows, "rule_name", "left").select(
        "rule_name", "check_type", "items", "table_count", "row_count"
    )


_TABLE_COVERAGE_SQL = f"""
    SELECT coalesce(i.table_name, d.table_name) AS table_name,
           i.table_name IS NOT NULL AS table_exists, d.table_name IS NOT NULL AS is_covered,
           coalesce(i.column_count, 0) AS column_count,
           coalesce(d.covered_columns, 0) AS covered_columns,
           coalesce(i.row_count, 0) AS row_count
    FROM {INVENTORY_SQL} i
         FULL JOIN (SELECT table_name, count(DISTINCT column_name) AS covered_columns
                    FROM {CATALOG_SQL} GROUP BY table_name) d ON i.table_name = d.table_name"""


@sample("column_coverage", _TABLE_COVERAGE_SQL)
def column_coverage(tables: SampleTables) -> DataFrame:
    return coverage.table_coverage(*found_and_declared(tables)).drop("schema_name", "covered_columns_found").fillna(0)


@sample(
    "uncovered_tables",
    f"""SELECT table_name, column_count, row_count FROM {INVENTORY_SQL} i
        WHERE table_name NOT IN (SELECT table_name FROM {CATALOG_SQL})""",
)
def tables_without_checks(tables: SampleTables) -> DataFrame:
    return coverage.uncovered_tables(*found_and_declared(tables)).drop("schema_name")


@sample(
    "coverage_summary",
    f"""
    SELECT count(CASE WHEN table_exists THEN 1 END) AS total_tables,
           count(CASE WHEN is_covered THEN 1 END) AS covered_tables,
           count(CASE WHEN is_covered AND table_exists THEN 1 END) AS covered_tables_found,
           count(CASE WHEN table_exists AND NOT is_covered THEN 1 END) AS uncovered_tables,
           CAST(sum(column_count) AS bigint) AS total_columns,
           CAST(sum(covered_columns) AS bigint) AS covered_columns,
           CAST(sum(row_count) AS bigint) AS total_rows,
           string_agg(CASE WHEN table_exists AND NOT is_covered THEN table_name END, ', '
                      ORDER BY table_name) AS uncovered_names,
           round(CAST(sum(covered_columns) AS double) / sum(column_count) * 100, 6)
               AS coverage_percentage
    FROM ({_TABLE_COVERAGE_SQL}) c""",
)
def summary_of_coverage(tables: SampleTables) -> DataFrame:
    return coverage.coverage_summary(*found_and_declared(tables)).select(
        "total_tables",
        "covered_tables",
        "covered_tables_found",
        "uncovered_tables",
        "total_columns",
        "covered_columns",
        "total_rows",
        F.array_join("uncovered_table_list", ", ").alias("uncovered_names"),
        F.round("coverage_percentage", 6).alias("coverage_percentage"),
    )


@sample(
    "coverage_found",
    f"""
    SELECT CAST(sum(covered_columns) AS bigint) + 1 AS covered_columns,
           CAST(sum(CASE WHEN table_exists THEN covered_columns ELSE 0 END) AS bigint) AS covered_columns_found,
           round(sum(CASE WHEN table_exists THEN covered_columns ELSE 0 END) * 100.0 / sum(column_count), 6)
               AS found_percentage
    FROM ({_TABLE_COVERAGE_SQL}) c""",
)
def coverage_found(tables: SampleTables) -> DataFrame:
    """One more column is declared that its table does not have; it is not found."""
    found, catalog = found_and_declared(tables)
    more = catalog.limit(1).withColumn("table_name", F.lit("orders")).withColumn("column_name", F.lit("o_nothing"))
    summary = coverage.coverage_summary(found, catalog.unionByName(more))
    return summary.select("covered_columns", "covered_columns_found", F.round("found_percentage", 6).alias("found_percentage"))


@sample(
    "coverage_matrix",
    "SELECT i.table_name, column_count, row_count, "
    + ", ".join(
        f"coalesce(string_agg(DISTINCT CASE WHEN check_type = '{k}' THEN column_name END, ', ' "
        f"ORDER BY CASE WHEN check_type = '{k}' THEN column_name END), '') AS checked_{k}"
        for k in COVERAGE_TYPES
    )
    + f""" FROM {INVENTORY_SQL} i LEFT JOIN {CATALOG_SQL} ON i.table_name = catalog.table_name
    GROUP BY i.table_name, column_count, row_count""",
)
def matrix(tables: SampleTables) -> DataFrame:
    found, catalog = found_and_declared(tables)
    cells = coverage.coverage_matrix(found, catalog, COVERAGE_TYPES)
    return cells.select(
        "table_name",
        "column_count",
        "row_count",
        *[F.col(f"`{k}`").alias(f"checked_{k}") for k in COVERAGE_TYPES],
    )


def report_folder(spark: SparkSession) -> str:
    """A new folder in the shared one the cluster names, or in its warehouse."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared.rstrip('/')}/report-{uuid.uuid4().hex}"


@sample(
    "report_roundtrip",
    f"""
    SELECT 'inventory' AS frame, count(*) AS n_rows, CAST(sum(row_count) AS bigint) AS measure
    FROM {INVENTORY_SQL} i
    UNION ALL SELECT 'columns', CAST(sum(column_count) AS bigint), 0 FROM {INVENTORY_SQL} i
    UNION ALL SELECT 'catalog', count(*), 0 FROM {CATALOG_SQL}
    UNION ALL SELECT 'table_coverage', count(*), CAST(sum(row_count) AS bigint)
              FROM ({_TABLE_COVERAGE_SQL}) c
    UNION ALL SELECT 'coverage_matrix', count(*), CAST(sum(row_count) AS bigint)
              FROM {INVENTORY_SQL} i
    UNION ALL SELECT 'coverage_summary', 1, CAST(sum(column_count) AS bigint) FROM {INVENTORY_SQL} i""",
)
def report_roundtrip(tables: SampleTables) -> DataFrame:
    """Write the report and count what is read back."""
    frames = write_report(tables.files, report_folder(tables.spark), "sample", COVERAGE_RULES)
    measures = {
        "inventory": "row_count",
        "columns": None,
        "catalog": None,
        "table_coverage": "row_count",
        "coverage_matrix": "row_count",
        "coverage_summary": "total_columns",
    }
    counts = [
        frames[name].agg(
            F.count(F.lit(1)).alias("n_rows"),
            (F.sum(column) if column else F.lit(0).cast("bigint")).alias("measure"),
        ).select(F.lit(name).alias("frame"), "n_rows", "measure")
        for name, column in measures.items()
    ]
    return reduce(DataFrame.unionByName, counts)
