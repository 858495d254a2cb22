"""What tables there are, which columns have checks, and whether metrics pass."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import CATALOG, INVENTORY, TABLE_COLUMN, THRESHOLD, conform, layout
from ..sources.tables import Tables, local_rows, split_name

_log = logging.getLogger(__name__)

#: Tables opened side by side; opening one reads its schema from its files or its database.
OPENED_TOGETHER = 16


def _readable(tables: Tables) -> list[tuple[str, DataFrame]]:
    """Tables that can be opened, in order; others are skipped with a warning."""

    def opened(name: str) -> DataFrame | None:
        try:
            return tables.table(name)
        except Exception as error:
            _log.warning("Failed to analyze table %s: %s", name, (str(error) or type(error).__name__).splitlines()[0])
            return None

    names = tables.names()
    with ThreadPoolExecutor(max_workers=OPENED_TOGETHER) as pool:
        frames = pool.map(inheritable_thread_target(tables.spark)(opened), names)
        return [(name, df) for name, df in zip(names, frames, strict=True) if df is not None]


def table_columns(tables: Tables) -> DataFrame:
    """One row per table and column, with position, type and nullability."""
    rows = [
        {
            "table_name": name,
            "ordinal": i,
            "column_name": field.name,
            "data_type": field.dataType.simpleString(),
            "nullable": field.nullable,
        }
        for name, df in _readable(tables)
        for i, field in enumerate(df.schema.fields)
    ]
    return local_rows(tables.spark, rows, TABLE_COLUMN)


def inventory(tables: Tables) -> DataFrame:
    """One row per table with its columns and exact row count.

    Counts read no column, so for parquet they come from the file footers. A source
    of files counts all tables in one scan, whose plan doesn't grow with their
    number; other sources have one aggregation per table in one plan.
    """
    found = _readable(tables)
    if not found:
        return local_rows(tables.spark, [], INVENTORY)
    counts = tables.row_counts([name for name, _ in found])
    if counts is None:
        counts = _united([df.agg(F.count(F.lit(1)).alias("row_count")).withColumn("table_name", F.lit(name)) for name, df in found])
    described = [
        {
            "schema_name": split_name(name)[0],
            "table_name": name,
            "column_count": len(df.columns),
            "columns": list(df.columns),
        }
        for name, df in found
    ]
    known = local_rows(
        tables.spark, described, layout("schema_name string, table_name string, column_count int, columns array<string>")
    )
    return conform(known.join(counts, "table_name", "left").fillna(0, ["row_count"]), INVENTORY)


def _united(frames: list[DataFrame]) -> DataFrame:
    """One frame of many, as a tree: a chain of unions is analyzed anew at each step."""
    while len(frames) > 1:
        frames = [reduce(DataFrame.unionByName, frames[i : i + 32]) for i in range(0, len(frames), 32)]
    return frames[0]


def inventory_summary(tables_found: DataFrame) -> DataFrame:
    """One row: totals of schemas, tables, columns and rows."""
    return tables_found.agg(
        F.expr("count(DISTINCT schema_name) AS total_schemas"),
        F.expr("count(1) AS total_tables"),
        F.expr("coalesce(sum(column_count), 0) AS total_columns"),
        F.expr("coalesce(sum(row_count), 0) AS total_rows"),
    )


def check_catalog(spark: SparkSession, rule_sets: Mapping[str, Sequence]) -> DataFrame:
    """One row per declared check: rule set, rule, check type, table and column.

    Rules whose configuration names no table and column declare none.
    """
    rows = []
    for set_name, rules in rule_sets.items():
        for rule in rules:
            configs = rule.config if isinstance(rule.config, (list, tuple)) else [rule.config]
            rows += [
                {
                    "rule_set": set_name,
                    "rule_name": rule.name,
                    "check_type": rule.check,
                    "table_name": config["table"],
                    "column_name": config["column"],
                }
                for config in configs
                if "table" in config and "column" in config
            ]
    return local_rows(spark, rows, CATALOG)


def covered_columns(catalog: DataFrame) -> DataFrame:
    """Check types and rule sets per (table, column), as sorted arrays."""
    return catalog.groupBy("table_name", "column_name").agg(
        F.sort_array(F.collect_set("check_type")).alias("check_types"),
        F.sort_array(F.collect_set("rule_set")).alias("rule_sets"),
    )


def rule_tables(catalog: DataFrame) -> DataFrame:
    """How many tables every rule touches, and which."""
    return catalog.groupBy("rule_set", "rule_name", "check_type").agg(
        F.count(F.lit(1)).alias("items"),
        F.count_distinct("table_name").alias("table_count"),
        F.sort_array(F.collect_set("table_name")).alias("tables"),
    )


def table_coverage(tables_found: DataFrame, catalog: DataFrame) -> DataFrame:
    """One row per table that exists or is named by a check.

    ``table_exists`` tells the two apart: a check may name a table that is not there.
    ``covered_columns`` are those declared, ``covered_columns_found`` those of them
    that the table has.
    """
    named = catalog.groupBy("table_name").agg(F.collect_set("column_name").alias("named"))
    declared = named.select("table_name", "named", F.size("named").cast("bigint").alias("covered_columns"))
    found = tables_found.select(
        "table_name", "schema_name", "column_count", "row_count", "columns", F.lit(True).alias("found")
    )
    return found.join(declared, "table_name", "full").select(
        "schema_name",
        "table_name",
        F.coalesce("found", F.lit(False)).alias("table_exists"),
        F.col("covered_columns").isNotNull().alias("is_covered"),
        "column_count",
        F.coalesce("covered_columns", F.lit(0).cast("bigint")).alias("covered_columns"),
        F.coalesce(F.size(F.array_intersect("named", "columns")), F.lit(0)).cast("bigint").alias("covered_columns_found"),
        "row_count",
    )


def uncovered_tables(tables_found: DataFrame, catalog: DataFrame) -> DataFrame:
    """Tables no check names."""
    return tables_found.join(catalog.select("table_name"), "table_name", "left_anti").select(
        "schema_name", "table_name", "column_count", "row_count"
    )


def coverage_summary(tables_found: DataFrame, catalog: DataFrame) -> DataFrame:
    """One row of counts, with the covered columns in percent of all columns.

    Covered tables and columns are those declared, whether they exist or not, so
    ``coverage_percentage`` may exceed 100. ``covered_tables_found``,
    ``covered_columns_found`` and ``found_percentage`` count only those that exist.
    """
    per_table = table_coverage(tables_found, catalog)
    exists, covered = F.col("table_exists"), F.col("is_covered")
    counted = per_table.agg(
        F.count_distinct("schema_name").alias("total_schemas"),
        F.count_if(exists).alias("total_tables"),
        F.count_if(covered).alias("covered_tables"),
        F.count_if(covered & exists).alias("covered_tables_found"),
        F.count_if(exists & ~covered).alias("uncovered_tables"),
        F.coalesce(F.sum("column_count"), F.lit(0)).alias("total_columns"),
        F.coalesce(F.sum("covered_columns"), F.lit(0)).alias("covered_columns"),
        F.coalesce(F.sum("covered_columns_found"), F.lit(0)).alias("covered_columns_found"),
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("total_rows"),
        F.sort_array(F.collect_list(F.when(exists & ~covered, F.col("table_name")))).alias(
            "uncovered_table_list"
        ),
    )


    def percent(part: str) -> Column:
        return F.coalesce(F.try_divide(part, "total_columns") * 100, F.lit(0.0))

    return counted.withColumns(
        {"coverage_percentage": percent("covered_columns"), "found_percentage": percent("covered_columns_found")}
    )


def coverage_matrix(
    tables_found: DataFrame, catalog: DataFrame, check_types: Sequence[str]
) -> DataFrame:
    """Tables by check types: the covered columns, joined by a comma; empty if none."""
    cells = (
        catalog.groupBy("table_name")
        .pivot("check_type", list(check_types))
        .agg(F.array_join(F.sort_array(F.collect_set("column_name")), ", "))
    )
    return (
        tables_found.select("schema_name", "table_name", "column_count", "row_count")
        .join(cells, "table_name", "left")
        .select(
            "schema_name",
            "table_name",
            "column_count",
            "row_count",
            *[F.coalesce(F.col(f"`{t}`"), F.lit("")).alias(t) for t in check_types],
        )
        .orderBy("schema_name", "table_name")
    )


def thresholds(catalog: DataFrame) -> DataFrame:
    """What the metric of a declared check is held to: NULL counts must equal 0.

    Other column checks carry no threshold.
    """
    column_checks = catalog.filter(F.col("check_type").isin("null", "time_series"))
    is_null_check = F.col("check_type") == "null"
    return conform(
        column_checks.select(
            "table_name",
            "column_name",
            "check_type",
            F.when(is_null_check, "equal_to").alias("comparator"),
            F.when(is_null_check, 0.0).alias("threshold"),
        ).distinct(),
        THRESHOLD,
    )


def evaluate_thresholds(items: DataFrame, limits: DataFrame) -> DataFrame:
    """Hold measured ``check_item`` rows to their thresholds; NULL where there is none."""
    measured = items.select(
        "table_name", "column_name", "check_type", "total_rows", "invalid_count"
    )
    passes = F.when(
        F.col("comparator") == "equal_to", F.col("invalid_count") == F.col("threshold")
    )
    return measured.join(limits, ["table_name", "column_name", "check_type"]).withColumn(
        "is_pass", passes
    )
