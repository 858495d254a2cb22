"""The monitoring report: inventory, coverage and thresholds, written together."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame

from ..operators import coverage
from ..sources.sinks import write_table
from ..sources.tables import Tables
from .runs import RunResult, run
from .specs import RULE_SETS, Rule


def write_report(
    tables: Tables,
    output: str,
    rule_set: str = "comprehensive",
    rules: Sequence[Rule] | None = None,
    fmt: str = "json",
) -> dict[str, DataFrame]:
    """Write the report frames under ``output`` and return them read back.

    The inventory counts every table, so it is written first and the frames that
    build on it start from the written rows.
    """
    rules = RULE_SETS[rule_set] if rules is None else rules
    output = output.rstrip("/")
    found = write_table(coverage.inventory(tables), f"{output}/inventory", fmt)
    catalog = coverage.check_catalog(tables.spark, {rule_set: rules})
    types = sorted({rule.check for rule in rules})
    frames = {
        "columns": coverage.table_columns(tables),
        "catalog": catalog,
        "covered_columns": coverage.covered_columns(catalog),
        "rule_tables": coverage.rule_tables(catalog),
        "table_coverage": coverage.table_coverage(found, catalog),
        "coverage_summary": coverage.coverage_summary(found, catalog),
        "coverage_matrix": coverage.coverage_matrix(found, catalog, types),
        "thresholds": coverage.thresholds(catalog),
    }
    written = {name: write_table(df, f"{output}/{name}", fmt) for name, df in frames.items()}
    return {"inventory": found, **written}


def run_with_report(
    tables: Tables,
    output: str,
    rule_set: str = "comprehensive",
    rules: Iterable[Rule] | None = None,
    **run_options,
) -> tuple[RunResult, Mapping[str, DataFrame]]:
    """A run and the report on its rule set, both written under ``output``."""
    rules = list(RULE_SETS[rule_set] if rules is None else rules)
    report = write_report(tables, f"{output.rstrip('/')}/report", rule_set, rules)
    result = run(tables, rules, output=f"{output.rstrip('/')}/runs", **run_options)
    return result, report
