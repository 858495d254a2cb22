"""Validation of large tables with Spark."""

from .operators.batch import batch_rollup, batch_summary, column_check_items, column_items
from .operators.batch import run_column_checks
from .operators.columns import register_column_check
from .operators.reconcile import Part, reconcile
from .operators.tablechecks import register_table_check
from .operators.totals import Dimension, SeriesTotal, Total
from .plans.report import run_with_report, write_report
from .plans.runs import changed_rules, history, plan_run, run, run_rollup
from .plans.specs import RULE_SETS, Rule, rule_set
from .sources import CatalogTables, FileTables, FrameTables, JdbcTables, write_table

__all__ = [
    "RULE_SETS",
    "CatalogTables",
    "Dimension",
    "FileTables",
    "FrameTables",
    "JdbcTables",
    "Part",
    "Rule",
    "SeriesTotal",
    "Total",
    "batch_rollup",
    "batch_summary",
    "changed_rules",
    "column_check_items",
    "column_items",
    "history",
    "plan_run",
    "reconcile",
    "register_column_check",
    "register_table_check",
    "rule_set",
    "run",
    "run_column_checks",
    "run_rollup",
    "run_with_report",
    "write_report",
    "write_table",
]
