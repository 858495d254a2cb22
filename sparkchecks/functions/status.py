"""Statuses and their ordering."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Item, rule and run statuses.
SUCCESS = "SUCCESS"
FAILED = "FAILED"
WARNING = "WARNING"
CRITICAL = "CRITICAL_FAILURE"


def severity(status: str) -> Column:
    """0 for success, 1 for a warning, 2 for anything else."""
    return F.expr(_severity(status))


def _severity(status: str) -> str:
    return f"CASE WHEN {status} = '{SUCCESS}' THEN 0 WHEN {status} = '{WARNING}' THEN 1 ELSE 2 END"


def worst_status(status: str) -> Column:
    """Aggregate: the most severe status of a group, SUCCESS for an empty one."""
    return F.expr(
        f"CASE max({_severity(status)}) WHEN 2 THEN '{CRITICAL}' WHEN 1 THEN '{WARNING}' "
        f"ELSE '{SUCCESS}' END"
    )


def status_tallies(status: str) -> dict[str, Column]:
    """Aggregates: how many statuses there are of each severity. A NULL status has failed."""
    return {
        "total": F.expr("count(1)"),
        "passed": F.expr(f"count_if({_severity(status)} = 0)"),
        "warnings": F.expr(f"count_if({_severity(status)} = 1)"),
        "failed": F.expr(f"count_if({_severity(status)} = 2)"),
    }
