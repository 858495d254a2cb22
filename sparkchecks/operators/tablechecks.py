"""Cross-table checks by name: what a rule's ``check`` refers to.

A table check builds a frame with one row per graded thing and a ``status``
column. The frame may come from any composition of DataFrame operations.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..sources.tables import Tables
from .groups import (
    first_mismatches,
    group_rollup,
    group_sum_items,
    mapped_sums,
    refinement_items,
    share_items,
    share_rollup,
)
from .reconcile import Reconciliation, reconcile_all
from .totals import matches

# Parameters of a rule that does not set them. Names of scenarios and years belong to a rule set.
DEFAULT_PERCENT = 5.0
DEFAULT_RTOL = 1e-5


Planner = Callable[[Tables, str, Mapping], DataFrame]


@dataclass(frozen=True)
class TableCheck:
    """``build(tables, rule_name, params)`` plans the graded rows.

    ``members`` is what the rows are called in messages. ``is_empty`` is an
    aggregate over them, in SQL, that tells whether there was no data to check.
    """

    check_type: str
    build: Planner
    members: str = "validations"
    is_empty: str = "false"


@dataclass(frozen=True)
class GroupedCheck:
    """A table check whose rows roll up graded members, of which it lists mismatches."""

    check_type: str
    items: Planner
    rollup: Callable[[DataFrame, str, Mapping], DataFrame]
    listed: int
    members: str
    is_empty: str = "false"

    def build(self, tables: Tables, rule_name: str, params: Mapping) -> DataFrame:
        return self.rollup(self.items(tables, rule_name, params), rule_name, params)

    def mismatches(self, items: DataFrame, rollup: DataFrame) -> DataFrame:
        return first_mismatches(items, self.listed, rollup)


def _reconcile(tables: Tables, rule_name: str, params: Mapping) -> DataFrame:
    return reconcile_all(tables, [reconciliation(rule_name, params)])


def reconciliation(rule_name: str, params: Mapping) -> Reconciliation:
    """What a reconciliation rule asks for."""
    bound = {**specs_defaults(), **{k: params[k] for k in ("scenario", "year") if k in params}}
    return Reconciliation(
        rule_name,
        params["parts"],
        params.get("tolerance", DEFAULT_PERCENT),
        bound,
        params.get("broken"),
    )


def specs_defaults() -> dict:
    """Scenario and year of the shipped rule sets, for rules that set none."""
    from ..plans import specs

    return {"scenario": specs.DEFAULT_SCENARIO, "year": specs.DEFAULT_YEAR}


def _scenarios(params: Mapping) -> Sequence[str]:
    from ..plans import specs

    return params.get("scenarios", specs.SCENARIOS)


def group_sum_plan(tables: Tables, rule_name: str, params: Mapping) -> DataFrame:
    """Graded regions of a group-sum rule."""
    scenarios = _scenarios(params)
    detail = tables.table(params["table"]).filter(matches(params.get("filters", {}), params))
    sums = mapped_sums(
        detail,
        tables.table(params["mapping_table"]),
        params["mapping_key"],
        params["group"],
        params["mapping_region"],
        params["column"],
        scenarios,
    )
    return group_sum_items(
        sums,
        tables.table(params["reference_table"]),
        rule_name,
        params.get("tolerance", DEFAULT_RTOL),
        params["reference_group"],
        params["reference_region"],
        params["reference_value"],
        scenarios,
        params.get("reference_subgroup"),
    )


def _requested_rollup(items: DataFrame, rule_name: str, params: Mapping) -> DataFrame:
    return group_rollup(
        items,
        rule_name,
        params.get("tolerance", DEFAULT_RTOL),
        _scenarios(params),
    )


def refinement_plan(tables: Tables, rule_name: str, params: Mapping) -> DataFrame:
    """Graded regions of a refinement rule."""
    return refinement_items(
        tables.table(params["table"]),
        rule_name,
        params.get("tolerance", DEFAULT_RTOL),
        params["region"],
        params["code"],
        params["cell"],
        params["original"],
        params["column"],
    )


def _found_rollup(items: DataFrame, rule_name: str, params: Mapping) -> DataFrame:
    return group_rollup(items, rule_name, params.get("tolerance", DEFAULT_RTOL))


def share_plan(tables: Tables, rule_name: str, params: Mapping) -> DataFrame:
    """Graded members of a share rule."""
    return share_items(
        tables.table(params["table"]),
        rule_name,
        params.get("tolerance", DEFAULT_RTOL),
        params["member"],
        params["group"],
        params["column"],
    )


def _share_rollup(items: DataFrame, rule_name: str, params: Mapping) -> DataFrame:
    return share_rollup(
        items,
        rule_name,
        params.get("tolerance", DEFAULT_RTOL),
        _scenarios(params),
    )


# How many mismatches are listed per group.
_CHECKS: dict[str, TableCheck | GroupedCheck] = {
    "reconcile": TableCheck("reconcile", _reconcile),
    "group_sums": GroupedCheck("group_sums", group_sum_plan, _requested_rollup, 10, "scenarios"),
    "refinement": GroupedCheck(
        "refinement", refinement_plan, _found_rollup, 5, "characteristics", "count(status) = 0"
    ),
    "share_sums": GroupedCheck(
        "share_sums", share_plan, _share_rollup, 10, "scenarios", "max(source_rows) = 0"
    ),
}


def table_check(check_type: str) -> TableCheck | GroupedCheck:
    if check_type not in _CHECKS:
        raise LookupError(f"Unknown table check: {check_type}")
    return _CHECKS[check_type]


def register_table_check(
    check_type: str, build: Callable[[Tables, Mapping], DataFrame], members: str = "validations"
) -> None:
    """Add a cross-table check of your own: ``build(tables, params)`` returns rows with a status."""

    def planned(tables: Tables, rule_name: str, params: Mapping) -> DataFrame:
        rows = build(tables, params)
        if "status" not in rows.columns:
            raise ValueError(f"{check_type}: the frame has no status column")
        return rows

    _CHECKS[check_type] = TableCheck(check_type, planned, members)
