"""Reconciliation of upstream input totals with downstream output totals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import texts
from ..functions.compare import classify_deviation
from ..functions.status import CRITICAL
from ..schemas import RECONCILE_ITEM, conform, layout
from ..sources.tables import Tables, local_rows
from .totals import SeriesTotal, Total, planned_totals

_EXPECTED = layout("rule int, component string, ordinal int, broken string, tolerance double")


@dataclass(frozen=True)
class Part:
    """Components whose totals come from the same tables; a failure affects the part only.

    Several inputs or outputs of a component are added up.
    """

    components: Sequence[str]
    inputs: Sequence[Total | SeriesTotal]
    outputs: Sequence[Total | SeriesTotal]


@dataclass(frozen=True)
class Reconciliation:
    """A rule to reconcile; ``broken`` lists parts known to fail, with their error."""

    rule_name: str
    parts: Sequence[Part]
    tolerance: float
    params: Mapping
    broken: Mapping[int, str] | None = None


def grade_components(expected: DataFrame, totals: DataFrame) -> DataFrame:
    """Grade every expected component; absent totals count as 0.

    ``expected`` has (rule, component, ordinal, broken, tolerance), the totals
    (rule, component, i, o) with one of i and o. They are stacked and grouped
    once, so a missing side needs no outer join. Totals of components that are
    not expected are dropped.
    """
    stacked = expected.unionByName(totals, allowMissingColumns=True)
    graded = (
        stacked.groupBy("rule", "component")
        .agg(
            F.max("ordinal").alias("ordinal"),
            F.max("broken").alias("broken"),
            F.max("tolerance").alias("tolerance"),
            F.coalesce(F.sum("i"), F.lit(0.0)).alias("input_total"),
            F.coalesce(F.sum("o"), F.lit(0.0)).alias("output_total"),
        )
        .filter(F.col("ordinal").isNotNull())
    )
    verdict = classify_deviation("component", "input_total", "output_total", "tolerance")
    failure = texts.filled(
        texts.COMPONENT_NOT_VALIDATED + ": {error}", component="component", error="broken"
    )
    graded = graded.select(
        "rule", "component", "ordinal", "broken", "input_total", "output_total",
        *[column.alias(name) for name, column in verdict.items()],
    )
    # A component without a deviation was not validated and shows no totals.
    known = "broken IS NULL AND deviation_percent IS NOT NULL"
    return graded.selectExpr(
        "rule",
        "component",
        "ordinal",
        *[
            f"CASE WHEN {known} THEN {name} END AS {name}"
            for name in ("input_total", "output_total", "deviation_percent")
        ],
        f"CASE WHEN broken IS NOT NULL THEN '{CRITICAL}' ELSE status END AS status",
        f"CASE WHEN broken IS NOT NULL THEN {failure} ELSE message END AS message",
    )


def reconcile_all(tables: Tables, rules: Sequence[Reconciliation]) -> DataFrame:
    """``reconcile_item`` rows of all parts of all rules, one per expected component.

    Tables are read once for all of them. A part whose tables or columns are
    missing, or that is listed as broken, gets critical rows; the other parts
    are graded as usual.
    """
    wanted: list = []
    side: dict[int, tuple[int, int, str]] = {}  # rule, part and side of each total
    for r, rule in enumerate(rules):
        for i, part in enumerate(rule.parts):
            if (rule.broken or {}).get(i) is None:
                for name, totals in (("i", part.inputs), ("o", part.outputs)):
                    for total in totals:
                        side[len(wanted)] = (r, i, name)
                        wanted.append((len(wanted), total, rule.params))
    frames, errors = planned_totals(tables, wanted)
    failed: dict[tuple[int, int], str] = {}
    for number, error in sorted(errors.items()):
        failed.setdefault(side[number][:2], error)
    expected, named = [], []
    for r, rule in enumerate(rules):
        ordinal = 0
        named.append({"rule": r, "rule_name": rule.rule_name, "scenario": rule.params.get("scenario")})
        for i, part in enumerate(rule.parts):
            error = (rule.broken or {}).get(i) or failed.get((r, i))
            for component in part.components:
                row = {"rule": r, "component": component, "ordinal": ordinal, "broken": error}
                expected.append({**row, "tolerance": float(rule.tolerance)})
                ordinal += 1
    none = local_rows(tables.spark, [], layout("total_id int, component string, total double"))
    totals = reduce(DataFrame.unionByName, frames or [none])
    # A total of a part that failed is left out with it.
    sides = {n: s for n, s in side.items() if s[:2] not in failed}
    totals = totals.selectExpr(
        f"element_at({_places({n: s[0] for n, s in sides.items()})}, total_id) AS rule",
        "component",
        *[
            f"CASE WHEN element_at({_places({n: int(s[2] == name) for n, s in sides.items()})}, total_id) = 1 "
            f"THEN total END AS {name}"
            for name in ("i", "o")
        ],
    ).filter("rule IS NOT NULL")
    items = grade_components(local_rows(tables.spark, expected, _EXPECTED), totals)
    rule_names = F.element_at(F.array(*[F.lit(n["rule_name"]) for n in named]), F.col("rule") + 1)
    scenarios = F.element_at(F.array(*[F.lit(n["scenario"]).cast("string") for n in named]), F.col("rule") + 1)
    return conform(items.withColumns({"rule_name": rule_names, "scenario": scenarios}), RECONCILE_ITEM)


def _places(numbers: Mapping[int, int]) -> str:
    """SQL of a literal map of whole numbers."""
    return f"map({', '.join(f'{k}, {v}' for k, v in numbers.items())})" if numbers else "map(-1, -1)"


def reconcile(
    tables: Tables,
    rule_name: str,
    parts: Sequence[Part],
    tolerance: float,
    params: Mapping,
    broken: Mapping[int, str] | None = None,
) -> DataFrame:
    """``reconcile_item`` rows of one rule."""
    return reconcile_all(tables, [Reconciliation(rule_name, parts, tolerance, params, broken)])
