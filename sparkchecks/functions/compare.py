"""Tolerance comparison of two columns.

Spark orders NaN above every number and treats NaN = NaN as true, so a plain
``abs(a - d) <= tol`` is wrong for NaN and infinities. All comparisons of
measures in this package go through this module. Operands are column names or
SQL expressions: one parsed expression is far cheaper to build from Python than
the same tree of Column calls.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import texts
from .status import CRITICAL, SUCCESS, WARNING

# Fixed value: absolute tolerance of the loose comparison.
LOOSE_ATOL = 1e-8

_INF = "double('Infinity')"


def close(actual: str, desired: str, rtol: float, atol: float, nan_equal: bool) -> Column:
    """``|actual - desired| <= atol + rtol * |desired|``, infinities only equal themselves."""
    return F.expr(
        f"""CASE
            WHEN {actual} IS NULL OR {desired} IS NULL THEN NULL
            WHEN isnan({actual}) OR isnan({desired})
                THEN {str(nan_equal).lower()} AND isnan({actual}) AND isnan({desired})
            WHEN abs({actual}) = {_INF} OR abs({desired}) = {_INF} THEN {actual} = {desired}
            ELSE abs({actual} - {desired}) <= {atol!r}D + {rtol!r}D * abs({desired})
        END"""
    )


def strictly_close(actual: str, desired: str, rtol: float) -> Column:
    """Relative tolerance only; NaN equals NaN. Decides the status of a group."""
    return close(actual, desired, rtol, atol=0.0, nan_equal=True)


def loosely_close(actual: str, desired: str, rtol: float) -> Column:
    """Relative plus a small absolute tolerance; NaN equals nothing. Decides what is listed."""
    return close(actual, desired, rtol, atol=LOOSE_ATOL, nan_equal=False)


def relative_error(actual: str, expected: str) -> Column:
    """``|actual - expected| / expected``, +inf for an expected zero. The divisor keeps its sign."""
    return F.expr(
        f"""CASE WHEN {expected} <> 0 THEN abs({actual} - {expected}) / {expected}
                 WHEN {expected} = 0 THEN {_INF} END"""
    )


def percent_deviation(input_total: str, output_total: str) -> str:
    """SQL of the deviation of an output from its input in percent; NULL for a zero input."""
    return f"try_divide({output_total} - {input_total}, {input_total}) * 100"


def classify_deviation(
    component: str, input_total: str, output_total: str, tolerance: float | str
) -> dict[str, Column]:
    """Grade an output total against its input total.

    Returns the columns ``deviation_percent``, ``status`` and ``message``. Cases
    are tried in order: nothing on both sides, nothing came out, something came
    out of nothing, then the percent deviation. A zero input that none of these
    covers cannot be graded and is critical without a deviation. ``tolerance`` is
    a number, or the name of a double column.
    """
    column = isinstance(tolerance, str)
    limit = tolerance if column else f"{float(tolerance)!r}D"
    i, o = input_total, output_total
    nothing = f"{i} = 0 AND {o} = 0"
    lost = f"{i} > 0 AND NOT isnan({i}) AND {o} = 0"
    invented = f"{o} > 0 AND NOT isnan({o}) AND {i} = 0"
    ungradable = f"{i} = 0"
    deviation = percent_deviation(i, o)
    # abs(NaN) <= tolerance is false in Spark too: NaN is the largest value.
    within = f"abs({deviation}) <= {limit}"

    def cases(*results: str) -> Column:
        branches = zip((nothing, lost, invented, ungradable, within), results)
        whens = " ".join(f"WHEN {condition} THEN {result}" for condition, result in branches)
        return F.expr(f"CASE {whens} ELSE {results[-1]} END")

    def text(template: str) -> str:
        return texts.filled(
            template,
            component=component,
            deviation=f"format_string('%.2f', {deviation})",
            tolerance=f"cast({tolerance} AS string)" if column else f"'{float(tolerance)}'",
        )

    return {
        "deviation_percent": cases("0D", "-100D", _INF, "NULL", deviation, deviation),
        "status": cases(
            *(f"'{s}'" for s in (SUCCESS, CRITICAL, CRITICAL, CRITICAL, SUCCESS, WARNING))
        ),
        "message": cases(
            text(texts.NOTHING_TO_DISTRIBUTE),
            text(texts.NOT_DISTRIBUTED),
            text(texts.NO_INPUT),
            text(texts.COMPONENT_NOT_VALIDATED),
            text(texts.WITHIN_TOLERANCE),
            text(texts.EXCEEDS_TOLERANCE),
        ),
    }
