"""Column checks as aggregate expressions.

A check turns a column into the aggregates that decide it, so that all checks of
a table, built-in or registered by a user, share one pass over it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import texts
from ..functions.measures import array_length, not_a_number

# Fixed value: hours of a year.
DEFAULT_LENGTH = 8760

Metrics = dict[str, Column]


@dataclass(frozen=True)
class ColumnCheck:
    """``metrics(column, dtype, params)`` gives aggregates, among them ``invalid_count``.

    ``by_length`` checks are counted from the rows of distinct array lengths instead.
    """

    check_type: str
    metrics: Callable[[Column, T.DataType, Mapping], Metrics]
    failed_text: str
    passed_text: str
    by_length: bool = False


def null_metrics(column: Column, dtype: T.DataType, params: Mapping) -> Metrics:
    return {"invalid_count": F.count_if(column.isNull())}


def nan_metrics(column: Column, dtype: T.DataType, params: Mapping) -> Metrics:
    return {"invalid_count": F.count_if(not_a_number(column, dtype, params.get("lexical", False)))}


def length_metrics(column: Column, dtype: T.DataType, params: Mapping) -> Metrics:
    """NULL arrays are neither right nor wrong."""
    if not isinstance(dtype, T.ArrayType):
        raise TypeError(f"array column expected, found {dtype.simpleString()}")
    length = array_length(column, dtype)
    return {  # the lengths themselves are rows of a pass of their own
        "invalid_count": F.count_if(length != params.get("expected_length", DEFAULT_LENGTH)),
    }


_CHECKS: dict[str, ColumnCheck] = {
    "null": ColumnCheck("null", null_metrics, texts.NULLS_FOUND, texts.NO_NULLS_FOUND),
    "nan": ColumnCheck("nan", nan_metrics, texts.NANS_FOUND, texts.NO_NANS_FOUND),
    "time_series": ColumnCheck(
        "time_series", length_metrics, texts.LENGTHS_WRONG, texts.LENGTHS_RIGHT, by_length=True
    ),
}


def column_check(check_type: str) -> ColumnCheck:
    if check_type not in _CHECKS:
        raise LookupError(f"Unknown column check: {check_type}")
    return _CHECKS[check_type]


def is_column_check(check_type: str) -> bool:
    return check_type in _CHECKS


def register_column_check(
    check_type: str, metrics: Callable[[Column, Mapping], Mapping[str, Column]]
) -> None:
    """Add a check of your own.

    ``metrics(column, params)`` returns aggregate expressions; ``invalid_count``
    is required and decides the status. Others are reported as doubles in the
    ``metrics`` of the check's row.
    """

    def checked(column: Column, dtype: T.DataType, params: Mapping) -> Metrics:
        found = dict(metrics(column, params))
        if "invalid_count" not in found:
            raise ValueError(f"{check_type}: expected the metric invalid_count, got {sorted(found)}")
        return found

    _CHECKS[check_type] = ColumnCheck(
        check_type, checked, texts.CUSTOM_FOUND, texts.NO_CUSTOM_FOUND
    )
