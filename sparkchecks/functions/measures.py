"""Scalar and aggregate expressions over measures, texts and arrays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .exact import exact_sums

# Fixed value: what counts as a plain number. \z instead of $, because Java's $
# also matches before a trailing newline.
NUMERIC_TEXT = r"^[-+]?[0-9]*\.?[0-9]+([eE][-+]?[0-9]+)?\z"

_INF = float("inf")
_FLOATS = (T.FloatType, T.DoubleType)


def rounded_bigint(value: Column, dtype: T.DataType) -> Column:
    """Rounding cast to a whole number: half-even for floats, half away from zero otherwise.

    Spark's bare cast truncates.
    """
    if isinstance(dtype, _FLOATS):
        return F.rint(value).cast("bigint")
    return F.round(value, 0).cast("bigint")


def array_length(arr: Column, dtype: T.DataType) -> Column:
    """Number of elements over all dimensions; NULL for a NULL array."""
    while isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.ArrayType):
        arr, dtype = F.flatten(arr), dtype.elementType
    return F.array_size(arr)


def array_totals(df: DataFrame, keys: Sequence[str], elements: str, total: str = "total") -> DataFrame:
    """Exact sum of all array elements per ``keys``; arrays are exploded, which compiles to a loop.

    NULL elements are ignored. Keys whose arrays are NULL or empty have no row. The arrays of a
    task are reduced to a few rows per key before anything is shuffled.
    """
    parts = df.select(*keys, F.explode(elements).alias("_element"))
    return exact_sums(parts, keys, {total: F.col("_element")})


def not_a_number(value: Column, dtype: T.DataType, lexical: bool = False) -> Column:
    """True where a value is NaN, infinite or not numeric; never true for NULL.

    Numbers are judged by type and texts by ``NUMERIC_TEXT``. Booleans, dates,
    binary and nested values are never numbers. Arrays of numbers or texts are
    judged by their elements unless ``lexical`` asks for the reading of the
    whole array as one text, which no non-NULL array passes.
    """
    if isinstance(dtype, _FLOATS):
        return F.isnan(value) | (F.abs(value) == _INF)
    if isinstance(dtype, T.NumericType):
        return F.lit(False)
    if isinstance(dtype, T.StringType):
        return value.isNotNull() & ~value.rlike(NUMERIC_TEXT)
    if isinstance(dtype, T.ArrayType) and not lexical:
        element = dtype.elementType
        if isinstance(element, _FLOATS):
            # array_max and array_min compile to primitive loops, a lambda does
            # not. NaN is the largest value, so array_max finds it.
            top, bottom = F.array_max(value), F.array_min(value)
            return F.isnan(top) | (top == _INF) | (bottom == -_INF)
        if isinstance(element, T.NumericType):
            return F.lit(False)
        return F.exists(value, lambda v: not_a_number(v, element))
    return value.isNotNull()
