"""Wording of result messages, and a way to fill it in."""

from __future__ import annotations

import re

# Message formats of the result tables.
NULLS_FOUND = "Found {invalid} NULL values in {table}.{column} ({rows} rows checked)"
NO_NULLS_FOUND = "No NULL values found in {table}.{column} ({rows} rows checked)"
NANS_FOUND = "Found {invalid} NaN values in {table}.{column} ({rows} rows checked)"
NO_NANS_FOUND = "No NaN values found in {table}.{column} ({rows} rows checked)"
LENGTHS_WRONG = (
    "Found {invalid} time series with invalid length in {table}.{column}. "
    "Expected: {expected}, Found lengths: {lengths}, Total checked: {rows}"
)
LENGTHS_RIGHT = "All {rows} time series in {table}.{column} have correct length of {expected}"
CUSTOM_FOUND = "Found {invalid} invalid values in {table}.{column} ({rows} rows checked)"
NO_CUSTOM_FOUND = "No invalid values found in {table}.{column} ({rows} rows checked)"
EXECUTION_FAILED = "SQL execution failed: {error}"

BATCH_PASSED = "All {total} validations passed"
BATCH_FAILED = "{failed} of {total} validations failed: {names}"
BATCH_BROKEN = "Batch validation execution failed: {error}"

NOTHING_TO_DISTRIBUTE = "No capacity for '{component}' needed to be distributed"
NOT_DISTRIBUTED = "Capacity for '{component}' was not distributed at all"
NO_INPUT = "Capacity for '{component}' got distributed although no input capacity was provided"
COMPONENT_NOT_VALIDATED = "Failed to validate {component}"
WITHIN_TOLERANCE = "{component}: {deviation}% deviation (within tolerance)"
EXCEEDS_TOLERANCE = "{component}: {deviation}% deviation (exceeds tolerance of {tolerance}%)"

NO_GROUP_DATA = "No data found for {group}"
GROUP_NOT_VALIDATED = "Failed to validate {group}"
GROUP_MATCHES = "All sums match for {group}"
GROUP_DIFFERS = "Sums do not match for {group}"
SHARES_MATCH = "All shares equal 1.0 for {group}"
SHARES_DIFFER = "Shares do not sum to 1.0 for {group}"

RULE_COUNTS = "{passed}/{total} {members} passed"
CRITICAL_FOUND = "Found {failed} critical failures in {rule}"
WARNINGS_FOUND = "Found {warnings} warnings in {rule}"
NO_RULE_DATA = "No {subject} data found"
RULE_BROKEN = "Rule execution failed: {error}"


def quoted(text: str) -> str:
    """A text as SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def filled(template: str, **values: str) -> str:
    """SQL of the text with every ``{name}`` of the template replaced by an SQL expression."""
    names = re.findall(r"\{(\w+)\}", template)
    pattern = re.sub(r"\{\w+\}", "%s", template.replace("%", "%%"))
    return f"format_string({', '.join([quoted(pattern), *[values[name] for name in names]])})"
