"""Row layouts of the result tables. Every operator returns one of these."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


_TYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "array<int>": T.ArrayType(T.IntegerType()),
    "array<string>": T.ArrayType(T.StringType()),
    "map<string;double>": T.MapType(T.StringType(), T.DoubleType()),
}


def layout(columns: str) -> T.StructType:
    """A schema from ``"name type, …"``; unlike ``fromDDL`` it needs no session."""
    # A semicolon stands for the comma of a map type.
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[type_]) for name, type_ in pairs])


CHECK_ITEM = layout(
    "rule_name string, ordinal int, check_type string, table_name string, column_name string, "
    "status string, total_rows bigint, invalid_count bigint, invalid_rate double, "
    "expected_length int, found_lengths array<int>, details string, "
    "metrics map<string;double>, length_count bigint, min_length int, max_length int"
)

FOUND_LENGTH = layout("rule_name string, table_name string, column_name string, length int, arrays bigint")

RUN_REPORT = layout(
    "run_id string, total_rules bigint, passed_rules bigint, failed_rules bigint, passed_rule_names array<string>, "
    "failed_rule_names array<string>, overall_status string, ts timestamp"
)

RECONCILE_ITEM = layout(
    "rule_name string, scenario string, ordinal int, component string, input_total double, "
    "output_total double, deviation_percent double, status string, message string"
)

GROUP_ITEM = layout(
    "rule_name string, group_key string, member_key string, actual double, expected double, "
    "n_rows bigint, relative_error double, is_strictly_close boolean, is_close boolean"
)

GROUP_ROLLUP = layout(
    "rule_name string, group_key string, status string, mismatches bigint, total_members bigint, "
    "total_actual double, total_expected double, tolerance double, message string"
)

RULE_RESULT = layout(
    "run_id string, ordinal int, rule_name string, validation_type string, status string, "
    "table_name string, total bigint, passed bigint, warnings bigint, failed bigint, "
    "message string, error_details string, ts timestamp"
)

INVENTORY = layout(
    "schema_name string, table_name string, column_count int, columns array<string>, row_count bigint"
)

TABLE_COLUMN = layout(
    "table_name string, ordinal int, column_name string, data_type string, nullable boolean"
)

CATALOG = layout(
    "rule_set string, rule_name string, check_type string, table_name string, column_name string"
)

THRESHOLD = layout(
    "table_name string, column_name string, check_type string, comparator string, threshold double"
)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of ``schema``, in order and cast to its types.

    Columns the frame lacks are added as typed NULLs.
    """
    return df.to(schema)
