"""Column checks: NULLs, NaN, array lengths, batches, errors and custom checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkchecks import Rule, batch_rollup, batch_summary, column_check_items, column_items
from sparkchecks import register_column_check, run_column_checks
from sparkchecks.operators.batch import found_lengths as length_rows_of
from sparkchecks.operators.coverage import check_catalog, evaluate_thresholds, thresholds

from .derived import SampleTables, with_derived
from .registry import sample


def item(table: str, column: str, **params) -> dict:
    return {"table": table, "column": column, **params}


NULL_ITEMS = [
    item("dirty_lineitem", "l_quantity"),
    item("dirty_lineitem", "l_extendedprice"),
    item("orders", "o_totalprice"),
    item("orders", "o_orderpriority"),
]
NAN_ITEMS = [
    item("dirty_events", "value"),
    item("dirty_events", "amount"),
    item("dirty_events", "user_id"),
    item("dirty_events", "ts"),
]
TEXT_ITEMS = [item("dirty_events", "reading"), item("dirty_events", "code")]
ARRAY_ITEMS = [
    item("dirty_embeddings", "noisy"),
    item("dirty_embeddings", "noisy", lexical=True),
    item("embeddings", "embedding"),
]
LENGTH_ITEMS = [
    item("dirty_embeddings", "embedding", expected_length=64),
    item("embeddings", "embedding", expected_length=64),
]
BROKEN_ITEMS = [
    item("lineitem", "l_quantity"),
    item("lineitem", "no_such_column"),
    item("no_such_table", "x"),
    item("dirty_lineitem", "l_quantity"),
]


def shown(items: DataFrame) -> DataFrame:
    """The comparable columns of ``check_item`` rows."""
    return items.select(
        "rule_name",
        "ordinal",
        "check_type",
        "table_name",
        "column_name",
        "status",
        "total_rows",
        "invalid_count",
        F.round("invalid_rate", 6).alias("invalid_rate"),
    )


def checked(
    rule: str, check: str, ordinal: int, table: str, column: str, invalid: str, source: str | None = None
) -> str:
    """The SQL counterpart of one item: its row from counts over the whole table."""
    return f"""
        SELECT '{rule}' AS rule_name, CAST({ordinal} AS integer) AS ordinal,
               '{check}' AS check_type, '{table}' AS table_name, '{column}' AS column_name,
               CASE WHEN count(CASE WHEN {invalid} THEN 1 END) > 0
                    THEN 'FAILED' ELSE 'SUCCESS' END AS status,
               count(*) AS total_rows,
               count(CASE WHEN {invalid} THEN 1 END) AS invalid_count,
               round(count(CASE WHEN {invalid} THEN 1 END) * 100.0
                     / CAST(nullif(count(*), 0) AS double), 6) AS invalid_rate
        FROM {source or table}"""


def union(*parts: str) -> str:
    return " UNION ALL ".join(parts)


_BAD_NUMBER = "({c} IS NOT NULL AND (isnan({c}) OR isinf({c})))"
_BAD_TEXT = (
    "({c} IS NOT NULL AND NOT regexp_full_match({c}, "
    "'[-+]?[0-9]*\\.?[0-9]+([eE][-+]?[0-9]+)?'))"
)
_BAD_ARRAY = "len(list_filter({c}, lambda v: isnan(v) OR isinf(v))) > 0"

NULL_SQL = union(
    checked("nulls", "null", 0, "dirty_lineitem", "l_quantity", "l_quantity IS NULL"),
    checked("nulls", "null", 1, "dirty_lineitem", "l_extendedprice", "l_extendedprice IS NULL"),
    checked("nulls", "null", 2, "orders", "o_totalprice", "o_totalprice IS NULL"),
    checked("nulls", "null", 3, "orders", "o_orderpriority", "o_orderpriority IS NULL"),
)
NAN_SQL = union(
    checked("nans", "nan", 0, "dirty_events", "value", _BAD_NUMBER.format(c="value")),
    checked("nans", "nan", 1, "dirty_events", "amount", _BAD_NUMBER.format(c="amount")),
    checked("nans", "nan", 2, "dirty_events", "user_id", "false"),
    checked("nans", "nan", 3, "dirty_events", "ts", "ts IS NOT NULL"),
)
LENGTH_SQL = union(
    checked("lengths", "time_series", 0, "dirty_embeddings", "embedding", "len(embedding) <> 64"),
    checked("lengths", "time_series", 1, "embeddings", "embedding", "len(embedding) <> 64"),
)


@sample("null_check", with_derived("dirty_lineitem") + NULL_SQL)
def null_check(tables: SampleTables) -> DataFrame:
    return shown(column_check_items(tables, column_items("nulls", "null", NULL_ITEMS)))


@sample("nan_check", with_derived("dirty_events") + NAN_SQL)
def nan_check(tables: SampleTables) -> DataFrame:
    return shown(column_check_items(tables, column_items("nans", "nan", NAN_ITEMS)))


@sample(
    "nan_check_text",
    with_derived("dirty_events")
    + union(
        checked("texts", "nan", 0, "dirty_events", "reading", _BAD_TEXT.format(c="reading")),
        checked("texts", "nan", 1, "dirty_events", "code", _BAD_TEXT.format(c="code")),
    ),
)
def nan_check_text(tables: SampleTables) -> DataFrame:
    return shown(column_check_items(tables, column_items("texts", "nan", TEXT_ITEMS)))


@sample(
    "nan_check_arrays",
    with_derived("dirty_embeddings")
    + union(
        checked("arrays", "nan", 0, "dirty_embeddings", "noisy", _BAD_ARRAY.format(c="noisy")),
        checked("arrays", "nan", 1, "dirty_embeddings", "noisy", "noisy IS NOT NULL"),
        checked("arrays", "nan", 2, "embeddings", "embedding", _BAD_ARRAY.format(c="embedding")),
    ),
)
def nan_check_arrays(tables: SampleTables) -> DataFrame:
    return shown(column_check_items(tables, column_items("arrays", "nan", ARRAY_ITEMS)))


@sample("array_length_check", with_derived("dirty_embeddings") + LENGTH_SQL)
def array_length_check(tables: SampleTables) -> DataFrame:
    return shown(column_check_items(tables, column_items("lengths", "time_series", LENGTH_ITEMS)))


def _lengths_sql(table: str) -> str:
    return f"""
        SELECT '{table}' AS table_name, CAST(64 AS integer) AS expected_length,
               (SELECT string_agg(CAST(n AS varchar), ', ' ORDER BY n)
                FROM (SELECT DISTINCT len(embedding) AS n FROM {table}
                      WHERE embedding IS NOT NULL)) AS lengths,
               CASE WHEN count(CASE WHEN len(embedding) <> 64 THEN 1 END) > 0
                    THEN 'Found ' || count(CASE WHEN len(embedding) <> 64 THEN 1 END)
                         || ' time series with invalid length in {table}.embedding. Expected: 64, '
                         || 'Found lengths: '
                         || (SELECT string_agg(CAST(n AS varchar), ', ' ORDER BY n)
                             FROM (SELECT DISTINCT len(embedding) AS n FROM {table}
                                   WHERE embedding IS NOT NULL))
                         || ', Total checked: ' || count(*)
                    ELSE 'All ' || count(*) || ' time series in {table}.embedding have correct '
                         || 'length of 64' END AS details
        FROM {table}"""


@sample(
    "found_lengths",
    with_derived("dirty_embeddings") + union(_lengths_sql("dirty_embeddings"), _lengths_sql("embeddings")),
)
def found_lengths(tables: SampleTables) -> DataFrame:
    items = column_check_items(tables, column_items("lengths", "time_series", LENGTH_ITEMS))
    return items.select(
        "table_name",
        "expected_length",
        F.array_join("found_lengths", ", ").alias("lengths"),
        "details",
    )


def all_items() -> list:
    return (
        column_items("nulls", "null", NULL_ITEMS)
        + column_items("nans", "nan", NAN_ITEMS)
        + column_items("lengths", "time_series", LENGTH_ITEMS)
        + column_items("clean", "null", [item("orders", "o_custkey"), item("orders", "o_orderkey")])
    )


ALL_SQL = union(
    NULL_SQL,
    NAN_SQL,
    LENGTH_SQL,
    checked("clean", "null", 0, "orders", "o_custkey", "o_custkey IS NULL"),
    checked("clean", "null", 1, "orders", "o_orderkey", "o_orderkey IS NULL"),
)
ALL_DERIVED = with_derived("dirty_lineitem", "dirty_events", "dirty_embeddings")
ROLLUP_SQL = f"""
    SELECT rule_name,
           CASE WHEN count(CASE WHEN status = 'FAILED' THEN 1 END) > 0
                THEN 'CRITICAL_FAILURE' ELSE 'SUCCESS' END AS status,
           count(*) AS total,
           count(CASE WHEN status = 'SUCCESS' THEN 1 END) AS passed,
           CAST(0 AS bigint) AS warnings,
           count(CASE WHEN status = 'FAILED' THEN 1 END) AS failed,
           coalesce(string_agg(CASE WHEN status = 'FAILED' THEN table_name || '.' || column_name END,
                               ', ' ORDER BY ordinal), '') AS failed_names,
           CASE WHEN count(CASE WHEN status = 'FAILED' THEN 1 END) = 0
                THEN 'All ' || count(*) || ' validations passed' END AS message,
           CASE WHEN count(CASE WHEN status = 'FAILED' THEN 1 END) > 0
                THEN count(CASE WHEN status = 'FAILED' THEN 1 END) || ' of ' || count(*)
                     || ' validations failed: '
                     || string_agg(CASE WHEN status = 'FAILED'
                                        THEN table_name || '.' || column_name END,
                                   ', ' ORDER BY ordinal) END AS error_details
    FROM ({ALL_SQL}) items GROUP BY rule_name"""


@sample("batch_rollup", ALL_DERIVED + ROLLUP_SQL)
def rolled_up(tables: SampleTables) -> DataFrame:
    return batch_rollup(column_check_items(tables, all_items()))


@sample(
    "batch_summary",
    ALL_DERIVED
    + f"""
    SELECT rule_name, table_name, column_name, max_by(status, ordinal) AS status
    FROM ({union(ALL_SQL, checked("clean", "null", 2, "orders", "o_custkey", "o_custkey < 100"))}) items
    GROUP BY rule_name, table_name, column_name""",
)
def summarized(tables: SampleTables) -> DataFrame:
    """The customer key of orders is checked twice by one rule; the last outcome counts."""
    register_column_check(
        "at_least", lambda c, params: {"invalid_count": F.count_if(c < params["limit"])}
    )
    (again,) = column_items("clean", "at_least", [item("orders", "o_custkey", limit=100)])
    again = type(again)(again.rule_name, 2, again.check_type, again.table, again.column, again.params)
    return batch_summary(column_check_items(tables, all_items() + [again]))


@sample(
    "error_isolation",
    with_derived("dirty_lineitem")
    + union(
        checked("mixed", "null", 0, "lineitem", "l_quantity", "l_quantity IS NULL"),
        *[
            f"""SELECT 'mixed', {i}, 'null', '{table}', '{column}', 'FAILED',
                       CAST(0 AS bigint), CAST(-1 AS bigint), CAST(NULL AS double)"""
            for i, table, column in [(1, "lineitem", "no_such_column"), (2, "no_such_table", "x")]
        ],
        checked("mixed", "null", 3, "dirty_lineitem", "l_quantity", "l_quantity IS NULL"),
    ),
)
def error_isolation(tables: SampleTables) -> DataFrame:
    return shown(run_column_checks(tables, column_items("mixed", "null", BROKEN_ITEMS)))


@sample(
    "custom_check",
    with_derived("dirty_lineitem")
    + union(
        checked("custom", "outside", 0, "lineitem", "l_quantity", "l_quantity < 5 OR l_quantity > 45"),
        checked(
            "custom", "outside", 1, "dirty_lineitem", "l_quantity", "l_quantity < 1 OR l_quantity > 50"
        ),
    ),
)
def custom_check(tables: SampleTables) -> DataFrame:
    register_column_check(
        "outside",
        lambda c, params: {"invalid_count": F.count_if((c < params["low"]) | (c > params["high"]))},
    )
    wanted = [
        item("lineitem", "l_quantity", low=5, high=45),
        item("dirty_lineitem", "l_quantity", low=1, high=50),
    ]
    return shown(column_check_items(tables, column_items("custom", "outside", wanted)))


@sample(
    "threshold_eval",
    with_derived("dirty_lineitem")
    + f"""
    SELECT table_name, column_name, check_type, total_rows, invalid_count,
           'equal_to' AS comparator, CAST(0 AS double) AS threshold, invalid_count = 0 AS is_pass
    FROM ({NULL_SQL}) items""",
)
def threshold_eval(tables: SampleTables) -> DataFrame:
    rules = [Rule("nulls", "null", NULL_ITEMS)]
    limits = thresholds(check_catalog(tables.spark, {"sample": rules}))
    return evaluate_thresholds(
        column_check_items(tables, column_items("nulls", "null", NULL_ITEMS)), limits
    )


@sample(
    "custom_metrics",
    """SELECT 'lineitem' AS table_name, count(CASE WHEN l_quantity < 5 THEN 1 END) AS invalid_count,
              CAST(max(l_quantity) AS double) AS largest, CAST(count(DISTINCT l_quantity) AS double) AS distinct_values
       FROM lineitem""",
)
def custom_metrics(tables: SampleTables) -> DataFrame:
    """A check of one's own that measures more than its invalid values."""
    register_column_check(
        "profiled",
        lambda c, params: {
            "invalid_count": F.count_if(c < params["low"]),
            "largest": F.max(c),
            "distinct_values": F.count_distinct(c),
        },
    )
    rows = column_check_items(tables, column_items("custom", "profiled", [item("lineitem", "l_quantity", low=5)]))
    return rows.select("table_name", "invalid_count", F.col("metrics.largest").alias("largest"), F.col("metrics.distinct_values").alias("distinct_values"))


@sample(
    "length_rows",
    with_derived("dirty_embeddings")
    + """SELECT 'dirty_embeddings' AS table_name, CAST(len(embedding) AS integer) AS length, count(*) AS arrays
         FROM dirty_embeddings WHERE embedding IS NOT NULL GROUP BY ALL
         UNION ALL SELECT 'embeddings', CAST(len(embedding) AS integer), count(*) FROM embeddings
         WHERE embedding IS NOT NULL GROUP BY ALL""",
)
def length_rows(tables: SampleTables) -> DataFrame:
    """Array lengths as rows, however many there are."""
    rows = length_rows_of(tables, column_items("lengths", "time_series", LENGTH_ITEMS))
    return rows.select("table_name", "length", "arrays")
