"""Batches of column checks: one pass per table, one row per check."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from ..functions import texts
from ..functions.status import CRITICAL, FAILED, SUCCESS
from ..functions.measures import array_length
from ..schemas import CHECK_ITEM, FOUND_LENGTH, conform, layout
from ..sources.tables import Tables, local_rows
from .columns import DEFAULT_LENGTH, column_check

MEASURED = layout(
    "item int, total_rows bigint, invalid_count bigint, metrics map<string;double>, "
    "found_lengths array<int>, length_count bigint, min_length int, max_length int"
)
_LENGTHS = layout("item int, length int, arrays bigint")

#: The most frequent lengths that a check's row lists; all of them are ``found_length`` rows.
MOST_LENGTHS = 100

_DESCRIBED = layout(
    "item int, rule_name string, ordinal int, check_type string, table_name string, "
    "column_name string, expected_length int, error_text string, failed_text string, "
    "passed_text string"
)


@dataclass(frozen=True)
class ColumnItem:
    """One check of one column."""

    rule_name: str
    ordinal: int
    check_type: str
    table: str
    column: str
    params: Mapping = field(default_factory=dict)


def column_items(rule_name: str, check_type: str, configs: Sequence[Mapping]) -> list[ColumnItem]:
    """Items from ``{"table": …, "column": …, **params}`` entries, in their order."""
    return [
        ColumnItem(
            rule_name,
            ordinal,
            check_type,
            config["table"],
            config["column"],
            {k: v for k, v in config.items() if k not in ("table", "column")},
        )
        for ordinal, config in enumerate(configs)
    ]


def _expected_length(item: ColumnItem) -> int | None:
    if item.check_type != "time_series":
        return None
    return item.params.get("expected_length", DEFAULT_LENGTH)


def _describe(tables: Tables, items: Sequence[ColumnItem], errors: Mapping[int, str]) -> DataFrame:
    """One local row per item: what it checks, and how its outcome reads."""
    rows = []
    for i, item in enumerate(items):
        known = {
            "table": item.table,
            "column": item.column,
            "expected": _expected_length(item),
            "invalid": "{invalid}",
            "rows": "{rows}",
            "lengths": "{lengths}",
        }
        row = {
            "item": i,
            "rule_name": item.rule_name,
            "ordinal": item.ordinal,
            "check_type": item.check_type,
            "table_name": item.table,
            "column_name": item.column,
            "expected_length": _expected_length(item),
        }
        if i in errors:
            row["error_text"] = texts.EXECUTION_FAILED.format(error=errors[i])
        else:
            check = column_check(item.check_type)
            row["failed_text"] = check.failed_text.format(**known)
            row["passed_text"] = check.passed_text.format(**known)
        rows.append(row)
    return local_rows(tables.spark, rows, _DESCRIBED)


def _graded(described: DataFrame, measured: DataFrame) -> DataFrame:
    """``check_item`` rows from the items and what was measured; errors count -1."""
    joined = described.join(measured, "item", "left")
    # A table without rows has no array lengths.
    by_length = (F.col("check_type") == "time_series") & F.col("error_text").isNull() & F.col("total_rows").isNull()
    none = {"total_rows": 0, "invalid_count": 0, "length_count": 0}
    joined = joined.withColumns({c: F.when(by_length, v).otherwise(F.col(c)).cast("bigint") for c, v in none.items()})
    empty = F.when(F.col("check_type") == "time_series", F.array().cast("array<int>"))
    joined = joined.withColumn("found_lengths", F.coalesce("found_lengths", empty))
    failed = "(error_text IS NOT NULL OR invalid_count > 0)"
    text = f"coalesce(error_text, CASE WHEN {failed} THEN failed_text ELSE passed_text END)"
    further = "length_count - size(found_lengths)"
    for name, value in {
        "{invalid}": "cast(invalid_count AS string)",
        "{rows}": "cast(total_rows AS string)",
        "{lengths}": f"concat(array_join(found_lengths, ', '), CASE WHEN {further} > 0 THEN concat(' and ', {further}, ' more') ELSE '' END)",
    }.items():
        text = f"replace({text}, '{name}', coalesce({value}, ''))"
    return conform(
        joined.selectExpr(
            "* EXCEPT (total_rows, invalid_count)",
            f"CASE WHEN {failed} THEN '{FAILED}' ELSE '{SUCCESS}' END AS status",
            "CASE WHEN error_text IS NOT NULL THEN 0 ELSE total_rows END AS total_rows",
            "CASE WHEN error_text IS NOT NULL THEN -1 ELSE invalid_count END AS invalid_count",
            "try_divide(invalid_count, total_rows) * 100 AS invalid_rate",
            f"{text} AS details",
        ),
        CHECK_ITEM,
    )


Failures = dict[int, str]


def _aggregates(df: DataFrame, item: ColumnItem, i: int) -> list[Column]:
    """The aggregates of one item, named by its number."""
    if item.column not in df.columns:
        raise LookupError(f"Column does not exist: {item.table}.{item.column}")
    metrics = column_check(item.check_type).metrics(
        F.col(f"`{item.column}`"), df.schema[item.column].dataType, item.params
    )
    return [metric.alias(f"{name}_{i}") for name, metric in metrics.items()]


def _plan_table(
    df: DataFrame, items: Mapping[int, ColumnItem]
) -> tuple[DataFrame | None, DataFrame | None, Failures]:
    """The plans for a table, and the items its schema rules out.

    One pass measures all checks but those of array lengths, which have rows of
    their own: (item, length, arrays).
    """
    planned, counted, failures = {}, {}, {}
    for i, item in items.items():
        try:
            aggregates = _aggregates(df, item, i)
            if column_check(item.check_type).by_length:
                counted[i] = item
            else:
                planned[i] = aggregates
        except Exception as error:
            failures[i] = str(error)
    lengths = _table_lengths(df, counted) if counted else None
    total = F.count(F.lit(1)).alias("total_rows")
    try:
        row = df.agg(total, *[a for aggregates in planned.values() for a in aggregates])
    except Exception:
        # An item does not type-check: find it, and leave it out.
        for i, aggregates in list(planned.items()):
            try:
                df.agg(*aggregates)
            except Exception as error:
                failures[i] = _first_line(error)
                del planned[i]
        row = df.agg(total, *[a for aggregates in planned.values() for a in aggregates])
    if not planned:
        return None, lengths, failures
    measured = ", ".join(
        f"struct({i} AS item, total_rows, cast(invalid_count_{i} AS bigint) AS invalid_count, "
        f"{_further_metrics(i, row.columns)} AS metrics)"
        for i in planned
    )
    return row.selectExpr(f"inline(array({measured}))"), lengths, failures


def _further_metrics(i: int, columns: Sequence[str]) -> str:
    """SQL of a map of what an item measures besides its invalid values; NULL if nothing."""
    names = [c.removesuffix(f"_{i}") for c in columns if c.endswith(f"_{i}") and c != f"invalid_count_{i}"]
    entries = ", ".join(f"{texts.quoted(n)}, cast(`{n}_{i}` AS double)" for n in names)
    return f"map({entries})" if names else "cast(NULL AS map<string, double>)"


def _table_lengths(df: DataFrame, items: Mapping[int, ColumnItem]) -> DataFrame:
    """(item, length, arrays) rows of a table's array-length checks, one row per distinct length.

    A grouping of its own: in the shared pass the lengths would be one buffer, and would cost
    all other checks of the table their compiled aggregation. NULL arrays are the length NULL.
    """
    pairs = F.array(
        *[
            F.struct(F.lit(i).alias("item"), array_length(F.col(f"`{x.column}`"), df.schema[x.column].dataType).alias("length"))
            for i, x in items.items()
        ]
    )
    rows = df.select(F.inline(pairs))
    return rows.groupBy("item", "length").agg(F.count(F.lit(1)).alias("arrays"))


def _by_length(tables: Tables, lengths: DataFrame, items: Mapping[int, ColumnItem] | Sequence[ColumnItem]) -> DataFrame:
    """What array-length checks measured, from rows of lengths: bounded rows, whatever the number of lengths."""
    numbered = items.items() if isinstance(items, Mapping) else enumerate(items)
    wanted = [{"item": i, "expected": _expected_length(x)} for i, x in numbered if x.check_type == "time_series"]
    known = local_rows(tables.spark, wanted, layout("item int, expected int"))
    measured = lengths.join(known, "item").groupBy("item").agg(
        F.sum("arrays").alias("total_rows"),
        F.coalesce(F.sum(F.when(F.col("length") != F.col("expected"), F.col("arrays"))), F.lit(0)).alias("invalid_count"),
        F.count("length").alias("length_count"),
        F.min("length").alias("min_length"),
        F.max("length").alias("max_length"),
    )
    # Ranks are limited in each task before rows of an item meet. The length NULL comes last and isn't
    # listed; a filter would change what is grouped, and the table would be read a second time.
    often = Window.partitionBy("item").orderBy(F.col("length").isNull(), F.desc("arrays"), "length")
    most = lengths.withColumn("rank", F.row_number().over(often)).filter(F.col("rank") <= MOST_LENGTHS)
    most = most.groupBy("item").agg(F.sort_array(F.collect_list("length")).alias("found_lengths"))
    return conform(measured.join(most, "item", "left"), MEASURED)


def found_lengths(tables: Tables, items: Sequence[ColumnItem]) -> DataFrame:
    """``found_length`` rows: how many arrays of each length the array-length checks met.

    Items that can't be planned have none.
    """
    described = _describe(tables, items, {}).select("item", "rule_name", "table_name", "column_name")
    frames = []
    for table, group in _by_table(items).items():
        try:
            _, lengths, _ = _plan_table(tables.table(table), group)
        except Exception:  # reported by the check itself
            continue
        if lengths is not None:
            frames.append(lengths)
    lengths = reduce(DataFrame.unionByName, frames or [local_rows(tables.spark, [], _LENGTHS)])
    return conform(lengths.filter("length IS NOT NULL").join(described, "item"), FOUND_LENGTH)


def _first_line(error: Exception) -> str:
    return (str(error) or type(error).__name__).splitlines()[0]


def _by_table(items: Sequence[ColumnItem]) -> dict[str, dict[int, ColumnItem]]:
    grouped: dict[str, dict[int, ColumnItem]] = {}
    for i, item in enumerate(items):
        grouped.setdefault(item.table, {})[i] = item
    return grouped


def column_check_items(tables: Tables, items: Sequence[ColumnItem]) -> DataFrame:
    """Lazy ``check_item`` rows: one aggregation per table, whatever the number of checks.

    Missing tables and columns, and checks that do not fit a column's type,
    become failed rows. All tables are parts of one plan, so one action runs
    them side by side; an error while reading a table fails that action. Use
    ``run_column_checks`` to isolate such errors.
    """
    plans, lengths, errors = [], [], {}
    for table, group in _by_table(items).items():
        try:
            plan, found, failures = _plan_table(tables.table(table), group)
        except Exception as error:
            plan, found, failures = None, None, dict.fromkeys(group, _first_line(error))
        errors.update(failures)
        if plan is not None:
            plans.append(plan)
        if found is not None:
            lengths.append(found)
    measured = [conform(plan, MEASURED) for plan in plans]
    if lengths:
        measured.append(_by_length(tables, reduce(DataFrame.unionByName, lengths), items))
    measured = measured or [local_rows(tables.spark, [], MEASURED)]
    return _graded(_describe(tables, items, errors), reduce(DataFrame.unionByName, measured))


def _measure(
    tables: Tables, df: DataFrame, items: Mapping[int, ColumnItem], keep: Callable[[DataFrame], DataFrame]
) -> tuple[list[Row], Failures]:
    """Run a table's checks; on an error narrow it down by halves.

    A few bad items among n cost about log n further passes each, not n. ``keep``
    is what is done with the rows of array lengths, which never come to the driver.
    """
    plan, lengths, failures = _plan_table(df, items)
    if plan is None and lengths is None:
        return [], failures
    try:
        rows = [] if plan is None else conform(plan, MEASURED).collect()
        if lengths is not None:
            rows += _by_length(tables, keep(lengths), items).collect()
        return rows, failures
    except Exception as error:
        rest = [i for i in items if i not in failures]
        if len(rest) == 1:
            return [], {**failures, rest[0]: _first_line(error)}
    rows = []
    for half in (rest[: len(rest) // 2], rest[len(rest) // 2 :]):
        found, more = _measure(tables, df, {i: items[i] for i in half}, keep)
        rows += found
        failures = {**failures, **more}
    return rows, failures


def run_column_checks(
    tables: Tables,
    items: Sequence[ColumnItem],
    parallel: int = 4,
    keep: Callable[[DataFrame], DataFrame] = lambda lengths: lengths,
) -> DataFrame:
    """``check_item`` rows with every error kept to its own item.

    Runs one job per table, ``parallel`` of them at a time. What comes to the
    driver is one row per check. A table that fails while it is read is retried
    by halves of its items; other tables are not run again. Rows of array lengths
    are reduced where they are; ``keep`` may write them and read them again.
    """

    def measure(table: str, group: Mapping[int, ColumnItem]):
        try:
            return _measure(tables, tables.table(table), group, keep)
        except Exception as error:
            return [], dict.fromkeys(group, _first_line(error))

    rows, errors = [], {}
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        jobs = [
            pool.submit(inheritable_thread_target(tables.spark)(measure), table, group)
            for table, group in _by_table(items).items()
        ]
        for job in jobs:
            found, failures = job.result()
            rows += [row.asDict() for row in found]
            errors.update(failures)
    return _graded(_describe(tables, items, errors), local_rows(tables.spark, rows, MEASURED))


def batch_rollup(items: DataFrame) -> DataFrame:
    """One row per rule: totals, status, and the failed items as ``table.column``."""
    failed = f"status = '{FAILED}'"
    tallied = items.groupBy("rule_name").agg(
        F.expr("count(1) AS total"),
        F.expr(f"count_if(NOT {failed}) AS passed"),
        F.expr("0L AS warnings"),
        F.expr(f"count_if({failed}) AS failed"),
        F.expr(
            f"""array_join(transform(array_sort(collect_list(CASE WHEN {failed} THEN struct(
                    ordinal, concat_ws('.', table_name, column_name) AS name) END)),
                s -> s.name), ', ') AS failed_names"""
        ),
    )
    failure = texts.filled(texts.BATCH_FAILED, failed="failed", total="total", names="failed_names")
    return tallied.selectExpr(
        "rule_name",
        f"CASE WHEN failed > 0 THEN '{CRITICAL}' ELSE '{SUCCESS}' END AS status",
        "total",
        "passed",
        "warnings",
        "failed",
        "failed_names",
        f"CASE WHEN failed = 0 THEN {texts.filled(texts.BATCH_PASSED, total='total')} END AS message",
        f"CASE WHEN failed > 0 THEN {failure} END AS error_details",
    )


def batch_summary(items: DataFrame) -> DataFrame:
    """Status per rule and column; the last item wins where a column is listed twice."""
    return items.groupBy("rule_name", "table_name", "column_name").agg(
        F.max_by("status", "ordinal").alias("status")
    )
