"""Runs of rule sets: one result row per rule, one report row per run."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import texts
from ..functions.status import CRITICAL, SUCCESS, status_tallies, worst_status
from ..operators.batch import (
    ColumnItem,
    batch_rollup,
    column_check_items,
    column_items,
    run_column_checks,
)
from ..operators.columns import is_column_check
from ..operators.reconcile import reconcile_all
from ..operators.tablechecks import GroupedCheck, TableCheck, reconciliation, table_check
from ..schemas import CHECK_ITEM, RULE_RESULT, RUN_REPORT, conform, layout
from ..sources.sinks import read_parts, replace_part, write_table
from ..sources.tables import Tables, local_rows
from .specs import Rule

_KNOWN = layout(
    "run_id string, ordinal int, rule_name string, validation_type string, table_name string, "
    "ts timestamp"
)


@dataclass(frozen=True)
class RunResult:
    """What a run leaves behind.

    ``rules`` are the ``rule_result`` rows and ``report`` their roll-up.
    ``check_items`` are the rows of all column checks, ``details`` the graded
    rows behind every table check, and ``mismatches`` the first mismatches of
    every group of a grouped check.
    """

    run_id: str
    rules: DataFrame
    report: DataFrame
    check_items: DataFrame
    details: dict[str, DataFrame]
    mismatches: dict[str, DataFrame]


@dataclass(frozen=True)
class _Graded:
    """Outcome of one table rule: its result row, and the frames behind it."""

    result: list
    details: DataFrame | None = None
    mismatches: DataFrame | None = None


@dataclass(frozen=True)
class _Stamp:
    run_id: str
    ts: datetime

    @classmethod
    def new(cls, run_id: str | None) -> _Stamp:
        return cls(run_id or uuid.uuid4().hex, datetime.now(timezone.utc))


def select_rules(rules: Iterable[Rule], only: Sequence[str] | None = None) -> list[Rule]:
    """The rules to run, in order; a later rule replaces an earlier one of the same name."""
    named = {rule.name: rule for rule in rules}
    if only is None:
        return list(named.values())
    unknown = sorted(set(only) - set(named))
    if unknown:
        raise ValueError(f"Unknown rules: {', '.join(unknown)}")
    return [rule for name, rule in named.items() if name in set(only)]


def _broken_row(
    tables: Tables, stamp: _Stamp, ordinal: int, rule: Rule, validation_type: str, error: str
) -> DataFrame:
    known = validation_type != "unknown"
    return local_rows(
        tables.spark,
        [
            {
                "run_id": stamp.run_id,
                "ordinal": ordinal,
                "rule_name": rule.name,
                "validation_type": validation_type,
                "status": CRITICAL,
                "table_name": "multiple_tables" if known else "unknown",
                "error_details": (texts.BATCH_BROKEN if known else texts.RULE_BROKEN).format(
                    error=error
                ),
                "ts": stamp.ts,
            }
        ],
        RULE_RESULT,
    )


def _first_line(error: Exception) -> str:
    return (str(error) or type(error).__name__).splitlines()[0]


@dataclass(frozen=True)
class _ColumnPlan:
    """The column rules of a run: their items, and rows of rules decided without data."""

    rules: dict[str, tuple[int, Rule]]
    items: list[ColumnItem]
    decided: list[DataFrame]


def _plan_column_rules(
    tables: Tables, rules: Sequence[tuple[int, Rule]], stamp: _Stamp
) -> _ColumnPlan:
    """Items of all column rules together, so that a table is scanned once for the whole run."""
    planned, items, decided = {}, [], []
    for ordinal, rule in rules:
        try:
            own = column_items(rule.name, rule.check, rule.config)
        except Exception as error:  # an entry without table or column fails its whole batch
            decided.append(_broken_row(tables, stamp, ordinal, rule, rule.check, repr(error)))
            continue
        planned[rule.name] = (ordinal, rule)
        items += own
        if not own:
            decided.append(
                local_rows(
                    tables.spark,
                    [
                        {
                            "run_id": stamp.run_id,
                            "ordinal": ordinal,
                            "rule_name": rule.name,
                            "validation_type": rule.check,
                            "status": SUCCESS,
                            "table_name": "multiple_tables",
                            "total": 0,
                            "passed": 0,
                            "warnings": 0,
                            "failed": 0,
                            "message": texts.BATCH_PASSED.format(total=0),
                            "ts": stamp.ts,
                        }
                    ],
                    RULE_RESULT,
                )
            )
    return _ColumnPlan(planned, items, decided)


def _column_results(plan: _ColumnPlan, items: DataFrame, stamp: _Stamp) -> DataFrame:
    known = local_rows(
        items.sparkSession,
        [
            {
                "run_id": stamp.run_id,
                "ordinal": ordinal,
                "rule_name": name,
                "validation_type": rule.check,
                "table_name": "multiple_tables",
                "ts": stamp.ts,
            }
            for name, (ordinal, rule) in plan.rules.items()
        ],
        _KNOWN,
    )
    return conform(batch_rollup(items).join(known, "rule_name"), RULE_RESULT)


def _table_result(
    check: TableCheck | GroupedCheck, rule: Rule, rows: DataFrame, ordinal: int, stamp: _Stamp
) -> DataFrame:
    """The ``rule_result`` row of a table check, from its graded rows."""
    tallied = rows.agg(
        worst_status("status").alias("worst"),
        *[column.alias(name) for name, column in status_tallies("status").items()],
        F.expr(f"{check.is_empty} AS empty"),
    )
    names = {"rule": texts.quoted(rule.name), "members": texts.quoted(check.members)}
    no_data = texts.NO_RULE_DATA.format(subject=rule.config.get("subject", rule.name))
    counts = {name: name for name in ("total", "passed", "warnings", "failed")}
    return conform(
        tallied.selectExpr(
            f"{texts.quoted(stamp.run_id)} AS run_id",
            f"{ordinal} AS ordinal",
            f"{names['rule']} AS rule_name",
            f"{texts.quoted(rule.check)} AS validation_type",
            f"CASE WHEN empty THEN '{CRITICAL}' ELSE worst END AS status",
            f"{texts.quoted(rule.config.get('table', 'unknown'))} AS table_name",
            *[f"CASE WHEN NOT empty THEN {name} END AS {name}" for name in counts],
            f"CASE WHEN NOT empty THEN {texts.filled(texts.RULE_COUNTS, **counts, **names)} "
            "END AS message",
            f"""CASE WHEN empty THEN {texts.quoted(no_data)}
                WHEN failed > 0 THEN {texts.filled(texts.CRITICAL_FOUND, **counts, **names)}
                WHEN warnings > 0 THEN {texts.filled(texts.WARNINGS_FOUND, **counts, **names)}
                END AS error_details""",
        ).withColumn("ts", F.lit(stamp.ts)),
        RULE_RESULT,
    )


def _reconcile_results(
    rows: DataFrame, rules: Sequence[tuple[int, Rule]], stamp: _Stamp
) -> DataFrame:
    """The ``rule_result`` rows of reconciliations that were planned together."""
    tallied = rows.groupBy("rule_name").agg(
        worst_status("status").alias("worst"),
        *[column.alias(name) for name, column in status_tallies("status").items()],
    )
    known = local_rows(
        rows.sparkSession,
        [
            {
                "run_id": stamp.run_id,
                "ordinal": ordinal,
                "rule_name": rule.name,
                "validation_type": rule.check,
                "table_name": rule.config.get("table", "unknown"),
                "ts": stamp.ts,
            }
            for ordinal, rule in rules
        ],
        _KNOWN,
    )
    counts = {name: name for name in ("total", "passed", "warnings", "failed")}
    names = {"rule": "rule_name", "members": texts.quoted(table_check("reconcile").members)}
    joined = known.join(tallied, "rule_name", "left").selectExpr(
        "* EXCEPT (total, passed, warnings, failed, worst)",
        f"coalesce(worst, '{SUCCESS}') AS status",
        *[f"coalesce({name}, 0L) AS {name}" for name in counts],
    )
    return conform(
        joined.selectExpr(
            "*",
            f"{texts.filled(texts.RULE_COUNTS, **counts, **names)} AS message",
            f"""CASE WHEN failed > 0 THEN {texts.filled(texts.CRITICAL_FOUND, **counts, **names)}
                WHEN warnings > 0 THEN {texts.filled(texts.WARNINGS_FOUND, **counts, **names)}
                END AS error_details""",
        ),
        RULE_RESULT,
    )


def _split(rules: Sequence[Rule]):
    numbered = list(enumerate(rules))
    column = [(i, r) for i, r in numbered if is_column_check(r.check)]
    table = [(i, r) for i, r in numbered if not is_column_check(r.check)]
    return column, table


def plan_run(
    tables: Tables,
    rules: Iterable[Rule],
    only: Sequence[str] | None = None,
    run_id: str | None = None,
) -> DataFrame:
    """The ``rule_result`` rows of a run as one lazy plan.

    Missing tables or columns and broken configurations fail their own rule. An
    error while data is read fails the action; ``run`` isolates those as well.
    """
    stamp = _Stamp.new(run_id)
    column_rules, table_rules = _split(select_rules(rules, only))
    plan = _plan_column_rules(tables, column_rules, stamp)
    results = list(plan.decided)
    if plan.items:
        results.append(_column_results(plan, column_check_items(tables, plan.items), stamp))
    together = []
    for ordinal, rule in table_rules:
        try:
            check = table_check(rule.check)
            if rule.check == "reconcile":  # all of them share their passes over tables
                together.append((ordinal, rule, reconciliation(rule.name, rule.config)))
                continue
            rows = check.build(tables, rule.name, rule.config)
            results.append(_table_result(check, rule, rows, ordinal, stamp))
        except Exception as error:
            results.append(
                _broken_row(tables, stamp, ordinal, rule, "unknown", _first_line(error))
            )
    if together:
        rows = reconcile_all(tables, [r for _, _, r in together])
        results.append(_reconcile_results(rows, [(o, r) for o, r, _ in together], stamp))
    if not results:
        return local_rows(tables.spark, [], RULE_RESULT)
    return reduce(DataFrame.unionByName, results)


def _broken_parts(tables: Tables, rule: Rule) -> dict[int, str]:
    """Find the parts of a reconciliation that fail while they are read."""
    broken = {}
    for i, part in enumerate(rule.config["parts"]):
        try:
            alone = {**rule.config, "parts": [part]}
            table_check(rule.check).build(tables, rule.name, alone).collect()
        except Exception as error:
            broken[i] = _first_line(error)
    return broken


def run(
    tables: Tables,
    rules: Iterable[Rule],
    only: Sequence[str] | None = None,
    run_id: str | None = None,
    output: str | None = None,
    parallel: int = 4,
    fmt: str = "parquet",
) -> RunResult:
    """Run rules, each isolated from the errors of the others.

    Column checks of all rules share one scan per table. Up to ``parallel`` jobs
    run side by side. With ``output`` the graded rows of every rule are written
    there under the run id, and what builds on them starts from what was
    written, so that nothing is computed twice. The results of all runs are tables
    of ``output`` with a part for each run (see ``history``): a run that is repeated
    under its id replaces its own part, and no other. Without ``output``
    ``details`` and ``mismatches`` are plans that run when used.
    """
    spark = tables.spark
    stamp = _Stamp.new(run_id)
    column_rules, table_rules = _split(select_rules(rules, only))

    def stored(df: DataFrame, *names: str) -> DataFrame:
        if output is None:
            return df
        return write_table(df, "/".join([output.rstrip("/"), stamp.run_id, *names]), fmt)

    def graded(rule: Rule, check: TableCheck | GroupedCheck, ordinal: int) -> _Graded:
        listed = None
        if isinstance(check, GroupedCheck):
            items = stored(check.items(tables, rule.name, rule.config), "items", rule.name)
            rows = stored(check.rollup(items, rule.name, rule.config), "details", rule.name)
            listed = stored(check.mismatches(items, rows), "mismatches", rule.name)
        else:
            rows = stored(check.build(tables, rule.name, rule.config), "details", rule.name)
        return _Graded(_table_result(check, rule, rows, ordinal, stamp).collect(), rows, listed)

    def run_table_rule(ordinal: int, rule: Rule) -> _Graded:
        try:
            check = table_check(rule.check)
            try:
                return graded(rule, check, ordinal)
            except Exception:
                if rule.check != "reconcile":
                    raise
                config = {**rule.config, "broken": _broken_parts(tables, rule)}
                return graded(Rule(rule.name, rule.check, config), check, ordinal)
        except Exception as error:
            row = _broken_row(tables, stamp, ordinal, rule, "unknown", _first_line(error))
            return _Graded(row.collect())

    def run_together(rules: list[tuple[int, Rule]]) -> dict[str, _Graded]:
        """Reconciliations in one plan, which share their passes over tables; alone if that fails."""
        if not rules:
            return {}
        try:
            parts = [reconciliation(rule.name, rule.config) for _, rule in rules]
            rows = stored(reconcile_all(tables, parts), "details", "reconciliations")
            found = {row["rule_name"]: row for row in _reconcile_results(rows, rules, stamp).collect()}
            return {r.name: _Graded([found[r.name]], rows.filter(F.col("rule_name") == r.name)) for _, r in rules}
        except Exception:
            return {rule.name: run_table_rule(ordinal, rule) for ordinal, rule in rules}

    together = [(i, r) for i, r in table_rules if r.check == "reconcile"]
    if len(together) < 2:
        together = []
    names = {r.name for _, r in together}
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        shared = pool.submit(inheritable_thread_target(spark)(run_together), together)
        jobs = {
            rule.name: pool.submit(inheritable_thread_target(spark)(run_table_rule), ordinal, rule)
            for ordinal, rule in table_rules
            if rule.name not in names
        }
        plan = _plan_column_rules(tables, column_rules, stamp)

        def keep(lengths: DataFrame) -> DataFrame:
            return stored(lengths, "found_lengths", uuid.uuid4().hex)

        items = run_column_checks(tables, plan.items, parallel, keep)
        results = [row for df in plan.decided for row in df.collect()]
        if plan.items:
            results += _column_results(plan, items, stamp).collect()
        alone = {name: job.result() for name, job in jobs.items()} | shared.result()
        done = {rule.name: alone[rule.name] for _, rule in table_rules}
    for outcome in done.values():
        results += outcome.result
    # One row per rule: as many as were asked for, whatever the size of the data.
    results.sort(key=lambda row: row["ordinal"])
    rules_df = local_rows(spark, [r.asDict() for r in results], RULE_RESULT)
    report = run_rollup(rules_df)
    if output is not None:
        rules_df = _kept(output, RESULTS, rules_df, stamp, fmt, RULE_RESULT)
        items = _kept(output, CHECK_ITEMS, items, stamp, fmt, CHECK_ITEM)
        dated = run_rollup(rules_df).withColumn("ts", F.lit(stamp.ts))
        report = _kept(output, REPORTS, dated, stamp, fmt, RUN_REPORT).drop("run_id", "ts")
    return RunResult(
        stamp.run_id,
        rules_df,
        report,
        items,
        {name: o.details for name, o in done.items() if o.details is not None},
        {name: o.mismatches for name, o in done.items() if o.mismatches is not None},
    )


#: Tables of all runs below a run's ``output``, and their layouts.
RESULTS, CHECK_ITEMS, REPORTS = "rule_results", "check_items", "reports"
_HISTORY = {RESULTS: RULE_RESULT, CHECK_ITEMS: CHECK_ITEM, REPORTS: RUN_REPORT}


def _kept(output: str, name: str, rows: DataFrame, stamp: _Stamp, fmt: str, schema: T.StructType) -> DataFrame:
    """The rows of a run as its part of a table of all runs, read back with the table's columns."""
    path = f"{output.rstrip('/')}/{name}"
    part = replace_part(conform(rows, schema).drop("run_id"), path, "run_id", stamp.run_id, fmt)
    return part.select(*[c for c in schema.names if c in part.columns])


def history(spark: SparkSession, output: str, name: str = RESULTS, fmt: str = "parquet") -> DataFrame:
    """The rows of all runs below ``output``, with their ``run_id``: results, check items or reports.

    A filter on the run reads its part only; all results of a rule over time are one filter.
    """
    schema = _HISTORY[name]
    rows = read_parts(spark, f"{output.rstrip('/')}/{name}", schema, "run_id", fmt)
    return rows.select("run_id", *[c for c in schema.names if c != "run_id"])


def changed_rules(results: DataFrame) -> DataFrame:
    """Per rule and run of ``history``: its status and that of the rule's run before, NULL for the first."""
    before = Window.partitionBy("rule_name").orderBy("ts", "run_id")
    return results.select(
        "rule_name", "run_id", "ts", "status", F.lag("status").over(before).alias("status_before")
    ).withColumn("changed", F.coalesce(F.col("status") != F.col("status_before"), F.lit(False)))


def run_rollup(rule_results: DataFrame) -> DataFrame:
    """One report row: a run succeeds if every rule did, and an empty run succeeds.

    A rule that ends with a warning counts as failed.
    """
    passed = F.col("status") == SUCCESS
    name = F.col("rule_name")
    return rule_results.agg(
        F.count(F.lit(1)).alias("total_rules"),
        F.count_if(passed).alias("passed_rules"),
        F.count_if(~passed).alias("failed_rules"),
        F.array_sort(F.collect_list(F.when(passed, name))).alias("passed_rule_names"),
        F.array_sort(F.collect_list(F.when(~passed, name))).alias("failed_rule_names"),
        F.when(F.count_if(~passed) > 0, CRITICAL).otherwise(SUCCESS).alias("overall_status"),
    )
