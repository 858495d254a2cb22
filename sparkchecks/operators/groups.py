"""Sums per group member compared with expected sums, and their roll-ups.

Item frames have the columns of ``group_item``; ``member_key`` keeps the type of
the column it comes from, so that members sort in their natural order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import texts
from ..functions.compare import loosely_close, relative_error, strictly_close
from ..functions.exact import exact_sums, is_partial, partial_sums, whole_sums
from ..functions.measures import rounded_bigint
from ..functions.status import CRITICAL, SUCCESS, WARNING
from ..schemas import GROUP_ROLLUP, conform, layout
from ..sources.tables import local_rows

_REQUEST = layout("group_key string, requested int")


def grade_members(
    sums: DataFrame,
    rule_name: str,
    group: str,
    member: str,
    tolerance: float,
    keep: Sequence[str] = (),
) -> DataFrame:
    """``group_item`` rows from (group, member, actual, expected, n_rows)."""
    return sums.selectExpr(
        f"{texts.quoted(rule_name)} AS rule_name",
        f"cast(`{group}` AS string) AS group_key",
        f"`{member}` AS member_key",
        "cast(actual AS double) AS actual",
        "cast(expected AS double) AS expected",
        "n_rows",
        *keep,
    ).select(
        "*",
        relative_error("actual", "expected").alias("relative_error"),
        strictly_close("actual", "expected", tolerance).alias("is_strictly_close"),
        loosely_close("actual", "expected", tolerance).alias("is_close"),
    )


def mapped_sums(
    detail: DataFrame,
    mapping: DataFrame,
    on: str,
    group: str,
    region: str,
    value: str,
    groups: Sequence[str],
) -> DataFrame:
    """Sum ``value`` per requested group and region of an inner join with a mapping.

    Returns (group_key, region, total, n_rows). Both sides are reduced per key before the join:
    the detail rows to one row with a sum for each requested group, the mapping to its distinct
    pairs with their number. Sums are exact, and rounded once.
    """
    wanted = list(dict.fromkeys(groups))
    rows = detail.filter(F.col(group).isin(wanted)).select(
        F.col(on).alias("_on"), F.col(group).cast("string").alias("group_key"), F.col(f"`{value}`").alias("_sum")
    )
    count = {"_rows": F.count(F.lit(1))}
    per_key = partial_sums(rows, ["_on", "group_key"], {"total": F.col("_sum")}, None, count)
    pairs = mapping.groupBy(F.col(on).alias("_key"), F.col(region).alias("region")).agg(F.count(F.lit(1)).alias("_pairs"))
    joined = per_key.join(pairs, F.col("_on") == F.col("_key"))
    count = {"n_rows": F.sum(F.col("_rows") * F.col("_pairs"))}
    keys = ["group_key", "region"]
    per_region = partial_sums(joined, keys, {"total": F.col("total")}, F.col("_pairs"), count)
    return whole_sums(per_region, keys, ["total"], ["n_rows"]).select(*keys, F.col("total").cast("double"), "n_rows")


def group_sum_items(
    sums: DataFrame,
    reference: DataFrame,
    rule_name: str,
    tolerance: float,
    group: str,
    region: str,
    value: str,
    groups: Sequence[str],
    subgroup: str | None = None,
) -> DataFrame:
    """Compare ``mapped_sums`` with the sums of an independent reference table.

    The reference is summed per group and region, and per ``subgroup`` if given;
    a region then counts once for every subgroup. Regions that only one side
    knows drop out.
    """
    extra = [F.col(subgroup).alias("_subgroup")] if subgroup else []
    rows = reference.filter(F.col(group).isin(list(groups))).select(
        *extra, F.col(group).cast("string").alias("group_key"), F.col(region).alias("region"), F.col(f"`{value}`").alias("_value")
    )
    keys = [*["_subgroup"] * len(extra), "group_key", "region"]
    expected = exact_sums(rows, keys, {"expected": F.col("_value")}).withColumn("expected", F.col("expected").cast("double"))
    joined = sums.withColumnRenamed("total", "actual").join(expected, ["group_key", "region"])
    return grade_members(joined, rule_name, "group_key", "region", tolerance)


def refinement_items(
    refined: DataFrame,
    rule_name: str,
    tolerance: float,
    region: str,
    code: str,
    cell: str,
    original: str,
    detail: str,
) -> DataFrame:
    """Per region and code: sum of ``detail`` against the distinct ``original`` values per cell.

    Values that repeat within a cell count once. One shuffle reduces the table
    to its distinct (region, code, cell, original) rows, from which both sums
    follow, so no second scan, join or distinct aggregate is needed.
    """
    rows = refined.filter(F.col(region).isNotNull() & F.col(code).isNotNull()).select(
        F.col(region).alias("_region"),
        F.col(code).alias("_code"),
        F.col(cell).alias("_cell"),
        F.col(original).alias("_original"),
        F.col(detail).alias("_detail"),
    )
    keys, cells = ["_region", "_code"], ["_region", "_code", "_cell", "_original"]
    reduced = partial_sums(rows, cells, {"_detail": F.col("_detail")}, None, {"_rows": F.count(F.lit(1))})
    if is_partial(reduced.schema["_detail"].dataType):
        # The values of a cell may lie in several bins; its original counts with the first of them.
        own = reduced.groupBy(*cells).agg(F.collect_list("_detail").alias("_parts"), F.sum("_rows").alias("_rows"))
        reduced = own.select(*cells, F.posexplode_outer("_parts").alias("_at", "_detail"), "_rows")
        first = F.coalesce(F.col("_at") == 0, F.lit(True))
        reduced = reduced.withColumns({"_original": F.when(first, F.col("_original")), "_rows": F.when(first, F.col("_rows"))})
    values = {"actual": F.col("_detail"), "expected": F.col("_original")}
    sums = whole_sums(partial_sums(reduced, keys, values, None, {"n_rows": F.sum("_rows")}), keys, list(values), ["n_rows"])
    sums = sums.select(
        F.col("_region").alias(region),
        F.col("_code").alias(code),
        *[rounded_bigint(F.col(c), sums.schema[c].dataType).alias(c) for c in values],
        "n_rows",
    )
    return grade_members(sums, rule_name, code, region, tolerance)


def group_rollup(
    items: DataFrame,
    rule_name: str,
    tolerance: float,
    requested: Sequence[str] | None = None,
    passed_text: str = texts.GROUP_MATCHES,
    failed_text: str = texts.GROUP_DIFFERS,
) -> DataFrame:
    """``group_rollup`` rows: all members must be strictly close for a group to pass.

    Listed mismatches are those that are not loosely close, so a failed group
    may have none. A NULL sum leaves its group critical and uncounted. Requested
    groups without members are critical with 0 of 0; without a request every
    group found is graded.
    """
    rows = items.selectExpr(
        "group_key",
        "1 AS member",
        "actual IS NULL OR expected IS NULL AS is_null",
        "is_strictly_close",
        "is_close",
        "actual",
        "expected",
    )
    if requested is not None:
        wanted = list(dict.fromkeys(requested))
        rows = rows.filter(F.col("group_key").isin(wanted)).unionByName(
            local_rows(
                items.sparkSession, [{"group_key": g, "requested": 1} for g in wanted], _REQUEST
            ),
            allowMissingColumns=True,
        )
    grouped = rows.groupBy("group_key").agg(
        F.expr("count(member) AS members"),
        F.expr("count_if(is_null) AS nulls"),
        F.expr("count_if(NOT is_strictly_close) AS strict_failures"),
        F.expr("count_if(NOT is_close) AS loose_failures"),
        F.expr("sum(actual) AS total_actual"),
        F.expr("sum(expected) AS total_expected"),
    )
    broken = "nulls > 0"
    unknown_total = "NULL" if requested is not None else "members"
    key = "group_key"
    return conform(
        grouped.selectExpr(
            f"{texts.quoted(rule_name)} AS rule_name",
            "group_key",
            f"""CASE WHEN members = 0 OR {broken} OR strict_failures > 0 THEN '{CRITICAL}'
                ELSE '{SUCCESS}' END AS status""",
            f"""CASE WHEN {broken} THEN NULL WHEN strict_failures > 0 THEN loose_failures
                ELSE 0 END AS mismatches""",
            f"CASE WHEN {broken} THEN {unknown_total} ELSE members END AS total_members",
            f"CASE WHEN NOT ({broken}) THEN total_actual END AS total_actual",
            f"CASE WHEN NOT ({broken}) THEN total_expected END AS total_expected",
            f"{float(tolerance)!r}D AS tolerance",
            f"""CASE WHEN members = 0 THEN {texts.filled(texts.NO_GROUP_DATA, group=key)}
                WHEN {broken} THEN {texts.filled(texts.GROUP_NOT_VALIDATED, group=key)}
                WHEN strict_failures > 0 THEN {texts.filled(failed_text, group=key)}
                ELSE {texts.filled(passed_text, group=key)} END AS message""",
        ),
        GROUP_ROLLUP,
    )


def share_items(
    shares: DataFrame, rule_name: str, tolerance: float, member: str, group: str, share: str
) -> DataFrame:
    """``group_item`` rows: the shares of every (member, group) against 1.0.

    ``bad_rows`` counts shares that are NULL or not numeric.
    """
    number = F.col(share).try_cast("double")
    sums = shares.groupBy(member, group).agg(
        F.sum(number).alias("actual"),
        F.lit(1.0).alias("expected"),
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(number.isNull()).alias("bad_rows"),
    )
    return grade_members(sums, rule_name, group, member, tolerance, keep=["bad_rows"])


def share_rollup(
    items: DataFrame,
    rule_name: str,
    tolerance: float,
    requested: Sequence[str],
    passed_text: str = texts.SHARES_MATCH,
    failed_text: str = texts.SHARES_DIFFER,
) -> DataFrame:
    """``group_rollup`` rows of the requested groups, plus ``source_rows``.

    A requested group without rows is a warning. A single share that is not a
    number, in whatever group, makes every group critical and uncounted.
    """
    wanted = list(dict.fromkeys(requested))
    # Groups nobody asked for share one bucket: they only matter for bad shares.
    bucket = F.when(F.col("group_key").isin(wanted), F.col("group_key"))
    rows = items.select(
        bucket.alias("group_key"), F.lit(1).alias("member"), "n_rows", "bad_rows", "is_close", "actual"
    ).unionByName(
        local_rows(
            items.sparkSession, [{"group_key": g, "requested": 1} for g in wanted], _REQUEST
        ),
        allowMissingColumns=True,
    )
    per_group = rows.groupBy("group_key").agg(
        F.expr("count(member) AS members"),
        F.expr("count_if(NOT is_close) AS failures"),
        F.expr("sum(actual) AS total_actual"),
        F.expr("sum(n_rows) AS n_rows"),
        F.expr("sum(bad_rows) AS bad_rows"),
    )
    # One row for each requested group and one for the rest: small enough to
    # put side by side with what holds for the whole table.
    whole = per_group.agg(
        F.expr("coalesce(sum(n_rows), 0) AS source_rows"),
        F.expr("coalesce(sum(bad_rows), 0) > 0 AS broken"),
        F.expr(
            """collect_list(CASE WHEN group_key IS NOT NULL
                 THEN struct(group_key, members, failures, total_actual) END) AS groups"""
        ),
    ).selectExpr("source_rows", "broken", "inline(groups)")
    key = "group_key"
    return whole.selectExpr(
        f"{texts.quoted(rule_name)} AS rule_name",
        "group_key",
        f"""CASE WHEN broken THEN '{CRITICAL}' WHEN members = 0 THEN '{WARNING}'
            WHEN failures > 0 THEN '{CRITICAL}' ELSE '{SUCCESS}' END AS status""",
        "CASE WHEN NOT broken THEN failures END AS mismatches",
        "CASE WHEN broken THEN 0 ELSE members END AS total_members",
        "CASE WHEN NOT broken THEN total_actual END AS total_actual",
        "CASE WHEN NOT broken AND members > 0 THEN cast(members AS double) END AS total_expected",
        f"{float(tolerance)!r}D AS tolerance",
        f"""CASE WHEN broken THEN {texts.filled(texts.GROUP_NOT_VALIDATED, group=key)}
            WHEN members = 0 THEN {texts.filled(texts.NO_GROUP_DATA, group=key)}
            WHEN failures > 0 THEN {texts.filled(failed_text, group=key)}
            ELSE {texts.filled(passed_text, group=key)} END AS message""",
        "source_rows",
    )


def first_mismatches(items: DataFrame, limit: int, rollup: DataFrame | None = None) -> DataFrame:
    """The first ``limit`` mismatches of every group, by member.

    With a roll-up, only of groups that failed with counted mismatches. The
    planner keeps ``limit`` rows per group and task before it shuffles; groups
    that did not fail are dropped from the few rows that are left.
    """
    order = Window.partitionBy("group_key").orderBy("member_key")
    listed = (
        items.filter(~F.col("is_close"))
        .withColumn("position", F.row_number().over(order))
        .filter(F.col("position") <= limit)
    )
    if rollup is None:
        return listed
    failed = rollup.filter((F.col("mismatches") > 0) & (F.col("status") == CRITICAL))
    # An inner join with the distinct keys: a semi join would be moved below the limit.
    return listed.join(failed.select("group_key").distinct(), "group_key").select(listed.columns)


def member_summary(items: DataFrame) -> DataFrame:
    """One row over all items: their number, source rows, distinct members and groups.

    NULL counts as a member or group.
    """

    def distinct(column: str) -> Column:
        null = F.max(F.when(F.col(column).isNull(), 1).otherwise(0))
        return F.count_distinct(column) + F.coalesce(null, F.lit(0))

    return items.agg(
        F.count(F.lit(1)).alias("total_items"),
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("total_records"),
        distinct("member_key").alias("unique_members"),
        distinct("group_key").alias("unique_groups"),
    )
