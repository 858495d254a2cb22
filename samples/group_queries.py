"""Grouped sums, refinement and shares against expected values, and tolerance comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkchecks.functions.compare import loosely_close, relative_error, strictly_close
from sparkchecks.functions.exact import exact_sums
from sparkchecks.functions.measures import rounded_bigint
from sparkchecks.operators.groups import (
    first_mismatches,
    group_rollup,
    group_sum_items,
    mapped_sums,
    member_summary,
    refinement_items,
    share_items,
    share_rollup,
)

from .derived import SampleTables, with_derived
from .registry import sample

RTOL = 1e-5
FLAGS = ["A", "N", "R"]


def close_sql(actual: str, desired: str, rtol: float = RTOL, atol: float = 0.0) -> str:
    return f"abs({actual} - {desired}) <= {atol!r} + {rtol!r} * abs({desired})"


def shown(items: DataFrame) -> DataFrame:
    return items.select(
        "group_key",
        "member_key",
        F.round("actual", 2).alias("actual"),
        F.round("expected", 2).alias("expected"),
        "n_rows",
        "is_strictly_close",
        "is_close",
    )


def shown_rollup(rollup: DataFrame) -> DataFrame:
    return rollup.select(
        "group_key",
        "status",
        "mismatches",
        "total_members",
        F.round("total_actual", 2).alias("total_actual"),
        F.round("total_expected", 2).alias("total_expected"),
    )


def nation_items(tables: SampleTables, reference: str) -> DataFrame:
    sums = mapped_sums(
        tables.table("lineitem"),
        tables.table("order_nations"),
        "l_orderkey",
        "l_returnflag",
        "n_name",
        "l_extendedprice",
        FLAGS,
    )
    return group_sum_items(
        sums, tables.table(reference), "nations", RTOL, "flag", "region", "demand", FLAGS
    )


def nation_items_sql(reference: str) -> str:
    return f"""
    SELECT p.flag AS group_key, p.region AS member_key, actual, expected, n_rows,
           {close_sql("actual", "expected")} AS is_strictly_close,
           {close_sql("actual", "expected", atol=1e-8)} AS is_close
    FROM (SELECT l_returnflag AS flag, n_name AS region, sum(l_extendedprice) AS actual,
                 count(*) AS n_rows
          FROM lineitem JOIN order_nations USING (l_orderkey) GROUP BY l_returnflag, n_name) p
         JOIN (SELECT flag, region, sum(demand) AS expected FROM {reference}
               GROUP BY flag, region) r ON p.flag = r.flag AND p.region = r.region"""


def shown_sql(items: str) -> str:
    return f"""
    SELECT group_key, member_key, round(actual, 2) AS actual, round(expected, 2) AS expected,
           n_rows, is_strictly_close, is_close FROM ({items}) items"""


def rollup_sql(items: str) -> str:
    return f"""
    SELECT group_key,
           CASE WHEN count(CASE WHEN NOT is_strictly_close THEN 1 END) > 0
                THEN 'CRITICAL_FAILURE' ELSE 'SUCCESS' END AS status,
           count(CASE WHEN NOT is_close THEN 1 END) AS mismatches, count(*) AS total_members,
           round(CAST(sum(actual) AS double), 2) AS total_actual,
           round(CAST(sum(expected) AS double), 2) AS total_expected
    FROM ({items}) items GROUP BY group_key"""


@sample(
    "group_sum_check",
    with_derived("order_nations", "nation_reference") + shown_sql(nation_items_sql("nation_reference")),
)
def group_sum_check(tables: SampleTables) -> DataFrame:
    return shown(nation_items(tables, "nation_reference"))


@sample(
    "mapped_sum_join",
    with_derived("order_nations", "supplier_reference")
    + shown_sql(nation_items_sql("supplier_reference")),
)
def mapped_sum_join(tables: SampleTables) -> DataFrame:
    """Against sums over suppliers, which know no customers of one nation."""
    return shown(nation_items(tables, "supplier_reference"))


@sample(
    "group_sum_rollup",
    with_derived("order_nations", "nation_reference")
    + rollup_sql(nation_items_sql("nation_reference"))
    + """ UNION ALL SELECT 'X', 'CRITICAL_FAILURE', 0, 0, NULL, NULL""",
)
def group_sum_rollup(tables: SampleTables) -> DataFrame:
    """One flag is requested that no row has."""
    items = nation_items(tables, "nation_reference")
    return shown_rollup(group_rollup(items, "nations", RTOL, [*FLAGS, "X"]))


REFINED_SQL = """
    SELECT characteristics_code AS group_key, nuts3 AS member_key,
           CAST(actual AS double) AS actual, CAST(expected AS double) AS expected, n_rows,
           abs(actual - expected) <= 1e-5 * abs(expected) AS is_strictly_close,
           abs(actual - expected) <= 1e-8 + 1e-5 * abs(expected) AS is_close
    FROM (SELECT r.nuts3, r.characteristics_code, n_rows,
                 CAST(round(sum_refined, 0) AS bigint) AS actual,
                 CAST(round(sum_census, 0) AS bigint) AS expected
          FROM (SELECT nuts3, characteristics_code, sum(hh_10types) AS sum_refined,
                       count(*) AS n_rows
                FROM refined GROUP BY nuts3, characteristics_code) r
               JOIN (SELECT nuts3, characteristics_code, sum(orig) AS sum_census
                     FROM (SELECT nuts3, cell_id, characteristics_code,
                                  sum(DISTINCT hh_5types) AS orig
                           FROM refined GROUP BY cell_id, characteristics_code, nuts3) t
                     GROUP BY nuts3, characteristics_code) c
               ON r.nuts3 = c.nuts3 AND r.characteristics_code = c.characteristics_code) s"""


def refined(tables: SampleTables) -> DataFrame:
    return refinement_items(
        tables.table("refined"),
        "refinement",
        RTOL,
        "nuts3",
        "characteristics_code",
        "cell_id",
        "hh_5types",
        "hh_10types",
    )


@sample("refinement_check", with_derived("refined") + shown_sql(REFINED_SQL))
def refinement_check(tables: SampleTables) -> DataFrame:
    return shown(refined(tables))


@sample("refinement_rollup", with_derived("refined") + rollup_sql(REFINED_SQL))
def refinement_rollup(tables: SampleTables) -> DataFrame:
    return shown_rollup(group_rollup(refined(tables), "refinement", RTOL))


@sample(
    "refinement_summary",
    with_derived("refined")
    + """SELECT (SELECT count(*) FROM (SELECT DISTINCT nuts3, characteristics_code FROM refined) d)
                    AS total_items,
                count(*) AS total_records, count(DISTINCT nuts3) AS unique_members,
                count(DISTINCT characteristics_code) AS unique_groups FROM refined""",
)
def refinement_summary(tables: SampleTables) -> DataFrame:
    return member_summary(refined(tables))


SHARES_SQL = f"""
    SELECT scenario AS group_key, bus_id AS member_key, share_sum,
           n_rows, {close_sql("share_sum", "1.0", atol=1e-8)} AS is_close
    FROM (SELECT bus_id, scenario, sum(profile_share) AS share_sum, count(*) AS n_rows
          FROM order_shares GROUP BY bus_id, scenario) s"""


def shares(tables: SampleTables, table: str = "order_shares") -> DataFrame:
    return share_items(tables.table(table), "shares", RTOL, "bus_id", "scenario", "profile_share")


@sample(
    "share_sum_check",
    with_derived("order_shares")
    + f"""SELECT group_key, member_key, round(share_sum, 6) AS share_sum, n_rows, is_close
          FROM ({SHARES_SQL}) s""",
)
def share_sum_check(tables: SampleTables) -> DataFrame:
    return shares(tables).select(
        "group_key", "member_key", F.round("actual", 6).alias("share_sum"), "n_rows", "is_close"
    )


@sample(
    "share_sum_scenarios",
    with_derived("order_shares")
    + f"""
    SELECT group_key,
           CASE WHEN count(CASE WHEN NOT is_close THEN 1 END) > 0
                THEN 'CRITICAL_FAILURE' ELSE 'SUCCESS' END AS status,
           count(CASE WHEN NOT is_close THEN 1 END) AS mismatches, count(*) AS total_members,
           (SELECT count(*) FROM order_shares) AS source_rows
    FROM ({SHARES_SQL}) s WHERE group_key IN ('F', 'O') GROUP BY group_key
    UNION ALL SELECT 'X', 'WARNING', 0, 0, (SELECT count(*) FROM order_shares)""",
)
def share_sum_scenarios(tables: SampleTables) -> DataFrame:
    """Of three statuses two are requested, and one that does not occur."""
    rollup = share_rollup(shares(tables), "shares", RTOL, ["F", "O", "X"])
    return rollup.select("group_key", "status", "mismatches", "total_members", "source_rows")


@sample(
    "share_sum_invalid",
    with_derived("gapped_shares")
    + """
    SELECT flag AS group_key,
           CASE WHEN (SELECT count(*) FROM gapped_shares WHERE profile_share IS NULL) > 0
                THEN 'CRITICAL_FAILURE' ELSE 'SUCCESS' END AS status,
           (SELECT count(*) FROM gapped_shares WHERE profile_share IS NULL) > 0 AS is_uncounted,
           CAST(0 AS bigint) AS total_members,
           (SELECT count(*) FROM gapped_shares) AS source_rows
    FROM (VALUES ('A'), ('N')) requested(flag)""",
)
def share_sum_invalid(tables: SampleTables) -> DataFrame:
    """Some shares are NULL, so no group can be graded."""
    rollup = share_rollup(shares(tables, "gapped_shares"), "shares", RTOL, ["A", "N"])
    return rollup.select(
        "group_key",
        "status",
        F.col("mismatches").isNull().alias("is_uncounted"),
        "total_members",
        "source_rows",
    )


@sample(
    "share_summary",
    with_derived("order_shares")
    + """SELECT (SELECT count(*) FROM (SELECT DISTINCT bus_id, scenario FROM order_shares) d)
                    AS total_items,
                count(*) AS total_records, count(DISTINCT bus_id) AS unique_members,
                count(DISTINCT scenario) AS unique_groups FROM order_shares""",
)
def share_summary(tables: SampleTables) -> DataFrame:
    return member_summary(shares(tables))


@sample(
    "first_mismatches",
    with_derived("order_shares")
    + f"""
    SELECT group_key, member_key, round(share_sum, 6) AS share_sum, n_rows,
           CAST(position AS integer) AS position
    FROM (SELECT *, row_number() OVER (PARTITION BY group_key ORDER BY member_key) AS position
          FROM ({SHARES_SQL}) s WHERE NOT is_close) m WHERE position <= 10""",
)
def listed_mismatches(tables: SampleTables) -> DataFrame:
    return first_mismatches(shares(tables), 10).select(
        "group_key", "member_key", F.round("actual", 6).alias("share_sum"), "n_rows", "position"
    )


_SHIFT = """CASE o_orderpriority WHEN '1-URGENT' THEN 0.0 WHEN '2-HIGH' THEN 1e-9
            WHEN '3-MEDIUM' THEN 1e-6 WHEN '4-NOT SPECIFIED' THEN 1e-4 ELSE -1e-3 END"""


@sample(
    "closeness_grid",
    f"""
    SELECT o_orderpriority, count(*) AS n_orders,
           count(CASE WHEN {close_sql("shifted", "o_totalprice")} THEN 1 END) AS strict_matches,
           count(CASE WHEN {close_sql("shifted", "o_totalprice", atol=1e-8)} THEN 1 END)
               AS loose_matches,
           round(max(abs(shifted - o_totalprice) / o_totalprice), 7) AS max_relative_error
    FROM (SELECT o_orderpriority, o_totalprice, o_totalprice * (1 + {_SHIFT}) AS shifted
          FROM orders) s GROUP BY o_orderpriority""",
)
def closeness_grid(tables: SampleTables) -> DataFrame:
    """Order totals shifted by less and by more than the tolerance."""
    shifted = tables.table("orders").select(
        "o_orderpriority", "o_totalprice", F.expr(f"o_totalprice * (1 + {_SHIFT})").alias("shifted")
    )
    actual, desired = "shifted", "o_totalprice"
    return shifted.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.count_if(strictly_close(actual, desired, RTOL)).alias("strict_matches"),
        F.count_if(loosely_close(actual, desired, RTOL)).alias("loose_matches"),
        F.round(F.max(relative_error(actual, desired)), 7).alias("max_relative_error"),
    )


@sample(
    "rounded_sums",
    """
    SELECT o_orderpriority, round(CAST(total AS double), 2) AS total,
           CAST(round(total, 0) AS bigint) AS rounded_total
    FROM (SELECT o_orderpriority, sum(CAST(o_totalprice AS decimal(28, 10))) AS total
          FROM orders GROUP BY o_orderpriority) s""",
)
def rounded_sums(tables: SampleTables) -> DataFrame:
    sums = exact_sums(tables.table("orders"), ["o_orderpriority"], {"total": F.col("o_totalprice")})
    whole = F.col("total").cast("decimal(28,10)")
    return sums.select(
        "o_orderpriority",
        F.round("total", 2).alias("total"),
        rounded_bigint(whole, T.DecimalType(28, 10)).alias("rounded_total"),
    )


@sample(
    "tiny_sums",
    # Every value is a whole number of 2^-90, so the sum is exact and rounded once.
    """SELECT o_orderpriority, CAST(sum(CAST(o_totalprice / 7e11 * pow(2.0, 90) AS hugeint)) AS double) / pow(2.0, 90) AS total
       FROM orders GROUP BY o_orderpriority""",
)
def tiny_sums(tables: SampleTables) -> DataFrame:
    """Values far below 1e-4 with long fractions: sums that are exact to the last bit."""
    return exact_sums(tables.table("orders"), ["o_orderpriority"], {"total": F.col("o_totalprice") / 7e11})


@sample(
    "decimal_group_sums",
    """SELECT CAST(o_orderstatus AS varchar) AS group_key, c_nationkey AS region,
              round(CAST(sum(CAST(o_totalprice AS decimal(18, 2)) * 0.00000001) AS double), 7) AS total, count(*) AS n_rows
       FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus IN ('F', 'O') GROUP BY ALL""",
)
def decimal_group_sums(tables: SampleTables) -> DataFrame:
    """Sums of decimals with ten fraction digits, mapped to regions; no digit is given up."""
    price = (F.col("o_totalprice").cast("decimal(18,2)") * F.lit(0.00000001).cast("decimal(9,8)")).cast("decimal(28,10)")
    detail = tables.table("orders").select("o_orderstatus", F.col("o_custkey").alias("cust"), price.alias("x"))
    mapping = tables.table("customer").select(F.col("c_custkey").alias("cust"), "c_nationkey")
    sums = mapped_sums(detail, mapping, "cust", "o_orderstatus", "c_nationkey", "x", ["F", "O"])
    return sums.select("group_key", "region", F.round("total", 7).alias("total"), "n_rows")


@sample(
    "listed_with_rollup",
    with_derived("order_shares")
    + f"""
    SELECT group_key, member_key, round(share_sum, 6) AS share_sum, n_rows,
           CAST(position AS integer) AS position
    FROM (SELECT *, row_number() OVER (PARTITION BY group_key ORDER BY member_key) AS position
          FROM ({SHARES_SQL}) s WHERE NOT is_close) m WHERE position <= 10 AND group_key <> 'P'""",
)
def listed_with_rollup(tables: SampleTables) -> DataFrame:
    """First mismatches of groups that a roll-up has as failed; one group was not asked for."""
    items = shares(tables)
    rollup = share_rollup(items, "shares", RTOL, ["F", "O"])
    return first_mismatches(items, 10, rollup).select(
        "group_key", "member_key", F.round("actual", 6).alias("share_sum"), "n_rows", "position"
    )
