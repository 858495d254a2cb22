"""Reconciliation of input totals with output totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkchecks import Dimension, Part, SeriesTotal, Total, reconcile
from sparkchecks.functions.compare import classify_deviation
from sparkchecks.functions.exact import exact_sums
from sparkchecks.functions.measures import array_totals as array_sums
from sparkchecks.functions.status import status_tallies, worst_status
from sparkchecks.plans.specs import BIOMASS_CARRIERS, ELECTRICITY_PARTS, GENERATOR_CARRIERS
from sparkchecks.plans.specs import HEAT_PARTS

from .derived import SampleTables, with_derived
from .registry import sample

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW", "9-NONE"]


def rounded(value: str, digits: int) -> str:
    """SQL of a rounded value without a negative zero."""
    return f"CASE WHEN round({value}, {digits}) = 0 THEN 0e0 ELSE round({value}, {digits}) END"


def shown(items: DataFrame) -> DataFrame:
    """Comparable columns; an infinite deviation shows as NULL with a flag."""
    infinite = "abs(deviation_percent) = double('Infinity')"
    return items.selectExpr(
        "ordinal",
        "component",
        f"{rounded('input_total', 2)} AS input_total",
        f"{rounded('output_total', 2)} AS output_total",
        f"CASE WHEN NOT ({infinite}) THEN {rounded('deviation_percent', 6)} END AS deviation_percent",
        f"{infinite} AS is_infinite",
        "status",
    )


def graded_sql(expected: list[str], inputs: str, outputs: str, tolerance: float) -> str:
    """SQL that grades expected components from (component, total) queries."""
    rows = ", ".join(f"({i}, '{c}')" for i, c in enumerate(expected))
    return f"""
    SELECT CAST(ordinal AS integer) AS ordinal, component, {rounded("i", 2)} AS input_total,
           {rounded("o", 2)} AS output_total,
           CASE WHEN i = 0 AND o = 0 THEN 0e0 WHEN i > 0 AND o = 0 THEN -100e0
                WHEN i = 0 THEN NULL
                ELSE {rounded("(o - i) / i * 100", 6)} END AS deviation_percent,
           i = 0 AND o > 0 AS is_infinite,
           CASE WHEN i = 0 AND o = 0 THEN 'SUCCESS'
                WHEN i = 0 OR o = 0 THEN 'CRITICAL_FAILURE'
                WHEN abs((o - i) / i * 100) <= {tolerance} THEN 'SUCCESS'
                ELSE 'WARNING' END AS status
    FROM (SELECT e.ordinal, e.component, coalesce(ti.total, 0.0) AS i, coalesce(t.total, 0.0) AS o
          FROM (VALUES {rows}) e(ordinal, component)
               LEFT JOIN (SELECT component, CAST(sum(total) AS double) AS total
                          FROM ({inputs}) x GROUP BY component) ti ON e.component = ti.component
               LEFT JOIN (SELECT component, CAST(sum(total) AS double) AS total
                          FROM ({outputs}) x GROUP BY component) t ON e.component = t.component) g"""


PRIORITY_PARTS = [
    Part(
        PRIORITIES,
        inputs=[Total("home_capacities", "capacity", {p: [p] for p in PRIORITIES}, "carrier")],
        outputs=[
            Total(
                "home_orders",
                "p_nom",
                {p: [p] for p in PRIORITIES if p != "5-LOW"},
                "carrier",
                dimension=Dimension("customer", "bus", "c_custkey", {"c_nationkey": 7}),
            )
        ],
    )
]
PRIORITY_SQL = graded_sql(
    PRIORITIES,
    "SELECT carrier AS component, capacity AS total FROM home_capacities",
    """SELECT carrier AS component, p_nom AS total FROM home_orders
       WHERE carrier <> '5-LOW' AND bus IN (SELECT c_custkey FROM customer WHERE c_nationkey = 7)""",
    5.0,
)


def reconciled(tables: SampleTables, parts: list[Part], tolerance: float = 5.0) -> DataFrame:
    return shown(reconcile(tables, "sample", parts, tolerance, {}))


@sample("reconcile_totals", with_derived("home_orders", "home_capacities") + PRIORITY_SQL)
def reconcile_totals(tables: SampleTables) -> DataFrame:
    """One component per outcome: close, off, without input, without output, with neither."""
    return reconciled(tables, PRIORITY_PARTS)


POOLS = {"BUDGET": ["ECONOMY", "PROMO"], "LARGE": ["LARGE"], "MEDIUM": ["MEDIUM", "STANDARD"]}


@sample(
    "reconcile_pooled",
    with_derived("part_sales", "part_plans")
    + graded_sql(
        list(POOLS),
        """SELECT CASE WHEN p_type = 'ECONOMY' THEN 'BUDGET' ELSE p_type END AS component,
                  planned AS total FROM part_plans WHERE p_type IN ('ECONOMY', 'LARGE', 'MEDIUM')""",
        """SELECT CASE WHEN p_type IN ('ECONOMY', 'PROMO') THEN 'BUDGET'
                       WHEN p_type IN ('MEDIUM', 'STANDARD') THEN 'MEDIUM' ELSE p_type END AS component,
                  l_quantity AS total FROM part_sales WHERE p_type <> 'SMALL'""",
        5.0,
    ),
)
def reconcile_pooled(tables: SampleTables) -> DataFrame:
    """Outputs pool several types where the inputs are planned under one."""
    own = {"BUDGET": ["ECONOMY"], "LARGE": ["LARGE"], "MEDIUM": ["MEDIUM"]}
    part = Part(
        list(POOLS),
        [Total("part_plans", "planned", own, "p_type")],
        [Total("part_sales", "l_quantity", POOLS, "p_type")],
    )
    return reconciled(tables, [part])


@sample(
    "reconcile_multi_source",
    graded_sql(
        ["finished", "open", "returned", "kept"],
        """SELECT CASE l_returnflag WHEN 'R' THEN 'returned' WHEN 'N' THEN 'kept' END AS component,
                  l_quantity AS total FROM lineitem WHERE l_returnflag <> 'A'
           UNION ALL
           SELECT CASE o_orderstatus WHEN 'F' THEN 'finished' ELSE 'open' END, o_totalprice / 3
           FROM orders WHERE o_orderstatus <> 'P'""",
        """SELECT CASE o_orderstatus WHEN 'F' THEN 'finished' ELSE 'open' END AS component,
                  o_totalprice AS total FROM orders WHERE o_orderstatus <> 'P'
           UNION ALL
           SELECT CASE l_returnflag WHEN 'R' THEN 'returned' ELSE 'kept' END, l_quantity
           FROM lineitem WHERE l_returnflag <> 'A'""",
        5.0,
    ),
)
def reconcile_multi_source(tables: SampleTables) -> DataFrame:
    """Components of one rule whose outputs come from different tables."""
    orders = {"finished": ["F"], "open": ["O"]}
    lines = {"returned": ["R"], "kept": ["N"]}
    part = Part(
        ["finished", "open", "returned", "kept"],
        [
            Total("lineitem", "l_quantity", lines, "l_returnflag"),
            Total("orders", "o_totalprice", orders, "o_orderstatus", divisor=3),
        ],
        [
            Total("orders", "o_totalprice", orders, "o_orderstatus"),
            Total("lineitem", "l_quantity", lines, "l_returnflag"),
        ],
    )
    return reconciled(tables, [part])


LANGUAGES = ["de", "en", "es", "fr"]
SERIES_PARTS = [
    Part(
        LANGUAGES,
        inputs=[
            Total("documents", "n_chars", {lang: [lang] for lang in LANGUAGES}, "lang", divisor=1e5)
        ],
        outputs=[
            SeriesTotal(
                table="documents",
                key="lang",
                members={lang: [lang] for lang in LANGUAGES},
                series_table="vectors",
                series_key="doc_id",
                series_value="embedding",
                dimension=Dimension("labels", "doc_id", "doc_id", {"quality": 1}),
            )
        ],
    )
]
SERIES_SQL = graded_sql(
    LANGUAGES,
    "SELECT lang AS component, CAST(n_chars AS double) / 100000 AS total FROM documents",
    """SELECT lang AS component, list_sum(CAST(embedding AS double[])) AS total
       FROM documents d JOIN embeddings e ON d.doc_id = e.vec_id
            JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality = 1""",
    5.0,
)


@sample("array_total_reconcile", SERIES_SQL)
def array_total_reconcile(tables: SampleTables) -> DataFrame:
    return reconciled(tables, SERIES_PARTS)


@sample(
    "array_totals",
    with_derived("dirty_embeddings")
    + """
    SELECT label, count(*) AS n_arrays, count(total) AS n_totals, round(sum(total), 4) AS total
    FROM (SELECT label, list_sum(CAST(embedding AS double[])) AS total FROM dirty_embeddings) t
    GROUP BY label""",
)
def array_totals(tables: SampleTables) -> DataFrame:
    """Every array reduced to its sum; empty and NULL arrays have none."""
    arrays = tables.table("dirty_embeddings").select("vec_id", "label", "embedding")
    return (
        arrays.select("vec_id", "label")
        .join(array_sums(arrays, ["vec_id"], "embedding"), "vec_id", "left")
        .groupBy("label")
        .agg(
            F.count(F.lit(1)).alias("n_arrays"),
            F.count("total").alias("n_totals"),
            F.round(F.sum("total"), 4).alias("total"),
        )
    )


@sample(
    "deviation_branches",
    """
    SELECT o_orderpriority, status, count(*) AS n_orders, round(sum(dev), 4) AS total_deviation
    FROM (SELECT o_orderpriority,
                 CASE WHEN i = 0 AND o = 0 THEN 'SUCCESS'
                      WHEN i = 0 OR o = 0 THEN 'CRITICAL_FAILURE'
                      WHEN abs((o - i) / i * 100) <= 25.0 THEN 'SUCCESS' ELSE 'WARNING' END AS status,
                 CASE WHEN i = 0 THEN 0.0 ELSE (o - i) / i * 100 END AS dev
          FROM (SELECT o_orderpriority,
                       CASE WHEN o_orderstatus = 'F' THEN 0.0 ELSE o_totalprice END AS i,
                       coalesce(s.total, 0.0) AS o
                FROM orders LEFT JOIN (SELECT l_orderkey, sum(l_extendedprice) AS total
                                       FROM lineitem GROUP BY l_orderkey) s
                     ON o_orderkey = s.l_orderkey) t) g
    GROUP BY o_orderpriority, status""",
)
def deviation_branches(tables: SampleTables) -> DataFrame:
    """Every order graded: its total against its lines, finished orders without an input."""
    lines = tables.table("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum("l_extendedprice").alias("lines")
    )
    totals = tables.table("orders").join(lines, "o_orderkey", "left").select(
        "o_orderpriority",
        F.col("o_orderkey").cast("string").alias("component"),
        F.when(F.col("o_orderstatus") == "F", 0.0).otherwise(F.col("o_totalprice")).alias("i"),
        F.coalesce("lines", F.lit(0.0)).alias("o"),
    )
    verdict = classify_deviation("component", "i", "o", 25.0)
    finite = F.abs("deviation_percent") != float("inf")
    return (
        totals.select("o_orderpriority", *[c.alias(n) for n, c in verdict.items()])
        .groupBy("o_orderpriority", "status")
        .agg(
            F.count(F.lit(1)).alias("n_orders"),
            F.round(
                F.sum(F.when(finite, F.col("deviation_percent")).otherwise(0.0)), 4
            ).alias("total_deviation"),
        )
    )


def tallied(items: DataFrame) -> DataFrame:
    return items.agg(
        *[c.alias(n) for n, c in status_tallies("status").items()],
        worst_status("status").alias("status"),
    )


@sample(
    "sector_rollup",
    with_derived("home_orders", "home_capacities")
    + f"""
    SELECT count(*) AS total, count(CASE WHEN status = 'SUCCESS' THEN 1 END) AS passed,
           count(CASE WHEN status = 'WARNING' THEN 1 END) AS warnings,
           count(CASE WHEN status = 'CRITICAL_FAILURE' THEN 1 END) AS failed,
           CASE WHEN count(CASE WHEN status = 'CRITICAL_FAILURE' THEN 1 END) > 0
                THEN 'CRITICAL_FAILURE'
                WHEN count(CASE WHEN status = 'WARNING' THEN 1 END) > 0 THEN 'WARNING'
                ELSE 'SUCCESS' END AS status
    FROM (SELECT status FROM ({PRIORITY_SQL}) a UNION ALL SELECT status FROM ({SERIES_SQL}) b) u""",
)
def sector_rollup(tables: SampleTables) -> DataFrame:
    parts = PRIORITY_PARTS + SERIES_PARTS
    return tallied(reconcile(tables, "sector", parts, 5.0, {}))


# The shipped sector rules over the stand-in tables.

_DOMESTIC = "(SELECT bus_id FROM bus WHERE scn_name = 'eGon2035' AND country = 'DE')"


def _series_sql(component: str, carriers: list[str]) -> str:
    listed = ", ".join(f"'{c}'" for c in carriers)
    return f"""
    SELECT '{component}' AS component, list_sum(CAST(s.p_set AS double[])) / 1000000 AS total
    FROM load a JOIN load_series s ON a.load_id = s.load_id JOIN bus b ON a.bus = b.bus_id
    WHERE a.carrier IN ({listed}) AND b.country = 'DE' AND a.scn_name = 'eGon2035'
          AND s.scn_name = 'eGon2035' AND b.scn_name = 'eGon2035'"""


_BIOMASS = ", ".join(f"'{c}'" for c in BIOMASS_CARRIERS)
ELECTRICITY_SQL = graded_sql(
    [*GENERATOR_CARRIERS, "storage_pumped_hydro", "electricity_demand"],
    """SELECT CASE WHEN carrier = 'pumped_hydro' THEN 'storage_pumped_hydro' ELSE carrier END
              AS component, capacity AS total FROM capacities
       UNION ALL SELECT 'electricity_demand', demand / 1000000 FROM household_demand
                 WHERE scenario = 'eGon2035' AND year = '2035'
       UNION ALL SELECT 'electricity_demand', demand / 1000000 FROM industry_demand
                 WHERE scenario = 'eGon2035' AND year = '2035'""",
    f"""SELECT CASE WHEN carrier IN ({_BIOMASS}) THEN 'biomass' ELSE carrier END AS component,
               p_nom AS total FROM generator WHERE bus IN {_DOMESTIC}
        UNION ALL SELECT 'storage_pumped_hydro', p_nom FROM storage
                  WHERE carrier = 'pumped_hydro' AND bus IN {_DOMESTIC}
        UNION ALL {_series_sql("electricity_demand", ["AC"])}""",
    5.0,
)
ELECTRICITY_DERIVED = [
    "generator", "storage", "bus", "load", "load_series", "capacities", "household_demand",
    "industry_demand",
]

HEAT_COMPONENTS = [c for part in HEAT_PARTS for c in part.components]
HEAT_SQL = graded_sql(
    HEAT_COMPONENTS,
    """SELECT CASE carrier WHEN 'urban_central_heat_pump' THEN 'central_heat_pump'
                           WHEN 'residential_rural_heat_pump' THEN 'residential_heat_pump'
                           WHEN 'urban_central_resistive_heater' THEN 'resistive_heater'
                           WHEN 'urban_central_solar_thermal_collector' THEN 'solar_thermal'
                           WHEN 'urban_central_geo_thermal' THEN 'geothermal' END AS component,
              capacity AS total FROM capacities
       UNION ALL SELECT 'heat_demand', demand / 1000000 FROM heat_demand""",
    f"""SELECT CASE carrier WHEN 'rural_heat_pump' THEN 'residential_heat_pump'
                           WHEN 'central_resistive_heater' THEN 'resistive_heater'
                           ELSE carrier END AS component, p_nom AS total FROM link
        UNION ALL
        SELECT CASE carrier WHEN 'solar_thermal_collector' THEN 'solar_thermal'
                            WHEN 'geo_thermal' THEN 'geothermal' END, p_nom FROM generator
        UNION ALL {_series_sql("heat_demand", ["rural_heat", "central_heat"])}""",
    5.0,
)
HEAT_DERIVED = ["generator", "link", "bus", "load", "load_series", "capacities", "heat_demand"]


@sample("electricity_sector", with_derived(*ELECTRICITY_DERIVED) + ELECTRICITY_SQL)
def electricity_sector(tables: SampleTables) -> DataFrame:
    params = {"scenario": "eGon2035", "year": "2035"}
    return shown(reconcile(tables, "electricity", ELECTRICITY_PARTS, 5.0, params))


@sample("heat_sector", with_derived(*HEAT_DERIVED) + HEAT_SQL)
def heat_sector(tables: SampleTables) -> DataFrame:
    return shown(reconcile(tables, "heat", HEAT_PARTS, 5.0, {"scenario": "eGon2035"}))


@sample(
    "bound_query",
    """
    SELECT o_orderpriority, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total
    FROM orders JOIN customer ON o_custkey = c_custkey
    WHERE o_orderstatus = 'F' AND c_acctbal > 1000.0 GROUP BY o_orderpriority""",
)
def bound_query(tables: SampleTables) -> DataFrame:
    sums = tables.query(
        """SELECT o_orderpriority, o_totalprice FROM {orders} JOIN {customer} ON o_custkey = c_custkey
           WHERE o_orderstatus = :status AND c_acctbal > :balance""",
        {"status": "F", "balance": 1000.0},
        orders="orders",
        customer="customer",
    )
    totals = exact_sums(sums, ["o_orderpriority"], {"total": F.col("o_totalprice")}, {"n_orders": F.count(F.lit(1))})
    return totals.select("o_orderpriority", "n_orders", F.round("total", 2).alias("total"))
