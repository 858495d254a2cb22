"""Tables derived from the sample tables, as SQL that Spark and DuckDB both read.

The sample tables are clean, so checks on them would all pass. The derived ones
have NULLs, NaN, short arrays and altered sums, over all rows of their sources.
``{name}`` stands for a sample table or another derived table.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from sparkchecks import FileTables, FrameTables

SAMPLE_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

DERIVED: dict[str, str] = {
    # --- column checks
    "dirty_lineitem": """
        SELECT l_orderkey, l_extendedprice, l_discount, l_tax,
               CASE WHEN l_linenumber = 3 THEN NULL ELSE l_quantity END AS l_quantity
        FROM {lineitem}""",
    "dirty_events": """
        SELECT user_id, ts,
               CASE WHEN event_type = 'error' THEN CAST('NaN' AS double)
                    WHEN event_type = 'view' THEN NULL ELSE value END AS value,
               CASE WHEN event_type = 'signup' THEN CAST('Infinity' AS double) ELSE value END AS amount,
               CASE event_type WHEN 'signup' THEN 'n/a' WHEN 'purchase' THEN 'NaN'
                    WHEN 'view' THEN '5.' WHEN 'click' THEN '.5' ELSE '1e3' END AS reading,
               CASE event_type WHEN 'signup' THEN NULL WHEN 'purchase' THEN ''
                    WHEN 'view' THEN '-7' WHEN 'click' THEN '+1.25E-3' ELSE '12' END AS code
        FROM {events}""",
    "dirty_embeddings": """
        SELECT vec_id, label,
               CASE WHEN label = 9 THEN NULL
                    WHEN label = 8 THEN {slice}(embedding, 1, 0)
                    ELSE {slice}(embedding, 1, 64 - least(label, 2)) END AS embedding,
               CASE WHEN label = 9 THEN NULL
                    WHEN label = 4 THEN {array}(CAST('NaN' AS float), CAST(1 AS float))
                    WHEN label = 5 THEN {array}(CAST('-Infinity' AS float))
                    ELSE embedding END AS noisy
        FROM {embeddings}""",
    # --- totals
    "home_orders": """
        SELECT o_custkey AS bus, o_orderpriority AS carrier, o_totalprice AS p_nom
        FROM {orders}""",
    "home_capacities": """
        SELECT o_orderpriority AS carrier,
               o_totalprice * CASE o_orderpriority WHEN '2-HIGH' THEN 1.03
                                                   WHEN '3-MEDIUM' THEN 1.2 ELSE 1.0 END AS capacity
        FROM {orders} JOIN {customer} ON o_custkey = c_custkey
        WHERE c_nationkey = 7 AND o_orderpriority <> '4-NOT SPECIFIED'""",
    "part_sales": """
        SELECT p_type, l_quantity FROM {lineitem} JOIN {part} ON l_partkey = p_partkey""",
    "part_plans": """
        SELECT p_type, l_quantity * CASE p_type WHEN 'LARGE' THEN 1.5 ELSE 1.01 END AS planned
        FROM {lineitem} JOIN {part} ON l_partkey = p_partkey WHERE p_type <> 'PROMO'""",
    "vectors": """
        SELECT vec_id AS doc_id, embedding FROM {embeddings}""",
    # --- group sums
    "order_nations": """
        SELECT o_orderkey AS l_orderkey, n_name
        FROM {orders} JOIN {customer} ON o_custkey = c_custkey
             JOIN {nation} ON c_nationkey = n_nationkey""",
    "nation_reference": """
        SELECT n_name AS region, l_returnflag AS flag,
               l_extendedprice * CASE n_name WHEN 'NATION_3' THEN 1.01
                                             WHEN 'NATION_5' THEN 1.0000001 ELSE 1.0 END AS demand
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
             JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey""",
    "supplier_reference": """
        SELECT CASE WHEN s_nationkey = 0 THEN NULL ELSE n_name END AS region,
               l_returnflag AS flag, l_extendedprice AS demand
        FROM {lineitem} JOIN {supplier} ON l_suppkey = s_suppkey
             JOIN {nation} ON s_nationkey = n_nationkey""",
    # --- refinement
    "refined": """
        SELECT o_orderstatus AS nuts3, o_custkey AS cell_id, l_returnflag AS characteristics_code,
               CAST(CASE WHEN l_returnflag = 'N' THEN l_extendedprice ELSE l_linenumber END
                    AS decimal(12,2)) AS hh_5types,
               CAST(CASE WHEN l_returnflag = 'N' THEN l_extendedprice ELSE l_linenumber END
                    AS decimal(12,2)) AS hh_10types
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey""",
    # --- shares
    "order_shares": """
        SELECT l.l_orderkey AS bus_id, o.o_orderstatus AS scenario,
               l.l_quantity / q.total
               * CASE WHEN o.o_orderpriority = '1-URGENT' THEN 0.9 ELSE 1.0 END AS profile_share
        FROM {lineitem} l
             JOIN (SELECT l_orderkey, sum(l_quantity) AS total FROM {lineitem}
                   GROUP BY l_orderkey) q ON l.l_orderkey = q.l_orderkey
             JOIN {orders} o ON l.l_orderkey = o.o_orderkey""",
    "gapped_shares": """
        SELECT l_orderkey AS bus_id, l_returnflag AS scenario,
               CASE WHEN l_tax > 0.07 THEN NULL ELSE l_discount END AS profile_share
        FROM {lineitem}""",
    # --- stand-ins for the tables the shipped rule sets name
    "bus": """
        SELECT c_custkey AS bus_id, 'eGon2035' AS scn_name, 'AC' AS carrier,
               CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'DE' ELSE 'FR' END AS country
        FROM {customer}""",
    "generator": """
        SELECT o_custkey AS bus, 'eGon2035' AS scn_name, o_totalprice AS p_nom,
               CASE concat(substr(o_orderpriority, 1, 1), o_orderstatus)
                    WHEN '1F' THEN 'others' WHEN '1O' THEN 'reservoir' WHEN '1P' THEN 'run_of_river'
                    WHEN '2F' THEN 'oil' WHEN '2O' THEN 'wind_onshore' WHEN '2P' THEN 'wind_offshore'
                    WHEN '3F' THEN 'solar' WHEN '3O' THEN 'solar_rooftop' WHEN '3P' THEN 'biomass'
                    WHEN '4F' THEN 'industrial_biomass_CHP' WHEN '4O' THEN 'central_biomass_CHP'
                    WHEN '4P' THEN 'solar_thermal_collector' WHEN '5F' THEN 'geo_thermal'
                    ELSE 'unplanned' END AS carrier
        FROM {orders}""",
    "storage": """
        SELECT l_suppkey AS bus, 'eGon2035' AS scn_name, l_quantity AS p_nom,
               CASE WHEN l_returnflag = 'R' THEN 'pumped_hydro' ELSE 'battery' END AS carrier
        FROM {lineitem}""",
    "link": """
        SELECT 'eGon2035' AS scn_name, l_extendedprice AS p_nom,
               CASE l_linenumber WHEN 1 THEN 'central_heat_pump' WHEN 2 THEN 'rural_heat_pump'
                    WHEN 3 THEN 'central_resistive_heater' ELSE 'other' END AS carrier
        FROM {lineitem}""",
    "load": """
        SELECT doc_id AS load_id, doc_id AS bus, 'eGon2035' AS scn_name,
               CASE lang WHEN 'en' THEN 'AC' WHEN 'de' THEN 'rural_heat'
                    WHEN 'fr' THEN 'central_heat' ELSE 'other' END AS carrier
        FROM {documents}""",
    "load_series": """
        SELECT doc_id AS load_id, 'eGon2035' AS scn_name,
               {array}(CAST(n_chars AS double) * 200, NULL, CAST(n_chars AS double) * 300) AS p_set
        FROM {documents}""",
    "capacities": """
        SELECT carrier, scn_name AS scenario_name,
               p_nom * CASE carrier WHEN 'oil' THEN 1.04 WHEN 'solar' THEN 1.3 ELSE 1.0 END AS capacity
        FROM {generator} JOIN (SELECT bus_id FROM {bus} WHERE country = 'DE') b ON bus = b.bus_id
        WHERE carrier NOT IN ('reservoir', 'solar_thermal_collector', 'geo_thermal')
        UNION ALL
        SELECT 'pumped_hydro', scn_name, p_nom / 2 FROM {storage} WHERE carrier = 'pumped_hydro'
        UNION ALL
        SELECT CASE carrier WHEN 'central_heat_pump' THEN 'urban_central_heat_pump'
                            WHEN 'rural_heat_pump' THEN 'residential_rural_heat_pump'
                            ELSE 'urban_central_resistive_heater' END,
               scn_name, p_nom * CASE carrier WHEN 'rural_heat_pump' THEN 1.1 ELSE 1.01 END
        FROM {link} WHERE carrier <> 'other'
        UNION ALL
        SELECT 'urban_central_geo_thermal', scn_name, p_nom FROM {generator}
        WHERE carrier = 'geo_thermal'""",
    "cell_demand": """
        SELECT l_orderkey AS zensus_population_id,
               CASE WHEN l_linestatus = 'O' THEN 'eGon2035' ELSE 'eGon100RE' END AS scenario,
               CASE WHEN l_returnflag = 'A' THEN 'residential' ELSE 'CTS' END AS sector,
               l_extendedprice AS demand
        FROM {lineitem}""",
    "cell_map": """
        SELECT l_orderkey AS zensus_population_id, n_name AS vg250_nuts3 FROM {order_nations}""",
    "household_demand": """
        SELECT n_name AS nuts3, '2035' AS year, d.scenario,
               d.demand * CASE WHEN n_name = 'NATION_3' AND d.scenario = 'eGon100RE'
                               THEN 1.001 ELSE 1.0 END AS demand
        FROM {cell_demand} d JOIN {order_nations} ON d.zensus_population_id = l_orderkey
        WHERE d.sector = 'residential'""",
    "industry_demand": """
        SELECT 'eGon2035' AS scenario, '2035' AS year, s_acctbal AS demand FROM {supplier}""",
    "heat_demand": """
        SELECT 'eGon2035' AS scenario, s_acctbal AS demand FROM {supplier}""",
    "power_plants": """
        SELECT s_acctbal AS el_capacity, CAST(NULL AS varchar(10)) AS carrier FROM {supplier}""",
    "building_shares": """
        SELECT bus_id, CASE scenario WHEN 'F' THEN 'eGon2035' ELSE 'other' END AS scenario,
               profile_share FROM {order_shares}""",
    "exact_shares": """
        SELECT l.l_orderkey AS bus_id,
               CASE WHEN o.o_orderstatus = 'F' THEN 'eGon100RE' ELSE 'eGon2035' END AS scenario,
               l.l_quantity / q.total AS profile_share
        FROM {lineitem} l
             JOIN (SELECT l_orderkey, sum(l_quantity) AS total FROM {lineitem}
                   GROUP BY l_orderkey) q ON l.l_orderkey = q.l_orderkey
             JOIN {orders} o ON l.l_orderkey = o.o_orderkey""",
}

# Which derived table stands in for a table of the shipped rule sets.
STAND_INS = {
    "grid.egon_etrago_bus": "bus",
    "grid.egon_etrago_generator": "generator",
    "grid.egon_etrago_storage": "storage",
    "grid.egon_etrago_link": "link",
    "grid.egon_etrago_load": "load",
    "grid.egon_etrago_load_timeseries": "load_series",
    "supply.egon_scenario_capacities": "capacities",
    "supply.egon_power_plants": "power_plants",
    "demand.egon_demandregio_hh": "household_demand",
    "demand.egon_demandregio_cts_ind": "industry_demand",
    "demand.egon_peta_heat": "heat_demand",
    "demand.egon_demandregio_zensus_electricity": "cell_demand",
    "boundaries.egon_map_zensus_vg250": "cell_map",
    "society.egon_destatis_zensus_household_per_ha_refined": "refined",
    "demand.egon_cts_electricity_demand_building_share": "building_shares",
    "demand.egon_cts_heat_demand_building_share": "exact_shares",
}

_DIALECT = {
    "spark": {"slice": "slice", "array": "array"},
    "duckdb": {"slice": "list_slice", "array": "list_value"},
}


def _names(sql: str) -> list[str]:
    return [n for n in dict.fromkeys(re.findall(r"\{(\w+)\}", sql)) if n not in ("slice", "array")]


class SampleTables(FrameTables):
    """The sample tables, the derived ones, and the stand-ins under their own names."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.files = FileTables(spark, sf_dir)
        named = {n: (lambda n=n: self.files.table(n)) for n in SAMPLE_TABLES}
        named.update({n: (lambda n=n: self._derive(n)) for n in DERIVED})
        named.update({t: (lambda n=n: self.table(n)) for t, n in STAND_INS.items()})
        super().__init__(spark, named)
        self._made: dict[str, DataFrame] = {}

    def _derive(self, name: str) -> DataFrame:
        if name not in self._made:
            sql = DERIVED[name]
            for word, function in _DIALECT["spark"].items():
                sql = sql.replace(f"{{{word}}}", function)
            self._made[name] = self.query(sql, **{n: n for n in _names(sql)})
        return self._made[name]


def with_derived(*names: str) -> str:
    """A WITH clause that defines derived tables, and what they build on, for DuckDB."""
    order: list[str] = []

    def add(name: str) -> None:
        for inner in _names(DERIVED[name]):
            if inner in DERIVED:
                add(inner)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    parts = []
    for name in order:
        sql = DERIVED[name].format(
            **_DIALECT["duckdb"], **{n: f'"{n}"' for n in _names(DERIVED[name])}
        )
        parts.append(f'"{name}" AS ({sql})')
    return "WITH " + ",\n".join(parts) + "\n"
