"""The shipped rule sets, as data.

Everything below names tables, columns, keys and tolerances of one particular
database of energy system data; no code of this package depends on it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from ..operators.reconcile import Part
from ..operators.totals import Dimension, SeriesTotal, Total


@dataclass(frozen=True)
class Rule:
    """A named check. ``config`` is a list of column items or one mapping of parameters."""

    name: str
    check: str
    config: Sequence[Mapping] | Mapping


# --- Fixed values: tables -------------------------------------------------------------------

BUS = "grid.egon_etrago_bus"
GENERATOR = "grid.egon_etrago_generator"
STORAGE = "grid.egon_etrago_storage"
LINK = "grid.egon_etrago_link"
LOAD = "grid.egon_etrago_load"
LOAD_SERIES = "grid.egon_etrago_load_timeseries"
CAPACITIES = "supply.egon_scenario_capacities"
POWER_PLANTS = "supply.egon_power_plants"
HOUSEHOLD_DEMAND = "demand.egon_demandregio_hh"
INDUSTRY_DEMAND = "demand.egon_demandregio_cts_ind"
HEAT_DEMAND = "demand.egon_peta_heat"
CELL_DEMAND = "demand.egon_demandregio_zensus_electricity"
CELL_MAP = "boundaries.egon_map_zensus_vg250"
HOUSEHOLDS = "society.egon_destatis_zensus_household_per_ha_refined"
ELECTRICITY_SHARES = "demand.egon_cts_electricity_demand_building_share"
HEAT_SHARES = "demand.egon_cts_heat_demand_building_share"

SCENARIOS = ["eGon2035", "eGon100RE"]
DEFAULT_SCENARIO = "eGon2035"
DEFAULT_YEAR = "2035"

# --- Fixed values: components of the sector rules --------------------------------------------

GENERATOR_CARRIERS = [
    "others",
    "reservoir",
    "run_of_river",
    "oil",
    "wind_onshore",
    "wind_offshore",
    "solar",
    "solar_rooftop",
    "biomass",
]
BIOMASS_CARRIERS = ["biomass", "industrial_biomass_CHP", "central_biomass_CHP"]

_DOMESTIC = {"scn_name": ":scenario", "country": "DE"}
_DOMESTIC_BUS = Dimension(BUS, "bus", "bus_id", _DOMESTIC)


def _capacities(members: Mapping[str, Sequence[str]]) -> Total:
    return Total(CAPACITIES, "capacity", members, "carrier", {"scenario_name": ":scenario"})


def _load_series(component: str, carriers: Sequence[str]) -> SeriesTotal:
    return SeriesTotal(
        table=LOAD,
        key="carrier",
        members={component: carriers},
        series_table=LOAD_SERIES,
        series_key="load_id",
        series_value="p_set",
        dimension=_DOMESTIC_BUS,
        filters={"scn_name": ":scenario"},
        series_filters={"scn_name": ":scenario"},
        divisor=1_000_000,
    )


def _yearly(table: str) -> Total:
    return Total(
        table,
        "demand",
        {"electricity_demand": []},
        filters={"scenario": ":scenario", "year": ":year"},
        divisor=1_000_000,
    )


ELECTRICITY_PARTS = [
    Part(
        components=GENERATOR_CARRIERS,
        inputs=[_capacities({c: [c] for c in GENERATOR_CARRIERS})],
        outputs=[
            Total(
                GENERATOR,
                "p_nom",
                {**{c: [c] for c in GENERATOR_CARRIERS}, "biomass": BIOMASS_CARRIERS},
                "carrier",
                {"scn_name": ":scenario"},
                _DOMESTIC_BUS,
            )
        ],
    ),
    Part(
        components=["storage_pumped_hydro"],
        inputs=[_capacities({"storage_pumped_hydro": ["pumped_hydro"]})],
        outputs=[
            Total(
                STORAGE,
                "p_nom",
                {"storage_pumped_hydro": ["pumped_hydro"]},
                "carrier",
                {"scn_name": ":scenario"},
                _DOMESTIC_BUS,
            )
        ],
    ),
    Part(
        components=["electricity_demand"],
        inputs=[_yearly(HOUSEHOLD_DEMAND), _yearly(INDUSTRY_DEMAND)],
        outputs=[_load_series("electricity_demand", ["AC"])],
    ),
]

HEAT_PARTS = [
    Part(
        components=["heat_demand"],
        inputs=[
            Total(
                HEAT_DEMAND,
                "demand",
                {"heat_demand": []},
                filters={"scenario": ":scenario"},
                divisor=1_000_000,
            )
        ],
        outputs=[_load_series("heat_demand", ["rural_heat", "central_heat"])],
    ),
    Part(
        components=["central_heat_pump", "residential_heat_pump", "resistive_heater"],
        inputs=[
            _capacities(
                {
                    "central_heat_pump": ["urban_central_heat_pump"],
                    "residential_heat_pump": ["residential_rural_heat_pump"],
                    "resistive_heater": ["urban_central_resistive_heater"],
                }
            )
        ],
        outputs=[
            Total(
                LINK,
                "p_nom",
                {
                    "central_heat_pump": ["central_heat_pump"],
                    "residential_heat_pump": ["rural_heat_pump"],
                    "resistive_heater": ["central_resistive_heater"],
                },
                "carrier",
                {"scn_name": ":scenario"},
            )
        ],
    ),
    Part(
        components=["solar_thermal", "geothermal"],
        inputs=[
            _capacities(
                {
                    "solar_thermal": ["urban_central_solar_thermal_collector"],
                    "geothermal": ["urban_central_geo_thermal"],
                }
            )
        ],
        outputs=[
            Total(
                GENERATOR,
                "p_nom",
                {
                    "solar_thermal": ["solar_thermal_collector"],
                    "geothermal": ["geo_thermal"],
                },
                "carrier",
                {"scn_name": ":scenario"},
            )
        ],
    ),
]

# --- Fixed values: rules ---------------------------------------------------------------------

_NULL_ITEMS = [
    {"table": HOUSEHOLD_DEMAND, "column": "demand"},
    {"table": HOUSEHOLD_DEMAND, "column": "nuts3"},
    {"table": HOUSEHOLD_DEMAND, "column": "scenario"},
    {"table": POWER_PLANTS, "column": "el_capacity"},
    {"table": POWER_PLANTS, "column": "carrier"},
    {"table": BUS, "column": "carrier"},
]

_NAN_ITEMS = [
    {"table": HOUSEHOLD_DEMAND, "column": "demand"},
    {"table": POWER_PLANTS, "column": "el_capacity"},
    {"table": LOAD_SERIES, "column": "p_set"},
]


def _hourly(table: str, column: str) -> dict:
    return {"table": table, "column": column, "expected_length": 8760}


_SERIES_ITEMS = [
    _hourly("demand.egon_demandregio_sites_ind_electricity_dsm_timeseries", "p_mset"),
    _hourly("demand.egon_demandregio_timeseries_cts_ind", "load_curve"),
    _hourly("demand.egon_etrago_electricity_cts_dsm_timeseries", "p_set"),
    _hourly("demand.egon_etrago_timeseries_individual_heating", "dist_aggregated_mw"),
    _hourly("demand.egon_heat_timeseries_selected_profiles", "selected_idp_profiles"),
    _hourly("demand.egon_osm_ind_load_curves_individual_dsm_timeseries", "p_set"),
    _hourly("demand.egon_sites_ind_load_curves_individual_dsm_timeseries", "p_set"),
    _hourly("demand.egon_timeseries_district_heating", "dist_aggregated_mw"),
    _hourly("grid.egon_etrago_bus_timeseries", "v_mag_pu_set"),
    _hourly("grid.egon_etrago_generator_timeseries", "p_max_pu"),
    _hourly("grid.egon_etrago_line_timeseries", "s_max_pu"),
    _hourly("grid.egon_etrago_link_timeseries", "p_min_pu"),
    _hourly(LOAD_SERIES, "p_set"),
    _hourly("grid.egon_etrago_storage_timeseries", "inflow"),
    _hourly("grid.egon_etrago_store_timeseries", "e_min_pu"),
    _hourly("grid.egon_etrago_transformer_timeseries", "s_max_pu"),
]


def _share_rule(name: str, table: str, subject: str) -> Rule:
    return Rule(
        name,
        "share_sums",
        {
            "table": table,
            "column": "profile_share",
            "member": "bus_id",
            "group": "scenario",
            "scenarios": SCENARIOS,
            "tolerance": 1e-5,
            "subject": subject,
        },
    )


SANITY_RULES = [
    Rule(
        "etrago_electricity_sanity",
        "reconcile",
        {
            "table": GENERATOR,
            "column": "p_nom",
            "scenario": "eGon2035",
            "year": "2035",
            "tolerance": 5.0,
            "parts": ELECTRICITY_PARTS,
        },
    ),
    Rule(
        "etrago_heat_sanity",
        "reconcile",
        {
            "table": LOAD,
            "column": "p_set",
            "scenario": "eGon2035",
            "tolerance": 5.0,
            "parts": HEAT_PARTS,
        },
    ),
    Rule(
        "residential_electricity_annual_sum",
        "group_sums",
        {
            "table": CELL_DEMAND,
            "column": "demand",
            "group": "scenario",
            "filters": {"sector": "residential"},
            "mapping_table": CELL_MAP,
            "mapping_key": "zensus_population_id",
            "mapping_region": "vg250_nuts3",
            "reference_table": HOUSEHOLD_DEMAND,
            "reference_group": "scenario",
            "reference_region": "nuts3",
            "reference_value": "demand",
            "reference_subgroup": "year",
            "scenarios": SCENARIOS,
            "tolerance": 1e-5,
        },
    ),
    Rule(
        "residential_electricity_hh_refinement",
        "refinement",
        {
            "table": HOUSEHOLDS,
            "column": "hh_10types",
            "region": "nuts3",
            "code": "characteristics_code",
            "cell": "cell_id",
            "original": "hh_5types",
            "tolerance": 1e-5,
            "subject": "refinement",
        },
    ),
    _share_rule("cts_electricity_demand_share", ELECTRICITY_SHARES, "CTS electricity demand share"),
    _share_rule("cts_heat_demand_share", HEAT_SHARES, "CTS heat demand share"),
]

RULE_SETS: dict[str, list[Rule]] = {
    "comprehensive": [
        Rule("critical_null_checks", "null", _NULL_ITEMS),
        Rule("critical_nan_checks", "nan", _NAN_ITEMS),
        Rule("time_series_completeness", "time_series", _SERIES_ITEMS),
        *SANITY_RULES,
    ],
    "critical_only": [
        Rule(
            "essential_null_checks",
            "null",
            [
                {"table": HOUSEHOLD_DEMAND, "column": "demand"},
                {"table": POWER_PLANTS, "column": "el_capacity"},
            ],
        ),
        Rule("core_time_series", "time_series", [_hourly(LOAD_SERIES, "p_set")]),
    ],
    "time_series_only": [
        Rule(
            "all_time_series",
            "time_series",
            [
                _hourly(LOAD_SERIES, "p_set"),
                _hourly("grid.egon_etrago_generator_timeseries", "p_max_pu"),
                _hourly("grid.egon_etrago_link_timeseries", "p_min_pu"),
                _hourly("grid.egon_etrago_line_timeseries", "s_max_pu"),
            ],
        )
    ],
    "null_checks_only": [Rule("comprehensive_null_checks", "null", _NULL_ITEMS)],
    "quick_check": [
        Rule("basic_null_check", "nan", [{"table": HOUSEHOLD_DEMAND, "column": "demand"}])
    ],
    "sanity_checks": list(SANITY_RULES),
}


def rule_set(name: str) -> list[Rule]:
    """The rules of a shipped set; raises on an unknown name."""
    if name not in RULE_SETS:
        raise ValueError(f"Rule set '{name}' not found. Available: {list(RULE_SETS)}")
    return RULE_SETS[name]
