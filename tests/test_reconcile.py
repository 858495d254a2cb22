import pytest

from sparkchecks import Dimension, FrameTables, Part, SeriesTotal, Total, reconcile
from sparkchecks.plans.specs import (
    BIOMASS_CARRIERS,
    ELECTRICITY_PARTS,
    GENERATOR_CARRIERS,
    HEAT_PARTS,
)

NAN = float("nan")


def rows_of(tables, parts, tolerance=5.0, **params):
    items = reconcile(tables, "rule", parts, tolerance, {"scenario": "eGon2035", "year": "2035", **params})
    found = sorted(items.collect(), key=lambda r: r.ordinal)
    assert [r.ordinal for r in found] == list(range(len(found)))
    return {r.component: r for r in found}


class Energy:
    """The tables behind the sector rules, every input total 100 and every output equal."""

    def __init__(self, spark):
        self.spark = spark
        self.frames = {}
        self.put("grid.egon_etrago_bus", "bus_id bigint, scn_name string, country string",
                 [(1, "eGon2035", "DE"), (2, "eGon2035", "FR"), (1, "eGon100RE", "DE"), (1, "eGon2035", "DE")])
        generators = [(1, c, "eGon2035", 100.0) for c in GENERATOR_CARRIERS if c != "biomass"]
        # Biomass output pools three carriers; foreign buses and other scenarios do not count.
        generators += [(1, c, "eGon2035", p) for c, p in zip(BIOMASS_CARRIERS, (50.0, 30.0, 20.0))]
        generators += [(2, "oil", "eGon2035", 999.0), (1, "oil", "eGon100RE", 999.0),
                       (None, "oil", "eGon2035", 999.0), (1, "unknown", "eGon2035", 999.0)]
        # The heat rule does not look at the country.
        generators += [(2, c, "eGon2035", 100.0) for c in ("solar_thermal_collector", "geo_thermal")]
        self.put("grid.egon_etrago_generator", "bus bigint, carrier string, scn_name string, p_nom double", generators)
        self.put("grid.egon_etrago_storage", "bus bigint, carrier string, scn_name string, p_nom double",
                 [(1, "pumped_hydro", "eGon2035", 60.0), (1, "pumped_hydro", "eGon2035", 40.0)])
        self.put("grid.egon_etrago_link", "carrier string, scn_name string, p_nom double",
                 [(c, "eGon2035", 100.0) for c in
                  ("central_heat_pump", "rural_heat_pump", "central_resistive_heater")])
        inputs = [*GENERATOR_CARRIERS, "pumped_hydro", "urban_central_heat_pump",
                  "residential_rural_heat_pump", "urban_central_resistive_heater",
                  "urban_central_solar_thermal_collector", "urban_central_geo_thermal"]
        self.put("supply.egon_scenario_capacities", "carrier string, scenario_name string, capacity double",
                 [(c, "eGon2035", 100.0) for c in inputs] + [("oil", "eGon100RE", 5.0)])
        self.put("grid.egon_etrago_load", "load_id bigint, bus bigint, carrier string, scn_name string",
                 [(10, 1, "AC", "eGon2035"), (11, 2, "AC", "eGon2035"), (12, 1, "rural_heat", "eGon2035"),
                  (13, 1, "central_heat", "eGon2035"), (10, 1, "AC", "eGon100RE")])
        # Bus 1 is listed twice for the scenario, and joins multiply.
        self.put("grid.egon_etrago_load_timeseries", "load_id bigint, scn_name string, p_set array<double>",
                 [(10, "eGon2035", [20e6, None, 30e6]), (11, "eGon2035", [1e9]), (12, "eGon2035", [30e6]),
                  (13, "eGon2035", [20e6]), (13, "eGon2035", []), (13, "eGon2035", None),
                  (10, "eGon100RE", [7e9])])
        self.put("demand.egon_demandregio_hh", "scenario string, year string, demand double",
                 [("eGon2035", "2035", 40e6), ("eGon2035", "2050", 1e9), ("eGon100RE", "2035", 1e9)])
        self.put("demand.egon_demandregio_cts_ind", "scenario string, year string, demand double",
                 [("eGon2035", "2035", 60e6)])
        self.put("demand.egon_peta_heat", "scenario string, demand double",
                 [("eGon2035", 100e6), ("eGon100RE", 1e9)])

    def put(self, name, ddl, rows):
        self.frames[name] = self.spark.createDataFrame(rows, ddl)

    @property
    def tables(self):
        return FrameTables(self.spark, self.frames)


@pytest.fixture
def energy(spark):
    return Energy(spark)


def test_electricity_all_equal(energy, any_size):
    rows = rows_of(energy.tables, ELECTRICITY_PARTS)
    assert len(rows) == 11
    assert {(r.status, r.input_total, r.output_total) for r in rows.values()} == {("SUCCESS", 100.0, 100.0)}


def test_heat_all_equal(energy, any_size):
    rows = rows_of(energy.tables, HEAT_PARTS)
    assert list(rows) == ["heat_demand", "central_heat_pump", "residential_heat_pump",
                          "resistive_heater", "solar_thermal", "geothermal"]
    assert {(r.status, r.input_total, r.output_total) for r in rows.values()} == {("SUCCESS", 100.0, 100.0)}


def test_missing_output_is_critical(energy):
    energy.frames["grid.egon_etrago_storage"] = energy.frames["grid.egon_etrago_storage"].limit(0)
    rows = rows_of(energy.tables, ELECTRICITY_PARTS)
    assert rows["storage_pumped_hydro"].status == "CRITICAL_FAILURE"
    assert rows["storage_pumped_hydro"].deviation_percent == -100.0
    assert sum(r.status == "SUCCESS" for r in rows.values()) == 10


def test_missing_table_breaks_its_part_only(energy):
    del energy.frames["grid.egon_etrago_storage"]
    rows = rows_of(energy.tables, ELECTRICITY_PARTS)
    broken = rows["storage_pumped_hydro"]
    assert (broken.status, broken.input_total, broken.output_total, broken.deviation_percent) == (
        "CRITICAL_FAILURE", None, None, None)
    assert "Failed to validate storage_pumped_hydro" in broken.message
    assert sum(r.status == "SUCCESS" for r in rows.values()) == 10


def test_absent_scenario_has_nothing_to_distribute(energy):
    rows = rows_of(energy.tables, ELECTRICITY_PARTS, scenario="eGon1999")
    assert {r.status for r in rows.values()} == {"SUCCESS"}
    assert rows["oil"].input_total == 0.0


def test_two_inputs_add_up(spark):
    frames = {
        "a": spark.createDataFrame([(200.0,)], "x double"),
        "b": spark.createDataFrame([(300.0,)], "x double"),
        "c": spark.createDataFrame([(500.0,)], "x double"),
    }
    part = Part(["all"], [Total("a", "x", {"all": []}), Total("b", "x", {"all": []})],
                [Total("c", "x", {"all": []})])
    row = rows_of(FrameTables(spark, frames), [part])["all"]
    assert (row.status, row.input_total, row.deviation_percent) == ("SUCCESS", 500.0, 0.0)


def test_a_member_may_count_for_several_components(spark):
    facts = spark.createDataFrame([("x", 1.0), ("y", 2.0), ("z", 4.0)], "k string, v double")
    total = Total("facts", "v", {"one": ["x", "y"], "two": ["y", "z"], "none": ["q"]}, "k")
    part = Part(["one", "two", "none"], [total], [total])
    rows = rows_of(FrameTables(spark, {"facts": facts}), [part])
    assert {c: r.input_total for c, r in rows.items()} == {"one": 3.0, "two": 6.0, "none": 0.0}


def test_list_filters_and_nan_totals(spark):
    facts = spark.createDataFrame([("x", 1.0, 1), ("y", NAN, 1), ("x", 5.0, 3)], "k string, v double, n int")
    total = Total("facts", "v", {"x": ["x"], "y": ["y"]}, "k", filters={"n": [1, 2]})
    rows = rows_of(FrameTables(spark, {"facts": facts}), [Part(["x", "y"], [total], [total])])
    assert rows["x"].input_total == 1.0
    assert (rows["y"].status, rows["y"].deviation_percent != rows["y"].deviation_percent) == ("WARNING", True)


def test_hot_keys_and_duplicates(spark, any_size):
    """A third of all rows share one key; results equal brute force on both join paths."""
    n = 3000
    facts = [(0 if i % 3 == 0 else i % 50, "ab"[i % 2], float(i)) for i in range(n)]
    dims = [(k, "DE" if k % 2 == 0 else "FR") for k in range(40)] + [(0, "DE"), (7, None), (None, "DE")]
    series = [(k, [float(k), None, 1.0]) for k in range(50)] + [(0, [5.0])] * 3
    tables = FrameTables(spark, {
        "facts": spark.createDataFrame(facts, "d bigint, k string, v double"),
        "dims": spark.createDataFrame(dims, "id bigint, country string"),
        "series": spark.createDataFrame(series, "d bigint, a array<double>"),
    })
    dimension = Dimension("dims", "d", "id", {"country": "DE"})
    semi = Total("facts", "v", {"a": ["a"], "b": ["b"]}, "k", dimension=dimension)
    inner = SeriesTotal("facts", "k", {"a": ["a"], "b": ["b"]}, "series", "d", "a", dimension)
    home = [k for k, c in dims if c == "DE"]
    rows = rows_of(tables, [Part(["a", "b"], [semi], [inner])])
    for key in "ab":
        wanted = sum(v for d, k, v in facts if k == key and d in home)
        joined = sum(
            sum(x for x in a if x is not None) * home.count(d)
            for d, k, _ in facts if k == key and d in home
            for s, a in series if s == d
        )
        assert (rows[key].input_total, rows[key].output_total) == (wanted, joined)


def test_decimal_series_keep_their_digits(spark, any_size):
    """Elements far below a millionth; three series count."""
    frames = {
        "facts": spark.sql("SELECT id AS s, 1 AS d, 'k' AS k FROM range(3)"),
        "dims": spark.sql("SELECT 1 AS id, 'DE' AS country"),
        "series": spark.sql("SELECT id AS s, array(cast(4e-7 AS decimal(28,10)), cast(4e-8 AS decimal(28,10))) AS a FROM range(3)"),
        "inputs": spark.sql("SELECT 'k' AS k, 1.32e-6D AS v"),
    }
    dimension = Dimension("dims", "d", "id", {"country": "DE"})
    part = Part(["k"], [Total("inputs", "v", {"k": ["k"]}, "k")], [SeriesTotal("facts", "k", {"k": ["k"]}, "series", "s", "a", dimension)])
    row = rows_of(FrameTables(spark, frames), [part])["k"]
    assert row.output_total == pytest.approx(1.32e-6, rel=1e-12) and row.status == "SUCCESS"


def test_one_broken_total_leaves_the_others(spark):
    facts = spark.createDataFrame([("x", 1.0), ("y", 2.0)], "k string, v double")
    good, bad = Total("facts", "v", {"x": ["x"]}, "k"), Total("facts", "w", {"y": ["y"]}, "k")
    rows = rows_of(FrameTables(spark, {"facts": facts}), [Part(["x"], [good], [good]), Part(["y"], [bad], [good])])
    assert rows["x"].status == "SUCCESS" and rows["y"].status == "CRITICAL_FAILURE"
