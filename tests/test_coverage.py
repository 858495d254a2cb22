import json
import logging
import time

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from sparkchecks import CatalogTables, FileTables, FrameTables, JdbcTables, Rule, run_with_report, write_report
from sparkchecks.operators import coverage
from sparkchecks.operators.batch import column_check_items, column_items
from sparkchecks.plans.specs import RULE_SETS
from sparkchecks.sources import local_rows, split_name, write_table
from sparkchecks.schemas import INVENTORY, RECONCILE_ITEM


@pytest.fixture
def tables(spark):
    def broken():
        raise RuntimeError("cannot be opened")

    return FrameTables(spark, {
        "b.two": spark.range(5).selectExpr("id AS x", "id AS y", "id AS z"),
        "a.one": spark.range(3).selectExpr("id AS x", "cast(id AS string) AS s"),
        "a.broken": broken,
        "bare": spark.range(0).selectExpr("id AS x"),
    })


RULES = [
    Rule("n", "null", [{"table": "a.one", "column": "x"}, {"table": "a.one", "column": "s"},
                       {"table": "gone.t", "column": "x"}]),
    Rule("m", "nan", [{"table": "a.one", "column": "x"}]),
    Rule("s", "share_sums", {"table": "b.two", "column": "y"}),
    Rule("q", "share_sums", {"scenarios": []}),
]


def test_inventory_skips_what_cannot_be_opened(tables, caplog):
    with caplog.at_level(logging.WARNING):
        rows = coverage.inventory(tables).orderBy("table_name").collect()
    assert [(r.schema_name, r.table_name, r.column_count, r.columns, r.row_count) for r in rows] == [
        ("a", "a.one", 2, ["x", "s"], 3),
        ("b", "b.two", 3, ["x", "y", "z"], 5),
        ("default", "bare", 1, ["x"], 0),
    ]
    assert "a.broken" in caplog.text
    assert tuple(coverage.inventory_summary(coverage.inventory(tables)).first()) == (3, 3, 6, 8)


def test_table_columns(tables):
    rows = coverage.table_columns(tables).filter("table_name = 'a.one'").orderBy("ordinal").collect()
    assert [tuple(r) for r in rows] == [("a.one", 0, "x", "bigint", False), ("a.one", 1, "s", "string", False)]


def test_catalog(spark):
    catalog = coverage.check_catalog(spark, {"set": RULES})
    assert catalog.count() == 5
    covered = {(r.table_name, r.column_name): r.check_types for r in coverage.covered_columns(catalog).collect()}
    assert covered[("a.one", "x")] == ["nan", "null"] and len(covered) == 4
    touched = {r.rule_name: (r.items, r.table_count, r.tables) for r in coverage.rule_tables(catalog).collect()}
    assert touched["n"] == (3, 2, ["a.one", "gone.t"])


def test_coverage(spark, tables):
    found, catalog = coverage.inventory(tables), coverage.check_catalog(spark, {"set": RULES})
    per_table = {r.table_name: r for r in coverage.table_coverage(found, catalog).collect()}
    assert (per_table["gone.t"].table_exists, per_table["gone.t"].is_covered) == (False, True)
    assert (per_table["bare"].table_exists, per_table["bare"].is_covered) == (True, False)
    assert per_table["a.one"].covered_columns == 2
    assert [r.table_name for r in coverage.uncovered_tables(found, catalog).collect()] == ["bare"]
    row = coverage.coverage_summary(found, catalog).first()
    assert (row.total_schemas, row.total_tables, row.covered_tables, row.covered_tables_found) == (3, 3, 3, 2)
    assert (row.uncovered_tables, row.uncovered_table_list) == (1, ["bare"])
    assert (row.total_columns, row.covered_columns) == (6, 4)
    assert row.coverage_percentage == pytest.approx(400 / 6)


def test_coverage_of_nothing(spark):
    none = local_rows(spark, [], INVENTORY)
    row = coverage.coverage_summary(none, coverage.check_catalog(spark, {"set": RULES})).first()
    assert (row.total_columns, row.coverage_percentage) == (0, 0.0)


def test_coverage_of_the_shipped_rules(spark):
    """28 columns in 25 tables; with 2167 columns that is 1.2921 percent."""
    catalog = coverage.check_catalog(spark, {"comprehensive": RULE_SETS["comprehensive"]})
    covered = coverage.covered_columns(catalog)
    assert covered.count() == 28
    assert covered.select("table_name").distinct().count() == 25
    found = local_rows(spark, [{"schema_name": "s", "table_name": "s.t", "column_count": 2167}], INVENTORY)
    row = coverage.coverage_summary(found, catalog).first()
    assert row.coverage_percentage == pytest.approx(1.2921089063221043)


def test_matrix(spark, tables):
    catalog = coverage.check_catalog(spark, {"set": RULES})
    rows = coverage.coverage_matrix(coverage.inventory(tables), catalog, ["nan", "null", "share_sums"]).collect()
    assert [tuple(r)[1:] for r in rows] == [
        ("a.one", 2, 3, "x", "s, x", ""), ("b.two", 3, 5, "", "", "y"), ("bare", 1, 0, "", "", "")]


def test_thresholds(spark, tables):
    catalog = coverage.check_catalog(spark, {"set": RULES + [
        Rule("t", "time_series", [{"table": "a.one", "column": "x"}])]})
    limits = coverage.thresholds(catalog)
    rows = {(r.column_name, r.check_type): (r.comparator, r.threshold) for r in limits.collect() if r.table_name == "a.one"}
    assert rows == {("x", "null"): ("equal_to", 0.0), ("s", "null"): ("equal_to", 0.0), ("x", "time_series"): (None, None)}
    measured = column_check_items(tables, column_items("n", "null", RULES[0].config))
    passes = {r.table_name + "." + r.column_name: r.is_pass for r in coverage.evaluate_thresholds(measured, limits).collect()}
    assert passes == {"a.one.x": True, "a.one.s": True, "gone.t.x": False}


def test_report_is_written(spark, tables, tmp_path):
    frames = write_report(tables, str(tmp_path), "set", RULES)
    assert frames["coverage_summary"].first().covered_tables == 3
    lines = [json.loads(line) for f in (tmp_path / "inventory").glob("*.json") for line in f.read_text().splitlines()]
    assert sorted(line["table_name"] for line in lines) == ["a.one", "b.two", "bare"]
    assert set(frames) == {p.name for p in tmp_path.iterdir()}


def test_run_with_report(spark, tables, tmp_path):
    result, report = run_with_report(tables, str(tmp_path), "set", RULES[:2], run_id="r")
    assert result.report.first().total_rules == 2
    assert report["catalog"].count() == 4
    assert (tmp_path / "runs" / "rule_results" / "run_id=r").exists() and (tmp_path / "report" / "catalog").exists()


# --- sources


def test_file_tables(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "plain.parquet"))
    spark.range(4).write.parquet(str(tmp_path / "grid.bus.parquet"))
    spark.range(5).write.parquet(str(tmp_path / "supply" / "plants.parquet"))
    (tmp_path / "notes.txt").write_text("not a table")
    tables = FileTables(spark, str(tmp_path))
    assert tables.names() == ["plain", "grid.bus", "supply.plants"]
    assert [tables.table(n).count() for n in tables.names()] == [3, 4, 5]
    with pytest.raises(LookupError):
        tables.table("notes")


def test_query_with_bound_parameters(spark):
    tables = FrameTables(spark, {"grid.bus": spark.createDataFrame([("DE", 1), ("FR", 2)], "country string, id int")})
    sql = "SELECT id FROM {bus} WHERE country = :country"
    assert [r.id for r in tables.query(sql, {"country": "DE"}, bus="grid.bus").collect()] == [1]
    assert tables.query(sql, {"country": "' OR 1=1 --"}, bus="grid.bus").count() == 0


def test_catalog_tables(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS shop")
    spark.range(2).write.mode("overwrite").saveAsTable("shop.sales")
    tables = CatalogTables(spark, exclude=["default"])
    assert tables.names() == ["shop.sales"] and tables.table("shop.sales").count() == 2
    spark.sql("DROP DATABASE shop CASCADE")


def test_jdbc_options(spark):
    tables = JdbcTables(spark, "jdbc:postgresql://host/db", {"user": "u"}, {"grid.bus": ("bus_id", 64)}, ["tiny"])
    assert tables.read_options("tiny") == {"dbtable": "tiny"}
    with pytest.raises(ValueError, match="partition column"):
        tables.read_options("huge")
    assert "ntile(64) OVER (ORDER BY bus_id)" in tables.bounds_sql("grid.bus")
    assert "'pg_catalog'" in tables.listing_sql()


@pytest.mark.parametrize("kind", ["bigint", "double", "varchar", "date", "timestamp", "decimal(9,2)"])
def test_jdbc_parts_are_even_and_hold_each_row_once(spark, kind):
    """The SQL that is built, run by a database inside this process: skewed keys, a hot key and NULLs."""
    db = duckdb.connect()
    value = {"bigint": "k", "double": "k / 7.0", "varchar": "'k' || chr(39) || k", "date": "DATE '2020-01-01' + CAST(k AS integer)", "timestamp": "TIMESTAMP '2020-01-01' + INTERVAL (k) SECOND", "decimal(9,2)": "k / 100.0"}[kind]
    db.execute(f"""CREATE TABLE t AS SELECT i, CASE WHEN i % 10 = 0 THEN NULL ELSE CAST({value} AS {kind}) END AS key
                   FROM (SELECT i, CASE WHEN i % 3 = 0 THEN 5 ELSE CAST(pow(1.001, i) AS bigint) END AS k FROM range(9000) r(i))""")
    tables = JdbcTables(spark, "jdbc:postgresql://host/db", partitioning={"t": ("key", 8)})
    bounds = db.execute(tables.bounds_sql("t")).fetchall()
    assert len(bounds) == 8 and len({n for *_, n in bounds}) <= 2
    parts = tables.predicates("t", [b for _, b, _ in bounds])
    rows = [r for p in parts for r in db.execute(f"SELECT i FROM t WHERE {p}").fetchall()]
    assert sorted(rows) == [(i,) for i in range(9000)]
    sizes = [db.execute(f"SELECT count(*) FROM t WHERE {p}").fetchone()[0] for p in parts]
    hot = db.execute("SELECT max(n) FROM (SELECT count(*) AS n FROM t WHERE key IS NOT NULL GROUP BY key)").fetchone()[0]
    assert max(sizes) <= hot + 2 * 9000 / 8
    assert tables.predicates("t", bounds[:1] and [5]) == ["key IS NOT NULL", "key IS NULL"]


def test_jdbc_reads_by_predicates(spark, monkeypatch):
    tables = JdbcTables(spark, "jdbc:postgresql://host/db", {"user": "u"}, {"t": ("id", 3)})
    monkeypatch.setattr(tables, "_read", lambda **o: spark.createDataFrame([(1, 1, 9), (2, 7, 9), (3, 7, 9)], "part int, lower_bound int, n int"))
    seen = {}
    monkeypatch.setattr(type(spark.read), "jdbc", lambda self, url, table, predicates, properties: seen.update(url=url, table=table, predicates=predicates, properties=properties))
    tables.table("t")
    assert seen["predicates"] == ["id < 7", "id >= 7", "id IS NULL"]
    assert seen["properties"]["user"] == "u" and seen["table"] == "t"
    with pytest.raises(TypeError):
        tables.predicates("t", [True, False])


def test_names_split():
    assert split_name("grid.bus") == ("grid", "bus")
    assert split_name("bus") == ("default", "bus")


@pytest.mark.parametrize("fmt", ["json", "parquet", "orc"])
def test_tables_survive_storage(spark, tmp_path, fmt):
    rows = [{"rule_name": "r", "ordinal": 1, "deviation_percent": d} for d in (float("inf"), float("nan"), -1.5, None)]
    stored = write_table(local_rows(spark, rows, RECONCILE_ITEM), str(tmp_path / "t"), fmt)
    assert stored.schema == RECONCILE_ITEM
    found = [r.deviation_percent for r in stored.collect()]
    assert sorted(map(str, found)) == ["-1.5", "None", "inf", "nan"]
    empty = write_table(local_rows(spark, [], RECONCILE_ITEM), str(tmp_path / "e"), fmt)
    assert empty.count() == 0
    parts = write_table(local_rows(spark, rows, RECONCILE_ITEM), str(tmp_path / "p"), fmt, ["rule_name"])
    assert parts.filter("rule_name = 'r'").count() == 4


def test_jdbc_bounds_of_only_null_keys(spark, monkeypatch):
    tables = JdbcTables(spark, "jdbc:postgresql://host/db", partitioning={"big": ("id", 8)})
    rows = {"SELECT 1": [(1,)]}

    class Answer:
        def __init__(self, query):
            self.query = query

        def first(self):
            return next((v[0] for k, v in rows.items() if k in self.query and v), None)

        def collect(self):
            return []

    monkeypatch.setattr(tables, "_read", lambda **o: Answer(o["query"]) if "query" in o else o)
    with pytest.raises(ValueError, match="NULL"):
        tables.table("big")
    rows["SELECT 1"] = []
    assert tables.table("big") == {"dbtable": "big"}


def test_inventory_of_many_frames(spark):
    frames = {f"s.t{i}": spark.range(i) for i in range(130)}
    rows = coverage.inventory(FrameTables(spark, frames)).collect()
    assert {r.table_name: r.row_count for r in rows} == {f"s.t{i}": i for i in range(130)}


def test_inventory_of_thousands_of_tables(spark, tmp_path):
    """2,000 tables in files: opened side by side, counted by one scan of one plan."""
    for i in range(2000):
        folder = tmp_path / (f"s{i % 3}" if i % 4 else ".")
        path = folder / f"t {i}+%.parquet"
        if i % 5 == 0:
            path.mkdir(parents=True)
            path = path / "part-0.parquet"
        path.parent.mkdir(parents=True, exist_ok=True)
        pq.write_table(pa.table({"x": list(range(i % 7)), "y": [0.5] * (i % 7)}), path)
    (tmp_path / "broken.parquet").write_text("no parquet")
    tables = FileTables(spark, str(tmp_path))
    started = time.time()
    found = coverage.inventory(tables)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") - plan.count("LocalRelation [") == 1
    rows = {r.table_name: (r.column_count, r.row_count) for r in found.collect()}
    assert len(rows) == 2000 and time.time() - started < 240
    assert rows == {(f"s{i % 3}." if i % 4 else "") + f"t {i}+%": (2, i % 7) for i in range(2000)}
