"""Sample queries by name, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .derived import SampleTables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


_OPENED: dict[tuple[str, str], SampleTables] = {}


def sample_tables(spark: SparkSession, sf_dir: str) -> SampleTables:
    """The sample tables of a folder, opened once per Spark application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _OPENED:
        _OPENED[key] = SampleTables(spark, sf_dir)
    return _OPENED[key]


def sample(name: str, sql: str | None = None):
    """Register ``build(tables) -> DataFrame`` under a name."""

    def register(build: Callable[[SampleTables], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: build(sample_tables(spark, sf_dir))
        if sql is not None:
            ORACLE_SQL[name] = sql
        return build

    return register
