"""Where tables come from: frames, files, the session catalog or a JDBC database.

Names are ``schema.table`` or plain ``table``. Every source hands out lazy
DataFrames; the columns read are those a query uses.
"""

from __future__ import annotations

import re
from abc import ABC, abstractmethod
from collections.abc import Callable, Mapping, Sequence
from datetime import date, datetime
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Schemas that hold no user tables.
SYSTEM_SCHEMAS = ("information_schema", "pg_catalog", "pg_toast")


def local_rows(spark: SparkSession, rows: Sequence[Mapping], schema: T.StructType) -> DataFrame:
    """A small DataFrame of literal rows, planned as a local relation.

    Unlike a list handed to ``createDataFrame`` it has an exact size, so joins
    against it are broadcast by the planner, and needs no Python worker.
    """
    table = pa.Table.from_pylist([dict(r) for r in rows], schema=to_arrow_schema(schema))
    return spark.createDataFrame(table, schema=schema)


def split_name(name: str) -> tuple[str, str]:
    """``schema.table`` as a pair; tables without a schema belong to ``default``."""
    schema, _, table = name.rpartition(".")
    return schema or "default", table


class Tables(ABC):
    """A set of named tables."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    @abstractmethod
    def names(self) -> list[str]:
        """Names of all user tables, sorted by schema and table."""

    @abstractmethod
    def table(self, name: str) -> DataFrame:
        """The table as a DataFrame; raises if there is none of that name."""

    def row_counts(self, names: Sequence[str]) -> DataFrame | None:
        """Lazy rows (table_name, row_count) of all named tables from one scan, where the source has one.

        None if it hasn't; tables without rows may be left out.
        """
        return None

    def query(self, sql: str, args: Mapping | None = None, **aliases: str) -> DataFrame:
        """Run SQL with bound parameters (``:name``) over tables of this source.

        ``aliases`` map the ``{alias}`` placeholders of the statement to table names.
        """
        frames = {alias: self.table(name) for alias, name in aliases.items()}
        return self.spark.sql(sql, args=dict(args or {}), **frames)


class FrameTables(Tables):
    """Tables given as DataFrames, or as functions that build one on demand."""

    def __init__(
        self, spark: SparkSession, frames: Mapping[str, DataFrame | Callable[[], DataFrame]]
    ):
        super().__init__(spark)
        self._frames = dict(frames)

    def names(self) -> list[str]:
        return sorted(self._frames, key=split_name)

    def table(self, name: str) -> DataFrame:
        if name not in self._frames:
            raise LookupError(f"Table does not exist: {name}")
        frame = self._frames[name]
        return frame() if callable(frame) else frame


class FileTables(Tables):
    """Tables stored as ``root/[schema/]table.<format>`` files or directories.

    ``root/schema.table.<format>`` is read as ``schema.table`` as well. The
    directory is listed through Hadoop, so any file system Spark reads will do.
    Listing and schemas are read once per instance.
    """

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet"):
        super().__init__(spark)
        self.root, self.fmt = root.rstrip("/"), fmt
        self._paths: dict[str, str] | None = None
        self._frames: dict[str, DataFrame] = {}

    def _list(self) -> dict[str, str]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        conf = self.spark._jsc.hadoopConfiguration()
        suffix = "." + self.fmt

        def entries(directory: str):
            where = path(directory)
            return [
                (s.getPath().getName(), s.getPath().toString(), s.isDirectory())
                for s in where.getFileSystem(conf).listStatus(where)
            ]

        found = {}
        for name, location, is_directory in entries(self.root):
            if name.endswith(suffix):
                found[name.removesuffix(suffix)] = location
            elif is_directory and not name.startswith(("_", ".")):
                for inner, inner_location, _ in entries(location):
                    if inner.endswith(suffix):
                        found[f"{name}.{inner.removesuffix(suffix)}"] = inner_location
        return found

    def names(self) -> list[str]:
        if self._paths is None:
            self._paths = self._list()
        return sorted(self._paths, key=split_name)

    def row_counts(self, names: Sequence[str]) -> DataFrame | None:
        """Files of all tables in one scan that reads no column, so counts come from the footers.

        A file's path says which table it belongs to, so the plan is the same for any number of tables.
        """
        if self.fmt not in ("parquet", "orc") or not names:
            return None
        self.names()
        locations = [self._paths[n] for n in names]
        # The root as the file system writes it, which paths of rows begin with.
        root = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        prefix = root.getFileSystem(self.spark._jsc.hadoopConfiguration()).makeQualified(root).toUri().getPath().rstrip("/")
        none = T.StructType([T.StructField("_none", T.StringType())])
        rows = self.spark.read.format(self.fmt).schema(none).option("recursiveFileLookup", True).load(locations)
        path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
        below = F.expr("substr(p, instr(p, r) + length(r))")
        suffix = re.escape("." + self.fmt)
        known = rows.select(path.alias("p"), F.lit(f"{prefix}/").alias("r")).select(below.alias("below"))
        name = F.regexp_extract("below", rf"^((?:[^/]+/)??[^/]+?){suffix}(?:/|$)", 1)
        return known.groupBy(F.replace(name, F.lit("/"), F.lit(".")).alias("table_name")).agg(F.count(F.lit(1)).alias("row_count"))

    def table(self, name: str) -> DataFrame:
        if name not in self.names():
            raise LookupError(f"Table does not exist: {name}")
        if name not in self._frames:
            self._frames[name] = self.spark.read.format(self.fmt).load(self._paths[name])
        return self._frames[name]


class CatalogTables(Tables):
    """Tables of the session catalog."""

    def __init__(self, spark: SparkSession, exclude: Sequence[str] = SYSTEM_SCHEMAS):
        super().__init__(spark)
        self.exclude = set(exclude)

    def names(self) -> list[str]:
        catalog = self.spark.catalog
        return sorted(
            (
                f"{database.name}.{table.name}"
                for database in catalog.listDatabases()
                if database.name not in self.exclude
                for table in catalog.listTables(database.name)
                if not table.isTemporary
            ),
            key=split_name,
        )

    def table(self, name: str) -> DataFrame:
        return self.spark.table(name)


class JdbcTables(Tables):
    """Tables of a relational database.

    ``partitioning`` names, per table, the column that splits the read and the
    number of parts: ``{"grid.bus": ("bus_id", 64)}``. The database is asked where
    parts of equally many rows begin, so a skewed column gives even parts; rows
    whose value is NULL are a part of their own. A table without an entry would
    come through a single connection into a single task, so it must be listed in
    ``small``.
    """

    def __init__(
        self,
        spark: SparkSession,
        url: str,
        options: Mapping[str, str] | None = None,
        partitioning: Mapping[str, tuple[str, int]] | None = None,
        small: Sequence[str] = (),
        fetch_size: int = 10_000,
    ):
        super().__init__(spark)
        self.url = url
        self.options = {"fetchsize": str(fetch_size), **(options or {})}
        self.partitioning = dict(partitioning or {})
        self.small = set(small)

    def _read(self, **options: str) -> DataFrame:
        return self.spark.read.format("jdbc").options(url=self.url, **self.options, **options).load()

    def listing_sql(self) -> str:
        skipped = ", ".join(f"'{s}'" for s in SYSTEM_SCHEMAS)
        return (
            "SELECT table_schema, table_name FROM information_schema.tables "
            f"WHERE table_type = 'BASE TABLE' AND table_schema NOT IN ({skipped})"
        )

    def bounds_sql(self, name: str) -> str:
        """Where each of the wanted parts begins, by the number of rows."""
        column, parts = self.partitioning[name]
        ranked = f"SELECT {column} AS k, ntile({parts}) OVER (ORDER BY {column}) AS part FROM {name} WHERE {column} IS NOT NULL"
        return f"SELECT part, min(k) AS lower_bound, count(*) AS n FROM ({ranked}) ranked GROUP BY part ORDER BY part"

    def any_row_sql(self, name: str) -> str:
        return f"SELECT 1 AS found FROM {name} LIMIT 1"

    def predicates(self, name: str, bounds: Sequence) -> list[str]:
        """Conditions that each row fulfils exactly one of: from one bound to the next, and NULL.

        A value that fills several parts gives equal bounds, which are one part.
        """
        column, _ = self.partitioning[name]
        cuts = [sql_literal(v) for v in dict.fromkeys(bounds)][1:]
        if not cuts:
            return [f"{column} IS NOT NULL", f"{column} IS NULL"]
        middle = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(cuts, cuts[1:], strict=False)]
        return [f"{column} < {cuts[0]}", *middle, f"{column} >= {cuts[-1]}", f"{column} IS NULL"]

    def read_options(self, name: str) -> dict[str, str]:
        """Reader options for a table that is read in one piece."""
        if name not in self.partitioning and name not in self.small:
            raise ValueError(f"{name}: give a partition column, or list it as small")
        return {"dbtable": name}

    def names(self) -> list[str]:
        rows = self._read(query=self.listing_sql()).collect()
        return sorted((f"{r[0]}.{r[1]}" for r in rows), key=split_name)

    def table(self, name: str) -> DataFrame:
        if name not in self.partitioning:
            return self._read(**self.read_options(name))
        bounds = [row[1] for row in self._read(query=self.bounds_sql(name)).collect()]
        if not bounds and name not in self.small and self._read(query=self.any_row_sql(name)).first():
            column, _ = self.partitioning[name]
            raise ValueError(f"{name}: all values of {column} are NULL, so it can't split the read")
        if not bounds:
            return self._read(**self.read_options(name))
        return self.spark.read.jdbc(self.url, name, predicates=self.predicates(name, bounds), properties=self.options)


def sql_literal(value) -> str:
    """A value of a partition column as a literal of standard SQL."""
    if isinstance(value, bool) or not isinstance(value, (int, float, Decimal, str, date)):
        raise TypeError(f"can't split by values such as {value!r}")
    if isinstance(value, datetime):
        return f"TIMESTAMP '{value:%Y-%m-%d %H:%M:%S.%f}'"
    if isinstance(value, date):
        return f"DATE '{value:%Y-%m-%d}'"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return str(value)
