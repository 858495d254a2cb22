"""Writing result tables."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()
) -> DataFrame:
    """Write ``df`` to ``path``, replacing what was there, and return it read back.

    Reading back cuts the lineage: what follows uses the stored rows, also after
    the loss of an executor.
    """
    df.write.mode("overwrite").partitionBy(*partition_by).format(fmt).save(path)
    return df.sparkSession.read.format(fmt).schema(df.schema).load(path)


def replace_part(df: DataFrame, path: str, column: str, value: str, fmt: str = "parquet") -> DataFrame:
    """Write ``df`` as the part ``column = value`` of a table, and return the part read back.

    Only that part is replaced, when all its files are there; other parts stay as they are also
    if the job fails. The table may not exist yet. A frame without rows leaves an empty part.
    """
    if not re.fullmatch(r"[\w.-]+", value):
        raise ValueError(f"letters, digits, '_', '.' and '-' can name a part, not {value!r}")
    if df.isEmpty():
        df.write.mode("overwrite").format(fmt).save(f"{path}/{column}={value}")
    else:
        part = df.withColumn(column, F.lit(value)).write.mode("overwrite").partitionBy(column).format(fmt)
        part.option("partitionOverwriteMode", "dynamic").save(path)
    return read_parts(df.sparkSession, path, df.schema, column, fmt).filter(F.col(column) == value)


def read_parts(spark: SparkSession, path: str, schema: T.StructType, column: str, fmt: str = "parquet") -> DataFrame:
    """A table of parts; a filter on ``column`` reads the parts it names only."""
    fields = [f for f in schema.fields if f.name != column]
    whole = T.StructType([*fields, T.StructField(column, T.StringType())])
    return spark.read.format(fmt).schema(whole).load(path)
