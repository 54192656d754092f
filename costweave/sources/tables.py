"""Scans of lake tables.

Every scan goes through ``spark.read`` with a column list and an optional
predicate so that Catalyst pushes both into the Parquet reader
(``ReadSchema`` / ``PushedFilters`` in ``explain``).
"""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.types import StructType

DRIVER_TABLES = ("region nation customer supplier part orders lineitem events "
                 "documents embeddings pages benchmark labels conversations").split()


def table_path(root: str, name: str) -> str:
    p = os.path.join(root, f"{name}.parquet")
    return p if os.path.exists(p) or "://" in root else os.path.join(root, name)


def scan_table(spark: SparkSession, root: str, name: str,
               cols: list[str] | None = None, where: Column | str | None = None) -> DataFrame:
    """Lazy scan; projection and predicate reach the Parquet scan."""
    df = spark.read.parquet(table_path(root, name))
    if cols:
        df = df.select(*cols)
    if where is not None:
        df = df.filter(where)
    return df


def scan_or_empty(spark: SparkSession, path: str, schema: StructType,
                  fmt: str = "parquet") -> DataFrame:
    """Missing table -> typed empty frame (only a missing path is forgiven)."""
    try:
        df = spark.read.format(fmt).load(path)
        df.schema  # forces path resolution
        return df
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_external(spark: SparkSession, path: str, fmt: str, schema: StructType | None = None,
                  **options) -> DataFrame:
    """Read-only mounted source: csv (plain or gzip), parquet or json."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        options.setdefault("header", "true")
    return reader.options(**options).load(path)
