"""Reading the driver's parquet tables and path-based table helpers."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """``<sf_dir>/<name>.parquet`` (or a folder of that name)."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def read_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A path-based table, or an empty frame of ``schema`` when nothing was written yet.

    The existence guard of the gold job: a missing table behaves like an
    empty one of the declared layout.
    """
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(hpath):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def create_table_sql(name: str, schema: StructType, partition_by: list[str] | None = None,
                     location: str | None = None, fmt: str = "parquet") -> str:
    """``CREATE TABLE IF NOT EXISTS`` DDL for a layout (bronze, silver and gold tables)."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString().upper()}" for f in schema.fields)
    ddl = f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING {fmt}"
    if partition_by:
        ddl += " PARTITIONED BY (" + ", ".join(partition_by) + ")"
    if location:
        ddl += f" LOCATION '{location}'"
    return ddl
