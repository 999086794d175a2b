"""Order-independent table fingerprints, so that an unchanged snapshot is not written again.

A fingerprint is the count, the sum and the exclusive or of the rows' 64-bit
hashes: equal for equal multisets of rows, in whatever order, partitions or
pages they came. It is a mergeable aggregate of three numbers, stored in a
one-row table ``<path>_fingerprint`` after the table itself; a run that fails
between both writes the table again next time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, LongType, StructField, StructType

from contrail.operators.silver import SPECS, silver_entity
from contrail.plans.jobs import _SILVER_LAYOUTS
from contrail.plans.sinks import exists, overwrite_table
from contrail.session import cut_lineage
from contrail.sources.tables import read_or_empty

FINGERPRINT = StructType([
    StructField("rows", LongType()), StructField("hash_sum", DecimalType(38, 0)), StructField("hash_xor", LongType())])


def fingerprint(df: DataFrame) -> DataFrame:
    """One row (:data:`FINGERPRINT`). Columns count by position, so select them in a fixed order."""
    # The place of a null among the columns is part of the hash: xxhash64 alone skips nulls.
    nulls = F.concat(*[F.when(F.col(f"`{c}`").isNull(), "1").otherwise("0") for c in df.columns])
    h = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns], nulls)
    return df.select(h.alias("h")).agg(
        F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.col("h").cast("decimal(20,0)")), F.lit(0)).cast("decimal(38,0)").alias("hash_sum"),
        F.coalesce(F.bit_xor("h"), F.lit(0)).cast("long").alias("hash_xor"))


def stored_fingerprint(spark: SparkSession, path: str) -> tuple | None:
    """The fingerprint beside the table at ``path``, if both are whole."""
    if not all(exists(spark, f"{p}/_SUCCESS") for p in (path, f"{path}_fingerprint")):
        return None
    row = read_or_empty(spark, f"{path}_fingerprint", FINGERPRINT).first()
    return tuple(row) if row else None


def overwrite_if_changed(df: DataFrame, path: str, layout: StructType) -> bool:
    """Replace the table at ``path`` by ``df`` unless it holds the same rows; whether it was written."""
    spark, path = df.sparkSession, path.rstrip("/")
    df = cut_lineage(df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in layout.fields]))
    new = tuple(fingerprint(df).first())
    if new == stored_fingerprint(spark, path):
        return False
    overwrite_table(df, path, layout)
    overwrite_table(spark.createDataFrame([new], FINGERPRINT).coalesce(1), f"{path}_fingerprint", FINGERPRINT)
    return True


def refresh_entity(bronze: DataFrame, entity: str, target_path: str) -> str:
    """Like ``jobs.silverize_entity``, but leaves an unchanged table alone: ``written``, ``skipped`` or ``empty``."""
    if bronze.isEmpty():
        return "empty"
    changed = overwrite_if_changed(silver_entity(bronze, SPECS[entity]), target_path, _SILVER_LAYOUTS[entity])
    return "written" if changed else "skipped"


#: Report of refreshes: step, status and the rows that the table then has.
REFRESHES = "step int, status string, table_rows long"

__all__ = ["FINGERPRINT", "REFRESHES", "fingerprint", "overwrite_if_changed", "refresh_entity", "stored_fingerprint"]
