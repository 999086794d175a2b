"""What changed between landings: snapshot history and field-level survivorship."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contrail.operators.parse import parse_pages
from contrail.operators.silver import SPECS, SilverSpec
from contrail.operators.snapshot import dedupe_first


def entity_snapshots(bronze: DataFrame, spec: SilverSpec | str) -> DataFrame:
    """Typed rows of a reference entity for every ingestion date, each key once a date (as ``silver_entity`` does)."""
    spec = SPECS[spec] if isinstance(spec, str) else spec
    items = parse_pages(bronze.select("raw_data", "offset", "ingestion_date"), spec.entity, keep=["ingestion_date", "offset"])
    rows = items.select("ingestion_date", "offset", "pos", *spec.project(F.col("item"))).where(F.col(spec.key).isNotNull())
    if spec.keep is not None:
        rows = rows.where(spec.keep())
    return dedupe_first(rows, ["ingestion_date", spec.key], [F.col("offset"), F.col("pos")]).drop("offset", "pos")


def snapshot_history(snapshots: DataFrame, landed: DataFrame, key: str, date_col: str = "ingestion_date") -> DataFrame:
    """``snapshots`` as periods: key, values, ``valid_from``, ``valid_to`` (exclusive; null: still so).

    ``landed`` holds the ``date_col`` of every snapshot, also of those without
    a row. A period lasts over consecutive snapshots with equal values (nulls
    are equal); a key that a snapshot lacks ends there, and may begin again.
    A key's rows are ordered alone: no more than there are snapshots.
    """
    dates = landed.select(F.col(date_col).alias("_date")).where("_date is not null").distinct()
    order = Window.orderBy("_date")  # one row per snapshot
    dates = dates.select("_date", F.row_number().over(order).alias("_seq"), F.lead("_date").over(order).alias("_next"))
    values = [c for c in snapshots.columns if c not in (key, date_col)]
    rows = snapshots.join(dates, F.col(date_col) == F.col("_date")).drop("_date")
    by_key = Window.partitionBy(key).orderBy("_seq")
    same = F.col("_seq") == F.lag("_seq").over(by_key) + 1
    for c in values:
        same = same & F.col(c).eqNullSafe(F.lag(c).over(by_key))
    rows = rows.withColumn("_new", F.when(F.coalesce(same, F.lit(False)), 0).otherwise(1))
    rows = rows.withColumn("_period", F.sum("_new").over(by_key))
    return rows.groupBy(key, "_period").agg(
        *[F.min_by(c, "_seq").alias(c) for c in values], F.min(date_col).alias("valid_from"),
        F.max_by("_next", "_seq").alias("valid_to")).drop("_period")


def as_of(history: DataFrame, date) -> DataFrame:
    """The rows of :func:`snapshot_history` that held on ``date``."""
    d = F.lit(date).cast("date")
    return history.where((F.col("valid_from") <= d) & (F.col("valid_to").isNull() | (F.col("valid_to") > d))).drop("valid_from", "valid_to")


def survivors(rows: DataFrame, keys: list[str], order: list[Column], source: list[str]) -> DataFrame:
    """One row per ``keys``: each column's newest value that is not null, and where it comes from.

    ``order`` ranks the landings, newest first; ties fall to the smaller
    ``source`` values, then to the smaller value. Beside each column c stands
    ``c_from``, a struct of the ``source`` columns, null where no landing has a
    value. Rows with an incomplete key identify nothing and are left out.

    One aggregate per column over ordered structs: partial aggregation leaves
    a candidate per key and task, however often a key was landed.
    """
    columns = [c for c in rows.columns if c not in (*keys, *source)]
    ranked = [c.alias(f"_o{i}") for i, c in enumerate(order)]
    best = [F.min(F.when(F.col(c).isNotNull(), F.struct(*ranked, *[F.col(s) for s in source], F.col(c).alias("_value")))).alias(c)
            for c in columns]
    complete = " and ".join(f"`{k}` is not null" for k in keys)
    won = rows.where(complete).groupBy(*keys).agg(*best)
    place = {c: F.when(F.col(c).isNotNull(), F.struct(*[F.col(c)[s].alias(s) for s in source])) for c in columns}
    return won.select(*keys, *[x for c in columns for x in (F.col(c)["_value"].alias(c), place[c].alias(f"{c}_from"))])
