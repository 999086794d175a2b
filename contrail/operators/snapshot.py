"""Latest-snapshot selection and deterministic key deduplication."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_snapshot(bronze: DataFrame, date_col: str = "ingestion_date") -> DataFrame:
    """Rows of the newest ``date_col`` (empty input → empty output).

    A scalar subquery, not a driver round trip: on a table partitioned by
    ``date_col`` the scan prunes to the newest partition at run time.
    """
    newest = bronze.agg(F.max(date_col)).scalar()
    return bronze.where(F.col(date_col) == newest)


def dedupe_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per ``keys``: the row with the smallest ``order`` tuple, then the smallest other columns.

    The order is total, so the winner does not depend on partitioning or
    input order. Rows whose key has a NULL part identify nothing and pass
    through unchanged.

    An aggregate (``min`` of a struct) rather than a window: partial
    aggregation leaves one candidate per key per task before the shuffle, so
    a key holding a third of all rows costs no more than any other key.
    Aggregating a struct sorts rows by key in each task (SortAggregate).
    """
    others = [c for c in df.columns if c not in keys]
    complete = reduce(and_, [F.col(k).isNotNull() for k in keys])
    ranked = [c.alias(f"_o{i}") for i, c in enumerate(order)]
    winner = F.min(F.struct(*ranked, *others)).alias("_w")
    unique = (df.where(complete).groupBy(*keys).agg(winner)
              .select(*keys, *[F.col("_w")[c].alias(c) for c in others]))
    return unique.select(df.columns).union(df.where(~complete))
