"""Join building blocks with explicit, checked size bounds.

``broadcast()`` is applied only to a side whose row count has been measured
(``count`` on an already materialised, bounded frame) and whose rows, at the
estimated width of its columns, are under a limit in bytes; beyond the limit
the plan falls back to a shuffle join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, NumericType, TimestampNTZType, TimestampType

# What we are willing to ship to every executor. A (date, hour) work set for
# ten years is 87,600 rows; an airport dimension a few tens of thousands.
DEFAULT_BROADCAST_ROWS = 2_000_000
DEFAULT_BROADCAST_BYTES = 64 * 2**20
# Estimated bytes of a row: its overhead, and a column by whether its type has a fixed width.
ROW_OVERHEAD, FIXED_WIDTH, OPEN_WIDTH = 16, 8, 64

_BUCKET = "__bucket"
# Output rows one task should produce when a product is generated.
ROWS_PER_TASK = 4_000_000


def row_bytes(df: DataFrame) -> int:
    """Estimated bytes of a row of ``df`` in memory."""
    fixed = (NumericType, DateType, TimestampType, TimestampNTZType, BooleanType)
    return ROW_OVERHEAD + sum(FIXED_WIDTH if isinstance(f.dataType, fixed) else OPEN_WIDTH for f in df.schema.fields)


def fits_broadcast(df: DataFrame, rows: int | None, max_rows: int = DEFAULT_BROADCAST_ROWS) -> bool:
    """Whether the measured ``rows`` of ``df`` are within the limits in rows and bytes."""
    return rows is not None and rows <= max_rows and rows * row_bytes(df) <= DEFAULT_BROADCAST_BYTES


def maybe_broadcast(df: DataFrame, rows: int | None,
                    max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``df`` when its measured row count is within the limits."""
    return F.broadcast(df) if fits_broadcast(df, rows, max_rows) else df


def replicated_product(big: DataFrame, small: DataFrame, small_rows: int,
                       max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
                       buckets: int | None = None, big_rows: int | None = None) -> DataFrame:
    """Every row of ``big`` paired with every row of ``small`` as an equi-join.

    Used for densification, whose output *is* the product of two bounded
    dimension sets (airports x processed hours). ``big`` is split into
    ``k`` hash buckets and ``small`` is replicated once per bucket, then the
    two are equi-joined on the bucket id. With ``k = 1`` and a broadcast of
    ``small`` this is a broadcast hash join streaming ``big``; when
    ``small`` is too large to broadcast, ``k`` buckets spread the output
    over ``k`` tasks, each producing |big|/k x |small| rows.

    When ``big_rows`` is known, the streamed side is first spread over
    enough partitions for the output (``ROWS_PER_TASK`` rows each, an
    explicit count that AQE keeps): both inputs are small but the product
    is not, and a small input usually sits in one partition.
    """
    spark = big.sparkSession
    parallelism = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if fits_broadcast(small, small_rows, max_broadcast_rows):
        k = 1
    else:
        k = buckets or parallelism
    if big_rows is not None and k == 1:
        want = min(big_rows, -(-big_rows * small_rows // ROWS_PER_TASK))
        if want > 1:
            big = big.repartition(want)
    keyed_big = big.withColumn(_BUCKET, F.pmod(F.xxhash64(*big.columns), F.lit(k)))
    keyed_small = small.withColumn(_BUCKET, F.explode(F.sequence(F.lit(0).cast("long"),
                                                                 F.lit(k - 1).cast("long"))))
    if k == 1:
        keyed_small = F.broadcast(keyed_small)
    return keyed_big.join(keyed_small, _BUCKET, "inner").drop(_BUCKET)
