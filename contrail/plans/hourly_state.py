"""Mergeable hourly state: sums per (location, date, hour) that late and corrected flights change in place.

The gold job freezes an hour once it is written (only the refresh window is
computed again). This is the other mode: :func:`flight_merge.merge_flights`
records the signed changes of each landing, and the state is their sum,

    flights, seconds (sum of delays), timed (flights with a delay), delayed,

which is exact, since all four are integers and subtraction undoes addition.
An old hour changes by the flights that changed, without reading its others.

``state/generation=<n>`` holds the sums of the landings listed beside it in
``included``; :func:`compact` writes the next one. A reader takes the newest
generation that is whole, and the changes of the landings it does not include.
A compaction that fails leaves an unread folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from contrail.functions.arith import mean_minutes_2dp, percentage_2dp
from contrail.operators import gold as G
from contrail.plans.flight_merge import CHANGES, MEASURES
from contrail.plans.sinks import exists, folder_names, overwrite_table
from contrail.session import cut_lineage
from contrail.sources.tables import read_or_empty

_KEY = ["airport_code", "date", "hour"]
_LANDINGS = StructType([StructField("landing", StringType())])


def landings(spark: SparkSession, root: str) -> list[str]:
    """Names of the landings whose changes are recorded."""
    names = folder_names(spark, f"{root}/changes", "landing=")
    return [n for n in names if exists(spark, f"{root}/changes/landing={n}/_SUCCESS")]


def newest_generation(spark: SparkSession, root: str) -> int | None:
    """Number of the newest generation that is whole; its list of landings is written last."""
    numbers = sorted((int(n) for n in folder_names(spark, f"{root}/state", "generation=")), reverse=True)
    return next((n for n in numbers if exists(spark, f"{root}/state/generation={n}/included/_SUCCESS")), None)


def _parts(spark: SparkSession, root: str) -> tuple[list[DataFrame], list[str]]:
    n = newest_generation(spark, root)
    parts, included = [], set()
    if n is not None:
        base = f"{root}/state/generation={n}"
        included = {r[0] for r in spark.read.schema(_LANDINGS).parquet(f"{base}/included").collect()}  # one per landing
        parts.append(spark.read.schema(CHANGES).parquet(f"{base}/sums"))
    every = landings(spark, root)
    parts += [spark.read.schema(CHANGES).parquet(f"{root}/changes/landing={x}") for x in every if x not in included]
    return parts, sorted(included | set(every))


def read_state(spark: SparkSession, root: str) -> DataFrame:
    """airport_code, date, hour and the four sums, of the hours that have flights."""
    parts, _ = _parts(spark, root.rstrip("/"))
    out = spark.createDataFrame([], CHANGES)
    for part in parts:
        out = out.unionByName(part)
    sums = out.groupBy(*_KEY).agg(*[F.sum(m).alias(m) for m in MEASURES])
    return sums.where(F.col("flights") > 0)


def compact(spark: SparkSession, root: str) -> int:
    """Write the sums of all recorded landings as the next generation; returns its number."""
    root = root.rstrip("/")
    _, names = _parts(spark, root)
    n = 1 + (newest_generation(spark, root) or 0)
    base = f"{root}/state/generation={n}"
    overwrite_table(read_state(spark, root).repartitionByRange("date").sortWithinPartitions("date"), f"{base}/sums", CHANGES)
    overwrite_table(spark.createDataFrame([(x,) for x in names], _LANDINGS).coalesce(1), f"{base}/included", _LANDINGS)
    return n


def stats_from_state(state: DataFrame, airports: DataFrame, until=None) -> DataFrame:
    """Gold rows of every location and every hour that has a flight anywhere, before the date ``until``.

    Hours that corrections have emptied are gone, as in a full build from the
    corrected flights.
    """
    if until is not None:
        state = state.where(F.col("date") < F.lit(until).cast("date"))
    state = cut_lineage(state)
    hours = cut_lineage(state.select(*G.HOUR_KEYS).distinct(), 1)  # 24 rows a date at most
    dim = cut_lineage(airports.select("airport_code", "longitude", "latitude"), 1)
    grid = G.dense_grid(dim, hours, dim.count(), hours.count())
    rows = grid.join(state, _KEY, "left")
    total, delayed = (F.coalesce(c, F.lit(0)).cast("int") for c in ("flights", "delayed"))
    return rows.select(
        "airport_code", "longitude", "latitude", total.alias("total_departures"),
        mean_minutes_2dp(F.col("seconds"), F.col("timed")).alias("average_departure_delay_minutes"),
        delayed.alias("delayed_flights"), percentage_2dp(delayed, total).alias("delayed_flights_percentage"),
        "date", "hour")
