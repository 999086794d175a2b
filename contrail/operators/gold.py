"""Hourly departure statistics per location (the gold layer).

Pipeline: flight facts → work set of (date, hour) → restrict facts to it →
aggregate per (location, date, hour) → densify against the location
dimension so every location gets a row for every processed hour.

Plan shape (see ``hourly_stats``): facts are restricted with a broadcast
semi-join on the small work set and aggregated first. Partial aggregation
collapses them map-side, so a hot location-hour is reduced before the
shuffle. The dense grid is generated in the partitions that the aggregates
are sent to, clustered by date as the table is written; the grid itself is
never shuffled.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.functions.arith import (
    mean_minutes_2dp, mean_minutes_reference, percentage_2dp, percentage_reference,
)
from contrail.functions.times import delay_seconds
from contrail.operators.joins import fits_broadcast, maybe_broadcast, replicated_product
from contrail.schemas import DELAY_THRESHOLD_MINUTES

KEYS = ["airport_code", "date", "hour"]
HOUR_KEYS = ["date", "hour"]
GOLD_COLUMNS = ["airport_code", "longitude", "latitude", "total_departures",
                "average_departure_delay_minutes", "delayed_flights",
                "delayed_flights_percentage", "date", "hour"]
#: Gold rows of one date that one task produces at most, about.
ROWS_PER_DATE_TASK = 1_000_000
DELAYED_AFTER_SECONDS = DELAY_THRESHOLD_MINUTES * 60


def _date(d: dt.date | str | Column) -> Column:
    if isinstance(d, Column):
        return d
    return F.lit(d if isinstance(d, str) else d.isoformat()).cast("date")


def flight_facts(flights: DataFrame) -> DataFrame:
    """(airport_code, date, hour, delay_seconds) per departure.

    Date and hour come from the actual local departure time, else the
    scheduled one. The delay is whole UTC seconds actual minus scheduled and
    is NULL when either side is missing (the flight still counts as a
    departure). Rows without location, date or hour are dropped. A ``date``
    column of ``flights`` holds this date already; on a table partitioned by
    it, filters on the facts' date prune the scan.
    """
    local = F.coalesce(F.col("departure_actual_time_local"),
                       F.col("departure_scheduled_time_local"))
    date = F.col("date") if "date" in flights.columns else F.to_date(local)
    return (
        flights.select(
            F.col("departure_airport_code").alias("airport_code"),
            date.alias("date"),
            F.hour(local).alias("hour"),
            delay_seconds("departure_actual_time_utc",
                          "departure_scheduled_time_utc").alias("delay_seconds"),
        )
        .where(F.col("airport_code").isNotNull() & F.col("date").isNotNull()
               & F.col("hour").isNotNull())
    )


def done_hours(gold: DataFrame) -> DataFrame:
    """(date, hour) pairs already present in the gold table."""
    return gold.where(F.col("hour").isNotNull()).select(*HOUR_KEYS).distinct()


def work_set(facts: DataFrame, done: DataFrame, as_of: dt.date | str | Column,
             refresh_days: int = 1, done_rows: int | None = None) -> DataFrame:
    """(date, hour, refresh) pairs to (re)compute on run date ``as_of``.

    * dates in ``[as_of - refresh_days, as_of)`` are refreshed: every hour
      with a flight, whether or not gold has it (``refresh = true``);
    * older dates contribute the hours with a flight that gold lacks;
    * today and later are ignored.

    One distinct over the facts (partial aggregation: each task ships at
    most 24 rows per day it saw) and one anti-join against the done set,
    whose join condition excludes refresh dates so they always survive.
    """
    as_of_c = _date(as_of)
    refresh_start = F.date_sub(as_of_c, refresh_days)
    cand = facts.where(F.col("date") < as_of_c).select(*HOUR_KEYS).distinct().alias("c")
    d = maybe_broadcast(done.select(*HOUR_KEYS), done_rows).alias("d")
    cond = ((F.col("c.date") == F.col("d.date")) & (F.col("c.hour") == F.col("d.hour"))
            & (F.col("c.date") < refresh_start))
    return (cand.join(d, cond, "left_anti")
            .select("date", "hour", (F.col("date") >= refresh_start).alias("refresh")))


def restrict_to_work_set(facts: DataFrame, work: DataFrame,
                         work_rows: int | None = None) -> DataFrame:
    """Facts whose (date, hour) is in the work set (semi-join; the work set is distinct)."""
    return facts.join(maybe_broadcast(work.select(*HOUR_KEYS), work_rows), HOUR_KEYS, "left_semi")


def delay_by_key_hour(facts: DataFrame, exact: bool = True) -> DataFrame:
    """Departures, mean delay (minutes, 2 dp) and delayed count per (location, date, hour)."""
    agg = facts.groupBy(*KEYS).agg(
        F.count(F.lit(1)).cast("int").alias("total_departures"),
        F.sum("delay_seconds").alias("_s"),
        F.count("delay_seconds").alias("_n"),
        F.avg(F.col("delay_seconds") / F.lit(60.0)).alias("_avg"),
        F.count_if(F.col("delay_seconds") > DELAYED_AFTER_SECONDS).cast("int")
        .alias("delayed_flights"),
    )
    mean = (mean_minutes_2dp(F.col("_s"), F.col("_n")) if exact
            else mean_minutes_reference(F.col("_avg")))
    return agg.select(*KEYS, "total_departures",
                      mean.alias("average_departure_delay_minutes"), "delayed_flights")


def dense_grid(dimension: DataFrame, work: DataFrame, dimension_rows: int,
               work_rows: int) -> DataFrame:
    """Every location of the dimension x every (date, hour) of the work set.

    The output is inherently |dimension| x |work set|; both inputs are
    bounded (the work set by 24 x days, the dimension by the reference
    list). The smaller side is replicated to the larger one, which stays
    partitioned, so the grid is produced in parallel.
    """
    dim = dimension.select("airport_code", "longitude", "latitude")
    hours = work.select(*HOUR_KEYS)
    if dimension_rows <= work_rows:
        grid = replicated_product(hours, dim, dimension_rows, big_rows=work_rows)
    else:
        grid = replicated_product(dim, hours, work_rows, big_rows=dimension_rows)
    return grid.select("airport_code", "longitude", "latitude", *HOUR_KEYS)


def _clustered_grid(dimension: DataFrame, work: DataFrame, partitions: int, salts: int,
                    dimension_rows: int) -> DataFrame:
    """The dense grid, generated where its rows are to be written: clustered by (date, ``_salt``).

    Only (date, hour, salt) rows are exchanged; each then meets the locations
    of its salt, so the product itself never crosses the network.
    """
    hours = work.select(*HOUR_KEYS, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt"))
    dim = dimension.select("airport_code", "longitude", "latitude", _salt(salts).alias("_dim_salt"))
    return (hours.repartition(partitions, "date", "_salt")
            .join(maybe_broadcast(dim, dimension_rows), F.col("_salt") == F.col("_dim_salt"))
            .drop("_dim_salt"))


def _salt(salts: int) -> Column:
    return F.pmod(F.xxhash64("airport_code"), F.lit(salts)).cast("int")


def hourly_stats(facts: DataFrame, dimension: DataFrame, work: DataFrame,
                 dimension_rows: int, work_rows: int, exact: bool = True) -> DataFrame:
    """Gold rows for every dimension location x every work-set hour, clustered by date.

    Locations missing from the dimension are dropped; dimension locations
    without flights get 0 departures, NULL mean delay, 0 delayed, 0.0 %.

    A date of many locations is split by a salt of the location, so that
    a task writes about ``ROWS_PER_DATE_TASK`` rows at most of a date.
    """
    salts = max(1, -(-dimension_rows * 24 // ROWS_PER_DATE_TASK))
    parallelism = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if not fits_broadcast(dimension.select("airport_code", "longitude", "latitude"), dimension_rows):
        salts = max(salts, parallelism)
    partitions = max(1, min(parallelism, work_rows), -(-dimension_rows * work_rows // ROWS_PER_DATE_TASK))
    delayed = F.col("delay_seconds") > DELAYED_AFTER_SECONDS
    flights = restrict_to_work_set(facts, work, work_rows).groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("_flights"), F.sum("delay_seconds").alias("_s"),
        F.count("delay_seconds").alias("_n"), F.sum(F.col("delay_seconds") / F.lit(60.0)).alias("_minutes"),
        F.count_if(delayed).alias("_delayed")
    ).withColumn("_salt", _salt(salts)).repartition(partitions, "date", "_salt")
    grid = _clustered_grid(dimension, work, partitions, salts, dimension_rows).withColumn("_in_dim", F.lit(1))
    # Both sides have one partitioning, which the union keeps: no exchange above it.
    agg = flights.unionByName(grid, allowMissingColumns=True).groupBy("date", "_salt", "hour", "airport_code").agg(
        F.max("_in_dim").alias("_in_dim"),
        F.coalesce(F.sum("_flights"), F.lit(0)).cast("int").alias("total_departures"),
        F.sum("_s").alias("_s"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("_n"),
        (F.sum("_minutes") / F.sum("_n")).alias("_avg"),
        F.coalesce(F.sum("_delayed"), F.lit(0)).cast("int").alias("delayed_flights"),
        F.max("longitude").alias("longitude"),
        F.max("latitude").alias("latitude"),
    ).where(F.col("_in_dim") == 1)
    if exact:
        mean = mean_minutes_2dp(F.col("_s"), F.col("_n"))
        pct = percentage_2dp(F.col("delayed_flights"), F.col("total_departures"))
    else:
        mean = mean_minutes_reference(F.col("_avg"))
        pct = percentage_reference(F.col("delayed_flights"), F.col("total_departures"))
    return agg.select(
        "airport_code", "longitude", "latitude", "total_departures",
        mean.alias("average_departure_delay_minutes"), "delayed_flights",
        pct.alias("delayed_flights_percentage"), "date",
        F.col("hour").cast("int").alias("hour"))
