"""Hourly departure statistics kept in Spark's state store: event-time watermark, dedupe, windows.

:func:`hourly_stats_stream` reads landed departure pages as they come and
appends the statistics of an hour and location once the watermark, the latest
departure seen less ``delay``, has passed the hour. Until then the hour's sums
and the flights already counted are state, kept across restarts by the
checkpoint and bounded by ``delay``: a flight landed again within it counts
once, and one that comes after its hour was closed is dropped (the batch merge
in :mod:`contrail.plans.flight_merge` takes such rows). Of a flight landed
with several times the first counts.

Runs with ``trigger(availableNow=True)``, like the other streams: a scheduler
starts it, it works through what has arrived, closes the hours that are due,
and stops. For state beyond memory, set Spark's RocksDB state store provider.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, DoubleType, IntegerType, StringType, StructField, StructType

from contrail.functions.arith import mean_minutes_2dp
from contrail.functions.times import delay_seconds, epoch_seconds
from contrail.operators.gold import DELAYED_AFTER_SECONDS
from contrail.operators.silver import DEPARTURE_LOCAL, FLIGHT_KEY, movement_rows
from contrail.streaming.incremental import BRONZE_FLIGHTS_PARTITIONED

#: Where a page and its item stand: identifies a flight without a complete key.
_PLACE = ["data_date", "data_time_block", "page_airport", "page_offset", "page_pos"]
_DAY = 86_400
#: Layout of the closed hours.
HOURS = StructType([
    StructField("airport_code", StringType()), StructField("hour", IntegerType()),
    StructField("total_departures", IntegerType()), StructField("average_departure_delay_minutes", DoubleType()),
    StructField("delayed_flights", IntegerType()), StructField("date", DateType()),
])


def stream_facts(bronze: DataFrame) -> DataFrame:
    """Flights of landed pages with what dedupe and windows need.

    ``event_time`` is the local departure time (actual, else scheduled) taken
    as UTC, so windows do not depend on the session zone. ``place`` is set
    where the key is incomplete. Rows without location or time are left out,
    by the parsed time: what is made of it would be worked out anew, with the
    parsing, for each mention in the pushed-down filter.
    """
    local = F.coalesce(*DEPARTURE_LOCAL)
    complete = reduce(and_, [F.col(k).isNotNull() for k in FLIGHT_KEY])
    return (movement_rows(bronze, [*FLIGHT_KEY, *DEPARTURE_LOCAL, "departure_actual_time_utc"])
            .where(F.col("departure_airport_code").isNotNull() & local.isNotNull())
            .select(*FLIGHT_KEY, F.when(~complete, F.to_json(F.struct(*_PLACE))).alias("place"),
                    F.timestamp_seconds(epoch_seconds(local)).alias("event_time"),
                    delay_seconds("departure_actual_time_utc", "departure_scheduled_time_utc").alias("delay_seconds")))


def hourly_windows(facts: DataFrame, delay: str) -> DataFrame:
    """Statistics per location and hour of distinct flights, under a watermark of ``delay``."""
    d = F.col("delay_seconds")
    sums = (facts.withWatermark("event_time", delay).dropDuplicatesWithinWatermark([*FLIGHT_KEY, "place"])
            .groupBy(F.col("departure_airport_code").alias("airport_code"), F.window("event_time", "1 hour").alias("hour_window"))
            .agg(F.count(F.lit(1)).cast("int").alias("total_departures"), F.sum(d).alias("_s"), F.count(d).alias("_n"),
                 F.count_if(d > DELAYED_AFTER_SECONDS).cast("int").alias("delayed_flights")))
    start: Column = F.unix_seconds("hour_window.start")
    return sums.select(
        "airport_code", F.date_from_unix_date(F.floor(start / _DAY).cast("int")).alias("date"),
        (F.pmod(start, F.lit(_DAY)) / 3600).cast("int").alias("hour"), "total_departures",
        mean_minutes_2dp(F.col("_s"), F.col("_n")).alias("average_departure_delay_minutes"), "delayed_flights")


def hourly_stats_stream(spark: SparkSession, bronze_path: str, out_path: str, checkpoint: str, delay: str = "2 days",
                        max_files_per_trigger: int = 1000) -> StreamingQuery:
    """Append the closed hours of the bronze departure pages at ``bronze_path`` to ``out_path``, by date.

    Closed hours are few; a task writes whole dates, not each task of the state a file per date.
    """
    bronze = (spark.readStream.schema(BRONZE_FLIGHTS_PARTITIONED)
              .option("maxFilesPerTrigger", max_files_per_trigger).parquet(bronze_path))
    return (hourly_windows(stream_facts(bronze), delay).repartition("date").writeStream.format("parquet").option("path", out_path)
            .option("checkpointLocation", checkpoint).partitionBy("date").outputMode("append")
            .trigger(availableNow=True).start())


__all__ = ["HOURS", "hourly_stats_stream", "hourly_windows", "stream_facts"]
