"""Incremental landing and silver refresh with Structured Streaming.

The batch operators are reused unchanged; streaming only decides *which*
rows are new. Each stage runs with ``trigger(availableNow=True)``: it
processes whatever arrived since its checkpoint and stops, so a scheduler
can run it every few hours like the batch job.

* :func:`land_page_stream` — page files (``write_page_files`` layout, one
  JSON record per page under ``airport_code=/block=`` folders) → bronze
  departure rows, through the parquet file sink (exactly once: the sink's
  commit log records each batch).
* :func:`movements_stream` — new bronze rows → the flight table partitioned
  by departure date, through ``foreachBatch`` and the batch merge: only the
  touched dates are rewritten, and no row is too late. A page landed twice, or
  a micro-batch run twice, counts once.
* :func:`refresh_gold_each_batch` — ``foreachBatch`` that merges each
  micro-batch into silver and then runs the gold job, so gold never runs
  before silver holds the rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, StructField, StructType

from contrail import schemas as S
from contrail.sources.pages import FLIGHT_PAGE_FILE_SCHEMA as PAGE_STREAM_SCHEMA, land_flight_pages
from contrail.sources.tables import read_or_empty

BRONZE_FLIGHTS_PARTITIONED = StructType([
    *[f for f in S.BRONZE_FLIGHTS.fields if f.name != "ingestion_date"],
    StructField("ingestion_date", DateType()),
])


def land_page_stream(spark: SparkSession, pages_dir: str, bronze_path: str, checkpoint: str,
                     run_date: dt.date | str, max_files_per_trigger: int = 1000
                     ) -> StreamingQuery:
    """Land new page files as bronze departure rows partitioned by ``ingestion_date``."""
    pages = (spark.readStream.schema(PAGE_STREAM_SCHEMA)
             .option("maxFilesPerTrigger", max_files_per_trigger).json(pages_dir))
    bronze = land_flight_pages(pages, run_date)
    return (bronze.writeStream.format("parquet").option("path", bronze_path)
            .option("checkpointLocation", checkpoint).partitionBy("ingestion_date")
            .outputMode("append").trigger(availableNow=True).start())


def movements_stream(spark: SparkSession, bronze_path: str, silver_path: str, checkpoint: str
                     ) -> StreamingQuery:
    """Merge newly landed bronze rows into the flight table, one row per flight."""
    from contrail.plans.jobs import silverize_new_movements

    def run(batch: DataFrame, batch_id: int) -> None:
        silverize_new_movements(batch, silver_path)

    bronze = spark.readStream.schema(BRONZE_FLIGHTS_PARTITIONED).parquet(bronze_path)
    return (bronze.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def refresh_gold_each_batch(spark: SparkSession, bronze_path: str, silver_path: str,
                            airports: DataFrame, gold_path: str, checkpoint: str,
                            as_of: dt.date | str) -> StreamingQuery:
    """For each batch of new bronze rows: merge them into silver, then run the gold job."""
    from contrail.plans.jobs import MOVEMENTS_BY_DATE, goldenize, silverize_new_movements

    def run(batch: DataFrame, batch_id: int) -> None:
        touched = silverize_new_movements(batch, silver_path)
        flights = read_or_empty(spark, silver_path, MOVEMENTS_BY_DATE)
        # Also without new rows: dates that an earlier run left may be due now.
        goldenize(spark, flights, airports, gold_path, as_of, touched=touched)

    bronze = spark.readStream.schema(BRONZE_FLIGHTS_PARTITIONED).parquet(bronze_path)
    return (bronze.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


__all__ = ["land_page_stream", "movements_stream", "refresh_gold_each_batch",
           "BRONZE_FLIGHTS_PARTITIONED", "PAGE_STREAM_SCHEMA"]
