"""Raw API pages: packing, landing (bronze rows) and page files.

A page is one JSON document ``{resource: {container: {list: [...]}, "Meta":
{"TotalCount": n}}}``. A list with a single entry may arrive as a bare
object. Landing stores each page as one string row with load metadata;
everything is set-based (one Spark job lands any number of pages).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from contrail.functions.times import block_date, block_hour_text
from contrail.schemas import Entity

# Page-file layout: one JSON record per page, partitioned by entity and date.
PAGE_FILE_SCHEMA = StructType([
    StructField("offset", LongType()), StructField("raw_data", StringType()),
])
# Departure pages keep the airport and block that they were requested for.
FLIGHT_PAGE_FILE_SCHEMA = StructType([
    *PAGE_FILE_SCHEMA.fields,
    StructField("airport_code", StringType()), StructField("block", StringType()),
])
# Page file names end in ``_<offset>.json``.
OFFSET_IN_FILE_NAME = r"_([0-9]+)\.json$"


def _date(d: dt.date | str | Column) -> Column:
    if isinstance(d, Column):
        return d
    return F.lit(d if isinstance(d, str) else d.isoformat()).cast("date")


def json_string(c: Column) -> Column:
    """JSON text of a scalar (quoted and escaped string, number, ``null``)."""
    return F.regexp_extract(F.to_json(F.array(c)), r"^\[(.*)\]$", 1)


def envelope(entity: Entity, list_json: Column, total: Column) -> Column:
    """The page document around an already serialised list (or single object)."""
    return F.concat(
        F.lit(f'{{"{entity.resource}":{{"{entity.container}":{{"{entity.list_key}":'),
        list_json,
        F.lit('},"Meta":{"TotalCount":'), total.cast("string"), F.lit("}}}"),
    )


def pack_pages(items: DataFrame, entity: Entity, page_cols: list[str], pos: Column,
               item_json: Column, total: Column | None = None) -> DataFrame:
    """Group item JSON texts into pages ordered by ``pos``.

    ``page_cols`` identify a page and must bound its size (the page size);
    a page holding one item is written as a bare object, as the source does.
    ``total`` is the ``Meta.TotalCount`` value (a column of the page keys or
    a scalar subquery); by default the number of items in the page.
    """
    total = total if total is not None else F.lit(None).cast("long")
    staged = items.select(*page_cols, pos.alias("_pos"), item_json.alias("_item"),
                          total.alias("_total"))
    grouped = staged.groupBy(*page_cols).agg(
        F.array_sort(F.collect_list(F.struct("_pos", "_item"))).alias("_items"),
        F.max("_total").alias("_total"))
    texts = F.transform("_items", lambda x: x["_item"])
    list_json = F.when(F.size("_items") == 1, F.element_at(texts, 1)).otherwise(
        F.concat(F.lit("["), F.array_join(texts, ","), F.lit("]")))
    n_total = F.coalesce(F.col("_total"), F.size("_items").cast("long"))
    return grouped.select(*page_cols, envelope(entity, list_json, n_total).alias("raw_data"),
                          F.size("_items").alias("n_items"))


def land_pages(pages: DataFrame, run_date: dt.date | str | Column) -> DataFrame:
    """Bronze rows for reference pages: ``(raw_data, ingestion_date, data_date, offset)``.

    Both dates are the run date (a parameter, so re-runs are reproducible).
    """
    d = _date(run_date)
    return pages.select(
        F.col("raw_data"), d.alias("ingestion_date"), d.alias("data_date"),
        F.col("offset").cast("int").alias("offset"))


def land_flight_pages(pages: DataFrame, run_date: dt.date | str | Column) -> DataFrame:
    """Bronze rows for departure pages fetched for a ``yyyy-MM-ddTHH:00`` block.

    ``pages`` carries ``raw_data, airport_code, offset, block``; the block is
    split into ``data_date`` and the block's hour text ``data_time_block``.
    """
    return pages.select(
        F.col("raw_data"), _date(run_date).alias("ingestion_date"),
        block_date("block").alias("data_date"),
        block_hour_text("block").alias("data_time_block"),
        F.col("airport_code").cast("string").alias("airport_code"),
        F.col("offset").cast("int").alias("offset"))


def write_page_files(pages: DataFrame, root: str, partition_cols: list[str]) -> None:
    """One JSON record per page (offset, raw_data) under ``root/<col>=<value>/...``.

    Departure pages also keep their ``airport_code`` and ``block`` in the record.
    """
    kept = [c for c in ("airport_code", "block") if c in pages.columns and c not in partition_cols]
    pages.select(*partition_cols, F.col("offset").cast("long").alias("offset"), "raw_data", *kept
                 ).write.mode("append").partitionBy(*partition_cols).json(root)


def read_page_files(spark: SparkSession, root: str, schema: StructType = PAGE_FILE_SCHEMA) -> DataFrame:
    """Pages written by :func:`write_page_files`, partition columns discovered from paths.

    ``FLIGHT_PAGE_FILE_SCHEMA`` reads departure pages.
    """
    return spark.read.schema(schema).json(root)


def read_page_documents(spark: SparkSession, root: str) -> DataFrame:
    """One-document-per-file layout (``<container>/<date>/<container>_<offset>.json``).

    Returns ``(container, date, offset, file_name, raw_data)``; the offset is
    the numeric file-name suffix (NULL when absent) and ``file_name`` breaks
    ties, which is the order pages are read in.
    """
    docs = spark.read.option("recursiveFileLookup", True).text(root, wholetext=True).select(
        F.col("value").alias("raw_data"), F.col("_metadata.file_path").alias("path"))
    parts = F.split("path", "/")
    return docs.select(
        F.element_at(parts, -3).alias("container"),
        F.element_at(parts, -2).try_cast("date").alias("date"),
        F.regexp_extract("path", OFFSET_IN_FILE_NAME, 1).try_cast("long").alias("offset"),
        F.element_at(parts, -1).alias("file_name"),
        "raw_data",
    )
