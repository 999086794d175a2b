"""The user-facing jobs: silver refresh and the incremental gold build.

Each job is a short sequence of Spark jobs with explicit materialisation
points (checkpoints in the shared folder) where a result is reused, so
nothing is recomputed per write and an executor loss only re-runs the
current stage.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, StringType, StructField, StructType

from contrail import schemas as S
from contrail.operators import gold as G
from contrail.operators.audit import split_quarantine
from contrail.operators.joins import DEFAULT_BROADCAST_ROWS
from contrail.operators.silver import (
    FLIGHT_KEY, SPECS, movement_rows, newest_per_flight, silver_entity, silver_movements,
)
from contrail.plans.sinks import (
    among, append_table, drop_partitions, overwrite_table, purge_null_hour, replace_partitions, spread, upsert_partitions,
)
from contrail.session import cut_lineage, drop_folder, stage, work_path
from contrail.sources.tables import read_or_empty

_SILVER_LAYOUTS = {
    "airports": S.SILVER_AIRPORTS, "cities": S.SILVER_CITIES, "countries": S.SILVER_COUNTRIES,
    "airlines": S.SILVER_AIRLINES, "aircraft_summaries": S.SILVER_AIRCRAFT,
}


def quarantine_pages(bronze: DataFrame, entity: str, path: str) -> dict[str, int]:
    """Store the landed pages that do not parse as ``entity``, with status and detail.

    The table at ``path`` is partitioned by ``ingestion_date``; the dates of
    ``bronze`` that have such pages are replaced, so a run can be repeated.
    Returns the number of pages by status.
    """
    _, bad = split_quarantine(bronze, S.ALL_ENTITIES[entity])
    bad = cut_lineage(bad)
    counts = {r["status"]: r["count"] for r in bad.groupBy("status").count().collect()}  # a handful
    if counts:
        replace_partitions(spread(bad, "ingestion_date"), path, ["ingestion_date"])
    return counts


def silverize_entity(bronze: DataFrame, entity: str, target_path: str,
                     quarantine_path: str | None = None) -> bool:
    """Overwrite one reference table from the newest bronze snapshot; False when bronze is empty.

    With ``quarantine_path``, pages that do not parse are stored there.
    """
    if bronze.isEmpty():
        return False
    if quarantine_path:
        quarantine_pages(bronze, entity, quarantine_path)
    overwrite_table(silver_entity(bronze, SPECS[entity]), target_path, _SILVER_LAYOUTS[entity])
    return True


def silverize_movements(bronze: DataFrame, target_path: str, dedupe: bool = False,
                        quarantine_path: str | None = None) -> bool:
    """Overwrite the flight table from all landed departure pages; False when bronze is empty.

    With ``quarantine_path``, pages that do not parse are stored there.
    """
    if bronze.isEmpty():
        return False
    if quarantine_path:
        quarantine_pages(bronze, S.FLIGHTS.name, quarantine_path)
    overwrite_table(silver_movements(bronze, dedupe=dedupe), target_path, S.SILVER_FLIGHTS)
    return True


def silverize_new_movements(bronze: DataFrame, target_path: str) -> list[dt.date | None]:
    """Merge newly landed departure pages into a flight table partitioned by departure ``date``.

    ``bronze`` holds the new rows only (for instance the new
    ``ingestion_date`` partitions). Touched dates are those of the new rows
    and those where the table holds one of their flights already; only these
    partitions are read, deduplicated together with the new rows, and
    replaced. However late a page arrives, none of its rows is lost, and
    merging the same pages again changes nothing. Flights without a
    departure time have a partition of their own. Returns the touched dates
    (None for that partition), which the gold job takes.
    """
    spark = bronze.sparkSession
    # Rows are staged as compressed parquet, and dropped in the end: checkpoints would hold them whole, twice a merge.
    staging = work_path(spark, "merge")
    try:
        return _merge_movements(spark, stage(movement_rows(bronze), staging, "new", "zstd"), target_path, staging)
    finally:
        drop_folder(spark, staging)


def _merge_movements(spark: SparkSession, new: DataFrame, target_path: str, staging: str) -> list[dt.date | None]:
    if new.isEmpty():
        return []
    layout = MOVEMENTS_BY_DATE
    table = read_or_empty(spark, target_path, layout)
    keys = new.select(*FLIGHT_KEY).dropna().distinct()
    met = table.select(*FLIGHT_KEY, "date").join(keys, FLIGHT_KEY, "left_semi").select("date")
    dates = [r[0] for r in new.select("date").union(met).distinct().collect()]  # bounded: one per date
    old = table.where(among("date", dates))
    rows = old.unionByName(new.select(old.columns))
    # Of all rows only a hash of their key is shuffled; whole rows only where several have one.
    h, complete = F.xxhash64(*FLIGHT_KEY), reduce(and_, [F.col(k).isNotNull() for k in FLIGHT_KEY])
    several = stage(rows.where(complete).groupBy(h.alias("_key")).count().where("count > 1").select("_key"), staging, "several")
    held = rows.withColumn("_hash", F.when(complete, h))
    alone = held.where(complete).join(several, F.col("_hash") == F.col("_key"), "left_anti").select(rows.columns)
    others = held.where(~complete).unionByName(held.join(several, F.col("_hash") == F.col("_key"), "left_semi"))
    merged = alone.unionByName(stage(newest_per_flight(others.select(rows.columns)), staging, "others"))
    left = {r[0] for r in merged.select("date").distinct().collect()}
    # Clustered by date for few files; adaptive execution splits a large date again.
    replace_partitions(merged.hint("rebalance", "date"), target_path, ["date"], layout)
    drop_partitions(spark, target_path, "date", [str(d) for d in dates if d not in left and d is not None])
    if None in dates and None not in left:
        drop_partitions(spark, target_path, "date", ["__HIVE_DEFAULT_PARTITION__"])
    return dates


#: The incremental flight table: silver columns, where each row was landed, and the partition date.
MOVEMENTS_BY_DATE = StructType([
    *S.SILVER_FLIGHTS.fields,
    StructField("ingestion_date", DateType()), StructField("data_date", DateType()),
    StructField("data_time_block", StringType()), StructField("page_airport", StringType()),
    StructField("page_offset", IntegerType()), StructField("page_pos", IntegerType()),
    StructField("date", DateType()),
])


@dataclass
class GoldRun:
    status: str
    appended_hours: int = 0
    refreshed_hours: int = 0
    purged_partitions: int = 0


def goldenize(spark: SparkSession, flights: DataFrame, airports: DataFrame, gold_path: str,
              as_of: dt.date | str, refresh_days: int = 1, exact: bool = True,
              max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
              touched: list[dt.date | None] | None = None) -> GoldRun:
    """Incremental hourly statistics into a ``date``-partitioned table at ``gold_path``.

    Hours older than the refresh window that the table lacks are added (their
    dates are replaced by what they held and the new hours);
    the ``refresh_days`` days before ``as_of`` are replaced whole (only days
    that have flights); today and later are left for a later run.

    ``touched`` names the departure dates that changed since the last run
    (:func:`silverize_new_movements` returns them). Only these, the refresh
    window and the dates below ``as_of`` that earlier runs had to leave are
    then looked at, in the flights and in the table (also for rows without an
    hour); when both are partitioned by ``date``, no other partition is read. Without it, all
    dates are candidates. Dates that a run leaves (``as_of`` and later) are
    kept in the one-row-per-date table ``<gold_path>_pending`` until a run
    has written them; a run that fails before keeps them.
    """
    as_of_d = dt.date.fromisoformat(as_of) if isinstance(as_of, str) else as_of
    refresh_start = as_of_d - dt.timedelta(days=refresh_days)
    facts = G.flight_facts(flights).where(F.col("date") < F.lit(as_of_d))
    table = read_or_empty(spark, gold_path, S.GOLD_AIRPORT_HOURS)
    if touched is None:
        return _goldenize(spark, facts, table, airports, gold_path, as_of_d, refresh_days, exact, max_broadcast_rows)
    pending_path = gold_path.rstrip("/") + "_pending"
    # Bounded: one row per date.
    pending = {r[0] for r in read_or_empty(spark, pending_path, PENDING_DATES).collect()}
    known = pending | {d for d in touched if d is not None}
    if known != pending:
        overwrite_table(spark.createDataFrame([(d,) for d in sorted(known)], PENDING_DATES).coalesce(1),
                        pending_path, PENDING_DATES)
    asked = sorted(known | {refresh_start + dt.timedelta(days=k) for k in range(refresh_days)})
    facts, table = (t.where(among("date", asked)) for t in (facts, table))
    run = _goldenize(spark, facts, table, airports, gold_path, as_of_d, refresh_days, exact, max_broadcast_rows, asked)
    left = sorted(d for d in known if d >= as_of_d)
    if left != sorted(known):
        overwrite_table(spark.createDataFrame([(d,) for d in left], PENDING_DATES).coalesce(1), pending_path, PENDING_DATES)
    return run


#: Departure dates that silver has taken in and gold has not handled yet.
PENDING_DATES = StructType([StructField("date", DateType())])


def _goldenize(spark: SparkSession, facts: DataFrame, table: DataFrame, airports: DataFrame, gold_path: str,
               as_of_d: dt.date, refresh_days: int, exact: bool, max_broadcast_rows: int,
               asked: list[dt.date] | None = None) -> GoldRun:
    if facts.isEmpty():
        return GoldRun("no_flights")

    purged = purge_null_hour(spark, gold_path, S.GOLD_AIRPORT_HOURS, dates=asked)
    if purged:
        table = read_or_empty(spark, gold_path, S.GOLD_AIRPORT_HOURS)
        if asked is not None:
            table = table.where(among("date", asked))
    # The done set, the work set and the dimension are bounded (24 x days;
    # the reference list): one partition each.
    done = cut_lineage(G.done_hours(table), 1)
    done_rows = done.count()
    work = cut_lineage(G.work_set(facts, done, as_of_d, refresh_days,
                                  done_rows if done_rows <= max_broadcast_rows else None), 1)
    by_date = work.groupBy("refresh", "date").count().collect()  # bounded: one row per date
    older = {r["date"]: r["count"] for r in by_date if not r["refresh"]}
    recent = {r["date"]: r["count"] for r in by_date if r["refresh"]}
    if not by_date:
        return GoldRun("nothing_to_do", purged_partitions=purged)

    dim = cut_lineage(airports.select("airport_code", "longitude", "latitude"), 1)
    n_locations = dim.count()
    if not n_locations:
        # No location, no rows: a refreshed day has no replacement and is cleared.
        drop_partitions(spark, gold_path, "date", [str(d) for d in recent])
        return GoldRun("written", 0, 0, purged)

    def stats(part: dict) -> DataFrame:
        # Clustered by date as it leaves the statistics, so it is written as it comes.
        bounds = F.col("date").between(F.lit(min(part)), F.lit(max(part)))
        mine = work.where(F.col("refresh") == F.lit(part is recent))
        return G.hourly_stats(facts.where(bounds), dim, mine, n_locations, sum(part.values()), exact)

    if older:
        # Whole dates: a commit that breaks off leaves a date as it was or as it
        # will be, never an hour with part of its locations, which would count as done.
        kept = table.where(among("date", list(older)) & F.col("hour").isNotNull())
        rows = stats(older)
        if not kept.isEmpty():
            rows = rows.unionByName(cut_lineage(kept.select(rows.columns))).hint("rebalance", "date")
        replace_partitions(rows, gold_path, ["date"], S.GOLD_AIRPORT_HOURS)
    if recent:
        replace_partitions(stats(recent), gold_path, ["date"], S.GOLD_AIRPORT_HOURS)
    return GoldRun("written", sum(older.values()), sum(recent.values()), purged)


# ---------------------------------------------------------------- tables and landing
BRONZE_TABLES = {**{e.name: S.BRONZE_REFERENCE for e in S.REFERENCE_ENTITIES.values()},
                 S.FLIGHTS.name: S.BRONZE_FLIGHTS}
SILVER_TABLES = {**_SILVER_LAYOUTS, "flights": S.SILVER_FLIGHTS}
GOLD_TABLE = "airports_daily_stats"


def table_path(root: str, layer: str, name: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{name}"


def create_tables(spark: SparkSession, root: str, register_as: str | None = None) -> list[str]:
    """Create every bronze, silver and gold table folder under ``root`` if missing (idempotent).

    Creation is a metadata operation (no Spark job): tables are read with
    their declared layout (:func:`read_layer`), so an empty folder is an
    empty table. Bronze is partitioned by ``ingestion_date`` and gold by
    ``date``. With ``register_as`` (a database name) each table is also
    registered in the session catalog with ``CREATE TABLE IF NOT EXISTS ...
    LOCATION``.
    """
    from contrail.sources.tables import create_table_sql
    made = []
    specs = ([("bronze", n, s, ["ingestion_date"]) for n, s in BRONZE_TABLES.items()]
             + [("silver", n, s, None) for n, s in SILVER_TABLES.items()]
             + [("gold", GOLD_TABLE, S.GOLD_AIRPORT_HOURS, ["date"])])
    if register_as:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {register_as}")
    for layer, name, layout, parts in specs:
        path = table_path(root, layer, name)
        _mkdirs(spark, path)
        if register_as:
            spark.sql(create_table_sql(f"{register_as}.{layer}_{name}", layout, parts, path))
        made.append(path)
    return made


def sync_catalog(spark: SparkSession, database: str) -> None:
    """Make the tables registered by :func:`create_tables` show what was written to their folders.

    Partitions are matched to the folders (added and dropped), and cached
    file listings are renewed. Run it after the jobs that wrote.
    """
    partitioned = {f"bronze_{n}" for n in BRONZE_TABLES} | {f"gold_{GOLD_TABLE}"}
    for t in spark.catalog.listTables(database):
        name = f"{database}.{t.name}"
        if t.name in partitioned:
            spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
        spark.catalog.refreshTable(name)


def _mkdirs(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(p)


def land_reference(spark: SparkSession, pages: DataFrame, root: str,
                   run_date: dt.date | str, repeat: bool = False) -> list[str]:
    """Append reference pages ``(container, offset, raw_data)`` to their bronze tables.

    With ``repeat``, pages of the run date that have the same offset are
    replaced, so that a landing may be run again, whole or in part.

    One pass per entity over ``pages`` (cache it if it is expensive); an
    unknown container raises ``ValueError`` before anything is written.
    """
    from contrail.sources.pages import land_pages
    containers = [r[0] for r in pages.select("container").distinct().collect()]  # a handful
    for c in containers:
        S.entity_for_container(c)
    written = []
    for c in containers:
        e = S.entity_for_container(c)
        rows = land_pages(pages.where(F.col("container") == c), run_date)
        path = table_path(root, "bronze", e.name)
        if repeat:
            upsert_partitions(rows, path, "ingestion_date", ["offset"], S.BRONZE_REFERENCE)
        else:
            append_table(rows, path, S.BRONZE_REFERENCE, ["ingestion_date"])
        written.append(e.name)
    return sorted(written)


def land_departures(pages: DataFrame, root: str, run_date: dt.date | str, repeat: bool = False) -> None:
    """Append departure pages ``(airport_code, block, offset, raw_data)`` to bronze flights.

    With ``repeat``, pages of the run date with the same airport, block and
    offset are replaced.
    """
    from contrail.sources.pages import land_flight_pages
    rows, path = land_flight_pages(pages, run_date), table_path(root, "bronze", "flights")
    if repeat:
        upsert_partitions(rows, path, "ingestion_date", ["data_date", "data_time_block", "airport_code", "offset"], S.BRONZE_FLIGHTS)
    else:
        append_table(rows, path, S.BRONZE_FLIGHTS, ["ingestion_date"])


def read_layer(spark: SparkSession, root: str, layer: str, name: str) -> DataFrame:
    """A table created by :func:`create_tables`, read with its declared layout."""
    layouts = {"bronze": BRONZE_TABLES, "silver": SILVER_TABLES, "gold": {GOLD_TABLE: S.GOLD_AIRPORT_HOURS}}
    try:
        layout = layouts[layer][name]
    except KeyError:
        raise ValueError(f"no table {name!r} in layer {layer!r}") from None
    return read_or_empty(spark, table_path(root, layer, name), layout)
