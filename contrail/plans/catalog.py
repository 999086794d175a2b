"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query reads the driver's tables (or data Spark derives from them) in
full. Oracle SQL for DuckDB lives in :mod:`contrail.plans.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from contrail.operators import gold
from contrail.plans import standins as si
from contrail.session import cut_lineage

Query = Callable[[SparkSession, str], DataFrame]


# ---------------------------------------------------------------- gold chain
def _facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.flight_facts(si.event_departures(spark, sf_dir))


def _work(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, int]:
    facts = _facts(spark, sf_dir)
    done = si.first_hour_done_set(facts)
    work = cut_lineage(gold.work_set(facts, done, si.RUN_DATE, done_rows=1), 1)
    return facts, work, work.count()


def q_flight_facts(spark, sf_dir):
    return _facts(spark, sf_dir)


def q_delay_by_key_hour(spark, sf_dir):
    return gold.delay_by_key_hour(_facts(spark, sf_dir))


def q_work_set(spark, sf_dir):
    return _work(spark, sf_dir)[1]


def q_restrict_to_work_set(spark, sf_dir):
    facts, work, rows = _work(spark, sf_dir)
    return gold.restrict_to_work_set(facts, work, rows)


def q_dense_grid(spark, sf_dir):
    _, work, rows = _work(spark, sf_dir)
    dim = si.nation_locations(spark, sf_dir)
    return gold.dense_grid(dim, work, dim.count(), rows)


def q_hourly_stats(spark, sf_dir):
    facts, work, rows = _work(spark, sf_dir)
    dim = si.nation_locations(spark, sf_dir)
    return gold.hourly_stats(facts, dim, work, dim.count(), rows)


QUERIES: dict[str, Query] = {
    "flight_facts": q_flight_facts,
    "delay_by_key_hour": q_delay_by_key_hour,
    "work_set": q_work_set,
    "restrict_to_work_set": q_restrict_to_work_set,
    "dense_grid": q_dense_grid,
    "hourly_stats": q_hourly_stats,
}


# ---------------------------------------------------------------- silver
def _silver(name: str) -> Query:
    from contrail.operators.silver import silver_entity

    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return silver_entity(si.entity_bronze(spark, sf_dir, name), name)
    q.__name__ = f"q_silver_{name}"
    return q


QUERIES.update({
    "silver_locations": _silver("airports"),
    "silver_cities": _silver("cities"),
    "silver_countries": _silver("countries"),
    "silver_airlines": _silver("airlines"),
    "silver_aircraft": _silver("aircraft_summaries"),
})


# ---------------------------------------------------------------- pages and parsing
def q_silver_movements(spark, sf_dir):
    from contrail.operators.silver import silver_movements
    return silver_movements(si.flight_bronze(spark, sf_dir))


def q_flatten_nested(spark, sf_dir):
    from pyspark.sql import functions as F
    from contrail.operators.parse import parse_pages
    from contrail.schemas import FLIGHTS
    columns = {
        "Departure.AirportCode": "departure_airport_code",
        "Departure.Terminal.Name": "departure_terminal_name",
        "Departure.Terminal.Gate": "departure_terminal_gate",
        "Departure.TimeStatus.Code": "departure_time_status_code",
        "Arrival.AirportCode": "arrival_airport_code",
        "MarketingCarrier.FlightNumber": "marketing_carrier_flight_number",
        "Equipment.AircraftCode": "equipment_aircraft_code",
        "FlightStatus.Code": "flight_status_code"}
    items = parse_pages(si.flight_bronze(spark, sf_dir), FLIGHTS.only(*columns), keep=[])
    return items.select(*[F.col(f"item.{path}").alias(name) for path, name in columns.items()])


def _order_pages(spark, sf_dir):
    from contrail.schemas import COUNTRIES
    from contrail.plans.standins import country_item_json, reference_pages
    return reference_pages(country_item_json(si.read_table(spark, sf_dir, "orders")),
                           COUNTRIES, overlap=False)


def q_parse_pages(spark, sf_dir):
    from pyspark.sql import functions as F
    from contrail.operators.parse import name_of, parse_pages
    from contrail.schemas import COUNTRIES
    items = parse_pages(_order_pages(spark, sf_dir), COUNTRIES, keep=["offset"])
    return items.select(F.col("offset").cast("int").alias("offset"), "pos",
                        F.col("item.CountryCode").alias("country_code"),
                        name_of(F.col("item.Names.Name")).alias("name"))


def q_land_pages(spark, sf_dir):
    from pyspark.sql import functions as F
    from contrail.operators.parse import page_items, total_count
    from contrail.schemas import COUNTRIES
    from contrail.sources.pages import land_pages
    bronze = land_pages(_order_pages(spark, sf_dir), si.RUN_DATE)
    return bronze.select("ingestion_date", "data_date", "offset",
                         F.size(page_items("raw_data", COUNTRIES)).alias("items"),
                         total_count("raw_data", COUNTRIES).alias("total"))


def q_land_flight_pages(spark, sf_dir):
    from pyspark.sql import functions as F
    from contrail.functions.times import time_block_4h
    from contrail.operators.parse import page_items
    from contrail.schemas import FLIGHTS
    from contrail.sources.pages import land_flight_pages, pack_pages
    ev = si.read_table(spark, sf_dir, "events").select(
        "event_id", (F.col("event_id") % 30).cast("string").alias("airport_code"),
        time_block_4h("ts").alias("block"),
        (F.col("event_id") / 1500).cast("long").alias("chunk"))
    item = F.to_json(F.struct(F.struct(F.col("airport_code").alias("AirportCode"))
                              .alias("Departure")))
    pages = pack_pages(ev, FLIGHTS, ["airport_code", "block", "chunk"], F.col("event_id"), item)
    bronze = land_flight_pages(pages.withColumn("offset", F.col("chunk") * 50), si.RUN_DATE)
    return bronze.select("ingestion_date", "data_date", "data_time_block", "airport_code",
                         "offset", F.size(page_items("raw_data", FLIGHTS)).alias("items"))


def q_one_or_many(spark, sf_dir):
    from pyspark.sql import functions as F
    from contrail.operators.parse import name_of, parse_pages
    from contrail.schemas import AIRLINES
    from contrail.sources.pages import pack_pages
    cust = si.read_table(spark, sf_dir, "customer")
    items = si.airline_item_json(cust, keep=("c_mktsegment", "c_nationkey"))
    items = items.withColumn("page", (F.col("id") / 100).cast("long"))
    keys = ["c_mktsegment", "c_nationkey", "page"]
    pages = pack_pages(items, AIRLINES, keys, F.col("id"), F.col("item_json"))
    parsed = parse_pages(pages, AIRLINES, keep=keys + ["n_items"])
    return parsed.select(*keys, "pos", "n_items",
                         F.col("item.AirlineID").alias("airline_id"),
                         name_of(F.col("item.Names.Name")).alias("name"))


def q_parse_times(spark, sf_dir):
    from pyspark.sql import functions as F
    from contrail.functions.times import (
        format_local_time, format_utc_time, parse_local_time, parse_utc_time)
    ev = si.read_table(spark, sf_dir, "events")
    local_text = F.when(F.col("event_type") == "error", F.lit("garbage")).otherwise(
        format_local_time("ts"))
    utc_text = F.when(F.col("event_type") == "view",
                      F.concat(format_local_time("ts"), F.lit(":00Z"))).otherwise(
        format_utc_time("ts"))
    return ev.select("event_id", parse_local_time(local_text).alias("local_time"),
                     parse_utc_time(utc_text).alias("utc_time"))


def q_utc_offset_hours(spark, sf_dir):
    from pyspark.sql import functions as F
    from contrail.functions.offsets import utc_offset_hours
    cust = si.read_table(spark, sf_dir, "customer")
    text = si.offset_text(F.col("c_custkey"), F.col("c_nationkey"))
    return cust.select("c_custkey", utc_offset_hours(text).alias("utc_offset"))


def q_time_block_4h(spark, sf_dir):
    from contrail.functions.times import block_date, previous_day_block_4h, time_block_4h
    ev = si.read_table(spark, sf_dir, "events")
    return ev.select("event_id", time_block_4h("ts").alias("block"),
                     previous_day_block_4h("ts").alias("previous_block"),
                     block_date(time_block_4h("ts")).alias("block_date"))


def q_latest_snapshot(spark, sf_dir):
    from pyspark.sql import functions as F
    from contrail.operators.parse import name_of, parse_pages
    from contrail.operators.snapshot import latest_snapshot
    from contrail.schemas import AIRLINES
    items = parse_pages(latest_snapshot(si.event_bronze(spark, sf_dir)), AIRLINES,
                        keep=["ingestion_date", "offset"])
    return items.select("ingestion_date", "offset", "pos",
                        F.col("item.AirlineID").alias("airline_id"),
                        F.col("item.AirlineID_ICAO").alias("airline_id_icao"),
                        name_of(F.col("item.Names.Name")).alias("name"))


def q_dedupe_latest(spark, sf_dir):
    from contrail.operators.silver import silver_entity
    return silver_entity(si.event_bronze(spark, sf_dir), "airlines")


QUERIES.update({
    "silver_movements": q_silver_movements,
    "flatten_nested": q_flatten_nested,
    "parse_pages": q_parse_pages,
    "land_pages": q_land_pages,
    "land_flight_pages": q_land_flight_pages,
    "one_or_many": q_one_or_many,
    "parse_times": q_parse_times,
    "utc_offset_hours": q_utc_offset_hours,
    "time_block_4h": q_time_block_4h,
    "latest_snapshot": q_latest_snapshot,
    "dedupe_latest": q_dedupe_latest,
})


# ---------------------------------------------------------------- audits
def q_classify_pages(spark, sf_dir):
    from contrail.operators.audit import classify_pages
    from contrail.schemas import AIRLINES
    return classify_pages(si.event_responses(spark, sf_dir), AIRLINES).drop("raw_data")


def q_page_gaps(spark, sf_dir):
    from contrail.operators.audit import page_gaps
    from contrail.schemas import FLIGHTS
    return page_gaps(si.gapped_flight_pages(spark, sf_dir), FLIGHTS,
                     ["airport_code", "ingestion_date"], si.GAP_STEP)


def q_page_audit(spark, sf_dir):
    from contrail.operators.audit import page_audit
    from contrail.schemas import FLIGHTS
    return page_audit(si.gapped_flight_pages(spark, sf_dir), FLIGHTS,
                      ["airport_code", "ingestion_date"])


def q_request_plan(spark, sf_dir):
    from pyspark.sql import functions as F
    from contrail.functions.times import time_block_4h
    from contrail.operators.audit import request_plan
    from contrail.operators.silver import silver_entity
    codes = silver_entity(si.entity_bronze(spark, sf_dir, "airports"), "airports")
    day = F.date_sub(F.lit(si.RUN_DATE).cast("date"), 1)
    blocks = spark.range(6).select(F.concat(day.cast("string"), F.lit("T"),
                                            F.lpad((F.col("id") * 4).cast("string"), 2, "0"),
                                            F.lit(":00")).alias("block"))
    ev = si.read_table(spark, sf_dir, "events")
    landed = ev.select((F.col("event_id") % si.LOCATION_MODULUS).cast("string")
                       .alias("airport_code"), time_block_4h("ts").alias("block"))
    return request_plan(codes, blocks, landed, 6)


def q_latest_entity_codes(spark, sf_dir):
    from pyspark.sql import functions as F
    from contrail.operators.audit import first_seen_codes
    from contrail.operators.parse import parse_pages
    from contrail.operators.snapshot import latest_snapshot
    from contrail.schemas import AIRLINES
    from contrail.session import work_path
    from contrail.sources.pages import read_page_files, write_page_files
    root = work_path(spark, "page_files")
    pages = si.event_bronze(spark, sf_dir).select(
        F.lit("Airlines").alias("entity"), F.col("ingestion_date").alias("date"),
        "offset", "raw_data")
    write_page_files(pages, root, ["entity", "date"])
    landed = read_page_files(spark, root).where(F.col("entity") == "Airlines")
    items = parse_pages(latest_snapshot(landed, "date"), AIRLINES, keep=["offset"])
    return first_seen_codes(items, F.col("item.AirlineID"),
                            {"first_offset": F.col("offset"), "first_pos": F.col("pos")})


def q_page_files_roundtrip(spark, sf_dir):
    from pyspark.sql import functions as F
    from contrail.operators.parse import name_of, parse_pages
    from contrail.schemas import AIRPORTS, CITIES
    from contrail.session import work_path
    from contrail.sources.pages import read_page_files, write_page_files
    root = work_path(spark, "page_files")
    sup = si.read_table(spark, sf_dir, "supplier")
    cust = si.read_table(spark, sf_dir, "customer")
    pages = (si.reference_pages(si.airport_item_json(sup), AIRPORTS, overlap=False)
             .withColumn("entity", F.lit("Airports"))
             .unionByName(si.reference_pages(si.city_item_json(cust), CITIES, overlap=False)
                          .withColumn("entity", F.lit("Cities")))
             .withColumn("date", F.lit(si.RUN_DATE)))
    write_page_files(pages, root, ["entity", "date"])
    back = read_page_files(spark, root)
    a = parse_pages(back.where(F.col("entity") == "Airports"), AIRPORTS, keep=["entity", "date"])
    c = parse_pages(back.where(F.col("entity") == "Cities"), CITIES, keep=["entity", "date"])
    cols = ["entity", F.col("date").cast("date").alias("date")]
    return (a.select(*cols, F.col("item.AirportCode").alias("code"),
                     name_of(F.col("item.Names.Name")).alias("name"))
            .unionByName(c.select(*cols, F.col("item.CityCode").alias("code"),
                                  name_of(F.col("item.Names.Name")).alias("name"))))


QUERIES.update({
    "classify_pages": q_classify_pages,
    "page_gaps": q_page_gaps,
    "page_audit": q_page_audit,
    "request_plan": q_request_plan,
    "latest_entity_codes": q_latest_entity_codes,
    "page_files_roundtrip": q_page_files_roundtrip,
})


# ---------------------------------------------------------------- incremental gold through tables
FIRST_RUN_DATE = "2024-01-16"


def q_gold_append_then_refresh(spark, sf_dir):
    """Two runs into one table: as of the 16th with the flights known by then, then the 31st."""
    from pyspark.sql import functions as F
    from contrail.plans.jobs import goldenize
    from contrail.session import work_path
    path = work_path(spark, "gold")
    flights = si.event_departures(spark, sf_dir)
    dim = si.nation_locations(spark, sf_dir)
    known_then = flights.where(F.col("departure_scheduled_time_utc")
                               < F.lit(FIRST_RUN_DATE).cast("timestamp_ntz"))
    goldenize(spark, known_then, dim, path, FIRST_RUN_DATE)
    goldenize(spark, flights, dim, path, si.RUN_DATE)
    return spark.read.parquet(path).select(*gold.GOLD_COLUMNS)


def q_purge_null_hour(spark, sf_dir):
    """A table holding hourly rows plus legacy per-day rows (hour NULL), purged."""
    from pyspark.sql import functions as F
    from contrail import schemas as S
    from contrail.plans.sinks import append_table, purge_null_hour
    from contrail.session import work_path
    path = work_path(spark, "gold")
    facts = _facts(spark, sf_dir)
    work = cut_lineage(facts.select("date", "hour").distinct(), 1)
    dim = si.nation_locations(spark, sf_dir)
    append_table(gold.hourly_stats(facts, dim, work, dim.count(), work.count()), path,
                 S.GOLD_AIRPORT_HOURS, ["date"])
    daily = facts.groupBy("airport_code", "date").agg(F.count(F.lit(1)).alias("n"))
    legacy = daily.unionByName(daily.select("airport_code", F.date_sub("date", 1).alias("date"),
                                            "n")).distinct()
    append_table(legacy.select(
        "airport_code", F.lit(None).cast("double").alias("longitude"),
        F.lit(None).cast("double").alias("latitude"), F.col("n").cast("int").alias("total_departures"),
        F.lit(None).cast("double").alias("average_departure_delay_minutes"),
        F.lit(0).alias("delayed_flights"), F.lit(0.0).alias("delayed_flights_percentage"),
        "date", F.lit(None).cast("int").alias("hour")), path, S.GOLD_AIRPORT_HOURS, ["date"])
    purge_null_hour(spark, path, S.GOLD_AIRPORT_HOURS)
    return spark.read.parquet(path).select(*gold.GOLD_COLUMNS)


QUERIES.update({
    "gold_append_then_refresh": q_gold_append_then_refresh,
    "purge_null_hour": q_purge_null_hour,
})


# ---------------------------------------------------------------- end to end through tables
def q_medallion_airport_hours(spark, sf_dir):
    """Pages → bronze → silver → gold through real tables.

    Airports pages from ``supplier`` (old and latest snapshot, overlapping
    pages), departure pages from ``lineitem`` ⋈ ``orders``; one gold run.
    """
    from pyspark.sql import functions as F
    from contrail import schemas as S
    from contrail.plans import jobs
    from contrail.session import work_path
    root = work_path(spark, "lake")
    jobs.create_tables(spark, root)
    sup = si.read_table(spark, sf_dir, "supplier")
    old = si.reference_pages(si.airport_item_json(sup, old=True), S.AIRPORTS, overlap=False)
    new = si.reference_pages(si.airport_item_json(sup), S.AIRPORTS)
    jobs.land_reference(spark, old.withColumn("container", F.lit("Airports")), root,
                        si.OLD_SNAPSHOT_DATE)
    jobs.land_reference(spark, new.withColumn("container", F.lit("Airports")), root, si.RUN_DATE)
    jobs.land_departures(si.flight_pages(spark, sf_dir), root, si.RUN_DATE)

    def t(layer, name):
        return jobs.table_path(root, layer, name)
    jobs.silverize_entity(jobs.read_layer(spark, root, "bronze", "airports"), "airports",
                          t("silver", "airports"))
    jobs.silverize_movements(jobs.read_layer(spark, root, "bronze", "flights"),
                             t("silver", "flights"))
    jobs.goldenize(spark, jobs.read_layer(spark, root, "silver", "flights"),
                   jobs.read_layer(spark, root, "silver", "airports"),
                   t("gold", "airports_daily_stats"), si.RUN_DATE)
    return jobs.read_layer(spark, root, "gold", "airports_daily_stats").select(*gold.GOLD_COLUMNS)


QUERIES["medallion_airport_hours"] = q_medallion_airport_hours


def q_silver_entity(spark, sf_dir):
    """The generic mapper in its four non-airport configurations, as (entity, key, name)."""
    from pyspark.sql import functions as F
    from contrail.operators.silver import SPECS, silver_entity
    out = None
    for name in ("cities", "countries", "airlines", "aircraft_summaries"):
        rows = silver_entity(si.entity_bronze(spark, sf_dir, name), name).select(
            F.lit(name).alias("entity"), F.col(SPECS[name].key).alias("key"), "name")
        out = rows if out is None else out.unionByName(rows)
    return out


QUERIES["silver_entity"] = q_silver_entity


def q_silver_movements_incremental(spark, sf_dir):
    """Flights after merging bronze in two runs that touch the same dates."""
    from pyspark.sql import functions as F
    from contrail import schemas as S
    from contrail.plans import jobs
    from contrail.session import drop_folder, stage, work_path
    path, landing = work_path(spark, "silver", "flights"), work_path(spark, "bronze")
    bronze = stage(si.flight_bronze(spark, sf_dir), landing, "flights", "zstd")
    late = F.crc32(F.col("raw_data").cast("binary")) % 2 == 0
    for part in (bronze.where(~late), bronze.where(late)):
        jobs.silverize_new_movements(part, path)
    drop_folder(spark, landing)
    return spark.read.schema(jobs.MOVEMENTS_BY_DATE).parquet(path).select(S.SILVER_FLIGHTS.fieldNames())


QUERIES["silver_movements_incremental"] = q_silver_movements_incremental


def q_catalog_tables(spark, sf_dir):
    """Countries landed twice, refreshed to silver, and read by table name throughout."""
    from pyspark.sql import functions as F
    from contrail import schemas as S
    from contrail.plans import jobs
    from contrail.session import work_path
    database, root = "contrail_catalog", work_path(spark, "lake")
    spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")
    jobs.create_tables(spark, root, register_as=database)
    orders = si.read_table(spark, sf_dir, "orders")
    for run_date, old in ((si.OLD_SNAPSHOT_DATE, True), (si.RUN_DATE, False)):
        pages = si.reference_pages(si.country_item_json(orders, old=old), S.COUNTRIES, overlap=not old)
        jobs.land_reference(spark, pages.withColumn("container", F.lit("Countries")), root, run_date)
        jobs.sync_catalog(spark, database)
        jobs.silverize_entity(spark.table(f"{database}.bronze_countries"), "countries",
                              jobs.table_path(root, "silver", "countries"))
        jobs.sync_catalog(spark, database)
    return spark.table(f"{database}.silver_countries")


QUERIES["catalog_tables"] = q_catalog_tables


def q_quarantine_pages(spark, sf_dir):
    """Responses that do not parse, stored by the silver job's quarantine and read back."""
    from pyspark.sql import functions as F
    from contrail.plans import jobs
    from contrail.schemas import AIRLINES
    from contrail.session import work_path
    path = work_path(spark, "quarantine", "airlines")
    pages = si.event_responses(spark, sf_dir).withColumn("ingestion_date", F.lit(si.RUN_DATE).cast("date"))
    jobs.quarantine_pages(pages, AIRLINES.name, path)
    return spark.read.parquet(path).select("event_id", "status", "detail")


QUERIES["quarantine_pages"] = q_quarantine_pages


def q_gold_from_dated_flights(spark, sf_dir):
    """Two landings merged into the flight table by date, each followed by gold over the touched dates.

    The first knows the pages of the blocks before the 16th but for the late
    ones; the second brings those and the later blocks.
    """
    from pyspark.sql import functions as F
    from contrail.plans import jobs
    from contrail.session import work_path
    from contrail.sources.pages import land_flight_pages
    silver, target = work_path(spark, "silver"), work_path(spark, "gold")
    pages = si.event_flight_pages(spark, sf_dir)
    first = ~F.col("late") & (F.col("block") < FIRST_RUN_DATE)
    dim = si.nation_locations(spark, sf_dir)
    for run_date, part in ((FIRST_RUN_DATE, pages.where(first)), (si.RUN_DATE, pages.where(~first))):
        touched = jobs.silverize_new_movements(land_flight_pages(part, run_date), silver)
        flights = spark.read.schema(jobs.MOVEMENTS_BY_DATE).parquet(silver)
        jobs.goldenize(spark, flights, dim, target, run_date, touched=touched)
    return spark.read.parquet(target).select(*gold.GOLD_COLUMNS)


def q_gold_refresh_empty(spark, sf_dir):
    """Gold built, then run again with no location left: the refreshed day is cleared."""
    from contrail.plans.jobs import goldenize
    from contrail.session import work_path
    path = work_path(spark, "gold")
    flights = si.event_departures(spark, sf_dir)
    dim = si.nation_locations(spark, sf_dir)
    goldenize(spark, flights, dim, path, si.RUN_DATE)
    goldenize(spark, flights, dim.where("airport_code IS NULL"), path, si.RUN_DATE)
    return spark.read.parquet(path).select(*gold.GOLD_COLUMNS)


def q_silver_movements_dedupe(spark, sf_dir):
    """All departure pages landed on two days with different gates; the newest landing wins.

    Flights without a number identify nothing: both of their rows stay.
    """
    from contrail.operators.silver import FLIGHT_KEY, silver_movements
    from contrail.sources.pages import land_flight_pages
    old = land_flight_pages(si.event_flight_pages(spark, sf_dir, "old"), si.OLD_SNAPSHOT_DATE)
    new = land_flight_pages(si.event_flight_pages(spark, sf_dir, "new"), si.RUN_DATE)
    return silver_movements(new.unionByName(old), dedupe=True).select(*FLIGHT_KEY, "departure_terminal_gate")


def q_dedupe_relanded(spark, sf_dir):
    """The same offsets landed twice on one day with different content, in both input orders."""
    from pyspark.sql import functions as F
    from contrail.operators.silver import silver_entity
    from contrail.schemas import AIRLINES
    from contrail.sources.pages import land_pages
    cust = si.read_table(spark, sf_dir, "customer")
    a, b = (land_pages(si.reference_pages(si.airline_item_json(cust, old=old), AIRLINES), si.RUN_DATE)
            for old in (True, False))
    return (silver_entity(si.landed(a.unionByName(b)), "airlines").withColumn("input_order", F.lit("ab"))
            .unionByName(silver_entity(si.landed(b.unionByName(a)), "airlines").withColumn("input_order", F.lit("ba"))))


def q_flight_files_roundtrip(spark, sf_dir):
    """Departure pages as files by date and hour, read back and landed with airport, block and offset."""
    from pyspark.sql import functions as F
    from contrail.functions.times import block_date, block_hour_text
    from contrail.operators.parse import page_items
    from contrail.schemas import FLIGHTS
    from contrail.session import work_path
    from contrail.sources.pages import (
        FLIGHT_PAGE_FILE_SCHEMA, land_flight_pages, read_page_files, write_page_files)
    root = work_path(spark, "page_files")
    pages = si.event_flight_pages(spark, sf_dir).select(
        "airport_code", "block", "offset", "raw_data", block_date("block").alias("date"),
        block_hour_text("block").alias("hour"))
    write_page_files(pages.hint("rebalance", "date", "hour"), root, ["date", "hour"])
    bronze = land_flight_pages(read_page_files(spark, root, FLIGHT_PAGE_FILE_SCHEMA), si.RUN_DATE)
    items = F.size(page_items("raw_data", FLIGHTS))
    return bronze.groupBy("ingestion_date", "data_date", "data_time_block", "airport_code", "offset").agg(
        F.sum(items).cast("int").alias("items"))


QUERIES.update({
    "gold_from_dated_flights": q_gold_from_dated_flights,
    "gold_refresh_empty": q_gold_refresh_empty,
    "silver_movements_dedupe": q_silver_movements_dedupe,
    "dedupe_relanded": q_dedupe_relanded,
    "flight_files_roundtrip": q_flight_files_roundtrip,
})


def q_flight_facts_nulls(spark, sf_dir):
    """Facts of flights of which some lack the location and some both local times."""
    from pyspark.sql import functions as F
    code = F.col("departure_airport_code")
    flights = si.event_departures(spark, sf_dir).withColumns({
        **{f"departure_{kind}_time_local": F.when(code != "8", F.col(f"departure_{kind}_time_local"))
           for kind in ("scheduled", "actual")},
        "departure_airport_code": F.when(code != "7", code)})
    return gold.flight_facts(flights)


def q_work_set_mid_month(spark, sf_dir):
    """The work set as of the 16th, with flights on that day and after it."""
    facts = _facts(spark, sf_dir)
    return gold.work_set(facts, si.first_hour_done_set(facts), FIRST_RUN_DATE, done_rows=1)


def q_silver_null_keys(spark, sf_dir):
    """Airlines of which every fifth has no id: these are dropped."""
    from pyspark.sql import functions as F
    from contrail.operators.silver import silver_entity
    from contrail.schemas import AIRLINES
    from contrail.sources.pages import land_pages
    items = si.airline_item_json(si.read_table(spark, sf_dir, "customer"))
    without = F.regexp_replace("item_json", r'"AirlineID":"[^"]*",', "")
    items = items.withColumn("item_json", F.when(F.col("id") % 5 == 0, without).otherwise(F.col("item_json")))
    return silver_entity(si.landed(land_pages(si.reference_pages(items, AIRLINES), si.RUN_DATE)), "airlines")


QUERIES.update({
    "flight_facts_nulls": q_flight_facts_nulls,
    "work_set_mid_month": q_work_set_mid_month,
    "silver_null_keys": q_silver_null_keys,
})


# ---------------------------------------------------------------- flights merged through an index
def q_silver_movements_indexed(spark, sf_dir):
    """All flights after two landings merged through the key-to-date index.

    The first brings the pages of odd orders, and those divisible by three
    before their flights departed (on the scheduled date, without a gate); the
    second the even ones and, again, those divisible by three, whose flights
    move to their actual date.
    """
    from pyspark.sql import functions as F
    from contrail import schemas as S
    from contrail.plans.flight_merge import merge_flights, read_flights
    from contrail.session import work_path
    from contrail.sources.pages import land_flight_pages
    root = work_path(spark, "flights")
    pages, planned = si.flight_pages(spark, sf_dir), si.flight_pages(spark, sf_dir, departed=False)
    third, even = F.col("o_orderkey") % 3 == 0, F.col("o_orderkey") % 2 == 0
    first = pages.where(~third & ~even).unionByName(planned.where(third))
    merge_flights(land_flight_pages(first, si.OLD_SNAPSHOT_DATE), root, "first")
    merge_flights(land_flight_pages(pages.where(third | even), si.RUN_DATE), root, "second")
    return read_flights(spark, root).select(*S.SILVER_FLIGHTS.fieldNames(), "date")


def q_gold_late_corrections(spark, sf_dir):
    """Hourly statistics from the signed changes of three landings, the sums compacted after the second.

    Landed: the flights of blocks before the 16th but the late ones, all with
    estimated times; the late and later ones, every third with an estimate;
    and the corrections of all estimates. Flights without a number come once,
    with their times.
    """
    from pyspark.sql import functions as F
    from contrail.plans import hourly_state
    from contrail.plans.flight_merge import merge_flights
    from contrail.session import work_path
    from contrail.sources.pages import land_flight_pages
    root = work_path(spark, "flights")
    numbered, third = F.col("event_type") != "signup", F.col("event_id") % 3 == 0
    first = ~F.col("late") & (F.col("block") < FIRST_RUN_DATE)
    early = (~((F.hour("ts") % 6) == 5)) & (F.col("ts") < F.lit(FIRST_RUN_DATE).cast("timestamp_ntz"))
    merge_flights(land_flight_pages(si.event_flight_pages(spark, sf_dir, estimate=numbered).where(first), "2024-01-16"),
                  root, "early")
    merge_flights(land_flight_pages(si.event_flight_pages(spark, sf_dir, estimate=numbered & third).where(~first), "2024-01-31"),
                  root, "late")
    hourly_state.compact(spark, root)
    corrected = si.event_flight_pages(spark, sf_dir, where=numbered & (early | third))
    merge_flights(land_flight_pages(corrected, "2024-02-01"), root, "corrections")
    return hourly_state.stats_from_state(hourly_state.read_state(spark, root), si.nation_locations(spark, sf_dir), si.RUN_DATE)


QUERIES.update({
    "silver_movements_indexed": q_silver_movements_indexed,
    "gold_late_corrections": q_gold_late_corrections,
})


# ---------------------------------------------------------------- audits from what was landed
def _thinned_pages(spark, sf_dir):
    """The gapped pages without every fourth group of three pages, so that gaps of several pages arise."""
    from pyspark.sql import functions as F
    pages = si.gapped_flight_pages(spark, sf_dir)
    return pages.where((F.col("offset") / (3 * si.GAP_STEP)).cast("long") % 4 != 2)


def q_page_gap_ranges(spark, sf_dir):
    """Missing offsets as ranges; every fifth page is landed twice."""
    from pyspark.sql import functions as F
    from contrail.operators.audit import page_gap_ranges
    from contrail.schemas import FLIGHTS
    pages = _thinned_pages(spark, sf_dir)
    again = pages.where(F.col("offset") % (5 * si.GAP_STEP) == 0)
    return page_gap_ranges(si.landed(pages.unionByName(again)), FLIGHTS, ["airport_code", "ingestion_date"], si.GAP_STEP)


def q_page_audit_relanded(spark, sf_dir):
    """The audit of pages of which every fifth is landed twice."""
    from pyspark.sql import functions as F
    from contrail.operators.audit import page_audit
    from contrail.schemas import FLIGHTS
    pages = si.gapped_flight_pages(spark, sf_dir)
    again = pages.where(F.col("offset") % (5 * si.GAP_STEP) == 0)
    return page_audit(pages.unionByName(again), FLIGHTS, ["airport_code", "ingestion_date"])


def q_page_audit_distinct(spark, sf_dir):
    """Distinct events per type over all days: pages landed daily, with the last page of the day before again.

    Bitmaps are built per type and day, then merged per type; every third
    event of a type is on no page.
    """
    from pyspark.sql import functions as F
    from contrail.operators.audit import announced_totals, item_key_bitmaps, page_audit_distinct
    from contrail.schemas import AIRLINES
    pages = si.event_type_pages(spark, sf_dir)
    bitmaps = item_key_bitmaps(pages, AIRLINES, ["event_type", "ingestion_date"], F.col("item.AirlineID").try_cast("long"))
    return page_audit_distinct(bitmaps, announced_totals(pages, AIRLINES, ["event_type"]), ["event_type"])


QUERIES.update({
    "page_gap_ranges": q_page_gap_ranges,
    "page_audit_relanded": q_page_audit_relanded,
    "page_audit_distinct": q_page_audit_distinct,
})


# ---------------------------------------------------------------- one document per file
def q_page_documents_latest(spark, sf_dir):
    """City codes with the document and place that first hold them, from the newest folder of documents.

    Documents are numbered by page, so that names order 10 before 9; the last
    page's has no number. An older date and a folder without a date lie beside.
    """
    from pyspark.sql import functions as F
    from contrail.operators.audit import first_seen_codes
    from contrail.operators.parse import parse_pages
    from contrail.schemas import CITIES
    from contrail.session import work_path
    from contrail.sources import documents as D
    root = work_path(spark, "documents")
    cust = si.read_table(spark, sf_dir, "customer")
    page = (F.col("offset") / si.REFERENCE_PAGE_SIZE).cast("long")
    new = si.landed(si.reference_pages(si.city_item_json(cust), CITIES))
    old = si.reference_pages(si.city_item_json(cust, old=True), CITIES, overlap=False)
    last = new.agg(F.max("offset")).scalar()
    number = F.when(F.col("offset") == last, F.lit("last")).otherwise(page.cast("string"))
    container = F.lit("Cities")
    for pages, date in ((old, si.OLD_SNAPSHOT_DATE), (old, "unsorted"), (new, si.RUN_DATE)):
        D.write_documents(pages, root, D.reference_document(container, F.lit(date), number if pages is new else page))
    items = parse_pages(D.read_newest_documents(spark, root, "Cities"), CITIES, keep=["date", "number", "file_name"])
    return first_seen_codes(items, F.col("item.CityCode"), {**D.document_order(), "pos": F.col("pos"), "date": F.col("date")})


def q_flight_documents(spark, sf_dir):
    """Departure pages as documents by date and hour, of which one day's are read back and landed."""
    from pyspark.sql import functions as F
    from contrail.functions.times import block_date, block_hour_text, time_block_4h
    from contrail.operators.parse import page_items
    from contrail.schemas import FLIGHTS
    from contrail.session import work_path
    from contrail.sources import documents as D
    from contrail.sources.pages import land_flight_pages, pack_pages
    root = work_path(spark, "documents")
    ev = si.read_table(spark, sf_dir, "events").select(
        "event_id", (F.col("event_id") % 3).cast("string").alias("airport_code"), time_block_4h("ts").alias("block"))
    item = F.to_json(F.struct(F.struct(F.col("airport_code").alias("AirportCode")).alias("Departure")))
    pages = pack_pages(ev, FLIGHTS, ["airport_code", "block"], F.col("event_id"), item).withColumn("offset", F.lit(50))
    D.write_documents(pages, root, D.flight_document(F.col("airport_code"), block_date("block"), block_hour_text("block"),
                                                     F.col("offset")))
    day = D.newest_date(spark, f"{root}/Flights")
    landed = land_flight_pages(D.read_flight_documents(spark, root, day), si.RUN_DATE)
    return landed.select("data_date", "data_time_block", "airport_code", "offset",
                         F.size(page_items("raw_data", FLIGHTS)).alias("items"))


QUERIES.update({
    "page_documents_latest": q_page_documents_latest,
    "flight_documents": q_flight_documents,
})


# ---------------------------------------------------------------- streaming
def q_stream_hourly_stats(spark, sf_dir):
    """Hours closed by a stream with a watermark of two days, run after each of two landings.

    The second brings the pages from the 16th on and, again, those of the 14th
    and 15th (counted in state) and of the 5th (behind the watermark).
    """
    from pyspark.sql import functions as F
    from contrail.session import work_path
    from contrail.sources.pages import land_flight_pages
    from contrail.streaming.hourly import HOURS, hourly_stats_stream
    bronze, out, checkpoint = (work_path(spark, "stream", x) for x in ("bronze", "hours", "checkpoint"))
    pages = si.landed(si.event_flight_pages(spark, sf_dir))
    day = F.substring("block", 1, 10)
    again = day.isin("2024-01-05", "2024-01-14", "2024-01-15")
    for run_date, part in ((FIRST_RUN_DATE, day < FIRST_RUN_DATE), (si.RUN_DATE, (day >= FIRST_RUN_DATE) | again)):
        (land_flight_pages(pages.where(part), run_date).write.mode("append").partitionBy("ingestion_date").parquet(bronze))
        hourly_stats_stream(spark, bronze, out, checkpoint).awaitTermination()
    return spark.read.schema(HOURS).parquet(out)


QUERIES["stream_hourly_stats"] = q_stream_hourly_stats


# ---------------------------------------------------------------- drift, history, fingerprints, survivorship
def q_schema_drift(spark, sf_dir):
    """Members of items that are unknown, missing or of another type, per ingestion date."""
    from contrail.operators.drift import schema_drift
    from contrail.schemas import AIRLINES
    return schema_drift(si.drifting_pages(spark, sf_dir), AIRLINES, ["ingestion_date"])


def q_silver_entity_history(spark, sf_dir):
    """Airlines over four snapshots as periods."""
    from contrail.operators.history import entity_snapshots, snapshot_history
    bronze = si.airline_snapshots(spark, sf_dir)
    return snapshot_history(entity_snapshots(bronze, "airlines"), bronze.select("ingestion_date"), "airline_id")


def q_silver_refresh_skips(spark, sf_dir):
    """Four refreshes of countries: first, the same pages in another order and cut, one name changed, and that again."""
    from pyspark.sql import functions as F
    from contrail.plans.fingerprint import REFRESHES, refresh_entity
    from contrail.schemas import COUNTRIES
    from contrail.session import work_path
    from contrail.sources.pages import land_pages
    path = work_path(spark, "silver", "countries")
    items = si.country_item_json(si.read_table(spark, sf_dir, "orders"))
    last = items.agg(F.max("id")).scalar()
    changed = items.withColumn("item_json", F.when(F.col("id") == last, F.regexp_replace("item_json", r'"\}\}\}$', '."}}}'))
                               .otherwise(F.col("item_json")))
    steps = [si.reference_pages(items, COUNTRIES), si.reference_pages(items.withColumn("id", -F.col("id")), COUNTRIES, 30, overlap=False),
             si.reference_pages(changed, COUNTRIES), si.reference_pages(changed, COUNTRIES, 70)]
    report = []
    for k, pages in enumerate(steps, 1):
        status = refresh_entity(si.landed(land_pages(pages, si.RUN_DATE)), "countries", path)
        report.append((k, status, spark.read.parquet(path).count()))
    return spark.createDataFrame(report, REFRESHES)


def q_movements_survivorship(spark, sf_dir):
    """Flights landed twice, the newer pages without a gate for odd events: each column's newest value and its landing."""
    from pyspark.sql import functions as F
    from contrail.operators.history import survivors
    from contrail.operators.silver import FLIGHT_KEY, movement_rows
    from contrail.sources.pages import land_flight_pages
    old = land_flight_pages(si.event_flight_pages(spark, sf_dir, "old"), si.OLD_SNAPSHOT_DATE)
    new = land_flight_pages(si.event_flight_pages(spark, sf_dir, "new"), si.RUN_DATE)
    rows = movement_rows(old.unionByName(new)).select(
        *FLIGHT_KEY, "departure_terminal_gate", "departure_actual_time_local", "ingestion_date", "page_offset", "page_pos")
    number, landed = F.col("marketing_carrier_flight_number").cast("long"), F.col("ingestion_date") == F.lit(si.RUN_DATE).cast("date")
    rows = rows.withColumns({
        "departure_terminal_gate": F.when(~(landed & (number % 2 == 1)), F.col("departure_terminal_gate")),
        "departure_actual_time_local": F.when(~(landed & (number % 3 == 1)), F.col("departure_actual_time_local"))})
    won = survivors(rows, FLIGHT_KEY, [-F.unix_date("ingestion_date")], ["ingestion_date", "page_offset", "page_pos"])
    return won.select(*FLIGHT_KEY, "departure_terminal_gate", "departure_actual_time_local",
                      F.col("departure_terminal_gate_from.ingestion_date").alias("gate_landed"),
                      F.col("departure_actual_time_local_from.ingestion_date").alias("time_landed"),
                      F.col("departure_terminal_gate_from.page_offset").alias("gate_offset"))


QUERIES.update({
    "schema_drift": q_schema_drift,
    "silver_entity_history": q_silver_entity_history,
    "silver_refresh_skips": q_silver_refresh_skips,
    "movements_survivorship": q_movements_survivorship,
})


def q_gold_frozen_hours(spark, sf_dir):
    """Two runs, the second with flights that came late for hours which the first had written: these stay frozen.

    Late are the flights of the last twenty minutes of an hour, and those of
    the hours 5, 11, 17 and 23, which the first run therefore lacks whole.
    """
    from pyspark.sql import functions as F
    from contrail.plans.jobs import goldenize
    from contrail.session import work_path
    path = work_path(spark, "gold")
    flights, dim = si.event_departures(spark, sf_dir), si.nation_locations(spark, sf_dir)
    local = F.coalesce("departure_actual_time_local", "departure_scheduled_time_local")
    on_time = (F.minute(local) < 40) & (F.hour(local) % 6 != 5) & (local < F.lit(FIRST_RUN_DATE).cast("timestamp_ntz"))
    goldenize(spark, flights.where(on_time), dim, path, FIRST_RUN_DATE)
    goldenize(spark, flights, dim, path, si.RUN_DATE)
    return spark.read.parquet(path).select(*gold.GOLD_COLUMNS)


QUERIES["gold_frozen_hours"] = q_gold_frozen_hours


def q_land_pages_repeated(spark, sf_dir):
    """Country pages landed on two dates; the second date's landing breaks off half way and is run again, with newer names."""
    from pyspark.sql import functions as F
    from contrail.operators.parse import name_of, parse_pages
    from contrail import schemas as S
    from contrail.plans import jobs
    from contrail.session import work_path
    root = work_path(spark, "lake")
    orders = si.read_table(spark, sf_dir, "orders")
    old, new = (si.landed(si.reference_pages(si.country_item_json(orders, old=x), S.COUNTRIES, overlap=False)
                          .withColumn("container", F.lit("Countries"))) for x in (True, False))
    for pages, date in ((old, si.OLD_SNAPSHOT_DATE), (old.where("offset % 200 = 0"), si.RUN_DATE), (new, si.RUN_DATE)):
        jobs.land_reference(spark, pages, root, date, repeat=True)
    items = parse_pages(jobs.read_layer(spark, root, "bronze", "countries"), S.COUNTRIES, keep=["ingestion_date", "offset"])
    return items.select("ingestion_date", "offset", "pos", F.col("item.CountryCode").alias("country_code"),
                        name_of(F.col("item.Names.Name")).alias("name"))


QUERIES["land_pages_repeated"] = q_land_pages_repeated
