"""Typed entity tables from landed pages (the silver layer).

Reference entities (airports, cities, countries, airlines, aircraft) share
one operator, :func:`silver_entity`, configured by :class:`SilverSpec`:
newest snapshot → parse → project → key not NULL → extra filter →
deterministic dedupe on the key (first by page offset, then position).
Departures (:func:`silver_movements`) read every landed page, parse the
eight time columns and are not deduplicated unless asked.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.functions.offsets import utc_offset_hours
from contrail.functions.times import parse_local_time, parse_utc_time
from contrail.operators.parse import name_of, parse_pages, to_double
from contrail.operators.snapshot import dedupe_first, latest_snapshot
from contrail import schemas as S


@dataclass(frozen=True)
class SilverSpec:
    entity: S.Entity
    key: str
    project: Callable[[Column], list[Column]]
    keep: Callable[[], Column] | None = None


def _airport(i: Column) -> list[Column]:
    return [
        i["AirportCode"].alias("airport_code"),
        to_double(i["Position"]["Coordinate"]["Longitude"]).alias("longitude"),
        to_double(i["Position"]["Coordinate"]["Latitude"]).alias("latitude"),
        i["CityCode"].alias("city_code"),
        i["CountryCode"].alias("country_code"),
        i["LocationType"].alias("location_type"),
        name_of(i["Names"]["Name"]).alias("name"),
        utc_offset_hours(i["UtcOffset"]).alias("utc_offset"),
        i["TimeZoneId"].alias("time_zone_id"),
    ]


def _city(i: Column) -> list[Column]:
    return [
        i["CityCode"].alias("city_code"), i["CountryCode"].alias("country_code"),
        name_of(i["Names"]["Name"]).alias("name"),
        utc_offset_hours(i["UtcOffset"]).alias("utc_offset"),
        i["TimeZoneId"].alias("time_zone_id"),
    ]


def _country(i: Column) -> list[Column]:
    return [i["CountryCode"].alias("country_code"), name_of(i["Names"]["Name"]).alias("name")]


def _airline(i: Column) -> list[Column]:
    return [i["AirlineID"].alias("airline_id"), i["AirlineID_ICAO"].alias("airline_id_icao"),
            name_of(i["Names"]["Name"]).alias("name")]


def _aircraft(i: Column) -> list[Column]:
    return [i["AircraftCode"].alias("aircraft_code"), name_of(i["Names"]["Name"]).alias("name"),
            i["AirlineEquipCode"].alias("airline_equip_code")]


# Only locations of this type are kept as airports.
AIRPORT_LOCATION_TYPE = "Airport"

SPECS: dict[str, SilverSpec] = {
    "airports": SilverSpec(S.AIRPORTS, "airport_code", _airport,
                           lambda: F.col("location_type") == AIRPORT_LOCATION_TYPE),
    "cities": SilverSpec(S.CITIES, "city_code", _city),
    "countries": SilverSpec(S.COUNTRIES, "country_code", _country),
    "airlines": SilverSpec(S.AIRLINES, "airline_id", _airline),
    "aircraft_summaries": SilverSpec(S.AIRCRAFT, "aircraft_code", _aircraft),
}


def silver_entity(bronze: DataFrame, spec: SilverSpec | str, latest: bool = True,
                  dedupe: bool = True) -> DataFrame:
    """Typed rows of one reference entity from its bronze pages."""
    spec = SPECS[spec] if isinstance(spec, str) else spec
    src = latest_snapshot(bronze) if latest else bronze
    items = parse_pages(src.select("raw_data", "offset"), spec.entity, keep=["offset"])
    rows = items.select("offset", "pos", *spec.project(F.col("item")))
    rows = rows.where(F.col(spec.key).isNotNull())
    if spec.keep is not None:
        rows = rows.where(spec.keep())
    if dedupe:
        rows = dedupe_first(rows, [spec.key], [F.col("offset"), F.col("pos")])
    out_cols = [c for c in rows.columns if c not in ("offset", "pos")]
    return rows.select(*out_cols)


def _leg(name: str, prefix: str) -> dict[str, tuple[str, Callable[[Column], Column] | None]]:
    return {f"{prefix}_{column}": (f"{name}.{member}", convert) for column, member, convert in (
        ("airport_code", "AirportCode", None),
        ("scheduled_time_local", "ScheduledTimeLocal.DateTime", parse_local_time),
        ("scheduled_time_utc", "ScheduledTimeUTC.DateTime", parse_utc_time),
        ("actual_time_local", "ActualTimeLocal.DateTime", parse_local_time),
        ("actual_time_utc", "ActualTimeUTC.DateTime", parse_utc_time),
        ("time_status_code", "TimeStatus.Code", None),
        ("time_status_definition", "TimeStatus.Definition", None),
        ("terminal_name", "Terminal.Name", None),
        ("terminal_gate", "Terminal.Gate", None))}


#: The 27 flat departure/arrival columns of a flight: the member of its item and how that is read.
MOVEMENT_MEMBERS = {
    **_leg("Departure", "departure"), **_leg("Arrival", "arrival"),
    "marketing_carrier_airline_id": ("MarketingCarrier.AirlineID", None),
    "marketing_carrier_flight_number": ("MarketingCarrier.FlightNumber", None),
    "operating_carrier_airline_id": ("OperatingCarrier.AirlineID", None),
    "operating_carrier_flight_number": ("OperatingCarrier.FlightNumber", None),
    "equipment_aircraft_code": ("Equipment.AircraftCode", None),
    "equipment_aircraft_registration": ("Equipment.AircraftRegistration", None),
    "flight_status_code": ("FlightStatus.Code", None),
    "flight_status_definition": ("FlightStatus.Definition", None),
    "service_type": ("ServiceType", None),
}
#: What tells the departure date of a flight.
DEPARTURE_LOCAL = ["departure_actual_time_local", "departure_scheduled_time_local"]


def movement_columns(i: Column, columns: list[str] | None = None) -> list[Column]:
    """The flat departure/arrival columns of one flight item (all 27, or only ``columns``)."""
    flat = []
    for name in MOVEMENT_MEMBERS if columns is None else columns:
        member, convert = MOVEMENT_MEMBERS[name]
        value = reduce(lambda c, key: c[key], member.split("."), i)
        flat.append((convert(value) if convert else value).alias(name))
    return flat


FLIGHT_KEY = ["marketing_carrier_airline_id", "marketing_carrier_flight_number",
              "departure_airport_code", "departure_scheduled_time_utc"]


def movement_rows(bronze: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Flat flight rows with their departure ``date`` and where they were landed.

    With ``columns``, only these and the local departure times are parsed from the pages.

    ``date`` is the local day of the actual, else scheduled, departure: the
    date that the hourly statistics use. Extra columns: ``date``,
    ``ingestion_date``, ``data_date``, ``data_time_block``, ``page_airport``,
    ``page_offset``, ``page_pos``; what ``bronze`` lacks of these is NULL.
    """
    keep = ["ingestion_date", "data_date", "data_time_block", "airport_code", "offset"]
    landed = bronze.select("raw_data", *[c if c in bronze.columns else F.lit(None).alias(c) for c in keep])
    entity = S.FLIGHTS
    if columns is not None:
        columns = list(dict.fromkeys([*columns, *DEPARTURE_LOCAL]))
        entity = entity.only(*[MOVEMENT_MEMBERS[c][0] for c in columns])
    items = parse_pages(landed, entity, keep=keep)
    rows = items.select(*movement_columns(F.col("item"), columns), "ingestion_date", "data_date", "data_time_block",
                        F.col("airport_code").alias("page_airport"), F.col("offset").alias("page_offset"),
                        F.col("pos").alias("page_pos"))
    return rows.withColumn("date", F.to_date(F.coalesce(*DEPARTURE_LOCAL)))


def newest_per_flight(rows: DataFrame) -> DataFrame:
    """One row per flight key (newest ingestion, then lowest offset and position, then all columns).

    Rows with an incomplete key are kept, but a row landed at the same place
    with the same content counts once.
    """
    complete = reduce(and_, [F.col(k).isNotNull() for k in FLIGHT_KEY])
    unique = dedupe_first(rows.where(complete), FLIGHT_KEY, [
        -F.unix_date("ingestion_date"), F.col("page_offset"), F.col("page_pos")])
    return unique.unionByName(rows.where(~complete).distinct())


def silver_movements(bronze: DataFrame, dedupe: bool = False) -> DataFrame:
    """Flat flight rows from every landed departure page.

    ``dedupe=False`` keeps every parsed item (a page landed twice counts
    twice). ``dedupe=True`` keeps one row per flight key, the newest
    ingestion winning, then the lowest (offset, position), then a total
    order; rows without a complete key are kept.
    """
    if dedupe:
        rows = newest_per_flight(movement_rows(bronze))
    else:
        rows = parse_pages(bronze.select("raw_data"), S.FLIGHTS, keep=[]).select(*movement_columns(F.col("item")))
    return rows.select(*[f.name for f in S.SILVER_FLIGHTS.fields])
