"""Entity configurations, page item schemas and table layouts.

Leaves that the source sometimes sends in another JSON type are declared as
STRING here and converted after parsing: ``from_json`` keeps the raw JSON text
of an object or array found in a STRING slot, and the text of a number, so a
``Names.Name`` that is an object or a list, or a coordinate sent quoted or
unquoted, all survive parsing.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql.types import (
    DateType, DoubleType, IntegerType, StringType, StructField, StructType,
    TimestampNTZType,
)


def _s(*names: str) -> list[StructField]:
    return [StructField(n, StringType()) for n in names]


NAMES = StructType([StructField("Name", StringType())])  # raw JSON: object, list or text
NAME_ENTRY = StructType(_s("@LanguageCode", "$"))

AIRPORT_ITEM = StructType([
    StructField("AirportCode", StringType()),
    StructField("Position", StructType([
        StructField("Coordinate", StructType(_s("Latitude", "Longitude")))])),
    *_s("CityCode", "CountryCode", "LocationType"),
    StructField("Names", NAMES),
    *_s("UtcOffset", "TimeZoneId"),
])
CITY_ITEM = StructType([*_s("CityCode", "CountryCode"), StructField("Names", NAMES),
                        *_s("UtcOffset", "TimeZoneId")])
COUNTRY_ITEM = StructType([*_s("CountryCode"), StructField("Names", NAMES)])
AIRLINE_ITEM = StructType([*_s("AirlineID", "AirlineID_ICAO"), StructField("Names", NAMES)])
AIRCRAFT_ITEM = StructType([*_s("AircraftCode"), StructField("Names", NAMES),
                            *_s("AirlineEquipCode")])

_TIME = StructType(_s("DateTime"))
_CODE_DEF = StructType(_s("Code", "Definition"))
LEG = StructType([
    StructField("AirportCode", StringType()),
    StructField("ScheduledTimeLocal", _TIME),
    StructField("ScheduledTimeUTC", _TIME),
    StructField("ActualTimeLocal", _TIME),
    StructField("ActualTimeUTC", _TIME),
    StructField("TimeStatus", _CODE_DEF),
    StructField("Terminal", StructType(_s("Name", "Gate"))),
])
_CARRIER = StructType(_s("AirlineID", "FlightNumber"))
FLIGHT_ITEM = StructType([
    StructField("Departure", LEG),
    StructField("Arrival", LEG),
    StructField("MarketingCarrier", _CARRIER),
    StructField("OperatingCarrier", _CARRIER),
    StructField("Equipment", StructType(_s("AircraftCode", "AircraftRegistration"))),
    StructField("FlightStatus", _CODE_DEF),
    StructField("ServiceType", StringType()),
])


@dataclass(frozen=True)
class Entity:
    """Where the list of items sits in a page and how the entity is keyed."""
    name: str          # bronze / silver table name
    resource: str      # top-level key
    container: str     # second-level key
    list_key: str      # key of the list (or single object)
    item: StructType
    page_size: int = 100

    def only(self, *paths: str) -> Entity:
        """This entity with the members at ``paths`` (``"Departure.Terminal.Gate"``) alone; parsing skips the others."""
        return replace(self, item=_members(self.item, [p.split(".") for p in paths]))


def _members(item: StructType, paths: list[list[str]]) -> StructType:
    known = set(item.fieldNames())
    missing = sorted({p[0] for p in paths} - known)
    if missing:
        raise ValueError(f"no member {missing[0]!r} among {sorted(known)}")
    kept = []
    for f in item.fields:
        below = [p[1:] for p in paths if p[0] == f.name]
        if below:
            kept.append(f if [] in below else StructField(f.name, _members(f.dataType, below), f.nullable))
    return StructType(kept)


# The page envelope keys of each entity.
AIRPORTS = Entity("airports", "AirportResource", "Airports", "Airport", AIRPORT_ITEM)
COUNTRIES = Entity("countries", "CountryResource", "Countries", "Country", COUNTRY_ITEM)
CITIES = Entity("cities", "CityResource", "Cities", "City", CITY_ITEM)
AIRLINES = Entity("airlines", "AirlineResource", "Airlines", "Airline", AIRLINE_ITEM)
AIRCRAFT = Entity("aircraft_summaries", "AircraftResource", "AircraftSummaries",
                  "AircraftSummary", AIRCRAFT_ITEM)
FLIGHTS = Entity("flights", "FlightStatusResource", "Flights", "Flight", FLIGHT_ITEM,
                 page_size=50)

REFERENCE_ENTITIES = {e.container: e for e in (AIRPORTS, AIRCRAFT, AIRLINES, CITIES, COUNTRIES)}
ALL_ENTITIES = {e.name: e for e in (AIRPORTS, COUNTRIES, CITIES, AIRLINES, AIRCRAFT, FLIGHTS)}


def entity_for_container(container: str) -> Entity:
    try:
        return REFERENCE_ENTITIES[container]
    except KeyError:
        raise ValueError(f"no reference entity has the container {container!r}") from None


# Table layouts (column order is the write order).
BRONZE_REFERENCE = StructType([
    StructField("raw_data", StringType()), StructField("ingestion_date", DateType()),
    StructField("data_date", DateType()), StructField("offset", IntegerType()),
])
BRONZE_FLIGHTS = StructType([
    StructField("raw_data", StringType()), StructField("ingestion_date", DateType()),
    StructField("data_date", DateType()), StructField("data_time_block", StringType()),
    StructField("airport_code", StringType()), StructField("offset", IntegerType()),
])

SILVER_AIRPORTS = StructType([
    StructField("airport_code", StringType()), StructField("longitude", DoubleType()),
    StructField("latitude", DoubleType()), StructField("city_code", StringType()),
    StructField("country_code", StringType()), StructField("location_type", StringType()),
    StructField("name", StringType()), StructField("utc_offset", DoubleType()),
    StructField("time_zone_id", StringType()),
])
SILVER_CITIES = StructType([
    StructField("city_code", StringType()), StructField("country_code", StringType()),
    StructField("name", StringType()), StructField("utc_offset", DoubleType()),
    StructField("time_zone_id", StringType()),
])
SILVER_COUNTRIES = StructType(_s("country_code", "name"))
SILVER_AIRLINES = StructType(_s("airline_id", "airline_id_icao", "name"))
SILVER_AIRCRAFT = StructType(_s("aircraft_code", "name", "airline_equip_code"))


def _leg_fields(prefix: str) -> list[StructField]:
    return [
        StructField(f"{prefix}_airport_code", StringType()),
        *[StructField(f"{prefix}_{t}", TimestampNTZType()) for t in (
            "scheduled_time_local", "scheduled_time_utc", "actual_time_local", "actual_time_utc")],
        *_s(f"{prefix}_time_status_code", f"{prefix}_time_status_definition",
            f"{prefix}_terminal_name", f"{prefix}_terminal_gate"),
    ]


SILVER_FLIGHTS = StructType([
    *_leg_fields("departure"), *_leg_fields("arrival"),
    *_s("marketing_carrier_airline_id", "marketing_carrier_flight_number",
        "operating_carrier_airline_id", "operating_carrier_flight_number",
        "equipment_aircraft_code", "equipment_aircraft_registration",
        "flight_status_code", "flight_status_definition", "service_type"),
])

GOLD_AIRPORT_HOURS = StructType([
    StructField("airport_code", StringType()), StructField("longitude", DoubleType()),
    StructField("latitude", DoubleType()), StructField("total_departures", IntegerType()),
    StructField("average_departure_delay_minutes", DoubleType()),
    StructField("delayed_flights", IntegerType()),
    StructField("delayed_flights_percentage", DoubleType()),
    StructField("date", DateType()), StructField("hour", IntegerType()),
])

# A flight counts as delayed when its delay is strictly above 15 minutes.
DELAY_THRESHOLD_MINUTES = 15
