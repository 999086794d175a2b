"""Stand-in inputs derived by Spark from the driver's tables.

The driver supplies TPC-H-like tables and an ``events`` stream, not airline
pages. Each function here derives, with ordinary DataFrame operations over
the *whole* table, the shape an operator consumes (flight rows, raw JSON
pages, landed bronze rows). The derivation rules are documented per
function so the DuckDB oracle can compute the expected result
independently from the same tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.session import cut_lineage
from contrail.sources.tables import read_table


def landed(bronze: DataFrame) -> DataFrame:
    """Materialise stand-in bronze rows once, like a stored landing table.

    Without it the page building would run twice per query: once inside
    the latest-snapshot subquery and once for the rows.
    """
    return cut_lineage(bronze)


# Fixed parameters of the flagship stand-in.
LOCATION_MODULUS = 30          # events spread over 30 location codes, nation keys 0..24
RUN_DATE = "2024-01-31"        # run date: the last landed day is "yesterday"


def hour_start(ts: F.Column) -> F.Column:
    """Start of the hour of an NTZ value (zone free, unlike ``date_trunc``)."""
    return F.make_timestamp_ntz(F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts),
                                F.lit(0), F.lit(0))


def event_departures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Departure-shaped rows from ``events``.

    location = ``event_id % 30`` as text; scheduled (local and UTC) = start of
    the hour of ``ts``; actual (local and UTC) = ``ts``, missing when
    ``event_type = 'error'``.
    """
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    sched = hour_start(F.col("ts"))
    actual = F.when(F.col("event_type") != "error", F.col("ts"))
    return ev.select(
        (F.col("event_id") % LOCATION_MODULUS).cast("string").alias("departure_airport_code"),
        sched.alias("departure_scheduled_time_local"),
        sched.alias("departure_scheduled_time_utc"),
        actual.alias("departure_actual_time_local"),
        actual.alias("departure_actual_time_utc"),
    )


def nation_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Location dimension from ``nation``: code = key, longitude = region, latitude = key."""
    return read_table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("string").alias("airport_code"),
        F.col("n_regionkey").cast("double").alias("longitude"),
        F.col("n_nationkey").cast("double").alias("latitude"),
    )


def first_hour_done_set(facts: DataFrame) -> DataFrame:
    """A done set holding the earliest (date, hour) of the facts (exercises the anti-join)."""
    first = facts.agg(F.min(F.struct("date", "hour")).alias("m"))
    return first.select(F.col("m.date").alias("date"), F.col("m.hour").alias("hour"))


# ------------------------------------------------------------ entity pages
OLD_SNAPSHOT_DATE = "2024-01-01"   # an earlier landing whose values must be ignored
REFERENCE_PAGE_SIZE = 100


def offset_text(key: F.Column, nation: F.Column) -> F.Column:
    """UTC offset text in eight shapes chosen by ``key % 8``.

    H = nation % 13, M = (key % 4) * 15, sign '-' for odd nations:
    0 ``±HH:MM``, 1 ``±H:MM`` (no zero pad), 2 ``±HHMM``, 3 ``±HH``, 4 ``H``,
    5 ``Z``, 6 empty, 7 ``HH:MM`` unsigned.
    """
    h = (nation % 13).cast("int")
    m = ((key % 4) * 15).cast("int")
    hh = F.lpad(h.cast("string"), 2, "0")
    mm = F.lpad(m.cast("string"), 2, "0")
    sign = F.when(nation % 2 == 1, F.lit("-")).otherwise(F.lit("+"))
    f = key % 8
    return (F.when(f == 0, F.concat(sign, hh, F.lit(":"), mm))
            .when(f == 1, F.concat(sign, h.cast("string"), F.lit(":"), mm))
            .when(f == 2, F.concat(sign, hh, mm))
            .when(f == 3, F.concat(sign, hh))
            .when(f == 4, h.cast("string"))
            .when(f == 5, F.lit("Z"))
            .when(f == 6, F.lit(""))
            .otherwise(F.concat(hh, F.lit(":"), mm)))


def _names_object(name: F.Column) -> F.Column:
    from contrail.sources.pages import json_string
    return F.concat(F.lit('{"@LanguageCode":"EN","$":'), json_string(name), F.lit("}"))


def airport_item_json(sup: DataFrame, old: bool = False) -> DataFrame:
    """Airport items from ``supplier`` (id, item JSON).

    code = s_suppkey; latitude = s_acctbal (quoted text when key % 4 = 1);
    longitude = s_nationkey; city = 'C' || s_nationkey; country = s_nationkey;
    type 'RailwayStation' when key % 10 = 0 else 'Airport'; name = s_name,
    sent as a [DE lower-case, EN] list when key % 3 = 0; offset text by
    :func:`offset_text`; zone 'Zone/' || s_nationkey. The old snapshot
    prefixes names with 'old '.
    """
    from contrail.sources.pages import json_string
    k, n = F.col("s_suppkey"), F.col("s_nationkey")
    name = F.concat(F.lit("old "), F.col("s_name")) if old else F.col("s_name")
    names = F.when(k % 3 == 0, F.concat(
        F.lit('[{"@LanguageCode":"DE","$":'), json_string(F.lower(name)),
        F.lit('},{"@LanguageCode":"EN","$":'), json_string(name), F.lit("}]"))
    ).otherwise(_names_object(name))
    lat = F.when(k % 4 == 1, json_string(F.col("s_acctbal").cast("string"))).otherwise(
        json_string(F.col("s_acctbal")))
    loc_type = F.when(k % 10 == 0, F.lit("RailwayStation")).otherwise(F.lit("Airport"))
    item = F.concat(
        F.lit('{"AirportCode":'), json_string(k.cast("string")),
        F.lit(',"Position":{"Coordinate":{"Latitude":'), lat,
        F.lit(',"Longitude":'), json_string(n.cast("double")),
        F.lit('}},"CityCode":'), json_string(F.concat(F.lit("C"), n.cast("string"))),
        F.lit(',"CountryCode":'), json_string(n.cast("string")),
        F.lit(',"LocationType":'), json_string(loc_type),
        F.lit(',"Names":{"Name":'), names,
        F.lit('},"UtcOffset":'), json_string(offset_text(k, n)),
        F.lit(',"TimeZoneId":'), json_string(F.concat(F.lit("Zone/"), n.cast("string"))),
        F.lit("}"))
    return sup.select(k.cast("long").alias("id"), item.alias("item_json"))


def city_item_json(cust: DataFrame, old: bool = False) -> DataFrame:
    """Cities from ``customer``: code 'C' || custkey, country nationkey, name, offset, zone = segment."""
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    name = F.concat(F.lit("old "), F.col("c_name")) if old else F.col("c_name")
    item = F.to_json(F.struct(
        F.concat(F.lit("C"), k.cast("string")).alias("CityCode"),
        n.cast("string").alias("CountryCode"),
        F.struct(F.struct(F.lit("EN").alias("@LanguageCode"), name.alias("$")).alias("Name"))
        .alias("Names"),
        offset_text(k, n).alias("UtcOffset"),
        F.col("c_mktsegment").alias("TimeZoneId")))
    return cust.select(k.cast("long").alias("id"), item.alias("item_json"))


def country_item_json(orders: DataFrame, old: bool = False) -> DataFrame:
    """Countries from ``orders``: code = orderkey, name = order priority."""
    k = F.col("o_orderkey")
    name = F.concat(F.lit("old "), F.col("o_orderpriority")) if old else F.col("o_orderpriority")
    item = F.to_json(F.struct(
        k.cast("string").alias("CountryCode"),
        F.struct(F.struct(F.lit("EN").alias("@LanguageCode"), name.alias("$")).alias("Name"))
        .alias("Names")))
    return orders.select(k.cast("long").alias("id"), item.alias("item_json"))


def airline_item_json(cust: DataFrame, old: bool = False, keep: tuple[str, ...] = ()
                      ) -> DataFrame:
    """Airlines from ``customer``: id = custkey, ICAO = segment, name (plus ``keep`` columns)."""
    k = F.col("c_custkey")
    name = F.concat(F.lit("old "), F.col("c_name")) if old else F.col("c_name")
    item = F.to_json(F.struct(
        k.cast("string").alias("AirlineID"), F.col("c_mktsegment").alias("AirlineID_ICAO"),
        F.struct(F.struct(F.lit("EN").alias("@LanguageCode"), name.alias("$")).alias("Name"))
        .alias("Names")))
    return cust.select(k.cast("long").alias("id"), item.alias("item_json"), *keep)


def aircraft_item_json(part: DataFrame, old: bool = False) -> DataFrame:
    """Aircraft from ``part``: code = partkey, name, equipment code = brand."""
    k = F.col("p_partkey")
    name = F.concat(F.lit("old "), F.col("p_name")) if old else F.col("p_name")
    item = F.to_json(F.struct(
        k.cast("string").alias("AircraftCode"),
        F.struct(F.struct(F.lit("EN").alias("@LanguageCode"), name.alias("$")).alias("Name"))
        .alias("Names"),
        F.col("p_brand").alias("AirlineEquipCode")))
    return part.select(k.cast("long").alias("id"), item.alias("item_json"))


def reference_pages(items: DataFrame, entity, page_size: int = REFERENCE_PAGE_SIZE,
                    overlap: bool = True) -> DataFrame:
    """Pages of ``page_size`` items by ``id div page_size``; ``offset`` = page * size.

    With ``overlap`` an item whose id is a multiple of the page size is also
    repeated as the last item of the previous page (a pagination overlap, so
    the snapshot holds duplicates). TotalCount = number of items.
    """
    from contrail.sources.pages import pack_pages
    base = items.select("id", "item_json", (F.col("id") / page_size).cast("long").alias("page"))
    if overlap:
        dup = items.where((F.col("id") % page_size == 0) & (F.col("id") >= page_size)).select(
            "id", "item_json", ((F.col("id") / page_size).cast("long") - 1).alias("page"))
        base = base.unionByName(dup)
    total = items.agg(F.count(F.lit(1))).scalar()
    pages = pack_pages(base, entity, ["page"], F.col("id"), F.col("item_json"), total)
    return pages.select((F.col("page") * page_size).alias("offset"), "raw_data", "n_items")


def entity_bronze(spark: SparkSession, sf_dir: str, entity_name: str) -> DataFrame:
    """Bronze rows of one reference entity: an old and the latest snapshot."""
    from contrail.sources.pages import land_pages
    from contrail import schemas as S
    table, builder, entity = {
        "airports": ("supplier", airport_item_json, S.AIRPORTS),
        "cities": ("customer", city_item_json, S.CITIES),
        "countries": ("orders", country_item_json, S.COUNTRIES),
        "airlines": ("customer", airline_item_json, S.AIRLINES),
        "aircraft_summaries": ("part", aircraft_item_json, S.AIRCRAFT),
    }[entity_name]
    src = read_table(spark, sf_dir, table)
    old = land_pages(reference_pages(builder(src, old=True), entity, overlap=False),
                     OLD_SNAPSHOT_DATE)
    new = land_pages(reference_pages(builder(src), entity), RUN_DATE)
    return landed(old.unionByName(new))


# ------------------------------------------------------------ flight pages
def flight_pages(spark: SparkSession, sf_dir: str, departed: bool = True) -> DataFrame:
    """Departure pages from ``lineitem`` joined to ``orders``: one page per order.

    Item per line: departure airport = l_suppkey; scheduled = o_orderdate;
    actual = l_shipdate, sent as 'n/a' when l_returnflag = 'R'; time status
    (l_linestatus, l_returnflag); terminal ('T' || l_linenumber,
    l_partkey % 100); arrival airport = o_custkey, scheduled = l_shipdate;
    marketing carrier ('MC', l_orderkey || '-' || l_linenumber); operating
    carrier (o_orderpriority, l_linenumber); aircraft = l_partkey; status =
    o_orderstatus; service 'Passenger'. Page metadata: airport = o_custkey,
    block = 4-hour block of o_orderdate, offset 0. Without ``departed``, no
    flight has an actual time yet, and gates are 'TBA'.
    """
    from contrail.functions.times import format_local_time, format_utc_time, time_block_4h
    from contrail.schemas import FLIGHTS
    from contrail.sources.pages import envelope
    # Lines are grouped per order first (small structs, partial aggregation),
    # then joined 1:1 to orders and serialised with one to_json per page. Lambdas are
    # interpreted, so the text of the order's time is made once per page, outside of them.
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag",
        "l_linestatus", "l_shipdate")
    lines = li.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct(
        "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus",
        "l_shipdate"))).alias("lines"))
    od = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    j = lines.join(od, lines.l_orderkey == od.o_orderkey).withColumn("_ordered", format_local_time("o_orderdate"))

    def t(c):
        return F.struct(c.alias("DateTime"))

    def item(x):
        returned = (x["l_returnflag"] == "R") | F.lit(not departed)
        gate = (x["l_partkey"] % 100).cast("string") if departed else F.lit("TBA")
        return F.struct(
            F.struct(
                x["l_suppkey"].cast("string").alias("AirportCode"),
                t(F.col("_ordered")).alias("ScheduledTimeLocal"),
                t(F.concat("_ordered", F.lit("Z"))).alias("ScheduledTimeUTC"),
                t(F.when(returned, F.lit("n/a")).otherwise(format_local_time(x["l_shipdate"])))
                .alias("ActualTimeLocal"),
                t(F.when(returned, F.lit("n/a")).otherwise(format_utc_time(x["l_shipdate"])))
                .alias("ActualTimeUTC"),
                F.struct(x["l_linestatus"].alias("Code"),
                         x["l_returnflag"].alias("Definition")).alias("TimeStatus"),
                F.struct(F.concat(F.lit("T"), x["l_linenumber"].cast("string")).alias("Name"),
                         gate.alias("Gate")).alias("Terminal"),
            ).alias("Departure"),
            F.struct(
                F.col("o_custkey").cast("string").alias("AirportCode"),
                t(format_local_time(x["l_shipdate"])).alias("ScheduledTimeLocal"),
            ).alias("Arrival"),
            F.struct(F.lit("MC").alias("AirlineID"),
                     F.concat(F.col("o_orderkey").cast("string"), F.lit("-"),
                              x["l_linenumber"].cast("string")).alias("FlightNumber"))
            .alias("MarketingCarrier"),
            F.struct(F.col("o_orderpriority").alias("AirlineID"),
                     x["l_linenumber"].cast("string").alias("FlightNumber"))
            .alias("OperatingCarrier"),
            F.struct(x["l_partkey"].cast("string").alias("AircraftCode")).alias("Equipment"),
            F.struct(F.col("o_orderstatus").alias("Code")).alias("FlightStatus"),
            F.lit("Passenger").alias("ServiceType"),
        )
    items = F.transform("lines", item)
    n = F.size("lines")
    list_json = F.when(n == 1, F.to_json(F.element_at(items, 1))).otherwise(F.to_json(items))
    return j.select(
        "o_orderkey", F.col("o_custkey").cast("string").alias("airport_code"),
        time_block_4h("o_orderdate").alias("block"),
        envelope(FLIGHTS, list_json, n.cast("long")).alias("raw_data"),
        n.alias("n_items"), F.lit(0).alias("offset"))


def flight_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    from contrail.sources.pages import land_flight_pages
    return land_flight_pages(flight_pages(spark, sf_dir), RUN_DATE)


def event_flight_pages(spark: SparkSession, sf_dir: str, gate: str = "A",
                       estimate: F.Column | None = None, where: F.Column | None = None) -> DataFrame:
    """Departure pages from ``events``: a page per airport, 4-hour block, lateness and 1500 events.

    airport = event_id % 30; scheduled = start of the hour; actual = ts to
    the minute, missing for 'error'; carrier ('EV', event_id), the number
    missing for 'signup'; offset = event_id div 1500 * 50. Pages of the hours
    5, 11, 17 and 23 are ``late``. Where ``estimate`` holds, the actual time is
    still 150 minutes off; ``where`` selects events.
    """
    from contrail.functions.times import format_local_time, format_utc_time, time_block_4h
    from contrail.schemas import FLIGHTS
    from contrail.sources.pages import pack_pages
    ev = read_table(spark, sf_dir, "events").select(
        "event_id", "ts", "event_type", (F.col("event_id") % LOCATION_MODULUS).cast("string").alias("airport_code"),
        time_block_4h("ts").alias("block"), (F.hour("ts") % 6 == 5).alias("late"),
        (F.col("event_id") / 1500).cast("long").alias("chunk"))
    if where is not None:
        ev = ev.where(where)
    sched = hour_start(F.col("ts"))
    known = F.col("ts") if estimate is None else F.when(
        estimate, F.col("ts") + F.expr("INTERVAL 150 MINUTES")).otherwise(F.col("ts"))
    actual = F.when(F.col("event_type") != "error", known)

    def t(c):
        return F.struct(c.alias("DateTime"))

    item = F.to_json(F.struct(
        F.struct(F.col("airport_code").alias("AirportCode"),
                 t(format_local_time(sched)).alias("ScheduledTimeLocal"),
                 t(format_utc_time(sched)).alias("ScheduledTimeUTC"),
                 t(format_local_time(actual)).alias("ActualTimeLocal"),
                 t(format_utc_time(actual)).alias("ActualTimeUTC"),
                 F.struct(F.lit(gate).alias("Gate")).alias("Terminal")).alias("Departure"),
        F.struct(F.lit("EV").alias("AirlineID"),
                 F.when(F.col("event_type") != "signup", F.col("event_id").cast("string")).alias("FlightNumber"))
        .alias("MarketingCarrier")))
    pages = pack_pages(ev, FLIGHTS, ["airport_code", "block", "late", "chunk"], F.col("event_id"), item)
    return pages.withColumn("offset", F.col("chunk") * 50)


# ------------------------------------------------------------ event pages
def event_item_json() -> F.Column:
    """An event as an airline-shaped item: id = user_id, ICAO = event_type, name = event_id."""
    return F.to_json(F.struct(
        F.col("user_id").cast("string").alias("AirlineID"),
        F.col("event_type").alias("AirlineID_ICAO"),
        F.struct(F.struct(F.lit("EN").alias("@LanguageCode"),
                          F.col("event_id").cast("string").alias("$")).alias("Name"))
        .alias("Names")))


def event_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events landed as pages: ingestion date = date of ts, page = event_id div 100."""
    from contrail.schemas import AIRLINES
    from contrail.sources.pages import pack_pages
    ev = read_table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", F.to_date("ts").alias("ingestion_date"),
        (F.col("event_id") / 100).cast("long").alias("page"))
    pages = pack_pages(ev, AIRLINES, ["ingestion_date", "page"], F.col("event_id"),
                       event_item_json())
    return landed(pages.select(
        "raw_data", "ingestion_date", F.col("ingestion_date").alias("data_date"),
        (F.col("page") * 100).cast("int").alias("offset")))


# ------------------------------------------------------------ responses and gaps
def event_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One response body per event, its shape chosen by ``event_type``.

    view → a page with the event as one airline item; click → throttled
    ``Error``; signup → ``ProcessingErrors`` with a "semantically incorrect"
    description when ``user_id`` is even, else a plain business error;
    purchase → lower-case ``error``; error → truncated JSON.
    """
    from contrail.schemas import AIRLINES
    from contrail.sources.pages import envelope
    ev = read_table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    t = F.col("event_type")
    perr = F.concat(
        F.lit('{"ProcessingErrors":{"ProcessingError":{"Type":"BusinessError","Description":"'),
        F.when(F.col("user_id") % 2 == 0, F.lit("Request was semantically incorrect"))
        .otherwise(F.lit("No flights found")), F.lit('"}}}'))
    body = (F.when(t == "view", envelope(AIRLINES, event_item_json(), F.lit(1)))
            .when(t == "click", F.lit('{"Error":"Account Over Queries Per Second Limit"}'))
            .when(t == "signup", perr)
            .when(t == "purchase", F.lit('{"error":"invalid_token"}'))
            .otherwise(F.lit('{"AirlineResource":{"Airlines":')))
    return ev.select("event_id", body.alias("raw_data"))


GAP_STEP = 50


def gapped_flight_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Departure pages of 50 from events with every seventh page of an airport missing.

    airport = event_id % 30, position = event_id div 30, page = position div
    50, offset = page * 50, TotalCount = events of the airport; pages with
    page % 7 = 6 are not landed.
    """
    from contrail.schemas import FLIGHTS
    from contrail.sources.pages import pack_pages
    ev = read_table(spark, sf_dir, "events").select(
        "event_id", (F.col("event_id") % LOCATION_MODULUS).cast("string").alias("airport_code"),
        (F.col("event_id") / LOCATION_MODULUS).cast("long").alias("p"))
    # One row per location: at most LOCATION_MODULUS rows, so broadcasting is bounded
    # and a location holding a third of the events is not shuffled into one task.
    totals = ev.groupBy("airport_code").agg(F.count(F.lit(1)).alias("total"))
    ev = ev.join(F.broadcast(totals), "airport_code").withColumn(
        "page", (F.col("p") / GAP_STEP).cast("long"))
    item = F.to_json(F.struct(F.struct(F.col("airport_code").alias("AirportCode"))
                              .alias("Departure")))
    pages = pack_pages(ev, FLIGHTS, ["airport_code", "page"], F.col("p"), item, F.col("total"))
    return pages.where(F.col("page") % 7 != 6).select(
        "airport_code", F.lit(RUN_DATE).cast("date").alias("ingestion_date"),
        (F.col("page") * GAP_STEP).cast("int").alias("offset"), "raw_data")


def event_type_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Airline pages of events by type, day of ts and event_id div 100, landed on that day and the next.

    Item id = event_id; events with event_id % 3 = 1 are on no page. Pages of
    an even event_id div 100 are landed again on the next day.
    TotalCount = events of the type.
    """
    from contrail.schemas import AIRLINES
    from contrail.sources.pages import pack_pages
    ev = read_table(spark, sf_dir, "events").select(
        "event_id", "event_type", F.to_date("ts").alias("ingestion_date"), (F.col("event_id") / 100).cast("long").alias("page"))
    totals = ev.groupBy("event_type").agg(F.count(F.lit(1)).alias("total"))  # one row per type
    item = F.to_json(F.struct(F.col("event_id").cast("string").alias("AirlineID")))
    pages = pack_pages(ev.where("event_id % 3 <> 1").join(F.broadcast(totals), "event_type"), AIRLINES,
                       ["event_type", "ingestion_date", "page"], F.col("event_id"), item, F.col("total"))
    pages = landed(pages.select("event_type", "ingestion_date", "page", "raw_data"))
    again = pages.where("page % 2 = 0").withColumn("ingestion_date", F.date_add("ingestion_date", 1))
    return pages.unionByName(again).select("event_type", "ingestion_date", (F.col("page") * 100).alias("offset"), "raw_data")


# ------------------------------------------------------------ drift and history
def drifting_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Airline pages of events, by day of ts and event_id div 100, of which items depart from the declared form.

    id = user_id, a number for 'view' on odd days; ICAO = event_type, absent
    on days divisible by three; name as declared, a bare text for 'click'; an
    undeclared ``Alliance`` for 'purchase', whose value is an object on even
    days, and an undeclared ``Names.Short`` for 'signup'.
    """
    from contrail.schemas import AIRLINES
    from contrail.sources.pages import json_string, pack_pages
    t, day = F.col("event_type"), F.dayofmonth("ts")
    user, name = F.col("user_id").cast("string"), json_string(F.col("event_id").cast("string"))
    names = F.when(t == "click", name).otherwise(F.concat(F.lit('{"@LanguageCode":"EN","$":'), name, F.lit("}")))
    item = F.concat(
        F.lit('{"AirlineID":'), F.when((t == "view") & (day % 2 == 1), user).otherwise(json_string(user)),
        F.when(day % 3 != 0, F.concat(F.lit(',"AirlineID_ICAO":'), json_string(t))).otherwise(F.lit("")),
        F.lit(',"Names":{"Name":'), names, F.when(t == "signup", F.lit(',"Short":"x"')).otherwise(F.lit("")), F.lit("}"),
        F.when(t == "purchase", F.when(day % 2 == 0, F.lit(',"Alliance":{"Code":1}')).otherwise(F.lit(',"Alliance":"A"')))
        .otherwise(F.lit("")), F.lit("}"))
    ev = read_table(spark, sf_dir, "events").select(
        "event_id", "ts", "event_type", "user_id", F.to_date("ts").alias("ingestion_date"),
        (F.col("event_id") / 100).cast("long").alias("page"))
    return pack_pages(ev, AIRLINES, ["ingestion_date", "page"], F.col("event_id"), item)


HISTORY_DATES = ("2024-01-01", "2024-01-11", "2024-01-21", RUN_DATE)


def airline_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Airlines of ``customer`` landed on four dates.

    First: old names, without ids divisible by five. Second: old names for
    ids divisible by three only. Third: as the second, without ids divisible
    by seven. Fourth: new names, all ids but those divisible by eleven.
    """
    from contrail.schemas import AIRLINES
    from contrail.sources.pages import land_pages
    cust = read_table(spark, sf_dir, "customer")
    old, new = airline_item_json(cust, old=True), airline_item_json(cust)
    third = F.col("id") % 3 == 0
    mixed = old.where(third).unionByName(new.where(~third))
    out = None
    for date, items in zip(HISTORY_DATES, (old.where("id % 5 <> 0"), mixed, mixed.where("id % 7 <> 0"), new.where("id % 11 <> 0")), strict=True):
        pages = land_pages(reference_pages(items, AIRLINES), date)
        out = pages if out is None else out.unionByName(pages)
    return landed(out)
