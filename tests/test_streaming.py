"""Incremental landing with availableNow streams: new files only, duplicates dropped."""
import json

from pyspark.sql import functions as F

from contrail.sources.pages import write_page_files
from contrail.streaming.hourly import HOURS, hourly_stats_stream, stream_facts
from contrail.streaming.incremental import land_page_stream, movements_stream


def flight_page(airport, flights):
    items = [{"Departure": {"AirportCode": airport,
                            "ScheduledTimeUTC": {"DateTime": t}, "ScheduledTimeLocal": {"DateTime": t[:-1]}},
              "MarketingCarrier": {"AirlineID": "XY", "FlightNumber": n}} for n, t in flights]
    return json.dumps({"FlightStatusResource": {"Flights": {"Flight": items},
                                                "Meta": {"TotalCount": len(items)}}})


def pages(spark, rows):
    return spark.createDataFrame(rows, "airport_code string, block string, offset long, raw_data string")


def test_stream_lands_new_pages_once_and_dedupes(spark, tmp_path):
    src, bronze, silver = str(tmp_path / "src"), str(tmp_path / "bronze"), str(tmp_path / "silver")
    ck1, ck2 = str(tmp_path / "ck1"), str(tmp_path / "ck2")
    p1 = flight_page("FRA", [("1", "2024-01-01T10:00Z"), ("2", "2024-01-01T11:00Z")])
    write_page_files(pages(spark, [("FRA", "2024-01-01T08:00", 0, p1)]), src, ["airport_code", "block"])
    land_page_stream(spark, src, bronze, ck1, "2024-01-02").awaitTermination()
    movements_stream(spark, bronze, silver, ck2).awaitTermination()
    assert spark.read.parquet(bronze).count() == 1
    assert spark.read.parquet(silver).count() == 2

    # second run: one new page re-sending flight 2 plus a new flight 3
    p2 = flight_page("FRA", [("2", "2024-01-01T11:00Z"), ("3", "2024-01-01T11:30Z")])
    write_page_files(pages(spark, [("FRA", "2024-01-01T08:00", 50, p2)]), src, ["airport_code", "block"])
    land_page_stream(spark, src, bronze, ck1, "2024-01-02").awaitTermination()
    movements_stream(spark, bronze, silver, ck2).awaitTermination()
    assert spark.read.parquet(bronze).count() == 2
    got = spark.read.parquet(silver).select("marketing_carrier_flight_number").collect()
    assert sorted(r[0] for r in got) == ["1", "2", "3"]
    assert spark.read.parquet(bronze).where(F.col("data_time_block") == "08").count() == 2


def hourly(spark, path):
    return sorted((r.airport_code, str(r.date), r.hour, r.total_departures, r.average_departure_delay_minutes, r.delayed_flights)
                  for r in spark.read.schema(HOURS).parquet(path).collect())


def test_hours_close_behind_the_watermark_and_survive_restarts(spark, tmp_path):
    from contrail.sources.pages import land_flight_pages
    bronze, out, ck = (str(tmp_path / x) for x in ("bronze", "out", "ck"))

    def land(day, *flights, offset=0):
        page = flight_page("FRA", [(n, t) for n, t in flights])
        rows = pages(spark, [("FRA", "2024-01-01T08:00", offset, page)])
        land_flight_pages(rows, day).write.mode("append").partitionBy("ingestion_date").parquet(bronze)
        query = hourly_stats_stream(spark, bronze, out, ck, "3 hours")
        query.awaitTermination()
        assert query.exception() is None
        return query

    # Two flights without a number at different places are two flights.
    land("2024-01-02", ("1", "2024-01-01T10:00Z"), ("2", "2024-01-01T10:59Z"), (None, "2024-01-01T11:00Z"), (None, "2024-01-01T11:00Z"))
    assert hourly(spark, out) == []
    # The page again, on another day: all of its flights are in the state. The hours up to 12:30 - 3 are not due.
    land("2024-01-03", ("1", "2024-01-01T10:00Z"), ("2", "2024-01-01T10:59Z"), (None, "2024-01-01T11:00Z"), (None, "2024-01-01T11:00Z"))
    land("2024-01-03", ("3", "2024-01-01T12:30Z"), offset=50)
    assert hourly(spark, out) == []
    # 14:00 closes the hour from 10 on, 15:00 the one from 11 on.
    land("2024-01-04", ("4", "2024-01-01T14:00Z"), offset=100)
    assert hourly(spark, out) == [("FRA", "2024-01-01", 10, 2, None, 0)]
    # Behind the watermark: dropped. On time for an open hour: counted.
    query = land("2024-01-05", ("5", "2024-01-01T10:30Z"), ("6", "2024-01-01T11:30Z"), ("7", "2024-01-01T15:00Z"), offset=150)
    assert sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"]) > 0
    assert hourly(spark, out) == [("FRA", "2024-01-01", 10, 2, None, 0), ("FRA", "2024-01-01", 11, 3, None, 0)]


def test_closed_hours_of_a_date_are_one_file_of_a_run(spark, tmp_path):
    from contrail.sources.pages import land_flight_pages
    bronze, out, ck = (str(tmp_path / x) for x in ("bronze", "out", "ck"))
    rows = [(a, "2024-01-01T08:00", 0, flight_page(a, [(f"{d}-{h}", f"2024-01-0{d}T{h:02}:10Z") for d in (1, 2, 9) for h in range(24)]))
            for a in ("FRA", "MUC", "HAM")]
    land_flight_pages(pages(spark, rows), "2024-01-10").write.partitionBy("ingestion_date").parquet(bronze)
    hourly_stats_stream(spark, bronze, out, ck).awaitTermination()
    assert hourly(spark, out) == sorted((a, f"2024-01-0{d}", h, 1, None, 0) for a, *_ in rows for d in (1, 2) for h in range(24))
    assert {d: len(list((tmp_path / "out" / f"date=2024-01-0{d}").glob("*.parquet"))) for d in (1, 2)} == {1: 1, 2: 1}


def test_stream_facts_parse_what_they_need_and_a_time_few_times(spark):
    from contrail.sources.pages import land_flight_pages
    def leg(**times):
        return {"AirportCode": "FRA", **{k: {"DateTime": v} for k, v in times.items()}, "Terminal": {"Gate": 4}}
    items = [
        {"Departure": leg(ScheduledTimeLocal="2024-01-01T10:00", ScheduledTimeUTC="2024-01-01T09:00Z",
                          ActualTimeLocal="2024-01-01T10:20", ActualTimeUTC="2024-01-01T09:20Z"),
         "Arrival": 7, "MarketingCarrier": {"AirlineID": "XY", "FlightNumber": 1}},
        {"Departure": leg(ScheduledTimeLocal="2024-01-01T11:00", ActualTimeLocal="n/a"), "OperatingCarrier": {"AirlineID": 3}},
        {"Departure": leg(ScheduledTimeLocal="soon", ScheduledTimeUTC="2024-01-01T09:00Z")},
        {"Departure": {**leg(ScheduledTimeLocal="2024-01-01T12:00"), "AirportCode": None}},
        {"Arrival": leg(ScheduledTimeLocal="2024-01-01T13:00")}]
    text = json.dumps({"FlightStatusResource": {"Flights": {"Flight": items}}})
    facts = stream_facts(land_flight_pages(pages(spark, [("FRA", "2024-01-01T08:00", 0, text), ("FRA", "2024-01-01T08:00", 50, "[")]), "2024-01-02"))
    got = [(r.marketing_carrier_flight_number, r.place is None, str(r.event_time), r.delay_seconds)
           for r in facts.orderBy("event_time").collect()]
    assert got == [("1", True, "2024-01-01 10:20:00", 1200), (None, False, "2024-01-01 11:00:00", None)]
    plan = facts._jdf.queryExecution().optimizedPlan().toString()
    parsed = plan[plan.index("from_json("):].split("\n")[0]
    assert "ScheduledTimeUTC" in parsed and "OperatingCarrier" not in parsed and "Gate" not in parsed
    # Once to filter, once to show: a filter on what is made of a time would parse it for each mention.
    assert plan.count("RLIKE(item") <= 6, plan
