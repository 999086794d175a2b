"""Page parsing edge cases (FIXTURES §4) and page landing/layouts."""
import json

import pytest
from pyspark.sql import functions as F

from contrail import schemas as S
from contrail.operators.audit import classify_pages, first_seen_codes, page_gaps
from contrail.operators.parse import parse_pages
from contrail.operators.silver import silver_entity, silver_movements
from contrail.sources.pages import land_pages, read_page_documents


def airport(code, name=None, **kw):
    d = {"AirportCode": code, "LocationType": "Airport",
         "Names": {"Name": name if name is not None else {"@LanguageCode": "EN", "$": f"N{code}"}}}
    d.update(kw)
    return d


def page(items, total=None):
    return json.dumps({"AirportResource": {"Airports": {"Airport": items},
                                           "Meta": {"TotalCount": total or 1}}})


def bronze(spark, pages, date="2024-01-31"):
    df = spark.createDataFrame([(p, o) for p, o in pages], "raw_data string, offset int")
    return land_pages(df, date)


def test_single_object_list_and_bad_pages(spark):
    pages = [(page(airport("AAA")), 0),                        # object instead of list
             (page([airport("BBB"), airport("CCC")]), 100),
             ('{"AirportResource":', 200),                     # malformed
             ('{"ProcessingErrors":{"ProcessingError":{"Type":"X"}}}', 300),
             (page([]), 400)]
    rows = silver_entity(bronze(spark, pages), "airports").collect()
    assert sorted(r.airport_code for r in rows) == ["AAA", "BBB", "CCC"]


def test_names_coordinates_and_numeric_codes(spark):
    items = [airport("AAA", name=[{"@LanguageCode": "DE", "$": "de"}, {"@LanguageCode": "EN", "$": "en"}],
                     Position={"Coordinate": {"Latitude": "1.5", "Longitude": 2.25}}),
             airport("BBB", name=[{"@LanguageCode": "FR", "$": "fr"}]),
             airport("CCC", name="plain"),
             airport(319)]
    out = {r.airport_code: r for r in silver_entity(bronze(spark, [(page(items), 0)]),
                                                     "airports").collect()}
    assert out["AAA"].name == "en" and out["AAA"].latitude == 1.5 and out["AAA"].longitude == 2.25
    assert out["BBB"].name == "fr" and out["CCC"].name == "plain" and "319" in out


def test_dedupe_is_deterministic_and_latest_wins(spark):
    old = bronze(spark, [(page([airport("AAA", name={"$": "old"})]), 0)], "2024-01-01")
    new = bronze(spark, [(page([airport("AAA", name={"$": "second"})]), 100),
                         (page([airport("BBB"), airport("AAA", name={"$": "first"})]), 0),
                         (page([airport("AAA", name={"$": "third"})]), 200)])
    for _ in range(3):
        rows = silver_entity(old.unionByName(new).repartition(5), "airports").collect()
        assert {r.airport_code: r.name for r in rows}["AAA"] == "first"


def test_location_type_and_null_key_filters(spark):
    items = [airport("AAA"), airport("RRR", LocationType="RailwayStation"), airport(None)]
    rows = silver_entity(bronze(spark, [(page(items), 0)]), "airports").collect()
    assert [r.airport_code for r in rows] == ["AAA"]


def test_empty_bronze_gives_empty_silver(spark):
    empty = spark.createDataFrame([], S.BRONZE_REFERENCE)
    assert silver_entity(empty, "countries").count() == 0


def test_movements_dedupe_option(spark):
    leg = {"AirportCode": "FRA", "ScheduledTimeUTC": {"DateTime": "2024-01-01T10:00Z"},
           "ScheduledTimeLocal": {"DateTime": "2024-01-01T11:00"}}
    f = {"Departure": leg, "MarketingCarrier": {"AirlineID": "XY", "FlightNumber": "1"}}
    raw = json.dumps({"FlightStatusResource": {"Flights": {"Flight": f}}})
    df = spark.createDataFrame([(raw, "2024-01-02", 0), (raw, "2024-01-03", 0)],
                               "raw_data string, ingestion_date string, offset int") \
        .withColumn("ingestion_date", F.to_date("ingestion_date"))
    assert silver_movements(df).count() == 2
    assert silver_movements(df, dedupe=True).count() == 1
    assert len(silver_movements(df).columns) == 27


def test_classify(spark):
    bodies = [page([airport("A")]), '{"Error":"Gateway Timeout"}', '{"error":"x"}',
              '{"ProcessingErrors":{"ProcessingError":{"Type":"T","Description":"semantically incorrect"}}}',
              '{"ProcessingErrors":{"ProcessingError":{"Type":"T"}}}', "{oops", '{"Other":1}',
              '{"Error":"Something else"}']
    df = spark.createDataFrame([(b,) for b in bodies], "raw_data string")
    got = [r.status for r in classify_pages(df, S.AIRPORTS).collect()]
    assert got == ["ok", "rate_limited", "error", "not_found", "processing_error", "malformed",
                   "empty", "error"]


def test_page_gaps_large_total_spans_chunks(spark):
    total = 50 * 10000 + 7
    pages = [(json.dumps({"FlightStatusResource": {"Flights": {"Flight": []},
                                                     "Meta": {"TotalCount": total}}}), o, "FRA")
             for o in (0, 50, 150)]
    df = spark.createDataFrame(pages, "raw_data string, offset int, airport_code string")
    gaps = page_gaps(df, S.FLIGHTS, ["airport_code"])
    assert gaps.count() == 10001 - 3
    assert gaps.where("offset = 100").count() == 1 and gaps.where("offset = 500000").count() == 1


def test_page_documents_layout_and_first_seen(spark, tmp_path):
    root = tmp_path / "Airports"
    for day, files in {"2024-01-01": {0: ["OLD"]},
                       "2024-02-01": {0: ["AAA", "BBB"], 100: ["BBB", "CCC"], 200: ["DDD"]}}.items():
        d = root / day
        d.mkdir(parents=True)
        for off, codes in files.items():
            items = [{"AirportCode": c} for c in codes]
            (d / f"Airports_{off}.json").write_text(page(items if len(items) > 1 else items[0]))
    docs = read_page_documents(spark, str(root / "*"))
    latest = docs.where(F.col("date") == docs.agg(F.max("date")).scalar())
    items = parse_pages(latest, S.AIRPORTS, keep=["offset"])
    codes = first_seen_codes(items, F.col("item.AirportCode"),
                             {"o": F.col("offset"), "p": F.col("pos")})
    ordered = [r.code for r in codes.orderBy("o", "p").collect()]
    assert ordered == ["AAA", "BBB", "CCC", "DDD"]


def test_only_the_asked_members_are_parsed_with_the_same_values(spark):
    def page(flights):
        return '{"FlightStatusResource":{"Flights":{"Flight":' + flights + '},"Meta":{"TotalCount":1}}}'
    good = ('{"Departure":{"AirportCode":"A","Terminal":{"Name":"T1","Gate":{"x":1}},"TimeStatus":{"Code":7}},'
            '"Arrival":{"AirportCode":null},"ServiceType":"p"}')
    texts = [page(good), page(f"[{good},null,{good}]"), page("[]"), page("null"), page("[3]"), page('[{"Departure":"s"}]'),
             page('[{"Departure":{"Terminal":5,"AirportCode":"q"},"Equipment":4},' + good + "]"),
             page('[{"OperatingCarrier":3,"Arrival":{"AirportCode":1.50}}]'), page(f"[{good},]"), "x", "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, raw_data string")
    paths = ["Departure.AirportCode", "Departure.Terminal.Gate", "Departure.TimeStatus.Code", "Arrival.AirportCode"]
    asked = S.FLIGHTS.only(*paths)
    assert asked.item.simpleString() == (
        "struct<Departure:struct<AirportCode:string,TimeStatus:struct<Code:string>,Terminal:struct<Gate:string>>,"
        "Arrival:struct<AirportCode:string>>")
    few, all_ = (parse_pages(df, e, keep=["n"]).select("n", "pos", *[F.col(f"item.{p}").alias(p.replace(".", "_")) for p in paths])
                 .orderBy("n", "pos").collect() for e in (asked, S.FLIGHTS))
    assert few == all_ and len(few) > 6
    with pytest.raises(ValueError):
        S.FLIGHTS.only("Departure.Gate")
