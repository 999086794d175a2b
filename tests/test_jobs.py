"""Table creation, landing jobs and routing."""
import json

import pytest
from pyspark.sql import functions as F

from contrail import schemas as S
from contrail.plans import jobs


def test_create_tables_idempotent_and_registered(spark, tmp_path):
    root = str(tmp_path / "lake")
    paths = jobs.create_tables(spark, root, register_as="contrail_t")
    assert len(paths) == 6 + 6 + 1
    jobs.create_tables(spark, root, register_as="contrail_t")
    gold = jobs.read_layer(spark, root, "gold", "airports_daily_stats")
    assert gold.count() == 0 and set(gold.columns) == {f.name for f in S.GOLD_AIRPORT_HOURS}
    assert spark.table("contrail_t.bronze_flights").count() == 0


def test_registered_tables_show_what_was_written(spark, tmp_path):
    root, page = str(tmp_path / "lake"), '{"CountryResource": {"Countries": {"Country": [{"CountryCode": "%s"}]}}}'
    spark.sql("DROP DATABASE IF EXISTS contrail_n CASCADE")
    jobs.create_tables(spark, root, register_as="contrail_n")
    for day, codes in (("2024-02-01", ["DE"]), ("2024-02-02", ["DE", "FR"])):
        rows = [("Countries", i, page % c) for i, c in enumerate(codes)]
        jobs.land_reference(spark, spark.createDataFrame(rows, "container string, offset int, raw_data string"), root, day)
        jobs.sync_catalog(spark, "contrail_n")
        jobs.silverize_entity(spark.table("contrail_n.bronze_countries"), "countries", jobs.table_path(root, "silver", "countries"))
        jobs.sync_catalog(spark, "contrail_n")
        assert spark.table("contrail_n.silver_countries").count() == len(codes) > 0
    assert spark.table("contrail_n.bronze_countries").count() == 3
    assert spark.table("contrail_n.bronze_countries").count() == jobs.read_layer(spark, root, "bronze", "countries").count()


def test_read_layer_rejects_unknown_names(spark, tmp_path):
    with pytest.raises(ValueError, match="no table 'airport'"):
        jobs.read_layer(spark, str(tmp_path), "silver", "airport")


def flight(number, when, airport="FRA"):
    return {"Departure": {"AirportCode": airport, "ScheduledTimeUTC": {"DateTime": f"{when}Z"},
                          "ScheduledTimeLocal": {"DateTime": when}},
            "MarketingCarrier": {"AirlineID": "XY", **({"FlightNumber": number} if number else {})}}


def flight_bronze(spark, pages):
    rows = [(json.dumps({"FlightStatusResource": {"Flights": {"Flight": items}}}), day, day, "08", "FRA", offset)
            for offset, day, items in pages]
    return spark.createDataFrame(rows, "raw_data string, ingestion_date string, data_date string, "
                                 "data_time_block string, airport_code string, offset int").withColumns(
        {c: F.col(c).cast("date") for c in ("ingestion_date", "data_date")})


PAGES = [(0, "2024-01-20", [flight("1", "2024-01-20T10:00"), flight(None, "2024-01-20T11:00")]),
         (50, "2024-01-21", [flight("2", "2024-01-10T10:00"), flight("1", "2024-01-20T10:00"), flight(None, "2024-01-20T11:00")]),
         (0, "2024-01-22", [flight("3", "2023-06-05T10:00"), flight("4", "garbage"), flight("5", "garbage")])]


def test_late_pages_and_incomplete_keys_are_kept(spark, tmp_path):
    from contrail.operators.silver import silver_movements
    path = str(tmp_path / "flights")
    whole = flight_bronze(spark, PAGES)
    for k in (0, 1, 2, 1):  # the last is merged twice
        jobs.silverize_new_movements(flight_bronze(spark, PAGES[k:k + 1]), path)
    got = spark.read.schema(jobs.MOVEMENTS_BY_DATE).parquet(path)
    want = silver_movements(whole, dedupe=True)
    columns = want.columns
    assert sorted(map(str, got.select(*columns).collect())) == sorted(map(str, want.collect()))
    assert got.count() == 7 and got.where("date is null").count() == 2
    plan = got.where("date = '2024-01-10'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def test_moved_flight_leaves_its_old_date(spark, tmp_path):
    path = str(tmp_path / "flights")
    first = flight("1", "2024-01-20T23:00")
    later = json.loads(json.dumps(first))
    later["Departure"]["ActualTimeLocal"] = {"DateTime": "2024-01-21T01:00"}
    jobs.silverize_new_movements(flight_bronze(spark, [(0, "2024-01-20", [first])]), path)
    jobs.silverize_new_movements(flight_bronze(spark, [(0, "2024-01-21", [later])]), path)
    got = spark.read.schema(jobs.MOVEMENTS_BY_DATE).parquet(path).collect()
    assert [str(r.date) for r in got] == ["2024-01-21"]


def test_merge_keeps_no_copy_of_its_rows(spark, tmp_path):
    """Beside the table nothing is left of a merge: neither checkpoints nor staged rows."""
    import os
    from contrail.session import ensure_checkpoint_dir
    kept = ensure_checkpoint_dir(spark).removeprefix("file:")

    def files():
        return {os.path.join(d, f) for d, _, names in os.walk(kept) for f in names}

    before, path = files(), str(tmp_path / "flights")
    for k in (0, 1, 1):
        jobs.silverize_new_movements(flight_bronze(spark, PAGES[k:k + 1]), path)
    assert files() == before
    got = spark.read.schema(jobs.MOVEMENTS_BY_DATE).parquet(path)
    assert sorted((r[0] or "", str(r[1])) for r in got.select("marketing_carrier_flight_number", "ingestion_date").collect()) == [
        ("", "2024-01-20"), ("", "2024-01-21"), ("1", "2024-01-21"), ("2", "2024-01-21")]


def test_dedupe_is_total_ordered(spark):
    from contrail.operators.snapshot import dedupe_first
    rows = [("k", 0, 0, "a"), ("k", 0, 0, "b"), (None, 0, 0, "c"), (None, 0, 0, "c")]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "key string, offset int, pos int, name string").coalesce(1)
        got = dedupe_first(df, ["key"], [F.col("offset"), F.col("pos")]).collect()
        assert sorted((str(r.key), r.name) for r in got) == [("None", "c"), ("None", "c"), ("k", "a")]


def test_audits_report_unknown_totals(spark):
    from contrail.operators.audit import page_audit, page_gaps
    page = '{"CountryResource": {"Countries": {"Country": [{"CountryCode": "DE"}]}}}'
    pages = spark.createDataFrame([("g", 0, page)], "g string, offset int, raw_data string")
    a = page_audit(pages, S.COUNTRIES, ["g"]).first()
    assert (a.announced, a.missing, a.complete) == (None, None, False)
    assert [tuple(r) for r in page_gaps(pages, S.COUNTRIES, ["g"]).collect()] == [("g", None)]


def test_land_reference_routes_and_rejects_unknown(spark, tmp_path):
    root = str(tmp_path / "lake")
    page = json.dumps({"CountryResource": {"Countries": {"Country": {"CountryCode": "DE"}}}})
    ok = spark.createDataFrame([("Countries", 0, page)], "container string, offset int, raw_data string")
    assert jobs.land_reference(spark, ok, root, "2024-02-01") == ["countries"]
    got = jobs.read_layer(spark, root, "bronze", "countries")
    assert got.where(F.col("ingestion_date") == "2024-02-01").count() == 1
    bad = spark.createDataFrame([("Spaceports", 0, page)], "container string, offset int, raw_data string")
    with pytest.raises(ValueError, match="no reference entity"):
        jobs.land_reference(spark, bad, root, "2024-02-01")


def test_silverize_skips_empty_bronze(spark, tmp_path):
    empty = spark.createDataFrame([], S.BRONZE_REFERENCE)
    assert jobs.silverize_entity(empty, "airports", str(tmp_path / "s")) is False


def test_quarantine_keeps_bad_pages_and_can_be_repeated(spark, tmp_path):
    path, silver = str(tmp_path / "q"), str(tmp_path / "s")
    good = '{"CountryResource": {"Countries": {"Country": [{"CountryCode": "DE"}]}}}'
    rows = [(good, "2024-02-01", 0), ("not json", "2024-02-01", 100), ('{"Error": "x"}', "2024-02-01", 200)]
    bronze = spark.createDataFrame(rows, "raw_data string, ingestion_date string, offset int").withColumn(
        "ingestion_date", F.col("ingestion_date").cast("date"))
    for _ in range(2):
        assert jobs.silverize_entity(bronze, "countries", silver, path)
        assert sorted(r.status for r in spark.read.parquet(path).collect()) == ["error", "malformed"]
    assert spark.read.parquet(silver).count() == 1
    assert jobs.quarantine_pages(bronze, "countries", path) == {"error": 1, "malformed": 1}


def test_landing_again_replaces_the_same_places(spark, tmp_path):
    root = str(tmp_path)
    rows = [("FRA", "2024-01-01T08:00", 0, "a"), ("FRA", "2024-01-01T08:00", 50, "b"), ("MUC", "2024-01-01T08:00", None, "c")]

    def land(some, day):
        frame = spark.createDataFrame(some, "airport_code string, block string, offset long, raw_data string")
        jobs.land_departures(frame, root, day, repeat=True)

    def held():
        return sorted((str(r.ingestion_date), r.airport_code, str(r.offset), r.raw_data)
                      for r in jobs.read_layer(spark, root, "bronze", "flights").collect())

    land(rows, "2024-01-02")
    land(rows, "2024-01-02")
    assert [r[3] for r in held()] == ["a", "b", "c"]
    land([("FRA", "2024-01-01T08:00", 50, "new"), ("FRA", "2024-01-01T12:00", 50, "other block"), ("MUC", "2024-01-01T08:00", None, "d")], "2024-01-02")
    land(rows[:1], "2024-01-03")
    land([], "2024-01-03")
    assert held() == [("2024-01-02", "FRA", "0", "a"), ("2024-01-02", "FRA", "50", "new"), ("2024-01-02", "FRA", "50", "other block"),
                      ("2024-01-02", "MUC", "None", "d"), ("2024-01-03", "FRA", "0", "a")]
    pages = spark.createDataFrame([("Countries", 0, "x"), ("Countries", 100, "y")], "container string, offset int, raw_data string")
    for _ in range(2):
        jobs.land_reference(spark, pages, root, "2024-01-02", repeat=True)
    assert jobs.read_layer(spark, root, "bronze", "countries").count() == 2


def test_new_hours_keep_the_others_of_their_date(spark, tmp_path):
    from contrail.plans.jobs import goldenize
    path = str(tmp_path / "gold")
    dim = spark.createDataFrame([("A", 1.0, 2.0), ("B", 3.0, 4.0)], "airport_code string, longitude double, latitude double")
    times = ["departure_actual_time_local", "departure_scheduled_time_local", "departure_actual_time_utc", "departure_scheduled_time_utc"]

    def flights(*hours):
        rows = spark.createDataFrame([("A", f"2024-01-10T{h}:00") for h in hours], "departure_airport_code string, t string")
        return rows.select("departure_airport_code", *[F.col("t").cast("timestamp_ntz").alias(c) for c in times])

    goldenize(spark, flights("08"), dim, path, "2024-01-20")
    first = sorted(map(str, spark.read.parquet(path).where("hour = 8").collect()))
    run = goldenize(spark, flights("08", "08", "09"), dim, path, "2024-01-20")
    assert run.appended_hours == 1
    table = spark.read.parquet(path)
    assert sorted(map(str, table.where("hour = 8").collect())) == first and len(first) == 2
    assert sorted((r.airport_code, r.total_departures) for r in table.where("hour = 9").collect()) == [("A", 1), ("B", 0)]


def test_touched_dates_limit_the_purge(spark, tmp_path):
    from contrail.plans.sinks import append_table, purge_null_hour
    path = str(tmp_path / "gold")
    rows = [("A", None, None, 1, None, 0, 0.0, f"2024-01-{d}", h) for d in (10, 11) for h in (None, 5)]
    names = [f.name for f in S.GOLD_AIRPORT_HOURS]
    table = spark.createDataFrame(rows, "a string, b double, c double, d int, e double, f int, g double, h string, i int").toDF(*names)
    append_table(table, path, S.GOLD_AIRPORT_HOURS, ["date"])
    import datetime as dt
    assert purge_null_hour(spark, path, S.GOLD_AIRPORT_HOURS, dates=[dt.date(2024, 1, 10)]) == 1
    left = spark.read.schema(S.GOLD_AIRPORT_HOURS).parquet(path)
    assert sorted((str(r.date), r.hour) for r in left.collect() if r.hour is None) == [("2024-01-11", None)] and left.count() == 3
    assert purge_null_hour(spark, path, S.GOLD_AIRPORT_HOURS) == 1
    assert spark.read.parquet(path).count() == 2


def test_large_partitions_are_written_in_pieces(spark, tmp_table):
    from contrail.plans.sinks import replace_partitions, spread
    from contrail.session import cut_lineage
    rows = cut_lineage(spark.range(3000).selectExpr("id", "repeat('x', 1000) text", "if(id < 2700, date'2024-01-01', if(id < 2990, date'2024-01-02', null)) d"))
    got = spread(rows, "d", 100_000)
    sizes = [len(p) for p in got.rdd.glom().collect()]
    assert len(sizes) >= 30 and max(sizes) < 1000 and sorted(got.collect(), key=lambda r: r.id) == rows.orderBy("id").collect()
    assert spread(rows, "d").rdd.getNumPartitions() == 1
    replace_partitions(got, tmp_table, ["d"])
    assert spark.read.parquet(tmp_table).select("id", "text", "d").exceptAll(rows).count() == 0


def test_quarantine_of_one_date_is_spread_over_tasks(spark, tmp_path, monkeypatch):
    import glob
    from contrail.plans import jobs, sinks
    spread = sinks.spread
    monkeypatch.setattr(jobs, "spread", lambda df, column: spread(df, column, 20_000))
    bronze = spark.range(2000).selectExpr("id", "'{\"Error\":\"no\"}' raw_data", "date'2024-01-01' ingestion_date")
    path = str(tmp_path / "q")
    assert jobs.quarantine_pages(bronze, "countries", path) == {"error": 2000}
    assert len(glob.glob(f"{path}/ingestion_date=2024-01-01/*.parquet")) > 2
    assert spark.read.parquet(path).select("id").distinct().count() == 2000
