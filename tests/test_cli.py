"""End to end through the command-line jobs: land → silver → gold."""
import json

import pytest

from contrail.plans import cli, jobs


def test_cli_runs_the_medallion(spark, tmp_path, capsys):
    root = str(tmp_path / "lake")
    cli.main(["create", "--root", root])
    ap = json.dumps({"AirportResource": {"Airports": {"Airport": {
        "AirportCode": "FRA", "LocationType": "Airport",
        "Position": {"Coordinate": {"Latitude": 50.0, "Longitude": 8.5}}}}}})
    jobs.land_reference(spark, spark.createDataFrame(
        [("Airports", 0, ap)], "container string, offset int, raw_data string"), root, "2024-01-03")
    leg = {"AirportCode": "FRA", "ScheduledTimeLocal": {"DateTime": "2024-01-01T10:00"},
           "ScheduledTimeUTC": {"DateTime": "2024-01-01T09:00Z"},
           "ActualTimeUTC": {"DateTime": "2024-01-01T09:20Z"}}
    f = json.dumps({"FlightStatusResource": {"Flights": {"Flight": {"Departure": leg}}}})
    jobs.land_departures(spark.createDataFrame(
        [("FRA", "2024-01-01T08:00", 0, f)],
        "airport_code string, block string, offset int, raw_data string"), root, "2024-01-03")
    cli.main(["silver-reference", "--root", root])
    cli.main(["silver-flights", "--root", root])
    cli.main(["gold", "--root", root, "--as-of", "2024-01-03"])
    out = capsys.readouterr().out
    assert "airports written" in out and "cities skipped" in out and "status='written'" in out
    (row,) = jobs.read_layer(spark, root, "gold", "airports_daily_stats").collect()
    assert (row.airport_code, row.hour, row.total_departures, row.average_departure_delay_minutes,
            row.delayed_flights_percentage) == ("FRA", 10, 1, 20.0, 100.0)


def test_cli_lands_saved_pages_and_runs_a_day_over_touched_dates(spark, tmp_path, capsys):
    from contrail.sources.pages import write_page_files
    root, saved, files = str(tmp_path / "lake"), tmp_path / "saved", str(tmp_path / "files")
    for date, lon in (("2024-01-01", 1.0), ("2024-01-02", 8.5)):
        folder = saved / "Airports" / date
        folder.mkdir(parents=True)
        (folder / "Airports_0.json").write_text(json.dumps({"AirportResource": {"Airports": {"Airport": {
            "AirportCode": "FRA", "LocationType": "Airport",
            "Position": {"Coordinate": {"Latitude": 50.0, "Longitude": lon}}}}}}))

    def page(day, hour):
        leg = {"AirportCode": "FRA", "ScheduledTimeLocal": {"DateTime": f"{day}T{hour}:00"},
               "ScheduledTimeUTC": {"DateTime": f"{day}T{hour}:00Z"}}
        return json.dumps({"FlightStatusResource": {"Flights": {"Flight": {
            "Departure": leg, "MarketingCarrier": {"AirlineID": "XX", "FlightNumber": "1"}}}}})

    cli.main(["create", "--root", root])
    cli.main(["land-reference", "--root", root, "--pages", str(saved), "--run-date", "2024-01-03"])
    cli.main(["silver-reference", "--root", root])
    for run_date, day, hour in (("2024-01-03", "2024-01-02", "10"), ("2024-01-04", "2024-01-01", "11")):
        here = f"{files}/{run_date}"
        write_page_files(spark.createDataFrame(
            [("FRA", f"{day}T08:00", 0, page(day, hour), day, "08")],
            "airport_code string, block string, offset int, raw_data string, date string, hour string"),
            here, ["date", "hour"])
        cli.main(["land-flights", "--root", root, "--pages", here, "--run-date", run_date])
        cli.main(["daily-flights", "--root", root, "--run-date", run_date, "--as-of", run_date])
    bronze = jobs.read_layer(spark, root, "bronze", "flights").collect()
    assert {(r.airport_code, r.data_time_block, r.offset) for r in bronze} == {("FRA", "08", 0)}
    rows = jobs.read_layer(spark, root, "gold", "airports_daily_stats").collect()
    assert {(str(r.date), r.hour, r.longitude) for r in rows} == {("2024-01-01", 11, 8.5), ("2024-01-02", 10, 8.5)}
    with pytest.raises(SystemExit):
        cli.main(["land-flights", "--root", root])
