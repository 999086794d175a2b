"""Incremental gold rules (one test per rule) and whole-table properties."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from contrail.plans.jobs import goldenize

DIM = [("FRA", 8.5, 50.0), ("MUC", 11.7, 48.3), ("HAM", 10.0, 53.6)]


def flights(spark, rows):
    """rows: (airport, scheduled 'YYYY-MM-DD HH:MM', delay minutes or None)."""
    out = []
    for a, s, d in rows:
        sched = dt.datetime.fromisoformat(s)
        act = None if d is None else sched + dt.timedelta(minutes=d)
        out.append((a, sched, sched, act, act))
    return spark.createDataFrame(out, "departure_airport_code string, "
                                 "departure_scheduled_time_local timestamp_ntz, "
                                 "departure_scheduled_time_utc timestamp_ntz, "
                                 "departure_actual_time_local timestamp_ntz, "
                                 "departure_actual_time_utc timestamp_ntz")


def dim(spark):
    return spark.createDataFrame(DIM, "airport_code string, longitude double, latitude double")


def table(spark, path):
    return {(r.airport_code, str(r.date), r.hour): r.asDict()
            for r in spark.read.parquet(path).collect()}


BASE = [("FRA", "2024-01-01 10:05", 20), ("FRA", "2024-01-01 10:30", 5),
        ("MUC", "2024-01-01 10:10", None), ("FRA", "2024-01-02 07:00", 16),
        ("XXX", "2024-01-02 07:00", 1), ("MUC", "2024-01-03 23:50", -3),
        ("HAM", "2024-01-04 00:10", 30)]


def test_values_and_dimension_rules(spark, tmp_table):
    goldenize(spark, flights(spark, BASE), dim(spark), tmp_table, "2024-01-05")
    t = table(spark, tmp_table)
    fra = t[("FRA", "2024-01-01", 10)]
    assert (fra["total_departures"], fra["average_departure_delay_minutes"],
            fra["delayed_flights"], fra["delayed_flights_percentage"]) == (2, 12.5, 1, 50.0)
    muc = t[("MUC", "2024-01-01", 10)]
    assert (muc["total_departures"], muc["average_departure_delay_minutes"], muc["delayed_flights"]) == (1, None, 0)
    ham = t[("HAM", "2024-01-01", 10)]
    assert (ham["total_departures"], ham["average_departure_delay_minutes"],
            ham["delayed_flights"], ham["delayed_flights_percentage"]) == (0, None, 0, 0.0)
    assert not any(k[0] == "XXX" for k in t)                 # not in the dimension
    hours = {(d, h) for _, d, h in t}
    assert len(t) == len(hours) * len(DIM)                  # dense: every airport per hour
    assert ("2024-01-04", 0) in hours and len(hours) == 4
    assert t[("FRA", "2024-01-02", 7)]["delayed_flights"] == 1   # 16 > 15


def test_rerun_same_day_changes_nothing(spark, tmp_table):
    f = flights(spark, BASE)
    goldenize(spark, f, dim(spark), tmp_table, "2024-01-05")
    first = table(spark, tmp_table)
    goldenize(spark, f, dim(spark), tmp_table, "2024-01-05")
    assert table(spark, tmp_table) == first


def test_day_by_day_equals_full_build(spark, tmp_path):
    f = flights(spark, BASE)
    inc, full = str(tmp_path / "inc"), str(tmp_path / "full")
    for day in range(2, 7):
        as_of = f"2024-01-0{day}"
        known = f.where(F.col("departure_scheduled_time_utc") < F.lit(as_of).cast("timestamp_ntz"))
        goldenize(spark, known, dim(spark), inc, as_of)
    goldenize(spark, f, dim(spark), full, "2024-01-06")
    assert table(spark, inc) == table(spark, full)
    assert spark.read.parquet(inc).count() == len(table(spark, inc))   # each key once


def test_late_flight_for_done_hour_is_frozen(spark, tmp_table):
    goldenize(spark, flights(spark, BASE), dim(spark), tmp_table, "2024-01-05")
    late = flights(spark, BASE + [("FRA", "2024-01-01 10:45", 60)])
    goldenize(spark, late, dim(spark), tmp_table, "2024-01-06")
    assert table(spark, tmp_table)[("FRA", "2024-01-01", 10)]["total_departures"] == 2


def test_refresh_days_widen_the_replaced_range(spark, tmp_table):
    goldenize(spark, flights(spark, BASE), dim(spark), tmp_table, "2024-01-05")
    late = flights(spark, BASE + [("FRA", "2024-01-03 23:15", 10)])
    goldenize(spark, late, dim(spark), tmp_table, "2024-01-05", refresh_days=3)
    assert table(spark, tmp_table)[("FRA", "2024-01-03", 23)]["total_departures"] == 1


def test_yesterday_refreshed_and_today_ignored(spark, tmp_table):
    f = flights(spark, BASE + [("FRA", "2024-01-05 09:00", 0)])
    run = goldenize(spark, f, dim(spark), tmp_table, "2024-01-05")
    t = table(spark, tmp_table)
    assert not any(d == "2024-01-05" for _, d, _ in t)          # today: ignored
    assert run.refreshed_hours == 1 and run.appended_hours == 3  # the 4th is yesterday
    more = flights(spark, BASE + [("HAM", "2024-01-04 00:20", 10), ("MUC", "2024-01-04 05:00", 0)])
    goldenize(spark, more, dim(spark), tmp_table, "2024-01-05")
    t = table(spark, tmp_table)
    assert t[("HAM", "2024-01-04", 0)]["total_departures"] == 2    # yesterday replaced whole
    assert ("MUC", "2024-01-04", 5) in t


def test_yesterday_without_flights_is_untouched(spark, tmp_table):
    goldenize(spark, flights(spark, BASE), dim(spark), tmp_table, "2024-01-05")
    before = table(spark, tmp_table)
    no_day4 = [r for r in BASE if not r[1].startswith("2024-01-04")]
    run = goldenize(spark, flights(spark, no_day4), dim(spark), tmp_table, "2024-01-05")
    assert run.status == "nothing_to_do" and table(spark, tmp_table) == before


def test_empty_flights_skip(spark, tmp_table):
    assert goldenize(spark, flights(spark, BASE).limit(0), dim(spark), tmp_table,
                     "2024-01-05").status == "no_flights"


@pytest.mark.parametrize("exact", [True, False])
def test_reference_rounding_mode_runs(spark, tmp_table, exact):
    goldenize(spark, flights(spark, BASE), dim(spark), tmp_table, "2024-01-05", exact=exact)
    assert table(spark, tmp_table)[("FRA", "2024-01-01", 10)]["average_departure_delay_minutes"] == 12.5


def test_delay_of_exactly_fifteen_minutes_is_not_delayed(spark, tmp_table):
    rows = [("FRA", "2024-01-01 10:00", 15), ("FRA", "2024-01-01 10:10", 16),
            ("FRA", "2024-01-01 10:20", -5)]
    goldenize(spark, flights(spark, rows), dim(spark), tmp_table, "2024-01-05")
    r = table(spark, tmp_table)[("FRA", "2024-01-01", 10)]
    assert (r["total_departures"], r["delayed_flights"], r["delayed_flights_percentage"],
            r["average_departure_delay_minutes"]) == (3, 1, 33.33, 8.67)


def test_refresh_without_replacement_rows_clears_the_day(spark, tmp_path):
    from contrail.plans import jobs
    from contrail import schemas as S
    path = str(tmp_path / "gold")
    flights = spark.sql("""SELECT 'FRA' AS departure_airport_code,
        timestamp_ntz'2024-01-30 10:00:00' AS departure_actual_time_local,
        timestamp_ntz'2024-01-30 10:00:00' AS departure_scheduled_time_local,
        timestamp_ntz'2024-01-30 09:00:00' AS departure_actual_time_utc,
        timestamp_ntz'2024-01-30 09:00:00' AS departure_scheduled_time_utc""")
    dim = spark.createDataFrame([("FRA", 8.5, 50.0)], "airport_code string, longitude double, latitude double")
    assert jobs.goldenize(spark, flights, dim, path, "2024-01-31").refreshed_hours == 1
    read = lambda: spark.read.schema(S.GOLD_AIRPORT_HOURS).parquet(path).count()
    assert read() == 1
    run = jobs.goldenize(spark, flights, dim.limit(0), path, "2024-01-31")
    assert (run.refreshed_hours, read()) == (0, 0)


def test_dates_left_by_a_run_are_written_after_skipped_days(spark, tmp_table):
    first = flights(spark, [("FRA", "2024-01-15 10:00", 1), ("FRA", "2024-01-16 10:00", 2), ("MUC", "2024-01-20 11:00", 3)])
    later = first.union(flights(spark, [("HAM", "2024-01-30 12:00", 4)]))
    day = dt.date
    goldenize(spark, first, dim(spark), tmp_table, "2024-01-16",
              touched=[day(2024, 1, 15), day(2024, 1, 16), day(2024, 1, 20), None])
    assert {k[1] for k in table(spark, tmp_table)} == {"2024-01-15"}
    goldenize(spark, later, dim(spark), tmp_table, "2024-01-20", touched=[])  # 20 January is still to come
    assert {k[1] for k in table(spark, tmp_table)} == {"2024-01-15", "2024-01-16"}
    goldenize(spark, later, dim(spark), tmp_table, "2024-01-31", touched=[day(2024, 1, 30)])
    full = tmp_table + "_full"
    goldenize(spark, later, dim(spark), full, "2024-01-31")
    assert table(spark, tmp_table) == table(spark, full)
    assert {k[1] for k in table(spark, full)} == {"2024-01-15", "2024-01-16", "2024-01-20", "2024-01-30"}
