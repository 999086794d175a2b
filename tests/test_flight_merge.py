"""Flights merged through the key-to-date index, and the hourly state summed from signed changes."""
import datetime as dt
import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from contrail.operators import gold as G
from contrail.plans import hourly_state as H
from contrail.plans import flight_merge as M
from contrail.plans.sinks import append_table


def departure_page(number, airport, scheduled, actual, gate):
    def times(kind, value):
        return {f"{kind}Time{zone}": {"DateTime": value + mark} for zone, mark in (("Local", ""), ("UTC", "Z"))} if value else {}
    return json.dumps({"FlightStatusResource": {"Flights": {"Flight": {
        "Departure": {"AirportCode": airport, **times("Scheduled", scheduled), **times("Actual", actual), "Terminal": {"Gate": gate}},
        "MarketingCarrier": {"AirlineID": "XY", **({"FlightNumber": number} if number else {})}}}}})


def pages(spark, rows, day):
    """Bronze rows of (number, airport, scheduled, actual, gate, offset); times as yyyy-MM-ddTHH:mm."""
    from contrail.sources.pages import land_flight_pages
    data = [(departure_page(number, airport, scheduled, actual, gate), "P", scheduled[:11] + "00:00", offset)
            for number, airport, scheduled, actual, gate, offset in rows]
    return land_flight_pages(spark.createDataFrame(data, "raw_data string, airport_code string, block string, offset long"), day)


FIRST = [("1", "A", "2024-01-10T08:00", None, "g1", 0), ("2", "A", "2024-01-10T09:00", "2024-01-10T09:30", "g2", 50),
         ("3", "B", "2024-02-20T10:00", "2024-02-20T10:05", "g3", 0), (None, "B", "2024-02-20T11:00", None, "g4", 50),
         ("5", "C", "2024-03-05T23:50", None, "g5", 0)]
#: Flight 1 left late, flight 5 the next day; flight 3 again unchanged; a flight without a number at another place.
SECOND = [("1", "A", "2024-01-10T08:00", "2024-01-10T10:20", "h1", 0), ("5", "C", "2024-03-05T23:50", "2024-03-06T00:30", "h5", 50),
          ("3", "B", "2024-02-20T10:00", "2024-02-20T10:05", "g3", 100), (None, "B", "2024-02-20T11:00", None, "g4", 100)]


def state(spark, root):
    return sorted(tuple(r) for r in H.read_state(spark, root).collect())


def built(rows):
    """The state that the flights themselves give."""
    d = F.col("delay_seconds")
    return sorted(tuple(r) for r in G.flight_facts(rows).groupBy("airport_code", "date", "hour").agg(
        F.count(F.lit(1)), F.coalesce(F.sum(d), F.lit(0)), F.count(d), F.count_if(d > 900)).collect())


@pytest.mark.parametrize("grain", ["month", "day"])
def test_landings_and_corrections(spark, tmp_table, grain):
    dates = M.merge_flights(pages(spark, FIRST, "2024-03-05"), tmp_table, "a", grain)
    assert sorted(map(str, dates)) == ["2024-01-10", "2024-02-20", "2024-03-05"]
    assert state(spark, tmp_table) == built(M.read_flights(spark, tmp_table))
    dates = M.merge_flights(pages(spark, SECOND, "2024-03-06"), tmp_table, "b", grain)
    assert sorted(map(str, dates)) == ["2024-01-10", "2024-02-20", "2024-03-05", "2024-03-06"]
    flights = M.read_flights(spark, tmp_table)
    got = sorted(((r.marketing_carrier_flight_number or "", r.departure_terminal_gate, str(r.date)) for r in flights.collect()))
    assert got == [("", "g4", "2024-02-20"), ("", "g4", "2024-02-20"), ("1", "h1", "2024-01-10"), ("2", "g2", "2024-01-10"),
                   ("3", "g3", "2024-02-20"), ("5", "h5", "2024-03-06")]
    assert state(spark, tmp_table) == built(flights)
    # Flight 5 left its date: no empty folder of the day stays behind.
    assert not glob.glob(f"{tmp_table}/rows/period=2024-03-05*")


def test_repeated_landing_changes_nothing(spark, tmp_table):
    for name, rows, day in (("a", FIRST, "2024-03-05"), ("b", SECOND, "2024-03-06"), ("b", SECOND, "2024-03-06"),
                            ("a again", FIRST, "2024-03-05")):
        M.merge_flights(pages(spark, rows, day), tmp_table, name)
    flights = M.read_flights(spark, tmp_table)
    assert flights.count() == 6 and state(spark, tmp_table) == built(flights)


def test_failure_between_changes_and_rows(spark, tmp_table, monkeypatch):
    M.merge_flights(pages(spark, FIRST, "2024-03-05"), tmp_table, "a")

    def broken(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(M, "replace_partitions", broken)
        with pytest.raises(RuntimeError):
            M.merge_flights(pages(spark, SECOND, "2024-03-06"), tmp_table, "b")
    M.merge_flights(pages(spark, SECOND, "2024-03-06"), tmp_table, "b")
    flights = M.read_flights(spark, tmp_table)
    assert flights.count() == 6 and state(spark, tmp_table) == built(flights)


def test_compaction_and_its_failure(spark, tmp_table):
    assert state(spark, tmp_table) == [] and H.newest_generation(spark, tmp_table) is None
    M.merge_flights(pages(spark, FIRST, "2024-03-05"), tmp_table, "a")
    assert H.compact(spark, tmp_table) == 1
    M.merge_flights(pages(spark, SECOND, "2024-03-06"), tmp_table, "b")
    want = state(spark, tmp_table)
    # A generation without its list of landings is not read.
    append_table(spark.createDataFrame([("X", None, 1, 1, 1, 1, 1)], M.CHANGES), f"{tmp_table}/state/generation=2/sums", M.CHANGES)
    assert H.newest_generation(spark, tmp_table) == 1 and state(spark, tmp_table) == want
    assert H.compact(spark, tmp_table) == 2 and state(spark, tmp_table) == want
    assert want == built(M.read_flights(spark, tmp_table))


def test_only_touched_prefixes_and_periods_are_read(spark, tmp_table):
    M.merge_flights(pages(spark, FIRST, "2024-03-05"), tmp_table, "a")
    correction = [SECOND[0]]
    prefixes = {r[0] for r in M.index_rows(M.movement_rows(pages(spark, correction, "2024-03-06"))).select("prefix").collect()}
    read = {f"prefix={p}" for p in prefixes} | {"period=2024-01"}
    for path in [*glob.glob(f"{tmp_table}/index/prefix=*"), *glob.glob(f"{tmp_table}/rows/period=*")]:
        if os.path.basename(path) in read:
            continue
        for file in glob.glob(f"{path}/*.parquet"):  # a reader would fail on it
            with open(file, "wb") as f:
                f.write(b"not parquet")
            os.remove(os.path.join(path, f".{os.path.basename(file)}.crc"))
    dates = M.merge_flights(pages(spark, correction, "2024-03-06"), tmp_table, "b")
    assert list(map(str, dates)) == ["2024-01-10"]
    rows = spark.read.schema(M.FLIGHT_ROWS).parquet(f"{tmp_table}/rows").where("period = '2024-01'")
    assert sorted(r.departure_terminal_gate for r in rows.collect()) == ["g2", "h1"]


def test_index_plan(spark, tmp_table):
    M.merge_flights(pages(spark, FIRST, "2024-03-05"), tmp_table, "a")
    index = spark.read.schema(M.INDEX).parquet(f"{tmp_table}/index")
    plan = M.index_slice(index, [3, 5], dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 31))._jdf.queryExecution().toString()
    assert "prefix" in plan.split("PartitionFilters")[1].split("]")[0]
    assert "GreaterThanOrEqual(scheduled" in plan


def test_rebuilt_index_drops_places_left(spark, tmp_table):
    M.merge_flights(pages(spark, FIRST, "2024-03-05"), tmp_table, "a")
    M.merge_flights(pages(spark, SECOND, "2024-03-06"), tmp_table, "b")
    index = spark.read.schema(M.INDEX).parquet(f"{tmp_table}/index")
    assert index.where("date = '2024-03-05'").count() == 1
    M.rebuild_index(spark, tmp_table)
    index = spark.read.schema(M.INDEX).parquet(f"{tmp_table}/index")
    assert index.count() == 4 and index.where("date = '2024-03-05'").count() == 0


def test_empty_landing(spark, tmp_table):
    assert M.merge_flights(pages(spark, FIRST, "2024-03-05").limit(0), tmp_table, "none") == []
    assert M.read_flights(spark, tmp_table).count() == 0


def test_read_flights_of_dates(spark, tmp_table):
    for grain in ("month", "day"):
        root = f"{tmp_table}_{grain}"
        M.merge_flights(pages(spark, FIRST, "2024-03-05"), root, "a", grain)
        got = M.read_flights(spark, root, dt.date(2024, 1, 11), dt.date(2024, 3, 5))
        assert sorted(r.departure_terminal_gate for r in got.collect()) == ["g3", "g4"]


def test_merge_leaves_no_uncompressed_rows(spark, tmp_path, monkeypatch):
    wide, cut = [], M.cut_lineage
    monkeypatch.setattr(M, "cut_lineage", lambda df, *a: (wide.append(len(df.columns)), cut(df, *a))[1])
    staging = str(tmp_path / "staging")
    monkeypatch.setattr(M, "work_path", lambda spark, *parts: staging, raising=False)
    M.merge_flights(pages(spark, FIRST, "2024-01-31"), str(tmp_path / "flights"), "first")
    M.merge_flights(pages(spark, SECOND, "2024-02-28"), str(tmp_path / "flights"), "second")
    assert max(wide, default=0) < 10  # rows of the table are staged as parquet, not checkpointed
    assert not (tmp_path / "staging").exists()
