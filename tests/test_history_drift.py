"""Schema drift, snapshot history, fingerprints and field-level survivorship."""
import json

import pytest
from pyspark.sql import functions as F

from contrail import schemas as S
from contrail.operators.drift import declared_paths, schema_drift
from contrail.operators.history import as_of, entity_snapshots, snapshot_history, survivors
from contrail.operators.silver import silver_entity
from contrail.plans import fingerprint as P
from contrail.plans import standins as si

SF = "/root/testdata/sf0.001"


def pages(spark, rows):
    """Country pages of (day, items); a page with one item holds it bare, text is taken as it is."""
    def raw(items):
        if isinstance(items, str):
            return items
        return json.dumps({"CountryResource": {"Countries": {"Country": items if len(items) != 1 else items[0]}}})
    return spark.createDataFrame([(d, k, raw(i)) for k, (d, i) in enumerate(rows)], "day string, offset int, raw_data string")


def country(code="DE", **more):
    return {"CountryCode": code, "Names": {"Name": {"@LanguageCode": "EN", "$": "x"}}, **more}


def test_drift_of_each_kind(spark):
    rows = [("clean", [country(), country("FR")]), ("clean", [country("IT")]),
            ("single", [country(Extra=[1, 2])]),
            ("types", [country(5), country("FR"), {**country(), "Names": "plain"}]),
            ("missing", [{"CountryCode": "DE"}, {"CountryCode": None}]),
            ("deep", [{**country(), "Names": {"Name": "x", "Other": {"a": 1}}}]),
            ("bad", "{oops"), ("bad", '{"Error": "x"}'), ("bad", [])]
    got = sorted((r.day, r.path, r.status, r.observed, r["items"]) for r in schema_drift(pages(spark, rows), S.COUNTRIES, ["day"]).collect())
    assert got == [
        ("deep", "Names.Other", "unknown", "OBJECT<a: BIGINT>", 1),
        ("missing", "Names", "missing", None, 0), ("missing", "Names.Name", "missing", None, 0),
        ("single", "Extra", "unknown", "ARRAY<BIGINT>", 1),
        ("types", "CountryCode", "type", "VARIANT", 3), ("types", "Names", "type", "VARIANT", 3)]
    assert schema_drift(pages(spark, rows).limit(0), S.COUNTRIES, ["day"]).count() == 0


def test_declared_paths_reach_every_leaf():
    paths = declared_paths(S.FLIGHTS.item)
    assert paths["Departure"] == ["OBJECT"] and paths["Departure.Terminal.Gate"] == ["STRING"] and len(paths) == 45


def test_history_slices_equal_the_snapshots(spark):
    bronze = si.airline_snapshots(spark, SF)
    history = snapshot_history(entity_snapshots(bronze, "airlines"), bronze.select("ingestion_date"), "airline_id")
    for date in si.HISTORY_DATES:
        want = silver_entity(bronze.where(F.col("ingestion_date") == F.lit(date).cast("date")), "airlines")
        got = as_of(history, date).select(want.columns)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    # Between two landings the older holds; before the first there is nothing.
    assert as_of(history, "2024-01-15").count() == as_of(history, "2024-01-11").count() and as_of(history, "2023-12-31").count() == 0


def test_history_of_gaps_and_nulls(spark):
    rows = [("a", None, 1), ("a", None, 2), ("a", "x", 3), ("a", "x", 5), ("b", "y", 1), ("b", "y", 5), ("c", None, 4)]
    snapshots = spark.createDataFrame(rows, "k string, v string, d int")
    landed = spark.createDataFrame([(d,) for d in (1, 2, 3, 4, 5, 5)], "d int")
    got = sorted(map(tuple, snapshot_history(snapshots, landed, "k", "d").collect()), key=str)
    assert got == sorted([("a", None, 1, 3), ("a", "x", 3, 4), ("a", "x", 5, None), ("b", "y", 1, 2), ("b", "y", 5, None), ("c", None, 4, 5)], key=str)


def test_fingerprint_is_of_the_multiset(spark):
    def of(rows):
        return tuple(P.fingerprint(spark.createDataFrame(rows, "a string, b string").repartition(3)).first())
    rows = [("1", "x"), ("2", None), (None, "2"), ("1", "x")]
    assert of(rows) == of(rows[::-1])
    for other in (rows[:3], rows + [rows[0]] * 2, [("1", "x"), ("2", None), ("2", None), ("1", "x")], [("1", "y"), *rows[1:]],
                  [("2", None), (None, "2"), ("1", "y"), ("1", "y")]):
        assert of(other) != of(rows)
    assert of([]) == (0, 0, 0) != of([(None, None)])


@pytest.mark.parametrize("broken", ["_SUCCESS", "_fingerprint"])
def test_refresh_skips_and_recovers(spark, tmp_table, broken):
    import os
    import shutil
    rows = [("d", [country(c) for c in ("DE", "FR", "IT")])]
    bronze = pages(spark, rows).withColumn("ingestion_date", F.lit("2024-01-01").cast("date"))
    assert P.refresh_entity(bronze, "countries", tmp_table) == "written"
    assert P.refresh_entity(bronze.withColumn("offset", F.lit(7)), "countries", tmp_table) == "skipped"
    # A table or fingerprint that is not whole is written again.
    os.remove(f"{tmp_table}/_SUCCESS") if broken == "_SUCCESS" else shutil.rmtree(f"{tmp_table}_fingerprint")
    assert P.refresh_entity(bronze, "countries", tmp_table) == "written"
    fewer = bronze.withColumn("raw_data", F.regexp_replace("raw_data", "IT", "FR"))
    assert P.refresh_entity(fewer, "countries", tmp_table) == "written"
    assert spark.read.parquet(tmp_table).count() == 2
    assert P.refresh_entity(bronze.limit(0), "countries", tmp_table) == "empty"


def test_survivors(spark):
    rows = [("k", 1, "p1", "old", None), ("k", 2, "p2", None, None), ("k", 3, "p3", None, 7), ("k", 3, "p4", "tie", 6),
            ("k", 3, "p3", None, 5), (None, 9, "p9", "x", 1), ("empty", 1, "p1", None, None)]
    df = spark.createDataFrame(rows, "k string, day int, page string, gate string, n int").repartition(4)
    got = {r.k: r for r in survivors(df, ["k"], [-F.col("day")], ["day", "page"]).collect()}
    assert set(got) == {"k", "empty"}
    assert got["k"].gate == "tie" and tuple(got["k"].gate_from) == (3, "p4")
    assert got["k"].n == 5 and tuple(got["k"].n_from) == (3, "p3")
    assert got["empty"].gate is None and got["empty"].gate_from is None
