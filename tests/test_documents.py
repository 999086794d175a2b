"""One document per file: names, newest folder by name, order by number."""
import glob
import json

from pyspark.sql import functions as F

from contrail import schemas as S
from contrail.operators.audit import first_seen_codes
from contrail.operators.parse import parse_pages
from contrail.sources import documents as D


def page(codes):
    items = [{"AirportCode": c} for c in codes]
    return json.dumps({"AirportResource": {"Airports": {"Airport": items if len(items) != 1 else items[0]}}})


def write(spark, root, date, docs):
    rows = spark.createDataFrame([(str(n), page(codes)) for n, codes in docs.items()], "number string, raw_data string").repartition(3)
    return D.write_documents(rows, root, D.reference_document(F.lit("Airports"), F.lit(date), F.col("number")))


def test_newest_folder_and_order(spark, tmp_path):
    root = str(tmp_path)
    assert D.read_newest_documents(spark, root, "Airports").count() == 0
    write(spark, root, "2024-02-01", {0: ["OLD"]})
    write(spark, root, "zzz", {0: ["NO DATE"]})
    assert write(spark, root, "2024-10-01", {10: ["BBB", "CCC"], 9: ["AAA", "BBB"], "tail": ["DDD"], "list": ["EEE", "AAA"], 2: []}) == 5
    assert sorted(glob.glob("*", root_dir=f"{root}/Airports/2024-10-01")) == [
        "Airports_10.json", "Airports_2.json", "Airports_9.json", "Airports_list.json", "Airports_tail.json"]
    assert not glob.glob(f"{root}/_staged*")
    # Unreadable files elsewhere do no harm: the other folders are not scanned.
    for other in ("2024-02-01", "zzz"):
        with open(f"{root}/Airports/{other}/Airports_0.json", "wb") as f:
            f.write(b"\xff\xfe{")
    docs = D.read_newest_documents(spark, root, "Airports")
    assert {r.file_name: r.number for r in docs.collect()} == {
        "Airports_2.json": 2, "Airports_9.json": 9, "Airports_10.json": 10, "Airports_tail.json": None, "Airports_list.json": None}
    assert "2024-10-01" in docs._jdf.queryExecution().toString() and "2024-02-01" not in docs._jdf.queryExecution().toString()
    items = parse_pages(docs, S.AIRPORTS, keep=["number", "file_name"])
    order = {**D.document_order(), "pos": F.col("pos")}
    codes = first_seen_codes(items, F.col("item.AirportCode"), order).orderBy(*order)
    assert [r.code for r in codes.collect()] == ["AAA", "BBB", "CCC", "EEE", "DDD"]


def test_documents_are_replaced(spark, tmp_path):
    write(spark, str(tmp_path), "2024-10-01", {0: ["A"], 1: ["B"]})
    write(spark, str(tmp_path), "2024-10-01", {0: ["C"]})
    docs = D.read_newest_documents(spark, str(tmp_path), "Airports")
    assert {r.number: r.raw_data.strip() for r in docs.collect()} == {0: page(["C"]), 1: page(["B"])}


def test_flight_documents(spark, tmp_path):
    rows = [("F A", "2024-01-02", "08", 0, '{"a": 1}'), ("FRA", "2024-01-02", "12", 50, '{"b": 1}'), ("FRA", "2024-01-03", "00", 0, "{}")]
    pages = spark.createDataFrame(rows, "airport string, date string, hour string, offset long, raw_data string")
    root = str(tmp_path)
    assert D.write_documents(pages, root, D.flight_document(*map(F.col, ("airport", "date", "hour", "offset")))) == 3
    assert glob.glob(f"{root}/Flights/2024-01-02/12/*") == [f"{root}/Flights/2024-01-02/12/Flights_from_FRA_2024-01-02T12_offset_50.json"]
    got = sorted((r.airport_code, r.block, r.offset, r.raw_data.strip()) for r in D.read_flight_documents(spark, root, "2024-01-02").collect())
    assert got == [("F A", "2024-01-02T08:00", 0, '{"a": 1}'), ("FRA", "2024-01-02T12:00", 50, '{"b": 1}')]
    assert D.read_flight_documents(spark, root, "2024-01-09").count() == 0


def test_staged_files_are_listed_plainly(spark, tmp_path, monkeypatch):
    from py4j.java_gateway import JavaMember
    calls, call = [], JavaMember.__call__
    monkeypatch.setattr(JavaMember, "__call__", lambda self, *args: (calls.append(self.name), call(self, *args))[1])
    assert write(spark, str(tmp_path), "2024-10-01", {k: ["A"] for k in range(12)}) == 12
    assert "rename" in calls and "listFiles" not in calls  # located statuses ask for permissions, file by file
    assert len(glob.glob(f"{tmp_path}/Airports/2024-10-01/Airports_*.json")) == 12 and not glob.glob(f"{tmp_path}/_staged*")
