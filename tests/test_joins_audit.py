"""Size-checked broadcast, replicated product fallback, request plan and quarantine."""
import json

from pyspark.sql import functions as F

from contrail import schemas as S
from contrail.operators.audit import page_audit, request_plan, split_quarantine
from contrail.operators.joins import maybe_broadcast, replicated_product


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_broadcast_only_within_measured_bound(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = spark.range(1000).withColumnRenamed("id", "k")
        small = spark.range(10).withColumnRenamed("id", "k")
        assert "BroadcastHashJoin" in plan(big.join(maybe_broadcast(small, 10, 100), "k"))
        assert "BroadcastHashJoin" not in plan(big.join(maybe_broadcast(small, 10, 5), "k"))
        assert "BroadcastHashJoin" not in plan(big.join(maybe_broadcast(small, None), "k"))
        # One bigint column: 24 bytes a row; 64 MB are reached long before the limit in rows.
        assert "BroadcastHashJoin" not in plan(big.join(maybe_broadcast(small, 3_000_000, 10**9), "k"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_replicated_product_is_complete_both_ways(spark):
    a = spark.range(37).select(F.col("id").alias("a"))
    b = spark.range(11).select(F.col("id").alias("b"))
    for max_rows in (100, 5):  # broadcast path, then bucketed shuffle path
        p = replicated_product(a, b, 11, max_broadcast_rows=max_rows, buckets=4, big_rows=37)
        rows = {(r.a, r.b) for r in p.collect()}
        assert len(rows) == 37 * 11 and p.count() == 37 * 11
        assert "CartesianProduct" not in plan(p) and "NestedLoop" not in plan(p)


def test_request_plan_skips_landed(spark):
    codes = spark.createDataFrame([("FRA",), ("MUC",), ("FRA",)], "airport_code string")
    blocks = spark.createDataFrame([("2024-01-01T00:00",), ("2024-01-01T04:00",)], "block string")
    landed = spark.createDataFrame([("FRA", "2024-01-01T00:00")], "airport_code string, block string")
    got = {(r.airport_code, r.block) for r in request_plan(codes, blocks, landed, 2).collect()}
    assert got == {("FRA", "2024-01-01T04:00"), ("MUC", "2024-01-01T00:00"),
                   ("MUC", "2024-01-01T04:00")}


def test_quarantine_and_audit(spark):
    good = json.dumps({"CountryResource": {"Countries": {"Country": [{"CountryCode": "DE"}, {"CountryCode": "FR"}]},
                                           "Meta": {"TotalCount": 3}}})
    df = spark.createDataFrame([(good, 0, "x"), ("{bad", 100, "x"), ('{"error":"e"}', 200, "x")],
                               "raw_data string, offset int, g string")
    ok, bad = split_quarantine(df, S.COUNTRIES)
    assert ok.count() == 1 and sorted(r.status for r in bad.collect()) == ["error", "malformed"]
    a = page_audit(ok, S.COUNTRIES, ["g"]).first()
    assert (a.pages, a.fetched, a.announced, a.missing, a.complete) == (1, 2, 3, 1, False)


def test_replicated_product_spreads_large_outputs(spark, monkeypatch):
    from contrail.operators import joins
    a = spark.range(37).select(F.col("id").alias("a")).coalesce(1)
    b = spark.range(11).select(F.col("id").alias("b"))
    monkeypatch.setattr(joins, "ROWS_PER_TASK", 10)
    spread = joins.replicated_product(a, b, 11, big_rows=37)
    assert spread.rdd.getNumPartitions() == 37 and spread.count() == 407
    monkeypatch.setattr(joins, "ROWS_PER_TASK", 4_000_000)
    assert joins.replicated_product(a, b, 11, big_rows=37).rdd.getNumPartitions() == 1


def total_pages(spark, rows):
    """Pages of (group, offset, announced total, items)."""
    def page(total, n):
        meta = "" if total is None else f', "Meta": {{"TotalCount": {total}}}'
        items = ",".join('{"CountryCode": "%d"}' % i for i in range(n))
        return f'{{"CountryResource": {{"Countries": {{"Country": [{items}]}}{meta}}}}}'
    return spark.createDataFrame([(g, o, page(t, n)) for g, o, t, n in rows], "g string, offset long, raw_data string")


def test_page_gap_ranges(spark, monkeypatch):
    from contrail.operators import audit
    rows = [("huge", 50, 10**10, 1),                                        # a total costs no more than its pages
            ("full", 0, 120, 1), ("full", 50, 120, 1), ("full", 100, 120, 1),
            ("mixed", 100, 1000, 1), ("mixed", 100, 1000, 1), ("mixed", 150, 1000, 1), ("mixed", 400, 1000, 1),
            ("mixed", 410, 1000, 1), ("mixed", 1000, 1000, 1), ("mixed", -50, 1000, 1), ("mixed", 900, 1000, 1),
            ("unknown", 0, None, 1), ("nothing", 0, 0, 0), ("elsewhere", 7, 101, 1), (None, 0, 60, 1)]
    pages = total_pages(spark, rows)
    want = sorted([("huge", 0, 0, 1), ("huge", 100, 10**10 - 50, 2 * 10**8 - 2), ("mixed", 0, 50, 2), ("mixed", 200, 350, 4),
                   ("mixed", 450, 850, 9), ("mixed", 950, 950, 1), ("unknown", None, None, None), ("elsewhere", 0, 100, 3),
                   (None, 50, 50, 1)], key=str)
    for size in (1, 3, 4096):  # windows that end between any two pages
        monkeypatch.setattr(audit, "PAGES_PER_WINDOW", size)
        assert sorted((tuple(r) for r in audit.page_gap_ranges(pages, S.COUNTRIES, ["g"], 50).collect()), key=str) == want
    small = pages.where("g <> 'huge'")
    offsets = {(r.g, o) for r in audit.page_gap_ranges(small, S.COUNTRIES, ["g"], 50).collect()
               if r.first is not None for o in range(r.first, r.last + 1, 50)}
    assert offsets == {(r.g, r.offset) for r in audit.page_gaps(small, S.COUNTRIES, ["g"], 50).where("offset is not null").collect()}


def test_relanded_offsets_count_once(spark):
    from contrail.operators.audit import page_audit
    rows = [("a", 0, 4, 2), ("a", 0, 4, 2), ("b", 0, 3, 1), ("b", 0, 3, 2), ("b", 2, 3, 1), ("c", None, 4, 2), ("c", None, 4, 2)]
    got = sorted(tuple(r) for r in page_audit(total_pages(spark, rows), S.COUNTRIES, ["g"]).collect())
    assert got == [("a", 1, 2, 4, 2, False), ("b", 2, 3, 3, 0, True), ("c", 2, 4, 4, 0, True)]


def test_distinct_keys_over_days(spark):
    from pyspark.sql import functions as F
    from contrail.operators.audit import announced_totals, item_key_bitmaps, merged_bitmaps, page_audit_distinct
    pages = total_pages(spark, [("a", 0, 5, 3), ("a", 0, 5, 3), ("a", 3, 5, 5), ("b", 0, 4, 2), ("c", 0, 2, 0), ("d", 0, None, 1)])
    bits = item_key_bitmaps(pages.withColumn("day", F.col("offset")), S.COUNTRIES, ["g", "day"], F.col("item.CountryCode"))
    got = sorted(tuple(r) for r in page_audit_distinct(bits, announced_totals(pages, S.COUNTRIES, ["g"]), ["g"]).collect())
    assert got == [("a", 5, 5, 0, True), ("b", 2, 4, 2, False), ("c", 0, 2, 2, False), ("d", 1, None, None, False)]
    assert merged_bitmaps(bits, []).agg(F.sum(F.bitmap_count("bits"))).first()[0] == 5
