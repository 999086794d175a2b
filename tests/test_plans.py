"""Physical plan checks: broadcasts where bounded, one shuffle for the stats, pruning."""
import os

from pyspark.sql import functions as F

from contrail.operators.snapshot import latest_snapshot
from contrail.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hourly_stats_plan(spark):
    p = plan(QUERIES["hourly_stats"](spark, SF))
    assert "BroadcastHashJoin" in p and "LeftSemi" in p
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    # The grid is generated after the exchanges: none lies above the union, and
    # what is exchanged on the grid's side are the (date, hour, salt) rows.
    above, below = p.split("Union", 1)
    assert "Exchange" not in above, p
    assert below.count("Exchange hashpartitioning") == 3, p
    grid = below[below.index("1 AS _in_dim"):]
    assert grid.index("BroadcastHashJoin [_salt") < grid.index("Exchange hashpartitioning"), p


def test_scan_prunes_columns_and_pushes_filters(spark):
    df = QUERIES["flight_facts"](spark, SF)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string>" in p


def test_latest_snapshot_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "bronze")
    df = spark.range(100).select(F.col("id").cast("string").alias("raw_data"),
                                 F.date_add(F.lit("2024-01-01").cast("date"),
                                            (F.col("id") % 5).cast("int")).alias("ingestion_date"))
    df.write.partitionBy("ingestion_date").parquet(path)
    latest = latest_snapshot(spark.read.parquet(path))
    assert latest.count() == 20
    p = plan(latest)
    assert "PartitionFilters: [isnotnull(ingestion_date" in p and "= Subquery subquery" in p, p
    assert len(os.listdir(path)) >= 5


def test_work_set_anti_join_broadcasts_done_set(spark):
    p = plan(QUERIES["work_set"](spark, SF))
    # the work set is checkpointed; its lineage plan is in the checkpointed RDD, so re-plan
    from contrail.operators import gold
    from contrail.plans import standins as si
    facts = gold.flight_facts(si.event_departures(spark, SF))
    p = plan(gold.work_set(facts, si.first_hour_done_set(facts), si.RUN_DATE, done_rows=1))
    assert "BroadcastHashJoin" in p and "LeftAnti" in p


def test_no_query_uses_cross_joins_or_python(spark):
    banned = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
              "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas")
    for key, q in QUERIES.items():
        p = plan(q(spark, SF))
        hits = [b for b in banned if b in p]
        assert not hits, (key, hits)


def test_gold_scan_of_dated_flights_prunes_to_the_touched_dates(spark, tmp_path):
    import datetime as dt

    from contrail.operators import gold
    from contrail.plans.jobs import MOVEMENTS_BY_DATE
    path = str(tmp_path / "flights")
    spark.range(9).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in MOVEMENTS_BY_DATE.fields if f.name != "date"],
        F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("date")
    ).write.partitionBy("date").parquet(path)
    facts = gold.flight_facts(spark.read.schema(MOVEMENTS_BY_DATE).parquet(path))
    p = plan(facts.where(F.col("date").isin([dt.date(2024, 1, 3)]) & (F.col("date") < F.lit(dt.date(2024, 1, 5)))))
    assert "PartitionFilters: [isnotnull(date" in p and "(date#" in p and "2024-01-03" in p, p


def one_line_tables(spark, tmp_path):
    spark.sql("select 1L l_orderkey, 1 l_linenumber, 2L l_partkey, 3L l_suppkey, 'R' l_returnflag, 'O' l_linestatus, "
              "timestamp_ntz'2024-01-02 03:04:05' l_shipdate").write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.sql("select 1L o_orderkey, 5L o_custkey, 'F' o_orderstatus, timestamp_ntz'2024-01-01 10:20:30' o_orderdate, "
              "'LOW' o_orderpriority").write.parquet(str(tmp_path / "orders.parquet"))
    return str(tmp_path)


def test_flatten_nested_parses_what_is_asked(spark, tmp_path):
    parsed = QUERIES["flatten_nested"](spark, one_line_tables(spark, tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    schema = parsed[parsed.index("from_json("):].split("\n")[0]
    assert "Gate" in schema and "ScheduledTimeLocal" not in schema and "OperatingCarrier" not in schema



def test_flight_pages_make_order_times_outside_lambdas(spark, tmp_path):
    from contrail.plans.standins import flight_pages
    pages = flight_pages(spark, one_line_tables(spark, tmp_path))
    text = pages.collect()[0].raw_data
    assert '"ScheduledTimeLocal":{"DateTime":"2024-01-01T10:20"},"ScheduledTimeUTC":{"DateTime":"2024-01-01T10:20Z"}' in text
    plan = pages._jdf.queryExecution().optimizedPlan().toString()
    lambdas = [line for line in plan.splitlines() if "lambdafunction(" in line]
    assert lambdas and all("_ordered" in line for line in lambdas)
    assert plan.count("minute(o_orderdate") == 1  # in the projection below them
