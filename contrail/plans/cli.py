"""Command-line entry points mirroring the reference's jobs.

    python -m contrail.plans.cli create --root R
    python -m contrail.plans.cli land-reference --root R --pages D --run-date 2024-01-31
    python -m contrail.plans.cli land-flights --root R --pages D --run-date 2024-01-31 [--repeat]
    python -m contrail.plans.cli silver-reference --root R
    python -m contrail.plans.cli silver-flights --root R [--dedupe]
    python -m contrail.plans.cli gold --root R --as-of 2024-01-31 [--refresh-days 1]
    python -m contrail.plans.cli daily-flights --root R --run-date 2024-01-31 --as-of 2024-01-31

``R`` is the lake folder created by :func:`contrail.plans.jobs.create_tables`
(``bronze/``, ``silver/``, ``gold/``). ``D`` holds saved pages:
``<container>/<date>/<container>_<offset>.json`` for reference pages, of which
the newest date is landed, and ``date=/hour=`` folders of page files for
departures. ``daily-flights`` merges the pages landed on the run date into the
flight table by date (``silver/flights_by_date``) and runs gold over the
touched dates. The session comes from
``spark-submit`` (or a local one when run directly).
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from contrail.plans import jobs
from contrail.operators.silver import SPECS
from contrail.operators.snapshot import latest_snapshot
from contrail.sources.pages import FLIGHT_PAGE_FILE_SCHEMA, read_page_documents, read_page_files
from contrail.sources.tables import read_or_empty


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="contrail")
    ap.add_argument("command", choices=["create", "land-reference", "land-flights", "silver-reference",
                                        "silver-flights", "gold", "daily-flights"])
    ap.add_argument("--root", required=True)
    ap.add_argument("--pages", help="folder of saved pages; required by the landing commands")
    ap.add_argument("--run-date", type=dt.date.fromisoformat, help="landing date; required where pages are landed or merged")
    ap.add_argument("--as-of", type=dt.date.fromisoformat, help="run date of gold; required by gold and daily-flights")
    ap.add_argument("--refresh-days", type=int, default=1)
    ap.add_argument("--dedupe", action="store_true")
    ap.add_argument("--repeat", action="store_true", help="landing replaces the run date's pages of the same place")
    a = ap.parse_args(argv)
    needed = {"gold": ["as_of"], "daily-flights": ["as_of", "run_date"],
              "land-reference": ["pages", "run_date"], "land-flights": ["pages", "run_date"]}
    for name in needed.get(a.command, []):
        if getattr(a, name) is None:
            ap.error(f"{a.command} needs --{name.replace('_', '-')}")
    spark = SparkSession.builder.appName(f"contrail-{a.command}").getOrCreate()

    def path(layer: str, name: str) -> str:
        return jobs.table_path(a.root, layer, name)

    if a.command == "create":
        for p in jobs.create_tables(spark, a.root):
            print(p)
    elif a.command == "land-reference":
        pages = latest_snapshot(read_page_documents(spark, a.pages), "date")
        print(*jobs.land_reference(spark, pages, a.root, a.run_date, a.repeat))
    elif a.command == "land-flights":
        jobs.land_departures(read_page_files(spark, a.pages, FLIGHT_PAGE_FILE_SCHEMA), a.root, a.run_date, a.repeat)
    elif a.command == "daily-flights":
        landed = jobs.read_layer(spark, a.root, "bronze", "flights").where(F.col("ingestion_date") == F.lit(a.run_date))
        touched = jobs.silverize_new_movements(landed, path("silver", "flights_by_date"))
        flights = read_or_empty(spark, path("silver", "flights_by_date"), jobs.MOVEMENTS_BY_DATE)
        print(jobs.goldenize(spark, flights, jobs.read_layer(spark, a.root, "silver", "airports"),
                             path("gold", "airports_daily_stats"), a.as_of, a.refresh_days, touched=touched))
    elif a.command == "silver-reference":
        for name in SPECS:
            done = jobs.silverize_entity(jobs.read_layer(spark, a.root, "bronze", name), name,
                                         path("silver", name), path("quarantine", name))
            print(name, "written" if done else "skipped: no bronze rows")
    elif a.command == "silver-flights":
        done = jobs.silverize_movements(jobs.read_layer(spark, a.root, "bronze", "flights"),
                                        path("silver", "flights"), a.dedupe, path("quarantine", "flights"))
        print("flights", "written" if done else "skipped: no bronze rows")
    else:
        run = jobs.goldenize(spark, jobs.read_layer(spark, a.root, "silver", "flights"),
                             jobs.read_layer(spark, a.root, "silver", "airports"),
                             path("gold", "airports_daily_stats"), a.as_of, a.refresh_days)
        print(run)


if __name__ == "__main__":
    main()
