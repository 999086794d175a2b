"""contrail: a flight-operations lakehouse on PySpark.

Public entry points (DataFrame in, DataFrame out, unless noted):

* pages:   ``sources.pages.pack_pages / land_pages / land_flight_pages /
  write_page_files / read_page_files / read_page_documents``
* parse:   ``operators.parse.parse_pages / page_items / name_of``
* silver:  ``operators.silver.silver_entity / silver_movements``,
  ``operators.snapshot.latest_snapshot / dedupe_first``
* gold:    ``operators.gold.flight_facts / work_set / restrict_to_work_set /
  delay_by_key_hour / dense_grid / hourly_stats``
* audits:  ``operators.audit.classify_pages / page_gaps / page_audit /
  request_plan / first_seen_codes``
* jobs (write tables): ``plans.jobs.create_tables / land_reference /
  land_departures / silverize_entity / silverize_movements / goldenize``,
  ``plans.sinks.*``; command line: ``python -m contrail.plans.cli``
* streaming: ``streaming.incremental.*``
"""
