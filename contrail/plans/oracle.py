"""DuckDB SQL computing, from the same driver tables, what each query must return.

Written independently of the Spark code: stand-in derivations are restated
in SQL, and the rounded metrics use the same exact integer formulas.
"""

from __future__ import annotations

RUN_DATE = "DATE '2024-01-31'"
REFRESH_START = "DATE '2024-01-30'"

_FLIGHTS = """
ev_flights AS (
  SELECT CAST(event_id % 30 AS VARCHAR) AS airport_code,
         date_trunc('hour', ts) AS sched,
         CASE WHEN event_type <> 'error' THEN ts END AS actual
  FROM events
),
facts AS (
  SELECT airport_code,
         CAST(coalesce(actual, sched) AS DATE) AS date,
         CAST(hour(coalesce(actual, sched)) AS INTEGER) AS hour,
         epoch_us(actual) // 1000000 - epoch_us(sched) // 1000000 AS delay_seconds
  FROM ev_flights
  WHERE airport_code IS NOT NULL AND coalesce(actual, sched) IS NOT NULL
)"""

_WORK = _FLIGHTS + f""",
done AS (
  SELECT CAST(min(sched) AS DATE) AS date, CAST(hour(min(sched)) AS INTEGER) AS hour
  FROM ev_flights
),
cand AS (SELECT DISTINCT date, hour FROM facts WHERE date < {RUN_DATE}),
work AS (
  SELECT c.date, c.hour, c.date >= {REFRESH_START} AS refresh
  FROM cand c
  WHERE NOT EXISTS (SELECT 1 FROM done d
                    WHERE d.date = c.date AND d.hour = c.hour AND c.date < {REFRESH_START})
),
dim AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS airport_code,
         CAST(n_regionkey AS DOUBLE) AS longitude,
         CAST(n_nationkey AS DOUBLE) AS latitude
  FROM nation
)"""


def _mean(s: str, n: str) -> str:
    return (f"CASE WHEN {n} > 0 THEN CAST(sign({s}) * ((abs({s}) * 10 + 3 * {n}) // (6 * {n})) "
            f"AS DOUBLE) / 100.0 END")


def _pct(d: str, t: str) -> str:
    return (f"CASE WHEN coalesce({t}, 0) > 0 THEN CAST(({d} * 20000 + {t}) // (2 * {t}) AS DOUBLE)"
            f" / 100.0 ELSE 0.0 END")


def _agg(src: str) -> str:
    return f"""
  SELECT airport_code, date, hour,
         CAST(count(*) AS INTEGER) AS total_departures,
         sum(delay_seconds) AS s, count(delay_seconds) AS n,
         CAST(count(*) FILTER (WHERE delay_seconds > 900) AS INTEGER) AS delayed_flights
  FROM {src} GROUP BY airport_code, date, hour"""


_GOLD_FROM_WORK = f"""
agg AS ({_agg("(SELECT f.* FROM facts f JOIN work w ON f.date = w.date AND f.hour = w.hour)")})
SELECT d.airport_code, d.longitude, d.latitude,
       CAST(coalesce(a.total_departures, 0) AS INTEGER) AS total_departures,
       {_mean("a.s", "a.n")} AS average_departure_delay_minutes,
       CAST(coalesce(a.delayed_flights, 0) AS INTEGER) AS delayed_flights,
       {_pct("a.delayed_flights", "a.total_departures")} AS delayed_flights_percentage,
       w.date, CAST(w.hour AS INTEGER) AS hour
FROM dim d CROSS JOIN work w
LEFT JOIN agg a ON a.airport_code = d.airport_code AND a.date = w.date AND a.hour = w.hour"""


ORACLE: dict[str, str] = {
    "flight_facts": f"WITH {_FLIGHTS} SELECT airport_code, date, hour, delay_seconds FROM facts",
    "delay_by_key_hour": f"""WITH {_FLIGHTS}, agg AS ({_agg("facts")})
SELECT airport_code, date, hour, total_departures,
       {_mean("s", "n")} AS average_departure_delay_minutes, delayed_flights
FROM agg""",
    "work_set": f"WITH {_WORK} SELECT date, hour, refresh FROM work",
    "restrict_to_work_set": f"""WITH {_WORK}
SELECT f.airport_code, f.date, f.hour, f.delay_seconds
FROM facts f WHERE EXISTS (SELECT 1 FROM work w WHERE w.date = f.date AND w.hour = f.hour)""",
    "dense_grid": f"""WITH {_WORK}
SELECT d.airport_code, d.longitude, d.latitude, w.date, w.hour FROM dim d CROSS JOIN work w""",
    "hourly_stats": f"WITH {_WORK}, {_GOLD_FROM_WORK}",
}


def _offset_expected(k: str, n: str) -> str:
    h = f"CAST({n} % 13 AS DOUBLE)"
    m = f"CAST(({k} % 4) * 15 AS DOUBLE)"
    sg = f"(CASE WHEN {n} % 2 = 1 THEN -1.0 ELSE 1.0 END)::DOUBLE"
    return f"""(CASE {k} % 8
  WHEN 0 THEN {sg} * ({h} + {m} / 60.0::DOUBLE) + 0.0::DOUBLE
  WHEN 1 THEN {sg} * ({h} + {m} / 60.0::DOUBLE) + 0.0::DOUBLE
  WHEN 2 THEN {sg} * ({h} + {m} / 60.0::DOUBLE) + 0.0::DOUBLE
  WHEN 3 THEN {sg} * ({h} + 0.0::DOUBLE) + 0.0::DOUBLE
  WHEN 4 THEN {h} + 0.0::DOUBLE
  WHEN 5 THEN 0.0::DOUBLE
  WHEN 6 THEN NULL
  ELSE {h} + {m} / 60.0::DOUBLE + 0.0::DOUBLE END)"""


ORACLE.update({
    "silver_locations": f"""
SELECT CAST(s_suppkey AS VARCHAR) AS airport_code, CAST(s_nationkey AS DOUBLE) AS longitude,
       s_acctbal AS latitude, 'C' || CAST(s_nationkey AS VARCHAR) AS city_code,
       CAST(s_nationkey AS VARCHAR) AS country_code, 'Airport' AS location_type,
       s_name AS name, {_offset_expected("s_suppkey", "s_nationkey")} AS utc_offset,
       'Zone/' || CAST(s_nationkey AS VARCHAR) AS time_zone_id
FROM supplier WHERE s_suppkey % 10 <> 0""",
    "silver_cities": f"""
SELECT 'C' || CAST(c_custkey AS VARCHAR) AS city_code, CAST(c_nationkey AS VARCHAR) AS country_code,
       c_name AS name, {_offset_expected("c_custkey", "c_nationkey")} AS utc_offset,
       c_mktsegment AS time_zone_id
FROM customer""",
    "silver_countries": """
SELECT CAST(o_orderkey AS VARCHAR) AS country_code, o_orderpriority AS name FROM orders""",
    "silver_airlines": """
SELECT CAST(c_custkey AS VARCHAR) AS airline_id, c_mktsegment AS airline_id_icao, c_name AS name
FROM customer""",
    "silver_aircraft": """
SELECT CAST(p_partkey AS VARCHAR) AS aircraft_code, p_name AS name, p_brand AS airline_equip_code
FROM part""",
})


_MOVEMENTS = """
SELECT CAST(l_suppkey AS VARCHAR) AS departure_airport_code,
       date_trunc('minute', o_orderdate) AS departure_scheduled_time_local,
       date_trunc('minute', o_orderdate) AS departure_scheduled_time_utc,
       CASE WHEN l_returnflag = 'R' THEN NULL ELSE date_trunc('minute', l_shipdate) END
         AS departure_actual_time_local,
       CASE WHEN l_returnflag = 'R' THEN NULL ELSE date_trunc('minute', l_shipdate) END
         AS departure_actual_time_utc,
       l_linestatus AS departure_time_status_code,
       l_returnflag AS departure_time_status_definition,
       'T' || CAST(l_linenumber AS VARCHAR) AS departure_terminal_name,
       CAST(l_partkey % 100 AS VARCHAR) AS departure_terminal_gate,
       CAST(o_custkey AS VARCHAR) AS arrival_airport_code,
       date_trunc('minute', l_shipdate) AS arrival_scheduled_time_local,
       NULL::TIMESTAMP AS arrival_scheduled_time_utc,
       NULL::TIMESTAMP AS arrival_actual_time_local,
       NULL::TIMESTAMP AS arrival_actual_time_utc,
       NULL::VARCHAR AS arrival_time_status_code,
       NULL::VARCHAR AS arrival_time_status_definition,
       NULL::VARCHAR AS arrival_terminal_name,
       NULL::VARCHAR AS arrival_terminal_gate,
       'MC' AS marketing_carrier_airline_id,
       CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR)
         AS marketing_carrier_flight_number,
       o_orderpriority AS operating_carrier_airline_id,
       CAST(l_linenumber AS VARCHAR) AS operating_carrier_flight_number,
       CAST(l_partkey AS VARCHAR) AS equipment_aircraft_code,
       NULL::VARCHAR AS equipment_aircraft_registration,
       o_orderstatus AS flight_status_code,
       NULL::VARCHAR AS flight_status_definition,
       'Passenger' AS service_type
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

_EVENT_ITEMS = """
ev_items AS (
  SELECT CAST(ts AS DATE) AS ingestion_date, CAST((event_id // 100) * 100 AS INTEGER) AS offset,
         CAST(row_number() OVER (PARTITION BY CAST(ts AS DATE), event_id // 100
                                 ORDER BY event_id) - 1 AS INTEGER) AS pos,
         CAST(user_id AS VARCHAR) AS airline_id, event_type AS airline_id_icao,
         CAST(event_id AS VARCHAR) AS name, event_id
  FROM events
),
latest AS (SELECT * FROM ev_items WHERE ingestion_date = (SELECT max(ingestion_date) FROM ev_items))"""

ORACLE.update({
    "silver_movements": _MOVEMENTS,
    "flatten_nested": f"""
SELECT departure_airport_code, departure_terminal_name, departure_terminal_gate,
       departure_time_status_code, arrival_airport_code, marketing_carrier_flight_number,
       equipment_aircraft_code, flight_status_code
FROM ({_MOVEMENTS})""",
    "parse_pages": """
SELECT CAST((o_orderkey // 100) * 100 AS INTEGER) AS offset,
       CAST(row_number() OVER (PARTITION BY o_orderkey // 100 ORDER BY o_orderkey) - 1 AS INTEGER)
         AS pos,
       CAST(o_orderkey AS VARCHAR) AS country_code, o_orderpriority AS name
FROM orders""",
    "land_pages": f"""
SELECT {RUN_DATE} AS ingestion_date, {RUN_DATE} AS data_date,
       CAST((o_orderkey // 100) * 100 AS INTEGER) AS offset,
       CAST(count(*) AS INTEGER) AS items, (SELECT count(*) FROM orders) AS total
FROM orders GROUP BY o_orderkey // 100""",
    "land_flight_pages": f"""
SELECT {RUN_DATE} AS ingestion_date, CAST(ts AS DATE) AS data_date,
       lpad(CAST(hour(ts) - hour(ts) % 4 AS VARCHAR), 2, '0') AS data_time_block,
       CAST(event_id % 30 AS VARCHAR) AS airport_code,
       CAST((event_id // 1500) * 50 AS INTEGER) AS offset, CAST(count(*) AS INTEGER) AS items
FROM events
GROUP BY CAST(ts AS DATE), hour(ts) - hour(ts) % 4, event_id % 30, event_id // 1500""",
    "one_or_many": """
SELECT c_mktsegment, c_nationkey, c_custkey // 100 AS page,
       CAST(row_number() OVER w - 1 AS INTEGER) AS pos,
       CAST(count(*) OVER w2 AS INTEGER) AS n_items,
       CAST(c_custkey AS VARCHAR) AS airline_id, c_name AS name
FROM customer
WINDOW w AS (PARTITION BY c_mktsegment, c_nationkey, c_custkey // 100 ORDER BY c_custkey),
       w2 AS (PARTITION BY c_mktsegment, c_nationkey, c_custkey // 100)""",
    "parse_times": """
SELECT event_id,
       CASE WHEN event_type = 'error' THEN NULL ELSE date_trunc('minute', ts) END AS local_time,
       CASE WHEN event_type = 'view' THEN NULL ELSE date_trunc('minute', ts) END AS utc_time
FROM events""",
    "utc_offset_hours": f"""
SELECT c_custkey, {_offset_expected("c_custkey", "c_nationkey")} AS utc_offset FROM customer""",
    "time_block_4h": """
SELECT event_id,
       strftime(ts, '%Y-%m-%d') || 'T' || lpad(CAST(hour(ts) - hour(ts) % 4 AS VARCHAR), 2, '0')
         || ':00' AS block,
       strftime(CAST(ts AS DATE) - INTERVAL 1 DAY, '%Y-%m-%d') || 'T'
         || lpad(CAST(hour(ts) - hour(ts) % 4 AS VARCHAR), 2, '0') || ':00' AS previous_block,
       CAST(ts AS DATE) AS block_date
FROM events""",
    "latest_snapshot": f"""WITH {_EVENT_ITEMS}
SELECT ingestion_date, "offset", pos, airline_id, airline_id_icao, name FROM latest""",
    "dedupe_latest": f"""WITH {_EVENT_ITEMS}
SELECT airline_id, airline_id_icao, name FROM (
  SELECT *, row_number() OVER (PARTITION BY airline_id ORDER BY "offset", pos) AS rn FROM latest)
WHERE rn = 1""",
})


_GAPPED = f"""
ev AS (SELECT CAST(event_id % 30 AS VARCHAR) AS airport_code, event_id // 30 AS p FROM events),
totals AS (SELECT airport_code, count(*) AS total FROM ev GROUP BY airport_code),
pages AS (SELECT airport_code, p // 50 AS page, count(*) AS n FROM ev GROUP BY airport_code, p // 50),
landed AS (SELECT * FROM pages WHERE page % 7 <> 6)"""

ORACLE.update({
    "classify_pages": """
SELECT event_id,
       CASE event_type WHEN 'view' THEN 'ok' WHEN 'click' THEN 'rate_limited'
         WHEN 'signup' THEN (CASE WHEN user_id % 2 = 0 THEN 'not_found' ELSE 'processing_error' END)
         WHEN 'purchase' THEN 'error' ELSE 'malformed' END AS status,
       CASE event_type WHEN 'click' THEN 'Account Over Queries Per Second Limit'
         WHEN 'signup' THEN 'BusinessError' WHEN 'purchase' THEN 'invalid_token' END AS detail
FROM events""",
    "page_gaps": f"""WITH {_GAPPED},
expected AS (SELECT airport_code, unnest(generate_series(0, total - 1, 50)) AS o FROM totals)
SELECT e.airport_code, {RUN_DATE} AS ingestion_date, CAST(e.o AS BIGINT) AS "offset"
FROM expected e
WHERE NOT EXISTS (SELECT 1 FROM landed l WHERE l.airport_code = e.airport_code AND l.page * 50 = e.o)""",
    "page_audit": f"""WITH {_GAPPED}
SELECT l.airport_code, {RUN_DATE} AS ingestion_date, count(*) AS pages,
       CAST(sum(l.n) AS BIGINT) AS fetched, max(t.total) AS announced,
       greatest(max(t.total) - CAST(sum(l.n) AS BIGINT), 0) AS missing,
       CAST(sum(l.n) AS BIGINT) >= max(t.total) AS complete
FROM landed l JOIN totals t USING (airport_code) GROUP BY l.airport_code""",
    "request_plan": f"""
WITH codes AS (SELECT DISTINCT CAST(s_suppkey AS VARCHAR) AS airport_code FROM supplier
               WHERE s_suppkey % 10 <> 0),
blocks AS (SELECT strftime({RUN_DATE} - INTERVAL 1 DAY, '%Y-%m-%d') || 'T'
                  || lpad(CAST(h * 4 AS VARCHAR), 2, '0') || ':00' AS block
           FROM range(6) t(h)),
landed AS (SELECT DISTINCT CAST(event_id % 30 AS VARCHAR) AS airport_code,
                  strftime(ts, '%Y-%m-%d') || 'T' || lpad(CAST(hour(ts) - hour(ts) % 4 AS VARCHAR), 2, '0')
                  || ':00' AS block FROM events)
SELECT c.airport_code, b.block FROM codes c CROSS JOIN blocks b
WHERE NOT EXISTS (SELECT 1 FROM landed l WHERE l.airport_code = c.airport_code AND l.block = b.block)""",
    "latest_entity_codes": f"""WITH {_EVENT_ITEMS}
SELECT airline_id AS code, CAST("offset" AS BIGINT) AS first_offset, pos AS first_pos FROM (
  SELECT *, row_number() OVER (PARTITION BY airline_id ORDER BY "offset", pos) AS rn FROM latest)
WHERE rn = 1""",
    "page_files_roundtrip": f"""
SELECT 'Airports' AS entity, {RUN_DATE} AS date, CAST(s_suppkey AS VARCHAR) AS code, s_name AS name
FROM supplier
UNION ALL
SELECT 'Cities', {RUN_DATE}, 'C' || CAST(c_custkey AS VARCHAR), c_name FROM customer""",
})


_FULL_GOLD = f"""WITH {_FLIGHTS},
work AS (SELECT DISTINCT date, hour FROM facts WHERE date < {RUN_DATE}),
dim AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS airport_code, CAST(n_regionkey AS DOUBLE) AS longitude,
         CAST(n_nationkey AS DOUBLE) AS latitude
  FROM nation
), {_GOLD_FROM_WORK}"""

ORACLE.update({
    "gold_append_then_refresh": _FULL_GOLD,
    "purge_null_hour": _FULL_GOLD,
})


ORACLE["medallion_airport_hours"] = f"""
WITH flights AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS airport_code,
         date_trunc('minute', o_orderdate) AS sched,
         CASE WHEN l_returnflag = 'R' THEN NULL ELSE date_trunc('minute', l_shipdate) END AS actual
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
),
facts AS (
  SELECT airport_code, CAST(coalesce(actual, sched) AS DATE) AS date,
         CAST(hour(coalesce(actual, sched)) AS INTEGER) AS hour,
         epoch_us(actual) // 1000000 - epoch_us(sched) // 1000000 AS delay_seconds
  FROM flights WHERE coalesce(actual, sched) IS NOT NULL
),
work AS (SELECT DISTINCT date, hour FROM facts WHERE date < {RUN_DATE}),
dim AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS airport_code, CAST(s_nationkey AS DOUBLE) AS longitude,
         s_acctbal AS latitude
  FROM supplier WHERE s_suppkey % 10 <> 0
), {_GOLD_FROM_WORK}"""


ORACLE["silver_entity"] = """
SELECT 'cities' AS entity, 'C' || CAST(c_custkey AS VARCHAR) AS key, c_name AS name FROM customer
UNION ALL SELECT 'countries', CAST(o_orderkey AS VARCHAR), o_orderpriority FROM orders
UNION ALL SELECT 'airlines', CAST(c_custkey AS VARCHAR), c_name FROM customer
UNION ALL SELECT 'aircraft_summaries', CAST(p_partkey AS VARCHAR), p_name FROM part"""

# Some orders hold two lines of one number and supplier, which is one flight: the first on its page stays.
_UNIQUE_MOVEMENTS = _MOVEMENTS.replace("FROM lineitem JOIN orders", """FROM (
  SELECT * FROM lineitem QUALIFY row_number() OVER (
    PARTITION BY l_orderkey, l_linenumber, l_suppkey ORDER BY l_partkey, l_returnflag, l_linestatus, l_shipdate) = 1)
JOIN orders""")
ORACLE["silver_movements_incremental"] = _UNIQUE_MOVEMENTS
ORACLE["catalog_tables"] = ORACLE["silver_countries"]
ORACLE["quarantine_pages"] = f"""SELECT * FROM ({ORACLE["classify_pages"]}) WHERE status <> 'ok'"""

ORACLE["gold_from_dated_flights"] = _FULL_GOLD.replace("THEN ts END", "THEN date_trunc('minute', ts) END")
ORACLE["gold_refresh_empty"] = f"SELECT * FROM ({_FULL_GOLD}) WHERE date < {REFRESH_START}"
ORACLE["silver_movements_dedupe"] = """
SELECT 'EV' AS marketing_carrier_airline_id,
       CASE WHEN event_type <> 'signup' THEN CAST(event_id AS VARCHAR) END AS marketing_carrier_flight_number,
       CAST(event_id % 30 AS VARCHAR) AS departure_airport_code,
       date_trunc('hour', ts) AS departure_scheduled_time_utc, gate AS departure_terminal_gate
FROM events, (VALUES ('old'), ('new')) AS g(gate)
WHERE gate = 'new' OR event_type = 'signup'"""
ORACLE["dedupe_relanded"] = f"""
SELECT a.*, o.input_order FROM ({ORACLE["silver_airlines"]}) AS a, (VALUES ('ab'), ('ba')) AS o(input_order)"""
ORACLE["flight_files_roundtrip"] = ORACLE["land_flight_pages"]
ORACLE["flight_facts_nulls"] = f"SELECT * FROM ({ORACLE['flight_facts']}) WHERE airport_code NOT IN ('7', '8')"
ORACLE["work_set_mid_month"] = (ORACLE["work_set"].replace(RUN_DATE, "DATE '2024-01-16'")
                                .replace(REFRESH_START, "DATE '2024-01-15'"))
ORACLE["silver_null_keys"] = f"SELECT * FROM ({ORACLE['silver_airlines']}) WHERE CAST(airline_id AS INTEGER) % 5 <> 0"
ORACLE["silver_movements_indexed"] = f"""
SELECT *, CAST(coalesce(departure_actual_time_local, departure_scheduled_time_local) AS DATE) AS date
FROM ({_UNIQUE_MOVEMENTS})"""
ORACLE["gold_late_corrections"] = ORACLE["gold_from_dated_flights"]
ORACLE["page_gap_ranges"] = f"""WITH {_GAPPED},
expected AS (SELECT airport_code, unnest(generate_series(0, (total - 1) // 50)) AS page FROM totals),
missing AS (
  SELECT e.airport_code, e.page FROM expected e
  WHERE NOT EXISTS (SELECT 1 FROM landed l
                    WHERE l.airport_code = e.airport_code AND l.page = e.page AND (l.page // 3) % 4 <> 2)),
known AS (SELECT DISTINCT airport_code FROM landed),
islands AS (
  SELECT *, page - row_number() OVER (PARTITION BY airport_code ORDER BY page) AS island
  FROM missing JOIN known USING (airport_code))
SELECT airport_code, {RUN_DATE} AS ingestion_date, CAST(min(page) * 50 AS BIGINT) AS first,
       CAST(max(page) * 50 AS BIGINT) AS last, count(*) AS pages
FROM islands GROUP BY airport_code, island"""
ORACLE["page_audit_relanded"] = ORACLE["page_audit"]
ORACLE["page_audit_distinct"] = """
SELECT event_type, count(*) FILTER (event_id % 3 <> 1) AS fetched, count(*) AS announced,
       count(*) FILTER (event_id % 3 = 1) AS missing, count(*) FILTER (event_id % 3 = 1) = 0 AS complete
FROM events GROUP BY event_type HAVING count(*) FILTER (event_id % 3 <> 1) > 0"""
ORACLE["page_documents_latest"] = f"""
WITH items AS (
  SELECT c_custkey AS id, c_custkey // 100 AS page FROM customer
  UNION ALL SELECT c_custkey, c_custkey // 100 - 1 FROM customer WHERE c_custkey % 100 = 0 AND c_custkey >= 100),
placed AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY page ORDER BY id) - 1 AS INTEGER) AS pos, max(page) OVER () AS last FROM items),
seen AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY page) AS rn FROM placed)
SELECT 'C' || CAST(id AS VARCHAR) AS code, page = last AS unnumbered, CASE WHEN page < last THEN page END AS number,
       'Cities_' || CASE WHEN page < last THEN CAST(page AS VARCHAR) ELSE 'last' END || '.json' AS file_name,
       pos, {RUN_DATE} AS date
FROM seen WHERE rn = 1"""
ORACLE["flight_documents"] = """
SELECT CAST(ts AS DATE) AS data_date, lpad(CAST(hour(ts) - hour(ts) % 4 AS VARCHAR), 2, '0') AS data_time_block,
       CAST(event_id % 3 AS VARCHAR) AS airport_code, 50 AS "offset", CAST(count(*) AS INTEGER) AS items
FROM events WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)
GROUP BY ALL"""
ORACLE["stream_hourly_stats"] = f"""
WITH {_FLIGHTS.replace("THEN ts END", "THEN date_trunc('minute', ts) END")},
closed AS (SELECT max(coalesce(actual, sched)) - INTERVAL 2 DAY AS until FROM ev_flights),
agg AS ({_agg("facts")})
SELECT airport_code, date, hour, total_departures, {_mean("s", "n")} AS average_departure_delay_minutes, delayed_flights
FROM agg, closed WHERE date + to_hours(hour + 1) <= until"""
ORACLE["schema_drift"] = """
WITH ev AS (SELECT CAST(ts AS DATE) AS d, day(ts) AS n, event_type AS t FROM events),
days AS (SELECT d, n, count(*) AS items, count(*) FILTER (t = 'view') AS views, count(*) FILTER (t = 'purchase') AS purchases,
                count(*) FILTER (t = 'signup') AS signups FROM ev GROUP BY d, n)
SELECT d AS ingestion_date, 'AirlineID' AS path, CASE WHEN views = items THEN 'BIGINT' ELSE 'VARIANT' END AS observed,
       items, 'type' AS status FROM days WHERE n % 2 = 1 AND views > 0
UNION ALL SELECT d, 'Alliance', CASE WHEN n % 2 = 0 THEN 'OBJECT<Code: BIGINT>' ELSE 'STRING' END, purchases, 'unknown'
FROM days WHERE purchases > 0
UNION ALL SELECT d, 'Names.Short', 'STRING', signups, 'unknown' FROM days WHERE signups > 0
UNION ALL SELECT d, 'AirlineID_ICAO', NULL, 0, 'missing' FROM days WHERE n % 3 = 0"""
ORACLE["silver_entity_history"] = """
WITH landed(seq, d) AS (VALUES (1, DATE '2024-01-01'), (2, DATE '2024-01-11'), (3, DATE '2024-01-21'), (4, DATE '2024-01-31')),
rows AS (
  SELECT c_custkey AS id, seq, d, c_mktsegment AS icao,
         CASE WHEN seq = 1 OR (seq < 4 AND c_custkey % 3 = 0) THEN 'old ' ELSE '' END || c_name AS name
  FROM customer, landed
  WHERE (seq <> 1 OR c_custkey % 5 <> 0) AND (seq <> 3 OR c_custkey % 7 <> 0) AND (seq <> 4 OR c_custkey % 11 <> 0)),
marked AS (
  SELECT *, CASE WHEN lag(seq) OVER w = seq - 1 AND lag(name) OVER w = name THEN 0 ELSE 1 END AS starts
  FROM rows WINDOW w AS (PARTITION BY id ORDER BY seq)),
periods AS (SELECT *, sum(starts) OVER (PARTITION BY id ORDER BY seq) AS p FROM marked)
SELECT CAST(id AS VARCHAR) AS airline_id, min(icao) AS airline_id_icao, min(name) AS name, min(d) AS valid_from,
       (SELECT l.d FROM landed l WHERE l.seq = max(periods.seq) + 1) AS valid_to
FROM periods GROUP BY id, p"""
ORACLE["silver_refresh_skips"] = """
SELECT CAST(step AS INTEGER) AS step, status, (SELECT count(DISTINCT o_orderkey) FROM orders) AS table_rows
FROM (VALUES (1, 'written'), (2, 'skipped'), (3, 'written'), (4, 'skipped')) AS r(step, status)"""
ORACLE["movements_survivorship"] = """
SELECT 'EV' AS marketing_carrier_airline_id, CAST(event_id AS VARCHAR) AS marketing_carrier_flight_number,
       CAST(event_id % 30 AS VARCHAR) AS departure_airport_code, date_trunc('hour', ts) AS departure_scheduled_time_utc,
       CASE WHEN event_id % 2 = 1 THEN 'old' ELSE 'new' END AS departure_terminal_gate,
       CASE WHEN event_type <> 'error' THEN date_trunc('minute', ts) END AS departure_actual_time_local,
       CASE WHEN event_id % 2 = 1 THEN DATE '2024-01-01' ELSE DATE '2024-01-31' END AS gate_landed,
       CASE WHEN event_type = 'error' THEN NULL WHEN event_id % 3 = 1 THEN DATE '2024-01-01' ELSE DATE '2024-01-31' END AS time_landed,
       CAST((event_id // 1500) * 50 AS INTEGER) AS gate_offset
FROM events WHERE event_type <> 'signup'"""
# Hours of the first run (before the 16th, not 5, 11, 17 or 23) count the flights it knew, the others all flights.
ORACLE["gold_frozen_hours"] = f"""WITH {_FLIGHTS.replace("facts AS", "all_facts AS").replace(
    "SELECT airport_code,\n         CAST(coalesce", "SELECT airport_code, minute(coalesce(actual, sched)) AS minute,\n         CAST(coalesce")},
known AS (SELECT DISTINCT date, hour FROM all_facts WHERE date < DATE '2024-01-16' AND hour % 6 <> 5 AND minute < 40),
facts AS (
  SELECT f.airport_code, f.date, f.hour, f.delay_seconds FROM all_facts f
  LEFT JOIN known k ON f.date = k.date AND f.hour = k.hour
  WHERE k.date IS NULL OR f.minute < 40),
work AS (SELECT DISTINCT date, hour FROM facts WHERE date < {RUN_DATE}),
dim AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS airport_code, CAST(n_regionkey AS DOUBLE) AS longitude,
         CAST(n_nationkey AS DOUBLE) AS latitude
  FROM nation
), {_GOLD_FROM_WORK}"""
ORACLE["land_pages_repeated"] = f"""
SELECT d AS ingestion_date, p.* REPLACE (prefix || name AS name)
FROM ({ORACLE["parse_pages"]}) AS p, (VALUES (DATE '2024-01-01', 'old '), ({RUN_DATE}, '')) AS l(d, prefix)"""
