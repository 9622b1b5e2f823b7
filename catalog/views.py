"""The given tables seen as surveys.

``lineitem`` rows are tows, ``orders`` station visits, ``events`` a long
laboratory feed. The given tables hold no NULL, so some are put in by key.
"""

from catalog.core import VIEWS

VIEWS["tows"] = """
SELECT l_orderkey AS sample, l_suppkey AS station, l_partkey AS gear, l_linenumber AS tow,
       l_quantity AS depth, l_extendedprice AS measure, l_discount AS rate, l_tax AS share,
       l_returnflag AS flag, l_linestatus AS status, l_shipdate AS time, CAST(l_shipdate AS DATE) AS day
FROM {lineitem}
"""
VIEWS["gappy_tows"] = """
SELECT sample, station, gear, tow, rate, flag, status, time, day,
       CASE WHEN (sample + gear) % 53 = 0 THEN NULL ELSE depth END AS depth,
       CASE WHEN gear % 5 = 0 THEN NULL ELSE measure END AS measure,
       CASE WHEN gear % 10 < 3 THEN NULL ELSE share END AS share,
       CASE WHEN gear % 7 = 0 THEN NULL ELSE flag END AS maybe_flag,
       CASE WHEN sample % 19 = 0 THEN NULL ELSE station END AS maybe_station
FROM {tows}
"""
VIEWS["readings"] = """
SELECT event_id AS code, user_id AS station, event_type AS analyte, value AS result, ts AS time,
       CAST(ts AS DATE) AS day,
       CASE WHEN event_id % 9 = 0 THEN NULL ELSE value END AS maybe_result,
       CASE WHEN event_id % 17 = 0 THEN NULL ELSE user_id END AS maybe_station,
       CASE WHEN event_id % 6 = 0 THEN NULL ELSE event_type END AS maybe_analyte
FROM {events}
"""
VIEWS["lab_text"] = """
SELECT event_id AS code, user_id AS station, event_type AS analyte, CAST(ts AS DATE) AS day, ts AS time,
       CASE WHEN event_id % 5 = 0 THEN concat('<', CAST(value AS STRING))
            WHEN event_id % 23 = 0 THEN 'N.S.'
            WHEN event_id % 29 = 0 THEN NULL
            ELSE CAST(value AS STRING) END AS result,
       CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST(value / 2 AS STRING) END AS rl,
       CASE WHEN event_id % 4 = 0 THEN 'ug/L' WHEN event_id % 4 = 1 THEN 'deg F' ELSE 'mg/L' END AS units,
       CASE WHEN event_id % 8 = 0 THEN 'Not Detected' WHEN event_id % 8 = 1 THEN NULL ELSE 'Detected' END AS detection,
       CASE WHEN event_id % 10 = 3 THEN 'Estimated' WHEN event_id % 10 = 4 THEN NULL ELSE 'Actual' END AS value_type,
       CASE WHEN event_id % 12 = 0 THEN 'Lab Duplicate' WHEN event_id % 3 = 0 THEN NULL ELSE 'ok' END AS notes,
       value
FROM {events}
"""
VIEWS["visits"] = """
SELECT o_orderkey AS code, o_custkey AS station, o_orderstatus AS status, o_orderpriority AS priority,
       o_totalprice AS measure, o_orderdate AS time, CAST(o_orderdate AS DATE) AS day
FROM {orders}
"""
VIEWS["clocked"] = """
SELECT o_orderkey AS code, CAST(o_orderdate AS DATE) AS day,
       concat(CAST(o_orderkey % 24 AS STRING), ':', lpad(CAST(o_custkey % 60 AS STRING), 2, '0')) AS hm,
       CASE WHEN o_orderkey % 4 = 0 THEN concat(month(o_orderdate), '/', day(o_orderdate), '/', year(o_orderdate))
            WHEN o_orderkey % 4 = 1 THEN concat(year(o_orderdate), '-', lpad(CAST(month(o_orderdate) AS STRING), 2, '0'),
                                                '-', lpad(CAST(day(o_orderdate) AS STRING), 2, '0'))
            WHEN o_orderkey % 4 = 2 THEN concat(month(o_orderdate), '/', day(o_orderdate), '/',
                                                lpad(CAST(year(o_orderdate) % 100 AS STRING), 2, '0'))
            ELSE 'no date' END AS written
FROM {orders}
"""
