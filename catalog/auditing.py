"""Feed profiles, feed comparison, quality checks and coverage."""

from pyspark.sql import functions as F

from catalog.core import query
from tidemerge.operators import audit, quality
from tidemerge.plans import publish

#: Years with a column of their own; visits of all others count in the last column.
YEARS = [1995, 1996, 1997, 1998, 1999, 2000, 2001]


@query("gappy_tows", sql="SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"Column\", count(*) - count({c}) AS \"NumNA\" FROM gappy_tows"
    for c in ("depth", "measure", "share", "maybe_flag", "maybe_station", "sample")
) + ")")
def null_profile(tows):
    return audit.null_profile(tows, ["depth", "measure", "share", "maybe_flag", "maybe_station", "sample"])


@query("gappy_tows", sql="""
SELECT 'maybe_flag' AS "Column", maybe_flag AS "Value", count(*) AS n FROM gappy_tows GROUP BY maybe_flag
UNION ALL SELECT 'status', status, count(*) FROM gappy_tows GROUP BY status
""")
def value_counts(tows):
    return audit.value_counts(tows, ["maybe_flag", "status"])


@query("lab_text", sql="SELECT analyte, units, detection, count(*) AS n FROM lab_text GROUP BY ALL")
def cross_tab(lab):
    return audit.cross_tab(lab, "analyte", "units", "detection")


@query("tows", sql="""
SELECT n AS "NumRecords", count(*) AS n FROM (SELECT count(*) AS n FROM tows GROUP BY sample, tow) GROUP BY n
""")
def count_of_counts(tows):
    return audit.count_of_counts(tows, "sample", "tow")


@query("lab_text", sql="""
SELECT 'Ammonia' AS "Parameter", CASE WHEN code % 4 = 0 THEN NULL WHEN code % 4 = 1 THEN '<' ELSE '=' END AS "Sign",
       code % 3 <> 0 AS "HasValue", count(*) AS n FROM lab_text GROUP BY ALL
UNION ALL SELECT 'Nitrate', CASE WHEN code % 5 = 0 THEN '~' ELSE '=' END, code % 2 <> 0, count(*) FROM lab_text GROUP BY ALL
""")
def sign_profile(lab):
    code = F.col("code")
    wide = lab.select(
        F.when(code % 3 != 0, F.col("value")).alias("Ammonia"),
        F.when(code % 4 == 1, "<").when(code % 4 != 0, "=").alias("Ammonia_Sign"),
        F.when(code % 2 != 0, F.col("value")).alias("Nitrate"),
        F.when(code % 5 == 0, "~").otherwise("=").alias("Nitrate_Sign"),
    )
    return audit.sign_profile(wide)


@query("visits", sql="""
SELECT status, priority, CAST(year(time) AS BIGINT) AS "Year", count(*) AS "NumSamples"
FROM (SELECT DISTINCT status, priority, time FROM visits) GROUP BY ALL
""")
def sampling_effort(visits):
    effort = audit.sampling_effort(visits, ["status", "priority"], "time")
    return effort.withColumn("Year", F.col("Year").cast("bigint"))


@query("visits", sql="SELECT concat(status, ' - ', priority) AS \"Station\", " + ", ".join(
    f"nullif(count(DISTINCT time) FILTER (year(time) = {y}), 0) AS \"{y}\"" for y in YEARS
) + f", nullif(count(DISTINCT time) FILTER (year(time) NOT IN ({', '.join(map(str, YEARS))})), 0) AS \"Other\""
  " FROM visits GROUP BY status, priority")
def effort_matrix(visits):
    return audit.effort_matrix(visits, ["status", "priority"], "time", YEARS)


@query("visits", sql="""
SELECT station, status, count(*) AS "NumSamples", min(day) AS "MinDate", max(day) AS "MaxDate" FROM visits GROUP BY ALL
""")
def record_period(visits):
    return audit.record_period(visits, ["station", "status"], "day")


@query("readings", sql="""
SELECT code, maybe_station, day, analyte FROM readings
QUALIFY count(*) OVER (PARTITION BY maybe_station, day, analyte) > 1
""")
def many_per_day(readings):
    rows = audit.many_per_day(readings, ["maybe_station", "day", "analyte"])
    return rows.select("code", "maybe_station", "day", "analyte")


@query("documents", "labels", sql="""
SELECT coalesce(d.doc_id, l.doc_id) AS doc_id,
       CASE WHEN d.doc_id IS NULL THEN 'right' WHEN l.doc_id IS NULL THEN 'left' ELSE 'both' END AS found_in
FROM (SELECT DISTINCT CASE WHEN n_chars > 200 THEN doc_id ELSE -1 - doc_id END AS doc_id FROM documents) d
FULL JOIN (SELECT DISTINCT doc_id FROM labels) l ON d.doc_id = l.doc_id
""")
def reconcile_feeds(documents, labels):
    short = documents.selectExpr("CASE WHEN n_chars > 200 THEN doc_id ELSE -1 - doc_id END AS doc_id")
    return audit.reconcile(short, labels, ["doc_id"])


ALTERED = """
SELECT o_custkey AS k, o_orderstatus AS a, CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE o_orderpriority END AS b FROM orders
"""
OTHER = """
SELECT CASE WHEN o_orderkey % 3 = 0 THEN -1 - o_custkey ELSE o_custkey END AS k, CASE WHEN o_orderkey % 5 = 0 THEN 'X' ELSE o_orderstatus END AS a,
       o_orderpriority AS b FROM orders
"""


def _two_feeds(orders):
    key = F.col("o_orderkey")
    left = orders.select(
        F.col("o_custkey").alias("k"), F.col("o_orderstatus").alias("a"),
        F.when(key % 8 != 0, F.col("o_orderpriority")).alias("b"),
    )
    customer = F.col("o_custkey")
    right = orders.select(
        F.when(key % 3 == 0, -1 - customer).otherwise(customer).alias("k"), F.when(key % 5 == 0, "X").otherwise(F.col("o_orderstatus")).alias("a"),
        F.col("o_orderpriority").alias("b"),
    )
    return left, right


@query("orders", sql=f"""
WITH pairs AS (SELECT l.a AS la, r.a AS ra, l.b AS lb, r.b AS rb FROM ({ALTERED}) l JOIN ({OTHER}) r ON l.k = r.k)
SELECT 'a' AS "Field", count(*) AS pairs, count(*) FILTER (la <> ra) AS different, count(*) FILTER ((la <> ra) IS NULL) AS unknown FROM pairs
UNION ALL
SELECT 'b', count(*), count(*) FILTER (lb <> rb), count(*) FILTER ((lb <> rb) IS NULL) FROM pairs
""")
def field_equivalence(orders):
    """Pairs of matched records that differ, counted without building the pairs."""
    left, right = _two_feeds(orders)
    return audit.field_equivalence(left, right, ["k"], ["a", "b"])


@query("orders", sql=f"""
SELECT l.a AS left_value, r.a AS right_value, count(*) AS n FROM ({ALTERED}) l JOIN ({OTHER}) r ON l.k = r.k
WHERE l.a <> r.a GROUP BY ALL
""")
def differing_values(orders):
    left, right = _two_feeds(orders)
    return audit.differing_values(left, right, ["k"], "a")


@query("readings", sql="""
SELECT code, CASE WHEN shifted = 0 THEN '<' ELSE '=' END AS sign, CASE WHEN shifted = 0 THEN rl ELSE shifted END AS value
FROM (SELECT code, CASE WHEN code % 6 = 0 THEN 0 ELSE result - 5 END AS shifted, result / 4 AS rl FROM readings)
WHERE shifted >= 0
""")
def zero_as_censored(readings):
    shifted = readings.select(
        "code", F.when(F.col("code") % 6 == 0, 0.0).otherwise(F.col("result") - 5).alias("value"),
        (F.col("result") / 4).alias("rl"),
    )
    return audit.zero_as_censored(shifted, "value", "rl", "sign").drop("rl")


@query("gappy_tows", sql="""
SELECT sample, gear, tow, lat, lon FROM (
  SELECT sample, gear, tow, 36.8 + depth / 20 AS lat, -123.1 + measure / 45000 AS lon FROM gappy_tows)
WHERE NOT (lat > 37 AND lat < 39) OR NOT (lon > -123 AND lon < -121)
""")
def quality_bounds(tows):
    placed = tows.select(
        "sample", "gear", "tow", (36.8 + F.col("depth") / 20).alias("lat"), (-123.1 + F.col("measure") / 45000).alias("lon")
    )
    return quality.out_of_bounds(placed, lat="lat", lon="lon")


@query("visits", sql="SELECT station, day, status, count(*) AS n FROM visits GROUP BY ALL HAVING count(*) > 1")
def quality_unique(visits):
    return quality.not_unique(visits, ["station", "day", "status"])


@query("gappy_tows", sql="SELECT sample, gear, tow, rate, share FROM gappy_tows WHERE rate = 0 OR share = 0")
def quality_zero(tows):
    zeros = quality.forbidden_zeros(tows, ["rate", "share"])
    return zeros.select("sample", "gear", "tow", "rate", "share")


@query("gappy_tows", sql="""
SELECT * FROM (
  SELECT 'maybe_flag' AS "Column", maybe_flag AS "Code", count(*) AS n FROM gappy_tows
  WHERE maybe_flag IS NOT NULL AND maybe_flag NOT IN ('A', 'N') GROUP BY ALL
  UNION ALL SELECT 'depth', CAST(CAST(depth AS BIGINT) AS VARCHAR), count(*) FROM gappy_tows
  WHERE depth NOT IN (1, 2, 3, 4, 5) GROUP BY ALL)
""")
def domain_check(tows):
    domains = {"maybe_flag": ("A", "N"), "depth": ("1", "2", "3", "4", "5")}
    return quality.off_domain(tows, domains)


@query("visits", "tows", sql="""
SELECT "Source", sum(a)::BIGINT AS rows_in, sum(b)::BIGINT AS rows_out FROM (
  SELECT 'visits' AS "Source", count(*) AS a, 0 AS b FROM visits
  UNION ALL SELECT 'tows', count(*), 0 FROM tows
  UNION ALL SELECT 'visits', 0, count(*) FROM visits WHERE status <> 'F'
  UNION ALL SELECT 'tows', 0, count(*) FROM tows) GROUP BY ALL HAVING sum(a) <> sum(b)
""")
def row_conservation(visits, tows):
    whole = visits.filter("status <> 'F'").select(F.lit("visits").alias("Source")).unionByName(
        tows.select(F.lit("tows").alias("Source"))
    )
    return quality.row_conservation({"visits": visits, "tows": tows}, whole)


@query("clocked", sql="""
SELECT code, day, local_time FROM (
  SELECT code, day, day + CAST(concat(hm, ':00') AS TIME) + INTERVAL 1 DAY * (code % 4) AS local_time FROM clocked)
WHERE abs(date_diff('day', day, CAST(local_time AS DATE))) > 1
""")
def clock_check(clocked):
    from tidemerge.functions import clock

    time = clock.at(F.col("day"), clock.parse(F.col("hm"), "H:m"))
    later = time + F.make_dt_interval((F.col("code") % 4).cast("int"))
    moved = clocked.select("code", "day", later.alias("local_time"))
    return quality.wrong_clock(moved, "local_time", "day")


@query("supplier", sql="""
SELECT DISTINCT concat('S ', s_nationkey) AS "Station", 37 + s_nationkey % 2 AS "Latitude", CAST(-121.5 AS DOUBLE) AS "Longitude" FROM supplier
""")
def station_coverage(supplier):
    placed = supplier.select(
        F.concat(F.lit("S "), "s_nationkey").alias("Station"), (37 + F.col("s_nationkey") % 2).alias("Latitude"),
        F.lit(-121.5).alias("Longitude"),
    )
    return publish.station_coverage(placed)


@query("visits", sql="""
SELECT min(day) AS first_day, max(day) AS last_day, CAST(max(year(day)) AS BIGINT) AS last_year FROM visits
""")
def temporal_coverage(visits):
    covered = publish.temporal_coverage(visits.withColumnRenamed("day", "Date"))
    return covered.withColumn("last_year", F.col("last_year").cast("bigint"))


@query("lab_text", sql="""
SELECT analyte, notes, count(*) AS n FROM lab_text WHERE notes LIKE '%Duplicate%' GROUP BY ALL
""")
def excluded_by_rule(lab):
    return audit.excluded(lab, F.col("notes").rlike("Duplicate"), "analyte", "notes")
