"""The integrated table over three surveys seen in the given tables."""

from pyspark.sql import functions as F

from catalog.core import VIEWS, query
from tidemerge.plans.integrate import integrate
from tidemerge.operators import quality

VIEWS["trawl"] = """
SELECT 'Trawl' AS Source, CAST(o_custkey AS STRING) AS Station, CAST(o_orderdate AS DATE) AS Date,
       o_orderdate AS Datetime, CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice / 100 END AS Salinity,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice / 10 END AS Conductivity,
       o_orderstatus AS Tide, CASE WHEN o_orderkey % 4 = 0 THEN NULL WHEN o_orderkey % 4 = 1 THEN true ELSE false END AS Field_coords,
       concat('note "', o_orderpriority, '"') AS Notes
FROM {orders}
"""
VIEWS["profile"] = """
SELECT 'Profile' AS Source, CASE WHEN l_suppkey % 25 = 0 THEN NULL ELSE CAST(l_suppkey AS STRING) END AS Station,
       CASE WHEN l_orderkey % 31 = 0 THEN NULL ELSE CAST(l_shipdate AS DATE) END AS Date, l_shipdate AS Datetime,
       l_quantity AS Depth, l_extendedprice AS Conductivity, l_extendedprice / 2 AS Conductivity_bottom,
       l_quantity AS Temperature
FROM {lineitem}
"""
VIEWS["lab"] = """
SELECT 'Lab' AS Source, CAST(user_id AS STRING) AS Station, CAST(ts AS DATE) AS Date, ts AS Datetime,
       value AS Chlorophyll, CASE WHEN event_id % 5 = 0 THEN '<' ELSE '=' END AS Chlorophyll_Sign
FROM {events}
"""
KNOWN = ("Profile", "Trawl", "Lab")
CALENDAR = """
  CAST(date_trunc('month', "Date") AS DATE) AS "MonthYear", year("Date")::INT AS "Year",
  concat(coalesce("Source", 'NA'), ' ', coalesce("Station", 'NA')) AS "StationID", month("Date")::INT AS "Month",
  CASE WHEN month("Date") IN (12, 1, 2) THEN 'Winter' WHEN month("Date") IN (3, 4, 5) THEN 'Spring'
       WHEN month("Date") IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END AS "Season"
"""


SALINITY_EXPR = """
CASE WHEN {c} >= 0 THEN CASE WHEN {s} < 2 THEN {s} - (0.008 / (1 + 1.5 * 400 * {q} + 400 * {q} * 400 * {q})
  + 0.0005 * ft / (1 + sqrt(100 * {q}) + 100 * {q} + 100 * {q} * sqrt(100 * {q}))) ELSE {s} END END
"""


def salinity_steps(source: str, columns: dict[str, str]) -> str:
    """A chain of subqueries that adds the salinity ``out`` of each conductivity column."""
    ratio = ", ".join(
        f'"{c}" / 1000 / (42.914 * (0.6766097 + 0.0200564 * 25 + 1.104259e-4 * 25 ** 2 - 6.9698e-7 * 25 ** 3'
        f" + 1.0031e-9 * 25 ** 4)) AS q{i}" for i, c in enumerate(columns)
    )
    series = ", ".join(
        f"0.008 - 0.1692 * sqrt(q{i}) + 25.3851 * q{i} + 14.0941 * sqrt(q{i}) ** 3 - 7.0261 * q{i} ** 2 + 2.7081 * sqrt(q{i}) ** 5"
        f" + ft * (0.0005 - 0.0056 * sqrt(q{i}) - 0.0066 * q{i} - 0.0375 * sqrt(q{i}) ** 3 + 0.0636 * q{i} ** 2"
        f" - 0.0144 * sqrt(q{i}) ** 5) AS s{i}" for i, _ in enumerate(columns)
    )
    final = ", ".join(
        SALINITY_EXPR.format(c=f'"{c}"', s=f"s{i}", q=f"q{i}") + f" AS {out}" for i, (c, out) in enumerate(columns.items())
    )
    return (
        f"(SELECT *, {final} FROM (SELECT *, {series} FROM (SELECT *, (25 - 15) / (1 + 0.0162 * (25 - 15)) AS ft, {ratio}"
        f" FROM ({source}))))"
    )


UNION = "SELECT * FROM profile UNION ALL BY NAME SELECT * FROM trawl UNION ALL BY NAME SELECT * FROM lab"
MADE = salinity_steps(UNION, {"Conductivity": "made", "Conductivity_bottom": "made_bottom"})


@query("profile", "trawl", "lab", sql=f"""
SELECT "Source", "Station", "Date", "Datetime", "Depth", "Conductivity", "Conductivity_bottom", "Temperature",
  "Tide", coalesce("Field_coords", FALSE) AS "Field_coords", "Notes", "Chlorophyll", "Chlorophyll_Sign", {CALENDAR},
  round(coalesce("Salinity", made), 6) AS "Salinity", round(made_bottom, 6) AS "Salinity_bottom"
FROM {MADE} WHERE year("Date") BETWEEN 0 AND 9999
""")
def integrate_surveys(profile, trawl, lab):
    """Union of ragged sources, calendar keys, coordinates flag, salinity from conductivity."""
    tables = {"Profile": profile, "Trawl": trawl, "Lab": lab}
    whole = integrate(tables, KNOWN, end_year=9999, known=KNOWN)
    return whole.withColumns({c: F.round(c, 6) for c in ("Salinity", "Salinity_bottom")})


@query("profile", "trawl", sql=f"""
SELECT "Source", "Station", "Date", {CALENDAR} FROM (
  SELECT * FROM profile UNION ALL BY NAME SELECT * FROM trawl) WHERE year("Date") BETWEEN 1997 AND 1999
""")
def integrate_year_range(profile, trawl):
    """Only the chosen sources enter the plan, and the years reach the scans."""
    tables = {"Profile": profile, "Trawl": trawl}
    years = integrate(tables, ["Trawl", "Profile"], 1997, 1999, known=KNOWN)
    return years.select("Source", "Station", "Date", "MonthYear", "Year", "StationID", "Month", "Season")


@query("profile", "trawl", "lab", sql=f"""
SELECT "Source", count(*) AS n, count("Salinity_filled") AS with_salinity, count("Notes") AS with_notes,
       min("Date") AS first_day, max("StationID") AS last_station
FROM (SELECT *, coalesce("Salinity", made) AS "Salinity_filled", {CALENDAR} FROM {MADE}
      WHERE "Date" IS NOT NULL) GROUP BY ALL
""")
def integrate_summary(profile, trawl, lab):
    """What each source brings to the integrated table."""
    whole = integrate({"Profile": profile, "Trawl": trawl, "Lab": lab}, KNOWN, end_year=9999, known=KNOWN)
    return whole.groupBy("Source").agg(
        F.count(F.lit(1)).alias("n"), F.count("Salinity").alias("with_salinity"), F.count("Notes").alias("with_notes"),
        F.min("Date").alias("first_day"), F.max("StationID").alias("last_station"),
    )


@query("profile", "trawl", "lab", sql="""
SELECT "Source", "Station", "Date", "Datetime", count(*) AS n FROM (
  SELECT "Source", "Station", "Date", "Datetime" FROM profile UNION ALL
  SELECT "Source", "Station", "Date", "Datetime" FROM trawl UNION ALL
  SELECT "Source", "Station", "Date", "Datetime" FROM lab) WHERE "Date" IS NOT NULL GROUP BY ALL HAVING count(*) > 1
""")
def integrated_duplicates(profile, trawl, lab):
    whole = integrate({"Profile": profile, "Trawl": trawl, "Lab": lab}, KNOWN, end_year=9999, known=KNOWN)
    return quality.not_unique(whole, ["Source", "Station", "Date", "Datetime"])
