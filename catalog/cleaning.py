"""Missing values, units, salinity, text, dates, coordinates and censoring."""

import datetime

from pyspark.sql import functions as F

from catalog.core import query
from tidemerge.functions import censor, clock, coords, nulls, text, units
from tidemerge.functions.codes import TRAWL_TIDES, rounded_index
from tidemerge.operators import joins, repair
from tidemerge.plans.publish import clean_text


@query("readings", sql="""
SELECT code, maybe_analyte, result FROM readings
WHERE maybe_analyte IS NULL OR maybe_analyte NOT IN ('click', 'view')
""")
def not_in_keep_null(readings):
    kept = readings.filter(nulls.not_in(F.col("maybe_analyte"), ["click", "view"]))
    return kept.select("code", "maybe_analyte", "result")


@query("gappy_tows", sql="""
SELECT sample, gear, tow, depth, measure, share FROM gappy_tows
WHERE NOT (depth IS NULL AND measure IS NULL AND share IS NULL)
""")
def drop_all_null(tows):
    kept = nulls.drop_all_null(tows, ["depth", "measure", "share"])
    return kept.select("sample", "gear", "tow", "depth", "measure", "share")


@query("gappy_tows", sql="""
SELECT sample, gear, tow, depth, measure, share FROM gappy_tows
WHERE depth IS NOT NULL AND measure IS NOT NULL AND share IS NOT NULL
""")
def drop_any_null(tows):
    return nulls.drop_any_null(tows.select("sample", "gear", "tow", "depth", "measure", "share"))


@query("gappy_tows", sql="""
SELECT sample, gear, tow,
       CASE WHEN measure IS NULL THEN NULL WHEN measure < 50000 THEN 'low' ELSE 'high' END AS level,
       concat(coalesce(CAST(maybe_station AS VARCHAR), 'NA'), ' ', coalesce(maybe_flag, 'NA')) AS label
FROM gappy_tows
""")
def if_else_and_paste(tows):
    level = nulls.if_else(F.col("measure") < 50000, F.lit("low"), F.lit("high"))
    label = text.paste(F.col("maybe_station"), F.col("maybe_flag"))
    return tows.select("sample", "gear", "tow", level.alias("level"), label.alias("label"))


@query("lab_text", sql="""
SELECT code, try_cast(result AS DOUBLE) AS number, round_even(value, 0) AS whole FROM lab_text
""")
def text_to_number(lab):
    return lab.select(
        "code", nulls.number(F.col("result")).alias("number"), rounded_index(F.col("value")).alias("whole")
    )


@query("lab_text", sql="""
SELECT code, value * 0.3048 AS metres, value * 100 AS centimetres, value * (14.007 / 1000) AS mg_n,
       CASE WHEN units = 'ug/L' THEN value / 1000 ELSE value END AS mg_l,
       CASE WHEN units LIKE '%F' THEN (value - 32) * 5 / 9 ELSE value END AS celsius
FROM lab_text
""")
def unit_conversion(lab):
    v, u = F.col("value"), F.col("units")
    return lab.select(
        "code",
        units.feet_to_metres(v).alias("metres"),
        units.metres_to_centimetres(v).alias("centimetres"),
        units.micromolar_to_mg_per_l(v, units.MOLAR_MASS_N).alias("mg_n"),
        units.ug_to_mg_per_l(v, u).alias("mg_l"),
        units.fahrenheit_to_celsius(v, u).alias("celsius"),
    )


@query("readings", sql="""
SELECT code, round(coalesce(maybe_result, result * 2 / (1 + 0.019 * (station % 40 - 25))), 6) AS conductance
FROM readings
""")
def specific_conductance(readings):
    value = units.specific_conductance(F.col("maybe_result"), F.col("result") * 2, F.col("station") % 40)
    return readings.select("code", F.round(value, 6).alias("conductance"))


SALINITY_SQL = """
SELECT {keep}, CASE WHEN c >= 0 THEN round(CASE WHEN s < 2
         THEN s - (0.008 / (1 + 1.5 * 400 * ratio + 400 * ratio * 400 * ratio)
                   + 0.0005 * ft / (1 + sqrt(100 * ratio) + 100 * ratio + 100 * ratio * sqrt(100 * ratio)))
         ELSE s END, 6) END AS salinity
FROM (
  SELECT *, 0.008 - 0.1692 * r + 25.3851 * r ** 2 + 14.0941 * r ** 3 - 7.0261 * r ** 4 + 2.7081 * r ** 5
            + ft * (0.0005 - 0.0056 * r - 0.0066 * r ** 2 - 0.0375 * r ** 3 + 0.0636 * r ** 4 - 0.0144 * r ** 5) AS s
  FROM (SELECT *, sqrt(ratio) AS r, (25 - 15) / (1 + 0.0162 * (25 - 15)) AS ft
        FROM (SELECT *, c / (42.914 * (0.6766097 + 0.0200564 * 25 + 1.104259e-4 * 25 ** 2 - 6.9698e-7 * 25 ** 3
                                       + 1.0031e-9 * 25 ** 4)) AS ratio
              FROM ({source})))
)
"""


@query("readings", sql=SALINITY_SQL.format(
    keep="code", source="SELECT code, maybe_result / 10 AS c FROM readings"
))
def practical_salinity(readings):
    made = units.add_practical_salinity(readings, F.col("maybe_result") / 10, "salinity")
    return made.select("code", F.round("salinity", 6).alias("salinity"))


@query("tows", sql="""
SELECT sample, gear, tow,
       CASE flag WHEN 'A' THEN 'Ebb' WHEN 'N' THEN 'Flood' ELSE flag END AS kept,
       CASE CAST(tow AS VARCHAR) WHEN '1' THEN 'High Slack' WHEN '2' THEN 'Ebb' WHEN '3' THEN 'Low Slack'
            WHEN '4' THEN 'Flood' END AS tide
FROM tows
""")
def recode_values(tows):
    return tows.select(
        "sample", "gear", "tow",
        text.recode(F.col("flag"), {"A": "Ebb", "N": "Flood"}).alias("kept"),
        text.recode(F.col("tow").cast("string"), TRAWL_TIDES, keep_unmatched=False).alias("tide"),
    )


@query("part", sql="""
SELECT p_partkey, regexp_replace(p_name, '[aeiou]', '') AS first_removed,
       CASE WHEN length(CAST(p_partkey AS VARCHAR)) >= 3 THEN CAST(p_partkey AS VARCHAR)
            ELSE lpad(CAST(p_partkey AS VARCHAR), 3, '0') END AS padded,
       regexp_matches(p_name, 'RING|WIDGET', 'i') AS ring
FROM part
""")
def text_repairs(part):
    key = F.col("p_partkey").cast("string")
    return part.select(
        "p_partkey",
        text.remove_first(F.col("p_name"), "[aeiou]").alias("first_removed"),
        text.pad_left(key, 3).alias("padded"),
        F.col("p_name").rlike("(?i)RING|WIDGET").alias("ring"),
    )


@query("readings", sql="""
SELECT code,
       CASE WHEN maybe_day IS NULL THEN NULL WHEN maybe_day < DATE '2024-01-15' THEN NULL ELSE result END AS after_start,
       CASE WHEN result <= 100 THEN result END AS in_range,
       CASE WHEN maybe_analyte IS NULL THEN NULL WHEN maybe_analyte LIKE '%er%' THEN NULL ELSE result END AS strict_note,
       CASE WHEN coalesce(maybe_analyte LIKE '%er%', FALSE) THEN NULL ELSE result END AS lenient_note
FROM (SELECT *, CASE WHEN code % 13 = 0 THEN NULL ELSE day END AS maybe_day FROM readings)
""")
def null_rules(readings):
    day, result = F.when(F.col("code") % 13 != 0, F.col("day")), F.col("result")
    note = F.col("maybe_analyte")
    return readings.select(
        "code",
        repair.null_before(day, datetime.date(2024, 1, 15), result).alias("after_start"),
        repair.null_above(result, 100).alias("in_range"),
        repair.null_when_noted(note, "er", result).alias("strict_note"),
        repair.null_when_noted(note, "er", result, missing_notes_too=False).alias("lenient_note"),
    )


@query("supplier", sql="""
SELECT s_suppkey, (d + m / 60 + s / 3600) * -1 AS longitude, d + m / 60 + s / 3600 AS from_text,
       CASE WHEN s_suppkey % 2 = 0 THEN d + m / 60 + s / 3600 ELSE d + (m + s / 100) / 60 END AS unpacked
FROM (SELECT s_suppkey, CAST(37 + s_suppkey % 3 AS DOUBLE) AS d, CAST(10 + s_suppkey % 50 AS DOUBLE) AS m,
             CAST(10 + (s_suppkey * 7) % 50 AS DOUBLE) AS s FROM supplier)
""")
def coordinate_forms(supplier):
    """One position in three writings: parts, dirty text, packed number."""
    key = F.col("s_suppkey")
    d, m, s = 37 + key % 3, 10 + key % 50, 10 + (key * 7) % 50
    written = F.concat(F.concat_ws("-", d, m, s), F.when(key % 3 == 0, 'W"x').when(key % 3 == 1, "'n\"").otherwise("W"))
    packed = F.concat(d, m, s)
    return supplier.select(
        "s_suppkey",
        coords.dms(d.cast("double"), m.cast("double"), s.cast("double"), -1).alias("longitude"),
        coords.dirty_dms(written).alias("from_text"),
        coords.packed_degrees(packed, 2, key % 2 == 1).alias("unpacked"),
    )


@query("supplier", "nation", sql="""
WITH placed AS (
  SELECT s_suppkey, CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE s_acctbal END AS flat,
         CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE s_acctbal + 1 END AS flon,
         CASE WHEN n_nationkey % 3 = 0 THEN NULL ELSE n_nationkey * 1.0 END AS lat,
         CASE WHEN n_nationkey % 2 = 0 THEN NULL ELSE n_nationkey * 2.0 END AS lon
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey)
SELECT s_suppkey, coalesce(lat, flat) AS "Latitude", coalesce(lon, flon) AS "Longitude",
       (lat IS NULL AND flat IS NOT NULL) OR (lon IS NULL AND flon IS NOT NULL) AS "Field_coords"
FROM placed
""")
def coordinates_with_fallback(supplier, nation):
    key, place = F.col("s_suppkey"), F.col("n_nationkey")
    field = supplier.select(
        "s_suppkey",
        "s_nationkey",
        F.when(key % 4 != 0, F.col("s_acctbal")).alias("Latitude"),
        F.when(key % 5 != 0, F.col("s_acctbal") + 1).alias("Longitude"),
    )
    stations = nation.select(
        "n_nationkey",
        F.when(place % 3 != 0, place * 1.0).alias("Latitude"),
        F.when(place % 2 != 0, place * 2.0).alias("Longitude"),
    )
    joined = joins.lookup(field, stations, [("s_nationkey", "n_nationkey")], suffix="_field")
    return coords.prefer_station_coords(joined).drop("s_nationkey")


@query("clocked", sql="""
SELECT code, CASE WHEN length(split_part(written, '/', 3)) = 2 THEN try_strptime(written, '%m/%d/%y')
                  ELSE coalesce(try_strptime(written, '%m/%d/%Y'), try_strptime(written, '%Y-%m-%d')) END::DATE AS day
FROM clocked
""")
def multi_format_dates(clocked):
    written = F.col("written")
    return clocked.select(
        "code",
        clock.parse_date(clock.whole_year(written), "M/d/yyyy", "yyyy-MM-dd").alias("day"),
    )


@query("clocked", sql="""
SELECT code, day + CAST(concat(hm, ':00') AS TIME) AS wall, hour(CAST(concat(hm, ':00') AS TIME)) AS hour
FROM clocked
""")
def combine_date_time(clocked):
    time = clock.parse(F.col("hm"), "H:m")
    return clocked.select("code", clock.at(F.col("day"), time).alias("wall"), F.hour(time).cast("bigint").alias("hour"))


@query("clocked", sql="""
SELECT code, timezone('America/Los_Angeles', timezone('Etc/GMT+8', pst)) AS local_time,
       CAST(timezone('America/Los_Angeles', timezone('Etc/GMT+8', pst)) AS DATE) AS local_day,
       timezone('America/Los_Angeles', timezone('UTC', pst)) AS from_utc,
       CASE WHEN hour(pst) IN (1, 2) THEN pst + INTERVAL 12 HOUR ELSE pst END AS afternoon
FROM (SELECT code, day + CAST(concat(hm, ':00') AS TIME) AS pst FROM clocked)
""")
def pst_to_local(clocked):
    pst = clock.at(F.col("day"), clock.parse(F.col("hm"), "H:m"))
    local = clock.to_local(pst, clock.PST)
    late = F.when(F.hour(pst).isin(1, 2), clock.add_hours(pst, 12)).otherwise(pst)
    return clocked.select(
        "code",
        local.alias("local_time"),
        local.cast("date").alias("local_day"),
        clock.to_local(pst, clock.UTC).alias("from_utc"),
        late.alias("afternoon"),
    )


@query("visits", sql="""
SELECT year(day) AS year, season, count(*) AS n, CAST(date_trunc('month', min(day)) AS DATE) AS first_month
FROM (SELECT day, CASE WHEN month(day) IN (12, 1, 2) THEN 'Winter' WHEN month(day) IN (3, 4, 5) THEN 'Spring'
                       WHEN month(day) IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END AS season FROM visits)
GROUP BY ALL
""")
def season_counts(visits):
    dated = visits.select("day", clock.season(F.month("day")).alias("season"))
    return dated.groupBy(F.year("day").cast("bigint").alias("year"), "season").agg(
        F.count(F.lit(1)).alias("n"), clock.month_start(F.min("day")).alias("first_month")
    )


@query("lab_text", sql="""
SELECT code, sign, CASE WHEN sign = '<' THEN try_cast(rl AS DOUBLE)
                        WHEN regexp_matches(result, '[A-Za-z]') THEN NULL ELSE try_cast(result AS DOUBLE) END AS value
FROM (SELECT *, CASE WHEN result IS NULL THEN NULL WHEN result LIKE '<%' THEN '<' ELSE '=' END AS sign FROM lab_text)
WHERE CASE WHEN sign = '<' THEN try_cast(rl AS DOUBLE)
           WHEN regexp_matches(result, '[A-Za-z]') THEN NULL ELSE try_cast(result AS DOUBLE) END IS NOT NULL
""")
def censor_split(lab):
    split = censor.split_censored(lab.select("code", "result", "rl"), "result", "rl", "sign")
    return split.select("code", "sign", F.col("result").alias("value"))


@query("lab_text", sql="""
SELECT code, CASE WHEN detection = 'Not Detected' THEN '<' WHEN value_type = 'Estimated' THEN '~' ELSE '=' END AS sign,
       CASE WHEN detection = 'Not Detected' THEN try_cast(rl AS DOUBLE) ELSE value END AS value
FROM lab_text
""")
def censor_status(lab):
    sign = censor.status_sign(F.col("detection"), F.col("value_type"))
    value = F.when(sign == "<", nulls.number(F.col("rl"))).otherwise(F.col("value"))
    return lab.select("code", sign.alias("sign"), value.alias("value"))


@query("readings", sql="""
SELECT code, CASE WHEN maybe_result IS NOT NULL THEN maybe_result
  WHEN analyte = 'click' AND day <= DATE '2024-01-10' THEN 0.02
  WHEN analyte = 'click' AND day >= DATE '2024-01-11' THEN 0.04
  WHEN analyte = 'view' AND maybe_analyte = 'view' THEN 0.08
  WHEN analyte = 'error' THEN 0.008 END AS value
FROM readings
""")
def fill_reporting_limit(readings):
    rules = [
        censor.LimitRule("click", 0.02, last_day=datetime.date(2024, 1, 10)),
        censor.LimitRule("click", 0.04, first_day=datetime.date(2024, 1, 11)),
        censor.LimitRule("view", 0.08, method="view"),
        censor.LimitRule("error", 0.008),
    ]
    value = censor.fill_limit(
        F.col("maybe_result"), F.col("analyte"), F.col("maybe_analyte"), F.col("day"), rules
    )
    return readings.select("code", value.alias("value"))


@query("documents", sql="""
SELECT doc_id, md5(replace(replace(replace(text, '"', ''''), chr(10), ' '), chr(13), ' ')) AS digest, length(text) AS n
FROM documents
""")
def publish_clean_text(documents):
    """Whole notes made safe for CSV, shown by their digest."""
    notes = clean_text(F.replace(F.col("text"), F.lit('"'), F.lit("'")))
    return documents.select("doc_id", F.md5(notes).alias("digest"), F.length("text").cast("bigint").alias("n"))
