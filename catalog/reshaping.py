"""Long to wide and back."""

from pyspark.sql import functions as F

from catalog.core import query
from tidemerge.functions.censor import SIGNS
from tidemerge.operators import reshape

KINDS = ["click", "view", "purchase", "error", "signup"]


@query("readings", sql="""
SELECT station, day, """ + ", ".join(f"arg_min(result, code) FILTER (analyte = '{k}') AS {k}" for k in KINDS) + """
FROM readings GROUP BY station, day
""")
def pivot_values(readings):
    return reshape.long_to_wide(
        readings, ["station", "day"], "analyte", KINDS, {"result": "{name}"}, order=F.col("code")
    )


@query("lab_text", sql="""
WITH signed AS (SELECT *, CASE WHEN detection = 'Not Detected' THEN '<' ELSE '=' END AS sign FROM lab_text),
firsts AS (SELECT * FROM signed QUALIFY row_number() OVER (PARTITION BY station, day, analyte ORDER BY code) = 1)
SELECT station, day, """ + ", ".join(
    f"max(value) FILTER (analyte = '{k}') AS {k}, coalesce(max(sign) FILTER (analyte = '{k}'), '=') AS \"{k}_Sign\""
    for k in KINDS
) + " FROM firsts GROUP BY station, day")
def pivot_value_sign(lab):
    """Value and sign of each analyte; a sign without a value reads measured."""
    signed = lab.withColumn("sign", F.when(F.col("detection") == "Not Detected", "<").otherwise("="))
    wide = reshape.long_to_wide(
        signed, ["station", "day"], "analyte", KINDS, {"value": "{name}", "sign": "{name}_Sign"}, order=F.col("code"), levels={"sign": SIGNS}
    )
    return wide.fillna("=", [f"{k}_Sign" for k in KINDS])


@query("readings", sql="SELECT maybe_station, " + ", ".join(
    f"CASE WHEN count(*) FILTER (analyte = '{k}') = count(maybe_result) FILTER (analyte = '{k}')"
    f" THEN round(avg(maybe_result) FILTER (analyte = '{k}'), 6) END AS mean_{k}" for k in KINDS
) + " FROM (SELECT *, code // 4 AS maybe_group FROM readings) GROUP BY maybe_station, maybe_group")
def pivot_mean(readings):
    """Mean per analyte of small blocks of samples, unknown if a member is unknown."""
    blocks = readings.withColumn("block", F.expr("code div 4"))
    wide = reshape.long_to_wide(
        blocks, ["maybe_station", "block"], "analyte", KINDS, {"maybe_result": "mean_{name}"}, how="mean"
    )
    return wide.select("maybe_station", *[F.round(f"mean_{k}", 6).alias(f"mean_{k}") for k in KINDS])


@query("gappy_tows", sql="""
SELECT * FROM (
  SELECT sample, gear, tow, unnest(['depth', 'measure', 'share']) AS parameter, unnest([depth, measure, share]) AS value
  FROM gappy_tows) WHERE value IS NOT NULL
""")
def unpivot_drop_null(tows):
    return reshape.wide_to_long(
        tows.select("sample", "gear", "tow", "depth", "measure", "share"), ["sample", "gear", "tow"],
        ["depth", "measure", "share"], "parameter", "value",
    )


@query("gappy_tows", sql="""
WITH water AS (SELECT station, day, avg(depth) FILTER (tow % 3 = 1) AS depth_top, avg(depth) FILTER (tow % 3 = 2) AS depth_bottom,
                      max(measure) FILTER (tow % 3 = 1 AND status = 'F') AS f_top, max(measure) FILTER (tow % 3 = 1 AND status = 'O') AS o_top,
                      max(measure) FILTER (tow % 3 = 2 AND status = 'F') AS f_bottom, max(measure) FILTER (tow % 3 = 2 AND status = 'O') AS o_bottom
               FROM gappy_tows WHERE tow % 3 IN (1, 2) GROUP BY ALL),
     nutrient AS (SELECT station, day, min(depth) AS depth_nutrient, min(share) FILTER (flag = 'A') * 14.007 AS a, min(share) FILTER (flag = 'N') AS n,
                         min(share) FILTER (flag = 'R') AS r
                  FROM gappy_tows WHERE tow % 3 = 0 GROUP BY ALL)
SELECT coalesce(w.station, n.station) AS station, coalesce(w.day, n.day) AS day, round(depth_top, 6) AS depth_top,
       round(depth_bottom, 6) AS depth_bottom, f_top, o_top, f_bottom, o_bottom, depth_nutrient, round(a, 6) AS a, n, r,
       c.tows, c.last_time
FROM water w FULL JOIN nutrient n ON w.station = n.station AND w.day = n.day
JOIN (SELECT station, day, count(*) AS tows, max(time) AS last_time FROM gappy_tows GROUP BY ALL) c
  ON coalesce(w.station, n.station) = c.station AND coalesce(w.day, n.day) = c.day
""")
def split_event_nutrient(tows):
    """Water and nutrient samples of a station-day pivoted apart, by their own names and rules, and joined back. All tows."""
    def water(tow, template, depth):
        return reshape.Part(
            F.col("tow") % 3 == tow, "kind", ["f", "o"], {template: "measure"}, ids={depth: lambda mine: F.round(F.avg(mine("depth")), 6)}
        )

    nutrient = reshape.Part(
        F.col("tow") % 3 == 0, "species", ["a", "n", "r"], {"{name}": "share"}, rule=F.min,
        ids={"depth_nutrient": lambda mine: F.min(mine("depth"))}, after={"a": lambda c: F.round(c * 14.007, 6)},
    )
    named = tows.withColumns({"kind": F.lower("status"), "species": F.lower("flag")})
    return reshape.pivot_parts(
        named, ["station", "day"], [water(1, "{name}_top", "depth_top"), water(2, "{name}_bottom", "depth_bottom"), nutrient],
        tows=F.count(F.lit(1)), last_time=F.max("time"),
    )


@query("events", sql="""
SELECT event_id, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k, split_part(CAST(value AS VARCHAR), '.', 1)::DOUBLE AS whole,
       concat(event_type, '-', user_id) AS station FROM events
""")
def split_and_unite(events):
    split = reshape.split_columns(
        events.withColumn("text", F.col("value").cast("string")), "text", ["whole", "fraction"], r"\."
    )
    united = reshape.unite(split, "station", ["event_type", "user_id"], "-")
    k = F.get_json_object("props", "$.k").try_cast("double")
    return united.select("event_id", k.alias("k"), "whole", "station")


@query("customer", sql="""
SELECT c_custkey AS "Key", c_name AS "Name", c_acctbal AS "Balance", c_mktsegment AS "Group" FROM customer
""")
def header_repairs(customer):
    """Spaces and suffixes leave the headers, a column is found by pattern, others move."""
    raw = customer.select(
        F.col("c_name").alias("Na me"), F.col("c_custkey").alias("K ey"), F.col("c_mktsegment").alias("Group_top"),
        F.col("c_acctbal").alias("Calculated_Balance"),
    )
    clean = reshape.strip_suffix(reshape.strip_spaces(raw), "_top")
    balance = reshape.pick_header(clean, "^Bal|Calculated_Bal")
    return reshape.move_first(
        reshape.move_after(clean.withColumnRenamed(balance, "Balance"), ["Balance"], "Name"), ["Key"]
    )
