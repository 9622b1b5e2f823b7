"""Lookups, filters by other tables, unions and joins on shared columns."""

import datetime

from pyspark.sql import functions as F

from catalog.core import query
from tidemerge.operators import joins, repair
from tidemerge.operators.reshape import stack
from tidemerge.operators.spread import spread_join
from tidemerge.plans.integrate import combine


@query("gappy_tows", "supplier", sql="""
SELECT sample, gear, tow, maybe_station, s_name
FROM gappy_tows LEFT JOIN (SELECT CASE WHEN s_suppkey = 20 THEN NULL ELSE s_suppkey END AS k, s_name FROM supplier) s
  ON maybe_station IS NOT DISTINCT FROM k
""")
def left_lookup_null_safe(tows, supplier):
    """Stations by number; the one nameless station belongs to the tows without a number."""
    key = F.col("s_suppkey")
    stations = supplier.select(F.when(key != 20, key).alias("k"), "s_name")
    joined = joins.lookup(tows, stations, [("maybe_station", "k")])
    return joined.select("sample", "gear", "tow", "maybe_station", "s_name")


@query("tows", sql="""
SELECT t.sample, t.gear, t.tow, d.deepest, d.n FROM tows t
LEFT JOIN (SELECT station, CASE WHEN flag = 'R' THEN 'r' ELSE flag END AS flag, max(depth) AS deepest, count(*) AS n FROM tows GROUP BY ALL) d
  ON t.station = d.station AND t.flag = d.flag
""")
def composite_lookup(tows):
    daily = tows.groupBy("station", F.when(F.col("flag") == "R", "r").otherwise(F.col("flag")).alias("flag")).agg(
        F.max("depth").alias("deepest"), F.count(F.lit(1)).alias("n")
    )
    return joins.lookup(tows, daily, ["station", "flag"]).select("sample", "gear", "tow", "deepest", "n")


@query("gappy_tows", sql="""
SELECT t.sample, t.gear, t.tow, t.maybe_flag, d.n FROM gappy_tows t
LEFT JOIN (SELECT maybe_flag, status, count(*) AS n FROM gappy_tows GROUP BY ALL) d
  ON t.maybe_flag IS NOT DISTINCT FROM d.maybe_flag AND t.status = d.status
""")
def skewed_fact_join(tows):
    """Two tables of the survey's own size; a few keys hold most rows and are spread."""
    counted = tows.groupBy("maybe_flag", "status").agg(F.count(F.lit(1)).alias("n"))
    joined = spread_join(tows, counted, ["maybe_flag", "status"])
    return joined.select("sample", "gear", "tow", "maybe_flag", "n")


@query("orders", "customer", sql="""
SELECT o_orderkey, o_custkey FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
""")
def exclusion_list(orders, customer):
    listed = customer.filter("c_mktsegment = 'BUILDING'")
    kept = joins.drop_listed(orders, listed, [("o_custkey", "c_custkey")])
    return kept.select("o_orderkey", "o_custkey")


@query("gappy_tows", "supplier", sql="""
SELECT sample, gear, tow, maybe_station FROM gappy_tows
WHERE NOT EXISTS (SELECT 1 FROM supplier
                  WHERE CASE WHEN s_nationkey % 2 = 0 THEN s_suppkey ELSE -1 - s_suppkey END IS NOT DISTINCT FROM maybe_station)
""")
def anti_join_null_safe(tows, supplier):
    listed = supplier.selectExpr("CASE WHEN s_nationkey % 2 = 0 THEN s_suppkey ELSE -1 - s_suppkey END AS listed")
    kept = spread_join(tows, listed, [("maybe_station", "listed")], "left_anti")
    return kept.select("sample", "gear", "tow", "maybe_station")


@query("lineitem", "part", sql="""
SELECT l_orderkey, l_partkey, l_linenumber FROM lineitem SEMI JOIN (SELECT * FROM part WHERE p_type = 'PROMO')
  ON l_partkey = p_partkey
""")
def semi_lookup(lineitem, part):
    kept = joins.keep_listed(lineitem, part.filter("p_type = 'PROMO'"), [("l_partkey", "p_partkey")])
    return kept.select("l_orderkey", "l_partkey", "l_linenumber")


@query("gappy_tows", sql="""
WITH a AS (SELECT maybe_flag, station, count(*) AS n_odd FROM gappy_tows WHERE tow % 2 = 1 GROUP BY ALL),
     b AS (SELECT maybe_flag, CASE WHEN gear % 7 = 0 THEN -1 - station ELSE station END AS station, count(*) AS n_even
           FROM gappy_tows WHERE tow % 2 = 0 GROUP BY ALL)
SELECT coalesce(a.maybe_flag, b.maybe_flag) AS maybe_flag, coalesce(a.station, b.station) AS station, n_odd, n_even
FROM a FULL JOIN b ON a.maybe_flag IS NOT DISTINCT FROM b.maybe_flag AND a.station = b.station
""")
def natural_full_join(tows):
    def counted(rows, name):
        return rows.groupBy("maybe_flag", "station").agg(F.count(F.lit(1)).alias(name))

    odd = counted(tows.filter("tow % 2 = 1"), "n_odd")
    shifted = tows.withColumn("station", F.expr("CASE WHEN gear % 7 = 0 THEN -1 - station ELSE station END"))
    return joins.natural_join(odd, counted(shifted.filter("tow % 2 = 0"), "n_even"), "full")


@query("supplier", "nation", sql="""
SELECT s_suppkey, coalesce(balance, CAST(n_regionkey AS DOUBLE)) AS balance
FROM (SELECT s_suppkey, s_nationkey, CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE s_acctbal END AS balance FROM supplier)
LEFT JOIN nation ON s_nationkey = n_nationkey
""")
def coalesce_lookup(supplier, nation):
    gappy = supplier.select(
        "s_suppkey", "s_nationkey", F.when(F.col("s_suppkey") % 3 != 0, F.col("s_acctbal")).alias("balance")
    )
    other = nation.select("n_nationkey", F.col("n_regionkey").cast("double").alias("balance"))
    return joins.fill_from(gappy, other, [("s_nationkey", "n_nationkey")], ["balance"]).drop("s_nationkey")


@query("tows", "supplier", sql="""
SELECT sample, gear, tow, CASE WHEN day <= last_old THEN 'NTU' WHEN day >= first_new THEN 'FNU' ELSE 'open' END AS method
FROM tows LEFT JOIN (
  SELECT s_suppkey, CASE WHEN s_suppkey % 6 = 0 THEN NULL ELSE make_date(1996 + s_suppkey % 4, 6, 1) END AS last_old,
         CASE WHEN s_suppkey % 6 = 1 THEN NULL ELSE make_date(1997 + s_suppkey % 4, 2, 1) END AS first_new
  FROM supplier) ON station = s_suppkey
""")
def effective_date(tows, supplier):
    """Method of each tow by its station's change dates; between them the method is open."""
    key = F.col("s_suppkey")
    changes = supplier.select(
        "s_suppkey",
        F.when(key % 6 != 0, F.make_date((1996 + key % 4).cast("int"), F.lit(6), F.lit(1))).alias("last_old"),
        F.when(key % 6 != 1, F.make_date((1997 + key % 4).cast("int"), F.lit(2), F.lit(1))).alias("first_new"),
    )
    dated = joins.lookup(tows, changes, [("station", "s_suppkey")])
    method = joins.by_change_date(
        F.col("day"), F.col("last_old"), F.col("first_new"), F.lit("NTU"), F.lit("FNU"), F.lit("open")
    )
    return dated.select("sample", "gear", "tow", method.alias("method"))


@query("orders", "lineitem", sql="""
SELECT o_orderkey, o_orderdate FROM orders
WHERE o_orderdate >= (SELECT min(l_shipdate) FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 45)
  AND o_orderdate <= (SELECT max(l_shipdate) FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 45) 
""")
def within_period(orders, lineitem):
    reference = lineitem.filter("l_returnflag = 'R' AND l_quantity > 45").withColumnRenamed("l_shipdate", "o_orderdate")
    return joins.within_period_of(orders, reference, "o_orderdate").select("o_orderkey", "o_orderdate")


@query("readings", sql="""
SELECT CAST(sum(a * b) AS BIGINT) AS paired_rows, CAST(coalesce(sum(a) FILTER (b = 0), 0) AS BIGINT) AS unpaired_rows
FROM (SELECT maybe_station, day, count(*) FILTER (analyte = 'click') AS a, count(*) FILTER (analyte = 'view') AS b
      FROM readings GROUP BY ALL)
""")
def co_occurrence(readings):
    is_kind = F.col("analyte")
    return joins.co_occurrence(readings, ["maybe_station", "day"], is_kind == "click", is_kind == "view")


@query("lab_text", sql="""
SELECT code, std AS analyte, value FROM lab_text
JOIN (VALUES ('click', 'DissAmmonia'), ('view', 'Chlorophyll'), ('error', 'TotPhos')) a(name, std) ON analyte = name
""")
def standardize_analyte(lab):
    """An inner join with a literal table filters and renames at once."""
    names = joins.literal_table(
        lab, ["analyte", "std"], [("click", "DissAmmonia"), ("view", "Chlorophyll"), ("error", "TotPhos")]
    )
    return lab.join(names, "analyte").select("code", F.col("std").alias("analyte"), "value")


@query("customer", "supplier", sql="""
SELECT * FROM (SELECT c_custkey AS key, c_acctbal AS balance, c_mktsegment AS segment FROM customer)
UNION ALL BY NAME (SELECT s_acctbal AS balance, s_suppkey AS key, s_name AS name FROM supplier)
""")
def ragged_union(customer, supplier):
    c = customer.selectExpr("c_custkey AS key", "c_acctbal AS balance", "c_mktsegment AS segment")
    return combine([c, supplier.selectExpr("s_acctbal AS balance", "s_suppkey AS key", "s_name AS name")])


@query("customer", "supplier", sql="""
SELECT c_nationkey AS nation, c_custkey % 10 AS part FROM customer
UNION SELECT s_nationkey, s_suppkey % 10 FROM supplier
""")
def union_distinct(customer, supplier):
    c = customer.selectExpr("c_nationkey AS nation", "c_custkey % 10 AS part")
    return stack([c, supplier.selectExpr("s_nationkey AS nation", "s_suppkey % 10 AS part")]).distinct()


@query("orders", sql="""
SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 3 THEN verified ELSE o_totalprice END AS value
FROM (SELECT *, CASE WHEN o_orderkey % 20 = 3 THEN NULL ELSE o_totalprice * 2 END AS verified FROM orders)
WHERE o_custkey % 50 <> 7 AND (o_orderkey % 10 <> 3 OR verified IS NOT NULL)
""")
def corrections_overlay(orders):
    """Verified values replace listed ones; unknown samples and unverified listed values leave."""
    key = F.col("o_orderkey")
    unknown = F.col("o_custkey") % 50 == 7
    listed = orders.filter((key % 10 == 3) | unknown).select(
        "o_orderkey",
        F.when(unknown, "Unknown").otherwise("Yes").alias("state"),
        F.when(key % 20 != 3, F.col("o_totalprice") * 2).alias("verified"),
    )
    fixed = repair.overlay_corrections(
        orders.select("o_orderkey", F.col("o_totalprice").alias("value")), listed, ["o_orderkey"], "value",
        "verified", F.col("state").rlike("(?i)unknown"), "o_orderkey",
    )
    return fixed


@query("lab_text", sql="""
SELECT code, number, CASE WHEN number NOT IN ('(NONE)', '(UserDefined)') THEN number
                          WHEN analyte = 'click' THEN 'A1'
                          WHEN analyte = 'view' AND number = '(NONE)' THEN 'B2' END AS station_id
FROM (SELECT code, analyte, CASE WHEN code % 3 = 0 THEN '(NONE)' WHEN code % 3 = 1 THEN '(UserDefined)'
                            ELSE CAST(station AS VARCHAR) END AS number FROM lab_text)
WHERE CASE WHEN number NOT IN ('(NONE)', '(UserDefined)') THEN number WHEN analyte = 'click' THEN 'A1'
           WHEN analyte = 'view' AND number = '(NONE)' THEN 'B2' END IS NOT NULL
""")
def assign_missing_station_ids(lab):
    code = F.col("code") % 3
    number = F.when(code == 0, "(NONE)").when(code == 1, "(UserDefined)").otherwise(F.col("station").cast("string"))
    numbered = lab.select("code", "analyte", number.alias("number"), number.alias("station_id"))
    rules = [("click", None, "A1"), ("view", "(NONE)", "B2")]
    known = repair.assign_ids(numbered, "station_id", "analyte", ["(NONE)", "(UserDefined)"], rules)
    return known.drop("analyte")
