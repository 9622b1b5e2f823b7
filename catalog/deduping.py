"""First, extreme, repaired, modal and averaged records, group values and depth bins."""

from pyspark.sql import functions as F

from catalog.core import VIEWS, query
from tidemerge.functions import clock, nulls
from tidemerge.operators import dedup, depth, joins, merge, reshape
from tidemerge.operators.spread import attach_group

ALL = "sample, station, gear, tow, depth, measure, rate, share, flag, status, time"
ORDER = ALL.split(", ")


@query("tows", sql="SELECT sample, tow, count(*) AS n FROM tows GROUP BY ALL HAVING count(*) > 1")
def duplicate_report(tows):
    return dedup.duplicate_keys(tows, ["sample", "tow"])


@query("tows", sql=f"""
SELECT sample, tow, station, gear, depth, measure FROM tows
QUALIFY row_number() OVER (PARTITION BY sample, tow ORDER BY time, {ALL}) = 1
""")
def keep_first(tows):
    first = dedup.keep_first(tows, ["sample", "tow"], ["time", *ORDER])
    return first.select("sample", "tow", "station", "gear", "depth", "measure")


@query("tows", sql="""
SELECT sample, station, gear, tow, depth FROM tows
QUALIFY depth = min(depth) OVER (PARTITION BY station, flag)
""")
def keep_extreme_ties(tows):
    """All tows at the least depth of their station; every group is treated as hot."""
    kept = dedup.keep_extreme(tows, ["station", "flag"], "depth")
    return kept.select("sample", "station", "gear", "tow", "depth")


@query("gappy_tows", sql="""
SELECT sample, station, gear, tow, depth FROM gappy_tows
WINDOW w AS (PARTITION BY sample)
QUALIFY depth = CASE WHEN count(*) OVER w = count(depth) OVER w THEN min(depth) OVER w END
""")
def keep_extreme_strict_null(tows):
    """A group with an unknown depth has no least one and leaves."""
    return dedup.keep_extreme(tows, ["sample"], "depth").select("sample", "station", "gear", "tow", "depth")


@query("gappy_tows", sql="""
SELECT sample, station, gear, tow, depth FROM gappy_tows
WINDOW w AS (PARTITION BY sample)
QUALIFY depth = CASE WHEN count(*) OVER w = count(depth) OVER w THEN max(depth) OVER w END
""")
def keep_deepest_strict(tows):
    kept = dedup.keep_extreme(tows, ["sample"], "depth", largest=True, few_ties=True)
    return kept.select("sample", "station", "gear", "tow", "depth")


@query("gappy_tows", sql="""
WITH s1 AS (
  SELECT * FROM gappy_tows WINDOW w AS (PARTITION BY sample)
  QUALIFY depth = CASE WHEN count(*) OVER w = count(depth) OVER w THEN min(depth) OVER w END)
SELECT sample, gear, tow, depth, measure FROM s1 WINDOW w AS (PARTITION BY sample)
QUALIFY measure = CASE WHEN count(*) OVER w = count(measure) OVER w THEN min(measure) OVER w END
""")
def first_tow_two_stage(tows):
    kept = dedup.keep_extreme(tows, ["sample"], "depth", "measure", few_ties=True)
    return kept.select("sample", "gear", "tow", "depth", "measure")


@query("tows", sql=f"""
SELECT sample, tow, station, gear, measure FROM (
  SELECT *, count(*) OVER (PARTITION BY sample, tow) AS n FROM tows)
WHERE n = 1 OR flag <> 'R'
QUALIFY row_number() OVER (PARTITION BY sample, tow ORDER BY {ALL}) = 1
""")
def split_repair_union(tows):
    """Repeated tows lose the returned ones and keep the first; single tows stay."""
    fixed = dedup.repair_repeated(tows, ["sample", "tow"], F.col("flag") != "R", ORDER)
    return fixed.select("sample", "tow", "station", "gear", "measure")


@query("gappy_tows", sql=f"""
SELECT station, day, tow, gear, n.mean_depth AS depth, n.n_measures AS measure FROM (
  SELECT *, count(*) OVER w AS n_all, avg(depth) OVER kept AS mean_kept, max(measure) OVER kept AS most
  FROM gappy_tows WINDOW w AS (PARTITION BY station, day), kept AS (PARTITION BY station, day, flag <> 'R')) t,
  LATERAL (SELECT CASE WHEN n_all = 1 THEN depth ELSE round(mean_kept, 6) END AS mean_depth, CASE WHEN n_all = 1 THEN measure ELSE most END AS n_measures) n
WHERE n_all = 1 OR flag <> 'R'
QUALIFY row_number() OVER (PARTITION BY station, day ORDER BY sample, tow, gear) = 1
""")
def repair_by_mean(tows):
    """Station-days of several tows lose the returned ones; of the rest the first stays, with their mean depth and largest measure."""
    fixed = dedup.repair_repeated(
        tows, ["station", "day"], F.col("flag") != "R", ["sample", "tow", "gear"], {"depth": lambda c: F.round(F.avg(c), 6), "measure": F.max}
    )
    return fixed.select("station", "day", "tow", "gear", "depth", "measure")


@query("lab_text", sql="""
SELECT station, day, analyte, code, notes FROM (
  SELECT *, count(*) OVER (PARTITION BY station, day, analyte) AS n FROM lab_text)
WHERE n = 1 OR NOT coalesce(regexp_matches(notes, 'duplicate', 'i'), FALSE)
QUALIFY row_number() OVER (PARTITION BY station, day, analyte ORDER BY code) = 1
""")
def resolve_replicates(lab):
    rejected = F.col("notes").rlike("(?i)duplicate")
    kept = dedup.resolve_replicates(lab, ["station", "day", "analyte"], rejected, ["code"])
    return kept.select("station", "day", "analyte", "code", "notes")


@query("gappy_tows", sql="""
SELECT station, day, measure, share, maybe_flag, sample, gear, tow FROM gappy_tows
QUALIFY row_number() OVER (PARTITION BY station, day, measure, share, maybe_flag
                           ORDER BY depth NULLS LAST, sample, gear, tow) = 1
""")
def replicate_dedup(tows):
    """Replicates with the same measures: the shallowest tow stays, unknown depths last."""
    same = ["station", "day", "measure", "share", "maybe_flag"]
    order = [F.col("depth").asc_nulls_last(), "sample", "gear", "tow"]
    return dedup.keep_first(tows, same, order).select(*same, "sample", "gear", "tow")


@query("readings", sql="""
WITH counted AS (SELECT maybe_station, day, maybe_analyte, count(*) AS n, min(code) AS first_code
                 FROM readings WHERE maybe_analyte IS NOT NULL GROUP BY ALL),
modal AS (SELECT * FROM counted
          QUALIFY row_number() OVER (PARTITION BY maybe_station, day ORDER BY n DESC, first_code) = 1),
means AS (SELECT maybe_station, day, round(avg(maybe_result), 6) AS mean_result FROM readings GROUP BY ALL)
SELECT means.maybe_station AS station, means.day, mean_result, modal.maybe_analyte AS modal_analyte
FROM means JOIN modal ON means.maybe_station IS NOT DISTINCT FROM modal.maybe_station AND means.day = modal.day
""")
def collapse_visits_mode(readings):
    """Station-days with the mean of the known results and the modal analyte; without one they vanish."""
    visit = ["maybe_station", "day"]
    modal = dedup.modal_value(readings, visit, "maybe_analyte", F.col("code"), "modal_analyte")
    means = readings.groupBy(*visit).agg(F.round(F.avg("maybe_result"), 6).alias("mean_result"))
    return joins.merge_unique([means, modal], visit).filter(F.col("modal_analyte").isNotNull()).withColumnRenamed("maybe_station", "station")


VIEWS["field_log"] = """
SELECT station, date_trunc('hour', time) AS time, code AS sample, analyte, maybe_result AS value,
       CASE WHEN code % 4 = 0 THEN NULL ELSE day END AS day, code AS _row FROM {readings}
"""
VIEWS["lab_log"] = """
SELECT station, date_trunc('hour', time) AS time, CASE WHEN code % 3 = 0 THEN code ELSE code + 1000000000 END AS sample,
       analyte, CASE WHEN code % 5 = 0 THEN result + 1 ELSE result END AS value, day, code AS _row FROM {readings}
"""


@query("field_log", "lab_log", sql="""
WITH both_feeds AS (
  SELECT station, time, sample, analyte, value, day, min((feed, _row)) AS place FROM (
    SELECT 0 AS feed, * FROM field_log UNION ALL SELECT 1, * FROM lab_log) GROUP BY ALL),
samples AS (
  SELECT *, count(*) OVER s AS n FROM both_feeds WINDOW s AS (PARTITION BY station, time, sample)
  QUALIFY row_number() OVER (PARTITION BY station, time, sample ORDER BY value IS NULL, place) = 1)
SELECT station, time, round(avg(value), 6) AS value, max(sample) AS sample, sum(n)::BIGINT AS n,
       arg_min(analyte, (value IS NULL, place)) AS analyte, min(day) AS day
FROM samples GROUP BY station, time
""")
def conflict_merge(field_log, lab_log):
    """Two feeds of partly the same samples: known values first, then the mean per visit. All records of both."""
    feeds = [f.withColumn("time", F.col("time").cast("timestamp_ntz")) for f in (field_log, lab_log)]
    known_first = [F.col("value").isNull()]
    rules = {"value": merge.mean, "sample": merge.largest, "day": merge.smallest}
    merged = merge.merge_feeds(feeds, ["station", "time"], rules, alike=[merge.Alike(["sample"], known_first)], first=known_first)
    return merged.select("station", "time", F.round("value", 6).alias("value"), "sample", F.col(merge.RECORDS).alias("n"), "analyte", "day")


@query("gappy_tows", sql="""
SELECT sample, gear, tow, count(*) OVER (PARTITION BY maybe_flag, status) AS n FROM gappy_tows
""")
def group_size(tows):
    """Few, large groups: all of them take the hot path."""
    sized = dedup.group_size(tows, ["maybe_flag", "status"], "n")
    return sized.select("sample", "gear", "tow", "n")


@query("gappy_tows", sql="""
SELECT sample, gear, tow,
  CASE WHEN count(*) OVER w = count(depth) OVER w THEN round(avg(depth) OVER w, 6) END AS mean_depth,
  CASE WHEN count(*) OVER w = count(depth) OVER w THEN max(depth) OVER w END AS deepest
FROM gappy_tows WINDOW w AS (PARTITION BY sample)
""")
def strict_group_mean(tows):
    attached = attach_group(
        tows, ["sample"],
        mean_depth=F.round(nulls.strict_mean(F.col("depth")), 6),
        deepest=nulls.strict_max(F.col("depth")),
    )
    return attached.select("sample", "gear", "tow", "mean_depth", "deepest")


@query("readings", sql="""
SELECT station, make_timestamp((epoch_us(min(time)) + (epoch_us(max(time)) - epoch_us(min(time))) // 2)::BIGINT) AS middle,
       make_timestamp((sum(epoch_us(time)) // count(*))::BIGINT) AS mean_time
FROM readings GROUP BY station
""")
def time_midpoint(readings):
    return readings.groupBy("station").agg(
        clock.midpoint(F.min("time"), F.max("time")).alias("middle"), clock.mean_time(F.col("time")).alias("mean_time")
    )


@query("gappy_tows", sql="""
WITH t AS (
  SELECT *, CASE WHEN count(*) OVER w = count(depth) OVER w THEN min(depth) OVER w END AS top,
            CASE WHEN count(*) OVER w = count(depth) OVER w THEN max(depth) OVER w END AS deep
  FROM gappy_tows WINDOW w AS (PARTITION BY station, day))
SELECT sample, gear, tow, depth, CASE WHEN depth = top AND depth < 25 THEN 'surface' ELSE 'bottom' END AS depth_bin
FROM t WHERE (depth = top AND depth < 25) OR (depth = deep AND depth > 25)
""")
def depth_bin_daily(tows):
    binned = depth.bin_daily(tows, ["station", "day"], "depth", 25)
    return binned.select("sample", "gear", "tow", "depth", F.col(depth.BIN).alias("depth_bin"))


@query("tows", sql="""
WITH long AS (
  SELECT sample, gear, tow, station, day, depth, unnest(['water', 'nutrient', 'algae']) AS parameter,
         unnest([measure, rate, share]) AS value FROM (
    SELECT sample, gear, tow, station, day, depth, measure,
           CASE WHEN gear % 3 = 0 THEN NULL ELSE rate END AS rate,
           CASE WHEN gear % 4 = 0 THEN NULL ELSE share END AS share FROM tows)),
t AS (SELECT *, min(depth) OVER w AS top, max(depth) OVER w AS deep FROM long WHERE value IS NOT NULL
      WINDOW w AS (PARTITION BY station, day, parameter)),
binned AS (SELECT *, CASE WHEN parameter <> 'nutrient' AND depth < 20 AND depth = top THEN 'surface'
                          WHEN parameter = 'nutrient' AND depth < 30 AND depth = top THEN 'nutrient'
                          WHEN parameter <> 'nutrient' AND depth > 20 AND depth = deep THEN 'bottom' END AS depth_bin FROM t)
SELECT sample, gear, tow, parameter, value, depth_bin FROM binned
WHERE depth_bin IS NOT NULL AND NOT (parameter = 'algae' AND depth_bin = 'bottom')
""")
def depth_bin_by_param(tows):
    gaps = tows.select(
        "sample", "gear", "tow", "station", "day", "depth", F.col("measure").alias("water"),
        F.when(F.col("gear") % 3 != 0, F.col("rate")).alias("nutrient"),
        F.when(F.col("gear") % 4 != 0, F.col("share")).alias("algae"),
    )
    ids = ["sample", "gear", "tow", "station", "day", "depth"]
    long = reshape.wide_to_long(gaps, ids, ["water", "nutrient", "algae"], "parameter", "value")
    binned = depth.bin_by_parameter(
        long, ["station", "day"], "parameter", "depth", ["water", "algae"], ["nutrient"],
        water_limit=20, nutrient_limit=30, surface_only=["algae"],
    )
    return binned.select("sample", "gear", "tow", "parameter", "value", F.col(depth.BIN).alias("depth_bin"))
