"""Operators against brute force, with every key hot and with none."""

import collections
import random
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import rows
from tidemerge.functions.censor import SIGNS
from tidemerge.functions.nulls import strict_min
from tidemerge.operators import audit, dedup, depth, joins, merge, quality, repair, reshape
from tidemerge.operators.spread import attach_group, full_join, grid_join, null_safe_join, spread_join

HOT = pytest.mark.parametrize("hot_rows", [1, 3, 10_000])


@pytest.fixture(scope="module")
def skewed():
    """A third of the rows under one key, another third without a key."""
    rnd = random.Random(7)
    keys = ["hot"] * 40 + [None] * 40 + [f"k{rnd.randrange(15)}" for _ in range(40)]
    return [(k, rnd.choice([None, 1, 2, 2, 3]), i) for i, k in enumerate(keys)]


@pytest.fixture(scope="module")
def facts(spark, skewed):
    return spark.createDataFrame(skewed, "k string, v int, i int").repartition(5)


@pytest.fixture(scope="module")
def dims(spark):
    table = [("hot", "a"), ("hot", "b"), (None, "c"), ("k1", "d"), ("k99", "e")]
    return table, spark.createDataFrame(table, "k string, d string")


class TestSpread:
    @HOT
    @pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
    def test_join_like_brute_force(self, facts, skewed, dims, hot_rows, how):
        table, df = dims
        want = []
        for k, v, i in skewed:
            found = [d for dk, d in table if dk == k]
            if how in ("left", "inner"):
                want += [(k, v, i, d) for d in found or ([None] if how == "left" else [])]
            elif bool(found) == (how == "left_semi"):
                want.append((k, v, i))
        got = spread_join(facts, df, ["k"], how, hot_rows=hot_rows, spread_by=["i"])
        assert collections.Counter(map(tuple, got.collect())) == collections.Counter(want)

    @HOT
    def test_full_join(self, facts, skewed, dims, hot_rows):
        table, df = dims
        want = [(k, v, i, d) for k, v, i in skewed for d in [x for y, x in table if y == k] or [None]]
        want += [(k, None, None, d) for k, d in table if k not in {r[0] for r in skewed}]
        got = full_join(facts, df, ["k"], hot_rows=hot_rows)
        assert collections.Counter(map(tuple, got.collect())) == collections.Counter(want)

    @HOT
    def test_group_values(self, facts, skewed, hot_rows):
        groups = collections.defaultdict(list)
        for k, v, _ in skewed:
            groups[k].append(v)
        least = {k: None if None in g else min(g) for k, g in groups.items()}
        got = attach_group(
            facts, ["k"], hot_rows=hot_rows, n=F.count(F.lit(1)), low=strict_min(F.col("v"))
        )
        assert {r.i: (r.n, r.low) for r in got.collect()} == {i: (len(groups[k]), least[k]) for k, _, i in skewed}
        assert got.count() == len(skewed)

    def test_group_value_may_replace_a_column(self, facts):
        got = attach_group(facts, ["k"], v=F.max("v"))
        assert got.columns == ["k", "i", "v"]

    def test_other_joins_are_refused(self, facts, dims):
        with pytest.raises(ValueError):
            spread_join(facts, dims[1], ["k"], "full")

    def test_shares_of_a_hot_key_differ(self, spark):
        """Identical rows of one key reach several partitions."""
        copies = spark.range(0, 4000, 1, 8).select(F.lit("x").alias("k"))
        dim = spark.createDataFrame([("x", 1)], "k string, d int")
        joined = spread_join(copies, dim, ["k"], hot_rows=100)
        assert joined.count() == 4000 and joined.agg(F.sum("d")).first()[0] == 4000

    def test_keys_named_differently(self, spark, facts):
        dim = spark.createDataFrame([("hot", 1), (None, 2)], "other string, d int")
        got = null_safe_join(facts, dim, [("k", "other")])
        assert got.columns == ["k", "v", "i", "d"] and got.filter("k IS NULL AND d = 2").count() == 40

    @HOT
    def test_all_rows_count_though_some_are_returned(self, spark, hot_rows):
        df = spark.createDataFrame([("a", 1, 5.0), ("a", 2, 9.0), ("b", 3, 1.0), (None, 4, 2.0), (None, 1, 7.0)], "k string, i int, v double")
        got = attach_group(df, ["k"], hot_rows=hot_rows, only=F.col("i") < 3, without=["v"], best=F.max("v"))
        assert got.columns == ["k", "i", "best"]
        assert rows(got) == [("a", 1, 9.0), ("a", 2, 9.0), (None, 1, 7.0)]


class TestDedup:
    @HOT
    def test_keep_extreme(self, facts, skewed, hot_rows):
        groups = collections.defaultdict(list)
        for k, v, _ in skewed:
            groups[k].append(v)
        want = sorted(i for k, v, i in skewed if None not in groups[k] and v == min(groups[k]))
        assert sorted(r.i for r in dedup.keep_extreme(facts, ["k"], "v", hot_rows=hot_rows).collect()) == want

    @pytest.mark.parametrize("tows, kept", [
        ([(1, 8, 2), (1, 8, 1), (1, 9, 0)], [(1, 8, 1)]),
        ([(1, 8, 1), (1, None, 2)], []),
        ([(1, 8, None), (1, 8, 1)], []),
        ([(1, 8, 1), (1, 9, None)], [(1, 8, 1)]),
        ([(None, 8, 1), (None, 9, 1)], [(None, 8, 1)]),
        ([(1, 8, 1), (1, 8, 1)], [(1, 8, 1), (1, 8, 1)]),
    ])
    def test_two_stage_first(self, spark, tows, kept):
        df = spark.createDataFrame(tows, "k int, t int, n int")
        assert rows(dedup.keep_extreme(df, ["k"], "t", "n")) == kept

    @settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
    @given(data=st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.sampled_from([1, 2, None])), min_size=1, max_size=20))
    def test_keep_first_is_the_first_and_idempotent(self, spark, data):
        df = spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(data)], "k string, v int, _row int")
        first = dedup.keep_first(df, ["k", "v"])
        want = {}
        for i, kv in enumerate(data):
            want.setdefault(kv, i)
        assert {(r.k, r.v): r._row for r in first.collect()} == want
        assert rows(dedup.keep_first(first, ["k", "v"])) == rows(first)

    def test_keep_first_limits_before_the_shuffle(self, facts):
        plan = dedup.keep_first(facts, ["k"], ["i"])._jdf.queryExecution().executedPlan().toString()
        assert plan.count("WindowGroupLimit") == 2
        plan = dedup.resolve_replicates(facts, ["k"], F.col("v") == 2, ["i"])._jdf.queryExecution().executedPlan().toString()
        assert plan.count("WindowGroupLimit") == 2

    def test_split_repair_with_identity_changes_nothing(self, facts, skewed):
        same = dedup.split_repair(facts, ["k"], lambda d: d, hot_rows=5)
        assert collections.Counter(map(tuple, same.collect())) == collections.Counter(skewed)

    @pytest.mark.parametrize("notes, survivor", [
        (["duplicate"], 0), (["duplicate", None], 1), ([None, None], 0), (["duplicate", "DUPLICATE"], None), (["ok", "Duplicate", None], 0),
    ])
    def test_resolve_replicates(self, spark, notes, survivor):
        df = spark.createDataFrame([(1, n, i) for i, n in enumerate(notes)], "k int, notes string, i int")
        got = dedup.resolve_replicates(df, ["k"], F.col("notes").rlike("(?i)duplicate"), ["i"]).collect()
        assert [r.i for r in got] == ([] if survivor is None else [survivor])

    @pytest.mark.parametrize("values, mode", [(["b", "a", "a", "b"], "b"), ([None, None, "a"], "a"), ([None], None), (["c", "a", "a"], "a")])
    def test_mode_prefers_the_first_seen(self, spark, values, mode):
        df = spark.createDataFrame([(1, v, i) for i, v in enumerate(values)], "k int, v string, i int")
        got = [r.v for r in dedup.modal_value(df, ["k"], "v", F.col("i")).collect()]
        assert got == ([] if mode is None else [mode])

    def test_duplicates(self, facts):
        assert dedup.duplicate_keys(facts, ["k"]).filter("k IS NULL").first().n == 40
        assert dedup.duplicate_rows(facts, ["i"]).count() == 0


class TestReshape:
    def test_wide_and_back(self, spark):
        data = [(1, "a", 1.0), (1, "b", 2.0), (2, "a", 3.0), (None, "b", 4.0)]
        long = spark.createDataFrame(data, "id int, Parameter string, Value double")
        wide = reshape.long_to_wide(long, ["id"], "Parameter", ["a", "b"], {"Value": "{name}"}, order=F.lit(1))
        assert wide.columns == ["id", "a", "b"]
        assert rows(reshape.wide_to_long(wide, ["id"], ["a", "b"])) == rows(long)

    def test_first_of_duplicates_may_be_null(self, spark):
        long = spark.createDataFrame([(1, "a", None, 0), (1, "a", 2.0, 1)], "id int, p string, v double, _row int")
        assert reshape.long_to_wide(long, ["id"], "p", ["a", "b"], {"v": "{name}"}).collect()[0].a is None

    def test_mean_of_duplicates_is_strict(self, spark):
        long = spark.createDataFrame([(1, "a", 1.0), (1, "a", 3.0), (1, "b", None), (1, "b", 3.0)], "id int, p string, v double")
        got = reshape.long_to_wide(long, ["id"], "p", ["a", "b", "c"], {"v": "{name}"}, how="mean").first()
        assert tuple(got) == (1, 2.0, None, None)

    def test_unknown_rule(self, spark):
        long = spark.createDataFrame([(1, "a", 1.0)], "id int, p string, v double")
        with pytest.raises(ValueError):
            reshape.long_to_wide(long, ["id"], "p", ["a"], {"v": "{name}"}, how="median")

    def test_stack_keeps_feed_order(self, spark):
        a, b = spark.createDataFrame([(1, 5)], "x int, _row int"), spark.createDataFrame([(2, 0)], "y int, _row int")
        stacked = reshape.stack([a, b])
        assert [(r.x, r.y) for r in stacked.orderBy("_row").collect()] == [(1, None), (None, 2)]

    def test_headers(self, spark):
        df = spark.createDataFrame([(1, 2, 3)], "`Collection Date` int, Oxygen int, Result_top int")
        assert reshape.strip_spaces(df).columns == ["CollectionDate", "Oxygen", "Result_top"]
        assert reshape.pick_header(df, "^Oxygen|Calculated_Oxygen") == "Oxygen"
        with pytest.raises(ValueError):
            reshape.pick_header(df, "O|R")
        assert reshape.strip_suffix(df, "_top").columns[-1] == "Result"
        assert reshape.columns_like(df, "n$", types=["int"]) == ["Oxygen"]
        assert reshape.move_after(df, ["Collection Date"], "Oxygen").columns == ["Oxygen", "Collection Date", "Result_top"]

    def test_split_columns(self, spark):
        df = spark.createDataFrame([("38-5-57.2",), ("38-5",), (None,)], "t string")
        assert rows(reshape.split_columns(df, "t", ["d", "m", "s"], "-")) == [(38.0, 5.0, 57.2), (38.0, 5.0, None), (None, None, None)]


class TestDepth:
    @HOT
    def test_daily_bins(self, spark, hot_rows):
        data = [("x", 1.0), ("x", 2.0), ("x", 30.0), ("y", 3.0), ("z", 5.0), ("w", 1.0), ("w", None), ("v", 2.0)]
        df = spark.createDataFrame(data, "k string, d double")
        got = depth.bin_daily(df, ["k"], "d", 3, hot_rows=hot_rows)
        assert rows(got, "k", "d", depth.BIN) == [("v", 2.0, "surface"), ("x", 1.0, "surface"), ("x", 30.0, "bottom"), ("z", 5.0, "bottom")]

    def test_times_of_a_profile_do_not_travel(self, spark):
        df = spark.range(40).select((F.col("id") % 4).alias("k"), (F.col("id") / 4).alias("d"), F.timestamp_seconds("id").cast("timestamp_ntz").alias("t"))
        binned = depth.bin_daily(df, ["k"], "d", 3, "t")
        assert binned.columns == ["k", "d", "t", depth.BIN]
        plan = binned._jdf.queryExecution().optimizedPlan().toString()
        # the spreading number is made from all that travels with a row
        hashed = re.findall(r"xxhash64\(([^)]*\)[^)]*)\)", plan)
        assert hashed and all("d#" in h and "t#" not in h for h in hashed)
        assert sorted((r.k, r.d, r.t.second) for r in binned.collect()) == sorted((k, d, 18 + k) for k in range(4) for d in (k / 4, 9 + k / 4))


class TestJoins:
    def test_suffix(self, spark):
        df = spark.createDataFrame([("a", 1)], "k string, x int")
        got = joins.lookup(df, spark.createDataFrame([("a", 2)], "k string, x int"), ["k"], suffix="_field")
        assert got.columns == ["k", "x_field", "x"]

    def test_period_with_a_missing_value_keeps_nothing(self, spark):
        days = spark.createDataFrame([(d,) for d in (1, 2, 3, 4, None)], "day int")
        known = spark.createDataFrame([(2,), (3,)], "day int")
        assert rows(joins.within_period_of(days, known, "day")) == [(2,), (3,)]
        assert joins.within_period_of(days, known.union(spark.createDataFrame([(None,)], "day int")), "day").count() == 0
        assert joins.within_period_of(days, known.limit(0), "day").count() == 0

    def test_natural_join_needs_shared_columns(self, spark):
        with pytest.raises(ValueError):
            joins.natural_join(spark.range(1), spark.range(1).toDF("other"))

    def test_listed(self, spark):
        df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
        listed = spark.createDataFrame([("a",), ("a",)], "k string")
        assert rows(joins.keep_listed(df, listed, ["k"])) == [("a",)]
        assert rows(joins.drop_listed(df, listed, ["k"])) == [("b",), (None,)]

    def test_merge_unique(self, spark):
        a, b = spark.createDataFrame([(1, 2), (None, 3)], "k int, x int"), spark.createDataFrame([(None, 4), (5, 6)], "k int, y int")
        assert rows(joins.merge_unique([a, b], ["k"])) == [(1, 2, None), (5, None, 6), (None, 3, 4)]

    def test_co_occurrence_counts_pairs(self, spark):
        df = spark.createDataFrame([("s", "a"), ("s", "a"), ("s", "b"), ("t", "a"), (None, "a"), (None, "b")], "k string, x string")
        assert tuple(joins.co_occurrence(df, ["k"], F.col("x") == "a", F.col("x") == "b").first()) == (3, 1)


class TestRepair:
    def test_corrections(self, spark):
        df = spark.createDataFrame([("s1", "pH", 1.0), ("s1", "T", 2.0), ("s2", "pH", 3.0), ("s3", "pH", 4.0), (None, "pH", 5.0)], "s string, a string, v double")
        listed = spark.createDataFrame([("s1", "pH", "Yes", 9.0), ("s1", "T", "No", None), ("s2", "T", "unknown", None)], "s string, a string, m string, w double")
        got = repair.overlay_corrections(df, listed, ["s", "a"], "v", "w", F.col("m").rlike("(?i)unknown"), "s")
        assert rows(got) == [("s1", "pH", 9.0), ("s3", "pH", 4.0), (None, "pH", 5.0)]

    def test_station_ids(self, spark):
        df = spark.createDataFrame([("(NONE)", "A"), ("(NONE)", "Z"), ("N1", "A"), (None, "A")], "id string, name string")
        assert rows(repair.assign_ids(df, "id", "name", ["(NONE)"], [("A", None, "I")])) == [("I", "A"), ("N1", "A"), (None, "A")]


class TestAudit:
    def test_field_equivalence_like_pairs(self, spark):
        rnd = random.Random(3)
        make = lambda n: [(rnd.choice(["k", "k", None, "j"]), rnd.choice(["x", "y", None])) for _ in range(n)]
        left, right = make(30), make(25)
        pairs = [(a, b) for k, a in left for q, b in right if k == q]
        want = (len(pairs), sum(a is not None and b is not None and a != b for a, b in pairs), sum(a is None or b is None for a, b in pairs))
        l, r = spark.createDataFrame(left, "k string, f string"), spark.createDataFrame(right, "k string, f string")
        got = audit.field_equivalence(l, r, ["k"], ["f"]).first()
        assert (got.pairs, got.different, got.unknown) == want
        counted = collections.Counter((a, b) for a, b in pairs if a and b and a != b)
        for hot in (1, 100):
            met = audit.differing_values(l, r, ["k"], "f", hot_rows=hot)
            assert {(x.left_value, x.right_value): x.n for x in met.collect()} == counted

    def test_field_equivalence_holds_values_once(self, spark):
        l = spark.createDataFrame([("a", "x", 1), ("a", None, 2), (None, "x", 3)], "k string, f string, g int")
        r = spark.createDataFrame([("a", "y", 1), (None, "x", 3), ("b", "x", 1)], "k string, f string, g int")
        got = audit.field_equivalence(l, r, ["k"], ["f", "g"])
        assert rows(got) == [("f", 3, 1, 1), ("g", 3, 1, 0)]
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        # one aggregation by value, one by key and one by field
        assert plan.count("Aggregate [") == 3

    def test_reconcile(self, spark):
        l, r = spark.createDataFrame([("a",), ("a",), (None,)], "k string"), spark.createDataFrame([("b",), (None,)], "k string")
        assert rows(audit.reconcile(l, r, ["k"])) == [("a", "left"), ("b", "right"), (None, "both")]

    def test_zero_as_censored(self, spark):
        df = spark.createDataFrame([(0.0, 0.5), (-1.0, 0.5), (2.0, 0.5), (None, 0.5)], "v double, rl double")
        assert rows(audit.zero_as_censored(df, "v", "rl", "s")) == [(0.5, 0.5, "<"), (2.0, 0.5, "=")]

    def test_effort_counts_events_once(self, spark):
        df = spark.createDataFrame([("a", "2020-01-01 08:00:00"), ("a", "2020-01-01 08:00:00"), ("a", "2021-01-01 08:00:00")], "s string, t string").withColumn("t", F.col("t").cast("timestamp_ntz"))
        assert rows(audit.effort_matrix(df, ["s"], "t", [2020, 2022])) == [("a", 1, None, 1)]


class TestQuality:
    def test_bounds(self, spark):
        df = spark.createDataFrame([(38.0, -122.0), (37.0, -122.0), (38.0, -121.0), (None, -122.0), (None, None), (None, -124.0)], "Latitude double, Longitude double")
        assert rows(quality.out_of_bounds(df)) == [(37.0, -122.0), (38.0, -121.0), (None, -124.0)]

    def test_zeros(self, spark):
        df = spark.createDataFrame([(0.0, 1.0), (1.0, 0.0), (None, None), (1.0, 1.0)], "Temperature double, Conductivity double")
        assert quality.forbidden_zeros(df).count() == 2

    def test_domains(self, spark):
        df = spark.createDataFrame([("Ebb", 1.0), ("High", 6.0), (None, None)], "Tide string, Microcystis double")
        assert rows(quality.off_domain(df)) == [("Microcystis", "6", 1), ("Tide", "High", 1)]

    def test_inventory(self, spark):
        df = spark.createDataFrame([("=", 1.0)], "DOC_Sign string, DOC double")
        assert quality.column_inventory({"x": df}) == [("x", "DOC_Sign", "string", True), ("x", "DOC", "double", False)]
        assert quality.documented_difference(df, ["DOC", "TOC"]) == {"missing": ["TOC"], "undocumented": ["DOC_Sign"]}


class TestFirstValues:
    LONG = [(1, "a", 5.0, "<", 2), (1, "a", 6.0, "=", 1), (1, "b", None, None, 3), (2, "b", 7.0, "~", 4), (None, "a", 8.0, "=", 5)]

    def test_texts_travel_as_numbers(self, spark):
        long = spark.createDataFrame(self.LONG, "id int, p string, v double, s string, _row int")
        wide = reshape.long_to_wide(long, ["id"], "p", ["a", "b", "c"], {"v": "{name}", "s": "{name}_Sign"}, levels={"s": SIGNS})
        plan = wide._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in plan and "Sort [" not in plan
        assert rows(wide) == [(1, 6.0, None, None, "=", None, None), (2, None, 7.0, None, None, "~", None), (None, 8.0, None, None, "=", None, None)]
        with pytest.raises(Exception, match="not among <, =: ~"):
            reshape.long_to_wide(long, ["id"], "p", ["b"], {"s": "{name}"}, levels={"s": ("<", "=")}).collect()

    def test_stacked_positions_stay_numbers(self, spark):
        feeds = [spark.createDataFrame([(f, i)], f"f int, _row {t}") for f, (i, t) in enumerate([(9, "int"), (2**40, "bigint")])]
        both = reshape.stack(feeds)
        assert dict(both.dtypes)["_row"] == "decimal(38,0)"
        assert [r.f for r in both.orderBy("_row").collect()] == [0, 1]
        again = reshape.stack([both.filter("f = 1"), both.filter("f = 0")])
        assert dict(again.dtypes)["_row"].startswith("struct") and [r.f for r in again.orderBy("_row").collect()] == [1, 0]


class TestMerge:
    FEEDS = "station string, time int, sample int, tide string, water double, rank double, note string"

    @staticmethod
    def plain(feeds):
        """The rules of ``merged`` below, record by record."""
        records, visits = {}, {}
        for f, feed in enumerate(feeds):
            for i, r in enumerate(feed):
                records.setdefault(r, (f, i))
        for record in sorted(records, key=records.get):
            visits.setdefault(record[:2], []).append(record)
        none_last = lambda v: (v is None, v or 0)
        out = []
        for key, mine in visits.items():
            n = len(mine)
            by_sample = {}
            for r in sorted(mine, key=lambda r: (none_last(r[5]), records[r])):
                by_sample.setdefault((r[2], r[4]), r)
            left = sorted(by_sample.values(), key=lambda r: (none_last(r[5]), records[r]))
            known = [r[4] for r in left if r[4] is not None]
            water = sum(known) / len(known) if known else None
            out.append((*key, left[0][2], left[0][3], None if water is None else float(round(water)) if n > 1 else water, left[0][5], left[0][6], n))
        return out

    @pytest.mark.parametrize("seed", range(3))
    def test_feeds_in_conflict(self, spark, seed):
        rng = random.Random(seed)

        def record():
            hot = rng.random() < 0.4  # one visit holds a large share of all records
            return ("hot" if hot else rng.choice(["a", "b", None]), 0 if hot else rng.randrange(3), rng.randrange(3), rng.choice(["Ebb", None]),
                    rng.choice([1.0, 2.0, 2.5, None]), rng.choice([1.0, 2.0, None, None]), rng.choice(["x", "y", None]))

        feeds = [[record() for _ in range(n)] for n in (40, 60, 5)]
        frames = [spark.createDataFrame([(*r, i) for i, r in enumerate(f)], self.FEEDS + ", _row long").repartition(3) for f in feeds]
        known = [F.col("rank").isNull(), F.col("rank")]
        got = merge.merge_feeds(frames, ["station", "time"], {"water": merge.whole_mean}, alike=[merge.Alike(["sample", "water"], known)], first=known)
        assert rows(got) == rows(spark.createDataFrame(self.plain(feeds), self.FEEDS + ", n long"))

    def test_feeds_without_records(self, spark):
        empty = spark.createDataFrame([], "k int, v double")
        assert merge.merge_feeds([empty, empty], ["k"], {"v": merge.mean}).collect() == []

    def test_parts_are_one_aggregation(self, spark):
        data = [("a", 1, "top", "t", 2.0, 1.0), ("a", 1, "top", "s", 3.0, 1.0), ("a", 1, "nut", "n", 5.0, 4.0), ("b", 1, "nut", "n", 7.0, 2.0),
                ("c", None, "top", "t", None, 3.0), ("d", 2, "none", "t", 1.0, 1.0)]
        long = spark.createDataFrame(data, "s string, d int, bin string, p string, v double, z double")
        parts = [reshape.Part(F.col("bin") == "top", "p", ["t", "s"], {"{name}_top": "v"}, ids={"z_top": lambda mine: F.avg(mine("z"))}),
                 reshape.Part(F.col("bin") == "nut", "p", ["n"], {"{name}": "v"}, rule=F.min, ids={"z_nut": lambda mine: F.max(mine("z"))}, after={"n": lambda c: c * 2})]
        wide = reshape.pivot_parts(long, ["s", "d"], parts, rows=F.count(F.lit(1)))
        assert wide._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
        assert wide.columns == ["s", "d", "rows", "z_top", "t_top", "s_top", "z_nut", "n"]
        assert rows(wide) == [("a", 1, 3, 1.0, 2.0, 3.0, 4.0, 10.0), ("b", 1, 1, None, None, None, 2.0, 14.0), ("c", None, 1, 3.0, None, None, None, None)]


class TestHotOnBothSides:
    """One key holds half of either side."""

    @pytest.fixture
    def sides(self, spark):
        rng = random.Random(4)
        left = [("hot" if i % 2 else rng.choice([None, "a", "b", "left"]), i) for i in range(120)]
        right = [("hot" if i % 2 else rng.choice([None, "a", "c", "right"]), 1000 + i) for i in range(80)]
        left += [("lone", 500 + i) for i in range(60)]
        return left, right, spark.createDataFrame(left, "k string, l int").repartition(3), spark.createDataFrame(right, "k string, r int").repartition(2)

    @pytest.mark.parametrize("hot_rows", [1, 7, 20, 10_000])
    def test_full_join(self, sides, hot_rows):
        left, right, l, r = sides
        want = [(k, a, b) for k, a in left for j, b in right if j == k]
        want += [(k, a, None) for k, a in left if k not in {j for j, _ in right}] + [(j, None, b) for j, b in right if j not in {k for k, _ in left}]
        assert sorted(map(tuple, full_join(l, r, ["k"], hot_rows=hot_rows).collect()), key=str) == sorted(want, key=str)

    def test_full_join_reads_rows_once(self, spark, tmp_path):
        """One join; beside it only the key columns are read, to find hot keys."""
        for side in "lr":
            spark.range(9).selectExpr("id AS k", f"id AS {side}").write.parquet(str(tmp_path / side))
        l, r = (spark.read.parquet(str(tmp_path / side)) for side in "lr")
        plan = full_join(l, r, ["k"])._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FullOuter") == 1
        assert len(re.findall(r"ReadSchema: struct<k:bigint,[lr]:bigint>", plan)) == 2

    @pytest.mark.parametrize("hot_rows", [1, 7, 10_000])
    def test_grid_join(self, sides, hot_rows):
        left, right, l, r = sides
        want = sorted(((k, a, b) for k, a in left for j, b in right if j == k), key=str)
        assert sorted(map(tuple, grid_join(l, r, ["k"], hot_rows=hot_rows).collect()), key=str) == want

    def test_differing_values_spread_their_pairs(self, spark):
        """300 values on either side of one key: no join partition gets much more than its share of their pairs."""
        left = spark.range(300).selectExpr("'hot' AS k", "concat('l', id) AS v").union(spark.range(300).selectExpr("concat('k', id)", "'x'"))
        right = spark.range(300).selectExpr("'hot' AS k", "concat('r', id) AS v").union(spark.range(300).selectExpr("concat('k', id)", "'y'"))
        got = audit.differing_values(left, right, ["k"], "v", hot_rows=30)
        assert got.agg(F.sum("n")).first()[0] == 300 * 300 + 300
        settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "50"}
        before = {s: spark.conf.get(s) for s in settings}
        for s, v in settings.items():
            spark.conf.set(s, v)
        try:
            pairs = grid_join(left, right.withColumnRenamed("v", "w"), ["k"], hot_rows=30).groupBy(F.spark_partition_id()).count().collect()
        finally:
            for s, v in before.items():
                spark.conf.set(s, v)
        assert max(p["count"] for p in pairs) < 300 * 300 / 8  # 100 cells over 50 partitions

    @pytest.mark.parametrize("hot_rows", [1, 7, 10_000])
    def test_extremes_with_many_ties(self, spark, hot_rows):
        data = [("hot", 1, i) for i in range(60)] + [("hot", 2, i) for i in range(60, 80)] + [("gap", None, 80), ("gap", 0, 81), (None, 5, 82), (None, 4, 83)]
        df = spark.createDataFrame(data, "k string, v int, i int").repartition(4)
        assert sorted(r.i for r in dedup.keep_extreme(df, ["k"], "v", hot_rows=hot_rows).collect()) == [*range(60), 83]
        assert sorted(r.i for r in dedup.keep_extreme(df, ["k"], "v", largest=True, hot_rows=hot_rows).collect()) == [*range(60, 80), 82]

    def test_extremes_of_few_ties_in_one_read(self, spark, skewed, tmp_path):
        """Ranked: one scan, one shuffle, the rank below it; the same rows as by aggregation, missing values or not."""
        spark.createDataFrame([(k, v, None if i % 11 == 0 else i % 5, i) for k, v, i in skewed] + [(f"n{i}", i % 2, i % 3, 200 + i % 40) for i in range(80)], "k string, v int, w int, i int").write.parquet(str(tmp_path / "t"))
        df = spark.read.parquet(str(tmp_path / "t"))
        for columns, more in ((["v"], {}), (["w"], {"largest": True}), (["v", "w"], {}), (["w", "v"], {})):
            ranked = dedup.keep_extreme(df, ["k"], *columns, few_ties=True, **more)
            plan = ranked._jdf.queryExecution().executedPlan().toString()
            assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1 and "WindowGroupLimit" in plan
            assert rows(ranked) == rows(dedup.keep_extreme(df, ["k"], *columns, **more)) != []

    def test_repaired_repeats(self, spark):
        data = [("one", "R", 1, 5.0), ("two", "R", 2, 1.0), ("two", "K", 3, 2.0), ("two", "K", 4, 4.0), ("gone", "R", 5, 1.0), ("gone", None, 6, 1.0), (None, "K", 7, None)]
        df = spark.createDataFrame(data, "k string, f string, i int, v double")
        stays = F.col("f") != "R"
        assert rows(dedup.repair_repeated(df, ["k"], stays, ["i"])) == [("one", "R", 1, 5.0), ("two", "K", 3, 2.0), (None, "K", 7, None)]
        assert rows(dedup.repair_repeated(df, ["k"], stays, ["i"], {"v": F.avg})) == [("one", "R", 1, 5.0), ("two", "K", 3, 3.0), (None, "K", 7, None)]
        for values in ({}, {"v": F.avg}):
            plan = dedup.repair_repeated(df, ["k"], stays, ["i"], values)._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange") == 1 and plan.count("Scan ExistingRDD") == 1
