"""Missing-value rules, text, clock, units, coordinates and censoring on small frames."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemerge.functions import censor, clock, codes, coords, nulls, text, units
from tidemerge.operators import repair


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def ntz(value):
    return F.lit(value).cast("timestamp_ntz")


def null(kind="string"):
    return F.lit(None).cast(kind)


class TestParse:
    FORMATS = ("M/d/yyyy H:mm:ss", "yyyy-MM-dd H:mm:ss", "yyyy-MM-dd", "M/d/yyyy", "M/d/yyyy H:mm", "H:m", "M/d/yyyy HHmm")

    def test_texts_read_as_the_formatter_reads_them(self, spark):
        days = ["2015-01-01", "2016-02-29", "2015-02-29", "2015-13-01", "2015-01-00", "0000-01-01", "0001-01-01", "9999-12-31", "12015-01-01", "-2015-01-01",
                "1883-11-18", "2015-03-08", "2015-1-1", "1/2/2015", "01/02/2015", "2/30/2015", "13/1/2015", "1/2/15", "1/2/0000", "001/2/2015", "", " "]
        times = ["", "1:02:03", "01:02:03", "02:30:00", "23:59:59", "24:00:00", "10:60:00", "10:00:60", "10:00", "7:5", "0730", "10:00:00Z", "10:00:00.5",
                 "10:00:00+01:00", "10", "1:2:3"]
        texts = [d + between + t + end for d in days for t in times for between in (" ", "T", "  ", "") for end in ("", " ", "\n")]
        df = spark.createDataFrame([(t,) for t in [*texts, None]], "t string")
        for fmt in self.FORMATS:
            plain = F.try_to_timestamp("t", F.lit(fmt)).cast("timestamp_ntz")
            got = df.select("t", plain.alias("a"), clock.parse(F.col("t"), fmt).alias("b"))
            assert got.filter(~F.col("a").eqNullSafe(F.col("b"))).collect() == []
            assert got.filter("a IS NOT NULL").count() > 0

    def test_a_day_alone_does_not_reach_the_formatter(self, spark):
        df = spark.range(1).select(F.concat(F.lit("2015-01-0"), F.col("id") + 1).alias("t"))
        plan = df.select(clock.parse(F.col("t"), "yyyy-MM-dd H:mm:ss"))._jdf.queryExecution().optimizedPlan().toString().lower()
        assert plan.index("contains(") < plan.index("gettimestamp(") and plan.index("rlike") < plan.index("gettimestamp(")


class TestNulls:
    def test_if_else_keeps_unknown_conditions_unknown(self, spark):
        got = one(spark, *[nulls.if_else(c, F.lit(1), F.lit(2)) for c in (F.lit(True), F.lit(False), null("boolean"))])
        assert got == (1, 2, None)

    def test_not_in_keeps_null(self, spark):
        df = spark.createDataFrame([("a",), ("b",), (None,)], "x string")
        assert [r.x for r in df.filter(nulls.not_in(F.col("x"), ["a"])).collect()] == ["b", None]

    @pytest.mark.parametrize("written, number", [("1.5", 1.5), ("abc", None), ("", None), ("NaN", None), (None, None), (" 2 ", 2.0)])
    def test_number(self, spark, written, number):
        assert one(spark, nulls.number(F.lit(written).cast("string"))) == (number,)

    def test_strict_aggregates(self, spark):
        df = spark.createDataFrame([(1, 1.0), (1, 3.0), (2, 1.0), (2, None), (3, None)], "k int, v double")
        got = df.groupBy("k").agg(
            nulls.strict_min(F.col("v")).alias("a"), nulls.strict_max(F.col("v")).alias("b"), nulls.strict_mean(F.col("v")).alias("c")
        )
        assert {r.k: (r.a, r.b, r.c) for r in got.collect()} == {1: (1.0, 3.0, 2.0), 2: (None,) * 3, 3: (None,) * 3}

    def test_drops(self, spark):
        df = spark.createDataFrame([(1, None), (None, None), (1, 2)], "a int, b int")
        assert nulls.drop_all_null(df, ["a", "b"]).count() == 2
        assert nulls.drop_any_null(df).count() == 1


class TestText:
    def test_paste_writes_missing_parts(self, spark):
        assert one(spark, text.paste(F.lit("20mm"), F.lit("504")), text.paste(F.lit("a"), null())) == ("20mm 504", "a NA")

    def test_remove_first_only(self, spark):
        assert one(spark, text.remove_first(F.lit("NL 16 NL 4"), "NL "), text.remove_first(F.lit("abc"), "x")) == ("16 NL 4", "abc")

    def test_pad_left_keeps_longer_text(self, spark):
        assert one(spark, text.pad_left(F.lit("930"), 4), text.pad_left(F.lit("11111"), 4)) == ("0930", "11111")

    def test_number_text(self, spark):
        got = one(spark, *[text.number_text(F.lit(v)) for v in (12154321.0, 2.5, -3.0)], text.number_text(null("double")))
        assert got == ("12154321", "2.5", "-3", None)

    def test_recode(self, spark):
        col = F.lit("HS")
        assert one(spark, text.recode(col, {"HS": "High"}), text.recode(col, {"x": "y"}), text.recode(col, {"x": "y"}, keep_unmatched=False),
                   text.recode(col, {"HS": None})) == ("High", "HS", None, None)

    def test_tides(self, spark):
        assert one(spark, codes.trawl_tide(F.lit(4.0)), codes.trawl_tide(F.lit(9)), codes.trawl_tide(F.lit(9), keep_unmatched=False)) == ("Flood", "9", None)

    def test_microcystis(self, spark):
        assert one(spark, codes.microcystis_index(F.lit("Absent")), codes.microcystis_index(F.lit("Extreme")), codes.rounded_index(F.lit(2.5)),
                   codes.rounded_index(F.lit(3.5))) == (1.0, 5.0, 2.0, 4.0)


class TestClock:
    def test_parse_takes_the_first_format_that_fits(self, spark):
        formats = ("M/d/yyyy H:mm:ss", "yyyy-MM-dd")
        got = one(spark, *[clock.parse(F.lit(t), *formats) for t in ("4/24/1995 0:00:00", "1995-04-24", "24.4.1995")])
        assert got == (dt.datetime(1995, 4, 24), dt.datetime(1995, 4, 24), None)

    @pytest.mark.parametrize("fmt, fits, fails", [
        ("M/d/yyyy", ["1/5/1997", "12/31/2020"], ["1/5/97", "1/5/1997 8:00", "a/b/cdef"]),
        ("yyyy-MM-dd", ["1997-01-05"], ["1997-1-5", "97-01-05"]),
        ("M/d/yyyy HHmm", ["1/5/1997 0930"], ["1/5/1997 930"]),
    ])
    def test_shape_admits_what_the_format_reads(self, spark, fmt, fits, fails):
        for text_, wanted in [(t, True) for t in fits] + [(t, False) for t in fails]:
            got = one(spark, F.lit(text_).rlike(clock.shape(fmt)), F.try_to_timestamp(F.lit(text_), F.lit(fmt)).isNotNull())
            assert got == (wanted, wanted)

    @pytest.mark.parametrize("written, year", [("3/7/69", 1969), ("3/7/98", 1998), ("3/7/00", 2000), ("3/7/68", 2068), ("3/7/2011", 2011)])
    def test_two_digit_years(self, spark, written, year):
        assert one(spark, clock.parse_date(clock.whole_year(F.lit(written)), "M/d/yyyy")) == (dt.date(year, 3, 7),)

    def test_pst_is_an_hour_behind_in_summer(self, spark):
        got = one(spark, *[clock.to_local(ntz(t), clock.PST) for t in ("2018-07-01 23:30:00", "2018-01-01 23:30:00")])
        assert got == (dt.datetime(2018, 7, 2, 0, 30), dt.datetime(2018, 1, 1, 23, 30))

    def test_skipped_hour_does_not_exist(self, spark):
        got = one(spark, *[clock.existing_local(ntz(t)) for t in ("2018-03-11 02:30:00", "2018-03-11 03:30:00", "2018-03-12 02:30:00")])
        assert got == (None, dt.datetime(2018, 3, 11, 3, 30), dt.datetime(2018, 3, 12, 2, 30))

    def test_at_needs_both(self, spark):
        day, time = F.lit("2020-02-29").cast("date"), ntz("1899-12-30 07:50:12")
        got = one(spark, clock.at(day, time), clock.at(day, null("timestamp_ntz")), clock.at(null("date"), time), clock.at(day, time, seconds=True))
        assert got == (dt.datetime(2020, 2, 29, 7, 50), None, None, dt.datetime(2020, 2, 29, 7, 50, 12))

    @pytest.mark.parametrize("t", ["1969-12-31 23:59:59.000001", "1899-12-30 12:00:00", "2024-06-30 01:02:03.456789"])
    def test_micros_and_back(self, spark, t):
        assert one(spark, clock.from_micros(clock.micros(ntz(t))) == ntz(t)) == (True,)

    def test_means(self, spark):
        df = spark.createDataFrame([("2020-01-01 08:00:00",), ("2020-01-01 10:00:00",), (None,)], "t string").select(F.col("t").cast("timestamp_ntz").alias("t"))
        got = df.agg(clock.mean_time(F.col("t")), clock.midpoint(F.min("t"), F.max("t"))).first()
        assert tuple(got) == (dt.datetime(2020, 1, 1, 9),) * 2
        assert df.filter("t IS NULL").agg(clock.mean_time(F.col("t"))).first()[0] is None

    def test_other_session_zone_changes_nothing(self, spark):
        zone = spark.conf.get("spark.sql.session.timeZone")
        try:
            spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
            text_time = F.lit("7/1/2018 23:30:00")
            parsed = clock.parse(text_time, "M/d/yyyy H:mm:ss")
            assert one(spark, clock.to_local(parsed, clock.PST)) == (dt.datetime(2018, 7, 2, 0, 30),)
            assert one(spark, clock.from_micros(clock.micros(parsed))) == (dt.datetime(2018, 7, 1, 23, 30),)
        finally:
            spark.conf.set("spark.sql.session.timeZone", zone)

    @pytest.mark.parametrize("month, name", [(12, "Winter"), (2, "Winter"), (3, "Spring"), (8, "Summer"), (9, "Fall"), (11, "Fall")])
    def test_season(self, spark, month, name):
        assert one(spark, clock.season(F.lit(month))) == (name,)


class TestUnits:
    @pytest.mark.parametrize("ec, salinity", [(1490, 0.747), (652, 0.316), (239, 0.113), (250, 0.118), (276, 0.131), (1949, 0.989), (1174, 0.582), (248, 0.117), (251, 0.119), (275, 0.13)])
    def test_published_salinities(self, spark, ec, salinity):
        df = units.add_practical_salinity(spark.range(1).select(F.lit(float(ec)).alias("ec")), F.col("ec") / 1000, "s")
        assert round(df.first().s, 3) == salinity

    def test_standard_sea_water(self, spark):
        df = units.add_practical_salinity(spark.range(1), F.lit(42.914), "s", temperature=15.0)
        assert df.first().s == pytest.approx(35.0, abs=1e-4)

    def test_impossible_conductivity(self, spark):
        df = spark.createDataFrame([(None,), (-1.0,), (0.0,)], "c double")
        got = [r.s for r in units.add_practical_salinity(df, F.col("c"), "s").collect()]
        assert got[:2] == [None, None] and got[2] == pytest.approx(0, abs=1e-9)

    @pytest.mark.parametrize("feet, metres", [(25, 7.62), (10, 3.05), (40, 12.19), (8, 2.44)])
    def test_feet(self, spark, feet, metres):
        assert round(one(spark, units.feet_to_metres(F.lit(float(feet))))[0], 2) == metres

    def test_specific_conductance(self, spark):
        got = one(
            spark, units.specific_conductance(F.lit(5.0), F.lit(100.0), F.lit(20.0)),
            units.specific_conductance(null("double"), F.lit(100.0), F.lit(25.0)), units.specific_conductance(null("double"), F.lit(100.0), null("double")),
        )
        assert got == (5.0, 100.0, None)


class TestCoordinates:
    def test_dms(self, spark):
        three = [F.lit(v) for v in (38.0, 30.0, 36.0)]
        assert one(spark, coords.dms(*three), coords.dms(*three, -1), coords.dms(*three[:2], null("double"))) == (38.51, -38.51, None)

    @pytest.mark.parametrize("written, degrees", [("38-30-36\"N", 38.51), ("38-30-36'", 38.51), ("38-30-36W", 38.51), ("38-30", None), ("", None), (None, None)])
    def test_dirty(self, spark, written, degrees):
        got = one(spark, coords.dirty_dms(F.lit(written).cast("string")))[0]
        assert got == (None if degrees is None else pytest.approx(degrees))

    def test_packed(self, spark):
        got = one(
            spark, coords.packed_degrees(F.lit("375432"), 2, F.lit(False)), coords.packed_degrees(F.lit("3754321"), 2, F.lit(True)),
            coords.packed_degrees(F.lit("12154321"), 3, F.lit(True), -1), coords.packed_degrees(F.lit("375432"), 2, null("boolean")),
        )
        assert got[0] == pytest.approx(37 + 54 / 60 + 32 / 3600) and got[1] == pytest.approx(37 + 54.321 / 60)
        assert got[2] == pytest.approx(-(121 + 54.321 / 60)) and got[3] is None

    def test_degree_minute_text(self, spark):
        got = one(spark, coords.degree_minute_text(F.lit("37°54.3")), coords.degree_minute_text(F.lit("-122°30"), west=True))
        assert got == (pytest.approx(37.905), -122.5)

    def test_station_before_field(self, spark):
        df = spark.createDataFrame(
            [(None, None, 1.0, 2.0), (3.0, 4.0, 1.0, 2.0), (None, None, None, None), (3.0, None, None, 2.0)],
            "Latitude double, Longitude double, Latitude_field double, Longitude_field double",
        )
        got = [(r.Latitude, r.Longitude, r.Field_coords) for r in coords.prefer_station_coords(df).collect()]
        assert got == [(1.0, 2.0, True), (3.0, 4.0, False), (None, None, False), (3.0, 2.0, True)]


class TestCensoring:
    def test_split(self, spark):
        df = spark.createDataFrame([("<0.05", "0.1"), ("2.5", "0.1"), ("N.S.", "0.1"), (None, "0.1"), ("<0.05", None)], "Result string, RL string")
        assert [(r.Result, r.Sign) for r in censor.split_censored(df).collect()] == [(0.1, "<"), (2.5, "=")]

    def test_status(self, spark):
        assert one(spark, censor.status_sign(F.lit("Not Detected"), F.lit("Estimated")), censor.status_sign(null(), F.lit("Estimated")), censor.status_sign(null(), null())) == ("<", "~", "=")

    @pytest.mark.parametrize("analyte, method, day, value", [("A", "m", "2020-10-19", 1.0), ("A", "m", "2020-10-20", 2.0), ("B", "x", "2020-01-01", 3.0), ("B", "y", "2020-01-01", None), ("C", "x", "2020-01-01", None)])
    def test_limits(self, spark, analyte, method, day, value):
        rules = [censor.LimitRule("A", 1.0, last_day=dt.date(2020, 10, 19)), censor.LimitRule("A", 2.0, first_day=dt.date(2020, 10, 20)), censor.LimitRule("B", 3.0, method="x")]
        fill = lambda v: censor.fill_limit(v, F.lit(analyte), F.lit(method), F.lit(day).cast("date"), rules)
        assert one(spark, fill(null("double")), fill(F.lit(9.0))) == (value, 9.0)

    def test_notes(self, spark):
        got = one(spark, *[repair.null_when_noted(n, "CDEC", F.lit(1.0), missing_notes_too=m) for n in (F.lit("from CDEC"), F.lit("calm"), null()) for m in (True, False)])
        assert got == (None, None, 1.0, 1.0, None, 1.0)

    def test_null_before(self, spark):
        first = dt.date(2019, 6, 1)
        got = one(spark, *[repair.null_before(d, first, F.lit(1.0)) for d in (F.lit("2019-05-31").cast("date"), F.lit("2019-06-01").cast("date"), null("date"))])
        assert got == (None, 1.0, None)
