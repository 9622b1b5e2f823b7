"""Sources, the integrated table, publication, feed preparation and survey quirks."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from catalog import QUERIES
from helpers import rows
from tidemerge.operators import quality
from tidemerge.plans import compare, publish
from tidemerge.plans.integrate import SOURCES, check_sources, integrate
from tidemerge.plans.surveys import SURVEYS, suisun, usgs_sfbs
from tidemerge.sources import registry, scan, sinks
from tidemerge.sources.vocabulary import CANONICAL, DERIVED, PUBLISHED, off_vocabulary


def feed(spark, columns, data=(), numbered=True):
    """A raw feed: listed columns as text, all others missing."""
    names = list(dict.fromkeys(n for r in data for n in r))
    made = []
    for i, r in enumerate(data):
        made.append((*[None if r.get(n) is None else str(r[n]) for n in names], i))
    df = spark.createDataFrame(made, ", ".join([f"`{n}` string" for n in names] + ["_row int"]))
    df = df.withColumns({n: F.lit(None).cast("string") for n in columns if n not in names})
    return df if numbered else df.drop("_row")


def clean(spark, name, **feeds):
    plan = SURVEYS[name]
    opened = {f: feed(spark, columns, feeds.get(f, ())) for f, columns in plan.feeds.items()}
    return plan.build(opened)


class TestScan:
    def write(self, path, text):
        path.write_text(text, encoding="utf-8")
        return str(path)

    def test_columns_by_name_and_type(self, spark, tmp_path):
        path = self.write(tmp_path / "a.csv", 'B,A,Flag,C\n1.5,x,TRUE,9\nabc,NA,false,9\n,"",T,9\n')
        df = scan.scan_csv(spark, path, {"A": "string", "B": "double", "Flag": "boolean"})
        assert [tuple(r)[:3] for r in df.orderBy("_row").collect()] == [("x", 1.5, True), (None, None, False), (None, None, True)]

    def test_line_breaks_and_quotes_in_text(self, spark, tmp_path):
        path = self.write(tmp_path / "n.csv", 'Id,Notes\n1,"two\nlines"\n2,"say ""hi"", ok"\n')
        df = scan.scan_csv(spark, path, {"Id": "int", "Notes": "string"}, line_breaks=True)
        assert rows(df, "Id", "Notes") == [(1, "two\nlines"), (2, 'say "hi", ok')]

    def test_ragged_files_in_order(self, spark, tmp_path):
        a, b = self.write(tmp_path / "a.csv", "X,Y\n1,2\n3,4\n"), self.write(tmp_path / "b.csv", "Y,Z\n5,6\n")
        df = scan.scan_ragged_csv(spark, [a, b])
        assert [(r.X, r.Y, r.Z) for r in df.orderBy("_row").collect()] == [("1", "2", None), ("3", "4", None), (None, "5", "6")]

    def test_scan_order_is_file_order(self, spark, tmp_path):
        path = self.write(tmp_path / "long.csv", "N\n" + "\n".join(str(i) for i in range(5000)) + "\n")
        df = scan.scan_csv(spark, path, {"N": "int"})
        assert [r.N for r in df.orderBy("_row").collect()] == list(range(5000))

    def test_positions_rank_files_by_path(self, spark, tmp_path):
        """Files of two headers, odd names: one number a row, in the order of all paths."""
        for i, name in enumerate(["a b.csv", "c%20d.csv", "e+ü.csv", "f.csv"]):
            self.write(tmp_path / name, ("X\n" if i % 2 else "Y\n") + "\n".join(str(1000 * i + k) for k in range(300)) + "\n")
        df = scan.scan_ragged_csv(spark, str(tmp_path))
        assert dict(df.dtypes)["_row"] == "decimal(32,0)"
        assert [int(r.n) for r in df.orderBy("_row").select(F.coalesce("X", "Y").alias("n")).collect()] == [1000 * i + k for i in range(4) for k in range(300)]
        assert {r.File for r in scan.with_file_name(scan.scan_csv(spark, str(tmp_path / "a b.csv"))).collect()} == {"a b.csv"}

    def test_only_named_columns_are_kept(self, spark, tmp_path):
        path = self.write(tmp_path / "a.csv", "A,B,C\n1,2,3\n")
        assert scan.scan_csv(spark, path, {"B": "int"}).columns == ["B", "_row"]

    def test_json_records(self, spark, tmp_path):
        path = self.write(tmp_path / "a.json", '{"status": "ok", "result": 1.5}\n{"status": "bad"}\n')
        df = scan.scan_json(spark, path, {"status": "DataStatus", "result": "Result"}, "status string, result double")
        assert rows(df, "DataStatus", "Result") == [("bad", None), ("ok", 1.5)]

    def test_file_names(self, spark, tmp_path):
        path = self.write(tmp_path / "named.csv", "A\n1\n")
        assert scan.with_file_name(scan.scan_csv(spark, path)).first().File == "named.csv"

    def test_sinks(self, spark, tmp_path):
        df = spark.createDataFrame([("a", None), ("b", 'x "y"')], "k string, v string")
        sinks.write_csv(df, str(tmp_path / "na"))
        assert sorted(r.v or "NULL" for r in scan.scan_csv(spark, str(tmp_path / "na")).collect()) == ["NULL", 'x "y"']
        sinks.write_csv(df, str(tmp_path / "blank"), missing="")
        assert "NA" not in "".join(p.read_text() for p in (tmp_path / "blank").glob("part*"))
        sinks.write_table(df, str(tmp_path / "t"), partition_by=["k"])
        assert spark.read.parquet(str(tmp_path / "t")).count() == 2


class TestIntegrate:
    def source(self, spark, name, dates=("2020-12-01",), **columns):
        df = spark.createDataFrame([(name, "1", d) for d in dates], "Source string, Station string, Date string")
        return df.withColumn("Date", F.col("Date").cast("date")).withColumns({n: F.lit(v) for n, v in columns.items()})

    def test_renamed_source_comes_first(self):
        with pytest.raises(ValueError) as error:
            check_sources(["USGS", "nonsense"])
        assert str(error.value) == (
            'The "USGS" data source has been renamed to "USGS_SFBS" because of the inclusion of an additional USGS dataset, "USGS_CAWSC".'
        )

    @pytest.mark.parametrize("sources", [None, [], ["SFBS"], ["EMP", "x"], "SFBS"])
    def test_unknown_sources_list_the_choices(self, sources):
        with pytest.raises(ValueError) as error:
            check_sources(sources)
        assert str(error.value) == "You must specify the data sources you wish to include. Choices include:\n " + ", ".join(SOURCES)

    def test_fixed_order_without_repeats(self):
        assert check_sources(["YBFMP", "20mm", "EMP", "EMP"]) == ["20mm", "EMP", "YBFMP"]

    def test_only_chosen_tables_are_opened(self, spark):
        def never():
            raise AssertionError("opened")

        got = integrate({"EMP": lambda: self.source(spark, "EMP"), "STN": never}, ["EMP"])
        assert got.count() == 1

    def test_december_keeps_its_year(self, spark):
        got = integrate({"EMP": self.source(spark, "EMP")}, "EMP").first()
        assert (got.Year, got.Month, got.Season, got.MonthYear, got.StationID) == (2020, 12, "Winter", dt.date(2020, 12, 1), "EMP 1")

    def test_published_first_row(self, spark):
        got = integrate({"20mm": self.source(spark, "20mm", ["1997-05-03"], Conductivity=1490.0, Conductivity_bottom=1949.0)}, "20mm").first()
        assert (got.Season, got.Month, got.MonthYear, round(got.Salinity, 3), round(got.Salinity_bottom, 3)) == ("Spring", 5, dt.date(1997, 5, 1), 0.747, 0.989)

    def test_years_are_inclusive_and_undated_rows_leave(self, spark):
        df = self.source(spark, "EMP", ["1999-12-31", "2000-01-01", "2001-12-31", "2002-01-01", None])
        assert integrate({"EMP": df}, "EMP", 2000, 2001).count() == 2
        assert integrate({"EMP": df}, "EMP").count() == 4
        assert integrate({"EMP": df}, "EMP", 2001, 2000).count() == 0

    def test_future_years_need_an_end_year(self, spark):
        df = self.source(spark, "EMP", [f"{dt.date.today().year + 1}-01-01"])
        assert integrate({"EMP": df}, "EMP").count() == 0
        assert integrate({"EMP": df}, "EMP", end_year=9999).count() == 1

    @pytest.mark.parametrize("columns, salinity", [
        ({"Salinity": 5.0, "Conductivity": 1490.0}, 5.0), ({"Conductivity": 1490.0}, 0.747), ({"Salinity": 5.0}, 5.0), ({}, None),
    ])
    def test_salinity_by_what_is_there(self, spark, columns, salinity):
        got = integrate({"EMP": self.source(spark, "EMP", **columns)}, "EMP").first()
        assert (None if got.Salinity is None else round(got.Salinity, 3)) == salinity and got.Salinity_bottom is None

    def test_field_coords_only_where_a_source_has_them(self, spark):
        a, b = self.source(spark, "EMP", Field_coords=True), self.source(spark, "STN")
        got = integrate({"EMP": a, "STN": b}, ["EMP", "STN"])
        assert sorted(r.Field_coords for r in got.collect()) == [False, True]
        assert "Field_coords" not in integrate({"STN": b}, ["STN"]).columns

    def test_rows_are_conserved(self, spark):
        tables = {s: self.source(spark, s, ["2000-01-01"] * (i + 1)) for i, s in enumerate(SOURCES)}
        whole = integrate(tables, SOURCES)
        assert whole.count() == sum(range(1, 18))
        assert quality.row_conservation(tables, whole).count() == 0

    def test_years_reach_the_scan(self, spark, tmp_path):
        self.source(spark, "EMP").write.parquet(str(tmp_path / "EMP"))
        plan = integrate(registry.stored(spark, str(tmp_path), ["EMP"]), "EMP", 2000, 2001)._jdf.queryExecution().executedPlan().toString()
        assert "GreaterThanOrEqual(Date,2000-01-01)" in plan and "LessThanOrEqual(Date,2001-12-31)" in plan
        assert "Exchange" not in plan

    def test_vocabulary(self):
        assert len(CANONICAL) == 74 and len({**CANONICAL, **DERIVED}) == 79 and len(PUBLISHED) == 74


class TestPublish:
    def test_table_and_files(self, spark, tmp_path):
        df = spark.createDataFrame(
            [("EMP", "b", "2020-01-02", 'say "hi"\r\nthere'), ("EMP", "a", "2020-01-03", None), ("STN", "c", "2020-01-01", "x")],
            "Source string, Station string, Date string, Notes string",
        ).withColumns({"Date": F.col("Date").cast("date"), "Datetime": F.lit("2020-01-01 07:05:00").cast("timestamp_ntz")})
        whole = integrate({"EMP": df.filter("Source = 'EMP'"), "STN": df.filter("Source = 'STN'")}, ["EMP", "STN"])
        table = publish.published(whole)
        assert tuple(table.columns) == PUBLISHED
        assert {(r.Station, r.Date, r.Datetime, r.Notes) for r in table.collect()} >= {("EMP b", "2020-01-02", "2020-01-01 07:05:00", "say 'hi'  there")}
        publish.publish(whole, str(tmp_path / "out"))
        assert {p.name for p in (tmp_path / "out").iterdir() if p.is_dir()} == {"Survey=EMP", "Survey=STN"}
        lines = [l for p in sorted((tmp_path / "out" / "Survey=EMP").glob("*.csv")) for l in p.read_text().splitlines()[1:]]
        assert [l.split(",")[1] for l in lines] == ["EMP a", "EMP b"]

    def test_metadata(self, spark):
        df = spark.createDataFrame([("EMP",), ("x",)], "Source string")
        meta = spark.createDataFrame([("EMP", "DWR")], "Abbreviation string, Agency string")
        assert rows(publish.with_survey_metadata(df, meta)) == [("EMP", "DWR"), ("x", None)]


@pytest.mark.parametrize("name", SURVEYS)
def test_cleaned_columns_are_in_the_vocabulary(spark, name):
    empty = clean(spark, name)
    assert off_vocabulary(empty.schema) == {}
    assert empty.count() == 0


@pytest.mark.parametrize("name, width", [("20mm", 14), ("Baystudy", 14), ("DJFMP", 10), ("DOP", 16), ("EDSM", 16), ("EMP", 68), ("FMWT", 16), ("NCRO", 49),
                                         ("SDO", 16), ("SKT", 13), ("SLS", 12), ("STN", 16), ("Suisun", 13), ("USBR", 13), ("USGS_CAWSC", 19), ("USGS_SFBS", 22), ("YBFMP", 14)])
def test_cleaned_width(spark, name, width):
    assert len(clean(spark, name).columns) == width


def test_stored_tables(spark, tmp_path):
    raw = tmp_path / "raw" / "DOP"
    raw.mkdir(parents=True)
    header = ["Date", "Latitude", "Longitude", "Station_Code", "Habitat", "Conductivity", "Temperature", "Secchi", "Start_Time", "pH", "Chl_a",
              "Start_Depth", "Salinity", "Turbidity", "DO", "Unused"]
    (raw / "tow.csv").write_text(",".join(header) + "\n2020-01-02,38,-121.5,A,Littoral,100,9,,08:30:00,7,NA,10,,1,9,z\n")
    registry.store(spark, {"DOP": SURVEYS["DOP"]}, str(tmp_path / "raw"), str(tmp_path / "clean"))
    got = integrate(registry.stored(spark, str(tmp_path / "clean"), ["DOP"]), ["DOP"]).first()
    assert (got.StationID, got.Depth, got.Datetime, got.Field_coords) == ("DOP A Littoral", 3.048, dt.datetime(2020, 1, 2, 8, 30), True)


def test_stored_files_hold_ranges_of_dates(spark, tmp_path):
    raw = tmp_path / "raw" / "DOP"
    raw.mkdir(parents=True)
    header = ["Date", "Latitude", "Longitude", "Station_Code", "Habitat", "Conductivity", "Temperature", "Secchi", "Start_Time", "pH", "Chl_a",
              "Start_Depth", "Salinity", "Turbidity", "DO", "Unused"]
    tows = [f"{year}-{month:02}-02,38,-121.5,{code},Littoral,100,9,,08:30:00,7,NA,10,,1,9,z" for code in "ABC" for month in range(1, 13) for year in range(2011, 2021)]
    (raw / "tow.csv").write_text(",".join(header) + "\n" + "\n".join(tows) + "\n")
    merging = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merging, "false")
    try:
        registry.store(spark, {"DOP": SURVEYS["DOP"]}, str(tmp_path / "raw"), str(tmp_path / "clean"))
    finally:
        spark.conf.unset(merging)
    files = spark.read.parquet(str(tmp_path / "clean" / "DOP")).groupBy(F.input_file_name()).agg(F.min("Date").alias("a"), F.max("Date").alias("b"), F.count("*").alias("n")).collect()
    assert sum(f.n for f in files) == len(tows) and len(files) >= 4
    for year in range(2011, 2021):
        assert sum(f.a.year <= year <= f.b.year for f in files) <= 2


# Raw headers that differ from the library's names.
RESULTS = ["Sample Type", "Analyte", "Long Station Name", "Station Number", "Sample Code", "Collection Date", "Result", "Rpt Limit", "Units", "Notes"]
PUBLISHED_FILE = ["Date", "Time", "Station_Number", "Depth", "Calculated_Chlorophyll", "Oxygen", "Salinity", "Temperature", "Nitrate_+_Nitrite", "Ammonium",
                  "Phosphate", "Silicate"]
RAW_HEADERS = {
    ("USBR", "profiles"): ["Station", "DateTime.PT", "Depth.feet", "Temp.C", "SpCond.uS", "Chl.ug.L", "Date"],
    ("USBR", "sites"): ["Station", "Lat", "Long", "Depth (m)"],
    ("USGS_SFBS", "early"): ["Date", "Time", "Station", "Depth", "Discrete DO", "Calculated Chl-a", "Salinity", "Temperature", "NO32", "NH4", "PO4", "Si"],
    ("USGS_SFBS", "published"): PUBLISHED_FILE,
    ("USGS_SFBS", "web"): [
        "Date", "Time", "Station", "Depth (m)", "Calculated Chlorophyll-a (micrograms/L)", "Oxygen (mg/L)", "Oxygen % Saturation", "Salinity",
        "Temperature (Degrees Celsius)", "NO32 (Micromolar)", "NH4 (Micromolar)", "PO4 (Micromolar)", "Si (Micromolar)"],
    ("USGS_SFBS", "stations"): ["Station", "Latitude degree", "Longitude degree"],
    ("NCRO", "requested"): RESULTS,
    ("NCRO", "recent"): RESULTS,
    ("NCRO", "questionable"): ["SampleCode", "Analyte", "Measurement Verified (Yes, No, or Unknown)", "Verified Result"],
    ("SDO", "by_depth"): [
        "Description", "Date", "Time (PST)", "Depth (m)", "MC Score", "Secchi (cm)", "Water Temp (°C)", "Sp Cond (µS/cm)", "DO (mg/L)", "pH"],
    ("USGS_CAWSC", "results"): [
        "MonitoringLocationIdentifier", "ActivityStartDate", "ActivityStartDateTime", "CharacteristicName", "ResultMeasureValue",
        "ResultDetectionConditionText", "ResultValueTypeName", "DetectionQuantitationLimitMeasure.MeasureValue", "ResultAnalyticalMethod.MethodIdentifier"],
}


class TestRawFiles:
    def stage(self, folder, name, **rows_of):
        """Every feed of a survey as a file with raw headers and a column nobody asks for."""
        base = folder / name
        base.mkdir()
        for feed_name, columns in SURVEYS[name].feeds.items():
            header = RAW_HEADERS.get((name, feed_name), list(columns))
            lines = [",".join(f'"{c}"' for c in [*header, "Unused"])]
            lines += [",".join(f'"{row[c]}"' if c in row else "" for c in header) + ",x" for row in rows_of.get(feed_name, ())]
            (base / f"{feed_name}.csv").write_text("\n".join(lines) + "\n", encoding="utf-8")
        return str(folder)

    @pytest.mark.parametrize("name", SURVEYS)
    def test_all_headers_are_known(self, spark, tmp_path, name):
        got = SURVEYS[name].read(spark, self.stage(tmp_path, name))
        assert got.columns == clean(spark, name).columns and got.count() == 0

    def test_usbr(self, spark, tmp_path):
        deep = [{"Station": "Pro", "DateTime.PT": "2020-07-01 09:00:00", "Depth.feet": d, "Temp.C": t, "SpCond.uS": 5, "Chl.ug.L": 1, "Date": "2020-07-01"}
                for d, t in ((1, 20), (9, 18))]
        raw = self.stage(tmp_path, "USBR", profiles=deep, sites=[{"Station": "NL PS", "Lat": 38, "Long": -121, "Depth (m)": 7}])
        got = SURVEYS["USBR"].read(spark, raw).first()
        assert (got.Station, got.Latitude, got.Longitude, got.Depth, got.Temperature, got.Temperature_bottom, got.Conductivity, got.Chlorophyll) == (
            "Pro", 38.0, -121.0, 7.0, 20.0, 18.0, 5.0, 1.0)

    def test_sfbs_vintages(self, spark, tmp_path):
        early = [{"Date": "7/3/98", "Time": "8:00", "Station": "3", "Depth": 1, "Discrete DO": 7, "Calculated Chl-a": 2, "Si": 10}]
        web = [{"Date": "7/3/2021", "Time": "8:00", "Station": "3", "Depth (m)": 1, "Oxygen (mg/L)": 8, "Oxygen % Saturation": 90, "Temperature (Degrees Celsius)": 15}]
        raw = self.stage(tmp_path, "USGS_SFBS", early=early, web=web, stations=[{"Station": "3", "Latitude degree": 37.5, "Longitude degree": -122}])
        # the published vintage is a folder of yearly files under two headers
        (tmp_path / "USGS_SFBS" / "published.csv").unlink()
        yearly = tmp_path / "USGS_SFBS" / "published.csv"
        yearly.mkdir()
        for year, oxygen in ((2016, "Oxygen"), (2017, "Calculated_Oxygen"), (2018, "Oxygen")):
            header = [oxygen if c == "Oxygen" else c for c in PUBLISHED_FILE]
            (yearly / f"{year} bay.csv").write_text(",".join(header) + f"\n1/2/{year},930,3,1,4,{year - 2010},30,9,,,,\n")
        got = SURVEYS["USGS_SFBS"].read(spark, raw)
        assert rows(got, "Date", "Datetime", "Latitude", "DissolvedOxygen", "DissolvedOxygenPercent", "Chlorophyll", "Temperature") == [
            (dt.date(1998, 7, 3), dt.datetime(1998, 7, 3, 8), 37.5, 7.0, None, 2.0, None),
            *[(dt.date(y, 1, 2), dt.datetime(y, 1, 2, 9, 30), 37.5, y - 2010.0, None, 4.0, 9.0) for y in (2016, 2017, 2018)],
            (dt.date(2021, 7, 3), dt.datetime(2021, 7, 3, 8), 37.5, 8.0, 90.0, None, 15.0),
        ]

    def test_ncro(self, spark, tmp_path):
        base = {"Sample Type": "Normal Sample", "Long Station Name": "Rock Slough", "Station Number": "B1", "Collection Date": "7/1/2018 9:00", "Rpt Limit": "0.1"}
        raw = self.stage(
            tmp_path, "NCRO", requested=[{**base, "Analyte": "Field pH", "Sample Code": "s1", "Result": "7.1"}],
            recent=[{**base, "Analyte": "Dissolved Calcium", "Sample Code": "s2", "Result": "<5", "Units": "mg/L"}],
            stations=[{"StationNumber": "B1", "StationName": "Rock Slough", "Latitude": 38, "Longitude": -121}],
            questionable=[{"SampleCode": "s1", "Analyte": "pH", "Measurement Verified (Yes, No, or Unknown)": "No", "Verified Result": 7.5}])
        got = SURVEYS["NCRO"].read(spark, raw)
        assert rows(got, "Station", "pH", "DissCalcium_Sign", "Latitude") == [("Rock Slough", 7.5, "<", 38.0)]

    def test_sdo_by_depth(self, spark, tmp_path):
        deep = [{"Description": "P8", "Date": "2021-07-01", "Time (PST)": "1899-12-31 09:00:00", "Depth (m)": d, "MC Score": 2, "Secchi (cm)": 50,
                 "Water Temp (°C)": 20 + d, "Sp Cond (µS/cm)": 300, "DO (mg/L)": 8, "pH": 7} for d in (1, 3, 6)]
        got = SURVEYS["SDO"].read(spark, self.stage(tmp_path, "SDO", by_depth=deep))
        assert rows(got, "Station", "Microcystis", "Secchi", "Temperature", "Temperature_bottom", "Conductivity", "DissolvedOxygen") == [
            ("lt40", 2.0, 50.0, 21.0, 26.0, 300.0, 8.0)]

    def test_cawsc_limits_and_methods(self, spark, tmp_path):
        base = {"MonitoringLocationIdentifier": "USGS-1", "ActivityStartDate": "2020-07-01", "ActivityStartDateTime": "2020-07-01 17:00:00",
                "ResultDetectionConditionText": "Not Detected"}
        results = [{**base, "CharacteristicName": "Chlorophyll a", "DetectionQuantitationLimitMeasure.MeasureValue": 0.3},
                   {**base, "CharacteristicName": "Inorganic nitrogen (nitrate and nitrite)", "ResultAnalyticalMethod.MethodIdentifier": "RED01"}]
        got = SURVEYS["USGS_CAWSC"].read(spark, self.stage(tmp_path, "USGS_CAWSC", results=results))
        assert rows(got, "Chlorophyll_Sign", "Chlorophyll", "DissNitrateNitrite") == [("<", 0.3, 0.08)]

    def test_line_breaks_are_the_callers_choice(self, spark, tmp_path):
        base = {"SampleDate": "2020-01-02", "SampleTime": "08:00:00", "LatitudeStart": 38, "LongitudeStart": -121, "StationCode": "a"}
        raw = self.stage(tmp_path, "EDSM", KDTR=[{**base, "Comments": "two\nlines"}])
        got = SURVEYS["EDSM"].read(spark, raw, line_breaks=["KDTR"])
        assert rows(got, "Date", "Notes") == [(dt.date(2020, 1, 2), "two\nlines")]
        with pytest.raises(ValueError, match="no feeds"):
            SURVEYS["EDSM"].read(spark, raw, line_breaks=["tow"])

    def test_one_scan_per_header(self, spark, tmp_path):
        for i in range(6):
            (tmp_path / f"{i}.csv").write_text("A,B\n" * (i % 2 == 0) + "B,C\n" * (i % 2) + f"{i},x\n")
        assert len(scan.scan_by_header(spark, str(tmp_path))) == 2
        got = scan.scan_ragged_csv(spark, str(tmp_path)).orderBy("_row").collect()
        assert [r.A if i % 2 == 0 else r.B for i, r in enumerate(got)] == [str(i) for i in range(6)]


@pytest.mark.parametrize("name, texts", [("survey_stn", 2), ("survey_skt", 2), ("survey_usbr", 5)])
def test_texts_are_read_once(spark, small, name, texts):
    plan = QUERIES[name](spark, small)._jdf.queryExecution().optimizedPlan().toString()
    # usbr reads its days in three places and its times in two: the totals of a day stand for hot days and for others
    assert plan.count("gettimestamp(") == texts


class TestSurveyQuirks:
    def test_djfmp_rows_without_time_become_one(self, spark):
        tows = [{"StationCode": "a", "SampleDate": f"2020-01-0{i}", "Secchi": i} for i in (1, 2, 3)]
        assert rows(clean(spark, "DJFMP", trawl_early=tows[1:], trawl_late=tows[:1]), "Station", "Date", "Secchi") == [("a", dt.date(2020, 1, 2), 200.0)]

    def test_skt_noon_and_typo(self, spark):
        sample = [{"StationCode": "519", "SampleDate": "3/6/2018 0:00:00", "SampleTimeStart": "12/30/1899 0:00:00", "Latitude": "38-6-0'N", "Longitude": "121-29.41.7"}]
        got = clean(spark, "SKT", sample=sample).first()
        assert got.Datetime == dt.datetime(2018, 3, 6, 12) and got.Field_coords
        assert got.Latitude == pytest.approx(38.1) and got.Longitude == pytest.approx(-(121 + 29 / 60 + 41.7 / 3600))

    def test_sls_visits_without_notes_lose_conductivity(self, spark):
        water = [{"Date": "1/2/2020 0:00:00", "Station": s, "TopEC": 5, "Comments": c} for s, c in (("a", None), ("b", "calm"), ("c", "CDEC"))]
        assert rows(clean(spark, "SLS", water_info=water), "Station", "Conductivity") == [("a", None), ("b", 5.0), ("c", None)]

    def test_sls_two_tows_double_the_visit(self, spark):
        water = [{"Date": "1/2/2020 0:00:00", "Station": "a"}]
        tows = [{"Date": "1/2/2020 0:00:00", "Station": "a", "Tide": t} for t in (1, 4)]
        assert rows(clean(spark, "SLS", water_info=water, tow_info=tows), "Tide") == [("Flood",), ("High Slack",)]

    def test_20mm_unknown_tow_time_hides_all_tows(self, spark):
        visit = [{"StationID": "1", "SurveyID": "9", "Station": "504"}, {"StationID": "2", "SurveyID": "9", "Station": "504"}]
        tows = [{"StationID": s, "TowTime": t, "TowNum": n, "BottomDepth": 25, "Tide": 2} for s, t, n in
                (("1", "12/30/1899 1:15:00", 1), ("1", "12/30/1899 10:00:00", 2), ("2", None, 1), ("2", "12/30/1899 9:00:00", 2))]
        got = clean(spark, "20mm", visit=visit, tow=tows, survey=[{"SurveyID": "9", "SampleDate": "5/3/1997 0:00:00"}])
        assert rows(got, "Datetime", "Tide", "Depth") == [(dt.datetime(1997, 5, 3, 10), "Ebb", 7.62), (None, None, None)]

    def test_suisun_visits_without_tide_vanish(self, spark):
        sample = [{"SampleRowID": i, "StationCode": "a", "SampleDate": f"1/{d}/2020 0:00:00", "SampleTime": f"12/30/1899 {h}:00:00", "WaterTemperature": 10, "TideCode": t}
                  for i, (d, h, t) in enumerate([(1, 8, None), (2, 8, "ebb"), (2, 10, None), (2, 12, "incoming"), (2, 14, "flood")])]
        got = clean(spark, "Suisun", sample=sample, depth=[{"SampleRowID": 1, "Depth": 2}, {"SampleRowID": 1, "Depth": 4}, {"SampleRowID": 2, "Depth": 6}])
        assert rows(got, "Date", "Datetime", "Tide", "Depth") == [(dt.date(2020, 1, 2), dt.datetime(2020, 1, 2, 11), "Flood", 4.5)]

    def test_suisun_can_keep_visits_without_tide(self, spark):
        names = ["Station", "Tide", *suisun.MEASURES, "Depth"]
        df = spark.createDataFrame([("a", None, *[1.0] * 7)], ", ".join(f"{n} {'string' if n in ('Station', 'Tide') else 'double'}" for n in names))
        df = df.withColumns({"Date": F.lit("2020-01-01").cast("date"), "Datetime": F.lit(None).cast("timestamp_ntz"), "_row": F.lit(1)})
        assert suisun.collapse_visits(df).count() == 0
        assert suisun.collapse_visits(df, drop_empty_mode=False).count() == 1

    def test_sdo_mistyped_time_and_pst(self, spark):
        wide = [{"Date": "7/1/2018", "Time": t, "StationID": "tb", "WTSurface": 20, "Microcystis": m} for t, m in (("111", "present"), ("930", "2.5"), (None, "3"))]
        assert rows(clean(spark, "SDO", wide=wide), "Datetime", "Microcystis") == [
            (dt.datetime(2018, 7, 1, 10, 30), 2.0), (dt.datetime(2018, 7, 1, 12, 11), None), (None, 3.0)]

    def test_sdo_events_split_where_secchi_differs(self, spark):
        deep = [{"Description": "P8", "Date": "2021-07-01", "Time_PST": "1899-12-31 09:00:00", "Depth_m": d, "Secchi_cm": s, "Temperature": d} for d, s in ((1, 50), (3, 50), (6, 50), (6, 60))]
        got = clean(spark, "SDO", by_depth=deep)
        assert rows(got, "Station", "Secchi", "Temperature", "Temperature_bottom") == [("lt40", 50.0, 1.0, 6.0), ("lt40", 60.0, None, 6.0)]

    def test_ybfmp_literal_repairs(self, spark):
        fish = [{"SampleDate": "1/20/2017", "Datetime": "1/20/2017 12:05", "StationCode": "STTD", "WaterTemp": 9, "Secchi": 0.2},
                {"SampleDate": "1/31/2017", "Datetime": "1/31/2017 13:20", "StationCode": "STTD", "WaterTemp": 9, "Secchi": 0.2},
                {"SampleDate": "1/23/2017", "Datetime": "1/23/2017 13:30", "StationCode": "STTD", "WaterTemp": 9, "Secchi": 0.2, "MicrocystisRank": 1},
                {"SampleDate": "1/24/2017", "Datetime": "1/24/2017 13:30", "StationCode": "STTD", "WaterTemp": 9, "Secchi": 0.2}]
        assert rows(clean(spark, "YBFMP", fish=fish), "Date", "Temperature", "Microcystis") == [(dt.date(2017, 1, 23), None, 1.0), (dt.date(2017, 1, 24), 9.0, None)]

    def test_ybfmp_repeated_visits_and_days(self, spark):
        def record(station, time, temp, secchi, **more):
            return {"SampleDate": "1/24/2017", "Datetime": time and f"1/24/2017 {time}", "StationCode": station, "WaterTemp": temp, "Secchi": secchi, **more}

        fish = [
            record("alone", "8:00", 9, None),  # a single visit needs no Secchi depth
            record("noted", "8:00", 9, None, FieldComments="x"), record("noted", "8:00", 9, None, FieldComments="y"),  # both leave
            record("both", "8:00", 9, None), record("both", "8:00", 7, 0.2),  # the one with a depth stays
            record("day", "9:00", 9, 0.2), record("day", "8:00", 9, 0.2), record("day", "10:00", 9, 0.2, Tide="High"),  # the earliest of a day
            record("untimed", None, 9, 0.2), record("untimed", "8:00", 9, 0.2, Tide="Low"),  # no earliest is known
        ]
        got = clean(spark, "YBFMP", fish=fish)
        assert rows(got, "Station", "Datetime", "Temperature", "Secchi") == [
            ("alone", dt.datetime(2017, 1, 24, 8), 9.0, None), ("both", dt.datetime(2017, 1, 24, 8), 7.0, 20.0), ("day", dt.datetime(2017, 1, 24, 8), 9.0, 20.0)]

    def test_ybfmp_feeds_that_differ_are_averaged(self, spark):
        zoop = [{"Date": "2017-01-24", "Datetime": "2017-01-24 08:00:00", "StationCode": "a", "WaterTemperature": 9, "Secchi": 0.25}]
        fish = [{"SampleDate": "1/24/2017", "Datetime": "1/24/2017 8:00", "StationCode": "a", "WaterTemp": 10, "Secchi": 0.2, "MicrocystisRank": 2}]
        got = clean(spark, "YBFMP", zoop=zoop, fish=fish)
        assert rows(got, "Temperature", "Secchi", "Microcystis") == [(9.5, 22.0, 2.0)]

    def test_cawsc_date_follows_local_time(self, spark):
        results = [{"MonitoringLocationIdentifier": "USGS-1", "ActivityStartDate": "2020-07-01", "ActivityStartDateTime": "2020-07-02 07:30:00",
                    "CharacteristicName": c, "ResultMeasureValue": v, "ResultDetectionConditionText": t} for c, v, t in (("pH", 7, None), ("Orthophosphate", None, "Not Detected"))]
        got = clean(spark, "USGS_CAWSC", results=results).first()
        assert (got.Date, got.Datetime, got.pH, got.DissOrthophos, got.DissOrthophos_Sign, got.Chlorophyll_Sign) == (
            dt.date(2020, 7, 2), dt.datetime(2020, 7, 2, 0, 30), 7.0, 0.008, "<", "=")

    def test_sfbs_first_of_day_and_bins(self, spark):
        early = [{"Date": "7/3/98", "Time": t, "Station": "3.0", "Depth": d, "Temperature": v, "DissSilica": n} for t, d, v, n in
                 (("8:00", 1, 15, 10), ("9:00", 1, 99, None), ("8:10", 10, 12, 20), ("8:10", 5, 13, None))]
        got = clean(spark, "USGS_SFBS", early=early, stations=[{"Station": "3", "Latitude": 37.5, "Longitude": -122}]).first()
        assert (got.Station, got.Date, got.Temperature, got.Temperature_bottom, got.Latitude) == ("3", dt.date(1998, 7, 3), 15.0, 12.0, 37.5)
        assert (got.Sample_depth_surface, got.Sample_depth_bottom, got.Sample_depth_nutr_surface) == (1.0, 10.0, 1.0)
        assert got.DissSilica == pytest.approx(0.60084) and got.Datetime == dt.datetime(1998, 7, 3, 8, 3, 20)

    def test_sfbs_published_headers(self, spark):
        names = ["Date", "Time", "Station_Number", "Depth", "Calculated_Chlorophyll", "Salinity", "Temperature", "Nitrate_+_Nitrite", "Ammonium", "Phosphate", "Silicate"]
        files = [spark.createDataFrame([("1/2/2016", "930", *["1"] * 10, 0)], ", ".join(f"`{n}` string" for n in [*names, oxygen]) + ", _row int")
                 for oxygen in ("Oxygen", "Calculated_Oxygen")]
        got = usgs_sfbs.shape_published(files)
        assert [(r.Time, r.DissolvedOxygen) for r in got.collect()] == [("9:30", "1")] * 2

    def test_ncro(self, spark):
        base = {"SampleType": "Normal Sample", "Analyte": "Field pH", "LongStationName": "Rock Slough @ CCWD", "StationNumber": "(NONE)", "CollectionDate": "7/1/2018 9:00",
                "RptLimit": "0.1"}
        requested = [
            {**base, "SampleCode": "s2", "Result": "7.2"}, {**base, "SampleCode": "s1", "Result": "7.1"}, {**base, "SampleCode": "s0", "Result": "7.0", "Notes": "Field DUPLICATE"},
            {**base, "SampleCode": "s3", "Analyte": "Dissolved Calcium", "Result": "5000", "Units": "ug/L"},
            {**base, "SampleCode": "s4", "Analyte": "Dissolved Ammonia", "Result": "<0.1"},
            {**base, "SampleCode": "s5", "Analyte": "Field Turbidity", "Result": "4", "CollectionDate": "2018-07-02 00:30:00"},
            {**base, "SampleCode": "s6", "LongStationName": "Nowhere"}, {**base, "SampleCode": "s7", "Result": "1", "CollectionDate": "7/5/2018 9:00"},
        ]
        stations = [{"StationNumber": "B9522200", "StationName": "Rock Slough", "WQES_StationCode": "RS", "LastDate_NTU": "7/1/2018", "FirstDate_FNU": "7/2/2018"}]
        got = clean(
            spark, "NCRO", requested=requested, stations=stations, portal_stations=[{"station_number": "B9522200", "latitude": 38, "longitude": -121.6}],
            secchi=[{"StationCode": "RS", "FldObsWaterHabs": "Low", "FldObsSecchi": 0.5, "DeploymentEnd": "2018-07-01 10:00:00"}],
            same_day=[{"SampleCode": "s7", "KeepRecord": "no"}], questionable=[{"SampleCode": "s3", "Analyte": "DissCalcium", "MeasVerified": "No", "ResultVerified": 6}],
        )
        assert rows(got, "Datetime", "pH", "DissCalcium", "DissAmmonia", "DissAmmonia_Sign", "TurbidityFNU", "TurbidityNTU", "Secchi", "Microcystis", "Latitude") == [
            (dt.datetime(2018, 7, 1, 10), 7.1, 6.0, 0.1, "<", None, None, 50.0, 2.0, 38.0),
            (dt.datetime(2018, 7, 2, 13, 30), None, None, None, "=", 4.0, None, None, None, 38.0),
        ]


class TestCompare:
    def test_portal_zero_is_censored(self, spark):
        analytes = spark.createDataFrame([("Field pH", "pH", "Y"), ("Lead", "Pb", "N")], "Analyte string, Abbreviation string, UseYN string")
        requested = spark.createDataFrame([("2020-01-01",), ("2020-12-31",)], "Date string").select(F.col("Date").cast("date"))
        portal = spark.createDataFrame(
            [("pH", "2020-02-01", "0", "0.5", " x "), ("pH", "2020-02-01", "-1", "0.5", "x"), ("pH", "2021-02-01", "7", "0.5", "x"), ("Lead", "2020-02-01", "7", "0.5", "x")],
            "Analyte string, DateTime string, Result string, RL string, ShortStationName string",
        ).withColumns({"DateTime": F.col("DateTime").cast("timestamp_ntz"), "Depth": F.lit(1.0), "DepthUnits": F.lit("m")})
        assert rows(compare.prepare_portal(portal, analytes, requested), "Analyte", "Result", "ResultSign", "ShortStationName", "Depth") == [("Field pH", 0.5, "<", "x", "1 m")]
