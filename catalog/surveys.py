"""The cleaning plan of every survey, run over raw feeds seen in the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import feeds  # noqa: F401  (registers the raw feeds)
from catalog.core import query
from tidemerge.plans.surveys import SURVEYS

ZONE = "'America/Los_Angeles'"
TRAWL = {"1": "High Slack", "2": "Ebb", "3": "Low Slack", "4": "Flood"}


#: How the views of a survey's feeds begin.
FEED_PREFIX: dict[str, str] = {}


def survey(name: str, key: str, prefix: str, sql: str, rounded: dict[str, int] | None = None) -> None:
    """Register a survey's plan; its feeds are the views named ``prefix_feed``.

    Columns that hold means are ``rounded``, as sums of doubles depend on their order.
    """
    plan = SURVEYS[name]
    FEED_PREFIX[name] = prefix
    inputs = [f"{prefix}_{feed}".lower() for feed in plan.feeds]

    def run(*tables):
        table = plan.build(dict(zip(plan.feeds, tables)))
        return table.withColumns({c: F.round(c, digits) for c, digits in (rounded or {}).items()})

    run.__name__ = key
    run.__doc__ = f"Cleaned table of {name}."
    query(*inputs, sql=sql)(run)


def stamp(text: str) -> str:
    return f"try_strptime({text}, '%m/%d/%Y %H:%M:%S')"


def local(ts: str) -> str:
    """NULL for wall-clock times that daylight saving skips."""
    return f"CASE WHEN timezone({ZONE}, timezone({ZONE}, {ts})) = {ts} THEN {ts} END"


def from_zone(zone: str, ts: str) -> str:
    return f"timezone({ZONE}, timezone('{zone}', {ts}))"


def at(day: str, time: str) -> str:
    return f"make_timestamp(year({day}), month({day}), day({day}), hour({time}), minute({time}), 0.0)"


def coded(expr: str, mapping: dict, otherwise: str = "NULL") -> str:
    whens = " ".join(f"WHEN '{a}' THEN " + ("NULL" if b is None else f"'{b}'") for a, b in mapping.items())
    return f"CASE {expr} {whens} ELSE {otherwise} END"


def strict(fn: str, col: str) -> str:
    return f"CASE WHEN count(*) OVER w = count({col}) OVER w THEN {fn}({col}) OVER w END"


def dms_stations(view: str, station: str = "Station", latitude=("LatD", "LatM", "LatS"), longitude=("LonD", "LonM", "LonS")) -> str:
    """Positions in degrees, minutes and seconds of the named columns."""
    def degrees(parts):
        return "{} + {} / 60 + {} / 3600".format(*parts)

    return f"""SELECT {station} AS Station, {degrees(latitude)} AS Latitude,
      ({degrees(longitude)}) * -1 AS Longitude FROM {view}
      WHERE {station} IS NOT NULL AND {degrees(latitude)} IS NOT NULL AND {degrees(longitude)} IS NOT NULL"""


FIELD_COORDS = """(s.Latitude IS NULL AND v.Latitude IS NOT NULL) OR (s.Longitude IS NULL AND v.Longitude IS NOT NULL) AS Field_coords,
  coalesce(s.Latitude, v.Latitude) AS Latitude, coalesce(s.Longitude, v.Longitude) AS Longitude"""

survey("DJFMP", "survey_djfmp", "djfmp", f"""
WITH trawl AS (SELECT 0 AS feed, * FROM djfmp_trawl_early UNION ALL BY NAME SELECT 1 AS feed, * FROM djfmp_trawl_late),
timed AS (SELECT *, CAST(SampleDate AS DATE) AS d, try_strptime(SampleDate || ' ' || SampleTime, '%Y-%m-%d %H:%M:%S') AS t FROM trawl),
firsts AS (SELECT *, {local('t')} AS Datetime FROM timed
  QUALIFY row_number() OVER (PARTITION BY StationCode, Datetime ORDER BY feed, _row) = 1)
SELECT 'DJFMP' AS Source, f.StationCode AS Station, Latitude, Longitude, d AS Date, Datetime, Secchi * 100 AS Secchi,
  WaterTemp AS Temperature, CASE WHEN d >= DATE '2019-06-01' THEN SpecificConductance END AS Conductivity, "DO" AS DissolvedOxygen
FROM firsts f LEFT JOIN djfmp_sites s ON f.StationCode = s.StationCode
""")

survey("DOP", "survey_dop", "dop", f"""
WITH t AS (SELECT *, coalesce(Station_Code, 'NA') || ' ' || coalesce(Habitat, 'NA') AS Station,
  {local("try_strptime(Date || ' ' || Start_Time, '%Y-%m-%d %H:%M:%S')")} AS Datetime, CAST(Date AS DATE) AS d FROM dop_tow
  WHERE Habitat IS NULL OR Habitat NOT IN ('Channel Deep', 'Oblique'))
SELECT 'DOP' AS Source, Station, Latitude, Longitude, TRUE AS Field_coords, d AS Date, Datetime, Start_Depth * 0.3048 AS Depth,
  Secchi, Temperature, Salinity, Conductivity, "DO" AS DissolvedOxygen, pH, Turbidity AS TurbidityFNU, Chl_a AS Chlorophyll FROM t
QUALIFY row_number() OVER (PARTITION BY Station, d, Secchi, Temperature, Salinity, Conductivity, "DO", pH, Turbidity, Chl_a
                           ORDER BY Datetime NULLS LAST, _row) = 1
""")

survey("EDSM", "survey_edsm", "edsm", f"""
WITH u AS (
  SELECT 0 AS feed, SampleDate, LatitudeStart, LongitudeStart, StationCode, Secchi, SampleTime, Tide, BottomDepth * 0.3048 AS Depth,
    Comments, SpecificConductanceTop AS ec, WaterTempTop AS Temperature, WaterTempBottom AS Temperature_bottom,
    DOTop AS DissolvedOxygen, DOBottom AS DissolvedOxygen_bottom, _row FROM edsm_20mm
  UNION ALL BY NAME
  SELECT 1 AS feed, SampleDate, LatitudeStart, LongitudeStart, StationCode, Secchi, SampleTime, Tide, BottomDepth AS Depth,
    Comments, SpecificConductance AS ec, WaterTemp AS Temperature, "DO" AS DissolvedOxygen, _row FROM edsm_kdtr),
d AS (SELECT *, coalesce(try_strptime(SampleDate, '%Y-%m-%d'), try_strptime(SampleDate, '%m/%d/%Y'))::DATE AS day,
  StationCode || ' ' || SampleDate AS Station FROM u),
t AS (SELECT *, {local("try_strptime(CAST(day AS VARCHAR) || ' ' || SampleTime, '%Y-%m-%d %H:%M:%S')")} AS Datetime FROM d)
SELECT 'EDSM' AS Source, Station, LatitudeStart AS Latitude, LongitudeStart AS Longitude, TRUE AS Field_coords, day AS Date,
  Datetime, Depth, {coded('Tide', {'HS': 'High Slack', 'LS': 'Low Slack'}, 'Tide')} AS Tide, Secchi * 100 AS Secchi,
  Temperature, Temperature_bottom, CASE WHEN day >= DATE '2019-06-01' THEN ec END AS Conductivity, DissolvedOxygen,
  DissolvedOxygen_bottom, Comments AS Notes FROM t
QUALIFY row_number() OVER (PARTITION BY Station, LatitudeStart, LongitudeStart, day, Datetime ORDER BY feed, _row) = 1
""")

FMWT_MEASURES = "Microcystis, Secchi, Temperature, Temperature_bottom, Conductivity, Conductivity_bottom, TurbidityNTU"
survey("FMWT", "survey_fmwt", "fmwt", f"""
WITH p AS (SELECT *, {stamp('SampleDate')} AS d, CASE WHEN hour({stamp('SampleTimeStart')}) <> 0 THEN {stamp('SampleTimeStart')} END AS t
  FROM fmwt_sample),
m AS (SELECT StationCode AS Station, CAST(d AS DATE) AS Date, {local(at('d', 't'))} AS Datetime, DepthBottom * 0.3048 AS Depth,
  {coded('CAST(TideCode AS VARCHAR)', TRAWL)} AS Tide, CASE WHEN Microcystis = 6 THEN 2 ELSE Microcystis END AS Microcystis,
  Secchi * 100 AS Secchi, SecchiEstimated AS Secchi_estimated, WaterTemperature AS Temperature,
  CASE WHEN BottomTemperature <> 0 AND BottomTemperature <= 40 THEN BottomTemperature END AS Temperature_bottom,
  ConductivityTop AS Conductivity, nullif(ConductivityBottom, 0) AS Conductivity_bottom, Turbidity AS TurbidityNTU, _row FROM p),
s AS (SELECT StationCode, DD_Latitude AS Latitude, DD_Longitude AS Longitude FROM fmwt_stations
  WHERE StationCode IS NOT NULL AND DD_Latitude IS NOT NULL AND DD_Longitude IS NOT NULL)
SELECT 'FMWT' AS Source, Station, Latitude, Longitude, Date, Datetime, Depth, Tide, Secchi_estimated, {FMWT_MEASURES}
FROM m LEFT JOIN s ON Station = StationCode WHERE coalesce({FMWT_MEASURES}) IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY Station, Date, Datetime ORDER BY _row) = 1
""")

survey("STN", "survey_stn", "stn", f"""
WITH tows AS (SELECT SampleRowID, min({stamp('TimeStart')}) AS t FROM stn_tow_effort
  WHERE SampleRowID IS NOT NULL AND {stamp('TimeStart')} IS NOT NULL GROUP BY SampleRowID),
st AS ({dms_stations('stn_stations', 'StationCodeSTN')}),
p AS (SELECT *, {stamp('SampleDate')} AS d FROM stn_sample LEFT JOIN tows USING (SampleRowID))
SELECT 'STN' AS Source, StationCode AS Station, Latitude, Longitude, CAST(d AS DATE) AS Date, {local(at('d', 't'))} AS Datetime,
  DepthBottom * 0.3048 AS Depth, {coded('CAST(TideCode AS VARCHAR)', TRAWL, 'CAST(TideCode AS VARCHAR)')} AS Tide, Microcystis,
  Secchi, TemperatureTop AS Temperature, TemperatureBottom AS Temperature_bottom, ConductivityTop AS Conductivity,
  ConductivityBottom AS Conductivity_bottom, TurbidityTop AS TurbidityNTU, SampleComments AS Notes
FROM p LEFT JOIN st ON StationCode = st.Station
WHERE coalesce(Microcystis, Secchi, TemperatureTop, TemperatureBottom, ConductivityTop, ConductivityBottom, TurbidityTop) IS NOT NULL
""")

TIDE_NUMBER = "CAST(CAST(t.Tide AS BIGINT) AS VARCHAR)"
survey("SLS", "survey_sls", "sls", f"""
WITH st AS ({dms_stations('sls_stations')})
SELECT 'SLS' AS Source, w.Station, Latitude, Longitude, CAST({stamp('w.Date')} AS DATE) AS Date,
  {local(at(stamp('w.Date'), stamp('t.Time')))} AS Datetime, BottomDepth * 0.3048 AS Depth,
  {coded(TIDE_NUMBER, TRAWL, TIDE_NUMBER)} AS Tide, Secchi, Temp AS Temperature,
  CASE WHEN Comments NOT LIKE '%CDEC%' THEN TopEC END AS Conductivity, Comments AS Notes
FROM sls_water_info w LEFT JOIN sls_tow_info t ON w.Date = t.Date AND w.Station = t.Station LEFT JOIN st ON w.Station = st.Station
""")


def dirty(col: str) -> str:
    cut = f"regexp_replace(regexp_replace(regexp_replace({col}, '\".*', ''), '''.*', ''), '[a-zA-Z]', '')"
    part = [f"try_cast(split_part({cut}, '-', {i}) AS DOUBLE)" for i in (1, 2, 3)]
    return f"({part[0]} + {part[1]} / 60 + {part[2]} / 3600)"


survey("SKT", "survey_skt", "skt", f"""
WITH st AS ({dms_stations('skt_stations', latitude=('LatDeg', 'LatMin', 'LatSec'), longitude=('LongDec', 'LongMin', 'LongSec'))}),
p AS (SELECT *, {stamp('SampleDate')} AS d FROM skt_sample),
c AS (SELECT *, CASE WHEN CAST(d AS DATE) = DATE '2018-03-06' AND StationCode = '519' THEN TIMESTAMP '1899-12-30 12:00:00'
  ELSE {stamp('SampleTimeStart')} END AS t,
  {dirty("nullif(Latitude, '0')")} AS lat, {dirty("CASE WHEN Longitude = '121-29.41.7' THEN '121-29-41.7' ELSE nullif(Longitude, '0') END")} * -1 AS lon FROM p),
v AS (SELECT * EXCLUDE (Latitude, Longitude), lat AS Latitude, lon AS Longitude FROM c)
SELECT 'SKT' AS Source, StationCode AS Station, {FIELD_COORDS}, CAST(d AS DATE) AS Date, {local(at('d', 't'))} AS Datetime,
  DepthBottom * 0.3048 AS Depth, {coded('CAST(TideCode AS VARCHAR)', {**TRAWL, '0': None}, 'CAST(TideCode AS VARCHAR)')} AS Tide, Secchi,
  CASE WHEN SampleComments IS NULL OR SampleComments NOT LIKE '%from CDEC%' THEN WaterTemperature END AS Temperature,
  CASE WHEN SampleComments IS NULL OR SampleComments NOT LIKE '%from CDEC%' THEN ConductivityTop END AS Conductivity,
  SampleComments AS Notes
FROM v LEFT JOIN st s ON v.StationCode = s.Station
""")

survey("USBR", "survey_usbr", "usbr", f"""
WITH p AS (SELECT *, CAST(Date AS DATE) AS d, {local("strptime(Datetime, '%Y-%m-%d %H:%M:%S')")} AS t FROM usbr_profiles),
b AS (SELECT *, {strict('min', 'Depth_feet')} AS top, {strict('max', 'Depth_feet')} AS deep, {strict('min', 't')} AS t0, {strict('max', 't')} AS t1
  FROM p WINDOW w AS (PARTITION BY Station, d)),
k AS (SELECT *, make_timestamp((epoch_us(t0) + (epoch_us(t1) - epoch_us(t0)) // 2)::BIGINT) AS mid,
  CASE WHEN Depth_feet = top AND Depth_feet < 3 THEN 's' WHEN Depth_feet = deep AND Depth_feet > 3 THEN 'b' END AS bin FROM b),
g AS (SELECT Station, d, mid, """ + ", ".join(
    f"CASE WHEN count(*) FILTER (bin = '{b}') = count({c}) FILTER (bin = '{b}') THEN avg({c}) FILTER (bin = '{b}') END AS {c}_{b}"
    for c in ("Depth_feet", "Temperature", "Conductivity", "Chlorophyll") for b in "sb"
) + """ FROM k WHERE bin IS NOT NULL GROUP BY Station, d, mid),
s AS (SELECT CASE WHEN replace(Station, 'NL ', '') = 'PS' THEN 'Pro' ELSE replace(Station, 'NL ', '') END AS Station, Latitude, Longitude, Depth_m
  FROM usbr_sites)
SELECT 'USBR' AS Source, g.Station, Latitude, Longitude, d AS Date, mid AS Datetime, Depth_m AS Depth,
  round(Depth_feet_s * 0.3048, 9) AS Sample_depth_surface, round(Depth_feet_b * 0.3048, 9) AS Sample_depth_bottom,
  round(Chlorophyll_s, 9) AS Chlorophyll, round(Temperature_s, 9) AS Temperature, round(Temperature_b, 9) AS Temperature_bottom,
  round(Conductivity_s, 6) AS Conductivity
FROM g LEFT JOIN s ON g.Station = s.Station
""", {"Sample_depth_surface": 9, "Sample_depth_bottom": 9, "Chlorophyll": 9, "Temperature": 9, "Temperature_bottom": 9, "Conductivity": 6})

EMP_SIGNED = feeds._EMP
survey("EMP", "survey_emp", "emp", f"""
WITH p AS (SELECT *, try_strptime(Date || ' ' || Time, '%Y-%m-%d %H:%M:%S') AS t, Station AS visited,
    NorthLat AS Latitude, WestLong AS Longitude FROM emp_measures),
s AS (SELECT * FROM emp_stations WHERE Station IS NOT NULL AND Latitude IS NOT NULL AND Longitude IS NOT NULL)
SELECT 'EMP' AS Source, v.visited AS Station, {FIELD_COORDS}, CAST(Date AS DATE) AS Date,
  CASE WHEN hour(t) <> 0 THEN {from_zone('Etc/GMT+8', 't')} END AS Datetime, FieldNotes AS Notes, Depth * 0.3048 AS Depth,
  'High Slack' AS Tide, round_even(Microcystis, 0) AS Microcystis, Chla_Sign AS Chlorophyll_Sign, Chla AS Chlorophyll, Secchi,
  WTSurface AS Temperature, WTBottom AS Temperature_bottom, SpCndSurface AS Conductivity, SpCndBottom AS Conductivity_bottom,
  DOSurface AS DissolvedOxygen, DOBottom AS DissolvedOxygen_bottom, DOpercentSurface AS DissolvedOxygenPercent,
  DOpercentBottom AS DissolvedOxygenPercent_bottom, pHSurface AS pH, pHBottom AS pH_bottom,
  TurbiditySurface_NTU AS TurbidityNTU, TurbidityBottom_NTU AS TurbidityNTU_bottom, TurbiditySurface_FNU AS TurbidityFNU,
  TurbidityBottom_FNU AS TurbidityFNU_bottom, {', '.join(f'{a}_Sign, {a}' for a in EMP_SIGNED)}
FROM p v LEFT JOIN s ON v.visited = s.Station
""")

survey("SDO", "survey_sdo", "sdo", f"""
WITH padded AS (SELECT *, CASE WHEN Time = '111' THEN '1111' WHEN length(Time) < 4 THEN lpad(Time, 4, '0') ELSE Time END AS hm FROM sdo_wide),
early AS (SELECT StationID AS Station, strptime(Date, '%m/%d/%Y')::DATE AS Date,
  {from_zone('Etc/GMT+8', "try_strptime(Date || ' ' || hm, '%m/%d/%Y %H%M')")} AS Datetime,
  round_even(try_cast(Microcystis AS DOUBLE), 0) AS Microcystis, Secchi, WTSurface AS Temperature, WTBottom AS Temperature_bottom,
  SpCndSurface AS Conductivity, SpCndBottom AS Conductivity_bottom, DOSurface AS DissolvedOxygen, DOBottom AS DissolvedOxygen_bottom,
  pHSurface AS pH, pHBottom AS pH_bottom FROM padded),
kept AS (SELECT * FROM early WHERE coalesce(Microcystis, Secchi, Temperature, Temperature_bottom, Conductivity, Conductivity_bottom,
  DissolvedOxygen, DissolvedOxygen_bottom, pH, pH_bottom) IS NOT NULL),
deep AS (SELECT {coded('Description', {'Turning Basin': 'tb', 'P8': 'lt40', 'Light 41': 'lt41', 'Light 43': 'lt43', 'Light 48': 'lt48'}, 'Description')} AS Station,
  {from_zone('Etc/GMT+8', at('Date', 'Time_PST'))} AS Datetime, Date, CASE Depth_m WHEN 1 THEN 'top' WHEN 6 THEN 'bottom' END AS bin,
  MC_Score AS Microcystis, Secchi_cm AS Secchi, Temperature, Conductivity, DissolvedOxygen, pH, _row FROM sdo_by_depth WHERE Depth_m IN (1, 6)),
firsts AS (SELECT * FROM deep QUALIFY row_number() OVER (PARTITION BY Station, Datetime, Date, Microcystis, Secchi, bin ORDER BY _row) = 1),
late AS (SELECT Station, Date, Datetime, Microcystis, Secchi, """ + ", ".join(
    f"max({c}) FILTER (bin = 'top') AS {c}, max({c}) FILTER (bin = 'bottom') AS {c}_bottom"
    for c in ("Temperature", "Conductivity", "DissolvedOxygen", "pH")
) + """ FROM firsts GROUP BY Station, Date, Datetime, Microcystis, Secchi)
SELECT 'SDO' AS Source, u.*, Latitude, Longitude FROM (SELECT * FROM kept UNION ALL BY NAME SELECT * FROM late) u
LEFT JOIN sdo_sites ON Station = StationID
""")

survey("20mm", "survey_20mm", "twentymm", f"""
WITH st AS ({dms_stations('twentymm_stations')}),
tows AS (SELECT *, CASE WHEN hour({stamp('TowTime')}) IN (1, 2) THEN {stamp('TowTime')} + INTERVAL 12 HOUR ELSE {stamp('TowTime')} END AS t
  FROM twentymm_tow),
t1 AS (SELECT * FROM tows WINDOW w AS (PARTITION BY StationID) QUALIFY t = {strict('min', 't')}),
t2 AS (SELECT * FROM t1 WINDOW w AS (PARTITION BY StationID) QUALIFY TowNum = {strict('min', 'TowNum')}),
v AS (SELECT o.*, LatDeg + LatMin / 60 + LatSec / 3600 AS Latitude, (LonDeg + LonMin / 60 + LonSec / 3600) * -1 AS Longitude,
  CAST({stamp('SampleDate')} AS DATE) AS d, t, t2.Tide, BottomDepth
  FROM twentymm_visit o LEFT JOIN twentymm_survey y ON o.SurveyID = y.SurveyID LEFT JOIN t2 ON o.StationID = t2.StationID)
SELECT '20mm' AS Source, v.Station, {FIELD_COORDS}, d AS Date, {local(at('d', 't'))} AS Datetime, BottomDepth * 0.3048 AS Depth,
  {coded('CAST(CAST(Tide AS BIGINT) AS VARCHAR)', TRAWL, 'CAST(CAST(Tide AS BIGINT) AS VARCHAR)')} AS Tide, Secchi, Temp AS Temperature,
  TopEC AS Conductivity, BottomEC AS Conductivity_bottom, Comments AS Notes
FROM v LEFT JOIN st s ON v.Station = s.Station
""")


def packed(col: str, digits: int) -> str:
    text = f"CAST(CAST({col} AS BIGINT) AS VARCHAR)"
    d, m, rest = f"substr({text}, 1, {digits})", f"substr({text}, {digits + 1}, 2)", f"substr({text}, {digits + 3})"
    by_seconds = f"try_cast({d} AS DOUBLE) + try_cast({m} AS DOUBLE) / 60 + try_cast({rest} AS DOUBLE) / 3600"
    by_minutes = f"try_cast({d} AS DOUBLE) + try_cast({m} || '.' || {rest} AS DOUBLE) / 60"
    return f"(CASE WHEN d >= DATE '1990-05-01' THEN {by_minutes} WHEN d < DATE '1990-05-01' THEN {by_seconds} END)"


survey("Baystudy", "survey_baystudy", "baystudy", f"""
WITH st AS (SELECT CASE WHEN Station = '211W' THEN '211' ELSE Station END AS Station,
  CAST(split_part(Latitude, '°', 1) AS DOUBLE) + CAST(split_part(Latitude, '°', 2) AS DOUBLE) / 60 AS Latitude,
  CAST(split_part(Longitude, '°', 1) AS DOUBLE) - CAST(split_part(Longitude, '°', 2) AS DOUBLE) / 60 AS Longitude
  FROM baystudy_stations WHERE Station <> '211E'),
visit AS (SELECT b.Year, b.Survey, b.Station, CAST({stamp('Date')} AS DATE) AS d, Depth, Secchi, Description AS tide_visit,
  ECSurf, ECBott, TempSurf, TempBott
  FROM baystudy_boat_station b LEFT JOIN baystudy_tide_codes c ON b.Tide = c.Tide
  LEFT JOIN baystudy_salin_temp t ON b.Year = t.Year AND b.Survey = t.Survey AND b.Station = t.Station),
tow AS (SELECT *, {stamp('Time')} AS t FROM baystudy_boat_tow),
firsts AS (SELECT * FROM tow WINDOW w AS (PARTITION BY Year, Survey, Station) QUALIFY t = {strict('min', 't')}),
v AS (SELECT f.Station, f._row, d, t, Depth, Secchi, coalesce(Description, tide_visit) AS tide, ECSurf, ECBott, TempSurf, TempBott,
  {packed('StartLat', 2)} AS Latitude, {packed('StartLong', 3)} * -1 AS Longitude
  FROM firsts f LEFT JOIN baystudy_tide_codes c ON f.Tide = c.Tide
  LEFT JOIN visit i ON f.Year = i.Year AND f.Survey = i.Survey AND f.Station = i.Station),
placed AS (SELECT v.Station, {FIELD_COORDS}, d AS Date, {local(at('d', 't'))} AS Datetime, Depth, tide AS Tide, Secchi,
  TempSurf AS Temperature, TempBott AS Temperature_bottom, ECSurf AS Conductivity, ECBott AS Conductivity_bottom, _row
  FROM v LEFT JOIN st s ON v.Station = s.Station)
SELECT 'Baystudy' AS Source, * EXCLUDE (_row) FROM placed
QUALIFY row_number() OVER (PARTITION BY Station, Date, Datetime ORDER BY _row, Depth, Secchi, Tide, Temperature) = 1
""")


def number_text(col: str) -> str:
    return f"coalesce(CASE WHEN {col} = floor({col}) THEN CAST(CAST({col} AS BIGINT) AS VARCHAR) ELSE CAST({col} AS VARCHAR) END, 'NA')"


SUISUN_ID = " || ' ' || ".join(
    ["CAST(d AS VARCHAR)", "Station", *[number_text(c) for c in ("Temperature", "Salinity", '"DO"', "PctSaturation", "Secchi", "ec")]]
)
survey("Suisun", "survey_suisun", "suisun", f"""
WITH depths AS (SELECT SampleRowID, avg(Depth) AS Depth FROM suisun_depth GROUP BY SampleRowID),
p AS (SELECT s.*, StationCode AS Station, CAST({stamp('SampleDate')} AS DATE) AS d,
  {local(at(stamp('SampleDate'), stamp('SampleTime')))} AS t, WaterTemperature AS Temperature, depths.Depth,
  coalesce(SpecificConductance, ElecCond / (1 + 0.019 * (WaterTemperature - 25))) AS ec,
  {coded('TideCode', {'flood': 'Flood', 'ebb': 'Ebb', 'low': 'Low Slack', 'high': 'High Slack', 'outgoing': 'Ebb', 'incoming': 'Flood'}, 'TideCode')} AS tide
  FROM suisun_sample s LEFT JOIN depths USING (SampleRowID)),
n AS (SELECT *, {SUISUN_ID} AS id FROM p),
g AS (SELECT d, Station, id, min(Temperature) AS Temperature, min(Secchi) AS Secchi, min(ec) AS ec, min("DO") AS do_, min(PctSaturation) AS pct,
  avg(Depth) AS Depth, make_timestamp((sum(epoch_us(t)) // count(t))::BIGINT) AS t FROM n GROUP BY d, Station, id),
m AS (SELECT d, Station, id, tide, count(*) AS c, min(_row) AS f FROM n WHERE tide IS NOT NULL GROUP BY d, Station, id, tide
  QUALIFY row_number() OVER (PARTITION BY d, Station, id ORDER BY count(*) DESC, min(_row)) = 1),
j AS (SELECT g.*, m.tide FROM g JOIN m ON g.d = m.d AND g.Station = m.Station AND g.id = m.id),
k AS (SELECT * FROM j QUALIFY row_number() OVER (PARTITION BY Station, d, t ORDER BY id) = 1)
SELECT 'Suisun' AS Source, k.Station, y_WGS84 AS Latitude, x_WGS84 AS Longitude, d AS Date, t AS Datetime, round(Depth, 9) AS Depth,
  tide AS Tide, Secchi, Temperature, ec AS Conductivity, do_ AS DissolvedOxygen, pct AS DissolvedOxygenPercent
FROM k LEFT JOIN (SELECT * FROM suisun_stations WHERE x_WGS84 IS NOT NULL AND y_WGS84 IS NOT NULL) s ON k.Station = s.StationCode
""", {"Depth": 9})

YB_WATER = "Temperature, Secchi, Conductivity, DissolvedOxygen, pH"
YB_ALL = f"Date, Datetime, Station, Tide, {YB_WATER}, Microcystis"


def yb_feed(view: str, day: str, time: str, temp: str, spc: str, mic: str) -> str:
    return f"""SELECT Date, Datetime, Station, Tide, {YB_WATER}, Microcystis, Notes, min(_row) AS _row FROM (
      SELECT {day} AS Date, {local(time)} AS Datetime, StationCode AS Station,
        {coded('Tide', {'High': 'High Slack', 'Low': 'Low Slack'}, 'Tide')} AS Tide, {temp} AS Temperature, Secchi * 100 AS Secchi,
        coalesce({spc}, Conductivity / (1 + 0.019 * ({temp} - 25))) AS Conductivity, {mic} AS Microcystis, "DO" AS DissolvedOxygen, pH,
        FieldComments AS Notes, _row FROM {view})
      WHERE coalesce(Temperature, Secchi, Conductivity, Microcystis, DissolvedOxygen, pH) IS NOT NULL GROUP BY ALL"""


survey("YBFMP", "survey_ybfmp", "ybfmp", f"""
WITH zoop AS ({yb_feed('ybfmp_zoop', 'CAST(Date AS DATE)', "try_strptime(Datetime, '%Y-%m-%d %H:%M:%S')", 'WaterTemperature', 'SpCnd', 'MicrocystisVisualRank')}),
fish0 AS ({yb_feed('ybfmp_fish', "strptime(SampleDate, '%m/%d/%Y')::DATE", "try_strptime(Datetime, '%m/%d/%Y %H:%M')", 'WaterTemp', 'SpecificConductance', 'MicrocystisRank')}),
fish_n AS (SELECT *, count(*) OVER (PARTITION BY Station, Datetime) AS n FROM fish0),
fish_d AS (SELECT * FROM fish_n WHERE n > 1 QUALIFY row_number() OVER (PARTITION BY {YB_ALL} ORDER BY _row) = 1),
fish1 AS (SELECT * FROM fish_n WHERE n = 1 UNION ALL SELECT * FROM fish_d WHERE Secchi IS NOT NULL),
fish2 AS (SELECT * FROM fish1 WINDOW w AS (PARTITION BY Date, Station, {YB_WATER}, Microcystis) QUALIFY Datetime = {strict('min', 'Datetime')}),
comb AS (SELECT {YB_ALL}, Notes, min(ord) AS ord FROM (
  SELECT {YB_ALL}, Notes, (0, _row) AS ord FROM zoop UNION ALL SELECT {YB_ALL}, Notes, (1, _row) FROM fish2) GROUP BY ALL),
comb_n AS (SELECT *, count(*) OVER (PARTITION BY Station, Datetime) AS n FROM comb),
d1 AS (SELECT * FROM comb_n WHERE n > 1 QUALIFY row_number() OVER (PARTITION BY {YB_ALL} ORDER BY ord) = 1),
d2 AS (SELECT * FROM d1 QUALIFY row_number() OVER (PARTITION BY Station, Datetime, Tide, {YB_WATER} ORDER BY Microcystis NULLS LAST, ord) = 1),
d3 AS (SELECT Date, Datetime, Station, Tide, Microcystis, Notes, avg(Temperature) OVER w AS Temperature,
  round_even(avg(Secchi) OVER w, 0) AS Secchi, avg(Conductivity) OVER w AS Conductivity, avg(DissolvedOxygen) OVER w AS DissolvedOxygen,
  avg(pH) OVER w AS pH FROM d2 WINDOW w AS (PARTITION BY Station, Datetime)
  QUALIFY row_number() OVER (PARTITION BY Station, Datetime ORDER BY Microcystis NULLS LAST, ord) = 1),
final AS (SELECT {YB_ALL}, Notes FROM comb_n WHERE n = 1 UNION ALL BY NAME SELECT * FROM d3)
SELECT 'YBFMP' AS Source, Station, Latitude, Longitude, Date, Datetime, Tide, Microcystis, Secchi, round(Temperature, 9) AS Temperature,
  round(Conductivity, 9) AS Conductivity, DissolvedOxygen, pH, Notes
FROM final LEFT JOIN (SELECT * FROM ybfmp_zoop_stations UNION SELECT * FROM ybfmp_fish_stations) s ON Station = StationCode
""", {"Temperature": 9, "Conductivity": 9})

CAWSC = {"Ammonia and ammonium": "DissAmmonia", "Chlorophyll a": "Chlorophyll", "Inorganic nitrogen (nitrate and nitrite)": "DissNitrateNitrite",
         "Organic carbon": "DOC", "Orthophosphate": "DissOrthophos", "Oxygen": "DissolvedOxygen", "pH": "pH",
         "Temperature, water": "Temperature", "Specific conductance": "Conductivity"}
CAWSC_SIGNED = ("DissAmmonia", "Chlorophyll", "DissNitrateNitrite", "DissOrthophos")
survey("USGS_CAWSC", "survey_usgs_cawsc", "cawsc", f"""
WITH s AS (SELECT *, CASE WHEN ResultDetectionConditionText = 'Not Detected' THEN '<' WHEN ResultValueTypeName = 'Estimated' THEN '~' ELSE '=' END AS sign,
  CAST(ActivityStartDate AS DATE) AS d, CAST(ActivityStartDateTime AS TIMESTAMP) AS utc FROM cawsc_results),
v AS (SELECT *, CASE WHEN sign = '<' THEN DetectionLimit ELSE ResultMeasureValue END AS v0, {coded('CharacteristicName', CAWSC)} AS analyte FROM s),
f AS (SELECT *, CASE WHEN v0 IS NOT NULL THEN v0 WHEN analyte = 'DissAmmonia' AND d < DATE '2020-10-20' THEN 0.02
  WHEN analyte = 'DissAmmonia' THEN 0.04 WHEN analyte = 'DissNitrateNitrite' AND Method = 'RED01' THEN 0.08
  WHEN analyte = 'DissNitrateNitrite' AND Method = 'RED02' THEN 0.02 WHEN analyte = 'DissOrthophos' THEN 0.008 END AS value FROM v),
k AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY MonitoringLocationIdentifier, d, utc, analyte ORDER BY _row) = 1),
w AS (SELECT MonitoringLocationIdentifier AS Station, d, utc, """ + ", ".join(
    [f"max(value) FILTER (analyte = '{a}') AS {a}" for a in CAWSC.values()]
    + [f"coalesce(max(sign) FILTER (analyte = '{a}'), '=') AS {a}_Sign" for a in CAWSC_SIGNED]
) + f""" FROM k GROUP BY ALL)
SELECT 'USGS_CAWSC' AS Source, w.* EXCLUDE (d, utc), try_cast(LatitudeMeasure AS DOUBLE) AS Latitude, try_cast(LongitudeMeasure AS DOUBLE) AS Longitude,
  coalesce(CAST({from_zone('UTC', 'utc')} AS DATE), d) AS Date, {from_zone('UTC', 'utc')} AS Datetime
FROM w LEFT JOIN cawsc_sites ON Station = MonitoringLocationIdentifier
""")

SF_WATER = ("Chlorophyll", "Salinity", "Temperature", "DissolvedOxygen", "DissolvedOxygenPercent")
SF_NUTRIENT = {"DissNitrateNitrite": 14.007, "DissAmmonia": 14.007, "DissOrthophos": 30.974, "DissSilica": 60.084}
SF_ALL = [*SF_WATER, *SF_NUTRIENT]
WATER_LIST = ", ".join(f"'{p}'" for p in SF_WATER)
survey("USGS_SFBS", "survey_usgs_sfbs", "sfbs", f"""
WITH u AS (SELECT 0 AS feed, * FROM sfbs_early UNION ALL BY NAME SELECT 1 AS feed, * FROM sfbs_published UNION ALL BY NAME SELECT 2 AS feed, * FROM sfbs_web),
p AS (SELECT *, CASE WHEN length(split_part(Date, '/', 3)) = 2 THEN try_strptime(Date, '%m/%d/%y')
  ELSE coalesce(try_strptime(Date, '%m/%d/%Y'), try_strptime(Date, '%Y-%m-%d')) END::DATE AS d, try_strptime(Time, '%H:%M') AS hm FROM u WHERE Date IS NOT NULL),
t AS (SELECT *, {local(at('d', 'hm'))} AS t FROM p),
long AS (SELECT * FROM (SELECT Station, d, t, Depth, feed, _row, unnest([{', '.join(f"'{c}'" for c in SF_ALL)}]) AS parameter,
  unnest([{', '.join(SF_ALL)}]) AS value FROM t) WHERE value IS NOT NULL),
b AS (SELECT *, {strict('min', 'Depth')} AS top, {strict('max', 'Depth')} AS deep FROM long WINDOW w AS (PARTITION BY d, Station, parameter)),
c AS (SELECT *, CASE WHEN parameter IN ({WATER_LIST}) AND Depth < 2 AND Depth = top THEN 'surface'
  WHEN parameter NOT IN ({WATER_LIST}) AND Depth < 5 AND Depth = top THEN 'nutrient'
  WHEN parameter IN ({WATER_LIST}) AND Depth > 2 AND Depth = deep THEN 'bottom' END AS bin FROM b),
e AS (SELECT *, count(*) OVER w AS n, {strict('min', 't')} AS first_t FROM c WHERE bin IS NOT NULL AND NOT (parameter = 'Chlorophyll' AND bin = 'bottom')
  WINDOW w AS (PARTITION BY d, Station, parameter, bin)),
k AS (SELECT * FROM e WHERE n = 1 OR t = first_t),
means AS (SELECT *, avg(Depth) OVER (PARTITION BY d, Station, bin) AS mean_depth,
  CASE WHEN count(*) OVER w = count(t) OVER w THEN make_timestamp((sum(epoch_us(t)) OVER w // count(*) OVER w)::BIGINT) END AS mean_t
  FROM k WINDOW w AS (PARTITION BY d, Station)),
firsts AS (SELECT * FROM means QUALIFY row_number() OVER (PARTITION BY d, Station, parameter, bin ORDER BY feed, _row) = 1),
water AS (SELECT d, Station, mean_t, max(mean_depth) FILTER (bin = 'surface') AS Sample_depth_surface, max(mean_depth) FILTER (bin = 'bottom') AS Sample_depth_bottom,
  """ + ", ".join(
    [f"max(value) FILTER (parameter = '{p}' AND bin = 'surface') AS {p}" for p in SF_WATER]
    + [f"max(value) FILTER (parameter = '{p}' AND bin = 'bottom') AS {p}_bottom" for p in SF_WATER[1:]]
) + """ FROM firsts WHERE bin <> 'nutrient' GROUP BY ALL),
nutrient AS (SELECT d, Station, mean_t, max(mean_depth) AS Sample_depth_nutr_surface, """ + ", ".join(
    f"max(value) FILTER (parameter = '{p}') * ({m} / 1000) AS {p}" for p, m in SF_NUTRIENT.items()
) + """ FROM firsts WHERE bin = 'nutrient' GROUP BY ALL),
j AS (SELECT coalesce(w.d, n.d) AS Date, coalesce(w.Station, n.Station) AS Station, coalesce(w.mean_t, n.mean_t) AS Datetime,
  w.* EXCLUDE (d, Station, mean_t), n.* EXCLUDE (d, Station, mean_t)
  FROM water w FULL JOIN nutrient n ON w.d IS NOT DISTINCT FROM n.d AND w.Station = n.Station AND w.mean_t IS NOT DISTINCT FROM n.mean_t)
SELECT 'USGS_SFBS' AS Source, Latitude, Longitude, j.* REPLACE (round(Sample_depth_surface, 9) AS Sample_depth_surface,
  round(Sample_depth_bottom, 9) AS Sample_depth_bottom, round(Sample_depth_nutr_surface, 9) AS Sample_depth_nutr_surface)
FROM j LEFT JOIN sfbs_stations s ON j.Station = s.Station
""", {"Sample_depth_surface": 9, "Sample_depth_bottom": 9, "Sample_depth_nutr_surface": 9})

NCRO_NAMES = {"Chlorophyll a": "Chlorophyll", "Dissolved Ammonia": "DissAmmonia", "Field Turbidity": "Turbidity", "Dissolved Calcium": "DissCalcium",
              "Field pH": "pH", "Field Water Temperature": "Temperature", "Field Specific Conductance": "Conductivity"}
NCRO_PLAIN = ("Temperature", "Conductivity", "DissolvedOxygen", "DissolvedOxygen_bottom", "pH", "TurbidityNTU", "TurbidityFNU")
NCRO_SIGNED = ("TotAlkalinity", "DissAmmonia", "DissBromide", "DissCalcium", "DissChloride", "Chlorophyll", "Pheophytin", "DissNitrateNitrite",
               "DOC", "TOC", "DON", "DissOrthophos", "TotPhos", "TSS", "VSS", "TKN", "TDS")
survey("NCRO", "survey_ncro", "ncro", f"""
WITH stations AS (SELECT s.StationNumber, StationName, coalesce(s.Latitude, p.latitude) AS Latitude, coalesce(s.Longitude, p.longitude) AS Longitude,
  WQES_StationCode, strptime(LastDate_NTU, '%m/%d/%Y')::DATE AS last_ntu, strptime(FirstDate_FNU, '%m/%d/%Y')::DATE AS first_fnu
  FROM ncro_stations s LEFT JOIN (SELECT * FROM ncro_portal_stations WHERE station_number IN (SELECT StationNumber FROM ncro_stations WHERE Latitude IS NULL)) p
  ON s.StationNumber = p.station_number),
u AS (SELECT 0 AS feed, * FROM ncro_requested UNION ALL SELECT 1, * FROM ncro_recent UNION ALL SELECT 2, * FROM ncro_laboratory UNION ALL SELECT 3, * FROM ncro_extra_field),
o AS (SELECT *, {coded('Analyte', NCRO_NAMES)} AS std, CASE WHEN Result LIKE '<%' THEN '<' ELSE '=' END AS sign,
  coalesce(try_strptime(CollectionDate, '%m/%d/%Y %H:%M'), try_strptime(CollectionDate, '%Y-%m-%d %H:%M:%S')) AS pst FROM u
  WHERE SampleType = 'Normal Sample' AND Result IS NOT NULL AND NOT regexp_matches(LongStationName, '^[(]')),
c1 AS (SELECT feed, _row, LongStationName, StationNumber AS n0, SampleCode, pst, {from_zone('Etc/GMT+8', 'pst')} AS t, std, sign, Notes,
  CASE WHEN std = 'DissCalcium' AND Units = 'ug/L' THEN v / 1000 ELSE v END AS value FROM (
  SELECT *, CASE WHEN sign = '<' THEN try_cast(RptLimit AS DOUBLE) WHEN regexp_matches(Result, '[A-Za-z]') THEN NULL ELSE try_cast(Result AS DOUBLE) END AS v FROM o)
  WHERE std IS NOT NULL AND v IS NOT NULL),
c2 AS (SELECT *, CASE WHEN n0 NOT IN ('(UserDefined)', '(NONE)') THEN n0 WHEN LongStationName = 'Holland Cut at Holland Marina' THEN 'B9D75841349'
  WHEN LongStationName = 'Middle River @ Undine Road' THEN 'B9D75011230'
  WHEN LongStationName = 'Old River near Bacon Island @ USGS Pile' AND n0 = '(UserDefined)' THEN 'B9D75811344'
  WHEN LongStationName = 'Old River near Bacon Island @ USGS Pile' THEN 'B9D75821343A' END AS number FROM c1),
c3 AS (SELECT c2.*, StationName AS name, CASE WHEN std = 'Turbidity' AND CAST(t AS DATE) <= last_ntu THEN 'TurbidityNTU'
  WHEN std = 'Turbidity' AND CAST(t AS DATE) >= first_fnu THEN 'TurbidityFNU' ELSE std END AS analyte, CAST(t AS DATE) AS d
  FROM c2 JOIN stations s ON number = s.StationNumber WHERE StationName IS NOT NULL),
c3n AS (SELECT *, count(*) OVER (PARTITION BY name, t, analyte) AS n FROM c3),
dups AS (SELECT * FROM c3n WHERE n > 1 AND (Notes IS NULL OR NOT regexp_matches(Notes, 'duplicate', 'i'))
  QUALIFY row_number() OVER (PARTITION BY name, t, analyte ORDER BY SampleCode, feed, _row) = 1),
c4 AS (SELECT * FROM c3n WHERE n = 1 UNION ALL SELECT * FROM dups),
c7 AS (SELECT *, CASE WHEN hour(t) IN (0, 1, 2) THEN t + INTERVAL 12 HOUR WHEN hour(t) = 3 THEN t + INTERVAL 4 HOUR ELSE t END AS t2 FROM c4
  WHERE SampleCode NOT IN (SELECT SampleCode FROM ncro_same_day WHERE KeepRecord = 'no')
  AND SampleCode NOT IN (SELECT SampleCode FROM ncro_questionable WHERE MeasVerified = 'Unknown')),
c8 AS (SELECT c7.*, q.SampleCode IS NOT NULL AS listed, CASE WHEN q.SampleCode IS NOT NULL THEN ResultVerified ELSE value END AS v2
  FROM c7 LEFT JOIN ncro_questionable q ON c7.SampleCode = q.SampleCode AND c7.analyte = q.Analyte),
k AS (SELECT * FROM c8 WHERE NOT listed OR v2 IS NOT NULL QUALIFY row_number() OVER (PARTITION BY name, number, t2, d, analyte ORDER BY feed, _row) = 1),
w AS (SELECT name, number, t2, d, """ + ", ".join(
    [f"max(v2) FILTER (analyte = '{a}') AS {a}" for a in (*NCRO_PLAIN, *NCRO_SIGNED)]
    + [f"coalesce(max(sign) FILTER (analyte = '{a}'), '=') AS {a}_Sign" for a in NCRO_SIGNED]
) + """ FROM k GROUP BY ALL),
hab AS (SELECT DISTINCT StationName, StationNumber, CAST(DeploymentEnd AS DATE) AS day, FldObsSecchi * 100 AS Secchi,
  CAST(CASE FldObsWaterHabs WHEN 'Not Visible' THEN 1 WHEN 'Absent' THEN 1 WHEN 'Low' THEN 2 WHEN 'Medium' THEN 3 WHEN 'High' THEN 4 WHEN 'Extreme' THEN 5 END AS DOUBLE) AS Microcystis
  FROM ncro_secchi JOIN stations ON StationCode = WQES_StationCode WHERE FldObsSecchi IS NOT NULL OR FldObsWaterHabs IS NOT NULL)
SELECT 'NCRO' AS Source, name AS Station, Latitude, Longitude, d AS Date, t2 AS Datetime, w.* EXCLUDE (name, number, t2, d), Secchi, Microcystis
FROM w LEFT JOIN hab ON name = hab.StationName AND number = hab.StationNumber AND d = day
LEFT JOIN stations s ON name = s.StationName AND number = s.StationNumber
""")
