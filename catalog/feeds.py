"""Raw survey feeds seen in the given tables: wall-clock texts, codes, gaps and repeats by key."""

from catalog.core import VIEWS

_MONTH, _DAY = "month(o_orderdate)", "day(o_orderdate)"


def _year(shift: int) -> str:
    return f"(year(o_orderdate) + {shift})"


def mdy(shift: int = 0) -> str:
    return f"concat({_MONTH}, '/', {_DAY}, '/', {_year(shift)})"


def ymd(shift: int = 0) -> str:
    return (
        f"concat({_year(shift)}, '-', lpad(CAST({_MONTH} AS STRING), 2, '0'), '-', lpad(CAST({_DAY} AS STRING), 2, '0'))"
    )


def hm(hour: str, minute: str) -> str:
    return f"concat({hour}, ':', lpad(CAST({minute} AS STRING), 2, '0'))"


def gap(every: int, value: str, key: str = "o_orderkey") -> str:
    return f"CASE WHEN {key} % {every} = 0 THEN NULL ELSE {value} END"


def real(value: str) -> str:
    return f"CAST({value} AS DOUBLE)"


def midnight(text: str) -> str:
    return f"concat({text}, ' 0:00:00')"


CLOCK = hm("o_orderkey % 24", "o_custkey % 60")
DUMMY = f"concat('12/30/1899 ', {CLOCK}, ':00')"
STATION = "concat('ST', o_custkey % 120)"
DMS = """
  CAST(37 + s_suppkey % 2 AS DOUBLE) AS LatD, CAST(s_suppkey % 60 AS DOUBLE) AS LatM,
  CASE WHEN s_suppkey % 11 = 0 THEN NULL ELSE CAST(s_suppkey * 7 % 60 AS DOUBLE) END AS LatS,
  CAST(121 + s_suppkey % 2 AS DOUBLE) AS LonD, CAST(s_suppkey * 3 % 60 AS DOUBLE) AS LonM,
  CAST(s_suppkey * 13 % 60 AS DOUBLE) AS LonS
"""

# --- DJFMP
_DJFMP = f"""
SELECT {STATION} AS StationCode, {ymd(20)} AS SampleDate,
       {gap(9, f"concat({CLOCK}, ':30')")} AS SampleTime, o_totalprice / 100 AS SpecificConductance,
       {real('o_orderkey % 30')} AS WaterTemp, {gap(6, real('o_orderkey % 20') + ' / 10')} AS Secchi,
       {real('o_custkey % 12')} AS DO, o_orderkey AS _row
FROM {{orders}} WHERE o_orderkey % 2 = """
VIEWS["djfmp_trawl_early"] = _DJFMP + "0"
VIEWS["djfmp_trawl_late"] = _DJFMP + "1"
VIEWS["djfmp_sites"] = """
SELECT concat('ST', s_suppkey) AS StationCode, 37 + s_acctbal / 10000 AS Latitude, -121 - s_acctbal / 10000 AS Longitude,
       s_suppkey AS _row FROM {supplier}
"""
# --- DOP
VIEWS["dop_tow"] = f"""
SELECT {gap(41, ymd(20))} AS Date, 37 + {real('o_custkey % 100')} / 100 AS Latitude,
       -121 - {real('o_custkey % 100')} / 100 AS Longitude, concat('D', o_custkey % 30) AS Station_Code,
       CASE o_orderkey % 5 WHEN 0 THEN 'Channel Deep' WHEN 1 THEN 'Oblique' WHEN 2 THEN NULL WHEN 3 THEN 'Littoral'
            ELSE 'Channel Surface' END AS Habitat,
       {real('o_custkey % 3')} AS Conductivity, {gap(7, real('o_custkey % 2'))} AS Temperature, CAST(80 AS DOUBLE) AS Secchi,
       {gap(8, f"concat({CLOCK}, ':00')")} AS Start_Time, CAST(7.5 AS DOUBLE) AS pH, CAST(1 AS DOUBLE) AS Chl_a,
       {real('o_orderkey % 50')} AS Start_Depth, CAST(NULL AS DOUBLE) AS Salinity, CAST(3 AS DOUBLE) AS Turbidity,
       CAST(9 AS DOUBLE) AS DO, o_orderkey AS _row
FROM {{orders}}
"""
# --- EDSM
_EDSM = f"""
SELECT {{day}} AS SampleDate, 37 + {real('o_custkey % 5')} / 10 AS LatitudeStart,
       -121 - {real('o_custkey % 5')} / 10 AS LongitudeStart, concat('E', o_custkey % 10) AS StationCode,
       {real('o_orderkey % 9')} / 10 AS Secchi, {gap(10, f"concat({hm('o_orderkey % 3 + 8', 'o_custkey % 2')}, ':00')")} AS SampleTime,
       CASE o_orderkey % 4 WHEN 0 THEN 'HS' WHEN 1 THEN 'LS' WHEN 2 THEN 'Ebb' END AS Tide,
       {real('o_orderkey % 40')} AS BottomDepth, {gap(3, 'o_orderpriority')} AS Comments, o_orderkey AS _row, {{extra}}
FROM {{{{orders}}}} WHERE o_orderkey % 2 = {{part}}
"""
VIEWS["edsm_20mm"] = _EDSM.format(
    day=f"CASE WHEN o_orderkey % 4 = 0 THEN {ymd(20)} ELSE {mdy(20)} END", part=0,
    extra="o_totalprice AS SpecificConductanceTop, o_totalprice / 1000 AS WaterTempTop, o_totalprice / 2000 AS WaterTempBottom, "
    "CAST(8 AS DOUBLE) AS DOTop, CAST(7 AS DOUBLE) AS DOBottom",
)
VIEWS["edsm_kdtr"] = _EDSM.format(
    day=ymd(20), part=1,
    extra="o_totalprice AS SpecificConductance, o_totalprice / 1000 AS WaterTemp, CAST(6 AS DOUBLE) AS DO",
)
# --- FMWT
VIEWS["fmwt_sample"] = f"""
SELECT {STATION} AS StationCode, {midnight(mdy())} AS SampleDate, {gap(13, DUMMY)} AS SampleTimeStart,
       {gap(2, real('o_orderkey % 30'))} AS WaterTemperature, {gap(3, 'o_totalprice / 1000')} AS Turbidity,
       {gap(2, real('o_custkey % 9') + ' / 10')} AS Secchi, o_orderkey % 5 = 1 AS SecchiEstimated,
       {gap(2, 'o_totalprice')} AS ConductivityTop, {real('o_orderkey % 6')} AS ConductivityBottom,
       CAST(o_orderkey % 6 AS INT) AS TideCode, {real('o_orderkey % 45')} AS DepthBottom,
       {gap(2, real('o_orderkey % 7'))} AS Microcystis, {gap(2, real('o_custkey % 50'))} AS BottomTemperature,
       o_orderkey AS _row
FROM {{orders}}
"""
VIEWS["fmwt_stations"] = """
SELECT concat('ST', s_suppkey) AS StationCode, CASE WHEN s_suppkey % 9 = 0 THEN NULL ELSE 37 + s_acctbal / 10000 END AS DD_Latitude,
       -121 - s_acctbal / 10000 AS DD_Longitude FROM {supplier}
"""
# --- STN
VIEWS["stn_sample"] = f"""
SELECT CAST(o_orderkey AS INT) AS SampleRowID, {midnight(mdy())} AS SampleDate, {STATION} AS StationCode,
       {gap(2, real('o_orderkey % 30'))} AS TemperatureTop, {gap(2, real('o_orderkey % 25'))} AS TemperatureBottom,
       {gap(2, real('o_custkey % 90'))} AS Secchi, {gap(2, 'o_totalprice')} AS ConductivityTop,
       {gap(2, 'o_totalprice / 2')} AS ConductivityBottom, CAST(o_orderkey % 7 AS INT) AS TideCode,
       {real('o_orderkey % 45')} AS DepthBottom, {gap(4, 'o_orderpriority')} AS SampleComments,
       {gap(6, real('o_orderkey % 5'))} AS Microcystis, {gap(2, 'o_totalprice / 1000')} AS TurbidityTop
FROM {{orders}}
"""
VIEWS["stn_tow_effort"] = """
SELECT CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE CAST(l_orderkey AS INT) END AS SampleRowID,
       CASE WHEN l_partkey % 8 = 0 THEN NULL
            ELSE concat('12/30/1899 ', l_partkey % 24, ':', lpad(CAST(l_suppkey % 60 AS STRING), 2, '0'), ':00') END AS TimeStart
FROM {lineitem}
"""
VIEWS["stn_stations"] = f"SELECT concat('ST', s_suppkey) AS StationCodeSTN, {DMS} FROM {{supplier}}"
# --- SLS
VIEWS["sls_water_info"] = f"""
SELECT {midnight(mdy())} AS Date, concat(CASE WHEN o_orderkey % 2 = 0 THEN 'ST' ELSE 'W' END, o_custkey) AS Station,
       {real('o_orderkey % 30')} AS Temp, o_totalprice AS TopEC,
       {real('o_custkey % 90')} AS Secchi,
       CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'EC from CDEC gauge' ELSE 'calm' END AS Comments
FROM {{orders}}
"""
VIEWS["sls_tow_info"] = f"""
SELECT {midnight(mdy())} AS Date, concat(CASE WHEN o_orderkey % 3 = 0 THEN 'T' ELSE 'ST' END, o_custkey) AS Station, {gap(7, DUMMY)} AS Time, {gap(9, real('o_orderkey % 6'))} AS Tide,
       {real('o_orderkey % 45')} AS BottomDepth
FROM {{orders}}
"""
VIEWS["sls_stations"] = f"SELECT concat('ST', s_suppkey) AS Station, {DMS} FROM {{supplier}}"
# --- SKT
VIEWS["skt_sample"] = f"""
SELECT {midnight(mdy(17))} AS SampleDate, CASE WHEN o_orderkey % 10 = 0 THEN '519' ELSE {STATION} END AS StationCode,
       {gap(6, DUMMY)} AS SampleTimeStart, {real('o_custkey % 90')} AS Secchi, o_totalprice AS ConductivityTop,
       {real('o_orderkey % 30')} AS WaterTemperature, {real('o_orderkey % 45')} AS DepthBottom,
       CAST(o_orderkey % 7 AS INT) AS TideCode,
       CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'values from CDEC' ELSE 'calm' END AS SampleComments,
       CASE o_orderkey % 5 WHEN 0 THEN '0' WHEN 1 THEN concat('38-', o_custkey % 60, '-7.5"N') WHEN 2 THEN concat('38-', o_custkey % 60, 'N')
            WHEN 3 THEN NULL ELSE concat('38-', o_custkey % 60, '-', o_orderkey % 60, '''') END AS Latitude,
       CASE o_orderkey % 7 WHEN 0 THEN '121-29.41.7' ELSE concat('121-', o_custkey % 60, '-', o_orderkey % 60, 'W') END AS Longitude
FROM {{orders}}
"""
VIEWS["skt_stations"] = """
SELECT concat('ST', s_suppkey) AS Station, CAST(38 AS DOUBLE) AS LatDeg, CAST(s_suppkey % 60 AS DOUBLE) AS LatMin,
       CASE WHEN s_suppkey % 6 = 0 THEN NULL ELSE CAST(30 AS DOUBLE) END AS LatSec, CAST(121 AS DOUBLE) AS LongDec,
       CAST(s_suppkey * 3 % 60 AS DOUBLE) AS LongMin, CAST(15 AS DOUBLE) AS LongSec FROM {supplier}
"""
# --- USBR
VIEWS["usbr_profiles"] = """
SELECT CASE WHEN l_suppkey % 30 = 0 THEN 'Pro' ELSE CAST(l_suppkey % 30 AS STRING) END AS Station,
       concat(substr(CAST(l_shipdate AS STRING), 1, 10), ' ', lpad(CAST(6 + l_partkey % 12 AS STRING), 2, '0'), ':',
              lpad(CAST(l_orderkey % 60 AS STRING), 2, '0'), ':15') AS Datetime,
       CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE l_quantity / 5 END AS Depth_feet,
       CASE WHEN l_partkey % 17 = 0 THEN NULL ELSE CAST(l_partkey % 40 AS DOUBLE) END AS Temperature,
       l_extendedprice AS Conductivity, l_discount * 100 AS Chlorophyll, substr(CAST(l_shipdate AS STRING), 1, 10) AS Date
FROM {lineitem}
"""
VIEWS["usbr_sites"] = """
SELECT CASE WHEN s_suppkey = 0 THEN 'PS' WHEN s_suppkey % 9 = 4 THEN concat('other ', s_suppkey) ELSE concat('NL ', s_suppkey) END AS Station,
       38 + s_acctbal / 100000 AS Latitude, -121 - s_acctbal / 100000 AS Longitude, CAST(s_suppkey AS DOUBLE) AS Depth_m FROM {supplier}
"""
# --- EMP
_EMP = ["Pheophytin", "TotAlkalinity", "TotAmmonia", "DissAmmonia", "DissBromide", "DissCalcium", "TotChloride",
        "DissChloride", "DissNitrateNitrite", "DOC", "TOC", "DON", "TON", "DissOrthophos", "TotPhos", "DissSilica",
        "TDS", "TSS", "VSS", "TKN"]
_EMP_MEASURES = ["SpCndSurface", "SpCndBottom", "WTSurface", "WTBottom", "DOSurface", "DOBottom", "DOpercentSurface",
                 "DOpercentBottom", "TurbiditySurface_FNU", "TurbidityBottom_FNU", "TurbiditySurface_NTU",
                 "TurbidityBottom_NTU", "pHSurface", "pHBottom"]
VIEWS["emp_measures"] = f"""
SELECT {STATION} AS Station, {ymd()} AS Date, {gap(8, f"concat({CLOCK}, ':00')")} AS Time,
       {real('o_orderkey % 45')} AS Depth, {real('o_custkey % 90')} AS Secchi, {gap(3, real('o_orderkey % 11') + ' / 2')} AS Microcystis,
       {gap(4, 'o_orderpriority')} AS FieldNotes, '=' AS Chla_Sign, o_totalprice / 10000 AS Chla,
       {gap(5, real('o_custkey % 40') + ' / 100 + 37')} AS NorthLat, {gap(7, real('o_custkey % 40') + ' / 100 - 122')} AS WestLong,
       {', '.join(f"{gap(i + 2, real(f'o_orderkey % {i + 20}'))} AS {m}" for i, m in enumerate(_EMP_MEASURES))},
       {', '.join(f"CASE WHEN o_orderkey % {i + 2} = 0 THEN '<' ELSE '=' END AS {a}_Sign, {gap(i + 3, real(f'o_custkey % {i + 9}'))} AS {a}" for i, a in enumerate(_EMP))}
FROM {{orders}}
"""
VIEWS["emp_stations"] = """
SELECT concat('ST', s_suppkey) AS Station, CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE 37 + s_acctbal / 10000 END AS Latitude,
       -121 - s_acctbal / 10000 AS Longitude FROM {supplier}
"""
# --- SDO
VIEWS["sdo_wide"] = f"""
SELECT {mdy()} AS Date, CASE o_orderkey % 9 WHEN 0 THEN NULL WHEN 1 THEN '111'
         ELSE CAST((o_orderkey % 24) * 100 + o_custkey % 60 AS STRING) END AS Time, {STATION} AS StationID,
       {gap(2, real('o_orderkey % 30'))} AS WTSurface, {gap(2, real('o_orderkey % 25'))} AS WTBottom,
       {gap(2, 'o_totalprice')} AS SpCndSurface, {gap(2, 'o_totalprice / 2')} AS SpCndBottom,
       {gap(4, real('o_custkey % 90'))} AS Secchi,
       CASE o_orderkey % 4 WHEN 0 THEN 'present' WHEN 1 THEN 'absent' WHEN 2 THEN '2.5' ELSE '3' END AS Microcystis,
       {gap(2, real('o_orderkey % 12'))} AS DOSurface, {gap(2, real('o_orderkey % 11'))} AS DOBottom,
       {gap(2, real('o_orderkey % 8'))} AS pHSurface, {gap(2, real('o_orderkey % 7'))} AS pHBottom
FROM {{orders}}
"""
VIEWS["sdo_by_depth"] = """
SELECT CASE user_id % 6 WHEN 0 THEN 'Turning Basin' WHEN 1 THEN 'P8' WHEN 2 THEN 'Light 41' WHEN 3 THEN 'Light 43'
            WHEN 4 THEN 'Light 48' ELSE 'Light 50' END AS Description,
       CAST(ts AS DATE) AS Date, ts AS Time_PST,
       CAST(CASE event_id % 4 WHEN 0 THEN 1 WHEN 1 THEN 3 WHEN 2 THEN 6 ELSE 9 END AS DOUBLE) AS Depth_m,
       CASE WHEN user_id % 2 = 0 THEN NULL ELSE CAST(1 AS DOUBLE) END AS MC_Score, CAST(user_id % 5 AS DOUBLE) AS Secchi_cm,
       value AS Temperature, value * 2 AS Conductivity, CASE WHEN event_id % 8 = 0 THEN NULL ELSE value / 10 END AS DissolvedOxygen,
       value / 50 AS pH, event_id AS _row
FROM {events}
"""
VIEWS["sdo_sites"] = """
SELECT CASE s_suppkey WHEN 0 THEN 'tb' WHEN 1 THEN 'lt40' WHEN 2 THEN 'lt41' ELSE concat('ST', s_suppkey) END AS StationID,
       37 + s_acctbal / 10000 AS Latitude, -121 - s_acctbal / 10000 AS Longitude FROM {supplier}
"""
# --- 20mm
VIEWS["twentymm_stations"] = VIEWS["sls_stations"]
VIEWS["twentymm_visit"] = f"""
SELECT CAST(o_orderkey AS STRING) AS StationID, CAST(o_custkey AS STRING) AS SurveyID, {STATION} AS Station,
       {gap(5, 'CAST(38 AS DOUBLE)')} AS LatDeg, {real('o_custkey % 60')} AS LatMin, {real('o_orderkey % 60')} AS LatSec,
       CAST(121 AS DOUBLE) AS LonDeg, {real('o_custkey % 60')} AS LonMin, {gap(4, real('o_orderkey % 60'))} AS LonSec,
       {real('o_orderkey % 30')} AS Temp, o_totalprice AS TopEC, o_totalprice * 2 AS BottomEC, {real('o_custkey % 90')} AS Secchi,
       {gap(4, 'o_orderpriority')} AS Comments
FROM {{orders}}
"""
VIEWS["twentymm_survey"] = """
SELECT concat(CASE WHEN c_custkey % 10 = 9 THEN 'X' ELSE '' END, c_custkey) AS SurveyID,
       concat(1 + c_custkey % 12, '/', 1 + c_custkey % 28, '/', 1995 + c_custkey % 20, ' 0:00:00') AS SampleDate
FROM {customer}
"""
VIEWS["twentymm_tow"] = """
SELECT CAST(l_orderkey AS STRING) AS StationID,
       CASE WHEN l_partkey % 40 = 0 THEN NULL
            ELSE concat('12/30/1899 ', l_partkey % 4, ':', lpad(CAST(l_suppkey % 3 AS STRING), 2, '0'), ':00') END AS TowTime,
       CAST(l_linenumber AS DOUBLE) AS Tide, l_quantity AS BottomDepth,
       CASE WHEN l_suppkey % 37 = 0 THEN NULL ELSE CAST(l_partkey % 3 AS DOUBLE) END AS TowNum
FROM {lineitem}
"""
# --- Baystudy
VIEWS["baystudy_stations"] = """
SELECT CASE WHEN s_suppkey = 0 THEN '211E' WHEN s_suppkey = 1 THEN '211W' WHEN s_suppkey % 3 = 2 THEN concat('X', s_suppkey)
            ELSE CAST(s_suppkey AS STRING) END AS Station,
       concat('37°', s_suppkey % 60, '.25') AS Latitude, concat('-122°', s_suppkey * 3 % 60, '.5') AS Longitude
FROM {supplier}
"""
VIEWS["baystudy_tide_codes"] = """
SELECT CAST(r_regionkey + 1 AS INT) AS Tide,
       CASE r_regionkey WHEN 0 THEN 'Flood' WHEN 1 THEN 'Ebb' WHEN 2 THEN 'Low Slack' WHEN 3 THEN 'High Slack' END AS Description
FROM {region}
"""
_BAY_SURVEY = {every: f"CAST(CASE WHEN o_orderkey % {every} = 0 THEN o_custkey ELSE -1 - o_custkey END AS INT)" for every in (1, 3, 6)}


def _bay_visit(every: int = 1) -> str:
    """One order in ``every`` names the survey that its tow names."""
    return f"CAST(o_orderkey % 7 AS INT) AS Year, {_BAY_SURVEY[every]} AS Survey, CAST(o_orderkey % 60 AS STRING) AS Station"


VIEWS["baystudy_boat_station"] = f"""
SELECT {_bay_visit(3)}, {midnight(mdy(-8))} AS Date, {real('o_orderkey % 30')} AS Depth, {real('o_custkey % 90')} AS Secchi,
       CAST(o_orderkey % 6 AS INT) AS Tide
FROM {{orders}}
"""
VIEWS["baystudy_salin_temp"] = f"""
SELECT {_bay_visit(6)}, max(o_totalprice) AS ECSurf, min(o_totalprice) AS ECBott, CAST(max(o_orderkey % 30) AS DOUBLE) AS TempSurf,
       CAST(min(o_orderkey % 30) AS DOUBLE) AS TempBott
FROM {{orders}} GROUP BY CAST(o_orderkey % 7 AS INT), {_BAY_SURVEY[6]}, CAST(o_orderkey % 60 AS STRING)
"""
VIEWS["baystudy_boat_tow"] = f"""
SELECT {_bay_visit()}, {gap(30, DUMMY, 'o_custkey')} AS Time, CAST(o_orderkey % 5 AS INT) AS Tide,
       {gap(4, real('370000 + (o_orderkey % 60) * 100 + o_custkey % 60'))} AS StartLat,
       {gap(5, real('12200000 + (o_orderkey % 60) * 1000 + o_custkey % 60'))} AS StartLong, o_orderkey AS _row
FROM {{orders}}
"""
# --- Suisun
VIEWS["suisun_sample"] = f"""
SELECT CAST(o_orderkey AS STRING) AS SampleRowID, concat('ST', o_custkey % 7) AS StationCode, {midnight(mdy())} AS SampleDate,
       {gap(9, DUMMY)} AS SampleTime, {real('o_orderkey % 2')} + 18.5 AS WaterTemperature, CAST(25 AS DOUBLE) AS Secchi,
       {gap(3, real('o_custkey % 2') + ' * 100')} AS SpecificConductance, {real('o_custkey % 2')} * 90 AS ElecCond,
       CASE o_orderkey % 8 WHEN 0 THEN NULL WHEN 1 THEN 'flood' WHEN 2 THEN 'ebb' WHEN 3 THEN 'low' WHEN 4 THEN 'high'
            WHEN 5 THEN 'outgoing' WHEN 6 THEN 'incoming' ELSE 'slack' END AS TideCode,
       {gap(4, 'CAST(8.5 AS DOUBLE)')} AS DO, CAST(90 AS DOUBLE) AS PctSaturation, CAST(NULL AS DOUBLE) AS Salinity, o_orderkey AS _row
FROM {{orders}}
"""
VIEWS["suisun_depth"] = """
SELECT CAST(l_orderkey AS STRING) AS SampleRowID, CASE WHEN l_partkey % 3 = 0 THEN NULL ELSE l_quantity END AS Depth FROM {lineitem}
"""
VIEWS["suisun_stations"] = """
SELECT concat(CASE WHEN s_suppkey % 7 = 6 THEN 'X' ELSE 'ST' END, s_suppkey) AS StationCode, -121 - s_acctbal / 10000 AS x_WGS84,
       38 + s_acctbal / 100000 AS y_WGS84 FROM {supplier}
"""
# --- YBFMP
_YB = """concat('Y', user_id % 5) AS StationCode, CASE event_id % 4 WHEN 0 THEN 'High' WHEN 1 THEN 'Low' WHEN 2 THEN 'Flood' END AS Tide,
       CASE WHEN event_id % 6 = 0 THEN NULL ELSE CAST(event_id % 3 AS DOUBLE) + 10 END AS {t}, CASE WHEN event_id % 10 = 0 THEN NULL ELSE CAST(event_id % 2 AS DOUBLE) / 4 END AS Secchi,
       CAST(100 AS DOUBLE) AS Conductivity, CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(120 AS DOUBLE) END AS {c},
       CASE WHEN event_id % 5 = 0 THEN NULL ELSE CAST(1 AS DOUBLE) END AS {m}, CAST(NULL AS DOUBLE) AS DO, CAST(7 AS DOUBLE) AS pH,
       CASE WHEN event_id % 7 = 0 THEN 'turbid' END AS FieldComments, event_id AS _row"""
_YB_HOUR = "lpad(CAST(hour(ts) - hour(ts) % 4 AS STRING), 2, '0')"
VIEWS["ybfmp_zoop"] = f"""
SELECT substr(CAST(ts AS STRING), 1, 10) AS Date,
       CASE WHEN event_id % 50 = 0 THEN NULL ELSE concat(substr(CAST(ts AS STRING), 1, 10), ' ', {_YB_HOUR}, ':00:00') END AS Datetime,
       {_YB.format(t='WaterTemperature', c='SpCnd', m='MicrocystisVisualRank')} FROM {{events}} WHERE event_id % 3 <> 1
"""
VIEWS["ybfmp_fish"] = f"""
SELECT concat(month(ts), '/', day(ts), '/', year(ts), ' ', {_YB_HOUR}, ':00') AS Datetime,
       concat(month(ts), '/', day(ts), '/', year(ts)) AS SampleDate,
       {_YB.format(t='WaterTemp', c='SpecificConductance', m='MicrocystisRank')} FROM {{events}} WHERE event_id % 3 <> 2
"""
VIEWS["ybfmp_zoop_stations"] = """
SELECT concat(CASE WHEN n_nationkey % 5 > 2 THEN 'Z' ELSE 'Y' END, n_nationkey) AS StationCode, CAST(38.5 AS DOUBLE) AS Latitude,
       CAST(-121.5 AS DOUBLE) AS Longitude FROM {nation}
"""
VIEWS["ybfmp_fish_stations"] = """
SELECT concat(CASE WHEN n_nationkey % 5 > 3 THEN 'Z' ELSE 'Y' END, n_nationkey) AS StationCode, CAST(38.5 AS DOUBLE) AS Latitude,
       CAST(-121.5 AS DOUBLE) AS Longitude FROM {nation}
"""
# --- USGS_CAWSC
VIEWS["cawsc_results"] = f"""
SELECT concat('USGS-', o_custkey % 90) AS MonitoringLocationIdentifier, {ymd(20)} AS ActivityStartDate,
       {gap(9, f"concat({ymd(20)}, ' ', lpad(CAST(o_custkey % 2 * 4 AS STRING), 2, '0'), ':30:00')", 'o_custkey')} AS ActivityStartDateTime,
       CASE o_orderkey % 10 WHEN 0 THEN 'Ammonia and ammonium' WHEN 1 THEN 'Chlorophyll a'
            WHEN 2 THEN 'Inorganic nitrogen (nitrate and nitrite)' WHEN 3 THEN 'Organic carbon' WHEN 4 THEN 'Orthophosphate'
            WHEN 5 THEN 'Oxygen' WHEN 6 THEN 'pH' WHEN 7 THEN 'Temperature, water' WHEN 8 THEN 'Specific conductance'
            ELSE 'Barium' END AS CharacteristicName,
       {gap(4, 'o_totalprice / 1000')} AS ResultMeasureValue,
       CASE o_custkey % 3 WHEN 0 THEN 'Not Detected' WHEN 1 THEN NULL ELSE 'Present' END AS ResultDetectionConditionText,
       CASE o_custkey % 5 WHEN 0 THEN 'Estimated' WHEN 1 THEN NULL ELSE 'Actual' END AS ResultValueTypeName,
       {gap(2, 'CAST(0.01 AS DOUBLE)', 'o_custkey')} AS DetectionLimit,
       CASE o_custkey % 4 WHEN 0 THEN 'RED01' WHEN 1 THEN 'RED02' WHEN 2 THEN NULL ELSE 'SHC02' END AS Method, o_orderkey AS _row
FROM {{orders}}
"""
VIEWS["cawsc_sites"] = """
SELECT concat('USGS-', s_suppkey) AS MonitoringLocationIdentifier, CASE WHEN s_suppkey % 7 = 0 THEN 'unknown' ELSE '38.25' END AS LatitudeMeasure,
       concat('-121.', s_suppkey) AS LongitudeMeasure FROM {supplier}
"""
# --- USGS_SFBS
_SFBS = f"""
SELECT {{day}} AS Date, {gap(97, f"{hm('8 + o_orderkey % 4', 'o_custkey % 60')}")} AS Time, CAST(o_custkey % 12 AS STRING) AS Station,
       CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE {real('o_orderkey % 13')} / 2 END AS Depth,
       {gap(3, 'o_totalprice / 100000')} AS Chlorophyll, {gap(4, 'o_totalprice / 50000')} AS DissolvedOxygen,
       {gap(5, 'o_totalprice / 20000')} AS Salinity, {gap(6, 'o_totalprice / 30000')} AS Temperature,
       {gap(2, 'o_totalprice / 10000')} AS DissNitrateNitrite, {gap(3, 'o_totalprice / 9000')} AS DissAmmonia,
       {gap(5, 'o_totalprice / 8000')} AS DissOrthophos, {gap(7, 'o_totalprice / 7000')} AS DissSilica, o_orderkey AS _row{{extra}}
FROM {{{{orders}}}} WHERE {{where}}
"""
VIEWS["sfbs_early"] = _SFBS.format(
    day=f"CASE WHEN o_orderkey % 55 = 0 THEN NULL ELSE {mdy()} END", where="o_orderkey % 3 = 0", extra="")
VIEWS["sfbs_published"] = _SFBS.format(
    day=f"concat({_MONTH}, '/', {_DAY}, '/', lpad(CAST(year(o_orderdate) % 100 AS STRING), 2, '0'))", where="o_orderkey % 3 = 1", extra="")
VIEWS["sfbs_web"] = _SFBS.format(
    day=ymd(), where="o_orderkey % 3 = 2", extra=", o_totalprice / 4000 AS DissolvedOxygenPercent")
VIEWS["sfbs_stations"] = """
SELECT concat(CASE WHEN s_suppkey % 12 > 8 THEN 'X' ELSE '' END, s_suppkey) AS Station, 37 + s_acctbal / 10000 AS Latitude,
       -121 - s_acctbal / 10000 AS Longitude FROM {supplier}
"""
# --- NCRO
_ANALYTE_CASE = """CASE event_id % 9 WHEN 0 THEN 'Chlorophyll a' WHEN 1 THEN 'Dissolved Ammonia' WHEN 2 THEN 'Field Turbidity'
            WHEN 3 THEN 'Dissolved Calcium' WHEN 4 THEN 'Field pH' WHEN 5 THEN 'Field Water Temperature'
            WHEN 6 THEN 'Field Specific Conductance' WHEN 7 THEN 'Field Turbidity' ELSE 'Lead' END"""
_NCRO = f"""
SELECT CASE WHEN event_id % 13 = 0 THEN 'Duplicate, Normal' ELSE 'Normal Sample' END AS SampleType, {_ANALYTE_CASE} AS Analyte,
       CASE user_id % 10 WHEN 0 THEN 'Holland Cut at Holland Marina' WHEN 1 THEN 'Middle River @ Undine Road' WHEN 2 THEN '( None )'
            WHEN 3 THEN 'Old River near Bacon Island @ USGS Pile' ELSE concat('River ', user_id % 10) END AS LongStationName,
       CASE user_id % 10 WHEN 0 THEN '(UserDefined)' WHEN 1 THEN '(NONE)' WHEN 3 THEN CASE WHEN event_id % 2 = 0 THEN '(UserDefined)' ELSE '(NONE)' END
            WHEN 4 THEN '(NONE)' ELSE concat('N', user_id % 10) END AS StationNumber,
       concat('C', CAST(floor(event_id / 3) AS BIGINT)) AS SampleCode, {{day}} AS CollectionDate,
       CASE event_id % 17 WHEN 0 THEN concat('<', CAST(value AS STRING)) WHEN 1 THEN 'N.S.' WHEN 2 THEN NULL ELSE CAST(value AS STRING) END AS Result,
       '0.05' AS RptLimit, CASE WHEN event_id % 5 = 0 THEN 'ug/L' ELSE 'mg/L' END AS Units,
       CASE event_id % 11 WHEN 0 THEN 'Field Duplicate' WHEN 1 THEN 'dilution duplicate' WHEN 2 THEN 'ok' END AS Notes, event_id AS _row
FROM {{{{events}}}} WHERE event_id % 4 = {{part}}
"""
_EV_MDY = "concat(month(ts), '/', day(ts), '/', year(ts), ' ', hour(ts), ':00')"
_EV_YMD = "concat(substr(CAST(ts AS STRING), 1, 10), ' ', hour(ts), ':00:00')"
for _i, (_name, _text) in enumerate(
    [("requested", _EV_MDY), ("recent", _EV_YMD), ("laboratory", _EV_MDY), ("extra_field", _EV_YMD)]
):
    VIEWS[f"ncro_{_name}"] = _NCRO.format(day=_text, part=_i)
VIEWS["ncro_stations"] = """
SELECT CASE n_nationkey WHEN 0 THEN 'B9D75841349' WHEN 1 THEN 'B9D75011230' WHEN 2 THEN 'B9D75811344' WHEN 3 THEN 'B9D75821343A'
            ELSE concat('N', n_nationkey) END AS StationNumber,
       concat('Station ', n_nationkey) AS StationName,
       CASE WHEN n_nationkey % 2 = 0 THEN NULL ELSE CAST(37.5 AS DOUBLE) END AS Latitude,
       CASE WHEN n_nationkey % 2 = 0 THEN NULL ELSE CAST(-121.5 AS DOUBLE) END AS Longitude,
       CASE WHEN n_nationkey % 9 <> 8 THEN concat('W', n_nationkey) END AS WQES_StationCode,
       concat('1/', 1 + n_nationkey, '/2024') AS LastDate_NTU, concat('1/', 4 + n_nationkey, '/2024') AS FirstDate_FNU
FROM {nation}
"""
VIEWS["ncro_portal_stations"] = """
SELECT concat('N', n_nationkey) AS station_number, CAST(38 AS DOUBLE) AS latitude, CAST(-122 AS DOUBLE) AS longitude FROM {nation}
"""
VIEWS["ncro_secchi"] = """
SELECT concat(CASE WHEN event_type = 'signup' THEN 'W' ELSE 'V' END, user_id % 12) AS StationCode, CASE event_id % 7 WHEN 0 THEN 'Not Visible' WHEN 1 THEN 'Absent' WHEN 2 THEN 'Low'
            WHEN 3 THEN 'Medium' WHEN 4 THEN 'High' WHEN 5 THEN 'Extreme' END AS FldObsWaterHabs,
       CASE WHEN event_id % 2 = 0 THEN NULL ELSE CAST(event_id % 3 AS DOUBLE) / 2 END AS FldObsSecchi, ts AS DeploymentEnd
FROM {events}
"""
VIEWS["ncro_same_day"] = """
SELECT concat('C', event_id) AS SampleCode, CASE WHEN event_type = 'click' AND event_id % 5 = 0 THEN 'no' ELSE 'yes' END AS KeepRecord FROM {events}
"""
VIEWS["ncro_questionable"] = """
SELECT concat(CASE WHEN event_type = 'view' THEN 'C' ELSE 'Q' END, event_id) AS SampleCode, CASE event_id % 3 WHEN 0 THEN 'pH' WHEN 1 THEN 'Temperature' ELSE 'Conductivity' END AS Analyte,
       CASE event_id % 4 WHEN 0 THEN 'Unknown' WHEN 1 THEN 'Yes' ELSE 'No' END AS MeasVerified,
       CASE WHEN event_id % 6 = 1 THEN NULL ELSE value * 3 END AS ResultVerified
FROM {events}
"""
