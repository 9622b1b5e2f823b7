"""Two feeds of the same laboratory: the requested export and the public portal, made comparable."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemerge.functions.clock import parse
from tidemerge.functions.nulls import not_in, number
from tidemerge.functions.text import number_text, paste, recode
from tidemerge.functions.units import fahrenheit_to_celsius, ug_to_mg_per_l
from tidemerge.operators.audit import zero_as_censored
from tidemerge.operators.joins import lookup, within_period_of

# The portal's names of field analytes.
PORTAL_NAMES = {
    "(Bottom) DissolvedOxygen": "Field (Bottom) Dissolved Oxygen",
    "DissolvedOxygen": "Field Dissolved Oxygen",
    "SpecificConductance": "Field Specific Conductance",
    "WaterTemperature": "Field Water Temperature",
    "pH": "Field pH",
}
# Results that mean nothing was measured, and records that are no field measurements.
NOT_MEASURED = ("N.S.", "D1")
LABORATORY_ONLY = ("Dissolved Total Kjeldahl Nitrogen", "Specific Conductance")
LABORATORY_METHODS = ("Std Method 5910B (DWR Modified)",)
ABBREVIATIONS = {"Total Dissolved Solids": "TDS"}

KEY = ("SampleCode", "AnalyteAbbr")
COMPARED = ("StationName", "ShortStationName", "StationNumber", "DateTime", "Result", "ResultSign", "Depth")


def _used(df: DataFrame, analytes: DataFrame) -> DataFrame:
    """Records of the analytes marked for use, with their abbreviation."""
    used = analytes.filter(F.col("UseYN") == "Y").select("Analyte", F.col("Abbreviation").alias("AnalyteAbbr"))
    return df.join(used, "Analyte")


def prepare_requested(df: DataFrame, analytes: DataFrame, stations: DataFrame) -> DataFrame:
    """Normal samples of used analytes at named stations, censored results at their limit."""
    normal = df.filter((F.col("SampleType") == "Normal Sample") & ~F.col("StationName").rlike(r"^\("))
    sign = F.when(F.col("Result").rlike("^<"), "<").otherwise("=")
    value = F.when(F.col("Result").isin(*NOT_MEASURED), F.lit(None).cast("string")).when(
        F.col("ResultSign") == "<", F.col("RL")
    ).otherwise(F.col("Result"))
    timed = lookup(_used(normal, analytes), stations, ["StationName"]).withColumns(
        {"DateTime": parse(F.col("CollectionDate"), "M/d/yyyy H:m"), "ResultSign": sign}
    )
    return (
        timed.withColumns({"Date": F.col("DateTime").cast("date"), "Result": number(value)})
        .drop("SampleType", "CollectionDate")
        .dropna(subset=["Result"])
    )


def prepare_portal(df: DataFrame, analytes: DataFrame, requested: DataFrame) -> DataFrame:
    """Portal records under the requested feed's names and within its period; zero means censored."""
    named = _used(df.withColumn("Analyte", recode(F.col("Analyte"), PORTAL_NAMES)), analytes)
    shaped = named.withColumns(
        {
            "Date": F.col("DateTime").cast("date"),
            "Depth": paste(number_text(F.col("Depth")), F.col("DepthUnits")),
            "ShortStationName": F.trim("ShortStationName"),
            "Result": number(F.col("Result")),
            "RL": number(F.col("RL")),
        }
    )
    inside = within_period_of(shaped, requested, "Date").dropna(subset=["Result"])
    return zero_as_censored(inside, "Result", "RL").drop("RL", "DepthUnits")


def keep_field_measurements(df: DataFrame) -> DataFrame:
    """Leave out laboratory-only analytes and methods, and give dissolved solids their own abbreviation."""
    kept = df.filter(~F.col("Analyte").isin(*LABORATORY_ONLY))
    if "Method" in df.columns:
        kept = kept.filter(not_in(F.col("Method"), LABORATORY_METHODS))
    abbreviation = F.col("AnalyteAbbr")
    for analyte, short in ABBREVIATIONS.items():
        abbreviation = F.when(F.col("Analyte") == analyte, short).otherwise(abbreviation)
    return kept.withColumn("AnalyteAbbr", abbreviation)


def same_units(df: DataFrame) -> DataFrame:
    """Dissolved calcium in mg/L and water temperature in degrees Celsius, whatever was reported."""
    calcium = (F.col("Analyte") == "Dissolved Calcium") & (F.col("Units") == "ug/L")
    warm = (F.col("Analyte") == "Field Water Temperature") & F.col("Units").rlike("F$")
    result, units = F.col("Result"), F.col("Units")
    value = F.when(calcium, ug_to_mg_per_l(result, units)).when(warm, fahrenheit_to_celsius(result, units))
    return df.withColumns(
        {"Result": value.otherwise(result), "Units": F.when(calcium, "mg/L").when(warm, "C").otherwise(units)}
    )
