"""USGS San Francisco Bay profiles: three vintages, surface, bottom and nutrient samples per day."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemerge.functions.clock import (
    add_local_time, exact_sum, from_micros, micros, parse, parse_date, whole_ratio, whole_year,
)
from tidemerge.functions.nulls import number
from tidemerge.functions.text import number_text
from tidemerge.functions.units import MOLAR_MASS_N, MOLAR_MASS_P, MOLAR_MASS_SIO2, micromolar_to_mg_per_l
from tidemerge.operators.depth import BIN, bin_by_parameter
from tidemerge.operators.dedup import ROW
from tidemerge.operators.joins import lookup
from tidemerge.operators.reshape import Part, pick_header, pivot_parts, stack, wide_to_long
from tidemerge.sources.registry import Feeds

# Measured parameters, molar masses, depth limits in metres.
WATER = ("Chlorophyll", "Salinity", "Temperature", "DissolvedOxygen", "DissolvedOxygenPercent")
NUTRIENTS = {
    "DissNitrateNitrite": MOLAR_MASS_N,
    "DissAmmonia": MOLAR_MASS_N,
    "DissOrthophos": MOLAR_MASS_P,
    "DissSilica": MOLAR_MASS_SIO2,
}
WATER_LIMIT, NUTRIENT_LIMIT = 2, 5
# Fixed value: where the published vintage keeps its oxygen, which its yearly files name differently.
OXYGEN_HEADER = "^Oxygen|Calculated_Oxygen"

_TIMED = {"Date": "string", "Time": "string", "Station": "string", "Depth": "double"}
_MEASURES = {p: "double" for p in (*WATER, *NUTRIENTS) if p != "DissolvedOxygenPercent"}
FEEDS = {
    "early": {**_TIMED, **_MEASURES},
    "published": {**_TIMED, **_MEASURES},
    "web": {**_TIMED, **_MEASURES, "DissolvedOxygenPercent": "double"},
    "stations": {"Station": "string", "Latitude": "double", "Longitude": "double"},
}
# Headers of the raw files. Those of the published vintage differ by year, see shape_published_file.
HEADERS = {
    "early": {
        "Discrete DO": "DissolvedOxygen", "Calculated Chl-a": "Chlorophyll", "NO32": "DissNitrateNitrite",
        "NH4": "DissAmmonia", "PO4": "DissOrthophos", "Si": "DissSilica",
    },
    "web": {
        "Depth (m)": "Depth", "Calculated Chlorophyll-a (micrograms/L)": "Chlorophyll",
        "Oxygen (mg/L)": "DissolvedOxygen", "Oxygen % Saturation": "DissolvedOxygenPercent",
        "Temperature (Degrees Celsius)": "Temperature", "NO32 (Micromolar)": "DissNitrateNitrite",
        "NH4 (Micromolar)": "DissAmmonia", "PO4 (Micromolar)": "DissOrthophos", "Si (Micromolar)": "DissSilica",
    },
    "stations": {"Latitude degree": "Latitude", "Longitude degree": "Longitude"},
}
DAY = ["Date", "Station"]
SAMPLE = [*DAY, "Parameter", BIN]


def shape_published_file(file: DataFrame) -> DataFrame:
    """Files of one header of the published vintage under shared names; times read ``HHmm``."""
    if "Station_Number" not in file.columns:
        return file
    names = {
        "Station_Number": "Station", "Calculated_Chlorophyll": "Chlorophyll",
        "Nitrate_+_Nitrite": "DissNitrateNitrite", "Ammonium": "DissAmmonia", "Phosphate": "DissOrthophos",
        "Silicate": "DissSilica", pick_header(file, OXYGEN_HEADER): "DissolvedOxygen",
    }
    time = F.concat(F.expr("left(Time, length(Time) - 2)"), F.lit(":"), F.right("Time", F.lit(2)))
    shared = {new: old for old, new in names.items()}
    return file.select(*[F.col(f"`{shared.get(c, c)}`").alias(c) for c in FEEDS["published"]], ROW).withColumn("Time", time)


SHAPES = {"published": shape_published_file}


def shape_published(files: Sequence[DataFrame]) -> DataFrame:
    """Yearly files of the published vintage under shared names."""
    return stack([shape_published_file(f) for f in files])


def _station_text(col: Column) -> Column:
    """Station numbers without a trailing ``.0``."""
    return F.coalesce(number_text(number(col)), col)


def first_of_day(binned: DataFrame) -> DataFrame:
    """Repeated samples of a day, parameter and bin reduced to the first time.

    A single sample stays even without a time; a repeated one whose times are
    not all known leaves. Each kept sample carries the number of rows and the
    depth and time totals at that time, so that means can be taken later.
    """
    by_time = binned.groupBy(*SAMPLE, "Datetime").agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum("Sample_depth").alias("_depth"),
        F.min_by("Value", ROW).alias("Value"),
    )
    # every value beside a time as a number: buffers of fixed size, which are hashed and not sorted
    known = F.coalesce(micros(F.col("Datetime")), F.lit(2**63 - 1))
    found = by_time.groupBy(*SAMPLE).agg(
        F.sum("_n").alias("_all"),
        F.count_if(F.col("Datetime").isNull()).alias("_untimed"),
        *[F.min_by(c, known).alias(c) for c in ("Datetime", "_n", "_depth", "Value")],
    )
    return found.filter("_all = 1 OR _untimed = 0").drop("_all", "_untimed")


def clean(feeds: Feeds, hot_rows: int | None = None) -> DataFrame:
    day = parse_date(F.col("Date"), "M/d/yyyy", "yyyy-MM-dd")
    rows = stack([feeds["early"], feeds["published"], feeds["web"]]).filter(F.col("Date").isNotNull())
    rows = rows.withColumn("Date", whole_year(F.col("Date")))
    rows = add_local_time(rows, day, parse(F.col("Time"), "H:m")).withColumns(
        {"Station": _station_text(F.col("Station")), "Sample_depth": F.col("Depth")}
    )
    ids = [*DAY, "Datetime", "Sample_depth", ROW]
    long = wide_to_long(rows.select(*ids, *WATER, *NUTRIENTS), ids, [*WATER, *NUTRIENTS])
    binned = bin_by_parameter(
        long, DAY, "Parameter", "Sample_depth", WATER, list(NUTRIENTS),
        water_limit=WATER_LIMIT, nutrient_limit=NUTRIENT_LIMIT, surface_only=["Chlorophyll"], hot_rows=hot_rows,
    )
    samples = first_of_day(binned)
    when = micros(F.col("Datetime"))

    def part(of_bin: str, depth: str, names: Sequence[str], template: str, after: Mapping[str, Callable[[Column], Column]] | None = None) -> Part:
        """Samples of one bin, with the mean depth of the rows that went into them."""
        return Part(
            F.col(BIN) == of_bin, "Parameter", names, {template: "Value"},
            ids={depth: lambda mine: F.try_divide(F.sum(mine("_depth")), F.sum(mine("_n")))}, after=after or {},
        )

    timed = F.when(F.count("Datetime") == F.count(F.lit(1)), exact_sum(when * F.col("_n")))
    in_mg_per_l = {p: lambda c, mass=mass: micromolar_to_mg_per_l(c, mass) for p, mass in NUTRIENTS.items()}
    wide = pivot_parts(
        samples, DAY,
        [
            part("surface", "Sample_depth_surface", WATER, "{name}"),
            part("bottom", "Sample_depth_bottom", [p for p in WATER if p != "Chlorophyll"], "{name}_bottom"),
            part("nutrient", "Sample_depth_nutr_surface", list(NUTRIENTS), "{name}", in_mg_per_l),
        ],
        Datetime=from_micros(whole_ratio(timed, F.sum("_n"))),
    )
    return lookup(wide, feeds["stations"].drop(ROW), ["Station"]).select(
        F.lit("USGS_SFBS").alias("Source"), "Station", "Latitude", "Longitude", "Date", "Datetime",
        "Sample_depth_surface", "Sample_depth_bottom", "Temperature", "Temperature_bottom", "Salinity",
        "Salinity_bottom", "Chlorophyll", "DissolvedOxygen", "DissolvedOxygen_bottom", "DissolvedOxygenPercent",
        "DissolvedOxygenPercent_bottom", "Sample_depth_nutr_surface", *NUTRIENTS,
    )
