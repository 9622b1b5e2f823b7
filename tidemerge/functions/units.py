"""Unit conversions, specific conductance and practical salinity, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Conversion factors and molar masses (g/mol).
METRES_PER_FOOT = 0.3048
MOLAR_MASS_N = 14.007
MOLAR_MASS_P = 30.974
MOLAR_MASS_SIO2 = 60.084

# Practical salinity scale 1978 (UNESCO Technical Papers in Marine Science 44).
PSS_RT = (0.6766097, 0.0200564, 1.104259e-4, -6.9698e-7, 1.0031e-9)
PSS_A = (0.0080, -0.1692, 25.3851, 14.0941, -7.0261, 2.7081)
PSS_B = (0.0005, -0.0056, -0.0066, -0.0375, 0.0636, -0.0144)
PSS_REFERENCE_CONDUCTIVITY = 42.914


def feet_to_metres(col: Column) -> Column:
    return col * METRES_PER_FOOT


def metres_to_centimetres(col: Column) -> Column:
    return col * 100


def micromolar_to_mg_per_l(col: Column, molar_mass: float) -> Column:
    return col * (molar_mass / 1000)


def ug_to_mg_per_l(value: Column, units: Column) -> Column:
    return F.when(units == "ug/L", value / 1000).otherwise(value)


def fahrenheit_to_celsius(value: Column, units: Column) -> Column:
    return F.when(units.rlike("F$"), (value - 32) * 5 / 9).otherwise(value)


def specific_conductance(measured: Column, electrical: Column, temperature: Column) -> Column:
    """The measured value, else electrical conductivity corrected to 25 degrees."""
    corrected = F.try_divide(electrical, 1 + 0.019 * (temperature - 25))
    return F.coalesce(measured, corrected)


def add_practical_salinity(
    df: DataFrame, conductivity: Column, name: str, temperature: float = 25.0
) -> DataFrame:
    """Add the practical salinity of a conductivity in mS/cm at the surface.

    Below salinity 2 the low-salinity extension of Hill, Dauphinee and Woods
    (1986) applies. NULL or negative conductivity gives NULL. The steps are
    columns of their own, so that no step is computed twice.
    """
    t = temperature
    rt = sum(c * t**i for i, c in enumerate(PSS_RT))
    ft = (t - 15) / (1 + 0.0162 * (t - 15))
    # the two series share their powers of the root, and ft is a constant
    weights = [a + ft * b for a, b in zip(PSS_A, PSS_B)]
    ratio, root, full = (F.col(f"_{name}_{step}") for step in ("ratio", "root", "full"))
    total = F.lit(weights[-1])
    for w in reversed(weights[:-1]):
        total = total * root + w
    x, y = 400 * ratio, 100 * ratio
    # the square root of 100 times the ratio is ten times the root
    fresh = PSS_A[0] / (1 + 1.5 * x + x * x) + PSS_B[0] * ft / (1 + 10 * root + y + y * 10 * root)
    steps = df.withColumn(
        f"_{name}_ratio", F.when(conductivity >= 0, conductivity / (PSS_REFERENCE_CONDUCTIVITY * rt))
    )
    steps = steps.withColumn(f"_{name}_root", F.sqrt(ratio)).withColumn(f"_{name}_full", total)
    return steps.withColumn(name, full - F.when(full < 2, fresh).otherwise(0.0)).drop(
        f"_{name}_ratio", f"_{name}_root", f"_{name}_full"
    )
