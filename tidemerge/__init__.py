"""tidemerge: integrate discrete field-survey observations with Spark DataFrames."""

from tidemerge.plans.integrate import SOURCES, integrate, integrated

__all__ = ["SOURCES", "integrate", "integrated"]
