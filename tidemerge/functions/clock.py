"""Dates and wall-clock times.

All times are ``timestamp_ntz``: the local California wall clock. Nothing here
depends on the session time zone, except that parsing goes through a zoned
timestamp and back, which is the identity for every time that exists.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOCAL_ZONE = "America/Los_Angeles"
PST = "Etc/GMT+8"
UTC = "UTC"


def shape(fmt: str) -> str:
    """A pattern of the texts a format can read, digits only: cheaper to test than a failed parse."""
    def digits(run: str) -> str:
        return r"\d{1,2}" if len(run) == 1 else rf"\d{{{len(run)}}}"

    runs = re.findall(r"([a-zA-Z])(\1*)|([^a-zA-Z]+)", fmt)
    return "^" + "".join(re.escape(other) if other else digits(first + rest) for first, rest, other in runs) + "$"


#: Formats whose texts, where they have exactly their shape, a cast reads alike and faster.
_CAST_TOO = re.compile(r"yyyy-MM-dd( HH?:mm:ss)?")


def _read(col: Column, fmt: str) -> Column:
    return F.try_to_timestamp(col, F.lit(fmt)).cast("timestamp_ntz")


def _read_alone(col: Column, fmt: str) -> Column:
    """As ``_read``, at less cost for texts not known to have the format's shape.

    A text without the format's marks, such as a day without its time, has to fail, and a failed
    parse costs twice a good one.
    """
    marks = [col.contains(m) for m in sorted(set(re.findall("[-/: ]", fmt)))]
    read = F.when(reduce(lambda a, b: a & b, marks, F.lit(True)), _read(col, fmt))
    if not _CAST_TOO.fullmatch(fmt):
        return read
    exact = col.rlike("^(?!0000)" + shape(fmt)[1:-1] + r"\z")
    return F.coalesce(F.when(exact, col).try_cast("timestamp_ntz"), read)


def parse(col: Column, *formats: str) -> Column:
    """First format that fits, as wall-clock time; NULL when none does."""
    if len(formats) == 1:
        return _read_alone(col, formats[0])
    fitting = F.when(col.rlike(shape(formats[0])), _read(col, formats[0]))
    for fmt in formats[1:]:
        fitting = fitting.when(col.rlike(shape(fmt)), _read(col, fmt))
    return fitting


def parse_date(col: Column, *formats: str) -> Column:
    return parse(col, *formats).cast("date")


def whole_year(col: Column) -> Column:
    """Text such as ``3/7/98`` with four year digits: 69-99 are 19xx, 00-68 are 20xx."""
    late = F.regexp_replace(col, r"^(\d+/\d+)/(69|[789]\d)$", "$1/19$2")
    return F.regexp_replace(late, r"^(\d+/\d+)/(\d\d)$", "$1/20$2")


def at(day: Column, time: Column, *, seconds: bool = False) -> Column:
    """The date of ``day`` with the hour and minute of ``time``; NULL if either is NULL."""
    secs = F.second(time) if seconds else F.lit(0)
    return F.make_timestamp_ntz(
        F.year(day), F.month(day), F.dayofmonth(day), F.hour(time), F.minute(time), secs
    )


def to_local(col: Column, zone: str) -> Column:
    """Wall clock of ``zone`` to the local California wall clock."""
    return F.convert_timezone(F.lit(zone), F.lit(LOCAL_ZONE), col)


def existing_local(col: Column) -> Column:
    """NULL for wall-clock times that daylight saving skips, which all lie past two o'clock."""
    there = F.convert_timezone(F.lit(LOCAL_ZONE), F.lit(UTC), col)
    back = F.convert_timezone(F.lit(UTC), F.lit(LOCAL_ZONE), there)
    return F.when((F.hour(col) != 2) | (back == col), col)


def add_local_time(df: DataFrame, day: Column, time: Column) -> DataFrame:
    """Add Date and Datetime from a day and a time of day, in steps so that each text is read once."""
    df = df.withColumns({"_time": time, "Date": day}).withColumn("Datetime", at(F.col("Date"), F.col("_time")))
    return df.withColumns({"Datetime": existing_local(F.col("Datetime")), "Date": F.col("Date").cast("date")}).drop("_time")


def add_local_stamp(df: DataFrame, stamp: Column) -> DataFrame:
    """Add Datetime read from one text."""
    return df.withColumn("Datetime", stamp).withColumn("Datetime", existing_local(F.col("Datetime")))


def add_hours(col: Column, hours: int) -> Column:
    return col + F.expr(f"INTERVAL {hours} HOURS")


def micros(col: Column) -> Column:
    """Microseconds since 1970 of a wall-clock time, free of any zone."""
    return (
        F.unix_date(col.cast("date")).cast("bigint") * 86_400_000_000
        + F.hour(col).cast("bigint") * 3_600_000_000
        + F.minute(col).cast("bigint") * 60_000_000
        + (F.extract(F.lit("SECOND"), col) * 1_000_000).cast("bigint")
    )


def from_micros(col: Column) -> Column:
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", col, epoch)


def exact_sum(col: Column) -> Column:
    """Sum of whole numbers that cannot overflow a 64-bit total."""
    return F.sum(col.cast("decimal(20,0)"))


def whole_ratio(total: Column, n: Column) -> Column:
    """Whole part of ``total / n`` for wide totals; NULL where ``n`` is zero."""
    return F.floor(F.try_divide(total.cast("decimal(30,0)"), n.cast("decimal(19,0)"))).cast("bigint")


def mean_time(col: Column) -> Column:
    """Aggregate: mean wall-clock time of the non-NULL members, to the microsecond."""
    m = micros(col)
    return from_micros(whole_ratio(exact_sum(m), F.count(m)))


def midpoint(first: Column, last: Column) -> Column:
    a, b = micros(first), micros(last)
    return from_micros(a + F.floor((b - a) / 2).cast("bigint"))


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def season(month: Column) -> Column:
    return (
        F.when(month.isin(12, 1, 2), "Winter")
        .when(month.isin(3, 4, 5), "Spring")
        .when(month.isin(6, 7, 8), "Summer")
        .when(month.isin(9, 10, 11), "Fall")
    )
