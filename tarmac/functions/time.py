"""Date and time expressions. Results do not depend on the session time zone unless stated."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def timestamp_lit(value: dt.datetime) -> Column:
    """A zone-free timestamp literal."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def date_lit(value: dt.date) -> Column:
    return F.lit(value.isoformat()).cast("date")


def micros_between(start: Column, end: Column) -> Column:
    """Whole microseconds from ``start`` to ``end`` (zone-free timestamps)."""
    return ((end - start).cast("decimal(20,6)") * F.lit(1_000_000)).cast("bigint")


def hours_between(start: Column, end: Column) -> Column:
    return micros_between(start, end) / F.lit(3.6e9)


def seconds_between(start: Column, end: Column) -> Column:
    return micros_between(start, end) / F.lit(1e6)


def parse_instant(text: Column) -> Column:
    """ISO 8601 text with an offset -> zone-free timestamp holding the UTC clock reading."""
    micros = F.unix_micros(F.try_to_timestamp(text))
    seconds = (micros.cast("decimal(20,0)") / F.lit(1_000_000)).cast("decimal(18,6)")
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)


def iso_seconds(ts: Column) -> Column:
    """``2025-01-02T03:04:05+00:00`` for a timestamp that holds a UTC clock reading."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


def iso_micros(ts: Column) -> Column:
    """``2025-01-02T03:04:05.250000+00:00``, always with six fraction digits."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def iso_instant(ts: Column) -> Column:
    """Like ``iso_micros`` but without the fraction when it is zero."""
    return F.when(ts == F.date_trunc("second", ts).cast("timestamp_ntz"), iso_seconds(ts)).otherwise(iso_micros(ts))


def add_millis(ts: Column, millis: int) -> Column:
    return ts + F.make_dt_interval(secs=F.lit(millis / 1000).cast("decimal(18,6)"))


# -- ages -----------------------------------------------------------------------------------------
# An age is first a count of whole months plus left-over days. A band limit of N years is compared
# with months of 30 days, so somebody can be 24 years old and already lie in the band above.


def _months_and_days(earlier: Column, later: Column) -> tuple[Column, Column]:
    day_gap = F.dayofmonth(later) - F.dayofmonth(earlier)
    months = (F.year(later) - F.year(earlier)) * 12 + F.month(later) - F.month(earlier)
    short = day_gap < 0
    days_in_month = F.dayofmonth(F.last_day(earlier))
    return F.when(short, months - 1).otherwise(months), F.when(short, day_gap + days_in_month).otherwise(day_gap)


def age_years(born: Column, as_of: Column) -> Column:
    """Whole years lived at ``as_of``; negative for a birth date after it; NULL stays NULL."""
    lived, _ = _months_and_days(born, as_of)
    ahead, _ = _months_and_days(as_of, born)
    years = F.when(born <= as_of, F.floor(lived / 12)).otherwise(-F.floor(ahead / 12))
    return F.when(born.isNotNull() & as_of.isNotNull(), years).cast("int")


# Band limits in years and their labels.
AGE_BANDS = ((25, "18-24"), (35, "25-34"), (45, "35-44"), (55, "45-54"))
AGE_BAND_ABOVE = "55+"
AGE_BAND_UNKNOWN = "unknown"


def age_band(born: Column, as_of: Column) -> Column:
    months, days = _months_and_days(born, as_of)
    lived_days = F.when(born <= as_of, months * 30 + days).otherwise(F.lit(0))
    band = F.when(born.isNull(), F.lit(AGE_BAND_UNKNOWN))
    for years, label in AGE_BANDS:
        band = band.when(lived_days < years * 360, F.lit(label))
    return band.otherwise(F.lit(AGE_BAND_ABOVE))
