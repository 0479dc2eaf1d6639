"""Column functions: guarded transforms, text, time, hashing."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KM_PER_DEGREE = 111.19
_NUMBER = r"([-+]?[0-9.]+(?:[eE][-+]?[0-9]+)?)"
_POINT_Z = rf"^\s*POINT\s*Z?\s*\(\s*{_NUMBER}\s+{_NUMBER}\s+{_NUMBER}\s*\)\s*$"


def safe_log(x: Column) -> Column:
    return F.when(x > 0, F.log1p(x)).otherwise(x)


def safe_sqrt(x: Column) -> Column:
    return F.when(x > 0, F.sqrt(x)).otherwise(x)


def safe_cbrt(x: Column, positive_only: bool = False) -> Column:
    return F.when(x > 0 if positive_only else x != 0, F.cbrt(x)).otherwise(x)


def nan_to_null(x: Column) -> Column:
    return F.when(~F.isnan(x), x)


def degrees_to_km(x: Column) -> Column:
    return x * KM_PER_DEGREE


def epoch_millis(ms: Column) -> Column:
    """Epoch milliseconds to a zone-free timestamp."""
    return F.expr("timestamp_ntz'1970-01-01 00:00:00'") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), (ms.cast("decimal(20,0)") / F.lit(1000)).cast("decimal(18,6)")
    )


def micros(ts: Column) -> Column:
    """Microseconds since the epoch, without going through a time zone."""
    return F.timestamp_diff("MICROSECOND", F.expr("timestamp_ntz'1970-01-01 00:00:00'"), ts)


def seconds_between(later: Column, earlier: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", earlier, later) / F.lit(1e6)


def wkt_ordinate(geo: Column, i: int) -> Column:
    """Ordinate 0=lon, 1=lat, 2=elevation of a 3-D point; NULL for anything else."""
    return F.regexp_extract(geo, _POINT_Z, i + 1).try_cast("double")


def region_of(place: Column) -> Column:
    """Last comma-separated part; a leading blank is kept."""
    return F.element_at(F.split(place, ","), -1)


def magnitude_class(mag: Column) -> Column:
    return (
        F.when(mag >= 7, "7+").when(mag >= 6, "6-7").when(mag >= 5, "5-6").when(mag >= 4, "4-5").otherwise("<4")
    )


def numeric_text(value: Column) -> Column:
    """Number in a text value, NULL when it holds none."""
    return F.trim(value).try_cast("double")


def short_hash(value: Column, digits: int = 8) -> Column:
    return F.substring(F.sha2(value, 256), 1, digits)


def _turn(x: Column, period: float) -> Column:
    return F.lit(2 * math.pi) * x / F.lit(period)


def cyclic_time(df: DataFrame, time: str = "time", version: int = 2) -> DataFrame:
    """Sine/cosine of the calendar fields. Version 1 turns the day of the month
    by seven; version 2 turns the weekday (Monday = 0) and adds the year cycle."""
    t = F.col(time)
    cycles = {"hour": (F.hour(t), 24), "month": (F.month(t), 12)}
    if version == 1:
        cycles["day"] = (F.dayofmonth(t), 7)
    else:
        cycles["day"] = (F.weekday(t), 7)
        cycles["year"] = (F.dayofyear(t), 365.25)
    new = {}
    for name, (field, period) in cycles.items():
        new[f"{name}_sin"] = F.sin(_turn(field, period))
        new[f"{name}_cos"] = F.cos(_turn(field, period))
    new["day_of_year"], new["month"] = F.dayofyear(t), F.month(t)
    return df.withColumns(new)
