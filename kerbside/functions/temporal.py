"""Time helpers.  Every result stays zone-less (TIMESTAMP_NTZ / DATE)."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: text layout of the hourly weather feed, e.g. 2024-01-01T13:00.
WEATHER_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trunc_hour(ts: Column | str) -> Column:
    """``date_trunc('hour', ts)`` kept as TIMESTAMP_NTZ.

    Spark's ``date_trunc`` returns a zoned timestamp even for NTZ input; with
    the session pinned to UTC the cast back is exact.
    """
    return F.date_trunc("hour", _col(ts)).cast("timestamp_ntz")


def elapsed_minutes(start: Column | str, end: Column | str) -> Column:
    """Whole elapsed minutes from ``start`` to ``end`` (truncating, bigint)."""
    return F.timestamp_diff("MINUTE", _col(start), _col(end))


def iso_weekday(d: Column | str) -> Column:
    """ISO day of week, Monday = 1 .. Sunday = 7."""
    return (F.weekday(_col(d)) + F.lit(1)).cast("int")


def month_text(ts: Column | str) -> Column:
    """``YYYY-MM`` of a timestamp, the form of the ``_source_month`` lineage column."""
    return F.date_format(_col(ts), "yyyy-MM")


def parse_weather_time(text: Column | str) -> Column:
    """Parse ``YYYY-MM-DDTHH:MM`` weather text to TIMESTAMP_NTZ (raises on junk under ANSI)."""
    return F.to_timestamp_ntz(_col(text), F.lit(WEATHER_TIME_FORMAT))
