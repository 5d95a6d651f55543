"""Column-level helpers (``Column... -> Column``), all built-in Spark expressions."""
from kerbside.functions.keys import date_key, hour_key, surrogate_key, trip_key
from kerbside.functions.temporal import (
    elapsed_minutes,
    iso_weekday,
    month_text,
    parse_weather_time,
    trunc_hour,
)
from kerbside.functions.numeric import exact_avg, exact_sum

__all__ = [
    "date_key", "hour_key", "surrogate_key", "trip_key",
    "elapsed_minutes", "iso_weekday", "month_text", "parse_weather_time", "trunc_hour",
    "exact_avg", "exact_sum",
]
