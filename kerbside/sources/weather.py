"""Hourly weather payloads -> one row per hour.

A payload is one JSON object whose ``hourly`` member holds parallel arrays
(``time[]``, ``temperature_2m[]`` ...).  The reader schema types the arrays and
``inline(arrays_zip(...))`` turns position ``i`` of every array into row ``i``
on the executors -- no driver-side unpacking.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.functions.temporal import parse_weather_time
from kerbside.schemas import WEATHER_PAYLOAD
from kerbside.sources.trips import check_month, landed_paths

# The hourly variables pulled for the single city coordinate,
# in local wall-clock time.
HOURLY_VARIABLES = ("temperature_2m", "precipitation", "wind_speed_10m", "weather_code")
DEFAULT_LATITUDE = 40.7128
DEFAULT_LONGITUDE = -74.0060
LOCAL_TIME_ZONE = "America/New_York"
FILE_PATTERN = r"weather_(\d{4}-\d{2})\.json(?:/|$)"


def month_bounds_columns(month: Column | str) -> tuple[Column, Column]:
    """First and last day, as DATE, of a ``YYYY-MM`` column."""
    m = F.col(month) if isinstance(month, str) else month
    first = F.to_date(F.concat(m, F.lit("-01")))
    return first, F.last_day(first)


def weather_file_path(root: str, month: str) -> str:
    return f"{root.rstrip('/')}/weather_{check_month(month)}.json"


def unpack_hourly(payloads: DataFrame, month: Column) -> DataFrame:
    """Parallel arrays -> rows: ``observed_at`` plus the measures and lineage."""
    h = "hourly"
    zipped = F.arrays_zip(
        F.col(f"{h}.time").alias("observed_at"),
        *[F.col(f"{h}.{v}").alias(v) for v in HOURLY_VARIABLES],
    )
    return (payloads.select(F.inline(zipped), month.alias("_source_month"))
            .select("observed_at", *HOURLY_VARIABLES, "_source_month"))


def read_weather_payload(spark: SparkSession, paths: list[str],
                         multi_line: bool = True) -> DataFrame:
    """Scan weather payload files.  A downloaded file is one (pretty-printed)
    JSON object, ``multi_line=True``; files a Spark job landed hold one payload
    per line, ``multi_line=False``, and split across tasks."""
    raw = spark.read.schema(WEATHER_PAYLOAD).option("multiLine", multi_line).json(paths)
    month = F.regexp_extract(F.col("_metadata.file_path"), FILE_PATTERN, 1)
    return unpack_hourly(raw, month)


def read_landed_weather(spark: SparkSession, root: str, months: list[str] | None = None,
                        spark_landed: bool = False) -> DataFrame:
    """R5 over a landing folder: the payloads of ``months`` (all when None),
    restricted to each file's month window (R6)."""
    names = ([f"weather_{check_month(m)}.json" for m in months] if months is not None
             else ["weather_*.json"])
    rows = read_weather_payload(spark, landed_paths(root, names, spark_landed),
                                multi_line=not spark_landed)
    return rows.where(in_month_window(parse_weather_time("observed_at"), F.col("_source_month")))


def in_month_window(ts: Column, month: Column) -> Column:
    """R6 per row: ``ts`` falls between the first and the last day of ``month``."""
    first, last = month_bounds_columns(month)
    return (ts >= first.cast("timestamp_ntz")) & (ts < F.date_add(last, 1).cast("timestamp_ntz"))
