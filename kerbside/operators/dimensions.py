"""C2 date dimension, C3 weather dimension, C4 zone dimension."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.functions.keys import date_key, hour_key
from kerbside.functions.numeric import exact_avg
from kerbside.functions.temporal import iso_weekday, parse_weather_time, trunc_hour

WEATHER_MEASURES = ("temperature_2m", "precipitation", "wind_speed_10m")


def date_dimension(silver: DataFrame) -> DataFrame:
    """One row per day between the first and last pickup day."""
    bounds = silver.agg(F.min("pickup_ts").alias("lo"), F.max("pickup_ts").alias("hi"))
    spine = bounds.select(F.explode(F.sequence(
        F.to_date("lo"), F.to_date("hi"), F.expr("INTERVAL 1 DAY"))).alias("date_day"))
    dow = iso_weekday("date_day")
    return spine.select(
        date_key("date_day").alias("date_key"),
        "date_day",
        F.year("date_day").alias("year"),
        F.month("date_day").alias("month"),
        F.dayofmonth("date_day").alias("day_of_month"),
        dow.alias("day_of_week"),
        dow.isin(6, 7).alias("is_weekend"),
    )


def hourly_weather(bronze_weather: DataFrame, measures=WEATHER_MEASURES) -> DataFrame:
    """A2/A3: average readings per hour.  Also removes re-ingested copies."""
    hour = trunc_hour(parse_weather_time("observed_at"))
    return (bronze_weather.groupBy(hour.alias("weather_hour"))
            .agg(*[exact_avg(m).alias(m) for m in measures]))


def weather_dimension(bronze_weather: DataFrame) -> DataFrame:
    """Hourly weather with its smart key and a wet flag (NULL when rain is)."""
    h = hourly_weather(bronze_weather)
    return h.select(
        hour_key("weather_hour").alias("weather_key"),
        "weather_hour", *WEATHER_MEASURES,
        (F.col("precipitation") > 0).alias("is_wet"),
    )


def zone_dimension(history: DataFrame) -> DataFrame:
    """C4: SCD2 history -> dim_zone with an ``is_current`` flag."""
    return history.select(
        "zone_id", "borough", "zone_name", "service_zone", "valid_from", "valid_to",
        F.col("valid_to").isNull().alias("is_current"),
    )
