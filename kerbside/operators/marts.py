"""Zone x hour demand joined to that hour's weather."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.functions.numeric import exact_avg, exact_sum
from kerbside.functions.temporal import month_text, parse_weather_time, trunc_hour
from kerbside.operators.dimensions import hourly_weather


def zone_hour_demand(silver: DataFrame) -> DataFrame:
    """A1: trips, revenue and mean distance per (pickup zone, pickup hour).

    Partial aggregation runs map-side, so a zone holding a third of all trips
    reaches the reducers as one row per map task.
    """
    return (silver.groupBy("pickup_zone_id", trunc_hour("pickup_ts").alias("pickup_hour"))
            .agg(F.count(F.lit(1)).alias("trip_count"),
                 exact_sum("total_amount").alias("revenue"),
                 exact_avg("trip_distance").alias("avg_distance")))


def zone_hourly_demand(silver: DataFrame, bronze_weather: DataFrame) -> DataFrame:
    """The mart.  Reads silver (not the fact), as the source model does: it
    counts replayed and dropoff-before-pickup trips that the fact drops.

    Both sides are reduced to hour grain before the join; AQE broadcasts the
    weather side (one row per hour) when its shuffle statistics allow it.
    """
    demand = zone_hour_demand(silver)
    weather = hourly_weather(bronze_weather, ("temperature_2m", "precipitation"))
    return (demand.join(weather, demand.pickup_hour == weather.weather_hour, "left")
            .select("pickup_zone_id", "pickup_hour", "trip_count", "revenue",
                    "avg_distance", "temperature_2m", "precipitation"))


MONTH_COLUMN = "pickup_month"


def zone_hourly_demand_months(silver: DataFrame, bronze_weather: DataFrame,
                              months: list[str] | None = None) -> DataFrame:
    """The mart with a ``pickup_month`` partition column, for ``months`` only
    (all months when None).

    Rebuilding just some months is exact: a silver row's pickup month equals
    its source month (the month-consistency filter), so the rows of month M
    come from silver partition M alone, and the weather of M's hours from the
    readings taken in M.
    """
    s, w = silver, bronze_weather
    if months is not None:
        s = s.where(F.col("source_month").isin(list(months)))
        w = w.where(month_text(parse_weather_time("observed_at")).isin(list(months)))
    return zone_hourly_demand(s, w).withColumn(MONTH_COLUMN, month_text("pickup_hour"))

