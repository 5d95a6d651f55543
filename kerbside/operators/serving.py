"""Serving and dashboard queries over the gold layer."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.functions.numeric import exact_sum
from kerbside.functions.temporal import month_text
from kerbside.operators.marts import MONTH_COLUMN

MAX_LIMIT = 168


def check_limit(limit: int, maximum: int = MAX_LIMIT) -> int:
    if not isinstance(limit, int) or isinstance(limit, bool) or not 1 <= limit <= maximum:
        raise ValueError(f"limit must be an integer in [1, {maximum}], got {limit!r}")
    return limit


# The two lookups that bind a parameter, as SQL over a lake's registered gold
# tables (see kerbside.sinks.catalog); parameters are bound, never formatted in.
PARAMETER_SQL = {
    "zone_demand": """
        SELECT pickup_hour, trip_count, revenue, avg_distance, temperature_2m, precipitation
        FROM {gold}.mart_zone_hourly_demand
        WHERE pickup_zone_id = :zone_id
        ORDER BY pickup_hour DESC
        LIMIT :limit""",
    "single_day_revenue": """
        SELECT count(*) AS c,
               CAST(round(sum(CAST(total_amount AS DECIMAL(28,9))), 0) AS DOUBLE) AS rev
        FROM {gold}.fact_trips WHERE pickup_date = :day""",
}


def run_serving_sql(spark, name: str, gold: str = "gold", **params) -> DataFrame:
    """Run one lookup with bound parameters (``limit`` is checked) on the database ``gold``."""
    if not gold.replace("_", "").isalnum():
        raise ValueError(f"not a database name: {gold!r}")
    if "limit" in params:
        check_limit(params["limit"])
    if "day" in params and not isinstance(params["day"], dt.date):
        params["day"] = dt.date.fromisoformat(str(params["day"]))
    return spark.sql(PARAMETER_SQL[name].format(gold=gold), args=params or None)


def publish_dashboards(mart: DataFrame, dim_zone: DataFrame, prefix: str = "dashboard_") -> list[str]:
    """The dashboard results as views, for SQL users: they are the operators below, by name."""
    views = {
        "top_zones": top_zones(mart, dim_zone),
        "hourly_profile": hourly_profile(mart),
        "daily_trips_vs_temperature": daily_trips_vs_temperature(mart),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(f"{prefix}{name}")
    return [f"{prefix}{name}" for name in views]


def zone_demand(mart: DataFrame, zone_id: int, limit: int = 24, since=None) -> DataFrame:
    """The latest ``limit`` hours of one pickup zone (F9, T2); ``since``
    (a date or timestamp) optionally keeps hours at or after it."""
    check_limit(limit)
    cond = F.col("pickup_zone_id") == F.lit(int(zone_id))
    if since is not None:
        start = F.lit(str(since)).cast("timestamp_ntz")
        cond = cond & (F.col("pickup_hour") >= start)
        if MONTH_COLUMN in mart.columns:
            # the stored mart is partitioned by month: prune the older months
            cond = cond & (F.col(MONTH_COLUMN) >= month_text(start))
    return (mart.where(cond)
            .select("pickup_hour", "trip_count", "revenue", "avg_distance",
                    "temperature_2m", "precipitation")
            .orderBy(F.col("pickup_hour").desc())
            .limit(limit))


def current_zones(dim_zone: DataFrame) -> DataFrame:
    return dim_zone.where(F.col("is_current"))


def top_zones(mart: DataFrame, dim_zone: DataFrame, n: int = 10) -> DataFrame:
    """Top zones by trips, grouped by zone *name* (names are not unique, so
    equal names merge, as in the dashboard).  Trips are summed per zone id
    before the join, so it moves one row per zone id."""
    per_zone = mart.groupBy("pickup_zone_id").agg(F.sum("trip_count").alias("trips"))
    zones = current_zones(dim_zone).select("zone_id", "zone_name")
    return (per_zone.join(zones, per_zone.pickup_zone_id == zones.zone_id, "inner")
            .groupBy("zone_name").agg(F.sum("trips").alias("trips"))
            .orderBy(F.col("trips").desc(), F.col("zone_name").asc())
            .limit(n))


def hourly_profile(mart: DataFrame) -> DataFrame:
    """Trips by hour of day."""
    return (mart.groupBy(F.hour("pickup_hour").alias("hour_of_day"))
            .agg(F.sum("trip_count").alias("trips"))
            .orderBy("hour_of_day"))


def daily_trips_vs_temperature(mart: DataFrame) -> DataFrame:
    """Daily trips and the plain mean of hourly temperatures (over
    zone-hours, not trip-weighted; NULLs skipped), rounded to 0.1."""
    temp = F.col("temperature_2m")
    mean = F.try_divide(exact_sum(temp), F.count(temp))
    return (mart.groupBy(F.to_date("pickup_hour").alias("day"))
            .agg(F.sum("trip_count").alias("trips"), F.round(mean, 1).alias("avg_temp_c"))
            .orderBy("day"))


def single_day_revenue(fact: DataFrame, day) -> DataFrame:
    """C11: trips and whole-unit revenue of one pickup day.  On a table
    partitioned by ``pickup_date`` the equality is a partition filter."""
    d = day if isinstance(day, dt.date) else dt.date.fromisoformat(str(day))
    money = exact_sum("total_amount")
    return (fact.where(F.col("pickup_date") == F.lit(d))
            .agg(F.count(F.lit(1)).alias("c"), F.round(money, 0).cast("double").alias("rev")))


def between_days(fact: DataFrame, first, last) -> DataFrame:
    """Pickup-time range that also prunes day partitions: the timestamp range
    alone does not imply a ``pickup_date`` partition filter, so add both."""
    a = dt.date.fromisoformat(str(first))
    b = dt.date.fromisoformat(str(last))
    return fact.where(F.col("pickup_date").between(F.lit(a), F.lit(b))
                      & (F.col("pickup_ts") >= F.lit(a).cast("timestamp_ntz"))
                      & (F.col("pickup_ts") < F.date_add(F.lit(b), 1).cast("timestamp_ntz")))


def star_weather_demand(fact: DataFrame, dim_weather: DataFrame) -> DataFrame:
    """Fact -> weather dimension on the pickup hour key; trips, revenue
    and mean minutes by wet / dry / unknown hour."""
    w = dim_weather.select("weather_key", "is_wet")
    j = fact.join(w, fact.pickup_weather_key == w.weather_key, "left")
    return (j.groupBy("is_wet")
            .agg(F.count(F.lit(1)).alias("trips"),
                 exact_sum("total_amount").alias("revenue"),
                 F.try_divide(F.sum("trip_minutes"), F.count("trip_minutes")).alias("avg_minutes")))


def star_weekend_revenue(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Fact -> date dimension on the day; trips and revenue by weekday
    and weekend flag."""
    d = dim_date.select("date_day", "day_of_week", "is_weekend")
    j = fact.join(d, fact.pickup_date == d.date_day, "inner")
    return (j.groupBy("day_of_week", "is_weekend")
            .agg(F.count(F.lit(1)).alias("trips"),
                 exact_sum("total_amount").alias("revenue")))
