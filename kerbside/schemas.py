"""Explicit StructTypes, one per layer table (the data contract)."""
from __future__ import annotations

from pyspark.sql import types as T

# Columns of a bronze trip file that the models read, after lower-casing.
BRONZE_TRIPS = T.StructType([
    T.StructField("tpep_pickup_datetime", T.TimestampNTZType()),
    T.StructField("tpep_dropoff_datetime", T.TimestampNTZType()),
    T.StructField("pulocationid", T.LongType()),
    T.StructField("dolocationid", T.LongType()),
    T.StructField("passenger_count", T.LongType()),
    T.StructField("trip_distance", T.DoubleType()),
    T.StructField("total_amount", T.DoubleType()),
    T.StructField("_source_dataset", T.StringType()),
    T.StructField("_source_month", T.StringType()),
])

# Hourly weather payload: one JSON object with parallel arrays under "hourly".
WEATHER_PAYLOAD = T.StructType([
    T.StructField("hourly", T.StructType([
        T.StructField("time", T.ArrayType(T.StringType())),
        T.StructField("temperature_2m", T.ArrayType(T.DoubleType())),
        T.StructField("precipitation", T.ArrayType(T.DoubleType())),
        T.StructField("wind_speed_10m", T.ArrayType(T.DoubleType())),
        T.StructField("weather_code", T.ArrayType(T.LongType())),
    ])),
])

# Zone lookup seed as shipped: quoted header, numeric id.
ZONE_LOOKUP = T.StructType([
    T.StructField("LocationID", T.IntegerType()),
    T.StructField("Borough", T.StringType()),
    T.StructField("Zone", T.StringType()),
    T.StructField("service_zone", T.StringType()),
])

SILVER_TRIPS = T.StructType([
    T.StructField("pickup_ts", T.TimestampNTZType()),
    T.StructField("dropoff_ts", T.TimestampNTZType()),
    T.StructField("pickup_zone_id", T.IntegerType()),
    T.StructField("dropoff_zone_id", T.IntegerType()),
    T.StructField("passenger_count", T.IntegerType()),
    T.StructField("trip_distance", T.DoubleType()),
    T.StructField("total_amount", T.DoubleType()),
    T.StructField("source_month", T.StringType()),
])

FACT_TRIPS = T.StructType([
    T.StructField("trip_key", T.StringType()),
    T.StructField("pickup_date", T.DateType()),
    T.StructField("pickup_date_key", T.IntegerType()),
    T.StructField("pickup_weather_key", T.LongType()),
    T.StructField("pickup_zone_id", T.IntegerType()),
    T.StructField("dropoff_zone_id", T.IntegerType()),
    T.StructField("pickup_ts", T.TimestampNTZType()),
    T.StructField("dropoff_ts", T.TimestampNTZType()),
    T.StructField("trip_minutes", T.LongType()),
    T.StructField("passenger_count", T.IntegerType()),
    T.StructField("trip_distance", T.DoubleType()),
    T.StructField("total_amount", T.DoubleType()),
])

FACT_COLUMNS = [f.name for f in FACT_TRIPS.fields]

# The fact's date keys per pickup day, with their row counts (a key profile).
FACT_DATE_KEYS = T.StructType([
    T.StructField("pickup_date_key", T.IntegerType()),
    T.StructField("n", T.LongType()),
    T.StructField("pickup_date", T.DateType()),
])

MART_COLUMNS = ["pickup_zone_id", "pickup_hour", "trip_count", "revenue", "avg_distance",
                "temperature_2m", "precipitation"]
