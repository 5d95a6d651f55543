"""Adapters that shape the driver's test tables like the mobility sources.

The same arithmetic is written as DuckDB SQL in ``kerbside.plans.oracle`` so
both engines see identical inputs.  Nothing here samples or caps rows: every
adapter is a projection (and, for the replay, a union) over a whole table.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the adapters (mirrored in the oracle SQL).
REPLAY_MODULUS = 10          # rows with event_id % 10 = 0 are landed twice
STRAY_MONTH_MODULUS = 97     # rows with event_id % 97 = 0 carry a wrong month
STRAY_MONTH = "2023-12"
ZONE_MODULUS = 25
DROPOFF_ZONE_MODULUS = 26
PASSENGER_MODULUS = 7
SERVICE_ZONES = ("Yellow Zone", "Boro Zone", "Airports")
AS_OF_STAMPS = ("2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-03-01 00:00:00")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bronze_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips from ``events`` (B1), with every tenth row landed a second time.

    One scan: each event emits one copy, or two when it is replayed.
    """
    e = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    copies = (F.when(eid % REPLAY_MODULUS == 0, F.array(F.lit(1), F.lit(2)))
              .otherwise(F.array(F.lit(1))))
    return e.select(
        F.col("ts").alias("tpep_pickup_datetime"),
        F.timestamp_add("MINUTE", eid % 90 - 5, F.col("ts")).alias("tpep_dropoff_datetime"),
        (F.col("user_id") % ZONE_MODULUS).alias("pulocationid"),
        F.nullif(eid % DROPOFF_ZONE_MODULUS, F.lit(DROPOFF_ZONE_MODULUS - 1)).alias("dolocationid"),
        F.nullif(eid % PASSENGER_MODULUS, F.lit(0)).alias("passenger_count"),
        ((eid % 40) * F.lit(0.5)).alias("trip_distance"),
        F.when(F.col("event_type") == "error", -F.col("value"))
         .otherwise(F.col("value")).alias("total_amount"),
        F.lit("yellow").alias("_source_dataset"),
        F.when(eid % STRAY_MONTH_MODULUS == 0, F.lit(STRAY_MONTH))
         .otherwise(F.date_format("ts", "yyyy-MM")).alias("_source_month"),
        F.explode(copies).alias("_copy"),
    ).drop("_copy")


def bronze_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minute-stamped weather readings from the ``view`` events (B2)."""
    e = table(spark, sf_dir, "events").where(F.col("event_type") == "view")
    eid = F.col("event_id")
    return e.select(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm").alias("observed_at"),
        F.col("value").alias("temperature_2m"),
        (eid % 3).cast("double").alias("precipitation"),
        (eid % 20).cast("double").alias("wind_speed_10m"),
        (eid % 4).cast("bigint").alias("weather_code"),
        F.date_format("ts", "yyyy-MM").alias("_source_month"),
    )


def zones_version(spark: SparkSession, sf_dir: str, version: int) -> DataFrame:
    """Zone lookup versions from nation x region.

    v1: every nation; v2: names changed where key % 5 = 0, rows removed where
    key % 11 = 10; v3: v1 again (re-appearance and change-back).
    """
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    key = F.col("n_nationkey")
    service = (F.when(key % 3 == 0, F.lit(SERVICE_ZONES[0]))
               .when(key % 3 == 1, F.lit(SERVICE_ZONES[1]))
               .otherwise(F.lit(SERVICE_ZONES[2])))
    name = F.col("n_name")
    if version == 2:
        name = F.when(key % 5 == 0, F.concat(name, F.lit(" North"))).otherwise(name)
    zones = n.join(r, n.n_regionkey == r.r_regionkey, "inner").select(
        key.cast("int").alias("zone_id"),
        F.col("r_name").alias("borough"),
        name.alias("zone_name"),
        service.alias("service_zone"),
    )
    if version == 2:
        zones = zones.where(F.col("zone_id") % 11 != 10)
    return zones


def volume_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver-shaped trips at volume from orders x lineitem."""
    o = table(spark, sf_dir, "orders")
    li = table(spark, sf_dir, "lineitem")
    return li.join(o, li.l_orderkey == o.o_orderkey, "inner").select(
        F.col("o_orderdate").alias("pickup_ts"),
        F.col("l_shipdate").alias("dropoff_ts"),
        F.col("l_suppkey").cast("int").alias("pickup_zone_id"),
        F.col("l_linenumber").cast("int").alias("dropoff_zone_id"),
        F.lit(None).cast("int").alias("passenger_count"),
        F.col("l_quantity").alias("trip_distance"),
        F.col("l_extendedprice").alias("total_amount"),
        F.date_format("o_orderdate", "yyyy-MM").alias("source_month"),
    )


def dirty_bronze_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A corrupted load for the gate: NULL pickups in minutes 0 and 50 of each
    hour, and on refunds (negative amounts) distance x100 and 99 passengers."""
    b = bronze_trips(spark, sf_dir)
    return b.select(
        F.when(F.minute("tpep_pickup_datetime") % 50 == 0, F.lit(None).cast("timestamp_ntz"))
         .otherwise(F.col("tpep_pickup_datetime")).alias("tpep_pickup_datetime"),
        "tpep_dropoff_datetime", "pulocationid", "dolocationid",
        F.when(F.col("total_amount") < 0, F.lit(99)).otherwise(F.col("passenger_count"))
         .alias("passenger_count"),
        F.when(F.col("total_amount") < 0, F.col("trip_distance") * 100)
         .otherwise(F.col("trip_distance")).alias("trip_distance"),
        "total_amount", "_source_dataset", "_source_month",
    )


def weather_payloads(spark: SparkSession, sf_dir: str, chunk: int = 16) -> DataFrame:
    """Re-pack the weather readings as payload objects of parallel arrays.

    Each payload holds the readings of ``chunk`` consecutive event ids (a
    bounded group), ordered by event id, like the hourly feed's arrays.
    """
    e = table(spark, sf_dir, "events").where(F.col("event_type") == "view")
    eid = F.col("event_id")
    reading = F.struct(
        eid.alias("event_id"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm").alias("time"),
        F.col("value").alias("temperature_2m"),
        (eid % 3).cast("double").alias("precipitation"),
        (eid % 20).cast("double").alias("wind_speed_10m"),
        (eid % 4).cast("bigint").alias("weather_code"),
    )
    grouped = (e.groupBy(F.floor(eid / chunk).alias("payload_id"),
                         F.date_format("ts", "yyyy-MM").alias("month"))
               .agg(F.sort_array(F.collect_list(reading)).alias("r")))
    fields = ["time", "temperature_2m", "precipitation", "wind_speed_10m", "weather_code"]

    def field_of(name: str):
        return lambda x: x.getField(name)

    hourly = F.struct(*[F.transform("r", field_of(f)).alias(f) for f in fields])
    return grouped.select("payload_id", "month", hourly.alias("hourly"))


# --- variants that give tests and months something to find -------------------

def clean_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze weather with one reading a time stamp, that of the smallest event."""
    e = table(spark, sf_dir, "events").where(F.col("event_type") == "view")
    at = F.date_format("ts", "yyyy-MM-dd'T'HH:mm")
    first = e.groupBy(at.alias("observed_at")).agg(
        F.min_by(F.struct("event_id", "value", "ts"), "event_id").alias("r"))
    eid = F.col("r.event_id")
    return first.select(
        "observed_at", F.col("r.value").alias("temperature_2m"),
        (eid % 3).cast("double").alias("precipitation"),
        (eid % 20).cast("double").alias("wind_speed_10m"),
        (eid % 4).cast("bigint").alias("weather_code"),
        F.date_format("r.ts", "yyyy-MM").alias("_source_month"))


def faint_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze weather whose rain readings are thousandths of a millimetre."""
    return bronze_weather(spark, sf_dir).withColumn("precipitation", F.col("precipitation") * 0.002)


def two_month_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze trips with the days before the 15th moved fifteen days back, into the month before."""
    trips = bronze_trips(spark, sf_dir)
    early = F.dayofmonth("tpep_pickup_datetime") < 15
    back = F.expr("INTERVAL 15 DAYS")
    moved = trips.where(early).select(
        *[(F.col(c) - back).alias(c) if c.startswith("tpep_") else F.col(c)
          for c in trips.columns])
    moved = moved.withColumn("_source_month", F.date_format("tpep_pickup_datetime", "yyyy-MM"))
    return trips.where(~early | early.isNull()).unionByName(moved)


def dirty_fact(fact: DataFrame) -> DataFrame:
    """Fact rows with planted faults: NaN and negative amounts, missing zones, orphan date keys, a key that repeats."""
    m = F.col("trip_minutes")
    amount = (F.when(m % 10 == 0, F.lit(float("nan"))).when(m % 11 == 0, -F.col("total_amount"))
              .otherwise(F.col("total_amount")))
    return fact.select(
        F.when(m % 17 == 0, F.lit("X")).otherwise(F.col("trip_key")).alias("trip_key"), "pickup_date",
        F.when(m % 19 == 0, F.lit(19000101)).otherwise(F.col("pickup_date_key")).alias("pickup_date_key"),
        "pickup_weather_key",
        F.when(m % 13 == 0, F.lit(None).cast("int")).otherwise(F.col("pickup_zone_id")).alias("pickup_zone_id"),
        "dropoff_zone_id", "pickup_ts", "dropoff_ts", "trip_minutes", "passenger_count",
        "trip_distance", amount.alias("total_amount"))


def customer_version(spark: SparkSession, sf_dir: str, version: int) -> DataFrame:
    """Customer extract: version 2 moves every fifth key to another segment and drops every eleventh."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    if version == 2:
        moved = F.when(F.col("c_custkey") % 5 == 0, F.lit("MOVED")).otherwise(F.col("c_mktsegment"))
        c = c.withColumn("c_mktsegment", moved).where(F.col("c_custkey") % 11 != 10)
    return c


def land_drifting_trip_files(spark: SparkSession, sf_dir: str, root: str) -> str:
    """Land the bronze trips by month with another schema in each: the earlier month has double passenger counts
    and no dropoff zone, the later one whole counts."""
    from kerbside.sinks.writers import land_files

    trips = bronze_trips(spark, sf_dir)
    name = F.concat(F.lit("yellow_tripdata_"), F.col("_source_month"), F.lit(".parquet"))
    drop = ("_source_dataset", "_source_month")
    early = F.col("_source_month") == "2023-12"
    land_files(trips.where(~early), root, name, drop=drop)
    other = trips.where(early).drop("dolocationid").withColumn(
        "passenger_count", F.col("passenger_count").cast("double"))
    land_files(other, root, name, drop=drop)
    return root


# --- landed source files derived from the driver tables ----------------------

def land_trip_files(spark: SparkSession, sf_dir: str, root: str, dataset: str = "yellow") -> str:
    """Land the bronze trips as monthly trip files (``{dataset}_tripdata_{month}
    .parquet``) in one job.  The lineage columns are left out: reading the
    files back restores them from the file names."""
    from kerbside.sinks.writers import land_files

    trips = bronze_trips(spark, sf_dir)
    name = F.concat(F.lit(f"{dataset}_tripdata_"), F.col("_source_month"), F.lit(".parquet"))
    return land_files(trips, root, name, drop=("_source_dataset", "_source_month"))


def land_weather_payloads(spark: SparkSession, sf_dir: str, root: str) -> str:
    """Land the weather payloads as monthly JSON files (``weather_{month}.json``),
    one payload object per line."""
    from kerbside.sinks.writers import land_files

    p = weather_payloads(spark, sf_dir)
    name = F.concat(F.lit("weather_"), F.col("month"), F.lit(".json"))
    return land_files(p, root, name, fmt="json", drop=("payload_id", "month"))


def write_zone_seed(spark: SparkSession, sf_dir: str, path: str, version: int = 1) -> str:
    """Write a zone version as the seed CSV: header ``LocationID, Borough, Zone,
    service_zone``, every field quoted."""
    z = zones_version(spark, sf_dir, version)
    (z.select(F.col("zone_id").alias("LocationID"), F.col("borough").alias("Borough"),
              F.col("zone_name").alias("Zone"), "service_zone")
     .write.mode("overwrite").option("header", "true").option("quoteAll", "true").csv(path))
    return path
