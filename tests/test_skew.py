"""Hot keys: one zone, one hour and one replayed trip each holding about a
third of all rows.  Results stay whole and exact, and the plans combine the
hot groups map-side before any shuffle."""
from __future__ import annotations

import contextlib
import io

from pyspark.sql import functions as F

from kerbside.operators import facts, marts, silver
from kerbside.sources import fixtures

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def _skewed_silver(spark):
    """Silver where every third row (by a hash of its attributes) is moved to
    zone 7 at 2024-01-15 08:xx, and one trip is replayed as often as half the
    table has rows."""
    s = silver.clean_trips(fixtures.bronze_trips(spark, SF))
    hot = (F.abs(F.hash("pickup_ts", "total_amount")) % 3) == 0
    moved = s.select(
        F.when(hot, F.lit("2024-01-15 08:00:00").cast("timestamp_ntz")
               + F.make_interval(mins=F.minute("pickup_ts"))).otherwise(F.col("pickup_ts"))
         .alias("pickup_ts"),
        "dropoff_ts",
        F.when(hot, F.lit(7)).otherwise(F.col("pickup_zone_id")).alias("pickup_zone_id"),
        "dropoff_zone_id", "passenger_count", "trip_distance", "total_amount", "source_month")
    moved = moved.where(F.col("dropoff_ts").isNull() | (F.col("dropoff_ts") >= F.col("pickup_ts"))
                        | ~hot)
    one = moved.where(F.col("dropoff_ts") >= F.col("pickup_ts")).orderBy("pickup_ts").limit(1)
    copies = s.count() // 2
    replay = one.select("*", F.explode(F.sequence(F.lit(1), F.lit(copies))).alias("_c")).drop("_c")
    return moved.unionByName(replay), copies


def test_hot_zone_hour_mart_is_exact(spark):
    s, copies = _skewed_silver(spark)
    total = s.count()
    mart = marts.zone_hourly_demand(s, fixtures.bronze_weather(spark, SF))
    assert mart.agg(F.sum("trip_count")).first()[0] == total        # nothing dropped
    hot_rows = s.where((F.col("pickup_zone_id") == 7)
                       & (F.date_trunc("hour", "pickup_ts") == F.lit("2024-01-15 08:00:00")
                          .cast("timestamp"))).count()
    got = mart.where((F.col("pickup_zone_id") == 7)
                     & (F.col("pickup_hour") == F.lit("2024-01-15 08:00:00")
                        .cast("timestamp_ntz"))).first()
    assert got.trip_count == hot_rows and hot_rows > (total - copies) // 4
    p = plan(mart)
    assert p.index("partial_count") > p.index("Exchange hashpartitioning(pickup_zone_id")


def test_hot_trip_key_dedupes_to_one_row(spark):
    s, copies = _skewed_silver(spark)
    keyed = facts.keyed_trips(s)
    fact = facts.build_fact(s)
    n_keys = keyed.where(F.col("trip_key").isNotNull()).select("trip_key").distinct().count()
    assert fact.count() == n_keys
    hot = (keyed.groupBy("trip_key").count().orderBy(F.col("count").desc()).first())
    assert hot["count"] >= copies
    assert fact.where(F.col("trip_key") == hot.trip_key).count() == 1
