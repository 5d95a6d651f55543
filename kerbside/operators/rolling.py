"""C6 over time: demand for every hour, gaps filled, and rolling means by time, not by row.

The spine has every hour from the first to the last of the mart for every zone; hours without trips count 0.  A window of
a zone's whole history would be one task for each zone; so the history is cut into months, each month carries the
hours of the frame before its start as an edge, and the window runs inside (zone, month).  The edges are dropped
afterwards.  A zone-month is 744 rows and the edge at most, however long the history is.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

HOUR = "INTERVAL 1 HOUR"


def dense_demand(mart: DataFrame) -> DataFrame:
    """(pickup_zone_id, pickup_hour, trip_count) for every zone and every hour between the mart's first and last; 0 where it has no row.

    Rows without a zone or an hour take no part.  Hours are made per zone and month, so no task holds a zone's whole history.
    """
    known = mart.where(F.col("pickup_zone_id").isNotNull() & F.col("pickup_hour").isNotNull())
    bounds = known.agg(F.min("pickup_hour").alias("lo"), F.max("pickup_hour").alias("hi")).withColumn("_one", F.lit(1))
    zones = known.select("pickup_zone_id").distinct().withColumn("_one", F.lit(1))
    # one row of bounds beside every zone, then a row a month, then the month's hours
    months = zones.join(F.broadcast(bounds), "_one").select("pickup_zone_id", "lo", "hi", F.explode(F.sequence(
        F.trunc("lo", "month"), F.trunc("hi", "month"), F.expr("INTERVAL 1 MONTH"))).alias("month"))
    first = F.greatest("lo", F.col("month").cast("timestamp_ntz"))
    last = F.least("hi", F.add_months("month", 1).cast("timestamp_ntz") - F.expr(HOUR))
    spine = months.select("pickup_zone_id", F.explode(F.sequence(first, last, F.expr(HOUR))).alias("pickup_hour"))
    counts = known.groupBy("pickup_zone_id", "pickup_hour").agg(F.sum("trip_count").alias("n"))
    return spine.join(counts, ["pickup_zone_id", "pickup_hour"], "left").select(
        "pickup_zone_id", "pickup_hour", F.coalesce("n", F.lit(0)).cast("bigint").alias("trip_count"))


def rolling_demand(mart: DataFrame, hours: int = 168) -> DataFrame:
    """The dense demand with ``rolling_trips`` (of the ``hours`` up to and including this one), ``rolling_hours`` (how many of them lie
    within the mart's time) and their quotient ``rolling_mean``.  Sums are whole numbers, so results do not depend on partitioning."""
    if not 1 <= hours <= 28 * 24:
        raise ValueError("hours must be between 1 and 672, so that an edge reaches into one earlier month at most")
    dense = dense_demand(mart)
    month = F.trunc("pickup_hour", "month")
    next_month = F.add_months(month, 1)
    edge = F.col("pickup_hour") >= next_month.cast("timestamp_ntz") - F.expr(f"INTERVAL {hours - 1} HOURS")
    chunks = F.when(edge, F.array(month, next_month)).otherwise(F.array(month))
    rows = dense.withColumn("_month", month).withColumn("_chunk", F.explode(chunks))
    # hours as whole numbers, for a range frame by time
    rows = rows.withColumn("_at", F.floor(F.unix_micros(F.col("pickup_hour").cast("timestamp")) / 3_600_000_000).cast("bigint"))
    frame = Window.partitionBy("pickup_zone_id", "_chunk").orderBy("_at").rangeBetween(-(hours - 1), 0)
    rolled = rows.withColumn("rolling_trips", F.sum("trip_count").over(frame)).withColumn("rolling_hours", F.count(F.lit(1)).over(frame))
    return rolled.where(F.col("_chunk") == F.col("_month")).select(
        "pickup_zone_id", "pickup_hour", "trip_count", "rolling_trips", "rolling_hours",
        (F.col("rolling_trips") / F.col("rolling_hours")).alias("rolling_mean"))
