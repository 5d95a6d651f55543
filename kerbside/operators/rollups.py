"""Roll-ups of the fact with distinct trips and zones, from one stored table of mergeable sketches.

Distinct counts do not add up, sketches of them do: the fact is reduced once to a row per hour with counts, an exact sum
and HyperLogLog sketches, stored by month, and a month is refreshed alone.  Every level above (day, month, all) is a
union of those rows, made by one GROUPING SETS; the fact is not read again.  The exact roll-up beside it reads the fact.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.functions.numeric import DEFAULT_SCALE
from kerbside.functions.temporal import month_text, trunc_hour

#: log2 of a sketch's buckets: a relative standard error of about 1.04 / sqrt(2^14) = 0.8 %, 16 KB at most.
SKETCH_BITS = 14
#: An estimate further off than this is taken for an error: four standard errors, and half a unit for small counts.
BOUND = 4 * 1.04 / (1 << (SKETCH_BITS // 2))
LEVELS = ("hour", "day", "month", "all")


def hour_sketches(fact: DataFrame) -> DataFrame:
    """(pickup_month, day, hour, trips, revenue, routes_sketch, zones_sketch): a row an hour of the fact."""
    route = F.concat_ws(">", F.col("pickup_zone_id").cast("string"), F.col("dropoff_zone_id").cast("string"))
    return fact.groupBy(month_text("pickup_ts").alias("pickup_month"), F.to_date("pickup_ts").alias("day"),
                        trunc_hour("pickup_ts").alias("hour")).agg(
        F.count(F.lit(1)).alias("trips"),
        F.sum(F.col("total_amount").cast(f"decimal(28,{DEFAULT_SCALE})")).alias("revenue"),
        F.hll_sketch_agg(route, SKETCH_BITS).alias("routes_sketch"),
        F.hll_sketch_agg("pickup_zone_id", SKETCH_BITS).alias("zones_sketch"))


def write_sketches(fact: DataFrame, path: str, months: list[str] | None = None) -> str:
    """Store the sketches by month; with ``months`` only those are read from the fact and replaced."""
    if months is not None:
        fact = fact.where(month_text("pickup_ts").isin(months))
    mode = "static" if months is None else "dynamic"
    (hour_sketches(fact).hint("rebalance", "pickup_month").write.mode("overwrite")
     .option("partitionOverwriteMode", mode).partitionBy("pickup_month").parquet(path))
    return path


def _levels(df: DataFrame, *aggs) -> DataFrame:
    sets = [[F.col("pickup_month"), F.col("day"), F.col("hour")], [F.col("pickup_month"), F.col("day")], [F.col("pickup_month")], []]
    grouped = df.groupingSets(sets, "pickup_month", "day", "hour").agg(F.grouping_id().alias("_g"), *aggs)
    names = F.create_map(*[F.lit(x) for pair in zip((0, 1, 3, 7), LEVELS, strict=True) for x in pair])
    return grouped.withColumn("level", names[F.col("_g").cast("int")]).drop("_g")


def rolled_up(sketches: DataFrame) -> DataFrame:
    """(level, pickup_month, day, hour, trips, revenue, routes, zones): all levels from stored sketches; routes and zones are estimates."""
    return _levels(
        sketches, F.sum("trips").alias("trips"), F.sum("revenue").cast("double").alias("revenue"),
        F.hll_sketch_estimate(F.hll_union_agg("routes_sketch")).alias("routes"),
        F.hll_sketch_estimate(F.hll_union_agg("zones_sketch")).alias("zones"),
    ).select("level", "pickup_month", "day", "hour", "trips", "revenue", "routes", "zones")


def rolled_up_exactly(fact: DataFrame) -> DataFrame:
    """The same table with exact distinct counts, from the fact.

    The fact is first reduced to its distinct (hour, pickup, drop-off) rows with counts, so the distinct counts of all levels
    run over those.
    """
    route = F.concat_ws(">", F.col("pickup_zone_id").cast("string"), F.col("dropoff_zone_id").cast("string"))
    small = fact.groupBy(month_text("pickup_ts").alias("pickup_month"), F.to_date("pickup_ts").alias("day"),
                         trunc_hour("pickup_ts").alias("hour"), "pickup_zone_id", route.alias("route")).agg(
        F.count(F.lit(1)).alias("trips"), F.sum(F.col("total_amount").cast(f"decimal(28,{DEFAULT_SCALE})")).alias("revenue"))
    return _levels(
        small, F.sum("trips").alias("trips"), F.sum("revenue").cast("double").alias("revenue"),
        F.count_distinct("route").alias("routes"), F.count_distinct("pickup_zone_id").alias("zones"),
    ).select("level", "pickup_month", "day", "hour", "trips", "revenue", "routes", "zones")


def compared(spark: SparkSession, path: str, fact: DataFrame) -> DataFrame:
    """The exact roll-up, and whether the stored sketches' estimates lie within ``BOUND`` of it."""
    on = ["level", "pickup_month", "day", "hour"]
    estimate = rolled_up(spark.read.parquet(path)).select(
        *[F.col(c).alias(f"_{c}") for c in on], F.col("trips").alias("_trips"), F.col("routes").alias("_routes"), F.col("zones").alias("_zones"))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in on]
    near = lambda c: F.abs(F.col(f"_{c}") - F.col(c)) <= F.col(c) * BOUND + 0.5
    joined = rolled_up_exactly(fact).join(estimate, same[0] & same[1] & same[2] & same[3], "left")
    good = F.coalesce(near("routes") & near("zones") & (F.col("trips") == F.col("_trips")), F.lit(False))
    return joined.select(*on, "trips", "revenue", "routes", "zones", good.alias("estimates_hold"))
