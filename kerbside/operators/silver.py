"""Bronze trips -> silver (F1-F4 filters, P1 conform)."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.functions.temporal import month_text

SILVER_COLUMNS = ["pickup_ts", "dropoff_ts", "pickup_zone_id", "dropoff_zone_id",
                  "passenger_count", "trip_distance", "total_amount", "source_month"]


def _to_int(c: str):
    # Round before narrowing: a double count of 1.9999999 is 2, not 1.
    return F.round(F.col(c)).cast("int")


def valid_trip(pickup) -> F.Column:
    """Positive fare and distance (NaN is not positive), a pickup time,
    and a pickup month equal to the month of the file the row came from."""
    amount, dist = F.col("total_amount"), F.col("trip_distance")
    return ((amount > 0) & ~F.isnan(amount)
            & (dist > 0) & ~F.isnan(dist)
            & pickup.isNotNull()
            & (month_text(pickup) == F.col("_source_month")))


def clean_trips(bronze: DataFrame, months: list[str] | None = None,
                max_passengers: int | None = None) -> DataFrame:
    """Type and clean bronze trips.

    ``months`` restricts to those source months (a partition filter when bronze
    is partitioned by ``_source_month``).  ``max_passengers`` optionally drops
    out-of-range passenger counts (off by default, as in the source models).
    """
    src = bronze
    if months is not None:
        src = src.where(F.col("_source_month").isin(list(months)))
    pickup = F.col("tpep_pickup_datetime").cast("timestamp_ntz")
    out = src.where(valid_trip(pickup)).select(
        pickup.alias("pickup_ts"),
        F.col("tpep_dropoff_datetime").cast("timestamp_ntz").alias("dropoff_ts"),
        _to_int("pulocationid").alias("pickup_zone_id"),
        _to_int("dolocationid").alias("dropoff_zone_id"),
        _to_int("passenger_count").alias("passenger_count"),
        F.col("trip_distance").cast("double").alias("trip_distance"),
        F.col("total_amount").cast("double").alias("total_amount"),
        F.col("_source_month").alias("source_month"),
    )
    if max_passengers is not None:
        out = out.where(F.col("passenger_count").isNull()
                        | F.col("passenger_count").between(0, max_passengers))
    return out


def month_consistency_rejects(bronze: DataFrame) -> DataFrame:
    """Rows that pass F1-F3 but whose pickup month differs from the file month,
    counted per (source month, pickup month)."""
    pickup = F.col("tpep_pickup_datetime").cast("timestamp_ntz")
    amount, dist = F.col("total_amount"), F.col("trip_distance")
    base = ((amount > 0) & ~F.isnan(amount) & (dist > 0) & ~F.isnan(dist) & pickup.isNotNull())
    return (bronze.where(base & (month_text(pickup) != F.col("_source_month")))
            .groupBy(F.col("_source_month").alias("source_month"),
                     month_text(pickup).alias("pickup_month"))
            .agg(F.count(F.lit(1)).alias("rejected_rows")))


def lineage_counts(bronze: DataFrame) -> DataFrame:
    """Rows per (dataset, source month) as landed."""
    return (bronze.groupBy(F.col("_source_dataset").alias("source_dataset"),
                           F.col("_source_month").alias("source_month"))
            .agg(F.count(F.lit(1)).alias("row_count")))
