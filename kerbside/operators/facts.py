"""Silver -> trip fact."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.functions.keys import date_key, hour_key, trip_key
from kerbside.functions.temporal import elapsed_minutes
from kerbside.schemas import FACT_COLUMNS


def keyed_trips(silver: DataFrame) -> DataFrame:
    """F5 + keys: trips whose dropoff is not before pickup, with the natural
    key, the day, the smart date/hour keys and the duration in minutes."""
    s = silver.where(F.col("dropoff_ts") >= F.col("pickup_ts"))
    return s.select(
        trip_key().alias("trip_key"),
        F.to_date("pickup_ts").alias("pickup_date"),
        date_key("pickup_ts").alias("pickup_date_key"),
        hour_key("pickup_ts").alias("pickup_weather_key"),
        "pickup_zone_id", "dropoff_zone_id", "pickup_ts", "dropoff_ts",
        elapsed_minutes("pickup_ts", "dropoff_ts").alias("trip_minutes"),
        "passenger_count", "trip_distance", "total_amount",
    )


def dedupe_trips(keyed: DataFrame) -> DataFrame:
    """One row per ``trip_key``.

    Every fact column is a function of the key's parts, so all rows sharing a
    key are equal and keeping any one of them equals keeping the first by
    dropoff time.  Written as an aggregate rather than a ranked window so each
    map task collapses its copies *before* the shuffle: a key replayed
    millions of times costs one row per map task, not one hot reducer.
    """
    return keyed.dropDuplicates(["trip_key"]).select(*FACT_COLUMNS)


# The key is NULL exactly when one of its non-coalesced parts is NULL (concat
# propagates NULL, md5 of text never is).  Testing the parts keeps the filter
# on plain columns: no second MD5 per row, and it can reach the scan.
KEY_PARTS = ("pickup_ts", "dropoff_ts", "pickup_zone_id", "trip_distance", "total_amount")


def has_key() -> F.Column:
    cond = F.lit(True)
    for c in KEY_PARTS:
        cond = cond & F.col(c).isNotNull()
    return cond


def split_rejects(keyed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows without a key (no pickup zone) go to a reject output instead of
    silently collapsing into one row."""
    return keyed.where(has_key()), keyed.where(~has_key())


def build_fact(silver: DataFrame) -> DataFrame:
    """Full fact build from silver (rows with a NULL key excluded)."""
    ok, _ = split_rejects(keyed_trips(silver))
    return dedupe_trips(ok)


def fact_rejects(silver: DataFrame) -> DataFrame:
    _, rejected = split_rejects(keyed_trips(silver))
    return rejected


def duplicates_removed(silver: DataFrame) -> DataFrame:
    """Rows into and out of W1 (one summary row)."""
    keyed, _ = split_rejects(keyed_trips(silver))
    return keyed.agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.count_distinct("trip_key").alias("rows_out"),
    ).select("rows_in", "rows_out", (F.col("rows_in") - F.col("rows_out")).alias("removed"))
