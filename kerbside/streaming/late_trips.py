"""Zone-hour demand from a stream of landed trips that come late, twice, or in any order.

* On time: a stateful query drops repeated trips by ``trip_key`` within the watermark and appends each micro-batch's trips to the
  table ``accepted``, one folder a batch.  A batch that is run again after a failure overwrites its own folder, so each trip
  is there once.
* Late: trips behind the watermark are dropped by the stateful operator, which says nothing of them.  After the stream has taken
  what has landed, the landed trips whose keys were not accepted are written to ``late``: what the watermark lost is set aside
  with its reason, not forgotten.
* Demand is additive: counts of accepted and late trips add up to those of a batch over everything, whatever the order of arrival.
"""
from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.functions.numeric import DEFAULT_SCALE
from kerbside.functions.temporal import trunc_hour
from kerbside.operators import facts, silver
from kerbside.sources.trips import FILE_PATTERN, lower_case_columns

TRIP_COLUMNS = ["trip_key", "pickup_ts", "pickup_zone_id", "total_amount"]
LATE_REASON = "behind the watermark"


def _trips(rows: DataFrame) -> DataFrame:
    """Keyed, clean trips of landed rows; lineage comes from the file names."""
    path = F.col("_metadata.file_path")
    named = lower_case_columns(rows).select("*", F.regexp_extract(path, FILE_PATTERN, 1).alias("_source_dataset"),
                                            F.regexp_extract(path, FILE_PATTERN, 2).alias("_source_month"))
    keyed = facts.keyed_trips(silver.clean_trips(named))
    return keyed.where(facts.has_key()).select(*TRIP_COLUMNS)


def take_landed(spark: SparkSession, landing: str, out: str, schema: T.StructType, delay: str = "1 hour",
                files_per_batch: int = 64) -> None:
    """Take every file that has landed since the last call, then set aside the late trips.  The stream's state is under ``out``."""
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
              .option("recursiveFileLookup", "true").parquet(landing))
    # event time must be a zoned timestamp for a watermark; sessions here run in UTC
    timed = _trips(stream).withColumn("_event", F.col("pickup_ts").cast("timestamp"))
    once = timed.withWatermark("_event", delay).dropDuplicatesWithinWatermark(["trip_key"])

    def append(batch: DataFrame, batch_id: int) -> None:
        (batch.select(*TRIP_COLUMNS).write.mode("overwrite").option("partitionOverwriteMode", "static")
         .parquet(f"{out}/accepted/batch={batch_id}"))

    query = (once.writeStream.foreachBatch(append).option("checkpointLocation", f"{out}/checkpoint")
             .trigger(availableNow=True).start())
    query.awaitTermination()
    _set_aside(spark, landing, out, schema)


def _accepted(spark: SparkSession, out: str) -> DataFrame | None:
    try:
        return spark.read.schema(_SCHEMA).option("recursiveFileLookup", "true").parquet(f"{out}/accepted")
    except AnalysisException:
        return None


_SCHEMA = T.StructType([T.StructField("trip_key", T.StringType()), T.StructField("pickup_ts", T.TimestampNTZType()),
                        T.StructField("pickup_zone_id", T.IntegerType()), T.StructField("total_amount", T.DoubleType())])


def _set_aside(spark: SparkSession, landing: str, out: str, schema: T.StructType) -> None:
    """Write the landed trips that were not accepted, each key once (copies are combined before the shuffle)."""
    landed = _trips(spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(landing)).dropDuplicates(["trip_key"])
    known = _accepted(spark, out)
    late = landed if known is None else landed.join(known.select("trip_key"), "trip_key", "left_anti")
    (late.select(*TRIP_COLUMNS, F.lit(LATE_REASON).alias("reason")).write.mode("overwrite")
     .option("partitionOverwriteMode", "static").parquet(f"{out}/late"))


def demand(spark: SparkSession, out: str, late: bool = True) -> DataFrame:
    """(pickup_zone_id, pickup_hour, trip_count, revenue) of the trips taken so far, by default with the late ones."""
    rows = _accepted(spark, out)
    if late:
        aside = spark.read.schema(_SCHEMA).parquet(f"{out}/late")
        rows = aside if rows is None else rows.unionByName(aside)
    if rows is None:
        rows = spark.createDataFrame([], _SCHEMA)
    return rows.groupBy("pickup_zone_id", trunc_hour("pickup_ts").alias("pickup_hour")).agg(
        F.count(F.lit(1)).alias("trip_count"),
        F.sum(F.col("total_amount").cast(f"decimal(28,{DEFAULT_SCALE})")).cast("double").alias("revenue"))
