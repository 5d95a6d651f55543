"""Bronze landing as an incremental file stream.

The landing job of the reference appends each monthly file to bronze.  As a
Structured Streaming query over the landing folder with
``trigger(availableNow=True)``, every landed file is picked up exactly once
across runs (the checkpoint records processed files), so a re-run lands
nothing twice and a new month lands only itself.  The parquet sink is
transactional per micro-batch (its ``_spark_metadata`` log), and readers of
the bronze folder only see committed batches.

``maxFilesPerTrigger`` bounds a micro-batch, so a backlog of thousands of
files is processed in several bounded batches rather than one huge one.
"""
from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.sources.trips import FILE_PATTERN, lower_case_columns


def ingest_landed_trips(spark: SparkSession, landing_glob: str, bronze_path: str,
                        checkpoint_path: str, schema: T.StructType,
                        max_files_per_trigger: int = 64) -> int:
    """Land every not-yet-seen trip file matching ``landing_glob`` into bronze.

    A file whose name is not that of a trip file fails the query.  The stream
    appends: a corrected month landed again adds its rows, and a bronze folder
    belongs either to this stream or to the batch writer, which replaces months.
    Returns the number of micro-batches in the query's progress that carried data
    (the last hundred at most).
    """
    stream = (spark.readStream.schema(schema)
              .option("maxFilesPerTrigger", max_files_per_trigger)
              .option("recursiveFileLookup", "true")
              .parquet(landing_glob))
    path = F.col("_metadata.file_path")
    def named(group: int):
        part = F.regexp_extract(path, FILE_PATTERN, group)
        return F.when(part != "", part).otherwise(
            F.raise_error(F.concat(F.lit("not a trip file name: "), path)))

    rows = lower_case_columns(stream).select(
        "*", named(1).alias("_source_dataset"), named(2).alias("_source_month"))
    q = (rows.writeStream.format("parquet")
         .option("checkpointLocation", checkpoint_path)
         .partitionBy("_source_month")
         .trigger(availableNow=True)
         .start(bronze_path))
    q.awaitTermination()
    return sum(1 for p in q.recentProgress if p.get("numInputRows", 0) > 0)
