"""Source freshness: how old the newest landed file and the newest reading of each source are.

Both come from listings: the files' modification times and names, and the month partitions of the bronze table.  No data file
is opened.  A source without files is stale.
"""
from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.operators.quality import QualityError
from kerbside.storage import names_in

COLUMNS = "source string, files long, newest_month string, newest_file timestamp, age_hours double, fresh boolean"


def landed_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, modified, bytes) of all files under ``root``, from the listing; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return files.select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("bytes"))


def freshness(spark: SparkSession, sources: dict[str, str], now: dt.datetime, bound: dt.timedelta) -> DataFrame:
    """One row per source (name -> landing folder): its files, the newest month in a file name, the newest file's time and age in hours at ``now``
    (UTC), and whether that age is within ``bound``.  A file from after ``now`` has age 0."""
    rows = None
    for name, root in sources.items():
        if names_in(spark, root):
            files = landed_files(spark, root)
            month = F.regexp_extract("path", r"(\d{4}-\d{2})[^/0-9]*(?:/|$)", 1)
            own = files.agg(F.count(F.lit(1)).alias("files"), F.max(F.nullif(month, F.lit(""))).alias("newest_month"),
                            F.max("modified").alias("newest_file"))
        else:
            own = spark.range(1).select(F.lit(0).cast("long").alias("files"), F.lit(None).cast("string").alias("newest_month"),
                                        F.lit(None).cast("timestamp").alias("newest_file"))
        own = own.select(F.lit(name).alias("source"), "*")
        rows = own if rows is None else rows.unionByName(own)
    if rows is None:
        return spark.createDataFrame([], COLUMNS)
    at = F.lit(now.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")
    seconds = (F.unix_micros(at) - F.unix_micros("newest_file")) / 1_000_000
    age = F.when(seconds > 0, seconds / 3600).when(seconds <= 0, F.lit(0.0))
    return rows.select("source", "files", "newest_month", "newest_file", age.alias("age_hours"),
                       F.coalesce(age <= bound.total_seconds() / 3600, F.lit(False)).alias("fresh"))


def gate_freshness(report: DataFrame) -> list:
    """The report's rows (one a source); raises :class:`QualityError` naming the stale sources."""
    rows = report.collect()
    stale = [("freshness", r["source"]) for r in rows if not r["fresh"]]
    if stale:
        raise QualityError("stale sources: " + ", ".join(s for _, s in stale), stale)
    return rows
