"""Compaction: day partitions of many small files become a few files of a target size.

What is to be done follows from the file listing alone: a partition is rewritten when it has more files than its bytes need.
All of them are rewritten by one job into a folder beside the table, in files of about the target size
(AQE merges and splits the shuffle's blocks to it), and then each partition's folder takes the place of the old one.  Readers see the old
or the new files of a partition, never both; a job that dies leaves the old ones.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.storage import move_folder, partition_values, remove_folder

TARGET_BYTES = 128 << 20


@dataclass(frozen=True)
class Compacted:
    partitions: int
    files_before: int
    files_after: int


def listing(spark: SparkSession, path: str, column: str) -> DataFrame:
    """(value, files, bytes) of each partition folder, from a distributed listing of the files."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
    value = F.url_decode(F.regexp_extract("path", f"/{column}=([^/]*)/", 1))
    return files.select(value.alias("value"), "length").groupBy("value").agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))


def compact(spark: SparkSession, path: str, column: str, target_bytes: int = TARGET_BYTES) -> Compacted:
    """Rewrite the partitions of the table at ``path`` that have more files than ceil(bytes / target).

    What is fetched is a row a partition.  Rows are neither changed nor reordered across partitions.
    """
    path = path.rstrip("/")
    before = {r["value"]: r for r in listing(spark, path, column).collect()}
    wanted = sorted(v for v, r in before.items() if r["files"] > max(1, -(-r["bytes"] // target_bytes)))
    if not wanted:
        return Compacted(0, sum(r["files"] for r in before.values()), sum(r["files"] for r in before.values()))
    stage = f"{path}__compacting"
    key, packed = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.minPartitionSize"
    old = {k: spark.conf.get(k) for k in (key, packed)}
    try:
        spark.conf.set(key, str(target_bytes))
        spark.conf.set(packed, str(target_bytes))
        rows = spark.read.option("basePath", path).parquet(*[f"{path}/{column}={v}" for v in wanted])
        (rows.hint("rebalance", column).write.mode("overwrite").option("partitionOverwriteMode", "static")
         .partitionBy(column).parquet(stage))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    for value in partition_values(spark, stage, column):
        move_folder(spark, f"{stage}/{column}={value}", f"{path}/{column}={value}")
    remove_folder(spark, stage)
    after = sum(r["files"] for r in listing(spark, path, column).collect())
    return Compacted(len(wanted), sum(r["files"] for r in before.values()), after)
