"""Table writers.

Tables are Parquet folders.  Overwrites that must touch only some partitions
use dynamic partition overwrite; full refreshes use static overwrite so stale
partitions disappear.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from kerbside.config import LakeConfig, small_write_tasks
from kerbside.sources.trips import LANDED_FILE_KEY
from kerbside.storage import remove_folder


def write_bronze(df: DataFrame, path: str, partition_cols=("_source_month",),
                 mode: str = "replace") -> str:
    """Land a bronze batch.

    ``mode="replace"`` (default) rewrites only the source-month partitions present
    in ``df``: re-ingesting a month is idempotent instead of duplicating it.
    ``mode="append"`` keeps the append-only behaviour (re-runs duplicate rows).
    """
    if mode not in ("replace", "append"):
        raise ValueError("mode must be 'replace' or 'append'")
    cols = list(partition_cols or [])
    if cols:
        # One shuffle groups rows by partition so each month is written by a
        # few tasks (AQE splits a hot month and merges small ones).
        df = df.hint("rebalance", *cols)
    w = df.write
    if mode == "replace":
        w = w.mode("overwrite").option("partitionOverwriteMode", "dynamic" if cols else "static")
    else:
        w = w.mode("append")
    if cols:
        w = w.partitionBy(*cols)
    with small_write_tasks(df.sparkSession):
        w.parquet(path)
    return path


def write_layer(df: DataFrame, cfg: LakeConfig, layer: str, name: str,
                partition_by: list[str] | None = None, replace: str = "static") -> str:
    """Write ``layer.name``.  ``replace="static"`` is a full refresh (the old
    table is replaced); ``"dynamic"`` replaces only the partitions in ``df``."""
    if replace not in ("static", "dynamic"):
        raise ValueError("replace must be 'static' or 'dynamic'")
    path = cfg.path(layer, name)
    out = df.hint("rebalance", *partition_by) if partition_by else df
    w = out.write.mode("overwrite").option("partitionOverwriteMode", replace)
    if partition_by:
        w = w.partitionBy(*partition_by)
    with small_write_tasks(df.sparkSession):
        w.parquet(path)
    return path


def write_day_partitioned(df: DataFrame, path: str, day_col: str = "pickup_date",
                          replace: str = "dynamic") -> str:
    """Write by day.  ``replace="dynamic"`` replaces only the days in ``df``;
    ``"static"`` replaces the whole table."""
    with small_write_tasks(df.sparkSession):
        (df.hint("rebalance", day_col).write.mode("overwrite")
         .option("partitionOverwriteMode", replace).partitionBy(day_col).parquet(path))
    return path


def publish_view(df: DataFrame, name: str) -> DataFrame:
    """A view materialisation (session-scoped)."""
    df.createOrReplaceTempView(name)
    return df


def land_files(df: DataFrame, root: str, file_name: Column, fmt: str = "parquet",
               drop: tuple[str, ...] = ()) -> str:
    """Land rows as named files in one job: one folder per ``file_name`` value,
    ``{root}/_landed_file={name}/``; columns in ``drop`` are left out of the
    files.  Names present in ``df`` are replaced, so landing a file again does
    not duplicate it.  A folder of a large name has several files, so that many tasks read it."""
    out = df.withColumn(LANDED_FILE_KEY, file_name).drop(*drop).hint("rebalance", LANDED_FILE_KEY)
    with small_write_tasks(df.sparkSession):
        (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(LANDED_FILE_KEY).format(fmt).save(root))
    return root


def remove_partitions(spark: SparkSession, path: str, column: str, values: list) -> None:
    """Delete partitions of a table that a rebuild left without rows (dynamic
    overwrite only replaces the partitions it writes)."""
    for value in values:
        remove_folder(spark, f"{path.rstrip('/')}/{column}={value}")
