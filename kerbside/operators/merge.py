"""Incremental fact maintenance on a day-partitioned Parquet table.

Without a transactional table format there is no ``MERGE INTO``; the same
results are built from DataFrame operations.

* **watermark** (S7): days after the target's last day are built and written straight
  into their new partitions.  A marker beside the target holds the watermark while they
  are written, so a load that dies half way is repeated from there.
* **backfill** (S9): the rows of an explicit day range are merged with the target's rows
  of that range by ``trip_key`` (a key maps to one day, so a key never moves between
  partitions), staged once and swapped in; the staged copy is removed.
* **month replacement**: a re-landed month is rebuilt from its silver month alone.  A silver
  row's source month is its pickup month and a ``trip_key`` fixes its day, so the fact days of
  a month depend on nothing else; days left without trips are removed.

Re-running any of them with the same input leaves the same rows.
"""
from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.config import staging_path
from kerbside.functions.temporal import month_text
from kerbside.operators.facts import build_fact, dedupe_trips, has_key, keyed_trips
from kerbside.schemas import FACT_COLUMNS, FACT_TRIPS
from kerbside.sinks.writers import remove_folder, remove_partitions, write_day_partitioned
from kerbside.sources.lake import partition_listing_only

EPOCH = dt.date(1900, 1, 1)
DAY = "pickup_date"


def read_target(spark: SparkSession, target: str) -> DataFrame | None:
    try:
        return spark.read.schema(FACT_TRIPS).parquet(target)
    except AnalysisException:
        return None


def _marker(target: str) -> str:
    return f"{target.rstrip('/')}__loading"


def watermark(spark: SparkSession, target: str) -> dt.date | None:
    """Last pickup day up to which the target is complete, or None when it does not exist.

    ``max`` of the partition column is answered from the partition listing
    (one row per day), so no data file of the fact is opened.  While a load is
    unfinished, the watermark is the one that load began with.
    """
    t = read_target(spark, target)
    if t is None:
        return None
    with partition_listing_only(spark):
        last = t.agg(F.max(DAY)).first()[0]
    try:
        begun = spark.read.schema("after date").parquet(_marker(target)).first()
    except AnalysisException:
        begun = None
    return min(last, begun["after"]) if begun and last else last


def _month(d: dt.date) -> str:
    return f"{d.year:04d}-{d.month:02d}"


def incremental_source(silver: DataFrame, last_day: dt.date | None) -> DataFrame:
    """Silver rows whose pickup day is after the watermark.

    A silver row's source month is its pickup month, so the day predicate
    implies ``source_month >= month(watermark)``; stated as well, it prunes
    the month partitions of silver that cannot hold newer days.
    """
    w = last_day or EPOCH
    return silver.where((F.col("source_month") >= F.lit(_month(w)))
                        & (F.to_date("pickup_ts") > F.lit(w)))


def _day(value) -> dt.date:
    return dt.date.fromisoformat(str(value))


def backfill_source(silver: DataFrame, first_day, last_day) -> DataFrame:
    a, b = _day(first_day), _day(last_day)
    return silver.where(F.col("source_month").between(F.lit(_month(a)), F.lit(_month(b)))
                        & F.to_date("pickup_ts").between(F.lit(a), F.lit(b)))


def merge_into(spark: SparkSession, new_rows: DataFrame, target: str, first_day, last_day) -> dict:
    """Upsert the fact rows of a day range into the day-partitioned ``target`` by ``trip_key``.

    A missing target is simply written.  The range is the partition filter on the
    target, so only its days are read and rewritten.
    """
    new_rows = new_rows.select(*FACT_COLUMNS)
    existing = read_target(spark, target)
    if existing is None:
        write_day_partitioned(new_rows, target, DAY, replace="static")
        return {"mode": "create"}
    old = existing.where(F.col(DAY).between(F.lit(_day(first_day)), F.lit(_day(last_day))))
    stage = staging_path(spark, "fact-merge")
    write_day_partitioned(dedupe_trips(old.select(*FACT_COLUMNS).unionByName(new_rows)),
                          stage, DAY, replace="static")
    staged = spark.read.schema(FACT_TRIPS).parquet(stage).select(*FACT_COLUMNS)
    write_day_partitioned(staged, target, DAY, replace="dynamic")
    remove_folder(spark, stage)
    return {"mode": "merge", "first_day": _day(first_day), "last_day": _day(last_day)}


def append_days(spark: SparkSession, new_rows: DataFrame, target: str, after: dt.date) -> dict:
    """Write fact rows whose days all come after ``after``, the target's watermark.

    No such day is complete in the target, so there is nothing to merge with: the rows go
    straight into their day partitions (dynamic overwrite, one write, no staging).
    """
    marker = spark.createDataFrame([(after,)], "after date")
    marker.write.mode("overwrite").parquet(_marker(target))
    write_day_partitioned(new_rows.select(*FACT_COLUMNS), target, DAY, replace="dynamic")
    remove_folder(spark, _marker(target))
    last = watermark(spark, target)
    return {"mode": "append" if last and last > after else "noop", "after": after, "last_day": last}


def replace_months(spark: SparkSession, silver: DataFrame, target: str, months: list[str]) -> dict:
    """Make the target's days of ``months`` those of silver's months, one month at a time, oldest first."""
    mode = "create" if read_target(spark, target) is None else "months"
    for month in sorted(months):
        own = silver.where(F.col("source_month") == F.lit(month))
        write_day_partitioned(build_fact(own).select(*FACT_COLUMNS), target, DAY, replace="dynamic")
        there = spark.read.schema(FACT_TRIPS).parquet(target)
        with partition_listing_only(spark):
            held = {r[0] for r in there.where(month_text(DAY) == F.lit(month)).select(DAY).distinct().collect()}
        kept = {r[0] for r in keyed_trips(own).where(has_key()).select(DAY).distinct().collect()}
        remove_partitions(spark, target, DAY, sorted(held - kept))
    return {"mode": mode, "months": sorted(months)}


def load_fact(spark: SparkSession, silver: DataFrame, target: str, mode: str = "watermark",
              first_day=None, last_day=None) -> dict:
    """C5 load: ``watermark`` (days after the last loaded day, appended; full
    load when the target is missing) or ``backfill`` (an explicit day range,
    merged by ``trip_key``)."""
    if mode == "watermark":
        last = watermark(spark, target)
        rows = build_fact(incremental_source(silver, last))
        if last is not None:
            return append_days(spark, rows, target, last)
        write_day_partitioned(rows.select(*FACT_COLUMNS), target, DAY, replace="static")
        return {"mode": "create"}
    if mode != "backfill":
        raise ValueError("mode must be 'watermark' or 'backfill'")
    if first_day is None or last_day is None:
        raise ValueError("backfill needs first_day and last_day")
    rows = build_fact(backfill_source(silver, first_day, last_day))
    return merge_into(spark, rows, target, first_day, last_day)
