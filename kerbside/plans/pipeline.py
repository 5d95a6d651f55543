"""Bronze -> gate -> silver -> dims / snapshot -> fact -> mart, with tests in between.

A plain function, one Spark application; scheduling stays outside.  Each
layer is written and read back (materialise once, read many), and each table's
tests run right after it is written: a failing test raises, and no later table is
written or registered.

A batch is landed beside bronze and swapped in after the gate and the bronze tests passed, so nothing bad goes
live; one that fails waits there and is checked again by the next run.  Months that were swapped in
but not built to the end (a failing test, a lost driver) are noted as pending, and the next run builds them with its own
(see :mod:`kerbside.sinks.landing`).  The zone history is written in versions (:mod:`kerbside.sinks.versions`).

A run replaces months.  Silver's source month is the pickup month, so the silver, fact and mart
partitions of the landed months depend on those months alone; they are rebuilt one month at a time,
whatever their order, and partitions left without rows are removed.  The cost follows
the batch and what earlier runs left, and the result equals a full rebuild.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.config import LakeConfig, apply_session_defaults, sized_shuffles
from kerbside.functions.temporal import month_text, parse_weather_time
from kerbside.operators import dimensions, marts, merge, quality, scd2, silver
from kerbside.sinks import landing
from kerbside.sinks.versions import write_version
from kerbside.sinks.writers import remove_folder, remove_partitions, write_layer
from kerbside.schemas import FACT_DATE_KEYS, FACT_TRIPS, SILVER_TRIPS
from kerbside.sources.lake import (
    MissingTableError,
    partition_listing_only,
    read_table,
    stored_bytes,
    table_exists,
)

ZONE_CHECK_COLUMNS = ["borough", "zone_name", "service_zone"]


def months_of(df: DataFrame, month) -> list[str]:
    """Distinct months of a frame, one row a calendar month."""
    return sorted(r.m for r in df.select(month.alias("m")).distinct().where("m IS NOT NULL").collect())


def stored_months(spark: SparkSession, df: DataFrame, column: str) -> list[str]:
    """Month partitions of a stored table, from its partition listing."""
    with partition_listing_only(spark):
        return months_of(df, F.col(column))


def edge_months(spark: SparkSession, silver_t: DataFrame) -> DataFrame:
    """The first and the last month partition of silver.

    A silver row's pickup month is its source month, so the earliest and the
    latest pickup (the bounds of the date spine) lie in those two partitions;
    the month list comes from the partition listing, not from the data.
    """
    with partition_listing_only(spark):
        b = silver_t.agg(F.min("source_month").alias("lo"), F.max("source_month").alias("hi")).first()
    if b.lo is None:
        return silver_t
    return silver_t.where(F.col("source_month").isin(b.lo, b.hi))


class TestLog:
    """Runs tables' tests as they are written; raises at the first table that fails one."""

    __test__ = False

    def __init__(self, stop: bool):
        self.stop, self.count, self.failed = stop, 0, []

    def run(self, table: str, results: DataFrame) -> None:
        rows = results.collect()
        self.count += len(rows)
        failed = [(table, r["check_name"], r["column_name"]) for r in rows if not r["success"]]
        self.failed += [f"{t}.{column}:{check}" for t, check, column in failed]
        if failed and self.stop:
            raise quality.QualityError(f"build tests failed: {self.failed}",
                                       [(check, f"{t}.{column}") for t, check, column in failed])

    def table(self, table: str, df: DataFrame) -> None:
        self.run(table, quality.run_suite(df, quality.table_checks(table)))


def _replace_months(spark: SparkSession, cfg: LakeConfig, layer: str, name: str, column: str,
                    months: list[str], build: Callable[[str], DataFrame],
                    rows: Callable[[str], DataFrame]) -> None:
    """Write each month's partition of ``layer.name``; remove it when the month has no ``rows``."""
    path = cfg.path(layer, name)
    for month in months:
        if rows(month).isEmpty():
            remove_partitions(spark, path, column, [month])
        else:
            write_layer(build(month), cfg, layer, name, partition_by=[column], replace="dynamic")
    if not table_folder_exists(spark, path):
        write_layer(build(""), cfg, layer, name, partition_by=[column])


def table_folder_exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def run_pipeline(spark: SparkSession, cfg: LakeConfig, trips: DataFrame, weather: DataFrame,
                 zones: DataFrame | None = None, as_of=None, fact_mode: str = "months",
                 backfill: tuple | None = None, fail_on_tests: bool = True,
                 register: bool = False, incremental: bool = True,
                 catalog_prefix: str = "") -> dict:
    """Run the daily build over landed bronze batches and return a summary.

    ``incremental=False`` rebuilds every month of bronze instead of the landed ones.
    ``fact_mode``: ``months`` (replace the fact's days of those months), ``watermark`` or ``backfill``
    (see :mod:`kerbside.operators.merge`).  Datasets other than yellow end after bronze.
    """
    apply_session_defaults(spark)
    landing.land(trips, cfg, cfg.bronze_trips)
    landing.land(weather, cfg, "weather_hourly")
    if cfg.dataset != "yellow":
        months = landing.landed_months(spark, cfg, cfg.bronze_trips)
        landing.swap_in(spark, cfg, cfg.bronze_trips)
        landing.swap_in(spark, cfg, "weather_hourly")
        return {"months": months, "tests": 0, "failed_tests": [], "fact_load": None}
    log = TestLog(fail_on_tests)
    trip_months, weather_months, bronze_t, bronze_w = _accept(spark, cfg, log, incremental)

    if zones is not None:
        if as_of is None:
            raise ValueError("as_of is required when a zone extract is given")
        hist = (read_table(spark, cfg, "snapshots", "zone_snapshot")
                if table_exists(spark, cfg, "snapshots", "zone_snapshot") else None)
        new_hist = scd2.scd2_apply(hist, zones, "zone_id", ZONE_CHECK_COLUMNS, as_of,
                                   check_unique="in_plan")
        write_version(new_hist, cfg.path("snapshots", "zone_snapshot"))
    write_layer(dimensions.zone_dimension(read_table(spark, cfg, "snapshots", "zone_snapshot")),
                cfg, "gold", "dim_zone")
    log.table("dim_zone", read_table(spark, cfg, "gold", "dim_zone"))

    # one month's rows at a time: the shuffle is sized by the largest month
    root = cfg.path("bronze", cfg.bronze_trips)
    widest = max((stored_bytes(spark, [f"{root}/_source_month={m}"]) for m in trip_months), default=0)
    with sized_shuffles(spark, widest):
        def clean(month: str) -> DataFrame:
            return silver.clean_trips(bronze_t, months=[month])

        _replace_months(spark, cfg, "silver", "stg_yellow_trips", "source_month", trip_months,
                        clean, clean)
        silver_t = read_table(spark, cfg, "silver", "stg_yellow_trips", schema=SILVER_TRIPS)

        write_layer(dimensions.date_dimension(edge_months(spark, silver_t)), cfg, "gold", "dim_date")
        dim_date = read_table(spark, cfg, "gold", "dim_date")
        log.table("dim_date", dim_date)
        write_layer(dimensions.weather_dimension(bronze_w), cfg, "gold", "dim_weather")
        log.table("dim_weather", read_table(spark, cfg, "gold", "dim_weather"))

        fact_path = cfg.path("gold", "fact_trips")
        if fact_mode == "months":
            load = merge.replace_months(spark, silver_t, fact_path, trip_months)
            touched = month_text("pickup_date").isin(trip_months)
        elif fact_mode == "backfill":
            load = merge.load_fact(spark, silver_t, fact_path, "backfill", *backfill)
            touched = F.col("pickup_date").between(*[F.lit(str(d)).cast("date") for d in backfill])
        else:
            load = merge.load_fact(spark, silver_t, fact_path, "watermark")
            touched = F.col("pickup_date") > F.lit(load.get("after") or merge.EPOCH)
        if load["mode"] == "create" or not incremental:
            touched = F.lit(True)
        # A trip_key fixes its day, so tests of the rewritten days are tests of the change; the
        # relationship test covers all days, from the date keys kept per day.
        fact_t = read_table(spark, cfg, "gold", "fact_trips", schema=FACT_TRIPS)
        _refresh_date_keys(spark, cfg, fact_t, touched)
        log.table("fact_trips", fact_t.where(touched))
        date_keys = read_table(spark, cfg, "gold", "fact_trips_date_keys", schema=FACT_DATE_KEYS)
        log.run("fact_trips", quality.run_suite(
            date_keys, quality.table_checks("fact_trips_date_keys", dim_date, "n")))

        _replace_months(spark, cfg, "gold", "mart_zone_hourly_demand", marts.MONTH_COLUMN,
                        sorted({*trip_months, *weather_months}),
                        lambda month: marts.zone_hourly_demand_months(silver_t, bronze_w, [month]),
                        lambda month: silver_t.where(F.col("source_month") == F.lit(month)))

    landing.clear_pending(spark, cfg, "trips", trip_months)
    landing.clear_pending(spark, cfg, "weather", weather_months)
    if register:
        from kerbside.sinks.catalog import register_lake
        register_lake(spark, cfg, catalog_prefix)
    return {"fact_load": load, "tests": log.count, "failed_tests": log.failed, "months": trip_months}


def _accept(spark: SparkSession, cfg: LakeConfig, log: TestLog,
            incremental: bool) -> tuple[list[str], list[str], DataFrame, DataFrame]:
    """Gate and test bronze as it would be with the landed months, swap them in, and say which months are to be built.

    The gate's counts are kept per source month: the landed and the pending months are counted, the others'
    counts are those stored, and the sum equals a full scan.  A lake without counts is counted in full.
    """
    trips, weather = cfg.bronze_trips, "weather_hourly"
    landed_w = landing.landed_rows(spark, cfg, weather)
    new_w = months_of(landed_w, month_text(parse_weather_time("observed_at"))) if landed_w is not None else []
    new_t = landing.landed_months(spark, cfg, trips)
    months = sorted({*new_t, *landing.pending(spark, cfg, "trips")})
    weather_months = sorted({*new_w, *landing.pending(spark, cfg, "weather")})

    suite = quality.bronze_trip_suite()
    after = landing.with_landed(spark, cfg, trips)
    counted = incremental and table_exists(spark, cfg, "bronze", "yellow_trips_profile")
    if after is None:
        quality.gate_bronze(spark, None)
    else:
        rows = after.where(F.col("_source_month").isin(months)) if counted else after
        counts_path = landing.landing_path(cfg, "yellow_trips_profile")
        counts = quality.suite_partials(rows, suite, "_source_month")
        counts.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(counts_path)
        profile = fresh = spark.read.schema(counts.schema).parquet(counts_path)
        if counted:
            kept = read_table(spark, cfg, "bronze", "yellow_trips_profile")
            others = F.col("_source_month").isNull() | ~F.col("_source_month").isin(months)
            profile = kept.where(others).unionByName(fresh.select(*kept.columns))
        quality.gate_bronze(spark, after, profile=profile)
        log.run("bronze_yellow_trips", quality.run_suite_from_partials(
            profile, quality.table_checks("bronze_yellow_trips")))
    after_w = landing.with_landed(spark, cfg, weather)
    if after_w is None:
        raise MissingTableError("missing table bronze.weather_hourly")
    log.table("bronze_weather_hourly", after_w)

    landing.mark_pending(spark, cfg, "trips", new_t)
    landing.mark_pending(spark, cfg, "weather", new_w)
    landing.swap_in(spark, cfg, trips)
    landing.swap_in(spark, cfg, weather)
    if not counted or months:
        write_layer(fresh, cfg, "bronze", "yellow_trips_profile", partition_by=["_source_month"],
                    replace="dynamic" if counted else "static")
    remove_folder(spark, counts_path)
    bronze_t, bronze_w = _bronze(spark, cfg), read_table(spark, cfg, "bronze", weather)
    if not incremental:
        months = stored_months(spark, bronze_t, "_source_month")
        weather_months = months_of(bronze_w, month_text(parse_weather_time("observed_at")))
    return months, weather_months, bronze_t, bronze_w


def _bronze(spark: SparkSession, cfg: LakeConfig) -> DataFrame | None:
    """Bronze trips, or None when the table is missing (the gate's first check)."""
    try:
        return read_table(spark, cfg, "bronze", cfg.bronze_trips)
    except MissingTableError:
        return None


def _refresh_date_keys(spark: SparkSession, cfg: LakeConfig, fact_t: DataFrame, touched) -> None:
    """The fact's date keys per day, recounted for the days a load touched; days that are gone go."""
    path = cfg.path("gold", "fact_trips_date_keys")
    kept = table_folder_exists(spark, path)
    rows = fact_t.where(touched) if kept else fact_t
    write_layer(quality.key_profile(rows, "pickup_date_key", "pickup_date"), cfg, "gold",
                "fact_trips_date_keys", partition_by=["pickup_date"],
                replace="dynamic" if kept else "static")
    if kept:
        stored = read_table(spark, cfg, "gold", "fact_trips_date_keys", schema=FACT_DATE_KEYS)
        with partition_listing_only(spark):
            gone = (stored.select("pickup_date").distinct()
                    .join(fact_t.select("pickup_date").distinct(), "pickup_date", "left_anti").collect())
        remove_partitions(spark, path, "pickup_date", [r[0] for r in gone])
