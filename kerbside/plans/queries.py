"""The registered query catalogue: ``name -> (spark, sf_dir) -> DataFrame``.

Every query reads the driver tables of ``sf_dir`` whole (through the adapters
in :mod:`kerbside.sources.fixtures`) and runs the library operators on them.
The SQL oracle of each query is in :data:`ORACLE`.
"""
from __future__ import annotations

import datetime as dt
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.config import LakeConfig, apply_session_defaults, ensure_checkpoint_dir, staging_path
from kerbside.functions.keys import date_key, hour_key
from kerbside.functions.temporal import elapsed_minutes
from kerbside.operators import dimensions, facts, marts, merge, quality, scan_report, serving, silver
from kerbside.operators.scd2 import scd2_apply
from kerbside.schemas import MART_COLUMNS
from kerbside.sinks.writers import publish_view, write_bronze
from kerbside.sources.trips import read_trips
from kerbside.sources.weather import month_bounds_columns, read_landed_weather, unpack_hourly
from kerbside.sources.zones import read_zone_seed
from kerbside.plans.oracle import sql
from kerbside.sources import fixtures

Query = Callable[[SparkSession, str], DataFrame]

BENCH_DAY = dt.date(2024, 1, 15)
INCREMENTAL_MONTH = "2024-01"        # the month landed in two halves
INCREMENTAL_CUT = "2024-01-15"
DEMAND_ZONE = 7
AS_OF = fixtures.AS_OF_STAMPS
ZONE_CHECK_COLUMNS = ["borough", "zone_name", "service_zone"]


# --- shared building blocks ---------------------------------------------------

def _session(spark: SparkSession) -> SparkSession:
    return apply_session_defaults(spark)


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh folder under the session's shared checkpoint dir.  Only when
    the session names none (local runs, tests) is a local one installed."""
    if not spark.conf.get("spark.checkpoint.dir", None) and not spark.sparkContext.getCheckpointDir():
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder the whole cluster shares")
        ensure_checkpoint_dir(spark, tempfile.mkdtemp(prefix="kerbside-ckpt-"))
    return staging_path(spark, label)


def silver_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.clean_trips(fixtures.bronze_trips(_session(spark), sf_dir))


def fact_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.build_fact(silver_trips(spark, sf_dir))


def mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.zone_hourly_demand(silver_trips(spark, sf_dir),
                                    fixtures.bronze_weather(spark, sf_dir))


def zone_history(spark: SparkSession, sf_dir: str, versions: int = 3) -> DataFrame:
    """SCD2 history after applying zone versions 1..``versions`` at their stamps."""
    _session(spark)
    hist = None
    for v in range(1, versions + 1):
        hist = scd2_apply(hist, fixtures.zones_version(spark, sf_dir, 2 if v == 2 else 1),
                          "zone_id", ZONE_CHECK_COLUMNS, AS_OF[v - 1], check_unique="in_plan")
    return hist


def dim_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.zone_dimension(zone_history(spark, sf_dir))


# --- registered queries -------------------------------------------------------

def q_clean_trips(spark, sf_dir):
    return silver_trips(spark, sf_dir)


def q_lineage_counts(spark, sf_dir):
    return silver.lineage_counts(fixtures.bronze_trips(_session(spark), sf_dir))


def q_month_consistency_rejects(spark, sf_dir):
    return silver.month_consistency_rejects(fixtures.bronze_trips(_session(spark), sf_dir))


def q_zone_hourly_demand(spark, sf_dir):
    return mart(spark, sf_dir)


def q_top_zones(spark, sf_dir):
    return serving.top_zones(mart(spark, sf_dir), dim_zone(spark, sf_dir), 10)


def q_hourly_profile(spark, sf_dir):
    return serving.hourly_profile(mart(spark, sf_dir))


def q_daily_trips_vs_temperature(spark, sf_dir):
    return serving.daily_trips_vs_temperature(mart(spark, sf_dir))


def q_zone_demand_latest(spark, sf_dir):
    return serving.zone_demand(mart(spark, sf_dir), DEMAND_ZONE, 24)


def q_fact_trips(spark, sf_dir):
    return fact_trips(spark, sf_dir)


def q_single_day_revenue(spark, sf_dir):
    return serving.single_day_revenue(fact_trips(spark, sf_dir), BENCH_DAY)


def q_duplicates_removed(spark, sf_dir):
    return facts.duplicates_removed(silver_trips(spark, sf_dir))


def q_trip_keys(spark, sf_dir):
    k = facts.keyed_trips(silver_trips(spark, sf_dir))
    return k.select("trip_key", "pickup_ts", "dropoff_ts", "pickup_zone_id", "dropoff_zone_id",
                    "passenger_count", "trip_distance", "total_amount")


def q_smart_keys(spark, sf_dir):
    s = silver_trips(spark, sf_dir)
    return s.select("pickup_ts", date_key("pickup_ts").alias("pickup_date_key"),
                    hour_key("pickup_ts").alias("pickup_weather_key"))


def q_trip_minutes(spark, sf_dir):
    s = silver_trips(spark, sf_dir)
    return s.select("pickup_ts", "dropoff_ts",
                    elapsed_minutes("pickup_ts", "dropoff_ts").alias("trip_minutes"))


def q_fact_trips_volume(spark, sf_dir):
    return facts.build_fact(fixtures.volume_trips(_session(spark), sf_dir))


def q_dim_date(spark, sf_dir):
    return dimensions.date_dimension(silver_trips(spark, sf_dir))


def q_dim_weather(spark, sf_dir):
    return dimensions.weather_dimension(fixtures.bronze_weather(_session(spark), sf_dir))


def q_scd2_zone_history(spark, sf_dir):
    return zone_history(spark, sf_dir, 3)


def q_scd2_after_delete(spark, sf_dir):
    return zone_history(spark, sf_dir, 2)


def q_dim_zone_current(spark, sf_dir):
    return dim_zone(spark, sf_dir).where(F.col("is_current"))


def q_star_weather_demand(spark, sf_dir):
    weather = dimensions.weather_dimension(fixtures.bronze_weather(_session(spark), sf_dir))
    return serving.star_weather_demand(fact_trips(spark, sf_dir), weather)


def q_star_weekend_revenue(spark, sf_dir):
    s = silver_trips(spark, sf_dir)
    return serving.star_weekend_revenue(facts.build_fact(s), dimensions.date_dimension(s))


def q_fact_rejects(spark, sf_dir):
    return facts.fact_rejects(silver_trips(spark, sf_dir))


def q_month_bounds(spark, sf_dir):
    months = fixtures.bronze_trips(_session(spark), sf_dir).select(
        F.col("_source_month").alias("source_month")).distinct()
    first, last = month_bounds_columns("source_month")
    return months.select("source_month", first.alias("first_day"), last.alias("last_day"))


def q_weather_unpacked(spark, sf_dir):
    p = fixtures.weather_payloads(_session(spark), sf_dir)
    return unpack_hourly(p, F.col("month"))


def q_landed_trips_scan(spark, sf_dir):
    """Trips landed as one file per month, read back by ONE scan
    over every landed month; the lineage columns come from the file names."""
    root = scratch(spark, "landed-trips")
    fixtures.land_trip_files(_session(spark), sf_dir, root)
    return read_trips(spark, root, "yellow", spark_landed=True)


def q_weather_payload_scan(spark, sf_dir):
    """Monthly weather payload files -> one row per reading, kept
    within each file's month window."""
    root = scratch(spark, "landed-weather")
    fixtures.land_weather_payloads(_session(spark), sf_dir, root)
    return read_landed_weather(spark, root, spark_landed=True)


def q_zone_seed_scan(spark, sf_dir):
    """The zone lookup written as the quoted seed CSV and read back."""
    path = scratch(spark, "zone-seed")
    fixtures.write_zone_seed(_session(spark), sf_dir, path)
    return read_zone_seed(spark, path)


def q_sql_mart_over_views(spark, sf_dir):
    """Silver and bronze weather published as views (catalog objects that
    SQL and ``spark.table`` resolve by name); the mart is built from the views."""
    publish_view(silver_trips(spark, sf_dir), "stg_yellow_trips")
    publish_view(fixtures.bronze_weather(spark, sf_dir), "bronze_weather_hourly")
    return marts.zone_hourly_demand(spark.table("stg_yellow_trips"),
                                    spark.table("bronze_weather_hourly"))


def q_quality_report(spark, sf_dir):
    return quality.run_suite(fixtures.bronze_trips(_session(spark), sf_dir),
                             quality.bronze_trip_suite())


def q_quality_report_from_profile(spark, sf_dir):
    """Q5 from per-month counts: the suite's counts kept per source month and
    summed equal the full-table suite."""
    suite = quality.bronze_trip_suite()
    partials = quality.suite_partials(fixtures.bronze_trips(_session(spark), sf_dir), suite,
                                      "_source_month")
    return quality.run_suite_from_partials(partials, suite)


def q_quality_report_dirty(spark, sf_dir):
    return quality.run_suite(fixtures.dirty_bronze_trips(_session(spark), sf_dir),
                             quality.bronze_trip_suite())


def _tables(spark, sf_dir, weather=None) -> dict:
    """The tested tables, made only when a test asks for them."""
    w = weather or fixtures.bronze_weather
    return {
        "fact_trips": lambda: fact_trips(spark, sf_dir),
        "dim_date": lambda: dimensions.date_dimension(silver_trips(spark, sf_dir)),
        "dim_weather": lambda: dimensions.weather_dimension(w(spark, sf_dir)),
        "dim_zone": lambda: dim_zone(spark, sf_dir),
        "bronze_yellow_trips": lambda: fixtures.bronze_trips(spark, sf_dir),
        "bronze_weather_hourly": lambda: w(spark, sf_dir),
    }


def q_build_tests(spark, sf_dir):
    """The 17 tests; the fact is built and written once, and each test reads it."""
    path = scratch(_session(spark), "fact-tested")
    fact_trips(spark, sf_dir).write.parquet(path)
    return quality.build_tests(_tables(spark, sf_dir) | {"fact_trips": spark.read.parquet(path)})


def q_build_tests_dirty(spark, sf_dir):
    """Q7-Q10 on a fact with NaN and negative amounts, missing zones, orphan date keys and a repeated key."""
    path = scratch(_session(spark), "fact-dirty")
    fixtures.dirty_fact(fact_trips(spark, sf_dir)).write.parquet(path)
    return quality.build_tests(_tables(spark, sf_dir) | {"fact_trips": spark.read.parquet(path)})


def q_fact_rejects_dirty(spark, sf_dir):
    """Trips of a zone that the source left out: no key, so they are rejects."""
    zone = F.col("pickup_zone_id")
    s = silver_trips(spark, sf_dir).withColumn("pickup_zone_id", F.when(zone != 3, zone))
    return facts.fact_rejects(s)


def q_gate_failed_checks(spark, sf_dir):
    """Q6: what the gate's error names on the corrupted load."""
    try:
        quality.gate_bronze(spark, fixtures.dirty_bronze_trips(_session(spark), sf_dir))
        failed = []
    except quality.QualityError as error:
        failed = error.failed
    return spark.createDataFrame(failed, "check_name string, column_name string")


def q_gate_missing_table(spark, sf_dir):
    """Q1: the gate on bronze before and after the trips land."""
    from kerbside.plans.pipeline import _bronze
    cfg = LakeConfig(scratch(_session(spark), "gate-lake"))
    seen = []
    for step in ("before", "after"):
        if step == "after":
            write_bronze(fixtures.bronze_trips(spark, sf_dir), cfg.path("bronze", cfg.bronze_trips))
        try:
            rows = quality.gate_bronze(spark, _bronze(spark, cfg))
            seen.append((step, True, int(rows[0]["observed"])))
        except quality.QualityError:
            seen.append((step, False, 0))
    return spark.createDataFrame(seen, "step string, passed boolean, row_count long")


def _build_test_kind(spark, sf_dir, kinds: set[str]) -> DataFrame:
    _session(spark)
    return quality.build_tests(_tables(spark, sf_dir), kinds)


def q_dim_weather_faint(spark, sf_dir):
    """C3 on readings of thousandths: nothing is rounded away before it is averaged."""
    return dimensions.weather_dimension(fixtures.faint_weather(_session(spark), sf_dir))


def q_scd2_customer_history(spark, sf_dir):
    """J8 at volume: three customer extracts."""
    _session(spark)
    hist = None
    for v in (1, 2, 3):
        extract = fixtures.customer_version(spark, sf_dir, 2 if v == 2 else 1)
        hist = scd2_apply(hist, extract, "c_custkey", ["c_name", "c_mktsegment"], AS_OF[v - 1],
                          check_unique="in_plan")
    return hist


def q_landed_trips_drift(spark, sf_dir):
    """Months whose columns differ in type and number, read as one table."""
    root = scratch(spark, "landed-drift")
    fixtures.land_drifting_trip_files(_session(spark), sf_dir, root)
    return read_trips(spark, root, "yellow", spark_landed=True)


def q_not_null_report(spark, sf_dir):
    """Q8: the eleven not-null tests of the build."""
    return _build_test_kind(spark, sf_dir, {"not_null"})


def q_unique_violations(spark, sf_dir):
    """Q9: the four uniqueness tests (duplicated values per key)."""
    return _build_test_kind(spark, sf_dir, {"unique"})


def q_orphan_date_keys(spark, sf_dir):
    """Fact date keys missing from the date dimension."""
    return _build_test_kind(spark, sf_dir, {"relationship"})


def q_accepted_range_violations(spark, sf_dir):
    """Q7: fact amounts not above zero."""
    return _build_test_kind(spark, sf_dir, {"greater_than"})


def q_incremental_watermark(spark, sf_dir):
    """Load days up to the bench day, then select what the watermark lets in."""
    s = silver_trips(spark, sf_dir)
    target = scratch(spark, "fact-watermark")
    merge.load_fact(spark, s, target, "backfill", dt.date(1900, 1, 1), BENCH_DAY)
    return facts.build_fact(merge.incremental_source(s, merge.watermark(spark, target)))


def q_merge_idempotent(spark, sf_dir):
    """Watermark load run twice into one target: the second run adds nothing."""
    s = silver_trips(spark, sf_dir)
    target = scratch(spark, "fact-idempotent")
    merge.load_fact(spark, s, target, "watermark")
    merge.load_fact(spark, s, target, "watermark")
    return spark.read.parquet(target).select(*facts.FACT_COLUMNS)


def q_merge_backfill(spark, sf_dir):
    """Load the first 20 days, then the rest by watermark, then re-merge a
    backfill of days 10-15: the table equals one full build."""
    s = silver_trips(spark, sf_dir)
    target = scratch(spark, "fact-backfill")
    merge.load_fact(spark, s, target, "backfill", "1900-01-01", "2024-01-20")
    merge.load_fact(spark, s, target, "watermark")
    merge.load_fact(spark, s, target, "backfill", "2024-01-10", "2024-01-15")
    return spark.read.parquet(target).select(*facts.FACT_COLUMNS)


def q_scan_footprint(spark, sf_dir):
    """M1: the single-day query over the fact, unpartitioned vs by day."""
    fact = fact_trips(spark, sf_dir)
    flat = scratch(spark, "fact-flat")
    by_day = scratch(spark, "fact-by-day")
    fact.write.parquet(flat)
    fact.write.partitionBy("pickup_date").parquet(by_day)
    pred = F.col("pickup_date") == F.lit(BENCH_DAY)
    both = (scan_report.scan_footprint(spark, flat, pred, "unpartitioned")
            .unionByName(scan_report.scan_footprint(spark, by_day, pred, "pickup_date")))
    # file and byte counts follow the writer's tasks; the row figures are those of the data
    return both.select("layout", "rows_total", "rows_scanned", "rows_matched", "pct_filtered_after_read")


def q_bronze_replace_idempotent(spark, sf_dir):
    """Landing the same months twice leaves one copy of each."""
    path = scratch(spark, "bronze")
    trips = fixtures.bronze_trips(_session(spark), sf_dir)
    write_bronze(trips, path)
    write_bronze(trips, path)
    return spark.read.parquet(path)


def q_bronze_stream_ingest(spark, sf_dir):
    """Landed monthly files streamed into bronze twice: each file lands once."""
    from kerbside.streaming import ingest_landed_trips
    _session(spark)
    landing = scratch(spark, "landing")
    fixtures.land_trip_files(spark, sf_dir, landing)
    schema = spark.read.option("recursiveFileLookup", "true").parquet(landing).schema
    bronze, ckpt = scratch(spark, "bronze-stream"), scratch(spark, "bronze-stream-ckpt")
    ingest_landed_trips(spark, landing, bronze, ckpt, schema)
    ingest_landed_trips(spark, landing, bronze, ckpt, schema)
    return spark.read.parquet(bronze)


def _lake_tables(spark, cfg) -> dict:
    from kerbside.sources.lake import read_table
    names = {"fact_trips": "gold", "dim_date": "gold", "dim_weather": "gold", "dim_zone": "gold"}
    tables = {n: read_table(spark, cfg, layer, n) for n, layer in names.items()}
    return tables | {"bronze_yellow_trips": read_table(spark, cfg, "bronze", "yellow_trips"),
                     "bronze_weather_hourly": read_table(spark, cfg, "bronze", "weather_hourly")}


def q_pipeline_end_to_end(spark, sf_dir):
    """C12 over the fixtures into a scratch lake, run three times; the build tests
    are then re-evaluated on the written tables."""
    from kerbside.plans.pipeline import run_pipeline
    cfg = LakeConfig(scratch(_session(spark), "lake"))
    trips, weather = fixtures.bronze_trips(spark, sf_dir), fixtures.clean_weather(spark, sf_dir)
    for version, stamp in ((1, AS_OF[0]), (2, AS_OF[1]), (1, AS_OF[2])):
        run_pipeline(spark, cfg, trips, weather, fixtures.zones_version(spark, sf_dir, version), stamp)
    return quality.build_tests(_lake_tables(spark, cfg))


def q_pipeline_failing_build(spark, sf_dir):
    """Weather that landed twice fails its test; the batch waits beside bronze, and no table is written."""
    from kerbside.plans.pipeline import run_pipeline
    from kerbside.sinks.catalog import LAKE_TABLES
    from kerbside.sources.lake import table_exists
    cfg = LakeConfig(scratch(_session(spark), "failing-lake"))
    try:
        weather = fixtures.clean_weather(spark, sf_dir)
        run_pipeline(spark, cfg, fixtures.bronze_trips(spark, sf_dir), weather.unionByName(weather),
                     fixtures.zones_version(spark, sf_dir, 1), AS_OF[0])
        failed = ""
    except quality.QualityError as error:
        failed = ", ".join(f"{check}({column})" for check, column in error.failed)
    rows = [(f"{layer}.{name}", table_exists(spark, cfg, layer, name), failed)
            for layer, name in LAKE_TABLES]
    return spark.createDataFrame(rows, "table_name string, written boolean, failed string")


def q_integrity_extras(spark, sf_dir):
    weather = dimensions.weather_dimension(fixtures.bronze_weather(_session(spark), sf_dir))
    return quality.integrity_extras(fact_trips(spark, sf_dir), dim_zone(spark, sf_dir), weather)


def built_lake(spark: SparkSession, sf_dir: str, prefix: str | None = None) -> LakeConfig:
    """A lake built from the fixtures; with ``prefix`` its tables are registered as ``{prefix}gold.fact_trips`` ..."""
    from kerbside.plans.pipeline import run_pipeline
    cfg = LakeConfig(scratch(_session(spark), "sql-lake"))
    run_pipeline(spark, cfg, fixtures.bronze_trips(spark, sf_dir), fixtures.clean_weather(spark, sf_dir),
                 fixtures.zones_version(spark, sf_dir, 1), AS_OF[0],
                 register=prefix is not None, catalog_prefix=prefix or "")
    return cfg


def late_days_lake(spark: SparkSession, sf_dir: str) -> LakeConfig:
    """The second half of January lands first, then the whole month again, with days before the last loaded one."""
    from kerbside.plans.pipeline import run_pipeline
    cfg = LakeConfig(scratch(_session(spark), "late-lake"))
    trips, weather = fixtures.bronze_trips(spark, sf_dir), fixtures.clean_weather(spark, sf_dir)
    cut = F.lit(INCREMENTAL_CUT).cast("timestamp_ntz")
    late = trips.where((F.col("tpep_pickup_datetime") >= cut)
                       | (F.col("_source_month") != INCREMENTAL_MONTH))
    run_pipeline(spark, cfg, late, weather.where(F.col("observed_at") >= INCREMENTAL_CUT),
                 fixtures.zones_version(spark, sf_dir, 1), AS_OF[0])
    run_pipeline(spark, cfg, trips, weather)
    return cfg


def emptied_month_lake(spark: SparkSession, sf_dir: str) -> LakeConfig:
    """Two months of trips, then the earlier one again as refunds only, of which none survives cleaning."""
    from kerbside.plans.pipeline import run_pipeline
    cfg = LakeConfig(scratch(_session(spark), "emptied-lake"))
    trips, weather = fixtures.two_month_trips(spark, sf_dir), fixtures.clean_weather(spark, sf_dir)
    run_pipeline(spark, cfg, trips, weather, fixtures.zones_version(spark, sf_dir, 1), AS_OF[0])
    refunds = (trips.where(F.col("_source_month") < INCREMENTAL_MONTH)
               .withColumn("total_amount", -F.abs("total_amount") - 1))
    run_pipeline(spark, cfg, refunds, weather)
    return cfg


def _lake_table(spark: SparkSession, cfg: LakeConfig, layer: str, name: str, columns: list[str]) -> DataFrame:
    from kerbside.sources.lake import read_table
    return read_table(spark, cfg, layer, name).select(*columns)


def q_pipeline_incremental_fact(spark, sf_dir):
    """The fact after half a month and then, re-landed, the whole month, late days included."""
    return _lake_table(spark, late_days_lake(spark, sf_dir), "gold", "fact_trips", facts.FACT_COLUMNS)


def q_pipeline_incremental_mart(spark, sf_dir):
    """The mart after the re-landed month replaced its month partition."""
    return _lake_table(spark, late_days_lake(spark, sf_dir), "gold", "mart_zone_hourly_demand", MART_COLUMNS)


def q_pipeline_emptied_month_fact(spark, sf_dir):
    """The fact after a month was re-landed without a surviving trip: that month's days are gone."""
    return _lake_table(spark, emptied_month_lake(spark, sf_dir), "gold", "fact_trips", facts.FACT_COLUMNS)


def _lookup(spark, sf_dir, name: str, **params) -> DataFrame:
    """A bound lookup on a lake registered under names of its own."""
    prefix = f"kerbside_{uuid.uuid4().hex[:12]}_"
    built_lake(spark, sf_dir, prefix)
    return serving.run_serving_sql(spark, name, f"{prefix}gold", **params)


def q_sql_zone_demand(spark, sf_dir):
    return _lookup(spark, sf_dir, "zone_demand", zone_id=DEMAND_ZONE, limit=24)


def q_sql_single_day_revenue(spark, sf_dir):
    return _lookup(spark, sf_dir, "single_day_revenue", day=BENCH_DAY)


def _dashboard(spark, sf_dir, name: str) -> DataFrame:
    """A dashboard view, by name, over the mart and the zones."""
    serving.publish_dashboards(mart(spark, sf_dir), dim_zone(spark, sf_dir))
    return spark.sql(f"SELECT * FROM dashboard_{name}")


def q_sql_top_zones(spark, sf_dir):
    return _dashboard(spark, sf_dir, "top_zones")


def q_sql_hourly_profile(spark, sf_dir):
    return _dashboard(spark, sf_dir, "hourly_profile")


def q_sql_daily_trips_vs_temperature(spark, sf_dir):
    return _dashboard(spark, sf_dir, "daily_trips_vs_temperature")


QUERIES: dict[str, Query] = {
    "clean_trips": q_clean_trips,
    "lineage_counts": q_lineage_counts,
    "month_consistency_rejects": q_month_consistency_rejects,
    "zone_hourly_demand": q_zone_hourly_demand,
    "top_zones": q_top_zones,
    "hourly_profile": q_hourly_profile,
    "daily_trips_vs_temperature": q_daily_trips_vs_temperature,
    "zone_demand_latest": q_zone_demand_latest,
    "fact_trips": q_fact_trips,
    "single_day_revenue": q_single_day_revenue,
    "duplicates_removed": q_duplicates_removed,
    "trip_keys": q_trip_keys,
    "smart_keys": q_smart_keys,
    "trip_minutes": q_trip_minutes,
    "fact_trips_volume": q_fact_trips_volume,
    "dim_date": q_dim_date,
    "dim_weather": q_dim_weather,
    "scd2_zone_history": q_scd2_zone_history,
    "scd2_after_delete": q_scd2_after_delete,
    "dim_zone_current": q_dim_zone_current,
    "star_weather_demand": q_star_weather_demand,
    "star_weekend_revenue": q_star_weekend_revenue,
    "fact_rejects": q_fact_rejects,
    "month_bounds": q_month_bounds,
    "weather_unpacked": q_weather_unpacked,
    "landed_trips_scan": q_landed_trips_scan,
    "weather_payload_scan": q_weather_payload_scan,
    "zone_seed_scan": q_zone_seed_scan,
    "sql_mart_over_views": q_sql_mart_over_views,
    "quality_report": q_quality_report,
    "quality_report_from_profile": q_quality_report_from_profile,
    "quality_report_dirty": q_quality_report_dirty,
    "build_tests": q_build_tests,
    "not_null_report": q_not_null_report,
    "unique_violations": q_unique_violations,
    "orphan_date_keys": q_orphan_date_keys,
    "accepted_range_violations": q_accepted_range_violations,
    "incremental_watermark": q_incremental_watermark,
    "merge_idempotent": q_merge_idempotent,
    "merge_backfill": q_merge_backfill,
    "scan_footprint": q_scan_footprint,
    "bronze_replace_idempotent": q_bronze_replace_idempotent,
    "bronze_stream_ingest": q_bronze_stream_ingest,
    "pipeline_end_to_end": q_pipeline_end_to_end,
    "integrity_extras": q_integrity_extras,
    "pipeline_incremental_fact": q_pipeline_incremental_fact,
    "pipeline_incremental_mart": q_pipeline_incremental_mart,
    "sql_top_zones": q_sql_top_zones,
    "sql_zone_demand": q_sql_zone_demand,
    "sql_single_day_revenue": q_sql_single_day_revenue,
    "sql_daily_trips_vs_temperature": q_sql_daily_trips_vs_temperature,
    "sql_hourly_profile": q_sql_hourly_profile,
    "build_tests_dirty": q_build_tests_dirty,
    "fact_rejects_dirty": q_fact_rejects_dirty,
    "gate_failed_checks": q_gate_failed_checks,
    "gate_missing_table": q_gate_missing_table,
    "dim_weather_faint": q_dim_weather_faint,
    "scd2_customer_history": q_scd2_customer_history,
    "landed_trips_drift": q_landed_trips_drift,
    "pipeline_failing_build": q_pipeline_failing_build,
    "pipeline_emptied_month_fact": q_pipeline_emptied_month_fact,
}


_MONEY = "CAST(sum(CAST(total_amount AS DECIMAL(28,9))) AS DOUBLE)"

ORACLE: dict[str, str] = {
    "clean_trips": sql(["silver"], "SELECT * FROM silver"),
    "lineage_counts": sql(["bronze_trips"], """
        SELECT _source_dataset AS source_dataset, _source_month AS source_month,
               count(*) AS row_count
        FROM bronze_trips GROUP BY 1, 2"""),
    "month_consistency_rejects": sql(["bronze_trips"], """
        SELECT _source_month AS source_month,
               strftime(tpep_pickup_datetime, '%Y-%m') AS pickup_month,
               count(*) AS rejected_rows
        FROM bronze_trips
        WHERE total_amount > 0 AND NOT isnan(total_amount)
          AND trip_distance > 0 AND NOT isnan(trip_distance)
          AND tpep_pickup_datetime IS NOT NULL
          AND strftime(tpep_pickup_datetime, '%Y-%m') <> _source_month
        GROUP BY 1, 2"""),
    "zone_hourly_demand": sql(["mart"], "SELECT * FROM mart"),
    "top_zones": sql(["mart", "dim_zone"], """
        SELECT z.zone_name, CAST(sum(m.trip_count) AS BIGINT) AS trips
        FROM mart m JOIN dim_zone z ON m.pickup_zone_id = z.zone_id AND z.is_current
        GROUP BY z.zone_name ORDER BY trips DESC, zone_name ASC LIMIT 10"""),
    "hourly_profile": sql(["mart"], """
        SELECT CAST(hour(pickup_hour) AS INTEGER) AS hour_of_day,
               CAST(sum(trip_count) AS BIGINT) AS trips
        FROM mart GROUP BY 1 ORDER BY 1"""),
    "daily_trips_vs_temperature": sql(["mart"], """
        SELECT CAST(pickup_hour AS DATE) AS day, CAST(sum(trip_count) AS BIGINT) AS trips,
               round(CAST(sum(CAST(temperature_2m AS DECIMAL(28,9))) AS DOUBLE)
                     / count(temperature_2m), 1) AS avg_temp_c
        FROM mart GROUP BY 1 ORDER BY 1"""),
    "zone_demand_latest": sql(["mart"], f"""
        SELECT pickup_hour, trip_count, revenue, avg_distance, temperature_2m, precipitation
        FROM mart WHERE pickup_zone_id = {DEMAND_ZONE}
        ORDER BY pickup_hour DESC LIMIT 24"""),
    "fact_trips": sql(["fact"], "SELECT * FROM fact"),
    "single_day_revenue": sql(["fact"], f"""
        SELECT count(*) AS c,
               CAST(round(sum(CAST(total_amount AS DECIMAL(28,9))), 0) AS DOUBLE) AS rev
        FROM fact WHERE pickup_date = DATE '{BENCH_DAY.isoformat()}'"""),
    "duplicates_removed": sql(["keyed"], """
        SELECT count(*) AS rows_in, count(DISTINCT trip_key) AS rows_out,
               count(*) - count(DISTINCT trip_key) AS removed
        FROM keyed WHERE trip_key IS NOT NULL"""),
    "trip_keys": sql(["keyed"], """
        SELECT trip_key, pickup_ts, dropoff_ts, pickup_zone_id, dropoff_zone_id,
               passenger_count, trip_distance, total_amount FROM keyed"""),
    "smart_keys": sql(["silver"], """
        SELECT pickup_ts, CAST(strftime(pickup_ts, '%Y%m%d') AS INTEGER) AS pickup_date_key,
               CAST(strftime(pickup_ts, '%Y%m%d%H') AS BIGINT) AS pickup_weather_key
        FROM silver"""),
    "trip_minutes": sql(["silver"], """
        SELECT pickup_ts, dropoff_ts, date_sub('minute', pickup_ts, dropoff_ts) AS trip_minutes
        FROM silver"""),
    "fact_trips_volume": sql(["volume_fact"], "SELECT * FROM volume_fact"),
    "dim_date": sql(["dim_date"], "SELECT * FROM dim_date"),
    "dim_weather": sql(["dim_weather"], "SELECT * FROM dim_weather"),
    "scd2_zone_history": sql(["zone_history"], "SELECT * FROM zone_history"),
    "scd2_after_delete": sql(["zone_history_v2"], "SELECT * FROM zone_history_v2"),
    "dim_zone_current": sql(["dim_zone"], "SELECT * FROM dim_zone WHERE is_current"),
    "star_weather_demand": sql(["fact", "dim_weather"], f"""
        SELECT w.is_wet, count(*) AS trips, {_MONEY} AS revenue,
               CAST(sum(f.trip_minutes) AS DOUBLE) / count(f.trip_minutes) AS avg_minutes
        FROM fact f LEFT JOIN dim_weather w ON f.pickup_weather_key = w.weather_key
        GROUP BY w.is_wet"""),
    "star_weekend_revenue": sql(["fact", "dim_date"], f"""
        SELECT d.day_of_week, d.is_weekend, count(*) AS trips, {_MONEY} AS revenue
        FROM fact f JOIN dim_date d ON f.pickup_date = d.date_day
        GROUP BY 1, 2"""),
}


def _suite_sql(src: str) -> str:
    def share(c, lo, hi, mostly):
        s_ = f"CAST(count_if({c} BETWEEN {lo} AND {hi}) AS DOUBLE) / nullif(count({c}), 0)"
        return (f"SELECT 'between' AS check_name, '{c}' AS column_name, {s_} AS observed, "
                f"CAST({mostly} AS DOUBLE) AS threshold, coalesce({s_} >= {mostly}, true) AS success "
                f"FROM {src}")

    def not_null(c):
        return (f"SELECT 'not_null', '{c}', CAST(count_if({c} IS NULL) AS DOUBLE), 0.0, "
                f"count_if({c} IS NULL) = 0 FROM {src}")
    return "\nUNION ALL ".join([
        f"SELECT 'row_count' AS check_name, '*' AS column_name, CAST(count(*) AS DOUBLE) AS observed, "
        f"1.0 AS threshold, count(*) >= 1 AS success FROM {src}",
        not_null("tpep_pickup_datetime"), not_null("pulocationid"),
        share("total_amount", -1000, 100000, 0.99), share("trip_distance", 0, 1000, 0.99),
        share("passenger_count", 0, 9, 0.95)])


def _test_sql(table: str, src: str, check: str, col: str, cond: str | None = None) -> str:
    if check == "not_null":
        obs = f"count_if({col} IS NULL)"
        frm = src
    elif check == "unique":
        obs = "count(*)"
        frm = f"(SELECT {col} FROM {src} WHERE {col} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"
    elif check == "relationships":
        obs = "count(*)"
        frm = (f"(SELECT {col} FROM {src} WHERE {col} IS NOT NULL AND {col} NOT IN "
               f"(SELECT date_key FROM dim_date WHERE date_key IS NOT NULL))")
    else:  # accepted_range: min 0 exclusive
        obs = f"count_if({col} IS NOT NULL AND (isnan(CAST({col} AS DOUBLE)) OR NOT ({col} > 0)))"
        frm = src
    return (f"SELECT '{table}' AS table_name, '{check}' AS check_name, '{col}' AS column_name, "
            f"CAST({obs} AS DOUBLE) AS observed, CAST(0 AS DOUBLE) AS threshold, {obs} = 0 AS success FROM {frm}")


_BUILD_TESTS = [
    ("dim_zone", "dim_zone", "not_null", "zone_id"),
    ("dim_zone", "dim_zone", "not_null", "is_current"),
    ("dim_date", "dim_date", "not_null", "date_key"),
    ("dim_date", "dim_date", "unique", "date_key"),
    ("dim_date", "dim_date", "not_null", "date_day"),
    ("dim_weather", "dim_weather", "not_null", "weather_key"),
    ("dim_weather", "dim_weather", "unique", "weather_key"),
    ("fact_trips", "fact", "not_null", "trip_key"),
    ("fact_trips", "fact", "unique", "trip_key"),
    ("fact_trips", "fact", "not_null", "pickup_date_key"),
    ("fact_trips", "fact", "relationships", "pickup_date_key"),
    ("fact_trips", "fact", "not_null", "pickup_zone_id"),
    ("fact_trips", "fact", "accepted_range", "total_amount"),
    ("bronze_yellow_trips", "bronze_trips", "not_null", "tpep_pickup_datetime"),
    ("bronze_yellow_trips", "bronze_trips", "not_null", "pulocationid"),
    ("bronze_weather_hourly", "bronze_weather", "not_null", "observed_at"),
    ("bronze_weather_hourly", "bronze_weather", "unique", "observed_at"),
]
_BUILD_TEST_VIEWS = ["fact", "dim_date", "dim_weather", "dim_zone", "bronze_trips", "bronze_weather"]
BUILD_TESTS_SQL = sql(_BUILD_TEST_VIEWS, "\nUNION ALL ".join(_test_sql(*t) for t in _BUILD_TESTS))


def _build_tests_of(check: str) -> str:
    return sql(_BUILD_TEST_VIEWS, "\nUNION ALL ".join(
        _test_sql(*t) for t in _BUILD_TESTS if t[2] == check))

_DIRTY = """
          SELECT CASE WHEN minute(tpep_pickup_datetime) % 50 = 0 THEN NULL
                      ELSE tpep_pickup_datetime END AS tpep_pickup_datetime,
                 pulocationid,
                 CASE WHEN total_amount < 0 THEN 99 ELSE passenger_count END AS passenger_count,
                 CASE WHEN total_amount < 0 THEN trip_distance * 100 ELSE trip_distance END
                   AS trip_distance,
                 total_amount
          FROM bronze_trips"""

ORACLE.update({
    "fact_rejects": sql(["keyed"], "SELECT * FROM keyed WHERE trip_key IS NULL"),
    "month_bounds": sql(["bronze_trips"], """
        SELECT source_month, CAST(source_month || '-01' AS DATE) AS first_day,
               last_day(CAST(source_month || '-01' AS DATE)) AS last_day
        FROM (SELECT DISTINCT _source_month AS source_month FROM bronze_trips)"""),
    "weather_unpacked": sql(["bronze_weather"], "SELECT * FROM bronze_weather"),
    "quality_report": sql(["bronze_trips"], _suite_sql("bronze_trips")),
    "quality_report_from_profile": sql(["bronze_trips"], _suite_sql("bronze_trips")),
    "quality_report_dirty": sql(["bronze_trips"], f"""
        , dirty AS ({_DIRTY})
        {_suite_sql("dirty")}"""),
    "build_tests": BUILD_TESTS_SQL,
    "not_null_report": _build_tests_of("not_null"),
    "unique_violations": _build_tests_of("unique"),
    "orphan_date_keys": _build_tests_of("relationships"),
    "accepted_range_violations": _build_tests_of("accepted_range"),
    "incremental_watermark": sql(["fact"], f"""
        SELECT * FROM fact WHERE pickup_date > DATE '{BENCH_DAY.isoformat()}'"""),
    "merge_idempotent": sql(["fact"], "SELECT * FROM fact"),
    "merge_backfill": sql(["fact"], "SELECT * FROM fact"),
    "bronze_replace_idempotent": sql(["bronze_trips"], "SELECT * FROM bronze_trips"),
    "bronze_stream_ingest": sql(["bronze_trips"], "SELECT * FROM bronze_trips"),
    "pipeline_end_to_end": sql([*_BUILD_TEST_VIEWS, "clean_weather"], "\nUNION ALL ".join(
        _test_sql(t, src.replace("bronze_weather", "clean_weather"), check, col)
        for t, src, check, col in _BUILD_TESTS)),
    "build_tests_dirty": sql([*_BUILD_TEST_VIEWS, "dirty_fact"], "\nUNION ALL ".join(
        _test_sql(t, "dirty_fact" if src == "fact" else src, check, col)
        for t, src, check, col in _BUILD_TESTS)),
    "integrity_extras": sql(["fact", "dim_zone", "dim_weather"], """
        SELECT 'relationships' AS check_name, 'pickup_zone_id' AS column_name,
               CAST(count(*) AS DOUBLE) AS observed, CAST(0 AS DOUBLE) AS threshold,
               count(*) = 0 AS success
        FROM fact WHERE pickup_zone_id IS NOT NULL
          AND pickup_zone_id NOT IN (SELECT zone_id FROM dim_zone WHERE is_current)
        UNION ALL
        SELECT 'relationships', 'pickup_weather_key', CAST(count(*) AS DOUBLE),
               CAST(0 AS DOUBLE), count(*) = 0
        FROM fact WHERE pickup_weather_key IS NOT NULL
          AND pickup_weather_key NOT IN (SELECT weather_key FROM dim_weather)
        UNION ALL
        SELECT 'unique_current', 'zone_id', CAST(count(*) AS DOUBLE), CAST(0 AS DOUBLE),
               count(*) = 0
        FROM (SELECT zone_id FROM dim_zone WHERE is_current AND zone_id IS NOT NULL
              GROUP BY 1 HAVING count(*) > 1)"""),
})

ORACLE.update({
    "sql_top_zones": ORACLE["top_zones"],
    "sql_single_day_revenue": ORACLE["single_day_revenue"],
    "sql_daily_trips_vs_temperature": ORACLE["daily_trips_vs_temperature"],
    "landed_trips_scan": sql(["bronze_trips"], "SELECT * FROM bronze_trips"),
    "weather_payload_scan": sql(["bronze_weather"], "SELECT * FROM bronze_weather"),
    "zone_seed_scan": sql(["zones_v1"], "SELECT * FROM zones_v1"),
    "sql_mart_over_views": ORACLE["zone_hourly_demand"],
    "pipeline_incremental_fact": ORACLE["fact_trips"],
    "pipeline_incremental_mart": sql(["clean_mart"], "SELECT * FROM clean_mart"),
    "pipeline_emptied_month_fact": sql(["fact"], f"""
        SELECT * FROM fact WHERE pickup_date >= DATE '{INCREMENTAL_CUT}'"""),
    "sql_zone_demand": sql(["clean_mart"], f"""
        SELECT pickup_hour, trip_count, revenue, avg_distance, temperature_2m, precipitation
        FROM clean_mart WHERE pickup_zone_id = {DEMAND_ZONE}
        ORDER BY pickup_hour DESC LIMIT 24"""),
    "sql_hourly_profile": ORACLE["hourly_profile"],
    "fact_rejects_dirty": sql(["keyed"], """
        SELECT * REPLACE (CAST(NULL AS VARCHAR) AS trip_key, CAST(NULL AS INTEGER) AS pickup_zone_id)
        FROM keyed WHERE pickup_zone_id = 3"""),
    "gate_failed_checks": sql(["bronze_trips"], f"""
        , dirty AS ({_DIRTY})
        SELECT check_name, column_name FROM ({_suite_sql("dirty")}) WHERE NOT success"""),
    "gate_missing_table": sql(["bronze_trips"], """
        SELECT 'before' AS step, false AS passed, CAST(0 AS BIGINT) AS row_count
        UNION ALL SELECT 'after', true, count(*) FROM bronze_trips"""),
    "dim_weather_faint": sql(["faint_hourly"], """
        SELECT CAST(strftime(weather_hour, '%Y%m%d%H') AS BIGINT) AS weather_key, weather_hour,
               temperature_2m, CAST(thousandths AS DOUBLE) / 1000 / n AS precipitation,
               wind_speed_10m, thousandths > 0 AS is_wet
        FROM faint_hourly"""),
    "scd2_customer_history": """
        WITH c AS (SELECT c_custkey, c_name, c_mktsegment, c_custkey % 5 = 0 AS moves,
                          c_custkey % 11 = 10 AS leaves FROM customer)
        SELECT c_custkey, c_name, c_mktsegment, TIMESTAMP '2024-01-01 00:00:00' AS valid_from,
               CASE WHEN moves OR leaves THEN TIMESTAMP '2024-02-01 00:00:00' END AS valid_to FROM c
        UNION ALL
        SELECT c_custkey, c_name, 'MOVED', TIMESTAMP '2024-02-01 00:00:00',
               TIMESTAMP '2024-03-01 00:00:00' FROM c WHERE moves AND NOT leaves
        UNION ALL
        SELECT c_custkey, c_name, c_mktsegment, TIMESTAMP '2024-03-01 00:00:00',
               CAST(NULL AS TIMESTAMP) FROM c WHERE moves OR leaves""",
    "landed_trips_drift": sql(["bronze_trips"], """
        SELECT * REPLACE (CASE WHEN _source_month <> '2023-12' THEN dolocationid END AS dolocationid)
        FROM bronze_trips"""),
    "pipeline_failing_build": """
        SELECT t AS table_name, false AS written, 'unique(bronze_weather_hourly.observed_at)' AS failed
        FROM (VALUES ('bronze.yellow_trips'), ('bronze.weather_hourly'), ('bronze.yellow_trips_profile'),
                     ('snapshots.zone_snapshot'), ('silver.stg_yellow_trips'), ('gold.dim_zone'),
                     ('gold.dim_date'), ('gold.dim_weather'), ('gold.fact_trips'),
                     ('gold.fact_trips_date_keys'), ('gold.mart_zone_hourly_demand')) AS v(t)""",
    "scan_footprint": sql(["fact"], f"""
        , n AS (SELECT count(*) AS total,
                       CAST(count_if(pickup_date = DATE '{BENCH_DAY.isoformat()}') AS BIGINT) AS matched
                FROM fact)
        SELECT 'unpartitioned' AS layout, total AS rows_total, total AS rows_scanned,
               matched AS rows_matched,
               round((total - matched) * 100.0 / total, 1) AS pct_filtered_after_read FROM n
        UNION ALL
        SELECT 'pickup_date', total, matched, matched, CAST(0.0 AS DOUBLE) FROM n"""),
})
