"""Bronze landing: idempotent replace, append, file stream, catalog, pipeline gate."""
from __future__ import annotations

import glob
import os
import uuid

import pytest
from pyspark.sql import functions as F

from kerbside.config import LakeConfig
from kerbside.operators import quality
from kerbside.plans.pipeline import run_pipeline
from kerbside.sinks.catalog import register_lake
from kerbside.sinks.writers import write_bronze
from kerbside.sources import fixtures, trip_file_path
from kerbside.streaming import ingest_landed_trips

SF = "/root/testdata/sf0.001"


def _counts(df):
    return {r._source_month: r["count"] for r in df.groupBy("_source_month").count().collect()}


def test_bronze_replace_is_idempotent_and_append_is_not(spark, workdir):
    trips = fixtures.bronze_trips(spark, SF)
    once = _counts(trips)
    write_bronze(trips, f"{workdir}/replace")
    write_bronze(trips, f"{workdir}/replace")
    assert _counts(spark.read.parquet(f"{workdir}/replace")) == once
    write_bronze(trips, f"{workdir}/append", mode="append")
    write_bronze(trips, f"{workdir}/append", mode="append")
    assert _counts(spark.read.parquet(f"{workdir}/append")) == {k: 2 * v for k, v in once.items()}


def test_stream_lands_each_file_once(spark, workdir):
    landing = f"{workdir}/landing"
    rows = spark.createDataFrame(
        [("2024-01-01 00:00:00", 1, 5.0), ("2024-01-02 00:00:00", 2, 6.0)],
        "tpep_pickup_datetime string, PULocationID int, total_amount double")
    rows.write.parquet(trip_file_path(landing, "yellow", "2024-01"))
    schema = rows.schema
    bronze, ckpt = f"{workdir}/bronze", f"{workdir}/ckpt"
    ingest_landed_trips(spark, landing, bronze, ckpt, schema)
    ingest_landed_trips(spark, landing, bronze, ckpt, schema)
    assert _counts(spark.read.parquet(bronze)) == {"2024-01": 2}
    rows.limit(1).write.parquet(trip_file_path(landing, "yellow", "2024-02"))
    ingest_landed_trips(spark, landing, bronze, ckpt, schema)
    got = spark.read.parquet(bronze)
    assert _counts(got) == {"2024-01": 2, "2024-02": 1}
    assert "pulocationid" in got.columns
    assert {r._source_dataset for r in got.select("_source_dataset").distinct().collect()} == {"yellow"}


def _files(cfg, layer, name):
    return glob.glob(f"{cfg.path(layer, name)}/**/*.parquet", recursive=True)


def test_pipeline_gate_stops_downstream(spark, workdir):
    cfg = LakeConfig(f"{workdir}/lake")
    with pytest.raises(quality.QualityError):
        run_pipeline(spark, cfg, fixtures.dirty_bronze_trips(spark, SF),
                     fixtures.clean_weather(spark, SF))
    assert not os.path.exists(cfg.path("silver", "stg_yellow_trips"))
    assert not os.path.exists(cfg.path("gold", "fact_trips"))


def test_failing_table_test_stops_later_tables_and_registration(spark, workdir):
    cfg = LakeConfig(f"{workdir}/lake")
    trips = fixtures.bronze_trips(spark, SF)
    zones = fixtures.zones_version(spark, SF, 1)
    prefix = f"t{uuid.uuid4().hex[:8]}_"
    # one trip whose amount is infinite passes the gate and silver; a test on the fact is made to fail
    checks = quality.table_checks
    try:
        quality.table_checks = lambda table, *a: checks(table, *a) + (
            [quality.Check("greater_than", "trip_distance", low=10)] if table == "fact_trips" else [])
        with pytest.raises(quality.QualityError, match="fact_trips.trip_distance"):
            run_pipeline(spark, cfg, trips, fixtures.clean_weather(spark, SF), zones,
                         "2024-01-01 00:00:00", register=True, catalog_prefix=prefix)
    finally:
        quality.table_checks = checks
    assert _files(cfg, "gold", "dim_weather") and not os.path.exists(cfg.path("gold", "mart_zone_hourly_demand"))
    assert not spark.catalog.databaseExists(f"{prefix}gold")


def test_pipeline_rerun_and_catalog_sql(spark, workdir):
    cfg, prefix = LakeConfig(f"{workdir}/lake"), f"t{uuid.uuid4().hex[:8]}_"
    trips, weather = fixtures.bronze_trips(spark, SF), fixtures.clean_weather(spark, SF)
    zones = fixtures.zones_version(spark, SF, 1)
    first = run_pipeline(spark, cfg, trips, weather, zones, "2024-01-01 00:00:00")
    n = spark.read.parquet(cfg.path("gold", "fact_trips")).count()
    second = run_pipeline(spark, cfg, trips, weather, zones, "2024-02-01 00:00:00",
                          register=True, catalog_prefix=prefix)
    assert first["fact_load"]["mode"] == "create" and second["fact_load"]["mode"] == "months"
    assert first["tests"] == second["tests"] == 17 and second["failed_tests"] == []
    assert spark.read.parquet(cfg.path("gold", "fact_trips")).count() == n
    assert spark.table(f"{prefix}snapshots.zone_snapshot").count() == 25     # no change, no new version
    assert f"{prefix}gold.fact_trips" in register_lake(spark, cfg, prefix)
    c = spark.sql(f"SELECT count(*) FROM {prefix}gold.fact_trips WHERE pickup_date = DATE'2024-01-15'")
    assert c.first()[0] == spark.read.parquet(cfg.path("gold", "fact_trips")).where(
        F.col("pickup_date") == "2024-01-15").count()


TABLES = [("bronze", "yellow_trips_profile"), ("silver", "stg_yellow_trips"),
          ("gold", "mart_zone_hourly_demand"), ("gold", "fact_trips"), ("gold", "fact_trips_date_keys"),
          ("gold", "dim_date"), ("gold", "dim_weather")]


def _same_lakes(spark, a, b):
    from pyspark.testing import assertDataFrameEqual

    for layer, name in TABLES:
        x, y = (spark.read.parquet(c.path(layer, name)) for c in (a, b))
        assertDataFrameEqual(x, y.select(*x.columns))


def test_runs_in_any_order_equal_a_full_rebuild(spark, workdir):
    trips, weather = fixtures.two_month_trips(spark, SF), fixtures.clean_weather(spark, SF)
    zones = fixtures.zones_version(spark, SF, 1)
    inc, full = LakeConfig(f"{workdir}/inc"), LakeConfig(f"{workdir}/full")
    cut = F.lit("2024-01-22").cast("timestamp_ntz")
    jan = F.col("_source_month") == "2024-01"
    # late January first, then December, then January again with its earlier days
    run_pipeline(spark, inc, trips.where(jan & (F.col("tpep_pickup_datetime") >= cut)), weather,
                 zones, "2024-01-01 00:00:00")
    run_pipeline(spark, inc, trips.where(~jan), weather.where(F.lit(False)))
    run_pipeline(spark, inc, trips.where(jan), weather.where(F.lit(False)))
    # a month that is re-landed with fewer days loses the others
    fewer = trips.where(~jan & (F.dayofmonth("tpep_pickup_datetime") > 20))
    run_pipeline(spark, inc, fewer, weather.where(F.lit(False)))
    run_pipeline(spark, full, trips.where(jan).unionByName(fewer), weather, zones,
                 "2024-01-01 00:00:00", incremental=False)
    _same_lakes(spark, inc, full)


def test_month_relanded_without_surviving_rows_is_cleared(spark, workdir):
    trips, weather = fixtures.two_month_trips(spark, SF), fixtures.clean_weather(spark, SF)
    cfg = LakeConfig(f"{workdir}/lake")
    run_pipeline(spark, cfg, trips, weather, fixtures.zones_version(spark, SF, 1), "2024-01-01 00:00:00")
    for month in ("2023-12", "2024-01"):
        refunds = trips.where(F.col("_source_month") == month).withColumn(
            "total_amount", -F.abs("total_amount") - 1)
        done = run_pipeline(spark, cfg, refunds, weather.where(F.lit(False)))
        assert done["failed_tests"] == [] and done["months"] == [month]
        for layer, name in TABLES[1:5]:
            assert not any(month in f for f in _files(cfg, layer, name)), (layer, name)
    for layer, name in TABLES[1:5]:
        assert _files(cfg, layer, name) == []


def test_other_datasets_keep_their_own_bronze(spark, workdir):
    cfg = LakeConfig(f"{workdir}/lake", dataset="green")
    done = run_pipeline(spark, cfg, fixtures.bronze_trips(spark, SF), fixtures.clean_weather(spark, SF))
    assert done["fact_load"] is None
    assert _files(cfg, "bronze", "green_trips") and not os.path.exists(cfg.path("bronze", "yellow_trips"))


def test_registration_leaves_other_tables_alone(spark, workdir):
    from kerbside.sinks.catalog import CatalogConflictError, register_table

    prefix = f"t{uuid.uuid4().hex[:8]}_"
    cfg = LakeConfig(f"{workdir}/lake")
    spark.range(3).write.parquet(cfg.path("gold", "dim_zone"))
    spark.sql(f"CREATE DATABASE {prefix}gold LOCATION '{workdir}/elsewhere'")
    spark.range(7).write.saveAsTable(f"{prefix}gold.dim_zone")          # managed
    spark.range(9).write.option("path", f"{workdir}/own").saveAsTable(f"{prefix}gold.dim_date")
    spark.range(3).write.parquet(cfg.path("gold", "dim_date"))
    for name, n in (("dim_zone", 7), ("dim_date", 9)):
        with pytest.raises(CatalogConflictError):
            register_table(spark, cfg, "gold", name, prefix=prefix)
        assert spark.table(f"{prefix}gold.{name}").count() == n


def test_registering_another_lake_repoints_tables(spark, workdir):
    from kerbside.sinks.catalog import register_table, table_location

    for root in (f"{workdir}/a", f"{workdir}/b"):
        cfg = LakeConfig(root)
        spark.range(3).write.parquet(cfg.path("gold", "dim_probe"))
        register_table(spark, cfg, "gold", "dim_probe", prefix="probe_")
        assert table_location(spark, "probe_gold.dim_probe") == cfg.path("gold", "dim_probe")
        assert spark.table("probe_gold.dim_probe").count() == 3
