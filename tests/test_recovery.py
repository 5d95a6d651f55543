"""What a failed or killed run leaves behind: pending months, landed batches, the zone history."""
from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from kerbside.config import LakeConfig
from kerbside.operators import merge, quality
from kerbside.plans.pipeline import run_pipeline
from kerbside.sinks import landing, versions
from kerbside.sources import fixtures
from kerbside.sources.lake import MissingTableError, read_table, table_exists
from tests.test_landing import SF, _same_lakes


def _full(spark, path, trips, weather, zones):
    cfg = LakeConfig(path)
    run_pipeline(spark, cfg, trips, weather, zones, "2024-01-01 00:00:00", incremental=False)
    return cfg


def test_months_of_failed_runs_are_built_later(spark, workdir, monkeypatch):
    trips, weather = fixtures.two_month_trips(spark, SF), fixtures.clean_weather(spark, SF)
    zones = fixtures.zones_version(spark, SF, 1)
    jan = F.col("_source_month") == "2024-01"
    cfg = LakeConfig(f"{workdir}/inc")
    run_pipeline(spark, cfg, trips.where(~jan), weather, zones, "2024-01-01 00:00:00")
    before = read_table(spark, cfg, "bronze", "yellow_trips").count()
    # weather that landed twice: nothing of the batch goes live
    with pytest.raises(quality.QualityError, match="observed_at"):
        run_pipeline(spark, cfg, trips.where(jan), weather.unionByName(weather))
    assert read_table(spark, cfg, "bronze", "yellow_trips").count() == before
    assert landing.landed_months(spark, cfg, "yellow_trips") == ["2024-01"]

    # a driver lost in the middle of the fact: bronze is in, the month stays pending
    def lost(*args):
        raise KeyboardInterrupt("lost")
    with monkeypatch.context() as patch:
        patch.setattr(merge, "replace_months", lost)
        with pytest.raises(KeyboardInterrupt):
            run_pipeline(spark, cfg, trips.where(~jan), weather)
    assert landing.pending(spark, cfg, "trips") == ["2023-12", "2024-01"]
    done = run_pipeline(spark, cfg, trips.where(F.lit(False)), weather.where(F.lit(False)))
    assert done["months"] == ["2023-12", "2024-01"] and landing.pending(spark, cfg, "trips") == []
    _same_lakes(spark, cfg, _full(spark, f"{workdir}/full", trips, weather, zones))


def test_failed_month_blocks_until_landed_again_or_discarded(spark, workdir):
    trips, weather = fixtures.bronze_trips(spark, SF), fixtures.clean_weather(spark, SF)
    zones = fixtures.zones_version(spark, SF, 1)
    cfg = LakeConfig(f"{workdir}/lake")
    jan = F.col("_source_month") == "2024-01"
    run_pipeline(spark, cfg, trips.where(jan), weather, zones, "2024-01-01 00:00:00")
    dirty = fixtures.dirty_bronze_trips(spark, SF).withColumn("_source_month", F.lit("2024-02"))
    with pytest.raises(quality.QualityError):
        run_pipeline(spark, cfg, dirty, weather)
    with pytest.raises(quality.QualityError):
        run_pipeline(spark, cfg, trips.where(jan), weather)
    landing.discard(spark, cfg, "yellow_trips", ["2024-02"])
    assert run_pipeline(spark, cfg, trips.where(jan), weather)["months"] == ["2024-01"]


def test_swap_goes_on_where_it_died(spark, workdir, monkeypatch):
    cfg = LakeConfig(f"{workdir}/lake")
    rows = spark.range(30).select("id", F.concat(F.lit("2024-0"), (F.col("id") % 3 + 1).cast("string")).alias("_source_month"))
    landing.land(rows, cfg, "probe")
    landing.swap_in(spark, cfg, "probe")
    landing.land(rows.withColumn("id", F.col("id") + 100), cfg, "probe")
    assert landing.with_landed(spark, cfg, "probe").agg(F.min("id"), F.count("id")).first()[:] == (100, 30)
    move, calls = landing.move_folder, []

    def dying(*args):
        if calls:
            raise KeyboardInterrupt("lost")
        calls.append(args)
        move(*args)
    with monkeypatch.context() as patch:
        patch.setattr(landing, "move_folder", dying)
        with pytest.raises(KeyboardInterrupt):
            landing.swap_in(spark, cfg, "probe")
    assert landing.with_landed(spark, cfg, "probe").agg(F.min("id"), F.count("id")).first()[:] == (100, 30)
    landing.swap_in(spark, cfg, "probe")
    assert spark.read.parquet(cfg.path("bronze", "probe")).agg(F.min("id"), F.count("id")).first()[:] == (100, 30)


def test_history_survives_a_writer_killed_half_way(spark, workdir, monkeypatch):
    cfg = LakeConfig(f"{workdir}/lake")
    path = cfg.path("snapshots", "zone_snapshot")

    def rows():
        return sorted(r.id for r in read_table(spark, cfg, "snapshots", "zone_snapshot").collect())
    half = spark.range(0, 8, 1, 4).select(F.when(F.col("id") < 7, F.col("id")).otherwise(
        F.raise_error(F.lit("killed")).cast("long")).alias("id"))
    with pytest.raises(Exception, match="killed"):
        versions.write_version(half, path)
    assert not table_exists(spark, cfg, "snapshots", "zone_snapshot")
    with pytest.raises(MissingTableError):
        rows()
    versions.write_version(spark.range(3), path)
    assert rows() == [0, 1, 2]
    with pytest.raises(Exception, match="killed"):
        versions.write_version(half, path)
    assert rows() == [0, 1, 2]

    def lost(*args):
        raise KeyboardInterrupt("lost")
    with monkeypatch.context() as patch:
        patch.setattr(versions, "_publish", lost)
        with pytest.raises(KeyboardInterrupt):
            versions.write_version(spark.range(9), path)
    assert rows() == [0, 1, 2]
    # a new version may read the one it replaces; the one before it stays until the next success
    grown = read_table(spark, cfg, "snapshots", "zone_snapshot").union(spark.range(3, 4))
    versions.write_version(grown, path)
    assert rows() == [0, 1, 2, 3]
    assert sorted(n for n in os.listdir(path) if n.startswith("version")) == ["version-000000000001", "version-000000000002"]
    versions.write_version(spark.range(1), path)
    assert rows() == [0] and len([n for n in os.listdir(path) if n.startswith("version")]) == 2


def test_two_writers_of_one_version_do_not_both_win(spark, workdir):
    path = f"{workdir}/t"
    versions.write_version(spark.range(1), path)
    with pytest.raises(Exception, match="(?i)exist"):
        versions._publish(spark, path, 1)
