"""The physical plans have the shape the scale design relies on."""
from __future__ import annotations

import contextlib
import os
import io
import re

from pyspark.sql import functions as F

from kerbside.operators import facts, marts, serving, silver
from kerbside.sources import fixtures

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def _silver(spark):
    return silver.clean_trips(fixtures.bronze_trips(spark, SF))


def test_scan_reads_only_needed_columns(spark):
    p = plan(_silver(spark))
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", p)
    assert schemas and all("props" not in s for s in schemas)


def test_fact_dedup_combines_before_the_shuffle(spark):
    p = plan(facts.build_fact(_silver(spark)))
    exchange = p.index("Exchange hashpartitioning(trip_key")
    assert p.index("partial_first", exchange) > exchange       # partial below the exchange
    assert "Window" not in p and "SortMergeJoin" not in p
    assert p.count("md5(") <= 2                                 # one key computation per branch


def test_mart_aggregates_then_broadcasts_weather(spark):
    p = plan(marts.zone_hourly_demand(_silver(spark), fixtures.bronze_weather(spark, SF)))
    assert re.search(r"BroadcastHashJoin \[[^\]]*pickup_hour[^\]]*\], \[[^\]]*\], LeftOuter, BuildRight", p)
    assert "partial_count" in p and "partial_sum" in p


def test_building_a_plan_runs_no_job(spark, monkeypatch):
    from kerbside.plans import queries as catalogue

    names = ("events", "nation", "region")
    read = {n: fixtures.table(spark, SF, n) for n in names}      # opening a file reads its footer
    monkeypatch.setattr(fixtures, "table", lambda s, d, name: read[name])
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "planning")
    try:
        for name in ("zone_hourly_demand", "top_zones", "star_weather_demand", "star_weekend_revenue",
                     "scd2_zone_history", "accepted_range_violations"):
            catalogue.QUERIES[name](spark, SF)
        assert list(tracker.getJobIdsForGroup("planning")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_scd2_versions_cost_one_join_each(spark):
    from kerbside.plans import queries as catalogue

    p = plan(catalogue.zone_history(spark, SF, 3))
    assert len(re.findall(r"(?:SortMergeJoin|ShuffledHashJoin) \[[^\n]*FullOuter", p)) == 2


def test_single_day_prunes_partitions(spark, workdir):
    fact = facts.build_fact(_silver(spark))
    fact.write.partitionBy("pickup_date").parquet(f"{workdir}/fact")
    q = serving.single_day_revenue(spark.read.parquet(f"{workdir}/fact"), "2024-01-15")
    p = plan(q)
    assert re.search(r"PartitionFilters: \[[^\]]*pickup_date", p)
    assert "PushedFilters: []" in p                     # nothing left to filter after pruning


def test_between_days_adds_partition_filter(spark, workdir):
    fact = facts.build_fact(_silver(spark))
    fact.write.partitionBy("pickup_date").parquet(f"{workdir}/fact")
    q = serving.between_days(spark.read.parquet(f"{workdir}/fact"), "2024-01-10", "2024-01-11")
    assert re.search(r"PartitionFilters: \[[^\]]*pickup_date", plan(q))
    got = q.agg(F.min("pickup_date"), F.max("pickup_date")).first()
    assert str(got[0]) >= "2024-01-10" and str(got[1]) <= "2024-01-11"


def test_watermark_reads_partition_listing_only(spark, workdir):
    from kerbside.operators import merge
    from kerbside.sources.lake import partition_listing_only

    fact = facts.build_fact(_silver(spark))
    fact.write.partitionBy("pickup_date").parquet(f"{workdir}/fact")
    t = spark.read.parquet(f"{workdir}/fact")
    with partition_listing_only(spark):
        p = plan(t.agg(F.max("pickup_date")))
    assert "LocalTableScan" in p and "FileScan" not in p
    assert spark.conf.get("spark.sql.optimizer.metadataOnly") == "false"
    assert merge.watermark(spark, f"{workdir}/fact") == fact.agg(F.max("pickup_date")).first()[0]


def test_shuffle_width_follows_input_bytes_and_is_restored(spark, workdir):
    from kerbside.config import MOST_SHUFFLE_PARTITIONS, shuffle_partitions_for, sized_shuffles
    from kerbside.sources.lake import stored_bytes

    assert shuffle_partitions_for(100 << 40, 8000) == MOST_SHUFFLE_PARTITIONS
    assert shuffle_partitions_for(1 << 20, 8) == 16                  # at least two waves
    spark.range(1000).write.parquet(f"{workdir}/t")
    n = stored_bytes(spark, [f"{workdir}/t"])
    assert n == sum(os.path.getsize(os.path.join(f"{workdir}/t", f))
                    for f in os.listdir(f"{workdir}/t") if not f.startswith((".", "_")))
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    with sized_shuffles(spark, 10 << 30):
        assert spark.conf.get(key) == "80"                             # 10 GB / 128 MB
    assert spark.conf.get(key) == before


def test_month_scoped_mart_reads_only_batch_months(spark, workdir):
    from kerbside.operators import marts

    _silver(spark).write.partitionBy("source_month").parquet(f"{workdir}/silver")
    stored = spark.read.parquet(f"{workdir}/silver")
    p = plan(marts.zone_hourly_demand_months(stored, fixtures.bronze_weather(spark, SF),
                                             ["2024-01"]))
    assert re.search(r"PartitionFilters: \[[^\]]*source_month[^\]]*2024-01", p)


def test_zone_demand_since_prunes_mart_months(spark, workdir):
    from kerbside.operators import marts

    m = marts.zone_hourly_demand_months(_silver(spark), fixtures.bronze_weather(spark, SF))
    m.write.partitionBy("pickup_month").parquet(f"{workdir}/mart")
    stored = spark.read.parquet(f"{workdir}/mart")
    q = serving.zone_demand(stored, 7, 24, "2024-01-20 00:00:00")
    assert re.search(r"PartitionFilters: \[[^\]]*pickup_month", plan(q))
    got = [r.pickup_hour for r in q.collect()]
    want = [r.pickup_hour for r in serving.zone_demand(
        m.drop("pickup_month"), 7, 24, "2024-01-20 00:00:00").collect()]
    assert got == want and all(str(h) >= "2024-01-20" for h in got)
