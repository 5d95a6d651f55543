"""Print the formatted physical plans of the headline queries (markdown).

    python scripts/show_plans.py [sf_dir] > PLANS.md

Plans are taken before execution (AQE may still coalesce partitions, switch a
join to broadcast or split a skewed partition at run time).  Scratch paths are
shortened to ``<scratch>``.
"""
from __future__ import annotations

import contextlib
import datetime as dt
import io
import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = re.sub(r"file:/\S*?/(kerbside-[^/\s]+|checkpoints)/\S*", "<scratch>", buf.getvalue())
    return re.sub(r"#\d+L?", "", text)


def main() -> None:
    from pyspark.sql import functions as F

    from kerbside.config import local_session
    from kerbside.operators import facts, marts, merge, quality, serving, silver
    from kerbside.plans import queries as catalogue
    from kerbside.sources import fixtures

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    scratch = tempfile.mkdtemp(prefix="kerbside-plans-")
    spark = local_session("kerbside-plans", 8, 8, scratch=scratch)
    s = silver.clean_trips(fixtures.bronze_trips(spark, sf))
    fact_path = f"{scratch}/fact"
    facts.build_fact(s).write.partitionBy("pickup_date").parquet(fact_path)
    fact = spark.read.parquet(fact_path)
    mart = marts.zone_hourly_demand(s, fixtures.bronze_weather(spark, sf))
    s.write.partitionBy("source_month").parquet(f"{scratch}/silver")
    stored_silver = spark.read.parquet(f"{scratch}/silver")
    catalogue.dim_zone(spark, sf).write.parquet(f"{scratch}/dim_zone")
    dim_zone = spark.read.parquet(f"{scratch}/dim_zone")
    shown = {
        "silver (C1): filters and projection pushed into the scan": s,
        "fact build (C5): key, partial de-duplication before the shuffle": facts.build_fact(s),
        "mart (C6): both sides aggregated, weather joined at hour grain": mart,
        "top zones (C8): per-zone partial sums before the join, top-k": serving.top_zones(
            mart, dim_zone, 10),
        "single day (C11): partition filter on the day-partitioned fact":
            serving.single_day_revenue(fact, dt.date(2024, 1, 15)),
        "watermark (S7): answered from the partition listing":
            _listing_only(spark, fact.agg(F.max("pickup_date"))),
        "watermark source (S7): prunes silver months": merge.incremental_source(
            stored_silver, dt.date(2024, 1, 20)),
        "bronze gate (Q2-Q6): one aggregate for all row-level checks": quality.run_suite(
            fixtures.bronze_trips(spark, sf), quality.bronze_trip_suite()),
    }
    from kerbside.operators import scd2
    cols = ["borough", "zone_name", "service_zone"]
    hist = scd2.scd2_apply(None, fixtures.zones_version(spark, sf, 1), "zone_id", cols,
                           fixtures.AS_OF_STAMPS[0], check_unique=False)
    hist.write.parquet(f"{scratch}/zone_history")
    shown["SCD2 (J8) as for a large dimension (no static broadcast): the duplicate-key check "
          "is the grouping whose shuffle the full-outer join reuses"] = _no_broadcast(
        spark, scd2.scd2_apply(spark.read.parquet(f"{scratch}/zone_history"),
                               fixtures.zones_version(spark, sf, 2), "zone_id", cols,
                               fixtures.AS_OF_STAMPS[1], check_unique="in_plan"))
    print(f"# Physical plans of the headline queries\n\nGenerated by `scripts/show_plans.py` "
          f"on `{os.path.basename(sf.rstrip('/'))}`.\n")
    for title, df in shown.items():
        print(f"## {title}\n\n```\n{formatted(df).strip()}\n```\n")
    spark.stop()


def _listing_only(spark, df):
    """Plan ``df`` with the partition-listing rule on (see sources.lake)."""
    from kerbside.sources.lake import partition_listing_only

    class Planned:
        def explain(self, mode):
            with partition_listing_only(spark):
                df.explain(mode)
    return Planned()


def _no_broadcast(spark, df):
    """Plan ``df`` with static broadcast joins off."""
    class Planned:
        def explain(self, mode):
            key = "spark.sql.autoBroadcastJoinThreshold"
            old = spark.conf.get(key)
            spark.conf.set(key, "-1")
            try:
                df.explain(mode)
            finally:
                spark.conf.set(key, old)
    return Planned()


if __name__ == "__main__":
    main()
