"""Queries beyond the source models: history as of a row's time, recovery, quarantine, clustered serving, late
streams, roll-ups, rolling demand, compaction, differences, freshness and the scan limit.

Same form as :mod:`kerbside.plans.queries`; :mod:`kerbside.plans.catalogue` joins the two.
"""
from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.config import LakeConfig
from kerbside.operators import (
    clustering, facts, freshness, lake_diff, quality, quarantine, rolling, rollups, scan_guard, scan_report, serving,
)
from kerbside.operators.marts import MONTH_COLUMN, zone_hourly_demand_months
from kerbside.operators.point_in_time import as_of_join
from kerbside.operators.scd2 import scd2_apply
from kerbside.plans import queries as base
from kerbside.plans.oracle import sql
from kerbside.sinks import compaction
from kerbside.sinks.versions import valid_path, write_version
from kerbside.sources import fixtures

#: When the zone and customer versions began, inside the time the trips and orders span.
ZONE_STAMPS = ("2024-01-01 00:00:00", "2024-01-10 12:00:00", "2024-01-20 00:00:00")
CUSTOMER_STAMPS = ("1995-06-01 00:00:00", "1997-06-01 00:00:00", "1999-06-01 00:00:00")
PASSENGERS = 4


def zone_versions(spark: SparkSession, sf_dir: str, path: str | None = None, stamps=ZONE_STAMPS) -> DataFrame:
    """Zone history of three extracts; with ``path`` kept there, each state a version of the table."""
    hist = None
    for i, stamp in enumerate(stamps):
        extract = fixtures.zones_version(spark, sf_dir, 2 if i == 1 else 1)
        hist = scd2_apply(hist, extract, "zone_id", base.ZONE_CHECK_COLUMNS, stamp, check_unique="in_plan")
        if path:
            write_version(hist, path)
            hist = spark.read.parquet(valid_path(spark, path))
    return hist


def q_trips_zone_as_of(spark, sf_dir):
    """Every trip of the fact with the zone's name and district at its pickup."""
    fact = base.fact_trips(spark, sf_dir).select("trip_key", "pickup_ts", "pickup_zone_id", "total_amount")
    return as_of_join(fact, zone_versions(spark, sf_dir), "pickup_zone_id", "pickup_ts", "zone_id",
                      ["zone_name", "borough", "valid_from"])


def q_revenue_by_zone_as_of(spark, sf_dir):
    """Trips and revenue by the zone name that held at pickup; trips without a valid version count under no name."""
    from kerbside.functions.numeric import exact_sum
    return q_trips_zone_as_of(spark, sf_dir).groupBy("zone_name").agg(
        F.count(F.lit(1)).alias("trips"), exact_sum("total_amount").alias("revenue"))


def q_orders_segment_as_of(spark, sf_dir):
    """Every order with the customer's segment at the order's time, from the customer history."""
    base._session(spark)
    hist = None
    for i, stamp in enumerate(CUSTOMER_STAMPS):
        extract = fixtures.customer_version(spark, sf_dir, 2 if i == 1 else 1)
        hist = scd2_apply(hist, extract, "c_custkey", ["c_name", "c_mktsegment"], stamp, check_unique="in_plan")
    orders = fixtures.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return as_of_join(orders, hist, "o_custkey", "o_orderdate", "c_custkey", ["c_mktsegment", "valid_from", "valid_to"])


def q_scd2_zone_history_versions(spark, sf_dir):
    """The zone history kept as versions of a table, each read for the next."""
    path = f"{base.scratch(base._session(spark), 'zone-versions')}/zone_snapshot"
    return zone_versions(spark, sf_dir, path, base.AS_OF)


def q_pipeline_after_failed_run(spark, sf_dir):
    """December builds, January lands with weather that fails its test, December lands again with good weather: the fact has both months."""
    from kerbside.plans.pipeline import run_pipeline
    cfg = LakeConfig(base.scratch(base._session(spark), "recovered-lake"))
    trips, weather = fixtures.two_month_trips(spark, sf_dir), fixtures.clean_weather(spark, sf_dir)
    january = F.col("_source_month") == base.INCREMENTAL_MONTH
    run_pipeline(spark, cfg, trips.where(~january), weather, fixtures.zones_version(spark, sf_dir, 1), base.AS_OF[0])
    try:
        run_pipeline(spark, cfg, trips.where(january), weather.unionByName(weather))
    except quality.QualityError:
        run_pipeline(spark, cfg, trips.where(~january), weather)
    return base._lake_table(spark, cfg, "gold", "fact_trips", facts.FACT_COLUMNS)


def _sorted_out(spark, sf_dir) -> tuple[str, dict]:
    path = base.scratch(base._session(spark), "sorted-out")
    rules = quarantine.trip_rules(max_passengers=PASSENGERS)
    return path, quarantine.write_sorted_out(fixtures.bronze_trips(spark, sf_dir), path, rules)


def q_quarantined_trips(spark, sf_dir):
    """Bronze rows that break a rule, with the rules they break."""
    path, _ = _sorted_out(spark, sf_dir)
    rows = quarantine.read_side(spark, path, quarantine.QUARANTINED)
    return rows.withColumn(quarantine.REASONS, F.array_join(quarantine.REASONS, ","))


def q_accepted_trips(spark, sf_dir):
    """Bronze rows that break no rule."""
    path, _ = _sorted_out(spark, sf_dir)
    return quarantine.read_side(spark, path, quarantine.ACCEPTED)


def q_quarantine_counts(spark, sf_dir):
    """The counts observed while the rows were written."""
    path, counts = _sorted_out(spark, sf_dir)
    return spark.createDataFrame(sorted(counts.items()), "measure string, n long")


def _clustered(spark, sf_dir) -> str:
    path = base.scratch(base._session(spark), "clustered-mart")
    mart = zone_hourly_demand_months(base.silver_trips(spark, sf_dir), fixtures.bronze_weather(spark, sf_dir))
    return clustering.write_clustered_mart(mart, path)


def q_zone_demand_clustered(spark, sf_dir):
    """C7 on the mart in curve order."""
    return serving.zone_demand(spark.read.parquet(_clustered(spark, sf_dir)), base.DEMAND_ZONE, 24)


def q_mart_clustered(spark, sf_dir):
    """The whole mart, written in curve order and read back."""
    return spark.read.parquet(_clustered(spark, sf_dir)).drop(MONTH_COLUMN)


def q_demand_stream_any_order(spark, sf_dir):
    """Trips streamed in three drops: late January, then the earlier days behind the watermark, then late January once more."""
    from kerbside.sinks.writers import land_files
    from kerbside.streaming import late_trips
    root, out = base.scratch(base._session(spark), "drops"), base.scratch(spark, "demand-stream")
    trips = fixtures.bronze_trips(spark, sf_dir)
    cut = F.lit(base.INCREMENTAL_CUT).cast("timestamp_ntz")
    newer = F.col("tpep_pickup_datetime") >= cut
    name = F.concat(F.lit("yellow_tripdata_"), F.col("_source_month"), F.lit(".parquet"))
    lineage = ("_source_dataset", "_source_month")
    for i, drop in enumerate((trips.where(newer), trips.where(~newer), trips.where(newer))):
        land_files(drop, f"{root}/drop{i}", name, drop=lineage)
        late_trips.take_landed(spark, root, out, trips.drop(*lineage).schema)
    return late_trips.demand(spark, out)


def q_rollup_levels(spark, sf_dir):
    """Hour, day, month and all from one table of sketches, held against exact distinct counts."""
    path = rollups.write_sketches(base.fact_trips(spark, sf_dir), base.scratch(base._session(spark), "sketches"))
    return rollups.compared(spark, path, base.fact_trips(spark, sf_dir))


def q_compacted_fact(spark, sf_dir):
    """The fact, written in many small files and compacted."""
    path = base.scratch(base._session(spark), "fact-small-files")
    base.fact_trips(spark, sf_dir).repartition(6).write.partitionBy("pickup_date").parquet(path)
    done = compaction.compact(spark, path, "pickup_date")
    if done.files_after != done.partitions:
        raise RuntimeError(f"not compacted: {done}")
    return spark.read.parquet(path).select(*facts.FACT_COLUMNS)


def q_lake_difference(spark, sf_dir):
    """Two copies of the fact, one with changed amounts and missing trips on two days."""
    left, right = (base.scratch(base._session(spark), f"difference-{side}") for side in ("left", "right"))
    fact = base.fact_trips(spark, sf_dir)
    fact.write.partitionBy("pickup_date").parquet(left)
    day = F.col("pickup_date") == F.lit(base.BENCH_DAY)
    amount = F.when(day & (F.col("trip_minutes") % 4 == 0), F.col("total_amount") + 1).otherwise(F.col("total_amount"))
    lost = (F.col("pickup_date") == F.lit(base.BENCH_DAY) + F.expr("INTERVAL 3 DAYS")) & (F.col("trip_minutes") % 5 == 0)
    fact.withColumn("total_amount", amount).where(~lost).write.partitionBy("pickup_date").parquet(right)
    return lake_diff.table_difference(spark.read.parquet(left), spark.read.parquet(right), "pickup_date")


def q_rolling_demand(spark, sf_dir):
    """Dense demand of every zone with its mean over the last seven days."""
    return rolling.rolling_demand(base.mart(spark, sf_dir), 168)


def q_source_freshness(spark, sf_dir):
    """Trips and weather that have just landed, and a source that has not, against a bound of a day; then all of them a month later."""
    root = base.scratch(base._session(spark), "fresh-landing")
    fixtures.land_trip_files(spark, sf_dir, f"{root}/trips")
    fixtures.land_weather_payloads(spark, sf_dir, f"{root}/weather")
    sources = {name: f"{root}/{name}" for name in ("trips", "weather", "zones")}
    now, report = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None), None
    for when, at in (("landed", now), ("a month later", now + dt.timedelta(days=31))):
        rows = freshness.freshness(spark, sources, at, dt.timedelta(days=1)).select(
            F.lit(when).alias("checked"), "source", (F.col("files") > 0).alias("has_files"), "newest_month", "fresh")
        report = rows if report is None else report.unionByName(rows)
    return report


def q_scan_guard(spark, sf_dir):
    """The single-day query on a flat and on a day-partitioned fact under a limit of half the flat table; planned bytes against those of M1."""
    fact, rows = base.fact_trips(spark, sf_dir), []
    paths = {name: base.scratch(spark, f"guard-{name}") for name in ("unpartitioned", "pickup_date")}
    fact.coalesce(4).write.parquet(paths["unpartitioned"])
    fact.write.partitionBy("pickup_date").parquet(paths["pickup_date"])
    limit = scan_guard.planned_bytes(spark.read.parquet(paths["unpartitioned"])) // 2
    for name, path in paths.items():
        day = spark.read.parquet(path).where(F.col("pickup_date") == F.lit(base.BENCH_DAY))
        planned, measured = scan_guard.planned_bytes(day), scan_report.measured_scan(spark, day)[1]["bytes"]
        try:
            n = scan_guard.guarded(day, limit).count()
            rows.append((name, False, n, planned == measured))
        except scan_guard.ScanLimitError:
            rows.append((name, True, None, planned == measured))
    return spark.createDataFrame(rows, "layout string, refused boolean, rows_matched long, agrees_with_scan boolean")


QUERIES: dict[str, base.Query] = {
    "trips_zone_as_of": q_trips_zone_as_of,
    "revenue_by_zone_as_of": q_revenue_by_zone_as_of,
    "orders_segment_as_of": q_orders_segment_as_of,
    "scd2_zone_history_versions": q_scd2_zone_history_versions,
    "pipeline_after_failed_run": q_pipeline_after_failed_run,
    "quarantined_trips": q_quarantined_trips,
    "accepted_trips": q_accepted_trips,
    "quarantine_counts": q_quarantine_counts,
    "zone_demand_clustered": q_zone_demand_clustered,
    "mart_clustered": q_mart_clustered,
    "demand_stream_any_order": q_demand_stream_any_order,
    "rollup_levels": q_rollup_levels,
    "compacted_fact": q_compacted_fact,
    "lake_difference": q_lake_difference,
    "rolling_demand": q_rolling_demand,
    "source_freshness": q_source_freshness,
    "scan_guard": q_scan_guard,
}


def _restamped(stamps) -> str:
    """The zone history of the oracle with other stamps."""
    text = base.sql(["zone_history"], "")
    for old, new in zip(fixtures.AS_OF_STAMPS, stamps, strict=True):
        text = text.replace(old, f"#{new}")
    return text.replace("#", "").rstrip().removeprefix("WITH ")


_AS_OF_TRIPS = f"""
    SELECT f.trip_key, f.pickup_ts, f.pickup_zone_id, f.total_amount, z.zone_name, z.borough, z.valid_from
    FROM fact f LEFT JOIN zone_history z ON z.zone_id = f.pickup_zone_id AND z.valid_from <= f.pickup_ts
                                        AND (z.valid_to IS NULL OR f.pickup_ts < z.valid_to)"""
_CUSTOMERS = f"""
    c AS (SELECT c_custkey, c_mktsegment, c_custkey % 5 = 0 AS moves, c_custkey % 11 = 10 AS leaves FROM customer),
    h AS (SELECT c_custkey, c_mktsegment, TIMESTAMP '{CUSTOMER_STAMPS[0]}' AS valid_from,
                 CASE WHEN moves OR leaves THEN TIMESTAMP '{CUSTOMER_STAMPS[1]}' END AS valid_to FROM c
          UNION ALL SELECT c_custkey, 'MOVED', TIMESTAMP '{CUSTOMER_STAMPS[1]}', TIMESTAMP '{CUSTOMER_STAMPS[2]}'
                    FROM c WHERE moves AND NOT leaves
          UNION ALL SELECT c_custkey, c_mktsegment, TIMESTAMP '{CUSTOMER_STAMPS[2]}', NULL FROM c WHERE moves OR leaves)"""
_TAGGED = f"""
    , tagged AS (
      SELECT *, concat_ws(',',
        CASE WHEN tpep_pickup_datetime IS NULL THEN 'no_pickup_time' END,
        CASE WHEN total_amount > 0 AND NOT isnan(total_amount) THEN NULL ELSE 'amount_not_positive' END,
        CASE WHEN trip_distance > 0 AND NOT isnan(trip_distance) THEN NULL ELSE 'distance_not_positive' END,
        CASE WHEN strftime(tpep_pickup_datetime, '%Y-%m') <> _source_month THEN 'late' END,
        CASE WHEN _source_month IS NULL THEN 'no_source_month' END,
        CASE WHEN passenger_count NOT BETWEEN 0 AND {PASSENGERS} THEN 'passengers_out_of_range' END) AS broken_rules
      FROM bronze_trips)"""
_RULES = ("no_pickup_time", "amount_not_positive", "distance_not_positive", "late", "no_source_month", "passengers_out_of_range")
_TWO_MONTHS = """
    , moved AS (
      SELECT * FROM bronze_trips WHERE day(tpep_pickup_datetime) >= 15
      UNION ALL
      SELECT tpep_pickup_datetime - INTERVAL 15 DAY, tpep_dropoff_datetime - INTERVAL 15 DAY, pulocationid, dolocationid,
             passenger_count, trip_distance, total_amount, _source_dataset, strftime(tpep_pickup_datetime - INTERVAL 15 DAY, '%Y-%m')
      FROM bronze_trips WHERE day(tpep_pickup_datetime) < 15)"""

ORACLE: dict[str, str] = {
    "trips_zone_as_of": f"{sql(['fact'], '').rstrip()}, {_restamped(ZONE_STAMPS)} {_AS_OF_TRIPS}",
    "revenue_by_zone_as_of": f"""{sql(['fact'], '').rstrip()}, {_restamped(ZONE_STAMPS)}
        SELECT zone_name, count(*) AS trips, CAST(sum(CAST(total_amount AS DECIMAL(28,9))) AS DOUBLE) AS revenue
        FROM ({_AS_OF_TRIPS}) GROUP BY zone_name""",
    "orders_segment_as_of": f"""WITH {_CUSTOMERS}
        SELECT o.o_orderkey, o.o_custkey, o.o_orderdate, h.c_mktsegment, h.valid_from, h.valid_to
        FROM orders o LEFT JOIN h ON h.c_custkey = o.o_custkey AND h.valid_from <= o.o_orderdate
                                 AND (h.valid_to IS NULL OR o.o_orderdate < h.valid_to)""",
    "scd2_zone_history_versions": base.ORACLE["scd2_zone_history"],
    "quarantined_trips": sql(["bronze_trips"], f"{_TAGGED} SELECT * FROM tagged WHERE broken_rules <> ''"),
    "accepted_trips": sql(["bronze_trips"], f"{_TAGGED} SELECT * EXCLUDE (broken_rules) FROM tagged WHERE broken_rules = ''"),
    "quarantine_counts": sql(["bronze_trips"], f"""{_TAGGED}
        SELECT 'rows' AS measure, count(*) AS n FROM tagged
        UNION ALL SELECT 'accepted', CAST(count_if(broken_rules = '') AS BIGINT) FROM tagged
        """ + "".join(f"""
        UNION ALL SELECT 'rule_{r}', CAST(count_if(list_contains(string_split(broken_rules, ','), '{r}')) AS BIGINT) FROM tagged"""
                      for r in _RULES)),
    "zone_demand_clustered": base.ORACLE["zone_demand_latest"],
    "mart_clustered": base.ORACLE["zone_hourly_demand"],
    "demand_stream_any_order": sql(["fact"], """
        SELECT pickup_zone_id, date_trunc('hour', pickup_ts) AS pickup_hour, count(*) AS trip_count,
               CAST(sum(CAST(total_amount AS DECIMAL(28,9))) AS DOUBLE) AS revenue
        FROM fact GROUP BY 1, 2"""),
    "rollup_levels": sql(["fact"], """
        , small AS (SELECT *, strftime(pickup_ts, '%Y-%m') AS pickup_month, CAST(pickup_ts AS DATE) AS day,
                           date_trunc('hour', pickup_ts) AS hour,
                           concat_ws('>', CAST(pickup_zone_id AS VARCHAR), CAST(dropoff_zone_id AS VARCHAR)) AS route FROM fact)
        SELECT CASE WHEN hour IS NOT NULL THEN 'hour' WHEN day IS NOT NULL THEN 'day'
                    WHEN pickup_month IS NOT NULL THEN 'month' ELSE 'all' END AS level,
               pickup_month, day, hour, count(*) AS trips,
               CAST(sum(CAST(total_amount AS DECIMAL(28,9))) AS DOUBLE) AS revenue,
               count(DISTINCT route) AS routes, count(DISTINCT pickup_zone_id) AS zones, true AS estimates_hold
        FROM small GROUP BY GROUPING SETS ((pickup_month, day, hour), (pickup_month, day), (pickup_month), ())"""),
    "compacted_fact": base.ORACLE["fact_trips"],
    "lake_difference": sql(["fact"], f"""
        , changed AS (
          SELECT * REPLACE (CASE WHEN pickup_date = DATE '{base.BENCH_DAY}' AND trip_minutes % 4 = 0
                                 THEN total_amount + 1 ELSE total_amount END AS total_amount)
          FROM fact WHERE NOT (pickup_date = DATE '{base.BENCH_DAY + dt.timedelta(days=3)}' AND trip_minutes % 5 = 0))
        SELECT *, 'left' AS side FROM (SELECT * FROM fact EXCEPT ALL SELECT * FROM changed)
        UNION ALL SELECT *, 'right' FROM (SELECT * FROM changed EXCEPT ALL SELECT * FROM fact)"""),
    "rolling_demand": sql(["mart"], """
        , known AS (SELECT * FROM mart WHERE pickup_zone_id IS NOT NULL AND pickup_hour IS NOT NULL)
        , spine AS (SELECT pickup_zone_id, pickup_hour FROM (SELECT DISTINCT pickup_zone_id FROM known),
                    (SELECT unnest(generate_series(min(pickup_hour), max(pickup_hour), INTERVAL 1 HOUR)) AS pickup_hour FROM known))
        , dense AS (SELECT s.*, coalesce(k.trip_count, 0) AS trip_count FROM spine s LEFT JOIN known k USING (pickup_zone_id, pickup_hour))
        SELECT pickup_zone_id, pickup_hour, CAST(trip_count AS BIGINT) AS trip_count, CAST(sum(trip_count) OVER w AS BIGINT) AS rolling_trips,
               count(*) OVER w AS rolling_hours, CAST(sum(trip_count) OVER w AS DOUBLE) / count(*) OVER w AS rolling_mean
        FROM dense WINDOW w AS (PARTITION BY pickup_zone_id ORDER BY pickup_hour RANGE BETWEEN INTERVAL 167 HOURS PRECEDING AND CURRENT ROW)"""),
    "source_freshness": sql(["bronze_trips", "bronze_weather"], """
        , newest AS (SELECT 'trips' AS source, max(_source_month) AS m FROM bronze_trips
                     UNION ALL SELECT 'weather', max(_source_month) FROM bronze_weather UNION ALL SELECT 'zones', NULL)
        SELECT checked, source, m IS NOT NULL AS has_files, m AS newest_month, m IS NOT NULL AND checked = 'landed' AS fresh
        FROM newest, (VALUES ('landed'), ('a month later')) AS c(checked)"""),
    "scan_guard": sql(["fact"], f"""
        SELECT 'unpartitioned' AS layout, true AS refused, CAST(NULL AS BIGINT) AS rows_matched, true AS agrees_with_scan
        UNION ALL SELECT 'pickup_date', false, count(*), true FROM fact WHERE pickup_date = DATE '{base.BENCH_DAY}'"""),
}


def _fact_of(bronze: str) -> str:
    """The fact of another bronze table of the oracle."""
    from kerbside.plans.oracle import CTE
    return ",".join(CTE[n].replace("FROM bronze_trips", f"FROM {bronze}") for n in ("silver", "keyed", "fact"))


ORACLE["pipeline_after_failed_run"] = f"{sql(['bronze_trips'], '').rstrip()} {_TWO_MONTHS}, {_fact_of('moved')} SELECT * FROM fact"
