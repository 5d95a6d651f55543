"""Silver, fact, SCD2, merge and serving operators on hand-written rows."""
from __future__ import annotations

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from kerbside.operators import facts, merge, scd2, serving, silver
from kerbside.schemas import SILVER_TRIPS

BRONZE = ("tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
          "pulocationid bigint, dolocationid bigint, passenger_count bigint, "
          "trip_distance double, total_amount double, _source_month string")


def ts(s):
    return dt.datetime.fromisoformat(s)


def test_silver_keeps_rows_that_pass_every_filter(spark):
    nan, at = float("nan"), ts("2023-06-30 23:59:59")
    good = (at, ts("2023-07-01 00:20:00"), 41, 7, 2, 0.004, 0.01, "2023-06")

    def but(place, value):
        return (*good[:place], value, *good[place + 1:])

    bad = [but(0, None), but(0, ts("2023-07-01 00:00:00")), but(0, ts("2003-06-30 12:00:00")),
           *[but(place, v) for place in (5, 6) for v in (0.0, -0.5, nan, None)], but(7, "2023-07")]
    open_ends = [but(1, None), but(2, None), but(3, None), but(4, None)]
    got = silver.clean_trips(spark.createDataFrame([good, *bad, *open_ends], BRONZE))
    assert got.schema == SILVER_TRIPS
    assert got.count() == 1 + len(open_ends)
    first = got.where("dropoff_ts IS NOT NULL AND pickup_zone_id = 41 AND dropoff_zone_id = 7 "
                      "AND passenger_count = 2").collect()
    assert [tuple(r) for r in first] == [good]
    assert silver.clean_trips(spark.createDataFrame([good], BRONZE), months=[]).count() == 0


def _silver(spark, rows):
    return spark.createDataFrame(rows, SILVER_TRIPS)


def test_trip_key_text_and_hash_are_frozen(spark):
    full = (ts("2021-11-07 17:42:03.000815"), ts("2021-11-07 18:05:59.500000"), 23, 201, 3, 6.04, 27.8, "2021-11")
    bare = (*full[:3], None, None, *full[5:])
    head = "2021-11-07 17:42:03.000815|2021-11-07 18:05:59.500000|23|"
    want = {h.upper() for h in (hashlib.md5(f"{head}{end}".encode()).hexdigest() for end in ("201|6.04|27.8|3", "|6.04|27.8|"))}
    got = facts.keyed_trips(_silver(spark, [full, bare])).collect()
    assert {r.trip_key for r in got} == want
    assert all((r.pickup_date_key, r.pickup_weather_key, r.trip_minutes) == (20211107, 2021110717, 23) for r in got)


def test_minutes_truncate(spark):
    row = (ts("2024-01-01 00:00:50"), ts("2024-01-01 00:01:10"), 1, 2, 1, 1.0, 1.0, "2024-01")
    assert facts.keyed_trips(_silver(spark, [row])).first().trip_minutes == 0


def test_fact_dedupes_and_rejects_null_keys(spark):
    a = (ts("2024-01-01 00:00:00"), ts("2024-01-01 00:10:00"), 1, 2, 1, 1.0, 5.0, "2024-01")
    no_zone = (ts("2024-01-01 00:00:00"), ts("2024-01-01 00:10:00"), None, 2, 1, 1.0, 5.0, "2024-01")
    backwards = (ts("2024-01-01 00:10:00"), ts("2024-01-01 00:00:00"), 1, 2, 1, 1.0, 5.0, "2024-01")
    s = _silver(spark, [a, a, a, no_zone, no_zone, backwards])
    assert facts.build_fact(s).count() == 1
    assert facts.fact_rejects(s).count() == 2
    d = facts.duplicates_removed(s).first()
    assert (d.rows_in, d.rows_out, d.removed) == (3, 1, 2)


# --- SCD2 ---------------------------------------------------------------------

ZONE = "zone_id int, borough string, zone_name string, service_zone string"
COLS = ["borough", "zone_name", "service_zone"]
T1, T2, T3 = "2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-03-01 00:00:00"


def _versions(hist):
    rows = [(r.zone_id, r.borough, r.zone_name, r.service_zone, str(r.valid_from),
             None if r.valid_to is None else str(r.valid_to)) for r in hist.collect()]
    return sorted(rows, key=lambda t: tuple("" if x is None else str(x) for x in t))


def test_scd2_transitions(spark):
    v1 = spark.createDataFrame([
        (1, "A", "one", "Y"), (2, "B", "two", "Y"), (3, "C", "three", "Y"),
        (4, "D", "four", "Y"), (5, "E", None, "Y"), (6, "F", "six", "Y"), (7, "G", "seven", "Y"),
    ], ZONE)
    v2 = spark.createDataFrame([
        (1, "A", "one", "Y"),            # no change
        (2, "B2", "two", "Y"),           # borough changes
        (3, "C", "three!", "Y"),         # name changes
        (4, "D", "four", "Z"),           # service zone changes
        (5, "E", "five", "Y"),           # NULL -> value
        (6, "F", None, "Y"),             # value -> NULL
        (8, "H", "eight", "Y"),          # insert   (7 is hard-deleted)
    ], ZONE)
    h1 = scd2.scd2_apply(None, v1, "zone_id", COLS, T1)
    h2 = scd2.scd2_apply(h1, v2, "zone_id", COLS, T2)
    got = _versions(h2)
    t1, t2 = "2024-01-01 00:00:00", "2024-02-01 00:00:00"
    assert (1, "A", "one", "Y", t1, None) in got
    for z in (2, 3, 4, 5, 6):
        assert sum(1 for g in got if g[0] == z) == 2
        assert any(g[0] == z and g[5] == t2 for g in got)
        assert any(g[0] == z and g[4] == t2 and g[5] is None for g in got)
    assert (7, "G", "seven", "Y", t1, t2) in got
    assert (8, "H", "eight", "Y", t2, None) in got
    # re-appearance of 7 and an identical re-run are both handled
    v3 = v2.unionByName(spark.createDataFrame([(7, "G", "seven", "Y")], ZONE))
    h3 = scd2.scd2_apply(h2.checkpoint(), v3, "zone_id", COLS, T3)
    got3 = _versions(h3)
    assert (7, "G", "seven", "Y", "2024-03-01 00:00:00", None) in got3
    assert len(got3) == len(got) + 1
    again = scd2.scd2_apply(h3.checkpoint(), v3, "zone_id", COLS, T3)
    assert _versions(again) == got3
    # one open version per key
    cur = h3.where(F.col("valid_to").isNull()).groupBy("zone_id").count()
    assert cur.where("count > 1").count() == 0


def test_scd2_null_keys_and_backward_stamps_raise(spark):
    v = spark.createDataFrame([(1, "A", "x", "Y"), (None, "A", "y", "Y")], ZONE)
    with pytest.raises(scd2.NullKeyError):
        scd2.scd2_apply(None, v, "zone_id", COLS, T1)
    with pytest.raises(Exception, match="NULL values of 'zone_id'"):
        scd2.scd2_apply(None, v, "zone_id", COLS, T1, check_unique="in_plan").collect()
    one = spark.createDataFrame([(1, "A", "x", "Y")], ZONE)
    other = spark.createDataFrame([(1, "A", "z", "Y")], ZONE)
    hist = scd2.scd2_apply(None, one, "zone_id", COLS, T2).checkpoint()
    with pytest.raises(Exception, match="before the start of an open version"):
        scd2.scd2_apply(hist, other, "zone_id", COLS, T1).collect()


def test_scd2_duplicate_incoming_key_raises(spark):
    v = spark.createDataFrame([(1, "A", "x", "Y"), (1, "A", "y", "Y")], ZONE)
    with pytest.raises(scd2.DuplicateKeyError):
        scd2.scd2_apply(None, v, "zone_id", COLS, T1)


# --- merge --------------------------------------------------------------------

def _day_trips(spark, days, dup=False):
    rows = []
    for d in days:
        for i in range(3):
            p = dt.datetime(2024, 1, d, i, 0, 0)
            rows.append((p, p + dt.timedelta(minutes=7), i, None, None, 1.0 + i, 10.0, "2024-01"))
    if dup:
        rows += rows[:2]
    return _silver(spark, rows)


def test_merge_watermark_is_idempotent(spark, workdir):
    s = _day_trips(spark, [1, 2, 3], dup=True)
    target = f"{workdir}/fact"
    assert merge.load_fact(spark, s, target)["mode"] == "create"
    assert merge.load_fact(spark, s, target)["mode"] == "noop"
    assert spark.read.parquet(target).count() == 9
    assert merge.watermark(spark, target) == dt.date(2024, 1, 3)


def test_merge_backfill_merges_and_keeps_other_days(spark, workdir):
    target = f"{workdir}/fact"
    merge.load_fact(spark, _day_trips(spark, [1, 2]), target)
    merge.load_fact(spark, _day_trips(spark, [5]), target)
    # a late day older than the watermark is skipped by the watermark ...
    merge.load_fact(spark, _day_trips(spark, [1, 2, 3, 5]), target)
    assert spark.read.parquet(target).count() == 9
    # ... and merged by a backfill, twice without duplicates
    for _ in range(2):
        merge.load_fact(spark, _day_trips(spark, [1, 2, 3, 5], dup=True), target,
                        "backfill", "2024-01-02", "2024-01-03")
    got = spark.read.parquet(target)
    assert got.count() == 12
    assert got.select("trip_key").distinct().count() == 12


def test_unfinished_append_is_repeated_from_its_watermark(spark, workdir, monkeypatch):
    target, trips = f"{workdir}/fact", _day_trips(spark, [1, 2, 5, 6])
    merge.load_fact(spark, _day_trips(spark, [1, 2]), target)
    write = merge.write_day_partitioned

    def half(df, path, *args, **kwargs):     # the later day lands, then the load dies
        write(df.where("pickup_date = '2024-01-06'"), path, *args, **kwargs)
        raise OSError("executor lost")

    monkeypatch.setattr(merge, "write_day_partitioned", half)
    with pytest.raises(OSError):
        merge.load_fact(spark, trips, target)
    monkeypatch.undo()
    assert merge.watermark(spark, target) == dt.date(2024, 1, 2)
    merge.load_fact(spark, trips, target)
    assert spark.read.parquet(target).count() == 12
    assert merge.watermark(spark, target) == dt.date(2024, 1, 6)


def test_backfill_leaves_no_staged_copy(spark, workdir):
    import glob

    from kerbside.config import ensure_checkpoint_dir

    target = f"{workdir}/fact"
    merge.load_fact(spark, _day_trips(spark, [1, 2, 3]), target)
    before = set(glob.glob(f"{ensure_checkpoint_dir(spark)}/kerbside-stage/*"))
    merge.load_fact(spark, _day_trips(spark, [2, 3]), target, "backfill", "2024-01-02", "2024-01-03")
    assert set(glob.glob(f"{ensure_checkpoint_dir(spark)}/kerbside-stage/*")) == before
    assert spark.read.parquet(target).count() == 9


def test_sums_keep_small_and_show_odd_values(spark):
    from kerbside.functions.numeric import exact_avg, exact_sum

    def both(values):
        r = spark.createDataFrame([(v,) for v in values], "v double").agg(
            exact_sum("v").alias("s"), exact_avg("v").alias("a")).first()
        return r.s, r.a

    assert both([0.004, 0.004, 0.004, None]) == (0.012, 0.004)
    assert both([None]) == (None, None)
    assert both([1.0, float("inf")])[0] == float("inf")
    assert both([1.0, float("nan")])[0] != both([1.0, float("nan")])[0]
    assert both([1e300, 1e300])[0] == 2e300


# --- serving ------------------------------------------------------------------

def test_limit_bounds():
    for bad in (0, 169, -1, "5", True):
        with pytest.raises(ValueError):
            serving.check_limit(bad)
    assert serving.check_limit(168) == 168


def test_zone_demand_latest_first(spark):
    mart = spark.createDataFrame(
        [(1, ts(f"2024-01-01 {h:02d}:00:00"), h, 1.0, 1.0, None, None) for h in range(5)]
        + [(2, ts("2024-01-01 09:00:00"), 1, 1.0, 1.0, None, None)],
        "pickup_zone_id int, pickup_hour timestamp_ntz, trip_count bigint, revenue double, "
        "avg_distance double, temperature_2m double, precipitation double")
    got = [r.trip_count for r in serving.zone_demand(mart, 1, 3).collect()]
    assert got == [4, 3, 2]
    since = [r.trip_count for r in serving.zone_demand(mart, 1, 24, "2024-01-01 03:00:00").collect()]
    assert since == [4, 3]


def test_mart_counts_silver_not_the_fact(spark):
    """The mart reads silver, so it counts replayed and dropoff-before-pickup
    trips that the fact leaves out."""
    from kerbside.operators import marts
    from kerbside.sources import fixtures

    sf = "/root/testdata/sf0.001"
    s = silver.clean_trips(fixtures.bronze_trips(spark, sf))
    mart = marts.zone_hourly_demand(s, fixtures.bronze_weather(spark, sf))
    n_silver = s.count()
    assert mart.agg(F.sum("trip_count")).first()[0] == n_silver
    assert facts.build_fact(s).count() < n_silver


def test_scd2_in_plan_check_matches_eager_and_fails_the_job(spark):
    v1 = spark.createDataFrame([(1, "A", "one", "Y"), (2, "B", "two", "Y")], ZONE)
    v2 = spark.createDataFrame([(1, "A", "uno", "Y"), (3, "C", "three", "Y")], ZONE)
    eager = scd2.scd2_apply(scd2.scd2_apply(None, v1, "zone_id", COLS, T1), v2, "zone_id",
                            COLS, T2)
    folded = scd2.scd2_apply(scd2.scd2_apply(None, v1, "zone_id", COLS, T1,
                                             check_unique="in_plan"),
                             v2, "zone_id", COLS, T2, check_unique="in_plan")
    assert _versions(folded) == _versions(eager)
    dup = spark.createDataFrame([(1, "A", "x", "Y"), (1, "A", "y", "Y")], ZONE)
    lazy = scd2.scd2_apply(eager.checkpoint(), dup, "zone_id", COLS, T3, check_unique="in_plan")
    with pytest.raises(Exception, match="duplicate values of 'zone_id'"):
        lazy.collect()
