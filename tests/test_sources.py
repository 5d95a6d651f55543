"""Source scans: path rules, month bounds, landed files, weather payload, zone seed."""
from __future__ import annotations

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from kerbside.sources import month_bounds_columns, read_trips, trip_file_path
from kerbside.sources.weather import read_weather_payload, weather_file_path
from kerbside.sources.zones import read_zone_seed


def test_only_known_datasets_and_real_months_have_a_file():
    assert trip_file_path("s3://bucket/raw/", "fhvhv", "2021-12") == \
        "s3://bucket/raw/fhvhv_tripdata_2021-12.parquet"
    for dataset, month in (("taxi", "2021-12"), ("Yellow", "2021-12"), ("green", "2021-00"),
                           ("green", "21-12"), ("green", "2021-12-01"), ("", "2021-12")):
        with pytest.raises(ValueError):
            trip_file_path("/raw", dataset, month)


def test_month_bounds_at_year_ends_and_century_years(spark):
    df = spark.createDataFrame([("1999-12",), ("2000-02",), ("2100-02",), (None,)], "m string")
    first, last = month_bounds_columns("m")
    got = {r.m: (r.a, r.b) for r in df.select("m", first.alias("a"), last.alias("b")).collect()}
    assert got == {"1999-12": (dt.date(1999, 12, 1), dt.date(1999, 12, 31)),
                   "2000-02": (dt.date(2000, 2, 1), dt.date(2000, 2, 29)),
                   "2100-02": (dt.date(2100, 2, 1), dt.date(2100, 2, 28)), None: (None, None)}


def test_months_with_other_schemas_read_as_one_table(spark, workdir):
    a = spark.createDataFrame([(1, 2.0, "x")], "passenger_count int, extra double, note string")
    b = spark.createDataFrame([(3.0, 4)], "Passenger_Count double, extra long")
    a.write.parquet(trip_file_path(workdir, "yellow", "2020-01"))
    b.write.parquet(trip_file_path(workdir, "yellow", "2020-02"))
    got = {r._source_month: r for r in read_trips(spark, workdir, "yellow").collect()}
    assert (got["2020-01"].passenger_count, got["2020-02"].passenger_count) == (1, 3)
    assert (got["2020-01"].extra, got["2020-02"].extra) == ("2.0", "4")   # types differ: text
    assert got["2020-02"].note is None and got["2020-01"].dolocationid is None
    with pytest.raises(ValueError):
        read_trips(spark, workdir, "yellow", [])


def test_read_trips_stamps_lineage_from_file_names(spark, workdir):
    rows = [("2024-01-01 00:00:00", 100, 18.5), ("2024-01-02 00:00:00", 132, 42.0)]
    df = spark.createDataFrame(rows, "TPEP_PICKUP_DATETIME string, PULocationID int, total_amount double")
    df.write.parquet(trip_file_path(workdir, "yellow", "2024-01"))
    df.limit(1).write.parquet(trip_file_path(workdir, "yellow", "2024-02"))
    got = read_trips(spark, workdir, "yellow", ["2024-01", "2024-02"])
    assert "pulocationid" in got.columns and "tpep_pickup_datetime" in got.columns
    counts = {(r._source_dataset, r._source_month): r["count"]
              for r in got.groupBy("_source_dataset", "_source_month").count().collect()}
    assert counts == {("yellow", "2024-01"): 2, ("yellow", "2024-02"): 1}
    every = read_trips(spark, workdir, "yellow")          # all landed months, one glob
    assert every.count() == 3


def test_weather_payload_unpacks_parallel_arrays(spark, workdir):
    payload = {"hourly": {
        "time": ["2024-01-01T00:00", "2024-01-01T01:00", "2024-01-01T01:00"],
        "temperature_2m": [1.5, None, 2.5],
        "precipitation": [0.0, 0.2, 0.4],
        "wind_speed_10m": [10.0, 11.0, 12.0],
        "weather_code": [3, 61, 61],
    }}
    path = weather_file_path(workdir, "2024-01")
    with open(path, "w") as fh:
        json.dump(payload, fh, indent=2)
    rows = read_weather_payload(spark, [path]).orderBy("observed_at", "wind_speed_10m").collect()
    assert [r.observed_at for r in rows] == ["2024-01-01T00:00", "2024-01-01T01:00",
                                             "2024-01-01T01:00"]
    assert rows[1].temperature_2m is None and rows[2].weather_code == 61
    assert {r._source_month for r in rows} == {"2024-01"}

    from kerbside.operators.dimensions import weather_dimension
    dim = {r.weather_key: r for r in weather_dimension(read_weather_payload(spark, [path])).collect()}
    assert set(dim) == {2024010100, 2024010101}
    # the repeated hour is averaged; NULL readings are skipped
    assert dim[2024010101].temperature_2m == 2.5
    assert dim[2024010101].precipitation == pytest.approx(0.3)
    assert dim[2024010100].is_wet is False and dim[2024010101].is_wet is True


def test_zone_seed_keeps_na_text(spark, workdir):
    path = os.path.join(workdir, "zones.csv")
    with open(path, "w") as fh:
        fh.write('"LocationID","Borough","Zone","service_zone"\n'
                 '1,"Alpha","Harbor Point","EWR"\n'
                 '2,"Beta","Corona","Boro Zone"\n'
                 '3,"Beta","Corona","Boro Zone"\n'
                 '4,"Unknown","N/A","N/A"\n')
    z = read_zone_seed(spark, path)
    assert z.columns == ["zone_id", "borough", "zone_name", "service_zone"]
    rows = {r.zone_id: r for r in z.collect()}
    assert rows[4].zone_name == "N/A" and rows[4].service_zone == "N/A"
    assert z.where(F.col("zone_name").isNull()).count() == 0
    assert z.select("zone_name").distinct().count() == 3   # names are not unique


def test_spark_landed_trip_files_read_back_once(spark, workdir):
    from kerbside.sources import fixtures
    from kerbside.sources.trips import read_trips

    sf = "/root/testdata/sf0.001"
    root = f"{workdir}/landing"
    fixtures.land_trip_files(spark, sf, root)
    fixtures.land_trip_files(spark, sf, root)              # re-landing replaces, not appends
    expected = {(r._source_month, r["count"])
                for r in fixtures.bronze_trips(spark, sf).groupBy("_source_month").count().collect()}
    got = read_trips(spark, root, "yellow", spark_landed=True)
    assert "_landed_file" not in got.columns
    assert {(r._source_month, r["count"]) for r in got.groupBy("_source_month").count().collect()} \
        == expected
    one = read_trips(spark, root, "yellow", ["2024-01"], spark_landed=True)
    assert {r._source_month for r in one.select("_source_month").distinct().collect()} == {"2024-01"}


def test_landed_weather_keeps_each_files_month_window(spark, workdir):
    from kerbside.sources.weather import read_landed_weather

    payload = {"hourly": {
        "time": ["2024-01-31T23:00", "2024-02-01T00:00", "2023-12-31T23:00"],
        "temperature_2m": [1.0, 2.0, 3.0], "precipitation": [0.0, 0.0, 0.0],
        "wind_speed_10m": [1.0, 1.0, 1.0], "weather_code": [0, 0, 0],
    }}
    with open(weather_file_path(workdir, "2024-01"), "w") as fh:
        json.dump(payload, fh)
    rows = read_landed_weather(spark, workdir).collect()
    assert [r.observed_at for r in rows] == ["2024-01-31T23:00"]
    assert read_landed_weather(spark, workdir, ["2024-01"]).count() == 1
