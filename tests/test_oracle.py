"""Every registered query equals its DuckDB oracle on the smallest tables."""
from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                                "scripts"))

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from check_oracle import TYPE_CLASS, compare, duck  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["pickup_zone_id", "pickup_hour", "trip_count", "revenue",
                          "avg_distance", "temperature_2m", "precipitation"]
    assert df.count() > 0


def test_every_query_has_an_oracle_or_is_listed():
    from kerbside.plans.catalogue import ORACLE, QUERIES

    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(oracle_sql()[name])
    problems = compare(rows, df.columns, rel.fetchall(), rel.columns)
    dtypes = dict(zip(rel.columns, [str(t) for t in rel.types]))
    for f in df.schema.fields:
        st = TYPE_CLASS.get(type(f.dataType).__name__, str(f.dataType))
        if st != dtypes[f.name]:
            problems.append(f"{f.name}: {st} vs {dtypes[f.name]}")
    assert not problems, problems


def test_scan_report_measures_what_a_layout_prunes(spark, workdir):
    from pyspark.sql import functions as F

    from kerbside.operators.scan_report import scan_footprint

    days = spark.range(1000).withColumn("d", F.col("id") % 10).repartition(4)
    days.write.parquet(f"{workdir}/flat")
    days.write.partitionBy("d").parquet(f"{workdir}/by_day")
    flat = scan_footprint(spark, f"{workdir}/flat", F.col("d") == 3, "flat").first()
    by_day = scan_footprint(spark, f"{workdir}/by_day", F.col("d") == 3, "by_day").first()
    assert (flat.files_scanned, flat.rows_scanned, flat.rows_matched) == (flat.files_total, 1000, 100)
    assert flat.pct_filtered_after_read == 90.0 and flat.bytes_scanned == flat.bytes_total
    assert 10 * by_day.files_scanned == by_day.files_total and by_day.rows_scanned == 100
    assert by_day.pct_filtered_after_read == 0.0 and by_day.bytes_scanned < by_day.bytes_total
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
