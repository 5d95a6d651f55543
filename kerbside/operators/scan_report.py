"""M1: scan footprint of a selective query -- files, bytes and rows really read.

The query (a count of the matching rows) runs, and the figures are the metrics
of its executed file scan: files and bytes left after partition pruning, rows
the scan gave out.  Totals come from the same scan without the predicate.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

REPORT_COLUMNS = ["layout", "files_total", "files_scanned", "bytes_total", "bytes_scanned",
                  "rows_total", "rows_scanned", "rows_matched", "pct_filtered_after_read"]
# Metric names of Spark's file scan node.
_METRICS = {"files": "numFiles", "bytes": "filesSize", "rows": "numOutputRows"}


def measured_scan(spark: SparkSession, df: DataFrame) -> tuple[int, dict[str, int]]:
    """Count ``df``'s rows and return the count with the metrics of its file scans.

    The plan is run without runtime re-planning, so that the executed plan is
    the one the metrics hang on; the session's setting is restored.
    """
    key = "spark.sql.adaptive.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        counted = df.agg(F.count(F.lit(1)).alias("n"))
        n = counted.collect()[0]["n"]
        leaves = counted._jdf.queryExecution().executedPlan().collectLeaves()
        total = dict.fromkeys(_METRICS, 0)
        for i in range(leaves.size()):
            metrics = leaves.apply(i).metrics()
            for name, metric in _METRICS.items():
                if metrics.contains(metric):
                    total[name] += metrics.apply(metric).value()
        return n, total
    finally:
        spark.conf.set(key, before)


def scan_footprint(spark: SparkSession, path: str, predicate: Column, layout: str) -> DataFrame:
    """One report row for ``predicate`` over the Parquet table at ``path``."""
    rows, whole = measured_scan(spark, spark.read.parquet(path))
    matched, read = measured_scan(spark, spark.read.parquet(path).where(predicate))
    share = round((read["rows"] - matched) * 100.0 / read["rows"], 1) if read["rows"] else None
    return spark.createDataFrame(
        [(layout, whole["files"], read["files"], whole["bytes"], read["bytes"], rows, read["rows"],
          matched, share)],
        "layout string, files_total long, files_scanned long, bytes_total long, bytes_scanned long, "
        "rows_total long, rows_scanned long, rows_matched long, pct_filtered_after_read double")
