"""Difference of two tables (two lakes, a re-run and a rebuild), reading rows only where they differ.

Each partition gets an order-free fingerprint: its number of rows and sums of two independent row hashes.  Fingerprints are
compared first, a row a partition; ``exceptAll`` runs on the partitions whose fingerprints differ, and on no other.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _row_hashes(columns: list[str]) -> tuple[Column, Column]:
    # NULLs are skipped by the hash functions, so every column goes with its place
    marked = [F.struct(F.lit(i), F.col(c), F.col(c).isNull()) for i, c in enumerate(columns)]
    return F.xxhash64(*marked), F.xxhash64(F.lit("second"), *marked[::-1])


def fingerprints(df: DataFrame, by: str) -> DataFrame:
    """(by, rows, first, second): equal for equal multisets of rows, whatever their order or files."""
    columns = sorted(df.columns)
    a, b = _row_hashes(columns)
    wide = "decimal(38,0)"
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("rows"), F.sum(a.cast("decimal(20,0)")).cast(wide).alias("first"),
                              F.sum(b.cast("decimal(20,0)")).cast(wide).alias("second"))


def changed_partitions(left: DataFrame, right: DataFrame, by: str) -> DataFrame:
    """(by, left_rows, right_rows) of the partitions whose fingerprints differ; NULL rows where a side has none."""
    l, r = fingerprints(left, by).alias("l"), fingerprints(right, by).alias("r")
    both = l.join(r, F.col(f"l.{by}").eqNullSafe(F.col(f"r.{by}")), "full_outer")
    same = F.lit(True)
    for c in ("rows", "first", "second"):
        same = same & F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))
    return both.where(~same).select(F.coalesce(f"l.{by}", f"r.{by}").alias(by),
                                    F.col("l.rows").alias("left_rows"), F.col("r.rows").alias("right_rows"))


def table_difference(left: DataFrame, right: DataFrame, by: str) -> DataFrame:
    """Rows that one side has more often than the other: the columns of ``left`` and ``side`` (``left`` or ``right``).

    Both sides must have the same columns, in any order.  The values of differing partitions (at most one a partition) are fetched to make a
    partition filter, so tables partitioned by ``by`` open only those folders.
    """
    if sorted(left.columns) != sorted(right.columns):
        raise ValueError(f"columns differ: {sorted(set(left.columns) ^ set(right.columns))}")
    right = right.select(*left.columns)
    values = [r[0] for r in changed_partitions(left, right, by).select(by).collect()]
    known = [v for v in values if v is not None]
    keep = F.col(by).isin(known) if known else F.lit(False)
    if len(known) < len(values):
        keep = keep | F.col(by).isNull()
    a, b = left.where(keep), right.where(keep)
    return (a.exceptAll(b).withColumn("side", F.lit("left"))
            .unionByName(b.exceptAll(a).withColumn("side", F.lit("right"))))
