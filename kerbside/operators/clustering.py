"""A mart laid out so that a lookup of one zone, or of a span of hours, opens few pages.

Inside a month the rows follow a space-filling curve over zone and hour that takes the bits of both numbers in turns: first the
hour's highest bits (blocks of 128 hours), then the zone's, then the hour's others.  So a zone is six short runs in a
month, and a day in all zones lies in one or two blocks.  Parquet keeps the least and greatest value of every page and row group; small
pages over ordered rows let a reader skip the rest.  (Spark pushes filters on the zone to Parquet, but none on
zone-less timestamps yet, so a span of hours still prunes by month only.)  The key is a native expression and is not stored.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.operators.marts import MONTH_COLUMN

#: Bits of each coordinate on the curve: zone ids below 65,536, hours of a month below 1,024 in blocks of 128.
ZONE_BITS, HOUR_BITS, BLOCK_BITS = 16, 10, 7
#: Rows of a Parquet page and bytes of a row group: the units that statistics can skip.
PAGE_ROWS, GROUP_BYTES = 500, 4 << 20


def curve(bits: list[tuple[Column, int]]) -> Column:
    """Place on the curve that takes these bits (number, which bit of it) one after the other, the first one highest; 63 at most.

    Bits of two numbers in turns give the Z-order curve; taking several of one first makes runs of it longer.
    """
    if len(bits) > 63:
        raise ValueError(f"{len(bits)} bits do not fit a long")
    key = F.lit(0).cast("long")
    for place, (number, bit) in enumerate(reversed(bits)):
        one = F.shiftright(number.cast("long"), bit).bitwiseAND(F.lit(1).cast("long"))
        key = key.bitwiseOR(F.shiftleft(one, place))
    return key


def z_order(coordinates: list[tuple[Column, int]]) -> Column:
    """Z-order curve of non-negative numbers, each given with its number of bits: one bit of each in turn, highest bits first."""
    levels = range(max(bits for _, bits in coordinates) - 1, -1, -1)
    return curve([(c, level) for level in levels for c, bits in coordinates if level < bits])


def mart_curve(zone: str = "pickup_zone_id", hour: str = "pickup_hour") -> Column:
    """Place of a zone-hour on the curve of its month; unknown zones and ids beyond the bits share the far end."""
    top = (1 << ZONE_BITS) - 1
    z = F.when(F.col(zone).between(0, top), F.col(zone)).otherwise(F.lit(top))
    h = (F.dayofmonth(hour) - 1) * 24 + F.hour(hour)
    hours = [(h, bit) for bit in range(HOUR_BITS - 1, -1, -1)]
    blocks = HOUR_BITS - BLOCK_BITS
    return curve([*hours[:blocks], *[(z, bit) for bit in range(ZONE_BITS - 1, -1, -1)], *hours[blocks:]])


def write_clustered_mart(mart: DataFrame, path: str, replace: str = "static", files_per_month: int = 1) -> str:
    """Write a mart with a ``pickup_month`` column by month, each month in curve order.

    ``files_per_month`` ranges of the curve are files of their own (for months beyond a file's good size).  The range partitioning
    samples keys, which decides where files begin, never which rows are written.
    """
    rows = mart.withColumn("_place", mart_curve())
    if files_per_month > 1:
        rows = rows.repartitionByRange(files_per_month * max(1, mart.select(MONTH_COLUMN).distinct().count()), MONTH_COLUMN, "_place")
    else:
        rows = rows.hint("rebalance", MONTH_COLUMN)
    rows = rows.sortWithinPartitions(MONTH_COLUMN, "_place").drop("_place")
    (rows.write.mode("overwrite").option("partitionOverwriteMode", replace).partitionBy(MONTH_COLUMN)
     .option("parquet.page.row.count.limit", PAGE_ROWS).option("parquet.block.size", GROUP_BYTES)
     .option("parquet.enable.dictionary", "false").parquet(path))
    return path
