"""Attributes of a validity history as of a row's own time.

A history row holds from ``valid_from`` up to, not including, ``valid_to`` (NULL = still open).  The join is an
equality join in two steps, never a range join and never one row per version:

1. a key's versions are packed by the year they begin in, and the first start of every such pack goes into one short
   sorted array per key; a binary search in that array names the pack that a row's time falls in;
2. the pack itself is joined by (key, first start) and searched the same way.

So an array holds the versions of one key and one year at most, however long the history is.  Histories are small beside
facts: AQE broadcasts the packs when their measured size allows it, otherwise both joins are sort-merge joins
in which AQE splits a hot key on the fact side.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_STEPS = [1 << b for b in range(30, -1, -1)]


def starts_not_after(starts: Column, at: Column) -> Column:
    """How many values of the sorted array are not after ``at``: a binary search; 0 when ``at`` is NULL."""
    size = F.coalesce(F.size(starts), F.lit(0))
    usable = F.filter(F.array(*[F.lit(s) for s in _STEPS]), lambda s: s <= size)
    return F.aggregate(usable, F.lit(0), lambda n, s: F.when(
        (n + s <= size) & F.coalesce(F.get(starts, n + s - 1) <= at, F.lit(False)), n + s).otherwise(n))


def as_of_join(rows: DataFrame, history: DataFrame, row_key: str, row_time: str, key: str,
               columns: list[str], valid_from: str = "valid_from", valid_to: str = "valid_to",
               how: str = "left") -> DataFrame:
    """``rows`` with ``columns`` of the history version that was valid at ``row_time``.

    ``how="left"`` keeps rows without a valid version (NULL columns), ``"inner"`` drops them.  A NULL key or time has no
    version; versions without a key or a start, and those that end no later than they begin, are never valid.
    Where versions of one key overlap, the one that began last decides (ties: the one that ends last), and once it has ended the row
    has no version.  Each row comes out once.  ``columns`` must not be columns of ``rows``.
    """
    if how not in ("left", "inner"):
        raise ValueError("how must be 'left' or 'inner'")
    clash = sorted({c.lower() for c in columns} & {c.lower() for c in rows.columns})
    if clash:
        raise ValueError(f"columns of both sides: {clash}")
    start, end = F.col(valid_from), F.col(valid_to)
    live = history.where(F.col(key).isNotNull() & start.isNotNull() & (end.isNull() | (start < end)))
    far = F.coalesce(end, F.lit("9999-12-31 23:59:59.999999").cast("timestamp_ntz").cast(history.schema[valid_to].dataType))
    version = F.struct(start.alias("f"), far.alias("_order"), end.alias("t"),
                       F.struct(*[F.col(c) for c in columns]).alias("a"))
    packs = live.groupBy(F.col(key).alias("_key"), F.year(start).alias("_year")).agg(
        F.sort_array(F.collect_list(version)).alias("_versions"), F.min(start).alias("_first"))
    firsts = packs.groupBy("_key").agg(F.sort_array(F.collect_list("_first")).alias("_firsts"))
    at = F.col(row_time)
    placed = rows.join(firsts, F.col(row_key) == F.col("_key"), "left").withColumn(
        "_first_of", F.get("_firsts", starts_not_after(F.col("_firsts"), at) - 1)).drop("_key", "_firsts")
    found = placed.join(packs.drop("_year"), (F.col(row_key) == F.col("_key"))
                        & (F.col("_first_of") == F.col("_first")), "left")
    last = F.get("_versions", starts_not_after(F.col("_versions.f"), at) - 1)
    found = found.withColumn("_v", last)
    valid = F.col("_v").isNotNull() & (F.col("_v.t").isNull() | (at < F.col("_v.t")))
    if how == "inner":
        found = found.where(valid)
    return found.select(*[F.col(c) for c in rows.columns],
                        *[F.when(valid, F.col(f"_v.a.{c}")).alias(c) for c in columns])
