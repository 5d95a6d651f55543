"""Late and dirty rows are set aside, not lost: one pass tags, one job writes, counts come with it.

Every bronze row gets the list of the rules it breaks, in rule order.  Rows that break none are accepted; the
others are quarantined with their reasons.  Both are written by one job into one table, partitioned by
``quality`` (``accepted`` / ``quarantined``) and source month, so bronze is scanned once and
accepted + quarantined = bronze.  The counts are taken by an ``Observation`` while that job runs.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from kerbside.config import small_write_tasks
from kerbside.functions.temporal import month_text
from kerbside.storage import move_folder, partition_values, remove_folder

ACCEPTED, QUARANTINED = "accepted", "quarantined"
REASONS = "broken_rules"


def trip_rules(max_passengers: int | None = None) -> dict[str, Column]:
    """Rule name -> whether a bronze trip breaks it.  The first five are silver's filters: NULL and NaN break them too.

    ``late``: the pickup lies in a month other than that of the file the row came with.  ``max_passengers`` adds the
    passenger range (D1), which silver does not apply by default; an unknown count does not break it.
    """
    pickup = F.col("tpep_pickup_datetime").cast("timestamp_ntz")

    def positive(c: str) -> Column:
        return F.coalesce((F.col(c) > 0) & ~F.isnan(c), F.lit(False))

    rules = {
        "no_pickup_time": pickup.isNull(),
        "amount_not_positive": ~positive("total_amount"),
        "distance_not_positive": ~positive("trip_distance"),
        "late": F.coalesce(month_text(pickup) != F.col("_source_month"), F.lit(False)),
        "no_source_month": F.col("_source_month").isNull(),
    }
    if max_passengers is not None:
        rules["passengers_out_of_range"] = F.coalesce(~F.col("passenger_count").between(0, max_passengers), F.lit(False))
    return rules


def tag(rows: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """The rows with ``broken_rules`` (array of rule names, empty when accepted)."""
    marks = F.array(*[F.when(broken, F.lit(name)) for name, broken in rules.items()])
    return rows.withColumn(REASONS, F.filter(marks, lambda m: m.isNotNull()))


def accepted(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.size(REASONS) == 0).drop(REASONS)


def quarantined(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.size(REASONS) > 0)


def observed(tagged: DataFrame, rules: dict[str, Column], name: str = "quarantine") -> tuple[DataFrame, Observation]:
    """The tagged rows with an observation of how many there are, are accepted, and break each rule."""
    seen = Observation(name)
    counts = [F.count(F.lit(1)).alias("rows"), F.count_if(F.size(REASONS) == 0).alias(ACCEPTED)]
    counts += [F.count_if(F.array_contains(REASONS, rule)).alias(f"rule_{rule}") for rule in rules]
    return tagged.observe(seen, *counts), seen


def write_sorted_out(bronze: DataFrame, path: str, rules: dict[str, Column] | None = None,
                     month: str = "_source_month") -> dict[str, int]:
    """Write accepted and quarantined rows of ``bronze`` in one job and return the counts observed on the way.

    Months present in ``bronze`` are replaced on both sides: both sides of a month are removed before the job moves its own in
    (a month without quarantined rows would otherwise keep its old ones).
    """
    spark = bronze.sparkSession
    rules = rules or trip_rules()
    rows, seen = observed(tag(bronze, rules), rules)
    side = F.when(F.size(REASONS) == 0, F.lit(ACCEPTED)).otherwise(F.lit(QUARANTINED))
    stage = f"{path.rstrip('/')}__incoming"
    sides = rows.withColumn("quality", side).withColumn("month", F.col(month)).hint("rebalance", "quality", "month")
    with small_write_tasks(spark):
        (sides.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("quality", "month")
         .parquet(stage))
    incoming = {side: partition_values(spark, f"{stage}/quality={side}", "month") for side in (ACCEPTED, QUARANTINED)}
    for value in sorted({*incoming[ACCEPTED], *incoming[QUARANTINED]}):
        for kind, values in incoming.items():
            own = f"quality={kind}/month={value}"
            if value in values:
                move_folder(spark, f"{stage}/{own}", f"{path}/{own}")
            else:
                remove_folder(spark, f"{path}/{own}")
    remove_folder(spark, stage)
    return dict(seen.get)


def read_side(spark, path: str, side: str) -> DataFrame:
    """The accepted or the quarantined rows of a table written by :func:`write_sorted_out` (a partition filter)."""
    rows = spark.read.parquet(path).where(F.col("quality") == side).drop("quality", "month")
    return rows.drop(REASONS) if side == ACCEPTED else rows
