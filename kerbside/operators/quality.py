"""Q1-Q10: data-quality checks as distributed aggregates.

A suite is a list of declarative checks over ONE table.  All row-level checks
(volume, not-null, ranges) are folded into a single ``agg`` -- one pass over
the data, only one small row reaches the driver.  Uniqueness and referential
checks need a grouping / anti-join and run as their own small aggregates.

Result rows: ``check_name, column_name, observed, threshold, success``.
"""
from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESULT_SCHEMA = T.StructType([
    T.StructField("check_name", T.StringType()),
    T.StructField("column_name", T.StringType()),
    T.StructField("observed", T.DoubleType()),
    T.StructField("threshold", T.DoubleType()),
    T.StructField("success", T.BooleanType()),
])


class QualityError(RuntimeError):
    """``failed`` has the (check, column) pairs that failed."""

    def __init__(self, message: str, failed: list[tuple[str, str]] | None = None):
        super().__init__(message)
        self.failed = failed or []


@dataclass(frozen=True)
class Check:
    """One expectation.

    kinds: ``row_count_min`` (observed rows >= threshold), ``not_null``
    (observed NULL count, must be 0), ``between`` (share of non-NULL values in
    [low, high], must be >= ``mostly``; no non-NULL value passes),
    ``greater_than`` (count of non-NULL values that are NaN or not > low, must be 0),
    ``unique`` (number of duplicated non-NULL values, must be 0) and
    ``relationship`` (non-NULL values missing from ``parent``, must be 0).
    ``rows`` names a column holding row counts when the checked table is a
    key profile (one row per key and part, see :func:`key_profile`) rather
    than the table itself; relationship checks then sum it.
    """

    kind: str
    column: str = "*"
    low: float | None = None
    high: float | None = None
    mostly: float = 1.0
    parent: DataFrame | None = None
    parent_column: str | None = None
    name: str | None = None
    rows: str | None = None

    @property
    def label(self) -> str:
        return self.name or self.kind


def _row(check: Check, observed, threshold, success) -> F.Column:
    return F.struct(F.lit(check.label).alias("check_name"),
                    F.lit(check.column).alias("column_name"),
                    observed.cast("double").alias("observed"),
                    F.lit(threshold).cast("double").alias("threshold"),
                    success.alias("success"))


ROW_LEVEL = ("row_count_min", "not_null", "between", "greater_than")


def _measure_name(c: Check, part: str) -> str:
    """Column name of one additive count of a check, from what the check is
    (not its position), so stored counts serve any suite with that check."""
    text = f"{c.kind}_{c.column}_{c.low}_{c.high}_{part}".replace("*", "all").replace("-", "m")
    return re.sub(r"[^0-9A-Za-z]+", "_", text)


def _measures(checks: list[Check]) -> list[F.Column]:
    """Every row-level check as additive counts (count, count_if): one
    aggregate computes them all, and sums of them over parts of a table equal
    them over the whole table."""
    aggs: dict[str, F.Column] = {}
    for c in checks:
        col = F.col(c.column) if c.column != "*" else None
        if c.kind == "row_count_min":
            aggs[_measure_name(c, "n")] = F.count(F.lit(1))
        elif c.kind == "not_null":
            aggs[_measure_name(c, "n")] = F.count_if(col.isNull())
        elif c.kind == "between":
            aggs[_measure_name(c, "in")] = F.count_if(col.between(F.lit(c.low), F.lit(c.high)))
            aggs[_measure_name(c, "n")] = F.count(col)
        elif c.kind == "greater_than":
            aggs[_measure_name(c, "n")] = F.count_if(col.isNotNull() & (F.isnan(col.cast("double")) | ~(col > F.lit(c.low))))
    return [a.alias(name) for name, a in aggs.items()]


def _results(checks: list[Check]) -> list[F.Column]:
    """One result struct per row-level check, over the measure columns."""
    rows = []
    for c in checks:
        obs = F.col(_measure_name(c, "n"))
        if c.kind == "row_count_min":
            rows.append(_row(c, obs, c.low, obs >= F.lit(c.low)))
        elif c.kind in ("not_null", "greater_than"):
            rows.append(_row(c, obs, 0, obs == 0))
        elif c.kind == "between":
            share = F.try_divide(F.col(_measure_name(c, "in")), obs)
            rows.append(_row(c, share, c.mostly,
                             F.coalesce(share >= F.lit(c.mostly), F.lit(True))))
    return rows


def _evaluate(measures: DataFrame, checks: list[Check]) -> DataFrame:
    return measures.select(F.explode(F.array(*_results(checks))).alias("r")).select("r.*")


def _single_pass(df: DataFrame, checks: list[Check]) -> DataFrame | None:
    """Row-level checks: one aggregate, then one struct per check exploded."""
    if not checks:
        return None
    return _evaluate(df.agg(*_measures(checks)), checks)


def suite_partials(df: DataFrame, checks: list[Check], by: str) -> DataFrame:
    """The row-level checks' counts per value of ``by`` (e.g. per source
    month): a small table that can be kept up to date one part at a time."""
    bad = [c.kind for c in checks if c.kind not in ROW_LEVEL]
    if bad:
        raise ValueError(f"only row-level checks have additive counts, not {bad}")
    return df.groupBy(by).agg(*_measures(checks))


def run_suite_from_partials(partials: DataFrame, checks: list[Check]) -> DataFrame:
    """Q5 from stored counts: summed over all parts they equal the counts of
    the whole table, so the result equals :func:`run_suite` on it."""
    sums = [F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in _measure_names(checks)]
    return _evaluate(partials.agg(*sums), checks)


def _measure_names(checks: list[Check]) -> list[str]:
    names: list[str] = []
    for c in checks:
        parts = ("in", "n") if c.kind == "between" else ("n",)
        for part in parts:
            n = _measure_name(c, part)
            if n not in names:
                names.append(n)
    return names


def _unique(df: DataFrame, c: Check) -> DataFrame:
    dups = (df.where(F.col(c.column).isNotNull()).groupBy(c.column).count()
            .where(F.col("count") > 1))
    obs = dups.agg(F.count(F.lit(1)).alias("o"))
    return obs.select(_row(c, F.col("o"), 0, F.col("o") == 0).alias("r")).select("r.*")


def _relationship(df: DataFrame, c: Check) -> DataFrame:
    # Both sides are reduced to one row per key before the anti-join (the
    # child with its row count, map-side combined), so the join moves
    # distinct keys only, however many rows share a key.
    weight = F.count(F.lit(1)) if c.rows is None else F.sum(c.rows)
    child = (df.where(F.col(c.column).isNotNull()).groupBy(F.col(c.column).alias("k"))
             .agg(weight.alias("n")))
    parent = c.parent.select(F.col(c.parent_column or c.column).alias("k")).distinct()
    missing = (child.join(parent, "k", "left_anti")
               .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("o")))
    return missing.select(_row(c, F.col("o"), 0, F.col("o") == 0).alias("r")).select("r.*")


def key_profile(df: DataFrame, key: str, by: str) -> DataFrame:
    """Rows per (``by``, ``key``) -- e.g. per pickup day and date key: a table
    a few rows per partition large that answers relationship checks on
    ``key`` (``Check(..., rows="n")``) and can be refreshed one part at a time."""
    return (df.where(F.col(key).isNotNull()).groupBy(by, key)
            .agg(F.count(F.lit(1)).alias("n")))


def run_suite(df: DataFrame, checks: list[Check]) -> DataFrame:
    """Q5: evaluate ``checks`` on ``df``; one result row per check (lazy)."""
    row_level = [c for c in checks if c.kind in ROW_LEVEL]
    parts = []
    single = _single_pass(df, row_level)
    if single is not None:
        parts.append(single)
    for c in checks:
        if c.kind == "unique":
            parts.append(_unique(df, c))
        elif c.kind == "relationship":
            parts.append(_relationship(df, c))
        elif c.kind not in ROW_LEVEL:
            raise ValueError(f"unknown check kind {c.kind!r}")
    return reduce(DataFrame.unionByName, parts)


def assert_results(results: DataFrame, what: str = "table") -> list:
    """Q6: collect the (one row per check) results and raise
    :class:`QualityError` naming the failed checks."""
    rows = results.collect()
    failed = [(r["check_name"], r["column_name"]) for r in rows if not r["success"]]
    if failed:
        names = ", ".join(f"{check}({column})" for check, column in failed)
        raise QualityError(f"{what} failed: {names}", failed)
    return rows


def assert_suite(df: DataFrame, checks: list[Check], what: str = "table") -> list:
    """Q6: run the suite and raise :class:`QualityError` naming failed checks."""
    return assert_results(run_suite(df, checks), what)


# The bronze trip gate thresholds.
def bronze_trip_suite() -> list[Check]:
    """The six bronze-trip expectations (volume, keys present, sane ranges)."""
    return [
        Check("row_count_min", "*", low=1, name="row_count"),
        Check("not_null", "tpep_pickup_datetime"),
        Check("not_null", "pulocationid"),
        Check("between", "total_amount", low=-1000, high=100000, mostly=0.99),
        Check("between", "trip_distance", low=0, high=1000, mostly=0.99),
        Check("between", "passenger_count", low=0, high=9, mostly=0.95),
    ]


def gate_bronze(spark: SparkSession, bronze: DataFrame | None,
                profile: DataFrame | None = None) -> list:
    """Q1 + Q2-Q6: the table must exist, have rows and pass the suite.

    With ``profile`` (the suite's counts per source month, see
    :func:`suite_partials`) the gate sums the stored counts instead of
    scanning the table: same result, a cost that follows the months landed.
    """
    if bronze is None:
        raise QualityError("missing bronze trips table")
    if profile is not None:
        return assert_results(run_suite_from_partials(profile, bronze_trip_suite()),
                              "bronze trips")
    return assert_suite(bronze, bronze_trip_suite(), "bronze trips")


# The build's tests, per table.
def table_checks(table: str, dim_date: DataFrame | None = None, keys_rows: str | None = None) -> list[Check]:
    """The tests of one table of the build; the fact's relationship test needs ``dim_date``."""
    return {
        "dim_zone": [Check("not_null", "zone_id"), Check("not_null", "is_current")],
        "dim_date": [Check("not_null", "date_key"), Check("unique", "date_key"),
                     Check("not_null", "date_day")],
        "dim_weather": [Check("not_null", "weather_key"), Check("unique", "weather_key")],
        "fact_trips": [Check("not_null", "trip_key"), Check("unique", "trip_key"),
                       Check("not_null", "pickup_date_key"), Check("not_null", "pickup_zone_id"),
                       Check("greater_than", "total_amount", low=0, name="accepted_range")],
        "fact_trips_date_keys": [Check("relationship", "pickup_date_key", parent=dim_date,
                                       parent_column="date_key", name="relationships", rows=keys_rows)],
        "bronze_yellow_trips": [Check("not_null", "tpep_pickup_datetime"), Check("not_null", "pulocationid")],
        "bronze_weather_hourly": [Check("not_null", "observed_at"), Check("unique", "observed_at")],
    }[table]


def build_tests(tables: dict[str, DataFrame | Callable[[], DataFrame]], kinds: set[str] | None = None) -> DataFrame:
    """Q7-Q10: the 17 data tests of the build, one result row each (only the
    check kinds in ``kinds`` when given: not_null, unique, relationship, greater_than).

    ``tables`` has the tables by name, or functions that make them, called only for the
    tables the chosen kinds need.  The relationship test reads the fact and the date dimension.
    """
    made: dict[str, DataFrame] = {}

    def frame(name: str) -> DataFrame:
        if name not in made:
            given = tables[name]
            made[name] = given if isinstance(given, DataFrame) else given()
        return made[name]

    parts = []
    for name in ("dim_zone", "dim_date", "dim_weather", "fact_trips", "fact_trips_date_keys",
                 "bronze_yellow_trips", "bronze_weather_hourly"):
        keys = name == "fact_trips_date_keys"
        wanted = kinds is None or any(c.kind in kinds for c in table_checks(name))
        if not wanted:
            continue
        chosen = [c for c in table_checks(name, frame("dim_date") if keys else None)
                  if kinds is None or c.kind in kinds]
        shown = "fact_trips" if keys else name
        parts.append(run_suite(frame(shown), chosen).select(F.lit(shown).alias("table_name"), "*"))
    return reduce(DataFrame.unionByName, parts)


def integrity_extras(fact: DataFrame, dim_zone: DataFrame, dim_weather: DataFrame) -> DataFrame:
    """Non-blocking checks the build lacks: pickup zones and hours of the fact
    present in their dimensions, and at most one open version per zone."""
    current = dim_zone.where(F.col("is_current"))
    parts = [
        run_suite(fact, [Check("relationship", "pickup_zone_id", parent=current,
                               parent_column="zone_id", name="relationships")]),
        run_suite(fact, [Check("relationship", "pickup_weather_key", parent=dim_weather,
                               parent_column="weather_key", name="relationships")]),
        run_suite(current, [Check("unique", "zone_id", name="unique_current")]),
    ]
    return reduce(DataFrame.unionByName, parts)
