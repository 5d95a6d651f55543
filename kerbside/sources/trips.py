"""Monthly trip files -> one bronze DataFrame with lineage columns.

The download itself is out of scope: files are expected to be landed under a
shared prefix as ``{dataset}_tripdata_{YYYY-MM}.parquet``.  Columns change type and come and
go between months, so each month is scanned with the schema of one of its own footers, cast to
the bronze contract and unioned by name; lineage comes from the file names.
"""
from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.schemas import BRONZE_TRIPS

# The trip datasets that may be ingested and the landed file name.
DATASETS = ("yellow", "green", "fhvhv")
FILE_TEMPLATE = "{dataset}_tripdata_{month}.parquet"
FILE_PATTERN = r"([a-z]+)_tripdata_(\d{4}-\d{2})\.parquet(?:/|$)"
# A landing job that writes many files at once with Spark produces one folder
# per file name: ``{root}/_landed_file={name}/part-*.parquet``.
LANDED_FILE_KEY = "_landed_file"
MONTH_PATTERN = re.compile(r"^\d{4}-(0[1-9]|1[0-2])$")


def check_dataset(dataset: str) -> str:
    if dataset not in DATASETS:
        raise ValueError(f"no trip files are known as {dataset!r}")
    return dataset


def check_month(month: str) -> str:
    if not MONTH_PATTERN.match(month):
        raise ValueError(f"month must be YYYY-MM, got {month!r}")
    return month


def trip_file_name(dataset: str, month: str) -> str:
    return FILE_TEMPLATE.format(dataset=check_dataset(dataset), month=check_month(month))


def trip_file_path(root: str, dataset: str, month: str) -> str:
    return f"{root.rstrip('/')}/{trip_file_name(dataset, month)}"


def lower_case_columns(df: DataFrame) -> DataFrame:
    """Lower-case every column name, so later look-ups never depend on case."""
    return df.toDF(*[c.lower() for c in df.columns])


def landed_paths(root: str, names: list[str], spark_landed: bool = False) -> list[str]:
    """Paths of landed files: ``{root}/{name}``, or the folder a Spark landing
    job wrote for that name.  Names may be globs."""
    prefix = f"{LANDED_FILE_KEY}=" if spark_landed else ""
    return [f"{root.rstrip('/')}/{prefix}{n}" for n in names]


def landed_months(spark: SparkSession, root: str, dataset: str,
                  spark_landed: bool = False) -> list[str]:
    """Months with a landed file, from the file names (no column is read; one row a month comes back)."""
    pattern = landed_paths(root, [f"{check_dataset(dataset)}_tripdata_*.parquet"], spark_landed)
    name = F.regexp_extract(F.col("_metadata.file_path"), FILE_PATTERN, 2)
    return sorted(r.m for r in spark.read.parquet(*pattern).select(name.alias("m")).distinct().collect())


def _to_contract(df: DataFrame) -> DataFrame:
    """Contract columns in their contract types; other columns as text unless every month agrees (see read_trips)."""
    types = {f.name: f.dataType for f in BRONZE_TRIPS.fields}
    return df.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c)
                       for c in df.columns])


def read_trips(spark: SparkSession, root: str, dataset: str, months: list[str] | None = None,
               spark_landed: bool = False) -> DataFrame:
    """The landed files of ``months`` (all landed months when None) as one DataFrame.

    Contract columns that a month lacks are NULL there; a column outside the
    contract whose type differs between months becomes text.  Adds
    ``_source_dataset`` and ``_source_month`` from each row's file name.
    """
    check_dataset(dataset)
    if months is None:
        months = landed_months(spark, root, dataset, spark_landed)
    if not months:
        raise ValueError("at least one month is required")
    parts = []
    for month in months:
        raw = spark.read.parquet(*landed_paths(root, [trip_file_name(dataset, month)], spark_landed))
        path = F.col("_metadata.file_path")
        parts.append(_to_contract(lower_case_columns(raw.select(
            "*", F.regexp_extract(path, FILE_PATTERN, 1).alias("_source_dataset"),
            F.regexp_extract(path, FILE_PATTERN, 2).alias("_source_month")))))
    kinds: dict[str, set[str]] = {}
    for part in parts:
        for column, kind in part.dtypes:
            kinds.setdefault(column, set()).add(kind)
    mixed = {c for c, k in kinds.items() if len(k) > 1}
    out = None
    for part in parts:
        part = part.select(*[F.col(c).cast("string").alias(c) if c in mixed else F.col(c)
                             for c in part.columns])
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    for field in BRONZE_TRIPS.fields if dataset == "yellow" else ():
        if field.name not in out.columns:
            out = out.withColumn(field.name, F.lit(None).cast(field.dataType))
    return out
