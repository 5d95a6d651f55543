"""Month partitions landed beside a table, swapped in after they passed, and the months whose build is pending.

A batch first goes to ``{table}__landing``, where months replace earlier copies of themselves.  The gate and the
bronze tests look at the table as it would be (:func:`with_landed`).  Only then are the months moved in.
A batch that fails stays in the landing folder, and the next run checks it again together with its own months.

Before the months are moved in, one empty file per month is left in the lake's pending folder; it is removed when the
run has built everything that follows from the month.  So whatever a run leaves undone is built by the next.
"""
from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.config import LakeConfig
from kerbside.sinks.writers import write_bronze
from kerbside.storage import create_mark, move_folder, names_in, partition_values, remove_folder

MONTH = "_source_month"
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def landing_path(cfg: LakeConfig, name: str) -> str:
    return f"{cfg.path('bronze', name)}__landing"


def land(batch: DataFrame, cfg: LakeConfig, name: str) -> list[str]:
    """Write a batch beside its bronze table; the months that lie there now, earlier failed ones included."""
    path = landing_path(cfg, name)
    write_bronze(batch, path)
    return landed_months(batch.sparkSession, cfg, name)


def landed_months(spark: SparkSession, cfg: LakeConfig, name: str) -> list[str]:
    return [m for m in partition_values(spark, landing_path(cfg, name), MONTH) if m != NO_VALUE]


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return None


def landed_rows(spark: SparkSession, cfg: LakeConfig, name: str) -> DataFrame | None:
    """The rows that lie beside the table, or None."""
    path = landing_path(cfg, name)
    return _stored(spark, path) if partition_values(spark, path, MONTH) else None


def with_landed(spark: SparkSession, cfg: LakeConfig, name: str) -> DataFrame | None:
    """The bronze table as it will be once the landed months are swapped in, or None when there is neither."""
    stored, new = _stored(spark, cfg.path("bronze", name)), landed_rows(spark, cfg, name)
    if stored is None or new is None:
        return new if stored is None else stored
    months = partition_values(spark, landing_path(cfg, name), MONTH)
    replaced = F.coalesce(F.col(MONTH), F.lit(NO_VALUE)).isin(months)
    return stored.where(~replaced).unionByName(new, allowMissingColumns=True)


def swap_in(spark: SparkSession, cfg: LakeConfig, name: str) -> None:
    """Move the landed months into the table, one at a time; a run that dies between two goes on with the rest."""
    path, target = landing_path(cfg, name), cfg.path("bronze", name)
    for folder in names_in(spark, path):
        if folder.startswith(f"{MONTH}="):
            move_folder(spark, f"{path}/{folder}", f"{target}/{folder}")
    remove_folder(spark, path)


def discard(spark: SparkSession, cfg: LakeConfig, name: str, months: list[str]) -> None:
    """Give up landed months that failed, instead of landing them again."""
    for month in months:
        remove_folder(spark, f"{landing_path(cfg, name)}/{MONTH}={month}")


def _pending_folder(cfg: LakeConfig) -> str:
    return f"{cfg.root.rstrip('/')}/bronze/_pending_builds"


def mark_pending(spark: SparkSession, cfg: LakeConfig, kind: str, months: list[str]) -> None:
    """Note months whose tables are still to be built; ``kind`` is trips or weather."""
    for month in months:
        create_mark(spark, f"{_pending_folder(cfg)}/{kind}={month}", replace=True)


def pending(spark: SparkSession, cfg: LakeConfig, kind: str) -> list[str]:
    return partition_values(spark, _pending_folder(cfg), kind)


def clear_pending(spark: SparkSession, cfg: LakeConfig, kind: str, months: list[str]) -> None:
    for month in months:
        remove_folder(spark, f"{_pending_folder(cfg)}/{kind}={month}")
