"""S3 / R9 by logical name: expose lake folders as ``layer.name`` catalog tables.

Each medallion layer becomes a database; each table an external Parquet table
over its folder, so SQL can address ``gold.fact_trips`` directly.  For
day-partitioned tables the partitions are recovered into the catalog, which
keeps partition pruning on the SQL path as well.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kerbside.config import LAYERS, LakeConfig
from kerbside.sinks.versions import valid_path

# Tables the pipeline writes, by layer, with their partition column if any.
LAKE_TABLES: dict[tuple[str, str], str | None] = {
    ("bronze", "yellow_trips"): "_source_month",
    ("bronze", "weather_hourly"): "_source_month",
    ("bronze", "yellow_trips_profile"): "_source_month",
    ("snapshots", "zone_snapshot"): None,
    ("silver", "stg_yellow_trips"): "source_month",
    ("gold", "dim_zone"): None,
    ("gold", "dim_date"): None,
    ("gold", "dim_weather"): None,
    ("gold", "fact_trips"): "pickup_date",
    ("gold", "fact_trips_date_keys"): "pickup_date",
    ("gold", "mart_zone_hourly_demand"): "pickup_month",
}


def _norm(path: str) -> str:
    return path.removeprefix("file:").rstrip("/")


def table_location(spark: SparkSession, qualified: str) -> str:
    """Storage location of a catalog table."""
    rows = (spark.sql(f"DESCRIBE TABLE EXTENDED {qualified}")
            .where("col_name = 'Location'").collect())
    return _norm(rows[0]["data_type"]) if rows else ""


OWNER_PROPERTY = "kerbside.lake"


class CatalogConflictError(RuntimeError):
    """The catalog holds a table of that name that no lake registered."""


def _registered_by_a_lake(spark: SparkSession, qualified: str) -> bool:
    kind = (spark.sql(f"DESCRIBE TABLE EXTENDED {qualified}")
            .where("col_name = 'Type'").collect())
    owner = spark.sql(f"SHOW TBLPROPERTIES {qualified}").where(f"key = '{OWNER_PROPERTY}'").collect()
    return bool(kind) and kind[0]["data_type"] == "EXTERNAL" and bool(owner)


def register_table(spark: SparkSession, cfg: LakeConfig, layer: str, name: str,
                   partitioned: bool = False, prefix: str = "") -> str:
    """Create (once) ``{prefix}{layer}.name`` over the table folder and sync its partitions.

    A table of that name elsewhere is repointed only when a lake registered it
    (it is external and carries the lake's property); anything else raises
    :class:`CatalogConflictError` and is left alone.
    """
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer!r}")
    qualified = f"{prefix}{layer}.{name}"
    # The layer's database lives with the lake (shared storage), not in the
    # session's default warehouse folder.
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {prefix}{layer} "
              f"LOCATION '{cfg.root.rstrip('/')}/{layer}'")
    path = valid_path(spark, cfg.path(layer, name))
    if spark.catalog.tableExists(qualified) and table_location(spark, qualified) != _norm(path):
        if not _registered_by_a_lake(spark, qualified):
            raise CatalogConflictError(f"{qualified} exists and was not registered by a lake")
        spark.sql(f"DROP TABLE {qualified}")     # external: its files stay
    if not spark.catalog.tableExists(qualified):
        spark.sql(f"CREATE TABLE {qualified} USING parquet LOCATION '{path}' "
                  f"TBLPROPERTIES ('{OWNER_PROPERTY}' = '{cfg.root}')")
    if partitioned:
        spark.sql(f"ALTER TABLE {qualified} RECOVER PARTITIONS")
    spark.catalog.refreshTable(qualified)
    return qualified


def register_lake(spark: SparkSession, cfg: LakeConfig, prefix: str = "") -> list[str]:
    """Register every lake table that exists on storage, in databases named
    ``{prefix}{layer}``."""
    from kerbside.sources.lake import table_exists

    done = []
    for (layer, name), part in LAKE_TABLES.items():
        if table_exists(spark, cfg, layer, name):
            done.append(register_table(spark, cfg, layer, name, part is not None, prefix))
    return done
