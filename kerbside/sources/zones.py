"""R8 + P2: the zone lookup seed -> (zone_id, borough, zone_name, service_zone)."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.schemas import ZONE_LOOKUP


def conform_zones(seed: DataFrame) -> DataFrame:
    """Rename the quoted seed headers and fix the id type."""
    return seed.select(
        F.col("LocationID").cast("int").alias("zone_id"),
        F.col("Borough").alias("borough"),
        F.col("Zone").alias("zone_name"),
        F.col("service_zone").alias("service_zone"),
    )


def read_zone_seed(spark: SparkSession, path: str) -> DataFrame:
    """Read the CSV seed with an explicit schema; the text ``N/A`` stays text."""
    seed = (spark.read.schema(ZONE_LOOKUP)
            .option("header", "true").option("quote", '"')
            .option("nullValue", None).option("mode", "FAILFAST")
            .csv(path))
    return conform_zones(seed)
