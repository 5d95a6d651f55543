"""Lake tables by logical name (``{root}/{layer}/{name}`` Parquet folders)."""
from __future__ import annotations

from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kerbside.config import LakeConfig
from kerbside.sinks.versions import valid_path


class MissingTableError(RuntimeError):
    pass


def read_table(spark: SparkSession, cfg: LakeConfig, layer: str, name: str,
               schema: StructType | None = None) -> DataFrame:
    """``layer.name``.  With ``schema`` a table written empty (no data files to
    infer a schema from) still reads, as an empty DataFrame.  A table kept in versions
    is read in its valid one."""
    path = valid_path(spark, cfg.path(layer, name))
    try:
        reader = spark.read.schema(schema) if schema is not None else spark.read
        return reader.parquet(path)
    except AnalysisException as exc:
        raise MissingTableError(f"missing table {layer}.{name} at {path}") from exc


def table_exists(spark: SparkSession, cfg: LakeConfig, layer: str, name: str) -> bool:
    try:
        read_table(spark, cfg, layer, name)
        return True
    except MissingTableError:
        return False


def stored_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Bytes stored under ``paths`` (folders, read recursively).

    The binary-file source lists the files; selecting only ``length`` means
    no file content is read.  The sum runs as one small distributed job.
    """
    if not paths:
        return 0
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .load(paths).select("length"))
    return int(files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0])


@contextmanager
def partition_listing_only(spark: SparkSession):
    """Plan queries that read only partition columns from the partition
    listing, without opening a data file.

    Spark's metadata-only rule is off by default because a partition folder
    holding only empty files would still count.  The writers of this package
    create partition folders only through ``partitionBy``, which never writes
    a partition without rows, so for these tables the answer is exact.  The
    setting is restored on exit; plan (and run) inside the block.
    """
    key = "spark.sql.optimizer.metadataOnly"
    old = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, old)
