"""Tables that cannot be rebuilt are never overwritten.

Every state of such a table is a folder of its own, ``version-<n>``.  A state is valid once the pointer ``_current/<n>``
exists; readers take the highest one.  The pointer is one empty file, created after the folder is complete, so a
writer that dies leaves the table as it was.  The state before the valid one stays until the next success.  Two writers
that publish the same number: the second one's pointer cannot be created, and it raises.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kerbside.storage import create_mark, file_system, names_in, remove_folder


def _folder(path: str, n: int) -> str:
    return f"{path.rstrip('/')}/version-{n:012d}"


def _pointers(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n) for n in names_in(spark, f"{path}/_current") if n.isdigit())


def is_versioned(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, f"{path.rstrip('/')}/_current")
    return fs.exists(p)


def valid_path(spark: SparkSession, path: str) -> str:
    """The folder that holds the table's rows: its valid version, or ``path`` itself for a table without versions."""
    if not is_versioned(spark, path):
        return path
    valid = _pointers(spark, path)
    return _folder(path, valid[-1] if valid else 0)


def write_version(df: DataFrame, path: str) -> str:
    """Write ``df`` (which may read the table itself) as the next version and make it the valid one."""
    spark = df.sparkSession
    fs, current = file_system(spark, f"{path.rstrip('/')}/_current")
    fs.mkdirs(current)
    valid = _pointers(spark, path)
    n = (valid[-1] if valid else 0) + 1
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(_folder(path, n))
    _publish(spark, path, n)
    for old in valid[:-1]:
        remove_folder(spark, f"{path}/_current/{old:012d}")
        remove_folder(spark, _folder(path, old))
    return _folder(path, n)


def _publish(spark: SparkSession, path: str, n: int) -> None:
    create_mark(spark, f"{path.rstrip('/')}/_current/{n:012d}", replace=False)
