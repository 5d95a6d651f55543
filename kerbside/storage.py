"""Folders on whatever storage a path names, through the file system Spark itself uses for it."""
from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    """(file system, path) of the JVM for ``path``."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files and folders in ``folder``; none when it does not exist."""
    fs, p = file_system(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of a partition column, from the folder names."""
    head = f"{column}="
    return [unquote(n.removeprefix(head)) for n in names_in(spark, path) if n.startswith(head)]


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder or file of this library's own tables."""
    fs, p = file_system(spark, path)
    fs.delete(p, True)


def move_folder(spark: SparkSession, source: str, target: str) -> None:
    """Put the folder ``source`` in the place of ``target``; a reader in between finds no folder there."""
    fs, s = file_system(spark, source)
    _, t = file_system(spark, target)
    fs.mkdirs(t.getParent())
    fs.delete(t, True)
    if not fs.rename(s, t):
        raise OSError(f"could not move {source} to {target}")


def create_mark(spark: SparkSession, path: str, replace: bool) -> None:
    """Create an empty file; without ``replace`` one that is there already is an error."""
    fs, p = file_system(spark, path)
    fs.create(p, replace).close()
