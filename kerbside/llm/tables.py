"""Intermediate tables in the shared checkpoint folder, and connected components over them."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Most bytes of an Arrow batch between Spark and its Python workers: a count of rows says little where texts differ so much in length.
ARROW_BATCH_BYTES = 8 << 20
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def prepare(spark: SparkSession) -> None:
    """Bound the session's Arrow batches, and send this package to the executors, once an application, so that their Python
    workers can import it wherever the driver found it."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BATCH_BYTES))
    context = spark.sparkContext
    name = f"kerbside-{context.applicationId}.zip"
    if any(str(f).endswith(name) for f in context._python_includes):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="kerbside-package-"), name)
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, files in os.walk(package):
            for file in sorted(f for f in files if f.endswith(".py")):
                full = os.path.join(folder, file)
                out.write(full, os.path.relpath(full, os.path.dirname(package)))
    context.addPyFile(path)


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; in local mode without that setting, a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="kerbside-checkpoint-"))
    return context.getCheckpointDir()


def _scratch(spark: SparkSession) -> str:
    return f"{shared_folder(spark).rstrip('/')}/kerbside-llm-{spark.sparkContext.applicationId}"


def stored(df: DataFrame) -> DataFrame:
    """The frame written as Parquet to the shared folder and read back: lineage ends there, a lost executor costs nothing."""
    spark = df.sparkSession
    path = f"{_scratch(spark)}/{uuid.uuid4().hex}"
    with _shuffles_dropped(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def _shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What is written has its shuffle files deleted when the write ends; else they stay until the driver's garbage is collected."""
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(DROP_SHUFFLES)
        else:
            spark.conf.set(DROP_SHUFFLES, before)


def drop(table: DataFrame) -> None:
    """Delete a frame that ``stored`` returned; only once all that was made from it has been stored itself."""
    spark = table.sparkSession
    for path in {f.rpartition("/")[0] for f in table.inputFiles()}:
        if f"/{os.path.basename(_scratch(spark))}/" in path:
            folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def drop_stored(spark: SparkSession) -> None:
    """Delete this application's intermediate tables; call it when its results have been written."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_scratch(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def _is_star_forest(edges: DataFrame) -> bool:
    """Whether every node is either a centre or has one centre, (a) of its edges (a, b)."""
    ends = edges.select(F.col("a").alias("n"), F.lit(0).alias("low")).union(edges.select(F.col("b").alias("n"), F.lit(1).alias("low")))
    nodes = ends.groupBy("n").agg(F.sum("low").alias("centres"), F.min("low").alias("least"))
    return nodes.filter("centres > 1 OR (centres = 1 AND least = 0)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """Smallest reachable id of every node that has an edge: (node, component).

    ``edges`` has columns a and b.  Large-star and small-star steps in turn: every step aggregates
    a minimum per node (partial sums first) and joins it back, so a node with very many edges is
    never gathered in one place.  Null ends are ignored.
    """
    work = stored(edges.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    ).distinct())
    while not _is_star_forest(work):
        both = work.union(work.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").filter("b > a").select(F.col("m").alias("a"), "b").filter("a < b").distinct()
        # small star: each node's smaller neighbours and itself point to the smallest of them
        up = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(up, "b").select(F.col("m").alias("x"), F.explode(F.array("a", "b")).alias("y")).filter("x < y")
        work = stored(small.select(F.col("x").alias("a"), F.col("y").alias("b")).distinct())
    return work.select(F.col("b").alias("node"), F.col("a").alias("component")).union(
        work.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    )
