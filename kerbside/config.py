"""Session defaults and lake layout.

Only settings live here.  Every operator is a plain ``DataFrame -> DataFrame``
function; this module says where layers live and how a session should be
configured so results are deterministic (UTC wall clock, ANSI casts) and
writes are partition-safe (dynamic partition overwrite).
"""
from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import SparkSession

# Settings every job relies on.  ``session.timeZone`` pins the wall clock so
# ``date_trunc`` / ``date_format`` agree across executors; dynamic overwrite
# lets the fact merge replace only the day partitions it touched.
SESSION_DEFAULTS: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # Target ~128 MB per shuffle partition and per written file; AQE merges
    # small partitions and splits skewed ones (joins and rebalance writes).
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
}

LAYERS = ("bronze", "silver", "gold", "snapshots")


def apply_session_defaults(spark: SparkSession) -> SparkSession:
    """Set the runtime SQL settings the library depends on (idempotent)."""
    for key, value in SESSION_DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


# More shuffle partitions than this cost more in block bookkeeping than they
# save; larger inputs are built one month at a time instead.
MOST_SHUFFLE_PARTITIONS = 20_000


def shuffle_partitions_for(input_bytes: int, cores: int, target_bytes: int = 128 << 20) -> int:
    """Initial shuffle width for a job over ``input_bytes``: enough partitions
    that each holds ~``target_bytes`` (AQE coalesces the excess), at least
    two waves of the cluster's cores and at most ``MOST_SHUFFLE_PARTITIONS``."""
    return min(MOST_SHUFFLE_PARTITIONS, max(2 * cores, -(-input_bytes // target_bytes)))


@contextmanager
def sized_shuffles(spark: SparkSession, input_bytes: int):
    """Inside the block ``spark.sql.shuffle.partitions`` fits a job over
    ``input_bytes``; a wider setting made by the cluster is kept, and the
    caller's setting comes back at the end.

    AQE merges small shuffle partitions and splits skewed join and rebalance
    partitions, but it cannot split a plain hash partition.
    """
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    want = shuffle_partitions_for(int(input_bytes), spark.sparkContext.defaultParallelism)
    spark.conf.set(key, str(max(want, int(before))))
    try:
        yield
    finally:
        spark.conf.set(key, before)


# A task that writes by partition sorts its rows in memory first, and a file with one row group is read by one
# task: so writes pass this many shuffled bytes a task on, whatever joins and aggregates are set to.
WRITE_TASK_BYTES = "32m"


@contextmanager
def small_write_tasks(spark: SparkSession):
    """Inside the block a task of a rebalanced write takes about ``WRITE_TASK_BYTES``; the caller's settings come back.

    AQE splits a hot partition between the blocks of its map tasks and not inside one, so scans are split as finely.
    """
    keys = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes")
    before = {key: spark.conf.get(key) for key in keys}
    for key in keys:
        spark.conf.set(key, WRITE_TASK_BYTES)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def local_session(app: str = "kerbside", cores: str | int = "*",
                  shuffle_partitions: int = 8, scratch: str | None = None) -> SparkSession:
    """A local-mode session for tests, the bench and examples.

    On a cluster the session comes from the launcher; call
    :func:`apply_session_defaults` on it instead.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("KERBSIDE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.warehouse.dir",
                os.path.join(scratch or tempfile.mkdtemp(prefix="kerbside-"), "kerbside-warehouse"))
    )
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_session_defaults(spark)
    if scratch is not None:
        ensure_checkpoint_dir(spark, os.path.join(scratch, "checkpoints"))
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint folder of the cluster.

    The folder named by ``spark.checkpoint.dir`` is used as is.  Only when the
    session has none (tests, local runs) is ``fallback`` installed.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        current = spark.sparkContext.getCheckpointDir()
        if not current:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if fallback is None:
        raise RuntimeError(
            "spark.checkpoint.dir is not set; a shared folder is needed for staging tables")
    spark.conf.set("spark.checkpoint.dir", fallback)
    spark.sparkContext.setCheckpointDir(fallback)
    return fallback


def staging_path(spark: SparkSession, label: str) -> str:
    """A fresh folder under the shared checkpoint dir for one staging table."""
    root = ensure_checkpoint_dir(spark)
    return f"{root.rstrip('/')}/kerbside-stage/{label}-{uuid.uuid4().hex}"


@dataclass(frozen=True)
class LakeConfig:
    """Where each medallion layer lives.

    ``root`` is a shared filesystem / object-store prefix; each table is a
    Parquet directory ``{root}/{layer}/{name}``.  Bronze trips are kept by
    ``dataset``; the models after bronze are those of the yellow trips.
    """

    root: str
    dataset: str = "yellow"

    @property
    def bronze_trips(self) -> str:
        return f"{self.dataset}_trips"

    def path(self, layer: str, name: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer!r}; choose from {LAYERS}")
        return f"{self.root.rstrip('/')}/{layer}/{name}"
