"""Session settings and the shared folder for staged tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from reviewloom.files import remove_path

# Settings every job relies on. They are session-level, so they can be applied to a session
# that somebody else built.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
}

# Good defaults for a cluster. The shuffle partition count is an upper bound that adaptive
# execution coalesces; raise it so that one partition stays near 200 MB.
SUGGESTED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def build_session(app_name: str = "reviewloom", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SUGGESTED_CONF, **REQUIRED_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_required_conf(spark: SparkSession) -> SparkSession:
    for key, value in REQUIRED_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``.

    Only a local session may go without it; then a temporary folder of this machine is set.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    folder = tempfile.mkdtemp(prefix="reviewloom-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


# Paths handed out since the innermost `staging` block began.
_open_blocks: list[list[str]] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    if _open_blocks:
        _open_blocks[-1].append(path)
    return path


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Remove the tables staged inside the block when it ends.

    Whatever is to outlive the block must have been written elsewhere by then.
    """
    _open_blocks.append([])
    try:
        yield
    finally:
        for path in _open_blocks.pop():
            remove_path(spark, path)


def stage(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write ``df`` once below the shared folder and read it back.

    This cuts the lineage: what was written survives lost executors and is not recomputed,
    and later steps read only the columns they need. ``options`` are those of the writer and of the reader.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).options(**options).parquet(path)


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """Set a session setting inside the block."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def small_tasks(spark: SparkSession):
    """Rebalanced writes inside the block use tasks of 4 MB of shuffled rows.

    By default few tasks would write all the folders of rows that take little room, and each file takes its time however small it is.
    """
    return setting(spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes", "4m")


def few_listings(spark: SparkSession):
    """Paths read inside the block are listed by some tasks for each core, not by one for each folder."""
    tasks = 8 * spark.sparkContext.defaultParallelism
    return setting(spark, "spark.sql.sources.parallelPartitionDiscovery.parallelism", str(tasks))
