"""Sinks: upsert tables, bounded chunk files, success and failure tables, period folders."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom.files import list_names, move_path, path_exists, remove_path
from reviewloom.session import scratch_path
from reviewloom.sources.upsert_table import read_current, save

__all__ = ["chunk_file_name", "period_path", "read_chunks", "read_current", "read_manifest", "save", "write_chunks", "write_outcomes"]

# Folder beside the chunk files, which readers of the folder skip; and files that take their names at a time.
MANIFEST = "_manifest"
RENAMES_AT_ONCE = 16

_FILE = "_file_name"


def period_path(root: str, start: str, end: str) -> str:
    """Folder of one run: ``start ~ end`` as a partition value."""
    return f"{root.rstrip('/')}/period={start} ~ {end}"


def chunk_file_name(prefix: str, chunk, chunk_count):
    """``prefix_03_of_12``: both numbers padded to the width of the count."""
    width = F.length(chunk_count.cast("string"))
    return F.concat(
        F.lit(f"{prefix}_"),
        F.lpad(chunk.cast("string"), width, F.lit("0")),
        F.lit("_of_"),
        chunk_count.cast("string"),
    )


def write_chunks(numbered: DataFrame, path: str, prefix: str, chunk: str = "chunk", chunk_count: str = "chunk_count", **options) -> None:
    """One Parquet file per chunk, named as in the manifest; a chunk is bounded, so one task can hold it.

    The files are written under names of Spark's own to a hidden folder, where a task that runs again leaves one file per chunk. Then
    they take their names, the names are held against the manifest, and the folder takes the place of ``path`` in one step. A job that fails
    before leaves ``path`` as it was.
    """
    spark = numbered.sparkSession
    parent, name = path.rstrip("/").rsplit("/", 1)
    written, named = (f"{parent}/_{kind}-{uuid.uuid4().hex}-{name}" for kind in ("written", "named"))
    files = numbered.withColumn(_FILE, chunk_file_name(prefix, F.col(chunk), F.col(chunk_count)))
    try:
        files.repartition(chunk).write.options(**options).partitionBy(_FILE).parquet(written)
        folders = [n for n in list_names(spark, written) if n.startswith(f"{_FILE}=")]

        def take_name(folder: str) -> str:
            (part,) = [n for n in list_names(spark, f"{written}/{folder}") if n.endswith(".parquet")]
            final = f"{folder.split('=', 1)[1]}.parquet"
            if not move_path(spark, f"{written}/{folder}/{part}", f"{named}/{final}"):
                raise OSError(f"{final} cannot take its name")
            return final

        with ThreadPoolExecutor(RENAMES_AT_ONCE) as pool:
            names = set(pool.map(take_name, folders))
        counts = spark.read.schema(numbered.schema).parquet(written) if not names else spark.read.parquet(named)
        expected = counts.groupBy(F.col(chunk)).agg(F.count(F.lit(1)).alias("row_count"), F.max(chunk_count).alias("chunk_count"))
        manifest = expected.withColumn("file_name", F.concat(chunk_file_name(prefix, F.col(chunk), F.col("chunk_count")), F.lit(".parquet")))
        manifest.write.parquet(f"{named}/{MANIFEST}")
        listed = spark.read.parquet(f"{named}/{MANIFEST}")
        # one row per chunk: the driver has just named as many files
        if {r["file_name"] for r in listed.select("file_name").toLocalIterator()} != names:
            raise OSError(f"files below {named} are not those of the manifest")
        remove_path(spark, path)
        if not move_path(spark, named, path):
            raise OSError(f"{path} was taken meanwhile")
    finally:
        remove_path(spark, written)
        remove_path(spark, named)


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all chunk files."""
    return spark.read.option("pathGlobFilter", "*.parquet").parquet(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """file_name, chunk, row_count, chunk_count of the chunk files."""
    return spark.read.parquet(f"{path}/{MANIFEST}")


def write_outcomes(rows: DataFrame, success_path: str, failed_path: str, pk: str, succeeded: str = "succeeded") -> None:
    """Rows whose ``succeeded`` is true to the success table, the others to the failure table.

    Both go through one write that is split by the outcome, so whatever gave the rows runs once. The success table is always written, the failure
    table only when it has rows.
    """
    spark = rows.sparkSession
    path = scratch_path(spark, "outcomes")
    rows.write.partitionBy(succeeded).parquet(path)
    schema = T.StructType([f for f in rows.schema.fields if f.name != succeeded])
    for outcome, target in ((True, success_path), (False, failed_path)):
        folder = f"{path}/{succeeded}={str(outcome).lower()}"
        part = spark.read.schema(schema).parquet(folder) if path_exists(spark, folder) else spark.createDataFrame([], schema)
        save(part, target, pk, overwrite=False, write_empty=outcome, staged=True)
