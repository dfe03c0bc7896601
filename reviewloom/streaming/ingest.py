"""Incremental ingest: new landed pages only, each micro-batch written once, stops and winners found when read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.files import path_exists
from reviewloom.plans.ingest import PAGE_FACTS, flat_pages, one_per_key, rows_before_stop
from reviewloom.sources.declared import Source
from reviewloom.sources.pages import stream_pages


def ingest_stream(spark: SparkSession, landing: str, table: str, checkpoint: str, source: Source, **options) -> None:
    """Process the pages that arrived since the last run, then stop.

    A micro-batch overwrites its own ``batch`` folder, so a repeated batch leaves the same rows. Nothing already written is rewritten: the cost of
    a run is that of its new pages. A row carries the record count and the fingerprint of its page, since the stop rule looks at a whole
    term, whose pages may arrive in any order and in any number of batches.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        flat_pages(batch, source).write.mode("overwrite").parquet(f"{table}/batch={batch_id}")

    query = (
        stream_pages(spark, landing, **options)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_ingested(spark: SparkSession, table: str, source: Source) -> DataFrame:
    """Current rows, as the batch job would give them from all pages landed so far."""
    return one_per_key(rows_before_stop(spark.read.parquet(table).drop("batch")), source)


def compact(spark: SparkSession, table: str, target: str, source: Source) -> None:
    """Write the log as one batch without the rows behind a stop, once it has grown long.

    A stop only ever moves to an earlier page, so those rows never come back; each page's facts stay, in a row without a position.
    """
    if path_exists(spark, target):
        raise ValueError(f"{target} exists already")
    flat = spark.read.parquet(table).drop("batch")
    facts = flat.where("position IS NULL OR position = 0").select("term", "page", *PAGE_FACTS)
    # a fact stands alone; the rows' own positions start at one, so that no row counts as a fact
    used = rows_before_stop(flat).withColumn("position", F.col("position") + 1)
    facts.unionByName(used, allowMissingColumns=True).select(*flat.columns).withColumn("batch", F.lit(0)).write.partitionBy("batch").parquet(target)
