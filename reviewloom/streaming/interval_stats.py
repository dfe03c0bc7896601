"""Incremental interval statistics: each run adds a histogram of its new events, reading merges them to one row per interval."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from reviewloom.operators.stats import dated_histogram, statistics_of_histograms
from reviewloom.sources.event_log import stream_events


def statistics_stream(
    spark: SparkSession,
    log: str,
    table: str,
    checkpoint: str,
    by: Sequence[str],
    prepare: Callable[[DataFrame], DataFrame] = lambda events: events,
    **options,
) -> None:
    """Histograms of every micro-batch, which can be merged: an interval may arrive in any number of batches and runs.

    The stream checkpoint takes the place of a byte cursor. A repeated batch overwrites itself.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        dated_histogram(prepare(batch), by).write.mode("overwrite").parquet(f"{table}/run={batch_id}")

    query = (
        stream_events(spark, log, **options)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_statistics(spark: SparkSession, table: str, by: Sequence[str]) -> DataFrame:
    """One row per interval with the count and last timestamp of its events."""
    return statistics_of_histograms(spark.read.parquet(table), by)
