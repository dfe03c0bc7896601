"""Finalize job: order by product, cut into chunks, split by chunk outcome."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.operators.ordering import MAX_CHUNK_SIZE, chunk_manifest, number_chunks
from reviewloom.sources.sinks import chunk_file_name


def export_chunks(
    df: DataFrame, product_id: str, ties: Sequence[str] = (), size: int = MAX_CHUNK_SIZE, scanned: bool = False
) -> DataFrame:
    """Stable order by product (missing products last), then by ``ties``, then as in the files.

    ``scanned`` says that ``df`` comes straight from Parquet files.
    """
    order: list[Column] = [F.col(f"`{product_id}`").asc_nulls_last(), *[F.col(f"`{c}`").asc_nulls_last() for c in ties]]
    return number_chunks(df, order, size, scanned)


def manifest(numbered: DataFrame, prefix: str) -> DataFrame:
    """Chunk sizes and file names."""
    return chunk_manifest(numbered).withColumn(
        "file_name", chunk_file_name(prefix, F.col("chunk"), F.col("chunk_count"))
    )


def split_outcomes(numbered: DataFrame, outcomes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of chunks that went through, and all others."""
    joined = with_outcome(numbered, outcomes)
    return joined.where("succeeded").drop("succeeded"), joined.where("NOT succeeded").drop("succeeded")


def with_outcome(numbered: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Adds ``succeeded``. A chunk without an outcome failed."""
    known = outcomes.groupBy("chunk").agg(F.bool_or("succeeded").alias("succeeded"))
    return numbered.join(known, "chunk", "left").withColumn("succeeded", F.coalesce("succeeded", F.lit(False)))
