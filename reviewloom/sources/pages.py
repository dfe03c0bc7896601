"""Landed API pages: rows ``(term, page, payload)`` kept as JSON files, read in batch or as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PAGE_SCHEMA = T.StructType(
    [
        T.StructField("term", T.LongType()),
        T.StructField("page", T.LongType()),
        T.StructField("payload", T.StringType()),
    ]
)


def land(pages: DataFrame, path: str) -> None:
    """Append fetched pages. Each page stays one row, so nothing needs a shuffle."""
    pages.select(*[f.name for f in PAGE_SCHEMA]).write.mode("append").json(path)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PAGE_SCHEMA).json(path)


def stream_pages(spark: SparkSession, path: str, **options) -> DataFrame:
    return spark.readStream.schema(PAGE_SCHEMA).options(**options).json(path)


def pages_of_offsets(answers: DataFrame, size: int, first_page: int = 0) -> DataFrame:
    """Pages of a source that is asked by offset: ``(term, offset, payload)`` with offsets that are whole pages of ``size`` records."""
    offset = F.col("offset").cast("bigint")
    error = F.raise_error(F.concat(F.lit(f"no multiple of {size}: offset "), offset.cast("string"))).cast("bigint")
    page = F.when(offset % size == 0, F.floor(offset / size) + first_page).otherwise(error)
    return answers.select("term", page.alias("page"), "payload")
