"""Duplicates: keep one row per key, report repeated keys, distinct ids in first-seen order.

Everything here is an aggregate, so rows of a hot key are combined before the shuffle; there is
no window that would gather one key's rows in a task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _one_per_key(df: DataFrame, pk: str, order: Sequence[str], pick) -> DataFrame:
    # A row that equals another in all of `order` is told apart by its remaining columns, so
    # the winner does not depend on the order of arrival.
    rest = [c for c in df.columns if c not in order]
    ranked = F.struct(*[F.col(f"`{c}`") for c in [*order, *rest]])
    kept = df.where(F.col(f"`{pk}`").isNotNull()).groupBy(F.col(f"`{pk}`")).agg(pick(ranked).alias("_row"))
    return kept.select(*[F.col(f"_row.`{c}`").alias(c) for c in df.columns])


def keep_last(df: DataFrame, pk: str, order: Sequence[str]) -> DataFrame:
    """Last row per key in ``order``; rows without a key go."""
    return _one_per_key(df, pk, order, F.max)


def keep_first(df: DataFrame, pk: str, order: Sequence[str]) -> DataFrame:
    """First row per key in ``order``, the key compared as text; rows without a key go."""
    return _one_per_key(df.withColumn(pk, F.col(f"`{pk}`").cast("string")), pk, order, F.min)


def first_seen(df: DataFrame, key: str, position: str) -> DataFrame:
    """Distinct keys with the position each was first seen at."""
    return df.groupBy(key).agg(F.min(position).alias("first_position"))


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their row counts."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1")
