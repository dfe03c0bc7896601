"""Upsert by key, as DataFrame algebra: anti join plus union."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _key(df: DataFrame, pk: str) -> tuple[Column, Column]:
    """Null-safe key as two plain equality keys, so the exchange of the anti join is shared."""
    text = df[pk].cast("string")
    return F.coalesce(text, F.lit("")), text.isNull()


def without_keys_of(df: DataFrame, other: DataFrame, pk: str) -> DataFrame:
    """Rows of ``df`` whose key is not in ``other``; a null key matches a null key.

    ``other`` is reduced to distinct keys first (combined before the shuffle), so a key that
    fills a third of it is one row in the join.
    """
    text, missing = _key(df, pk)
    left = df.withColumns({"_k": text, "_n": missing})
    text, missing = _key(other, pk)
    right = other.select(text.alias("_k"), missing.alias("_n")).distinct()
    return left.join(right, ["_k", "_n"], "left_anti").drop("_k", "_n")


def upsert(old: DataFrame, new: DataFrame, pk: str, overwrite: bool) -> DataFrame:
    """``overwrite``: new rows win; otherwise old rows win. Repeats inside one side all stay."""
    for side, df in (("old", old), ("new", new)):
        if pk not in df.columns:
            raise ValueError(f"upsert: the {side} table has no column {pk}")
    old = old.withColumn(pk, old[pk].cast("string"))
    new = new.withColumn(pk, new[pk].cast("string"))
    if overwrite:
        return without_keys_of(old, new, pk).unionByName(new, allowMissingColumns=True)
    return old.unionByName(without_keys_of(new, old, pk), allowMissingColumns=True)


def conflicting_keys(old: DataFrame, new: DataFrame, pk: str) -> DataFrame:
    """Keys present on both sides, as text: distinct on each side, then a semi join."""
    left = old.select(old[pk].cast("string").alias(pk)).distinct()
    right = new.select(new[pk].cast("string").alias(pk)).distinct()
    return left.join(right, pk, "left_semi")
