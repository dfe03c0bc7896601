"""Row filters."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.functions.text import int_string_id, is_number, is_valid
from reviewloom.operators.schema import existing


def drop_blank(df: DataFrame, names: Iterable[object]) -> DataFrame:
    """Keep rows in which every listed column that exists is neither null nor blank."""
    columns = existing(df, names)
    if not columns:
        return df
    checks = [is_valid(F.col(f"`{c}`"), df.schema[c].dataType) for c in columns]
    return df.where(reduce(Column.__and__, checks))


def normalise_ids(df: DataFrame, names: Iterable[object], drop_invalid: bool = True) -> DataFrame:
    """Ids as integer text; rows with an id that is no number go, or keep a null."""
    columns = existing(df, names)
    if not columns:
        return df
    kinds = {c: df.schema[c].dataType for c in columns}
    if drop_invalid:
        df = df.where(reduce(Column.__and__, [is_number(F.col(f"`{c}`"), k) for c, k in kinds.items()]))
    return df.withColumns({c: int_string_id(F.col(f"`{c}`"), k) for c, k in kinds.items()})


def filter_rows(df: DataFrame, filters: Mapping[str, object], contains: bool = True) -> DataFrame:
    """Case-insensitive filter on several columns, all of which must match.

    With ``contains`` each value is a regular expression searched in the column. Filters on
    unknown columns are skipped. Column names come out in lower case.
    """
    if not filters:
        return df
    lowered = df.toDF(*[c.lower() for c in df.columns])
    for name, wanted in filters.items():
        if name.lower() not in lowered.columns:
            continue
        value = F.lower(F.col(f"`{name.lower()}`").cast("string"))
        pattern = str(wanted).lower()
        lowered = lowered.where(value.rlike(pattern) if contains else value == pattern)
    return lowered
