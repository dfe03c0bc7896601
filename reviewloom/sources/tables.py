"""Table scans: a spec with select, where, group-by and order-by text; parts; directories."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.files import path_exists
from reviewloom.sources.dataset import Dataset


@dataclass(frozen=True)
class ScanSpec:
    select: Sequence[str | None] | str | None = None
    where: str | None = None
    group_by: Sequence[str] | str | None = None
    order_by: str | None = None


def clean_select(names: Sequence[str | None] | str | None) -> list[str]:
    """Strip, drop blanks and repeats, keep order; an empty list or a ``*`` means all columns."""
    if names is None:
        return ["*"]
    if isinstance(names, str):
        names = [names]
    cleaned = list(dict.fromkeys(n.strip() for n in names if n is not None and n.strip()))
    return ["*"] if not cleaned or "*" in cleaned else cleaned


def scan(df: DataFrame, spec: ScanSpec | None = None) -> DataFrame:
    """Apply a scan spec. Columns and predicates reach the file scan through the optimizer.

    Select items are plain column names, so grouping by the selected columns is DISTINCT.
    """
    if spec is None:
        return df
    if spec.where and spec.where.strip():
        df = df.where(F.expr(spec.where.strip()))
    columns = clean_select(spec.select)
    if spec.group_by:
        keys = [k.strip() for k in spec.group_by.split(",")] if isinstance(spec.group_by, str) else list(spec.group_by)
        wanted = df.columns if columns == ["*"] else columns
        loose = [c for c in wanted if c not in keys]
        if loose:
            raise ValueError(f"selected columns are not grouped: {loose}")
        df = df.select(*keys).distinct()
    if spec.order_by and spec.order_by.strip():
        df = df.orderBy(*[_order_item(item) for item in _order_items(spec.order_by)])
    return df if columns == ["*"] else df.select(*[F.col(f"`{c}`") for c in columns])


def _order_items(text: str) -> list[str]:
    """The items of an ORDER BY text: commas within brackets or quotes don't part them."""
    items, depth, quote = [""], 0, ""
    for c in text:
        if quote:
            quote = "" if c == quote else quote
        elif c in "'\"`":
            quote = c
        depth += 0 if quote else (c in "([") - (c in ")]")
        if c == "," and not depth and not quote:
            items.append("")
        else:
            items[-1] += c
    return items


_ORDER = re.compile(r"^(.*?)(?:\s+(ASC|DESC))?(?:\s+NULLS\s+(FIRST|LAST))?$", re.IGNORECASE | re.DOTALL)


def _order_item(text: str) -> Column:
    """One item with its direction; nulls come last unless it says otherwise."""
    expression, direction, nulls = _ORDER.match(text.strip()).groups()
    item, first = F.expr(expression), (nulls or "LAST").upper() == "FIRST"
    if (direction or "ASC").upper() == "DESC":
        return item.desc_nulls_first() if first else item.desc_nulls_last()
    return item.asc_nulls_first() if first else item.asc_nulls_last()


def load(
    spark: SparkSession,
    path: str,
    dataset: Dataset,
    spec: ScanSpec | None = None,
    fmt: str = "parquet",
    required: bool = False,
    **options,
) -> DataFrame:
    """Read one table. A missing path gives no rows, or an error when the table is ``required``."""
    if not path_exists(spark, path):
        if required:
            raise FileNotFoundError(f"{dataset.name}: nothing at {path}")
        return dataset.empty(spark)
    reader = spark.read.format(fmt).options(**options)
    if fmt == "csv":
        reader = reader.options(**{"header": True, **options})
    return scan(reader.load(path), spec)


def union_parts(parts: Sequence[DataFrame]) -> DataFrame:
    """All parts of one table, by name; a column a part lacks is null there."""
    if not parts:
        raise ValueError("no parts to read")
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part, allowMissingColumns=True)
    return result


def merge_directory(
    spark: SparkSession, path: str, wanted: Sequence[str], fmt: str = "parquet", **options
) -> DataFrame | None:
    """Wanted columns of every file below ``path`` as text; ``None`` when no file has any of them.

    All rows of a file that has a wanted column stay, also those whose wanted cells are empty; files without one go.
    One scan with merged schemas, however many files there are. The natural order of the file
    names is kept as ``file_order``, digits padded so that ``part_2`` comes before ``part_10``.
    CSV files may have different headers: each record is read by its own file's header.
    """
    if fmt == "csv":
        raw = spark.read.options(**{"header": True, "singleVariantColumn": "record", **options}).csv(path)
        # a record has the columns of its file's header, the empty ones too
        has = [F.try_variant_get("record", f"$['{c}']", "variant").isNotNull() for c in wanted]
        found = raw.where(reduce(Column.__or__, has, F.lit(False)))
        present = found.agg(*[F.count_if(h).alias(c) for h, c in zip(has, wanted, strict=True)]).first()
        existing = [c for c in wanted if present[c]]
        values = [F.try_variant_get("record", f"$['{c}']", "string").alias(c) for c in existing]
        return found.select(*values, _file_order()) if existing else None
    reader = spark.read.options(**options).format(fmt)
    merged = spark.read.options(**{"mergeSchema": True, **options}).format(fmt).load(path)
    existing = [c for c in dict.fromkeys(wanted) if c in merged.columns]
    if not existing:
        return None
    found = merged.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in existing], _file_order(), F.col("_metadata.file_path").alias("_file"))
    # only a file that shows no wanted value at all has to be asked for its columns
    empty = found.groupBy("_file").agg(F.max(F.coalesce(*existing).isNotNull()).alias("_some")).where(~F.col("_some"))
    without = [r["_file"] for r in empty.collect() if not set(existing) & set(reader.load(r["_file"]).columns)]
    kept = found.where(~F.col("_file").isin(without)) if without else found
    return kept.select(*existing, "file_order")


def _file_order():
    # 40 digits hold any number a file name is likely to have; a longer run sorts behind them
    padded = F.regexp_replace(F.col("_metadata.file_path"), r"(\d+)", "0" * 39 + "$1")
    return F.regexp_replace(padded, r"0*(\d{40})(?!\d)", "$1").alias("file_order")
