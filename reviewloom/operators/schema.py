"""Projection operators: select, rename, prefix, map one column spec to another."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom.sources.dataset import Dataset, indexed_name


def existing(df: DataFrame, names: Iterable[object]) -> list[str]:
    """Names that are real columns of ``df``, in list order, without repeats."""
    have = set(df.columns)
    return list(dict.fromkeys(n for n in names if isinstance(n, str) and n.strip() and n in have))


def reindex(df: DataFrame, names: Sequence[object], strict: bool = False) -> DataFrame:
    """Keep the listed columns in list order. ``strict`` demands exactly the columns of ``df``."""
    columns = existing(df, names)
    if strict:
        not_text = [n for n in names if n is not None and not isinstance(n, str)]
        listed = {n for n in names if isinstance(n, str)}
        if not_text or None in names or listed != set(df.columns):
            raise ValueError(
                f"columns differ: missing {sorted(listed - set(df.columns))}, "
                f"not listed {sorted(set(df.columns) - listed)}, not text {not_text}"
            )
    return df.select(*[F.col(f"`{c}`") for c in columns])


def rename(df: DataFrame, mapping: Mapping[str | None, str | None]) -> DataFrame:
    """Rename the columns that exist; pairs with a missing side are skipped."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k is not None and v is not None and k in df.columns})


def drop(df: DataFrame, names: Iterable[object]) -> DataFrame:
    return df.drop(*existing(df, names))


def prefix_columns(df: DataFrame, dataset: Dataset, prefix: str) -> tuple[DataFrame, Dataset]:
    """Prefix the declared columns, so that joined tables cannot collide."""
    declared = dataset.flat().values()
    return rename(df, {c: prefix + c for c in declared}), dataset.prefixed(prefix)


def mapping_between(source: Dataset, target: Dataset) -> dict[str, str]:
    """Physical rename map for the logical names both specs declare.

    Two arrays pair up by position as far as the shorter one goes; an array and a plain column
    pair position 1 with the plain name.
    """
    result: dict[str, str] = {}
    for logical, name in source.columns.items():
        other = target.get(logical)
        if other is None:
            continue
        wide_source, wide_target = logical in source.arrays, logical in target.arrays
        if wide_source and wide_target:
            result.update(zip(source.indexed(logical), target.indexed(logical)))
        elif wide_source:
            result[indexed_name(name, 1)] = other
        elif wide_target:
            result[name] = indexed_name(other, 1)
        else:
            result[name] = other
    return result


def map_to(df: DataFrame, source: Dataset, target: Dataset) -> DataFrame:
    return rename(df, mapping_between(source, target))


def resolve_by_priority(sources: Sequence[Dataset], target: Dataset) -> dict[str, str]:
    """Per flat target name, the physical column of the first source that declares it.

    This chooses columns, it does not merge values; a name no source has keeps the target's own.
    """
    chosen: dict[str, str] = {}
    for logical, own in target.flat().items():
        chosen[logical] = next((s.flat()[logical] for s in sources if logical in s.flat()), own)
    return chosen


def rename_between(chosen: Mapping[str, str], target: Mapping[str, str]) -> dict[str, str]:
    """Rename map between two flat mappings that share their logical names."""
    return {column: target[logical] for logical, column in chosen.items() if logical in target}


def project_by_priority(
    df: DataFrame, sources: Sequence[Dataset], target: Dataset, keep: Sequence[str] = ()
) -> DataFrame:
    """Select and rename in one projection; target columns nobody supplies are left out.

    ``keep`` lists columns to carry along under their own names.
    """
    chosen = resolve_by_priority(sources, target)
    names = rename_between(chosen, target.flat())
    supplied = [F.col(f"`{c}`").alias(n) for c, n in names.items() if c in df.columns]
    return df.select(*supplied, *[F.col(f"`{c}`") for c in keep])


def export_order(layout: Dataset, paired: Sequence[tuple[str, str]], after: str) -> list[str]:
    """Flat columns of the layout with each name/value pair interleaved and placed after ``after``."""
    moved = {logical for pair in paired for logical in pair}
    block = [
        column
        for names, values in paired
        for pair in zip(layout.indexed(names), layout.indexed(values))
        for column in pair
    ]
    result: list[str] = []
    for logical, name in layout.columns.items():
        if logical in moved:
            continue
        result.extend(layout.indexed(logical) if logical in layout.arrays else [name])
        if logical == after:
            result.extend(block)
    return result if after in layout else result + block


def widen_array(df: DataFrame, column: str, width: int, name: str | None = None) -> DataFrame:
    """``column`` becomes ``name1 … nameN``; positions past the end are null."""
    base = name or column
    kept = [F.col(f"`{c}`") for c in df.columns if c != column]
    return df.select(*kept, *[F.get(F.col(column), i).alias(indexed_name(base, i + 1)) for i in range(width)])


def unify_types(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Narrow the columns to text, long or double by what they hold.

    Text and nested columns become text, numbers become long unless a value has a fraction,
    columns without any value become text. One aggregate row decides, one projection casts.
    """
    wanted = existing(df, names) if names else df.columns
    fields = {f.name: f.dataType for f in df.schema.fields}
    probes = []
    for c in wanted:
        if isinstance(fields[c], (T.NumericType, T.BooleanType)):
            value = F.col(f"`{c}`")
            held = value.isNotNull()
            if isinstance(fields[c], (T.DoubleType, T.FloatType)):
                held = held & ~F.isnan(value)
            probes.append(F.count_if(held).alias(f"held {c}"))
            if isinstance(fields[c], T.FractionalType):
                probes.append(F.count_if(held & (value != F.floor(value))).alias(f"fraction {c}"))
    facts = df.agg(*probes).first().asDict() if probes else {}

    def narrowed(c: str):
        kind, value = fields[c], F.col(f"`{c}`")
        if c not in wanted:
            return value
        if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
            return F.to_json(value).alias(c)
        if not isinstance(kind, (T.NumericType, T.BooleanType)) or not facts[f"held {c}"]:
            return value.cast("string").alias(c)
        if facts.get(f"fraction {c}"):
            return value.cast("double").alias(c)
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            return F.when(~F.isnan(value), value).cast("bigint").alias(c)
        return value.cast("bigint").alias(c)

    return df.select(*[narrowed(c) for c in df.columns])
