"""Upsert tables: key-bucketed segments of Parquet files under numbered versions.

Every row is in the bucket of its key's hash, and a segment is one written folder of buckets. A version names the live segments and which of
their buckets count, so a save touches only what its keys reach:

* rows already there win: the keys of the touched buckets are read, and a segment with the new keys' rows is added;
* new rows win: the touched buckets are written again without the old rows of the new keys, and the other buckets stay where they are.

A version is taken by publishing its file, which succeeds for one writer only. A writer that comes second does its work again on what the first one left.
Readers see finished versions only, and a failed save leaves files that no version names.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom.files import list_names, path_exists, publish, read_text, remove_path
from reviewloom.operators.upsert import upsert, without_keys_of
from reviewloom.session import stage

# Buckets of a new table. A bucket is what a save in which new rows win writes again, so it should stay near 1 GB.
BUCKETS = 64

# A version of more segments than this is merged into one segment by the save that would add to it.
MAX_SEGMENTS = 32

_BUCKET, _SEGMENT = "_bucket", "_segment"


@dataclass(frozen=True)
class Segment:
    """A written folder, the schema of its files, and its live buckets."""

    name: str
    schema: str
    buckets: tuple[int, ...]


@dataclass(frozen=True)
class Version:
    number: int
    pk: str
    bucket_count: int
    schema: str
    segments: tuple[Segment, ...]


def _version_path(path: str, number: int) -> str:
    return f"{path}/_versions/{number:012d}.json"


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the published versions."""
    log = f"{path}/_versions"
    names = list_names(spark, log) if path_exists(spark, log) else []
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))


def version(spark: SparkSession, path: str, number: int | None = None) -> Version | None:
    """The named version, or the newest one; ``None`` before the first save."""
    if number is None:
        known = versions(spark, path)
        if not known:
            return None
        number = known[-1]
    held = json.loads(read_text(spark, _version_path(path, number)))
    return Version(**{**held, "segments": tuple(Segment(**{**s, "buckets": tuple(s["buckets"])}) for s in held["segments"])})


def _schema(text: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(text))


def _rows(spark: SparkSession, path: str, of: Version, buckets: Iterable[int] | None = None, columns: list[str] | None = None) -> DataFrame:
    """Live rows, of some buckets only if named: one scan per schema that segments were written with, pruned to their live buckets."""
    wanted = None if buckets is None else set(buckets)
    target = _schema(of.schema)
    names = columns or target.names
    by_schema: dict[str, list[Segment]] = {}
    for segment in of.segments:
        if wanted is None or wanted & set(segment.buckets):
            by_schema.setdefault(segment.schema, []).append(segment)
    parts = []
    for text, segments in by_schema.items():
        written = _schema(text)
        fields = T.StructType([*written.fields, T.StructField(_SEGMENT, T.StringType()), T.StructField(_BUCKET, T.IntegerType())])
        scan = spark.read.schema(fields).option("basePath", path).parquet(*[f"{path}/{_SEGMENT}={s.name}" for s in segments])
        live = F.lit(False)
        for s in segments:
            live = live | ((F.col(_SEGMENT) == s.name) & F.col(_BUCKET).isin(*[b for b in s.buckets if wanted is None or b in wanted]))
        kinds = {f.name: f.dataType for f in target.fields}
        parts.append(
            scan.where(live).select(
                *[(F.col(f"`{c}`") if c in written.names else F.lit(None)).cast(kinds[c]).alias(c) for c in names]
            )
        )
    if not parts:
        return spark.createDataFrame([], T.StructType([target[c] for c in names]))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionAll(part)
    return rows


def read_current(spark: SparkSession, path: str, number: int | None = None) -> DataFrame | None:
    """Rows of the newest (or a named) version, ``None`` before the first one."""
    held = version(spark, path, number)
    return None if held is None else _rows(spark, path, held)


def _bucket(pk: str, count: int) -> Column:
    return F.pmod(F.xxhash64(F.coalesce(F.col(f"`{pk}`").cast("string"), F.lit(""))), F.lit(count)).cast("int").alias(_BUCKET)


def _write_segment(rows: DataFrame, path: str, pk: str, count: int) -> Segment:
    """Write rows as a segment. Rebalancing splits a bucket that one key fills and packs small ones into a task."""
    spark, name = rows.sparkSession, uuid.uuid4().hex
    target = f"{path}/{_SEGMENT}={name}"
    rows.withColumn(_BUCKET, _bucket(pk, count)).hint("rebalance", _BUCKET).write.partitionBy(_BUCKET).parquet(target)
    found = sorted(int(n.split("=", 1)[1]) for n in list_names(spark, target) if n.startswith(f"{_BUCKET}="))
    return Segment(name, rows.schema.json(), tuple(found))


def _next(spark: SparkSession, path: str, base: Version, new: DataFrame, overwrite: bool) -> Version:
    """The version after ``base`` with the staged rows ``new`` in it."""
    pk, count = base.pk, base.bucket_count
    everything = base.segments and len(base.segments) >= MAX_SEGMENTS
    touched = set(range(count)) if everything else {r[0] for r in new.select(_bucket(pk, count)).distinct().collect()}
    old = _rows(spark, path, base, touched)
    schema = upsert(old.limit(0), new.limit(0), pk, overwrite).schema
    if overwrite or everything:
        rows = upsert(old, new, pk, overwrite)
        kept = [Segment(s.name, s.schema, tuple(b for b in s.buckets if b not in touched)) for s in base.segments]
    else:
        keys = _rows(spark, path, base, touched, [pk])
        rows = without_keys_of(new, keys.withColumn(pk, F.col(f"`{pk}`").cast("string")), pk)
        kept = list(base.segments)
    added = _write_segment(rows, path, pk, count)
    live = tuple(s for s in [*kept, added] if s.buckets)
    return Version(base.number + 1, pk, count, schema.json(), live)


def save(
    df: DataFrame, path: str, pk: str | None, overwrite: bool = False, write_empty: bool = False, buckets: int = BUCKETS, staged: bool = False
) -> bool:
    """Upsert ``df`` into the table at ``path`` and say whether anything was written.

    Nothing is written without a key name, without rows, or when either side lacks the key column. Into an empty table the rows go as they are;
    otherwise keys become text. ``buckets`` counts when the table is made. ``staged`` says that ``df`` is a scan of written files.
    """
    spark = df.sparkSession
    if not pk or pk not in df.columns:
        return False
    # a retry, and the upsert itself, look at the new rows more than once
    new = df if staged else stage(df, "new-rows")
    if not write_empty and new.isEmpty():
        return False
    while True:
        base = version(spark, path)
        if base is not None and pk not in _schema(base.schema).names:
            return False
        if base is not None and base.pk != pk:
            raise ValueError(f"the table at {path} is keyed by {base.pk}, not by {pk}")
        if base is None or not base.segments:
            added = _write_segment(new, path, pk, base.bucket_count if base else buckets)
            count, number = (base.bucket_count, base.number + 1) if base else (buckets, 1)
            made = Version(number, pk, count, new.schema.json(), (added,) if added.buckets else ())
        else:
            texts = new.withColumn(pk, F.col(f"`{pk}`").cast("string"))
            made = _next(spark, path, base, texts, overwrite)
        if publish(spark, _version_path(path, made.number), json.dumps(asdict(made))):
            return True
        # another writer took the number: what was written for it is no part of any version
        _remove_segments(spark, path, {s.name for s in made.segments} - {s.name for s in (base.segments if base else ())})


def compact(spark: SparkSession, path: str) -> bool:
    """Merge the live segments into one. Says whether it did; it gives way to a save that came in between."""
    base = version(spark, path)
    if base is None or len(base.segments) < 2:
        return False
    added = _write_segment(_rows(spark, path, base), path, base.pk, base.bucket_count)
    made = Version(base.number + 1, base.pk, base.bucket_count, base.schema, (added,))
    if publish(spark, _version_path(path, made.number), json.dumps(asdict(made))):
        return True
    _remove_segments(spark, path, {added.name})
    return False


def _remove_segments(spark: SparkSession, path: str, names: Iterable[str]) -> None:
    for name in names:
        remove_path(spark, f"{path}/{_SEGMENT}={name}")


def forget_versions(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Remove all but the newest versions, and the segments that only those named. Readers of a removed version lose its files."""
    if keep < 1:
        raise ValueError("the newest version stays")
    known = versions(spark, path)
    held = {s.name for n in known[-keep:] for s in version(spark, path, n).segments}
    for n in known[:-keep]:
        gone = {s.name for s in version(spark, path, n).segments} - held
        remove_path(spark, _version_path(path, n))
        _remove_segments(spark, path, gone)
