"""JSON pages and records as VARIANT columns."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.functions.text import clean_text
from reviewloom.session import stage

# Fixed value: an array position inside a dotted key, and what it is folded to.
INDEX_IN_KEY = r"\.\d+(\.|$)"
INDEX_FOLDED = ".{index}$1"
# A text that could be JSON; free text is left alone without a parse attempt.
_MAYBE_JSON = r'^\s*(?:[\[{"]|-?\d|true\b|false\b|null\b)'


def fold_index(key: Column) -> Column:
    """``a.3.b`` becomes ``a.{index}.b``."""
    return F.regexp_replace(key, INDEX_IN_KEY, INDEX_FOLDED)


def variant_path(key: str) -> str:
    """Dotted key with 1-based array positions to a JSON path with 0-based ones."""
    steps = []
    for part in key.split("."):
        quote = '"' if "'" in part else "'"
        steps.append(f"[{int(part) - 1}]" if part.isdigit() else f"[{quote}{part}{quote}]")
    return "$" + "".join(steps)


def embedded(value: Column) -> Column:
    """The value itself, or the parsed JSON when it is a text that holds JSON."""
    text = F.try_variant_get(value, "$", "string")
    is_json_text = (F.schema_of_variant(value) == "STRING") & text.rlike(_MAYBE_JSON)
    return F.when(is_json_text, F.coalesce(F.try_parse_json(text), value)).otherwise(value)


def get_key(record: Column, key: str, embedded_in: Iterable[str] = ()) -> Column:
    """VARIANT at a dotted key; ``embedded_in`` names the keys on the way that hold JSON texts."""
    here, done = record, ""
    for prefix in sorted((p for p in embedded_in if key.startswith(p + ".")), key=len):
        relative = prefix[len(done) + 1:] if done else prefix
        here = embedded(F.try_variant_get(here, variant_path(relative), "variant"))
        done = prefix
    rest = key[len(done) + 1:] if done else key
    return F.try_variant_get(here, variant_path(rest), "variant")


def _is_item(key: str) -> bool:
    """An array item: not searched for embedded JSON, and an array in it stays one value."""
    return key.rsplit(".", 1)[-1].isdigit()


def _may_be_container(text: Column) -> Column:
    return F.coalesce(text.rlike(r'^\s*[\[{"]'), F.lit(False))


def _is_container(value: Column, key: str) -> Column:
    if _is_item(key):
        return F.schema_of_variant(value).startswith("OBJECT<")
    return F.schema_of_variant(embedded(value)).rlike("^(OBJECT|ARRAY)<")


def leaf_text(value: Column, key: str) -> Column:
    """Cleaned text of the scalar at ``key``; null for null, missing, object and array values.

    Only texts that start like an object, an array or a quoted text are parsed.
    """
    text = F.try_variant_get(value, "$", "string")
    if _is_item(key):
        return F.when(_may_be_container(text) & _is_container(value, key), F.lit(None)).otherwise(clean_text(text))
    parsed = F.try_variant_get(embedded(value), "$", "string")
    plain = F.when(F.trim(text) != "null", clean_text(text))
    return F.when(_may_be_container(text), F.when(~_is_container(value, key), clean_text(parsed))).otherwise(plain)


def has_leaf(value: Column, key: str) -> Column:
    """True where the key exists and its value is a scalar (JSON null counts)."""
    text = F.try_variant_get(value, "$", "string")
    return value.isNotNull() & ~F.when(_may_be_container(text), _is_container(value, key)).otherwise(F.lit(False))


def target_keys(
    df: DataFrame,
    record: str,
    key_map: dict[str, str],
    keep: Sequence[str] = (),
    embedded_in: Iterable[str] = (),
    missing: str | None = None,
) -> DataFrame:
    """One text column per wanted key; absent keys give ``missing`` (null by default)."""
    keys = list(key_map)
    # Each value is looked up once, and read from its own column afterwards.
    found = df.select(*keep, *[get_key(F.col(record), k, embedded_in).alias(f"_k{i}") for i, k in enumerate(keys)])
    columns = []
    for i, key in enumerate(keys):
        held = F.col(f"_k{i}")
        value = leaf_text(held, key)
        if missing is not None:
            value = F.when(has_leaf(held, key), value).otherwise(F.lit(missing))
        columns.append(value.alias(key_map[key]))
    return found.select(*keep, *columns)


def missing_keys(df: DataFrame, record: str, keys: Sequence[str], embedded_in: Iterable[str] = ()) -> DataFrame:
    """Folded names of the wanted keys that at least one record lacks: one pass, one row of counts."""
    counts = df.agg(
        *[F.count_if(~has_leaf(get_key(F.col(record), k, embedded_in), k)).alias(f"k{i}") for i, k in enumerate(keys)]
    )
    pairs = F.array(
        *[F.struct(F.lit(k).alias("key"), F.col(f"k{i}").alias("records_without")) for i, k in enumerate(keys)]
    )
    return (
        counts.select(F.explode(pairs).alias("p"))
        .select(fold_index(F.col("p.key")).alias("missing_key"), "p.records_without")
        .where("records_without > 0")
        .groupBy("missing_key")
        .agg(F.max("records_without").alias("records_without"))
    )


def records(df: DataFrame, payload: str, path: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Walk each payload text down ``path`` and give one row per record, with its 0-based position.

    A missing step, a step into a scalar or a payload that is no JSON gives no rows.
    """
    array = records_array(F.col(payload), path)
    return df.select(*keep, F.posexplode(array).alias("position", "record"))


def records_array(payload: Column, path: Sequence[str]) -> Column:
    return F.try_variant_get(F.try_parse_json(payload), variant_path(".".join(path)), "array<variant>")


# Levels that one pass of `flatten` descends before it looks whether any value is still open.
LEVELS_PER_PASS = 4


def _is_open(value: str, member: str) -> Column:
    """An object, or an array that does not sit directly in an array."""
    kind = F.schema_of_variant(value)
    return F.coalesce(kind.startswith("OBJECT<") | (kind.startswith("ARRAY<") & F.col(member)), F.lit(False))


def _descend(level: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Each open value replaced by its children; finished ones go through unchanged."""
    stepped = level.withColumn("_open", _is_open("_v", "_member")).withColumn("_parent", F.when(F.col("_open"), F.col("_v")))
    exploded = stepped.lateralJoin(level.sparkSession.tvf.variant_explode_outer(F.col("_parent").outer()))
    in_object = F.col("key").isNotNull()
    child = F.when(in_object, embedded(F.col("value"))).otherwise(F.col("value"))
    step = F.coalesce(F.col("key"), (F.col("pos") + 1).cast("string"))
    return exploded.where(~F.col("_open") | F.col("pos").isNotNull()).select(
        *keep,
        F.when(F.col("_open"), child).otherwise(F.col("_v")).alias("_v"),
        F.when(F.col("_open"), F.concat_ws(".", "_path", step)).otherwise(F.col("_path")).alias("_path"),
        F.when(F.col("_open"), in_object).otherwise(F.col("_member")).alias("_member"),
    )


def flatten(df: DataFrame, record: str, keep: Sequence[str]) -> DataFrame:
    """Long form ``(keep…, path, value)`` of every leaf, dotted keys, 1-based array positions, at whatever depth.

    Texts that hold JSON are descended into when they are object members. An array inside an
    array stays one value. A pass goes some levels down and writes what it found: finished leaves are set
    aside as text, and only values that are still open are read by the next pass.
    """
    frontier = df.select(
        *keep,
        F.col(record).alias("_v"),
        F.lit(None).cast("string").alias("_path"),
        F.lit(True).alias("_member"),
    )
    finished = []
    while True:
        level = frontier
        for _ in range(LEVELS_PER_PASS):
            level = _descend(level, keep)
        is_open = _is_open("_v", "_member")
        text = F.try_variant_get("_v", "$", "string")
        leaf = F.when(F.schema_of_variant("_v").startswith("ARRAY<"), text).otherwise(clean_text(text))
        found = level.select(
            *keep, "_path", "_member", is_open.alias("_open"), F.when(is_open, F.col("_v")).alias("_v"), F.when(~is_open, leaf).alias("_text")
        )
        found = stage(found, "flat-levels")
        finished.append(found.where("NOT _open").select(*keep, F.col("_path").alias("path"), F.col("_text").alias("value")))
        frontier = found.where("_open").select(*keep, "_v", "_path", "_member")
        if frontier.isEmpty():
            return reduce(DataFrame.unionAll, finished)


def flat_key_map(nested: dict[str, object]) -> dict[str, str]:
    """Expand ``{"images.{index}": ("url", 3)}`` to ``{"images.1": "url1", …}``; plain names stay."""
    flat: dict[str, str] = {}
    for key, target in nested.items():
        if isinstance(target, str):
            flat[key] = target
            continue
        name, width = target
        if "{index}" not in key:
            raise ValueError(f"array key without an index place: {key}")
        for i in range(1, width + 1):
            flat[key.replace("{index}", str(i))] = f"{name}{i}"
    return flat


def embedded_prefixes(keys: Iterable[str], embedded_keys: Iterable[str]) -> list[str]:
    """The declared JSON-text keys that are a prefix of at least one wanted key."""
    wanted = list(keys)
    return [e for e in embedded_keys if any(re.match(re.escape(e) + r"\.", k) for k in wanted)]
