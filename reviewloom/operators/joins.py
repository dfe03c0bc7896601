"""Equi joins. No broadcast hints: the planner broadcasts a side only when its measured size is
below ``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles, splitting hot partitions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.operators.filters import drop_blank
from reviewloom.operators.schema import reindex
from reviewloom.session import stage
from reviewloom.sources.dataset import require_columns

# Join kinds and what the DataFrame API calls them.
JOIN_KINDS = {"LEFT": "left", "RIGHT": "right", "INNER": "inner", "FULL OUTER": "full"}

# Most keys of one side that are dealt to pieces; a key beyond them has at most a few ten-thousandths of the rows.
TRACKED_KEYS = 4096

# Pieces of a hot key that make up the rows of an average partition; small ones spread evenly.
PIECES_OF_AVERAGE = 4


def _kind(how: str) -> str:
    if how not in JOIN_KINDS:
        raise ValueError(f"unknown join kind {how!r}, expected one of {sorted(JOIN_KINDS)}")
    return JOIN_KINDS[how]


_LEFT, _RIGHT = "l.", "r."


def _of(side: str, name: str) -> Column:
    return F.col(f"`{side}{name}`")


@dataclass(frozen=True)
class HotKeys:
    """Keys of one side with so many rows that a partition of them would be a long task.

    ``table`` has the key columns and ``pieces``, into how many parts a key's rows are dealt; it has at most ``TRACKED_KEYS`` rows. ``null_pieces``
    is the same for the rows without a key, which match nothing but have to be carried by an outer join.
    """

    table: DataFrame | None
    null_pieces: int


def _size_in_bytes(df: DataFrame) -> int:
    """The planner's estimate, from file sizes."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def _byte_setting(spark: SparkSession, name: str) -> int:
    value = spark.conf.get(name)
    return -1 if value.startswith("-") else int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(value))


def hot_keys(side: DataFrame, keys: Sequence[str]) -> HotKeys:
    """Keys whose rows pass what an average partition holds, by a sketch of frequent items over one scan of the key columns.

    Nothing is shuffled but the sketches. Candidates get their exact counts afterwards, so a key that is named here is known to occur. A side
    so small that Spark would rather broadcast it, or call none of its partitions skewed, is not looked at.
    """
    spark = side.sparkSession
    settings = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes")
    if _size_in_bytes(side) <= min(_byte_setting(spark, name) for name in settings):
        return HotKeys(None, 1)
    columns = [F.col(f"`{k}`") for k in keys]
    known = reduce(Column.__and__, [c.isNotNull() for c in columns])
    mark = F.xxhash64(*columns)
    tracked = F.call_function("approx_top_k", F.when(known, mark), F.lit(TRACKED_KEYS), F.lit(4 * TRACKED_KEYS))
    found = side.agg(F.count(F.lit(1)).alias("rows"), F.count_if(~known).alias("nulls"), tracked.alias("top")).first()
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    average = max(1, found["rows"] // partitions)
    marks = [item["item"] for item in found["top"] or [] if item["item"] is not None and item["count"] > average]
    piece = max(1, average // PIECES_OF_AVERAGE)
    null_pieces = -(-found["nulls"] // piece) if found["nulls"] > average else 1
    if not marks:
        return HotKeys(None, null_pieces)
    counted = side.where(known & mark.isin(*marks)).groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > average)
    pieces = F.ceil(F.col("n") / piece).cast("int")
    return HotKeys(stage(counted.select(*columns, pieces.alias("pieces")), "hot-keys"), null_pieces)


# Columns that the spread sides of a join have besides their own.
_SALTS, _REPEATED, _HERE = ("_deal", "_copy"), "_repeated", "_here"


def _spread(side: DataFrame, mark: str, keys: Sequence[str], own: HotKeys, other_keys: Sequence[str], other: HotKeys, swap: bool) -> DataFrame:
    """Deal the rows of the side's own hot keys to pieces, and repeat the rows of the other side's hot keys once per piece of those.

    The dealt pieces are staged: a task that runs again has to deal its rows alike. The tables of hot keys are small by their bound.
    """
    columns = [F.col(f"`{k}`") for k in keys]
    null_key = reduce(Column.__or__, [c.isNull() for c in columns])
    dealt, copied = (_SALTS[1], _SALTS[0]) if swap else _SALTS

    def pieces_of(rows: DataFrame, hot: HotKeys, names: Sequence[str], column: str) -> DataFrame:
        if hot.table is None:
            return rows.withColumn(column, F.lit(None).cast("int"))
        table = hot.table.toDF(*[f"_h{i}" for i in range(len(names))], column)
        same = reduce(Column.__and__, [c == F.col(f"_h{i}") for i, c in enumerate(columns)])
        return rows.join(F.broadcast(table), same, "left").drop(*[f"_h{i}" for i in range(len(names))])

    rows = side
    if own.table is not None or own.null_pieces > 1:
        rows = pieces_of(rows, own, keys, "_own")
        pieces = F.when(null_key, F.lit(own.null_pieces)).otherwise(F.coalesce("_own", F.lit(1)))
        dealt_rows = rows.withColumn(dealt, F.pmod(F.monotonically_increasing_id(), pieces).cast("int")).drop("_own")
        rows = stage(dealt_rows, "dealt-rows")
    else:
        rows = rows.withColumn(dealt, F.lit(0))
    rows = pieces_of(rows, other, other_keys, "_other")
    repeated = rows.withColumn(_REPEATED + mark, F.col("_other").isNotNull())
    copies = F.explode(F.sequence(F.lit(0), F.coalesce("_other", F.lit(1)) - 1))
    return repeated.withColumn(copied, copies).drop("_other").withColumn(_HERE + mark, F.lit(True))


def _joined(left: DataFrame, right: DataFrame, keys: Mapping[str, str], how: str) -> DataFrame:
    """The join with every column marked by its side; each side is read once by it.

    Adaptive execution splits a hot partition on either side of an inner join and on the kept side of a left or right join, but not on the other
    side of those, whose rows multiply, and not in a full join. Hot keys of those sides are dealt to pieces, and the rows they meet
    are repeated per piece. A repeated row without a partner in one piece has one in another, since its key is known to occur, so such rows go.
    """
    kind = _kind(how)
    if not keys:
        raise ValueError("a join needs at least one key")
    marked_left = left.toDF(*[_LEFT + c for c in left.columns])
    marked_right = right.toDF(*[_RIGHT + c for c in right.columns])
    left_keys, right_keys = [_LEFT + a for a in keys], [_RIGHT + b for b in keys.values()]
    same = reduce(Column.__and__, [_of(_LEFT, a) == _of(_RIGHT, b) for a, b in keys.items()])
    hot_left = hot_keys(marked_left, left_keys) if kind in ("right", "full") else HotKeys(None, 1)
    hot_right = hot_keys(marked_right, right_keys) if kind in ("left", "full") else HotKeys(None, 1)
    # rows without a key are lost or kept one by one where adaptive execution can split them
    if kind != "full":
        hot_left, hot_right = HotKeys(hot_left.table, 1), HotKeys(hot_right.table, 1)
    if all(h.table is None and h.null_pieces == 1 for h in (hot_left, hot_right)):
        return marked_left.join(marked_right, same, kind)
    spread_left = _spread(marked_left, "l", left_keys, hot_left, right_keys, hot_right, swap=False)
    spread_right = _spread(marked_right, "r", right_keys, hot_right, left_keys, hot_left, swap=True).withColumnsRenamed({s: f"{s}_r" for s in _SALTS})
    salted = reduce(Column.__and__, [F.col(s) == F.col(f"{s}_r") for s in _SALTS], same)
    joined = spread_left.join(spread_right, salted, kind)
    alone = lambda here, absent: F.coalesce(F.col(_REPEATED + here), F.lit(False)) & F.col(_HERE + absent).isNull()
    return joined.where(~(alone("l", "r") | alone("r", "l"))).select(*[f"`{c}`" for c in [*marked_left.columns, *marked_right.columns]])


def simple_join(left: DataFrame, right: DataFrame, keys: Mapping[str, str], how: str) -> DataFrame:
    """All columns of both sides; the names must not collide (prefix them first)."""
    clash = sorted(set(left.columns) & set(right.columns))
    if clash:
        raise ValueError(f"both sides have {clash}")
    return _joined(left, right, keys, how).toDF(*left.columns, *right.columns)


def named_join(
    left: DataFrame,
    right: DataFrame,
    keys: Mapping[str, str],
    how: str,
    left_name: str,
    right_name: str,
    left_columns: Sequence[str] | None = None,
    right_columns: Sequence[str] | None = None,
    drop_common: bool = False,
) -> DataFrame:
    """Join whose shared non-key columns are told apart as ``column__side``.

    LEFT and RIGHT keep the leading side unchanged, add the other side's own columns, then its
    copies of the shared columns. INNER adds both sides' copies behind the left side. FULL OUTER
    lists the own columns, every key once per side, then both copies. ``drop_common`` leaves the
    renamed copies out; the leading side keeps its own.
    """
    _kind(how)
    lcols = list(dict.fromkeys(left.columns if left_columns is None else left_columns))
    rcols = list(dict.fromkeys(right.columns if right_columns is None else right_columns))
    if not keys or not lcols or not rcols:
        raise ValueError("keys and both column lists must not be empty")
    for a, b in keys.items():
        if a not in lcols or b not in rcols:
            raise ValueError(f"join key {a} = {b} is not in both column lists")
    lkeys, rkeys = set(keys), set(keys.values())
    left_only = [c for c in lcols if c not in rcols and c not in lkeys]
    right_only = [c for c in rcols if c not in lcols and c not in rkeys]
    common = [c for c in lcols if c in rcols and c not in lkeys and c not in rkeys]

    def own(side: str, names: Sequence[str]) -> list[Column]:
        return [_of(side, c).alias(c) for c in names]

    def copies(side: str, name: str) -> list[Column]:
        return [] if drop_common else [_of(side, c).alias(f"{c}__{name}") for c in common]

    if how == "LEFT":
        columns = own(_LEFT, left.columns) + own(_RIGHT, right_only) + copies(_RIGHT, right_name)
    elif how == "RIGHT":
        columns = own(_RIGHT, right.columns) + own(_LEFT, left_only) + copies(_LEFT, left_name)
    elif how == "INNER":
        columns = own(_LEFT, left.columns) + own(_RIGHT, right_only) + copies(_LEFT, left_name) + copies(_RIGHT, right_name)
    else:
        key_pairs = [
            _of(side, k).alias(f"{k}__{name}")
            for a, b in keys.items()
            for side, k, name in ((_LEFT, a, left_name), (_RIGHT, b, right_name))
        ]
        columns = own(_LEFT, left_only) + own(_RIGHT, right_only) + key_pairs + copies(_LEFT, left_name) + copies(_RIGHT, right_name)
    return _joined(left, right, keys, how).select(*columns)


def remap_options(
    df: DataFrame, options: DataFrame, columns: Mapping[str, str], key: str
) -> DataFrame:
    """Overwrite id, name and option columns of ``df`` by those of the option table.

    ``columns`` maps option-table columns to columns of ``df``; ``key`` is the option table's
    product id. Rows with a blank value in a mapped column go on both sides and after the join.
    Several options of one product multiply the rows.
    """
    require_columns(options, columns.keys(), "option table")
    require_columns(df, columns.values(), "table to remap")
    source = drop_blank(options, columns.keys()).select(*[F.col(f"`{c}`").alias(f"option__{c}") for c in columns])
    target = drop_blank(df, columns.values())
    joined = target.join(source, target[f"`{columns[key]}`"] == source[f"`option__{key}`"], "inner")
    replaced = joined.select(
        *[joined[f"`option__{a}`"].alias(b) for a, b in columns.items()],
        *[target[f"`{c}`"] for c in df.columns if c not in columns.values()],
    )
    return reindex(drop_blank(replaced, columns.values()), df.columns, strict=True)
