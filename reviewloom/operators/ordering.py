"""Global numbering, fixed-size chunks and id batches without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.session import stage

# Fixed value: rows an export chunk may hold at most.
MAX_CHUNK_SIZE = 500

# monotonically_increasing_id puts the partition above bit 33 and the position below it.
_POSITION_BITS = 33


def _with_place_in_files(df: DataFrame, scanned: bool) -> DataFrame:
    """Add file and row index. Range partitioning looks at its input twice, and both looks have to
    see the same places, so anything but a plain table scan is staged first."""
    table = df if scanned else stage(df, "to-number")
    return table.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))


def number_rows(
    df: DataFrame, order: Sequence[Column], name: str = "row_number", total: str | None = None, scanned: bool = False
) -> DataFrame:
    """1-based row number in ``order``; rows equal in it keep the order of the table's files.

    The rows are range-partitioned on the whole order and their place in the files, so that one
    product, or one group of equal copies, with a third of the rows spreads over many tasks. They
    are sorted per partition and staged together with their position. Partition sizes then give
    every partition's first number. The joined table of sizes has one row per shuffle partition,
    which is what makes its broadcast safe. ``total`` names a column for the row count of the
    whole table. ``scanned`` says that ``df`` comes straight from Parquet files.
    """
    placed_in = [F.col("_file"), F.col("_row")]
    ranged = _with_place_in_files(df, scanned).repartitionByRange(*order, *placed_in).sortWithinPartitions(*order, *placed_in)
    placed = ranged.drop("_file", "_row").withColumn("_place", F.monotonically_increasing_id())
    staged = stage(placed, "numbered")
    staged = staged.withColumns(
        {
            "_part": F.shiftright("_place", _POSITION_BITS),
            "_pos": F.col("_place").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)),
        }
    )
    sizes = staged.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    in_order = Window.orderBy("_part")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    everything = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = sizes.select(
        "_part",
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"),
        *([F.sum("_size").over(everything).alias(total)] if total else []),
    )
    numbered = staged.join(F.broadcast(offsets), "_part")
    return numbered.withColumn(name, F.col("_offset") + F.col("_pos") + 1).drop("_place", "_part", "_pos", "_offset")


def number_chunks(df: DataFrame, order: Sequence[Column], size: int, scanned: bool = False) -> DataFrame:
    """Cut the ordered table into chunks of ``size`` rows.

    Adds ``row_number``, the 1-based ``chunk`` and the ``chunk_count`` of the table.
    """
    if not 1 <= size <= MAX_CHUNK_SIZE:
        raise ValueError(f"a chunk holds 1 to {MAX_CHUNK_SIZE} rows, got {size}")
    numbered = number_rows(df, order, total="_rows", scanned=scanned)
    return numbered.withColumns(
        {"chunk": F.floor((F.col("row_number") - 1) / size) + 1, "chunk_count": F.ceil(F.col("_rows") / size)}
    ).drop("_rows")


def chunk_manifest(numbered: DataFrame) -> DataFrame:
    """One row per chunk with its size and first and last row."""
    return numbered.groupBy("chunk", "chunk_count").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min("row_number").alias("first_row"),
        F.max("row_number").alias("last_row"),
    )


def id_batches(ids: DataFrame, key: str, position: str, size: int) -> DataFrame:
    """Distinct ids in order of ``position``, ``size`` of them per batch, as one array per batch."""
    numbered = number_rows(ids.select(key, position), [F.col(position), F.col(key)])
    batch = F.floor((F.col("row_number") - 1) / size) + 1
    entries = F.array_sort(F.collect_list(F.struct("row_number", key)))
    return (
        numbered.groupBy(batch.alias("batch"))
        .agg(entries.alias("_entries"))
        .select("batch", F.size("_entries").alias("id_count"), F.col(f"_entries.{key}").alias("ids"))
    )
