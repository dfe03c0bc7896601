"""Trend, ratio and smoothing rules of the tuner.

They work on interval statistics: one row per interval of a series, so windows over a series see
as many rows as the log has intervals, however large the log is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Intervals per chunk, chunks needed, limits and step of the memory ratio.
INTERVAL_CHUNK_SIZE = 12
MIN_CHUNK_COUNT = 2
MIN_MEMORY_RATIO = 0.4
MAX_MEMORY_RATIO = 0.8
MEMORY_RATIO_STEP = 0.05
# Fixed value: number of latest deltas that count as recent.
RECENT_DELTAS = 3


def chunk_means(
    stats: DataFrame, series: Sequence[str], order: str, value: str, size: int = INTERVAL_CHUNK_SIZE
) -> DataFrame:
    """Mean of ``value`` per chunk of ``size`` intervals; a last chunk below half a chunk joins the previous."""
    ordered = Window.partitionBy(*series).orderBy(order)
    whole = Window.partitionBy(*series)
    ranked = stats.select(
        *series,
        F.col(value).alias("_value"),
        (F.row_number().over(ordered) - 1).alias("_i"),
        F.count(F.lit(1)).over(whole).alias("_n"),
    )
    last = F.floor((F.col("_n") - 1) / size)
    last_size = F.col("_n") - last * size
    merged = (last_size < max(size // 2, 1)) & (last > 0)
    chunk = F.least(F.floor(F.col("_i") / size), F.when(merged, last - 1).otherwise(last))
    return (
        ranked.select(*series, "_value", chunk.alias("chunk"), F.col("_n").alias("interval_count"), last_size.alias("last_chunk_size"))
        .groupBy(*series, "chunk", "interval_count", "last_chunk_size")
        .agg(F.avg("_value").alias("chunk_mean"))
    )


def trend_forecast(
    stats: DataFrame,
    series: Sequence[str],
    order: str,
    value: str,
    size: int = INTERVAL_CHUNK_SIZE,
    min_chunks: int = MIN_CHUNK_COUNT,
) -> DataFrame:
    """Weighted linear trend over the chunk means, read off at the present position.

    Chunk ``x`` has residual weight ``x + 1``, i.e. weight ``(x + 1)**2`` in the squared error.
    The present is ``chunks - 1`` plus the filled share of the last chunk before merging. Too few
    intervals are an error.
    """
    means = chunk_means(stats, series, order, value, size)
    x, y = F.col("chunk").cast("double"), F.col("chunk_mean")
    w = (x + 1) * (x + 1)
    sums = means.groupBy(*series, "interval_count", "last_chunk_size").agg(
        F.count(F.lit(1)).alias("chunk_count"),
        F.sum(w).alias("s0"),
        F.sum(w * x).alias("s1"),
        F.sum(w * x * x).alias("s2"),
        F.sum(w * y).alias("t0"),
        F.sum(w * x * y).alias("t1"),
    )
    slope = (F.col("s0") * F.col("t1") - F.col("s1") * F.col("t0")) / (F.col("s0") * F.col("s2") - F.col("s1") * F.col("s1"))
    intercept = (F.col("t0") - F.col("slope") * F.col("s1")) / F.col("s0")
    present = F.col("chunk_count") - 1 + F.least(F.col("last_chunk_size") / F.lit(float(size)), F.lit(1.0))
    enough = F.col("interval_count") >= size * min_chunks
    forecast = F.greatest(F.lit(1).cast("bigint"), F.bround(F.col("slope") * F.col("present") + F.col("intercept")).cast("bigint"))
    return (
        sums.withColumn("slope", F.when(enough, slope))
        .withColumn("intercept", intercept)
        .withColumn("present", present)
        .select(
            *series,
            "interval_count",
            "chunk_count",
            F.round("present", 6).alias("present"),
            F.round("slope", 6).alias("slope"),
            F.round("intercept", 6).alias("intercept"),
            F.when(
                ~enough, F.raise_error(F.lit(f"a trend needs at least {size * min_chunks} intervals")).cast("bigint")
            )
            .otherwise(forecast)
            .alias("forecast"),
        )
    )


def updated_ratio(
    inferred: Column,
    oom: Column,
    previous: Column | float,
    low: float = MIN_MEMORY_RATIO,
    high: float = MAX_MEMORY_RATIO,
    step: float = MEMORY_RATIO_STEP,
) -> Column:
    """Grow while nothing failed, fall back to the minimum when failures dominate, else shrink by their share."""
    prev = previous if isinstance(previous, Column) else F.lit(previous)
    return (
        F.when(oom == 0, F.least(F.lit(high), prev + step))
        .when((inferred == 0) | (oom >= inferred), F.lit(low))
        .otherwise(F.greatest(F.lit(low), prev * (1 - oom / inferred)))
    )


def ema_step(alpha: Column | float, previous: Column, current: Column, low: float, high: float) -> Column:
    """``alpha * current + (1 - alpha) * previous``; the previous value unless ``low < alpha < high``."""
    a = alpha if isinstance(alpha, Column) else F.lit(alpha)
    return F.when((a > low) & (a < high), a * current + (1 - a) * previous).otherwise(previous.cast("double"))


def adaptive_alpha(
    stats: DataFrame,
    series: Sequence[str],
    order: str,
    value: str,
    previous: float,
    low: float,
    high: float,
    step: float,
    noise: float,
    recent: int = RECENT_DELTAS,
) -> DataFrame:
    """Move alpha by ``step`` when the mean of the last ``recent`` deltas leaves the mean of the earlier ones."""
    ordered = Window.partitionBy(*series).orderBy(order)
    whole = Window.partitionBy(*series)
    deltas = stats.select(
        *series,
        (F.col(value) - F.lag(value).over(ordered)).cast("double").alias("_delta"),
        (F.row_number().over(ordered) - 2).alias("_i"),
        F.count(F.lit(1)).over(whole).alias("_n"),
    )
    # Delta i leads from interval i to i + 1, so there are n - 1 of them.
    means = deltas.groupBy(*series, "_n").agg(
        F.avg(F.when((F.col("_i") >= 0) & (F.col("_i") < F.col("_n") - recent), F.col("_delta"))).alias("_past"),
        F.avg(F.when((F.col("_i") >= 0) & (F.col("_i") >= F.col("_n") - 1 - recent), F.col("_delta"))).alias("_recent"),
    )
    change = F.col("_recent") - F.col("_past")
    alpha = (
        F.when(F.col("_n") <= recent, F.lit(previous))
        .when(F.abs(change) < noise, F.lit(previous))
        .when(change > 0, F.lit(min(high, previous + step)))
        .otherwise(F.lit(max(low, previous - step)))
    )
    return means.select(*series, F.col("_n").alias("interval_count"), F.round(change, 6).alias("delta_change"), F.round(alpha, 6).alias("alpha"))
