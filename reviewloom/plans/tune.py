"""Tuning job: interval statistics of the event log, trend of the text length, memory ratio."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.files import list_names, path_exists, remove_path
from reviewloom.operators.stats import dated_histogram, dated_statistics, inferred_statistics, outcomes_of_histograms, stale_statistics
from reviewloom.operators.tuning import trend_forecast, updated_ratio
from reviewloom.session import small_tasks, stage
from reviewloom.sources.event_log import EVENT_DATE, listed_dates, scan_dates


def tune(events: DataFrame, series: Sequence[str], interval: str, previous_ratio: float) -> DataFrame:
    """Both settings straight from the event log, which is read once: lengths and outcomes share a histogram."""
    by = [*series, interval]
    return tune_histograms(stage(dated_histogram(events, by), "tune-histogram"), series, interval, previous_ratio)


def tune_histograms(histograms: DataFrame, series: Sequence[str], interval: str, previous_ratio: float) -> DataFrame:
    """Both settings from written histograms, which may hold an interval in several parts."""
    by = [*series, interval]
    return tune_recorded(inferred_statistics(histograms, by), outcomes_of_histograms(histograms, by), series, interval, previous_ratio)


def refresh_histograms(
    spark: SparkSession, log: str, table: str, by: Sequence[str], prepare: Callable[[DataFrame], DataFrame] = lambda events: events
) -> list[str]:
    """Bring the recorded histograms below ``table`` up to date with a dated log, and name the dates that were read again.

    Beside the histograms of a date stand the file count, bytes and newest time that its folder had. A date whose folder looks different now is
    read again as a whole, and one that is gone is forgotten; the folders of all other dates stay closed. The listing is taken before
    the events, so what arrives in between is found by the next run, and a run that fails leaves its dates stale.

    Histograms are kept in a folder per month and the facts of all dates in one table, since a file per date would take longer than its few rows. The
    rows that other dates of a month have are copied when the month is written again; until that is done, the facts know none of its dates.
    """
    facts, histograms = f"{table}/dates", f"{table}/histograms"
    listed = stage(listed_dates(spark, log), "listed-dates")
    recorded = path_exists(spark, facts)
    known = stage(spark.read.schema(listed.schema).parquet(facts), "known-dates") if recorded else listed.limit(0)
    columns = [c for c in listed.columns if c != EVENT_DATE]
    both = listed.join(known.withColumnsRenamed({c: f"known_{c}" for c in columns}), EVENT_DATE, "full")
    same = F.lit(True)
    for c in columns:
        same = same & F.col(c).eqNullSafe(F.col(f"known_{c}"))
    # one row per date of the log
    differing = both.where(~same).select(EVENT_DATE, F.col("file_count").isNotNull().alias("there"), _month().alias(_MONTH)).collect()
    if not differing:
        return []
    stale = sorted(r[EVENT_DATE] for r in differing if r["there"])
    touched = sorted({r[_MONTH] for r in differing})
    parts = []
    if stale:
        parts.append(dated_histogram(prepare(scan_dates(spark, log, stale)), [EVENT_DATE, *by]).withColumn(_MONTH, _month()))
    folders = {m: f"{histograms}/{_MONTH}={m}" for m in touched}
    there = set(list_names(spark, histograms)) if recorded and path_exists(spark, histograms) else set()
    old = [folder for folder in folders.values() if folder.rsplit("/", 1)[1] in there]
    if old:
        months = spark.read.option("basePath", histograms).parquet(*old)
        parts.append(months.join(both.where(same).select(EVENT_DATE), EVENT_DATE, "left_semi"))
    filled = set()
    if parts:
        merged = stage(reduce(DataFrame.unionByName, parts), "dated-histograms")
        filled = {r[0] for r in merged.select(_MONTH).distinct().collect()}
    if recorded:
        known.where(~_month().isin(touched)).write.mode("overwrite").parquet(facts)
    else:
        remove_path(spark, histograms)
    if parts:
        with small_tasks(spark):
            written = merged.hint("rebalance", _MONTH).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            written.partitionBy(_MONTH).parquet(histograms)
    for month in touched:
        if month not in filled:
            remove_path(spark, folders[month])
    listed.write.mode("overwrite").parquet(facts)
    return stale


# Folder of the histograms of a month.
_MONTH = "event_month"


def _month() -> Column:
    """The month of a date's name, behind a letter, so that Spark takes the folder's name for nothing but text."""
    return F.concat(F.lit("m"), F.substring(EVENT_DATE, 1, 7))


def tune_refreshed(
    spark: SparkSession,
    log: str,
    table: str,
    series: Sequence[str],
    interval: str,
    previous_ratio: float,
    prepare: Callable[[DataFrame], DataFrame] = lambda events: events,
) -> DataFrame:
    """Both settings per series from recorded histograms, after those of stale dates have been made anew."""
    refresh_histograms(spark, log, table, [*series, interval], prepare)
    return tune_histograms(spark.read.parquet(f"{table}/histograms"), series, interval, previous_ratio)


def tune_recorded(
    statistics: DataFrame, outcomes: DataFrame, series: Sequence[str], interval: str, previous_ratio: float
) -> DataFrame:
    """Per series: the text length to allow next, and the memory ratio after the latest interval.

    ``statistics`` has ``p95_text_length`` per interval, ``outcomes`` the inferred and
    out-of-memory counts; recorded statistics need no second look at the log.
    """
    forecast = trend_forecast(statistics, series, interval, "p95_text_length")
    latest = outcomes.groupBy(*series).agg(
        F.max(F.struct(interval, "inferred_count", "oom_count")).alias("last")
    )
    ratio = updated_ratio(F.col("last.inferred_count"), F.col("last.oom_count"), previous_ratio)
    ratios = latest.select(
        *series, F.col(f"last.{interval}").alias("last_interval"), F.round(ratio, 6).alias("memory_usage_ratio")
    )
    texts = forecast.select(*series, "interval_count", F.col("forecast").alias("max_text_length"))
    # One row per series on both sides: put them side by side by an aggregate.
    both = texts.unionByName(ratios, allowMissingColumns=True)
    return both.groupBy(*series).agg(*[F.max(c).alias(c) for c in both.columns if c not in series])


def refresh_statistics(recorded: DataFrame, events: DataFrame, by: Sequence[str]) -> DataFrame:
    """Recorded interval statistics, with every interval that disagrees with the log computed anew.

    ``recorded`` carries ``event_count`` and ``last_timestamp`` next to the statistics. Intervals
    the log no longer has are left out.
    """
    stale = stale_statistics(recorded, events, by).select(*by)
    kept = recorded.join(stale, list(by), "left_anti")
    return kept.unionByName(dated_statistics(events.join(stale, list(by), "left_semi"), by))
