"""Statistics over the inference event log."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from reviewloom.sources.event_log import INFERRED, OOM_FALLBACK

_LENGTHS = "batch_snapshot.text_token_length_mappings"
_BATCH_SIZE = "batch_snapshot.batch_snapshot_summary.batch_size"


def length_summary(rows: DataFrame, by: Sequence[str], lengths: Mapping[str, Column]) -> DataFrame:
    """Per group and named length: ``count_<name>``, ``total_<name>`` and the exact ``p95_<name>``.

    The 95th percentile interpolates linearly and is truncated to an integer. Lengths have few
    distinct values, so the rows shrink to a histogram before the shuffle; the window then runs
    over one row per distinct length, not over the rows of a group.
    """
    entries = F.array(*[_entry(name, length, F.lit(1)) for name, length in lengths.items()])
    return _summaries(rows.select(*by, F.explode(entries).alias("_e")), by, list(lengths))


def _entry(name: str, length: Column, weight: Column) -> Column:
    return F.struct(
        F.lit(name).alias("name"), length.cast("bigint").alias("length"), weight.cast("bigint").alias("weight")
    )


def _summaries(entries: DataFrame, by: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Count, total and percentile per group and name of weighted entries ``_e(name, length, weight)``."""
    return _from_histogram(_histogram(entries, by), by, names)


def _histogram(entries: DataFrame, by: Sequence[str], latest: Mapping[str, str] | None = None) -> DataFrame:
    """Weight per group, name and length. ``latest`` carries the maximum of further columns along: output name to column."""
    return (
        entries.where("_e.length IS NOT NULL")
        .groupBy(*by, F.col("_e.name").alias("name"), F.col("_e.length").alias("length"))
        .agg(F.sum("_e.weight").alias("n"), *[F.max(c).alias(o) for o, c in (latest or {}).items()])
    )


def _from_histogram(histogram: DataFrame, by: Sequence[str], names: Sequence[str], latest: Sequence[str] = ()) -> DataFrame:
    """Count, total and percentile per group and name, and the maxima in the columns ``latest``."""
    whole = Window.partitionBy(*by, "name")
    ranked = histogram.select(
        "*",
        F.sum("n").over(whole.orderBy("length").rowsBetween(Window.unboundedPreceding, 0)).alias("_upto"),
        F.sum("n").over(whole).alias("_total"),
    )
    place = 0.95 * (F.col("_total") - 1)
    below = F.floor(place)
    above = F.least(below + 1, F.col("_total") - 1)
    found = ranked.groupBy(*by, "name", "_total").agg(
        F.min(F.when(F.col("_upto") > below, F.col("length"))).alias("_low"),
        F.min(F.when(F.col("_upto") > above, F.col("length"))).alias("_high"),
        F.sum(F.col("length") * F.col("n")).alias("_sum"),
        *[F.max(o).alias(o) for o in latest],
    )
    share = place - below
    span = F.col("_high") - F.col("_low")
    # Measured from the nearer end, as numpy does it, so that truncation falls on the same side.
    p95 = F.floor(F.when(share >= 0.5, F.col("_high") - span * (1 - share)).otherwise(F.col("_low") + span * share))
    wide = []
    for n in names:
        mine = F.col("name") == n
        wide += [
            F.coalesce(F.max(F.when(mine, F.col("_total"))), F.lit(0)).alias(f"count_{n}"),
            F.coalesce(F.max(F.when(mine, F.col("_sum"))), F.lit(0)).alias(f"total_{n}"),
            F.coalesce(F.max(F.when(mine, F.col("_p95"))), F.lit(0)).alias(f"p95_{n}"),
        ]
    return found.withColumn("_p95", p95).groupBy(*by).agg(*wide, *[F.max(o).alias(o) for o in latest])


def events_by_type(events: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return events.groupBy(*by, "event_type").agg(F.count(F.lit(1)).alias("event_count"))


def batch_summary(rows: DataFrame, batch: str, tokens: str) -> DataFrame:
    """Size, largest and total token count per batch."""
    return rows.groupBy(batch).agg(
        F.count(tokens).alias("batch_size"),
        F.coalesce(F.max(tokens), F.lit(0)).alias("max_token_count_per_batch"),
        F.coalesce(F.sum(tokens), F.lit(0)).alias("total_token_count_per_batch"),
    )


def label_counts(rows: DataFrame, batch: str, label: str) -> DataFrame:
    return rows.groupBy(batch).agg(
        F.count_if(F.col(label) == 1).alias("positive_text_count"),
        F.count_if(F.col(label) == 0).alias("negative_text_count"),
    )


def inconsistent_batches(events: DataFrame) -> DataFrame:
    """Inferred events whose stored batch size is not the length of their array."""
    held = F.coalesce(F.size(_LENGTHS), F.lit(0))
    stored = F.coalesce(F.col(_BATCH_SIZE), F.lit(0))
    return events.where((F.col("event_type") == INFERRED) & (stored != held)).select(
        "event_id", stored.alias("stored_size"), held.alias("held_size")
    )


def interval_statistics(events: DataFrame, by: Sequence[str], **applied) -> DataFrame:
    """One row of statistics per interval over its inferred batches; the log is read once.

    Batch counts travel through the same histogram as the lengths, as entries with a weight. A
    batch whose stored size differs from its array is an error. ``applied`` adds the settings in
    force as constant columns.
    """
    inferred = events.where(F.col("event_type") == INFERRED)
    rows = _summaries(inferred.select(*by, F.explode(_batch_entries()).alias("_e")), by, _STATISTICS)
    return rows.select(*by, *_statistics(), *[F.lit(v).alias(k) for k, v in applied.items()])


def dated_statistics(events: DataFrame, by: Sequence[str]) -> DataFrame:
    """Interval statistics with the count and last timestamp of all events of the interval."""
    return statistics_of_histograms(dated_histogram(events, by), by)


def dated_histogram(events: DataFrame, by: Sequence[str]) -> DataFrame:
    """What the statistics and outcomes of events come from, in a form that can be merged: by, name, length, n, last_timestamp."""
    own = F.when(F.col("event_type") == INFERRED, _batch_entries()).otherwise(F.array().cast(_ENTRY_TYPE))
    outcomes = [_entry(name, F.lit(0), (F.col("event_type") == kind).cast("bigint")) for name, kind in _OUTCOMES.items()]
    entries = F.concat(own, F.array(_entry("event", F.lit(0), F.lit(1)), *outcomes))
    return _histogram(events.select(*by, "timestamp", F.explode(entries).alias("_e")), by, {"last_timestamp": "timestamp"})


def statistics_of_histograms(histograms: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row of dated statistics per interval, however many histograms hold a part of it."""
    merged = histograms.groupBy(*by, "name", "length").agg(F.sum("n").alias("n"), F.max("last_timestamp").alias("last_timestamp"))
    rows = _from_histogram(merged, by, [*_STATISTICS, "event"], ["last_timestamp"])
    return rows.select(*by, F.col("count_event").alias("event_count"), "last_timestamp", *_statistics())


def inferred_statistics(histograms: DataFrame, by: Sequence[str]) -> DataFrame:
    """What :func:`interval_statistics` gives, from histograms: a row per interval that has an inferred batch."""
    merged = histograms.where(F.col("name").isin(*_STATISTICS)).groupBy(*by, "name", "length").agg(F.sum("n").alias("n"))
    return _from_histogram(merged, by, _STATISTICS).select(*by, *_statistics())


def outcomes_of_histograms(histograms: DataFrame, by: Sequence[str]) -> DataFrame:
    """What :func:`outcome_counts` gives, from histograms."""
    count = lambda name: F.coalesce(F.sum(F.when(F.col("name") == name, F.col("n"))), F.lit(0))
    return histograms.where(F.col("name").isin(*_OUTCOMES)).groupBy(*by).agg(*[count(name).alias(f"{name}_count") for name in _OUTCOMES])


_STATISTICS = ("text_length", "token_length", "batch", "positive", "negative")
_OUTCOMES = {"inferred": INFERRED, "oom": OOM_FALLBACK}
_ENTRY_TYPE = "array<struct<name:string,length:bigint,weight:bigint>>"


def _batch_entries() -> Column:
    """All a batch contributes: its lengths one by one, and its counts as weights."""
    held, stored = F.coalesce(F.size(_LENGTHS), F.lit(0)), F.coalesce(F.col(_BATCH_SIZE), F.lit(0))
    checked = F.when(
        stored != held,
        F.raise_error(F.concat(F.lit("batch size differs from its array: event "), F.col("event_id").cast("string"))).cast("bigint"),
    ).otherwise(stored)
    lengths = F.coalesce(F.col(_LENGTHS), F.array().cast("array<struct<text_length:bigint,token_length:bigint>>"))
    return F.concat(
        F.transform(lengths, lambda e: _entry("text_length", e["text_length"], F.lit(1))),
        F.transform(lengths, lambda e: _entry("token_length", e["token_length"], F.lit(1))),
        F.array(
            _entry("batch", F.lit(0), checked),
            _entry("positive", F.lit(0), F.coalesce("positive_text_count", F.lit(0))),
            _entry("negative", F.lit(0), F.coalesce("negative_text_count", F.lit(0))),
        ),
    ).cast(_ENTRY_TYPE)


def _statistics() -> list[Column]:
    return [
        F.col("count_batch").alias("inferred_total_text_count"),
        F.col("count_positive").alias("positive_text_count"),
        F.col("count_negative").alias("negative_text_count"),
        ratio_or_zero("total_text_length", "count_batch").alias("avg_text_length"),
        F.col("p95_text_length"),
        ratio_or_zero("total_token_length", "count_batch").alias("avg_token_length"),
        F.col("p95_token_length"),
        ratio_or_zero("total_token_length", "total_text_length").alias("token_to_text_ratio"),
    ]


def ratio_or_zero(numerator: str, denominator: str) -> Column:
    n, d = F.col(numerator).cast("double"), F.col(denominator).cast("double")
    return F.when(d > 0, n / d).otherwise(F.lit(0.0))


def outcome_counts(events: DataFrame, by: Sequence[str]) -> DataFrame:
    """Inferred and out-of-memory events per interval."""
    return events.groupBy(*by).agg(
        F.count_if(F.col("event_type") == INFERRED).alias("inferred_count"),
        F.count_if(F.col("event_type") == OOM_FALLBACK).alias("oom_count"),
    )


def stale_statistics(recorded: DataFrame, events: DataFrame, by: Sequence[str]) -> DataFrame:
    """Intervals whose recorded event count or last timestamp no longer match the log.

    ``recorded`` has ``event_count`` and ``last_timestamp`` per interval. What comes back has to
    be recomputed from the whole log of that interval.
    """
    current = events.groupBy(*by).agg(
        F.count(F.lit(1)).alias("log_event_count"), F.max("timestamp").alias("log_last_timestamp")
    )
    joined = current.join(recorded, list(by), "full")
    same = F.col("event_count").eqNullSafe(F.col("log_event_count")) & F.col("last_timestamp").eqNullSafe(
        F.col("log_last_timestamp")
    )
    return joined.where(~same).select(*by, "event_count", "log_event_count", "last_timestamp", "log_last_timestamp")


def audited(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count the rows that pass here while the action runs; no extra pass."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("row_count")), seen
