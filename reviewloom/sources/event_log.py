"""Append-only JSON event log: one typed struct keyed by ``event_type``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom.files import list_names
from reviewloom.session import few_listings, small_tasks

_SUMMARY = T.StructType(
    [
        T.StructField("batch_size", T.LongType()),
        T.StructField("max_token_count_per_batch", T.LongType()),
        T.StructField("total_token_count_per_batch", T.LongType()),
    ]
)

# Union of the event types; fields of other types are null.
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_type", T.StringType()),
        T.StructField("event_id", T.LongType()),
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField(
            "batch_snapshot",
            T.StructType(
                [
                    T.StructField("batch_snapshot_summary", _SUMMARY),
                    T.StructField(
                        "text_token_length_mappings",
                        T.ArrayType(
                            T.StructType(
                                [T.StructField("text_length", T.LongType()), T.StructField("token_length", T.LongType())]
                            )
                        ),
                    ),
                ]
            ),
        ),
        T.StructField("positive_text_count", T.LongType()),
        T.StructField("negative_text_count", T.LongType()),
        T.StructField("device", T.StringType()),
        T.StructField("elapsed_ms", T.DoubleType()),
        T.StructField("original_batch_snapshot_summary", _SUMMARY),
        T.StructField("fallback_batch_snapshot_summaries", T.ArrayType(_SUMMARY)),
        T.StructField("exception_type", T.StringType()),
        T.StructField("error_message", T.StringType()),
    ]
)

# The event types.
INFERRED = "inferred"
OOM_FALLBACK = "oom_fallback"
INFERRED_FAILED = "inferred_failed"

_TORN = "_torn_line"


def _with_torn(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(_TORN, T.StringType())])


# Spark's name of the folder for null partition values.
_NO_DATE = "__HIVE_DEFAULT_PARTITION__"

# Partition column of logs written here; scans of a time range read its folders only.
EVENT_DATE = "event_date"


def scan_events(
    spark: SparkSession, path: str, start: str | None = None, end: str | None = None, schema: T.StructType = EVENT_SCHEMA, strict: bool = True
) -> DataFrame:
    """Events with ``start <= timestamp < end``. Blank lines are skipped.

    Torn lines, which are no JSON, go. A line that is JSON but no event of the schema is an error, unless ``strict`` is off;
    :func:`rejected_lines` lists both kinds.
    """
    return _between(_events(spark.read.text(path), schema, strict), start, end).drop(EVENT_DATE)


def _date_name() -> Column:
    """The date a folder of the log is named after, as text."""
    return F.coalesce(F.col(EVENT_DATE).cast("string"), F.lit(_NO_DATE))


def listed_dates(spark: SparkSession, path: str) -> DataFrame:
    """event_date (as its folder is named), file_count, byte_count, newest: what the files of each date look like from outside.

    Only the listing is read. A log that grew, shrank or was written anew looks different.
    """
    with few_listings(spark):
        found = spark.read.format("binaryFile").load(path)
    files = found.select(_date_name().alias(EVENT_DATE), "length", "modificationTime")
    return files.groupBy(EVENT_DATE).agg(
        F.count(F.lit(1)).alias("file_count"), F.sum("length").alias("byte_count"), F.max("modificationTime").alias("newest")
    )


def scan_dates(spark: SparkSession, path: str, dates: Sequence[str], schema: T.StructType = EVENT_SCHEMA) -> DataFrame:
    """Events of the folders of some dates, with the folder's name in ``event_date``. Other folders are not opened."""
    # as one text: as many literals, handed over one by one, take longer than the listing
    quoted = ", ".join("'" + d.replace("\\", "\\\\").replace("'", "\\'") + "'" for d in dates)
    with few_listings(spark):
        lines = spark.read.text(path)
    named = lines.withColumn(EVENT_DATE, _date_name())
    return _events(named.where(f"{EVENT_DATE} IN ({quoted})" if dates else "false"), schema)


def rejected_lines(spark: SparkSession, path: str, schema: T.StructType = EVENT_SCHEMA) -> DataFrame:
    """file, line, reason of the lines that are no events: ``torn``, ``misfit`` (a value of another type) or ``untyped``."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"))
    parsed = lines.where(F.trim("line") != "").withColumn("e", _parsed(F.col("line"), schema))
    reason = F.when(_torn(F.col("e")), "torn").when(_misfit(F.col("e")), F.when(F.col("e")[_TORN].isNotNull(), "misfit").otherwise("untyped"))
    return parsed.select("file", "line", reason.alias("reason")).where(F.col("reason").isNotNull())


def _parsed(line: Column, schema: T.StructType) -> Column:
    # whole lines are parsed whatever columns are wanted later, so that the same lines are always rejected
    return F.from_json(line, _with_torn(schema), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _TORN})


def _torn(event: Column) -> Column:
    return event[_TORN].isNotNull() & F.try_parse_json(event[_TORN]).isNull()


def _misfit(event: Column) -> Column:
    return F.when(event[_TORN].isNull(), event["event_type"].isNull()).otherwise(F.try_parse_json(event[_TORN]).isNotNull())


def _events(lines: DataFrame, schema: T.StructType, strict: bool = True) -> DataFrame:
    """Events of the text ``lines``. A line is parsed once: as an array of one event or none, which is then exploded."""
    error = F.raise_error(F.concat(F.lit("no event of the log's schema: "), F.col("value"))).cast("boolean")

    def whole(event: Column) -> Column:
        fits = event[_TORN].isNull() & event["event_type"].isNotNull()
        return F.when(_misfit(event), error).otherwise(fits) if strict else fits

    dated = [EVENT_DATE] if EVENT_DATE in lines.columns else []
    event = F.filter(F.array(_parsed(F.col("value"), schema)), whole)
    return lines.where(F.trim("value") != "").select(*dated, F.explode(event).alias("e")).select("e.*", *dated).drop(_TORN)


def stream_events(spark: SparkSession, path: str, schema: T.StructType = EVENT_SCHEMA, **options) -> DataFrame:
    """The same log as a stream of files."""
    return _events(spark.readStream.options(**options).text(path), schema).drop(EVENT_DATE)


def _between(events: DataFrame, start: str | None, end: str | None) -> DataFrame:
    dated = EVENT_DATE in events.columns
    if start is not None:
        first = F.lit(start).cast("timestamp_ntz")
        events = events.where(F.col("timestamp") >= first)
        if dated:
            events = events.where(F.col(EVENT_DATE) >= F.to_date(first))
    if end is not None:
        last = F.lit(end).cast("timestamp_ntz")
        events = events.where(F.col("timestamp") < last)
        if dated:
            events = events.where(F.col(EVENT_DATE) <= F.to_date(last))
    return events


def tail(events: DataFrame, n: int, newest_first: bool = True) -> DataFrame:
    """The last ``n`` events; a top-n per task, then one merge of ``n`` rows."""
    last = events.orderBy(F.col("timestamp").desc(), F.col("event_id").desc()).limit(n)
    return last if newest_first else last.orderBy("timestamp", "event_id")


def tail_of_log(spark: SparkSession, path: str, n: int, newest_first: bool = True) -> DataFrame:
    """The last ``n`` events of a dated log, from its newest folders only.

    The number of folders looked at doubles until they hold ``n`` events. The files of other folders are not listed.
    """
    folders = [f.split("=", 1)[1] for f in list_names(spark, path) if f.startswith(f"{EVENT_DATE}=")]
    dates = sorted((f for f in folders if f != _NO_DATE), reverse=True)
    taken = 1
    while taken < len(dates):
        newest = spark.read.option("basePath", path).text([f"{path}/{EVENT_DATE}={d}" for d in dates[:taken]])
        recent = _between(_events(newest, EVENT_SCHEMA), dates[taken - 1], None).drop(EVENT_DATE)
        if recent.limit(n).count() == n:
            return tail(recent, n, newest_first)
        taken *= 2
    return tail(scan_events(spark, path), n, newest_first)


def append_events(events: DataFrame, path: str) -> None:
    """Add events below their date.

    Rebalancing gathers a date's events into files of a good size, and splits a date that holds
    most of them.
    """
    dated = events.withColumn(EVENT_DATE, F.to_date("timestamp")).hint("rebalance", EVENT_DATE)
    with small_tasks(events.sparkSession):
        dated.write.mode("append").partitionBy(EVENT_DATE).json(path)


def clear_events(spark: SparkSession, path: str, schema: T.StructType = EVENT_SCHEMA) -> None:
    spark.createDataFrame([], schema).write.mode("overwrite").json(path)
