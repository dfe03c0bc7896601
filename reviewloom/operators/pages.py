"""Page operators: fingerprints, the stop rule of paged sources, term windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.functions.ids import page_fingerprint
from reviewloom.functions.json import records_array, variant_path
from reviewloom.session import stage
from reviewloom.sources.declared import DAY_MS

# Fixed value: share of a source's term limit that is used.
SAFE_TERM_RATIO = 0.8


def fingerprint_pages(pages: DataFrame, payload: str, record_path: Sequence[str], pk: str, records: str | None = None) -> DataFrame:
    """Record count and fingerprint per landed page. A page is one row, so nothing is shuffled.

    A payload is parsed once; ``records`` names a column for what was found in it.
    """
    listed = pages.withColumn("_records", records_array(F.col(payload), record_path))
    ids = F.transform(
        F.coalesce("_records", F.array().cast("array<variant>")),
        lambda record: F.try_variant_get(record, variant_path(pk), "string"),
    )
    marked = listed.withColumn("_ids", ids).withColumns({"record_count": F.size("_ids"), "fingerprint": page_fingerprint(F.col("_ids"))}).drop("_ids")
    return marked.withColumnRenamed("_records", records) if records else marked.drop("_records")


def pages_before_stop(pages: DataFrame, facts: DataFrame | None = None) -> DataFrame:
    """Pages of each term before its first empty or repeated page.

    ``pages`` has ``term, page, record_count, fingerprint``. A page is repeated when an earlier
    page of the term has its fingerprint, i.e. when it is not the first of its fingerprint. All
    shuffles carry page numbers only, and their keys are single pages or combined aggregates, so
    a last page that a source repeats forever stays harmless. The stops are staged: with their
    real size known, the planner broadcasts them when they are small, and payloads stay put.
    ``facts`` has the four columns once per page where ``pages`` has several rows of one.
    """
    facts = (pages if facts is None else facts).select("term", "page", "record_count", "fingerprint")
    firsts = (
        facts.where("record_count > 0").groupBy("term", "fingerprint").agg(F.min("page").alias("page")).select("term", "page")
    )
    stops = facts.join(firsts, ["term", "page"], "left_anti").groupBy("term").agg(F.min("page").alias("stop_page"))
    stops = stage(stops, "page-stops")
    kept = pages.join(stops, "term", "left").where(F.col("stop_page").isNull() | (F.col("page") < F.col("stop_page")))
    return kept.drop("stop_page")


def safe_term_ms(limit_ms: Column) -> Column:
    """Term limit with a margin, one day at least; null means no limit."""
    return F.when(
        limit_ms.isNotNull(), F.greatest(F.lit(DAY_MS), F.floor(limit_ms * SAFE_TERM_RATIO).cast("bigint"))
    )


def term_windows(ranges: DataFrame, start: str, end: str, limit_ms: str) -> DataFrame:
    """Cut each range into equal terms ``[term_start, term_end)``; the last one is shorter.

    A range without a limit, or no longer than it, stays one term.
    """
    safe = safe_term_ms(F.col(limit_ms))
    span_ms = F.timestamp_diff("MILLISECOND", F.col(start), F.col(end))
    step = F.when(safe.isNull() | (span_ms <= safe), F.lit(None).cast("bigint")).otherwise(safe)
    count = F.when(step.isNull(), F.lit(1).cast("bigint")).otherwise(F.ceil(span_ms / step))
    numbered = ranges.withColumns({"_step": step, "_n": count}).where(F.col("_n") > 0)
    terms = numbered.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_n") - 1)).alias("term"))
    offset = F.expr(f"timestampadd(MILLISECOND, term * _step, {start})")
    next_offset = F.expr(f"timestampadd(MILLISECOND, (term + 1) * _step, {start})")
    return terms.withColumns(
        {
            "term_start": F.coalesce(offset, F.col(start)),
            "term_end": F.coalesce(F.least(next_offset, F.col(end)), F.col(end)),
        }
    ).drop("_step", "_n")
