"""Ingest job: landed pages to one flat, deduplicated table per source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.functions.json import embedded_prefixes, fold_index, get_key, has_leaf, target_keys
from reviewloom.operators.dedupe import keep_first, keep_last
from reviewloom.operators.pages import fingerprint_pages, pages_before_stop, term_windows
from reviewloom.session import stage
from reviewloom.sources.declared import Source

POSITION = ("term", "page", "position")

# What the stop rule wants to know of a page, carried by each of its rows.
PAGE_FACTS = ("record_count", "fingerprint")

# Folded names of the wanted keys that a record lacks.
ABSENT = "_absent"


def flat_pages(pages: DataFrame, source: Source, absent: bool = False) -> DataFrame:
    """The records of all landed pages with their position, the facts of their page, and the wanted keys as text columns.

    Every payload is parsed once. A page without records is one row without a position. ``absent`` adds the keys that each record lacks.
    """
    listed = fingerprint_pages(pages, "payload", source.record_path, source.pk, "_records")
    found = listed.select("term", "page", *PAGE_FACTS, F.posexplode_outer("_records").alias("position", "record"))
    key_map = source.key_map()
    inside, keep = embedded_prefixes(key_map, source.embedded_keys), [*POSITION, *PAGE_FACTS]
    if absent:
        names = [F.when(~has_leaf(get_key(F.col("record"), k, inside), k), fold_index(F.lit(k))) for k in key_map]
        found, keep = found.withColumn(ABSENT, F.array_distinct(F.array_compact(F.array(*names)))), [*keep, ABSENT]
    return target_keys(found, "record", key_map, keep=keep, embedded_in=inside)


def rows_before_stop(flat: DataFrame) -> DataFrame:
    """Rows of the pages that a term really has; ``flat`` is a written table of :func:`flat_pages` rows, over any number of runs."""
    one_per_page = flat.where("position IS NULL OR position = 0")
    return pages_before_stop(flat, one_per_page).where("position IS NOT NULL").drop(*PAGE_FACTS)


def one_per_key(rows: DataFrame, source: Source, last_wins: bool | None = None) -> DataFrame:
    """The row of each key that wins over (term, page, position): the last or the first one, as the source declares."""
    wins = source.last_wins if last_wins is None else last_wins
    return (keep_last if wins else keep_first)(rows, source.pk_column(), POSITION).drop(*POSITION)


def ingest(pages: DataFrame, source: Source, last_wins: bool | None = None, apply_stop: bool = True) -> DataFrame:
    """One row per key. The flat rows are written once, and both the stops and the rows come from them."""
    if not apply_stop:
        return one_per_key(flat_pages(pages, source).where("position IS NOT NULL").drop(*PAGE_FACTS), source, last_wins)
    return one_per_key(rows_before_stop(stage(flat_pages(pages, source), "flat-pages")), source, last_wins)


def ingest_with_report(pages: DataFrame, source: Source) -> tuple[DataFrame, DataFrame]:
    """The rows of :func:`ingest`, and missing_key, records_without of the keys that at least one of the records used lacks.

    A folded name counts the records that lack any of its keys.
    """
    rows = rows_before_stop(stage(flat_pages(pages, source, absent=True), "flat-pages"))
    report = rows.select(F.explode(ABSENT).alias("missing_key")).groupBy("missing_key").agg(F.count(F.lit(1)).alias("records_without"))
    return one_per_key(rows.drop(ABSENT), source), report


def missing_key_report(pages: DataFrame, source: Source) -> DataFrame:
    return ingest_with_report(pages, source)[1]


def source_terms(spark: SparkSession, source: Source, start: str, end: str) -> DataFrame:
    """term, term_start, term_end: the windows in which a period of the source has to be asked for."""
    period = spark.range(1).select(
        F.lit(start).cast("timestamp_ntz").alias("start"), F.lit(end).cast("timestamp_ntz").alias("end"), F.lit(source.term_limit_ms).cast("bigint").alias("limit")
    )
    return term_windows(period, "start", "end", "limit").select("term", "term_start", "term_end")


def only(rows: DataFrame, source: Source, products: Sequence[str] | None = None, groups: Sequence[str] | None = None) -> DataFrame:
    """Rows of some products, or of some review groups; the source answers to one of the two filters only."""
    if products is not None and groups is not None:
        raise ValueError("filter by products or by groups, not by both")
    if products is None and groups is None:
        return rows
    name, wanted = ("PRODUCT_REMOTE_ID", products) if products is not None else ("REVIEW_GROUP_ID", groups)
    return rows.where(F.col(f"`{source.dataset[name]}`").isin(list(wanted)))
