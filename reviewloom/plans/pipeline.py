"""The four stages of one source, each from tables to a table below the period folder."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.plans.finalize import export_chunks, with_outcome
from reviewloom.plans.ingest import ingest_with_report, source_terms
from reviewloom.plans.postprocess import Labeller, postprocess_with_report
from reviewloom.plans.preprocess import preprocess
from reviewloom.session import staging
from reviewloom.sources.dataset import Dataset
from reviewloom.sources.declared import EXPORT_LAYOUT, OPTION_MAP, Source
from reviewloom.sources.pages import read_pages
from reviewloom.sources.sinks import period_path, read_chunks, read_current, save, write_chunks, write_outcomes
from reviewloom.sources.tables import load


@dataclass(frozen=True)
class Workspace:
    """Where the tables of one source and period are."""

    root: str
    start: str
    end: str

    def table(self, name: str) -> str:
        return f"{period_path(self.root, self.start, self.end)}/{name}"


def run_ingest(spark: SparkSession, space: Workspace, source: Source, landing: str, name: str = "reviews") -> None:
    """Landed pages to the source table; rows already there win.

    Beside it go the terms of the period with the pages that landed of each, and the report of missing keys.
    """
    with staging(spark):
        pages = read_pages(spark, landing)
        landed = pages.groupBy("term").agg(F.countDistinct("page").alias("landed_pages"))
        terms = source_terms(spark, source, space.start, space.end).join(landed, "term", "left")
        terms.withColumn("landed_pages", F.coalesce("landed_pages", F.lit(0).cast("bigint"))).write.mode("overwrite").parquet(space.table(f"{name}_terms"))
        rows, missing = ingest_with_report(pages, source)
        missing.write.mode("overwrite").parquet(space.table(f"{name}_missing_keys"))
        _save(rows, space.table(name), source.pk_column())


def run_preprocess(
    spark: SparkSession,
    space: Workspace,
    source: Source,
    id_map: str,
    id_map_spec: Dataset,
    option_map: str,
    orders_source: Source | None = None,
) -> None:
    """Source tables and mappings to the export table. The mappings must exist."""
    orders = read_current(spark, space.table("orders")) if orders_source else None
    with staging(spark):
        rows = preprocess(
            source,
            _current(spark, space.table("reviews")),
            load(spark, id_map, id_map_spec, required=True),
            load(spark, option_map, OPTION_MAP, required=True),
            id_map_spec,
            OPTION_MAP,
            orders=orders,
            orders_spec=orders_source.dataset if orders is not None else None,
        )
        _save(rows, space.table("preprocessed"), EXPORT_LAYOUT["REVIEW_ID"])


def run_postprocess(spark: SparkSession, space: Workspace, option_map: str, labeller: Labeller) -> None:
    """The export table to positive reviews under hashed ids, beside the ids that occur twice and the row counts of the steps."""
    options = load(spark, option_map, OPTION_MAP, required=True)
    with staging(spark):
        done = postprocess_with_report(_current(spark, space.table("preprocessed")), options, OPTION_MAP, labeller)
        done.duplicates.write.mode("overwrite").parquet(space.table("postprocessed_duplicates"))
        steps = spark.createDataFrame(list(done.steps.items()), "step string, row_count bigint")
        steps.write.mode("overwrite").parquet(space.table("postprocessed_steps"))
        _save(done.rows, space.table("postprocessed"), EXPORT_LAYOUT["REVIEW_ID"])


def run_chunks(spark: SparkSession, space: Workspace, size: int, prefix: str = "upload") -> DataFrame:
    """Write the chunk files to upload and return their rows."""
    rows = _current(spark, space.table("postprocessed"))
    with staging(spark):
        write_chunks(export_chunks(rows, EXPORT_LAYOUT["PRODUCT_ID"], size=size), space.table("chunks"), prefix)
    return read_chunks(spark, space.table("chunks"))


def run_finalize(spark: SparkSession, space: Workspace, outcomes: DataFrame) -> None:
    """Split the uploaded chunks by their ``(chunk, succeeded)`` outcome."""
    numbered = read_chunks(spark, space.table("chunks")).drop("row_number", "chunk_count")
    with staging(spark):
        write_outcomes(
            with_outcome(numbered, outcomes).drop("chunk"), space.table("success"), space.table("failed"), EXPORT_LAYOUT["REVIEW_ID"]
        )


def _save(rows: DataFrame, path: str, key: str) -> None:
    """Upsert; rows already there win. Rows that could not be saved are an error, for the next stage would miss them."""
    if not save(rows, path, key, overwrite=False) and not rows.isEmpty():
        raise ValueError(f"nothing was saved at {path}: no column {key}")


def _current(spark: SparkSession, path: str) -> DataFrame:
    table = read_current(spark, path)
    if table is None:
        raise FileNotFoundError(f"nothing at {path}")
    return table
