"""Postprocess job: product names from the option table, hashed review ids, positive reviews only."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from reviewloom.functions.ids import MAX_HASHED_ID_LENGTH, hashed_review_id
from reviewloom.functions.time import parse_time_of_day, parse_timestamp
from reviewloom.operators.dedupe import duplicate_keys
from reviewloom.operators.filters import drop_blank, normalise_ids
from reviewloom.operators.joins import remap_options
from reviewloom.operators.labels import WordModel, classify, positive_only
from reviewloom.operators.stats import audited
from reviewloom.session import stage
from reviewloom.sources.dataset import Dataset, indexed_name, require_columns
from reviewloom.sources.declared import EXPORT_LAYOUT

LABEL = "_label"

# (table, review id column, contents column) -> table with a LABEL column.
Labeller = Callable[[DataFrame, str, str], DataFrame]


HASHED = "_hashed_id"


def readable_rows(df: DataFrame, review_id: str, date: str, time: str, length: int = MAX_HASHED_ID_LENGTH) -> DataFrame:
    """Rows whose id, date and time can be read, with the id hashed from them beside the original one."""
    require_columns(df, [review_id, date, time])
    kinds = {f.name: f.dataType for f in df.schema.fields}
    parsed_date = parse_timestamp(F.col(f"`{date}`"), kinds[date])
    parsed_time = (
        parse_time_of_day(F.col(f"`{time}`"))
        if kinds[time].simpleString() == "string"
        else parse_timestamp(F.col(f"`{time}`"), kinds[time])
    )
    valid = drop_blank(df, [review_id, date, time]).where(parsed_date.isNotNull() & parsed_time.isNotNull())
    return valid.withColumn(HASHED, hashed_review_id(F.col(f"`{review_id}`"), parsed_date, parsed_time, length))


def _with_hashed(df: DataFrame, review_id: str, columns: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(HASHED if c == review_id else f"`{c}`").alias(c) for c in columns])


def hash_ids(df: DataFrame, review_id: str, date: str, time: str, length: int = MAX_HASHED_ID_LENGTH) -> DataFrame:
    """Replace ids by timestamp and hash digits; rows whose id, date or time cannot be read go."""
    return _with_hashed(readable_rows(df, review_id, date, time, length), review_id, df.columns)


def given_labels(labels: DataFrame, key: str, label: str = "label") -> Labeller:
    """Labels from a table, by review id as it is before hashing. An id may repeat its label; different ones are an error."""

    def attach(df: DataFrame, review_id: str, contents: str) -> DataFrame:
        ids = labels.groupBy(F.col(key).cast("string").alias(review_id)).agg(F.min(label).alias("_low"), F.max(label).alias("_high"))
        error = F.raise_error(F.concat(F.lit("labels differ for id "), F.col(f"`{review_id}`")))
        one = F.when(F.col("_low") != F.col("_high"), error.cast(ids.schema["_low"].dataType)).otherwise(F.col("_low"))
        table = ids.select(f"`{review_id}`", one.alias(LABEL))
        return df.join(table, review_id, "left")

    return attach


def predicted_labels(model: WordModel) -> Labeller:
    """Labels from a classifier, by the text of each row."""

    def attach(df: DataFrame, review_id: str, contents: str) -> DataFrame:
        text = "_classified"
        return classify(df.withColumn(text, F.col(f"`{contents}`")), replace(model, text=text), LABEL).drop(text)

    return attach


@dataclass(frozen=True)
class Postprocessed:
    """The job's rows, the hashed ids that several rows got, and the row counts of its steps as they were seen on the way."""

    rows: DataFrame
    duplicates: DataFrame
    steps: dict[str, int]

    @property
    def removed(self) -> int:
        """Rows whose id, date or time could not be read."""
        return self.steps["remapped"] - self.steps["readable"]


def _hashed_rows(df: DataFrame, options: DataFrame, options_spec: Dataset, layout: Dataset, length: int) -> tuple[DataFrame, dict[str, Observation]]:
    name = layout.columns
    product_id = options_spec["EXPORT_PLATFORM_PRODUCT_ID"]
    columns = {
        product_id: name["PRODUCT_ID"],
        options_spec["PRODUCT_NAME"]: indexed_name(name["PRODUCT_OPTION_NAME"], 1),
        options_spec["PRODUCT_OPTION_NAME"]: indexed_name(name["PRODUCT_OPTION_VALUE"], 1),
    }
    seen: dict[str, Observation] = {}
    remapped = remap_options(df, normalise_ids(options, [product_id]), columns, product_id)
    remapped, seen["remapped"] = audited(drop_blank(remapped, [name["REVIEW_CONTENTS"]]), "remapped")
    hashed = readable_rows(remapped, name["REVIEW_ID"], name["REVIEW_CREATED_DATE"], name["REVIEW_CREATED_TIME"], length)
    hashed, seen["readable"] = audited(hashed, "readable")
    return hashed, seen


def _positive(hashed: DataFrame, labeller: Labeller, layout: Dataset, columns: Sequence[str]) -> DataFrame:
    """Positive rows under their hashed ids. Labels belong to the original ids, and unreadable rows need none."""
    review_id, contents = layout.columns["REVIEW_ID"], layout.columns["REVIEW_CONTENTS"]
    return _with_hashed(positive_only(labeller(hashed, review_id, contents), LABEL), review_id, columns)


def postprocess(
    df: DataFrame,
    options: DataFrame,
    options_spec: Dataset,
    labeller: Labeller,
    layout: Dataset = EXPORT_LAYOUT,
    hashed_length: int = MAX_HASHED_ID_LENGTH,
) -> DataFrame:
    """Remap options, hash ids, keep positive reviews."""
    hashed, _ = _hashed_rows(df, options, options_spec, layout, hashed_length)
    return _positive(hashed, labeller, layout, df.columns)


def postprocess_with_report(
    df: DataFrame,
    options: DataFrame,
    options_spec: Dataset,
    labeller: Labeller,
    layout: Dataset = EXPORT_LAYOUT,
    hashed_length: int = MAX_HASHED_ID_LENGTH,
) -> Postprocessed:
    """:func:`postprocess` with its duplicate report and row counts.

    The hashed rows are written once; the write counts the rows on its way, the report reads the written ids only, and the labels go on from there.
    """
    hashed, seen = _hashed_rows(df, options, options_spec, layout, hashed_length)
    staged = stage(hashed, "hashed-rows")
    review_id = layout.columns["REVIEW_ID"]
    duplicates = duplicate_keys(staged.select(F.col(HASHED).alias(review_id)), review_id)
    steps = {step: observation.get["row_count"] for step, observation in seen.items()}
    return Postprocessed(_positive(staged, labeller, layout, df.columns), duplicates, steps)
