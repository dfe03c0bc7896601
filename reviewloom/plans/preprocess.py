"""Preprocess job: clean the inputs, join them, project to the export layout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.functions import text, time
from reviewloom.operators.filters import drop_blank, normalise_ids
from reviewloom.operators.joins import simple_join
from reviewloom.operators.rules import RuleContext, apply_rule
from reviewloom.operators.schema import export_order, prefix_columns, project_by_priority, reindex
from reviewloom.session import stage
from reviewloom.sources.dataset import Dataset, check_created_columns, check_order_ids, indexed_name
from reviewloom.sources.declared import BUYER_LABEL_NAME, BUYER_LABEL_VALUE, EXPORT_LAYOUT, Source

# Prefixes of the joined columns.
REVIEW, ORDERS, ID_MAP, OPTIONS = "review__", "order_history__", "id_mapping__", "product_option_mapping__"

# Per input, the columns a row must have, and those that become integer ids.
REVIEW_KEYS = ("REVIEW_ID", "ORDER_ID", "PRODUCT_ID")
ORDER_KEYS = ("ORDER_ID", "PRODUCT_ID")
ID_MAP_KEYS = ("SCRAPING_PLATFORM_PRODUCT_ID", "EXPORT_PLATFORM_PRODUCT_ID")
OPTION_KEYS = ("EXPORT_PLATFORM_PRODUCT_ID", "PRODUCT_NAME")

PAIRED = (("PRODUCT_OPTION_NAME", "PRODUCT_OPTION_VALUE"), ("CUSTOMER_ATTRIBUTE_NAME", "CUSTOMER_ATTRIBUTE_VALUE"))


def clean_input(df: DataFrame, dataset: Dataset, keys, ids, prefix: str) -> tuple[DataFrame, Dataset]:
    """Required columns present, blank keys gone, ids normalised, declared columns only, prefixed."""
    dataset.require(df)
    df = drop_blank(df, [dataset.get(k) for k in keys])
    df = normalise_ids(df, [dataset.get(k) for k in ids])
    df = reindex(df, list(dataset.flat().values()))
    return prefix_columns(df, dataset, prefix)


def join_mappings(
    reviews: DataFrame, r: Dataset, id_map: DataFrame, m: Dataset, option_map: DataFrame, o: Dataset
) -> DataFrame:
    """Reviews ⟕ id map ⟕ option map, with the two mapping tables joined first.

    The option join looks at mapping columns only, so both orders give the same rows, and this
    one shuffles the reviews once. The mapping is staged, which tells the planner its real size:
    below the broadcast threshold the reviews are not shuffled at all, above it both sides are,
    and hot products are split.
    """
    mapping = stage(
        simple_join(id_map, option_map, {m["EXPORT_PLATFORM_PRODUCT_ID"]: o["EXPORT_PLATFORM_PRODUCT_ID"]}, "LEFT"),
        "product-mapping",
    )
    return simple_join(reviews, mapping, {r["PRODUCT_ID"]: m["SCRAPING_PLATFORM_PRODUCT_ID"]}, "LEFT")


def preprocess(
    source: Source,
    reviews: DataFrame,
    id_map: DataFrame,
    option_map: DataFrame,
    id_map_spec: Dataset,
    option_map_spec: Dataset,
    orders: DataFrame | None = None,
    orders_spec: Dataset | None = None,
    reviews_spec: Dataset | None = None,
    layout: Dataset = EXPORT_LAYOUT,
) -> DataFrame:
    """From the inputs to the export table. ``orders`` is optional."""
    reviews_spec = reviews_spec or source.dataset
    check_created_columns(reviews_spec)
    review_df, r = clean_input(reviews, reviews_spec, REVIEW_KEYS, REVIEW_KEYS, REVIEW)
    map_df, m = clean_input(id_map, id_map_spec, ID_MAP_KEYS, ID_MAP_KEYS, ID_MAP)
    option_df, o = clean_input(option_map, option_map_spec, OPTION_KEYS, OPTION_KEYS[:1], OPTIONS)

    joined, h = review_df, None
    if orders is not None:
        check_order_ids(reviews_spec, orders_spec)
        order_df, h = clean_input(orders, orders_spec, ORDER_KEYS, ORDER_KEYS, ORDERS)
        joined = simple_join(joined, order_df, {r["ORDER_ID"]: h["ORDER_ID"]}, "LEFT")
    joined = join_mappings(joined, r, map_df, m, option_df, o)
    return export_projection(joined, source, r, h, m, o, layout)


def export_projection(
    joined: DataFrame, source: Source, r: Dataset, h: Dataset | None, m: Dataset, o: Dataset, layout: Dataset
) -> DataFrame:
    """Columns by priority, then the export rules, on the joined and prefixed table."""
    priority = [d for d in (r, h, m, o) if d is not None]
    projected = project_by_priority(joined, priority, layout)
    # The rules below may read joined columns, so both sets live in one table until the end.
    both = project_by_priority(joined, priority, layout, keep=joined.columns)
    name = layout.columns

    if "REVIEW_CREATED_DATETIME" in r:
        column = r["REVIEW_CREATED_DATETIME"]
        moment = time.parse_timestamp(F.col(f"`{column}`"), joined.schema[column].dataType)
        created = {name["REVIEW_CREATED_DATE"]: time.date_part(moment), name["REVIEW_CREATED_TIME"]: time.time_part(moment)}
    else:
        created = {
            name["REVIEW_CREATED_DATE"]: time.strict_date(F.col(f"`{name['REVIEW_CREATED_DATE']}`")),
            name["REVIEW_CREATED_TIME"]: time.strict_time(F.col(f"`{name['REVIEW_CREATED_TIME']}`")),
        }

    star = name["REVIEW_STAR_RATING"]
    if star in projected.columns:
        rating = text.star_default(F.col(f"`{star}`"), projected.schema[star].dataType)
    else:
        rating = F.lit(text.DEFAULT_STAR_RATING)

    both = both.withColumns(
        {
            **created,
            star: rating,
            name["PRODUCT_ID"]: F.col(f"`{m['EXPORT_PLATFORM_PRODUCT_ID']}`"),
            indexed_name(name["CUSTOMER_ATTRIBUTE_NAME"], 1): F.lit(BUYER_LABEL_NAME),
            indexed_name(name["CUSTOMER_ATTRIBUTE_VALUE"], 1): F.lit(BUYER_LABEL_VALUE.format(label=source.label)),
            indexed_name(name["PRODUCT_OPTION_NAME"], 1): F.col(f"`{o['PRODUCT_NAME']}`"),
            indexed_name(name["PRODUCT_OPTION_VALUE"], 1): F.col(f"`{o['PRODUCT_OPTION_NAME']}`"),
        }
    )
    both = drop_blank(both, [name["REVIEW_CONTENTS"]])
    title, contents = name["REVIEW_TITLE"], name["REVIEW_CONTENTS"]
    if title in projected.columns and contents in projected.columns:
        both = both.withColumns(
            {
                contents: text.title_contents(F.col(f"`{title}`"), F.col(f"`{contents}`")),
                title: F.lit(None).cast("string"),
            }
        )
    both = apply_rule(both, source.name, "target", RuleContext(reviews=r, orders=h, export=layout))
    return reindex(both, export_order(layout, PAIRED, "MANAGER_COMMENT"))
