"""Registered queries: every operator and job on the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reviewloom.functions import ids, text, time
from reviewloom.functions import json as js
from reviewloom.operators import buckets, dedupe, filters, joins, labels, ordering, rules, schema, stats, tuning, upsert
from reviewloom.operators import pages as page_ops
from reviewloom.plans import finalize, hide, ingest, postprocess, preprocess, tune
from reviewloom.session import scratch_path, stage
from reviewloom.sources import event_log, tables
from reviewloom.sources import pages as page_source
from reviewloom.sources.dataset import Dataset
from reviewloom.sources.declared import (
    DAY_MS,
    EXPORT_LAYOUT,
    OPTION_MAP,
    SOURCE_A_ID_MAP,
    SOURCE_A_ORDERS,
    SOURCE_A_REVIEWS,
    SOURCE_B_ID_MAP,
    SOURCE_B_REVIEWS,
    TARGET_REVIEWS,
)
from reviewloom.streaming import ingest as page_stream
from reviewloom.streaming import interval_stats as statistics_stream
from reviewloom.workload import views as v

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

TOKEN_CAP = 512
BUCKET_CAP = 4096
PADDING_RATIO = 0.4
CHUNK_SIZE = 500


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# Column specs of the views.
REVIEWS = Dataset(
    "reviews",
    {
        "REVIEW_ID": "review_id",
        "ORDER_ID": "order_id",
        "PRODUCT_ID": "product_id",
        "REVIEW_CREATED_DATETIME": "created_at",
        "REVIEW_STAR_RATING": "star_rating",
        "AMOUNT": "amount",
    },
)
ORDERS = Dataset(
    "orders", {"ORDER_ID": "order_id", "BUYER_ID": "buyer_id", "BUYER_NAME": "buyer_name", "ORDERED_AT": "ordered_at"}
)
ID_MAP = Dataset(
    "id map",
    {"SCRAPING_PLATFORM_PRODUCT_ID": "source_product_id", "EXPORT_PLATFORM_PRODUCT_ID": "export_product_id"},
)
OPTIONS = Dataset(
    "option map",
    {
        "EXPORT_PLATFORM_PRODUCT_ID": "export_product_id",
        "PRODUCT_NAME": "product_name",
        "PRODUCT_OPTION_NAME": "option_name",
    },
)


def prefixed(df: DataFrame, spec: Dataset, prefix: str) -> DataFrame:
    return schema.prefix_columns(df, spec, prefix)[0]


# Scans and sinks


@query
def scan_spec(spark, d):
    spec = tables.ScanSpec(
        select=[" l_orderkey ", "l_partkey", None, "", "l_quantity", "l_shipdate", "l_orderkey"],
        where="l_shipdate >= DATE '1998-01-01' AND l_quantity >= 10",
        order_by="l_shipdate DESC, l_orderkey",
    )
    return tables.scan(v.table(spark, d, "lineitem"), spec)


@query
def scan_group_by(spark, d):
    spec = tables.ScanSpec(select=["l_returnflag", "l_linestatus"], group_by="l_returnflag, l_linestatus")
    return tables.scan(v.table(spark, d, "lineitem"), spec)


@query
def scan_union_parts(spark, d):
    customers = v.table(spark, d, "customer").select(
        F.col("c_custkey").alias("party_id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), "c_mktsegment"
    )
    suppliers = v.table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("party_id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation")
    )
    return tables.union_parts([customers, suppliers])


def _old_orders(spark, d):
    return v.table(spark, d, "orders").select(
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey")).alias("order_id"),
        F.col("o_totalprice").alias("total"),
        F.col("o_orderdate").alias("ordered_at"),
    )


def _new_orders(spark, d):
    return v.table(spark, d, "orders").select(
        F.when(F.col("o_orderstatus") != "F", F.col("o_orderkey") * 2).alias("order_id"),
        (F.col("o_totalprice") * 2).alias("total"),
        F.col("o_orderpriority").alias("priority"),
    )


@query
def upsert_overwrite(spark, d):
    return upsert.upsert(_old_orders(spark, d), _new_orders(spark, d), "order_id", overwrite=True)


@query
def upsert_ignore(spark, d):
    return upsert.upsert(_old_orders(spark, d), _new_orders(spark, d), "order_id", overwrite=False)


@query
def upsert_conflicts(spark, d):
    return upsert.conflicting_keys(_old_orders(spark, d), _new_orders(spark, d), "order_id")


@query
def dir_column_merge(spark, d):
    merged = tables.merge_directory(spark, v.events_by_kind_path(spark, d) + "/*", ["event_id", "value", "props", "absent"])
    return merged.select("event_id", "value", "props")


def _log(spark, d, **between):
    v.apply_required_conf(spark)
    return event_log.scan_events(spark, v.event_log_path(spark, d), **between)


@query
def event_log_scan(spark, d):
    found = _log(spark, d, start="2024-01-03 00:00:00")
    lengths = "batch_snapshot.text_token_length_mappings"
    return found.select(
        "event_id",
        "event_type",
        "timestamp",
        F.col("batch_snapshot.batch_snapshot_summary.batch_size").alias("batch_size"),
        F.col("batch_snapshot.batch_snapshot_summary.max_token_count_per_batch").alias("max_tokens"),
        F.col("batch_snapshot.batch_snapshot_summary.total_token_count_per_batch").alias("total_tokens"),
        F.size(lengths).alias("text_count"),
        "positive_text_count",
        "negative_text_count",
    )


@query
def event_log_tail(spark, d):
    v.apply_required_conf(spark)
    return event_log.tail_of_log(spark, v.event_log_path(spark, d), 10).select("event_id", "event_type", "timestamp")


# Projections


@query
def reindex_lenient(spark, d):
    wanted = ["o_totalprice", None, "o_orderkey", "missing", 7, "o_orderkey", "o_orderstatus"]
    return schema.reindex(v.table(spark, d, "orders"), wanted)


@query
def rename_safe(spark, d):
    names = {"o_orderkey": "order_id", "o_custkey": None, None: "x", "missing": "y", "o_totalprice": "total"}
    return schema.rename(v.table(spark, d, "orders"), names)


@query
def drop_safe(spark, d):
    return schema.drop(v.table(spark, d, "orders"), ["o_orderpriority", None, " ", "missing", "o_custkey"])


@query
def prefix_columns(spark, d):
    return prefixed(v.order_history(spark, d), ORDERS, preprocess.ORDERS)


@query
def schema_map_rename(spark, d):
    li = v.table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("id"), F.col("l_quantity").alias("v1"), F.col("l_discount").alias("v2"), F.col("l_tax").alias("v3"),
        F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status1"),
    )
    source = Dataset("in", {"ID": "id", "VALUE": "v", "FLAG": "flag", "STATUS": "status"}, arrays={"VALUE": 3, "STATUS": 1})
    target = Dataset("out", {"ID": "key", "VALUE": "amount", "FLAG": "marks", "STATUS": "state"}, arrays={"VALUE": 2, "FLAG": 4})
    return schema.map_to(li, source, target)


@query
def priority_project(spark, d):
    r = prefixed(v.reviews_fact(spark, d), REVIEWS, preprocess.REVIEW)
    h = prefixed(v.order_history(spark, d), ORDERS, preprocess.ORDERS)
    joined = joins.simple_join(r, h, {"review__order_id": "order_history__order_id"}, "LEFT")
    target = Dataset(
        "out",
        {"ORDER_ID": "order_id", "BUYER_NAME": "buyer", "ORDERED_AT": "ordered_at", "REVIEW_ID": "review_id", "UNKNOWN": "unknown"},
    )
    return schema.project_by_priority(joined, [REVIEWS.prefixed(preprocess.REVIEW), ORDERS.prefixed(preprocess.ORDERS)], target)


@query
def export_projection(spark, d):
    r = v.source_a_reviews(spark, d)
    mapped = schema.map_to(r, SOURCE_A_REVIEWS.dataset, EXPORT_LAYOUT)
    return schema.reindex(mapped, schema.export_order(EXPORT_LAYOUT, preprocess.PAIRED, "MANAGER_COMMENT"))


@query
def array_widen(spark, d):
    r = v.reviews_text(spark, d).select("review_id", "images")
    return schema.widen_array(r, "images", 10, "image")


@query
def unify_types(spark, d):
    li = v.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag", "l_shipdate",
        F.when(F.col("l_returnflag") == "none", F.col("l_tax")).alias("never"),
        (F.col("l_linenumber") > 3).alias("late"),
    )
    return schema.unify_types(li)


# JSON


def _parsed(spark, d):
    return v.conversation_records(spark, d).select("record_id", F.parse_json(F.to_json("record")).alias("record"))


@query
def json_flatten(spark, d):
    # every record also has a member twelve levels down
    inner = F.struct(F.col("record.memberName").alias("role"))
    for level in range(11, 0, -1):
        inner = F.struct(F.array(inner).alias(f"n{level}")) if level % 2 else F.struct(inner.alias(f"n{level}"))
    deep = v.conversation_records(spark, d).withColumn("record", F.col("record").withField("deep", inner))
    return js.flatten(deep.select("record_id", F.parse_json(F.to_json("record")).alias("record")), "record", ["record_id"])


@query
def json_embedded(spark, d):
    key_map = {"reviewId": "review_id", "attachment.imageAttachments.1.imgSrc": "image1", "attachment.imageAttachments.2.imgSrc": "image2"}
    return js.target_keys(_parsed(spark, d), "record", key_map, embedded_in=["attachment"])


@query
def json_target_keys(spark, d):
    key_map = {"reviewId": "review_id", "goods.sno": "goods", "images.2": "second", "images.3": "third", "none.at": "absent"}
    return js.target_keys(_parsed(spark, d), "record", key_map, missing="")


@query
def json_records(spark, d):
    found = js.records(v.conversation_pages(spark, d), "payload", ["data", "content"], keep=("term", "page"))
    return found.select(
        "term", "page", "position", F.try_variant_get("record", "$.reviewId", "bigint").alias("review_id")
    )


@query
def missing_keys(spark, d):
    keys = ["reviewId", "images.1", "images.3", "images.4", "goods.sno", "goods.name", "attachment.imageAttachments.2.imgSrc"]
    return js.missing_keys(_parsed(spark, d), "record", keys, embedded_in=["attachment"])


# Filters


@query
def drop_blank(spark, d):
    r = v.reviews_text(spark, d).select("review_id", "order_id", "title", "contents")
    return filters.drop_blank(r, ["contents", "title", "missing", None])


@query
def filter_contains(spark, d):
    p = v.table(spark, d, "part").withColumnsRenamed({"p_name": "P_Name"})
    return filters.filter_rows(p, {"p_name": "RED|ring$", "P_TYPE": "pro", "unknown": "x"})


@query
def filter_equals_ci(spark, d):
    return filters.filter_rows(v.table(spark, d, "part"), {"P_TYPE": "promo", "p_brand": "brand#1"}, contains=False)


@query
def positive_filter(spark, d):
    r = v.reviews_text(spark, d).select("review_id", "product_id", "contents")
    return labels.keep_positive(r, v.labels(spark, d), "review_id", "label")


# Joins


def _sides(spark, d):
    return prefixed(v.reviews_fact(spark, d), REVIEWS, preprocess.REVIEW), prefixed(v.order_history(spark, d), ORDERS, preprocess.ORDERS)


_ORDER_KEYS = {"review__order_id": "order_history__order_id", "review__created_at": "order_history__ordered_at"}


@query
def join_simple_left(spark, d):
    return joins.simple_join(*_sides(spark, d), _ORDER_KEYS, "LEFT")


@query
def join_simple_right(spark, d):
    return joins.simple_join(*_sides(spark, d), _ORDER_KEYS, "RIGHT")


@query
def join_simple_inner(spark, d):
    return joins.simple_join(*_sides(spark, d), {"review__order_id": "order_history__order_id"}, "INNER")


@query
def join_simple_full(spark, d):
    return joins.simple_join(*_sides(spark, d), {"review__order_id": "order_history__order_id"}, "FULL OUTER")


@query
def join_order_history(spark, d):
    return joins.simple_join(*_sides(spark, d), {"review__order_id": "order_history__order_id"}, "LEFT")


@query
def join_product_map(spark, d):
    r, _ = _sides(spark, d)
    m = prefixed(v.product_id_map(spark, d), ID_MAP, preprocess.ID_MAP)
    return joins.simple_join(r, m, {"review__product_id": "id_mapping__source_product_id"}, "LEFT")


@query
def join_option_map(spark, d):
    r, _ = _sides(spark, d)
    m = prefixed(v.product_id_map(spark, d), ID_MAP, preprocess.ID_MAP)
    o = prefixed(v.option_map(spark, d), OPTIONS, preprocess.OPTIONS)
    return preprocess.join_mappings(
        r, REVIEWS.prefixed(preprocess.REVIEW), m, ID_MAP.prefixed(preprocess.ID_MAP), o, OPTIONS.prefixed(preprocess.OPTIONS)
    )


def _named(spark, d, how, **options):
    left = v.reviews_fact(spark, d).select("review_id", "order_id", "created_at", "amount")
    right = v.order_history(spark, d).select(
        F.col("order_id").alias("oid"), F.col("ordered_at").alias("created_at"), "buyer_name", F.col("buyer_id").alias("amount")
    )
    return joins.named_join(left, right, {"order_id": "oid"}, how, "reviews", "orders", **options)


@query
def join_named_left(spark, d):
    return _named(spark, d, "LEFT")


@query
def join_named_right(spark, d):
    return _named(spark, d, "RIGHT")


@query
def join_named_inner(spark, d):
    return _named(spark, d, "INNER")


@query
def join_named_full(spark, d):
    return _named(spark, d, "FULL OUTER")


@query
def join_named_drop(spark, d):
    return _named(spark, d, "FULL OUTER", drop_common=True)


@query
def option_remap(spark, d):
    r = v.reviews_fact(spark, d).select(
        "review_id", (F.col("product_id") + 100000).alias("product_id"), "amount",
        F.lit("old name").alias("name"),
        F.when(F.col("star_rating") > 1, F.lit("old option")).otherwise(F.lit(" ")).alias("option"),
    )
    columns = {"export_product_id": "product_id", "product_name": "name", "option_name": "option"}
    return joins.remap_options(r, v.option_map(spark, d), columns, "export_product_id")


# Duplicates


@query
def dedupe_last(spark, d):
    return dedupe.keep_last(v.reviews_fact(spark, d), "review_id", ["created_at", "product_id", "amount"])


@query
def dedupe_first(spark, d):
    return dedupe.keep_first(v.reviews_fact(spark, d), "review_id", ["created_at", "product_id", "amount"])


@query
def distinct_first_seen(spark, d):
    e = v.table(spark, d, "events")
    return dedupe.first_seen(e, "user_id", "event_id")


@query
def duplicate_keys(spark, d):
    return dedupe.duplicate_keys(v.reviews_fact(spark, d), "review_id")


# Pages and terms


def _marked(spark, d):
    return page_ops.fingerprint_pages(v.landed_item_pages(spark, d), "payload", ["reviews"], "sno")


@query
def page_fingerprint(spark, d):
    return _marked(spark, d).select("term", "page", F.col("record_count").cast("bigint").alias("record_count"), "fingerprint")


@query
def page_stop(spark, d):
    kept = page_ops.pages_before_stop(_marked(spark, d))
    return kept.select("term", "page", F.col("record_count").cast("bigint").alias("record_count"))


@query
def term_windows(spark, d):
    limit = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(None).cast("bigint"))
        .when(F.col("o_orderpriority") == "2-HIGH", F.lit(DAY_MS).cast("bigint"))
        .otherwise(F.lit(30 * DAY_MS))
    )
    ranges = v.table(spark, d, "orders").select(
        "o_orderkey", F.col("o_orderdate").alias("range_start"),
        F.expr("timestampadd(HOUR, 25 * CAST(o_custkey % 60 AS INT), o_orderdate)").alias("range_end"),
        limit.alias("limit_ms"),
    )
    return page_ops.term_windows(ranges, "range_start", "range_end", "limit_ms").select("o_orderkey", "term", "term_start", "term_end")


# Event log statistics


@query
def events_by_type(spark, d):
    return stats.events_by_type(_log(spark, d))


@query
def batch_summary(spark, d):
    return stats.batch_summary(v.text_lengths(spark, d), "batch_id", "token_length")


@query
def label_counts(spark, d):
    return stats.label_counts(v.text_lengths(spark, d), "batch_id", "label")


def _daily(events):
    return events.withColumn("day", F.to_date("timestamp"))


@query
def interval_stats(spark, d):
    return stats.interval_statistics(_daily(_log(spark, d)), ["day"])


@query
def p95_length(spark, d):
    docs = v.table(spark, d, "documents").select(
        "lang", F.length("text").alias("chars"), text.whitespace_tokens(F.col("text")).alias("tokens")
    )
    return stats.length_summary(docs, ["lang"], {"chars": F.col("chars"), "tokens": F.col("tokens")})


@query
def log_consistency(spark, d):
    # A batch whose array lost its last entry is what the check has to find.
    lengths = F.col("batch_snapshot.text_token_length_mappings")
    cut = F.when(F.col("event_id") % 10 == 3, F.slice(lengths, 1, F.size(lengths) - 1)).otherwise(lengths)
    damaged = _log(spark, d).withColumn("batch_snapshot", F.col("batch_snapshot").withField("text_token_length_mappings", cut))
    return stats.inconsistent_batches(damaged)


@query
def chunk_means(spark, d):
    means = tuning.chunk_means(v.monthly_stats(spark, d), ["series"], "month", "p95_text_length")
    return means.withColumn("chunk_mean", F.round("chunk_mean", 6))


@query
def trend_forecast(spark, d):
    return tuning.trend_forecast(v.monthly_stats(spark, d), ["series"], "month", "p95_text_length")


@query
def ratio_update(spark, d):
    daily = stats.outcome_counts(_daily(_log(spark, d)), ["day"])
    return daily.withColumn("ratio", F.round(tuning.updated_ratio(F.col("inferred_count"), F.col("oom_count"), 0.7), 6))


@query
def ema(spark, d):
    previous = F.lag("p95_text_length").over(Window.partitionBy("series").orderBy("month"))
    monthly = v.monthly_stats(spark, d).select("series", "month", "p95_text_length", previous.alias("previous_length"))
    return monthly.select(
        "series", "month",
        F.round(tuning.ema_step(0.3, F.col("previous_length"), F.col("p95_text_length"), 0.1, 0.9), 6).alias("ema"),
        F.round(tuning.ema_step(0.95, F.col("previous_length"), F.col("p95_text_length"), 0.1, 0.9), 6).alias("ema_out_of_range"),
    )


@query
def adaptive_alpha(spark, d):
    return tuning.adaptive_alpha(
        v.monthly_stats(spark, d), ["series"], "month", "p95_text_length", previous=0.3, low=0.1, high=0.9, step=0.05, noise=10.0
    )


@query
def stats_rescan(spark, d):
    # Recorded facts that miss the newest event of every second day.
    daily = _daily(_log(spark, d))
    facts = daily.groupBy("day").agg(F.count(F.lit(1)).alias("event_count"), F.max("timestamp").alias("last_timestamp"))
    short = F.dayofmonth("day") % 2 == 0
    recorded = facts.select(
        "day",
        F.when(short, F.col("event_count") - 1).otherwise(F.col("event_count")).alias("event_count"),
        F.when(short, F.expr("timestampadd(HOUR, -1, last_timestamp)")).otherwise(F.col("last_timestamp")).alias("last_timestamp"),
    )
    return stats.stale_statistics(recorded, daily, ["day"])


@query
def row_audit(spark, d):
    steps = []
    df, seen = stats.audited(v.reviews_text(spark, d), "read")
    steps.append(("read", seen))
    df, seen = stats.audited(filters.drop_blank(df, ["contents"]), "with contents")
    steps.append(("with contents", seen))
    df, seen = stats.audited(filters.normalise_ids(df, ["review_id", "order_id"]), "with ids")
    steps.append(("with ids", seen))
    df.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame(
        [(i, name, seen.get["row_count"]) for i, (name, seen) in enumerate(steps)], "step bigint, name string, row_count bigint"
    )


# Numbering, chunks, batches

_FACT_TIES = ["review_id", "order_id", "created_at", "star_rating", "amount"]


def _chunked(spark, d):
    return finalize.export_chunks(v.reviews_fact(spark, d), "product_id", _FACT_TIES, CHUNK_SIZE, scanned=True)


@query
def chunk_ids(spark, d):
    return _chunked(spark, d).select("product_id", *_FACT_TIES, "row_number", "chunk")


@query
def chunk_manifest(spark, d):
    return finalize.manifest(_chunked(spark, d), "upload")


@query
def id_batches(spark, d):
    batched = hide.request_batches(v.table(spark, d, "lineitem"), "l_orderkey", "l_partkey")
    return batched.select("batch", "id_count", F.concat_ws(",", "ids").alias("ids"))


@query
def hide_reconcile(spark, d):
    li = v.table(spark, d, "lineitem").select(F.floor(F.col("l_orderkey") / 100).alias("batch"), F.col("l_orderkey").alias("id"), "l_returnflag")
    return hide.reconcile(li, li.where(F.col("l_returnflag") != "R"), "batch", "id")


def _tokens(spark, d):
    docs = filters.drop_blank(v.table(spark, d, "documents"), ["text"])
    return docs.select("doc_id", text.whitespace_tokens(F.col("text"), TOKEN_CAP).cast("bigint").alias("tokens"))


def _bucketed(spark, d):
    return buckets.token_buckets(_tokens(spark, d), "tokens", "doc_id", BUCKET_CAP, PADDING_RATIO)


@query
def token_buckets(spark, d):
    return _bucketed(spark, d)


@query
def bucket_resplit(spark, d):
    return buckets.resplit_buckets(_bucketed(spark, d), "tokens", "doc_id")


# Scalar functions


@query
def clean_text(spark, d):
    c = v.table(spark, d, "conversations")
    return c.select("conv_id", "turn", text.clean_text(F.concat(F.col("text"), F.lit("\t|\x7f"))).alias("cleaned"))


@query
def parse_ts(spark, d):
    e = v.table(spark, d, "events")
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    number = (
        F.when(F.col("event_type") == "click", millis)
        .when(F.col("event_type") == "view", F.lit(20000000000) + F.col("event_id"))
        .when(F.col("event_type") == "error", F.lit(None).cast("bigint"))
        .otherwise(F.floor(millis / 1000))
    )
    words = F.when(F.col("event_type") == "click", F.lit("x")).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    kinds = e.select("event_id", number.alias("n"), words.alias("w"), "value")
    return kinds.select(
        "event_id",
        time.parse_timestamp(F.col("n"), kinds.schema["n"].dataType).alias("from_number"),
        time.parse_timestamp(F.col("w"), kinds.schema["w"].dataType).alias("from_text"),
        time.parse_timestamp(F.col("value"), kinds.schema["value"].dataType).alias("from_double"),
    )


@query
def split_datetime(spark, d):
    e = v.table(spark, d, "events")
    moment = time.parse_timestamp(F.col("ts"), e.schema["ts"].dataType)
    return e.select("event_id", time.date_part(moment).alias("created_date"), time.time_part(moment).alias("created_time"))


@query
def parse_date_time(spark, d):
    e = v.table(spark, d, "events").select(
        "event_id", F.date_format("ts", "yyyy-MM-dd").alias("date_text"), F.date_format("ts", "HH:mm:ss").alias("time_text")
    )
    return e.select(
        "event_id", time.strict_date(F.col("date_text")).alias("created_date"), time.strict_time(F.col("time_text")).alias("created_time")
    )


@query
def parse_by_format(spark, d):
    e = v.table(spark, d, "events").select(
        "event_id",
        *[F.date_format("ts", f).alias(n) for n, f in {"a": "yyyy/M/d", "b": "dd.MM.yy", "c": "MMM d,  yyyy", "t": "HHmmss", "u": "h:mm:ss a"}.items()],
    )
    return e.select(
        "event_id",
        time.parse_date_by_format(F.col("a"), "%Y/%m/%d").alias("slashed"),
        time.parse_date_by_format(F.col("b"), "%d.%m.%y").alias("short"),
        time.parse_date_by_format(F.col("c"), "%b %d, %Y").alias("named"),
        time.parse_time_by_format(F.col("t"), "%H%M%S").alias("packed"),
        time.parse_time_by_format(F.col("u"), "%I:%M:%S %p").alias("halved"),
    )


@query
def date_time_text(spark, d):
    e = v.table(spark, d, "events")
    seconds = F.hour("ts") * 3600 + F.minute("ts") * 60 + F.second("ts")
    return e.select(
        "event_id", time.date_to_text(F.col("ts")).alias("date_text"), time.time_part(F.col("ts")).alias("time_text"),
        time.day_fraction_to_text(seconds / 86400 + F.lit(45000)).alias("serial_time_text"),
    )


@query
def join_date_time(spark, d):
    e = v.table(spark, d, "events")
    return e.select(
        "event_id", time.join_date_and_time(F.date_format("ts", "yyyy-MM-dd"), F.date_format("ts", "HH:mm:ss")).alias("joined")
    )


@query
def title_contents(spark, d):
    r = v.reviews_text(spark, d)
    return r.select("review_id", text.title_contents(F.col("title"), F.col("contents")).alias("contents"))


def _raw_ids(spark, d):
    k = F.col("o_orderkey")
    raw = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.concat(k.cast("string"), F.lit(".0")))
        .when(F.col("o_orderpriority") == "2-HIGH", F.concat(F.lit("no-"), k.cast("string")))
        .when(F.col("o_orderpriority") == "5-LOW", F.lit(None))
        # ids of more digits than any number type holds
        .when(F.col("o_orderpriority") == "3-MEDIUM", F.concat(F.lit("+009"), F.lpad(k.cast("string"), 44, "0"), F.lit(".000")))
        .otherwise(F.concat(F.lit(" "), k.cast("string")))
    )
    return v.table(spark, d, "orders").select(raw.alias("order_id"), F.col("o_custkey").cast("double").alias("buyer_id"), "o_totalprice")


@query
def int_string_id(spark, d):
    return filters.normalise_ids(_raw_ids(spark, d), ["order_id", "buyer_id", "missing"])


@query
def int_string_id_keep(spark, d):
    return filters.normalise_ids(_raw_ids(spark, d), ["order_id", "buyer_id"], drop_invalid=False)


@query
def hash_review_id(spark, d):
    e = v.table(spark, d, "events").select(
        "event_id", F.col("event_id").cast("string").alias("review_id"), F.to_date("ts").alias("created_date"),
        F.when(F.col("event_type") == "error", F.lit("late")).otherwise(F.date_format("ts", "HH:mm:ss")).alias("created_time"),
    )
    return postprocess.hash_ids(e, "review_id", "created_date", "created_time").select("event_id", "review_id")


@query
def star_default(spark, d):
    r = v.reviews_text(spark, d)
    return r.select("review_id", text.star_default(F.col("star_rating"), r.schema["star_rating"].dataType).alias("star_rating"))


@query
def token_count(spark, d):
    t = F.col("text")
    return v.table(spark, d, "documents").select(
        "doc_id", F.length("text").cast("bigint").alias("text_length"),
        text.whitespace_tokens(t).cast("bigint").alias("tokens"),
        text.whitespace_tokens(t, TOKEN_CAP).cast("bigint").alias("tokens_capped"),
    )


# Rules and labels


def _rule_input(spark, d):
    r, h = _sides(spark, d)
    joined = joins.simple_join(r, h, {"review__order_id": "order_history__order_id"}, "LEFT")
    name = EXPORT_LAYOUT.columns
    return joined.select(
        F.col("review__review_id").alias(name["REVIEW_ID"]),
        F.lit("nobody").alias(name["REVIEW_WRITER_NAME"]),
        F.col("review__star_rating").alias(name["REVIEW_STAR_RATING"]),
        "order_history__buyer_name",
    )


@query
def rule_writer_from_buyer(spark, d):
    context = rules.RuleContext(orders=ORDERS.prefixed(preprocess.ORDERS))
    return rules.apply_rule(_rule_input(spark, d), "source_a", "target", context)


@query
def rule_star_override(spark, d):
    return rules.apply_rule(_rule_input(spark, d), "source_b", "target", rules.RuleContext())


@query
def rules_identity(spark, d):
    return rules.apply_rule(_rule_input(spark, d), "source_c", "target", rules.RuleContext())


@query
def classify_text(spark, d):
    docs = v.table(spark, d, "documents").select("doc_id", "text")
    given = docs.join(v.table(spark, d, "labels").select("doc_id", "quality"), "doc_id")
    model = labels.train_classifier(given, "text", "quality", scratch_path(spark, "classifier"))
    return labels.classify(docs, model).select("doc_id", "label")


# Jobs


@query
def job_preprocess(spark, d):
    return preprocess.preprocess(
        SOURCE_A_REVIEWS,
        v.source_a_reviews(spark, d),
        v.declared_id_map(spark, d, "에이블리_상품_id"),
        v.declared_option_map(spark, d),
        SOURCE_A_ID_MAP,
        OPTION_MAP,
        orders=v.source_a_orders(spark, d),
        orders_spec=SOURCE_A_ORDERS.dataset,
    )


@query
def job_preprocess_without_orders(spark, d):
    return preprocess.preprocess(
        SOURCE_B_REVIEWS,
        v.source_b_reviews(spark, d),
        v.declared_id_map(spark, d, "노출상품ID"),
        v.declared_option_map(spark, d),
        SOURCE_B_ID_MAP,
        OPTION_MAP,
    )


def _postprocessed(spark, d):
    given = postprocess.given_labels(v.labels(spark, d), "review_id")
    return postprocess.postprocess(job_preprocess(spark, d), v.declared_option_map(spark, d), OPTION_MAP, given)


@query
def job_postprocess(spark, d):
    return _postprocessed(spark, d)


@query
def postprocess_duplicates(spark, d):
    given = postprocess.given_labels(v.labels(spark, d), "review_id")
    return postprocess.postprocess_with_report(job_preprocess(spark, d), v.declared_option_map(spark, d), OPTION_MAP, given).duplicates


def _outcomes(numbered: DataFrame) -> DataFrame:
    """Upload outcomes as they would come back: every fourth chunk fails, every ninth has no answer."""
    known = numbered.select("chunk").distinct()
    return known.select("chunk", F.when(F.col("chunk") % 9 != 0, F.col("chunk") % 4 != 0).alias("succeeded"))


@query
def finalize_split(spark, d):
    numbered = _chunked(spark, d).select("product_id", *_FACT_TIES, "chunk")
    done = finalize.with_outcome(numbered, _outcomes(numbered))
    return done.withColumn("outcome", F.when(F.col("succeeded"), "success").otherwise("failed")).drop("succeeded")


@query
def job_finalize(spark, d):
    name = EXPORT_LAYOUT.columns
    wanted = [name[k] for k in ("REVIEW_ID", "PRODUCT_ID", "REVIEW_CONTENTS")]
    # Stages hand over tables: finalize starts from the written result of postprocess.
    done = stage(_postprocessed(spark, d).select(*wanted, "구매옵션_옵션값1"), "postprocessed")
    numbered = finalize.export_chunks(done, name["PRODUCT_ID"], [name["REVIEW_ID"], "구매옵션_옵션값1"], 50, scanned=True)
    outcome = finalize.with_outcome(numbered, _outcomes(numbered))
    return outcome.drop("chunk_count")


@query
def job_ingest(spark, d):
    v.apply_required_conf(spark)
    landed = page_source.read_pages(spark, v.landed_path(spark, d))
    return ingest.ingest(landed, SOURCE_B_REVIEWS)


@query
def job_ingest_orders(spark, d):
    v.apply_required_conf(spark)
    return ingest.ingest(v.landed_order_pages(spark, d), SOURCE_A_ORDERS)


@query
def job_ingest_target(spark, d):
    v.apply_required_conf(spark)
    pages_of = page_source.pages_of_offsets(v.landed_target_answers(spark, d), 20, TARGET_REVIEWS.first_page)
    return ingest.ingest(pages_of, TARGET_REVIEWS)


@query
def job_tune(spark, d):
    hourly = _log(spark, d).withColumns({"series": F.lit("all"), "hour": F.date_trunc("HOUR", "timestamp").cast("timestamp_ntz")})
    return tune.tune(hourly, ["series"], "hour", 0.7)


def _in_series(events):
    """Every event in the series of all, and most of them in a second one; intervals are hours."""
    series = F.when(F.col("event_id") % 5 != 0, F.array(F.lit("all"), F.lit("most"))).otherwise(F.array(F.lit("all")))
    return events.withColumns({"series": F.explode(series), "hour": F.date_trunc("HOUR", "timestamp").cast("timestamp_ntz")})


@query
def job_tune_refreshed(spark, d):
    # A first run sees every third date in part and every fourth one not at all; the second run reads those again.
    v.apply_required_conf(spark)
    log, table = scratch_path(spark, "growing-log"), scratch_path(spark, "histograms")
    events = v.events(spark, d)
    day = F.dayofyear("timestamp")
    early = (day % 4 != 0) & ((day % 3 != 0) | (F.col("event_id") % 2 == 0))
    event_log.append_events(events.where(early), log)
    tune.refresh_histograms(spark, log, table, ["series", "hour"], _in_series)
    event_log.append_events(events.where(~early), log)
    return tune.tune_refreshed(spark, log, table, ["series"], "hour", 0.7, _in_series)


# Streams


@query
def stream_ingest(spark, d):
    v.apply_required_conf(spark)
    table, checkpoint = scratch_path(spark, "ingested"), scratch_path(spark, "ingest-checkpoint")
    page_stream.ingest_stream(spark, v.landed_path(spark, d), table, checkpoint, SOURCE_B_REVIEWS)
    return page_stream.read_ingested(spark, table, SOURCE_B_REVIEWS)


@query
def stream_ingest_pages(spark, d):
    # repeated and past-end pages, over several batches in no order
    v.apply_required_conf(spark)
    table, checkpoint = scratch_path(spark, "ingested"), scratch_path(spark, "ingest-checkpoint")
    page_stream.ingest_stream(spark, v.landed_items_path(spark, d), table, checkpoint, SOURCE_A_REVIEWS, maxFilesPerTrigger=4)
    rows = page_stream.read_ingested(spark, table, SOURCE_A_REVIEWS)
    return rows.select(*[SOURCE_A_REVIEWS.dataset[k] for k in ("REVIEW_ID", "REVIEW_CONTENTS", "REVIEW_CREATED_DATETIME", "PRODUCT_ID")])


@query
def stream_interval_stats(spark, d):
    v.apply_required_conf(spark)
    table, checkpoint = scratch_path(spark, "statistics"), scratch_path(spark, "statistics-checkpoint")
    # several batches, in which days arrive in parts
    statistics_stream.statistics_stream(spark, v.event_log_path(spark, d), table, checkpoint, ["day"], _daily, maxFilesPerTrigger=128)
    return statistics_stream.read_statistics(spark, table, ["day"])
