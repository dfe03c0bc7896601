"""The driver's tables in the shape of review data.

Every view keeps all rows of its tables. Irregular input (missing keys, blank texts, repeated
ids, doubled options) comes from values, not from leaving rows out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.functions.text import whitespace_tokens
from reviewloom.operators.schema import widen_array
from reviewloom.operators.stats import length_summary
from reviewloom.session import apply_required_conf, scratch_path
from reviewloom.sources import event_log, pages


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    apply_required_conf(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reviews_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as reviews; the order of the same number gives product and date."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    docs = table(spark, sf_dir, "documents")
    d = docs.join(orders, docs.doc_id == orders.o_orderkey, "left")
    k = F.col("doc_id")
    return d.select(
        k.cast("string").alias("review_id"),
        F.when(k % 5 == 0, F.concat(k.cast("string"), F.lit(".0"))).otherwise(k.cast("string")).alias("order_id"),
        F.col("o_custkey").cast("string").alias("product_id"),
        F.col("o_orderdate").alias("created_at"),
        F.when(k % 4 == 0, F.lit(None))
        .when(k % 4 == 1, F.split_part("text", F.lit("\n"), F.lit(1)))
        .when(k % 4 == 2, F.concat_ws(" ", "source", "lang"))
        .otherwise(F.lit("  "))
        .alias("title"),
        F.when(k % 17 == 0, F.lit(None)).when(k % 19 == 0, F.lit(" \u3000 ")).otherwise(F.col("text")).alias("contents"),
        F.when(k % 3 == 0, F.lit(None))
        .when(k % 3 == 1, F.lit(""))
        .otherwise((k % 5 + 1).cast("string"))
        .alias("star_rating"),
        F.col("source").alias("writer_name"),
        F.col("lang"),
        F.transform(
            F.when(k % 4 == 0, F.array().cast("array<bigint>")).otherwise(F.sequence(F.lit(1).cast("bigint"), k % 4)),
            lambda i: F.concat(F.lit("http://img/"), k.cast("string"), F.lit("/"), i.cast("string")),
        ).alias("images"),
    )


def reviews_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as reviews at volume; ``review_id`` repeats."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("review_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_shipdate").alias("created_at"),
        (F.col("l_quantity").cast("int") % 5 + 1).alias("star_rating"),
        F.col("l_extendedprice").alias("amount"),
    )


def order_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their buyer; orders in status P have no id yet, so their reviews find none."""
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    return o.join(c, o.o_custkey == c.c_custkey).select(
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey")).alias("order_id"),
        F.col("o_custkey").alias("buyer_id"),
        F.col("c_name").alias("buyer_name"),
        F.col("o_orderdate").alias("ordered_at"),
    )


def product_id_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as id map; large parts are not mapped (blank source id)."""
    p = table(spark, sf_dir, "part")
    return p.select(
        F.when(F.col("p_size") <= 42, F.col("p_partkey")).alias("source_product_id"),
        (F.col("p_partkey") + 100000).alias("export_product_id"),
    )


def option_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as option map: small parts have a blank id, PROMO parts have a second option."""
    p = table(spark, sf_dir, "part")
    first = p.select(
        F.when(F.col("p_size") > 4, F.col("p_partkey") + 100000).alias("export_product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_brand").alias("option_name"),
    )
    second = p.where(F.col("p_type") == "PROMO").select(
        (F.col("p_partkey") + 100000).alias("export_product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("option_name"),
    )
    return first.unionByName(second)


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A label for every document: the given quality, else long texts count as positive."""
    d, given = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return d.select("doc_id", "n_chars").join(given, "doc_id", "left").select(
        F.col("doc_id").cast("string").alias("review_id"),
        F.coalesce(F.col("quality"), F.when(F.col("n_chars") >= 1000, F.lit(1)).otherwise(F.lit(0))).alias("label"),
    )


def page_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as page items. Each term repeats its last page, and then has a page past the end."""
    b = table(spark, sf_dir, "events").select(
        (F.col("user_id") % 4).alias("term"),
        F.floor(F.col("event_id") / 50).alias("page"),
        F.col("event_id").alias("id"),
        "ts",
        "value",
    )
    last = b.groupBy("term").agg(F.max("page").alias("last_page"), F.min("page").alias("first_page"))
    again = b.join(last, "term").where("page = last_page").select("term", (F.col("last_page") + 1).alias("page"), "id", "ts", "value")
    past = b.join(last, "term").where("page = first_page").select(
        "term", (F.col("last_page") + 2).alias("page"), (F.col("id") + 1000000).alias("id"), "ts", "value"
    )
    return b.unionByName(again).unionByName(past)


def landed_item_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The items as landed pages; a page holds at most 50 events, so it is one short array."""
    record = F.struct(
        F.col("id").alias("sno"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("updated_at"),
        F.concat(F.lit("v="), F.col("value").cast("string")).alias("contents"),
        F.struct((F.col("id") % 97).alias("sno")).alias("goods"),
    )
    listed = page_items(spark, sf_dir).groupBy("term", "page").agg(F.sort_array(F.collect_list(record)).alias("reviews"))
    return listed.select("term", "page", F.to_json(F.struct("reviews")).alias("payload"))


def landed_items_path(spark: SparkSession, sf_dir: str, files: int = 12) -> str:
    """The item pages in several landing files, so that a stream takes several batches to read them."""
    return _once(spark, sf_dir, "item-landing", lambda path: pages.land(landed_item_pages(spark, sf_dir).repartition(files, "page"), path))


def landed_order_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as landed pages from page 1 on. An order comes again on the next page under another name; each term repeats its last page."""
    o = table(spark, sf_dir, "orders").select(
        (F.col("o_custkey") % 4).alias("term"), (F.floor(F.col("o_orderkey") / 400) + 1).alias("page"), F.col("o_orderkey").alias("id"), "o_orderstatus", "o_orderdate"
    )
    again = o.where("o_orderstatus = 'F'").withColumn("page", F.col("page") + 1)
    items = o.withColumn("seen", F.lit("first")).unionByName(again.withColumn("seen", F.lit("again")))
    last = items.groupBy("term").agg(F.max("page").alias("last"))
    repeated = items.join(last, "term").where("page = last").withColumns({"page": F.col("page") + 1, "seen": F.lit("late")}).drop("last")
    record = F.struct(
        F.col("id").alias("sno"),
        F.concat_ws("-", "seen", F.col("id").cast("string")).alias("buyer_name"),
        (F.col("id") % 97).alias("goods_sno"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("ordered_at"),
    )
    listed = items.unionByName(repeated).groupBy("term", "page").agg(F.sort_array(F.collect_list(record)).alias("order_items"))
    return listed.select("term", "page", F.to_json(F.struct("order_items")).alias("payload"))


def landed_target_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as reviews of the target, 20 to an answer, asked by offset. Two turns are a question and its answer."""
    c = table(spark, sf_dir, "conversations").withColumn("pair", F.floor(F.col("turn") / 2))
    text = lambda odd: F.max(F.when(F.col("turn") % 2 == odd, F.col("text")))
    pairs = c.groupBy("conv_id", "pair").agg(text(0).alias("question"), text(1).alias("answer"))
    review = pairs.groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pair", "question", "answer"))), lambda e: F.struct(e["question"].alias("question"), e["answer"].alias("answer"))).alias("questions"))
    grouped = F.when(F.col("conv_id") % 3 == 0, F.struct((F.col("conv_id") % 5).alias("id"), F.concat(F.lit("group "), F.col("conv_id") % 5).alias("name")))
    record = F.struct(
        F.col("conv_id").alias("id"),
        F.concat(F.lit("author "), F.col("conv_id") % 11).alias("author_name"),
        F.concat(F.lit("review "), F.col("conv_id")).alias("text"),
        (F.col("conv_id") % 2 == 0).alias("is_visible"),
        F.struct((F.col("conv_id") % 97).alias("id"), F.concat(F.lit("r"), F.col("conv_id") % 97).alias("remote_id")).alias("product"),
        grouped.alias("review_group"),
        "questions",
    )
    offset = F.floor(F.col("conv_id") / 40) * 20
    listed = review.groupBy((F.col("conv_id") % 2).alias("term"), offset.alias("offset")).agg(F.sort_array(F.collect_list(F.struct("conv_id", record.alias("r")))).alias("l"))
    return listed.select("term", "offset", F.to_json(F.struct(F.col("l.r").alias("results"))).alias("payload"))


def conversation_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of conversations as nested records; one member is a JSON text."""
    c = table(spark, sf_dir, "conversations")
    picture = F.concat(F.lit("http://img/"), F.col("conv_id").cast("string"), F.lit("/"), F.col("turn").cast("string"))
    attachment = F.to_json(F.struct(F.array(F.struct(picture.alias("imgSrc"))).alias("imageAttachments")))
    record = F.struct(
        (F.col("conv_id") * 100 + F.col("turn")).alias("reviewId"),
        F.col("role").alias("memberName"),
        F.col("text").alias("reviewContent"),
        F.struct(F.col("conv_id").alias("sno")).alias("goods"),
        F.array(F.col("role"), F.lit("x")).alias("images"),
        attachment.alias("attachment"),
    )
    return c.select("conv_id", "turn", (F.col("conv_id") * 100 + F.col("turn")).alias("record_id"), record.alias("record"))


def conversation_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page per conversation; its turns are the records (a handful each)."""
    listed = conversation_records(spark, sf_dir).groupBy("conv_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("turn", "record"))), lambda e: e["record"]).alias("content")
    )
    return listed.select(
        (F.col("conv_id") % 4).alias("term"),
        F.floor(F.col("conv_id") / 4).alias("page"),
        F.to_json(F.struct(F.struct("content").alias("data"))).alias("payload"),
    )


def text_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in inference batches of four, with lengths and a label."""
    d = table(spark, sf_dir, "documents")
    batch = F.floor(F.col("doc_id") / 4)
    return d.select(
        batch.alias("batch_id"),
        (F.col("doc_id") % 4).cast("int").alias("pos"),
        F.col("n_chars").alias("text_length"),
        whitespace_tokens(F.col("text")).cast("bigint").alias("token_length"),
        F.when(F.col("doc_id") % 6 == 0, F.lit(0)).otherwise(F.lit(1)).alias("label"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batches as events, one an hour; every ninth one ran out of memory."""
    batches = text_lengths(spark, sf_dir).groupBy("batch_id").agg(
        F.array_sort(F.collect_list(F.struct("pos", "text_length", "token_length"))).alias("entries"),
        F.count_if(F.col("label") == 1).alias("positive_text_count"),
        F.count_if(F.col("label") == 0).alias("negative_text_count"),
    )
    pair = "struct<text_length:bigint,token_length:bigint>"
    summary = F.struct(
        F.size("entries").cast("bigint").alias("batch_size"),
        F.array_max("entries.token_length").alias("max_token_count_per_batch"),
        F.aggregate("entries", F.lit(0).cast("bigint"), lambda a, e: a + e["token_length"]).alias("total_token_count_per_batch"),
    )
    return batches.select(
        F.when(F.col("batch_id") % 9 == 0, F.lit(event_log.OOM_FALLBACK)).otherwise(F.lit(event_log.INFERRED)).alias("event_type"),
        F.col("batch_id").alias("event_id"),
        F.expr("timestampadd(HOUR, batch_id, TIMESTAMP_NTZ'2024-01-01 00:00:00')").alias("timestamp"),
        F.struct(
            summary.alias("batch_snapshot_summary"),
            F.transform("entries", lambda e: F.struct(e["text_length"], e["token_length"]))
            .cast(f"array<{pair}>")
            .alias("text_token_length_mappings"),
        ).alias("batch_snapshot"),
        "positive_text_count",
        "negative_text_count",
    )


_written: dict[tuple[str, str, str], str] = {}


def _once(spark: SparkSession, sf_dir: str, label: str, write) -> str:
    """Path of a derived input, written once per application and table folder."""
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key not in _written:
        path = scratch_path(spark, label)
        write(path)
        _written[key] = path
    return _written[key]


def event_log_path(spark: SparkSession, sf_dir: str) -> str:
    """The events as a JSON log that also has blank and torn lines."""

    def write(path: str) -> None:
        log = events(spark, sf_dir)
        event_log.append_events(log, path)
        torn = log.select(
            F.explode(F.array(F.expr("substr(to_json(struct(*)), 1, 40)"), F.lit(""))).alias("value"),
            F.to_date("timestamp").alias(event_log.EVENT_DATE),
        )
        torn.hint("rebalance", event_log.EVENT_DATE).write.mode("append").partitionBy(event_log.EVENT_DATE).text(path)

    return _once(spark, sf_dir, "event-log", write)


def landed_path(spark: SparkSession, sf_dir: str) -> str:
    return _once(spark, sf_dir, "landing", lambda path: pages.land(conversation_pages(spark, sf_dir), path))


def events_by_kind_path(spark: SparkSession, sf_dir: str) -> str:
    """Event table as a folder of files with different columns."""

    def write(path: str) -> None:
        e = table(spark, sf_dir, "events")
        e.where(F.col("event_type").isin("click", "view")).select("event_id", "value", "props").write.parquet(f"{path}/part_2")
        e.where(F.col("event_type").isin("error", "signup")).select("event_id", "props").write.parquet(f"{path}/part_10")
        # all other events; a third of them has neither id nor value, so whole rows are empty
        others = ~F.coalesce(F.col("event_type").isin("click", "view", "error", "signup"), F.lit(False))
        empty = F.when(F.col("user_id") % 3 != 0, F.col("event_id"))
        e.where(others).select(F.when(empty.isNotNull(), F.col("value")).alias("value"), empty.alias("event_id")).write.parquet(f"{path}/part_1")
        e.select(F.col("ts").alias("unwanted")).write.parquet(f"{path}/part_3")

    return _once(spark, sf_dir, "parts", write)


def monthly_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interval statistics of the order lines: one row per return flag and month, prices as lengths."""
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("series"), F.trunc("l_shipdate", "MM").alias("month"),
        F.floor(F.col("l_extendedprice") / 100).alias("length"),
    )
    summary = length_summary(li, ["series", "month"], {"text_length": F.col("length")})
    return summary.select("series", "month", F.col("count_text_length").alias("text_count"), "p95_text_length")


def source_a_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text reviews with the column names of source A."""
    r = reviews_text(spark, sf_dir).select(
        F.col("review_id").alias("리뷰_id"),
        F.col("contents").alias("리뷰_내용"),
        F.col("product_id").alias("상품_id"),
        F.col("created_at").alias("리뷰_작성_일시"),
        F.col("order_id").alias("주문_id"),
        F.col("lang").alias("사이즈"),
        F.col("images").alias("URL_이미지"),
    )
    return widen_array(r, "URL_이미지", 10)


def source_b_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text reviews with the column names of source B; the date is an epoch in milliseconds."""
    r = reviews_text(spark, sf_dir).select(
        F.col("review_id").alias("리뷰_id"),
        F.col("contents").alias("리뷰_내용"),
        F.unix_millis(F.col("created_at").cast("timestamp")).alias("리뷰_작성_일시"),
        F.col("writer_name").alias("구매자명"),
        F.col("title").alias("리뷰_제목"),
        F.col("star_rating").alias("별점"),
        F.col("product_id").alias("상품_노출_id"),
        F.col("lang").alias("판매명"),
        F.col("product_id").alias("상품_옵션_id"),
        F.col("images").alias("URL_이미지"),
    )
    return widen_array(r, "URL_이미지", 10)


def source_a_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = order_history(spark, sf_dir)
    nothing = F.lit(None).cast("string")
    return h.select(
        F.col("order_id").alias("주문_id"),
        F.col("buyer_id").alias("상품_id"),
        F.col("buyer_name").alias("구매자명"),
        nothing.alias("구매자_번호"),
        nothing.alias("구매자_이메일"),
        F.col("buyer_name").alias("수취인명"),
        nothing.alias("수취인_주소"),
        nothing.alias("판매명"),
        nothing.alias("상품_코드"),
        nothing.alias("옵션_정보"),
        F.col("ordered_at").alias("주문_일시"),
    )


def declared_id_map(spark: SparkSession, sf_dir: str, source_column: str) -> DataFrame:
    return product_id_map(spark, sf_dir).select(
        F.col("source_product_id").alias(source_column), F.col("export_product_id").alias("브이리뷰_상품_id")
    )


def declared_option_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return option_map(spark, sf_dir).select(
        F.col("export_product_id").alias("브이리뷰_상품_id"),
        F.col("product_name").alias("상품명"),
        F.col("option_name").alias("옵션명"),
    )
