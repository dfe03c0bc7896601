"""Sources, sinks, streams and the whole pipeline on small files."""

import json
import os
import shutil
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from reviewloom import session
from reviewloom.operators import rules
from reviewloom.operators.labels import train_classifier
from reviewloom.operators.ordering import number_chunks
from reviewloom.operators.stats import dated_statistics as stats_of
from reviewloom.operators.stats import inferred_statistics, interval_statistics, outcome_counts, outcomes_of_histograms
from reviewloom.plans import pipeline, tune
from reviewloom.plans.ingest import ingest, missing_key_report, only, source_terms
from reviewloom.plans.postprocess import given_labels, predicted_labels
from reviewloom.plans.preprocess import preprocess
from reviewloom.sources import event_log, sinks, tables
from reviewloom.sources.dataset import Dataset
from reviewloom.sources.declared import (
    OPTION_MAP,
    SOURCE_A_ID_MAP,
    SOURCE_A_ORDERS,
    SOURCE_A_REVIEWS,
    SOURCE_B_ID_MAP,
    SOURCE_B_REVIEWS,
    TARGET_REVIEWS,
)
from reviewloom.sources.pages import land, pages_of_offsets, read_pages
from reviewloom.streaming import ingest as stream_ingest
from reviewloom.session import stage
from reviewloom.streaming import interval_stats as stream_stats

SPEC = Dataset("t", {"ID": "id", "V": "v"}, required=frozenset({"ID"}))


def ids(df, column="id"):
    return sorted(r[column] for r in df.collect())


def test_missing_tables(spark, tmp_path):
    empty = tables.load(spark, f"{tmp_path}/none", SPEC)
    assert empty.columns == ["id", "v"] and empty.count() == 0
    with pytest.raises(FileNotFoundError):
        tables.load(spark, f"{tmp_path}/none", SPEC, required=True)


def test_scan_spec(spark, tmp_path):
    spark.range(10).select("id", (F.col("id") % 2).alias("v")).write.parquet(f"{tmp_path}/t")
    spec = tables.ScanSpec(select=[" id ", None], where="id > 6", order_by="id DESC")
    got = tables.load(spark, f"{tmp_path}/t", SPEC, spec)
    assert [tuple(r) for r in got.collect()] == [(9,), (8,), (7,)]
    assert tables.clean_select([" a ", "", None, "a"]) == ["a"]
    assert tables.clean_select(None) == tables.clean_select([]) == tables.clean_select(["a", "*"]) == ["*"]
    with pytest.raises(ValueError):
        tables.scan(got, tables.ScanSpec(select=["id", "v"], group_by="id"))


def test_order_by_text(spark):
    df = spark.createDataFrame([(1, None), (2, "b,c"), (3, "a"), (None, "a")], "id int, v string")
    ids_of = lambda order: [r.id for r in tables.scan(df, tables.ScanSpec(order_by=order)).collect()]
    assert ids_of("coalesce(v, 'zz') desc, id") == [1, 2, 3, None]
    assert ids_of("v NULLS FIRST, id DESC NULLS FIRST") == [1, None, 3, 2]
    assert ids_of("replace(v, ',', 'x') DESC, id") == [2, 3, None, 1]


@pytest.mark.parametrize("fmt", ["parquet", "csv", "json"])
def test_directory_merge(spark, tmp_path, fmt):
    for name, columns in (("part_10", "a,b"), ("part_2", "b,a"), ("part_1", "c,a"), ("part_3", "z")):
        parts = [F.lit(f"{name}.{c}").alias(c) for c in columns.split(",")]
        spark.range(1).select(*parts).write.options(header=True).format(fmt).save(f"{tmp_path}/{fmt}/{name}")
    merged = tables.merge_directory(spark, f"{tmp_path}/{fmt}/*", ["a", "b", "nowhere"], fmt)
    got = [(r.a, r.b) for r in merged.orderBy("file_order").collect()]
    assert got == [("part_1.a", None), ("part_2.a", "part_2.b"), ("part_10.a", "part_10.b")]
    assert tables.merge_directory(spark, f"{tmp_path}/{fmt}/*", ["nowhere"], fmt) is None


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_directory_merge_keeps_empty_rows(spark, tmp_path, fmt):
    some = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, z string").coalesce(1)
    nothing = spark.createDataFrame([(None, "y"), (None, "y")], "a int, z string").coalesce(1)
    for name, part in (("p1", some), ("p2", nothing), ("p3", nothing.select("z"))):
        part.write.options(header=True).format(fmt).save(f"{tmp_path}/{fmt}/{name}")
    merged = tables.merge_directory(spark, f"{tmp_path}/{fmt}/*", ["a", "b"], fmt)
    assert [r.a for r in merged.orderBy("file_order", F.col("a").asc_nulls_last()).collect()] == ["1", "3", None, None, None]


def test_event_log_rejects(spark, tmp_path):
    lines = ['{"event_type": "inferred", "event_id": 1}', '{"event_type": "inf', "", '{"event_type": "inferred", "event_id": 2.5}', '{"event_id": 3}']
    spark.createDataFrame([(x,) for x in lines[:3]], "value string").coalesce(1).write.text(f"{tmp_path}/torn")
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{tmp_path}/bad")
    assert [r.event_id for r in event_log.scan_events(spark, f"{tmp_path}/torn").collect()] == [1]
    with pytest.raises(Exception, match="no event of the log's schema"):
        event_log.scan_events(spark, f"{tmp_path}/bad").collect()
    assert event_log.scan_events(spark, f"{tmp_path}/bad", strict=False).count() == 1
    rejected = {(r.reason, r.line) for r in event_log.rejected_lines(spark, f"{tmp_path}/bad").collect()}
    assert rejected == {("torn", lines[1]), ("misfit", lines[3]), ("untyped", lines[4])}


def test_upsert_table(spark, tmp_path):
    path = f"{tmp_path}/t"
    table = lambda data: spark.createDataFrame(data, "id string, v string")
    assert not sinks.save(table([("1", "a")]), path, None)
    assert not sinks.save(table([("1", "a")]), path, "other")
    assert not sinks.save(table([]), path, "id")
    assert sinks.read_current(spark, path) is None
    assert sinks.save(table([("1", "a"), ("2", "b")]), path, "id")
    assert sinks.save(table([("2", "B"), ("3", "c")]), path, "id", overwrite=True)
    assert sorted(tuple(r) for r in sinks.read_current(spark, path).collect()) == [("1", "a"), ("2", "B"), ("3", "c")]
    assert sinks.save(table([("3", "C"), ("4", "d")]), path, "id")
    assert sorted(r.v for r in sinks.read_current(spark, path).collect()) == ["B", "a", "c", "d"]
    assert not sinks.save(table([]), path, "id")
    assert not sinks.save(spark.createDataFrame([("x",)], "k string"), path, "k")


def test_outcome_tables(spark, tmp_path):
    rows = spark.createDataFrame([("1", "a")], "id string, v string")
    outcome = lambda value: rows.withColumn("succeeded", F.lit(value))
    sinks.write_outcomes(outcome(False), f"{tmp_path}/ok", f"{tmp_path}/bad", "id")
    assert sinks.read_current(spark, f"{tmp_path}/ok").columns == ["id", "v"]
    assert sinks.read_current(spark, f"{tmp_path}/bad").count() == 1
    sinks.write_outcomes(outcome(True), f"{tmp_path}/ok2", f"{tmp_path}/bad2", "id")
    assert sinks.read_current(spark, f"{tmp_path}/bad2") is None


def test_chunk_files_have_the_names_of_the_manifest(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/out/chunks"
    files = lambda: sorted(f for f in os.listdir(path) if not f.startswith(("_", ".")))
    numbered = number_chunks(spark.range(0, 105, 1, 7), [F.col("id")], 10)
    sinks.write_chunks(numbered, path, "upload")
    manifest = {r.file_name: (r.chunk, r.row_count) for r in sinks.read_manifest(spark, path).collect()}
    assert files() == sorted(manifest) == [f"upload_{i:02d}_of_11.parquet" for i in range(1, 12)]
    for name, (chunk, count) in manifest.items():
        rows = spark.read.parquet(f"{path}/{name}").collect()
        assert len(rows) == count and {(r.chunk, (r.id // 10) + 1) for r in rows} == {(chunk, chunk)}
    # a task that fails once changes nothing, a job that fails leaves what was there
    marker = f"{tmp_path}/failed-once"

    def fails_once(batches):
        for batch in batches:
            if not os.path.exists(marker):
                open(marker, "w").close()
                raise RuntimeError("lost")
            yield batch

    small = stage(number_chunks(spark.range(25), [F.col("id")], 10), "numbered-rows")
    with pytest.raises(Exception, match="lost"):
        sinks.write_chunks(small.mapInArrow(fails_once, small.schema), path, "upload")
    assert len(files()) == 11 and os.listdir(f"{tmp_path}/out") == ["chunks"]
    sinks.write_chunks(small.mapInArrow(fails_once, small.schema), path, "upload")
    assert files() == [f"upload_{i}_of_3.parquet" for i in (1, 2, 3)] and sinks.read_chunks(spark, path).count() == 25
    sinks.write_chunks(small.limit(0), path, "upload")
    assert files() == [] and sinks.read_manifest(spark, path).count() == 0


def test_outcomes_run_their_input_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = spark.range(0, 100, 1, 4).selectExpr("CAST(id AS STRING) AS id", "id % 3 > 0 AS succeeded")
    sinks.write_outcomes(rows.mapInArrow(counted, rows.schema), f"{tmp_path}/ok", f"{tmp_path}/bad", "id")
    assert seen.value == 100
    assert (sinks.read_current(spark, f"{tmp_path}/ok").count(), sinks.read_current(spark, f"{tmp_path}/bad").count()) == (66, 34)


def test_tail_lists_the_newest_folders_only(spark, tmp_path, monkeypatch):
    log, looked_at = f"{tmp_path}/log", []
    events = spark.range(20).select(
        F.lit(event_log.INFERRED).alias("event_type"), F.col("id").alias("event_id"), F.expr("timestampadd(DAY, CAST(id AS INT), TIMESTAMP_NTZ'2024-01-01 00:00:00')").alias("timestamp")
    )
    event_log.append_events(events, log)
    whole = event_log.tail
    monkeypatch.setattr(event_log, "tail", lambda found, *args: (looked_at.append(found.inputFiles()), whole(found, *args))[1])
    assert [r.event_id for r in event_log.tail_of_log(spark, log, 3).collect()] == [19, 18, 17]
    assert {f.split("event_date=")[1][:10] for f in looked_at[0]} == {f"2024-01-{day}" for day in (17, 18, 19, 20)}


def test_event_log(spark, tmp_path):
    path, dated = f"{tmp_path}/log", f"{tmp_path}/dated"
    line = lambda i: json.dumps({"event_type": "inferred", "event_id": i, "timestamp": f"2024-01-0{i}T00:00:00"})
    os.makedirs(path)
    with open(f"{path}/a.json", "w") as f:
        f.write("\n".join([line(1), "", line(2), line(3)[:30]]))
    plain = event_log.scan_events(spark, path)
    assert ids(plain, "event_id") == [1, 2] and plain.count() == 2
    event_log.append_events(plain, dated)
    event_log.append_events(plain.withColumn("event_id", F.col("event_id") + 3), dated)
    log = event_log.scan_events(spark, dated)
    assert log.columns == plain.columns
    assert ids(log, "event_id") == [1, 2, 4, 5]
    for where in (path, dated):
        assert set(ids(event_log.scan_events(spark, where, start="2024-01-02"), "event_id")) <= {2, 5}
        assert set(ids(event_log.scan_events(spark, where, end="2024-01-02"), "event_id")) <= {1, 4}
    assert ids(event_log.scan_events(spark, dated, start="2024-01-02"), "event_id") == [2, 5]
    assert ids(event_log.scan_events(spark, dated, end="2024-01-02 00:00:01"), "event_id") == [1, 2, 4, 5]
    for n, want in ((1, [5]), (2, [5, 2]), (3, [5, 2, 4]), (9, [5, 2, 4, 1])):
        assert [r.event_id for r in event_log.tail(log, n).collect()] == want
        assert [r.event_id for r in event_log.tail_of_log(spark, dated, n).collect()] == want
    assert [r.event_id for r in event_log.tail(log, 2, newest_first=False).collect()] == [2, 5]
    event_log.clear_events(spark, dated)
    assert event_log.scan_events(spark, dated).count() == 0


def test_period_path():
    assert sinks.period_path("/a/", "2024-01-01", "2024-02-01") == "/a/period=2024-01-01 ~ 2024-02-01"


def test_shared_dir_needs_a_setting_on_a_cluster(spark):
    assert session.shared_dir(spark)
    assert session.stage(spark.range(5), "test").count() == 5


def page(term, number, *records, root="reviews"):
    body = {root: list(records)}
    return (term, number, json.dumps(body, ensure_ascii=False))


def pages_frame(spark, listed):
    return spark.createDataFrame(listed, "term long, page long, payload string")


def a_review(sno, text="좋아요\n정말", **more):
    return {"sno": sno, "contents": text, "updated_at": "2024-01-02 03:04:05", "order_item_sno": 7, "goods": {"sno": 70}, "images": ["u1", "u2"], **more}


def test_ingest(spark):
    pages = pages_frame(
        spark,
        [page(0, 0, a_review(1), a_review(2)), page(0, 1, a_review(1, "new"), {"sno": None}), page(0, 2, a_review(1), a_review(2)), page(0, 3, a_review(9))],
    )
    rows = {r["리뷰_id"]: r for r in ingest(pages, SOURCE_A_REVIEWS).collect()}
    assert set(rows) == {"1", "2"}
    assert rows["1"]["리뷰_내용"] == "new" and rows["2"]["리뷰_내용"] == "좋아요 정말"
    assert (rows["2"]["상품_id"], rows["2"]["URL_이미지2"], rows["2"]["URL_이미지3"]) == ("70", "u2", None)
    first = {r["리뷰_id"]: r["리뷰_내용"] for r in ingest(pages, SOURCE_A_REVIEWS, last_wins=False).collect()}
    assert first["1"] == "좋아요 정말"
    missing = {r.missing_key for r in missing_key_report(pages, SOURCE_A_REVIEWS).collect()}
    assert {"size", "images.{index}"} <= missing


def mappings(spark):
    id_map = spark.createDataFrame([("70", "700"), ("71.0", "701"), (" ", "702")], "`에이블리_상품_id` string, `브이리뷰_상품_id` string")
    options = spark.createDataFrame([("700", "가방", "빨강"), ("700", "가방", "파랑"), ("701", " ", "x")], "`브이리뷰_상품_id` string, `상품명` string, `옵션명` string")
    return id_map, options


def test_preprocess(spark):
    pages = pages_frame(spark, [page(0, 0, a_review(1), a_review(2, " "), a_review(3, goods={"sno": 71}), a_review(4, order_item_sno=None))])
    reviews = ingest(pages, SOURCE_A_REVIEWS)
    orders = spark.createDataFrame([(7, 70, "김")], "`주문_id` int, `상품_id` int, `구매자명` string")
    for c in SOURCE_A_ORDERS.dataset.flat().values():
        if c not in orders.columns:
            orders = orders.withColumn(c, F.lit(None).cast("string"))
    id_map, options = mappings(spark)
    got = preprocess(SOURCE_A_REVIEWS, reviews, id_map, options, SOURCE_A_ID_MAP, OPTION_MAP, orders, SOURCE_A_ORDERS.dataset)
    rows = sorted((r["리뷰_id"], r["상품_id"], r["구매옵션_옵션값1"], r["리뷰_작성자명"], r["리뷰_별점"]) for r in got.collect() if r["리뷰_id"] == "1")
    assert rows == [("1", "700", "빨강", "김", 5), ("1", "700", "파랑", "김", 5)]
    assert sorted({r["리뷰_id"] for r in got.collect()}) == ["1", "3"]
    assert [r["구매옵션_옵션값1"] for r in got.where("`리뷰_id` = '3'").collect()] == [None]
    row = got.first()
    assert (str(row["리뷰_작성_일자"]), row["리뷰_작성_시간"], row["고객정보_정보명1"]) == ("2024-01-02", "03:04:05", "구매처")
    assert got.columns[:2] == ["리뷰_id", "상품_id"]
    with pytest.raises(ValueError, match="missing"):
        preprocess(SOURCE_A_REVIEWS, reviews.drop("리뷰_내용"), id_map, options, SOURCE_A_ID_MAP, OPTION_MAP)


def test_preprocess_with_date_and_time_columns(spark):
    spec = Dataset(
        "r", {"REVIEW_ID": "id", "PRODUCT_ID": "p", "REVIEW_CONTENTS": "c", "REVIEW_CREATED_DATE": "d", "REVIEW_CREATED_TIME": "t", "REVIEW_TITLE": "h"}
    )
    reviews = spark.createDataFrame([("1", "70", "본문", "2024-01-02", "03:04:05", "제목")], "id string, p string, c string, d string, t string, h string")
    id_map, options = mappings(spark)
    row = preprocess(SOURCE_B_REVIEWS, reviews, id_map, options, SOURCE_A_ID_MAP, OPTION_MAP, reviews_spec=spec).first()
    assert (str(row["리뷰_작성_일자"]), row["리뷰_작성_시간"], row["리뷰_내용"], row["리뷰_제목"]) == ("2024-01-02", "03:04:05", "제목 본문", None)


def test_rules(spark):
    df = spark.createDataFrame([("w", None)], "`리뷰_작성자명` string, buyer string")
    orders = Dataset("o", {"BUYER_NAME": "buyer"})
    run = lambda source, context: rules.apply_rule(df, source, "target", context).first()
    assert run("source_a", rules.RuleContext(orders=orders))["리뷰_작성자명"] is None
    assert run("source_a", rules.RuleContext())["리뷰_작성자명"] == "w"
    assert run("source_b", rules.RuleContext())["리뷰_별점"] == 5
    assert run("other", rules.RuleContext()) == df.first()


@pytest.mark.parametrize("labelled", ["table", "model"])
def test_pipeline(spark, tmp_path, labelled):
    """Pages to success and failure tables, stage by stage, and once more without any change."""
    space = pipeline.Workspace(f"{tmp_path}/out", "2024-01-01", "2024-02-01")
    land(pages_frame(spark, [page(0, 0, *[a_review(i, f"text {i} good") for i in range(1, 8)]), page(0, 1, *[a_review(i, f"text {i} bad") for i in range(8, 11)])]), f"{tmp_path}/landing")
    id_map, options = mappings(spark)
    id_map.write.parquet(f"{tmp_path}/ids")
    options.write.parquet(f"{tmp_path}/options")
    if labelled == "table":
        given = spark.range(1, 11).select(F.col("id").cast("string").alias("id"), (F.col("id") < 8).cast("int").alias("label"))
        labeller = given_labels(given, "id")
    else:
        taught = spark.createDataFrame([("so good", 1), ("really good", 1), ("so bad", 0), ("really bad", 0)] * 5, "t string, y int")
        labeller = predicted_labels(train_classifier(taught, "t", "y", f"{tmp_path}/model"))
    for _ in range(2):
        pipeline.run_ingest(spark, space, SOURCE_A_REVIEWS, f"{tmp_path}/landing")
        pipeline.run_preprocess(spark, space, SOURCE_A_REVIEWS, f"{tmp_path}/ids", SOURCE_A_ID_MAP, f"{tmp_path}/options")
        pipeline.run_postprocess(spark, space, f"{tmp_path}/options", labeller)
    # Two options per product: seven positive reviews, once from the first and once from the second join.
    post = sinks.read_current(spark, space.table("postprocessed"))
    assert post.select("`리뷰_id`").distinct().count() == 7 and post.count() == 28
    numbered = pipeline.run_chunks(spark, space, 10)
    assert sorted(f for f in os.listdir(space.table("chunks")) if not f.startswith(("_", "."))) == [f"upload_{i}_of_3.parquet" for i in (1, 2, 3)]
    outcomes = spark.createDataFrame([(1, True), (2, False), (3, True)], "chunk bigint, succeeded boolean")
    pipeline.run_finalize(spark, space, outcomes)
    assert numbered.count() == 28
    assert sinks.read_current(spark, space.table("success")).count() == 18
    assert sinks.read_current(spark, space.table("failed")).count() == 10


def test_stream_ingest(spark, tmp_path):
    landing, table, checkpoint = (f"{tmp_path}/{n}" for n in ("landing", "table", "checkpoint"))
    land(pages_frame(spark, [page(0, 0, a_review(1), a_review(2))]), landing)
    stream_ingest.ingest_stream(spark, landing, table, checkpoint, SOURCE_A_REVIEWS)
    before = stream_ingest.read_ingested(spark, table, SOURCE_A_REVIEWS).collect()
    stream_ingest.ingest_stream(spark, landing, table, checkpoint, SOURCE_A_REVIEWS)
    assert stream_ingest.read_ingested(spark, table, SOURCE_A_REVIEWS).collect() == before
    land(pages_frame(spark, [page(0, 1, a_review(2, "later"), a_review(3))]), landing)
    stream_ingest.ingest_stream(spark, landing, table, checkpoint, SOURCE_A_REVIEWS)
    streamed = stream_ingest.read_ingested(spark, table, SOURCE_A_REVIEWS)
    batch = ingest(read_pages(spark, landing), SOURCE_A_REVIEWS)
    assert sorted(map(str, streamed.select(*batch.columns).collect())) == sorted(map(str, batch.collect()))
    stream_ingest.compact(spark, table, f"{tmp_path}/compact", SOURCE_A_REVIEWS)
    assert stream_ingest.read_ingested(spark, f"{tmp_path}/compact", SOURCE_A_REVIEWS).count() == 3


@pytest.mark.parametrize("source", [SOURCE_A_REVIEWS, replace(SOURCE_A_REVIEWS, last_wins=False)], ids=["last", "first"])
def test_stream_finds_stops_over_batches(spark, tmp_path, source):
    """Pages in no order, one to a batch: repeated pages, an empty one, one landed twice, and pages behind the stop."""
    landing, table, checkpoint = (f"{tmp_path}/{n}" for n in ("landing", "table", "checkpoint"))
    listed = [
        page(0, 3, a_review(1, "behind"), a_review(90)),
        page(0, 0, a_review(1, "first"), a_review(2)),
        page(0, 2, a_review(2, "again"), a_review(1, "again")),  # the ids of page 0: the stop
        page(0, 1, a_review(2, "later"), a_review(3)),
        page(1, 1),
        page(1, 2, a_review(4, "behind")),
        page(1, 0, a_review(4), a_review(1, "other term")),
        page(1, 0, a_review(4), a_review(1, "landed twice")),
        page(2, 0, a_review(7)),
    ]
    for k, one in enumerate(listed):
        land(pages_frame(spark, [one]), landing)
        if k % 3 != 1:
            stream_ingest.ingest_stream(spark, landing, table, checkpoint, source, maxFilesPerTrigger=1)
        if k in (2, 5, 8):
            batch = ingest(read_pages(spark, landing), source)
            streamed = stream_ingest.read_ingested(spark, table, source)
            assert streamed.columns == batch.columns and sorted(map(str, streamed.collect())) == sorted(map(str, batch.collect()))
    assert {r["리뷰_id"] for r in batch.collect()} == {"1", "2", "3", "4", "7"}
    stream_ingest.compact(spark, table, f"{tmp_path}/compact", source)
    merged = stream_ingest.read_ingested(spark, f"{tmp_path}/compact", source)
    assert sorted(map(str, merged.collect())) == sorted(map(str, batch.collect()))
    assert spark.read.parquet(f"{tmp_path}/compact").where("`리뷰_id` = '90'").count() == 0


def test_orders_keep_their_first_row(spark, tmp_path):
    order = lambda sno, name: {"sno": sno, "buyer_name": name, "goods_sno": 5}
    pages = [(0, 1, json.dumps({"order_items": [order(1, "a"), order(2, "b")]})), (0, 2, json.dumps({"order_items": [order(2, "c"), order(3, "d")]}))]
    land(pages_frame(spark, pages), f"{tmp_path}/landing")
    space = pipeline.Workspace(f"{tmp_path}/out", "2024-01-01", "2024-03-01")
    pipeline.run_ingest(spark, space, SOURCE_A_ORDERS, f"{tmp_path}/landing", "orders")
    rows = sinks.read_current(spark, space.table("orders")).collect()
    assert {(r["주문_id"], r["구매자명"]) for r in rows} == {("1", "a"), ("2", "b"), ("3", "d")}
    missing = {r.missing_key: r.records_without for r in spark.read.parquet(space.table("orders_missing_keys")).collect()}
    assert missing["buyer_tel"] == 4 and "sno" not in missing
    (term,) = spark.read.parquet(space.table("orders_terms")).collect()
    assert (term.term, term.landed_pages, str(term.term_end)) == (0, 2, "2024-03-01 00:00:00")
    # a source with a limit is asked in terms of four fifths of it
    terms = source_terms(spark, SOURCE_B_REVIEWS, "2024-01-01", "2024-03-01").orderBy("term").collect()
    assert [str(t.term_start)[:10] for t in terms] == ["2024-01-01", "2024-01-25", "2024-02-18"]


def test_target_answers(spark):
    review = {"id": 5, "text": "t", "product": {"remote_id": "r1"}, "questions": [{"question": f"q{i}", "answer": f"a{i}"} for i in range(12)]}
    other = {"id": 6, "review_group": {"id": 3}, "questions": [{"answer": "only"}]}
    answers = spark.createDataFrame([(0, 0, json.dumps({"results": [review]})), (0, 20, json.dumps({"results": [other]}))], "term long, offset long, payload string")
    rows = ingest(pages_of_offsets(answers, 20), TARGET_REVIEWS)
    found = {r["리뷰_id"]: r for r in rows.collect()}
    assert (found["5"]["고객정보_정보명10"], found["5"]["고객정보_답변값1"]) == ("q9", "a0")
    assert (found["6"]["고객정보_정보명1"], found["6"]["고객정보_답변값1"], found["6"]["고객정보_답변값2"]) == (None, "only", None)
    assert [r["리뷰_id"] for r in only(rows, TARGET_REVIEWS, products=["r1"]).collect()] == ["5"]
    assert [r["리뷰_id"] for r in only(rows, TARGET_REVIEWS, groups=["3"]).collect()] == ["6"]
    assert only(rows, TARGET_REVIEWS).count() == 2
    with pytest.raises(ValueError):
        only(rows, TARGET_REVIEWS, products=[], groups=[])
    with pytest.raises(Exception, match="no multiple of 20"):
        pages_of_offsets(answers.withColumn("offset", F.col("offset") + 1), 20).collect()


def event(i, day, lengths):
    size = len(lengths)
    return json.dumps(
        {
            "event_type": "inferred", "event_id": i, "timestamp": f"2024-01-{day:02d}T00:00:{i:02d}",
            "batch_snapshot": {
                "batch_snapshot_summary": {"batch_size": size, "max_token_count_per_batch": 1, "total_token_count_per_batch": 1},
                "text_token_length_mappings": [{"text_length": n, "token_length": n // 2} for n in lengths],
            },
            "positive_text_count": size, "negative_text_count": 0,
        }
    )


def test_stream_statistics(spark, tmp_path):
    log, table, checkpoint = (f"{tmp_path}/{n}" for n in ("log", "table", "checkpoint"))
    by_day = lambda e: e.withColumn("day", F.to_date("timestamp"))
    spark.createDataFrame([(event(1, 1, [10, 20]),), (event(2, 2, [30]),)], "value string").write.text(log)
    run = lambda: stream_stats.statistics_stream(spark, log, table, checkpoint, ["day"], by_day)
    run()
    run()
    stats = stream_stats.read_statistics(spark, table, ["day"])
    assert [(r.event_count, r.inferred_total_text_count, r.p95_text_length) for r in stats.orderBy("day").collect()] == [(1, 2, 19), (1, 1, 30)]
    spark.createDataFrame([(event(3, 2, [50]),)], "value string").write.mode("append").text(log)
    # Day 2 now has an event its recorded statistics do not know.
    events = by_day(event_log.scan_events(spark, log))
    fresh = tune.refresh_statistics(stats, events, ["day"])
    assert [(r.event_count, r.avg_text_length) for r in fresh.orderBy("day").collect()] == [(1, 15.0), (2, 40.0)]
    run()
    # the second run brought more of a day that the first one knew: one row, as from the whole log
    merged = stream_stats.read_statistics(spark, table, ["day"])
    assert [r.event_count for r in merged.orderBy("day").collect()] == [1, 2]
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, stats_of(by_day(event_log.scan_events(spark, log)), ["day"]).collect()))


def test_refresh_reads_stale_dates_only(spark, tmp_path, monkeypatch):
    log, table = f"{tmp_path}/log", f"{tmp_path}/table"
    by_day = lambda e: e.withColumn("day", F.to_date("timestamp"))
    opened = []
    plain = tune.scan_dates
    monkeypatch.setattr(tune, "scan_dates", lambda s, path, dates: opened.append(list(dates)) or plain(s, path, dates))
    refresh = lambda: tune.refresh_histograms(spark, log, table, ["day"], by_day)

    def put(*events):
        event_log.append_events(spark.read.schema(event_log.EVENT_SCHEMA).json(spark.sparkContext.parallelize(events)), log)

    def same_as_the_log():
        histograms, events = spark.read.parquet(f"{table}/histograms"), by_day(event_log.scan_events(spark, log))
        assert sorted(map(tuple, inferred_statistics(histograms, ["day"]).collect())) == sorted(map(tuple, interval_statistics(events, ["day"]).collect()))
        assert sorted(map(tuple, outcomes_of_histograms(histograms, ["day"]).collect())) == sorted(map(tuple, outcome_counts(events, ["day"]).collect()))

    put(event(1, 1, [10, 20]), event(2, 2, [30]), event(3, 3, [5]), json.dumps({"event_type": "oom_fallback", "event_id": 4, "timestamp": "2024-01-03T01:00:00"}))
    assert refresh() == ["2024-01-01", "2024-01-02", "2024-01-03"]
    same_as_the_log()
    assert refresh() == [] and len(opened) == 1
    put(event(5, 2, [70, 80]), event(6, 4, [1]))
    assert refresh() == ["2024-01-02", "2024-01-04"] == opened[-1]
    same_as_the_log()
    # a date that shrank, and one that is gone
    spark.createDataFrame([(event(2, 2, [30]),)], "value string").write.mode("overwrite").text(f"{log}/event_date=2024-01-02")
    shutil.rmtree(f"{log}/event_date=2024-01-03")
    assert refresh() == ["2024-01-02"]
    same_as_the_log()
    # a date whose events are gone, and a run that fails half way
    spark.createDataFrame([("",)], "value string").write.mode("overwrite").text(f"{log}/event_date=2024-01-04")
    put(event(7, 1, [3]))
    monkeypatch.setattr(tune, "scan_dates", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        refresh()
    monkeypatch.setattr(tune, "scan_dates", plain)
    assert refresh() == ["2024-01-01", "2024-01-04"]
    same_as_the_log()


def test_refresh_writes_few_files(spark, tmp_path):
    log, table = f"{tmp_path}/log", f"{tmp_path}/table"
    by_day = lambda e: e.withColumn("day", F.to_date("timestamp"))
    refresh = lambda: tune.refresh_histograms(spark, log, table, ["day"], by_day)
    files = lambda part="": {str(p) for p in (tmp_path / "table").rglob(f"*{part}*/*.parquet")}
    dated = lambda i, month, day: event(i, day, [i, 2 * i]).replace("2024-01-", f"2024-{month:02d}-")

    def put(*events):
        event_log.append_events(spark.read.schema(event_log.EVENT_SCHEMA).json(spark.sparkContext.parallelize(events)), log)

    def same_as_the_log():
        histograms, events = spark.read.parquet(f"{table}/histograms"), by_day(event_log.scan_events(spark, log))
        assert sorted(map(tuple, inferred_statistics(histograms, ["day"]).collect())) == sorted(map(tuple, interval_statistics(events, ["day"]).collect()))

    put(*[dated(day, month, day) for month in (1, 2, 3) for day in range(1, 29)])
    assert len(refresh()) == 84
    # neither the histograms nor the facts have a file per date
    assert len(files()) < 20
    same_as_the_log()
    # only the month of a changed date is written again, and its other dates stay
    others = files("m2024-01") | files("m2024-03")
    put(dated(50, 2, 5))
    assert refresh() == ["2024-02-05"]
    assert others and files("m2024-01") | files("m2024-03") == others
    same_as_the_log()
    # a date that is gone beside others, and a month that is gone
    shutil.rmtree(f"{log}/event_date=2024-01-07")
    for day in range(1, 29):
        shutil.rmtree(f"{log}/event_date=2024-03-{day:02d}")
    assert refresh() == [] and not files("m2024-03")
    same_as_the_log()
    # a run that fails while it writes leaves the dates of its months stale
    put(dated(51, 2, 6))
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(tune, "small_tasks", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            refresh()
    assert refresh() == [f"2024-02-{day:02d}" for day in range(1, 29)]
    same_as_the_log()


def test_inconsistent_batch_is_an_error(spark, tmp_path):
    broken = event(1, 1, [10, 20]).replace('"batch_size": 2', '"batch_size": 3')
    spark.createDataFrame([(broken,)], "value string").write.text(f"{tmp_path}/log")
    from reviewloom.operators.stats import interval_statistics

    events = event_log.scan_events(spark, f"{tmp_path}/log").withColumn("day", F.to_date("timestamp"))
    with pytest.raises(Exception, match="differs from its array"):
        interval_statistics(events, ["day"]).collect()
