"""Scalar functions on small literal cases."""

import json
import datetime
import hashlib

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reviewloom.functions import ids, text, time
from reviewloom.functions import json as js
from reviewloom.operators.filters import drop_blank, filter_rows, normalise_ids
from reviewloom.plans.postprocess import hash_ids

dt = datetime.datetime


def one(spark, values, kind, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r.y for r in df.select("i", fn(F.col("x"), df.schema["x"].dataType).alias("y")).orderBy("i").collect()]


def test_drop_blank(spark):
    df = spark.createDataFrame([(None,), ("",), ("  ",), ("　",), ("\x1c",), ("x",)], "a string")
    assert [r.a for r in drop_blank(df, ["a", "missing", None]).collect()] == ["x"]
    assert drop_blank(df, ["missing"]).count() == 6
    nan = spark.createDataFrame([(float("nan"),), (None,), (1.0,)], "a double")
    assert [r.a for r in drop_blank(nan, ["a"]).collect()] == [1.0]


def test_title_contents(spark):
    rows = [(None, None), ("A", None), (None, " b "), ("A", "A b"), ("A", "c"), ("  ", "c"), ("", " "), ("제목", "제목 내용")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, t string, c string")
    got = [r.y for r in df.select("i", text.title_contents(F.col("t"), F.col("c")).alias("y")).orderBy("i").collect()]
    assert got == [None, "A", "b", "A b", "A c", "c", "", "제목 내용"]


def test_clean_text(spark):
    assert one(spark, ["a\nb\tc\x7f", None, "가\r\n나\x00"], "string", lambda c, k: text.clean_text(c)) == ["a bc", None, "가 나"]


def test_star_default(spark):
    assert one(spark, [None, "", "3"], "string", text.star_default) == ["5", "5", "3"]
    assert one(spark, [None, 4], "int", text.star_default) == [5, 4]


def test_integer_ids(spark):
    cases = ["1.0", "7", "x", None, " 12 ", "1e3", ""]
    assert one(spark, cases, "string", text.int_string_id) == ["1", "7", None, None, "12", "1000", None]
    assert one(spark, [1.0, float("nan"), None], "double", text.int_string_id) == ["1", None, None]
    assert one(spark, [9007199254740993], "bigint", text.int_string_id) == ["9007199254740993"]
    long = "1234567890" * 5
    assert one(spark, [long, f"-00{long}.0", "-0.", "+7", "0007", ".0", "1.5e1"], "string", text.int_string_id) == [long, f"-{long}", "0", "7", "7", "0", "15"]
    for bad in ("1.00000000001", "1e-3", "1e30", ".5", f"{long}.5"):
        with pytest.raises(Exception, match="not an integer"):
            one(spark, [bad], "string", text.int_string_id)
    for bad in (1e19, float("inf"), 0.5):
        with pytest.raises(Exception, match="not an integer"):
            normalise_ids(spark.createDataFrame([(bad,)], "a double"), ["a"]).collect()
    df = spark.createDataFrame([(c,) for c in cases], "a string")
    assert sorted(r.a for r in normalise_ids(df, ["a"]).collect()) == ["1", "1000", "12", "7"]
    assert normalise_ids(df, ["a"], drop_invalid=False).count() == len(cases)


@pytest.mark.parametrize("value,kind", [("1.5", "string"), (1.5, "double")])
def test_fractional_id_is_an_error(spark, value, kind):
    df = spark.createDataFrame([(value,)], f"a {kind}")
    with pytest.raises(Exception, match="not an integer"):
        normalise_ids(df, ["a"]).collect()


def test_timestamps(spark):
    assert one(spark, [1700000000000, 1700000000, 20000000001, None], "bigint", time.parse_timestamp) == [
        dt(2023, 11, 14, 22, 13, 20), dt(2023, 11, 14, 22, 13, 20), dt(1970, 8, 20, 11, 33, 20), None,
    ]
    assert one(spark, [1e12, 1e10, 1.5], "double", time.parse_timestamp) == [
        dt(2001, 9, 9, 1, 46, 40), dt(2286, 11, 20, 17, 46, 40), dt(1970, 1, 1, 0, 0, 1, 500000),
    ]
    assert one(spark, ["2024-01-02 03:04:05", "x", None, "2024-01-02T03:04:05Z"], "string", time.parse_timestamp) == [
        dt(2024, 1, 2, 3, 4, 5), None, None, dt(2024, 1, 2, 3, 4, 5),
    ]


def test_strict_dates_and_times(spark):
    df = spark.createDataFrame([("2024-01-02", "03:04:05"), (None, None)], "d string, t string")
    rows = df.select(time.strict_date(F.col("d")).alias("d"), time.strict_time(F.col("t")).alias("t")).collect()
    assert [tuple(r) for r in rows] == [(datetime.date(2024, 1, 2), "03:04:05"), (None, None)]
    bad = spark.createDataFrame([("2024-13-02", "25:00:00")], "d string, t string")
    for column in (time.strict_date(F.col("d")), time.strict_time(F.col("t"))):
        with pytest.raises(Exception, match="invalid"):
            bad.select(column).collect()
    with pytest.raises(Exception, match="invalid"):
        bad.select(time.join_date_and_time(F.col("d"), F.col("t"))).collect()


def test_day_fraction(spark):
    assert one(spark, [0.5, 45000.25, 0.0], "double", lambda c, k: time.day_fraction_to_text(c)) == ["12:00:00", "06:00:00", "00:00:00"]


def test_hashed_ids(spark):
    df = spark.createDataFrame([("1001",), ("1002",), ("1004",), ("x",)], "id string").withColumns(
        {"d": F.lit("2024-01-02"), "t": F.when(F.col("id") == "x", F.lit("never")).otherwise(F.lit("03:04:00"))}
    )
    got = sorted(r.id for r in hash_ids(df, "id", "d", "t").collect())
    assert got == ["2024010203042410", "2024010203043105", "2024010203046265"]
    for length in (12, 17):
        with pytest.raises(ValueError):
            hash_ids(df, "id", "d", "t", length)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(max_size=12), min_size=1, max_size=20), st.integers(1, 4))
def test_hash_digits_equal_big_integers(spark, values, digits):
    values = [v.encode("utf-8", "ignore").decode() for v in values]
    want = [str(int(hashlib.sha256(v.encode()).hexdigest(), 16) % 10**digits).zfill(digits) for v in values]
    assert one(spark, values, "string", lambda c, k: ids.sha256_digits(c, digits)) == want


def test_filters(spark):
    df = spark.createDataFrame([("Red Ring", 1), ("blue", 2)], "Name string, N int")
    assert [tuple(r) for r in filter_rows(df, {"NAME": "ri.g", "other": "x"}).collect()] == [("Red Ring", 1)]
    assert [tuple(r) for r in filter_rows(df, {"name": "BLUE", "n": 2}, contains=False).collect()] == [("blue", 2)]
    assert filter_rows(df, {"name": "x"}).columns == ["name", "n"]
    assert filter_rows(df, {}).columns == ["Name", "N"]


RECORD = (
    '{"reviewId":1,"attachment":"{\\"imageAttachments\\":[{\\"imgSrc\\":\\"u\\"}]}","goods":{"sno":7},'
    '"images":["x","{\\"a\\":1}"],"none":null,"empty":{},"list":[[1,2],3],"text":"a\\nb","flag":"true","open":"{not json"}'
)


def records(spark):
    return spark.createDataFrame([(1, RECORD)], "id int, j string").select("id", F.parse_json("j").alias("r"))


def test_flatten(spark):
    got = {r.path: r.value for r in js.flatten(records(spark), "r", ["id"]).collect()}
    assert got == {
        "reviewId": "1", "attachment.imageAttachments.1.imgSrc": "u", "goods.sno": "7", "images.1": "x",
        "images.2": '{"a":1}', "none": None, "list.1": "[1,2]", "list.2": "3", "text": "a b", "flag": "true", "open": "{not json",
    }


@pytest.mark.parametrize("levels", [1, 3, 4, 5, 12, 40])
def test_flatten_at_any_depth(spark, levels):
    nested, path = {"leaf": 1, "list": [[2, {"x": 3}], []]}, []
    for k in range(levels):
        nested, path = ({f"k{k}": nested}, [f"k{k}", *path]) if k % 3 else ({f"k{k}": ["s", nested]}, [f"k{k}", "2", *path])
    texts = [json.dumps({"deep": nested, "text": json.dumps({"in": nested})}), json.dumps({"flat": 1}), "5", "{}", None]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, j string").select("id", F.try_parse_json("j").alias("r"))
    at = ".".join(path)
    want = {(0, f"{head}.{at}.{leaf}", value) for head in ("deep", "text.in") for leaf, value in (("leaf", "1"), ("list.1", '[2,{"x":3}]'), ("list.2", "[]"))}
    got = {tuple(r) for r in js.flatten(df, "r", ["id"]).collect()}
    assert want | {(1, "flat", "1"), (2, None, "5"), (4, None, None)} == {g for g in got if g[2] != "s"}
    assert sum(g[2] == "s" for g in got) == 2 * len(range(0, levels, 3))


def test_target_keys(spark):
    keys = ["reviewId", "attachment.imageAttachments.1.imgSrc", "goods.sno", "goods", "images.2", "images.3", "none", "empty", "list.1", "text", "open"]
    row = js.target_keys(records(spark), "r", {k: f"c{i}" for i, k in enumerate(keys)}, embedded_in=["attachment"]).first()
    assert list(row) == ["1", "u", "7", None, '{"a":1}', None, None, None, "[1,2]", "a b", "{not json"]
    filled = js.target_keys(records(spark), "r", {"images.3": "a", "none": "b"}, missing="").first()
    assert list(filled) == ["", None]


def test_missing_keys(spark):
    keys = ["reviewId", "images.1", "images.3", "none", "none.a", "empty", "attachment.imageAttachments.4.imgSrc"]
    got = {r.missing_key for r in js.missing_keys(records(spark), "r", keys, ["attachment"]).collect()}
    assert got == {"images.{index}", "none.a", "empty", "attachment.imageAttachments.{index}.imgSrc"}


def test_records(spark):
    df = spark.createDataFrame([(1, '{"data":{"content":[{"a":1},{"a":2}]}}'), (2, '{"data":5}'), (3, "junk"), (4, None)], "p int, j string")
    got = [(r.p, r.position) for r in js.records(df, "j", ["data", "content"], ["p"]).orderBy("p", "position").collect()]
    assert got == [(1, 0), (1, 1)]
    nested = spark.createDataFrame([(1, '{"pages":[{"x":[1]},{"x":[{"a":3}]}]}')], "p int, j string")
    assert js.records(nested, "j", ["pages", "2", "x"], ["p"]).count() == 1


def test_flat_key_map():
    assert js.flat_key_map({"a": "x", "b.{index}.c": ("y", 2)}) == {"a": "x", "b.1.c": "y1", "b.2.c": "y2"}
    with pytest.raises(ValueError):
        js.flat_key_map({"a": ("x", 2)})


def test_whitespace_tokens(spark):
    assert one(spark, ["a b　c", " ", None, "x"], "string", lambda c, k: text.whitespace_tokens(c)) == [3, 0, 0, 1]
    assert one(spark, ["a b c"], "string", lambda c, k: text.whitespace_tokens(c, 2)) == [2]


@pytest.mark.parametrize(
    "fmt,texts",
    [
        ("%Y-%m-%d", ["2024-02-29", "2024-2-9", "1999-12-31", None]),
        ("%d.%m.%y", ["1.1.69", "31.12.68", "01.02.00"]),
        ("%B %d, %Y", ["March 5,   2021", "may 31, 1900"]),
        ("%a %d %b %Y", ["Mon 4 Mar 2024", "sun 03 DEC 2023"]),
        ("%Y%j", ["2024366", "2023001", "2023366"]),
        ("%m/%d", ["12/25", "1/2"]),
        ("100%% %Y", ["100% 2020"]),
    ],
)
def test_dates_by_format(spark, fmt, texts):
    got = one(spark, texts, "string", lambda c, _: time.parse_date_by_format(c, fmt))
    assert got == [t and dt.strptime(t, fmt).date() for t in texts]


@pytest.mark.parametrize(
    "fmt,texts",
    [
        ("%H:%M:%S", ["01:02:03", "1:2:3", "23:59:59", None]),
        ("%I:%M %p", ["12:00 AM", "12:30 pm", "1:05 PM", "11:59 am"]),
        ("%H%M%S.%f", ["010203.5", "235959.000001"]),
        ("%H", ["7"]),
    ],
)
def test_times_by_format(spark, fmt, texts):
    got = one(spark, texts, "string", lambda c, _: time.parse_time_by_format(c, fmt))
    shown = "%H:%M:%S.%f" if "%f" in fmt else "%H:%M:%S"
    assert got == [t and dt.strptime(t, fmt).strftime(shown) for t in texts]


@pytest.mark.parametrize("fmt,text", [("%Y-%m-%d", "2023-02-29"), ("%Y-%m-%d", "2023-1-1 "), ("%Y-%m-%d", ""), ("%d/%m/%Y", "13/13/2020")])
def test_texts_without_the_format_are_errors(spark, fmt, text):
    with pytest.raises(ValueError):
        dt.strptime(text, fmt)
    with pytest.raises(Exception, match="invalid date"):
        one(spark, [text], "string", lambda c, _: time.parse_date_by_format(c, fmt))


def test_formats_are_checked():
    for fmt in ("%Q", "%", "%Y %Y"):
        with pytest.raises(ValueError):
            time._compiled(fmt)


def test_postprocess_report(spark):
    from reviewloom.plans.postprocess import given_labels, postprocess_with_report
    from reviewloom.sources.declared import EXPORT_LAYOUT, OPTION_MAP

    name = EXPORT_LAYOUT.columns
    columns = [name["REVIEW_ID"], name["PRODUCT_ID"], name["REVIEW_CONTENTS"], name["REVIEW_CREATED_DATE"], name["REVIEW_CREATED_TIME"]]
    option = [f"{name['PRODUCT_OPTION_NAME']}1", f"{name['PRODUCT_OPTION_VALUE']}1"]
    rows = [
        ("1", "700", "good", "2024-01-02", "03:04:05", "a", "b"),
        ("2", "700", "good", "2024-01-02", "late", "a", "b"),  # unreadable, and without a label
        ("3", "700", "bad", "2024-01-02", "03:04:05", "a", "b"),
        ("4", "701", "good", "2024-01-02", "03:04:05", "a", "b"),
        ("5", "700", " ", "2024-01-02", "03:04:05", "a", "b"),
    ]
    df = spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in columns + option))
    options = spark.createDataFrame([("700", "bag", "red"), ("700", "bag", "blue")], ", ".join(f"`{c}` string" for c in ("브이리뷰_상품_id", "상품명", "옵션명")))
    labels = spark.createDataFrame([("1", 1), ("3", 0)], "id string, label int")
    done = postprocess_with_report(df, options, OPTION_MAP, given_labels(labels, "id"))
    assert done.steps == {"remapped": 6, "readable": 4} and done.removed == 2
    assert sorted(r.row_count for r in done.duplicates.collect()) == [2, 2]
    kept = done.rows.collect()
    assert len(kept) == 2 and all(r[name["REVIEW_ID"]].startswith("202401020304") for r in kept)
    assert done.rows.columns == df.columns
