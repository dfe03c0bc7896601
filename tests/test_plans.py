"""What the physical plans must look like, and that hot keys are split."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from reviewloom.operators.joins import hot_keys, simple_join
from reviewloom.session import scratch_path, stage, staging
from reviewloom.files import path_exists
from reviewloom.workload.queries import QUERIES

# Rows that went through Python, joins without a key.
UNWANTED = ("PythonUDF", "ArrowEvalPython", "BatchEvalPython", "InPandas", "InArrow", "CartesianProduct", "BroadcastNestedLoopJoin")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"classify_text"}))
def test_no_python_rows_and_no_keyless_joins(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert [w for w in UNWANTED if w in text] == []


def test_scan_is_pruned_and_filtered(spark, sf_dir):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    text = plan(QUERIES["scan_spec"](spark, sf_dir))
    assert "struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double,l_shipdate:timestamp_ntz>" in text
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(l_quantity,10\.0\)", text)


@pytest.fixture
def hot(spark):
    """A third of 60000 rows under one key, in a session that splits small partitions."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    big = spark.range(0, 60000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v")
    )
    yield stage(big, "hot"), spark.range(100000).select(F.col("id").alias("key"), (F.col("id") * 2).alias("w"))
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("how,count", [("LEFT", 60000), ("INNER", 60000), ("RIGHT", 60000 + 60000), ("FULL OUTER", 60000 + 60000)])
def test_hot_keys_are_split(hot, how, count):
    big, small = hot
    joined = simple_join(big, small, {"k": "key"}, how)
    rows = joined.collect()
    # adaptive execution splits what it can; the sides it cannot split are dealt beforehand
    assert "skew=true" in plan(joined) or "_deal" in plan(joined)
    # `big` has 40000 distinct keys, all of them known, so 60000 of the known keys stay alone.
    assert len(rows) == count
    assert longest_task(joined) < 12000


def longest_task(joined):
    """Rows of the largest task of a join's output, with all columns in use."""
    of_task = joined.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n"), F.max(F.xxhash64(*joined.columns)))
    return max(r["n"] for r in of_task.collect())


@pytest.fixture
def both_hot(hot):
    """Left rows that meet a hot key on the right, and rows without a key on both sides."""
    _, small = hot
    session = small.sparkSession
    left = session.range(0, 9000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") < 4, F.lit(7)).otherwise(F.col("id")).cast("long").alias("k"), F.col("id").alias("a")
    )
    right = session.range(0, 60000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id")).cast("int").alias("key"),
        F.sha2(F.col("id").cast("string"), 256).alias("b"),
    )
    return stage(left, "left"), stage(right, "right")


@pytest.mark.parametrize("how", ["LEFT", "RIGHT", "INNER", "FULL OUTER"])
@pytest.mark.parametrize("turned", [False, True])
def test_hot_other_side_is_split(both_hot, how, turned):
    left, right = both_hot if not turned else both_hot[::-1]
    keys = {"k": "key"} if not turned else {"key": "k"}
    joined = simple_join(left, right, keys, how)
    (a, b), = keys.items()
    plain = left.join(right, left[a] == right[b], {"LEFT": "left", "RIGHT": "right", "INNER": "inner", "FULL OUTER": "full"}[how])
    bag = lambda df: Counter(map(tuple, df.collect()))
    assert bag(joined) == bag(plain)
    # three left rows meet 20000 right ones: 60000 rows of one key
    assert longest_task(joined) < 20000


def test_equal_copies_of_a_hot_key_are_split(spark, hot):
    copies = stage(spark.range(0, 60000, 1, 8).select(F.lit(5).cast("long").alias("key"), F.lit("x" * 40).alias("b")), "copies")
    one = spark.range(10).select(F.col("id").alias("k"))
    joined = simple_join(one, copies, {"k": "key"}, "LEFT")
    assert joined.count() == 60009 and longest_task(joined) < 16000


def test_hot_keys_are_found(hot, spark):
    big, small = hot
    (found,) = hot_keys(big, ["k"]).table.collect()
    assert found["k"] == 7 and 16 <= found["pieces"] <= 24
    assert hot_keys(small, ["key"]).table is None
    pairs = big.select(F.col("k"), (F.col("k") + 1).alias("m"))
    (found,) = hot_keys(pairs, ["k", "m"]).table.collect()
    assert (found["k"], found["m"]) == (7, 8)
    # a side that would be broadcast is not looked at
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "256MB")
    assert hot_keys(big, ["k"]).table is None


def test_right_join_reads_each_side_once(hot):
    big, small = hot
    assert plan(simple_join(big, stage(small, "small"), {"k": "key"}, "RIGHT")).count("FileScan") <= 3


def test_staging_removes_what_it_staged(spark):
    with staging(spark):
        kept = stage(spark.range(3), "inside")
        path = kept.inputFiles()[0].rsplit("/", 1)[0]
        assert path_exists(spark, path)
    assert not path_exists(spark, path)
    assert not path_exists(spark, scratch_path(spark, "unused"))
