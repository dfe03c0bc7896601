"""Batches of texts with similar token counts, so that padding stays small."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.operators.ordering import number_rows
from reviewloom.session import stage

# Fixed value: share of its tokens a bucket may keep when it has to be split again.
RESPLIT_RATIO = 0.7


def fill_buckets(histogram: Iterable[tuple[int, int]], cap: int, ratio: float) -> list[tuple[int, int, int, int, int]]:
    """Greedy filling on ``(tokens, rows)`` pairs in ascending order.

    A bucket takes the next row while ``tokens * (rows + 1) <= cap`` and ``smallest / tokens >=
    ratio``; its first row is always taken. Rows of equal token count fill the open bucket and
    then equal ones, so every token count needs two runs at most. A run ``(tokens, first, rows,
    bucket, per_bucket)`` says that row ``j`` of that token count, ``first <= j < first + rows``,
    is in bucket ``bucket + (j - first) // per_bucket``.
    """
    runs = []
    bucket, filled, smallest = -1, 0, 0
    for tokens, rows in histogram:
        if tokens < 1:
            raise ValueError("token counts start at 1")
        first = 0
        if filled and smallest / tokens >= ratio:
            first = min(rows, max(0, cap // tokens - filled))
            if first:
                runs.append((tokens, 0, first, bucket, first))
                filled += first
        rest = rows - first
        if rest:
            per_bucket = max(1, cap // tokens) if ratio <= 1 else 1
            runs.append((tokens, first, rest, bucket + 1, per_bucket))
            opened = -(-rest // per_bucket)
            bucket += opened
            filled, smallest = rest - (opened - 1) * per_bucket, tokens
    return runs


def token_buckets(df: DataFrame, tokens: str, ordinal: str, cap: int, ratio: float) -> DataFrame:
    """``(ordinal, tokens, bucket)`` with the 0-based bucket of every row; ``ordinal`` is unique.

    Token counts are staged next to their ordinals, because they are needed three times and texts
    are not. Only the histogram of token counts comes to the driver; it has one row per token
    count and token counts are truncated. Rows are numbered in parallel and look their bucket up
    by range.
    """
    spark = df.sparkSession
    counted = stage(df.select(F.col(ordinal), F.col(tokens).cast("bigint").alias(tokens)), "token-counts")
    histogram = counted.groupBy(tokens).agg(F.count(F.lit(1)).alias("n")).collect()
    counts = sorted((row[tokens], row["n"]) for row in histogram)
    starts, total = {}, 0
    for t, n in counts:
        starts[t] = total
        total += n
    runs = spark.createDataFrame(
        [(t, starts[t] + first, starts[t] + first + rows, bucket, per) for t, first, rows, bucket, per in fill_buckets(counts, cap, ratio)],
        "_t bigint, _from bigint, _to bigint, _bucket bigint, _per bigint",
    )
    numbered = number_rows(counted, [F.col(tokens), F.col(ordinal)], "_rank", scanned=True)
    rank = F.col("_rank") - 1
    joined = numbered.join(
        F.broadcast(runs), (F.col(tokens) == F.col("_t")) & (rank >= F.col("_from")) & (rank < F.col("_to"))
    )
    bucket = F.col("_bucket") + F.floor((rank - F.col("_from")) / F.col("_per"))
    return joined.select(ordinal, tokens, bucket.alias("bucket"))


def resplit_buckets(bucketed: DataFrame, tokens: str, ordinal: str, ratio: float = RESPLIT_RATIO) -> DataFrame:
    """Split every bucket again with ``max(int(total * ratio), 1)`` tokens as cap and no padding rule.

    Adds the 0-based ``part`` inside the old bucket. The greedy step is a fold over the bucket's histogram of token counts: the rows of one
    count fill the open part first, and then parts of equal size, so a row's part follows from its place among the rows of its count. Rows are never
    gathered, and the work is linear in them.
    """
    size, big = F.col(tokens).cast("bigint"), lambda n: F.lit(n).cast("bigint")
    counts = bucketed.groupBy("bucket", size.alias("t")).agg(F.count(F.lit(1)).alias("n"))
    of_bucket = counts.groupBy("bucket").agg(F.array_sort(F.collect_list(F.struct("t", "n"))).alias("_counts"), F.sum(F.col("t") * F.col("n")).alias("_total"))
    capped = of_bucket.withColumn("_cap", F.greatest(F.floor(F.col("_total") * ratio).cast("bigint"), big(1)))
    run = "array<struct<t:bigint,open:bigint,first:bigint,next:bigint,per:bigint>>"
    start = F.struct(big(-1).alias("part"), big(0).alias("filled"), F.array().cast(run).alias("runs"))

    def place(state, entry):
        # integer division throughout: token counts are at least one
        fitting = F.call_function("div", F.col("_cap"), entry["t"])
        first = F.when(state["part"] < 0, big(0)).otherwise(F.least(entry["n"], F.greatest(big(0), fitting - state["filled"])))
        per, rest = F.greatest(big(1), fitting), entry["n"] - first
        opened = F.call_function("div", rest + per - 1, per)
        placed = F.struct(entry["t"].alias("t"), state["part"].alias("open"), first.alias("first"), (state["part"] + 1).alias("next"), per.alias("per"))
        return F.struct(
            (state["part"] + opened).alias("part"),
            F.when(opened > 0, rest - (opened - 1) * per).otherwise(state["filled"] + first).alias("filled"),
            F.concat(state["runs"], F.array(placed)).alias("runs"),
        )

    runs = capped.select("bucket", F.explode(F.aggregate("_counts", start, place, lambda state: state["runs"])).alias("_r")).select("bucket", "_r.*")
    ranked = bucketed.select("bucket", size.alias(tokens), ordinal, (F.row_number().over(Window.partitionBy("bucket", size).orderBy(ordinal)) - 1).alias("_j"))
    j = F.col("_j").cast("bigint")
    part = F.when(j < F.col("first"), F.col("open")).otherwise(F.col("next") + F.call_function("div", j - F.col("first"), F.col("per")))
    joined = ranked.withColumnRenamed(tokens, "t").join(runs, ["bucket", "t"])
    return joined.select("bucket", F.col("t").alias(tokens), ordinal, part.alias("part"))
