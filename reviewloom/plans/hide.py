"""Hiding job: distinct ids in batches, and what the responses left out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.operators.dedupe import first_seen
from reviewloom.operators.ordering import id_batches

# Fixed value: ids per request.
HIDE_BATCH_SIZE = 100


def request_batches(ids: DataFrame, key: str, position: str, size: int = HIDE_BATCH_SIZE) -> DataFrame:
    """Distinct ids in first-seen order, one array per request."""
    return id_batches(first_seen(ids, key, position), key, "first_position", size)


def reconcile(requests: DataFrame, responses: DataFrame, batch: str, key: str) -> DataFrame:
    """Per batch the distinct ids asked for, those answered, and those asked for but not answered.

    Both sides are reduced to distinct (batch, id) pairs; one full join on the pair then feeds
    one count per batch.
    """
    asked = requests.select(batch, key).distinct().withColumn("_asked", F.lit(1))
    answered = responses.select(batch, key).distinct().withColumn("_answered", F.lit(1))
    both = asked.join(answered, [batch, key], "full")
    return both.groupBy(batch).agg(
        F.count("_asked").alias("request_count"),
        F.count("_answered").alias("response_count"),
        F.count_if(F.col("_answered").isNull()).alias("unanswered_count"),
        (F.count("_asked") == F.count("_answered")).alias("complete"),
    )
