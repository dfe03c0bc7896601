"""Sentiment labels: keep positive rows, and a naive Bayes classifier that gives the labels."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.session import stage

# Labels.
NEGATIVE = 0
POSITIVE = 1

# Words whose weights every scoring task holds. The others are joined, so the number bounds memory and not the vocabulary.
HELD_WORDS = 1 << 16


def positive_only(df: DataFrame, label: str) -> DataFrame:
    """Rows labelled positive. A row without a label is an error, not a negative."""
    value = F.col(label)
    return df.where(
        F.when(value.isNull(), F.raise_error(F.lit("a row has no label")).cast("boolean")).otherwise(value == POSITIVE)
    ).drop(label)


def keep_positive(df: DataFrame, labels: DataFrame, key: str, label: str) -> DataFrame:
    """Attach labels by key, then keep the positive rows."""
    joined = df.join(labels.select(key, F.col(label).alias("_label")), key, "left")
    return positive_only(joined, "_label").select(*df.columns)


@dataclass(frozen=True)
class WordModel:
    """Naive Bayes on words: ``words`` has one row (word, n0, n1) per word of the labelled texts, in the column ``text``."""

    text: str
    words: DataFrame
    total0: int
    total1: int
    size: int
    texts0: int
    texts1: int

    @property
    def prior(self) -> float:
        return math.log(self.texts1 + 1) - math.log(self.texts0 + 1)

    def weights(self) -> DataFrame:
        """word, n, weight: the log of the ratio of the smoothed likelihoods."""
        share = lambda n, total: F.log((F.col(n) + 1) / F.lit(float(total + self.size)))
        return self.words.select("word", (F.col("n0") + F.col("n1")).alias("n"), (share("n1", self.total1) - share("n0", self.total0)).alias("weight"))


def _words(text: Column) -> Column:
    """Lower-cased runs without white space; a null text has none."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"(?U)\s+"), lambda w: w != "")


def train_classifier(labelled: DataFrame, text: str, label: str, path: str) -> WordModel:
    """Multinomial naive Bayes on the counts of all words, smoothed by one.

    The fit is sums of counts, so the model is the same whatever the order or partitioning of the labelled rows. It is a table
    of words saved at ``path`` and loaded from there: scoring jobs share it, and it does not drag its training table along.
    """
    is_label = lambda value: F.count_if(F.col(label) == value)
    words = labelled.select(F.col(label), F.explode(_words(F.col(text))).alias("word"))
    words.groupBy("word").agg(is_label(NEGATIVE).alias("n0"), is_label(POSITIVE).alias("n1")).write.parquet(f"{path}/words")
    texts = labelled.agg(is_label(NEGATIVE).alias("texts0"), is_label(POSITIVE).alias("texts1"), F.lit(text).alias("text"))
    texts.write.parquet(f"{path}/texts")
    return load_classifier(labelled.sparkSession, path)


def load_classifier(spark: SparkSession, path: str) -> WordModel:
    words = spark.read.parquet(f"{path}/words")
    total = lambda n: F.coalesce(F.sum(n), F.lit(0))
    sums = words.agg(total("n0").alias("total0"), total("n1").alias("total1"), F.count(F.lit(1)).alias("size")).first()
    return WordModel(words=words, **sums.asDict(), **spark.read.parquet(f"{path}/texts").first().asDict())


def classify(df: DataFrame, model: WordModel, label: str = "label") -> DataFrame:
    """Adds the label of each row's text.

    Rows are written once with a number. Words of the highest counts meet their weights in a broadcast table and leave one sum per row;
    only the rarer ones, counted per row, are shuffled to the table of all words. Words that no labelled text has weigh nothing.
    """
    rows = stage(df.withColumn("_row", F.monotonically_increasing_id()), "unlabelled")
    weights = stage(model.weights(), "weights")
    held = stage(weights.orderBy(F.desc("n"), "word").limit(HELD_WORDS).select(F.col("word"), F.col("weight").alias("_weight")), "held-weights")
    words = rows.select("_row", F.explode(_words(F.col(f"`{model.text}`"))).alias("word")).join(F.broadcast(held), "word", "left")
    rare = F.when(F.col("_weight").isNull(), F.col("word")).alias("word")
    counted = stage(words.groupBy("_row", rare).agg(F.sum("_weight").alias("_score"), F.count(F.lit(1)).alias("_n")), "row-words")
    of_rare = counted.where(F.col("word").isNotNull()).join(weights, "word").select("_row", (F.col("_n") * F.col("weight")).alias("_score"))
    of_held = counted.where(F.col("word").isNull()).select("_row", "_score")
    scores = of_held.unionByName(of_rare).groupBy("_row").agg(F.sum("_score").alias("_score"))
    positive = F.coalesce(F.col("_score"), F.lit(0.0)) + F.lit(model.prior) > 0
    return rows.join(scores, "_row", "left").withColumn(label, positive.cast("int")).select(*[f"`{c}`" for c in df.columns], label)
