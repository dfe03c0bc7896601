"""Toxicity scores from a factorization machine over hashed terms.

A text's terms are its distinct words and the distinct beginnings of its words, hashed into ``BUCKETS``. Of the buckets seen in training those with the
highest chi-square against the label, above ``MIN_CHI``, are features; each has a weight and a vector, and a text's logit is

    bias + sum of weights + mean over its features of the products of their vectors with those of the others

so that two terms together may weigh more, or less, than both alone. The fit is a mini-batch Adam in numpy on at most ``MAX_TRAIN``
labelled texts, the ones with the smallest hash of their id; the model has a fixed size and is broadcast.

Cases: null and empty texts have no terms and score the model's bias; without labels of both kinds the score is the smoothed share of label 1;
a document with several labels counts once, with the highest; null labels and labels of unknown documents are not used; rows that repeat an id get
their own scores; an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.common import NO_ALNUM, Words, mixed, span_hashes, text_steps

# Labelled texts that the fit reads, at most.
MAX_TRAIN = 20_000

BUCKETS = 1 << 18
FEATURES = 8192
MIN_TEXTS = 3
MIN_CHI = 15.0
# Bytes of the beginnings that are terms beside the whole word.
BEGINNINGS = (5, 6, 7)
FACTORS = 8

_EPOCHS = 15
_BATCH = 128
_RATE = 0.02
_DECAY = 3e-4
_SEED = 11


def terms(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Text numbers and buckets of the distinct terms, in order of the texts."""
    words = Words(texts, NO_ALNUM)
    numbers, hashes = [words.text_of], [words.hashes]
    for size in BEGINNINGS:
        longer = words.ends - words.starts > size
        numbers.append(words.text_of[longer])
        hashes.append(mixed(span_hashes(words.sums, words.starts[longer], words.starts[longer] + size) ^ np.uint64(size)))
    buckets = (np.concatenate(hashes) & np.uint64(BUCKETS - 1)).astype(np.int64)
    pairs = np.unique(np.concatenate(numbers).astype(np.int64) * BUCKETS + buckets)
    return pairs // BUCKETS, pairs % BUCKETS


@dataclass
class Machine:
    feature_of: np.ndarray  # feature number of each bucket, -1 for none
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def logits(self, rows: np.ndarray, features: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Logits, the summed vectors and the number of features of each text."""
        vectors = self.factors[features]
        sums = np.stack([np.bincount(rows, vectors[:, f], count) for f in range(vectors.shape[1])], 1)
        squares = np.bincount(rows, (vectors**2).sum(1), count)
        linear = np.bincount(rows, self.weights[features], count)
        sizes = np.maximum(np.bincount(rows, minlength=count), 1)
        return self.bias + linear + ((sums**2).sum(1) - squares) / (2 * sizes), sums, sizes

    def select(self, rows: np.ndarray, buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        features = self.feature_of[buckets]
        keep = features >= 0
        return rows[keep], features[keep]

    def score(self, texts: list[bytes]) -> np.ndarray:
        rows, features = self.select(*terms(texts))
        logits, _, _ = self.logits(rows, features, len(texts))
        return 1 / (1 + np.exp(-np.clip(logits, -60, 60)))


def _features(rows: np.ndarray, buckets: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Buckets with the highest chi-square, ties to the smaller bucket."""
    seen = np.bincount(buckets, minlength=BUCKETS).astype(float)
    ones = np.bincount(buckets, labels[rows], minlength=BUCKETS)
    n, positive = len(labels), labels.sum()
    expected = seen * positive / n
    spread = expected * (1 - positive / n) * (1 - seen / n)
    chi = np.where((seen >= MIN_TEXTS) & (spread > 0), (ones - expected) ** 2 / np.where(spread > 0, spread, 1), 0.0)
    best = np.argsort(-chi, kind="stable")[:FEATURES]
    out = np.full(BUCKETS, -1)
    chosen = np.sort(best[chi[best] >= MIN_CHI])
    out[chosen] = np.arange(len(chosen))
    return out


def fit(rows: np.ndarray, buckets: np.ndarray, labels: np.ndarray) -> Machine:
    """Fit to texts given as (text number, bucket) pairs in order of the texts."""
    share = (labels.sum() + 1) / (len(labels) + 2)
    nothing = Machine(np.full(BUCKETS, -1), float(np.log(share / (1 - share))), np.zeros(1), np.zeros((1, FACTORS)))
    if len(np.unique(labels)) < 2:
        return nothing
    feature_of = _features(rows, buckets, labels)
    size = max(1, int(feature_of.max()) + 1)
    rng = np.random.default_rng(_SEED)
    machine = Machine(feature_of, nothing.bias, np.zeros(size), rng.normal(0, 0.02, (size, FACTORS)))
    rows, features = machine.select(rows, buckets)
    ends = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=len(labels)))])
    moments = [np.zeros((2, size)), np.zeros((2, size, FACTORS)), np.zeros(2)]
    step = 0
    for _ in range(_EPOCHS):
        shuffled = rng.permutation(len(labels))
        for low in range(0, len(labels), _BATCH):
            texts = shuffled[low : low + _BATCH]
            own = np.concatenate([np.arange(ends[t], ends[t + 1]) for t in texts])
            sizes = ends[texts + 1] - ends[texts]
            r, f = np.repeat(np.arange(len(texts)), sizes), features[own]
            logits, sums, counts = machine.logits(r, f, len(texts))
            error = (1 / (1 + np.exp(-np.clip(logits, -60, 60))) - labels[texts]) / len(texts)
            vectors = machine.factors[f]
            pull = (error / counts)[r][:, None] * (sums[r] - vectors)
            grads = [
                np.bincount(f, error[r], size) + _DECAY * machine.weights,
                np.stack([np.bincount(f, pull[:, k], size) for k in range(FACTORS)], 1) + _DECAY * machine.factors,
                error.sum(),
            ]
            step += 1
            moves = []
            for grad, moment in zip(grads, moments, strict=True):
                moment[0] = 0.9 * moment[0] + 0.1 * grad
                moment[1] = 0.999 * moment[1] + 0.001 * grad**2
                moves.append(_RATE * (moment[0] / (1 - 0.9**step)) / (np.sqrt(moment[1] / (1 - 0.999**step)) + 1e-8))
            machine.weights -= moves[0]
            machine.factors -= moves[1]
            machine.bias -= float(moves[2])
    return machine


def train(docs: DataFrame, labels: DataFrame, learnable: Column) -> Machine:
    """Fit to documents that have a label and are ``learnable`` (a condition on doc_id).

    At most ``MAX_TRAIN`` ids are chosen before the texts are read, which bounds what is broadcast and collected.
    """
    one = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & learnable).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_TRAIN)
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data in text_steps(batch):
                number, buckets = terms(data)
                cut = np.concatenate([[0], np.cumsum(np.bincount(number, minlength=len(data)))])
                lists = pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(buckets, pa.int32()))
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), rows.column("toxic").cast(pa.int32()), lists], ["doc_id", "toxic", "terms"])

    # a repeated id would pass the bound: one row per id
    rows = texts.mapInArrow(hashed, "doc_id long, toxic int, terms array<int>")
    found = rows.groupBy("doc_id").agg(F.min(F.struct("terms", "toxic")).alias("r")).select("doc_id", "r.*").orderBy("doc_id").toArrow()
    lists = found.column("terms").combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) and lists.num_chunks else lists
    sizes = np.array([len(x) for x in lists], np.int64) if found.num_rows else np.zeros(0, np.int64)
    buckets = np.concatenate([np.zeros(0, np.int64), *(x.values.to_numpy() for x in lists)]) if found.num_rows else np.zeros(0, np.int64)
    toxic = np.array(found.column("toxic").to_pylist(), float)
    return fit(np.repeat(np.arange(len(sizes)), sizes), buckets.astype(np.int64), (toxic > 0).astype(float))


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """doc_id, score of every whole text."""
    held = docs.sparkSession.sparkContext.broadcast(machine)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in text_steps(batch):
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(held.value.score(texts), pa.float64())], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(scored, "doc_id long, score double")


def toxicity(docs: DataFrame, labels: DataFrame, held_out: Column) -> DataFrame:
    """doc_id, held_out, score, predicted; held-out documents teach nothing."""
    machine = train(docs, labels, ~held_out)
    scored = score(docs, machine)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
