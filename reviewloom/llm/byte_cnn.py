"""Language ID by a convolutional network over bytes, in numpy.

Bytes are folded (A-Z lowered; digits, marks and control characters to blanks), embedded, and convolved by filters of several widths.
Each filter's maximum over a window of ``WINDOW_BYTES`` feeds a softmax over the languages. A text is cut into such
windows, the last one padded; its probabilities are the means over all its windows.

The network is trained on windows of at most ``MAX_TRAIN`` labelled texts, ``WINDOWS_PER_TEXT`` of each: of every language in turn the ones with the
smallest hash of their id. It has a fixed size and is broadcast.

Cases: null texts and texts without a letter are ``und`` with score 0, and so is everything when no labelled text was found; rows that
repeat an id are predicted each; an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom.llm.common import text_steps, tidy

# Labelled texts that the training reads, at most, and windows of each.
MAX_TRAIN = 3000
WINDOWS_PER_TEXT = 4

WINDOW_BYTES = 192
WIDTHS = (2, 3, 4)
FILTERS = 12
EMBEDDING = 8

_EPOCHS = 6
_BATCH = 64
_RATE = 0.01
_SEED = 5
_CHUNK = 64

_LETTER = regex.compile(r"\p{L}")
UNKNOWN = "und"


def _folds() -> np.ndarray:
    out = np.arange(256, dtype=np.uint8)
    letters = np.zeros(256, bool)
    letters[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
    out[65:91] += 32
    out[~letters] = 32
    return out


_FOLD = _folds()


def windows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All windows of the texts, and the text number of each; an empty text has one blank window."""
    counts = np.array([max(1, -(-len(t) // WINDOW_BYTES)) for t in texts], np.int64)
    padded = b"".join(t.ljust(n * WINDOW_BYTES) for t, n in zip(texts, counts.tolist(), strict=True))
    return _FOLD[np.frombuffer(padded, np.uint8)].reshape(-1, WINDOW_BYTES), np.repeat(np.arange(len(texts)), counts)


@dataclass
class Network:
    languages: list[str]
    embedding: np.ndarray  # byte, value
    kernels: np.ndarray  # offset and value, filter; narrower filters have zeros behind their width
    kernel_bias: np.ndarray
    dense: np.ndarray
    dense_bias: np.ndarray

    def columns(self, data: np.ndarray) -> np.ndarray:
        """Embedded bytes of every place of the widest filter: window, place, offset and value."""
        embedded = self.embedding[data].reshape(len(data), -1)
        places = data.shape[1] - max(WIDTHS) + 1
        size = max(WIDTHS) * EMBEDDING
        view = np.lib.stride_tricks.as_strided(
            embedded, (len(data), places, size), (embedded.strides[0], EMBEDDING * embedded.itemsize, embedded.itemsize), writeable=False
        )
        return np.ascontiguousarray(view)

    def pooled(self, columns: np.ndarray) -> np.ndarray:
        """Response of every filter at every place."""
        return (columns.reshape(-1, columns.shape[2]) @ self.kernels).reshape(len(columns), columns.shape[1], -1)

    def head(self, peaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hidden = np.maximum(peaks + self.kernel_bias, 0)
        logits = hidden @ self.dense + self.dense_bias
        odds = np.exp(logits - logits.max(1, keepdims=True))
        return hidden, odds / odds.sum(1, keepdims=True)

    def probabilities(self, data: np.ndarray) -> np.ndarray:
        out = np.empty((len(data), len(self.languages)), np.float32)
        for low in range(0, len(data), _CHUNK):
            responses = self.pooled(self.columns(data[low : low + _CHUNK]))
            out[low : low + _CHUNK] = self.head(responses.max(1))[1]
        return out

    def predict(self, texts: list[bytes]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text."""
        lettered = np.array([_LETTER.search(t.decode()) is not None for t in texts], bool)
        if not self.languages:
            lettered[:] = False
        names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if lettered.any():
            data, text_of = windows([t for t, ok in zip(texts, lettered, strict=True) if ok])
            found = self.probabilities(data)
            sums = np.stack([np.bincount(text_of, found[:, k]) for k in range(found.shape[1])], 1)
            means = sums / np.bincount(text_of)[:, None]
            best = means.argmax(1)
            scores[lettered] = np.clip(means.max(1), 0, 1)
            for at, language in zip(np.flatnonzero(lettered), best, strict=True):
                names[at] = self.languages[language]
        return names, scores


def fit(texts: list[bytes], labels: list[str]) -> Network:
    """Train on whole windows spread evenly over each text. Languages are in the order of their names."""
    languages = sorted(set(labels))
    rng = np.random.default_rng(_SEED)
    count, size = FILTERS * len(WIDTHS), max(WIDTHS) * EMBEDDING
    mask = np.zeros((size, count), np.float32)
    for k, width in enumerate(WIDTHS):
        mask[: width * EMBEDDING, k * FILTERS : (k + 1) * FILTERS] = 1
    start = lambda *shape: rng.normal(0, 1, shape).astype(np.float32)
    net = Network(
        languages, start(256, EMBEDDING) * 0.5, start(size, count) * mask * np.float32(size**-0.5),
        np.zeros(count, np.float32), start(count, max(1, len(languages))) * np.float32(count**-0.5), np.zeros(max(1, len(languages)), np.float32),
    )
    if len(languages) < 1:
        return net
    data, text_of = windows(texts)
    place = np.arange(len(text_of)) - np.searchsorted(text_of, text_of)
    total = np.bincount(text_of)[text_of]
    stride = -(-total // WINDOWS_PER_TEXT)
    # a text's last window is mostly padding
    chosen = (place % stride == 0) & ((place < total - 1) | (total == 1))
    data, target = data[chosen], np.array([languages.index(x) for x in labels])[text_of[chosen]]
    params = [net.embedding, net.kernels, net.kernel_bias, net.dense, net.dense_bias]
    moments = [np.zeros((2, *p.shape), np.float32) for p in params]
    step = 0
    for _ in range(_EPOCHS):
        shuffled = rng.permutation(len(data))
        for low in range(0, len(data), _BATCH):
            x, y = data[shuffled[low : low + _BATCH]], target[shuffled[low : low + _BATCH]]
            columns = net.columns(x)
            responses = net.pooled(columns)
            peak_at = responses.argmax(1)
            hidden, odds = net.head(np.take_along_axis(responses, peak_at[:, None], 1)[:, 0])
            error = odds.copy()
            error[np.arange(len(y)), y] -= 1
            error /= len(y)
            back = (error @ net.dense.T) * (hidden > 0)
            # only the places of the maxima have a gradient: window, filter, offset and value
            inputs = columns[np.arange(len(x))[:, None], peak_at]
            to_bytes = (back[:, :, None] * net.kernels.T[None]).reshape(len(x), count, max(WIDTHS), EMBEDDING)
            used = x[np.arange(len(x))[:, None, None], peak_at[:, :, None] + np.arange(max(WIDTHS))]
            embedding = np.zeros_like(net.embedding)
            np.add.at(embedding, used.reshape(-1), to_bytes.reshape(-1, EMBEDDING))
            grads = [embedding, np.einsum("nf,nfs->sf", back, inputs) * mask, back.sum(0), hidden.T @ error, error.sum(0)]
            step += 1
            for p, grad, moment in zip(params, grads, moments, strict=True):
                moment[0] = 0.9 * moment[0] + 0.1 * grad
                moment[1] = 0.999 * moment[1] + 0.001 * grad**2
                p -= np.float32(_RATE) * (moment[0] / (1 - 0.9**step)) / (np.sqrt(moment[1] / (1 - 0.999**step)) + np.float32(1e-7))
    return net


def train(docs: DataFrame, learnable: Column) -> Network:
    """Fit to documents with a language that are ``learnable`` (a condition on doc_id): at most ``MAX_TRAIN`` of them.

    The languages take turns, so each has its share of the texts, or all that it has, however rare it is.
    """
    named = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & learnable).select("doc_id", "lang", "text")
    ids = named.groupBy("doc_id").agg(F.min("lang").alias("lang")).withColumn("draw", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)))
    counts = ids.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    # of a frequent language about twice as many ids as could be asked for meet in a task: those with the smallest draws
    few = ids.join(counts, "lang").where(F.col("draw").cast("double") * F.col("n") <= 2.0 * MAX_TRAIN * (1 << 40))
    turns = few.withColumn("turn", F.row_number().over(Window.partitionBy("lang").orderBy("draw", "doc_id")))
    chosen = turns.orderBy("turn", "draw", "doc_id").limit(MAX_TRAIN).select("doc_id")
    # a long text is thinned to evenly spread stretches before it is moved; the windows are cut from those
    stretch, count = 2 * WINDOW_BYTES, F.floor(F.length("text") / WINDOWS_PER_TEXT).cast("int")
    spread = F.transform(F.sequence(F.lit(0), F.lit(WINDOWS_PER_TEXT - 1)), lambda k: F.substring(F.col("text"), k * count + 1, F.lit(stretch)))
    thin = F.when(F.length("text") > WINDOWS_PER_TEXT * stretch, F.array_join(spread, " ")).otherwise(F.col("text"))
    texts = named.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min(F.struct("lang", thin.alias("text"))).alias("r"))
    rows = texts.orderBy("doc_id").select("r.*").collect()
    return fit([r["text"].encode() for r in rows], [r["lang"] for r in rows])


def detect(docs: DataFrame, network: Network) -> DataFrame:
    """``docs`` with lang_pred and score of every whole text; columns of these names are replaced."""
    held = docs.sparkSession.sparkContext.broadcast(network)
    columns = [c for c in docs.columns if c not in ("lang_pred", "score")]

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in text_steps(batch):
                names, scores = held.value.predict(texts)
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(names, pa.string()), pa.array(scores)], [*columns, "lang_pred", "score"])

    source = docs.select(*columns)
    return source.mapInArrow(tidy(predicted), T.StructType(list(source.schema.fields)).add("lang_pred", "string").add("score", "double"))


def known(docs: DataFrame, network: Network, least: float) -> DataFrame:
    """Rows of ``docs``, with all their columns, whose text has a language of which the network is as sure as ``least``."""
    held = docs.sparkSession.sparkContext.broadcast(network)

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in text_steps(batch):
                names, scores = held.value.predict(texts)
                yield rows.filter(pa.array([n != UNKNOWN and s >= least for n, s in zip(names, scores, strict=True)], pa.bool_()))

    return docs.mapInArrow(tidy(chosen), docs.schema)


def language_id(docs: DataFrame, held_out: Column) -> DataFrame:
    """doc_id, held_out, lang_pred, score; held-out documents teach nothing."""
    found = detect(docs.select("doc_id", "text"), train(docs, ~held_out)).drop("text")
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
