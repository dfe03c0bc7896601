"""Target-distribution importance resampling over hashed n-grams.

Separators of a text collapse to single spaces; one overlapped regex scan then matches at every word, and the groups of a match are the spans by
which its 1-gram grows to the 2-gram and the 3-gram, so one running CRC gives the hashes of all three. Each text is scanned once: its buckets are staged as packed
16-bit numbers, and both the corpus counts and the weights are read from those.

The weight of a text is the sum of its buckets' gains, floored logarithms of the target's smoothed bucket shares over the corpus's own. Gumbel
noise from the id's hash on top of the weights turns the highest scores into a sample without replacement.

Cases: a null or wordless text has no features and weight 0, and is never drawn; rows that repeat an id are scored each by its text; score ties go to
the smaller id (null ids last), then to the text with fewer features, then to the earlier place in the staged rows; an empty corpus gives no rows, an empty target
leaves the smoothing alone. Other columns of the inputs are ignored.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.common import NO_ALNUM, text_steps
from reviewloom.operators.ordering import number_rows
from reviewloom.session import stage

# Fixed values of the sampler: buckets, which are also what smoothing adds to the totals, and units of a score.
BUCKETS = 10_000
SCALE = 1000

# A-Z to a-z, separators to spaces.
_CLEAN = bytes(b + 32 if 65 <= b <= 90 else 0x20 if NO_ALNUM[b] else b for b in range(256))
# From a word's first byte: the word, and with their spaces the one or two after it.
_GRAMS = regex.compile(rb"(?<![^ ])([^ ]++)( [^ ]++)?( [^ ]++)?(?![^ ])")


def gram_hashes(text: bytes) -> array:
    """CRC-32 of all runs of one to three words of a text."""
    clean = b" ".join(text.translate(_CLEAN).split())
    out, crc = array("I"), zlib.crc32
    add = out.append
    for match in _GRAMS.finditer(clean, overlapped=True):
        one, two, three = match.groups()
        value = crc(one)
        add(value)
        if two is not None:
            value = crc(two, value)
            add(value)
            if three is not None:
                add(crc(three, value))
    return out


def buckets_of(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """The id, n_words and the packed buckets of all features of every whole text."""

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in text_steps(batch):
                found = [(np.frombuffer(gram_hashes(t), np.uint32) % BUCKETS).astype("<u2") for t in texts]
                # n words have 3n - 3 features, but one word has one
                words = [(len(f) + 3) // 3 if len(f) > 1 else len(f) for f in found]
                packed = pa.array([f.tobytes() for f in found], pa.binary())
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(words, pa.int64()), packed], [id_column, "n_words", "buckets"])

    id_type = docs.schema[id_column].dataType.simpleString()
    return docs.select(id_column, "text").mapInArrow(scanned, f"{id_column} {id_type}, n_words long, buckets binary")


def bucket_counts(packed: DataFrame) -> DataFrame:
    """bucket, count: a task sends one row per bucket at most."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for value in batch.column(0):
                counts += np.bincount(np.frombuffer(value.as_buffer(), "<u2"), minlength=BUCKETS)
        present = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(present), pa.array(counts[present])], ["bucket", "count"])

    return packed.select("buckets").mapInArrow(counted, "bucket long, count long").groupBy("bucket").agg(F.sum("count").alias("count"))


def bucket_gains(corpus: DataFrame, target: DataFrame) -> np.ndarray:
    """Gain of every bucket from both tables of counts: ``BUCKETS`` numbers, whatever the size of the tables."""
    sides = corpus.select("bucket", F.col("count").alias("s"), F.lit(0).alias("t")).unionAll(target.select("bucket", F.lit(0), "count"))
    total_s, total_t = sides.agg(F.coalesce(F.sum("s"), F.lit(0)), F.coalesce(F.sum("t"), F.lit(0))).first()
    every = corpus.sparkSession.range(BUCKETS).select(F.col("id").alias("bucket"), F.lit(0).alias("s"), F.lit(0).alias("t"))
    counts = sides.unionAll(every).groupBy("bucket").agg(F.sum("s").cast("double").alias("s"), F.sum("t").cast("double").alias("t"))
    share = ((F.col("t") + 1) * F.lit(float(total_s + BUCKETS))) / ((F.col("s") + 1) * F.lit(float(total_t + BUCKETS)))
    rows = counts.select("bucket", F.floor(SCALE * F.log(share)).alias("gain")).collect()
    gains = np.zeros(BUCKETS, np.int64)
    gains[[r["bucket"] for r in rows]] = [r["gain"] for r in rows]
    return gains


def weighted(packed: DataFrame, gains: np.ndarray, seed: int, id_column: str = "doc_id") -> DataFrame:
    """The id, n_words, n_features, weight and score of every row."""
    held = packed.sparkSession.sparkContext.broadcast(gains)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.frombuffer(value.as_buffer(), "<u2") for value in batch.column("buckets")]
            weights = pa.array([int(held.value[f].sum()) for f in found], pa.int64())
            counts = pa.array([len(f) for f in found], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_column), batch.column("n_words"), counts, weights], [id_column, "n_words", "n_features", "weight"]
            )

    id_type = packed.schema[id_column].dataType.simpleString()
    rows = packed.mapInArrow(summed, f"{id_column} {id_type}, n_words long, n_features long, weight long")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_column).cast("string"), F.lit(""))), 256)
    drawn = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    return rows.withColumn("score", F.col("weight") + F.floor(-SCALE * F.log(-F.log(drawn))))


def resample(docs: DataFrame, target: DataFrame, percent: int = 5, min_words: int = 20, seed: int = 42) -> DataFrame:
    """doc_id, n_features, weight, score of every document, and the rank of the drawn ones.

    Of the documents with ``min_words`` words, ``percent`` of a hundred are drawn. The rows are numbered in the order of the draw by
    range partitions, so no task sees more than its share of them.
    """
    packed = stage(buckets_of(docs), "buckets")
    wanted = buckets_of(target.select(F.lit(0).alias("doc_id"), "text"))
    gains = bucket_gains(stage(bucket_counts(packed), "corpus-counts"), stage(bucket_counts(wanted), "target-counts"))
    scored = stage(weighted(packed, gains, seed), "scored")
    eligible = F.col("n_words") >= min_words
    drawn = scored.where(eligible).count() * percent // 100
    order = [eligible.desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features")]
    numbered = number_rows(scored, order, "place", scanned=True)
    rank = F.when(eligible & (F.col("place") <= drawn), F.col("place"))
    return numbered.select("doc_id", "n_features", "weight", "score", rank.alias("rank"))


def drawn_documents(docs: DataFrame, ranked: DataFrame) -> DataFrame:
    """Documents whose id was drawn, whole; where rows repeat an id, all of them."""
    ids = ranked.where("rank is not null").select("doc_id").distinct()
    return docs.join(ids, "doc_id", "left_semi").select(*docs.columns)
