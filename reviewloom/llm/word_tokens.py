"""BPE encoding through a table of distinct words, and decoding through a table of pieces.

Words are runs without ASCII white space. The tokenizer's own split never crosses white space, so a text's
ids are those of its words in order. Spark splits and counts the words; each word that is frequent enough to be shared is
encoded once, for all documents, and decoded through a join of its ids with the pieces. The documents then join
their words with that table by position. The table goes to every task, so its size is bounded: a histogram of counts gives
the smallest count that at most ``SHARED_WORDS`` words reach. Rarer words are encoded once per batch of documents
where they stand, since moving them and the ids around them would cost more than encoding them.

Cases: a null text is an empty one, and gives no ids and an empty decoded text; repeated rows keep their own rows;
an empty table gives an empty one; other columns of the input are ignored.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import AddedToken

from reviewloom.llm.common import text_steps, tidy
from reviewloom.session import stage

# Words of the table that every task holds, at most.
SHARED_WORDS = 1 << 17

# Rarer words that a task remembers before it starts anew.
RARE_WORDS = 300_000

# Words that the tokenizer gets as one text, and what stands behind each.
LINE_WORDS = 250
_END = "\n"

# Counts are compared in steps of 2^(1/4).
_STEPS_PER_DOUBLING = 4

_BLANKS = "[ \\t\\n\\x0B\\f\\r]+"


@lru_cache(maxsize=1)
def _tokenizer(tokenizer_file: str):
    from tokenizers import Tokenizer

    # a task has one core, and each thread of its own would keep memory
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokenizer = Tokenizer.from_file(tokenizer_file)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    if tokenizer.decoder is not None:
        raise ValueError("only a tokenizer whose decoder joins pieces with blanks can be decoded by pieces")
    return tokenizer


def count_words(docs: DataFrame) -> DataFrame:
    """word, n over all texts."""
    words = docs.select(F.explode(F.split("text", _BLANKS)).alias("word"))
    return words.where(F.col("word") != "").groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def shared_words(counts: DataFrame, limit: int = SHARED_WORDS) -> DataFrame:
    """The words whose count reaches the smallest step that no more than ``limit`` words reach."""
    step = F.floor(F.log2("n") * _STEPS_PER_DOUBLING).cast("int")
    total, reached = 0, None
    for row in sorted(counts.groupBy(step.alias("step")).count().collect(), reverse=True):
        total += row["count"]
        if total > limit:
            break
        reached = row["step"]
    return counts.where(F.lit(False) if reached is None else step >= reached).select("word")


def encode_words(words: DataFrame, tokenizer_file: str) -> DataFrame:
    """word, ids of distinct words."""

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(tokenizer_file)
        _tokenizer.cache_clear()
        for batch in batches:
            found = tokenizer.encode_batch_fast(batch.column("word").to_pylist(), add_special_tokens=False)
            ids = pa.array([e.ids for e in found], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("word"), ids], ["word", "ids"])

    return words.select("word").mapInArrow(tidy(encoded), "word string, ids array<int>")


def piece_table(spark: SparkSession, tokenizer_file: str) -> DataFrame:
    """id, piece of the whole vocabulary, which is as small as the tokenizer's file."""
    vocabulary = _tokenizer(tokenizer_file).get_vocab(with_added_tokens=True)
    # the driver needs the tokenizer for nothing else
    _tokenizer.cache_clear()
    return spark.createDataFrame([(i, p) for p, i in vocabulary.items()], "id int, piece string")


def decode(coded: DataFrame, key: str, tokenizer_file: str) -> DataFrame:
    """key, decoded: the pieces of ``ids`` joined by id, in order, with a blank between. Keys must be unique."""
    pieces = piece_table(coded.sparkSession, tokenizer_file)
    spread = coded.select(key, F.posexplode("ids").alias("_at", "id"))
    in_order = F.array_sort(F.collect_list(F.struct("_at", "piece")))
    texts = spread.join(pieces, "id").groupBy(key).agg(F.array_join(in_order["piece"], " ").alias("decoded"))
    return coded.select(key).join(texts, key, "left").select(key, F.coalesce("decoded", F.lit("")).alias("decoded"))


def word_table(docs: DataFrame, tokenizer_file: str, limit: int = SHARED_WORDS) -> DataFrame:
    """word, ids, decoded of the shared words."""
    counts = stage(count_words(docs), "word-counts")
    coded = stage(encode_words(shared_words(counts, limit), tokenizer_file), "coded-words")
    return coded.join(decode(coded, "word", tokenizer_file), "word")


def _joined(values: pa.Array, at: np.ndarray, first: np.ndarray) -> pa.Array:
    """The binary values at the places ``at``, those from ``first[k]`` to ``first[k + 1]`` in one."""
    taken = values.take(pa.array(at))
    offsets = np.frombuffer(taken.buffers()[1], np.int32, len(at) + 1) if len(at) else np.zeros(1, np.int32)
    return pa.Array.from_buffers(pa.binary(), len(first) - 1, [None, pa.py_buffer(offsets[first]), taken.buffers()[2] or pa.py_buffer(b"")])


class _WordTable:
    """Places of words in two arrays, of their ids and of their decoded texts: the shared ones for good, rarer ones until there are too many.

    A decoded text ends with a blank here, unless it is empty.
    """

    def __init__(self, shared: bytes, tokenizer_file: str):
        self.tokenizer = _tokenizer(tokenizer_file)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        pieces = [b""] * (max(vocabulary.values(), default=-1) + 1)
        for piece, i in vocabulary.items():
            pieces[i] = piece.encode() + b" "
        self.pieces = pa.array(pieces, pa.binary())
        # a token of its own ends a word, so that many words are encoded as one text; no word has a line break
        self.tokenizer.add_special_tokens([AddedToken(_END, normalized=False)])
        self.end = self.tokenizer.token_to_id(_END)
        table = pa.ipc.open_stream(shared).read_all()
        self.ids, self.texts = (pa.concat_arrays([pa.array([], pa.binary()), *table.column(c).cast(pa.binary()).chunks]) for c in ("ids", "decoded"))
        self.place = {w: k for k, w in enumerate(table.column("word").cast(pa.binary()).to_pylist())}
        self.shared = len(self.place)

    def learn(self, new: list[bytes]) -> None:
        """Encode words that the table lacks."""
        ids, texts = [self.ids], [self.texts]
        for low in range(0, len(new), 5000):
            coded, counts = self._encoded(new[low : low + 5000])
            first = np.concatenate([[0], np.cumsum(counts)])
            ids.append(pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer((4 * first).astype(np.int32)), pa.py_buffer(coded)]))
            texts.append(_joined(self.pieces, coded, first))
        self.place.update(zip(new, range(len(self.place), len(self.place) + len(new)), strict=True))
        self.ids, self.texts = pa.concat_arrays(ids), pa.concat_arrays(texts)

    def forget(self) -> None:
        """Drop the rarer words."""
        for word in list(self.place)[self.shared :]:
            del self.place[word]
        self.ids, self.texts = self.ids[: self.shared], self.texts[: self.shared]

    def _encoded(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words, one after the other, and how many each has."""
        end = _END.encode()
        lines = [(end.join(words[k : k + LINE_WORDS]) + end).decode() for k in range(0, len(words), LINE_WORDS)]
        ids = self._flat(lines)[0]
        ends = np.flatnonzero(ids == self.end)
        if len(ends) == len(words):
            return ids[ids != self.end], np.diff(ends, prepend=-1) - 1
        # some token of the tokenizer takes the white space around it, and the ends with it
        return self._flat([w.decode() for w in words])

    def _flat(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.fromiter(chain.from_iterable(found), "<u4"), np.fromiter(map(len, found), np.int64, len(found))

    def encode(self, texts: list[bytes]) -> tuple[pa.Array, pa.Array]:
        """Ids and decoded text of each text."""
        if len(self.place) > self.shared + RARE_WORDS:
            self.forget()
        split = [t.split() for t in texts]
        words = list(chain.from_iterable(split))
        at = np.fromiter(map(self.place.get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(at < 0).tolist()
        self.learn(list(dict.fromkeys(map(words.__getitem__, missing))))
        at[missing] = [self.place[words[i]] for i in missing]
        first = np.concatenate([[0], np.cumsum(np.fromiter(map(len, split), np.int64, len(split)))])
        # a word of characters that the tokenizer drops has no pieces and no place in the text
        return _joined(self.ids, at, first), pc.binary_slice(_joined(self.texts, at, first), 0, -1)


def encode_documents(docs: DataFrame, tokenizer_file: str, limit: int = SHARED_WORDS) -> DataFrame:
    """doc_id, n_tokens, ids (binary, little-endian u32) and decoded text of every row."""
    spark = docs.sparkSession
    shared = word_table(docs, tokenizer_file, limit)
    shared = shared.withColumn("decoded", F.when(F.col("decoded") == "", "").otherwise(F.concat("decoded", F.lit(" ")))).toArrow()
    # every task makes its table anew, so the ids go as bytes, which it only has to copy
    as_bytes = [np.array(i, "<u4").tobytes() for i in shared.column("ids").to_pylist()]
    shared = shared.set_column(shared.schema.get_field_index("ids"), "ids", pa.array(as_bytes, pa.binary()))
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, shared.schema) as writer:
        writer.write_table(shared, max_chunksize=10_000)
    held = spark.sparkContext.broadcast(sink.getvalue().to_pybytes())

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _WordTable(held.value, tokenizer_file)
        _tokenizer.cache_clear()
        for batch in batches:
            for rows, texts in text_steps(batch):
                ids, decoded = known.encode(texts)
                n_tokens = pa.array(pc.binary_length(ids).to_numpy().astype(np.int64) // 4)
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), n_tokens, ids, decoded.cast(pa.string())], ["doc_id", "n_tokens", "ids", "decoded"])

    return docs.select("doc_id", "text").mapInArrow(tidy(joined), "doc_id long, n_tokens long, ids binary, decoded string")


def word_tokens(docs: DataFrame, tokenizer_file: str, limit: int = SHARED_WORDS) -> DataFrame:
    """Digests of ``encode_documents``: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    coded = encode_documents(docs, tokenizer_file, limit)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
