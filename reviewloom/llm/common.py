"""Helpers the operators of this folder share: table scans, byte-level words, Arrow slices."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Text that one numpy step works on. A longer text makes a step of its own.
STEP_BYTES = 2 << 20

# Fixed values of the word hash: the multiplier (odd) of the polynomial and its inverse modulo 2^64.
_P = 0x9E3779B97F4A7C15
_P_INVERSE = pow(_P, -1, 1 << 64)
_BYTE_VALUES = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def clean_worker() -> None:
    """Give back the memory that tasks left in this worker, which runs the tasks of a whole application, or an operator in the driver's Python."""
    _powers_cache.update(_no_powers())
    gc.collect()
    pa.default_memory_pool().release_unused()
    # freed blocks of numpy stay with the C library until it is told; not every C library can be
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``function``, whose tasks give back their memory when they end: while stages without Python run, idle workers still count for their executor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        clean_worker()
        try:
            yield from function(batches)
        finally:
            clean_worker()

    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_crc(doc_id: str = "doc_id") -> Column:
    """crc32 of an id as text, for folds. Null ids count as an empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))


def steps(lengths: np.ndarray, limit: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Cut consecutive rows into ranges of about ``limit`` bytes, one row at least."""
    total = np.cumsum(lengths)
    low = 0
    while low < len(lengths):
        done = total[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(total, done + limit, "right")))
        yield low, high
        low = high


def text_steps(batch: pa.RecordBatch, column: str = "text", limit: int = STEP_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of an Arrow batch with their texts as UTF-8 bytes; a null text counts as empty."""
    texts = batch.column(column).cast(pa.binary())
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    for low, high in steps(sizes, limit):
        yield batch.slice(low, high - low), [t or b"" for t in texts.slice(low, high - low).to_pylist()]


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser, so that all bits of a hash depend on all bits of its input."""
    values = values ^ (values >> np.uint64(30))
    values *= np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


def _no_powers() -> dict[str, np.ndarray]:
    return {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


_powers_cache = _no_powers()


def _powers(kind: str, count: int) -> np.ndarray:
    if len(_powers_cache[kind]) < count:
        base = np.full(count, _P if kind == "up" else _P_INVERSE, np.uint64)
        base[0] = 1
        _powers_cache[kind] = np.multiply.accumulate(base)
    return _powers_cache[kind][:count]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Running polynomial sums of a byte array; see ``span_hashes``."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[data] * _powers("up", max(1, len(data)))[: len(data)], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans: equal bytes, equal hash, wherever they stand."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    scale = _powers("down", len(sums))
    return mixed((sums[ends] - sums[starts]) * scale[starts] + (ends - starts).astype(np.uint64))


def window_hashes(sums: np.ndarray, size: int) -> np.ndarray:
    """``span_hashes`` of the spans of ``size`` bytes at every place."""
    values = sums[size:] - sums[:-size]
    values *= _powers("down", len(sums))[: len(values)]
    values += np.uint64(size)
    return mixed(values)


class Words:
    """Words of some texts: hash and text number of each, in order.

    ``separators`` is a table of 256 booleans, true for bytes between words. Words are runs of the
    other bytes and never cross texts. ``lower`` folds A-Z first.
    """

    def __init__(self, texts: list[bytes], separators: np.ndarray, lower: bool = True):
        joined = b"\x00".join(texts)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.data = np.frombuffer(joined, np.uint8)
        self.text_start = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]]) if len(texts) else np.zeros(0, np.int64)
        data = self.data
        if lower:
            data = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
        inside = np.zeros(len(data) + 2, bool)
        inside[1:-1] = ~separators[data]
        # the bytes between texts are none of theirs, whatever the separators are
        inside[self.text_start[1:]] = False
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        self.starts, self.ends = edges[0::2], edges[1::2]
        self.sums = prefix_hashes(data)
        self.hashes = span_hashes(self.sums, self.starts, self.ends)
        self.text_of = np.searchsorted(self.text_start, self.starts, "right") - 1
        self.counts = np.bincount(self.text_of, minlength=len(texts))
        self.first = np.concatenate([[0], np.cumsum(self.counts)])


def separator_table(*ranges: tuple[int, int]) -> np.ndarray:
    out = np.zeros(256, bool)
    for low, high in ranges:
        out[low : high + 1] = True
    return out


# White space of the word rules; everything ASCII but letters and digits.
BLANKS = separator_table((0x20, 0x20), (0x09, 0x0D))
NO_ALNUM = separator_table((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
