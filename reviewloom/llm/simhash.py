"""SimHash fingerprints, and all fingerprints within a Hamming radius through permuted block tables.

Terms are words and pairs of adjacent words; a term weighs 1 + floor(log2 of its count in the text). Every term hash votes with its weight on each
of ``BITS`` signed bits, and a fingerprint has a one where the votes are positive.

For the radius r, the bits are cut into ``blocks`` > r blocks. Two fingerprints within the radius agree on at least blocks - r of them, so for every
choice of that many blocks there is a table keyed by them, and each pair is found in some table. It is compared in the tables
in which it meets, and counted in the first of them only. Equal fingerprints are one row throughout.

A text is compared with an edited text, whose last half comes from the document after it in descending doc_id. The texts are range-partitioned,
neighbours meet inside a partition, and only the two rows at either side of a partition's border are joined afterwards.

Cases: a null text counts as empty and has the fingerprint without any one; null ids come last; rows that repeat an id follow one another in the order of
the table's files; a single row is its own successor; an empty table gives no rows. Other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.llm.common import BLANKS, Words, mixed, steps, text_steps
from reviewloom.session import stage

# Bits of a fingerprint, a multiple of 64; the default radius and number of blocks.
BITS = 128
RADIUS, BLOCKS = 3, 5

# Text that one step counts.
VOTE_BYTES = 256 << 10

# Bits of a term's hash, and the odd numbers that pairs and the 64-bit parts of a fingerprint start from.
_TERM_BITS = 48
_PAIR = np.uint64(0xD6E8FEB86659FD93)
_PARTS = np.random.default_rng(20240613).integers(1, 1 << 63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BITS_OF_BYTE = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.float64)


def _weighted_terms(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, hash and weight of the distinct terms of each text, by text."""
    h, text = words.hashes, words.text_of.astype(np.uint64)
    paired = text[1:] == text[:-1]
    pairs = mixed(h[:-1] * _PAIR + h[1:])[paired]
    # one sort by text and term: the text's number takes the place of the lowest bits of the hash
    low = np.uint64(_TERM_BITS)
    keys = (np.concatenate([text, text[1:][paired]]) << low) | (np.concatenate([h, pairs]) >> np.uint64(64 - _TERM_BITS))
    keys.sort()
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    counts, keys = np.diff(np.append(first, len(keys))), keys[first]
    return (keys >> low).astype(np.int64), keys & np.uint64((1 << _TERM_BITS) - 1), np.frexp(counts)[1]


def _fingerprints_of_step(texts: list[bytes], bits: int) -> np.ndarray:
    of_text, terms, weights = _weighted_terms(Words(texts, BLANKS))
    row, weights = of_text * 256, weights.astype(np.float64)
    totals = np.bincount(of_text, weights, len(texts))[:, None]
    out = np.zeros((len(texts), bits), bool)
    for part in range(bits // 64):
        hashes = mixed((terms + np.uint64(1)) * _PARTS[part]).astype(">u8").view(np.uint8).reshape(-1, 8)
        for at in range(8):
            # terms that agree in a byte vote alike: their weights are summed first
            sums = np.bincount(row + hashes[:, at], weights, 256 * len(texts)).reshape(-1, 256)
            ones = 64 * part + 8 * at
            out[:, ones : ones + 8] = 2 * (sums @ _BITS_OF_BYTE) > totals
    return np.packbits(out, axis=1)


def fingerprints_of(texts: list[bytes], bits: int = BITS) -> np.ndarray:
    """One row of ``bits`` / 8 bytes per text."""
    # a few bytes for every text: a step has sums for each of them, and numbers them in 16 bits
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 64
    parts = [_fingerprints_of_step(texts[low:high], bits) for low, high in steps(sizes, VOTE_BYTES)]
    return np.concatenate(parts) if parts else np.zeros((0, bits // 8), np.uint8)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal bits, row by row."""
    return 1 - np.unpackbits(a ^ b, axis=1).mean(1)


def fingerprint(docs: DataFrame, bits: int = BITS) -> DataFrame:
    """doc_id and the fingerprint of every whole text, as bytes."""

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in text_steps(batch):
                found = [f.tobytes() for f in fingerprints_of(texts, bits)]
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(found, pa.binary())], ["doc_id", "fingerprint"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(marked, f"doc_id {id_type}, fingerprint binary")


# texts and their successors


def edited(text: str, after: str) -> str:
    """``text`` with its last half replaced by as much of the beginning of ``after``."""
    half = len(text) // 2
    return text[: len(text) - half] + after[:half]


_COMPARED = "n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"


def _compared(ids: pa.Array, texts: list[bytes], after: list[bytes], own: np.ndarray, other: np.ndarray) -> list[pa.Array]:
    plain = [t.decode() for t in texts]
    changed = [edited(t, a.decode()).encode() for t, a in zip(plain, after, strict=True)]
    marks = fingerprints_of(changed, own.shape[1] * 8)
    return [
        ids,
        pa.array([len(t) for t in plain], pa.int64()),
        pa.array([hashlib.sha256(t).hexdigest() for t in changed], pa.string()),
        pa.array([f.tobytes() for f in own], pa.binary()),
        pa.array([f.tobytes() for f in marks], pa.binary()),
        pa.array(likeness(own, marks)),
        pa.array(likeness(own, other)),
    ]


def compare_with_next(docs: DataFrame, bits: int = BITS, scanned: bool = False) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next in descending doc_id.

    ``scanned`` says that ``docs`` comes straight from Parquet files; other inputs are staged, so that ties keep one order however often a task runs.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    fields = f"doc_id {id_type}, {_COMPARED}"
    names = [f.split()[0] for f in fields.split(", ")]

    def in_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        border_only = [pa.nulls(1, t) for t in (pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64())]

        def border(ids: pa.Array, text: bytes, first: bool) -> pa.RecordBatch:
            edge = [pa.array([part], pa.int32()), pa.array([first]), pa.array([text], pa.binary())]
            return pa.RecordBatch.from_arrays([ids, *border_only, *edge], [*names, "part", "first", "text"])

        held = None
        for batch in batches:
            for rows, texts in text_steps(batch):
                ids, marks = rows.column("doc_id"), fingerprints_of(texts, bits)
                if held is None:
                    yield border(ids[:1], texts[0], True)
                else:
                    ids, texts, marks = pa.concat_arrays([held[0], ids]), [held[1], *texts], np.concatenate([held[2], marks])
                inside = _compared(ids[:-1], texts[:-1], texts[1:], marks[:-1], marks[1:])
                none = [pa.nulls(len(ids) - 1, t) for t in (pa.int32(), pa.bool_(), pa.binary())]
                yield pa.RecordBatch.from_arrays([*inside, *none], [*names, "part", "first", "text"])
                held = ids[-1:], texts[-1], marks[-1:]
        if held is not None:
            yield border(held[0], held[1], False)

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in text_steps(batch):
                after = [a or b"" for a in rows.column("after").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    _compared(rows.column("doc_id"), texts, after, fingerprints_of(texts, bits), fingerprints_of(after, bits)), names
                )

    table = docs.select("doc_id", "text") if scanned else stage(docs.select("doc_id", "text"), "to-compare")
    placed = table.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    order = [F.col("doc_id").desc_nulls_last(), F.col("_file"), F.col("_row")]
    ranged = placed.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    found = stage(ranged.mapInArrow(in_partition, f"{fields}, part int, first boolean, text binary"), "compared")
    borders = found.where("part is not null")
    # one row per partition: the partition after it that has rows, and after the last one the first
    parts = borders.where("first").select("part")
    by_part, everything = Window.orderBy("part"), Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    next_part = parts.select("part", F.coalesce(F.lead("part").over(by_part), F.min("part").over(everything)).alias("next"))
    firsts = borders.where("first").select(F.col("part").alias("next"), F.col("text").alias("after"))
    lasts = borders.where("NOT first").select("doc_id", "text", "part").join(next_part, "part").join(firsts, "next")
    return found.where("part is null").select(*names).unionAll(lasts.select("doc_id", "text", "after").mapInArrow(across, fields))


# search


def _masks(bits: int, radius: int, blocks: int) -> list[tuple[int, ...]]:
    """For every choice of blocks - radius blocks, the bits they hold, as one signed 64-bit mask per part."""
    if not 0 <= radius < blocks <= bits:
        raise ValueError(f"{blocks} blocks of {bits} bits for radius {radius}")
    ends = [round(bits * k / blocks) for k in range(blocks + 1)]
    masks = []
    for chosen in combinations(range(blocks), blocks - radius):
        whole = sum(((1 << (ends[b + 1] - ends[b])) - 1) << ends[b] for b in chosen)
        parts = [(whole >> (64 * p)) & ((1 << 64) - 1) for p in range(bits // 64)]
        masks.append(tuple(m - (1 << 64) if m >> 63 else m for m in parts))
    return masks


def _parts(column: Column, bits: int) -> list[Column]:
    """The 64-bit parts of a fingerprint, as longs."""
    digits = F.hex(column)
    # sixteen digits may pass the range of a long: two halves of eight never do
    halves = [F.conv(F.substring(digits, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(bits // 32)]
    return [F.shiftleft(halves[2 * p], 32).bitwiseOR(halves[2 * p + 1]) for p in range(bits // 64)]


def _meetings(fingerprints: DataFrame, column: str, radius: int, blocks: int, bits: int) -> tuple[DataFrame, Column]:
    """Ordered pairs of different fingerprints within the radius, as longs ``a0, a1, ..`` and ``b0, b1, ..``, each once; and their distance."""
    count, masks = bits // 64, _masks(bits, radius, blocks)
    distinct = fingerprints.where(F.col(column).isNotNull()).select(F.col(column).alias("fp")).distinct()
    parts = distinct.select(*[p.alias(f"p{k}") for k, p in enumerate(_parts(F.col("fp"), bits))])

    def key(number: int, mask: tuple[int, ...]) -> Column:
        masked = [F.col(f"p{k}").bitwiseAND(F.lit(m)) for k, m in enumerate(mask)]
        # the low bytes name the table; keys that share a hash are told apart by the comparison
        return F.xxhash64(*masked, F.lit(number)).bitwiseAND(F.lit(~0xFFFF)).bitwiseOR(F.lit(number))

    keyed = parts.withColumn("key", F.explode(F.array(*[key(t, m) for t, m in enumerate(masks)])))
    left = keyed.toDF(*[f"a{k}" for k in range(count)], "key")
    right = keyed.toDF(*[f"b{k}" for k in range(count)], "key")
    differ = [F.col(f"a{k}").bitwiseXOR(F.col(f"b{k}")) for k in range(count)]
    distance = reduce(Column.__add__, [F.bit_count(d) for d in differ])

    def agree(mask: tuple[int, ...]) -> Column:
        return reduce(Column.__and__, [d.bitwiseAND(F.lit(m)) == 0 for d, m in zip(differ, mask, strict=True)])

    first_table = reduce(lambda rest, t: F.when(agree(masks[t]), t).otherwise(rest), reversed(range(len(masks))), F.lit(-1))
    near = (distance > 0) & (distance <= radius) & (first_table == F.col("key").bitwiseAND(F.lit(0xFFFF)))
    return left.join(right, "key").where(near), distance


def _bytes_of(side: str, bits: int) -> Column:
    return F.unhex(F.concat(*[F.lpad(F.hex(f"{side}{k}"), 16, "0") for k in range(bits // 64)]))


def near_pairs(fingerprints: DataFrame, column: str = "fingerprint", radius: int = RADIUS, blocks: int = BLOCKS, bits: int = BITS) -> DataFrame:
    """a, b, distance for all ordered pairs of different fingerprints within the radius, each once.

    A bucket is a plain equi-join key; adaptive execution splits the hot ones. More ``blocks`` give more tables with longer keys.
    """
    met, distance = _meetings(fingerprints, column, radius, blocks, bits)
    return met.select(_bytes_of("a", bits).alias("a"), _bytes_of("b", bits).alias("b"), distance.alias("distance"))


def near_counts(rows: DataFrame, column: str = "fingerprint", radius: int = RADIUS, blocks: int = BLOCKS, bits: int = BITS) -> DataFrame:
    """``rows`` with n_near: how many other fingerprints lie within the radius of theirs. Pairs are counted where they meet."""
    met, _ = _meetings(rows, column, radius, blocks, bits)
    counted = met.groupBy(*[f"a{k}" for k in range(bits // 64)]).agg(F.count(F.lit(1)).alias("n_near"))
    counts = stage(counted.select(_bytes_of("a", bits).alias(column), "n_near"), "near-counts")
    return rows.join(counts, column, "left").withColumn("n_near", F.coalesce("n_near", F.lit(0).cast("long")))


def document_fingerprints(docs: DataFrame, scanned: bool = False) -> DataFrame:
    """Every document compared with its successor, with the count of other fingerprints near its own."""
    counted = near_counts(compare_with_next(docs, scanned=scanned))
    return counted.withColumns({c: F.lower(F.hex(c)) for c in ("fingerprint", "edited_fingerprint")})
