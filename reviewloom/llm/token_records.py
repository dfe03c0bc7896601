"""Token ids as length-delimited binary records, with a separate offset index.

A record is framed as

    u64 payload length | u32 masked checksum of those 8 bytes | payload | u32 masked checksum of the payload | "\\n"

and its payload is ``i64 doc_id | u8 flags | u8 bytes per id | ids``, all little-endian. Flag 1 marks a null
doc_id. The checksum is crc32, rotated right by 15 bits plus a constant, so that a checksum of data that holds
checksums stays useful. The line break is the separator of Spark's text sink, which writes the frames:
files appear by its commit protocol, so that a lost executor leaves no half-written or double file.

Cases: a null text is encoded as an empty one (end id only); repeated rows and repeated ids are records of
their own; rows come in ascending doc_id, null ids first; an empty table gives no record. Other columns of
the input are ignored.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reviewloom.llm.common import steps, text_steps
from reviewloom.session import scratch_path, stage

# Fixed values of the frame.
MASK_DELTA = 0xA282EAD8
HEAD = struct.Struct("<QI")
TAIL = struct.Struct("<I")
PAYLOAD = struct.Struct("<qBB")
TRAILER = b"\n"

# Records of one file; a reader holds a file in memory.
RECORDS_PER_FILE = 4096

# Entries that a worker's table of encoded pieces may reach; then only its first ones stay, which are mostly frequent.
MEMO_ENTRIES = 400_000
MEMO_STAYS = 60_000

# Letters whose class no Unicode version changes. A run of text with other characters than these and
# ASCII is handed to the tokenizer as it stands.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
_PLAIN = re.compile(rf"[\x00-\x1b\x20-\x7e{_LETTERS}]*")
_RUNS = re.compile(r"\s*\S+|\s+")
# The split of the byte-level tokenizer, for plain text only.
_PIECES = re.compile(rf"'(?:s|t|re|ve|m|ll|d)| ?[{_LETTERS}]+| ?[0-9]+| ?[^\s0-9{_LETTERS}]+|\s+(?!\S)|\s+")


def _byte_letters() -> dict[int, str]:
    """The letter a byte-level vocabulary writes for each byte: itself where it is visible, else the next one from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}


_BYTE_LETTERS = _byte_letters()


def masked_checksum(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK_DELTA) & 0xFFFFFFFF


class _Memo(dict):
    """Encoded pieces; a missing one is encoded when it is asked for."""

    def __init__(self, encode: Callable[[str], bytes]):
        super().__init__()
        self.encode = encode

    def __missing__(self, piece: str) -> bytes:
        self[piece] = coded = self.encode(piece)
        return coded


class PieceEncoder:
    """Encodes texts with a byte-level tokenizer, each distinct piece once.

    The tokenizer splits text before it merges, so a text's ids are those of its pieces in order.
    """

    def __init__(self, tokenizer_file: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.width = 2 if self.tokenizer.get_vocab_size(True) <= 1 << 16 else 4
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model = self.tokenizer.model
        self.memo = _Memo(self._ids)

    def _ids(self, piece: str) -> bytes:
        if _PLAIN.fullmatch(piece) and not any(s in piece for s in self.specials):
            # a piece that the tokenizer would not split any further: only its merges are left to do
            letters = piece.encode().decode("latin-1").translate(_BYTE_LETTERS)
            ids = [t.id for t in self.model.tokenize(letters)]
        else:
            ids = self.tokenizer.encode(piece, add_special_tokens=False).ids
        return np.array(ids, f"<u{self.width}").tobytes()

    def pieces(self, text: str) -> list[str]:
        if _PLAIN.fullmatch(text) and not any(s in text for s in self.specials):
            return _PIECES.findall(text)
        if len(runs := _RUNS.findall(text)) < 2:
            return runs
        return list(chain.from_iterable(map(self.pieces, runs)))

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        """Little-endian ids of each text."""
        if len(self.memo) > MEMO_ENTRIES:
            stays = dict(islice(self.memo.items(), MEMO_STAYS))
            self.memo.clear()
            self.memo.update(stays)
        return [b"".join(map(self.memo.__getitem__, self.pieces(text))) for text in texts]


@lru_cache(maxsize=1)
def _encoder(tokenizer_file: str) -> PieceEncoder:
    """One encoder per Python worker, which runs many tasks."""
    return PieceEncoder(tokenizer_file)


def frame(payload: bytes) -> bytes:
    """A record without its trailer, which the sink writes."""
    length = struct.pack("<Q", len(payload))
    return length + TAIL.pack(masked_checksum(length)) + payload + TAIL.pack(masked_checksum(payload))


def read_frames(data: bytes) -> Iterator[tuple[int, int, bytes]]:
    """Offset, length and payload of every record of a file; damaged ones raise."""
    at = 0
    while at < len(data):
        end, payload = _read_frame(data, at)
        yield at, end - at, payload
        at = end


def _read_frame(data: bytes, at: int) -> tuple[int, bytes]:
    if len(data) - at < HEAD.size:
        raise ValueError(f"record at {at}: file ends in its head")
    length, check = HEAD.unpack_from(data, at)
    if masked_checksum(data[at : at + 8]) != check:
        raise ValueError(f"record at {at}: length is damaged")
    start, end = at + HEAD.size, at + HEAD.size + length
    if len(data) < end + TAIL.size + len(TRAILER):
        raise ValueError(f"record at {at}: file ends in it")
    payload = data[start:end]
    if masked_checksum(payload) != TAIL.unpack_from(data, end)[0] or data[end + TAIL.size : end + TAIL.size + 1] != TRAILER:
        raise ValueError(f"record at {at}: payload is damaged")
    return end + TAIL.size + len(TRAILER), payload


def payload_of(doc_id: int | None, ids: bytes, width: int) -> bytes:
    return PAYLOAD.pack(doc_id or 0, doc_id is None, width) + ids


def ids_of(payload: bytes) -> tuple[int | None, np.ndarray]:
    doc_id, flags, width = PAYLOAD.unpack_from(payload)
    return None if flags & 1 else doc_id, np.frombuffer(payload, f"<u{width}", offset=PAYLOAD.size)


def write_records(docs: DataFrame, path: str, tokenizer_file: str, end_id: int) -> None:
    """Encode ``doc_id, text`` and write the records below ``path`` in ascending doc_id.

    The texts are range-partitioned, which samples ids; no task or driver holds more than a share.
    """

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer_file)
        end = np.array([end_id], f"<u{encoder.width}").tobytes()
        for batch in batches:
            for rows, texts in text_steps(batch):
                coded = encoder.encode(t.decode() for t in texts)
                out = [frame(payload_of(d, c + end, encoder.width)) for d, c in zip(rows.column("doc_id").to_pylist(), coded, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["frame"])

    tie = F.xxhash64("text")
    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie)
    (
        ordered.mapInArrow(frames, "frame binary")
        .select(F.col("frame").cast("string").alias("value"))
        .write.option("maxRecordsPerFile", RECORDS_PER_FILE)
        .option("lineSep", TRAILER.decode())
        .text(path)
    )


def build_index(spark: SparkSession, path: str) -> DataFrame:
    """The offset index, read from the files: one row per record with its place, its ids' count and crc32.

    ``start`` counts the ids of all records before it. Files are ordered by their first record; the window
    over files has one row per file.
    """
    schema = "file string, position long, offset long, length long, doc_id long, n_tokens long, before long, ids_crc32 long"

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                rows, before = [], 0
                for k, (offset, length, payload) in enumerate(read_frames(content.as_py())):
                    doc_id, ids = ids_of(payload)
                    rows.append((file, k, offset, length, doc_id, len(ids), before, zlib.crc32(ids.astype("<u4").tobytes())))
                    before += len(ids)
                if rows:
                    names = [c.split()[0] for c in schema.split(", ")]
                    types = [pa.string()] + [pa.int64()] * 7
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(path).select("path", "content")
    places = stage(files.mapInArrow(walk, schema), "token-index")
    of_file = places.groupBy("file").agg(F.sum("n_tokens").alias("_ids"), F.min_by(F.struct("doc_id"), "position").alias("_first"))
    in_order = Window.orderBy("_first", "file").rowsBetween(Window.unboundedPreceding, -1)
    base = of_file.select("file", F.coalesce(F.sum("_ids").over(in_order), F.lit(0)).alias("_base"))
    return places.join(base, "file").select(
        "doc_id", (F.col("_base") + F.col("before")).alias("start"), "n_tokens", "ids_crc32", "file", "position", "offset", "length"
    )


def read_records(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """Shuffled read: the ids of the index rows in ``wanted``, by their offsets alone.

    Only files that hold a wanted record are opened. Rows: doc_id, ids.
    """
    places = wanted.groupBy("file").agg(F.collect_list(F.struct("offset", "length")).alias("places"))
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(path).select("path", "content")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, found in zip(batch.column("content"), batch.column("places").to_pylist(), strict=True):
                data = content.as_py()
                for low, high in steps(np.array([p["length"] for p in found])):
                    got = [ids_of(_read_frame(data, p["offset"])[1]) for p in found[low:high]]
                    ids = pa.array([g[1].astype("<i8") for g in got], pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_arrays([pa.array([g[0] for g in got], pa.int64()), ids], ["doc_id", "ids"])

    return files.join(places, F.col("path") == F.col("file")).select("content", "places").mapInArrow(cut, "doc_id long, ids array<long>")


def token_records(docs: DataFrame, tokenizer_file: str, end_id: int = 2) -> DataFrame:
    """Write the records of ``docs`` to the shared folder and return their index, read from them."""
    spark = docs.sparkSession
    path = scratch_path(spark, "token-records")
    write_records(docs, path, tokenizer_file, end_id)
    return build_index(spark, path)
