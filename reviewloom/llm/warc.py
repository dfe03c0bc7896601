"""WARC archives with a two-level capture index.

Records are written one gzip member each, so that any of them can be read by its range alone. Of records with
equal payloads the one with the smallest page_id is a response and the others are revisits that name it.
The index sorts captures by reversed host and path (``com,example,www)/path``) and page_id, cuts the sorted list into compressed
blocks, and keeps the first key of each block in a sparse directory. A lookup finds its block by binary search in
the directory, its line by binary search in the block, and reads the record's range from its archive.

Cases: a null html is an empty payload, null urls have an empty target and key; rows that repeat a page_id with
the response's payload are responses too; null page_ids are kept and sort last among equal payloads; an empty table gives no archive record
and an empty index. Other columns of the input are ignored.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.llm.common import steps
from reviewloom.session import scratch_path, stage

# Records of one archive file; a reader holds a compressed file in memory.
RECORDS_PER_FILE = 2048

# Lines of an index block, at least; blocks grow so that the directory has at most so many entries.
BLOCK_LINES = 1024
DIRECTORY_ENTRIES = 1 << 16

# An empty gzip member. The text sink puts a separator behind each row; this one is a valid part of the archive.
SEPARATOR = gzip.compress(b"", mtime=0)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LAST_ID = (1 << 63) - 1


def surt(url: Column) -> Column:
    """Reversed-host key of a url: scheme dropped, host labels reversed, path and query kept. Null counts as empty."""
    url = F.coalesce(url, F.lit(""))
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(url)
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), _UPPER, _LOWER)
    tail = F.regexp_extract(rest, "^[^/?#]*([^#]*)", 1)
    return F.concat(F.array_join(F.reverse(F.split(host, "[.]")), ","), F.lit(")"), tail)


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    kind = "revisit" if revisit else "response"
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Target-URI: {json.dumps(url or '')}",
        f"WARC-Payload-Digest: sha1:{_digest(payload)}",
        f"WARC-Payload-Length: {len(payload)}",
    ]
    if revisit:
        head.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    block = b"" if revisit else payload
    head.append(f"Content-Length: {len(block)}")
    return gzip.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", 6, mtime=0)


def parse_record(data: bytes) -> dict:
    """Fields of one uncompressed record; a revisit has no payload of its own."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    payload = rest[: int(fields["Content-Length"])]
    if rest[len(payload) :] != b"\r\n\r\n":
        raise ValueError("record length is wrong")
    number = lambda text: int(text) if (text := text.removeprefix("<urn:page:").removesuffix(">")) else None
    revisit = fields["WARC-Type"] == "revisit"
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if not revisit and _digest(payload) != digest:
        raise ValueError("payload is damaged")
    return {
        "page_id": number(fields["WARC-Record-ID"]),
        "url": json.loads(fields["WARC-Target-URI"]),
        "payload_bytes": int(fields["WARC-Payload-Length"]) if revisit else len(payload),
        "payload_digest": digest,
        "record_type": fields["WARC-Type"],
        "refers_to": number(fields["WARC-Refers-To"]) if revisit else None,
        "payload": None if revisit else payload,
    }


def _members(content: bytes) -> Iterator[tuple[int, int, bytes]]:
    """Offset, length and data of the non-empty members of an archive."""
    at, view = 0, memoryview(content)
    while at < len(view):
        reader, parts, used = zlib.decompressobj(wbits=31), [], 0
        while not reader.eof:
            chunk = view[at + used : at + used + (1 << 16)]
            if not chunk:
                raise ValueError(f"archive ends in the record at {at}")
            parts.append(reader.decompress(chunk))
            used += len(chunk)
        length = used - len(reader.unused_data)
        if data := b"".join(parts):
            yield at, length, data
        at += length


def revisits(pages: DataFrame) -> DataFrame:
    """page_id, refers_to of pages whose payload another page with a smaller page_id has."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    digests = stage(pages.select("page_id", F.sha1(payload).alias("_digest"), F.octet_length(payload).alias("_size")), "page-digests")
    firsts = digests.groupBy("_digest", "_size").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    repeated = digests.join(firsts, ["_digest", "_size"]).where(F.coalesce(F.col("page_id"), F.lit(_LAST_ID)) != F.col("refers_to"))
    return repeated.select(F.coalesce("page_id", F.lit(_LAST_ID)).alias("_id"), "_digest", "refers_to").distinct()


def write_archives(pages: DataFrame, path: str) -> None:
    """Write every page as a WARC record below ``path``."""
    known = stage(revisits(pages), "revisits")
    rows = pages.select("page_id", "url", "html", F.coalesce("page_id", F.lit(_LAST_ID)).alias("_id"))
    digest = F.sha1(F.coalesce(F.col("html"), F.lit("")).cast("binary"))
    marked = rows.withColumn("_digest", digest).join(known, ["_id", "_digest"], "left").select("page_id", "url", "html", "refers_to")

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "html", "refers_to")]
            for low in range(0, batch.num_rows, 256):
                part = zip(*(c.slice(low, 256).to_pylist() for c in columns), strict=True)
                out = [_record(i, url, (html or "").encode(), to, to is not None) for i, url, html, to in part]
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    (
        marked.mapInArrow(records, "record binary")
        .select(F.col("record").cast("string").alias("value"))
        .write.option("maxRecordsPerFile", RECORDS_PER_FILE)
        .option("encoding", "ISO-8859-1")
        .option("lineSep", SEPARATOR.decode("latin-1"))
        .text(path)
    )


def _archives(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(path).select("path", "content")


def captures(spark: SparkSession, path: str) -> DataFrame:
    """key, page_id, file, offset, length of every record, from the archives themselves."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                rows = []
                for offset, length, data in _members(content.as_py()):
                    record = parse_record(data)
                    rows.append((record["url"], record["page_id"], file, offset, length))
                if rows:
                    url, page, files, offsets, lengths = zip(*rows, strict=True)
                    arrays = [pa.array(url), pa.array(page, pa.int64()), pa.array(files), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())]
                    yield pa.RecordBatch.from_arrays(arrays, ["url", "page_id", "file", "offset", "length"])

    found = _archives(spark, path).mapInArrow(walk, "url string, page_id long, file string, offset long, length long")
    return stage(found.select(surt(F.col("url")).alias("key"), F.coalesce("page_id", F.lit(_LAST_ID)).alias("page_id"), "file", "offset", "length"), "captures")


def build_index(found: DataFrame) -> DataFrame:
    """Compressed blocks of the sorted captures: block, first_key, first_page, lines, data.

    Captures are range-partitioned on the whole key, so a host or url with a third of the rows spreads.
    """
    lines = max(BLOCK_LINES, -(-2 * found.count() // DIRECTORY_ENTRIES))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple] = []

        def packed(rows: list[tuple]) -> pa.RecordBatch:
            data = zlib.compress(json.dumps(rows).encode(), 6)
            arrays = [pa.array([rows[0][0]]), pa.array([rows[0][1]], pa.int64()), pa.array([len(rows)], pa.int64()), pa.array([data], pa.binary())]
            return pa.RecordBatch.from_arrays(arrays, ["first_key", "first_page", "lines", "data"])

        for batch in batches:
            waiting += zip(*(batch.column(c).to_pylist() for c in ("key", "page_id", "file", "offset", "length")), strict=True)
            while len(waiting) >= lines:
                yield packed(waiting[:lines])
                waiting = waiting[lines:]
        if waiting:
            yield packed(waiting)

    order = ["key", "page_id", "file", "offset"]
    cut = found.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(blocks, "first_key string, first_page long, lines long, data binary")
    return stage(cut.withColumn("block", F.monotonically_increasing_id()), "capture-blocks")


def find_captures(index: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows of ``wanted`` (key, page_id) with file, offset, length; pairs without a capture go.

    The directory has at most about ``DIRECTORY_ENTRIES`` entries by the choice of the block size. Equal pairs share a lookup, which finds all their captures.
    """
    spark = index.sparkSession
    directory = sorted((r.first_key.encode(), r.first_page, r.block) for r in index.select("first_key", "first_page", "block").collect())
    held = spark.sparkContext.broadcast(([d[:2] for d in directory], [d[2] for d in directory]))

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts, blocks = held.value
        for batch in batches:
            rows = []
            for key, page in zip(batch.column("key").to_pylist(), batch.column("page_id").to_pylist(), strict=True):
                pair = (key.encode(), page)
                # captures of an equal pair may reach from the block before the first equal one to the last equal one
                low, high = max(0, bisect.bisect_left(firsts, pair) - 1), bisect.bisect_right(firsts, pair)
                rows += [(key, page, block) for block in blocks[low:high]]
            arrays = [pa.array([r[c] for r in rows], t) for c, t in enumerate((pa.string(), pa.int64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, ["key", "page_id", "block"])

    looked = wanted.select("key", "page_id").distinct().mapInArrow(locate, "key string, page_id long, block long")
    asked = looked.groupBy("block").agg(F.collect_list(F.struct("key", "page_id")).alias("asked"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, pairs in zip(batch.column("data").to_pylist(), batch.column("asked").to_pylist(), strict=True):
                entries = json.loads(zlib.decompress(data))
                keys = [(k.encode(), p) for k, p, *_ in entries]
                out = []
                for pair in pairs:
                    want = (pair["key"].encode(), pair["page_id"])
                    low, high = bisect.bisect_left(keys, want), bisect.bisect_right(keys, want)
                    out += [(pair["key"], pair["page_id"], *entry[2:]) for entry in entries[low:high]]
                if out:
                    kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
                    arrays = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays(arrays, ["key", "page_id", "file", "offset", "length"])

    hits = index.join(asked, "block").select("data", "asked")
    return hits.mapInArrow(search, "key string, page_id long, file string, offset long, length long")


_FIELDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def read_ranges(spark: SparkSession, path: str, places: DataFrame) -> DataFrame:
    """The records at ``places`` (file, offset, length): each range is cut from its archive and decompressed alone.

    An archive has a bounded number of records, and so has its list of places.
    """
    per_file = places.groupBy("file").agg(F.collect_list(F.struct("offset", "length")).alias("places"))
    kinds = {"payload": pa.binary(), "page_id": pa.int64(), "payload_bytes": pa.int64(), "refers_to": pa.int64()}
    names = [c.split()[0] for c in _FIELDS.split(", ")]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, found in zip(batch.column("content"), batch.column("places").to_pylist(), strict=True):
                data = content.as_py()
                for low, high in steps(np.array([p["length"] for p in found])):
                    rows = [parse_record(gzip.decompress(data[p["offset"] : p["offset"] + p["length"]])) for p in found[low:high]]
                    arrays = [pa.array([r[n] for r in rows], kinds.get(n, pa.string())) for n in names]
                    yield pa.RecordBatch.from_arrays(arrays, names)

    return _archives(spark, path).join(per_file, F.col("path") == F.col("file")).select("content", "places").mapInArrow(cut, _FIELDS)


def warc_pages(pages: DataFrame) -> DataFrame:
    """Write archives and index, look every capture up by its key, and read the records back."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(pages, path)
    index = build_index(captures(spark, path))
    wanted = pages.select(surt(F.col("url")).alias("key"), F.coalesce("page_id", F.lit(_LAST_ID)).alias("page_id"))
    return read_ranges(spark, path, find_captures(index, wanted))
