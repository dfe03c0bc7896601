"""Removal of text that an earlier document holds, by suffix arrays.

A byte goes when a 50-byte string that covers it also starts in a document with a smaller doc_id. Every 50-byte window has an anchor: its 16-byte
substring with the smallest hash, the leftmost of equals. Equal windows have equal anchors at equal places, so the windows of one anchor can be
judged apart from all others. Consecutive windows with one anchor make a span of at most 84 bytes; a document is cut into
some 1/18 as many spans as it has bytes.

1. A window holds its anchor and at least 17 more bytes to its left or to its right. Where neither of these two strings of 33 bytes, the span's
   probes, is in another document, no window of the span repeats. Hashes of probes are counted in packed rows, and a bitmap of fixed size keeps those that may repeat.
2. Spans with such a probe go to the task of their anchor, each distinct span of a step once, with the smallest and largest doc_id that has it.
3. A task lines the spans of each anchor up and cuts them where any of them differ; the pieces become symbols. Symbols that only occur together are one. The suffix array of all the
   symbols, with the lengths of common prefixes, puts equal windows next to each other, and gives each window the smallest document that has it.
4. What was found for a span is joined to all its occurrences, which stay rows of their own, so a span that a third of all documents share is no hot group.

Cases: null texts are empty; documents with a null doc_id keep all and remove nothing elsewhere; rows with equal doc_ids are one document, so they don't
remove from each other; texts under 50 bytes lose nothing; an empty table gives an empty one; other columns are ignored. Removed runs end at
bytes, not at characters; ``cut_texts`` widens what stays to whole characters.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom.llm.common import mixed, prefix_hashes, span_hashes, text_steps, tidy, window_hashes
from reviewloom.llm.suffix_grouping import suffix_array
from reviewloom.session import stage

# The repeated length, the length of an anchor, and the anchors' places in a window.
LENGTH = 50
ANCHOR = 16
PLACES = LENGTH - ANCHOR + 1

# Probes or anchors of a task, about.
TASK_ANCHORS = 400_000
# Text that one numpy step cuts into spans; it needs some 100 bytes for each.
STEP_BYTES = 1 << 20
# Spans of one suffix array, about; those of an anchor stay together.
SUFFIX_SPANS = 8192

# Bytes beside the anchor that a window holds on one side at least, and bits of the bitmap of probes that may repeat.
BESIDE = PLACES // 2
FILTER_BITS = 27

# Bits of the bitmap of texts with a removed range.
KEY_BITS = 24

_POSITION_BITS = 28
_POSITION = np.uint64((1 << _POSITION_BITS) - 1)
_COLUMNS = np.arange(-(PLACES - 1), LENGTH)


class Spans:
    """Spans of some texts: text number, place in the text, anchor's place in the span, length, hashes of anchor and span."""

    def __init__(self, texts: list[bytes]):
        joined = b"".join(texts)
        self.data = np.frombuffer(joined, np.uint8)
        ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
        sizes = np.diff(ends, prepend=0)
        n = len(self.data)
        if n < LENGTH:
            self._set(np.zeros((5, 0), np.int64), np.zeros(n + 1, np.uint64))
            self.has_left = self.has_right = np.zeros(0, bool)
            self.left_probes = self.right_probes = np.zeros(0, np.uint64)
            return
        sums = prefix_hashes(self.data)
        anchors = window_hashes(sums, ANCHOR)
        low = anchors & ~_POSITION
        low |= np.arange(len(anchors), dtype=np.uint64)
        # minimum over PLACES neighbours by doubling
        width = 1
        while 2 * width <= PLACES:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        if rest := PLACES - width:
            low = np.minimum(low[:-rest], low[rest:])
        inside = np.arange(LENGTH, n + 1) <= np.repeat(ends, sizes)[: n - LENGTH + 1]
        change = np.ones(len(inside), bool)
        change[1:] = (low[1:] != low[:-1]) | ~inside[:-1]
        starts = np.flatnonzero(change & inside)
        closes = np.ones(len(inside), bool)
        closes[:-1] = change[1:] | ~inside[1:]
        lasts = np.flatnonzero(closes & inside)
        where = (low[starts] & _POSITION).astype(np.int64)
        text_of = np.searchsorted(ends, starts, "right")
        self._set(np.stack([text_of, starts, where - starts, lasts + LENGTH - starts, starts - (ends - sizes)[text_of]]), sums)
        self.anchors = anchors[where]
        self.has_left, self.has_right = self.left >= BESIDE, self.length - self.left >= ANCHOR + BESIDE
        self.left_probes = mixed(span_hashes(sums, where[self.has_left] - BESIDE, where[self.has_left] + ANCHOR) ^ np.uint64(1))
        self.right_probes = span_hashes(sums, where[self.has_right], where[self.has_right] + ANCHOR + BESIDE)

    def _set(self, fields: np.ndarray, sums: np.ndarray) -> None:
        self.text_of, self.starts, self.left, self.length, self.place = fields
        self.anchors = np.zeros(fields.shape[1], np.uint64)
        # the anchor's place is part of a span's identity
        self.hashes = mixed(span_hashes(sums, self.starts, self.starts + self.length) ^ (self.left + 1).astype(np.uint64))


def _gather(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The bytes of spans, one behind the other."""
    ends = np.cumsum(lengths)
    return data[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)]


def packed_rows(bucket: np.ndarray, columns: dict[str, np.ndarray], data: np.ndarray | None = None, lengths: np.ndarray | None = None) -> pa.RecordBatch:
    """One row per bucket, in ascending order of ``bucket``, with each column's values (and the spans' bytes) packed."""
    found, first = np.unique(bucket, return_index=True)
    cuts = np.append(first, len(bucket))
    pack = lambda values, at: pa.array([values[i:j].tobytes() for i, j in zip(at[:-1], at[1:], strict=True)], pa.binary())
    arrays = [pa.array(found.astype(np.int64)), *(pack(values, cuts) for values in columns.values())]
    names = ["bucket", *columns]
    if data is not None:
        arrays.append(pack(data, np.concatenate([[0], np.cumsum(lengths)])[cuts]))
        names.append("data")
    return pa.RecordBatch.from_arrays(arrays, names)


def unpacked(group: pa.Table, name: str, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(group.column(name).to_pylist()), kind)


def text_pieces(batch: pa.RecordBatch, limit: int) -> Iterator[tuple[pa.RecordBatch, list[bytes], int]]:
    """Slices of a batch, their texts, and where these begin in the whole texts.

    A text above ``limit`` bytes comes in pieces that share ``LENGTH - 1`` bytes with the next, so every window is in one of them. A span that is cut
    in two is two spans; its windows keep their anchor and their probes.
    """
    for rows, texts in text_steps(batch, limit=limit):
        if len(texts) == 1 and len(texts[0]) > limit:
            for at in range(0, len(texts[0]) - LENGTH + 1, limit):
                yield rows, [texts[0][at : at + limit + LENGTH - 1]], at
        else:
            yield rows, texts, 0


def _ids_of(rows: pa.RecordBatch) -> np.ndarray:
    return rows.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)


class ProbeFilter:
    """Bitmap of probes: their first bits name a task's segment, the last 32 two places in it.

    Segments and pickled filters are compressed, since most bitmaps are sparse and the driver's heap holds several copies of what passes through it.
    """

    def __init__(self, bits: int):
        self.bits, self.inner = bits, FILTER_BITS - bits
        self.packed = np.zeros(1 << (FILTER_BITS - 3), np.uint8)

    def segment_of(self, probes: np.ndarray) -> np.ndarray:
        return (probes >> np.uint64(64 - self.bits)).astype(np.int64)

    def segment(self, low_bits: np.ndarray) -> bytes:
        marks = np.zeros(1 << self.inner, np.uint8)
        for places in self._places(low_bits):
            marks[places] = 1
        return zlib.compress(np.packbits(marks, bitorder="little"), 1)

    def put(self, segment: int, packed: bytes) -> None:
        size = 1 << (self.inner - 3)
        self.packed[segment * size : (segment + 1) * size] = np.frombuffer(zlib.decompress(packed), np.uint8)

    def __getstate__(self) -> tuple[int, list[bytes]]:
        return self.bits, [zlib.compress(self.packed[low : low + STEP_BYTES], 1) for low in range(0, len(self.packed), STEP_BYTES)]

    def __setstate__(self, state: tuple[int, list[bytes]]) -> None:
        self.__init__(state[0])
        low = 0
        # a worker may have other steps than the driver
        for packed in state[1]:
            part = np.frombuffer(zlib.decompress(packed), np.uint8)
            self.packed[low : low + len(part)] = part
            low += len(part)

    def _places(self, low_bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        spread = (low_bits * np.uint64(0x9E3779B1)) & np.uint64(0xFFFFFFFF)
        return (low_bits & np.uint64((1 << self.inner) - 1)).astype(np.int64), (spread >> np.uint64(32 - self.inner)).astype(np.int64)

    def holds(self, probes: np.ndarray) -> np.ndarray:
        out = np.ones(len(probes), bool)
        for places in self._places(probes & np.uint64(0xFFFFFFFF)):
            slot = (self.segment_of(probes) << self.inner) | places
            out &= (self.packed[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 > 0
        return out

    def may_repeat(self, spans: Spans) -> np.ndarray:
        """Numbers of the spans with a probe of the bitmap."""
        out = np.zeros(len(spans.starts), bool)
        out[spans.has_left] = self.holds(spans.left_probes)
        out[spans.has_right] |= self.holds(spans.right_probes)
        return np.flatnonzero(out)


def repeated_probes(docs: DataFrame, spans: int) -> ProbeFilter:
    """The probes that more than one document may have. What comes to the driver is the bitmap, whose size is fixed."""
    out = ProbeFilter(min(FILTER_BITS - 6, max(4, (-(-spans // TASK_ANCHORS) - 1).bit_length())))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts, _ in text_pieces(batch, STEP_BYTES):
                cut = Spans(texts)
                ids = _ids_of(rows)[cut.text_of]
                probes, ids = np.concatenate([cut.left_probes, cut.right_probes]), np.concatenate([ids[cut.has_left], ids[cut.has_right]])
                order = np.lexsort((ids, probes))
                probes, ids = probes[order], ids[order]
                once = np.ones(len(order), bool)
                once[1:] = (probes[1:] != probes[:-1]) | (ids[1:] != ids[:-1])
                probes = probes[once]
                # 32 bits and the segment tell most probes apart; mistaking some costs time only
                yield packed_rows(out.segment_of(probes), {"probes": probes.astype(np.uint32)})

    def several(group: pa.Table) -> pa.Table:
        values = np.sort(unpacked(group, "probes", "<u4"))
        twice = values[1:][values[1:] == values[:-1]].astype(np.uint64)
        return pa.table({"bucket": [group.column("bucket")[0].as_py()], "packed": pa.array([out.segment(twice)], pa.binary())})

    rows = docs.select("doc_id", "text").mapInArrow(tidy(packed), "bucket long, probes binary")
    for row in rows.groupBy("bucket").applyInArrow(several, "bucket long, packed binary").toLocalIterator():
        out.put(row["bucket"], bytes(row["packed"]))
    return out


def _distinct(spans: Spans, keep: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First occurrence of each distinct span among ``keep``, with the smallest and largest doc_id that has it."""
    order = keep[np.argsort(spans.hashes[keep], kind="stable")]
    hashes = spans.hashes[order]
    begins = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])) if len(order) else np.zeros(0, np.int64)
    if not len(order):
        return order, order, order
    return order[begins], np.minimum.reduceat(ids[order], begins), np.maximum.reduceat(ids[order], begins)


def _windows_of(group: pa.Table) -> pa.Table:
    """span, lo, hi, first_doc: windows lo to hi of a span, whose strings the smallest document first_doc also has."""
    hashes, anchors = unpacked(group, "spans", "<u8"), unpacked(group, "anchors", "<u8")
    low, high = unpacked(group, "low", "<i8"), unpacked(group, "high", "<i8")
    left, length = unpacked(group, "left", "u1").astype(np.int64), unpacked(group, "length", "u1").astype(np.int64)
    data = unpacked(group, "data", "u1")
    offset = np.cumsum(length) - length
    order = np.lexsort((hashes, anchors))
    begins = np.flatnonzero(np.concatenate([[True], hashes[order][1:] != hashes[order][:-1]]))
    low, high = np.minimum.reduceat(low[order], begins), np.maximum.reduceat(high[order], begins)
    first = order[begins]
    hashes, anchors, left, length, offset = (x[first] for x in (hashes, anchors, left, length, offset))
    new_anchor = np.concatenate([[True], anchors[1:] != anchors[:-1]])
    family = np.cumsum(new_anchor) - 1
    alone = np.bincount(family)[family] == 1
    # a span that all occurrences of its anchor agree on repeats as a whole
    whole = np.flatnonzero(alone & (low < high))
    parts = [(whole, np.zeros(len(whole), np.int64), length[whole] - LENGTH, low[whole])]
    varied = np.flatnonzero(~alone)
    at = 0
    while at < len(varied):
        # whole families of some thousand spans at a time
        end = min(at + SUFFIX_SPANS, len(varied))
        while end < len(varied) and family[varied[end]] == family[varied[end - 1]]:
            end += 1
        part = varied[at:end]
        lines = _lines(data, offset[part], left[part], length[part])
        met = _meeting(lines, left[part], length[part], family[part])
        # no other span of the family shares a window with these
        quiet = part[~met]
        quiet = quiet[low[quiet] < high[quiet]]
        parts.append((quiet, np.zeros(len(quiet), np.int64), length[quiet] - LENGTH, low[quiet]))
        if met.any():
            part = part[met]
            which, lo, hi, doc = _family_windows(lines[met], left[part], length[part], family[part], low[part], high[part])
            parts.append((part[which], lo, hi, doc))
        at = end
    which, lo, hi, doc = map(np.concatenate, zip(*parts, strict=True))
    return pa.table({"span": hashes[which].view(np.int64), "lo": lo.astype(np.int32), "hi": hi.astype(np.int32), "first_doc": doc})


def _lines(data: np.ndarray, offset: np.ndarray, left: np.ndarray, length: np.ndarray) -> np.ndarray:
    """A line per span, with the anchors below each other; 256 where a span has no byte."""
    count, width = len(offset), len(_COLUMNS)
    lines = np.full((count, width), 256, np.uint16)
    cells = np.repeat(np.arange(count) * width + PLACES - 1 - left - (np.cumsum(length) - length), length) + np.arange(int(length.sum()))
    lines.reshape(-1)[cells] = _gather(data, offset, length)
    return lines


def _meeting(lines: np.ndarray, left: np.ndarray, length: np.ndarray, family: np.ndarray) -> np.ndarray:
    """Spans that share a probe with another span of their family; the others share no window."""
    sums = prefix_hashes(lines.astype(np.uint8).reshape(-1))
    anchor = np.arange(len(lines)) * lines.shape[1] + PLACES - 1
    out = np.zeros(len(lines), bool)
    for there, begin, end in ((left >= BESIDE, -BESIDE, ANCHOR), (length - left >= ANCHOR + BESIDE, 0, ANCHOR + BESIDE)):
        which = np.flatnonzero(there)
        probes = span_hashes(sums, anchor[which] + begin, anchor[which] + end) ^ mixed(family[which].astype(np.uint64))
        _, same, count = np.unique(probes, return_inverse=True, return_counts=True)
        out[which] |= count[same] > 1
    return out


def _family_windows(lines, left, length, family, low, high) -> tuple[np.ndarray, ...]:
    """Runs of windows with the same smallest document, below the span's largest one: span number, lo, hi, document."""
    count, width, middle = len(lines), len(_COLUMNS), PLACES - 1
    begin, end = middle - left, middle - left + length
    heads = np.flatnonzero(np.concatenate([[True], family[1:] != family[:-1]]))
    head_of = np.cumsum(np.concatenate([[True], family[1:] != family[:-1]])) - 1
    varies = np.logical_or.reduceat((lines != lines[heads][head_of]) | (lines == 256), heads, axis=0)
    # cut where the lines of a family may part: right of the anchor before a varying column, left of it behind one
    cut = np.zeros((len(heads), width), bool)
    cut[:, middle + 1 :] = varies[:, middle + 1 :]
    cut[:, 1 : middle + 1] = varies[:, :middle]
    cuts = cut[head_of]
    column = np.arange(width)
    cuts &= (column >= begin[:, None]) & (column < end[:, None])
    cuts[np.arange(count), begin] = True
    line, start = np.nonzero(cuts)
    stop = np.append(start[1:], 0)
    last = np.append(line[1:] != line[:-1], True)
    stop[last] = end[line[last]]
    sums = prefix_hashes(lines.astype(np.uint8).reshape(-1))
    # a window holds its anchor, so a piece is told by its column and by all that is between the anchor and the piece's far end
    near, far = line * width + np.minimum(start, middle), line * width + np.maximum(stop, middle)
    pieces = span_hashes(sums, near, far) ^ mixed((head_of[line] * width + start).astype(np.uint64))
    _, symbol, times = np.unique(pieces, return_inverse=True, return_counts=True)
    # two pieces that only occur one behind the other are one
    _, pair, pair_times = np.unique(symbol[:-1] * len(times) + symbol[1:], return_inverse=True, return_counts=True)
    joined = ~last[:-1] & (pair_times[pair] == times[symbol[:-1]]) & (pair_times[pair] == times[symbol[1:]])
    opens, closes = np.concatenate([[True], ~joined]), np.concatenate([~joined, [True]])
    line, start, stop, symbol = line[opens], start[opens], stop[closes], symbol[opens]
    # a zero behind each line; the sequence of symbols and, beside it, what each stands for
    place = np.arange(len(line)) + line
    symbols = np.zeros(len(line) + count, np.int64)
    symbols[place] = symbol + 1
    piece_of = np.full(len(symbols), -1)
    piece_of[place] = np.arange(len(line))
    bytes_of = np.zeros(len(symbols), np.int64)
    bytes_of[place] = stop - start
    suffixes = suffix_array(symbols)
    suffixes = suffixes[piece_of[suffixes] >= 0]
    # windows begin at the anchor or left of it
    suffixes = suffixes[start[piece_of[suffixes]] <= middle]
    common = np.zeros(len(suffixes), np.int64)
    alive = np.arange(1, len(suffixes))
    a, b = suffixes[:-1].copy(), suffixes[1:].copy()
    while len(alive):
        same = (symbols[a] == symbols[b]) & (symbols[a] > 0)
        alive, a, b = alive[same], a[same], b[same]
        common[alive] += bytes_of[a]
        a, b = a + 1, b + 1
    piece = piece_of[suffixes]
    owner, first, size = line[piece], start[piece], (stop - start)[piece]
    smallest = np.full((count, PLACES), np.iinfo(np.int64).max)
    for shift in range(int(size.max(initial=0))):
        fits = np.flatnonzero((size > shift) & (first + shift <= middle) & (first + shift + LENGTH <= end[owner]))
        if not len(fits):
            continue
        begins = np.flatnonzero(common < LENGTH + shift)
        segment = np.cumsum(common < LENGTH + shift) - 1
        lowest = np.minimum.reduceat(low[owner], begins)
        smallest[owner[fits], first[fits] + shift] = lowest[segment[fits]]
    window = np.arange(PLACES)
    valid = (window >= begin[:, None]) & (window + LENGTH <= end[:, None])
    owner, at = np.nonzero(valid)
    value = smallest[owner, at]
    breaks = np.concatenate([[True], (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])]) if len(owner) else np.zeros(0, bool)
    lo = np.flatnonzero(breaks)
    hi = np.append(lo[1:], len(owner)) - 1
    useful = value[lo] < high[owner[lo]]
    lo, hi = lo[useful], hi[useful]
    return owner[lo], at[lo] - begin[owner[lo]], at[hi] - begin[owner[lo]], value[lo]


def repeated_spans(docs: DataFrame, probes: ProbeFilter, spans: int) -> DataFrame:
    """span, lo, hi, first_doc of all spans with windows that a smaller document has."""
    held = docs.sparkSession.sparkContext.broadcast(probes)
    tasks = max(16, -(-spans // TASK_ANCHORS))
    names = ["spans", "anchors", "low", "high", "left", "length"]

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts, _ in text_pieces(batch, STEP_BYTES):
                cut = Spans(texts)
                kept = held.value.may_repeat(cut)
                first, low, high = _distinct(cut, kept, _ids_of(rows)[cut.text_of])
                bucket = (mixed(cut.anchors[first]) % np.uint64(tasks)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                first, bucket = first[order], bucket[order]
                lengths = cut.length[first]
                columns = [cut.hashes[first], cut.anchors[first], low[order], high[order], cut.left[first].astype(np.uint8), lengths.astype(np.uint8)]
                yield packed_rows(bucket, dict(zip(names, columns, strict=True)), _gather(cut.data, cut.starts[first], lengths), lengths)

    schema = "bucket long, " + ", ".join(f"{n} binary" for n in [*names, "data"])
    rows = docs.select("doc_id", "text").mapInArrow(tidy(packed), schema)
    return stage(rows.groupBy("bucket").applyInArrow(_windows_of, "span long, lo int, hi int, first_doc long"), "repeated-spans")


def repeated_runs(docs: DataFrame) -> DataFrame:
    """doc_id, key, runs: the byte ranges of each text (``key`` is its xxhash64) that windows of smaller documents cover.

    Texts without such a range have no row. Ranges of one text may overlap.
    """
    known = docs.where(F.col("doc_id").isNotNull() & (F.octet_length("text") >= LENGTH)).select("doc_id", "text")
    spans = (known.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // (PLACES // 2)
    probes = repeated_probes(known, spans)
    found = repeated_spans(known, probes, spans)
    held = docs.sparkSession.sparkContext.broadcast(probes)

    def occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts, at in text_pieces(batch, STEP_BYTES):
                cut = Spans(texts)
                kept = held.value.may_repeat(cut)
                text = pa.array(cut.text_of[kept])
                arrays = [rows.column("doc_id").take(text), rows.column("key").take(text), pa.array(cut.place[kept] + at), pa.array(cut.hashes[kept].view(np.int64))]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "key", "place", "span"])

    keyed = known.withColumn("key", F.xxhash64("text"))
    rows = keyed.mapInArrow(tidy(occurrences), "doc_id long, key long, place long, span long")
    hits = rows.join(found, "span").where("first_doc < doc_id")
    run = F.struct((F.col("place") + F.col("lo")).cast("int").alias("begin"), (F.col("place") + F.col("hi") + LENGTH).cast("int").alias("end"))
    # a text's ranges are no more than its spans
    return hits.groupBy("doc_id", "key").agg(F.collect_set(run).alias("runs"))


def merged(runs: list[dict] | None) -> list[tuple[int, int]]:
    """Maximal ranges: those that overlap or touch become one."""
    out: list[tuple[int, int]] = []
    for begin, end in sorted((r["begin"], r["end"]) for r in runs or []):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((begin, end))
    return out


def _key_bits(runs: DataFrame) -> np.ndarray:
    """Bitmap of fixed size of the keys' first bits."""
    shift = 64 - KEY_BITS
    word, bit = F.shiftrightunsigned("key", shift + 6), F.expr(f"shiftleft(1L, cast(shiftrightunsigned(key, {shift}) & 63 as int))")
    held = runs.groupBy(word.alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    out = np.zeros(1 << (KEY_BITS - 6), np.int64)
    out[held.column("word").to_numpy().astype(np.int64)] = held.column("bits").to_numpy()
    return out.view(np.uint64)


def _map_with_runs(docs: DataFrame, function: Callable[[pa.RecordBatch, list, list], pa.RecordBatch], schema: T.StructType | str) -> DataFrame:
    """``function`` of slices of ``docs`` and the merged ranges of their texts.

    Only documents that may have a range, by a bitmap of fixed size, are moved to be joined; the others are mapped where they lie.
    """
    runs = stage(repeated_runs(docs), "repeated-runs")
    held = docs.sparkSession.sparkContext.broadcast(_key_bits(runs))
    keyed = docs.withColumn("_key", F.xxhash64("text"))

    def marked(batch: pa.RecordBatch, wanted: bool) -> pa.RecordBatch:
        bits = batch.column("_key").to_numpy().view(np.uint64) >> np.uint64(64 - KEY_BITS)
        found = (held.value[(bits >> np.uint64(6)).astype(np.int64)] >> (bits & np.uint64(63))) & np.uint64(1) > 0
        return batch.filter(pa.array(found == wanted))

    def to_join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield marked(batch, True)

    def without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in text_steps(marked(batch, False)):
                yield function(rows, texts, [[]] * len(texts))

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in text_steps(batch):
                yield function(rows, texts, [merged(r) for r in rows.column("_runs").to_pylist()])

    of_key = runs.select(F.col("doc_id").alias("_id"), F.col("key").alias("_found"), F.col("runs").alias("_runs"))
    same = (F.col("doc_id") == F.col("_id")) & (F.col("_key") == F.col("_found"))
    met = keyed.mapInArrow(tidy(to_join), keyed.schema).join(of_key, same, "left").select(*docs.columns, "_runs")
    return met.mapInArrow(tidy(joined), schema).union(keyed.mapInArrow(tidy(without), schema))


def removed_bytes(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]

    def digests(rows: pa.RecordBatch, texts: list[bytes], ranges: list) -> pa.RecordBatch:
        out = []
        for text, cut in zip(texts, ranges, strict=True):
            edges = [0, *(e for r in cut for e in r), len(text)]
            kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
            out.append((len(text), len(text) - len(kept), len(cut), hashlib.sha256(kept).hexdigest()))
        kinds = [pa.int64()] * 3 + [pa.string()]
        return pa.RecordBatch.from_arrays([rows.column("doc_id"), *(pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True))], names)

    return _map_with_runs(docs.select("doc_id", "text"), digests, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def cut_texts(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated bytes cut from ``text``; a character of which a byte stays is kept whole."""
    columns = [c for c in docs.columns if c != "text"]

    def cut(rows: pa.RecordBatch, texts: list[bytes], ranges: list) -> pa.RecordBatch:
        out: list[str | None] = []
        for text, there, runs in zip(texts, rows.column("text").is_valid().to_pylist(), ranges, strict=True):
            follows = lambda at, t=text: at < len(t) and t[at] & 0xC0 == 0x80
            edges = [0]
            for begin, end in runs:
                # a removed range loses its partial characters at both ends
                while follows(begin):
                    begin += 1
                while follows(end):
                    end -= 1
                if begin < end:
                    edges += [begin, end]
            edges.append(len(text))
            out.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)).decode() if there else None)
        return pa.RecordBatch.from_arrays([*rows.select(columns).columns, pa.array(out, pa.string())], [*columns, "text"])

    return _map_with_runs(docs, cut, docs.select(*columns, "text").schema).select(*docs.columns)
