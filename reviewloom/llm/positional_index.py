"""Distributed positional inverted index, and benchmark decontamination by phrase search in it.

Documents are indexed in segments of about ``SEGMENT_BYTES`` of text. A segment is one row: its documents with the position
of their first word, its terms in order, and each term's positions as one ascending list. Positions count through the segment,
with one free position between documents, so no phrase reaches from one into the next. Segments are built where the documents lie: no posting is shuffled,
and a frequent term is no hot key.

A phrase is searched from its rarest term: that list, moved back by the term's offset, gives the candidates, and
the lists of the other terms, moved alike, are intersected with them from the rarest to the most frequent. Terms
are 64-bit hashes of words.

The searched items come in blocks of a bounded number of words; each block is broadcast, and every segment is searched for
all of them. A segment looks up each distinct word of a block once; only windows of which it has all words are looked at.

Cases: null or wordless texts have no words, no hit and are not contaminated; wordless items are never found; an item with
fewer words than a window is one window; items that repeat an id count once under it; a null item_id hits words but is no
item; an empty table gives no rows, and empty items no hits. Other columns of the inputs are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame

from reviewloom.llm.common import NO_ALNUM, Words, text_steps, tidy
from reviewloom.session import stage

# Words of a window, and of the items in one broadcast block.
WINDOW = 13
BLOCK_WORDS = 1_000_000

# Text of a segment. A segment passes Spark as one row, of which its executor holds several copies, so it is no larger than a search pays for.
SEGMENT_BYTES = 1 << 19

# Candidate places, and windows, that one numpy step compares.
_STEP_CANDIDATES = 1 << 20
_STEP_WINDOWS = 1 << 16

# Row groups of some segments: a task holds one while it writes, and one while it reads, in and outside of the heap. Their size is looked at after each
# few rows, since by default a hundred go into one at least.
_INDEX_FILES = {"parquet.block.size": str(8 << 20), "parquet.page.size.row.check.min": "4"}

# Bytes of an Arrow batch of texts or segments: a Python worker and its JVM hold a few batches each.
ARROW_BATCH_BYTES = 8 << 20

_SEGMENT = "doc_ids array<long>, firsts array<long>, counts array<long>, terms array<long>, ends array<long>, positions array<int>"


def item_blocks(items: DataFrame, limit: int = BLOCK_WORDS) -> list[Broadcast]:
    """The items as broadcast blocks of (item_id, word hashes), each of about ``limit`` words."""
    context = items.sparkSession.sparkContext
    blocks, held, size = [], [], 0
    for row in items.select("item_id", "text").toLocalIterator():
        words = Words([(row["text"] or "").encode()], NO_ALNUM).hashes
        if not len(words):
            continue
        held.append((row["item_id"], words))
        size += len(words)
        if size >= limit:
            blocks.append(context.broadcast(held))
            held, size = [], 0
    if held:
        blocks.append(context.broadcast(held))
    return blocks


def build_index(docs: DataFrame) -> DataFrame:
    """Segments of ``doc_id, text`` with the postings of all their words."""

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in text_steps(batch, limit=SEGMENT_BYTES):
                words = Words(texts, NO_ALNUM)
                counts = words.counts
                firsts = words.first[:-1] + np.arange(len(texts))
                at = np.arange(len(words.hashes)) + words.text_of
                hashes = words.hashes
                order = np.argsort(hashes, kind="stable")
                terms, sizes = np.unique(hashes, return_counts=True)
                columns = [firsts, counts, terms.view(np.int64), np.cumsum(sizes)]
                arrays = [pa.array([rows.column("doc_id").to_pylist()], pa.list_(pa.int64()))]
                arrays += [pa.array([c], pa.list_(pa.int64())) for c in columns]
                arrays.append(pa.array([at[order].astype(np.int32)], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in _SEGMENT.split(", ")])

    return stage(docs.select("doc_id", "text").mapInArrow(tidy(segments), _SEGMENT), "positional-index", **_INDEX_FILES)


class Segment:
    """One segment in memory."""

    def __init__(self, batch: pa.RecordBatch, row: int):
        column = lambda name: batch.column(name)[row].values.to_numpy(zero_copy_only=False)
        self.doc_ids = batch.column("doc_ids")[row].as_py()
        self.firsts, self.counts = column("firsts"), column("counts")
        self.terms = column("terms").view(np.uint64)
        self.ends, self.positions = column("ends"), column("positions").astype(np.int64)
        self.starts = np.concatenate([[0], self.ends[:-1]]).astype(np.int64)
        lists = np.repeat(np.arange(len(self.terms)), self.ends - self.starts)
        self.keys = (lists << 32) | self.positions
        self.size = int(self.firsts[-1] + self.counts[-1] + 1) if len(self.firsts) else 0

    def lists_of(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each term's list, -1 where the segment lacks it."""
        if not len(self.terms):
            return np.full(hashes.shape, -1)
        at = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
        return np.where(self.terms[at] == hashes, at, -1)

    def has(self, lists: np.ndarray, positions: np.ndarray) -> np.ndarray:
        """Whether the lists hold the positions."""
        wanted = (lists << 32) | positions
        return (positions >= 0) & (self.keys[np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)] == wanted)

    def phrases(self, windows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Window numbers and start positions of all occurrences of equally long windows (rows of hashes)."""
        lists = self.lists_of(windows)
        alive = np.flatnonzero((lists >= 0).all(axis=1))
        for which, start in self.phrases_of(lists[alive]):
            yield alive[which], start

    def phrases_of(self, lists: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The same for windows given as rows of the numbers of their terms' lists."""
        if not len(lists):
            return
        sizes = (self.ends - self.starts)[lists]
        by_rarity = np.argsort(sizes, axis=1, kind="stable")
        first = np.take_along_axis(sizes, by_rarity[:, :1], 1)[:, 0]
        total = np.cumsum(first)
        low = 0
        while low < len(lists):
            done = total[low - 1] if low else 0
            high = max(low + 1, int(np.searchsorted(total, done + _STEP_CANDIDATES, "right")))
            which = np.repeat(np.arange(low, high), first[low:high])
            inner = np.arange(len(which)) - np.repeat(total[low:high] - first[low:high] - done, first[low:high])
            offset = by_rarity[which, 0]
            start = self.positions[self.starts[lists[which, offset]] + inner] - offset
            for k in range(1, lists.shape[1]):
                offset = by_rarity[which, k]
                keep = self.has(lists[which, offset], start + offset)
                which, start = which[keep], start[keep]
                if not len(which):
                    break
            if len(which):
                # the rarest term may stand before the segment's first position
                keep = start >= 0
                yield which[keep], start[keep]
            low = high

    def document_of(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.firsts, positions, "right") - 1

    def near(self, words: np.ndarray, slop: int) -> tuple[np.ndarray, np.ndarray]:
        """First and last positions where the words stand in order in one document, with at most ``slop`` words between them in all.

        Each occurrence of the first word gives its nearest match at most.
        """
        lists = self.lists_of(words)
        if (lists < 0).any():
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        start = self.positions[self.starts[lists[0]] : self.ends[lists[0]]]
        last = start
        for k in lists[1:]:
            place = np.searchsorted(self.keys, (k << 32) | (last + 1))
            keep = place < self.ends[k]
            start, last = start[keep], self.positions[place[keep]]
        keep = (last - start <= len(words) - 1 + slop) & (self.document_of(start) == self.document_of(last))
        return start[keep], last[keep]


def search(index: DataFrame, items: DataFrame, slop: int = 0) -> DataFrame:
    """Where whole items stand in the documents: exact phrases, or in order with up to ``slop`` words between.

    Rows: doc_id, item_id, first_word, last_word (numbers of words in the document).
    """
    blocks = item_blocks(items)

    def matches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                segment, out = Segment(batch, row), []
                for block in blocks:
                    for item_id, words in block.value:
                        if slop:
                            first, last = segment.near(words, slop)
                        else:
                            first = np.concatenate([np.zeros(0, np.int64), *(s for _, s in segment.phrases(words[None, :]))])
                            last = first + len(words) - 1
                        doc = segment.document_of(first)
                        out += [(segment.doc_ids[d], item_id, int(a - segment.firsts[d]), int(b - segment.firsts[d])) for d, a, b in zip(doc, first, last, strict=True)]
                if out:
                    arrays = [pa.array(c, pa.int64()) for c in zip(*out, strict=True)]
                    yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "item_id", "first_word", "last_word"])

    return index.mapInArrow(tidy(matches), "doc_id long, item_id long, first_word long, last_word long")


class ItemWindows:
    """Windows of a block: its distinct terms, the number of each word's term, and by length where windows begin and the item they are of."""

    def __init__(self, block: list):
        sizes = np.array([len(words) for _, words in block])
        self.terms, self.numbers = np.unique(np.concatenate([words for _, words in block]), return_inverse=True)
        ends = np.cumsum(sizes)
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for length in np.unique(np.minimum(sizes, WINDOW)).tolist():
            items = np.flatnonzero(np.minimum(sizes, WINDOW) == length)
            count = sizes[items] - length + 1
            begin = np.repeat((ends - sizes)[items] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
            self.by_length[length] = begin, np.repeat(items, count)

    def found_in(self, segment: Segment) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Length, items and start positions of the windows' occurrences."""
        lists = segment.lists_of(self.terms)[self.numbers]
        missing = np.concatenate([[0], np.cumsum(lists < 0)])
        for length, (begin, item_of) in self.by_length.items():
            alive = np.flatnonzero(missing[begin + length] == missing[begin])
            for low in range(0, len(alive), _STEP_WINDOWS):
                part = alive[low : low + _STEP_WINDOWS]
                for which, start in segment.phrases_of(lists[begin[part][:, None] + np.arange(length)]):
                    yield length, item_of[part[which]], start


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Per document: n_words, n_hit, n_items, items_sha256 and contaminated, for windows of ``items``."""
    # the segments are searched when the result is asked for, so the setting stays
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BATCH_BYTES))
    blocks = item_blocks(items)
    index = build_index(docs)
    names = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    schema = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = [ItemWindows(b.value) for b in blocks] if len(blocks) == 1 else None
        for batch in batches:
            for row in range(batch.num_rows):
                segment = Segment(batch, row)
                edges = np.zeros(segment.size + WINDOW + 1, np.int64)
                found: list[set] = [set() for _ in segment.doc_ids]
                for number, block in enumerate(blocks):
                    for length, items_of, start in (windows[number] if windows else ItemWindows(block.value)).found_in(segment):
                        np.add.at(edges, start, 1)
                        np.add.at(edges, start + length, -1)
                        pairs = np.unique(np.stack([segment.document_of(start), items_of], 1), axis=0)
                        for doc, item in pairs.tolist():
                            if (item_id := block.value[item][0]) is not None:
                                found[doc].add(item_id)
                covered = np.concatenate([[0], np.cumsum(np.cumsum(edges) > 0)])
                hit = covered[segment.firsts + segment.counts] - covered[segment.firsts]
                lists = [",".join(sorted(map(str, ids))) for ids in found]
                arrays = [
                    pa.array(segment.doc_ids, pa.int64()),
                    pa.array(segment.counts, pa.int64()),
                    pa.array(hit, pa.int64()),
                    pa.array([len(ids) for ids in found], pa.int64()),
                    pa.array([hashlib.sha256(text.encode()).hexdigest() for text in lists]),
                    pa.array((hit > 0) & (20 * hit >= segment.counts)),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names)

    return index.mapInArrow(tidy(judged), schema)
