"""Fill-in-the-middle transformation, with cuts located through memoized content-defined chunks.

A rolling hash over the last ``HASH_BYTES`` bytes cuts a text into chunks, so copies and near copies of a text have most chunks in common.
A worker keeps a summary of each chunk it has seen, found by the chunk's bytes themselves: its units and characters, and whether a letter stands
at either end. The units of a text are the sums of its chunks' units, less one wherever a letter run passes a boundary, and a cut is
found by looking for its chunk in the running sums and walking through that chunk alone.

Units are runs of ASCII letters and single other characters. The two cuts, the form and whether a text stays plain come from the SHA-256 of
``seed:doc_id``.

Cases: a null text counts as empty, and an empty one stays plain; so does a text that holds a marker, since it could not be told from an inserted
one; a null id is hashed as an empty text; repeated rows and ids are transformed alike and all stay; an empty table gives no rows; a text of
any length is hashed in steps. Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.common import prefix_hashes, span_hashes, text_steps

# The markers of the three parts.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

# Bytes under the rolling hash, the chunks' mean and least lengths, and the length at which a text without a cut is cut anyway.
HASH_BYTES = 32
MEAN_CHUNK, MIN_CHUNK, MAX_CHUNK = 512, 64, 8192

# Bytes hashed at a time, and bytes of chunks that a worker's table may hold.
STEP = 1 << 20
MEMO_BYTES = 32 << 20

_LETTERS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
# Bytes that continue a character are left out; of the others, letters become "a" and the rest a blank.
_CONTINUES = bytes(range(0x80, 0xC0))
_KINDS = bytes(ord("a") if b in _LETTERS else ord(" ") for b in range(256))


def _kinds(chunk: bytes) -> bytes:
    """One byte per character: "a" for a letter, a blank for anything else."""
    return chunk.translate(_KINDS, _CONTINUES)


@dataclass(frozen=True, slots=True)
class Summary:
    """What a text needs to know of one of its chunks."""

    units: int
    chars: int
    letter_first: bool
    letter_last: bool


class Chunks:
    """Summaries of chunks, each computed once while the table has room; a full table starts anew."""

    def __init__(self, limit: int = MEMO_BYTES):
        self.limit, self.held, self.known = limit, 0, {}

    def summary(self, chunk: bytes) -> Summary:
        found = self.known.get(chunk)
        if found is None:
            kinds = _kinds(chunk)
            runs = kinds.count(b" a") + kinds.startswith(b"a")
            found = Summary(runs + kinds.count(b" "), len(kinds), kinds.startswith(b"a"), kinds.endswith(b"a"))
            if self.held > self.limit:
                self.known.clear()
                self.held = 0
            self.known[chunk] = found
            self.held += len(chunk)
        return found


def _candidates(text: bytes) -> np.ndarray:
    """Ends of the windows whose hash falls on the cutting residue, in steps of bounded memory."""
    found = []
    for low in range(0, len(text), STEP):
        first = max(0, low - HASH_BYTES + 1)
        data = np.frombuffer(text, np.uint8, min(len(text), low + STEP) - first, first)
        if len(data) < HASH_BYTES:
            continue
        starts = np.arange(len(data) - HASH_BYTES + 1)
        hashes = span_hashes(prefix_hashes(data), starts, starts + HASH_BYTES)
        found.append(np.flatnonzero(hashes % np.uint64(MEAN_CHUNK) == 0) + first + HASH_BYTES)
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def chunk_ends(text: bytes) -> list[int]:
    """Ends of a text's chunks: between characters, and decided by the bytes before them."""
    ends, last = [], 0

    def cut(at: int) -> None:
        nonlocal last
        while at < len(text) and text[at] & 0xC0 == 0x80:
            at += 1
        ends.append(at)
        last = at

    for at in [*_candidates(text).tolist(), len(text)]:
        while at - last > MAX_CHUNK:
            cut(last + MAX_CHUNK)
        if at - last >= MIN_CHUNK:
            cut(at)
    return ends if last == len(text) else [*ends, len(text)]


class Located:
    """The chunks of one text, ready to be asked for its units and where they begin."""

    def __init__(self, text: bytes, chunks: Chunks):
        self.text, self.ends = text, chunk_ends(text)
        begins = [0, *self.ends[:-1]]
        summaries = [chunks.summary(text[a:b]) for a, b in zip(begins, self.ends)]
        # a letter run that passes a boundary is one unit, of the chunk in which it begins
        goes_on = [False, *(a.letter_last and b.letter_first for a, b in zip(summaries, summaries[1:]))]
        self.goes_on = goes_on[: len(summaries)]
        self.units = np.cumsum([s.units - g for s, g in zip(summaries, self.goes_on)], dtype=np.int64)
        self.chars = np.cumsum([s.chars for s in summaries], dtype=np.int64)

    @property
    def count(self) -> int:
        return int(self.units[-1]) if len(self.units) else 0

    def cut(self, units: int) -> int:
        """Characters of the first ``units`` units, i.e. where the next one begins."""
        if units >= self.count:
            return int(self.chars[-1]) if len(self.chars) else 0
        at = int(np.searchsorted(self.units, units, "right"))
        begin, units_before, chars_before = (self.ends[at - 1], self.units[at - 1], self.chars[at - 1]) if at else (0, 0, 0)
        kinds = np.frombuffer(_kinds(self.text[begin : self.ends[at]]), np.uint8)
        begins_unit = kinds == ord(" ")
        begins_unit[1:] |= begins_unit[:-1]
        begins_unit[0] = begins_unit[0] or not self.goes_on[at]
        return int(chars_before + np.flatnonzero(begins_unit)[units - units_before])


_worker_chunks = Chunks()


def _draw(group: int, seed: int) -> Column:
    """The ``group``-th eight hex digits of the hash of seed and id, as a number."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digest, 8 * group - 7, 8), 16, 10).cast("long")


def fill_middle(docs: DataFrame, seed: int = 1, plain_percent: int = 10, spm_percent: int = 20) -> DataFrame:
    """doc_id, n, form (plain, psm or spm), prefix_chars, middle_chars and the output text."""

    def located(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in text_steps(batch):
                found = [Located(t, _worker_chunks) for t in texts]
                draws = zip(found, rows.column("h1").to_pylist(), rows.column("h2").to_pylist(), strict=True)
                units = [sorted((h1 % (f.count + 1), h2 % (f.count + 1))) for f, h1, h2 in draws]
                cuts = [[f.cut(a), f.cut(b)] for f, (a, b) in zip(found, units, strict=True)]
                counts = pa.array([f.count for f in found], pa.int64())
                sides = [pa.array([c[k] for c in cuts], pa.int64()) for k in (0, 1)]
                kept = [rows.column(name) for name in ("doc_id", "text", "h3", "h4")]
                yield pa.RecordBatch.from_arrays([*kept, counts, *sides], ["doc_id", "text", "h3", "h4", "n", "low", "high"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    drawn = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *[_draw(k, seed).alias(f"h{k}") for k in (1, 2, 3, 4)])
    cut = drawn.mapInArrow(located, f"doc_id {id_type}, text string, h3 long, h4 long, n long, low long, high long")
    text = F.col("text")
    marked = F.contains(text, F.lit(PREFIX)) | F.contains(text, F.lit(SUFFIX)) | F.contains(text, F.lit(MIDDLE))
    plain = (text == "") | marked | (F.col("h3") % 100 >= 100 - plain_percent)
    form = F.when(plain, "plain").when(F.col("h4") % 100 < spm_percent, "spm").otherwise("psm")
    formed = cut.select("doc_id", "text", "n", "low", "high", form.alias("form"))
    low, high = F.col("low").cast("int"), F.col("high").cast("int")
    prefix, middle, suffix = F.substring(text, F.lit(1), low), F.substring(text, low + 1, high - low), F.substring(text, high + 1, F.length(text))
    output = (
        F.when(F.col("form") == "plain", text)
        .when(F.col("form") == "psm", F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle))
        .otherwise(F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle))
    )
    cut_form = F.col("form") != "plain"
    return formed.select(
        "doc_id",
        "n",
        "form",
        F.when(cut_form, F.col("low")).alias("prefix_chars"),
        F.when(cut_form, F.col("high") - F.col("low")).alias("middle_chars"),
        output.alias("output"),
    )


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made from: a marker stands once in it, since texts that hold one stay plain."""
    first, second = F.when(form == "psm", F.lit(SUFFIX)).otherwise(F.lit(PREFIX)), F.lit(MIDDLE)
    after = F.substring(output, F.lit(len(PREFIX) + 1), F.length(output))
    a, rest = F.split_part(after, first, F.lit(1)), F.split_part(after, first, F.lit(2))
    b, middle = F.split_part(rest, second, F.lit(1)), F.split_part(rest, second, F.lit(2))
    return F.when(form == "plain", output).when(form == "psm", F.concat(a, middle, b)).otherwise(F.concat(b, middle, a))
