"""Similarity join of documents by their 5-word shingles, Jaccard at least 3/4, and the groups it links.

Documents with equal sets are one class from the start. Of the classes, only those that share a shingle among their first n - ceil(3n/4) + 1
in a global order can be similar; the order puts shingles that several classes have last, and of those the ones of short words, which meet by chance. A shingle there that several classes have makes a block.

1. Each class is compared with the centre of most of its blocks; what is similar gets one label. This takes large groups of near copies together at the
   cost of one comparison a class.
2. Blocks whose classes have several labels are joined by a count-vector R-tree: shingles are hashed into ``GROUPS`` groups, a class is the
   point of its counts per group, and a node holds the maxima below it. The overlap of two classes, or of anything below two nodes, is at most the summed minima of
   their coordinates; node pairs whose bound is too small, or that have one label, are not entered. A block that is too
   large for a task is dealt into tiles, and every pair of tiles is a task. A pair belongs to the first of its common blocks in the order, as far as the first
   ``SKETCH`` blocks of both classes tell, and only that one gives it. There the two have no more in common than either has shingles from the block's
   on, so classes that meet late in their prefixes are no pair.
3. A block first gives a forest: of the pairs that may be similar, those that do not close a circle. They are bound once more by points of as many
   groups as they have shingles, verified by their shingles, and the links joined into components, which are the new labels. Blocks of which a pair was refuted
   go on, after ``FORESTS`` rounds with all their pairs of different labels.

No link between classes is lost by this: pairs of one label need no comparison to stay together, and a block goes on until each of its pairs is
verified, refuted, or joined by verified ones. Shingles are 64-bit hashes. Postings travel in packed rows; those of
very frequent shingles are spread by class.

Cases: documents without words, or null, have no shingles and stay alone; fewer than five words are one shingle; repeated rows and ids are rows of their
own, in the class of their text; null ids count only where no other id is in the group; an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.common import BLANKS, Words, mixed, text_steps, tidy
from reviewloom.llm.components import connected
from reviewloom.llm.substring_dedup import ProbeFilter, packed_rows, unpacked
from reviewloom.session import stage

SHINGLE_WORDS = 5

# Coordinates of a point, members of a leaf, and members of a tile of a block.
GROUPS = 256
LEAF = 32
TILE = 2048

# Blocks of a class that tell which block a pair belongs to, and rounds in which blocks give forests only.
SKETCH = 16
FORESTS = 1

_MOST = np.iinfo(np.uint16).max

# Postings of a task, frequent shingles that every task knows, and the largest number of the bitmap's segments, as a power of two.
BUCKET_POSTINGS = 400_000
FREQUENT = 1 << 17
FILTER_SHIFT = 20
# Documents that make a shingle's postings spread over tasks.
SPREAD_AT = 2000

# Bits of the filter that picks the texts of classes in blocks.
FILTER_BITS = 24

_FACTORS = np.random.default_rng(77).integers(1, 1 << 63, SHINGLE_WORDS, dtype=np.uint64) | np.uint64(1)
_SALTS = np.random.default_rng(78).integers(1, 1 << 63, 2, dtype=np.uint64)


def _places(texts: list[bytes]) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of the texts; of every shingle, repeats included, the text, first word, number of words and hash, by text."""
    words = Words(texts, BLANKS)
    places = np.maximum(words.counts - (SHINGLE_WORDS - 1), (words.counts > 0).astype(np.int64))
    text_of = np.repeat(np.arange(len(texts)), places)
    start = words.first[text_of] + np.arange(len(text_of)) - np.repeat(np.cumsum(places) - places, places)
    size = np.minimum(words.counts[text_of], SHINGLE_WORDS)
    padded = np.concatenate([words.hashes, np.zeros(SHINGLE_WORDS, np.uint64)])
    rolled = sum((padded[k : k + len(words.hashes)] * _FACTORS[k] for k in range(SHINGLE_WORDS)), np.zeros(len(words.hashes), np.uint64))
    total = rolled[start] + size.astype(np.uint64)
    # a text of fewer words is one shingle, without the words behind it
    short = np.flatnonzero(size < SHINGLE_WORDS)
    total[short] = size[short]
    for k in range(SHINGLE_WORDS):
        total[short] += np.where(size[short] > k, padded[start[short] + k] * _FACTORS[k], np.uint64(0))
    return words, text_of, start, size, mixed(total)


def _ranges(text_of: np.ndarray, count: int) -> Iterator[tuple[int, int]]:
    """Where each text's shingles begin and end."""
    cut = np.searchsorted(text_of, np.arange(count + 1)).tolist()
    return zip(cut[:-1], cut[1:], strict=True)


def _distinct(text_of: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Marks the first of equal shingles of a text, which stand together."""
    first = np.ones(len(hashes), bool)
    first[1:] = (text_of[1:] != text_of[:-1]) | (hashes[1:] != hashes[:-1])
    return first


def sized_shingles(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text numbers and hashes of the distinct shingles, sorted by both, and the bytes of their words."""
    words, text_of, start, size, hashes = _places(texts)
    running = np.concatenate([[0], np.cumsum(words.ends - words.starts)])
    sizes = running[start + size] - running[start]
    order = np.empty(len(hashes), np.int64)
    # sorting text by text is faster than sorting all by two keys
    for low, high in _ranges(text_of, len(texts)):
        np.add(np.argsort(hashes[low:high]), low, out=order[low:high])
    hashes, sizes = hashes[order], sizes[order]
    first = _distinct(text_of, hashes)
    return text_of[first], hashes[first], sizes[first]


def shingles(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Text numbers and hashes of the distinct shingles, sorted by both."""
    _, text_of, _, _, hashes = _places(texts)
    for low, high in _ranges(text_of, len(texts)):
        hashes[low:high].sort()
    first = _distinct(text_of, hashes)
    return text_of[first], hashes[first]


def fingerprints(text_of: np.ndarray, hashes: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Size and two 64-bit sums of each text's set."""
    cut = np.searchsorted(text_of, np.arange(count + 1))
    sums = []
    for salt in _SALTS:
        running = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(hashes ^ salt), dtype=np.uint64)])
        sums.append((running[cut[1:]] - running[cut[:-1]]).view(np.int64))
    return np.diff(cut), sums[0], sums[1]


def _sets(docs: DataFrame, carry: Sequence[str]) -> DataFrame:
    """doc_id and the carried columns, n_shingles, fp, fp2 and a number of every row."""
    names = ["doc_id", *carry]

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in text_steps(batch):
                arrays = map(pa.array, fingerprints(*shingles(texts), len(texts)))
                yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in names), *arrays], [*names, "n_shingles", "fp", "fp2"])

    source = docs.select(*names, "text")
    made = ", ".join(f"{c} {source.schema[c].dataType.simpleString()}" for c in names)
    sets = source.mapInArrow(tidy(found), f"{made}, n_shingles long, fp long, fp2 long")
    # the numbers are written with the rows, so they are the same whenever they are read
    return stage(sets.withColumn("row", F.monotonically_increasing_id()), "shingle-sets")


def _repeated_shingles(docs: DataFrame, total: int) -> tuple[ProbeFilter, np.ndarray]:
    """A bitmap, of fixed size, of the shingles that several sets may have, and the keys of very frequent ones, at most ``FREQUENT``.

    Both only shape the order and the dealing of postings: a shingle that is wrongly in the bitmap, or missing among the frequent ones, costs time, not links.
    """
    out = ProbeFilter(min(FILTER_SHIFT, max(4, (-(-total // BUCKET_POSTINGS) - 1).bit_length())))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in text_steps(batch):
                text_of, hashes = shingles(texts)
                hashes = np.sort(hashes[_first_of_each(fingerprints(text_of, hashes, len(texts))[1])[text_of]])
                yield packed_rows(out.segment_of(hashes), {"shingles": hashes.astype(np.uint32)})

    def several(group: pa.Table) -> pa.Table:
        values, counts = np.unique(unpacked(group, "shingles", "<u4"), return_counts=True)
        marks = out.segment(values[counts > 1].astype(np.uint64))
        hot = values[counts > SPREAD_AT].tobytes()
        return pa.table({"bucket": [group.column("bucket")[0].as_py()], "packed": pa.array([marks], pa.binary()), "hot": pa.array([hot], pa.binary())})

    rows = docs.select("text").mapInArrow(tidy(packed), "bucket long, shingles binary")
    keys: list[np.ndarray] = [np.zeros(0, np.int64)]
    for row in rows.groupBy("bucket").applyInArrow(several, "bucket long, packed binary, hot binary").toLocalIterator():
        out.put(row["bucket"], bytes(row["packed"]))
        if sum(map(len, keys)) < FREQUENT:
            keys.append((row["bucket"] << 32) | np.frombuffer(row["hot"], "<u4").astype(np.int64))
    return out, np.sort(np.concatenate(keys))[:FREQUENT]


def _first_of_each(fps: np.ndarray) -> np.ndarray:
    """Marks the first text of each fingerprint."""
    first = np.zeros(len(fps), bool)
    first[np.unique(fps, return_index=True)[1]] = True
    return first


def _key_of(repeated: ProbeFilter, hashes: np.ndarray) -> np.ndarray:
    return (repeated.segment_of(hashes) << 32) | (hashes & np.uint64(0xFFFFFFFF)).astype(np.int64)


def _lookup(sorted_values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(sorted_values):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(sorted_values, wanted), len(sorted_values) - 1)
    return at, sorted_values[at] == wanted


def _blocks(docs: DataFrame, postings: int, repeated: tuple[ProbeFilter, np.ndarray]) -> DataFrame:
    """shingle, fp, place: prefix shingles that several sets have, and how many shingles of the set come before in the order.

    In the order, shingles of one set alone come first; they make no block, so only the others of a prefix are sent.
    """
    spark = docs.sparkSession
    buckets = max(1, -(-postings // BUCKET_POSTINGS))
    held = spark.sparkContext.broadcast(repeated)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, hot = held.value
        for batch in batches:
            for _, texts in text_steps(batch):
                text_of, hashes, size = sized_shingles(texts)
                sizes, fp, _ = fingerprints(text_of, hashes, len(texts))
                # equal sets of a step send one posting list
                keep = _first_of_each(fp)[text_of]
                text_of, hashes, size = text_of[keep], hashes[keep], size[keep]
                several = known.holds(hashes)
                # those of one set alone take the first places, in whatever order
                alone = np.bincount(text_of[~several], minlength=len(texts))
                text_of, hashes, size = text_of[several], hashes[several], size[several]
                order = np.lexsort((hashes, -size, text_of))
                text_of, hashes = text_of[order], hashes[order]
                place = alone[text_of] + np.arange(len(text_of)) - np.searchsorted(text_of, text_of)
                sent = place <= sizes[text_of] - -(-3 * sizes[text_of] // 4)
                text_of, hashes, place = text_of[sent], hashes[sent], place[sent].astype(np.int32)
                owner = fp[text_of].view(np.uint64)
                salt = np.where(_lookup(hot, _key_of(known, hashes))[1], mixed(owner), np.uint64(0))
                bucket = ((mixed(hashes ^ _SALTS[0]) + salt) % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                cut = np.concatenate([[0], np.cumsum(np.bincount(bucket, minlength=buckets))])
                full = np.flatnonzero(np.diff(cut))
                columns = hashes[order], owner[order], place[order]
                parts = [[x[cut[b] : cut[b + 1]].tobytes() for b in full] for x in columns]
                yield pa.RecordBatch.from_arrays([pa.array(full), *(pa.array(p, pa.binary()) for p in parts)], ["bucket", "hashes", "owners", "places"])

    def shared(group: pa.Table) -> pa.Table:
        known, hot = held.value
        hashes, owners, places = unpacked(group, "hashes", "<u8"), unpacked(group, "owners", "<u8"), unpacked(group, "places", "<i4")
        order = np.lexsort((owners, hashes))
        hashes, owners, places = hashes[order], owners[order], places[order]
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (owners[1:] != owners[:-1])
        hashes, owners, places = hashes[new], owners[new], places[new]
        many = np.zeros(len(hashes), bool)
        many[1:] = hashes[1:] == hashes[:-1]
        many[:-1] |= many[1:]
        # spread shingles have their other owners elsewhere
        many |= _lookup(hot, _key_of(known, hashes))[1]
        return pa.table({"shingle": hashes[many].view(np.int64), "fp": owners[many].view(np.int64), "place": places[many]})

    rows = docs.select("text").mapInArrow(tidy(packed), "bucket long, hashes binary, owners binary, places binary")
    return stage(rows.groupBy("bucket").applyInArrow(shared, "shingle long, fp long, place int"), "shared-shingles")


def _bit_words(values: DataFrame) -> DataFrame:
    """word, bits: a bitmap of the first bits of ``fp``, of fixed size, whatever the number of rows."""
    bits = F.shiftrightunsigned("fp", 64 - FILTER_BITS)
    marks = F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(fp, {64 - FILTER_BITS}) & 63 as int))"))
    return values.groupBy(F.shiftright(bits, 6).alias("word")).agg(marks.alias("bits"))


def _filter_bits(fps: DataFrame) -> np.ndarray:
    """The bitmap of the fingerprints as an array."""
    out = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    found = _bit_words(fps).toArrow()
    out[found.column("word").to_numpy().astype(np.int64)] = found.column("bits").to_numpy()
    return out


def _class_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """rep, n, point, fine and shingles of each class in ``wanted`` (fp, fp2, n_shingles, rep), once.

    The texts are read where they lie; only rows that the bitmap lets pass are moved.
    """
    held = docs.sparkSession.sparkContext.broadcast(_filter_bits(wanted))
    key, made = ["fp", "fp2", "n_shingles"], ["point", "fine", "shingles"]

    def picked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in text_steps(batch):
                text_of, hashes = shingles(texts)
                sizes, fp, fp2 = fingerprints(text_of, hashes, len(texts))
                bits = fp.view(np.uint64) >> np.uint64(64 - FILTER_BITS)
                maybe = (held.value[(bits >> np.uint64(6)).astype(np.int64)].view(np.uint64) >> (bits & np.uint64(63))) & np.uint64(1) > 0
                chosen = np.flatnonzero(maybe & _first_of_each(fp) & (sizes > 0))
                cut = np.searchsorted(text_of, np.arange(len(texts) + 1))
                for low in range(0, len(chosen), 64):
                    part = chosen[low : low + 64]
                    sets = [hashes[cut[t] : cut[t + 1]] for t in part]
                    points = [pa.array([f(s).tobytes() for s in sets], pa.binary()) for f in (point, fine_point)]
                    lists = pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_arrays([*(pa.array(x[part]) for x in (fp, fp2, sizes)), *points, lists], [*key, *made])

    rows = docs.select("text").mapInArrow(tidy(picked), "fp long, fp2 long, n_shingles long, point binary, fine binary, shingles array<long>")
    once = rows.groupBy(*key).agg(*[F.first(c).alias(c) for c in made]).join(wanted, key)
    return stage(once.select("rep", F.col("n_shingles").alias("n"), *made), "class-sets")


def point(hashes: np.ndarray) -> np.ndarray:
    """Counts of a set's shingles per group."""
    counts = np.bincount((hashes & np.uint64(GROUPS - 1)).astype(np.int64), minlength=GROUPS)
    # one kind for all points: counts beyond it would lower the bound, so such a point says nothing and is never pruned
    return np.where((counts > _MOST).any(), _MOST, counts).astype(np.uint16)


def fine_point(hashes: np.ndarray) -> np.ndarray:
    """The same over about as many groups as the set has shingles, a power of two, in bytes."""
    groups = max(GROUPS, 1 << (max(1, len(hashes)) - 1).bit_length())
    counts = np.bincount((hashes & np.uint64(groups - 1)).astype(np.int64), minlength=groups)
    return np.where((counts > 255).any(), 255, counts).astype(np.uint8)


def fine_overlap(a: np.ndarray, b: np.ndarray) -> int:
    """At most so many shingles are in both sets: the finer point is folded to the groups of the other."""
    size = min(len(a), len(b))
    a, b = (x.reshape(-1, size).sum(0, dtype=np.int64) for x in (a, b))
    return int(np.minimum(a, b).sum())


class Tree:
    """What the nodes of an R-tree are made of: points, sizes, labels, reaches and earlier blocks of all members."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray, labels: np.ndarray, reach: np.ndarray, earlier: Sequence[frozenset] | None):
        self.points, self.sizes, self.labels, self.reach, self.earlier = points, sizes, labels, reach, earlier


class Node:
    """A node of the R-tree: maxima of its points, range of their sizes, their largest reach, their label if they have one only, and the earlier blocks that all of them are in.

    Points, blocks and children are only made of nodes that are entered: most of a large group of one label never is.
    """

    def __init__(self, tree: Tree, members: np.ndarray):
        self.tree, self.members = tree, members
        own, sizes = tree.labels[members], tree.sizes[members]
        self.label = int(own[0]) if (own == own[0]).all() else None
        self.smallest, self.largest, self.reach = int(sizes.min()), int(sizes.max()), int(tree.reach[members].max())

    @cached_property
    def high(self) -> np.ndarray:
        return self.tree.points[self.members].max(0)

    @cached_property
    def earlier(self) -> frozenset:
        if not self.tree.earlier:
            return frozenset()
        out = self.tree.earlier[self.members[0]]
        for member in self.members[1:]:
            if not out:
                break
            out &= self.tree.earlier[member]
        return out

    @cached_property
    def children(self) -> list[Node]:
        if len(self.members) <= LEAF:
            return []
        # by label first, so that a large group of one label is a subtree that is never entered from itself
        if self.label is None:
            order = self.members[np.argsort(self.tree.labels[self.members], kind="stable")]
            ends = np.flatnonzero(np.diff(self.tree.labels[order])) + 1
            middle = int(ends[np.abs(ends - len(order) // 2).argmin()])
        else:
            points = self.tree.points[self.members]
            order = self.members[np.argsort(points[:, (self.high - points.min(0)).argmax()], kind="stable")]
            middle = len(order) // 2
        return [Node(self.tree, part) for part in (order[:middle], order[middle:])]


def _by_size(labels: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The labels as numbers in the order of their smallest sets, so that the nodes of a tree hold sets of like sizes."""
    names, number = np.unique(labels, return_inverse=True)
    smallest = np.full(len(names), np.iinfo(np.int64).max)
    np.minimum.at(smallest, number, sizes)
    rank = np.empty(len(names), np.int64)
    rank[np.argsort(smallest, kind="stable")] = np.arange(len(names))
    return rank[number]


def candidate_pairs(
    points: np.ndarray,
    sizes: np.ndarray,
    labels: np.ndarray,
    side: np.ndarray | None = None,
    earlier: Sequence[frozenset] | None = None,
    forest: bool = False,
    reach: np.ndarray | None = None,
) -> list[tuple[int, int]]:
    """Pairs of different labels whose overlap may be enough. ``side`` (0, 1) asks for pairs across the sides only.

    Pairs that share one of their ``earlier`` blocks are left to it. ``forest`` leaves out pairs between which the pairs found before them make a path.
    ``reach`` is the number of a set's shingles from the block's on: two sets of which that is the first common one have no more in common.
    """
    if len(points) < 2:
        return []
    everything, labels, reach = np.arange(len(points)), _by_size(labels, sizes), sizes if reach is None else reach
    tree = Tree(points, sizes, labels, reach, earlier)
    if side is None:
        root = Node(tree, everything)
        waiting = [(root, root)]
    else:
        parts = [everything[side == s] for s in (0, 1)]
        if not len(parts[0]) or not len(parts[1]):
            return []
        waiting = [tuple(Node(tree, p) for p in parts)]
    joined = np.array(labels)
    out: list[tuple[int, int]] = []
    while waiting:
        a, b = waiting.pop()
        if a.label is not None and a.label == b.label or 4 * a.largest < 3 * b.smallest or 4 * b.largest < 3 * a.smallest:
            continue
        if 7 * min(a.reach, b.reach) < 3 * (a.smallest + b.smallest) or not a.earlier.isdisjoint(b.earlier):
            continue
        if 7 * int(np.minimum(a.high, b.high).sum(dtype=np.int64)) < 3 * (a.smallest + b.smallest):
            continue
        if forest and (joined[a.members] == joined[b.members[0]]).all() and (joined[b.members] == joined[b.members[0]]).all():
            continue
        if a is b and a.children:
            # the halves come before what lies between them: what they join is not looked at again
            waiting += [(a.children[0], a.children[1]), (a.children[1], a.children[1]), (a.children[0], a.children[0])]
        elif a.children and (not b.children or len(a.members) >= len(b.members)):
            waiting += [(child, b) for child in a.children]
        elif b.children:
            waiting += [(a, child) for child in b.children]
        else:
            i, j = np.repeat(a.members, len(b.members)), np.tile(b.members, len(a.members))
            keep = (joined[i] != joined[j]) & (7 * np.minimum(reach[i], reach[j]) >= 3 * (sizes[i] + sizes[j]))
            if a is b:
                keep &= i < j
            i, j = i[keep], j[keep]
            near = 7 * np.minimum(points[i], points[j]).sum(1, dtype=np.int64) - 3 * (sizes[i] + sizes[j])
            # the likeliest first, so that a forest has few pairs that are refuted
            order = np.argsort(-near, kind="stable")
            order = order[near[order] >= 0]
            for i, j in zip(i[order].tolist(), j[order].tolist(), strict=True):
                if forest and joined[i] == joined[j] or earlier and not earlier[i].isdisjoint(earlier[j]):
                    continue
                out.append((i, j))
                if forest:
                    joined[joined == joined[j]] = joined[i]
    return out


def _tree_pairs(rows: DataFrame, turn: int) -> DataFrame:
    """shingle, a, b: candidate pairs of each block in ``rows`` (shingle, rep, place, label, n, point, earlier, tiles), a forest of them in early turns."""

    def pairs(group: pa.Table) -> pa.Table:
        # another order, and so another forest, each turn
        group = group.take(pa.array(np.random.default_rng(turn).permutation(len(group))))
        points = np.frombuffer(b"".join(group.column("point").to_pylist()), np.uint16).reshape(-1, GROUPS)
        n, label, rep, tile, place = (group.column(c).to_numpy() for c in ("n", "label", "rep", "tile", "place"))
        shingle, i, j = (group.column(c)[0].as_py() for c in ("shingle", "i", "j"))
        earlier = [frozenset(e) for e in group.column("earlier").to_pylist()]
        found = candidate_pairs(points, n, label, None if i == j else (tile == j).astype(int), earlier, turn < FORESTS, n - place)
        a, b = (np.array([rep[p[k]] for p in found], np.int64) for k in (0, 1))
        return pa.table({"shingle": np.full(len(found), shingle, np.int64), "a": np.minimum(a, b), "b": np.maximum(a, b)})

    # a member of tile t meets all tiles: the pairs (t, k) and (k, t)
    dealt = rows.withColumn("tile", F.pmod(F.xxhash64("rep"), "tiles")).withColumn("k", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    dealt = dealt.withColumns({"i": F.least("tile", "k").cast("long"), "j": F.greatest("tile", "k").cast("long"), "tile": F.col("tile").cast("long")})
    narrow = dealt.select("shingle", "i", "j", "tile", "rep", "place", "label", "n", "point", "earlier")
    return narrow.groupBy("shingle", "i", "j").applyInArrow(pairs, "shingle long, a long, b long")


def _bounded(pairs: DataFrame, points: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose sizes and fine points leave them a chance."""
    sides = [points.select(F.col("rep").alias(s), F.col("n").alias(f"n{s}"), F.col("fine").alias(f"p{s}")) for s in "ab"]
    both = pairs.join(sides[0], "a").join(sides[1], "b").where("4 * na >= 3 * nb and 4 * nb >= 3 * na").select("a", "b", "na", "nb", "pa", "pb")

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = [[np.frombuffer(x, np.uint8) for x in batch.column(c).to_pylist()] for c in ("pa", "pb")]
            total = batch.column("na").to_numpy() + batch.column("nb").to_numpy()
            overlap = np.fromiter(map(fine_overlap, *points), np.int64, batch.num_rows)
            yield batch.select(["a", "b"]).filter(pa.array(7 * overlap >= 3 * total))

    return both.mapInArrow(tidy(kept), "a long, b long")


def _verified(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose sets are similar. Sets that the bitmap of their classes leaves out are not moved."""
    place, at = f"shiftrightunsigned(xxhash64(rep), {64 - FILTER_BITS})", f"cast(shiftrightunsigned(xxhash64(rep), {64 - FILTER_BITS}) & 63 as int)"
    either = pairs.select(F.col("a").alias("rep")).union(pairs.select(F.col("b").alias("rep")))
    words = F.broadcast(_bit_words(either.select(F.xxhash64("rep").alias("fp"))))
    maybe = sets.select("rep", "n", "shingles", F.expr(f"shiftright({place}, 6)").alias("word")).join(words, "word").where(f"shiftright(bits, {at}) & 1 = 1")
    sides = [maybe.select(F.col("rep").alias(s), F.col("n").alias(f"n{s}"), F.col("shingles").alias(f"s{s}")) for s in "ab"]
    overlap = F.size(F.array_intersect("sa", "sb"))
    return pairs.join(sides[0], "a").join(sides[1], "b").where(7 * overlap >= 3 * (F.col("na") + F.col("nb"))).select("a", "b")


def _relabelled(blocks: DataFrame, groups: DataFrame) -> DataFrame:
    """The members of blocks with the labels of ``groups`` (node, root); classes in no group are their own."""
    return blocks.join(groups.withColumnRenamed("node", "rep"), "rep", "left").withColumn("label", F.coalesce("root", "rep")).drop("root")


def _linked(blocks: DataFrame, sets: DataFrame, near: DataFrame) -> DataFrame:
    """node, root of the classes that links join, from the blocks (shingle, rep, place) and what is joined already."""
    labelled = stage(_relabelled(blocks, near), "labelled-blocks")
    # blocks of the same members are one; their sums of hashes tell
    marks = [F.sum(F.xxhash64("rep", F.lit(k)).cast("decimal(20,0)")).alias(f"mark{k}") for k in (0, 1)]
    counts = F.count(F.lit(1)).alias("m"), F.sum("place").alias("places")
    mixed_blocks = labelled.groupBy("shingle").agg(F.min("label").alias("l"), F.max("label").alias("h"), *counts, *marks).where("l <> h")
    # of these the first in the order, which every member has before the others
    single = mixed_blocks.groupBy("m", "mark0", "mark1").agg(F.min_by("shingle", F.struct("places", "shingle")).alias("shingle"))
    single = single.select("shingle", F.ceil(F.col("m") / TILE).cast("int").alias("tiles"))
    members = stage(labelled.drop("label").join(single, "shingle"), "mixed-blocks")
    first = members.groupBy("rep").agg(F.slice(F.array_sort(F.collect_list(F.struct("place", "shingle"))), 1, SKETCH).alias("first"))
    classes = stage(first.join(sets.select("rep", "n", "point"), "rep"), "members")
    tried: DataFrame | None = None
    for turn in range(FORESTS + 1):
        rows = _relabelled(members, near).join(classes, "rep").withColumn("earlier", F.filter("first", lambda s: s["place"] < F.col("place"))["shingle"]).drop("first")
        given = stage(_tree_pairs(rows, turn), "tree-pairs")
        pairs = given.select("a", "b").distinct()
        new = pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti")
        links = stage(_verified(sets, stage(_bounded(new, sets), "likely-pairs")), "links")
        near = stage(connected(links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(near.select(F.col("node").alias("u"), F.col("root").alias("v")))), "components")
        if turn == FORESTS:
            break
        tried = pairs if tried is None else tried.union(new)
        # where all pairs of a forest are joined, so is what they left out
        root = lambda c: near.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}"))
        apart = given.join(root("a"), "a", "left").join(root("b"), "b", "left").where(~F.coalesce("root_a", "a").eqNullSafe(F.coalesce("root_b", "b")))
        left = stage(apart.select("shingle").distinct(), "refuted-blocks")
        if left.isEmpty():
            break
        members = stage(members.join(left, "shingle", "left_semi"), "mixed-blocks")
    return near


def _star(blocks: DataFrame) -> DataFrame:
    """a, b: for each class the centre of most of its blocks, unless it is that itself.

    The centre of a block is its class of most blocks: edits put shingles of their own into a prefix, so of near copies the least edited one has most
    shared ones, and that one resembles more of the others than any.
    """
    degree = blocks.groupBy("rep").agg(F.count(F.lit(1)).alias("degree"))
    centres = blocks.join(degree, "rep").groupBy("shingle").agg(F.max(F.struct("degree", (-F.col("rep")).alias("rep"))).alias("c"))
    met = blocks.join(centres, "shingle").groupBy("rep", "c").agg(F.count(F.lit(1)).alias("times"))
    best = met.groupBy("rep").agg(F.max(F.struct("times", "c")).alias("best"))
    return best.select(F.col("rep").alias("a"), (-F.col("best.c.rep")).alias("b")).where("a <> b")


def similar_classes(docs: DataFrame, carry: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(doc_id, carried columns, n_shingles, rep) of every row, and (rep, first_id, label) of every class; both from staged tables.

    ``rep`` is the number of one of the rows with a class's set, so rows that share an id are in the classes of their texts; ``label`` is one of the
    numbers of its component, and ``first_id`` the smallest doc_id of the class. Rows without shingles have no class.
    """
    sets = _sets(docs, carry)
    key = ["fp", "fp2", "n_shingles"]
    reps = sets.where("n_shingles > 0").groupBy(*key).agg(F.min("row").alias("rep"), F.min("doc_id").alias("first_id"))
    reps = stage(reps, "classes")
    total = sets.agg(F.sum("n_shingles")).first()[0] or 0
    shared = _blocks(docs, total // 4, _repeated_shingles(docs, total))
    blocks = stage(shared.join(reps.select("fp", "rep"), "fp").select("shingle", "rep", "place"), "blocks")
    wanted = reps.join(blocks.select("rep").distinct(), "rep", "left_semi").drop("first_id")
    class_sets = _class_sets(docs, stage(wanted, "block-classes"))
    # one comparison a class
    likely = stage(_bounded(stage(_star(blocks), "tree-pairs"), class_sets), "likely-pairs")
    near = stage(connected(_verified(class_sets, likely).select(F.col("a").alias("u"), F.col("b").alias("v"))), "near-labels")
    groups = _linked(blocks, class_sets, near).select(F.col("node").alias("rep"), F.col("root").alias("label"))
    labelled = reps.select("rep", "first_id").join(groups, "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    return sets.join(reps.select(*key, "rep"), key, "left").select("doc_id", *carry, "n_shingles", "rep"), stage(labelled, "class-labels")


def jaccard_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id: the smallest doc_id that links reach."""
    rows, classes = similar_classes(docs)
    smallest = classes.groupBy("label").agg(F.min("first_id").alias("component_id"))
    named = stage(classes.join(smallest, "label").select("rep", "component_id"), "component-ids")
    joined = rows.join(named, "rep", "left")
    return joined.select("doc_id", "n_shingles", F.when(F.col("rep").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def similar_groups(docs: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """doc_id, the carried columns, and ``group``: a number that the rows of a component share, null for rows without shingles."""
    rows, classes = similar_classes(docs, carry)
    return rows.join(classes.select("rep", F.col("label").alias("group")), "rep", "left").select("doc_id", *carry, "group")
