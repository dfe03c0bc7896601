"""Importance resampling, SimHash fingerprints and fill-in-the-middle against brute force, with odd rows."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

import oracle_check  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from reviewloom.llm import fill_middle, importance_resampling, simhash  # noqa: E402
from reviewloom.llm.common import table  # noqa: E402
from reviewloom.llm.registry import ORACLES, QUERIES  # noqa: E402

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]")

LINE = "One two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty"
TEXTS = [
    None,
    "",
    " \n\t ",
    "word",
    "Two words",
    "three little words",
    LINE,
    LINE,
    LINE.upper() + "!",
    (LINE + "\n") * 200,
    "x" * 30_000,
    "x" * 30_000 + "é" * 20_000 + "y" * 9_000,
    "ab " * 9_000,
    "Ünïcödé ñandú größe 東京は夜 naïve İstanbul é z w กำ 'ſ " * 20,
    "a <P> marker " * 30,
    "it's 1234½ \x00\x1c\x85 a_b-c \U0001f600",
    " ".join(f"w{i} {i * i}" for i in range(20_000)),
]


def rows_of(texts):
    rows = list(enumerate(texts))
    return rows + [(3, "word"), (6, LINE), (None, LINE), (None, None), (-5, "minus five and " * 9)]


@pytest.fixture(scope="module")
def odd(spark):
    frame = spark.createDataFrame(rows_of(TEXTS), "doc_id long, text string")
    clashing = ["n_words", "buckets", "weight", "score", "rank", "place", "part", "first", "fp", "key", "n", "low", "h1", "form", "output", "_file", "count"]
    return frame.select("*", *[F.lit("x").alias(c) for c in clashing])


def bag(frame, *names):
    return Counter(tuple(r[n] for n in names) for r in frame.select(*names).collect())


# 11: importance resampling


def grams(text):
    words = WORD.findall((text or "").translate(LOWER))
    return len(words), [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def resampled(rows, target):
    def bucket(gram):
        return zlib.crc32(gram.encode()) % 10_000

    found = [(d, *grams(t)) for d, t in rows]
    s = Counter(bucket(g) for _, _, gs in found for g in gs)
    t = Counter(bucket(g) for text in target for g in grams(text)[1])
    scale = (sum(s.values()) + 10_000, sum(t.values()) + 10_000)
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * scale[0] / ((s[b] + 1) * scale[1]))) for b in {*s, *t}}
    scored = []
    for d, n, gs in found:
        h = int(hashlib.sha256(f"42:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[bucket(g)] for g in gs)
        scored.append((d, n, len(gs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    many = [x for x in scored if x[1] >= 20]
    many.sort(key=lambda x: (-x[4], x[0] is None, x[0] or 0, x[2]))
    drawn = Counter()
    for place, x in enumerate(many[: 5 * len(many) // 100], 1):
        drawn[x + (place,)] += 1
    taken = Counter(x[:5] for x in drawn.elements())
    rest = Counter(scored) - taken
    return Counter((d, f, w, c, r) for d, _, f, w, c, r in drawn.elements()) + Counter((d, f, w, c, None) for d, _, f, w, c in rest.elements())


FIELDS = ["doc_id", "n_features", "weight", "score", "rank"]


def test_hashes_are_those_of_the_runs():
    for text in TEXTS:
        want = Counter(zlib.crc32(g.encode()) for g in grams(text)[1])
        assert Counter(importance_resampling.gram_hashes((text or "").encode())) == want


def test_resampling_of_odd_rows(odd):
    copies = odd.select("doc_id", "text", "score").unionAll(odd.select(F.col("doc_id") + 100, "text", "score"))
    rows = [(r["doc_id"], r["text"]) for r in copies.collect()]
    target = ["Seven eight nine, ten!", None, "", "naïve größe"]
    items = odd.sparkSession.createDataFrame([(t,) for t in target], "text string")
    assert bag(importance_resampling.resample(copies, items), *FIELDS) == resampled(rows, target)


def test_resampling_draws_what_the_target_is_like(spark):
    rows = [(i, " ".join(f"{'alpha' if i % 10 == 0 else 'omega'}{(i * 7 + j) % 13}" for j in range(40))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    target = spark.createDataFrame([(" ".join(f"alpha{j % 13}" for j in range(60)),)], "text string")
    ranked = importance_resampling.resample(docs, target)
    drawn = [r["doc_id"] for r in ranked.where("rank is not null").orderBy("rank").collect()]
    assert len(drawn) == 20 and all(d % 10 == 0 for d in drawn)
    assert {r["doc_id"] for r in importance_resampling.drawn_documents(docs, ranked).collect()} == set(drawn)


def test_resampling_of_empty_tables(odd):
    empty = odd.limit(0)
    assert importance_resampling.resample(empty, odd).count() == 0
    ranked = importance_resampling.resample(odd, empty)
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert bag(ranked, *FIELDS) == resampled(rows, [])


# 12: SimHash


def slow_mark(text, bits=simhash.BITS):
    """Votes term by term; the hashes of the words come from the library."""
    words = simhash.Words([text], simhash.BLANKS).hashes
    with np.errstate(over="ignore"):
        terms = Counter(int(w) >> 16 for w in words)
        for a, b in zip(words[:-1], words[1:]):
            terms[int(simhash.mixed(np.array([a * simhash._PAIR + b]))[0]) >> 16] += 1
        out = []
        for part in range(bits // 64):
            votes = [0] * 64
            for term, count in terms.items():
                h = int(simhash.mixed((np.array([term], np.uint64) + np.uint64(1)) * simhash._PARTS[part])[0])
                for at in range(64):
                    votes[at] += count.bit_length() * (1 if h >> (63 - at) & 1 else -1)
            out += [v > 0 for v in votes]
    return np.packbits(out).tobytes()


def differing(a, b):
    return (int.from_bytes(a) ^ int.from_bytes(b)).bit_count()


def test_marks_are_signed_votes(monkeypatch):
    texts = [(t or "").encode() for t in TEXTS if len(t or "") < 5000]
    want = [slow_mark(t) for t in texts]
    assert [f.tobytes() for f in simhash.fingerprints_of(texts)] == want
    monkeypatch.setattr(simhash, "VOTE_BYTES", 100)
    assert [f.tobytes() for f in simhash.fingerprints_of(texts)] == want


def expected_comparison(rows):
    mark = {t: simhash.fingerprints_of([t.encode()])[0].tobytes() for t in {t or "" for _, t in rows}}
    out = Counter()
    for (d, t), (_, after) in zip(rows, rows[1:] + rows[:1]):
        t, after = t or "", after or ""
        half = len(t) // 2
        edit = t[: len(t) - half] + after[:half]
        m = simhash.fingerprints_of([edit.encode()])[0].tobytes()
        near = [1 - differing(mark[t], x) / simhash.BITS for x in (m, mark[after])]
        out[(d, len(t), hashlib.sha256(edit.encode()).hexdigest(), mark[t].hex(), m.hex(), *near)] += 1
    return out


COMPARED = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


@pytest.mark.parametrize("parts", [1, 4, 40])
def test_every_document_meets_its_successor(spark, sf_dir, parts):
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        docs = table(spark, sf_dir, "documents")
        rows = sorted(((r["doc_id"], r["text"]) for r in docs.collect()), reverse=True)
        found = simhash.document_fingerprints(docs, scanned=True)
        assert bag(found, *COMPARED) == expected_comparison(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_comparison_of_odd_rows(spark, odd):
    # ids apart from each other: the order of equal ones is that of the files
    rows = [(i, t) for i, (_, t) in enumerate(rows_of(TEXTS))] + [(None, LINE)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    down = sorted(rows, key=lambda r: -1 if r[0] is None else r[0], reverse=True)
    assert bag(simhash.document_fingerprints(frame), *COMPARED) == expected_comparison(down)
    found = simhash.document_fingerprints(odd).collect()
    assert Counter(r["doc_id"] for r in found) == Counter(d for d, _ in rows_of(TEXTS))
    marks = simhash.fingerprint(odd).collect()
    assert {(r["doc_id"], r["fingerprint"]) for r in found} == {(r["doc_id"], r["fingerprint"].hex()) for r in marks}
    assert simhash.document_fingerprints(odd.limit(0)).count() == 0
    (alone,) = simhash.document_fingerprints(odd.where("doc_id = 4")).collect()
    assert alone["near_next"] == 1.0


def test_tables_find_all_pairs_of_the_radius(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 256, (40, 16), dtype=np.uint8)
    marks = [bytes(b) for b in base]
    for b in base:  # near ones at every distance up to six
        for flips in range(1, 7):
            bits = np.unpackbits(b)
            bits[rng.choice(128, flips, replace=False)] ^= 1
            marks.append(np.packbits(bits).tobytes())
    marks += [marks[0]] * 50 + [None, b"\x00" * 16, b"\xff" * 16]
    frame = spark.createDataFrame([(m,) for m in marks], "fingerprint binary")
    distinct = {m for m in marks if m is not None}
    for radius, blocks in ((3, 5), (0, 2), (1, 4), (4, 6)):
        want = Counter((a, b, differing(a, b)) for a in distinct for b in distinct if 0 < differing(a, b) <= radius)
        found = simhash.near_pairs(frame, radius=radius, blocks=blocks)
        assert Counter((bytes(r["a"]), bytes(r["b"]), r["distance"]) for r in found.collect()) == want
    counts = simhash.near_counts(frame).collect()
    assert len(counts) == len(marks)
    for r in counts:
        m = r["fingerprint"]
        assert r["n_near"] == (0 if m is None else sum(0 < differing(bytes(m), o) <= simhash.RADIUS for o in distinct))
    with pytest.raises(ValueError):
        simhash.near_pairs(frame, radius=5, blocks=5)


def test_likeness_tells_edits_from_strangers(spark, sf_dir):
    rows = QUERIES["op12_simhash"](spark, sf_dir).where("n_chars > 100 and near_next < 1").collect()
    assert np.mean([r["near_edited"] > r["near_next"] for r in rows]) > 0.97


# 13: fill in the middle


def filled(rows):
    out = Counter()
    for d, text in rows:
        text = text or ""
        units = UNIT.findall(text)
        n = len(units)
        digest = hashlib.sha256(f"1:{'' if d is None else d}".encode()).hexdigest()
        h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
        a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
        pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
        if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
            out[(d, n, "plain", None, None, text)] += 1
        elif h4 % 100 < 20:
            out[(d, n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}")] += 1
        else:
            out[(d, n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}")] += 1
    return out


FILLED = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]


def test_fill_middle_of_odd_rows(odd):
    # every odd text under many ids, so that all forms and cuts occur
    many = odd.select(F.explode(F.sequence(F.lit(0), F.lit(9))).alias("k"), "*").select((F.col("doc_id") + F.col("k") * 1000).alias("doc_id"), "text", "form")
    rows = [(r["doc_id"], r["text"]) for r in many.collect()]
    made = fill_middle.fill_middle(many)
    assert bag(made, *FILLED) == filled(rows)
    texts = made.select("doc_id", fill_middle.restored(F.col("output"), F.col("form")).alias("text"))
    assert bag(texts, "doc_id", "text") == Counter((d, t or "") for d, t in rows)
    assert fill_middle.fill_middle(odd.limit(0)).count() == 0


@pytest.mark.parametrize("limits", [(512, 64, 8192, 32 << 20), (8, 1, 50, 100), (64, 40, 90, 0)])
def test_cuts_at_every_unit(monkeypatch, limits):
    for name, value in zip(("MEAN_CHUNK", "MIN_CHUNK", "MAX_CHUNK"), limits):
        monkeypatch.setattr(fill_middle, name, value)
    monkeypatch.setattr(fill_middle, "STEP", 1000)
    chunks = fill_middle.Chunks(limits[3])
    rng = np.random.default_rng(3)
    texts = ["".join(rng.choice(list("ab .é東\U0001f600"), 700)) for _ in range(5)] + [t[:3000] for t in TEXTS if t]
    for text in texts:
        found, units = fill_middle.Located(text.encode(), chunks), UNIT.findall(text)
        assert found.count == len(units)
        ends = np.cumsum([0] + [len(u) for u in units])
        for k in range(0, len(units) + 1, max(1, len(units) // 300)):
            assert found.cut(k) == ends[k]


def test_copies_share_their_chunks():
    rng = np.random.default_rng(1)
    text = " ".join(f"word{i}" for i in rng.integers(0, 10_000, 5000)).encode()
    changed = text[:9000] + b"something else" + text[9010:]
    cut = [{t[a:b] for a, b in zip([0, *ends], ends)} for t, ends in ((t, fill_middle.chunk_ends(t)) for t in (text, changed))]
    assert len(cut[0] & cut[1]) >= len(cut[0]) - 4
    chunks = fill_middle.Chunks()
    fill_middle.Located(text, chunks)
    before = len(chunks.known)
    fill_middle.Located(changed, chunks)
    assert len(chunks.known) <= before + 4


@pytest.mark.parametrize("name", ["op11_importance_resampling", "op13_fill_middle"])
def test_queries_equal_their_sql(spark, sf_dir, name):
    assert oracle_check.difference(QUERIES[name](spark, sf_dir), oracle_check.connect(sf_dir), ORACLES[name]) is None
