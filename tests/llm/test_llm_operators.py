"""The operators of the llm folder against brute force, on the small tables and on rows with every odd case."""

import base64
import gc
import hashlib
import pickle
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

import oracle_check  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from tokenizers import AddedToken, Tokenizer  # noqa: E402

import corpus_pipeline  # noqa: E402
from reviewloom.llm import byte_cnn, common, factorization, jaccard_join, positional_index, substring_dedup, token_records, url_templates, warc, word_tokens  # noqa: E402
from reviewloom.llm.common import id_crc, table  # noqa: E402
from reviewloom.llm.components import connected  # noqa: E402
from reviewloom.llm.divergence_rules import divergence_rules  # noqa: E402
from reviewloom.llm.registry import ORACLES, QUERIES, URL_RULES  # noqa: E402
from reviewloom.llm.suffix_grouping import suffix_array  # noqa: E402

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

_LINE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
ODD_TEXTS = [
    None,
    "",
    "   \n\t ",
    "word",
    "three little words",
    _LINE,
    _LINE,
    _LINE.upper() + "!",
    (_LINE + "\n") * 40,
    "x" * 500,
    "ab " * 300,
    "Ünïcödé ñandú größe 東京は夜 naïve \u0130stanbul e\u0301\u00a0z\u2003w \u0e01\u0e33 '\u017f",
    "it's IT'S we'll \U0001f600 <|endoftext|> <|startoftext|>mid<|endoftext|>dle 1234½ \x00\x1c\x85 a_b-c",
    " ".join(f"w{i}" for i in range(30_000)),
    "12 345 ... ### $$$",
    "tail   spaces   \n\n\n",
]


@pytest.fixture(scope="module")
def odd(spark):
    """Odd texts, some rows twice, a null id, and columns that clash with names the operators use."""
    rows = [(i, t, "en" if i % 2 else None) for i, t in enumerate(ODD_TEXTS)]
    rows += [(3, "word", "en"), (None, _LINE, None), (100, ODD_TEXTS[8], "de")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    clashing = ["key", "rep", "span", "ids", "frame", "words", "score", "lang_pred", "n_words", "file", "label", "fp", "place", "runs", "repeated_runs"]
    return frame.select("*", *[F.lit("x").alias(c) for c in clashing], F.lit("en").alias("source"), F.lit(1).cast("long").alias("n_chars"))


@pytest.fixture(scope="module")
def empty(odd):
    return odd.limit(0)


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    return table(spark, sf_dir, "documents")


def texts_of(frame):
    return [(r["doc_id"], r["text"]) for r in frame.select("doc_id", "text").collect()]


def bag(frame, *names):
    return Counter(tuple(r[n] for n in names) for r in frame.select(*names).collect())


def u32(ids):
    return np.array(ids, "<u4").tobytes()


# 1: token records


def expected_records(rows):
    tokenizer = Tokenizer.from_file(BYTE_BPE)
    out, start = {}, 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        out[doc_id] = (start, len(ids), zlib.crc32(u32(ids)))
        start += len(ids)
    return out


def test_token_records(documents):
    found = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in token_records.token_records(documents, BYTE_BPE).collect()}
    assert found == expected_records(texts_of(documents))


def test_token_records_of_odd_rows(spark, odd, empty, tmp_path):
    rows = texts_of(odd)
    tokenizer = Tokenizer.from_file(BYTE_BPE)
    want = Counter((d, tuple(tokenizer.encode(t or "", add_special_tokens=False).ids + [2])) for d, t in rows)
    path = str(tmp_path / "records")
    token_records.write_records(odd, path, BYTE_BPE, 2)
    index = token_records.build_index(spark, path)
    read = token_records.read_records(spark, path, index)
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in read.collect()) == want
    some = token_records.read_records(spark, path, index.where("doc_id in (11, 13)"))
    assert {r["doc_id"] for r in some.collect()} == {11, 13}
    starts = index.orderBy("start").collect()
    assert [r["start"] for r in starts] == list(np.cumsum([0] + [r["n_tokens"] for r in starts[:-1]]))
    assert token_records.token_records(empty, BYTE_BPE).count() == 0


def test_damaged_records_are_found():
    data = token_records.frame(token_records.payload_of(7, u32([1, 2]), 4)) + token_records.TRAILER
    assert [token_records.ids_of(p)[0] for _, _, p in token_records.read_frames(data + data)] == [7, 7]
    for at in (2, 9, 14, len(data) - 3):
        broken = data[:at] + bytes([data[at] ^ 1]) + data[at + 1 :]
        with pytest.raises(ValueError):
            list(token_records.read_frames(broken))
    with pytest.raises(ValueError):
        list(token_records.read_frames(data[:-4]))


# 2: WARC


def expected_pages(rows):
    first = {}
    for page, html in rows:
        payload = (html or "").encode()
        if page is not None:
            first[payload] = min(first.get(payload, page), page)
    out = Counter()
    for page, html in rows:
        payload = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        to = first.get(payload)
        revisit = to is not None and page != to
        out[(page, len(payload), digest, "revisit" if revisit else "response", to if revisit else None)] += 1
    return out


WARC_FIELDS = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def test_warc(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    rows = [(r["page_id"], r["html"]) for r in pages.collect()]
    assert bag(QUERIES["op2_warc"](spark, sf_dir), *WARC_FIELDS) == expected_pages(rows)


def test_warc_of_odd_pages(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 3)
    rows = [(9, "http://B.a.com/x?q#f", "<p>same</p>"), (4, "http://a.com/", "<p>same</p>"), (4, "http://a.com/", "<p>same</p>"), (5, None, None), (6, "no scheme\r\n", ""),
            (None, "http://z.org", "<p>same</p>"), (7, "http://z.org", "é" * 100_000), (8, "http://z.org", "\r\n\r\nWARC/1.1\r\n\r\n"), (10, "http://z.org", "\x1f")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("key", F.lit(1)).withColumn("refers_to", F.lit(2))
    found = warc.warc_pages(pages)
    assert bag(found, *WARC_FIELDS) == expected_pages([(p, h) for p, _, h in rows])
    assert {r["page_id"]: bytes(r["payload"]) for r in found.where("record_type = 'response' and page_id > 6").collect()} == {
        7: ("é" * 100_000).encode(), 8: b"\r\n\r\nWARC/1.1\r\n\r\n", 10: b"\x1f"}
    assert warc.warc_pages(pages.limit(0)).count() == 0


def test_lookup_reads_only_what_is_asked(spark, tmp_path):
    pages = spark.range(3000).select(F.col("id").alias("page_id"), F.concat(F.lit("http://h/"), "id").alias("url"), F.col("id").cast("string").alias("html"))
    warc.write_archives(pages, path := str(tmp_path / "w"))
    index = warc.build_index(warc.captures(spark, path))
    wanted = pages.where("page_id in (0, 17, 2999)").select(warc.surt(F.col("url")).alias("key"), "page_id")
    wanted = wanted.union(spark.createDataFrame([("h)/none", 1)], wanted.schema))
    read = warc.read_ranges(spark, path, warc.find_captures(index, wanted)).collect()
    assert sorted(bytes(r["payload"]) for r in read) == [b"0", b"17", b"2999"]


# 3: toxicity


def test_toxicity_catches_held_out_documents(spark):
    rng = np.random.default_rng(1)
    plain, bad, group = [f"plain{i}" for i in range(200)], ["idiot", "moron"], ["redfolk", "bluefolk"]
    rows, labels = [], []
    for i in range(1500):
        words = list(rng.choice(plain, 40))
        # either word alone is harmless: only both together are toxic
        insult, mention = rng.random() < 0.5, rng.random() < 0.5
        words += [str(rng.choice(bad))] * insult + [str(rng.choice(group))] * mention
        rows.append((i, " ".join(rng.permutation(words))))
        labels.append((i, int(insult and mention)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    held = id_crc() % 5 == 0
    found = factorization.toxicity(docs, marks, held).where("held_out").join(marks, "doc_id").collect()
    assert np.mean([r["predicted"] == r["toxic"] for r in found]) > 0.97


def test_toxicity_of_odd_rows(spark, odd, empty):
    marks = spark.createDataFrame([(3, 1), (3, 0), (5, 0), (6, None), (None, 1), (999, 1), (4, 0)], "doc_id long, toxic int")
    found = factorization.toxicity(odd, marks, id_crc() % 5 == 0)
    assert found.count() == odd.count() and found.where("score between 0 and 1 and predicted in (0, 1)").count() == odd.count()
    assert factorization.toxicity(odd, marks.limit(0), id_crc() % 5 == 0).where("score = 0.5").count() == odd.count()
    assert factorization.toxicity(empty, marks, id_crc() % 5 == 0).count() == 0


def test_toxicity_learns_from_allowed_rows_only(documents, spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    held = id_crc() % 5 == 0
    one = factorization.toxicity(documents, labels, held)
    flipped = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert bag(one, "doc_id", "score") == bag(factorization.toxicity(documents, flipped, held), "doc_id", "score")


# 4: url templates


def split_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return host.translate(LOWER), re.match(r"[^?#]*", rest[len(host) :])[0]


def rule_of(host, path):
    best = None
    for rule in URL_RULES:
        if (host == rule.host or host.endswith("." + rule.host)) and path.startswith(rule.path) and (best is None or len(rule.text) > len(best.text)):
            best = rule
    return best


def test_urls_follow_rules(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    found = {r["page_id"]: r for r in QUERIES["op4_url_templates"](spark, sf_dir).collect()}
    assert len(found) == pages.count()
    for row in pages.select("page_id", "url").collect():
        host, path = split_url(row["url"])
        rule, got = rule_of(host, path), found[row["page_id"]]
        assert (got["host"], got["path"], got["rule"]) == (host, path, rule.text if rule else None)
        if rule:
            assert got["verdict"] == ("block" if rule.block else "allow")


def test_url_templates_learn_from_labels(spark):
    rows = [(f"http://shop.org/spam/{i}", "spam") for i in range(60)] + [(f"http://shop.org/news/{i}", "news") for i in range(60)]
    rows += [(f"http://shop.org/spam/later{i}", None) for i in range(5)] + [("http://shop.org/news/later1", None), (None, None), ("nothing", None), ("HTTP://A.B", None), ("http://h?x://y/z", None)]
    pages = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(rows)], "page_id long, url string").withColumn("t0", F.lit(1)).withColumn("s0", F.lit("s"))
    rules = [url_templates.Rule(f"shop.org/spam/{i}", block=True) for i in range(1, 10)] + [url_templates.Rule(f"shop.org/news/{i}", block=False) for i in range(1, 10)]
    found = {r["page_id"]: r for r in url_templates.judge_urls(pages, rules).collect()}
    assert {found[i]["verdict"] for i, (u, _) in enumerate(rows) if u and "/spam/" in u} == {"block"}
    assert {found[i]["verdict"] for i, (u, _) in enumerate(rows) if not u or "/spam/" not in u} == {"allow"}
    for i, (url, _) in enumerate(rows):
        assert (found[i]["host"], found[i]["path"]) == split_url(url)
    assert url_templates.judge_urls(pages.limit(0), rules).count() == 0


@pytest.mark.parametrize("depth", [1, 4, 5, 9, 30])
def test_url_templates_of_any_depth(spark, depth):
    """Paths that differ at their last segment only; the labels below each other level are mixed."""
    head = "/".join("abcdefgh"[k % 8] for k in range(depth))
    rows = [f"http://deep.org/{head}/{kind}/{i}" for kind in ("spam", "news") for i in range(40)] + [f"http://deep.org/{head}/{kind}/later" for kind in ("spam", "news")]
    rules = [url_templates.Rule(f"deep.org/{head}/{kind}/{i}", block=kind == "spam") for kind in ("spam", "news") for i in range(1, 10)]
    pages = spark.createDataFrame(list(enumerate(rows)), "page_id long, url string")
    found = {r["page_id"]: r["verdict"] for r in url_templates.judge_urls(pages, rules).collect()}
    assert [found[i] for i in range(len(rows))] == ["block" if "/spam/" in u else "allow" for u in rows]


def slow_templates(rows):
    """The same tree with dicts: purity of every (host, segments) given with its labels."""
    z, branches, smoothing = url_templates.Z, url_templates.MAX_BRANCHES, url_templates.SMOOTHING
    out = {}

    def below(rows, level, purity):
        for key, _ in rows:
            out[key] = purity
        rows = [(k, v) for k, v in rows if len(k[1]) > level]
        if not any(v for _, v in rows):
            return
        wide = len({k[1][level] for k, _ in rows}) > branches
        children = defaultdict(list)
        for k, v in rows:
            children["*" if wide else k[1][level]].append((k, v))
        listed = []
        for name, own in children.items():
            n, b = sum(len(v) for _, v in own), sum(sum(v) for _, v in own)
            listed.append((int(any(len(k[1]) > level + 1 for k, _ in own)), b / n if n else None, name, n, b, own))
        listed.sort(key=lambda c: (c[0], c[1] is not None, c[1] or 0, c[2]))
        merged = []
        for shape, _, name, n, b, own in listed:
            if merged and merged[-1][0] == shape and n and merged[-1][1]:
                m, d = merged[-1][1:3]
                share = (b + d) / (n + m)
                if abs(b / n - d / m) <= z * (share * (1 - share) * (1 / n + 1 / m)) ** 0.5:
                    merged[-1] = (shape, n + m, b + d, merged[-1][3] + own)
                    continue
            merged.append((shape, n, b, own))
        for _, n, b, own in merged:
            below(own, level + 1, (b + smoothing * purity) / (n + smoothing))

    hosts = defaultdict(list)
    for key, labels in rows.items():
        hosts[key[0]].append((key, labels))
    for own in hosts.values():
        n, b = sum(len(v) for _, v in own), sum(sum(v) for _, v in own)
        below(own, 0, (b + smoothing * url_templates.PRIOR) / (n + smoothing))
    return out


def test_url_purities_equal_a_tree_of_dicts(spark):
    rng = np.random.default_rng(8)
    words = ["news", "spam", "shop", "a1", "x", "", "b-2"] + [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(5) for j in range(10)]
    rows = []
    for i in range(1500):
        path = "/".join(rng.choice(words, int(rng.integers(0, 7)), p=[0.1] * 7 + [0.3 / 50] * 50))
        label = None if rng.random() < 0.4 else int(rng.random() < (0.9 if "spam" in path else 0.1))
        rows.append((i, f"h{i % 4}", "/" + path, label))
    frame = spark.createDataFrame(rows, "page_id long, host string, path string, label int")
    urls = frame.withColumn("segments", url_templates._segments(F.col("path"))).withColumn("key", F.array_join("segments", "/"))
    want = defaultdict(list)
    for _, host, path, label in rows:
        segments = tuple("*" if re.search("[0-9]", s) else s for s in path[1:].split("/"))
        want[(host, segments)] += [] if label is None else [label]
    found = {(r["host"], tuple(r["key"].split("/"))): r["purity"] for r in url_templates.template_scores(urls).collect()}
    expected = slow_templates(dict(want))
    assert set(found) == set(expected)
    assert all(abs(found[k] - expected[k]) < 1e-9 for k in expected)


# 5: BPE through words


def expected_tokens(rows):
    tokenizer = Tokenizer.from_file(WORD_BPE)
    out = Counter()
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        out[(doc_id, len(ids), hashlib.sha256(u32(ids)).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())] += 1
    return out


@pytest.mark.parametrize("limit", [0, 40, 1 << 17])
def test_word_tokens(documents, odd, empty, limit):
    names = ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    for frame in (documents, odd) if limit == 40 else (odd,):
        assert bag(word_tokens.word_tokens(frame, WORD_BPE, limit), *names) == expected_tokens(texts_of(frame))
    assert word_tokens.word_tokens(empty, WORD_BPE, limit).count() == 0


def no_shared_words():
    sink = pa.BufferOutputStream()
    schema = pa.schema([("word", pa.string()), ("ids", pa.binary()), ("decoded", pa.string())])
    with pa.ipc.new_stream(sink, schema):
        pass
    return sink.getvalue().to_pybytes()


def test_rare_words_reach_the_tokenizer_many_at_a_time(monkeypatch):
    monkeypatch.setattr(word_tokens, "RARE_WORDS", 1500)
    known = word_tokens._WordTable(no_shared_words(), WORD_BPE)
    word_tokens._tokenizer.cache_clear()
    given = []

    class Recorder:
        def encode_batch_fast(self, texts, **options):
            given.extend(texts)
            return tokenizer.encode_batch_fast(texts, **options)

    tokenizer, known.tokenizer = known.tokenizer, Recorder()
    plain = Tokenizer.from_file(WORD_BPE)
    for low in (0, 1000, 500, 4000):
        texts = [f"W{i} x{i}'ll \u0301é{i}ß\t{'<|endoftext|>' * (i % 3)} W{i}\n" for i in range(low, low + 1000)] + ["", " \x0b", "\x00 \ufeff"]
        ids, decoded = known.encode([t.encode() for t in texts])
        want = [plain.encode(t, add_special_tokens=False).ids for t in texts]
        assert ids.to_pylist() == [u32(w) for w in want]
        assert decoded.to_pylist() == [plain.decode(w, skip_special_tokens=False).encode() for w in want]
    assert 0 < len(given) < 100


def test_words_of_tokens_that_take_white_space(tmp_path):
    plain = Tokenizer.from_file(WORD_BPE)
    plain.add_special_tokens([AddedToken("<gap>", lstrip=True, rstrip=True)])
    plain.save(str(tmp_path / "gap.json"))
    known = word_tokens._WordTable(no_shared_words(), str(tmp_path / "gap.json"))
    word_tokens._tokenizer.cache_clear()
    texts = ["one <gap> two", "<gap>", "a<gap>b three"]
    assert known.encode([t.encode() for t in texts])[0].to_pylist() == [u32(plain.encode(t, add_special_tokens=False).ids) for t in texts]


def test_decode_joins_pieces(spark):
    tokenizer = Tokenizer.from_file(WORD_BPE)
    ids = tokenizer.encode("a strange catamaran").ids
    coded = spark.createDataFrame([(1, ids), (2, []), (3, None)], "k int, ids array<int>")
    assert bag(word_tokens.decode(coded, "k", WORD_BPE), "k", "decoded") == {(1, tokenizer.decode(ids, skip_special_tokens=False)): 1, (2, ""): 1, (3, ""): 1}


# 6: quality rules


def base_of(text):
    text = text or ""
    words, lines = WORD.findall(text), [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
    count, hit = Counter(windows), set()
    for k, window in enumerate(windows):
        if count[window] > 1:
            hit.update(range(k, k + 8))
    failed = len(words) < 20 or 100 * len(hit) > 30 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit), failed


def test_quality_base(documents, odd, empty):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    for frame in (documents, odd):
        found = divergence_rules(frame)
        assert bag(found, "doc_id", *names) == Counter((d, *base_of(t)) for d, t in texts_of(frame))
        assert found.where("base_failed and kept").count() == 0
    assert divergence_rules(empty).count() == 0


def test_quality_distances(documents):
    """The distances of some documents, computed again in Python."""
    from reviewloom.llm.divergence_rules import COMMON_WORDS, MIN_COMPARED, MIN_REFERENCE

    rows = documents.select("doc_id", "lang", "text").collect()
    counts, totals = defaultdict(Counter), Counter()
    for r in rows:
        words = [w.lower() for w in WORD.findall(r["text"] or "")]
        counts[r["lang"]].update(words)
        totals[r["lang"]] += len(words)
    shares = {k: {w: n / totals[k] for w, n in sorted(c.items(), key=lambda x: (-x[1], x[0]))[:COMMON_WORDS]} for k, c in counts.items() if totals[k] >= MIN_REFERENCE}

    def distance(words, reference):
        own = Counter(w for w in words if w in reference)
        p = [own[w] / len(words) for w in reference]
        q = list(reference.values())
        p, q = np.array([*p, 1 - sum(p)]), np.array([*q, 1 - sum(q)])
        m = (p + q) / 2
        side = lambda x: sum(a * np.log2(a / b) for a, b in zip(x, m) if a > 0)
        return np.sqrt(max(0, (side(p) + side(q)) / 2))

    found = {r["doc_id"]: r for r in divergence_rules(documents).collect()}
    for r in rows[:60]:
        words = [w.lower() for w in WORD.findall(r["text"] or "")]
        got = found[r["doc_id"]]["word_distance"]
        if len(words) < MIN_COMPARED:
            assert got is None
        else:
            assert got == pytest.approx(min(distance(words, ref) for ref in shares.values()), abs=1e-6)


def test_quality_compares_every_language(spark):
    """Twenty languages; documents of the smallest, of none, and of the smallest in name only."""
    text = lambda k, n: " ".join(f"{'abcdefghijklmnopqrst'[k]}{'abcdefghij'[(i * i + k) % 10]}{'xyz'[i % 3]}" for i in range(n))
    rows = [(100 * k + i, f"l{k:02}", text(k, 250 - k)) for k in range(20) for i in range(6)]
    rows += [(5000, None, text(19, 120)), (5001, "l19", " ".join(str(10_000 + i * 37) for i in range(80))), (5002, "none", text(19, 120))]
    found = {r["doc_id"]: r for r in divergence_rules(spark.createDataFrame(rows, "doc_id long, lang string, text string")).collect()}
    own, unnamed, odd_one, unknown = (found[i] for i in (1900, 5000, 5001, 5002))
    assert own["word_distance"] is not None and own["word_distance"] < 0.2
    assert unnamed["word_distance"] < 0.3
    assert odd_one["word_distance"] > 0.6 and not odd_one["kept"]
    assert unknown["word_distance"] is None


def test_quality_keeps_good_documents(documents, spark, sf_dir):
    good = table(spark, sf_dir, "labels").where("quality = 1")
    judged = divergence_rules(documents).where("not base_failed").join(good, "doc_id")
    assert judged.where("not kept").count() <= judged.count() // 100


# 7: decontamination


def test_contamination_equals_sql(spark, sf_dir):
    query = QUERIES["op7_positional_index"]
    assert oracle_check.difference(query(spark, sf_dir), oracle_check.connect(sf_dir), ORACLES["op7_positional_index"]) is None


def contamination_of(rows, items):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    windows = defaultdict(set)
    for item, text in items:
        words = split(text)
        size = min(13, len(words))
        for k in range(len(words) - size + 1 if size else 0):
            windows[tuple(words[k : k + size])].add(item)
    out = Counter()
    for doc_id, text in rows:
        words, hit, found = split(text), set(), set()
        for size in {len(w) for w in windows}:
            for k in range(len(words) - size + 1):
                if (key := tuple(words[k : k + size])) in windows:
                    hit.update(range(k, k + size))
                    found |= windows[key] - {None}
        ids = ",".join(sorted(map(str, found)))
        out[(doc_id, len(words), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(words))] += 1
    return out


@pytest.mark.parametrize("block_words", [1_000_000, 5])
def test_contamination_of_odd_rows(spark, odd, empty, monkeypatch, block_words):
    monkeypatch.setattr(positional_index, "BLOCK_WORDS", block_words)
    rows = [(10, _LINE), (9, "WORD"), (9, "little words"), (None, "three little"), (7, None), (8, "..."), (2, "seven Eight, nine")]
    items = spark.createDataFrame(rows, "item_id long, text string").withColumn("doc_id", F.lit(1))
    names = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert bag(positional_index.contamination(odd, items), *names) == contamination_of(texts_of(odd), rows)
    assert bag(positional_index.contamination(odd, items.limit(0)), *names) == contamination_of(texts_of(odd), [])
    assert positional_index.contamination(empty, items).count() == 0


def test_phrases_and_proximity(spark):
    docs = spark.createDataFrame([(1, "a b c d e a b x c"), (2, "c b a"), (3, "a q b r c"), (4, "a b"), (5, "c")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b c"), (2, "b")], "item_id long, text string")
    index = positional_index.build_index(docs)
    places = lambda slop: sorted(tuple(r) for r in positional_index.search(index, items.where("item_id = 1"), slop).collect())
    assert places(0) == [(1, 1, 0, 2)]
    assert places(1) == [(1, 1, 0, 2), (1, 1, 5, 8)]
    assert places(2) == [(1, 1, 0, 2), (1, 1, 5, 8), (3, 1, 0, 4)]
    assert positional_index.search(index, items.where("item_id = 2")).count() == 5


def test_tasks_hold_little_of_an_index(spark):
    rng = np.random.default_rng(9)
    rows = [(k, " ".join(f"w{w}" for w in rng.integers(0, 30_000, 8_000))) for k in range(250)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    index = positional_index.build_index(docs)
    longest = index.select(F.max(F.size("positions") * 4 + F.size("terms") * 16 + F.size("doc_ids") * 24)).first()[0]
    assert longest < 1_500_000 and index.select(F.sum(F.size("doc_ids"))).first()[0] == 250
    files = [pq.ParquetFile(f.removeprefix("file:").replace("///", "/")).metadata for f in index.inputFiles()]
    groups = [m.row_group(k).total_byte_size for m in files for k in range(m.num_row_groups)]
    assert len(groups) > 1 and max(groups) < 12 << 20
    items = [(1, rows[7][1]), (2, " ".join(rows[9][1].split()[5:30]) + " none"), (3, "none " * 20), (4, rows[3][1][:40].rsplit(" ", 1)[0]), (None, rows[5][1])]
    found = positional_index.contamination(docs, spark.createDataFrame(items, "item_id long, text string")).where("n_hit > 0").collect()
    hits = {r["doc_id"]: (r["n_hit"], r["n_items"], r["contaminated"]) for r in found}
    assert hits[7] == (8000, 1, True) and hits[9] == (25, 1, False) and hits[5] == (8000, 0, True) and hits[3][1] == 1
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= 8 << 20


# 8: Jaccard join


def components_of(rows):
    sets = []
    for _, text in rows:
        words = WORD.findall((text or "").translate(LOWER))
        sets.append({tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set())
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]) and label[i] != label[j]:
                label = [label[j] if x == label[i] else x for x in label]
    smallest = {}
    for (doc_id, _), group in zip(rows, label):
        if doc_id is not None:
            smallest[group] = min(smallest.get(group, doc_id), doc_id)
    return Counter((d, len(s), smallest.get(g)) for (d, _), s, g in zip(rows, sets, label))


def near_copies(count, seed):
    rng = np.random.default_rng(seed)
    out = []
    for family in range(count):
        words = [f"f{family}w{i}" for i in range(int(rng.integers(6, 90)))]
        for _ in range(int(rng.integers(1, 14))):
            changed = list(words)
            for _ in range(int(rng.integers(0, 6))):
                changed[int(rng.integers(len(changed)))] = f"c{rng.integers(50)}"
            out.append(" ".join(changed) + " and a line that all of them share in the end" * bool(rng.random() < 0.5))
    return [(i, t) for i, t in enumerate(out)]


@pytest.mark.parametrize("small", [False, True])
def test_jaccard_components(spark, odd, empty, monkeypatch, small):
    if small:  # many tasks, tiles and spread postings
        for name, value in (("TILE", 40), ("LEAF", 2), ("BUCKET_POSTINGS", 500), ("SPREAD_AT", 4)):
            monkeypatch.setattr(jaccard_join, name, value)
    names = ("doc_id", "n_shingles", "component_id")
    rows = near_copies(25, seed=3 + small)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert bag(jaccard_join.jaccard_components(frame), *names) == components_of(rows)
    if small:
        assert bag(jaccard_join.jaccard_components(odd), *names) == components_of(texts_of(odd))
        assert jaccard_join.jaccard_components(empty).count() == 0


def test_shingles_are_sorted_within_their_texts_only(monkeypatch):
    def no_sort_by_two_keys(*_):
        raise AssertionError

    monkeypatch.setattr(np, "lexsort", no_sort_by_two_keys)
    rng = np.random.default_rng(11)
    texts = ["", "one", " a B\tc d ", "a b c d e", "a b c d e a b c d e", "\n"]
    texts += [" ".join(("x", "Yy", "zé")[i] for i in rng.integers(3, size=n)) for n in rng.integers(0, 400, 60)]
    texts = [t.encode() for t in texts]
    text_of, hashes, sizes = jaccard_join.sized_shingles(texts)
    assert all(np.array_equal(x, y) for x, y in zip(jaccard_join.shingles(texts), (text_of, hashes), strict=True))
    hash_of = {}
    for k, text in enumerate(texts):
        words = text.lower().split()
        want = {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, bool(words)))}
        own = text_of == k
        assert len(want) == own.sum() and (np.diff(hashes[own].astype(object)) > 0).all()
        for shingle in want:
            hash_of.setdefault(shingle, int(jaccard_join.shingles([b" ".join(shingle)])[1][0]))
        assert {(hash_of[x], sum(map(len, x))) for x in want} == set(zip(hashes[own].tolist(), sizes[own].tolist(), strict=True))
    assert len(set(hash_of.values())) == len(hash_of)


def test_rows_of_one_id_are_in_the_classes_of_their_texts(spark):
    text = lambda name, *changed: " ".join("new" if i in changed else f"{name}{i}" for i in range(60))
    rows = [(5, text("a")), (2, text("a", 0)), (5, text("b")), (8, text("b", 0)), (None, text("c")), (9, text("c", 0)), (None, text("d")), (None, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    names = ("doc_id", "n_shingles", "component_id")
    found = bag(jaccard_join.jaccard_components(frame), *names)
    assert found == components_of(rows)
    assert found[(8, 56, 5)] == 1 and found[(5, 56, 2)] == 1 and found[(None, 56, 9)] == 1 and found[(None, 56, None)] == 1


def test_tree_finds_all_pairs_of_the_bound():
    rng = np.random.default_rng(0)
    points = rng.poisson(1.0, (300, jaccard_join.GROUPS)).astype(np.uint16)
    points[100:200] = points[0:100] + (rng.random((100, jaccard_join.GROUPS)) < 0.05)
    sizes, labels = points.sum(1).astype(np.int64), rng.integers(0, 200, 300)
    overlap = np.minimum(points[:, None], points[None]).sum(2)
    want = {(i, j) for i in range(300) for j in range(i + 1, 300) if labels[i] != labels[j] and 7 * overlap[i, j] >= 3 * (sizes[i] + sizes[j])}
    found = jaccard_join.candidate_pairs(points, sizes, labels)
    assert {(min(p), max(p)) for p in found} == want and len(found) == len(want)


def test_forest_joins_what_all_pairs_join_and_leaves_pairs_to_earlier_blocks():
    rng = np.random.default_rng(1)
    near = rng.poisson(2.0, jaccard_join.GROUPS).astype(np.uint16)
    points = np.concatenate([near + (rng.random((150, jaccard_join.GROUPS)) < 0.1), rng.poisson(2.0, (150, jaccard_join.GROUPS))]).astype(np.uint16)
    sizes, labels = points.sum(1).astype(np.int64), np.arange(300)
    everything, forest = (jaccard_join.candidate_pairs(points, sizes, labels, forest=f) for f in (False, True))
    assert set(forest) <= set(everything) and len(everything) == 150 * 149 // 2 and len(forest) == 149
    joined = labels.copy()
    for i, j in forest:
        joined[joined == joined[j]] = joined[i]
    assert len(set(joined[:150])) == 1
    # the first hundred share an earlier block
    earlier = [frozenset([-7, k] if k < 100 else [k]) for k in range(300)]
    found = jaccard_join.candidate_pairs(points, sizes, labels, earlier=earlier)
    assert {tuple(sorted(p)) for p in found} == {tuple(sorted(p)) for p in everything if max(p) >= 100}


def test_pairs_of_a_large_group_grow_with_its_members(spark, monkeypatch):
    # the smallest class that a text of the second group meets is one of the first, so the one comparison with it joins nothing
    group = lambda c: [" ".join(f"{c}{k}" for k in range(90)) + f" lonesome{i} q{i} q{i} q{i} sentence{i}" for i in range(60)]
    rows = list(enumerate(group("a") + group("b")))
    given = []

    def stage(df, label):
        out = session_stage(df, label)
        given.append(out.count() if label == "tree-pairs" else 0)
        return out

    session_stage = jaccard_join.stage
    monkeypatch.setattr(jaccard_join, "stage", stage)
    frame = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    found = bag(jaccard_join.jaccard_components(frame), "doc_id", "n_shingles", "component_id")
    assert found == components_of(rows) and found[(119, 91, 60)] == 1
    assert 59 <= sum(given) < 4 * 60


def given_pairs(monkeypatch):
    given = []

    def stage(df, label):
        out = session_stage(df, label)
        given.append(out.count() if label == "tree-pairs" else 0)
        return out

    session_stage = jaccard_join.stage
    monkeypatch.setattr(jaccard_join, "stage", stage)
    return given


def edited_copies(count):
    """Near copies of one text; the first is edited most, so few of the others are similar to it."""
    rng = np.random.default_rng(12)
    rows = []
    for i in range(count):
        words = [f"w{k}" for k in range(124)]
        for _ in range(4 if i == 0 else int(rng.integers(0, 5))):
            words[int(rng.integers(124))] = f"edit{rng.integers(1 << 40)}"
        rows.append((i, " ".join(words)))
    return rows


def test_a_large_group_is_joined_by_its_least_edited_text(spark, monkeypatch):
    rows, given = edited_copies(240), given_pairs(monkeypatch)
    frame = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert bag(jaccard_join.jaccard_components(frame), "doc_id", "n_shingles", "component_id") == components_of(rows)
    assert sum(given) < 2 * len(rows)


def sentence_texts(count, seed):
    """Texts of shared sentences: most of their shingles several of them have, and few are similar."""
    rng = np.random.default_rng(seed)
    pool = [" ".join(f"{'abcdefgh'[k % 8] * int(rng.integers(1, 9))}{k}x{i}" for i in range(int(rng.integers(5, 30)))) for k in range(40)]
    rows = []
    while len(rows) < count:
        picked = rng.permutation(40)[: int(rng.integers(4, 9))].tolist()
        for _ in range(int(rng.integers(1, 4))):
            own = list(picked)
            if rng.random() < 0.7:
                own[int(rng.integers(len(own)))] = int(rng.integers(40))
            rows.append((len(rows), " ".join(pool[k] for k in own)))
    return rows


@pytest.mark.parametrize("sketch, tile", [(16, 2048), (1, 20)])
def test_texts_of_shared_sentences(spark, monkeypatch, sketch, tile):
    monkeypatch.setattr(jaccard_join, "SKETCH", sketch)
    monkeypatch.setattr(jaccard_join, "TILE", tile)
    rows = sentence_texts(260, seed=tile)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert bag(jaccard_join.jaccard_components(frame), "doc_id", "n_shingles", "component_id") == components_of(rows)


def test_pairs_out_of_reach_are_not_given():
    rng = np.random.default_rng(4)
    points = (rng.poisson(1.0, jaccard_join.GROUPS) + (rng.random((200, jaccard_join.GROUPS)) < 0.05)).astype(np.uint16)
    sizes = points.sum(1).astype(np.int64)
    reach = sizes - rng.integers(0, sizes // 4)
    found = jaccard_join.candidate_pairs(points, sizes, np.arange(200), reach=reach)
    overlap = np.minimum(np.minimum(points[:, None], points[None]).sum(2), np.minimum(reach[:, None], reach[None]))
    want = {(i, j) for i in range(200) for j in range(i + 1, 200) if 7 * overlap[i, j] >= 3 * (sizes[i] + sizes[j])}
    assert {(min(p), max(p)) for p in found} == want and 0 < len(want) < 200 * 199 // 4


def test_connected(spark):
    edges = [(i, i + 1) for i in range(40) if i % 10] + [(50, 41), (7, 7), (99, 3)]
    found = dict(tuple(r) for r in connected(spark.createDataFrame(edges, "u long, v long")).collect())
    assert found[99] == 1 and found[10] == 1 and found[20] == 11 and found[50] == 41 and found[40] == 31


def test_connected_asks_for_no_job_but_its_writes(spark, monkeypatch):
    asked = []
    frame = type(spark.range(0))
    monkeypatch.setattr(frame, "collect", lambda self, f=frame.collect: asked.append(self) or f(self))
    path = spark.createDataFrame([(i, i + 1) for i in range(20)], "u long, v long")
    found = connected(path)
    assert not asked
    assert {tuple(r) for r in found.collect()} == {(i, 0) for i in range(21)}
    assert connected(path.where("u < 0")).count() == connected(spark.createDataFrame([(7, 7)], "u long, v long")).count() == 0


# 9: repeated substrings


def removed_from(rows):
    first = {}
    for doc_id, text in rows:
        data = (text or "").encode()
        for k in range(len(data) - 49):
            if doc_id is not None:
                first[data[k : k + 50]] = min(first.get(data[k : k + 50], doc_id), doc_id)
    out = Counter()
    for doc_id, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data) + 1, bool)
        for k in range(len(data) - 49):
            if doc_id is not None and first[data[k : k + 50]] < doc_id:
                gone[k : k + 50] = True
        kept = bytes(b for b, g in zip(data, gone) if not g)
        runs = int(np.count_nonzero(gone[1:] & ~gone[:-1]) + gone[0])
        out[(doc_id, len(data), len(data) - len(kept), runs, hashlib.sha256(kept).hexdigest())] += 1
    return out


REMOVED = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def test_removed_bytes(documents, odd, empty):
    for frame in (documents, odd):
        assert bag(substring_dedup.removed_bytes(frame), *REMOVED) == removed_from(texts_of(frame))
    assert substring_dedup.removed_bytes(empty).count() == 0


@pytest.mark.parametrize("step", [substring_dedup.STEP_BYTES, 64, 7])
def test_removed_bytes_of_random_overlaps(spark, monkeypatch, step):
    """Also where every text is longer than a step and comes in pieces."""
    monkeypatch.setattr(substring_dedup, "SUFFIX_SPANS", 5)
    monkeypatch.setattr(substring_dedup, "STEP_BYTES", step)
    rng = np.random.default_rng(5)
    pool = ["".join(rng.choice(list("abé "), int(rng.integers(30, 160)))) for _ in range(12)]
    rows = []
    for i in range(80):
        pieces = [pool[int(rng.integers(len(pool)))] for _ in range(int(rng.integers(1, 6)))]
        cut = [p[int(rng.integers(0, 40)) : int(rng.integers(40, 160))] for p in pieces]
        rows.append((int(i // 1.3), "".join(cut) + "z" * int(rng.integers(0, 3))))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert bag(substring_dedup.removed_bytes(frame), *REMOVED) == removed_from(rows)


@pytest.mark.parametrize("size", [0, 49, 50, 63, 64, 65, 113, 114, 500])
def test_pieces_hold_every_window_once(size):
    text = bytes(np.random.default_rng(size).integers(1, 255, size, dtype=np.uint8))
    batch = pa.RecordBatch.from_pydict({"text": pa.array([b"short", text, None, text], pa.binary())})
    found = Counter()
    for rows, texts, at in substring_dedup.text_pieces(batch, 64):
        assert rows.num_rows == len(texts) and sum(map(len, texts)) <= 64 + 49
        for piece in texts:
            found.update((at + k, piece[k : k + 50]) for k in range(len(piece) - 49))
    assert found == {(k, text[k : k + 50]): 2 for k in range(size - 49)}


def test_suffix_array():
    rng = np.random.default_rng(2)
    for _ in range(300):
        symbols = rng.integers(0, int(rng.integers(1, 5)) + 1, int(rng.integers(0, 40)))
        assert suffix_array(symbols).tolist() == sorted(range(len(symbols)), key=lambda i: symbols[i:].tolist())


def test_cut_texts_keeps_characters_whole(spark):
    shared = "é" * 60
    rows = [(1, "ab" + shared + "x"), (2, "a" + shared + "ñ"), (3, None)]
    cut = substring_dedup.cut_texts(spark.createDataFrame(rows, "doc_id long, text string").withColumn("runs", F.lit(1)))
    assert {r["doc_id"]: r["text"] for r in cut.collect()} == {1: rows[0][1], 2: "añ", 3: None}
    assert cut.columns == ["doc_id", "text", "runs"]


# 10: language ID


def test_language_of_held_out_documents(spark, sf_dir, documents):
    found = QUERIES["op10_byte_cnn"](spark, sf_dir)
    rows = found.where("held_out").join(documents.select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.95
    assert found.where("score between 0 and 1").count() == documents.count()


def test_marks_and_digits_are_no_letters(spark):
    texts = ["½ ² Ⅷ", "①", "٣", "", None, "___ 12", "ª", "ь"]
    rows = [(i, t, None) for i, t in enumerate(texts)] + [(100 + i, "plain words of a text", "en") for i in range(20)] + [(200, "kaksi sanaa vain", "fi")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    network = byte_cnn.train(docs, F.lit(True))
    # a rare language is learned too
    assert network.languages == ["en", "fi"]
    found = {r["doc_id"]: r["lang_pred"] for r in byte_cnn.detect(docs, network).collect()}
    assert {i for i in range(len(texts)) if found[i] == "und"} == {i for i, t in enumerate(texts) if not any(c.isalpha() for c in t or "")}


def test_rare_languages_have_their_turn(spark, monkeypatch):
    monkeypatch.setattr(byte_cnn, "MAX_TRAIN", 10)
    rows = [(i, f"words {i}", "en") for i in range(500)] + [(1000 + i, f"sanat {i}", "fi") for i in range(3)]
    seen = []
    monkeypatch.setattr(byte_cnn, "fit", lambda texts, labels: seen.extend(labels))
    byte_cnn.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True))
    assert Counter(seen) == {"en": 7, "fi": 3}


def slow_probabilities(net, text):
    """The network window by window, place by place, filter by filter."""
    folded = [byte_cnn._FOLD[b] for b in text] or []
    total = np.zeros(len(net.languages))
    pieces = range(0, max(1, len(text)), byte_cnn.WINDOW_BYTES)
    for low in pieces:
        window = (folded[low : low + byte_cnn.WINDOW_BYTES] + [32] * byte_cnn.WINDOW_BYTES)[: byte_cnn.WINDOW_BYTES]
        vectors = [net.embedding[b] for b in window]
        peaks = []
        for f in range(net.kernels.shape[1]):
            width = byte_cnn.WIDTHS[f // byte_cnn.FILTERS]
            kernel = net.kernels[: width * byte_cnn.EMBEDDING, f].reshape(width, -1)
            places = range(byte_cnn.WINDOW_BYTES - max(byte_cnn.WIDTHS) + 1)
            peaks.append(max(sum(float(vectors[p + k] @ kernel[k]) for k in range(width)) for p in places))
        hidden = np.maximum(np.array(peaks) + net.kernel_bias, 0)
        odds = np.exp(hidden @ net.dense + net.dense_bias)
        total += odds / odds.sum()
    return total / len(pieces)


def test_network_equals_a_plain_one():
    texts = ["the words of a short text", "die Wörter eines Textes über Größe " * 8, "1 2 x"]
    net = byte_cnn.fit([t.encode() for t in texts[:2]] * 4, ["en", "de"] * 4)
    names, scores = net.predict([t.encode() for t in texts])
    for text, name, score in zip(texts, names, scores):
        odds = slow_probabilities(net, text.encode())
        assert name == net.languages[int(odds.argmax())] and abs(score - odds.max()) < 1e-4


def test_language_of_odd_rows(spark, odd, empty):
    held = id_crc() % 3 == 1
    found = byte_cnn.language_id(odd, held)
    lettered = lambda t: any(c.isalpha() for c in t or "")
    by_text = defaultdict(set)
    for row in byte_cnn.detect(odd, byte_cnn.train(odd, ~held)).collect():
        by_text[row["text"]].add(row["lang_pred"])
    assert found.count() == odd.count()
    assert {t for t, names in by_text.items() if names == {"und"}} == {t for t in by_text if not lettered(t)}
    nothing = odd.withColumn("lang", F.lit(None).cast("string"))
    assert bag(byte_cnn.language_id(nothing, held), "lang_pred", "score") == {("und", 0.0): odd.count()}
    assert byte_cnn.language_id(empty, held).count() == 0


# the pipeline


def test_pipeline_stages(spark, sf_dir, documents):
    columns, before = documents.columns, documents
    for name, stage_of in corpus_pipeline.STAGES:
        after = spark.createDataFrame(stage_of(spark, before, sf_dir).toPandas())
        rows = texts_of(before)
        if name == "language_id":
            assert after.count() >= 0.99 * before.where("text rlike '[a-z]'").count()
        elif name == "jaccard_join":
            want = {d for d, _, c in components_of(rows) if d == c}
            assert {r["doc_id"] for r in after.collect()} == want and after.count() == len(want)
        elif name == "substring_dedup":
            kept = {(d, h) for d, _, _, _, h in removed_from(rows)}
            same = sum((d, hashlib.sha256(t.encode()).hexdigest()) in kept for d, t in texts_of(after))
            assert same >= 0.98 * after.count()  # a few ranges end inside a character
            assert after.where(F.length("text") != F.col("n_chars")).count() == 0
        elif name == "decontamination":
            items = [(r["item_id"], r["text"]) for r in table(spark, sf_dir, "benchmark").collect()]
            clean = {key[0] for key in contamination_of(rows, items) if not key[5]}
            assert {r["doc_id"] for r in after.collect()} == clean
        else:
            assert bag(after, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == expected_tokens(rows)
            continue
        assert after.columns == columns and after.count() > 0
        before = after


@pytest.mark.parametrize("bits", [4, 12, 20])
def test_filters_take_little_of_the_drivers_heap(bits):
    probes = np.random.default_rng(bits).integers(0, 1 << 64, 3000, dtype=np.uint64)
    some = substring_dedup.ProbeFilter(bits)
    segments = some.segment_of(probes)
    for segment in np.unique(segments):
        marks = some.segment(probes[segments == segment] & np.uint64(0xFFFFFFFF))
        assert bits > 4 or len(marks) < 100_000  # a sixteenth of the bitmap: 1 MB
        some.put(segment, marks)
    state = pickle.dumps(some, 5)
    again = pickle.loads(state)
    assert len(state) < 1_000_000 and (again.packed == some.packed).all() and again.segment_of(probes).tolist() == segments.tolist()
    assert some.holds(probes).all() and again.holds(probes).all() and again.holds(probes ^ np.uint64(0x5555555555555555)).mean() < 0.1


def test_the_driver_keeps_no_tokenizer(spark, documents):
    word_tokens.encode_documents(documents.limit(50), WORD_BPE)
    assert word_tokens._tokenizer.cache_info().currsize == 0


def test_tasks_leave_no_memory_in_workers(spark, documents):
    some = documents.limit(400).repartition(4)
    substring_dedup.cut_texts(some).write.format("noop").mode("overwrite").save()
    word_tokens.encode_documents(some, public_tokenizers.path("word_bpe_49k.json")).write.format("noop").mode("overwrite").save()

    def left(batches):
        for _ in batches:
            pass
        tables = sum(type(x).__name__ == "_WordTable" for x in gc.get_objects())
        powers = sum(len(a) > 1 for a in common._powers_cache.values())
        yield pa.RecordBatch.from_arrays([pa.array([tables + powers + word_tokens._tokenizer.cache_info().currsize], pa.int64())], ["n"])

    assert {r["n"] for r in spark.range(0, 8, 1, 8).mapInArrow(left, "n long").collect()} == {0}


def test_near_copies_are_judged_row_by_row(spark):
    text = lambda name, *changed: " ".join("new" if i in changed else f"{name}{i}" for i in range(60))
    rows = [(1, text("a")), (5, text("a", 0)), (5, text("b")), (5, text("b")), (7, text("c")), (7, text("d")), (None, text("e")), (None, text("e", 0)), (None, text("f"))]
    rows += [(None, text("f")), (2, ""), (2, ""), (3, None), (9, text("e"))]
    clashing = ["_id", "_key", "_runs", "_found", "_hash1", "__hash1", "_doc_id", "group", "wins", "score", "lang_pred", "others", "_text", "row", "fp", "rep"]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select(
        "*", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(1).cast("long").alias("n_chars"), *[F.lit("x").alias(c) for c in clashing]
    )
    kept = corpus_pipeline.keep_one_of_near_copies(spark, docs, None)
    assert kept.columns == docs.columns
    want = [(1, text("a")), (5, text("b")), (7, text("c")), (7, text("d")), (9, text("e")), (None, text("f")), (2, ""), (2, ""), (3, None)]
    assert Counter(texts_of(kept)) == Counter(want)
    cut = corpus_pipeline.cut_repeated_passages(spark, docs, None)
    assert cut.columns == docs.columns and cut.where("others <> 'x' OR _key <> 'x'").count() == 0


def test_near_copies_of_the_pipeline_give_pairs_by_their_number(spark, monkeypatch):
    rows, given = edited_copies(200), given_pairs(monkeypatch)
    frame = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    kept = corpus_pipeline.keep_one_of_near_copies(spark, frame, None)
    assert Counter(d for d, _ in texts_of(kept)) == Counter({c for _, _, c in components_of(rows)})
    assert 0 < sum(given) < 2 * len(rows)


def test_pipeline_of_odd_rows(spark, odd, sf_dir):
    docs, columns = odd, odd.columns
    for name, stage_of in corpus_pipeline.STAGES:
        before, docs = docs, stage_of(spark, docs, sf_dir)
        if name == "language_id":
            assert {t for _, t in texts_of(docs)} <= {t for t in ODD_TEXTS if any(c.isalpha() for c in t or "")}
        elif name == "jaccard_join":
            groups = defaultdict(list)
            for d, _, c in components_of(texts_of(before)).elements():
                groups[c].append(d)
            assert docs.count() == len([g for g in groups if g is not None]) + sum(c is None for c in groups)
        if name != "bpe":
            assert docs.columns == columns and docs.where("score <> 'x' OR fp <> 'x'").count() == 0
    assert docs.count() == before.count() > 0


def test_pipeline_of_an_empty_table(spark, documents, sf_dir):
    docs = documents.limit(0)
    for _, stage_of in corpus_pipeline.STAGES:
        docs = stage_of(spark, docs, sf_dir)
        assert docs.count() == 0
