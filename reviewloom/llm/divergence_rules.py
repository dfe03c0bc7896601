"""Quality rules by distribution divergence, in DataFrame functions only.

Per document, counts of words, symbols, repeated lines and repeated windows of words give the base rules. Beyond them,
its histogram of character classes and its histogram of common words are compared with those of the languages by
Jensen-Shannon distance; a document far from every language goes. Short documents, and languages with
little text, are not compared.

References cover all documents. One aggregate finds the ``COMMON_WORDS`` of every language with ``MIN_REFERENCE`` words; then each text is read once for
all its counts, those of the common words included; the written counts give the 7 class shares of each language. The references meet the counts as one
literal that is looped over, so the plan does not grow with the languages. Everything about a document is computed in its own row, without a shuffle.

Cases: a null text has no words and fails the base rules; documents without lang are compared with all references; repeated rows are
judged alike; ties between common words go to the smaller word; an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

import json
from collections import defaultdict
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.session import stage
# Fixed values of the base rules.
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
SYMBOLS = "[#*$%&|<>]+"
_BLANKS = "[ \\t\\n\\x0B\\f\\r]+"
_VISIBLE = "[^ \\t\\n\\x0B\\f\\r]"

# Words of a language's reference.
COMMON_WORDS = 25

# Words a document and a language need to be compared.
MIN_COMPARED = 50
MIN_REFERENCE = 1000

# Jensen-Shannon distances (base 2, 0 to 1) from the nearest language that a document may reach.
MAX_CLASS_DISTANCE = 0.25
MAX_WORD_DISTANCE = 0.60

# Character classes: name and pattern. What none of them takes is the last class.
CLASSES = {
    "lower": "\\p{Ll}",
    "blank": "[\\s\\p{Z}]",
    "upper": "\\p{Lu}",
    "letter": "[\\p{Lo}\\p{Lm}\\p{Lt}]",
    "digit": "\\p{N}",
    "mark": "[.,;:!?'\"()\\-]",
}
_CLASS_NAMES = [*CLASSES, "rest"]


def _words(text: Column) -> Column:
    """Runs without ASCII white space; a null text has none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\f\r"))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, _BLANKS))


def _repeat_words(prepared: DataFrame) -> DataFrame:
    """Adds n_repeat_words to rows with ``words``.

    A 64-bit hash per window tells which documents may repeat one; equal windows have equal hashes. Only those documents sort their
    windows as texts, and equal neighbours give the positions that count.
    """
    count = F.size("words")
    starts = F.when(count >= WINDOW, F.sequence(F.lit(1), count - (WINDOW - 1))).otherwise(F.array().cast("array<int>"))
    # words are hashed once each, then pairs of neighbours to windows of 2, 4 and 8 words
    hashed = prepared.withColumn("_hashes", F.transform("words", lambda w: F.xxhash64(w)))
    for width in (1, 2, 4):
        left = F.greatest(F.size("_hashes") - width, F.lit(0))
        pairs = F.zip_with(F.slice("_hashes", 1, left), F.slice("_hashes", width + 1, left), lambda a, b: F.xxhash64(a, b))
        hashed = hashed.withColumn("_hashes", pairs)
    suspect = hashed.withColumn("_suspect", F.size(F.array_distinct("_hashes")) < F.size("_hashes")).drop("_hashes")
    window = lambda i: F.struct(F.array_join(F.slice("words", i, WINDOW), " ").alias("w"), i.alias("i"))
    nothing = F.array().cast("array<struct<w:string,i:int>>")
    sorted_windows = suspect.withColumn("_sorted", F.when(F.col("_suspect"), F.array_sort(F.transform(starts, window))).otherwise(nothing))
    same = lambda x, k: F.get(F.col("_sorted"), k)["w"].eqNullSafe(x["w"])
    twice = F.filter("_sorted", lambda x, k: same(x, k + 1) | ((k > 0) & same(x, k - 1)))
    placed = sorted_windows.withColumn("_at", F.array_sort(F.transform(twice, lambda x: x["i"]))).drop("_sorted", "_suspect")
    width = F.lit(WINDOW)
    covered = F.transform("_at", lambda p, k: F.least(width, F.coalesce(F.get(F.col("_at"), k + 1) - p, width)))
    return placed.withColumn("n_repeat_words", F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x)).drop("_at")


def _dropped(text: Column, runs: str) -> Column:
    """Characters of ``text`` in matches of a pattern."""
    return F.length(text) - F.length(F.regexp_replace(text, runs, ""))


def base_counts(docs: DataFrame) -> DataFrame:
    """Adds ``words``, n_words, word_chars, n_dup_lines, n_repeat_words and base_failed to ``text``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(_VISIBLE))
    counted = docs.withColumns({"words": _words(F.col("text")), "_lines": lines}).withColumns(
        {
            "n_words": F.size("words").cast("long"),
            "word_chars": F.length(F.array_join("words", "")).cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        }
    )
    repeated = _repeat_words(counted.drop("_lines"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return repeated.withColumn("base_failed", failed)


def _with_class_counts(rows: DataFrame) -> DataFrame:
    """Adds n_symbols and the number of characters of each class in ``text``.

    Each class is taken out of what the ones before left, so only the first, most frequent one reads the whole text. No class takes
    a symbol, so the symbols are counted in what is left at the end.
    """
    rows = rows.withColumn("_left", F.coalesce(F.col("text"), F.lit("")))
    for name, pattern in CLASSES.items():
        rows = rows.withColumn("_rest", F.regexp_replace("_left", pattern + "+", ""))
        rows = rows.withColumn(name, (F.length("_left") - F.length("_rest")).cast("long")).drop("_left").withColumnRenamed("_rest", "_left")
    return rows.withColumns({"rest": F.length("_left").cast("long"), "n_symbols": _dropped(F.col("_left"), SYMBOLS).cast("long")}).drop("_left")


def common_words(docs: DataFrame) -> dict[str, dict[str, float]]:
    """Per language with enough words: its common words with their shares. Larger languages come first."""
    words = docs.where(F.col("lang").isNotNull()).select("lang", F.explode(_words(F.lower("text"))).alias("word"))
    by_word = stage(words.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n")), "language-words")
    enough = by_word.groupBy("lang").agg(F.sum("n").alias("n_words")).where(F.col("n_words") >= MIN_REFERENCE)
    sizes = {r["lang"]: r["n_words"] for r in enough.orderBy(F.desc("n_words"), "lang").collect()}
    by_count = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    placed = by_word.where(F.col("lang").isin(list(sizes))).withColumn("place", F.row_number().over(by_count))
    out: dict[str, dict[str, float]] = {lang: {} for lang in sizes}
    for row in placed.where(F.col("place") <= COMMON_WORDS).collect():
        out[row["lang"]][row["word"]] = row["n"] / sizes[row["lang"]]
    return out


def class_shares(measured: DataFrame, languages: list[str]) -> dict[str, list[float]]:
    """Share of each character class in all texts of each language."""
    sums = [F.sum(name).alias(name) for name in _CLASS_NAMES]
    rows = measured.where(F.col("lang").isin(languages)).groupBy("lang").agg(*sums).collect()
    return {r["lang"]: [r[name] / sum(r[n] for n in _CLASS_NAMES) for name in _CLASS_NAMES] for r in rows}


def _part(p: Column, q: Column) -> Column:
    """What a bin adds to twice the divergence: p log p/m + q log q/m, with 0 log 0 = 0."""
    m = (p + q) / 2
    side = lambda x: F.when(x > 0, x * F.log2(x / m)).otherwise(F.lit(0.0))
    return side(p) + side(q)


def _distance(twice_divergence: Column) -> Column:
    return F.sqrt(F.greatest(twice_divergence / 2, F.lit(0.0)))


def _literal(found: list[dict], listed: list[str]) -> Column:
    """The references as one foldable value: classes and total share of words per language, and per place in ``listed`` the languages with that word."""
    holders = defaultdict(list)
    for k, reference in enumerate(found):
        for word, share in reference["words"].items():
            holders[word].append({"k": k, "q": share})
    languages = [{"classes": r["classes"], "total": float(sum(r["words"].values()))} for r in found]
    value = {"languages": languages, "holders": [holders[word] for word in listed]}
    kind = "languages array<struct<classes:array<double>,total:double>>, holders array<array<struct<k:int,q:double>>>"
    return F.from_json(F.lit(json.dumps(value)), kind)


def _class_distance(known: Column) -> Column:
    """Distance of the class counts from those of the nearest language."""
    total = reduce(lambda a, b: a + b, [F.col(name) for name in _CLASS_NAMES])

    def distance(language: Column) -> Column:
        parts = [_part(F.col(name) / total, F.get(language["classes"], F.lit(k))) for k, name in enumerate(_CLASS_NAMES)]
        return _distance(reduce(lambda a, b: a + b, parts))

    return F.array_min(F.transform(known["languages"], distance))


def _word_distance(known: Column) -> tuple[Column, Column]:
    """What each listed word adds for each language that has it (``_gains``), and from that the distance of the counts in ``_runs`` (place in the listed words, n) from the common words of the nearest language and the rest of its words."""

    def gains(run: Column) -> Column:
        p = run["n"] / F.col("n_words")
        gain = lambda h: F.struct(h["k"].alias("k"), (_part(p, h["q"]) - h["q"]).alias("d"), p.alias("p"))
        return F.transform(F.get(known["holders"], run["place"]), gain)

    def distance(language: Column, k: Column) -> Column:
        add = lambda state, x: F.when(x["k"] == k, F.struct((state["d"] + x["d"]).alias("d"), (state["p"] + x["p"]).alias("p"))).otherwise(state)
        total = language["total"]
        # a common word that the document lacks adds its share
        finish = lambda state: state["d"] + total + _part(F.greatest(1 - state["p"], F.lit(0.0)), F.greatest(1 - total, F.lit(0.0)))
        return _distance(F.aggregate("_gains", F.struct(F.lit(0.0).alias("d"), F.lit(0.0).alias("p")), add, finish))

    return F.flatten(F.transform("_runs", gains)), F.array_min(F.transform(known["languages"], distance))


def _with_runs(rows: DataFrame, listed: list[str]) -> DataFrame:
    """Adds ``_runs``: place in ``listed`` and count of every listed word in ``words``."""
    hits = F.array_sort(F.filter(F.transform("words", F.lower), lambda w: w.isin(listed)))
    place = F.array(*map(F.lit, listed)).cast("array<string>")
    rows = rows.withColumn("_hits", hits)
    begins = F.filter(F.sequence(F.lit(0), F.size("_hits")), lambda i: (i == 0) | (F.get(F.col("_hits"), i) != F.get(F.col("_hits"), i - 1)))
    rows = rows.withColumn("_begins", F.when(F.size("_hits") > 0, begins).otherwise(F.array().cast("array<int>")))
    end = lambda k: F.coalesce(F.get(F.col("_begins"), k + 1), F.size("_hits"))
    run = lambda i, k: F.struct((F.array_position(place, F.get(F.col("_hits"), i)).cast("int") - 1).alias("place"), (end(k) - i).alias("n"))
    return rows.withColumn("_runs", F.transform("_begins", run)).drop("_hits", "_begins")


def divergence_rules(docs: DataFrame) -> DataFrame:
    """doc_id, the base counts, base_failed, kept, class_distance, word_distance.

    The distances, to the nearest reference each, are null where a document is not compared; then the base rules decide alone.
    """
    source = docs.select("doc_id", "lang", "text")
    words = common_words(source)
    listed = sorted({word for of in words.values() for word in of})
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    counted = _with_runs(_with_class_counts(base_counts(source)), listed)
    # written, so that no text is read again for the class shares
    measured = stage(counted.select("doc_id", "lang", *counts, *_CLASS_NAMES, "_runs"), "measured")
    if words:
        classes = class_shares(measured, list(words))
        compared = (F.col("n_words") >= MIN_COMPARED) & (F.col("lang").isNull() | F.col("lang").isin(list(words)))
        known = _literal([{"classes": classes[lang], "words": of} for lang, of in words.items()], listed)
        gains, word_distance = _word_distance(known)
        nearest = {"class_distance": F.least(F.lit(1.0), _class_distance(known)), "word_distance": F.least(F.lit(1.0), word_distance)}
        measured = measured.withColumn("_gains", F.when(compared, gains))
        judged = measured.withColumns({name: F.when(compared, distance) for name, distance in nearest.items()})
    else:
        judged = measured.withColumns({name: F.lit(None).cast("double") for name in ("class_distance", "word_distance")})
    far = (F.col("class_distance") > MAX_CLASS_DISTANCE) | (F.col("word_distance") > MAX_WORD_DISTANCE)
    judged = judged.withColumn("kept", ~F.col("base_failed") & ~F.coalesce(far, F.lit(False)))
    # written, so that a filter on the result is not pushed into the nested expressions above
    return stage(judged.select("doc_id", *counts, "kept", "class_distance", "word_distance"), "quality")
