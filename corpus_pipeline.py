"""A pipeline over ``documents``: language ID, near copies, repeated passages, benchmark passages, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again as the next one's docs. All but the last return the
columns of documents.

Cases: every row is judged by its own text, so rows with null ids and rows that share an id pass the stages like all others; of rows that are equal in
id and text one stays, if the text has words; a document that loses all its text goes; an empty table gives none. Extra columns go along, whatever they are called.
"""

from __future__ import annotations

from functools import reduce

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.llm import byte_cnn
from reviewloom.llm.common import clean_worker, table
from reviewloom.llm.jaccard_join import similar_groups
from reviewloom.llm.positional_index import ARROW_BATCH_BYTES, contamination
from reviewloom.llm.substring_dedup import cut_texts
from reviewloom.llm.word_tokens import encode_documents
from reviewloom.session import scratch_path, stage, staging

# A language of which the network is less sure than this is no language. Clean texts of mixed passages stay above it.
MIN_LANGUAGE_SCORE = 0.35



def _bound_memory(spark: SparkSession) -> None:
    """Bound the batches of the step that begins, and give back what the step before it left in the driver's Python."""
    clean_worker()
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BATCH_BYTES))


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the network tells; it learns from the documents that name theirs."""
    _bound_memory(spark)
    network = byte_cnn.train(docs, F.lit(True))
    known = byte_cnn.known(docs, network, MIN_LANGUAGE_SCORE)
    return known.select(*docs.columns)


def _hashes() -> dict[str, Column]:
    """Two 64-bit hashes tell texts apart: with one alone, different texts would meet at the size of a large corpus."""
    return {"_hash1": F.xxhash64("text"), "_hash2": F.xxhash64(F.lit(1), "text")}


def _by_key(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """Semi or anti join of ``docs`` with ``keys``: the two hashes of the text, and doc_id where that is to match as well."""
    mark = "_"
    while any(c.startswith(mark) for c in docs.columns):
        mark += "_"
    of_row = {**_hashes(), "doc_id": F.col("doc_id")}
    named = keys.select(*[F.col(c).alias(f"{mark}{c}") for c in keys.columns])
    same = reduce(Column.__and__, [of_row[c].eqNullSafe(F.col(f"{mark}{c}")) for c in keys.columns])
    return docs.join(named, same, how).select(*docs.columns)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of similar texts: the one with the smallest id, null ids last, then with the smallest hashes.

    Rows are judged by their own texts, so rows that share an id go their own ways. Rows without words resemble nothing and stay.
    """
    _bound_memory(spark)
    plain = docs.select("doc_id", "text")
    hashes = list(_hashes())
    key = [F.col("doc_id").isNull().alias("none"), "doc_id", *hashes]
    path = scratch_path(spark, "judged-copies")
    # the tables behind the groups take more room than the texts
    with staging(spark):
        groups = stage(similar_groups(plain.withColumns(_hashes()), carry=hashes), "near-copies").where(F.col("group").isNotNull())
        winners = groups.groupBy("group").agg(F.min(F.struct(*key)).alias("w"))
        judged = groups.join(winners, "group").withColumn("_wins", F.struct(*key) == F.col("w"))
        by_row = judged.groupBy("doc_id", *hashes).agg(F.bool_and("_wins").alias("wins"), F.count(F.lit(1)).alias("n"))
        by_row.write.parquet(path)
    rows = spark.read.schema(by_row.schema).parquet(path)
    losers = rows.where("NOT wins").select("doc_id", *hashes)
    # a winner may stand in the table more than once
    repeated = rows.where("wins AND n > 1").select("doc_id", *hashes)
    once = _by_key(docs, repeated, "left_semi").dropDuplicates(["doc_id", "text"])
    return _by_key(docs, losers.unionAll(repeated), "left_anti").unionByName(once)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without what an earlier document holds; n_chars follows, and emptied documents go."""
    _bound_memory(spark)
    others = [c for c in docs.columns if c not in ("doc_id", "text", "n_chars")]
    # further columns go along in one, so that none of them meets a name of the operator
    packed = docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in others]).alias("others")) if others else docs.select("doc_id", "text")
    cut = cut_texts(packed).where("text is null or text <> ''")
    length = F.length("text").cast(docs.schema["n_chars"].dataType).alias("n_chars")
    return cut.select("doc_id", "text", length, *[F.col(f"others.`{c}`").alias(c) for c in others]).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that don't hold too much of a benchmark.

    Contamination is a matter of the text alone, so texts are judged under a hash. Texts whose hash is found are few; they are judged again
    under numbers of their own, so that no clean text goes because it shares the hash of another.
    """
    _bound_memory(spark)
    items = table(spark, sf_dir, "benchmark")
    first, second = _hashes().values()
    found = contamination(docs.select(first.alias("doc_id"), "text"), items)
    suspect = stage(found.where("contaminated").select(F.col("doc_id").alias("_found")).distinct(), "suspect-texts")
    texts = docs.select("text").withColumns(_hashes()).join(suspect, F.col("_hash1") == F.col("_found"), "left_semi").dropDuplicates(list(_hashes()))
    numbered = stage(texts.withColumn("doc_id", F.monotonically_increasing_id()), "numbered-texts")
    sure = contamination(numbered, items).where("contaminated").select("doc_id")
    return _by_key(docs, stage(numbered.join(sure, "doc_id").select(*_hashes()), "contaminated"), "left_anti")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, digests of the ids and of the decoded text, and the ids as little-endian u32."""
    _bound_memory(spark)
    coded = encode_documents(docs, public_tokenizers.path("word_bpe_49k.json"))
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"), "ids")


STAGES = [
    ("language_id", keep_known_languages),
    ("jaccard_join", keep_one_of_near_copies),
    ("substring_dedup", cut_repeated_passages),
    ("decontamination", drop_contaminated),
    ("bpe", encode),
]

# The models and the similarity join have no form in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
