"""Registered queries of the operators and their SQL."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.llm.byte_cnn import language_id
from reviewloom.llm.common import id_crc, table
from reviewloom.llm.divergence_rules import divergence_rules
from reviewloom.llm.factorization import toxicity
from reviewloom.llm.fill_middle import fill_middle, restored
from reviewloom.llm.importance_resampling import resample
from reviewloom.llm.jaccard_join import jaccard_components
from reviewloom.llm.positional_index import contamination
from reviewloom.llm.simhash import document_fingerprints
from reviewloom.llm.substring_dedup import removed_bytes
from reviewloom.llm.token_records import token_records
from reviewloom.llm.url_templates import Rule, judge_urls
from reviewloom.llm.warc import warc_pages
from reviewloom.llm.word_tokens import word_tokens


def op1_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_records(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=2).select(
        "doc_id", "start", "n_tokens", "ids_crc32", "file", "offset", "length"
    )


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return warc_pages(table(spark, sf_dir, "pages")).select(*fields)


def op3_factorization(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), held_out=id_crc() % 5 == 0)


# Fixed rules of the url query.
URL_RULES = [
    Rule("com/", block=False),
    Rule("example.com/en/", block=True),
    Rule("www.example.com/en/", block=False),
    Rule("net/es/", block=True),
    Rule("net/fr/", block=True),
]


def op4_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op6_divergence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence_rules(table(spark, sf_dir, "documents"))


def op7_positional_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removed_bytes(table(spark, sf_dir, "documents"))


def op10_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(table(spark, sf_dir, "documents"), held_out=id_crc() % 3 == 1)


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "n_near"]
    return document_fingerprints(table(spark, sf_dir, "documents"), scanned=True).select(*fields)


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_middle(table(spark, sf_dir, "documents"))
    output, text = F.col("output"), restored(F.col("output"), F.col("form"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(output, 256).alias("output_sha256"), F.sha2(text, 256).alias("restored_sha256")
    )


QUERIES = {
    "op1_token_records": op1_token_records,
    "op2_warc": op2_warc,
    "op3_factorization": op3_factorization,
    "op4_url_templates": op4_url_templates,
    "op5_bpe": op5_bpe,
    "op6_divergence_rules": op6_divergence_rules,
    "op7_positional_index": op7_positional_index,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_byte_cnn": op10_byte_cnn,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_simhash": op12_simhash,
    "op13_fill_middle": op13_fill_middle,
    "pipeline": corpus_pipeline.run,
}

ORACLES: dict[str, str] = {
    # windows of 13 words, or of the whole item where it is shorter, joined as texts
    "op7_positional_index": r"""
        WITH d AS (
            SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
        b AS (
            SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
        bw AS (SELECT item_id, w, least(13, len(w)) AS m, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0),
        win AS (SELECT DISTINCT item_id, m, array_to_string(w[i:i + m - 1], ' ') AS s FROM bw),
        dp AS (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, (SELECT DISTINCT m FROM win) WHERE len(w) >= m),
        dw AS (SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS s FROM dp),
        hit AS (SELECT doc_id, i, win.m AS m, item_id FROM dw JOIN win ON dw.s = win.s AND dw.m = win.m),
        pos AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + m)) AS p FROM hit) GROUP BY doc_id),
        its AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
                FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM hit) GROUP BY doc_id)
        SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
        FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)""",
    # hashes of seed and id as numbers, units by pattern, parts joined again
    "op13_fill_middle": r"""
        WITH d AS (
            SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
                sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
        x AS (SELECT doc_id, t, u, len(u) AS n, [CAST('0x' || h[8 * k + 1:8 * k + 8] AS BIGINT) FOR k IN [0, 1, 2, 3]] AS h FROM d),
        c AS (
            SELECT doc_id, t, n, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b, u,
                CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 90 THEN 'plain'
                     WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM x),
        p AS (
            SELECT doc_id, t, n, form, array_to_string(u[1:a], '') AS pre, array_to_string(u[a + 1:b], '') AS mid, array_to_string(u[b + 1:n], '') AS suf
            FROM c)
        SELECT doc_id, CAST(n AS BIGINT) AS n, form,
            CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars,
            CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
            sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                   ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
            sha256(t) AS restored_sha256
        FROM p""",
    # checksums of the distinct runs byte by byte, through a table of 256 remainders
    "op11_importance_resampling": r"""
        WITH RECURSIVE rem(i, k, c) AS (
            SELECT i, 0, i FROM range(256) r(i)
            UNION ALL SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM rem WHERE k < 8),
        tab AS (SELECT list(c ORDER BY i) AS tab FROM rem WHERE k = 8),
        src AS (
            SELECT true AS own, row_number() OVER () AS r, doc_id, text FROM documents
            UNION ALL SELECT false, row_number() OVER (), NULL, text FROM benchmark),
        w AS (
            SELECT own, r, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM src),
        g AS (
            SELECT own, r, array_to_string(w[i:i + m - 1], ' ') AS g
            FROM (SELECT own, r, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM w, range(1, 4) k(m) WHERE len(w) >= m)),
        f AS (SELECT own, r, g, count(*) AS c FROM g GROUP BY ALL),
        crc AS (
            SELECT g, xor(list_reduce([x FOR x IN list_concat([4294967295], list_transform(range(0, octet_length(encode(g))),
                lambda k: CAST('0x' || hex(encode(g))[2 * k + 1:2 * k + 2] AS BIGINT)))],
                lambda a, b: xor(a >> 8, tab[CAST(xor(a & 255, b) AS INTEGER) + 1])), 4294967295) % 10000 AS bucket
            FROM (SELECT DISTINCT g FROM f), tab),
        fb AS (SELECT own, r, bucket, sum(c) AS c FROM f JOIN crc USING (g) GROUP BY ALL),
        cnt AS (SELECT bucket, coalesce(sum(c) FILTER (own), 0) AS s, coalesce(sum(c) FILTER (NOT own), 0) AS t FROM fb GROUP BY bucket),
        tot AS (SELECT CAST(sum(s) AS DOUBLE) AS s_all, CAST(sum(t) AS DOUBLE) AS t_all FROM cnt),
        gain AS (
            SELECT bucket, CAST(floor(1000 * ln(((CAST(t AS DOUBLE) + 1) * (s_all + 10000)) / ((CAST(s AS DOUBLE) + 1) * (t_all + 10000)))) AS BIGINT) AS gain
            FROM cnt, tot),
        wt AS (SELECT r, sum(c * gain) AS weight, sum(c) AS n_features FROM fb JOIN gain USING (bucket) WHERE own GROUP BY r),
        sc AS (
            SELECT doc_id, len(w) AS n_words, CAST(coalesce(n_features, 0) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
                CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), ''))[1:8] AS BIGINT) + 0.5)
                    / 4294967296.0))) AS BIGINT) AS score
            FROM w LEFT JOIN wt USING (r) WHERE own),
        rk AS (
            SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id NULLS LAST, n_features) AS place,
                count(*) FILTER (n_words >= 20) OVER () AS many FROM sc)
        SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= 5 * many // 100 THEN place END AS rank FROM rk""",
}
