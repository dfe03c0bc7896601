"""SQL for DuckDB that must give the same rows as the registered queries.

The views are written out again here as CTEs, so both sides are independent.
"""

from __future__ import annotations

from reviewloom.functions.text import WHITESPACE
from reviewloom.workload.queries import BUCKET_CAP, CHUNK_SIZE, PADDING_RATIO, TOKEN_CAP

WS = WHITESPACE
# Token separators: the same without the four separator controls.
SPACES = "".join(c for c in WHITESPACE if not "\x1c" <= c <= "\x1f")

# Views

RV = r"""rv AS (
  SELECT CAST(d.doc_id AS VARCHAR) AS review_id,
         CASE WHEN d.doc_id % 5 = 0 THEN d.doc_id || '.0' ELSE CAST(d.doc_id AS VARCHAR) END AS order_id,
         CAST(o.o_custkey AS VARCHAR) AS product_id, o.o_orderdate AS created_at,
         CASE d.doc_id % 4 WHEN 0 THEN NULL WHEN 1 THEN split_part(d.text, chr(10), 1)
                           WHEN 2 THEN d.source || ' ' || d.lang ELSE '  ' END AS title,
         CASE WHEN d.doc_id % 17 = 0 THEN NULL WHEN d.doc_id % 19 = 0 THEN ' ' || chr(12288) || ' '
              ELSE d.text END AS contents,
         CASE WHEN d.doc_id % 3 = 0 THEN NULL WHEN d.doc_id % 3 = 1 THEN ''
              ELSE CAST(d.doc_id % 5 + 1 AS VARCHAR) END AS star_rating,
         d.source AS writer_name, d.lang,
         list_transform(range(1, d.doc_id % 4 + 1), lambda i: 'http://img/' || d.doc_id || '/' || i) AS images
  FROM documents d LEFT JOIN orders o ON o.o_orderkey = d.doc_id)"""

RF = """rf AS (
  SELECT l_orderkey * 10 + l_linenumber AS review_id, l_orderkey AS order_id, l_partkey AS product_id,
         l_shipdate AS created_at, CAST(l_quantity AS INT) % 5 + 1 AS star_rating, l_extendedprice AS amount
  FROM lineitem)"""

OH = """oh AS (
  SELECT CASE WHEN o_orderstatus <> 'P' THEN o_orderkey END AS order_id, o_custkey AS buyer_id,
         c_name AS buyer_name, o_orderdate AS ordered_at
  FROM orders JOIN customer ON o_custkey = c_custkey)"""

PM = """pm AS (
  SELECT CASE WHEN p_size <= 42 THEN p_partkey END AS source_product_id, p_partkey + 100000 AS export_product_id
  FROM part)"""

OM = """om AS (
  SELECT CASE WHEN p_size > 4 THEN p_partkey + 100000 END AS export_product_id, p_name AS product_name,
         p_brand AS option_name FROM part
  UNION ALL
  SELECT p_partkey + 100000, p_name, p_type FROM part WHERE p_type = 'PROMO')"""

LB = """lb AS (
  SELECT CAST(d.doc_id AS VARCHAR) AS review_id,
         coalesce(l.quality, CASE WHEN d.n_chars >= 1000 THEN 1 ELSE 0 END) AS label
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)"""

PI = """b AS (
  SELECT user_id % 4 AS term, event_id // 50 AS page, event_id AS id FROM events),
m AS (SELECT term, max(page) AS hi, min(page) AS lo FROM b GROUP BY term),
pi AS (
  SELECT term, page, id FROM b
  UNION ALL SELECT b.term, m.hi + 1, b.id FROM b JOIN m ON b.term = m.term AND b.page = m.hi
  UNION ALL SELECT b.term, m.hi + 2, b.id + 1000000 FROM b JOIN m ON b.term = m.term AND b.page = m.lo),
pg AS (
  SELECT term, page, count(*) AS record_count,
         sha256(array_to_string(list_sort(list_distinct(list(CAST(id AS VARCHAR)))), ',')) AS fingerprint
  FROM pi GROUP BY term, page)"""

CV = r"""cv AS (
  SELECT conv_id, turn, conv_id * 100 + turn AS record_id, role,
         regexp_replace(replace(text, chr(10), ' '), '[\x00-\x1F\x7F]', '', 'g') AS cleaned,
         'http://img/' || conv_id || '/' || turn AS url
  FROM conversations)"""

TL = f"""tl AS (
  SELECT doc_id // 4 AS batch_id, n_chars AS text_length,
         CAST(CASE WHEN coalesce(trim(text, '{WS}'), '') = '' THEN 0
                   ELSE len(string_split_regex(trim(text, '{WS}'), '[{SPACES}]+')) END AS BIGINT) AS token_length,
         CASE WHEN doc_id % 6 = 0 THEN 0 ELSE 1 END AS label
  FROM documents),
ev AS (
  SELECT batch_id AS event_id, CASE WHEN batch_id % 9 = 0 THEN 'oom_fallback' ELSE 'inferred' END AS event_type,
         TIMESTAMP '2024-01-01' + to_hours(batch_id) AS timestamp,
         CAST(TIMESTAMP '2024-01-01' + to_hours(batch_id) AS DATE) AS day,
         count(*) AS n, max(token_length) AS max_tokens, CAST(sum(token_length) AS BIGINT) AS total_tokens,
         count(*) FILTER (label = 1) AS positive_text_count, count(*) FILTER (label = 0) AS negative_text_count
  FROM tl GROUP BY batch_id)"""

def p95(value: str) -> str:
    """Linear interpolation between two order statistics, measured from the nearer end."""
    ls = f"list_sort(list({value}))"
    place = "0.95::DOUBLE * (count(*) - 1)"
    low, high = f"{ls}[CAST(floor({place}) AS BIGINT) + 1]", f"{ls}[least(CAST(floor({place}) AS BIGINT) + 2, count(*))]"
    share = f"({place} - floor({place}))"
    return (
        f"CAST(floor(CASE WHEN {share} >= 0.5 THEN {high} - ({high} - {low}) * (1 - {share}) "
        f"ELSE {low} + ({high} - {low}) * {share} END) AS BIGINT)"
    )


MS = f"""ms AS (
  SELECT l_returnflag AS series, CAST(date_trunc('month', l_shipdate) AS DATE) AS month,
         {p95("CAST(floor(l_extendedprice / 100) AS BIGINT)")} AS p95_text_length
  FROM lineitem GROUP BY 1, 2)"""

TK = f"""tk AS (
  SELECT doc_id, CAST(least(len(string_split_regex(trim(text, '{WS}'), '[{SPACES}]+')), {TOKEN_CAP}) AS BIGINT) AS tokens
  FROM documents WHERE trim(text, '{WS}') <> '')"""


def sql(*parts: str, recursive: bool = False) -> str:
    *ctes, select = parts
    if not ctes:
        return select
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(ctes) + "\n" + select


def hashed(id_text: str, digits: int = 4) -> str:
    """SHA-256 of a text modulo 10**digits, word by word."""
    return (
        f"lpad(CAST(list_reduce(list_prepend(0::BIGINT, list_transform(range(1, 58, 8), "
        f"lambda p: ('0x' || substr(sha256({id_text}), p, 8))::BIGINT)), "
        f"lambda a, w: (a * 4294967296 + w) % {10**digits}) AS VARCHAR), {digits}, '0')"
    )


def chunked(stats: str, series: str, order: str, value: str, size: int = 12) -> str:
    """CTEs up to the chunk means of a series."""
    return f"""numbered AS (
  SELECT {series} AS series, {value} AS value, row_number() OVER (PARTITION BY {series} ORDER BY {order}) - 1 AS i,
         count(*) OVER (PARTITION BY {series}) AS n FROM {stats}),
sized AS (SELECT *, (n - 1) // {size} AS last_chunk, n - ((n - 1) // {size}) * {size} AS last_size FROM numbered),
cm AS (
  SELECT series, least(i // {size}, CASE WHEN last_size < {size // 2} AND last_chunk > 0 THEN last_chunk - 1 ELSE last_chunk END) AS chunk,
         n AS interval_count, last_size AS last_chunk_size, avg(value) AS chunk_mean
  FROM sized GROUP BY ALL)"""


TREND = """sums AS (
  SELECT series, interval_count, last_chunk_size, count(*) AS k,
         sum((chunk + 1) ** 2) AS s0, sum((chunk + 1) ** 2 * chunk) AS s1, sum((chunk + 1) ** 2 * chunk * chunk) AS s2,
         sum((chunk + 1) ** 2 * chunk_mean) AS t0, sum((chunk + 1) ** 2 * chunk * chunk_mean) AS t1
  FROM cm GROUP BY ALL),
line AS (SELECT *, (s0 * t1 - s1 * t0) / (s0 * s2 - s1 * s1) AS slope,
                k - 1 + least(last_chunk_size / 12.0, 1.0) AS present FROM sums),
fc AS (SELECT *, (t0 - slope * s1) / s0 AS intercept,
              greatest(1, CAST(round_even(slope * present + (t0 - slope * s1) / s0, 0) AS BIGINT)) AS forecast FROM line)"""

RATIO = """CASE WHEN oom_count = 0 THEN least(0.8, 0.7 + 0.05)
     WHEN inferred_count = 0 OR oom_count >= inferred_count THEN 0.4
     ELSE greatest(0.4, 0.7 * (1 - oom_count / inferred_count)) END"""

STATS = f"""count(*) AS inferred_total_text_count, count(*) FILTER (label = 1) AS positive_text_count,
       count(*) FILTER (label = 0) AS negative_text_count,
       CAST(sum(text_length) AS DOUBLE) / count(*) AS avg_text_length,
       {p95("text_length")} AS p95_text_length,
       CAST(sum(token_length) AS DOUBLE) / count(*) AS avg_token_length,
       {p95("token_length")} AS p95_token_length,
       CAST(sum(token_length) AS DOUBLE) / CAST(sum(text_length) AS DOUBLE) AS token_to_text_ratio"""

INFERRED = "inferred AS (SELECT tl.*, ev.day, ev.timestamp FROM tl JOIN ev ON ev.event_id = tl.batch_id WHERE event_type = 'inferred')"

OLD_NEW = """o AS (SELECT CAST(CASE WHEN o_orderstatus <> 'P' THEN o_orderkey END AS VARCHAR) AS order_id, o_totalprice AS total,
                   o_orderdate AS ordered_at FROM orders),
n AS (SELECT CAST(CASE WHEN o_orderstatus <> 'F' THEN o_orderkey * 2 END AS VARCHAR) AS order_id, o_totalprice * 2 AS total,
             o_orderpriority AS priority FROM orders)"""

SIDES = """l AS (SELECT review_id AS review__review_id, order_id AS review__order_id, product_id AS review__product_id,
                   created_at AS review__created_at, star_rating AS review__star_rating, amount AS review__amount FROM rf),
r AS (SELECT order_id AS order_history__order_id, buyer_id AS order_history__buyer_id,
             buyer_name AS order_history__buyer_name, ordered_at AS order_history__ordered_at FROM oh)"""

NAMED = """l AS (SELECT review_id, order_id, created_at, amount FROM rf),
r AS (SELECT order_id AS oid, ordered_at AS created_at, buyer_name, buyer_id AS amount FROM oh)"""

RULE_INPUT = """ri AS (
  SELECT rf.review_id AS "리뷰_id", 'nobody' AS "리뷰_작성자명", rf.star_rating AS "리뷰_별점",
         oh.buyer_name AS order_history__buyer_name
  FROM rf LEFT JOIN oh ON rf.order_id = oh.order_id)"""

FACT_ORDER = "product_id NULLS LAST, review_id, order_id, created_at, star_rating, amount"

CHUNKS = f"""numbered AS (
  SELECT *, row_number() OVER (ORDER BY {FACT_ORDER}) AS row_number FROM rf),
chunks AS (SELECT *, (row_number - 1) // {CHUNK_SIZE} + 1 AS chunk FROM numbered)"""


def images(width: int = 10, source: str = "images", name: str = '"URL_이미지{}"') -> str:
    return ", ".join(f"{source}[{i}] AS {name.format(i)}" for i in range(1, width + 1))


PRE_A = f"""r AS (
  SELECT *, CAST(CAST(CAST(order_id AS DOUBLE) AS BIGINT) AS VARCHAR) AS oid FROM rv WHERE product_id IS NOT NULL),
h AS (SELECT CAST(order_id AS VARCHAR) AS oid, buyer_name FROM oh WHERE order_id IS NOT NULL AND buyer_id IS NOT NULL),
mp AS (SELECT CAST(source_product_id AS VARCHAR) AS sid, CAST(export_product_id AS VARCHAR) AS eid FROM pm
       WHERE source_product_id IS NOT NULL),
op AS (SELECT CAST(export_product_id AS VARCHAR) AS eid, product_name, option_name FROM om
       WHERE export_product_id IS NOT NULL AND trim(product_name) <> ''),
pre AS (
  SELECT r.review_id AS "리뷰_id", mp.eid AS "상품_id", CAST(r.created_at AS DATE) AS "리뷰_작성_일자",
         strftime(r.created_at, '%H:%M:%S') AS "리뷰_작성_시간", h.buyer_name AS "리뷰_작성자명",
         r.contents AS "리뷰_내용", 5 AS "리뷰_별점",
         op.product_name AS "구매옵션_옵션명1", op.option_name AS "구매옵션_옵션값1",
         '구매처' AS "고객정보_정보명1", '에이블리 구매자 리뷰입니다.' AS "고객정보_답변값1", {images()}
  FROM r LEFT JOIN h ON r.oid = h.oid LEFT JOIN mp ON r.product_id = mp.sid LEFT JOIN op ON mp.eid = op.eid
  WHERE trim(coalesce(r.contents, ''), '{WS}') <> '')"""

POST_A = f"""pos AS (
  SELECT p.* EXCLUDE ("상품_id", "구매옵션_옵션명1", "구매옵션_옵션값1"), op.eid AS "상품_id",
         op.product_name AS "구매옵션_옵션명1", op.option_name AS "구매옵션_옵션값1"
  FROM pre p JOIN op ON p."상품_id" = op.eid JOIN lb ON lb.review_id = p."리뷰_id" AND lb.label = 1
  WHERE p."구매옵션_옵션명1" IS NOT NULL AND p."구매옵션_옵션값1" IS NOT NULL),
post AS (
  SELECT * EXCLUDE ("리뷰_id"), strftime("리뷰_작성_일자", '%Y%m%d') || replace(left("리뷰_작성_시간", 5), ':', '')
         || {hashed('"리뷰_id"')} AS "리뷰_id" FROM pos)"""

# title/contents merge of a view with `title` and `contents`
MERGED = f"""CASE WHEN title IS NULL AND contents IS NULL THEN NULL
     WHEN trim(coalesce(title, ''), '{WS}') <> ''
          AND starts_with(trim(coalesce(contents, ''), '{WS}'), trim(coalesce(title, ''), '{WS}'))
     THEN trim(contents, '{WS}')
     WHEN trim(coalesce(title, ''), '{WS}') = '' THEN trim(coalesce(contents, ''), '{WS}')
     WHEN trim(coalesce(contents, ''), '{WS}') = '' THEN trim(title, '{WS}')
     ELSE trim(title, '{WS}') || ' ' || trim(contents, '{WS}') END"""

INGESTED = sql(
    CV,
    """SELECT CAST(record_id AS VARCHAR) AS "리뷰_id", cleaned AS "리뷰_내용", role AS "구매자명",
       CAST(NULL AS VARCHAR) AS "리뷰_작성_일시", CAST(NULL AS VARCHAR) AS "리뷰_제목", CAST(NULL AS VARCHAR) AS "별점",
       CAST(NULL AS VARCHAR) AS "상품_노출_id", CAST(NULL AS VARCHAR) AS "판매명", CAST(NULL AS VARCHAR) AS "상품_옵션_id",
       url AS "URL_이미지1", """
    + ", ".join(f'CAST(NULL AS VARCHAR) AS "URL_이미지{i}"' for i in range(2, 11))
    + " FROM cv",
)

BUCKETS = f"""ranked AS (SELECT *, row_number() OVER (ORDER BY tokens, doc_id) AS rn FROM tk),
filled AS (
  SELECT rn, doc_id, tokens, CAST(0 AS BIGINT) AS bucket, CAST(1 AS BIGINT) AS size, tokens AS smallest
  FROM ranked WHERE rn = 1
  UNION ALL
  SELECT t.rn, t.doc_id, t.tokens,
         CASE WHEN t.tokens * (f.size + 1) <= {BUCKET_CAP} AND f.smallest / t.tokens >= {PADDING_RATIO} THEN f.bucket ELSE f.bucket + 1 END,
         CASE WHEN t.tokens * (f.size + 1) <= {BUCKET_CAP} AND f.smallest / t.tokens >= {PADDING_RATIO} THEN f.size + 1 ELSE 1 END,
         CASE WHEN t.tokens * (f.size + 1) <= {BUCKET_CAP} AND f.smallest / t.tokens >= {PADDING_RATIO} THEN f.smallest ELSE t.tokens END
  FROM filled f JOIN ranked t ON t.rn = f.rn + 1)"""

RESPLIT = """inner_rank AS (
  SELECT bucket, doc_id, tokens, row_number() OVER (PARTITION BY bucket ORDER BY tokens, doc_id) AS j,
         greatest(CAST(floor(sum(tokens) OVER (PARTITION BY bucket) * 0.7::DOUBLE) AS BIGINT), 1) AS cap FROM filled),
parts AS (
  SELECT bucket, doc_id, tokens, j, cap, CAST(0 AS BIGINT) AS part, CAST(1 AS BIGINT) AS size FROM inner_rank WHERE j = 1
  UNION ALL
  SELECT t.bucket, t.doc_id, t.tokens, t.j, t.cap,
         CASE WHEN t.tokens * (p.size + 1) <= t.cap THEN p.part ELSE p.part + 1 END,
         CASE WHEN t.tokens * (p.size + 1) <= t.cap THEN p.size + 1 ELSE 1 END
  FROM parts p JOIN inner_rank t ON t.bucket = p.bucket AND t.j = p.j + 1)"""

ORACLES: dict[str, str] = {
    "scan_spec": """SELECT l_orderkey, l_partkey, l_quantity, l_shipdate FROM lineitem
        WHERE l_shipdate >= DATE '1998-01-01' AND l_quantity >= 10""",
    "scan_group_by": "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem",
    "scan_union_parts": """SELECT c_custkey AS party_id, c_name AS name, c_acctbal AS balance, c_mktsegment, CAST(NULL AS INT) AS nation FROM customer
        UNION ALL SELECT s_suppkey, s_name, NULL, NULL, s_nationkey FROM supplier""",
    "upsert_overwrite": sql(
        OLD_NEW,
        """SELECT order_id, total, ordered_at, CAST(NULL AS VARCHAR) AS priority FROM o
        WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.order_id IS NOT DISTINCT FROM o.order_id)
        UNION ALL SELECT order_id, total, NULL, priority FROM n""",
    ),
    "upsert_ignore": sql(
        OLD_NEW,
        """SELECT order_id, total, ordered_at, CAST(NULL AS VARCHAR) AS priority FROM o
        UNION ALL SELECT order_id, total, NULL, priority FROM n
        WHERE NOT EXISTS (SELECT 1 FROM o WHERE n.order_id IS NOT DISTINCT FROM o.order_id)""",
    ),
    "upsert_conflicts": sql(OLD_NEW, "SELECT DISTINCT order_id FROM o WHERE order_id IN (SELECT order_id FROM n)"),
    "dir_column_merge": """WITH m AS (SELECT *, coalesce(event_type IN ('click', 'view', 'error', 'signup'), false) AS listed FROM events)
        SELECT CASE WHEN listed OR user_id % 3 <> 0 THEN CAST(event_id AS VARCHAR) END AS event_id,
        CASE WHEN event_type IN ('click', 'view') OR NOT listed AND user_id % 3 <> 0 THEN CAST(value AS VARCHAR) END AS value,
        CASE WHEN listed THEN props END AS props FROM m""",
    "event_log_scan": sql(
        TL,
        """SELECT event_id, event_type, timestamp, n AS batch_size, max_tokens, total_tokens, CAST(n AS INT) AS text_count,
        positive_text_count, negative_text_count FROM ev WHERE timestamp >= TIMESTAMP '2024-01-03'""",
    ),
    "event_log_tail": sql(TL, "SELECT event_id, event_type, timestamp FROM ev ORDER BY timestamp DESC, event_id DESC LIMIT 10"),
    "reindex_lenient": "SELECT o_totalprice, o_orderkey, o_orderstatus FROM orders",
    "rename_safe": "SELECT o_orderkey AS order_id, o_custkey, o_orderstatus, o_totalprice AS total, o_orderdate, o_orderpriority FROM orders",
    "drop_safe": "SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate FROM orders",
    "prefix_columns": sql(RF, OH, SIDES, "SELECT * FROM r"),
    "schema_map_rename": """SELECT l_orderkey AS key, l_quantity AS amount1, l_discount AS amount2, l_tax AS v3,
        l_returnflag AS marks1, l_linestatus AS state FROM lineitem""",
    "priority_project": sql(
        RF,
        OH,
        """SELECT rf.order_id, oh.buyer_name AS buyer, oh.ordered_at, rf.review_id
        FROM rf LEFT JOIN oh ON rf.order_id = oh.order_id""",
    ),
    "export_projection": sql(
        RV,
        f"""SELECT review_id AS "리뷰_id", product_id AS "상품_id", contents AS "리뷰_내용", {images()} FROM rv""",
    ),
    "array_widen": sql(RV, f"SELECT review_id, {images(name='image{}')} FROM rv"),
    "unify_types": """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, CAST(l_quantity AS BIGINT) AS l_quantity,
        l_extendedprice, l_returnflag, CAST(l_shipdate AS VARCHAR) AS l_shipdate, CAST(NULL AS VARCHAR) AS never,
        CAST(l_linenumber > 3 AS BIGINT) AS late FROM lineitem""",
    "json_flatten": sql(
        CV,
        """SELECT record_id, 'reviewId' AS path, CAST(record_id AS VARCHAR) AS value FROM cv
        UNION ALL SELECT record_id, 'memberName', role FROM cv
        UNION ALL SELECT record_id, 'reviewContent', cleaned FROM cv
        UNION ALL SELECT record_id, 'goods.sno', CAST(conv_id AS VARCHAR) FROM cv
        UNION ALL SELECT record_id, 'images.1', role FROM cv
        UNION ALL SELECT record_id, 'images.2', 'x' FROM cv
        UNION ALL SELECT record_id, 'attachment.imageAttachments.1.imgSrc', url FROM cv
        UNION ALL SELECT record_id, 'deep.n1.1.n2.n3.1.n4.n5.1.n6.n7.1.n8.n9.1.n10.n11.1.role', role FROM cv""",
    ),
    "json_embedded": sql(
        CV, "SELECT CAST(record_id AS VARCHAR) AS review_id, url AS image1, CAST(NULL AS VARCHAR) AS image2 FROM cv"
    ),
    "json_target_keys": sql(
        CV,
        """SELECT CAST(record_id AS VARCHAR) AS review_id, CAST(conv_id AS VARCHAR) AS goods, 'x' AS second,
        '' AS third, '' AS absent FROM cv""",
    ),
    "json_records": sql(CV, "SELECT conv_id % 4 AS term, conv_id // 4 AS page, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS INT) AS position, record_id AS review_id FROM cv"),
    "missing_keys": sql(
        CV,
        """SELECT key AS missing_key, (SELECT count(*) FROM cv) AS records_without
        FROM (VALUES ('images.{index}'), ('goods.name'), ('attachment.imageAttachments.{index}.imgSrc')) AS t(key)""",
    ),
    "drop_blank": sql(
        RV,
        f"""SELECT review_id, order_id, title, contents FROM rv
        WHERE trim(coalesce(title, ''), '{WS}') <> '' AND trim(coalesce(contents, ''), '{WS}') <> ''""",
    ),
    "filter_contains": """SELECT * FROM part WHERE regexp_matches(lower(p_name), 'red|ring$') AND regexp_matches(lower(p_type), 'pro')""",
    "filter_equals_ci": "SELECT * FROM part WHERE lower(p_type) = 'promo' AND lower(p_brand) = 'brand#1'",
    "positive_filter": sql(
        RV, LB, "SELECT rv.review_id, product_id, contents FROM rv JOIN lb ON lb.review_id = rv.review_id WHERE label = 1"
    ),
    "join_simple_left": sql(
        RF, OH, SIDES, "SELECT * FROM l LEFT JOIN r ON review__order_id = order_history__order_id AND review__created_at = order_history__ordered_at"
    ),
    "join_simple_right": sql(
        RF, OH, SIDES, "SELECT * FROM l RIGHT JOIN r ON review__order_id = order_history__order_id AND review__created_at = order_history__ordered_at"
    ),
    "join_simple_inner": sql(RF, OH, SIDES, "SELECT * FROM l JOIN r ON review__order_id = order_history__order_id"),
    "join_simple_full": sql(RF, OH, SIDES, "SELECT * FROM l FULL JOIN r ON review__order_id = order_history__order_id"),
    "join_order_history": sql(RF, OH, SIDES, "SELECT * FROM l LEFT JOIN r ON review__order_id = order_history__order_id"),
    "join_product_map": sql(
        RF,
        OH,
        PM,
        SIDES,
        """SELECT l.*, pm.source_product_id AS id_mapping__source_product_id, pm.export_product_id AS id_mapping__export_product_id
        FROM l LEFT JOIN pm ON review__product_id = pm.source_product_id""",
    ),
    "join_option_map": sql(
        RF,
        OH,
        PM,
        OM,
        SIDES,
        """SELECT l.*, pm.source_product_id AS id_mapping__source_product_id, pm.export_product_id AS id_mapping__export_product_id,
        om.export_product_id AS product_option_mapping__export_product_id, om.product_name AS product_option_mapping__product_name,
        om.option_name AS product_option_mapping__option_name
        FROM l LEFT JOIN pm ON review__product_id = pm.source_product_id LEFT JOIN om ON pm.export_product_id = om.export_product_id""",
    ),
    "join_named_left": sql(
        RF, OH, NAMED,
        "SELECT l.*, r.buyer_name, r.created_at AS created_at__orders, r.amount AS amount__orders FROM l LEFT JOIN r ON order_id = oid",
    ),
    "join_named_right": sql(
        RF, OH, NAMED,
        "SELECT r.*, l.review_id, l.created_at AS created_at__reviews, l.amount AS amount__reviews FROM l RIGHT JOIN r ON order_id = oid",
    ),
    "join_named_inner": sql(
        RF, OH, NAMED,
        """SELECT l.*, r.buyer_name, l.created_at AS created_at__reviews, l.amount AS amount__reviews,
        r.created_at AS created_at__orders, r.amount AS amount__orders FROM l JOIN r ON order_id = oid""",
    ),
    "join_named_full": sql(
        RF, OH, NAMED,
        """SELECT l.review_id, r.buyer_name, l.order_id AS order_id__reviews, r.oid AS oid__orders,
        l.created_at AS created_at__reviews, l.amount AS amount__reviews, r.created_at AS created_at__orders, r.amount AS amount__orders
        FROM l FULL JOIN r ON order_id = oid""",
    ),
    "join_named_drop": sql(
        RF, OH, NAMED,
        "SELECT l.review_id, r.buyer_name, l.order_id AS order_id__reviews, r.oid AS oid__orders FROM l FULL JOIN r ON order_id = oid",
    ),
    "option_remap": sql(
        RF,
        OM,
        """SELECT rf.review_id, om.export_product_id AS product_id, rf.amount, om.product_name AS name, om.option_name AS option
        FROM rf JOIN om ON rf.product_id + 100000 = om.export_product_id WHERE rf.star_rating > 1""",
    ),
    "dedupe_last": sql(
        RF,
        """SELECT * FROM rf QUALIFY row_number() OVER (PARTITION BY review_id
        ORDER BY created_at DESC, product_id DESC, amount DESC, star_rating DESC) = 1""",
    ),
    "dedupe_first": sql(
        RF,
        """SELECT * REPLACE (CAST(review_id AS VARCHAR) AS review_id) FROM rf QUALIFY row_number() OVER (PARTITION BY review_id
        ORDER BY created_at, product_id, amount, star_rating) = 1""",
    ),
    "distinct_first_seen": "SELECT user_id, min(event_id) AS first_position FROM events GROUP BY user_id",
    "duplicate_keys": sql(RF, "SELECT review_id, count(*) AS row_count FROM rf GROUP BY review_id HAVING count(*) > 1"),
    "page_fingerprint": sql(PI, "SELECT * FROM pg"),
    "page_stop": sql(
        PI,
        """repeated AS (SELECT term, page, row_number() OVER (PARTITION BY term, fingerprint ORDER BY page) AS seen FROM pg),
stops AS (SELECT term, min(page) AS stop FROM repeated WHERE seen > 1 GROUP BY term)""",
        "SELECT pg.term, pg.page, pg.record_count FROM pg LEFT JOIN stops ON stops.term = pg.term WHERE stop IS NULL OR pg.page < stop",
    ),
    "term_windows": """WITH r AS (
      SELECT o_orderkey, o_orderdate AS s, o_orderdate + to_hours(25 * (o_custkey % 60)) AS e,
             CASE o_orderpriority WHEN '1-URGENT' THEN NULL WHEN '2-HIGH' THEN 86400000 ELSE 2073600000 END AS step FROM orders),
    c AS (SELECT *, CASE WHEN step IS NULL OR epoch_ms(e) - epoch_ms(s) <= step THEN 1
                         ELSE CAST(ceil((epoch_ms(e) - epoch_ms(s)) / step) AS BIGINT) END AS n FROM r),
    t AS (SELECT *, unnest(range(n)) AS term FROM c)
    SELECT o_orderkey, term, CASE WHEN n = 1 THEN s ELSE s + to_milliseconds(term * step) END AS term_start,
           CASE WHEN n = 1 THEN e ELSE least(s + to_milliseconds((term + 1) * step), e) END AS term_end FROM t""",
    "events_by_type": sql(TL, "SELECT event_type, count(*) AS event_count FROM ev GROUP BY 1"),
    "batch_summary": sql(
        TL,
        """SELECT batch_id, count(token_length) AS batch_size, max(token_length) AS max_token_count_per_batch,
        CAST(sum(token_length) AS BIGINT) AS total_token_count_per_batch FROM tl GROUP BY 1""",
    ),
    "label_counts": sql(
        TL, "SELECT event_id AS batch_id, positive_text_count, negative_text_count FROM ev"
    ),
    "interval_stats": sql(TL, INFERRED, f"SELECT day, {STATS} FROM inferred GROUP BY day"),
    "p95_length": f"""WITH t AS (SELECT lang, length(text) AS chars,
        CAST(CASE WHEN trim(text, '{WS}') = '' THEN 0
             ELSE len(string_split_regex(trim(text, '{WS}'), '[{SPACES}]+')) END AS BIGINT) AS tokens FROM documents)
        SELECT lang, count(*) AS count_chars, CAST(sum(chars) AS BIGINT) AS total_chars, {p95("chars")} AS p95_chars,
               count(*) AS count_tokens, CAST(sum(tokens) AS BIGINT) AS total_tokens, {p95("tokens")} AS p95_tokens
        FROM t GROUP BY lang""",
    "log_consistency": sql(
        TL,
        """SELECT event_id, n AS stored_size, CAST(n - 1 AS INT) AS held_size FROM ev
        WHERE event_type = 'inferred' AND event_id % 10 = 3""",
    ),
    "chunk_means": sql(
        MS,
        chunked("ms", "series", "month", "p95_text_length"),
        "SELECT series, chunk, interval_count, last_chunk_size, round(chunk_mean, 6) AS chunk_mean FROM cm",
    ),
    "trend_forecast": sql(
        MS,
        chunked("ms", "series", "month", "p95_text_length"),
        TREND,
        """SELECT series, interval_count, k AS chunk_count, round(CAST(present AS DOUBLE), 6) AS present, round(slope, 6) AS slope,
        round(intercept, 6) AS intercept, forecast FROM fc""",
    ),
    "ratio_update": sql(
        TL,
        """oc AS (SELECT day, count(*) FILTER (event_type = 'inferred') AS inferred_count,
                 count(*) FILTER (event_type = 'oom_fallback') AS oom_count FROM ev GROUP BY day)""",
        f"SELECT day, inferred_count, oom_count, round(CAST({RATIO} AS DOUBLE), 6) AS ratio FROM oc",
    ),
    "ema": sql(
        MS,
        "lagged AS (SELECT *, lag(p95_text_length) OVER (PARTITION BY series ORDER BY month) AS prev FROM ms)",
        """SELECT series, month, round(0.3::DOUBLE * p95_text_length + (1 - 0.3::DOUBLE) * prev, 6) AS ema,
        round(CAST(prev AS DOUBLE), 6) AS ema_out_of_range FROM lagged""",
    ),
    "adaptive_alpha": sql(
        MS,
        """d AS (SELECT series, p95_text_length - lag(p95_text_length) OVER (PARTITION BY series ORDER BY month) AS delta,
               row_number() OVER (PARTITION BY series ORDER BY month) - 2 AS i, count(*) OVER (PARTITION BY series) AS n FROM ms),
a AS (SELECT series, n, avg(delta) FILTER (i >= 0 AND i >= n - 4) - avg(delta) FILTER (i >= 0 AND i < n - 3) AS change FROM d GROUP BY series, n)""",
        """SELECT series, n AS interval_count, round(change, 6) AS delta_change,
        round(CAST(CASE WHEN n <= 3 OR abs(change) < 10 THEN 0.3 WHEN change > 0 THEN 0.35 ELSE 0.25 END AS DOUBLE), 6) AS alpha FROM a""",
    ),
    "stats_rescan": sql(
        TL,
        "w AS (SELECT day, count(*) AS n, max(timestamp) AS last FROM ev GROUP BY day)",
        """SELECT day, n - 1 AS event_count, n AS log_event_count, last - to_hours(1) AS last_timestamp, last AS log_last_timestamp
        FROM w WHERE dayofmonth(day) % 2 = 0""",
    ),
    "row_audit": sql(
        RV,
        f"""SELECT CAST(0 AS BIGINT) AS step, 'read' AS name, count(*) AS row_count FROM rv
        UNION ALL SELECT 1, 'with contents', count(*) FROM rv WHERE trim(coalesce(contents, ''), '{WS}') <> ''
        UNION ALL SELECT 2, 'with ids', count(*) FROM rv WHERE trim(coalesce(contents, ''), '{WS}') <> '' AND review_id IS NOT NULL AND order_id IS NOT NULL""",
    ),
    "chunk_ids": sql(RF, CHUNKS, "SELECT * FROM chunks"),
    "chunk_manifest": sql(
        RF,
        CHUNKS,
        """SELECT chunk, row_count, first_row, last_row, chunk_count,
        'upload_' || lpad(CAST(chunk AS VARCHAR), CAST(length(CAST(chunk_count AS VARCHAR)) AS INT), '0') || '_of_' || chunk_count AS file_name
        FROM (SELECT chunk, count(*) AS row_count, min(row_number) AS first_row, max(row_number) AS last_row,
                     max(chunk) OVER () AS chunk_count FROM chunks GROUP BY chunk)""",
    ),
    "id_batches": """WITH f AS (SELECT l_orderkey, min(l_partkey) AS pos FROM lineitem GROUP BY 1),
    g AS (SELECT *, row_number() OVER (ORDER BY pos, l_orderkey) AS rn FROM f)
    SELECT (rn - 1) // 100 + 1 AS batch, CAST(count(*) AS INT) AS id_count, string_agg(CAST(l_orderkey AS VARCHAR), ',' ORDER BY rn) AS ids
    FROM g GROUP BY 1""",
    "hide_reconcile": """WITH q AS (SELECT l_orderkey // 100 AS batch, l_orderkey AS id, bool_or(l_returnflag <> 'R') AS answered
               FROM lineitem GROUP BY 1, 2)
    SELECT batch, count(*) AS request_count, count(*) FILTER (answered) AS response_count,
           count(*) FILTER (NOT answered) AS unanswered_count, bool_and(answered) AS complete FROM q GROUP BY batch""",
    "token_buckets": sql(TK, BUCKETS, "SELECT doc_id, tokens, bucket FROM filled", recursive=True),
    "bucket_resplit": sql(TK, BUCKETS, RESPLIT, "SELECT bucket, tokens, doc_id, part FROM parts", recursive=True),
    "clean_text": r"""SELECT conv_id, turn, regexp_replace(replace(text || chr(9) || '|' || chr(127), chr(10), ' '),
        '[\x00-\x1F\x7F]', '', 'g') AS cleaned FROM conversations""",
    "parse_ts": """SELECT event_id,
        CASE event_type WHEN 'click' THEN date_trunc('millisecond', ts)
             WHEN 'view' THEN TIMESTAMP '1970-01-01' + to_seconds((20000000000 + event_id) // 1000)
             WHEN 'error' THEN NULL ELSE date_trunc('second', ts) END AS from_number,
        CASE WHEN event_type <> 'click' THEN date_trunc('second', ts) END AS from_text,
        make_timestamp(CAST(round(value * 1000000) AS BIGINT)) AS from_double FROM events""",
    "split_datetime": "SELECT event_id, CAST(ts AS DATE) AS created_date, strftime(ts, '%H:%M:%S') AS created_time FROM events",
    "parse_date_time": "SELECT event_id, CAST(ts AS DATE) AS created_date, strftime(ts, '%H:%M:%S') AS created_time FROM events",
    "parse_by_format": """SELECT event_id, CAST(strptime(strftime(ts, '%Y/%m/%d'), '%Y/%m/%d') AS DATE) AS slashed,
        CAST(strptime(strftime(ts, '%d.%m.%y'), '%d.%m.%y') AS DATE) AS short, CAST(strptime(strftime(ts, '%b %d, %Y'), '%b %d, %Y') AS DATE) AS named,
        strftime(strptime(strftime(ts, '%H%M%S'), '%H%M%S'), '%H:%M:%S') AS packed,
        strftime(strptime(strftime(ts, '%I:%M:%S %p'), '%I:%M:%S %p'), '%H:%M:%S') AS halved FROM events""",
    "date_time_text": """SELECT event_id, strftime(ts, '%Y-%m-%d') AS date_text, strftime(ts, '%H:%M:%S') AS time_text,
        strftime(ts, '%H:%M:%S') AS serial_time_text FROM events""",
    "join_date_time": "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS joined FROM events",
    "title_contents": sql(RV, f"SELECT review_id, {MERGED} AS contents FROM rv"),
    "int_string_id": """SELECT CASE WHEN o_orderpriority = '3-MEDIUM' THEN '9' || lpad(CAST(o_orderkey AS VARCHAR), 44, '0') ELSE CAST(o_orderkey AS VARCHAR) END AS order_id, CAST(o_custkey AS VARCHAR) AS buyer_id, o_totalprice
        FROM orders WHERE o_orderpriority NOT IN ('2-HIGH', '5-LOW')""",
    "int_string_id_keep": """SELECT CASE WHEN o_orderpriority = '3-MEDIUM' THEN '9' || lpad(CAST(o_orderkey AS VARCHAR), 44, '0') WHEN o_orderpriority NOT IN ('2-HIGH', '5-LOW') THEN CAST(o_orderkey AS VARCHAR) END AS order_id,
        CAST(o_custkey AS VARCHAR) AS buyer_id, o_totalprice FROM orders""",
    "hash_review_id": f"""SELECT event_id, strftime(ts, '%Y%m%d%H%M') || {hashed('CAST(event_id AS VARCHAR)')} AS review_id
        FROM events WHERE event_type <> 'error'""",
    "star_default": sql(RV, "SELECT review_id, coalesce(nullif(star_rating, ''), '5') AS star_rating FROM rv"),
    "token_count": f"""WITH t AS (SELECT doc_id, length(text) AS text_length,
        CASE WHEN coalesce(trim(text, '{WS}'), '') = '' THEN 0
             ELSE len(string_split_regex(trim(text, '{WS}'), '[{SPACES}]+')) END AS tokens FROM documents)
        SELECT doc_id, CAST(text_length AS BIGINT) AS text_length, CAST(tokens AS BIGINT) AS tokens,
               CAST(least(tokens, {TOKEN_CAP}) AS BIGINT) AS tokens_capped FROM t""",
    "classify_text": f"""WITH d AS (SELECT doc_id, unnest(list_filter(string_split_regex(lower(text), '[{SPACES}]+'), lambda x: x <> '')) AS w FROM documents),
        t AS (SELECT d.doc_id, w, quality FROM d JOIN labels USING (doc_id)),
        v AS (SELECT w, count(*) FILTER (quality = 0) AS n0, count(*) FILTER (quality = 1) AS n1 FROM t GROUP BY w),
        z AS (SELECT sum(n0) AS s0, sum(n1) AS s1, count(*) AS k FROM v),
        p AS (SELECT count(*) FILTER (quality = 0) AS d0, count(*) FILTER (quality = 1) AS d1 FROM documents JOIN labels USING (doc_id)),
        s AS (SELECT doc_id, sum(ln((n1 + 1) / (s1 + k)) - ln((n0 + 1) / (s0 + k))) AS x FROM d JOIN v USING (w), z GROUP BY doc_id)
        SELECT documents.doc_id, CAST(coalesce(x, 0) + ln(d1 + 1) - ln(d0 + 1) > 0 AS INT) AS label
        FROM documents LEFT JOIN s USING (doc_id), p""",
    "rule_writer_from_buyer": sql(RF, OH, RULE_INPUT, 'SELECT * REPLACE (order_history__buyer_name AS "리뷰_작성자명") FROM ri'),
    "rule_star_override": sql(RF, OH, RULE_INPUT, 'SELECT * REPLACE (5 AS "리뷰_별점") FROM ri'),
    "rules_identity": sql(RF, OH, RULE_INPUT, "SELECT * FROM ri"),
    "job_preprocess": sql(RV, OH, PM, OM, PRE_A, "SELECT * FROM pre"),
    "job_preprocess_without_orders": sql(
        RV,
        PM,
        OM,
        """mp AS (SELECT CAST(source_product_id AS VARCHAR) AS sid, CAST(export_product_id AS VARCHAR) AS eid FROM pm
       WHERE source_product_id IS NOT NULL),
op AS (SELECT CAST(export_product_id AS VARCHAR) AS eid, product_name, option_name FROM om WHERE export_product_id IS NOT NULL)""",
        f"""SELECT review_id AS "리뷰_id", mp.eid AS "상품_id", CAST(created_at AS DATE) AS "리뷰_작성_일자",
        strftime(created_at, '%H:%M:%S') AS "리뷰_작성_시간", writer_name AS "리뷰_작성자명", CAST(NULL AS VARCHAR) AS "리뷰_제목",
        {MERGED} AS "리뷰_내용", '5' AS "리뷰_별점", op.product_name AS "구매옵션_옵션명1", op.option_name AS "구매옵션_옵션값1",
        '구매처' AS "고객정보_정보명1", '쿠팡 구매자 리뷰입니다.' AS "고객정보_답변값1", {images()}
        FROM rv LEFT JOIN mp ON product_id = mp.sid LEFT JOIN op ON mp.eid = op.eid
        WHERE product_id IS NOT NULL AND trim(coalesce(contents, ''), '{WS}') <> ''""",
    ),
    "job_postprocess": sql(RV, OH, PM, OM, LB, PRE_A, POST_A, "SELECT * FROM post"),
    "postprocess_duplicates": sql(
        RV,
        OH,
        PM,
        OM,
        PRE_A,
        f"""ids AS (
          SELECT strftime("리뷰_작성_일자", '%Y%m%d') || replace(left("리뷰_작성_시간", 5), ':', '') || {hashed('"리뷰_id"')} AS "리뷰_id"
          FROM pre p JOIN op ON p."상품_id" = op.eid WHERE p."구매옵션_옵션명1" IS NOT NULL AND p."구매옵션_옵션값1" IS NOT NULL)""",
        """SELECT "리뷰_id", count(*) AS row_count FROM ids GROUP BY 1 HAVING count(*) > 1""",
    ),
    "finalize_split": sql(
        RF,
        CHUNKS,
        """SELECT * EXCLUDE (row_number), CASE WHEN chunk % 9 <> 0 AND chunk % 4 <> 0 THEN 'success' ELSE 'failed' END AS outcome FROM chunks""",
    ),
    "job_finalize": sql(
        RV,
        OH,
        PM,
        OM,
        LB,
        PRE_A,
        POST_A,
        """done AS (SELECT "리뷰_id", "상품_id", "리뷰_내용", "구매옵션_옵션값1",
               row_number() OVER (ORDER BY "상품_id" NULLS LAST, "리뷰_id", "구매옵션_옵션값1") AS row_number FROM post)""",
        """SELECT *, (row_number - 1) // 50 + 1 AS chunk,
        ((row_number - 1) // 50 + 1) % 9 <> 0 AND ((row_number - 1) // 50 + 1) % 4 <> 0 AS succeeded FROM done""",
    ),
    "job_ingest": INGESTED,
    "job_tune": sql(
        TL,
        INFERRED,
        f"""ds AS (SELECT 'all' AS series, timestamp AS hour,
              {p95("text_length")} AS p95_text_length FROM inferred GROUP BY 1, 2)""",
        chunked("ds", "series", "hour", "p95_text_length"),
        TREND,
        """oc AS (SELECT timestamp AS last_interval, count(*) FILTER (event_type = 'inferred') AS inferred_count,
                 count(*) FILTER (event_type = 'oom_fallback') AS oom_count FROM ev GROUP BY 1 ORDER BY 1 DESC LIMIT 1)""",
        f"""SELECT series, interval_count, forecast AS max_text_length, last_interval,
        round(CAST({RATIO} AS DOUBLE), 6) AS memory_usage_ratio FROM fc, oc""",
    ),
    "job_tune_refreshed": sql(
        TL,
        INFERRED,
        f"""se AS (SELECT batch_id, unnest(CASE WHEN batch_id % 5 <> 0 THEN ['all', 'most'] ELSE ['all'] END) AS series FROM (SELECT DISTINCT batch_id FROM tl)),
            ds AS (SELECT series, timestamp AS hour, {p95("text_length")} AS p95_text_length FROM inferred JOIN se USING (batch_id) GROUP BY 1, 2)""",
        chunked("ds", "series", "hour", "p95_text_length"),
        TREND,
        """oc AS (SELECT series, timestamp AS last_interval, count(*) FILTER (event_type = 'inferred') AS inferred_count,
                 count(*) FILTER (event_type = 'oom_fallback') AS oom_count FROM ev JOIN se ON batch_id = event_id GROUP BY 1, 2
                 QUALIFY row_number() OVER (PARTITION BY series ORDER BY timestamp DESC) = 1)""",
        f"""SELECT series, interval_count, forecast AS max_text_length, last_interval,
        round(CAST({RATIO} AS DOUBLE), 6) AS memory_usage_ratio FROM fc JOIN oc USING (series)""",
    ),
    "job_ingest_orders": """WITH o AS (SELECT o_custkey % 4 AS term, o_orderkey // 400 + 1 AS page, o_orderkey AS id, o_orderdate AS ordered FROM orders)
        SELECT CAST(id AS VARCHAR) AS "주문_id", CAST(id % 97 AS VARCHAR) AS "상품_id", 'first-' || id AS "구매자명", CAST(NULL AS VARCHAR) AS "구매자_번호",
               CAST(NULL AS VARCHAR) AS "구매자_이메일", CAST(NULL AS VARCHAR) AS "수취인명", CAST(NULL AS VARCHAR) AS "수취인_주소",
               CAST(NULL AS VARCHAR) AS "판매명", CAST(NULL AS VARCHAR) AS "상품_코드", CAST(NULL AS VARCHAR) AS "옵션_정보",
               strftime(ordered, '%Y-%m-%d') AS "주문_일시" FROM o""",
    "job_ingest_target": sql(
        CV,
        """qa AS (SELECT conv_id, turn // 2 + 1 AS k, max(cleaned) FILTER (turn % 2 = 0) AS q, max(cleaned) FILTER (turn % 2 = 1) AS a FROM cv GROUP BY ALL)""",
        """SELECT CAST(conv_id AS VARCHAR) AS "리뷰_id", 'review ' || conv_id AS "리뷰_내용", CAST(NULL AS VARCHAR) AS "리뷰_작성_일시",
        'author ' || conv_id % 11 AS "작성자명", CAST(conv_id % 97 AS VARCHAR) AS "상품_내부_id", CASE WHEN conv_id % 2 = 0 THEN 'true' ELSE 'false' END AS "리뷰_노출_여부",
        'r' || conv_id % 97 AS "상품_노출_id", CAST(NULL AS VARCHAR) AS "상품명", CASE WHEN conv_id % 3 = 0 THEN CAST(conv_id % 5 AS VARCHAR) END AS "그룹_id",
        CASE WHEN conv_id % 3 = 0 THEN 'group ' || conv_id % 5 END AS "그룹명", """
        + ", ".join(f'max(q) FILTER (k = {k}) AS "고객정보_정보명{k}", max(a) FILTER (k = {k}) AS "고객정보_답변값{k}"' for k in range(1, 11))
        + " FROM qa GROUP BY conv_id",
    ),
    "stream_ingest": INGESTED,
    "stream_ingest_pages": sql(
        PI,
        """repeated AS (SELECT term, page, row_number() OVER (PARTITION BY term, fingerprint ORDER BY page) AS seen FROM pg),
stops AS (SELECT term, min(page) AS stop FROM repeated WHERE seen > 1 GROUP BY term),
used AS (SELECT DISTINCT id FROM pi LEFT JOIN stops USING (term) WHERE stop IS NULL OR page < stop)""",
        """SELECT CAST(id AS VARCHAR) AS "리뷰_id", 'v=' || value AS "리뷰_내용", strftime(ts, '%Y-%m-%d %H:%M:%S') AS "리뷰_작성_일시",
        CAST(id % 97 AS VARCHAR) AS "상품_id" FROM used JOIN events ON event_id = id""",
    ),
    "stream_interval_stats": sql(
        TL,
        INFERRED,
        f"""w AS (SELECT day, count(*) AS event_count, max(timestamp) AS last_timestamp FROM ev GROUP BY day),
st AS (SELECT day, {STATS} FROM inferred GROUP BY day)""",
        "SELECT w.event_count, w.last_timestamp, w.day, st.* EXCLUDE (day) FROM w LEFT JOIN st ON st.day = w.day",
    ),
}
