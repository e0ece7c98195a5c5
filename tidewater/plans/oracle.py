"""DuckDB SQL twins of the driver catalogue (same column names and types).

Written independently of the Spark plans: plain SQL over the driver
tables, brute force where that is the clearest statement of the result
(for example the Jaccard join is an inverted-index self-join with no
prefix filter). Regexes use RE2 spellings of the Java patterns
(``\\p{Han}`` for ``\\p{IsHan}``).
"""

from __future__ import annotations

# ---------------------------------------------------------------- shared fragments

TOKP = r"[\p{Han}]+|[\p{Hiragana}]+|[\p{Katakana}]+|[A-Za-z0-9]+"


def N(x: str) -> str:
    """Key normaliser (documents hold no text that NFKC changes)."""
    return rf"regexp_replace(lower(coalesce({x}, '')), '\s+', '', 'g')"


def two_dp(x: str) -> str:
    return f"(({x}) // 100)::VARCHAR || '.' || lpad((({x}) % 100)::VARCHAR, 2, '0')"


DOCS = f"""d AS (
  SELECT doc_id, text, n_chars, coalesce(TRY_CAST(substr(source, 4) AS INTEGER) % 2 = 0, false) AS cur,
         {N('text')} AS k
  FROM documents)"""

UNMATCHED = """um AS (
  SELECT c.* FROM d c
  WHERE NOT EXISTS (SELECT 1 FROM d o WHERE o.cur <> c.cur AND o.k <> '' AND o.k = c.k))"""

JACCARD = f"""WITH {DOCS}, {UNMATCHED},
sets AS (
  SELECT cur, toks, min(doc_id) AS rep, count(*) AS cnt
  FROM (SELECT cur, doc_id, list_sort(list_distinct(regexp_extract_all(text, '{TOKP}'))) AS toks FROM um)
  WHERE len(toks) > 0 GROUP BY cur, toks),
t AS (SELECT cur, rep, len(toks) AS n, unnest(toks) AS tok FROM sets),
ov AS (
  SELECT a.rep AS v2_id, b.rep AS lg_id, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS inter
  FROM t a JOIN t b ON a.tok = b.tok WHERE a.cur AND NOT b.cur GROUP BY a.rep, b.rep),
j AS (
  SELECT ov.v2_id, ov.lg_id, sa.cnt AS n_left, sb.cnt AS n_right, inter, na + nb - inter AS uni,
         1.0::DOUBLE - inter::DOUBLE / (na + nb - inter)::DOUBLE AS jaccard_dist
  FROM ov JOIN sets sa ON sa.cur AND sa.rep = ov.v2_id
          JOIN sets sb ON NOT sb.cur AND sb.rep = ov.lg_id)
"""
JACCARD_PAIRS = JACCARD + ", jp AS (SELECT * FROM j WHERE jaccard_dist < 0.5)\n"

MINHASH_PRIME = 2**31 - 1
LSH_BANDS, LSH_ROWS = 20, 3


def _least(j: int) -> str:
    """Least value of hash function j over the token numbers ``x``."""
    a, b = pow(48271, j + 1, MINHASH_PRIME), pow(69621, j + 1, MINHASH_PRIME)
    return f"list_min(list_transform(x, lambda v: (v * {a} + {b}) % {MINHASH_PRIME}))"


LSH = JACCARD + """, xs AS (
  SELECT cur, rep, list_transform(toks, lambda t: CAST('0x' || substr(md5(t), 1, 7) AS BIGINT)) AS x FROM sets),
""" + "bands AS (" + "\nUNION ALL ".join(
    f"SELECT cur, rep, {i} AS band, [" + ", ".join(_least(i * LSH_ROWS + r) for r in range(LSH_ROWS)) + "] AS bh FROM xs"
    for i in range(LSH_BANDS)) + """),
met AS (SELECT DISTINCT a.rep AS v2_id, b.rep AS lg_id FROM bands a JOIN bands b
        ON a.band = b.band AND a.bh = b.bh AND a.cur AND NOT b.cur)
SELECT j.v2_id, j.lg_id, j.n_left, j.n_right, j.jaccard_dist FROM j JOIN met USING (v2_id, lg_id)
WHERE j.jaccard_dist < 0.5"""

LEGACY = f"""lg AS (
  SELECT CAST(p_partkey AS VARCHAR) AS fund_id,
         CASE WHEN p_size < 25 THEN 'INDEX' ELSE 'ACTIVE' END AS "投資信託_分類",
         {two_dp('p_size')} AS "信託報酬_率",
         CASE WHEN p_size % 3 = 0 THEN 'True' WHEN p_size % 3 = 1 THEN 'False' ELSE 'unknown' END AS "有効レコード",
         p_name AS "ファンド名", p_type AS "愛称", p_brand AS "運用会社",
         {two_dp('p_partkey % 1000')} AS "隠れコスト",
         'STRAT-' || upper(substr(p_type, 1, 3)) || '-' || lpad((p_partkey % 100)::VARCHAR, 2, '0') AS "内部戦略コード"
  FROM part)"""

LEGACY_EN = """SELECT fund_id, "投資信託_分類" AS fund_category, "信託報酬_率" AS trust_fee_rate,
       "有効レコード" AS is_active, "ファンド名" AS fund_name, "愛称" AS alias_name,
       "運用会社" AS management_company, "隠れコスト" AS hidden_cost,
       "内部戦略コード" AS internal_strategy_code FROM lg"""

LEGACY_TYPED = f"""WITH {LEGACY}, en AS ({LEGACY_EN})
SELECT fund_id, fund_category, CAST(trust_fee_rate AS DECIMAL(5,2)) AS trust_fee_rate,
       CASE WHEN is_active = 'True' THEN true WHEN is_active = 'False' THEN false
            ELSE TRY_CAST(is_active AS BOOLEAN) END AS is_active,
       fund_name, alias_name, management_company, CAST(hidden_cost AS DECIMAL(5,2)) AS hidden_cost,
       internal_strategy_code FROM en"""

MONTHS = "strftime(o_orderdate, '%Y-%m')"
RELOAD = "o_orderdate >= TIMESTAMP '1998-01-01 00:00:00'"

DAILY = """daily AS (
  SELECT o_custkey, CAST(o_orderdate AS DATE) AS base_date,
         arg_max(o_orderpriority, o_orderkey) AS o_orderpriority,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18,4))) AS DECIMAL(18,4)) AS nav
  FROM orders GROUP BY 1, 2)"""

SCD2 = """chg AS (
  SELECT *, lag(o_orderpriority) OVER (PARTITION BY o_custkey ORDER BY base_date) AS prev,
            row_number() OVER (PARTITION BY o_custkey ORDER BY base_date) AS rn
  FROM daily),
keep AS (SELECT * FROM chg WHERE rn = 1 OR prev IS DISTINCT FROM o_orderpriority),
scd AS (
  SELECT o_custkey, o_orderpriority, base_date AS effective_start_date,
         COALESCE(CAST(lead(base_date) OVER w - INTERVAL 1 DAY AS DATE), DATE '9999-12-31') AS effective_end_date,
         lead(base_date) OVER w IS NULL AS current_flag
  FROM keep WINDOW w AS (PARTITION BY o_custkey ORDER BY base_date))"""

NAV = """navc AS (
  SELECT o_custkey, base_date, nav,
         CAST(nav - lag(nav) OVER w AS DECIMAL(18,4)) AS price_change,
         round(CAST(nav - lag(nav) OVER w AS DOUBLE) / CAST(lag(nav) OVER w AS DOUBLE) * 100.0::DOUBLE, 6)
           AS price_change_rate_pct
  FROM daily WINDOW w AS (PARTITION BY o_custkey ORDER BY base_date))"""

FUND_SK = ("CAST('0x' || substr(md5(s.o_custkey::VARCHAR || '|' || strftime(s.effective_start_date, '%Y-%m-%d')), 1, 15)"
           " AS BIGINT)")

CALENDAR = """b AS (SELECT CAST(min(o_orderdate) AS DATE) AS d0, CAST(max(o_orderdate) AS DATE) AS d1 FROM orders),
cal AS (
  SELECT CAST(strftime(date_value, '%Y%m%d') AS INTEGER) AS date_sk, date_value,
         CAST(year(date_value) AS INTEGER) AS year, CAST(month(date_value) AS INTEGER) AS month,
         CAST(day(date_value) AS INTEGER) AS day, CAST(isodow(date_value) AS INTEGER) AS day_of_week,
         isodow(date_value) >= 6 AS is_weekend, last_day(date_value) = date_value AS is_month_end,
         strftime(date_value, '%Y%m') AS year_month,
         CAST(year(date_value - INTERVAL 3 MONTH) AS INTEGER) AS fiscal_year
  FROM (SELECT CAST(unnest(generate_series(d0, d1, INTERVAL 1 DAY)) AS DATE) AS date_value FROM b))"""

QTEXT = """CASE event_type
  WHEN 'view' THEN 'SELECT * FROM "Sales".orders_' || (user_id % 5)::VARCHAR || ' o JOIN `lake`.`gold`.dim_'
       || (user_id % 3)::VARCHAR || ' d ON o.k = d.k JOIN sales.orders_' || (user_id % 5)::VARCHAR || ' o2 ON o2.k = o.k'
  WHEN 'click' THEN 'select count(*) from information_schema.tables t join web.clicks c on t.x = c.x'
  WHEN 'purchase' THEN 'SELECT x FROM unnest(array[1,2]) AS u(x) JOIN (SELECT 1 FROM shop.purchases_'
       || (user_id % 3)::VARCHAR || ') p ON true'
  WHEN 'signup' THEN 'WITH a AS (SELECT 1) SELECT * FROM a JOIN json_table(doc) j ON 1=1 JOIN "crm"."users" u ON u.id = '
       || user_id::VARCHAR
  ELSE NULL END"""

TABLE_REF = r"""\b(?:from|join)\s+((?:[`"]?[a-z0-9_$]+[`"]?)(?:\.(?:[`"]?[a-z0-9_$]+[`"]?)){0,2})"""


def refs_report(source: str) -> str:
    return f"""WITH q AS ({source}),
r AS (SELECT qid, split_part(submitted, 'T', 1) AS day,
             unnest(regexp_extract_all(lower(query), '{TABLE_REF}', 1)) AS raw
      FROM q WHERE query IS NOT NULL),
f AS (SELECT DISTINCT qid, regexp_replace(raw, '[`"]', '', 'g') AS t, day FROM r
      WHERE NOT starts_with(raw, 'unnest') AND NOT starts_with(raw, 'json_table')
        AND NOT regexp_matches(raw, '^("?information_schema"?|"?sys"?|"?pg_catalog"?)\\.')),
g AS (SELECT DISTINCT qid, CASE WHEN len(string_split(t, '.')) = 3
                     THEN string_split(t, '.')[2] || '.' || string_split(t, '.')[3] ELSE t END AS tbl, day FROM f)
SELECT tbl, day, count(*) AS n FROM g GROUP BY tbl, day"""


QLOG = f"""SELECT 'q' || event_id::VARCHAR AS qid, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS submitted,
       {QTEXT} AS query FROM events"""

AUDIT = """WITH e AS (
  SELECT *, (['ap-northeast-1', 'us-east-1', 'us-west-2', 'eu-west-1'])[user_id % 4 + 1] AS region FROM events),
r AS (
  SELECT e.*, 'arn:aws:s3:::data/' || event_id::VARCHAR AS resource_arn, 'AWS::S3::Object' AS resource_type
  FROM e WHERE event_type <> 'error'
  UNION ALL
  SELECT e.*, 'arn:aws:kms:key/' || user_id::VARCHAR, 'AWS::KMS::Key' FROM e WHERE event_type <> 'error' AND value > 20
  UNION ALL
  SELECT e.*, NULL, NULL FROM e WHERE event_type = 'error')
SELECT event_id::VARCHAR AS eventid, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS eventtime, event_type AS eventname,
       region AS awsregion, 'IAMUser' AS identity_type, user_id::VARCHAR AS principal_id,
       'role-' || event_type AS issuer_user, CASE WHEN user_id % 2 = 0 THEN 'true' ELSE 'false' END AS mfa,
       region, strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day,
       resource_arn, resource_type
FROM r"""

EMAIL_RE = r"([A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,})"
STRAT_RE = r"(STRAT-[A-Z]{3}-[0-9]{2})"
TOKEN_RE = r"([0-9a-f]{40})"


def near_hits(value: str, regex: str, keywords: list[str], distance: int = 300) -> str:
    """Matches with a keyword ending at most ``distance`` characters before
    them: the text before match i is put together from the pieces between the
    matches, and its tail searched for a keyword (no look-behind in RE2)."""
    bare = regex.strip("()")
    before = f"array_to_string(list_zip_text[1:2 * i - 1], '')"
    tests = " OR ".join(f"contains(lower(right({before}, {distance + len(k)})), '{k}')" for k in keywords)
    return f"""(SELECT count(*) FROM (
        SELECT unnest(range(1, len(m) + 1)) AS i, list_zip_text FROM (
          SELECT m, flatten(list_transform(range(1, len(p) + 1), lambda k: [p[k], coalesce(m[k], '')])) AS list_zip_text
          FROM (SELECT regexp_extract_all({value}, '{bare}') AS m, regexp_split_to_array({value}, '{bare}') AS p)))
      WHERE {tests})"""


def cell_hits(cells: str) -> str:
    return f"""h AS (
  SELECT object, row, "column", columnName, 'email-address' AS detector,
         len(regexp_extract_all(value, '{EMAIL_RE}', 1)) AS hits FROM {cells}
  UNION ALL
  SELECT object, row, "column", columnName, 'strategy-code-detector',
         CASE WHEN lower(columnName) IN ('内部戦略コード', '戦略コード')
              THEN len(regexp_extract_all(value, '{STRAT_RE}', 1))
              ELSE {near_hits('value', STRAT_RE, ['内部戦略コード', '戦略コード'])} END FROM {cells}
  UNION ALL
  SELECT object, row, "column", columnName, 'secret-token',
         CASE WHEN lower(columnName) IN ('token')
              THEN len(regexp_extract_all(value, '{TOKEN_RE}', 1))
              ELSE {near_hits('value', TOKEN_RE, ['token'])} END FROM {cells})"""


DOC_CELLS = """dc AS (
  SELECT 'documents' AS object, CAST(doc_id AS VARCHAR) AS row, c.pos AS "column", c.name AS columnName,
         CASE c.name WHEN 'doc_id' THEN CAST(doc_id AS VARCHAR) WHEN 'text' THEN text WHEN 'lang' THEN lang
                     WHEN 'source' THEN source ELSE CAST(n_chars AS VARCHAR) END AS value
  FROM documents CROSS JOIN (VALUES ('doc_id', 1), ('text', 2), ('lang', 3), ('source', 4), ('n_chars', 5)) AS c(name, pos))"""

LEGACY_CELLS = f"""{LEGACY},
lc AS (
  SELECT 'legacy_fund_master' AS object, fund_id AS row, c.pos AS "column", c.name AS columnName,
         CASE c.name WHEN 'fund_id' THEN fund_id WHEN '投資信託_分類' THEN "投資信託_分類" WHEN '信託報酬_率' THEN "信託報酬_率"
                     WHEN '有効レコード' THEN "有効レコード" WHEN 'ファンド名' THEN "ファンド名"
                     WHEN '愛称' THEN "愛称" WHEN '運用会社' THEN "運用会社"
                     WHEN '隠れコスト' THEN "隠れコスト" ELSE "内部戦略コード" END AS value
  FROM lg CROSS JOIN (VALUES ('fund_id', 1), ('投資信託_分類', 2), ('信託報酬_率', 3), ('有効レコード', 4), ('ファンド名', 5),
                             ('愛称', 6), ('運用会社', 7), ('隠れコスト', 8), ('内部戦略コード', 9)) AS c(name, pos))"""


ORACLE: dict[str, str] = {
    # scans
    "scan_csv": "SELECT * FROM orders",
    "scan_nav_csv": """SELECT CAST(o_custkey AS VARCHAR) AS fund_id, CAST(o_orderdate AS DATE) AS base_date,
                              CAST(o_totalprice AS DECIMAL(18,4)) AS nav_price FROM orders""",
    "scan_legacy_csv": f"WITH {LEGACY} SELECT * FROM lg",
    "rename_map": f"WITH {LEGACY} {LEGACY_EN}",
    "canonicalize_columns": f"""WITH {LEGACY}
SELECT fund_id, "投資信託_分類" AS fund_category, "信託報酬_率" AS trust_fee_rate, "有効レコード" AS valid_flag,
       "ファンド名" AS fund_name, "愛称" AS nickname, "運用会社" AS management_company,
       "隠れコスト" AS hidden_cost, "内部戦略コード" FROM lg""",
    "decimal_cast": f"""WITH {LEGACY}, en AS ({LEGACY_EN})
SELECT fund_id, fund_category, CAST(trust_fee_rate AS DECIMAL(5,2)) AS trust_fee_rate, is_active,
       fund_name, alias_name, management_company, CAST(hidden_cost AS DECIMAL(5,2)) AS hidden_cost,
       internal_strategy_code FROM en""",
    "bool_normalize": LEGACY_TYPED,
    "ingest_snapshot": f"SELECT *, DATE '2025-07-01' AS ingest_date FROM ({LEGACY_TYPED})",
    "routed_ingest": f"SELECT *, DATE '2025-07-01' AS ingest_date FROM ({LEGACY_TYPED})",
    "watermark_extract": "SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '1998-08-01 00:00:00'",
    # sinks
    "partition_overwrite": f"""SELECT *, {MONTHS} AS o_month, CASE WHEN {RELOAD} THEN 2 ELSE 1 END AS load_id
                               FROM orders""",
    "full_overwrite": f"SELECT *, {MONTHS} AS o_month, 2 AS load_id FROM orders WHERE {RELOAD}",
    "replace_table": f"""SELECT {MONTHS} AS o_month, count(*) AS n_orders,
                                CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total
                         FROM orders GROUP BY 1""",
    "union_snapshots": f"""SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, DATE '2025-06-30' AS ingest_date
                           FROM orders
                           UNION ALL
                           SELECT o_orderkey, o_custkey, 'F', o_totalprice, DATE '2025-07-01' FROM orders
                           WHERE {RELOAD}""",
    "latest_snapshot": f"""SELECT o_orderkey, o_custkey, CASE WHEN {RELOAD} THEN 'F' ELSE o_orderstatus END AS o_orderstatus,
                                  o_totalprice,
                                  CASE WHEN {RELOAD} THEN DATE '2025-07-01' ELSE DATE '2025-06-30' END AS ingest_date
                           FROM orders""",
    "write_audit_publish": f"""SELECT *, {MONTHS} AS o_month, CASE WHEN {RELOAD} THEN 2 ELSE 1 END AS load_id
                               FROM orders""",
    "compact_flow_logs": """SELECT strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day,
       strftime(ts, '%H') AS hour, count(*) AS flows, CAST(sum(CAST(round(value * 100, 0) AS BIGINT)) AS BIGINT) AS bytes
FROM events WHERE strftime(ts, '%H') BETWEEN '09' AND '17' GROUP BY 1, 2, 3, 4""",
    "compact_partitions": f"SELECT *, {MONTHS} AS o_month, 1 AS load_id FROM orders",
    # text
    "normalize_key": f"SELECT doc_id, md5({N('text')}) AS key_md5 FROM documents",
    "det_key": f"""SELECT p_partkey, concat_ws('_', {N('p_name')}, {N('p_brand')}, {N('p_type')}) AS det_key
                   FROM part""",
    "text_features": f"""SELECT p_partkey, concat_ws(' ', {N('p_name')}, {N('p_brand')}, {N('p_type')}) AS text
                         FROM part""",
    "tokenize": f"""SELECT doc_id, len(t) AS n_tokens, len(list_distinct(t)) AS n_distinct,
                           md5(array_to_string(t, ' ')) AS tokens_md5
                    FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{TOKP}') AS t FROM documents)""",
    # matching
    "exact_match_pairs": f"""WITH {DOCS},
lgk AS (SELECT sha256(k) AS key_sha256, min(doc_id) AS lg_id, count(*) AS n_right
        FROM d WHERE NOT cur AND k <> '' GROUP BY 1)
SELECT d.doc_id AS v2_id, lgk.lg_id, lgk.n_right, lgk.key_sha256
FROM d JOIN lgk ON sha256(d.k) = lgk.key_sha256 WHERE d.cur AND d.k <> ''""",
    "unmatched_left": f"WITH {DOCS}, {UNMATCHED} SELECT doc_id FROM um WHERE cur",
    "unmatched_right": f"WITH {DOCS}, {UNMATCHED} SELECT doc_id FROM um WHERE NOT cur",
    "load_counts": f"""WITH {DOCS}
SELECT 'current' AS side, count(*) AS n_rows FROM d WHERE cur
UNION ALL SELECT 'legacy', count(*) FROM d WHERE NOT cur""",
    "exact_match_members": f"""WITH {DOCS}
SELECT sha256(k) AS key_sha256, CASE WHEN cur THEN 0 ELSE 1 END AS side, doc_id AS id FROM d
WHERE k <> '' AND k IN (SELECT k FROM d WHERE cur) AND k IN (SELECT k FROM d WHERE NOT cur)""",
    "jaccard_members": f"""WITH {DOCS}, {UNMATCHED},
t AS (SELECT cur, doc_id, list_sort(list_distinct(regexp_extract_all(text, '{TOKP}'))) AS toks FROM um)
SELECT CASE WHEN cur THEN 0 ELSE 1 END AS side, min(doc_id) OVER (PARTITION BY cur, toks) AS rep, doc_id AS id
FROM t WHERE len(toks) > 0""",
    "match_job": JACCARD_PAIRS + """, lgk AS (SELECT k, min(doc_id) AS lg_id FROM d WHERE NOT cur AND k <> '' GROUP BY 1)
SELECT d.doc_id AS v2_id, lgk.lg_id, 'exact' AS kind, 0.0::DOUBLE AS jaccard_dist, NULL::BIGINT AS fee_diff
FROM d JOIN lgk ON d.k = lgk.k WHERE d.cur
UNION ALL
SELECT jp.v2_id, jp.lg_id, 'similar', jp.jaccard_dist, CAST(abs(a.n_chars - b.n_chars) AS BIGINT)
FROM jp JOIN documents a ON a.doc_id = jp.v2_id JOIN documents b ON b.doc_id = jp.lg_id""",
    "lsh_similarity_join": LSH,
    "jaccard_join": JACCARD_PAIRS + "SELECT * FROM jp",
    "fee_diff": JACCARD_PAIRS + """SELECT jp.v2_id, jp.lg_id, jp.jaccard_dist, abs(a.n_chars - b.n_chars) AS fee_diff
FROM jp JOIN documents a ON a.doc_id = jp.v2_id JOIN documents b ON b.doc_id = jp.lg_id""",
    "distance_summary": JACCARD_PAIRS + """, w AS (SELECT n_left * n_right AS m, jaccard_dist AS x FROM jp)
SELECT CAST(coalesce(sum(m), 0) AS BIGINT) AS n, round(sum(m * x) / sum(m), 6) AS mean,
       CASE WHEN sum(m) > 1 THEN round(sqrt(greatest(0.0::DOUBLE, sum(m * x * x) - sum(m * x) * sum(m * x) / sum(m)) / (sum(m) - 1)), 6)
       END AS stddev, min(x) AS min, max(x) AS max FROM w""",
    "match_preview": JACCARD_PAIRS + "SELECT * FROM jp ORDER BY jaccard_dist, v2_id, lg_id LIMIT 10",
    # gold
    "scd2_dimension": f"WITH {DAILY}, {SCD2} SELECT * FROM scd",
    "scd2_refresh": f"WITH {DAILY}, {SCD2} SELECT * FROM scd",
    "nav_change": f"WITH {DAILY}, {NAV} SELECT * FROM navc",
    "dim_date": f"WITH {CALENDAR} SELECT * FROM cal",
    "fact_performance": f"""WITH {DAILY}, {SCD2}, {NAV}, {CALENDAR}
SELECT n.o_custkey, n.base_date, n.nav, n.price_change, n.price_change_rate_pct,
       s.effective_start_date, s.o_orderpriority, c.date_sk
FROM navc n JOIN scd s ON s.o_custkey = n.o_custkey
                      AND n.base_date BETWEEN s.effective_start_date AND s.effective_end_date
            LEFT JOIN cal c ON c.date_value = n.base_date""",
    "gold_dim_fund": f"""WITH {DAILY}, {SCD2}
SELECT *, {FUND_SK} AS fund_sk FROM scd s""",
    "gold_fact": f"""WITH {DAILY}, {SCD2},
fixed AS (SELECT o_custkey, base_date, CAST(CASE WHEN base_date >= DATE '1998-01-01' THEN nav - 1 ELSE nav END
                                             AS DECIMAL(18,4)) AS nav FROM daily),
{NAV.replace('FROM daily', 'FROM fixed')}, {CALENDAR}
SELECT n.o_custkey, n.base_date, n.nav, n.price_change, n.price_change_rate_pct,
       s.effective_start_date, {FUND_SK} AS fund_sk, c.date_sk
FROM navc n JOIN scd s ON s.o_custkey = n.o_custkey
                      AND n.base_date BETWEEN s.effective_start_date AND s.effective_end_date
            LEFT JOIN cal c ON c.date_value = n.base_date""",
    "daily_wide": f"""WITH {DAILY}
SELECT d.o_custkey, d.base_date, d.nav, c.c_name, c.c_mktsegment, c.c_nationkey
FROM daily d LEFT JOIN customer c ON c.c_custkey = d.o_custkey""",
    # logs
    "table_refs_daily": refs_report(QLOG),
    "table_refs_recent": refs_report(QLOG + " ORDER BY submitted DESC, qid DESC LIMIT 1000"),
    "audit_log_scan": AUDIT,
    "partition_projection": f"""SELECT * FROM ({AUDIT})
WHERE region IN ('us-east-1', 'eu-west-1')
  AND CAST(year || '-' || month || '-' || day AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-12'""",
    "flow_log_scan": """SELECT strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day,
       CASE WHEN event_type = 'error' THEN 'REJECT' ELSE 'ACCEPT' END AS action,
       count(*) AS flows,
       CAST(sum(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS packets,
       CAST(sum(CAST(round(value * 100, 0) AS BIGINT)) AS BIGINT) AS bytes
FROM events WHERE strftime(ts, '%H') BETWEEN '09' AND '17' GROUP BY 1, 2, 3, 4""",
    # sensitive scan
    "sensitive_scan": f"WITH {DOC_CELLS}, {cell_hits('dc')} SELECT * FROM h WHERE hits > 0",
    "sensitive_findings": f"""WITH {DOC_CELLS}, {LEGACY_CELLS}, cells AS (SELECT * FROM dc UNION ALL SELECT * FROM lc),
{cell_hits('cells')}
SELECT object, detector, "column", columnName, count(*) AS cells, CAST(sum(hits) AS BIGINT) AS hits
FROM h WHERE hits > 0 GROUP BY 1, 2, 3, 4""",
    "sensitive_totals": f"""WITH {DOC_CELLS}, {LEGACY_CELLS}, cells AS (SELECT * FROM dc UNION ALL SELECT * FROM lc),
{cell_hits('cells')}
SELECT object, CAST(sum(hits) AS BIGINT) AS total_count FROM h WHERE hits > 0 GROUP BY 1""",
    "finding_documents": f"""WITH {DOC_CELLS}, {LEGACY_CELLS}, cells AS (SELECT * FROM dc UNION ALL SELECT * FROM lc),
{cell_hits('cells')},
n AS (SELECT *, row_number() OVER (PARTITION BY object, detector
                                   ORDER BY TRY_CAST(row AS BIGINT) NULLS LAST, row, "column", columnName) - 1 AS rank,
             CAST(sum(hits) OVER (PARTITION BY object) AS BIGINT) AS total_count,
             CAST(sum(hits) OVER (PARTITION BY object, detector) AS BIGINT) AS "count",
             (count(*) OVER (PARTITION BY object, detector) + 99) // 100 AS n_chunks
      FROM h WHERE hits > 0)
SELECT object, detector, rank // 100 AS chunk, total_count, "count", n_chunks, count(*) AS n_cells,
       CAST(to_json(list(struct_pack("row" := row, "column" := "column", "columnName" := columnName) ORDER BY rank)) AS VARCHAR) AS cells
FROM n GROUP BY ALL""",
    "incremental_load": "SELECT *, strftime(o_orderdate, '%Y-%m') AS o_month FROM orders",
    "hashing_features": f"""WITH t AS (
  SELECT doc_id, CAST('0x' || substr(md5(tok), 1, 7) AS BIGINT) % 512 AS i
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '{TOKP}')) AS tok FROM documents)),
c AS (SELECT doc_id, i, count(*) AS n FROM t GROUP BY ALL)
SELECT d.doc_id, CAST(coalesce(sum(n), 0) AS BIGINT) AS n_tokens, count(i) AS n_indices,
       coalesce(string_agg(i || ':' || n, ' ' ORDER BY i), '') AS features
FROM documents d LEFT JOIN c ON d.doc_id = c.doc_id GROUP BY d.doc_id""",
    "sensitive_lines": f"""WITH {LEGACY_CELLS},
n AS (SELECT CAST(p_partkey AS VARCHAR) AS row, 'bucket=' || (p_partkey % 8) AS bucket,
             1 + row_number() OVER (PARTITION BY p_partkey % 8 ORDER BY p_partkey) AS line FROM part),
cells AS (SELECT * FROM lc), {cell_hits('cells')}
SELECT n.bucket AS object, n.line, "column", columnName, detector, hits FROM h JOIN n USING (row)
WHERE hits > 0 AND ('0x' || substr(md5(n.bucket), 1, 4))::INTEGER % 100 < 75""",
    "hash_sample": """SELECT doc_id, source, lang, n_chars FROM documents
WHERE ('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 4))::INTEGER % 100 < 75""",
}
