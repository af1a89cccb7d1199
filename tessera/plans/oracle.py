"""DuckDB SQL twins of the fixtures, used as an independent oracle.

Each function returns CTE text (``name AS (...)``) over the tables
registered as views (documents, events, part, ...). The rules are the same
as in ``tessera.sources.fixtures``; the SQL is written from those rules,
not generated from the Spark plan.
"""

from __future__ import annotations

# Fixed values of the inputs, stated here once more: an oracle that took them
# from the code it checks would take its mistakes along.
ACCESS_LOG_PATTERN_ORIGINAL = r'^(\S+) (\S+) (\S+) \[([\w:/]+\s[+\-]\d{4})\] "(\S+) (\S+)\s*(\S*)" (\d{3}) (\S+)'
ACCESS_LOG_PATTERN = r'^(\S+) (\S+) (\S+) \[([\w:/]+\s[+\-]\d{4})\] "(\S+) (\S+)\s*(\S*)\s*" (\d{3}) (\S+)'
DATAFILE_PATTERN = r'^(.+),"(.+)",(.*),(.*),(.*)'
GOLDFILE_PATTERN = r"^(.+),(.+)"
DATAFILE_HEADER_FIELD = '"id"'
GOLDFILE_HEADER_FIELD = '"idAmazon"'
PRODUCT_HEADER = '"id","title","description","manufacturer","price"'
GOLD_HEADER = '"idAmazon","idGoogle"'
STOPWORDS = (
    "a an and are as at be being by for from in is it of on or over that the this to was were why with"
).split()

STOP_LIST = "[" + ", ".join(f"'{w}'" for w in STOPWORDS) + "]"


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def simple_tokens(expr: str) -> str:
    return (
        f"list_filter(list_transform(regexp_split_to_array({expr}, '\\W+'), "
        f"lambda x: lower(x)), lambda x: x <> '')"
    )


def tokens(expr: str) -> str:
    return f"list_filter({simple_tokens(expr)}, lambda x: NOT list_contains({STOP_LIST}, x))"


def clean(expr: str) -> str:
    return f"trim(regexp_replace(lower({expr}), '[^a-zA-Z0-9 ]', '', 'g'))"


def div0(num: str, den: str) -> str:
    """Double division, NULL when the divisor is zero (Spark's try_divide)."""
    return f"(CAST({num} AS DOUBLE) / NULLIF(CAST({den} AS DOUBLE), 0))"


DOC_LINES = """doc_lines AS (
  SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, line FROM (
    SELECT doc_id, unnest(range(len(arr))) AS line_no, unnest(arr) AS line
    FROM (SELECT doc_id, string_split(text, chr(10)) AS arr FROM documents)))"""

ALL_WORDS = f"""all_words AS (
  SELECT unnest(string_split({clean('line')}, ' ')) AS word FROM doc_lines)"""

WORDS = """words AS (SELECT word FROM all_words WHERE word <> '')"""

WORD_COUNTS = """word_counts AS (SELECT word, count(*) AS "count" FROM words GROUP BY word)"""

CLF_LINES = """clf_lines AS (
  SELECT event_id AS line_id,
    'u' || CAST(user_id AS VARCHAR) || ' - - [' || strftime(ts, '%d/%b/%Y:%H:%M:%S')
    || ' -0400] "GET /' || event_type || '/' || CAST(event_id % 50 AS VARCHAR) || ' HTTP/1.0'
    || CASE WHEN event_id % 7 = 0 THEN ' ' ELSE '' END || '" '
    || CASE WHEN event_type = 'error' THEN '404' ELSE '200' END || ' '
    || CASE WHEN event_id % 11 = 0 THEN '-' ELSE CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) END
    AS value
  FROM events
  UNION ALL
  SELECT -event_id - 1 AS line_id, 'junk line ' || CAST(event_id AS VARCHAR) AS value
  FROM events WHERE event_id % 97 = 0)"""


def _g(i: int, pattern: str = ACCESS_LOG_PATTERN) -> str:
    return f"CASE WHEN ok THEN regexp_extract(value, {q(pattern)}, {i}) END"


PARSED = f"""parsed AS (
  SELECT line_id, value,
    {_g(1)} AS host, {_g(2)} AS client_identd, {_g(3)} AS user_id,
    CAST(try_strptime(substr({_g(4)}, 1, 20), '%d/%b/%Y:%H:%M:%S') AS TIMESTAMP) AS date_time,
    {_g(5)} AS method, {_g(6)} AS endpoint, {_g(7)} AS protocol,
    CAST({_g(8)} AS INTEGER) AS response_code,
    CASE WHEN {_g(9)} = '-' THEN CAST(0 AS BIGINT) ELSE TRY_CAST({_g(9)} AS BIGINT) END AS content_size,
    ok AS parse_ok
  FROM (SELECT *, coalesce(regexp_matches(value, {q(ACCESS_LOG_PATTERN)}), false) AS ok FROM clf_lines))"""

ACCESS = """access AS (SELECT * FROM parsed WHERE parse_ok)"""

LOG = [CLF_LINES, PARSED, ACCESS]

PRODUCT_LINES = f"""product_lines AS (
  SELECT CAST(-1 AS BIGINT) AS line_id, {q(PRODUCT_HEADER)} AS value
  UNION ALL
  SELECT p_partkey AS line_id,
    '"' || CAST(p_partkey AS VARCHAR) || '","' || p_name || '","' || p_type || '","' || p_brand
    || '",' || CAST(p_retailprice AS VARCHAR) AS value
  FROM part)"""


def _dp(i: int) -> str:
    return f"regexp_extract(value, {q(DATAFILE_PATTERN)}, {i})"


PRODUCTS = f"""products AS (
  SELECT CASE WHEN st = 1 THEN replace({_dp(1)}, '"', '') END AS id,
    CASE WHEN st = 1 THEN concat_ws(' ', {_dp(2)}, {_dp(3)}, {_dp(4)}) END AS value,
    st AS parse_status
  FROM (SELECT value, CASE WHEN NOT coalesce(regexp_matches(value, {q(DATAFILE_PATTERN)}), false) THEN -1
                      WHEN {_dp(1)} = {q(DATAFILE_HEADER_FIELD)} THEN 0 ELSE 1 END AS st
        FROM product_lines))"""

RECORDS = f"""rec_a AS (SELECT doc_id AS id, text AS value FROM documents),
rec_b AS (SELECT item_id AS id, text AS value FROM benchmark),
tok_a AS (SELECT id, {tokens('value')} AS tokens FROM rec_a),
tok_b AS (SELECT id, {tokens('value')} AS tokens FROM rec_b)"""

TF = """tf_a AS (
  SELECT id, token, count(*) AS n, count(*) / n_tokens AS tf
  FROM (SELECT id, len(tokens) AS n_tokens, unnest(tokens) AS token FROM tok_a)
  GROUP BY id, token, n_tokens),
tf_b AS (
  SELECT id, token, count(*) AS n, count(*) / n_tokens AS tf
  FROM (SELECT id, len(tokens) AS n_tokens, unnest(tokens) AS token FROM tok_b)
  GROUP BY id, token, n_tokens)"""

IDF = """idf AS (
  SELECT token, count(*) AS df,
    ((SELECT count(DISTINCT id) FROM rec_a) + (SELECT count(DISTINCT id) FROM rec_b)) / count(*) AS idf
  FROM (SELECT token FROM tf_a UNION ALL SELECT token FROM tf_b)
  GROUP BY token)"""

WEIGHTS = """w_a AS (SELECT t.id, t.token, t.tf * i.idf AS weight FROM tf_a t JOIN idf i ON t.token = i.token),
w_b AS (SELECT t.id, t.token, t.tf * i.idf AS weight FROM tf_b t JOIN idf i ON t.token = i.token),
u_a AS (SELECT id, token, weight, weight / sqrt(sum(weight * weight) OVER (PARTITION BY id)) AS unit FROM w_a),
u_b AS (SELECT id, token, weight, weight / sqrt(sum(weight * weight) OVER (PARTITION BY id)) AS unit FROM w_b)"""

SIMS = """sims AS (
  SELECT a.id AS a_id, b.id AS b_id, sum(a.unit * b.unit) AS similarity
  FROM u_a a JOIN u_b b ON a.token = b.token
  GROUP BY a.id, b.id)"""

GOLD = f"""tt_a AS (SELECT id, ' ' || array_to_string({simple_tokens('value')}, ' ') || ' ' AS t FROM rec_a),
tt_b AS (SELECT id, ' ' || array_to_string({simple_tokens('value')}, ' ') || ' ' AS t,
                len({simple_tokens('value')}) AS nt FROM rec_b),
gold AS (SELECT a.id AS a_id, b.id AS b_id FROM tt_a a JOIN tt_b b ON contains(a.t, b.t) WHERE b.nt > 0)"""

GOLD_SIMS = """gs AS (
  SELECT g.a_id, g.b_id, coalesce(s.similarity, 0.0) AS similarity
  FROM gold g LEFT JOIN sims s ON g.a_id = s.a_id AND g.b_id = s.b_id)"""

ER = [RECORDS, TF, IDF, WEIGHTS, SIMS]
ER_GOLD = ER + [GOLD, GOLD_SIMS]

GOLD_LINES = f"""gold_lines AS (
  SELECT 'header' AS line_id, {q(GOLD_HEADER)} AS value
  UNION ALL
  SELECT CAST(a_id AS VARCHAR) || '-' || CAST(b_id AS VARCHAR) AS line_id,
    '"' || CAST(a_id AS VARCHAR) || '","' || CAST(b_id AS VARCHAR) || '"' AS value FROM gold)"""

RATINGS = """ratings AS (
  SELECT o.o_custkey AS user_id, l.l_partkey AS item_id, max(l.l_quantity % 5 + 1) AS rating
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  GROUP BY o.o_custkey, l.l_partkey),
movies AS (SELECT p_partkey AS item_id, p_name AS title FROM part)"""

SPLITS = """bucketed AS (SELECT *, ((user_id % 10 + 10) % 10 * 31 + (item_id % 10 + 10) % 10 * 17) % 10 AS bucket FROM ratings),
train AS (SELECT user_id, item_id, rating FROM bucketed WHERE bucket < 6),
validation AS (SELECT user_id, item_id, rating FROM bucketed WHERE bucket IN (6, 7)),
test AS (SELECT user_id, item_id, rating FROM bucketed WHERE bucket >= 8),
shared AS (SELECT t.* FROM test t WHERE user_id IN (SELECT user_id FROM train) AND item_id IN (SELECT item_id FROM train))"""


def with_(ctes: list[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


__all__ = [
    "ACCESS_LOG_PATTERN", "ACCESS_LOG_PATTERN_ORIGINAL", "GOLDFILE_HEADER_FIELD", "GOLDFILE_PATTERN", "STOP_LIST", "q", "clean", "tokens",
    "simple_tokens", "div0", "with_",
]
