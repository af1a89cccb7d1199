"""The registered queries: one per operator, each with a DuckDB oracle.

Every query reads the whole driver tables (or what Spark derives from them)
and returns a DataFrame whose column names equal the oracle's. Floating
results are rounded to 6 decimals on both sides so that summation order
cannot change the comparison. Queries about fitted models return what must
hold whatever the fit (which ids have factors, which pairs are predicted).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import timedelta
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions.logs import day_of_month, hour_of_day, parse_apache_time
from tessera.functions.numeric import similarity_bin, squared_error
from tessera.functions.text import clean_text, remove_quotes, simple_tokenize, tokenize
from tessera.operators import basic, evaluation as ev, packed as pk, recommend as rc, similarity as sm
from tessera.operators import weblog as wl, wordcount as wc
from tessera.operators.frequent import frequent_top
from tessera.plans import oracle as o
from tessera.plans.stored import stored
from tessera.session import checkpoint_dir
from tessera.sources import fixtures as fx
from tessera.sources import parsers as ps
from tessera.sources.gzip_lines import read_gzip_lines
from tessera.sources.logstore import read_days, store_days
from tessera.sources.tables import Tables
from tessera.sources.text import document_lines, numbered_lines, read_file_lines, read_text_lines

# Parameters of the registered queries (the data has ~30 ratings per item).
TOP_RATED_MIN = 30
RECOMMEND_MIN = 25
FREQUENT_HOST_MIN = 10


def r6(c) -> F.Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def pairs6(c: str) -> F.Column:
    """``r6`` for scores of very many pairs, which are not negative: by
    arithmetic, for Spark's own rounding goes through decimal digits."""
    x = F.col(c)
    return F.when(x.between(0.0, 1e9), F.floor(x * 1e6 + 0.5) / 1e6).otherwise(r6(x)).alias(c)


class Ctx:
    """Shared lazy DataFrames of one data directory (plans, not data)."""

    def __init__(self, spark: SparkSession, data_dir: str):
        self.spark = spark
        self.t = Tables(spark, data_dir)

    @cached_property
    def lines(self) -> DataFrame:
        return fx.corpus_lines(self.t.documents)

    @cached_property
    def counts(self) -> DataFrame:
        return wc.word_count(wc.corpus_words(self.lines))

    @cached_property
    def clf(self) -> DataFrame:
        return fx.clf_lines(self.t.events)

    @cached_property
    def parsed(self) -> DataFrame:
        return ps.parse_access_log(self.clf)

    @cached_property
    def access(self) -> DataFrame:
        return ps.split_valid_failed(self.parsed)[0]

    @cached_property
    def a(self) -> DataFrame:
        return fx.records_a(self.t.documents)

    @cached_property
    def b(self) -> DataFrame:
        return fx.records_b(self.t.benchmark)

    @cached_property
    def tok_a(self) -> DataFrame:
        return sm.clustered_tokens(self.a)

    @cached_property
    def tok_b(self) -> DataFrame:
        return sm.clustered_tokens(self.b)

    @cached_property
    def tf_a(self) -> DataFrame:
        return sm.term_frequency_of(self.tok_a)

    @cached_property
    def tf_b(self) -> DataFrame:
        return sm.term_frequency_of(self.tok_b)

    @cached_property
    def idf(self) -> DataFrame:
        return sm.inverse_document_frequency([self.tok_a, self.tok_b])

    @cached_property
    def w_a(self) -> DataFrame:
        return sm.tfidf(self.tf_a, self.idf)

    @cached_property
    def w_b(self) -> DataFrame:
        return sm.tfidf(self.tf_b, self.idf)

    @cached_property
    def stored_weights(self) -> tuple[sm.Weights, sm.Weights, tuple[int, int] | None] | tuple[DataFrame, DataFrame, None]:
        """As ``paired``, for joins at several thresholds: a block join reads
        the weights once, token joins read stored ones."""
        w_a, w_b, blocks = self.paired
        if blocks:
            return w_a, w_b, blocks
        a, b = (stored(sm.long_form(w, "weight", "df_0", "df_1"), "weights") for w in (w_a, w_b))
        return a, b, None

    @cached_property
    def packed(self) -> tuple[sm.Packed, sm.Packed, DataFrame]:
        """Token counts of both sides in packed blocks, and the document
        frequencies, all stored: each record is tokenized once."""
        tok_a, tok_b = (pk.packed(sm.record_tokens(x), name) for x, name in ((self.a, "tokens-a"), (self.b, "tokens-b")))
        return tok_a, tok_b, stored(sm.inverse_document_frequency([tok_a, tok_b]), "idf")

    @cached_property
    def paired(self) -> tuple[sm.Weights, sm.Weights, tuple[int, int] | None]:
        """Weights of both sides, and the shape of a block join of all their
        pairs, which is measured before the join."""
        tok_a, tok_b, idf = self.packed
        blocks = sm.pair_blocks(idf, self.a, self.b)
        return sm.tfidf(sm.term_frequency_of(tok_a), idf), sm.tfidf(sm.term_frequency_of(tok_b), idf), blocks

    @cached_property
    def sims(self) -> DataFrame:
        w_a, w_b, blocks = self.paired
        return sm.similarities(w_a, w_b, blocks=blocks)

    @cached_property
    def gold(self) -> DataFrame:
        """Stored: evaluations read it several times, and Spark knows its size,
        so a small one is broadcast to the scored pairs as they are made."""
        return stored(fx.gold_pairs(self.a, self.b), "gold")

    @cached_property
    def ratings(self) -> DataFrame:
        return fx.ratings(self.t.lineitem, self.t.orders)

    @cached_property
    def movies(self) -> DataFrame:
        return fx.movies(self.t.part)

    @cached_property
    def splits(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        return rc.keyed_split(self.ratings)

    @cached_property
    def stored_ratings(self) -> DataFrame:
        """Ratings, for queries that read them several times."""
        return stored(self.ratings, "all-ratings")

    @cached_property
    def stored_splits(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        return rc.keyed_split(self.stored_ratings)

    @cached_property
    def ids(self) -> rc.Dictionary:
        """Dense ids of all ratings, stored once for every fit of a query."""
        return rc.dictionary(self.stored_ratings)

    @cached_property
    def dense_train(self) -> rc.DenseRatings:
        return rc.dense(self.stored_splits[0], self.ids)


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Ctx], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None):
    def deco(fn: Callable[[Ctx], DataFrame]):
        REGISTRY[name] = Query(name, fn, sql)
        return fn
    return deco


def run(name: str, spark: SparkSession, data_dir: str) -> DataFrame:
    return REGISTRY[name].build(Ctx(spark, data_dir))


# ---------------------------------------------------------------- sources --

@query("split_text_lines", o.with_([o.DOC_LINES], "SELECT doc_id, line FROM doc_lines"))
def _split_text_lines(c: Ctx) -> DataFrame:
    return c.lines.select("doc_id", "line")


@query("document_lines", o.with_([o.DOC_LINES], "SELECT doc_id, line_no, line FROM doc_lines"))
def _document_lines(c: Ctx) -> DataFrame:
    return document_lines(c.t.documents)


@query("numbered_lines", o.with_([o.DOC_LINES], """SELECT doc_id, line_no, line,
  row_number() OVER (ORDER BY doc_id, line_no) - 1 AS line_index FROM doc_lines"""))
def _numbered_lines(c: Ctx) -> DataFrame:
    return numbered_lines(c.lines, ["doc_id", "line_no"])


@query("read_file_lines", o.with_([o.CLF_LINES], """SELECT value, row_number() OVER (ORDER BY line_id) - 1 AS line_index
  FROM clf_lines"""))
def _read_file_lines(c: Ctx) -> DataFrame:
    # The log in the order of its ids, written as several text files into the shared folder.
    path = f"{checkpoint_dir(c.spark).rstrip('/')}/log-{uuid.uuid4().hex[:12]}"
    c.clf.repartitionByRange(8, "line_id").sortWithinPartitions("line_id").select("value").write.text(path)
    return read_file_lines(c.spark, path).select("value", "line_index")


@query("read_text_lines", o.with_([o.CLF_LINES], """SELECT value, count(*) AS n FROM clf_lines GROUP BY value"""))
def _read_text_lines(c: Ctx) -> DataFrame:
    # The log written as text files into the shared folder, and read as text.
    path = f"{checkpoint_dir(c.spark).rstrip('/')}/log-{uuid.uuid4().hex[:12]}"
    c.clf.select("value").write.text(path)
    return read_text_lines(c.spark, path).groupBy("value").agg(F.count(F.lit(1)).alias("n"))


@query("read_gzip_lines", o.with_([o.CLF_LINES], """SELECT value, count(*) AS n FROM clf_lines GROUP BY value"""))
def _read_gzip_lines(c: Ctx) -> DataFrame:
    # The log written as gzip files into the shared folder, read by ranges of 64 kB.
    path = f"{checkpoint_dir(c.spark).rstrip('/')}/log-{uuid.uuid4().hex[:12]}"
    c.clf.select("value").write.option("compression", "gzip").text(path)
    return read_gzip_lines(c.spark, path, 1 << 16).groupBy("value").agg(F.count(F.lit(1)).alias("n"))


@query("load_stopwords", o.with_([o.DOC_LINES], """SELECT DISTINCT trim(w, ' ') AS token FROM (
  SELECT unnest(string_split(line, ' ')) AS w FROM doc_lines) WHERE trim(w, ' ') <> ''"""))
def _load_stopwords(c: Ctx) -> DataFrame:
    return ps.load_stopwords(c.lines.select(F.explode(F.split("line", " ")).alias("value")))


@query("failed_log_lines", o.with_(o.LOG, "SELECT line_id, value FROM parsed WHERE NOT parse_ok"))
def _failed_log_lines(c: Ctx) -> DataFrame:
    return ps.split_valid_failed(c.parsed)[1].select("line_id", "value")


@query("daily_unique_hosts_by_date", o.with_(o.LOG, """SELECT CAST(date_time AS DATE) AS day,
  count(DISTINCT host) AS unique_hosts FROM access GROUP BY 1"""))
def _daily_unique_hosts_by_date(c: Ctx) -> DataFrame:
    return wl.daily_unique_hosts(c.access, by_date=True)


@query("daily_requests_per_host_by_date", o.with_(o.LOG, """SELECT CAST(date_time AS DATE) AS day,
  CAST(count(*) // count(DISTINCT host) AS BIGINT) AS avg_requests FROM access GROUP BY 1"""))
def _daily_requests_per_host_by_date(c: Ctx) -> DataFrame:
    return wl.daily_requests_per_host(c.access, by_date=True)


@query("parse_access_log", o.with_(o.LOG, """SELECT line_id, value, host, client_identd, user_id, date_time,
  method, endpoint, protocol, response_code, content_size, parse_ok FROM parsed"""))
def _parse_access_log(c: Ctx) -> DataFrame:
    return c.parsed


@query("split_valid_failed", o.with_(o.LOG, """SELECT count(*) AS n_parsed,
  count(*) FILTER (WHERE parse_ok) AS n_access, count(*) FILTER (WHERE NOT parse_ok) AS n_failed FROM parsed"""))
def _split_valid_failed(c: Ctx) -> DataFrame:
    return ps.parse_counts(c.parsed)


@query("log_cleaning_report", o.with_([o.CLF_LINES], f"""SELECT count(*) AS n_lines,
  count(*) FILTER (WHERE regexp_matches(value, {o.q(o.ACCESS_LOG_PATTERN_ORIGINAL)})) AS n_ok_original,
  count(*) FILTER (WHERE NOT regexp_matches(value, {o.q(o.ACCESS_LOG_PATTERN_ORIGINAL)})) AS n_failed_original,
  count(*) FILTER (WHERE regexp_matches(value, {o.q(o.ACCESS_LOG_PATTERN)})) AS n_ok_corrected,
  count(*) FILTER (WHERE NOT regexp_matches(value, {o.q(o.ACCESS_LOG_PATTERN)})) AS n_failed_corrected
  FROM clf_lines"""))
def _log_cleaning_report(c: Ctx) -> DataFrame:
    return ps.log_cleaning_report(c.clf)


@query("parse_product_csv", o.with_([o.PRODUCT_LINES, o.PRODUCTS], "SELECT id, value, parse_status FROM products"))
def _parse_product_csv(c: Ctx) -> DataFrame:
    return ps.parse_product_csv(fx.product_lines(c.t.part))


@query("parse_gold_csv", o.with_(o.ER[:1] + [o.GOLD, o.GOLD_LINES], f"""SELECT
  CASE WHEN st = 1 THEN replace(regexp_extract(value, {o.q(o.GOLDFILE_PATTERN)}, 1), '"', '') END AS a_id,
  CASE WHEN st = 1 THEN replace(regexp_extract(value, {o.q(o.GOLDFILE_PATTERN)}, 2), '"', '') END AS b_id,
  st AS parse_status
  FROM (SELECT value, CASE WHEN NOT regexp_matches(value, {o.q(o.GOLDFILE_PATTERN)}) THEN -1
          WHEN regexp_extract(value, {o.q(o.GOLDFILE_PATTERN)}, 1) = {o.q(o.GOLDFILE_HEADER_FIELD)} THEN 0 ELSE 1 END AS st
        FROM gold_lines)"""))
def _parse_gold_csv(c: Ctx) -> DataFrame:
    return ps.parse_gold_csv(fx.gold_lines(c.gold))


@query("parse_ratings", o.with_([o.RATINGS], """SELECT
  TRY_CAST(split_part(v, '::', 1) AS BIGINT) AS user_id, TRY_CAST(split_part(v, '::', 2) AS BIGINT) AS item_id,
  TRY_CAST(split_part(v, '::', 3) AS DOUBLE) AS rating
  FROM (SELECT concat_ws('::', CAST(user_id AS VARCHAR), CAST(item_id AS VARCHAR), CAST(rating AS VARCHAR), '0') AS v
        FROM ratings)"""))
def _parse_ratings(c: Ctx) -> DataFrame:
    return ps.parse_ratings(fx.rating_lines(c.ratings))


@query("parse_movies", """SELECT TRY_CAST(split_part(v, '::', 1) AS BIGINT) AS item_id, split_part(v, '::', 2) AS title
  FROM (SELECT concat_ws('::', CAST(p_partkey AS VARCHAR), p_name, p_type) AS v FROM part)""")
def _parse_movies(c: Ctx) -> DataFrame:
    return ps.parse_movies(fx.movie_lines(c.t.part))


# ------------------------------------------------- projections and filters --

@query("append_suffix", o.with_([o.DOC_LINES, o.ALL_WORDS, o.WORDS],
                                "SELECT DISTINCT word, word || 's' AS plural FROM words"))
def _append_suffix(c: Ctx) -> DataFrame:
    return wc.pluralize(wc.corpus_words(c.lines).distinct())


@query("word_lengths", o.with_([o.DOC_LINES, o.ALL_WORDS, o.WORDS],
                               "SELECT DISTINCT word, CAST(length(word) AS INTEGER) AS length FROM words"))
def _word_lengths(c: Ctx) -> DataFrame:
    return wc.word_lengths(wc.corpus_words(c.lines).distinct())


@query("project_field", "SELECT event_id, event_type FROM events")
def _project_field(c: Ctx) -> DataFrame:
    return basic.project_field(c.t.events, "event_id", "event_type")


@query("filter_modulo", """SELECT count(*) AS n, CAST(sum(event_id) AS BIGINT) AS total
  FROM events WHERE event_id % 7 = 0""")
def _filter_modulo(c: Ctx) -> DataFrame:
    return basic.filter_modulo(c.t.events, "event_id", 7).agg(
        F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("total")
    )


@query("drop_stopwords", o.with_(o.ER[:1], f"""SELECT id, token, count(*) AS n FROM (
  SELECT doc_id AS id, unnest({o.simple_tokens('text')}) AS token FROM documents)
  WHERE NOT list_contains({o.STOP_LIST}, token) GROUP BY id, token"""))
def _drop_stopwords(c: Ctx) -> DataFrame:
    # The list as a table, anti-joined; the tokenizer of ER takes it as a literal.
    tokens = c.a.select("id", F.explode(simple_tokenize("value")).alias("token"))
    return sm.drop_stopwords(tokens, fx.stopwords(c.spark)).groupBy("id", "token").agg(F.count(F.lit(1)).alias("n"))


@query("drop_empty_words", o.with_([o.DOC_LINES, o.ALL_WORDS], """SELECT count(*) AS n_words,
  count(*) FILTER (WHERE word <> '') AS n_nonempty FROM all_words"""))
def _drop_empty_words(c: Ctx) -> DataFrame:
    w = wc.words(c.lines)
    return w.agg(F.count(F.lit(1)).alias("n_words"), F.count_if(F.col("word") != "").alias("n_nonempty"))


@query("filter_status_ne", o.with_(o.LOG, """SELECT line_id, host, date_time, endpoint, response_code
  FROM access WHERE response_code <> 200"""))
def _filter_status_ne(c: Ctx) -> DataFrame:
    return wl.filter_status_ne(c.access, 200).select("line_id", "host", "date_time", "endpoint", "response_code")


@query("filter_status_eq", o.with_(o.LOG, """SELECT line_id, host, date_time, endpoint, response_code
  FROM access WHERE response_code = 404"""))
def _filter_status_eq(c: Ctx) -> DataFrame:
    return wl.filter_status_eq(c.access, 404).select("line_id", "host", "date_time", "endpoint", "response_code")


@query("filter_min_count", o.with_([o.RATINGS], f"""SELECT item_id, count(*) AS "count" FROM ratings
  GROUP BY item_id HAVING count(*) > {TOP_RATED_MIN}"""))
def _filter_min_count(c: Ctx) -> DataFrame:
    return basic.filter_min_count(basic.group_count_values(c.ratings, "item_id"), TOP_RATED_MIN)


@query("lookup_pair", o.with_(o.ER_GOLD, """SELECT a_id, b_id, round(similarity, 6) AS similarity FROM gs
  WHERE (a_id, b_id) = (SELECT (a_id, b_id) FROM gold ORDER BY a_id, b_id LIMIT 1)"""))
def _lookup_pair(c: Ctx) -> DataFrame:
    first = c.gold.orderBy("a_id", "b_id").limit(1)
    return sm.pair_similarity(c.tok_a, c.tok_b, c.idf, first).select("a_id", "b_id", r6("similarity").alias("similarity"))


@query("exact_title", """SELECT count(*) AS n FROM part WHERE p_name = 'red widget'""")
def _exact_title(c: Ctx) -> DataFrame:
    return basic.exact_title(c.movies, "red widget")


# ------------------------------------------------------------------ joins --

@query("join_on_key", o.with_([o.RATINGS], """SELECT r.user_id, r.item_id, r.rating, m.title
  FROM ratings r JOIN movies m ON r.item_id = m.item_id"""))
def _join_on_key(c: Ctx) -> DataFrame:
    return basic.join_on_key(c.ratings, c.movies, "item_id").select("user_id", "item_id", "rating", "title")


@query("join_tokens", o.with_(o.ER, """SELECT a.token, a.id AS a_id, b.id AS b_id
  FROM tf_a a JOIN tf_b b ON a.token = b.token"""))
def _join_tokens(c: Ctx) -> DataFrame:
    return sm.join_tokens(c.w_a, c.w_b)


@query("true_duplicates", o.with_(o.ER_GOLD, """SELECT s.a_id, s.b_id, round(s.similarity, 6) AS similarity
  FROM sims s JOIN gold g ON s.a_id = g.a_id AND s.b_id = g.b_id"""))
def _true_duplicates(c: Ctx) -> DataFrame:
    return ev.true_duplicates(c.tok_a, c.tok_b, c.idf, c.gold).select("a_id", "b_id", r6("similarity").alias("similarity"))


@query("non_duplicates", o.with_(o.ER_GOLD, """SELECT s.a_id, s.b_id, round(s.similarity, 6) AS similarity
  FROM sims s ANTI JOIN gold g ON s.a_id = g.a_id AND s.b_id = g.b_id"""))
def _non_duplicates(c: Ctx) -> DataFrame:
    return ev.non_duplicates(c.sims, c.gold).select("a_id", "b_id", pairs6("similarity"))


@query("gold_similarities", o.with_(o.ER_GOLD, "SELECT a_id, b_id, round(similarity, 6) AS similarity FROM gs"))
def _gold_similarities(c: Ctx) -> DataFrame:
    return ev.gold_similarities(c.tok_a, c.tok_b, c.idf, c.gold).select("a_id", "b_id", r6("similarity").alias("similarity"))


@query("gold_mapping", o.with_(o.ER[:1] + [o.GOLD], "SELECT a_id, b_id FROM gold"))
def _gold_mapping(c: Ctx) -> DataFrame:
    return c.gold


@query("unrated_items", o.with_([o.RATINGS], """SELECT (SELECT min(user_id) FROM ratings) AS user_id, m.item_id
  FROM movies m WHERE m.item_id NOT IN (
    SELECT item_id FROM ratings WHERE user_id = (SELECT min(user_id) FROM ratings))"""))
def _unrated_items(c: Ctx) -> DataFrame:
    user = c.ratings.agg(F.min("user_id")).scalar()
    return rc.unrated_items(c.ratings, c.movies, user)


# ----------------------------------------------------------- aggregations --

@query("sum_all", "SELECT CAST(sum(event_id) AS BIGINT) AS total FROM events")
def _sum_all(c: Ctx) -> DataFrame:
    return basic.sum_all(c.t.events, "event_id")


@query("count_rows", o.with_([o.DOC_LINES], "SELECT count(*) AS n FROM doc_lines"))
def _count_rows(c: Ctx) -> DataFrame:
    return basic.count_rows(c.lines)


@query("group_values", o.with_([o.RATINGS], """SELECT item_id, rating, count(*) AS multiplicity
  FROM ratings GROUP BY item_id, rating"""))
def _group_values(c: Ctx) -> DataFrame:
    return basic.group_values(c.ratings, "item_id", "rating")


LIST_SIZE = 16


@query("value_lists", o.with_([o.RATINGS], f"""SELECT item_id, segment, list(rating ORDER BY rating) AS "values"
  FROM (SELECT item_id, rating, (row_number() OVER (PARTITION BY item_id ORDER BY rating) - 1) // {LIST_SIZE} AS segment FROM ratings)
  GROUP BY item_id, segment"""))
def _value_lists(c: Ctx) -> DataFrame:
    return basic.value_lists(c.ratings, "item_id", "rating", LIST_SIZE)


@query("group_count_values", o.with_([o.RATINGS], """SELECT user_id, count(*) AS "count" FROM ratings GROUP BY user_id"""))
def _group_count_values(c: Ctx) -> DataFrame:
    return basic.group_count_values(c.ratings, "user_id")


_WC = [o.DOC_LINES, o.ALL_WORDS, o.WORDS, o.WORD_COUNTS]


@query("word_count", o.with_(_WC, 'SELECT word, "count" FROM word_counts'))
def _word_count(c: Ctx) -> DataFrame:
    return c.counts


@query("unique_words", o.with_(_WC, "SELECT count(*) AS unique_words FROM word_counts"))
def _unique_words(c: Ctx) -> DataFrame:
    return wc.unique_words(c.counts)


@query("mean_per_word", o.with_(_WC, """SELECT CAST(sum("count") AS BIGINT) AS total_words,
  count(*) AS unique_words, round(sum("count") / count(*), 6) AS mean_count FROM word_counts"""))
def _mean_per_word(c: Ctx) -> DataFrame:
    return wc.mean_per_word(c.counts).withColumn("mean_count", r6("mean_count"))


@query("split_words", o.with_([o.DOC_LINES, o.ALL_WORDS], """SELECT word, count(*) AS "count"
  FROM all_words GROUP BY word"""))
def _split_words(c: Ctx) -> DataFrame:
    return wc.word_count(wc.words(c.lines))


@query("content_size_stats", o.with_(o.LOG, """SELECT CAST(sum(content_size) // count(*) AS BIGINT) AS avg_size,
  min(content_size) AS min_size, max(content_size) AS max_size FROM access"""))
def _content_size_stats(c: Ctx) -> DataFrame:
    return wl.content_size_stats(c.access)


@query("response_code_counts", o.with_(o.LOG, """SELECT response_code, count(*) AS "count"
  FROM access GROUP BY response_code"""))
def _response_code_counts(c: Ctx) -> DataFrame:
    return wl.response_code_counts(c.access)


@query("response_code_fractions", o.with_(o.LOG, """SELECT response_code, count(*) AS "count",
  round(count(*) / (SELECT count(*) FROM access), 6) AS fraction FROM access GROUP BY response_code"""))
def _response_code_fractions(c: Ctx) -> DataFrame:
    return wl.response_code_fractions(c.access).withColumn("fraction", r6("fraction"))


@query("endpoint_counts", o.with_(o.LOG, """SELECT endpoint, count(*) AS "count" FROM access GROUP BY endpoint"""))
def _endpoint_counts(c: Ctx) -> DataFrame:
    return wl.endpoint_counts(c.access)


@query("error_endpoint_counts", o.with_(o.LOG, """SELECT endpoint, count(*) AS "count" FROM access
  WHERE response_code <> 200 GROUP BY endpoint"""))
def _error_endpoint_counts(c: Ctx) -> DataFrame:
    return wl.error_endpoint_counts(c.access)


@query("frequent_hosts", o.with_(o.LOG, f"""SELECT host, count(*) AS "count" FROM access
  GROUP BY host HAVING count(*) > {FREQUENT_HOST_MIN}"""))
def _frequent_hosts(c: Ctx) -> DataFrame:
    return wl.frequent_hosts(c.access, FREQUENT_HOST_MIN)


@query("unique_hosts", o.with_(o.LOG, "SELECT count(DISTINCT host) AS unique_hosts FROM access"))
def _unique_hosts(c: Ctx) -> DataFrame:
    return wl.unique_hosts(c.access)


# The sketch against the exact count, day by day and over all days.
_SKETCH_ERROR = 0.05


@query("host_sketches", o.with_(o.LOG, """SELECT CAST(date_time AS DATE) AS day, count(*) AS requests, true AS near
  FROM access GROUP BY 1 UNION ALL SELECT NULL, count(*), true FROM access"""))
def _host_sketches(c: Ctx) -> DataFrame:
    kept = stored(wl.host_sketches(c.access), "host-sketches")
    exact = wl.daily_unique_hosts(c.access, by_date=True).withColumnRenamed("unique_hosts", "exact")
    days = kept.select("day", "requests", F.hll_sketch_estimate("hosts").alias("unique_hosts")).join(exact, "day")
    whole = wl.hosts_of_days(kept).select(
        F.lit(None).cast("date").alias("day"), "requests", "unique_hosts", F.lit(wl.unique_hosts(c.access).scalar()).alias("exact")
    )
    near = F.abs(F.col("unique_hosts") - F.col("exact")) <= F.ceil(_SKETCH_ERROR * F.col("exact"))
    return days.unionByName(whole).select("day", "requests", near.alias("near"))


@query("daily_unique_hosts", o.with_(o.LOG, """SELECT CAST(dayofmonth(date_time) AS INTEGER) AS day,
  count(DISTINCT host) AS unique_hosts FROM access GROUP BY 1"""))
def _daily_unique_hosts(c: Ctx) -> DataFrame:
    return wl.daily_unique_hosts(c.access)


@query("daily_requests_per_host", o.with_(o.LOG, """SELECT CAST(dayofmonth(date_time) AS INTEGER) AS day,
  count(*) // count(DISTINCT host) AS avg_requests FROM access GROUP BY 1"""))
def _daily_requests_per_host(c: Ctx) -> DataFrame:
    return wl.daily_requests_per_host(c.access)


@query("not_found_count", o.with_(o.LOG, "SELECT count(*) AS not_found FROM access WHERE response_code = 404"))
def _not_found_count(c: Ctx) -> DataFrame:
    return wl.not_found_count(c.access)


@query("not_found_by_day", o.with_(o.LOG, """SELECT CAST(dayofmonth(date_time) AS INTEGER) AS day,
  count(*) AS "count" FROM access WHERE response_code = 404 GROUP BY 1"""))
def _not_found_by_day(c: Ctx) -> DataFrame:
    return wl.not_found_by_day(c.access)


@query("not_found_by_hour", o.with_(o.LOG, """SELECT CAST(hour(date_time) AS INTEGER) AS hour,
  count(*) AS "count" FROM access WHERE response_code = 404 GROUP BY 1"""))
def _not_found_by_hour(c: Ctx) -> DataFrame:
    return wl.not_found_by_hour(c.access)


@query("item_count_avg", o.with_([o.RATINGS], """SELECT item_id, count(*) AS n_ratings,
  round(avg(rating), 6) AS avg_rating FROM ratings GROUP BY item_id"""))
def _item_count_avg(c: Ctx) -> DataFrame:
    return rc.item_count_avg(c.ratings).withColumn("avg_rating", r6("avg_rating"))


@query("item_counts", o.with_([o.RATINGS], "SELECT item_id, count(*) AS n_ratings FROM ratings GROUP BY item_id"))
def _item_counts(c: Ctx) -> DataFrame:
    return rc.item_counts(c.ratings)


@query("mean_value", o.with_([o.RATINGS], "SELECT round(avg(rating), 6) AS mean_rating FROM ratings"))
def _mean_value(c: Ctx) -> DataFrame:
    return rc.mean_value(c.ratings).withColumn("mean_rating", r6("mean_rating"))


@query("token_total", o.with_(o.ER[:1], """SELECT CAST(sum(n) AS BIGINT) AS total_tokens FROM (
  SELECT len(tokens) AS n FROM tok_a UNION ALL SELECT len(tokens) FROM tok_b)"""))
def _token_total(c: Ctx) -> DataFrame:
    return sm.token_total(sm.record_tokens(c.a), sm.record_tokens(c.b))


# --------------------------------------------------------- sorts and top-k --

@query("top_words", o.with_(_WC, 'SELECT word, "count" FROM word_counts ORDER BY "count" DESC, word LIMIT 15'))
def _top_words(c: Ctx) -> DataFrame:
    return wc.top_words(c.counts, 15)


@query("top_words_proven", o.with_(_WC, 'SELECT word, "count" FROM word_counts ORDER BY "count" DESC, word LIMIT 15'))
def _top_words_proven(c: Ctx) -> DataFrame:
    return frequent_top(wc.corpus_words(c.lines), "word", 15)


@query("top_endpoints_proven", o.with_(o.LOG, """SELECT endpoint, count(*) AS "count" FROM access
  GROUP BY endpoint ORDER BY "count" DESC, endpoint LIMIT 10"""))
def _top_endpoints_proven(c: Ctx) -> DataFrame:
    return frequent_top(c.access, "endpoint", 10)


@query("largest_values", o.with_([o.DOC_LINES, o.ALL_WORDS, o.WORDS],
                                 "SELECT word FROM words ORDER BY word DESC LIMIT 5"))
def _largest_values(c: Ctx) -> DataFrame:
    return wc.largest_values(wc.corpus_words(c.lines), "word", 5)


@query("top_endpoints", o.with_(o.LOG, """SELECT endpoint, count(*) AS "count" FROM access
  GROUP BY endpoint ORDER BY "count" DESC, endpoint LIMIT 10"""))
def _top_endpoints(c: Ctx) -> DataFrame:
    return wl.top_endpoints(c.access, 10)


@query("top_error_endpoints", o.with_(o.LOG, """SELECT endpoint, count(*) AS "count" FROM access
  WHERE response_code <> 200 GROUP BY endpoint ORDER BY "count" DESC, endpoint LIMIT 10"""))
def _top_error_endpoints(c: Ctx) -> DataFrame:
    return wl.top_error_endpoints(c.access, 10)


@query("top_not_found_endpoints", o.with_(o.LOG, """SELECT endpoint, count(*) AS "count" FROM access
  WHERE response_code = 404 GROUP BY endpoint ORDER BY "count" DESC, endpoint LIMIT 20"""))
def _top_not_found_endpoints(c: Ctx) -> DataFrame:
    return wl.top_not_found_endpoints(c.access, 20)


@query("top_not_found_hosts", o.with_(o.LOG, """SELECT host, count(*) AS "count" FROM access
  WHERE response_code = 404 GROUP BY host ORDER BY "count" DESC, host LIMIT 25"""))
def _top_not_found_hosts(c: Ctx) -> DataFrame:
    return wl.top_not_found_hosts(c.access, 25)


@query("top_not_found_days", o.with_(o.LOG, """SELECT CAST(dayofmonth(date_time) AS INTEGER) AS day,
  count(*) AS "count" FROM access WHERE response_code = 404 GROUP BY 1 ORDER BY "count" DESC, day LIMIT 5"""))
def _top_not_found_days(c: Ctx) -> DataFrame:
    return wl.top_not_found_days(c.access, 5)


@query("stored_days", o.with_(o.LOG, """SELECT CAST(date_time AS DATE) AS day, response_code, count(*) AS "count",
  CAST(sum(content_size) AS BIGINT) AS bytes FROM access
  WHERE CAST(date_time AS DATE) BETWEEN (SELECT min(CAST(date_time AS DATE)) FROM access) + 1
    AND (SELECT min(CAST(date_time AS DATE)) FROM access) + 3 GROUP BY 1, 2"""))
def _stored_days(c: Ctx) -> DataFrame:
    # The whole log is parsed and stored once; the report reads three of its days.
    path = f"{checkpoint_dir(c.spark).rstrip('/')}/log-days-{uuid.uuid4().hex[:12]}"
    store_days(c.access, path)
    first = c.spark.read.parquet(path).agg(F.min("day")).first()[0]
    days = (None, None) if first is None else (first + timedelta(days=1), first + timedelta(days=3))
    return read_days(c.spark, path, *days).groupBy("day", "response_code").agg(
        F.count(F.lit(1)).alias("count"), F.sum("content_size").alias("bytes")
    )


@query("sort_by_key", o.with_(o.LOG, """SELECT response_code, count(*) AS "count" FROM access
  GROUP BY response_code ORDER BY response_code"""))
def _sort_by_key(c: Ctx) -> DataFrame:
    return basic.sort_by_key(wl.response_code_counts(c.access), ["response_code"])


@query("stable_sort", o.with_([o.RATINGS], """SELECT round(avg(r.rating), 3) AS avg_rating, m.title, m.item_id
  FROM ratings r JOIN movies m ON r.item_id = m.item_id GROUP BY m.item_id, m.title
  ORDER BY avg_rating, m.title, m.item_id"""))
def _stable_sort(c: Ctx) -> DataFrame:
    stats = rc.with_titles(rc.count_and_average(c.ratings), c.movies)
    return basic.stable_sort(
        stats.select(F.round("avg_rating", 3).alias("avg_rating"), "title", "item_id"),
        "avg_rating", "title", ids=["item_id"],
    )


@query("biggest_record", o.with_(o.ER[:1], """SELECT id, CAST(len(tokens) AS INTEGER) AS n_tokens FROM tok_a
  ORDER BY n_tokens DESC, id LIMIT 1"""))
def _biggest_record(c: Ctx) -> DataFrame:
    return sm.biggest_record(sm.record_tokens(c.a))


@query("smallest_idf", o.with_(o.ER[:3], """SELECT token, round(idf, 6) AS idf FROM idf
  ORDER BY idf, token LIMIT 11"""))
def _smallest_idf(c: Ctx) -> DataFrame:
    return sm.smallest_idf(c.idf, 11).withColumn("idf", r6("idf"))


@query("top_rated", o.with_([o.RATINGS], f"""SELECT s.item_id, m.title, s.n_ratings, round(s.avg_rating, 6) AS avg_rating
  FROM (SELECT item_id, count(*) AS n_ratings, avg(rating) AS avg_rating FROM ratings GROUP BY item_id) s
  JOIN movies m ON s.item_id = m.item_id WHERE s.n_ratings > {TOP_RATED_MIN}
  ORDER BY round(s.avg_rating, 3) DESC, m.title DESC, s.item_id DESC LIMIT 20"""))
def _top_rated(c: Ctx) -> DataFrame:
    return rc.top_rated(c.ratings, c.movies, TOP_RATED_MIN, 20).withColumn("avg_rating", r6("avg_rating"))


@query("sample_take", o.with_(o.LOG, "SELECT line_id, host, endpoint FROM access ORDER BY line_id LIMIT 20"))
def _sample_take(c: Ctx) -> DataFrame:
    return basic.sample_take(c.access.select("line_id", "host", "endpoint"), 20, ["line_id"])


# ---------------------------------------------------------- set operations --

@query("build_corpus", o.with_(o.ER[:1], """SELECT 0 AS src, id, CAST(len(tokens) AS INTEGER) AS n_tokens FROM tok_a
  UNION ALL SELECT 1 AS src, id, CAST(len(tokens) AS INTEGER) AS n_tokens FROM tok_b"""))
def _build_corpus(c: Ctx) -> DataFrame:
    corpus = sm.build_corpus(sm.record_tokens(c.a), sm.record_tokens(c.b))
    return corpus.select("src", "id", F.size("tokens").alias("n_tokens"))


@query("add_ratings", o.with_([o.RATINGS, o.SPLITS], """SELECT user_id, item_id, rating FROM train
  UNION ALL SELECT user_id, item_id, rating FROM test WHERE user_id = (SELECT min(user_id) FROM ratings)"""))
def _add_ratings(c: Ctx) -> DataFrame:
    train, _, test = c.splits
    user = c.ratings.agg(F.min("user_id")).scalar()
    mine = test.where(F.col("user_id") == user)
    return rc.add_ratings(train, mine)


@query("distinct_day_host", o.with_(o.LOG, """SELECT DISTINCT CAST(dayofmonth(date_time) AS INTEGER) AS day, host
  FROM access"""))
def _distinct_day_host(c: Ctx) -> DataFrame:
    return wl.distinct_day_host(c.access)


@query("distinct_ids", o.with_(o.ER[:2], "SELECT DISTINCT id FROM tf_a"))
def _distinct_ids(c: Ctx) -> DataFrame:
    return basic.distinct_ids(c.tf_a)


@query("distinct_not_found_endpoints", o.with_(o.LOG, """SELECT DISTINCT endpoint FROM access
  WHERE response_code = 404"""))
def _distinct_not_found_endpoints(c: Ctx) -> DataFrame:
    return wl.distinct_not_found_endpoints(c.access)


# -------------------------------------------------------- scalar functions --

@query("clean_text", o.with_([o.DOC_LINES], f"SELECT doc_id, line_no, {o.clean('line')} AS cleaned FROM doc_lines"))
def _clean_text(c: Ctx) -> DataFrame:
    return c.lines.select("doc_id", "line_no", clean_text("line").alias("cleaned"))


@query("simple_tokenize", f"""SELECT doc_id, array_to_string({o.simple_tokens('text')}, ' ') AS tokens,
  CAST(len({o.simple_tokens('text')}) AS INTEGER) AS n_tokens FROM documents""")
def _simple_tokenize(c: Ctx) -> DataFrame:
    t = simple_tokenize("text")
    return c.t.documents.select("doc_id", F.array_join(t, " ").alias("tokens"), F.size(t).alias("n_tokens"))


@query("tokenize", f"""SELECT doc_id, array_to_string({o.tokens('text')}, ' ') AS tokens,
  CAST(len({o.tokens('text')}) AS INTEGER) AS n_tokens FROM documents""")
def _tokenize(c: Ctx) -> DataFrame:
    t = tokenize("text", fx.STOPWORDS)
    return c.t.documents.select("doc_id", F.array_join(t, " ").alias("tokens"), F.size(t).alias("n_tokens"))


@query("remove_quotes", o.with_([o.PRODUCT_LINES], """SELECT line_id, replace(value, '"', '') AS unquoted
  FROM product_lines"""))
def _remove_quotes(c: Ctx) -> DataFrame:
    return fx.product_lines(c.t.part).select("line_id", remove_quotes("value").alias("unquoted"))


@query("parse_apache_time", o.with_([o.CLF_LINES], """SELECT line_id,
  CAST(try_strptime(substr(regexp_extract(value, '\\[([^\\]]*)\\]', 1), 1, 20), '%d/%b/%Y:%H:%M:%S') AS TIMESTAMP)
  AS date_time FROM clf_lines"""))
def _parse_apache_time(c: Ctx) -> DataFrame:
    return c.clf.select("line_id", parse_apache_time(F.regexp_extract("value", r"\[([^\]]*)\]", 1)).alias("date_time"))


@query("day_of_month", o.with_(o.LOG, "SELECT line_id, CAST(dayofmonth(date_time) AS INTEGER) AS day FROM access"))
def _day_of_month(c: Ctx) -> DataFrame:
    return c.access.select("line_id", day_of_month("date_time").alias("day"))


@query("hour_of_day", o.with_(o.LOG, "SELECT line_id, CAST(hour(date_time) AS INTEGER) AS hour FROM access"))
def _hour_of_day(c: Ctx) -> DataFrame:
    return c.access.select("line_id", hour_of_day("date_time").alias("hour"))


@query("squared_error", o.with_([o.RATINGS, o.SPLITS], """SELECT user_id, item_id,
  round((rating - (SELECT avg(rating) FROM train)) * (rating - (SELECT avg(rating) FROM train)), 6) AS squared_error
  FROM test"""))
def _squared_error(c: Ctx) -> DataFrame:
    train, _, test = c.splits
    mean = train.agg(F.avg("rating")).scalar()
    return test.select("user_id", "item_id", r6(squared_error("rating", F.lit(1.0) * mean)).alias("squared_error"))


@query("similarity_bin", o.with_(o.ER, """SELECT CAST(trunc(similarity * 100) AS INTEGER) AS bin, count(*) AS "count"
  FROM sims GROUP BY 1"""))
def _similarity_bin(c: Ctx) -> DataFrame:
    return c.sims.groupBy(similarity_bin("similarity").alias("bin")).agg(F.count(F.lit(1)).alias("count"))


# ------------------------------------------------------ entity resolution --

@query("term_frequency", o.with_(o.ER[:2], "SELECT id, token, n, round(tf, 6) AS tf FROM tf_a"))
def _term_frequency(c: Ctx) -> DataFrame:
    return c.tf_a.select("id", "token", "n", r6("tf").alias("tf"))


@query("inverse_document_frequency", o.with_(o.ER[:3], "SELECT token, df, round(idf, 6) AS idf FROM idf"))
def _inverse_document_frequency(c: Ctx) -> DataFrame:
    return c.idf.select("token", "df", r6("idf").alias("idf"))


@query("idf_histogram", o.with_(o.ER[:3], """SELECT CAST(CASE WHEN hi = lo THEN 0
    ELSE least(floor((idf - lo) / ((hi - lo) / 50)), 49) END AS INTEGER) AS bucket,
  count(*) AS "count", round(min(lo + CAST(CASE WHEN hi = lo THEN 0
    ELSE least(floor((idf - lo) / ((hi - lo) / 50)), 49) END AS INTEGER) * ((hi - lo) / 50)), 6) AS lower
  FROM (SELECT idf, (SELECT min(idf) FROM idf) AS lo, (SELECT max(idf) FROM idf) AS hi FROM idf)
  GROUP BY 1"""))
def _idf_histogram(c: Ctx) -> DataFrame:
    return sm.idf_histogram(c.idf, 50).withColumn("lower", r6("lower"))


@query("tfidf", o.with_(o.ER[:4], "SELECT id, token, round(weight, 6) AS weight FROM w_a"))
def _tfidf(c: Ctx) -> DataFrame:
    return c.w_a.select("id", "token", r6("weight").alias("weight"))


@query("vector_norms", o.with_(o.ER[:4], """SELECT id, round(sqrt(sum(weight * weight)), 6) AS norm
  FROM w_a GROUP BY id"""))
def _vector_norms(c: Ctx) -> DataFrame:
    return sm.vector_norms(c.w_a).withColumn("norm", r6("norm"))


@query("dot_product", o.with_(o.ER[:4], """SELECT a.id AS a_id, b.id AS b_id, round(sum(a.weight * b.weight), 6) AS dot
  FROM w_a a JOIN w_b b ON a.token = b.token GROUP BY a.id, b.id"""))
def _dot_product(c: Ctx) -> DataFrame:
    w_a, w_b, blocks = c.paired
    return sm.dot_products(w_a, w_b, blocks=blocks).withColumn("dot", pairs6("dot"))


@query("cosine_similarity", o.with_(o.ER_GOLD, """SELECT g.a_id, g.b_id,
  round(coalesce(d.dot / (na.norm * nb.norm), 0.0), 6) AS similarity
  FROM gold g
  LEFT JOIN (SELECT a.id AS a_id, b.id AS b_id, sum(a.weight * b.weight) AS dot
             FROM w_a a JOIN w_b b ON a.token = b.token GROUP BY a.id, b.id) d
    ON g.a_id = d.a_id AND g.b_id = d.b_id
  LEFT JOIN (SELECT id, sqrt(sum(weight * weight)) AS norm FROM w_a GROUP BY id) na ON g.a_id = na.id
  LEFT JOIN (SELECT id, sqrt(sum(weight * weight)) AS norm FROM w_b GROUP BY id) nb ON g.b_id = nb.id"""))
def _cosine_similarity(c: Ctx) -> DataFrame:
    # For the gold pairs, 0 without a shared token; the oracle has the textbook form.
    return sm.pair_similarity(c.tok_a, c.tok_b, c.idf, c.gold).withColumn("similarity", r6("similarity"))


@query("inverted_index", o.with_(o.ER[:2], "SELECT token, id FROM tf_b"))
def _inverted_index(c: Ctx) -> DataFrame:
    return sm.inverted_index(c.tok_b)


@query("common_tokens", o.with_(o.ER[:2], """SELECT a.id AS a_id, b.id AS b_id, list_sort(list(a.token)) AS tokens
  FROM tf_a a JOIN tf_b b ON a.token = b.token GROUP BY a.id, b.id"""))
def _common_tokens(c: Ctx) -> DataFrame:
    w_a, w_b, blocks = c.paired
    return sm.common_tokens(w_a, w_b, blocks=blocks)


@query("scalable_similarity", o.with_(o.ER, "SELECT a_id, b_id, round(similarity, 6) AS similarity FROM sims"))
def _scalable_similarity(c: Ctx) -> DataFrame:
    return c.sims.withColumn("similarity", pairs6("similarity"))


THRESHOLDS = (0.2, 0.5, 0.8)
_AT = f"levels AS (SELECT unnest([{', '.join(map(str, THRESHOLDS))}])::DOUBLE AS threshold)"


@query("similarity_join", o.with_(o.ER + [_AT], """SELECT threshold, a_id, b_id, round(similarity, 6) AS similarity
  FROM sims JOIN levels ON similarity >= threshold"""))
def _similarity_join(c: Ctx) -> DataFrame:
    w_a, w_b, blocks = c.stored_weights
    joined = sm.threshold_join(w_a, w_b, THRESHOLDS, blocks=blocks)
    return joined.select("threshold", "a_id", "b_id", pairs6("similarity"))


# Which pairs the bounds let through is part of the method, so the oracle has the same bounds.
@query("similarity_join_report", o.with_(o.ER + [_AT, *(f"""rest_{s} AS (SELECT u.id, u.token,
  sqrt(sum(u.unit * u.unit) OVER (PARTITION BY u.id ORDER BY i.df, u.token ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS rest
  FROM u_{s} u JOIN idf i ON u.token = i.token)""" for s in "ab"), """met AS (SELECT DISTINCT threshold, a.id AS a_id, b.id AS b_id
  FROM rest_a a JOIN rest_b b ON a.token = b.token JOIN levels
  ON a.rest >= threshold - 1e-9 AND b.rest >= threshold - 1e-9 AND a.rest * b.rest >= threshold - 1e-9)"""],
    """SELECT l.threshold, count(m.a_id) AS candidates, count(*) FILTER (WHERE s.similarity >= l.threshold) AS pairs
  FROM levels l LEFT JOIN met m ON m.threshold = l.threshold LEFT JOIN sims s ON m.a_id = s.a_id AND m.b_id = s.b_id
  GROUP BY l.threshold"""))
def _similarity_join_report(c: Ctx) -> DataFrame:
    w_a, w_b, blocks = c.stored_weights
    return sm.threshold_report(w_a, w_b, THRESHOLDS, blocks=blocks)


@query("gold_evaluation", o.with_(o.ER_GOLD, """SELECT count(*) AS n_true_duplicates,
  round(avg(similarity), 6) AS avg_sim_duplicates,
  round(((SELECT sum(similarity) FROM sims) - sum(similarity))
        / ((SELECT count(DISTINCT id) FROM rec_a) * (SELECT count(DISTINCT id) FROM rec_b) - count(*)), 6)
    AS avg_sim_non_duplicates
  FROM gs"""))
def _gold_evaluation(c: Ctx) -> DataFrame:
    tok_a, tok_b, idf = c.packed
    w_a, w_b = (sm.tfidf(sm.term_frequency_of(x), idf) for x in (tok_a, tok_b))
    # Only the records that gold pairs name are tokenized once more.
    gold = ev.gold_similarities(sm.record_tokens(c.a), sm.record_tokens(c.b), idf, c.gold)
    out = ev.gold_evaluation(gold, sm.similarity_total(w_a, w_b), c.a, c.b)
    return out.withColumn("avg_sim_duplicates", r6("avg_sim_duplicates")).withColumn(
        "avg_sim_non_duplicates", r6("avg_sim_non_duplicates")
    )


@query("threshold_sweep", o.with_(o.ER_GOLD + ["""th AS (SELECT CAST(range AS INTEGER) AS i FROM range(100))""",
                                                """bins AS (
  SELECT CAST(trunc(similarity * 100) AS INTEGER) AS bin, 1 AS d FROM sims
  UNION ALL SELECT CAST(trunc(similarity * 100) AS INTEGER) AS bin, -1 AS d FROM gs)""",
                                                """fp AS (SELECT th.i, CAST(coalesce(sum(b.d), 0) AS BIGINT) AS fp
  FROM th LEFT JOIN bins b ON b.bin <= 100 AND CAST(b.bin AS DOUBLE) / 100 >= CAST(th.i AS DOUBLE) / 100
  GROUP BY th.i)""",
                                                """fn AS (SELECT th.i, count(g.similarity) AS fn
  FROM th LEFT JOIN gs g ON g.similarity < CAST(th.i AS DOUBLE) / 100 GROUP BY th.i)""",
                                                """cnt AS (SELECT fp.i, (SELECT count(*) FROM gs) - fn.fn AS tp, fp.fp, fn.fn
  FROM fp JOIN fn ON fp.i = fn.i)"""],
                                  f"""SELECT CAST(i AS DOUBLE) / 100 AS threshold, tp, fp, fn,
  round({o.div0('tp', 'tp + fp')}, 6) AS precision,
  round({o.div0('tp', 'tp + fn')}, 6) AS recall,
  round({o.div0(f"2 * {o.div0('tp', 'tp + fn')} * {o.div0('tp', 'tp + fp')}",
                 f"{o.div0('tp', 'tp + fn')} + {o.div0('tp', 'tp + fp')}")}, 6) AS fmeasure
  FROM cnt"""))
def _threshold_sweep(c: Ctx) -> DataFrame:
    out = ev.threshold_sweep(c.sims, c.gold, 100)
    for col in ("precision", "recall", "fmeasure"):
        out = out.withColumn(col, r6(col))
    return out


# --------------------------------------------------------- recommendation --

@query("keyed_split", o.with_([o.RATINGS, o.SPLITS], """SELECT 'train' AS split, count(*) AS n FROM train
  UNION ALL SELECT 'validation', count(*) FROM validation UNION ALL SELECT 'test', count(*) FROM test"""))
def _keyed_split(c: Ctx) -> DataFrame:
    return rc.split_sizes(c.ratings)


@query("random_split", o.with_([o.RATINGS], "SELECT user_id, item_id, rating, 1 AS parts FROM ratings"))
def _random_split(c: Ctx) -> DataFrame:
    # Every rating is in one part; which one is up to the seed.
    parts = rc.random_split(c.ratings, (6, 2, 2), seed=0)
    return basic.union_all(*parts).groupBy("user_id", "item_id", "rating").agg(F.count(F.lit(1)).cast("int").alias("parts"))


@query("rmse", o.with_([o.RATINGS, o.SPLITS], """SELECT round(sqrt(avg((p.prediction - t.rating) * (p.prediction - t.rating))), 6) AS rmse
  FROM (SELECT item_id, avg(rating) AS prediction FROM train GROUP BY item_id) p
  JOIN test t ON p.item_id = t.item_id"""))
def _rmse(c: Ctx) -> DataFrame:
    # Item-mean predictor on the keyed split, scored with rmse().
    train, _, test = c.splits
    means = train.groupBy("item_id").agg(F.avg("rating").alias("prediction"))
    pred = test.select("user_id", "item_id").join(means, "item_id")
    return rc.rmse(pred, test).withColumn("rmse", r6("rmse"))


@query("mean_baseline_rmse", o.with_([o.RATINGS, o.SPLITS], """SELECT round(sqrt(avg(
  (rating - (SELECT avg(rating) FROM train)) * (rating - (SELECT avg(rating) FROM train)))), 6) AS rmse FROM test"""))
def _mean_baseline_rmse(c: Ctx) -> DataFrame:
    train, _, test = c.splits
    return rc.mean_baseline_rmse(train, test).withColumn("rmse", r6("rmse"))


@query("items_for_user", o.with_([o.RATINGS], f"""SELECT s.item_id, m.title, s.n_ratings, round(s.avg_rating, 6) AS avg_rating
  FROM (SELECT item_id, count(*) AS n_ratings, avg(rating) AS avg_rating FROM ratings GROUP BY item_id) s
  JOIN movies m ON s.item_id = m.item_id WHERE s.n_ratings > {TOP_RATED_MIN}
  ORDER BY round(s.avg_rating, 3) DESC, m.title DESC, s.item_id DESC LIMIT 50"""))
def _items_for_user(c: Ctx) -> DataFrame:
    return rc.items_for_user(c.ratings, c.movies, TOP_RATED_MIN, 50).withColumn("avg_rating", r6("avg_rating"))


# Predictions and errors of a fit have no SQL twin. What these queries return
# is what must hold for them whatever the numbers; tests check the numbers.

@query("train_als", o.with_([o.RATINGS, o.SPLITS], """SELECT DISTINCT 'user' AS kind, user_id AS id, 4 AS n FROM train
  UNION ALL SELECT DISTINCT 'item', item_id, 4 FROM train"""))
def _train_als(c: Ctx) -> DataFrame:
    fitted = rc.train_als(c.dense_train, rank=4)
    parts = [
        f.select(F.lit(kind).alias("kind"), F.col(i).alias("id"), F.size("features").alias("n"))
        for kind, i, f in (("user", "user_id", fitted.user_factors()), ("item", "item_id", fitted.item_factors()))
    ]
    return basic.union_all(*parts)


@query("predict_pairs", o.with_([o.RATINGS, o.SPLITS], """SELECT user_id, item_id, true AS predicted FROM validation
  WHERE user_id IN (SELECT user_id FROM train) AND item_id IN (SELECT item_id FROM train)"""))
def _predict_pairs(c: Ctx) -> DataFrame:
    found = rc.predict_pairs(rc.train_als(c.dense_train, rank=4), c.stored_splits[1])
    return found.select("user_id", "item_id", (~F.isnan("prediction")).alias("predicted"))


@query("select_rank", "SELECT unnest([4, 8, 12]) AS rank, true AS scored, 1 AS n_best FROM (SELECT count(*) FROM lineitem)")
def _select_rank(c: Ctx) -> DataFrame:
    best = F.sum(F.col("best").cast("int")).over(Window.partitionBy(F.lit(0))).cast("int")
    return rc.select_rank(c.dense_train, c.stored_splits[1]).select("rank", (F.col("rmse") > 0).alias("scored"), best.alias("n_best"))


@query("test_model", "SELECT true AS scored FROM (SELECT count(*) FROM lineitem)")
def _test_model(c: Ctx) -> DataFrame:
    _, val, test = c.stored_splits
    return rc.test_model(c.dense_train, test, rc.best_rank(c.dense_train, val)).select((F.col("rmse") > 0).alias("scored"))


@query("retest_with_ratings", "SELECT true AS scored FROM (SELECT count(*) FROM lineitem)")
def _retest_with_ratings(c: Ctx) -> DataFrame:
    train, val, test = c.stored_splits
    mine = val.where(F.col("user_id") == c.stored_ratings.agg(F.min("user_id")).scalar())
    rank = rc.best_rank(c.dense_train, val)
    return rc.retest_with_ratings(train, mine, test, rank, ids=c.ids).select((F.col("rmse") > 0).alias("scored"))


@query("recommend_for_user", o.with_([o.RATINGS, o.SPLITS], f"""SELECT m.item_id, m.title, n.n_ratings
  FROM (SELECT item_id, count(*) AS n_ratings FROM (
      SELECT * FROM train UNION ALL SELECT * FROM validation WHERE user_id = (SELECT min(user_id) FROM ratings))
    GROUP BY item_id HAVING count(*) > {RECOMMEND_MIN}) n JOIN movies m ON m.item_id = n.item_id
  WHERE m.item_id NOT IN (SELECT item_id FROM (SELECT * FROM train UNION ALL SELECT * FROM validation)
    WHERE user_id = (SELECT min(user_id) FROM ratings))"""))
def _recommend_for_user(c: Ctx) -> DataFrame:
    # All candidates: the user's own ratings join training, the rank is the chosen one.
    train, val, _ = c.stored_splits
    user = c.stored_ratings.agg(F.min("user_id")).first()[0]
    mine = val.where(F.col("user_id") == user)
    found = rc.recommend_for_user(
        train, c.movies, user, mine, rank=rc.best_rank(c.dense_train, val), min_ratings=RECOMMEND_MIN, k=None, ids=c.ids
    )
    return found.select("item_id", "title", "n_ratings")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: (lambda spark, d, _n=name: run(_n, spark, d)) for name in REGISTRY}


def oracle_sql() -> dict[str, str]:
    return {name: q.sql for name, q in REGISTRY.items() if q.sql is not None}
