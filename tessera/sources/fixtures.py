"""Reference-shaped inputs derived from the driver tables.

The original jobs read a text corpus, a web-server access log, two product
catalogues with a gold mapping, a stopword file, and rating / title files.
None ship with the reference, so each is derived here from the given tables
by Spark (the work grows with the tables), and each has a DuckDB twin in
``tessera.plans.oracle`` built from the same rule.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import simple_tokenize
from tessera.plans.joins import grid_join, lookup_join
from tessera.plans.stored import stored
from tessera.sources.text import document_lines

# Candidate pairs that one task of the anchor join makes of a hot token.
PAIRS_PER_TASK = 2_000_000

# The stopword list used in place of the reference's file.
STOPWORDS = (
    "a", "an", "and", "are", "as", "at", "be", "being", "by", "for", "from",
    "in", "is", "it", "of", "on", "or", "over", "that", "the", "this", "to",
    "was", "were", "why", "with",
)

# Month names of a log's time stamp.
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")

# Header lines of the CSV-shaped fixtures.
PRODUCT_HEADER = '"id","title","description","manufacturer","price"'
GOLD_HEADER = '"idAmazon","idGoogle"'


def corpus_lines(documents: DataFrame) -> DataFrame:
    """(doc_id, line_no, line): the text corpus, one row per line."""
    return document_lines(documents.select("doc_id", "text"))


def clf_lines(events: DataFrame) -> DataFrame:
    """Common Log Format lines, one per event, plus junk lines.

    host ``u<user_id>``; time from ``ts`` with a fixed ``-0400`` zone;
    request ``GET /<event_type>/<event_id % 50> HTTP/1.0`` written with a
    trailing space for every 7th event (the case the original pattern
    misses); status 404 for ``error`` events, else 200; size ``-`` for every
    11th event, else ``floor(value)``. Every 97th event also yields a junk
    line that no pattern accepts.
    """
    eid = F.col("event_id")
    request = F.concat(
        F.lit("GET /"), F.col("event_type"), F.lit("/"), (eid % 50).cast("string"),
        F.lit(" HTTP/1.0"), F.when(eid % 7 == 0, F.lit(" ")).otherwise(F.lit("")),
    )
    size = F.when(eid % 11 == 0, F.lit("-")).otherwise(
        F.floor(F.col("value")).cast("bigint").cast("string")
    )
    status = F.when(F.col("event_type") == "error", F.lit("404")).otherwise(F.lit("200"))
    # The wall time from its parts: formatting would go through the session's zone.
    ts = F.col("ts").cast("timestamp_ntz")

    def two(part) -> F.Column:
        return F.lpad(part.cast("string"), 2, "0")

    month = F.element_at(F.array(*[F.lit(m) for m in MONTHS]), F.month(ts))
    stamp = F.concat(
        two(F.dayofmonth(ts)), F.lit("/"), month, F.lit("/"), F.lpad(F.year(ts).cast("string"), 4, "0"),
        F.lit(":"), two(F.hour(ts)), F.lit(":"), two(F.minute(ts)), F.lit(":"), two(F.second(ts)),
    )
    line = F.concat(
        F.lit("u"), F.col("user_id").cast("string"), F.lit(" - - ["), stamp, F.lit(' -0400] "'),
        request, F.lit('" '), status, F.lit(" "), size,
    )
    good = F.struct(eid.alias("line_id"), line.alias("value"))
    junk = F.struct((-eid - 1).alias("line_id"), F.concat(F.lit("junk line "), eid.cast("string")).alias("value"))
    both = F.when(eid % 97 == 0, F.array(good, junk)).otherwise(F.array(good))
    return events.select(F.explode(both).alias("e")).select("e.line_id", "e.value")


def _literal_line(spark: SparkSession, line_id: int | str, text: str) -> DataFrame:
    own = F.lit(line_id) if isinstance(line_id, str) else F.lit(line_id).cast("bigint")
    return spark.range(1).select(own.alias("line_id"), F.lit(text).alias("value"))


def product_lines(part: DataFrame) -> DataFrame:
    """Quoted CSV lines ``"id","title","description","manufacturer",price``
    from ``part`` (p_partkey, p_name, p_type, p_brand, p_retailprice), plus a
    header line."""
    q = F.lit('"')
    line = F.concat(
        q, F.col("p_partkey").cast("string"), F.lit('","'), F.col("p_name"),
        F.lit('","'), F.col("p_type"), F.lit('","'), F.col("p_brand"), F.lit('",'),
        F.col("p_retailprice").cast("string"),
    )
    rows = part.select(F.col("p_partkey").alias("line_id"), line.alias("value"))
    return _literal_line(part.sparkSession, -1, PRODUCT_HEADER).unionByName(rows)


def gold_lines(gold: DataFrame) -> DataFrame:
    """``"a_id","b_id"`` lines for a gold mapping, plus a header line."""
    line = F.concat(
        F.lit('"'), F.col("a_id").cast("string"), F.lit('","'),
        F.col("b_id").cast("string"), F.lit('"'),
    )
    own = F.concat_ws("-", F.col("a_id").cast("string"), F.col("b_id").cast("string"))
    rows = gold.select(own.alias("line_id"), line.alias("value"))
    return _literal_line(gold.sparkSession, "header", GOLD_HEADER).unionByName(rows)


def ratings(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """(user_id, item_id, rating): a customer's rating of a part.

    rating = max(l_quantity % 5 + 1) over the customer's line items of the
    part, so every (user, item) appears once. One shuffle join on the order
    key, then one partially-aggregated group-by.
    """
    li = lineitem.select("l_orderkey", "l_partkey", "l_quantity")
    od = orders.select("o_orderkey", "o_custkey")
    return (
        li.join(od, li.l_orderkey == od.o_orderkey)
        .groupBy(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id"))
        .agg(F.max(F.col("l_quantity") % 5 + 1).alias("rating"))
    )


def rating_lines(ratings_df: DataFrame) -> DataFrame:
    """``user::item::rating::timestamp`` lines (timestamp 0)."""
    return ratings_df.select(
        F.concat_ws(
            "::", F.col("user_id").cast("string"), F.col("item_id").cast("string"),
            F.col("rating").cast("string"), F.lit("0"),
        ).alias("value")
    )


def movies(part: DataFrame) -> DataFrame:
    """(item_id, title) from ``part``. Names repeat; ids break ties."""
    return part.select(F.col("p_partkey").alias("item_id"), F.col("p_name").alias("title"))


def movie_lines(part: DataFrame) -> DataFrame:
    """``id::title::genres`` lines from ``part`` (genres = p_type)."""
    return part.select(
        F.concat_ws(
            "::", F.col("p_partkey").cast("string"), F.col("p_name"), F.col("p_type")
        ).alias("value")
    )


def stopwords(spark: SparkSession) -> DataFrame:
    """The stopword list as a one-column (``token``) DataFrame."""
    return spark.createDataFrame([(w,) for w in STOPWORDS], "token string")


def records_a(documents: DataFrame) -> DataFrame:
    """Entity-resolution side A: (id, value) from ``documents``."""
    return documents.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("id"), F.col("text").alias("value"))


def records_b(benchmark: DataFrame) -> DataFrame:
    """Entity-resolution side B: (id, value) from ``benchmark``."""
    return benchmark.where(F.col("item_id").isNotNull()).select(F.col("item_id").alias("id"), F.col("text").alias("value"))


def _token_lists(records: DataFrame) -> DataFrame:
    """(id, tokens), stored: every branch of ``gold_pairs`` reads them, so each
    record is tokenized once."""
    return stored(records.select("id", simple_tokenize("value").alias("tokens")), "token-lists")


def _distinct_tokens(lists: DataFrame, id_alias: str) -> DataFrame:
    # explode_outer + null test: no inferred size() filter re-running the tokenizer.
    return lists.select(
        F.col("id").alias(id_alias), F.explode_outer(F.array_distinct("tokens")).alias("token")
    ).where(F.col("token").isNotNull())


def _token_text(lists: DataFrame, id_alias: str, text_alias: str) -> DataFrame:
    """The token sequence as one string with a space before and after every
    token, so containment of one in another is token-aligned."""
    # Non-nullable on purpose: a nullable expression here would let the
    # optimizer infer an ``isnotnull(<tokenizer>)`` filter from the
    # containment test and run the tokenizer again inside the scan.
    text = F.coalesce(F.concat(F.lit(" "), F.array_join("tokens", " "), F.lit(" ")), F.lit(""))
    return lists.select(F.col("id").alias(id_alias), text.alias(text_alias))


def gold_pairs(a: DataFrame, b: DataFrame) -> DataFrame:
    """(a_id, b_id): B records whose token sequence occurs in an A record.

    Exact and without a cross product: each B record is anchored on its
    token that is rarest in A (a containing A record must hold it), the
    anchor is equi-joined to A's (id, token) postings, and the candidates
    are verified with a substring test on the normalised token strings.
    The anchors are stored: knowing their size, Spark need not shuffle all
    postings of A where they are few.
    """
    a_lists, b_lists = _token_lists(a), _token_lists(b)
    a_tok = _distinct_tokens(a_lists, "a_id")
    b_tok = _distinct_tokens(b_lists, "b_id")
    a_df = a_tok.groupBy("token").agg(F.count(F.lit(1)).alias("df_a"))
    anchors = (
        lookup_join(b_tok, a_df, "token", "left")
        .groupBy("b_id")
        .agg(F.min(F.struct(F.coalesce("df_a", F.lit(0)).alias("df_a"), F.col("token"))).alias("least"))
        .select("b_id", "least.token", "least.df_a")
        .where("df_a > 0")
    )
    anchors = stored(anchors, "anchors")
    # Rows of both sides per anchor token: copies and templates share anchors.
    sizes = anchors.groupBy("token").agg(F.first("df_a").alias("df_a"), F.count(F.lit(1)).alias("n_b"))
    left = lookup_join(a_tok, sizes, "token")
    right = lookup_join(anchors.select("b_id", "token"), sizes, "token")
    candidates = grid_join(left, right, "token", "a_id", "b_id", "df_a", "n_b", PAIRS_PER_TASK).select("a_id", "b_id")
    # The shorter texts first, then A's, tested where they meet.
    return (
        candidates.join(_token_text(b_lists, "b_id", "b_text"), "b_id")
        .join(_token_text(a_lists, "a_id", "a_text"), "a_id")
        .where(F.col("a_text").contains(F.col("b_text")))
        .select("a_id", "b_id")
    )
