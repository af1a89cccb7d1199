"""Bag-of-words TF-IDF, cosine similarity and scalable entity resolution.

Records are ``(id, value)`` DataFrames. Every vector lives in long form
``(id, token, weight)``; no dictionary is collected or broadcast by hand.

Plan shape of ``similarities`` (per side):
  records -> tokenize -> hash-partition by id (one exchange, reused)
  -> count per (id, token)                  (no shuffle: id-clustered)
  -> document frequency per token           (partial agg + shuffle)
  -> tf * idf (lookup join on token; AQE splits hot partitions)
  -> unit-length weights by a window on id
then one join of the two sides on token and one partially aggregated
group-by on (a_id, b_id). The pairs of a hot token are cut into a grid of
tasks (see ``grid_join``). Where records share so many tokens that token pairs
outnumber what a grid of blocks copies (``pair_blocks`` measures both), the
pairs are summed cell by cell instead, without a shuffle of token pairs
(``block_cells``). With a least similarity only pairs that can reach it are
made (``threshold_candidates``). Postings of tokens that the other side lacks
make no pair and stay out of both joins.

The queries hold both sides as ``Packed`` counts instead: the functions here
take them where they take rows, and no posting of A is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.text import tokenize
from tessera.llm.common import ship
from tessera.operators import cells
from tessera.operators import packed as pk
from tessera.operators.packed import Packed, Weights
from tessera.plans.joins import block_cells, block_shape, grid_join, lookup_join
from tessera.sources.fixtures import STOPWORDS

# Target number of candidate pairs produced by one join task for a hot token.
PAIRS_PER_TASK = 2_000_000

# Pairs of records in a cell of the block join.
PAIRS_PER_CELL = 100_000

# Bounds of pruning are taken so much lower than the threshold: sums of
# doubles depend on their order.
SLACK = 1e-9

_IDS = ("a_id", "b_id")


def record_tokens(
    records: DataFrame, stopwords: Iterable[str] = STOPWORDS, id_col: str = "id", text_col: str = "value"
) -> DataFrame:
    """(id, tokens): the token list of every record (duplicates kept)."""
    return records.select(F.col(id_col).alias("id"), tokenize(text_col, stopwords).alias("tokens"))


def drop_stopwords(tokens_long: DataFrame, stopwords: DataFrame, col: str = "token") -> DataFrame:
    """Long-form tokens without those in a stopword DataFrame (``token``
    column): a left anti join, broadcast by AQE only when the list is
    measured small."""
    return tokens_long.join(stopwords.select(F.col("token").alias(col)).distinct(), col, "left_anti")


def token_total(*token_frames: DataFrame) -> DataFrame:
    """One row: the number of tokens over several (id, tokens) frames."""
    total = None
    for df in token_frames:
        part = df.select(F.size("tokens").cast("bigint").alias("n"))
        total = part if total is None else total.unionByName(part)
    return total.agg(F.sum("n").alias("total_tokens"))


def biggest_record(tokens: DataFrame) -> DataFrame:
    """(id, n_tokens) of the record with the most tokens (lowest id on ties)."""
    return (
        tokens.select("id", F.size("tokens").alias("n_tokens"))
        .orderBy(F.desc("n_tokens"), F.asc("id"))
        .limit(1)
    )


def clustered_tokens(records: DataFrame, stopwords: Iterable[str] = STOPWORDS, partitions: int | None = None) -> DataFrame:
    """(id, tokens) hash-partitioned by id: the one exchange every TF / IDF
    consumer reads (Spark reuses it, so each record is tokenized once).

    The tokenizer runs in the scan and the exchange carries token lists (no
    separators, no stopwords). ``partitions`` spreads the records before
    that, for a source with fewer splits than cores.
    """
    if partitions:
        records = records.repartition(partitions, F.xxhash64("id"))
    return record_tokens(records, stopwords).repartition("id")


def _exploded(tokens: DataFrame, distinct: bool = False) -> DataFrame:
    # explode_outer + a null test keeps the optimizer from inferring a
    # ``size(tokens) > 0`` filter that would re-run the tokenizer.
    arr = F.array_distinct("tokens") if distinct else F.col("tokens")
    return tokens.select(
        "id", F.size("tokens").alias("n_tokens"), F.explode_outer(arr).alias("token")
    ).where(F.col("token").isNotNull())


def term_frequency_of(tokens: DataFrame | Packed) -> DataFrame | Packed:
    """(id, token, n_tokens, n, tf) from id-clustered (id, tokens); packed
    tokens hold these counts already.

    The record length rides along with every token, so no per-record join
    or window is needed, and the count per (id, token) needs no shuffle.
    """
    if isinstance(tokens, Packed):
        return tokens
    return (
        _exploded(tokens).groupBy("id", "token", "n_tokens")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("tf", F.col("n") / F.col("n_tokens"))
    )


def term_frequency(records: DataFrame, stopwords: Iterable[str] = STOPWORDS) -> DataFrame:
    """(id, token, n_tokens, n, tf): tf = occurrences / tokens of the record."""
    return term_frequency_of(clustered_tokens(records, stopwords))


def record_count(records: DataFrame) -> DataFrame:
    return records.agg(F.count_distinct("id").alias("n_records"))


def inverse_document_frequency(token_frames: Sequence[DataFrame | Packed]) -> DataFrame:
    """(token, df, df_0, df_1, ..., idf) over the union of several corpora.

    Input: one (id, tokens) frame per corpus (one row per record, empty
    records included). idf = N / df (no logarithm), N = number of records of
    all corpora, df = number of records holding the token; the per-corpus
    counts ``df_i`` are kept for skew planning. Each record contributes its
    distinct tokens once, partially aggregated before the shuffle; N is a
    scalar subquery.
    """
    tagged = None
    for i, toks in enumerate(token_frames):
        held = toks.frequencies() if isinstance(toks, Packed) else _exploded(toks, distinct=True).withColumn("n", F.lit(1).cast("bigint"))
        part = held.select("token", "n", F.lit(i).alias("_src"))
        tagged = part if tagged is None else tagged.unionByName(part)
    per_corpus = [F.sum(F.when(F.col("_src") == i, F.col("n")).otherwise(0)).alias(f"df_{i}") for i in range(len(token_frames))]
    n_total = None
    for toks in token_frames:
        n = F.lit(toks.n_records) if isinstance(toks, Packed) else toks.agg(F.count_distinct("id")).scalar()
        n_total = n if n_total is None else n_total + n
    return (
        tagged.groupBy("token")
        .agg(F.sum("n").alias("df"), *per_corpus)
        .withColumn("idf", n_total / F.col("df"))
    )


def smallest_idf(idf: DataFrame, k: int = 11) -> DataFrame:
    """The k tokens with the smallest IDF (the most common tokens)."""
    return idf.select("token", "idf").orderBy(F.asc("idf"), F.asc("token")).limit(k)


def idf_histogram(idf: DataFrame, bins: int = 50) -> DataFrame:
    """(bucket, lower, count): equal-width histogram of the IDF values.

    The maximum falls in the last bucket. Range bounds come from scalar
    subqueries; the histogram is one partially aggregated group-by.
    """
    lo = idf.agg(F.min("idf")).scalar()
    hi = idf.agg(F.max("idf")).scalar()
    width = (hi - lo) / bins
    bucket = F.when(hi == lo, F.lit(0)).otherwise(
        F.least(F.floor((F.col("idf") - lo) / width), F.lit(bins - 1))
    ).cast("int")
    return (
        idf.groupBy(bucket.alias("bucket"))
        .agg(F.count(F.lit(1)).alias("count"))
        .withColumn("lower", lo + F.col("bucket") * width)
        .orderBy("bucket")
    )


def tfidf(tf: DataFrame | Packed, idf: DataFrame) -> DataFrame | Weights:
    """(id, token, weight, df_0, df_1, ...): tf * idf; of packed counts as
    ``Weights``, whose blocks look up their distinct tokens.

    A lookup join on token: the vocabulary has no size bound, so the idf
    table is never broadcast by hand, and AQE splits the partitions that
    hot tokens fill.
    """
    if isinstance(tf, Packed):
        return pk.weights(tf, idf)
    extra = [c for c in idf.columns if c.startswith("df_")]
    joined = lookup_join(tf.select("id", "token", "tf"), idf.select("token", "idf", *extra), "token")
    return joined.select("id", "token", (F.col("tf") * F.col("idf")).alias("weight"), *extra)


def vector_norms(weights: DataFrame) -> DataFrame:
    """(id, norm): Euclidean norm of each weight vector."""
    return weights.groupBy("id").agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"))


def unit_weights(weights: DataFrame | Weights) -> DataFrame | Weights:
    """Adds ``norm`` and ``unit`` = weight / norm (window on id; blocks make
    them when they are read)."""
    if isinstance(weights, Weights):
        return weights
    w = Window.partitionBy("id")
    norm = F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(w))
    return weights.withColumn("norm", norm).withColumn("unit", F.try_divide(F.col("weight"), F.col("norm")))


def inverted_index(tokens: DataFrame) -> DataFrame:
    """(token, id): which records hold each token, from (id, tokens)."""
    return _exploded(tokens, distinct=True).select("token", "id")


def long_form(weights: DataFrame | Weights, *values: str, meets: str | None = None) -> DataFrame:
    """(id, token, values) as rows."""
    if isinstance(weights, Weights):
        return weights.rows(*values, meets=meets)
    return (weights.where(F.col(meets) > 0) if meets else weights).select("id", "token", *values)


def _pair_postings(
    a_w: DataFrame | Weights, b_w: DataFrame | Weights, value_col: str, pairs_per_task: int
) -> DataFrame:
    """Join the A and B postings on token; ``a_w`` and ``b_w`` carry ``df_0``
    (postings of the token in A) and ``df_1`` (in B), from which the pairs of
    a hot token are cut into tasks of about ``pairs_per_task`` pairs."""
    a_w = long_form(a_w, value_col, "df_0", "df_1", meets="df_1")
    b_w = long_form(b_w, value_col, "df_0", "df_1", meets="df_0")
    a = a_w.select(F.col("id").alias("a_id"), "token", F.col(value_col).alias("a_value"), "df_0", "df_1")
    b = b_w.select(F.col("id").alias("b_id"), "token", F.col(value_col).alias("b_value"), "df_0", "df_1")
    return grid_join(a, b, "token", "a_id", "b_id", "df_0", "df_1", pairs_per_task)


def token_pairs(a_w: DataFrame, b_w: DataFrame, pairs_per_task: int = PAIRS_PER_TASK) -> DataFrame:
    """(token, a_id, b_id): the inverted-index join, one row per shared token."""
    return _pair_postings(a_w, b_w, "weight", pairs_per_task).select("token", "a_id", "b_id")


join_tokens = token_pairs


def build_corpus(*token_frames: DataFrame) -> DataFrame:
    """(src, id, tokens): several (id, tokens) frames as one bag, tagged with
    the position of their frame (ids of different sources may collide)."""
    out = None
    for i, df in enumerate(token_frames):
        part = df.select(F.lit(i).alias("src"), "id", "tokens")
        out = part if out is None else out.unionByName(part)
    return out


def pair_blocks(
    idf: DataFrame, a_records: DataFrame, b_records: DataFrame, pairs_per_cell: int = PAIRS_PER_CELL
) -> tuple[int, int] | None:
    """Rows and columns of a block join of the two sides, or None where the
    token join moves fewer rows.

    The token join shuffles a row for every token that a pair shares, the
    block join a copy of A's postings for every column and of B's for every
    row. Both numbers follow from the document frequencies; one row comes to
    the driver.
    """
    d0, d1 = F.col("df_0").cast("double"), F.col("df_1").cast("double")
    n = idf.agg(F.sum(d0 * d1).alias("met"), F.sum(d0).alias("a"), F.sum(d1).alias("b")).first()
    rows, columns = block_shape(a_records.count(), b_records.count(), pairs_per_cell)
    copies = (n["a"] or 0.0) * columns + (n["b"] or 0.0) * rows
    return (rows, columns) if (n["met"] or 0.0) > copies else None


def _in_cells(
    a_w: DataFrame | Weights, b_w: DataFrame | Weights, values: Sequence[str], blocks: tuple[int, int], run: cells.Run, *more: T.StructField
) -> DataFrame:
    """(a_id, b_id, ...) by ``run`` on the cells of a block join of the
    postings that can meet one of the other side. Packed records are the
    blocks of their side; others are cut into ``blocks``."""
    def ids(w: DataFrame | Weights) -> T.DataType:
        return w.counts.id_type if isinstance(w, Weights) else w.schema["id"].dataType

    schema = T.StructType([T.StructField("a_id", ids(a_w)), T.StructField("b_id", ids(b_w)), *more])
    b = long_form(b_w, *values, meets="df_0").withColumnRenamed("id", "b_id")
    if isinstance(a_w, Weights):
        postings = b_w.counts.postings if isinstance(b_w, Weights) else b.count()
        return a_w.meet(b, postings, values, run, schema)
    ship(b.sparkSession)
    a = long_form(a_w, *values, meets="df_1").withColumnRenamed("id", "a_id")
    return block_cells(a, b, "a_id", "b_id", *blocks, run, schema)


def _summed_products(
    a_w: DataFrame | Weights, b_w: DataFrame | Weights, value_col: str, name: str, blocks: tuple[int, int] | None, pairs_per_task: int
) -> DataFrame:
    """(a_id, b_id, ``name``): the sum of products over the shared tokens of
    every pair that shares one, by one of the two joins."""
    if blocks:
        return _in_cells(a_w, b_w, [value_col], blocks, cells.summed(_IDS, value_col, name), T.StructField(name, T.DoubleType()))
    joined = _pair_postings(a_w, b_w, value_col, pairs_per_task)
    return joined.groupBy("a_id", "b_id").agg(F.sum(F.col("a_value") * F.col("b_value")).alias(name))


def similarities(
    a_w: DataFrame | Weights, b_w: DataFrame | Weights, pairs_per_task: int = PAIRS_PER_TASK, blocks: tuple[int, int] | None = None, min_similarity: float = 0.0
) -> DataFrame:
    """(a_id, b_id, similarity) for every pair sharing at least one token and
    of at least ``min_similarity``.

    ``a_w`` / ``b_w`` are ``tfidf`` outputs (with ``df_0``/``df_1``). The
    cosine is the sum of products of unit weights over shared tokens, so no
    per-pair norm lookup (and no extra join) is needed.
    """
    if min_similarity > 0:
        return threshold_join(a_w, b_w, [min_similarity], pairs_per_task, blocks).drop("threshold")
    return _summed_products(unit_weights(a_w), unit_weights(b_w), "unit", "similarity", blocks, pairs_per_task)


def _rests(units: DataFrame | Weights) -> DataFrame | Weights:
    """Adds ``rest``: the length of what is left of each vector from a token
    on, from rare to common. The window runs from the common end: one that
    looks ahead is summed anew for every row. Blocks make it when they are read."""
    if isinstance(units, Weights):
        return units
    from_end = Window.partitionBy("id").orderBy(F.desc(F.col("df_0") + F.col("df_1")), F.desc("token")).rowsBetween(Window.unboundedPreceding, 0)
    return units.withColumn("rest", F.sqrt(F.sum(F.col("unit") * F.col("unit")).over(from_end)))


def _prefixes(units: DataFrame | Weights, min_similarity: float) -> DataFrame:
    """(id, token, rest, df_0, df_1): the rarest tokens of each vector, as far
    as what is left from a token on (``rest``, its length) can still make the
    least similarity with a vector of length one."""
    return long_form(_rests(units), "rest", "df_0", "df_1").where(F.col("rest") >= min_similarity - SLACK)


def threshold_candidates(a_u: DataFrame | Weights, b_u: DataFrame | Weights, min_similarity: float, pairs_per_task: int = PAIRS_PER_TASK) -> DataFrame:
    """(a_id, b_id) of all pairs that can have ``min_similarity``, from unit
    weights with document frequencies.

    Both sides order tokens from rare to common. Take the first token that a
    pair shares: all that it shares lies from there on in both vectors, so its
    cosine is at most the product of the two rests. A pair is made only where
    that bound holds, and only prefixes whose own rest reaches the least
    similarity are indexed; common tokens mostly fall out. No pair is lost.
    """
    met = _pair_postings(_prefixes(a_u, min_similarity), _prefixes(b_u, min_similarity), "rest", pairs_per_task)
    return met.where(F.col("a_value") * F.col("b_value") >= min_similarity - SLACK).select("a_id", "b_id").distinct()


def _scored(pairs: DataFrame, a_u: DataFrame, b_u: DataFrame) -> DataFrame:
    """(a_id, b_id, similarity) of pairs that share a token, over all their tokens."""
    a = long_form(a_u, "unit").select(F.col("id").alias("a_id"), "token", F.col("unit").alias("a_unit"))
    b = long_form(b_u, "unit").select(F.col("id").alias("b_id"), "token", F.col("unit").alias("b_unit"))
    met = pairs.join(a, "a_id").join(b, ["b_id", "token"])
    return met.groupBy("a_id", "b_id").agg(F.sum(F.col("a_unit") * F.col("b_unit")).alias("similarity"))


def threshold_scores(
    a_w: DataFrame | Weights, b_w: DataFrame | Weights, thresholds: Sequence[float], pairs_per_task: int = PAIRS_PER_TASK, blocks: tuple[int, int] | None = None
) -> DataFrame:
    """(threshold, a_id, b_id, similarity): for each threshold the pairs of
    ``threshold_candidates``, scored over all their tokens; in cells of a block
    join for all thresholds at once."""
    a_u, b_u = unit_weights(a_w), unit_weights(b_w)
    cols, levels = ("threshold", "a_id", "b_id", "similarity"), [float(t) for t in thresholds]
    if blocks:
        double = [T.StructField(c, T.DoubleType()) for c in ("threshold", "similarity")]
        return _in_cells(_rests(a_u), _rests(b_u), ["unit", "rest"], blocks, cells.above(_IDS, levels, SLACK), *double).select(*cols)
    out = None
    for t in levels:
        scored = _scored(threshold_candidates(a_u, b_u, t, pairs_per_task), a_u, b_u)
        part = scored.withColumn("threshold", F.lit(t)).select(*cols)
        out = part if out is None else out.unionByName(part)
    return out


def threshold_join(
    a_w: DataFrame | Weights, b_w: DataFrame | Weights, thresholds: Sequence[float], pairs_per_task: int = PAIRS_PER_TASK, blocks: tuple[int, int] | None = None
) -> DataFrame:
    """(threshold, a_id, b_id, similarity): for each threshold the pairs of at
    least that similarity."""
    return threshold_scores(a_w, b_w, thresholds, pairs_per_task, blocks).where(F.col("similarity") >= F.col("threshold"))


def threshold_report(
    a_w: DataFrame | Weights, b_w: DataFrame | Weights, thresholds: Sequence[float], pairs_per_task: int = PAIRS_PER_TASK, blocks: tuple[int, int] | None = None
) -> DataFrame:
    """(threshold, candidates, pairs): how many pairs the pruned join makes
    and keeps for each threshold."""
    t, sim = F.col("threshold"), F.col("similarity")
    counts = [c for x in thresholds for c in (F.count_if(t == float(x)), F.count_if((t == float(x)) & (sim >= float(x))))]
    found = threshold_scores(a_w, b_w, thresholds, pairs_per_task, blocks).agg(*[c.alias(f"n{i}") for i, c in enumerate(counts)])
    rows = [F.struct(F.lit(float(x)).alias("threshold"), F.col(f"n{2 * i}").alias("candidates"), F.col(f"n{2 * i + 1}").alias("pairs")) for i, x in enumerate(thresholds)]
    return found.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def dot_products(
    a_w: DataFrame | Weights, b_w: DataFrame | Weights, pairs_per_task: int = PAIRS_PER_TASK, blocks: tuple[int, int] | None = None
) -> DataFrame:
    """(a_id, b_id, dot): raw dot products over shared tokens."""
    return _summed_products(a_w, b_w, "weight", "dot", blocks, pairs_per_task)


def common_tokens(
    a_w: DataFrame | Weights, b_w: DataFrame | Weights, pairs_per_task: int = PAIRS_PER_TASK, blocks: tuple[int, int] | None = None
) -> DataFrame:
    """(a_id, b_id, tokens): the sorted shared tokens of each candidate pair.

    A list is at most as long as the smaller record's vocabulary.
    """
    if blocks:
        tokens = T.StructField("tokens", T.ArrayType(T.StringType()))
        return _in_cells(a_w, b_w, [], blocks, cells.listed(_IDS, "tokens"), tokens)
    joined = _pair_postings(a_w, b_w, "weight", pairs_per_task)
    return joined.groupBy("a_id", "b_id").agg(F.sort_array(F.collect_list("token")).alias("tokens"))


def er_weights(
    a_records: DataFrame, b_records: DataFrame, stopwords: Iterable[str] = STOPWORDS
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(A weights, B weights, idf) with the IDF of the union of both sides."""
    tok_a = clustered_tokens(a_records, stopwords)
    tok_b = clustered_tokens(b_records, stopwords)
    idf = inverse_document_frequency([tok_a, tok_b])
    return tfidf(term_frequency_of(tok_a), idf), tfidf(term_frequency_of(tok_b), idf), idf


def scalable_similarity(
    a_records: DataFrame,
    b_records: DataFrame,
    stopwords: Iterable[str] = STOPWORDS,
    pairs_per_task: int = PAIRS_PER_TASK,
    blocks: tuple[int, int] | None = None,
    min_similarity: float = 0.0,
) -> DataFrame:
    """Entity resolution: (a_id, b_id, similarity) for all candidate pairs.

    A pair is a candidate when the two records share a token; the cosine of
    every other pair is 0 and is not materialised. With ``min_similarity``
    only pairs of at least that much are returned, and hardly any other is made.
    """
    a_w, b_w, _ = er_weights(a_records, b_records, stopwords)
    return similarities(a_w, b_w, pairs_per_task, blocks, min_similarity)


def pair_similarity(
    a_tokens: DataFrame, b_tokens: DataFrame, idf: DataFrame, pairs: DataFrame, sharing_only: bool = False
) -> DataFrame:
    """(a_id, b_id, similarity) of the requested pairs; 0 when no token is
    shared (``sharing_only``: such pairs are left out).

    Starts from the pairs: only the records they name get weights, A's unit
    weights are joined on a_id, B's on (b_id, token), and products are summed
    per pair. The work is pairs x tokens per record; no other pair is scored.
    """
    asked = pairs.select("a_id", "b_id").distinct()

    def units(tokens: DataFrame, id_col: str) -> DataFrame:
        named = tokens.join(asked.select(F.col(id_col).alias("id")).distinct(), "id", "left_semi")
        return unit_weights(tfidf(term_frequency_of(named), idf)).select(
            F.col("id").alias(id_col), "token", F.col("unit").alias(f"{id_col}_unit")
        )

    met = asked.join(units(a_tokens, "a_id"), "a_id").join(units(b_tokens, "b_id"), ["b_id", "token"])
    sums = met.groupBy("a_id", "b_id").agg(F.sum(F.col("a_id_unit") * F.col("b_id_unit")).alias("similarity"))
    if sharing_only:
        return pairs.select("a_id", "b_id").join(sums, ["a_id", "b_id"])
    return pairs.select("a_id", "b_id").join(sums, ["a_id", "b_id"], "left").select(
        "a_id", "b_id", F.coalesce(F.col("similarity"), F.lit(0.0)).alias("similarity")
    )


def similarity_total(a_w: DataFrame | Weights, b_w: DataFrame | Weights) -> DataFrame:
    """One row: the sum of the similarities of all A x B pairs. It factors by
    token, (sum of A's unit weights) x (sum of B's), so no pair is made."""
    def sums(w: DataFrame | Weights, other: str, name: str) -> DataFrame:
        if isinstance(w, Weights):
            return unit_weights(w).token_sums("unit", name, other)
        return unit_weights(w).where(F.col(other) > 0).groupBy("token").agg(F.sum("unit").alias(name))

    return sums(a_w, "df_1", "sa").join(sums(b_w, "df_0", "sb"), "token").agg(
        F.coalesce(F.sum(F.col("sa") * F.col("sb")), F.lit(0.0)).alias("total")
    )
