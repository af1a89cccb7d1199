"""Evaluation of entity-resolution scores against a gold mapping.

``sims`` holds the candidate pairs (a_id, b_id, similarity); every pair
that is not a candidate has similarity 0. ``gold`` holds (a_id, b_id).
Nothing here builds the |A| x |B| product: zero-similarity pairs are
accounted for arithmetically.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.numeric import similarity_bin
from tessera.operators import similarity as sm
from tessera.operators.similarity import pair_similarity
from tessera.session import checkpoint_dir

KEYS = ["a_id", "b_id"]


def true_duplicates(a_tokens: DataFrame, b_tokens: DataFrame, idf: DataFrame, gold: DataFrame) -> DataFrame:
    """Gold pairs that share a token, with their similarity."""
    return pair_similarity(a_tokens, b_tokens, idf, gold, sharing_only=True)


def non_duplicates(sims: DataFrame, gold: DataFrame) -> DataFrame:
    """Candidate pairs that are not in the gold mapping (anti join)."""
    return sims.join(gold.select(*KEYS), KEYS, "left_anti")


def gold_similarities(a_tokens: DataFrame, b_tokens: DataFrame, idf: DataFrame, gold: DataFrame) -> DataFrame:
    """(a_id, b_id, similarity) for every gold pair; 0 when not a candidate."""
    return pair_similarity(a_tokens, b_tokens, idf, gold)


def scored_pairs(sims: DataFrame, gold: DataFrame) -> DataFrame:
    """Every candidate pair and whether it is a gold pair: (a_id, b_id,
    similarity, is_gold). Gold pairs that are no candidates have similarity 0
    and are counted, not made, so that a small gold mapping is broadcast and no
    candidate is shuffled."""
    g = gold.select(*KEYS, F.lit(True).alias("_gold"))
    return sims.select(*KEYS, "similarity").join(g, KEYS, "left").select(
        *KEYS, "similarity", F.coalesce(F.col("_gold"), F.lit(False)).alias("is_gold")
    )


def gold_evaluation(gold_sims: DataFrame, all_sum: DataFrame, a_records: DataFrame, b_records: DataFrame) -> DataFrame:
    """One row over all |A| x |B| pairs (zeros implied):

    n_true_duplicates, avg_sim_duplicates (over ``gold_sims``, zero when not
    a candidate), avg_sim_non_duplicates = (sum over all pairs - sum over
    gold pairs) / (|A| * |B| - gold pairs). The sum over all pairs comes
    from ``similarity_total``, so no table of pairs is made.
    """
    n_a = a_records.agg(F.count_distinct("id")).scalar()
    n_b = b_records.agg(F.count_distinct("id")).scalar()
    total = all_sum.select("total").scalar()
    totals = gold_sims.agg(F.count(F.lit(1)).alias("n_true_duplicates"), F.sum("similarity").alias("_gold_sum"))
    n = F.col("n_true_duplicates").cast("double")
    return totals.select(
        "n_true_duplicates",
        F.try_divide(F.col("_gold_sum"), n).alias("avg_sim_duplicates"),
        F.try_divide(
            total - F.coalesce(F.col("_gold_sum"), F.lit(0.0)), F.lit(1.0) * n_a * n_b - n
        ).alias("avg_sim_non_duplicates"),
    )


def _first_threshold_above(x, n: int):
    """Smallest i with x < i / n, exactly (float division as written):
    floor(x * n) is within one of it, so test the neighbours in order."""
    k0 = F.floor(x * n).cast("long")
    nf = F.lit(float(n))
    return (
        F.when(x < (k0 - 1) / nf, k0 - 1)
        .when(x < k0 / nf, k0)
        .when(x < (k0 + 1) / nf, k0 + 1)
        .otherwise(k0 + 2)
    )


def threshold_sweep(sims: DataFrame, gold: DataFrame, n_thresholds: int = 100) -> DataFrame:
    """Precision / recall / F-measure for thresholds t = i / n, i = 0..n-1.

      fp(t) = sum over bins b with b / n >= t of (candidates with
              int(sim * n) == b) - (gold pairs in bin b; a gold pair that
              is not a candidate has sim 0); bins outside 0..n are dropped;
      fn(t) = gold pairs with sim < t (exact comparison);
      tp(t) = gold pairs - fn(t).

    One pass: candidates are counted by bin and, if gold, by the first
    threshold they fall below; at most ~n * n small rows are left of them. Every
    gold pair counts as one of similarity 0, which the candidates among them
    take back. Signed sums of these counts by bin and threshold are at most ~2n
    rows, and running sums over those give every threshold at once. The data
    are never paired with the thresholds.
    """
    n = n_thresholds
    spark = sims.sparkSession
    x, is_gold = F.col("similarity"), F.col("is_gold")
    above = F.greatest(_first_threshold_above(x, n), F.lit(0))
    counts = (
        scored_pairs(sims, gold)
        .groupBy(similarity_bin(x, n).cast("long").alias("bin"), F.when(is_gold, above).alias("above"), "is_gold")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    at_zero = F.greatest(_first_threshold_above(F.lit(0.0), n), F.lit(0))

    def event(kind: str, idx, v) -> F.Column:
        return F.struct(F.lit(kind).alias("kind"), idx.cast("long").alias("idx"), v.cast("long").alias("v"))

    own, mine = F.col("n"), is_gold.cast("long")
    candidates = counts.select(F.explode(F.array(
        event("fp", F.col("bin"), own * (1 - mine)), event("fp", F.lit(0), own * mine),
        event("fn", F.col("above"), own * mine), event("fn", at_zero, -own * mine),
    )).alias("e"))
    true = gold.agg(F.count(F.lit(1)).alias("n")).select(F.explode(F.array(event("fp", F.lit(0), -own), event("fn", at_zero, own))).alias("e"))
    events = candidates.unionByName(true).select("e.kind", "e.idx", "e.v")
    events = events.where((F.col("v") != 0) & ((F.col("kind") == "fn") | F.col("idx").between(0, n)))
    # Fixed bound: the threshold grid has n + 1 rows per kind.
    grid = spark.range(0, n + 1).select(
        F.explode(F.array(F.lit("fp"), F.lit("fn"))).alias("kind"), F.col("id").alias("idx"), F.lit(0).cast("long").alias("v")
    )
    per_key = events.unionByName(grid).groupBy("kind", "idx").agg(F.sum("v").alias("v"))
    by_kind = Window.partitionBy("kind")
    running = per_key.select(
        "kind", "idx",
        F.sum("v").over(by_kind.orderBy(F.desc("idx")).rowsBetween(Window.unboundedPreceding, 0)).alias("from_top"),
        F.sum("v").over(by_kind.orderBy("idx").rowsBetween(Window.unboundedPreceding, 0)).alias("from_bottom"),
        F.sum("v").over(by_kind).alias("total"),
    ).where(F.col("idx") < n)
    fp = running.where(F.col("kind") == "fp").select(F.col("idx").alias("i"), F.col("from_top").alias("fp"))
    fn = running.where(F.col("kind") == "fn").select(
        F.col("idx").alias("i"), F.col("from_bottom").alias("fn"), F.col("total").alias("n_gold")
    )
    out = fn.join(F.broadcast(fp), "i").select(
        (F.col("i") / F.lit(float(n))).alias("threshold"),
        (F.col("n_gold") - F.col("fn")).cast("bigint").alias("tp"),
        F.col("fp").cast("bigint").alias("fp"),
        F.col("fn").cast("bigint").alias("fn"),
    )
    tp, fp_c, fn_c = F.col("tp").cast("double"), F.col("fp").cast("double"), F.col("fn").cast("double")
    out = out.withColumn("precision", F.try_divide(tp, tp + fp_c)).withColumn("recall", F.try_divide(tp, tp + fn_c))
    fmeasure = F.try_divide(2 * F.col("recall") * F.col("precision"), F.col("recall") + F.col("precision"))
    return out.withColumn("fmeasure", fmeasure).orderBy("threshold")


def resolve_and_evaluate(
    a_records: DataFrame,
    b_records: DataFrame,
    gold: DataFrame,
    n_thresholds: int = 100,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Entity resolution plus both evaluations over one scored table.

    The candidate similarities are computed once and checkpointed to the
    session's shared ``spark.checkpoint.dir`` (a reliable checkpoint: it
    cuts the long lineage, and a lost executor does not force the whole
    similarity job to re-run). Returns (sims, gold_evaluation,
    threshold_sweep).
    """
    checkpoint_dir(a_records.sparkSession)
    tok_a, tok_b = sm.clustered_tokens(a_records), sm.clustered_tokens(b_records)
    idf = sm.inverse_document_frequency([tok_a, tok_b])
    a_w, b_w = sm.tfidf(sm.term_frequency_of(tok_a), idf), sm.tfidf(sm.term_frequency_of(tok_b), idf)
    sims = sm.similarities(a_w, b_w).checkpoint(eager=True)
    return (
        sims,
        gold_evaluation(gold_similarities(tok_a, tok_b, idf, gold), sm.similarity_total(a_w, b_w), a_records, b_records),
        threshold_sweep(sims, gold, n_thresholds),
    )
