"""TF-IDF, cosine and entity-resolution invariants against brute force."""

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tessera.operators import evaluation as ev
from tessera.operators import similarity as sm
from tessera.sources import fixtures as fx
from tessera.sources.tables import Tables

A = [(1, "Adobe Photoshop CS3 image editing"), (2, "Microsoft Office word processing suite"),
     (3, "Adobe Illustrator vector drawing"), (4, ""), (5, "the the the")]
B = [(10, "Photoshop by Adobe"), (11, "office suite for word processing"), (12, "garden hose"),
     (13, "vector drawing program")]


def records(spark, rows):
    return spark.createDataFrame(rows, "id long, value string")


def py_tokens(s, stop=fx.STOPWORDS):
    return [t for t in (x.lower() for x in re.split(r"[^a-zA-Z0-9_]+", s)) if t and t not in stop]


def brute_force(a_rows, b_rows):
    """Cosine of every A x B pair, dictionaries in Python (the textbook way)."""
    ta = {i: py_tokens(v) for i, v in a_rows}
    tb = {i: py_tokens(v) for i, v in b_rows}
    n = len(ta) + len(tb)
    df = Counter()
    for toks in list(ta.values()) + list(tb.values()):
        df.update(set(toks))
    idf = {t: n / c for t, c in df.items()}

    def weights(toks):
        c = Counter(toks)
        return {t: (k / len(toks)) * idf[t] for t, k in c.items()}

    wa = {i: weights(t) for i, t in ta.items() if t}
    wb = {i: weights(t) for i, t in tb.items() if t}
    out = {}
    for i, x in wa.items():
        for j, y in wb.items():
            dot = sum(v * y.get(t, 0.0) for t, v in x.items())
            if any(t in y for t in x):
                out[(i, j)] = dot / (math.sqrt(sum(v * v for v in x.values())) *
                                     math.sqrt(sum(v * v for v in y.values())))
    return out


def test_tf_literal(spark):
    tf = sm.term_frequency(records(spark, [(1, "one_ one_ two!")]))
    got = {r.token: r.tf for r in tf.collect()}
    assert got == pytest.approx({"one_": 2 / 3, "two": 1 / 3})


def test_dot_and_norm_literal(spark):
    a = spark.createDataFrame([(1, "foo", 2.0), (1, "bar", 3.0), (1, "baz", 5.0)], "id long, token string, weight double")
    b = spark.createDataFrame([(2, "foo", 1.0), (2, "bar", 0.0), (2, "baz", 20.0)], "id long, token string, weight double")
    a = a.withColumn("df_0", F.lit(1)).withColumn("df_1", F.lit(1))
    b = b.withColumn("df_0", F.lit(1)).withColumn("df_1", F.lit(1))
    assert sm.dot_products(a, b).first().dot == pytest.approx(102.0)
    assert sm.vector_norms(a).first().norm == pytest.approx(6.164414, abs=1e-6)


def test_inverted_index_literal(spark):
    tokens = spark.createDataFrame([(1, ["foo", "foo"]), (2, [])], "id long, tokens array<string>")
    assert [tuple(r) for r in sm.inverted_index(tokens).collect()] == [("foo", 1)]


def test_scalable_equals_brute_force(spark):
    expected = brute_force(A, B)
    got = {(r.a_id, r.b_id): r.similarity for r in sm.scalable_similarity(records(spark, A), records(spark, B)).collect()}
    assert got.keys() == expected.keys()
    for k, v in expected.items():
        assert got[k] == pytest.approx(v, rel=1e-9)


def test_salting_is_exact(spark):
    """Forcing every token to be 'hot' (tiny task budget) gives the same scores."""
    a, b = records(spark, A), records(spark, B)
    plain = {(r.a_id, r.b_id): r.similarity for r in sm.scalable_similarity(a, b).collect()}
    salted = {(r.a_id, r.b_id): r.similarity for r in sm.scalable_similarity(a, b, pairs_per_task=1).collect()}
    assert plain.keys() == salted.keys()
    for k in plain:
        assert salted[k] == pytest.approx(plain[k], rel=1e-12)


def test_common_tokens_and_pair_similarity(spark):
    a, b = records(spark, A), records(spark, B)
    a_w, b_w, _ = sm.er_weights(a, b)
    common = {(r.a_id, r.b_id): r.tokens for r in sm.common_tokens(a_w, b_w).collect()}
    assert common[(1, 10)] == ["adobe", "photoshop"]
    tok_a, tok_b = sm.clustered_tokens(a, partitions=3), sm.clustered_tokens(b)
    idf = sm.inverse_document_frequency([tok_a, tok_b])
    pairs = spark.createDataFrame([(1, 10), (1, 12), (99, 10), (2, 11), (2, 11)], "a_id long, b_id long")
    got = [(r.a_id, r.b_id, r.similarity) for r in sm.pair_similarity(tok_a, tok_b, idf, pairs).collect()]
    every = brute_force(A, B)
    assert sorted(got) == sorted((x, y, pytest.approx(every.get((x, y), 0.0))) for x, y in [(1, 10), (1, 12), (99, 10), (2, 11), (2, 11)])
    only = {(r.a_id, r.b_id) for r in sm.pair_similarity(tok_a, tok_b, idf, pairs, sharing_only=True).collect()}
    assert only == {(1, 10), (2, 11)}
    assert sm.similarity_total(a_w, b_w).first().total == pytest.approx(sum(every.values()))


def brute_sweep(sims, gold, n_a, n_b, n=100):
    gold_scores = [sims.get(g, 0.0) for g in gold]
    fp_bins = [0] * (n + 1)
    for s in sims.values():
        b = int(s * n)
        if 0 <= b <= n:
            fp_bins[b] += 1
    for s in gold_scores:
        b = int(s * n)
        if 0 <= b <= n:
            fp_bins[b] -= 1
    rows = []
    for i in range(n):
        t = float(i) / n
        fp = sum(fp_bins[b] for b in range(n + 1) if float(b) / n >= t)
        fn = sum(1 for s in gold_scores if s < t)
        tp = len(gold_scores) - fn
        rows.append((t, tp, fp, fn))
    return rows


def test_threshold_sweep_and_gold_eval_brute_force(spark):
    a, b = records(spark, A), records(spark, B)
    sims_df = sm.scalable_similarity(a, b)
    sims = {(r.a_id, r.b_id): r.similarity for r in sims_df.collect()}
    gold_pairs = [(1, 10), (2, 11), (3, 13), (4, 12)]  # (4, 12) shares no token: score 0
    gold = spark.createDataFrame(gold_pairs, "a_id long, b_id long")
    expected = brute_sweep(sims, gold_pairs, len(A), len(B))
    got = [(r.threshold, r.tp, r.fp, r.fn) for r in ev.threshold_sweep(sims_df, gold).collect()]
    assert got == expected
    tok_a, tok_b = sm.clustered_tokens(a), sm.clustered_tokens(b)
    idf = sm.inverse_document_frequency([tok_a, tok_b])
    a_w, b_w, _ = sm.er_weights(a, b)
    row = ev.gold_evaluation(ev.gold_similarities(tok_a, tok_b, idf, gold), sm.similarity_total(a_w, b_w), a, b).first()
    g = [sims.get(p, 0.0) for p in gold_pairs]
    assert row.n_true_duplicates == 4
    assert row.avg_sim_duplicates == pytest.approx(sum(g) / 4)
    assert row.avg_sim_non_duplicates == pytest.approx((sum(sims.values()) - sum(g)) / (len(A) * len(B) - 4))


def test_gold_fixture_matches_containment(spark):
    t = Tables(spark, "/root/testdata/sf0.001")
    a, b = fx.records_a(t.documents), fx.records_b(t.benchmark)
    got = {(r.a_id, r.b_id) for r in fx.gold_pairs(a, b).collect()}
    da = {r.id: " " + " ".join(py_tokens(r.value, ())) + " " for r in a.collect()}
    db = {r.id: " " + " ".join(py_tokens(r.value, ())) + " " for r in b.collect() if py_tokens(r.value, ())}
    expected = {(i, j) for i, x in da.items() for j, y in db.items() if y in x}
    assert got == expected


def test_salt_count_of_huge_work(spark):
    from tessera.plans.joins import salt_count

    rows = [(1e16, 5.0), (1e19, 1e12), (1e30, 1e18), (0.0, 3.0), (10.0, 0.0)]
    df = spark.createDataFrame(rows, "work double, most double")
    got = [r[0] for r in df.select(salt_count(F.col("work"), 2_000_000, F.col("most"))).collect()]
    assert got == [5, 10**12, 10**18, 1, 1]
    longs = spark.createDataFrame([(3_000_000_000, 3_000_000_000)], "a long, b long")
    work = F.col("a").cast("double") * F.col("b").cast("double")
    assert longs.select(salt_count(work, 2_000_000)).first()[0] == 4_500_000_000_000


@pytest.mark.parametrize("n_left,n_right", [(300, 4), (4, 300), (60, 60), (1, 500)])
def test_grid_join_is_exact_and_copies_little(spark, n_left, n_right):
    from tessera.plans.joins import grid_join

    left = spark.createDataFrame([(i, "hot", n_left, n_right) for i in range(n_left)] + [(9999, "cold", 1, 1)], "a long, k string, l long, r long")
    right = spark.createDataFrame([(i, "hot", n_left, n_right) for i in range(n_right)] + [(9999, "cold", 1, 1)], "b long, k string, l long, r long")
    out = grid_join(left, right, "k", "a", "b", "l", "r", pairs_per_task=50)
    assert out.columns == ["k", "a", "b"]
    got = sorted((r.a, r.b) for r in out.collect())
    assert got == sorted([(x, y) for x in range(n_left) for y in range(n_right)] + [(9999, 9999)])
    # Rows that enter the join, copies included: far fewer than the pairs.
    from math import ceil, sqrt
    cells = ceil(n_left * n_right / 50)
    rows = max(1, ceil(min(sqrt(cells * n_left / n_right), cells, n_left)))
    columns = max(1, ceil(min(cells / rows, n_right)))
    assert n_left * columns + n_right * rows <= 3 * (n_left + n_right) + 4 * sqrt(n_left * n_right * cells)


def test_resolve_and_evaluate_checkpointed(spark):
    a, b = records(spark, A), records(spark, B)
    gold = spark.createDataFrame([(1, 10), (2, 11), (3, 13)], "a_id long, b_id long")
    sims, evaluation, sweep = ev.resolve_and_evaluate(a, b, gold)
    direct = {(r.a_id, r.b_id): r.similarity for r in sm.scalable_similarity(a, b).collect()}
    assert {(r.a_id, r.b_id): r.similarity for r in sims.collect()} == pytest.approx(direct)
    assert evaluation.first().n_true_duplicates == 3
    assert sweep.count() == 100


def test_salting_splits_the_larger_side(spark):
    """B much larger than A for a shared hot token: still exact."""
    a_rows = [(1, "alpha beta"), (2, "beta gamma")]
    b_rows = [(100 + i, f"beta word{i % 7} gamma") for i in range(60)]
    a, b = records(spark, a_rows), records(spark, b_rows)
    expected = brute_force(a_rows, b_rows)
    got = {(r.a_id, r.b_id): r.similarity for r in sm.scalable_similarity(a, b, pairs_per_task=3).collect()}
    assert got.keys() == expected.keys()
    for k, v in expected.items():
        assert got[k] == pytest.approx(v, rel=1e-9)
