"""Rating summaries, RMSE and ALS."""

import pytest
from pyspark.sql import functions as F

from tessera.operators import basic
from tessera.operators import recommend as rc
from tessera.plans.catalog import Ctx
from tessera.sources import fixtures as fx
from tessera.sources.parsers import parse_movies, parse_ratings
from tessera.sources.tables import Tables

SCHEMA_P = "user_id long, item_id long, prediction double"
SCHEMA_A = "user_id long, item_id long, rating double"


def test_count_and_average_literals(spark):
    rows = [(1, 1, 1.0), (2, 1, 2.0), (3, 1, 3.0), (4, 1, 4.0), (1, 100, 10.0), (2, 100, 20.0), (3, 100, 30.0)]
    got = {r.item_id: (r.n_ratings, r.avg_rating) for r in rc.count_and_average(spark.createDataFrame(rows, SCHEMA_A)).collect()}
    assert got == {1: (4, 2.5), 100: (3, 20.0)}


def test_rmse_literals(spark):
    pred = spark.createDataFrame([(1, 1, 5.0), (1, 2, 3.0), (1, 3, 4.0), (2, 1, 3.0), (2, 2, 2.0), (2, 3, 4.0)], SCHEMA_P)
    actual = spark.createDataFrame([(1, 2, 3.0), (1, 3, 5.0), (2, 1, 5.0), (2, 2, 1.0)], SCHEMA_A)
    pred2 = spark.createDataFrame([(2, 2, 5.0), (1, 2, 5.0)], SCHEMA_P)
    assert rc.rmse(pred, actual).first().rmse == pytest.approx(1.22474487139, abs=1e-8)
    assert rc.rmse(pred2, actual).first().rmse == pytest.approx(3.16227766017, abs=1e-8)
    same = actual.withColumnRenamed("rating", "prediction")
    assert rc.rmse(same, actual).first().rmse == pytest.approx(0.0, abs=1e-8)


def test_stable_sort_is_order_independent(spark):
    one = [(1.0, "alpha"), (2.0, "alpha"), (2.0, "beta"), (3.0, "alpha"), (1.0, "epsilon"), (1.0, "delta")]
    two = [(1.0, "delta"), (2.0, "alpha"), (2.0, "beta"), (3.0, "alpha"), (1.0, "epsilon"), (1.0, "alpha")]
    s1 = basic.stable_sort(spark.createDataFrame(one, "k double, v string"), "k", "v").collect()
    s2 = basic.stable_sort(spark.createDataFrame(two, "k double, v string"), "k", "v").collect()
    assert [tuple(r) for r in s1] == [tuple(r) for r in s2]
    assert [tuple(r) for r in s1][:2] == [(1.0, "alpha"), (1.0, "delta")]


def test_line_parsers(spark):
    lines = spark.createDataFrame([("1::1193::5::978300760",), ("bad",)], "value string")
    got = [tuple(r) for r in parse_ratings(lines).collect()]
    assert got == [(1, 1193, 5.0), (None, None, None)]
    movies = spark.createDataFrame([("1::Toy Story (1995)::Animation|Children's",)], "value string")
    assert [tuple(r) for r in parse_movies(movies).collect()] == [(1, "Toy Story (1995)")]


def test_keyed_split_partitions_all(spark):
    t = Tables(spark, "/root/testdata/sf0.001")
    ratings = fx.ratings(t.lineitem, t.orders)
    parts = rc.keyed_split(ratings)
    assert sum(p.count() for p in parts) == ratings.count()
    # every (user, item) appears once
    assert ratings.groupBy("user_id", "item_id").count().where(F.col("count") > 1).count() == 0


def test_als_pipeline_smoke(spark):
    t = Tables(spark, "/root/testdata/sf0.001")
    ratings = fx.ratings(t.lineitem, t.orders)
    movies = fx.movies(t.part)
    train, val, test = rc.keyed_split(ratings)
    ranks = rc.select_rank(train, val, ranks=(2, 4), iterations=2)
    rows = ranks.collect()
    assert [r["rank"] for r in rows] == [2, 4] and all(r.rmse is not None and r.rmse > 0 for r in rows)
    best = min(rows, key=lambda r: (r.rmse, r["rank"]))
    assert [r["rank"] for r in rows if r.best] == [best["rank"]] == [rc.best_rank(train, val, ranks=(2, 4), iterations=2)]
    assert rc.test_model(train, test, best["rank"], iterations=2).first().rmse > 0
    user = ratings.agg(F.min("user_id")).first()[0]
    recs = rc.recommend_for_user(ratings, movies, user, rank=2, iterations=2, min_ratings=0, k=5).collect()
    assert len(recs) == 5
    scores = [r.prediction for r in recs]
    assert scores == sorted(scores, reverse=True)
    rated = {r.item_id for r in ratings.where(F.col("user_id") == user).collect()}
    assert not rated & {r.item_id for r in recs}
    assert rc.mean_baseline_rmse(train, test).first().rmse > 0


def test_add_ratings_size_invariant(spark):
    t = Tables(spark, "/root/testdata/sf0.001")
    ratings = fx.ratings(t.lineitem, t.orders)
    train, _, test = rc.keyed_split(ratings)
    user = ratings.agg(F.min("user_id")).first()[0]
    mine = test.where(F.col("user_id") == user)
    assert rc.add_ratings(train, mine).count() == train.count() + mine.count()
    assert rc.item_counts(ratings).agg(F.sum("n_ratings")).first()[0] == ratings.count()
    assert rc.mean_value(ratings).first().mean_rating == pytest.approx(ratings.agg(F.avg("rating")).first()[0])


def test_stable_sort_descending_is_total(spark):
    rows = [(3.0004, "a"), (3.0001, "b"), (2.0, "z"), (3.0, "c")]
    got = [tuple(r) for r in basic.stable_sort(spark.createDataFrame(rows, "k double, v string"), "k", "v",
                                                ascending=False).collect()]
    # 3.0004, 3.0001 and 3.0 all round to 3.000, so the value breaks the tie (descending)
    assert [v for _, v in got] == ["c", "b", "a", "z"]


def test_rmse_of_repeated_keys_does_not_depend_on_order(spark):
    for order in ([3.0, 5.0], [5.0, 3.0]):
        pred = spark.createDataFrame([(1, 1, p) for p in order], SCHEMA_P)
        actual = spark.createDataFrame([(1, 1, 4.0), (1, 1, 2.0)], SCHEMA_A)
        assert rc.rmse(pred, actual).first().rmse == pytest.approx(1.0)


def test_split_of_negative_and_huge_ids(spark):
    rows = [(-i, 9_223_372_036_854_775_000 + i % 7, 1.0) for i in range(2000)]
    sizes = {r.split: r.n for r in rc.split_sizes(spark.createDataFrame(rows, SCHEMA_A)).collect()}
    assert sum(sizes.values()) == 2000 and sizes["train"] > 1000 and min(sizes.values()) > 300


def test_ids_beyond_int(spark):
    big = 3_000_000_000
    rows = [(big + u, -big - i, float((u * i) % 5 + 1)) for u in range(12) for i in range(10) if (u + i) % 4]
    ratings = spark.createDataFrame(rows, SCHEMA_A)
    fitted = rc.train_als(ratings, rank=2, iterations=2)
    assert {r.user_id for r in fitted.user_factors().collect()} == {r[0] for r in rows}
    assert {r.item_id for r in fitted.item_factors().collect()} == {r[1] for r in rows}
    asked = ratings.unionByName(spark.createDataFrame([(1, 2, 3.0)], SCHEMA_A))
    assert rc.predict_pairs(fitted, asked).count() == len(rows)


def test_own_ratings_change_the_model(spark):
    t = Tables(spark, "/root/testdata/sf0.001")
    ratings = fx.ratings(t.lineitem, t.orders)
    train, val, test = rc.keyed_split(ratings)
    user = ratings.agg(F.min("user_id")).first()[0]
    mine = val.where(F.col("user_id") == user)
    assert rc.retest_with_ratings(train, mine, test, rank=2, iterations=2).first().rmse > 0
    recs = rc.recommend_for_user(train, fx.movies(t.part), user, mine, rank=2, iterations=2, min_ratings=0, k=1000).collect()
    rated = {r.item_id for r in rc.add_ratings(train, mine).where(F.col("user_id") == user).collect()}
    assert recs and not rated & {r.item_id for r in recs}


def test_stable_sort_breaks_ties_by_id(spark):
    rows = [(1.0, "a", i) for i in (3, 1, 2)]
    got = basic.stable_sort(spark.createDataFrame(rows, "k double, v string, id int"), "k", "v", ids=["id"]).collect()
    assert [r.id for r in got] == [1, 2, 3]


def test_random_split_deals_every_row_once_and_sorts_nothing(spark):
    rows = [(i % 50, i % 7, float(i % 3)) for i in range(600)] + [(None, None, None)] * 30
    ratings = spark.createDataFrame(rows, SCHEMA_A).repartition(3)
    parts = rc.random_split(ratings, (6, 2, 2), seed=3)
    order = lambda r: [(x is not None, x) for x in r]
    got = [[tuple(r) for r in p.collect()] for p in parts]
    assert sorted((r for p in got for r in p), key=order) == sorted(rows, key=order)
    assert len(got[0]) > len(got[1]) + len(got[2]) > 150 and parts[0].columns == ratings.columns
    assert all("Sort" not in p._jdf.queryExecution().executedPlan().toString() for p in parts)
    assert [p.count() for p in rc.random_split(ratings, (0, 1, 0))] == [0, 630, 0]
    with pytest.raises(ValueError, match="negative"):
        rc.random_split(ratings, (1, -1))


def test_fits_cut_ratings_into_few_blocks(spark, monkeypatch):
    rows = [(u, i, float((u * i) % 5 + 1)) for u in range(12) for i in range(10)]
    ratings = spark.createDataFrame(rows, SCHEMA_A)
    assert rc.dense(ratings).blocks == 3 and rc.als(2).getNumUserBlocks() == rc.als(2).getNumItemBlocks() == 3
    monkeypatch.setattr(rc, "RATINGS_PER_BLOCK", 25)
    train = rc.dense(ratings)
    assert train.blocks == 5
    assert rc.predict_pairs(rc.train_als(train, rank=2, iterations=2), ratings).count() == 120


def test_blocks_of_a_fit_stay_small_whatever_the_ratings(spark, monkeypatch):
    """A task holds a whole block, so its ratings have a bound, and a fit of
    many blocks drops the factors that earlier iterations sent."""
    assert rc.RATINGS_PER_BLOCK <= 5_000_000
    assert rc.als(2).getCheckpointInterval() == 10 and rc.als(2, blocks=8).getCheckpointInterval() == 1
    monkeypatch.setattr(rc, "RATINGS_PER_BLOCK", 25)
    rows = [(u, i, float((u * i) % 5 + 1)) for u in range(12) for i in range(10)]
    ratings = spark.createDataFrame(rows, SCHEMA_A)
    sizes = []
    monkeypatch.setattr(rc, "ThreadPool", lambda n: sizes.append(n) or pool(n))
    pool = __import__("multiprocessing.pool", fromlist=["ThreadPool"]).ThreadPool
    many = {r["rank"]: r.rmse for r in rc.select_rank(ratings, ratings, ranks=(1, 2), iterations=3).collect()}
    monkeypatch.setattr(rc, "RATINGS_PER_BLOCK", 1000)
    few = {r["rank"]: r.rmse for r in rc.select_rank(ratings, ratings, ranks=(1, 2), iterations=3).collect()}
    assert sizes == [1, rc.FITS_AT_ONCE] and many.keys() == few.keys() == {1, 2}
    assert all(0 < x < 2 for x in (*many.values(), *few.values()))


def test_queries_of_fits_make_ratings_once(spark):
    c = Ctx(spark, "/root/testdata/sf0.001")
    for part in (*c.stored_splits, c.ids.users, c.dense_train.rows):
        plan = part._jdf.queryExecution().optimizedPlan().toString()
        assert "lineitem" not in plan and "l_orderkey" not in plan
    assert c.stored_ratings.count() == c.ratings.count()
