"""Rating summaries and collaborative-filtering recommendations.

``ratings`` is (user_id, item_id, rating); ``movies`` is (item_id, title).
Model fitting uses Spark ML's distributed ALS; everything around it is
DataFrame joins and aggregations.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.numeric import squared_error
from tessera.plans.stored import indexed, shuffles_dropped, stored
from tessera.session import checkpoint_dir

# ALS settings of the original jobs.
ALS_ITERATIONS = 5
ALS_REG = 0.1
ALS_SEED = 5
RANKS = (4, 8, 12)

# ALS sends a copy of nearly every factor to every block of the other side, in
# each iteration, so blocks are few. But a task holds a whole block, while it is
# made some 50 bytes a rating, and the factors it asks for: 100 MB and 150 MB
# (rank 12) at this number of ratings.
LEAST_BLOCKS = 3
RATINGS_PER_BLOCK = 2_000_000

# ALS drops the shuffle files of iterations behind a checkpoint. Fits of more
# than the least blocks have one in each iteration, small ones in the first only.
CHECKPOINT_EVERY = 10

# Fits of the least blocks that run side by side; each holds its ratings in
# memory and the factors of an iteration on disk, so larger ones run one by one.
FITS_AT_ONCE = 2


def count_and_average(ratings: DataFrame) -> DataFrame:
    """(item_id, n_ratings, avg_rating)."""
    return ratings.groupBy("item_id").agg(
        F.count(F.lit(1)).alias("n_ratings"), F.avg("rating").alias("avg_rating")
    )


item_count_avg = count_and_average


def item_counts(ratings: DataFrame) -> DataFrame:
    """(item_id, n_ratings)."""
    return ratings.groupBy("item_id").agg(F.count(F.lit(1)).alias("n_ratings"))


def mean_value(ratings: DataFrame, alias: str = "mean_rating") -> DataFrame:
    """One row: the mean rating."""
    return ratings.agg(F.avg("rating").alias(alias))


def add_ratings(train: DataFrame, mine: DataFrame) -> DataFrame:
    """Training ratings plus a user's own ratings (bag union by name)."""
    return train.unionByName(mine.select(*train.columns))


def with_titles(stats: DataFrame, movies: DataFrame) -> DataFrame:
    """Attach titles (inner join on item_id)."""
    return stats.join(movies.select("item_id", "title"), "item_id")


def _rating_order(avg: Column, title: Column, item: Column, digits: int = 3) -> list[Column]:
    # Descending on the rounded average, then on the title, then on the id:
    # a total order, so the top k is the same on every run.
    return [F.round(avg, digits).desc(), title.desc(), item.desc()]


def top_rated(ratings: DataFrame, movies: DataFrame, min_ratings: int = 500, k: int = 20) -> DataFrame:
    """(item_id, title, n_ratings, avg_rating): best average among items
    with more than ``min_ratings`` ratings."""
    stats = with_titles(count_and_average(ratings), movies).where(F.col("n_ratings") > min_ratings)
    return stats.orderBy(*_rating_order(F.col("avg_rating"), F.col("title"), F.col("item_id"))).limit(k)


def split_label() -> Column:
    """``train``, ``validation`` or ``test`` (60/20/20) by arithmetic on the
    key: remainders are taken before multiplying, so neither negative nor
    very large ids leave the rule."""
    user, item = (F.pmod(F.col(c), F.lit(10)) for c in ("user_id", "item_id"))
    bucket = F.pmod(user * 31 + item * 17, F.lit(10))
    return F.when(bucket < 6, F.lit("train")).when(bucket < 8, F.lit("validation")).otherwise(F.lit("test"))


def keyed_split(ratings: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Repeatable (train, validation, test) split (no randomness)."""
    return tuple(ratings.where(split_label() == name) for name in ("train", "validation", "test"))


def split_sizes(ratings: DataFrame) -> DataFrame:
    """(split, n): rows of each part, in one pass."""
    return ratings.groupBy(split_label().alias("split")).agg(F.count(F.lit(1)).alias("n"))


def random_split(ratings: DataFrame, weights: Sequence[float] = (6, 2, 2), seed: int = 0) -> list[DataFrame]:
    """Random split with the given weights: every row draws once, and a part
    has the draws of its range.

    Rows are stored with their draws, so the parts neither overlap nor miss a
    row whatever is computed anew, and none of them is sorted for it (Spark's
    ``randomSplit`` makes and sorts all rows once for each part).
    """
    if not weights or min(weights) < 0 or sum(weights) <= 0:
        raise ValueError("weights must not be negative, and one must be above 0")
    drawn = stored(ratings.withColumn("_draw", F.rand(seed)), "draws")
    ends = [sum(weights[: i + 1]) / sum(weights) for i in range(len(weights))]
    draw = F.col("_draw")
    part = F.lit(max(i for i, w in enumerate(weights) if w > 0))  # whatever the last end is rounded to
    for i in reversed(range(len(weights))):
        part = F.when(draw < ends[i], F.lit(i)).otherwise(part)
    return [drawn.where(part == i).drop("_draw") for i in range(len(weights))]


def rmse(predicted: DataFrame, actual: DataFrame) -> DataFrame:
    """One row: root mean squared error over (user, item) keys present in both.

    ``predicted`` has a ``prediction`` column, ``actual`` a ``rating``
    column; a key that repeats on a side counts once, with the mean of its
    values there.
    """
    keys = ["user_id", "item_id"]
    p = predicted.groupBy(*keys).agg(F.avg("prediction").alias("prediction"))
    r = actual.groupBy(*keys).agg(F.avg("rating").alias("rating"))
    return p.join(r, keys).agg(F.sqrt(F.avg(squared_error("prediction", "rating"))).alias("rmse"))


def als(rank: int, iterations: int = ALS_ITERATIONS, reg: float = ALS_REG, seed: int = ALS_SEED,
        blocks: int = LEAST_BLOCKS) -> ALS:
    return ALS(
        rank=rank, maxIter=iterations, regParam=reg, seed=seed, numUserBlocks=blocks, numItemBlocks=blocks,
        userCol="user", itemCol="item", ratingCol="rating",
        coldStartStrategy="drop", nonnegative=False, checkpointInterval=1 if blocks > LEAST_BLOCKS else CHECKPOINT_EVERY,
    )


@dataclass(frozen=True)
class Dictionary:
    """Stored (user_id, user) and (item_id, item): ALS takes int ids, tables
    have bigint ones."""

    users: DataFrame
    items: DataFrame

    def coded(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``user`` and ``item`` beside ``user_id`` and
        ``item_id``; rows with other ids are dropped."""
        return rows.join(self.users, "user_id").join(self.items, "item_id")


def dictionary(ratings: DataFrame) -> Dictionary:
    """Dense ids of all users and items of ``ratings``. Written once; fits,
    predictions and evaluations of a query read the same one."""
    parts = []
    for id_col, name in (("user_id", "user"), ("item_id", "item")):
        ids = ratings.select(id_col).where(F.col(id_col).isNotNull()).distinct()
        parts.append(indexed(ids, name, f"{name}-ids").select(id_col, F.col(name).cast("int").alias(name)))
    return Dictionary(*parts)


@dataclass(frozen=True)
class DenseRatings:
    """Stored (user, item, rating) with the ids they stand for, and the
    blocks of users and of items a fit cuts them into."""

    rows: DataFrame
    ids: Dictionary
    blocks: int = LEAST_BLOCKS


def dense(ratings: DataFrame, ids: Dictionary | None = None) -> DenseRatings:
    """``ratings`` in dense ids, stored for the fits that read them."""
    ids = ids or dictionary(ratings)
    rows = stored(ids.coded(ratings).select("user", "item", "rating"), "ratings")
    return DenseRatings(rows, ids, max(LEAST_BLOCKS, -(-rows.count() // RATINGS_PER_BLOCK)))


@dataclass(frozen=True)
class FittedALS:
    """A model over dense ids, and the ids they stand for."""

    model: ALSModel
    ids: Dictionary

    def user_factors(self) -> DataFrame:
        """(user_id, features)."""
        return self.model.userFactors.withColumnRenamed("id", "user").join(self.ids.users, "user").select("user_id", "features")

    def item_factors(self) -> DataFrame:
        """(item_id, features)."""
        return self.model.itemFactors.withColumnRenamed("id", "item").join(self.ids.items, "item").select("item_id", "features")


def train_als(train: DataFrame | DenseRatings, rank: int, iterations: int = ALS_ITERATIONS,
              reg: float = ALS_REG, seed: int = ALS_SEED) -> FittedALS:
    """Explicit-feedback ALS (Spark ML); ids may be any bigint.

    ALS cuts its iteration lineage, and drops the shuffle files behind it, by
    checkpointing every ``checkpointInterval`` iterations into the session's
    shared ``spark.checkpoint.dir``; make sure that folder is set.
    """
    if isinstance(train, DataFrame):
        train = dense(train)
    checkpoint_dir(train.rows.sparkSession)
    return FittedALS(als(rank, iterations, reg, seed, train.blocks).fit(train.rows), train.ids)


def predict_pairs(fitted: FittedALS, pairs: DataFrame) -> DataFrame:
    """(user_id, item_id, prediction); pairs with unknown ids are dropped."""
    coded = fitted.ids.coded(pairs.select("user_id", "item_id"))
    return fitted.model.transform(coded).select("user_id", "item_id", "prediction")


def select_rank(train: DataFrame | DenseRatings, validation: DataFrame, ranks: Sequence[int] = RANKS,
                iterations: int = ALS_ITERATIONS, reg: float = ALS_REG, seed: int = ALS_SEED) -> DataFrame:
    """(rank, rmse, best) of a model per rank on the validation set; ``best``
    marks the lowest error, of equal errors the lowest rank.

    Both sets are stored once in dense ids, and fits are jobs of their own;
    small ones run side by side, ``FITS_AT_ONCE`` at a time. A key that repeats
    in the validation set counts once, with its mean (as in ``rmse``). One
    number per rank comes to the driver.
    """
    if isinstance(train, DataFrame):
        train = dense(train)
    known = train.ids.coded(validation.groupBy("user_id", "item_id").agg(F.avg("rating").alias("rating")))
    known = stored(known.select("user", "item", "rating"), "validation")

    def error(rank: int) -> float | None:
        scored = train_als(train, rank, iterations, reg, seed).model.transform(known)
        return scored.agg(F.sqrt(F.avg(squared_error("prediction", "rating"))).alias("rmse")).first()["rmse"]

    with shuffles_dropped(known.sparkSession), ThreadPool(FITS_AT_ONCE if train.blocks <= LEAST_BLOCKS else 1) as pool:
        found = pool.map(inheritable_thread_target(known.sparkSession)(error), ranks, chunksize=1)
    errors = {int(r): None if e is None else float(e) for r, e in zip(ranks, found)}
    best = min((r for r, e in errors.items() if e is not None), key=lambda r: (errors[r], r), default=None)
    rows = [(r, e, r == best) for r, e in errors.items()]
    return known.sparkSession.createDataFrame(rows, "rank int, rmse double, best boolean")


def best_rank(train: DataFrame | DenseRatings, validation: DataFrame, **options) -> int:
    """The rank that ``select_rank`` marks."""
    row = select_rank(train, validation, **options).where("best").first()
    if row is None:
        raise ValueError("no rank can be scored: validation shares no user and item with train")
    return row["rank"]


def test_model(train: DataFrame | DenseRatings, test: DataFrame, rank: int, iterations: int = ALS_ITERATIONS,
               reg: float = ALS_REG, seed: int = ALS_SEED) -> DataFrame:
    """One row: RMSE on the test set of a model trained with ``rank``."""
    model = train_als(train, rank, iterations, reg, seed)
    return rmse(predict_pairs(model, test), test)


def retest_with_ratings(train: DataFrame, mine: DataFrame, test: DataFrame, rank: int,
                        ids: Dictionary | None = None, **options) -> DataFrame:
    """One row: RMSE on the test set after a user's own ratings joined
    training. ``ids`` must know the users and items of both."""
    return test_model(dense(add_ratings(train, mine), ids), test, rank, **options)


def mean_baseline_rmse(train: DataFrame, test: DataFrame) -> DataFrame:
    """One row: RMSE of predicting the training mean for every test rating."""
    mean = train.agg(F.avg("rating")).scalar()
    return test.agg(F.sqrt(F.avg(squared_error(F.lit(1.0) * mean, F.col("rating")))).alias("rmse"))


def items_for_user(ratings: DataFrame, movies: DataFrame, min_ratings: int = 500, k: int = 50) -> DataFrame:
    """Well-known items to offer a user for rating: top_rated with ids."""
    return top_rated(ratings, movies, min_ratings, k)


def unrated_items(ratings: DataFrame, movies: DataFrame, user_id) -> DataFrame:
    """(user_id, item_id) for every item the user has not rated (anti join)."""
    mine = ratings.where(F.col("user_id") == user_id).select("item_id")
    return movies.select("item_id").join(mine, "item_id", "left_anti").select(
        F.lit(user_id).cast("bigint").alias("user_id") if not isinstance(user_id, Column) else user_id.alias("user_id"),
        "item_id",
    )


def recommend_for_user(
    ratings: DataFrame,
    movies: DataFrame,
    user_id,
    my_ratings: DataFrame | None = None,
    rank: int = 8,
    min_ratings: int = 75,
    k: int | None = 25,
    iterations: int = ALS_ITERATIONS,
    reg: float = ALS_REG,
    seed: int = ALS_SEED,
    ids: Dictionary | None = None,
) -> DataFrame:
    """Top-k predicted items the user has not rated, among items with more
    than ``min_ratings`` ratings: (item_id, title, n_ratings, prediction).
    Only items with enough ratings are scored. Without ``k`` all of them are
    returned, in no order."""
    train = ratings if my_ratings is None else add_ratings(ratings, my_ratings)
    model = train_als(dense(train, ids), rank, iterations, reg, seed)
    known = item_counts(train).where(F.col("n_ratings") > min_ratings)
    candidates = unrated_items(train, movies, user_id).select("item_id").join(known, "item_id")
    # One user for all: as a scalar, for a join on a constant is a join without a key.
    user = model.ids.users.where(F.col("user_id") == user_id).select("user").scalar()
    asked = candidates.join(model.ids.items, "item_id").withColumn("user", user).where(F.col("user").isNotNull())
    found = (
        model.model.transform(asked).select("item_id", "n_ratings", "prediction")
        .join(movies.select("item_id", "title"), "item_id")
        .select("item_id", "title", "n_ratings", "prediction")
    )
    return found if k is None else found.orderBy(F.desc("prediction"), F.asc("item_id")).limit(k)
