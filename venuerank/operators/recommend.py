"""Collaborative filtering: rating matrix, factor model, recommendations and their metrics."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venuerank import schemas
from venuerank.functions.hashing import draw
from venuerank.functions.scoring import status
from venuerank.operators import factors
from venuerank.operators.ranking import ordered_position, top_per_group
from venuerank.operators.sampling import split_by_key
from venuerank.session import ensure_checkpoint_dir, materialise

RANK, ITERATIONS, REGULARISATION = 20, 10, 0.1
TOP_N = 10
SEED = 42
MAX_RMSE = 1.5
BLOCK_RATINGS, SMALL_BLOCK = 1_000_000, 20_000  # of a factor block, and where there are cores to spare
FEW_BLOCKS, FULL_BLOCK = 12, 8_000_000  # blocks beyond which they grow first, and ratings of one at most
CHECKPOINT_INTERVAL = 2  # a checkpoint also frees the shuffle files of the steps before


class RatingMatrix(NamedTuple):
    ratings: DataFrame     # user_idx, business_idx, stars, and any kept column
    users: DataFrame       # user_id, user_idx
    businesses: DataFrame  # business_id, business_idx


def dense_index(df: DataFrame, column: str, index: str) -> DataFrame:
    """Integer index of every value, most frequent first, ties in alphabetical order.

    The same numbering as a string indexer, but the labels stay distributed.
    """
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_seen"))
    placed = ordered_position(counts, [F.col("_seen").desc(), F.col(column).asc()], index)
    return placed.select(column, F.col(index).cast("int").alias(index))


def build_user_item_matrix(ratings: DataFrame, keep: tuple[str, ...] = ()) -> RatingMatrix:
    users = dense_index(ratings, "user_id", "user_idx")
    businesses = dense_index(ratings, "business_id", "business_idx")
    matrix = (
        ratings.join(users, "user_id").join(businesses, "business_id")
        .select("user_idx", "business_idx", F.col("stars").cast("float").alias("stars"), *keep)
    )
    return RatingMatrix(matrix, users, businesses)


def _blocks(ratings: DataFrame) -> int:
    """Factor blocks where none are given: by the number of ratings, and enough to keep the cores busy.

    A fit sends each user's factors to every block that holds one of their venues, and all-user recommendations meet every block of
    users with every block of venues, so blocks by the session's shuffle partitions would multiply both. From FEW_BLOCKS on blocks
    take more ratings before there are more of them, as copies of a factor are most of what a fit shuffles.
    """
    rows = ratings.count()
    cores = ratings.sparkSession.sparkContext.defaultParallelism
    few = min(-(-rows // BLOCK_RATINGS), max(FEW_BLOCKS, -(-rows // FULL_BLOCK)))
    return max(1, few, min(cores, -(-rows // SMALL_BLOCK)))


def _als(rank: int, iterations: int, regularisation: float, blocks: int) -> ALS:
    als = ALS(
        userCol="user_idx", itemCol="business_idx", ratingCol="stars",
        rank=rank, maxIter=iterations, regParam=regularisation,
        nonnegative=True, coldStartStrategy="drop", seed=SEED,
        checkpointInterval=CHECKPOINT_INTERVAL,
    )
    return als.setNumBlocks(blocks)


def train_als(
    train: DataFrame, rank: int = RANK, max_iter: int = ITERATIONS, reg_param: float = REGULARISATION,
    blocks: int | None = None,
) -> ALSModel:
    ensure_checkpoint_dir(train.sparkSession)
    return _als(rank, max_iter, reg_param, blocks or _blocks(train)).fit(train)


def rmse_evaluator() -> RegressionEvaluator:
    return RegressionEvaluator(metricName="rmse", labelCol="stars", predictionCol="prediction")


def grid_search(
    train: DataFrame, ranks: tuple[int, ...] = (10, 20), reg_params: tuple[float, ...] = (0.01, 0.1),
    max_iter: int = ITERATIONS, folds: int = 2, parallelism: int = 2, key: str = "review_id", blocks: int | None = None,
) -> tuple[ALSModel, DataFrame]:
    """Best model by cross-validated RMSE, and `rank, reg_param, rmse, is_best` of the grid.

    A rating's fold hangs on its `key` alone, so the folds don't depend on partitioning.
    """
    spark = train.sparkSession
    ensure_checkpoint_dir(spark)
    als = _als(RANK, max_iter, REGULARISATION, blocks or _blocks(train))
    number = F.conv(F.substring(draw(F.col(key), SEED + 1), 1, 8), 16, 10).cast("long")
    train = train.withColumn("fold", (number % folds).cast("int"))
    grid = ParamGridBuilder().addGrid(als.rank, list(ranks)).addGrid(als.regParam, list(reg_params)).build()
    search = CrossValidator(
        estimator=als, estimatorParamMaps=grid, evaluator=rmse_evaluator(),
        numFolds=folds, parallelism=parallelism, seed=SEED, foldCol="fold",
    )
    fitted = search.fit(train)
    rows = [(int(p[als.rank]), float(p[als.regParam]), float(m)) for p, m in zip(grid, fitted.avgMetrics)]
    best = min(rows, key=lambda row: row[2])
    table = spark.createDataFrame(
        [(*row, row == best) for row in rows], "rank int, reg_param double, rmse double, is_best boolean"
    )
    return fitted.bestModel, table


def real_predictions(predictions: DataFrame, column: str = "prediction") -> DataFrame:
    return predictions.filter(F.col(column).isNotNull() & ~F.isnan(column))


def evaluate_rmse(model: ALSModel, test: DataFrame) -> float:
    return rmse_evaluator().evaluate(real_predictions(model.transform(test)))


def rmse_table(predictions: DataFrame, actual: str, predicted: str) -> DataFrame:
    error = F.col(actual) - F.col(predicted)
    rmse = F.sqrt(F.avg(error * error))
    return real_predictions(predictions, predicted).agg(rmse.alias("rmse")).withColumn(
        "status", status(F.col("rmse"), F.col("rmse") < MAX_RMSE)
    )


def rank_sweep(
    train: DataFrame, test: DataFrame, ranks: tuple[int, ...] = (5, 10, 20), max_iter: int = ITERATIONS,
) -> DataFrame:
    """`rank, rmse, is_best` for models of several sizes."""
    rows = [(rank, evaluate_rmse(train_als(train, rank, max_iter), test)) for rank in ranks]
    table = train.sparkSession.createDataFrame(rows, "rank int, rmse double")
    return table.withColumn("is_best", F.col("rank") == best_rank(table).scalar())


def best_rank(sweep: DataFrame) -> DataFrame:
    return sweep.agg(F.min_by("rank", "rmse").alias("rank"))


def generate_recommendations(
    model: ALSModel, matrix: RatingMatrix, top_n: int = TOP_N, exclude_rated: bool = False, bounded: bool = True
) -> DataFrame:
    """`user_id, business_id, predicted_rating, rank` of the best `top_n` venues per user.

    A batch option for all users among all venues, with the results of the library's `recommendForAllUsers`, ties going to the
    venue of the smaller index. Its work grows with users times venues, less the products that can't reach a place; unless
    `bounded` every one is worked out. Only each user's best leave a task. `recommend_for_requests` asks for what is wanted.

    Venues the user has rated stay in, unless `exclude_rated` drops them; ranks then keep
    their gaps.
    """
    best = factors.best_items(model.userFactors, model.itemFactors, model.rank, top_n, bounded=bounded).rows
    ranked = best.select(
        F.col("user").alias("user_idx"), F.col("item").alias("business_idx"), F.col("score").cast("float").alias("predicted_rating"), "rank"
    )
    ranked = real_predictions(ranked, "predicted_rating")
    if exclude_rated:
        ranked = ranked.join(matrix.ratings.select("user_idx", "business_idx"), ["user_idx", "business_idx"], "left_anti")
    return (
        ranked.join(matrix.users, "user_idx").join(matrix.businesses, "business_idx")
        .select(*schemas.RECOMMENDATION_COLUMNS)
    )


def recommend_for_requests(
    model: ALSModel, matrix: RatingMatrix, requests: DataFrame, venues: DataFrame, top_n: int = TOP_N
) -> DataFrame:
    """The best `top_n` venues of the metro of each of `requests(user_id, metro_area)`, of `venues(business_id, metro_area)`.

    A request meets the venues of its metro only, in the bounded search over factors, so no pair becomes a row; ties go
    to the smaller business_id.
    """
    asked = requests.select("user_id", "metro_area").distinct().join(matrix.users, "user_id").join(model.userFactors.withColumnRenamed("id", "user_idx"), "user_idx")
    known = matrix.businesses.join(model.itemFactors.withColumnRenamed("id", "business_idx"), "business_idx").select("business_id", "features")
    known = materialise(ordered_position(known, [F.asc("business_id")], "place"), "known-venues")
    offered = venues.select("business_id", "metro_area").distinct().join(known, "business_id")
    best = factors.best_in_scopes(
        asked.select(F.col("metro_area").alias("scope"), F.col("user_idx").alias("id"), "features"),
        offered.select(F.col("metro_area").alias("scope"), F.col("place").alias("id"), "features"), model.rank, top_n,
    ).rows.select(F.col("scope").alias("metro_area"), F.col("user").alias("user_idx"), F.col("item").alias("place"), F.col("score").cast("float").alias("predicted_rating"), "rank")
    named = materialise(best, "best-of-requests").join(matrix.users, "user_idx").join(known.select("place", "business_id"), "place")
    return named.select("user_id", "metro_area", "business_id", "predicted_rating", "rank")


def stored_matrix(ratings: DataFrame, key: str) -> RatingMatrix:
    """The rating matrix with its key, written once for all fits."""
    matrix = build_user_item_matrix(ratings, (key,))
    return RatingMatrix(*[materialise(table, name) for table, name in zip(matrix, ("ratings", "users", "venues"))])


def fit_and_recommend(
    ratings: DataFrame, key: str, top_n: int = TOP_N, cross_validate: bool = False, **params
) -> tuple[DataFrame, DataFrame]:
    """Recommendations from a model trained on 80 % of the ratings, and its RMSE on the rest.

    `params` go to `train_als`, or to `grid_search` when the model is chosen by cross-validation.
    """
    matrix = stored_matrix(ratings, key)
    train, test = split_by_key(matrix.ratings, key)
    model = grid_search(train, key=key, **params)[0] if cross_validate else train_als(train, **params)
    rmse = rmse_table(model.transform(test), "stars", "prediction")
    return generate_recommendations(model, matrix, top_n), rmse


def predicted_precision_at_k(recommendations: DataFrame, k: int = 10, threshold: float = 4.0) -> DataFrame:
    """Mean over users of the share of their first `k` whose predicted rating is high; 0 if none."""
    relevant: Column = (F.col("predicted_rating") >= threshold).cast("int")
    per_user = (
        recommendations.filter(F.col("rank") <= k).groupBy("user_id").agg(F.avg(relevant).alias("share"))
    )
    return per_user.agg(F.coalesce(F.avg("share"), F.lit(0.0)).alias("precision_at_k"))


def matrix_size(ratings: DataFrame) -> DataFrame:
    """How many ratings, users and venues there are; each is counted alone, so no rating is multiplied."""
    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("what"), "n")

    distinct = [ratings.select(c).filter(F.col(c).isNotNull()).distinct() for c in ("user_id", "business_id")]
    rows = counted(ratings, "ratings").unionByName(counted(distinct[0], "users")).unionByName(counted(distinct[1], "businesses"))
    return rows.agg(*[F.max(F.when(F.col("what") == c, F.col("n"))).alias(c) for c in ("ratings", "users", "businesses")])
