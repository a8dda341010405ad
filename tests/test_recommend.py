import pytest
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from venuerank.operators import recommend
from venuerank.operators.sampling import split_by_key

RATINGS = [("u1", "b1", 5.0), ("u1", "b2", 3.0), ("u1", "b3", 4.0), ("u2", "b1", 4.0), ("u2", "b2", 2.0),
           ("u2", "b4", 5.0), ("u3", "b2", 3.0), ("u3", "b3", 5.0), ("u3", "b4", 4.0), ("u3", "b1", 1.0)]


@pytest.fixture(scope="module")
def ratings(spark):
    return spark.createDataFrame(RATINGS, "user_id string, business_id string, stars double").cache()


@pytest.fixture(scope="module")
def matrix(ratings):
    return recommend.build_user_item_matrix(ratings)


@pytest.fixture(scope="module")
def model(matrix):
    return recommend.train_als(matrix.ratings, rank=10, max_iter=15)


def test_matrix(matrix):
    assert matrix.ratings.columns == ["user_idx", "business_idx", "stars"]
    assert dict(matrix.ratings.dtypes) == {"user_idx": "int", "business_idx": "int", "stars": "float"}
    assert (matrix.ratings.count(), matrix.users.count(), matrix.businesses.count()) == (10, 3, 4)


def test_index_is_the_string_indexers(spark):
    rows = spark.range(3000).select(F.concat(F.lit("k"), F.floor(F.sqrt("id") * 3) % 97).alias("k")).repartition(5)
    labels = StringIndexer(inputCol="k", outputCol="i").fit(rows).labels
    found = recommend.dense_index(rows.unionByName(spark.createDataFrame([(None,)], "k string")), "k", "i")
    assert {r["k"]: r["i"] for r in found.collect()} == {label: i for i, label in enumerate(labels)}


def test_factors_and_fit(model, matrix):
    assert (model.userFactors.count(), model.itemFactors.count()) == (3, 4)
    assert recommend.evaluate_rmse(model, matrix.ratings) < 2.0


def test_recommendations(model, matrix):
    recs = recommend.generate_recommendations(model, matrix, 3).collect()
    assert {r["user_id"] for r in recs} == {"u1", "u2", "u3"}
    for user in ("u1", "u2", "u3"):
        own = sorted((r["rank"], -r["predicted_rating"]) for r in recs if r["user_id"] == user)
        assert [rank for rank, _ in own] == [1, 2, 3] and own == sorted(own, key=lambda p: p[1])
    assert all(r["predicted_rating"] == r["predicted_rating"] for r in recs)


def test_rated_venues_can_be_left_out(model, matrix, ratings):
    recs = recommend.generate_recommendations(model, matrix, 4, exclude_rated=True)
    assert {(r["user_id"], r["business_id"]) for r in recs.collect()} == {("u1", "b4"), ("u2", "b3")}


def test_seeded_runs_agree(matrix):
    a, b = (recommend.evaluate_rmse(recommend.train_als(matrix.ratings, 4, 3), matrix.ratings) for _ in range(2))
    assert a == pytest.approx(b, rel=1e-5)


def test_search_over_parameters(matrix):
    best, table = recommend.grid_search(matrix.ratings.withColumn("review_id", F.monotonically_increasing_id()), (2, 4), (0.1,), max_iter=2)
    assert best.rank in (2, 4)
    rows = table.collect()
    assert len(rows) == 2 and sum(r["is_best"] for r in rows) == 1
    assert min(rows, key=lambda r: r["rmse"])["is_best"]


def test_rank_sweep(matrix):
    rows = recommend.rank_sweep(matrix.ratings, matrix.ratings, (2, 5), 3).collect()
    assert [r["rank"] for r in rows] == [2, 5] and sum(r["is_best"] for r in rows) == 1


def test_fit_and_recommend(spark):
    rows = spark.range(400).selectExpr("concat('r', id) review_id", "concat('u', id % 20) user_id",
                                       "concat('b', (id * 7) % 31) business_id", "cast(1 + id % 5 as float) stars")
    recs, rmse = recommend.fit_and_recommend(rows, "review_id", 5, rank=3, max_iter=3)
    assert recs.groupBy("user_id").count().agg(F.max("count")).first()[0] == 5
    assert recs.columns == ["user_id", "business_id", "predicted_rating", "rank"]
    assert rmse.first()["rmse"] > 0
    chosen, _ = recommend.fit_and_recommend(
        rows, "review_id", 5, cross_validate=True, ranks=(2,), reg_params=(0.1, 1.0), max_iter=2)
    assert chosen.groupBy("user_id").count().agg(F.max("count")).first()[0] == 5
    train, test = split_by_key(rows, "review_id")
    assert train.count() + test.count() == 400


def test_rmse_ignores_missing_predictions(spark):
    df = spark.createDataFrame([(4.0, 3.0), (2.0, 3.0), (1.0, float("nan")), (1.0, None)], "stars double, p double")
    row = recommend.rmse_table(df, "stars", "p").first()
    assert (row["rmse"], row["status"]) == (1.0, "PASS")


def precision(spark, rows, **options):
    df = spark.createDataFrame(rows, "user_id string, business_id string, predicted_rating double, rank int")
    return recommend.predicted_precision_at_k(df, **options).first()["precision_at_k"]


def user(name, *predicted):
    return [(name, f"b{i}", p, i) for i, p in enumerate(predicted, start=1)]


@pytest.mark.parametrize("rows, options, expected", [
    (user("a", 5.0, 4.5), {}, 1.0), (user("a", 1.0, 2.0), {}, 0.0), (user("a", 4.5, 2.0), {}, 0.5), ([], {}, 0.0),
    (user("a", *[4.5] * 10, 1.0), {}, 1.0), (user("a", 4.0), {}, 1.0),
    (user("a", 5.0) + user("b", 1.0, 1.0, 1.0), {}, 0.5), (user("a", 5.0, 1.0), {"k": 1}, 1.0),
    (user("a", 3.5), {"threshold": 3.0}, 1.0),
])
def test_precision(spark, rows, options, expected):
    assert precision(spark, rows, **options) == expected


def test_folds_hang_on_keys_alone(spark):
    rows = spark.range(200).selectExpr("concat('r', id) review_id", "cast(id % 20 as int) user_idx",
                                       "cast((id * 7) % 31 as int) business_idx", "cast(1 + id % 5 as float) stars")
    few, many = (recommend.grid_search(rows.repartition(n), (2,), (0.1, 1.0), max_iter=2)[1].collect() for n in (1, 5))
    assert [r["rmse"] for r in few] == pytest.approx([r["rmse"] for r in many], rel=1e-4)


def test_requests_are_answered_from_their_metro(spark):
    rows = spark.range(400).selectExpr("concat('r', id) review_id", "concat('u', id % 20) user_id",
                                       "concat('b', (id * 7) % 31) business_id", "cast(1 + id % 5 as float) stars")
    matrix = recommend.stored_matrix(rows, "review_id")
    model = recommend.train_als(matrix.ratings, 3, 3)
    venues = spark.range(31).selectExpr("concat('b', id) business_id", "if(id % 2 = 0, 'M', 'N') metro_area")
    asked = spark.createDataFrame([("u1", "M"), ("u2", "N"), ("u2", "M"), ("nobody", "M"), ("u3", "nowhere")], "user_id string, metro_area string")
    found = recommend.recommend_for_requests(model, matrix, asked, venues, 5)
    assert "CartesianProduct" not in found._jdf.queryExecution().executedPlan().toString()
    ids = {r["user_id"]: r["user_idx"] for r in matrix.users.collect()}
    items = {r["business_id"]: r["business_idx"] for r in matrix.businesses.collect()}
    u, v = ({r["id"]: r["features"] for r in f.collect()} for f in (model.userFactors, model.itemFactors))
    for user, metro in (("u1", "M"), ("u2", "N"), ("u2", "M")):
        scored = sorted((-sum(a * b for a, b in zip(u[ids[user]], v[items[f"b{i}"]])), f"b{i}") for i in range(31) if (i % 2 == 0) == (metro == "M"))
        got = found.filter((F.col("user_id") == user) & (F.col("metro_area") == metro)).orderBy("rank").collect()
        assert [r["predicted_rating"] for r in got] == pytest.approx([-s for s, _ in scored[:5]], rel=1e-4)
    assert found.select("user_id").distinct().count() == 2


def test_matrix_size(ratings):
    assert tuple(recommend.matrix_size(ratings).first()) == (10, 3, 4)
