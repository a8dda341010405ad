import numpy as np
import pytest
from pyspark.sql import functions as F

from venuerank.operators import factors, recommend

RATINGS = "user_idx int, business_idx int, stars float"


def ratings_of(spark, users, venues, per_user, seed=1, hot=False):
    """Ratings of a low-rank taste with noise; with `hot`, every user has rated venue 0 too, a third of all ratings."""
    draw = np.random.default_rng(seed)
    taste, kind = draw.uniform(0.2, 1.5, (users, 3)), draw.uniform(0.2, 1.5, (venues, 3))
    rows = []
    for u in range(users):
        seen = draw.choice(np.arange(1, venues), per_user, replace=False).tolist() + ([0] if hot else [])
        rows += [(u, int(v), float(np.clip(taste[u] @ kind[v] + draw.normal() * 0.1, 0.5, 5))) for v in seen]
    return spark.createDataFrame(rows, RATINGS).repartition(3), len(rows)


def as_dict(df):
    return {r["id"]: np.array(r["features"]) for r in df.collect()}


def test_error_equals_the_library(spark):
    ratings, _ = ratings_of(spark, 60, 40, 20)
    train, test = (recommend.materialise(t, "split") for t in ratings.randomSplit([0.8, 0.2], 3))
    model = recommend.train_als(train, 3, 10, 0.02)
    # the library's users are the answer to its venues, so one half step from these must give them again
    held = factors._with_slices(train, "user_idx", "business_idx", 5)
    users = factors._half(held, "user_idx", "business_idx", model.itemFactors, 3, 0.02)
    ours, theirs = as_dict(users), as_dict(model.userFactors)
    assert ours.keys() == theirs.keys() and all(np.allclose(ours[i], theirs[i], atol=1e-3) for i in ours)
    error = F.col("stars") - F.col("prediction")
    rmse = lambda f: factors.predict(test, f, 3).agg(F.sqrt(F.avg(error * error))).first()[0]
    library = recommend.evaluate_rmse(model, test)
    assert rmse(factors.Factors(users, model.itemFactors)) == pytest.approx(library, abs=1e-3)
    # from a start of its own the fit may end in another optimum, about as good
    assert rmse(factors.factorise(train, 3, 10, 0.02)) < library + 0.02


def test_a_venue_with_a_third_of_all_ratings_is_cut(spark):
    ratings, n = ratings_of(spark, 90, 30, 2, hot=True)
    assert ratings.filter("business_idx = 0").count() * 3 == n
    whole, cut = (factors.factorise(ratings, 2, 3, 0.1, slice_rows=rows) for rows in (10_000, 7))
    for a, b in zip(whole, cut):
        a, b = as_dict(a), as_dict(b)
        assert a.keys() == b.keys() and all(np.allclose(a[i], b[i], atol=1e-8) for i in a)
    sliced = factors._with_slices(ratings, "business_idx", "user_idx", 7).filter("business_idx = 0")
    assert sliced.select("business_idx_slice").distinct().count() > 8


def test_solve_is_non_negative_least_squares():
    draw = np.random.default_rng(2)
    rank, rows = 4, 30
    upper = np.triu_indices(rank)
    sums, exact = [], []
    for _ in range(rows):
        a = draw.normal(size=(9, rank))
        b = a @ draw.uniform(-1, 1, rank)
        sums.append(np.concatenate([(a.T @ a)[upper], a.T @ b]))
        exact.append((a.T @ a + 0.1 * 9 * np.eye(rank), a.T @ b))
    for x, (gram, right) in zip(factors.solve(np.array(sums), np.full(rows, 9), rank, 0.1), exact):
        slope = gram @ x - right
        assert (x >= 0).all() and (slope > -1e-6).all() and np.abs(slope[x > 0]).max(initial=0) < 1e-6


def plain_best(users, items, n):
    out = {}
    for u, f in users.items():
        scored = sorted(((-float(f @ g), i) for i, g in items.items()))[:n]
        out[u] = [(i, pytest.approx(-s, abs=1e-9)) for s, i in scored]
    return out


@pytest.mark.parametrize("n, block", [(3, 4), (10, 16), (500, 7)])
def test_best_items_equal_brute_force(spark, n, block):
    draw = np.random.default_rng(n)
    # lengths of a wide range, both signs, equal rows, and items and users of no length
    items = {i: draw.normal(size=3) * 10 ** draw.uniform(-2, 1) for i in range(200)} | {300: np.zeros(3), 301: np.ones(3), 302: np.ones(3)}
    users = {u: draw.normal(size=3) for u in range(25)} | {90: np.zeros(3), 91: -np.ones(3)}
    frame = lambda rows: spark.createDataFrame([(int(i), f.tolist()) for i, f in rows.items()], "id int, features array<double>")
    best = factors.best_items(frame(users), frame(items), 3, n, block)
    found = {}
    for r in best.rows.orderBy("user", "rank").collect():
        found.setdefault(r["user"], []).append((r["item"], r["score"]))
    assert found == plain_best(users, items, n)
    print(f"share of products skipped for the best {n}: {best.skipped:.2f}")
    assert best.possible == len(users) * len(items)
    assert best.skipped > 0.3 if n < 100 else best.skipped == 0


def test_best_items_equal_the_library(spark):
    ratings, _ = ratings_of(spark, 40, 150, 20, seed=5)
    model = recommend.train_als(ratings, 4, 5, 0.1)
    best = factors.best_items(model.userFactors, model.itemFactors, 4, 6, 8)
    theirs = {r["user_idx"]: [(x["business_idx"], pytest.approx(x["rating"], abs=1e-5)) for x in r["recommendations"]] for r in model.recommendForAllUsers(6).collect()}
    found = {}
    for r in best.rows.orderBy("user", "rank").collect():
        found.setdefault(r["user"], []).append((r["item"], r["score"]))
    assert found == theirs
    print(f"share of products skipped: {best.skipped:.2f}")


def test_no_users_or_items(spark):
    none = spark.createDataFrame([], "id int, features array<double>")
    one = spark.createDataFrame([(1, [1.0, 2.0])], "id int, features array<double>")
    assert factors.best_items(none, one, 2, 3).rows.count() == factors.best_items(one, none, 2, 3).rows.count() == 0


def test_penalties_are_compared_on_the_test_ratings(spark):
    ratings, _ = ratings_of(spark, 30, 20, 10)
    train, test = (recommend.materialise(t, "split") for t in ratings.randomSplit([0.8, 0.2], 3))
    start = F.array(F.lit(1.0))
    found = factors.penalty_sweep(train, test, 1, 2, [0.1, 5.0], start=start).orderBy("reg_param").collect()
    error = F.col("stars") - F.col("prediction")
    for row in found:
        scored = factors.predict(test, factors.factorise(train, 1, 2, row["reg_param"], start=start), 1)
        assert row["rmse"] == pytest.approx(scored.agg(F.sqrt(F.avg(error * error))).first()[0])
    assert [r["is_best"] for r in found] == [True, False]


def test_best_in_scopes_equals_all_products(spark):
    """Users among the items of their own scope: one of many blocks, one smaller than the places asked for, one without items."""
    draw = np.random.default_rng(9)
    u, v = draw.uniform(0, 1, (25, 3)), draw.uniform(0, 1, (60, 3)) * draw.exponential(1, (60, 1))
    homes = {0: range(0, 40), 1: range(40, 43), 2: range(30, 60), 3: []}
    asked = [(s, i) for s in homes for i in range(25) if i % (s + 1) == 0]
    schema = "scope int, id int, features array<double>"
    users = spark.createDataFrame([(s, i, u[i].tolist()) for s, i in asked], schema)
    items = spark.createDataFrame([(s, j, v[j].tolist()) for s, held in homes.items() for j in held], schema)
    best = factors.best_in_scopes(users, items, 3, 5, block=4)
    got = {}
    for r in best.rows.orderBy("scope", "user", "rank").collect():
        got.setdefault((r["scope"], r["user"]), []).append(r["item"])
    assert got == {(s, i): sorted(homes[s], key=lambda j: (-float(u[i] @ v[j]), j))[:5] for s, i in asked if len(homes[s])}
    assert best.possible == sum(len(homes[s]) for s, _ in asked) and 0 < best.products < best.possible
