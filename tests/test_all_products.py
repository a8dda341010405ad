"""Best venues of all users, with and without bounds, over several spans, groups and tiles."""

import numpy as np
import pytest

from venuerank.operators import factors, recommend


def plain_best(u, v, n):
    scores = u.astype(np.float64) @ v.astype(np.float64).T
    return {i: sorted(range(len(v)), key=lambda j: (-round(scores[i, j], 12), j))[:n] for i in range(len(u))}


@pytest.mark.parametrize("kind", ["float", "double"])
@pytest.mark.parametrize("bounded", [True, False])
def test_all_products_or_those_within_bounds(spark, monkeypatch, kind, bounded):
    """Close scores, which 32-bit products put in another order, and ties come out in order."""
    monkeypatch.setattr(factors, "USER_ROWS", 30)
    monkeypatch.setattr(factors, "LEAST_ROWS", 1)
    monkeypatch.setattr(factors, "ITEM_ROWS", 96)
    monkeypatch.setattr(factors, "TILE", 7)
    draw = np.random.default_rng(3)
    u = draw.uniform(0.5, 1, (70, 4)).astype(np.float32)
    v = (draw.uniform(0.5, 1, (6, 4))[draw.integers(0, 6, 250)] + draw.uniform(0, 1e-6, (250, 4))).astype(np.float32)
    v[40:60] = v[40]
    frame = lambda x: spark.createDataFrame([(i, f.tolist()) for i, f in enumerate(x)], f"id int, features array<{kind}>")
    best = factors.best_items(frame(u), frame(v), 4, 6, block=32, bounded=bounded)
    found = {}
    for r in best.rows.orderBy("user", "rank").collect():
        found.setdefault(r["user"], []).append(r["item"])
    assert found == plain_best(u, v, 6)
    assert best.possible == 70 * 250 and (bounded or best.products == best.possible)


def test_products_too_great_for_32_bits(spark):
    frame = lambda rows: spark.createDataFrame(rows, "id int, features array<double>")
    rows = factors.best_items(frame([(0, [1e25, 1.0])]), frame([(j, [1e20 * j, -1.0]) for j in range(12)]), 2, 3).rows
    assert [r["item"] for r in rows.orderBy("rank").collect()] == [11, 10, 9]


@pytest.mark.parametrize("bounded", [True, False])
def test_recommendations_are_the_librarys_and_no_pair_is_a_row(spark, bounded):
    rows = spark.range(900).selectExpr("concat('r', id) review_id", "concat('u', id % 45) user_id",
                                       "concat('b', (id * 7) % 61) business_id", "cast(1 + id % 5 as float) stars")
    matrix = recommend.stored_matrix(rows, "review_id")
    model = recommend.train_als(matrix.ratings, 3, 3)
    found = recommend.generate_recommendations(model, matrix, 5, bounded=bounded)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not [n for n in ("CartesianProduct", "BroadcastNestedLoopJoin", "ObjectHashAggregate") if n in plan]
    ids = {r["user_idx"]: r["user_id"] for r in matrix.users.collect()}
    theirs = {ids[r["user_idx"]]: [pytest.approx(x["rating"], abs=1e-5) for x in r["recommendations"]] for r in model.recommendForAllUsers(5).collect()}
    ours = {}
    for r in found.orderBy("user_id", "rank").collect():
        ours.setdefault(r["user_id"], []).append(r["predicted_rating"])
    assert ours == theirs
    assert dict(found.dtypes) == {"user_id": "string", "business_id": "string", "predicted_rating": "float", "rank": "int"}
