"""Factor blocks follow the ratings, and the search for best items knows no key that all users share."""

import numpy as np
from pyspark.sql import functions as F

from venuerank.operators import factors, recommend
from venuerank.session import sibling


def test_blocks_follow_the_ratings_and_not_the_shuffle_partitions(spark):
    many = sibling(spark)
    many.conf.set("spark.sql.shuffle.partitions", "200")
    cores = spark.sparkContext.defaultParallelism
    assert recommend._blocks(many.range(500)) == 1
    assert recommend._blocks(many.range(10_000_000)) == 10
    assert recommend._blocks(many.range(400_000)) == min(cores, 20)


def test_blocks_fill_up_before_there_are_more(spark):
    """Every block more is another copy of most factors in each half step."""
    assert spark.sparkContext.defaultParallelism <= recommend.FEW_BLOCKS
    assert recommend._blocks(spark.range(29_000_000)) == 12
    assert recommend._blocks(spark.range(174_000_000)) == 22


def test_steps_free_the_shuffles_of_those_before():
    als = recommend._als(3, 10, 0.1, 2)
    assert als.getCheckpointInterval() < als.getMaxIter()


def test_groups_and_spans_equal_brute_force(spark, monkeypatch):
    """Several groups of users meet several spans of items; the later spans know the first one's worst places."""
    monkeypatch.setattr(factors, "USER_ROWS", 20)
    monkeypatch.setattr(factors, "LEAST_ROWS", 1)
    monkeypatch.setattr(factors, "ITEM_ROWS", 24)
    draw = np.random.default_rng(3)
    u, v = draw.normal(size=(70, 4)), draw.normal(size=(130, 4)) * draw.exponential(1, (130, 1))
    v[100:] = v[50:80]  # equal items go by their id
    frame = lambda rows: spark.createDataFrame([(i, f.tolist()) for i, f in enumerate(rows)], "id int, features array<double>")
    best = factors.best_items(frame(u), frame(v), 4, 6, block=8)
    found = {}
    for r in best.rows.orderBy("user", "rank").collect():
        found.setdefault(r["user"], []).append(r["item"])
    score = lambda i, j: ((u[i, 0] * v[j, 0] + u[i, 1] * v[j, 1]) + u[i, 2] * v[j, 2]) + u[i, 3] * v[j, 3]
    assert found == {i: sorted(range(130), key=lambda j: (-score(i, j), j))[:6] for i in range(70)}
    assert 0 < best.products < best.possible == 70 * 130


def test_one_factor_spreads_over_groups_of_users(spark):
    """With one factor every user has the same best items, whose block was one key for all users."""
    users = spark.range(9_000).select(F.col("id").cast("int").alias("id"), F.array(F.rand(1) + 0.1).alias("features"))
    items = spark.range(3_000).select(F.col("id").cast("int").alias("id"), F.array(F.rand(2)).alias("features"))
    users, items = (recommend.materialise(t, "one-factor") for t in (users, items))
    best = factors.best_items(users, items, 1, 5)
    assert best.rows.count() == 9_000 * 5 and best.rows.select("item").distinct().count() == 5
    assert best.skipped > 0.8
