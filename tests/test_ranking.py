import random

import pytest
from pyspark.sql import functions as F

from venuerank.operators import ranking, sampling


def test_top_per_group_with_one_hot_group(spark):
    rng = random.Random(1)
    rows = [("hot" if i % 3 else f"g{i % 50}", rng.randrange(1000), f"id{i:05}") for i in range(6000)]
    df = spark.createDataFrame(rows, "grp string, score int, id string").repartition(7)
    top = ranking.top_per_group(df, ["grp"], [F.desc("score"), F.asc("id")], 5, ["id"])
    found = {}
    for r in top.collect():
        found.setdefault(r["grp"], []).append((r["rank"], r["id"]))
    expected = {}
    for group in {r[0] for r in rows}:
        best = sorted((r for r in rows if r[0] == group), key=lambda r: (-r[1], r[2]))[:5]
        expected[group] = [(i + 1, r[2]) for i, r in enumerate(best)]
    assert {g: sorted(v) for g, v in found.items()} == expected


def test_top_per_group_prunes_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", 1, "x")], "grp string, score int, id string").repartition(3)
    top = ranking.top_per_group(df, ["grp"], [F.desc("score"), F.asc("id")], 5, ["id"])
    assert top._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") == 4


@pytest.mark.parametrize("partitions", [1, 5, 23])
def test_ordered_position(spark, partitions):
    values = list(range(500)) * 2
    random.Random(2).shuffle(values)
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "v int, id int").repartition(partitions)
    placed = ranking.ordered_position(df, [F.desc("v"), F.asc("id")], "place").collect()
    expected = sorted(((v, i) for i, v in enumerate(values)), key=lambda p: (-p[0], p[1]))
    assert [(r["v"], r["id"]) for r in sorted(placed, key=lambda r: r["place"])] == expected
    assert sorted(r["place"] for r in placed) == list(range(1000))


def test_ordered_position_of_nothing(spark):
    assert ranking.ordered_position(spark.createDataFrame([], "v int"), [F.asc("v")]).count() == 0


def test_position_within(spark):
    rows = [("a", 3), ("a", 1), (None, 9), ("b", 5), (None, 8), ("a", 2)]
    placed = ranking.position_within(spark.createDataFrame(rows, "g string, v int"), "g", [F.asc("v")])
    assert {(r["g"], r["v"], r["position"], r["group_size"]) for r in placed.collect()} == {
        ("a", 1, 0, 3), ("a", 2, 1, 3), ("a", 3, 2, 3), (None, 8, 0, 2), (None, 9, 1, 2), ("b", 5, 0, 1)}


def ids(df):
    return {r["id"] for r in df.collect()}


def test_split_by_key_is_stable_and_disjoint(spark):
    df = spark.range(5000)
    train, test = sampling.split_by_key(df, "id", 0.8)
    again, _ = sampling.split_by_key(df.repartition(13), "id", 0.8)
    assert ids(train) == ids(again)
    assert not ids(train) & ids(test) and len(ids(train)) + len(ids(test)) == 5000
    assert len(ids(train)) == pytest.approx(4000, rel=0.03)
    assert ids(sampling.split_by_key(df, "id", 0.8, seed=1)[0]) != ids(train)


@pytest.mark.parametrize("cap", [0, 1, 137, 3999, 4000, 4001])
def test_capped_sample_has_the_exact_size(spark, cap):
    assert sampling.capped_sample(spark.range(4000), "id", cap).count() == min(cap, 4000)


def test_capped_sample_is_stable(spark):
    a = ids(sampling.capped_sample(spark.range(4000), "id", 100))
    assert a == ids(sampling.capped_sample(spark.range(4000).repartition(9), "id", 100))
    assert a < ids(sampling.capped_sample(spark.range(4000), "id", 200))


def test_stratified_split(spark):
    df = spark.range(3000).withColumn("label", (F.col("id") % 10 == 0).cast("int"))
    split = sampling.stratified_split(df, "id", "label")
    counts = {(r["label"], r["is_test"]): r["count"] for r in split.groupBy("label", "is_test").count().collect()}
    assert counts == {(0, True): 540, (0, False): 2160, (1, True): 60, (1, False): 240}
    assert split.columns == ["id", "label", "is_test"]
