import datetime
import math

import pytest
from pyspark.sql import functions as F

from venuerank.functions import geo, hashing, scoring, text
from venuerank.functions.vocabulary import CUISINE_TAGS, FOOD_AND_DRINK_TAGS


def one(spark, schema, row, column):
    return spark.createDataFrame([row], schema).select(column.alias("x")).first()["x"]


def km(spark, a, b):
    return one(spark, "a double, b double, c double, d double", (*a, *b),
               geo.haversine_km(F.col("a"), F.col("b"), F.col("c"), F.col("d")))


def test_distances(spark):
    assert km(spark, (36.16, -86.78), (36.03, -86.78)) < 50
    assert km(spark, (45.52, -122.68), (43.66, -70.26)) > 50
    assert km(spark, (10.0, 20.0), (10.0, 20.0)) == 0.0
    assert km(spark, (0.0, 0.0), (0.0, 180.0)) == pytest.approx(math.pi * 6371.0)


@pytest.mark.parametrize("lat, lng, cell", [
    (33.41, -112.01, "33.4_-112.1"), (33.49, -112.09, "33.4_-112.1"), (33.45, -112.07, "33.4_-112.1"),
    (-33.85, 151.21, "-33.9_151.2"), (0.05, 0.05, "0.0_0.0"), (0.3, 0.7, "0.2_0.6"),
])
def test_grid_cell(spark, lat, lng, cell):
    assert one(spark, "lat double, lng double", (lat, lng), geo.grid_cell(F.col("lat"), F.col("lng"))) == cell


def test_grid_cell_needs_a_position(spark):
    df = geo.with_grid_cell(spark.createDataFrame([(None, 1.0)], "latitude double, longitude double"))
    assert df.first()["grid_cell"] is None


@pytest.mark.parametrize("cell, label", [
    ("33.4_-112.1", "Downtown"), ("33.6_-112.1", "North District"), ("33.2_-112.1", "South District"),
    ("33.4_-111.9", "East District"), ("33.4_-112.3", "West District"), ("33.7_-112.1", "North Side"),
    ("33.6_-111.9", "Northeast Side"), ("34.4_-112.1", "North Outskirts"), ("32.9_-112.6", "Southwest Outskirts"),
    ("not_a_valid_cell", "not_a_valid_cell"), ("abc", "abc"), ("1.0_x", "1.0_x"),
])
def test_compass_label(spark, cell, label):
    found = one(spark, "cell string, lat double, lng double", (cell, 33.45, -112.05),
                geo.compass_label(F.col("cell"), F.col("lat"), F.col("lng")))
    assert found == label


def test_cell_bounds(spark):
    for cell, south, west in (("33.4_-112.1", 33.4, -112.1), ("odd", 9.95, 19.95)):
        df = spark.createDataFrame([(cell, 10.0, 20.0)], "cell string, lat double, lng double")
        edges = geo.cell_bounds(F.col("cell"), F.col("lat"), F.col("lng"))
        row = df.select(*[e.alias(n) for n, e in edges.items()]).first()
        assert row["south"] == pytest.approx(south) and row["west"] == pytest.approx(west)
        assert row["north"] - row["south"] == pytest.approx(0.1) and row["east"] - row["west"] == pytest.approx(0.1)


def test_valid_coordinate(spark):
    df = spark.createDataFrame([("1.5",), ("x",), ("NaN",), (None,)], "v string")
    assert [r["ok"] for r in df.select(geo.valid_coordinate(F.col("v")).alias("ok")).collect()] == [
        True, False, False, False]


def weight(spark, date, as_of="2024-01-01"):
    return one(spark, "d string", (date,), scoring.recency_weight(F.col("d"), as_of))


def test_recency(spark):
    assert weight(spark, "2023-12-22 10:00:00") > weight(spark, "2022-08-19 10:00:00")
    assert 0 < weight(spark, "2014-01-03 00:00:00") <= 1
    assert weight(spark, "2024-01-01 23:59:59") == 1.0
    assert weight(spark, "2024-07-01 00:00:00") > 1
    assert weight(spark, "2023-01-01 00:00:00", datetime.date(2024, 1, 1)) == pytest.approx(0.5)


@pytest.mark.parametrize("date", ["2023-01-01", "yesterday", "", None, "2024-12-31 00:00:00"])
def test_recency_is_null_without_a_readable_date_and_at_the_pole(spark, date):
    assert weight(spark, date) is None


def test_popularity(spark):
    found = one(spark, "r double, n long, w double", (4.0, 9, 0.5), scoring.popularity(F.col("r"), F.col("n"), F.col("w")))
    assert found == pytest.approx(0.4 * 4 + 0.4 * math.log(10) + 0.1)


@pytest.mark.parametrize("stars, label", [(5.0, "positive"), (4.0, "positive"), (3.5, "neutral"), (3.0, "neutral"),
                                          (2.5, "neutral"), (2.0, "negative"), (1.0, "negative")])
def test_star_label(spark, stars, label):
    assert one(spark, "s double", (stars,), scoring.star_label(F.col("s"))) == label


@pytest.mark.parametrize("norm, colour", [(1.0, "#c62828"), (0.7, "#c62828"), (0.69, "#ef6c00"), (0.4, "#ef6c00"),
                                          (0.39, "#2e7d32"), (0.0, "#2e7d32")])
def test_heat_colours(spark, norm, colour):
    assert one(spark, "n double", (norm,), scoring.banded(F.col("n"), scoring.HEAT_COLOURS)) == colour


def bayes(spark, positive, negative, rate, prior=30):
    return one(spark, "p long, n long, r double", (positive, negative, rate),
               scoring.bayesian_score(F.col("p"), F.col("n"), F.col("r"), prior)) / 10


def test_bayesian_score_shrinks(spark):
    assert bayes(spark, 0, 0, 0.7) == pytest.approx(0.7)
    assert bayes(spark, 3, 0, 0.7) < 0.9
    assert abs(bayes(spark, 800, 200, 0.5) - 0.8) < 0.02
    assert abs(bayes(spark, 10, 0, 0.5, 100) - 0.5) < abs(bayes(spark, 10, 0, 0.5, 5) - 0.5)


@pytest.mark.parametrize("value, digits, rounded", [(2.5, 0, 2.0), (3.5, 0, 4.0), (7.25, 1, 7.2), (7.35, 1, 7.4), (8.4500004, 1, 8.5), (8.45, 1, 8.4)])
def test_half_even(spark, value, digits, rounded):
    assert one(spark, "v double", (value,), scoring.half_even(F.col("v"), digits)) == rounded


def test_card_figures(spark):
    assert one(spark, "v double", (4.5,), scoring.full_stars(F.col("v"))) == 4
    assert one(spark, "v double", (7.0,), scoring.full_stars(F.col("v"))) == 5
    assert one(spark, "v double", (4.99,), scoring.percent_of(F.col("v"), 5)) == 99
    assert one(spark, "v double", (6.0,), scoring.percent_of(F.col("v"), 5)) == 100


def test_tags(spark):
    found = one(spark, "c string", (" Bars , , Wine Bars\t",), text.tags(F.col("c")))
    assert found == ["Bars", "Wine Bars"]


@pytest.mark.parametrize("categories, food", [
    ("Mexican, Restaurants", True), (" PIZZA ", True), ("Automotive, Car Wash", False), ("Barstools", False),
    ("", False), (None, False), ("Yoga,Bars", True),
])
def test_food_tags(spark, categories, food):
    assert one(spark, "c string", (categories,), text.has_any_tag(F.col("c"), FOOD_AND_DRINK_TAGS)) is food


def test_tag_lists():
    assert len(set(FOOD_AND_DRINK_TAGS)) == len(FOOD_AND_DRINK_TAGS) == 35
    assert len(set(CUISINE_TAGS)) == len(CUISINE_TAGS) == 105


def test_tokens(spark):
    found = one(spark, "t string", ("Café a The-End, x_1 Ü2!",), text.tokens(F.col("t")))
    assert found == ["café", "the", "end", "x_1", "ü2"]
    assert one(spark, "t string", (None,), text.tokens(F.col("t"))) == []


@pytest.mark.parametrize("value, terms", [
    ("big red dog", ["big", "red", "dog", "big red", "red dog"]), ("solo", ["solo"]), ("", []), (None, []),
])
def test_unigrams_and_bigrams(spark, value, terms):
    assert one(spark, "t string", (value,), text.unigrams_and_bigrams(F.col("t"))) == terms


def test_single_line(spark):
    assert one(spark, "t string", ("a\\b\tc\nd\re",), text.single_line(F.col("t"))) == "ab c d e"
    assert one(spark, "t string", (None,), text.single_line(F.col("t"))) == ""


def test_draws_split_evenly(spark):
    draws = spark.range(20_000).select(hashing.below(hashing.draw(F.col("id"), 7), 0.8).alias("kept"))
    assert draws.filter("kept").count() == pytest.approx(16_000, rel=0.02)
    assert spark.range(10).filter(hashing.below(hashing.draw(F.col("id"), 7), 1.0)).count() == 10
