import math

import pytest
from pyspark.sql import functions as F

from venuerank.operators import clean, scores, sentiment

VENUE = "business_id string, name string, metro_area string, city string, latitude double, longitude double, categories string"
REVIEW = "review_id string, business_id string, user_id string, stars int, date string, text string"


@pytest.fixture()
def venues(spark):
    return spark.createDataFrame([
        ("a", "A", "M", "C", 33.41, -112.01, "Bars"), ("b", "B", "M", "C", 33.42, -112.02, "Pizza"),
        ("c", "C", "M", "C", 33.43, -112.03, "Pizza"), ("d", "D", "N", "C", 33.44, -112.04, "Thai"),
        ("e", "E", "N", "C", 50.0, 8.0, None), ("f", "F", "N", "C", 50.01, 8.01, "Bars"),
        ("unreviewed", "U", "N", "C", 50.0, 8.0, "Bars"),
    ], VENUE)


@pytest.fixture()
def reviews(spark):
    rows = []
    for venue, stars, date in [
        ("a", 5, "2023-01-01 00:00:00"), ("a", 3, "no date"), ("b", 4, "2023-01-01 00:00:00"), ("c", 1, "2022-01-01 00:00:00"),
        ("c", 2, "2023-12-31 00:00:00"), ("d", 3, "2023-01-01 00:00:00"), ("e", 3, "2023-01-01 00:00:00"),
        ("f", 3, "bad"), ("nowhere", 5, "2023-01-01 00:00:00"),
    ]:
        rows.append((f"r{len(rows)}", venue, f"u{len(rows) % 3}", stars, date, "text"))
    return spark.createDataFrame(rows, REVIEW)


def by_key(df, *keys):
    return {tuple(r[k] for k in keys): r for r in df.collect()}


def test_business_scores(venues, reviews):
    found = by_key(scores.compute_business_scores(clean.build_enriched(reviews, venues, "2024-01-01")), "business_id")
    assert set(found) == {(k,) for k in "abcdef"}
    a = found[("a",)]
    assert (a["avg_rating"], a["review_count"]) == (4.0, 2)
    assert a["recency_score"] == pytest.approx(0.25)  # the unreadable date counts as a review
    assert a["popularity_score"] == pytest.approx(0.4 * 4 + 0.4 * math.log(3) + 0.2 * 0.25)
    assert found[("f",)]["recency_score"] is None and found[("f",)]["popularity_score"] is None


def rows(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


def test_summing_before_the_join_changes_nothing(venues, reviews):
    for business in (venues, venues.union(venues.filter("business_id = 'a'")).union(
            venues.filter("business_id = 'b'").withColumn("categories", F.lit("Sushi")))):
        whole = scores.compute_business_scores(clean.build_enriched(reviews, business, "2024-01-01"))
        early = scores.score_from_totals(scores.review_totals(reviews, "2024-01-01"), business)
        assert early.columns == whole.columns
        assert rows(early) == rows(whole)


def test_grid_aggregates(venues, reviews):
    business_scores = scores.compute_business_scores(clean.build_enriched(reviews, venues, "2024-01-01"))
    found = by_key(scores.compute_grid_aggregates(business_scores), "grid_cell", "metro_area")
    assert set(found) == {("33.4_-112.1", "M"), ("33.4_-112.1", "N"), ("50.0_8.0", "N")}
    shared = found[("33.4_-112.1", "M")]
    assert shared["restaurant_count"] == 3 and shared["top_cuisine"] == "Pizza"
    assert shared["center_lat"] == pytest.approx(33.42)
    by_venue = by_key(business_scores, "business_id")
    assert shared["avg_popularity"] == pytest.approx(sum(by_venue[(k,)]["popularity_score"] for k in "abc") / 3)
    tie = found[("50.0_8.0", "N")]
    assert tie["top_cuisine"] is None  # no category comes before any other on a tie
    assert tie["avg_popularity"] == pytest.approx(by_venue[("e",)]["popularity_score"])
    tops = by_key(scores.top_cuisine(business_scores), "grid_cell", "metro_area")
    assert {k: r["top_cuisine"] for k, r in tops.items()} == {k: r["top_cuisine"] for k, r in found.items()}


def test_ties_between_categories_go_by_alphabet(spark):
    table = spark.createDataFrame([("x", "m", c, 1.0, 1.0, 1.0) for c in ("Thai", "Bars", "Thai", "Bars", "Pizza")],
                                  "grid_cell string, metro_area string, categories string, latitude double, "
                                  "longitude double, popularity_score double")
    assert scores.compute_grid_aggregates(table).first()["top_cuisine"] == "Bars"
    assert scores.approximate_grid_aggregates(table).first()["top_cuisine"] in ("Thai", "Bars", "Pizza")


def test_grid_sentiment_three_ways(venues, reviews):
    enriched = clean.build_enriched(reviews, venues, "2024-01-01")
    plain = sentiment.compute_grid_sentiment(enriched)
    found = by_key(plain, "grid_cell")
    assert set(found) == {("33.4_-112.1",)}  # the other cell has neutral reviews only
    row = found[("33.4_-112.1",)]
    assert (row["positive_count"], row["negative_count"], row["sentiment_score"]) == (2, 2, 0.5)
    assert rows(sentiment.grid_sentiment_by_pivot(enriched)) == rows(plain)
    totals = scores.review_totals(reviews, "2024-01-01")
    assert rows(sentiment.sentiment_from_totals(totals, venues)) == rows(plain)


def test_one_sided_sentiment(spark):
    table = spark.createDataFrame([("x", 5)] * 3 + [("y", 1)] * 2, "grid_cell string, stars int")
    for found in (sentiment.compute_grid_sentiment(table), sentiment.grid_sentiment_by_pivot(table)):
        assert {r["grid_cell"]: r["sentiment_score"] for r in found.collect()} == {"x": 1.0, "y": 0.0}


@pytest.fixture()
def cells(spark):
    grid = spark.createDataFrame([
        ("1.0_1.0", "M", 1.05, 1.05, 5, 2.0), ("1.1_1.0", "M", 1.15, 1.05, 3, 3.0), ("1.0_1.0", "N", 1.05, 1.05, 1, 1.0),
        ("9.0_9.0", "Quiet", 9.05, 9.05, 1, 1.0),
    ], "grid_cell string, metro_area string, center_lat double, center_lng double, restaurant_count long, avg_popularity double")
    mood = spark.createDataFrame([("1.0_1.0", 0.75, 30, 10), ("1.1_1.0", 1.0, 3, 0)],
                                 "grid_cell string, sentiment_score double, positive_count long, negative_count long")
    return grid, mood


def test_cells_without_sentiment_show_zeros_and_shared_cells_share(cells):
    found = by_key(sentiment.cell_sentiment(*cells), "metro_area", "grid_cell")
    assert len(found) == 4
    assert found[("N", "1.0_1.0")]["positive_count"] == found[("M", "1.0_1.0")]["positive_count"] == 30
    assert found[("Quiet", "9.0_9.0")]["sentiment_score"] == 0


def test_satisfaction(spark, cells):
    labels = cells[0].select("metro_area", "grid_cell", F.concat(F.lit("at "), "grid_cell").alias("neighborhood"))
    found = by_key(sentiment.satisfaction_ranking(*cells, labels), "metro_area", "position")
    rate = 33 / 43
    assert found[("M", 1)]["satisfaction"] == pytest.approx(round((3 + 30 * rate) / 33 * 10, 1))
    assert found[("M", 1)]["neighborhood"] == "at 1.1_1.0"
    assert found[("M", 2)]["satisfaction"] == pytest.approx(round((30 + 30 * rate) / 70 * 10, 1))
    assert found[("Quiet", 1)]["satisfaction"] == 5.0  # no reviews anywhere: the neutral prior


def test_bayesian_cells_and_coverage(cells):
    found = by_key(sentiment.bayesian_cells(*cells), "grid_cell", "metro_area")
    rate = 63 / 83  # the shared cell counts once per metro
    row = found[("1.1_1.0", "M")]
    assert row["global_rate"] == pytest.approx(rate)
    assert row["raw_score"] == 1.0
    assert row["bayesian_score"] == pytest.approx((3 + 30 * rate) / 33 * 10)
    coverage = by_key(sentiment.spatial_coverage(cells[0], sentiment.bayesian_cells(*cells)), "metro_area", "grid_cell")
    assert len(coverage) == 4 and coverage[("Quiet", "9.0_9.0")]["bayesian_score"] is None
