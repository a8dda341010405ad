import pytest

from venuerank import schemas
from venuerank.operators import clean, metro

BUSINESS = ("business_id string, name string, city string, state string, latitude double, longitude double, "
            "is_open int, categories string, review_count int")
REVIEW = "review_id string, business_id string, user_id string, stars int, date string, text string"


@pytest.fixture()
def businesses(spark):
    return spark.createDataFrame([
        ("b1", "Taco", "phoenix ", "az", 33.45, -112.07, 1, "Mexican, Restaurants", 100),
        ("b2", "Gone", "Phoenix", "AZ", 33.46, -112.06, 0, "Restaurants", 10),
        ("b3", "Slice", " PHOENIX", "AZ ", 33.47, -112.05, 1, "Pizza", 50),
        ("b4", "Lost", "Phoenix", "AZ", None, None, 1, "Restaurants", 10),
        ("b5", "Wash", "Phoenix", "AZ", 33.4, -112.0, 1, "Automotive, Car Wash", 10),
        ("b6", "Stretch", "Phoenix", "AZ", 33.4, -112.0, 1, "Yoga, Active Life", 10),
        ("b7", "Pub", "Tempe", "AZ", 33.42, -111.94, 1, "Nightlife, Bars", 20),
        ("b8", "Unsure", "Phoenix", "AZ", 33.4, -112.0, None, "Bars", 10),
    ], BUSINESS)


@pytest.fixture()
def reviews(spark):
    return spark.createDataFrame([
        ("r1", "b1", "u1", 5, "2023-01-01 00:00:00", "great"),
        ("r2", "b1", "u2", 4, "2022-01-01 00:00:00", "good"),
        ("r3", "b2", "u1", 3, "2021-01-01 00:00:00", "closed now"),
        ("r4", "b3", "u3", 2, "bad date", "meh"),
        ("r5", "b3", "u3", 2, "2021-01-01 00:00:00", None),
    ], REVIEW)


def test_only_open_located_food_venues_stay(businesses):
    tidy = clean.open_food_businesses(businesses)
    assert {r["business_id"] for r in tidy.collect()} == {"b1", "b3", "b7"}
    assert {(r["city"], r["state"]) for r in tidy.collect()} == {("Phoenix", "AZ"), ("Tempe", "AZ")}


def test_spellings_of_a_city_share_a_metro(businesses):
    cleaned = clean.clean_businesses(businesses)
    assert {r["metro_area"] for r in cleaned.collect()} == {"Phoenix"}
    assert "city_key" not in cleaned.columns


def test_venue_without_state_keeps_its_row(spark):
    rows = [("a", "A", "Town", None, 1.0, 1.0, 1, "Bars", 1), ("b", "B", "Town", "X", 1.0, 1.0, 1, "Bars", 1)]
    cleaned = clean.clean_businesses(spark.createDataFrame(rows, BUSINESS))
    assert {r["business_id"]: r["metro_area"] for r in cleaned.collect()} == {"a": None, "b": "Town"}


def test_incomplete_reviews_are_dropped(reviews):
    assert {r["review_id"] for r in clean.clean_reviews(reviews).collect()} == {"r1", "r2", "r3", "r4"}


def test_enrichment(businesses, reviews):
    enriched = clean.build_enriched(clean.clean_reviews(reviews), clean.clean_businesses(businesses), "2024-01-01")
    rows = {r["review_id"]: r for r in enriched.collect()}
    assert set(rows) == {"r1", "r2", "r4"}
    assert rows["r1"]["recency_weight"] == pytest.approx(0.5)
    assert rows["r4"]["recency_weight"] is None
    assert rows["r1"]["grid_cell"] == "33.4_-112.1"
    assert set(enriched.columns) == {
        *schemas.REVIEW_COLUMNS, "is_open", "name", "city", "state", "latitude", "longitude", "categories",
        "review_count", "metro_area", "recency_weight", "grid_cell"}


def test_row_filters_reach_the_scan(spark, reviews, tmp_path):
    reviews.write.parquet(str(tmp_path / "reviews"))
    plan = clean.clean_reviews(spark.read.parquet(str(tmp_path / "reviews")))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(review_id), IsNotNull(business_id)" in text


def test_a_venue_with_most_reviews(spark, businesses):
    """One venue holds nearly all reviews; none is lost when the join is split."""
    many = spark.range(30_000).selectExpr(
        "concat('x', id) review_id", "if(id % 100 = 0, 'b3', 'b1') business_id", "concat('u', id % 7) user_id",
        "cast(1 + id % 5 as int) stars", "'2023-01-01 00:00:00' date", "repeat('word ', 20) text")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "64KB")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        enriched = clean.build_enriched(many, clean.clean_businesses(businesses), "2024-01-01")
        counts = {r["business_id"]: r["count"] for r in enriched.groupBy("business_id").count().collect()}
    finally:
        for name in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold",
                     "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
                     "spark.sql.adaptive.advisoryPartitionSizeInBytes"):
            spark.conf.unset(name)
    assert counts == {"b1": 29_700, "b3": 300}


def test_city_anchors_add_up(businesses):
    rows = {r["city_key"]: r for r in metro.city_anchors(clean.open_food_businesses(businesses)).collect()}
    assert rows["Phoenix_AZ"]["total_reviews"] == 150
    assert rows["Phoenix_AZ"]["center_lat"] == pytest.approx(33.46)
