import math

import pytest
from pyspark.sql import functions as F

from venuerank.operators import explore, neighborhoods, serving

SCORES = ("business_id string, name string, metro_area string, city string, latitude double, longitude double, "
          "grid_cell string, categories string, avg_rating double, review_count long, recency_score double, "
          "popularity_score double")


def venue(key, metro="M", score=1.0, categories="Bars, Thai", rating=4.0, lat=1.0, city="C"):
    return (key, f"Name of {key}", metro, city, lat, 2.0, "1.0_2.0", categories, rating, 10, 0.5, score)


@pytest.fixture(scope="module")
def scores(spark):
    return spark.createDataFrame([
        venue("a", score=5.0), venue("b", score=3.0, categories="Mexican, Restaurants"), venue("c", score=1.0, rating=2.0),
        venue("d", "N", 2.0, "Italian", city="D"), venue("e", "N", None, None, lat=None, city="D"),
        venue("f", "N", 2.0, "New Mexican Cuisine", lat=float("nan"), city="D"),
    ], SCORES).cache()


@pytest.fixture(scope="module")
def recs(spark):
    rows = [("u1", "a", 4.8, 1), ("u1", "d", 4.5, 2), ("u1", "gone", 4.4, 3), ("u2", "d", 6.0, 1), ("u2", "f", 2.0, 2),
            ("u3", "b", 3.0, 1), ("u3", "c", 2.0, 2)]
    return spark.createDataFrame(rows, "user_id string, business_id string, predicted_rating double, rank int").cache()


def test_lists(scores):
    assert [r[0] for r in serving.metros(scores).collect()] == ["M", "N"]
    assert [r[0] for r in serving.cities(scores).collect()] == ["C", "D"]
    tags = [tuple(r) for r in serving.cuisine_tags_by_metro(scores).collect()]
    assert tags == [("M", "Mexican"), ("M", "Thai"), ("N", "Italian")]


@pytest.mark.parametrize("cuisine, expected", [
    (None, ["a", "b", "c", "d", "f", "e"]), ("All", ["a", "b", "c", "d", "f", "e"]), ("mexican", ["b", "f"]),
    ("BARS", ["a", "c"]), ("%", []),
])
def test_businesses_by_cuisine(scores, cuisine, expected):
    assert [r["business_id"] for r in serving.businesses_by_cuisine(scores, cuisine).collect()] == expected


def test_metro_summary(spark, scores):
    grid = spark.createDataFrame([("M", "x"), ("M", "y"), ("N", "x")], "metro_area string, grid_cell string")
    found = {r["metro_area"]: tuple(r)[1:] for r in serving.metro_summary(scores, grid, "Bars").collect()}
    assert found == {"M": (2, 2, 3.0), "N": (1, 0, None)}


def ask(spark, recs, scores, *pairs, **options):
    requests = spark.createDataFrame(list(pairs), "user_id string, requested_metro string")
    rows = serving.recommendations_for(requests, recs, scores, **options).collect()
    return sorted((r["user_id"], r["rank"], r["business_id"], r["city_filtered"]) for r in rows)


def test_recommendations_prefer_the_metro_and_fall_back(spark, recs, scores):
    assert ask(spark, recs, scores, ("u1", "M")) == [("u1", 1, "a", True)]
    assert ask(spark, recs, scores, ("u1", "elsewhere")) == [("u1", 1, "a", False), ("u1", 2, "d", False)]
    assert ask(spark, recs, scores, ("u2", "M"), ("u3", "M")) == [
        ("u2", 1, "d", False), ("u2", 2, "f", False), ("u3", 1, "b", True), ("u3", 2, "c", True)]
    assert ask(spark, recs, scores, ("u3", "M"), limit=1) == [("u3", 1, "b", True)]
    assert ask(spark, recs, scores, ("nobody", "M")) == []


def test_proxy_user(recs, scores):
    def proxy(*cuisines, metro="M"):
        return [r["user_id"] for r in serving.find_proxy_user(recs, scores, metro, list(cuisines)).collect()]
    assert proxy("Bars") == ["u1"]              # one match each, higher prediction
    assert proxy("Bars", "Mexican") == ["u3"]   # two matches
    assert proxy("Italian", metro="N") == ["u2"]
    assert proxy("Sushi") == [] and proxy() == []


def test_details_and_cards(spark, recs, scores):
    details = {(r["user_id"], r["business_id"]): r["name"] for r in serving.recommendation_details(recs, scores).collect()}
    assert len(details) == 7 and details[("u1", "gone")] is None
    shown = serving.recommendations_for(spark.createDataFrame([("u2", "N")], "user_id string, requested_metro string"), recs, scores)
    cards = {r["rank"]: r for r in serving.recommendation_cards(shown).collect()}
    assert (cards[1]["predicted"], cards[1]["match_pct"], cards[1]["full_stars"], cards[1]["empty_stars"]) == (5.0, 100, 4, 1)
    assert cards[2]["match_pct"] == 40
    assert [r["rank"] for r in serving.recommendation_pins(shown).collect()] == [1]  # NaN latitude


def test_search_cards(spark):
    found = spark.createDataFrame([("q", 1, "N", "C", 5, None, 0.4567)], "query_id string, position int, name string, "
                                  "city string, review_count long, avg_rating double, final_score double")
    row = serving.search_cards(found).first()
    assert (row["full_stars"], row["empty_stars"], row["match_pct"]) == (0, 5, 45)


def test_pins(scores):
    pins = {r["business_id"]: r for r in serving.business_pins(scores).collect()}
    assert set(pins) == {"a", "b", "c", "d"}
    assert [pins[k]["pin_class"] for k in "abc"] == ["green", "orange", "lightgray"]
    # colours compare the pins shown, not all venues
    assert {r["business_id"]: r["pin_class"] for r in serving.business_pins(scores, pins=2).collect()} == {
        "a": "green", "b": "lightgray", "d": "lightgray"}


def test_display_table(scores):
    assert serving.display_table(scores).columns == ["Name", "Cuisine", "Avg Rating", "Reviews", "Score"]


GRID = "grid_cell string, metro_area string, center_lat double, center_lng double, avg_popularity double, restaurant_count long, top_cuisine string"


@pytest.fixture(scope="module")
def grid(spark):
    return spark.createDataFrame([
        ("33.4_-112.1", "M", 33.45, -112.05, 1.0, 9, "Thai"), ("33.4_-112.0", "M", 33.45, -111.95, 2.0, 8, None),
        ("33.4_-112.2", "M", 33.45, -112.15, 3.0, 1, "Thai"), ("odd", "N", 10.0, 20.0, 0.0, 1, "Thai"),
    ], GRID).cache()


def test_heat(grid):
    found = {r["grid_cell"]: (r["weight"], r["colour"]) for r in serving.heat_points(grid).collect()}
    assert found == {"33.4_-112.1": (0.0, "#2e7d32"), "33.4_-112.0": (0.5, "#ef6c00"), "33.4_-112.2": (1.0, "#c62828"),
                     "odd": (0.0, "#2e7d32")}


def test_rectangles(grid):
    found = {r["grid_cell"]: r for r in serving.cell_rectangles(grid).collect()}
    assert found["odd"]["south"] == pytest.approx(9.95) and found["odd"]["neighborhood"] == "odd"
    assert found["33.4_-112.1"]["east"] == pytest.approx(-112.0)


def names(df):
    return {(r["metro_area"], r["grid_cell"]): r["neighborhood"] for r in df.collect()}


def test_repeated_labels_are_numbered(spark):
    cells = spark.createDataFrame([(f"{lat:.1f}_1.0", "M", lat + 0.05, 1.05) for lat in (1.0, 1.1, 1.2, 1.3, 1.4, 1.5)],
                                  "grid_cell string, metro_area string, center_lat double, center_lng double")
    found = names(neighborhoods.add_neighborhood_labels(cells))
    assert found[("M", "1.2_1.0")] == "Downtown 1" and found[("M", "1.3_1.0")] == "Downtown 2"
    assert len(set(found.values())) == len(found) == 6


def test_frames_without_cells_stay_as_they_are(spark):
    df = spark.createDataFrame([(1,)], "x int")
    assert neighborhoods.add_neighborhood_labels(df) is df


def test_place_names_for_the_largest_cells(spark, grid):
    places = spark.createDataFrame([("33.4_-112.1", "", "Old Town"), ("33.4_-112.2", None, None)],
                                   "grid_cell string, neighbourhood string, suburb string")
    found = names(neighborhoods.add_neighborhood_labels(grid, places))
    assert found[("M", "33.4_-112.1")] == "Old Town"
    assert "Old Town" not in found[("M", "33.4_-112.2")]
    many = spark.range(15).selectExpr("concat(id, '.0_1.0') grid_cell", "'M' metro_area", "id + 0.05 center_lat",
                                      "1.05 center_lng", "id restaurant_count")
    largest = {r["grid_cell"] for r in neighborhoods.largest_cells(many).collect()}
    assert largest == {f"{i}.0_1.0" for i in range(5, 15)}
    assert neighborhoods.largest_cells(many.drop("restaurant_count")).count() == 0


# --- exploration ---------------------------------------------------------------------------

def test_frequencies(spark, scores):
    stars = spark.createDataFrame([(5,), (5,), (1,), (None,)], "stars int")
    assert {tuple(r) for r in explore.star_frequency(stars).collect()} == {(5, 2), (1, 1)}
    opened = spark.createDataFrame([(1,), (0,), (1,), (None,)], "is_open int")
    assert {tuple(r) for r in explore.open_frequency(opened).collect()} == {("Open", 2), ("Closed", 1)}
    assert {tuple(r) for r in explore.city_frequency(scores).collect()} == {("C", 3), ("D", 3)}


@pytest.fixture(scope="module")
def measured(spark):
    rows = [(f"id{i:03}", (i * 37 % 101) / 20, i, (i % 7) / 7, (i * i % 89) / 10) for i in range(101)]
    return spark.createDataFrame(
        rows, "business_id string, avg_rating double, review_count long, recency_score double, popularity_score double"
    ).withColumn("name", F.col("business_id")).cache()


def test_summary_matches_pandas(measured):
    expected = measured.toPandas()[explore.MEASURES].describe().round(3)
    found = {r["metric"]: r for r in explore.score_summary(measured).collect()}
    for metric in explore.MEASURES:
        row = found[metric]
        ours = [row[c] for c in ("count", "mean", "std", "min", "p25", "p50", "p75", "max")]
        assert ours == pytest.approx(expected[metric].tolist(), abs=1.1e-3)


def test_summary_interpolates(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (8.0,)], "v double")
    row = explore.score_summary(df, ["v"]).first()
    assert (row["p25"], row["p50"], row["p75"]) == (1.75, 3.0, 5.0)


def test_histogram_keeps_empty_bins(spark):
    df = spark.createDataFrame([(0.0,), (0.1,), (10.0,)], "v double")
    rows = {r["bin"]: r for r in explore.score_histogram(df, ["v"]).collect()}
    assert len(rows) == 20 and (rows[0]["rows"], rows[1]["rows"], rows[19]["rows"]) == (2, 0, 1)
    assert rows[4]["bin_start"] == pytest.approx(2.0) and rows[4]["mean"] == pytest.approx(10.1 / 3)


def test_histogram_of_one_value(spark):
    rows = explore.score_histogram(spark.createDataFrame([(3.0,)] * 4, "v double"), ["v"]).collect()
    assert sum(r["rows"] for r in rows) == 4


def test_rank_shift(measured):
    pdf = measured.toPandas()
    raw = pdf.sort_values(["avg_rating", "business_id"], ascending=[False, True])["business_id"].tolist()
    pop = pdf.sort_values(["popularity_score", "business_id"], ascending=[False, True])["business_id"].tolist()
    shifts = explore.rank_shift(measured)
    rows = {r["business_id"]: r for r in shifts.collect()}
    assert all((rows[k]["rank_raw"], rows[k]["rank_pop"]) == (raw.index(k), pop.index(k)) for k in raw)
    movers = explore.rank_movers(shifts, 3).collect()
    ordered = sorted(rows.values(), key=lambda r: (r["rank_shift"], r["business_id"]))
    assert {r["business_id"] for r in movers if r["direction"] == "up"} == {r["business_id"] for r in ordered[:3]}
    assert max(r["rank_shift"] for r in movers) == ordered[-1]["rank_shift"]


def test_top_by_city(scores):
    rows = [(r["city"], r["position"], r["business_id"], r["colour"]) for r in explore.top_by_city(scores, 2).collect()]
    assert sorted(rows) == [("C", 1, "a", "#c62828"), ("C", 2, "b", "#2e7d32"), ("D", 1, "d", "#2e7d32"), ("D", 2, "f", "#2e7d32")]
    assert not any(math.isnan(p) for _, p, _, _ in rows)
