"""Registered queries: one per operator, each over the whole tables of a folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from venuerank.functions.geo import haversine_km
from venuerank.functions.scoring import status
from venuerank.functions.text import unigrams_and_bigrams
from venuerank.operators import (
    classifier, clean, explore, factors, increment, metro, places, profiles, recommend, sampling, scores, search, sentiment, serving, sketches,
)
from venuerank.operators.neighborhoods import add_neighborhood_labels, largest_cells, metro_centres
from venuerank.operators.ranking import ordered_position
from venuerank.plans import round_trip
from venuerank.plans.gold import Gold, gold
from venuerank.plans.serving_sql import serve
from venuerank.session import materialise, shared_dir, sibling
from venuerank.sinks.guards import duplicate_keys
from venuerank.sinks.observed import watched, write_observed
from venuerank.sources import star_schema

# Digits compared. Means of coordinates given to a thousandth often end in a 5 at the seventh
# digit, where rounding would hang on the last bits; they are compared to two digits more.
DIGITS = 6
CENTRE_DIGITS = 8
CENTRES = {"center_lat", "center_lng", "city_lat", "city_lng"}
METRO = "City 1"
CITY = "City 3"
WORST_RMSE = 4.0  # stars run from 1 to 5
CUISINE = "Mexican"
TASTE = ["Mexican", "Bars"]
PHRASES = ["best mexican restaurants", "fast food", "quiet coffee tea nightlife", " \t"]
# metros whose profiles are left to the fallback, as if they had not been indexed yet
UNPROFILED = ["City 1", "City 10"]
SAMPLE = 10_000
DAMAGED = "-13"  # reviews whose id ends so are written as broken lines
# a venue's vector spreads over all words of all its reviews, which these tables make of invented words
MATCH = 0.002


def digits(column: str) -> int:
    return CENTRE_DIGITS if column in CENTRES else DIGITS


def rounded(df: DataFrame) -> DataFrame:
    """Sums of doubles differ in their last bits between engines and runs."""
    return df.select(*[
        F.round(c, digits(c)).alias(c) if t in ("double", "float") else F.col(c) for c, t in df.dtypes
    ])


# --- clean ---

def business_scores(g: Gold) -> DataFrame:
    totals = scores.review_totals(g.clean_fact_rows, star_schema.AS_OF)
    return scores.score_from_totals(totals, g.businesses)


def business_scores_grouped(g: Gold) -> DataFrame:
    return scores.compute_business_scores(g.enriched_fact_rows)


def clean_businesses(g: Gold) -> DataFrame:
    return metro.assign_metros(clean.open_food_businesses(g.business_rows), g.metro_map)


def city_anchors(g: Gold) -> DataFrame:
    return metro.city_anchors(clean.open_food_businesses(g.business_rows))


def city_priority(g: Gold) -> DataFrame:
    placed = ordered_position(g.city_centres, metro.by_volume(), "turn")
    return placed.select("city_key", "total_reviews", "turn")


def metro_map(g: Gold) -> DataFrame:
    return metro.build_metro_map(g.city_centres)


def venue_distance(g: Gold) -> DataFrame:
    """How far each venue lies from the centre of its own city."""
    tidy = clean.open_food_businesses(g.business_rows).select("business_id", "city_key", "latitude", "longitude")
    centre = g.city_centres.select("city_key", "center_lat", "center_lng")
    km = haversine_km(F.col("latitude"), F.col("longitude"), F.col("center_lat"), F.col("center_lng"))
    return tidy.join(centre, "city_key").select("business_id", "city_key", km.alias("distance_km"))


# --- sentiment and cells ---

def satisfaction_ranking(g: Gold) -> DataFrame:
    return sentiment.satisfaction_ranking(g.grid_aggregates, g.grid_sentiment, g.cell_labels)


def bayesian_cells(g: Gold) -> DataFrame:
    return sentiment.bayesian_cells(g.grid_aggregates, g.grid_sentiment)


def spatial_coverage(g: Gold) -> DataFrame:
    return sentiment.spatial_coverage(g.grid_aggregates, bayesian_cells(g))


def neighborhood_labels(g: Gold) -> DataFrame:
    return add_neighborhood_labels(g.grid_aggregates).select(
        "metro_area", "grid_cell", "center_lat", "center_lng", "restaurant_count", "neighborhood"
    )


# --- profiles and search ---

def profiles_with_fallback(g: Gold) -> DataFrame:
    return profiles.profiles_with_fallback(g.profiles.filter(~F.col("metro_area").isin(UNPROFILED)), g.business_scores)


def tfidf_vocabulary(g: Gold) -> DataFrame:
    """Each metro's terms, counted by the number of venues that have them."""
    return search.vocabulary_summary(g.text_index)


def tfidf_index(g: Gold) -> DataFrame:
    """Each venue's vector over all terms of its reviews, summed up: its terms, weights and heaviest weight."""
    return search.venue_summary(g.text_index)


def tfidf_weights(g: Gold) -> DataFrame:
    """Weights of the phrases' terms in every venue that has them."""
    words = phrases(g).select("metro_area", F.explode(unigrams_and_bigrams(F.col("query"))).alias("term")).distinct()
    return search.term_weights(g.text_index, words)


def phrases(g: Gold) -> DataFrame:
    """Every phrase asked in every metro."""
    asked = F.array(*[F.struct(F.lit(str(i)).alias("number"), F.lit(p).alias("query")) for i, p in enumerate(PHRASES)])
    return (
        g.business_scores.select("metro_area").distinct()
        .select("metro_area", F.inline(asked))
        .select(F.concat_ws("/", "metro_area", "number").alias("query_id"), "metro_area", "query")
    )


def text_search(g: Gold) -> DataFrame:
    return search.search(phrases(g), g.profiles, g.text_index, min_match=MATCH)


# --- recommendations ---

def requests(g: Gold) -> DataFrame:
    return g.recommendations.select("user_id").distinct().withColumn("requested_metro", F.lit(METRO))


def recommendations_for_user(g: Gold) -> DataFrame:
    return serving.recommendations_for(requests(g), g.recommendations, g.business_scores)


def rating_index(g: Gold) -> DataFrame:
    users = recommend.dense_index(g.ratings, "user_id", "idx").select(F.lit("user").alias("kind"), F.col("user_id").alias("id"), "idx")
    venues = recommend.dense_index(g.ratings, "business_id", "idx").select(
        F.lit("business").alias("kind"), F.col("business_id").alias("id"), "idx"
    )
    return users.unionByName(venues)


def venue_mean_predictions(g: Gold) -> DataFrame:
    means = g.business_scores.select("business_id", F.col("avg_rating").alias("prediction"))
    return g.ratings.join(means, "business_id")


def rmse_of_predictions(g: Gold) -> DataFrame:
    return recommend.rmse_table(venue_mean_predictions(g), "stars", "prediction")


# A model's figures hang on its arithmetic; of the queries below SQL checks what must hold for any
# model: who is served, with how many rows, in what order, and that each figure is within its bounds.

def _in_order(df: DataFrame, keys: list[str]) -> Column:
    """Whether a row's predicted rating is no higher than that of the rank before."""
    before = F.lag("predicted_rating").over(Window.partitionBy(*keys).orderBy("rank"))  # ten rows a key
    return F.coalesce(F.col("predicted_rating") <= before, F.lit(True))


def als_top_n(g: Gold) -> DataFrame:
    known = g.ratings.select("business_id").distinct().withColumn("is_known", F.lit(True))
    found = g.model_recommendations.withColumn("in_order", _in_order(g.model_recommendations, ["user_id"]))
    return found.join(known, "business_id", "left").select(
        "user_id", "rank", F.coalesce("is_known", F.lit(False)).alias("is_known"), "in_order"
    )


def als_rmse(g: Gold) -> DataFrame:
    scored = recommend.real_predictions(g.test_predictions)
    rmse = recommend.rmse_table(scored, "stars", "prediction")
    rows = scored.agg(F.count(F.lit(1)).alias("scored"))
    figures = rows.select(F.lit("scored").alias("what"), F.col("scored").cast("double").alias("value")).unionByName(
        rmse.select(F.lit("rmse").alias("what"), F.col("rmse").alias("value"))
    )
    at = lambda name: F.max(F.when(F.col("what") == name, F.col("value")))
    return figures.agg(at("scored").cast("long").alias("scored"), at("rmse").between(0.0, WORST_RMSE).alias("rmse_in_bounds"))


def _swept(table: DataFrame, keys: list[str]) -> DataFrame:
    """The parameters tried, with whether their figure is in bounds and one is the best of all."""
    best = table.agg(F.sum(F.col("is_best").cast("int")).alias("n"), F.min("rmse").alias("least")).first()
    right = F.lit(best["n"] == 1) & (F.col("is_best") == (F.col("rmse") == best["least"]))
    return table.select(*keys, F.col("rmse").between(0.0, WORST_RMSE).alias("rmse_in_bounds"), right.alias("one_best"))


def als_rank_sweep(g: Gold) -> DataFrame:
    return _swept(recommend.rank_sweep(*g.split_matrix), ["rank"])


def als_grid_search(g: Gold) -> DataFrame:
    return _swept(recommend.grid_search(g.split_matrix[0])[1], ["rank", "reg_param"])


def als_requests(g: Gold) -> DataFrame:
    """The model's best venues of one metro, for every user."""
    asked = g.ratings.select("user_id").distinct().withColumn("metro_area", F.lit(METRO))
    found = recommend.recommend_for_requests(g.factor_model, g.matrix, asked, g.business_scores)
    here = g.business_scores.select("business_id", F.col("metro_area").alias("its_metro"))
    keys = ["user_id", "metro_area"]
    return found.withColumn("in_order", _in_order(found, keys)).join(here, "business_id").select(
        *keys, "rank", (F.col("its_metro") == F.col("metro_area")).alias("is_there"), "in_order"
    )


def als_served(g: Gold) -> DataFrame:
    """The model's recommendations as they are served: how many each user sees, and whether they fit the request."""
    shown = serving.recommendations_for(requests(g).join(g.model_recommendations.select("user_id").distinct(), "user_id", "left_semi"), g.model_recommendations, g.business_scores)
    cards = serving.recommendation_cards(shown)
    fits = F.min((F.col("metro_area") == F.col("requested_metro")) | ~F.col("city_filtered"))
    rows = shown.groupBy("user_id").agg(
        F.count(F.lit(1)).between(1, recommend.TOP_N).alias("some_shown"), fits.alias("fits"),
        F.max("predicted_rating").isNotNull().alias("rated"),
    )
    drawn = cards.groupBy("user_id").agg(F.min(F.col("match_pct").between(0, 100) & (F.col("full_stars") + F.col("empty_stars") == 5)).alias("cards_right"))
    return rows.join(drawn, "user_id")


def als_status(g: Gold) -> DataFrame:
    """Figures of the models' outputs: whether each is in bounds, and its status agrees with it."""
    rmse = recommend.rmse_table(g.test_predictions, "stars", "prediction").select(F.lit("rmse").alias("metric"), F.col("rmse").alias("value"), "status", F.lit(WORST_RMSE).alias("most"))
    precision = recommend.predicted_precision_at_k(g.model_recommendations).select(
        F.lit("precision_at_k").alias("metric"), F.col("precision_at_k").alias("value"),
        status(F.col("precision_at_k"), F.col("precision_at_k") >= 0.5).alias("status"), F.lit(1.0).alias("most"),
    )
    f1 = classifier.classification_metrics(g.classifier_predictions).select(F.lit("weighted_f1").alias("metric"), F.col("weighted_f1").alias("value"), "status", F.lit(1.0).alias("most"))
    passed = F.when(F.col("metric") == "rmse", F.col("value") < recommend.MAX_RMSE).when(F.col("metric") == "weighted_f1", F.col("value") >= classifier.MIN_F1).otherwise(F.col("value") >= 0.5)
    return rmse.unionByName(precision).unionByName(f1).select(
        "metric", F.col("value").between(F.lit(0.0), F.col("most")).alias("in_bounds"), (F.col("status") == F.when(passed, "PASS").otherwise("FAIL")).alias("status_agrees")
    )


# --- classifier ---

def wordy_predictions(g: Gold) -> DataFrame:
    """Stand-in classifier that SQL can repeat: long documents are good ones."""
    return classifier.binary_labels(g.judged_rows).withColumn(
        "prediction", (F.length("text") > 1000).cast("double")
    )


def sentiment_classifier_metrics(g: Gold) -> DataFrame:
    figures = classifier.classification_metrics(g.classifier_predictions)
    rows = g.classifier_predictions.agg(F.count(F.lit(1)).alias("n")).scalar()
    return figures.select(
        rows.alias("held_out"), F.col("accuracy").between(0.5, 1.0).alias("accuracy_in_bounds"),
        F.col("weighted_f1").between(0.5, 1.0).alias("f1_in_bounds"),
    )


def sentiment_classifier_confusion(g: Gold) -> DataFrame:
    cells = classifier.confusion_matrix(g.classifier_predictions)
    return cells.select("actual", (F.col("predicted_0") + F.col("predicted_1")).alias("held_out"))


def eval_status(g: Gold) -> DataFrame:
    rmse = rmse_of_predictions(g).select(F.lit("rmse").alias("metric"), F.col("rmse").alias("value"), "status")
    f1 = classifier.classification_metrics(wordy_predictions(g)).select(
        F.lit("weighted_f1").alias("metric"), F.col("weighted_f1").alias("value"), "status"
    )
    precision = recommend.predicted_precision_at_k(g.recommendations).select(
        F.lit("precision_at_k").alias("metric"), F.col("precision_at_k").alias("value"),
        status(F.col("precision_at_k"), F.col("precision_at_k") >= 0.5).alias("status"),
    )
    return rmse.unionByName(f1).unionByName(precision)


# --- sampling ---

def hash_split(g: Gold) -> DataFrame:
    train, test = sampling.split_by_key(g.ratings.select("review_id"), "review_id")
    return train.withColumn("is_train", F.lit(True)).unionByName(test.withColumn("is_train", F.lit(False)))


def stratified_split(g: Gold) -> DataFrame:
    labelled = classifier.binary_labels(g.ratings).select("review_id", F.col("label").cast("int").alias("label"))
    return sampling.stratified_split(labelled, "review_id", "label")


def capped_sample(g: Gold) -> DataFrame:
    return sampling.capped_sample(g.ratings.select("review_id", "stars"), "review_id", SAMPLE)


# --- exact searches and models in slices ---

CLOSE_SCORES = 1e-4  # the library's products are made of 32-bit numbers
CLOSE_RMSE = 0.05
FACTOR_ROUNDS = 6


def als_exact_top_n(g: Gold) -> DataFrame:
    """The model's best venues by bounded search, and whether they score as the library scores them and as the best of all products."""
    model = g.factor_model
    best = factors.best_items(model.userFactors, model.itemFactors, model.rank, recommend.TOP_N)
    found = best.rows.select(F.col("user").alias("user_idx"), F.col("item").alias("business_idx"), F.col("rank").cast("int").alias("rank"), "score")
    found = model.transform(found)
    everything = materialise(recommend.generate_recommendations(model, g.matrix, bounded=False), "all-products")
    theirs = everything.select("user_id", F.col("rank").cast("int").alias("rank"), "predicted_rating")
    met = found.join(g.matrix.users, "user_idx").join(theirs, ["user_id", "rank"])
    close = lambda c: F.abs(F.col("score") - F.col(c)) < CLOSE_SCORES
    return met.select("user_id", "rank", (close("predicted_rating") & close("prediction")).alias("agrees"))


def als_in_slices(g: Gold) -> DataFrame:
    """Factors fitted by sums in slices: ratings they can score, and whether their error is that of the library's model."""
    train, test = g.split_matrix
    fitted = factors.factorise(train, recommend.RANK, FACTOR_ROUNDS, recommend.REGULARISATION)
    scored = factors.predict(test, fitted, recommend.RANK)
    theirs = recommend.rmse_table(g.test_predictions, "stars", "prediction").select("rmse").scalar()
    error = F.col("stars") - F.col("prediction")
    return scored.agg(F.count(F.lit(1)).alias("scored"), F.sqrt(F.avg(error * error)).alias("rmse")).select(
        "scored", (F.abs(F.col("rmse") - theirs) < CLOSE_RMSE).alias("as_the_library")
    )


def flat_factors(g: Gold) -> DataFrame:
    """The factor of each user and venue of a model with one factor."""
    users = g.flat_factors.users.withColumnRenamed("id", "user_idx").join(g.matrix.users, "user_idx")
    venues = g.flat_factors.businesses.withColumnRenamed("id", "business_idx").join(g.matrix.businesses, "business_idx")
    factor = F.col("features")[0].alias("factor")
    return users.select(F.lit("user").alias("kind"), F.col("user_id").alias("id"), factor).unionByName(
        venues.select(F.lit("business").alias("kind"), F.col("business_id").alias("id"), factor)
    )


def flat_top_n(g: Gold) -> DataFrame:
    """Each user's best products of that model, by bounded search."""
    best = factors.best_items(g.flat_factors.users, g.flat_factors.businesses, 1, recommend.TOP_N).rows
    named = best.withColumnRenamed("user", "user_idx").join(g.matrix.users, "user_idx")
    return named.select("user_id", F.col("rank").cast("int").alias("rank"), F.col("score").alias("predicted_rating"))


FLAT_PENALTIES = [0.1, 0.5, 2.0]


def flat_sweep(g: Gold) -> DataFrame:
    """The error of the one-factor model under several penalties, and which is least."""
    return factors.penalty_sweep(*g.split_matrix, 1, 3, FLAT_PENALTIES, start=F.array(F.lit(1.0)))


# --- places, sketches, loads ---

def nearest_centres(g: Gold) -> DataFrame:
    """The two nearest city centres to each cell."""
    cells = g.grid_aggregates.select("metro_area", "grid_cell", F.col("center_lat").alias("lat"), F.col("center_lng").alias("lng"))
    centres = g.city_centres.select(F.col("city_key").alias("place"), F.col("center_lat").alias("lat"), F.col("center_lng").alias("lng"))
    return places.nearest_places(cells, centres, ["metro_area", "grid_cell"], 2)


def _metro_sketches(g: Gold) -> DataFrame:
    """Sketches by metro, rolled up from stored ones by cell."""
    by_cell = materialise(sketches.sketched(g.enriched_fact_rows.select("metro_area", "grid_cell", "user_id", "stars"), ["metro_area", "grid_cell"]), "sketches")
    return materialise(sketches.rolled_up(by_cell, ["metro_area"]), "metro-sketches")


def sketched_metros(g: Gold) -> DataFrame:
    """Users and reviews of each metro as counted, and whether the sketches' figures are within their errors."""
    rows = g.enriched_fact_rows.select("metro_area", "user_id", "stars")
    low, high = F.percentile("stars", F.lit(0.5 - sketches.RANK_ERROR)), F.percentile("stars", F.lit(0.5 + sketches.RANK_ERROR))
    exact = rows.groupBy("metro_area").agg(
        F.count_distinct("user_id").alias("users"), F.count(F.lit(1)).alias("reviews"), F.floor(low).alias("low"), F.ceil(high).alias("high")
    )
    met = sketches.estimates(_metro_sketches(g)).join(exact, "metro_area")
    users = F.col("users")
    return met.select(
        "metro_area", "users", "reviews", sketches.within(F.col("users_hll"), users, sketches.HLL_ERROR).alias("hll_within"),
        sketches.within(F.col("users_theta"), users, sketches.THETA_ERROR).alias("theta_within"),
        (F.col("rows") == F.col("reviews")).alias("all_rows"), F.col("median").between(F.col("low"), F.col("high")).alias("median_within"),
    )


def users_shared_with_metro(g: Gold) -> DataFrame:
    """Users each metro shares with one metro, as counted, and whether the sketches' figure is within its error."""
    rows = g.enriched_fact_rows.select("metro_area", "user_id").distinct()
    here = rows.filter(F.col("metro_area") == METRO).select("user_id", F.lit(True).alias("is_here"))
    size = here.agg(F.count(F.lit(1))).scalar()
    exact = rows.join(here, "user_id", "left").groupBy("metro_area").agg(F.count_if(F.col("is_here")).alias("shared_users"), F.count(F.lit(1)).alias("users"))
    met = sketches.shared_users(_metro_sketches(g), "metro_area", METRO).join(exact, "metro_area")
    either = F.col("users") + size - F.col("shared_users")
    return met.select(
        "metro_area", "shared_users", sketches.within(F.col("shared"), F.col("shared_users"), sketches.THETA_ERROR, either).alias("shared_within"),
        sketches.within(F.col("either"), either, sketches.THETA_ERROR).alias("either_within"),
    )


def incremental_scores(g: Gold) -> DataFrame:
    """Venue scores from a state that took three loads, the second one twice."""
    reviews = g.clean_fact_rows.select("review_id", "business_id", "stars", "date", F.pmod(F.xxhash64("review_id"), F.lit(3)).cast("int").alias("load"))
    state = None
    for given in ([0], [0, 1], [1], [1, 2]):
        state = increment.advance(state, reviews.filter(F.col("load").isin(given)))
    return scores.score_from_totals(increment.totals(state, star_schema.AS_OF), g.businesses)


def _round_trip(g: Gold) -> tuple[DataFrame, DataFrame]:
    reviews = star_schema.reviews(g.spark, g.base, F.md5("text"))
    return round_trip.stored_reviews(reviews, g.businesses.select("business_id", "metro_area"), F.col("review_id").endswith(DAMAGED), METRO)


def observed_write(g: Gold) -> DataFrame:
    """What a write of the clean reviews observed of the rows it scanned and the rows it wrote."""
    spark = sibling(g.spark)
    scanned, seen = watched(star_schema.reviews(spark, g.base), rows=F.count(F.lit(1)), textless=F.count_if(F.col("text").isNull()))
    path = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/observed-{uuid.uuid4().hex}"
    written = write_observed(
        clean.clean_reviews(scanned), path, good=F.count_if(F.col("stars") >= 4), stars=F.sum(F.col("stars").cast("double")), last_date=F.max("date"),
    )
    facts = {"scanned": seen.get["rows"], "without_text": seen.get["textless"], "written": written["rows"], "nulls": sum(written["nulls"].values())}
    facts |= {name: written[name] for name in ("good", "stars", "last_date")}
    return g.spark.range(1).select(*[(F.lit(value).cast("long") if isinstance(value, int) else F.lit(value)).alias(name) for name, value in facts.items()])


def reviews_through_json(g: Gold) -> DataFrame:
    """Reviews of each metro after JSON lines, partitioned Parquet and the replacement of one metro."""
    stored, _ = _round_trip(g)
    return stored.groupBy("metro_area").agg(
        F.count(F.lit(1)).alias("reviews"), F.sum("stars").cast("long").alias("stars"), F.count("text").alias("texts"),
        F.min("text").alias("first_text"), F.max("date").alias("last_date"), F.count_distinct("user_id").alias("users"),
    )


def batch_tables(g: Gold) -> DataFrame:
    """Rows of each table of the batch run over JSON lines, as copied and read back, and a figure all of them count in.

    Review texts go by their digests.
    """
    reviews = star_schema.reviews(g.spark, g.base, F.md5("text"))
    tables = round_trip.served_tables(g.business_rows, reviews, star_schema.AS_OF)
    figures = {
        "reviews_enriched": F.col("recency_weight"), "business_scores": F.col("popularity_score"),
        "grid_aggregates": F.col("avg_popularity"), "business_profiles": F.length("profile_text").cast("double"),
    }
    counted = [
        table.agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct("metro_area").alias("metros"), F.sum(figures.get(name, F.lit(0.0))).alias("figure"))
        .select(F.lit(name).alias("table_name"), "row_count", "metros", "figure")
        for name, table in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def rejected_lines(g: Gold) -> DataFrame:
    """The damaged lines, by what can still be read of them."""
    _, rejected = _round_trip(g)
    return rejected.select(F.regexp_extract("malformed", '"review_id":"([^"]*)"', 1).alias("review_id"), F.col("malformed").endswith("}").alias("is_closed"))


QUERIES: dict[str, Callable[[Gold], DataFrame]] = {
    "business_scores": business_scores,
    "business_scores_grouped": business_scores_grouped,
    "clean_businesses": clean_businesses,
    "clean_reviews": lambda g: g.clean_review_rows,
    "reviews_enriched": lambda g: g.enriched_rows,
    "city_anchors": city_anchors,
    "city_priority": city_priority,
    "venue_distance": venue_distance,
    "metro_map": metro_map,
    "top_cuisine": lambda g: scores.top_cuisine(g.business_scores),
    "grid_aggregates": lambda g: scores.compute_grid_aggregates(g.business_scores),
    "grid_sentiment": lambda g: sentiment.compute_grid_sentiment(g.enriched_fact_rows),
    "grid_sentiment_pivot": lambda g: sentiment.grid_sentiment_by_pivot(g.enriched_fact_rows),
    "cell_sentiment": lambda g: sentiment.cell_sentiment(g.grid_aggregates, g.grid_sentiment),
    "satisfaction_ranking": satisfaction_ranking,
    "bayesian_cells": bayesian_cells,
    "sentiment_chart": lambda g: sentiment.sentiment_chart(bayesian_cells(g)),
    "spatial_coverage": spatial_coverage,
    "metro_centres": lambda g: metro_centres(g.grid_aggregates),
    "largest_cells": lambda g: largest_cells(g.grid_aggregates),
    "neighborhood_labels": neighborhood_labels,
    "cell_bounds": lambda g: serving.cell_rectangles(g.grid_aggregates),
    "heat_points": lambda g: serving.heat_points(g.grid_aggregates),
    "pin_classes": lambda g: serving.business_pins(g.business_scores),
    "metros": lambda g: serving.metros(g.business_scores),
    "cities": lambda g: serving.cities(g.business_scores),
    "in_city": lambda g: serving.in_city(g.business_scores, CITY),
    "businesses_by_cuisine": lambda g: serving.businesses_by_cuisine(g.business_scores, CUISINE),
    "cuisine_tags_by_metro": lambda g: serving.cuisine_tags_by_metro(g.business_scores),
    "metro_summary": lambda g: serving.metro_summary(g.business_scores, g.grid_aggregates, CUISINE),
    "display_table": lambda g: serving.display_table(serving.in_metro(g.business_scores, METRO)),
    "business_profiles": lambda g: profiles.build_profiles(g.enriched_snippet_rows),
    "profiles_with_fallback": profiles_with_fallback,
    "sanitized_profiles": lambda g: profiles.sanitise(g.profiles),
    "tfidf_vocabulary": tfidf_vocabulary,
    "tfidf_index": tfidf_index,
    "tfidf_weights": tfidf_weights,
    "text_search": text_search,
    "search_cards": lambda g: serving.search_cards(text_search(g)),
    "recommendations_for_user": recommendations_for_user,
    "recommendation_details": lambda g: serving.recommendation_details(g.recommendations, g.business_scores),
    "recommendation_pins": lambda g: serving.recommendation_pins(recommendations_for_user(g)),
    "card_fields": lambda g: serving.recommendation_cards(recommendations_for_user(g)),
    "taste_matches": lambda g: serving.taste_matches(g.recommendations, g.business_scores, METRO, TASTE),
    "proxy_user": lambda g: serving.find_proxy_user(g.recommendations, g.business_scores, METRO, TASTE),
    "predicted_precision_at_k": lambda g: recommend.predicted_precision_at_k(g.recommendations),
    "rating_index": rating_index,
    "matrix_size": lambda g: recommend.matrix_size(g.ratings),
    "rmse_of_predictions": rmse_of_predictions,
    "als_top_n": als_top_n,
    "als_rmse": als_rmse,
    "als_rank_sweep": als_rank_sweep,
    "als_grid_search": als_grid_search,
    "als_requests": als_requests,
    "als_served": als_served,
    "als_status": als_status,
    "als_exact_top_n": als_exact_top_n,
    "als_in_slices": als_in_slices,
    "flat_factors": flat_factors,
    "flat_predictions": lambda g: g.flat_predictions.select("review_id", "prediction"),
    "flat_rmse": lambda g: recommend.rmse_table(g.flat_predictions, "stars", "prediction").select("rmse"),
    "flat_top_n": flat_top_n,
    "flat_sweep": flat_sweep,
    "nearest_centres": nearest_centres,
    "sketched_metros": sketched_metros,
    "users_shared_with_metro": users_shared_with_metro,
    "incremental_scores": incremental_scores,
    "observed_write": observed_write,
    "reviews_through_json": reviews_through_json,
    "rejected_lines": rejected_lines,
    "batch_tables": batch_tables,
    "venues_of_city": lambda g: serve(g.spark, "venues_of_city", {"scores": g.business_scores}, city=CITY),
    "venues_by_cuisine": lambda g: serve(g.spark, "venues_by_cuisine", {"scores": g.business_scores}, cuisine=CUISINE),
    "users_matching_taste": lambda g: serve(
        g.spark, "users_matching_taste", {"recommendations": g.recommendations, "scores": g.business_scores}, metro=METRO, cuisines=TASTE,
    ),
    "classification_metrics": lambda g: classifier.classification_metrics(wordy_predictions(g)),
    "confusion_matrix": lambda g: classifier.confusion_matrix(wordy_predictions(g)),
    "sentiment_classifier_metrics": sentiment_classifier_metrics,
    "sentiment_classifier_confusion": sentiment_classifier_confusion,
    "term_classifier_scores": lambda g: g.term_predictions.select("review_id", F.col("label").cast("int").alias("label"), "probability", "prediction"),
    "term_classifier_metrics": lambda g: classifier.classification_metrics(g.term_predictions),
    "term_classifier_confusion": lambda g: classifier.confusion_matrix(g.term_predictions),
    "eval_status": eval_status,
    "hash_split": hash_split,
    "stratified_split": stratified_split,
    "capped_sample": capped_sample,
    "duplicate_keys": lambda g: duplicate_keys(g.ratings, ["user_id", "business_id"]),
    "star_frequency": lambda g: explore.star_frequency(g.review_rows),
    "city_frequency": lambda g: explore.city_frequency(g.business_rows),
    "open_frequency": lambda g: explore.open_frequency(g.business_rows),
    "score_histogram": lambda g: explore.score_histogram(g.business_scores),
    "score_summary": lambda g: explore.score_summary(g.business_scores),
    "rank_shift": lambda g: explore.rank_shift(g.business_scores),
    "rank_movers": lambda g: explore.rank_movers(explore.rank_shift(g.business_scores)),
    "top10_by_city": lambda g: explore.top_by_city(g.business_scores),
}


def run(name: str, spark: SparkSession, base: str) -> DataFrame:
    return rounded(QUERIES[name](gold(spark, base)))
