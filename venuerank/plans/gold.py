"""Gold tables over the star schema, built once per session and folder."""

from __future__ import annotations

from functools import cached_property

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from venuerank.functions.text import snippet
from venuerank.operators import classifier, clean, factors, metro, neighborhoods, profiles, recommend, scores, search, sentiment, term_regression
from venuerank.operators.ranking import top_per_group
from venuerank.operators.sampling import split_by_key
from venuerank.session import apply_defaults, materialise
from venuerank.sources import raw, star_schema

TERM_ROUNDS = 5

_built: dict[tuple[str, str], tuple[str, "Gold"]] = {}


def gold(spark: SparkSession, base: str) -> "Gold":
    """The folder's gold tables; built anew when a file of the folder has changed since."""
    key, seen = (spark.sparkContext.applicationId, base), _state(spark, base)
    if key not in _built or _built[key][0] != seen:
        _built[key] = (seen, Gold(spark, base))
    return _built[key][1]


def _state(spark: SparkSession, base: str) -> str:
    """Names, sizes and times of what lies in a folder, tables of several files included."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base)
    store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = []
    for entry in store.listStatus(path):
        for file in store.listStatus(entry.getPath()) if entry.isDirectory() else [entry]:
            found.append(f"{file.getPath()} {file.getLen()} {file.getModificationTime()}")
    return "\n".join(sorted(found))


class Gold:
    """Serving queries read these tables, which are stored the first time they are asked for.

    Lower-case names are stored tables; the `*_rows` properties stay lazy.
    """

    def __init__(self, spark: SparkSession, base: str):
        self.spark = apply_defaults(spark)
        self.base = base

    # --- lazy inputs ---

    @property
    def business_rows(self) -> DataFrame:
        return star_schema.businesses(self.spark, self.base)

    @property
    def review_rows(self) -> DataFrame:
        return star_schema.reviews(self.spark, self.base)

    @property
    def clean_review_rows(self) -> DataFrame:
        return clean.clean_reviews(self.review_rows)

    @property
    def enriched_rows(self) -> DataFrame:
        return clean.build_enriched(self.clean_review_rows, self.businesses, star_schema.AS_OF)

    @property
    def clean_fact_rows(self) -> DataFrame:
        """`clean_review_rows` without their texts, of which it is only asked whether they are there."""
        there = F.when(F.col("text").isNotNull(), F.lit(""))
        return clean.clean_reviews(star_schema.reviews(self.spark, self.base, there)).drop("text")

    @property
    def enriched_fact_rows(self) -> DataFrame:
        return clean.build_enriched(self.clean_fact_rows, self.businesses, star_schema.AS_OF)

    @property
    def enriched_snippet_rows(self) -> DataFrame:
        """Enriched reviews whose texts are cut to what a profile shows before any join."""
        reviews = clean.clean_reviews(star_schema.reviews(self.spark, self.base, snippet(F.col("text"))))
        return clean.build_enriched(reviews, self.businesses, star_schema.AS_OF)

    @property
    def judged_rows(self) -> DataFrame:
        return star_schema.judged_documents(self.spark, self.base)

    # --- stored tables ---

    @cached_property
    def city_centres(self) -> DataFrame:
        return materialise(metro.city_anchors(clean.open_food_businesses(self.business_rows)), "city-centres")

    @cached_property
    def metro_map(self) -> DataFrame:
        return metro.build_metro_map(self.city_centres)

    @cached_property
    def businesses(self) -> DataFrame:
        tidy = clean.open_food_businesses(self.business_rows)
        return materialise(metro.assign_metros(tidy, self.metro_map), "businesses")

    @cached_property
    def review_totals(self) -> DataFrame:
        return materialise(scores.review_totals(self.clean_fact_rows, star_schema.AS_OF), "review-totals")

    @cached_property
    def business_scores(self) -> DataFrame:
        return materialise(scores.score_from_totals(self.review_totals, self.businesses), "business-scores")

    @cached_property
    def grid_aggregates(self) -> DataFrame:
        return materialise(scores.compute_grid_aggregates(self.business_scores), "grid-aggregates")

    @cached_property
    def grid_sentiment(self) -> DataFrame:
        return materialise(sentiment.sentiment_from_totals(self.review_totals, self.businesses), "grid-sentiment")

    @cached_property
    def cell_labels(self) -> DataFrame:
        return materialise(neighborhoods.add_neighborhood_labels(self.grid_aggregates), "cell-labels")

    @cached_property
    def profiles(self) -> DataFrame:
        return materialise(profiles.build_profiles(self.enriched_snippet_rows), "profiles")

    @cached_property
    def text_index(self) -> search.TextIndex:
        return search.build_index(self.business_scores, self.enriched_rows.select("business_id", "text"))

    @cached_property
    def ratings(self) -> DataFrame:
        return materialise(raw.ratings(self.enriched_fact_rows), "ratings")

    @cached_property
    def matrix(self) -> recommend.RatingMatrix:
        return recommend.stored_matrix(self.ratings, "review_id")

    @property
    def split_matrix(self) -> tuple[DataFrame, DataFrame]:
        return split_by_key(self.matrix.ratings, "review_id")

    @cached_property
    def factor_model(self) -> ALSModel:
        return recommend.train_als(self.split_matrix[0])

    @cached_property
    def flat_factors(self) -> factors.Factors:
        """One factor each, fitted in three rounds from equal venues, which SQL can repeat."""
        return factors.factorise(self.split_matrix[0], 1, 3, recommend.REGULARISATION, start=F.array(F.lit(1.0)))

    @cached_property
    def flat_predictions(self) -> DataFrame:
        return materialise(factors.predict(self.split_matrix[1], self.flat_factors, 1), "flat-predictions")

    @cached_property
    def test_predictions(self) -> DataFrame:
        return materialise(self.factor_model.transform(self.split_matrix[1]), "test-predictions")

    @cached_property
    def model_recommendations(self) -> DataFrame:
        return materialise(recommend.generate_recommendations(self.factor_model, self.matrix), "model-recommendations")

    @cached_property
    def classifier_predictions(self) -> DataFrame:
        return materialise(classifier.predict_held_out(self.judged_rows), "classifier-predictions")

    @cached_property
    def term_predictions(self) -> DataFrame:
        """The table-based classifier after a few steps, which SQL can repeat."""
        return materialise(term_regression.predict_held_out(self.judged_rows, TERM_ROUNDS), "term-predictions")

    @cached_property
    def recommendations(self) -> DataFrame:
        """Stand-in for a model's output that SQL can repeat: each user's best-rated venues."""
        rated = self.ratings.groupBy("user_id", "business_id").agg(F.avg("stars").alias("predicted_rating"))
        order = [F.desc("predicted_rating"), F.asc("business_id")]
        return materialise(top_per_group(rated, ["user_id"], order, 10, ["business_id"], "rank"), "recommendations")
