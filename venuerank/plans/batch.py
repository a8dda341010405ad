"""The whole batch run: raw records to gold tables."""

from __future__ import annotations

import datetime
import logging
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from venuerank.operators import classifier, clean, profiles, recommend, scores, sentiment
from venuerank.operators.metro import METRO_RADIUS_KM
from venuerank.session import apply_defaults, materialise, sibling
from venuerank.sinks.observed import write_observed
from venuerank.sinks.writers import jdbc_settings, ready_for_serving, write_jdbc, write_parquet
from venuerank.sources.raw import cell_stars, join_path, labelled_text, malformed_lines, ratings, read_json, read_table

log = logging.getLogger(__name__)

STAGES = ("clean", "aggregate", "recommend", "sentiment", "profiles")
FITTING = ("recommend", "sentiment")  # stages that fit models can't be observed


class BatchOptions(NamedTuple):
    raw: str
    output: str
    as_of: datetime.date | str
    stages: tuple[str, ...] = STAGES
    business_file: str = "business.json"
    review_file: str = "review.json"
    radius_km: float = METRO_RADIUS_KM
    rank: int = recommend.RANK
    max_iter: int = recommend.ITERATIONS
    reg_param: float = recommend.REGULARISATION
    cross_validate: bool = False
    to_database: bool = False
    sample_rows: int | None = None
    vocabulary: int = classifier.VOCABULARY_SIZE


class _Sink:
    """Writes gold tables and reports their rows and nulls: as observed, or of fitting stages from the file footers."""

    def __init__(self, options: BatchOptions, observing: SparkSession):
        self.options = options
        self.observing = observing
        self.nulls: dict[str, dict[str, int]] = {}
        self.settings = jdbc_settings() if options.to_database else None
        self.rows: dict[str, int] = {}

    def store(self, df: DataFrame, name: str, partition_by: str | None = None) -> None:
        path = join_path(self.options.output, name)
        if df.sparkSession is self.observing:
            found = write_observed(df, path, partition_by)
            self.rows[name], self.nulls[name] = found["rows"], {c: n for c, n in found["nulls"].items() if n}
            log.info("%s: %d rows, nulls %s", name, self.rows[name], self.nulls[name])
        else:
            write_parquet(df, path, partition_by)
            self.rows[name] = df.sparkSession.read.schema(df.schema).parquet(path).count()

    def publish(self, spark: SparkSession, name: str) -> None:
        if self.settings:
            stored = read_table(spark, self.options.output, name)
            write_jdbc(ready_for_serving(stored, name), name, self.settings)


def _clean(spark: SparkSession, options: BatchOptions, sink: _Sink) -> None:
    raw_businesses = read_json(spark, options.raw, options.business_file, "business")
    raw_reviews = read_json(spark, options.raw, options.review_file, "review")
    businesses = materialise(clean.clean_businesses(raw_businesses, options.radius_km), "businesses")
    enriched = clean.build_enriched(clean.clean_reviews(raw_reviews), businesses, options.as_of)
    sink.store(enriched, "reviews_enriched", "metro_area")
    files = (("business", options.business_file), ("review", options.review_file))
    lines = [
        malformed_lines(spark, options.raw, file, entity).select(F.lit(entity).alias("entity"), F.col("malformed").alias("line"))
        for entity, file in files
    ]
    sink.store(lines[0].unionByName(lines[1]), "rejected_lines")
    if sink.rows["rejected_lines"]:
        log.warning("%d input lines could not be read, see rejected_lines", sink.rows["rejected_lines"])


def _aggregate(spark: SparkSession, options: BatchOptions, sink: _Sink) -> None:
    enriched = read_table(spark, options.output, "reviews_enriched")
    sink.store(scores.compute_business_scores(enriched), "business_scores", "metro_area")
    stored = read_table(spark, options.output, "business_scores")
    sink.store(scores.compute_grid_aggregates(stored), "grid_aggregates", "metro_area")
    sink.publish(spark, "business_scores")
    sink.publish(spark, "grid_aggregates")


def _recommend(spark: SparkSession, options: BatchOptions, sink: _Sink) -> None:
    enriched = read_table(spark, options.output, "reviews_enriched")
    rated = ratings(enriched)
    fixed = {} if options.cross_validate else {"rank": options.rank, "reg_param": options.reg_param}
    recommendations, rmse = recommend.fit_and_recommend(
        rated, "review_id", cross_validate=options.cross_validate, max_iter=options.max_iter, **fixed
    )
    sink.store(recommendations, "als_recommendations")
    sink.store(rmse, "als_rmse")
    sink.publish(spark, "als_recommendations")


def _sentiment(spark: SparkSession, options: BatchOptions, sink: _Sink) -> None:
    enriched = read_table(spark, options.output, "reviews_enriched")
    sink.store(sentiment.compute_grid_sentiment(cell_stars(enriched)), "grid_sentiment")
    sink.publish(spark, "grid_sentiment")
    reviews = labelled_text(enriched)
    if classifier.binary_labels(reviews).select("label").distinct().count() < 2:
        log.warning("no text classifier: the reviews have one label only")
        return
    predictions = materialise(classifier.predict_held_out(reviews, options.sample_rows, options.vocabulary), "predictions")
    sink.store(classifier.classification_metrics(predictions), "sentiment_metrics")
    sink.store(classifier.confusion_matrix(predictions), "sentiment_confusion")


def _profiles(spark: SparkSession, options: BatchOptions, sink: _Sink) -> None:
    enriched = read_table(spark, options.output, "reviews_enriched")
    sink.store(profiles.build_profiles(enriched, stored=True), "business_profiles", "metro_area")
    sink.publish(spark, "business_profiles")


_RUN = {
    "clean": _clean, "aggregate": _aggregate, "recommend": _recommend,
    "sentiment": _sentiment, "profiles": _profiles,
}


def run_batch(spark: SparkSession, options: BatchOptions) -> dict[str, int]:
    """Run the chosen stages in order; returns the rows written per table."""
    unknown = [s for s in options.stages if s not in _RUN]
    if unknown:
        raise ValueError(f"unknown stages {unknown}, choose from {list(STAGES)}")
    apply_defaults(spark)
    sink = _Sink(options, sibling(spark))  # checks the database settings before any work
    for stage in STAGES:
        if stage in options.stages:
            _RUN[stage](spark if stage in FITTING else sink.observing, options, sink)
    return sink.rows
