"""Review text classifier: TF-IDF of one- and two-word terms, then logistic regression."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import IDF, CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from venuerank.functions.scoring import status
from venuerank.functions.text import unigrams_and_bigrams
from venuerank.operators.sampling import capped_sample, stratified_split
from venuerank.session import materialise

VOCABULARY_SIZE = 10_000
TEST_FRACTION = 0.2
SEED = 42
MIN_F1 = 0.80


def binary_labels(reviews: DataFrame) -> DataFrame:
    """Reviews that are not three stars, labelled 1 from four stars up."""
    return reviews.filter(F.col("stars") != 3).withColumn("label", (F.col("stars") >= 4).cast("double"))


def prepare(reviews: DataFrame, cap: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Fitting rows, all of them unless `cap` says how many, and all held-out rows: `review_id, label, terms`.

    Keys are split, and sampled under a cap, first. Texts are fetched once, for the rows chosen, and stored dealt evenly over the
    session's partitions; terms, three times their size, are made where they are read.
    """
    labelled = binary_labels(reviews).select("review_id", "text", "label")
    split = stratified_split(labelled.select("review_id", "label"), "review_id", "label", TEST_FRACTION, SEED)
    keys = materialise(split.select("review_id", "is_test"), "split")
    if cap is not None:
        chosen = capped_sample(keys.filter("NOT is_test"), "review_id", cap, SEED)
        keys = materialise(chosen.unionByName(keys.filter("is_test")), "chosen")
    parts = int(reviews.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = materialise(labelled.join(keys, "review_id").repartition(parts, "review_id"), "chosen-texts")
    rows = found.select("is_test", "review_id", "label", unigrams_and_bigrams(F.col("text")).alias("terms"))
    return rows.filter("NOT is_test").drop("is_test"), rows.filter("is_test").drop("is_test")


def most_frequent_terms(rows: DataFrame, size: int) -> list[str]:
    """The `size` terms found most often in `rows(terms)`, ties in the order of the alphabet."""
    counts = rows.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("found"))
    return [row["term"] for row in counts.orderBy(F.desc("found"), "term").limit(size).collect()]


def predict_held_out(reviews: DataFrame, cap: int | None = None, vocabulary: int = VOCABULARY_SIZE) -> DataFrame:
    """`review_id, label, prediction` of every held-out review.

    Fitted on every other review unless `cap` bounds their number; `vocabulary` bounds the terms the model holds in the driver.
    """
    train, test = prepare(reviews, cap)
    sizes = train.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("label").alias("classes")).first()
    if sizes["classes"] < 2:
        raise ValueError("the classifier needs reviews of both labels")

    # the library's own fit of a vocabulary counts in hash maps of JVM objects and caches every term
    terms = most_frequent_terms(train, vocabulary)
    if not terms:
        raise ValueError("the classifier needs reviews with words")
    counter = CountVectorizerModel.from_vocabulary(terms, inputCol="terms", outputCol="counts")
    counted = materialise(counter.transform(train).select("review_id", "label", "counts"), "counts")
    inverse = IDF(inputCol="counts", outputCol="unused").fit(counted).idf
    # one more than the library's inverse document frequency keeps terms found everywhere
    weigh = ElementwiseProduct(
        inputCol="counts", outputCol="weighted", scalingVec=Vectors.dense(inverse.toArray() + 1)
    )
    scale = Normalizer(inputCol="weighted", outputCol="features", p=2.0)

    def features(df: DataFrame) -> DataFrame:
        return scale.transform(weigh.transform(df)).select("review_id", "label", "features")

    # strength 1 of the ridge penalty on the summed loss is 1/n on the mean loss
    model = LogisticRegression(
        maxIter=1000, tol=1e-4, regParam=1.0 / sizes["n"], elasticNetParam=0.0, standardization=False
    ).fit(features(counted))
    return model.transform(features(counter.transform(test))).select("review_id", "label", "prediction")


def classification_metrics(predictions: DataFrame) -> DataFrame:
    """One row with accuracy, support-weighted F1 and pass status, from label and prediction."""
    cells = predictions.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("rows"))
    hit = F.when(F.col("label") == F.col("prediction"), F.col("rows")).otherwise(0)
    actual = cells.groupBy("label").agg(F.sum("rows").alias("actual"), F.sum(hit).alias("hits"))
    guessed = cells.groupBy(F.col("prediction").alias("label")).agg(F.sum("rows").alias("guessed"))
    f1 = 2 * F.col("hits") / (F.col("actual") + F.coalesce("guessed", F.lit(0)))
    return (
        actual.join(guessed, "label", "left")
        .agg(
            (F.sum("hits") / F.sum("actual")).alias("accuracy"),
            (F.sum(f1 * F.col("actual")) / F.sum("actual")).alias("weighted_f1"),
        )
        .withColumn("status", status(F.col("weighted_f1"), F.col("weighted_f1") >= MIN_F1))
    )


def ml_metrics(predictions: DataFrame) -> dict[str, float]:
    """The same two figures from the library's evaluator."""
    evaluator = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction")
    return {name: evaluator.setMetricName(name).evaluate(predictions) for name in ("accuracy", "f1")}


def confusion_matrix(predictions: DataFrame) -> DataFrame:
    """One row per actual label, one column per predicted label."""
    return (
        predictions.withColumn("guess", F.col("prediction").cast("int"))
        .groupBy(F.col("label").cast("int").alias("actual")).pivot("guess", [0, 1]).count()
        .withColumnsRenamed({"0": "predicted_0", "1": "predicted_1"})
        .na.fill(0, ["predicted_0", "predicted_1"])
    )
