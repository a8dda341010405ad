import pytest
from pyspark.ml.feature import CountVectorizer

from venuerank.operators import classifier

GOOD = ["wonderful tasty meal", "great friendly staff", "loved this lovely place", "excellent fresh food"]
BAD = ["terrible cold soup", "awful rude waiter", "hated this dirty place", "horrible stale bread"]


def corpus(spark, n=120, neutral=20):
    rows = [(f"g{i}", GOOD[i % 4] + f" visit {i}", 5) for i in range(n)]
    rows += [(f"b{i}", BAD[i % 4] + f" visit {i}", 1) for i in range(n // 2)]
    rows += [(f"n{i}", "so so", 3) for i in range(neutral)]
    return spark.createDataFrame(rows, "review_id string, text string, stars int")


def test_learns_a_separable_corpus(spark):
    predictions = classifier.predict_held_out(corpus(spark)).cache()
    assert predictions.count() == 36  # a fifth of each label, no neutral review
    row = classifier.classification_metrics(predictions).first()
    assert row["accuracy"] > 0.85 and row["weighted_f1"] >= 0.80 and row["status"] == "PASS"
    library = classifier.ml_metrics(predictions)
    assert row["accuracy"] == pytest.approx(library["accuracy"])
    assert row["weighted_f1"] == pytest.approx(library["f1"])
    assert sum(r["predicted_0"] + r["predicted_1"] for r in classifier.confusion_matrix(predictions).collect()) == 36


def test_cap_bounds_the_fit_only(spark):
    train, test = classifier.prepare(corpus(spark), cap=50)
    assert (train.count(), test.count()) == (50, 36)
    assert train.join(test, "review_id").isEmpty()


def test_fits_on_all_rows_unless_capped(spark):
    """The fit took at most 200,000 reviews."""
    rows = spark.range(260_000).selectExpr("cast(id AS string) AS review_id", "'so so' AS text", "cast(1 + 4 * (id % 2) AS int) AS stars")
    train, test = classifier.prepare(rows)
    assert (train.count(), test.count()) == (208_000, 52_000)


def test_fitting_rows_are_dealt_over_the_partitions(spark):
    """A few long texts fill one advisory partition, which left the whole fit to one task."""
    train, test = classifier.prepare(corpus(spark))
    assert len(set(train.inputFiles())) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert set(train.inputFiles()) == set(test.inputFiles())  # texts are fetched once for both


def test_vocabulary_is_that_of_the_library_and_repeats(spark):
    rows = spark.createDataFrame([(["b", "a", "c c"] * 2 + ["d"],), (["e", "a", "f", "a"],), ([],), (["g", "b"],)], "terms array<string>")
    library = CountVectorizer(inputCol="terms", outputCol="counts", vocabSize=3).fit(rows).vocabulary
    assert classifier.most_frequent_terms(rows, 3) == ["a", "b", "c c"] == library
    # of terms found once, the first in the alphabet are kept however the rows lie
    for parts in (1, 3):
        assert classifier.most_frequent_terms(rows.repartition(parts), 5) == ["a", "b", "c c", "d", "e"]


def test_needs_words(spark):
    silent = spark.createDataFrame([(f"s{i}", "", 1 + 4 * (i % 2)) for i in range(40)], "review_id string, text string, stars int")
    with pytest.raises(ValueError):
        classifier.predict_held_out(silent)


def test_needs_both_labels(spark):
    neutral = spark.createDataFrame([(f"n{i}", "so so", 3) for i in range(20)], "review_id string, text string, stars int")
    with pytest.raises(ValueError):
        classifier.predict_held_out(neutral)


def test_labels(spark):
    rows = spark.createDataFrame([("a", 2.5), ("b", 3.0), ("c", 4.0), ("d", 3.5)], "review_id string, stars double")
    assert {r["review_id"]: r["label"] for r in classifier.binary_labels(rows).collect()} == {"a": 0.0, "c": 1.0, "d": 0.0}


def test_metrics_match_the_library(spark):
    rows = [(0.0, 0.0)] * 5 + [(0.0, 1.0)] * 3 + [(1.0, 1.0)] * 7 + [(1.0, 0.0)] * 2 + [(2.0, 1.0)]
    predictions = spark.createDataFrame(rows, "label double, prediction double")
    row = classifier.classification_metrics(predictions).first()
    library = classifier.ml_metrics(predictions)
    assert (row["accuracy"], row["weighted_f1"]) == (pytest.approx(library["accuracy"]), pytest.approx(library["f1"]))


def test_confusion_matrix(spark):
    rows = [(0.0, 0.0)] * 2 + [(1.0, 0.0)] * 3
    found = {r["actual"]: (r["predicted_0"], r["predicted_1"])
             for r in classifier.confusion_matrix(spark.createDataFrame(rows, "label double, prediction double")).collect()}
    assert found == {0: (2, 0), 1: (3, 0)}
