import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from venuerank.operators import classifier, term_regression

WORDS = ["good", "bad", "food", "slow", "warm", "table", "soup", "again"]
SCHEMA = "review_id string, text string, stars int"


def corpus(spark, n=60):
    """Texts of five words; the label mostly follows the first two."""
    rng = np.random.default_rng(5)
    rows = []
    for i in range(n):
        words = rng.choice(WORDS, 5).tolist()
        score = words.count("good") - words.count("bad") + rng.normal(0, 0.5)
        rows.append((f"r{i}", " ".join(words), 5 if score > 0 else 1))
    return spark.createDataFrame(rows, SCHEMA)


def matrix(counts, reviews, idf):
    """Rows of length 1 by definition."""
    at = {t: i for i, t in enumerate(sorted(idf))}
    x = np.zeros((len(reviews), len(at)))
    for i, review in enumerate(reviews):
        for term, tf in counts[review].items():
            if term in at:
                x[i, at[term]] = tf * idf[term]
    lengths = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(lengths > 0, lengths, 1)


def steps(x, y, rounds):
    """The same descent on whole arrays, the intercept as a last column without a penalty."""
    n = len(x)
    z = np.hstack([x, np.ones((n, 1))])
    penalty = np.append(np.ones(x.shape[1]), 0) / n
    w = v = np.zeros(z.shape[1])
    for k in range(1, rounds + 1):
        residual = 1 / (1 + np.exp(-z @ v)) - y
        new = v - (z.T @ residual / n + penalty * v) / (0.5 + 1 / n)
        w, v = new, new + (k - 1) / (k + 2) * (new - w)
    return w


def gathered(counts):
    found = {}
    for r in counts.collect():
        found.setdefault(r["review_id"], {})[r["term"]] = r["tf"]
    return found


@pytest.fixture(scope="module")
def parts(spark):
    reviews = corpus(spark).cache()
    train, test = term_regression.split(reviews)
    counts = term_regression.term_counts(reviews).cache()
    return reviews, train, test, counts


def test_terms_are_counted_over_whole_texts(spark):
    found = gathered(term_regression.term_counts(spark.createDataFrame([("a", "Good good food", 5), ("b", "", 1), ("c", None, 1)], SCHEMA)))
    assert found == {"a": {"good": 2, "food": 1, "good good": 1, "good food": 1}}


@pytest.mark.parametrize("vocabulary", [None, 6])
def test_steps_equal_those_on_whole_arrays(parts, vocabulary):
    _, train, test, counts = parts
    model = term_regression.fit(train, counts, 4, vocabulary)
    fitted = {r["term"]: r for r in model.terms.collect()}
    labels = {r["review_id"]: r["label"] for r in train.collect()}
    tf = gathered(counts)
    total, df = {}, {}
    for review in labels:
        for term, n in tf[review].items():
            total[term], df[term] = total.get(term, 0) + n, df.get(term, 0) + 1
    chosen = sorted(total, key=lambda t: (-total[t], t))[:vocabulary]
    idf = {t: np.log((len(labels) + 1) / (df[t] + 1)) + 1 for t in chosen}
    assert {t: pytest.approx(v) for t, v in idf.items()} == {t: r["idf"] for t, r in fitted.items()}
    reviews = sorted(labels)
    w = steps(matrix(tf, reviews, idf), np.array([labels[r] for r in reviews]), 4)
    assert [fitted[t]["weight"] for t in sorted(idf)] == pytest.approx(w[:-1].tolist(), abs=1e-12)
    assert model.intercept == pytest.approx(w[-1], abs=1e-12)
    held = sorted(r["review_id"] for r in test.collect())
    margins = matrix(tf, held, idf) @ w[:-1] + w[-1]
    scored = {r["review_id"]: r for r in term_regression.predict(model, test, counts).collect()}
    assert [scored[r]["probability"] for r in held] == pytest.approx((1 / (1 + np.exp(-margins))).tolist(), abs=1e-12)
    assert [scored[r]["prediction"] for r in held] == (margins > 0).astype(float).tolist()


def test_the_descent_ends_at_the_library_model(spark, parts):
    """Both minimise the same loss; the library's fit has it at strength 1/n on the mean."""
    _, train, _, counts = parts
    labels = {r["review_id"]: r["label"] for r in train.collect()}
    reviews = sorted(labels)
    tf = gathered(counts)
    x = matrix(tf, reviews, {t: 1.0 for r in reviews for t in tf[r]})
    y = np.array([labels[r] for r in reviews])
    rows = spark.createDataFrame([(float(a), Vectors.dense(b)) for a, b in zip(y, x)], ["label", "features"])
    library = LogisticRegression(maxIter=1000, tol=1e-10, regParam=1.0 / len(y), elasticNetParam=0.0, standardization=False).fit(rows)
    w = steps(x, y, 3000)
    assert w[:-1] == pytest.approx(library.coefficients.toArray(), abs=1e-4)
    assert w[-1] == pytest.approx(library.intercept, abs=1e-4)


def test_learns_and_scores_unknown_texts_by_the_intercept(spark, parts):
    reviews, train, test, counts = parts
    model = term_regression.fit(train, counts, 12)
    share = term_regression.predict(model, train, counts).agg(F.avg((F.col("label") == F.col("prediction")).cast("int"))).first()[0]
    assert share > 0.8
    strange = spark.createDataFrame([("x", "zzz", 1), ("y", "", 1), ("z", None, 5)], SCHEMA)
    keys = classifier.binary_labels(strange).select("review_id", "label")
    scored = term_regression.predict(model, keys, term_regression.term_counts(strange)).collect()
    assert [r["probability"] for r in scored] == pytest.approx([1 / (1 + np.exp(-model.intercept))] * 3)


def test_needs_both_labels(spark):
    reviews = spark.createDataFrame([(f"r{i}", "so so", 5) for i in range(10)], SCHEMA)
    with pytest.raises(ValueError):
        term_regression.predict_held_out(reviews)


def _held_out(reviews, rounds=4):
    return {r["review_id"]: (r["label"], pytest.approx(r["probability"], abs=1e-12), r["prediction"]) for r in term_regression.predict_held_out(reviews, rounds).collect()}


@pytest.mark.parametrize("limits", [{"SMALL_PART": 20, "PACK": 7, "SLICE_WORDS": 30}, {"SMALL_PART": 20, "TERM_ROWS": 25}])
def test_parts_rows_of_parts_and_frequent_terms_change_nothing(spark, parts, monkeypatch, limits):
    """Terms in several parts, cut into rows of a few counts, or so frequent that they aren't packed."""
    reviews, train, test, counts = parts
    model = term_regression.fit(train, counts, 4)
    separate = {r["review_id"]: r for r in term_regression.predict(model, test, counts).collect()}
    expected = _held_out(reviews)
    assert {k: (r["label"], r["probability"], r["prediction"]) for k, r in separate.items()} == expected
    for name, value in limits.items():
        monkeypatch.setattr(term_regression, name, value)
    found = {r["review_id"]: (r["label"], r["probability"], r["prediction"]) for r in term_regression.predict_held_out(reviews, 4).collect()}
    assert found == expected
    again = {r["term"]: (r["idf"], r["weight"]) for r in term_regression.fit(train, counts, 4).terms.collect()}
    assert {r["term"]: (pytest.approx(r["idf"]), pytest.approx(r["weight"], abs=1e-12)) for r in model.terms.collect()} == again


def test_a_step_shuffles_no_counts(spark, parts):
    """Packs are met where they lie: the only rows shuffled are two numbers for each part of a review."""
    _, train, _, counts = parts
    rows = counts.withColumn("is_test", F.lit(False))
    dealt = term_regression._deal(rows, rows.count(), 60, 60)
    coefficients = train.select("review_id", F.col("label").alias("alpha"))
    plan = term_regression._margins(dealt, coefficients)._jdf.queryExecution().executedPlan().toString().splitlines()
    at = next(i for i, line in enumerate(plan) if dealt.table in line)
    met = max(i for i in range(at) if "CoGroup" in plan[i])
    assert not [line for line in plan[met:at] if "Exchange" in line]
