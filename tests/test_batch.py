import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from venuerank import schemas, session
from venuerank.operators import scores, sentiment
from venuerank.plans.batch import BatchOptions, run_batch
from venuerank.sinks import guards, writers
from venuerank.sources import raw

import sample_records as synth


@pytest.fixture(scope="module")
def sample(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("raw"))
    synth.write_sample(spark, path, 60, 1500, 40)
    return path


@pytest.fixture(scope="module")
def run(spark, sample, tmp_path_factory):
    output = str(tmp_path_factory.mktemp("gold"))
    options = BatchOptions(raw=sample, output=output, as_of="2025-01-01", rank=4, max_iter=3)
    return options, run_batch(spark, options)


def table(spark, run, name):
    return raw.read_table(spark, run[0].output, name)


def test_sample_is_seeded_and_consistent(spark, sample):
    businesses = raw.read_json(spark, sample, "business.json", "business")
    reviews = raw.read_json(spark, sample, "review.json", "review")
    users = raw.read_json(spark, sample, "user.json", "user")
    assert (businesses.count(), reviews.count(), users.count()) == (60, 1500, 40)
    assert businesses.select("business_id").distinct().count() == 60
    assert reviews.join(businesses, "business_id", "left_anti").isEmpty()
    assert reviews.join(users, "user_id", "left_anti").isEmpty()
    assert {r["city"]: r["count"] for r in businesses.groupBy("city").count().collect()} == {c[0]: 20 for c in synth.CITIES}
    joined = reviews.join(businesses.select("business_id", "categories"), "business_id").filter("stars = 5")
    cuisine = F.split("categories", ",")[0]
    assert joined.filter(~F.col("text").contains(cuisine)).isEmpty()
    shares = {r["stars"]: r["count"] / 1500 for r in reviews.groupBy("stars").count().collect()}
    assert shares[5.0] == pytest.approx(0.35, abs=0.05) and shares[1.0] == pytest.approx(0.1, abs=0.04)
    again = synth.generate_reviews(spark, 1500, 60, 40).select("review_id", "date", "text")
    assert again.exceptAll(reviews.select("review_id", "date", "text")).isEmpty()
    for centre in synth.CITIES:
        far = businesses.filter((F.col("city") == centre[0]) & (F.abs(F.col("latitude") - centre[2]) > 0.2))
        assert far.isEmpty()


def test_json_with_blank_and_broken_lines(spark, tmp_path):
    lines = [json.dumps({"review_id": "r1", "stars": 5}), "", "{broken", json.dumps({"review_id": "r2", "stars": 4.5})]
    (tmp_path / "review.json").write_text("\n".join(lines))
    reviews = raw.read_json(spark, str(tmp_path) + "/", "review.json", "review")
    assert {(r["review_id"], r["stars"]) for r in reviews.collect()} == {("r1", 5.0), (None, None), ("r2", 4.5)}
    broken = raw.malformed_lines(spark, str(tmp_path), "review.json", "review").collect()
    assert [r["malformed"] for r in broken] == ["{broken"]
    assert "malformed" not in schemas.REVIEW_RAW.fieldNames()


def test_batch_writes_every_table(spark, run):
    rows = run[1]
    assert set(rows) == {"reviews_enriched", "business_scores", "grid_aggregates", "als_recommendations", "als_rmse",
                         "grid_sentiment", "business_profiles", "rejected_lines", "sentiment_metrics", "sentiment_confusion"}
    for name, count in rows.items():
        assert table(spark, run, name).count() == count
        assert count > 0 or name == "rejected_lines"
    assert table(spark, run, "sentiment_metrics").first()["weighted_f1"] > 0.8
    assert sorted(table(spark, run, "business_scores").columns) == sorted(schemas.SCORE_COLUMNS)
    assert sorted(table(spark, run, "business_profiles").columns) == sorted(schemas.PROFILE_COLUMNS)
    assert {r[0] for r in table(spark, run, "business_scores").select("metro_area").distinct().collect()} == {
        c[0] for c in synth.CITIES}


def test_gold_tables_agree(spark, run):
    enriched = table(spark, run, "reviews_enriched")
    business_scores = table(spark, run, "business_scores")
    assert business_scores.agg(F.sum("review_count")).first()[0] == enriched.count()
    grid = table(spark, run, "grid_aggregates")
    assert grid.agg(F.sum("restaurant_count")).first()[0] == business_scores.count()
    fresh = sentiment.compute_grid_sentiment(enriched)
    assert fresh.select(*schemas.SENTIMENT_COLUMNS).exceptAll(table(spark, run, "grid_sentiment")).isEmpty()
    recs = table(spark, run, "als_recommendations")
    assert recs.groupBy("user_id").count().agg(F.max("count")).first()[0] <= 10
    assert scores.top_cuisine(business_scores).count() == grid.count()


def test_every_serving_table_passes_its_guard(spark, run):
    for name in schemas.PRIMARY_KEYS:
        ready = writers.ready_for_serving(table(spark, run, name), name)
        assert ready.count() == run[1][name]


def test_rerun_replaces(spark, run):
    again = run_batch(spark, run[0]._replace(stages=("aggregate", "sentiment")))
    tables = ("business_scores", "grid_aggregates", "grid_sentiment", "sentiment_metrics", "sentiment_confusion")
    assert again == {k: run[1][k] for k in tables}
    assert table(spark, run, "grid_sentiment").count() == run[1]["grid_sentiment"]


def test_unknown_stage(spark, run):
    with pytest.raises(ValueError):
        run_batch(spark, run[0]._replace(stages=("clean", "publish")))


def test_copy_of_a_laid_out_table_moves_no_row(spark, tmp_path):
    """Rows stay in the task that read them: each of four tasks writes a file of each metro it holds, the rebalanced copy has one a metro."""
    rows = spark.range(1000).selectExpr("if(id % 2 = 0, 'a', 'b') metro_area", "id")
    rows.repartition(4).write.partitionBy("metro_area").parquet(str(tmp_path / "table"))
    stored = raw.read_table(spark, str(tmp_path), "table")
    assert stored.rdd.getNumPartitions() == 4
    for name, laid_out in (("kept", True), ("moved", False)):
        writers.write_parquet(stored, str(tmp_path / name), "metro_area", laid_out=laid_out)
        copy = raw.read_table(spark, str(tmp_path), name)
        assert sorted(tuple(r) for r in copy.collect()) == sorted(tuple(r) for r in stored.collect())
    assert len(list((tmp_path / "kept").glob("*/*.parquet"))) >= 4
    assert len(list((tmp_path / "moved").glob("*/*.parquet"))) == 2


def test_partitioned_write_splits_a_dominant_value(spark, tmp_path):
    """A value with nearly all rows is spread over files; metro names stay text."""
    rows = spark.range(0, 200_000, 1, 8).selectExpr(
        "if(id % 1000 = 0, '42', 'big') metro_area", "id", "sha2(cast(id as string), 256) filler")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1MB")
    try:
        writers.write_parquet(rows, str(tmp_path / "t"), "metro_area")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "t" / "metro_area=big").glob("*.parquet"))) > 3
    stored = raw.read_table(spark, str(tmp_path), "t")
    assert dict(stored.dtypes)["metro_area"] == "string"
    assert {r["metro_area"]: r["count"] for r in stored.groupBy("metro_area").count().collect()} == {"42": 200, "big": 199_800}


def test_metro_filter_prunes_partitions(spark, run):
    plan = table(spark, run, "business_scores").filter(F.col("metro_area") == synth.CITIES[0][0])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(metro_area" in text


def test_settings_are_checked_before_any_work(spark, run, monkeypatch):
    for name in writers.JDBC_SETTINGS:
        monkeypatch.delenv(name, raising=False)
    with pytest.raises(OSError, match="VENUE_DB_URL, VENUE_DB_USER, VENUE_DB_PASSWORD"):
        run_batch(spark, run[0]._replace(to_database=True, raw="/nowhere"))


def test_jdbc_options():
    settings = writers.jdbc_settings({"VENUE_DB_URL": "jdbc:x://h/d", "VENUE_DB_USER": "u", "VENUE_DB_PASSWORD": "p"})
    options = writers.jdbc_options("als_recommendations", settings, connections=3, batch=50)
    assert options["dbtable"] == "als_recommendations" and options["numPartitions"] == "3" and options["batchsize"] == "50"
    columns = T._parse_datatype_string("user_id string, business_id string, predicted_rating double, rank int")
    typed = writers.jdbc_options("als_recommendations", settings, columns=columns)["createTableColumnTypes"]
    assert typed == "user_id VARCHAR(50), business_id VARCHAR(50), predicted_rating DOUBLE PRECISION, rank INT"
    assert options["driver"] == "org.postgresql.Driver"
    assert "createTableColumnTypes" not in options


def test_tables_are_made_with_keys_and_swapped_in_one_go(spark, run):
    made = [s for name in schemas.PRIMARY_KEYS for s in schemas.create_statements(name, table(spark, run, name).schema)]
    assert sum("PRIMARY KEY" in s for s in made) == 5 and sum("CREATE INDEX" in s for s in made) == 6
    columns = T._parse_datatype_string("user_id string, business_id string, predicted_rating double, rank int")
    swap = writers.swap_statements("als_recommendations", "als_recommendations_staging", columns)
    assert "PRIMARY KEY (user_id, business_id)" in swap[0]
    assert [s.split()[0] for s in swap] == ["CREATE", "CREATE", "CREATE", "DELETE", "INSERT", "DROP"]
    import duckdb

    database = duckdb.connect()
    database.execute("CREATE TABLE als_recommendations_staging AS SELECT 'u' AS user_id, 'b' AS business_id, 4.5 AS predicted_rating, 1 AS rank")
    for _ in range(2):
        for statement in swap[:-1]:
            database.execute(statement)
    assert database.execute("SELECT * FROM als_recommendations").fetchall() == [("u", "b", 4.5, 1)]


def test_rejected_lines_are_kept_and_counted(spark, tmp_path):
    synth.write_sample(spark, str(tmp_path / "raw"), 30, 300, 20)
    (tmp_path / "raw" / "review.json" / "broken.json").write_text("{broken\n\n[1, 2\n")
    options = BatchOptions(raw=str(tmp_path / "raw"), output=str(tmp_path / "gold"), as_of="2025-01-01", stages=("clean",))
    rows = run_batch(spark, options)
    assert rows["rejected_lines"] == 2
    kept = raw.read_table(spark, options.output, "rejected_lines").collect()
    assert {(r["entity"], r["line"]) for r in kept} == {("review", "{broken"), ("review", "[1, 2")}


def test_writes_are_observed_in_a_session_of_their_own(spark, run, tmp_path):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    from venuerank.sinks.observed import watched, write_observed

    side = session.sibling(spark)
    assert side.conf.get("spark.sql.shuffle.partitions") == "4" and session.shared_dir(side) == session.shared_dir(spark)
    rows = side.range(1000).select("id", F.when(F.col("id") % 10 > 0, F.col("id") % 3).alias("a.b"), F.lit("x").alias("kind"))
    whole, seen = watched(rows, rows=F.count(F.lit(1)))
    found = write_observed(whole.filter("id >= 500"), str(tmp_path / "t"), "kind", top=F.max("id"))
    assert found == {"rows": 500, "nulls": {"id": 0, "a.b": 50, "kind": 0}, "top": 999} and seen.get == {"rows": 1000}
    assert write_observed(rows.limit(0), str(tmp_path / "none"))["rows"] == 0
    # as many as the files hold
    assert all(n == table(spark, run, name).count() for name, n in run[1].items())
    # a model fitted afterwards in the first session can still be applied
    data = VectorAssembler(inputCols=["x"], outputCol="features").transform(spark.range(50).selectExpr("double(id) AS x", "double(id > 20) AS label"))
    assert LogisticRegression(maxIter=2).fit(data).transform(data).filter("prediction = label").count() > 25


def test_guards(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "k string, v int")
    assert [tuple(r) for r in guards.duplicate_keys(df, ["k"]).collect()] == [("a", 2)]
    with pytest.raises(ValueError, match="'a'"):
        guards.require_unique(df, ["k"])
    assert guards.require_unique(df, ["k", "v"]) is df


def test_serving_types(spark):
    recs = spark.createDataFrame([("u", "b", 4.5, 1), ("u", None, 4.0, 2), ("u", "c", float("nan"), 3)],
                                 "user_id string, business_id string, predicted_rating float, rank long")
    ready = writers.ready_for_serving(recs, "als_recommendations")
    assert dict(ready.dtypes)["predicted_rating"] == "double" and dict(ready.dtypes)["rank"] == "int"
    assert ready.count() == 1


def test_copy_skips_empty_tables(spark):
    tables = {"full": spark.range(3), "empty": spark.range(0)}
    written = {}
    copied = writers.copy_tables(list(tables), tables.__getitem__, lambda df, name: written.update({name: df.count()}))
    assert copied == ["full"] and written == {"full": 3}


def test_scratch_folder(spark):
    assert session.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    stored = session.materialise(spark.range(7), "seven")
    assert stored.count() == 7 and session.shared_dir(spark) in stored.inputFiles()[0]


def test_metro_fallback(spark):
    assert raw.with_metro_fallback(spark.createDataFrame([("C",)], "city string")).first()["metro_area"] == "C"
