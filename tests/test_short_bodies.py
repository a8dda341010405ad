"""Queries that need no whole review text carry none through their joins."""

import glob
import os
import re

import pytest
from pyspark.sql import functions as F

from venuerank.plans.gold import Gold
from venuerank.plans.queries import QUERIES
from venuerank.session import shared_dir
from venuerank.sources import star_schema

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def carries_texts(df):
    return re.search(r"text#\d+ AS body", df._jdf.queryExecution().optimizedPlan().toString()) is not None


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_facts_are_the_clean_reviews_without_texts(spark):
    g = Gold(spark, FOLDER)
    assert carries_texts(g.clean_review_rows) and not carries_texts(g.clean_fact_rows)
    assert rows(g.clean_fact_rows) == rows(g.clean_review_rows.drop("text"))
    assert rows(g.enriched_snippet_rows.select("review_id", "text")) == rows(g.enriched_rows.select("review_id", F.substring("text", 1, 120)))


def test_short_bodies_equal_those_of_whole_texts(spark):
    whole = star_schema.reviews(spark, FOLDER)
    assert rows(star_schema.reviews(spark, FOLDER, F.md5("text")).fillna("none")) == rows(whole.withColumn("text", F.md5("text")).fillna("none"))


@pytest.mark.parametrize("name", ["business_scores", "business_scores_grouped", "grid_sentiment", "grid_sentiment_pivot"])
def test_scores_read_no_texts(spark, name):
    assert not carries_texts(QUERIES[name](Gold(spark, FOLDER)))


def test_batch_tables_write_packed_lines_and_no_row_twice(spark):
    scratch = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}"
    before = set(glob.glob(f"{scratch}/*"))
    QUERIES["batch_tables"](Gold(spark, FOLDER))
    made = set(glob.glob(f"{scratch}/*")) - before
    lines = [f for folder in made for f in glob.glob(f"{folder}/*.json/part-*")]
    assert lines and all(f.endswith(".gz") for f in lines)
    assert not [folder for folder in made if os.path.basename(folder).startswith("profile-rows")]  # the enriched table is stored already
