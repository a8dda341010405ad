"""Text profiles of venues."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from venuerank import schemas
from venuerank.functions.rows import complete_rows
from venuerank.functions.scoring import popularity
from venuerank.functions.text import SNIPPET_CHARS, SNIPPETS_PER_PROFILE, profile_text, single_line, snippet
from venuerank.operators.ranking import top_per_group
from venuerank.session import materialise
from venuerank.sources.raw import with_metro_fallback

PRUNED = 1_000  # spark.sql.optimizer.windowGroupLimitThreshold
_ATTRIBUTES = ["name", "metro_area", "city", "latitude", "longitude", "categories"]


def latest_snippets(cut: DataFrame, per_venue: int = SNIPPETS_PER_PROFILE) -> DataFrame:
    """`business_id, snippets`: each venue's latest of `cut(business_id, review_id, date, snippet)`, newest first.

    The cut comes before the list is built, so no list grows with the reviews of a venue. Up to PRUNED Spark cuts each
    venue within the tasks before its shuffle, so snippets are shuffled once; beyond, slices of a venue are cut first.
    """
    order = [F.col("date").desc(), F.col("review_id").asc()]
    cut = cut.filter(F.col("snippet").isNotNull())
    if per_venue <= PRUNED:
        place = F.row_number().over(Window.partitionBy("business_id").orderBy(*order))
        latest = cut.withColumn("place", place).filter(F.col("place") <= per_venue)
    else:
        latest = top_per_group(cut, ["business_id"], order, per_venue, ["review_id"], "place")
    listed = F.sort_array(F.collect_list(F.struct("place", "snippet")))
    return latest.groupBy("business_id").agg(listed.getField("snippet").alias("snippets"))


def build_profiles(
    enriched: DataFrame, chars: int = SNIPPET_CHARS, per_venue: int = SNIPPETS_PER_PROFILE, stored: bool = False
) -> DataFrame:
    """One row per venue with its scores and a short text to show: the first `chars` characters of
    its `per_venue` latest reviews. Searches read whole reviews, not this text.

    `enriched` is read twice: unless it is a `stored` table, what is needed of it is stored first, so that the enrichment
    runs once.
    """
    texts = snippet(F.col("text"), chars).alias("snippet")
    kept = with_metro_fallback(enriched).select("review_id", "date", "stars", "recency_weight", "business_id", *_ATTRIBUTES, texts)
    rows = kept if stored else materialise(kept, "profile-rows")
    # numbers only in the first step, which hash-aggregates all reviews; should a venue have
    # two spellings of an attribute, the second step, over venues, keeps the smaller
    spelled = rows.groupBy("business_id", *_ATTRIBUTES).agg(
        F.sum("stars").alias("star_sum"),
        F.count("stars").alias("rated"),
        F.count(F.lit(1)).alias("reviews"),
        F.sum("recency_weight").alias("recency_sum"),
    )
    venues = spelled.groupBy("business_id").agg(
        *[F.min(c).alias(c) for c in _ATTRIBUTES],
        F.try_divide(F.sum("star_sum").cast("double"), F.sum("rated").cast("double")).alias("avg_rating"),
        F.sum("reviews").alias("review_count"),
        F.sum("recency_sum").alias("recency_sum"),
    )
    recency = F.col("recency_sum") / F.col("review_count")
    return (
        venues.join(latest_snippets(rows.select("business_id", "review_id", "date", "snippet"), per_venue), "business_id", "left")
        .withColumn("popularity_score", popularity(F.col("avg_rating"), F.col("review_count"), recency))
        .withColumn("profile_text", profile_text(F.col("categories"), F.coalesce("snippets", F.array())))
        .select(*schemas.PROFILE_COLUMNS)
    )


def category_profiles(business_scores: DataFrame) -> DataFrame:
    """Profiles from categories alone."""
    return business_scores.withColumn("profile_text", profile_text(F.col("categories"))).select(
        *schemas.PROFILE_COLUMNS
    )


def profiles_with_fallback(profiles: DataFrame, business_scores: DataFrame) -> DataFrame:
    """Rich profiles, and category profiles for every metro that has none.

    `profiles` are those of the metros that have been profiled so far.
    """
    covered = profiles.select("metro_area").distinct()
    return profiles.unionByName(category_profiles(business_scores).join(covered, "metro_area", "left_anti"))


def sanitise(profiles: DataFrame) -> DataFrame:
    """Profiles ready for a line-based bulk load."""
    cleaned = {c: single_line(F.col(c)) for c in ("name", "metro_area", "city", "profile_text")}
    return (
        complete_rows(profiles, ["business_id"])
        .withColumns(cleaned)
        .withColumn("review_count", F.col("review_count").cast("int"))
    )
