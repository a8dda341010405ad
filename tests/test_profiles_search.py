import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from venuerank.operators import profiles, search

ENRICHED = ("review_id string, business_id string, stars int, date string, text string, name string, metro_area string, "
            "city string, latitude double, longitude double, categories string, recency_weight double")
PROFILE = ("business_id string, name string, metro_area string, city string, latitude double, longitude double, "
           "avg_rating double, review_count long, popularity_score double, profile_text string")


def review(number, venue, date="2023-01-01 00:00:00", text="fine", stars=4, categories="Bars", metro="M"):
    return (f"r{number:04}", venue, stars, date, text, venue.upper(), metro, "C", 1.0, 2.0, categories, 0.5)


def test_profile_text(spark):
    rows = [review(1, "a", "2023-01-01 00:00:00", "old"), review(2, "a", "2023-06-01 00:00:00", "new"),
            review(3, "a", "2023-06-01 00:00:00", "same day"), review(4, "b", text=None, categories=None)]
    found = {r["business_id"]: r for r in profiles.build_profiles(spark.createDataFrame(rows, ENRICHED)).collect()}
    assert found["a"]["profile_text"] == "Bars Bars Bars new same day old"
    assert found["a"]["review_count"] == 3
    assert found["a"]["popularity_score"] == pytest.approx(0.4 * 4 + 0.4 * math.log(4) + 0.1)
    assert found["b"]["profile_text"] == ""


def test_profile_takes_the_latest_twenty_and_the_first_120_characters(spark):
    rows = [review(i, "a", f"2023-01-01 00:{i // 60:02}:{i % 60:02}", f"<{i}>" + "x" * 300) for i in range(400)]
    text = profiles.build_profiles(spark.createDataFrame(rows, ENRICHED).repartition(6)).first()["profile_text"]
    assert re.findall(r"<(\d+)>", text) == [str(i) for i in range(399, 379, -1)]
    assert all(len(part) == 120 for part in text.split(" ")[3:])


def test_a_venue_with_two_spellings_is_one_profile(spark):
    rows = [review(1, "a"), (*review(2, "a")[:5], "Another", *review(2, "a")[6:])]
    found = profiles.build_profiles(spark.createDataFrame(rows, ENRICHED)).collect()
    assert [(r["name"], r["review_count"]) for r in found] == [("A", 2)]


def test_city_stands_in_for_a_missing_metro(spark):
    rows = spark.createDataFrame([review(1, "a")], ENRICHED).drop("metro_area")
    assert profiles.build_profiles(rows).first()["metro_area"] == "C"


def profile(venue, text, reviews=10, rating=4.0, metro="M"):
    return (venue, f"Venue {venue}", metro, "C", 1.0, 2.0, rating, reviews, 3.0, text)


def test_fallback_profiles_cover_other_metros(spark):
    rich = spark.createDataFrame([profile("a", "rich text")], PROFILE)
    scored = spark.createDataFrame([("a", "A", "M", "C", 1.0, 2.0, "x", "Bars", 4.0, 1, 0.5, 3.0),
                                    ("b", "B", "N", "C", 1.0, 2.0, "x", " Thai", 4.0, 1, 0.5, 3.0),
                                    ("c", "C", "N", "C", 1.0, 2.0, "x", None, 4.0, 1, 0.5, 3.0)],
                                   "business_id string, name string, metro_area string, city string, latitude double, "
                                   "longitude double, grid_cell string, categories string, avg_rating double, "
                                   "review_count long, recency_score double, popularity_score double")
    found = {r["business_id"]: r["profile_text"] for r in profiles.profiles_with_fallback(rich, scored).collect()}
    assert found == {"a": "rich text", "b": "Thai Thai Thai", "c": ""}


def test_sanitise(spark):
    row = profiles.sanitise(spark.createDataFrame([profile("a", "tab\there\\ \nend"), profile(None, "x")], PROFILE)).collect()
    assert [r["profile_text"] for r in row] == ["tab here  end"]


# --- search, against a plain implementation -----------------------------------------------

def terms(text):
    words = re.findall(r"\w\w+", text.lower())
    return words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def plain_vectors(docs, size):
    counts = {k: Counter(terms(t)) for k, t in docs.items()}
    corpus, df = Counter(), Counter()
    for c in counts.values():
        corpus.update(c)
        df.update(c.keys())
    kept = [t for t, _ in sorted(corpus.items(), key=lambda p: (-p[1], p[0]))[:size]]
    idf = {t: math.log((1 + len(docs)) / (1 + df[t])) + 1 for t in kept}

    def vector(c):
        raw = {t: (1 + math.log(n)) * idf[t] for t, n in c.items() if t in idf}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        return {t: v / norm for t, v in raw.items()}

    return {k: vector(c) for k, c in counts.items()}, vector


def plain_search(rows, query, size, top_n):
    vectors, vector = plain_vectors({r[0]: r[9] for r in rows}, size)
    asked = vector(Counter(terms(query)))
    loudest = max(math.log1p(r[7] or 0) for r in rows) or 1.0
    scored = []
    for r in rows:
        match = sum(w * asked.get(t, 0) for t, w in vectors[r[0]].items())
        scored.append((r[0], match, 0.6 * match + 0.25 * math.log1p(r[7] or 0) / loudest + 0.15 * (r[6] or 0) / 5))
    best = sorted(scored, key=lambda s: (-round(s[2], 9), s[0]))[:top_n]
    return [(k, pytest.approx(m), pytest.approx(f)) for k, m, f in best if m > 0.05]


DOCS = [
    profile("a", "Ramen Ramen Ramen spicy broth and ramen noodles", 5, 3.0), profile("b", "Italian pasta and wine, cozy", 80, 4.5),
    profile("c", "spicy wings and beer", 900, 4.9), profile("d", "quiet coffee", 2, 2.0),
    profile("e", "Spicy ramen!", None, None), profile("f", "Ramen bar with beer and spicy snacks", 300, 4.0),
    profile("g", "", 1000, 5.0), profile("h", "x", 999, 4.8),
]


def index_of(table, size=None, block=search.BLOCK):
    """Index in which a profile's text plays the one review of its venue."""
    venues = table.select("business_id", "metro_area", F.lit("").alias("categories"))
    return search.build_index(venues, table.select("business_id", F.col("profile_text").alias("text")), size, block)


def engine(spark, rows, query, size=None, top_n=10, block=search.BLOCK):
    table = spark.createDataFrame(rows, PROFILE)
    asked = spark.createDataFrame([("q", "M", query)], "query_id string, metro_area string, query string")
    found = search.search(asked, table, index_of(table, size, block), top_n).orderBy("position").collect()
    return [(r["business_id"], r["match_score"], r["final_score"]) for r in found]


@pytest.mark.parametrize("size, top_n", [(None, 10), (None, 2), (6, 10)])
def test_search_equals_the_plain_one(spark, size, top_n):
    asked = ["spicy ramen", "ramen broth", "cozy pasta wine", "beer", "unknown words", "   "]
    table = spark.createDataFrame(DOCS, PROFILE)
    queries = spark.createDataFrame([(q, "M", q) for q in asked], "query_id string, metro_area string, query string")
    found = {q: [] for q in asked}
    for r in search.search(queries, table, index_of(table, size), top_n).orderBy("position").collect():
        found[r["query_id"]].append((r["business_id"], r["match_score"], r["final_score"]))
    assert found == {q: plain_search(DOCS, q, size, top_n) if q.strip() else [] for q in asked}


def test_venues_without_a_match_take_places(spark):
    """Well-known venues fill the first places and are cut afterwards, as they do not match."""
    rows = [profile("match", "dim sum palace with many other words", 1, 1.0)] + [
        profile(f"big{i}", "steak", 5000, 5.0) for i in range(3)]
    assert engine(spark, rows, "palace", top_n=1) == plain_search(rows, "palace", None, 1) == []
    assert [r[0] for r in engine(spark, rows, "palace", top_n=4)] == ["match"]


def test_no_profiles(spark):
    assert engine(spark, [], "ramen") == []


def test_exact_text_ranks_first_and_metros_are_apart(spark):
    rows = [profile("a", "Cuban sandwich counter"), profile("b", "Cuban coffee"),
            profile("z", "Cuban sandwich counter", metro="N")]
    assert engine(spark, rows, "Cuban sandwich counter")[0][0] == "a"
    assert {r[0] for r in engine(spark, rows, "cuban")} == {"a", "b"}


def test_stored_index_answers_alike(spark, tmp_path):
    table = spark.createDataFrame(DOCS, PROFILE)
    search.store_index(index_of(table), str(tmp_path))
    asked = spark.createDataFrame([("q", "M", "spicy ramen")], "query_id string, metro_area string, query string")
    stored = search.search(asked, table, search.load_index(spark, str(tmp_path)))
    fresh = search.search(asked, table, index_of(table))
    assert stored.select("position", "business_id").collect() == fresh.select("position", "business_id").collect()


def test_whole_reviews_are_counted_one_by_one(spark):
    venues = spark.createDataFrame([("a", "M", "Noodle Bars, Soup"), ("b", "M", None), ("c", None, "Soup")], "business_id string, metro_area string, categories string")
    long = " ".join(f"w{i}" for i in range(5000)) + " ending"
    reviews = spark.createDataFrame([("a", "soup soup"), ("a", "soup bowl"), ("b", long), ("b", None), ("c", "soup")], "business_id string, text string")
    index = search.build_index(venues, reviews)
    counts = {(r["business_id"], r["term"]): r["tf"] for r in search.venue_terms(index).collect()}
    assert counts["a", "soup"] == 3 + 3 and counts["a", "soup soup"] == 1 and counts["a", "noodle bars"] == 3
    assert ("a", "soup soup bowl") not in counts and counts["b", "w4999 ending"] == 1 and counts["b", "ending"] == 1
    assert not [k for k in counts if k[0] == "c"]
    squares = search.term_weights(index).groupBy("business_id").agg(F.sum(F.col("weight") ** 2).alias("s")).collect()
    assert {r["business_id"]: round(r["s"], 9) for r in squares} == {"a": 1.0, "b": 1.0}
    assert search.vocabulary(index).count() == len({t for _, t in counts})
    assert [r["term"] for r in index.dictionary.orderBy("term_id").collect()] == sorted({t for _, t in counts})


def many_profiles(n, metro="M"):
    """Profiles in which few words are very frequent, of many lengths, so that long lists have a wide range of weights."""
    draw = random.Random(11)
    words = [f"word{i}" for i in range(60)]
    share = [1 / (i + 1) for i in range(60)]
    return [
        profile(f"{metro}{i:04}", " ".join(draw.choices(words, share, k=draw.choice([3, 8, 40, 160]))), draw.choice([None, 0, 3, 80, 2000]), draw.choice([None, 1.0, 3.5, 5.0]), metro)
        for i in range(n)
    ]


@pytest.fixture(scope="module")
def many(spark):
    rows = many_profiles(400) + many_profiles(30, "N")
    table = spark.createDataFrame(rows, PROFILE)
    return rows, table, index_of(table, block=16)


def test_blocks_are_skipped_for_a_frequent_term(spark, many):
    rows, table, index = many
    asked = spark.createDataFrame([("q", "M", "word0")], "query_id string, metro_area string, query string")
    weights = search.materialise(search._query_weights(asked, index), "weights")
    idle = spark.createDataFrame([], "query_id string, metro_area string, business_id string, match_score double")
    plan = search.first_look(weights, index, search._standing(table), idle, 5).plan.toPandas()
    lists = index.ranked.groupBy("metro", "term_id").count().toPandas()
    assert lists["count"].max() > 300  # a term that most venues have
    assert len(plan) >= 15 and (~plan["kept"]).sum() >= len(plan) / 2
    kept = plan[plan["kept"]]["bound"]
    assert plan[~plan["kept"]]["bound"].max() < plan["least"].iloc[0] and (kept >= plan["least"].iloc[0] - 1e-8).all()


@pytest.mark.parametrize("top_n", [1, 5, 50, 500])
def test_bounded_search_equals_scoring_everything(spark, many, top_n):
    rows, table, index = many
    asked = ["word0", "word0 word1", "word3 word40 word0 word0", "word59", "nothing", "word1 word2 word3 word4 word5"]
    queries = spark.createDataFrame([(f"{m}{i}", m, q) for m in "MN" for i, q in enumerate(asked)], "query_id string, metro_area string, query string")
    found = {}
    for r in search.search(queries, table, index, top_n).orderBy("query_id", "position").collect():
        found.setdefault(r["query_id"], []).append((r["business_id"], r["match_score"], r["final_score"]))
    for m in "MN":
        here = [r for r in rows if r[2] == m]
        for i, q in enumerate(asked):
            assert found.get(f"{m}{i}", []) == plain_search(here, q, None, top_n), (m, q)


def test_equal_texts_are_one_vector(spark):
    venues = spark.createDataFrame([("a", "M", "Thai"), ("b", "M", "Thai")], "business_id string, metro_area string, categories string")
    reviews = spark.createDataFrame([("a", "good soup")] * 50 + [("b", "good soup"), ("b", "Thai")], "business_id string, text string")
    index = search.build_index(venues, reviews)
    counts = {(r["business_id"], r["term"]): r["tf"] for r in search.venue_terms(index).collect()}
    assert counts == {("a", "good"): 50, ("a", "soup"): 50, ("a", "good soup"): 50, ("a", "thai"): 3, ("b", "good"): 1, ("b", "soup"): 1, ("b", "good soup"): 1, ("b", "thai"): 4}


def test_snippets_are_shuffled_once_and_cut_before(spark, monkeypatch):
    """Also of a venue with most reviews; beyond what Spark prunes, slices give the same."""
    rows = spark.range(3_000).select(
        F.when(F.col("id") % 10 < 8, "hot").otherwise(F.concat(F.lit("v"), F.col("id") % 37)).alias("business_id"),
        F.concat(F.lit("r"), "id").alias("review_id"), F.concat(F.lit("d"), F.pmod(F.xxhash64("id"), F.lit(50))).alias("date"),
        F.when(F.col("id") % 11 != 0, F.concat(F.lit("s"), "id")).alias("snippet"),
    )
    latest = profiles.latest_snippets(rows, 4)
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Partial" in plan[plan.index("Exchange hashpartitioning"):]
    found = {r["business_id"]: r["snippets"] for r in latest.collect()}
    expected = {}
    for r in sorted(rows.collect(), key=lambda r: r["review_id"]):
        expected.setdefault(r["business_id"], []).append(r)
    expected = {v: [r["snippet"] for r in sorted(rs, key=lambda r: r["date"], reverse=True) if r["snippet"]][:4] for v, rs in expected.items()}
    assert found == {v: s for v, s in expected.items() if s}
    monkeypatch.setattr(profiles, "PRUNED", 3)
    assert {r["business_id"]: r["snippets"] for r in profiles.latest_snippets(rows, 4).collect()} == found
