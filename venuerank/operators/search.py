"""Text search over venues, per metro, on an index of integer terms with impact-ordered posting lists.

Building. Every distinct review text is tokenised once. Its terms get integer ids in alphabetical order, and a
text becomes a vector of (term, times). A venue's counts are then the sum of the vectors of its texts,
each times its number of reviews: a sparse product of (venue, text, times) and (text, term, times). A task multiplies
the entries of some venues of one metro with a share of the terms of their texts, so a text travels once for many
venues, products are never rows, and lists come out whole, with their counts.

Searching. Posting lists of more than `block` venues are read in order of weight, in blocks
with the greatest weight of each; a stored index keeps them so, a fresh one orders the lists that are asked for. A first look at short lists and at each list's first block gives a
score that the last place of the answer has at least; a block whose best venue can't reach it, even with the
greatest weights of all other terms and the metro's best standing, is not read. Winners have
no posting in such a block, so the answer is that of scoring everything.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from venuerank.functions.scoring import score_order
from venuerank.functions.text import strip, unigrams_and_bigrams
from venuerank.operators.ranking import ordered_position, top_per_group
from venuerank.session import materialise
from venuerank.sources.raw import join_path

CATEGORY_TIMES = 3
RESULTS = 10
MIN_MATCH = 0.05
TEXT_SHARE, VOLUME_SHARE, RATING_SHARE = 0.6, 0.25, 0.15
BLOCK = 128  # postings of a block
BUCKETS = 16  # of terms; a text's vector travels in so many parts
CHUNK_ENTRIES = 500_000  # (venue, text) pairs that meet a metro's texts together
CELL_PRODUCTS = 4_000_000  # multiplied in one go
PACK = 4_096  # pairs to a row
BATCH = 262_144
PUSHED_TERMS = 1_000  # so many terms are looked up by a filter in the scan, more by a join
SLACK = 1e-9  # scores are compared to nine digits


class TextIndex(NamedTuple):
    dictionary: DataFrame  # term, term_id: ids in alphabetical order
    venues: DataFrame      # venue, business_id, metro, metro_area, documents of the metro, length of the vector of weights
    postings: DataFrame    # metro, term_id, venue, tf, doc_count, corpus_count, is_first of its list
    ranked: DataFrame      # metro, term_id, block, venue, weight: long lists, heaviest first
    blocks: DataFrame      # metro, term_id, block, top: the block's greatest weight


STORED = {
    "dictionary": "term string, term_id long",
    "venues": "venue int, business_id string, metro int, metro_area string, documents long, length double",
    "postings": "metro int, term_id long, venue int, tf long, doc_count long, corpus_count long, is_first boolean",
    "ranked": "metro int, term_id long, block int, venue int, weight double",
    "blocks": "metro int, term_id long, block int, top double",
}


def term_counts(texts: DataFrame, keys: list[str], text: str) -> DataFrame:
    """How often each one- or two-word term occurs in each text."""
    terms = texts.select(*keys, F.explode(unigrams_and_bigrams(F.col(text))).alias("term"))
    return terms.groupBy(*keys, "term").agg(F.count(F.lit(1)).alias("tf"))


def _numbered_venues(venues: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(venue, business_id, metro, metro_area, documents, categories of the venues that lie in a metro; the metros)."""
    located = venues.filter(F.col("metro_area").isNotNull()).select("business_id", "metro_area", "categories")
    metros = ordered_position(located.groupBy("metro_area").agg(F.count(F.lit(1)).alias("documents")), [F.col("metro_area").asc()], "metro")
    metros = materialise(metros.withColumn("metro", F.col("metro").cast("int")), "metros")
    placed = ordered_position(located, [F.col("business_id").asc()], "venue")
    return materialise(placed.withColumn("venue", F.col("venue").cast("int")).join(metros, "metro_area"), "venues"), metros


def _text_vectors(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(dictionary, text_key, bucket, vector of (term_id, tf)) of `texts(text_key, text)`, a row each bucket of terms of a distinct text."""
    counted = materialise(term_counts(texts, ["text_key"], "text"), "text-terms")
    placed = ordered_position(counted.select("term").distinct(), [F.col("term").asc()], "term_id")
    dictionary = materialise(placed.select("term", "term_id").sortWithinPartitions("term"), "dictionary")
    entry = F.struct(F.col("term_id").cast("int").alias("term_id"), F.col("tf").cast("int").alias("tf"))
    bucket = F.pmod("term_id", F.lit(BUCKETS)).cast("int").alias("bucket")
    # a vector is as long as its text
    vectors = counted.join(dictionary, "term").groupBy("text_key", bucket).agg(F.collect_list(entry).alias("vector"))
    return dictionary, materialise(vectors.select("text_key", "bucket", "vector.term_id", "vector.tf"), "text-vectors")


def _runs(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places of runs that begin at `starts`, one run after the other."""
    return np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())


def _lists_of_cell(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The postings of a cell, list by list, from its rows of vectors (`text` is given) and of packed entries."""
    vectors, entries = [], []
    for batch in batches:
        is_vector = batch.column("text").is_valid()
        vectors.append(batch.filter(is_vector))
        entries.append(batch.filter(pc.invert(is_vector)))
    flat = lambda parts, c: np.concatenate([p.column(c).flatten().to_numpy() for p in parts])
    text = np.concatenate([p.column("text").to_numpy() for p in vectors])
    lengths = np.concatenate([p.column("a").value_lengths().to_numpy() for p in vectors]).astype(np.int64)
    order = np.argsort(text, kind="stable")
    by_text = _runs((np.cumsum(lengths) - lengths)[order], lengths[order])
    terms, tfs = flat(vectors, "a")[by_text], flat(vectors, "b")[by_text]
    known, of_term = np.unique(np.repeat(text[order], lengths[order]), return_inverse=True)
    venues, texts, times = flat(entries, "a"), flat(entries, "b"), flat(entries, "c")
    if not len(known):
        return
    at = np.minimum(np.searchsorted(known, texts), len(known) - 1)
    here = known[at] == texts  # a text may have no term of the cell
    venues, at, times = venues[here], at[here], times[here]
    passes = max(1, -(-int(np.bincount(of_term)[at].sum()) // CELL_PRODUCTS))
    pass_of = (terms // BUCKETS) % passes
    for k in range(passes):
        chosen = np.flatnonzero(pass_of == k)
        sizes = np.bincount(of_term[chosen], minlength=len(known))
        places = chosen[_runs((np.cumsum(sizes) - sizes)[at], sizes[at])]
        if not len(places):
            continue
        met = (terms[places].astype(np.int64) << 32) | np.repeat(venues, sizes[at])
        order = np.argsort(met)
        met, tf = met[order], (tfs[places].astype(np.int64) * np.repeat(times, sizes[at]))[order]
        heads = np.flatnonzero(np.concatenate(([True], met[1:] != met[:-1])))
        tf, met = np.add.reduceat(tf, heads), met[heads]
        term, venue = met >> 32, (met & 0xFFFFFFFF).astype(np.int32)
        first = np.concatenate(([True], term[1:] != term[:-1]))
        starts = np.flatnonzero(first)
        n = np.diff(np.append(starts, len(term)))
        held = [pa.array(term), pa.array(venue), pa.array(tf), pa.array(np.repeat(n, n)), pa.array(np.repeat(np.add.reduceat(tf, starts), n)), pa.array(first)]
        metro = pa.array(np.full(len(term), key[0].as_py(), np.int32))
        rows = pa.RecordBatch.from_arrays([metro, *held], names=["metro", "term_id", "venue", "tf", "doc_count", "corpus_count", "is_first"])
        for low in range(0, len(rows), BATCH):
            yield rows.slice(low, BATCH)


def _postings(said: DataFrame, vectors: DataFrame, chunk_entries: int = CHUNK_ENTRIES) -> DataFrame:
    """The sparse product of `said(venue, metro, text_key, times)` and the texts' vectors, with the counts of each list; stored.

    A cell is a chunk of a metro's venues and a range of terms. A metro of up to `chunk_entries` pairs is one chunk, so its
    lists are whole; those of more chunks are counted together afterwards.
    """
    spark = said.sparkSession
    sizes = vectors.groupBy("text_key").agg(F.sum(F.size("term_id")).alias("size"))
    texts = materialise(ordered_position(sizes, [F.asc("text_key")], "text").withColumn("text", F.col("text").cast("int")), "texts")
    chunks = said.groupBy("metro").agg(F.ceil(F.count(F.lit(1)) / chunk_entries).cast("int").alias("chunks"))
    chunk = F.pmod(F.xxhash64("venue"), F.col("chunks")).cast("int").alias("chunk")
    entries = materialise(said.join(texts, "text_key").join(chunks, "metro").select("metro", chunk, "venue", "text", F.col("times").cast("int").alias("times"), "size"), "entries")
    loads = entries.groupBy("metro", "chunk").agg(F.sum("size").alias("products"), F.count(F.lit(1)).alias("entries"))
    cells = materialise(loads.select(
        "metro", "chunk", F.least(F.lit(BUCKETS), F.greatest(F.lit(1), F.ceil(F.col("products") / CELL_PRODUCTS))).cast("int").alias("ranges"),
        F.ceil(F.col("entries") / PACK).cast("int").alias("packs"),
    ), "cells")
    figures = cells.agg(F.sum("ranges").alias("cells"), F.max("chunk").alias("last")).first()

    pack = F.pmod(F.xxhash64("venue", "text"), F.col("packs")).alias("pack")
    packed = entries.join(cells, ["metro", "chunk"]).groupBy("metro", "chunk", "ranges", pack).agg(
        F.collect_list(F.struct(F.col("venue").alias("a"), F.col("text").alias("b"), F.col("times").alias("c"))).alias("pairs")
    )
    each = F.explode(F.sequence(F.lit(0), F.col("ranges") - 1)).alias("range")
    packed = packed.select("metro", "chunk", each, F.lit(None).cast("int").alias("text"), "pairs.a", "pairs.b", "pairs.c")
    needed = entries.select("metro", "chunk", "text").distinct().join(cells, ["metro", "chunk"])
    numbered = vectors.join(texts.select("text_key", "text"), "text_key").drop("text_key")
    meeting = needed.join(numbered, "text").select(
        "metro", "chunk", F.floor(F.col("bucket") * F.col("ranges") / BUCKETS).cast("int").alias("range"), "text",
        F.col("term_id").alias("a"), F.col("tf").alias("b"), F.array().cast("array<int>").alias("c"),  # a null list costs the Arrow writer a pass over its batch
    )
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), figures["cells"] or 1)
    met = meeting.unionByName(packed).repartition(parts, "metro", "chunk", "range").groupBy("metro", "chunk", "range")
    postings = materialise(met.applyInArrow(_lists_of_cell, STORED["postings"]), "postings")
    if not figures["last"]:
        return postings
    whole = postings.filter("is_first").groupBy("metro", "term_id").agg(
        F.sum("doc_count").alias("doc_count"), F.sum("corpus_count").alias("corpus_count"), F.min("venue").alias("first")
    )
    joined = postings.drop("doc_count", "corpus_count", "is_first").join(materialise(whole, "lists"), ["metro", "term_id"])
    return materialise(joined.select("metro", "term_id", "venue", "tf", "doc_count", "corpus_count", (F.col("venue") == F.col("first")).alias("is_first")), "postings")


def _most_frequent(postings: DataFrame, dictionary: DataFrame, size: int) -> DataFrame:
    """The postings of each metro's `size` most frequent terms, ties in alphabetical order.

    A histogram of counts, which has few rows whatever the number of terms, gives the least count that
    can get in; only terms from there on are ranked.
    """
    corpus = postings.filter("is_first").select("metro", "term_id", "corpus_count")
    frequent_first = Window.partitionBy("metro").orderBy(F.desc("corpus_count"))
    least = (
        corpus.groupBy("metro", "corpus_count").agg(F.count(F.lit(1)).alias("terms"))
        .withColumn("terms", F.sum("terms").over(frequent_first))
        .filter(F.col("terms") >= size)
        .groupBy("metro").agg(F.max("corpus_count").alias("least"))
    )
    contenders = corpus.join(materialise(least, "least-counts"), "metro", "left").filter(
        F.col("corpus_count") >= F.coalesce("least", F.lit(0))
    )
    order = [F.col("corpus_count").desc(), F.col("term_id").asc()]
    kept = top_per_group(contenders.drop("least"), ["metro"], order, size, ["term_id"], "place")
    return postings.join(materialise(kept.select("metro", "term_id"), "kept-terms"), ["metro", "term_id"], "left_semi")


def _idf(documents: Column, doc_count: Column) -> Column:
    return F.ln((1 + documents) / (1 + doc_count)) + 1


def _raw() -> Column:
    return (1 + F.ln("tf")) * _idf(F.col("documents"), F.col("doc_count"))


def build_index(venues: DataFrame, reviews: DataFrame, size: int | None = None, block: int = BLOCK) -> TextIndex:
    """Sublinear TF-IDF of `venues(business_id, metro_area, categories)` by their `reviews(business_id, text)`; stored,
    but for `ranked` and `blocks`: a search orders the lists of its terms, whose ids are looked up in the stored postings.

    Terms of a venue's categories count CATEGORY_TIMES. No text of a venue is put together. `size` keeps
    a metro's most frequent terms only.
    """
    numbered, metros = _numbered_venues(venues)
    place = numbered.select("business_id", "venue", "metro")
    key = F.md5(F.col("text").cast("binary")).alias("text_key")
    written = reviews.filter(F.col("text").isNotNull()).select("business_id", "text")
    tagged = numbered.filter(F.col("categories").isNotNull()).select("venue", "metro", F.col("categories").alias("text"))
    said = (
        written.select("business_id", key, F.lit(1).alias("times")).groupBy("business_id", "text_key").agg(F.sum("times").alias("times"))
        .join(place, "business_id").select("venue", "metro", "text_key", "times")
        .unionByName(tagged.select("venue", "metro", key, F.lit(CATEGORY_TIMES).cast("long").alias("times")))
    )
    texts = written.select(key, "text").unionByName(tagged.select(key, "text")).groupBy("text_key").agg(F.first("text").alias("text"))
    dictionary, vectors = _text_vectors(texts)
    postings = _postings(materialise(said, "said"), vectors)
    if size is not None:
        postings = materialise(_most_frequent(postings, dictionary, size), "postings-kept")
    squares = postings.join(metros.select("metro", "documents"), "metro").groupBy("venue").agg(F.sum(_raw() * _raw()).alias("squares"))
    lengths = numbered.drop("categories").join(squares.select("venue", F.sqrt("squares").alias("length")), "venue", "left")
    lengths = materialise(lengths, "lengths")
    long = postings.filter(F.col("doc_count") > block).join(lengths.select("venue", "documents", "length"), "venue")
    heaviest = Window.partitionBy("metro", "term_id").orderBy(F.desc("weight"), F.asc("venue"))
    ranked = long.select("metro", "term_id", "venue", (_raw() / F.col("length")).alias("weight")).withColumn(
        "block", F.floor((F.row_number().over(heaviest) - 1) / block).cast("int")
    )
    return TextIndex(dictionary, lengths, postings, ranked, _tops(ranked))


def _tops(ranked: DataFrame) -> DataFrame:
    return ranked.groupBy("metro", "term_id", "block").agg(F.max("weight").alias("top"))


# --- readable views ---

def _metros(index: TextIndex) -> DataFrame:
    return index.venues.groupBy("metro", "metro_area").agg(F.max("documents").alias("documents"))


def vocabulary(index: TextIndex) -> DataFrame:
    """metro_area, term, corpus_count, doc_count, idf of every term of a metro."""
    heads = index.postings.filter("is_first").join(_metros(index), "metro").join(index.dictionary, "term_id")
    return heads.select("metro_area", "term", "corpus_count", "doc_count", _idf(F.col("documents"), F.col("doc_count")).alias("idf"))


def venue_terms(index: TextIndex) -> DataFrame:
    """metro_area, business_id, term, tf."""
    names = index.venues.select("venue", "business_id", "metro_area")
    return index.postings.join(names, "venue").join(index.dictionary, "term_id").select("metro_area", "business_id", "term", "tf")


def _weighted(postings: DataFrame, index: TextIndex) -> DataFrame:
    """metro, term_id, venue, weight of postings, each venue's vector of unit length."""
    of_venue = postings.join(index.venues.select("venue", "documents", "length"), "venue")
    return of_venue.select("metro", "term_id", "venue", (_raw() / F.col("length")).alias("weight"))


def term_weights(index: TextIndex, terms: DataFrame | None = None) -> DataFrame:
    """`metro_area, business_id, term, weight`; of `terms(metro_area, term)` alone if given."""
    held = index.postings
    if terms is not None:
        held = _of_terms(held, materialise(_numbered(terms, index).select("metro", "term_id").distinct(), "asked-terms"))
    names = index.venues.select("venue", "business_id", "metro_area")
    return _weighted(held, index).join(names, "venue").join(index.dictionary, "term_id").select("metro_area", "business_id", "term", "weight")


def _with_ends(df: DataFrame, index: TextIndex) -> DataFrame:
    """The terms that the ids `low` and `high` stand for, as first_term and last_term."""
    for column, name in (("low", "first_term"), ("high", "last_term")):
        df = df.join(index.dictionary.select(F.col("term_id").alias(column), F.col("term").alias(name)), column).drop(column)
    return df


def vocabulary_summary(index: TextIndex) -> DataFrame:
    """Each metro's terms by the number of venues that have them."""
    heads = index.postings.filter("is_first").groupBy("metro", "doc_count").agg(
        F.count(F.lit(1)).alias("terms"), F.sum("corpus_count").alias("corpus_count"), F.min("term_id").alias("low"), F.max("term_id").alias("high"),
    )
    heads = heads.join(_metros(index), "metro").withColumn("idf", _idf(F.col("documents"), F.col("doc_count")))
    return _with_ends(heads, index).select("metro_area", "doc_count", "terms", "corpus_count", "idf", "first_term", "last_term")


def venue_summary(index: TextIndex) -> DataFrame:
    """Each venue's vector: its terms, their weights' sum and the heaviest."""
    found = _weighted(index.postings, index).groupBy("venue").agg(
        F.count(F.lit(1)).alias("terms"), F.sum("weight").alias("weight_sum"), F.max("weight").alias("heaviest"),
        F.min("term_id").alias("low"), F.max("term_id").alias("high"),
    )
    found = found.join(index.venues.select("venue", "business_id", "metro_area"), "venue")
    return _with_ends(found, index).select("metro_area", "business_id", "terms", "weight_sum", "heaviest", "first_term", "last_term")


# --- storing ---

def store_index(index: TextIndex, path: str) -> None:
    """Keep an index for later searches: lists by metro and ordered by term, terms in order, for skipping."""
    ranked = materialise(index.ranked, "ranked")
    for name, table in index._replace(ranked=ranked, blocks=_tops(ranked))._asdict().items():
        if "term_id" in table.columns and "metro" in table.columns:
            order = [c for c in ("term_id", "block", "venue") if c in table.columns]
            by_metro = table.hint("rebalance", "metro").sortWithinPartitions("metro", *order)
            by_metro.write.mode("overwrite").partitionBy("metro").parquet(join_path(path, name))
        else:
            key = "term" if name == "dictionary" else "venue"
            table.repartitionByRange(key).sortWithinPartitions(key).write.mode("overwrite").parquet(join_path(path, name))


def load_index(spark: SparkSession, path: str) -> TextIndex:
    # schemas are named, as a table of long lists may well be empty
    return TextIndex(*[spark.read.schema(STORED[name]).parquet(join_path(path, name)) for name in TextIndex._fields])


# --- searching ---

def _numbered(terms: DataFrame, index: TextIndex) -> DataFrame:
    """Rows of `terms(metro_area, term, ..)` with metro, documents and term_id; unknown ones go."""
    return terms.join(index.dictionary, "term").join(_metros(index), "metro_area")


def _of_terms(table: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows of the stored `wanted(metro, term_id)`; a few ids go into the scan, which then skips pages without them."""
    ids = [r["term_id"] for r in wanted.select("term_id").distinct().limit(PUSHED_TERMS + 1).collect()]
    held = table.filter(F.col("term_id").isin(ids)) if len(ids) <= PUSHED_TERMS else table
    return held.join(wanted, ["metro", "term_id"], "left_semi")


def _query_weights(queries: DataFrame, index: TextIndex) -> DataFrame:
    """query_id, metro, term_id, query_weight, and `long_top`, the greatest weight where the list is a long one."""
    asked = materialise(_numbered(term_counts(queries, ["query_id", "metro_area"], "query"), index), "query-terms")
    wanted = materialise(asked.select("metro", "term_id").distinct(), "query-lists")
    heads = _of_terms(index.postings.filter("is_first"), wanted).select("metro", "term_id", "doc_count")
    tops = _of_terms(index.blocks.filter("block = 0"), wanted).select("metro", "term_id", F.col("top").alias("long_top"))
    query = Window.partitionBy("query_id", "metro")
    return (
        asked.join(heads, ["metro", "term_id"]).join(tops, ["metro", "term_id"], "left")
        .withColumn("raw", _raw())
        .select("query_id", "metro", "metro_area", "term_id", (F.col("raw") / F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(query))).alias("query_weight"), "long_top")
    )


def _standing(profiles: DataFrame) -> DataFrame:
    """The part of the score that no query changes: review volume and rating."""
    volume = F.log1p(F.coalesce(F.col("review_count"), F.lit(0)).cast("double"))
    loudest = materialise(profiles.groupBy("metro_area").agg(F.max(volume).alias("loudest")), "loudest")
    relative = volume / F.when(F.col("loudest") > 0, F.col("loudest")).otherwise(1.0)
    rating = F.coalesce(F.col("avg_rating"), F.lit(0.0)) / 5
    return (
        profiles.join(loudest, "metro_area")
        .withColumn("standing", VOLUME_SHARE * relative + RATING_SHARE * rating)
        .drop("loudest")
    )


class Look(NamedTuple):
    """What a search knows after its first look."""

    parts: DataFrame  # query_id, metro_area, venue, part: of short lists and first blocks
    plan: DataFrame   # query_id, metro, metro_area, term_id, block, query_weight, bound, least, kept: blocks behind the first


def first_look(weights: DataFrame, index: TextIndex, standing: DataFrame, idle: DataFrame, top_n: int) -> Look:
    """Scores from short lists and first blocks, and which further blocks can still matter.

    `weights` are the stored `_query_weights`; `idle(query_id, metro_area, business_id, match_score)` are
    the venues that can take a place without a match.
    """
    lists = lambda where: materialise(weights.filter(where).select("metro", "term_id").distinct(), "lists")
    long = lists("long_top IS NOT NULL")
    short = materialise(_weighted(_of_terms(index.postings, lists("long_top IS NULL")), index), "short-lists")
    heads = _of_terms(index.ranked.filter("block = 0"), long).select("metro", "term_id", "venue", "weight")
    asked = weights.select("query_id", "metro", "metro_area", "term_id", "query_weight")
    met = short.select("metro", "term_id", "venue", "weight").unionByName(heads).join(asked, ["metro", "term_id"])
    parts = materialise(met.select("query_id", "metro_area", "venue", (F.col("weight") * F.col("query_weight")).alias("part")), "first-parts")

    # the score that the last place has at least
    candidates = _candidates(parts, idle, index).join(standing.select("metro_area", "business_id", "standing"), ["metro_area", "business_id"])
    scored = candidates.withColumn("score", TEXT_SHARE * F.col("match_score") + F.col("standing"))
    best = top_per_group(scored, ["query_id", "metro_area"], [F.desc("score"), F.asc("business_id")], top_n, ["business_id"], "place")
    least = best.filter(F.col("place") == top_n).select("query_id", "metro_area", F.col("score").alias("least"))

    # what a block's venue could have at most
    short_tops = short.groupBy("metro", "term_id").agg(F.max("weight").alias("short_top"))
    query = Window.partitionBy("query_id", "metro")
    bounded = (
        weights.join(short_tops, ["metro", "term_id"], "left")
        .withColumn("most", F.col("query_weight") * F.coalesce("long_top", "short_top"))
        .withColumn("others", F.sum("most").over(query) - F.col("most"))
        .filter("long_top IS NOT NULL")
    )
    highest = standing.groupBy("metro_area").agg(F.max("standing").alias("highest"))
    later = _of_terms(index.blocks.filter("block > 0"), long)
    bound = TEXT_SHARE * (F.col("query_weight") * F.col("top") + F.col("others")) + F.col("highest")
    plan = (
        later.join(bounded, ["metro", "term_id"]).join(highest, "metro_area").join(least, ["query_id", "metro_area"], "left")
        .select("query_id", "metro", "metro_area", "term_id", "block", "query_weight", bound.alias("bound"), "least")
        .withColumn("kept", F.col("least").isNull() | (F.col("bound") >= F.col("least") - 2 * SLACK))
    )
    return Look(parts, materialise(plan, "block-plan"))


def _candidates(parts: DataFrame, idle: DataFrame, index: TextIndex) -> DataFrame:
    """query_id, metro_area, business_id, match_score of the venues met, and of the idle ones."""
    matches = parts.groupBy("query_id", "metro_area", "venue").agg(F.sum("part").alias("match_score"))
    named = matches.join(index.venues.select("venue", "business_id"), "venue").drop("venue")
    key = ["query_id", "metro_area", "business_id"]
    return named.unionByName(idle).groupBy(*key).agg(F.max("match_score").alias("match_score"))


def search(
    queries: DataFrame, profiles: DataFrame, index: TextIndex, top_n: int = RESULTS, min_match: float = MIN_MATCH,
) -> DataFrame:
    """Best venues for each of `queries(query_id, metro_area, query)`.

    Venues are ranked by 60 % text match, 25 % volume and 15 % rating; of the first `top_n`
    those matching the text by more than `min_match` are returned. Venues without a common
    term may take places too. Only the metro's `top_n` by standing can do so, hence a query
    meets its matches and those few, never the whole metro; of a frequent term's matches only the
    blocks that can still hold a winner.
    """
    asked = queries.filter(F.length(strip(F.col("query"))) > 0)
    located = profiles.filter(F.col("metro_area").isNotNull())
    venue = ["metro_area", "business_id"]
    # stored first: a few queries are broadcast and the lists are read in place, many are joined by shuffle
    weights = materialise(_query_weights(asked, index), "query-weights")
    standing = _standing(located)
    well_known = top_per_group(
        standing.select(*venue, "standing"), ["metro_area"], [score_order("standing"), F.col("business_id").asc()],
        top_n, ["business_id"],
    )
    idle = materialise(asked.join(well_known, "metro_area").select("query_id", *venue, F.lit(0.0).alias("match_score")), "idle")
    look = first_look(weights, index, standing, idle, top_n)
    kept = materialise(look.plan.filter("kept").select("query_id", "metro", "metro_area", "term_id", "block", "query_weight"), "blocks-kept")
    further = _of_terms(index.ranked.filter("block > 0"), materialise(kept.select("metro", "term_id").distinct(), "lists"))
    rest = further.join(kept, ["metro", "term_id", "block"]).select("query_id", "metro_area", "venue", (F.col("weight") * F.col("query_weight")).alias("part"))
    candidates = (
        _candidates(look.parts.unionByName(rest), idle, index).join(standing, venue)
        .withColumn("final_score", TEXT_SHARE * F.col("match_score") + F.col("standing"))
        .drop("standing", "profile_text")
    )
    ranked = top_per_group(
        candidates, ["query_id", "metro_area"], [score_order("final_score"), F.col("business_id").asc()],
        top_n, ["business_id"], "position",
    )
    return ranked.filter(F.col("match_score") > min_match)
