"""Text classifier whose vocabulary and weights stay out of the driver.

Logistic regression over TF-IDF of terms, with a ridge penalty of strength 1 on the weights, fitted by accelerated
gradient steps over all fitting rows. From zero weights, weights are always a sum of the reviews' vectors, so a step
keeps one coefficient a review in place of the weights. Terms are dealt once to parts of about PART_ENTRIES
counts, which are packed and stored in buckets; a step sends a review's coefficient to the parts that have a term of it,
and a part answers with its share of each review's margin. So counts are shuffled once, and a step shuffles at most two
numbers for each part of a review, without any term. The driver sees one number a step, the intercept. Neither
rows nor terms are bounded; a term that more than TERM_ROWS reviews have stays in rows, which are joined.

A text without terms, or with none of the fitted ones, is scored by the intercept alone.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venuerank.operators.classifier import SEED, TEST_FRACTION, binary_labels
from venuerank.operators.ranking import ordered_position
from venuerank.operators.sampling import stratified_split
from venuerank.functions.text import tokens, unigrams_and_bigrams
from venuerank.session import discard, materialise, shared_dir

ROUNDS = 50
DIGITS = 9  # margins are compared with 0 to so many digits
PART_ENTRIES, SMALL_PART = 8_000_000, 100_000  # counts of a part, and where there are cores to spare
PACK = 1_000_000  # counts to a row
SLICE_WORDS = 500_000  # whose terms are counted at once
TERM_ROWS = 1_000_000  # reviews of a term that is packed
TERM_CHARS = 3  # characters of a text to a term, about


class TermModel(NamedTuple):
    terms: DataFrame  # term, idf, weight
    intercept: float


def split(reviews: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stored (review_id, label) of the fitting and of the held-out reviews, as the library classifier splits them."""
    labelled = binary_labels(reviews).select("review_id", "label")
    parted = materialise(stratified_split(labelled, "review_id", "label", TEST_FRACTION, SEED), "term-split")
    return tuple(parted.filter(side).select("review_id", "label") for side in ("NOT is_test", "is_test"))


def term_counts(reviews: DataFrame) -> DataFrame:
    """`review_id, term, tf` of whole texts."""
    return reviews.select("review_id", F.explode(unigrams_and_bigrams(F.col("text"))).alias("term")).groupBy("review_id", "term").agg(F.count(F.lit(1)).alias("tf"))


def inverse_frequencies(counts: DataFrame, documents: int, vocabulary: int | None = None) -> DataFrame:
    """`term, idf`; of the `vocabulary` most frequent terms where that is given, ties by term."""
    found = counts.groupBy("term").agg(F.sum("tf").alias("total"), F.count(F.lit(1)).alias("df"))
    if vocabulary is not None:
        found = found.orderBy(F.desc("total"), "term").limit(vocabulary)
    return found.select("term", (F.log((F.lit(documents) + 1.0) / (F.col("df") + 1.0)) + 1.0).alias("idf"))


def _lists(values: np.ndarray | pa.Array, ends: list[int]) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, *ends], pa.int32()), values if isinstance(values, pa.Array) else pa.array(values))


def _by_part(reviews: pa.Array, tests: np.ndarray, terms: pa.Array, at: np.ndarray, code: np.ndarray, tf: np.ndarray, parts: int) -> pa.RecordBatch:
    """Counts (review at, term code, tf) as one row for each part that has any, with its terms and lists of counts."""
    home = (pd.util.hash_array(terms.to_numpy(zero_copy_only=False), categorize=False) % parts).astype(np.int32)
    place = np.argsort(home, kind="stable")
    held = np.bincount(home, minlength=parts)
    code_there = np.empty(len(home), np.int32)
    code_there[place] = np.arange(len(home)) - np.repeat(np.cumsum(held) - held, held)
    order = np.argsort(home[code], kind="stable")
    at, code, tf = at[order], code[order], tf[order]
    counts = np.bincount(home[code], minlength=parts)
    some = np.flatnonzero(held)
    ends = np.cumsum(counts)[some].tolist()
    return pa.RecordBatch.from_arrays(
        [pa.array(some.astype(np.int32)), _lists(terms.take(pa.array(place)), np.cumsum(held)[some].tolist()), _lists(reviews.take(pa.array(at)), ends),
         _lists(tests[at], ends), _lists(code_there[code], ends), _lists(tf.astype(np.int32), ends)],
        names=["part", "terms", "reviews", "tests", "codes", "tf"],
    )


def _rows_by_part(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                terms = batch.column("term").dictionary_encode()
                tests, tf = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("is_test", "tf"))
                yield _by_part(batch.column("review_id"), tests, terms.dictionary, np.arange(batch.num_rows), terms.indices.to_numpy(), tf, parts)

    return run


def _words_by_part(parts: int):
    """As `_rows_by_part`, from each review's words: terms are made and counted for SLICE_WORDS or so at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            upto = np.cumsum(batch.column("words").value_lengths().to_numpy())
            cuts = np.flatnonzero(np.diff(upto // SLICE_WORDS, append=-1)) + 1
            for low, high in zip([0, *cuts[:-1]], cuts):
                piece = batch.slice(low, high - low)
                words, sizes = piece.column("words").flatten(), piece.column("words").value_lengths().to_numpy()
                if not len(words):
                    continue
                row = np.repeat(np.arange(len(sizes)), sizes)
                first = np.flatnonzero(row[1:] == row[:-1])
                pairs = pc.binary_join_element_wise(words.take(pa.array(first)), words.take(pa.array(first + 1)), " ")
                terms = pa.concat_arrays([words, pairs]).dictionary_encode()
                size = len(terms.dictionary)
                found, tf = np.unique(np.concatenate([row, row[first]]) * size + terms.indices.to_numpy(), return_counts=True)
                tests = piece.column("is_test").to_numpy(zero_copy_only=False)
                yield _by_part(piece.column("review_id"), tests, terms.dictionary, found // size, found % size, tf, parts)

    return run


def _pack(documents: int, named: bool):
    """A part's counts, added up, by term: a row for each PACK counts or so of whole terms. The first row has the part's reviews."""

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        lists = {c: rows.column(c).chunk(0) for c in ("terms", "reviews", "tests", "codes", "tf")}
        reviews, terms = (lists[c].flatten().dictionary_encode() for c in ("reviews", "terms"))
        held = lists["terms"].value_lengths().to_numpy().astype(np.int64)
        own = lists["codes"].flatten().to_numpy() + np.repeat(np.cumsum(held) - held, lists["codes"].value_lengths().to_numpy())
        at, code = reviews.indices.to_numpy().astype(np.int64), terms.indices.to_numpy().astype(np.int64)[own]
        order = np.argsort(code * len(reviews.dictionary) + at, kind="stable")
        at, code = at[order], code[order]
        heads = np.concatenate(([0], np.flatnonzero((code[1:] != code[:-1]) | (at[1:] != at[:-1])) + 1))
        tf = np.add.reduceat(lists["tf"].flatten().to_numpy()[order], heads)
        fitting = ~lists["tests"].flatten().to_numpy(zero_copy_only=False)[order][heads]
        at, code = at[heads], code[heads]
        df = np.bincount(code[fitting], minlength=len(terms.dictionary))
        known = df > 0
        kept = known[code]
        at, tf = at[kept].astype(np.int32), tf[kept].astype(np.int32)
        sizes = np.bincount(code[kept], minlength=len(df))[known]
        idf = np.log((documents + 1.0) / (df[known] + 1.0)) + 1.0
        upto = np.cumsum(sizes)
        ends = [int(e) for e in np.flatnonzero(np.diff(upto // PACK, append=-1)) + 1]  # terms before each row's end
        counts = [int(upto[e - 1]) for e in ends]
        names = terms.dictionary.filter(pa.array(known)) if named else pa.array([], pa.string())
        return pa.table({
            "part": pa.array(np.full(len(ends), rows.column("part")[0].as_py()), pa.int32()), "chunk": pa.array(range(len(ends)), pa.int32()),
            "reviews": _lists(reviews.dictionary, [len(reviews.dictionary)] * len(ends)),
            "sizes": _lists(sizes.astype(np.int32), ends), "idf": _lists(idf, ends), "at": _lists(at, counts), "tf": _lists(tf, counts),
            "terms": _lists(names, ends if named else [0] * len(ends)),
        })

    return run


def _unpacked(packs: pa.Table) -> tuple[pa.Array, list[tuple[np.ndarray, ...]]]:
    """A part's reviews, and by row: (place of the review, tf * idf, first count of each term, counts of each term)."""
    packs = packs.sort_by("chunk").combine_chunks()
    lists = {c: packs.column(c).chunk(0) for c in ("reviews", "sizes", "idf", "at", "tf")}
    rows = []
    for i in range(len(packs)):
        sizes, idf, at, tf = (lists[c][i].values.to_numpy() for c in ("sizes", "idf", "at", "tf"))
        rows.append((at, tf * np.repeat(idf, sizes), np.cumsum(sizes) - sizes, sizes))
    return lists["reviews"][0].values, rows


def _squares(packs: pa.Table) -> pa.Table:
    reviews, rows = _unpacked(packs)
    squares = sum(np.bincount(at, raw * raw, len(reviews)) for at, raw, _, _ in rows)
    part = np.full(len(reviews), packs.column("part")[0].as_py())
    return pa.table({"review_id": reviews, "part": pa.array(part, pa.int32()), "square": pa.array(squares)}).filter(pa.array(squares > 0))


def _placed(reviews: pa.Array, sent: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Coefficient of each review of a part, and which were sent one."""
    place = pc.index_in(sent.column("review_id"), value_set=reviews).to_numpy()
    return np.bincount(place, sent.column("a").to_numpy(), len(reviews)), np.bincount(place, minlength=len(reviews)) > 0


def _answered(held_out: bool):
    """A part's share of the margins of the reviews that were sent, or of the others."""

    def run(packs: pa.Table, sent: pa.Table) -> pa.Table:
        if not len(packs) or not len(sent):
            return pa.table({"review_id": sent.column("review_id").slice(0, 0), "share": pa.array([], pa.float64())})
        reviews, rows = _unpacked(packs)
        a, fitting = _placed(reviews, sent)
        share = np.zeros(len(reviews))
        for at, raw, heads, sizes in rows:
            share += np.bincount(at, raw * np.repeat(np.add.reduceat(raw * a[at], heads), sizes), len(reviews))
        asked = fitting ^ held_out
        return pa.table({"review_id": reviews.filter(pa.array(asked)), "share": pa.array(share[asked])})

    return run


def _weighed(packs: pa.Table, sent: pa.Table) -> pa.Table:
    """A part's terms with their weights."""
    if not len(packs):
        return pa.table({"term": pa.array([], pa.string()), "idf": pa.array([], pa.float64()), "weight": pa.array([], pa.float64())})
    reviews, rows = _unpacked(packs)
    a = _placed(reviews, sent)[0]
    packs = packs.sort_by("chunk").combine_chunks()
    weights = np.concatenate([np.add.reduceat(raw * a[at], heads) for at, raw, heads, _ in rows])
    return pa.table({"term": packs.column("terms").chunk(0).flatten(), "idf": packs.column("idf").chunk(0).flatten(), "weight": pa.array(weights)})


class _Dealt(NamedTuple):
    table: str       # packs in buckets by part, which are met without a shuffle
    buckets: int
    links: DataFrame  # review_id, length, in_parts
    often: DataFrame | None  # review_id, is_test, term, idf, raw: counts of terms that are not packed


def _deal(rows: DataFrame, entries: int, reviews: int, documents: int, words: DataFrame | None = None, named: bool = False) -> _Dealt:
    """Counts `review_id, is_test, term, tf`, about `entries` of them, in stored parts; `documents` of the `reviews` are fitted.

    `words(review_id, is_test, words)` gives the same counts with fewer rows.
    """
    spark = rows.sparkSession
    kind = rows.schema["review_id"].dataType.simpleString()
    often = None
    if reviews > TERM_ROWS:  # else no term can be in more
        rows = materialise(rows, "term-rows")
        found = materialise(rows.groupBy("term").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > TERM_ROWS).select("term"), "frequent-terms")
        if not found.isEmpty():
            whole = rows.join(found, "term").groupBy("review_id", "is_test", "term").agg(F.sum("tf").alias("tf"))
            whole = materialise(whole, "frequent-counts")
            idf = whole.groupBy("term").agg(F.count_if(~F.col("is_test")).alias("df")).filter("df > 0").select("term", (F.log((F.lit(documents) + 1.0) / (F.col("df") + 1.0)) + 1.0).alias("idf"))
            often = materialise(whole.join(idf, "term").select("review_id", "is_test", "term", "idf", (F.col("tf") * F.col("idf")).alias("raw")), "frequent-values")
            rows = rows.join(found, "term", "left_anti")
    cores = spark.sparkContext.defaultParallelism
    parts = max(1, -(-entries // PART_ENTRIES), min(cores, -(-entries // SMALL_PART)))
    buckets = 2 * parts  # by their hash, few parts share one
    listed = f"part int, terms array<string>, reviews array<{kind}>, tests array<boolean>, codes array<int>, tf array<int>"
    if words is None or reviews > TERM_ROWS:
        dealt = rows.select("review_id", "is_test", "term", "tf").mapInArrow(_rows_by_part(parts), listed)
    else:
        dealt = words.select("review_id", "is_test", "words").mapInArrow(_words_by_part(parts), listed)
    packs = dealt.repartition(buckets, "part").groupBy("part").applyInArrow(
        _pack(documents, named), f"part int, chunk int, reviews array<{kind}>, sizes array<int>, idf array<double>, at array<int>, tf array<int>, terms array<string>",
    )
    name = f"term_packs_{uuid.uuid4().hex}"
    packs.write.bucketBy(buckets, "part").option("path", f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{name}").saveAsTable(name)
    squares = _packs(spark, name).groupBy("part").applyInArrow(_squares, f"review_id {kind}, part int, square double")
    if often is not None:
        squares = squares.unionByName(often.select("review_id", F.lit(None).cast("int").alias("part"), (F.col("raw") * F.col("raw")).alias("square")))
    links = squares.groupBy("review_id").agg(F.sqrt(F.sum("square")).alias("length"), F.collect_set("part").alias("in_parts"))
    return _Dealt(name, buckets, materialise(links, "term-links"), often)


def _packs(spark, name: str, *more: str) -> DataFrame:
    return spark.table(name).select("part", "chunk", "reviews", "sizes", "idf", "at", "tf", *more)


def _forget(dealt: _Dealt) -> None:
    spark = dealt.links.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {dealt.table}")
    stored = spark.createDataFrame([], "part int")
    stored.scratch_path = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{dealt.table}"
    discard(stored, dealt.links, *([] if dealt.often is None else [dealt.often]))


def _sent(dealt: _Dealt, coefficients: DataFrame) -> DataFrame:
    """`part, review_id, a`: the coefficients of raw values, in every part that needs them."""
    linked = coefficients.join(dealt.links, "review_id")
    sent = linked.select(F.explode("in_parts").alias("part"), "review_id", (F.col("alpha") / F.col("length")).alias("a"))
    return sent.repartition(dealt.buckets, "part")


def _margins(dealt: _Dealt, coefficients: DataFrame, held_out: bool = False) -> DataFrame:
    """`review_id, margin` without the intercept, of the reviews of `coefficients(review_id, alpha)` or of all others; none without a fitted term."""
    spark = coefficients.sparkSession
    kind = coefficients.schema["review_id"].dataType.simpleString()
    met = _packs(spark, dealt.table).groupBy("part").cogroup(_sent(dealt, coefficients).groupBy("part"))
    shares = met.applyInArrow(_answered(held_out), f"review_id {kind}, share double")
    if dealt.often is not None:
        asked = dealt.often.filter("is_test" if held_out else "NOT is_test")
        shares = shares.unionByName(asked.join(_often_weights(dealt, coefficients), "term").select("review_id", (F.col("raw") * F.col("weight")).alias("share")))
    return shares.groupBy("review_id").agg(F.sum("share").alias("share")).join(dealt.links.select("review_id", "length"), "review_id").select("review_id", (F.col("share") / F.col("length")).alias("margin"))


def _often_weights(dealt: _Dealt, coefficients: DataFrame) -> DataFrame:
    linked = coefficients.join(dealt.links, "review_id").select("review_id", (F.col("alpha") / F.col("length")).alias("a"))
    return dealt.often.join(linked, "review_id").groupBy("term").agg(F.any_value("idf").alias("idf"), F.sum(F.col("raw") * F.col("a")).alias("weight"))


def _probability(margin: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-margin))


def _fitting_rows(train: DataFrame) -> int:
    classes = train.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("label").alias("classes")).first()
    if classes["classes"] < 2:
        raise ValueError("the classifier needs reviews of both labels")
    return classes["n"]


def _descend(dealt: _Dealt, train: DataFrame, n: int, rounds: int) -> tuple[DataFrame, float]:
    """`review_id, alpha` of the fitting reviews after `rounds` steps, whose vectors so weighted add up to the weights; and the intercept.

    A step's length is the inverse of the greatest curvature a sum of rows of length 1, the intercept and the
    penalty can have.
    """
    step = 1.0 / (0.5 + 1.0 / n)
    zero = F.lit(0.0)
    state = train.select("review_id", "label", zero.alias("last"), zero.alias("alpha"), zero.alias("margin"))
    held, last, intercept = [], 0.0, 0.0
    for k in range(1, rounds + 1):
        ahead = (k - 1) / (k + 2)  # where the next gradient is taken
        moved = state.withColumn("residual", _probability(F.col("margin") + F.lit(intercept)) - F.col("label"))
        moved = moved.withColumn("moved", F.col("alpha") - step / n * (F.col("residual") + F.col("alpha")))
        stepped = materialise(moved.select(
            "review_id", "label", "residual", F.col("moved").alias("last"), (F.col("moved") + ahead * (F.col("moved") - F.col("last"))).alias("alpha"),
        ), "term-step")
        here = intercept - step * stepped.agg(F.avg("residual")).first()[0]
        last, intercept = here, here + ahead * (here - last)
        discard(*held)
        held = [stepped]
        if k < rounds:
            margins = _margins(dealt, stepped.select("review_id", "alpha"))
            state = materialise(stepped.drop("residual").join(margins, "review_id", "left").withColumn("margin", F.coalesce("margin", zero)), "term-state")
            held.append(state)
    return held[0].select("review_id", F.col("last").alias("alpha")), last


def fit(train: DataFrame, counts: DataFrame, rounds: int = ROUNDS, vocabulary: int | None = None) -> TermModel:
    """The model after `rounds` steps from zero weights. `train` has review_id and label, `counts` its terms."""
    n = _fitting_rows(train)
    mine = counts.join(train.select("review_id"), "review_id", "left_semi").select("review_id", F.lit(False).alias("is_test"), "term", "tf")
    if vocabulary is not None:
        mine = mine.join(materialise(inverse_frequencies(mine, n, vocabulary), "term-frequencies").select("term"), "term", "left_semi")
    mine = materialise(mine.select("review_id", "is_test", "term", "tf"), "term-counts")
    dealt = _deal(mine, mine.count(), n, n, named=True)
    alpha, intercept = _descend(dealt, train, n, rounds)
    packs = _packs(mine.sparkSession, dealt.table, "terms")
    terms = packs.groupBy("part").cogroup(_sent(dealt, alpha).groupBy("part")).applyInArrow(_weighed, "term string, idf double, weight double")
    if dealt.often is not None:
        terms = terms.unionByName(_often_weights(dealt, alpha))
    model = TermModel(materialise(terms, "term-model"), intercept)
    discard(mine)
    _forget(dealt)
    return model


def predict(model: TermModel, reviews: DataFrame, counts: DataFrame) -> DataFrame:
    """`reviews` with probability and prediction of label 1."""
    mine = counts.join(reviews.select("review_id"), "review_id", "left_semi").join(model.terms, "term")
    raw = F.col("tf") * F.col("idf")
    sums = mine.groupBy("review_id").agg((F.sum(raw * F.col("weight")) / F.sqrt(F.sum(raw * raw))).alias("margin"))
    return _scored(reviews.join(sums, "review_id", "left"), model.intercept)


def _scored(margins: DataFrame, intercept: float) -> DataFrame:
    whole = margins.withColumn("margin", F.coalesce("margin", F.lit(0.0)) + F.lit(intercept))
    return whole.withColumns({
        "probability": _probability(F.col("margin")), "prediction": (F.round("margin", DIGITS) > 0).cast("double"),
    }).drop("margin")


def predict_held_out(reviews: DataFrame, rounds: int = ROUNDS, vocabulary: int | None = None) -> DataFrame:
    """`review_id, label, probability, prediction` of every held-out review."""
    labelled = binary_labels(reviews)
    if vocabulary is not None:
        train, test = split(reviews)
        counts = materialise(term_counts(labelled), "term-all-counts")
        return predict(fit(train, counts, rounds, vocabulary), test, counts)
    train, test = split(reviews)
    n = _fitting_rows(train)
    sides = train.withColumn("is_test", F.lit(False)).unionByName(test.withColumn("is_test", F.lit(True)))
    sides = sides.select("review_id", "is_test").distinct()
    numbered = materialise(ordered_position(sides, [F.asc("review_id")], "number"), "term-reviews")
    texts = labelled.select("review_id", "text").join(numbered, "review_id")
    size = labelled.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("chars")).first()
    texts = texts.select(F.col("number").alias("review_id"), "is_test", "text")
    rows = texts.select("review_id", "is_test", F.explode(unigrams_and_bigrams(F.col("text"))).alias("term")).groupBy("review_id", "is_test", "term").agg(F.count(F.lit(1)).alias("tf"))
    words = texts.select("review_id", "is_test", tokens(F.col("text")).alias("words"))
    dealt = _deal(rows, size["chars"] // TERM_CHARS, size["n"], n, words)
    mine = lambda side, held: side.join(numbered.filter(held).select("review_id", "number"), "review_id")
    alpha, intercept = _descend(dealt, materialise(mine(train, "NOT is_test").select(F.col("number").alias("review_id"), "label"), "term-labels"), n, rounds)
    margins = _margins(dealt, alpha, held_out=True).withColumnRenamed("review_id", "number")
    found = materialise(mine(test, "is_test").join(margins, "number", "left").drop("number"), "term-margins")
    _forget(dealt)
    return _scored(found, intercept)
