"""Toxic passages by maximum-scoring segment search over token log-odds.

* Log-odds: words and the leading 4 and 5 bytes of words get the log-odds of toxic against
  clean training texts, counted once per text and
  smoothed by an informative Dirichlet prior (a floor and a share of the counts of both). Entries
  whose z-score is significant make the lexicon; every other word costs DRIFT.
* Segments: all maximal-scoring segments of a text's words, best one first. Equal words score once
  in a segment, further ones cost DRIFT there, but score anew in any other segment. Where no word
  comes again one linear pass finds them.
* Extreme values: a segment of score S among n words has the expected number K n exp(-L S) of
  equals in clean text; L solves sum p exp(L s) = 1 over the scores of clean training words and K
  comes from the best segments of clean training texts. Segments of an expectation below
  SIGNIFICANT are passages; a text's evidence is the sum of their -log expectations, each
  by the share of its score from words that no better passage of the text has. Two logistic
  parameters, fitted on the training texts, turn it into a probability.

The model is learnt from at most TRAIN_ROWS labelled rows, the first by a hash of doc_id. Scores
read the text alone, all of it.

Defined results: a null, empty or blank text has no evidence and gets the probability of a text
without passages; rows without a label are scored but never learnt from; repeated label rows
count once per pair of rows; without labels, or with one class only, the lexicon is empty and
every score is the share of toxic rows (0 without any); columns other than those named are ignored.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from venuerank.llm.sampling import first_by_hash
from venuerank.llm.text import Texts, in_batches, prefix_hash, slices, span_hash, words, _LOWER
from venuerank.session import materialise

TRAIN_ROWS = 20_000
LEAST_COUNT = 5  # tokens of fewer texts can't be significant
PRIOR_FLOOR, PRIOR_SHARE = 0.5, 0.005  # the Dirichlet prior's pseudo-counts: a floor, and a share of a token's counts
Z = 3.2  # a token of six toxic texts and no clean one passes, of five not
DRIFT = 0.25
SIGNIFICANT = 0.05
PREFIXES = (4, 5)


class Model(NamedTuple):
    keys: np.ndarray  # sorted token hashes of the lexicon
    odds: np.ndarray
    rate: float  # L
    scale: float  # log K
    bias: float
    slope: float


def token_hashes(texts: Texts) -> tuple[np.ndarray, list[np.ndarray]]:
    """Word bounds per text, and per word the hashes of the word and of its longer prefixes."""
    found = words(texts)
    prefix = prefix_hash(_LOWER[texts.data])
    out = [found.hashes]
    for size in PREFIXES:
        ends = np.minimum(found.starts + size, found.ends)
        # a short word's prefix is the word itself and adds nothing
        out.append(np.where(found.ends - found.starts > size, span_hash(prefix, found.starts, ends) ^ np.uint64(size), found.hashes))
    return found.cuts, out


def word_scores(hashes: list[np.ndarray], model: Model) -> np.ndarray:
    """The largest lexicon score of each word's tokens, 0 where none is known."""
    best = np.zeros(len(hashes[0]))
    if not len(model.keys):
        return best
    seen = np.zeros(1 << 16, bool)
    seen[model.keys >> np.uint64(48)] = True
    for h in hashes:
        maybe = np.flatnonzero(seen[h >> np.uint64(48)])
        place = np.minimum(np.searchsorted(model.keys, h[maybe]), len(model.keys) - 1)
        hit = model.keys[place] == h[maybe]
        maybe, place = maybe[hit], place[hit]
        best[maybe] = np.maximum(best[maybe], model.odds[place])
    return best


def segments(at: list[int], scores: list[float], drift: float = DRIFT) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (first word, end, score) in one linear pass.

    `at` are the places of the words that score; every other word costs `drift`. Candidates are
    kept with the running sums before and after them; a new one is merged leftwards while the
    nearest candidate with a smaller sum before it ends below the new one's end.
    """
    found: list[tuple[int, int, float, float]] = []
    total, place = 0.0, 0
    for where, score in zip(at, scores):
        total -= drift * (where - place)
        begin, low, high = where, total, total + score
        while found:
            # candidates that start no lower can't be joined to this one, nor to a later one before it
            j = len(found) - 1
            while j >= 0 and found[j][2] >= low:
                j -= 1
            if j < 0 or found[j][3] >= high:
                break
            begin, low = found[j][0], found[j][2]
            del found[j:]
        found.append((begin, where + 1, low, high))
        total, place = total + score, where + 1
    return [(a, b, high - low) for a, b, low, high in found]


def _islands(at: list[int], scores: list[float], low: int, high: int, drift: float) -> Iterator[tuple[int, int]]:
    """Runs of hits that no segment with a positive score leaves."""
    begin, total = low, 0.0
    for i in range(low, high):
        if i > begin:
            total -= drift * (at[i] - at[i - 1] - 1)
            if total <= 0:
                yield begin, i
                begin, total = i, 0.0
        total += scores[i]
    yield begin, high


def _best_by_end(at: list[int], words_: list[int], scores: list[float], low: int, high: int, drift: float) -> list[tuple[float, int, int]]:
    """(-score, last hit, first hit) of the best segment that ends at each hit, equal words scoring once in it.

    A start whose segment has fallen to 0 is dropped: the hit after it is a better start for all that follows.
    So no more starts are held than the scores of distinct words can carry.
    """
    value, last, live, out = np.zeros(high - low), {}, 0, []
    for i in range(low, high):
        j = i - low
        if j > live:
            value[live:j] -= drift * (at[i] - at[i - 1] - 1)
        before = last.get(words_[i], -1)
        value[max(live, before + 1) : j + 1] += scores[i]
        if before >= live:
            value[live : before + 1] -= drift
        last[words_[i]] = j
        while value[live] <= 0:
            live += 1
        held = value[live : j + 1]
        k = len(held) - 1 - int(held[::-1].argmax())  # the shortest of equals
        out.append((-float(held[k]), i, low + live + k))
    return out


def distinct_segments(at: list[int], words_: list[int], scores: list[float], drift: float = DRIFT) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (first word, end, score), in each of which equal words score once.

    The best segment is one, and so on left and right of it. All segments that beat every one they overlap are taken at once.
    """
    found, todo = [], [(0, len(at))]
    while todo:
        for low, high in _islands(at, scores, *todo.pop(), drift):
            if len(set(words_[low:high])) == high - low:
                found += segments(at[low:high], scores[low:high], drift)
                continue
            touched, begin = bytearray(high - low), low
            chosen = []
            for score, end, first in sorted(_best_by_end(at, words_, scores, low, high, drift)):
                if 1 not in touched[first - low : end + 1 - low]:
                    chosen.append((first, end + 1, -score))
                touched[first - low : end + 1 - low] = b"\1" * (end + 1 - first)
            for first, end, score in sorted(chosen):
                found.append((at[first], at[end - 1] + 1, score))
                if first > begin:
                    todo.append((begin, first))
                begin = end
            if begin < high:
                todo.append((begin, high))
    return sorted(found)


class Passage(NamedTuple):
    first: int  # word
    end: int
    score: float
    new: float  # share of its score from words that no better passage has


class Evidence(NamedTuple):
    n: int  # words
    best: float  # score of the best segment
    passages: list[Passage]
    counted: list[float]  # the scores that make up the segments


def evidence(texts: Texts, model: Model) -> list[Evidence]:
    """The passages of each text."""
    cuts, hashes = token_hashes(texts)
    scores = word_scores(hashes, model)
    places = np.flatnonzero(scores)
    edges = np.searchsorted(places, cuts)
    out = []
    for i, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())):
        n = int(cuts[i + 1] - cuts[i])
        if a == b:
            out.append(Evidence(n, 0.0, [], []))
            continue
        at, own, held = (places[a:b] - cuts[i]).tolist(), hashes[0][places[a:b]].tolist(), scores[places[a:b]].tolist()
        found = distinct_segments(at, own, held)
        seen, passages, counted = set(), [], []
        for first, end, score in sorted(found, key=lambda p: (-p[2], p[0])):
            inside = dict((own[k], held[k]) for k in range(bisect_left(at, first), bisect_left(at, end)))
            counted += inside.values()
            if expectation(score, n, model) < SIGNIFICANT:
                new = sum(x for w, x in inside.items() if w not in seen) / sum(inside.values())
                passages.append(Passage(first, end, score, new))
                seen.update(inside)
        out.append(Evidence(n, max(p[2] for p in found), sorted(passages), counted))
    return out


def expectation(score: float, n: int, model: Model) -> float:
    return math.exp(min(50.0, model.scale + math.log(max(n, 1)) - model.rate * score))


def weight_of(n: int, passages: Iterable[tuple[float, float]], model: Model) -> float:
    """The evidence of (score, new) of a text's passages."""
    return math.log1p(sum(-math.log(max(1e-300, expectation(s, n, model))) * new for s, new in passages))


def probability(n: int, passages: list[Passage], model: Model) -> float:
    x = weight_of(n, [(p.score, p.new) for p in passages], model)
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, model.bias + model.slope * x))))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, trained: Column, rows: int) -> DataFrame:
    """(doc_id, text, y) of at most `rows` labelled rows; stored."""
    known = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & trained)
    chosen = materialise(first_by_hash(known.select("doc_id", F.col(label).cast("int").alias("y")), "doc_id", rows), "labelled")
    # at most `rows` rows of two numbers
    return materialise(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "y"), "training")


def learn(docs: DataFrame, labels: DataFrame, trained: Column, rows: int = TRAIN_ROWS) -> Model:
    train = training_rows(in_batches(docs), labels, "toxic", trained, rows)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = batch.column("y").to_numpy()
            for part in slices(batch.column("text")):
                cuts, hashes = token_hashes(part)
                doc = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
                flat, text = np.concatenate(hashes), np.tile(doc, len(hashes))
                order = np.lexsort((text, flat))
                flat, text = flat[order], text[order]
                once = np.ones(len(flat), bool)  # a text counts once for each of its tokens
                once[1:] = (flat[1:] != flat[:-1]) | (text[1:] != text[:-1])
                flat, toxic = flat[once], y[part.first + text[once]] == 1
                keys, back = np.unique(flat, return_inverse=True)
                hits = np.bincount(back, weights=toxic, minlength=len(keys)).astype(np.int64)
                all_ = np.bincount(back, minlength=len(keys))
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(hits), pa.array(all_ - hits)], names=["token", "toxic", "clean"])

    counts = materialise(
        train.mapInArrow(count, "token long, toxic long, clean long").groupBy("token")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")),
        "token-counts",
    )
    sums = counts.agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c"), F.count_if(F.col("toxic") + F.col("clean") >= LEAST_COUNT).alias("n")).first()
    classes = {r["y"]: r["n"] for r in train.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    empty = Model(np.empty(0, np.uint64), np.empty(0), 1.0, 0.0, -30.0, 1.0)
    toxic_rows, all_rows = classes.get(1, 0), sum(classes.values())
    if not toxic_rows or toxic_rows == all_rows or not sums["t"] or not sums["c"]:
        share = toxic_rows / all_rows if all_rows else 0.0
        return empty._replace(bias=math.log(max(share, 1e-13) / max(1 - share, 1e-13)))
    # log-odds under the prior; only significant tokens leave the executors
    t, c = float(sums["t"]), float(sums["c"])
    prior = PRIOR_FLOOR + PRIOR_SHARE * (F.col("toxic") + F.col("clean"))
    a, b, weight = F.col("toxic") + prior, F.col("clean") + prior, PRIOR_FLOOR * sums["n"] + PRIOR_SHARE * (t + c)
    odds = F.log(a / (t + weight - a)) - F.log(b / (c + weight - b))
    chosen = (
        counts.filter(F.col("toxic") + F.col("clean") >= LEAST_COUNT)
        .select("token", "clean", odds.alias("odds"), (odds / F.sqrt(1 / a + 1 / b)).alias("z"))
        .filter((F.col("z") >= Z) & (F.col("odds") > 0))
        .orderBy("token").collect()  # bounded by the training rows
    )
    keys = np.array([r["token"] for r in chosen], np.int64).view(np.uint64)
    order = np.argsort(keys)
    model = empty._replace(keys=keys[order], odds=np.array([r["odds"] for r in chosen])[order])
    if not len(keys):
        share = toxic_rows / all_rows
        return empty._replace(bias=math.log(share / (1 - share)))
    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free = model._replace(scale=-1e6)  # every segment counts
        for batch in batches:
            found = [x for part in slices(batch.column("text")) for x in evidence(part, free)]
            clean = batch.column("y").to_numpy() != 1
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("y"), pa.array([x.n for x in found], pa.int64()), pa.array([x.best for x in found], pa.float64()),
                    pa.array([[p.score for p in x.passages] for x in found], pa.list_(pa.float64())),
                    pa.array([[p.new for p in x.passages] for x in found], pa.list_(pa.float64())),
                    pa.array([x.counted if c else [] for x, c in zip(found, clean)], pa.list_(pa.float64())),
                ],
                names=["y", "n", "best", "scores", "new", "counted"],
            )

    seen = materialise(train.mapInArrow(best, "y int, n long, best double, scores array<double>, new array<double>, counted array<double>"), "segments")
    # how often each score counts among clean words; a token's score counts half a time more, its word and prefixes as one
    values, mult = np.unique(model.odds, return_counts=True)
    hits = {r["s"]: r["n"] for r in seen.select(F.explode("counted").alias("s")).groupBy("s").agg(F.count(F.lit(1)).alias("n")).collect()}
    all_words = seen.filter("y <> 1").agg(F.sum("n")).first()[0] or 1
    shares = np.array([hits.get(v, 0) for v in values.tolist()]) + 0.5 * mult / (1 + len(PREFIXES))
    model = model._replace(rate=_rate(values, shares / all_words))
    found = seen.drop("counted").collect()  # at most `rows` rows
    clean = [(r["n"], r["best"]) for r in found if r["y"] != 1]
    # P(no segment above s among n words) = exp(-K n exp(-L s)): K by its moment over clean texts
    hit = max(sum(s > 0 for _, s in clean), 1) / max(len(clean), 1)
    words_ = sum(n for n, _ in clean) / max(len(clean), 1)
    model = model._replace(scale=math.log(max(hit, 1 / len(clean)) / max(words_, 1.0) * math.exp(model.rate * _quantile([s for _, s in clean if s > 0]))))
    x = np.array([
        weight_of(r["n"], [(s, w) for s, w in zip(r["scores"], r["new"]) if expectation(s, r["n"], model) < SIGNIFICANT], model) for r in found
    ])
    y = np.array([r["y"] == 1 for r in found], float)
    bias, slope = _logistic(x, y)
    return model._replace(bias=bias, slope=slope)


def _quantile(values: list[float]) -> float:
    return float(np.median(values)) if values else 0.0


def _rate(odds: np.ndarray, shares: np.ndarray) -> float:
    """L > 0 with sum p exp(L s) = 1 over the scores of clean words."""
    def total(rate: float) -> float:
        return float((shares * np.exp(np.minimum(rate * odds, 700))).sum()) + max(0.0, 1 - shares.sum()) * math.exp(-rate * DRIFT) - 1

    low, high = 1e-6, 1.0
    if total(low) >= 0:  # the scores drift upwards even in clean text
        return low
    while total(high) < 0 and high < 64:
        high *= 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if total(mid) < 0 else (low, mid)
    return low


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Bias and slope by Newton steps with a small ridge."""
    w, z = np.zeros(2), np.column_stack([np.ones(len(x)), x])
    ridge = np.diag([1e-3, 1e-1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (y - p) - ridge @ w
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge, grad)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(max(w[1], 0.0))


def scored(docs: DataFrame, model: Model, keep: list[str], inside: str | None = None) -> DataFrame:
    """`keep` columns, score, and passages as (first word, end, score).

    The text is the column of that name, or of the struct column `inside`, which then travels once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(keep.index(inside)).field("text") if inside else batch.column(len(keep))
            for part in slices(texts):
                found = evidence(part, model)
                held = [batch.column(i).slice(part.first, len(found)) for i in range(len(keep))]
                passages = pa.array([[{"first": p.first, "end": p.end, "score": p.score} for p in x.passages] for x in found], kind)
                yield pa.RecordBatch.from_arrays([*held, pa.array([probability(x.n, x.passages, model) for x in found], pa.float64()), passages], names=[*keep, "score", "passages"])

    passage = StructType().add("first", "long").add("end", "long").add("score", "double")
    kind = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
    docs = in_batches(docs)
    chosen = docs.select(*keep) if inside else docs.select(*keep, F.col("text").alias("_text"))
    schema = docs.select(*keep).schema.add("score", "double").add("passages", ArrayType(passage))
    return chosen.mapInArrow(run, schema)


def fold(modulus: int, doc_id: str = "doc_id") -> Column:
    """crc32 of doc_id as text, modulo; null ids fall to fold 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % modulus, F.lit(0))


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs`, with all their columns, that aren't predicted toxic."""
    packed = docs.select(F.struct(*docs.columns).alias("row"))
    return scored(packed, learn(docs, labels, fold(5) != 0), ["row"], "row").filter("score < 0.5").select("row.*")


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, passages."""
    model = learn(docs, labels, fold(5) != 0)
    return scored(docs, model, ["doc_id"]).select(
        "doc_id", (fold(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "passages"
    )
