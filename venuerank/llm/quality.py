"""Document quality by a byte-level convolutional network in numpy.

Bytes are embedded, filters of WIDTH bytes run over a text at every STRIDE-th byte, and their
responses are max-pooled within chunks of CHUNK bytes that overlap by half and cover the whole text.
A layer of hidden units looks at each chunk's pooled responses, so it can see which patterns a
chunk has and which it lacks; their maxima over all chunks, of the units and of the filters
themselves, are combined into one probability. All layers are learnt together, by gradient steps
through the pooled maxima.

The network is learnt from at most TRAIN_ROWS labelled rows, the first by a hash of doc_id, and of
these from whole texts of at most TRAIN_BYTES bytes together: in the same order, a text that doesn't
fit the bytes left is passed over and the next ones are still taken. Equal rows are learnt once.
If no text of a class fits, learning fails with a ValueError. Scores read the text alone, all of it.

Defined results: null and empty texts, and texts shorter than a filter, are filled up with zero
bytes and scored like any other; rows without a label are scored but never learnt from; with
no labels or one class only, every score is the share of label 1 (0.5 without any); an empty table
gives no rows; columns other than those named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venuerank.llm.text import Texts, in_batches, slices
from venuerank.llm.toxicity import fold, training_rows

TRAIN_ROWS = 4000
TRAIN_BYTES = 12_000_000
STEPS = 800  # gradient steps, however many rows there are
BATCH = 32
RATE = 0.01
EMBED = 8
WIDTH = 8
STRIDE = 2
FILTERS = 24
HIDDEN = 16
CHUNK = 256  # bytes; chunks start every half of it
SLICE_BYTES = 1 << 18


class Network(NamedTuple):
    embed: np.ndarray  # 256 x EMBED
    filters: np.ndarray  # WIDTH * EMBED x FILTERS
    shift: np.ndarray  # FILTERS
    units: np.ndarray  # FILTERS x HIDDEN
    lift: np.ndarray  # HIDDEN
    out: np.ndarray  # HIDDEN + FILTERS
    bias: np.ndarray  # 1


def fresh() -> Network:
    draw = np.random.default_rng(7)
    normal = lambda *shape: draw.normal(size=shape).astype(np.float32)
    return Network(
        normal(256, EMBED) * 0.5, normal(WIDTH * EMBED, FILTERS) * (0.5 / np.sqrt(WIDTH)), np.zeros(FILTERS, np.float32),
        normal(FILTERS, HIDDEN) * 0.3, np.zeros(HIDDEN, np.float32), normal(HIDDEN + FILTERS) * 0.1, np.zeros(1, np.float32),
    )


class Pooled(NamedTuple):
    codes: np.ndarray  # bytes, each text filled up to whole half chunks and one of zeros
    halves: np.ndarray  # half chunks before each text
    best: np.ndarray  # filter responses per chunk
    at: np.ndarray  # their places in codes
    first: np.ndarray  # first chunk of each text


def _lay_out(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Bytes with each text filled up with zeros to half chunks, two at least, and the half chunks before each.

    A half chunk of zeros follows each text, so that windows that reach over its end find no other text there.
    """
    half = CHUNK // 2
    sizes = np.diff(texts.bounds)
    halves = np.maximum(2, -(-sizes // half))
    before = np.concatenate(([0], np.cumsum(halves + 1)))
    codes = np.zeros(int(before[-1]) * half + WIDTH, np.uint8)
    place = np.arange(len(texts.data)) + np.repeat(before[:-1] * half - texts.bounds[:-1], sizes)
    codes[place] = texts.data
    return codes, before


def _respond(net: Network, codes: np.ndarray, start: int, end: int) -> np.ndarray:
    """Filter responses at every STRIDE-th place of codes[start:end]."""
    embedded = net.embed[codes[start : end + WIDTH - STRIDE]]
    count = (end - start) // STRIDE
    windows = np.lib.stride_tricks.as_strided(
        embedded, (count, WIDTH * EMBED), (embedded.strides[0] * STRIDE, embedded.strides[1]), writeable=False
    )
    return np.ascontiguousarray(windows) @ net.filters


def pool(net: Network, texts: Texts, places: bool) -> Pooled:
    """Chunk maxima of the filter responses; chunks are pairs of neighbouring half chunks of a text."""
    codes, before = _lay_out(texts)
    half, steps = CHUNK // 2, CHUNK // 2 // STRIDE
    total = int(before[-1])
    tops, spots = np.empty((total, FILTERS), np.float32), np.empty((total, FILTERS), np.int64) if places else np.empty((0, 0), np.int64)
    block = 512
    for a in range(0, total, block):
        b = min(total, a + block)
        got = _respond(net, codes, a * half, b * half).reshape(b - a, steps, FILTERS)
        if places:
            where = got.argmax(1)
            spots[a:b] = np.arange(a, b)[:, None] * half + where * STRIDE
            tops[a:b] = np.take_along_axis(got, where[:, None, :], 1)[:, 0]
        else:
            tops[a:b] = got.max(1)
    # a chunk is a half and the next one of the same text
    left = np.ones(total, bool)
    left[before[1:] - 1] = left[before[1:] - 2] = False
    i = np.flatnonzero(left)
    best = np.maximum(tops[i], tops[i + 1])
    at = np.where(tops[i] >= tops[i + 1], spots[i], spots[i + 1]) if places else spots
    return Pooled(codes, before, np.maximum(best + net.shift, 0), at, before[:-1] - 2 * np.arange(len(before) - 1))


def combine(net: Network, pooled: Pooled) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(probabilities, maxima per text, hidden units per chunk)."""
    hidden = np.maximum(pooled.best @ net.units + net.lift, 0)
    both = np.concatenate([hidden, pooled.best], 1)
    top = np.maximum.reduceat(both, pooled.first)
    return 1 / (1 + np.exp(-np.clip(top @ net.out + net.bias[0], -30, 30))), top, both


def predict(net: Network, texts: Texts) -> np.ndarray:
    return combine(net, pool(net, texts, False))[0]


def _gradients(net: Network, texts: Texts, y: np.ndarray, weight: np.ndarray) -> Network:
    pooled = pool(net, texts, True)
    p, top, both = combine(net, pooled)
    error = ((p - y) * weight / len(y)).astype(np.float32)
    d_out, d_bias = top.T @ error, np.array([error.sum()], np.float32)
    d_top = error[:, None] * net.out
    # the chunk that holds each maximum
    edges = np.append(pooled.first, len(both))
    chunk = np.stack([a + both[a:b].argmax(0) for a, b in zip(edges[:-1], edges[1:])])
    d_best = np.zeros_like(pooled.best)
    d_hidden = np.zeros((len(both), HIDDEN), np.float32)
    live = top > 0
    np.add.at(d_hidden, (chunk[:, :HIDDEN], np.arange(HIDDEN)), np.where(live[:, :HIDDEN], d_top[:, :HIDDEN], 0))
    np.add.at(d_best, (chunk[:, HIDDEN:], np.arange(FILTERS)), np.where(live[:, HIDDEN:], d_top[:, HIDDEN:], 0))
    used = np.flatnonzero(d_hidden.any(1))
    d_units, d_lift = pooled.best[used].T @ d_hidden[used], d_hidden[used].sum(0)
    d_best[used] += d_hidden[used] @ net.units.T
    d_best *= pooled.best > 0
    row, column = np.nonzero(d_best)
    value = d_best[row, column]
    codes = pooled.codes[pooled.at[row, column][:, None] + np.arange(WIDTH)]
    seen = net.embed[codes].reshape(len(row), -1)
    order = np.argsort(column, kind="stable")
    d_filters = np.zeros_like(net.filters)
    cuts = np.searchsorted(column[order], np.arange(FILTERS + 1))
    for f in range(FILTERS):
        mine = order[cuts[f] : cuts[f + 1]]
        d_filters[:, f] = value[mine] @ seen[mine]
    d_shift = np.bincount(column, weights=value, minlength=FILTERS).astype(np.float32)
    spread = (value[:, None] * net.filters.T[column]).reshape(-1, EMBED)
    d_embed = np.stack([np.bincount(codes.ravel(), weights=spread[:, e], minlength=256) for e in range(EMBED)], 1).astype(np.float32)
    return Network(d_embed, d_filters, d_shift, d_units, d_lift, d_out, d_bias)


def fit(texts: list[str], labels: np.ndarray, steps: int = STEPS) -> Network:
    """Adam over shuffled batches; texts of a batch have like lengths, so that no batch is much larger than others."""
    net = fresh()
    draw = np.random.default_rng(5)
    y = labels.astype(np.float32)
    share = float(y.mean())
    order = np.argsort([len(t) for t in texts], kind="stable")
    batches = [order[i : i + BATCH] for i in range(0, len(order), BATCH)]
    mean, square, step = [np.zeros_like(w) for w in net], [np.zeros_like(w) for w in net], 0
    while step < steps:
        for k in draw.permutation(len(batches)):
            rows, rate = batches[k], RATE * max(0.0, 1 - step / steps)
            part = next(slices(pa.array([texts[i] for i in rows]), 1 << 60))
            # the rarer class counts half of the way to an equal share
            weight = np.where(y[rows] == 1, 1.0, np.sqrt(share / (1 - share))).astype(np.float32)
            step += 1
            new = []
            for i, (w, g) in enumerate(zip(net, _gradients(net, part, y[rows], weight))):
                mean[i] = 0.9 * mean[i] + 0.1 * g
                square[i] = 0.999 * square[i] + 0.001 * g * g
                new.append((w - rate * (mean[i] / (1 - 0.9**step)) / (np.sqrt(square[i] / (1 - 0.999**step)) + 1e-8)).astype(np.float32))
            net = Network(*new)
    return net


def constant(share: float) -> Network:
    """A network whose every score is `share`."""
    share = min(max(share, 1e-6), 1 - 1e-6)
    return Network(*[np.zeros_like(w) for w in fresh()[:-1]], np.array([np.log(share / (1 - share))], np.float32))


def fitting(sizes: list[int], most_bytes: int, order: Iterable[int]) -> list[int]:
    """The rows, taken in `order`, that fit the bytes left; one that doesn't is passed over."""
    taken, left = [], most_bytes
    for i in order:
        if sizes[i] <= left:
            taken.append(i)
            left -= sizes[i]
    return taken


def within(sizes: list[int], labels: list[int], most_bytes: int) -> list[int]:
    """Rows of at most `most_bytes` together, of every class there is; ValueError where no such rows exist."""
    taken = fitting(sizes, most_bytes, range(len(sizes)))
    if {labels[i] for i in taken} != set(labels):
        # the shortest text of each class comes first
        first = [min((i for i in range(len(sizes)) if labels[i] == y), key=lambda i: sizes[i]) for y in sorted(set(labels))]
        taken = fitting(sizes, most_bytes, [*first, *(i for i in range(len(sizes)) if i not in first)])
        lost = set(labels) - {labels[i] for i in taken}
        if lost:
            raise ValueError(f"no labelled text of class {sorted(lost)} fits the {most_bytes} bytes to learn from")
    return taken


def learn(docs: DataFrame, labels: DataFrame, trained: Column, rows: int = TRAIN_ROWS, most_bytes: int = TRAIN_BYTES) -> Network:
    # rows are within the bound already; their bytes are bounded by passing over whole texts, before any text travels
    held = training_rows(docs, labels, "quality", trained, rows).withColumn("y", (F.col("y") == 1).cast("int")).withColumn("h", F.xxhash64("text"))
    key = ["doc_id", "h", "y"]
    sizes = held.groupBy(*key).agg(F.coalesce(F.max(F.octet_length("text")), F.lit(0)).alias("size")).orderBy(F.xxhash64("doc_id"), *key).collect()
    classes = {r["y"] for r in sizes}
    if len(classes) < 2:
        return constant(float(classes.pop()) if classes else 0.5)
    chosen = [sizes[i] for i in within([r["size"] for r in sizes], [r["y"] for r in sizes], most_bytes)]
    wanted = docs.sparkSession.createDataFrame([tuple(r[c] for c in key) for r in chosen], held.select(*key).schema)
    found = held.join(F.broadcast(wanted), key).dropDuplicates(key).orderBy(F.xxhash64("doc_id"), *key).select("text", "y").collect()
    return fit([r["text"] or "" for r in found], np.array([r["y"] for r in found], float))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    net = learn(docs, labels, fold(4) != 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column("text"), SLICE_BYTES):
                n = len(part.bounds) - 1
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(part.first, n), pa.array(predict(net, part).astype(np.float64))], names=["doc_id", "score"])

    chosen = in_batches(docs).select("doc_id", "text")
    found = chosen.mapInArrow(run, docs.select("doc_id").schema.add("score", "double"))
    return found.select("doc_id", (fold(4) == 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
