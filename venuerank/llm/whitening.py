"""Whitening of vectors by the leading components of their covariance.

1. Entries become whole numbers floor(STEPS * c). Each distinct whole-number vector counts once, however
   many rows share it; these are the fit list, stored. Its size n and per-dimension sums S are exact.
2. The covariance is summed from vectors centred by S / n before they are multiplied: each task adds up
   its own d x d sums, and one row per task and dimension meets in the shuffle. Only the d x d result comes
   to the driver, whose size hangs on the dimension and not on the rows.
3. The driver brings it to tridiagonal form by Householder reflections, finds the leading eigenvalues by
   bisection with Sturm counts, and their vectors by inverse iteration; vectors whose eigenvalues lie
   close together are made orthogonal to each other in every step. Extended precision is used throughout.
4. The d x k projection travels with the tasks, and every row is centred, projected and scaled.

Defined results: rows whose vector is null, empty, or holds null or non-finite entries drop out; entries
beyond 2^53 / STEPS are held at that bound; of vectors of several dimensions those of the most
frequent one stay (the larger on ties) and the others drop out; components of no variance, below 1e-12 of
the total, aren't returned, so a table of equal vectors gives no rows, like an empty one; rows that repeat
are all returned; a deviation beyond a 64-bit integer is null; columns other than vec_id and embedding
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venuerank.session import materialise

STEPS = 256
COMPONENTS = 4
LARGEST = float(1 << 53)
LEAST_SHARE = 1e-12
CLOSE = 1e-3  # eigenvalues nearer than this share of the largest form a cluster
BATCH_VALUES = 1 << 20  # entries of a Gram product taken at once


class Fit(NamedTuple):
    n: int
    sums: list[int]          # of each dimension, exact
    values: np.ndarray       # leading eigenvalues, falling
    vectors: np.ndarray      # d x k, unit columns
    trace: float
    identity_error: float    # of the whitened fit list's covariance


def stepped(embedding: Column) -> Column:
    """floor(STEPS * c) of every entry as a long; null where the vector can't take part."""
    wide = F.transform(embedding, lambda c: c.cast("double"))
    fine = F.forall(wide, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    held = lambda c: F.least(F.greatest(F.floor(F.greatest(F.least(c * STEPS, F.lit(LARGEST)), F.lit(-LARGEST))), F.lit(-(1 << 53))), F.lit(1 << 53))
    return F.when(embedding.isNotNull() & (F.size(embedding) > 0) & fine, F.transform(wide, lambda c: held(c).cast("long")))


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, x of the rows that take part, stored."""
    rows = vectors.select("vec_id", stepped(F.col("embedding")).alias("x")).filter("x IS NOT NULL")
    rows = materialise(rows, "whitening-rows")
    kept = rows.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    return rows if kept is None else rows.filter(F.size("x") == kept["d"])


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def covariance(rows: DataFrame, column: str, mean: np.ndarray, n: int, to: np.ndarray | None = None, shift: np.ndarray | None = None) -> np.ndarray:
    """Covariance, divisor n, of the vectors of `column`, centred by `mean`; where given, of their projection by `to`, centred by `shift`."""
    d = len(mean)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, some = None, False
        for batch in batches:
            held = _matrix(batch.column(0), d)
            for at in range(0, len(held), max(1, BATCH_VALUES // d)):
                part = held[at : at + max(1, BATCH_VALUES // d)] - mean
                part = part if to is None else part @ to - shift
                gram = part.T @ part
                total, some = gram if total is None else total + gram, True
        if some:
            index = pa.array(np.arange(len(total)), pa.int32())
            bounds = pa.array(np.arange(len(total) + 1) * len(total), pa.int32())
            yield pa.RecordBatch.from_arrays([index, pa.ListArray.from_arrays(bounds, pa.array(total.ravel()))], names=["i", "part"])

    parts = rows.select(column).mapInArrow(run, "i int, part array<double>")
    found = parts.select("i", F.posexplode("part").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v")).collect()  # d x d rows
    size = d if to is None else to.shape[1]
    out = np.zeros((size, size))
    for r in found:
        out[r["i"], r["j"]] = r["v"] / n
    return (out + out.T) / 2


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(diagonal, off-diagonal, reflectors) of the symmetric matrix under Householder reflections."""
    a = matrix.astype(np.longdouble)
    d = len(a)
    reflectors = []
    for k in range(d - 2):
        x = a[k + 1 :, k].copy()
        norm = np.sqrt((x * x).sum())
        if norm == 0 or np.abs(x[1:]).max(initial=0) == 0:
            reflectors.append(None)
            continue
        x[0] += norm if x[0] >= 0 else -norm
        v = x / np.sqrt((x * x).sum())
        reflectors.append(v)
        # both sides of the trailing block; row and column k become (0, .., -+norm, 0, ..)
        block = a[k + 1 :, k + 1 :]
        p = block @ v
        w = p - v * (v @ p)
        block -= 2 * (np.outer(v, w) + np.outer(w, v))
        a[k + 1 :, k] -= 2 * v * (v @ a[k + 1 :, k])
        a[k, k + 1 :] = a[k + 1 :, k]
    return np.diag(a).copy(), np.diag(a, 1).copy(), reflectors


def count_below(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues of the tridiagonal matrix lie below each of `at`: sign changes of its Sturm sequence."""
    tiny = np.finfo(np.longdouble).tiny * 1e10
    below = np.zeros(len(at), np.int64)
    for i in range(len(diagonal)):
        q = diagonal[i] - at - (off[i - 1] * off[i - 1] / q if i else 0)
        q = np.where(np.abs(q) < tiny, -tiny, q)  # a vanishing term counts as a negative one, here and in the next
        below += q < 0
    return below


def leading_values(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues, falling, by bisection on their Sturm counts."""
    d = len(diagonal)
    reach = np.abs(np.concatenate((off, [0]))) + np.abs(np.concatenate(([0], off)))
    low, high = (diagonal - reach).min(), (diagonal + reach).max()
    margin = np.finfo(np.float64).eps * max(abs(low), abs(high)) + np.finfo(np.float64).tiny
    lows, highs = np.full(k, low - margin, np.longdouble), np.full(k, high + margin, np.longdouble)
    wanted = d - 1 - np.arange(k)  # this many lie below the value looked for
    for _ in range(200):
        middle = (lows + highs) / 2
        if ((middle <= lows) | (middle >= highs)).all():
            break
        above = count_below(diagonal, off, middle) > wanted
        highs, lows = np.where(above, middle, highs), np.where(above, lows, middle)
    return (lows + highs) / 2


def _solve(diagonal: np.ndarray, off: np.ndarray, value, right: np.ndarray) -> np.ndarray:
    """(T - value I)^-1 right by elimination with row exchanges; a vanishing pivot is replaced by a tiny one."""
    d = len(diagonal)
    main, upper, second = diagonal - value, np.append(off, 0).astype(np.longdouble), np.zeros(d, np.longdouble)
    lower, b = np.append(off, 0).astype(np.longdouble), right.astype(np.longdouble).copy()
    small = np.finfo(np.longdouble).eps * max(np.abs(diagonal).max(), np.abs(off).max(initial=0), np.finfo(np.float64).tiny)
    for i in range(d - 1):
        if abs(main[i]) < abs(lower[i]):
            main[i], lower[i] = lower[i], main[i]
            upper[i], main[i + 1] = main[i + 1], upper[i]
            second[i], upper[i + 1] = upper[i + 1], second[i]
            b[i], b[i + 1] = b[i + 1], b[i]
        if abs(main[i]) < small:
            main[i] = small
        factor = lower[i] / main[i]
        main[i + 1] -= factor * upper[i]
        upper[i + 1] -= factor * second[i]
        b[i + 1] -= factor * b[i]
    if abs(main[-1]) < small:
        main[-1] = small
    out = np.zeros(d, np.longdouble)
    for i in range(d - 1, -1, -1):
        rest = b[i] - (upper[i] * out[i + 1] if i + 1 < d else 0) - (second[i] * out[i + 2] if i + 2 < d else 0)
        out[i] = rest / main[i]
    return out


def leading_vectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray, rounds: int = 6) -> np.ndarray:
    """Unit eigenvectors of the tridiagonal matrix by inverse iteration, orthogonal within each cluster of close values."""
    d, scale = len(diagonal), max(np.abs(values).max(initial=0), np.finfo(np.float64).tiny)
    out = np.zeros((d, len(values)), np.longdouble)
    head = 0
    for c in range(len(values)):
        if c and values[c - 1] - values[c] > CLOSE * scale:
            head = c
        # a fixed start with weight in every direction, another one for each vector
        x = 1 + ((np.arange(d) * (2 * c + 7) + 3 * c) % 11).astype(np.longdouble) / 11
        # equal values would give equal vectors; a nudge far below a double's precision tells their solves apart
        value = values[c] + (c - head) * np.finfo(np.longdouble).eps * scale
        for _ in range(rounds):
            for before in range(head, c):
                x -= out[:, before] * (out[:, before] @ x)
            x /= np.sqrt(x @ x)
            x = _solve(diagonal, off, value, x)
            x /= np.abs(x).max()
        for _ in range(2):
            for before in range(head, c):
                x -= out[:, before] * (out[:, before] @ x)
            x /= np.sqrt(x @ x)
        out[:, c] = x
    return out


def leading_components(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, d x k unit eigenvectors) of a symmetric matrix, largest first."""
    # a scale near 1 keeps squares of tiny or huge entries in range
    scale = np.abs(matrix).max(initial=0)
    if not scale:
        return np.zeros(k), np.eye(len(matrix))[:, :k]
    diagonal, off, reflectors = tridiagonal(matrix / scale)
    values = leading_values(diagonal, off, k)
    vectors = leading_vectors(diagonal, off, values)
    for at in range(len(reflectors) - 1, -1, -1):
        v = reflectors[at]
        if v is not None:
            vectors[at + 1 :] -= 2 * np.outer(v, v @ vectors[at + 1 :])
    vectors /= np.sqrt((vectors * vectors).sum(0))
    return (values * scale).astype(np.float64), vectors.astype(np.float64)


def fit(rows: DataFrame, components: int = COMPONENTS) -> Fit | None:
    """Components over the distinct vectors of `rows(x)`; None where there is none of any variance."""
    distinct = materialise(rows.select("x").distinct(), "whitening-fit")
    n = distinct.count()
    if not n:
        return None
    added = distinct.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("s")).collect()
    sums = [int(r["s"]) for r in sorted(added, key=lambda r: r["i"])]
    mean = np.array([s / n for s in sums])
    held = covariance(distinct, "x", mean, n)
    trace = float(np.trace(held))
    if trace <= 0:
        return None
    values, vectors = leading_components(held, min(components, len(sums)))
    real = int((values > LEAST_SHARE * trace).sum())
    values, vectors = values[:real], vectors[:, :real]
    to = vectors / np.sqrt(values)
    left = covariance(distinct, "x", mean, n, to, _whitened_mean(distinct, mean, to, n)) - np.eye(real)
    return Fit(n, sums, values, vectors, trace, float(np.abs(left).max(initial=0)))


def _whitened_mean(rows: DataFrame, mean: np.ndarray, to: np.ndarray, n: int) -> np.ndarray:
    """Mean of the whitened fit list; nothing but what rounding leaves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(to.shape[1])
        for batch in batches:
            total += ((_matrix(batch.column(0), len(mean)) - mean) @ to).sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), pa.array(total)], names=["i", "s"])

    found = rows.select("x").mapInArrow(run, "i int, s double").groupBy("i").agg(F.sum("s").alias("s")).collect()
    return np.array([r["s"] for r in sorted(found, key=lambda r: r["i"])]) / n


def apply(rows: DataFrame, fitted: Fit) -> DataFrame:
    """A row for each of `rows(vec_id, x)` and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    d, n = len(fitted.sums), fitted.n
    mean, to = np.array([s / n for s in fitted.sums]), fitted.vectors / np.sqrt(fitted.values)
    k = to.shape[1]
    explained = fitted.values / fitted.trace
    sums, safe = fitted.sums, all(abs(s) < 1 << 62 for s in fitted.sums)

    def deviations(x: np.ndarray) -> list[int | None]:
        most = float(np.abs(x).max(initial=0)) * n + max(map(abs, sums))
        if safe and most * most * d < 2.0**62:
            off = x * n - np.array(sums, np.int64)
            return (off * off).sum(1).tolist()
        exact = [sum((n * v - s) ** 2 for v, s in zip(row, sums)) for row in x.tolist()]
        return [v if v < 1 << 63 else None for v in exact]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("x"), d)
            index = np.repeat(np.arange(len(x)), k)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(pa.array(index)), pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()),
                    pa.array(np.full(len(index), n)), pa.array(deviations(x), pa.int64()).take(pa.array(index)),
                    pa.array(((x - mean) @ to).ravel()), pa.array(np.tile(explained, len(x))), pa.array(np.full(len(index), fitted.identity_error)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    kind = dict(rows.dtypes)["vec_id"]
    return rows.select("vec_id", "x").mapInArrow(
        run, f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    )


def whitened(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Fit on all distinct vectors of `vectors(vec_id, embedding)`, and every usable row whitened."""
    rows = usable(vectors)
    fitted = fit(rows, components)
    if fitted is None:  # nothing varies; the same columns without rows
        d = rows.limit(0)
        return apply(d, Fit(1, [0], np.ones(1), np.ones((1, 1)), 1.0, 0.0))
    return apply(rows, fitted)
