"""Words of many texts at once, as numpy arrays over the UTF-8 bytes of an Arrow column."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

BATCH_ROWS = 1000
SLICE_BYTES = 1 << 20  # texts are worked on in slices of about this many bytes; one longer text makes its own

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def in_batches(df: DataFrame) -> DataFrame:
    """The same rows; Python tasks of its session take them BATCH_ROWS at a time, which bounds a worker's memory."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every input bit moves every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def seeds(n: int, start: int) -> np.ndarray:
    """`n` fixed pseudo-random 64-bit numbers."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(start))


_TABLE = seeds(256, 11)
_BASE = int(seeds(1, 23)[0]) | 1
_powers: dict[str, np.ndarray] = {}


def _power(name: str, base: int, n: int) -> np.ndarray:
    held = _powers.get(name)
    if held is None or len(held) < n:
        factors = np.full(max(n, SLICE_BYTES), base, np.uint64)
        factors[0] = 1
        _powers[name] = held = np.cumprod(factors)
    return held


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """H with H[j] - H[i] standing for data[i:j]; see `span_hash`."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_TABLE[data] * _power("up", _BASE, len(data))[: len(data)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span; equal bytes give equal hashes wherever they stand."""
    down = _power("down", pow(_BASE, -1, 1 << 64), len(prefix))
    return mix((prefix[ends] - prefix[starts]) * down[starts] + (ends - starts).astype(np.uint64))


class Texts(NamedTuple):
    first: int  # row of the column where the slice starts
    data: np.ndarray  # bytes of all texts of the slice
    bounds: np.ndarray  # text i is data[bounds[i]:bounds[i + 1]]


def slices(column: pa.Array | pa.ChunkedArray, most: int = SLICE_BYTES) -> Iterator[Texts]:
    """The column cut into runs of texts of about `most` bytes; null counts as empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    bounds = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    held = column.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None and held.size else np.empty(0, np.uint8)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + most, "right")) - 1)
        yield Texts(at, data[bounds[at] : bounds[to]], bounds[at : to + 1] - bounds[at])
        at = to


class Words(NamedTuple):
    starts: np.ndarray
    ends: np.ndarray
    cuts: np.ndarray  # words of text i are cuts[i]:cuts[i + 1]
    hashes: np.ndarray


def words(texts: Texts, lower: bool = True) -> Words:
    """Runs of bytes other than [\\x20\\x09-\\x0D], with A-Z lower-cased for the hash on demand."""
    data, bounds = texts.data, texts.bounds
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = ~_SPACE[data]
    begins = inside[:-1].copy()
    begins[1:] &= ~inside[:-2]
    edges = bounds[:-1][bounds[:-1] < len(data)]
    begins[edges] = inside[edges]  # a text begins anew whatever stood before it
    finishes = inside[:-1] & ~inside[1:]
    last = bounds[1:][bounds[1:] > 0] - 1
    finishes[last] = inside[last]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(finishes) + 1
    prefix = prefix_hash(_LOWER[data] if lower else data)
    return Words(starts, ends, np.searchsorted(starts, bounds), span_hash(prefix, starts, ends))
