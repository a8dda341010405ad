"""Token sequences of a fixed length by hierarchical residual packing.

Documents become token ids of a public tokenizer plus an end id; only those longer than a
sequence are cut. Partitions of about PIECES_PER_TASK pieces are packed by best fit, longest first, and
the nearly full bins are emitted. The others become items themselves: the bins of several partitions
meet in one task and are packed again, up to the root of this tree. A task takes at most BINS_PER_TASK
bins, so no task grows with the input even where nothing fits together; where that leaves more than one
task at the top, rounds go on until one saves fewer bins than it has tasks. Every level is stored
in the shared folder.

Ids come from `bpe`, which gives those of the tokenizer itself.

Defined results: a null or empty text is its end id alone; ties in length keep the order of the
rows; repeated rows are packed like any others; an empty table gives no rows; columns other than
doc_id and text are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from venuerank.llm import bpe
from venuerank.llm.text import in_batches, slices
from venuerank.session import materialise

CAPACITY = 4096
END_ID = 1
NEARLY_FULL = 0.995  # share of the capacity from which a bin is emitted
FAN_IN = 8
PIECES_PER_TASK = 50_000
BINS_PER_TASK = 100_000
SLICE_BYTES = 1 << 20

_MEMBER = "doc_id: bigint, piece: int, start: bigint, length: bigint, ids_crc32: bigint, offset: bigint"
_BINS = f"used long, members array<struct<{_MEMBER}>>"
_FIELDS = ["doc_id", "piece", "start", "length", "ids_crc32"]


def _with_ends(ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same with END_ID behind the ids of each document."""
    n = np.arange(len(bounds) - 1)
    out = np.full(len(ids) + len(n), END_ID, np.uint32)
    out[np.arange(len(ids)) + np.repeat(n, np.diff(bounds))] = ids
    return out, bounds + np.arange(len(bounds))


def cut_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every document's pieces, stored."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bpe.loaded(tokenizer)
        for batch in batches:
            doc_ids = batch.column("doc_id")
            for part in slices(batch.column("text"), SLICE_BYTES):
                ids, bounds = _with_ends(*encoder.encode(part))
                counts = -(-np.diff(bounds) // capacity)
                row = np.repeat(np.arange(len(counts)), counts)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
                start = piece * capacity
                length = np.minimum(np.diff(bounds)[row] - start, capacity)
                raw = memoryview(ids.astype("<u4").tobytes())
                begin = bounds[row] + start
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(begin.tolist(), (begin + length).tolist())]
                yield pa.RecordBatch.from_arrays(
                    [doc_ids.take(pa.array(row + part.first)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                    names=_FIELDS,
                )

    found = in_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return materialise(found.mapInArrow(pieces, "doc_id long, piece int, start long, length long, ids_crc32 long"), "packing-pieces")


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each item: longest first, each into the fullest bin that still takes it."""
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    room: list[list[int]] = [[] for _ in range(capacity + 1)]  # bins by the room they have
    open_ = 0  # bit r is set while some bin has room r
    made = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        fits = open_ >> need
        if fits:
            had = need + (fits & -fits).bit_length() - 1
            chosen = room[had].pop()
            if not room[had]:
                open_ &= ~(1 << had)
        else:
            had, chosen, made = capacity, made, made + 1
        bins[i], offsets[i] = chosen, capacity - had
        left = had - need
        if left:
            room[left].append(chosen)
            open_ |= 1 << left
    return bins, offsets


def _gather(items: pa.Table, capacity: int) -> pa.RecordBatch | None:
    """Pack a task's items, each with its members, into bins with theirs."""
    used = items.column("used").to_numpy().astype(np.int64)
    if not len(used):
        return None
    lists = items.column("members").combine_chunks()
    bounds, flat = lists.offsets.to_numpy().astype(np.int64), lists.values
    bins, base = best_fit(used, capacity)
    order = np.lexsort((base, bins))
    sizes = np.diff(bounds)[order]
    inner = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    members = flat.take(pa.array(np.repeat(bounds[:-1][order], sizes) + inner))
    columns = {name: members.field(name) for name in _FIELDS}
    columns["offset"] = pa.array(members.field("offset").to_numpy() + np.repeat(base[order], sizes))
    per_bin = np.bincount(bins[order], weights=sizes).astype(np.int64)
    members = pa.StructArray.from_arrays(list(columns.values()), names=list(columns))
    offsets = pa.array(np.concatenate(([0], np.cumsum(per_bin))), pa.int32())
    total = np.bincount(bins, weights=used).astype(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(total), pa.ListArray.from_arrays(offsets, members)], names=["used", "members"])


def pack(pieces: DataFrame, capacity: int = CAPACITY, nearly_full: float = NEARLY_FULL) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""

    def level(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            held.append(batch)
            rows += len(batch)
            if rows >= BINS_PER_TASK:  # a larger partition is packed in parts
                yield _gather(pa.Table.from_batches(held), capacity)
                held, rows = [], 0
        if rows:
            yield _gather(pa.Table.from_batches(held), capacity)

    member = F.struct("doc_id", "piece", "start", "length", "ids_crc32", F.lit(0).cast("long").alias("offset"))
    items = pieces.select(F.col("length").alias("used"), F.array(member).alias("members"))
    items = items.coalesce(max(1, pieces.count() // PIECES_PER_TASK))
    full, sealed, before, tasks = int(capacity * nearly_full), None, None, None
    while True:
        bins = materialise(items.mapInArrow(level, _BINS), "packing-bins")
        done = bins.filter(F.col("used") >= full)
        sealed = done if sealed is None else sealed.unionByName(done)
        rest = bins.filter(F.col("used") < full)
        left = rest.count()
        parts = rest.select(F.spark_partition_id()).distinct().count() if tasks is None else tasks
        at_top = tasks is not None and tasks <= -(-before // BINS_PER_TASK)
        if not left or (parts == 1 and left <= BINS_PER_TASK) or (at_top and before - left < tasks):
            sealed = sealed.unionByName(rest)
            break
        tasks, before = max(-(-parts // FAN_IN), -(-left // BINS_PER_TASK)), left
        items = rest.repartition(tasks)
    numbered = materialise(sealed.withColumn("sequence_id", F.monotonically_increasing_id()), "packing-sequences")
    return numbered.select("sequence_id", F.explode("members").alias("m")).select(
        *[f"m.{name}" for name in _FIELDS], "sequence_id", "m.offset"
    )


def packed(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    return pack(cut_pieces(docs, tokenizer, capacity), capacity)
