"""Removal of every byte covered by a string of `need` bytes that also starts somewhere else.

1. Anchors. Of the windows of some bytes that start within a string of `need` bytes, the one of the
   smallest hash, leftmost on ties, is its anchor. That depends on the string alone, so equal
   strings have equal anchors, and only about one position in a hundred is one. An anchor's run
   is the strings it stands for: those starting at a stretch of neighbouring positions.
2. Runs whose anchor occurs once hold no repeat. Runs that are equal as a whole, twice or more,
   repeat throughout. What is left are runs of one anchor that differ somewhere: the edges of
   repeated passages. They are cut into ranges of RANGE starts, and the same two questions decide
   most ranges: is the part common to all their strings shared, is the range as a whole?
3. The ranges that remain share the middle and differ in a few bytes around it. In each task these
   leaves, the middle written as one symbol of its own, form one text, whose suffix array is built
   by linear grouping (`suffix_array`). A string is repeated exactly if the suffix that starts with it
   has a neighbour that agrees in RANGE symbols. A middle shared by more than LEAF_ROWS leaves
   would make one long text in one task: there the strings themselves are counted, with
   map-side sums, which decides the same question for a group of any size.

Runs and middles are told apart by two independent 64-bit hashes. Nothing of a document but its
anchors, and the few bytes of the leaves, is moved; documents are read in place, and shuffled once for
the edges and once for the result.

Passages. A repeated passage of prose can be shorter than `need`: 51 words take some 310 bytes, seldom 400.
`with_passages` looks for strings of PASSAGE_BYTES first. A stretch they cover is a passage if it
holds more than PASSAGE_WORDS whole words. A repeated string of `need` bytes lies wholly within such a
stretch, here and elsewhere, so the search for these then goes over the stretches of at least `need` bytes
alone. `without_passages` removes passages, and stretches of at least NEED bytes whatever their words.

Defined results: a null text is empty; documents shorter than `need` never change; rows that repeat
doc_id and text are separate documents that repeat each other; strings are bytes, so a cut may
fall inside a character, and `text` drops the parts of one; an empty table gives no rows; columns
other than doc_id and text are ignored, unless asked to be kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from venuerank.llm.suffix_array import suffix_array
from venuerank.llm.text import Texts, in_batches, mix, prefix_hash, seeds, slices, span_hash
from venuerank.session import discard, materialise

NEED = 400
PASSAGE_BYTES = 224  # 51 words are shorter in less than one case of a hundred
PASSAGE_ANCHOR = 64
PASSAGE_WORDS = 50
RANGE = 8
LEAF_ROWS = 256
TASK_SYMBOLS = 40_000
_NO_ID = -(2**63)  # stands for a null doc_id while documents are joined to their spans
_PLACE = np.uint64(0xFFFFFFFF)
_SALT = seeds(3, 71)

_RUNS = "anchor long, run long, doc_id long, digest long, at int, first int, last int"
_ITEMS = "middle long, whole long, doc_id long, digest long, first int, last int, alone boolean, before binary, after binary"
_SPANS = "doc_id long, digest long, first int, last int"


def runs(texts: Texts, need: int, size: int) -> tuple[np.ndarray, ...]:
    """(text, anchor hash, run hash, anchor, first start, last start) of every run, places within the text.

    Anchors are windows of `size` bytes.
    """
    data, bounds = texts.data, texts.bounds
    spread = need - size + 1  # anchors a string can have
    none = np.empty(0, np.int64)
    if len(data) < need:
        return none, none, none, none, none, none
    prefix = prefix_hash(data)
    starts = np.arange(len(data) - size + 1)
    hashes = span_hash(prefix, starts, starts + size)
    # smallest (hash, place) over each stretch of `spread` starts, by doubling
    least = (hashes & ~_PLACE) | starts.astype(np.uint64)
    width = 1
    while width < spread:
        step = min(width, spread - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    begin = np.arange(len(least))
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[: len(least)]
    whole = begin + need <= bounds[text + 1]
    begin, text, anchor = begin[whole], text[whole], (least[whole] & _PLACE).astype(np.int64)
    if not len(begin):
        return none, none, none, none, none, none
    new = np.append(True, (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1]))
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(begin)) - 1
    text, anchor, first, last = text[heads], anchor[heads], begin[heads], begin[tails]
    # equal runs have equal bytes and the anchor at the same place
    run = mix(span_hash(prefix, first, last + need) ^ (anchor - first).astype(np.uint64) ^ _SALT[0])
    base = bounds[text]
    return text, hashes[anchor].view(np.int64), run.view(np.int64), anchor - base, first - base, last - base


def _find_runs(need: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column("text")):
                text, *columns = runs(part, need, size)
                rows = pa.array(text + part.first)
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
                made = [pa.array(c, k) for c, k in zip(columns, kinds)]
                yield pa.RecordBatch.from_arrays(
                    [*made[:2], batch.column("doc_id").take(rows), batch.column("digest").take(rows), *made[2:]],
                    names=["anchor", "run", "doc_id", "digest", "at", "first", "last"],
                )

    return run


def _cut_ranges(need: int):
    """Items of each edge run of a document: ranges of RANGE starts on a grid fixed to the anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            edges = batch.column("edges")
            counts = edges.value_lengths().to_numpy()
            flat = edges.flatten()
            at, first, last = (flat.field(c).to_numpy().astype(np.int64) for c in ("at", "first", "last"))
            anchor = flat.field("anchor").to_numpy().view(np.uint64)
            alone = flat.field("alone").to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(batch)), counts)
            for part in slices(batch.column("text")):
                mine = np.flatnonzero((row >= part.first) & (row < part.first + len(part.bounds) - 1))
                if not len(mine):
                    continue
                # offsets of starts from the anchor, moved above 0
                lift = -(-need // RANGE) * RANGE
                low, high = (first - at)[mine] + lift, (last - at)[mine] + lift
                pieces = high // RANGE - low // RANGE + 1
                of = np.repeat(np.arange(len(mine)), pieces)
                cell = np.repeat(low // RANGE, pieces) + np.arange(len(of)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                begin, final = np.maximum(cell * RANGE, low[of]), np.minimum(cell * RANGE + RANGE - 1, high[of])
                base = part.bounds[row[mine] - part.first][of] + at[mine][of] - lift
                prefix = prefix_hash(part.data)
                a, b = base + cell * RANGE + RANGE - 1, base + cell * RANGE + need  # the middle
                key = anchor[mine][of] + cell.astype(np.uint64) * _SALT[1]
                middle = mix(key ^ span_hash(prefix, a, b))
                whole = mix(key ^ span_hash(prefix, base + begin, base + final + need) ^ mix(begin.astype(np.uint64) ^ _SALT[2]))
                raw = part.data.tobytes()
                before = [raw[x:y] for x, y in zip((base + begin).tolist(), a.tolist())]
                after = [raw[x:y] for x, y in zip(b.tolist(), (base + final + need).tolist())]
                rows = pa.array(row[mine][of])
                start = at[mine][of] - lift
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(middle.view(np.int64)), pa.array(whole.view(np.int64)), batch.column("doc_id").take(rows), batch.column("digest").take(rows),
                        pa.array(start + begin, pa.int32()), pa.array(start + final, pa.int32()), pa.array(alone[mine][of]),
                        pa.array(before, pa.binary()), pa.array(after, pa.binary()),
                    ],
                    names=["middle", "whole", "doc_id", "digest", "first", "last", "alone", "before", "after"],
                )

    return run


def repeated_starts(middles: np.ndarray, before: list[bytes], after: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(leaf, place of a start within it) of every string that starts in two leaves of one middle.

    Each string is RANGE symbols long: some bytes, the middle's symbol, some bytes.
    """
    _, symbol = np.unique(middles, return_inverse=True)
    left, right = np.array([len(x) for x in before]), np.array([len(x) for x in after])
    sizes = left + right + 2  # a symbol for the middle, and one that ends the leaf
    begins = np.cumsum(sizes) - sizes
    text = np.empty(int(sizes.sum()), np.int64)
    inner = np.arange(len(text)) - np.repeat(begins, sizes)
    leaf = np.repeat(np.arange(len(sizes)), sizes)
    bytes_ = np.ones(len(text), bool)
    bytes_[begins + left] = bytes_[begins + sizes - 1] = False
    text[bytes_] = np.frombuffer(b"".join(x for pair in zip(before, after) for x in pair), np.uint8) + 1
    text[begins + left] = 258 + symbol
    text[begins + sizes - 1] = 257
    order = suffix_array(text)
    padded = np.append(text, np.zeros(RANGE, np.int64))
    same = np.ones(len(order) - 1, bool)
    for k in range(RANGE):
        same &= padded[order[1:] + k] == padded[order[:-1] + k]
    hit = np.zeros(len(order) + 1, bool)
    hit[1:-1] = same
    found = np.sort(order[hit[1:] | hit[:-1]])
    # strings start at the middle or up to RANGE - 1 bytes before it, and end within the leaf
    there = (inner[found] <= left[leaf[found]]) & (inner[found] + RANGE < sizes[leaf[found]])
    found = found[there]
    return leaf[found], inner[found]


def _order_leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Leaves come sorted by middle; whole middles are joined to texts of about TASK_SYMBOLS."""

    def spans(leaves: pa.Table) -> pa.RecordBatch:
        of, inner = repeated_starts(leaves.column("middle").to_numpy(), leaves.column("before").to_pylist(), leaves.column("after").to_pylist())
        wanted = leaves.column("alone").to_numpy()[of]
        rows = pa.array(of[wanted])
        start = pa.array(leaves.column("first").to_numpy()[of[wanted]] + inner[wanted], pa.int32())
        ids = [leaves.column(c).take(rows).combine_chunks() for c in ("doc_id", "digest")]
        return pa.RecordBatch.from_arrays([*ids, start, start], names=["doc_id", "digest", "first", "last"])

    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        leaves = pa.Table.from_batches(held)
        middles = leaves.column("middle").to_numpy()
        changes = np.flatnonzero(middles[1:] != middles[:-1]) + 1
        at, most = 0, TASK_SYMBOLS // (2 * RANGE)
        while len(changes) and changes[-1] - at >= most:
            to = int(changes[np.searchsorted(changes, at + most)]) if changes[-1] > at + most else int(changes[-1])
            yield spans(leaves.slice(at, to - at))
            at = to
        held = leaves.slice(at).to_batches()
    if sum(map(len, held)):
        yield spans(pa.Table.from_batches(held))


def _same_doc(docs: DataFrame, other: DataFrame) -> Column:
    return (docs["doc_id"] == other["o_id"]) & (docs["digest"] == other["o_digest"])


def repeated_spans(docs: DataFrame, need: int = NEED, anchor: int | None = None) -> DataFrame:
    """(doc_id, digest, first, last): starts first..last of strings that occur elsewhere too.

    `docs` has doc_id, text and digest, a hash of the text that tells apart rows of one doc_id. Anchors
    take `anchor` bytes, half a string unless given.
    """
    if need < 2 * RANGE:
        raise ValueError(f"strings below {2 * RANGE} bytes aren't searched for")
    found = materialise(docs.mapInArrow(_find_runs(need, anchor or need // 2), _RUNS), "suffix-runs")
    # an anchor's runs: how many, and whether they are all equal
    anchors = (
        found.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.min("run").alias("low"), F.max("run").alias("high"))
        .filter("n > 1").select("anchor", (F.col("low") == F.col("high")).alias("uniform"))
    )
    # stored, so that the join is of two plain shuffles and a hot anchor can be split
    anchors = materialise(anchors, "suffix-anchors")
    shared = materialise(found.join(anchors, "anchor"), "suffix-shared")
    discard(found, anchors)
    mixed = shared.filter("NOT uniform")
    place = F.struct("doc_id", "digest", "at", "first", "last")
    classes = materialise(mixed.groupBy("anchor", "run").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("rep")), "suffix-classes")
    columns = ["doc_id", "digest", "first", "last"]
    twice = materialise(classes.filter("n > 1").select("anchor", "run"), "suffix-twice")
    spans = [materialise(shared.filter("uniform").select(*columns).unionByName(mixed.join(twice, ["anchor", "run"]).select(*columns)), "suffix-runs-repeated")]
    discard(shared, twice)

    # one run of each kind goes on, to be compared with the others of its anchor
    edge = F.struct("anchor", F.col("rep.at").alias("at"), F.col("rep.first").alias("first"), F.col("rep.last").alias("last"), (F.col("n") == 1).alias("alone"))
    per_doc = classes.groupBy(F.col("rep.doc_id").alias("o_id"), F.col("rep.digest").alias("o_digest")).agg(F.collect_list(edge).alias("edges"))
    per_doc = materialise(per_doc, "suffix-edges")  # a document's own runs, no more than its bytes
    met = docs.join(per_doc, _same_doc(docs, per_doc)).select("doc_id", "digest", "text", "edges")
    # rows that repeat a document cut the same items again, but none of their runs is alone
    items = materialise(met.mapInArrow(_cut_ranges(need), _ITEMS), "suffix-items")
    discard(classes, per_doc)

    held = F.struct("doc_id", "digest", "first", "last", "alone", "before", "after")
    kinds = items.groupBy("middle", "whole").agg(F.count(F.lit(1)).alias("n"), F.max("alone").alias("any_alone"), F.min(held).alias("rep"))
    kinds = materialise(kinds, "suffix-kinds")
    equal = materialise(kinds.filter("n > 1 AND any_alone").select("middle", "whole"), "suffix-equal")
    spans.append(materialise(items.filter("alone").join(equal, ["middle", "whole"]).select(*columns), "suffix-ranges-repeated"))
    discard(items, equal)
    # middles with several kinds, one of them undecided
    undecided = (F.col("n") == 1) & F.col("any_alone")
    middles = materialise(
        kinds.groupBy("middle").agg(F.count(F.lit(1)).alias("leaves"), F.max(undecided).alias("open")).filter("leaves > 1 AND open").select("middle", "leaves"),
        "suffix-middles",
    )
    leaves = kinds.join(middles, "middle").select("middle", "leaves", "rep.doc_id", "rep.digest", "rep.first", "rep.last", undecided.alias("alone"), "rep.before", "rep.after")
    leaves = materialise(leaves, "suffix-leaves")
    discard(kinds, middles)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    few = leaves.filter(F.col("leaves") <= LEAF_ROWS).drop("leaves").repartition(parts, "middle").sortWithinPartitions("middle")
    spans.append(few.mapInArrow(_order_leaves, _SPANS))
    strings, counted = _counted(leaves.filter(F.col("leaves") > LEAF_ROWS))
    out = spans[0]
    for other in [*spans[1:], counted]:
        out = out.unionByName(other)
    out = materialise(out, "suffix-spans")
    discard(leaves, strings, *spans[:2])
    return out


def _counted(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(stored strings, starts of the repeated ones) of the leaves of large middles, by counting each string."""
    # start k of a leaf: `before` without its first k bytes, the middle, and as many bytes of
    # `after` as make RANGE symbols
    left = F.octet_length("before")
    strings = leaves.withColumn("k", F.explode(F.sequence(F.lit(0), F.col("last") - F.col("first")))).select(
        "middle", "doc_id", "digest", "alone", (F.col("first") + F.col("k")).alias("start"),
        F.substring(F.col("before"), F.col("k") + 1, left).alias("head"),
        F.substring(F.col("after"), F.lit(1), F.lit(RANGE - 1) - left + F.col("k")).alias("tail"),
    )
    strings = materialise(strings, "suffix-strings")
    key = ["middle", "head", "tail"]
    counts = strings.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(*key)
    hits = strings.filter("alone").join(counts, key)
    return strings, hits.select("doc_id", "digest", F.col("start").alias("first"), F.col("start").alias("last"))


def _stretches(spans: pa.StructArray | None, need: int, fine: bool) -> list[list[int]]:
    """[from, to) of the bytes that the strings of `need` bytes cover, which start in the spans of the kind `fine`."""
    out: list[list[int]] = []
    if spans is None or not len(spans):
        return out
    first, last = spans.field("first").to_numpy(), spans.field("last").to_numpy()
    mine = np.flatnonzero(spans.field("fine").to_numpy(zero_copy_only=False) == fine)
    order = mine[np.argsort(first[mine], kind="stable")]
    for a, b in zip(first[order].tolist(), (last[order] + need).tolist()):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def _blank(byte: int) -> bool:
    return byte == 0x20 or 0x09 <= byte <= 0x0D


def whole_words(data: bytes, a: int, b: int) -> int:
    """How many words lie wholly in data[a:b]."""
    n = len(data[a:b].split())
    if n and a > 0 and not _blank(data[a - 1]) and not _blank(data[a]):
        n -= 1
    if n and b < len(data) and not _blank(data[b]) and not _blank(data[b - 1]):
        n -= 1
    return n


def _remove(need: int, keep_text: bool, passages: bool = False):
    """Rows without the bytes that repeated strings of `need` bytes cover, or, where `need` is 0, without passages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans = batch.column("text"), batch.column("spans")
            n_bytes, n_removed, n_spans, digests, kept, n_passages, in_passages = [], [], [], [], [], [], []
            for i in range(len(batch)):
                data = (texts[i].as_py() or "").encode()
                found = spans[i].values
                some = []
                if passages or not need:
                    some = [(a, b, whole_words(data, a, b)) for a, b in _stretches(found, PASSAGE_BYTES, True)]
                gone = _stretches(found, need, False) if need else [[a, b] for a, b, n in some if n > PASSAGE_WORDS or b - a >= NEED]
                rest = b"".join(data[a:b] for a, b in zip([0, *(b for _, b in gone)], [*(a for a, _ in gone), len(data)]))
                n_bytes.append(len(data))
                n_removed.append(len(data) - len(rest))
                n_spans.append(len(gone))
                digests.append(hashlib.sha256(rest).hexdigest())
                if keep_text:
                    kept.append(rest.decode(errors="ignore") if gone else texts[i].as_py())
                if passages:
                    some = [b - a for a, b, n in some if n > PASSAGE_WORDS]
                    n_passages.append(len(some))
                    in_passages.append(sum(some))
            made = [pa.array(n_bytes, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(digests, pa.string())]
            names = ["n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if passages:
                made, names = [*made, pa.array(n_passages, pa.int64()), pa.array(in_passages, pa.int64())], [*names, "n_passages", "passage_bytes"]
            if keep_text:
                made, names = [*made, pa.array(kept, pa.string())], [*names, "kept_text"]
            others = [c for c in batch.schema.names if c not in ("text", "spans")]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in others], *made], names=[*others, *names])

    return run


def _long_stretches(need: int):
    """The stretches of at least `need` bytes that strings of PASSAGE_BYTES cover, widened to whole characters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, at, text = [], [], []
            spans = batch.column("spans")
            for i in range(len(batch)):
                found = [s for s in _stretches(spans[i].values, PASSAGE_BYTES, True) if s[1] - s[0] >= need]
                data = batch.column("text")[i].as_py().encode() if found else b""
                for a, b in found:
                    while data[a] & 0xC0 == 0x80:
                        a -= 1
                    while b < len(data) and data[b] & 0xC0 == 0x80:
                        b += 1
                    row.append(i)
                    at.append(a)
                    text.append(data[a:b].decode())
            index = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(index), batch.column("digest").take(index), pa.array(at, pa.int32()), pa.array(text, pa.string())],
                names=["doc_id", "digest", "at", "text"],
            )

    return run


def _base(docs: DataFrame, carry: list[str] | None) -> DataFrame:
    return in_batches(docs).select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("doc_id"), "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("digest"),
        *([F.struct(*carry).alias("carried")] if carry else []),
    )


def _with_spans(base: DataFrame, spans: DataFrame) -> DataFrame:
    """Rows with the list of their spans."""
    per_doc = spans.groupBy(F.col("doc_id").alias("o_id"), F.col("digest").alias("o_digest")).agg(F.collect_set(F.struct("first", "last", "fine")).alias("spans"))
    per_doc = materialise(per_doc, "suffix-per-document")
    return base.join(per_doc, _same_doc(base, per_doc), "left").drop("o_id", "o_digest")


def _result(met: DataFrame, need: int, keep_text: bool, passages: bool) -> DataFrame:
    met = met.drop("digest").withColumn("doc_id", F.nullif("doc_id", F.lit(_NO_ID)))
    schema = T.StructType([f for f in met.schema.fields if f.name not in ("text", "spans")])
    for name in ("n_bytes", "n_removed", "n_spans"):
        schema = schema.add(name, "long")
    schema = schema.add("kept_sha256", "string")
    if passages:
        schema = schema.add("n_passages", "long").add("passage_bytes", "long")
    return met.mapInArrow(_remove(need, keep_text, passages), schema.add("kept_text", "string") if keep_text else schema)


def _kind(spans: DataFrame, fine: bool) -> DataFrame:
    return spans.select("doc_id", "digest", "first", "last", F.lit(fine).alias("fine"))


def without_repeats(docs: DataFrame, need: int = NEED, keep_text: bool = False, carry: list[str] | None = None) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256; on demand kept_text, and `carried`, a struct of columns."""
    base = _base(docs, carry)
    spans = repeated_spans(base.select("doc_id", "text", "digest"), need)
    return _result(_with_spans(base, _kind(spans, False)), need, keep_text, False)


def with_passages(docs: DataFrame, need: int = NEED) -> DataFrame:
    """`without_repeats`, and n_passages and passage_bytes, of passages of more than PASSAGE_WORDS words that repeat."""
    if need < PASSAGE_BYTES:
        raise ValueError(f"strings of {need} bytes are no longer than those that passages are made of")
    base = _base(docs, None)
    texts = base.select("doc_id", "text", "digest")
    fine = _kind(repeated_spans(texts, PASSAGE_BYTES, PASSAGE_ANCHOR), True)
    found = materialise(_with_spans(texts, fine).filter("spans IS NOT NULL").mapInArrow(_long_stretches(need), "doc_id long, digest long, at int, text string"), "suffix-stretches")
    named = found.select("doc_id", F.xxhash64("digest", "at").alias("digest"), "text")
    inner = repeated_spans(named, need)
    places = found.select(F.col("doc_id").alias("p_id"), F.xxhash64("digest", "at").alias("p_digest"), F.col("digest").alias("whole"), "at").distinct()
    coarse = inner.join(places, (F.col("doc_id") == F.col("p_id")) & (F.col("digest") == F.col("p_digest"))).select(
        "doc_id", F.col("whole").alias("digest"), (F.col("first") + F.col("at")).alias("first"), (F.col("last") + F.col("at")).alias("last")
    )
    return _result(_with_spans(base, fine.unionByName(_kind(coarse, False))), need, False, True)


def without_passages(docs: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """Per row: the columns of `without_repeats`, kept_text and `carried`, with repeated passages and repeats of NEED bytes removed."""
    base = _base(docs, carry)
    spans = repeated_spans(base.select("doc_id", "text", "digest"), PASSAGE_BYTES, PASSAGE_ANCHOR)
    return _result(_with_spans(base, _kind(spans, True)), 0, True, False)
