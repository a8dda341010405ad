"""SentencePiece encoding with seeded merge-dropout, and lossless decoding.

The vocabulary of a BPE model is read from its file; merging is done here. Every word starts as
single characters (bytes, where a character has no piece). Its agenda holds the adjacent pairs
that form a piece; the best-scoring one, leftmost on ties, is taken off in each step. A keyed
hash of the seed, the document, the word's place in its text, the pair's place and the piece decides
whether the merge is skipped for good or made, so the same key gives the same ids anywhere and every
occurrence of a word is drawn on its own. Each distinct word of a slice is worked out once without
skips; an occurrence that skips none of these merges takes its ids from there, and only the others
are worked out one by one, all of them in lock-step.

Merges never cross the start of a word, since no piece holds a blank after another character;
blanks in a run belong to the word after them. Dropout 0 gives the model's own ids.

Defined results: a null or empty text has no ids and decodes to an empty text; any other text
decodes to itself, blanks at either end, line breaks and the blank's own symbol U+2581 included;
repeated rows of one doc_id and text get the same ids; an empty table gives no rows; columns other
than doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from venuerank.llm.text import Texts, in_batches, mix, prefix_hash, slices, span_hash

DROPOUT = 0.1
SEED = 20
SLICE_BYTES = 2 << 20
_NEVER = np.float32(np.inf)
_CHARACTER_BYTES = np.repeat([1, 2, 3, 4], [0xC0, 0x20, 0x10, 0x10])  # by a character's first byte
_LEAD_BITS = np.array([0, 0x7F, 0x1F, 0x0F, 0x07])
_LONG = 64  # words of more symbols are worked on apart from the rest


class Vocabulary:
    """Pieces of a model, the ids of its bytes and characters, and the table of pairs that merge."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.vocab_size()
        self.score = np.array([model.get_score(i) for i in range(size)], np.float32)
        plain, self.byte_ids, self.raw = {}, np.zeros(256, np.int32), []
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_ids[int(piece[1:-1], 16)] = i
                self.raw.append(bytes([int(piece[1:-1], 16)]))
            elif model.is_control(i) or model.is_unknown(i):
                self.raw.append(b"")
            else:
                plain[piece] = i
                self.raw.append(piece.replace("▁", " ").encode())
        self.blank = plain["▁"]
        self.by_code = np.full(0x110000, -1, np.int32)
        for p, i in plain.items():
            if len(p) == 1:
                self.by_code[ord(p)] = i
        # a blank is the piece of its symbol; the symbol in a text itself goes by its bytes
        self.by_code[ord("▁")] = -1
        self.by_code[ord(" ")] = self.blank
        pairs = {
            (plain[p[:k]] << 32) | plain[p[k:]]: i
            for p, i in plain.items() for k in range(1, len(p)) if p[:k] in plain and p[k:] in plain
        }
        # open addressing: a pair's slot is found by a few vectorised probes
        self.bits = max(4, (4 * max(1, len(pairs))).bit_length())
        self.keys, self.merged = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, -1, np.int32)
        self.probes = 1
        for key, i in pairs.items():
            slot, tries = int(self._slot(np.array([key], np.int64))[0]), 1
            while self.keys[slot] >= 0:
                slot, tries = (slot + 1) & ((1 << self.bits) - 1), tries + 1
            self.keys[slot], self.merged[slot] = key, i
            self.probes = max(self.probes, tries)
        self.lengths = np.array([len(r) for r in self.raw], np.int64)
        self.begins = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(self.raw), np.uint8)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def merge(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece each pair of ids forms, -1 where it forms none."""
        out = np.full(len(left), -1, np.int32)
        todo = np.flatnonzero((left >= 0) & (right >= 0))
        keys = (left[todo].astype(np.int64) << 32) | right[todo]
        slots = self._slot(keys)
        for _ in range(self.probes):
            held = self.keys[slots]
            hit = held == keys
            out[todo[hit]] = self.merged[slots[hit]]
            more = (held >= 0) & ~hit
            if not more.any():
                break
            todo, keys, slots = todo[more], keys[more], (slots[more] + 1) & ((1 << self.bits) - 1)
        return out

    def symbols(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places, ids) of the symbols that texts start from: a character's piece, or the bytes of one that has none."""
        lead = np.flatnonzero((data & 0xC0) != 0x80)
        size = _CHARACTER_BYTES[data[lead]]
        padded = np.append(data, np.zeros(3, np.uint8)).astype(np.int64)
        code = padded[lead] & _LEAD_BITS[size]
        for k in (1, 2, 3):
            code = np.where(size > k, (code << 6) | (padded[lead + k] & 0x3F), code)
        piece = self.by_code[code]
        alone = np.zeros(len(data), bool)  # bytes that are symbols themselves
        alone[lead] = piece < 0
        for k in (1, 2, 3):
            alone[lead[(piece < 0) & (size > k)] + k] = True
        ids = np.where(alone, self.byte_ids[data], np.int32(-1))
        ids[lead[piece >= 0]] = piece[piece >= 0]
        places = np.flatnonzero(ids >= 0)
        return places, ids[places]

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of the ids, the blank before the first word included."""
        sizes = self.lengths[ids]
        inner = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return self.flat[np.repeat(self.begins[ids], sizes) + inner]


@lru_cache(maxsize=1)
def loaded(path: str) -> Vocabulary:
    """A worker's vocabulary; it reads the file once for all its tasks."""
    return Vocabulary(path)


def _limit(dropout: float) -> np.uint64:
    return np.uint64(min(int(dropout * 2.0**64), 2**64 - 1))


def _event(place: np.ndarray, piece: np.ndarray) -> np.ndarray:
    """What a merge's draw hangs on besides its word's key."""
    return mix((place.astype(np.uint64) << np.uint64(32)) | piece.astype(np.uint64))


def run_agendas(vocabulary: Vocabulary, symbols: np.ndarray, keys: np.ndarray, dropout: float, merges: list[tuple[np.ndarray, np.ndarray]] | None = None) -> np.ndarray:
    """Merge all rows of `symbols` (-1 fills the ends) in lock-step; -1 marks what was merged away.

    (rows, what is drawn for) of the merges made are added to `merges`.
    """
    n, width = symbols.shape
    symbols = symbols.copy()
    result = symbols
    rows = np.arange(n)
    live = rows
    after = np.tile(np.arange(1, width + 1), (n, 1))  # place of the next symbol; width: none
    before = np.tile(np.arange(-1, width - 1), (n, 1))
    pair = np.full((n, width), -1, np.int32)
    for place in range(width - 1):
        pair[:, place] = vocabulary.merge(symbols[:, place], symbols[:, place + 1])
    cost = np.where(pair >= 0, -vocabulary.score[pair], _NEVER)
    limit = _limit(dropout)
    while True:
        place = cost[live].argmin(1)
        open_ = cost[live, place] < _NEVER
        live, place = live[open_], place[open_]
        if not len(live):
            return result
        piece = pair[live, place]
        if dropout:
            drawn = mix(keys[live] ^ _event(place, piece))
            skipped = drawn < limit
            cost[live[skipped], place[skipped]] = _NEVER
            at, place, piece = live[~skipped], place[~skipped], piece[~skipped]
        else:
            at = live
        if merges is not None:
            merges.append((at, _event(place, piece)))
        right = after[at, place]
        beyond = after[at, right]
        symbols[at, place], symbols[at, right] = piece, -1
        after[at, place] = beyond
        cost[at, right] = _NEVER
        inside = beyond < width
        before[at[inside], beyond[inside]] = place[inside]
        following = np.where(inside, symbols[at, np.minimum(beyond, width - 1)], -1)
        pair[at, place] = made = vocabulary.merge(piece, following)
        cost[at, place] = np.where(made >= 0, -vocabulary.score[made], _NEVER)
        left = before[at, place]
        has = left >= 0
        a, p = at[has], left[has]
        pair[a, p] = made = vocabulary.merge(symbols[a, p], piece[has])
        cost[a, p] = np.where(made >= 0, -vocabulary.score[made], _NEVER)


def word_bounds(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts of words, cuts): a word is a run of blanks and the other bytes after it."""
    blank = data == 0x20
    start = np.zeros(len(data) + 1, bool)
    start[1:-1] = blank[1:] & ~blank[:-1]
    start[bounds[:-1]] = True
    start = start[:-1]
    starts = np.flatnonzero(start)
    return starts, np.searchsorted(starts, bounds)


def encode_slice(vocabulary: Vocabulary, texts: Texts, doc_keys: np.ndarray, dropout: float = DROPOUT, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """(ids, bounds) of a slice of texts."""
    n = len(texts.bounds) - 1
    if not len(texts.data):
        return np.empty(0, np.int32), np.zeros(n + 1, np.int64)
    starts, cuts = word_bounds(texts.data, texts.bounds)
    ends = np.append(starts[1:], len(texts.data))
    counts = np.diff(cuts)
    doc = np.repeat(np.arange(n), counts)
    inner = np.arange(len(starts)) - np.repeat(cuts[:-1], counts)
    first = (inner == 0).astype(np.uint64)
    # the first word of a text follows the model's own blank
    kinds = span_hash(prefix_hash(texts.data), starts, ends) ^ first
    distinct, at, back = np.unique(kinds, return_index=True, return_inverse=True)
    keys = mix(doc_keys[doc] ^ mix(inner.astype(np.uint64) + np.uint64(seed) * np.uint64(1000003)))
    places, symbols = vocabulary.symbols(texts.data)
    pool, pooled = [], 0

    def work_out(at: np.ndarray, dropout: float, merges: list | None) -> tuple[np.ndarray, np.ndarray]:
        """(lengths, offsets in the pool) of the words of these numbers; `merges` takes (word, draw) of all merges."""
        nonlocal pooled
        begin, lead = np.searchsorted(places, starts[at]), first[at].astype(np.int64)
        sizes = np.searchsorted(places, ends[at]) - begin + lead
        lengths, offsets = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        bands = [(0, 4), (4, 8), (8, 12), (12, 20), (20, _LONG)] + [(x, x + 1) for x in np.unique(sizes[sizes >= _LONG]).tolist()]
        for low, high in bands:
            chosen = np.flatnonzero((sizes >= low) & (sizes < high))
            width = int(sizes[chosen].max()) if len(chosen) else 0
            step = max(1, (1 << 20) // max(width, 1))
            for k in range(0, len(chosen), step):
                rows = chosen[k : k + step]
                column = np.arange(width)[None, :]
                source = np.clip(begin[rows, None] + column - lead[rows, None], 0, len(symbols) - 1)
                block = np.where(column < sizes[rows, None], symbols[source], np.int32(-1))
                block[lead[rows] == 1, 0] = vocabulary.blank
                made = None if merges is None else []
                done = run_agendas(vocabulary, block, keys[at[rows]], dropout, made)
                if made:
                    merges += [(rows[i], event) for i, event in made]
                left = done >= 0
                lengths[rows] = left.sum(1)
                offsets[rows] = pooled + np.cumsum(lengths[rows]) - lengths[rows]
                pool.append(done[left])
                pooled += len(pool[-1])
        return lengths, offsets

    merges: list[tuple[np.ndarray, np.ndarray]] = []
    lengths, offsets = work_out(at, 0.0, merges if dropout else None)
    take, offset = lengths[back], offsets[back]
    if merges:
        # the merges of each distinct word, and the occurrences that skip one of them
        row = np.concatenate([r for r, _ in merges])
        order = np.argsort(row, kind="stable")
        event = np.concatenate([e for _, e in merges])[order]
        edges = np.searchsorted(row[order], np.arange(len(at) + 1))
        skips, limit, block = np.zeros(len(starts), bool), _limit(dropout), 1 << 16
        for a in range(0, len(starts), block):
            kind = back[a : a + block]
            count = np.diff(edges)[kind]
            before = np.cumsum(count) - count
            owner = np.repeat(np.arange(len(kind)), count)
            drawn = mix(keys[a : a + block][owner] ^ event[edges[kind][owner] + np.arange(len(owner)) - before[owner]])
            skips[a + owner[drawn < limit]] = True
        alone = np.flatnonzero(skips)
        take[alone], offset[alone] = work_out(alone, dropout, None)
    inner = np.arange(take.sum()) - np.repeat(np.cumsum(take) - take, take)
    ids = np.concatenate(pool)[np.repeat(offset, take) + inner]
    upto = np.concatenate(([0], np.cumsum(take)))
    return ids, upto[cuts]


def decode_slice(vocabulary: Vocabulary, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, bounds) of the texts, without the blank before each first word."""
    data = vocabulary.decode(ids)
    upto = np.concatenate(([0], np.cumsum(vocabulary.lengths[ids])))[bounds]
    full = upto[1:] > upto[:-1]
    keep = np.ones(len(data), bool)
    keep[upto[:-1][full]] = False
    return data[keep], upto - np.concatenate(([0], np.cumsum(full)))


def encoded(docs: DataFrame, model: str, dropout: float = DROPOUT, seed: int = SEED) -> DataFrame:
    """doc_id, n_pieces, ids, lossless (whether the ids decode to the whole text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = loaded(model)
        for batch in batches:
            doc_ids = batch.column("doc_id")
            held = doc_ids.fill_null(-1).to_numpy().astype(np.int64).view(np.uint64)
            for part in slices(batch.column("text"), SLICE_BYTES):
                n = len(part.bounds) - 1
                keys = mix(held[part.first : part.first + n] + np.uint64(seed))
                ids, bounds = encode_slice(vocabulary, part, keys, dropout, seed)
                data, back = decode_slice(vocabulary, ids, bounds)
                same = np.array_equal(back, part.bounds) and np.array_equal(data, part.data)
                lossless = [True] * n if same else [
                    np.array_equal(data[back[i] : back[i + 1]], part.data[part.bounds[i] : part.bounds[i + 1]]) for i in range(n)
                ]
                yield pa.RecordBatch.from_arrays(
                    [doc_ids.slice(part.first, n), pa.array(np.diff(bounds), pa.int64()), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids)), pa.array(lossless)],
                    names=["doc_id", "n_pieces", "ids", "lossless"],
                )

    found = in_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return found.mapInArrow(run, "doc_id long, n_pieces long, ids array<int>, lossless boolean")


def decoded(pieces: DataFrame, model: str) -> DataFrame:
    """doc_id and text of rows with ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = loaded(model)
        for batch in batches:
            lists = batch.column("ids")
            flat = lists.flatten().to_numpy().astype(np.int64)
            bounds = np.concatenate(([0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy()))).astype(np.int64)
            data, upto = decode_slice(vocabulary, flat, bounds)
            raw = data.tobytes()
            texts = [raw[a:b].decode() for a, b in zip(upto[:-1].tolist(), upto[1:].tolist())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return pieces.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(run, "doc_id long, text string")
