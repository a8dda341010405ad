"""Byte-pair encoding and decoding with certain cuts taken first.

A merge makes a token of the vocabulary, so two neighbouring symbols that stand side by side inside no
token are never joined, whatever surrounds them: between them is a certain cut. Each pre-tokenised
word is cut at all such places, its fragments are merged alone, and their ids are put one after
another. A fragment occurs far more often than the words it is part of, so a worker merges each
distinct one once and remembers it; all new fragments of a slice of texts are merged in lock-step.

Special tokens are found in the raw text; normalising and splitting into words are left to the tokenizer
file's own rules, which never span ASCII white space, so each distinct white-space separated stretch
passes through them once per slice of texts, many in one call. Decoding gathers the tokens' bytes with one blank between,
as a file without a decoder asks for.

Defined results: a null text is an empty one, without ids, and decodes to the empty text; rows that
repeat are encoded alike and all kept; there is no limit on a text's length, and a word without white
space of any length is merged through a heap; an empty table gives no rows; columns other than doc_id and
text are ignored unless named in `carry`.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from venuerank.llm.text import Texts, in_batches, prefix_hash, seeds, slices, span_hash, words

SHORT = 24  # symbols of a fragment up to which it is merged in lock-step with others; longer ones through a heap
KNOWN = 500_000  # stretches, and fragments, a worker remembers; beyond, it starts to remember anew
_NEVER = 1 << 40  # rank of a pair that isn't joined
_ENDS = seeds(1, 151)[0]  # tells fragments that end a word from others


class Merges:
    """The vocabulary, its merges by rank, and which neighbours stand inside some token."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            held = json.load(file)
        model = held["model"]
        wanted = {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "ignore_merges": False}
        if any(model.get(k, v) != v for k, v in wanted.items()) or held.get("decoder") or held.get("post_processor"):
            raise ValueError("the tokenizer file asks for more than plain byte-pair merges")
        self.suffix = model["end_of_word_suffix"] or ""
        self.vocabulary: dict[str, int] = model["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        ids = self.vocabulary
        self.ranks = {(ids[a], ids[b]): (rank, ids[a + b]) for rank, (a, b) in enumerate(pairs)}
        self.added = {t["content"]: t["id"] for t in held["added_tokens"]}
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in held["added_tokens"]):
            raise ValueError("special tokens that take blanks with them or are normalised aren't known here")
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None

        order = sorted(self.ranks)
        self.pairs = np.array([a * len(ids) + b for a, b in order], np.int64)
        self.pair_ranks = np.array([self.ranks[pair][0] for pair in order], np.int64)
        self.made = np.array([ids[a + b] for a, b in pairs], np.int64)  # by rank

        # every symbol is one character of the byte alphabet, or one that ends its word
        letters = sorted({c for token in ids for c in self._plain(token)[0]})
        self.size = len(letters)
        self.number = np.zeros(max(map(ord, letters)) + 1, np.uint8)
        self.number[[ord(c) for c in letters]] = np.arange(self.size)
        self.symbol = np.array([ids[c] for c in letters] + [ids[c + self.suffix] for c in letters], np.int64)
        self.joined = np.zeros((self.size, 2 * self.size), bool)
        for token in ids:
            plain, ends = self._plain(token)
            at = [int(self.number[ord(c)]) for c in plain]
            for i in range(len(at) - 1):
                self.joined[at[i], at[i + 1] + (self.size if ends and i == len(at) - 2 else 0)] = True

        tokens = {i: t for t, i in ids.items()} | {i: t for t, i in self.added.items()}
        raw = [tokens.get(i, "").encode() for i in range(max(tokens) + 1)]
        self.token_sizes = np.array([len(t) for t in raw], np.int64)
        self.token_starts = np.cumsum(self.token_sizes) - self.token_sizes
        self.token_bytes = np.frombuffer(b"".join(raw), np.uint8)

    def _plain(self, token: str) -> tuple[str, bool]:
        ends = bool(self.suffix) and token.endswith(self.suffix) and len(token) > len(self.suffix)
        return (token[: -len(self.suffix)], True) if ends else (token, False)

    def numbers(self, found: list[str]) -> np.ndarray:
        """All letters of the words, one word after another, as numbers of the byte alphabet."""
        return self.number[np.frombuffer("".join(found).encode("utf-32-le"), np.uint32)]

    def fragments(self, letters: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first letter, behind the last, whether it ends its word) of each fragment of words that stop before `stops`."""
        ends = np.zeros(len(letters), bool)
        ends[stops - 1] = True
        cut = np.ones(len(letters) + 1, bool)
        cut[1:-1] = ends[:-1] | ~self.joined[letters[:-1], letters[1:] + np.where(ends[1:], self.size, 0)]
        places = np.flatnonzero(cut)
        return places[:-1], places[1:], ends[places[1:] - 1]

    def merge(self, letters: np.ndarray, first: np.ndarray, stop: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
        """Ids of each fragment: the lowest-ranked pair is joined first, the leftmost on ties."""
        sizes = stop - first
        out: list[np.ndarray] = [np.empty(0, np.int32)] * len(first)
        for i in np.flatnonzero(sizes > SHORT).tolist():
            symbols = self.symbol[letters[first[i] : stop[i]]]
            if ends[i]:
                symbols[-1] = self.symbol[int(letters[stop[i] - 1]) + self.size]
            out[i] = np.array(self._agenda(symbols.tolist()), np.int32)
        short = np.flatnonzero(sizes <= SHORT)
        if len(short):
            place = np.arange(SHORT)
            inside = place < sizes[short][:, None]
            at = letters[np.minimum(first[short][:, None] + place, len(letters) - 1)].astype(np.int64)
            at += np.where((place == sizes[short][:, None] - 1) & ends[short][:, None], self.size, 0)
            for i, ids in zip(short.tolist(), self._lock_step(np.where(inside, self.symbol[at], -1))):
                out[i] = ids
        return out

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * len(self.vocabulary) + b
        place = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where((a >= 0) & (b >= 0) & (self.pairs[place] == key), self.pair_ranks[place], _NEVER)

    def _lock_step(self, symbols: np.ndarray) -> list[np.ndarray]:
        """Rows of symbols, -1 behind the last, with one merge in every row at a time until none is left."""
        rows, width = symbols.shape
        symbols = np.concatenate([symbols, np.full((rows, 1), -1)], 1)
        ranks = np.concatenate([self._rank(symbols[:, :-1], symbols[:, 1:]), np.full((rows, 1), _NEVER)], 1)
        done, place = symbols.copy(), np.arange(width + 1)
        live = np.arange(rows)
        while len(live):
            best = ranks.argmin(1)
            at = np.arange(len(live))
            lowest = ranks[at, best]
            go = lowest < _NEVER
            if not go.all():
                done[live[~go]] = symbols[~go]
                live, symbols, ranks, best, lowest = live[go], symbols[go], ranks[go], best[go], lowest[go]
                at = np.arange(len(live))
                if not len(live):
                    break
            # what stands behind the pair moves up by one
            after = np.minimum(place + (place > best[:, None]), width)
            symbols, ranks = np.take_along_axis(symbols, after, 1), np.take_along_axis(ranks, after, 1)
            symbols[at, best] = self.made[lowest]
            ranks[at, best] = self._rank(symbols[at, best], symbols[at, np.minimum(best + 1, width)])
            some = best > 0
            ranks[at[some], best[some] - 1] = self._rank(symbols[at[some], best[some] - 1], symbols[at[some], best[some]])
        sizes = (done >= 0).sum(1)
        return [row[:n] for row, n in zip(done.astype(np.int32), sizes.tolist())]

    def _agenda(self, symbols: list[int]) -> list[int]:
        after = [*range(1, len(symbols)), -1]
        before = [-1, *range(len(symbols) - 1)]
        ranks = self.ranks
        agenda = [(*ranks[p], i) for i, p in enumerate(zip(symbols, symbols[1:])) if p in ranks]
        agenda = [(rank, i, made) for rank, made, i in agenda]
        heapq.heapify(agenda)
        while agenda:
            _, i, made = heapq.heappop(agenda)
            j = after[i]
            if symbols[i] < 0 or j < 0 or ranks.get((symbols[i], symbols[j]), (0, -1))[1] != made:
                continue  # one of the two has changed since
            symbols[i], symbols[j] = made, -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b >= 0 and (symbols[a], symbols[b]) in ranks:
                    rank, to = ranks[symbols[a], symbols[b]]
                    heapq.heappush(agenda, (rank, a, to))
        return [s for s in symbols if s >= 0]


class Known:
    """Runs of ids found through sorted hashes; the runs lie one after another."""

    def __init__(self):
        self.keys, self.at, self.sizes = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
        self.ids = np.empty(0, np.int32)

    def missing(self, distinct: np.ndarray) -> np.ndarray:
        place = np.minimum(np.searchsorted(self.keys, distinct), max(0, len(self.keys) - 1))
        return self.keys[place] != distinct if len(self.keys) else np.ones(len(distinct), bool)

    def add(self, keys: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> None:
        at = len(self.ids) + np.cumsum(sizes) - sizes
        self.ids = np.concatenate([self.ids, ids.astype(np.int32)])
        to = np.searchsorted(self.keys, keys)
        self.keys, self.at, self.sizes = (np.insert(a, to, b) for a, b in ((self.keys, keys), (self.at, at), (self.sizes, sizes)))

    def gather(self, distinct: np.ndarray, back: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds) of the runs distinct[back], one after another."""
        place = np.searchsorted(self.keys, distinct)
        at, sizes = self.at[place][back], self.sizes[place][back]
        upto = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
        return self.ids[np.repeat(at - upto[:-1], sizes) + np.arange(upto[-1])], upto


class Encoder:
    """Ids of texts by way of their distinct stretches without white space, and of these stretches' distinct fragments."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        held = Tokenizer.from_file(path)
        self.merges, self.normalizer, self.splitter = Merges(path), held.normalizer, held.pre_tokenizer
        self.stretches, self.parts = Known(), Known()

    def _split(self, raw: str) -> list[tuple[str, tuple[int, int]]]:
        return self.splitter.pre_tokenize_str(raw)

    def _normal(self, raw: str) -> str:
        return self.normalizer.normalize_str(raw) if self.normalizer else raw

    def encode_words(self, found: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds) of pre-tokenised words: cut for certain, and the fragments merged alone."""
        if not found:
            return np.empty(0, np.int32), np.zeros(1, np.int64)
        letters = self.merges.numbers(found)
        stops = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))
        first, stop, ends = self.merges.fragments(letters, stops)
        hashes = span_hash(prefix_hash(letters), first, stop) ^ np.where(ends, _ENDS, np.uint64(0))
        distinct, one, back = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.parts.keys) > KNOWN:
            self.parts = Known()
        new = self.parts.missing(distinct)
        if new.any():
            made = self.merges.merge(letters, first[one[new]], stop[one[new]], ends[one[new]])
            self.parts.add(distinct[new], np.fromiter(map(len, made), np.int64, len(made)), np.concatenate(made))
        ids, upto = self.parts.gather(distinct, back)
        return ids, upto[np.concatenate(([0], np.searchsorted(stop, stops) + 1))]

    def encode_stretches(self, found: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds) of stretches without ASCII white space."""
        together = self._normal(" ".join(found))
        special = self.merges.special
        if together.count(" ") != len(found) - 1 or (special and special.search(" ".join(found))):
            return self._one_by_one(found)
        pieces = [(word, at) for word, (at, _) in self._split(together) if word]
        ids, bounds = self.encode_words([word for word, _ in pieces])
        # words of stretch i stand behind its first i blanks
        blanks = np.flatnonzero(np.frombuffer(together.encode("utf-32-le"), np.uint32) == 0x20)
        places = np.fromiter((at for _, at in pieces), np.int64, len(pieces))
        return ids, bounds[np.concatenate(([0], np.searchsorted(places, blanks), [len(pieces)]))]

    def _one_by_one(self, found: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same where special tokens or white space beyond ASCII stand in the stretches."""
        special, added, pieces, owner = self.merges.special, self.merges.added, [], []
        for i, raw in enumerate(found):
            for part in special.split(raw) if special else [raw]:
                new = [added[part]] if part in added else [word for word, _ in self._split(self._normal(part)) if word]
                pieces += new
                owner += [i] * len(new)
        plain = np.array([isinstance(p, str) for p in pieces], bool)
        ids, bounds = self.encode_words([p for p in pieces if isinstance(p, str)])
        sizes = np.ones(len(pieces), np.int64)
        sizes[plain] = np.diff(bounds)
        upto = np.concatenate(([0], np.cumsum(sizes)))
        out = np.empty(upto[-1], np.int32)
        out[np.repeat(plain, sizes)] = ids
        out[upto[:-1][~plain]] = [p for p in pieces if not isinstance(p, str)]
        return out, upto[np.searchsorted(np.array(owner, np.int64), np.arange(len(found) + 1))]

    def encode(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds): text i has ids[bounds[i]:bounds[i + 1]]."""
        found = words(texts, lower=False)
        distinct, first, back = np.unique(found.hashes, return_index=True, return_inverse=True)
        if len(self.stretches.keys) > KNOWN:
            self.stretches = Known()
        new = self.stretches.missing(distinct)
        if new.any():
            raw = texts.data.tobytes()
            spans = zip(found.starts[first[new]].tolist(), found.ends[first[new]].tolist())
            ids, bounds = self.encode_stretches([raw[a:b].decode() for a, b in spans])
            self.stretches.add(distinct[new], np.diff(bounds), ids)
        ids, upto = self.stretches.gather(distinct, back)
        return ids, upto[found.cuts]

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, bounds) of the tokens of each text, one blank between two."""
        m = self.merges
        known = (ids >= 0) & (ids < len(m.token_sizes))
        if not known.all():
            raise ValueError(f"no token has the id {int(ids[~known][0])}")
        sizes = m.token_sizes[ids] + 1  # a blank after each token, for now
        upto = np.concatenate(([0], np.cumsum(sizes)))
        place = np.repeat(m.token_starts[ids] - upto[:-1], sizes) + np.arange(upto[-1])
        blank = upto[1:] - 1
        place[blank] = 0
        out = m.token_bytes[place] if len(place) else np.empty(0, np.uint8)
        out[blank] = 0x20
        # the blank after a text's last token goes
        some = np.diff(bounds) > 0
        keep = np.ones(len(out), bool)
        keep[upto[bounds[1:][some]] - 1] = False
        return out[keep], upto[bounds] - np.concatenate(([0], np.cumsum(some)))


@lru_cache(maxsize=1)
def loaded(path: str) -> Encoder:
    """A worker's encoder; what it knows serves all its tasks."""
    return Encoder(path)


def encoded(docs: DataFrame, tokenizer: str, carry: tuple[str, ...] = (), decoded: bool = False) -> DataFrame:
    """doc_id, the columns of `carry`, ids array<int> of every text; with `decoded` also the text its ids decode to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = loaded(tokenizer)
        for batch in batches:
            kept = [batch.column(i) for i, name in enumerate(batch.schema.names) if name != "text"]
            names = [name for name in batch.schema.names if name != "text"]
            for part in slices(batch.column("text")):
                ids, bounds = encoder.encode(part)
                made = [pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids))]
                if decoded:
                    data, ends = encoder.decode(ids, bounds)
                    texts = pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data))
                    made.append(texts.cast(pa.string()))
                yield pa.RecordBatch.from_arrays(
                    [*[c.slice(part.first, len(bounds) - 1) for c in kept], *made], names=[*names, "ids", *(["decoded"] if decoded else [])]
                )

    base = in_batches(docs).select("doc_id", *carry, "text")
    schema = T.StructType([f for f in base.schema.fields if f.name != "text"] + [T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return base.mapInArrow(run, schema.add("decoded", "string") if decoded else schema)


def decode_ids(rows: DataFrame, tokenizer: str) -> DataFrame:
    """`rows` with `decoded`, the text that `ids` array<int> stand for; null ids are none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = loaded(tokenizer)
        for batch in batches:
            lists = batch.column("ids").fill_null([])
            bounds = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy()))).astype(np.int64)
            data, ends = encoder.decode(lists.flatten().to_numpy(), bounds)
            texts = pa.LargeStringArray.from_buffers(len(batch), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data))
            yield pa.RecordBatch.from_arrays([*batch.columns, texts.cast(pa.string())], names=[*batch.schema.names, "decoded"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("decoded", T.StringType())]))


def round_trips(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 of the decimal ids joined by a blank, decoded_sha256, of every text."""
    found = encoded(docs, tokenizer, decoded=True)
    return found.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )
