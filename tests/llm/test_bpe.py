import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from support import prose
from venuerank.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
TRICKY = [
    None, "", " \t\n", "a", "Hello, WORLD's don't I'll we've 12345", "x<|endoftext|>y <|startoftext|><|endoftext|>", "<|endoftext", "|><|>",
    "é ́a b c\u0085d", "ΣΊΣΥΦΟΣ Σ İstanbul ẞ ǅ", "日本語のテキスト😀👩‍👩‍👧", "\x00\x01\x1c\x1f​﻿", "Ⅷ²½٣४", "'s't're''sS'S",
    "a" * 5000, "ab" * 3000, "日" * 700, "!?" * 500, "<|endoftext|>" * 40, "naïve façade Ünïcödé ñandú", "\U0010ffff�", "word\x0bword\x0cword",
]


@pytest.fixture(scope="module")
def library():
    held = Tokenizer.from_file(PATH)
    held.no_truncation()
    held.no_padding()
    return held


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return ids, library.decode(ids, skip_special_tokens=False)


def random_texts(n):
    draw = random.Random(7)
    kinds = ["abcdefghij ", "the and ing tion 's ", "áéñüÀß ", "日本語 한국어 ", "0123456789., ", "<|endoftext|> <|>", "😀👍🏽́‍ ", "ΑΣσς "]
    return ["".join(draw.choice(draw.choice(kinds)) for _ in range(draw.randint(0, 120))) for _ in range(n)]


def test_equals_the_library(documents, library):
    texts = TRICKY + random_texts(400) + [prose(400, 3)]
    got = {r.doc_id: r for r in bpe.encoded(documents(list(enumerate(texts)), clash=True), PATH, decoded=True).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        assert (got[i].ids, got[i].decoded) == expected(library, text), text


def test_digests(documents, library):
    texts = [None, "", "Some words, twice.", "Some words, twice."]
    got = sorted(map(tuple, bpe.round_trips(documents(list(enumerate(texts)) + [(None, "null id")]), PATH).collect()), key=str)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for i, text in [*enumerate(texts), (None, "null id")]:
        ids, decoded = expected(library, text)
        want.append((i, len(ids), sha(" ".join(map(str, ids))), sha(decoded)))
    assert got == sorted(want, key=str)


def test_decoding_of_given_ids(spark, library):
    rows = [(1, [49406, 320, 5, 49407]), (2, []), (3, None), (4, [0])]
    got = bpe.decode_ids(spark.createDataFrame(rows, "doc_id long, ids array<int>"), PATH).collect()
    assert [r.decoded for r in got] == [library.decode(ids or [], skip_special_tokens=False) for _, ids in rows]


def test_a_text_longer_than_a_slice(documents, library, monkeypatch):
    texts = ["short", prose(260_000, 5), "x" * 30_000 + " " + prose(10, 1)]
    assert len(texts[1]) > 1 << 20
    got = {r.doc_id: r.ids for r in bpe.encoded(documents(list(enumerate(texts))), PATH).collect()}
    assert [got[i] for i in range(3)] == [expected(library, t)[0] for t in texts]


def test_cuts_are_certain(library):
    merges = bpe.Merges(PATH)
    found = ["qzxqj", "hello", "aaaa", "zqzqz", "x"]
    letters, stops = merges.numbers(found), np.cumsum([len(w) for w in found])
    assert all(merges.joined[a, b] for a, b in (merges.numbers([p]) for p in ("th", "in", "he")))
    first, stop, ends = merges.fragments(letters, stops)
    joined = ["".join(found)[a:b] for a, b in zip(first, stop)]
    assert "".join(joined) == "".join(found) and set(stops) <= set(stop) and ends.sum() == len(found)
    assert len(joined) > len(found)
    ids = np.concatenate(merges.merge(letters, first, stop, ends)).tolist()
    assert ids == [i for w in found for i in library.encode(w, add_special_tokens=False).ids]


def test_heap_and_lock_step_agree():
    merges, draw = bpe.Merges(PATH), random.Random(1)
    rows = [[draw.randrange(64, 64 + draw.choice([2, 5, 26])) for _ in range(draw.randint(1, 40))] for _ in range(500)]
    table = np.full((len(rows), 40), -1)
    for i, row in enumerate(rows):
        table[i, : len(row)] = row
    assert [r.tolist() for r in merges._lock_step(table)] == [merges._agenda(list(row)) for row in rows]


def test_words_are_forgotten(documents, library, monkeypatch):
    encoder = bpe.Encoder(PATH)
    monkeypatch.setattr(bpe, "KNOWN", 5)
    for seed in range(4):
        text = prose(50, seed)
        raw = np.frombuffer(text.encode(), np.uint8)
        assert encoder.encode(bpe.Texts(0, raw, np.array([0, len(raw)])))[0].tolist() == expected(library, text)[0]


def test_empty_table(documents):
    assert bpe.round_trips(documents([]), PATH).count() == 0
