"""Texts longer than any slice, beside short ones, against the plain definitions."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from support import prose, words_of
from test_near_dup import shingles
from test_packing import check as check_packing
from test_toxicity import BAD, corpus, table
from venuerank.llm import bpe, near_dup, packing, pieces, suffix_dedup, toxicity
from venuerank.llm.text import SLICE_BYTES

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
LONGEST = 2 << 20


@pytest.fixture(scope="module")
def long_text():
    text = prose(420_000, 77)
    assert len(text.encode()) > max(SLICE_BYTES, LONGEST, packing.SLICE_BYTES, pieces.SLICE_BYTES)
    return text


def test_ids_and_pieces(documents, long_text):
    rows = [(1, prose(30, 1)), (2, long_text), (3, prose(40, 2))]
    library = Tokenizer.from_file(WORD_BPE)
    got = {r.doc_id: r.ids for r in bpe.encoded(documents(rows), WORD_BPE).collect()}
    assert got == {i: library.encode(t, add_special_tokens=False).ids for i, t in rows}
    used, least = check_packing(rows, packing.packed(documents(rows), WORD_BPE).collect(), 4096)
    assert used <= least + 1
    encoded = pieces.encoded(documents(rows), PIECES)
    assert sorted((r.doc_id, r.text) for r in pieces.decoded(encoded, PIECES).collect()) == rows


def test_near_copies(documents, long_text):
    words = long_text.split()
    changed = list(words)
    changed[::50] = [f"new{k}" for k in range(len(changed[::50]))]
    far = list(words)
    far[::20] = [f"far{k}" for k in range(len(far[::20]))]
    rows = [(5, long_text), (7, " ".join(changed)), (8, " ".join(far)), (9, prose(60, 3))]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dup.near_groups(documents(rows)).collect()}
    heads = {5: 5, 7: 5, 8: 8, 9: 9}
    assert got == {i: (len(shingles(t)), heads[i]) for i, t in rows}


def removed(texts, need):
    """(bytes, removed, runs, digest of the rest) per text; strings are told apart by Python's own hash."""
    raw = [t.encode() for t in texts]
    held = [np.array([hash(b[i : i + need]) for i in range(len(b) - need + 1)], np.int64) for b in raw]
    _, inverse, counts = np.unique(np.concatenate(held), return_inverse=True, return_counts=True)
    twice, at, out = counts[inverse] > 1, 0, []
    for b, h in zip(raw, held):
        cover = np.zeros(len(b) + 1, int)
        starts = np.flatnonzero(twice[at : at + len(h)])
        at += len(h)
        np.add.at(cover, starts, 1)
        np.add.at(cover, starts + need, -1)
        gone = np.cumsum(cover)[:-1] > 0
        rest = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out.append((len(b), int(gone.sum()), int((np.diff(np.append(0, gone.astype(int))) == 1).sum()), hashlib.sha256(rest).hexdigest()))
    return out


def test_repeated_passages(documents, long_text):
    """One passage at both ends of the long text, one across the place where a slice would end, one in its middle."""
    passage, other = prose(120, 5), long_text[SLICE_BYTES - 300 : SLICE_BYTES + 400]
    texts = [
        f"{passage} {long_text} {passage}", f"{prose(40, 6)} {other} {prose(30, 7)}", f"{prose(20, 8)} {long_text[1_500_000:1_500_600]}",
        prose(300, 9), passage[:300],
    ]
    got = suffix_dedup.with_passages(documents(list(enumerate(texts)))).collect()
    found = sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got)
    want = [(i, *row) for i, row in enumerate(removed(texts, suffix_dedup.NEED))]
    assert found == want and found[0][3] == 4


def test_toxic_passage_at_the_end(spark, documents, long_text):
    rows, labels = corpus()
    odd = [(1001, long_text), (1002, " ".join([long_text, *BAD, *BAD, prose(50, 4)]))]
    got = {r.doc_id: r for r in toxicity.score_documents(documents(rows + odd), table(spark, labels)).collect()}
    n = len(words_of(420_000, 77))
    assert (got[1001].predicted, got[1002].predicted) == (0, 1)
    assert any(p["first"] <= n < p["end"] for p in got[1002].passages)
