import hashlib
import random
import re

import numpy as np
import pytest

from support import prose
from venuerank.llm import suffix_dedup
from venuerank.llm.suffix_array import suffix_array


def brute(texts, need):
    raw = [(t or "").encode() for t in texts]
    seen = {}
    for b in raw:
        for i in range(len(b) - need + 1):
            seen[b[i : i + need]] = seen.get(b[i : i + need], 0) + 1
    out = []
    for b in raw:
        gone = np.zeros(len(b) + 1, int)
        for i in range(len(b) - need + 1):
            if seen[b[i : i + need]] > 1:
                gone[i : i + need] = 1
        gone = gone[: len(b)]
        rest = bytes(x for x, g in zip(b, gone) if not g)
        out.append((len(b), int(gone.sum()), int((np.diff(np.append(0, gone)) == 1).sum()), hashlib.sha256(rest).hexdigest()))
    return out


def check(df, texts, need=suffix_dedup.NEED):
    got = suffix_dedup.without_repeats(df, need)
    found = sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got.collect())
    assert found == sorted((i, *row) for i, row in enumerate(brute(texts, need)))
    return found


def passages(need):
    shared, other = prose(need // 3, 1), prose(need // 3, 2)
    edge = prose(need, 3)[:need]
    return [
        prose(50, 10) + shared + prose(30, 11), prose(20, 12) + shared + prose(40, 13) + other, other[5:] + prose(60, 14) + shared[9:],
        "x" + edge + "y", "z" + edge + "w", "z" + edge[: need - 1] + "q", edge[1:] + "r", prose(100, 15) + " " + prose(100, 15),
        "ab" * need, "aaab" * need, None, "", "short", prose(100, 16), prose(100, 16), "é" * need + prose(9, 17), "\n" + "é" * need + prose(9, 18),
    ]


@pytest.mark.parametrize("need", [400, 61])
def test_equals_brute_force(documents, need):
    texts = passages(need)
    found = check(documents(list(enumerate(texts)), clash=True), texts, need)
    assert any(0 < r[2] < r[1] for r in found)


def test_random_texts_of_few_symbols(documents):
    draw = random.Random(3)
    texts = ["".join(draw.choice("ab ") for _ in range(draw.randint(0, 200))) for _ in range(60)]
    parts = ["".join(draw.choice("abc") for _ in range(60)) for _ in range(4)]
    texts += ["".join(draw.choice(parts)[draw.randint(0, 9) :] for _ in range(5)) for _ in range(40)]
    check(documents(list(enumerate(texts))), texts, 40)


@pytest.mark.parametrize("most", [1, 3])
def test_large_groups_are_counted(documents, monkeypatch, most):
    monkeypatch.setattr(suffix_dedup, "LEAF_ROWS", most)
    shared = prose(120, 5)
    texts = [prose(9, 100 + i) + shared + prose(9, 200 + i) for i in range(25)] + passages(400)
    check(documents(list(enumerate(texts))), texts)


def test_rows_repeated_and_null_ids(documents):
    text = prose(200, 4)
    got = suffix_dedup.without_repeats(documents([(1, text), (1, text), (None, prose(200, 6)), (2, "q" + prose(200, 6)), (1, prose(200, 7))]))
    assert sorted((str(r.doc_id), r.n_bytes - r.n_removed) for r in got.collect()) == [("1", 0), ("1", 0), ("1", len(prose(200, 7))), ("2", 1), ("None", 0)]


def test_stretches_and_passages_equal_brute_force(documents):
    texts = passages(400) + passages(300)
    short = prose(51, 30)  # shorter than a string, but a passage
    assert 224 <= len(short) < 400
    texts += [f"{prose(70, 31)} {short} {prose(80, 32)}", f"{prose(7, 33)} {short}", f"{short}{prose(90, 34)}", f"{prose(50, 35)} {prose(33, 36)}", f"{prose(33, 36)} {prose(50, 37)}"]
    got = {r.doc_id: r for r in suffix_dedup.with_passages(documents(list(enumerate(texts)), clash=True)).collect()}
    assert [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in (got[i] for i in range(len(texts)))] == brute(texts, 400)
    # what strings of the shorter length cover, by brute force, and the words in it
    for i, text in enumerate(texts):
        data = (text or "").encode()
        want = []
        for a, b in covered(texts, suffix_dedup.PASSAGE_BYTES)[i]:
            n = sum(a <= m.start() and m.end() <= b for m in re.finditer(rb"[^\x20\x09-\x0D]+", data))
            if n > 50:
                want.append(b - a)
        assert (got[i].n_passages, got[i].passage_bytes) == (len(want), sum(want)), i
    assert [got[i].n_passages for i in range(len(texts) - 5, len(texts))] == [1, 1, 0, 0, 0] or got[len(texts) - 3].n_passages == 1
    assert got[len(texts) - 5].n_removed == 0


def covered(texts, need):
    raw = [(t or "").encode() for t in texts]
    seen = {}
    for b in raw:
        for i in range(len(b) - need + 1):
            seen[b[i : i + need]] = seen.get(b[i : i + need], 0) + 1
    out = []
    for b in raw:
        found = []
        for i in range(len(b) - need + 1):
            if seen[b[i : i + need]] > 1:
                if found and i <= found[-1][1]:
                    found[-1][1] = i + need
                else:
                    found.append([i, i + need])
        out.append(found)
    return out


def test_passages_are_removed(documents):
    short, line = prose(51, 40), prose(30, 41)
    solid = "x".join(prose(80, 42).split())  # over 400 bytes without a blank
    texts = [f"{prose(70, i)} {short} {prose(60, 60 + i)} {line}" for i in range(5)] + [f"{solid} {i}" for i in range(2)] + [prose(90, 80), None, ""]
    got = {r.doc_id: r for r in suffix_dedup.without_passages(documents(list(enumerate(texts))), carry=["doc_id"]).collect()}
    assert all(short[10:-10] not in got[i].kept_text and line in got[i].kept_text and prose(69, i) in got[i].kept_text for i in range(5))
    assert [got[i].kept_text for i in (5, 6)] == ["0", "1"] and [got[i].kept_text for i in (7, 8, 9)] == [prose(90, 80), None, ""]


def test_a_text_longer_than_a_slice(documents):
    shared = prose(300, 50)
    long = prose(250_000, 51)
    assert len(long) > 1 << 20
    at = len(long) - 5000
    texts = [long[:at] + shared + long[at:], shared + "q" + prose(50, 52)]
    got = {r.doc_id: r for r in suffix_dedup.without_repeats(documents(list(enumerate(texts)))).collect()}
    assert [got[i].n_spans for i in (0, 1)] == [1, 1] and all(len(shared) <= got[i].n_removed <= len(shared) + 2 for i in (0, 1))


def test_whole_words():
    data = b"ab cd  ef\tgh ij"
    assert [suffix_dedup.whole_words(data, a, b) for a, b in ((0, 15), (1, 15), (2, 14), (3, 5), (4, 8), (5, 7), (0, 0), (15, 15))] == [5, 4, 3, 1, 0, 0, 0, 0]


def test_empty_table(documents):
    assert suffix_dedup.without_repeats(documents([])).count() == 0
    assert suffix_dedup.with_passages(documents([])).count() == 0
    assert suffix_dedup.without_passages(documents([])).count() == 0


def test_suffix_array():
    draw = random.Random(1)
    for _ in range(500):
        s = [draw.randint(1, draw.choice([1, 2, 5])) for _ in range(draw.randint(0, 40))]
        assert suffix_array(np.array(s, np.int64)).tolist() == sorted(range(len(s)), key=lambda i: s[i:])
