import random
import re
import string
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from venuerank.llm import spelling


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    longer, shorter = (a, b) if len(a) > len(b) else (b, a)
    return any(longer[:i] + longer[i + 1 :] == shorter for i in range(len(longer)))


def brute_words(rows):
    lower = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 7 and n >= 2}


def brute(words):
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out, key=str)


def check(df, words):
    got = sorted((tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in df.collect()), key=str)
    assert got == brute(words)
    return got


def misspelt(draw, word):
    i = draw.randrange(len(word))
    letter = draw.choice("aeinrsté")
    return draw.choice([word[:i] + word[i + 1 :], word[:i] + letter + word[i:], word[:i] + letter + word[i + 1 :]])


def vocabulary(n, seed=0):
    draw = random.Random(seed)
    parts = ["tion", "ing", "the", "er", "an", "st", "éa", "ou", "ñi", "re", "ly"]
    words = {}
    while len(words) < n:
        word = "".join(draw.choice(parts) for _ in range(draw.randint(3, 6)))
        for _ in range(draw.randint(0, 3)):
            words[word] = draw.choice([2, 3, 30, 40, 500, 9000])
            word = misspelt(draw, word)
        words[word] = draw.randint(2, 50)
    return {w: c for w, c in words.items() if len(w) >= 7}


def test_texts_of_all_kinds(documents):
    draw = random.Random(5)
    base = ["restaurant", "Restaurant", "excellent", "naïveté", "ÀÉÎÕÜßÿ", "delicious", "delicous", "delicius", "aaaaaaaa", "aaaaaaa", "short", "×÷×÷×÷×"]
    rows = [(i, " ".join(draw.choice(["", "-", "9"]) + draw.choice([w, misspelt(draw, w), w]) for w in draw.choices(base, k=40))) for i in range(120)]
    rows += [(None, "restaurant restaurants"), (500, None), (501, ""), (502, "x" * 3000 + " " + "x" * 3000), (503, "x" * 2999 + " " + "x" * 3000 + "日" + "x" * 2999), (1, rows[1][1]), (1, rows[1][1])]
    got = check(spelling.grouped_variants(documents(rows, clash=True)), brute_words(rows))
    assert any(r[1] for r in got) and any(r[0] == "x" * 2999 for r in got)


@pytest.mark.parametrize("most, leaf, probes", [(8000, 24, 20000), (40, 2, 30), (1, 1, 7)])
def test_equals_brute_force(spark, monkeypatch, most, leaf, probes):
    # small bounds: more levels are dealt, deeper searches, and shards left too large at the last level
    monkeypatch.setattr(spelling, "SHARD_WORDS", most)
    monkeypatch.setattr(spelling, "LEAF", leaf)
    monkeypatch.setattr(spelling, "PROBES", probes)
    words = vocabulary(700, most)
    table = spark.createDataFrame(list(words.items()), "word string, n long").repartition(5)
    got = check(spelling.variants(table), words)
    assert any(r[1] for r in got) and any(r[2] != r[1] and r[1] for r in got)


def test_many_words_of_one_path(spark, monkeypatch):
    """Letters of one group are told apart by verification only: all these words have one frequency vector."""
    monkeypatch.setattr(spelling, "SHARD_WORDS", 50)
    draw = random.Random(3)
    same = [c for c in string.ascii_lowercase + "àáâãäåæçèéêëìíîïðñòóôõö" if ord(c) % 16 == 1]
    words = {"".join(draw.choice(same) for _ in range(7)): draw.choice([2, 25, 600]) for _ in range(250)}
    words |= {"b" + w[1:]: 5 for w in list(words)[:50]} | {w[1:] + "ab": 5 for w in list(words)[:50]}
    check(spelling.variants(spark.createDataFrame(list(words.items()), "word string, n long")), words)


def test_chains_are_followed_to_their_root(spark):
    words = {"abcdefg" + "h" * i: 3 * 10 ** (8 - i) for i in range(8)}
    got = check(spelling.variants(spark.createDataFrame(list(words.items()), "word string, n long")), words)
    assert {r[2] for r in got} == {"abcdefg"}


def test_one_edit():
    draw = random.Random(2)
    words = ["".join(draw.choice("ab") for _ in range(draw.randint(7, 10))) for _ in range(120)] + ["a" * 5000, "a" * 4999, "a" * 4999 + "b"]
    pairs = [(x, y) for x in words for y in words if len(x) - len(y) in (0, 1)]
    data = "".join(words).encode("latin-1")
    at = {w: i for i, w in enumerate(words)}
    bounds = np.concatenate(([0], np.cumsum([len(w) for w in words])))
    got = spelling.one_edit(np.frombuffer(data, np.uint8), bounds, np.array([at[x] for x, _ in pairs]), np.array([at[y] for _, y in pairs]))
    assert got.tolist() == [one_edit(x, y) for x, y in pairs]


def test_slips(documents):
    rows = [(i, "wonderful") for i in range(200)]
    got = sorted(r.word for r in spelling.occurrences(documents(rows)).collect())
    assert Counter(got) == Counter({w: n for w, n in Counter(
        (lambda h: "wonderful"[: h % 9] + "wonderful"[h % 9 + 1 :] if h % 31 == 0 else "wonderful")(zlib.crc32(f"{i}:wonderful".encode())) for i in range(200)
    ).items()})


def test_empty_table(documents):
    assert spelling.grouped_variants(documents([])).count() == 0
    assert spelling.grouped_variants(documents([(1, "no words"), (2, None)]).withColumn("word", F.lit(1))).count() == 0
