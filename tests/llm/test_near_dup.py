import re
from collections import Counter, defaultdict

import pytest

from support import prose, words_of
from venuerank.llm import near_dup

_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(_LOWER))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    """doc_id -> (set size, smallest doc_id reachable); doc_ids must differ."""
    sets = {i: shingles(t) for i, t in rows}
    head = {i: i for i in sets}

    def find(x):
        while head[x] != x:
            x = head[x]
        return x

    lists, shared = defaultdict(list), Counter()
    for i, s in sets.items():
        for x in s:
            lists[x].append(i)
    for held in lists.values():
        for j, a in enumerate(held):
            for b in held[j + 1 :]:
                shared[a, b] += 1
    for (a, b), n in shared.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            a, b = find(a), find(b)
            head[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def edited(seed, changes, n=200):
    w = words_of(n, seed)
    for k in changes:
        w[k % n] = f"new{k}"
    return " ".join(w)


def check(df, rows):
    want = brute(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dup.near_groups(df).collect()}
    assert got == {i: (n, c, c == i) for i, (n, c) in want.items()}
    return want


def test_links_chains_and_shared_passages(documents):
    passage = prose(60, 999)
    rows = [(i, prose(120, i) + " " + passage) for i in range(40)]  # one passage in all, no links
    rows += [(100 + i, edited(500, range(0, 4 * i, 4))) for i in range(12)]  # ever more edits: a chain
    rows += [(200 + i, edited(600, [i * 7, i * 7 + 3])) for i in range(40)]  # copies of one text that differ from each other
    rows += [(300, "One two"), (301, "one TWO"), (302, "one"), (303, None), (304, ""), (305, " \t\n"), (306, None)]
    rows += [(400, prose(30_000, 77)), (401, prose(30_000, 77) + " end")]
    want = check(documents(rows, clash=True), rows)
    assert len({c for _, c in want.values()}) < len(rows) - 40


def test_similarity_at_the_edge(documents):
    # 3 of 4 shingles shared is 75 %, 5 of 7 less
    rows = [(1, "a b c d e f g"), (2, "a b c d e f g h"), (3, "p q r s t u v w x y"), (4, "p q r s t u v w x z z2")]
    check(documents(rows), rows)


def test_empty_table_and_repeated_rows(documents):
    assert near_dup.near_groups(documents([])).count() == 0
    text = prose(50, 1)
    rows = [(1, text), (1, text), (2, text.upper()), (3, text + " more"), (1, text + " more2")]
    got = sorted((r.doc_id, r.component_id) for r in near_dup.near_groups(documents(rows)).collect())
    assert got == [(1, 1), (1, 1), (1, 1), (2, 1), (3, 1)]


def test_keep_one(documents):
    rows = [(2, prose(50, 1)), (1, prose(50, 1) + " x"), (3, prose(50, 2)), (4, None), (5, "")]
    kept = near_dup.keep_one(documents(rows, clash=True))
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 4, 5]


def test_large_group_of_copies_of_copies(documents):
    # copies of one text, copies of the edited copies, and shortened ones: many are no links of the hub's
    rows = [(i, edited(9, range(0, 5 * (i % 13), 5))) for i in range(26)]
    rows += [(50 + i, edited(9, [7 * k + i for k in range(i)])) for i in range(30)]
    rows += [(100 + i, " ".join(words_of(200, 9)[: 120 + 4 * i])) for i in range(20)]
    rows += [(200 + i, " ".join(words_of(200, 9)[6 * i : 6 * i + 110])) for i in range(15)]
    want = check(documents(rows), rows)
    assert len({c for _, c in want.values()}) > 5


def test_hub_differences_lose_no_pair(spark):
    import numpy as np

    draw = np.random.default_rng(4)
    base = np.arange(1, 141, dtype=np.uint64)
    sets = [base]
    for i in range(120):
        near = sets[draw.integers(0, len(sets))]
        cut = near[draw.random(len(near)) > draw.uniform(0, 0.25)]
        sets.append(np.unique(np.append(cut, draw.integers(200, 800, draw.integers(0, 25)).astype(np.uint64))))
    alike = lambda x, y: 100 * len(np.intersect1d(x, y)) >= 75 * len(np.union1d(x, y))
    apart = {i: i + 1 if not alike(s, base) else 0 for i, s in enumerate(sets)}  # those linked to the hub share its label
    held = spark.createDataFrame([(i, bytearray(s.tobytes())) for i, s in enumerate(sets)], "cid long, shingles binary")
    anchors = spark.createDataFrame([(i, label, 0) for i, label in apart.items()], "cid long, label long, anchor long")
    got = {(r.a, r.b) for r in near_dup.anchored_pairs(anchors, held).collect()}
    want = {(i, j) for i in apart for j in apart if i < j and apart[i] != apart[j] and alike(sets[i], sets[j])}
    assert want and want <= got and len(got) < 0.5 * 121 * 60


def test_members_that_meet_share_an_anchor(spark):
    import numpy as np

    draw = np.random.default_rng(5)
    lists = [(value, int(cid), int(cid) % 7 * 3) for value in range(60) for cid in draw.choice(80, draw.integers(2, 9), replace=False)]
    labels = {cid: cid % 30 for cid in range(80)}
    postings = spark.createDataFrame(lists, "value long, cid long, fame long")
    named = spark.createDataFrame(list(labels.items()), "cid long, label long")
    anchors, held = defaultdict(set), defaultdict(set)
    for r in near_dup.open_members(postings, named).collect():
        anchors[r.cid].add(r.anchor)
    for value, cid, _ in lists:
        held[value].add(cid)
    for met in held.values():
        for x in met:
            for y in met:
                assert labels[x] == labels[y] or anchors[x] & anchors[y]
    places = Counter(cid for _, cid, _ in lists)
    assert all(len(a) <= places[cid] for cid, a in anchors.items())  # grows with lists, not with pairs


def test_one_template_in_unlinked_texts(documents):
    # similarity of about 0.6 to one template and to each other: every text stays alone, but for a few true copies
    rows = [(i, " ".join(words_of(160, 5)) + " " + prose(40, 1000 + i)) for i in range(60)]
    rows += [(100 + i, rows[i][1] + " end") for i in range(0, 60, 9)]
    rows += [(200 + i, " ".join(words_of(160, 6)) + " " + prose(38, 3000 + i)) for i in range(30)]
    want = check(documents(rows), rows)
    assert any(c != i for i, (_, c) in want.items()) and sum(c == i for i, (_, c) in want.items()) > 60


@pytest.mark.parametrize("n", [0, 1, 4, 5, 9])
def test_number_of_shingles(documents, n):
    rows = [(1, prose(n, 3))]
    assert near_dup.near_groups(documents(rows)).first().n_shingles == len(shingles(rows[0][1]))
