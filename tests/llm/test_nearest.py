import numpy as np
import pytest

from venuerank.llm import nearest

SCHEMA = "vec_id long, embedding array<float>, label int, score double, rank int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1.0, 1) for i, v in rows], SCHEMA)


def brute(rows, queries, k):
    good = {(i, tuple(np.float32(v).astype(float).tolist())) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = {}
    for i, q in good:
        if i in queries:
            found = sorted((-float(np.dot(q, v)), j) for j, v in good if j != i and len(v) == len(q))
            out[i] = [(j, -s) for s, j in found[:k]]
    return out


def ask(spark, rows, queries, k):
    df = table(spark, rows)
    got = {}
    for r in sorted(nearest.nearest(df, df.filter(df.vec_id.isin(list(queries))), k).collect(), key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(got[r.query_id])
    return got


def clustered(n, dim=24, seed=0):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(8, dim))
    rows = [centres[i % 8] + draw.normal(size=dim) * (0.3 + i % 3) for i in range(n)]
    return [(i, (v / np.linalg.norm(v) * draw.uniform(0.9, 1.1)).tolist()) for i, v in enumerate(rows)]


def recall(got, want):
    hits = sum(len({j for j, _ in got.get(i, [])} & {j for j, _ in found}) for i, found in want.items())
    return hits / sum(len(found) for found in want.values())


@pytest.mark.parametrize("shard", [10_000, 400])
def test_recall(spark, monkeypatch, shard):
    monkeypatch.setattr(nearest, "SHARD_ROWS", shard)
    rows = clustered(3000)
    queries = set(range(0, 3000, 20))
    got, want = ask(spark, rows, queries, 20), brute(rows, queries, 20)
    assert set(got) == set(want) and all(len(got[i]) == 20 for i in want)
    assert recall(got, want) >= 0.95
    exact = dict(((i, j), s) for i in want for j, s in [(j, float(np.dot(np.float32(rows[i][1]).astype(float), np.float32(rows[j][1]).astype(float)))) for j, _ in got[i]])
    assert all(s == pytest.approx(exact[i, j], rel=1e-12) for i in got for j, s in got[i])
    assert all(list(got[i]) == sorted(got[i], key=lambda x: (-x[1], x[0])) for i in got)


def test_copies_ties_and_odd_vectors(spark):
    rows = [(i, [1.0, 0.0]) for i in range(200)] + [(200, [0.0, 1.0]), (201, [0.5, 0.5]), (202, [-1.0, 0.0])]
    rows += [(300, None), (301, []), (302, [0.0, 0.0]), (303, [float("nan"), 1.0]), (304, [None, 1.0]), (305, [float("inf"), 0.0])]
    rows += [(None, [1.0, 1.0]), (7, [1.0, 0.0]), (400, [1.0, 2.0, 3.0]), (401, [3.0, 2.0, 1.0])]
    queries = {0, 5, 7, 199, 200, 202, 302, 303, 400}
    assert ask(spark, rows, queries, 20) == brute(rows, queries, 20)


def test_few_rows(spark):
    rows = [(0, [1.0, 2.0]), (20, [2.0, 1.0]), (21, [0.5, 0.5])]
    assert ask(spark, rows, {0, 20}, 20) == brute(rows, {0, 20}, 20)
    assert ask(spark, rows[:1], {0}, 20) == {}
    assert ask(spark, [], {0}, 20) == {}


def test_pruning_keeps_diverse_edges():
    points = np.array([[0, 0], [1, 0], [1.1, 0], [0, 1], [0, 1.05], [-3, 0]], np.float32)
    graph = nearest.Graph(points)
    kept = graph.prune(np.array([0]), np.array([[1, 2, 3, 4, 5, 2, -1]], np.int32))[0]
    assert [k for k in kept.tolist() if k >= 0] == [1, 3, 5]
