import math
import random
import zlib
from collections import defaultdict

from support import prose
from venuerank.llm import sharding


def check(rows, got, shards):
    assert sorted((str(r.doc_id), r["size"], r.text_crc32) for r in got) == sorted(
        (str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows
    )
    slots, sizes = defaultdict(list), defaultdict(int)
    for r in got:
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(slots) <= set(range(shards))
    largest = max(r["size"] for r in got)
    # each of the cuts on the way to a leaf is off by one row's bytes at most
    assert max(sizes.values()) - min(sizes.get(s, 0) for s in range(shards)) <= 4 * largest
    return sizes


def test_sizes_are_near_equal(documents):
    rows = [(i, prose(1 + (i * 37) % 90, i)) for i in range(2000)]
    check(rows, sharding.kd_shards(documents(rows, clash=True), 8).collect(), 8)


def test_ties_split_too(documents):
    rows = [(7, "same text")] * 1000 + [(i, None) for i in range(300)]
    check(rows, sharding.kd_shards(documents(rows), 8).collect(), 8)


def test_target_bytes_and_odd_shards(documents):
    rows = [(i, "x" * (i % 50)) for i in range(700)] + [(None, "é" * 9), (3, "")]
    total = sum(len((t or "").encode()) + 1 for _, t in rows)
    sizes = check(rows, sharding.kd_shards(documents(rows), target_bytes=total // 5 + 1).collect(), 5)
    assert len(sizes) == 5


def test_few_and_no_rows(documents):
    assert sharding.kd_shards(documents([])).count() == 0
    assert sharding.kd_shards(documents([(1, "a")])).collect()[0].slot == 0


def plain_tree(points, dims, shards, first=0):
    """Row -> leaf of a k-d tree by plain recursion; a point is (row, size, key of each dimension)."""
    if shards == 1:
        return {p[0]: first for p in points}
    widths = [max(p[2][k] for p in points) - min(p[2][k] for p in points) for k in range(dims)]
    widest = widths.index(max(widths))
    goal, total, cut = sum(p[1] for p in points) * (shards // 2) / shards, 0, None
    for p in sorted(points, key=lambda p: p[2][widest]):
        total += p[1]
        if total >= goal:
            cut = p[2][widest]
            break
    low, high = ([p for p in points if (p[2][widest] > cut) == side] for side in (False, True))
    return plain_tree(low, dims, shards // 2, first) | plain_tree(high, dims, shards - shards // 2, first + shards // 2)


def test_leaves_equal_a_plain_tree(spark):
    draw = random.Random(6)
    rows = [(i, draw.randint(1, 900), draw.gauss(0, 1), draw.choice([1.0, 2.0, 5.0]), draw.expovariate(1), draw.randrange(1 << 29)) for i in range(900)]
    points = spark.createDataFrame(rows, "doc_id long, size long, d0 double, d1 double, d2 double, tie long")
    top = float((1 << 31) - 1)
    ends = [(min(r[k] for r in rows), max(r[k] for r in rows)) for k in (2, 3, 4)]
    keyed = [
        (r[0], r[1], [(math.floor((r[k] - low) / (high - low) * top + 0.5) << 29) + r[5] for k, (low, high) in zip((2, 3, 4), ends)])
        for r in rows
    ]
    for shards in (8, 5):
        got = {r.doc_id: r.shard for r in sharding.kd_leaves(points, shards).collect()}
        assert got == plain_tree(keyed, 3, shards)
