"""Postings from cells: a metro's texts meet its venues in tasks, and products never are rows."""

import random
from collections import Counter

import pyarrow as pa
import pytest

from venuerank.operators import search


def plain(said, vectors):
    tf = Counter()
    for venue, metro, text, times in said:
        for term, n in vectors[text].items():
            tf[metro, term, venue] += times * n
    lists = {}
    for (metro, term, venue), n in tf.items():
        lists.setdefault((metro, term), []).append((venue, n))
    return {
        (metro, term, venue, n, len(held), sum(m for _, m in held), venue == min(held)[0])
        for (metro, term), held in lists.items() for venue, n in held
    }


@pytest.fixture(scope="module")
def tables():
    draw = random.Random(5)
    vectors = {f"t{i}": {draw.randrange(300): draw.randrange(1, 4) for _ in range(draw.choice([0, 1, 40]))} for i in range(60)}
    pairs = {(draw.randrange(90), draw.choice(list(vectors))) for _ in range(1500)}
    return [(v, v % 3, t, draw.randrange(1, 5)) for v, t in sorted(pairs)], vectors


@pytest.mark.parametrize("chunk_entries", [10_000, 100])
def test_postings_equal_the_plain_product(spark, tables, chunk_entries):
    said, vectors = tables
    parts = [
        (text, b, [t for t in v if t % search.BUCKETS == b], [n for t, n in v.items() if t % search.BUCKETS == b])
        for text, v in vectors.items() for b in {t % search.BUCKETS for t in v}
    ]
    found = search._postings(
        spark.createDataFrame(said, "venue int, metro int, text_key string, times long"),
        spark.createDataFrame(parts, "text_key string, bucket int, term_id array<int>, tf array<int>"), chunk_entries,
    )
    fields = ("metro", "term_id", "venue", "tf", "doc_count", "corpus_count", "is_first")
    rows = [tuple(r[c] for c in fields) for r in found.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == plain(said, vectors)


def test_a_cell_of_many_products_is_done_in_passes(tables, monkeypatch):
    said, vectors = tables
    here = [s for s in said if s[1] == 0]
    number = {t: i for i, t in enumerate(vectors)}
    columns = {"text": pa.int32(), "a": pa.list_(pa.int32()), "b": pa.list_(pa.int32()), "c": pa.list_(pa.int32())}
    rows = [{"text": number[t], "a": list(v), "b": list(v.values()), "c": None} for t, v in vectors.items() if v]
    rows.append({"text": None, "a": [s[0] for s in here], "b": [number[s[2]] for s in here], "c": [s[3] for s in here]})
    batch = pa.RecordBatch.from_pylist(rows, pa.schema(list(columns.items())))

    def run():
        return [list(r.values()) for b in search._lists_of_cell((pa.scalar(0),), iter([batch])) for r in b.to_pylist()]

    whole = run()
    monkeypatch.setattr(search, "CELL_PRODUCTS", 500)
    monkeypatch.setattr(search, "BATCH", 7)
    assert sorted(run()) == sorted(whole) and {tuple(r) for r in whole} == plain(here, vectors)
