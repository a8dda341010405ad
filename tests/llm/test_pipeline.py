import importlib
import os
import re
from collections import defaultdict

import pytest

import __spark_entry__ as driver
from support import prose
from test_near_dup import brute as linked
from test_suffix_dedup import brute as removed
from test_toxicity import BAD

FOLDER = "/root/testdata/sf0.001"
pipeline = importlib.import_module("corpus_pipeline")


@pytest.fixture
def folder(spark, documents, tmp_path):
    rows = [(i, prose(60 + i % 50, i)) for i in range(120)]
    for i in range(0, 120, 5):
        w = rows[i][1].split()
        rows[i] = (i, " ".join([*w[:9], BAD[i % 4], BAD[(i + 1) % 4], *w[9:], BAD[(i + 2) % 4]]))
    rows += [(200, rows[1][1]), (201, rows[1][1].replace(" ", "  ")), (202, rows[2][1] + " end"), (203, None), (204, ""), (205, None)]
    shared = prose(90, 888)
    rows += [(300 + i, prose(300, 300 + i) + " " + shared + " " + prose(300, 400 + i)) for i in range(3)]
    documents(rows).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, 1, int(i < 120 and i % 5 == 0)) for i, _ in rows]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path), rows


def test_stages_against_brute_force(spark, folder):
    path, rows = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns, held = docs.columns, dict(rows)
    for k, (name, stage) in enumerate(pipeline.STAGES):
        out = f"{path}/stage-{k}"
        stage(spark, docs, path).write.parquet(out)
        docs = spark.read.parquet(out)
        if name != "packing":
            assert docs.columns == columns
            got = {r.doc_id: r.text for r in docs.collect()}
            assert len(got) == docs.count()
        if name == "toxicity":
            assert set(got) == {i for i, _ in rows if not (i < 120 and i % 5 == 0)}
        elif name == "exact_dedup":
            assert set(held) - set(got) == {200, 201, 204, 205}
        elif name == "near_dedup":
            want = linked([(i, t) for i, t in held.items()])
            assert set(got) == {i for i in held if want[i][1] == i} and 202 not in got
        elif name == "suffix_dedup":
            want = removed(list(held.values()), 400)
            assert [len((held[i] or "").encode()) - len((got[i] or "").encode()) for i in held] == [w[1] for w in want]
            assert sum(w[1] for w in want) > 3 * 400 and all(r.n_chars == len(r.text) for r in docs.collect() if r.text is not None)
        held = got
    ends = defaultdict(int)
    for r in docs.collect():
        ends[r.doc_id] += r.length
    assert set(ends) == set(held)


def test_empty_tables(spark, documents, tmp_path):
    documents([]).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_registered():
    names = {f"op{n}_" for n in range(1, 14)}
    assert {q.split("_")[0] + "_" for q in driver.queries() if re.match(r"op\d+_", q)} == names
    assert "pipeline" in driver.queries() and "op1_exact_dedup" in driver.oracle_sql()
