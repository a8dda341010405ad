import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from support import normal, prose
from venuerank.llm import exact_dedup


def check(df, rows, **settings):
    groups = defaultdict(list)
    for i, t in rows:
        groups[normal(t)].append(i)
    want = sorted(
        (i, min(g for g in groups[normal(t)] if g is not None), len(groups[normal(t)]), hashlib.sha256(normal(t).encode()).hexdigest())
        for i, t in rows if i is not None
    )
    got = exact_dedup.exact_groups(df, **settings)
    found = sorted((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got.collect() if r.doc_id is not None)
    assert found == want
    assert all(r.kept == (r.doc_id == r.keep_id) for r in got.collect())


def test_groups_with_odd_rows(documents):
    rows = [(5, "a  b"), (3, "a\tb"), (9, "a b "), (4, None), (2, ""), (8, "x" * 300_000), (1, "x" * 300_000), (7, "a\x0b\n b"), (5, "a b"), (None, "a b")]
    check(documents(rows, clash=True), rows)


def test_empty_table(documents):
    assert exact_dedup.exact_groups(documents([])).count() == 0
    assert exact_dedup.keep_first(documents([])).count() == 0


def test_directory_splits_only_overfull_buckets(spark, documents):
    rows = [(i, prose(5, i % 600)) for i in range(900)]
    df = documents(rows)
    check(df, rows, capacity=20)
    _, index = exact_dedup.build_index(df, 20)
    held = index.groupBy("depth", "bucket").agg(F.count("*").alias("n"), F.min("key").alias("low"), F.max("key").alias("high")).collect()
    assert len({r.depth for r in held}) > 1 and max(r.n for r in held) <= 20
    assert sum(r.n for r in held) == 600


def test_texts_that_collide_are_chained(spark):
    index = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "key long, norm string")
    entries = index.groupBy("key", "norm").count()
    assert entries.count() == 3  # the text, not the key, tells groups apart
    keys = spark.createDataFrame([(1,)] * 3 + [(1 << 62,)], "key long")
    directory = exact_dedup.grow_directory(keys, 1, 4)
    assert {(r.slot, r.depth, r.bits) for r in directory.collect()} == {(0, 2, 2), (1, 2, 2)}
    keyed = spark.createDataFrame([(7, 1, "a"), (3, 1, "b"), (5, 1, "a"), (1, 1 << 62, "c")], "doc_id long, key long, norm string")
    routed = exact_dedup.route(keyed, directory).collect()
    assert sorted((r.bucket, r.key, r.keep_id, r.group_size) for r in routed) == [(0, 1, 3, 1), (0, 1, 5, 2), (1, 1 << 62, 1, 1)]


def test_one_task_owns_a_bucket_and_copies_are_summed_before_the_route(spark, documents):
    rows = [(i, "the same text" if i % 3 == 0 else prose(5, i)) for i in range(900)]
    keyed = documents(rows).select("doc_id", exact_dedup.normalised(F.col("text")).alias("norm")).withColumn("key", F.xxhash64("norm"))
    directory = exact_dedup.grow_directory(keyed, 50)
    bits = directory.first().bits
    assert directory.count() <= 2**bits < 64  # as far as it doubled, not 2**18
    routed = exact_dedup.route(keyed, directory)
    placed = routed.withColumn("task", F.spark_partition_id())
    held = placed.groupBy("depth", "bucket").agg(F.countDistinct("task").alias("tasks"), F.min("key").alias("low"), F.max("key").alias("high"), F.count("*").alias("n")).collect()
    assert len(held) > 8 and all(r.tasks == 1 and r.n <= 50 for r in held)
    for r in held:  # a bucket is the range of keys with its leading bits
        assert r.depth == 0 or {k % 2**64 >> (64 - r.depth) for k in (r.low, r.high)} == {r.bucket}
    plan = routed._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange hashpartitioning(bucket") < plan.rindex("Exchange hashpartitioning(bucket") < plan.index("partial_min")


def test_keep_first_leaves_whole_rows(documents):
    rows = [(2, "a b"), (1, "a  b"), (1, "a  b"), (3, None), (4, "")]
    kept = exact_dedup.keep_first(documents(rows, clash=True))
    assert kept.columns == documents(rows, clash=True).columns
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(1, "a  b"), (3, None)]
