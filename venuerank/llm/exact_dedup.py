"""Exact duplicates by an extendible-hash index kept on shared files; DataFrame functions only.

A text's key is a 64-bit hash of its normalised bytes. A directory maps the leading bits of a
key to a bucket: it doubles (one more bit) as long as a bucket holds more keys than `capacity`,
and only overfull buckets are split. Texts then go where the directory sends them: each is looked
up in it, copies are summed on the map side by (bucket, key, whole text), and one task owns all
entries of a bucket, a range of keys. Whole texts are compared, never the key alone, so texts
that collide on a key become separate entries of the chain that the owner makes of them. The
index, one entry per distinct text in bucket order, is a table in the shared folder; rows find
their entry by bucket, key and digest.

Defined results: a null text counts as empty; empty texts are equal to each other; of equal texts
the smallest doc_id stays, a null one only where the group has no other; repeated rows are members of
one group like any other; an empty table gives no rows; columns other than `doc_id` and `text`
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from venuerank.session import materialise

# At most 2**18 directory slots, so the broadcast directory stays within a few MB at any input;
# buckets still overfull at this depth keep all their entries as a longer chain.
MAX_DEPTH = 18
CAPACITY = 4_000

# Runs of white space that differ from a single blank; replacing only these equals replacing every
# run of [\x20\x09-\x0D] by one space, with far fewer matches.
_UNTIDY = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), _UNTIDY, " ")


def leading_bits(key: Column, bits: int) -> Column:
    """The top `bits` of a 64-bit key as a number from 0."""
    return F.shiftrightunsigned(key, 64 - bits) if bits else F.lit(0).cast("long")


def grow_directory(keys: DataFrame, capacity: int, max_depth: int = MAX_DEPTH) -> DataFrame:
    """slot -> (depth, bucket): the occupied slots of the directory, of as many bits as the deepest bucket; stored.

    Each doubling counts the keys below the overfull buckets by one more bit. The counts are kept
    as a table of at most ``2**max_depth`` rows, so a round never touches the keys again.
    `bucket` is the leading `depth` bits of its keys, and `bits` the directory's own depth.
    """
    slots = materialise(
        keys.select("key").distinct().groupBy(leading_bits(F.col("key"), max_depth).alias("slot")).agg(F.count(F.lit(1)).alias("n")),
        "directory-slots",
    )
    depth, settled = 0, None
    open_slots = slots
    while True:
        bucket = F.shiftright("slot", max_depth - depth)
        filled = open_slots.groupBy(bucket.alias("bucket")).agg(F.sum("n").alias("held"))
        placed = open_slots.withColumn("bucket", bucket).join(filled, "bucket")
        fits = F.lit(True) if depth == max_depth else F.col("held") <= capacity
        rounds = materialise(placed.select("slot", "n", "bucket", fits.alias("fits")), "directory")
        closed = rounds.filter("fits").select("slot", F.lit(depth).alias("depth"), "bucket")
        settled = closed if settled is None else settled.unionByName(closed)
        open_slots = rounds.filter("NOT fits").select("slot", "n")
        if open_slots.isEmpty():
            break
        depth += 1
    slot = F.shiftright("slot", max_depth - depth)
    return materialise(settled.select(slot.alias("slot"), "depth", "bucket", F.lit(depth).alias("bits")).distinct(), "directory-final")


def looked_up(keyed: DataFrame, directory: DataFrame) -> DataFrame:
    """`keyed` with the depth and bucket that the directory names for each key."""
    first = directory.first()
    slot = leading_bits(F.col("key"), first.bits if first else 0)
    # at most 2**MAX_DEPTH rows, as many as the directory has doubled to
    return keyed.withColumn("slot", slot).join(F.broadcast(directory.drop("bits")), "slot").drop("slot")


def route(keyed: DataFrame, directory: DataFrame) -> DataFrame:
    """One row per distinct text with keep_id and group_size, all of a bucket in the task that owns it."""
    # the whole text is part of the grouping key: copies meet in map-side sums, so a text that a
    # third of all rows repeat is sent once per map task
    entries = looked_up(keyed, directory).groupBy("bucket", "depth", "key", "norm").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    return entries.select("bucket", "depth", "key", F.sha2(F.col("norm"), 256).alias("text_sha256"), "keep_id", "group_size").repartition("bucket", "depth")


def build_index(docs: DataFrame, capacity: int = CAPACITY) -> tuple[DataFrame, DataFrame]:
    """(rows, index): every row's key, place in the directory and digest, and the stored index of distinct texts.

    `rows` has doc_id, key, text_sha256, depth, bucket; `index` has bucket, depth, key, chain (0 for the
    first text of a key), text_sha256, keep_id, group_size.
    """
    texts = docs.select(F.col("doc_id"), normalised(F.col("text")).alias("norm"))
    keyed = texts.withColumn("key", F.xxhash64("norm"))
    rows = materialise(
        keyed.select("doc_id", "key", F.sha2(F.col("norm"), 256).alias("text_sha256")), "dedup-rows"
    )
    directory = grow_directory(rows, capacity)
    chain = Window.partitionBy("bucket", "depth", "key").orderBy("text_sha256")
    owned = (
        route(keyed, directory)
        .withColumn("chain", F.row_number().over(chain) - 1)
        .withColumn("before", F.lag("text_sha256").over(chain))
    )
    # rows find their entry by key and digest; two texts of one digest would make that wrong
    index = owned.withColumn(
        "text_sha256",
        F.when(F.col("before") == F.col("text_sha256"), F.raise_error(F.lit("two texts share a SHA-256"))).otherwise(F.col("text_sha256")),
    ).drop("before")
    return looked_up(rows, directory), materialise(index.sortWithinPartitions("depth", "bucket", "key", "chain"), "dedup-index")


def exact_groups(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256, and the entry's bucket, depth, chain.

    Rows that repeat one doc_id with equal texts all say kept; `keep_first` leaves one of them.
    """
    rows, index = build_index(docs, capacity)
    return rows.join(index, ["bucket", "depth", "key", "text_sha256"]).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256",
        "bucket", "depth", "chain",
    )


def keep_first(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The rows of `docs`, with all their columns, that stay: one per group of equal texts."""
    rows, index = build_index(docs, capacity)
    stay = index.select(F.col("key").alias("s_key"), F.col("text_sha256").alias("s_sha"), F.col("keep_id").alias("s_id"))
    norm = normalised(F.col("text"))
    packed = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", F.xxhash64(norm).alias("key"), F.sha2(norm, 256).alias("sha"))
    same = (packed["key"] == stay["s_key"]) & (packed["sha"] == stay["s_sha"]) & packed["doc_id"].eqNullSafe(stay["s_id"])
    kept = packed.join(stay, same, "left_semi")
    again = rows.groupBy("doc_id", "text_sha256").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    if not again.isEmpty():  # rows that repeat both id and text
        kept = kept.groupBy("key", "sha").agg(F.min("row").alias("row"))
    return kept.select("row.*")
