"""Shards of near equal bytes by k-d tree partitioning; DataFrame functions only.

Every row is a point in its metadata: length, n_chars, doc_id, and a hash of lang and source. A
node is cut at the weighted median, by bytes, of its widest dimension, until each leaf holds the
target bytes. Medians are found for all nodes of a level at once by sums over ever finer digits
of the coordinate, so no node is sorted or gathered, however many rows share a value: a hash of
the row breaks ties. What reaches the driver is one cut per node, fewer than the shards.

Defined results: a null text weighs one byte; a null coordinate counts as the least; ties and
repeated rows fall to either side by the row's hash; an empty table gives no rows; columns that
the operator doesn't name are ignored, whatever they are called.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venuerank.session import materialise

SHARDS = 8
_COORD_BITS, _TIE_BITS, _DIGIT_BITS = 31, 29, 12
_KEY_BITS = _COORD_BITS + _TIE_BITS  # a multiple of the digit's bits
_INDEX_BITS = 33  # monotonically_increasing_id keeps the row's index in the low 33 bits


def text_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def document_points(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32 and the coordinates d0.. of each document."""
    names = set(docs.columns)
    text = F.coalesce(F.col("text"), F.lit(""))
    size = text_bytes(F.col("text"))
    dims = [F.log2(size)]
    dims += [F.log2(F.col("n_chars") + 1)] if "n_chars" in names else []
    dims += [F.col("doc_id").cast("double")]
    dims += [F.crc32(F.col(c).cast("string")).cast("double") for c in ("lang", "source") if c in names]
    return docs.select(
        "doc_id", size.alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        *[F.when(F.isnan(d), None).otherwise(d).alias(f"d{i}") for i, d in enumerate(dims)],
    )


def _of_node(values: list, node: Column) -> Column:
    """The value of each node, by the node's place in the list."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), node + 1)


def kd_leaves(points: DataFrame, shards: int) -> DataFrame:
    """`points` with its leaf 0..shards-1; `points` must be a stored table with size and d0...

    Column `tie` must be there too: a long of 29 bits, drawn per row.
    """
    dims = [c for c in points.columns if c.startswith("d") and c[1:].isdigit()]
    ends = points.agg(
        *[F.min(d).alias(f"lo_{d}") for d in dims], *[F.max(d).alias(f"hi_{d}") for d in dims]
    ).first()
    top = float((1 << _COORD_BITS) - 1)

    def coordinate(d: str) -> Column:
        low, high = ends[f"lo_{d}"], ends[f"hi_{d}"]
        if low is None or high <= low:
            return F.lit(0).cast("long")
        return F.coalesce(F.round((F.col(d) - low) / (high - low) * top).cast("long"), F.lit(0).cast("long"))

    placed = points.select("*", *[(F.shiftleft(coordinate(d), _TIE_BITS) + F.col("tie")).alias(f"key_{d}") for d in dims])
    node, leaves = F.lit(0), [shards]  # a node is its place in `leaves`, the shards below it
    while max(leaves) > 1:
        level = placed.withColumn("node", node)
        spread = {
            r["node"]: r
            for r in level.groupBy("node")
            .agg(F.sum("size").alias("weight"), *[(F.max(f"key_{d}") - F.min(f"key_{d}")).alias(d) for d in dims])
            .collect()  # one row per node
        }
        widest = [max(dims, key=lambda d, r=spread.get(i): (r[d] if r else 0, -int(d[1:]))) for i in range(len(leaves))]
        key = _of_key(dims, widest, node)
        goal = {i: r["weight"] * (leaves[i] // 2) / leaves[i] for i, r in spread.items()}
        cut = weighted_cuts(level.select("node", "size", key.alias("key")), goal)
        cuts = [cut.get(i, -1) if n > 1 else (1 << _KEY_BITS) for i, n in enumerate(leaves)]
        right = F.when(_of_key(dims, widest, node) > _of_node(cuts, node), 1).otherwise(0)
        starts, below = [], []
        for n in leaves:
            starts.append(len(below))
            below += [n // 2, n - n // 2] if n > 1 else [1]
        placed = materialise(placed.withColumn("next", (_of_node(starts, node) + right).cast("int")), "kd-level")
        placed = placed.drop("node").withColumnRenamed("next", "node")
        node, leaves = F.col("node"), below
    return placed.withColumn("shard", node.cast("int")).drop("node", *[f"key_{d}" for d in dims])


def _of_key(dims: list[str], widest: list[str], node: Column) -> Column:
    keys = F.array(*[F.col(f"key_{d}") for d in dims])
    return F.element_at(keys, _of_node([dims.index(d) + 1 for d in widest], node))


def weighted_cuts(rows: DataFrame, goal: dict[int, float]) -> dict[int, int]:
    """Per node the key up to which rows weigh closest to the node's goal.

    `rows` has node, key, size. Each round fixes one more digit of the key from sums of sizes by
    digit: at most 2**12 sums per node are moved, one row per node returns.
    """
    rows = materialise(rows, "kd-keys")
    prefix, done = {i: 0 for i in goal}, {i: 0.0 for i in goal}
    if not goal:
        return {}
    order = sorted(goal)
    for shift in range(_KEY_BITS - _DIGIT_BITS, -1, -_DIGIT_BITS):
        place = F.array_position(F.array(*[F.lit(i) for i in order]), F.col("node")).cast("int")
        known = F.element_at(F.array(*[F.lit(prefix[i]).cast("long") for i in order]), place)
        sums = (
            rows.filter(F.shiftright("key", shift + _DIGIT_BITS) == known)
            .groupBy("node", F.shiftright("key", shift).bitwiseAND(F.lit((1 << _DIGIT_BITS) - 1)).alias("digit"))
            .agg(F.sum("size").alias("w"))
        )
        # the histogram of a node has at most 2**12 entries: fold it to one row, and let the row
        # carry the first digit at which the running sum reaches what is left of the goal
        entries = sums.groupBy("node").agg(F.array_sort(F.collect_list(F.struct("digit", "w"))).alias("h"))
        want = F.element_at(F.array(*[F.lit(float(goal[i] - done[i])) for i in order]), place)
        start = F.struct(F.lit(0.0).alias("sum"), F.lit(-1).cast("long").alias("digit"), F.lit(0.0).alias("before"))

        def step(acc: Column, x: Column) -> Column:
            open_ = acc["digit"] < 0
            total = acc["sum"] + F.when(open_, x["w"].cast("double")).otherwise(F.lit(0.0))
            hit = open_ & (total >= want)  # noqa: B023
            return F.struct(
                total.alias("sum"), F.when(hit, x["digit"].cast("long")).otherwise(acc["digit"]).alias("digit"),
                F.when(hit, acc["sum"]).otherwise(acc["before"]).alias("before"),
            )

        found = entries.select("node", F.aggregate("h", start, step).alias("r"), F.element_at("h", -1)["digit"].alias("last"))
        for r in found.collect():  # one row per node
            hit = r["r"]["digit"] if r["r"]["digit"] >= 0 else r["last"]
            done[r["node"]] += r["r"]["before"] if r["r"]["digit"] >= 0 else 0.0
            prefix[r["node"]] = (prefix[r["node"]] << _DIGIT_BITS) + hit
    return prefix


def numbered(rows: DataFrame, shard: str = "shard") -> DataFrame:
    """Adds `slot`, gapless from 0 in each shard, without gathering a shard anywhere.

    Rows are range-sorted by shard and tie and stored with their place in the sort partition; a
    partition's share of a shard starts where the partitions before it end.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    stored = materialise(
        rows.repartitionByRange(parts, shard, "tie").sortWithinPartitions(shard, "tie").withColumn("mark", F.monotonically_increasing_id()),
        "kd-sorted",
    ).withColumn("part", F.shiftright("mark", _INDEX_BITS))
    pieces = stored.groupBy("part", shard).agg(F.min("mark").alias("start"), F.count(F.lit(1)).alias("n"))
    # one entry per sort partition and shard in it: partitions + shards rows at most
    runs = pieces.groupBy(shard).agg(F.array_sort(F.collect_list(F.struct("part", "start", "n"))).alias("runs"))
    offsets = runs.select(shard, "runs", F.posexplode("runs").alias("at", "run")).select(
        shard, F.col("run.part").alias("part"), F.col("run.start").alias("start"),
        F.aggregate(F.slice("runs", 1, F.col("at")), F.lit(0).cast("long"), lambda a, x: a + x["n"]).alias("offset"),
    )
    return stored.join(F.broadcast(offsets), ["part", shard]).withColumn(
        "slot", F.col("mark") - F.col("start") + F.col("offset")
    ).drop("part", "start", "offset", "mark")


def kd_shards(docs: DataFrame, shards: int | None = SHARDS, target_bytes: int | None = None) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot; give `target_bytes` in place of a number of shards."""
    tie = F.xxhash64(F.monotonically_increasing_id(), "doc_id").bitwiseAND(F.lit((1 << _TIE_BITS) - 1))
    points = materialise(document_points(docs).withColumn("tie", tie), "kd-points")
    if target_bytes:
        total = points.agg(F.sum("size")).first()[0] or 0
        shards = max(1, -(-total // target_bytes))
    return numbered(kd_leaves(points, shards)).select("doc_id", "size", "text_crc32", "shard", "slot")
