"""Factor models that need no block of one venue's ratings, and their exact best venues.

Fitting alternates between the two sides. One side's normal equations are sums over ratings of the other
side's outer products, so they can be added up in slices: a venue or user with more than SLICE_ROWS
ratings is cut into slices that land in different tasks, each slice's sum is one small row, and the rows of a
cut one meet before they are solved. No task holds all ratings of anything, and factors are never broadcast: ratings are
dealt once to parts of about PART_RATINGS, packed, and a half step sends a factor once to each part that has a rating of it.

The best items of every user come from items in order of their factors' length, in blocks. By
Cauchy and Schwarz a product is at most the product of the lengths, so a user is done with all blocks from
the first whose longest factor can't reach the user's worst place. A group of users meets a span of items in one
task, block by block, and keeps only its best so far, so products are never rows. The first span's worst places
bound the others. Products are taken in 32 bits to see what may get in, and in 64 bits for what does; a search without
bounds works out every one of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from venuerank.operators.ranking import ordered_position
from venuerank.session import discard, materialise

SLICE_ROWS = 100_000
PART_RATINGS, SMALL_PART = 1_000_000, 20_000  # whose sums are added up in one task, and where there are cores to spare
PACK = 4_096  # ratings to a row
CHUNK = 65_536  # ratings multiplied out at once
SOLVED = 1_024  # rows solved side by side; their matrices stay in a core's cache
SWEEPS = 100  # of coordinate descent at most
BLOCK = 512
USER_ROWS, ITEM_ROWS = 32_768, 131_072  # of a group of users and of a span of items, which meet in one task
LEAST_ROWS, STATE_ROWS = 1_024, 4_194_304  # users worth a group of their own; places held by a group at most
TILE = 1_024  # users multiplied at once; a tile's products stay in a core's cache
FEW = 4  # times top_n entries a user, beyond which a tile looks for its own best first
FINITE = 1e30  # products up to which 32 bits do
SLACK = 1e-9


class Factors(NamedTuple):
    users: DataFrame       # id, features array<double>
    businesses: DataFrame  # id, features array<double>


# --- fitting ---

def solve(sums: np.ndarray, counts: np.ndarray, rank: int, regularisation: float) -> np.ndarray:
    """Non-negative least squares for many rows at once, by coordinate descent.

    A row of `sums` is the upper triangle of a Gram matrix and the right-hand side; the penalty grows with the count.
    """
    found = np.zeros((len(sums), rank))
    for low in range(0, len(sums), SOLVED):
        rows = slice(low, low + SOLVED)
        found[rows] = _solved(np.ascontiguousarray(sums[rows].T), counts[rows], rank, regularisation)
    return found


def _solved(sums: np.ndarray, counts: np.ndarray, rank: int, regularisation: float) -> np.ndarray:
    """`solve` for rows that lie side by side; those that stand still are left out of further sweeps."""
    upper = np.triu_indices(rank)
    gram = np.zeros((rank, rank, len(counts)))
    gram[upper] = gram[upper[1], upper[0]] = sums[: len(upper[0])]
    gram[np.arange(rank), np.arange(rank)] += regularisation * counts
    right = sums[len(upper[0]) :]
    found, place = np.zeros((len(counts), rank)), np.arange(len(counts))
    x = np.zeros((rank, len(counts)))
    for sweep in range(SWEEPS):
        most = np.zeros(len(place))
        for j in range(rank):
            new = np.maximum(0.0, x[j] + (right[j] - np.einsum("km,km->m", gram[j], x)) / gram[j, j])
            np.maximum(most, np.abs(new - x[j]), out=most)
            x[j] = new
        moving = most >= 1e-10
        left = np.count_nonzero(moving)
        if not left or left < 0.75 * len(place):
            found[place[~moving]] = x[:, ~moving].T
            place, x, right, gram = place[moving], x[:, moving], right[:, moving], gram[:, :, moving]
        if not left:
            break
    found[place] = x.T
    return found


def _sums_of(features: np.ndarray, at: np.ndarray, stars: np.ndarray, heads: np.ndarray, counts: np.ndarray, rank: int) -> np.ndarray:
    """The upper triangle of the Gram matrix and the right-hand side of each run of ratings: runs of like length are multiplied together, filled up with zeros."""
    upper = np.triu_indices(rank)
    sums = np.empty((len(heads), len(upper[0]) + rank))
    widths = 1 << np.ceil(np.log2(counts)).astype(np.int64)
    for width in np.unique(widths):
        like = np.flatnonzero(widths == width)
        step = max(1, CHUNK // int(width))
        for low in range(0, len(like), step):
            runs = like[low : low + step]
            inside = np.arange(width) < counts[runs, None]
            rows = np.where(inside, heads[runs, None] + np.arange(width), 0)
            x = np.empty((len(runs), width, rank + 1))
            x[:, :, :rank], x[:, :, rank] = features[at[rows]], stars[rows]
            x[~inside] = 0.0
            met = np.matmul(x.transpose(0, 2, 1), x)
            sums[runs, : len(upper[0])], sums[runs, len(upper[0]) :] = met[:, upper[0], upper[1]], met[:, :rank, rank]
    return sums


def _lists(rows: np.ndarray) -> pa.Array:
    bounds = pa.array(np.arange(len(rows) + 1) * rows.shape[1], pa.int32())
    return pa.ListArray.from_arrays(bounds, pa.array(rows.ravel()))


def _normal_sums(rank: int, regularisation: float):
    """A part's factors and packed ratings become one solved row for each uncut id, and one row of sums for each slice of a cut one."""
    def finished(ids, cut, counts, sums) -> pa.RecordBatch:
        features = solve(sums, counts, rank, regularisation)
        whole = pa.array(cut)
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int32()), pa.array(counts, pa.int64()),
             pc.if_else(whole, _lists(sums), None), pc.if_else(whole, None, _lists(features))],
            names=["id", "n", "sums", "features"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given, packs = [], []
        for batch in batches:
            is_factor = batch.column("other").is_valid()
            given.append(batch.filter(is_factor))
            packs.append(batch.filter(pc.invert(is_factor)))
        if not given:
            return
        known = np.concatenate([r.column("other").to_numpy() for r in given])
        features = np.concatenate([r.column("features").flatten().to_numpy() for r in given]).astype(np.float64).reshape(-1, rank)
        place = np.argsort(known)
        known, features = known[place], features[place]
        ids, slices, cut, others, stars = (
            np.concatenate([r.column(c).flatten().to_numpy(zero_copy_only=False) for r in packs]) for c in ("ids", "slices", "cuts", "others", "stars")
        )
        if not len(known) or not len(ids):
            return
        at = np.minimum(np.searchsorted(known, others), len(known) - 1)
        order = np.lexsort((slices, ids))
        order = order[known[at[order]] == others[order]]  # the rest has no factor on the other side
        if not len(order):
            return
        ids, slices, cut, stars, at = ids[order], slices[order], cut[order], stars[order], at[order]
        heads = np.concatenate(([0], np.flatnonzero((ids[1:] != ids[:-1]) | (slices[1:] != slices[:-1])) + 1))
        counts = np.diff(np.append(heads, len(ids)))
        low = 0
        while low < len(heads):
            high = max(low + 1, int(np.searchsorted(heads, heads[low] + CHUNK)))
            group = heads[low:high]
            yield finished(ids[group], cut[group], counts[low:high], _sums_of(features, at, stars, group, counts[low:high], rank))
            low = high

    return run


def _merge_slices(rank: int, regularisation: float):
    def run(rows: pa.Table) -> pa.Table:
        sums = np.array(rows.column("sums").to_pylist()).sum(0, keepdims=True)
        n = np.array([sum(rows.column("n").to_pylist())])
        return pa.table({"id": rows.column("id").slice(0, 1), "features": _lists(solve(sums, n, rank, regularisation))})

    return run


def _with_slices(ratings: DataFrame, side: str, other: str, slice_rows: int) -> DataFrame:
    """`<side>_slice` and `<side>_cut`: ids of many ratings are dealt to slices by the other side's id."""
    hot = ratings.groupBy(side).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > slice_rows)
    hot = materialise(hot.select(side, F.ceil(F.col("_n") / slice_rows).cast("int").alias("_slices")), "hot-ids")  # at most a slice_rows-th of the ratings
    slices = F.coalesce("_slices", F.lit(1))
    return ratings.join(hot, side, "left").withColumn(f"{side}_slice", F.pmod(F.xxhash64(other), slices).cast("int")).withColumn(f"{side}_cut", slices > 1).drop("_slices")


class Dealt(NamedTuple):
    packs: DataFrame  # part, ids, slices, cuts, others, stars
    links: DataFrame  # other, in_parts: where an id of the other side is needed
    parts: int


def _dealt(ratings: DataFrame, side: str, other: str) -> Dealt:
    """Ratings by the task that adds up the sums of their id and slice; stored."""
    rows = ratings.count()
    parts = max(1, -(-rows // PART_RATINGS), min(ratings.sparkSession.sparkContext.defaultParallelism, -(-rows // SMALL_PART)))
    placed = ratings.withColumn("part", F.pmod(F.xxhash64(side, f"{side}_slice"), F.lit(parts)).cast("int"))
    pack = F.pmod(F.xxhash64(side, other), F.lit(max(1, -(-rows // (parts * PACK))))).alias("pack")
    columns = [F.col(c).alias(name) for c, name in ((side, "ids"), (f"{side}_slice", "slices"), (f"{side}_cut", "cuts"), (other, "others"))]
    packs = placed.groupBy("part", pack).agg(F.collect_list(F.struct(*columns, F.col("stars").cast("double").alias("stars"))).alias("r")).select("part", *[f"r.{name}" for name in ("ids", "slices", "cuts", "others", "stars")])
    links = placed.groupBy(F.col(other).alias("other")).agg(F.collect_set("part").alias("in_parts"))
    return Dealt(materialise(packs, "packed-ratings"), materialise(links, "links"), parts)


def _half(ratings: DataFrame, side: str, other: str, factors: DataFrame, rank: int, regularisation: float) -> DataFrame:
    """`id, features` of one side, given the other's."""
    return _half_of(_dealt(ratings, side, other), factors, rank, regularisation)


def _half_of(dealt: Dealt, factors: DataFrame, rank: int, regularisation: float) -> DataFrame:
    sent = factors.join(dealt.links, F.col("id") == F.col("other")).select(F.explode("in_parts").alias("part"), "other", "features")
    # lists that are not there are empty, as a null one costs the Arrow writer a pass over its batch
    nothing = lambda df, c: F.array().cast(df.schema[c].dataType).alias(c)
    lists = dealt.packs.columns[1:]
    sent = sent.select("part", "other", "features", *[nothing(dealt.packs, c) for c in lists])
    held = dealt.packs.select("part", F.lit(None).cast("int").alias("other"), nothing(factors, "features"), *lists)
    met = sent.unionByName(held).repartitionById(dealt.parts, F.col("part"))
    sums = met.mapInArrow(_normal_sums(rank, regularisation), "id int, n long, sums array<double>, features array<double>")
    sums = materialise(sums, "normal-sums")
    # a cut id has as many rows as slices
    merged = sums.filter("sums IS NOT NULL").select("id", "n", "sums").groupBy("id").applyInArrow(_merge_slices(rank, regularisation), "id int, features array<double>")
    found = materialise(sums.filter("features IS NOT NULL").select("id", "features").unionByName(merged), "factors")
    discard(sums)
    return found


def factorise(
    ratings: DataFrame, rank: int, iterations: int, regularisation: float, seed: int = 42, slice_rows: int = SLICE_ROWS, start: Column | None = None,
) -> Factors:
    """Non-negative factors of `ratings(user_idx, business_idx, stars)`, the penalty weighted by each one's number of ratings.

    `start` gives the venues' first factors from their `id`; without it they are drawn by a hash.
    """
    held = ratings.select(F.col("user_idx").cast("int").alias("user_idx"), F.col("business_idx").cast("int").alias("business_idx"), "stars")
    held = _with_slices(_with_slices(held, "user_idx", "business_idx", slice_rows), "business_idx", "user_idx", slice_rows)
    held = materialise(held, "sliced-ratings")
    drawn = F.transform(F.sequence(F.lit(0), F.lit(rank - 1)), lambda j: (F.pmod(F.xxhash64("id", j, F.lit(seed)), F.lit(1 << 20)) + 1) / float(rank ** 0.5 * (1 << 20)))
    businesses = materialise(held.select(F.col("business_idx").alias("id")).distinct().select("id", (drawn if start is None else start).alias("features")), "factors")
    by_user, by_business = _dealt(held, "user_idx", "business_idx"), _dealt(held, "business_idx", "user_idx")
    discard(held)
    users = None
    for _ in range(iterations):
        new = _half_of(by_user, businesses, rank, regularisation)
        discard(*([users] if users is not None else []))
        users = new
        new = _half_of(by_business, users, rank, regularisation)
        discard(businesses)
        businesses = new
    discard(by_user.packs, by_user.links, by_business.packs, by_business.links)
    return Factors(users, businesses)


def dot(a: str, b: str, rank: int) -> Column:
    """Product of two arrays of `rank` numbers, written out so that it is compiled."""
    return sum((F.get(a, F.lit(j)).cast("double") * F.get(b, F.lit(j)).cast("double") for j in range(1, rank)), F.get(a, F.lit(0)).cast("double") * F.get(b, F.lit(0)).cast("double"))


def predict(ratings: DataFrame, factors: Factors, rank: int) -> DataFrame:
    """`ratings(user_idx, business_idx, ..)` whose user and venue have factors, with `prediction`."""
    users = factors.users.select(F.col("id").alias("user_idx"), F.col("features").alias("_u"))
    businesses = factors.businesses.select(F.col("id").alias("business_idx"), F.col("features").alias("_b"))
    met = ratings.join(users, "user_idx").join(businesses, "business_idx")
    return met.withColumn("prediction", dot("_u", "_b", rank)).drop("_u", "_b")


def penalty_sweep(train: DataFrame, test: DataFrame, rank: int, iterations: int, penalties: list[float], start: Column | None = None) -> DataFrame:
    """`reg_param, rmse, is_best` over the test ratings that each model can score; of equal errors the smallest penalty is best."""
    rows = []
    for penalty in penalties:
        scored = predict(test, factorise(train, rank, iterations, penalty, start=start), rank)
        error = F.col("stars") - F.col("prediction")
        rows.append(scored.agg(F.sqrt(F.avg(error * error)).alias("rmse")).select(F.lit(penalty).alias("reg_param"), "rmse"))
    tried = materialise(reduce(DataFrame.unionByName, rows), "penalties")  # one row a penalty
    best = tried.agg(F.min_by("reg_param", F.struct("rmse", "reg_param"))).scalar()
    return tried.withColumn("is_best", F.col("reg_param") == best)


# --- the best items of every user ---

class Best(NamedTuple):
    rows: DataFrame     # user, item, score, rank
    products: int       # worked out
    possible: int       # users times items

    @property
    def skipped(self) -> float:
        return 1 - self.products / self.possible if self.possible else 0.0


def _length(rank: int) -> Column:
    return F.sqrt(dot("features", "features", rank))


def best_items(users: DataFrame, items: DataFrame, rank: int, top_n: int, block: int = BLOCK, bounded: bool = True) -> Best:
    """The `top_n` items of the greatest product for each of `users(id, features)`, ties to the smaller item id.

    Unless `bounded`, no product is skipped.
    """
    best = best_in_scopes(*[t.select(F.lit(0).alias("scope"), "id", "features") for t in (users, items)], rank, top_n, block, bounded)
    return best._replace(rows=best.rows.drop("scope"))


def best_in_scopes(users: DataFrame, items: DataFrame, rank: int, top_n: int, block: int = BLOCK, bounded: bool = True) -> Best:
    """The same for `users(scope, id, features)` among the `items(scope, id, features)` of their scope; rows have the scope too.

    Neither one scope nor one popular item is a key: groups of at most USER_ROWS users meet groups of at most ITEM_ROWS items.
    """
    spark, long = users.sparkSession, lambda c: F.col(c).cast("long")
    single = all(t.schema["features"].dataType.elementType.typeName() == "float" for t in (users, items))
    whole = F.col("features").cast(f"array<{'float' if single else 'double'}>").alias("features")
    placed = materialise(
        ordered_position(items.select("scope", "id", "features", _length(rank).alias("length")), [F.asc("scope"), F.desc("length"), F.asc("id")], "place"), "top-places"
    )
    scopes = ordered_position(placed.groupBy("scope").agg(F.min("place").alias("start"), F.count(F.lit(1)).alias("items")), [F.asc("scope")], "s")
    asked = users.groupBy("scope").agg(F.count(F.lit(1)).alias("users")).join(scopes, "scope")
    rows = F.least(F.lit(max(1, min(USER_ROWS, STATE_ROWS // top_n))), F.greatest(F.lit(LEAST_ROWS), F.ceil(F.col("users") / spark.sparkContext.defaultParallelism)))
    scopes = materialise(asked.select("*", F.ceil(F.col("users") / rows).cast("int").alias("groups"), F.ceil(F.col("items") / ITEM_ROWS).cast("int").alias("spans")), "top-scopes")
    figures = scopes.agg(F.sum(F.col("users") * F.col("items")).alias("possible"), F.max("spans").alias("spans")).first()
    people = users.join(scopes.select("scope", "s", "groups", "spans"), "scope").select(
        "s", F.pmod(F.xxhash64("id"), F.col("groups")).cast("int").alias("crowd"), "spans", long("id").alias("user"), whole, _length(rank).alias("length")
    )
    people = materialise(people, "top-people")
    at = F.col("place") - F.col("start")
    blocks = placed.join(scopes.select("scope", "s", "start", "groups"), "scope").select(
        "s", "groups", F.floor(at / ITEM_ROWS).cast("int").alias("span"), F.floor(at / block).cast("int").alias("block"), "length", F.struct(long("id").alias("id"), whole).alias("entry"),
    ).groupBy("s", "span", "block").agg(F.max("length").alias("bound"), F.max("groups").alias("groups"), F.collect_list("entry").alias("entries"))
    blocks = blocks.select("s", "span", "block", "bound", "groups", F.col("entries.id").alias("ids"), F.flatten("entries.features").alias("features"))
    blocks = materialise(blocks, "top-blocks")
    tops = materialise(blocks.groupBy("s", "span").agg(F.max("bound").alias("longest")), "top-bounds")

    def met(who: DataFrame, spans: Column) -> DataFrame:
        given = who.select("s", "crowd", "span", F.lit(-1).alias("block"), F.col("least").alias("bound"), F.array("user").alias("ids"), "features")
        offered = blocks.filter(spans).select("s", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("crowd"), "span", "block", "bound", "ids", "features")
        key = ["s", "crowd", "span"]
        dealt = given.unionByName(offered).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *key).sortWithinPartitions(*key, "block")
        return materialise(dealt.mapInArrow(_best_of_groups(rank, top_n, bounded), "s long, user long, item long, score double, products long"), "top-found")

    nobody = F.lit(None).cast("double")
    found = met(people.withColumns({"span": F.lit(0), "least": nobody}), F.col("span") == 0)
    if (figures["spans"] or 0) > 1:
        worst = found.filter("user IS NOT NULL").groupBy("s", "user").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least")).filter(F.col("n") == top_n).drop("n")
        later = people.filter("spans > 1").join(worst, ["s", "user"], "left").withColumn("span", F.explode(F.sequence(F.lit(1), F.col("spans") - 1))).join(tops, ["s", "span"])
        if bounded:
            reach = F.col("length") * F.col("longest") * (1 + SLACK) + SLACK
            later = later.filter(F.col("least").isNull() | (reach >= F.col("least")))
        found = found.unionByName(met(later, F.col("span") > 0))
    kind = items.schema["id"].dataType
    named = found.filter("user IS NOT NULL").join(scopes.select("s", "scope"), "s").select(
        "scope", F.col("user").cast(users.schema["id"].dataType).alias("user"), F.col("item").cast(kind).alias("item"), "score"
    )
    # at most top_n rows of a user from each span
    best_first = Window.partitionBy("scope", "user").orderBy(F.desc("score"), F.asc("item"))
    ranked = named.withColumn("rank", F.row_number().over(best_first)).filter(F.col("rank") <= top_n)
    return Best(ranked, found.agg(F.sum("products")).first()[0] or 0, figures["possible"] or 0)


def _places(flags: np.ndarray) -> np.ndarray:
    """Where flags are set; where few are, eight are looked at in one."""
    if len(flags) % 8:
        return np.flatnonzero(flags)
    words = np.flatnonzero(flags.view(np.uint64))
    near = (words[:, None] * 8 + np.arange(8)).ravel()
    return near[flags[near]]


def _best_of_groups(rank: int, top_n: int, bounded: bool = True):
    """Rows sorted by group, users (block -1) before blocks of items by falling length, become each group's best items and how many products that took."""
    none = np.iinfo(np.int64).max
    rough = (rank + 8) * 2.0 ** -23  # of a reach, by which a 32-bit product may be off

    class Group:
        def __init__(self, key):
            self.key, self.given, self.u, self.products = key, [], None, 0

        def start(self):
            ids, features, least = zip(*self.given) if self.given else ((), (), ())
            self.ids = np.concatenate(ids) if ids else np.zeros(0, np.int64)
            self.u = np.concatenate(features).astype(np.float64) if ids else np.zeros((0, rank))
            self.narrow = self.u.astype(np.float32)
            self.worst = np.concatenate(least) if ids else np.zeros(0)
            self.length = np.sqrt((self.u * self.u).sum(1))
            self.scores = np.full((len(self.ids), top_n), -np.inf)
            self.items = np.full((len(self.ids), top_n), none)
            self.given = []

        def meet(self, ids, v, longest):
            if self.u is None:
                self.start()
            reach = self.length * longest * (1 + SLACK) + SLACK
            active = np.flatnonzero(reach >= self.worst) if bounded else np.arange(len(self.ids))
            self.products += len(active) * len(ids)
            narrow = reach.max(initial=0) < FINITE
            left, right = (self.narrow, v.astype(np.float32).T) if narrow else (self.u, v.T)
            for low in range(0, len(active), TILE):
                rows = active[low : low + TILE]
                # these products may be off, so they only say what may get in
                products, margin = left[rows] @ right, (rough if narrow else SLACK) * reach[rows]
                least = self.worst[rows] - margin
                near = products >= least.astype(products.dtype)[:, None]
                if len(ids) > top_n and np.count_nonzero(near) > FEW * top_n * len(rows):
                    own = np.partition(products, -top_n, axis=1)[:, -top_n]
                    near = products >= np.maximum(least, own - 2 * margin).astype(products.dtype)[:, None]
                r, c = np.divmod(_places(near.ravel()), len(ids))
                score = self.u[rows[r], 0] * v[c, 0]
                for j in range(1, rank):
                    score += self.u[rows[r], j] * v[c, j]
                good = score >= self.worst[rows[r]]
                self.take(rows[r[good]], ids[c[good]], score[good])

        def take(self, rows, ids, scores):
            if not len(rows):
                return
            changed = rows[np.concatenate(([True], rows[1:] != rows[:-1]))]  # rows rise
            all_rows = np.concatenate((np.repeat(changed, top_n), rows))
            all_ids, all_scores = np.concatenate((self.items[changed].ravel(), ids)), np.concatenate((self.scores[changed].ravel(), scores))
            order = np.lexsort((all_ids, -all_scores, all_rows))
            sorted_rows = all_rows[order]
            heads = np.flatnonzero(np.concatenate(([True], sorted_rows[1:] != sorted_rows[:-1])))
            kept = order[(heads[:, None] + np.arange(top_n)).ravel()]  # a changed row has top_n places already
            self.items[changed], self.scores[changed] = all_ids[kept].reshape(-1, top_n), all_scores[kept].reshape(-1, top_n)
            self.worst[changed] = np.maximum(self.worst[changed], self.scores[changed, -1])

        def found(self) -> Iterator[pa.RecordBatch]:
            names = ["s", "user", "item", "score", "products"]
            if self.u is not None:
                for low in range(0, len(self.ids), TILE):
                    held = self.scores[low : low + TILE] > -np.inf
                    users = np.repeat(self.ids[low : low + TILE], held.sum(1))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(users), self.key[0], np.int64)), pa.array(users), pa.array(self.items[low : low + TILE][held]),
                         pa.array(self.scores[low : low + TILE][held]), pa.nulls(len(users), pa.int64())], names=names)
            yield pa.RecordBatch.from_arrays(
                [pa.array([self.key[0]], pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.float64()), pa.array([self.products], pa.int64())], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("s", "crowd", "span")] + [batch.column("block").to_numpy() < 0], 1)
            bounds = batch.column("bound").to_numpy(zero_copy_only=False)
            heads = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]).any(1)))) if len(keys) else []
            for at, to in zip(heads, [*heads[1:], len(keys)]):
                key = tuple(keys[at, :3].tolist())
                if group is None or group.key != key:
                    if group is not None:
                        yield from group.found()
                    group = Group(key)
                if keys[at, 3]:
                    part = batch.slice(at, to - at)
                    group.given.append((
                        part.column("ids").flatten().to_numpy(), part.column("features").flatten().to_numpy().reshape(-1, rank), np.nan_to_num(bounds[at:to].astype(float), nan=-np.inf),
                    ))
                    continue
                for i in range(at, to):
                    ids = batch.column("ids").slice(i, 1).flatten().to_numpy()
                    group.meet(ids, batch.column("features").slice(i, 1).flatten().to_numpy().astype(np.float64).reshape(-1, rank), bounds[i])
        if group is not None:
            yield from group.found()

    return run
