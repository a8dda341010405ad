"""Spelling variants: words one letter apart, grouped under the far more frequent one.

Words are the runs of letters of whole texts, counted with map-side sums; one run in SLIPS, by a hash of
document and run, loses a letter first. Two words are near if one inserted, deleted or replaced letter
makes one of the other. They are found by a trie of frequency vectors:

1. A word's letters fall into GROUPS groups, and its path in the trie is its count in each group, one
   level after another. One edit takes a letter from at most one group and adds one to at most one
   other, so a search may spend a deficit of one and a surplus of one on its way down. Of two near
   words one finds the other by spending the deficit first, so a search never spends the surplus
   first: each pair is met once, and words of one path are compared in their order.
2. The first levels of the trie are dealt to tasks: every word is at home in the shard of its counts
   there, and goes searching in each shard it can reach within the budget. The levels used are as many of
   SHARD_LEVELS as make every shard at most SHARD_WORDS words.
3. In its task a shard's lower levels are searched depth first, all words that reached a node at
   once; nodes of at most LEAF words are leaves, whose words are verified letter by letter.
4. A shard that all levels leave larger than SHARD_WORDS holds words of equal counts throughout. Its
   words meet by what is left of them without one letter, which is exact too and needs no large task.

Each word's near words are then counted, with the most frequent one as its form where that one is FACTOR
times as frequent; roots follow forms by pointer doubling, at most log2 of a chain that grows in
frequency by FACTOR each step.

Defined results: a null text has no runs; a null doc_id is written as an empty one; repeated rows are
separate occurrences, cut alike; runs and words of any length count; of equally frequent near words the first
in code-point order is the form; an empty table gives no rows; columns other than doc_id and text are
ignored.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venuerank.llm.text import in_batches, mix, seeds
from venuerank.session import materialise

RUN = r"[A-Za-zÀ-ÿ]"
LEAST_LETTERS = 7
LEAST_COUNT = 2
SLIPS = 31
FACTOR = 10
GROUPS = 16
SHARD_LEVELS = (3, 5, 8, 12, GROUPS)  # how many levels may be dealt to tasks
SHARD_WORDS = 8_000
LEAF = 24
PROBES = 20_000  # words searching a shard at once
PAIR_BYTES = 1 << 22  # letters compared at once
_LEVEL_SALT = seeds(GROUPS, 131)


def occurrences(docs: DataFrame, least: int = LEAST_LETTERS) -> DataFrame:
    """`word` of every run long enough to give one: lower-cased, and less a letter where the hash says so."""
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(f"{RUN}{{{least},}}"), F.lit(0))).alias("run"))
    lowered = runs.select("doc_id", F.translate("run", string.ascii_uppercase, string.ascii_lowercase).alias("run"))
    return lowered.select(slipped(F.col("doc_id"), F.col("run")).alias("word")).filter(F.length("word") >= least)


def slipped(doc_id: Column, run: Column) -> Column:
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    rest = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(h % SLIPS == 0, rest).otherwise(run)


def counted_words(docs: DataFrame) -> DataFrame:
    """`word, n` of every word that occurs LEAST_COUNT times."""
    return occurrences(docs).groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= LEAST_COUNT)


# --- frequency vectors ---

def letters(words: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(letters, bounds): word i is letters[bounds[i]:bounds[i + 1]]; all letters lie below U+0100."""
    raw = [w.encode("latin-1") for w in words.to_pylist()]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(w) for w in raw]))).astype(np.int64)


def frequency_vectors(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Each word's letters counted by group, one row a word."""
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    flat = np.bincount(row * GROUPS + data % GROUPS, minlength=(len(bounds) - 1) * GROUPS)
    return flat.reshape(-1, GROUPS).astype(np.int32)


def shard_keys(vectors: np.ndarray, levels: int) -> np.ndarray:
    """64-bit key of the path through the first levels, built level by level; column l has the key at depth l + 1."""
    out = np.zeros((len(vectors), levels), np.uint64)
    key = np.zeros(len(vectors), np.uint64)
    for level in range(levels):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + vectors[:, level].astype(np.uint64) + _LEVEL_SALT[level])
        out[:, level] = key
    return out


def reached(vectors: np.ndarray, levels: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, spent, key) of every path within the budget: spent 0 nothing, 1 the deficit, 2 the surplus after it."""
    rows = np.arange(len(vectors))
    found = [(rows, np.zeros(len(rows), np.int8), shard_keys(vectors, levels)[:, -1])]
    for i in range(levels):
        some = rows[vectors[:, i] > 0]
        less = vectors[some].copy()
        less[:, i] -= 1
        found.append((some, np.ones(len(some), np.int8), shard_keys(less, levels)[:, -1]))
        for j in range(i + 1, levels):
            more = less.copy()
            more[:, j] += 1
            found.append((some, np.full(len(some), 2, np.int8), shard_keys(more, levels)[:, -1]))
    return tuple(np.concatenate(part) for part in zip(*found))


# --- the search within a shard ---

def one_edit(data: np.ndarray, bounds: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether words a[i] and b[i] differ by one inserted, deleted or replaced letter; a is as long as b, or longer."""
    size, least = bounds[a + 1] - bounds[a], bounds[b + 1] - bounds[b]
    out = np.zeros(len(a), bool)
    order = np.argsort(size, kind="stable")
    at = 0
    while at < len(order):
        # pairs of about one length are compared as a matrix
        to = min(len(order), at + max(1, PAIR_BYTES // max(1, int(size[order[at]]))))
        while to > at + 1 and (to - at) * int(size[order[to - 1]]) > 2 * PAIR_BYTES:
            to = at + (to - at + 1) // 2
        part = order[at:to]
        width = int(size[part[-1]])
        place = np.arange(width)
        x, y = (np.where(place < n[part][:, None], data[np.minimum(bounds[w[part]][:, None] + place, len(data) - 1)], 0) for w, n in ((a, size), (b, least)))
        differs = x != y
        first = np.where(differs.any(1), differs.argmax(1), width)
        # behind the first difference the longer word goes on one letter later
        shifted = np.concatenate([x[:, 1:], np.zeros((len(part), 1), x.dtype)], 1)
        rest = np.where((size[part] > least[part])[:, None], shifted, x)
        after = place >= (first + (size[part] == least[part]))[:, None]
        gap = size[part] - least[part]
        out[part] = ((rest == y) | ~after).all(1) & np.where(gap == 0, first < width, gap == 1)
        at = to
    return out


class Shard:
    """The lower levels of the paths of a shard's words, sorted."""

    def __init__(self, lower: np.ndarray):
        self.depth = lower.shape[1]
        self.order = np.lexsort(lower.T[::-1]) if self.depth else np.arange(len(lower))
        self.paths = np.ascontiguousarray(lower[self.order])

    def search(self, probes: np.ndarray, spent: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(probe, word of the shard) of every pair whose paths agree within the budget."""
        stack = [(0, 0, len(self.paths), np.arange(len(probes)), spent)]
        while stack:
            level, low, high, mine, used = stack.pop()
            if not len(mine) or low == high:
                continue
            if level == self.depth or high - low <= LEAF:
                yield from self._leaf(level, low, high, mine, used, probes)
                continue
            column = self.paths[low:high, level]
            starts = np.concatenate(([0], np.flatnonzero(column[1:] != column[:-1]) + 1, [high - low]))
            own = probes[mine, level]
            for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
                step = column[a] - own
                go = (step == 0) | ((step == -1) & (used == 0)) | ((step == 1) & (used == 1))
                stack.append((level + 1, low + a, low + b, mine[go], used[go] + np.abs(step[go]).astype(np.int8)))

    def _leaf(self, level: int, low: int, high: int, mine: np.ndarray, used: np.ndarray, probes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        block = max(1, PAIR_BYTES // 4 // (high - low))
        for at in range(0, len(mine), block):
            who, state = mine[at : at + block], np.repeat(used[at : at + block, None], high - low, axis=1)
            alive = np.ones(state.shape, bool)
            for k in range(level, self.depth):
                step = self.paths[low:high, k][None, :] - probes[who, k][:, None]
                alive &= (step == 0) | ((step == -1) & (state == 0)) | ((step == 1) & (state == 1))
                state = state + np.abs(step).astype(np.int8)
            i, j = np.nonzero(alive)
            yield who[i], self.order[low + j]


def _search(levels: int):
    """Rows come sorted by shard, the words at home there before those that search it."""

    def pairs(home: pa.Table, visitors: pa.Table) -> pa.RecordBatch:
        data, bounds = letters(home.column("word"))
        own, ends = letters(visitors.column("word"))
        paths, mine = frequency_vectors(data, bounds), frequency_vectors(own, ends)
        both, spans = np.concatenate([own, data]), np.concatenate([ends, bounds[1:] + len(own)])
        found = [(np.empty(0, np.int64), np.empty(0, np.int64))]
        for i, j in Shard(paths[:, levels:]).search(mine[:, levels:], visitors.column("spent").to_numpy()):
            near = one_edit(both, spans, i, j + len(visitors))
            found.append((i[near], j[near]))
        i, j = map(np.concatenate, zip(*found))
        # words of one path find each other, and the later one counts; words of two paths are met once
        one_path = np.flatnonzero((mine[i] == paths[j]).all(1))
        a, b = visitors.column("word").take(pa.array(i[one_path])).to_pylist(), home.column("word").take(pa.array(j[one_path])).to_pylist()
        keep = np.ones(len(i), bool)
        keep[one_path] = [x > y for x, y in zip(a, b)]
        columns = [t.column(c).take(pa.array(k[keep])).combine_chunks() for t, k in ((visitors, i), (home, j)) for c in ("word", "n")]
        return pa.RecordBatch.from_arrays(columns, names=["a", "n_a", "b", "n_b"])

    def serve(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        keys, spent = rows.column("key").to_numpy(), rows.column("spent").to_numpy()
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for low, high in zip(cuts[:-1], cuts[1:]):
            middle = low + int(np.searchsorted(spent[low:high], 0))
            if low < middle < high:
                home = rows.slice(low, middle - low)
                for at in range(middle, high, PROBES):
                    yield pairs(home, rows.slice(at, min(PROBES, high - at)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            held.append(batch)
            size += len(batch)
            if size < PROBES:
                continue
            rows = pa.Table.from_batches(held)
            last = int(np.searchsorted(rows.column("key").to_numpy(), batch.column("key")[-1].as_py()))
            yield from serve(rows.slice(0, last))
            rows = rows.slice(last)  # the shard that may go on
            home = int(np.searchsorted(rows.column("spent").to_numpy(), 0))
            if len(rows) - home >= PROBES:
                yield from serve(rows)  # only its words at home are still needed
                rows = rows.slice(0, home)
            held, size = rows.to_batches(), max(0, len(rows) - home)
        if held:
            yield from serve(pa.Table.from_batches(held))

    return run


def _entries(levels: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, counts = batch.column("word"), batch.column("n")
            vectors = frequency_vectors(*letters(words))
            row, spent, key = reached(vectors, levels)
            own = np.arange(len(batch))
            row = np.concatenate([own, row])
            key = np.concatenate([shard_keys(vectors, levels)[:, -1], key])
            spent = np.concatenate([np.full(len(batch), -1, np.int8), spent])
            index = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.view(np.int64)), pa.array(spent), words.take(index), counts.take(index)], names=["key", "spent", "word", "n"]
            )

    return run


def _shard_sizes(words: DataFrame) -> DataFrame:
    """`level, key, words` of every node of the trie at the levels of SHARD_LEVELS."""
    wanted = np.array(SHARD_LEVELS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = shard_keys(frequency_vectors(*letters(batch.column("word"))), GROUPS)[:, wanted - 1]
            levels = np.tile(wanted, len(keys))
            yield pa.RecordBatch.from_arrays([pa.array(levels, pa.int32()), pa.array(keys.ravel().view(np.int64))], names=["level", "key"])

    return words.select("word").mapInArrow(run, "level int, key long").groupBy("level", "key").agg(F.count(F.lit(1)).alias("words"))


def near_pairs(words: DataFrame) -> DataFrame:
    """`a, n_a, b, n_b` of each two near words of the stored `words(word, n)`, once."""
    sizes = materialise(_shard_sizes(words), "spelling-nodes")
    largest = {r["level"]: r["most"] for r in sizes.groupBy("level").agg(F.max("words").alias("most")).collect()}  # one row a level
    levels = next((k for k in SHARD_LEVELS if largest.get(k, 0) <= SHARD_WORDS), GROUPS)
    entries = in_batches(words).mapInArrow(_entries(levels), "key long, spent byte, word string, n long")
    heavy = None
    if largest.get(levels, 0) > SHARD_WORDS:
        entries = materialise(entries, "spelling-entries")
        heavy = materialise(sizes.filter((F.col("level") == levels) & (F.col("words") > SHARD_WORDS)).select("key"), "spelling-heavy")
        crowded = entries.join(heavy, "key")
        entries = entries.join(heavy, "key", "left_anti")
    parts = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = entries.repartition(parts, "key").sortWithinPartitions("key", "spent")
    found = dealt.mapInArrow(_search(levels), "a string, n_a long, b string, n_b long")
    return found if heavy is None else found.unionByName(_pairs_by_remains(materialise(crowded, "spelling-crowded")))


def _pairs_by_remains(entries: DataFrame) -> DataFrame:
    """Pairs of shards too large for a task, whose words have equal counts: joined by what is left without one letter."""
    place = F.explode(F.sequence(F.lit(1), F.length("word"))).alias("place")
    without = F.concat(F.substring(F.col("word"), F.lit(1), F.col("place") - 1), F.substring(F.col("word"), F.col("place") + 1, F.length("word")))
    home, visitors = entries.filter("spent = -1"), entries.filter("spent >= 0")
    cut = lambda df, word, n: df.select("word", "n", place).select(F.col("word").alias(word), F.col("n").alias(n), "place", without.alias("rest"))
    ours, theirs = cut(visitors.filter("spent <> 1"), "a", "n_a"), cut(home, "b", "n_b")
    same_path = visitors.filter("spent = 0").select(F.col("word").alias("a")).distinct()
    replaced = ours.join(theirs, ["place", "rest"]).filter("a <> b").select("a", "n_a", "b", "n_b").distinct()
    # of words of one path the later finds the earlier, others are met once
    one_path = replaced.join(same_path, "a", "left_semi").filter("a > b")
    other = replaced.join(same_path, "a", "left_anti")
    longer = cut(visitors.filter("spent = 1"), "a", "n_a").select("a", "n_a", F.col("rest").alias("b")).distinct()
    deleted = longer.join(home.select(F.col("word").alias("b"), F.col("n").alias("n_b")), "b").select("a", "n_a", "b", "n_b")
    return one_path.unionByName(other).unionByName(deleted)


# --- groups ---

def variants(words: DataFrame) -> DataFrame:
    """`word, form, root, n, n_near, form_n` of every row of `words(word, n)`."""
    words = materialise(words, "spelling-words")
    pairs = materialise(near_pairs(words), "spelling-pairs")
    sides = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("near_n"))
    )
    best = sides.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    grouped = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(-F.col("best.less") >= FACTOR * F.col("n"), F.struct(F.col("best.near").alias("form"), (-F.col("best.less")).alias("form_n"))).alias("up"),
    ).select("word", "n", "n_near", "up.form", "up.form_n")
    grouped = materialise(grouped, "spelling-forms")
    roots = _roots(grouped.filter("form IS NOT NULL").select("word", F.col("form").alias("root")))
    return grouped.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(up: DataFrame) -> DataFrame:
    """`word, root` with each pointer followed to its end. A pointer goes to a word FACTOR times as frequent, so chains are short."""
    up = materialise(up, "spelling-roots")
    while True:
        # targets that point on themselves; each is asked for once however many words point to it
        ends = up.select(F.col("root").alias("word")).distinct()
        further = materialise(ends.join(up, "word").select(F.col("word").alias("root"), F.col("root").alias("next")), "spelling-further")
        if not further.take(1):
            return up
        up = materialise(up.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "spelling-roots")


def grouped_variants(docs: DataFrame) -> DataFrame:
    return variants(counted_words(docs.select("doc_id", "text")))
