"""Near duplicates by an inverted join over MinHash signature coordinates.

A document's set holds its distinct 5-word shingles. Documents of equal sets form one class. A
class's signature has COORDINATES minima; it is posted under coordinate-value pairs. Two sets of
Jaccard similarity 0.75 agree in each coordinate with probability 0.75, and in fewer than MATCHES
of all with probability under 1e-7, so pairs are sought that agree in MATCHES.

* Prefix: values that no other class has can't collide. Of the s values that others share, any
  pair with MATCHES collisions meets in one of the s - MATCHES + 1 rarest: only these are posted.
* Skip: the long lists are never merged. Pairs met in the short ones are probed for the rest of
  their collisions in the signatures themselves.
* No list is expanded into all its pairs. Each list compares its members with its hub, the one whose
  lists are longest together, such as the text the others are copies of. A pair within one
  component can't change the result, so only members of lists that still hold several
  components go on; each is anchored at the most popular hub it met, and members of a list
  that holds several anchors are anchored at the list's own hub as well. So any two members
  that meet have an anchor in common.
* Members x, y of one anchor b are told by D(m), the shingles that either m or b has but not both:
  they are similar enough exactly if D(x) and D(y) share (g(x) + g(y)) / 14 shingles, where
  g(m) = 7 |D(m)| - |m|, and one of them isn't linked to b. What a member shares with no other
  rules most of them out, and the rest meet in lists of the rarest shared shingles, again a
  prefix.

Every link is confirmed on the full sets. Components come from label propagation with pointer
jumping over tables in the shared folder.

Defined results: null and empty texts, and texts of white space, have no shingles and are linked
with nothing; fewer than five words are one shingle; repeated rows are one class; ties of hubs
fall by class number; an empty table gives no rows; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venuerank.llm.text import Texts, in_batches, mix, seeds, slices, words
from venuerank.session import materialise

WORDS = 5
PERCENT = 75
COORDINATES = 64
MATCHES = 28

_PLACES = seeds(WORDS, 37) | np.uint64(1)
_TIMES = (seeds(COORDINATES, 41) | np.uint64(1))[:, None]
_PLUS = seeds(COORDINATES, 43)[:, None]


def shingle_sets(texts: Texts) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    found = words(texts)
    h, cuts = found.hashes, found.cuts
    whole = np.zeros(max(0, len(h) - WORDS + 1), np.uint64)
    for place, times in enumerate(_PLACES):
        whole += h[place : place + len(whole)] * times
    whole = mix(whole)
    sets = []
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        if b - a >= WORDS:
            sets.append(np.unique(whole[a : b - WORDS + 1]))
        elif b > a:  # a short text is one shingle of its own length
            sets.append(mix((h[a:b] * _PLACES[: b - a]).sum(dtype=np.uint64, keepdims=True) + np.uint64(b - a)))
        else:
            sets.append(h[:0])
    return sets


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """COORDINATES unsigned 32-bit minima per non-empty set, one row each."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *(len(s) for s in sets[:-1])])
    out = np.empty((len(sets), COORDINATES), np.uint32)
    for k in range(COORDINATES):
        out[:, k] = np.minimum.reduceat(flat * _TIMES[k] + _PLUS[k], starts) >> np.uint64(32)
    return out


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("doc_id")
        for part in slices(batch.column("text")):
            sets = shingle_sets(part)
            full = [i for i, s in enumerate(sets) if len(s)]
            sig: list = [None] * len(sets)
            if full:
                rows = signatures([sets[i] for i in full]).view(np.int32)
                for i, row in zip(full, rows):
                    sig[i] = row
            prints = np.array([(s.sum(dtype=np.uint64), mix(s ^ np.uint64(0x5DEECE66D)).sum(dtype=np.uint64)) for s in sets], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [
                    ids.slice(part.first, len(sets)), batch.column("digest").slice(part.first, len(sets)), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(prints[:, 0].view(np.int64)), pa.array(prints[:, 1].view(np.int64)),
                    pa.array(sig, pa.list_(pa.int32())),
                ],
                names=["doc_id", "digest", "n_shingles", "print_a", "print_b", "signature"],
            )


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cids, a, b = batch.column("cid"), batch.column("print_a").to_numpy(), batch.column("print_b").to_numpy()
        for part in slices(batch.column("text")):
            keep, blobs = [], []
            for i, s in enumerate(shingle_sets(part), part.first):
                # rows repeating a doc_id with another text belong to another class
                if s.sum(dtype=np.uint64).view(np.int64) == a[i] and mix(s ^ np.uint64(0x5DEECE66D)).sum(dtype=np.uint64).view(np.int64) == b[i]:
                    keep.append(i)
                    blobs.append(s.tobytes())
            yield pa.RecordBatch.from_arrays([cids.take(pa.array(keep, pa.int64())), pa.array(blobs, pa.binary())], names=["cid", "shingles"])


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for i, (x, y) in enumerate(zip(batch.column("left"), batch.column("right"))):
            x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            x, y = (x, y) if len(x) <= len(y) else (y, x)
            at = np.searchsorted(y, x)
            shared = int((y[np.minimum(at, len(y) - 1)] == x).sum())
            if 100 * shared >= PERCENT * (len(x) + len(y) - shared):
                keep.append(i)
        picked = pa.array(keep, pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("a").take(picked), batch.column("b").take(picked)], names=["a", "b"])


def prefix_postings(classes: DataFrame) -> DataFrame:
    """(value, cid, fame) for the rarest shared values of each class that can still reach MATCHES.

    `fame` is the length of all its lists together.
    """
    value = F.shiftleft(F.col("at").cast("long"), 32) + F.col("v").bitwiseAND(F.lit(0xFFFFFFFF))
    posted = materialise(
        classes.select("cid", F.posexplode("signature").alias("at", "v"))
        .withColumn("v", F.col("v").cast("long")).select("cid", value.alias("value")),
        "near-coordinates",
    )
    # stored, here and below: only a join of two plain shuffles can be split where a value is hot
    lengths = materialise(posted.groupBy("value").agg(F.count(F.lit(1)).alias("length")).filter("length > 1"), "near-lengths")
    ranked = (
        posted.join(lengths, "value")
        .groupBy("cid")
        .agg(F.array_sort(F.collect_list(F.struct("length", "value"))).alias("lists"), F.sum("length").alias("fame"))  # COORDINATES at most
        .filter(F.size("lists") >= MATCHES)
    )
    rarest = F.explode(F.slice("lists", 1, F.size("lists") - (MATCHES - 1)))
    return ranked.select("cid", "fame", rarest.alias("p")).select("p.value", "cid", "fame")


def _collisions(x: str, y: str) -> Column:
    same = F.zip_with(F.col(x), F.col(y), lambda a, b: (a == b).cast("int"))
    return F.aggregate(same, F.lit(0), lambda total, hit: total + hit)


def _alike(x: str, y: str) -> Column:
    """What a link needs of the set sizes."""
    return F.least(x, y) * 100 >= F.greatest(x, y) * PERCENT


def _hubs(postings: DataFrame) -> DataFrame:
    """(value, fame, hub): the most famous member of each list, the largest cid on ties."""
    best = postings.groupBy("value").agg(F.max(F.struct("fame", "cid")).alias("top"))
    return materialise(best.select("value", F.col("top.fame").alias("hub_fame"), F.col("top.cid").alias("hub")), "near-hubs")


def star_pairs(postings: DataFrame, members: DataFrame) -> DataFrame:
    """(a, b): the hub of each list and its other members, of enough collisions over the whole signatures and alike in size."""
    pairs = postings.join(_hubs(postings), "value").filter("cid != hub").select(F.col("hub").alias("a"), F.col("cid").alias("b")).distinct()
    x = members.select(F.col("cid").alias("a"), F.col("n_shingles").alias("n_a"), F.col("signature").alias("s_a"))
    y = members.select(F.col("cid").alias("b"), F.col("n_shingles").alias("n_b"), F.col("signature").alias("s_b"))
    return pairs.join(x, "a").join(y, "b").filter(_alike("n_a", "n_b")).filter(_collisions("s_a", "s_b") >= MATCHES).select("a", "b")


def open_members(postings: DataFrame, labels: DataFrame) -> DataFrame:
    """(cid, label, anchor), stored: members of lists of several components; two that meet in a list share an anchor."""
    named = postings.join(labels, "cid", "left").withColumn("label", F.coalesce("label", "cid"))
    mixed = named.groupBy("value").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high").select("value")
    lists = materialise(named.join(materialise(mixed, "near-mixed"), "value"), "near-open")
    met = materialise(lists.select("value", "cid", "label").join(_hubs(lists), "value"), "near-met")
    top = met.groupBy("cid", "label").agg(F.max(F.struct("hub_fame", "hub")).alias("top")).select("cid", "label", F.col("top.hub").alias("anchor"))
    top = materialise(top, "near-tops")
    several = (
        met.join(top.select("cid", "anchor"), "cid").groupBy("value")
        .agg(F.min("anchor").alias("low"), F.max("anchor").alias("high")).filter("low < high").select("value")
    )
    across = met.join(materialise(several, "near-across"), "value").select("cid", "label", F.col("hub").alias("anchor"))
    return materialise(top.union(across).distinct(), "near-anchors")


def _differences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        deltas, sizes, anchors = [], [], []
        for x, y in zip(batch.column("own"), batch.column("hub_own")):
            x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            deltas.append(np.setxor1d(x, y, assume_unique=True).view(np.int64))
            sizes.append(len(x))
            anchors.append(len(y))
        kept = [batch.column(c) for c in ("anchor", "cid", "label")]
        made = [pa.array(sizes, pa.int64()), pa.array(anchors, pa.int64()), pa.array(deltas, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays([*kept, *made], names=["anchor", "cid", "label", "n", "n_hub", "delta"])


def anchored_pairs(anchors: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b): members of one anchor and different components that may be similar enough, by what tells them from it."""
    own = sets.select("cid", F.col("shingles").alias("own"))
    hub = sets.select(F.col("cid").alias("anchor"), F.col("shingles").alias("hub_own"))
    several = anchors.groupBy("anchor").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high").select("anchor")
    met = anchors.join(materialise(several, "near-several"), "anchor").join(hub, "anchor").join(own, "cid")
    told = materialise(met.mapInArrow(_differences, "anchor long, cid long, label long, n long, n_hub long, delta array<long>"), "near-differences")
    elements = told.select("anchor", "cid", F.explode("delta").alias("element"))
    shared = elements.groupBy("anchor", "element").agg(F.count(F.lit(1)).alias("seen")).filter("seen > 1")
    kept = materialise(elements.join(materialise(shared, "near-shared"), ["anchor", "element"]), "near-kept")
    # g as above; a pair shares no more than what either shares with anyone
    common = kept.groupBy("anchor", "cid").agg(F.array_sort(F.collect_list(F.struct("seen", "element"))).alias("common"))  # one set's shingles
    gap = 7 * F.size("delta") - F.col("n")
    facts = told.join(common, ["anchor", "cid"]).select(
        "anchor", "cid", "label", gap.alias("gap"), F.size("common").alias("most"), "common", (gap > F.col("n_hub")).alias("apart")
    )
    facts = materialise(facts, "near-facts")
    least = materialise(facts.filter("apart").groupBy("anchor").agg(F.min("gap").alias("least")), "near-least")
    able = facts.join(least, "anchor").filter(14 * F.col("most") - F.col("gap") >= F.col("least"))
    need = F.greatest(F.lit(1), F.ceil((F.col("least") + F.col("gap")) / 14).cast("int"))
    posted = able.select("anchor", "cid", "label", "gap", "most", F.explode(F.slice("common", 1, F.col("most") - need + 1)).alias("p"))
    posted = posted.select("anchor", F.col("p.element").alias("element"), F.col("cid").alias("b"), F.col("label").alias("label_b"), F.col("gap").alias("gap_b"), F.col("most").alias("most_b"))
    asked = facts.filter("apart").select("anchor", F.col("cid").alias("a"), F.col("label").alias("label_a"), F.col("gap").alias("gap_a"), F.col("most").alias("most_a"), F.explode("common").alias("p"))
    asked = asked.select("anchor", F.col("p.element").alias("element"), "a", "label_a", "gap_a", "most_a")
    enough = (F.col("label_a") != F.col("label_b")) & (F.col("gap_a") + F.col("gap_b") <= 14 * F.least("most_a", "most_b"))
    p, q = asked.alias("p"), posted.alias("q")
    same = (F.col("p.anchor") == F.col("q.anchor")) & (F.col("p.element") == F.col("q.element"))
    return p.join(q, same & enough).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose full sets are similar enough, stored."""
    left, right = sets.select(F.col("cid").alias("a"), F.col("shingles").alias("left")), sets.select(F.col("cid").alias("b"), F.col("shingles").alias("right"))
    both = pairs.join(left, "a").join(right, "b")
    return materialise(both.mapInArrow(_confirm, "a long, b long"), "near-links")


def components(links: DataFrame) -> DataFrame:
    """(cid, label): the smallest cid reachable, for every cid that has a link; stored."""
    edges = materialise(links.select("a", "b").union(links.select("b", "a")).distinct(), "near-edges")
    labels = materialise(edges.groupBy(F.col("a").alias("cid")).agg(F.min("b").alias("m")).select("cid", F.least("cid", "m").alias("label")), "near-labels")
    while True:
        heard = edges.join(labels.select(F.col("cid").alias("b"), F.col("label").alias("l")), "b").groupBy(F.col("a").alias("cid")).agg(F.min("l").alias("l"))
        near = labels.join(heard, "cid").select("cid", F.least("label", "l").alias("next"), "label")
        # one jump: the label's own label of the round before
        onward = labels.select(F.col("cid").alias("next"), F.col("label").alias("jump"))
        moved = materialise(near.join(onward, "next", "left").select("cid", F.least("next", "jump").alias("next"), "label"), "near-labels")
        labels = moved.select("cid", F.col("next").alias("label"))
        if moved.filter("next != label").isEmpty():
            return labels


def near_groups(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept, and digest, a hash of the text."""
    texts = in_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), text_digest().alias("digest"), "text")
    sketches = materialise(
        texts.mapInArrow(_sketch, "doc_id long, digest long, n_shingles long, print_a long, print_b long, signature array<int>"), "near-sketches"
    )
    key = ["print_a", "print_b", "n_shingles"]
    classes = materialise(
        sketches.filter("n_shingles > 0").groupBy(*key)
        .agg(F.min("doc_id").alias("rep"), F.first("signature").alias("signature"))
        .withColumn("cid", F.monotonically_increasing_id()),
        "near-classes",
    )
    postings = materialise(prefix_postings(classes), "near-postings")
    members = materialise(classes.join(postings.select("cid").distinct(), "cid", "left_semi"), "near-members")
    # null doc_ids are searched for too
    wanted = members.select(F.col("rep").alias("doc_id"), "cid", "print_a", "print_b")
    found = texts.join(wanted, texts["doc_id"].eqNullSafe(wanted["doc_id"])).select(wanted["doc_id"], "cid", "print_a", "print_b", "text")
    sets = materialise(found.dropDuplicates().drop("doc_id").mapInArrow(_full_sets, "cid long, shingles binary"), "near-sets")
    sets = sets.dropDuplicates(["cid"]) if _repeated(sets) else sets

    links = confirmed(star_pairs(postings, members), sets)
    labels = components(links)
    more = confirmed(anchored_pairs(open_members(postings, labels), sets), sets)
    if not more.isEmpty():
        labels = components(links.union(more))

    named = classes.select(*key, "cid", "rep").join(labels, "cid", "left").withColumn("label", F.coalesce("label", "cid"))
    named = materialise(named, "near-named")
    # stored: a component may hold a third of all classes, and only a join of two plain shuffles can be split
    heads = materialise(named.groupBy("label").agg(F.min("rep").alias("component_id")), "near-heads")
    ended = named.join(heads, "label").select(*key, "component_id")
    placed = sketches.join(ended, key, "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return placed.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "digest")


def text_digest() -> Column:
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of `docs`, with all their columns, that stay: those whose doc_id is their component's smallest."""
    gone = near_groups(docs).filter("NOT kept").select(F.col("doc_id").alias("g_id"), F.col("digest").alias("g_digest"))
    packed = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text_digest().alias("digest"))
    dropped = (packed["digest"] == gone["g_digest"]) & packed["doc_id"].eqNullSafe(gone["g_id"])
    return packed.join(gone, dropped, "left_anti").select("row.*")


def _repeated(sets: DataFrame) -> bool:
    """Whether texts that differ only in case or white space repeat a class's first doc_id."""
    return not sets.groupBy("cid").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty()
