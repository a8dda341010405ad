"""Approximate nearest neighbours by inner product over robust-pruned directed graphs.

Distinct vectors are dealt by hash into shards of about SHARD_ROWS; rows that share a vector are
one node, whose k + 1 smallest ids are kept, which is all a result of k rows can use. A shard's
graph is grown in batches: a greedy beam search from the shard's middle proposes the nodes passed
on the way as neighbours, and pruning keeps one only if no neighbour kept before is nearer to it by
the factor RELAX, so that edges point in diverse directions; edges are then returned and
pruned alike where a node has too many. Points get one more coordinate that makes all norms
of a shard equal, so nearness on the graph agrees with inner products.

Queries travel in blocks, one copy per shard, and meet each shard's stored graph in an equi-join on
the shard. Scores of the beams are computed anew in double precision from the original vectors.

Defined results: vectors null, empty, zero, or with null or non-finite components take no part;
vectors of different dimensions never meet; rows that repeat id and vector count once; ties go to
the smaller vec_id; a query's own id is never among its results; an empty table gives no rows;
columns other than vec_id and embedding are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from venuerank.llm.text import mix
from venuerank.operators.ranking import top_per_group
from venuerank.session import materialise

SHARD_ROWS = 8192
DEGREE = 24
BUILD_BEAM = 48
SEARCH_BEAM = 160
RELAX = 1.2
EXPAND = 4  # nodes of a beam that are expanded at once
BATCH = 256
QUERY_BLOCK = 256


def valid(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


class Graph:
    """A shard's nodes and their out-edges; -1 fills unused places."""

    def __init__(self, vectors: np.ndarray, edges: np.ndarray | None = None, entry: int = 0):
        self.vectors = vectors
        self.edges = np.full((len(vectors), DEGREE + DEGREE // 2), -1, np.int32) if edges is None else edges
        self.entry = entry

    def beam(self, queries: np.ndarray, width: int, products: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Greedy search for all queries at once: (nodes, distances, expanded nodes), nearest first."""
        rows = np.arange(len(queries))[:, None]
        met = np.zeros((len(queries), len(self.vectors) + 1), bool)
        nodes = np.full((len(queries), width), -1, np.int32)
        dist = np.full((len(queries), width), np.inf, np.float32)
        fresh = np.zeros((len(queries), width), bool)
        nodes[:, 0], fresh[:, 0] = self.entry, True
        dist[:, 0] = self.distance(queries, nodes[:, :1], products)[:, 0]
        met[:, self.entry] = met[:, -1] = True
        passed = []
        while fresh.any():
            best = np.argsort(np.where(fresh, dist, np.inf), axis=1, kind="stable")[:, :EXPAND]
            open_ = fresh[rows, best]
            at = np.where(open_, nodes[rows, best], -1)
            passed.append(at)
            fresh[rows, best] = False
            near = np.where(at[:, :, None] >= 0, self.edges[at], -1).reshape(len(queries), -1)
            # a node named twice in one step counts at its first place only
            order = np.argsort(near, axis=1, kind="stable")
            near = near[rows, order]
            near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
            near[met[rows, near]] = -1
            met[rows, near] = True
            new = np.where(near >= 0, self.distance(queries, near, products), np.inf)
            nodes, dist = np.concatenate([nodes, near], 1), np.concatenate([dist, new], 1)
            fresh = np.concatenate([fresh, near >= 0], 1)
            keep = np.argsort(dist, axis=1, kind="stable")[:, :width]
            nodes, dist, fresh = nodes[rows, keep], dist[rows, keep], fresh[rows, keep]
            fresh &= np.isfinite(dist)
        return nodes, dist, np.concatenate(passed, 1)

    def distance(self, queries: np.ndarray, nodes: np.ndarray, products: bool) -> np.ndarray:
        points = self.vectors[nodes]
        inner = np.matmul(points, queries[:, :, None])[:, :, 0]
        return -inner if products else (points * points).sum(-1) - 2 * inner + (queries * queries).sum(-1)[:, None]

    def prune(self, points: np.ndarray, found: np.ndarray) -> np.ndarray:
        """Robust pruning of each point's candidates to DEGREE diverse neighbours."""
        rows = np.arange(len(points))
        own = self.vectors[points]
        dist = self.distance(own, found, False)
        order = np.argsort(found, axis=1, kind="stable")
        ranked = found[rows[:, None], order]
        twice = np.zeros_like(found, bool)
        twice[rows[:, None], order[:, 1:]] = ranked[:, 1:] == ranked[:, :-1]
        dist[(found < 0) | (found == points[:, None]) | twice] = np.inf
        places = self.vectors[found]
        squares = (places * places).sum(-1)
        between = squares[:, :, None] + squares[:, None, :] - 2 * np.matmul(places, places.transpose(0, 2, 1))
        out = np.full((len(points), DEGREE), -1, np.int32)
        for place in range(DEGREE):
            best = dist.argmin(1)
            left = np.isfinite(dist[rows, best])
            if not left.any():
                break
            out[left, place] = found[rows, best][left]
            covered = RELAX * RELAX * between[rows, best] <= dist
            dist[covered & left[:, None]] = np.inf
            dist[rows, best] = np.inf
        return out

    def grow(self) -> None:
        """Insert all nodes in a fixed random order, in batches that double up to BATCH."""
        order = np.argsort(mix(np.arange(len(self.vectors), dtype=np.uint64)))
        middle = self.vectors.mean(0)
        self.entry = int(((self.vectors - middle) ** 2).sum(1).argmin())
        order = np.concatenate([[self.entry], order[order != self.entry]])
        at, size = 1, 1
        while at < len(order):
            points = order[at : at + size]
            _, _, passed = self.beam(self.vectors[points], BUILD_BEAM, False)
            self.edges[points, :DEGREE] = self.prune(points, passed)
            self._return_edges(points)
            at, size = at + size, min(BATCH, size * 2)

    def _return_edges(self, points: np.ndarray) -> None:
        ends = self.edges[points, :DEGREE].ravel()
        starts = np.repeat(points, DEGREE)[ends >= 0]
        ends = ends[ends >= 0]
        order = np.argsort(ends, kind="stable")
        ends, starts = ends[order], starts[order]
        heads, first, counts = np.unique(ends, return_index=True, return_counts=True)
        held = (self.edges[heads] >= 0).sum(1)
        roomy = held + counts <= self.edges.shape[1]
        inner = np.arange(len(ends)) - np.repeat(first, counts)
        put = np.repeat(roomy, counts)
        self.edges[ends[put], (np.repeat(held, counts) + inner)[put]] = starts[put]
        tight = np.flatnonzero(~roomy)
        for a in range(0, len(tight), BATCH):
            part = tight[a : a + BATCH]
            most = int(counts[part].max())
            more = np.full((len(part), most), -1, np.int32)
            for row, i in enumerate(part):
                more[row, : counts[i]] = starts[first[i] : first[i] + counts[i]]
            kept = self.prune(heads[part], np.concatenate([self.edges[heads[part]], more], 1))
            self.edges[heads[part]] = -1
            self.edges[heads[part], :DEGREE] = kept


def _level(vectors: np.ndarray) -> np.ndarray:
    """Float vectors with one more coordinate that makes all norms equal, and none above 1."""
    vectors = vectors / np.abs(vectors).max()
    squares = (vectors * vectors).sum(1)
    top = squares.max()
    return np.concatenate([vectors, np.sqrt(np.maximum(top - squares, 0))[:, None]], 1).astype(np.float32)


def _matrix(lists: pa.Array, dtype: type = np.float64) -> np.ndarray:
    return np.asarray(lists.flatten().to_numpy(zero_copy_only=False), dtype).reshape(len(lists), -1)


def build_graphs(nodes: DataFrame) -> DataFrame:
    """One stored row per shard: its nodes' ids and vectors, edges and entry; a shard has about SHARD_ROWS nodes."""

    def grown(table: pa.Table) -> pa.Table:
        table = table.sort_by("cid")
        original = _matrix(table.column("embedding").combine_chunks())
        graph = Graph(_level(original))
        graph.grow()
        return pa.table(
            {
                "shard": table.column("shard").slice(0, 1), "dim": pa.array([original.shape[1]], pa.int32()), "entry": pa.array([graph.entry], pa.int32()),
                "cids": pa.array([table.column("cid").to_numpy().astype(np.int64).tobytes()], pa.binary()),
                "least": pa.array([table.column("vec_id").to_numpy().astype(np.int64).tobytes()], pa.binary()),
                "vectors": pa.array([original.tobytes()], pa.binary()), "edges": pa.array([graph.edges.tobytes()], pa.binary()),
            }
        )

    schema = "shard string, dim int, entry int, cids binary, least binary, vectors binary, edges binary"
    return materialise(nodes.groupBy("shard").applyInArrow(grown, schema), "nearest-graphs")


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[str, Graph, np.ndarray, np.ndarray, np.ndarray] | None = None
        for batch in batches:
            shards = batch.column("shard").to_pylist()
            for i, shard in enumerate(shards):
                if held is None or held[0] != shard:
                    row = {c: batch.column(c)[i] for c in ("dim", "entry", "cids", "least", "vectors", "edges")}
                    original = np.frombuffer(row["vectors"].as_buffer(), np.float64).reshape(-1, row["dim"].as_py())
                    edges = np.frombuffer(row["edges"].as_buffer(), np.int32).reshape(len(original), -1)
                    held = (shard, Graph(_level(original), edges, row["entry"].as_py()), original, np.frombuffer(row["cids"].as_buffer(), np.int64), np.frombuffer(row["least"].as_buffer(), np.int64))
                _, graph, original, cids, least = held
                ids = np.asarray(batch.column("query_ids")[i].values.to_numpy(), np.int64)
                queries = _matrix(batch.column("query_vectors")[i].values)
                unit = queries / np.abs(queries).max(1, keepdims=True)
                lifted = np.concatenate([unit, np.zeros((len(unit), 1))], 1).astype(np.float32)
                nodes, _, _ = graph.beam(lifted, max(SEARCH_BEAM, 2 * k), True)
                score = np.matmul(original[nodes], queries[:, :, None])[:, :, 0]
                score[nodes < 0] = -np.inf
                best = np.lexsort((least[nodes], -score), axis=1)[:, : k + 1]
                rows = np.arange(len(ids))[:, None]
                real = nodes[rows, best] >= 0
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.broadcast_to(ids[:, None], best.shape)[real]), pa.array(cids[nodes[rows, best]][real]), pa.array(least[nodes[rows, best]][real]), pa.array(score[rows, best][real])],
                    names=["query_id", "cid", "least", "score"],
                )

    return run


def nearest(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id, score: the `k` rows of `vectors` found nearest to each of `queries`."""
    rows = vectors.select("vec_id", "embedding").filter(valid(F.col("embedding")) & F.col("vec_id").isNotNull())
    classes = rows.groupBy("embedding").agg(F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("copies"))
    nodes = materialise(classes.withColumn("cid", F.monotonically_increasing_id()), "nearest-nodes")
    # a dimension has its own shards
    sizes = {r["dim"]: r["n"] for r in nodes.groupBy(F.size("embedding").alias("dim")).agg(F.count(F.lit(1)).alias("n")).collect()}
    dealt = F.pmod(F.xxhash64("cid"), F.element_at(_shards_of(sizes), F.size("embedding")).cast("long"))
    shard = F.concat_ws("/", F.size("embedding"), dealt)
    graphs = build_graphs(nodes.select("cid", "vec_id", "embedding", shard.alias("shard"))) if sizes else None

    asked = queries.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query")).filter(valid(F.col("query")) & F.col("query_id").isNotNull()).distinct()
    if not sizes:
        return asked.select("query_id", F.lit(1).alias("rank"), F.col("query_id").alias("vec_id"), F.lit(0.0).alias("score")).limit(0)
    # blocks of about QUERY_BLOCK queries, each copied to every shard of its dimension
    asked = materialise(asked, "nearest-queries")
    total = asked.count()
    block = F.pmod(F.xxhash64("query_id", "query"), F.lit(max(1, -(-total // QUERY_BLOCK))))
    blocks = asked.groupBy(F.size("query").alias("q_dim"), block.alias("block")).agg(F.collect_list(F.struct("query_id", "query")).alias("q"))
    sent = blocks.withColumn("to", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(F.try_element_at(_shards_of(sizes), F.col("q_dim")), F.lit(0)).cast("long") - 1)))
    sent = sent.filter("to >= 0").select(F.concat_ws("/", "q_dim", "to").alias("shard"), F.col("q.query_id").alias("query_ids"), F.col("q.query").alias("query_vectors"))
    met = sent.join(graphs, "shard").mapInArrow(_search(k), "query_id long, cid long, least long, score double")
    found = materialise(met, "nearest-found")

    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "least")
    best = found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k + 1).drop("place", "least")
    # copies of one vector: only classes of several rows look up their smallest ids
    many = nodes.filter("copies > 1").select("cid", "embedding")
    copies = top_per_group(rows.join(many, "embedding").select("cid", "vec_id").distinct(), ["cid"], [F.col("vec_id")], k + 1, ["vec_id"]).select("cid", "vec_id")
    members = materialise(nodes.filter("copies = 1").select("cid", "vec_id").union(copies), "nearest-members")
    ranked = best.join(members, "cid").filter("vec_id != query_id").dropDuplicates(["query_id", "vec_id", "score"])
    final = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return ranked.withColumn("rank", F.row_number().over(final)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _shards_of(sizes: dict[int, int]) -> Column:
    """Map from a dimension to its number of shards."""
    pairs = [F.lit(x) for dim, n in sorted(sizes.items()) for x in (dim, max(1, -(-n // SHARD_ROWS)))]
    return F.create_map(*pairs) if pairs else F.create_map().cast("map<int,int>")
