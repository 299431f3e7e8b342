"""Approximate nearest neighbours by largest inner product: one hierarchical navigable small-world graph per shard.

Equal vectors are indexed once, with their smallest ids (k + 1 of them, which is all a top-k list with ties to smaller ids can
need), so a vector that a third of all rows share is one node. Distinct vectors are dealt to shards of about ``SHARD`` by hash. A shard's graph is
a few flat neighbour arrays, one per layer, kept in a table; building and searching work on blocks of vectors at once.

Vectors get one more coordinate that makes all norms of the shard equal: nearest by angle there is largest inner product here.
Nodes are linked to diverse near nodes: one is taken if no chosen one is nearer to it than the node itself. The queries travel to the shards, in
blocks of ``QUERY_BLOCK``: a shard is sent once for every ``ASKED`` queries, so with a given query set the shuffle grows as the vectors do. The shard
results are merged by a ranked window. Scores are computed in double precision on the original vectors.

Edge cases: vectors that are null, empty, zero, or hold null or non-finite components take no part, nor do null ids; vectors are
compared with those of their own dimension only; repeated rows count once; different vectors under one id are each a candidate and, asked for, share
the list of that id, which leaves out all of them; fewer than k candidates give a shorter list; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.common import keep

SHARD = 8192
QUERY_BLOCK = 1024
ASKED = 16_384
LINKS = 16
EF_BUILD = 80
EF_SEARCH = 160
BLOCK = 512


class Layer:
    """Nodes ``nodes`` (numbers in the shard) of one layer, their vectors and their neighbours (local numbers, -1 where none)."""

    def __init__(self, nodes: np.ndarray, x: np.ndarray, degree: int, near: np.ndarray | None = None):
        self.nodes, self.x, self.degree = nodes, x, degree
        self.near = np.full((len(nodes), degree), -1, np.int32) if near is None else near

    def search(self, q: np.ndarray, entry: np.ndarray, ef: int, width: int = 4) -> tuple[np.ndarray, np.ndarray]:
        """Best-first search for all rows of ``q`` together: (local numbers, similarities), best first, -1 where none."""
        n = len(q)
        seen = np.zeros((n, len(self.nodes)), bool)
        ids = np.full((n, ef), -1, np.int64)
        sims = np.full((n, ef), -np.inf, np.float32)
        done = np.ones((n, ef), bool)
        rows = np.arange(n)
        ids[:, 0] = entry
        sims[:, 0] = np.einsum("qd,qd->q", self.x[entry], q)
        done[:, 0] = False
        seen[rows, entry] = True
        while True:
            pick = ~done
            pick &= np.cumsum(pick, axis=1) <= width
            r, c = np.nonzero(pick)
            if not len(r):
                return ids, sims
            done[r, c] = True
            near = self.near[ids[r, c]]
            of = np.repeat(r, self.degree)
            near = near.ravel()
            fresh = near >= 0
            of, near = of[fresh], near[fresh].astype(np.int64)
            pair = np.unique(of * len(self.nodes) + near)
            of, near = pair // len(self.nodes), pair % len(self.nodes)
            new = ~seen[of, near]
            of, near = of[new], near[new]
            if not len(of):
                continue
            seen[of, near] = True
            got = np.einsum("pd,pd->p", self.x[near], q[of])
            better = got > sims[of, -1]
            of, near, got = of[better], near[better], got[better]
            if not len(of):
                continue
            count = np.bincount(of, minlength=n)
            hit = np.flatnonzero(count)
            place = np.arange(len(of)) - (np.cumsum(count) - count)[of]
            width_new = int(count.max())
            row_at = np.full(n, -1)
            row_at[hit] = np.arange(len(hit))
            more_ids = np.full((len(hit), width_new), -1, np.int64)
            more_sims = np.full((len(hit), width_new), -np.inf, np.float32)
            more_ids[row_at[of], place] = near
            more_sims[row_at[of], place] = got
            all_ids = np.concatenate([ids[hit], more_ids], 1)
            all_sims = np.concatenate([sims[hit], more_sims], 1)
            all_done = np.concatenate([done[hit], more_ids < 0], 1)
            order = np.argsort(-all_sims, axis=1, kind="stable")[:, :ef]
            ids[hit] = np.take_along_axis(all_ids, order, 1)
            sims[hit] = np.take_along_axis(all_sims, order, 1)
            done[hit] = np.take_along_axis(all_done, order, 1)

    def diverse(self, at: np.ndarray, cand: np.ndarray, sims: np.ndarray, take: int) -> np.ndarray:
        """Up to ``take`` of each row's candidates (best first, -1 where none): diverse ones first, then the nearest of the rest."""
        cand = np.where(cand == at[:, None], -1, cand)
        order = np.argsort(np.where(cand < 0, np.inf, -sims), axis=1, kind="stable")
        cand, sims = np.take_along_axis(cand, order, 1), np.take_along_axis(sims, order, 1)
        x = self.x[np.maximum(cand, 0)]
        among = np.matmul(x, x.transpose(0, 2, 1))
        n, width = cand.shape
        chosen = np.zeros((n, width), bool)
        nearest = np.full((n, width), -np.inf, np.float32)  # similarity to the nearest chosen candidate
        for k in range(width):
            good = (cand[:, k] >= 0) & (nearest[:, k] < sims[:, k]) & (chosen.sum(1) < take)
            chosen[:, k] = good
            nearest[good] = np.maximum(nearest[good], among[good, k])
        first = np.argsort(np.where(cand < 0, 2, np.where(chosen, 0, 1)), axis=1, kind="stable")[:, :take]
        out = np.take_along_axis(cand, first, 1)
        return np.pad(out, ((0, 0), (0, max(0, take - out.shape[1]))), constant_values=-1)

    def link(self, at: np.ndarray, cand: np.ndarray, sims: np.ndarray, links: int) -> None:
        """Give new nodes their neighbours, and those neighbours a way back, thinned where they have too many."""
        forward = self.diverse(at, cand, sims, links)
        self.near[at, :links] = forward
        src, k = np.nonzero(forward >= 0)
        to, back = forward[src, k], at[src]
        order = np.argsort(to, kind="stable")
        to, back = to[order], back[order]
        target, begin, count = np.unique(to, return_index=True, return_counts=True)
        for s in range(0, len(target), BLOCK):
            t, b, c = target[s : s + BLOCK], begin[s : s + BLOCK], count[s : s + BLOCK]
            more = np.full((len(t), int(c.max())), -1, np.int64)
            of = np.repeat(np.arange(len(t)), c)
            place = np.arange(len(of)) - np.repeat(np.cumsum(c) - c, c)
            more[of, place] = back[np.repeat(b, c) + place]
            old = self.near[t].astype(np.int64)
            known = (more[:, :, None] == old[:, None, :]).any(2)
            both = np.concatenate([old, np.where(known, -1, more)], 1)
            sim = np.einsum("nkd,nd->nk", self.x[np.maximum(both, 0)], self.x[t])
            sim[both < 0] = -np.inf
            top = np.argsort(-sim, axis=1, kind="stable")[:, : 2 * self.degree]
            both, sim = np.take_along_axis(both, top, 1), np.take_along_axis(sim, top, 1)
            self.near[t] = self.diverse(t, both, sim, self.degree)


class Graph:
    """Layers from the bottom up. Node numbers follow the order of the shard's vectors."""

    def __init__(self, layers: list[Layer]):
        self.layers = layers

    @staticmethod
    def build(x: np.ndarray, seed: int = 1, links: int = LINKS, ef: int = EF_BUILD) -> Graph:
        n = len(x)
        level = np.floor(-np.log(1 - np.random.default_rng(seed).random(n)) / np.log(links)).astype(int)
        order = np.argsort(-level, kind="stable")  # nodes of upper layers come first in every layer
        layers: list[Layer] = []
        for height in range(int(level.max(initial=0)), -1, -1):
            nodes = order[level[order] >= height]
            layer = Layer(nodes, x[nodes], 2 * links if height == 0 else links)
            graph = Graph(layers)
            at = 0
            while at < len(nodes):
                stop = min(len(nodes), max(64, min(at + BLOCK, 2 * at)))
                new = np.arange(at, stop)
                q = layer.x[new]
                own = q @ q.T
                np.fill_diagonal(own, -np.inf)
                top = np.argsort(-own, axis=1, kind="stable")[:, :ef]
                cand, sims = new[top], np.take_along_axis(own, top, 1)
                if at:
                    entry = graph.descend(q) if layers else np.zeros(len(q), np.int64)
                    found, near = layer.search(q, entry, ef)
                    cand, sims = np.concatenate([found, cand], 1), np.concatenate([near, sims], 1)
                    best = np.argsort(-sims, axis=1, kind="stable")[:, :ef]
                    cand, sims = np.take_along_axis(cand, best, 1), np.take_along_axis(sims, best, 1)
                cand = np.where(np.isfinite(sims), cand, -1)
                layer.link(new, cand, sims, links)
                at = stop
            layers.insert(0, layer)
        return Graph(layers)

    def descend(self, q: np.ndarray) -> np.ndarray:
        """The nearest node found in the lowest of these layers, as its number in the layer below, where such nodes come first."""
        entry = np.zeros(len(q), np.int64)
        for layer in reversed(self.layers):
            entry = layer.search(q, entry, 4, 2)[0][:, 0]
        return entry

    def nearest(self, q: np.ndarray, ef: int = EF_SEARCH) -> np.ndarray:
        """Shard numbers of about the ``ef`` nearest nodes of each query, -1 where none."""
        out = np.full((len(q), ef), -1, np.int64)
        bottom = self.layers[0]
        for s in range(0, len(q), BLOCK):
            part = q[s : s + BLOCK]
            found = bottom.search(part, Graph(self.layers[1:]).descend(part), ef)[0]
            out[s : s + BLOCK] = np.where(found >= 0, bottom.nodes[np.maximum(found, 0)], -1)
        return out


def augmented(x: np.ndarray) -> np.ndarray:
    """One more coordinate that makes all norms equal, scaled to 1."""
    square = (x * x).sum(1)
    top = square.max(initial=0)
    return (np.column_stack([x, np.sqrt(np.maximum(top - square, 0))]) / np.sqrt(top if top > 0 else 1)).astype(np.float32)


def _pack(a: np.ndarray) -> bytes:
    return np.ascontiguousarray(a).tobytes()


def _build_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (dim, shard): one row per shard with its vectors, ids and graph as flat arrays."""
    pending: list[pa.RecordBatch] = []

    def emit(table: pa.Table) -> Iterator[pa.RecordBatch]:
        table = table.combine_chunks()
        dim, shard = (table.column(c).to_numpy() for c in ("dim", "shard"))
        cut = np.flatnonzero((dim[1:] != dim[:-1]) | (shard[1:] != shard[:-1])) + 1
        for a, b in zip(np.append(0, cut).tolist(), np.append(cut, len(dim)).tolist(), strict=True):
            part = table.slice(a, b - a)
            x = np.concatenate([np.asarray(v, np.float64) for v in part.column("v").to_pylist()]).reshape(b - a, int(dim[a]))
            ids = part.column("ids").to_pylist()
            graph = Graph.build(augmented(x))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([int(dim[a])], pa.int32()),
                    pa.array([int(shard[a])], pa.int32()),
                    pa.array([_pack(x)]),
                    pa.array([[i for one in ids for i in one]], pa.list_(pa.int64())),
                    pa.array([np.cumsum([0, *map(len, ids)]).tolist()], pa.list_(pa.int32())),
                    pa.array([[_pack(layer.nodes.astype(np.int32)) for layer in graph.layers]], pa.list_(pa.binary())),
                    pa.array([[_pack(layer.near) for layer in graph.layers]], pa.list_(pa.binary())),
                ],
                ["dim", "shard", "vectors", "ids", "id_ends", "nodes", "near"],
            )

    for batch in batches:
        if not batch.num_rows:
            continue
        dim, shard = batch.column("dim").to_numpy(), batch.column("shard").to_numpy()
        if pending and (pending[-1].column("dim")[-1].as_py(), pending[-1].column("shard")[-1].as_py()) != (int(dim[0]), int(shard[0])):
            yield from emit(pa.Table.from_batches(pending))
            pending = []
        whole = np.flatnonzero((dim != dim[-1]) | (shard != shard[-1]))
        stop = int(whole[-1]) + 1 if len(whole) else 0
        if stop:
            yield from emit(pa.Table.from_batches([*pending, batch.slice(0, stop)]))
            pending = []
        pending.append(batch.slice(stop))
    if pending:
        yield from emit(pa.Table.from_batches(pending))


class Shard:
    """A shard's vectors, ids and graph, read from its flat arrays."""

    def __init__(self, row: pa.RecordBatch):
        cell = lambda name: row.column(name)[0]
        self.x = np.frombuffer(cell("vectors").as_py(), np.float64).reshape(-1, cell("dim").as_py())
        self.ids, self.ends = (cell(name).values.to_numpy() for name in ("ids", "id_ends"))
        wide = augmented(self.x)
        layers = []
        for height, (nodes, near) in enumerate(zip(cell("nodes").as_py(), cell("near").as_py(), strict=True)):
            nodes = np.frombuffer(nodes, np.int32).astype(np.int64)
            degree = 2 * LINKS if height == 0 else LINKS
            layers.append(Layer(nodes, wide[nodes], degree, np.frombuffer(near, np.int32).reshape(-1, degree)))
        self.graph = Graph(layers)

    def nearest(self, own: np.ndarray, q: np.ndarray, k: int, ef: int) -> pa.RecordBatch:
        """(query_id, vec_id, score): the k nearest found of every query, its own id left out."""
        norm = np.sqrt((q * q).sum(1, keepdims=True))
        found = self.graph.nearest(np.column_stack([q / norm, np.zeros(len(q))]).astype(np.float32), ef)
        score = np.einsum("qkd,qd->qk", self.x[np.maximum(found, 0)], q)
        score[found < 0] = -np.inf
        top = np.argsort(-score, axis=1, kind="stable")[:, : 2 * k]
        found, score = np.take_along_axis(found, top, 1), np.take_along_axis(score, top, 1)
        live = found >= 0
        counts = np.where(live, self.ends[found + 1] - self.ends[found], 0).ravel()
        of = np.repeat(np.repeat(np.arange(len(q)), found.shape[1]), counts)
        begin = np.repeat(np.where(live, self.ends[found], 0).ravel(), counts)
        got = self.ids[begin + np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)]
        value = np.repeat(score.ravel(), counts)
        other = got != own[of]
        of, got, value = of[other], got[other], value[other]
        order = np.lexsort((got, -value, of))
        of, got, value = of[order], got[order], value[order]
        first = np.searchsorted(of, np.arange(len(q)))
        use = np.arange(len(of)) - first[of] < k
        return pa.RecordBatch.from_arrays([pa.array(own[of[use]]), pa.array(got[use]), pa.array(value[use])], ["query_id", "vec_id", "score"])


def _search(k: int, ef: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted so that every shard is followed by the blocks of queries sent to it. No vector may have been dealt to a shard; blocks
        sent there find nothing."""
        shard, at = None, None
        for batch in batches:
            keys = zip(*(batch.column(c).to_pylist() for c in ("dim", "shard", "is_block")), strict=True)
            for n, (*key, is_block) in enumerate(keys):
                row = batch.slice(n, 1)
                if not is_block:
                    shard, at = Shard(row), key
                    continue
                if key != at:
                    continue
                own = row.column("query_ids")[0].values.to_numpy()
                yield shard.nearest(own, row.column("queries")[0].values.to_numpy().reshape(len(own), -1), k, ef)

    return run


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v) of the rows that take part, v as array of doubles."""
    v = F.col("v")
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return (
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
        .filter(F.col("vec_id").isNotNull() & v.isNotNull() & (F.size("v") > 0))
        .filter(finite & F.exists(v, lambda c: c != 0))
        .distinct()
    )


def nearest_neighbours(
    vectors: DataFrame, queries: DataFrame, k: int = 20, ef: int = EF_SEARCH, shard_size: int = SHARD, asked_at_once: int = ASKED
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found in ``vectors`` of every row of ``queries``, own ids left out.

    Both have columns vec_id and embedding.
    """
    # Only the k + 1 smallest ids of equal vectors can be in a list; the ranked window drops the rest before the shuffle.
    same = Window.partitionBy("v").orderBy("vec_id")
    distinct = keep(
        usable(vectors).withColumn("n", F.row_number().over(same)).filter(F.col("n") <= k + 1)
        .groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "ann-vectors"
    )
    shards = F.greatest(F.lit(1), F.ceil(F.col("n") / shard_size)).cast("int")
    sizes = distinct.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).select("d", shards.alias("shards"))
    graphs = keep(
        distinct.withColumn("dim", F.size("v"))
        .join(sizes, F.col("dim") == F.col("d"))
        .withColumn("shard", F.pmod(F.xxhash64("v"), F.col("shards")).cast("int"))
        .select("dim", "shard", "v", "ids")
        .repartition("dim", "shard")
        .sortWithinPartitions("dim", "shard")
        .mapInArrow(
            _build_shards,
            "dim int, shard int, vectors binary, ids array<long>, id_ends array<int>, nodes array<binary>, near array<binary>",
        ),
        "ann-graphs",
    )
    asked = usable(queries)
    n_asked = asked.count()
    n_blocks, n_parts = (max(1, -(-n_asked // size)) for size in (QUERY_BLOCK, asked_at_once))
    blocks = (
        asked.withColumn("q_dim", F.size("v"))
        .withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(max(n_blocks, n_parts))).cast("int"))
        .groupBy("q_dim", "block")  # at most about QUERY_BLOCK rows each
        .agg(F.collect_list(F.struct("vec_id", "v")).alias("rows"))
        .join(sizes, F.col("q_dim") == F.col("d"))
        .withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
        .select(
            F.col("q_dim").alias("dim"),
            "shard",
            (F.col("block") % n_parts).alias("part"),
            F.lit(True).alias("is_block"),
            F.col("rows.vec_id").alias("query_ids"),
            F.flatten("rows.v").alias("queries"),
        )
    )
    each = graphs.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(n_parts - 1)))).withColumn("is_block", F.lit(False))
    found = (
        each.unionByName(blocks, allowMissingColumns=True)
        .repartition("dim", "shard", "part")
        .sortWithinPartitions("dim", "shard", "part", "is_block")
        .mapInArrow(_search(k, ef), "query_id long, vec_id long, score double")
    )
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op3_nearest(spark, sf_dir: str) -> DataFrame:
    """Contract query: the 20 nearest of every vector whose id is divisible by 20."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest_neighbours(vectors, vectors.filter("vec_id % 20 = 0"))
