"""Approximate nearest neighbours: a navigable small-world graph with layers per shard.

Vectors are dealt out at random to shards of a bounded size. A task builds the graph of a shard,
kept as flat arrays of neighbour numbers, one row per vector and layer. The graph of a shard goes to one
task and is read once; the queries stream past it. Each shard gives its nearest, and a query's nearest
of all shards are merged.
"""

from __future__ import annotations

import heapq
import io
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidemark.llm.stage import Run

#: Vectors of a shard, on average.
SHARD = 4096
#: Neighbours kept in upper layers, and in the lowest; width of the search while building and asking.
LINKS, LINKS_0 = 12, 24
BUILD_WIDTH, SEARCH_WIDTH = 48, 64
NEAREST = 10
QUERY_STEP = 100

_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


class Graph:
    """Distinct vectors, numbered, with the neighbours of each by layer."""

    def __init__(self, vectors: np.ndarray, levels: np.ndarray | None = None):
        self.vectors = np.ascontiguousarray(vectors, np.float32)
        self.squares = np.einsum("ij,ij->i", self.vectors, self.vectors)
        n = len(vectors)
        if levels is None:
            levels = (-np.log(1 - np.random.default_rng(n).random(n)) / math.log(LINKS)).astype(np.int32)
        self.levels = levels
        self.rows = np.cumsum(levels) - levels  # of the upper layers: row of layer 1
        self.lowest = np.full((n, LINKS_0), -1, np.int32)
        self.upper = np.full((int(levels.sum()), LINKS), -1, np.int32)
        self.entry = 0
        self.seen, self.stamp = np.zeros(n, np.int64), 0

    @classmethod
    def built(cls, vectors: np.ndarray) -> Graph:
        graph = cls(vectors)
        for i in range(1, len(vectors)):
            graph._insert(i)
        return graph

    def _links(self, i: int, layer: int) -> np.ndarray:
        return self.lowest[i] if layer == 0 else self.upper[self.rows[i] + layer - 1]

    def _distances(self, q: np.ndarray, q_square: float, of: np.ndarray) -> np.ndarray:
        return self.squares[of] - 2 * (self.vectors[of] @ q) + q_square

    def _layer(self, q: np.ndarray, starts: list[tuple[float, int]], width: int, layer: int) -> list[tuple[float, int]]:
        """The nearest met when walking from ``starts``, nearest first."""
        self.stamp += 1
        seen, stamp, q_square = self.seen, self.stamp, float(q @ q)
        best = [(-d, i) for d, i in starts]
        open_ = list(starts)
        heapq.heapify(best)
        heapq.heapify(open_)
        for _, i in starts:
            seen[i] = stamp
        while open_:
            d, i = heapq.heappop(open_)
            if d > -best[0][0] and len(best) >= width:
                break
            near = self._links(i, layer)
            near = near[near >= 0]
            near = near[seen[near] != stamp]
            if not len(near):
                continue
            seen[near] = stamp
            for e, j in zip(self._distances(q, q_square, near).tolist(), near.tolist()):
                if len(best) < width:
                    heapq.heappush(best, (-e, j))
                    heapq.heappush(open_, (e, j))
                elif e < -best[0][0]:
                    heapq.heapreplace(best, (-e, j))
                    heapq.heappush(open_, (e, j))
        return sorted((-d, i) for d, i in best)

    def _descend(self, q: np.ndarray, to: int) -> list[tuple[float, int]]:
        start = np.array([self.entry])
        at = [(float(self._distances(q, float(q @ q), start)[0]), self.entry)]
        for layer in range(int(self.levels[self.entry]), to, -1):
            at = self._layer(q, at, 1, layer)
        return at

    def _spread(self, near: list[tuple[float, int]], most: int) -> list[int]:
        """Neighbours in several directions: each nearer to the centre than to those taken before."""
        if len(near) <= most:
            return [i for _, i in near]
        ids = np.array([i for _, i in near])
        vectors, squares = self.vectors[ids], self.squares[ids]
        between = squares[:, None] + squares[None, :] - 2 * (vectors @ vectors.T)
        closest = np.full(len(ids), np.inf, np.float32)
        taken, rest = [], []
        for k, (d, _) in enumerate(near):
            if d < closest[k]:
                taken.append(k)
                np.minimum(closest, between[k], out=closest)
                if len(taken) == most:
                    break
            else:
                rest.append(k)
        return ids[(taken + rest)[:most]].tolist()

    def _insert(self, i: int) -> None:
        q, top = self.vectors[i], int(self.levels[i])
        at = self._descend(q, top)
        for layer in range(min(top, int(self.levels[self.entry])), -1, -1):
            at = self._layer(q, at, BUILD_WIDTH, layer)
            chosen = self._spread(at, LINKS)
            self._links(i, layer)[: len(chosen)] = chosen
            for j in chosen:
                links = self._links(j, layer)
                free = np.nonzero(links < 0)[0]
                if len(free):
                    links[free[0]] = i
                    continue
                all_ = np.append(links, i)
                d = self._distances(self.vectors[j], float(self.squares[j]), all_)
                links[:] = self._spread(sorted(zip(d.tolist(), all_.tolist())), len(links))
        if top > self.levels[self.entry]:
            self.entry = i

    def search(self, q: np.ndarray, width: int) -> np.ndarray:
        """Numbers of about ``width`` near vectors; all, where there are no more than that."""
        if len(self.vectors) <= width:
            return np.arange(len(self.vectors))
        q = q.astype(np.float32)
        return np.array([i for _, i in self._layer(q, self._descend(q, 0), width, 0)])


class ShardIndex:
    """A graph over the distinct vectors of a shard, with the ids that have each, smallest first."""

    def __init__(self, graph: Graph, exact: np.ndarray, ids: np.ndarray, ends: np.ndarray):
        self.graph, self.exact, self.ids, self.ends = graph, exact, ids, ends

    @classmethod
    def built(cls, ids: np.ndarray, vectors: np.ndarray) -> ShardIndex:
        distinct, which = np.unique(vectors, axis=0, return_inverse=True)
        mixed = np.random.default_rng(0).permutation(len(distinct))  # sorted vectors would make a poor graph
        place = np.empty(len(distinct), np.int64)
        place[mixed] = np.arange(len(distinct))
        which = place[which.ravel()]
        order = np.lexsort((ids, which))
        return cls(Graph.built(distinct[mixed]), distinct[mixed], ids[order], np.cumsum(np.bincount(which, minlength=len(distinct))))

    def to_bytes(self) -> bytes:
        g, out = self.graph, io.BytesIO()
        np.savez(out, exact=self.exact, levels=g.levels, lowest=g.lowest, upper=g.upper, entry=g.entry, ids=self.ids, ends=self.ends)
        return out.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> ShardIndex:
        x = np.load(io.BytesIO(data))
        graph = Graph(x["exact"], x["levels"])
        graph.lowest, graph.upper, graph.entry = x["lowest"], x["upper"], int(x["entry"])
        return cls(graph, x["exact"], x["ids"], x["ends"])

    def nearest(self, query_id: int, q: np.ndarray, k: int, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and Euclidean distances of the k nearest found, without the query's own id."""
        near = self.graph.search(q, max(width, k))
        distances = np.sqrt(((self.exact[near].astype(np.float64) - q.astype(np.float64)) ** 2).sum(axis=1))
        ids, scores = [], []
        for i, d in zip(near.tolist(), distances.tolist()):
            # k smallest ids of equal vectors are enough, and one more if the query is among them.
            own = np.unique(self.ids[self.ends[i - 1] if i else 0 : self.ends[i]])[: k + 1]
            ids.append(own[own != query_id][:k])
            scores.append(np.full(len(ids[-1]), d))
        ids, scores = np.concatenate(ids), np.concatenate(scores)
        order = np.lexsort((ids, scores))[:k]
        return ids[order], scores[order]


def valid(vectors: DataFrame, column: str) -> DataFrame:
    """vec_id, vec, dim of the rows that take part: with an id and finite numbers that are not all 0."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(column).cast("array<double>").alias("vec"))
    fine = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vec", lambda x: x != 0)
    return rows.where(F.col("vec_id").isNotNull() & F.coalesce(fine, F.lit(False))).withColumn("dim", F.size("vec"))


def nearest(run: Run, vectors: DataFrame, column: str, query_step: int = QUERY_STEP, k: int = NEAREST, shard: int = SHARD) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each row whose vec_id ``query_step`` divides.

    * Vectors that are NULL, empty, all 0, or hold NULL or non-finite numbers take no part, nor do rows
      without vec_id. Vectors of other lengths than the query's are no candidates.
    * Equal distances go by the smaller vec_id. With fewer candidates than k all are returned; an
      empty table gives no rows.
    * Equal vectors are one node of a shard's graph. Rows repeating an id are one candidate, at their
      smallest distance; a query id with several vectors asks by the smallest of them.
    """
    found = run.written(valid(vectors, column).withColumn("deal", F.monotonically_increasing_id()), "vectors")
    n = found.count()
    shards = max(1, math.ceil(n / shard))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """All rows of a shard; vectors of each length get a graph of their own."""
        some = [b for b in batches if b.num_rows]
        if not some:
            return
        rows = pa.Table.from_batches(some)
        for dim in pc.unique(rows["dim"]).to_pylist():
            alike = rows.filter(pc.equal(rows["dim"], dim))
            index = ShardIndex.built(alike["vec_id"].to_numpy(), pc.list_flatten(alike["vec"]).to_numpy().reshape(-1, dim))
            yield pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), alike["shard"][:1].combine_chunks(), pa.array([index.to_bytes()])], ["dim", "shard", "data"])

    # A task per shard: graphs are small and dear, so tasks put together by their bytes would be too few.
    dealt = found.select("vec_id", "vec", "dim", F.pmod(F.xxhash64("deal"), F.lit(shards)).cast("int").alias("shard"))
    index = run.written(dealt.repartitionById(shards, F.col("shard")).mapInArrow(build, "dim int, shard int, data binary"), "index")

    queries = found.where(F.col("vec_id") % query_step == 0).groupBy("vec_id", "dim").agg(F.min("vec").alias("vec"))
    queries = queries.groupBy("vec_id").agg(F.min(F.struct("dim", "vec")).alias("q")).select("q.dim", "vec_id", "q.vec")
    asked = queries.select("dim", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(None).cast("binary").alias("data"), "vec_id", "vec")
    graphs = index.select("*", F.lit(None).cast("long").alias("vec_id"), F.lit(None).cast("array<double>").alias("vec"))
    met = graphs.unionByName(asked).repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "dim", F.col("data").isNull())

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The graph for a length of vectors, then the queries of that length."""
        dim, graph = None, None
        for batch in batches:
            got = []
            for at, data, query, vec in zip(*(batch.column(c) for c in ("dim", "data", "vec_id", "vec"))):
                if data.is_valid:
                    dim, graph = at.as_py(), ShardIndex.from_bytes(data.as_py())
                elif at.as_py() == dim:  # else no vector of the shard has this length
                    query = query.as_py()
                    ids, scores = graph.nearest(query, vec.values.to_numpy(), k, SEARCH_WIDTH)
                    got.append((np.full(len(ids), query), ids, scores))
            if got:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*got)], schema=_FOUND)

    near = met.select("dim", "data", "vec_id", "vec").mapInArrow(ask, "query_id long, vec_id long, score double")
    near = near.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(Run(spark, "op3"), spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "embedding")
