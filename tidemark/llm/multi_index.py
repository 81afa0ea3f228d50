"""Near-duplicate vectors by an inverted multi-index.

Each half of a vector has a codebook of its own; the nearest centres of both halves name one cell of a
grid. A vector is also sent to the cells near its own, which are visited in the order of the squared
distance from the vector to the cell: the sum of two numbers, one per half, so a traversal of two
ascending sequences gives it. The visit ends at a distance within which the target share of vectors at
the least similarity lies. What meets in a cell is compared exactly.

Of two cells one sends its vectors to the other, so a pair is compared once and links are counted where
they are found, without listing pairs. Equal vectors are one node with a size; large cells are compared
block by block.
"""

from __future__ import annotations

import hashlib
import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.components import components, roots
from tidemark.llm.stage import Run

SIMILARITY = 0.95
#: Share of vectors exactly SIMILARITY away from another that the visited cells are to hold.
TARGET_RECALL = 0.995
#: Distinct vectors of a cell on average, by which the codebooks' size is set, and the largest size.
OCCUPANCY, CENTRES = 256, 1024
#: Vectors the codebooks are fitted on, at most, and numbers in them; trials for the visited distance.
FITTED, FITTED_VALUES, TRIALS = 1 << 14, 1 << 22, 4000
ROUNDS = 12
#: Members, and visitors, of a cell that one task compares at a time; rows of one matrix product.
BLOCK, PRODUCT = 4096, 512

_ROWS = "row long, vec_id long, dim int, key binary, raw binary"
_MEMBER, _OWN, _VISITOR = 0, 1, 2


def _fine(vec: Column) -> Column:
    """Whether a vector takes part: numbers only, finite, not all 0."""
    numbers = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(numbers & F.exists(vec, lambda x: x != 0), F.lit(False))


def packed_rows(vectors: DataFrame, column: str) -> DataFrame:
    """Every row with a number; key and raw (little-endian doubles) are NULL where it takes no part."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(column).cast("array<double>").alias("vec"))
    rows = rows.select("vec_id", F.when(F.col("vec_id").isNotNull() & _fine(F.col("vec")), F.col("vec")).alias("vec"))
    rows = rows.withColumn("row", F.monotonically_increasing_id())

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vec = batch.column("vec")
            raws, dims = [], []
            for x in vec:
                values = None if not x.is_valid else x.values.to_numpy(zero_copy_only=False) + 0.0  # -0 is 0
                raws.append(None if values is None else values.astype("<f8").tobytes())
                dims.append(None if values is None else len(values))
            keys = [None if r is None else hashlib.blake2b(r, digest_size=16).digest() for r in raws]
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("vec_id"), pa.array(dims, pa.int32()), pa.array(keys, pa.binary()), pa.array(raws, pa.binary())], [c.split()[0] for c in _ROWS.split(", ")])

    return rows.mapInArrow(pack, _ROWS)


def units(raws, dim: int) -> np.ndarray:
    """Vectors of unit length, padded to ``dim`` with zeros."""
    out = np.zeros((len(raws), dim))
    for i, raw in enumerate(raws):
        values = np.frombuffer(raw, "<f8")
        out[i, : len(values)] = values / np.abs(values).max()  # no overflow of squares
    return out / np.sqrt(np.einsum("ij,ij->i", out, out))[:, None]


def centres(points: np.ndarray, k: int, seed: int) -> np.ndarray:
    """At most k centres of the points, by Lloyd's rounds; centres without points are dropped."""
    rng = np.random.default_rng(seed)
    distinct = np.unique(points, axis=0)
    found = distinct[rng.permutation(len(distinct))[:k]]
    for _ in range(ROUNDS):
        nearest = (points @ found.T - 0.5 * (found**2).sum(axis=1)).argmax(axis=1)
        order = np.argsort(nearest, kind="stable")
        held, starts, sizes = np.unique(nearest[order], return_index=True, return_counts=True)
        found = np.add.reduceat(points[order], starts, axis=0) / sizes[:, None]
    return found


class Codebook:
    """Centres of one half, and how far they lie from each other."""

    def __init__(self, found: np.ndarray):
        self.found = found
        self.squares = (found**2).sum(axis=1)
        between = self.squares[:, None] + self.squares[None, :] - 2 * found @ found.T
        self.between = 2 * np.sqrt(np.maximum(between, 0))
        self.between[self.between == 0] = np.inf

    def distances(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest centre, and the squared distance to where each centre becomes the nearest."""
        d = self.squares - 2 * points @ self.found.T  # less the square of the point
        own = d.argmin(axis=1)
        # A point at distances p and q from two centres lies (q² - p²) / (2 * theirs) from their border.
        border = np.maximum(d - d[np.arange(len(d)), own][:, None], 0) / self.between[own]
        return own, border**2


def nearest_cells(first: np.ndarray, second: np.ndarray, limit: float) -> Iterator[tuple[int, int]]:
    """Cells (i, j) by ascending first[i] + second[j] up to the limit: a traversal of two sequences."""
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    x, y = first[a].tolist(), second[b].tolist()
    a, b = a.tolist(), b.tolist()
    open_ = [(x[0] + y[0], 0, 0)]
    while open_:
        distance, i, j = heapq.heappop(open_)
        if distance > limit:
            return
        yield a[i], b[j]
        if j + 1 < len(y):
            heapq.heappush(open_, (x[i] + y[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(x):  # a column is entered from its top only
            heapq.heappush(open_, (x[i + 1] + y[0], i + 1, 0))


def visits(cell: int, other: int) -> bool:
    """Whether the first of two different cells sends its vectors to the second; else the second does."""
    return (cell < other) == ((cell + other) % 2 == 0)


class Grid:
    """Codebooks of both halves, fitted on some vectors, and how far to visit."""

    def __init__(self, points: np.ndarray, dims: np.ndarray, k: int, similarity: float, target: float):
        self.dim = points.shape[1]
        self.half = (self.dim + 1) // 2
        self.books = [Codebook(centres(p, k, seed)) for seed, p in enumerate(self.halves(points))]
        rng = np.random.default_rng(2)
        some = rng.integers(len(points), size=TRIALS)
        u = points[some]
        aside = rng.normal(size=u.shape) * (np.arange(self.dim) < dims[some][:, None])
        aside -= np.einsum("ij,ij->i", aside, u)[:, None] * u
        length = np.sqrt(np.einsum("ij,ij->i", aside, aside))
        aside /= np.where(length > 0, length, 1)[:, None]
        v = similarity * u + math.sqrt(1 - similarity**2) * aside
        far = np.zeros(len(u))
        for book, p, q in zip(self.books, self.halves(u), self.halves(v)):
            far += book.distances(p)[1][np.arange(len(u)), book.distances(q)[0]]
        self.limit = float(np.quantile(far, target)) if target < 1 else 2 * (1 - similarity)

    def halves(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return points[:, : self.half], points[:, self.half :]

    def cells(self, points: np.ndarray) -> Iterator[tuple[int, list[int]]]:
        """Of each vector its own cell and the others that it is sent to."""
        width = len(self.books[1].found)
        (own_a, a), (own_b, b) = (book.distances(p) for book, p in zip(self.books, self.halves(points)))
        for i, home in enumerate((own_a * width + own_b).tolist()):
            near = (x * width + y for x, y in nearest_cells(a[i], b[i], self.limit))
            yield home, [c for c in near if c != home and visits(home, c)]


def fitted(nodes: DataFrame, n: int, similarity: float, target: float) -> Grid:
    """A grid for ``n`` nodes, fitted on a bounded sample that comes to the driver."""
    dim = nodes.agg(F.max("dim")).first()[0]
    most = max(2, min(FITTED, FITTED_VALUES // dim))
    some = nodes.select("raw", "dim").sample(min(1.0, 1.5 * most / n), seed=1).limit(most).collect() or nodes.select("raw", "dim").limit(most).collect()
    k = 1 << max(1, round(math.log2(math.sqrt(n / OCCUPANCY)))) if n > OCCUPANCY else 1
    return Grid(units([r.raw for r in some], dim), np.array([r.dim for r in some]), min(k, CENTRES), similarity, target)


_SENT = "dim int, cell long, kind int, node long, least long, size long, raw binary"
_SIZES = "dim int, cell long, members long, asking long"
_FOUND = "node long, links long, least long, root long"


def _sent(grid: Grid):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                cells, kinds, of = [], [], []
                for i, (home, others) in enumerate(grid.cells(units(part.column("raw").to_pylist(), grid.dim))):
                    cells += [home, home, *others]
                    kinds += [_MEMBER, _OWN, *[_VISITOR] * len(others)]
                    of += [i] * (2 + len(others))
                taken = {c: part.column(c).take(pa.array(of)) for c in ("dim", "node", "least", "size", "raw")}
                columns = [taken["dim"], pa.array(cells, pa.int64()), pa.array(kinds, pa.int32()), *[taken[c] for c in ("node", "least", "size", "raw")]]
                yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in _SENT.split(", ")])

    return run


def _cell_sizes(grid: Grid):
    """Members and asking vectors by cell, added up per batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _sent(grid)(batches):
            dims, cells, kinds = (batch.column(c).to_numpy() for c in ("dim", "cell", "kind"))
            keys, where = np.unique(np.stack((dims.astype(np.int64), cells)), axis=1, return_inverse=True)
            where = where.ravel()
            members = np.bincount(where, weights=kinds == _MEMBER).astype(np.int64)
            asking = np.bincount(where, weights=kinds != _MEMBER).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(keys[0].astype(np.int32)), pa.array(keys[1]), pa.array(members), pa.array(asking)], [x.split()[0] for x in _SIZES.split(", ")])

    return run


def _compared(similarity: float):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        """Links between the members and the asking vectors of one block of a cell."""
        member = rows["kind"].to_numpy() == _MEMBER
        own = (rows["kind"].to_numpy() == _OWN)[~member]
        sides = []
        for some in (member, ~member):
            part = rows[some]
            sides.append((units(part["raw"].to_list(), int(rows["dim"].iloc[0])), part["node"].to_numpy(), part["least"].to_numpy(), part["size"].to_numpy()))
        (m, m_node, m_least, m_size), (q, q_node, q_least, q_size) = sides
        m_links, q_links = np.zeros(len(m), np.int64), np.zeros(len(q), np.int64)
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        label = np.arange(len(m) + len(q))
        for at in range(0, len(q), PRODUCT):
            linked = (q[at : at + PRODUCT] @ m.T >= similarity) & (q_node[at : at + PRODUCT, None] != m_node[None, :])
            q_links[at : at + PRODUCT] = linked @ m_size
            # Vectors of the cell itself ask each other both ways, visitors only one way.
            foreign = ~own[at : at + PRODUCT]
            m_links += q_size[at : at + PRODUCT][foreign] @ linked[foreign].astype(np.int64)
            i, j = np.nonzero(linked)
            if len(i):  # merged at once, so that memory follows the vectors and not the links
                label = roots(len(label), np.concatenate((np.arange(len(label)), i + at + len(m))), np.concatenate((label, j)))
        node, links, least = np.concatenate((m_node, q_node)), np.concatenate((m_links, q_links)), np.concatenate((m_least, q_least))
        root = np.full(len(label), np.iinfo(np.int64).max)
        np.minimum.at(root, label, least)
        out = pd.DataFrame({"node": node, "links": links, "least": least, "root": root[label]})
        return out[(out["links"] > 0) | (out["least"] != out["root"])]

    return run


def near_duplicates(run: Run, vectors: DataFrame, column: str, similarity: float = SIMILARITY, target: float = TARGET_RECALL, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per row of ``vectors``.

    Links are pairs of rows with a cosine of ``similarity`` or more. Every link reported is one; about
    the share ``target`` of pairs just at ``similarity`` is found, and more of those nearer to each
    other. With a target of 1 the visited cells provably hold all of them.

    * Vectors that are NULL, empty, all 0, or hold NULL or non-finite numbers link with nothing, nor do
      rows without vec_id; their component is their own id, NULL without one, which is not kept.
    * Vectors of different lengths do not link. Equal vectors are one node, however many there are.
    * Rows that repeat an id are vectors of their own, in components named by the smallest id of theirs.
    * An empty table gives no rows; other columns are not read.
    """
    rows = run.written(packed_rows(vectors, column), "rows")
    held = rows.where("key IS NOT NULL")
    groups = run.written(held.groupBy("key").agg(F.min("row").alias("node"), F.count(F.lit(1)).alias("size"), F.min("vec_id").alias("least")), "groups")
    n = groups.count()
    out = rows.select("vec_id", "key")
    if n:
        nodes = run.written(held.select(F.col("row").alias("node"), "dim", "raw").join(groups.drop("key"), "node"), "nodes")
        grid = fitted(nodes, n, similarity, target)
        found = run.written(_links(nodes, grid, similarity, block), "found")
        counted = found.groupBy("node").agg(F.sum("links").alias("links"))
        parts = components(run, run.written(found.where("least <> root").select(F.col("least").alias("a"), F.col("root").alias("b")).distinct(), "edges"))
        by_key = (
            groups.join(counted, "node", "left")
            .join(parts.select(F.col("node").alias("least"), "root"), "least", "left")
            .select("key", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"), F.coalesce("root", "least").alias("component_id"))
        )
        out = out.join(run.written(by_key, "by_key"), "key", "left")
    else:
        out = out.withColumn("n_links", F.lit(None).cast("long")).withColumn("component_id", F.lit(None).cast("long"))
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def _links(nodes: DataFrame, grid: Grid, similarity: float, block: int) -> DataFrame:
    """Links by node where they were found, and a smaller id of the node's group there."""
    sent = nodes.select("dim", "node", "least", "size", "raw")
    sizes = sent.mapInArrow(_cell_sizes(grid), _SIZES).groupBy("dim", "cell").agg(F.sum("members").alias("members"), F.sum("asking").alias("asking"))
    # Cells without members have nobody to meet.
    blocks = sizes.where("members > 0").select("dim", "cell", F.ceil(F.col("members") / block).alias("of_members"), F.ceil(F.col("asking") / block).alias("of_asking"))
    dealt = sent.mapInArrow(_sent(grid), _SENT).join(blocks, ["dim", "cell"])
    own = lambda n: F.pmod(F.xxhash64("node"), F.col(n))
    every = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    is_member = F.col("kind") == _MEMBER
    dealt = dealt.withColumn("member_block", F.explode(F.when(is_member, F.array(own("of_members"))).otherwise(every("of_members"))))
    dealt = dealt.withColumn("asking_block", F.explode(F.when(is_member, every("of_asking")).otherwise(F.array(own("of_asking")))))
    names = ["dim", "kind", "node", "least", "size", "raw"]
    return dealt.groupBy("dim", "cell", "member_block", "asking_block").applyInPandas(lambda rows: _compared(similarity)(rows[names]), _FOUND)


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(Run(spark, "op13"), spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "embedding")


# What the operator tends to: every pair is compared here.
OP13_SQL = """
WITH RECURSIVE good AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b
    ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.95
), reached AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION
  SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
), parts AS (SELECT a AS vec_id, MIN(b) AS component_id FROM reached GROUP BY a),
counted AS (SELECT a AS vec_id, COUNT(*) AS n FROM links GROUP BY a)
SELECT vec_id, COALESCE(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN parts USING (vec_id) LEFT JOIN counted USING (vec_id)
"""
