"""Connected components of a graph whose edges are a DataFrame."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.stage import Run

MAX_ROUNDS = 60


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest node of each node's component, for nodes 0..n-1 and edges a-b, in one task."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        label = label[label]
        label = label[label]
        if (label == before).all():
            return label


def components(run: Run, edges: DataFrame) -> DataFrame:
    """node, root (the smallest node reachable) for every node of ``edges`` (a, b: BIGINT).

    Alternates two steps until nothing changes: every node hands its larger neighbours, then its
    smaller ones, to the smallest of them. The number of rounds is logarithmic, a round never makes
    more edges than it had, and minima are taken before the shuffle. Each round is written, so a
    lost executor costs one round at most.
    """
    current = run.written(_tidy(edges.select("a", "b")), "edges-0")
    mark = _mark(current)
    for i in range(1, MAX_ROUNDS + 1):
        following = run.written(_small(_large(current)), f"edges-{i}")
        run.drop(f"edges-{i - 1}")
        current, before, mark = following, mark, _mark(following)
        if mark == before:
            break
    else:
        raise RuntimeError(f"no fixed point after {MAX_ROUNDS} rounds")
    return current.select(F.col("b").alias("node"), F.col("a").alias("root")).union(current.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())


def _tidy(edges: DataFrame) -> DataFrame:
    """Each edge once, as (smaller, larger), without loops."""
    return edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())


def _hub(pairs: DataFrame) -> DataFrame:
    """(u, v, hub): each pair with the smallest of u and all its v."""
    least = pairs.groupBy("u").agg(F.min(F.least("u", "v")).alias("hub"))
    return pairs.join(least, "u")


def _large(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    return _tidy(_hub(both).where("v > u").select(F.col("hub").alias("a"), F.col("v").alias("b")))


def _small(edges: DataFrame) -> DataFrame:
    downward = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    linked = _hub(downward)
    return _tidy(linked.select(F.col("hub").alias("a"), F.col("v").alias("b")).union(linked.select(F.col("hub").alias("a"), F.col("u").alias("b"))))
