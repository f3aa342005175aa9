"""Connected components of an edge table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .shared import cut, discard

#: Edges for each file that a step writes: the table of edges shrinks to one a node.
EDGES_PER_TASK = 250_000


def components(edges: DataFrame, a: str = "a", b: str = "b", native: bool = False) -> DataFrame:
    """(node, component): for every node of an edge that reaches a smaller one, the smallest that it reaches.

    Nodes are longs; with native also structs of longs. Nulls, loops and repeated edges are ignored; an empty table gives an empty one.

    Without native, tasks of EDGES_PER_TASK edges first replace their edges by a spanning forest (each node and the smallest that it
    reaches in the task), again as long as this halves the table: repeated and redundant edges of large groups go before any exchange by node.
    What is left, and all edges with native, runs through alternating large-star and small-star steps in DataFrame operations. Each step
    deals edges by node and pre-aggregates the minimum. The loop ends when a step changes no edge; the number of steps
    grows with the logarithm of the longest chain.
    """
    e = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    e = cut(e.distinct() if native else e, "cc")
    n = e.count()
    while not native and n:
        tasks = 1 + n // EDGES_PER_TASK
        new = cut(e.repartition(tasks).mapInArrow(_forest, "u long, v long"), "cc")
        discard(e)
        e, before, n = new, n, new.count()
        if tasks == 1:
            return e.select(F.col("u").alias("node"), F.col("v").alias("component"))
        if 2 * n > before:
            break
    before = _sums(e)
    if not before[0]:
        return e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    while True:
        tasks = 1 + before[0] // EDGES_PER_TASK
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("m")), F.struct(F.col("v").alias("u"), F.col("m").alias("m")))).alias("x"))
        small = small.select(F.col("x.u").alias("u"), F.col("x.m").alias("v"))
        new = cut(small.where(F.col("u") != F.col("v")).distinct().coalesce(tasks), "cc")
        after = _sums(new)
        discard(e)
        e = new
        if after == before:
            return e.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = after


def _sums(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u") % 1000003)).first())


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's edges (u, v) -> each node that isn't the smallest of its tree, and that one."""
    parts = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
    u, v = (np.concatenate([p[k] for p in parts] or [np.zeros(0, np.int64)]) for k in (0, 1))
    node, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    x, y = at[: len(u)], at[len(u) :]
    root = np.arange(len(node))
    while True:  # smaller roots spread along edges and pointers are halved until nothing changes
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    own = np.flatnonzero(root != np.arange(len(node)))
    yield pa.RecordBatch.from_arrays([pa.array(node[own]), pa.array(node[root[own]])], names=["u", "v"])
