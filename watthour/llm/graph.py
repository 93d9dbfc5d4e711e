"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watthour.llm.staging import stage


def spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (member, smallest node of its component) of a small edge list, without loops."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = flat[: len(a)], flat[len(a):]
    root = np.arange(len(nodes))
    while True:  # hook the larger root onto the smaller, then halve the paths
        ra, rb = root[left], root[right]
        open_ = ra != rb
        if not open_.any():
            break
        np.minimum.at(root, np.maximum(ra, rb)[open_], np.minimum(ra, rb)[open_])
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
    keep = root != np.arange(len(nodes))
    return nodes[keep], nodes[root[keep]]


def _contract(batches):
    for batch in batches:
        a, b = spanning(batch.column("a").to_numpy(), batch.column("b").to_numpy())
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a long, b long); root is the smallest node.

    Each batch is contracted to a forest first, which takes most edges away.  A large-star
    step links a node's larger neighbours to its smallest one, a small-star step its smaller
    neighbours; both aggregate by map-side minimum, so a node with many neighbours is no hot
    group.  Loops and repeated edges are allowed; nulls are left out.
    """
    now = edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b")
    now = stage(now.mapInArrow(_contract, "a long, b long").distinct(), "edges")
    before = None
    while True:
        mark = now.select(F.count("*"), F.sum(F.hash("a", "b").cast("long"))).first()
        if mark == before or mark[0] == 0:
            break
        before = mark
        now = stage(_star(_star(now, True), False), "edges")
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(now.select("b", "b").distinct())


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large: v > u are linked to min(N(u) + u).  Small: v <= u are."""
    if large:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    joined = both.join(least, "a")
    if large:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            least.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()
