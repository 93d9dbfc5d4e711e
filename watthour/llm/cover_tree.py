"""Exact pairs of near-equal vectors by dual traversal of cover trees.

Vectors of one length are compared on the unit sphere, where cosine >= c means a chord of at
most sqrt(2 - 2 c).  The upper tree spans all data: a net of pivots, every vector belonging to
its nearest; cells that are still large get pivots of their own, level after level.  Pairs of
cells are carried down from parents to children and pruned by covering radii.  Leaf cells are
stored in blocks of some 8 MB of vectors; each block has nested levels with halving radii, built
once, down to nodes of ``LEAF`` vectors on average.  A pair of blocks is compared level by level:
a pair of nodes goes on only if its centres are no further apart than both covering radii and the
threshold.  Vectors of surviving leaves meet in single precision, loosened by its error bound,
and what passes is decided in double precision.  Equal vectors are one vector with a weight, so
a frequent vector is no hot group, and tasks return counts and spanning edges, not pairs.

Data without any structure at the scale of the radii (random directions in many dimensions)
can't be pruned above the leaves by any tree; there all pairs of blocks meet, each as one
matrix product in strips.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from watthour.llm.graph import components, spanning
from watthour.llm.staging import partitions, stage

BLOCK_BYTES = 1 << 23  # vectors of a block
LEAF = 8  # vectors of a node on average, below which a block's levels end
PIVOTS = 256  # children of a node of the upper tree at most
SAMPLE = 8 * PIVOTS  # vectors of a cell, about, that its pivots come from
RANGE = 1 << 40  # of the hashes that choose them
LARGE = 4  # a cell below the first level is split if it holds more than so many blocks
DEPTH = 4  # levels of the upper tree; cells that are still large are cut into blocks by hash
TREE_BYTES = 64 << 20  # of pivots, which go to every task; beyond, cells are cut by hash too
STRIP = 512  # rows of a block compared at once
SLACK = 1e-9  # bounds are loosened by more than rounding; the last comparison is the exact one


def block_rows(dim: int) -> int:
    return max(256, BLOCK_BYTES // (8 * dim))


def _chord(cosine: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * cosine, 0))


def _farthest_first(x: np.ndarray, k: int) -> np.ndarray:
    """Pivots: each the point farthest from those before."""
    chosen = [0]
    best = x @ x[0]
    while len(chosen) < min(k, len(x)):
        chosen.append(int(np.argmin(best)))
        best = np.maximum(best, x @ x[chosen[-1]])
    return x[chosen]


def _cover(x: np.ndarray, members: np.ndarray, radius: float, most: int) -> np.ndarray | None:
    """Greedy net of the members: for each its centre (an index into ``members``); None if it has over ``most``."""
    owner = np.full(len(members), -1)
    centres: list[int] = [0]
    owner[0] = 0
    least = 1 - radius * radius / 2
    for first in range(0, len(members), 256):
        part = np.arange(first, min(first + 256, len(members)))
        near = x[members[part]] @ x[members[centres]].T
        best = near.argmax(axis=1)
        fits = near[np.arange(len(part)), best] >= least
        owner[part[fits]] = np.array(centres)[best[fits]]
        open_ = part[~fits]
        if not len(open_):
            continue
        if len(centres) > most:
            return None
        gram = x[members[open_]] @ x[members[open_]].T
        done = np.zeros(len(open_), dtype=bool)
        for i in range(len(open_)):
            if not done[i]:
                hit = ~done & (gram[i] >= least)
                hit[i] = True
                owner[open_[hit]] = open_[i]
                done |= hit
                centres.append(int(open_[i]))
    return owner if len(centres) <= most else None


def _split(x: np.ndarray, groups: list[np.ndarray], radius: float, most: int) -> list[np.ndarray] | None:
    """The groups cut into nets of this radius; None if that gives over ``most`` parts."""
    new: list[np.ndarray] = []
    for g in groups:
        owner = _cover(x, g, radius, most - len(new))
        if owner is None:
            return None
        order = np.argsort(owner, kind="stable")
        new += [g[p] for p in np.split(order, np.flatnonzero(np.diff(owner[order])) + 1)]
    return new


def build(x: np.ndarray, smallest: float) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """(order, levels) of a block of unit vectors: after ordering, a node is a range of vectors.

    A level has (first vector of each node, centre, covering radius); level 0 is one node.
    Levels end where radii are far below ``smallest`` or nodes below ``LEAF`` vectors on average.
    """
    most = len(x) // LEAF
    groups = [np.arange(len(x))]
    radius, levels = 1.0, []
    sizes_by_level = [[len(x)]]
    while radius > smallest / 4 and (new := _split(x, groups, radius, most)) is not None:
        groups = new
        sizes_by_level.append([len(g) for g in groups])
        radius /= 2
    order = np.concatenate(groups)
    y = x[order]
    for sizes in sizes_by_level:
        start = np.concatenate([[0], np.cumsum(sizes)])[:-1]
        centre = np.add.reduceat(y, start, axis=0)
        norm = np.linalg.norm(centre, axis=1)
        flat = norm < 1e-12
        centre = np.where(flat[:, None], y[start], centre / np.maximum(norm, 1e-12)[:, None])
        to = np.einsum("ij,ij->i", y, np.repeat(centre, sizes, axis=0))
        levels.append((start, centre, _chord(np.minimum.reduceat(to, start)) + SLACK))
    return order, levels


def dual(a: list, b: list, threshold: float) -> np.ndarray:
    """Which pairs of leaves of two blocks' levels may hold vectors within the threshold: leaves of a x leaves of b."""
    open_ = np.ones((1, 1), dtype=bool)
    i = j = 0
    while (i, j) != (len(a) - 1, len(b) - 1) and open_.any():
        u, v = min(i + 1, len(a) - 1), min(j + 1, len(b) - 1)
        up = [np.searchsorted(own[at][0], own[to][0], side="right") - 1 for own, at, to in ((a, i, u), (b, j, v))]
        near = _chord(a[u][1] @ b[v][1].T)
        open_ = open_[np.ix_(*up)] & (near <= a[u][2][:, None] + b[v][2] + threshold + SLACK)
        i, j = u, v
    return open_ if open_.any() else np.zeros((len(a[-1][0]), len(b[-1][0])), dtype=bool)


def hits(x: np.ndarray, y: np.ndarray, open_: np.ndarray, starts: tuple[np.ndarray, np.ndarray], cosine: float, same: bool):
    """Linked pairs (places in x, places in y) of the open leaves, strip by strip; each pair of a block with itself once."""
    x32, y32 = x.astype(np.float32), y.astype(np.float32)
    least = cosine - (x.shape[1] + 8) * 2.0**-22  # more than single precision can lose in products of unit vectors
    edges = [np.append(s, len(v)) for s, v in zip(starts, (x, y))]
    sizes = [np.diff(e) for e in edges]
    if same:
        open_ = np.triu(open_)
    full = 2 * (sizes[0] @ open_ @ sizes[1]) > len(x) * len(y) // (2 if same else 1)
    leaves = [(0, len(x), None)] if full else [(edges[0][i], edges[0][i + 1], i) for i in np.flatnonzero(open_.any(axis=1))]
    for first, last, leaf in leaves:
        own = None if leaf is None else np.flatnonzero(np.repeat(open_[leaf], sizes[1]))
        for r in range(first, last, STRIP):
            rows = slice(r, min(r + STRIP, last))
            cols = slice(r if same else 0, len(y)) if own is None else own
            back = np.arange(cols.start, cols.stop) if own is None else own
            near = x32[rows] @ y32[cols].T
            at = np.flatnonzero(near >= least)
            if len(at) * 128 > near.size:  # many: one more product is cheaper than pair by pair
                p, q = np.nonzero(x[rows] @ y[cols].T >= cosine)
            else:
                p, q = np.divmod(at, near.shape[1])
                sure = np.einsum("ij,ij->i", x[p + r], y[back[q]]) >= cosine
                p, q = p[sure], q[sure]
            p, q = p + r, back[q]
            if same:
                p, q = p[p < q], q[p < q]
            if len(p):
                yield p, q


def _unpack(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, list]:
    nodes = np.frombuffer(row["nodes"], dtype=np.int64)
    x = np.frombuffer(row["vectors"], dtype=np.float64).reshape(len(nodes), -1)
    levels, at = [], np.frombuffer(row["starts"], dtype=np.int64)
    radii = np.frombuffer(row["radii"], dtype=np.float64)
    for start in np.split(at, np.flatnonzero(at[1:] <= at[:-1]) + 1):
        centre = np.add.reduceat(x, start, axis=0)
        norm = np.linalg.norm(centre, axis=1)
        centre = np.where((norm < 1e-12)[:, None], x[start], centre / np.maximum(norm, 1e-12)[:, None])
        levels.append((start, centre, radii[: len(start)]))
        radii = radii[len(start):]
    return nodes, np.frombuffer(row["weights"], dtype=np.int64), x, levels


def _compare(cosine: float):
    threshold = float(_chord(np.array(cosine))) + SLACK

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        a = _unpack(next(r for r in rows if r["side"] == 0))
        b = _unpack(next(r for r in rows if r["side"] == 1)) if len(rows) > 1 else a
        same = a is b
        links_a = np.zeros(len(a[0]))
        links_b = links_a if same else np.zeros(len(b[0]))
        edges = [np.zeros((0, 2), np.int64)]
        for p, q in hits(a[2], b[2], dual(a[3], b[3], threshold), (a[3][-1][0], b[3][-1][0]), cosine, same):
            links_a += np.bincount(p, weights=b[1][q], minlength=len(links_a))
            links_b += np.bincount(q, weights=a[1][p], minlength=len(links_b))
            edges.append(np.stack(spanning(a[0][p], b[0][q]), axis=1))
        edges = np.concatenate(edges)
        if len(edges):
            edges = np.stack(spanning(edges[:, 0], edges[:, 1]), axis=1)
        node, links = (a[0], links_a) if same else (np.concatenate([a[0], b[0]]), np.concatenate([links_a, links_b]))
        some = links > 0
        return pa.table([
            pa.array(np.concatenate([edges[:, 0], node[some]])),
            pa.array(np.concatenate([edges[:, 1], node[some]])),
            pa.array(np.concatenate([np.zeros(len(edges), np.int64), links[some].astype(np.int64)]))], names=["a", "b", "links"])
    return run


def _units(batches):
    """Rows with their vector normalised as bytes, its length, and its identity."""
    for batch in batches:
        lists = batch.column("vector")
        size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        start = np.cumsum(size) - size
        values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # a null component is a NaN
        units = np.full(len(size), None, dtype=object)
        for dim in np.unique(size[size > 0]):
            at = np.flatnonzero(size == dim)
            x = values[start[at][:, None] + np.arange(dim)]
            fine = np.isfinite(x).all(axis=1)
            at, x = at[fine], x[fine]
            with np.errstate(over="ignore"):
                norm = np.linalg.norm(x, axis=1)
            top = np.abs(x).max(axis=1, initial=0)
            odd = (top > 0) & ((norm == 0) | ~np.isfinite(norm))  # the squares leave the range of doubles
            x[odd] /= top[odd][:, None]
            norm[odd] = np.linalg.norm(x[odd], axis=1)
            at, x, norm = at[top > 0], x[top > 0], norm[top > 0]
            for i, unit in zip(at, x / norm[:, None] + 0.0):
                units[i] = unit.tobytes()
        dims = np.where([u is None for u in units], 0, size)
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(dims, pa.int32()), pa.array(units, pa.binary())],
                                         names=["vec_id", "dim", "unit"])


@dataclass
class Upper:
    """The levels of the tree above the blocks: what its nodes are, on the driver and in every task."""

    dims: dict[int, int]  # root -> length of its vectors
    children: dict[int, list[int]] = field(default_factory=dict)
    pivots: dict[int, np.ndarray] = field(default_factory=dict)  # of the children, in their order
    radius: dict[int, float] = field(default_factory=dict)

    def bytes(self) -> int:
        return sum(p.nbytes for p in self.pivots.values())

    def grow(self, cell: int, pivots: np.ndarray) -> None:
        first = len(self.dims) + len(self.radius)
        self.pivots[cell] = pivots
        self.children[cell] = list(range(first, first + len(pivots)))
        self.radius.update(dict.fromkeys(self.children[cell], 0.0))


def _down(tree: Upper):
    """Points of split cells move to the child with the nearest pivot; ``far`` is their chord to it."""
    def run(batches):
        for batch in batches:
            cell = batch.column("cell").to_numpy().copy()
            far = batch.column("far").to_numpy().copy()
            units = batch.column("unit")
            for c in np.unique(cell):
                if int(c) in tree.pivots:
                    at = np.flatnonzero(cell == c)
                    x = np.frombuffer(b"".join(units.take(pa.array(at)).to_pylist()), dtype=np.float64).reshape(len(at), -1)
                    near = x @ tree.pivots[int(c)].T
                    cell[at] = np.array(tree.children[int(c)])[near.argmax(axis=1)]
                    far[at] = _chord(near.max(axis=1)) + SLACK
            columns = {**dict(zip(batch.schema.names, batch.columns)), "cell": pa.array(cell, pa.int32()), "far": pa.array(far, pa.float64())}
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))
    return run


def _meet(tree: Upper, threshold: float):
    """Pairs of cells, each replaced by the pairs of children that may hold vectors within the threshold."""
    def side(cell: int) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        if cell not in tree.children:
            return None
        own = tree.children[cell]
        return np.array(own), tree.pivots[cell], np.array([tree.radius[c] for c in own])

    place = {c: (cell, k) for cell, own in tree.children.items() for k, c in enumerate(own)}

    def single(cell: int):
        up, k = place[cell]
        return np.array([cell]), tree.pivots[up][k:k + 1], np.array([tree.radius[cell]])

    def run(batches):
        for batch in batches:
            for i, j in zip(batch.column("i").to_pylist(), batch.column("j").to_pylist()):
                a, b = side(i), side(j)
                if a is None and b is None:
                    yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([j], pa.int32())], names=["i", "j"])
                    continue
                a, b = a or single(i), b or single(j)
                ok = _chord(a[1] @ b[1].T) <= a[2][:, None] + b[2] + threshold + SLACK
                if i == j:
                    ok = np.triu(ok)
                p, q = np.nonzero(ok)
                p, q = a[0][p], b[0][q]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(p, q), pa.int32()), pa.array(np.maximum(p, q), pa.int32())], names=["i", "j"])
    return run


TREE = "dim int, cell int, block long, nodes binary, weights binary, vectors binary, starts binary, radii binary"


def _trees(smallest: float):
    def run(table: pa.Table) -> pa.Table:
        dim, cell, block = (table.column(c)[0].as_py() for c in ("dim", "cell", "block"))
        nodes, weights = (table.column(c).to_numpy() for c in ("node", "weight"))
        first = np.argsort(nodes)
        x = np.frombuffer(b"".join(table.column("unit").to_pylist()), dtype=np.float64).reshape(len(nodes), dim)[first]
        order, levels = build(x, smallest)
        parts = (nodes[first][order], weights[first][order], x[order], np.concatenate([v[0] for v in levels]), np.concatenate([v[2] for v in levels]))
        return pa.table({
            "dim": pa.array([dim], pa.int32()), "cell": pa.array([cell], pa.int32()), "block": pa.array([block], pa.int64()),
            **{n: pa.array([np.ascontiguousarray(p).tobytes()], pa.binary()) for n, p in zip(("nodes", "weights", "vectors", "starts", "radii"), parts)}})
    return run


def _upper(points: DataFrame, threshold: float) -> tuple[Upper, DataFrame, list[tuple[int, int, int]], int]:
    """(tree, points with their leaf cell, leaf cells as (cell, dim, points), levels).

    One pass for each level: cells above their size get pivots, the farthest-first net of about
    ``SAMPLE`` of their vectors, chosen by a threshold on hashes.  Only nodes of the upper tree reach the driver.
    """
    spark = points.sparkSession
    counts = {r["dim"]: r["count"] for r in points.groupBy("dim").count().collect()}
    roots = {dim: i for i, dim in enumerate(sorted(counts))}
    tree = Upper({i: dim for dim, i in roots.items()})
    named = spark.createDataFrame(list(roots.items()) or [(-1, -1)], "dim int, cell int")
    celled = points.join(F.broadcast(named), "dim").withColumn("far", F.lit(0.0))  # named: a row for each length
    sizes = [(roots[dim], dim, n) for dim, n in counts.items()]
    levels = 0
    while levels < DEPTH:
        large = {c: min(PIVOTS, -(-n // block_rows(dim))) for c, dim, n in sizes
                 if not levels or n > LARGE * block_rows(dim) and tree.radius[c] > threshold}
        if not large or levels and tree.bytes() + sum(large.get(c, 0) * 8 * dim for c, dim, _ in sizes) > TREE_BYTES:
            break
        dims = {c: dim for c, dim, _ in sizes}
        cells = spark.createDataFrame([(c, large[c], RANGE * SAMPLE // max(n, SAMPLE)) for c, _, n in sizes if c in large] or [(-1, 0, 0)],
                                      "cell int, k int, below long")
        sample = celled.select("cell", "node", "unit").join(F.broadcast(cells), "cell").where(F.pmod(F.xxhash64("node", F.lit(2)), F.lit(RANGE)) < F.col("below"))
        for r in sample.groupBy("cell").applyInArrow(_net, "cell int, pivots binary").collect():
            tree.grow(r["cell"], np.frombuffer(r["pivots"], dtype=np.float64).reshape(-1, dims[r["cell"]]))
        celled = stage(celled.mapInArrow(_down(tree), celled.schema), "cells")
        sizes = []
        for r in celled.groupBy("cell").agg(F.max("far").alias("far"), F.count("*").alias("n"), F.max("dim").alias("dim")).collect():
            tree.radius[r["cell"]] = r["far"]
            sizes.append((r["cell"], r["dim"], r["n"]))
        levels += 1
    return tree, celled, sizes, levels


def _net(table: pa.Table) -> pa.Table:
    units = table.column("unit").to_pylist()
    first = np.argsort(table.column("node").to_numpy())
    x = np.frombuffer(b"".join(units), dtype=np.float64).reshape(len(units), -1)[first]
    pivots = _farthest_first(x, table.column("k")[0].as_py())
    return pa.table({"cell": table.column("cell").slice(0, 1), "pivots": pa.array([pivots.tobytes()], pa.binary())})


def near_pairs(vectors: DataFrame, cosine: float = 0.95, id_col: str = "vec_id", vector_col: str | Column = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row: exact links of cosine >= ``cosine``.

    Vectors that are null, empty, zero or hold a null or non-finite component link with
    nothing and are components of their own, as are vectors of different lengths.
    ``n_links`` counts rows, equal vectors too; ``component_id`` is the smallest id reachable.
    Rows that repeat an id are rows of their own; a null id names no component and isn't kept.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vector"))
    rows = rows.mapInArrow(_units, "vec_id long, dim int, unit binary").withColumn("node", F.xxhash64("unit"))
    valid = rows.where("dim > 0")
    points = stage(valid.groupBy("dim", "node").agg(
        F.count("*").alias("weight"), F.min("vec_id").alias("least"), F.max("unit").alias("unit")), "points")
    threshold = float(_chord(np.array(cosine)))
    tree, celled, sizes, levels = _upper(points, threshold)
    met = spark.createDataFrame([(r, r) for r in tree.dims] or [(-1, -1)], "i int, j int").where("i >= 0")
    for _ in range(levels):
        met = met.mapInArrow(_meet(tree, threshold), "i int, j int").repartition(partitions(spark))
    blocks = spark.createDataFrame([(c, -(-n // block_rows(d))) for c, d, n in sizes] or [(-1, 0)], "cell int, blocks int")
    blocked = celled.join(F.broadcast(blocks), "cell").withColumn(
        "block", F.pmod(F.xxhash64("node", F.lit(1)), "blocks"))  # blocks: a row for each leaf of the tree, which TREE_BYTES bounds
    trees = stage(blocked.select("dim", "cell", "block", "node", "weight", "unit").groupBy("dim", "cell", "block").applyInArrow(
        _trees(threshold), TREE), "trees")
    met = stage(met, "pairs")
    names = trees.select("cell", "block")
    tasks = met.join(names.select(F.col("cell").alias("i"), F.col("block").alias("p")), "i").join(
        names.select(F.col("cell").alias("j"), F.col("block").alias("q")), "j").where("i < j OR p <= q")
    task = F.xxhash64("i", "p", "j", "q").alias("task")
    one = tasks.select(task, F.col("i").alias("cell"), F.col("p").alias("block"), F.lit(0).alias("side"))
    two = tasks.where("i <> j OR p <> q").select(task, F.col("j").alias("cell"), F.col("q").alias("block"), F.lit(1).alias("side"))
    found = stage(one.union(two).join(trees, ["cell", "block"]).groupBy("task").applyInArrow(
        _compare(cosine), "a long, b long, links long"), "found")
    links = found.where("links > 0").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    roots = components(found.where("links = 0").select("a", "b"))
    labels = points.select("node", "weight", "least").join(links, "node", "left").join(roots, "node", "left").select(
        "node", "weight", "least", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "node").alias("root"))
    best = labels.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = labels.join(best, "root").select("node", (F.col("weight") - 1 + F.col("links")).alias("n_links"), "component_id")
    linked = valid.select("vec_id", "node").join(classes, "node").select("vec_id", "n_links", "component_id")
    alone = rows.where("dim = 0").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
