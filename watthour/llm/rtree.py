"""Hard negatives by inner product, from an R-tree packed by sort-tile-recursion.

Rows are dealt into tiles by cuts of one coordinate after another, found on a bounded sample;
a tile with many rows is split into blocks of about ``BLOCK`` by their numbers.  Each block is
packed into leaves of ``LEAF`` rows by the same recursion, with runs of leaves as inner nodes.
A node's minimum bounding box gives an interval for the inner product with an anchor: each
coordinate contributes the smaller and the larger of its two products.  A search visits an
anchor's leaves best first and prunes boxes outside the score window or strictly below the
kth score found; what the sample holds gives the first bounds, so whole tiles go before
anything is sent to them.

A row's coordinate x is floor(scale * x).  Scores are exact integers.  Anchors are never
compared pairwise with rows by a cross join: packed batches of anchors meet the blocks that
their bounds admit.

Defined cases: rows with a null label, a null vector or a null or non-finite component take no
part, nor do rows whose squared length does not fit 62 bits, as their scores fit no long.
Vectors of different lengths have no inner product and never meet.  Null ids (and the largest
long, which stands for them) rank after all others and are no anchors; every row of a repeated id is a row of its own, an anchor as well
if its id is one, and only an anchor's own row is left out of its positives.  Empty tables
give no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from watthour.llm.staging import stage, widened
from watthour.llm.textops import blob

LEAF = 64
BLOCK = 4096
SAMPLE = 4096  # rows; they steer the cuts and the first bounds, never the result
TILES = 1024
ANCHORS = 1024  # in a batch
LARGEST = 1 << 62
NO_ID = np.iinfo(np.int64).max


def str_cuts(x: np.ndarray, rows: int, dims: list[int] | None = None) -> list | None:
    """Nested cuts [dim, values, children] that deal ``x`` into tiles of some ``rows`` rows.

    With P tiles to make and r coordinates left, a coordinate is cut into P ** (1 / r) slabs.
    The coordinates are those that vary most, as many as P allows to cut at all.
    """
    pages = -(-len(x) // rows)
    if pages < 2 or not x.shape[1]:
        return None
    if dims is None:
        many = min(x.shape[1], max(1, int(np.ceil(np.log2(pages)))))
        dims = list(np.argsort(-x.astype(np.float64).var(axis=0), kind="stable")[:many])
    if not dims:
        return None
    slabs = min(pages, int(np.ceil(pages ** (1 / len(dims)) - 1e-9)))
    order = np.argsort(x[:, dims[0]], kind="stable")
    bounds = [len(x) * i // slabs for i in range(1, slabs)]
    values = np.unique(x[order[bounds], dims[0]])
    slab = np.searchsorted(values, x[:, dims[0]], side="right")
    return [int(dims[0]), values, [str_cuts(x[slab == i], rows, dims[1:]) for i in range(len(values) + 1)]]


def tile_count(cuts: list | None) -> int:
    return 1 if cuts is None else sum(map(tile_count, cuts[2]))


def str_tiles(x: np.ndarray, cuts: list | None) -> np.ndarray:
    """The tile of every row."""
    out = np.zeros(len(x), dtype=np.int64)
    if cuts is None:
        return out
    slab, base = np.searchsorted(cuts[1], x[:, cuts[0]], side="right"), 0
    for i, child in enumerate(cuts[2]):
        own = np.flatnonzero(slab == i)
        out[own] = base + str_tiles(x[own], child)
        base += tile_count(child)
    return out


def boxes(x: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.minimum.reduceat(x, starts, axis=0), np.maximum.reduceat(x, starts, axis=0)


def intervals(a: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the inner products of anchors (rows) with what lies in each box (columns)."""
    a, low, high = (v.astype(np.float64) for v in (a, low, high))
    up, down = np.maximum(a, 0), np.minimum(a, 0)
    slack = 1e-12 * (np.abs(a) @ np.maximum(np.abs(low), np.abs(high)).T)  # rounding of doubles
    return up @ low.T + down @ high.T - slack, up @ high.T + down @ low.T + slack


def products(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows; by doubles where these are exact."""
    size = lambda v: float(np.sqrt((v.astype(np.float64) ** 2).sum(axis=-1)).max(initial=0))
    if size(a) * size(x) < 2.0**52:
        return (a.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ x.astype(np.int64).T


class Queries:
    """The searches of a batch of anchors: Q windows [low, high] of scores each, and k."""

    def __init__(self, row, vector, label, low, high, kth, k, same) -> None:
        self.row, self.vector, self.label, self.low, self.high, self.kth = row, vector, label, low, high, kth
        self.k, self.same = k, same

    def take(self, at: np.ndarray) -> Queries:
        return Queries(*(v[at] for v in (self.row, self.vector, self.label, self.low, self.high, self.kth)), self.k, self.same)

    def admits(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Which boxes (columns) may hold a result of some window of each anchor (row)."""
        least, most = intervals(self.vector, low, high)
        floor = np.maximum(self.low, self.kth).astype(np.float64)
        out = np.zeros(most.shape, dtype=bool)
        for q in range(floor.shape[1]):
            out |= (most >= floor[:, q, None]) & (least <= self.high[:, q, None].astype(np.float64)) & (self.low[:, q] <= self.high[:, q])[:, None]
        return out

    def fits(self, score: np.ndarray, row: np.ndarray, label: np.ndarray):
        """(anchor, column, window) of scores inside a window and not below its kth."""
        fine = (self.label[:, None] == label) == self.same
        fine &= self.row[:, None] != row
        found = []
        for q in range(self.low.shape[1]):
            floor = np.maximum(self.low[:, q], self.kth[:, q])[:, None]
            i, j = np.nonzero(fine & (score >= floor) & (score <= self.high[:, q, None]))
            found.append((i, j, np.full(len(i), q)))
        return tuple(np.concatenate(c) for c in zip(*found))


def best(anchor, window, score, ident, row, k: int) -> np.ndarray:
    """Positions of the first k of each (anchor, window): by score, then id."""
    order = np.lexsort((row, ident, -score, window, anchor))
    a, w = anchor[order], window[order]
    start = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (w[1:] != w[:-1])])) if len(a) else np.zeros(0, dtype=np.int64)
    rank = np.arange(len(a)) - np.repeat(start, np.diff(np.append(start, len(a))))
    return order[rank < k]


def search(queries: Queries, leaves: dict) -> tuple[np.ndarray, ...]:
    """(anchor position, window, score, id, row) of the best k of each window in one block."""
    x, ident, row, label, starts = (leaves[n] for n in ("x", "id", "row", "label", "starts"))
    low, high = boxes(x, starts)
    inner = np.arange(0, len(starts), 8)
    alive = np.repeat(queries.admits(*(f.reduceat(v, inner, axis=0) for f, v in ((np.minimum, low), (np.maximum, high)))), 8, axis=1)
    alive = alive[:, : len(starts)] & queries.admits(low, high)
    most = np.where(alive, intervals(queries.vector, low, high)[1], -np.inf)
    first = np.argsort(-most, axis=1, kind="stable")
    ends = np.append(starts[1:], len(x))
    kept = tuple(np.zeros(0, dtype=np.int64) for _ in range(5))
    at, step = 0, 1
    while at < len(starts):  # the next leaves of every anchor's queue, more at a time as bounds settle
        wave, at, step = first[:, at:at + step], at + step, min(2 * step, 16)
        bound = np.maximum(queries.low, queries.kth).min(axis=1).astype(np.float64)
        on, col = np.nonzero(np.take_along_axis(most, wave, axis=1) >= np.maximum(bound, -1e300)[:, None])
        if not len(on):
            break  # what follows in a queue is bounded by less
        leaf = wave[on, col]
        order = np.argsort(leaf, kind="stable")
        cuts = np.flatnonzero(np.diff(leaf[order], prepend=-1))
        new = []
        for group in np.split(order, cuts[1:]):
            a, b = starts[leaf[group[0]]], ends[leaf[group[0]]]
            part = queries.take(on[group])
            score = products(part.vector, x[a:b])
            i, j, q = part.fits(score, row[a:b], label[a:b])
            new.append((on[group][i], q, score[i, j], ident[a:b][j], row[a:b][j]))
        kept = tuple(np.concatenate(c) for c in zip(kept, *new))
        kept = tuple(c[best(*kept, queries.k)] for c in kept)
        full = np.flatnonzero(np.bincount(kept[0] * queries.low.shape[1] + kept[1], minlength=queries.low.size) == queries.k)
        if len(full):
            worst = np.full(queries.low.size, NO_ID)
            np.minimum.at(worst, kept[0] * queries.low.shape[1] + kept[1], kept[2])
            flat = queries.kth.reshape(-1).copy()
            flat[full] = np.maximum(flat[full], worst[full])
            queries.kth = flat.reshape(queries.kth.shape)
    return kept


def pack(x: np.ndarray, ident: np.ndarray, row: np.ndarray, label: np.ndarray) -> dict:
    """A block's rows in leaf order, and where its leaves start."""
    tile = str_tiles(x, str_cuts(x, LEAF))
    order = np.argsort(tile, kind="stable")
    starts = np.flatnonzero(np.diff(tile[order], prepend=-1))
    sizes = np.diff(np.append(starts, len(x)))  # equal vectors share a tile: cut by count then
    starts = np.concatenate([np.arange(s, s + n, LEAF) for s, n in zip(starts, sizes)])
    return {"x": x[order], "id": ident[order], "row": row[order], "label": label[order], "starts": starts}


def _ints(raw: np.ndarray) -> np.ndarray:
    return raw.astype(np.int16) if np.abs(raw).max(initial=0) < 1 << 15 else raw.astype(np.int64)


def _matrix(data: list[bytes], dim: int) -> np.ndarray:
    """Coordinates of rows as integers, from blobs of 64-bit values."""
    return np.frombuffer(b"".join(data), dtype=np.int64).reshape(len(data), dim)


def _binary(batches):
    """Vectors as blobs of 64-bit integers."""
    for batch in batches:
        listed = batch.column("whole")
        flat = listed.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        size = pc.list_value_length(listed).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(size)
        vecs = [blob(flat[e - n:e]) for e, n in zip(ends, size)]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("id", "label", "is_anchor")), pa.array(size.astype(np.int32)), pa.array(vecs, pa.binary())],
            names=["id", "label", "is_anchor", "dim", "vec"])


def _dealt(plans: Broadcast):
    def run(batches):
        for batch in batches:
            dim = batch.column("dim").to_numpy()
            tile = np.zeros(len(dim), dtype=np.int64)
            for d in np.unique(dim):
                own = np.flatnonzero(dim == d)
                tile[own] = str_tiles(_matrix(batch.column("vec").take(pa.array(own)).to_pylist(), int(d)), plans.value[int(d)]["cuts"])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tile)], names=[*batch.schema.names, "tile"])
    return run


BLOCKS = "dim int, tile long, chunk long, n long, low array<long>, high array<long>, vecs binary, ids binary, rows binary, labels binary, starts binary"


def _packed(table: pa.Table) -> pa.Table:
    dim = table.column("dim")[0].as_py()
    x = _matrix(table.column("vec").to_pylist(), dim)
    tree = pack(x, table.column("id").to_numpy(), table.column("row").to_numpy(), table.column("label").to_numpy())
    low, high = boxes(x, np.zeros(1, dtype=np.int64))
    small = _ints(tree["x"])
    return pa.table({"dim": table.column("dim")[:1], "tile": table.column("tile")[:1], "chunk": table.column("chunk")[:1],
                     "n": pa.array([len(x)]), "low": pa.array([low[0]], pa.list_(pa.int64())), "high": pa.array([high[0]], pa.list_(pa.int64())), "vecs": [blob(small)],
                     "ids": [blob(tree["id"])], "rows": [blob(tree["row"])], "labels": [blob(tree["label"])],
                     "starts": [blob(tree["starts"].astype(np.int64))]})


BATCHES = "dim int, tile long, chunk long, name string, vecs binary, rows binary, labels binary, low binary, high binary, kth binary"


def _read_queries(r: dict, k: int, same: bool) -> Queries:
    row = np.frombuffer(r["rows"], dtype=np.int64)
    window = [np.frombuffer(r[n], dtype=np.int64).reshape(len(row), -1) for n in ("low", "high", "kth")]
    return Queries(row, np.frombuffer(r["vecs"], dtype=np.int64).reshape(len(row), r["dim"]), np.frombuffer(r["labels"], dtype=np.int64), *window, k, same)


def _sent(plans: Broadcast, k: int, same: bool):
    """Batches of anchors for every block of every tile that may hold a result of theirs."""
    def run(batches):
        for batch in batches:
            for start in range(0, len(batch), ANCHORS):
                part = batch.slice(start, ANCHORS)
                dims = part.column("dim").to_numpy()
                for d in np.unique(dims):
                    own = part.take(pa.array(np.flatnonzero(dims == d)))
                    plan = plans.value[int(d)]
                    row = own.column("row").to_numpy()
                    window = [np.array(own.column(n).to_pylist(), dtype=np.int64).reshape(len(row), -1) for n in ("low", "high")]
                    queries = Queries(row, _matrix(own.column("vec").to_pylist(), int(d)), own.column("label").to_numpy(), *window,
                                      np.full(window[0].shape, -LARGEST), k, same)
                    if plan["sample"]:
                        search(queries, plan["sample"])  # raises kth: the sample's rows are rows
                    admitted = queries.admits(plan["low"], plan["high"])
                    for t in np.flatnonzero(admitted.any(axis=0)):
                        some = queries.take(np.flatnonzero(admitted[:, t]))
                        packed = [blob(some.vector)] + [blob(v) for v in (some.row, some.label, some.low, some.high, some.kth)]
                        chunks = int(plan["chunks"][t])
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([int(d)] * chunks, pa.int32()), pa.array([int(plan["tiles"][t])] * chunks), pa.array(range(chunks), pa.int64()),
                             pa.array([f"{row[0]}"] * chunks), *[pa.array([v] * chunks, pa.binary()) for v in packed]],
                            names=["dim", "tile", "chunk", "name", "vecs", "rows", "labels", "low", "high", "kth"])
    return run


FOUND = "anchor long, search int, score long, id long, row long"


def _searched(k: int, same: bool):
    def run(table: pa.Table) -> pa.Table:
        out = []
        for r in table.to_pylist():
            count = r["n"]
            kind = np.int16 if len(r["b_vecs"]) == 2 * count * r["dim"] else np.int64
            leaves = {"x": np.frombuffer(r["b_vecs"], dtype=kind).reshape(count, r["dim"]), "starts": np.frombuffer(r["starts"], dtype=np.int64),
                      **{n: np.frombuffer(r[c], dtype=np.int64) for n, c in (("id", "ids"), ("row", "b_rows"), ("label", "b_labels"))}}
            queries = _read_queries(r, k, same)
            at, q, score, ident, row = search(queries, leaves)
            out.append((queries.row[at], q, score, ident, row))
        anchor, q, score, ident, row = (np.concatenate(c) for c in zip(*out))
        return pa.table({"anchor": anchor, "search": pa.array(q.astype(np.int32)), "score": score, "id": ident, "row": row})
    return run


def _first(anchors: DataFrame, blocks: DataFrame, plans: Broadcast, k: int, same: bool) -> DataFrame:
    """The best k rows of every window of every anchor: (anchor row, search, score, id, row, rank)."""
    sent = anchors.mapInArrow(_sent(plans, k, same), BATCHES)
    held = blocks.select("dim", "tile", "chunk", "n", "ids", "starts", F.col("vecs").alias("b_vecs"), F.col("rows").alias("b_rows"), F.col("labels").alias("b_labels"))
    met = sent.join(held, ["dim", "tile", "chunk"])
    found = met.groupBy("dim", "tile", "chunk", "name").applyInArrow(_searched(k, same), FOUND)
    order = W.partitionBy("anchor", "search").orderBy(F.desc("score"), "id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _plans(rows: DataFrame) -> dict[int, dict]:
    """For each vector length: a sample, cuts into tiles.  Only bounded samples come to the driver."""
    out = {}
    for d, n in rows.groupBy("dim").count().collect():
        drawn = rows.where(F.col("dim") == d).where(F.pmod(F.xxhash64("row"), F.lit(1 << 30)) < (1 << 30) * min(1.0, SAMPLE / n)).limit(2 * SAMPLE).toPandas()
        x = _matrix(list(drawn["vec"]), d) if len(drawn) else np.zeros((0, d), dtype=np.int64)
        tiles = min(TILES, max(1, n // BLOCK), max(1, (8 << 20) // (8 * max(d, 1))))
        cuts = str_cuts(x, -(-len(x) // tiles)) if tiles > 1 and len(x) else None
        ids = (drawn[c].to_numpy(dtype=np.int64) for c in ("id", "row", "label"))
        out[d] = {"cuts": cuts, "sample": pack(x, *ids) if len(x) else None}
    return out


def hard_negatives(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30,
                   high: int = 90, base: int = 100, scale: float = 256.0, id_col: str = "vec_id",
                   vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    An anchor's positives are its first ``positives`` other rows of the same label; for each,
    the first ``negatives`` rows of other labels with low * p <= base * s <= high * p.
    ``is_anchor`` is a condition on the columns of ``vectors``.
    """
    context = vectors.sparkSession.sparkContext
    scaled = F.transform(F.col(vector_col), lambda x: F.lit(scale) * x.cast("double"))
    fine = F.forall(scaled, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < 2.0**31)) & F.col(label_col).isNotNull()
    whole = F.when(fine, F.transform(scaled, lambda x: F.floor(x).cast("long")))
    length = F.aggregate("whole", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    rows = vectors.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.col(label_col).cast("long").alias("label"),
        (F.coalesce(is_anchor, F.lit(False)) & F.col(id_col).isNotNull()).alias("is_anchor"), whole.alias("whole"))
    rows = rows.where(F.col("whole").isNotNull()).where(length < float(LARGEST)).mapInArrow(
        _binary, "id long, label long, is_anchor boolean, dim int, vec binary")
    rows = stage(rows.withColumn("row", F.monotonically_increasing_id()), "rows")

    plans = _plans(rows)
    dealt = rows.mapInArrow(_dealt(context.broadcast(plans)), widened(rows, tile=T.LongType()))
    sizes = stage(dealt.groupBy("dim", "tile").agg(F.count("*").alias("size")), "tiles")
    chunk = F.pmod(F.xxhash64("row"), F.ceil(F.col("size") / BLOCK)).alias("chunk")
    cut = dealt.join(F.broadcast(sizes), ["dim", "tile"]).select("dim", "tile", chunk, "id", "label", "row", "vec")
    blocks = stage(cut.groupBy("dim", "tile", "chunk").applyInArrow(_packed, BLOCKS), "blocks")

    sides = blocks.select("dim", "tile", F.posexplode(F.arrays_zip("low", "high")).alias("pos", "side"))
    sides = sides.groupBy("dim", "tile", "pos").agg(F.min("side.low").alias("low"), F.max("side.high").alias("high"))
    whole_boxes = sides.groupBy("dim", "tile").agg(F.array_sort(F.collect_list(F.struct("pos", "low", "high"))).alias("box"))
    found: dict[int, list] = {d: [] for d in plans}
    for r in sizes.join(whole_boxes, ["dim", "tile"], "left").orderBy("dim", "tile").collect():  # at most TILES of a length
        found[r["dim"]].append((r["tile"], -(-r["size"] // BLOCK), [(b["low"], b["high"]) for b in r["box"] or []]))
    for d, plan in plans.items():
        box = np.array([f[2] for f in found[d]], dtype=np.int64).reshape(len(found[d]), d, 2)
        plan |= {"tiles": [f[0] for f in found[d]], "chunks": [f[1] for f in found[d]], "low": box[:, :, 0], "high": box[:, :, 1]}
    shared = context.broadcast(plans)

    anchors = rows.where("is_anchor").select("dim", "vec", "label", "row", F.col("id").alias("anchor_id"))
    every = anchors.withColumn("low", F.array(F.lit(-LARGEST))).withColumn("high", F.array(F.lit(LARGEST)))
    near = stage(_first(every, blocks, shared, positives, True).select("anchor", F.col("rank").alias("nth"), F.col("score").alias("p"), F.col("id").alias("positive_id")), "positives")
    windows = near.groupBy("anchor").agg(F.transform(F.array_sort(F.collect_list(F.struct("nth", "p"))), lambda s: s["p"]).alias("ps"))
    part = lambda p, share: F.lit(share).cast("decimal(10,0)") * p.cast("decimal(20,0)")
    floor = lambda v: F.call_function("div", v - F.pmod(v, F.lit(base)), F.lit(base))
    padded = F.transform(F.sequence(F.lit(0), F.lit(positives - 1)), lambda i: F.get("ps", i))
    windowed = anchors.join(windows, anchors["row"] == windows["anchor"]).select(
        "dim", "vec", "label", "row",
        F.transform(padded, lambda p: F.coalesce(-floor(-part(p, low)), F.lit(LARGEST))).alias("low"),
        F.transform(padded, lambda p: F.coalesce(floor(part(p, high)), F.lit(-LARGEST))).alias("high"))
    far = _first(windowed, blocks, shared, negatives, False).select(
        "anchor", (F.col("search") + 1).alias("nth"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    names = anchors.select(F.col("row").alias("anchor"), "anchor_id")
    no_id = lambda c: F.when(F.col(c) != NO_ID, F.col(c)).alias(c)
    return far.join(near, ["anchor", "nth"]).join(names, "anchor").select(
        "anchor_id", no_id("positive_id"), "rank", no_id("negative_id"), F.col("p").alias("positive_score"), "negative_score")
