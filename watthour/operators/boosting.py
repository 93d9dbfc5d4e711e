"""Boosted trees for many models at once: one Spark job for all, or one per tree level.

A model is one (group, setting, target): a time fold, a set of parameters, a horizon.  Features
are cut into quantile bins once, by sketches.  Each row is written once per group with its
bins, its targets and the current predictions of its models.

Written rows of at most ``SMALL`` bytes, which is checked, are broadcast, and each task grows
the trees of some models.  Any more of them stay where they are: to grow a level, every task
walks its rows down the open trees of all models and adds up residuals by (model, node,
feature, bin); the partial histograms are merged by bucket of nodes, where each node's best
split is chosen, and only the splits come back.  The driver then holds trees, never rows, and a
task's part of a histogram is bounded by open nodes x features x bins.  Both ways share the
histograms and the choice of splits, and give the same trees.

Squared loss: with G the sum of residuals and n the rows of a node, a leaf is
rate * G / (n + ``SHRINK``) and a split gains GL^2/(nL+s) + GR^2/(nR+s) - G^2/(n+s).  Rows are
drawn for a tree by a hash of the row, features by a fixed seed.  A missing feature value
falls into the lowest bin; a row without a target takes no part in that model.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watthour.session import drop_written, written

SEED = 42
BINS = 64
SHRINK = 1.0  # rows added to every divisor
LEAST = 1  # rows on each side of a split
EVERY = 10  # trees after which the predictions are written
LEAF, OPEN = -1, -2
SMALL = 64 << 20  # bytes of written rows that may be broadcast
CHUNK = 4  # targets whose trees a task grows together
MODEL_AT, GROUP_BITS = 40, 12  # a slot holds setting, group, target and node, feature and bin
BUCKETS = 8  # of nodes, times the partitions of the rows

U64 = np.uint64


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


@dataclass
class Trees:
    """Trees of one setting in heap order (children of i: 2i+1, 2i+2), by [tree, group, target]."""

    setting: dict
    groups: int
    targets: int
    feature: list[np.ndarray] = field(default_factory=list)
    bin: list[np.ndarray] = field(default_factory=list)
    value: list[np.ndarray] = field(default_factory=list)
    gain: np.ndarray | None = None  # [group, target, feature]

    @property
    def nodes(self) -> int:
        return 2 ** (self.setting["depth"] + 1) - 1

    def sprout(self) -> None:
        shape = (self.groups, self.targets, self.nodes)
        self.feature.append(np.full(shape, LEAF, dtype=np.int16))
        self.bin.append(np.zeros(shape, dtype=np.uint8))
        self.value.append(np.zeros(shape))
        self.feature[-1][:, :, 0] = OPEN

    def last(self, count: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """The newest trees as plain arrays, to be sent to tasks."""
        return list(zip(self.feature[-count:], self.bin[-count:], self.value[-count:])) if count else []


def nodes_of(feature: np.ndarray, cut: np.ndarray, bins: np.ndarray) -> np.ndarray:
    """The node where each row's walk ends in each target's tree (one group)."""
    rows, targets = np.arange(len(bins))[:, None], np.arange(len(feature))[None]
    node = np.zeros((len(bins), len(feature)), dtype=np.int64)
    while True:
        at = feature[targets, node]
        inside = at >= 0
        if not inside.any():
            return node
        right = bins[rows, np.maximum(at, 0)] > cut[targets, node]
        node = np.where(inside, 2 * node + 1 + right, node)


def _matrix(column: pa.Array, kind: type) -> np.ndarray:
    raw = column.to_pylist()
    return np.frombuffer(b"".join(raw), dtype=kind).reshape(len(raw), -1)


def _by_group(batch: pa.RecordBatch):
    """(group, row numbers, bins, targets, hashes, predictions) of each group in a batch."""
    group = batch.column("grp").to_numpy()
    for g in np.unique(group):
        own = np.flatnonzero(group == g)
        part = batch.take(pa.array(own))
        yield (int(g), own, _matrix(part.column("bins"), np.uint8), _matrix(part.column("ys"), np.float64),
               part.column("hash").to_numpy().view(U64), _matrix(part.column("preds"), np.float64))


def _advanced(preds: np.ndarray, g: int, bins: np.ndarray, pending: list, targets: int) -> np.ndarray:
    """Predictions with the trees that are not in the written ones yet."""
    preds = preds.copy()
    for s, trees in enumerate(pending):
        own = preds[:, s * targets:(s + 1) * targets]
        for feature, cut, value in trees:
            own += value[g][np.arange(targets)[None], nodes_of(feature[g], cut[g], bins)]
    return preds


def _advance(pending: list, targets: int):
    def run(batches):
        for batch in batches:
            out = [None] * len(batch)
            for g, own, bins, _, _, preds in _by_group(batch):
                for i, row in zip(own, _advanced(preds, g, bins, pending, targets)):
                    out[i] = row.tobytes()
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(out, pa.binary())], names=batch.schema.names)
    return run


def histogram(bins, ys, hashes, preds, feature, cut, columns, share, setting: int, number: int):
    """Sorted (slot, residuals, rows) of the open nodes of one group's trees of one setting.

    A slot is target and node << 16 | place in ``columns`` * BINS + bin.
    """
    drawn = _scramble(hashes + U64(number * 1000 + setting)) <= U64(min(int(share * 2.0**64), 2**64 - 1))
    use = np.flatnonzero(drawn)
    node = nodes_of(feature, cut, bins[use])
    rest = ys[use] - preds[use]
    at, h = np.nonzero((feature[np.arange(len(feature))[None], node] == OPEN) & ~np.isnan(rest))
    keys, place = np.unique(h * feature.shape[1] + node[at, h], return_inverse=True)
    slot = ((place[:, None] * len(columns) + np.arange(len(columns))[None]) * BINS + bins[use][at][:, columns]).reshape(-1)
    size = len(keys) * len(columns) * BINS
    grads = np.bincount(slot, weights=np.repeat(rest[at, h], len(columns)), minlength=size)
    counts = np.bincount(slot, minlength=size)
    full = np.flatnonzero(counts)
    return keys[full // (len(columns) * BINS)] << 16 | full % (len(columns) * BINS), grads[full], counts[full]


def _histograms(pending: list, growing: list, targets: int, buckets: int, number: int):
    """Histograms of a task's rows for all models, packed by bucket of nodes.

    ``growing`` has, per setting, the open trees, the drawn features and the share of rows.
    """
    def run(batches):
        parts = []
        for batch in batches:
            for g, _, bins, ys, hashes, preds in _by_group(batch):
                preds = _advanced(preds, g, bins, pending, targets)
                for s, grow in enumerate(growing):
                    if grow is not None:
                        feature, cut, columns, share = grow
                        slots, *sums = histogram(bins, ys, hashes, preds[:, s * targets:(s + 1) * targets], feature[g], cut[g], columns, share, s, number)
                        parts.append((slots | (s << GROUP_BITS | g) << MODEL_AT, *sums))
        if not parts:
            return
        slots, grads, counts = merge(*(np.concatenate(c) for c in zip(*parts)))
        bucket = (_scramble((slots >> 16).view(U64)) % U64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
        rows = [(int(b), *(x[order[cuts[b]:cuts[b + 1]]].tobytes() for x in (slots, grads, counts))) for b in np.flatnonzero(np.diff(cuts))]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.binary(), pa.binary(), pa.binary()))],
                                             names=["bucket", "slots", "grads", "counts"])
    return run


def merge(slots: np.ndarray, grads: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sums of equal slots, in order."""
    names, at = np.unique(slots, return_inverse=True)
    return names, np.bincount(at, weights=grads, minlength=len(names)), np.bincount(at, weights=counts, minlength=len(names))


SPLITS = "node long, feature int, bin int, gain double, left_sum double, left_n double, total double, n double"


def best_splits(slots: np.ndarray, grads: np.ndarray, counts: np.ndarray) -> dict[str, np.ndarray]:
    """For every node its best split (gain 0: none) and its totals; slots are sorted and distinct."""
    node, cell = slots >> 16, slots & 0xFFFF
    line = np.flatnonzero(np.diff(slots // BINS, prepend=-1))  # where a feature of a node starts
    start = np.repeat(line, np.diff(np.append(line, len(slots))))
    g, n = np.cumsum(grads), np.cumsum(counts)
    left_g, left_n = g - (g - grads)[start], n - (n - counts)[start]
    first = np.flatnonzero(np.diff(node, prepend=-1))
    last = np.append(line[1:], len(slots)) - 1  # totals of a node: those of its first feature
    ends = last[np.searchsorted(line, first)]
    which = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(slots))))
    total, size = left_g[ends], left_n[ends]
    right_g, right_n = total[which] - left_g, size[which] - left_n
    score = lambda a, b: a * a / (b + SHRINK)
    gain = score(left_g, left_n) + score(right_g, right_n) - score(total, size)[which]
    gain[(left_n < LEAST) | (right_n < LEAST)] = 0
    gain[gain < 1e-9] = 0
    top = np.maximum.reduceat(gain, first)
    hits = np.flatnonzero(gain >= top[which] * (1 - 1e-9))  # equal but for the order of sums
    best = hits[np.flatnonzero(np.diff(which[hits], prepend=-1))]  # the first of equal ones
    return {"node": node[first], "feature": (cell[best] // BINS).astype(np.int32), "bin": (cell[best] % BINS).astype(np.int32),
            "gain": top, "left_sum": left_g[best], "left_n": left_n[best], "total": total, "n": size}


def _chosen(table: pa.Table) -> pa.Table:
    parts = [np.concatenate([np.frombuffer(b, dtype=t) for b in table.column(c).to_pylist()])
             for c, t in (("slots", np.int64), ("grads", np.float64), ("counts", np.float64))]
    return pa.table(best_splits(*merge(*parts)))


def _prepared(names: Sequence[str], targets: Sequence[str], cuts: list[np.ndarray], base: np.ndarray):
    """Rows as (grp, hash, bins, ys, preds)."""
    def run(batches):
        for batch in batches:
            columns = [batch.column(c).to_numpy(zero_copy_only=False).astype(np.float64) for c in names]
            bins = np.stack([np.searchsorted(c, np.nan_to_num(x, nan=-np.inf), side="left") for x, c in zip(columns, cuts)], axis=1).astype(np.uint8)
            ys = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.float64) for c in targets], axis=1)
            group = batch.column("grp")
            preds = base[group.to_numpy()]
            blobs = (pa.array([r.tobytes() for r in x], pa.binary()) for x in (bins, ys, preds))
            yield pa.RecordBatch.from_arrays([group, batch.column("hash"), *blobs], names=["grp", "hash", "bins", "ys", "preds"])
    return run


STATE = "grp int, hash long, bins binary, ys binary, preds binary"


@dataclass
class Boosted:
    """Fitted models: [setting][tree, group, target]."""

    features: list[str]
    targets: dict[int, str]
    groups: list
    cuts: list[np.ndarray]
    base: np.ndarray  # [group, target]
    trees: list[Trees]

    def importances(self, setting: int = 0, group: int = 0) -> np.ndarray:
        """Share of the gain by [target, feature]; all zero where nothing was split."""
        gain = self.trees[setting].gain[group]
        return gain / np.maximum(gain.sum(axis=1, keepdims=True), 1e-300)

    def scorer(self, setting: int, group: int, horizons: Sequence[int]):
        """A function from a matrix of features to predictions by horizon."""
        at = [list(self.targets).index(h) for h in horizons]
        cuts, base = self.cuts, self.base[group, at]
        trees = [tuple(x[group, at] for x in t) for t in self.trees[setting].last(len(self.trees[setting].feature))]

        def score(x: np.ndarray) -> np.ndarray:
            bins = np.stack([np.searchsorted(c, np.nan_to_num(x[:, f], nan=-np.inf), side="left") for f, c in enumerate(cuts)], axis=1)
            out = np.tile(base, (len(x), 1))
            for feature, cut, value in trees:
                out += value[np.arange(len(at))[None], nodes_of(feature, cut, bins)]
            return out
        return score


def quantile_cuts(rows: DataFrame, features: Sequence[str], bins: int = BINS) -> list[np.ndarray]:
    """Upper bounds of the bins of each feature, from one aggregate of sketches."""
    shares = [i / bins for i in range(1, bins)]
    found = rows.agg(*[F.percentile_approx(F.nanvl(F.col(f).cast("double"), F.lit(None).cast("double")), shares, 100 * bins).alias(f"q{i}")
                       for i, f in enumerate(features)]).first()
    return [np.unique(np.array(q if q else [], dtype=np.float64)) for q in found]


def check(setting: dict) -> None:
    """Raise for a setting that trees can't be grown with."""
    if not 0 <= setting["depth"] <= 16 or setting["trees"] < 0 or not 0 < setting["rows"] <= 1 or not 0 < setting["columns"] <= 1:
        raise ValueError(f"no trees can be grown with {setting}")


def boost(rows: DataFrame, features: Sequence[str], targets: dict[int, str], settings: Sequence[dict],
          group: str | None = None) -> Boosted:
    """Fit every setting for every target in every value of ``group`` (one group without it)."""
    for setting in settings:
        check(setting)
    features, names = list(features), list(targets.values())
    wanted = list(dict.fromkeys([*features, *names]))
    group = F.lit(None).cast("int") if group is None else F.col(group)
    # read once; hashed as doubles, so a row is drawn for a tree whatever partition it is in
    lean = written(rows.select(group.alias("group"), F.xxhash64(*[F.col(c).cast("double") for c in wanted]).alias("hash"),
                               *[F.col(c).cast("double").alias(c) for c in wanted]), "boosting")
    groups = sorted((r[0] for r in lean.select("group").distinct().collect()), key=lambda g: (g is not None, g)) or [None]
    number = F.coalesce(*[F.when(F.col("group").eqNullSafe(F.lit(g)), i) for i, g in enumerate(groups)])
    numbered = lean.withColumn("grp", number.cast("int"))
    base = np.zeros((len(groups), len(names)))
    means = numbered.groupBy("grp").agg(*[F.avg(F.nanvl(y, F.lit(None))).alias(f"y{i}") for i, y in enumerate(names)])
    for r in means.collect():
        base[r["grp"]] = [0.0 if m is None else m for m in r[1:]]
    cuts = quantile_cuts(lean, features)
    if len(features) * BINS > 1 << 16 or len(groups) >= 1 << GROUP_BITS or len(settings) >= 1 << 11:
        raise ValueError("too many features, groups or settings for one fit")
    if any((2 ** (x["depth"] + 1) - 1) * len(names) >= 1 << MODEL_AT - 16 for x in settings):
        raise ValueError("too many targets for trees so deep")
    state = written(numbered.mapInArrow(_prepared(features, names, cuts, np.tile(base, (1, len(settings)))), STATE), "boosting")
    drop_written(lean)
    size = state.agg(F.coalesce(F.sum(F.octet_length("bins") + F.octet_length("ys") + 12), F.lit(0))).first()[0]
    trees = [Trees(s, len(groups), len(names)) for s in settings]
    if size <= SMALL:
        _fit_by_models(state, trees, base, len(features), len(names))
    else:
        _fit_by_levels(state, trees, len(features), len(names))
    drop_written(state)
    return Boosted(features, dict(targets), groups, cuts, base, trees)


def _fit_by_models(state: DataFrame, trees: list[Trees], base: np.ndarray, width: int, targets: int) -> None:
    """Broadcast the rows, at most ``SMALL`` bytes, and grow each setting's trees of some targets in a task."""
    spark = state.sparkSession
    rows = [part[:1] + part[2:5] for batch in state.drop("preds").withColumn("preds", F.col("ys")).toArrow().to_batches() for part in _by_group(batch)]
    held = {g: tuple(np.concatenate(c) for c in zip(*[r[1:] for r in rows if r[0] == g])) for g in {r[0] for r in rows}}
    shared = spark.sparkContext.broadcast((held, base))
    work = [(s, g, a) for s, t in sorted(enumerate(trees), key=lambda x: -x[1].setting["trees"] * x[1].setting["depth"])
            for g in held for a in range(0, targets, CHUNK)]
    plan = [t.setting for t in trees]

    def run(batches):
        data, base = shared.value
        for batch in batches:
            for s, g, a in zip(*(batch.column(c).to_pylist() for c in ("s", "g", "a"))):
                bins, ys, hashes = data[g]
                ys = ys[:, a:a + CHUNK]
                tree = Trees(plan[s], 1, ys.shape[1])
                tree.gain = np.zeros((1, ys.shape[1], width))
                preds = np.tile(base[g, a:a + CHUNK], (len(ys), 1))
                for round_ in range(plan[s]["trees"]):
                    def found(growing):
                        feature, cut, columns, share = growing[s]
                        return best_splits(*histogram(bins, ys, hashes, preds, feature[0], cut[0], columns, share, s, round_))
                    _grow({s: tree}, round_, width, found)
                    preds += tree.value[-1][0][np.arange(ys.shape[1])[None], nodes_of(tree.feature[-1][0], tree.bin[-1][0], bins)]
                blobs = [np.stack(x).tobytes() if x else b"" for x in (tree.feature, tree.bin, tree.value)]
                yield pa.RecordBatch.from_arrays([*(pa.array([v], pa.int32()) for v in (s, g, a)), *(pa.array([b], pa.binary()) for b in (*blobs, tree.gain.tobytes()))],
                                                 names=["s", "g", "a", "feature", "bin", "value", "gain"])

    for t in trees:
        t.gain = np.zeros((t.groups, t.targets, width))
        for _ in range(t.setting["trees"]):
            t.sprout()
    tasks = spark.createDataFrame(work, "s int, g int, a int").repartition(len(work), "s", "g", "a") if work else None
    for r in tasks.mapInArrow(run, "s int, g int, a int, feature binary, bin binary, value binary, gain binary").toLocalIterator() if work else ():
        t, some = trees[r["s"]], slice(r["a"], r["a"] + CHUNK)
        many = min(CHUNK, targets - r["a"])
        for name, kind in (("feature", np.int16), ("bin", np.uint8), ("value", np.float64)):
            grown = np.frombuffer(r[name], dtype=kind).reshape(-1, many, t.nodes)
            for whole, part in zip(getattr(t, name), grown):
                whole[r["g"], some] = part
        t.gain[r["g"], some] = np.frombuffer(r["gain"], dtype=np.float64).reshape(many, width)


def _fit_by_levels(state: DataFrame, trees: list[Trees], width: int, targets: int) -> None:
    """One job per level of all models' trees; predictions are written every ``EVERY`` trees."""
    buckets = BUCKETS * max(1, state.rdd.getNumPartitions())
    first = state
    for t in trees:
        t.gain = np.zeros((t.groups, t.targets, width))
    pending = 0
    for round_ in range(max((t.setting["trees"] for t in trees), default=0)):
        if pending == EVERY:
            advanced = written(state.mapInArrow(_advance(_newest(trees, pending, round_), targets), STATE), "boosting")
            if state is not first:
                drop_written(state)
            state, pending = advanced, 0
        newest = _newest(trees, pending, round_)

        def found(growing, state=state, newest=newest, round_=round_):
            sums = state.mapInArrow(_histograms(newest, growing, targets, buckets, round_), "bucket long, slots binary, grads binary, counts binary")
            return {c: x.to_numpy() for c, x in sums.groupBy("bucket").applyInArrow(_chosen, SPLITS).toPandas().items()}

        _grow({s: t for s, t in enumerate(trees) if round_ < t.setting["trees"]}, round_, width, found)
        pending += 1
    if state is not first:
        drop_written(state)


def _newest(trees: list[Trees], pending: int, round_: int) -> list:
    """The trees of the last ``pending`` rounds; a setting with fewer trees has stopped before."""
    return [t.last(max(0, min(len(t.feature), t.setting["trees"]) - (round_ - pending))) for t in trees]


def _grow(trees: dict[int, Trees], round_: int, width: int, found) -> None:
    """One more tree for the models of these settings, level by level.

    ``found`` gives the best split of every open node of what is growing.
    """
    columns = {}
    for s, t in trees.items():
        t.sprout()
        share = max(1, int(t.setting["columns"] * width))
        columns[s] = np.sort(np.random.default_rng([SEED, s, round_]).permutation(width)[:share])
    for level in range(max(t.setting["depth"] for t in trees.values()) + 1):
        growing: list = [None] * (max(trees) + 1)
        for s, t in trees.items():
            if (t.feature[-1] == OPEN).any():
                growing[s] = t.feature[-1], t.bin[-1], columns[s], t.setting["rows"]
        if not any(growing):
            break
        best = found(growing)
        key = best["node"]
        setting, group, at = key >> MODEL_AT - 16 + GROUP_BITS, key >> MODEL_AT - 16 & (1 << GROUP_BITS) - 1, key & (1 << MODEL_AT - 16) - 1
        for s, t in trees.items():
            if growing[s] is None:
                continue
            # keys of a setting that grows alone in a task do not name it
            own = setting == s if len(trees) > 1 or setting.any() else np.ones(len(key), dtype=bool)
            feature, cut, value = t.feature[-1], t.bin[-1], t.value[-1]
            feature[feature == OPEN] = LEAF  # unless split below
            rate, (g, h, node) = t.setting["rate"], (group[own], at[own] // t.nodes, at[own] % t.nodes)
            column, bin_, gain, left, left_n, total, n = (best[c][own] for c in ("feature", "bin", "gain", "left_sum", "left_n", "total", "n"))
            value[g, h, node] = rate * total / (n + SHRINK)
            split = (gain > 0) & (level < t.setting["depth"])
            g, h, node, column, bin_, left, left_n, total, n, gain = (x[split] for x in (g, h, node, column, bin_, left, left_n, total, n, gain))
            feature[g, h, node], cut[g, h, node] = columns[s][column], bin_
            np.add.at(t.gain, (g, h, columns[s][column]), gain)
            for child, sums, size in ((2 * node + 1, left, left_n), (2 * node + 2, total - left, n - left_n)):
                value[g, h, child] = rate * sums / (size + SHRINK)
                more = (size >= 2 * LEAST) & (level + 1 < t.setting["depth"])
                feature[g, h, child] = np.where(more, OPEN, LEAF)
