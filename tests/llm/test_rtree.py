"""Hard negatives against plain comparisons of all rows, and the packing itself."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from watthour.llm import rtree as ops

SCHEMA = "vec_id long, embedding array<double>, label int"


def plain(rows, every=10, positives=5, negatives=10, low=30, high=90):
    last = 1 << 63
    used = []
    for i, v, label in rows:
        if label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        whole = [int(np.floor(256 * x)) for x in v]
        if sum(x * x for x in whole) < 1 << 62:
            used.append((i, whole, label))
    out = []
    for at, (i, v, label) in enumerate(used):
        if i is None or i % every:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w)), last if j is None else j, other == label)
                  for b, (j, w, other) in enumerate(used) if b != at and len(w) == len(v)]
        scored.sort()
        for p, j, _ in [s for s in scored if s[2]][:positives]:
            fits = [s for s in scored if not s[2] and low * -p <= 100 * -s[0] <= high * -p][:negatives]
            out += [(i, None if j == last else j, rank, None if n == last else n, -p, -s) for rank, (s, n, _) in enumerate(fits, 1)]
    return sorted(out, key=str)


def mined(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return sorted((tuple(r) for r in ops.hard_negatives(df, F.col("vec_id") % 10 == 0, **options).collect()), key=str)


def clustered(seed, n=900, dim=6):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim))
    x = centres[rng.integers(0, 12, n)] + 0.2 * rng.normal(size=(n, dim))
    return [(i, v.tolist(), int(rng.integers(0, 4))) for i, v in enumerate(x)]


@pytest.mark.parametrize("seed, small", [(1, False), (2, True), (3, True)])
def test_equals_all_comparisons(spark, monkeypatch, seed, small):
    """With small blocks there are many tiles, chunks and batches of anchors."""
    rows = clustered(seed)
    if small:
        for name, value in {"BLOCK": 40, "SAMPLE": 200, "ANCHORS": 7}.items():
            monkeypatch.setattr(ops, name, value)
    want = plain(rows)
    assert len(want) > 1000
    assert mined(spark, rows) == want


def test_boxes_are_pruned(monkeypatch):
    monkeypatch.setattr(ops, "LEAF", 4)
    rng = np.random.default_rng(5)
    x = np.rint(256 * (np.repeat(np.eye(8), 50, axis=0) + 0.01 * rng.normal(size=(400, 8)))).astype(np.int64)
    tree = ops.pack(x, np.arange(400), np.arange(400), np.zeros(400, dtype=np.int64))
    low, high = ops.boxes(tree["x"], tree["starts"])
    window = np.array([[30000]]), np.array([[ops.LARGEST]])
    queries = ops.Queries(np.array([-1]), x[:1], np.zeros(1, dtype=np.int64), *window, np.full((1, 1), -ops.LARGEST), 5, True)
    admitted = queries.admits(low, high)[0]
    assert 0 < admitted.sum() < len(admitted) / 2
    least, most = ops.intervals(x[:1], low, high)
    score = tree["x"] @ x[0]
    for i, (a, b) in enumerate(zip(tree["starts"], np.append(tree["starts"][1:], 400))):
        assert least[0, i] <= score[a:b].min() and score[a:b].max() <= most[0, i]


def test_ties_copies_nulls_and_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(ops, "BLOCK", 16)
    same = [0.5, 0.25]
    rows = [(i, same, i % 3) for i in range(60)] + [(i, [0.3, 0.2], 1) for i in range(60, 75)]
    rows += [(100, same, None), (110, None, 1), (120, [None, 1.0], 1), (130, [float("nan"), 1.0], 1), (140, [float("inf"), 1.0], 1),
             (150, [1e300, 0.0], 1), (160, [], 1), (170, [], 2), (180, [0.5, 0.5, 0.5], 1), (181, [0.3, 0.3, 0.3], 2), (190, [0.4, 0.4, 0.4], 1),
             (None, same, 1), (None, [0.3, 0.2], 2), (20, same, 2), (20, same, 2), (200, [-0.5, -0.25], 1), (210, [0.0, 0.0], 1)]
    assert mined(spark, rows) == plain(rows)


def test_large_components_are_exact(spark):
    rng = np.random.default_rng(9)
    rows = [(i, (rng.normal(size=3) * 2.0**18).tolist(), i % 2) for i in range(80)]
    assert mined(spark, rows) == plain(rows)


def test_empty_and_other_columns(spark):
    assert mined(spark, []) == []
    df = spark.createDataFrame([(i, [1.0, i / 50], i % 2, "x", 1) for i in range(40)], "vec_id long, embedding array<float>, label int, row string, tile int")
    got = ops.hard_negatives(df, F.col("vec_id") % 10 == 0)
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain([(i, [1.0, float(np.float32(i / 50))], i % 2) for i in range(40)])


def test_search_of_many_small_leaves_equals_all_comparisons(monkeypatch):
    """In this process, where a small leaf takes effect: waves of many leaves and rising bounds."""
    monkeypatch.setattr(ops, "LEAF", 3)
    rng = np.random.default_rng(11)
    centres = rng.normal(size=(9, 5))
    x = np.floor(256 * (centres[rng.integers(0, 9, 500)] + 0.1 * rng.normal(size=(500, 5)))).astype(np.int64)
    ident, label = rng.permutation(500), rng.integers(0, 3, 500)
    tree = ops.pack(x, ident, np.arange(500), label)
    assert len(tree["starts"]) > 100
    own = np.arange(0, 500, 25)
    low, high = np.tile([-ops.LARGEST, 20000], (len(own), 1)), np.tile([ops.LARGEST, 90000], (len(own), 1))
    queries = ops.Queries(own, x[own], label[own], low.copy(), high.copy(), np.full(low.shape, -ops.LARGEST), 4, False)
    at, q, score, found, _ = ops.search(queries, tree)
    got = {}
    for i, w, s, d in zip(at, q, score, found):
        got.setdefault((int(i), int(w)), []).append((-int(s), int(d)))
    for i, a in enumerate(own):
        for w in range(2):
            every = sorted((-int(s), int(d)) for s, d, y in zip(x @ x[a], ident, label) if y != label[a] and low[i, w] <= s <= high[i, w])
            assert sorted(got.get((i, w), [])) == every[:4]
