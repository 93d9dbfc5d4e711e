import hashlib
import random

import numpy as np
import pytest

from llm.llm_frames import corpus, frame, roots, shingles
from watthour.llm import cover_tree
from watthour.llm.cover_tree import near_pairs
from watthour.llm.fingerprints import fingerprints
from watthour.llm.graph import components
from watthour.llm import ngram_join
from watthour.llm.ngram_join import jaccard_components
from watthour.llm.suffix_dedup import remove_repeats


def joined(rows):
    sets = {r[0]: shingles(r[1]) for r in rows}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and
             100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    return sets, roots(sets, links)


@pytest.mark.parametrize("common", [64, 2])
def test_jaccard_components(spark, monkeypatch, common):
    """Also with almost every value common, so that the exact way for them is taken."""
    monkeypatch.setattr(ngram_join, "COMMON", common)
    rows = corpus()
    base = rows[20][1] or "w " * 50
    rows += [(1000 + i, base + f" extra{i}", "en", "s1", 0, "", "", "") for i in range(8)]
    sets, root = joined(rows)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(frame(spark, rows)).collect()}
    assert found == {i: (len(s), root[i]) for i, s in sets.items()}


def test_jaccard_repeated_and_null_ids(spark):
    rows = [(7, "a b c d e f", *[None] * 6), (7, "a b c d e f", *[None] * 6), (None, "a b c d e f", *[None] * 6), (None, "q r", *[None] * 6)]
    found = sorted(((r.doc_id, r.component_id) for r in jaccard_components(frame(spark, rows)).collect()), key=str)
    assert found == [(7, 7), (7, 7), (None, 7), (None, None)]
    assert jaccard_components(frame(spark, [])).count() == 0


def removed(rows, length=100):
    seen, out = set(), {}
    for i, text in sorted((r[0], r[1] or "") for r in rows):
        b = text.encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            w = b[p:p + length]
            if w in seen:
                gone[p:p + length] = b"\1" * length
            seen.add(w)
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out[i] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def test_remove_repeats(spark):
    rows = corpus(seed=5)
    df = remove_repeats(frame(spark, rows), carry=["lang", "runs"])
    found = {r.doc_id: tuple(r)[2:6] for r in df.select("carried", "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()}
    assert found == removed(rows)
    assert any(v[1] for v in found.values())


def test_remove_repeats_ids(spark):
    text = "".join(random.Random(1).choices("abcdefgh", k=150))
    rows = [(5, text, *[None] * 6), (5, text, *[None] * 6), (None, text, *[None] * 6)]
    found = sorted(((r.doc_id, r.n_removed) for r in remove_repeats(frame(spark, rows)).collect()), key=str)
    assert found == [(5, 150), (5, 150), (None, 0)]
    assert remove_repeats(frame(spark, [])).count() == 0


@pytest.mark.parametrize("parts", [1, 2])
def test_remove_repeats_equal_rows(spark, parts):
    """Rows equal in id and text are one document, not earlier than itself; a repeat inside it goes."""
    draw = random.Random(2)
    text, inner = ("".join(draw.choices("abcdefgh", k=k)) for k in (400, 150))
    rows = [(5, text, *[None] * 6)] * 2
    found = [(r.doc_id, r.n_removed) for r in remove_repeats(frame(spark, rows).repartition(parts)).collect()]
    assert found == [(5, 0), (5, 0)]
    rows = [(5, inner + text + inner, *[None] * 6)] * 40 + [(None, "".join(draw.choices("xyz", k=300)), *[None] * 6)] * 2 + [(9, text, *[None] * 6)]
    found = sorted(((r.doc_id, r.n_removed) for r in remove_repeats(frame(spark, rows).repartition(parts)).collect()), key=str)
    assert found == [(5, 150)] * 40 + [(9, 400)] + [(None, 0)] * 2


def test_near_pairs(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(120, 8))
    x[40:70] = x[40] + rng.normal(size=(30, 8)) * 0.1
    x[90:100] = x[90]
    rows = [(i * 2, v.tolist(), 1) for i, v in enumerate(x)]
    odd = [(1001, None, 0), (1003, [0.0] * 8, 0), (1005, [float("nan")] + [1.0] * 7, 0), (1007, [1.0, None] + [1.0] * 6, 0), (1009, [1.0, 2.0], 0), (None, x[0].tolist(), 0)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, node int")
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_pairs(df).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = u @ u.T >= 0.95
    np.fill_diagonal(near, False)
    root = roots(range(120), zip(*np.nonzero(near)))
    for i in range(1, 120):
        assert found[2 * i] == (near[i].sum(), 2 * root[i], root[i] == i)
    assert found[0][0] == near[0].sum() + 1 and found[None] == (found[0][0], found[0][1], False)
    assert all(found[i] == (0, i, True) for i in (1001, 1003, 1005, 1007, 1009))
    assert near_pairs(df.limit(0)).count() == 0


def linked(ids, x):
    """What near_pairs gives, from all products."""
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = u @ u.T >= 0.95
    np.fill_diagonal(near, False)
    root = roots(range(len(x)), zip(*np.nonzero(near)))
    least = {}
    for i, r in root.items():
        least[r] = min(least.get(r, ids[i]), ids[i])
    return sorted((ids[i], int(near[i].sum()), least[root[i]]) for i in range(len(x)))


@pytest.mark.parametrize("rows", [16, 100])
def test_near_pairs_over_many_cells_and_blocks(spark, monkeypatch, rows):
    """Clusters, tight and loose, and random directions of two lengths; several levels above the blocks, hot copies, repeated ids."""
    monkeypatch.setattr(cover_tree, "block_rows", lambda dim: rows)
    monkeypatch.setattr(cover_tree, "LARGE", 1)
    monkeypatch.setattr(cover_tree, "PIVOTS", 6)
    rng = np.random.default_rng(rows)
    spread = np.repeat(rng.normal(size=(30, 12)), 20, axis=0) + rng.normal(size=(600, 12)) * rng.choice([0.01, 0.1, 0.3], size=(600, 1))
    x = np.concatenate([spread, np.repeat(spread[:1], 150, axis=0), rng.normal(size=(150, 12))])
    y = np.repeat(rng.normal(size=(5, 3)), 30, axis=0) + rng.normal(size=(150, 3)) * 0.1
    ids = [int(i) for i in rng.permutation(len(x))]
    more = [i + 10_000 for i in range(len(y))]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in [*zip(ids, x), *zip(more, y)]], "vec_id long, embedding array<double>")
    found = sorted((r.vec_id, r.n_links, r.component_id) for r in near_pairs(df).collect())
    assert found == sorted(linked(ids, x) + linked(more, y))
    again = near_pairs(df.union(df.where("vec_id < 3"))).where("vec_id < 3").collect()
    assert len(again) == 6 and {r.vec_id for r in again} == {0, 1, 2}


@pytest.mark.parametrize("same", [False, True])
@pytest.mark.parametrize("tight", [0.02, 0.5])
def test_blocks_are_compared_whole(same, tight):
    """Nodes that can't meet are pruned, all links are found, by single and by double precision."""
    rng = np.random.default_rng(6)
    base = rng.normal(size=(20, 16))
    unit = lambda n, scale: (v := base[rng.integers(0, 20, n)] + rng.normal(size=(n, 16)) * scale) / np.linalg.norm(v, axis=1, keepdims=True)
    x, y = unit(1500, tight), unit(900, tight)
    (p, la), (q, lb) = cover_tree.build(x, 0.3), cover_tree.build(y, 0.3)
    x, y = x[p], y[q]
    if same:
        y, lb = x, la
    open_ = cover_tree.dual(la, lb, float(np.sqrt(0.1)))
    assert tight > 0.1 or len(la) > 2 and open_.mean() < 0.5
    found = [pair for a, b in cover_tree.hits(x, y, open_, (la[-1][0], lb[-1][0]), 0.95, same) for pair in zip(a.tolist(), b.tolist())]
    near = np.triu(x @ y.T >= 0.95, 1) if same else x @ y.T >= 0.95
    assert len(found) == len(set(found)) and set(found) == set(zip(*(v.tolist() for v in np.nonzero(near))))


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 50), (100, 101), (7, 7)]
    found = dict(components(spark.createDataFrame(chain, "a long, b long")).collect())
    assert found == {**{i: 0 for i in range(41)}, 50: 50, 100: 50, 101: 50}


def test_fingerprints(spark):
    rows = corpus(seed=9)
    df = fingerprints(frame(spark, rows))
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
    found = {r.doc_id: r for r in df.collect()}
    texts = dict(sorted((r[0], r[1] or "") for r in rows))
    ids = list(texts)
    by_text, error = {}, []
    for i, at in enumerate(ids):
        text, after = texts[at], texts[ids[(i + 1) % len(ids)]]
        k = len(text) // 4
        edited = text[:len(text) - k] + after[:k]
        r = found[at]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert by_text.setdefault(text, r.fingerprint) == r.fingerprint
        if edited == text:
            assert r.near_edited == 1 and r.fingerprint == r.edited_fingerprint
        a, b = shingles(text), shingles(edited)
        if len(a | b) >= 100:
            error.append(r.near_edited - len(a & b) / len(a | b))
        assert 0 <= r.near_next <= 1
    assert abs(np.mean(error)) < 0.03 and np.abs(error).max() < 0.25
    assert fingerprints(frame(spark, [])).count() == 0
