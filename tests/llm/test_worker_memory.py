"""What workers hold: buckets are worked through in parts, with the same results, and memory is given back."""

import tracemalloc

import numpy as np
import pyarrow as pa

import corpus_pipeline
from llm.llm_frames import corpus, frame, roots, shingles
from watthour.llm import ngram_join, suffix_dedup, textops


def rows_of(table):
    return sorted(map(str, table.to_pylist()))


def test_values_are_matched_by_ranges(monkeypatch):
    texts = [r[1] for r in corpus()] + ["a b c d e f g h i j k l " * 3 + f"extra{i}" for i in range(80)]
    index = pa.Table.from_batches(ngram_join._index("text", 1)([pa.RecordBatch.from_pydict({"text": t}) for t in (texts[:70], texts[70:])]))
    whole = ngram_join._match(index)
    assert whole["mask"].null_count and whole["need_b"].null_count  # pairs, and values in more than COMMON sets
    monkeypatch.setattr(ngram_join, "MATCHED", 50)
    assert rows_of(ngram_join._match(index)) == rows_of(whole)
    lone = index.slice(0, 1).set_column(1, "entries", pa.array([np.uint64([1 << 16]).tobytes()], pa.binary()))
    assert ngram_join._match(lone).equals(ngram_join.FOUND.empty_table())


def test_a_bucket_is_matched_in_little_memory():
    """Every value is that of two sets, so nothing can be left out."""
    rng, blobs, sets = np.random.default_rng(1), 128, 500
    values = rng.integers(0, 1 << 48, 400_000, dtype=np.uint64) << np.uint64(16)
    owners = rng.integers(0, blobs, (2, len(values)))
    out = []
    for k in range(blobs):
        own = np.concatenate([values[o == k] for o in owners])
        own = np.sort(own | rng.integers(0, sets, len(own)).astype(np.uint64) << np.uint64(4))
        out.append((own.tobytes(), rng.integers(-2**63, 2**63, sets).tobytes(), np.full(sets, 300, np.uint32).tobytes(), bytes(2 * sets)))
    table = pa.table([pa.array(c, pa.binary()) for c in zip(*out)], names=["entries", "nodes", "sizes", "voids"])
    tracemalloc.start()
    found = ngram_join._match(table)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found.num_rows > 390_000
    assert peak < 16 * table.nbytes


def test_groups_are_verified_some_at_a_time(monkeypatch):
    texts = list({ngram_join._node(h): t for t in {r[1] for r in corpus(seed=5)}
                  if len(h := ngram_join.shingles(*ngram_join.joined(pa.array([t])))[0]) >= 4}.items())
    third = len(texts) // 3
    groups = [(g, texts[at:at + third]) for g, at in enumerate((0, third, 2 * third))] + [(3, texts)]
    rows = [{"node": n, "root": g, "i": 0, "j": 0, "text": t} for g, own in groups for n, t in own]
    table = pa.Table.from_batches(pa.Table.from_pylist(rows[::-1]).to_batches(max_chunksize=7))
    links = lambda: set(map(tuple, zip(*ngram_join._verify(table).to_pydict().values())))
    whole = links()
    monkeypatch.setattr(ngram_join, "VERIFIED", 300)
    assert links() == whole
    sets = {n: shingles(t) for n, t in texts}
    near = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    assert near and roots(sets, whole) == roots(sets, near)


def test_windows_that_occur_once_take_little_memory():
    rng, cells, n = np.random.default_rng(2), 100, 6000
    out = []
    for k in range(cells):
        h = np.sort(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        w = np.arange(n, dtype=np.uint64) << np.uint64(14) | rng.integers(0, 50, n).astype(np.uint64) << np.uint64(2) | np.uint64(suffix_dedup.OPEN)
        if k < 2:  # the same windows in the first two cells, of texts 3 and 53
            h[:7], w[:7] = 1 + np.arange(7), (np.arange(7, dtype=np.uint64) + np.uint64(100 * k)) << np.uint64(14) | np.uint64(13)
        out.append((h.tobytes(), w.tobytes(), (np.arange(50) + 50 * k).tobytes(), np.zeros(50, np.int32).tobytes()))
    table = pa.table([pa.array(c, pa.binary()) for c in zip(*out)], names=["hashes", "places", "ids", "versions"])
    tracemalloc.start()
    found = suffix_dedup._repeated(table)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found.to_pylist() == [{"doc_id": 53, "version": 0, "first": 100, "span": 6}]
    assert peak < 4 * table.nbytes


def test_a_worker_between_groups_holds_no_tables():
    textops.range_hash(textops.prefix_hash(np.zeros(10, np.uint8)), np.zeros(1, int), np.ones(1, int))
    assert textops._POWERS
    assert textops.lean_group(lambda table: table.num_rows)(pa.table({"x": [1, 2]})) == 2
    assert not textops._POWERS


def test_repeats_are_removed_by_one_python_step_a_stage(spark):
    """Two steps in a stage would take two workers a task, and idle ones keep what they hold."""
    rows = corpus(seed=11, size=20) + [(9000 + i, ("漢字é" * 40)[i:] + "q" * i, *[None] * 6) for i in range(3)]
    docs = frame(spark, rows)
    whole = {r.doc_id: bytes(r.kept).decode("utf-8", "ignore") for r in suffix_dedup.remove_repeats(docs).collect()}
    out = corpus_pipeline.remove_repeated_strings(spark, docs, "")
    assert out.columns == docs.columns and {r.doc_id: r.text for r in out.collect()} == whole
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "EvalPython" not in plan
