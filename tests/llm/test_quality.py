"""Statistics against plain counts, trees against a node-by-node walk, verdicts on the tables."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from watthour.llm import quality as ops
from watthour.llm import textops


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i:i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    seen, dup, lines = set(), 0, 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            lines += 1
            dup += line in seen
            seen.add(line)
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
            "n_dup_lines": dup, "n_repeat_words": len(covered), "n_chars": len(text), "n_lines": lines,
            "n_upper": len(re.findall("[A-Z]", text)), "n_digits": len(re.findall("[0-9]", text)), "n_distinct": len(set(words))}


def texts(seed):
    rng = random.Random(seed)
    words = ["a", "b", "The", "##", "é$", "日本", "x|y", "1.5", " ", "\x1c"]
    out = [None, "", " \n\t", "a", "a b c a b c", "a b c d a b c", "same\nsame\n same\nsame ", "a\r\na\n\na\n"]
    for _ in range(40):
        out.append("".join(rng.choice(words[: rng.randint(1, 10)]) + rng.choice([" ", " ", " ", "\n", "  ", "\t", "\x0b"]) for _ in range(rng.randint(0, 80))))
    return out


@pytest.mark.parametrize("seed, chunk", [(1, None), (2, 7), (3, 64)])
def test_statistics_equal_plain_counts(monkeypatch, seed, chunk):
    if chunk:
        for module in (textops, ops):
            monkeypatch.setattr(module, "CHUNK", chunk)
        monkeypatch.setattr(textops, "_POWERS", {})
    listed = texts(seed)
    got = ops.statistics(pa.array(listed, pa.string()))
    for i, text in enumerate(listed):
        assert {k: int(got[k][i]) for k in plain(text)} == plain(text), text


def test_a_very_long_text():
    text = "word and more words\n" * 60000 + "w" * 1_200_000
    got = ops.statistics(pa.array([text, "x y"]))
    assert {k: int(got[k][0]) for k in plain(text)} == plain(text)


def sample(seed=0, n=600):
    rng = np.random.default_rng(seed)
    x = rng.random((n, 3)).round(2)
    good = (x[:, 0] + 0.3 * x[:, 1] + 0.1 * rng.normal(size=n) < 0.6).astype(float)
    return x, good


def test_trees_learn_and_never_rise_where_they_may_not():
    x, good = sample()
    forest = ops.fit(x, good, 1 - good, {0})
    assert ((forest.score(x) >= 0.5) == (good > 0)).mean() > 0.9
    other, truth = sample(1)
    assert ((forest.score(other) >= 0.5) == (truth > 0)).mean() > 0.85
    line = np.linspace(-0.5, 1.5, 300)
    for b, c in np.random.default_rng(2).random((50, 2)):
        score = forest.score(np.stack([line, np.full(300, b), np.full(300, c)], axis=1))
        assert (np.diff(score) <= 1e-12).all()
    free = ops.fit(x[:, [0]], 1 - good, good, set())  # the labels turned round: free trees rise
    bound = ops.fit(x[:, [0]], 1 - good, good, {0})
    assert np.diff(free.score(line[:, None])).max() > 0.1 and np.ptp(bound.score(line[:, None])) < 1e-9


def test_flat_arrays_equal_a_walk():
    x, good = sample()
    forest = ops.fit(x, good, 1 - good, {0}, trees=7, depth=3)
    for row, score in zip(x[:50], forest.score(x[:50])):
        total = forest.base
        for node in forest.roots:
            while forest.left[node] != node:
                node = forest.left[node] if row[forest.feature[node]] <= forest.cut[node] else forest.right[node]
            total += forest.value[node]
        assert score == pytest.approx(1 / (1 + np.exp(-total)))


def junk(i):
    rng = random.Random(i)
    return " ".join(rng.choice(["ab", "cd", "ef"]) + "$$%" + str(rng.randint(0, 999)) for _ in range(120))


def clean(i):
    rng = random.Random(i)
    return " ".join("".join(rng.choices("abcdefghij", k=rng.randint(1, 9))) for _ in range(120))


def test_verdicts_nulls_repeats_and_other_columns(spark):
    rows = [(i, junk(i) if i % 4 == 0 else clean(i)) for i in range(200)]
    labels = [(i, 0 if i % 4 == 0 else 1) for i in range(0, 200, 2)] + [(5, None), (None, 1), (999, 0), (6, 1), (6, 1)]
    odd = [(1000, None), (1001, ""), (None, clean(7)), (None, junk(7)), (3, clean(3)), (1002, "same words here " * 40)]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows + odd], "doc_id long, text string, quality int, good string")
    known = spark.createDataFrame([(i, q, 0, "t") for i, q in labels], "doc_id long, quality int, toxic int, text string")
    got = ops.quality_rules(docs, known).collect()
    assert len(got) == 206
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert all(by[i][0].kept == (i % 4 != 0) for i in range(200))
    assert by[1000][0].base_failed and by[1001][0].base_failed and by[1002][0].base_failed
    assert sorted(r.kept for r in by[None]) == [False, True] and len(by[3]) == 2
    for r in got:
        want = plain(dict(rows + odd)[r.doc_id]) if r.doc_id is not None else None
        assert want is None or all(r[k] == v for k, v in want.items())


def test_no_labels_one_kind_and_no_documents(spark):
    docs = spark.createDataFrame([(1, clean(1)), (2, junk(2)), (3, "short")], "doc_id long, text string")
    for labels in ([], [(1, 1), (2, 1)], [(9, 0)]):
        known = spark.createDataFrame(labels, "doc_id long, quality int")
        assert {r.doc_id: r.kept for r in ops.quality_rules(docs, known).collect()} == {1: True, 2: True, 3: False}
    assert ops.quality_rules(docs.limit(0), spark.createDataFrame([(1, 0)], "doc_id long, quality int")).count() == 0


def test_held_out_labels_of_the_tables(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    stats = ops.document_statistics(spark.read.parquet(f"{sf}/documents.parquet"))
    held = F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0
    seen = ops.verdicts(stats, ops.train(stats, labels.where(~held))).join(labels.where(held).select("doc_id", F.col("quality").alias("truth")), "doc_id")
    right = seen.where(~F.col("base_failed")).agg(F.avg((F.col("kept") == (F.col("truth") > 0)).cast("double"))).first()[0]
    assert right > 0.9
