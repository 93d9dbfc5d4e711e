"""Phrase mining against a plain count of every phrase, and its defined cases."""

import random
import re
from collections import Counter

import pytest

from watthour.llm import collocations as ops

SCHEMA = "doc_id long, text string, lang string"


def plain(rows, top, least, longest=4, inside=80):
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", folded):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            n[lang] += len(words)
            for i in range(len(words)):
                for m in range(1, longest + 1):
                    if i + m <= len(words):
                        f[lang, tuple(words[i:i + m])] += 1
    out = []
    for (lang, phrase), a in f.items():
        if len(phrase) < 2 or a < least:
            continue
        held = [f[lang, p] for (other, p), m in f.items() if other == lang and len(p) > len(phrase) and m >= least
                and any(p[i:i + len(phrase)] == phrase for i in range(len(p) - len(phrase) + 1))]
        if any(100 * h >= inside * a for h in held):
            continue
        score, k = min((2000000 * a // (f[lang, phrase[:k]] + f[lang, phrase[k:]]), k) for k in range(1, len(phrase)))
        out.append((lang, -score, -a, " ".join(phrase).encode(), f[lang, phrase[:k]], f[lang, phrase[k:]]))
    result, seen = [], Counter()
    for lang, score, a, phrase, l, r in sorted(out):
        seen[lang] += 1
        if seen[lang] <= top:
            result.append((lang, seen[lang], phrase.decode(), -a, l, r, n[lang], -score))
    return result


def mined(spark, rows, **options):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return sorted(tuple(r) for r in ops.collocations(docs, **options).collect())


def corpus(seed):
    rng = random.Random(seed)
    words = ["the", "The", "of", "new", "york", "a", "b.c", "é", "ß", "x", " ", "日本"]
    gaps = [" ", "\t", "  ", ". ", ",", "\n", "\r\n", "; ", "\x0b"]
    rows = []
    for i in range(60):
        text = "".join(rng.choice(words[: rng.randint(2, 12)]) + rng.choices(gaps, [20, 1, 1, 1, 1, 1, 1, 1, 1])[0] for _ in range(rng.randint(0, 60)))
        rows.append((i, text, rng.choice(["en", "de", "en", None, "und"])))
    return rows


@pytest.mark.parametrize("seed, budget", [(1, 1 << 20), (2, 40), (3, 7), (4, 1)])
def test_equals_a_plain_count(spark, seed, budget):
    """Small budgets extend prefixes to their whole length."""
    rows = corpus(seed)
    want = plain(rows, 50, 4)
    assert len(want) > 50
    assert mined(spark, rows, top=50, least=4, budget=budget) == sorted(want)


def test_a_holder_drops_what_it_holds_and_ties_go_by_bytes(spark):
    rows = [(1, "new york city. " * 10 + "new york. " * 2, "en"), (2, "b a. é a. z a. " * 5, "en")]
    got = mined(spark, rows, top=10, least=4)
    assert [r[2] for r in got] == [r[2] for r in plain(rows, 10, 4)]
    assert "new york" not in [r[2] for r in got]
    assert got == plain(rows, 10, 4)


def test_scores_past_64_bits(spark):
    """The product is formed with more than 64 bits."""
    one = spark.createDataFrame([(10**14, 2 * 10**14)], "n long, l1 long").selectExpr(
        f"CAST(n AS DECIMAL(20,0)) * {ops.FACTOR} div (l1 + l1) AS score")
    assert one.first()["score"] == 500000


def test_nulls_empty_repeated_long_and_no_rows(spark):
    rows = [(None, None, None), (1, "", "en"), (1, " .,\n\t", None), (2, "p q", "en"), (2, "p q", "en"), (None, "p q " * 5000, "en"), (3, "w" * 70000, "de")]
    assert mined(spark, rows, top=10, least=2) == plain(rows, 10, 2)
    assert mined(spark, [], top=10) == []
    assert mined(spark, [(None, None, None)], top=10) == []


def test_other_columns_do_not_clash(spark):
    docs = spark.createDataFrame([("p q " * 9, "en", 1, "x", 5)], "text string, lang string, id long, word string, n long")
    docs = docs.withColumnRenamed("word", "grp").withColumn("w0", docs.n)
    assert [r.phrase for r in ops.collocations(docs, least=3).collect()] == [p[2] for p in plain([(1, "p q " * 9, "en")], 9, 3)]


def test_parts_of_any_size_count_the_same_words(monkeypatch):
    """In this process, where a small part takes effect."""
    import pyarrow as pa

    rows = corpus(7)
    batch = pa.RecordBatch.from_pydict({"lang": [lang or "und" for _, _, lang in rows], "text": [text for _, text, _ in rows]})

    def counts(size):
        monkeypatch.setattr(ops._gathered, "__defaults__", (size,))
        out, parts = Counter(), 0
        for part in ops._count_words(iter([batch.slice(0, 40), batch.slice(40)])):
            parts += 1
            for r in part.to_pylist():
                out[r["id"], r["lang"], r["word"]] += r["n"]
        return out, parts

    (one, few), (other, many) = counts(8 << 20), counts(100)
    assert one == other and few == 2 and many > 20
    words = Counter(w for (_, _, w), n in one.items() for _ in range(n) if w)
    assert words["the"] > 0 and "The" not in words
