"""Small corpora and plain-Python versions to compare with."""

from __future__ import annotations

import random
import re

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, bucket string, runs string, node string"


def words(text):
    return WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(text):
    w = words(text)
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def corpus(seed=3, size=60):
    """Texts with copies, near copies, shared passages, nulls, empties, ties and odd characters."""
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdéñü漢") for _ in range(rng.randint(1, 7))) for _ in range(400)]
    make = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    texts = [None, "", "   \n\t", "one", "One", "two words", "a b c d", "a b c d e", "a b c d e f", "!!! 123", "x" * 5000,
             "ab" * 300, make(3000)]
    passage = make(60)
    for _ in range(size):
        base = make(rng.randint(5, 200))
        texts.append(base)
        kind = rng.random()
        if kind < 0.3:
            texts.append(base)
        elif kind < 0.6:
            w = base.split()
            w[rng.randrange(len(w))] = "changed"
            texts.append(" ".join(w))
        elif kind < 0.8:
            texts.append(make(20) + " " + passage + " " + make(rng.randint(1, 30)))
    rows = [(i * 3, t, rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "s3", None]), len(t or ""), "x", None, "y")
            for i, t in enumerate(texts)]
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def roots(ids, links):
    up = {i: i for i in ids}

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}
