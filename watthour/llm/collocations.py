"""Phrases of words that stand together far more often than apart, from truncated suffix trees.

Vertical partitioning, after ERA: every word position starts a suffix of ``longest`` words,
cut at the end of its piece.  The prefixes of suffixes are extended by a word until each has
at most ``budget`` suffixes, and are brought together into groups of about that many.  The
suffixes of one group fit into one task, which builds its part of the suffix tree, cut at depth
``longest``, without looking at any other group.  A node's count is the total of the leaves
below it.  Only nodes above an extended prefix lie in several groups; their partial totals
are added.

Words are runs of bytes other than space and tab, with A-Z folded, inside pieces of text
between ``.,;:!?`` and line ends.  Everything is counted within a language.  A word's id is a
64-bit hash of language and word; the ids of words that occur ``least`` times, the only ones in
results, are checked to be unique.  No phrase holds a rarer word, so suffixes end before one; a
bitmap of fixed size, which never loses a frequent word, tells them.

Defined cases: a null text is empty, a null language is ``und``; empty texts, texts without
words and empty tables give no phrase; repeated rows count as often as they stand; ties go by
score, count and the phrase's bytes; only the language and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from watthour.llm.staging import stage
from watthour.llm.textops import U64, blob, joined, lean, mix, slices, trim, word_hashes, word_spans

LONGEST = 4
LEAST = 30
BUDGET = 1 << 20  # suffixes in a group
HOT = 1 << 22  # extended prefixes, at most: the budget grows where a corpus would have more
LIGHT = 8  # prefixes above this part of the budget are placed one by one
BITS = 27  # of the bitmap of frequent words: 16 MB
PART = 8 << 20  # bytes of text worked on at once
FACTOR = 2_000_000
SALTS = 32  # shares of a frequent word's look-ups, and of a language's ranking

_FOLD = np.arange(256, dtype=np.uint8)  # A-Z to a-z, tab to space, ends of pieces to newline
_FOLD[65:91] += 32
_FOLD[9] = 32
_FOLD[list(b".,;:!?\x0a\x0b\x0c\x0d")] = 10


def _gathered(batches, size: int = PART) -> Iterator[pa.Table]:
    """The rows in parts of about ``size`` bytes (one row at least)."""
    held, total = [], 0
    for batch in batches:
        for part in slices(batch, "text", 1 << 20, size):
            held.append(part)
            total += part.nbytes
            if total >= size:
                yield pa.Table.from_batches(held).combine_chunks()
                held, total = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


class Words:
    """The words of a part: where they stand, their ids, pieces and languages."""

    def __init__(self, part: pa.Table) -> None:
        data, offsets = joined(part.column("text"))
        self.data = _FOLD[data]
        self.starts, words = word_hashes(self.data)
        names = part.column("lang").to_pylist()
        self.langs = sorted(set(names))
        at = {name: i for i, name in enumerate(self.langs)}
        salt = [int.from_bytes(blake2b(n.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little") for n in self.langs]
        doc = np.searchsorted(offsets, self.starts, side="right") - 1
        self.lang = np.array([at[n] for n in names], dtype=np.int64)[doc]
        self.ids = np.maximum(mix(words + np.array(salt, dtype=U64)[self.lang]), U64(1))
        self.piece = np.searchsorted(np.flatnonzero(self.data == 10), self.starts)

    def strings(self, which: np.ndarray) -> pa.Array:
        _, ends = word_spans(self.data)
        starts, size = self.starts[which], (ends - self.starts)[which]
        offsets = np.concatenate([[0], np.cumsum(size)])
        flat = self.data[np.repeat(starts - offsets[:-1], size) + np.arange(offsets[-1])]
        return pa.LargeStringArray.from_buffers(len(which), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(flat)).cast(pa.string())


WORDS = "id long, lang string, word string, n long"


def _count_words(batches):
    """Counts of the words of each part; id 0 counts all of a language."""
    for part in _gathered(batches):
        words = Words(part)
        ids, first, n = np.unique(words.ids, return_index=True, return_counts=True)
        names = pa.array(words.langs, pa.string())
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids.view(np.int64)), names.take(pa.array(words.lang[first])), words.strings(first), pa.array(n)],
            names=["id", "lang", "word", "n"])
        total = np.bincount(words.lang, minlength=len(names))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.zeros(len(names), dtype=np.int64)), names, pa.array([""] * len(names)), pa.array(total)],
            names=["id", "lang", "word", "n"])


def _bitmap(table: pa.Table) -> pa.Table:
    slots = np.unique(table.column("slot").to_numpy() & 0xFFFF)
    bits = np.zeros(1 << 16, dtype=bool)
    bits[slots] = True
    return pa.table({"chunk": table.column("chunk")[:1], "bits": pa.array([np.packbits(bits, bitorder="little").tobytes()])})


def frequent_bits(words: DataFrame) -> np.ndarray:
    """2**BITS bits, set where the high bits of some frequent word's id point."""
    slot = F.shiftrightunsigned("id", 64 - BITS)
    chunks = words.select(slot.alias("slot"), F.shiftright(slot, 16).alias("chunk"))
    out = np.zeros(1 << BITS - 3, dtype=np.uint8)
    for row in chunks.groupBy("chunk").applyInArrow(_bitmap, "chunk long, bits binary").collect():
        out[row.chunk << 13:(row.chunk + 1) << 13] = np.frombuffer(row.bits, dtype=np.uint8)
    return out


def _suffixes(words: Words, bits: np.ndarray, longest: int) -> list[np.ndarray]:
    """The ids of the words of every suffix of two words or more; 0 where it has ended."""
    slot = words.ids >> U64(64 - BITS)
    fine = (bits[(slot >> U64(3)).astype(np.int64)] >> (slot & U64(7)).astype(np.uint8) & 1).astype(bool)
    n = len(words.ids)
    alive, columns = fine.copy(), [words.ids]
    for d in range(1, longest):
        on = np.zeros(n, dtype=bool)
        if n > d:
            on[:n - d] = alive[:n - d] & fine[d:] & (words.piece[d:] == words.piece[:n - d])
        column = np.zeros(n, dtype=U64)
        column[:n - d][on[:n - d]] = words.ids[d:][on[:n - d]]
        columns.append(column)
        alive = on
    keep = columns[1] != 0
    return [c[keep] for c in columns]


def _extend(key: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix(key * U64(0xD6E8FEB86659FD93) + word)


def _member(x: np.ndarray, sorted_: np.ndarray) -> np.ndarray:
    if not len(sorted_):
        return np.zeros(len(x), dtype=bool)
    return sorted_[np.minimum(np.searchsorted(sorted_, x), len(sorted_) - 1)] == x


def _count_prefixes(depth: int, plan: Broadcast):
    """Counts of prefixes of ``depth`` words below the extended ones of one word less."""
    def run(batches):
        bits, hot, longest = plan.value["bits"], plan.value["hot"], plan.value["longest"]
        for part in _gathered(batches):
            columns = _suffixes(Words(part), bits, longest)
            key = columns[0]
            for d in range(1, depth):
                below = _member(key, hot[d - 1])
                key, columns = _extend(key[below], columns[d][below]), [c[below] for c in columns]
            keys, n = np.unique(key, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], names=["key", "n"])
    return lean(run)


def _placed(columns: list[np.ndarray], plan: dict) -> np.ndarray:
    """The group of every suffix: of its shortest prefix that is not extended."""
    key = columns[0].copy()
    open_ = np.arange(len(key))
    for d, hot in enumerate(plan["hot"]):
        open_ = open_[_member(key[open_], hot)]
        key[open_] = _extend(key[open_], columns[d + 1][open_])
    group = ((mix(key) >> U64(32)) * U64(plan["light"]) >> U64(32)).astype(np.int64)
    heavy, bins = plan["heavy"]
    own = _member(key, heavy)
    group[own] = plan["light"] + bins[np.searchsorted(heavy, key[own])]
    return group


def _ship(plan: Broadcast):
    """The suffixes of each part by group, equal ones as one with a count."""
    def run(batches):
        codec = pa.Codec("zstd", compression_level=1)
        for part in _gathered(batches):
            columns = _suffixes(Words(part), plan.value["bits"], plan.value["longest"])
            whole = columns[0]
            for c in columns[1:]:
                whole = _extend(whole, c)
            order = np.argsort(whole)
            again = np.ones(max(len(order) - 1, 0), dtype=bool)
            for c in columns:  # by the words themselves: two hashes may be equal
                c = c[order]
                again &= c[1:] == c[:-1]
            first = np.flatnonzero(np.append([True], ~again)) if len(order) else order
            times = np.diff(np.append(first, len(order))).astype(np.uint32)
            columns = [c[order[first]] for c in columns]
            group = _placed(columns, plan.value)
            order = np.lexsort((columns[0], group))
            columns, times, group = [c[order] for c in columns], times[order], group[order]
            starts = np.flatnonzero(np.diff(group, prepend=-1))
            ends = np.append(starts[1:], len(group))
            sizes, data = [], []
            for a, b in zip(starts, ends):
                raw = b"".join([*(blob(c[a:b]) for c in columns), blob(times[a:b])])
                sizes.append(len(raw))
                data.append(codec.compress(raw, asbytes=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(group[starts]), pa.array(sizes, pa.int64()), pa.array(data, pa.binary())], names=["grp", "size", "data"])
    return lean(run)


def _tree(plan: Broadcast, least: int):
    """Nodes of two words or more of a group's tree, with their totals."""
    def run(table: pa.Table) -> pa.Table:
        hot, longest = plan.value["hot"], plan.value["longest"]
        codec = pa.Codec("zstd")
        parts, counts = [], []
        for size, data in zip(table.column("size").to_pylist(), table.column("data").to_pylist()):
            raw = codec.decompress(data, size)
            n = size // (8 * longest + 4)
            parts.append(np.frombuffer(raw, dtype=U64, count=n * longest).reshape(longest, n))
            counts.append(np.frombuffer(raw, dtype=np.uint32, offset=8 * longest * n))
        leaves, count = np.concatenate(parts, axis=1), np.concatenate(counts).astype(np.int64)
        del parts, counts, table
        order = np.lexsort(leaves[::-1])
        leaves, count = leaves[:, order], count[order]
        split = np.zeros(leaves.shape[1], dtype=bool)  # the path of words changes here
        split[0] = True
        key, out = leaves[0], []
        for d in range(1, longest + 1):
            split[1:] |= leaves[d - 1][1:] != leaves[d - 1][:-1]
            first = np.flatnonzero(split)
            if d > 1:
                key = _extend(key, leaves[d - 1])
                total = np.add.reduceat(count, first)
                partial = _member(key[first], hot[d - 1]) if d <= len(hot) else np.zeros(len(first), dtype=bool)
                keep = (leaves[d - 1][first] != 0) & (partial | (total >= least))
                path = leaves[:, first[keep]].copy()
                path[d:] = 0
                out.append((path, np.full(keep.sum(), d, dtype=np.int32), total[keep], partial[keep]))
        path = np.concatenate([o[0] for o in out], axis=1)
        trim()
        return pa.table({**{f"w{i}": pa.array(path[i].view(np.int64)) for i in range(longest)},
                         "len": np.concatenate([o[1] for o in out]), "n": np.concatenate([o[2] for o in out]),
                         "partial": np.concatenate([o[3] for o in out])})
    return run


def _next_fit(n: np.ndarray, capacity: int) -> np.ndarray:
    """Bins of prefixes, largest first, none above ``capacity``."""
    out, at, room = np.zeros(len(n), dtype=np.int64), 0, capacity
    for i in np.argsort(-n, kind="stable"):
        if n[i] > room:
            at, room = at + 1, capacity
        out[i], room = at, room - n[i]
    return out


def phrase_counts(texts: DataFrame, words: DataFrame, total: int, longest: int = LONGEST,
                  least: int = LEAST, budget: int = BUDGET) -> DataFrame:
    """(w0.., len, n): every phrase of 2 to ``longest`` words that occurs ``least`` times."""
    context = texts.sparkSession.sparkContext
    budget = max(budget, total // HOT)
    plan = {"bits": frequent_bits(words), "hot": [], "longest": longest}

    def large(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
        rows = counts.where(F.col("n") * LIGHT > budget).toPandas()  # at most LIGHT * total / budget
        return rows.iloc[:, 0].to_numpy(dtype=np.int64).view(U64), rows["n"].to_numpy(dtype=np.int64)

    keys, n = large(words.select("id", "n"))
    heavy = [(keys[n <= budget], n[n <= budget])]
    depth = 1
    while (n > budget).any() and depth < longest - 1:
        plan["hot"].append(np.sort(keys[n > budget]))
        depth += 1
        counts = texts.mapInArrow(_count_prefixes(depth, context.broadcast(plan)), "key long, n long")
        keys, n = large(counts.groupBy("key").agg(F.sum("n").alias("n")))
        heavy.append((keys[n <= budget], n[n <= budget]))
    if (n > budget).any():  # one word more is the whole suffix
        plan["hot"].append(np.sort(keys[n > budget]))
    keys, n = (np.concatenate(x) for x in zip(*heavy))
    bins, order = _next_fit(n, budget), np.argsort(keys)
    plan |= {"heavy": (keys[order], bins[order]), "light": 2 * total // budget + 1}
    shared = context.broadcast(plan)
    shipped = texts.mapInArrow(_ship(shared), "grp long, size long, data binary")
    path = [f"w{i}" for i in range(longest)]
    nodes = stage(shipped.groupBy("grp").applyInArrow(
        _tree(shared, least), ", ".join(f"{w} long" for w in path) + ", len int, n long, partial boolean"), "nodes")
    above = nodes.where("partial").groupBy(*path, "len").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    return nodes.where("NOT partial").drop("partial").unionByName(above)


def _padded(words: list[Column], longest: int) -> list[Column]:
    return [*words, *([F.lit(0).cast("long")] * (longest - len(words)))]


def collocations(docs: DataFrame, top: int = 2000, least: int = LEAST, longest: int = LONGEST,
                 budget: int = BUDGET, inside: int = 80, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases.

    a, l and r are the counts of the phrase and of both sides of the cut with the lowest score,
    n all words of the language; score = floor(2000000 a / (l + r)).  A phrase goes if one that
    holds it has at least ``inside`` per cent of its count.
    """
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))
    counted = texts.mapInArrow(lean(_count_words), WORDS).groupBy("id", "lang", "word").agg(F.sum("n").alias("n"))
    counted = stage(counted.where((F.col("n") >= least) | (F.col("id") == 0)), "words")
    totals, words = counted.where("id = 0").select("lang", "n"), counted.where("id <> 0")
    if words.groupBy("id").count().where("count > 1").limit(1).count():
        raise ValueError("two frequent words share an id")
    total = totals.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    phrases = stage(phrase_counts(texts, words, total, longest, least, budget), "phrases")

    path = [f"w{i}" for i in range(longest)]
    part = [f"p{i}" for i in range(longest)]
    salt = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    singles = words.select(*[c.alias(p) for c, p in zip(_padded([F.col("id")], longest), part)], "lang", F.col("n").alias("m"), salt)
    known = singles.unionByName(phrases.where(F.col("len") < longest).select(
        *[F.col(w).alias(p) for w, p in zip(path, part)], F.lit(None).cast("string").alias("lang"), F.col("n").alias("m"), F.lit(0).alias("salt")))

    def side(columns: list[str], cut: int, right: bool) -> Column:
        spread = F.pmod(F.hash(*path), F.lit(SALTS)) if len(columns) == 1 else F.lit(0)
        return F.struct(*[c.alias(p) for c, p in zip(_padded([F.col(c) for c in columns], longest), part)],
                        spread.cast("int").alias("salt"), F.lit(cut).alias("cut"), F.lit(right).alias("right"))

    sides = F.lit(None)
    for size in range(2, longest + 1):
        all_ = F.array(*[side(path[a:b], k, a > 0) for k in range(1, size) for a, b in ((0, k), (k, size))])
        sides = F.when(F.col("len") == size, all_).otherwise(sides)
    looked = phrases.select(*path, "len", "n", F.explode(sides).alias("s")).select(*path, "len", "n", "s.*").join(known, [*part, "salt"])
    sums = [F.sum(F.when((F.col("cut") == k) & (F.col("right") == right), F.col("m"))).alias(f"{'r' if right else 'l'}{k}")
            for k in range(1, longest) for right in (False, True)]
    scored = looked.groupBy(*path, "len", "n").agg(*sums, F.max(F.when((F.col("cut") == 1) & ~F.col("right"), F.col("lang"))).alias("lang"))
    cuts = F.array_min(F.filter(F.array(*[
        F.when(F.col("len") > k, F.struct(
            F.expr(f"CAST(n AS DECIMAL(20,0)) * {FACTOR} div (l{k} + r{k})").alias("score"),
            F.lit(k).alias("cut"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"))) for k in range(1, longest)]), lambda c: c.isNotNull()))
    scored = scored.select(*path, "len", "lang", F.col("n").alias("a"), cuts.alias("c")).select(*path, "len", "lang", "a", "c.score", "c.l", "c.r")

    parts = F.lit(None)
    for size in range(3, longest + 1):
        subs = F.array(*[F.struct(*[c.alias(w) for c, w in zip(_padded([F.col(p) for p in path[a:a + m]], longest), path)])
                         for m in range(2, size) for a in range(size - m + 1)])
        parts = F.when(F.col("len") == size, subs).otherwise(parts)
    holders = phrases.where("len > 2").select(F.explode(parts).alias("s"), "n").select("s.*", "n").groupBy(*path).agg(F.max("n").alias("held"))
    kept = scored.join(holders, path, "left").where(f"held IS NULL OR 100 * held < {inside} * a").drop("held")

    share = F.pmod(F.hash(*path), F.lit(SALTS))
    best = [F.desc("score"), F.desc("a")]
    for by in (["lang", share], ["lang"]):  # ties stay: their order needs the words
        kept = kept.withColumn("_at", F.rank().over(W.partitionBy(*by).orderBy(*best))).where(F.col("_at") <= top).drop("_at")
    kept = stage(kept, "best")
    spelled = kept.select(*path, F.posexplode(F.array(*path)).alias("pos", "id")).where("id <> 0").join(words.select("id", "word"), "id")
    spelled = spelled.groupBy(*path).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    named = kept.join(spelled, path)
    for by in (["lang", share], ["lang"]):
        named = named.withColumn("rank", F.row_number().over(W.partitionBy(*by).orderBy(*best, "phrase"))).where(F.col("rank") <= top)
    return named.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
