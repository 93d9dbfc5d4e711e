"""Stupid-backoff scores of all documents under counts of all documents, as a relational plan.

The n-gram table is partitioned by the hash of its context word and joined there to the
n-grams of the documents, which travel in packed batches; scores are summed per document.

    S(w | v) = c(v w) / c(v)             if c(v w) >= ``least``
             = BACKOFF * c(w) / N        otherwise

A document of words w1..wn gets the sum of log S(w_i | w_{i-1}), with a start mark before w1.
Words are runs of bytes other than space and \\t..\\r, with A-Z folded, known by 44 bits of
their hash.  Frequent words would make hot partitions: the few words that are at least one in
``HOT`` of all are counted first and their n-grams are spread by both words.  N-grams that
back off to a word without a broadcast count go on to that word's partition.
"""

from __future__ import annotations

from math import log

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watthour.llm.staging import partitions, small_batches
from watthour.llm.textops import U64, blob, joined, lean, mix, slices, trim, word_hashes

BACKOFF = 0.4
HOT = 2000
BITS = 44
START, END = U64(1), U64(0)  # as words; the hashes of words are larger
SLICE = 3 << 20


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = joined(texts)
    starts, words = word_hashes(data)
    return np.maximum(words >> U64(64 - BITS), U64(2)), np.searchsorted(starts, offsets)


def _bucket(x: np.ndarray, buckets: int) -> np.ndarray:
    return ((mix(x) >> U64(32)) * U64(buckets) >> U64(32)).astype(np.int64)


def _frequent(only: np.ndarray | None):
    """Counts of words: those frequent in a part, or exactly those asked for; -1 counts all."""
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", 4096, SLICE):
                words, _ = _words(part.column("text"))
                names, counts = np.unique(words, return_counts=True)
                if only is None:
                    keep = counts * 2 * HOT >= len(words)
                else:
                    keep = np.isin(names, only)
                names, counts = names[keep].astype(np.int64), counts[keep]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.append(names, -1)), pa.array(np.append(counts, len(words)))], names=["word", "n"])
    return lean(run)


ROWS = "bucket int, kind int, batch long, keys binary, numbers binary, entries binary"
IDS, NGRAMS, SUMS, COUNTS, BACKED = range(5)
ROW = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("batch", pa.int64()),
                 ("keys", pa.binary()), ("numbers", pa.binary()), ("entries", pa.binary())])


def _rows(rows: list[tuple]) -> list[pa.Array]:
    return [pa.array(x, t) for x, t in zip(zip(*rows), ROW.types)] if rows else [pa.array([], t) for t in ROW.types]


def _ngrams(buckets: int, hot: np.ndarray):
    """Bigrams of every document by context: keys and numbers are the contexts and how many
    entries each has; an entry is word << 20 | document << 8 | times."""
    def run(batches):
        task, made = TaskContext.get().partitionId(), 0
        for batch in batches:
            for part in slices(batch, "text", 4096, SLICE):
                words, first = _words(part.column("text"))
                n = np.diff(first)
                some = n > 0
                doc = np.repeat(np.arange(len(n)), n)
                left = np.concatenate([[START], words[:-1]]) if len(words) else words
                left[first[:-1][some]] = START
                context = np.concatenate([left, words[first[1:][some] - 1]])
                word = np.concatenate([words, np.full(some.sum(), END)])
                doc = np.concatenate([doc, np.flatnonzero(some)])
                low = word << U64(20) | doc.astype(U64) << U64(8)
                spread = np.isin(context, hot)
                bucket = _bucket(np.where(spread, mix(context) + word, context), buckets)
                order = np.lexsort((low, context, bucket))
                context, low, bucket = context[order], low[order], bucket[order]
                if len(low):
                    cut = np.flatnonzero(np.concatenate([[True], (low[1:] != low[:-1]) | (context[1:] != context[:-1])]))
                    times = np.diff(np.append(cut, len(low)))
                    again = -(-times // 255)  # an entry holds 255 at most
                    cut = np.repeat(cut, again)
                    last = np.cumsum(again) - 1
                    size = np.full(len(cut), 255)
                    size[last] = times - (again - 1) * 255
                    context, low, bucket = context[cut], low[cut] | size.astype(U64), bucket[cut]
                name = task << 32 | made
                made += 1
                out = [(name % buckets, IDS, name, blob(part.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False)),
                        blob(n.astype(np.int64)), blob(np.array(part.column("doc_id").is_null(), dtype=np.int8)))]
                cuts = np.searchsorted(bucket, np.arange(buckets + 1))
                for k in np.flatnonzero(np.diff(cuts)):
                    c = context[cuts[k]:cuts[k + 1]]
                    start = np.flatnonzero(np.concatenate([[True], c[1:] != c[:-1]]))
                    number = np.diff(np.append(start, len(c))).astype(np.uint32)
                    out.append((int(k), NGRAMS, name, blob(c[start]), blob(number), blob(low[cuts[k]:cuts[k + 1]])))
                yield pa.RecordBatch.from_arrays(_rows(out), schema=ROW)
    return lean(run)


def _column(table: pa.Table, name: str, kind: type) -> list[np.ndarray]:
    return [np.frombuffer(b, dtype=kind) for b in table.column(name).to_pylist()]


def _sums(rows: list[tuple], batches: np.ndarray, place: np.ndarray, doc: np.ndarray, score: np.ndarray, buckets: int) -> None:
    """Add a row of sums by document for every batch (``place`` says which)."""
    key = place << 12 | doc
    total = np.bincount(key, weights=score, minlength=len(batches) << 12)
    for i, name in enumerate(batches):
        own = np.trim_zeros(total[i << 12:(i + 1) << 12], "b")
        rows.append((int(name) % buckets, SUMS, int(name), b"", b"", blob(own)))


def _score(buckets: int, hot: dict[int, int], total: int, least: int):
    names = np.array(sorted(hot), dtype=U64)
    known = np.array([hot[int(w)] for w in names], dtype=np.int64)

    def count(words: np.ndarray) -> np.ndarray:
        """Counts of the hot words, 0 for others."""
        if not len(names):
            return np.zeros(len(words), dtype=np.int64)
        at = np.minimum(np.searchsorted(names, words), len(names) - 1)
        return np.where(names[at] == words, known[at], 0)

    def run(table: pa.Table) -> pa.Table:
        trim()
        kind = table.column("kind").to_numpy()
        passed = table.filter(pa.array(kind == IDS))
        table = table.filter(pa.array(kind == NGRAMS))
        rows: list[tuple] = []
        if len(table):
            batches = table.column("batch").to_numpy()
            entries = _column(table, "entries", U64)
            place = np.repeat(np.arange(len(batches)), [len(e) for e in entries])
            entry = np.concatenate(entries)
            del entries
            context = np.concatenate([np.repeat(k, n) for k, n in zip(_column(table, "keys", U64), _column(table, "numbers", np.uint32))])
            times, word = (entry & U64(255)).astype(np.int64), entry >> U64(20)
            doc = (entry >> U64(8) & U64(0xFFF)).astype(np.int64)
            contexts, at = np.unique(context, return_inverse=True)
            own = np.bincount(at, weights=times).astype(np.int64)
            fixed = count(contexts)
            mine = fixed == 0
            rows.append((int(table.column("bucket")[0].as_py()), COUNTS, 0, blob(contexts[mine]), blob(own[mine]), b""))
            score = -np.log(np.where(mine, own, fixed))[at]
            del at, contexts
            _, pair = np.unique(mix(mix(context) + word), return_inverse=True)
            del context
            c2 = np.bincount(pair, weights=times)[pair]
            del pair
            real = word != END
            seen = real & (c2 >= least)
            score += np.log(c2)
            del c2
            score[~seen] = log(BACKOFF) - log(max(total, 1))
            score[~real] = 0
            back = count(word)
            known_back = np.flatnonzero(real & ~seen & (back > 0))
            score[known_back] += np.log(back[known_back])
            score *= times
            _sums(rows, batches, place, doc, score, buckets)
            on = np.flatnonzero(real & ~seen & (back == 0))
            bucket = _bucket(word[on], buckets)
            order = np.lexsort((word[on], bucket))
            on, bucket = on[order], bucket[order]
            cuts = np.searchsorted(bucket, np.arange(buckets + 1))
            for k in np.flatnonzero(np.diff(cuts)):
                part = on[cuts[k]:cuts[k + 1]]
                rows.append((int(k), BACKED, 0, blob(batches), blob(place[part].astype(np.uint32)), blob(entry[part])))
        return pa.concat_tables([passed.cast(ROW), pa.table(_rows(rows), schema=ROW)])
    return run


def _back_off(buckets: int):
    def run(table: pa.Table) -> pa.Table:
        trim()
        kind = table.column("kind").to_numpy()
        passed = table.filter(pa.array((kind == IDS) | (kind == SUMS)))
        counts, table = table.filter(pa.array(kind == COUNTS)), table.filter(pa.array(kind == BACKED))
        rows: list[tuple] = []
        if len(table):
            words = np.concatenate(_column(counts, "keys", U64))
            order = np.argsort(words)
            words, number = words[order], np.concatenate(_column(counts, "numbers", np.int64))[order]
            listed = _column(table, "keys", np.int64)
            batches, at = np.unique(np.concatenate(listed), return_inverse=True)
            shift = np.concatenate([[0], np.cumsum([len(x) for x in listed])])
            place = np.concatenate([at[p.astype(np.int64) + s] for p, s in zip(_column(table, "numbers", np.uint32), shift)])
            entry = np.concatenate(_column(table, "entries", U64))
            score = np.log(number[np.searchsorted(words, entry >> U64(20))]) * (entry & U64(255)).astype(np.int64)
            _sums(rows, batches, place, (entry >> U64(8) & U64(0xFFF)).astype(np.int64), score, buckets)
        return pa.concat_tables([passed.cast(ROW), pa.table(_rows(rows), schema=ROW)])
    return run


def _documents(table: pa.Table) -> pa.Table:
    kind = table.column("kind").to_numpy()
    ids = table.filter(pa.array(kind == IDS)).to_pylist()[0]
    n = np.frombuffer(ids["numbers"], dtype=np.int64)
    total = np.zeros(1 << 12)
    for sums in _column(table.filter(pa.array(kind == SUMS)), "entries", np.float64):
        total[: len(sums)] += sums
    total = total[: len(n)]
    return pa.table({
        "doc_id": pa.array(np.frombuffer(ids["keys"], dtype=np.int64), mask=np.frombuffer(ids["entries"], dtype=np.int8) > 0),
        "n_words": pa.array(n), "log_score": pa.array(total),
        "log_score_per_word": pa.array(total / np.maximum(n, 1), mask=n == 0)})


def stupid_backoff(docs: DataFrame, least: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, log_score, log_score_per_word) for every row, in natural logarithms.

    Null and empty texts have no word, score 0 and null per word.  N-grams in fewer than
    ``least`` places of the corpus back off.  Ids are only carried: null and repeated ones stay.
    """
    spark = docs.sparkSession
    buckets = partitions(spark)
    small_batches(spark)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    texts = docs.select("text")

    def counted(only: np.ndarray | None) -> DataFrame:
        return texts.mapInArrow(_frequent(only), "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))

    # lower bounds: a word that is frequent at all is so in some part; at most HOT words pass
    bounds = counted(None)
    total = bounds.where("word = -1").select(F.col("n").alias("total"))
    hot = bounds.where("word >= 0").join(F.broadcast(total)).where(F.col("n") * HOT >= F.col("total"))
    hot = np.array([r.word for r in hot.select("word").collect()], dtype=U64)
    exact = {r.word: r.n for r in counted(hot).collect()}
    words = exact.pop(-1, 0)
    exact[int(START)] = docs.where(F.col("text").rlike(r"[^\x20\x09-\x0D]")).count()
    marked = np.append(hot, START)
    rows = docs.mapInArrow(_ngrams(buckets, marked), ROWS)
    scored = rows.groupBy("bucket").applyInArrow(_score(buckets, exact, words, least), ROWS)
    backed = scored.groupBy("bucket").applyInArrow(_back_off(buckets), ROWS)
    return backed.groupBy("batch").applyInArrow(
        _documents, "doc_id long, n_words long, log_score double, log_score_per_word double")
