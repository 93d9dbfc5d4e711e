"""Exact removal of repeated byte strings: prefix-free parsing with local triggers.

Every text is parsed into phrases by a rolling hash: a position is a trigger when its hash
of ``GRAM`` bytes is the smallest of some window of ``length`` bytes, so every window holds
a trigger and equal windows hold it at the same place.  All windows with one trigger form a
run; the run's bytes are a phrase with its borders.  Equality classes of windows, which is all
that removal needs of the corpus order of suffixes, come from two tables:

* dictionary: triggers are grouped by their gram and phrases by their bytes.  The windows of
  the first occurrence of a gram have no earlier one; a phrase that occurred before is
  repeated as a whole.
* parse: where neither holds (borders of repeated passages, edits), windows are
  ordered among those of the same gram by hash of their whole ``length`` bytes.

A full lexicographic suffix array of the dictionary would shuffle several bytes per byte of
unique text; classes of equal suffix prefixes need one phrase entry per 35 bytes.  Positions
are ordered by (id, start); grams and phrases are compared by 48-bit hashes, phrases only
within their gram, windows by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from watthour.llm.staging import partitions, small_batches, stage, widened
from watthour.llm.textops import U64, blob, lean, lean_group, mix, prefix_hash, range_hash, remembered, slices, trim

GRAM = 32
PIECE = 1 << 17  # windows of one text that are parsed together
BUFFER = 1 << 18  # bytes hashed together; at most 1 << 20, as places take 20 bits
PART = 2 << 20  # bytes of text worked on together
PER_GRAM = 16  # entries of one gram that a batch ships; the rest are compared as windows
NULL_ID = -(2**63)


def _bytes(column: pa.Array) -> list[bytes]:
    return [b"" if t is None else t.encode() for t in column.to_pylist()]


def _buffers(texts: list[bytes], length: int):
    """(bytes, text of each piece, its place in the text, its bounds in the bytes)."""
    parts, owner, base, size = [], [], [], 0
    for i, raw in enumerate(texts):
        for at in range(0, len(raw) - length + 1, PIECE):
            piece = raw[at:at + PIECE + length - 1]
            if size + len(piece) > BUFFER:
                yield _buffer(parts, owner, base)
                parts, owner, base, size = [], [], [], 0
            parts.append(piece)
            owner.append(i)
            base.append(at)
            size += len(piece)
    if parts:
        yield _buffer(parts, owner, base)


def _buffer(parts, owner, base):
    bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    return np.frombuffer(b"".join(parts), dtype=np.uint8), np.array(owner), np.array(base), bounds


def _runs(data: np.ndarray, bounds: np.ndarray, length: int):
    """Runs of windows with one trigger: (trigger, first window, last window, gram hash, phrase hash)."""
    c = prefix_hash(data)
    at = np.arange(len(data) - GRAM + 1)
    gram = range_hash(c, at, at + GRAM)
    value = (gram >> U64(20) << U64(20)) | at.astype(U64)
    k = length - GRAM + 1
    padded = np.full(-(-len(value) // k) * k, ~U64(0), dtype=U64)
    padded[: len(value)] = value
    blocks = padded.reshape(-1, k)
    up = np.minimum.accumulate(blocks, axis=1).ravel()
    down = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    valid = np.zeros(len(data) + 1, dtype=np.int8)
    np.add.at(valid, bounds[:-1], 1)
    np.add.at(valid, np.maximum(bounds[1:] - length + 1, bounds[:-1]), -1)
    p = np.flatnonzero(np.cumsum(valid[:-1]))
    trigger = (np.minimum(down[p], up[p + k - 1]) & U64(BUFFER - 1)).astype(np.int64)
    new = np.concatenate([[True], (p[1:] != p[:-1] + 1) | (trigger[1:] != trigger[:-1])])
    start = np.flatnonzero(new)
    first, last, trigger = p[start], p[np.append(start[1:], len(p)) - 1], trigger[start]
    place = ((trigger - first) << 20 | (last - first)).astype(U64)
    # triggers have small hashes; scrambled, they fall into all buckets alike
    return trigger, first, last, mix(gram[trigger]), mix(range_hash(c, first, last + length) + mix(place))


ENTRY = np.dtype([("gram", "<u8"), ("phrase", "<u8"), ("at", "<u4")])  # gram 48 | text 12 | rest 1; phrase 48 | 8 | 8
FLAGS = "doc_id long, version int, first long, span int, kind int"
SETTLED, OPEN, WITNESS = 0, 1, 2  # repeated; to be compared as windows; only compared with


def _parse(length: int, buckets: int):
    """Phrase entries by bucket of their gram.  A phrase seen before in the batch is settled
    here; so a passage that many texts hold ships once a batch."""
    def run(batches):
        remembered("suffixes")
        for batch in batches:
            for part in slices(batch, "text", 4096, PART):
                texts = _bytes(part.column("text"))
                rows = []
                for data, owner, base, bounds in _buffers(texts, length):
                    trigger, first, last, gram, phrase = _runs(data, bounds, length)
                    piece = np.searchsorted(bounds, first, side="right") - 1
                    rows.append((gram >> U64(16), phrase >> U64(16), owner[piece],
                                 trigger - bounds[piece] + base[piece], trigger - first, last - first))
                if not rows:
                    continue
                gram, phrase, text, at, lead, span = (np.concatenate(x) for x in zip(*rows))
                ids = part.column("doc_id").to_numpy(zero_copy_only=False)
                version = part.column("version").to_numpy(zero_copy_only=False)
                rank = _rank(ids, version)
                order = np.lexsort((at, rank[text], phrase, gram))
                same = (gram[order][1:] == gram[order][:-1]) & (phrase[order][1:] == phrase[order][:-1])
                # a place listed twice is one of rows equal in id and text: no earlier place, and shipped once
                twin = same & (rank[text][order][1:] == rank[text][order][:-1]) & (at[order][1:] == at[order][:-1])
                again = np.zeros(len(gram), dtype=bool)
                again[order[1:][same & ~twin]] = True
                kept = ~again
                kept[order[1:][twin]] = False
                kept = np.flatnonzero(kept)
                kept = kept[np.lexsort((at[kept], rank[text[kept]], gram[kept]))]
                start = np.flatnonzero(np.concatenate([[True], gram[kept][1:] != gram[kept][:-1]]))
                nth = np.arange(len(kept)) - np.repeat(start, np.diff(np.append(start, len(kept))))
                rest = kept[nth >= PER_GRAM]
                more = np.repeat(np.maximum.reduceat(nth, start) >= PER_GRAM, np.diff(np.append(start, len(kept))))
                more, kept = more[nth < PER_GRAM], kept[nth < PER_GRAM]
                done = np.concatenate([np.flatnonzero(again), rest])
                flags = pa.table([
                    pa.array(ids[text[done]]), pa.array(version[text[done]]), pa.array(at[done] - lead[done]),
                    pa.array(span[done].astype(np.int32)),
                    pa.array(np.repeat(np.array([SETTLED, OPEN], np.int32), [int(again.sum()), len(rest)]))],
                    names=["doc_id", "version", "first", "span", "kind"])
                entry = np.empty(len(kept), dtype=ENTRY)
                bucket = (gram[kept] * U64(buckets) >> U64(48)).astype(np.int64)
                cuts = np.searchsorted(bucket, np.arange(buckets + 1))
                entry["phrase"] = phrase[kept] << U64(16) | (lead[kept] << 8 | span[kept]).astype(U64)
                entry["at"] = at[kept]
                out = [(int(mix(ids[:1].view(U64))[0] % U64(buckets)), b"", b"", b"", _ipc(flags))] if len(done) else []
                for k in np.flatnonzero(np.diff(cuts)):
                    own = slice(cuts[k], cuts[k + 1])
                    used, place = np.unique(text[kept[own]], return_inverse=True)
                    part_entry = entry[own].copy()
                    part_entry["gram"] = gram[kept[own]] << U64(16) | place.astype(U64) << U64(4) | more[own].astype(U64)
                    out.append((int(k), blob(part_entry), blob(ids[used]), blob(version[used]), b""))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(zip(*out), [pa.int32()] + [pa.binary()] * 4)],
                    names=["bucket", "entries", "ids", "versions", "flags"])
    return lean(run)


def _ipc(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _view(cell: pa.BinaryScalar) -> pa.Buffer:
    """The bytes of a cell, not copied."""
    return cell.as_buffer()


def _rank(ids: np.ndarray, version: np.ndarray) -> np.ndarray:
    order = np.lexsort((version, ids))
    new = np.concatenate([[0], (ids[order][1:] != ids[order][:-1]) | (version[order][1:] != version[order][:-1])])
    rank = np.empty(len(ids), dtype=np.int64)
    rank[order] = np.cumsum(new)
    return rank


def _settle(table: pa.Table) -> pa.Table:
    """Of one bucket of grams: which runs are repeated, and which need comparing as windows."""
    remembered("suffixes")
    out = [pa.ipc.open_stream(f).read_all() for f in map(_view, table.column("flags")) if f.size]
    trim()
    schema = pa.schema([("doc_id", pa.int64()), ("version", pa.int32()), ("first", pa.int64()), ("span", pa.int32()), ("kind", pa.int32())])
    entries, ids, versions, text = [], [], [], []
    for e, i, v in zip(*(map(_view, table.column(c)) for c in ("entries", "ids", "versions"))):
        if e.size:
            e = np.frombuffer(e, dtype=ENTRY)
            text.append(((e["gram"] >> U64(4)) & U64(0xFFF)).astype(np.int64) + sum(map(len, ids)))
            entries.append(e)
            ids.append(np.frombuffer(i, dtype=np.int64))
            versions.append(np.frombuffer(v, dtype=np.int32))
    if entries:
        e, text, ids, versions = (np.concatenate(x) for x in (entries, text, ids, versions))
        gram, more = e["gram"] >> U64(16), (e["gram"] & U64(1)).astype(bool)
        order = np.argsort(gram, kind="stable")
        near = np.zeros(len(order) + 1, dtype=bool)
        near[1:-1] = gram[order][1:] == gram[order][:-1]
        order = order[near[1:] | near[:-1] | more[order]]
        e, text, gram, more = (x[order] for x in (e, text, gram, more))  # most grams occur once
        phrase, at, rank = e["phrase"] >> U64(16), e["at"].astype(np.int64), _rank(ids, versions)
        order = np.lexsort((at, rank[text], gram))
        g = gram[order]
        group = np.cumsum(np.concatenate([[True], g[1:] != g[:-1]])) - 1 if len(g) else np.zeros(0, np.int64)
        start = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]])) if len(g) else group
        by = np.lexsort((np.arange(len(order)), phrase[order], group))
        again, twin = np.zeros(len(order), dtype=bool), np.zeros(len(order), dtype=bool)
        again[by[1:]] = (group[by][1:] == group[by][:-1]) & (phrase[order][by][1:] == phrase[order][by][:-1])
        place = order[by]  # as in _parse, twins count once
        twin[by[1:]] = again[by[1:]] & (rank[text[place]][1:] == rank[text[place]][:-1]) & (at[place][1:] == at[place][:-1])
        kind = np.where(again, SETTLED, OPEN)
        kind[start] = WITNESS
        need = np.zeros(len(start), dtype=bool)
        np.logical_or.at(need, group, (kind == OPEN) | more[order])
        keep = ((kind != WITNESS) | need[group]) & ~twin
        order, kind = order[keep], kind[keep].astype(np.int32)
        lead, span = ((e["phrase"][order] >> U64(k) & U64(255)).astype(np.int64) for k in (8, 0))
        out.append(pa.table([
            pa.array(ids[text[order]]), pa.array(versions[text[order]]), pa.array(at[order] - lead),
            pa.array(span.astype(np.int32)), pa.array(kind)], schema=schema))
    return pa.concat_tables(out) if out else schema.empty_table()


def _windows(length: int, buckets: int):
    """Hashes of the windows of open runs and their witnesses, by bucket."""
    def run(batches):
        remembered("suffixes")
        for batch in batches:
            for part in slices(batch, "text", 4096, PART):
                ids = part.column("doc_id").to_numpy(zero_copy_only=False)
                version = part.column("version").to_numpy(zero_copy_only=False)
                rows = []
                for i, (raw, runs) in enumerate(zip(_bytes(part.column("text")), part.column("runs").to_pylist())):
                    runs = np.array(runs, dtype=np.int64)
                    runs.sort()
                    data = np.frombuffer(raw, dtype=np.uint8)
                    for base in range(0, len(raw) - length + 1, PIECE):
                        a, b = np.searchsorted(runs >> 10, (base, base + PIECE))
                        a = max(a - 1, 0)  # a run may reach over from the piece before
                        first, span, kind = runs[a:b] >> 10, runs[a:b] >> 2 & 255, runs[a:b] & 3
                        p = np.repeat(first - np.concatenate([[0], np.cumsum(span + 1)[:-1]]), span + 1) + np.arange((span + 1).sum())
                        kind = np.repeat(kind, span + 1)
                        inside = (p >= base) & (p < base + PIECE)
                        p, kind = p[inside] - base, kind[inside]
                        if len(p):
                            c = prefix_hash(data[base:base + PIECE + length - 1])
                            rows.append((range_hash(c, p, p + length), np.full(len(p), i), p + base, kind))
                if not rows:
                    continue
                h, text, p, kind = (np.concatenate(x) for x in zip(*rows))
                order = np.argsort(h, kind="stable")
                h, text, p, kind = h[order], text[order], p[order], kind[order]
                bucket = ((h >> U64(32)) * U64(buckets) >> U64(32)).astype(np.int64)
                cuts = np.searchsorted(bucket, np.arange(buckets + 1))
                out = []
                for k in np.flatnonzero(np.diff(cuts)):
                    own = slice(cuts[k], cuts[k + 1])
                    used, place = np.unique(text[own], return_inverse=True)
                    where = p[own].astype(U64) << U64(14) | place.astype(U64) << U64(2) | kind[own].astype(U64)
                    out.append((int(k), blob(h[own]), blob(where), blob(ids[used]), blob(version[used])))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(zip(*out), [pa.int32()] + [pa.binary()] * 4)],
                    names=["bucket", "hashes", "places", "ids", "versions"])
    return lean(run)


def _repeated(table: pa.Table) -> pa.Table:
    """Open windows with an earlier equal one, as runs."""
    remembered("suffixes")
    trim()
    h, w, ids, versions = (np.frombuffer(b"".join(table.column(c).to_pylist()), dtype=t) for c, t in (
        ("hashes", U64), ("places", U64), ("ids", np.int64), ("versions", np.int32)))
    many, texts = (pc.binary_length(table.column(c)).to_numpy() // 8 for c in ("hashes", "ids"))
    base = np.repeat(np.cumsum(texts) - texts, many)  # of each window's cell
    order = np.argsort(h)
    near = np.zeros(len(order) + 1, dtype=bool)
    near[1:-1] = h[order[1:]] == h[order[:-1]]
    order = order[near[1:] | near[:-1]]  # windows that occur once are not repeated
    h, w, base = h[order], w[order], base[order]
    text = base + (w >> U64(2) & U64(0xFFF)).astype(np.int64)
    p, kind, rank = (w >> U64(14)).astype(np.int64), (w & U64(3)).astype(np.int64), _rank(ids, versions)
    order = np.lexsort((p, rank[text], h))
    again = np.zeros(len(h), dtype=bool)
    # a place may be listed twice: it is repeated only if a smaller place is equal
    start = np.concatenate([[True], h[order][1:] != h[order][:-1]])[:len(order)]
    head = order[np.maximum.accumulate(np.where(start, np.arange(len(order)), 0))]
    again[order] = (p[order] != p[head]) | (rank[text[order]] != rank[text[head]])
    hit = np.flatnonzero(again & (kind == OPEN))
    hit = hit[np.lexsort((p[hit], rank[text[hit]]))]
    cut = np.concatenate([[True], (p[hit][1:] != p[hit][:-1] + 1) | (rank[text[hit]][1:] != rank[text[hit]][:-1])]) if len(hit) else np.zeros(0, bool)
    start = np.flatnonzero(cut)
    last = p[hit][np.append(start[1:], len(hit)) - 1] if len(hit) else p[:0]
    head = hit[start]
    return pa.table([pa.array(ids[text[head]]), pa.array(versions[text[head]]), pa.array(p[head]), pa.array(last - p[head])],
                    names=["doc_id", "version", "first", "span"])


KEPT = {"doc_id": T.LongType(), "n_bytes": T.LongType(), "n_removed": T.LongType(), "n_spans": T.LongType(),
        "kept_sha256": T.StringType(), "kept": T.BinaryType()}


def _remove(length: int, as_text: bool):
    def run(batches):
        remembered("suffixes")
        for batch in batches:
            for part in slices(batch, "text", 4096, PART):
                rows = []
                for raw, runs in zip(_bytes(part.column("text")), part.column("runs").to_pylist()):
                    removed = spans = 0
                    if runs:
                        edge = np.zeros(len(raw) + 1, dtype=np.int32)
                        runs = np.array(runs, dtype=np.int64)
                        np.add.at(edge, runs >> 20, 1)
                        np.add.at(edge, (runs >> 20) + (runs & 0xFFFFF) + length, -1)
                        gone = np.cumsum(edge[:-1]) > 0
                        removed = int(gone.sum())
                        spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                        kept = np.frombuffer(raw, dtype=np.uint8)[~gone].tobytes()
                    else:
                        kept = raw
                    rows.append((len(raw), removed, spans, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "ignore") if as_text else kept))
                columns = [pa.array(x, t) for x, t in zip(zip(*rows), [pa.int64()] * 3 + [pa.string(), pa.string() if as_text else pa.binary()])]
                yield pa.RecordBatch.from_arrays([part.column("carried"), part.column("doc_id"), *columns], names=["carried", *KEPT])
    return lean(run)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100,
                   carry: Sequence[str] = (), as_text: bool = False) -> DataFrame:
    """Remove every byte covered by a ``length``-byte string that also starts earlier.

    (doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) for every row; earlier means a
    smaller id, or the same text at a smaller start.  Null and empty texts keep nothing and
    remove nothing.  A null id counts as the smallest (as -2**63, which gives null back).  Rows that share an id are ordered by a
    hash of the text; rows equal in both are one document and get the same result.
    Of other columns those in ``carry`` come along, in the struct ``carried``.  With ``as_text``
    ``kept`` is a string, and a character that lost some of its bytes goes.
    """
    if not GRAM <= length < GRAM + 256:
        raise ValueError("length must be 32 to 287")
    buckets = partitions(docs.sparkSession)
    small_batches(docs.sparkSession)
    docs = docs.select(
        (F.struct(*carry) if carry else F.lit(None).cast("int")).alias("carried"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("doc_id"),
        F.hash(F.coalesce(text_col, F.lit(""))).alias("version"), F.coalesce(text_col, F.lit("")).alias("text"))
    key = ["doc_id", "version"]
    # buckets are dealt out by hand, so that a task never holds several that were put together
    parsed = docs.select(*key, "text").mapInArrow(
        _parse(length, buckets), "bucket int, entries binary, ids binary, versions binary, flags binary")
    flags = stage(parsed.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(lean_group(_settle), FLAGS), "phrases")

    def listed(df: DataFrame, packed: str) -> DataFrame:
        return df.select(*key, F.expr(packed).alias("run")).groupBy(*key).agg(F.collect_list("run").alias("runs")).hint("shuffle_hash")

    wanted = listed(flags.where(F.col("kind") > SETTLED), "first << 10 | cast(span as long) << 2 | cast(kind as long)")
    compared = docs.join(wanted, key).select("carried", *key, "text", "runs").mapInArrow(
        _windows(length, buckets), "bucket int, hashes binary, places binary, ids binary, versions binary")
    late = compared.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(lean_group(_repeated), "doc_id long, version int, first long, span long")
    runs = flags.where(F.col("kind") == SETTLED).select(*key, "first", F.col("span").cast("long")).unionByName(late)
    gone = listed(runs, "first << 20 | span")
    # both joins take the texts in the same columns and partitions, so that one exchange serves both
    schema = widened(docs.select("carried"), **KEPT | ({"kept": T.StringType()} if as_text else {}))
    done = docs.join(gone, key, "left").select("carried", "doc_id", "text", "runs").mapInArrow(_remove(length, as_text), schema)
    done = done.withColumn("doc_id", F.nullif("doc_id", F.lit(NULL_ID)))
    return done if carry else done.drop("carried")
