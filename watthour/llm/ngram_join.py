"""Exact self-join of documents on the Jaccard similarity of their word n-gram sets.

Method: the universe of shingle hashes is cut into segments, as many as the size band needs.
Two sets with |X xor Y| <= H agree in at least m - H of m segments, or in m - H // 2 of them
up to one element.  Each set is indexed by the additive hash of every segment's subset;
bands of small sets, which would need nearly empty segments, get half as many segments and
the one-deletion neighbourhood of each instead (``Band.deletions``, the cheaper allocation
there).  A segment costs what its value is common: empty segments and values found in more
than ``common`` sets are not paired, and the count that a pair must reach is lowered by as
many.  Where too few segments are left on both sides, sets take further partitions of the
universe (empty segments, known at once) or are compared in blocks within groups connected
by the common values.  What is left of candidates is verified on the whole sets.

Sets are identified by 64-bit hashes of folded words; two different sets of one corpus of
n documents take the same identity with probability n**2 / 2**65.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watthour.llm.graph import components, spanning
from watthour.llm.staging import partitions, small_batches, stage
from watthour.llm.textops import U64, blob, joined, lean, lean_group, mix, remembered, shingles, slices

LEVELS = 4  # partitions of the universe tried before empty segments count as values
COMMON = 64  # a value in more sets than this is common: it is counted, not paired
BLOCK = 256  # sets of a candidate group compared in one block
MATCHED = 1 << 18  # index entries of a bucket matched at once
VERIFIED = 3 << 20  # bytes of text whose groups are verified at once
SMALL_H = 8  # bands with a smaller distance take one-deletion neighbourhoods


@dataclass(frozen=True)
class Band:
    """Sets of lo..hi-1 shingles ("lower") and their partners of up to 5/4 as many."""

    index: int
    lo: int
    hi: int

    @property
    def distance(self) -> int:
        top = self.hi - 1
        return (top + top * 5 // 4) // 9

    @property
    def deletions(self) -> bool:
        return self.distance < SMALL_H

    @property
    def segments(self) -> int:
        h = self.distance
        return h // 2 + 1 if self.deletions else h + 1 + (h + 7) // 8

    def spare(self, size: np.ndarray | int, other: np.ndarray | int) -> np.ndarray | int:
        """Segments in which sets of these sizes agree at least, if similar."""
        h = (size + other) // 9
        return self.segments - (h // 2 if self.deletions else h)


@lru_cache(maxsize=1)
def bands() -> tuple[list[Band], np.ndarray]:
    """Bands up to sizes of 2**40; sets of three shingles or fewer are similar only if equal."""
    edges = [4]
    while edges[-1] < 1 << 40:
        edges.append(edges[-1] * 5 // 4 + 1)
    return [Band(i, a, b) for i, (a, b) in enumerate(zip(edges, edges[1:]))], np.array(edges)


def roles(size: int) -> list[tuple[int, Band]]:
    """(0, band as a lower set) and, where smaller partners exist, (1, the band below)."""
    if size < 4:
        return []
    all_bands, edges = bands()
    at = int(np.searchsorted(edges, size, side="right")) - 1
    out = [(0, all_bands[at])]
    if at and size <= (edges[at] - 1) * 5 // 4:
        out.append((1, all_bands[at - 1]))
    return out


def partners(band: Band, role: int, size: int) -> int:
    """The largest set that the band compares with one of this size and role."""
    return size * 5 // 4 if role == 0 else band.hi - 1


@lru_cache(maxsize=4096)
def _salt(*parts: int) -> np.uint64:
    x = np.array([0x51ED270B], dtype=U64)
    for p in parts:
        x = mix(x + U64(p))
    return x[0]


@lru_cache(maxsize=512)
def _layout(band: Band, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the segments start in the universe, and what tells their values apart."""
    m = band.segments
    starts = (np.arange(m, dtype=np.float64) / m * 2.0**64).astype(U64)
    return starts, mix(np.arange(m, dtype=U64) + _salt(3, band.index, level))


def signatures(own: np.ndarray, prefix: np.ndarray, role: int, band: Band) -> tuple[list[np.ndarray], int]:
    """48-bit keys shifted over role, kind and level bits; and the segments unusable at level
    0: how many, or which (as bits) in bands with deletions.  ``prefix`` has running sums of ``own``."""
    m, keys, first = band.segments, [], 0
    limit = band.spare(len(own), partners(band, role, len(own)))
    for level in range(LEVELS):
        placed = own
        if level:
            placed = np.sort(mix(own + _salt(1, level)))
            prefix = np.concatenate([np.zeros(1, U64), np.cumsum(placed)])
        starts, salts = _layout(band, level)
        cuts = np.append(np.searchsorted(placed, starts), len(placed))
        sums = prefix[cuts[1:]] - prefix[cuts[:-1]]
        sizes = np.diff(cuts)
        last = level == LEVELS - 1
        used = np.flatnonzero((sizes > 0) | last)
        low = U64(role << 3 | level)
        if band.deletions:
            seg = U64(3)
            own_keys = [(mix(sums + salts)[used] >> U64(19) << seg | used.astype(U64)) << U64(16) | low]
            at = np.repeat(np.arange(m), sizes)
            gone = at[(sizes[at] > 1) | last]
            less = (sums[at] - placed)[(sizes[at] > 1) | last]
            own_keys.append((mix(less + salts[gone]) >> U64(19) << seg | gone.astype(U64)) << U64(16) | low | U64(4))
            void = 0 if last else int((1 << np.flatnonzero(sizes <= 1)).sum())
            count = void.bit_count()
        else:
            own_keys = [mix(sums + salts)[used] >> U64(16) << U64(16) | low]
            void = count = m - len(used)
        keys += own_keys
        first = first if level else void
        if count < limit or last:
            return keys, first
    raise AssertionError


def _node(own: np.ndarray) -> int:
    total = own.sum(dtype=U64, keepdims=True) ^ _salt(4, len(own))
    return int(mix(total)[0].view(np.int64))


def _sets(text_col: str, *carried: str):
    def run(batches):
        remembered("sets")
        for batch in batches:
            for part in slices(batch, text_col):
                hashes, bounds = shingles(*joined(part.column(text_col)))
                nodes = [_node(hashes[a:b]) for a, b in zip(bounds, bounds[1:])]
                yield pa.RecordBatch.from_arrays(
                    [*map(part.column, carried), pa.array(np.diff(bounds), pa.int64()), pa.array(nodes, pa.int64())],
                    names=[*carried, "n_shingles", "node"])
    return lean(run)


def _index(text_col: str, buckets: int):
    """Packed signatures: entry = 48-bit key, place of the set in the blob << 4, role/kind/level."""
    def run(batches):
        remembered("sets")
        for batch in batches:
            for part in slices(batch, text_col):
                hashes, bounds = shingles(*joined(part.column(text_col)))
                entries, owner, nodes, sizes, voids, seen = [], [], [], [], [], set()
                for a, b in zip(bounds, bounds[1:]):
                    own = hashes[a:b]
                    if len(own) < 4 or (node := _node(own)) in seen:
                        continue
                    seen.add(node)
                    void = np.zeros(2, dtype=np.uint8)
                    prefix = np.concatenate([np.zeros(1, U64), np.cumsum(own)])
                    for role, band in roles(len(own)):
                        keys, unusable = signatures(own, prefix, role, band)
                        void[role] = min(unusable, 255)
                        entries += keys
                        owner.append(np.full(sum(map(len, keys)), len(nodes), dtype=U64))
                    nodes.append(node)
                    sizes.append(len(own))
                    voids.append(void)
                if not entries:
                    continue
                keys = np.concatenate(entries) | np.concatenate(owner) << U64(4)
                keys.sort()
                bucket = ((keys >> U64(40)) * U64(buckets) >> U64(24)).astype(np.int64)
                cuts = np.searchsorted(bucket, np.arange(buckets + 1))
                nodes, sizes, voids = np.array(nodes), np.array(sizes, dtype=np.uint32), np.array(voids)
                out = []
                for k in np.flatnonzero(np.diff(cuts)):
                    own = keys[cuts[k]:cuts[k + 1]]
                    used, place = np.unique((own >> U64(4)) & U64(0xFFF), return_inverse=True)
                    own = own & ~U64(0xFFF0) | place.astype(U64) << U64(4)
                    used = used.astype(np.int64)
                    out.append((int(k), blob(own), blob(nodes[used]), blob(sizes[used]), blob(voids[used])))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(zip(*out), [pa.int32()] + [pa.binary()] * 4)],
                    names=["bucket", "entries", "nodes", "sizes", "voids"])
    return lean(run)


FOUND = pa.schema([(n, pa.int64()) for n in ("a", "b", "band", "level", "need_a", "need_b", "found", "mask")])


def _match(table: pa.Table) -> pa.Table:
    """Of one bucket: pairs with the number of values they share (need_*: how many they must),
    and for sets with common values (need_b null) the group's smallest set as ``b``.
    Ranges of values are matched one after another, so that few entries are unpacked at once."""
    entries, nodes, sizes, voids = (np.frombuffer(b"".join(table.column(c).to_pylist()), dtype=t) for c, t in (
        ("entries", U64), ("nodes", np.int64), ("sizes", np.uint32), ("voids", np.uint8)))
    many, sets = (pc.binary_length(table.column(c)).to_numpy() // 8 for c in ("entries", "nodes"))
    base = np.repeat(np.cumsum(sets) - sets, many)  # of each entry's blob
    order = np.argsort(entries)
    value = entries[order] >> U64(16)
    same = np.zeros(len(value) + 1, dtype=bool)
    same[1:-1] = value[1:] == value[:-1]
    shared = same[1:] | same[:-1]  # values of one set alone say nothing
    order, value = order[shared], value[shared]
    cuts = np.unique(np.append(np.searchsorted(value, value[::MATCHED]), len(value)))
    del value, same, shared
    parts = []
    for first, end in zip(cuts, cuts[1:]):
        e = entries[order[first:end]]
        at = base[order[first:end]] + (e >> U64(4) & U64(0xFFF)).astype(np.int64)
        parts.append(_matched(e, nodes[at], sizes[at].astype(np.int64), voids.reshape(-1, 2)[at]))
    del entries, nodes, sizes, voids, base, order
    rows = []
    for kind, names in enumerate(zip(*parts)):
        keys, found, mask = _merged(*map(np.concatenate, zip(*names)))
        columns = [pa.array(c) for c in keys.T]
        if kind:  # without need_b
            columns = [*columns, pa.nulls(len(keys), pa.int64()), pa.array(found), pa.array(mask)]
        else:
            columns = [*columns, pa.array(found), pa.nulls(len(keys), pa.int64())]
        rows.append(pa.table(columns, schema=FOUND))
    return pa.concat_tables(rows) if rows else FOUND.empty_table()


Counted = tuple[np.ndarray, np.ndarray, np.ndarray]  # rows, how often each was found, united masks


def _matched(entries: np.ndarray, node: np.ndarray, size: np.ndarray, voids: np.ndarray) -> tuple[Counted, Counted]:
    """Of one range of values: pairs (a, b, band, level, need_a, need_b), and stars (a, b, band, level, need_a)."""
    role, level = (entries >> U64(3) & U64(1)).astype(np.int64), (entries & U64(3)).astype(np.int64)
    # past level 0 what is unusable isn't kept: all may be, so that one shared value is enough
    void = np.where(level == 0, voids[np.arange(len(voids)), role].astype(np.int64), 1 << 40)
    key = entries & ~U64(0xFFF0)
    order = np.lexsort((key, node, key >> U64(16)))
    key, node, size, void = key[order], node[order], size[order], void[order]
    fresh = np.concatenate([[True], (key[1:] != key[:-1]) | (node[1:] != node[:-1])])
    key, node, size, void = key[fresh], node[fresh], size[fresh], void[fresh]
    value = key >> U64(16)
    role, deleted, level = ((key >> U64(k) & U64(w)).astype(np.int64) for k, w in ((3, 1), (2, 1), (0, 3)))
    edges = bands()[1]
    band = np.searchsorted(edges, size, side="right") - 1 - role
    start = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]]))
    group = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(value))))
    members = np.diff(np.append(start, len(value)))[group]
    all_bands = bands()[0]
    segments = np.array([b.segments for b in all_bands])
    short = np.array([b.deletions for b in all_bands])
    out = []
    few = members <= COMMON
    for step in range(1, int(members[few].max(initial=1))):
        i = np.flatnonzero(few[:-step] & (group[step:] == group[:-step]))
        j = i + step
        ok = (node[i] != node[j]) & (role[i] + role[j] < 2) & (deleted[i] + deleted[j] < 2)
        ok &= 5 * np.minimum(size[i], size[j]) >= 4 * np.maximum(size[i], size[j])
        i, j = i[ok], j[ok]
        swap = node[i] > node[j]
        i, j = np.where(swap, j, i), np.where(swap, i, j)
        h = (size[i] + size[j]) // 9
        spare = segments[band[i]] - np.where(short[band[i]], h // 2, h)
        lost = [np.where(short[band[x]] & (level[x] == 0), np.bitwise_count(void[x]), void[x]) for x in (i, j)]
        out.append(np.stack([node[i], node[j], band[i], level[i], spare - lost[0], spare - lost[1]], axis=1))
    pairs = np.concatenate(out) if out else np.zeros((0, 6), np.int64)
    del out
    pairs = _merged(pairs, np.ones(len(pairs), np.int64), np.zeros(len(pairs), np.int64))
    i = np.flatnonzero(~few)
    lower = role[i] == 0
    partner = np.where(lower, size[i] * 5 // 4, edges[band[i] + 1] - 1)
    h = (size[i] + partner) // 9
    need = segments[band[i]] - np.where(short[band[i]], h // 2, h)
    leader = node[start[group[i]]]  # sorted by node within a value
    seg = np.where(short[band[i]], 1 << (value[i] & U64(7)).astype(np.int64), 0)
    need -= np.where(short[band[i]], 0, void[i])
    need -= np.where(short[band[i]] & (level[i] > 0), 1 << 40, 0)
    known = np.where(short[band[i]] & (level[i] == 0), void[i], 0)
    star = np.stack([node[i], leader, band[i], level[i], need], axis=1)
    return pairs, _merged(star, np.ones(len(i), np.int64), seg | known)


def _merged(rows: np.ndarray, found: np.ndarray, mask: np.ndarray) -> Counted:
    """Equal rows put together: their counts added, their masks united."""
    order = np.lexsort(rows.T)
    rows = rows[order]
    cut = np.flatnonzero(np.concatenate([[True], (rows[1:] != rows[:-1]).any(axis=1)])) if len(rows) else order
    return rows[cut], np.add.reduceat(found[order], cut), np.bitwise_or.reduceat(mask[order], cut)


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of a block, by products of incidence columns."""
    n = len(sets)
    tokens, at = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    shared = np.bincount(at, minlength=len(tokens)) > 1
    rank = np.cumsum(shared) - 1
    keep = shared[at]
    column, owner = rank[at[keep]], owner[keep]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    out = np.zeros((n, n), dtype=np.float32)
    width = 2048
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, (first, first + width))
        part = np.zeros((n, width), dtype=np.float32)
        part[owner[a:b], column[a:b] - first] = 1
        out += part @ part.T
    return out


EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _verify(table: pa.Table) -> pa.Table:
    """Links within the groups (root, i, j) of one bucket, some whole groups at a time."""
    table = table.combine_chunks()
    node, keys = table.column("node").to_numpy(), np.stack([table.column(c).to_numpy() for c in ("root", "i", "j")], axis=1)
    order = np.lexsort((node, keys[:, 2], keys[:, 1], keys[:, 0]))
    keys = keys[order]
    cut = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1), [True]]))
    lengths = pc.binary_length(table.column("text")).to_numpy()[order]
    before = np.concatenate([[0], np.cumsum(lengths)])[cut]  # bytes before each group
    edges, g = [], 0
    while g < len(cut) - 1:
        end = max(g + 1, int(np.searchsorted(before, before[g] + VERIFIED, side="right")) - 1)
        rows = order[cut[g]:cut[end]]
        edges += _links(node[rows], table.column("text").take(pa.array(rows)), cut[g:end + 1] - cut[g])
        g = end
    edges = np.concatenate(edges) if edges else np.zeros((0, 2), np.int64)
    return pa.table([pa.array(edges[:, 0]), pa.array(edges[:, 1])], schema=EDGES)


def _links(node: np.ndarray, texts: pa.ChunkedArray, cut: np.ndarray) -> list[np.ndarray]:
    """Spanning links (member, smallest) of each group; ``cut`` has where they start, and the end."""
    hashes, bounds = [], [0]
    for batch in pa.table({"text": texts}).to_batches():
        for part in slices(batch, "text"):
            h, b = shingles(*joined(part.column("text")))
            hashes.append(h)
            bounds += list(b[1:] + bounds[-1])
    hashes, edges = np.concatenate(hashes), []
    for start, end in zip(cut, cut[1:]):
        own = {}
        for r in range(start, end):
            s = hashes[bounds[r]:bounds[r + 1]]
            if node[r] not in own and _node(s) == node[r]:  # rows may share an id
                own[node[r]] = s
        if len(own) < 2:
            continue
        names, sets = np.array(list(own)), list(own.values())
        inter, size = _overlaps(sets), np.array([len(s) for s in sets])
        a, b = np.nonzero(np.triu(100 * inter >= 80 * (size[:, None] + size[None, :] - inter), 1))
        if len(a):
            edges.append(np.stack(spanning(names[a], names[b]), axis=1))
    return edges


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keys: bool = False) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row: 5-word shingles, similarity >= 0.8.

    Words are runs of bytes other than space and \\t..\\r, with A-Z folded.  Null and empty
    texts have no shingle and link with nothing; fewer than five words make one shingle.
    ``component_id`` is the smallest id reachable by links.  Rows that repeat an id are rows
    of their own; a null id stays null and names no component (a component of null ids only
    is null).  An empty table gives an empty one; other columns are not looked at.
    With ``keys`` two columns more: ``version``, a hash of the text, which tells rows of an id
    apart, and ``component``, equal for the rows of one component whatever their ids (null
    where there are no shingles).
    """
    buckets = partitions(docs.sparkSession)
    small_batches(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("version"), F.col(text_col).alias("text"))
    sets = stage(docs.mapInArrow(_sets("text", "doc_id", "version"), "doc_id long, version long, n_shingles long, node long"), "sets")
    index = docs.select("text").mapInArrow(
        _index("text", buckets), "bucket int, entries binary, nodes binary, sizes binary, voids binary")
    found = stage(index.groupBy("bucket").applyInArrow(
        lean_group(_match), ", ".join(f"{f.name} long" for f in FOUND)), "found")
    edges = _candidates(found)
    groups = components(edges)
    # every set of a candidate group meets every other in one block pair
    blocks = groups.groupBy("root").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    # by id and text: an id alone, null above all, may stand for many texts
    first = sets.where("n_shingles >= 4").groupBy("node").agg(F.min(F.struct("doc_id", "version")).alias("row"))
    asked = stage(groups.join(blocks, "root").join(first, "node").select(
        "row.doc_id", "row.version", "node", "root", "blocks", F.pmod(F.xxhash64("node"), "blocks").alias("own")), "asked")
    asked = asked.hint("shuffle_hash")  # it grows with the corpus: the same join at every size
    texts = docs.join(asked, docs.doc_id.eqNullSafe(asked.doc_id) & (docs.version == asked.version)).select("node", "root", "blocks", "own", "text")
    meet = texts.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(
        "node", "root", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "text")
    # written before they are contracted, as a stage with two Python steps takes two workers a task
    links = stage(meet.groupBy(F.pmod(F.xxhash64("root", "i", "j"), F.lit(buckets)).alias("bucket")).applyInArrow(
        lean_group(_verify), "a long, b long"), "links")
    linked = components(links)
    least = sets.where("n_shingles > 0").groupBy("node").agg(F.min("doc_id").alias("least"))
    labels = least.join(linked, "node", "left").select("node", F.coalesce("root", "node").alias("root"), "least")
    best = labels.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = labels.join(best, "root").select("node", "component_id", F.col("root").alias("component"))
    names = ["doc_id", "n_shingles", "component_id", *(["version", "component"] if keys else [])]
    alone = sets.where("n_shingles = 0").withColumns(
        {"component_id": F.col("doc_id"), "component": F.lit(None).cast("long")}).select(*names)
    return sets.where("n_shingles > 0").join(classes, "node").select(*names).unionByName(alone)


def _candidates(found: DataFrame) -> DataFrame:
    """Pairs that share enough values, and stars over common values between sets that are
    left with too few others."""
    common = found.where("need_b IS NULL")
    key = ["band", "level"]
    lost = common.groupBy(F.col("a").alias("node"), *key).agg(
        F.sum("found").alias("times"), F.expr("bit_or(mask)").alias("mask"))
    lost = lost.select("node", *key, F.when(F.col("mask") > 0, F.expr("bit_count(mask)")).otherwise(F.col("times")).cast("long").alias("lost"))
    pairs = found.where("need_b IS NOT NULL").groupBy("a", "b", *key).agg(
        F.min("need_a").alias("need_a"), F.min("need_b").alias("need_b"), F.sum("found").alias("found"))
    for side in ("a", "b"):
        pairs = pairs.join(lost.select(F.col("node").alias(side), *key, F.col("lost").alias(f"lost_{side}")), [side, *key], "left")
    need = F.greatest(*(F.col(f"need_{s}") - F.coalesce(f"lost_{s}", F.lit(0)) for s in ("a", "b")), F.lit(1))
    near = pairs.where(F.col("found") >= need).select("a", "b")
    stars = common.join(lost.withColumnRenamed("node", "a"), ["a", *key]).where("lost >= need_a").select("a", "b")
    return near.union(stars)
