"""Packing documents into windows of tokens by non-negative least squares on the histogram.

Tokens are made once.  Documents are cut at multiples of the window; what is left over is
binned by length.  All combinations of at most ``DEPTH`` bins that fill a window exactly are
the columns of a least-squares problem whose right side is the histogram; its non-negative
solution, rounded down, says how often each combination is used.  What remains of the
histogram is packed greedily, longest first, again as repeated combinations.  The plan only
depends on the histogram (at most ``BINS`` numbers), so its size doesn't grow with the data;
pieces find their place in it by their rank among the pieces of their bin.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Sequence
from dataclasses import dataclass
from struct import pack as pack_ids

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from watthour.llm.staging import partitions, small_batches, stage, widened
from watthour.llm.textops import lean, remembered, slices

BINS = 256
DEPTH = 3
END = (1).to_bytes(4, "little")
# White space as the pre-tokenizer's pattern knows it.
SPACE = "\t-\r \x85\xa0  -     　"
# A text falls into these parts before it is split further; no token reaches over two of them.
PARTS = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")


# Fixed value: what the tokenizer's file adds to its pieces, found before a text is split.
ADDED = {"<|endoftext|>": 50256}


class Ids(dict):
    """Little-endian ids of parts of texts; two generations of at most ``size`` parts are kept."""

    def __init__(self, path: str, size: int = 120_000):
        import public_tokenizers
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
        self.encode = tiktoken.Encoding(
            "parts", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.size, self.old = size, {}
        self.added = {text: pack_ids("<I", number) for text, number in ADDED.items()}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(ADDED, key=len, reverse=True))) + ")")

    def __missing__(self, part: str) -> bytes:
        ids = self.old.get(part)
        if ids is None:
            found = self.encode(part)
            ids = pack_ids("<%dI" % len(found), *found)
        if len(part) <= 64:
            if len(self) >= self.size:
                self.old = dict(self)
                self.clear()
            self[part] = ids
        return ids

    def text(self, text: str) -> bytes:
        if not any(added in text for added in self.added):
            return b"".join(map(self.__getitem__, PARTS.findall(text)))
        return b"".join(self.added.get(piece) or b"".join(map(self.__getitem__, PARTS.findall(piece))) for piece in self.cut.split(text))


def token_ids(path: str) -> Ids:
    memory = remembered("packing")
    if path not in memory:
        memory[path] = Ids(path)
    return memory[path]


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, bin int"


def _pieces(path: str, window: int, with_ids: bool):
    def run(batches):
        ids = token_ids(path)
        for batch in batches:
            for part in slices(batch, "text"):
                doc, start, length, crc, total, data = [], [], [], [], [], []
                for d, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    tokens = ids.text(text or "") + END
                    n = len(tokens) // 4
                    for at in range(0, n, window):
                        piece = tokens[4 * at:4 * (at + window)]
                        doc.append(d)
                        start.append(at)
                        length.append(len(piece) // 4)
                        crc.append(zlib.crc32(piece))
                        total.append(n)
                        data.append(piece)
                size = -(-window // BINS)
                columns = [pa.array(x, pa.int64()) for x in (doc, start, length, crc, total)]
                columns.append(pa.array([-(-x // size) for x in length], pa.int32()))
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "bin"]
                if with_ids:
                    columns, names = [*columns, pa.array(data, pa.binary())], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(columns, names=names)
    return lean(run)


def nnls(columns: np.ndarray, target: np.ndarray, weight: np.ndarray, rounds: int = 1000) -> np.ndarray:
    """Lawson-Hanson for columns given by row numbers (-1: none): min |W (A x - target)|, x >= 0."""
    n = len(target)

    def dense(at: np.ndarray) -> np.ndarray:
        out = np.zeros((n + 1, len(at)))
        for part in columns[at].T:
            np.add.at(out, (part, np.arange(len(at))), 1)
        return out[:n] * weight[:, None]

    x = np.zeros(len(columns))
    passive = np.zeros(len(columns), dtype=bool)
    goal = target * weight
    tolerance = 1e-9 * max(1.0, float(np.abs(goal).max()))
    for _ in range(rounds):
        at = np.flatnonzero(passive)
        residual = np.append((goal - dense(at) @ x[at]) * weight, 0.0)
        gradient = residual[columns].sum(axis=1)
        gradient[passive] = -np.inf
        best = int(np.argmax(gradient))
        if gradient[best] <= tolerance:
            break
        passive[best] = True
        while True:
            at = np.flatnonzero(passive)
            z = np.linalg.lstsq(dense(at), goal, rcond=None)[0]
            if (z > 1e-12).all():
                x[:] = 0
                x[at] = z
                break
            low = z <= 1e-12
            step = np.min(x[at][low] / np.maximum(x[at][low] - z[low], 1e-300))
            x[at] += step * (z - x[at])
            gone = at[x[at] <= 1e-12]
            if not len(gone):
                gone = at[low][np.argmin(x[at][low])][None]
            x[gone] = 0
            passive[gone] = False
    return x


@dataclass(frozen=True)
class Shape:
    """Bins of one sequence, and how many sequences have it."""

    bins: tuple[int, ...]
    repeats: int


def plan(histogram: Sequence[int]) -> list[Shape]:
    """Shapes that take every piece: ``histogram[b]`` pieces of bin b (b = 1..BINS)."""
    left = np.array(histogram, dtype=np.int64)
    full, out = len(left) - 1, []
    if left[full]:
        out.append(Shape((full,), int(left[full])))
        left[full] = 0
    combos = [(full - a, a, -1) for a in range(1, full // 2 + 1)]
    combos += [(full - a - b, b, a) for a in range(1, full // 3 + 1) for b in range(a, (full - a) // 2 + 1)]
    there = np.append(left > 0, True)
    combos = np.array([c for c in combos if there[list(c)].all()], dtype=np.int64).reshape(-1, DEPTH)
    if len(combos):
        target = left[1:full].astype(float)
        weight = np.sqrt(np.arange(1, full) / full)  # long pieces are harder to place later
        times = np.floor(nnls(np.where(combos < 0, full - 1, combos - 1), target, weight) + 1e-6).astype(np.int64)
        for c, k in zip(combos, times):
            bins = tuple(int(b) for b in c if b > 0)
            k = min(int(k), *(int(left[b]) // bins.count(b) for b in bins))
            if k > 0:
                out.append(Shape(bins, k))
                for b in bins:
                    left[b] -= k
    while left.any():
        room, bins = full, []
        free = left.copy()
        while (fit := np.flatnonzero(free[: room + 1])).size:
            b = int(fit[-1])
            bins.append(b)
            free[b] -= 1
            room -= b
        k = min(int(left[b]) // bins.count(b) for b in set(bins))
        out.append(Shape(tuple(bins), k))
        for b in bins:
            left[b] -= k
    return out


def _places(shapes: list[Shape]) -> dict[int, np.ndarray]:
    """By bin: rows (first rank, pieces a sequence, first sequence)."""
    out: dict[int, list] = {}
    taken: dict[int, int] = {}
    sequence = 0
    for s in shapes:
        for b in set(s.bins):
            m = s.bins.count(b)
            out.setdefault(b, []).append((taken.get(b, 0), m, sequence))
            taken[b] = taken.get(b, 0) + m * s.repeats
        sequence += s.repeats
    return {b: np.array(rows) for b, rows in out.items()}


def _assign(places: dict[int, np.ndarray]):
    def run(batches):
        for batch in batches:
            bins, rank = batch.column("bin").to_numpy(), batch.column("rank").to_numpy()
            sequence = np.zeros(len(bins), dtype=np.int64)
            for b in np.unique(bins):
                own = np.flatnonzero(bins == b)
                rows = places[int(b)]
                at = np.searchsorted(rows[:, 0], rank[own], side="right") - 1
                sequence[own] = rows[at, 2] + (rank[own] - rows[at, 0]) // rows[at, 1]
            yield batch.append_column("sequence_id", pa.array(sequence))
    return lean(run)


def pack(docs: DataFrame, tokens: str, id_col: str = "doc_id", text_col: str = "text",
         window: int = 2048, with_ids: bool = False) -> DataFrame:
    """Pieces (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids]).

    ``tokens`` is the path of a rank file; the ids of a text (null: empty) are followed by id
    1, so an empty text is one piece of one id.  Every row is a document, also one that
    repeats an id or has none.  Sequences hold at most ``window`` ids and are gapless from
    offset 0.  An empty table gives no piece.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    schema = PIECES + (", ids binary" if with_ids else "")
    pieces = stage(docs.mapInArrow(_pieces(tokens, window, with_ids), schema), "pieces")
    # ranks within a bin: counts by (bin, cell) first, so that a frequent length is no hot group
    pieces = pieces.withColumn("cell", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(16 * partitions(spark))))
    counts = pieces.groupBy("bin", "cell").count()
    before = counts.withColumn(
        "before", F.sum("count").over(Window.partitionBy("bin").orderBy("cell")) - F.col("count")).drop("count")
    histogram = np.zeros(BINS + 1, dtype=np.int64)
    for b, n in counts.groupBy("bin").agg(F.sum("count")).collect():  # BINS rows at most
        histogram[b] = n
    own = Window.partitionBy("bin", "cell").orderBy("doc_id", "start", "ids_crc32", "length")
    ranked = pieces.withColumn("row", F.row_number().over(own) - 1).join(before, ["bin", "cell"]).withColumn(
        "rank", (F.col("row") + F.col("before")).cast("long")).drop("row", "before", "cell")
    placed = ranked.mapInArrow(_assign(_places(plan(histogram))), widened(ranked, sequence_id=T.LongType()))
    along = Window.partitionBy("sequence_id").orderBy(F.desc("bin"), "rank")
    offset = F.sum("length").over(along.rowsBetween(Window.unboundedPreceding, 0)) - F.col("length")
    return placed.withColumn("offset", offset).drop("bin", "rank")
