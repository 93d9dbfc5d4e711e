"""Quality verdicts: boosted trees over document statistics, monotone where a rule must be.

Statistics are counted over whole texts, in vectorised passes over the bytes of many texts at
once.  The trees are fitted on labelled documents: distinct rows of statistics with how many
labels of each kind they have, at most about ``SAMPLE`` of them, drawn by a hash of the row (the
only bounded step: everything else covers all rows).  Growing a tree splits on histograms of
quantile bins; for features in ``FALLING`` a split whose right side would score higher than
its left is not taken, and what lies below a split keeps to its side of the midpoint, so
that more symbols, repeats or upper case never raise a score.  All trees are one set of flat
node arrays; scoring steps all documents down all levels together.

Defined cases: a null text is an empty one; texts without words fail the base rules; rows of a
repeated or null id are documents of their own (each is trained on if its id has a label);
several labels of one id count as many; labels that are null or have no document take no part;
without both kinds of label there is nothing to learn and the base rules decide alone; empty
tables give no rows; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watthour.llm.staging import stage
from watthour.llm.textops import CHUNK, SEPARATORS, U64, joined, lean, mix, prefix_hash, range_hash, slices, word_spans

SAMPLE = 20_000  # distinct labelled rows of statistics that the trees are fitted on
TREES, DEPTH, RATE, BINS, LEAST = 60, 4, 0.15, 64, 8.0
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_chars", "n_lines",
          "n_upper", "n_letters", "n_digits", "n_marks", "n_distinct"]
FEATURES = ["log_words", "word_length", "symbols", "dup_lines", "repeats", "upper", "letters", "digits", "marks", "distinct", "line_words"]
FALLING = {"symbols", "dup_lines", "repeats", "upper"}  # more of these never raises a score

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True
_LETTER[0xC2:] = True  # the first byte of a code point beyond ASCII
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[48:58] = True
_MARK = np.zeros(256, dtype=bool)
_MARK[list(b"!?.,;:'\"()[]{}-_=+/\\~^`@")] = True
_FIRST = (np.arange(256) & 0xC0) != 0x80  # bytes that start a code point


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of data[start:end] for spans in order that do not overlap, in chunks."""
    out = np.empty(len(starts), dtype=U64)
    i = 0
    while i < len(starts):
        base = int(starts[i])
        j = int(np.searchsorted(ends, base + CHUNK, side="right"))
        if j == i:  # one span longer than a chunk: the hash of its pieces' hashes
            total = np.zeros(1, dtype=U64)
            for at in range(base, int(ends[i]), CHUNK):
                total = mix(total + prefix_hash(data[at:min(at + CHUNK, int(ends[i]))])[-1])
            out[i] = total[0]
            i += 1
            continue
        out[i:j] = range_hash(prefix_hash(data[base:int(ends[j - 1])]), starts[i:j] - base, ends[i:j] - base)
        i = j
    return out


def _again(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys stand there more than once, and which of those not for the first time."""
    order = np.argsort(keys, kind="stable")
    sorted_ = keys[order]
    same = np.zeros(len(keys) + 1, dtype=bool)
    same[1:-1] = sorted_[1:] == sorted_[:-1]
    many, later = np.empty(len(keys), dtype=bool), np.empty(len(keys), dtype=bool)
    many[order], later[order] = same[:-1] | same[1:], same[:-1]
    return many, later


def statistics(texts: pa.Array) -> dict[str, np.ndarray]:
    """The counts of ``COUNTS`` for every text."""
    data, offsets = joined(texts)  # a newline ends each text
    n = len(offsets) - 1
    doc_of = lambda at: np.searchsorted(offsets, at, side="right") - 1
    count = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags)])[offsets])
    starts, ends = word_spans(data)
    doc = doc_of(starts)
    words = mix(span_hashes(data, starts, ends))
    salt = mix(np.arange(n, dtype=U64) + U64(1))  # equal words of other texts are other words
    repeat = np.zeros(len(words), dtype=bool)
    if len(words) > 2:
        window = mix(words[:-2] * U64(3) + mix(words[1:-1] * U64(5) + mix(words[2:] * U64(7))))
        inside = np.flatnonzero(doc[2:] == doc[:-2])
        many = inside[_again(window[inside] + salt[doc[inside]])[0]]
        for k in range(3):
            repeat[many + k] = True
    _, seen = _again(words + salt[doc])
    line_ends = np.flatnonzero(data == 10)
    line_starts = np.concatenate([[0], line_ends[:-1] + 1]).astype(np.int64) if len(line_ends) else line_ends
    filled = np.searchsorted(starts, line_ends) > np.searchsorted(starts, line_starts)
    a, b = line_starts[filled], line_ends[filled]
    line_doc = doc_of(a)
    _, dup = _again(mix(span_hashes(data, a, b)) + mix((b - a).astype(U64)) + salt[line_doc])
    within = ~SEPARATORS[data]
    total = lambda at, flags=None: np.bincount(at, weights=flags, minlength=n).astype(np.int64)
    return {
        "n_words": total(doc), "word_chars": count(_FIRST[data] & within), "n_symbols": count(_SYMBOL[data]),
        "n_dup_lines": total(line_doc, dup), "n_repeat_words": total(doc, repeat),
        "n_chars": count(_FIRST[data]) - 1, "n_lines": total(line_doc), "n_upper": count(_UPPER[data]), "n_letters": count(_LETTER[data]),
        "n_digits": count(_DIGIT[data]), "n_marks": count(_MARK[data]), "n_distinct": total(doc, ~seen)}


def features(counts: dict[str, np.ndarray]) -> np.ndarray:
    """Rows of ``FEATURES``: shares and lengths, always finite."""
    c = {name: np.asarray(values, dtype=np.float64) for name, values in counts.items()}
    words, chars = np.maximum(c["n_words"], 1), np.maximum(c["word_chars"], 1)
    return np.stack([
        np.log1p(c["n_words"]), c["word_chars"] / words, c["n_symbols"] / words, c["n_dup_lines"] / np.maximum(c["n_lines"], 1),
        c["n_repeat_words"] / words, c["n_upper"] / np.maximum(c["n_letters"], 1), c["n_letters"] / chars, c["n_digits"] / chars,
        c["n_marks"] / words, c["n_distinct"] / words, c["n_words"] / np.maximum(c["n_lines"], 1)], axis=1)


@dataclass
class Forest:
    """Flat node arrays of all trees; a leaf is a node that is its own child."""

    roots: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of being good."""
        out = np.empty(len(x))
        for start in range(0, len(x), 4096):
            part = x[start:start + 4096]
            node = np.tile(self.roots, (len(part), 1))
            for _ in range(self.depth):
                goes_left = np.take_along_axis(part, self.feature[node], axis=1) <= self.cut[node]
                node = np.where(goes_left, self.left[node], self.right[node])
            out[start:start + 4096] = self.base + self.value[node].sum(axis=1)
        return 1 / (1 + np.exp(-out))


def fit(x: np.ndarray, good: np.ndarray, bad: np.ndarray, falling: set[int], trees: int = TREES, depth: int = DEPTH,
        rate: float = RATE, bins: int = BINS, least: float = LEAST) -> Forest:
    """Trees on the logistic loss; a row has ``good`` and ``bad`` labels."""
    rows, width = x.shape
    weight = good + bad
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)]
    binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    base = float(np.log((good.sum() + 0.5) / (bad.sum() + 0.5)))
    margin = np.full(rows, base)
    nodes: list[list] = []  # feature, cut, left, right, value
    roots = []

    def new() -> int:
        at = len(nodes)
        nodes.append([0, 0.0, at, at, 0.0])
        return at

    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = good - weight * p, np.maximum(weight * p * (1 - p), 1e-9)
        root = new()
        roots.append(root)
        work = [(root, np.arange(rows), -np.inf, np.inf, 0)]
        while work:
            at, own, low, high, level = work.pop()
            g, h = grad[own].sum(), hess[own].sum()
            value = float(np.clip(g / (h + 1), low, high))
            best = None
            for f in range(width if level < depth else 0):
                size = len(cuts[f]) + 1
                gs = np.cumsum(np.bincount(binned[own, f], weights=grad[own], minlength=size))[:-1]
                hs = np.cumsum(np.bincount(binned[own, f], weights=hess[own], minlength=size))[:-1]
                ws = np.cumsum(np.bincount(binned[own, f], weights=weight[own], minlength=size))[:-1]
                if not len(gs):
                    continue
                left, right = np.clip(gs / (hs + 1), low, high), np.clip((g - gs) / (h - hs + 1), low, high)
                gain = 2 * left * gs - left**2 * (hs + 1) + 2 * right * (g - gs) - right**2 * (h - hs + 1)
                gain -= 2 * value * g - value**2 * (h + 1)
                gain[(ws < least) | (weight[own].sum() - ws < least)] = -np.inf
                if f in falling:
                    gain[right > left] = -np.inf
                k = int(np.argmax(gain))
                if gain[k] > 1e-6 and (best is None or gain[k] > best[0]):
                    best = gain[k], f, k, left[k], right[k]
            if best is None:
                nodes[at][4] = rate * value
                margin[own] += rate * value
                continue
            _, f, k, left, right = best
            middle = (left + right) / 2
            a, b = new(), new()
            nodes[at][:4] = f, float(cuts[f][k]), a, b
            goes_left = binned[own, f] <= k
            bounds = ((middle, high), (low, middle)) if f in falling else ((low, high), (low, high))
            work += [(a, own[goes_left], *bounds[0], level + 1), (b, own[~goes_left], *bounds[1], level + 1)]
    columns = list(zip(*nodes)) if nodes else [()] * 5
    return Forest(np.array(roots, dtype=np.int64), *(np.array(c, dtype=t) for c, t in zip(columns, (np.int64, float, np.int64, np.int64, float))), depth, base)


def _counted(batches):
    for batch in batches:
        for part in slices(batch, "text"):
            stats = statistics(part.column("text"))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(stats[c]) for c in COUNTS)], names=["doc_id", *COUNTS])


def _scored(forest: Forest | None):
    def run(batches):
        for batch in batches:
            x = features({c: batch.column(c).to_numpy() for c in COUNTS})
            score = np.ones(len(x)) if forest is None else forest.score(x)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], names=[*batch.schema.names, "quality"])
    return run


BASE_FAILED = "n_words < 50 OR 100 * n_repeat_words > 50 * n_words"


def train(stats: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", label_col: str = "quality") -> Forest | None:
    """Trees for (doc_id, counts) with (id, 0/1) labels; None without both kinds."""
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), (F.col(label_col) > 0).alias("good")).where("good IS NOT NULL")
    known = known.groupBy("doc_id").agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad"))
    rows = stats.where(f"NOT ({BASE_FAILED})").join(known, "doc_id").groupBy(*COUNTS).agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    rows = stage(rows, "labelled")
    n = rows.count()
    share = min(1.0, sample / max(n, 1))
    drawn = rows.where(F.pmod(F.xxhash64(*COUNTS), F.lit(1 << 30)) < (1 << 30) * share).toPandas()
    drawn = drawn.sort_values(COUNTS, kind="stable")  # the sums of a fit do not hang on the order of tasks
    if not len(drawn) or drawn["good"].sum() == 0 or drawn["bad"].sum() == 0:
        return None
    x = features({c: drawn[c].to_numpy() for c in COUNTS})
    return fit(x, drawn["good"].to_numpy(float), drawn["bad"].to_numpy(float), {FEATURES.index(f) for f in FALLING})


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, counts) of every row, written once."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return stage(texts.mapInArrow(lean(_counted), "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS)), "statistics")


def verdicts(stats: DataFrame, forest: Forest | None, least: float = 0.5) -> DataFrame:
    """``stats`` with base_failed, quality (0 to 1) and kept."""
    schema = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", quality double"
    scored = stats.select("doc_id", *COUNTS).mapInArrow(_scored(forest), schema).withColumn("base_failed", F.expr(BASE_FAILED))
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= least))


def quality_rules(docs: DataFrame, labels: DataFrame, least: float = 0.5, sample: int = SAMPLE) -> DataFrame:
    """Statistics and verdict of every document, with trees fitted on the labelled ones."""
    stats = document_statistics(docs)
    return verdicts(stats, train(stats, labels, sample), least)
