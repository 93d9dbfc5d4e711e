"""Language identification by unigram piece models, marginalised over segmentations.

A fixed public vocabulary gives the pieces.  For each language, piece probabilities come from
the vocabulary's own segmentation of training texts, smoothed.  A word is scored by the
forward algorithm: the sum, over all segmentations into pieces, of the product of their
probabilities.  A text's score is the product over its words; words are scored once, all
languages and many words at a time, and remembered.  Words are runs of letters; combining marks
and digits part them, as they do everywhere in training and scoring alike.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from watthour.llm.staging import small_batches, widened
from watthour.llm.textops import U64, lean, mix, prefix_hash, range_hash, remembered, slices

MARK = "▁"
STRETCH = 16  # bytes after which the running sums are rescaled, so that none leaves the range of doubles
TOGETHER = 2048  # words scored side by side
LONG = 256  # bytes of a word from which it is scored alone, byte by byte, not side by side with others
RANGE = 1 << 40  # of the hashes that choose the sample
WORDS = re.compile(r"[^\W\d_]+")  # runs of letters: what else a text holds tells no language
UNKNOWN = "und"


@dataclass(frozen=True)
class Pieces:
    """Pieces as bytes (a space stands for the mark), by hash, and every single byte."""

    values: list[bytes]
    slots: np.ndarray  # direct table: top bits of the hash -> piece or -1
    hashes: np.ndarray
    ids: dict[str, int]  # as the vocabulary spells them
    places: dict[bytes, int]
    sizes: list[int]  # lengths that pieces have, ascending

    @staticmethod
    def load(path: str) -> Pieces:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        values, ids = [bytes([b]) for b in range(256)], {}
        known = {v: i for i, v in enumerate(values)}
        for i in range(model.get_piece_size()):
            if model.is_control(i) or model.is_unknown(i) or model.is_byte(i):
                continue
            piece = model.id_to_piece(i)
            raw = piece.replace(MARK, " ").encode()
            if b" " in raw[1:]:
                continue  # no word holds a space
            if raw not in known:
                known[raw] = len(values)
                values.append(raw)
            ids[piece] = known[raw]
        data = np.frombuffer(b"".join(values), dtype=np.uint8)
        ends = np.cumsum([len(v) for v in values])
        hashes = range_hash(prefix_hash(data), np.concatenate([[0], ends[:-1]]), ends)
        slots = np.full((4, 1 << 20), -1, dtype=np.int32)
        for i, h in enumerate(hashes):
            row = slots[:, int(h >> U64(44))]
            row[np.flatnonzero(row < 0)[0]] = i
        return Pieces(values, slots, hashes, ids, known, sorted({len(v) for v in values}))

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``h`` that are pieces, and which."""
        at, slot = np.arange(len(h)), (h >> U64(44)).astype(np.int64)
        places, found = [], []
        for column in self.slots:
            piece = column[slot[at]]
            at, piece = at[piece >= 0], piece[piece >= 0]
            hit = self.hashes[piece] == h[at]
            places.append(at[hit])
            found.append(piece[hit])
            at = at[~hit]
            if not len(at):
                break
        return np.concatenate(places), np.concatenate(found)


def pieces(path: str) -> Pieces:
    known = remembered("language").setdefault("pieces", {})
    if path not in known:
        known[path] = Pieces.load(path)
    return known[path]


@dataclass(frozen=True)
class Model:
    languages: list[str]
    probabilities: np.ndarray  # pieces x languages
    path: str


def forward(model: Model, words: Sequence[bytes]) -> np.ndarray:
    """Log of the summed probability of all segmentations: words x languages."""
    out = np.zeros((len(words), len(model.languages)))
    lengths = np.array([len(w) + 1 for w in words])
    for i in np.flatnonzero(lengths > LONG):
        out[i] = _alone(model, b" " + words[i])
    order = np.argsort(-lengths, kind="stable")
    order = order[lengths[order] <= LONG]
    for first in range(0, len(order), TOGETHER):
        own = order[first:first + TOGETHER]
        out[own] = _together(model, [b" " + words[i] for i in own], lengths[own])
    return out


def _together(model: Model, words: list[bytes], lengths: np.ndarray) -> np.ndarray:
    """The same for words in descending order of length, a stretch of all of them at a time.

    ``alpha`` holds the sums at the ends of a stretch, and before them those of the last
    ``reach`` places of the stretch before, from which a piece may still start.
    """
    known = pieces(model.path)
    reach = known.sizes[-1]
    width = reach + STRETCH
    out = np.zeros((len(words), len(model.languages)))
    alpha = np.zeros((width, len(words), len(model.languages)))
    alpha[reach - 1] = 1
    for at in range(0, int(lengths[0]), STRETCH):
        n = int(np.searchsorted(-lengths, -at, side="left"))  # words longer than that
        alpha = alpha[:, :n]
        grid = b"".join(w[max(at - reach, 0):at + STRETCH].rjust(reach + min(len(w) - at, STRETCH), b"\0").ljust(width, b"\0") for w in words[:n])
        c = prefix_hash(np.frombuffer(grid, dtype=np.uint8))
        place = np.arange(n) * width + reach
        for end in range(1, int(min(lengths[0] - at, STRETCH)) + 1):
            live = int(np.searchsorted(-lengths[:n], -(at + end), side="right"))  # words that reach this end
            for size in known.sizes:
                if size > at + end:
                    break
                hit, piece = known.find(range_hash(c, place[:live] + end - size, place[:live] + end))
                alpha[reach - 1 + end, hit] += alpha[reach - 1 + end - size, hit] * model.probabilities[piece]
        more = int(np.searchsorted(-lengths[:n], -(at + STRETCH), side="left"))
        done = np.arange(more, n)
        out[done] += np.log(alpha[reach - 1 + lengths[done] - at, done])
        last = alpha[-1, :more]
        out[:more] += np.log(last)
        alpha = np.concatenate([alpha[STRETCH:, :more] / last, np.zeros((STRETCH, more, out.shape[1]))])
    return out


def _alone(model: Model, word: bytes) -> np.ndarray:
    """The same for one word of any length."""
    known = pieces(model.path)
    reach, out = known.sizes[-1], np.zeros(len(model.languages))
    alpha = [np.ones(len(model.languages))]  # the last places
    for end in range(1, len(word) + 1):
        total = np.zeros(len(model.languages))
        for size in known.sizes:
            if size > end:
                break
            piece = known.places.get(word[end - size:end])
            if piece is not None:
                total += alpha[-size] * model.probabilities[piece]
        alpha.append(total)
        if end % STRETCH == 0:
            out += np.log(total)
            alpha = [a / total for a in alpha[-reach:]]
    return out + np.log(alpha[-1])


class Words(dict):
    """Rows of word scores; starts afresh when full, by number or by characters."""

    def __init__(self, model: Model, size: int = 200_000):
        super().__init__()
        self.model, self.size, self.characters = model, size, 0
        self.scores = np.zeros((size, len(model.languages)), dtype=np.float32)

    def text_scores(self, texts: list[list[str]]) -> np.ndarray:
        out = np.zeros((len(texts), len(self.model.languages)))
        flat = [w for words in texts for w in words]
        for first in range(0, len(flat), self.size // 2):
            part = flat[first:first + self.size // 2]
            new = [w for w in dict.fromkeys(part) if w not in self]
            if len(self) + len(new) > self.size or self.characters > 64 * self.size:
                self.clear()
                self.characters = 0
                new = list(dict.fromkeys(part))
            if new:
                at = len(self)
                self.scores[at:at + len(new)] = forward(self.model, [w.encode() for w in new])
                self.update(zip(new, range(at, at + len(new))))
                self.characters += sum(map(len, new))
            rows = np.fromiter(map(self.__getitem__, part), dtype=np.int64, count=len(part))
            sums = np.zeros((len(part) + 1, out.shape[1]))
            np.cumsum(self.scores[rows], axis=0, out=sums[1:], dtype=np.float64)
            ends = np.cumsum([len(w) for w in texts])
            a = np.clip(ends - [len(w) for w in texts] - first, 0, len(part))
            b = np.clip(ends - first, 0, len(part))
            out += sums[b] - sums[a]
        return out


def train(docs: DataFrame, path: str, per_language: int = 1000, text_col: str = "text", lang_col: str = "lang",
          id_col: str = "doc_id", smoothing: float = 0.5) -> Model:
    """Piece probabilities from at most ``per_language`` different texts of each label.

    The sample takes the smallest hashes of id and text, so it is the same in every run; rows
    without label or text are left out, and repeated rows count once.  A threshold from the
    number of different rows leaves about twice as many for the ranking, however many there are.
    Only piece counts reach the driver: at most one per label and piece.
    """
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.xxhash64(id_col, text_col).alias("h"))
    enough = 2 * per_language
    bounds = rows.groupBy("lang").agg(F.approx_count_distinct("h", 0.02).alias("n")).collect()  # one row a label, as in the model
    below = docs.sparkSession.createDataFrame([(r["lang"], RANGE * enough // max(r["n"], enough)) for r in bounds], "label string, below long")
    few = rows.join(F.broadcast(below), F.col("lang") == F.col("label")).where(F.pmod("h", F.lit(RANGE)) < F.col("below"))
    first = Window.partitionBy("lang").orderBy(F.pmod("h", F.lit(RANGE)), "h")
    sample = few.select("lang", "text", "h").dropDuplicates(["lang", "h"]).withColumn("n", F.row_number().over(first)).where(
        F.col("n") <= per_language).select("lang", "text")

    def count(batches):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        known = pieces(path)
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                total = np.zeros(len(known.values), dtype=np.int64)
                words = Counter(WORDS.findall(text))
                for w, found in zip(words, model.encode(list(words), out_type=str, num_threads=1)):
                    for p in found:
                        i = known.ids.get(p)
                        if i is not None:
                            total[i] += words[w]
                at = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(total[at])], names=["lang", "piece", "n"])

    found = sample.mapInArrow(count, "lang string, piece long, n long").groupBy("lang", "piece").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(found["lang"].unique())
    counts = np.full((len(pieces(path).values), len(languages)), smoothing)
    counts[found["piece"], np.searchsorted(languages, found["lang"]) if languages else []] += found["n"]
    return Model(languages, counts / counts.sum(axis=0), path)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
            keep: dict[str, Column] | None = None) -> DataFrame:
    """(doc_id, kept columns, lang_pred, score) for every row.

    ``score`` is the posterior of the language under equal priors; ties go to the first
    language in order.  A null text, one without letters, or a model without languages gives
    ``und`` and 0.  Null and repeated ids are only carried.
    """
    keep = keep or {}
    small_batches(docs.sparkSession)
    token = f"{model.path}:{mix(np.array([hash(model.probabilities.tobytes()) & (2**63 - 1)], dtype=U64))[0]}"

    def run(batches):
        memory = remembered("language")
        if memory.get("model") != token:
            memory.pop("words", None)
            memory.update(model=token, words=Words(model))
        words = memory["words"]
        for batch in batches:
            for part in slices(batch, "__text"):
                texts = part.column("__text").to_pylist()
                letters = [WORDS.findall(t) if t and model.languages else [] for t in texts]
                usable = [any(c.isalpha() for w in x for c in w) for x in letters]  # a word may be all ½ or ²
                scores = words.text_scores(letters)
                label, score = [], []
                for u, row in zip(usable, scores):
                    best = int(np.argmax(row)) if u else -1
                    label.append(model.languages[best] if u else UNKNOWN)
                    score.append(float(1 / np.exp(row - row[best]).sum()) if u else 0.0)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(i) for i in range(part.num_columns - 1)), pa.array(label, pa.string()), pa.array(score, pa.float64())],
                    names=[*part.schema.names[:-1], "lang_pred", "score"])

    run = lean(run)
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), *(c.alias(n) for n, c in keep.items()), F.col(text_col).alias("__text"))
    schema = widened(given.drop("__text"), lang_pred=T.StringType(), score=T.DoubleType())
    return given.mapInArrow(run, schema)
