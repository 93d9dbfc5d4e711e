"""Token counts under a unigram vocabulary, without making tokens: count-only Viterbi.

An Aho-Corasick automaton over the vocabulary enumerates the pieces that end at each
character of a word; dynamic programming keeps the best score and its number of pieces.
Words (a run of space marks and what follows up to the next mark) are counted once and
remembered, as no piece holds a mark after another character; pieces of several marks match
in runs of spaces.
"""

from __future__ import annotations

import re
from math import inf

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watthour.llm.staging import small_batches
from watthour.llm.textops import remembered

MARK = "▁"
WORD = re.compile(f"{MARK}+[^{MARK}]*")
UNKNOWN_PENALTY = 10.0  # fixed: an unknown character scores this much below the worst piece


def vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class Counter(dict):
    """Number of tokens by word, which starts with its marks.

    Ties: of equal scores the path through the earlier start (the longer last piece) is kept.
    A character that starts no piece of its own is unknown.  The first piece of a vocabulary
    stands for unknown text, and where a text holds it literally it may match.  Unknown
    neighbours are taken together and give a token for each of their bytes, only that piece
    on its own is one token.
    """

    def __init__(self, pieces: list[tuple[str, float]], size: int = 700_000):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            if MARK in piece.lstrip(MARK):
                raise ValueError(f"piece {piece!r} reaches over two words")
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.single = {p for p, _ in pieces if len(p) == 1}
        self.unknown = min(s for _, s in pieces) - UNKNOWN_PENALTY
        self.literal = pieces[0][0]
        self.size, self.old = size, {}

    def __missing__(self, word: str) -> int:
        count = self.old.get(word)
        if count is None:
            count = self.count(word)
        if len(word) <= 64:
            if len(self) >= self.size:
                self.old = dict(self)
                self.clear()
            self[word] = count
        return count

    def count(self, text: str) -> int:
        if not self.single.issuperset(text) or self.literal in text:
            return self._count_with_unknowns(text)
        n = len(text)
        best = [-inf] * (n + 1)
        count = [0] * (n + 1)
        best[0] = 0.0
        for last, (length, score) in self.automaton.iter(text):  # at an end the longest piece comes first
            score += best[last + 1 - length]
            if score > best[last + 1]:
                best[last + 1], count[last + 1] = score, count[last + 1 - length] + 1
        return count[n]

    def _count_with_unknowns(self, text: str) -> int:
        n, size = len(text), len(self.literal.encode())
        best, count = [-inf] * (n + 1), [0] * (n + 1)
        # of the best path to each end: does it end in unknown text, and in the literal piece alone
        open_, alone = [False] * (n + 1), [False] * (n + 1)
        best[0] = 0.0
        ends: list[list] = [[] for _ in range(n + 1)]
        for last, piece in self.automaton.iter(text):
            ends[last + 1].append(piece)

        def before(start: int) -> int:
            """Tokens up to ``start`` where unknown text goes on from there."""
            return count[start] + (size - 1 if alone[start] else 0)

        for end in range(1, n + 1):
            for length, score in ends[end]:
                start = end - length
                score += best[start]
                if score > best[end]:
                    literal = text.startswith(self.literal, start) and length == len(self.literal)
                    best[end], open_[end], alone[end] = score, literal, literal and not open_[start]
                    count[end] = before(start) + size if literal and open_[start] else count[start] + 1
            char = text[end - 1]
            if char not in self.single and best[end - 1] + self.unknown > best[end]:
                best[end], open_[end], alone[end] = best[end - 1] + self.unknown, True, False
                count[end] = before(end - 1) + len(char.encode())
        return count[n]

    def text(self, text: str) -> int:
        if not text:
            return 0
        marked = text.replace(" ", MARK)
        return sum(map(self.__getitem__, WORD.findall(marked if marked[0] == MARK else MARK + marked)))


def counter(path: str) -> Counter:
    memory = remembered("counts")
    if path not in memory:
        memory[path] = Counter(vocabulary(path))
    return memory[path]


def token_counts(docs: DataFrame, vocab: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, n_tokens) for every row; null and empty texts have no token.

    ``vocab`` is the path of a sentencepiece file whose pieces and scores are taken as a
    unigram model with byte fallback, over the text as one string with a space mark in front and
    for each space (no split at spaces, no other normalisation).  Rows are counted apart: null and
    repeated ids stay, equal texts have equal counts.  Other columns are left out; an empty table gives none.
    """
    def run(batches):
        count = counter(vocab)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()),
                 pa.array([count.text(t) for t in texts], pa.int64())],
                names=["doc_id", "n_chars", "n_tokens"])

    small_batches(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return docs.mapInArrow(run, "doc_id long, n_chars long, n_tokens long")
