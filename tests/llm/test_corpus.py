import functools
import math
import random
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
import sentencepiece

import public_tokenizers as public
from llm.llm_frames import corpus, frame, words
from watthour.llm import mixing, packing, sharding
from watthour.llm.language_id import forward, predict, train
from watthour.llm.lm_score import stupid_backoff
from watthour.llm.token_counts import token_counts, vocabulary

PIECES = public.path("piece_bpe_32k.model")
RANKS = public.path("byte_bpe_50k.tiktoken")


def test_packing(spark):
    from tokenizers import Tokenizer

    added = ["hi <|endoftext|> there", "<|endoftext|>", "a<|endoftext|><|endoftext|> \n b", "<|endoftext|", "x <|ENDOFTEXT|> <|endoftext|>\n\n"]
    rows = corpus(seed=2) + [(9100 + i, text, *[None] * 6) for i, text in enumerate(added)]
    model = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    docs = {r[0]: model.encode(r[1] or "", add_special_tokens=False).ids + [1] for r in rows}
    out = packing.pack(frame(spark, rows), RANKS, with_ids=True).toPandas()
    for d, own in out.groupby("doc_id"):
        own = own.sort_values("start")
        assert list(own.start) == [0, *own.length.cumsum()[:-1]] and own.length.sum() == len(docs[d])
        assert b"".join(own.ids) == np.array(docs[d], dtype="<u4").tobytes()
        assert all(zlib.crc32(x) == c for x, c in zip(own.ids, own.ids_crc32)) and set(own.doc_tokens) == {len(docs[d])}
    assert set(out.doc_id) == set(docs)
    for _, own in out.groupby("sequence_id"):
        own = own.sort_values("offset")
        assert list(own.offset) == [0, *own.length.cumsum()[:-1]] and own.length.sum() <= 2048
    assert packing.pack(frame(spark, []), RANKS).count() == 0


def test_plan_takes_everything_with_little_padding():
    rng = np.random.default_rng(4)
    h = np.bincount(np.clip(rng.gamma(2, 50, 20000).astype(int), 1, 256), minlength=257)
    shapes = packing.plan(h)
    used = Counter()
    for s in shapes:
        assert sum(s.bins) <= 256
        for b in s.bins:
            used[b] += s.repeats
    assert all(used[b] == h[b] for b in range(1, 257))
    assert sum(s.repeats for s in shapes) * 256 < 1.02 * (h * np.arange(257)).sum()


def test_token_counts(spark):
    from tokenizers import Tokenizer, models, pre_tokenizers

    model = Tokenizer(models.Unigram(vocabulary(PIECES), unk_id=0, byte_fallback=True))
    model.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=False)
    parts = ["<unk>", "<s>", "<", "unk", ">", " ", "  ", "    ", "a", "the", "漢字", "é", "\n", "\t", "▁", " w", "<0x41>", "является"]
    rng = random.Random(3)
    mixed = ["".join(rng.choices(parts, k=rng.randint(1, 12))) for _ in range(3000)]
    more = [" lead ▁ mark  two\n\n\x1c漢字 <s> <0x41>", "    if x:\n        y  ", "漢<unk>", "<unk>漢", "<unk><unk>", "a<unk>b", " ",
            " " * 5000, "x" * 5000, "漢" * 3000, "a <unk>漢" * 2000, *mixed]
    rows = corpus(seed=6) + [(9001 + i, text, *[None] * 6) for i, text in enumerate(more)]
    found = {r.doc_id: (r.n_chars, r.n_tokens) for r in token_counts(frame(spark, rows), PIECES).collect()}
    assert found == {r[0]: (len(r[1] or ""), len(model.encode(r[1] or "", add_special_tokens=False).ids)) for r in rows}
    again = [(None, "two words", *[None] * 6), (None, "two words", *[None] * 6), (7, None, *[None] * 6), (7, "", *[None] * 6)]
    got = sorted((r.doc_id or 0, r.n_chars, r.n_tokens) for r in token_counts(frame(spark, again), PIECES).collect())
    assert got[0] == got[1] and got[0][1] == 9 and got[2:] == [(7, 0, 0), (7, 0, 0)]
    assert token_counts(frame(spark, []), PIECES).count() == 0


def test_lm_score(spark):
    rows = corpus(seed=8)
    docs = {r[0]: words(r[1]) for r in rows}
    one, two = Counter(), Counter()
    for w in docs.values():
        one.update(["<s>"] * bool(w) + w)
        two.update(zip(["<s>", *w], w))
    n = sum(map(len, docs.values()))
    found = {r.doc_id: r for r in stupid_backoff(frame(spark, rows)).collect()}
    for d, w in docs.items():
        want = sum(math.log(two[p] / one[p[0]]) if two[p] > 1 else math.log(0.4 * one[p[1]] / n) for p in zip(["<s>", *w], w))
        assert found[d].n_words == len(w) and found[d].log_score == pytest.approx(want, abs=1e-9)
    assert found[next(r[0] for r in rows if r[1] is None)].log_score_per_word is None
    assert stupid_backoff(frame(spark, [])).count() == 0


def test_language_forward_and_edges(spark):
    rows = [(i, t, lang, None, 0, None, None, None) for i, (t, lang) in enumerate([
        ("the cat and the dog", "en"), ("der hund und die katze", "de"), (None, "en"), ("", "de"), ("123 !!", "en"), ("und der hund", None), ("the dog", "de"), ("½ ²", "en")])]
    docs = frame(spark, rows)
    model = train(docs.where("doc_id < 2"), PIECES)
    spelled = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = [spelled.id_to_piece(i).replace("▁", " ").encode() for i in range(spelled.get_piece_size())
             if not (spelled.is_control(i) or spelled.is_unknown(i) or spelled.is_byte(i))]
    known = {v: i for i, v in enumerate(dict.fromkeys([*(bytes([b]) for b in range(256)), *(v for v in texts if b" " not in v[1:])]))}
    assert len(known) == len(model.probabilities)

    def brute(word):
        """All segmentations of the whole word, in whole numbers of any size."""
        word, ways = b" " + word, [[Fraction(1)] * 2]
        exact = functools.cache(lambda piece: [Fraction(p) for p in model.probabilities[piece]])
        for end in range(1, len(word) + 1):
            total = [Fraction(0)] * 2
            for start in range(end):
                if (piece := known.get(word[start:end])) is not None:
                    total = [t + w * p for t, w, p in zip(total, ways[start], exact(piece))]
            ways.append(total)
        return [math.log(w.numerator) - math.log(w.denominator) for w in ways[-1]]

    long = max((v for v in texts if v[:1] == b" " and b" " not in v[1:]), key=len).decode().strip()
    tried = [w.encode() for w in ("hund", "a" * 100, "漢字", "x", long, "не" + long * 4, "漢字の文章" * 9, "donaudampfschifffahrt" * 13, long * 14, "a" * 15, "a" * 16, "a" * 255, "a" * 256)]
    assert np.allclose(forward(model, tried), [brute(w) for w in tried])
    found = {r.doc_id: (r.lang_pred, r.score) for r in predict(docs, model).collect()}
    assert [found[i][0] for i in range(8)] == ["en", "de", "und", "und", "und", "de", "en", "und"]
    assert found[2][1] == 0 and 0.5 < found[0][1] <= 1
    assert {r.lang_pred for r in predict(docs, train(docs.limit(0), PIECES)).collect()} == {"und"}


def test_language_sample_is_bounded_and_counts_repeats_once(spark):
    rows = [(i, f"{'the cat' if i % 2 else 'der hund'} {chr(97 + i % 26)}{chr(97 + i // 26)}", "en" if i % 2 else "de", *[None] * 5) for i in range(400)]
    hot = [(None, "the dog", "en", *[None] * 5)] * 300
    small, again = (train(frame(spark, rows + hot), PIECES, per_language=50) for _ in range(2))
    assert small.languages == ["de", "en"] and (small.probabilities == again.probabilities).all()
    whole = train(frame(spark, rows), PIECES, per_language=1000)
    assert (whole.probabilities == train(frame(spark, rows * 2), PIECES, per_language=1000).probabilities).all()
    found = {r.doc_id: r.lang_pred for r in predict(frame(spark, rows), small).collect()}
    assert all(found[r[0]] == r[2] for r in rows)
    assert predict(frame(spark, []), small).count() == 0
    tied = predict(frame(spark, [(None, "the the", None, *[None] * 5)] * 2), train(frame(spark, [(1, "the", "b", *[None] * 5), (2, "the", "a", *[None] * 5)]), PIECES))
    assert [(r.doc_id, r.lang_pred, r.score) for r in tied.collect()] == [(None, "a", 0.5)] * 2


def targets(sizes, weights=(5, 2, 1)):
    """Shares by weight; the excess over twice the size is dealt again until none is above."""
    w = dict(zip(sizes, (weights[i % 3] for i in range(len(sizes)))))
    left, out, open_ = 1.5 * sum(sizes.values()), {}, dict(sizes)
    while open_:
        unit = left / sum(w[s] for s in open_)
        full = [s for s in open_ if unit * w[s] > 2 * sizes[s]]
        if not full:
            return {**out, **{s: unit * w[s] for s in open_}}
        for s in full:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
            del open_[s]
    return out


def test_mixing(spark, monkeypatch):
    monkeypatch.setattr(mixing, "CELL", 8)
    rows = corpus(seed=4, size=200)
    df = mixing.mix(frame(spark, rows))
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
    found = df.collect()
    assert sorted(map(str, found)) == sorted(map(str, mixing.mix(frame(spark, rows)).collect()))
    sizes = {r[0]: len(words(r[1])) for r in rows}
    assert {r.doc_id: r.size for r in found} == sizes
    total = Counter()
    for r in rows:
        total[r[3]] += sizes[r[0]]
    order = {s: total[s] for s in sorted(total, key=lambda s: (s is None, s or ""))}
    want = targets(order)
    for s in order:
        own = [r for r in found if r.source == s]
        assert own[0].source_size == total[s] and own[0].target == pytest.approx(want[s])
        assert abs(sum(r.taken for r in own) - want[s]) <= max(r.size for r in own)
        assert all(r.taken == r.copies * r.size and r.copies in (0, 1, 2) for r in own)
    copied = mixing.repeat_documents(frame(spark, rows), df)
    assert copied.columns == frame(spark, rows).columns and copied.count() == sum(r.copies for r in found)
    assert mixing.mix(frame(spark, [])).count() == 0


def test_sharding(spark):
    names = [f"n{i}" for i in range(7)]
    table = sharding.fill(names, 101)
    counts = Counter(table)
    assert max(counts.values()) - min(counts.values()) <= 1 and set(counts) == set(range(7))
    fewer = sharding.fill(names[:-1], 101)
    moved = sum(a != b for a, b in zip(table, fewer) if a != 6)
    assert moved < 30
    df = sharding.place(frame(spark, corpus()), names, 101)
    assert df.count() == len(corpus()) and all(r.shard == names[table[r.slot]] for r in df.collect())
    with pytest.raises(ValueError):
        sharding.fill(names, 100)
