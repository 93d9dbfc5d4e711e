import os
from collections import Counter

import pytest

import corpus_pipeline
from llm.llm_frames import corpus, frame
from oracle import connect, differences
from watthour.llm.queries import ORACLES, QUERIES

SF_DIR = os.environ.get("WATTHOUR_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not there")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    assert differences(QUERIES[name](spark, SF_DIR), connect(SF_DIR), ORACLES[name]) == []


def test_language_on_held_out_documents(spark):
    rows = QUERIES["op8_language_id"](spark, SF_DIR).collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    held = [r for r in rows if r.held_out and lang[r.doc_id]]
    assert held and sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.9 * len(held)


def test_documents_without_labels_stay(spark):
    texts = ["plain words", None, "", "12 ½ !?", "漢字"]
    docs = frame(spark, [(i, t, *[None] * 6) for i, t in enumerate(texts)])
    kept = corpus_pipeline.STAGES[0][1](spark, docs, SF_DIR)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [0, 4]


def test_join_keeps_one_row_of_each_component(spark):
    """Unrelated rows of one id all stay; of near copies one stays, with null ids too."""
    one = corpus_pipeline.STAGES[1][1]
    base = " ".join(f"w{i}" for i in range(60))
    texts = [(7, "first text of the id seven"), (7, "quite another one under this id"), (7, "first text of the id seven"),
             (None, base), (None, base + " x"), (None, base + " y"), (None, "alone without any id at all"),
             (None, "near to an id " + base), (9, "near to an id " + base + " z"), (8, "   "), (8, None)]
    docs = frame(spark, [(i, t, *[None] * 6) for i, t in texts])
    kept = sorted(((r.doc_id, r.text) for r in one(spark, docs, SF_DIR).collect()), key=str)
    linked = [t for _, t in kept if t and base in t]
    assert len(linked) == 1 and (9, linked[0]) in kept  # all of them are near
    assert [r for r in kept if r[1] not in linked] == sorted(
        [(7, "first text of the id seven"), (7, "quite another one under this id"), (None, "alone without any id at all"),
         (8, "   "), (8, None)], key=str)
    apart = [(None, base), (None, base + " x"), (None, " ".join(f"v{i}" for i in range(60)))]
    assert len(one(spark, frame(spark, [(i, t, *[None] * 6) for i, t in apart]), SF_DIR).collect()) == 2


def test_stages(spark):
    """Every stage on a corpus with nulls, repeats and empties: columns stay, decisions show."""
    docs = frame(spark, corpus(seed=12) + [(3, "again under the same id", "en", "s1", 0, None, None, None)])
    columns = docs.columns
    named, one, cut, mixed, packed = (f for _, f in corpus_pipeline.STAGES)
    spoken = named(spark, docs, SF_DIR)
    assert spoken.columns == columns and all(any(c.isalpha() for c in r.text) for r in spoken.collect())
    single = one(spark, spoken, SF_DIR)
    ids = [r.doc_id for r in single.collect()]
    assert single.columns == columns and len(ids) == len(set(ids)) < spoken.count()
    short = cut(spark, single, SF_DIR)
    assert short.columns == columns and sorted(r.doc_id for r in short.collect()) == sorted(ids)
    assert sum(len(r.text) for r in short.collect()) < sum(len(r.text) for r in single.collect())
    twice = mixed(spark, short, SF_DIR)
    assert twice.columns == columns and max(Counter(r.doc_id for r in twice.collect()).values()) <= 2
    assert packed(spark, twice, SF_DIR).where("start = 0").count() == twice.count()
