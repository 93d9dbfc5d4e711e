"""From raw documents to packed sequences: five stages, each over all that the one before kept.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and gives a
DataFrame, which ``run`` writes as Parquet and rereads as the next one's ``docs``.  All but the
last give the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from watthour.llm.language_id import UNKNOWN, predict, train
from watthour.llm.mixing import mix, repeat_documents
from watthour.llm.ngram_join import jaccard_components
from watthour.llm.packing import pack
from watthour.llm.queries import table, tokenizer
from watthour.llm.staging import stage
from watthour.llm.suffix_dedup import remove_repeats

ORACLE_SQL = None  # no stage but the join can be said in SQL


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no language is found (null text, no letters) go; all others stay.

    Without any label there is no language to find, and texts with letters stay.
    """
    model = train(docs, tokenizer("piece_bpe_32k.model"))
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    named = predict(docs, model, keep={f"c{i}": F.col(c) for i, c in enumerate(docs.columns)})
    return named.where(F.col("lang_pred") != UNKNOWN).select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents connected by similarity one row stays: the smallest id, then the smallest hash of the text.

    Null ids come last.  Rows are told apart by id and text, so unlinked rows that share an
    id all stay; rows equal in both are one group.  Texts without words link with nothing and stay.
    """
    names = docs.columns
    key = ["__null", "__id", "__version"]
    keyed = lambda df, version: df.withColumns({
        "__null": F.col("doc_id").isNull(), "__id": F.coalesce("doc_id", F.lit(0)).cast("long"), "__version": version})
    found = keyed(jaccard_components(docs, keys=True).where("component IS NOT NULL"), F.col("version"))
    kept = found.groupBy("component").agg(F.min(F.struct(*key)).alias("row")).select("row.*")
    nth = F.row_number().over(Window.partitionBy(*key).orderBy(F.xxhash64(*names)))
    worded = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    rows = keyed(docs.where(worded), F.xxhash64("text")).join(kept, key, "left_semi")
    return rows.withColumn("__nth", nth).where("__nth = 1").select(*names).unionByName(docs.where(~worded))


def remove_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of 100-byte strings that start earlier too; every row stays."""
    rest = remove_repeats(docs, carry=[c for c in docs.columns if c not in ("doc_id", "text")], as_text=True).withColumnRenamed("kept", "text")
    fresh = {"doc_id": F.col("doc_id"), "text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return rest.select(*(fresh.get(c, F.col("carried")[c]).alias(c) for c in docs.columns))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it: not at all, once or twice."""
    return repeat_documents(docs, mix(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences; a document taken twice has two rows for each piece."""
    return pack(docs, tokenizer("byte_bpe_50k.tiktoken"))


STAGES = [
    ("language ID", identify_language),
    ("n-gram Jaccard join", keep_one_of_each_group),
    ("suffix-array dedup", remove_repeated_strings),
    ("mixing sources to target weights", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
