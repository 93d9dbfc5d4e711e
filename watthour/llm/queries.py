"""The registered queries of this subpackage, one for each operator, and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from watthour.llm.collocations import collocations
from watthour.llm.cover_tree import near_pairs
from watthour.llm.fingerprints import fingerprints
from watthour.llm.language_id import predict, train
from watthour.llm.lm_score import stupid_backoff
from watthour.llm.mixing import mix
from watthour.llm.ngram_join import jaccard_components
from watthour.llm.packing import pack
from watthour.llm.quality import quality_rules
from watthour.llm.rtree import hard_negatives
from watthour.llm.sharding import place
from watthour.llm.suffix_dedup import remove_repeats
from watthour.llm.token_counts import token_counts

SHARDS = [f"shard-{i:03d}" for i in range(64)]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.tiktoken"))


def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return place(table(spark, sf_dir, "documents"), SHARDS)


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stupid_backoff(table(spark, sf_dir, "documents"))


def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_pairs(table(spark, sf_dir, "embeddings"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))
    model = train(docs.where(~held_out), tokenizer("piece_bpe_32k.model"))
    return predict(docs, model, keep={"held_out": held_out})


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).drop("version")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return rules.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.select("vec_id", "embedding", label.alias("label")), F.col("vec_id") % 100 == 0)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_ngram_jaccard_join, op2_packing, op3_suffix_array_dedup, op4_fingerprints, op5_sharding,
    op6_lm_score, op7_embedding_near_dedup, op8_language_id, op9_mixing, op10_token_counts,
    op11_quality_rules, op12_hard_negatives, op13_collocations)}

WORDS_SQL = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
FOLD_SQL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1_SQL = rf"""WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({FOLD_SQL}, '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (SELECT doc_id, list_distinct(CASE WHEN len(w) >= 5
    THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM words),
shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b USING (shingle)
  WHERE a.doc_id <> b.doc_id GROUP BY 1, 2
  HAVING 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))),
reach(doc_id, root) AS (SELECT doc_id, doc_id FROM documents
  UNION SELECT links.b, reach.root FROM reach JOIN links ON links.a = reach.doc_id)
SELECT sets.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id FROM sets
JOIN (SELECT doc_id, min(root) AS component_id FROM reach GROUP BY 1) USING (doc_id)"""

OP7_SQL = """WITH RECURSIVE units AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM units a JOIN units b ON a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.95),
reach(vec_id, root) AS (SELECT vec_id, vec_id FROM units
  UNION SELECT links.b, reach.root FROM reach JOIN links ON links.a = reach.vec_id),
roots AS (SELECT vec_id, min(root) AS component_id FROM reach GROUP BY 1),
counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY 1)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM roots LEFT JOIN counts USING (vec_id)"""

OP12_SQL = """WITH parts AS (
  SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
    list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor(256 * x)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
    CAST(list_dot_product(a.v, r.v) AS BIGINT) AS score
  FROM parts a JOIN parts r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id),
positives AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id AS negative_id,
  positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 10"""

OP13_SQL = rf"""WITH pieces AS (SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array({FOLD_SQL}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY 1),
grams AS (SELECT lang, unnest(flatten(list_transform(range(1, 5), lambda m:
    list_transform(range(1, len(w) - m + 2), lambda i: w[i:i+m-1])))) AS p FROM words),
f AS (SELECT lang, p, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 30),
cuts AS (SELECT lang, p, a, unnest(range(1, len(p))) AS k FROM f WHERE len(p) > 1),
scored AS (SELECT cuts.lang, cuts.p, cuts.a, k, l.a AS l, r.a AS r,
    CAST(2000000 * CAST(cuts.a AS HUGEINT) // (l.a + r.a) AS BIGINT) AS score
  FROM cuts JOIN f l ON l.lang = cuts.lang AND l.p = cuts.p[1:k]
  JOIN f r ON r.lang = cuts.lang AND r.p = cuts.p[k+1:]
  QUALIFY row_number() OVER (PARTITION BY cuts.lang, cuts.p ORDER BY score, k) = 1),
inside AS (SELECT lang, a, unnest(flatten(list_transform(range(2, len(p)), lambda m:
    list_transform(range(1, len(p) - m + 2), lambda i: p[i:i+m-1])))) AS p FROM f WHERE len(p) > 2),
held AS (SELECT lang, p, max(a) AS held FROM inside GROUP BY ALL)
SELECT lang, row_number() OVER w AS rank, array_to_string(p, ' ') AS phrase, a, l, r, n, score
FROM scored LEFT JOIN held USING (lang, p) JOIN totals USING (lang)
WHERE held IS NULL OR 100 * held < 80 * a
WINDOW w AS (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' '))
QUALIFY row_number() OVER w <= 2000"""

ORACLES = {"op1_ngram_jaccard_join": OP1_SQL, "op7_embedding_near_dedup": OP7_SQL,
           "op12_hard_negatives": OP12_SQL, "op13_collocations": OP13_SQL}
