"""Document fingerprints by one-permutation MinHash, in Spark SQL only.

Every 5-word shingle is hashed once; the top bits of the hash choose one of ``BINS`` bins and
each bin keeps its smallest hash.  Empty bins are filled by optimal densification: a bin asks
bins given by a hash of (bin, attempt) until one is not empty.  The low ``BITS`` bits of every
bin make the fingerprint; likeness corrects for bits that agree by chance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from watthour.llm.staging import partitions

BINS = 128
BITS = 8
ATTEMPTS = 16  # random ones; then all bins in a cycle of odd step, which finds any
SHIFT = 64 - (BINS.bit_length() - 1)
WORDS = r"[\x20\x09-\x0D]+"


def with_fingerprint(df: DataFrame, text: str, low: str) -> DataFrame:
    """Add ``low``: the low bits of every bin of the text in column ``text`` (array of ints).

    Fewer than five words make one shingle; a text without words has all zeros.  Steps are
    columns of their own, so that lambdas look into arrays that are there already.
    """
    names = df.columns
    df = df.withColumn("__w", F.expr(f"transform(filter(split({text}, '{WORDS}'), w -> w <> ''), w -> xxhash64(w))".replace("\\", "\\\\")))
    df = df.withColumn("__h", F.expr("""CASE
        WHEN size(__w) >= 5 THEN transform(sequence(0, size(__w) - 5),
            i -> xxhash64(get(__w, i), get(__w, i + 1), get(__w, i + 2), get(__w, i + 3), get(__w, i + 4)))
        WHEN size(__w) > 0 THEN array(xxhash64(__w)) ELSE cast(array() AS array<bigint>) END"""))
    df = df.withColumn("__h", F.sort_array("__h"))
    df = df.withColumn("__m", F.expr(
        f"filter(__h, (x, i) -> i = 0 OR shiftrightunsigned(x, {SHIFT}) <> shiftrightunsigned(get(__h, i - 1), {SHIFT}))"))
    df = df.withColumn("__b", F.expr(f"map_from_arrays(transform(__m, x -> cast(shiftrightunsigned(x, {SHIFT}) AS int)), __m)"))
    df = df.withColumn("__b", F.expr(f"transform(sequence(0, {BINS - 1}), i -> try_element_at(__b, i))"))
    df = df.withColumn(low, F.expr(f"""CASE WHEN size(__m) = 0 THEN array_repeat(0, {BINS}) ELSE
        transform(sequence(0, {BINS - 1}), i -> cast(coalesce(
            get(__b, i),
            get(__b, get(filter(transform(sequence(1, {ATTEMPTS}), t -> cast(pmod(xxhash64(i, t), {BINS}) AS int)), j -> get(__b, j) IS NOT NULL), 0)),
            get(__b, get(filter(transform(sequence(1, {BINS - 1}), t -> (i + t * (2 * i + 1)) % {BINS}), j -> get(__b, j) IS NOT NULL), 0))
        ) & {(1 << BITS) - 1} AS int)) END"""))
    return df.select(*names, low)


def packed(low: str) -> Column:
    """The fingerprint: hexadecimal digits of all bins."""
    return F.expr(f"array_join(transform({low}, x -> lpad(lower(hex(x)), {BITS // 4}, '0')), '')")


def likeness(a: str, b: str) -> Column:
    """Estimated similarity of two arrays of low bits, corrected for chance; 1 for equal ones."""
    same = F.expr(f"size(filter(sequence(0, {BINS - 1}), i -> get({a}, i) = get({b}, i)))") / float(BINS)
    chance = 2.0**-BITS
    return F.greatest(F.lit(0.0), (same - chance) / (1 - chance))


def with_next(docs: DataFrame, blocks: int) -> DataFrame:
    """(block, guest, doc_id, version, text): rows by ranges of ids; every block also has, as
    its last row, a guest: the first row of the next block (of the last block: the very first).

    So a window per block sees every row's successor, and no window holds all rows.
    """
    spark = docs.sparkSession
    marks = docs.agg(F.percentile_approx("doc_id", [i / blocks for i in range(1, blocks)], 100 * blocks)).first()[0] if blocks > 1 else []
    bounds = F.array(*(F.lit(m).cast("long") for m in sorted(set(marks or [])))) if marks else F.array().cast("array<bigint>")
    placed = docs.withColumn("bounds", bounds).withColumn("block", F.expr("size(filter(bounds, b -> b < doc_id))")).drop("bounds")
    firsts = sorted((r.block, r.first) for r in placed.groupBy("block").agg(F.min("doc_id").alias("first")).collect())  # ``blocks`` rows at most
    if not firsts:
        return placed.withColumn("guest", F.lit(False))
    before = [(first, firsts[i - 1][0]) for i, (_, first) in enumerate(firsts)]
    guests = docs.where(F.col("doc_id").isin([first for first, _ in before]))
    guests = guests.withColumn("n", F.row_number().over(Window.partitionBy("doc_id").orderBy("version"))).where("n = 1").drop("n")
    where = spark.createDataFrame(before, "doc_id long, block int")
    guests = guests.join(F.broadcast(where), "doc_id")
    return placed.withColumn("guest", F.lit(False)).unionByName(guests.withColumn("guest", F.lit(True)))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of all texts and of their edited forms, and what these are like.

    The edited text replaces the last quarter of the code points by the first as many of the
    next document (ascending id; after the last the first).  Null texts count as empty, a null
    id as the smallest; rows that share an id are ordered by a hash of the text.
    """
    null_id = -(2**63)
    docs = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(null_id)).alias("doc_id"),
        F.coalesce(text_col, F.lit("")).alias("text")).withColumn("version", F.xxhash64("text"))
    rows = with_next(docs, 4 * partitions(docs.sparkSession))
    along = Window.partitionBy("block").orderBy("guest", "doc_id", "version")
    rows = rows.withColumn("next", F.lead("text").over(along)).withColumn("n_chars", F.length("text").cast("long"))
    rows = rows.withColumn("edited", F.expr(
        "concat(left(text, cast(n_chars - n_chars div 4 AS int)), left(coalesce(next, ''), cast(n_chars div 4 AS int)))")).drop("next")
    rows = with_fingerprint(rows, "text", "low").drop("text")
    rows = with_fingerprint(rows, "edited", "edited_low").withColumn("edited_sha256", F.sha2("edited", 256)).drop("edited")
    rows = rows.withColumn("next_low", F.lead("low").over(along)).where("NOT guest")
    return rows.select(
        F.nullif("doc_id", F.lit(null_id)).alias("doc_id"), "n_chars", "edited_sha256",
        packed("low").alias("fingerprint"), packed("edited_low").alias("edited_fingerprint"),
        likeness("low", "edited_low").alias("near_edited"), likeness("low", "next_low").alias("near_next"))
