"""Mixing sources to target weights by pivotal dependent rounding, in Spark SQL only.

Every document of a source starts with the same expected number of copies, target / size of
the source.  The whole part is certain; fractions are rounded in pairs: words move from one
document of a pair to the other until one fraction is 0 or 1, up or down at random so that
every expectation is kept.  The words of a pair never change, so a source's total stays at its
target until a single fraction is left.  Pairs are fought within cells of some ``CELL``
documents (a fold over the cell's array); what is left of a cell goes on to the next level,
where ``CELL`` cells meet: a reduction tree whose nodes are all small, however large the
source.  Random numbers are hashes of the documents, so reruns agree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from watthour.llm.staging import stage

CELL = 256
NEAR = 1e-9  # fractions this close to 0 or 1 are whole
WORDS = r"[^\x20\x09-\x0D]+"


def source_targets(sources: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """(source, source_size, target) from (source, source_size): one row per source.

    Sources in code point order, null last, weigh ``weights`` repeating and share ``share`` of
    all sizes; no target is above ``cap`` times its source, the excess goes to the others by
    weight.  With sources ordered by cap / weight, those that reach their cap come first, and
    the level of the rest is the largest that any prefix leaves.
    """
    everything = Window.partitionBy()
    order = Window.orderBy(F.col("source").asc_nulls_last())
    parts = F.array(*(F.lit(float(w)) for w in weights))
    weighed = sources.withColumn("weight", F.get(parts, (F.row_number().over(order) - 1) % len(weights)))
    weighed = weighed.withColumn("most", F.col("source_size") * cap)
    by_cap = Window.orderBy((F.col("most") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    left = share * F.sum("source_size").over(everything) - (F.sum("most").over(by_cap.rowsBetween(Window.unboundedPreceding, 0)) - F.col("most"))
    level = left / F.sum("weight").over(by_cap.rowsBetween(0, Window.unboundedFollowing))
    return weighed.withColumn("level", level).withColumn("level", F.max("level").over(everything)).select(
        "source", "source_size", F.least("most", F.col("level") * F.col("weight")).alias("target"))


def _fold(level: int, seed: int) -> Column:
    """Fights along a cell's array; gives what is left over and the rounded units."""
    unit = "struct<size: bigint, doc_id: bigint, version: bigint, p: double>"
    return F.expr(f"""aggregate(units,
      named_struct('left', cast(null as {unit}), 'done', cast(array() as array<{unit}>)),
      (acc, x) -> CASE WHEN acc.left IS NULL THEN named_struct('left', x, 'done', acc.done) ELSE
        element_at(transform(array(named_struct(
            'up', least((1 - acc.left.p) * acc.left.size, x.p * x.size),
            'down', least(acc.left.p * acc.left.size, (1 - x.p) * x.size),
            'chance', pmod(xxhash64({seed}L, {level}, acc.left.doc_id, acc.left.version, x.doc_id, x.version), 9007199254740992L) / 9007199254740992D)),
          v -> element_at(transform(array(CASE WHEN v.chance * (v.up + v.down) < v.down THEN v.up ELSE -v.down END),
          move -> element_at(transform(array(named_struct(
              'a', named_struct('size', acc.left.size, 'doc_id', acc.left.doc_id, 'version', acc.left.version, 'p', acc.left.p + move / acc.left.size),
              'b', named_struct('size', x.size, 'doc_id', x.doc_id, 'version', x.version, 'p', x.p - move / x.size))),
            y -> CASE
              WHEN y.a.p < {NEAR} OR y.a.p > 1 - {NEAR} THEN named_struct('left', y.b, 'done', array_append(acc.done, y.a))
              ELSE named_struct('left', y.a, 'done', array_append(acc.done, y.b)) END), 1)), 1)), 1) END)""")


def mix(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, seed: int = 17,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, size, source_size, target, taken, source, version, copies) for every row.

    ``size`` is the number of words (null text: 0), ``copies`` 0, 1 or 2, ``taken`` = size *
    copies.  Documents without words take no part in rounding and keep the whole part.  Null
    is a source of its own.  ``version`` is a hash of the text; rows that share id and text
    are rounded as documents of their own.  An empty table gives an empty one.
    """
    sizes = stage(docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).alias("source"),
        F.xxhash64(text_col).alias("version"),
        F.coalesce(F.regexp_count(text_col, F.lit(WORDS)), F.lit(0)).cast("long").alias("size")), "sizes")
    per_source = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.sum((F.col("size") > 0).cast("long")).alias("units"))
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    targets = source_targets(per_source.select("source", "source_size"), weights, share)
    sources = stage(targets.join(per_source.select(F.col("source").alias("same"), "units"), F.col("source").eqNullSafe(F.col("same"))).drop("same").withColumn(
        "whole", F.floor(expected + NEAR)).withColumn("p", F.greatest(expected - F.col("whole"), F.lit(0.0))).withColumn(
        "cells", F.ceil(F.col("units") / CELL)), "sources")
    known = sources.withColumnRenamed("source", "same")
    rows = sizes.join(known, F.col("source").eqNullSafe(F.col("same"))).drop("same")
    rounded = (F.col("p") > NEAR) & (F.col("size") > 0)
    columns = ["source", "doc_id", "version", "size", "up"]
    done = [rows.where(~rounded).select(*columns[:-1], F.lit(0).cast("long").alias("up"))]
    cell = F.pmod(F.xxhash64("doc_id", "version", "size"), "cells")
    now = rows.where(rounded).select("source", "cells", cell.alias("cell"), "size", "doc_id", "version", "p")
    most = sources.agg(F.max("cells")).first()[0] or 0
    level = 0
    while True:
        cells = now.groupBy("source", "cells", "cell").agg(
            F.array_sort(F.collect_list(F.struct("size", "doc_id", "version", "p"))).alias("units"))
        fought = stage(cells.select("source", "cells", "cell", _fold(level, seed).alias("r")).select("source", "cells", "cell", "r.*"), "rounds")
        part = fought.select("source", F.explode("done").alias("u"))
        done.append(part.select("source", "u.doc_id", "u.version", "u.size", F.round("u.p").cast("long").alias("up")))
        if most <= 1:
            break
        most = -(-most // CELL)
        level += 1
        now = fought.select("source", F.ceil(F.col("cells") / CELL).alias("cells"), "cell", "left.*").withColumn(
            "cell", F.pmod("cell", "cells")).select("source", "cells", "cell", "size", "doc_id", "version", "p")
    coin = F.pmod(F.xxhash64(F.lit(seed), F.lit(-1), "left.doc_id", "left.version"), F.lit(2**53)) / F.lit(float(2**53))
    done.append(fought.select("source", "left.doc_id", "left.version", "left.size", (coin < F.col("left.p")).cast("long").alias("up")))
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    out = out.join(known, F.col("source").eqNullSafe(F.col("same")))
    copies = (F.col("whole") + F.col("up")).cast("long")
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * copies).alias("taken"), "source", "version", copies.alias("copies"))


def repeat_documents(docs: DataFrame, copies: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` as often as ``mix`` says, with their own columns only."""
    names = docs.columns
    lists = copies.groupBy(F.col("doc_id").alias("__id"), F.col("version").alias("__version")).agg(F.collect_list("copies").alias("__copies"))
    keyed = docs.withColumn("__version0", F.xxhash64(text_col))
    nth = F.row_number().over(Window.partitionBy(id_col, "__version0").orderBy(id_col))
    keyed = keyed.withColumn("__nth", nth)
    joined = keyed.join(lists, F.col(id_col).cast("long").eqNullSafe(F.col("__id")) & (F.col("__version0") == F.col("__version")))
    times = F.get("__copies", F.col("__nth") - 1)
    return joined.where(times > 0).select(*names, F.explode(F.sequence(F.lit(1).cast("long"), times)).alias("__time")).select(*names)
