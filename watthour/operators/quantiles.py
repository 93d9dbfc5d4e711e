"""Exact percentiles without sorting a group in one task.

A sketch gives, for each wanted percentile, two values that enclose it up to one
neighbour.  Rows between those brackets are only counted, with the smallest and the
largest value of each gap, which are the neighbours; the few inside one are tallied by
value and cut by a second sketch into slots of about as many values each, and only the
slots that hold the wanted ranks are sorted.  The rows are read twice, and what is
shuffled is the bracket contents, whatever the distribution of values or the size of a
group.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SKETCH_ACCURACY = 10_000
# the sketch is off by at most 1/accuracy of the rows in rank; brackets allow three times that
SLACK = 3 / SKETCH_ACCURACY
SLOTS = 256


def exact_percentiles(rows: DataFrame, by: Sequence[str], value: str, probs: dict[str, float],
                      also: dict[str, Column] | None = None) -> DataFrame:
    """Linear-interpolated percentiles per group, one column per entry of ``probs``.

    ``by`` must name columns with few values, such as a feature name or a horizon: the
    table of brackets is broadcast.  ``also`` adds numeric aggregates to the sketch's
    pass over the rows.  Groups without a value are absent.
    """
    also = also or {}
    wanted = list(enumerate(probs.values()))
    data = rows.withColumn("_v", F.col(value).cast("double"))
    marks = [m for _, p in wanted for m in (max(p - SLACK, 0.0), min(p + SLACK, 1.0))]
    sketch = data.groupBy(*by).agg(
        F.min("_v").alias("_min"), F.max("_v").alias("_max"),
        F.percentile_approx("_v", marks, SKETCH_ACCURACY).alias("_marks"),
        *[c.alias(name) for name, c in also.items()],
    )
    low = [F.col("_min") if p <= SLACK else F.col("_marks")[2 * i] for i, p in wanted]
    high = [F.col("_max") if p >= 1 - SLACK else F.col("_marks")[2 * i + 1] for i, p in wanted]
    sketch = sketch.select(
        *by, *also, *[c.alias(f"_lo{i}") for i, c in enumerate(low)], *[c.alias(f"_hi{i}") for i, c in enumerate(high)])
    v = F.col("_v")
    inside = [v.between(F.col(f"_lo{i}"), F.col(f"_hi{i}")) for i, _ in wanted]
    # rises with v and is the same for two values only if no bracket edge lies between them
    zone = sum(((v >= F.col(f"_lo{i}")).cast("int") + (v > F.col(f"_hi{i}")).cast("int") for i, _ in wanted), F.lit(0))

    tally = data.select(*by, "_v").where(v.isNotNull()).join(F.broadcast(sketch), list(by)).select(
        *by, *also, zone.alias("_zone"), v.alias("_any"), F.when(reduce(or_, inside), v).alias("_v"),
    ).groupBy(*by, "_zone", "_v").agg(
        F.count("*").alias("_c"), F.min("_any").alias("_least"), F.max("_any").alias("_most"),
        *[F.max(name).alias(name) for name in also])
    cuts = tally.groupBy(*by, "_zone").agg(
        F.percentile_approx("_v", [i / SLOTS for i in range(1, SLOTS)], SKETCH_ACCURACY).alias("_cuts"))
    tally = tally.join(F.broadcast(cuts), [*by, "_zone"]).withColumn(
        "_slot", F.coalesce(F.size(F.filter("_cuts", lambda cut: cut <= v)), F.lit(-1))).drop("_cuts")

    counts = tally.groupBy(*by, "_zone", "_slot").agg(F.sum("_c").alias("_in"))
    group = Window.partitionBy(*by)
    total = F.sum("_in").over(group)
    upto = F.sum("_in").over(group.orderBy("_zone", "_slot"))

    def rank(p: float) -> Column:
        return F.floor(F.lit(p) * (F.col("_n") - 1)).cast("long")

    def top(p: float) -> Column:
        return F.least(rank(p) + 1, F.col("_n") - 1)

    holds = [(F.col("_start") <= top(p)) & (F.col("_start") + F.col("_in") > rank(p)) for _, p in wanted]
    holding = (
        counts.withColumns({"_n": total, "_start": upto - F.col("_in")})
        .where(reduce(or_, holds))
        .select(*by, "_zone", "_slot", "_n", "_start")
    )
    last = tally.join(F.broadcast(holding), [*by, "_zone", "_slot"])
    within = Window.partitionBy(*by, "_zone", "_slot").orderBy("_v")
    placed = last.withColumn("_upto", F.col("_start") + F.sum("_c").over(within))

    def at(place: Column) -> Column:
        # of a gap only the first and the last value are known
        first, last = F.col("_upto") - F.col("_c"), F.col("_upto") - 1
        known = F.coalesce(v, F.when(place == first, F.col("_least")), F.when(place == last, F.col("_most")))
        return F.max(F.when((last >= place) & (first <= place), known))

    ends = placed.groupBy(*by).agg(
        F.max("_n").alias("_n"), *[F.max(name).alias(name) for name in also],
        *[at(rank(p)).alias(f"_low{i}") for i, p in wanted], *[at(top(p)).alias(f"_high{i}") for i, p in wanted],
    )

    def between(i: int, p: float) -> Column:
        place = F.lit(p) * (F.col("_n") - 1)
        low, high = F.col(f"_low{i}"), F.col(f"_high{i}")
        exact = low + (high - low) * (place - F.floor(place))
        return F.coalesce(exact, F.raise_error(F.lit("percentile outside its bracket")).cast("double"))

    return ends.select(*by, *also, *[between(i, p).alias(name) for i, (name, p) in enumerate(probs.items())])
