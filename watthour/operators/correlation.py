"""Correlation over numeric columns, from sums of products in blocks of columns.

Every task turns its rows into matrices and adds up, for each pair of blocks of ``block``
columns, the sums that Pearson's r of all their pairs needs; these arrays are merged in two
steps, so that no group grows with the number of tasks, and r comes out in long form.  The
plan has one shape for every number of columns.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watthour.functions.stats import correlation, nan_to_null

BLOCK = 64  # columns in a block
SHARES = 256  # groups of tasks that are merged first

# fixed values: pairs above this are reported
HIGH_CORRELATION = 0.8


def _sums(x: np.ndarray, seen: np.ndarray, block: int) -> dict[tuple[int, int], np.ndarray]:
    """By pair of blocks: n, sums of both sides, of their squares and of products over common rows."""
    starts = range(0, x.shape[1], block)
    square, seen = x * x, seen.astype(np.float64)
    out = {}
    for i in starts:
        for j in starts:
            if i <= j:
                a, b = slice(i, i + block), slice(j, j + block)
                out[i, j] = np.stack([seen[:, a].T @ seen[:, b], x[:, a].T @ seen[:, b], seen[:, a].T @ x[:, b],
                                      square[:, a].T @ seen[:, b], seen[:, a].T @ square[:, b], x[:, a].T @ x[:, b]])
    return out


def pearson(sums: np.ndarray) -> np.ndarray:
    """r of every pair of two blocks; NaN without common rows or where a side does not vary."""
    n, sa, sb, qa, qb, p = sums
    with np.errstate(divide="ignore", invalid="ignore"):
        va, vb = qa - sa * sa / n, qb - sb * sb / n
        r = (p - sa * sb / n) / np.sqrt(va * vb)
    # a side that is constant in the common rows has only rounding left
    return np.where((n > 0) & (va > 1e-12 * qa) & (vb > 1e-12 * qb), np.clip(r, -1, 1), np.nan)


GRAM = "i int, j int, share int, sums binary"


def _tallied(low: list[float], complete: bool, block: int):
    width = len(low)

    def run(batches):
        held: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            column = batch.column("x")
            x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)
            seen = ~np.isnan(x)
            if complete and not seen.all():
                raise ValueError("missing values in a complete frame")
            # from each column's smallest value on: r is the same, and a constant is 0
            for at, sums in _sums(np.where(seen, x - np.array(low), 0.0), seen, block).items():
                held[at] = held[at] + sums if at in held else sums
            share = batch.column("share")[0].as_py() if len(batch) else 0
        if held:
            rows = [(i, j, share, sums.tobytes()) for (i, j), sums in held.items()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.int32(), pa.binary()))],
                                             names=["i", "j", "share", "sums"])
    return run


def _added(table: pa.Table) -> np.ndarray:
    return sum(np.frombuffer(b) for b in table.column("sums").to_pylist())


def _merged(table: pa.Table) -> pa.Table:
    first = table.slice(0, 1)
    return pa.table({"i": first.column("i"), "j": first.column("j"), "share": first.column("share"), "sums": [_added(table).tobytes()]})


def _named(columns: list[str], full: bool, block: int):
    """Cells of a pair of blocks by name: i < j, or both halves and the diagonal."""
    names, width = np.array(columns, dtype=object), len(columns)

    def run(table: pa.Table) -> pa.Table:
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        sums = _added(table).reshape(6, min(block, width - i), min(block, width - j))
        r = pearson(sums)
        a, b = (x.reshape(-1) for x in np.meshgrid(np.arange(i, i + r.shape[0]), np.arange(j, j + r.shape[1]), indexing="ij"))
        r = r.reshape(-1)
        r[(a == b) & ~np.isnan(r)] = 1.0
        upper = a < b
        parts = [(a[upper], b[upper], r[upper])]
        if full:
            parts += [(b[upper], a[upper], r[upper]), (a[a == b], b[a == b], r[a == b])]
        a, b, r = (np.concatenate(c) for c in zip(*parts))
        return pa.table({"feature_1": pa.array(names[a], pa.string()), "feature_2": pa.array(names[b], pa.string()), "correlation": pa.array(r, mask=np.isnan(r))})
    return run


def _cells(df: DataFrame, columns: Sequence[str], full: bool, complete: bool, block: int) -> DataFrame:
    columns = list(columns)
    if len(columns) < 2:
        raise ValueError("correlation needs at least two numeric columns")
    values = df.select(F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in columns]).alias("x"))
    least = df.agg(*[F.min(nan_to_null(F.col(c).cast("double"))).alias(f"_{i}") for i, c in enumerate(columns)]).first()
    low = [0.0 if v is None or not np.isfinite(v) else v for v in least]
    tallied = values.withColumn("share", F.pmod(F.spark_partition_id(), F.lit(SHARES))).mapInArrow(_tallied(low, complete, block), GRAM)
    merged = tallied.groupBy("i", "j", "share").applyInArrow(_merged, GRAM)
    return merged.groupBy("i", "j").applyInArrow(_named(columns, full, block), "feature_1 string, feature_2 string, correlation double")


def correlation_pairs(df: DataFrame, columns: Sequence[str], complete: bool = False, block: int = BLOCK) -> DataFrame:
    """(feature_1, feature_2, correlation) for every pair, each in column order.

    A pair uses the rows where both are present.  ``complete`` says that no value is
    missing, as in a training frame: deviations are then taken once per column.  It is checked
    in the same pass, and a missing value raises.
    """
    return _cells(df, columns, False, complete, block)


def correlation_matrix(df: DataFrame, columns: Sequence[str], complete: bool = False, block: int = BLOCK) -> DataFrame:
    """Every cell of the matrix, both halves and the diagonal, in long form."""
    return _cells(df, columns, True, complete, block)


def high_pairs(pairs: DataFrame, threshold: float = HIGH_CORRELATION) -> DataFrame:
    return pairs.where(F.abs("correlation") > threshold).select("feature_1", "feature_2", "correlation")


def correlation_summary(matrix: DataFrame, threshold: float = HIGH_CORRELATION) -> DataFrame:
    """Column count, high pairs, and the mean absolute r over all cells (0 if any is NULL)."""
    r = F.abs("correlation")
    once = F.col("feature_1") < F.col("feature_2")
    return matrix.agg(
        F.count_distinct("feature_1").alias("numeric_features_count"),
        F.count_if(once & (r > threshold)).alias("high_correlation_count"),
        F.when(F.count_if(r.isNull()) > 0, 0.0).otherwise(F.avg(r)).alias("average_absolute_correlation"),
    )


def correlation_report(df: DataFrame, columns: Sequence[str], threshold: float = HIGH_CORRELATION) -> DataFrame:
    """The summary with a status; below two columns there is no correlation, and a reason."""
    if len(columns) >= 2:
        return correlation_summary(correlation_matrix(df, columns), threshold).withColumns({
            "correlation_computed": F.lit(True), "reason": F.lit(None).cast("string")})
    return df.sparkSession.range(1).select(
        F.lit(len(columns)).cast("long").alias("numeric_features_count"),
        F.lit(None).cast("long").alias("high_correlation_count"),
        F.lit(None).cast("double").alias("average_absolute_correlation"),
        F.lit(False).alias("correlation_computed"), F.lit("insufficient_numeric_features").alias("reason"))


def correlation_with(df: DataFrame, target: str, columns: Sequence[str]) -> DataFrame:
    """r of one column with each of the others."""
    y = nan_to_null(F.col(target).cast("double"))
    one = df.agg(*[
        correlation(y, nan_to_null(F.col(c).cast("double"))).alias(f"_r{i}") for i, c in enumerate(columns)
    ])
    return one.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"_r{i}").alias("correlation")) for i, c in enumerate(columns)
    ])).alias("p")).select("p.*")
