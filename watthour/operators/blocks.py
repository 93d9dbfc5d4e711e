"""Row-positional windows that never put a whole long series into one task.

``lag``, ``lead`` and rolling frames count rows, so a plain window needs a whole
series in one partition.  With ``keys`` that is fine for hourly series: one row per
(key, hour) after aggregation, about 8 766 a year, however hot the key was in the
readings.  Without keys it would be one task for everything.  Here rows get their
position from monthly counts, positions are cut into blocks, and each block also
receives the few rows before and after it that its frames can reach.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from watthour.functions.frames import join_on

# with the usual halo of some 770 rows a block still fits the 4096 rows that Spark's
# window operator keeps in memory
BLOCK_ROWS = 3072
SCRATCH = "_s_"

Stage = Callable[[WindowSpec], dict[str, Column]]


def with_positions(df: DataFrame, ts: str, keys: Sequence[str] = (), *,
                   position: str = "_pos", total: str = "_total") -> DataFrame:
    """Add each row's 0-based place in its series and the series length.

    Ranks are taken inside (keys, month); the offset of a month is the sum of the
    counts before it, a table of one row per key and month.
    """
    month = F.year(ts) * 12 + F.month(ts)
    cells = df.withColumn("_cell", month)
    by = [*keys, "_cell"]
    counts = cells.groupBy(*by).agg(F.count("*").alias("_rows"))
    series = Window.partitionBy(*keys)
    earlier = series.orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *by,
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"),
        F.sum("_rows").over(series).alias(total),
    )
    ranked = cells.withColumn("_rank", F.row_number().over(Window.partitionBy(*by).orderBy(ts)))
    placed = join_on(ranked, offsets, by)
    return placed.withColumn(position, F.col("_start") + F.col("_rank") - 1).drop("_cell", "_start", "_rank")


def _in_stages(df: DataFrame, window: WindowSpec, stages: Sequence[Stage]) -> DataFrame:
    for stage in stages:
        df = df.withColumns(stage(window))
    return df.drop(*[c for c in df.columns if c.startswith(SCRATCH)])


def over_rows(df: DataFrame, *stages: Stage, ts: str, keys: Sequence[str] = (), behind: int = 0,
              ahead: int = 0, block_rows: int | None = None, position: str | None = None) -> DataFrame:
    """Add the columns of each ``stage(window)`` over the series in time order.

    Stages run one after another over the same sort; columns whose names start with
    ``SCRATCH`` only pass from one to the next.  ``behind`` and ``ahead`` are the farthest
    rows the stages reach together.  With keys and no ``block_rows`` a plain window per
    key is used (one shuffle); otherwise blocks.  ``position`` names a column to keep
    each row's place in its series.
    """
    if keys and block_rows is None:
        window = Window.partitionBy(*keys).orderBy(ts)
        if position:
            df = df.withColumn(position, (F.row_number().over(window) - 1).cast("long"))
        return _in_stages(df, window, stages)
    size = max(block_rows or BLOCK_ROWS, 1)
    placed = with_positions(df, ts, keys)
    place, total = F.col("_pos"), F.col("_total")
    first = F.floor(F.greatest(place - ahead, F.lit(0)) / size)
    last = F.floor(F.least(place + behind, total - 1) / size)
    spread = placed.withColumn("_block", F.explode(F.sequence(first, last)))
    window = Window.partitionBy(*keys, "_block").orderBy("_pos")
    own = F.col("_block") == F.floor(place / size)
    done = _in_stages(spread, window, stages).where(own).drop("_total", "_block")
    return done.withColumnRenamed("_pos", position) if position else done.drop("_pos")
