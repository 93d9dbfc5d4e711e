"""Readings to hourly series, and reports on a series' regularity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from watthour.functions.frames import join_on
from watthour.functions.stats import nan_to_null, seconds_between, whole_days
from watthour.operators.blocks import over_rows
from watthour.schemas import TS, VALUE

HOUR_SECONDS = 3600.0
# fixed values: tolerance of the frequency check and length of the gap list
FREQUENCY_TOLERANCE_SECONDS = 60.0
GAP_LOCATIONS = 10


def hourly_mean(readings: DataFrame, ts: str = TS, value: str = VALUE,
                keys: Sequence[str] = (), every: str = "1 hour") -> DataFrame:
    """Mean per left-closed, left-labelled hour; hours without a value are absent.

    The partial aggregate leaves one row per task, key and hour before the shuffle,
    so a key with most of the readings costs no more than the others.
    """
    labelled = readings.select(
        *keys, F.window(ts, every)["start"].alias(ts), nan_to_null(F.col(value)).alias(value)
    )
    means = labelled.groupBy(*keys, ts).agg(F.avg(value).alias(value))
    return means.where(F.col(value).isNotNull())


def hour_grid(start, end) -> "F.Column":
    """Array of hourly timestamps from start to end, both included."""
    return F.sequence(start, end, F.expr("INTERVAL 1 HOUR"))


def hourly_calendar(df: DataFrame, start: str, steps: int = 24, name: str = TS) -> DataFrame:
    """``steps`` hourly timestamps from the ``start`` column of each row."""
    last = F.col(start) + F.expr(f"INTERVAL {steps - 1} HOURS")
    return df.withColumn(name, F.explode(hour_grid(F.col(start), last)))


def fill_hours(hourly: DataFrame, ts: str = TS, keys: Sequence[str] = ()) -> DataFrame:
    """Add the missing hours of each series with NULL values: lags go by clock then.

    Hours are laid out month by month, and months are dealt out to tasks: no array is longer than
    a month has hours, or the span has months, and a long or keyless series is made by many tasks.
    """
    tasks = int(hourly.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    span = hourly.groupBy(*keys).agg(F.min(ts).alias("_lo"), F.max(ts).alias("_hi"))
    month = F.date_trunc("month", "_lo").cast("timestamp_ntz")
    months = span.select(*keys, "_lo", "_hi", F.explode(
        F.sequence(month, F.col("_hi"), F.expr("INTERVAL 1 MONTH"))).alias("_month")).repartition(tasks, *keys, "_month")
    first = F.greatest("_lo", "_month")
    last = F.least(F.col("_hi"), F.col("_month") + F.expr("INTERVAL 1 MONTH") - F.expr("INTERVAL 1 HOUR"))
    grid = months.select(*keys, F.explode(hour_grid(first, last)).alias(ts))
    return join_on(grid, hourly, [*keys, ts], "left")


def load_summary(readings: DataFrame, hourly: DataFrame, weather: DataFrame | None = None,
                 ts: str = TS, keys: Sequence[str] = ()) -> DataFrame:
    """Record counts before and after resampling, time range, whole days, weather rows.

    Three aggregates tagged by column and combined by one more: no frame is joined.
    """
    none = F.lit(None)

    def part(df: DataFrame, by: Sequence[str], raw, kept, seen, lo, hi) -> DataFrame:
        cols = (raw.cast("long").alias("raw"), kept.cast("long").alias("kept"),
                seen.cast("long").alias("seen"), lo.cast("timestamp_ntz").alias("lo"),
                hi.cast("timestamp_ntz").alias("hi"))
        return df.groupBy(*by).agg(*cols)

    rows = F.count("*")
    parts = part(readings, keys, rows, none, none, none, none).unionByName(
        part(hourly, keys, none, rows, none, F.min(ts), F.max(ts)))
    if weather is not None:
        parts = parts.unionByName(part(weather, keys, none, none, rows, none, none))
    return parts.groupBy(*keys).agg(
        F.coalesce(F.max("raw"), F.lit(0)).alias("generation_records"),
        F.coalesce(F.max("kept"), F.lit(0)).alias("processed_records"),
        F.min("lo").alias("start"),
        F.max("hi").alias("end"),
        whole_days(F.min("lo"), F.max("hi")).alias("total_days"),
        F.coalesce(F.max("seen"), F.lit(0)).alias("weather_records"),
        F.lit(weather is not None).alias("weather_available"),
    )


def with_step_seconds(hourly: DataFrame, ts: str = TS, keys: Sequence[str] = (),
                      name: str = "step_seconds", position: str | None = None) -> DataFrame:
    """Seconds since the previous row of the series; NULL on the first."""
    return over_rows(
        hourly.select(*keys, ts), lambda w: {name: seconds_between(F.lag(ts).over(w), F.col(ts))},
        ts=ts, keys=keys, behind=1, position=position,
    )


def gap_report(hourly: DataFrame, ts: str = TS, keys: Sequence[str] = (),
               expected_seconds: float = HOUR_SECONDS) -> DataFrame:
    """Per series: number of gaps, longest gap in hours, positions of the first ten."""
    steps = with_step_seconds(hourly, ts, keys, position="position")
    gap = F.col("step_seconds") > expected_seconds
    summary = steps.groupBy(*keys).agg(
        F.count_if(gap).alias("total_gaps"),
        F.coalesce(F.max(F.when(gap, F.col("step_seconds"))) / HOUR_SECONDS, F.lit(0.0)).alias("max_gap_hours"),
    )
    first = Window.partitionBy(*keys).orderBy("position")
    located = (
        steps.where(gap)
        .withColumn("_n", F.row_number().over(first))
        .where(F.col("_n") <= GAP_LOCATIONS)
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_list("position")).alias("gap_locations"))
    )
    if not keys:
        summary, located = (d.withColumn("_one", F.lit(1)) for d in (summary, located))
    joined = join_on(summary, located, keys or ["_one"], "left").drop("_one")
    empty = F.array().cast("array<bigint>")
    return joined.withColumn("gap_locations", F.coalesce("gap_locations", empty))


def frequency_check(hourly: DataFrame, ts: str = TS, keys: Sequence[str] = (),
                    expected_seconds: float = HOUR_SECONDS) -> DataFrame:
    """Per series: most common step (smallest on a tie) within a minute of the expected one."""
    steps = with_step_seconds(hourly, ts, keys)
    tally = steps.groupBy(*keys, "step_seconds").agg(F.count("*").alias("_n"))
    best = F.min(F.when(F.col("step_seconds").isNotNull(), F.struct((-F.col("_n")).alias("n"), F.col("step_seconds").alias("s"))))
    modal = tally.groupBy(*keys).agg(F.sum("_n").alias("records"), best.alias("_best"))
    off = F.abs(F.col("_best.s") - expected_seconds)
    return modal.select(
        *keys, "records", F.col("_best.s").alias("modal_step_seconds"),
        F.coalesce(off < FREQUENCY_TOLERANCE_SECONDS, F.lit(True)).alias("frequency_consistent"),
    )


def order_check(readings: DataFrame, ts: str, seq: str, keys: Sequence[str] = (),
                width: int = 1_000_000) -> DataFrame:
    """Per series: does time never step back along the ingest order ``seq``?

    Raw rows are compared inside blocks of ``width`` consecutive sequence numbers; the
    seams between blocks are compared on one (first, last) pair per block.
    """
    block = F.floor(F.col(seq) / width)
    rows = readings.select(*keys, ts, seq, block.alias("_block"))
    by = [*keys, "_block"]
    inner = Window.partitionBy(*by).orderBy(seq)
    within = (
        rows.withColumn("_back", F.lag(ts).over(inner) > F.col(ts))
        .groupBy(*by)
        .agg(
            F.count("*").alias("records"),
            F.count_if("_back").alias("_inside"),
            F.min_by(ts, seq).alias("_first"),
            F.max_by(ts, seq).alias("_last"),
        )
    )
    outer = Window.partitionBy(*keys).orderBy("_block")
    seams = within.withColumn("_seam", (F.lag("_last").over(outer) > F.col("_first")).cast("long"))
    return seams.groupBy(*keys).agg(
        F.sum("records").alias("records"),
        (F.sum("_inside") + F.coalesce(F.sum("_seam"), F.lit(0))).alias("steps_back"),
    ).withColumn("is_sorted", F.col("steps_back") == 0)
