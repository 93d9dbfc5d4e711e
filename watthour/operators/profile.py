"""Column profiles, target statistics, outliers, quality roll-up and histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from watthour.functions.frames import to_long
from watthour.functions.stats import adjusted_kurtosis, adjusted_skewness, percent
from watthour.operators.quantiles import exact_percentiles

# fixed values: outlier fence in units of iqr, and the share of outliers worth reporting
FENCE = 1.5
OUTLIER_ALERT_PERCENT = 5.0

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}
NUMERIC_FIELDS = ("mean", "median", "std", "variance", "min", "max", "range", "q1", "q3", "iqr",
                  "skewness", "kurtosis")
DRIFT_FIELDS = ("mean", "std", "min", "max", "q1", "q3", "median")


def numeric_columns(df: DataFrame) -> list[str]:
    kinds = (T.NumericType, T.BooleanType)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


# fixed values: what a column without any row has
TEMPLATE = {"dtype": "unknown", "count": 0, "missing_count": 0, "missing_percentage": 100.0, "unique_values": 0,
            "is_constant": True, "outlier_count": 0, "outlier_percentage": 0.0}


def _every(df: DataFrame, columns: Sequence[str], profile: DataFrame) -> DataFrame:
    """A profile row for every column, also of a frame without rows."""
    names = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c) for c in columns])).alias("feature"))
    return names.join(profile, "feature", "left").withColumns(
        {c: F.coalesce(c, F.lit(x)) for c, x in TEMPLATE.items()}).select(*profile.columns)


def _dtype(df: DataFrame, columns: Sequence[str]) -> Column:
    names = F.create_map(*[F.lit(x) for c in columns for x in (c, df.schema[c].dataType.simpleString())])
    return names[F.col("feature")]


def _tally(long: DataFrame) -> DataFrame:
    """(feature, value, c): the one full shuffle of a profile, keyed by value so that a
    feature is spread over all tasks.  NULL keeps its own row."""
    return long.groupBy("feature", "value").agg(F.count("*").alias("c"))


def _base(tally: DataFrame, **extra: Column) -> DataFrame:
    """Fields every type has, and the count of the commonest value; a column without
    values gets the fixed empty template."""
    here = F.col("value").isNotNull()
    raw = tally.groupBy("feature").agg(
        F.sum(F.when(here, F.col("c")).otherwise(0)).alias("count"),
        F.sum(F.when(here, 0).otherwise(F.col("c"))).alias("_missing"),
        F.count_if(here).alias("unique_values"),
        F.max(F.when(here, F.col("c"))).alias("_top"),
        *[c.alias(name) for name, c in extra.items()],
    )
    some = F.col("count") > 0
    return raw.select(
        "feature", "count",
        F.when(some, F.col("_missing")).otherwise(0).alias("missing_count"),
        percent(F.col("_missing"), F.col("count") + F.col("_missing")).alias("missing_percentage"),
        "unique_values",
        (F.col("unique_values") <= 1).alias("is_constant"),
        "_top",
        *extra,
    )


def profile_numeric(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per numeric or boolean column with the full set of statistics."""
    columns = list(columns or numeric_columns(df))
    flags = {c for c in columns if isinstance(df.schema[c].dataType, T.BooleanType)}
    numbers = df.select(*[(F.col(c).cast("int") if c in flags else F.col(c)).alias(c) for c in columns])
    long = to_long(numbers, columns)
    tally = _tally(long)
    v, c = F.col("value"), F.col("c")
    base = _base(
        tally,
        mean=F.try_divide(F.sum(v * c), F.sum(F.when(v.isNotNull(), c))),
        min=F.min("value"), max=F.max("value"),
    )
    quartiles = exact_percentiles(long, ["feature"], "value", QUARTILES)
    head = base.join(F.broadcast(quartiles), "feature", "left").withColumn("iqr", F.col("q3") - F.col("q1"))
    off = v - F.col("mean")
    outside = (v < F.col("q1") - FENCE * F.col("iqr")) | (v > F.col("q3") + FENCE * F.col("iqr"))
    spread = (
        tally.join(F.broadcast(head), "feature")
        .groupBy("feature")
        .agg(
            F.sum(off * off * c).alias("_s2"),
            F.sum(F.pow(off, 3) * c).alias("_s3"),
            F.sum(F.pow(off, 4) * c).alias("_s4"),
            F.sum(F.when(outside, c).otherwise(0)).alias("outlier_count"),
            # the smallest of the commonest values
            F.min(F.when(c == F.col("_top"), v)).alias("mode"),
            *[F.first(name).alias(name) for name in head.columns if name not in ("feature", "_top")],
        )
    )
    n = F.col("count")
    variance = F.try_divide(F.col("_s2"), n - 1)
    m2, m3, m4 = (F.try_divide(F.col(s), n) for s in ("_s2", "_s3", "_s4"))
    return _every(df, columns, spread.withColumns({
        "dtype": F.when(n > 0, _dtype(df, columns)).otherwise("unknown"),
        "variance": variance,
        "std": F.sqrt(variance),
        "range": F.col("max") - F.col("min"),
        "skewness": adjusted_skewness(n, m2, m3),
        "kurtosis": adjusted_kurtosis(n, m2, m4),
        "outlier_percentage": F.coalesce(percent(F.col("outlier_count"), n), F.lit(0.0)),
    }).select("feature", "dtype", "count", "missing_count", "missing_percentage", "unique_values",
              "is_constant", "mode", *NUMERIC_FIELDS, "outlier_count", "outlier_percentage"))


def profile_strings(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per text column: the base fields, numeric fields NULL, no outliers."""
    columns = list(columns or string_columns(df))
    long = df.select(*columns).unpivot([], columns, "feature", "value")
    empty = {name: F.lit(None).cast("double") for name in NUMERIC_FIELDS}
    tally = _tally(long)
    base = _base(tally)
    commonest = (
        tally.join(F.broadcast(base.select("feature", "_top")), "feature")
        .where((F.col("c") == F.col("_top")) & F.col("value").isNotNull())
        .groupBy("feature").agg(F.min("value").alias("mode"))
    )
    return _every(df, columns, (
        base.join(F.broadcast(commonest), "feature", "left")
        .withColumns({
            "dtype": F.when(F.col("count") > 0, _dtype(df, columns)).otherwise("unknown"),
            **empty,
            "outlier_count": F.lit(0).cast("long"),
            "outlier_percentage": F.lit(0.0),
        })
        .select("feature", "dtype", "count", "missing_count", "missing_percentage", "unique_values",
                "is_constant", "mode", *NUMERIC_FIELDS, "outlier_count", "outlier_percentage")
    ))


def feature_profile(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """Profile of every numeric, boolean and text column; ``mode`` as text."""
    kept = df.select(*[c for c in df.columns if c not in set(exclude)])
    parts = []
    if numeric_columns(kept):
        parts.append(profile_numeric(kept))
    if string_columns(kept):
        parts.append(profile_strings(kept))
    if not parts:
        raise ValueError("no column to profile")
    texts = [p.withColumn("mode", F.col("mode").cast("string")) for p in parts]
    return texts[0] if len(texts) == 1 else texts[0].unionByName(texts[1])


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, std, min, quartiles, max per column, from two passes over the rows."""
    facts = exact_percentiles(
        to_long(df, columns), ["feature"], "value", {"p25": 0.25, "p50": 0.5, "p75": 0.75},
        also={"count": F.count("value"), "mean": F.avg("value"), "std": F.stddev_samp("value"),
              "min": F.min("value"), "max": F.max("value")},
    )
    names = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c) for c in columns])).alias("feature"))
    return names.join(facts, "feature", "left").select(
        "feature", F.coalesce("count", F.lit(0)).alias("count"), "mean", "std", "min", "p25", "p50", "p75", "max")


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, nulls, rows), counted in one pass over the wide frame."""
    columns = list(columns or df.columns)
    one = df.agg(F.count("*").alias("_rows"), *[
        F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(columns)
    ])
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"_n{i}").alias("null_count"))
        for i, c in enumerate(columns)
    ])
    return one.select(F.explode(pairs).alias("p"), F.col("_rows").alias("row_count")).select(
        "p.column_name", "p.null_count", "row_count"
    )


def iqr_outliers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Bounds and number of values strictly outside them, per column."""
    long = to_long(df, columns)
    fences = exact_percentiles(long, ["feature"], "value", QUARTILES).select(
        "feature",
        (F.col("q1") - FENCE * (F.col("q3") - F.col("q1"))).alias("lower_bound"),
        (F.col("q3") + FENCE * (F.col("q3") - F.col("q1"))).alias("upper_bound"),
    )
    v = F.col("value")
    counted = long.join(F.broadcast(fences), "feature").groupBy("feature").agg(
        F.first("lower_bound").alias("lower_bound"), F.first("upper_bound").alias("upper_bound"),
        F.count("value").alias("count"),
        F.count_if((v < F.col("lower_bound")) | (v > F.col("upper_bound"))).alias("outlier_count"),
    )
    return counted.withColumn(
        "outlier_percentage", F.coalesce(percent(F.col("outlier_count"), F.col("count")), F.lit(0.0)))


def quality_summary(profile: DataFrame) -> DataFrame:
    """Roll-up of a profile: columns with missing values, constant, rich in outliers."""
    return profile.agg(
        F.count("*").alias("feature_count"),
        F.count_if(F.col("missing_count") > 0).alias("features_with_missing"),
        F.count_if("is_constant").alias("features_constant"),
        F.count_if(F.col("outlier_percentage") > OUTLIER_ALERT_PERCENT).alias("features_with_outliers"),
        F.avg("missing_percentage").alias("average_missing_percentage"),
    )


def drift_reference(profile: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The seven statistics drift checks need, for columns that have a mean."""
    return profile.where(F.col("mean").isNotNull()).select(*keep, "feature", *DRIFT_FIELDS)


def drift_statistics(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The same rows straight from the data: no full profile, and no shuffle of values.

    Moments and extremes come with the sketch's pass; what is shuffled after that are the few
    values inside the brackets of three percentiles.
    """
    columns = list(columns or numeric_columns(df))
    found = exact_percentiles(
        to_long(df, columns), ["feature"], "value", QUARTILES,
        also={"mean": F.avg("value"), "std": F.stddev_samp("value"), "min": F.min("value"), "max": F.max("value")})
    return found.select("feature", *DRIFT_FIELDS)


def _with_horizon(df: DataFrame, targets: Sequence[str]) -> DataFrame:
    long = to_long(df, targets, name="_target")
    number = F.create_map(*[F.lit(x) for h, t in enumerate(targets, start=1) for x in (t, h)])
    return long.select(number[F.col("_target")].alias("horizon"), "value")


def target_stats(df: DataFrame, targets: Sequence[str]) -> DataFrame:
    """All horizons taken together; population deviation."""
    facts = exact_percentiles(
        # one group over all horizons, which count from 1
        _with_horizon(df, targets).withColumn("_all", F.least(F.col("horizon"), F.lit(0))), ["_all"], "value",
        {"overall_median": 0.5},
        also={"total_predictions": F.count("*"), "valid_predictions": F.count("value"),
              "overall_mean": F.avg("value"), "overall_std": F.stddev_pop("value"),
              "overall_min": F.min("value"), "overall_max": F.max("value")},
    )
    return facts.select(
        F.expr(f"total_predictions div {len(targets)}").alias("total_samples"),
        F.lit(len(targets)).alias("forecast_horizons"),
        "total_predictions", "valid_predictions",
        (F.col("total_predictions") - F.col("valid_predictions")).alias("missing_predictions"),
        "overall_mean", "overall_std", "overall_min", "overall_max", "overall_median",
    )


def target_stats_by_horizon(df: DataFrame, targets: Sequence[str]) -> DataFrame:
    """Per horizon, sample deviation; horizons without a value are left out."""
    return exact_percentiles(
        _with_horizon(df, targets), ["horizon"], "value", {"median": 0.5},
        also={"count": F.count("value"), "mean": F.avg("value"), "std": F.stddev_samp("value"),
              "min": F.min("value"), "max": F.max("value")},
    )


def histogram(df: DataFrame, bins: dict[str, int], positive: bool = False) -> DataFrame:
    """Equal-width bins from minimum to maximum per column, empty bins included; ``positive``
    leaves out values of 0 and below."""
    columns = list(bins)
    long = to_long(df, columns).where(F.col("value") > 0 if positive else F.col("value").isNotNull())
    number = F.create_map(*[F.lit(x) for item in bins.items() for x in item])
    edges = long.groupBy("feature").agg(F.min("value").alias("_lo"), F.max("value").alias("_hi"))
    flat = F.col("_lo") == F.col("_hi")
    edges = edges.select(
        "feature", number[F.col("feature")].alias("_bins"),
        F.when(flat, F.col("_lo") - 0.5).otherwise(F.col("_lo")).alias("_lo"),
        F.when(flat, F.col("_hi") + 0.5).otherwise(F.col("_hi")).alias("_hi"),
    ).withColumn("_width", (F.col("_hi") - F.col("_lo")) / F.col("_bins"))
    slot = F.least(F.floor((F.col("value") - F.col("_lo")) / F.col("_width")), F.col("_bins") - 1).cast("int")
    counts = (
        long.join(F.broadcast(edges), "feature")
        .groupBy("feature", slot.alias("bin")).agg(F.count("*").alias("_n"))
    )
    grid = edges.withColumn("bin", F.explode(F.sequence(F.lit(0), F.col("_bins") - 1)))
    return grid.join(counts, ["feature", "bin"], "left").select(
        "feature", "bin",
        (F.col("_lo") + F.col("bin") * F.col("_width")).alias("bin_start"),
        (F.col("_lo") + (F.col("bin") + 1) * F.col("_width")).alias("bin_end"),
        F.coalesce("_n", F.lit(0)).alias("count"),
    )
