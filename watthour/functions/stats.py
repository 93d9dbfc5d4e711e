"""Statistics Spark has no direct column for, with explicit NULL and zero rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def nan_to_null(column: Column) -> Column:
    """Spark sorts NaN above every number; missing values are NULL here."""
    return F.when(~F.isnan(column), column)


def adjusted_skewness(n: Column, m2: Column, m3: Column) -> Column:
    """Bias-adjusted skewness from central moments (averages); constant data gives 0."""
    n = n.cast("double")
    g1 = F.try_divide(m3, F.pow(m2, 1.5))
    return (
        F.when(n < 3, F.lit(None).cast("double"))
        .when(m2 == 0, F.lit(0.0))
        .otherwise(g1 * F.try_divide(F.sqrt(n * (n - 1)), n - 2))
    )


def adjusted_kurtosis(n: Column, m2: Column, m4: Column) -> Column:
    """Bias-adjusted excess kurtosis from central moments; constant data gives 0."""
    n = n.cast("double")
    g2 = F.try_divide(m4, m2 * m2) - 3
    return (
        F.when(n < 4, F.lit(None).cast("double"))
        .when(m2 == 0, F.lit(0.0))
        .otherwise(F.try_divide(n - 1, (n - 2) * (n - 3)) * ((n + 1) * g2 + 6))
    )


def correlation(x: Column, y: Column) -> Column:
    """Pearson r over the rows where both sides are present; NULL when one is constant."""
    both = x.isNotNull() & y.isNotNull()
    spread = F.stddev_pop(F.when(both, x)) * F.stddev_pop(F.when(both, y))
    return F.try_divide(F.covar_pop(x, y), spread)


def correlation_complete(x: Column, y: Column) -> Column:
    """Pearson r of columns without missing values; equal deviations are computed once."""
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def r_squared(squared_error: Column, squared_total: Column) -> Column:
    """1 - SSE/SST; with no spread in y: 1 if the fit is perfect, else 0."""
    return (
        F.when((squared_total == 0) & (squared_error == 0), F.lit(1.0))
        .when(squared_total == 0, F.lit(0.0))
        .otherwise(F.lit(1.0) - F.try_divide(squared_error, squared_total))
    )


def percent(part: Column, whole: Column) -> Column:
    return F.try_divide(part * F.lit(100.0), whole)


def whole_days(start: Column, end: Column) -> Column:
    """Whole days between two timestamps, the rest cut off."""
    return F.extract(F.lit("DAY"), end - start).cast("long")


def seconds_between(start: Column, end: Column) -> Column:
    """Elapsed seconds.  Taken from an interval, so that timestamps without a zone are
    never read through the session's zone and its clock changes."""
    gap = end - start
    parts = {"DAY": 86_400, "HOUR": 3_600, "MINUTE": 60, "SECOND": 1}
    return sum((F.extract(F.lit(p), gap).cast("double") * n for p, n in parts.items()), F.lit(0.0))
