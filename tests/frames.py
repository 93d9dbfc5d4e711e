"""Micro-frames for the tests."""

from __future__ import annotations

from datetime import datetime, timedelta

START = datetime(2024, 1, 1)


def hourly_rows(values, start=START, skip=()):
    """(time, value) per hour; hours in ``skip`` are left out of the clock."""
    rows, i = [], 0
    for v in values:
        while i in skip:
            i += 1
        rows.append((start + timedelta(hours=i), None if v is None else float(v)))
        i += 1
    return rows


def series(spark, values, start=START, skip=(), key=None):
    rows = hourly_rows(values, start, skip)
    if key is None:
        return spark.createDataFrame(rows, "date_time timestamp_ntz, ac_power double")
    return spark.createDataFrame([(key, *r) for r in rows], "plant string, date_time timestamp_ntz, ac_power double")


def solar_days(days, start=datetime(2020, 5, 1)):
    """Daylight triangle of the 45-day fixture: 500 * (1 - |h - 12| / 6) + 50 DC, 0.95 of it AC."""
    rows = []
    for i in range(days * 24):
        h = i % 24
        dc = 500 * (1 - abs(h - 12) / 6) + 50 if 6 <= h <= 18 else 0.0
        rows.append((start + timedelta(hours=i), round(dc * 0.95, 1)))
    return rows
