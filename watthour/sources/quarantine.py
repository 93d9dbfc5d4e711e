"""Scans of CSV readings that keep going on bad rows: good rows typed, bad rows with the reason.

Every field is read as text and typed here, so whether a row is good depends on the whole row
and not on the columns a later step happens to select.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from watthour.operators.hourly import hourly_mean, load_summary
from watthour.schemas import GENERATION, TS, VALUE, WEATHER
from watthour.sources.readings import TIME_FORMAT

RAW = "_corrupt_record"
MALFORMED = "malformed row"


@dataclass(frozen=True)
class Scan:
    """``rows`` in the types of the readings; ``quarantine`` with file, reason and record."""

    rows: DataFrame
    quarantine: DataFrame


def parse_time(text: Column, formats: Sequence[str] = (TIME_FORMAT,)) -> Column:
    """timestamp_ntz by the first format that fits, else NULL.

    No session time zone takes part: a time inside a daylight-saving gap stays as written.
    """
    def by(form: str) -> Column:
        # a separator that no time holds, so that the text is one field
        options = {"timestampNTZFormat": form, "sep": "\u0001", "mode": "PERMISSIVE"}
        return F.from_csv(text, "t timestamp_ntz", options)["t"]
    return F.coalesce(*[by(f) for f in formats])


def _typed(field: T.StructField, formats: Sequence[str]) -> Column:
    if field.name == TS:
        return parse_time(F.col(TS), formats)
    return F.col(field.name).try_cast(field.dataType)


def _scan(spark: SparkSession, path: str, schema: T.StructType, formats: Sequence[str]) -> Scan:
    text = T.StructType([T.StructField(n, T.StringType()) for n in [*schema.names, RAW]])
    raw = spark.read.csv(path, schema=text, header=True, enforceSchema=False, mode="PERMISSIVE",
                         columnNameOfCorruptRecord=RAW)
    faults = [F.when(F.col(RAW).isNotNull(), F.lit(MALFORMED)), F.when(F.col(TS).isNull(), F.lit(f"{TS}: missing"))]
    for field in schema.fields:
        unread = F.col(field.name).isNotNull() & _typed(field, formats).isNull()
        kind = "time" if field.name == TS else field.dataType.simpleString()
        faults.append(F.when(unread, F.lit(f"{field.name}: no {kind}")))
    judged = raw.select(*text.names, F.input_file_name().alias("file"), F.coalesce(*faults).alias("reason"))
    record = F.coalesce(F.col(RAW), F.to_csv(F.struct(*schema.names)))
    return Scan(
        judged.where("reason IS NULL").select(*[_typed(f, formats).alias(f.name) for f in schema.fields]),
        judged.where("reason IS NOT NULL").select("file", "reason", record.alias("record")),
    )


def scan_generation(spark: SparkSession, path: str, formats: Sequence[str] = (TIME_FORMAT,)) -> Scan:
    """Generation readings; a row that is malformed, has no readable time or a field that is
    not of its type is put aside.  An empty number is a missing value, not a fault."""
    return _scan(spark, path, GENERATION, formats)


def scan_weather(spark: SparkSession, path: str, formats: Sequence[str] = (TIME_FORMAT,)) -> Scan:
    return _scan(spark, path, WEATHER, formats)


def quarantine_summary(scan: Scan) -> DataFrame:
    """Rows put aside per file and reason."""
    return scan.quarantine.groupBy("file", "reason").agg(F.count("*").alias("row_count"))


def count_weather(spark: SparkSession, path: str | None, source: str = "csv") -> tuple[int, bool]:
    """(records, available) of weather, which is only counted: a path that is missing, or
    files that fail while they are read, give (0, False) and stop nothing."""
    if path is None:
        return 0, False
    try:
        if source == "csv":
            # a field is referenced, so that files are opened and headers checked
            rows = spark.read.csv(path, schema=WEATHER, header=True, enforceSchema=False)
            return rows.agg(F.count("*"), F.count(TS)).first()[0], True
        rows = spark.read.format(source).load(path)
        return rows.agg(F.count("*"), *[F.count(c) for c in rows.columns[:1]]).first()[0], True
    except (PySparkException, Py4JJavaError):  # a failed task comes as the latter
        return 0, False


def load_report(spark: SparkSession, generation: str, weather: str | None = None,
                formats: Sequence[str] = (TIME_FORMAT,)) -> DataFrame:
    """One row: readings kept and put aside, hours, time range and what is known of the weather."""
    scan = scan_generation(spark, generation, formats)
    seen, there = count_weather(spark, weather)
    facts = load_summary(scan.rows, hourly_mean(scan.rows, TS, VALUE))
    aside = scan.quarantine.agg(F.count("*").alias("quarantined_records"))
    both = facts.unionByName(aside, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns]).withColumns({
        "weather_records": F.lit(seen).cast("long"), "weather_available": F.lit(there)})
