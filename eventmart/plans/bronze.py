"""Bronze: raw events with parsed time, window and provenance."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.functions.timecols import event_time, time_literal, window_start
from eventmart.operators.incremental import high_water
from eventmart.schemas import FAMILIES
from eventmart.sources.drift import declared, scan_by_schema
from eventmart.sources.scan import SOURCE


def parse_raw(
    raw: DataFrame, family: str, loaded_at: datetime | str | Column | None = None
) -> DataFrame:
    """Raw rows to bronze rows. A time that does not parse gives NULL and the row stays."""
    fam = FAMILIES[family]
    parsed = raw.withColumn(fam.ts, event_time(raw, "timestamp"))
    columns = [fam.ts if c == "timestamp" else c for c in fam.raw.names]
    return parsed.select(
        *columns,
        F.to_date(fam.ts).alias(fam.date),
        window_start(fam.ts).alias(fam.window),
        SOURCE,
        time_literal(loaded_at).alias("loaded_at"),
    )


def load(
    spark: SparkSession,
    directory: str,
    family: str,
    target: DataFrame | None = None,
    as_of: datetime | str | Column | None = None,
    mark: str | None = None,
) -> DataFrame:
    """Bronze rows of the batches named after everything the target has loaded.

    Files may differ in schema: each is read with its own and fitted to the family's declared
    columns, a payload that is text like one that is a struct. Pass `mark` when the high-water mark is already known; otherwise it is read
    from the target.
    """
    if mark is None:
        mark = high_water(target)
    found = scan_by_schema(spark, directory, family, mark)
    if not found:
        none = spark.createDataFrame([], T.StructType([*FAMILIES[family].raw.fields, T.StructField(SOURCE, T.StringType())]))
        return parse_raw(none, family, as_of)
    return reduce(DataFrame.unionByName, [parse_raw(declared(rows, family), family, as_of) for rows in found])


def bronze_device_events(spark: SparkSession, directory: str, **options) -> DataFrame:
    return load(spark, directory, "device", **options)


def bronze_session_events(spark: SparkSession, directory: str, **options) -> DataFrame:
    return load(spark, directory, "session", **options)


def bronze_transaction_events(spark: SparkSession, directory: str, **options) -> DataFrame:
    return load(spark, directory, "transaction", **options)
