"""Batches whose files differ in schema: files grouped by their footers, one scan a group, values fitted to the declared types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.functions.payload import struct_of_text
from eventmart.schemas import FAMILIES
from eventmart.sources.footers import footer_schemas, schema_ranges
from eventmart.sources.scan import SOURCE, batch_name, family_files

_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTIONS = (T.FloatType, T.DoubleType, T.DecimalType)
_TIMES = (T.DateType, T.TimestampType, T.TimestampNTZType)


def scan_by_schema(spark: SparkSession, directory: str, family: str, mark: str = "") -> list[DataFrame]:
    """The rows of batches named after the mark, a frame for each schema their files have, plus the batch name.

    Each frame reads only the files of its schema: the path is constant per file, so
    the ranges skip files before they are opened.
    """
    fam = FAMILIES[family]
    files = family_files(spark, directory, family).where(F.col(SOURCE) > F.lit(mark))
    groups: dict[str, tuple[T.StructType, list]] = {}
    for ranges in schema_ranges(footer_schemas(spark, files)).values():
        schema = spark.read.parquet(ranges[0][0]).schema
        groups.setdefault(schema.json(), (schema, []))[1].extend(ranges)
    frames = []
    for schema, ranges in groups.values():
        rows = spark.read.schema(schema).parquet(f"{directory}/{fam.glob}")
        path = F.col("_metadata.file_path")
        own = F.lit(False)
        for first, after in ranges:
            own = own | ((path >= F.lit(first)) & ((path < F.lit(after)) if after else F.lit(True)))
        if mark:  # no name is empty
            own = own & (batch_name(fam) > F.lit(mark))
        frames.append(rows.where(own).select("*", batch_name(fam).alias(SOURCE)))
    return frames


def fit(col: Column, have: T.DataType, want: T.DataType) -> Column:
    """`col` as the declared type; a value that has no equal there is NULL."""
    if have == want:
        return col
    nothing = F.lit(None).cast(want)
    if isinstance(want, T.StructType):
        if isinstance(have, T.StringType):
            return struct_of_text(col, want)
        if not isinstance(have, T.StructType):
            return nothing
        fields = [
            (fit(col.getField(f.name), have[f.name].dataType, f.dataType) if f.name in have.names else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in want.fields
        ]
        return F.when(col.isNotNull(), F.struct(*fields))
    if isinstance(want, T.StringType):
        return F.to_json(col) if isinstance(have, (T.StructType, T.ArrayType, T.MapType)) else col.cast(want)
    numbers = (*_INTEGERS, *_FRACTIONS)
    if isinstance(have, _FRACTIONS) and isinstance(want, _INTEGERS):
        return F.when(F.floor(col) == col, col.try_cast(want))
    if isinstance(have, (T.StringType, T.BooleanType, *numbers)) and isinstance(want, (T.BooleanType, *numbers)):
        return col.try_cast(want)
    if isinstance(have, (T.StringType, *_TIMES)) and isinstance(want, _TIMES):
        return col.try_cast(want)
    return nothing


def declared(df: DataFrame, family: str) -> DataFrame:
    """A scan's rows with the family's raw columns; absent ones are NULL, others left out.

    Event time keeps the type it is stored in, since parsing depends on it.
    """
    have = {f.name.lower(): f for f in df.schema.fields}
    columns = []
    for f in FAMILIES[family].raw.fields:
        own = have.get(f.name.lower())
        if own is None:
            columns.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif f.name == "timestamp" and isinstance(own.dataType, _TIMES):
            columns.append(F.col(own.name).alias(f.name))
        else:
            columns.append(fit(F.col(own.name), own.dataType, f.dataType).alias(f.name))
    return df.select(*columns, SOURCE)
