"""Scans of raw families: glob, provenance, high-water filter, inventory, schema union."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.schemas import FAMILIES, Family
from eventmart.sources.footers import footer_schemas

SOURCE = "source_filename"


def batch_name(family: Family) -> Column:
    """`{family}_events_{stamp}.parquet` of the batch a row came from.

    A batch is one file or one directory of part files, so the name is taken from
    the path. The value is constant per file: comparing it with a literal skips
    files before they are opened.
    """
    return F.regexp_extract(
        F.col("_metadata.file_path"), rf"({family.name}_events_[^/]*\.parquet)", 1
    )


def scan_events(
    spark: SparkSession, directory: str, family: str, schema: T.StructType | None = None
) -> DataFrame:
    """All batches of a family plus their batch name; absent columns read as NULL."""
    fam = FAMILIES[family]
    return (
        spark.read.schema(schema or fam.raw)
        .parquet(f"{directory}/{fam.glob}")
        .select("*", batch_name(fam).alias(SOURCE))
    )


def only_new_files(df: DataFrame, mark: str, col: str = SOURCE) -> DataFrame:
    """Rows of batches named after the mark, in string order.

    A batch arriving late under a smaller name is never read; the streaming source
    is the form without that gap.
    """
    return df.where(F.col(col) > F.lit(mark))


def family_files(spark: SparkSession, directory: str, family: str) -> DataFrame:
    """(family, source_filename, file), from the directory listing alone.

    The listing is read as file metadata, so no file content is touched.
    """
    fam = FAMILIES[family]
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(directory)
    )
    name = F.regexp_extract("path", rf"({fam.name}_events_[^/]*\.parquet)", 1)
    return listing.select(F.lit(family).alias("family"), name.alias(SOURCE), F.col("_metadata.file_path").alias("file")).where(
        F.col(SOURCE) != ""
    )


def source_inventory(spark: SparkSession, directory: str, families: list[str] | None = None) -> DataFrame:
    """(family, files) batches waiting per family; a family without any shows 0."""
    families = families or list(FAMILIES)
    found = reduce(DataFrame.unionByName, [family_files(spark, directory, f) for f in families])
    per_family = [
        F.count_distinct(F.when(F.col("family") == f, F.col(SOURCE))).alias(f) for f in families
    ]
    entries = [F.struct(F.lit(f).alias("family"), F.col(f).alias("files")) for f in families]
    return found.agg(*per_family).select(F.inline(F.array(*entries)))


def source_rows(spark: SparkSession, directory: str, family: str) -> DataFrame:
    """(family, source_filename, n_rows) per batch."""
    return (
        scan_events(spark, directory, family)
        .groupBy(SOURCE)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .select(F.lit(family).alias("family"), SOURCE, "n_rows")
    )


def require_sources(spark: SparkSession, directory: str, families: list[str] | None = None) -> int:
    """Number of batches found; an error when there is nothing to load at all."""
    total = source_inventory(spark, directory, families).agg(F.sum("files").alias("n")).first()["n"]
    if not total:
        raise ValueError(f"no event files under {directory}")
    return total


_NUMERIC_ORDER = ["tinyint", "smallint", "int", "bigint", "float", "double"]


def _common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type both sides convert to; text when they have nothing else in common."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return _common_struct(a, b)
    names = [a.simpleString(), b.simpleString()]
    if all(n in _NUMERIC_ORDER for n in names):
        wider = max(names, key=_NUMERIC_ORDER.index)
        if wider == "float" and {"int", "bigint"} & set(names):
            wider = "double"
        return b if wider == names[1] else a if wider == names[0] else T.DoubleType()
    if all(isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType)) for t in (a, b)):
        return T.TimestampNTZType()
    return T.StringType()


def _common_struct(a: T.StructType, b: T.StructType) -> T.StructType:
    merged = {f.name: f.dataType for f in a.fields}
    for f in b.fields:
        merged[f.name] = _common_type(merged[f.name], f.dataType) if f.name in merged else f.dataType
    return T.StructType([T.StructField(n, t) for n, t in merged.items()])


def _conform(col: Column, have: T.DataType, want: T.DataType) -> Column:
    """`col` converted to `want`, with struct fields it lacks filled by NULL."""
    if have == want:
        return col
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        fields = [
            (
                _conform(col.getField(f.name), have[f.name].dataType, f.dataType)
                if f.name in have.names
                else F.lit(None).cast(f.dataType)
            ).alias(f.name)
            for f in want.fields
        ]
        return F.when(col.isNotNull(), F.struct(*fields))
    if isinstance(have, T.StructType) and isinstance(want, T.StringType):
        return F.to_json(col)
    return col.cast(want)


def schema_union(spark: SparkSession, files: list[str]) -> DataFrame:
    """Union of Parquet files by column name.

    A column some files lack is NULL there, and a column stored under several
    types takes their common type. Footers are read once, by tasks; each schema is one scan.
    """
    signed = footer_schemas(spark, spark.createDataFrame([(f,) for f in files], "file string"))
    by_signature: dict[str, list[str]] = {}
    for row in signed.collect():
        by_signature.setdefault(row["signature"], []).append(row["file"])
    groups: dict[str, tuple[list[str], T.StructType]] = {}
    for paths in by_signature.values():
        schema = spark.read.parquet(paths[0]).schema
        groups.setdefault(schema.simpleString(), ([], schema))[0].extend(paths)
    wanted = reduce(_common_struct, [schema for _, schema in groups.values()])
    parts = []
    for paths, schema in groups.values():
        part = spark.read.schema(schema).parquet(*paths)
        parts.append(
            part.select(
                *[
                    (
                        _conform(F.col(f.name), schema[f.name].dataType, f.dataType)
                        if f.name in schema.names
                        else F.lit(None).cast(f.dataType)
                    ).alias(f.name)
                    for f in wanted.fields
                ]
            )
        )
    return reduce(DataFrame.unionByName, parts)


def scan_union(spark: SparkSession, directory: str, family: str) -> DataFrame:
    """`schema_union` over every file of a family, for batches without a declared schema."""
    files = [row["file"] for row in family_files(spark, directory, family).select("file").toLocalIterator()]
    return schema_union(spark, files)
