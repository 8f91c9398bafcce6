"""Schemas of Parquet files from their footers, read once in a distributed job."""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import unquote, urlparse

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventmart.session import stage


def _signature(source) -> str:
    import pyarrow.parquet as pq

    return pq.read_schema(source).to_string(show_field_metadata=False, show_schema_metadata=False)


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Footers by path; null where this process cannot open the file system."""
    from pyarrow import fs

    for batch in batches:
        found = []
        for path in batch.column(0).to_pylist():
            try:
                url = urlparse(path)
                system, at = (fs.LocalFileSystem(), unquote(url.path)) if url.scheme in ("", "file") else fs.FileSystem.from_uri(path)
                with system.open_input_file(at) as file:
                    found.append(_signature(file))
            except (OSError, pa.ArrowException):
                found.append(None)
        yield pa.record_batch([batch.column(0), pa.array(found, pa.string())], ["file", "signature"])


def _given(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Footers of file contents that Spark has read."""
    for batch in batches:
        found = [_signature(pa.BufferReader(content.as_buffer())) for content in batch.column(1)]
        yield pa.record_batch([batch.column(0), pa.array(found, pa.string())], ["file", "signature"])


def footer_schemas(spark: SparkSession, files: DataFrame) -> DataFrame:
    """`file, signature` of each Parquet file of `files`; equal schemas have equal signatures.

    Tasks read the footers. Where only Spark can open the file system, its reader
    hands the files over, at the price of reading them whole.
    """
    schema = "file string, signature string"
    found = stage(files.select("file").mapInArrow(_opened, schema))
    unopened = found.where("signature is null")
    if unopened.isEmpty():
        return found
    whole = spark.read.format("binaryFile").load([r["file"] for r in unopened.select("file").collect()])
    handed = whole.select(F.col("_metadata.file_path").alias("file"), "content")
    return found.where("signature is not null").unionByName(stage(handed.mapInArrow(_given, schema)))


def schema_ranges(signed: DataFrame) -> dict[str, list[tuple[str, str | None]]]:
    """Signature -> ranges [first file, first file after) in the order of paths.

    Batches are named by time and schemas change now and then, so there are few
    ranges. The window sees a row per file, names only.
    """
    order = Window.orderBy("file")
    starts = (
        signed.withColumn("last", F.lag("signature").over(order))
        .where(~F.col("signature").eqNullSafe(F.col("last")))
        .orderBy("file")
        .select("file", "signature")
        .collect()
    )
    found: dict[str, list[tuple[str, str | None]]] = {}
    for row, after in zip(starts, [*starts[1:], None]):
        found.setdefault(row["signature"], []).append((row["file"], after["file"] if after else None))
    return found
