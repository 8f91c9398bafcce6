"""Batch sink: land a batch under a timestamp name, as the raw families are stored."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_line_total(df: DataFrame) -> DataFrame:
    """Transactions carry unit price times quantity as their total."""
    return df.withColumn("total_amount", F.col("unit_price") * F.col("quantity"))


def land_batch(df: DataFrame, directory: str, family: str, stamp: datetime | str) -> str:
    """Write one batch to `{family}_events_{YYYYmmdd_HHMMSS}.parquet` and return its path.

    The batch is a directory of part files, written by all tasks. Landing two
    batches under one second is an error rather than a silent overwrite.
    """
    if isinstance(stamp, datetime):
        stamp = stamp.strftime("%Y%m%d_%H%M%S")
    if family == "transaction" and "unit_price" in df.columns:
        df = with_line_total(df)
    path = f"{directory}/{family}_events_{stamp}.parquet"
    df.write.mode("errorifexists").parquet(path)
    return path
