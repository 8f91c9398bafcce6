"""Newest-wins deduplication."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _orderable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.MapType):
        return False
    if isinstance(dtype, T.StructType):
        return all(_orderable(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return _orderable(dtype.elementType)
    return not isinstance(dtype, T.VariantType)


def latest_per_key(df: DataFrame, key: str | list[str], order_by: list[str]) -> DataFrame:
    """One row per key: the highest by `order_by`, ties broken by every other column.

    The total order makes the survivor the same on every run. Catalyst turns the
    row-number filter into a group limit before the shuffle, so a key holding a
    large share of the rows sends at most one row per map task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [f.name for f in df.schema if f.name not in {*keys, *order_by} and _orderable(f.dataType)]
    newest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in [*order_by, *rest]])
    return df.withColumn("_row", F.row_number().over(newest)).where("_row = 1").drop("_row")
