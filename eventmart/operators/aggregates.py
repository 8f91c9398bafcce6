"""Aggregation building blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def conditional_sums(
    col: str, names: dict[str, str], measure: Column | str | int = 1
) -> list[Column]:
    """One `sum(measure where col = value)` per entry of {value: output name}."""
    amount = F.lit(measure) if isinstance(measure, int) else F.col(measure) if isinstance(measure, str) else measure
    return [
        F.sum(F.when(F.col(col) == value, amount).otherwise(F.lit(0))).cast("bigint").alias(name)
        for value, name in names.items()
    ]


def count_true(flag: Column | str) -> Column:
    """How many rows have the flag set; NULL counts as unset."""
    flag = F.col(flag) if isinstance(flag, str) else flag
    return F.sum(F.when(flag, F.lit(1)).otherwise(F.lit(0))).cast("bigint")


def mode_per_key(df: DataFrame, key: str, modes: dict[str, str]) -> DataFrame:
    """Most frequent value per key for several columns of one type, {column: output name}.

    NULLs do not count; the smallest value wins ties; NULL when a key has no value.
    Counting first, with map-side combine, leaves one row per distinct value for
    the second step, so no task ever holds one key's rows.
    """
    return mode_of_counts(value_counts(df, key, list(modes)), key, modes)


def value_counts(df: DataFrame, key: str, columns: list[str], by: str | None = None) -> DataFrame:
    """`key, slot, value, n`: how often a key has a value in the column of that slot; `by` counts within groups of it."""
    known = df.where(F.col(key).isNotNull())
    keys = [key, *([by] if by else [])]
    slots = F.array(
        *[
            F.struct(F.lit(i).alias("slot"), F.col(c).alias("value"))
            for i, c in enumerate(columns)
        ]
    )
    return known.select(*keys, F.inline(slots)).groupBy(*keys, "slot", "value").agg(F.count("value").alias("n"))


def mode_of_counts(counted: DataFrame, key: str, modes: dict[str, str]) -> DataFrame:
    """`mode_per_key` from its counts, one row per key, slot and value."""
    # A NULL value has n = 0 and ranks below every real one: it keeps its key alive.
    rank = F.struct(-F.col("n"), F.col("value"))
    return counted.groupBy(key).agg(
        *[
            F.min_by("value", F.when(F.col("slot") == i, rank)).alias(name)
            for i, name in enumerate(modes.values())
        ]
    )
