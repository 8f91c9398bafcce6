"""Row validation and declarative data-quality checks."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.functions.timecols import days_interval, time_literal

MAX_AGE_DAYS = 30


def validate_events(
    df: DataFrame,
    required: list[str],
    ts_col: str,
    as_of: datetime | str | Column | None = None,
    max_age_days: int = MAX_AGE_DAYS,
    rules: list[Column] | None = None,
) -> DataFrame:
    """Rows with every required column, not after `as_of` and not older than the limit.

    Extra `rules` must be true; a rule that comes out NULL drops the row.
    """
    now = time_literal(as_of)
    tests = [F.col(c).isNotNull() for c in required]
    tests += [F.col(ts_col) <= now, F.col(ts_col) >= now - days_interval(max_age_days)]
    return df.where(reduce(and_, tests + (rules or [])))


@dataclass(frozen=True)
class Check:
    """A named rule on a column (or, for `unique`, on several)."""

    kind: str
    column: str | tuple[str, ...]
    values: tuple = field(default=())
    low: float | None = None
    high: float | None = None
    inclusive: bool = True

    @property
    def column_label(self) -> str:
        return self.column if isinstance(self.column, str) else ",".join(self.column)


def not_null(column: str) -> Check:
    return Check("not_null", column)


def unique(*columns: str) -> Check:
    return Check("unique", columns if len(columns) > 1 else columns[0])


def accepted_values(column: str, values: list) -> Check:
    return Check("accepted_values", column, values=tuple(values))


def accepted_range(
    column: str, low: float | None = None, high: float | None = None, inclusive: bool = True
) -> Check:
    return Check("accepted_range", column, low=low, high=high, inclusive=inclusive)


def _row_fails(check: Check) -> Column:
    """True on rows that break the rule; NULL breaks only `not_null`."""
    col = F.col(check.column)
    if check.kind == "not_null":
        return col.isNull()
    if check.kind == "accepted_values":
        return ~col.isin(list(check.values))
    if check.kind == "accepted_range":
        tests = []
        if check.low is not None:
            tests.append(col < check.low if check.inclusive else col <= check.low)
        if check.high is not None:
            tests.append(col > check.high if check.inclusive else col >= check.high)
        if not tests:
            return F.lit(False)
        return reduce(lambda a, b: a | b, tests)
    raise ValueError(f"unknown check {check.kind!r}")


def _duplicates(df: DataFrame, check: Check) -> DataFrame:
    columns = [check.column] if isinstance(check.column, str) else list(check.column)
    present = reduce(and_, [F.col(c).isNotNull() for c in columns])
    return (
        df.where(present)
        .groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .where(F.col("n_records") > 1)
    )


def failing_rows(df: DataFrame, check: Check) -> DataFrame:
    """The rows a check rejects; for `unique`, one row per repeated value with its count."""
    if check.kind == "unique":
        return _duplicates(df, check)
    return df.where(_row_fails(check))


def row_faults(checks: list[Check]) -> list[Column]:
    """The number of rows that fail each check, one aggregate per row-wise check."""
    return [F.coalesce(F.sum(F.when(_row_fails(c), F.lit(1)).otherwise(F.lit(0))), F.lit(0)).cast("bigint") for c in checks]


def run_checks(df: DataFrame, checks: list[Check]) -> DataFrame:
    """(check, column, failing_rows, passed), one row per check.

    All row-wise checks share one pass over the data; each `unique` adds one
    grouping of its own columns.
    """
    row_wise = [c for c in checks if c.kind != "unique"]
    parts = []
    if row_wise:
        totals = df.agg(
            *[faults.alias(f"_{i}") for i, faults in enumerate(row_faults(row_wise))]
        )
        entries = [
            F.struct(
                F.lit(c.kind).alias("check"),
                F.lit(c.column_label).alias("column"),
                F.col(f"_{i}").alias("failing_rows"),
            )
            for i, c in enumerate(row_wise)
        ]
        parts.append(totals.select(F.inline(F.array(*entries))))
    for c in checks:
        if c.kind == "unique":
            parts.append(
                _duplicates(df, c)
                .agg(F.count(F.lit(1)).alias("failing_rows"))
                .select(F.lit("unique").alias("check"), F.lit(c.column_label).alias("column"), "failing_rows")
            )
    report = reduce(DataFrame.unionByName, parts)
    return report.withColumn("passed", F.col("failing_rows") == 0)
