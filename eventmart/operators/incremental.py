"""Incremental loading: marks, lookback bounds, change detection and keyed upsert."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.functions.timecols import EPOCH, time_literal

LOOKBACK_MINUTES = 20


@dataclass(frozen=True)
class Bounds:
    """What an incremental run may read, and whether it is incremental at all."""

    incremental: bool
    max_window: datetime
    lower: datetime


FULL_LOAD = Bounds(False, EPOCH, EPOCH)


def high_water(target: DataFrame | None, col: str = "source_filename") -> str:
    """Largest name loaded so far; '' when nothing is."""
    if target is None:
        return ""
    return target.agg(F.coalesce(F.max(col), F.lit("")).alias("mark")).first()["mark"]


def max_or(df: DataFrame, col: str, default: Column, out: str) -> DataFrame:
    """One row: the global maximum of `col`, or the default on an empty input."""
    return df.agg(F.coalesce(F.max(col), default).alias(out))


def is_incremental(target: DataFrame | None, window_col: str) -> bool:
    """A run is incremental when the target exists and already has its window column."""
    return target is not None and window_col in target.columns


def bounds_from_max(max_window: datetime | None, minutes: int = LOOKBACK_MINUTES) -> Bounds:
    newest = max_window or EPOCH
    return Bounds(True, newest, newest - timedelta(minutes=minutes))


def lookback_bounds(
    target: DataFrame | None, window_col: str, minutes: int = LOOKBACK_MINUTES
) -> Bounds:
    """Bounds from the target's newest window, as literals so that they prune the scans."""
    if not is_incremental(target, window_col):
        return FULL_LOAD
    newest = target.agg(F.max(window_col).cast("timestamp_ntz").alias("m")).first()["m"]
    return bounds_from_max(newest, minutes)


def within_lookback(
    df: DataFrame,
    window_col: str,
    bounds: Bounds,
    strict: bool = False,
    date_col: str | None = None,
) -> DataFrame:
    """Rows at or after (strict: after) the lower bound; rows without a window drop out.

    `date_col` is the day of the same timestamp. When the table is partitioned
    by it, the implied day bound skips whole directories.
    """
    window, lower = F.col(window_col), time_literal(bounds.lower)
    kept = df.where(window > lower if strict else window >= lower)
    if date_col is not None and bounds.lower > EPOCH:
        kept = kept.where(F.col(date_col) >= F.lit(bounds.lower.date()))
    return kept


def strict_lookback(
    df: DataFrame, window_col: str, bounds: Bounds, date_col: str | None = None
) -> DataFrame:
    """The final filter of an incremental run: the boundary window itself is left out."""
    if not bounds.incremental:
        return df
    return within_lookback(df, window_col, bounds, strict=True, date_col=date_col)


def new_or_changed(
    batch: DataFrame, target: DataFrame | None, key: str, version: str
) -> DataFrame:
    """Batch rows whose key the target lacks, or holds in an older version."""
    if target is None:
        return batch
    known = target.select(F.col(key).alias("_key"), F.col(version).alias("_version"))
    return (
        batch.join(known, F.col(key) == F.col("_key"), "left")
        .where(F.col("_key").isNull() | (F.col(version) > F.col("_version")))
        .drop("_key", "_version")
    )


def without_keys(target: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Target rows whose key is not among `keys`; rows with a NULL key stay."""
    return target.join(keys.select(key).distinct(), key, "left_anti").select(*target.columns)


def upsert(target: DataFrame | None, batch: DataFrame, key: str) -> DataFrame:
    """Drop target rows whose key the batch holds, then add every batch row.

    Duplicates inside one batch survive; a later layer removes them.
    """
    if target is None:
        return batch
    return without_keys(target, batch, key).unionByName(batch, allowMissingColumns=True)
