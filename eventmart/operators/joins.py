"""Interval join and the two metric joins."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.functions.timecols import micros_since_epoch, seconds_interval


def _bucket(micros: Column, width: int) -> Column:
    """Floor division that also holds for times before the epoch."""
    return F.call_function("div", micros - F.pmod(micros, F.lit(width)), F.lit(width))


#: A hot key is dealt to at most so many tasks.
MOST_SALTS = 1024


@dataclass(frozen=True)
class HotKeys:
    """Which keys of an interval join hold too many rows of one time bucket, by hash: {shares to deal them to: hashes}.

    Two keys of one hash are dealt alike, which costs a few copies and changes no result.
    """

    tiers: dict[int, tuple[int, ...]]

    def salts(self, hashed: Column) -> Column:
        out = F.lit(1)
        for salts, hashes in self.tiers.items():
            out = F.when(hashed.isin(list(hashes)), F.lit(salts)).otherwise(out)
        return out.cast("bigint")


def hot_keys(df: DataFrame, keys: list[str], ts: str, within_seconds: float, tasks: int) -> HotKeys:
    """The keys that, in one time bucket, hold more than half a task's even share of the rows.

    One pass with a sketch of frequent items, whose size follows the number of tasks and not the data; there can be
    at most twice as many such keys as tasks, and those that the sketch overrates are only dealt out in vain.
    """
    width = _width(within_seconds)
    place = F.xxhash64(*keys, _bucket(micros_since_epoch(ts), width))
    most = min(4 * tasks, 10_000)
    tracked = 1 << max(10, math.ceil(math.log2(16 * most)))
    found = df.select(place.alias("place")).agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(place, {most}, {tracked})").alias("top")
    )
    row = found.first()  # `most` entries
    tiers: dict[int, list[int]] = {}
    for item in row["top"] or []:
        shares = 2 * tasks * item["count"] / row["n"]
        if shares > 1:
            tiers.setdefault(min(1 << math.ceil(math.log2(shares)), MOST_SALTS), []).append(item["item"])
    return HotKeys({salts: tuple(sorted(hashes)) for salts, hashes in sorted(tiers.items())})


def _width(within_seconds: float) -> int:
    """Microseconds in a time bucket: four intervals."""
    return max(4 * round(within_seconds * 1_000_000), 1)  # as the interval of the condition is rounded


def _hashable(left: DataFrame, left_keys: list[str], right: DataFrame, right_keys: list[str]) -> None:
    """Equal keys must have equal hashes on both sides."""
    for a, b in zip(left_keys, right_keys):
        one, other = left.schema[a].dataType.typeName(), right.schema[b].dataType.typeName()
        if one != other or one in ("double", "float", "decimal"):
            raise ValueError(f"hot keys need one exact type on both sides, {a} is {one} and {other}")


def spread_by_time(
    left: DataFrame,
    right: DataFrame,
    left_ts: str,
    right_ts: str,
    within_seconds: float,
    salts: int = 1,
    hot: HotKeys | None = None,
    left_keys: list[str] | None = None,
    right_keys: list[str] | None = None,
) -> tuple[DataFrame, DataFrame, Column]:
    """Both sides with an extra equality for an interval join, and that equality.

    Time buckets are four intervals wide. A left row lies in exactly one bucket, a
    right row goes to the one or two buckets its interval touches, so each pair meets
    once and a heavy user spreads over time. With `salts` above one, left rows of a
    bucket spread further over that many shares, each facing a copy of the right rows.
    With `hot` only the keys named there are spread, each as far as it needs; the keys' names on both sides go with it.
    """
    reach = round(within_seconds * 1_000_000)
    width = _width(within_seconds)
    at = micros_since_epoch(right_ts)
    buckets = F.sequence(_bucket(at - F.lit(reach), width), _bucket(at + F.lit(reach), width))
    right = right.withColumn("_r_bucket", F.explode(buckets))
    whole = F.xxhash64(*left.columns)
    left_salt = F.pmod(whole, F.lit(salts)) if salts > 1 else None
    last = F.lit(salts - 1).cast("bigint")
    if hot is not None and hot.tiers:
        _hashable(left, left_keys, right, right_keys)
        left_salt = F.pmod(whole, hot.salts(F.xxhash64(*left_keys, F.col("_bucket"))))
        last = hot.salts(F.xxhash64(*right_keys, F.col("_r_bucket"))) - F.lit(1)
    left = left.withColumn("_bucket", _bucket(micros_since_epoch(left_ts), width))
    same = F.col("_bucket") == F.col("_r_bucket")
    if left_salt is not None:
        left = left.withColumn("_salt", left_salt)
        right = right.withColumn(
            "_r_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), last))
        )
        same = same & (F.col("_salt") == F.col("_r_salt"))
    return left, right, same


def interval_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    left_ts: str,
    right_ts: str,
    within_seconds: float,
    take: dict[str, str],
    salts: int = 1,
    how: str = "left",
    hot: HotKeys | None = None,
) -> DataFrame:
    """Left rows with every right row of equal keys at most `within_seconds` away.

    Both ends are inclusive and fractions of a second count. `take` maps the
    right columns to carry to their output names.

    A plain equi-join on `keys` would compare everything one user ever did with
    everything else of that user in one task, so time is part of the join keys (see
    `spread_by_time`). Adaptive execution splits a bucket that is still too large;
    `salts` does so without it, and `hot` (see `hot_keys`) only for the keys that need it.
    """
    span = seconds_interval(within_seconds)
    columns = left.columns
    side = right.select(
        *[F.col(k).alias(f"_r_{k}") for k in keys],
        F.col(right_ts).alias("_r_ts"),
        *[F.col(c).alias(f"_t_{name}") for c, name in take.items()],
    )
    condition = F.col("_r_ts").between(F.col(left_ts) - span, F.col(left_ts) + span)
    for k in keys:
        condition = (F.col(k) == F.col(f"_r_{k}")) & condition
    right_keys = [f"_r_{k}" for k in keys]
    left, side, same = spread_by_time(left, side, left_ts, "_r_ts", within_seconds, salts, hot, keys, right_keys)
    return left.join(side, same & condition, how).select(
        *columns, *[F.col(f"_t_{name}").alias(name) for name in take.values()]
    )


def full_outer_merge(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer join that coalesces the keys and flags which sides were present.

    Adds `in_left` and `in_right`, true when the side's first key is not NULL. NULL
    keys never match. All other column names must differ between the sides.
    """
    condition = None
    for k in keys:
        equal = left[k] == right[k]
        condition = equal if condition is None else condition & equal
    joined = left.join(right, condition, "full")
    return joined.select(
        *[F.coalesce(left[k], right[k]).alias(k) for k in keys],
        left[keys[0]].isNotNull().alias("in_left"),
        right[keys[0]].isNotNull().alias("in_right"),
        *[left[c] for c in left.columns if c not in keys],
        *[right[c] for c in right.columns if c not in keys],
    )


def left_merge(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Many-to-one enrichment: every left row, with the right side's columns or NULL."""
    return left.join(right, key, "left")
