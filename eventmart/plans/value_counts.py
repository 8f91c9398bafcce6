"""Percentile ranks that are kept up with a stored table instead of counted anew.

A table of `value, n`, cut into ranges of values, follows a layer table: the files that came
and went since the version it has seen are counted, and only the ranges with a changed count are
written again. The number of rows in each range is a mark of the pointer file, so the rows below a
range are known without a scan.

NULL and NaN are not counted. Minus zero counts as zero. An empty table gives no ranks.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventmart.operators.ranks import HOT
from eventmart.plans.store import LayerTable
from eventmart.session import stage, staging

#: Distinct values a range is cut for; a range of four times as many has all ranges cut again.
RANGE_VALUES = 1_000_000
#: Ranges at most; beyond RANGE_VALUES times so many distinct values they get larger.
MOST_RANGES = 1000
_SCHEMA = "value double, n long, in_range long, low double, range int"


class ValueCounts:
    """Counts of one double column of a layer table, under `root`."""

    def __init__(self, spark: SparkSession, root: str, name: str, range_values: int = RANGE_VALUES):
        self.spark = spark
        self.table = LayerTable(spark, root, name, "range", "value", ("in_range", "low"))
        self.range_values = range_values

    # ---- keeping up ----

    def follow(self, source: LayerTable, column: str) -> list[int] | None:
        """Bring the counts to the newest version of `source`. The ranges written, or None for all.

        The version is noted with the counts in one commit, so a run that fails is simply repeated.
        """
        newest = source.versions()[-1]
        held = self.table.snapshot()
        since = held.batches.get(source.name) if held else None
        if since == newest:
            return []
        with staging(self.spark):
            if since not in source.versions():  # never seen, or expired
                counted = _counted(source.read(), column, 1)
                self._cut(stage(counted.groupBy("value").agg(F.sum("n").alias("n"))), {source.name: newest})
                return None
            sides = [_counted(df, column, sign) for sign, df in zip((1, -1), source.difference(since, [column])) if df is not None]
            both = reduce(DataFrame.unionByName, sides, self.spark.createDataFrame([], "value double, n long"))
            delta = both.groupBy("value").agg(F.sum("n").alias("n")).where("n <> 0")
            ranges = self._ranges(held)
            if not ranges:
                self._cut(stage(delta), {source.name: newest})
                return None
            delta = stage(_placed(delta, ranges))
            touched = sorted(r["range"] for r in delta.select("range").distinct().collect())  # MOST_RANGES at most
            if not touched:
                self.table.replace_days(self.spark.createDataFrame([], _SCHEMA), [], {source.name: newest})
                return touched
            parts = [str(i) for i in touched]
            stored = self.table.read_days(parts)
            columns = ["value", "n", "low", "range"]
            merged = stored.select(*columns).unionByName(delta.select(*columns))
            merged = merged.groupBy("value", "low", "range").agg(F.sum("n").alias("n")).where("n <> 0")
            self.table.replace_days(_with_totals(merged), parts, {source.name: newest})
            after = self.table.snapshot()
            if max((e["rows"] for e in after.entries), default=0) > 4 * self.range_values and len(ranges) < MOST_RANGES:
                self._cut(stage(self.table.read().select("value", "n")), {source.name: newest})
                return None
        return touched

    def _cut(self, counts: DataFrame, made_from: dict[str, int]) -> None:
        """Store all counts in ranges of about as many distinct values each."""
        distinct = counts.count()
        ranges = min(MOST_RANGES, max(1, math.ceil(distinct / self.range_values)))
        steps = [i / ranges for i in range(1, ranges)]
        inner = counts.approxQuantile("value", steps, 0.1 / ranges) if steps and distinct else []
        lows = sorted({-math.inf, *inner})
        self.table.replace(_with_totals(_placed(counts, [(low, i) for i, low in enumerate(lows)])), made_from)

    def _ranges(self, held) -> list[tuple[float, int]]:
        """(lowest value, number) of the stored ranges, in order; the first one takes all that lies below it."""
        found = sorted({(float(e["marks"]["low"].replace("Infinity", "inf")), int(e["part"])) for e in held.entries})
        return [(-math.inf, found[0][1]), *found[1:]] if found else []

    # ---- ranks ----

    def ranks(self, out: str, scale: float = 100.0) -> tuple[int, DataFrame]:
        """(rows counted, `value, n, out`): the average rank of each value as a share of all rows.

        Reads the distinct values once. What lies below a range comes from the pointer file.
        """
        held = self.table.snapshot()
        sizes = {int(e["part"]): int(e["marks"]["in_range"]) for e in held.entries} if held else {}
        total, offsets = 0, []
        for _, number in self._ranges(held) if held else []:
            offsets.append((number, total))
            total += sizes[number]
        stored = self.table.read() if sizes else self.spark.createDataFrame([], _SCHEMA)
        below = Window.partitionBy("range").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
        placed = stored.withColumn("_below", F.coalesce(F.sum("n").over(below), F.lit(0)))
        # A row per range, MOST_RANGES at most.
        starts = F.broadcast(self.spark.createDataFrame(offsets, "range int, _offset long"))
        position = F.col("_offset") + F.col("_below") + (F.col("n") + F.lit(1)) / F.lit(2.0)
        share = (position / F.lit(float(max(total, 1))) * F.lit(scale)).alias(out)
        return total, placed.join(starts, "range").select("value", "n", share)

    def ranked(self, df: DataFrame, column: str, out: str, scale: float = 100.0) -> DataFrame:
        """Rows of the table that the counts follow, with the percentile of `column`; NULL and NaN get NULL.

        Frequent values, `HOT` at most, are joined by broadcast, so a tie of any size stays where it is.
        """
        total, ranks = self.ranks("_rank", scale)
        ranks = stage(ranks)
        rows = df.withColumn("_value", _plain(F.col(column)))
        hot = F.col("n") * HOT >= total
        frequent = ranks.where(hot).select(F.col("value").alias("_value"), F.col("_rank").alias("_hot_rank"))
        rest = ranks.where(~hot).select(F.col("value").alias("_value"), "_rank")
        met = rows.join(F.broadcast(frequent), "_value", "left")
        # A row that has its rank leaves the key of the second join empty, which a hash of the row spreads.
        done = F.col("_hot_rank").isNotNull() | F.col("_value").isNull()
        names = df.columns
        return (
            met.where(done).select(*names, F.col("_hot_rank").alias(out))
            .unionByName(met.where(~done).join(rest, "_value", "left").select(*names, F.col("_rank").alias(out)))
        )


def _plain(value: Column) -> Column:
    """NULL for NaN; adding zero turns minus zero into zero."""
    return F.when(~F.isnan(value), value.cast("double") + F.lit(0.0))


def _counted(df: DataFrame, column: str, sign: int) -> DataFrame:
    values = df.select(_plain(F.col(column)).alias("value")).where("value IS NOT NULL")
    return values.groupBy("value").agg((F.count(F.lit(1)) * F.lit(sign)).alias("n"))


def _placed(counts: DataFrame, ranges: list[tuple[float, int]]) -> DataFrame:
    """Adds the range of each value: the one with the largest `low` that is not above it."""
    known = F.array(*[F.struct(F.lit(low).alias("low"), F.lit(number).alias("range")) for low, number in ranges])
    own = F.array_max(F.filter(known, lambda r: r["low"] <= F.col("value")))
    return counts.withColumn("_own", own).select("value", "n", "_own.low", "_own.range")


def _with_totals(counts: DataFrame) -> DataFrame:
    """Adds the rows in each range, from one row per range."""
    per_range = F.broadcast(counts.groupBy("range").agg(F.sum("n").alias("in_range")))
    return counts.join(per_range, "range").select("value", "n", "in_range", "low", "range")
