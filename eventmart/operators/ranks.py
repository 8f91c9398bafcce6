"""Percentile rank with averaged ties, without sorting all rows in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventmart.session import stage

# A value held by at least 1/HOT of all rows is joined by broadcast. At most HOT
# values can be that frequent, which bounds the broadcast whatever the data.
HOT = 1000


def _value_ranks(values: DataFrame, col: str, out: str, scale: float, buckets: int | None) -> tuple[int, DataFrame]:
    """(row count, one row per distinct value with its tie count and percentile)."""
    counts = values.groupBy(col).agg(F.count(F.lit(1)).alias("_ties"))
    # A range of values per partition, as many as the distinct values need unless told.
    ranged = counts.repartitionByRange(buckets, col) if buckets else counts.repartitionByRange(col)
    counts = stage(ranged.withColumn("_bucket", F.spark_partition_id()))
    n = counts.agg(F.coalesce(F.sum("_ties"), F.lit(0))).first()[0]
    # One row per bucket: the only unpartitioned window reads at most `buckets` rows.
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        counts.groupBy("_bucket")
        .agg(F.sum("_ties").alias("_total"))
        .select("_bucket", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_offset"))
    )
    below = Window.partitionBy("_bucket").orderBy(col).rowsBetween(Window.unboundedPreceding, -1)
    placed = counts.withColumn("_below", F.coalesce(F.sum("_ties").over(below), F.lit(0)))
    position = F.col("_offset") + F.col("_below") + (F.col("_ties") + F.lit(1)) / F.lit(2.0)
    ranks = placed.join(F.broadcast(offsets), "_bucket").select(
        col, "_ties", (position / F.lit(float(n)) * F.lit(scale)).alias(out)
    )
    return n, ranks


def pct_rank_avg(
    df: DataFrame, col: str, out: str, scale: float = 100.0, buckets: int | None = None
) -> DataFrame:
    """Average rank of a double column over all rows, as a share of the row count.

    Ties share the mean of their positions; NULL and NaN get NULL and are not
    counted. Rows are counted per distinct value first, so ties never pile up in a
    sort. Distinct values are dealt out by range: each range is ranked on its own and
    shifted by the rows in the ranges before it.
    The input is read several times, so it is staged once.
    """
    df = stage(df)
    ranked = F.col(col).isNotNull() & ~F.isnan(col)
    values = df.where(ranked)
    n, ranks = _value_ranks(values.select(col), col, out, scale, buckets)
    unranked = df.where(~ranked).withColumn(out, F.lit(None).cast("double"))
    if n == 0:
        return unranked
    hot = F.col("_ties") * HOT >= n
    frequent = F.broadcast(ranks.where(hot).select(col, out))
    rest = ranks.where(~hot).select(col, out)
    return (
        values.join(frequent, col)
        .unionByName(values.join(frequent.select(col), col, "left_anti").join(rest, col))
        .unionByName(unranked)
        .select(*df.columns, out)
    )
