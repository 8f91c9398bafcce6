import statistics

import pytest
from pyspark.sql import functions as F

from eventmart.operators.joins import hot_keys, interval_join, spread_by_time


def logs(spark, n, name):
    """A third of the rows from one user within minutes, the others spread."""
    user = F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 997)
    at = F.when(F.col("id") % 3 == 0, F.col("id") % 600).otherwise((F.col("id") * 131) % 86_400)
    ts = F.timestamp_seconds(F.lit(1_700_000_000) + at).cast("timestamp_ntz")
    return spark.range(n).select(F.col("id").alias(name), user.cast("bigint").alias("user_id"), ts.alias("ts"))


def test_only_the_hot_key_is_dealt_out(spark):
    left = logs(spark, 30_000, "a")
    hot = hot_keys(left, ["user_id"], "ts", 600, tasks=8)
    assert [len(h) for h in hot.tiers.values()] == [1]
    right = logs(spark, 300, "b").select(F.col("user_id").alias("_r_user_id"), F.col("ts").alias("_r_ts"), "b")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        one, other, _ = spread_by_time(left, right, "ts", "_r_ts", 600, 1, hot, ["user_id"], ["_r_user_id"])
        tasks = one.repartition(8, "user_id", "_bucket", "_salt").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    sizes = [r["count"] for r in tasks]
    assert max(sizes) <= 3 * statistics.median(sizes)
    copies = other.where("_r_user_id <> -1").groupBy("b", "_r_bucket").count().agg(F.max("count")).first()[0]
    assert copies == 1


def test_dealt_out_keys_change_no_result(spark):
    left, right = logs(spark, 3_000, "a"), logs(spark, 200, "b")
    odd = spark.createDataFrame([(-1, None, None), (-2, 5, None), (-3, None, 1)], "a bigint, user_id bigint, at bigint")
    left = left.unionByName(odd.select("a", "user_id", F.timestamp_seconds("at").cast("timestamp_ntz").alias("ts")))
    left = left.unionByName(left.where("a < 9"))  # repeated rows
    hot = hot_keys(left, ["user_id"], "ts", 60, tasks=64)
    assert hot.tiers
    plain = interval_join(left, right, ["user_id"], "ts", "ts", 60, {"b": "b"})
    dealt = interval_join(left, right, ["user_id"], "ts", "ts", 60, {"b": "b"}, hot=hot)
    assert plain.exceptAll(dealt).isEmpty() and dealt.exceptAll(plain).isEmpty()


def test_no_rows_and_keys_of_unlike_type(spark):
    left, right = logs(spark, 300, "a"), logs(spark, 30, "b")
    assert hot_keys(left.limit(0), ["user_id"], "ts", 60, 8).tiers == {}
    hot = hot_keys(left, ["user_id"], "ts", 600, 8)
    with pytest.raises(ValueError):
        interval_join(left, right.withColumn("user_id", F.col("user_id").cast("int")), ["user_id"], "ts", "ts", 60, {"b": "b"}, hot=hot)
