"""Streams over landed batches: pickup, windows, late data, dedup, interval join, sinks.

Event time is TIMESTAMP inside a stream, because watermarks refuse TIMESTAMP_NTZ;
`stream_time` converts on entry and the operators convert back on output. The
session zone is UTC, so nothing shifts.
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from eventmart.functions.timecols import seconds_interval
from eventmart.operators.dedup import latest_per_key
from eventmart.operators.incremental import LOOKBACK_MINUTES
from eventmart.operators.joins import HotKeys, spread_by_time
from eventmart.plans import silver
from eventmart.plans.bronze import parse_raw
from eventmart.plans.refresh import Warehouse
from eventmart.plans.store import LayerTable
from eventmart.schemas import FAMILIES
from eventmart.session import path_exists
from eventmart.sources.scan import batch_name, SOURCE

CADENCE = "10 seconds"
BatchSink = Callable[[DataFrame, int], None]


def read_family(
    spark: SparkSession,
    directory: str,
    family: str,
    schema: T.StructType | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """Raw rows of a family as batches land, each file exactly once, whatever its name."""
    fam = FAMILIES[family]
    reader = spark.readStream.schema(schema or fam.raw)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(f"{directory}/{fam.glob}").select("*", batch_name(fam).alias(SOURCE))


def stream_time(df: DataFrame, ts: str, late_minutes: int = LOOKBACK_MINUTES) -> DataFrame:
    """Event time as TIMESTAMP with the lookback as its watermark."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, f"{late_minutes} minutes")


def tumbling_counts(
    df: DataFrame, ts: str, keys: list[str], minutes: int = 10, late_minutes: int = LOOKBACK_MINUTES
) -> DataFrame:
    """Rows per tumbling window and key; a window is emitted once it can no longer change."""
    counted = (
        stream_time(df, ts, late_minutes)
        .groupBy(F.window(ts, f"{minutes} minutes").alias("_w"), *keys)
        .agg(F.count(F.lit(1)).alias("n_events"))
    )
    return counted.select(F.col("_w.start").cast("timestamp_ntz").alias("window_start"), *keys, "n_events")


def drop_repeats(df: DataFrame, key: str, ts: str, late_minutes: int = LOOKBACK_MINUTES) -> DataFrame:
    """First row per key within the lookback: for exact repeats, where any copy will do."""
    kept = stream_time(df, ts, late_minutes).dropDuplicatesWithinWatermark([key])
    return kept.withColumn(ts, F.col(ts).cast("timestamp_ntz"))


def interval_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    left_ts: str,
    right_ts: str,
    within_seconds: float,
    take: dict[str, str],
    late_minutes: int = LOOKBACK_MINUTES,
    salts: int = 1,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Stream-stream left outer interval join.

    State is spread over time buckets and, with `salts`, within a bucket. `hot` keys, measured on rows that have
    landed, must stay the same for the life of a checkpoint, as rows in the state were dealt by them. Both watermarks bound the state. A left row without a partner appears only once
    the watermark shows that none can come any more.
    """
    span = seconds_interval(within_seconds)
    side = stream_time(right, right_ts, late_minutes).select(
        *[F.col(k).alias(f"_r_{k}") for k in keys],
        F.col(right_ts).alias("_r_ts"),
        *[F.col(c).alias(f"_t_{name}") for c, name in take.items() if c != right_ts],
    )
    condition = (F.col("_r_ts") >= F.col(left_ts) - span) & (F.col("_r_ts") <= F.col(left_ts) + span)
    for k in keys:
        condition = (F.col(k) == F.col(f"_r_{k}")) & condition
    timed, side, same = spread_by_time(
        stream_time(left, left_ts, late_minutes), side, left_ts, "_r_ts", within_seconds, salts, hot, keys, [f"_r_{k}" for k in keys]
    )
    joined = timed.join(side, same & condition, "leftOuter")
    return joined.select(
        *[F.col(c).cast("timestamp_ntz").alias(c) if c == left_ts else F.col(c) for c in left.columns],
        *[
            F.col("_r_ts").cast("timestamp_ntz").alias(name)
            if c == right_ts
            else F.col(f"_t_{name}").alias(name)
            for c, name in take.items()
        ],
    )


# ---- sinks ------------------------------------------------------------------

_one_writer = threading.Lock()


def newest_wins_sink(table: LayerTable, key: str, order_by: list[str], writer: str) -> BatchSink:
    """Upsert of each micro-batch's newest row per key where the table has no row as new.

    A micro-batch that is replayed after a failure is recognised by its id.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = latest_per_key(batch, key, order_by)

        def newer(stored: DataFrame | None) -> DataFrame:
            """What is newer than the version that the commit replaces."""
            if stored is None:
                return rows
            held = stored.select(F.col(key).alias("_key"), F.struct(*order_by).alias("_held"))
            met = rows.join(held, F.col(key) == F.col("_key"), "left")
            return met.where(F.col("_key").isNull() | (F.struct(*order_by) > F.col("_held"))).drop("_key", "_held")

        table.upsert(newer, key, writer, batch_id)

    return write


def bronze_sink(warehouse: Warehouse, family: str, as_of: datetime | None = None) -> BatchSink:
    """Parse raw rows and upsert them into the family's bronze table."""
    fam = FAMILIES[family]
    table = warehouse.table(fam.table)

    def write(batch: DataFrame, batch_id: int) -> None:
        table.upsert(parse_raw(batch, family, as_of or _now()), fam.key, f"bronze_{family}", batch_id)

    return write


def lookback_sink(warehouse: Warehouse, as_of: datetime | None = None) -> BatchSink:
    """Raw device rows straight to silver, with the exact lookback rule against the table.

    The watermark only approximates that rule: it follows the newest event, while the
    rule follows the newest window stored.
    """
    name = "silver_device_events"
    table = warehouse.table(name)

    def write(batch: DataFrame, batch_id: int) -> None:
        now = as_of or _now()

        def rows(target: DataFrame | None) -> DataFrame:
            return silver.silver_device_events(
                parse_raw(batch, "device", now),
                target=target,
                as_of=now,
                lookback_minutes=warehouse.lookback_minutes,
                bounds=table.bounds("event_window_start", warehouse.lookback_minutes),
            )

        table.upsert(rows, "event_id", name, batch_id)

    return write


def refresh_sink(warehouse: Warehouse, family: str, as_of: datetime | None = None) -> BatchSink:
    """Bronze upsert of the micro-batch, then the silver and gold tables that depend on the family.

    A table whose other inputs are not built yet waits for their sinks. Sinks of one process take turns.
    """
    to_bronze = bronze_sink(warehouse, family, as_of)

    def write(batch: DataFrame, batch_id: int) -> None:
        with _one_writer:
            to_bronze(batch, batch_id)
            warehouse.refresh(None, as_of, layers=("silver", "gold"), family=family)

    return write


# ---- the end of a stream ------------------------------------------------------


def with_heartbeat(df: DataFrame, path: str) -> DataFrame:
    """A stream that also takes heartbeat rows from `path`.

    Windows and unmatched rows wait for later events. Where none will come, `beat` lands a row
    that is later than all, in a batch of its own, and the watermark passes what is held.
    """
    spark = df.sparkSession
    if not path_exists(spark, path):
        spark.createDataFrame([], df.schema).write.parquet(path)
    return df.unionByName(spark.readStream.schema(df.schema).parquet(path))


def beat(spark: SparkSession, path: str, schema: T.StructType, ts: str, at: datetime, values: dict | None = None) -> None:
    """Land one heartbeat row: `ts` is `at`, the columns in `values` are set, all others are NULL.

    It must pass the filters before the watermark, join keys that may not be NULL among them. Nothing comes out for
    it: its own window, and it as an unmatched row, stay ahead of the watermark it makes. Heartbeats
    of two joined inputs lie further apart than the join reaches.
    """
    row = {ts: at, **(values or {})}
    columns = [F.lit(row.get(f.name)).cast(f.dataType).alias(f.name) for f in schema.fields]
    spark.range(1).select(*columns).coalesce(1).write.mode("append").parquet(path)


def beat_after(newest: datetime, reach_seconds: float = 0, late_minutes: int = LOOKBACK_MINUTES) -> datetime:
    """A heartbeat time that lets everything up to `newest` be final: past its window or reach, plus the lateness."""
    return newest + timedelta(seconds=2 * reach_seconds, minutes=2 * late_minutes + 60)


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def start(df: DataFrame, sink: BatchSink, checkpoint: str, cadence: str | None = CADENCE) -> StreamingQuery:
    """Run a stream into a batch sink; `cadence=None` takes what is there and stops."""
    writer = df.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=cadence) if cadence else writer.trigger(availableNow=True)).start()


def drain(df: DataFrame, sink: BatchSink, checkpoint: str) -> None:
    start(df, sink, checkpoint, None).awaitTermination()


def drain_to_files(df: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Run an append-mode stream over what is there into Parquet files and read them back.

    Of several inputs the slowest sets the watermark, so that none loses rows to another.
    """
    df.sparkSession.conf.set("spark.sql.streaming.multipleWatermarkPolicy", "min")
    (
        df.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return df.sparkSession.read.schema(df.schema).parquet(path)
