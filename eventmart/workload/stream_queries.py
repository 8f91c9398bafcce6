"""Registered streaming queries: each drains a stream over the given tables."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.functions.timecols import time_literal
from eventmart.plans import checks
from eventmart.plans.bronze import parse_raw
from eventmart.plans.check_state import CheckState
from eventmart.plans.refresh import Warehouse
from eventmart.plans.store import LayerTable
from eventmart.plans.value_counts import ValueCounts
from eventmart.session import shared_path
from eventmart.sources.landing import land_batch
from eventmart.sources.scan import SOURCE
from eventmart.streaming import streams
from eventmart.workload import families as fam
from eventmart.workload.oracle import AS_OF as SQL_AS_OF
from eventmart.workload.queries import ORACLE, REPEAT, SPLIT, money_rounded, query

_AS_OF = datetime.fromisoformat(fam.AS_OF)
_LOADED = datetime.fromisoformat(fam.LOADED_AT)


def _event_stream(spark, sf_dir) -> DataFrame:
    """The `events` table as a stream, whether it is one file or a folder of files."""
    schema = fam.table(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")


def _closed(spark, sf_dir, build, work, beats) -> DataFrame:
    """Land heartbeats later than all `events` and drain a stream over both.

    One drain takes the events and the heartbeats in one batch: none is late, as a watermark moves after its
    batch, and the batch without data that follows brings out what they close. State is written twice.
    `build` makes the stream from the inputs, one for each heartbeat: its column values.
    """
    events = fam.table(spark, sf_dir, "events")
    paths = [f"{work}/heartbeat{i}" for i in range(len(beats))]
    newest = events.agg(F.max("ts").cast("timestamp_ntz")).first()[0]
    for i, (path, values) in enumerate(zip(paths, beats) if newest is not None else ()):
        # Hours apart, so that no heartbeat is a partner of another.
        streams.beat(spark, path, events.schema, "ts", streams.beat_after(newest) + timedelta(hours=i), values)
    inputs = [streams.with_heartbeat(_event_stream(spark, sf_dir), path) for path in paths]
    return streams.drain_to_files(build(*inputs), f"{work}/out", f"{work}/checkpoint")


@query(
    """SELECT window_start, event_type, COUNT(*) AS n_events FROM (
      SELECT event_type, date_trunc('minute', ts) - to_minutes(CAST(EXTRACT(minute FROM ts) AS BIGINT) % 10) AS window_start FROM events)
    GROUP BY ALL"""
)
def stream_tumbling(spark, sf_dir):
    """Every window; the heartbeat closes the last ones."""
    work = shared_path(spark, "stream")
    return _closed(spark, sf_dir, lambda rows: streams.tumbling_counts(rows, "ts", ["event_type"]), work, [{}])


@query(
    """SELECT a.event_id, a.user_id, a.ts, b.event_id AS partner_id
    FROM events a LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') b
      ON a.user_id = b.user_id AND b.ts BETWEEN a.ts - INTERVAL 5 MINUTE AND a.ts + INTERVAL 5 MINUTE"""
)
def stream_interval_join(spark, sf_dir):
    """Every matched and every unmatched row; heartbeats of both inputs make the last unmatched ones final."""
    work = shared_path(spark, "stream")

    def build(rows, others):
        bought = others.where(F.col("event_type") == "purchase")
        return streams.interval_join(
            rows.select("event_id", "user_id", "ts"), bought, ["user_id"], "ts", "ts", 300, {"event_id": "partner_id"}
        )

    return _closed(spark, sf_dir, build, work, [{"user_id": 0}, {"user_id": 0, "event_type": "purchase"}])


@query("SELECT event_id, user_id, event_type, event_timestamp FROM device_latest", ("device_latest",))
def stream_dedup_upsert(spark, sf_dir):
    """Three drains of one stream: the second brings reloaded rows, which replace the first, the third older copies, which do not."""
    work = shared_path(spark, "stream")
    ev = fam.events(spark, sf_dir)
    table = LayerTable(spark, work, "device", "event_date", "event_window_start")
    warehouse_rows = [
        (ev, "20240131_000000", None),
        (ev.where(F.col("event_id") % 10 == 0), "20240131_010000", F.lit("click")),
        (ev.where(F.col("event_id") % 4 == 0), "20240130_000000", F.lit("scroll")),
    ]
    for rows, stamp, kind in warehouse_rows:
        raw = fam.raw_device(rows, as_text=True)
        land_batch(raw.withColumn("event_type", kind) if kind is not None else raw, f"{work}/in", "device", stamp)
        bronze = parse_raw(streams.read_family(spark, f"{work}/in", "device"), "device", fam.LOADED_AT)
        sink = streams.newest_wins_sink(table, "event_id", [SOURCE, "event_timestamp"], "dedup")
        streams.drain(bronze, sink, f"{work}/checkpoint")
    return table.read().select("event_id", "user_id", "event_type", "event_timestamp")


_BATCH = "CAST(floor(CAST(substr(transaction_id, 5) AS BIGINT) / 4) AS BIGINT) % 3"


@query(
    f"""SELECT * EXCLUDE (source_filename), 'transaction_events_2024013' || ({_BATCH}) || '_000000.parquet' AS source_filename
    FROM bronze_transaction""",
    ("bronze_transaction",),
)
def stream_ingest(spark, sf_dir):
    """Batches landing in falling name order between drains: all are picked up, each once."""
    work = shared_path(spark, "stream")
    ev = fam.events(spark, sf_dir)
    warehouse = Warehouse(spark, work)
    for i in (2, 1, 0):
        part = ev.where(F.pmod(F.floor(F.col("event_id") / 4), F.lit(3)) == i)
        land_batch(fam.raw_transaction(part, as_text=True), f"{work}/in", "transaction", f"2024013{i}_000000")
        streams.drain(
            streams.read_family(spark, f"{work}/in", "transaction"),
            streams.bronze_sink(warehouse, "transaction", _LOADED),
            f"{work}/checkpoint",
        )
    return warehouse.read("bronze_transaction_events")


@query("SELECT CAST(event_id AS VARCHAR) AS event_id, ts FROM events")
def stream_drop_repeats(spark, sf_dir):
    """Every row landed twice; each comes out once."""
    work = shared_path(spark, "stream")
    raw = fam.raw_device(fam.events(spark, sf_dir))
    for stamp in ("20240131_000000", "20240131_000010"):
        land_batch(raw, f"{work}/in", "device", stamp)
    rows = streams.read_family(spark, f"{work}/in", "device", raw.schema).select(
        "event_id", F.col("timestamp").alias("ts")
    )
    return streams.drain_to_files(
        streams.drop_repeats(rows, "event_id", "ts"), f"{work}/out", f"{work}/checkpoint"
    )


@query(
    f"""SELECT * EXCLUDE (source_filename, loaded_at), {SQL_AS_OF} AS loaded_at
    FROM bronze_device WHERE event_timestamp <= {SQL_AS_OF} AND event_timestamp >= {SQL_AS_OF} - INTERVAL 30 DAY""",
    ("bronze_device",),
)
def stream_lookback(spark, sf_dir):
    """Raw to silver by micro-batch, each against the lookback of the table so far."""
    work = shared_path(spark, "stream")
    ev = fam.events(spark, sf_dir)
    warehouse = Warehouse(spark, work)
    split = time_literal(fam.SPLIT_AT)
    for part, stamp in (
        (ev.where(F.col("ts") < split), "20240131_000000"),
        (ev.where(F.col("ts") >= split), "20240131_000010"),
    ):
        land_batch(fam.raw_device(part, as_text=True), f"{work}/in", "device", stamp)
        streams.drain(
            streams.read_family(spark, f"{work}/in", "device"),
            streams.lookback_sink(warehouse, _AS_OF),
            f"{work}/checkpoint",
        )
    return warehouse.read("silver_device_events")


@query("SELECT * FROM gold_conversion", ("gold_conversion",))
def refresh_layers(spark, sf_dir):
    """All three families landed, then bronze, silver and gold built from the files."""
    work = shared_path(spark, "refresh")
    ev = fam.events(spark, sf_dir)
    for family, raw in fam.RAW.items():
        land_batch(raw(ev, as_text=True), f"{work}/in", family, fam.STAMP)
    warehouse = Warehouse(spark, work)
    warehouse.refresh(f"{work}/in", _AS_OF)
    return money_rounded(warehouse.read("gold_user_conversion"))


@query("SELECT * FROM gold_conversion", ("gold_conversion",))
def refresh_stream(spark, sf_dir):
    """A sink for each family, transactions first: each builds what its inputs allow."""
    work = shared_path(spark, "refresh")
    ev = fam.events(spark, sf_dir)
    warehouse = Warehouse(spark, work)
    for family in ("transaction", "session", "device"):
        land_batch(fam.RAW[family](ev, as_text=True), f"{work}/in", family, fam.STAMP)
        sink = streams.refresh_sink(warehouse, family, _AS_OF)
        streams.drain(streams.read_family(spark, f"{work}/in", family), sink, f"{work}/checkpoint-{family}")
    return money_rounded(warehouse.read("gold_user_conversion"))


@query(
    """SELECT 'unique' AS "check", 'event_id' AS "column", count(*) AS failing_rows FROM events WHERE event_id % 10 = 0
    UNION ALL SELECT 'accepted_values', 'event_type', count(*) FROM events WHERE event_id % 10 = 0"""
)
def refresh_reports(spark, sf_dir):
    """The failed checks of a bronze build from batches with repeated keys and unknown event types."""
    work = shared_path(spark, "refresh")
    ev = fam.events(spark, sf_dir)
    for family, raw in fam.RAW.items():
        land_batch(raw(ev, as_text=True), f"{work}/in", family, fam.STAMP)
    odd = fam.raw_device(ev.where(F.col("event_id") % 10 == 0), as_text=True).withColumn("event_type", F.lit("hover"))
    land_batch(odd, f"{work}/in", "device", "20240131_010000")
    reports = Warehouse(spark, work).refresh(f"{work}/in", _AS_OF, layers=("bronze",))
    failed = reports["bronze_device_events"].where(~F.col("passed"))
    return failed.select("check", "column", "failing_rows")


@query(
    f"""SELECT event_id, user_id, event_type, loaded_at FROM bronze_device
      WHERE event_timestamp < {SPLIT} AND CAST(event_id AS BIGINT) NOT IN (SELECT CAST(event_id AS BIGINT) FROM bronze_device WHERE event_timestamp >= {REPEAT})
    UNION ALL SELECT event_id, user_id, event_type, loaded_at + INTERVAL 2 HOUR FROM bronze_device WHERE event_timestamp >= {REPEAT}""",
    ("bronze_device",),
)
def upsert_stored(spark, sf_dir):
    """Two upserts into a stored table, and the second once more, which must publish nothing."""
    columns = ["event_id", "user_id", "event_type", "loaded_at"]
    rows = fam.bronze(fam.events(spark, sf_dir), "device").select(*columns, "event_date", "event_timestamp")
    later = rows.where(F.col("event_timestamp") >= time_literal(fam.REPEAT_FROM))
    later = later.withColumn("loaded_at", F.col("loaded_at") + F.expr("INTERVAL 2 HOURS"))
    table = LayerTable(spark, shared_path(spark, "store"), "device", "event_date", "event_id")
    table.upsert(rows.where(F.col("event_timestamp") < time_literal(fam.SPLIT_AT)), "event_id")
    version = table.upsert(later, "event_id")
    if table.upsert(later, "event_id") != version:
        raise AssertionError("an upsert without a change published a version")
    return table.read().select(*columns)


@query("SELECT platform, user_id, customer_segment FROM gold_conversion", ("gold_conversion",))
def catalog_conversion(spark, sf_dir):
    """A mart by its name in the catalog, as another session sees it after the refresh."""
    work = shared_path(spark, "refresh")
    ev = fam.events(spark, sf_dir)
    for family, raw in fam.RAW.items():
        land_batch(raw(ev, as_text=True), f"{work}/in", family, fam.STAMP)
    Warehouse(spark, work, catalog=True).refresh(f"{work}/in", _AS_OF)
    return spark.newSession().sql("SELECT platform, user_id, customer_segment FROM gold.gold_user_conversion")


@query(ORACLE["pct_rank_avg"])
def pct_rank_kept(spark, sf_dir):
    """Percentiles from counts that follow a stored table through three increments, the last of which corrects values."""
    work = shared_path(spark, "ranks")
    rows = fam.events(spark, sf_dir).select("event_id", "value", F.to_date("ts").alias("event_date"), "ts")
    early, odd = F.col("ts") < time_literal(fam.SPLIT_AT), F.col("event_id") % 10 == 0
    wrong = rows.withColumn("value", F.when(odd, F.col("value") + 1).otherwise(F.col("value")))
    table = LayerTable(spark, work, "values", "event_date", "event_id")
    counts = ValueCounts(spark, work, "value_counts")
    for batch in (wrong.where(early), wrong.where(~early), rows.where(odd)):
        table.upsert(batch.drop("ts"), "event_id")
        counts.follow(table, "value")
    return counts.ranked(table.read(), "value", "pct").select("event_id", "value", "pct")


@query(ORACLE["check_suite_bronze_device"])
def check_suite_kept(spark, sf_dir):
    """A suite on two commits: the second report looks at the files that changed. Copies of a key come in one batch."""
    work = shared_path(spark, "checks")
    bronze = fam.bronze_device_with_copies(fam.events(spark, sf_dir))
    table = LayerTable(spark, work, "device", "event_date", "event_id")
    early = F.col("event_timestamp") < time_literal(fam.SPLIT_AT)
    for batch in (bronze.where(early), bronze.where(~early)):
        table.upsert(batch, "event_id")
        report = CheckState(table, "event_id", checks.BRONZE_DEVICE, f"{work}/state").report()
    return report
