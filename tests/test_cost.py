"""Work that queries on large tables need not do."""

import os

from eventmart.operators.quality import not_null, unique
from eventmart.plans import check_state
from eventmart.plans.store import LayerTable
from eventmart.sources.drift import scan_by_schema
from eventmart.workload import stream_queries

ROWS = [("a", "2024-01-01 00:00:00"), ("b", "2024-01-01 00:04:00"), ("c", "2024-01-01 02:00:00")]


def _events(spark, path):
    rows = [(i, ts, 7, "purchase" if name == "b" else "view", 1.0, '{"k": 1}') for i, (name, ts) in enumerate(ROWS)]
    schema = "event_id long, ts string, user_id long, event_type string, value double, props string"
    df = spark.createDataFrame(rows, schema)
    df.withColumn("ts", df.ts.cast("timestamp_ntz")).write.parquet(f"{path}/events.parquet")


def test_a_closed_stream_writes_its_state_twice(spark, tmp_path, monkeypatch):
    """Events and heartbeats in one batch, and one without data: every row comes out of two commits."""
    _events(spark, str(tmp_path))
    monkeypatch.setattr(stream_queries, "shared_path", lambda spark, label: f"{tmp_path}/{label}")
    rows = stream_queries.stream_interval_join(spark, str(tmp_path)).select("event_id", "partner_id").collect()
    assert sorted((r[0], r[1]) for r in rows if r[1] is not None) == [(0, 1), (1, 1)]
    assert sorted(r[0] for r in rows if r[1] is None) == [2]
    commits = os.listdir(f"{tmp_path}/stream/checkpoint/commits")
    assert sorted(name for name in commits if name.isdigit()) == ["0", "1"]


def test_a_report_does_not_store_the_files_again(spark, tmp_path, monkeypatch):
    table = LayerTable(spark, str(tmp_path), "t", "day", "id")
    rows = spark.createDataFrame([("a", 1), ("a", None), ("b", 2)], "id string, v int").selectExpr("*", "DATE'2024-01-01' AS day")
    table.upsert(rows, "id")
    stored = []
    kept = check_state.stage
    monkeypatch.setattr(check_state, "stage", lambda df: stored.append(df) or kept(df))
    report = check_state.CheckState(table, "id", [unique("id"), not_null("v")], f"{tmp_path}/state").report()
    assert {(r["check"], r["failing_rows"]) for r in report.collect()} == {("unique", 1), ("not_null", 1)}
    assert stored == []


def test_a_first_load_takes_the_batch_name_once(spark, tmp_path):
    """Without a mark no row is compared with it; with one, only later batches are read."""
    for stamp in ("20240101_000000", "20240102_000000"):
        spark.createDataFrame([(stamp,)], "event_id string").write.parquet(f"{tmp_path}/device_events_{stamp}.parquet")
    (first,) = scan_by_schema(spark, str(tmp_path), "device")
    assert first._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract") == 1
    assert first.count() == 2
    (later,) = scan_by_schema(spark, str(tmp_path), "device", "device_events_20240101_000000.parquet")
    assert [r["event_id"] for r in later.collect()] == ["20240102_000000"]
