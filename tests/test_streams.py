from datetime import datetime, timedelta

from pyspark.sql import functions as F

from eventmart.plans.refresh import Warehouse
from eventmart.plans.store import LayerTable
from eventmart.sources.landing import land_batch
from eventmart.streaming import streams
from eventmart.workload import families as fam

AS_OF = datetime(2024, 1, 30)


def session_rows(spark, *rows):
    return spark.createDataFrame(list(rows), "session_id string, timestamp string, pages_viewed bigint").coalesce(1)


def test_late_smaller_name_is_picked_up_once(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path / "w"))
    stream = lambda: streams.drain(
        streams.read_family(spark, f"{tmp_path}/in", "session"),
        streams.bronze_sink(w, "session", AS_OF),
        f"{tmp_path}/cp",
    )
    land_batch(session_rows(spark, ("a", "2024-01-29T10:00:00+00:00", 1)), f"{tmp_path}/in", "session", "20240129_100010")
    stream()
    land_batch(session_rows(spark, ("b", "2024-01-29T10:00:00+00:00", 1)), f"{tmp_path}/in", "session", "20240129_100000")
    stream()
    stream()
    assert sorted(r["session_id"] for r in w.read("bronze_session_events").collect()) == ["a", "b"]


def test_newest_wins_over_micro_batches(spark, tmp_path):
    table = LayerTable(spark, str(tmp_path / "w"), "s")
    for i, pages in enumerate((1, 2, 3)):
        land_batch(
            session_rows(spark, ("s", f"2024-01-29T10:0{i}:00+00:00", pages), ("s", f"2024-01-29T09:0{i}:00+00:00", 9)),
            f"{tmp_path}/in", "session", f"20240129_10000{i}",
        )
    rows = streams.read_family(spark, f"{tmp_path}/in", "session", max_files=1)
    streams.drain(rows, streams.newest_wins_sink(table, "session_id", ["timestamp"], "s"), f"{tmp_path}/cp")
    assert [r["pages_viewed"] for r in table.read().collect()] == [3]
    assert table.snapshot().batches == {"s": 2}


def test_replayed_micro_batch_changes_nothing(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path / "w"))
    sink = streams.bronze_sink(w, "session", AS_OF)
    batch = session_rows(spark, ("s", "2024-01-29T10:00:00+00:00", 1)).withColumn("source_filename", F.lit("f"))
    for c in ("user_id", "platform", "device_type", "referrer", "landing_page"):
        batch = batch.withColumn(c, F.lit("x"))
    batch = batch.withColumns(
        {"session_duration_seconds": F.lit(1), "interactions": F.lit(1), "is_bounce": F.lit(False)}
    )
    sink(batch, 0)
    version = w.table("bronze_session_events").snapshot().version
    sink(batch.withColumn("pages_viewed", F.lit(99).cast("bigint")), 0)
    assert w.table("bronze_session_events").snapshot().version == version
    assert w.read("bronze_session_events").first()["pages_viewed"] == 1


def test_rows_behind_the_watermark_are_dropped_from_windows(spark, tmp_path):
    """What the lookback leaves out: a window 20 minutes behind the newest event."""
    base = datetime(2024, 1, 29, 10)
    for i, minutes in enumerate([[0, 5, 60], [1, 62], [120]]):
        land_batch(
            session_rows(spark, *[(f"{i}{m}", (base + timedelta(minutes=m)).isoformat(), m) for m in minutes]),
            f"{tmp_path}/in", "session", f"20240129_10000{i}",
        )
        rows = streams.read_family(spark, f"{tmp_path}/in", "session").select(
            F.col("timestamp").cast("timestamp_ntz").alias("ts"), F.lit("x").alias("kind")
        )
        counts = streams.tumbling_counts(rows, "ts", ["kind"])
        out = streams.drain_to_files(counts, f"{tmp_path}/out", f"{tmp_path}/cp")
    got = {(r["window_start"] - base).total_seconds() / 60: r["n_events"] for r in out.collect()}
    assert got == {0: 2, 60: 2}


def test_stream_join_equals_batch_join_where_final(spark, tmp_path, sf_dir):
    from eventmart.operators.joins import interval_join

    ev = fam.events(spark, sf_dir)
    land_batch(fam.raw_device(ev), f"{tmp_path}/in", "device", "20240131_000000")
    rows = lambda: streams.read_family(spark, f"{tmp_path}/in", "device", fam.raw_device(ev).schema).select(
        "event_id", "user_id", F.col("timestamp").alias("ts"), "event_type"
    )
    left, right = rows(), rows().where("event_type = 'click'")
    for salts in (1, 3):
        joined = streams.interval_join(left, right, ["user_id"], "ts", "ts", 900, {"event_id": "m"}, salts=salts)
        out = streams.drain_to_files(joined, f"{tmp_path}/out{salts}", f"{tmp_path}/cp{salts}")
        flat = fam.raw_device(ev).select("event_id", "user_id", F.col("timestamp").alias("ts"), "event_type")
        batch = interval_join(flat, flat.where("event_type = 'click'"), ["user_id"], "ts", "ts", 900, {"event_id": "m"})
        cut = F.lit("2024-01-30 20:00:00").cast("timestamp_ntz")
        a, b = out.where(F.col("ts") < cut), batch.where(F.col("ts") < cut)
        assert a.count() == b.count() and a.exceptAll(b).isEmpty()
        assert out.exceptAll(batch).isEmpty()


def test_drain_with_refresh(spark, sf_dir, tmp_path):
    ev = fam.events(spark, sf_dir)
    w = Warehouse(spark, str(tmp_path / "w"))
    for family, raw in fam.RAW.items():
        land_batch(raw(ev, as_text=True), f"{tmp_path}/in", family, fam.STAMP)
    for family in ("session", "transaction"):
        streams.drain(
            streams.read_family(spark, f"{tmp_path}/in", family),
            streams.bronze_sink(w, family, AS_OF),
            f"{tmp_path}/cp-{family}",
        )
    streams.drain(
        streams.read_family(spark, f"{tmp_path}/in", "device"),
        streams.refresh_sink(w, "device", AS_OF),
        f"{tmp_path}/cp-device",
    )
    assert w.read("gold_platform_events").agg(F.sum("total_events")).first()[0] == w.read("silver_device_events").count()
    assert w.read("gold_user_conversion").count() > 0


def test_a_heartbeat_closes_windows_and_unmatched_rows(spark, tmp_path):
    base = datetime(2024, 1, 29, 10)
    schema = "k string, ts timestamp_ntz, v int"
    late = base + timedelta(minutes=50)
    rows = [("a", base, 1), ("a", base + timedelta(minutes=3), 2), ("b", late, 3), ("a", late, 4), ("c", late, 0)]
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/in")
    source = lambda i: streams.with_heartbeat(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), f"{tmp_path}/beat{i}")
    counted = lambda: streams.drain_to_files(streams.tumbling_counts(source(0), "ts", ["k"]), f"{tmp_path}/o1", f"{tmp_path}/c1")
    join = lambda: streams.interval_join(source(1), source(2).where("v > 1"), ["k"], "ts", "ts", 60, {"v": "w"})
    joined = lambda: streams.drain_to_files(join(), f"{tmp_path}/o2", f"{tmp_path}/c2")
    assert counted().count() == 1 and joined().count() == 4

    def land_beats(hours):
        for i in range(3):
            at = streams.beat_after(late, 60) + timedelta(hours=hours + i)
            streams.beat(spark, f"{tmp_path}/beat{i}", source(i).schema, "ts", at, {"k": "a", "v": 9})

    land_beats(0)
    want = [("a", 1), ("a", 2), ("b", 1), ("c", 1)]
    assert sorted((r["k"], r["n_events"]) for r in counted().collect()) == want
    pairs = [(0, None), (1, None), (2, 2), (3, 3), (4, 4)]
    assert sorted(((r["v"], r["w"]) for r in joined().collect()), key=str) == sorted(pairs, key=str)
    # Landing more heartbeats brings out no row of the input twice.
    land_beats(9)
    assert sorted((r["k"], r["n_events"]) for r in counted().collect() if r["window_start"] <= late) == want
    assert sorted(((r["v"], r["w"]) for r in joined().where("v < 9").collect()), key=str) == sorted(pairs, key=str)
