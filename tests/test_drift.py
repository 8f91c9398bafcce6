"""Loading batches whose files differ in schema."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from eventmart.plans.bronze import load
from eventmart.plans.refresh import Warehouse
from eventmart.sources.drift import scan_by_schema
from eventmart.sources.footers import footer_schemas, schema_ranges
from eventmart.sources.landing import land_batch
from eventmart.sources.scan import family_files, schema_union

AT = "2024-01-29T10:00:00+00:00"


def land(spark, directory, stamp, schema, *rows, family="transaction"):
    land_batch(spark.createDataFrame(list(rows), schema).coalesce(1), str(directory), family, stamp)


def test_numbers_text_and_absent_columns_fit_the_declared_types(spark, tmp_path):
    land(spark, tmp_path, "20240101_000000", "transaction_id string, timestamp string, quantity bigint", ("a", AT, 2))
    land(spark, tmp_path, "20240101_000001", "quantity double, transaction_id string, timestamp string", (3.0, "b", AT), (2.5, "c", AT), (float("nan"), "d", AT))
    land(spark, tmp_path, "20240101_000002", "transaction_id string, quantity string, is_first_purchase string", ("e", "7", "true"), ("f", "many", "?"))
    land(spark, tmp_path, "20240101_000003", "transaction_id bigint, timestamp timestamp_ntz, quantity int, extra string", (9, datetime(2024, 1, 1, 5), 1, "x"))
    rows = {r["transaction_id"]: r for r in load(spark, str(tmp_path), "transaction", as_of="2024-01-31 00:00:00").collect()}
    assert {k: r["quantity"] for k, r in rows.items()} == {"a": 2, "b": 3, "c": None, "d": None, "e": 7, "f": None, "9": 1}
    assert rows["e"]["is_first_purchase"] is True and rows["f"]["is_first_purchase"] is None
    assert rows["9"]["transaction_timestamp"] == datetime(2024, 1, 1, 5) and rows["e"]["transaction_timestamp"] is None
    assert rows["a"]["source_filename"] == "transaction_events_20240101_000000.parquet" and "extra" not in rows["9"].asDict()
    later = load(spark, str(tmp_path), "transaction", mark="transaction_events_20240101_000001.parquet")
    assert {r["transaction_id"] for r in later.collect()} == {"e", "f", "9"}
    assert load(spark, str(tmp_path), "transaction", mark="transaction_events_3").count() == 0


def test_payload_as_struct_and_as_text(spark, tmp_path):
    base = "event_id string, timestamp string, "
    land(spark, tmp_path, "20240101_000000", base + "payload struct<browser:string,location:struct<latitude:int>>", ("a", AT, ("Edge", (5,))), ("n", AT, None), family="device")
    texts = [("b", AT, '{"browser": "Safari", "performance": {"page_load_time_ms": "slow", "network_type": "4G"}}'), ("c", AT, "no json"), ("d", AT, None)]
    land(spark, tmp_path, "20240101_000001", base + "payload string", *texts, family="device")
    land(spark, tmp_path, "20240101_000002", base + "payload bigint", ("e", AT, 4), family="device")
    df = load(spark, str(tmp_path), "device")
    rows = {r["event_id"]: r["payload"] for r in df.collect()}
    assert rows["a"]["browser"] == "Edge" and rows["a"]["location"]["latitude"] == 5.0 and rows["a"]["session"] is None
    assert rows["b"]["browser"] == "Safari" and rows["b"]["performance"]["page_load_time_ms"] is None
    assert rows["b"]["performance"]["network_type"] == "4G"
    assert (rows["c"] is None or rows["c"]["browser"] is None) and rows["d"] is None and rows["e"] is None and rows["n"] is None


def test_alternating_schemas_are_two_scans(spark, tmp_path):
    for i in range(8):
        kind = "double" if i % 2 else "bigint"
        land(spark, tmp_path, f"20240101_00000{i}", f"transaction_id string, quantity {kind}", (f"t{i}", float(i) if i % 2 else i))
    frames = scan_by_schema(spark, str(tmp_path), "transaction")
    assert sorted(sorted(r["transaction_id"] for r in f.collect()) for f in frames) == [["t0", "t2", "t4", "t6"], ["t1", "t3", "t5", "t7"]]
    ranges = schema_ranges(footer_schemas(spark, family_files(spark, str(tmp_path), "transaction")))
    assert sum(map(len, ranges.values())) == 8
    files = [r["file"] for r in family_files(spark, str(tmp_path), "transaction").collect()]
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    assert schema_union(spark, files).agg(F.sum("quantity")).first()[0] == 28.0
    # One job for the footers, one to look at what they say, one for each schema, and the sum itself; not one for each file.
    assert len(set(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) - set(before)) <= 8


def test_files_behind_another_file_system(spark, tmp_path):
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.drift.link./in", f"file://{tmp_path}")
    land(spark, tmp_path, "20240101_000000", "transaction_id string, quantity bigint", ("a", 2))
    land(spark, tmp_path, "20240101_000001", "transaction_id string, quantity double", ("b", 4.0))
    rows = load(spark, "viewfs://drift/in", "transaction").select("transaction_id", "quantity").collect()
    assert sorted(map(tuple, rows)) == [("a", 2), ("b", 4)]


@pytest.mark.parametrize("drift", ["payload string", "payload struct<browser:bigint>"])
def test_a_family_goes_on_loading_after_a_change(spark, tmp_path, drift):
    w, source = Warehouse(spark, str(tmp_path / "w")), tmp_path / "in"
    base = "event_id string, timestamp string, user_id string, device_id string, event_type string, "
    land(spark, source, "20240129_000000", base + "payload struct<browser:string>", ("a", AT, "u", "d", "click", ("Edge",)), family="device")
    w.load_bronze(str(source), "device", datetime(2024, 1, 30))
    value = '{"browser": "7"}' if drift == "payload string" else (7,)
    land(spark, source, "20240129_000010", base + drift, ("b", AT, "u", "d", "click", value), family="device")
    w.load_bronze(str(source), "device", datetime(2024, 1, 30))
    assert {r["event_id"]: r["payload"]["browser"] for r in w.read("bronze_device_events").collect()} == {"a": "Edge", "b": "7"}
