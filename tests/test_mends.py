"""Faults found in the first round, each held by a test."""

import math
from datetime import datetime, timedelta

import duckdb
import pytest
from pyspark.sql import functions as F

from eventmart.functions.scoring import exact_sum, round_half_up
from eventmart.operators.joins import interval_join
from eventmart.plans.refresh import CheckFailure, Warehouse
from eventmart.plans.store import ConcurrentCommit, LayerTable
from eventmart.sources.landing import land_batch
from eventmart.streaming import streams
from eventmart.workload import families as fam


def test_rounding_equals_duckdb_at_every_size(spark):
    values = [10000000000000.126, 1e12 + 0.126, 9e15, 2.0**53 + 2, 1e17, 1e300, 1.7e308, 0.005, 1.005, 2.675, -2.5, 0.49999999999999994, 4503599627370497.5, 45035996273704.97, 0.0, -0.0]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x double")
    for digits in (0, 2):
        got = [r.y for r in rows.select("i", round_half_up("x", digits).alias("y")).orderBy("i").collect()]
        want = [duckdb.execute("SELECT round(CAST(? AS DOUBLE), ?)", [v, digits]).fetchone()[0] for v in values]
        assert got == want
    odd = spark.createDataFrame([(math.inf,), (-math.inf,), (math.nan,)], "x double").select(round_half_up("x").alias("y")).collect()
    assert odd[0].y == math.inf and odd[1].y == -math.inf and math.isnan(odd[2].y)


def test_small_amounts_are_not_cut(spark):
    df = spark.createDataFrame([(1e-7,)] * 1000, "x double")
    assert df.agg(exact_sum("x")).first()[0] == pytest.approx(1e-4, rel=1e-9)


@pytest.mark.parametrize("reach", [0, 0.5, 1.005, 300])
@pytest.mark.parametrize("salts", [1, 3])
def test_interval_reach_at_bucket_borders(spark, reach, salts):
    start, rows = datetime(2024, 1, 1), []
    micros = round(reach * 1e6)
    for k in range(40):
        at = start + timedelta(microseconds=k * max(micros, 1) - 5)
        rows += [(k, at, at + timedelta(microseconds=d)) for d in (micros, -micros, micros + 1, -micros - 1)]
    left = spark.createDataFrame([(i, "u", a) for i, (_, a, _) in enumerate(rows)], "i int, u string, t timestamp_ntz")
    right = spark.createDataFrame([(i, "u", b) for i, (_, _, b) in enumerate(rows)], "j int, u string, t timestamp_ntz")
    got = {(r.i, r.m) for r in interval_join(left, right, ["u"], "t", "t", reach, {"j": "m"}, salts=salts).collect() if r.m is not None}
    span = timedelta(microseconds=micros)
    assert got == {(i, j) for i, (_, a, _) in enumerate(rows) for j, (_, _, b) in enumerate(rows) if abs(a - b) <= span}


def _table(spark, path, name="t"):
    return LayerTable(spark, str(path), name)


def test_rival_commits_both_survive(spark, tmp_path, monkeypatch):
    table = _table(spark, tmp_path)
    row = lambda k: spark.createDataFrame([(k, "x")], "id int, v string")
    table.replace(row(0))
    publish, rival = LayerTable._publish, []

    def late(self, snapshot):
        if not rival:
            rival.append(True)
            _table(spark, tmp_path).upsert(row(2), "id")
        publish(self, snapshot)

    monkeypatch.setattr(LayerTable, "_publish", late)
    table.upsert(row(1), "id")
    assert sorted(r.id for r in table.read().collect()) == [0, 1, 2]
    with pytest.raises(ConcurrentCommit):
        publish(table, table.snapshot())


def test_an_older_row_does_not_replace_a_newer_one(spark, tmp_path):
    table = _table(spark, tmp_path)
    sink = streams.newest_wins_sink(table, "id", ["version"], "w")
    for number, rows in enumerate([[(1, 2), (2, 1)], [(1, 1), (2, 3), (3, 1)], [(1, 2), (2, None)]]):
        sink(spark.createDataFrame(rows, "id int, version int"), number)
    assert sorted((r.id, r.version) for r in table.read().collect()) == [(1, 2), (2, 3), (3, 1)]


def test_a_build_with_bad_rows_is_reported_or_stopped(spark, sf_dir, tmp_path):
    ev = fam.events(spark, sf_dir).limit(50)
    for family, raw in fam.RAW.items():
        land_batch(raw(ev, as_text=True), str(tmp_path / "in"), family, fam.STAMP)
    land_batch(fam.raw_device(ev, as_text=True).withColumn("device_type", F.lit("toaster")), str(tmp_path / "in"), "device", "20240131_010000")
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    with pytest.raises(CheckFailure, match="device_type"):
        warehouse.refresh(str(tmp_path / "in"), datetime.fromisoformat(fam.AS_OF), layers=("bronze",), on_failure="raise")
    (tmp_path / "none").mkdir()
    with pytest.raises(ValueError, match="no event files"):
        Warehouse(spark, str(tmp_path / "v")).refresh(str(tmp_path / "none"), datetime.fromisoformat(fam.AS_OF))


def test_upkeep_folds_files_and_expires_versions(spark, sf_dir, tmp_path):
    ev = fam.events(spark, sf_dir).limit(60)
    warehouse = Warehouse(spark, str(tmp_path / "w"), keep_versions=2, salts=2)
    for k in range(3):
        for family, raw in fam.RAW.items():
            land_batch(raw(ev.where(F.col("event_id") % 3 == k), as_text=True), str(tmp_path / "in"), family, f"2024013{k}_000000")
        warehouse.refresh(str(tmp_path / "in"), datetime.fromisoformat(fam.AS_OF), layers=("bronze", "silver"))
    table = warehouse.table("bronze_device_events")
    assert len(table.versions()) <= 2 and table.read().count() == 60
