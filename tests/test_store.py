import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from eventmart.plans.refresh import Warehouse
from eventmart.plans.store import ConcurrentCommit, LayerTable, Snapshot, foldable
from eventmart.sources.landing import land_batch
from eventmart.workload import families as fam

AS_OF = datetime(2024, 1, 30)


def rows(spark, *values):
    return spark.createDataFrame(list(values), "id string, day string, v int").select(
        "id", F.col("day").cast("date").alias("day"), "v"
    )


def ids(df):
    return sorted((r["id"], r["v"]) for r in df.collect())


@pytest.fixture
def table(spark, tmp_path):
    return LayerTable(spark, str(tmp_path), "t", "day", "id", ("id",))


def test_first_upsert_keeps_duplicates_of_the_batch(spark, table):
    table.upsert(rows(spark, ("a", "2024-01-01", 1), ("a", "2024-01-01", 2)), "id")
    assert ids(table.read()) == [("a", 1), ("a", 2)]


def test_upsert_replaces_across_days(spark, table):
    table.upsert(rows(spark, ("a", "2024-01-01", 1), ("b", "2024-01-01", 1), ("c", "2024-01-02", 1)), "id")
    table.upsert(rows(spark, ("a", "2024-01-03", 2), ("d", "2024-01-02", 2)), "id")
    assert ids(table.read()) == [("a", 2), ("b", 1), ("c", 1), ("d", 2)]
    assert table.snapshot().mark("id") == "d"


def test_day_without_hits_is_not_rewritten(spark, table):
    table.upsert(rows(spark, ("a", "2024-01-01", 1), ("b", "2024-01-02", 1)), "id")
    table.upsert(rows(spark, ("b", "2024-01-02", 2)), "id")
    first = [e for e in table.snapshot().entries if e["part"] == "2024-01-01"]
    assert [e["write"][:10] for e in first] == ["0000000001"]


def test_null_day_and_null_key(spark, table):
    table.upsert(rows(spark, ("a", None, 1), (None, "2024-01-01", 1)), "id")
    table.upsert(rows(spark, ("a", "2024-01-05", 2), (None, "2024-01-01", 2)), "id")
    assert sorted((r["id"] or "", r["v"]) for r in table.read().collect()) == [("", 1), ("", 2), ("a", 2)]


def test_repeated_batch_id_changes_nothing(spark, table):
    batch = rows(spark, ("a", "2024-01-01", 1))
    assert table.upsert(batch, "id", "stream", 0) is not None
    assert table.upsert(rows(spark, ("a", "2024-01-01", 9)), "id", "stream", 0) is None
    assert ids(table.read()) == [("a", 1)]
    table.upsert(rows(spark, ("a", "2024-01-01", 3)), "id", "stream", 1)
    assert ids(table.read()) == [("a", 3)]


def test_reader_keeps_its_version(spark, table):
    table.upsert(rows(spark, ("a", "2024-01-01", 1)), "id")
    before = table.read()
    table.upsert(rows(spark, ("a", "2024-01-01", 2)), "id")
    assert ids(before) == [("a", 1)]
    assert ids(table.read()) == [("a", 2)]


def test_two_writers_cannot_publish_one_version(spark, table):
    table.upsert(rows(spark, ("a", "2024-01-01", 1)), "id")
    now = table.snapshot()
    with pytest.raises(ConcurrentCommit):
        table._publish(Snapshot(now.version, now.schema, [], {}))


def test_compact_and_expire(spark, table):
    for i in range(4):
        table.upsert(rows(spark, (f"k{i}", "2024-01-01", i)), "id")
    assert table.compact(min_files=3) is not None
    assert len(table.snapshot().entries) == 1
    assert ids(table.read()) == [(f"k{i}", i) for i in range(4)]
    assert table.expire(keep=1)
    assert ids(table.read()) == [(f"k{i}", i) for i in range(4)]


def test_empty_batch(spark, table):
    table.upsert(rows(spark, ("a", "2024-01-01", 1)), "id")
    assert table.upsert(rows(spark, ("x", "2024-01-01", 1)).limit(0), "id") == 1
    assert ids(table.read()) == [("a", 1)]


def test_new_column_joins_the_schema(spark, table):
    table.upsert(rows(spark, ("a", "2024-01-01", 1)), "id")
    table.upsert(rows(spark, ("b", "2024-01-01", 1)).withColumn("extra", F.lit("x")), "id")
    assert sorted((r["id"], r["extra"]) for r in table.read().collect()) == [("a", None), ("b", "x")]


def land(spark, sf_dir, directory, low, high, stamp):
    ev = fam.events(spark, sf_dir).where((F.col("ts") >= low) & (F.col("ts") < high))
    for family in ("device", "session", "transaction"):
        land_batch(fam.RAW[family](ev, as_text=True), directory, family, stamp)


def test_two_refreshes_equal_one(spark, sf_dir, tmp_path):
    """Rows that are never later than the lookback: the split does not show in silver or gold."""
    split = "2024-01-20 00:00:00"
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    land(spark, sf_dir, one, "2024-01-01", "2024-02-01", "20240131_000000")
    whole = Warehouse(spark, str(tmp_path / "w1"))
    whole.refresh(one, AS_OF)
    parts = Warehouse(spark, str(tmp_path / "w2"))
    land(spark, sf_dir, two, "2024-01-01", split, "20240131_000000")
    parts.refresh(two, AS_OF)
    land(spark, sf_dir, two, split, "2024-02-01", "20240131_000010")
    reports = parts.refresh(two, AS_OF)
    for name in ("silver_device_events", "silver_transactions", "gold_platform_events", "gold_user_engagement"):
        a, b = whole.read(name), parts.read(name)
        drop = [c for c in ("loaded_at", "processed_at", "aggregated_at") if c in a.columns]
        a, b = a.drop(*drop), b.drop(*drop).select(*a.drop(*drop).columns)
        assert a.count() == b.count() > 0
        assert a.exceptAll(b).isEmpty(), name
    assert parts.read("silver_user_activity").count() >= whole.read("silver_user_activity").count()
    assert "gold_user_engagement" in parts.register_views()
    top = spark.sql("SELECT platform, total_events FROM gold_platform_events ORDER BY total_events DESC LIMIT 1").first()
    assert top["total_events"] == max(r["total_events"] for r in parts.read("gold_platform_events").collect())
    for report in reports.values():
        assert [r["column"] for r in report.where("not passed").collect()] == []


def test_third_refresh_without_new_files_changes_nothing(spark, sf_dir, tmp_path):
    directory = str(tmp_path / "in")
    land(spark, sf_dir, directory, "2024-01-01", "2024-01-10", "20240131_000000")
    w = Warehouse(spark, str(tmp_path / "w"))
    w.refresh(directory, AS_OF, layers=("bronze", "silver"))
    before = w.read("silver_device_events").count(), w.read("bronze_session_events").count()
    w.refresh(directory, AS_OF, layers=("bronze", "silver"))
    assert (w.read("silver_device_events").count(), w.read("bronze_session_events").count()) == before


def session_file(spark, directory, stamp, *rows):
    schema = "session_id string, timestamp string, user_id string, platform string, pages_viewed bigint"
    land_batch(spark.createDataFrame(list(rows), schema).coalesce(1), directory, "session", stamp)


def device_file(spark, directory, stamp, *rows):
    schema = "event_id string, timestamp string, user_id string, platform string"
    df = spark.createDataFrame(list(rows), schema)
    land_batch(df.withColumn("device_id", F.lit("d")).withColumn("event_type", F.lit("click")).coalesce(1), directory, "device", stamp)


def test_batch_load_skips_a_late_smaller_name(spark, tmp_path):
    w, source = Warehouse(spark, str(tmp_path / "w")), str(tmp_path / "in")
    session_file(spark, source, "20240129_000010", ("a", "2024-01-29T10:00:00+00:00", "u", "p", 1))
    w.load_bronze(source, "session", AS_OF)
    session_file(spark, source, "20240129_000000", ("b", "2024-01-29T10:00:00+00:00", "u", "p", 1))
    w.load_bronze(source, "session", AS_OF)
    assert [r["session_id"] for r in w.read("bronze_session_events").collect()] == ["a"]


def test_reemitted_session_keeps_the_latest_batch(spark, tmp_path):
    w, source = Warehouse(spark, str(tmp_path / "w")), str(tmp_path / "in")
    session_file(spark, source, "20240129_000000", ("a", "2024-01-28T10:00:00+00:00", "u", "p", 1))
    w.load_bronze(source, "session", AS_OF)
    session_file(spark, source, "20240129_000010", ("a", "2024-01-29T10:00:00+00:00", "u", "p", 2))
    w.load_bronze(source, "session", AS_OF)
    assert [r["pages_viewed"] for r in w.read("bronze_session_events").collect()] == [2]


@pytest.mark.parametrize("retract", [False, True])
def test_late_session_through_the_warehouse(spark, tmp_path, retract):
    w, source = Warehouse(spark, str(tmp_path / "w"), retract_unmatched=retract), str(tmp_path / "in")
    device_file(spark, source, "20240129_000000", ("e", "2024-01-29T10:05:00+00:00", "u", "p"))
    session_file(spark, source, "20240129_000000", ("far", "2024-01-29T09:00:00+00:00", "u", "p", 1))
    for family in ("device", "session"):
        w.load_bronze(source, family, AS_OF)
    w.build_silver("silver_user_activity", AS_OF)
    session_file(spark, source, "20240129_000010", ("near", "2024-01-29T10:06:00+00:00", "u", "p", 1))
    w.load_bronze(source, "session", AS_OF)
    w.build_silver("silver_user_activity", AS_OF)
    ids = sorted(r["activity_id"] for r in w.read("silver_user_activity").collect())
    assert ids == (["e_near"] if retract else ["e_near", "e_no_session"])


def test_boundary_window_is_kept_for_devices_and_dropped_for_activity(spark, tmp_path):
    w, source = Warehouse(spark, str(tmp_path / "w")), str(tmp_path / "in")
    device_file(spark, source, "20240129_000000", ("new", "2024-01-29T10:45:00+00:00", "u", "p"))
    session_file(spark, source, "20240129_000000", ("s", "2024-01-29T09:00:00+00:00", "u", "p", 1))
    for family in ("device", "session"):
        w.load_bronze(source, family, AS_OF)
    for name in ("silver_device_events", "silver_user_activity"):
        w.build_silver(name, AS_OF)
    late = [("edge", "2024-01-29T10:25:00+00:00", "u", "p"), ("in", "2024-01-29T10:35:00+00:00", "u", "p"), ("out", "2024-01-29T10:15:00+00:00", "u", "p")]
    device_file(spark, source, "20240129_000010", *late)
    w.load_bronze(source, "device", AS_OF)
    for name in ("silver_device_events", "silver_user_activity"):
        w.build_silver(name, AS_OF)
    ids = lambda name: sorted(r["event_id"] for r in w.read(name).collect())
    assert ids("silver_device_events") == ["edge", "in", "new"]
    assert ids("silver_user_activity") == ["in", "new"]


def files(table):
    return sorted((e["part"], e["write"]) for e in table.snapshot().entries)


def test_rows_that_are_there_already_are_not_written(spark, table):
    first = rows(spark, *[(f"k{i}", f"2024-01-{1 + i % 9:02d}", i) for i in range(100)], ("n", "2024-01-01", None))
    table.upsert(first, "id")
    before = files(table)
    assert table.upsert(first, "id") == 1 and files(table) == before
    assert table.upsert(rows(spark, ("k5", "2024-01-06", 5), ("n", "2024-01-01", None)), "id") == 1
    # One changed row among ninety-nine equal ones: its day is rewritten, the other eight are left.
    version = table.upsert(first.withColumn("v", F.when(F.col("id") == "k5", -1).otherwise(F.col("v"))), "id")
    new = [e for e in table.snapshot().entries if int(e["write"][:10]) == version]
    assert {e["part"] for e in new} == {"2024-01-06"} and sum(e["rows"] for e in new) == 11
    assert dict(ids(table.read()))["k5"] == -1 and table.read().count() == 101
    # Twice the same key is not the same as once.
    table.upsert(rows(spark, ("k5", "2024-01-06", -1), ("k5", "2024-01-06", -1)), "id")
    assert table.read().where("id = 'k5'").count() == 2


def test_ignored_and_nested_columns(spark, tmp_path):
    table = LayerTable(spark, str(tmp_path), "t")
    make = lambda at, p, m: spark.createDataFrame([("a", at, p, m)], "id string, at int, p struct<x:int,y:string>, m map<string,int>")
    table.upsert(make(1, (1, None), {"a": 1}), "id")
    assert table.upsert(make(2, (1, None), {"a": 1}), "id", ignore=("at",)) == 1
    assert table.upsert(make(2, (1, None), {"a": 2}), "id", ignore=("at",)) == 2
    assert table.upsert(make(2, (1, "y"), {"a": 2}), "id", ignore=("at",)) == 3
    assert table.upsert(make(3, (1, "y"), {"a": 2}), "id") == 4
    assert table.read().first()["at"] == 3


def test_one_row_reads_one_day(spark, table):
    table.upsert(rows(spark, *[(f"k{i}", f"2024-01-{1 + i % 30:02d}", i) for i in range(3000)]), "id")
    one = rows(spark, ("k7", "2024-01-08", -7))
    assert [r["day"] for r in table.key_days(one, "id").collect()] == ["2024-01-08"]
    near = table._days_of(table.snapshot(), one, "id")
    assert [e["part"] for e in near] == ["2024-01-08"]
    # Of the side table one bucket is read, and what is stored is not shuffled.
    found = table.key_days(one, "id")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and re.search(r"PartitionFilters: \[[^\]]*bucket", plan)
    stored_side = plan[: plan.index("FileScan")].splitlines()[-3:]
    assert not any("hashpartitioning" in line for line in stored_side)
    table.upsert(one, "id")
    assert dict(ids(table.read()))["k7"] == -7 and table.read().count() == 3000
    # A key that moves to another day is found on its old one.
    table.upsert(rows(spark, ("k7", "2024-02-01", 1)), "id")
    assert table.read().where("id = 'k7'").select(F.col("day").cast("string")).collect()[0][0] == "2024-02-01"
    assert table.read().count() == 3000


def test_a_table_without_side_table_finds_its_keys(spark, table):
    table.replace(rows(spark, ("a", "2024-01-01", 1), ("b", "2024-01-02", 1)))
    table.upsert(rows(spark, ("a", "2024-01-05", 2)), "id")
    assert ids(table.read()) == [("a", 2), ("b", 1)]


def test_a_condition_holds_for_the_version_it_replaces(spark, table):
    table.upsert(rows(spark, ("k", "2024-01-01", 1)), "id")
    rival = LayerTable(spark, table.path.rsplit("/", 1)[0], "t", "day", "id", ("id",))
    asked = []

    def older(stored):
        if not asked:  # a rival publishes a newer row while this batch is being made
            asked.append(1)
            rival.upsert(rows(spark, ("k", "2024-01-01", 9)), "id")
        held = stored.select("id", F.col("v").alias("held"))
        return rows(spark, ("k", "2024-01-01", 5)).join(held, "id").where("v > held").select("id", "day", "v")

    table.upsert(older, "id")
    assert ids(table.read()) == [("k", 9)]


def test_compact_starts_again_after_a_rival(spark, table, monkeypatch):
    for i in range(4):
        table.upsert(rows(spark, (f"k{i}", "2024-01-01", i)), "id")
    rival = LayerTable(spark, table.path.rsplit("/", 1)[0], "t", "day", "id", ("id",))
    write, done = table._write, []

    def slow(df, version):
        if not done:
            done.append(1)
            rival.upsert(rows(spark, ("late", "2024-01-02", 1)), "id")
        return write(df, version)

    monkeypatch.setattr(table, "_write", slow)
    assert table.compact(min_files=3) is not None
    assert ids(table.read()) == [(f"k{i}", i) for i in range(4)] + [("late", 1)]


def test_notes_stay_few_and_are_seldom_rewritten():
    notes, rewritten = [], 0
    for i in range(5000):
        notes.append({"write": str(i), "rows": 1 + i % 7})
        if folded := foldable(notes, 8):
            rows = sum(n["rows"] for n in folded)
            rewritten += rows
            notes = [n for n in notes if n not in folded] + [{"write": f"f{i}", "rows": rows}]
        assert len(notes) <= 20
    total = sum(n["rows"] for n in notes)
    assert total == sum(1 + i % 7 for i in range(5000)) and rewritten <= 12 * total
    assert foldable([], 1) == [] and foldable(notes[:1], 2) == []
    assert foldable([{"rows": 100}, {"rows": 1}, {"rows": 1}], 2) == [{"rows": 1}, {"rows": 1}]


def folders(table, name):
    fs, path = table._fs(f"{table.path}/{name}")
    return sorted(s.getPath().getName().split("=")[1] for s in fs.listStatus(path))


def test_folded_notes_still_name_every_day(spark, table):
    for i in range(5):
        table.upsert(rows(spark, (f"k{i}", f"2024-01-0{1 + i}", i), (f"m{i}", "2024-01-09", i), (None, "2024-01-01", i)), "id")
    table.upsert(rows(spark, ("k0", "2024-02-01", 7)), "id")
    before = {(r["key"], r["day"]) for r in table._read_notes(table.snapshot().notes).collect()}
    assert len(table.snapshot().notes) == 6 and table.compact(min_files=4) is not None
    now = table.snapshot()
    assert len(now.notes) == 1 and now.keyed
    assert {(r["key"], r["day"]) for r in table._read_notes(now.notes).collect()} == before
    assert {r["day"] for r in table.key_days(rows(spark, ("k0", "2024-03-01", 1)), "id").collect()} == {"2024-01-01", "2024-02-01"}
    # A reader of the version before still has its notes, until it expires.
    assert table._read_notes(table.snapshot(now.version - 1).notes).count() == len(before)
    table.expire(keep=1)
    assert folders(table, "keys") == [n["write"] for n in now.notes]
    table.upsert(rows(spark, ("k3", "2024-01-20", -3), ("new", "2024-01-20", 1)), "id")
    got = [(r["id"], r["v"]) for r in table.read().where("id is not null").collect()]
    assert sorted(got) == sorted([("k0", 7), ("k1", 1), ("k2", 2), ("k3", -3), ("k4", 4), ("new", 1), *((f"m{i}", i) for i in range(5))])


def test_a_commit_whose_files_a_rival_swept_starts_again(spark, table, monkeypatch):
    table.upsert(rows(spark, ("a", "2024-01-01", 1)), "id")
    rival = LayerTable(spark, table.path.rsplit("/", 1)[0], "t", "day", "id", ("id",))
    without, done = table._without, []

    def late(*args):
        if not done:
            done.append(1)
            for i in range(2):
                rival.upsert(rows(spark, (f"r{i}", "2024-01-02", i)), "id")
            rival.expire(keep=1)
        return without(*args)

    monkeypatch.setattr(table, "_without", late)
    table.upsert(rows(spark, ("a", "2024-01-03", 2)), "id")
    assert ids(table.read()) == [("a", 2), ("r0", 0), ("r1", 1)]
    # Files that are gone without a rival's commit are an error.
    monkeypatch.setattr(table, "_without", lambda *args: spark.read.parquet(f"{table.path}/none"))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        table.upsert(rows(spark, ("a", "2024-01-04", 3)), "id")


def test_a_refresh_without_new_files_publishes_nothing_and_an_hour_changes_a_day(spark, sf_dir, tmp_path):
    source = str(tmp_path / "in")
    land(spark, sf_dir, source, "2024-01-01", "2024-01-12 10:00:00", "20240131_000000")
    w = Warehouse(spark, str(tmp_path / "w"))
    w.refresh(source, AS_OF)
    names = [*("bronze_device_events", "silver_device_events", "silver_transactions", "silver_user_activity")]
    names += ["gold_platform_daily", "gold_platform_events", "gold_user_conversion", "gold_user_engagement"]
    versions = lambda: {n: w.table(n).snapshot().version for n in names}
    before = versions()
    w.refresh(source, datetime(2024, 1, 30, 1))
    assert versions() == before
    land(spark, sf_dir, source, "2024-01-12 10:00:00", "2024-01-12 11:00:00", "20240131_000010")
    w.refresh(source, AS_OF)
    daily = w.table("gold_platform_daily").snapshot()
    assert {e["part"] for e in daily.entries if int(e["write"][:10]) == daily.version} == {"2024-01-12"}
    assert len({e["part"] for e in daily.entries}) == 12
    from eventmart.plans import gold

    whole = gold.gold_platform_events(w.read("silver_device_events"), AS_OF)
    assert w.read("gold_platform_events").exceptAll(whole).isEmpty() and whole.exceptAll(w.read("gold_platform_events")).isEmpty()
    whole = gold.gold_user_engagement(w.read("silver_device_events"))
    mart = w.read("gold_user_engagement").select(*whole.columns)
    assert mart.exceptAll(whole).isEmpty() and whole.exceptAll(mart).isEmpty() and mart.dtypes == whole.dtypes
    for name in ("gold_user_days", "gold_user_choices"):
        held = w.table(name).snapshot()
        assert {e["part"] for e in held.entries if int(e["write"][:10]) == held.version} == {"2024-01-12"}
