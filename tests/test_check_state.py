from pyspark.sql import functions as F

from eventmart.operators.quality import accepted_range, accepted_values, not_null, run_checks, unique
from eventmart.plans.check_state import CheckState
from eventmart.plans.store import LayerTable

SUITE = [not_null("id"), unique("id"), accepted_values("kind", ["a", "b"]), accepted_range("v", 0, 9), unique("kind", "v")]


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), "id string, day string, kind string, v int").withColumn("day", F.col("day").cast("date"))


def told(report):
    return [tuple(r) for r in report.collect()]


def test_reports_on_changes_equal_those_on_the_whole_table(spark, tmp_path):
    table = LayerTable(spark, str(tmp_path), "t", "day", "id")
    commits = [
        [("1", "2024-01-01", "a", 1), ("1", "2024-01-02", "a", 2), ("2", "2024-01-01", "x", 99), (None, "2024-01-01", "b", None)],
        [("3", "2024-01-03", "b", 3), ("4", "2024-01-03", "x", -1), ("4", "2024-01-04", None, 5)],
        # A repeated key is replaced by one row, a sound one by two; a bad value goes, a bad one comes.
        [("1", "2024-01-04", "a", 1), ("3", "2024-01-01", "a", 3), ("3", "2024-01-02", "a", 30), ("2", "2024-01-01", "a", 9)],
        [(None, None, "x", 10)],
    ]
    for rows in commits:
        table.upsert(frame(spark, *rows), "id")
        got = told(CheckState(table, "id", SUITE, str(tmp_path / "checks")).report())
        assert got == told(run_checks(table.read(), SUITE))
    table.compact(min_files=2)
    assert told(CheckState(table, "id", SUITE, str(tmp_path / "checks")).report()) == got
    for day in range(3):
        table.upsert(frame(spark, (f"n{day}", "2024-01-09", "x", 1)), "id")
    table.expire(1)
    assert told(CheckState(table, "id", SUITE, str(tmp_path / "checks")).report()) == told(run_checks(table.read(), SUITE))


def test_a_small_commit_does_not_scan_the_table(spark, tmp_path, monkeypatch):
    table = LayerTable(spark, str(tmp_path), "t", "day", "id")
    table.upsert(frame(spark, *[(f"{d}-{i}", f"2024-01-{d:02d}", "a", 1) for d in range(1, 11) for i in range(5)]), "id")
    suite = [not_null("id"), unique("id"), accepted_range("v", 0, 9)]
    state = CheckState(table, "id", suite, str(tmp_path / "checks"))
    assert all(r[-1] for r in told(state.report()))
    table.upsert(frame(spark, ("10-1", "2024-01-10", "a", 2), ("new", "2024-01-10", "a", 77)), "id")
    read = []
    inner = LayerTable._read_entries

    def watched(self, entries, schema):
        if self is table:
            read.extend(e["part"] for e in entries)
        return inner(self, entries, schema)

    monkeypatch.setattr(LayerTable, "_read_entries", watched)
    got = told(state.report())
    assert set(read) == {"2024-01-10"}
    assert [r[2] for r in got] == [0, 1, 0]
