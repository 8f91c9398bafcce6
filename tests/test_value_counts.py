import math
import random

import pytest

from eventmart.operators.ranks import pct_rank_avg
from eventmart.plans.store import LayerTable
from eventmart.plans.value_counts import ValueCounts

def frame(spark, rows):
    return spark.createDataFrame([(i, d, v) for i, d, v in rows], "id string, day string, v double").selectExpr(
        "id", "cast(day AS date) AS day", "v"
    )


def by_id(df):
    return {r["id"]: r["pct"] for r in df.collect()}


@pytest.mark.parametrize("range_values, hot", [(3, 5), (1000, 1000)])
def test_kept_up_ranks_equal_a_full_count(spark, tmp_path, monkeypatch, range_values, hot):
    monkeypatch.setattr("eventmart.plans.value_counts.HOT", hot)
    rng = random.Random(5)
    table = LayerTable(spark, str(tmp_path), "t", "day", "id")
    counts = ValueCounts(spark, str(tmp_path), "t_counts", range_values)
    values = [0.0, -0.0, 1e-9, -7.25, 1e12, math.inf, -math.inf, math.nan, None, *range(12)]
    for step in range(3):
        rows = [(str(rng.randint(0, 60)), f"2024-01-0{rng.randint(1, 4)}", rng.choice(values)) for _ in range(15 if step else 60)]
        rows = list({r[0]: r for r in rows}.values())
        if step == 2:  # all that is left lies below or above what the ranges were cut for
            rows = [(i, d, -1e6 - n if n % 2 else 1e6 + n) for n, (i, d, _) in enumerate(rows)]
        table.upsert(frame(spark, [(i, d, None if v is None else float(v)) for i, d, v in rows]), "id")
        counts.follow(table, "v")
        got = by_id(counts.ranked(table.read(), "v", "pct"))
        want = by_id(pct_rank_avg(table.read(), "v", "pct"))
        assert got.keys() == want.keys()
        assert all((a is None) == (want[k] is None) and (a is None or math.isclose(a, want[k])) for k, a in got.items())
    assert counts.follow(table, "v") == []


def test_a_small_commit_writes_only_its_ranges(spark, tmp_path):
    table = LayerTable(spark, str(tmp_path), "t", "day", "id")
    counts = ValueCounts(spark, str(tmp_path), "t_counts", 10)
    table.upsert(frame(spark, [(str(i), "2024-01-01", float(i)) for i in range(100)]), "id")
    assert counts.follow(table, "v") is None
    table.upsert(frame(spark, [("new", "2024-01-02", 50.5)]), "id")
    assert len(counts.follow(table, "v")) == 1
    writes = {e["part"]: e["write"][:10] for e in counts.table.snapshot().entries}
    assert len(writes) == 10 and sorted(writes.values()).count("0000000002") == 1


def test_an_expired_version_is_counted_anew(spark, tmp_path):
    table = LayerTable(spark, str(tmp_path), "t", "day", "id")
    counts = ValueCounts(spark, str(tmp_path), "t_counts")
    table.upsert(frame(spark, [("a", "2024-01-01", 1.0)]), "id")
    counts.follow(table, "v")
    for v in (2.0, 3.0):
        table.upsert(frame(spark, [("a", "2024-01-01", v), ("b", "2024-01-02", v + 1)]), "id")
    table.expire(1)
    assert counts.follow(table, "v") is None
    assert by_id(counts.ranked(table.read(), "v", "pct")) == {"a": 50.0, "b": 100.0}


def test_an_emptied_table_gives_no_ranks_and_fills_again(spark, tmp_path):
    table = LayerTable(spark, str(tmp_path), "t", "day", "id")
    counts = ValueCounts(spark, str(tmp_path), "t_counts")
    table.upsert(frame(spark, [("a", "2024-01-01", 1.0)]), "id")
    counts.follow(table, "v")
    table.upsert(frame(spark, [("a", "2024-01-01", None)]), "id")
    counts.follow(table, "v")
    assert by_id(counts.ranked(table.read(), "v", "pct")) == {"a": None}
    table.upsert(frame(spark, [("b", "2024-01-01", 4.0)]), "id")
    counts.follow(table, "v")
    assert by_id(counts.ranked(table.read(), "v", "pct")) == {"a": None, "b": 100.0}
