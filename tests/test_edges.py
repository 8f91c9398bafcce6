"""Hand-made rows with stated results, one group per operator."""

import math
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from eventmart.functions.payload import unpack_payload
from eventmart.functions.scoring import (
    customer_segment,
    exact_avg,
    exact_sum,
    guarded_rate,
    round_half_up,
    safe_ratio,
)
from eventmart.functions.timecols import parse_timestamp, whole_days_between, window_start
from eventmart.operators.aggregates import mode_per_key
from eventmart.operators.dedup import latest_per_key
from eventmart.operators.incremental import (
    EPOCH,
    FULL_LOAD,
    bounds_from_max,
    high_water,
    is_incremental,
    lookback_bounds,
    new_or_changed,
    strict_lookback,
    upsert,
    within_lookback,
)
from eventmart.operators.joins import interval_join
from eventmart.operators.quality import (
    accepted_range,
    accepted_values,
    failing_rows,
    not_null,
    run_checks,
    unique,
    validate_events,
)
from eventmart.operators.ranks import pct_rank_avg
from eventmart.plans import bronze, gold, silver
from eventmart.schemas import PAYLOAD
from eventmart.sources.landing import land_batch
from eventmart.sources.scan import (
    SOURCE,
    only_new_files,
    require_sources,
    scan_events,
    scan_union,
    source_inventory,
)

AS_OF = datetime(2025, 1, 31)


def frame(spark, schema, *rows):
    """Rows with times given as text: columns typed `time` become TIMESTAMP_NTZ."""
    fields = [f.strip().rsplit(" ", 1) for f in schema.split(",")]
    plain = ", ".join(f"{n} {'string' if t == 'time' else t}" for n, t in fields)
    df = spark.createDataFrame(list(rows), plain)
    return df.select(*[F.col(n).cast("timestamp_ntz") if t == "time" else F.col(n) for n, t in fields])


def one(df):
    return df.first()[0]


# ---- time -------------------------------------------------------------------


@pytest.mark.parametrize(
    "text, expected",
    [
        ("not a time", None),
        ("12:30", None),
        ("", None),
        (None, None),
        ("2025-01-01T10:17:33.123456+00:00", datetime(2025, 1, 1, 10, 17, 33, 123456)),
        ("2025-01-01T23:30:00-05:00", datetime(2025, 1, 2, 4, 30)),
        ("2025-01-01 10:00:00", datetime(2025, 1, 1, 10)),
    ],
)
def test_parse_timestamp(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert one(df.select(parse_timestamp("t"))) == expected


@pytest.mark.parametrize(
    "ts, start",
    [
        ("2025-01-01 10:17:33.123456", datetime(2025, 1, 1, 10, 10)),
        ("2025-01-01 10:20:00", datetime(2025, 1, 1, 10, 20)),
        ("2025-01-01 10:19:59.999999", datetime(2025, 1, 1, 10, 10)),
        ("1969-12-31 23:59:59.5", datetime(1969, 12, 31, 23, 50)),
        (None, None),
    ],
)
def test_window_start(spark, ts, start):
    assert one(frame(spark, "t time", (ts,)).select(window_start("t"))) == start


def test_bad_time_stays_in_bronze_and_leaves_silver(spark):
    raw = spark.createDataFrame(
        [("a", "not a time"), ("b", "2025-01-30T10:17:33+00:00")], "event_id string, timestamp string"
    )
    for c in ("user_id", "device_id", "device_type", "platform", "event_type"):
        raw = raw.withColumn(c, F.lit("x"))
    raw = raw.withColumn("payload", F.lit("{}")).withColumn(SOURCE, F.lit("device_events_1.parquet"))
    rows = {r["event_id"]: r for r in bronze.parse_raw(raw, "device", AS_OF).collect()}
    assert rows["a"]["event_timestamp"] is rows["a"]["event_date"] is rows["a"]["event_window_start"] is None
    assert rows["b"]["event_window_start"] == datetime(2025, 1, 30, 10, 10)
    kept = silver.silver_device_events(bronze.parse_raw(raw, "device", AS_OF), as_of=AS_OF)
    assert [r["event_id"] for r in kept.collect()] == ["b"]


@pytest.mark.parametrize("hours, days", [(71, 2), (-71, -2), (0, 0), (72, 3)])
def test_whole_days(spark, hours, days):
    a = datetime(2025, 1, 10)
    df = frame(spark, "a time, b time", (str(a), str(a + timedelta(hours=hours))))
    assert one(df.select(whole_days_between("a", "b"))) == days


# ---- sources ----------------------------------------------------------------


def land(spark, directory, stamp, schema, *rows, family="transaction"):
    return land_batch(spark.createDataFrame(list(rows), schema).coalesce(1), str(directory), family, stamp)


def test_high_water_reads_only_larger_names(spark, tmp_path):
    for second in (9, 10, 11):
        land(spark, tmp_path, f"20250101_0000{second:02d}", "transaction_id string", (str(second),))
    rows = scan_events(spark, str(tmp_path), "transaction")
    new = only_new_files(rows, "transaction_events_20250101_000010.parquet")
    assert [r["transaction_id"] for r in new.collect()] == ["11"]
    assert only_new_files(rows, high_water(None)).count() == 3
    assert high_water(rows.limit(0)) == ""
    assert high_water(rows) == "transaction_events_20250101_000011.parquet"


def test_mark_skips_files_unopened(spark, tmp_path):
    for second in range(4):
        land(spark, tmp_path, f"20250101_00000{second}", "transaction_id string", (str(second),))
    new = only_new_files(
        scan_events(spark, str(tmp_path), "transaction"), "transaction_events_20250101_000002.parquet"
    )
    new.collect()
    plan = new._jdf.queryExecution().executedPlan()
    scan = plan.collectLeaves().head()
    assert scan.metrics().apply("numFiles").value() == 1


def test_landing_fills_totals_and_refuses_to_overwrite(spark, tmp_path):
    schema = "transaction_id string, quantity bigint, unit_price double, total_amount double"
    land(spark, tmp_path, datetime(2025, 1, 1), schema, ("t", 3, 2.5, 0.0))
    assert scan_events(spark, str(tmp_path), "transaction").first()["total_amount"] == 7.5
    with pytest.raises(Exception, match="(?i)exists"):
        land(spark, tmp_path, "20250101_000000", schema, ("t", 3, 2.5, 0.0))


def test_single_file_batches_are_named_too(spark, tmp_path):
    pd.DataFrame({"session_id": ["s"], "pages_viewed": [3]}).to_parquet(
        tmp_path / "session_events_20250101_000000.parquet"
    )
    row = scan_events(spark, str(tmp_path), "session").first()
    assert (row[SOURCE], row["pages_viewed"], row["referrer"]) == ("session_events_20250101_000000.parquet", 3, None)


def test_inventory_counts_batches_and_requires_one(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    with pytest.raises(ValueError):
        require_sources(spark, str(tmp_path / "empty"))
    land(spark, tmp_path, "20250101_000000", "transaction_id string", ("1",))
    land(spark, tmp_path, "20250101_000001", "session_id string", ("1",), family="session")
    land(spark, tmp_path, "20250101_000002", "session_id string", ("1",), family="session")
    found = {r["family"]: r["files"] for r in source_inventory(spark, str(tmp_path)).collect()}
    assert found == {"device": 0, "session": 2, "transaction": 1}
    assert require_sources(spark, str(tmp_path)) == 3


def test_union_fills_absent_columns_and_widens_types(spark, tmp_path):
    land(spark, tmp_path, "20250101_000000", "id string, quantity int", ("a", 1))
    land(spark, tmp_path, "20250101_000001", "referrer string, quantity double, id string", ("paid", 2.5, "b"))
    land(spark, tmp_path, "20250101_000002", "id string, quantity bigint", ("c", 2**40))
    out = scan_union(spark, str(tmp_path), "transaction")
    assert dict(out.dtypes) == {"id": "string", "quantity": "double", "referrer": "string"}
    assert sorted((r["id"], r["quantity"], r["referrer"]) for r in out.collect()) == [
        ("a", 1.0, None), ("b", 2.5, "paid"), ("c", float(2**40), None),
    ]


def test_union_of_nested_columns(spark, tmp_path):
    land(spark, tmp_path, "20250101_000000", "id string, p struct<x:int,y:string>", ("a", (1, "y")), family="device")
    land(spark, tmp_path, "20250101_000001", "id string, p struct<x:double,z:string>", ("b", (1.5, "z")), family="device")
    land(spark, tmp_path, "20250101_000002", "id string, p struct<x:double,z:string>", ("c", None), family="device")
    rows = {r["id"]: r["p"] for r in scan_union(spark, str(tmp_path), "device").collect()}
    assert rows["a"].asDict() == {"x": 1.0, "y": "y", "z": None}
    assert rows["b"].asDict() == {"x": 1.5, "y": None, "z": "z"}
    assert rows["c"] is None


# ---- dedup and incremental --------------------------------------------------


def test_dedup_takes_newest_load_then_last_file(spark):
    schema = "k string, loaded_at int, source_filename string, v string"
    df = frame(spark, schema, ("a", 1, "f1", "old"), ("a", 2, "f0", "new"), ("b", 1, "fa", "first"), ("b", 1, "fb", "last"))
    out = latest_per_key(df, "k", ["loaded_at", "source_filename"])
    assert {r["k"]: r["v"] for r in out.collect()} == {"a": "new", "b": "last"}


def test_dedup_is_the_same_whatever_the_row_order(spark):
    rows = [("a", 1, str(i)) for i in range(20)]
    picks = {
        latest_per_key(spark.createDataFrame(r, "k string, t int, v string").repartition(n), "k", ["t"]).first()["v"]
        for r, n in ((rows, 1), (rows[::-1], 3), (rows[5:] + rows[:5], 4))
    }
    assert picks == {"9"}


def test_upsert(spark):
    schema = "k int, v string"
    target = frame(spark, schema, (1, "t"), (2, "t"), (None, "t"))
    out = upsert(target, frame(spark, schema, (2, "b"), (3, "b"), (3, "b2"), (None, "b")), "k")
    assert sorted((r["k"] or 0, r["v"]) for r in out.collect()) == [
        (0, "b"), (0, "t"), (1, "t"), (2, "b"), (3, "b"), (3, "b2"),
    ]
    assert upsert(None, target, "k").count() == 3


def test_new_or_changed(spark):
    target = frame(spark, "k int, v int", (1, 5), (2, 5), (3, 5))
    batch = frame(spark, "k int, v int", (1, 5), (2, 6), (3, 4), (4, 1))
    assert sorted(r["k"] for r in new_or_changed(batch, target, "k", "v").collect()) == [2, 4]
    assert new_or_changed(batch, None, "k", "v").count() == 4


def test_lookback_inclusive_and_strict(spark):
    rows = frame(
        spark, "w time",
        *[(f"2025-01-01 10:{m}:00",) for m in (10, 20, 30, 40)], (None,),
    )
    target = rows.where("w = TIMESTAMP_NTZ '2025-01-01 10:40:00'")
    bounds = lookback_bounds(target, "w")
    minutes = lambda df: sorted(r["w"].minute for r in df.collect())
    assert minutes(within_lookback(rows, "w", bounds)) == [20, 30, 40]
    assert minutes(strict_lookback(rows, "w", bounds)) == [30, 40]
    assert minutes(within_lookback(rows, "w", FULL_LOAD)) == [10, 20, 30, 40]
    assert strict_lookback(rows, "w", FULL_LOAD).count() == 5


def test_bounds_of_missing_and_empty_targets(spark):
    rows = frame(spark, "w time", ("2025-01-01",))
    assert lookback_bounds(None, "w") == FULL_LOAD
    assert lookback_bounds(rows.withColumnRenamed("w", "other"), "w") == FULL_LOAD
    empty = lookback_bounds(rows.limit(0), "w")
    assert empty == bounds_from_max(None) and empty.lower == EPOCH - timedelta(minutes=20)
    assert not is_incremental(None, "w") and is_incremental(rows, "w")


# ---- payload ----------------------------------------------------------------

FULL = (
    "1920x1080", "Edge", "99.0", ("Oslo", "NO", 1.5, -2.5),
    ("s1", "2025-01-01", True), (120, "5G"),
)


def test_struct_and_text_payload_agree(spark):
    df = spark.createDataFrame([("a", FULL), ("b", None)], spark.createDataFrame([], "id string").schema.add("payload", PAYLOAD))
    from_struct = unpack_payload(df)
    from_text = unpack_payload(df.withColumn("payload", F.to_json("payload")))
    assert from_struct.dtypes == from_text.dtypes
    assert sorted(from_struct.collect()) == sorted(from_text.collect())


@pytest.mark.parametrize(
    "text",
    ["{bad json", "", "[]", '"text"', "{}", '{"browser": null, "location": {"city": null}}', '{"location": "x", "session": 5}'],
)
def test_bad_missing_and_null_leaves_are_null(spark, text):
    row = unpack_payload(spark.createDataFrame([("a", text)], "id string, payload string")).first()
    assert set(row.asDict().values()) == {"a", None}


def test_one_bad_leaf_leaves_the_others(spark):
    text = '{"browser": "Edge", "location": {"latitude": "north", "longitude": 7}, "performance": {"page_load_time_ms": 12}}'
    row = unpack_payload(spark.createDataFrame([("a", text)], "id string, payload string")).first()
    assert (row["browser"], row["latitude"], row["longitude"], row["page_load_time_ms"]) == ("Edge", None, 7.0, 12)


def test_struct_without_some_leaves(spark):
    df = spark.createDataFrame([("a", ("Edge", ("x",)))], "id string, payload struct<browser:string,location:struct<city:string>>")
    row = unpack_payload(df).first()
    assert (row["browser"], row["city"], row["latitude"], row["session_id"]) == ("Edge", "x", None, None)


# ---- validation -------------------------------------------------------------


def test_age_window_is_inclusive(spark):
    micro = timedelta(microseconds=1)
    times = [AS_OF, AS_OF + micro, AS_OF - timedelta(days=30), AS_OF - timedelta(days=30) - micro]
    df = frame(spark, "i int, t time", *[(i, str(t)) for i, t in enumerate(times)], (9, None))
    assert sorted(r["i"] for r in validate_events(df, ["i"], "t", AS_OF).collect()) == [0, 2]


def test_transaction_rules(spark):
    df = frame(
        spark,
        "transaction_id string, transaction_timestamp time, user_id string, total_amount double, quantity bigint",
        ("zero", str(AS_OF), "u", 0.0, 1),
        ("none", str(AS_OF), "u", 1.0, 0),
        ("debt", str(AS_OF), "u", -0.01, 1),
        ("null", str(AS_OF), "u", None, 1),
        ("nobody", str(AS_OF), None, 1.0, 1),
    )
    assert [r["transaction_id"] for r in silver.validate_transactions(df, AS_OF).collect()] == ["zero"]


# ---- interval join ----------------------------------------------------------


@pytest.fixture
def sides(spark):
    t = datetime(2025, 1, 1, 10)
    left = [("exact", "u", "p", t), ("lone", "v", "p", t), ("nul", "u", None, t), ("two", "w", "p", t)]
    right = [
        ("s+300", "u", "p", t + timedelta(seconds=300)),
        ("s+300.000001", "u", "p", t + timedelta(seconds=300, microseconds=1)),
        ("s-300", "u", "p", t - timedelta(seconds=300)),
        ("other", "u", "q", t),
        ("nul", "u", None, t),
        ("w1", "w", "p", t),
        ("w2", "w", "p", t + timedelta(seconds=1)),
    ]
    schema = "id string, user string, plat string, t time"
    return tuple(frame(spark, schema, *[(*r[:3], str(r[3])) for r in rows]) for rows in (left, right))


@pytest.mark.parametrize("options", [{}, {"salts": 4}])
def test_interval_join_edges(sides, options):
    out = interval_join(*sides, ["user", "plat"], "t", "t", 300, {"id": "match"}, **options)
    assert sorted((r["id"], r["match"] or "-") for r in out.collect()) == [
        ("exact", "s+300"), ("exact", "s-300"), ("lone", "-"), ("nul", "-"), ("two", "w1"), ("two", "w2"),
    ]


@pytest.mark.parametrize("options", [{}, {"salts": 3}])
def test_interval_join_against_brute_force(spark, options):
    """One user holds most rows, times straddle the epoch and bucket ends."""
    import random

    rnd = random.Random(5)
    def make(n):
        base = datetime(1970, 1, 1)
        return [(i, "hot" if rnd.random() < 0.6 else f"u{i % 5}", base + timedelta(milliseconds=rnd.randrange(-4_000_000, 4_000_000))) for i in range(n)]
    a, b = make(150), make(60)
    want = sorted(
        (i, m) for i, u, t in a
        for m in ([j for j, v, s in b if u == v and abs((t - s).total_seconds()) <= 300] or [-1])
    )
    schema = "id int, u string, t time"
    left, right = (frame(spark, schema, *[(i, u, str(t)) for i, u, t in rows]) for rows in (a, b))
    out = interval_join(left, right, ["u"], "t", "t", 300, {"id": "m"}, **options)
    assert sorted((r["id"], -1 if r["m"] is None else r["m"]) for r in out.collect()) == want


# ---- marts ------------------------------------------------------------------


def activity_row(event, user, session=None, platform="iOS"):
    return (event, user, platform, session, 60 if session else None, "organic" if session else None, False if session else None)


def test_conversion_of_both_sides(spark):
    activity = spark.createDataFrame(
        [activity_row("e1", "both", "s1"), activity_row("e2", "both", "s2"), activity_row("e3", "look")],
        "event_id string, user_id string, platform string, session_id string, session_duration_seconds bigint, referrer string, is_bounce boolean",
    ).withColumns(
        {
            "pages_viewed": F.lit(1).cast("bigint"),
            "interactions": F.lit(1).cast("bigint"),
            "event_timestamp": F.lit("2025-01-10").cast("timestamp_ntz"),
        }
    )
    txns = frame(
        spark,
        "transaction_id string, user_id string, platform string, total_amount double, is_first_purchase boolean, product_category string, transaction_timestamp time",
        ("t1", "both", "iOS", 10.0, True, "toys", "2025-01-12 23:00:00"),
        ("t2", "buy", "iOS", 5.0, None, "toys", "2025-01-12"),
    )
    rows = {r["user_id"]: r for r in gold.gold_user_conversion(activity, txns, AS_OF).collect()}
    assert {u: r["has_converted"] for u, r in rows.items()} == {"both": True, "look": False, "buy": False}
    assert rows["both"]["session_conversion_rate"] == 50.0 and rows["both"]["days_to_first_purchase"] == 2
    buy = rows["buy"]
    assert (buy["total_events"], buy["total_sessions"], buy["bounce_sessions"], buy["organic_sessions"]) == (0, 0, 0, None)
    assert (buy["session_conversion_rate"], buy["bounce_rate"], buy["customer_segment"]) == (0.0, 0.0, "One-Time Buyer")
    look = rows["look"]
    assert (look["total_transactions"], look["total_revenue"], look["customer_segment"]) == (0, 0.0, "Non-Purchaser")
    assert look["first_purchase_count"] is None and look["session_conversion_rate"] == 0.0


def test_segments(spark):
    df = spark.createDataFrame([(i, n) for i, n in enumerate([None, 1, 2, 5, 6])], "i int, n bigint")
    out = [r["s"] for r in df.select("i", customer_segment("n").alias("s")).orderBy("i").collect()]
    assert out == ["Non-Purchaser", "One-Time Buyer", "Repeat Buyer", "Repeat Buyer", "Loyal Customer"]


def test_categories(spark):
    df = spark.createDataFrame(
        [(i, p) for i, p in enumerate([90.0, 89.99, 70.0, 40.0, 39.99, None, float("nan")])], "i int, p double"
    )
    out = [r["c"] for r in df.select("i", gold.engagement_category("p").alias("c")).orderBy("i").collect()]
    assert out == ["highly_engaged", "engaged", "engaged", "moderate", "low", "low", "low"]


def test_users_are_counted_once_per_group(spark):
    events = frame(
        spark,
        "platform string, event_type string, device_type string, event_date string, user_id string, device_id string",
        ("iOS", "click", "mobile", "2025-01-01", "u", "d"),
        ("iOS", "scroll", "mobile", "2025-01-01", "u", "d"),
        ("iOS", None, None, "2025-01-01", None, None),
    ).withColumn("event_date", F.col("event_date").cast("date"))
    row = gold.gold_platform_events(events, AS_OF).first()
    assert (row["total_events"], row["total_unique_users"], row["days_active"]) == (3, 2, 1)
    assert (row["click_events"], row["page_view_events"], row["mobile_events"]) == (1, 0, 2)


def test_no_users_gives_null_not_an_error(spark):
    events = frame(
        spark,
        "platform string, event_type string, device_type string, event_date string, user_id string, device_id string",
        ("iOS", "click", "mobile", None, None, None),
    ).withColumn("event_date", F.col("event_date").cast("date"))
    row = gold.gold_platform_events(events, AS_OF).first()
    assert row["avg_events_per_user"] is None and row["avg_events_per_day"] is None


def test_modes(spark):
    df = frame(
        spark, "u string, a string, b string",
        ("x", "b", None), ("x", "a", None), ("x", "b", None), ("x", "a", None), ("x", "c", None),
        ("y", None, "k"), (None, "z", "z"),
    )
    out = {r["u"]: (r["ma"], r["mb"]) for r in mode_per_key(df, "u", {"a": "ma", "b": "mb"}).collect()}
    assert out == {"x": ("a", None), "y": (None, "k")}


# ---- ranks ------------------------------------------------------------------


def test_rank_of_ties(spark):
    df = spark.createDataFrame([(10.0,), (20.0,), (20.0,), (30.0,)], "s double")
    assert sorted(r["p"] for r in pct_rank_avg(df, "s", "p").collect()) == [25.0, 62.5, 62.5, 100.0]


@pytest.mark.parametrize("n, buckets", [(1, 4), (500, 2), (5000, 16)])
def test_rank_against_pandas(spark, n, buckets):
    """Heavy ties on one value, infinities, NULL and NaN."""
    import random

    rnd = random.Random(n)
    values = [1.0 if rnd.random() < 0.4 else round(rnd.gauss(0, 50), 1) for _ in range(n)]
    extra = [None, float("nan"), float("inf"), float("-inf"), -0.0] if n > 1 else []
    rows = list(enumerate(values + extra))
    df = spark.createDataFrame(rows, "i int, s double").repartition(5)
    got = {r["i"]: r["p"] for r in pct_rank_avg(df, "s", "p", buckets=buckets).collect()}
    want = pd.Series([v for _, v in rows], dtype="float64").rank(pct=True) * 100
    assert len(got) == len(rows)
    for i, w in want.items():
        assert (got[i] is None) if math.isnan(w) else got[i] == pytest.approx(w, rel=1e-12)


def test_rank_of_nothing(spark):
    assert pct_rank_avg(spark.createDataFrame([], "s double"), "s", "p").columns == ["s", "p"]
    assert pct_rank_avg(spark.createDataFrame([(None,)], "s double"), "s", "p").first()["p"] is None


def test_engagement_against_pandas(spark, sf_dir):
    from eventmart.workload.queries import QUERIES

    events = QUERIES["silver_device_events"](spark, sf_dir)
    got = gold.gold_user_engagement(events).toPandas().set_index(["user_id", "event_date"]).sort_index()
    df = events.toPandas()
    by = df.groupby(["user_id", pd.to_datetime(df["event_date"])])
    span = (by["event_timestamp"].max() - by["event_timestamp"].min()).dt.total_seconds() / 60
    score = by["event_id"].count() * 1.0 + by["session_id"].nunique() * 5.0 + by["event_type"].nunique() * 3.0 + span * 0.5
    pct = (score.rank(pct=True) * 100).sort_index()
    assert len(got) == len(pct)
    assert abs(got["engagement_percentile"].to_numpy() - pct.to_numpy()).max() < 1e-9
    usual = df.groupby("user_id")["browser"].agg(lambda x: x.mode()[0])
    assert (got["primary_browser"].groupby("user_id").first() == usual).all()


# ---- numbers ----------------------------------------------------------------


@pytest.mark.parametrize(
    "x, want",
    [(1.005, 1.0), (2.5, 2.5), (-1.235, -1.24), (0.125, 0.13), (1e17, 1e17), (None, None), (float("inf"), float("inf"))],
)
def test_round(spark, x, want):
    assert one(spark.createDataFrame([(x,)], "x double").select(round_half_up("x"))) == want


def test_ratios(spark):
    df = spark.createDataFrame([(1, 3), (1, 0), (None, 2)], "a bigint, b bigint")
    assert [r[0] for r in df.select(safe_ratio("a", "b", 100.0)).collect()] == [33.33, None, None]
    assert [r[0] for r in df.select(guarded_rate("a", "b")).collect()] == [33.33, 0.0, None]


def test_exact_sum_ignores_order_and_survives_extremes(spark):
    values = [0.1] * 10 + [1e15, -1e15, 3.3]
    sums = {one(spark.createDataFrame([(v,) for v in vs], "x double").agg(exact_sum("x"))) for vs in (values, values[::-1])}
    assert sums == {4.3}
    assert one(spark.createDataFrame([(1e300,), (1.0,)], "x double").agg(exact_sum("x"))) == 1e300
    assert math.isnan(one(spark.createDataFrame([(float("nan"),), (1.0,)], "x double").agg(exact_sum("x"))))
    assert one(spark.createDataFrame([(None,), (1.5,), (2.5,)], "x double").agg(exact_avg("x"))) == 2.0
    assert one(spark.createDataFrame([], "x double").agg(exact_sum("x"))) is None


# ---- checks -----------------------------------------------------------------


def test_null_passes_all_but_not_null(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    report = run_checks(df, [not_null("x"), unique("x"), accepted_values("x", [1.0]), accepted_range("x", 0, 1)])
    assert [(r["check"], r["failing_rows"]) for r in report.orderBy("check").collect()] == [
        ("accepted_range", 0), ("accepted_values", 0), ("not_null", 2), ("unique", 0),
    ]


def test_bounds_inclusive_and_strict(spark):
    df = spark.createDataFrame([(0.0,), (0.5,), (1.0,), (1.1,)], "x double")
    bad = lambda c: sorted(r["x"] for r in failing_rows(df, c).collect())
    assert bad(accepted_range("x", 0, 1)) == [1.1]
    assert bad(accepted_range("x", 0, 1, inclusive=False)) == [0.0, 1.0, 1.1]
    assert bad(accepted_range("x", low=0.5)) == [0.0]
    assert bad(accepted_range("x", high=0.5)) == [1.0, 1.1]
    assert bad(accepted_range("x")) == []


def test_unique_over_two_columns_and_empty_input(spark):
    df = frame(spark, "a string, b int", ("u", 1), ("u", 2), ("u", 2), (None, 3), (None, 3))
    assert [tuple(r) for r in failing_rows(df, unique("a", "b")).collect()] == [("u", 2, 2)]
    assert all(r["passed"] for r in run_checks(df.limit(0), [not_null("a"), unique("a", "b")]).collect())


# ---- stale unmatched rows ---------------------------------------------------


def test_late_session_adds_a_second_row_and_retract_removes_the_first(spark):
    raw = frame(
        spark,
        "event_id string, event_timestamp time, user_id string, platform string, event_window_start time",
        ("e", "2025-01-30 10:01:00", "u", "p", "2025-01-30 10:00:00"),
    ).withColumns({c: F.lit("x") for c in ("device_id", "device_type", "event_type", SOURCE)})
    devices = raw.withColumn("event_date", F.to_date("event_timestamp")).withColumn("loaded_at", F.col("event_timestamp"))
    sessions = frame(
        spark,
        "session_id string, session_timestamp time, user_id string, platform string, session_window_start time",
        ("s", "2025-01-30 10:03:00", "u", "p", "2025-01-30 10:00:00"),
    ).withColumns({c: F.lit("x") for c in ("referrer", "landing_page", SOURCE)}).withColumns(
        {c: F.lit(1).cast("bigint") for c in ("session_duration_seconds", "pages_viewed", "interactions")}
    ).withColumn("is_bounce", F.lit(False)).withColumn("session_date", F.to_date("session_timestamp")).withColumn(
        "loaded_at", F.col("session_timestamp")
    )
    first = silver.silver_user_activity(devices, sessions.limit(0), as_of=AS_OF)
    second = silver.silver_user_activity(devices, sessions, target=first, as_of=AS_OF)
    both = upsert(first, second, "activity_id")
    assert sorted(r["activity_id"] for r in both.collect()) == ["e_no_session", "e_s"]
    assert [r["activity_id"] for r in silver.stale_unmatched(second).collect()] == ["e_no_session"]
