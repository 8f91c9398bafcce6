"""Plans hold at scale: pruning, pushdown, partial steps before shuffles, no Python nodes."""

import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from eventmart.operators.dedup import latest_per_key
from eventmart.operators.incremental import Bounds, within_lookback
from eventmart.operators.joins import interval_join
from eventmart.operators.ranks import pct_rank_avg
from eventmart.plans import gold, silver
from eventmart.plans.refresh import Warehouse
from eventmart.session import shared_root
from eventmart.sources.landing import land_batch
from eventmart.workload import families as fam
from eventmart.workload.queries import QUERIES

AS_OF = datetime(2024, 1, 30)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def warehouse(spark, sf_dir, tmp_path_factory):
    root = tmp_path_factory.mktemp("w")
    ev = fam.events(spark, sf_dir)
    for family, raw in fam.RAW.items():
        land_batch(raw(ev, as_text=True), f"{root}/in", family, fam.STAMP)
    w = Warehouse(spark, str(root))
    w.refresh(f"{root}/in", AS_OF, layers=("bronze", "silver"))
    return w


def test_dedup_limits_groups_before_the_shuffle(spark, sf_dir):
    text = plan(latest_per_key(fam.table(spark, sf_dir, "events"), "user_id", ["ts"]))
    assert text.count("WindowGroupLimit") == 2
    assert text.rindex("WindowGroupLimit") > text.index("Exchange")


def test_hot_key_sends_one_row_per_task(spark):
    """A third of all rows share a key: the shuffle carries a handful of them."""
    rows = spark.range(0, 90_000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("t")
    )
    out = latest_per_key(rows, "k", ["t"])
    out.collect()
    text = out._jdf.queryExecution().executedPlan()
    written = []

    def walk(node):
        if node.nodeName() == "Exchange":
            written.append(node.metrics().apply("shuffleRecordsWritten").value())
        if node.nodeName().endswith("QueryStage"):
            walk(node.plan())
        if node.nodeName() == "AdaptiveSparkPlan":
            walk(node.executedPlan())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(text)
    assert written == [60_000 + 6]


@pytest.mark.parametrize(
    "name",
    ["silver_device_events", "silver_transactions", "silver_user_activity", "gold_platform_events", "gold_user_conversion", "gold_user_engagement"],
)
def test_data_sets_stay_on_the_jvm(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert not re.search(r"Python|Pandas|CartesianProduct|BroadcastNestedLoop", text)


@pytest.mark.parametrize("name", ["silver_device_events", "silver_user_activity", "user_mode", "user_day_metrics", "upsert"])
def test_rows_never_meet_in_one_partition(spark, sf_dir, name):
    assert "SinglePartition" not in plan(QUERIES[name](spark, sf_dir))


def test_rank_sorts_only_bucket_totals_in_one_partition(spark, sf_dir):
    """The staged ranks come from a plan whose one single-partition step follows an aggregation."""
    from eventmart.operators import ranks

    values = fam.table(spark, sf_dir, "events").select("value")
    _, df = ranks._value_ranks(values, "value", "p", 100.0, 4)
    text = plan(df)
    assert text.count("SinglePartition") == 1
    below = text[text.index("SinglePartition"):].splitlines()[1]
    assert "HashAggregate" in below and "_bucket" in below


def test_hot_scores_are_joined_by_broadcast(spark):
    rows = spark.range(5000).select(
        "id", F.when(F.col("id") % 3 == 0, 0.0).otherwise(F.col("id").cast("double")).alias("s")
    )
    text = plan(pct_rank_avg(rows, "s", "p"))
    assert "BroadcastHashJoin" in text and "LeftAnti" in text


def test_lookback_prunes_days_and_row_groups(warehouse):
    newest = datetime(2024, 1, 28, 12)
    bounds = Bounds(True, newest, newest - timedelta(minutes=20))
    stored = warehouse.read("silver_device_events")
    text = plan(within_lookback(stored, "event_window_start", bounds, date_col="event_date").select("event_id"))
    assert re.search(r"PartitionFilters: \[.*event_date#\d+ >= 2024-01-28", text)
    assert "GreaterThanOrEqual(event_window_start" in text
    assert "browser" not in text


def test_platform_mart_reads_only_its_columns(warehouse):
    text = plan(gold.platform_daily(warehouse.read("silver_device_events")))
    read = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert {c.split(":")[0] for c in read.split(",")} == {"user_id", "device_id", "device_type", "platform", "event_type"}


def test_payload_leaves_are_pruned(warehouse):
    flat = silver.silver_device_events(warehouse.read("bronze_device_events"), as_of=AS_OF)
    raw = warehouse.read("bronze_device_events")
    from eventmart.functions.payload import unpack_payload

    text = plan(unpack_payload(raw).select("browser", "latitude"))
    assert "payload:struct<browser:string,location:struct<latitude:double>>" in text
    assert flat.columns[-1] == "network_type"


def test_interval_join_is_an_equi_join_on_time_buckets(spark, sf_dir):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ev = fam.table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
        text = plan(interval_join(ev, ev, ["user_id"], "ts", "ts", 300, {"event_id": "m"}))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert re.search(r"SortMergeJoin \[_bucket#\d+L, user_id#\d+L\], \[_r_bucket#\d+L, _r_user_id#\d+L\]", text)


def test_upsert_never_reads_what_it_does_not_touch(warehouse):
    """Marks come from the pointer file: bounds cost no scan."""
    table = warehouse.table("silver_device_events")
    newest = warehouse.read("silver_device_events").agg(F.max("event_window_start")).first()[0]
    assert table.bounds("event_window_start", 20).max_window == newest


def test_shared_folder_is_the_configured_one(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        assert shared_root(spark) == root.rstrip("/")
