"""Every registered query: the Spark side, with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.functions.payload import unpack_payload
from eventmart.functions.scoring import customer_segment, exact_sum, round_half_up, safe_ratio
from eventmart.functions.timecols import minutes_between, parse_timestamp, time_literal, whole_days_between, window_start
from eventmart.operators.aggregates import conditional_sums, count_true, mode_per_key
from eventmart.operators.dedup import latest_per_key
from eventmart.operators.incremental import (
    high_water,
    lookback_bounds,
    max_or,
    new_or_changed,
    upsert,
    within_lookback,
)
from eventmart.operators.joins import full_outer_merge, hot_keys, interval_join, left_merge
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
from eventmart.plans import bronze, checks, gold, silver
from eventmart.schemas import EVENT_TYPES
from eventmart.session import shared_path, stage
from eventmart.sources.landing import land_batch, with_line_total
from eventmart.sources.scan import (
    SOURCE,
    family_files,
    scan_events,
    schema_union,
)
from eventmart.sources.scan import source_inventory as count_sources
from eventmart.sources.scan import source_rows as rows_per_batch
from eventmart.workload import families as fam
from eventmart.workload.oracle import AS_OF as SQL_AS_OF
from eventmart.workload.oracle import with_ctes

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

SPLIT = f"TIMESTAMP '{fam.SPLIT_AT}'"
REPEAT = f"TIMESTAMP '{fam.REPEAT_FROM}'"


def query(sql: str | None = None, ctes: tuple[str, ...] = (), name: str | None = None):
    """Register a query under its function name; without `sql` only its rows are checked."""

    def register(fn: Query) -> Query:
        key = name or fn.__name__
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = with_ctes(sql, *ctes)
        return fn

    return register


# ---- inputs -----------------------------------------------------------------


def _bronze_devices(spark, sf_dir):
    return fam.bronze_device_with_copies(fam.events(spark, sf_dir))


def _silver_devices(spark, sf_dir):
    return silver.silver_device_events(_bronze_devices(spark, sf_dir), as_of=fam.AS_OF)


def _engagement_input(spark, sf_dir):
    """The mart reads its input twice; like the stored table, the rows are built once."""
    return stage(_silver_devices(spark, sf_dir).select(*gold.ENGAGEMENT_INPUT))


def _silver_transactions(spark, sf_dir):
    return silver.silver_transactions(
        fam.bronze(fam.events(spark, sf_dir), "transaction"), as_of=fam.AS_OF
    )


def _activity(spark, sf_dir, salts=1):
    return silver.silver_user_activity(
        _bronze_devices(spark, sf_dir),
        fam.bronze(fam.events(spark, sf_dir), "session"),
        as_of=fam.AS_OF,
        salts=salts,
    )


def money_rounded(df: DataFrame) -> DataFrame:
    """Sums of doubles to six digits, the most that does not hang on the order of adding."""
    money = [c for c in ("total_revenue", "avg_transaction_value") if c in df.columns]
    return df.withColumns({c: round_half_up(c, 6) for c in money})


def _first_batch(bronze: DataFrame, ts: str) -> DataFrame:
    return bronze.where(F.col(ts) < time_literal(fam.SPLIT_AT))


def _second_batch(bronze: DataFrame, ts: str) -> DataFrame:
    """What arrives after the split, plus a repeat of the last quarter hour, loaded later."""
    return bronze.where(F.col(ts) >= time_literal(fam.REPEAT_FROM)).withColumn(
        "loaded_at", F.col("loaded_at") + F.expr("INTERVAL 2 HOURS")
    )


# ---- sources and sinks ------------------------------------------------------


@query("SELECT event_id, event_type, value FROM events WHERE value >= 20")
def scan_project(spark, sf_dir):
    return (
        fam.table(spark, sf_dir, "events")
        .where(F.col("value") >= 20)
        .select("event_id", "event_type", "value")
    )


@query("SELECT COUNT(*) AS n_rows, MIN(event_timestamp) AS first_ts, MAX(event_timestamp) AS last_ts FROM bronze_device", ("bronze_device",))
def table_count(spark, sf_dir):
    return fam.bronze(fam.events(spark, sf_dir), "device").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("event_timestamp").alias("first_ts"),
        F.max("event_timestamp").alias("last_ts"),
    )


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def sample_limit(spark, sf_dir):
    return (
        fam.table(spark, sf_dir, "orders")
        .select("o_orderkey", "o_totalprice")
        .orderBy(F.desc("o_totalprice"), "o_orderkey")
        .limit(10)
    )


@query("SELECT event_type, COUNT(*) AS n_rows, 'events.parquet' AS source_file FROM events GROUP BY event_type")
def scan_with_filename(spark, sf_dir):
    """Provenance from the scan itself; a table stored as part files names the table."""
    table_name = F.regexp_extract(F.col("_metadata.file_path"), r"(events\.parquet)", 1)
    return (
        fam.table(spark, sf_dir, "events")
        .groupBy("event_type", table_name.alias("source_file"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def _land_transactions(spark, sf_dir) -> str:
    """The transaction family landed as three batches by event id."""
    directory = shared_path(spark, "landing")
    ev = fam.events(spark, sf_dir)
    for i in range(3):
        raw = fam.raw_transaction(ev.where(F.pmod(F.floor(F.col("event_id") / 4), F.lit(3)) == i), as_text=True)
        land_batch(raw, directory, "transaction", f"2024013{i}_000000")
    return directory


_BATCH_OF_TXN = "CAST(floor(CAST(substr(transaction_id, 5) AS BIGINT) / 4) AS BIGINT) % 3"


@query(
    f"""SELECT * EXCLUDE (source_filename, loaded_at),
      'transaction_events_2024013' || ({_BATCH_OF_TXN}) || '_000000.parquet' AS source_filename,
      TIMESTAMP '2024-01-31 00:00:00' AS loaded_at
    FROM bronze_transaction WHERE {_BATCH_OF_TXN} > 0""",
    ("bronze_transaction",),
)
def file_high_water(spark, sf_dir):
    """Three batches on disk, the first one loaded already: only the other two are read."""
    directory = _land_transactions(spark, sf_dir)
    loaded = scan_events(spark, directory, "transaction").where(
        F.col(SOURCE) <= "transaction_events_20240130_000000.parquet"
    )
    return bronze.load(spark, directory, "transaction", mark=high_water(loaded), as_of=fam.LOADED_AT)


@query(
    f"""SELECT 'transaction_events_2024013' || ({_BATCH_OF_TXN}) || '_000000.parquet' AS source_filename,
      'transaction' AS family, COUNT(*) AS n_rows FROM bronze_transaction GROUP BY ALL""",
    ("bronze_transaction",),
)
def source_rows(spark, sf_dir):
    return rows_per_batch(spark, _land_transactions(spark, sf_dir), "transaction")


@query(
    """WITH days AS (SELECT DISTINCT CAST(ts AS DATE) AS day, event_type FROM events)
    SELECT family, count(DISTINCT week) AS files FROM (
      SELECT 'device' AS family, date_trunc('week', day) AS week FROM days
      UNION ALL SELECT 'session', date_trunc('week', day) FROM days WHERE event_type = 'signup'
      UNION ALL SELECT 'transaction', date_trunc('week', day) FROM days WHERE event_type = 'purchase') GROUP BY family"""
)
def source_inventory(spark, sf_dir):
    """All families landed, a batch for each week that has rows."""
    directory = shared_path(spark, "landing")
    ev = fam.events(spark, sf_dir).withColumn("week", F.date_trunc("week", "ts").cast("date"))
    for family, kind in (("device", None), ("session", "signup"), ("transaction", "purchase")):
        own = ev if kind is None else ev.where(F.col("event_type") == kind)
        for week in sorted(r["week"] for r in own.select("week").distinct().collect()):
            raw = fam.RAW[family](own.where(F.col("week") == F.lit(week)), as_text=True)
            land_batch(raw, directory, family, f"{week:%Y%m%d}_000000")
    return count_sources(spark, directory)


@query(
    """SELECT transaction_id, CAST(quantity AS DOUBLE) AS quantity,
      CASE WHEN CAST(substr(transaction_id, 5) AS BIGINT) % 8 = 0 THEN NULL ELSE product_category END AS product_category
    FROM bronze_transaction""",
    ("bronze_transaction",),
    name="schema_union",
)
def schema_union_query(spark, sf_dir):
    """One batch lacks a column and stores quantity as int, the other stores it as double."""
    directory = shared_path(spark, "landing")
    rows = fam.raw_transaction(fam.events(spark, sf_dir)).select(
        "transaction_id", "quantity", "product_category"
    )
    even = F.substring("transaction_id", 5, 20).cast("bigint") % 8 == 0
    land_batch(
        rows.where(even).select("transaction_id", F.col("quantity").cast("int").alias("quantity")),
        directory, "transaction", "20240130_000000",
    )
    land_batch(
        rows.where(~even).withColumn("quantity", F.col("quantity").cast("double")),
        directory, "transaction", "20240130_000010",
    )
    files = [r["file"] for r in family_files(spark, directory, "transaction").select("file").collect()]
    return schema_union(spark, files)


@query(
    "SELECT l_orderkey, l_linenumber, l_extendedprice AS unit_price, l_quantity AS quantity, l_extendedprice * l_quantity AS total_amount FROM lineitem"
)
def line_total(spark, sf_dir):
    return with_line_total(
        fam.table(spark, sf_dir, "lineitem").select(
            "l_orderkey",
            "l_linenumber",
            F.col("l_extendedprice").alias("unit_price"),
            F.col("l_quantity").alias("quantity"),
        )
    )


@query(
    """SELECT 'transaction_events_20240130_000000.parquet' AS source_filename, COUNT(*) AS n_rows,
      round(sum(total_amount), 6) AS revenue FROM bronze_transaction""",
    ("bronze_transaction",),
    name="land_batch",
)
def land_batch_query(spark, sf_dir):
    """Land a batch whose totals are still zero; the sink fills them in."""
    directory = shared_path(spark, "landing")
    raw = fam.raw_transaction(fam.events(spark, sf_dir), as_text=True).withColumn("total_amount", F.lit(0.0))
    land_batch(raw, directory, "transaction", "20240130_000000")
    return (
        scan_events(spark, directory, "transaction")
        .groupBy(SOURCE)
        .agg(F.count(F.lit(1)).alias("n_rows"), round_half_up(exact_sum("total_amount"), 6).alias("revenue"))
    )


# ---- bronze -----------------------------------------------------------------

_LEAVES = (
    "screen_resolution, browser, browser_version, city, country, latitude, longitude, "
    "session_id, is_new_session, page_load_time_ms, network_type"
)


def _land_drifted(spark, sf_dir, family, drift) -> str:
    """A family as three batches by event id; `drift` changes what the second and the third hold."""
    directory = shared_path(spark, "landing")
    ev = fam.events(spark, sf_dir)
    for i, change in enumerate((lambda df: df, *drift)):
        part = ev.where(F.pmod(F.floor(F.col("event_id") / 4), F.lit(3)) == i)
        land_batch(change(fam.RAW[family](part, as_text=True)), directory, family, f"20240131_0000{i}0")
    return directory


def _drifted_sql(family: str, key: str, absent: str) -> str:
    """The bronze table where the third batch lacks a column."""
    batch = f"CAST(floor(CAST({key} AS BIGINT) / 4) AS BIGINT) % 3"
    return f"""SELECT * REPLACE (CASE WHEN {batch} = 2 THEN NULL ELSE {absent} END AS {absent},
      '{family}_events_20240131_0000' || ({batch}) || '0.parquet' AS source_filename) FROM bronze_{family}"""


@query(_drifted_sql("device", "event_id", "device_type"), ("bronze_device",))
def bronze_device_events(spark, sf_dir):
    """Payload as struct, as JSON text, and with a leaf of another type where a column is absent."""
    slower = F.col("payload").withField("performance.page_load_time_ms", F.col("payload.performance.page_load_time_ms").cast("double"))
    drift = (
        lambda df: df.withColumn("payload", F.to_json("payload")),
        lambda df: df.withColumn("payload", slower).drop("device_type"),
    )
    directory = _land_drifted(spark, sf_dir, "device", drift)
    return unpack_payload(bronze.load(spark, directory, "device", as_of=fam.LOADED_AT))


@query(_drifted_sql("session", "substr(session_id, 6)", "referrer"), ("bronze_session",))
def bronze_session_events(spark, sf_dir):
    """Whole numbers as doubles, then a boolean as text where a column is absent."""
    drift = (
        lambda df: df.withColumns({c: F.col(c).cast("double") for c in ("pages_viewed", "interactions")}),
        lambda df: df.withColumn("is_bounce", F.col("is_bounce").cast("string")).drop("referrer"),
    )
    return bronze.load(spark, _land_drifted(spark, sf_dir, "session", drift), "session", as_of=fam.LOADED_AT)


@query(_drifted_sql("transaction", "substr(transaction_id, 5)", "product_category"), ("bronze_transaction",))
def bronze_transaction_events(spark, sf_dir):
    """Quantity as double, then as int, with event time already a timestamp, where a column is absent."""
    drift = (
        lambda df: df.withColumn("quantity", F.col("quantity").cast("double")),
        lambda df: df.withColumns({"quantity": F.col("quantity").cast("int"), "timestamp": parse_timestamp("timestamp")}).drop("product_category"),
    )
    return bronze.load(spark, _land_drifted(spark, sf_dir, "transaction", drift), "transaction", as_of=fam.LOADED_AT)


@query(
    """SELECT event_id, date_trunc('minute', ts) - to_minutes(CAST(EXTRACT(minute FROM ts) AS BIGINT) % 10) AS window_start FROM events"""
)
def window_10m(spark, sf_dir):
    return fam.table(spark, sf_dir, "events").select("event_id", window_start("ts").alias("window_start"))


@query(
    """SELECT date_trunc('minute', ts) - to_minutes(CAST(EXTRACT(minute FROM ts) AS BIGINT) % 10) AS window_start,
      event_type, COUNT(*) AS n_events FROM events GROUP BY ALL"""
)
def tumbling_counts(spark, sf_dir):
    return (
        fam.table(spark, sf_dir, "events")
        .groupBy(window_start("ts").alias("window_start"), "event_type")
        .agg(F.count(F.lit(1)).alias("n_events"))
    )


# ---- dedup, unpack, validate ------------------------------------------------


@query(
    "SELECT event_id, user_id, event_type, event_timestamp, loaded_at FROM device_latest",
    ("device_latest",),
)
def dedup_latest(spark, sf_dir):
    rows = _bronze_devices(spark, sf_dir).select(
        "event_id", "user_id", "event_type", "event_timestamp", "loaded_at"
    )
    return latest_per_key(rows, "event_id", ["loaded_at", "event_timestamp"])


@query(
    """SELECT user_id, event_id, ts FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
      FROM events) WHERE rn = 1"""
)
def dedup_latest_per_user(spark, sf_dir):
    return latest_per_key(
        fam.table(spark, sf_dir, "events").select("user_id", "event_id", "ts"), "user_id", ["ts", "event_id"]
    )


@query(f"SELECT event_id, {_LEAVES} FROM bronze_device", ("bronze_device",))
def json_unpack(spark, sf_dir):
    """The payload as JSON text."""
    rows = fam.raw_device(fam.events(spark, sf_dir)).select("event_id", F.to_json("payload").alias("payload"))
    return unpack_payload(rows)


@query(f"SELECT event_id, {_LEAVES} FROM bronze_device", ("bronze_device",))
def struct_unpack(spark, sf_dir):
    return unpack_payload(fam.raw_device(fam.events(spark, sf_dir)).select("event_id", "payload"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def json_props(spark, sf_dir):
    return unpack_payload(
        fam.table(spark, sf_dir, "events").select("event_id", "props"), "props", {"k": ("k", "int")}
    )


@query(
    f"""SELECT event_id, event_timestamp, user_id FROM bronze_device
    WHERE event_timestamp <= {SQL_AS_OF} AND event_timestamp >= {SQL_AS_OF} - INTERVAL 7 DAY""",
    ("bronze_device",),
)
def validate_device(spark, sf_dir):
    rows = fam.bronze(fam.events(spark, sf_dir), "device")
    return validate_events(rows, silver.DEVICE_REQUIRED, "event_timestamp", fam.AS_OF, max_age_days=7).select(
        "event_id", "event_timestamp", "user_id"
    )


@query(
    f"""SELECT transaction_id, quantity, total_amount FROM bronze_transaction
    WHERE total_amount >= 0 AND quantity > 0 AND transaction_timestamp <= {SQL_AS_OF}
      AND transaction_timestamp >= {SQL_AS_OF} - INTERVAL 30 DAY""",
    ("bronze_transaction",),
)
def validate_txn(spark, sf_dir):
    rows = fam.bronze(fam.events(spark, sf_dir), "transaction")
    return silver.validate_transactions(rows, fam.AS_OF).select("transaction_id", "quantity", "total_amount")


@query("SELECT activity_id, event_id FROM activity", ("activity",))
def validate_activity(spark, sf_dir):
    return _activity(spark, sf_dir).select("activity_id", "event_id")


# ---- incremental ------------------------------------------------------------


@query(
    f"""SELECT event_id, event_window_start FROM bronze_device WHERE event_window_start >=
      (SELECT COALESCE(MAX(event_window_start), TIMESTAMP '1970-01-01') - INTERVAL 20 MINUTE FROM bronze_device
       WHERE event_timestamp < {SPLIT})""",
    ("bronze_device",),
)
def lookback_inclusive(spark, sf_dir):
    rows = fam.bronze(fam.events(spark, sf_dir), "device")
    bounds = lookback_bounds(_first_batch(rows, "event_timestamp"), "event_window_start")
    return within_lookback(rows, "event_window_start", bounds, date_col="event_date").select(
        "event_id", "event_window_start"
    )


@query(
    f"""SELECT event_id, event_window_start FROM bronze_device WHERE event_window_start >
      (SELECT COALESCE(MAX(event_window_start), TIMESTAMP '1970-01-01') - INTERVAL 20 MINUTE FROM bronze_device
       WHERE event_timestamp < {SPLIT})""",
    ("bronze_device",),
)
def lookback_strict(spark, sf_dir):
    rows = fam.bronze(fam.events(spark, sf_dir), "device")
    bounds = lookback_bounds(_first_batch(rows, "event_timestamp"), "event_window_start")
    return within_lookback(
        rows, "event_window_start", bounds, strict=True, date_col="event_date"
    ).select("event_id", "event_window_start")


@query("SELECT event_type, MAX(ts) AS newest FROM events GROUP BY event_type")
def max_per_type(spark, sf_dir):
    return fam.table(spark, sf_dir, "events").groupBy("event_type").agg(F.max("ts").alias("newest"))


@query("SELECT COALESCE(MAX(ts), TIMESTAMP '1970-01-01') AS newest FROM events WHERE event_type = 'none'")
def max_with_default(spark, sf_dir):
    none = fam.table(spark, sf_dir, "events").where(F.col("event_type") == "none")
    return max_or(none, "ts", time_literal("1970-01-01"), "newest")


@query(
    f"""SELECT n.event_id, n.event_type, n.loaded_at FROM device_latest n
      LEFT JOIN (SELECT * FROM bronze_device WHERE event_timestamp < {SPLIT}) t ON n.event_id = t.event_id
      WHERE t.event_id IS NULL OR n.loaded_at > t.loaded_at""",
    ("device_latest",),
    name="new_or_changed",
)
def new_or_changed_query(spark, sf_dir):
    ev = fam.events(spark, sf_dir)
    columns = ["event_id", "event_type", "loaded_at"]
    target = _first_batch(fam.bronze(ev, "device"), "event_timestamp").select("event_id", "loaded_at")
    batch = latest_per_key(fam.bronze_device_with_copies(ev).select(*columns), "event_id", ["loaded_at"])
    return new_or_changed(batch, target, "event_id", "loaded_at")


@query(
    f"""SELECT event_id, user_id, event_type, loaded_at FROM bronze_device
      WHERE event_timestamp < {SPLIT} AND CAST(event_id AS BIGINT) NOT IN (SELECT CAST(event_id AS BIGINT) FROM bronze_device WHERE event_timestamp >= {REPEAT})
    UNION ALL SELECT event_id, user_id, event_type, loaded_at + INTERVAL 2 HOUR FROM bronze_device WHERE event_timestamp >= {REPEAT}""",
    ("bronze_device",),
    name="upsert",
)
def upsert_query(spark, sf_dir):
    rows = fam.bronze(fam.events(spark, sf_dir), "device")
    columns = ["event_id", "user_id", "event_type", "loaded_at"]
    return upsert(
        _first_batch(rows, "event_timestamp").select(*columns),
        _second_batch(rows, "event_timestamp").select(*columns),
        "event_id",
    )


@query(
    f"""SELECT b.* EXCLUDE (source_filename, loaded_at), b.loaded_at + INTERVAL 2 HOUR AS loaded_at FROM bronze_device b
    WHERE event_window_start >= (SELECT MAX(event_window_start) - INTERVAL 20 MINUTE FROM bronze_device WHERE event_timestamp < {SPLIT})
      AND event_timestamp >= {REPEAT} AND event_timestamp <= {SQL_AS_OF}""",
    ("bronze_device",),
)
def silver_device_increment(spark, sf_dir):
    """The second of two runs: rows inside the lookback that are new or were loaded again."""
    rows = fam.bronze(fam.events(spark, sf_dir), "device")
    first = _first_batch(rows, "event_timestamp")
    target = silver.silver_device_events(first, as_of=fam.AS_OF)
    both = first.unionByName(_second_batch(rows, "event_timestamp"))
    return silver.silver_device_events(both, target=target, as_of=fam.AS_OF)


@query(
    f"""SELECT t.* EXCLUDE (source_filename, loaded_at),
      CASE WHEN transaction_timestamp >= {REPEAT} THEN loaded_at + INTERVAL 2 HOUR ELSE loaded_at END AS loaded_at,
      {SQL_AS_OF} AS processed_at
    FROM bronze_transaction t
    WHERE transaction_window_start > (SELECT MAX(transaction_window_start) - INTERVAL 20 MINUTE FROM bronze_transaction WHERE transaction_timestamp < {SPLIT})
      AND transaction_timestamp <= {SQL_AS_OF}""",
    ("bronze_transaction",),
)
def silver_transactions_increment(spark, sf_dir):
    rows = fam.bronze(fam.events(spark, sf_dir), "transaction")
    first = _first_batch(rows, "transaction_timestamp")
    target = silver.silver_transactions(first, as_of=fam.AS_OF)
    both = first.unionByName(_second_batch(rows, "transaction_timestamp"))
    return silver.silver_transactions(both, target=target, as_of=fam.AS_OF)


_ACTIVITY_LOWER = (
    "(SELECT MAX(event_window_start) - INTERVAL 20 MINUTE FROM bronze_device "
    f"WHERE event_timestamp < {SPLIT} AND event_timestamp <= {SQL_AS_OF})"
)


@query(
    f"""SELECT d.event_id || '_' || COALESCE(s.session_id, 'no_session') AS activity_id, d.event_id, d.event_timestamp,
      s.session_id, s.referrer
    FROM bronze_device d LEFT JOIN (SELECT * FROM bronze_session WHERE session_window_start >= {_ACTIVITY_LOWER}) s
      ON d.user_id = s.user_id AND d.platform = s.platform
      AND s.session_timestamp BETWEEN d.event_timestamp - INTERVAL 5 MINUTE AND d.event_timestamp + INTERVAL 5 MINUTE
    WHERE d.event_window_start > {_ACTIVITY_LOWER} AND d.event_timestamp <= {SQL_AS_OF}""",
    ("bronze_device", "bronze_session"),
)
def silver_activity_increment(spark, sf_dir):
    ev = fam.events(spark, sf_dir)
    devices, sessions = fam.bronze(ev, "device"), fam.bronze(ev, "session")
    target = silver.silver_user_activity(
        _first_batch(devices, "event_timestamp"), _first_batch(sessions, "session_timestamp"), as_of=fam.AS_OF
    )
    return silver.silver_user_activity(devices, sessions, target=target, as_of=fam.AS_OF).select(
        "activity_id", "event_id", "event_timestamp", "session_id", "referrer"
    )


# ---- joins ------------------------------------------------------------------

_INTERVAL_SQL = """SELECT a.event_id, a.user_id, a.ts, b.event_id AS partner_id, b.ts AS partner_ts
  FROM events a LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') b
    ON a.user_id = b.user_id AND b.ts BETWEEN a.ts - INTERVAL 30 MINUTE AND a.ts + INTERVAL 30 MINUTE"""


def _interval(spark, sf_dir, salts, hot=None):
    rows = fam.table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    return interval_join(
        rows.drop("event_type"),
        rows.where(F.col("event_type") == "purchase"),
        ["user_id"],
        "ts",
        "ts",
        1800,
        {"event_id": "partner_id", "ts": "partner_ts"},
        salts=salts,
        hot=hot,
    )


@query(_INTERVAL_SQL)
def interval_join_left(spark, sf_dir):
    return _interval(spark, sf_dir, salts=1)


@query(_INTERVAL_SQL)
def interval_join_salted(spark, sf_dir):
    return _interval(spark, sf_dir, salts=4)


@query(_INTERVAL_SQL)
def interval_join_hot(spark, sf_dir):
    """Keys found frequent in their time bucket are dealt out, the others are not copied."""
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = fam.table(spark, sf_dir, "events").select("user_id", "ts")
    return _interval(spark, sf_dir, salts=1, hot=hot_keys(rows, ["user_id"], "ts", 1800, tasks))


@query(
    """SELECT a.event_id, a.ts, b.event_id AS partner_id
    FROM events a LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') b
      ON a.user_id = b.user_id AND abs(date_diff('microsecond', a.ts, b.ts)) <= 600000500"""
)
def interval_join_fraction(spark, sf_dir):
    """A reach that is no whole number of milliseconds."""
    rows = fam.table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    bought = rows.where(F.col("event_type") == "purchase")
    joined = interval_join(rows.drop("event_type"), bought, ["user_id"], "ts", "ts", 600.0005, {"event_id": "partner_id"})
    return joined.select("event_id", "ts", "partner_id")


@query(
    """SELECT o_orderkey, round(o_totalprice * 1e7 + 0.126, 2) AS large, round(o_totalprice * 1e10, 2) AS huge,
      round(-o_totalprice / 7, 3) AS small FROM orders"""
)
def round_large(spark, sf_dir):
    price = F.col("o_totalprice")
    return fam.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        round_half_up(price * 1e7 + 0.126).alias("large"),
        round_half_up(price * 1e10).alias("huge"),
        round_half_up(-price / 7, 3).alias("small"),
    )


@query("SELECT l_returnflag, round(sum(l_quantity * 1e-9), 9) AS total FROM lineitem GROUP BY l_returnflag")
def sum_small(spark, sf_dir):
    lines = fam.table(spark, sf_dir, "lineitem").groupBy("l_returnflag")
    return lines.agg(round_half_up(exact_sum(F.col("l_quantity") * 1e-9), 9).alias("total"))


@query("SELECT * FROM conversion", ("conversion",))
def full_outer_metrics(spark, sf_dir):
    return money_rounded(gold.conversion_metrics(_activity(spark, sf_dir), _silver_transactions(spark, sf_dir)))


@query(
    """SELECT COALESCE(c.key, s.key) AS nationkey, c.n_customers, s.n_suppliers,
      c.key IS NOT NULL AS in_left, s.key IS NOT NULL AS in_right
    FROM (SELECT c_nationkey AS key, COUNT(*) AS n_customers FROM customer GROUP BY 1) c
    FULL OUTER JOIN (SELECT s_nationkey + 5 AS key, COUNT(*) AS n_suppliers FROM supplier GROUP BY 1) s ON c.key = s.key"""
)
def full_outer_nations(spark, sf_dir):
    """Two whole tables; the suppliers' keys are moved by five, so both sides have keys of their own."""
    customers = (
        fam.table(spark, sf_dir, "customer")
        .groupBy(F.col("c_nationkey").alias("nationkey"))
        .agg(F.count(F.lit(1)).alias("n_customers"))
    )
    suppliers = (
        fam.table(spark, sf_dir, "supplier")
        .groupBy((F.col("s_nationkey") + 5).alias("nationkey"))
        .agg(F.count(F.lit(1)).alias("n_suppliers"))
    )
    return full_outer_merge(customers, suppliers, ["nationkey"])


@query(
    """SELECT u.user_id, u.event_date, u.total_events, c.primary_device, c.primary_platform, c.primary_browser
    FROM user_day u LEFT JOIN choices c ON u.user_id = c.user_id""",
    ("user_day", "choices"),
)
def left_merge_choices(spark, sf_dir):
    devices = _engagement_input(spark, sf_dir)
    days = gold.user_day_metrics(devices).select("user_id", "event_date", "total_events")
    return left_merge(days, gold.primary_choices(devices), "user_id")


# ---- aggregates -------------------------------------------------------------


@query("SELECT * FROM platform_daily", ("platform_daily",))
def platform_daily(spark, sf_dir):
    return gold.platform_daily(_silver_devices(spark, sf_dir))


@query("SELECT * FROM platform_rollup", ("platform_rollup",))
def platform_rollup(spark, sf_dir):
    return gold.platform_rollup(gold.platform_daily(_silver_devices(spark, sf_dir)))


@query(
    "SELECT l_returnflag, "
    + ", ".join(
        f"CAST(SUM(CASE WHEN l_linestatus = '{v}' THEN l_linenumber ELSE 0 END) AS BIGINT) AS lines_{v.lower()}"
        for v in ("O", "F")
    )
    + " FROM lineitem GROUP BY l_returnflag"
)
def conditional_line_sums(spark, sf_dir):
    return (
        fam.table(spark, sf_dir, "lineitem")
        .groupBy("l_returnflag")
        .agg(*conditional_sums("l_linestatus", {"O": "lines_o", "F": "lines_f"}, "l_linenumber"))
    )


@query(
    "SELECT user_id, "
    + ", ".join(
        f"CAST(SUM(CASE WHEN event_type = '{v}' THEN 1 ELSE 0 END) AS BIGINT) AS n_{v}" for v in EVENT_TYPES
    )
    + ", CAST(SUM(CASE WHEN is_new_session THEN 1 ELSE 0 END) AS BIGINT) AS n_new_sessions FROM silver_device GROUP BY user_id",
    ("silver_device",),
    name="conditional_sums",
)
def conditional_sums_query(spark, sf_dir):
    return (
        _silver_devices(spark, sf_dir)
        .groupBy("user_id")
        .agg(
            *conditional_sums("event_type", {v: f"n_{v}" for v in EVENT_TYPES}),
            count_true("is_new_session").alias("n_new_sessions"),
        )
    )


@query("SELECT * REPLACE (CAST(bounce_sessions AS BIGINT) AS bounce_sessions) FROM seen", ("seen",))
def user_activity_metrics(spark, sf_dir):
    return gold.user_activity_metrics(_activity(spark, sf_dir))


@query("SELECT * REPLACE (CAST(first_purchase_count AS BIGINT) AS first_purchase_count) FROM bought", ("bought",))
def transaction_metrics(spark, sf_dir):
    return money_rounded(gold.transaction_metrics(_silver_transactions(spark, sf_dir)))


@query("SELECT * FROM user_day", ("user_day",))
def user_day_metrics(spark, sf_dir):
    return gold.user_day_metrics(_silver_devices(spark, sf_dir))


@query("SELECT * FROM choices", ("choices",))
def user_mode(spark, sf_dir):
    return gold.primary_choices(_silver_devices(spark, sf_dir))


@query(
    """SELECT o_custkey, (SELECT p FROM (SELECT o_orderpriority AS p, COUNT(*) AS n FROM orders i
        WHERE i.o_custkey = u.o_custkey GROUP BY 1) ORDER BY n DESC, p LIMIT 1) AS usual_priority
    FROM (SELECT DISTINCT o_custkey FROM orders) u"""
)
def customer_mode(spark, sf_dir):
    return mode_per_key(
        fam.table(spark, sf_dir, "orders"), "o_custkey", {"o_orderpriority": "usual_priority"}
    )


# ---- ranks and scores -------------------------------------------------------


@query(
    """SELECT event_id, value, (rank() OVER (ORDER BY value) - 1 + (COUNT(*) OVER (PARTITION BY value) + 1) / CAST(2 AS DOUBLE))
      / CAST(COUNT(*) OVER () AS DOUBLE) * 100 AS pct FROM events""",
    name="pct_rank_avg",
)
def pct_rank_query(spark, sf_dir):
    return pct_rank_avg(fam.table(spark, sf_dir, "events").select("event_id", "value"), "value", "pct")


@query(
    "SELECT user_id, event_date, session_duration_minutes, engagement_score FROM scored", ("scored",)
)
def engagement_score(spark, sf_dir):
    return gold.engagement_scores(gold.user_day_metrics(_silver_devices(spark, sf_dir))).select(
        "user_id", "event_date", "session_duration_minutes", "engagement_score"
    )


@query(
    """SELECT event_id, CASE WHEN value >= 90 THEN 'highly_engaged' WHEN value >= 70 THEN 'engaged'
      WHEN value >= 40 THEN 'moderate' ELSE 'low' END AS category FROM events"""
)
def engagement_category(spark, sf_dir):
    return fam.table(spark, sf_dir, "events").select(
        "event_id", gold.engagement_category("value").alias("category")
    )


@query(
    """WITH bought AS (SELECT o_custkey AS c_custkey, count(*) AS n_orders FROM orders GROUP BY o_custkey),
    steps(least, most, segment) AS (VALUES (0, 0, 'Non-Purchaser'), (1, 1, 'One-Time Buyer'), (2, 5, 'Repeat Buyer'), (6, NULL, 'Loyal Customer'))
    SELECT c_custkey, n_orders, segment FROM customer LEFT JOIN bought USING (c_custkey)
    JOIN steps ON ifnull(n_orders, 0) >= least AND (most IS NULL OR ifnull(n_orders, 0) <= most)""",
    name="customer_segment",
)
def customer_segment_query(spark, sf_dir):
    counts = fam.table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"))
    customers = fam.table(spark, sf_dir, "customer").select("c_custkey")
    return customers.join(counts, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        "c_custkey", "n_orders", customer_segment("n_orders").alias("segment")
    )


@query("SELECT user_id, platform, days_to_first_purchase FROM gold_conversion", ("gold_conversion",))
def days_to_first_purchase(spark, sf_dir):
    both = gold.conversion_metrics(_activity(spark, sf_dir), _silver_transactions(spark, sf_dir))
    return both.select(
        "user_id",
        "platform",
        whole_days_between("first_activity_date", "first_purchase_date").alias("days_to_first_purchase"),
    )


@query(
    """SELECT o_orderkey, CAST(EXTRACT(DAY FROM (l.last_ship - o_orderdate)) AS BIGINT) AS days_to_ship,
      date_diff('microsecond', o_orderdate, l.last_ship) / CAST(1000000 AS DOUBLE) / CAST(60 AS DOUBLE) AS minutes_to_ship
    FROM orders JOIN (SELECT l_orderkey, MAX(l_shipdate) AS last_ship FROM lineitem GROUP BY 1) l ON l_orderkey = o_orderkey"""
)
def time_spans(spark, sf_dir):
    last = fam.table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("last_ship"))
    orders = fam.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return orders.join(last, F.col("o_orderkey") == F.col("l_orderkey")).select(
        "o_orderkey",
        whole_days_between("o_orderdate", "last_ship").alias("days_to_ship"),
        minutes_between("o_orderdate", "last_ship").alias("minutes_to_ship"),
    )


@query(
    """SELECT user_id, ROUND(CAST(COUNT(*) AS DOUBLE) / NULLIF(SUM(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END), 0), 2) AS events_per_purchase
    FROM events GROUP BY user_id""",
    name="safe_ratio",
)
def safe_ratio_query(spark, sf_dir):
    return (
        fam.table(spark, sf_dir, "events")
        .groupBy("user_id")
        .agg(F.count(F.lit(1)).alias("n"), *conditional_sums("event_type", {"purchase": "p"}))
        .select("user_id", safe_ratio("n", "p").alias("events_per_purchase"))
    )


@query(
    "SELECT user_id, platform, total_revenue, total_events FROM conversion ORDER BY total_revenue DESC, total_events DESC, user_id, platform LIMIT 10",
    ("conversion",),
)
def topk_revenue(spark, sf_dir):
    both = money_rounded(gold.conversion_metrics(_activity(spark, sf_dir), _silver_transactions(spark, sf_dir)))
    return (
        both.select("user_id", "platform", "total_revenue", "total_events")
        .orderBy(F.desc("total_revenue"), F.desc("total_events"), "user_id", "platform")
        .limit(10)
    )


# ---- data quality -----------------------------------------------------------


@query("SELECT event_id FROM joined WHERE session_id IS NULL", ("joined",))
def check_not_null(spark, sf_dir):
    joined = silver.silver_user_activity(
        _bronze_devices(spark, sf_dir),
        fam.bronze(fam.events(spark, sf_dir), "session"),
        as_of="2024-01-31 00:00:00",
    )
    return failing_rows(joined, not_null("session_id")).select("event_id")


@query("SELECT o_custkey, COUNT(*) AS n_records FROM orders GROUP BY o_custkey HAVING COUNT(*) > 1")
def check_unique(spark, sf_dir):
    return failing_rows(fam.table(spark, sf_dir, "orders"), unique("o_custkey"))


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus NOT IN ('F', 'O')")
def check_accepted_values(spark, sf_dir):
    orders = fam.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return failing_rows(orders, accepted_values("o_orderstatus", ["F", "O"]))


@query("SELECT l_orderkey, l_linenumber, l_discount FROM lineitem WHERE l_discount <= 0.0 OR l_discount >= CAST(0.08 AS DOUBLE)")
def check_accepted_range(spark, sf_dir):
    lines = fam.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_discount")
    return failing_rows(lines, accepted_range("l_discount", 0.0, 0.08, inclusive=False))


def _suite_sql(table: str, suite: list) -> str:
    """The report of a suite, one SELECT per check."""
    parts = []
    for c in suite:
        if c.kind == "unique":
            columns = [c.column] if isinstance(c.column, str) else list(c.column)
            present = " AND ".join(f"{x} IS NOT NULL" for x in columns)
            by = ", ".join(columns)
            count = f"(SELECT COUNT(*) FROM (SELECT {by} FROM {table} WHERE {present} GROUP BY {by} HAVING COUNT(*) > 1))"
        else:
            if c.kind == "not_null":
                bad = f"{c.column} IS NULL"
            elif c.kind == "accepted_values":
                bad = f"{c.column} NOT IN (" + ", ".join(f"'{v}'" for v in c.values) + ")"
            else:
                low = f"{c.column} {'<' if c.inclusive else '<='} {c.low}" if c.low is not None else "FALSE"
                high = f"{c.column} {'>' if c.inclusive else '>='} {c.high}" if c.high is not None else "FALSE"
                bad = f"({low} OR {high})"
            count = f"(SELECT COUNT(*) FROM {table} WHERE {bad})"
        parts.append(f"SELECT '{c.kind}' AS \"check\", '{c.column_label}' AS \"column\", {count} AS failing_rows")
    return "SELECT *, failing_rows = 0 AS passed FROM (" + " UNION ALL ".join(parts) + ")"


@query(_suite_sql("bronze_copies", checks.BRONZE_DEVICE), ("bronze_copies",))
def check_suite_bronze_device(spark, sf_dir):
    return run_checks(_bronze_devices(spark, sf_dir), checks.BRONZE_DEVICE)


@query(_suite_sql("silver_device", checks.SILVER_DEVICE), ("silver_device",))
def check_suite_silver_device(spark, sf_dir):
    return run_checks(_silver_devices(spark, sf_dir), checks.SILVER_DEVICE)


@query(_suite_sql("gold_engagement", checks.GOLD_ENGAGEMENT), ("gold_engagement",))
def check_suite_gold_engagement(spark, sf_dir):
    return run_checks(gold.gold_user_engagement(_engagement_input(spark, sf_dir)), checks.GOLD_ENGAGEMENT)


_TPCH_SUITE = [
    not_null("o_custkey"),
    unique("o_orderkey"),
    unique("o_custkey", "o_orderdate"),
    accepted_values("o_orderstatus", ["F", "O", "P"]),
    accepted_range("o_totalprice", low=1000),
    accepted_range("o_totalprice", high=400000),
]


@query(_suite_sql("orders", _TPCH_SUITE))
def check_suite(spark, sf_dir):
    return run_checks(fam.table(spark, sf_dir, "orders"), _TPCH_SUITE)


# ---- data sets --------------------------------------------------------------


@query("SELECT * FROM silver_device", ("silver_device",))
def silver_device_events(spark, sf_dir):
    return _silver_devices(spark, sf_dir)


@query("SELECT * FROM silver_txn", ("silver_txn",))
def silver_transactions(spark, sf_dir):
    return _silver_transactions(spark, sf_dir)


@query("SELECT * FROM activity", ("activity",))
def silver_user_activity(spark, sf_dir):
    return _activity(spark, sf_dir)


@query("SELECT * FROM activity", ("activity",))
def silver_user_activity_salted(spark, sf_dir):
    return _activity(spark, sf_dir, salts=4)


@query(
    f"""SELECT {SQL_AS_OF} AS aggregated_at, shares.* EXCLUDE (platform), platform_rollup.*,
      round(total_events / days_active, 2) AS avg_events_per_day,
      round(total_events / nullif(total_unique_users, 0), 2) AS avg_events_per_user
    FROM platform_rollup JOIN (
      SELECT platform, round(100 * avg(CAST(event_type = 'page_view' AS INTEGER)), 2) AS page_view_pct,
        round(100 * avg(CAST(device_type = 'mobile' AS INTEGER)), 2) AS mobile_event_pct
      FROM silver_device GROUP BY platform
    ) shares USING (platform)""",
    ("platform_rollup", "silver_device"),
)
def gold_platform_events(spark, sf_dir):
    return gold.gold_platform_events(_silver_devices(spark, sf_dir), as_of=fam.AS_OF)


@query("SELECT * FROM gold_conversion", ("gold_conversion",))
def gold_user_conversion(spark, sf_dir):
    return money_rounded(
        gold.gold_user_conversion(_activity(spark, sf_dir), _silver_transactions(spark, sf_dir), as_of=fam.AS_OF)
    )


@query("SELECT * FROM gold_engagement", ("gold_engagement",))
def gold_user_engagement(spark, sf_dir):
    return gold.gold_user_engagement(_engagement_input(spark, sf_dir))
