"""Silver: deduplicated, unpacked, validated and session-enriched rows.

Each function returns the batch of one run. `target` is the table so far (None on
the first run); `bounds` may be passed when they are already known.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.functions.payload import unpack_payload
from eventmart.functions.timecols import time_literal
from eventmart.operators.dedup import latest_per_key
from eventmart.operators.incremental import (
    LOOKBACK_MINUTES,
    Bounds,
    lookback_bounds,
    new_or_changed,
    strict_lookback,
    within_lookback,
)
from eventmart.operators.joins import interval_join
from eventmart.operators.quality import validate_events
from eventmart.schemas import FAMILIES, NO_SESSION, TRANSACTION_RAW
from eventmart.sources.scan import SOURCE

AsOf = datetime | str | Column | None
SESSION_REACH_SECONDS = 300

DEVICE_REQUIRED = ["event_id", "event_timestamp", "user_id", "device_id", "event_type", "event_window_start"]
ACTIVITY_REQUIRED = ["event_id", "event_timestamp", "user_id"]
TRANSACTION_REQUIRED = ["transaction_id", "transaction_timestamp", "user_id"]

_SESSION_TAKE = {
    "session_id": "session_id",
    "session_duration_seconds": "session_duration_seconds",
    "pages_viewed": "pages_viewed",
    "interactions": "interactions",
    "is_bounce": "is_bounce",
    "referrer": "referrer",
    "landing_page": "landing_page",
    "loaded_at": "session_loaded_at",
}


def recent(bronze: DataFrame, family: str, bounds: Bounds) -> DataFrame:
    """Bronze rows inside the lookback. The filter stays below the dedup, where it prunes."""
    fam = FAMILIES[family]
    return within_lookback(bronze, fam.window, bounds, date_col=fam.date)


def newest(bronze: DataFrame, family: str) -> DataFrame:
    """One row per event key: last load first, then last file, then latest event time."""
    fam = FAMILIES[family]
    order = [c for c in ("loaded_at", SOURCE, fam.ts) if c in bronze.columns]
    return latest_per_key(bronze, fam.key, order)


def validate_device(events: DataFrame, as_of: AsOf = None) -> DataFrame:
    return validate_events(events, DEVICE_REQUIRED, "event_timestamp", as_of)


def validate_transactions(transactions: DataFrame, as_of: AsOf = None) -> DataFrame:
    rules = [F.col("total_amount") >= 0, F.col("quantity") > 0]
    return validate_events(transactions, TRANSACTION_REQUIRED, "transaction_timestamp", as_of, rules=rules)


def validate_activity(activity: DataFrame, as_of: AsOf = None) -> DataFrame:
    return validate_events(activity, ACTIVITY_REQUIRED, "event_timestamp", as_of)


def silver_device_events(
    bronze: DataFrame,
    target: DataFrame | None = None,
    as_of: AsOf = None,
    lookback_minutes: int = LOOKBACK_MINUTES,
    bounds: Bounds | None = None,
) -> DataFrame:
    """New or changed device events with a flat payload, one row per `event_id`."""
    bounds = bounds or lookback_bounds(target, "event_window_start", lookback_minutes)
    known = None
    if bounds.incremental:
        known = within_lookback(target, "event_window_start", bounds, date_col="event_date")
    changed = new_or_changed(newest(recent(bronze, "device", bounds), "device"), known, "event_id", "loaded_at")
    flat = unpack_payload(
        changed.select(
            "event_id",
            "event_timestamp",
            "user_id",
            "device_id",
            "device_type",
            "platform",
            "event_type",
            "event_date",
            "loaded_at",
            "event_window_start",
            "payload",
        )
    )
    return validate_device(flat, as_of)


def silver_transactions(
    bronze: DataFrame,
    target: DataFrame | None = None,
    as_of: AsOf = None,
    lookback_minutes: int = LOOKBACK_MINUTES,
    bounds: Bounds | None = None,
) -> DataFrame:
    """Valid transactions, one row per `transaction_id`."""
    fam = FAMILIES["transaction"]
    bounds = bounds or lookback_bounds(target, fam.window, lookback_minutes)
    deduped = newest(recent(bronze, "transaction", bounds), "transaction")
    columns = [fam.ts if c == "timestamp" else c for c in TRANSACTION_RAW.names]
    valid = validate_transactions(deduped, as_of).select(
        *columns, fam.date, fam.window, "loaded_at", time_literal(as_of).alias("processed_at")
    )
    return strict_lookback(valid, fam.window, bounds, date_col=fam.date)


def silver_user_activity(
    bronze_devices: DataFrame,
    bronze_sessions: DataFrame,
    target: DataFrame | None = None,
    as_of: AsOf = None,
    lookback_minutes: int = LOOKBACK_MINUTES,
    bounds: Bounds | None = None,
    salts: int = 1,
) -> DataFrame:
    """Device events with every session of the same user and platform within five minutes.

    An event without a session keeps one row with NULL session columns.
    """
    bounds = bounds or lookback_bounds(target, "activity_window_start", lookback_minutes)
    devices = recent(bronze_devices, "device", bounds).select(
        "event_id",
        "event_timestamp",
        "user_id",
        "device_id",
        "device_type",
        "platform",
        "event_type",
        "event_date",
        "event_window_start",
        SOURCE,
        "loaded_at",
    )
    sessions = recent(bronze_sessions, "session", bounds).select(
        "session_id",
        "session_timestamp",
        "user_id",
        "platform",
        "session_duration_seconds",
        "pages_viewed",
        "interactions",
        "is_bounce",
        "referrer",
        "landing_page",
        SOURCE,
        "loaded_at",
    )
    # Rows the validation would drop after the join are dropped before it: the rules
    # look at device columns only, so the result is the same and the join is smaller.
    events = validate_activity(newest(devices, "device"), as_of).drop(SOURCE)
    joined = interval_join(
        events.withColumnsRenamed(
            {"event_window_start": "activity_window_start", "loaded_at": "device_loaded_at"}
        ),
        newest(sessions, "session"),
        ["user_id", "platform"],
        "event_timestamp",
        "session_timestamp",
        SESSION_REACH_SECONDS,
        _SESSION_TAKE,
        salts=salts,
    )
    activity_id = F.concat(
        F.col("event_id"), F.lit("_"), F.coalesce(F.col("session_id"), F.lit(NO_SESSION))
    )
    activity = joined.select(
        activity_id.alias("activity_id"),
        "event_id",
        "event_timestamp",
        "user_id",
        "device_id",
        "device_type",
        "platform",
        "event_type",
        "event_date",
        "activity_window_start",
        *[name for name in _SESSION_TAKE.values() if name != "session_loaded_at"],
        "device_loaded_at",
        "session_loaded_at",
        time_literal(as_of).alias("processed_at"),
    )
    return strict_lookback(activity, "activity_window_start", bounds, date_col="event_date")


def stale_unmatched(batch: DataFrame) -> DataFrame:
    """Keys under which events of the batch were stored before they found a session."""
    return (
        batch.where(F.col("session_id").isNotNull())
        .select(F.concat("event_id", F.lit(f"_{NO_SESSION}")).alias("activity_id"))
        .distinct()
    )
