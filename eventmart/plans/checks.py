"""The check suites run after each build."""

from __future__ import annotations

from eventmart.operators.quality import accepted_range, accepted_values, not_null, unique
from eventmart.schemas import DEVICE_TYPES, ENGAGEMENT_CATEGORIES, EVENT_TYPES

# Which columns each table is checked on, and against what.
BRONZE_DEVICE = [
    not_null("event_id"),
    unique("event_id"),
    not_null("event_timestamp"),
    not_null("user_id"),
    not_null("device_id"),
    accepted_values("device_type", DEVICE_TYPES),
    not_null("event_type"),
    accepted_values("event_type", EVENT_TYPES),
    not_null("event_date"),
]

SILVER_DEVICE = [
    not_null("event_id"),
    unique("event_id"),
    not_null("event_timestamp"),
    not_null("user_id"),
    not_null("device_id"),
    not_null("session_id"),
    not_null("event_window_start"),
    accepted_range("page_load_time_ms", 0, 60000),
    accepted_range("latitude", -90, 90),
    accepted_range("longitude", -180, 180),
]

# A row is a user and a day, so that pair is what must be unique, not the user alone.
GOLD_ENGAGEMENT = [
    not_null("user_id"),
    unique("user_id", "event_date"),
    not_null("event_date"),
    not_null("total_events"),
    accepted_range("total_events", low=0),
    not_null("engagement_score"),
    accepted_values("engagement_category", ENGAGEMENT_CATEGORIES),
]

SUITES = {
    "bronze_device_events": BRONZE_DEVICE,
    "silver_device_events": SILVER_DEVICE,
    "gold_user_engagement": GOLD_ENGAGEMENT,
}
