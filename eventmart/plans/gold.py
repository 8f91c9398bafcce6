"""Gold: platform, conversion and engagement marts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.functions.scoring import (
    bucketize_labels,
    conversion_flag,
    customer_segment,
    exact_avg,
    exact_sum,
    guarded_rate,
    round_half_up,
    safe_ratio,
    weighted_score,
)
from eventmart.functions.timecols import minutes_between, time_literal, whole_days_between
from eventmart.operators.aggregates import conditional_sums, count_true, mode_of_counts, mode_per_key, value_counts
from eventmart.operators.joins import full_outer_merge, left_merge
from eventmart.operators.ranks import pct_rank_avg
from eventmart.schemas import DEVICE_TYPES, EVENT_TYPES

AsOf = datetime | str | Column | None

# Score weights and percentile thresholds of the engagement mart.
ENGAGEMENT_WEIGHTS = {
    "total_events": 1.0,
    "unique_sessions": 5.0,
    "event_types_count": 3.0,
    "session_duration_minutes": 0.5,
}
ENGAGEMENT_STEPS = [(90, "highly_engaged"), (70, "engaged"), (40, "moderate")]
ENGAGEMENT_OTHER = "low"

# What the engagement mart reads; project to these before storing an input just for it.
ENGAGEMENT_INPUT = [
    "event_id",
    "event_timestamp",
    "event_date",
    "user_id",
    "device_id",
    "session_id",
    "event_type",
    "device_type",
    "platform",
    "browser",
    "page_load_time_ms",
]


CHOICES = {"device_type": "primary_device", "platform": "primary_platform", "browser": "primary_browser"}


def platform_daily(events: DataFrame) -> DataFrame:
    """Events, users and devices per platform, event type, device type and day."""
    return events.groupBy("platform", "event_type", "device_type", "event_date").agg(
        F.count(F.lit(1)).alias("event_count"),
        F.count_distinct("user_id").alias("unique_users"),
        F.count_distinct("device_id").alias("unique_devices"),
    )


def platform_rollup(daily: DataFrame) -> DataFrame:
    """Daily groups added up per platform.

    Adding distinct counts of finer groups counts a user once per group, so the two
    `total_unique_*` columns exceed the true distinct counts. That is their meaning.
    """
    return daily.groupBy("platform").agg(
        F.sum("event_count").alias("total_events"),
        F.sum("unique_users").alias("total_unique_users"),
        F.sum("unique_devices").alias("total_unique_devices"),
        F.count_distinct("event_date").alias("days_active"),
        F.min("event_date").alias("first_event_date"),
        F.max("event_date").alias("last_event_date"),
        *conditional_sums("event_type", {v: f"{v}_events" for v in EVENT_TYPES}, "event_count"),
        *conditional_sums("device_type", {v: f"{v}_events" for v in DEVICE_TYPES}, "event_count"),
    )


def gold_platform_events(events: DataFrame, as_of: AsOf = None) -> DataFrame:
    """One row per platform, largest first."""
    return platform_mart(platform_daily(events), as_of)


def platform_mart(daily: DataFrame, as_of: AsOf = None) -> DataFrame:
    """The platform mart from its daily groups, just made or stored."""
    return (
        platform_rollup(daily)
        .withColumns(
            {
                "avg_events_per_user": safe_ratio("total_events", "total_unique_users"),
                "avg_events_per_day": safe_ratio("total_events", "days_active"),
                "mobile_event_pct": safe_ratio("mobile_events", "total_events", 100.0),
                "page_view_pct": safe_ratio("page_view_events", "total_events", 100.0),
                "aggregated_at": time_literal(as_of),
            }
        )
        .orderBy(F.desc("total_events"))
    )


def user_activity_metrics(activity: DataFrame) -> DataFrame:
    """Activity per user and platform.

    Bounces and referrers count event-session rows, averages weigh a session by its
    events, as the columns are defined.
    """
    return activity.groupBy("user_id", "platform").agg(
        F.count_distinct("event_id").alias("total_events"),
        F.count_distinct("session_id").alias("total_sessions"),
        count_true("is_bounce").alias("bounce_sessions"),
        F.avg("session_duration_seconds").alias("avg_session_duration"),
        F.avg("pages_viewed").alias("avg_pages_viewed"),
        F.avg("interactions").alias("avg_interactions"),
        F.min("event_timestamp").alias("first_activity_date"),
        F.max("event_timestamp").alias("last_activity_date"),
        *conditional_sums("referrer", {v: f"{v}_sessions" for v in ("organic", "social", "paid")}),
    )


def transaction_metrics(transactions: DataFrame) -> DataFrame:
    """Purchases per user and platform."""
    return transactions.groupBy("user_id", "platform").agg(
        F.count(F.lit(1)).alias("total_transactions"),
        exact_sum("total_amount").alias("total_revenue"),
        exact_avg("total_amount").alias("avg_transaction_value"),
        count_true("is_first_purchase").alias("first_purchase_count"),
        F.min("transaction_timestamp").alias("first_purchase_date"),
        F.max("transaction_timestamp").alias("last_purchase_date"),
        F.count_distinct("product_category").alias("unique_categories_purchased"),
    )


def conversion_metrics(activity: DataFrame, transactions: DataFrame) -> DataFrame:
    """Both metric sets side by side, with the conversion flag and the segment.

    Both sides are aggregated before the join. A side that is absent gives 0 for the
    totals and NULL elsewhere, referrer counts included.
    """
    both = full_outer_merge(
        user_activity_metrics(activity), transaction_metrics(transactions), ["user_id", "platform"]
    )
    zero = ("total_events", "total_sessions", "bounce_sessions")
    purchases = F.when(F.col("in_right"), F.col("total_transactions"))
    return both.withColumns(
        {
            "has_converted": conversion_flag(
                F.when(F.col("in_left"), 1), F.when(F.col("in_right"), 1)
            ),
            "customer_segment": customer_segment(purchases),
            **{c: F.coalesce(F.col(c), F.lit(0)) for c in zero},
            "total_revenue": F.coalesce("total_revenue", F.lit(0.0)),
        }
    ).withColumn("total_transactions", F.coalesce("total_transactions", F.lit(0))).drop("in_left", "in_right")


def gold_user_conversion(activity: DataFrame, transactions: DataFrame, as_of: AsOf = None) -> DataFrame:
    """One row per user and platform, by revenue, then by events."""
    return (
        conversion_metrics(activity, transactions)
        .withColumns(
            {
                "session_conversion_rate": guarded_rate("total_transactions", "total_sessions"),
                "bounce_rate": guarded_rate("bounce_sessions", "total_sessions"),
                "customer_ltv": round_half_up("total_revenue"),
                "days_to_first_purchase": whole_days_between("first_activity_date", "first_purchase_date"),
                "aggregated_at": time_literal(as_of),
            }
        )
        .orderBy(F.desc("total_revenue"), F.desc("total_events"))
    )


def user_day_metrics(events: DataFrame) -> DataFrame:
    """Activity per user and day; rows without a user or a day form no group."""
    return (
        events.where(F.col("user_id").isNotNull() & F.col("event_date").isNotNull())
        .withColumn("event_date", F.col("event_date").cast("timestamp_ntz"))
        .groupBy("user_id", "event_date")
        .agg(
            F.count("event_id").alias("total_events"),
            F.count_distinct("session_id").alias("unique_sessions"),
            F.count_distinct("device_id").alias("unique_devices"),
            F.count_distinct("event_type").alias("event_types_count"),
            F.avg("page_load_time_ms").alias("avg_page_load_time_ms"),
            F.max("page_load_time_ms").alias("max_page_load_time_ms"),
            F.min("page_load_time_ms").alias("min_page_load_time_ms"),
            F.min("event_timestamp").alias("first_event_time"),
            F.max("event_timestamp").alias("last_event_time"),
        )
    )


def engagement_scores(user_days: DataFrame) -> DataFrame:
    return user_days.withColumn(
        "session_duration_minutes", minutes_between("first_event_time", "last_event_time")
    ).withColumn("engagement_score", weighted_score(ENGAGEMENT_WEIGHTS))


def engagement_category(percentile: Column | str) -> Column:
    return bucketize_labels(percentile, ENGAGEMENT_STEPS, ENGAGEMENT_OTHER)


def primary_choices(events: DataFrame) -> DataFrame:
    """Most used device type, platform and browser per user."""
    return mode_per_key(events, "user_id", CHOICES)


def scored_user_days(events: DataFrame) -> DataFrame:
    """Scored user days with their day as a date, to be stored by day."""
    return engagement_scores(user_day_metrics(events)).withColumn("event_day", F.col("event_date").cast("date"))


def daily_choices(events: DataFrame) -> DataFrame:
    """How often a user used each device type, platform and browser on each day."""
    return value_counts(events, "user_id", list(CHOICES), by="event_date")


def engagement_mart(ranked: DataFrame, choices: DataFrame) -> DataFrame:
    """The engagement mart from stored user days with their percentile, and from stored daily choices."""
    added_up = choices.groupBy("user_id", "slot", "value").agg(F.sum("n").alias("n"))
    labelled = ranked.drop("event_day").withColumn("engagement_category", engagement_category("engagement_percentile"))
    return left_merge(labelled, mode_of_counts(added_up, "user_id", CHOICES), "user_id")


def gold_user_engagement(events: DataFrame) -> DataFrame:
    """One row per user and day, scored and ranked against all other user days."""
    scored = engagement_scores(user_day_metrics(events))
    ranked = pct_rank_avg(scored, "engagement_score", "engagement_percentile").withColumn(
        "engagement_category", engagement_category("engagement_percentile")
    )
    return left_merge(ranked, primary_choices(events), "user_id")
