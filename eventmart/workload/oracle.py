"""SQL that must give the same rows as the registered queries, built from shared CTEs."""

from __future__ import annotations

from eventmart.schemas import DEVICE_TYPES, EVENT_TYPES

AS_OF = "TIMESTAMP '2024-01-30 00:00:00'"

CTES: dict[str, tuple[list[str], str]] = {
    "ev": (
        [],
        "SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events",
    ),
    "bronze_device": (
        ["ev"],
        """SELECT CAST(event_id AS VARCHAR) AS event_id, ts AS event_timestamp,
          'user_' || user_id AS user_id,
          'dev_' || user_id || '_' || (event_id % 3) AS device_id,
          CASE event_id % 4 WHEN 0 THEN 'mobile' WHEN 1 THEN 'tablet' WHEN 2 THEN 'laptop' ELSE 'desktop' END AS device_type,
          CASE user_id % 5 WHEN 0 THEN 'iOS' WHEN 1 THEN 'Android' WHEN 2 THEN 'Windows' WHEN 3 THEN 'MacOS' ELSE 'Linux' END AS platform,
          CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'click' WHEN 'signup' THEN 'form_submit'
            WHEN 'purchase' THEN 'video_complete' WHEN 'error' THEN 'scroll' END AS event_type,
          CAST(ts AS DATE) AS event_date,
          date_trunc('minute', ts) - to_minutes(CAST(EXTRACT(minute FROM ts) AS BIGINT) % 10) AS event_window_start,
          'device_events_20240131_000000.parquet' AS source_filename,
          TIMESTAMP '2024-01-31 00:00:00' AS loaded_at,
          '1920x1080' AS screen_resolution,
          CASE k % 4 WHEN 0 THEN 'Chrome' WHEN 1 THEN 'Safari' WHEN 2 THEN 'Firefox' ELSE 'Edge' END AS browser,
          '100.0' AS browser_version, 'Springfield' AS city, 'US' AS country,
          CAST(k % 90 AS DOUBLE) AS latitude, CAST(-(k % 180) AS DOUBLE) AS longitude,
          's_' || user_id || '_' || (event_id % 7) AS session_id,
          k % 2 = 0 AS is_new_session,
          CAST(100 + k * 10 AS INTEGER) AS page_load_time_ms, 'WiFi' AS network_type
        FROM ev""",
    ),
    "bronze_session": (
        ["ev"],
        """SELECT 'sess_' || event_id AS session_id, ts AS session_timestamp, 'user_' || user_id AS user_id,
          CASE user_id % 5 WHEN 0 THEN 'iOS' WHEN 1 THEN 'Android' WHEN 2 THEN 'Windows' WHEN 3 THEN 'MacOS' ELSE 'Linux' END AS platform,
          'mobile' AS device_type,
          CAST(30 + k * 7 AS BIGINT) AS session_duration_seconds,
          CAST(1 + k % 20 AS BIGINT) AS pages_viewed, CAST(k % 51 AS BIGINT) AS interactions,
          k < 5 AS is_bounce,
          CASE k % 5 WHEN 0 THEN 'organic' WHEN 1 THEN 'social' WHEN 2 THEN 'direct' WHEN 3 THEN 'email' ELSE 'paid' END AS referrer,
          '/page/home' AS landing_page,
          CAST(ts AS DATE) AS session_date,
          date_trunc('minute', ts) - to_minutes(CAST(EXTRACT(minute FROM ts) AS BIGINT) % 10) AS session_window_start,
          'session_events_20240131_000000.parquet' AS source_filename,
          TIMESTAMP '2024-01-31 00:00:00' AS loaded_at
        FROM ev WHERE event_type = 'signup'""",
    ),
    "bronze_transaction": (
        ["ev"],
        """SELECT 'txn_' || event_id AS transaction_id, ts AS transaction_timestamp, 'user_' || user_id AS user_id,
          CASE (user_id + CASE WHEN user_id % 7 = 0 THEN 1 ELSE 0 END) % 5
            WHEN 0 THEN 'iOS' WHEN 1 THEN 'Android' WHEN 2 THEN 'Windows' WHEN 3 THEN 'MacOS' ELSE 'Linux' END AS platform,
          'prod_100' AS product_id,
          CASE k % 6 WHEN 0 THEN 'electronics' WHEN 1 THEN 'clothing' WHEN 2 THEN 'food' WHEN 3 THEN 'books'
            WHEN 4 THEN 'toys' ELSE 'sports' END AS product_category,
          CAST(1 + k % 5 AS BIGINT) AS quantity, value AS unit_price, value * CAST(1 + k % 5 AS BIGINT) AS total_amount,
          'USD' AS currency, 'credit_card' AS payment_method, 'US' AS shipping_country,
          k % 5 = 0 AS is_first_purchase,
          CAST(ts AS DATE) AS transaction_date,
          date_trunc('minute', ts) - to_minutes(CAST(EXTRACT(minute FROM ts) AS BIGINT) % 10) AS transaction_window_start,
          'transaction_events_20240131_000000.parquet' AS source_filename,
          TIMESTAMP '2024-01-31 00:00:00' AS loaded_at
        FROM ev WHERE event_type = 'purchase'""",
    ),
    "bronze_copies": (
        ["bronze_device"],
        """SELECT * FROM bronze_device UNION ALL
        SELECT * REPLACE (TIMESTAMP '2024-01-31 01:00:00' AS loaded_at, 'click' AS event_type)
        FROM bronze_device WHERE CAST(event_id AS BIGINT) % 10 = 0""",
    ),
    "device_latest": (
        ["bronze_copies"],
        """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY event_id
          ORDER BY loaded_at DESC, source_filename DESC, event_timestamp DESC) AS rn FROM bronze_copies) WHERE rn = 1""",
    ),
    "silver_device": (
        ["device_latest"],
        f"""SELECT * EXCLUDE (source_filename) FROM device_latest
        WHERE event_id IS NOT NULL AND event_timestamp IS NOT NULL AND user_id IS NOT NULL AND device_id IS NOT NULL
          AND event_type IS NOT NULL AND event_window_start IS NOT NULL
          AND event_timestamp <= {AS_OF} AND event_timestamp >= {AS_OF} - INTERVAL 30 DAY""",
    ),
    "silver_txn": (
        ["bronze_transaction"],
        f"""SELECT * EXCLUDE (source_filename), {AS_OF} AS processed_at FROM bronze_transaction
        WHERE transaction_id IS NOT NULL AND transaction_timestamp IS NOT NULL AND user_id IS NOT NULL
          AND total_amount >= 0 AND quantity > 0
          AND transaction_timestamp <= {AS_OF} AND transaction_timestamp >= {AS_OF} - INTERVAL 30 DAY""",
    ),
    "joined": (
        ["device_latest", "bronze_session"],
        """SELECT concat_ws('_', event_id, ifnull(near.session_id, 'no_session')) AS activity_id,
          device_latest.* EXCLUDE (session_id, event_window_start, loaded_at, source_filename, screen_resolution, browser,
            browser_version, city, country, latitude, longitude, is_new_session, page_load_time_ms, network_type),
          event_window_start AS activity_window_start, loaded_at AS device_loaded_at, near.*
        FROM device_latest LEFT JOIN (
          SELECT user_id AS of_user, platform AS on_platform, session_timestamp AS began, session_id, session_duration_seconds,
            pages_viewed, interactions, is_bounce, referrer, landing_page, loaded_at AS session_loaded_at FROM bronze_session
        ) near ON of_user = user_id AND on_platform = platform
          AND abs(date_diff('microsecond', event_timestamp, began)) <= 300000000""",
    ),
    "activity": (
        ["joined"],
        f"""SELECT * EXCLUDE (of_user, on_platform, began), {AS_OF} AS processed_at FROM joined
        WHERE event_id IS NOT NULL AND event_timestamp IS NOT NULL AND user_id IS NOT NULL
          AND event_timestamp <= {AS_OF} AND event_timestamp >= {AS_OF} - INTERVAL 30 DAY""",
    ),
    "platform_daily": (
        ["silver_device"],
        """WITH once AS (
          SELECT DISTINCT event_date, platform, device_type, event_type, user_id, device_id, count(*) OVER w AS event_count
          FROM silver_device WINDOW w AS (PARTITION BY event_date, platform, device_type, event_type)
        )
        SELECT event_date, platform, device_type, event_type, any_value(event_count) AS event_count,
          count(DISTINCT user_id) AS unique_users, count(DISTINCT device_id) AS unique_devices
        FROM once GROUP BY event_date, platform, device_type, event_type""",
    ),
    "platform_rollup": (
        ["silver_device"],
        """SELECT platform, count(*) AS total_events,
          count(DISTINCT (event_date, event_type, device_type, user_id)) AS total_unique_users,
          count(DISTINCT (event_date, event_type, device_type, device_id)) AS total_unique_devices,
          """
        + ", ".join(
            f"count(*) FILTER ({col} = '{v}') AS {v}_events"
            for col, vs in (("device_type", DEVICE_TYPES), ("event_type", EVENT_TYPES))
            for v in vs
        )
        + """, len(list_distinct(list(event_date))) AS days_active,
          min(event_date) AS first_event_date, max(event_date) AS last_event_date
        FROM silver_device GROUP BY platform""",
    ),
    # Conversion: every user and platform seen on either side, then one lookup per side.
    "pair": (
        ["activity", "silver_txn"],
        "SELECT user_id, platform FROM activity UNION SELECT user_id, platform FROM silver_txn",
    ),
    "seen": (
        ["activity"],
        """SELECT user_id, platform, min(event_timestamp) AS first_activity_date, max(event_timestamp) AS last_activity_date,
          avg(interactions) AS avg_interactions, avg(pages_viewed) AS avg_pages_viewed,
          avg(session_duration_seconds) AS avg_session_duration,
          len(list_distinct(list(event_id))) AS total_events,
          ifnull(len(list_distinct(list(session_id) FILTER (session_id IS NOT NULL))), 0) AS total_sessions,
          count_if(is_bounce) AS bounce_sessions,
          count(*) FILTER (referrer = 'organic') AS organic_sessions, count(*) FILTER (referrer = 'social') AS social_sessions,
          count(*) FILTER (referrer = 'paid') AS paid_sessions
        FROM activity GROUP BY user_id, platform""",
    ),
    "bought": (
        ["silver_txn"],
        """SELECT user_id, platform, min(transaction_timestamp) AS first_purchase_date,
          max(transaction_timestamp) AS last_purchase_date, count(transaction_id) AS total_transactions,
          round(sum(total_amount), 6) AS total_revenue, round(avg(total_amount), 6) AS avg_transaction_value,
          count_if(is_first_purchase) AS first_purchase_count,
          len(list_distinct(list(product_category))) AS unique_categories_purchased
        FROM silver_txn GROUP BY user_id, platform""",
    ),
    "conversion": (
        ["pair", "seen", "bought"],
        """SELECT p.user_id, p.platform,
          s.* EXCLUDE (user_id, platform) REPLACE (ifnull(s.total_events, 0) AS total_events,
            ifnull(s.total_sessions, 0) AS total_sessions, CAST(ifnull(s.bounce_sessions, 0) AS BIGINT) AS bounce_sessions),
          b.* EXCLUDE (user_id, platform) REPLACE (ifnull(b.total_transactions, 0) AS total_transactions,
            ifnull(b.total_revenue, 0) AS total_revenue, CAST(b.first_purchase_count AS BIGINT) AS first_purchase_count),
          s.user_id IS NOT NULL AND b.user_id IS NOT NULL AS has_converted,
          (MAP {0: 'Non-Purchaser', 1: 'One-Time Buyer', 2: 'Repeat Buyer', 3: 'Loyal Customer'})[
            least(ifnull(b.total_transactions, 0), 2) + CAST(ifnull(b.total_transactions, 0) > 5 AS INTEGER)] AS customer_segment
        FROM pair p LEFT JOIN seen s USING (user_id, platform) LEFT JOIN bought b USING (user_id, platform)""",
    ),
    "gold_conversion": (
        ["conversion"],
        f"""SELECT *, {AS_OF} AS aggregated_at, round(total_revenue, 2) AS customer_ltv,
          ifnull(round(100 * (total_transactions / nullif(total_sessions, 0)), 2), 0) AS session_conversion_rate,
          ifnull(round(100 * (bounce_sessions / nullif(total_sessions, 0)), 2), 0) AS bounce_rate,
          CAST(trunc(date_diff('microsecond', first_activity_date, first_purchase_date) / 86400000000) AS BIGINT) AS days_to_first_purchase
        FROM conversion""",
    ),
    "user_day": (
        ["silver_device"],
        """SELECT user_id, CAST(event_date AS TIMESTAMP) AS event_date, COUNT(event_id) AS total_events,
          COUNT(DISTINCT session_id) AS unique_sessions, COUNT(DISTINCT device_id) AS unique_devices,
          COUNT(DISTINCT event_type) AS event_types_count,
          AVG(page_load_time_ms) AS avg_page_load_time_ms, MAX(page_load_time_ms) AS max_page_load_time_ms,
          MIN(page_load_time_ms) AS min_page_load_time_ms,
          MIN(event_timestamp) AS first_event_time, MAX(event_timestamp) AS last_event_time
        FROM silver_device WHERE user_id IS NOT NULL AND event_date IS NOT NULL GROUP BY user_id, event_date""",
    ),
    "scored": (
        ["user_day"],
        """SELECT *, total_events * CAST(1 AS DOUBLE) + unique_sessions * CAST(5 AS DOUBLE)
            + event_types_count * CAST(3 AS DOUBLE) + session_duration_minutes * CAST(0.5 AS DOUBLE) AS engagement_score
        FROM (SELECT *, date_diff('microsecond', first_event_time, last_event_time) / CAST(1000000 AS DOUBLE)
            / CAST(60 AS DOUBLE) AS session_duration_minutes FROM user_day)""",
    ),
    "ranked": (
        ["scored"],
        """SELECT *, CASE WHEN engagement_percentile >= 90 THEN 'highly_engaged' WHEN engagement_percentile >= 70 THEN 'engaged'
            WHEN engagement_percentile >= 40 THEN 'moderate' ELSE 'low' END AS engagement_category
        FROM (SELECT *, (rank() OVER (ORDER BY engagement_score) - 1
            + (COUNT(*) OVER (PARTITION BY engagement_score) + 1) / CAST(2 AS DOUBLE)) / CAST(COUNT(*) OVER () AS DOUBLE) * 100
            AS engagement_percentile FROM scored)""",
    ),
    "choices": (
        ["silver_device"],
        """SELECT user_id, """
        + ", ".join(
            f"""(SELECT v FROM (SELECT {col} AS v, COUNT(*) AS n FROM silver_device i
               WHERE i.user_id = u.user_id AND {col} IS NOT NULL GROUP BY {col}) ORDER BY n DESC, v LIMIT 1) AS {name}"""
            for col, name in (
                ("device_type", "primary_device"),
                ("platform", "primary_platform"),
                ("browser", "primary_browser"),
            )
        )
        + " FROM (SELECT DISTINCT user_id FROM silver_device) u",
    ),
    "gold_engagement": (
        ["ranked", "choices"],
        """SELECT r.*, c.primary_device, c.primary_platform, c.primary_browser
        FROM ranked r LEFT JOIN choices c ON r.user_id = c.user_id""",
    ),
}


def with_ctes(body: str, *names: str) -> str:
    """`body` preceded by the named CTEs and everything they need, in order."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for need in CTES[name][0]:
            add(need)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    if not ordered:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n][1]})" for n in ordered) + "\n" + body
