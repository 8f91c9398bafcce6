"""Raw family schemas, value domains and the column roles each family plays."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# The domains the event families draw from.
DEVICE_TYPES = ["mobile", "tablet", "laptop", "desktop"]
PLATFORMS = ["iOS", "Android", "Windows", "MacOS", "Linux"]
EVENT_TYPES = ["page_view", "click", "scroll", "video_start", "video_complete", "form_submit"]
BROWSERS = ["Chrome", "Safari", "Firefox", "Edge"]
REFERRERS = ["organic", "social", "direct", "email", "paid"]
PRODUCT_CATEGORIES = ["electronics", "clothing", "food", "books", "toys", "sports"]
ENGAGEMENT_CATEGORIES = ["highly_engaged", "engaged", "moderate", "low"]
NO_SESSION = "no_session"

# Names and types of the raw files.
PAYLOAD = T.StructType(
    [
        T.StructField("screen_resolution", T.StringType()),
        T.StructField("browser", T.StringType()),
        T.StructField("browser_version", T.StringType()),
        T.StructField(
            "location",
            T.StructType(
                [
                    T.StructField("city", T.StringType()),
                    T.StructField("country", T.StringType()),
                    T.StructField("latitude", T.DoubleType()),
                    T.StructField("longitude", T.DoubleType()),
                ]
            ),
        ),
        T.StructField(
            "session",
            T.StructType(
                [
                    T.StructField("session_id", T.StringType()),
                    T.StructField("session_start", T.StringType()),
                    T.StructField("is_new_session", T.BooleanType()),
                ]
            ),
        ),
        T.StructField(
            "performance",
            T.StructType(
                [
                    T.StructField("page_load_time_ms", T.LongType()),
                    T.StructField("network_type", T.StringType()),
                ]
            ),
        ),
    ]
)

# Fixed values, as above.
DEVICE_RAW = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("device_id", T.StringType()),
        T.StructField("device_type", T.StringType()),
        T.StructField("platform", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("payload", PAYLOAD),
    ]
)

# Fixed values, as above.
SESSION_RAW = T.StructType(
    [
        T.StructField("session_id", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("platform", T.StringType()),
        T.StructField("device_type", T.StringType()),
        T.StructField("session_duration_seconds", T.LongType()),
        T.StructField("pages_viewed", T.LongType()),
        T.StructField("interactions", T.LongType()),
        T.StructField("is_bounce", T.BooleanType()),
        T.StructField("referrer", T.StringType()),
        T.StructField("landing_page", T.StringType()),
    ]
)

# Fixed values, as above.
TRANSACTION_RAW = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("platform", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("product_category", T.StringType()),
        T.StructField("quantity", T.LongType()),
        T.StructField("unit_price", T.DoubleType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("currency", T.StringType()),
        T.StructField("payment_method", T.StringType()),
        T.StructField("shipping_country", T.StringType()),
        T.StructField("is_first_purchase", T.BooleanType()),
    ]
)

# Leaf path in the payload -> (silver column, silver type).
# Fixed values, as above.
PAYLOAD_LEAVES = {
    "screen_resolution": ("screen_resolution", "string"),
    "browser": ("browser", "string"),
    "browser_version": ("browser_version", "string"),
    "location.city": ("city", "string"),
    "location.country": ("country", "string"),
    "location.latitude": ("latitude", "double"),
    "location.longitude": ("longitude", "double"),
    "session.session_id": ("session_id", "string"),
    "session.is_new_session": ("is_new_session", "boolean"),
    "performance.page_load_time_ms": ("page_load_time_ms", "int"),
    "performance.network_type": ("network_type", "string"),
}


@dataclass(frozen=True)
class Family:
    """One raw event family and the names its time columns take in bronze."""

    name: str
    key: str
    raw: T.StructType
    ts: str
    date: str
    window: str

    @property
    def glob(self) -> str:
        return f"{self.name}_events_*.parquet"

    @property
    def table(self) -> str:
        return f"bronze_{self.name}_events"


FAMILIES = {
    f.name: f
    for f in (
        Family("device", "event_id", DEVICE_RAW, "event_timestamp", "event_date", "event_window_start"),
        Family("session", "session_id", SESSION_RAW, "session_timestamp", "session_date", "session_window_start"),
        Family(
            "transaction",
            "transaction_id",
            TRANSACTION_RAW,
            "transaction_timestamp",
            "transaction_date",
            "transaction_window_start",
        ),
    )
}
