"""The three raw families derived from the `events` table by fixed integer rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.functions.timecols import time_literal
from eventmart.plans.bronze import parse_raw
from eventmart.schemas import (
    BROWSERS,
    DEVICE_TYPES,
    PLATFORMS,
    PRODUCT_CATEGORIES,
    REFERRERS,
)
from eventmart.sources.scan import SOURCE

AS_OF = "2024-01-30 00:00:00"
LOADED_AT = "2024-01-31 00:00:00"
RELOADED_AT = "2024-01-31 01:00:00"
SPLIT_AT = "2024-01-20 00:00:00"
REPEAT_FROM = "2024-01-19 23:45:00"
STAMP = "20240131_000000"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` with `k`, the integer inside `props`."""
    return table(spark, sf_dir, "events").withColumn(
        "k", F.get_json_object("props", "$.k").cast("int")
    )


def _pick(domain: list[str], index: str) -> str:
    values = ", ".join(f"'{v}'" for v in domain)
    return f"element_at(array({values}), cast({index} + 1 as int))"


def _time(as_text: bool) -> str:
    """Event time as stored, or as the raw families write it: ISO-8601 text in UTC."""
    text = "concat(date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\"), '+00:00')"
    return f"{text if as_text else 'ts'} AS timestamp"


_USER = "concat('user_', user_id) AS user_id"


def raw_device(ev: DataFrame, as_text: bool = False) -> DataFrame:
    return ev.selectExpr(
        "cast(event_id as string) AS event_id",
        _time(as_text),
        _USER,
        "concat('dev_', user_id, '_', event_id % 3) AS device_id",
        f"{_pick(DEVICE_TYPES, 'event_id % 4')} AS device_type",
        f"{_pick(PLATFORMS, 'user_id % 5')} AS platform",
        """CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'click' WHEN 'signup' THEN 'form_submit'
          WHEN 'purchase' THEN 'video_complete' WHEN 'error' THEN 'scroll' END AS event_type""",
        f"""named_struct(
          'screen_resolution', '1920x1080',
          'browser', {_pick(BROWSERS, 'k % 4')},
          'browser_version', '100.0',
          'location', named_struct('city', 'Springfield', 'country', 'US',
            'latitude', cast(k % 90 as double), 'longitude', cast(-(k % 180) as double)),
          'session', named_struct('session_id', concat('s_', user_id, '_', event_id % 7),
            'session_start', '2024-01-01T00:00:00', 'is_new_session', k % 2 = 0),
          'performance', named_struct('page_load_time_ms', cast(100 + k * 10 as bigint), 'network_type', 'WiFi')
        ) AS payload""",
    )


def raw_session(ev: DataFrame, as_text: bool = False) -> DataFrame:
    return ev.where("event_type = 'signup'").selectExpr(
        "concat('sess_', event_id) AS session_id",
        _time(as_text),
        _USER,
        f"{_pick(PLATFORMS, 'user_id % 5')} AS platform",
        "'mobile' AS device_type",
        "cast(30 + k * 7 as bigint) AS session_duration_seconds",
        "cast(1 + k % 20 as bigint) AS pages_viewed",
        "cast(k % 51 as bigint) AS interactions",
        "k < 5 AS is_bounce",
        f"{_pick(REFERRERS, 'k % 5')} AS referrer",
        "'/page/home' AS landing_page",
    )


def raw_transaction(ev: DataFrame, as_text: bool = False) -> DataFrame:
    return ev.where("event_type = 'purchase'").selectExpr(
        "concat('txn_', event_id) AS transaction_id",
        _time(as_text),
        _USER,
        f"{_pick(PLATFORMS, '(user_id + if(user_id % 7 = 0, 1, 0)) % 5')} AS platform",
        "'prod_100' AS product_id",
        f"{_pick(PRODUCT_CATEGORIES, 'k % 6')} AS product_category",
        "cast(1 + k % 5 as bigint) AS quantity",
        "value AS unit_price",
        "value * cast(1 + k % 5 as bigint) AS total_amount",
        "'USD' AS currency",
        "'credit_card' AS payment_method",
        "'US' AS shipping_country",
        "k % 5 = 0 AS is_first_purchase",
    )


RAW = {"device": raw_device, "session": raw_session, "transaction": raw_transaction}


def bronze(ev: DataFrame, family: str, as_text: bool = False) -> DataFrame:
    raw = RAW[family](ev, as_text).withColumn(SOURCE, F.lit(f"{family}_events_{STAMP}.parquet"))
    return parse_raw(raw, family, LOADED_AT)


def bronze_device_with_copies(ev: DataFrame) -> DataFrame:
    """Device rows where every tenth event was loaded again, an hour later, as a click."""
    rows = bronze(ev, "device")
    again = bronze(ev.where(F.col("event_id") % 10 == 0), "device").withColumns(
        {"loaded_at": time_literal(RELOADED_AT), "event_type": F.lit("click")}
    )
    return rows.unionByName(again)
